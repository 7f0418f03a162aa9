"""Byte-level BPE encoding and decoding with a rank vocabulary.

Encoding looks each pre-token up twice at most. A minimal perfect hash over the vocabulary resolves pre-tokens that are
entries themselves. The rest is merged, lowest rank first, leftmost on ties: short pre-tokens of many texts side by side, one
merge of each in a round; long ones with a heap over linked bytes. Results are kept in a bounded table in each Python worker, so
frequent words cost one look-up.

Ids travel as binary columns of little-endian unsigned 32-bit integers; ``decode`` turns them back into bytes. Null text
counts as empty and gives empty binaries. Long texts are worked on in pieces that are cut where no pre-token can span.
Rows are independent: ties, repeated rows and other columns do not matter.
"""

from __future__ import annotations

import base64
from functools import cached_property
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.llm.common import bounded_batches

#: Entries of a worker's table of known pre-tokens; it is emptied when full.
KNOWN = 300_000
PIECE = 1 << 18
#: Bytes of pre-tokens that are merged side by side, and how many are at once.
SHORT, BLOCK = 32, 4096
_NO_RANK = np.iinfo(np.int32).max


def _mixed(hashes: np.ndarray, level: int) -> np.ndarray:
    h = hashes ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of n distinct 64-bit keys onto 0..n-1.

    A key is settled on the first level where no other open key shares its cell; its number is the rank of that cell
    among the settled ones. Twice as many cells as open keys settle about 60 % on each level.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        open_keys, before = keys, 0
        while len(open_keys):
            cells = max(64, 2 * len(open_keys))
            at = (_mixed(open_keys, len(self.levels)) % np.uint64(cells)).astype(np.int64)
            alone = np.bincount(at, minlength=cells) == 1
            self.levels.append((alone, (before + np.cumsum(alone) - 1).astype(np.int32)))
            before += int(alone.sum())
            open_keys = open_keys[~alone[at]]

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; for a key outside the set any number or -1."""
        out = np.full(len(keys), -1, np.int32)
        left = np.arange(len(keys))
        for level, (alone, rank) in enumerate(self.levels):
            at = (_mixed(keys[left], level) % np.uint64(len(alone))).astype(np.int64)
            hit = alone[at]
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return out


class Vocabulary:
    """Entries by id with the pattern that splits text; only these travel, tables are built where they are used."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern

    def __getstate__(self):
        return {"ranks": self.ranks, "pattern": self.pattern}

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        """Read a rank file (base64 entry, space, rank on each line) on the driver."""
        with open(path, "rb") as lines:
            return cls({base64.b64decode(entry): int(rank) for entry, rank in (x.split() for x in lines if x.strip())}, pattern)

    @cached_property
    def _split(self):
        return regex.compile(self.pattern).findall

    @cached_property
    def _whole(self) -> tuple[int, PerfectHash, list[bytes], np.ndarray]:
        entries = list(self.ranks)
        seed = 0
        while len(np.unique(hashes := self._hashes(entries, seed))) < len(entries):
            seed += 1
        table = PerfectHash(hashes)
        slots = table.slots(hashes)
        by_slot: list[bytes] = [b""] * len(entries)
        ids = np.zeros(len(entries), np.uint32)
        for entry, slot in zip(entries, slots.tolist()):
            by_slot[slot], ids[slot] = entry, self.ranks[entry]
        return seed, table, by_slot, ids

    @staticmethod
    def _hashes(entries: list[bytes], seed: int) -> np.ndarray:
        return np.fromiter((xxhash.xxh3_64_intdigest(e, seed) for e in entries), np.uint64, len(entries))

    @cached_property
    def _known(self) -> dict[str, bytes]:
        return {}

    @cached_property
    def _flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = max(self.ranks.values(), default=-1) + 1
        by_id = [b""] * size
        for entry, rank in self.ranks.items():
            by_id[rank] = entry
        length = np.fromiter(map(len, by_id), np.int64, size)
        return np.frombuffer(b"".join(by_id), np.uint8), np.cumsum(length) - length, length

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a byte string by merging neighbours: a heap of candidate pairs over a linked list of parts."""
        ranks, n = self.ranks, len(piece)
        if n == 1:
            return [ranks[piece]]
        after = list(range(1, n + 1))  # a part starts at i and ends at after[i]; 0: it was merged away
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, end = heappop(heap)
            j = after[i]
            if not j or j >= n or after[j] != end:
                continue
            after[i], after[j] = end, 0
            if end < n:
                before[end] = i
                if (r := ranks.get(piece[i : after[end]])) is not None:
                    heappush(heap, (r, i, after[end]))
            if (p := before[i]) >= 0 and (r := ranks.get(piece[p:end])) is not None:
                heappush(heap, (r, p, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : after[i]]])
            i = after[i]
        return out

    @cached_property
    def _pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of the single bytes, codes of all pairs of entries that make an entry (sorted), and its rank; None if a byte has no id."""
        ranks, size = self.ranks, self._size
        if any(bytes([b]) not in ranks for b in range(256)):
            return None
        code, made = [], []
        for entry, rank in ranks.items():
            for cut in range(1, len(entry)):
                if (a := ranks.get(entry[:cut])) is not None and (b := ranks.get(entry[cut:])) is not None:
                    code.append(a * size + b)
                    made.append(rank)
        order = np.argsort(np.array(code, np.int64))
        single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        # one pair more, which no code equals, so that a search always ends inside
        return single, np.append(np.array(code, np.int64)[order], size * size), np.append(np.array(made, np.int32)[order], _NO_RANK)

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the entry that each pair of ids makes; a place behind the end has id -1 and makes none."""
        _, codes, made = self._pairs
        code = np.where(right >= 0, left * self._size + right, -1)
        at = np.searchsorted(codes, code)
        return np.where(codes[at] == code, made[at], _NO_RANK)

    @cached_property
    def _size(self) -> int:
        return max(self.ranks.values(), default=-1) + 1

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """``merge`` of short byte strings as binaries of ids; each round makes the next merge of every one of them."""
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        width = int(length.max())
        flat = self._pairs[0][np.frombuffer(b"".join(pieces), np.uint8)]
        place = np.arange(width)
        ids = np.full((len(pieces), width + 1), -1, np.int64)
        ids[:, :width][place < length[:, None]] = flat
        rank = self._ranks_of(ids[:, :-1], ids[:, 1:])
        done, left = np.zeros((len(pieces), width), "<u4"), np.arange(len(pieces))
        while len(left):
            at = rank.argmin(1)
            rows = np.arange(len(left))
            lowest = rank[rows, at]
            go = lowest < _NO_RANK
            if not go.all():
                over = left[~go]
                done[over] = ids[~go, :-1].astype("<u4")
                length[over] = (ids[~go] >= 0).sum(1)
                left, at, lowest, ids, rank = left[go], at[go], lowest[go], ids[go], rank[go]
                if not len(left):
                    break
                rows = np.arange(len(left))
            # the part at `at` takes in the next one; everything behind moves up
            ids[rows, at] = lowest
            ids[:, 1:-1] = np.where(place[1:] > at[:, None], ids[:, 2:], ids[:, 1:-1])
            rank[:, :-1] = np.where(place[:-1] > at[:, None], rank[:, 1:], rank[:, :-1])
            rank[:, -1] = _NO_RANK
            rank[rows, at] = self._ranks_of(ids[rows, at], ids[rows, at + 1])
            before = np.flatnonzero(at > 0)
            rank[before, at[before] - 1] = self._ranks_of(ids[before, at[before] - 1], ids[before, at[before]])
        whole = done.tobytes()
        return [whole[s : s + 4 * n] for s, n in zip(range(0, 4 * width * len(pieces), 4 * width), length.tolist())]

    def _learn(self, tokens: set[str]) -> None:
        """Put the ids of pre-tokens into the table."""
        names = list(tokens)
        pieces = [t.encode("utf-8") for t in names]
        seed, table, by_slot, ids = self._whole
        slots = table.slots(self._hashes(pieces, seed))
        short = []
        for name, piece, slot in zip(names, pieces, slots.tolist()):
            if slot >= 0 and by_slot[slot] == piece:
                self._known[name] = ids[slot].tobytes()
            elif len(piece) > SHORT or self._pairs is None:
                self._known[name] = np.array(self.merge(piece), "<u4").tobytes()
            else:
                short.append((piece, name))
        short.sort(key=lambda x: len(x[0]))
        for k in range(0, len(short), BLOCK):
            block = short[k : k + BLOCK]
            self._known.update(zip((name for _, name in block), self.merge_many([piece for piece, _ in block])))

    def _pieces(self, text: str):
        """Cuts before a single space between two characters that are no spaces: each pre-token ends there."""
        start = 0
        while len(text) - start > PIECE:
            found = _BOUNDARY.search(text, start + PIECE)
            if not found:
                break
            yield text[start : found.start()]
            start = found.start()
        yield text[start:] if start else text

    def encode(self, text: str) -> bytes:
        """Ids of a text, little-endian, four bytes each."""
        out = []
        for part in self._pieces(text):
            tokens = self._split(part)
            try:
                out.append(b"".join(map(self._known.__getitem__, tokens)))
            except KeyError:
                if len(self._known) > KNOWN:
                    self._known.clear()
                self._learn({t for t in tokens if t not in self._known})
                out.append(b"".join(map(self._known.__getitem__, tokens)))
        return b"".join(out)

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """``encode`` of each text; short ones are worked on together, so that what is unknown in any of them is learned at once."""
        out, group, size = [], [], 0
        for text in texts:
            if len(text) > PIECE:
                out += [*self._encode_group(group), self.encode(text)]
                group, size = [], 0
                continue
            group.append(text)
            size += len(text)
            if size > PIECE:
                out += self._encode_group(group)
                group, size = [], 0
        return out + self._encode_group(group)

    def _encode_group(self, texts: list[str]) -> list[bytes]:
        tokens = [self._split(t) for t in texts]
        if len(self._known) > KNOWN:
            self._known.clear()
        self._learn(set().union(*tokens).difference(self._known))
        return [b"".join(map(self._known.__getitem__, t)) for t in tokens]

    def decode(self, ids: bytes) -> bytes:
        """Bytes of the entries with these ids, end to end."""
        flat, start, length = self._flat
        parts = []
        for at in range(0, len(ids), 4 * PIECE):
            part = np.frombuffer(ids[at : at + 4 * PIECE], "<u4")
            size = length[part]
            total = int(size.sum())
            offset = np.cumsum(size) - size
            parts.append(flat[np.arange(total) + np.repeat(start[part] - offset, size)].tobytes())
        return b"".join(parts)


_BOUNDARY = regex.compile(r"(?<=\S)(?= \S)")


class Codec:
    """Column functions over one vocabulary, which is broadcast (its size is that of the file, not of the data)."""

    def __init__(self, spark: SparkSession, vocabulary: Vocabulary):
        bounded_batches(spark)
        shared = spark.sparkContext.broadcast(vocabulary)

        @F.pandas_udf("binary")
        def encode(text: pd.Series) -> pd.Series:
            vocabulary = shared.value
            return pd.Series(vocabulary.encode_many([t or "" for t in text]), dtype=object)

        @F.pandas_udf("binary")
        def decode(ids: pd.Series) -> pd.Series:
            vocabulary = shared.value
            return pd.Series([vocabulary.decode(x or b"") for x in ids], dtype=object)

        self._encode, self._decode = encode, decode

    def encode(self, text: Column) -> Column:
        return self._encode(text)

    def decode(self, ids: Column) -> Column:
        return self._decode(ids)


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", identifier: str = "doc_id") -> DataFrame:
    """For each row: ``identifier``, ids (binary) and decoded (binary)."""
    codec = Codec(docs.sparkSession, vocabulary)
    ids = docs.select(F.col(identifier), codec.encode(F.col(text)).alias("ids"))
    return ids.select(identifier, "ids", codec.decode(F.col("ids")).alias("decoded"))
