"""Alignment of the tokens of two tokenizers, and how often each pair of tokens meets in the whole corpus.

Tokenizer A is a byte-level BPE file of the ``tokenizers`` library, which reads a space and the text; B is a sentencepiece
model with byte fallback, which puts that space itself. What they report is taken as coarse cuts: character offsets of A,
byte spans of B (``offset_mapping``, which in the installed release stands in for the immutable proto: the same spans). Where a token
holds only some bytes of a character, or is one fallback byte, its span covers the character or nothing at all; the
cuts are then refined by the lengths of the tokens' decoded bytes, from the last cut that is certain. In ASCII
text characters are bytes, and the lengths alone are the cuts. Places where A and B both end divide the tokens into groups.
Two tokens are linked where their bytes overlap; there is one link for each stretch between neighbouring cuts of either.

Neither tokenizer joins anything across a single space between two other characters: A starts a word there, and no piece
of B has a space behind another character. So both end before each such space, groups and links never reach over it,
and a word with its space always gives the same tokens, groups and links. Tasks remember those of short words; new
ones are encoded many at a time, as one text. Long stretches without such a space are encoded as they are.

Links are summed up by pair of ids within a text, within a task and then over the corpus. The HEAD most frequent pairs (17 bytes
each) go to all tasks with their counts; texts' other pairs meet the table of counts in a join by pair, none of them frequent.

Null and empty texts, and texts whose joined bytes of A or B differ from a space and the text, have no tokens: all figures are 0
and the digest is the empty string. Repeated rows count as often as they occur. Null identifiers are kept. Other
columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.common import bounded_batches, most_frequent, release, shared_folder
from pitpanel.session import stable

#: Pairs that all tasks have with their counts.
HEAD = 1 << 19
#: Pairs that a task holds before it reports their counts.
HELD = 2_000_000
#: Words that a task remembers, twice as many at most; characters of such a word at most, characters of words that are encoded at once.
REMEMBERED, SHORT, TOGETHER = 250_000, 64, 1 << 18
_CUT = re.compile(r"(?<=\S) (?=[\w!-/:-@\[-`{-~])")
_SHIFT = 32


def byte_letters() -> dict[str, int]:
    """The letters that byte-level tokenizers write for bytes: visible Latin-1 letters are themselves, the rest follow from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers with the bytes of each id."""

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        # a task is one thread; the library would start one for each core for a batch of one text
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        entries = {i: bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode() for entry, i in self.a.get_vocab().items()}
        self.a_bytes = [entries.get(i, b"") for i in range(max(entries) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        # a piece with a space behind another character could join what a cut has parted
        self.divisible = not any(re.search("[^▁]▁", p) for p in pieces)
        a, b = range(len(self.a_bytes)), range(len(self.b_bytes))
        self.written = [f";{i}" for i in a] + [f",{i}" for i in a] + [f"|{i}" for i in b] + [f",{i}" for i in b]
        # what was needed lately, and what before that
        self.known: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}
        # whether a text is cut before a word that begins so
        self.begins: dict[str, bool] = {}

    def coded(self, text: str):
        """Ids and byte ends of A and of B over a space and the text; None if either does not give those bytes."""
        source = b" " + text.encode()
        if text.isascii():
            # the lengths of the tokens are their places: none of them asked for
            a = np.array(self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, np.int64)
            b = np.asarray(self.b.encode(text, return_type="numpy", num_threads=1), np.int64)
            a_end, b_end = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        else:
            found = self.a.encode(" " + text, add_special_tokens=False)
            a = np.array(found.ids, np.int64)
            letters = np.frombuffer((" " + text).encode("utf-32-le"), np.uint32)
            at = np.concatenate([[0], np.cumsum(1 + (letters > 0x7F) + (letters > 0x7FF) + (letters > 0xFFFF))])
            a_end = refined(at[np.array(found.offsets, np.int64).reshape(-1, 2)], self.a_sizes[a])
            spans = self.b.encode(text, return_type="offset_mapping", return_bytes=True, num_threads=1)
            b = np.array(spans["ids"], np.int64)
            coarse = np.array(spans["offsets"], np.int64).reshape(-1, 2) + 1
            coarse[:1, 0] = 0
            b_end = refined(coarse, self.b_sizes[b])
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != source or b"".join(map(self.b_bytes.__getitem__, b.tolist())) != source:
            return None
        return a, a_end, b, b_end

    def words(self, text: str) -> list[str]:
        """The text cut at its separating spaces, which go."""
        return _CUT.split(text) if self.divisible else [text]

    def remember(self, texts: list[list[str]]) -> None:
        """Make sure that the short words of these texts are known."""
        needed = set().union(*texts)
        if len(self.known) + len(needed) > REMEMBERED:
            self.known, self.older = {w: self.known[w] for w in needed if w in self.known}, self.known
        new = {w for w in needed.difference(self.known) if len(w) <= SHORT}
        again = new.intersection(self.older)
        self.known.update((w, self.older[w]) for w in again)
        new -= again
        for plain in (True, False):
            some, size = [], 0
            for w in new:
                if w.isascii() != plain:
                    continue
                if not self._joined(w):
                    self.known[w] = self.entries([w])[0]
                    continue
                some.append(w)
                size += len(w)
                if size >= TOGETHER:
                    self.known.update(zip(some, self.entries(some)))
                    some, size = [], 0
            if some:
                self.known.update(zip(some, self.entries(some)))

    def _joined(self, word: str) -> bool:
        """Whether a word can stand among others in one text and be cut out again."""
        first = word[:1]
        if first not in self.begins:
            self.begins[first] = bool(_CUT.search(f"x {first}"))
        return self.begins[first] and not word[-1].isspace() and "▁" not in word

    def entries(self, words: list[str]) -> list[tuple | None]:
        """For each word n_a, n_b, n_groups, its groups written with a semicolon before each, packed pair codes of its links."""
        source = " ".join(words)
        coded = self.coded(source)
        if coded is None:
            return [None] if len(words) == 1 else [self.entries([w])[0] for w in words]
        a, a_ends, b, b_ends = coded
        # two sorted runs: merged, not sorted anew
        merged = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")
        first = _first(merged)
        stretches, cuts = merged[first], merged[~first]
        links = a[np.searchsorted(a_ends, stretches)] << _SHIFT | b[np.searchsorted(b_ends, stretches)]
        a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        n, m = len(self.a_bytes), len(self.b_bytes)
        codes = np.concatenate([a + n * ~_first(a_group), 2 * n + b + m * ~_first(b_group)])
        codes = codes[np.argsort(np.concatenate([a_group, b_group]), kind="stable")]
        ends = np.cumsum([1 + n for n in (map(len, words) if source.isascii() else [len(w.encode()) for w in words])])
        # all of them end where a word ends
        upto = [np.searchsorted(x, ends, "right") for x in (a_ends, b_ends, cuts, stretches)]
        n_a, n_b, n_groups, n_links = (np.diff(x, prepend=0).tolist() for x in upto)
        text = list(map(self.written.__getitem__, codes.tolist()))
        out, at, link, links = [], 0, 0, links.tobytes()
        for x, y, g, k in zip(n_a, n_b, n_groups, n_links):
            to, behind = at + x + y, link + 8 * k
            out.append((x, y, g, "".join(text[at:to]), links[link:behind]))
            at, link = to, behind
        return out

    def aligned(self, words: list[str]):
        """n_a, n_b, n_groups, groups as ``a1,a2|b1;a3|b2,b3``, pair codes of all links; None if the bytes are others."""
        found = list(map(self.known.get, words))
        if None in found:
            found = [self.entries([w])[0] if x is None and len(w) > SHORT else x for w, x in zip(words, found)]
            if None in found:
                return None
        n_a, n_b, n_groups, groups, links = zip(*found)
        return sum(n_a), sum(n_b), sum(n_groups), "".join(groups)[1:], np.frombuffer(b"".join(links), np.int64)


def refined(coarse: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Byte ends of tokens from their coarse (begin, end): certain where that is as long as the token, by its bytes elsewhere."""
    summed = np.cumsum(sizes)
    certain = (coarse[:, 1] - coarse[:, 0] == sizes) & (sizes > 0)
    last = np.maximum.accumulate(np.where(certain, np.arange(len(sizes)), -1))
    return summed + np.where(last >= 0, coarse[last, 1] - summed[last], 0) if len(sizes) else summed


@lru_cache(2)
def loaded(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


def _first(group: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], group[1:] != group[:-1]])


_ALIGNED = "id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def _align(a_path: str, b_path: str, with_groups: bool):
    def align(batches):
        tokenizers = loaded(a_path, b_path)
        for pdf in batches:
            out, texts = [], [tokenizers.words(t) if t else [] for t in pdf["text"]]
            tokenizers.remember(texts)
            for identifier, words in zip(pdf["id"], texts):
                found = tokenizers.aligned(words) if words else None
                if found is None:
                    out.append((identifier, 0, 0, 0, 0, "", b"", b"", ""))
                    continue
                n_a, n_b, n_groups, groups, links = found
                pairs, times = np.unique(links, return_counts=True)
                out.append((identifier, n_a, n_b, n_groups, len(links), hashlib.sha256(groups.encode()).hexdigest(),
                            np.diff(pairs, prepend=0).tobytes(), times.astype(np.uint32).tobytes(), groups if with_groups else ""))
            names = [x.split()[0] for x in _ALIGNED.split(", ")]
            pdf = pd.DataFrame(out, columns=[*names, "groups"])
            yield pdf if with_groups else pdf[names]

    return align


def _pairs(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(packed, np.int64))


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", identifier: str = "doc_id", with_groups: bool = False) -> DataFrame:
    """One row for each text: id (as text), n_a, n_b, n_groups, n_links, groups_sha256, pairs (sorted codes ``a << 32 | b`` as
    differences) with times (how many links of the text each has); ``groups`` in full on demand."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(identifier).cast("string").alias("id"), F.col(text).alias("text"))
    return rows.mapInPandas(_align(a_path, b_path, with_groups), _ALIGNED + (", groups string" if with_groups else ""))


def _summed(batches):
    held, size = [], 0

    def report():
        pairs = np.concatenate([p for p, _ in held])
        code, at = np.unique(pairs, return_inverse=True)
        return code, np.bincount(at, np.concatenate([t for _, t in held])).astype(np.int64)

    for pdf in batches:
        for packed, times in zip(pdf["pairs"], pdf["times"]):
            held.append((_pairs(packed), np.frombuffer(times, np.uint32)))
            size += len(held[-1][0])
            if size > HELD:
                held = [report()]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield pd.DataFrame(dict(zip(("pair", "n"), held[0])))
                    held, size = [], 0
    if held:
        yield pd.DataFrame(dict(zip(("pair", "n"), report())))


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, n, best): links of each pair in the corpus, and whether no other pair with that id of B has more."""
    counts = stable(found.select("pairs", "times").mapInPandas(_summed, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))
    of_b = F.col("pair").bitwiseAND((1 << _SHIFT) - 1)
    # at most one row for each id of B, whatever the corpus: 16 bytes for each piece of the vocabulary
    most = counts.groupBy(of_b.alias("b")).agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), of_b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _looked_up(head):
    def look_up(batches):
        code, n, best = head.value
        for pdf in batches:
            sums, bests, rest, rest_times = [], [], [], []
            for packed, times in zip(pdf["pairs"], pdf["times"]):
                pairs, times = _pairs(packed), np.frombuffer(times, np.uint32).astype(np.int64)
                at = np.minimum(np.searchsorted(code, pairs), max(len(code) - 1, 0))
                known = code[at] == pairs if len(code) else np.zeros(len(pairs), bool)
                sums.append(int((n[at[known]] * times[known]).sum()))
                bests.append(int(times[known][best[at[known]]].sum()))
                rest.append(pairs[~known])
                rest_times.append(times[~known])
            yield pdf.drop(columns=["pairs", "times"]).assign(n_best=bests, count_sum=sums, rest=rest, rest_times=rest_times)

    return look_up


def score(docs: DataFrame, a_path: str, b_path: str, text: str = "text", identifier: str = "doc_id") -> DataFrame:
    """One row for each text: identifier, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    path = shared_folder(spark, "alignment")
    named = align(docs, a_path, b_path, text, identifier).withColumn("row", F.monotonically_increasing_id())
    named.write.option("compression", "zstd").parquet(path)
    found = spark.read.parquet(path)
    counts = stable(pair_counts(found))
    release(spark)
    head = most_frequent(counts, "n", HEAD).toPandas().sort_values("pair")
    least = int(head["n"].min()) if len(head) else None
    shared = spark.sparkContext.broadcast((head["pair"].to_numpy(np.int64), head["n"].to_numpy(np.int64), head["best"].to_numpy(bool)))
    figures = "id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, row long, n_best long, count_sum long"
    looked = stable(found.mapInPandas(_looked_up(shared), figures + ", rest array<long>, rest_times array<long>"))
    rest = looked.where(F.size("rest") > 0).select("row", F.explode(F.arrays_zip("rest", "rest_times")).alias("x"))
    rest = rest.select("row", F.col("x.rest").alias("pair"), F.col("x.rest_times").alias("times"))
    rare = counts if least is None else counts.where(F.col("n") < least)
    more = rest.join(rare, "pair").groupBy("row").agg(
        F.sum(F.col("n") * F.col("times")).alias("more_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"))
    both = looked.drop("rest", "rest_times").join(more, "row", "left")
    return both.select(
        F.col("id").cast(docs.schema[identifier].dataType).alias(identifier), "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256")
