"""Benchmark decontamination by the q-gram lemma.

Texts are compared as lower-case letters, digits and single spaces (UTF-8 bytes). Benchmark items are cut into
overlapping segments: WORDS words from each word on, so that a passage of that many words is found wherever it begins,
and SEGMENT bytes every STRIDE bytes, which allow more edits close together. Within a word of more than LONG bytes, as
in scripts without spaces, segments begin every LONG bytes; there a passage of SEGMENT + LONG bytes is found. A place in a document matches a segment of length L within e edits only if both share at least
L + 1 - Q - Q * e q-grams whose diagonals (place in the text minus place in the segment) lie within e of each other.

The filter works in three steps over a batch of texts. A bit table finds places whose q-gram is in the benchmark at all;
windows of text with fewer such places than any segment needs are done. In the windows that are left the q-grams are
gathered by item and diagonal band and counted by segment; bands are twice as wide as the budget and overlap by half, so
every alignment lies inside one. Bands that reach their bound are verified by an edit distance along the band, free at both ends of the text.

Alignments are made many at a time, each a row of a matrix, so that a stem that many items share costs no more for each.

The benchmark goes to the executors in blocks of about BLOCK_CHARS characters, one after another: the matches of a block are
written before the next one is built, so what the driver holds and what is broadcast stays bounded however large it is. Null and
empty texts match nothing. Items of fewer than MIN_CHARS bytes after normalisation allow no edits and are no evidence
that a text has seen the benchmark, as any text may hold a few words; where they stand in a text word by word is told in a column of its own, which
``clean`` does not look at. Repeated rows and other columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.common import bounded_batches, shared_folder

Q = 8
#: Segments have at most this many bytes and start this far apart.
SEGMENT, STRIDE = 120, 60
#: Words of a passage that is found from any word on (SEGMENT bytes of it if they are more); bytes of a long word.
WORDS, LONG = 13, 12
#: Edits allowed for each byte of a segment.
RATE = 0.08
MIN_CHARS = 24
BLOCK_CHARS = 4_000_000
#: Alignments that are made at once.
ROWS = 4096
#: Bytes of text that are looked at together.
CHUNK = 1 << 20
_BITS = 22
_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
SHORT = "array<struct<item_id:bigint,place:int>>"
MATCH = "array<struct<item_id:bigint,segment:int,place:int,edits:int>>"


def normalize(text: str) -> bytes:
    return b" ".join(text.lower().encode("utf-8").translate(_PLAIN).split())


def grams(data: np.ndarray) -> np.ndarray:
    """The Q bytes from each place as one number."""
    out = np.zeros(max(0, len(data) - Q + 1), np.uint64)
    for k in range(Q):
        out |= data[k : k + len(out)].astype(np.uint64) << np.uint64(8 * k)
    return out


def _cell(gram: np.ndarray) -> np.ndarray:
    return (gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BITS)


def _inside(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of consecutive groups of these sizes."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def budget(length: int) -> int:
    """Edits allowed in a segment; never so many that the lemma asks for less than one q-gram."""
    return max(0, min(int(RATE * length), (length - Q) // Q))


@dataclass
class Block:
    """Index of some benchmark segments. Segments that overlap in an item share a *source*, whose q-grams stand in it once."""

    items: list[int]
    starts: list[int]
    segments: list[bytes]

    def __post_init__(self):
        self.size = np.array([len(s) for s in self.segments], np.int64)
        self.edits = np.array([budget(n) for n in self.size.tolist()], np.int64)
        self.bound = self.size + 1 - Q - Q * self.edits
        sources, source, offset = [], [], []
        last = base = None
        for item, start, s in zip(self.items, self.starts, self.segments):
            held = sources[-1][start - base :][: len(s)] if sources and item == last and 0 <= start - base <= len(sources[-1]) else None
            if held is None or not s.startswith(held):
                sources.append(bytearray())
                last, base, held = item, start, b""
            sources[-1] += s[len(held) :]
            source.append(len(sources) - 1)
            offset.append(start - base)
        self.source, self.offset = np.array(source), np.array(offset, np.int64)
        self.longest = max(map(len, sources))
        # of each source: its first segment and their number, the least bound, the widest step of bands
        _, self.begin, self.parts = np.unique(self.source, return_index=True, return_counts=True)
        self.lowest = np.minimum.reduceat(self.bound, self.begin)
        self.step = 1 + np.maximum.reduceat(self.edits, self.begin)
        parts = [grams(np.frombuffer(s, np.uint8)) for s in sources]
        gram = np.concatenate(parts)
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        at = np.concatenate([np.arange(len(p)) for p in parts])
        order = np.argsort(gram, kind="stable")
        self.owner, self.at = owner[order], at[order]
        self.gram, self.first, self.count = np.unique(gram[order], return_index=True, return_counts=True)
        self.table = np.zeros(1 << _BITS, bool)
        self.table[_cell(self.gram)] = True
        self.least = int(self.bound.min())
        self.reach = int((self.size + self.edits).max()) - Q + 1
        self.overlap = 2 * int((self.size + 2 * self.edits).max()) + Q

    def _places(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places with q-grams of the benchmark in windows that have enough of them, and the numbers of those q-grams."""
        gram = grams(data)
        hit = np.flatnonzero(self.table[_cell(gram)])
        if len(hit) < self.least:
            return hit[:0], hit[:0]
        # a window holds enough if the place `least - 1` hits later is within reach
        dense = np.flatnonzero(hit[self.least - 1 :] - hit[: len(hit) - self.least + 1] < self.reach)
        near = np.zeros(len(hit) + 1, np.int64)
        np.add.at(near, dense, 1)
        np.add.at(near, dense + self.least, -1)
        hit = hit[np.cumsum(near)[:-1] > 0]
        number = np.minimum(np.searchsorted(self.gram, gram[hit]), len(self.gram) - 1)
        same = self.gram[number] == gram[hit]
        return hit[same], number[same]

    def candidates(self, data: np.ndarray) -> list[tuple[int, int, int]]:
        """(segment, lowest diagonal of a band, diagonals of the band) that the lemma leaves."""
        place, number = self._places(data)
        if not len(place):
            return []
        copies = self.count[number]
        entry = np.repeat(self.first[number], copies) + _inside(copies)
        source, at = self.owner[entry], self.at[entry]
        diagonal, step = np.repeat(place, copies) - at, self.step[source]
        # a number for each band: even ones begin at multiples of the width, odd ones half a width later
        found: list[tuple[int, int, int]] = []
        for half in (0, 1):
            band = (diagonal + self.longest - half * step) // (2 * step)
            key = source * (len(data) + 2 * self.longest) + band + 1
            order = np.argsort(key)
            first = np.flatnonzero(np.diff(key[order], prepend=-1))
            n = np.diff(first, append=len(order))
            enough = n >= self.lowest[source[order[first]]]
            first, n = first[enough], n[enough]
            one = order[first]
            # places in the source of the hits of each band, in order
            stride = self.longest + 1
            hits = np.sort(np.repeat(np.arange(len(n)), n) * stride + at[order[np.repeat(first, n) + _inside(n)]])
            parts = self.parts[source[one]]
            segment = np.repeat(self.begin[source[one]], parts) + _inside(parts)
            base = np.repeat(np.arange(len(n)), parts) * stride + self.offset[segment]
            inside = np.searchsorted(hits, base + self.size[segment] - Q, "right") - np.searchsorted(hits, base)
            low = np.repeat(band[one] * 2 * step[one] + half * step[one] - self.longest, parts) + self.offset[segment]
            good = inside >= self.bound[segment]
            found += zip(segment[good].tolist(), low[good].tolist(), np.repeat(2 * step[one], parts)[good].tolist())
        return found

    def distances(self, found: list[tuple[int, int, int]], data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each (segment, lowest diagonal, diagonals) the edits and the end of its best alignment around them.

        More edits than the segment allows mean none."""
        segment, low, span = (np.array(x, np.int64) for x in zip(*found))
        edits, ends = np.full(len(segment), 1 << 14, np.int64), np.full(len(segment), -1, np.int64)
        margin = int((self.size + 3 * self.edits).max() + 2 * span.max() + 2)
        padded = np.zeros(len(data) + 2 * margin, np.uint8)
        padded[margin : margin + len(data)] = data
        order = np.argsort(self.size[segment], kind="stable")
        for some in np.array_split(order, 1 + len(order) // ROWS):
            size, most = self.size[segment[some]], self.edits[segment[some]]
            wide = span[some] + 2 * most + 1
            patterns = np.zeros((len(some), int(size.max())), np.uint8)
            for k, s in enumerate(segment[some].tolist()):
                patterns[k, : size[k]] = np.frombuffer(self.segments[s], np.uint8)
            first = low[some] - most + margin
            steps = np.arange(int(wide.max()), dtype=np.int16)
            cost = np.where(steps < wide[:, None], 0, 1 << 12).astype(np.int16)
            alive = np.arange(len(some))
            for i in range(patterns.shape[1]):
                done = i >= size[alive]
                if done.any() or i % 8 == 7:
                    last = alive[done]
                    edits[some[last]] = cost[done].min(1)
                    ends[some[last]] = first[last] - margin + cost[done].argmin(1) + size[last]
                    go = ~done & (cost.min(1) <= most[alive])
                    alive, cost = alive[go], cost[go]
                    if not len(alive):
                        break
                row = padded[first[alive, None] + i + steps]
                new = cost + (row != patterns[alive, i, None])
                new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)
                cost = np.minimum.accumulate(new - steps, axis=1) + steps
            edits[some[alive]] = cost.min(1) if len(alive) else 0
            ends[some[alive]] = first[alive] - margin + cost.argmin(1) + size[alive] if len(alive) else 0
        return edits, ends

    def matches(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        """For each text (item, segment, place in the normalised text, edits) of all its matches."""
        out: list[dict] = [{} for _ in texts]
        chunk, size = [], 0

        def flush():
            data = np.frombuffer(b"".join(p + bytes(SEGMENT) for _, _, p in chunk), np.uint8)
            begin = np.cumsum([0] + [len(p) + SEGMENT for _, _, p in chunk])
            found = self.candidates(data)
            for (segment, _, _), edits, end in zip(found, *(x.tolist() for x in self.distances(found, data))) if found else ():
                if edits <= self.edits[segment]:
                    # its last byte is in the text or behind it; the first diagonal may be before the text
                    k = int(np.searchsorted(begin, end - 1, "right")) - 1
                    row, offset, _ = chunk[k]
                    place = max(int(begin[k]), end - len(self.segments[segment]))
                    key = (self.items[segment], self.starts[segment])
                    value = (edits, offset + place - int(begin[k]))
                    out[row][key] = min(out[row].get(key, value), value)

        for row, text in enumerate(texts):
            plain = normalize(text or "")
            for offset in range(0, max(1, len(plain)), CHUNK):
                piece = plain[offset : offset + CHUNK + self.overlap]
                chunk.append((row, offset, piece))
                size += len(piece) + SEGMENT
                if size >= CHUNK:
                    flush()
                    chunk, size = [], 0
        if chunk:
            flush()
        return [[(item, start, place, edits) for (item, start), (edits, place) in sorted(found.items(), key=lambda x: (x[0][0] is not None, x))] for found in out]


def segments(plain: bytes) -> list[tuple[int, bytes]]:
    """Overlapping segments of a normalised item, each with a start of its own; the last one of SEGMENT bytes ends with it.

    Where segments of both kinds begin at one place, that of WORDS words leaves out its first byte.
    """
    if len(plain) <= SEGMENT:
        found = {0: plain}
    else:
        starts = [*range(0, len(plain) - SEGMENT, STRIDE), len(plain) - SEGMENT]
        found = {s: plain[s : s + SEGMENT] for s in starts}
    ends = [k for k, byte in enumerate(plain) if byte == 32] + [len(plain)]
    begin = 0
    for word, end in enumerate(ends):
        last = ends[word + WORDS - 1] if word + WORDS <= len(ends) else len(plain) + 1
        for start in range(begin, end if end - begin > LONG else begin + 1, LONG):
            stop = min(last, start + SEGMENT)
            if stop <= len(plain):
                start += start in found
                found.setdefault(start, plain[start:stop])
        begin = end + 1
    return sorted(found.items())


class ShortItems:
    """Items of fewer than MIN_CHARS bytes, by their words."""

    def __init__(self, items: list[tuple[int | None, bytes]]) -> None:
        self.items: dict[tuple[bytes, ...], list] = {}
        self.sizes: dict[bytes, set[int]] = {}
        for item, plain in items:
            words = tuple(plain.split(b" "))
            self.items.setdefault(words, []).append(item)
            self.sizes.setdefault(words[0], set()).add(len(words))

    def matches(self, text: str | None) -> list[dict]:
        words, out, place = normalize(text or "").split(b" "), [], 0
        for k, word in enumerate(words):
            for n in self.sizes.get(word, ()):
                out += [{"item_id": item, "place": place} for item in self.items.get(tuple(words[k : k + n]), ())]
            place += len(word) + 1
        return out


def _rows(benchmark: DataFrame, text: str, identifier: str) -> DataFrame:
    return benchmark.select(F.col(identifier).cast("long").alias("item"), F.col(text).alias("text")).where("text is not null").distinct()


def short_items(benchmark: DataFrame, text: str = "text", identifier: str = "item_id"):
    """The short items, part by part; a text that normalisation makes shorter may be long, so all are looked at."""
    rows = _rows(benchmark, text, identifier).mapInPandas(_short, "item long, plain binary")
    n = 1 + (rows.agg(F.sum(F.length("plain") + 32)).first()[0] or 0) // BLOCK_CHARS
    for k in range(n):
        part = [(r["item"], bytes(r["plain"])) for r in rows.where(F.pmod(F.xxhash64("item", "plain"), F.lit(n)) == k).toLocalIterator()]
        if part:
            yield ShortItems(part)


def _short(batches):
    for pdf in batches:
        plain = pdf["text"].map(normalize)
        few = plain.map(lambda p: 0 < len(p) < MIN_CHARS)
        yield pd.DataFrame({"item": pdf["item"], "plain": plain})[few.to_numpy(bool)]


def blocks(benchmark: DataFrame, text: str = "text", identifier: str = "item_id"):
    """Indexes of the benchmark, block by block."""
    rows = _rows(benchmark, text, identifier)
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = 1 + total // BLOCK_CHARS
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        plain = [(r["item"], p) for r in part.toLocalIterator() if len(p := normalize(r["text"])) >= MIN_CHARS]
        found = [(item, *s) for item, p in sorted(plain, key=lambda x: (x[0] is not None, x)) for s in segments(p)]
        if found:
            items, starts, parts = zip(*found)
            yield Block(list(items), list(starts), list(parts))


def _finder(spark, block: Block):
    """A column function, text to its matches, and what it has broadcast."""
    shared = spark.sparkContext.broadcast(block)

    @F.pandas_udf(MATCH)
    def find(text: pd.Series) -> pd.Series:
        names = ("item_id", "segment", "place", "edits")
        return pd.Series([[dict(zip(names, m)) for m in row] for row in shared.value.matches(list(text))], dtype=object)

    return find, shared


def _short_finder(spark, items: ShortItems):
    shared = spark.sparkContext.broadcast(items)

    @F.pandas_udf(SHORT)
    def find(text: pd.Series) -> pd.Series:
        return pd.Series([shared.value.matches(t) for t in text], dtype=object)

    return find, shared


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus array columns ``benchmark_matches`` (item_id, segment start, place, edits) and
    ``benchmark_short_matches`` (item_id, place) of items too short to be evidence."""
    bounded_batches(docs.sparkSession)
    long = _found(docs, "benchmark_matches", MATCH, blocks(benchmark), _finder, text)
    return _found(long, "benchmark_short_matches", SHORT, short_items(benchmark), _short_finder, text)


def _found(docs: DataFrame, name: str, kind: str, parts, finder, text: str) -> DataFrame:
    """``docs`` plus the matches in all parts of the benchmark, one part after another."""
    spark, parts = docs.sparkSession, iter(parts)
    first, second = next(parts, None), next(parts, None)
    if second is None:
        return docs.withColumn(name, finder(spark, first)[0](F.col(text)) if first else F.array().cast(kind))
    folder = shared_folder(spark, "benchmark")
    docs.drop(name).withColumn("__row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(f"{folder}/docs")
    rows = spark.read.parquet(f"{folder}/docs")
    parts, first, second = chain((first, second), parts), None, None
    for number, part in enumerate(parts):
        find, shared = finder(spark, part)
        hits = rows.select("__row", find(F.col(text)).alias("__found")).where(F.size("__found") > 0)
        hits.write.parquet(f"{folder}/matches/part={number}")
        shared.destroy()
        del part, find
    hits = spark.read.parquet(f"{folder}/matches").groupBy("__row").agg(F.array_sort(F.flatten(F.collect_list("__found"))).alias("__found"))
    both = rows.join(hits, "__row", "left")
    return both.select(*[F.col(f"`{c}`") for c in rows.columns if c != "__row"], F.coalesce("__found", F.array().cast(kind)).alias(name))


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` without a match of an item that is long enough."""
    bounded_batches(docs.sparkSession)
    found = _found(docs, "__benchmark_matches", MATCH, blocks(benchmark), _finder, text)
    return found.where(F.size("__benchmark_matches") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
