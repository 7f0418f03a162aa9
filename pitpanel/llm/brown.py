"""Language-model scoring with a class-based bigram model: P(text) = product of P(class | class before) * P(word | class).

Word counts cover the whole training corpus and stay a distributed table. The vocabulary, all words that occur LEAST times,
is put into CLASSES classes by exchange: a word moves to the class with the best bigram likelihood. It grows with the corpus;
since the words go to all tasks, HEAD of them is the most (the most frequent, all of a count or none).

Bigrams of all training texts are a table as well, with one row for each word of the vocabulary and its neighbours on either
side, at most as many as there are words. The exchange begins with the SEED most frequent words, whose moves depend on each other most: these
are moved one by one until none moves. Then all words move in rounds. In a round the words of every other rank look for
their best class in tasks, given the classes of the round before; the moves count if the likelihood of the whole corpus, taken anew, is
higher. Rounds end when a pair of them gains less than a share GAIN of all that was gained.

Words outside the vocabulary form the tail class, text ends a class of their own. Class transitions are interpolated with class
frequencies; in the tail class every count is raised by one and one more is kept for unknown words.

Scores of vocabulary words are summed in the task that reads a text. Tail words are joined with the counts by word; no single
one of them is frequent, so that join has no hot key. Sums go back to the row by a row number.

Null text counts as empty: it has its end token only. Without training rows all counts are 0. Repeated rows are scored
one by one (and counted one by one in training); other columns are not looked at. Texts of any length are read word by word.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import cached_property
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.common import Steps, bounded_batches, crc_of, most_frequent
from pitpanel.session import stable

#: Words that are broadcast at most, words that the exchange begins with, and classes.
HEAD, CLUSTERED, CLASSES = 1 << 18, 500, 50
#: Times that a word occurs at least to be in the vocabulary.
LEAST = 20
#: Share of all gains so far that a pair of rounds has to add for another one.
GAIN = 0.05
#: Bigrams that a task holds before it reports their counts.
HELD = 3_000_000
#: Weight of the class bigrams against class frequencies.
BIGRAM = 0.9
#: Words whose moves are looked for at once.
BLOCK = 256


def words(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case, separated by ASCII white space only."""
    return (text or "").encode("utf-8").lower().split()  # both know ASCII only on bytes


def _count(batches):
    """(word, n) of one task; the table is emptied when it grows large."""
    seen: Counter = Counter()

    def flush():
        rows = pd.DataFrame({"word": [w.decode("utf-8") for w in seen], "n": list(seen.values())})
        seen.clear()
        return rows

    for pdf in batches:
        for text in pdf["text"]:
            seen.update(words(text))
        if len(seen) > 1_000_000:
            yield flush()
    if seen:
        yield flush()


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def likelihood(joint: np.ndarray) -> float:
    """What the exchange raises: sum n(g,h) log n(g,h) - sum n(g,.) log n(g,.) - sum n(.,g) log n(.,g)."""
    return float(_xlogx(joint).sum() - _xlogx(joint.sum(0)).sum() - _xlogx(joint.sum(1)).sum())


def _take(joint: np.ndarray, c: int, out: np.ndarray, inn: np.ndarray, own: float, sign: int) -> None:
    """Give a word's bigrams to class c, or take them away; ``out`` and ``inn`` are those with other words by class."""
    joint[c] += sign * out
    joint[:, c] += sign * inn
    joint[c, c] += sign * own


def _best(joint: np.ndarray, out: np.ndarray, inn: np.ndarray, own: float, classes: int, old: int) -> int:
    """The class with the best likelihood for a word whose bigrams ``joint`` is without; equal ones: the old or the lowest."""
    # totals of each class with the bigrams between it and the word, wherever that goes
    rows, cols = joint.sum(1) + inn, joint.sum(0) + out
    total_out, total_in = out.sum() + own, inn.sum() + own
    c = np.arange(classes)
    # class c takes the word: row c gains `out`, column c gains `inn`, the cell (c, c) both and the word's own;
    # only cells where the word has bigrams change
    h, g = np.flatnonzero(out), np.flatnonzero(inn)
    row = (_xlogx(joint[:classes, h] + out[h]) - _xlogx(joint[:classes, h])).sum(1)
    col = (_xlogx(joint[g, :classes] + inn[g, None]) - _xlogx(joint[g, :classes])).sum(0)
    cell = joint[c, c]
    both = _xlogx(cell + out[:classes] + inn[:classes] + own) - _xlogx(cell)
    row -= _xlogx(cell + out[:classes]) - _xlogx(cell)
    col -= _xlogx(cell + inn[:classes]) - _xlogx(cell)
    gain = row + col + both
    gain -= _xlogx(rows[:classes] + total_out) - _xlogx(rows[:classes]) + _xlogx(cols[:classes] + total_in) - _xlogx(cols[:classes])
    return int(np.argmax(gain > gain.max() - 1e-9)) if gain[old] < gain.max() - 1e-9 else old


def _best_many(joint: np.ndarray, out: np.ndarray, inn: np.ndarray, own: np.ndarray, classes: int, old: np.ndarray) -> np.ndarray:
    """``_best`` for each of many words (rows of ``out`` and ``inn``), each seen alone; ``joint`` has the bigrams of all of them."""
    n = np.arange(len(old))
    total_out, total_in = out.sum(1) + own, inn.sum(1) + own
    rows, cols = np.tile(joint.sum(1), (len(old), 1)), np.tile(joint.sum(0), (len(old), 1))
    rows[n, old] -= total_out
    cols[n, old] -= total_in
    rows, cols = rows[:, :classes], cols[:, :classes]

    def side(cells: np.ndarray, gained: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Sum over the cells that a word has bigrams in, by the class that takes it."""
        w, h = np.nonzero(gained)
        times = gained[w, h]
        part = cells[h, :classes]
        part[np.arange(len(w)), old[w]] -= times
        same = np.flatnonzero(h == old[w])
        part[same] -= other[w[same], :classes]
        part[same, old[w[same]]] -= own[w[same]]
        part = _xlogx(part + times[:, None]) - _xlogx(part)
        total = np.zeros((len(old), classes))
        if len(w):
            first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            total[w[first]] = np.add.reduceat(part, first, axis=0)
        return total

    gain = side(joint.T, out, inn) + side(joint, inn, out)
    cell = np.tile(joint.diagonal()[:classes], (len(old), 1))
    cell[n, old] -= out[n, old] + inn[n, old] + own
    plain = _xlogx(cell)
    gain -= _xlogx(cell + out[:, :classes]) - plain
    gain -= _xlogx(cell + inn[:, :classes]) - plain
    gain += _xlogx(cell + out[:, :classes] + inn[:, :classes] + own[:, None]) - plain
    gain -= _xlogx(rows + total_out[:, None]) - _xlogx(rows) + _xlogx(cols + total_in[:, None]) - _xlogx(cols)
    most = gain.max(1)
    return np.where(gain[n, old] < most - 1e-9, np.argmax(gain > most[:, None] - 1e-9, axis=1), old)


def exchange(bigrams: np.ndarray, free: int, classes: int) -> np.ndarray:
    """Class of each symbol. The first ``free`` symbols are clustered, each further one keeps a class of its own.

    Maximises sum n(g,h) log n(g,h) - sum n(g,.) log n(g,.) - sum n(.,g) log n(.,g) over class bigrams by moving one
    symbol at a time to its best class; equal gains go to the lowest class number.
    """
    size = len(bigrams)
    classes = min(classes, max(1, free))
    label = np.concatenate([np.arange(free) % classes, classes + np.arange(size - free)]).astype(np.int64)
    n_labels = classes + size - free
    into = lambda v: np.bincount(label, weights=v, minlength=n_labels)
    hot = np.zeros((size, n_labels))
    hot[np.arange(size), label] = 1
    joint = hot.T @ bigrams @ hot
    while True:
        moved = 0
        for w in range(free):
            old = label[w]
            out, inn, own = into(bigrams[w]), into(bigrams[:, w]), bigrams[w, w]
            out[old] -= own
            inn[old] -= own
            _take(joint, old, out, inn, own, -1)
            new = _best(joint, out, inn, own, classes, int(old))
            _take(joint, new, out, inn, own, 1)
            moved += new != old
            label[w] = new
        if not moved:
            break
    return label


@dataclass
class Symbols:
    """Symbols: the words of the vocabulary, the tail, the end of a text."""

    head: list[bytes]
    counts: np.ndarray

    @cached_property
    def symbol(self) -> np.ndarray:
        """Symbol of each word of the vocabulary; one more entry, read at -1, for all others."""
        return np.arange(len(self.head) + 1)

    @property
    def tail(self) -> int:
        return len(self.head)

    @property
    def end(self) -> int:
        return self.tail + 1

    @cached_property
    def number(self) -> dict[bytes, int]:
        return {w: k for k, w in enumerate(self.head)}

    def numbers(self, text: str | None) -> tuple[list[bytes], np.ndarray]:
        """Words of a text and their numbers in the vocabulary, -1 outside."""
        found = words(text)
        return found, np.fromiter(map(self.number.get, found, repeat(-1)), np.int64, len(found))

    def __getstate__(self):
        return {"head": self.head, "counts": self.counts}


def _bigrams(shared):
    """(first, second, n) of the symbols of one task; each text begins and ends with the end of a text."""
    def count(batches):
        symbols = shared.value
        size = symbols.end + 1
        held, kept, n = [], None, 0

        def summed():
            code, times = np.unique(np.concatenate(held), return_counts=True)
            if kept is None:
                return code, times.astype(np.int64)
            code, at = np.unique(np.concatenate([kept[0], code]), return_inverse=True)
            return code, np.bincount(at, np.concatenate([kept[1], times])).astype(np.int64)

        def rows(code, times):
            return pd.DataFrame({"first": (code // size).astype(np.int32), "second": (code % size).astype(np.int32), "n": times})

        for pdf in batches:
            for text in pdf["text"]:
                line = np.concatenate([[symbols.end], symbols.symbol[symbols.numbers(text)[1]], [symbols.end]])
                held.append(line[:-1] * size + line[1:])
                n += len(line)
                if n > HELD:
                    kept, held = summed(), []
                    n = len(kept[0])
                    if n > HELD // 2:
                        yield rows(*kept)
                        kept, n = None, 0
        if held:
            yield rows(*summed())
        elif kept is not None:
            yield rows(*kept)

    return count


def _neighbours(steps: Steps, pairs: DataFrame) -> DataFrame:
    """One row for each symbol: its followers with counts, and what comes before it."""
    def side(own: str, other: str, name: str) -> DataFrame:
        listed = pairs.groupBy(F.col(own).alias("symbol")).agg(F.collect_list(F.struct(F.col(other).alias("s"), "n")).alias("x"))
        return listed.select("symbol", F.col("x.s").alias(name), F.col("x.n").alias(f"n_{name}"))

    # two tables first: each is grouped on its own, and the shuffle files of one go before those of the other come
    after, before = steps.keep(side("first", "second", "after"), "after"), steps.keep(side("second", "first", "before"), "before")
    both = steps.keep(after.join(before, "symbol", "full"), "neighbours")
    steps.drop(after, before)
    return both


def _by_word(others: pd.Series, times: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists of symbols and counts, one behind the other, with the place of the word that each belongs to."""
    owner = np.repeat(np.arange(len(others)), [len(x) for x in others])
    if not len(owner):
        return owner, owner, np.zeros(0)
    return owner, np.concatenate(others.to_list()).astype(np.int64), np.concatenate(times.to_list()).astype(np.float64)


def _joint(shared):
    """Cells of the class bigrams of one task's words."""
    def add(batches):
        label, size, _, _ = shared.value
        joint = np.zeros(size * size)
        for pdf in batches:
            some = pdf[pdf["after"].notna()]
            for k in range(0, len(some), BLOCK):
                part = some[k : k + BLOCK]
                owner, after, n = _by_word(part["after"], part["n_after"])
                joint += np.bincount(label[part["symbol"].to_numpy()[owner]] * size + label[after], n, size * size)
        cell = np.flatnonzero(joint)
        yield pd.DataFrame({"cell": cell, "n": joint[cell].astype(np.int64)})

    return add


def _moves(shared):
    """(symbol, class) of the words of one half that another class suits better, each seen alone."""
    def move(batches):
        label, size, joint, (half, free, classes) = shared.value

        def by_class(words: np.ndarray, others: pd.Series, times: pd.Series) -> tuple[np.ndarray, np.ndarray]:
            """Bigrams of each word with the words of each class, and with itself."""
            owner, other, n = _by_word(others, times)
            own = np.bincount(owner, n * (other == words[owner]), len(words))
            total = np.bincount(owner * size + label[other], n, len(words) * size).reshape(-1, size)
            total[np.arange(len(words)), label[words]] -= own
            return total, own

        for pdf in batches:
            able = (pdf["symbol"] < free) & (pdf["symbol"] % 2 == half) & pdf["after"].notna() & pdf["before"].notna()
            some = pdf[able]
            for k in range(0, len(some), BLOCK):
                part = some[k : k + BLOCK]
                words = part["symbol"].to_numpy(np.int64)
                out, own = by_class(words, part["after"], part["n_after"])
                inn, _ = by_class(words, part["before"], part["n_before"])
                old = label[words]
                new = _best_many(joint, out, inn, own, classes, old)
                yield pd.DataFrame({"symbol": words[new != old], "label": new[new != old]})

    return move


def cluster(steps: Steps, pairs: DataFrame, symbols: Symbols) -> tuple[np.ndarray, np.ndarray]:
    """Class of each symbol, tail and end last, and the class bigrams."""
    spark, free = steps.spark, len(symbols.head)
    seed = min(CLUSTERED, free)
    # the seed words among themselves, all other words as one, text ends
    place = lambda c: F.when(F.col(c) < seed, F.col(c)).when(F.col(c) < symbols.end, seed).otherwise(seed + 1).cast("int")
    cells = pairs.groupBy(place("first").alias("first"), place("second").alias("second")).agg(F.sum("n").alias("n")).toPandas()
    small = np.zeros((seed + 2, seed + 2))
    small[cells["first"].to_numpy(np.int64), cells["second"].to_numpy(np.int64)] = cells["n"].to_numpy(np.float64)
    classes = min(CLASSES, max(1, free))
    seeded = exchange(small, seed, classes)[:seed]
    label = np.concatenate([seeded, np.arange(free - seed) % classes, [classes, classes + 1]]).astype(np.int64)
    size = classes + 2
    table = _neighbours(steps, pairs)

    def joint_of(label: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast((label, size, None, None))
        found = table.select("symbol", "after", "n_after").mapInPandas(_joint(shared), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        shared.unpersist()
        joint = np.zeros(size * size)
        joint[found["cell"].to_numpy(np.int64)] = found["n"].to_numpy(np.float64)
        return joint.reshape(size, size)

    joint = joint_of(label)
    first = last = likelihood(joint)
    while True:
        before = last
        for half in (0, 1):
            shared = spark.sparkContext.broadcast((label, size, joint, (half, free, classes)))
            moves = table.mapInPandas(_moves(shared), "symbol long, label long").toPandas()  # words of the vocabulary: bounded
            shared.unpersist()
            other = label.copy()
            other[moves["symbol"].to_numpy(np.int64)] = moves["label"].to_numpy(np.int64)
            changed = joint_of(other) if len(moves) else joint
            if likelihood(changed) > last:
                label, joint, last = other, changed, likelihood(changed)
        if last - before <= GAIN * (last - first):
            break
    steps.drop(table)
    return label, joint


@dataclass
class Model:
    """Log10 probabilities; ``transition`` by class, ``emission`` and ``base`` by head word."""

    symbols: Symbols
    label: np.ndarray
    transition: np.ndarray
    emission: np.ndarray
    base: np.ndarray
    end_base: float
    end_known: bool


def train(texts: DataFrame) -> tuple[Model, DataFrame, dict[str, float]]:
    """Learn from column ``text``: the model, the table (word, n) of all counts, and totals."""
    spark = texts.sparkSession
    counts = stable(texts.mapInPandas(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))
    total, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = most_frequent(counts.where(F.col("n") >= LEAST), "n", HEAD).toPandas().sort_values(["n", "word"], ascending=[False, True])
    symbols = Symbols([w.encode("utf-8") for w in top["word"]], top["n"].to_numpy(np.int64))
    with Steps(spark, "classes") as steps:
        found = texts.mapInPandas(_bigrams(spark.sparkContext.broadcast(symbols)), "first int, second int, n long")
        pairs = steps.keep(found.groupBy("first", "second").agg(F.sum("n").alias("n")), "bigrams")
        label, joint = cluster(steps, pairs, symbols)
    n_labels = len(joint)
    ends = joint[:, n_labels - 1].sum()
    held = joint.sum(0)
    n, v = total + ends, kinds + (ends > 0)
    frequency = (held + 1) / (held.sum() + n_labels)
    given = joint / np.maximum(1, joint.sum(1, keepdims=True))
    seen = joint.sum(1, keepdims=True) > 0
    transition = np.log10(np.where(seen, BIGRAM * given + (1 - BIGRAM) * frequency, frequency))
    in_class = np.bincount(label[:-2], weights=symbols.counts, minlength=n_labels)
    emission = np.log10(symbols.counts / in_class[label[:-2]])
    base = np.log10((symbols.counts + 1) / (n + v + 1))
    model = Model(symbols, label, transition, emission, base, float(np.log10((ends + 1) / (n + v + 1))), bool(ends))
    tail = total - int(symbols.counts.sum())
    return model, counts, {"n": n, "v": v, "tail_total": tail + (kinds - len(symbols.head)) + 1}


def _scores(shared):
    def score(batches):
        model = shared.value
        symbols = model.symbols
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                found, number = symbols.numbers(text)
                known = number[number >= 0]
                line = model.label[np.concatenate([[symbols.end], symbols.symbol[number], [symbols.end]])]
                tail = Counter(found[k] for k in np.flatnonzero(number < 0).tolist())
                rows.append((
                    len(found) + 1, len(known) + model.end_known, model.base[known].sum() + model.end_base,
                    model.transition[line[:-1], line[1:]].sum() + model.emission[known].sum(),
                    # words hold no space
                    b" ".join(tail).decode("utf-8"), np.fromiter(tail.values(), np.int64, len(tail)),
                ))
            n_tokens, n_known, base, own, tail, times = zip(*rows) if rows else ((),) * 6
            yield pd.DataFrame({"id": pdf["id"], "n_tokens": n_tokens, "n_known": n_known, "base_score": base, "score": own, "tail": tail, "times": times})

    return score


def held_out(identifier: Column) -> Column:
    """A seventh of the identifiers, by checksum, is kept from training."""
    return crc_of(identifier) % 7 == 2


def score(docs: DataFrame, text: str = "text", identifier: str = "doc_id") -> DataFrame:
    """One row for each row of ``docs``: identifier, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(identifier).alias("id"), F.col(text).alias("text"))
    model, counts, totals = train(rows.where(~held_out(F.col("id"))).select("text"))
    kind = rows.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = rows.mapInPandas(_scores(shared), f"id {kind}, n_tokens long, n_known long, base_score double, score double, tail string, times array<long>")
    scored = stable(scored.withColumn("row", F.monotonically_increasing_id()))
    listed = scored.where(F.size("times") > 0).select("row", F.split("tail", " ").alias("word"), "times")
    tail = listed.select("row", F.inline(F.arrays_zip("word", "times"))).join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    times = F.col("times")
    sums = tail.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, times).otherwise(0)).alias("more_known"),
        F.sum(times * F.log10((F.col("n") + 1) / F.lit(float(totals["n"] + totals["v"] + 1)))).alias("more_base"),
        F.sum(times * F.log10((F.col("n") + 1) / F.lit(float(totals["tail_total"])))).alias("more_score"),
    )
    out = scored.drop("tail", "times").join(sums, "row", "left").select(
        F.col("id").alias(identifier), held_out(F.col("id")).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(totals["n"])).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
