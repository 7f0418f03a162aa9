"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts every n-gram of every training row: each task sums its rows into one vector per language and Spark
adds those up. The log-probability matrix (languages x BUCKETS floats) is broadcast; it does not grow with the corpus.
A batch is scored as a sparse matrix, bucket numbers with row offsets, times that dense matrix.

Null text, empty text and text without a letter get ``und`` with score 0, and so does everything if there was no
training row. Rows with null language or text teach nothing. Nor do labels beyond the MAX_LANGUAGES most frequent ones (of equally
frequent ones the first in sorted order): those are languages, the rest is free text and misspellings. Equal scores go to the first language in
sorted order. Long texts are counted piece by piece, cut between letters and other characters only.
Repeated rows are counted and scored one by one; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.common import bounded_batches, crc_of

ORDERS = (2, 3)
#: Hash buckets of the n-grams; the broadcast matrix has this many floats for each language.
BUCKETS = 1 << 16
#: Labels that are learned at most; the matrix takes 134 MB for 512.
MAX_LANGUAGES = 512
SMOOTHING = 0.5
UNDETERMINED = "und"
#: Characters that are worked on at once: the arrays of a chunk take some hundred bytes for each.
CHUNK = 1 << 17


@lru_cache(1)
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each n-gram of a list of texts, the text each belongs to, and the letters of each text.

    Case is dropped, whatever is no letter counts as one space, and texts are framed by spaces.
    """
    codes = np.frombuffer(" ".join(["", *(t.lower() for t in texts), ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    lengths = np.fromiter((len(t.lower()) for t in texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), lengths + 1)
    owner = np.concatenate([owner, owner[-1:]])
    letter = _letters()[codes]
    n_letters = np.bincount(owner[letter], minlength=len(texts))
    keep = letter | np.concatenate([[True], letter[:-1]])
    codes, owner = np.where(letter, codes, 32)[keep].astype(np.uint32), owner[keep]
    buckets, owners = [], []
    for n in ORDERS:
        m = len(codes) - n + 1
        if m < 1:
            continue
        value = np.full(m, n, np.uint32)
        for k in range(n):
            value = (value ^ codes[k : k + m]) * np.uint32(0x9E3779B1)
            value ^= value >> np.uint32(15)
        # a space may stand at either end of a gram, not inside: then none spans two words or two texts
        inside = np.ones(m, bool)
        for k in range(1, n - 1):
            inside &= codes[k : k + m] != 32
        first = np.where(codes[:m] != 32, owner[:m], owner[1 : 1 + m])
        buckets.append((value[inside] >> np.uint32(8)) & np.uint32(BUCKETS - 1))
        owners.append(first[inside])
    if not buckets:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), n_letters
    return np.concatenate(buckets), np.concatenate(owners), n_letters


def pieces(text: str, size: int):
    """Parts of a text in lower case of about ``size`` characters; no run of letters is cut, so no n-gram differs."""
    text, start = text.lower(), 0
    while len(text) - start > size:
        cut = start + size
        while cut > start and text[cut - 1].isalpha():
            cut -= 1
        if cut == start:  # letters only: the run stays whole
            cut = start + size
            while cut < len(text) and text[cut].isalpha():
                cut += 1
        yield text[start:cut]
        start = cut
    if start < len(text) or not start:
        yield text[start:]


def _chunks(texts: list[str]):
    """(row, piece) pairs in lists of about CHUNK characters; a long text is cut into pieces."""
    chunk, size = [], 0
    for row, text in enumerate(texts):
        for piece in pieces(text, CHUNK):
            chunk.append((row, piece))
            size += len(piece)
            if size >= CHUNK:
                yield chunk
                chunk, size = [], 0
    if chunk:
        yield chunk


@dataclass
class Model:
    """languages in sorted order; weights: BUCKETS x languages; prior: one value a language."""

    languages: list[str]
    weights: np.ndarray
    prior: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        texts = [t or "" for t in texts]
        total = np.zeros((len(texts), len(self.languages)))
        letters = np.zeros(len(texts), np.int64)
        for chunk in _chunks(texts):
            rows = np.array([r for r, _ in chunk])
            bucket, owner, n_letters = features([p for _, p in chunk])
            np.add.at(letters, rows, n_letters)
            if len(bucket) and self.languages:
                # the owners ascend within each order: runs of one text are summed at once
                starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                part = np.add.reduceat(self.weights[bucket], starts, axis=0, dtype=np.float64)
                np.add.at(total, rows[owner[starts]], part)
        known = (letters > 0) & bool(self.languages)
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        total += self.prior
        best = total.argmax(axis=1)
        share = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        return [self.languages[b] if k else UNDETERMINED for b, k in zip(best, known)], np.where(known, share, 0.0)


def _count(batches):
    """Sums of one task: (language, bucket, n); bucket -1 has the number of rows."""
    sums: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for pdf in batches:
        for lang, group in pdf.groupby("lang"):
            rows[lang] = rows.get(lang, 0) + len(group)
            if lang not in sums:
                sums[lang] = np.zeros(BUCKETS, np.int64)
            for chunk in _chunks(list(group["text"])):
                sums[lang] += np.bincount(features([p for _, p in chunk])[0], minlength=BUCKETS)
    for lang, vector in sums.items():
        some = np.flatnonzero(vector)
        yield pd.DataFrame({"lang": lang, "bucket": np.append(some, -1).astype(np.int32), "n": np.append(vector[some], rows[lang])})


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Learn from all rows of ``labelled`` that have text and language."""
    bounded_batches(labelled.sparkSession)
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    often = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "lang").limit(MAX_LANGUAGES)
    learned = [r["lang"] for r in often.collect()]
    rows = rows.where(F.col("lang").isin(learned)) if learned else rows.limit(0)
    counts = rows.mapInPandas(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counts.toPandas()  # at most languages x BUCKETS rows
    languages = sorted(found["lang"].unique())
    number = found["lang"].map({x: k for k, x in enumerate(languages)}).to_numpy(np.int64) if len(found) else np.zeros(0, np.int64)
    n = np.full((BUCKETS, len(languages)), SMOOTHING)
    head = found["bucket"].to_numpy() == -1
    np.add.at(n, (found["bucket"].to_numpy()[~head], number[~head]), found["n"].to_numpy()[~head])
    prior = np.zeros(len(languages))
    prior[number[head]] = found["n"].to_numpy()[head]
    return Model(languages, np.log(n / n.sum(axis=0)).astype(np.float32), np.log(prior / max(1, prior.sum())))


def predictor(model: Model, spark):
    """Column function: text to struct(lang, score)."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(text: pd.Series) -> pd.DataFrame:
        lang, score = shared.value.predict(list(text))
        return pd.DataFrame({"lang": lang, "score": score})

    return predict


def held_out(identifier: Column) -> Column:
    """A third of the identifiers, by checksum, is kept from training."""
    return crc_of(identifier) % 3 == 1


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", identifier: str = "doc_id") -> DataFrame:
    """All rows and columns of ``docs`` plus struct column ``langid_prediction``; learns from rows not held out."""
    bounded_batches(docs.sparkSession)
    model = fit(docs.where(~held_out(F.col(identifier))), text, lang)
    return docs.withColumn("langid_prediction", predictor(model, docs.sparkSession)(F.col(text)))
