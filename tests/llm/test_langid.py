"""Language identification: brute force, held-out accuracy and edge cases."""

import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from pitpanel.llm import langid, queries


def test_held_out_accuracy(spark, small):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = queries.op6_language_id(spark, small).collect()
    assert len(rows) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    tested = [r for r in rows if r["held_out"] and docs[r["doc_id"]]["lang"] and r["lang_pred"] != "und"]
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in tested]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_and_identifier_are_no_inputs(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang")
    plain = {r["doc_id"]: r["langid_prediction"] for r in langid.identify(docs).collect()}
    hidden = docs.withColumn("lang", F.when(~langid.held_out(F.col("doc_id")), F.col("lang")))
    assert plain == {r["doc_id"]: r["langid_prediction"] for r in langid.identify(hidden).collect()}


def test_edges(spark):
    rows = [(i, "the cat and the dog of it", "en", 1) for i in range(20)] + [(100 + i, "der hund und die katze", "de", 2) for i in range(20)]
    rows += [(200, None, "en", 3), (201, "", "en", 3), (202, "123 !?", "de", 3), (203, "x", None, 3), (None, "und der hund", None, 3), (204, "the " * 400_000, None, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, bucket int")
    got = {r["doc_id"]: r["langid_prediction"] for r in langid.identify(df).collect()}
    assert [got[k]["lang"] for k in (200, 201, 202)] == ["und"] * 3 and got[200]["score"] == 0
    assert got[None]["lang"] == "de" and got[204]["lang"] == "en" and got[203]["lang"] in ("de", "en")
    unlearned = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r["langid_prediction"]["lang"] for r in langid.identify(unlearned).collect()} == {"und"}
    assert langid.identify(df.limit(0)).count() == 0


def test_scores_do_not_depend_on_the_batch(spark):
    texts = ["the cat and the dog", "der hund und", "a", "un chat et le chien", ""]
    model = langid.Model(["a", "b"], np.random.default_rng(0).normal(size=(langid.BUCKETS, 2)).astype(np.float32), np.zeros(2))
    lang, score = model.predict(texts)
    for k, text in enumerate(texts):
        assert model.predict([text])[0][0] == lang[k] and np.isclose(model.predict([text])[1][0], score[k])


def grams(text):
    """Buckets of all grams of two and three characters, with a space at an end but not inside, and the number of letters."""
    lowered = text.lower()
    plain = " "
    for c in lowered:
        if c.isalpha():
            plain += c
        elif plain[-1] != " ":
            plain += " "
    plain += "" if plain[-1] == " " else " "
    out = []
    for n in (2, 3):
        for k in range(len(plain) - n + 1):
            gram = plain[k : k + n]
            if " " in gram[1:-1]:
                continue
            value = n
            for c in gram:
                value = (value ^ ord(c)) * 0x9E3779B1 % 2**32
                value ^= value >> 15
            out.append((value >> 8) % langid.BUCKETS)
    return out, sum(c.isalpha() for c in lowered)


def brute(rows):
    """{identifier: (language, score)} by dictionaries; rows are (identifier, text, language)."""
    learn = [(t, lang) for i, t, lang in rows if t is not None and lang is not None and zlib.crc32(str(i).encode()) % 3 != 1]
    counts, docs = {lang: Counter() for _, lang in learn}, Counter(lang for _, lang in learn)
    for t, lang in learn:
        counts[lang].update(grams(t)[0])
    out = {}
    for i, t, _ in rows:
        found, letters = grams(t or "")
        if not letters:
            out[i] = ("und", 0.0)
            continue
        total = {}
        for lang in sorted(counts):
            size = sum(counts[lang].values()) + 0.5 * langid.BUCKETS
            total[lang] = math.log(docs[lang] / len(learn)) + sum(np.float32(math.log((counts[lang][b] + 0.5) / size)).item() for b in found)
        best = max(sorted(total), key=total.get)
        out[i] = (best, 1 / sum(math.exp(v - total[best]) for v in total.values()))
    return out


def test_against_brute_force(spark, small):
    rows = [(r["doc_id"], (r["text"] or "")[:1500], r["lang"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    rows += [(10**6, "Straße; o'clock\n99 ΑΣ.Σ'α", "de"), (10**6 + 1, None, "de"), (10**6 + 2, "12", "en"), (10**6 + 3, "İstanbul ﬁn", None)]
    got = {r["doc_id"]: r["langid_prediction"] for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    for i, (lang, score) in brute(rows).items():
        assert got[i]["lang"] == lang and math.isclose(got[i]["score"], score, rel_tol=1e-3, abs_tol=1e-6), i


def test_long_texts_without_spaces_count_the_same(monkeypatch):
    text = "ab" * 400 + "1é" + "xyz" * 300 + " " + "q" * 50
    whole = Counter(grams(text)[0])
    for size in (7, 100, 10_000):
        parts = list(langid.pieces(text, size))
        assert "".join(parts) == text
        found = Counter()
        for p in parts:
            found.update(langid.features([p])[0].tolist())
        assert found == whole, size


def test_many_labels(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 3)
    rows = [(i, "the cat and the dog", "en") for i in range(20)] + [(100 + i, "der hund und die katze", "de") for i in range(15)]
    rows += [(200 + i, "le chat et le chien", f"fr{i}") for i in range(40)]
    got = {r["doc_id"]: r["langid_prediction"]["lang"] for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    learned = {f"fr{i}" for i in range(40) if zlib.crc32(str(200 + i).encode()) % 3 != 1}
    assert set(got.values()) == {"en", "de", min(learned)} and got[0] == "en" and got[100] == "de" and got[200] == min(learned)


def test_memory_of_a_batch_is_bounded():
    import tracemalloc

    rng = np.random.default_rng(2)
    model = langid.Model(list("abcd"), rng.normal(size=(langid.BUCKETS, 4)).astype(np.float32), np.zeros(4))
    texts = ["".join(rng.choice(list("abcdefgh "), 1000)) for _ in range(2000)]
    model.predict(texts[:1])
    tracemalloc.start()
    model.predict(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48 << 20
