"""Language-model scoring: base scores by brute force, probabilities sum to one, exchange improves its likelihood."""

import math
import re
import zlib
from collections import Counter

import numpy as np

from pitpanel.llm import brown, queries


def tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def check(rows, docs):
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts = Counter(t for i, text in docs if not out(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), len(ts := tokens(text)), sum(counts[t] > 0 for t in ts), out(i), round(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts), 6)) for i, text in docs)
    assert all(r["train_tokens"] == n and r["score"] < 0.0001 for r in rows)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["held_out"], round(r["base_score"], 6)) for r in rows) == want


def test_query(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    check(queries.op7_lm_scoring(spark, small).collect(), docs)


def test_tail_words_and_edges(spark, monkeypatch):
    monkeypatch.setattr(brown, "HEAD", 5)
    monkeypatch.setattr(brown, "CLUSTERED", 3)
    docs = [(i, " ".join(f"W{(i * k) % 11}" for k in range(i % 9))) for i in range(60)] + [(70, None), (70, "a\xa0b \t c"), (None, "w1 w1 never"), (71, "")]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, word string")
    check(brown.score(df).collect(), docs)
    assert brown.score(df.limit(0)).count() == 0
    only_held = [(i, "some words") for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2]
    check(brown.score(spark.createDataFrame(only_held, "doc_id long, text string")).collect(), only_held)


def test_probabilities_sum_to_one(spark, monkeypatch):
    monkeypatch.setattr(brown, "HEAD", 6)
    monkeypatch.setattr(brown, "CLUSTERED", 4)
    texts = spark.createDataFrame([(" ".join(f"w{(i * k) % 9}" for k in range(9)),) for i in range(30)], "text string")
    model, counts, totals = brown.train(texts)
    assert np.allclose((10**model.transition).sum(1), 1)
    label = model.label[model.symbols.symbol[:-1]]
    assert np.allclose(np.bincount(label, 10**model.emission)[np.unique(label)], 1)
    head = {w.decode() for w in model.symbols.head}
    tail = sum(r["n"] + 1 for r in counts.collect() if r["word"] not in head)
    assert tail + 1 == totals["tail_total"]


def test_scores_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(brown, "CLUSTERED", 4)
    monkeypatch.setattr(brown, "CLASSES", 3)
    monkeypatch.setattr(brown, "LEAST", 6)
    kinds = [["the", "a", "some"], ["cat", "dog", "bird", "fish"], ["sees", "likes"], ["."]]
    docs = [(i, " ".join(kinds[k % 4][(i * 7 + k * k + i // 3) % len(kinds[k % 4])] for k in range(4 + i % 9)) + (f" rare{i}" if i % 4 == 0 else "")) for i in range(80)]
    docs += [(100, None), (101, "The the never"), (102, "x" * 100_000 + " the " * 1000)]
    rows = {r["doc_id"]: r["score"] for r in brown.score(spark.createDataFrame([(i, t, 1, "s") for i, t in docs], "doc_id long, text string, id long, symbol string")).collect()}
    learned = [(i, t) for i, t in docs if zlib.crc32(str(i).encode()) % 7 != 2]
    texts = spark.createDataFrame(learned, "doc_id long, text string")
    model, _, _ = brown.train(texts.select("text"))
    head = {w.decode(): int(c) for w, c in zip(model.symbols.head, model.label)}
    counts = Counter(t for _, text in learned for t in tokens(text) if t is not None)
    assert set(head) == {w for w, n in counts.items() if n >= 6} and len(head) > 6 and len(set(head.values())) == 3
    kind = lambda t: "end" if t is None else head.get(t, "tail")
    classes = [0, 1, 2, "tail", "end"]
    pairs, of = Counter(), Counter()
    for _, text in learned:
        line = [kind(t) for t in [None, *tokens(text)]]
        pairs.update(zip(line, line[1:]))
        of.update(line[1:])
    total = sum(of.values())
    in_class = Counter()
    for w, n in counts.items():
        in_class[kind(w)] += n
    unknown = in_class["tail"] + sum(w not in head for w in counts) + 1
    for i, text in docs:
        before, want = "end", 0.0
        for t in tokens(text):
            c = kind(t)
            follows = sum(pairs[before, x] for x in classes)
            own = (of[c] + 1) / (total + len(classes))
            step = 0.9 * pairs[before, c] / follows + 0.1 * own if follows else own
            word = 1 if t is None else counts[t] / in_class[c] if t in head else (counts[t] + 1) / unknown
            want += math.log10(step * word)
            before = c
        assert math.isclose(rows[i], want, rel_tol=1e-9), i


def test_moves_in_tasks_raise_the_likelihood_and_the_vocabulary_has_no_bound(spark, monkeypatch):
    monkeypatch.setattr(brown, "CLUSTERED", 10)
    monkeypatch.setattr(brown, "CLASSES", 4)
    monkeypatch.setattr(brown, "LEAST", 5)
    monkeypatch.setattr(brown, "GAIN", 0.01)
    rng = np.random.default_rng(5)
    kinds = [[f"{c}{k}" for k in range(200)] for c in "abcd"]
    texts = [" ".join(kinds[(i + k) % 4][rng.integers(200)] for k in range(60)) for i in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    model, _, _ = brown.train(df)
    head = [w.decode() for w in model.symbols.head]
    assert len(head) == 800
    groups = [Counter(int(c) for w, c in zip(head, model.label) if w[0] == k) for k in "abcd"]
    # moves made at once end in a local optimum: most words of a kind come together, though two kinds may share a class
    assert sum(g.most_common(1)[0][1] for g in groups) > 0.75 * 800 and len({g.most_common(1)[0][0] for g in groups}) >= 2


def likelihood(bigrams, label):
    hot = np.eye(label.max() + 1)[label]
    joint = hot.T @ bigrams @ hot
    xlogx = lambda x: (x[x > 0] * np.log(x[x > 0])).sum()
    return xlogx(joint) - xlogx(joint.sum(0)) - xlogx(joint.sum(1))


def test_exchange_ends_where_no_move_helps():
    rng = np.random.default_rng(3)
    kind = np.arange(40) % 4
    chain = np.array([[0.05, 0.85, 0.05, 0.05], [0.05, 0.05, 0.85, 0.05], [0.05, 0.05, 0.05, 0.85], [0.85, 0.05, 0.05, 0.05]])
    bigrams = rng.poisson(40 * chain[kind][:, kind]).astype(float)
    order = rng.permutation(40)
    bigrams = bigrams[np.ix_(order, order)]
    label = brown.exchange(bigrams, 37, 4)
    assert label[37:].tolist() == [4, 5, 6]
    best = likelihood(bigrams, label)
    assert best > likelihood(bigrams, np.concatenate([np.arange(37) % 4, [4, 5, 6]]))
    for w in range(37):
        for c in range(4):
            other = label.copy()
            other[w] = c
            assert likelihood(bigrams, other) <= best + 1e-6


def test_better_than_unigrams_on_ordered_text(spark):
    docs = [(i, "the cat sat on a mat . " * 5) for i in range(100)]
    rows = brown.score(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert all(r["score"] > r["base_score"] / 2 for r in rows)


def test_many_words_find_the_class_that_each_finds_alone():
    rng = np.random.default_rng(7)
    size, classes, n = 9, 7, 60
    label = np.concatenate([rng.integers(0, classes, n), [classes, classes + 1]])
    bigrams = rng.poisson(0.4, (n + 2, n + 2)).astype(float)
    hot = np.eye(size)[label]
    joint = hot.T @ bigrams @ hot
    out, inn, own, old = bigrams[:n] @ hot, (bigrams.T @ hot)[:n], bigrams.diagonal()[:n].copy(), label[:n]
    out[np.arange(n), old] -= own
    inn[np.arange(n), old] -= own
    want = []
    for w in range(n):
        alone = joint.copy()
        brown._take(alone, old[w], out[w], inn[w], own[w], -1)
        want.append(brown._best(alone, out[w], inn[w], own[w], classes, int(old[w])))
    assert brown._best_many(joint, out, inn, own, classes, old).tolist() == want
    assert (np.array(want) != old).any()
