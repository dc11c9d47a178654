import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import ODD
from tapeworks.llm import toxicity as tox

R = random.Random(4)
BAD = ["vilewort", "grubface", "snotling", "hagfish"]


def word():
    return "".join(R.choice("bcdfglmnprst") + R.choice("aeiou") for _ in range(R.randint(1, 4)))


def corpus(n=1200):
    texts, toxic = [], []
    for i in range(n):
        words = [word() for _ in range(R.randint(5, 60))]
        bad = i % 6 == 0
        if bad:
            for _ in range(R.randint(1, 4)):
                words.insert(R.randrange(len(words)), R.choice(BAD) + R.choice(["", "s", "ish"]))
        texts.append(" ".join(words))
        toxic.append(int(bad))
    return texts, toxic


corpus_texts = corpus()


@pytest.fixture(scope="module")
def fitted(spark, docs_of):
    texts, toxic = corpus_texts
    docs = docs_of(texts)
    labels = spark.createDataFrame([(i, 1, y) for i, y in enumerate(toxic)] + [(None, 1, 1), (3, 1, None), (10**9, 1, 1)], "doc_id bigint, quality int, toxic int")
    return docs, labels, toxic, tox.fit(docs, labels)


def test_held_out_accuracy(fitted):
    docs, _, toxic, index = fitted
    rows = tox.score(docs, index).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(len(toxic)) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == toxic[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert all(e.toxic in (0, 1) and 0 < e.cosine <= 1 for r in rows for e in r.evidence)
    assert sorted(map(tuple, tox.score_fitted(docs, index).collect()), key=str) == sorted(map(tuple, rows), key=str)
    kept = {r.doc_id for r in tox.remove_toxic(docs, index).collect()}
    assert kept == {r.doc_id for r in rows if not r.predicted} and tox.remove_toxic(docs, index).columns == docs.columns


def test_labels_of_the_held_out_fold_are_not_used(spark, fitted):
    docs, labels, _, model = fitted
    flipped = labels.withColumn("toxic", F.when(tox.is_held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = tox.fit(docs, flipped)
    assert again.index.terms == model.index.terms and (again.index.labels == model.index.labels).all() and again.zero_score == model.zero_score
    assert (again.index.weighing == model.index.weighing).all() and (again.steps[1] == model.steps[1]).all()


def plain_vectors(texts, toxic):
    """TF-IDF by dictionaries: document frequencies of all texts, relevance from the fitted fold."""
    fold = {t: y for i, (t, y) in enumerate(zip(texts, toxic, strict=True)) if zlib.crc32(str(i).encode()) % 5}
    counts = {t: tox.terms_of(t) for t in texts}
    df, n, bad = Counter(), Counter(), Counter()
    for t in texts:
        df.update(counts[t].keys())
    for t, y in fold.items():
        n.update(counts[t].keys())
        bad.update({k: y for k in counts[t]})
    base = sum(fold.values()) / len(fold)

    def weight(k):
        p, m, z = bad[k] / n[k], n[k], 1.96
        low = (p + z * z / (2 * m) - z * math.sqrt(p * (1 - p) / m + z * z / (4 * m * m))) / (1 + z * z / m)
        return (math.log((1 + len(texts)) / (1 + df[k])) + 1) * (tox.FLOOR + (1 - tox.FLOOR) * max(0, low - base) / (1 - base))

    def vector(t):
        v = {k: (1 + math.log(c)) * weight(k) for k, c in counts[t].items() if n[k]}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {k: x / size for k, x in v.items()}

    return {t: vector(t) for t in fold}, vector


def test_nearest_equal_brute_force_over_the_whole_vocabulary(fitted):
    _, _, toxic, model = fitted
    texts, _ = corpus_texts
    known, vector = plain_vectors(texts, toxic)
    ids = {texts.index(t) for t in known}
    assert set(model.index.ids.tolist()) == ids and {int(model.index.labels[i]) for i in range(len(ids))} == {0, 1}
    assert set(model.index.terms) == {k for t in known for k in tox.terms_of(t)}
    for text in R.sample(texts, 150):
        q = vector(text)
        cosines = ((sum(w * v.get(k, 0) for k, w in q.items()), texts.index(t)) for t, v in known.items())
        scores = sorted((-s, i) for s, i in cosines if s > 0)[: tox.NEIGHBOURS]
        got = model.index.nearest(*model.index.vector(text), tox.NEIGHBOURS)
        assert np.allclose([-s for s, _ in scores], [s for s, _ in got], atol=1e-6)
        clear = [i for (s, i), (t, _) in zip(scores, scores[1:], strict=False) if abs(s - t) > 1e-5]
        assert {i for i in clear} <= {int(model.index.ids[i]) for _, i in got}


def test_blocks_that_cannot_reach_the_best_are_left_out(fitted, monkeypatch):
    index, texts = fitted[3].index, corpus_texts[0][:100]
    monkeypatch.setattr(tox, "FIRST", 1)
    index.visited = 0
    for text in texts:
        index.nearest(*index.vector(text), 1)
    assert index.visited < 0.8 * len(texts) * index.n_blocks


def test_an_equal_text_outvotes_its_neighbours(spark, docs_of):
    texts, toxic = corpus(400)
    plain = " ".join(word() for _ in range(30))  # nothing of the known bad words
    mine = next(i for i in range(90_000, 90_100) if zlib.crc32(str(i).encode()) % 5)
    docs = docs_of([*texts, plain, plain], [*range(len(texts)), 80_000, mine])
    labels = spark.createDataFrame([(i, y) for i, y in enumerate(toxic)] + [(mine, 1)], "doc_id bigint, toxic int")
    model = tox.fit(docs, labels)
    near = model.score(plain)[1]
    assert near[0][0] == pytest.approx(1) and model.index.ids[near[0][1]] == mine and model.index.vote(near) > 0.5


def test_odd_inputs(spark, docs_of, fitted):
    index = fitted[3]
    rows = tox.score(docs_of([*ODD, "a grubface", "a grubface"], [None, *range(len(ODD) + 1)]), index).collect()
    assert len(rows) == len(ODD) + 2 and rows[0].held_out is False and rows[0].score == index.zero_score and rows[-1].score == rows[-2].score > 0.5
    none = tox.fit(docs_of(["a"]), spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert [r.score for r in tox.score(docs_of(["a", None]), none).collect()] == [0.0, 0.0]
    assert tox.score(docs_of([]), index).count() == 0 and tox.score_fitted(docs_of(["a", None]), none).count() == 2
    wordless = docs_of(["", None, "!!", "..."])
    model = tox.fit(wordless, spark.createDataFrame([(i, 1) for i in range(4)], "doc_id bigint, toxic int"))
    assert [r.score for r in tox.score_fitted(wordless, model).collect()] == [model.zero_score] * 4


def test_isotonic():
    edges, values = tox.isotonic(np.array([0.1, 0.2, 0.3, 0.9, 0.9]), np.array([0, 1, 0, 1, 1]))
    assert (np.diff(edges) > 0).all() and (np.diff(values) > 0).all()
    votes = np.r_[np.full(50, 0.1), np.full(100, 0.5), 0.9]
    edges, values = tox.isotonic(votes, np.r_[np.zeros(50), np.ones(99), 0, 1])
    assert (np.diff(values) >= 0).all() and values[-1] > 0.9
