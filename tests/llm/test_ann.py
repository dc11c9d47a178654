import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeworks.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, label int, norm double, codes string"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(int(i), v if v is None else [None if x is None else float(x) for x in v], None, None, "c") for i, v in zip(ids, vectors, strict=True)], SCHEMA)


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(40, 24))[rng.integers(0, 40, 3000)] + 0.7 * rng.normal(size=(3000, 24))).astype(np.float32)
    got: dict[int, list] = {}
    for r in ann.nearest(frame(spark, x), every=50).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r)
    y = x.astype(np.float64)
    y /= np.sqrt((y**2).sum(1))[:, None]
    hits = 0
    for q, rows in got.items():
        s = y @ y[q]
        s[q] = -2
        assert [r.rank for r in rows] == [1, 2, 3, 4, 5] and all(abs(s[r.vec_id] - r.score) < 1e-12 for r in rows)
        hits += len(set(np.argsort(-s)[:5]) & {r.vec_id for r in rows})
    assert len(got) == 60 and hits >= 0.9 * 300


def test_recall_and_share_of_exact_cosines(spark):
    """By codes alone few rows get an exact cosine, however rows come in batches."""
    rng = np.random.default_rng(3)
    n, asked = 12_000, 60
    x = (rng.normal(size=(200, 32))[rng.integers(0, 200, n)] + 0.5 * rng.normal(size=(n, 32))).astype(np.float32)
    y = x.astype(np.float64)
    y /= np.sqrt((y**2).sum(1))[:, None]
    results = []
    for rows in ("1000", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
        index, books, d = ann.build_index(frame(spark, x).repartition(3, "vec_id"))
        exact = spark.sparkContext.accumulator(0)
        queries = ann._clean(frame(spark, x[:asked]), "vec_id", "embedding")
        found = {}
        for r in ann.search(index.coalesce(2), queries, books, d, exact_share=exact).collect():
            found.setdefault(r.query_id, set()).add(r.vec_id)
        hits = 0
        for q in range(asked):
            s = y @ y[q]
            s[q] = -2
            hits += len(set(np.argsort(-s)[:5].tolist()) & found[q])
        results.append((hits / (5 * asked), exact.value / (n * asked)))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    print("recall, share of exact cosines:", results)
    assert all(recall >= 0.9 and share <= 2 * ann.RERANK / n + 1e-9 for recall, share in results)


def test_copies_ties_and_odd_vectors(spark):
    v = [[1, 0, 0]] * 40 + [[0, 1, 0], [0.9, 0.1, 0]]
    odd = [None, [0, 0, 0], [1, None, 0], [float("nan"), 1, 0], [float("inf"), 0, 0], [1, 0], []]
    got = ann.nearest(frame(spark, v + odd), every=20, k=5).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(0, i) for i in (1, 2, 3, 4, 5)] + [(20, i) for i in (0, 1, 2, 3, 4)] + [(40, 41), *[(40, i) for i in (0, 1, 2, 3)]]
    assert ann.nearest(frame(spark, [])).count() == 0
    assert [(r.query_id, r.vec_id) for r in ann.nearest(frame(spark, [[1, 0], [0, 1]]), every=2).collect()] == [(0, 1)]
    twice = ann.nearest(frame(spark, [[1, 0], [1, 0], [1, 1], [1, 1]], [0, 0, 3, 3]), every=2).collect()
    assert [(r.query_id, r.vec_id) for r in twice] == [(0, 3)]
    # a row that is repeated leaves room for other ids, and a row without an id takes no part
    many = ann.nearest(frame(spark, [[1, 0]] * 30 + [[1, 0.1]] * 3, [0] + [1] * 26 + [2, 3, 4] + [5, 6, 7]), every=100).orderBy("rank").collect()
    assert [r.vec_id for r in many] == [1, 2, 3, 4, 5]
    lost = frame(spark, [[1, 0], [0, 1], [1, 1]]).withColumn("vec_id", F.when(F.col("vec_id") != 1, F.col("vec_id")))
    assert [(r.query_id, r.vec_id) for r in ann.nearest(lost, every=2).orderBy("query_id").collect()] == [(0, 2), (2, 0)]


@pytest.mark.parametrize("beam", [1, 4])
def test_encoding_gets_closer_with_a_wider_beam(beam):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 16))
    books = ann.train(x, 4, 16)
    codes, norms = ann.encode(x, books, beam)
    sums = sum(books[i][codes[:, i]] for i in range(4))
    assert np.allclose(norms, np.sqrt((sums**2).sum(1)))
    wide, _ = ann.encode(x, books, 16)
    error = lambda c: ((x - sum(books[i][c[:, i]] for i in range(4))) ** 2).sum()
    assert error(wide) <= error(codes) + 1e-9 < (x**2).sum()
