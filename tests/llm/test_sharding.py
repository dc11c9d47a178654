import zlib

from conftest import ODD
from tapeworks.llm import sharding
from tapeworks.llm.sharding import _with_range, shard_by_bytes, splitters


def check(rows, texts, shards):
    assert len(rows) == len(texts)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    for found in by.values():
        assert sorted(r.slot for r in found) == list(range(len(found)))
    assert all(0 <= s < shards for s in by) and all(r.law == "bytes" and r.grown_shard is None for r in rows)
    size = sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for t in texts)
    assert sorted((r.size, r.text_crc32) for r in rows) == size
    return {s: sum(r.size for r in found) for s, found in by.items()}


def test_near_equal_with_a_hot_group(docs_of):
    texts = ["a copy of one text " * 5] * 700 + [f"text {i} " * (i % 40) for i in range(1400)]
    sizes = check(shard_by_bytes(docs_of(texts).repartition(5)).collect(), texts, 24)
    assert len(sizes) == 24 and max(sizes.values()) - min(sizes.values()) < 2 * max(len(t) + 8 for t in texts)
    again = check(shard_by_bytes(docs_of(texts).repartition(3)).collect(), texts, 24)
    assert max(again.values()) - min(again.values()) < 2 * max(len(t) + 8 for t in texts)


def test_odd_inputs(docs_of):
    texts = [*ODD, "same", "same"]
    check(shard_by_bytes(docs_of(texts, [None, *range(len(ODD)), len(ODD) - 1])).collect(), texts, 24)
    assert shard_by_bytes(docs_of([])).count() == 0
    check(shard_by_bytes(docs_of(["x"]), 3).collect(), ["x"], 3)


def test_splitters_are_weighted(spark):
    keys = spark.range(4000).selectExpr("id * 1000 as key", "id as tie", "case when id < 1000 then 30 else 1 end as size")
    found = sorted((r.key, r.tie) for r in splitters(keys, 16, 33_000).collect())
    assert len(set(found)) == len(found) <= 15 and sum(k < 1_000_000 for k, _ in found) >= 12


def test_ranges_are_those_of_a_binary_search(spark):
    import bisect
    import random

    rng = random.Random(2)
    rows = [(rng.choice([rng.randrange(-(2**63), 2**63), 5 << 40, -7]), rng.randrange(100), 1) for _ in range(3000)]
    borders = sorted({(k, t) for k, t, _ in rng.sample(rows, 60)})
    got = _with_range(spark.createDataFrame(rows, "key bigint, tie bigint, size bigint"), spark.createDataFrame(borders, "key bigint, tie bigint")).collect()
    assert len(got) == len(rows) and all(r.range == bisect.bisect_right(borders, (r.key, r.tie)) for r in got)
    assert {r.range for r in _with_range(spark.createDataFrame(rows, "key bigint, tie bigint, size bigint"), spark.createDataFrame([], "key bigint, tie bigint")).collect()} == {0}


def test_equal_rows_are_divided(spark, docs_of, monkeypatch):
    """One row repeated is dealt to many ranges, and its copies fill shards."""
    seen = []
    find = sharding._with_range
    monkeypatch.setattr(sharding, "_with_range", lambda rows, borders: seen.append(find(rows, borders)) or seen[-1])
    texts = ["the same row"] * 3000
    sizes = check(shard_by_bytes(docs_of(texts, [7] * 3000)).collect(), texts, 24)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * 20
    assert max(r["count"] for r in seen[0].groupBy("range").count().collect()) < 100
