import random
import re

import xxhash

from conftest import ODD
from tapeworks.llm import simhash as S

R = random.Random(6)


def plain(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(values, ids):
    root = {i: i for i in range(len(values))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i in range(len(values)):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least.get(find(i)) for i in range(len(values))]


def test_documents(docs_of):
    base = ["".join(R.choice(["Ab ", "cD\n", "éF\t", "gh\x0b", "i j "]) for _ in range(R.randint(1, 300))) for _ in range(40)]
    texts = base + [b + " tail" for b in base[:20]] + base[:5] + ODD
    ids = [*range(3, len(texts) + 1), None, None][: len(texts)]
    rows = S.near_duplicates(docs_of(texts, ids)).collect()
    values = [plain(t) for t in texts]
    want = sorted(zip(map(str, ids), [f"{v:016x}" for v in values], map(str, groups(values, ids)), strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == want
    assert S.near_duplicates(docs_of([])).count() == 0


def test_links_reach_all_within_two_bits(spark, monkeypatch):
    seeds = [R.getrandbits(64) for _ in range(60)]
    values = set(seeds)
    for s in seeds[:20]:
        for _ in range(30):
            s ^= (1 << R.randrange(64)) ^ (1 << R.randrange(64) if R.random() < 0.7 else 0)
            values.add(s)
    values = sorted(values | {0, 2**64 - 1})
    signed = [v - 2**64 if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    want = groups(values, signed)
    for limit, members in ((S.SHARD_LIMIT, S.BROADCAST_MEMBERS), (3, S.BROADCAST_MEMBERS), (S.SHARD_LIMIT, 0), (3, 0)):
        monkeypatch.setattr(S, "SHARD_LIMIT", limit)
        monkeypatch.setattr(S, "BROADCAST_MEMBERS", members)
        found = {r.id: r.root for r in S.components(S.links(fps)).collect()}
        assert [found.get(v, v) for v in signed] == want


def test_tree():
    tree, values = S.BKTree(), [R.getrandbits(10) for _ in range(300)]
    values = list(dict.fromkeys(values))
    for v in values:
        tree.add(v)
    for q in range(0, 1024, 7):
        assert sorted(values[i] for i in tree.within(q, 2)) == sorted(v for v in values if (v ^ q).bit_count() <= 2)


def test_hot_component(spark):
    edges = spark.createDataFrame([(0, i) for i in range(1, 200)] + [(1000 + i, 1001 + i) for i in range(64)] + [(5, 5), (None, 3)], "src bigint, dst bigint")
    got = {r.id: r.root for r in S.components(edges).collect()}
    assert len(got) == 265 and all(got[i] == 0 for i in range(200)) and all(got[1000 + i] == 1000 for i in range(65))


def test_trees_answer_as_brute_force():
    import pyarrow as pa

    members = [(k, v - 2**64 if v >> 63 else v) for k in (1, 2) for v in sorted({R.getrandbits(7) | R.getrandbits(1) << 63 for _ in range(80)})]
    trees = S.shard_trees(pa.table({"key": [k for k, _ in members], "fp": [v for _, v in members]}))
    for key, fp in members:
        near = {trees[key].values[i] for i in trees[key].within(fp % 2**64, 2)}
        assert near == {v % 2**64 for k, v in members if k == key and ((v ^ fp) % 2**64).bit_count() <= 2}
