import random

from conftest import ODD
from tapeworks.llm import near_copies as N
from tapeworks.llm import simhash

R = random.Random(8)


def shingle_set(text):
    w = (text or "").lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near(a, b):
    return not a and not b or len(a & b) >= 0.8 * len(a | b) - 1e-12


def brute(texts):
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets, fps = [shingle_set(t) for t in texts], [simhash.fingerprint(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            if near(sets[i], sets[j]) or (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {find(i) for i in range(len(texts))}


def corpus():
    texts, passage = [], " ".join(f"common{i}" for i in range(40))
    for i in range(40):
        words = [f"w{R.randrange(4000)}" for _ in range(R.randint(6, 300))]
        texts.append(" ".join(words) + (" " + passage if i % 3 else ""))
        for n in range(4):
            copy = list(words)
            for _ in range(max(1, len(words) // R.choice([30, 50, 80, 120]))):
                copy[R.randrange(len(copy))] = f"x{R.randrange(9999)}"
            texts.append(" ".join(copy) + (" " + passage if i % 3 else ""))
    R.shuffle(texts)
    return texts + ODD


def test_equals_brute_force(docs_of):
    texts = corpus()
    docs = docs_of(texts)
    kept = N.keep_one_each(docs)
    assert kept.columns == docs.columns
    want = brute(texts)
    assert {r.doc_id for r in kept.collect()} == want
    # op9's two bits alone leave most of these copies
    assert simhash.near_duplicates(docs).select("component_id").distinct().count() > 1.3 * len(want)


def test_parities_bound_the_difference():
    for n, m in ((30, 40), (900, 1100), (3000, 3000), (0, 5)):
        shared = [R.getrandbits(64) for _ in range(min(n, m) // 2)]
        a, b = (N.np.array(sorted({*shared, *(R.getrandbits(64) for _ in range(k - len(shared)))}), dtype=N.np.uint64) for k in (n, m))
        x, y = N.parity(a), N.parity(b)
        width = min(len(x), len(y))
        assert (N.fold(N.parity(a), 64) == N.fold(N.fold(x, width), 64)).all()
        assert N.np.bitwise_count(N.fold(x, width) ^ N.fold(y, width)).sum() <= len(set(a.tolist()) ^ set(b.tolist()))


def test_rows_that_share_an_id_or_have_none(docs_of):
    docs = docs_of(["one two three four", "quite other words stand here", "one two three four", "x y z", "x y z", "x y z"], [1, 1, 2, 7, 7, None])
    got = sorted((str(r.doc_id), r.text) for r in N.keep_one_each(docs).collect())
    assert got == [("1", "one two three four"), ("1", "quite other words stand here"), ("7", "x y z"), ("None", "x y z")]
    assert N.keep_one_each(docs_of([])).count() == 0
    # rows of one id with other texts are other documents, in any order
    for order in ([0, 1, 2, 3], [3, 2, 1, 0], [2, 0, 3, 1]):
        rows = [(1, "this is text A"), (1, "some words of B"), (2, "this is text A"), (2, "and C has these")]
        kept = N.keep_one_each(docs_of([rows[i][1] for i in order], [rows[i][0] for i in order])).collect()
        assert sorted((r.doc_id, r.text) for r in kept) == [(1, "some words of B"), (1, "this is text A"), (2, "and C has these")]
