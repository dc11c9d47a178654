import hashlib
import random

import numpy as np
import pytest

from conftest import ODD
from tapeworks.llm import suffixes as S

R = random.Random(8)


def noise(n, alphabet="abcdefghij klmé"):
    return "".join(R.choice(alphabet) for _ in range(n))


def brute(texts):
    seen, out = set(), []
    for t in texts:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            window = b[p : p + 100]
            if window in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(x for x, y in zip(b, gone, strict=True) if not y)
        spans = sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(b)))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus():
    passages = [noise(R.randint(60, 500)) for _ in range(12)]
    texts = []
    for _ in range(120):
        parts = []
        for _ in range(R.randint(0, 4)):
            p = R.choice(passages)
            a = R.choice([0, 0, R.randint(0, 40)])
            parts += [noise(R.randint(0, 120)), p[a : len(p) - R.choice([0, 0, R.randint(0, 40)])]]
        texts.append("".join(parts))
    return texts + [texts[3], "q" * 350, "xy" * 200 + noise(10) + "xy" * 90, *ODD, noise(99), noise(100)]


@pytest.mark.parametrize(("batch", "hot"), [(S._BATCH_ROWS, S.HOT), (5, S.HOT), (5, 3), (S._BATCH_ROWS, 1)])
def test_equals_brute_force(docs_of, monkeypatch, batch, hot):
    """Hot anchors and hot windows are resolved by other means, to the same bytes."""
    monkeypatch.setattr(S, "_BATCH_ROWS", batch)
    monkeypatch.setattr(S, "HOT", hot)
    texts = corpus()
    rows = sorted(S.dedup_substrings(docs_of(texts).repartition(7)).collect(), key=lambda r: r.doc_id)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows] == brute(texts)


def test_repeated_rows_and_null_ids(docs_of):
    a, b = noise(300), noise(150)
    rows = S.dedup_substrings(docs_of([a, a, a, b + a, None], [5, 5, None, None, 6]), with_kept=True).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in rows)
    size = len(a.encode())
    assert len(rows) == 5 and got[:3] == [(False, 5, size), (False, 5, size), (False, 6, 0)]
    assert sum(x[2] for x in got[3:]) == size and S.dedup_substrings(docs_of([])).count() == 0


def test_sorting(monkeypatch):
    rng = np.random.default_rng(3)
    strings = rng.integers(0, 3, (400, S._REACH)).astype(np.uint8)
    strings[50:200, :40] = strings[0, :40]
    strings[200:260] = strings[7]
    group = np.sort(rng.integers(0, 4, 400))
    order = S.deep_shallow_sort(group, strings)
    assert [(group[i], strings[i].tobytes()) for i in order] == sorted((group[i], strings[i].tobytes()) for i in range(400))
    texts = [bytes(rng.integers(97, 100, 9).astype(np.uint8)) for _ in range(300)]
    trie = S.BlindTrie(9)
    for t in texts:
        trie.insert(t)
    assert list(trie) == sorted(set(texts))


def test_quicksort_leaves_ties_of_the_shallow_depth():
    rng = np.random.default_rng(4)
    words = rng.integers(0, 4, (500, 2)).astype(np.uint64) << np.uint64(60)
    group = np.sort(rng.integers(0, 5, 500))
    order, starts, ends = S.multikey_quicksort(group, words)
    rows = [(group[i], *words[i].tolist()) for i in order]
    assert rows == sorted(rows) and sorted(order.tolist()) == list(range(500))
    assert all(len(set(rows[s:e])) == 1 and e - s > 1 for s, e in zip(starts, ends, strict=True))
    assert sum(ends - starts) == sum(rows.count(r) > 1 for r in rows)
    assert [len(x) for x in S.multikey_quicksort(group[:0], words[:0])] == [0, 0, 0]


def test_a_batch_border_inside_an_anchor():
    """Contexts of one anchor in many small batches."""
    rows = [(0, 7, c, 0, d, S._pack(np.int64(100), np.int64(68), np.int64(68))) for c in (1, 1, 2, 3, 3, 3, 4) for d in (1,)] + [(0, 8, 1, 0, 1, 5)]
    whole = [r for b in S._compare(iter([S._rows(0, *(np.array([r[i] for r in rows]) for i in range(1, 6)))])) for r in b.to_pylist() if r["kind"] == 2]
    parts = [r for b in S._compare(S._rows(0, *(np.array([r[i]]) for i in range(1, 6))) for r in rows) for r in b.to_pylist() if r["kind"] == 2]
    assert whole == parts and [r["context"] for r in whole] == [1, 2, 3, 4]


def test_chunks_have_the_same_anchors(monkeypatch):
    data = np.frombuffer(noise(3000).encode(), np.uint8)
    whole = set(zip(*map(tuple, S.anchors(data)), strict=True))
    monkeypatch.setattr(S, "_CHUNK", 257)
    assert set(zip(*map(tuple, S.anchors(data)), strict=True)) == whole
