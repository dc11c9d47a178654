import hashlib
import random
import re

import pytest

from conftest import ODD
from tapeworks.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
R = random.Random(9)


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window):
    w, hit, found = words(text), set(), set()
    for i, item in items:
        b = words(item)
        n = min(window, len(b))
        spans = {tuple(b[k : k + n]) for k in range(len(b) - n + 1)} if n else set()
        for at in range(len(w) - n + 1) if n else ():
            if tuple(w[at : at + n]) in spans:
                hit |= set(range(at, at + n))
                found.add(i)
    names = sorted(map(str, found))
    return len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)


def text(n):
    return "".join(R.choice(["Alpha", "beta", "GAMMA", "été", "d9", "ÉT", "kappa"]) + R.choice([" ", ", ", "\n", "-"]) for _ in range(n))


@pytest.mark.parametrize("window, gram, broadcast", [(10, 6, 10**6), (6, 6, 10**6), (7, 3, 0)])
def test_equals_brute_force(spark, docs_of, monkeypatch, window, gram, broadcast):
    monkeypatch.setattr(D, "BROADCAST_ROWS", broadcast)
    items = [(i, text(R.randint(12, 40))) for i in range(12)] + [(20, "one two THREE"), (21, ""), (22, None), (23, "!!"), (24, "Alpha")][: 4 + (window == 10)]
    texts = [text(60) for _ in range(20)]
    for i in range(15):
        item = items[i % 12][1]
        cut = words(item)[1 : 1 + R.randint(window - 1, 20)]
        texts.append(text(15) + " ".join(cut) + " " + text(15))
    texts += ["x one, Two three y", *ODD]
    rows = D.contamination(docs_of(texts), spark.createDataFrame(items, "item_id bigint, text string"), window, gram).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == brute(texts[r.doc_id], items, window)


def test_repeats_nulls_and_empty(spark, docs_of):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k"), (1, "a b c d e f g h i j k")], "item_id bigint, text string")
    hit = "z a b c d e f g h i j k"
    rows = D.contamination(docs_of([hit, hit, "no", hit], [4, 4, None, None]), bench).collect()
    assert sorted((r.doc_id is None, r.n_hit) for r in rows) == [(False, 11), (False, 11), (True, 0), (True, 11)]
    kept = D.remove_contaminated(docs_of([hit, hit, "no", hit], [4, 4, None, None]), bench).collect()
    assert [(r.doc_id, r.text) for r in kept] == [(None, "no")]
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert [r.contaminated for r in D.contamination(docs_of([hit]), none).collect()] == [False]
    assert D.contamination(docs_of([]), bench).count() == 0
