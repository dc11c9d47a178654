import random

import pytest
from pyspark.sql import functions as F

from conftest import ODD
from tapeworks.llm import lines as L

R = random.Random(3)


def distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        c = [i]
        for j, y in enumerate(b, 1):
            c.append(min(p[j] + 1, c[-1] + 1, p[j - 1] + (x != y)))
        p = c
    return p[-1]


def edited(text, n, alphabet="xyé"):
    s = list(text)
    for _ in range(n):
        kind, at = R.randint(0, 2), R.randrange(max(1, len(s)))
        if kind == 0 and s:
            s.pop(at)
        elif kind == 1 or not s:
            s.insert(at, R.choice(alphabet))
        else:
            s[at] = R.choice(alphabet)
    return "".join(s)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_distance(spark, edits):
    pairs = [(a := "".join(R.choice("abé") for _ in range(R.randint(0, 40))), edited(a, R.randint(0, 5), "abé")) for _ in range(600)]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", L.edit_distance(F.col("a"), F.col("b"), edits).alias("d")).collect()
    assert all(r.d == (d if (d := distance(r.a, r.b)) <= edits else None) for r in got)


def corpus():
    base = ["".join(R.choice("abcdefgh ") for _ in range(R.randint(*R.choice([(8, 24), (18, 22), (29, 60)])))).strip() for _ in range(70)]
    return ["\n".join(edited(R.choice(base), R.choice([0, 0, 1, 1, 2, 3])) for _ in range(R.randint(1, 5))) for _ in range(120)]


def allowed(a, b, classes=L.CLASSES):
    return max((edits for least, edits in classes if min(len(a), len(b)) >= least), default=0)


@pytest.mark.parametrize(("crowd", "classes"), [(512, L.CLASSES), (2, L.CLASSES), (3, ((6, 2), (30, 4)))])
def test_links_equal_brute_force(docs_of, monkeypatch, crowd, classes):
    monkeypatch.setattr(L, "CROWD", crowd)
    docs = docs_of(corpus())
    line = {r.id: r.line for r in L.occurrences(docs, True).collect()}
    ids = list(line)
    want = {}
    for n, a in enumerate(ids):
        for b in ids[:n]:
            most = allowed(line[a], line[b], classes)
            if abs(len(line[a]) - len(line[b])) <= most and (d := distance(line[a], line[b])) <= most:
                want[tuple(sorted((a, b)))] = d
    assert {tuple(sorted((r.a, r.b))): r.distance for r in L.edit_links(docs, classes).collect()} == want and len(want) > 50


def test_a_word_replaced_in_a_long_line(docs_of):
    """Classes with more edits find near copies that a fixed radius of two loses."""
    rng = random.Random(12)
    pairs = []
    for _ in range(12):
        words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 7))) for _ in range(30)]
        copy = list(words)
        copy[rng.randrange(30)] = "other"
        pairs.append((" ".join(words), " ".join(copy)))
    docs = docs_of([t for pair in pairs for t in pair])
    found = L.edit_links(docs, ((10, 1), (20, 2), (100, 7))).count()
    assert found == 12 and L.edit_links(docs).count() < 12


def test_crowds_are_divided_again(docs_of, monkeypatch):
    """Lines that share two long parts stay a crowd after one division."""
    monkeypatch.setattr(L, "CROWD", 8)
    rng = random.Random(3)
    texts = ["same beginning of it " + "".join(rng.choice("abcdefghij") for _ in range(20)) + " and the same long ending" for _ in range(40)]
    texts += [edited(t, 1) for t in texts[:10]]
    line = {r.id: r.line for r in L.occurrences(docs_of(texts), True).collect()}
    want = {tuple(sorted((a, b))) for n, a in enumerate(line) for b in list(line)[:n] if distance(line[a], line[b]) <= 2}
    assert {tuple(sorted((r.a, r.b))) for r in L.edit_links(docs_of(texts)).collect()} == want and len(want) >= 8


def brute(texts):
    """Texts after dedup, by union of all near pairs."""
    seen = {}
    for i, t in enumerate(texts):
        for n, raw in enumerate((t or "").split("\n")):
            if key := raw.strip(" "):
                seen.setdefault(key, (i, n))
    keys, root = list(seen), {}
    find = lambda k: k if root.setdefault(k, k) == k else find(root[k])
    for n, a in enumerate(keys):
        for b in keys[:n]:
            if (most := allowed(a, b)) and abs(len(a) - len(b)) <= most and distance(a, b) <= most:
                root[find(a)] = find(b)
    head = {}
    for k in keys:
        r = find(k)
        head[r] = min(head.get(r, seen[k]), seen[k])
    out = []
    for i, t in enumerate(texts):
        kept = [raw for n, raw in enumerate((t or "").split("\n")) if not raw.strip(" ") or head[find(raw.strip(" "))] == (i, n)]
        out.append(t if t is None else "\n".join(kept))
    return out


def test_dedup_equals_brute_force(docs_of):
    texts = corpus()[:60] + ["Same short line.\nSame short line.", " Same short line. \nother", *ODD[:4]]
    docs = docs_of(texts)
    got = L.dedup(docs)
    assert got.columns == docs.columns
    rows = {r.doc_id: r for r in got.collect()}
    assert [rows[i].text for i in range(len(texts))] == brute(texts)
    assert all(r.n_chars == len(r.text or "") for r in rows.values())


def test_odd_inputs(docs_of):
    docs = docs_of([*ODD, "same\nx", "same\nx"], [*range(len(ODD)), 99, 99])
    rows = L.dedup(docs).collect()
    assert len(rows) == len(ODD) + 2 and [r.text for r in rows if r.doc_id == 99] == ["same\nx"] * 2
    assert L.dedup(docs_of([])).count() == 0
    nulls = L.dedup(docs_of(["a line", "a line"], [None, 5])).collect()
    assert sorted((r.doc_id is None, r.text) for r in nulls) == [(False, ""), (True, "a line")]


def test_columns_of_any_name_pass(spark):
    names = ["text_hash", "removed", "_doc", "_hash", "line_no", "id", "root", "kept", "row", "head", "line"]
    rows = [(i, "one line that is the same\nother " + "xyzuvw"[i] * 9, *[f"{n}{i}" for n in names]) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, " + ", ".join(f"{n} string" for n in names))
    got = L.dedup(docs).orderBy("doc_id").collect()
    assert [r.text.count("\n") for r in got] == [1, 0, 0, 0] and [tuple(r)[2:] for r in got] == [tuple(r[2:]) for r in rows]
