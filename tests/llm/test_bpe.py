import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import ODD
from tapeworks.llm import bpe


@pytest.fixture(scope="module")
def pair():
    path = bpe.default_vocab()
    return bpe.Codec(path), Tokenizer.from_file(path)


def same(pair, text):
    c, t = pair
    want = t.encode(text or "", add_special_tokens=False).ids
    assert c.encode(text) == want and c.decode(want) == t.decode(want, skip_special_tokens=False)


def test_texts(pair):
    for text in [*ODD, "Hello, World! it's 123  naïvé <|endoftext|> a<|startoftext|>b", "ΣΑΣ ΟΔΟΣ İI", "don'T'S'ReX ''ll's", "<|ENDOFTEXT|>", "a b c\x1fd", "é ﬁ", "ab" * 3000, "🙂👩‍👩‍👧"]:
        same(pair, text)


@given(st.text(alphabet=st.characters(exclude_categories=["Cs", "Cn"], max_codepoint=0x2FFF), max_size=60))
@settings(max_examples=200, deadline=None)
def test_any_text(text):
    c, t = _loaded()
    assert c.encode(text) == t.encode(text, add_special_tokens=False).ids


def test_every_code_point(pair):
    """Letters, numbers, spaces and capitals of all of Unicode are the tokenizer's own."""
    c, t = pair
    texts = [f"a{chr(x)}a {chr(x)}{chr(x)} 1{chr(x)}" for x in range(0x110000) if not 0xD800 <= x < 0xE000]
    for at in range(0, len(texts), 50_000):
        part = texts[at : at + 50_000]
        wrong = [s for s, found in zip(part, t.encode_batch(part, add_special_tokens=False), strict=True) if c.encode(s) != found.ids]
        assert not wrong


def _loaded(found=[]):  # noqa: B006
    if not found:
        path = bpe.default_vocab()
        found[:] = bpe.Codec(path), Tokenizer.from_file(path)
    return found


def test_cuts_are_certain(pair):
    c, _ = pair
    rng = random.Random(1)
    for _ in range(300):
        symbols = [c.bytes[rng.randrange(256)] for _ in range(rng.randint(1, 30))]
        symbols[-1] += c.end
        assert tuple(i for part in c.cuts(symbols) for i in c._merge(part)) == c._merge(tuple(symbols))


def test_long_texts_in_pieces(pair, monkeypatch):
    monkeypatch.setattr(bpe, "_PIECE", 50)
    same(pair, "word and, another's one " * 200 + "x" * 400 + " end")


def test_documents(spark, docs_of, pair):
    c, t = pair
    texts = [*ODD, "the same", "the same"]
    docs = docs_of(texts, [None, *range(len(ODD)), len(ODD) - 1])
    for rows in (bpe.digest_documents(docs).collect(), bpe.tokenise(docs).collect()):
        for r, text in zip(rows, texts, strict=True):
            ids = t.encode(text or "", add_special_tokens=False).ids
            assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
            assert r.decoded_sha256 == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert [r.ids for r in bpe.tokenise(docs).collect()] == [r.ids for r in bpe.encode_documents(docs).collect()]
    back = bpe.decode_documents(bpe.encode_documents(docs)).collect()
    assert back[-1].text == "the</w> same</w>"
    assert bpe.digest_documents(docs_of([])).count() == 0
