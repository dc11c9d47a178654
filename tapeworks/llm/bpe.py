"""BPE encoding and decoding with forced-boundary splitting.

A pair of adjacent byte symbols that occurs inside no vocabulary token can never be merged
across, so it marks a certain cut. A word is cut there, its fragments are encoded on their
own (and remembered), and the ids are concatenated. Merging a fragment uses a heap over a
linked list, so even one word of a million letters takes n log n steps.

Before that, as the tokenizer's file says: added tokens are taken out of the raw text, the
rest is brought to NFC and lower case, and words are letters, single digits, runs of other
signs or English contractions. Its last symbol carries the end-of-word mark. There is no
decoder in the file, so decoding joins the tokens' strings by one space.

Texts run through whole, in pieces that end at white space (which no word crosses) so that
memory stays bounded. Defined results: a null text is the empty one; no ids give the digest
of the empty string; repeated rows are encoded each; other columns are ignored; an empty
table gives an empty result. The vocabulary file is read by every worker from ``vocab``, a
parameter; it must be at that path on each node.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm.common import table

#: Unicode White_Space, which splits words and is dropped.
_SPACE = "\t-\r \x85\xa0  -     　"
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_PIECE = 1 << 20
#: Words remembered by a worker, and four times as many as fragments; beyond that it starts anew.
REMEMBERED = 250_000
#: Texts whose ids a worker holds at once.
_ROWS = 256


def default_vocab() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_symbols() -> dict[int, str]:
    """Printable stand-ins for the 256 bytes: printable Latin-1 itself, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


#: Letters and numbers that are newer than the tokenizer's tables (Unicode 16), to which they are other
#: signs. First and last of each range.
_NEWER = (
    "0558-0558 058B-058C 088F-088F 0C5C-0C5C 0CDC-0CDC 208F-208F 209D-209F A7CE-A7CF A7D2-A7D2 A7D4-A7D4 A7DD-A7DD A7E2-A7E2 A7F1-A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 "
    "10ED9-10EEE 11B0A-11B0A 11DB0-11DDB 11DE0-11DE9 11DF1-11DF1 1246F-1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 "
    "191A0-191D2 1B123-1B128 1B168-1B168 1D6A6-1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F "
    "2B81E-2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
).split()
#: Capitals of Unicode 16 and 17, which Python's own tables may lack, and their small letters. Fixed values.
_CAPITALS = {0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B}
_CAPITALS |= {c: c + 32 for c in range(0x10D50, 0x10D66)} | {c: c + 27 for c in range(0x16EA0, 0x16EB9)}
_FIRST_NEWER = chr(min(int(r.partition("-")[0], 16) for r in _NEWER))


def _has_newer(text: str) -> bool:
    """Whether a text may hold signs that need the exact tables; quick for Latin ones."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return max(text) >= _FIRST_NEWER
    return False


@lru_cache(maxsize=1)
def _word_finder():
    """Finds all words of a text."""
    import regex

    newer = "".join(f"\\U{a:0>8}-\\U{b:0>8}" for a, b in (r.split("-") for r in _NEWER))
    whole = regex.compile(rf"{_CONTRACTIONS}|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+").findall
    exact = regex.compile(rf"(?V1){_CONTRACTIONS}|[\p{{L}}--[{newer}]]+|[\p{{N}}--[{newer}]]|(?:[{newer}]|[^{_SPACE}\p{{L}}\p{{N}}])+").findall
    ascii_only = regex.compile(rf"{_CONTRACTIONS}|[a-z]+|[0-9]|[^{_SPACE}a-z0-9]+").findall
    return lambda text: ascii_only(text) if text.isascii() else exact(text) if _has_newer(text) else whole(text)


class _Memo(dict):
    """A dict that computes what is missing, and empties itself when full."""

    def __init__(self, make, most: int) -> None:
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        self[key] = made = self.make(key)
        return made


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str) -> None:
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        top = max([*self.ids.values(), *added.values()], default=-1) + 1
        self.tokens = [""] * top
        for token, i in chain(self.ids.items(), added.items()):
            self.tokens[i] = token
        self.names = [str(i) for i in range(top)]
        self.added = added
        self.ranks = {tuple(m) if isinstance(m, list) else tuple(m.split(" ")): r for r, m in enumerate(model["merges"])}
        self.inner = {pair for token in self.ids for pair in self._pairs(self._symbols(token))}
        self.bytes = _byte_symbols()
        self.find_words = _word_finder()
        self.find_space = regex.compile(f"[{_SPACE}]").search
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")").split if added else lambda t: [t]
        self.fragments = _Memo(self._merge, REMEMBERED // 4)
        self.words = _Memo(self._encode_word, REMEMBERED)

    @staticmethod
    def _pairs(symbols: list[str]) -> zip:
        return zip(symbols, symbols[1:], strict=False)

    def _symbols(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def cuts(self, symbols: list[str]) -> list[tuple[str, ...]]:
        """Fragments of a word between its forced boundaries."""
        out, begin = [], 0
        for at, pair in enumerate(self._pairs(symbols), 1):
            if pair not in self.inner:
                out.append(tuple(symbols[begin:at]))
                begin = at
        out.append(tuple(symbols[begin:]))
        return out

    def _encode_word(self, word: str) -> tuple[int, ...]:
        symbols = [self.bytes[b] for b in word.encode("utf-8", "replace")]
        symbols[-1] += self.end
        return tuple(chain.from_iterable(map(self.fragments.__getitem__, self.cuts(symbols))))

    def _merge(self, symbols: tuple[str, ...]) -> tuple[int, ...]:
        if len(symbols) == 1:
            return (self.ids[symbols[0]],)
        ranks, parts, n = self.ranks, list(symbols), len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[p], i, *p) for i, p in enumerate(self._pairs(parts)) if p in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else n
            if parts[i] != left or j >= n or parts[j] != right:
                continue
            parts[i], parts[j], after[i] = left + right, None, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := ranks.get(pair := (parts[i], parts[after[i]]))) is not None:
                    heapq.heappush(heap, (r, i, *pair))
            if (b := before[i]) >= 0 and (r := ranks.get(pair := (parts[b], parts[i]))) is not None:
                heapq.heappush(heap, (r, b, *pair))
        return tuple(self.ids[p] for p in parts if p is not None)

    def _pieces(self, text: str) -> Iterator[str]:
        while len(text) > _PIECE and (m := self.find_space(text, _PIECE)):
            yield text[: m.start()]
            text = text[m.start() :]
        yield text

    def encode_parts(self, text: str | None) -> Iterator[list[int]]:
        for part in self.split_added(text or ""):
            if part in self.added:
                yield [self.added[part]]
                continue
            for piece in self._pieces(part):
                if not piece.isascii():
                    # lower case sign by sign: no final sigma
                    piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
                    if _has_newer(piece):
                        piece = piece.translate(_CAPITALS)
                yield list(chain.from_iterable(map(self.words.__getitem__, self.find_words(piece.lower()))))

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(self.encode_parts(text)))

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))

    def digests(self, text: str | None, into: list[np.ndarray] | None = None) -> tuple[int, str, str]:
        """(number of ids, digest of the ids, digest of the decoded text); ids are added to ``into``."""
        n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
        for ids in self.encode_parts(text):
            if ids:
                gap = b" " if n else b""
                of_ids.update(gap + " ".join(map(self.names.__getitem__, ids)).encode())
                of_text.update(gap + self.decode(ids).encode())
                n += len(ids)
                if into is not None:
                    into.append(np.array(ids, dtype=np.int32))
        return n, of_ids.hexdigest(), of_text.hexdigest()


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def encode_documents(docs: DataFrame, vocab: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of every text."""
    vocab = vocab or default_vocab()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocab)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.encode(t.as_py()) for t in batch.column(1)], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, ids array<int>")


def decode_documents(encoded: DataFrame, vocab: str | None = None) -> DataFrame:
    """(doc_id, text) of (doc_id, ids)."""
    vocab = vocab or default_vocab()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocab)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.decode(i.as_py() or []) for i in batch.column(1)], pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def digest_documents(docs: DataFrame, vocab: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): one pass, ids never leave the worker."""
    vocab = vocab or default_vocab()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocab)
        for batch in batches:
            n, ids, text = zip(*(c.digests(t.as_py()) for t in batch.column(1)), strict=True) if batch.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(text, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def tokenise(docs: DataFrame, vocab: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256): the ids and their digests, in small batches."""
    vocab = vocab or default_vocab()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocab)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part, found, starts, rows = batch.slice(at, _ROWS), [np.empty(0, np.int32)], [0], []
                for text in part.column(1):
                    rows.append(c.digests(text.as_py(), found))
                    starts.append(starts[-1] + rows[-1][0])
                ids = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(np.concatenate(found)))
                n, of_ids, of_text = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([part.column(0), ids, pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], names=["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"doc_id {kind}, ids array<int>, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_documents(table(spark, sf_dir, "documents"))
