"""Near copies: components of SimHash links and of exact Jaccard similarity over word shingles.

Two texts are near copies if the sets of their 5-word shingles have a Jaccard similarity of at
least 4/5 (words as in simhash.py; a text of five words or fewer is one shingle), or if op9's
SimHash links them. No radius of 64 bits is sure to hold every pair of that similarity, and
blocks of the width that ten bits or more leave are too short to divide a table, so the pairs come
from prefixes of the sets, which are exact: with all shingles in one order, two sets of that
similarity share a shingle among the first n - ceil(4 n / 5) + 1 of each. Any order is right;
shingles that are common in a sample of the texts come last, so prefixes hold rare ones.

Equal sets are one node. Sets that share a prefix shingle are first paired with the smallest of
them, then all those that are not yet in one component. Before the exact test a pair must fit in
size and in parities of the hashes, first of 512 bits, then of twice the shingles or more: sets
differ in at least as many shingles as parities in bits, and may in (|A| + |B|) / 9 only. No pair is
lost by either, and whole sets are shipped for few pairs that are not near copies.

Defined results: texts without words are copies of each other; rows without an id stay; rows that
share an id are different documents if their texts differ, and one if not.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.llm import simhash
from tapeworks.llm.common import components, cut

SHINGLE = 5
#: Texts whose shingles are counted to put common ones last, and how many of these are broadcast.
SAMPLE = 5000
COMMON = 50_000
_PARITY = 512
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """Sorted different hashes of a text's shingles."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 7)], dtype=np.uint64)
    codes = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    n = len(words) - SHINGLE + 1
    mixed = np.zeros(n, dtype=np.uint64)
    for i in range(SHINGLE):
        mixed = (mixed ^ codes[i : i + n]) * _ODD[i]
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def parity(found: np.ndarray) -> np.ndarray:
    """Bytes of the parities of hashes by their low bits, of a width that is a power of two."""
    width = max(_PARITY, 1 << (2 * len(found)).bit_length())
    return np.packbits((np.bincount((found % np.uint64(width)).astype(np.int64), minlength=width) & 1).astype(np.uint8))


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    """Parities of a smaller width, in ``size`` bytes."""
    return bits if len(bits) == size else np.bitwise_xor.reduce(bits.reshape(-1, size), axis=0)


def prefix(found: np.ndarray, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first n - ceil(4 n / 5) + 1 shingles, common ones last."""
    n = len(found)
    if not n:
        return found
    ranks = np.zeros(n, dtype=np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        ranks = np.where(common[at] == found, rank[at], 0)
    return found[np.lexsort((found, ranks))[: n - -(-4 * n // 5) + 1]]


def _common(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(sorted shingles, their counts) that several texts of a sample hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update(shingles(text.as_py()).view(np.int64).tolist())
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["h", "n"])

    share = min(1.0, SAMPLE / max(1, docs.count()))
    counted = docs.select("text").sample(share, 1).mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
    rows = counted.where("n >= 3").orderBy(F.desc("n"), "h").limit(COMMON).collect()
    found, n = np.array([r["h"] for r in rows], dtype=np.int64).view(np.uint64), np.array([r["n"] for r in rows], dtype=np.int64)
    order = np.argsort(found)
    return found[order], n[order]


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp, node, size, parity, wide, prefix) of every row; node names the set."""
    common = docs.sparkSession.sparkContext.broadcast(_common(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            rows = []
            for text in batch.column(2).to_pylist():
                found = shingles(text)
                wide = parity(found)
                node = np.uint64(xxhash.xxh64_intdigest(found.tobytes())).astype(np.int64)
                rows.append((np.uint64(simhash.fingerprint(text)).astype(np.int64), node, len(found), fold(wide, _PARITY // 8).tobytes(), wide.tobytes(), prefix(found, *common.value).view(np.int64)))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], names=["doc_id", "text_hash", "fp", "node", "size", "parity", "wide", "prefix"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash bigint, fp bigint, node bigint, size bigint, parity binary, wide binary, prefix array<bigint>")


def _paired(nodes: np.ndarray, sizes: np.ndarray, parities: np.ndarray, roots: np.ndarray, star: bool) -> list[np.ndarray]:
    """Pairs of one signature that sizes and parities allow: with the first (star), or of different roots."""
    out = []
    order = np.argsort(nodes) if star else np.argsort(sizes, kind="stable")
    nodes, sizes, parities, roots = nodes[order], sizes[order], parities[order], roots[order]
    if not star and (roots == roots[0]).all():
        return out
    for i in range(1 if star else len(nodes) - 1):
        end = len(nodes) if star else int(np.searchsorted(sizes, 5 * sizes[i] // 4, side="right"))
        rest = slice(i + 1, end)
        differ = np.bitwise_count(parities[rest] ^ parities[i]).sum(axis=1, dtype=np.int64)
        near = (9 * differ <= sizes[rest] + sizes[i]) & (5 * np.minimum(sizes[rest], sizes[i]) >= 4 * np.maximum(sizes[rest], sizes[i])) & (star | (roots[rest] != roots[i]))
        other = nodes[rest][near]
        out.append(np.column_stack([np.minimum(other, nodes[i]), np.maximum(other, nodes[i])]))
    return out


def _candidates(shared: DataFrame, star: bool) -> DataFrame:
    """(a, b) from shared(sig, node, size, parity, root)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def pairs(frame: pd.DataFrame) -> pd.DataFrame:
            keys = frame["sig"].to_numpy()
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            nodes, sizes, roots = (frame[c].to_numpy() for c in ("node", "size", "root"))
            parities = np.frombuffer(b"".join(frame["parity"]), dtype=np.uint64).reshape(len(frame), -1)
            out: list[np.ndarray] = []
            for s, e in zip(starts, np.r_[starts[1:], len(keys)], strict=True):
                if e - s > 1:
                    out += _paired(nodes[s:e], sizes[s:e], parities[s:e], roots[s:e], star)
            both = np.unique(np.concatenate(out), axis=0) if out else np.empty((0, 2), np.int64)
            return pd.DataFrame({"a": both[:, 0], "b": both[:, 1]})

        # rows come sorted by key; the last key of a frame may go on in the next
        for frame in frames:
            if len(frame):
                keys = frame["sig"].to_numpy()
                last = int(np.searchsorted(keys, keys[-1]))
                if last:
                    yield pairs(pd.concat([*held, frame[:last]]))
                    held = []
                elif held and held[-1]["sig"].iloc[-1] != keys[-1]:
                    yield pairs(pd.concat(held))
                    held = []
                held.append(frame[last:])
        if held:
            yield pairs(pd.concat(held))

    return shared.repartition("sig").sortWithinPartitions("sig").mapInPandas(run, "a bigint, b bigint").distinct()


def _fitting(pairs: DataFrame, marked: DataFrame) -> DataFrame:
    """Of pairs(a, b) those that wide parities allow."""
    wide = marked.join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi").groupBy("node").agg(F.min("size").alias("size"), F.min("wide").alias("wide"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for size, x, y in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                n = min(len(x), len(y))
                a, b = fold(np.frombuffer(x, np.uint8), n), fold(np.frombuffer(y, np.uint8), n)
                keep.append(9 * int(np.bitwise_count(a ^ b).sum(dtype=np.int64)) <= size)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    first, second = wide.withColumnsRenamed({"node": "a", "wide": "x", "size": "size_a"}), wide.withColumnsRenamed({"node": "b", "wide": "y", "size": "size_b"})
    both = pairs.join(first, "a").join(second, "b").select("a", "b", (F.col("size_a") + F.col("size_b")).alias("size"), "x", "y")
    return cut(both.mapInArrow(run, "a bigint, b bigint"), "near-fitting")


def _verified(docs: DataFrame, pairs: DataFrame, marked: DataFrame) -> DataFrame:
    """Of pairs(a, b) those whose sets have a similarity of 4/5, as (src, dst)."""
    pairs = _fitting(pairs, marked)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    one_each = cut(marked.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("text_hash").alias("text_hash")), "near-wanted")
    few = one_each.count() <= simhash.BROADCAST_IDS
    texts = docs.select(F.xxhash64("text").alias("text_hash"), "text").join(F.broadcast(one_each) if few else one_each, "text_hash")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["node", "hashes"])

    known = cut(texts.select("node", "text").mapInArrow(sets, "node bigint, hashes binary").dropDuplicates(["node"]), "near-sets")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(5 * both >= 4 * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["src", "dst"]).filter(pa.array(keep, pa.bool_()))

    first, second = known.withColumnsRenamed({"node": "a", "hashes": "x"}), known.withColumnsRenamed({"node": "b", "hashes": "y"})
    return pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y").mapInArrow(exact, "src bigint, dst bigint")


def jaccard_links(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """(src, dst) between nodes: its components are those of all pairs of similarity 4/5 or more."""
    entries = marked.select("node", F.explode("prefix").alias("sig"))
    keys = entries.groupBy("sig").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("sig")
    nodes = marked.groupBy("node").agg(F.min("size").alias("size"), F.min("parity").alias("parity"))
    shared = cut(entries.join(keys, "sig", "left_semi").distinct().join(nodes, "node").select("sig", "node", "size", "parity"), "near-shared")
    stars = cut(_candidates(shared.withColumn("root", F.col("node")), True), "near-stars")
    links = cut(_verified(docs, stars, marked), "near-star-links")
    roots = components(links).withColumnRenamed("id", "node")
    placed = shared.join(roots, "node", "left").select("sig", "node", "size", "parity", F.coalesce("root", "node").alias("root"))
    others = cut(_candidates(placed, False), "near-pairs")
    return links.unionByName(_verified(docs, others, marked))


def keep_one_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, that with the smallest id; all columns stay."""
    marked = cut(sketches(docs), "near-sketches")
    similar = cut(jaccard_links(docs, marked), "near-links")
    of_fp = marked.groupBy("fp").agg(F.min("node").alias("first"))
    of_fp = cut(of_fp, "near-fingerprints")
    linked = simhash.links(of_fp.select("fp"))
    by_bits = linked.join(of_fp.select(F.col("fp").alias("src"), F.col("first").alias("x")), "src").join(of_fp.select(F.col("fp").alias("dst"), F.col("first").alias("y")), "dst").select(F.col("x").alias("src"), F.col("y").alias("dst"))
    same = marked.select("fp", "node").join(of_fp, "fp").where("node <> first").select(F.col("first").alias("src"), F.col("node").alias("dst"))
    roots = cut(components(similar.unionByName(by_bits).unionByName(same)), "near-roots").withColumnRenamed("id", "node")
    rows = marked.where(F.col("doc_id").isNotNull()).join(roots, "node", "left").select("doc_id", "text_hash", F.coalesce("root", "node").alias("root"))
    rows = cut(rows, "near-placed")
    heads = rows.groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("head"))
    gone = cut(rows.join(heads, "root").where((F.col("doc_id") != F.col("head.doc_id")) | (F.col("text_hash") != F.col("head.text_hash"))).select(F.col("doc_id").alias("_near_doc"), F.col("text_hash").alias("_near_hash")).distinct(), "near-copies")
    few = gone.count() <= simhash.BROADCAST_IDS
    match = [docs["doc_id"] == F.col("_near_doc"), F.xxhash64(docs["text"]) == F.col("_near_hash")]
    kept = docs.join(F.broadcast(gone) if few else gone, match, "left_anti")
    # rows that repeat an id and a text are few: only these are brought together, and the first by all their columns stays
    again = cut(rows.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("_near_doc"), F.col("text_hash").alias("_near_hash")), "near-repeats")
    rare = again.count() <= simhash.BROADCAST_IDS
    again = F.broadcast(again) if rare else again
    first = Window.partitionBy("_near_doc", "_near_hash").orderBy(F.to_json(F.struct(*[F.col(f"_near_row.`{c}`") for c in docs.columns if c != "text"])))
    whole = kept.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_near_row"), F.col("doc_id"), F.xxhash64("text").alias("_near_h"))
    repeated = whole.join(again, [F.col("doc_id") == F.col("_near_doc"), F.col("_near_h") == F.col("_near_hash")]).withColumn("_near_n", F.row_number().over(first)).where("_near_n = 1").select("_near_row.*")
    return kept.join(again, match, "left_anti").unionByName(repeated)
