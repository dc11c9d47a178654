"""SimHash near-duplicate detection with BK-tree shards.

Fingerprints: text is lower-cased in A-Z, split at ASCII white space, and its word
3-shingles (with repeats) are hashed by XXH64 seed 42; bit b is set if more than half of
the hashes have it. Distinct fingerprints are the nodes, so copies cost one row.

Linking within ``radius`` bits: the 64 bits are four blocks of 16. Two fingerprints within
2 bits agree on at least two blocks, so each fingerprint goes to the six shards named by its
pairs of blocks; any linked pair shares one. Shards of one member are dropped. Each other shard is a
BK-tree (children keyed by Hamming distance to the parent); a query follows only edges within the
radius. As long as the shards' members are few (``BROADCAST_MEMBERS``, counted first), the trees are
built once and broadcast, and every fingerprint is sought in its shards' trees where it lies; beyond
that a set of fingerprints that grows with the corpus is too much to broadcast, and the
shuffle brings each shard's members together. Only edges that join two parts of a shard are emitted
(at most one a member and task), never all pairs.

A shard whose members exceed ``SHARD_LIMIT`` is divided once more: its members also agree
within ``radius`` bits on the other 32 bits, cut into radius + 1 pieces, one of which must be
equal. No link is lost by that.

Defined results: null and empty texts and texts of white space have no words; their fingerprint
is zero and they link as any other. Repeated rows and equal texts share a fingerprint and so a
component. A null doc_id is kept with its fingerprint, and never serves as a component's id
unless it stands alone. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm.common import components, cut, table

SHINGLE = 3
RADIUS = 2
SHARD_LIMIT = 20_000
BROADCAST_IDS = 1_000_000
BROADCAST_MEMBERS = 250_000
_SEED = 42


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of one whole text."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), _SEED)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    counts, n, step = np.zeros(64, dtype=np.int64), len(words) - shingle + 1, 1 << 16
    for at in range(0, n, step):
        part = words[at : min(n, at + step) + shingle - 1]
        hashes = np.fromiter((digest(join(s), _SEED) for s in zip(*(part[i:] for i in range(shingle)), strict=False)), dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"doc_id {kind}, fp bigint")


class BKTree:
    """Integers under Hamming distance; children are keyed by their distance to the parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def within(self, value: int, radius: int) -> list[int]:
        """Indices of stored values at most ``radius`` bits from ``value``."""
        if not self.values:
            return []
        found, todo = [], [0]
        while todo:
            node = todo.pop()
            d = (self.values[node] ^ value).bit_count()
            if d <= radius:
                found.append(node)
            kids = self.children[node]
            if kids:
                todo.extend(kids[e] for e in range(max(1, d - radius), d + radius + 1) if e in kids)
        return found

    def add(self, value: int) -> int:
        new = len(self.values)
        self.values.append(value)
        self.children.append({})
        if new:
            node = 0
            while True:
                d = (self.values[node] ^ value).bit_count()
                below = self.children[node].get(d)
                if below is None:
                    self.children[node][d] = new
                    break
                node = below
        return new


class _Parts:
    """Union-find over numbers."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def top(self, i):
        self.parent.setdefault(i, i)
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i, j) -> bool:
        """Whether i and j were apart."""
        a, b = self.top(i), self.top(j)
        self.parent[b] = a
        return a != b


def _forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning edges of the link graph of distinct ``values`` (uint64)."""
    tree, parts, edges = BKTree(), _Parts(), []
    for value in map(int, values):
        near = tree.within(value, radius)
        new = tree.add(value)
        edges += [(tree.values[other], value) for other in near if parts.join(other, new)]
    return edges


def shard_trees(members: pa.Table) -> dict[int, BKTree]:
    """A tree of each shard, from members (key, fp)."""
    trees: dict[int, BKTree] = {}
    for key, fp in zip(members["key"].to_pylist(), members["fp"].to_pylist(), strict=True):
        trees.setdefault(key, BKTree()).add(fp % (1 << 64))
    return trees


def _sought(shared, radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Edges of each member (key, fp) with what its shard's tree holds within the radius."""
        trees, parts = shared.value, _Parts()
        for batch in batches:
            src, dst = [], []
            for key, fp in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tree, value = trees[key], fp % (1 << 64)
                for other in tree.within(value, radius):
                    if tree.values[other] < value and parts.join((key, value), (key, tree.values[other])):
                        src.append(tree.values[other])
                        dst.append(value)
            both = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (src, dst)]
            yield pa.RecordBatch.from_arrays(both, names=["src", "dst"])

    return run


def _shard_edges(radius: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by key; a key may go over the end of a frame."""
        key, held = None, []

        def close() -> list[tuple[int, int]]:
            values = np.unique(np.concatenate(held)) if held else np.empty(0, np.uint64)
            return _forest(values, radius) if len(values) > 1 else []

        def out(edges: list[tuple[int, int]]) -> pd.DataFrame:
            both = np.array(edges, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pd.DataFrame({"src": both[:, 0], "dst": both[:, 1]})

        for frame in frames:
            if not len(frame):
                continue
            keys, fps = frame["key"].to_numpy(), frame["fp"].to_numpy().view(np.uint64)
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            ends = np.r_[starts[1:], len(keys)]
            edges: list[tuple[int, int]] = []
            if keys[0] != key:
                edges += close()
                held = []
            for s, e in zip(starts[:-1], ends[:-1], strict=True):
                if held:
                    held.append(fps[s:e])
                    edges += close()
                    held = []
                elif e - s > 1:
                    edges += _forest(np.unique(fps[s:e]), radius)
            held.append(fps[starts[-1] :])
            key = keys[-1]
            if edges:
                yield out(edges)
        if edges := close():
            yield out(edges)

    return run


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (src, dst) between distinct fingerprints ``fp`` within ``radius`` <= 2 bits: a
    spanning forest of every shard, whose components are those of all links."""
    if not 0 <= radius <= 2:
        raise ValueError("four blocks by pairs find links of at most 2 bits")
    block = [F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    pairs = list(combinations(range(4), 2))
    keys = F.array(*[F.xxhash64(F.lit(n), block[i], block[j]) for n, (i, j) in enumerate(pairs)])
    keyed = fps.select("fp", F.posexplode(keys).alias("table", "key"))
    crowded = cut(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SHARD_LIMIT).select("key"), "crowded")
    if crowded.limit(1).count():
        rest = F.lit(0).cast("long")
        for n, (i, j) in enumerate(pairs):
            k, m = (x for x in range(4) if x not in (i, j))
            rest = F.when(F.col("table") == n, F.shiftleft(block[k], 16).bitwiseOR(block[m])).otherwise(rest)
        sub = F.array(*[F.xxhash64("key", F.lit(p), F.shiftright("rest", s).bitwiseAND(F.lit((1 << w) - 1))) for p, (s, w) in enumerate(((0, 11), (11, 11), (22, 10)))])
        full = keyed.withColumn("rest", rest).join(crowded, "key", "left_semi").select("fp", F.explode(sub).alias("key"))
        keyed = keyed.select("fp", "key").join(crowded, "key", "left_anti").select("fp", "key").unionByName(full)
    several = keyed.groupBy("key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi").select("key")
    members = cut(keyed.select("key", "fp").distinct().join(several, "key", "left_semi").select("key", "fp"), "shard-members")
    if members.count() <= BROADCAST_MEMBERS:
        trees = fps.sparkSession.sparkContext.broadcast(shard_trees(members.toArrow()))
        return members.mapInArrow(_sought(trees, radius), "src bigint, dst bigint").distinct()
    return (
        members.repartition("key")
        .sortWithinPartitions("key")
        .mapInPandas(_shard_edges(radius), "src bigint, dst bigint")
        .distinct()
    )


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): component_id is the smallest doc_id reachable."""
    marked = cut(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    groups = components(links(nodes.select("fp"), radius))
    placed = nodes.join(groups, nodes["fp"] == groups["id"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = cut(placed.join(smallest, "root").select("fp", "component_id"), "component-ids")
    # ids grow with the corpus, so they are joined by the shuffle; rows of a hot fingerprint are 16 bytes each, and split
    # where they are too many
    return marked.join(ids, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
