"""Exact substring dedup: remove every byte covered by a 100-byte string that starts earlier.

Suffixes that can matter are found without listing them all. Each 100-byte window keeps the
smallest 32-byte gram hash in it (ties to the right), its anchor; equal windows have equal
anchors at equal places, so only occurrences of one anchor need comparing. An anchor brings
its context, the up to 68 bytes on either side. Occurrences whose whole context equals an
earlier one's are covered at once (first inside a task, so that a hot passage sends one row a
task, then after one shuffle); only the earliest of each context goes on. Anchors are told apart by 64
bits and contexts by 128 more of another hash, so only a collision of both could take bytes that
don't repeat.

Those are sorted by deep-shallow sorting: the suffixes after the anchor, and the reversed
prefixes before it, go through a multikey quicksort over 8-byte characters to a shallow depth
of 16 bytes (all groups partitioned around their pivots in one vectorised pass); groups still tied
there, the ones with long common prefixes, are ordered by blind tries. From both sorted orders
and their common-prefix lengths follow the classes of equal prefixes at every depth; a window that
takes j bytes from the left and 68 - j from the right is equal for two occurrences exactly if both
classes are. All windows of an anchor hold it, so the bytes covered there are one run, from the
leftmost window that starts earlier elsewhere to the rightmost.

An anchor with over ``HOT`` different contexts is not one task's work: each of its windows, at
most 69 a context, is named by a hash of 128 bits, the first of each name is found by an aggregation
that combines before the shuffle, and names that over ``HOT`` rows bear are few and broadcast.

Documents are ordered by id. Rows that repeat id and text are one document, and each gets its
result; different texts under one id (or no id) are ordered by a hash of the text. Defined
results: null and empty texts have no bytes; texts under 100 bytes lose none; a text that
repeats itself is compared with itself, overlaps included; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm.common import cut, table

SPAN = 100
GRAM = 32
_REACH = SPAN - GRAM
_SHALLOW = 16
#: Contexts of one anchor (136 bytes each), and windows of one name, that one task compares: well under a second's work.
#: Beyond it a context costs up to 69 rows, so the bound is no lower than it must be.
HOT = 20_000
BROADCAST_NAMES = 1_000_000
_CHUNK = 1 << 23
#: Bytes of text whose anchors a task combines before it sends them.
_COMBINE = 1 << 25
_LOW = np.uint64((1 << 24) - 1)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_BYTES = np.random.default_rng(20).integers(0, 2**64, 256, dtype=np.uint64)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of every GRAM-byte gram, by doubling."""
    h, factor, n = _BYTES[data], 0x9E3779B97F4A7C15, 1
    while n < GRAM:
        h = h[:-n] * np.uint64(factor) + h[n:]
        factor, n = factor * factor % 2**64, 2 * n
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the anchors of all SPAN-byte windows."""
    positions, hashes = [], []
    for begin in range(0, max(1, len(data) - SPAN + 1), _CHUNK):
        part = data[begin : begin + _CHUNK + SPAN - 1]
        if len(part) < SPAN:
            break
        h = gram_hashes(part)
        least = (h & ~_LOW) | (_LOW - np.arange(len(h), dtype=np.uint64))
        want, have = _REACH + 1, 1
        while 2 * have <= want:
            least, have = np.minimum(least[:-have], least[have:]), 2 * have
        if have < want:
            least = np.minimum(least[: len(least) - (want - have)], least[want - have :])
        at = (_LOW - (np.unique(least) & _LOW)).astype(np.int64)
        positions.append(at + begin)
        hashes.append(h[at])
    if not positions:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(positions), np.concatenate(hashes)


def _pack(pos: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (pos << 14) | (left << 7) | right


def _unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 14, (place >> 7) & 127, place & 127


def _cover(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all windows that hold the anchor."""
    pos, left, right = _unpack(place)
    return pos - left, pos + GRAM + right


def _repeats(anchor: np.ndarray, context: np.ndarray, more: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by anchor, context, doc and place; mask of those that are not their context's first)."""
    order = np.lexsort((place, doc, more, context, anchor))
    return order, _again(anchor[order], context[order], more[order])


def _again(*columns: np.ndarray) -> np.ndarray:
    """Rows equal to the one before in all columns."""
    if not len(columns[0]):
        return np.empty(0, bool)
    return np.r_[False, np.logical_and.reduce([c[1:] == c[:-1] for c in columns])]


def _merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of ranges per document."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    first = np.r_[True, doc[1:] != doc[:-1]]
    # ends made comparable over documents by a number that grows with each
    base = np.cumsum(first).astype(np.int64) * (int(end.max()) + 1)
    far = np.maximum.accumulate(base + end)
    new = np.r_[True, (base + start)[1:] > far[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(doc) - 1]
    return doc[new], start[new], far[last] - base[last]


_ROW = "kind int, anchor bigint, context bigint, more bigint, doc bigint, place bigint"


def _rows(kind: int, *columns: np.ndarray) -> pa.RecordBatch:
    as_long = lambda x: pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64, copy=False))
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), kind, np.int32)), *map(as_long, columns)], names=["kind", "anchor", "context", "more", "doc", "place"])


def _ranges(doc: np.ndarray, place: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of kind 1 for all bytes of all windows at these places, dealt by document and start."""
    d, s, e = _merged(doc, *_cover(place))
    if len(d):
        yield _rows(1, (d * 1_000_003 + s) * 7_919, e, e, d, s)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kind 0: an anchor; kind 1: a covered range (context: its end; place: its start)."""
    import xxhash

    digest = xxhash.xxh3_128_digest
    found: list[tuple[np.ndarray, ...]] = []
    n_bytes = 0

    def flush() -> Iterator[pa.RecordBatch]:
        if not found:
            return
        anchor, context, more, doc, place = (np.concatenate(x) for x in zip(*found, strict=True))
        found.clear()
        order, again = _repeats(anchor, context, more, doc, place)
        gone, first = order[again], order[~again]
        yield from _ranges(doc[gone], place[gone])
        yield _rows(0, *(c[first] for c in (anchor, context, more, doc, place)))

    for batch in batches:
        for doc, text in zip(batch.column(0).to_numpy(zero_copy_only=False), batch.column(1), strict=True):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
            pos, hashes = anchors(np.frombuffer(raw, np.uint8))
            if not len(pos):
                continue
            left, right = np.minimum(pos, _REACH), np.minimum(len(raw) - GRAM - pos, _REACH)
            sides = (left << 7) | right
            context = np.frombuffer(b"".join(digest(raw[s:e], k) for s, e, k in zip((pos - left).tolist(), (pos + GRAM + right).tolist(), sides.tolist(), strict=True)), np.uint64).reshape(-1, 2)
            found.append((hashes, context[:, 0], context[:, 1], np.full(len(pos), doc, np.int64), _pack(pos, left, right)))
            n_bytes += len(raw)
            if n_bytes >= _COMBINE:
                yield from flush()
                n_bytes = 0
    yield from flush()


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by anchor, context, doc, place. Kind 1 passes; kind 2: the first of a context whose anchor
    has others. Of the rows so far only the last two contexts' firsts are held."""
    held: list[np.ndarray] = [np.empty(0, np.int64)] * 5
    known = False  # whether the anchor held has had another context before

    for batch in batches:
        kind = batch.column(0).to_numpy()
        columns = [batch.column(i).to_numpy() for i in range(1, 6)]
        if (ranges := kind == 1).any():
            yield _rows(1, *(c[ranges] for c in columns))
        columns = [np.r_[h, c[~ranges]] for h, c in zip(held, columns, strict=True)]
        if not len(columns[0]):
            continue
        again = _again(*columns[:3])
        if again.any():
            yield from _ranges(columns[3][again], columns[4][again])
        firsts = [c[~again] for c in columns]
        anchor = firsts[0]
        same = anchor[1:] == anchor[:-1]
        several = np.r_[False, same] | np.r_[same, False]
        if known:
            several[0] = True
        # the last context may go on in the next batch, and its anchor may have more
        if several[:-1].any():
            yield _rows(2, *(f[:-1][several[:-1]] for f in firsts))
        held, known = [f[-1:] for f in firsts], bool(several[-1])
    if known:
        yield _rows(2, *held)


class BlindTrie:
    """Orders strings of one length. Inner nodes know only the byte at which they branch; a
    string goes down blindly and is compared once, with the leaf that it meets."""

    def __init__(self, size: int) -> None:
        self.size, self.root, self.leaves = size, None, []

    def insert(self, text: bytes) -> None:
        leaf = ("leaf", text, int.from_bytes(text, "big"))
        if self.root is None:
            self.root = leaf
            return
        node = self.root
        while node[0] != "leaf":
            node = node[2].get(text[node[1]]) or next(iter(node[2].values()))
        differ = node[2] ^ leaf[2]
        if not differ:
            return
        depth = self.size - (differ.bit_length() + 7) // 8
        other = node[1][depth]
        parent, node = None, self.root
        while node[0] != "leaf" and node[1] < depth:
            parent, node = node, node[2][text[node[1]]]
        if node[0] != "leaf" and node[1] == depth:
            node[2][text[depth]] = leaf
            return
        branch = ("branch", depth, {text[depth]: leaf, other: node})
        if parent is None:
            self.root = branch
        else:
            parent[2][text[parent[1]]] = branch

    def __iter__(self) -> Iterator[bytes]:
        todo = [self.root] if self.root else []
        while todo:
            node = todo.pop()
            if node[0] == "leaf":
                yield node[1]
            else:
                todo += [node[2][b] for b in sorted(node[2], reverse=True)]


def multikey_quicksort(group: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, starts, ends): rows by group and by all characters ``words`` (n, depth), and where
    rows are tied. Every pass splits every open segment around a pivot into less, equal and greater;
    the equal part goes on with the next character."""
    n, depths = words.shape
    order, segment = np.arange(n), np.cumsum(np.r_[False, group[1:] != group[:-1]]) if n else np.empty(0, np.int64)
    depth = np.zeros(n, np.int64)
    open_at = np.arange(n)
    ties: list[tuple[np.ndarray, np.ndarray]] = []
    while len(open_at):
        # segments are neighbours: keep those of several rows, put aside those tied to the full depth
        first = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
        sizes = np.diff(np.r_[first, len(segment)])
        done = depth[first] == depths
        tied = done & (sizes > 1)
        ties.append((open_at[first[tied]], open_at[first[tied]] + sizes[tied]))
        go_on = np.repeat(~done & (sizes > 1), sizes)
        open_at, segment, depth = open_at[go_on], segment[go_on], depth[go_on]
        if not len(open_at):
            break
        first = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
        sizes = np.diff(np.r_[first, len(segment)])
        character = words[order[open_at], depth]
        pivot = np.repeat(character[first + sizes // 2], sizes)
        side = (character >= pivot).astype(np.int64) + (character > pivot)
        key = segment * 3 + side
        moved = np.argsort(key, kind="stable")
        order[open_at] = order[open_at][moved]
        segment, depth = key[moved], depth[moved] + (side[moved] == 1)
        segment = np.cumsum(np.r_[False, segment[1:] != segment[:-1]])
    starts, ends = (np.concatenate(x) for x in zip(*ties, strict=True)) if ties else (np.empty(0, np.int64),) * 2
    return order, starts, ends


def deep_shallow_sort(group: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """Order of the rows of ``strings`` (n, width; uint8) within groups given in ascending order."""
    width = strings.shape[1]
    words = strings[:, :_SHALLOW].copy().view(">u8").astype(np.uint64)
    order, starts, ends = multikey_quicksort(group, words)
    rest = np.ascontiguousarray(strings[:, _SHALLOW:])
    for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
        rows = np.sort(order[s:e]).tolist()
        same: dict[bytes, list[int]] = {}
        for r in rows:
            same.setdefault(rest[r].tobytes(), []).append(r)
        trie = BlindTrie(width - _SHALLOW)
        for text in same:
            trie.insert(text)
        order[s:e] = [r for text in trie for r in same[text]]
    return order


def covered(group: np.ndarray, left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(most, least) bytes taken from the left by a window that an earlier row of the group has
    too; most < least where there is none. Rows come by group, earliest first."""
    n = len(group)
    sides = []
    for strings in (left, right):
        order = deep_shallow_sort(group, strings)
        ranked = strings[order]
        differ = ranked[1:] != ranked[:-1]
        common = np.where(differ.any(1), differ.argmax(1), strings.shape[1])
        common[group[order][1:] != group[order][:-1]] = -1
        sides.append((order, np.r_[-1, common] if n else common))

    def classes(side: int, depth: int) -> np.ndarray:
        order, common = sides[side]
        out = np.empty(n, np.int64)
        out[order] = np.cumsum(common < depth)
        return out

    most, least = np.full(n, -1), np.full(n, SPAN)
    for j in range(_REACH + 1):
        fits = np.flatnonzero((n_left >= j) & (n_right >= _REACH - j))
        key = classes(0, j)[fits] * (n + 1) + classes(1, _REACH - j)[fits]
        order = np.argsort(key, kind="stable")
        again = fits[order[1:][key[order][1:] == key[order][:-1]]]
        most[again] = j
        least[again] = np.minimum(least[again], j)
    return most, least


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, doc, place, sides) of the anchors wanted of each packed text."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for doc, packed, wanted, places in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), batch.column(3), strict=True):
            raw = unpack(packed.as_py())
            place = places.values.to_numpy()
            pos, n_left, n_right = _unpack(place)
            sides = [
                raw[p - x : p][::-1].ljust(_REACH, b"\0") + raw[p + GRAM : p + GRAM + y].ljust(_REACH, b"\0") for p, x, y in zip(pos.tolist(), n_left.tolist(), n_right.tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(wanted.values), pa.array(np.full(len(place), doc, np.int64)), pa.array(place), pa.array(sides, pa.binary())], names=["anchor", "doc", "place", "sides"])


_BATCH_ROWS = 200_000


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by anchor, doc, place, at most HOT an anchor: covered ranges (doc, start, end)."""

    def settle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if not rows.num_rows:
            return
        anchor, doc, place = (rows[c].to_numpy() for c in ("anchor", "doc", "place"))
        both = np.frombuffer(b"".join(rows["sides"].to_pylist()), np.uint8).reshape(-1, 2 * _REACH)
        pos, n_left, n_right = _unpack(place)
        group = np.cumsum(np.r_[True, anchor[1:] != anchor[:-1]])
        most, least = covered(group, both[:, :_REACH], both[:, _REACH:], n_left, n_right)
        hit = most >= least
        yield pa.RecordBatch.from_arrays([pa.array(doc[hit]), pa.array((pos - most)[hit]), pa.array((pos - least + SPAN)[hit])], names=["doc", "start", "end"])

    held: list[pa.Table] = []
    n_held = 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        n_held += batch.num_rows
        if n_held < _BATCH_ROWS:
            continue
        rows = pa.concat_tables(held).combine_chunks()
        anchor = rows["anchor"].to_numpy()
        whole = int(np.searchsorted(anchor, anchor[-1]))  # the last anchor may go on
        yield from settle(rows.slice(0, whole))
        held, n_held = [rows.slice(whole)], rows.num_rows - whole
    if held:
        yield from settle(pa.concat_tables(held))


_NAMED = "name bigint, more bigint, doc bigint, place bigint, j int"


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of every context: its name (128 bits), doc, place and bytes from the left."""
    import xxhash

    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            docs, places, js, names = [], [], [], []
            for anchor, doc, place, sides in zip(*(c.to_pylist() for c in part.columns), strict=True):
                n_left, n_right = (place >> 7) & 127, place & 127
                left, right = sides[:_REACH][::-1], sides[_REACH:]
                head = anchor.to_bytes(8, "little", signed=True)
                for j in range(max(0, _REACH - n_right), n_left + 1):
                    names.append(xxhash.xxh3_128_digest(head + left[_REACH - j :] + right[: _REACH - j], j))
                    js.append(j)
                n = max(0, n_left + 1 - max(0, _REACH - n_right))
                docs += [doc] * n
                places += [place] * n
            both = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(docs, pa.int64()), pa.array(places, pa.int64()), pa.array(js, pa.int32())], names=["name", "more", "doc", "place", "j"])


def _resolve_hot(contexts: DataFrame) -> DataFrame:
    """Covered ranges of contexts(anchor, doc, place, sides) of hot anchors, by names of windows."""
    windows = contexts.mapInArrow(_windows, _NAMED)
    firsts = windows.groupBy("name", "more").agg(F.min(F.struct("doc", "place")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = cut(firsts, "window-names")
    common, rare = firsts.where(F.col("n") > HOT), firsts.where(F.col("n") <= HOT)
    few = common.count() <= BROADCAST_NAMES
    named = windows.join(F.broadcast(common) if few else common, ["name", "more"]).unionByName(windows.join(rare, ["name", "more"]))
    later = named.where((F.col("doc") != F.col("first.doc")) | (F.col("place") != F.col("first.place")))
    runs = later.groupBy("doc", "place").agg(F.max("j").alias("most"), F.min("j").alias("least"))
    pos = F.shiftright("place", 14)
    return runs.select("doc", (pos - F.col("most")).alias("start"), (pos - F.col("least") + SPAN).alias("end"))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        out: list[tuple] = []
        for doc, packed, starts, ends in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), batch.column(3), strict=True):
            raw = unpack(packed.as_py())
            if not starts.is_valid or not len(starts.values):
                out.append((doc, len(raw), 0, 0, hashlib.sha256(raw).hexdigest(), raw))
                continue
            s, e = starts.values.to_numpy(), ends.values.to_numpy()
            _, s, e = _merged(np.zeros(len(s), np.int64), s, e)
            kept = b"".join(raw[a:b] for a, b in zip([0, *e.tolist()], [*s.tolist(), len(raw)], strict=True))
            out.append((doc, len(raw), int((e - s).sum()), len(s), hashlib.sha256(kept).hexdigest(), kept))
        doc, *rest = zip(*out, strict=True) if out else [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), *(pa.array(x, k) for x, k in zip(rest, kinds, strict=True))], names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def _digest_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _finish(batches):
        yield batch.select(["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _packed(rows: DataFrame) -> DataFrame:
    """(doc, packed): texts compressed before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([pack((t.as_py() or "").encode("utf-8", "surrogatepass")) for t in batch.column(1)], pa.binary())], names=["doc", "packed"])

    return rows.mapInArrow(run, "doc bigint, packed binary")


def dedup_substrings(docs: DataFrame, with_kept: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the bytes that stay)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    doubled = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col("doc").isNull()).limit(1).count()
    numbers = None
    if doubled:
        # number the documents in order; the numbers grow with it and are kept in a table
        keys = rows.select("doc", F.xxhash64("text").alias("hash")).distinct().orderBy(F.col("doc").asc_nulls_first(), "hash")
        numbers = cut(keys.withColumn("number", F.monotonically_increasing_id()), "document-numbers").withColumnRenamed("doc", "id")
        joined = rows.withColumn("hash", F.xxhash64("text")).withColumnRenamed("hash", "h").join(numbers, [F.col("doc").eqNullSafe(F.col("id")), F.col("h") == F.col("hash")])
        rows = joined.select(F.col("number").alias("doc"), "text").dropDuplicates(["doc"])
    found = rows.mapInArrow(_find, _ROW)
    compared = cut(found.repartition("anchor").sortWithinPartitions("anchor", "context", "more", "doc", "place").mapInArrow(_compare, _ROW), "anchors")
    packed = _packed(rows)  # both joins with it read one shuffle
    several = compared.where("kind = 2").select("anchor", "doc", "place")
    hot = cut(several.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).select("anchor"), "hot-anchors")

    def contexts(wanted: DataFrame) -> DataFrame:
        of_doc = wanted.groupBy("doc").agg(F.collect_list(F.struct("anchor", "place")).alias("w")).select("doc", F.col("w.anchor").alias("wanted"), F.col("w.place").alias("places"))
        return packed.join(of_doc, "doc").select("doc", "packed", "wanted", "places").mapInArrow(_contexts, "anchor bigint, doc bigint, place bigint, sides binary")

    n_hot = hot.count()
    ranges = compared.where("kind = 1").select("doc", F.col("place").alias("start"), F.col("context").alias("end"))
    if n_hot:
        names = F.broadcast(hot) if n_hot <= BROADCAST_NAMES else hot
        ranges = ranges.unionByName(_resolve_hot(cut(contexts(several.join(names, "anchor", "left_semi")), "hot-contexts")))
        several = several.join(names, "anchor", "left_anti")
    resolved = contexts(several).repartition("anchor").sortWithinPartitions("anchor", "doc", "place").mapInArrow(_resolve, "doc bigint, start bigint, end bigint")
    ranges = ranges.unionByName(resolved)
    by_doc = ranges.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("r")).select("doc", F.col("r.start").alias("starts"), F.col("r.end").alias("ends"))
    last = packed.join(by_doc, "doc", "left").select("doc", "packed", "starts", "ends")
    base = "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    result = last.mapInArrow(_finish, base + ", kept binary") if with_kept else last.mapInArrow(_digest_only, base)
    if numbers is None:
        return result.withColumnRenamed("doc", "doc_id")
    again = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("h")).join(numbers, [F.col("doc_id").eqNullSafe(F.col("id")), F.col("h") == F.col("hash")])
    return again.select("doc_id", F.col("number").alias("doc")).join(result, "doc").drop("doc")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents"))
