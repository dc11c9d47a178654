"""Line dedup: exact copies and lines within a few edits of another, over all documents.

Exact copies meet under two independent 64-bit hashes of the trimmed line. Near copies come
from a segment-partition edit join. How many edits two lines may differ by follows from the length of
the shorter one, by ``CLASSES``: each class (least length, edits) has its own join. There a line of
length L is cut into edits + 1 segments, and each (L, segment number, segment) is indexed. A line
probes the indexes of its own and up to so many shorter lengths with the few substrings that a
match-aware alignment allows. Two lines within the edits share a signature; none is missed. Candidates
are verified by a banded bit-parallel edit distance (a band of 2 * edits + 1 diagonals in one word),
after their common ends are stripped. Texts stay in their scans: only hashes are shuffled, combined
first on the map side, and only candidates' lines are fetched.

Signatures that more than ``CROWD`` different lines share are not paired at once: what is left
of each line without the shared segment must be within the edits too, so it is segmented
again under the signature, and so on up to ``DIVISIONS`` times. That is exact, and divides a crowd that
shares common parts. Pairs whose parities of signs and of neighbouring signs differ by more than
the edits can cause are dropped inside the join.

Lines form classes of copies: connected components of copies and links. Of each the first line
(smallest doc_id, then line number) stays; the others go. All native DataFrame operations.

Defined results: a null or empty text has no lines and stays as it is; blank lines are never
copies and stay; lines shorter than the first class have no edits to spare and only exact copies;
rows that repeat doc_id and text are one document; ties go to the smaller doc_id; an empty table
gives an empty result; other columns, whatever their names, pass through ``dedup`` untouched, but for
``n_chars``, which is counted anew where lines went.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeworks.llm.common import bound, components, cut, drop_cut, table

#: (least length of the shorter line, edits): about a tenth of it, and at most two.
CLASSES = ((10, 1), (20, 2))
CROWD = 512
DIVISIONS = 3
BROADCAST_IDS = 1_000_000
#: Columns of the distance table between two looks at whether it can still end within the edits.
PIECE = 8


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _ids(line: Column) -> tuple[Column, Column]:
    key = F.trim(line)
    return F.xxhash64(key), F.xxhash64(F.concat(F.lit("~"), key))


def occurrences(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """(doc_id, text_hash, line_no, id, id2[, line]) of every line that is not blank."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(lines_of(F.col("text"))).alias("line_no", "raw")).where(F.trim("raw") != "")
    a, b = _ids(F.col("raw"))
    return rows.select("doc_id", "text_hash", "line_no", a.alias("id"), b.alias("id2"), *([F.trim("raw").alias("line")] if with_text else []))


def _probes(edits: int) -> list[tuple[int, int, int]]:
    """(delta, segment, shift) of every substring that a line looks up: delta is how much shorter
    the indexed line is, shift the substring's place against the segment's. (0, i, 0) are the
    line's own index entries."""
    return [
        (delta, i, shift)
        for delta in range(edits + 1)
        for i in range(edits + 1)
        for shift in range(max(-i, delta - (edits - i)), min(i, delta + (edits - i)) + 1)
    ]


def signatures(lines: DataFrame, edits: int, under: str = "0", keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """Columns ``keep``, sig, own, at, width for every probe of lines(line, ...): own marks index
    entries (which are probes too); at (from 1) and width place the substring in the line.
    ``under`` is SQL for what the signatures belong to. Segments differ by one sign at most."""
    n = edits + 1
    probe = F.array(*[F.struct(F.lit(d).alias("delta"), F.lit(i).alias("i"), F.lit(s).alias("shift")) for d, i, s in _probes(edits)])
    sized = lines.select(*keep, "line", F.char_length("line").alias("size"))
    each = sized.select(*keep, "line", "size", F.explode(probe).alias("p")).select(*keep, "line", "size", "p.*", F.expr("size - p.delta").alias("length"))
    # of the n segments, n - length % n come first and are one sign shorter
    small = each.select("*", F.expr(f"int(length div {n})").alias("small"), F.expr(f"{n} - length % {n}").alias("short"))
    placed = small.select(
        "*", F.expr("small * i + greatest(i - short, 0) + 1 + shift").alias("at"), F.expr("small + int(i >= short)").alias("width")
    ).where("at >= 1 and width > 0 and at + width - 1 <= size")
    return placed.select(*keep, F.expr(f"xxhash64({under}, length, i, substring(line, at, width))").alias("sig"), F.expr("delta = 0 and shift = 0").alias("own"), "at", "width", "line")


def _common(a: Column, b: Column, from_end: bool) -> Column:
    """Length of the common prefix (or suffix), by halving."""
    part = F.right if from_end else F.left
    most = F.least(F.char_length(a), F.char_length(b))
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.greatest(most, F.lit(1)) + 1)).cast("int") + 1)

    def step(s: Column, _: Column) -> Column:
        mid = F.shiftright(s["lo"] + s["hi"] + 1, 1)
        return F.when(s["lo"] >= s["hi"], s).otherwise(bound(mid, lambda m: F.when(part(a, m) == part(b, m), F.struct(m.alias("lo"), s["hi"].alias("hi"))).otherwise(F.struct(s["lo"].alias("lo"), (m - 1).alias("hi")))))

    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), most.alias("hi")), step, lambda s: s["lo"])


def _banded(a: Column, b: Column, m: Column, n: Column, edits: int) -> Column:
    """Edit distance of sign arrays a and b, of m and n signs, if at most ``edits``, else more. Bit k of a
    word stands for the diagonal k - edits; vertical differences are packed into vp and vn."""
    width = 2 * edits + 1
    mask = (1 << width) - 1

    def step(s: Column, j: Column) -> Column:
        sign = F.get(b, j - 1)
        equal = F.lit(0)
        for k in range(width):
            equal = equal.bitwiseOR(F.when(F.get(a, j + (k - edits - 1)) == sign, 1 << k).otherwise(0))

        def with_equal(x: Column) -> Column:
            d0 = ((x.bitwiseAND(s["vp"]) + s["vp"]).bitwiseXOR(s["vp"])).bitwiseOR(x).bitwiseOR(s["vn"]).bitwiseAND(F.lit(mask))
            return bound(d0, with_d0)

        def with_d0(d: Column) -> Column:
            hp = s["vn"].bitwiseOR(F.lit(mask).bitwiseXOR(d.bitwiseOR(s["vp"])))
            return bound(hp, lambda h: with_both(d, h))

        def with_both(d: Column, h: Column) -> Column:
            hn, down = d.bitwiseAND(s["vp"]), F.shiftright(d, 1)
            row = F.call_function("shiftleft", F.lit(1), F.greatest(m - j + edits, F.lit(0)))
            dist = F.when(j <= m - edits, s["dist"] + F.when(d.bitwiseAND(F.lit(1 << (width - 1))) == 0, 1).otherwise(0)).otherwise(
                s["dist"] + F.when(h.bitwiseAND(row) != 0, 1).otherwise(0) - F.when(hn.bitwiseAND(row) != 0, 1).otherwise(0)
            )
            vp = hn.bitwiseOR(F.lit(mask).bitwiseXOR(down.bitwiseOR(h)))
            return F.struct(vp.alias("vp"), down.bitwiseAND(h).alias("vn"), dist.alias("dist"))

        return bound(equal, with_equal)

    # the distance on the band's lowest diagonal can only fall by one a column after its end, so
    # beyond this it is too far: whole pieces are skipped then
    alive = lambda s: s["dist"] <= 2 * edits + n - m
    start = F.struct(F.lit(mask & ~((1 << edits) - 1)).alias("vp"), F.lit(0).alias("vn"), F.lit(edits).alias("dist"))
    piece = lambda s, at: F.when(alive(s), F.aggregate(F.sequence(at, F.least(at + (PIECE - 1), n)), s, step)).otherwise(s)
    return F.aggregate(F.sequence(F.lit(1), n, F.lit(PIECE)), start, piece, lambda s: F.when(alive(s), s["dist"]).otherwise(edits + 1))


def edit_distance(a: Column, b: Column, edits: int) -> Column:
    """Edit distance where it is at most ``edits``, else null. a and b: strings."""

    def inner(x: Column, y: Column) -> Column:
        m, n = F.char_length(x), F.char_length(y)
        # a pattern of at least `edits` signs lets the band start at its own corner
        pad = F.lit("\x00" * edits)
        far = F.abs(m - n) > edits
        signs = F.struct(F.split(F.concat(x, pad), "").alias("x"), F.split(F.concat(y, pad), "").alias("y"))
        d = bound(signs, lambda s: bound(F.struct(s["x"].alias("x"), s["y"].alias("y"), F.size(s["x"]).alias("m"), F.size(s["y"]).alias("n")), lambda t: _banded(t["x"], t["y"], t["m"], t["n"], edits)))
        return F.when(far, None).when(F.least(m, n) == 0, F.greatest(m, n)).otherwise(bound(d, lambda v: F.when(v <= edits, v)))

    head = _common(a, b, False)
    return bound(
        head,
        lambda h: bound(
            F.struct(F.substring(a, h + 1, F.char_length(a)).alias("x"), F.substring(b, h + 1, F.char_length(b)).alias("y")),
            lambda s: bound(_common(s["x"], s["y"], True), lambda t: bound(F.struct(F.left(s["x"], F.char_length(s["x"]) - t).alias("x"), F.left(s["y"], F.char_length(s["y"]) - t).alias("y")), lambda r: inner(r["x"], r["y"]))),
        ),
    )


def _shared(entries: DataFrame) -> DataFrame:
    """Of entries(sig, id, own): those whose signature different lines share."""
    once = entries.groupBy("sig", "id").agg(F.max("own").alias("own"))
    w = Window.partitionBy("sig")
    return once.withColumn("lo", F.min("id").over(w)).withColumn("hi", F.max("id").over(w)).withColumn("indexed", F.max("own").over(w)).where("lo <> hi and indexed").drop("lo", "hi", "indexed")


def _parities(line: Column) -> tuple[Column, Column]:
    """64-bit parities of a line's signs and of its neighbouring pairs of signs, by class. One edit
    flips at most two bits of the first and four of the second."""
    codes = F.transform(F.split(line, ""), lambda c: F.ascii(c))

    def of(numbers: Column) -> Column:
        bit = lambda n: F.call_function("shiftleft", F.lit(1).cast("bigint"), n.bitwiseAND(F.lit(63)))
        return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda s, n: s.bitwiseXOR(bit(n)))

    both = lambda c: F.zip_with(c, F.slice(c, F.lit(2), F.greatest(F.size(c) - 1, F.lit(0))), lambda x, y: F.coalesce(x * 31 + y * 7, F.lit(0)))
    parities = bound(codes, lambda c: F.struct(of(c).alias("one"), of(F.slice(both(c), F.lit(1), F.greatest(F.size(c) - 1, F.lit(0)))).alias("two")))
    return parities["one"], parities["two"]


def _pairs(shared: DataFrame, edits: int) -> DataFrame:
    """Pairs of an index entry and a probe under one signature, as far as their parities allow
    ``edits`` edits. The join itself drops the others: they are never written."""
    index, probe = shared.where("own").selectExpr("sig", "id as a", "one as one_a", "two as two_a"), shared.selectExpr("sig", "id as b", "own", "one as one_b", "two as two_b")
    near = f"a <> b and (not own or a < b) and bit_count(one_a ^ one_b) <= {2 * edits} and bit_count(two_a ^ two_b) <= {4 * edits}"
    return index.join(probe, "sig").where(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, line) of the given line ids; broadcast only as long as they are few."""
    few = ids.count() <= BROADCAST_IDS
    found = occurrences(docs, with_text=True).select("id", "line")
    return cut(found.join(F.broadcast(ids) if few else ids, "id", "left_semi").groupBy("id").agg(F.min("line").alias("line")), "line-texts")


def _class_links(docs: DataFrame, least: int, below: int | None, edits: int) -> DataFrame:
    """(a, b, distance) of different lines within ``edits`` edits, the shorter of length least to below - 1."""
    spark = docs.sparkSession
    size = F.char_length("line")
    inside = (size >= least) if below is None else size.between(least, below - 1 + edits)
    level = occurrences(docs, with_text=True).where(inside).select("id", "line")
    if below is not None:
        # short lines are little text: they are written once, one of each
        level = cut(level.groupBy("id").agg(F.min("line").alias("line")), "short-lines")
    entries = signatures(level, edits).select("id", "sig", "own")
    shared = cut(_shared(entries), "shared")
    spent = [shared]  # tables that nothing reads once the candidates are written
    wanted = shared.select("id").distinct()
    texts = _texts(docs, wanted) if below is None else level.join(wanted, "id", "left_semi")
    one, two = _parities(F.col("line"))
    lines = cut(texts.select("id", "line", one.alias("one"), two.alias("two")), "line-parities")
    marks = lines.select("id", "one", "two")
    candidates, level = None, lines.select("id", "line")
    for division in range(DIVISIONS + 1):
        if division:
            entries = signatures(level, edits, "first", ("id", "first", "first_own")).select("id", "sig", (F.col("first_own") & F.col("own")).alias("own"))
            shared = _shared(entries)
        shared = cut(shared.join(marks, "id"), "shared-marked")
        spent.append(shared)
        crowded = cut(shared.groupBy("sig").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD).select("sig"), "crowded")
        last = division == DIVISIONS or not crowded.limit(1).count()
        if not last:
            # an index entry is cut at its segment, so both roles meet under the signature
            parts = signatures(level, edits) if not division else signatures(level, edits, "first", ("id", "first", "first_own"))
            parts = parts.join(crowded, "sig", "left_semi")
            rest = F.concat(F.left("line", F.col("at") - 1), F.substring(F.col("line"), F.col("at") + F.col("width"), F.char_length("line")))
            own = F.col("own") & F.col("first_own") if division else F.col("own")
            level = cut(parts.select("id", own.alias("first_own"), F.col("sig").alias("first"), rest.alias("line")), "line-rests")
            spent.append(level)
            # what is too short for as many segments stays as it is
            crowded = cut(level.groupBy(F.col("first").alias("sig")).agg(F.min(F.char_length("line")).alias("size")).where(F.col("size") > edits).select("sig"), "divided")
            level = level.join(crowded.withColumnRenamed("sig", "first"), "first", "left_semi")
        found = _pairs(shared if last else shared.join(crowded, "sig", "left_anti"), edits)
        candidates = found if candidates is None else candidates.unionByName(found)
        if last:
            break
    candidates = cut(candidates.distinct(), "line-candidates")
    for written in spent:
        drop_cut(written)
    both = candidates.join(lines.select(F.col("id").alias("a"), F.col("line").alias("line_a")), "a").join(lines.select(F.col("id").alias("b"), F.col("line").alias("line_b")), "b")
    if below is not None:
        both = both.where(F.least(F.char_length("line_a"), F.char_length("line_b")) < below)
    # pairs are few bytes but much work: deal them to all cores
    both = both.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "a", "b")
    return both.select("a", "b", edit_distance(F.col("line_a"), F.col("line_b"), edits).alias("distance")).where(F.col("distance").isNotNull())


def edit_links(docs: DataFrame, classes: tuple[tuple[int, int], ...] = CLASSES) -> DataFrame:
    """(a, b, distance) for all pairs of different lines (by id) within the edits that the shorter
    one's length allows by ``classes``: (least length, edits), both rising."""
    found = None
    for (least, edits), after in zip(classes, [*classes[1:], None], strict=True):
        if not 1 <= edits <= 14 or least <= edits or (after and (after[0] <= least or after[1] < edits)):
            raise ValueError("classes must rise, with edits 1..14 and less than the least length")
        links = _class_links(docs, least, after[0] if after else None, edits)
        found = links if found is None else found.unionByName(links)
    return found


def removed_lines(docs: DataFrame, classes: tuple[tuple[int, int], ...] = CLASSES) -> tuple[DataFrame, DataFrame]:
    """((doc_id, text_hash, removed), links) of docs(doc_id, text). removed: array of (line_no,
    class_doc_id, class_line_no), the lines that go and the first line of the class of each."""
    occ = occurrences(docs)
    links = cut(edit_links(docs, classes), "line-links")
    roots = cut(components(links.select(F.col("a").alias("src"), F.col("b").alias("dst"))), "line-roots")
    exact = occ.groupBy("id", "id2").agg(F.min(F.struct("doc_id", "line_no", "text_hash")).alias("first"), F.count(F.lit(1)).alias("n"))
    placed = exact.join(roots, "id", "left").where((F.col("n") > 1) | F.col("root").isNotNull()).select("id", "id2", "first", "root")
    placed = cut(placed, "line-classes")
    heads = cut(placed.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("first").alias("head")), "line-heads")
    few = heads.count() <= BROADCAST_IDS
    # a component may hold many lines, so its head goes to them and not they to it
    classes_of = placed.join(F.broadcast(heads) if few else heads, "root", "left").select("id", "id2", F.coalesce("head", "first").alias("head"))
    gone = occ.join(classes_of, ["id", "id2"]).where(~((F.col("doc_id").eqNullSafe(F.col("head.doc_id"))) & (F.col("line_no") == F.col("head.line_no")) & (F.col("text_hash") == F.col("head.text_hash"))))
    return gone.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set(F.struct("line_no", F.col("head.doc_id").alias("class_doc_id"), F.col("head.line_no").alias("class_line_no")))).alias("removed")), links


def _joined(rows: DataFrame, removed: DataFrame) -> DataFrame:
    r = removed.withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
    return rows.join(r, [F.col("doc_id").eqNullSafe(F.col("_doc")), F.col("text_hash") == F.col("_hash")], "left").drop("_doc", "_hash")


def dedup(docs: DataFrame, classes: tuple[tuple[int, int], ...] = CLASSES) -> DataFrame:
    """``docs`` with the removed lines taken out of their texts; every row and column stays."""
    removed, _ = removed_lines(docs.select("doc_id", "text"), classes)
    # the row is one value, so that no name of its columns can clash with ours
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id"), F.xxhash64("text").alias("text_hash"))
    numbered = F.transform(lines_of(F.col("row.text")), lambda line, i: F.struct(i.alias("i"), line.alias("line")))
    kept = F.array_join(F.transform(F.filter(numbered, lambda x: ~F.array_contains(F.col("removed.line_no"), x["i"])), lambda x: x["line"]), "\n")
    out = _joined(rows, removed).withColumn("kept", F.when(F.col("removed").isNotNull(), kept))

    def column(field) -> Column:
        old = F.col("row")[field.name]
        if field.name == "text":
            return F.coalesce("kept", old).alias("text")
        if field.name == "n_chars":
            return F.coalesce(F.char_length("kept").cast(field.dataType), old).alias("n_chars")
        return old.alias(field.name)

    return out.select(*map(column, docs.schema))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, lines removed, links of its lines, a digest of the ids kept, and for each
    removed line its class, named by the place of the class's first line."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    removed, links = removed_lines(docs)
    degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("links"))
    linked = occurrences(docs).join(degree, "id").groupBy("doc_id", "text_hash").agg(F.sum("links").alias("n_links")).withColumnsRenamed({"doc_id": "_d", "text_hash": "_h"})
    ids = F.transform(lines_of(F.col("text")), lambda line: F.xxhash64(F.trim(line)))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), ids.alias("ids"))
    kept = F.filter("ids", lambda _, i: ~F.array_contains(F.coalesce("removed.line_no", F.array().cast("array<int>")), i))
    return (
        _joined(rows, removed)
        .join(linked, [F.col("doc_id").eqNullSafe(F.col("_d")), F.col("text_hash") == F.col("_h")], "left")
        .select(
            "doc_id",
            F.size("ids").cast("long").alias("n_lines"),
            F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.sha2(F.array_join(F.transform(kept, lambda x: F.hex(x)), ","), 256).alias("kept_sha256"),
            F.col("removed").alias("membership"),
        )
    )
