"""Secret scan: fixed patterns, and a randomness test battery with false-discovery control.

Base spans come from three patterns (kinds ``assign``, ``access``, ``hex``). The battery then
tests every other token of ``MIN_TOKEN`` or more signs of at least two classes (small letters, capitals,
digits). Its encoding (hex, base32, base64) is inferred from its signs. Two questions are put:

Is it like a random key? Against the encoding's uniform null it takes a chi-squared test of the
alphabet, a runs test of signs above and below the alphabet's middle, and a lag-one serial correlation
test. Fisher's rule combines the p-values: near 0 for text, anywhere in (0, 1) for a random
key. Tokens below ``LEAST_LEVEL`` are not random.

Is it unlike text? Written names repeat few letters often, and change between classes seldom. The null is a
text whose pairs of signs are equal at the rate ``TEXT_PAIRS`` or more, and whose neighbours differ in class at
the rate ``TEXT_CHANGES`` or less; both tests' distributions follow from the token's length alone, so levels
are length-aware and hang on no other token. Fisher's rule combines them, and the procedure of Benjamini and
Hochberg over all tested tokens holds the share of texts among reported tokens to ``FDR``. Levels are
binned, always towards fewer reports, so what meets in one place is a table of bounded size.
Tokens that pass both are reported as kind ``random``.

Defined results: null and empty texts have no spans; repeated rows are scanned each; tokens
overlapping a base span are left to it; an empty table gives an empty result; other columns
are ignored. Spans are kind:start:end in code points, end exclusive, by start, then kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeworks.llm.common import bound, cut, table

#: Fixed by the contract, in the order of their kinds.
ASSIGN = r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]+"
_ASSIGN_HEAD = r"(?i)^(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
ASSIGN_LEAST = 12
#: A maximal run reaches the least length exactly if some match of the open pattern does.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ["assign", "access", "hex", "random"]
#: Tokens that the battery tests.
MIN_TOKEN = 16
TOKEN = rf"[A-Za-z0-9+/_=-]{{{MIN_TOKEN},}}"
FDR = 0.01
#: Tokens below this combined p-value against a random key are not random.
LEAST_LEVEL = 1e-3
#: The null of written text: share of equal pairs of signs, sum of cubed shares, rate of class changes.
TEXT_PAIRS, TEXT_CUBES, TEXT_CHANGES = 0.055, 0.004, 0.25
#: Levels are told apart by these parts of a power of ten, up to this many powers.
_PARTS, _POWERS = 20, 40
#: Matches whose places are summed up together.
_BLOCK = 64
#: (name, signs it may hold, size of the alphabet, pattern for signs above its middle)
ENCODINGS = [("hex", r"^([0-9a-f]+|[0-9A-F]+)$", 16, "[8-9a-fA-F]"), ("base32", r"^[A-Z2-7]+=*$", 32, "[Q-Z2-7]"), ("base64", r"^[A-Za-z0-9+/_-]+=*$", 64, "[g-z0-9+/_-]")]


def _spans(text: Column, pattern: str, kind: str) -> Column:
    """array<struct<start, kind, end, token>> of the pattern's matches; offsets in code points."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    order = F.lit(KINDS.index(kind))
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,token:string>>")

    def step(s: Column, token: Column) -> Column:
        start = s["at"] + F.get(gaps, s["i"])
        end = start + F.length(token)
        span = F.struct(start.alias("start"), order.alias("kind"), end.alias("end"), token.alias("token"))
        return F.struct(end.alias("at"), (s["i"] + 1).alias("i"), F.concat(s["out"], F.array(span)).alias("out"))

    # spans are gathered by blocks, so that no long array is copied for every match
    def block(s: Column, first: Column) -> Column:
        part = F.slice(matches, first, F.lit(_BLOCK))
        found = F.aggregate(part, F.struct(s["at"].alias("at"), s["i"].alias("i"), empty.alias("out")), step)
        return bound(found, lambda f: F.struct(f["at"].alias("at"), f["i"].alias("i"), F.concat(s["blocks"], F.array(f["out"])).alias("blocks")))

    none = F.array().cast("array<array<struct<start:int,kind:int,end:int,token:string>>>")
    state = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), none.alias("blocks"))
    every = F.aggregate(F.sequence(F.lit(1), F.size(matches), F.lit(_BLOCK)), state, block, lambda s: F.flatten(s["blocks"]))
    return F.when(F.size(matches) > 0, every).otherwise(empty)


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal, by a rational approximation good to 1e-7."""

    def tail(v: Column) -> Column:
        x = F.least(F.abs(v), F.lit(37.0))
        t = 1 / (1 + F.lit(0.2316419) * x)
        density = F.exp(-x * x / 2) / F.lit(2.5066282746310002)
        poly = lambda t: t * (F.lit(0.319381530) + t * (F.lit(-0.356563782) + t * (F.lit(1.781477937) + t * (F.lit(-1.821255978) + t * F.lit(1.330274429)))))
        return bound(density * bound(t, poly), lambda p: F.when(v >= 0, p).otherwise(1 - p))

    return bound(z, tail)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def _serial(token: Column, n: Column) -> Column:
    """z of the lag-one correlation of the signs' codes; 9 where all are equal."""

    def of_centred(z: Column) -> Column:
        products = F.zip_with(z, F.slice(z, F.lit(2), F.greatest(F.size(z) - 1, F.lit(1))), lambda a, b: F.coalesce(a * b, F.lit(0.0)))
        power = _sum(F.transform(z, lambda c: c * c))
        return bound(power, lambda p: F.when(p > 0, F.sqrt(n) * (_sum(products) / p + 1 / n)).otherwise(F.lit(9.0)))

    codes = F.transform(F.split(token, ""), lambda c: F.ascii(c).cast("double"))
    return bound(codes, lambda c: bound(_sum(c) / n, lambda mean: bound(F.transform(c, lambda x: x - mean), of_centred)))


def _runs(halves: Column, n: Column) -> Column:
    """z of the number of changes in a text of two signs; 9 where there is only one."""

    def of_ones(ones: Column) -> Column:
        changes = (F.size(F.split(halves, "\x01\x02")) + F.size(F.split(halves, "\x02\x01")) - 2).cast("double")
        mean = 2 * ones * (n - ones) / n
        return bound(mean, lambda m: F.when(m * (m - 1) > 0, (changes - m) / F.sqrt(m * (m - 1) / (n - 1))).otherwise(F.lit(9.0)))

    return bound(n - F.length(F.replace(halves, F.lit("\x01"), F.lit(""))), of_ones)


def battery(token: Column) -> Column:
    """Combined p-value of a token under the uniform null of its inferred encoding."""
    size, high = F.lit(64.0), F.lit(ENCODINGS[-1][3])
    for _, signs, k, above in reversed(ENCODINGS[:-1]):
        size = F.when(token.rlike(signs), F.lit(float(k))).otherwise(size)
        high = F.when(token.rlike(signs), F.lit(above)).otherwise(high)
    n = F.length(token).cast("double")

    def chi(k: Column) -> Column:
        # the sum of squared counts, by taking out one sign at a time
        squares = F.aggregate(F.array_distinct(F.split(token, "")), F.lit(0.0), lambda s, c: s + F.pow(F.length(token) - F.length(F.replace(token, c, F.lit(""))), F.lit(2)))
        return (k * squares / n - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)

    # signs above and below the alphabet's middle, written as 1 and 2
    halves = F.regexp_replace(F.regexp_replace(token, high, F.lit("\x01")), F.lit("[^\x01]"), F.lit("\x02"))
    p_chi = _upper_tail(bound(size, chi))
    p_runs = 2 * _upper_tail(F.abs(bound(halves, lambda h: _runs(h, n))))
    p_serial = 2 * _upper_tail(F.abs(_serial(token, n)))
    log = lambda p: F.ln(F.greatest(p, F.lit(1e-300)))
    x = -2 * (log(p_chi) + log(p_runs) + log(p_serial))
    return bound(x, lambda v: F.least(F.exp(-v / 2) * (1 + v / 2 + v * v / 8), F.lit(1.0)))


def unlike_text(token: Column) -> Column:
    """Combined p-value of a token under the null of written text; small for random keys."""
    n = F.length(token).cast("double")
    pairs = n * (n - 1) / 2
    squares = F.aggregate(F.array_distinct(F.split(token, "")), F.lit(0.0), lambda s, c: s + F.pow(F.length(token) - F.length(F.replace(token, c, F.lit(""))), F.lit(2)))
    spread = pairs * (TEXT_PAIRS - TEXT_PAIRS**2) + n * (n - 1) * (n - 2) * (TEXT_CUBES - TEXT_PAIRS**2)
    few_pairs = (pairs * TEXT_PAIRS - 0.5 - (squares - n) / 2) / F.sqrt(spread)
    # classes as one sign each, then borders between two classes
    classes = F.translate(token, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-", "a" * 26 + "A" * 26 + "0" * 10 + "_" * 5)
    changes = F.length(F.regexp_replace(classes, r"(.)\1*", "x")).cast("double") - 1
    many_changes = (changes - 0.5 - TEXT_CHANGES * (n - 1)) / F.sqrt((n - 1) * TEXT_CHANGES * (1 - TEXT_CHANGES))
    log = lambda z: F.ln(F.greatest(_upper_tail(z), F.lit(1e-300)))
    x = -2 * (log(few_pairs) + log(many_changes))
    return bound(x, lambda v: F.least(F.exp(-v / 2) * (1 + v / 2), F.lit(1.0)))


def borders(scored: DataFrame, fdr: float) -> DataFrame:
    """One row (border): the least bin of ``scored(bin)`` whose tokens are reported, by Benjamini and Hochberg.
    Bin b holds levels up to 10 ** (-b / _PARTS)."""
    counts = scored.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    # at most _PARTS * _POWERS + 1 rows meet here
    smaller = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("rank", F.sum("n").over(smaller)).withColumn("all", F.sum("n").over(Window.partitionBy()))
    level = F.pow(F.lit(10.0), -F.col("bin") / F.lit(float(_PARTS)))
    return ranked.where(level * F.col("all") <= fdr * F.col("rank")).agg(F.min("bin").alias("border")).where("border is not null")


def scan(docs: DataFrame, fdr: float = FDR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    assign = F.filter(_spans(text, ASSIGN, "assign"), lambda s: F.length(F.regexp_replace(s["token"], _ASSIGN_HEAD, "")) >= ASSIGN_LEAST)
    several = lambda t: (t.rlike("[a-z]").cast("int") + t.rlike("[A-Z]").cast("int") + t.rlike("[0-9]").cast("int")) >= 2
    long_tokens = F.filter(_spans(text, TOKEN, "random"), lambda s: several(s["token"]))
    # only spans leave the scan, so the texts are read and matched once
    found = cut(
        rows.select("doc_id", "text_hash", F.array_sort(F.concat(assign, _spans(text, ACCESS, "access"), _spans(text, HEX, "hex"))).alias("base"), long_tokens.alias("long")),
        "spans",
    )
    bare = found.withColumn("long", F.filter("long", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))))
    tokens = bare.select("doc_id", "text_hash", F.explode("long").alias("t"))
    level = F.floor(-F.log10(F.greatest(unlike_text(F.col("t.token")), F.lit(10.0**-_POWERS))) * _PARTS).cast("int")
    scored = cut(tokens.withColumns({"random": battery(F.col("t.token")), "bin": level}), "scores")
    kept = scored.where(F.col("random") >= LEAST_LEVEL).join(F.broadcast(borders(scored, fdr)), F.col("bin") >= F.col("border"))
    extra = kept.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("t")).alias("extra")).withColumnsRenamed({"doc_id": "d", "text_hash": "h"})
    joined = bare.drop("long").join(extra, [F.col("doc_id").eqNullSafe(F.col("d")), F.col("text_hash") == F.col("h")], "left")
    nothing = F.array().cast("array<struct<start:int,kind:int,end:int,token:string>>")
    more = F.coalesce("extra", nothing)

    def line(spans: Column) -> Column:
        name = lambda k: F.get(F.array(*map(F.lit, KINDS)), k)
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    return joined.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(line(F.col("base")), 256).alias("base_sha256"),
        line(F.array_sort(F.concat("base", more))).alias("spans"),
        F.size(more).cast("long").alias("n_random"),
    )


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
