"""Document fingerprints: a homomorphic multiset hash over paragraphs, in DataFrame functions only.

A text is the multiset of its lines that are not blank. Each is hashed to a wide vector of integers and
a document's fingerprint is the sum of the vectors, modulo powers of two:

* ``WIDE`` lanes modulo 2**60, expanded from the line's SHA-256 by seeded hashes: with 64 lanes, 3,840 bits
  of additive hash decide equality, in any order of lines;
* ``LANES`` lanes modulo 2**32: the line's word triples, each as a vector of -1 and +1 from its hash, so
  that the cosine of two documents' lanes, read as signed numbers, estimates that of their counts of triples
  (standard error about 0.09).

Both parts are in the fingerprint in full and :func:`likeness` reads nothing else. As both are sums, a line's
vector can be added or taken away later: :func:`combine`.

Order of documents: the ids are cut at their quantiles, and between these evenly, into ranges of about ``ROWS``
rows; an id with more rows than that, and null ids, are cut by a hash of the text. A range is ordered by one task,
and borrows the first row of the next range. One shuffle moves the texts; all else stays in place.

Defined results: a null text is an empty one; its fingerprint is all zeros, like to another empty one
(1) and to nothing else (0); equal ids are ordered by a hash of the text, null ids come first; repeated
rows are separate documents; a single document is its own next; an empty table gives an empty result; a very
long text is summed in chunks; columns beside ``doc_id`` and ``text``, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldmark.llm.quality import with_text

WIDE, LANES, ROWS, QUANTILES = 64, 120, 500, 256
BROADCAST_ROWS = 200_000
_MASK = (1 << 60) - 1
_WORDS = 2  # 64-bit hashes a triple is spread over; each gives 60 lanes in 20 packed sums of 3 counts
_PACKED = (1 << 40) | (1 << 20) | 1
_CHUNK = 1 << 19  # triples that a packed sum may count


def _units(text: str) -> str:
    """A hash of each word triple within a line; of the whole line where it has fewer words."""
    lines = f"transform(filter(split({text}, '\\n'), p -> trim(p) <> ''), p -> split(p, ' '))"
    triples = "transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2]))"
    return f"flatten(transform({lines}, w -> if(size(w) < 3, array(xxhash64(concat_ws(' ', w))), {triples})))"


def _strong(text: str) -> str:
    return f"transform(filter(split({text}, '\\n'), p -> trim(p) <> ''), p -> sha2(p, 256))"


def _lane_sums(digests: str) -> str:
    return f"aggregate({digests}, array_repeat(0L, {WIDE}), (a, d) -> transform(a, (v, k) -> (v + (xxhash64(k, d) & {_MASK}L)) & {_MASK}L))"


def _signed(x: str) -> str:
    """``x`` modulo 2**32, as a signed number."""
    return f"((({x}) + 2147483648L) & 4294967295L) - 2147483648L"


def vectors(texts: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """``keys``, ``strong`` and ``lanes`` of each row; ``keys`` tell the rows apart."""
    rows = texts.select(*keys, F.expr(_strong(text)).alias("digests"), F.expr(_units(text)).alias("units"))
    rows = rows.select(*keys, F.expr(_lane_sums("digests")).alias("strong"), "units")
    rows = rows.select(*keys, "strong", F.posexplode_outer("units").alias("at", "h0"))
    rows = rows.withColumn("chunk", F.expr(f"coalesce(at, 0) div {_CHUNK}")).withColumn("h1", F.expr("if(h0 IS NULL, NULL, xxhash64(h0, 1L))"))
    sums = [F.expr(f"coalesce(sum(shiftrightunsigned(h{k}, {s}) & {_PACKED}L), 0L)").alias(f"s{k}_{s}") for k in range(_WORDS) for s in range(20)]
    packed = rows.groupBy(*keys, "strong", "chunk").agg(F.count("h0").alias("n"), *sums)
    columns = ", ".join(f"s{k}_{s}" for k in range(_WORDS) for s in range(20))
    # a triple adds 1 or -1 to each lane: twice the ones less all
    lanes = f"transform(sequence(0, {LANES - 1}), j -> 2 * (shiftrightunsigned(packed[j div 3], 20 * (j % 3)) & 1048575L) - n)"
    unpacked = packed.select(*keys, "strong", "n", F.expr(f"array({columns})").alias("packed")).select(*keys, "strong", F.expr(lanes).alias("lanes"))
    summed = unpacked.groupBy(*keys, "strong").agg(F.collect_list("lanes").alias("parts"))
    total = "aggregate(slice(parts, 2, size(parts)), parts[0], (a, x) -> zip_with(a, x, (p, q) -> p + q))"
    return summed.select(*keys, "strong", F.expr(f"transform({total}, x -> {_signed('x')})").alias("lanes"))


def text_of(strong: str, lanes: str) -> Column:
    """The fingerprint as hexadecimal digits."""
    return F.expr(f"concat(array_join(transform({strong}, x -> lpad(lower(hex(x)), 15, '0')), ''), array_join(transform({lanes}, x -> lpad(lower(hex(x & 4294967295L)), 8, '0')), ''))")


def likeness(a: str, b: str) -> Column:
    """1 for equal fingerprints, else the cosine of the lanes where it is positive. ``a`` and ``b`` have ``strong`` and ``lanes``."""
    dot = lambda x, y: f"aggregate(zip_with({x}.lanes, {y}.lanes, (p, q) -> cast(p AS double) * q), 0D, (s, v) -> s + v)"
    return F.expr(
        f"CASE WHEN {a}.strong = {b}.strong THEN 1D ELSE least(1D, greatest(0D, coalesce(try_divide({dot(a, b)}, sqrt({dot(a, a)}) * sqrt({dot(b, b)})), 0D))) END"
    )


def combine(a: str, b: str, sign: int = 1) -> tuple[Column, Column]:
    """``strong`` and ``lanes`` after the lines of ``b`` joined (1) or left (-1) those of ``a``."""
    op = "+" if sign > 0 else "-"
    return F.expr(f"zip_with({a}.strong, {b}.strong, (p, q) -> (p {op} q) & {_MASK}L)"), F.expr(f"zip_with({a}.lanes, {b}.lanes, (p, q) -> {_signed(f'p {op} q')})")


def _decided(column: str, bounds: list[int], leaves: list[str]) -> str:
    """SQL for the leaf of the range that ``column`` lies in; ``bounds`` are the first values of all ranges but the first."""
    if not bounds:
        return leaves[0]
    mid = len(bounds) // 2
    low, high = _decided(column, bounds[:mid], leaves[: mid + 1]), _decided(column, bounds[mid + 1 :], leaves[mid + 1 :])
    return f"if({column} < {_long(bounds[mid])}, {low}, {high})"


def _long(x: int) -> str:
    return f"{x}L" if x > -(2**63) else "(-9223372036854775807L - 1L)"


def range_of(rows: DataFrame, per_range: int = ROWS) -> tuple[str, int]:
    """SQL for the number of the range of a row (doc_id, tie), ascending in both, and how many ranges there may be."""
    quantiles = rows.where("doc_id IS NOT NULL").agg(F.percentile_approx("doc_id", [k / QUANTILES for k in range(QUANTILES + 1)], 10_000)).first()[0] or []
    often = {v for v, w in zip(quantiles, quantiles[1:], strict=False) if v == w}
    bounds = sorted({*quantiles[1:], *(v + 1 for v in often if v < 2**63 - 1)})
    part = f"if(doc_id IS NULL, -1, {_decided('doc_id', bounds, [str(k) for k in range(len(bounds) + 1)])})"
    # at most two rows for each quantile
    sizes = {r.part: r for r in rows.groupBy(F.expr(part).alias("part")).agg(F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).collect()}
    leaves, before = [], 0
    for k in range(-1, len(bounds) + 1):
        own = sizes.get(k)
        many = max(1, own.n // per_range) if own else 1
        if many == 1:
            leaves.append(f"{before}L")
        elif own.low == own.high:  # one id, or none
            leaves.append(f"({before}L + ((shiftright(tie, 32) + 2147483648L) * {many}L) div 4294967296L)")
        else:
            width = float(own.high) - float(own.low) + 1
            leaves.append(f"({before}L + least({many - 1}L, bigint(floor((double(doc_id) - {float(own.low)!r}D) / {width!r}D * {many}D))))")
        before += many
    return f"if(doc_id IS NULL, {leaves[0]}, {_decided('doc_id', bounds, leaves[1:])})", before


def with_next(docs: DataFrame) -> DataFrame:
    """``bucket, rn, borrowed, doc_id, text, next_text``: each document beside the next one's text.

    A borrowed row is the first of the following range; it is there to be somebody's next.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    bucket, ranges = range_of(rows)
    rows = rows.withColumn("bucket", F.expr(bucket))
    firsts = rows.groupBy("bucket").agg(F.min(F.struct("doc_id", "tie")).alias("f"))
    by_range = Window.orderBy("bucket")  # a row a range, not a row a document
    everywhere = by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    borrow = firsts.select(
        F.coalesce(F.lag("bucket").over(by_range), F.last("bucket").over(everywhere)).alias("to"), F.col("f.doc_id").alias("b_id"), F.col("f.tie").alias("b_tie"), F.col("bucket").alias("b_bucket")
    )
    if ranges <= BROADCAST_ROWS:  # known before: a row of 32 bytes for each range
        borrow = F.broadcast(borrow)
    lent = rows.join(borrow, (rows.bucket == F.col("b_bucket")) & rows.doc_id.eqNullSafe(F.col("b_id")) & (rows.tie == F.col("b_tie")))
    lent = lent.select("doc_id", "text", "tie", F.col("to").alias("bucket"), F.lit(True).alias("borrowed"))
    order = Window.partitionBy("bucket").orderBy("borrowed", "doc_id", "tie")
    return (
        rows.select("doc_id", "text", "tie", "bucket", F.lit(False).alias("borrowed"))
        .unionByName(lent)
        .select("bucket", F.row_number().over(order).alias("rn"), "borrowed", "doc_id", "text", F.lead("text").over(order).alias("next_text"))
    )


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(with_text(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    rows = rows.withColumn("edited", F.expr("if(borrowed, NULL, concat(substring(text, 1, int(n_chars - n_chars div 2)), substring(next_text, 1, int(n_chars div 2))))"))
    rows = rows.select("bucket", "rn", "borrowed", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.posexplode(F.array("text", "edited")).alias("tag", "t")).where("t IS NOT NULL")
    each = vectors(rows, "t", ["bucket", "rn", "borrowed", "doc_id", "n_chars", "edited_sha256", "tag"])
    order = Window.partitionBy("bucket").orderBy("rn", "tag")
    each = each.withColumn("v", F.struct("strong", "lanes"))
    # a document's two rows are neighbours, and behind them stands the next one's text
    each = each.withColumn("e", F.lead("v", 1).over(order)).withColumn("x", F.lead("v", 2).over(order))
    return each.where("tag = 0 AND NOT borrowed").select(
        "doc_id", "n_chars", "edited_sha256", text_of("strong", "lanes").alias("fingerprint"), text_of("e.strong", "e.lanes").alias("edited_fingerprint"),
        likeness("v", "e").alias("near_edited"), likeness("v", "x").alias("near_next"),
    )
