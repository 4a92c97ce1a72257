"""Transcripts, format checks, overlaps; samples and apportionment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.functions import replies
from foldmark.functions import text as checks
from foldmark.operators import rank, stats
from foldmark.plans.registry import query, rounded, table


@query("""
SELECT conv_id, md5(string_agg(upper(coalesce(role, '')) || ': ' || coalesce(text, ''), chr(10) ORDER BY turn, role, text)) AS transcript_md5, CAST(sum(length(coalesce(text, '')) + length(coalesce(role, '')) + 2) + count(*) - 1 AS BIGINT) AS context_chars FROM conversations GROUP BY 1""")
def transcript_render(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "conversations").groupBy("conv_id").agg(checks.transcript("role", "text", "turn").alias("t"))
    return t.select("conv_id", F.md5(F.col("t").cast("binary")).alias("transcript_md5"), F.char_length("t").cast("long").alias("context_chars"))


@query(r"""
SELECT conv_id, turn, nullif(regexp_extract(text, '^\s*\(?([A-D])(?:\)|[\s.):]|$)', 1), '') AS letter, text LIKE '%\%%' ESCAPE '\' OR regexp_matches(text, '(?i)\bpercent\b') AS has_percent,
  regexp_matches(text, '[0-9]') AS has_digits, len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) AS n_lines FROM conversations""")
def format_checks(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    lines = F.size(F.filter(F.split(t, "\n"), lambda x: F.trim(x) != "")).cast("long")
    return table(spark, d, "conversations").select("conv_id", "turn", replies.option_letter(t).alias("letter"), (t.contains("%") | checks.whole_word(t, "percent")).alias("has_percent"), t.rlike("[0-9]").alias("has_digits"), F.when(t.isNotNull(), lines).alias("n_lines"))


@query(r"""
WITH t AS (SELECT conv_id, turn, trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13)) AS t FROM conversations), l AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: trim(x) <> '') AS l FROM t)
SELECT conv_id, turn, CASE WHEN t = '' THEN 0 ELSE 1 + len(regexp_extract_all(t, '[.!?]\s+')) END AS n_sentences, len(l) >= 2 AND len(list_filter(l, lambda x: NOT regexp_matches(ltrim(x), '^(?:[0-9]+[.)]|[-*•])[ \t]'))) = 0 AS bullets,
  NOT regexp_matches(t, '\n\s*\n') AND len(list_filter(l, lambda x: regexp_matches(ltrim(x), '^(?:[0-9]+[.)]|[-*•])[ \t]') OR len(string_split(x, '|')) > 2 OR regexp_matches(x, '^#{1,6}[ \t]+\S'))) = 0 AS paragraph FROM l""")
def format_kinds(spark: SparkSession, d: str) -> DataFrame:
    """The form of every turn, whoever speaks."""
    t = F.coalesce("text", F.lit(""))
    return table(spark, d, "conversations").select("conv_id", "turn", replies.sentence_count(t).alias("n_sentences"), replies.bullets(t).alias("bullets"), replies.paragraph(t).alias("paragraph"))


@query(r"""
SELECT doc_id, regexp_matches(text, '(?i)\bthe\b') AS has_the, regexp_matches(text, '(?i)\bidiot\b') AS has_idiot, contains(lower(text), 'trash') AS has_stem FROM documents WHERE regexp_matches(text, '(?i)\b(the|idiot)\b') OR contains(lower(text), 'trash')""")
def param_grep(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    out = table(spark, d, "documents").select("doc_id", checks.whole_word(t, "the").alias("has_the"), checks.whole_word(t, "idiot").alias("has_idiot"), F.lower(t).contains("trash").alias("has_stem"))
    return out.where("has_the OR has_idiot OR has_stem")


_GRAMS_SQL = """t AS (SELECT conv_id, string_agg(coalesce(text, ''), ' ' ORDER BY turn, role, text) AS text FROM conversations GROUP BY 1),
w AS (SELECT conv_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}]+'), lambda x: x <> '') AS w FROM t),
g AS (SELECT DISTINCT conv_id, gram FROM (SELECT conv_id, unnest(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) AS gram FROM w WHERE len(w) >= 4))"""


def _grams(spark: SparkSession, d: str) -> DataFrame:
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", F.col("text").alias("x"))))
    t = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(turns, lambda s: F.coalesce(s["x"], F.lit(""))), " ").alias("text"))
    return t.select("conv_id", F.explode(checks.word_windows(F.col("text"), 4)).alias("gram"))


@query(f"""
WITH {_GRAMS_SQL}, c AS (SELECT gram, count(*) AS n FROM g GROUP BY 1)
SELECT conv_id, count(*) AS own, count(CASE WHEN n > 1 THEN 1 END) AS shared, round(count(CASE WHEN n > 1 THEN 1 END) / count(*), 6) AS containment FROM g JOIN c USING (gram) GROUP BY 1""")
def corpus_containment(spark: SparkSession, d: str) -> DataFrame:
    """Share of a transcript's word windows that any other transcript has too."""
    g = _grams(spark, d)
    shared = g.groupBy("gram").agg(F.count("*").alias("n"))
    out = g.join(shared, "gram").groupBy("conv_id").agg(F.count("*").alias("own"), F.count_if(F.col("n") > 1).alias("shared"))
    return rounded(out.withColumn("containment", F.col("shared") / F.col("own")), "containment")


@query(f"""
WITH {_GRAMS_SQL}, q AS (SELECT conv_id AS q, gram FROM g WHERE conv_id % 50 = 0), s AS (SELECT q.q, g.conv_id, count(*) AS n FROM q JOIN g ON q.gram = g.gram AND q.q <> g.conv_id GROUP BY 1, 2), o AS (SELECT q, count(*) AS own FROM q GROUP BY 1)
SELECT o.q AS conv_id, own, coalesce(max(n), 0) AS shared, round(coalesce(max(n), 0) / own, 6) AS nearest FROM o LEFT JOIN s USING (q) GROUP BY 1, 2""")
def nearest_transcript(spark: SparkSession, d: str) -> DataFrame:
    """A search: for the transcripts whose id is divisible by 50 the greatest overlap with any other one.

    Transcripts of one content are one row while windows are joined, so a group of copies is no group of pairs.
    """
    g = _grams(spark, d)
    content = g.groupBy("conv_id").agg(F.count("*").alias("own"), F.sum(F.xxhash64("gram").cast("decimal(38,0)")).alias("content"))
    one = content.groupBy("content").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"), F.first("own").alias("own"))
    asked = content.where("conv_id % 50 = 0").join(one.select("content", F.col("conv_id").alias("rep"), "copies"), "content").select("conv_id", "rep", "own", "copies")
    reps = asked.select(F.col("rep").alias("conv_id")).distinct()
    grams = g.join(one.select("conv_id"), "conv_id", "left_semi")
    q = g.join(reps, "conv_id", "left_semi").select(F.col("conv_id").alias("rep"), "gram")
    n = q.join(grams, "gram").where("rep <> conv_id").groupBy("rep", "conv_id").agg(F.count("*").alias("n")).groupBy("rep").agg(F.max("n").alias("n"))
    out = asked.join(n, "rep", "left").withColumn("shared", F.expr("if(copies > 1, own, coalesce(n, 0L))"))
    return rounded(out.select("conv_id", "own", "shared", (F.col("shared") / F.col("own")).alias("nearest")), "nearest")


@query(f"""
WITH {_GRAMS_SQL}, c AS (SELECT gram, count(*) AS n FROM g GROUP BY 1), x AS (SELECT conv_id, count(CASE WHEN n > 1 THEN 1 END) / count(*) AS s FROM g JOIN c USING (gram) GROUP BY 1)
SELECT count(*) AS n, round(quantile_cont(s, 0.5), 6) AS median, round(quantile_disc(s, 0.9), 6) AS p90, round(max(s), 6) AS most FROM x""")
def overlap_summary(spark: SparkSession, d: str) -> DataFrame:
    """Median, nearest-rank ninetieth percentile and maximum of the overlaps."""
    g = _grams(spark, d)
    shared = g.groupBy("gram").agg(F.count("*").alias("n"))
    s = g.join(shared, "gram").groupBy("conv_id").agg((F.count_if(F.col("n") > 1) / F.count("*")).alias("s"))
    return rounded(stats.quantiles(s, "s", 0.9).withColumnRenamed("at", "p90"), "median", "p90", "most")


@query("""
WITH w AS (SELECT user_id, event_type, count(*) AS w FROM events GROUP BY 1, 2), q AS (SELECT *, 10 * w / sum(w) OVER (PARTITION BY user_id) AS quota FROM w),
r AS (SELECT *, floor(quota) AS whole, 10 - sum(floor(quota)) OVER (PARTITION BY user_id) AS rest, row_number() OVER (PARTITION BY user_id ORDER BY round(quota - floor(quota), 9) DESC, event_type) AS k FROM q)
SELECT user_id, event_type, CAST(whole + CASE WHEN k <= rest THEN 1 ELSE 0 END AS BIGINT) AS share FROM r""")
def largest_remainder(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("w")).withColumn("total", F.lit(10))
    return rank.largest_remainder(w, ["user_id"], "w", "total", "event_type").select("user_id", "event_type", "share")


@query("""SELECT event_type, event_id FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY sha256('blind|' || CAST(event_id AS VARCHAR)), event_id) AS k FROM events) WHERE k <= 20""")
def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    """Twenty rows of each stratum, by a keyed hash."""
    return rank.stratified_sample(table(spark, d, "events"), "event_type", 20, "blind", "event_id").select("event_type", "event_id")


@query("SELECT c_custkey, 'q_' || substr(sha256('key:' || CAST(c_custkey AS VARCHAR)), 1, 16) AS opaque FROM customer")
def opaque_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", rank.opaque_id("key", "c_custkey").alias("opaque"))


@query("""
WITH u AS (SELECT c_custkey, CAST('0x' || substr(sha256('bias|' || CAST(c_custkey AS VARCHAR)), 1, 13) AS BIGINT) / 4503599627370496.0 AS u, CAST('0x' || substr(sha256('size|' || CAST(c_custkey AS VARCHAR)), 1, 13) AS BIGINT) / 4503599627370496.0 AS s FROM customer)
SELECT c_custkey, u < 0.35 AS active, round(exp(ln(10.0) + (ln(500.0) - ln(10.0)) * s), 6) AS book_size FROM u""")
def keyed_sampling(spark: SparkSession, d: str) -> DataFrame:
    """Draws by key: an activation, and a log-uniform size from a stream of its own."""
    c = table(spark, d, "customer").select("c_custkey")
    size = F.exp(F.ln(F.lit(10.0)) + (F.ln(F.lit(500.0)) - F.ln(F.lit(10.0))) * rank.uniform("size", "c_custkey"))
    return rounded(c.select("c_custkey", (rank.uniform("bias", "c_custkey") < 0.35).alias("active"), size.alias("book_size")), "book_size")


@query("""
SELECT n_nationkey, r_regionkey, k AS replicate, CAST(row_number() OVER (ORDER BY k, r_regionkey, n_nationkey) - 1 AS BIGINT) AS idx FROM (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey), (SELECT unnest([0, 1, 2]) AS k)""")
def population_grid(spark: SparkSession, d: str) -> DataFrame:
    """A small grid with replicates outermost and an index that follows from the place."""
    from pyspark.sql import Window

    g = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).withColumn("replicate", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    w = Window.orderBy("replicate", "r_regionkey", "n_nationkey")  # 75 rows: nations are a fixed dimension
    return g.select("n_nationkey", "r_regionkey", "replicate", (F.row_number().over(w) - 1).cast("long").alias("idx"))


@query("""
WITH t AS (SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN coalesce(text, '') END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, CASE WHEN role = 'user' THEN 0 ELSE 1 END ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS heard FROM conversations WHERE role IN ('user', 'assistant'))
SELECT conv_id, turn, md5(coalesce(heard, '')) AS response_md5 FROM t WHERE role = 'assistant'""")
def replay_answers(spark: SparkSession, d: str) -> DataFrame:
    """A baseline system that repeats what it heard last, replayed over every conversation."""
    from foldmark.streaming.replay import LastHeard, replay

    c = table(spark, d, "conversations").withColumnsRenamed({"conv_id": "subject", "turn": "at"})
    probes = c.where("role = 'assistant'").select("subject", "at", F.col("at").cast("string").alias("probe_id"), F.lit("?").alias("question"))
    out = replay(c.where("role = 'user'").select("subject", "at", "text"), probes, LastHeard)
    return out.select(F.col("subject").alias("conv_id"), F.col("probe_id").cast("long").alias("turn"), F.md5(F.col("response").cast("binary")).alias("response_md5"))
