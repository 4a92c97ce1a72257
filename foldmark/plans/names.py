"""Name search: which entries of a catalogue a written name could mean."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.operators import names
from foldmark.plans.registry import query, rounded, table

# the catalogue are the parts, named by what they are; asked is, for every fiftieth part, its name with a letter lost
_CATALOGUE_SQL = "cat AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name || ' ' || p_type || ' ' || p_brand AS name FROM part)"
_ASKED_SQL = "asked AS (SELECT p_partkey AS query_id, substr(p_name, 1, 2) || substr(p_name, 4) || ' ' || p_brand AS text FROM part WHERE p_partkey % 50 = 0)"


def catalogue(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("id"), F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("name"))


def asked(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.substring("p_name", 1, 2), F.expr("substring(p_name, 4)"), F.lit(" "), F.col("p_brand"))
    return table(spark, d, "part").where("p_partkey % 50 = 0").select(F.col("p_partkey").alias("query_id"), text.alias("text"))


@query(f"""
WITH RECURSIVE {_CATALOGUE_SQL}, {_ASKED_SQL}, w AS (SELECT id, unnest(list_distinct(regexp_extract_all(lower(name), '[a-z0-9]+') || regexp_extract_all(lower(id), '[a-z0-9]+'))) AS word FROM cat),
telling AS (SELECT word FROM w GROUP BY 1 HAVING count(*) <= (SELECT count(*) FROM cat) / 4),
q AS (SELECT *, row_number() OVER (ORDER BY text) AS qk, len(text) AS la FROM (SELECT DISTINCT lower(trim(text)) AS text FROM asked)),
qw AS (SELECT qk, unnest(list_distinct(regexp_extract_all(text, '[a-z0-9]+'))) AS word, len(list_distinct(regexp_extract_all(text, '[a-z0-9]+'))) AS n FROM q),
shared AS (SELECT qk, id, count(*) / any_value(n) AS share FROM qw JOIN telling USING (word) JOIN w USING (word) GROUP BY 1, 2),
t AS (SELECT *, row_number() OVER (ORDER BY text) AS tk, len(text) AS lb FROM (SELECT DISTINCT lower(name) AS text FROM cat UNION SELECT DISTINCT lower(id) FROM cat)),
qc AS (SELECT qk, i, substr(text, i::INT + 1, 1) AS c FROM q, range(la) AS r(i)), tc AS (SELECT tk, j, substr(text, j::INT + 1, 1) AS c FROM t, range(lb) AS r(j)),
hit AS (SELECT qk, tk, i, j FROM qc JOIN tc USING (c)), islands AS (SELECT *, i - row_number() OVER (PARTITION BY qk, tk, i - j ORDER BY i) AS g FROM hit),
run AS MATERIALIZED (SELECT qk, tk, i, j, max(i) OVER (PARTITION BY qk, tk, i - j, g) - i + 1 AS run FROM islands),
region(qk, tk, alo, ahi, blo, bhi, m) AS (SELECT qk, tk, 0::BIGINT, la::BIGINT, 0::BIGINT, lb::BIGINT, 0::BIGINT FROM q, t UNION ALL
  SELECT qk, tk, CASE side WHEN 0 THEN alo ELSE -b.i + b.k END, CASE side WHEN 0 THEN -b.i ELSE ahi END, CASE side WHEN 0 THEN blo ELSE -b.j + b.k END, CASE side WHEN 0 THEN -b.j ELSE bhi END, CASE side WHEN 0 THEN b.k ELSE 0 END
  FROM (SELECT qk, tk, alo, ahi, blo, bhi, max({{'k': least(run, ahi - i, bhi - j), 'i': -i, 'j': -j}}) AS b FROM region JOIN run USING (qk, tk) WHERE i >= alo AND i < ahi AND j >= blo AND j < bhi GROUP BY ALL), (VALUES (0), (1)) AS s(side)),
alike AS (SELECT qk, tk, 2.0 * sum(m) / any_value(la + lb) AS ratio FROM region JOIN q USING (qk) JOIN t USING (tk) GROUP BY 1, 2),
named AS (SELECT id, tk FROM cat JOIN t ON t.text = lower(name) UNION SELECT id, tk FROM cat JOIN t ON t.text = lower(id)),
scores AS (SELECT qk, id, max(score) AS score FROM (SELECT qk, id, ratio AS score FROM alike JOIN named USING (tk) WHERE ratio >= 0.5 UNION ALL SELECT qk, id, share FROM shared) GROUP BY 1, 2),
best AS (SELECT *, row_number() OVER (PARTITION BY qk ORDER BY score DESC, id) AS place FROM scores WHERE score >= 0.5)
SELECT query_id, id, round(score, 6) AS score, CAST(place AS INTEGER) AS place FROM asked JOIN q ON q.text = lower(trim(asked.text)) JOIN best USING (qk) WHERE place <= 5""")
def close_names(spark: SparkSession, d: str) -> DataFrame:
    """The five best entries for each written name, by matching blocks or telling words."""
    return rounded(names.best_names(asked(spark, d), catalogue(spark, d)), "score")


@query(f"""
WITH {_CATALOGUE_SQL}, x AS (SELECT p_partkey AS query_id, CASE p_partkey % 3 WHEN 0 THEN CAST(p_partkey AS VARCHAR) WHEN 1 THEN upper(p_name || ' ' || p_type || ' ' || p_brand) ELSE p_name END AS text FROM part)
SELECT query_id, coalesce((SELECT min(id) FROM cat WHERE id = text), (SELECT min(id) FROM cat WHERE lower(name) = lower(text))) AS id FROM x""")
def resolved_names(spark: SparkSession, d: str) -> DataFrame:
    """Entries by id, else by name in any case; the third kind of text names none."""
    said = F.expr("CASE p_partkey % 3 WHEN 0 THEN CAST(p_partkey AS STRING) WHEN 1 THEN upper(concat_ws(' ', p_name, p_type, p_brand)) ELSE p_name END")
    return names.resolved(table(spark, d, "part").select(F.col("p_partkey").alias("query_id"), said.alias("text")), catalogue(spark, d))
