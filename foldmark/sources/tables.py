"""Tables with declared schemas, keys, hidden columns and invariants; one way in and out.

Every read takes the declared schema. A write checks the key, sorts by it (nulls first), writes beside the
table and then takes its place, so a reader never sees half a table,
though for a moment none: what is read while it is written belongs into a :class:`foldmark.sources.versions.Store`.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    name: str
    schema: str
    key: tuple[str, ...]
    hidden: tuple[str, ...] = ()
    invariants: dict[str, str] = field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromDDL(self.schema)


# fixed values: names and types of the tables that data is exchanged in
TABLES = {
    t.name: t
    for t in (
        Table("customer", "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", ("c_custkey",), ("c_name", "c_acctbal")),
        Table("events", "event_id long, ts timestamp, user_id long, event_type string, value double, props string", ("event_id",), (), {"a type": "event_type IS NOT NULL"}),
        Table("prices", "seed string, date date, instrument_id string, price double, spread_bp double", ("seed", "date", "instrument_id"), (), {"positive": "price > 0"}),
        Table("curves", "seed string, date date, curve_id string, tenor string, level double", ("seed", "date", "curve_id", "tenor")),
        Table("ideas", "pm_id string, trade_idea_id string, instrument_id string, side string, legs array<struct<instrument_id: string, tenor: string, side: string, weight: double>>, entry_date date, exit_date date, own_signal double, conflict boolean, followed_street boolean",
              ("pm_id", "trade_idea_id"), ("own_signal", "conflict", "followed_street"), {"street is set iff in conflict": "(followed_street IS NOT NULL) = coalesce(conflict, false)"}),
        Table("position_days", "pm_id string, date date, trade_idea_id string, pnl_z double, pnl_state string", ("pm_id", "date", "trade_idea_id"), ("pnl_z", "pnl_state"), {"flat iff near zero": "(pnl_state = 'flat') = (abs(pnl_z) < 1e-9)"}),
        Table("rules", "pm_id string, rule_id string, field string, op string, level_num double, level_text string, window long, action string", ("pm_id", "rule_id"), (), {"one level": "level_num IS NULL OR level_text IS NULL"}),
        Table("drift_events", "pm_id string, date date, event string, trait_id string, from_num double, from_text string, to_num double, to_text string", ("pm_id", "date", "trait_id", "event"), (), {"one from": "from_num IS NULL OR from_text IS NULL", "one to": "to_num IS NULL OR to_text IS NULL"}),
        Table("sessions", "session_id string, pm_id string, date date, kind string, trade_idea_ids array<string>, turns array<struct<role: string, text: string>>", ("pm_id", "session_id"), (), {"2 to 8 turns": "size(turns) BETWEEN 2 AND 8"}),
        Table("responses", "probe_id string, pm_id string, response string, latency_ms long", ("pm_id", "probe_id")),
        Table("scores", "probe_id string, pm_id string, scorer string, correct boolean, detail string", ("pm_id", "probe_id", "scorer")),
    )
}


def public(name: str, df: DataFrame) -> DataFrame:
    """``df`` without the columns that a consumer must not see."""
    return df.drop(*TABLES[name].hidden)


def duplicate_keys(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def violations(df: DataFrame, table: Table) -> DataFrame:
    """Rows that break an invariant, with its name; a null outcome counts as broken."""
    checks = [F.when(~F.coalesce(F.expr(e), F.lit(False)), F.lit(n)) for n, e in table.invariants.items()]
    broken = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")
    return df.withColumn("broken", broken).where(F.size("broken") > 0)


def checked(df: DataFrame, table: Table) -> DataFrame:
    extra = set(df.columns) ^ set(table.struct.names)
    if extra:
        raise ValueError(f"{table.name}: columns differ: {sorted(extra)}")
    if twice := duplicate_keys(df, table.key).head(1):
        raise ValueError(f"{table.name}: key is not unique: {twice[0]}")
    if bad := violations(df, table).head(1):
        raise ValueError(f"{table.name}: {bad[0]['broken']} broken: {bad[0]}")
    return df.select(*table.struct.names)


def write(df: DataFrame, table: Table, path: str, kind: str = "parquet") -> str:
    """Check, sort by key, write as ``parquet`` (zstd) or ``json`` lines, then take the table's place."""
    spark = df.sparkSession
    out = checked(df, table).sortWithinPartitions(*table.key) if kind == "parquet" else checked(df, table).repartitionByRange(*table.key).sortWithinPartitions(*table.key)
    staged = f"{path}.staged"
    writer = out.write.mode("overwrite")
    (writer.option("compression", "zstd").parquet if kind == "parquet" else writer.option("ignoreNullFields", "false").json)(staged)
    jvm = spark.sparkContext._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(path)
    fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(target):
        fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"could not move {staged} to {path}")
    return path


def read(spark: SparkSession, table: Table, path: str, kind: str = "parquet") -> DataFrame:
    """The table with its schema, checked. JSON lines fail on a malformed, blank or unknown-field line."""
    if kind == "parquet":
        return checked(spark.read.parquet(path), table)
    lines = spark.read.text(path)
    known = F.array(*(F.lit(n) for n in table.struct.names))
    odd = lines.where((F.trim("value") == "") | (F.size(F.array_except(F.coalesce(F.json_object_keys("value"), F.array(F.lit("?"))), known)) > 0))
    if bad := odd.head(1):
        raise ValueError(f"{table.name}: bad line {bad[0]['value']!r}")
    return checked(spark.read.schema(table.struct).option("mode", "FAILFAST").json(path), table)


def split_mixed(df: DataFrame, column: str) -> DataFrame:
    """A text column of numbers or words as ``<column>_num`` and ``<column>_text``, one of them filled."""
    return df.withColumn(f"{column}_num", F.expr(f"try_cast({column} AS double)")).withColumn(f"{column}_text", F.when(F.col(f"{column}_num").isNull(), F.col(column))).drop(column)


def join_mixed(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(f"{column}_text"), F.col(f"{column}_num").cast("string"))).drop(f"{column}_num", f"{column}_text")


def append_parts(df: DataFrame, part: str, path: str) -> None:
    """Write a folder per ``part``; folders of parts that are not in ``df`` stay as they are."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def pending(wanted: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``wanted`` that have no finished part yet."""
    return wanted.join(done.select(*key).distinct(), key, "left_anti")


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Ratings from CSV: a blank rating is skipped, yes and no are told in any case, with or without a byte-order mark."""
    rows = spark.read.option("header", True).csv(path)
    rows = rows.toDF(*(c.lstrip("\ufeff").strip() for c in rows.columns)).where("trim(coalesce(rating, '')) <> ''")
    return rows.withColumn("rating", F.when(F.lower(F.trim("rating")).isin("yes", "y", "1", "true"), True).when(F.lower(F.trim("rating")).isin("no", "n", "0", "false"), False))


def write_csv(df: DataFrame, path: str) -> str:
    """Rows as CSV with a header, so that :func:`read_csv` gives them back: nulls and empty texts are told apart."""
    df.write.mode("overwrite").option("header", True).option("nullValue", r"\N").option("emptyValue", "").option("quoteAll", True).option("escape", '"').csv(path)
    return path


def read_csv(spark: SparkSession, schema: str, path: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("nullValue", r"\N").option("emptyValue", "").option("escape", '"').option("multiLine", True).option("mode", "FAILFAST").csv(path)


def derived(df: DataFrame, name: str, key: tuple[str, ...], **more) -> Table:
    """A table declared by a frame's own schema."""
    return Table(name, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), key, **more)


def day_arrays(rows: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """``key, first, values``: a series as an array by day from its first one, null where a day has no row; of several
    rows of one day the greatest value counts."""
    rows = rows.where(F.col(day).isNotNull()).groupBy(key, day).agg(F.max(value).alias(value))
    ends = rows.groupBy(key).agg(F.min(day).alias("first"), F.map_from_entries(F.collect_list(F.struct(F.col(day), F.col(value)))).alias("m"), F.max(day).alias("last"))
    return ends.select(key, "first", F.transform(F.sequence("first", "last"), lambda d: F.try_element_at("m", d)).alias("values"))


def day_rows(arrays: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """The rows of :func:`day_arrays` again."""
    out = arrays.select(key, "first", F.posexplode("values").alias("at", value)).where(F.col(value).isNotNull())
    return out.select(key, F.expr("date_add(first, at)").alias(day), value)


def metadata(spark: SparkSession, path: str, entry: dict | None = None) -> dict:
    """Write ``entry`` as a small JSON file beside a table, or read it."""
    if entry is not None:
        spark.createDataFrame([(json.dumps(entry, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return entry
    return json.loads(spark.read.text(path).first()[0])
