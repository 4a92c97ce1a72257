"""From raw documents to token files, in five stages that hand on Parquet.

Each stage takes what its predecessor kept and all but the last return the columns of ``documents``:

1. quality: documents that the attention net scores under its threshold go.
2. near-duplicates: of each class the document with the least id stays.
3. decontamination: documents that give away a benchmark item go.
4. mixing: documents are drawn by the budgets of their domain, language and source; one that is drawn in
   two epochs comes twice.
5. token files: the rest is tokenized into Arrow files; the stage returns a row per document, read back.

Defined results: tables may be empty, texts null (scored as empty, a copy of nothing, without tokens);
columns beyond those of ``documents`` are handed on by all stages but the last. SQL cannot express a
trained net, so there is no ``ORACLE_SQL``; the stages are tested against brute force on small tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.llm import decontamination, mixing, near_duplicates, quality, token_files
from foldmark.llm.common import counted, dropped, new_path, recorded, written

#: Share of all tokens that the mixture may hold, and how often a document may be drawn.
MIXTURE_SHARE, MIXTURE_EPOCHS = 1.0, 2


@contextmanager
def _only(spark: SparkSession, *names: str) -> Iterator[None]:
    """Delete the tables written inside when it ends, but for those ``names``: what a stage decides lives on, as its
    result is lazy, and what it needed to decide goes. No stage touches another one's tables."""
    with recorded() as made:
        yield
    dropped(spark, [path for path in made if path.rsplit("/", 1)[-1].rsplit("-", 1)[0] not in names])


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    while name in docs.columns:
        name += "_"
    return name


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    net = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = _free(docs, "__quality")
    return quality.score_quality(docs, net, tuple(docs.columns), score).where(F.col(score) >= quality.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with _only(spark, "twice", "gone"):
        classes = written(near_duplicates.near_duplicates(docs), "members")
        # one text of each class stays, under its least id; ids may be null or repeat, so classes go by their label
        leads = classes.where(F.col("doc_id").eqNullSafe(F.col("class_id")) & ~F.startswith("key", F.lit(near_duplicates.NO_TEXT)))
        twice = written(leads.groupBy("label").agg(F.count("*").alias("n"), F.min("key").alias("first"), F.first("class_id").alias("class_id")).where("n > 1"), "twice")
        others = leads.join(counted(twice.select("label", "first")), "label").where("key <> first")
        gone = classes.where(~F.col("doc_id").eqNullSafe(F.col("class_id"))).select("doc_id", "key").unionByName(others.select("doc_id", "key"))
        gone = written(gone.distinct(), "gone")
    key = F.coalesce(F.md5(F.col("text").cast("binary")), F.concat(F.lit(near_duplicates.NO_TEXT), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    own, who, other = (_free(docs, name) for name in ("__key", "__id", "__gone"))
    left = docs.withColumn(own, key)
    gone = gone.select(F.col("doc_id").alias(who), F.col("key").alias(other))
    same = (F.col(own) == F.col(other)) & F.col("doc_id").eqNullSafe(F.col(who))
    left = left.join(counted(gone), same, "left_anti")
    if not twice.isEmpty():  # rows equal in id and text are one document, too
        again = counted(twice.select(F.col("class_id").alias(who), F.col("first").alias(other)))
        left = left.join(again, same, "left_anti").unionByName(left.join(again, same, "left_semi").dropDuplicates(["doc_id", own]))
    return left.select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # by id and text: ids may be null or repeat, and a clean document must not go for its namesake
    who = F.xxhash64(F.col("doc_id"), F.col("text"))
    bad = decontamination.contaminated(docs.select(who.alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    own, given = _free(docs, "__who"), _free(docs, "__bad")
    bad = written(bad.select(F.col("doc_id").alias(given)).distinct(), "contaminated")
    return docs.withColumn(own, who).join(counted(bad), F.col(own) == F.col(given), "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with _only(spark, "plan"):
        rows = written(mixing.keyed(docs), "keyed")
        plan = mixing.plan(rows, share=MIXTURE_SHARE, max_epochs=MIXTURE_EPOCHS)
    # the same columns beside the whole document, and no count of tokens: the plan holds all sums
    own = F.struct(*(F.col(c) for c in docs.columns)).alias("row")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    filled = docs.select(own, "doc_id", F.coalesce("lang", F.lit("none")).alias("lang"), F.coalesce("source", F.lit("none")).alias("source"), F.md5(text.cast("binary")).alias("digest"))
    leaves = filled.withColumn("domain", mixing.domain_of())
    return mixing.mixed(leaves, plan).select("row.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.read_token_files(token_files.write_token_files(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("near-duplicates", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("source mixing", mix_sources),
    ("token files", tokenize),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = new_path(spark, f"stage-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
