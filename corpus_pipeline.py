"""From raw documents to packed training batches: five stages over whole tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.llm.common import stored
from sheafline.llm.line_dedup import dedup_lines
from sheafline.llm.mixing import mix_sources
from sheafline.llm.near_dedup import near_duplicates
from sheafline.llm.packing import counted, pack
from sheafline.llm.quality import fit, score_quality

#: A document stays if its quality score reaches this.
LEAST_QUALITY = 0.7
#: Columns that the stages work on; all others only pass through.
WORKED_ON = ["doc_id", "text", "lang", "source", "n_chars"]

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keeps_columns(stage: Stage) -> Stage:
    """A stage whose result has the columns of its input, whatever they are called: other columns bear neutral names inside."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        inside = docs.toDF(*(c if c in WORKED_ON else f"_own{i}" for i, c in enumerate(docs.columns)))
        return stage(spark, inside, sf_dir).select(*inside.columns).toDF(*docs.columns)

    return run_stage


@keeps_columns
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbours' votes reject go: those with a score under LEAST_QUALITY.

    Null, empty and wordless texts have the share of label 1 as their score. Repeated rows and equal texts fare alike, very long
    texts are scored whole, rows without an id are scored too. Without labels every document scores 1 and stays.
    An empty table gives no rows.
    """
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, model).where(F.col("score") >= LEAST_QUALITY).select(*docs.columns)


@keeps_columns
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 20 characters or more found in three documents stay in the last one only; every document stays.

    Null texts become empty ones. Rows without an id keep all their lines and count for none; rows that share an id are one
    document to the count. Very long texts are read whole. n_chars, where there, follows the text. An empty table gives no rows.
    """
    out = dedup_lines(docs, least_chars=20, least_docs=3)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


@keeps_columns
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the smallest id, with all its rows.

    Documents without words and rows without an id stay. Ties cannot occur, as ids differ or are one document.
    Very long texts are compared whole. An empty table gives no rows.
    """
    groups = near_duplicates(docs, width=5, percent=80).where("not kept").select("doc_id").distinct()
    return docs.join(groups, "doc_id", "left_anti").select(*docs.columns)


@keeps_columns
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source makes up an equal share of as many rows as there are; a document's copies share its id.

    Null sources are a source of their own. Rows that share an id share their number of copies, whatever the partitioning; null texts, empty and very long ones are repeated like all others. An empty table gives no rows.
    """
    return mix_sources(docs, weights=None).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its exact token count, length bucket and batch (doc_id, source, n_tokens, bucket, padded, rank, batch).

    Null and empty texts have 0 tokens. A text longer than a batch's budget makes a batch of its own. Repeated rows are
    packed each; equal lengths share a bucket. Further columns are left out. An empty table gives no rows.
    """
    return pack(counted(docs.select("doc_id", "source", "text")), length=F.col("n_tokens"), buckets=16, budget=65536).select("doc_id", "source", "n_tokens", "bucket", "padded", "rank", "batch")


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: Sketches, latent vectors and components are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each one's result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
