"""Sources and sinks: documents as binary files, checkpoints as JSON or Parquet, final documents as text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE_STATS = "struct<input_tokens:bigint,output_tokens:bigint,total_tokens:bigint,cached_tokens:bigint,cache_creation_input_tokens:bigint,reasoning_tokens:bigint,image_tokens:bigint,duration_ms:bigint>"
PAGE_QUALITY = "struct<status:string,coverage:string,warnings:array<string>,errors:array<string>>"
RECORD = f"struct<status:string,page_num:int,normalized_canonical:string,canonical:string,markdown:string,raw_response:string,raw_ocr:string,quality:{PAGE_QUALITY},stats:{PAGE_STATS}>"
CHECKPOINT = f"checkpoint_version int, checkpoint_schema string, pipeline_fingerprint string, source_id string, page_count int, updated_at_utc string, pages map<string,{RECORD}>"


def read_documents(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, source_id, size_mb, content) of document files in any store Spark reads; the identity is a content hash."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.concat(F.lit("local-sha256:"), F.sha2("content", 256)).alias("source_id"), (F.col("length") / 1e6).alias("size_mb"), "content")


def with_page_counts(documents: DataFrame, count: Callable[[bytes], int]) -> DataFrame:
    """Adds page_count by a caller's PDF reader (none is bundled); a count below 1 is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("content")
            pages = [count(x) for x in batch.column(at).to_pylist()]
            if min(pages, default=1) < 1:
                raise ValueError("a document has no pages")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pages, pa.int32())], [*batch.schema.names, "page_count"])

    return documents.mapInArrow(run, T.StructType([*documents.schema.fields, T.StructField("page_count", T.IntegerType())]))


def explode_pages(documents: DataFrame) -> DataFrame:
    return documents.withColumn("page", F.explode(F.sequence(F.lit(1), F.col("page_count"))))


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """Checkpoint JSON files as one row for each page record; unreadable files give no rows."""
    raw = spark.read.schema(CHECKPOINT).option("multiLine", "true").json(path).where("pages is not null")
    rows = raw.select("checkpoint_version", "checkpoint_schema", "pipeline_fingerprint", "source_id", "page_count", F.explode("pages").alias("page_key", "r"))
    kept = rows.select("*", "r.*").drop("r")
    return kept.withColumn("normalized_canonical", F.coalesce("normalized_canonical", "canonical")).withColumn("page", F.coalesce("page_num", F.col("page_key").try_cast("int")))


def append_checkpoint(records: DataFrame, path: str) -> None:
    """Adds finished pages to the Parquet store, partitioned so that a resume reads only its own fingerprint."""
    records.write.mode("append").partitionBy("pipeline_fingerprint").parquet(path)


def write_documents(documents: DataFrame, path: str) -> None:
    """One text file tree of final documents; Spark's committer makes each file appear whole."""
    documents.select("document").write.mode("overwrite").text(path, lineSep="\n")
