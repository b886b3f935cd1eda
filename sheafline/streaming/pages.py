"""An extension: pages that arrive as files are judged as a stream by the same operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheafline.operators.findings import page_findings

PAGES = "doc_id long, page int, markdown string, audit string"


def arriving_pages(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def stream_findings(pages: DataFrame, out: str, checkpoint: str):
    """Writes findings of new pages as they come; the checkpoint makes each file count once."""
    found = page_findings(pages, audit="audit")
    return found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
