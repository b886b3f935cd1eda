"""The store of finished pages: every attempt is appended, the newest record of a page wins.

Records are Parquet rows partitioned by pipeline fingerprint and by a hashed bucket of the source, so that resuming one
document reads one folder, whatever the number of documents. Appending is idempotent in effect: a write that failed half-way and
is repeated, or a page that was read again, leaves records that :func:`newest` passes over and :func:`compact` removes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.functions.text import text
from sheafline.operators.state import missing_pages, valid_checkpoint

#: What names a page in the store.
KEYS = ("source_id", "pipeline_fingerprint", "page")
HEADER = ("checkpoint_version", "checkpoint_schema", "pipeline_fingerprint", "source_id", "page_count")
#: Folders that the sources of one fingerprint are dealt over.
BUCKETS = 64
PARTITIONED = ("pipeline_fingerprint", "bucket")


def bucket(source_id: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(text(source_id)), F.lit(buckets)).cast("int")


def page_records(results: DataFrame, ocr_annex: bool = False, thinking_annex: bool = False, diagnostic: bool = False, page: str = "page_num", now: Column | None = None) -> DataFrame:
    """Results of pages as records, with the fields that the modes need: the texts always, the raw answers for the
    transcript annex, the reasonings for theirs, everything for diagnostics. Further columns (header values, keys) pass through; missing texts are ''."""
    of = lambda *names: F.coalesce(*[F.col(c).cast("string") for c in names if c in results.columns], F.lit(""))
    fields = {"normalized_canonical": of("raw_ocr", "canonical", "audit"), "markdown": of("markdown")}
    if ocr_annex or diagnostic:
        fields |= {"raw_response": of("raw_response", "raw_audit"), "raw_ocr": of("raw_ocr", "audit")}
    if thinking_annex or diagnostic:
        fields |= {"ocr_reasoning": of("ocr_reasoning"), "markdown_reasoning": of("markdown_reasoning")}
    if diagnostic:
        fields |= {"markdown_raw_response": of("markdown_raw_response", "raw_markdown"), "sanitized_canonical": of("sanitized_canonical", "raw_ocr", "audit")}
    texts = {"normalized_canonical", "canonical", "raw_ocr", "raw_response", "raw_audit", "audit", "markdown", "ocr_reasoning", "markdown_reasoning", "markdown_raw_response", "raw_markdown", "sanitized_canonical"}
    passed = [c for c in results.columns if c not in texts | {page, "status", "updated_at"}]
    at = now if now is not None else F.current_timestamp()
    return results.select(*passed, F.col(page).cast("int").alias("page"), F.lit("done").alias("status"), at.alias("updated_at"), *[c.alias(k) for k, c in fields.items()])


def restored_results(records: DataFrame) -> DataFrame:
    """Records as results again: texts that a mode left out fall back on the transcript or ''."""
    of = lambda *names: F.coalesce(*[F.col(c) for c in names if c in records.columns], F.lit(""))
    raw = ("raw_ocr", "normalized_canonical", "canonical")
    texts = {c: raw for c in raw} | {c: (c, *raw) for c in ("raw_response", "sanitized_canonical")}
    texts |= {c: (c,) for c in ("ocr_reasoning", "markdown_reasoning", "markdown_raw_response", "markdown")}
    return records.select(*[c for c in records.columns if c not in texts], *[of(*names).alias(k) for k, names in texts.items()])


def newest(records: DataFrame, keys: tuple[str, ...] = KEYS, at: str = "updated_at") -> DataFrame:
    """One record for each page, the newest; equally new ones are ordered by their content, so any repetition gives the same.

    A map-side combined maximum: attempts of a page are reduced before the shuffle. Records without a time are the oldest; null keys are a key of their own.
    """
    comparable = [c for c, kind in records.dtypes if c not in keys and "map<" not in kind and "variant" not in kind]
    order = F.struct(F.col(at).isNotNull(), F.col(at), F.xxhash64(*comparable))
    rest = [c for c in records.columns if c not in keys]
    found = records.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("r"))
    return found.select(*keys, "r.*").select(*records.columns)


def append(records: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Adds records to the store; a repeated call adds nothing that :func:`newest` shows."""
    records.withColumn("bucket", bucket(F.col("source_id"), buckets)).write.mode("append").partitionBy(*PARTITIONED).parquet(path)


def read(spark: SparkSession, path: str, fingerprint: str | None = None, source_id: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The newest record of each page, of one fingerprint and source if given; only their folders are read."""
    rows = spark.read.option("mergeSchema", "true").parquet(path)
    if fingerprint is not None:
        rows = rows.where(F.col("pipeline_fingerprint") == fingerprint)
    if source_id is not None:
        at = spark.range(1).select(bucket(F.lit(source_id), buckets)).first()[0]
        rows = rows.where((F.col("bucket") == at) & (F.col("source_id") == source_id))
    return newest(rows.drop("bucket"))


def superseded(spark: SparkSession, path: str) -> DataFrame:
    """(pipeline_fingerprint, bucket, records, pages) of folders that hold more records than pages."""
    per_page = spark.read.parquet(path).groupBy(*PARTITIONED, "source_id", "page").agg(F.count("*").alias("n"))
    return per_page.groupBy(*PARTITIONED).agg(F.sum("n").alias("records"), F.count("*").alias("pages")).where("records > pages")


def compact(spark: SparkSession, path: str) -> int:
    """Rewrites the folders that hold superseded records with the newest ones, and no other; gives how many those were.

    Dynamic partition overwrite: Spark writes beside the store and swaps the folders in when the job is committed, so a job that fails leaves the store as it was.
    """
    stale = superseded(spark, path).select(*PARTITIONED).cache()
    try:
        n = stale.count()  # at most BUCKETS for each fingerprint
        if n:
            rows = spark.read.option("mergeSchema", "true").parquet(path).join(F.broadcast(stale), list(PARTITIONED), "left_semi")
            kept = newest(rows, (*KEYS, "bucket"))
            kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONED).parquet(path)
        return n
    finally:
        stale.unpersist()


def resume(records: DataFrame, pages: DataFrame, version: int, schema: str, fingerprint: str, need_raw: bool = False) -> tuple[DataFrame, DataFrame]:
    """(finished records, pages still to do): the newest record of each page counts, and only if it may be resumed from.

    ``pages`` holds source_id, page and page_count; a record of another page count is void.
    """
    done = valid_checkpoint(newest(records), version, schema, fingerprint, need_raw=need_raw)
    done = done.join(pages.select("source_id", "page", F.col("page_count").alias("expected")).distinct(), ["source_id", "page"]).where(F.col("page_count") == F.col("expected")).drop("expected")
    return done, missing_pages(pages, done, ["source_id", "page"])


def progress_documents(records: DataFrame) -> DataFrame:
    """(source_id, document): one JSON document for each source with its newest records by page number, in the layout that :func:`sheafline.sources.files.read_checkpoint` reads. Only a source's own pages meet in a task."""
    rows = newest(records)
    body = [c for c in rows.columns if c not in (*HEADER, "page")]
    entry = F.struct(F.col("page"), F.struct(F.col("page").alias("page_num"), *body).alias("r"))
    by = rows.groupBy(*HEADER).agg(F.array_sort(F.collect_list(entry), lambda a, b: F.coalesce(a["page"], F.lit(-1)) - F.coalesce(b["page"], F.lit(-1))).alias("x"), F.max("updated_at").alias("updated_at_utc"))
    pages = F.map_from_entries(F.transform("x", lambda e: F.struct(F.coalesce(e["page"].cast("string"), F.lit("null")).alias("key"), e["r"].alias("value"))))
    return by.select("source_id", F.to_json(F.struct(*HEADER, F.col("updated_at_utc").cast("string").alias("updated_at_utc"), pages.alias("pages"))).alias("document"))
