"""Derived corpora: invoice pages, audit transcripts, usage and checkpoint records, rendered from relational tables.

Defects are functions of keys, so that a query's answer can be told from the source tables alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.session import table

#: Tasks of a deal for each split of the scanned table.
DEALT_BY_SPLIT = 8
HEADER = ["REF", "DESIGNATION", "QTE", "P.U. NET HT", "MONTANT HT"]


def comma(value: Column) -> Column:
    """Two decimals with a comma; goes through decimal, so large values get no exponent."""
    return F.translate(value.cast("decimal(18,2)").cast("string"), ".", ",")


def unit_price() -> Column:
    return F.round(F.col("l_extendedprice") / F.col("l_quantity"), 2)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_key, items): the lines of each order with their part names, in a total order."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    items = table(spark, sf_dir, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    item = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", F.col("p_name").alias("name"), unit_price().alias("unit"))
    # dealt by the session's number of partitions: what follows is bound by CPU, so small tables must not be merged into a task or two;
    # by more of them where the table has many splits, so that no task's share grows with it
    splits = table(spark, sf_dir, "lineitem").rdd.getNumPartitions()
    items = items.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), DEALT_BY_SPLIT * splits), "l_orderkey")
    return items.groupBy(F.col("l_orderkey").alias("order_key")).agg(F.sort_array(F.collect_list(item)).alias("items"))


def _row(cells: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))


def invoice_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page, markdown): one page for each order with lines: a line-item table and a totals table."""
    return order_lines(spark, sf_dir).select(F.col("order_key").alias("doc_id"), F.lit(1).alias("page"), _invoice().alias("markdown"))


def invoice_and_audit_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page, markdown, audit): both readings of each order, written side by side from the same lines, so that no join has to bring them together."""
    return order_lines(spark, sf_dir).select(F.col("order_key").alias("doc_id"), F.lit(1).alias("page"), _invoice().alias("markdown"), _audit().alias("audit"))


def _invoice() -> Column:
    """The Markdown of an order's lines."""
    rows = F.transform("items", lambda x: _row(F.array(x["l_partkey"].cast("string"), x["name"], x["l_quantity"].cast("int").cast("string"), comma(x["unit"]), comma(x["l_extendedprice"]))))
    total = F.aggregate("items", F.lit(0).cast("decimal(18,2)"), lambda a, x: (a + x["l_extendedprice"].cast("decimal(18,2)")).cast("decimal(18,2)"))
    head = F.array(F.lit("<!-- PAGE 1 -->"), F.lit(""), F.lit("## Tableau des Lignes de Facturation"), F.lit("| " + " | ".join(HEADER) + " |"), F.lit("|" + " --- |" * len(HEADER)))
    tail = F.array(F.lit(""), F.lit("## Totaux"), F.lit("| LIBELLE | MONTANT |"), F.lit("| --- | --- |"), F.concat(F.lit("| TOTAL HT | "), comma(total), F.lit(" |")))
    return F.array_join(F.concat(head, rows, tail), "\n")


def audit_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page, audit): the transcript grammar of the same orders.

    By key: wrong groups= where doc_id % 5 = 0, a missing table end where % 7 = 0, partial coverage where
    % 11 = 0, a flag where % 13 = 0, index gaps where % 17 = 0.
    """
    return order_lines(spark, sf_dir).select(F.col("order_key").alias("doc_id"), F.lit(1).alias("page"), _audit().alias("audit"))


def _audit() -> Column:
    """The transcript of an order's lines."""
    key = F.col("order_key")

    def one(x: Column, i: Column) -> Column:
        n = F.when((key % 5 == 0) & (i == 0), 4).otherwise(5).cast("string")
        start = F.concat(F.lit("[[VISUAL_ROW id=R"), (i + 1).cast("string"), F.lit(" kind=data groups="), n, F.lit("]]"))
        cells = F.array(x["l_partkey"].cast("string"), x["name"], x["l_quantity"].cast("int").cast("string"), comma(x["unit"]), comma(x["l_extendedprice"]))
        numbered = F.transform(cells, lambda c, j: F.concat((j + 1 + F.when((key % 17 == 0) & (j > 2), 1).otherwise(0)).cast("string"), F.lit("="), c))
        return F.concat(F.array(start), numbered, F.array(F.lit("[[/VISUAL_ROW]]")))

    head = F.array(F.lit("[[OCR_AUDIT_PAGE page=1 pages=1 document_type=invoice language=fr]]"), F.lit("[[OCR_ZONE id=Z1 kind=table source=printed order=1]]"), F.lit("[[VISUAL_TABLE id=T1]]"), F.lit("[[VISUAL_ROW id=H1 kind=header groups=5]]"), *[F.lit(f"{i}={h}") for i, h in enumerate(HEADER, 1)], F.lit("[[/VISUAL_ROW]]"))
    none = F.array().cast("array<string>")
    tail = F.concat(
        F.when(key % 7 == 0, none).otherwise(F.array(F.lit("[[/VISUAL_TABLE]]"))),
        F.array(F.lit("[[/OCR_ZONE]]")),
        F.when(key % 13 == 0, F.array(F.lit("[[OCR_FLAG kind=stamp]]"))).otherwise(none),
        F.array(F.concat(F.lit("[[END_OCR_AUDIT coverage="), F.when(key % 11 == 0, "partial").otherwise("complete"), F.lit("]]"))),
    )
    body = F.flatten(F.transform("items", one))
    return F.array_join(F.concat(head, body, tail), "\n")


def usage_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page, usage JSON) with text lengths as stand-ins for token counts; every fifth lacks a total, every seventh has nested details."""
    t = table(spark, sf_dir, "conversations")
    n = F.length("text")
    fields = F.concat_ws(
        ",",
        F.concat(F.lit('"prompt_tokens":'), n.cast("string")),
        F.concat(F.lit('"completion_tokens":'), (F.col("turn") + 1).cast("string")),
        F.when(F.col("conv_id") % 5 != 0, F.concat(F.lit('"total_tokens":'), (n + F.col("turn") + 1).cast("string"))),
        F.when(F.col("conv_id") % 7 == 0, F.concat(F.lit('"prompt_tokens_details":{"cached_tokens":'), F.floor(n / 2).cast("string"), F.lit("}"))),
    )
    return t.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page"), F.concat(F.lit("{"), fields, F.lit("}")).alias("usage"))
