import json

from pyspark.sql import functions as F

from sheafline.functions import text as t
from sheafline.operators import transport
from sheafline.operators.findings import page_findings
from sheafline.sources import files


def test_checkpoint_store_reads_its_own_fingerprint_only(spark, tmp_path):
    path = str(tmp_path / "store")
    for mark in ("f1", "f2"):
        files.append_checkpoint(spark.createDataFrame([(mark, 1, "x"), (mark, 2, None)], "pipeline_fingerprint string, page int, markdown string"), path)
    files.append_checkpoint(spark.createDataFrame([("f1", 3, "z")], "pipeline_fingerprint string, page int, markdown string"), path)
    own = spark.read.parquet(path).where("pipeline_fingerprint = 'f1'")
    assert sorted(r["page"] for r in own.collect()) == [1, 2, 3]
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pipeline_fingerprint" in plan


def test_documents_are_written_whole_and_again(spark, tmp_path):
    path = str(tmp_path / "out")
    for text in ("first", "line one\nline two\n\nend é"):
        files.write_documents(spark.createDataFrame([(text,)], "document string"), path)
    assert spark.read.text(path, wholetext=True).first()[0] == "line one\nline two\n\nend é\n"


def test_uris(spark):
    uris = spark.createDataFrame([("gs://b/in/a/x.pdf",), ("/in/y.tar.gz",)], "u string")
    rows = uris.select(t.derived_uri("u", "out", "md", ".md"), t.canonical_uri("u", "out")).collect()
    assert [tuple(r) for r in rows] == [("gs://out/md/a/x.md", "gs://out/in/a/x.pdf"), ("gs://out/md/y.tar.md", "gs://out/in/y.tar.gz")]


def test_prompt_cache_needs_more_pages_than_workers(spark):
    pages = spark.createDataFrame([(4,), (5,)], "n int")
    assert [r[0] for r in pages.select(transport.use_prompt_cache(F.col("n"), 4)).collect()] == [False, True]
    assert all(r[0] for r in pages.select(transport.use_prompt_cache(F.col("n"), 4, forced=True)).collect())


def test_request_messages_hold_prompt_and_views(spark):
    views = F.array(*(F.struct(F.lit(x).alias("label"), F.lit(f"data:{x}").alias("data_url")) for x in ("left", "right")))
    sent = json.loads(spark.range(1).select(transport.request_messages(F.lit('read "this"'), views)).first()[0])
    assert [m["role"] for m in sent] == ["user"] and [c["type"] for c in sent[0]["content"]] == ["text", "text", "image_url", "text", "image_url"]
    assert sent[0]["content"][0]["text"] == 'read "this"' and sent[0]["content"][4]["image_url"] == {"url": "data:right"}


def test_declared_rows_show_what_was_declared(spark):
    page = "<!-- PAGE 1 -->\n<!-- ROW_MAP source_rows=3 continuations=0 output_rows=2 mixed=r4 -->\n| A | B |\n|---|---|\n| x | y |\n<!-- GRID_MAP tracks=2 header_spans=1 unnamed=none -->"
    got = {r["rule"]: r["detail"] for r in page_findings(spark.createDataFrame([(1, 1, page)], "doc_id long, page int, markdown string"), ("commitments",)).collect()}
    assert set(got) == {"row_map_equation_mismatch", "row_map_output_mismatch", "row_map_mixed_invalid", "grid_map_orphelin_ligne"}
    assert got["row_map_output_mismatch"] == {"source": "3", "joined": "0", "output": "2", "mixed": "r4", "table_width": "2", "table_rows": "1"}
