"""Page results, document verdicts, profiles and nested content."""

from pyspark.sql import functions as F

from sheafline.functions.unicode import alike, content_text, deep_json, json_text
from sheafline.operators import findings, results, state, transport

STATS = "struct<" + ",".join(f"{k}:long" for k in state.COUNTERS) + ">"


def test_page_results(spark):
    audit = "[[OCR_AUDIT_PAGE page=1]]\n[[VISUAL_TABLE id=T]]\n[[VISUAL_ROW id=R kind=data groups=1]]\n1=a\n[[/VISUAL_ROW]]\n[[/VISUAL_TABLE]]\n[[END_OCR_AUDIT coverage=complete]]"
    stats = (5,) + (0,) * (len(state.COUNTERS) - 1)
    audits = spark.createDataFrame([(1, 1, audit, stats), (1, 2, " ", None)], f"doc_id long, page int, audit string, stats {STATS}")
    pages = [(1, 1, "<!-- PAGE 1 -->\ntexte", stats), (1, 2, "texte", stats), (1, 3, "| NET A PAYER |\n|---|\n| 5 |", None), (1, 4, None, None)]
    got = results.page_results(audits, spark.createDataFrame(pages, f"doc_id long, page int, markdown string, stats {STATS}")).orderBy("page").collect()
    assert [(r["status"], r["review_required"], r["stats"]["input_tokens"], r["format_complete"]) for r in got[:3]] == [("complete", False, 10, True), ("warning", False, 5, False), ("warning", True, 0, False)]
    assert len(got) == 4 and "quality=unavailable" in got[1]["audit"] and got[3]["markdown"] is not None
    assert results.NO_TRANSCRIPT in got[1]["quality"]["warnings"] and got[1]["quality"]["error_count"] == 0 and got[1]["quality"]["warning_count"] == 2 + got[1]["n_warnings"]
    assert [(f["rule"], f["severity"], f["line_no"], f["col_no"], f["detail"]) for f in got[2]["findings"] if f["severity"] == "critical"] == [("financial_data_in_markdown_header", "critical", 3, 1, {"value": "NET A PAYER"})]


def test_validated_documents(spark):
    pages = spark.createDataFrame([(1, 1, "<!-- PAGE 1 -->\n| A | B |\n|---|---|\n| 1 | 2 |"), (2, 1, "| A | B |\n|---|---|\n| 1 |"), (3, 1, "<!-- PAGE 1 -->\n| TOTAL HT |\n|---|\n| 1 |")], "doc_id long, page int, markdown string")
    docs = state.assemble_documents(pages, audit=None).withColumn("page_count", F.lit(1))
    got = {r["doc_id"]: (r["ok"], r["n_errors"], r["n_critical"]) for r in findings.validate_documents(docs).collect()}
    assert got == {1: (True, 0, 0), 2: (False, 2, 0), 3: (False, 0, 1)}


def test_profiles_keep_repeated_pages(spark):
    pages = spark.createDataFrame([(1, 0.01), (1, 0.01), (2, 1.0), (3, None)], "doc_id long, s double")
    got = transport.first_fitting_profile(pages, "markdown", F.col("s") * F.col("full_dpi"))
    assert sorted((r["doc_id"], r["profile"], r["fits"]) for r in got.collect()) == [(1, "quality", True), (1, "quality", True), (2, "emergency", False), (3, "emergency", False)]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_nested_content(spark):
    assert content_text([[[[["deep"]]]], " ", {"content": [{"text": "x"}]}]) == "deep\n\nx" and content_text({"text": "a", "content": "b"}) == "a" and content_text(7) == ""
    far = lambda n, inner: "[" * n + inner + "]" * n
    values = [far(9, '"deep"'), far(2_000, '"deep"'), far(200_000, '{"content": [1, "a\\u00e9", {"text": "b"}]}'), far(200_000, '"x"') + "]", far(200_000, "{1}"), "no json", None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    assert [r[0] for r in rows.orderBy("i").select(json_text("v")).collect()] == ["deep", "deep", "aé\n\nb", "", "", "", ""]
    assert deep_json(' {"a": [1, {"b": null}], "c": "x,]"} ') == {"a": [1, {"b": None}], "c": "x,]"}
    assert alike("abcd", "abcf", 0.7) and not alike("abcd", "wxyz", 0.1)


def test_composed_queries_read_both_texts_from_one_deal_in_one_python_step(spark):
    from sheafline import queries

    for name in ("composed_page_quality", "composed_page_results", "composed_page_findings"):
        plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1 and plan.count("Join") == 1 and plan.count("RepartitionByExpression") == 1, name  # lines with their parts, dealt once


def test_only_what_is_asked_of_composed_pages_is_made(spark):
    audit = "```\r\n[[OCR_AUDIT_PAGE page=1]]\r\n[[VISUAL_ROW id=R groups=3]]\r\n2=a\r\n[[/VISUAL_ROW]]\r\n[[END_OCR_AUDIT coverage=complete]]\r\n```"
    md = "```\n<!-- PAGE 7 -->\n<!-- GRID_MAP tracks=1 -->\n| [SANS_ENTETE_5] | A |\n|---|---|\n| x | y |\n\n## Vide\n\n## Fin\n```"
    pages = spark.createDataFrame([(1, 3, md, audit, None, None), (2, None, md, None, None, None), (3, 1, None, "\x1f", None, None)], f"doc_id long, page int, raw_markdown string, raw_audit string, markdown_stats {STATS}, audit_stats {STATS}")
    whole = results.composed_pages(pages).orderBy("doc_id").collect()
    some = results.composed_pages(pages, columns=("findings", "status")).orderBy("doc_id").collect()
    assert some[0].asDict().keys() == {"doc_id", "page", "findings", "status"} and [(r.findings, r.status) for r in some] == [(r.findings, r.status) for r in whole]
    assert whole[0].markdown == "<!-- PAGE 3 -->\n\n| [SANS_ENTETE_1] | A |\n|---|---|\n| x | y |\n" and "groups=1]]\n1=a" in whole[0].audit
    assert whole[0].markdown_sanitizations == {"outer_fence": 1, "grid_map_comments_removed": 1, "unnamed_headers_renumbered": 1, "empty_sections_removed": 2}
    assert whole[0].audit_sanitizations == {"line_endings": 1, "outer_fence": 1, "visual_row_groups_fixed": 1, "visual_row_indices_renumbered": 1}
    assert whole[1].markdown == "" and "no transcript" in whole[1].audit and results.NO_TRANSCRIPT in whole[2].quality.warnings and whole[2].stats.input_tokens == 0
