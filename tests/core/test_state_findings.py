"""State, assembly, transport, findings and files on small fixtures derived by hand."""

import json

from pyspark.sql import functions as F

from sheafline.operators import findings, grammar, markdown, state, transport
from sheafline.sources import files, recognizer
from sheafline.streaming.pages import arriving_pages, stream_findings


def one(spark, expr, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["x"] for r in rows.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def rules(md, audit="", *groups):
    from sheafline.operators.pages import Page

    return [(f.rule, f.severity) for g in groups for r in findings.RULES[g] for f in r(Page(md, audit, 1))]


def test_structure_rules():
    md = "<!-- PAGE 1 -->\n| A | [SANS_ENTETE_2] |\n|---|---|\n| 1 |  |\n\n| x |\n## Cadrage documentaire\n[[VISUAL_ROW"
    assert [r for r, _ in rules(md, "", "structure")] == [
        "ocr_audit_recopie_dans_markdown", "heading_diagnostic_interdit", "sans_entete_numerotation_invalide", "sans_entete_colonne_entierement_vide",
        "table_sans_donnee", "table_markdown_malformee", "table_largeur_entete_separateur",
    ]


def test_commitments():
    table = "| DESIGNATION | QTE | MONTANT |\n|---|---|---|\n| Eco-contribution | 1 | 0,10 |"
    got = [r for r, _ in rules(table, "", "commitments")]
    assert got == ["track_map_absent_complex", "grid_map_absent_complex", "row_map_absent_complex", "special_row_map_absent", "special_row_geometry_evidence_absent"]
    maps = '<!-- SPECIAL_ROW_MAP label="eco-contribution" tracks=3 cells="Eco-contribution¦1¦0,10" -->\n<!-- TRACK_MAP locked=no tracks=3 headers="DESIGNATION¦QTE¦MONTANT" evidence="geometry:2" -->\n<!-- GRID_MAP tracks=3 header_spans=4 unnamed=none -->\n<!-- ROW_MAP source_rows=3 continuations=1 output_rows=1 mixed=r1,r4 -->\n'
    got = [r for r, _ in rules(maps + table, "", "commitments")]
    assert got == ["track_map_not_locked", "grid_map_header_spans_invalid", "row_map_equation_mismatch", "row_map_mixed_invalid", "mixed_row_header_zone_not_empty"]
    assert rules(maps.split("\n")[0], "", "commitments") == [("special_row_map_orphelin_ligne", "warning")]


def test_regressions():
    md = "| DESIGNATION | QTE | [SANS_ENTETE_1] | P.U. NET | MONTANT | TVA |\n|---|---|---|---|---|---|\n| Vis | 2 | 2 | 3,00 | 6,00 | 20 |\n| Clou | 4 | 4 | 1,00 | 4,00 | 20 |\n| Eco-contribution |  | 3 pcs | x | éco | 1,00 |"
    assert ("contribution_row_shifted", "critical") in rules(md, "", "regression") and ("contribution_amount_shifted", "critical") in rules(md, "", "regression")
    md = "| [SANS_ENTETE_1] | SOUMIS | EXO | T |\n|---|---|---|---|\n| Codes TVA | 1 | 2 | 3 |\n| x | TOTAL HT | 1 | 2 |"
    assert [r for r, _ in rules(md, "", "regression")] == ["tax_axis_demoted_to_data", "mixed_tax_row_shifted"]
    md = "| DESIGNATION | QTE | MONTANT |\n|---|---|---|\n| a | 2 10 | 1 |\n| b | 2 11 | 1 |"
    assert [r for r, _ in rules(md, "", "regression")] == ["repeated_numeric_tracks_merged"]
    assert [r for r, _ in rules("<!-- GRID_MAP x -->", "", "regression")] == ["technical_map_comment_leaked"]


def test_cross_rules():
    audit = "[[TEXT_BLOCK id=B state=uncertain]]\nReçu le matin\n[[/TEXT_BLOCK]]\n[[TEXT_BLOCK id=C state=truncated]]\n[TRONQUE]\n[[/TEXT_BLOCK]]"
    assert [r for r, _ in rules("rien", audit, "cross")] == ["uncertain_ocr_omitted", "standalone_truncated_block_lost"]
    md = "| DESIGNATION | QTE |\n|---|---|\n| Vis<br>Reçu le matin [INCERTAIN] | 2 |\n\n[TRONQUÉ]"
    assert [r for r, _ in rules(md, audit, "cross")] == ["uncertain_handwriting_embedded_in_line_item"]


def test_findings_rows(spark):
    pages = spark.createDataFrame([(1, 1, "<!-- PAGE 1 -->\n| TOTAL HT | 5 € |\n|---|---|\n| Remise | 1 |"), (2, 1, None)], "doc_id long, page int, markdown string")
    got = findings.page_findings(pages, ("accounting",)).collect()
    assert [(r["doc_id"], r["rule"], r["line_no"], r["col_no"]) for r in got] == [(1, "financial_label_in_header", 2, 1), (1, "financial_amount_in_header", 2, None)]
    verdicts = findings.document_verdict(pages, findings.page_findings(pages, ("regression",))).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["ok"], r["n_critical"]) for r in verdicts] == [(1, False, 1), (2, True, 0)]


def test_transcript(spark):
    raw = "```\r\n[[OCR_AUDIT_PAGE page=1]]\r\n[[VISUAL_TABLE id=T]]\r\n[[VISUAL_ROW id=R kind=Header]]\r\n4=B\r\n2=A\r\n[[/VISUAL_ROW]]\r\n[[/VISUAL_TABLE]]\r\n[[END_OCR_AUDIT coverage=complete]]\r\n```"
    r = one(spark, grammar.sanitize_transcript, raw, " ")
    assert r[0]["changes"] == {"line_endings": 1, "outer_fence": 1, "visual_row_groups_fixed": 1, "visual_row_indices_renumbered": 1} and r[1]["value"] is None
    assert "[[VISUAL_ROW id=R kind=Header groups=2]]\n1=B\n2=A\n" in r[0]["value"]
    assert [(x["kind"], x["cells"]) for x in one(spark, grammar.visual_tables, raw)[0][0]] == [("header", ["A", "B"])]
    q = one(spark, grammar.transcript_quality, r[0]["value"], raw, "", "[[OCR_AUDIT_PAGE x]]\n[[VISUAL_ROW groups=2]]\n1=a\n[[END_OCR_AUDIT coverage=partial]]")
    assert (q[0]["status"], q[0]["row_count"], q[0]["cell_count"]) == ("complete", 1, 2)
    assert q[1]["status"] == "warning" and q[1]["warnings"] == ["R: visual_row_groups_absent"]
    assert q[2]["errors"] == ["OCR_AUDIT_PAGE_absent", "END_OCR_AUDIT_absent"] and q[2]["coverage"] == "unknown"
    assert q[3]["status"] == "degraded" and q[3]["errors"] == ["visual_row_non_fermee=1/0"] and q[3]["warnings"] == ["row_1: groupes_indices_incoherents=attendus_[1, 2]_recus_[1]"]


def test_markdown(spark):
    md = "```\n<!-- PAGE 7 -->\n\n<!-- GRID_MAP tracks=1 -->\n| [SANS_ENTETE_5] |\n|---|\n| x |\n\n## Vide\n```"
    rows = spark.createDataFrame([(md,)], "v string").select(markdown.sanitize_markdown("v", F.lit(3)).alias("x"))
    r = rows.first()["x"]
    assert r["value"] == "<!-- PAGE 3 -->\n\n| [SANS_ENTETE_1] |\n|---|\n| x |\n"
    assert r["changes"] == {"outer_fence": 1, "grid_map_comments_removed": 1, "unnamed_headers_renumbered": 1, "empty_sections_removed": 1}


def test_usage_and_status(spark):
    u = one(spark, state.usage_stats, '{"prompt_tokens":5,"completion_tokens":2,"prompt_tokens_details":{"cached_tokens":4}}', '{"input_tokens":1,"total_tokens":9}', None)
    assert [(x["input_tokens"], x["total_tokens"], x["cached_tokens"], x["uncached_input_tokens"]) for x in u] == [(5, 7, 4, 1), (1, 9, 0, 1), (0, 0, 0, 0)]
    pages = spark.createDataFrame([(1, "complete"), (1, None), (2, "complete"), (3, "unavailable"), (3, "warning")], "doc_id long, status string")
    assert {r[0]: r[1] for r in state.document_status(pages).collect()} == {1: "warning", 2: "ok", 3: "partial"}
    s = spark.createDataFrame([("complete", 1, 0), ("degraded", 1, 0), ("degraded", 0, 1), ("complete", 0, 0)], "b string, w int, c int")
    assert [r[0] for r in s.select(state.page_status(F.col("b"), F.col("w"), F.col("c"))).collect()] == ["warning", "degraded", "warning", "complete"]
    assert state.fingerprint({"b": 1, "a": 2}) == state.fingerprint({"a": 2, "b": 1}) != state.fingerprint({"a": 2, "b": 2})


def test_assembly(spark):
    pages = spark.createDataFrame([(1, 2, "two\n", "b ```` b"), (1, 1, "one", "a\n")], "doc_id long, page int, markdown string, audit string")
    doc = state.assemble_documents(pages).first()["document"]
    assert doc.index("PAGE_BUNDLE_START page=1") < doc.index("PAGE_BUNDLE_START page=2") and "`````text\nb ```` b\n`````" in doc
    assert one(spark, state.rendered_document, doc, "x<!-- OCR_ANNEX_START source=\"raw_qwen_independent_ocr_audit\" -->y", "z\n") == ["one\n\ntwo", "x", "z"]
    assert one(spark, state.transcript_annex, doc)[0].count("## OCR visuel indépendant — Page ") == 2 and one(spark, state.thinking_annex, doc) == [""]


def test_closing_annexes(spark):
    rows = [(1, 2, "two\n", "b", None, "w" * 5), (1, 1, "one", "a <!-- OCR_ANNEX_END --> ```` a\n", "x\n", ""), (2, 1, None, None, None, None)]
    pages = spark.createDataFrame(rows, "doc_id long, page int, markdown string, audit string, why string, also string")
    docs = {r["doc_id"]: r["document"] for r in state.assemble_documents(pages, closing_annex=True, thinking={"ocr_reasoning": "why", "markdown_reasoning": "also"}).collect()}
    doc = docs[1]
    assert doc.startswith("<!-- RENDERED_DOCUMENT_START -->\n\none\n\ntwo\n\n<!-- RENDERED_DOCUMENT_END -->\n\n# Annexe d'audit — OCR visuel indépendant\n\n<!-- OCR_ANNEX_START") and doc.endswith("````\n\n<!-- THINKING_ANNEX_END -->\n")
    assert "\n\n## OCR brut — Page 1\n\n<!-- RAW_OCR_META page=1 raw_chars=32 " in doc and "-->\n\n`````text\na <!-- OCR_ANNEX_END --> ```` a\n`````\n\n## OCR brut — Page 2\n\n" in doc
    assert one(spark, state.rendered_document, doc) == ["one\n\ntwo"]
    annex, why = one(spark, state.transcript_annex, doc)[0], one(spark, state.thinking_annex, doc)[0]
    assert annex.startswith("Cette annexe") and annex.endswith("````text\nb\n````")
    assert why.count("##### ") == 4 and "stage=ocr_reasoning chars=0 sha256=none truncated=no -->\n\n````text\n[AUCUN REASONING_CONTENT RETOURNÉ]\n````" in why and "````text\nx\n````" in why
    assert "sha256=none" in docs[2] and one(spark, state.rendered_document, docs[2]) == [""]
    short = spark.range(1).select(state.thinking_block(F.lit(1), {"ocr_reasoning": F.lit("abcdef"), "markdown_reasoning": F.lit("abc")}, most=4)).first()[0]
    assert "chars=6" in short and "truncated=yes" in short and "````text\nab\n\n[..." in short and "\n\nef\n````" in short


def test_read_then_write(spark):
    class Reader:
        def __init__(self):
            self.calls = 0

        def __call__(self, request):
            self.calls += 1
            return {"short": ("x", "{}"), "blank": ("[[PAGE 1]]\n[PAGE VIDE]", "{}"), "": ("", "{}")}.get(request, ("```text\n" + "a" * 40 + "\n```" if self.calls > 2 else "```\n" + " " * 50 + "\n```", str(self.calls)))

    class Writer:
        def __call__(self, request):
            return f"```markdown\n<!-- PAGE 1 -->\n# {request}\n| A | [SANS_ENTETE_1] |\n|---|---|\n| 1 |  |\n```", "{}"

    rows = [(1, 1, "late"), (2, 1, "short"), (3, 1, "blank"), (4, 1, None)]
    asked = spark.createDataFrame(rows, "doc_id long, page int, request string").coalesce(1)
    got = {r["doc_id"]: r for r in recognizer.read_then_write(asked, Reader, Writer, lambda page, text: F.concat(page.cast("string"), F.lit(":"), text)).collect()}
    assert (got[1]["text"], got[1]["text_usage"], got[1]["too_short"]) == ("a" * 40, "3", False)
    assert got[1]["markdown"].startswith("# 1:" + "a" * 40 + "\n| A |") and "SANS_ENTETE" not in got[1]["markdown"]
    assert [(got[i]["too_short"], got[i]["markdown"] is None) for i in (2, 3, 4)] == [(True, True), (False, False), (True, True)]
    assert got[3]["text"] == "[PAGE VIDE]" and recognizer.read_then_write(asked.limit(0), Reader, Writer, lambda page, text: text).count() == 0


def test_transport(spark):
    rows = spark.createDataFrame([(429, "", 1), (400, "", 1), (None, "overloaded", 2), (500, "Invalid API key", 1), (503, "", 3), (None, "", 2)], "s int, m string, a int")
    got = [tuple(r[0]) for r in rows.select(transport.retry_policy(F.col("s"), F.col("m"), F.col("a"))).collect()]
    assert got == [(True, 10.0), (False, 0.0), (True, 10.0), (False, 0.0), (False, 0.0), (True, 4.0)]
    got = [tuple(r[0]) for r in rows.select(transport.legacy_retry_policy(F.concat_ws(" ", F.col("s"), F.col("m")), F.col("a"))).collect()]
    assert got[0] == (True, 60) and got[2] == (True, 30) and got[3] == (False, 0) and got[4] == (False, 0)
    assert one(spark, transport.sse_events, ": c\ndata: a\ndata:b\n\n{\"x\":1}\n\ndata: [DONE]", "") == [["a\nb", '{"x":1}', "[DONE]"], []]
    assert [p[1:] for p in transport.profiles("audit")] == [("quality", 280, 420, 90), ("balanced", 260, 390, 88), ("compact", 240, 360, 85), ("emergency", 220, 330, 82)]
    dates = spark.createDataFrame([("3.5",), ("Wed, 21 Oct 2015 07:28:00 GMT",), ("x",)], "h string")
    assert [r[0] for r in dates.select(transport.retry_after_seconds(F.col("h"), F.lit("2015-10-21 07:27:00").cast("timestamp"))).collect()] == [3.5, 60.0, None]


def test_files_and_stream(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF")
    docs = files.explode_pages(files.with_page_counts(files.read_documents(spark, str(tmp_path)), lambda b: 2))
    assert [(r["page"], r["source_id"][:13]) for r in docs.collect()] == [(1, "local-sha256:"), (2, "local-sha256:")]
    record = {"status": "done", "page_num": 1, "canonical": "c", "markdown": "m", "raw_response": "r", "quality": {"status": "complete"}, "stats": {"input_tokens": 1}}
    (tmp_path / "c.json").write_text(json.dumps({"checkpoint_version": 2, "checkpoint_schema": "s", "pipeline_fingerprint": "f", "source_id": "i", "page_count": 2, "pages": {"1": record, "2": {**record, "status": "failed"}}}))
    rows = files.read_checkpoint(spark, str(tmp_path / "c.json"))
    assert [r["page"] for r in state.valid_checkpoint(rows, 2, "s", "f", "i", 2).collect()] == [1]
    assert state.valid_checkpoint(rows, 2, "s", "other").count() == 0
    asked = spark.createDataFrame([(1, 1, "q")], "doc_id long, page int, request string")
    assert recognizer.recognize(asked, lambda: recognizer.Recorded({"q": ("text", "{}")})).first()["response"] == "text"
    spark.createDataFrame([(1, 1, "x", "")], "doc_id long, page int, markdown string, audit string").write.parquet(str(tmp_path / "in"))
    query = stream_findings(arriving_pages(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck"))
    query.awaitTermination(60)
    assert [r["rule"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["page_marker_absent"]


def test_import_without_corpus_operators():
    import __spark_entry__ as e

    assert "arithmetic_fit_by_order" in e.queries() and set(e.oracle_sql()) <= set(e.queries())
