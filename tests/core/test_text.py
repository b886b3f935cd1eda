"""Lexical rules: expected values are derived by hand from the formats."""

import pytest
from pyspark.sql import functions as F

from sheafline.functions import text as t


def one(spark, expr, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["x"] for r in rows.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_decimals(spark):
    cells = ["1.234,56", "1,234.56", "1,234", "1,234,567", "−12,5", "(12)", "1 234,50 €", "n/a", None, "7", "3.5.1", "12."]
    assert one(spark, t.parse_decimal, *cells) == [1234.56, 1234.56, 1.234, None, -12.5, 12.0, 1234.5, None, None, 7.0, None, 12.0]


def test_plain_and_fuzzy(spark):
    assert one(spark, t.plain_cell, " a<BR/>b  *c*_d`  ", None) == ["a b cd", ""]
    assert one(spark, t.fuzzy_normalize, "Quantité — N° 3", "ÉCO-Contribution") == ["quantite n 3", "eco contribution"]


def test_lines(spark):
    assert one(spark, t.lines, "a\r\nb\n\nc\n", "", "x y", "\n") == [["a", "b", "", "c"], [], ["x", "y"], [""]]


def test_predicates(spark):
    assert one(spark, t.is_monetary, "1 234,50 €", "12 %", "abc", "(5.00)", "[SANS_ENTETE_1]", "") == [True, False, False, True, False, False]
    assert one(spark, t.is_financial_label, "TOTAL HT", "QUANTITÉ", "éco-participation", "**Remise**", "", "export") == [True, False, True, True, False, False]
    assert one(spark, t.is_percent, "12 %", "-3,5%", "x%") == [True, True, False]
    assert one(spark, t.is_number_or_amount, "(12)", "3 €", "1a", "") == [True, True, False, False]


def test_attributes(spark):
    assert one(spark, t.parse_attributes, "id=R1 Kind=\"a b\" x='1' id=R2", "") == [{"kind": "a b", "x": "1", "id": "R2"}, {}]


def test_fences(spark):
    got = one(spark, t.strip_outer_fence, "```md\na\n```", "\n```\na", "x\ny", "~~~~\nb\n~~~~~")
    assert [(r["value"], r["removed"]) for r in got] == [("a", True), ("```\na", False), ("x\ny", False), ("b", True)]
    assert one(spark, t.code_fence, "a ````` b", "none") == ["``````", "````"]
    assert one(spark, t.page_markers_outside_fences, "<!-- PAGE 1 -->\n```\n<!-- PAGE 2 -->\n```\n<!-- page 3 -->") == [[1, 3]]
    assert one(spark, t.strip_triple_backticks, "```json\n{}\n```", "a") == ["{}", "a"]
    assert one(spark, t.strip_appendix, "body\n\n## Annexe - OCR brut\nrest", " a ") == ["body", "a"]


def test_escapes(spark):
    assert one(spark, t.escape_cell, "<EMPTY>", "a|b<BR>c & [TRONQUE]", "x_y") == ["", "a\\|b<br>c &amp; [TRONQUÉ]", "x\\_y"]
    assert one(spark, t.escape_block_line, "- item", "1. x", "---", "1.5") == ["\\- item", "1\\. x", "\\---", "1.5"]


def test_shorten(spark):
    got = one(spark, lambda c: t.shorten(c, 10), "0123456789", "abcdefghijkl")
    assert got[0]["value"] == "0123456789" and not got[0]["shortened"]
    assert got[1]["value"].startswith("abcde\n\n[...") and got[1]["value"].endswith("longueur originale=12 caractères ...]\n\nhijkl")


def test_aliases(spark):
    assert [(r["section"], r["valid"]) for r in one(spark, t.normalize_section, " Logo ", "totals", "x", None)] == [("issuer", True), ("totals", True), ("other", False), ("other", False)]
    assert [r["source"] for r in one(spark, t.normalize_source, "STAMP", "ink")] == ["stamp", "printed"]
    assert one(spark, t.derive_status, "a [ILLISIBLE] [TRONQUE]", "[TRONQUE]", "b", "[INCERTAIN]") == ["uncertain_truncated", "truncated", "readable", "readable"]


def test_canonical(spark):
    r = one(spark, t.sanitize_canonical, "```\r\n[[PAGE 1]]\r\n<SANS_ENTETE_2> [TRONQUÉE]\r\n```")[0]
    assert r["value"] == "[SANS_ENTETE_2] [TRONQUE]"
    assert r["changes"] == {"line_endings": 1, "outer_fence": 1, "model_page_markers": 1, "token_aliases": 1}


def test_uris(spark):
    assert one(spark, t.object_key, "gs://other/in/a/b.pdf", "/x.pdf", "gs://b") == ["in/a/b.pdf", "x.pdf", None]
    assert one(spark, lambda c: t.derived_uri(c, "bkt", "progress", ".progress.json"), "gs://o/in/a.b.pdf", "in/noext") == ["gs://bkt/progress/a.b.progress.json", "gs://bkt/progress/noext.progress.json"]


@pytest.mark.parametrize(("value", "expected"), [('"a"', "a"), ('{"text":"t"}', "t"), ('[{"text":"a"},"b",{"content":[{"text":"c"}]}," "]', "a\n\nb\n\nc"), ("null", ""), ("[]", "")])
def test_json_text(spark, value, expected):
    assert one(spark, lambda c: t.json_text_to_depth(c, 3), value) == [expected]
