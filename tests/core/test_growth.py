"""Steps whose tasks must not grow with the table, and short cuts that must not change a result."""

from pyspark.sql import functions as F

from sheafline import queries
from sheafline.functions import unicode as u
from sheafline.operators import findings, pages


def test_findings_are_dealt_over_the_sessions_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        plan = queries.matched_table_findings(spark, "/root/testdata/sf0.001")
        assert plan.rdd.getNumPartitions() == 16
        dealt = plan._jdf.queryExecution().optimizedPlan().toString().split("Repartition")[1]
        assert "VISUAL_TABLE" not in dealt  # orders are dealt, not the texts made of them
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_lines_without_comments_are_matched_against_no_declaration(monkeypatch):
    asked = []

    class Counting:
        def __init__(self, pattern):
            self.pattern = pattern

        def match(self, line):
            asked.append(line)
            return self.pattern.match(line)

    monkeypatch.setattr(findings, "DECLARATIONS", {k: Counting(v) for k, v in findings.DECLARATIONS.items()})
    grid = ' <!-- GRID_MAP tracks=2 header_spans=1 unnamed=none -->'
    found = list(findings.declared_grids(pages.Page("\n".join(["text"] * 50 + [grid, "| a | b |", "|---|---|", "| 1 | 2 |"]))))
    assert set(asked) == {grid} and [g.declared["grid"][0].line for g in found] == [51]


def test_cells_read_by_short_cuts():
    for content in ("a | b", "a \\| b | c", "a\\\\| b", "\\", "", "|", " x |\\"):
        by_token = "".join("\0" if x == "|" else x for x in pages._PIPE.findall(content)).split("\0")
        assert pages._split(content) == [x.strip() for x in by_token]
    for value, amount in [("12,50 €", True), ("−3", True), ("(4)", True), ("+", False), ("٣", True), ("²", False), ("[SANS_ENTETE_1]", False), ("<br>7", True), ("5 %", False), ("", False)]:
        assert u.monetary(value) is amount
    assert [u.fuzzy(x) for x in ("ﬁn", "Ça & LÀ", "__a__<BR/>b")] == ["fin", "ca la", "a b"]


def test_deep_contents_are_dealt_over_the_sessions_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        assert queries.nested_content_text(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 16
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_runs_of_brackets_are_one_token():
    deep = "[" * 3000 + '{"content": [["a"], "b"]}' + "]" * 3000
    assert len(u._TOKEN.findall(deep)) < 20
    assert u.content_text(u.deep_json(deep)) == "a\n\nb"


def test_texts_without_placeholders_keep_their_lines(spark):
    from sheafline.operators import tables

    r = spark.range(1).select(tables.renumber_unnamed(F.lit("| A |\r\n|---|\n| 1 |\n")).alias("a"), tables.renumber_unnamed(F.lit("| [sans_entete_3] |\n|---|")).alias("b")).first()
    assert (r.a.value, r.a.changed, r.b.value, r.b.changed) == ("| A |\n|---|\n| 1 |", 0, "| [SANS_ENTETE_1] |\n|---|", 1)


def test_cut_headers_read_both_readings_from_one_deal_of_the_lines(spark):
    plan = queries.cut_headers_and_blocks(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and plan.count("RepartitionByExpression") == 1  # lines with their parts, dealt once: no texts are joined


def test_lines_of_tables_with_many_splits_are_dealt_over_more_tasks(spark):
    from sheafline.plans import corpora

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        plan = corpora.order_lines(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert int(plan.split("RepartitionByExpression [")[1].split("], ")[1].split("\n")[0]) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_short_cuts_of_page_rules_find_the_same():
    import re

    texts = ["REMİSE 3", "ſOLDE", "omr", "from", "a|eco contribution|b", "TOTAL\nHT", "Konsigne", "écoparticipation", "ÉCO-CONTRIBUTION", "", "xyz"]
    for pattern in (findings.CONTRIBUTION, findings.PAIR_LABEL, findings.BANK_LINE, findings.STACK):
        assert [bool(u.caseless(pattern)(u.folded(x))) for x in texts] == [bool(pattern.search(x)) for x in texts]
    audit = "[[VISUAL_TABLEX]][[visual_table a]]1[[VISUAL_TABLE b]2[[/VISUAL_table]][[VISUAL_TABLE\nc]]3[[/VISUAL_TABLE]][[VISUAL_TABLE]]4"
    assert pages.blocks(audit, "VISUAL_TABLE") == re.findall(r"(?is)\[\[VISUAL_TABLE\b([^\]]*)\]\](.*?)\[\[/VISUAL_TABLE\]\]", audit)
    assert pages.indexed("2=b\n 1= a \n\n x=1\n10=c\n1=d") == ["a", "d", "b", "c"]
    assert u.plain_cells(["a  b", "c"]) == ["a b", "c"] and u.plain_cells(["*a*", "<br/>b"]) == ["a", "b"] and u.plain_cells(["a b"]) == ["a b"]


def python_steps(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython")


def test_documents_are_validated_in_one_pass(spark):
    plan = queries.validated_documents(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") <= 1 and plan.count("Join") == 1  # lines with their parts; the checks join nothing


def test_tables_and_transcripts_are_parsed_by_the_page_parser(spark):
    sf = "/root/testdata/sf0.001"
    assert [python_steps(queries.QUERIES[n](spark, sf)) for n in ("invoice_roundtrip_cells", "arithmetic_fit_by_order", "table_cells", "table_width_check", "audit_table_rows")] == [1] * 5


def test_declared_grids_read_cells_once(monkeypatch):
    asked = []
    monkeypatch.setattr(findings, "contributes", lambda cells: asked.append(cells))
    md = "\n".join(["| DESIGNATION | QTE | MONTANT |", "|---|---|---|", *[f"| Eco-contribution {i} | 1 | 2 |" for i in range(20)]])
    assert [f.rule for f in findings.commitments(pages.Page(md))][-2:] == ["special_row_map_absent", "special_row_geometry_evidence_absent"] and not asked


def test_structure_of_odd_pages():
    md = "<!-- PAGE 1 -->\n| a | b |\n|---|\n| 1 |\n| \\| | 2 |\n|\n\n|---|---|\n|:---|\n<!-- PAGE 3 -->"
    assert pages.Page(md).structure(2) == ([1, 3], False, [2, 4, 6, 8]) and pages.Page("").structure(None) == ([], True, [])


def test_needles_are_in_all_that_their_patterns_find():
    import itertools
    import re

    words = ["total", "ht", "tva", "ttc", "net", "a", "payer", "solde", "éco", "eco", "contribution", "participation", "redevance", "levy", "fee", "frais", "surcharge", "remise", "discount", "escompte", "port", "retenue", "arrondi", "octroi", "de", "mer", "régional", "om", "omr", "droits", "taxes", "acompte", "iban", "rib", "bic", "swift", "compte", "bancaire", "red", "REMİSE", "ſolde", "ESCOMPTE"]
    held = {findings.IS_FEE: findings.CONTRIBUTION, findings.IS_PAIR: findings.PAIR_LABEL, findings.IS_SIMPLE_PAIR: findings.SIMPLE_PAIR, findings.IS_STACK: findings.STACK, findings.IS_LOOSE_STACK: findings.LOOSE_STACK, findings.IS_BANK: findings.BANK_LINE}
    for some in itertools.chain(itertools.product(words, repeat=2), itertools.permutations(words[:9], 3)):
        for text in (" ".join(some), "-".join(some)):
            for needled, pattern in held.items():
                assert needled(u.folded(text)) == bool(pattern.search(text)), (text, pattern.pattern)
    assert u.all_plain("a|b c") and not any(map(u.all_plain, ("a  b", "*a", "a b", "<br>", "a`", "_a", "a\tb")))
    assert not re.search("[<*_`]", "a|b c")


def test_headers_are_searched_once(monkeypatch):
    asked = []

    class Counting:
        def search(self, text):
            asked.append(text)

    pattern = Counting()
    for _ in range(3):
        table = pages.Page("| ONCE | TWICE |\n|---|---|\n| 1 | 2 |").tables[0]
        assert table.column(pattern) is None and not table.headed(pattern)
    assert asked == ["ONCE", "TWICE", "ONCE | TWICE"]
