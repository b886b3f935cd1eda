"""Transcript rows that are in order need one pattern a line; the others are still written anew."""

from pyspark.sql import functions as F

from sheafline.functions import text as t
from sheafline.operators import grammar


def test_rows_in_and_out_of_order(spark):
    text = "[[VISUAL_ROW id=A groups=2]]\n1=x\n2=y\n[[/VISUAL_ROW]]\n[[visual_row id=B groups=1]]\n 3 = p\nfree\n07=q\n[[/VISUAL_ROW]]\n4=out"
    r = spark.range(1).select(grammar.renumber_rows(F.lit(text)).alias("r")).first().r
    assert r.value == "[[VISUAL_ROW id=A groups=2]]\n1=x\n2=y\n[[/VISUAL_ROW]]\n[[visual_row id=B groups=2]]\n 1 = p\nfree\n2=q\n[[/VISUAL_ROW]]\n4=out"
    assert (r.groups_fixed, r.indices_renumbered) == (1, 2)


def test_lines_of_a_row_are_matched_once(spark):
    plan = spark.range(1).select(grammar.renumber_rows(F.concat(F.lit("1=x"), F.col("id").cast("string"))).alias("r"))._jdf.queryExecution().analyzed().toString()
    assert plan.count(r"^(\s*)(\d+)(\s*=.*)$") <= 3  # the index; and both sides of it in rows out of order


def test_attributes_with_quotes_of_all_kinds(spark):
    bags = {"a=1": {"a": "1"}, "A=\"x y\" b='z'": {"a": "x y", "b": "z"}, 'a="b': {"a": '"b'}, "a='": {"a": "'"}, 'a=""': {"a": ""}, "x==1": {"x": "=1"}, "a=\"'q'\" A=d": {"a": "d"}}
    rows = spark.createDataFrame([(b,) for b in bags], "b string").select("b", t.parse_attributes("b").alias("m")).collect()
    assert {r.b: r.m for r in rows} == bags
