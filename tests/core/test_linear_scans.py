"""Scans of lines by slices give what a walk from line to line gives, in time that grows with the lines."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from sheafline.functions import text
from sheafline.operators import grammar, tables, transport
from sheafline.operators.pages import Page


def made(parts, n, seps=("\n",), seed=1, most=14):
    rnd = random.Random(seed)
    return [rnd.choice(seps).join(rnd.choice(parts) for _ in range(rnd.randint(0, most))) for _ in range(n)]


def both(spark, texts, column, walk):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(texts)], "i int, v string").select("v", column(F.col("v")).alias("x")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert plain(r["x"]) == walk(r["v"]), r["v"]


def plain(x):
    return [plain(y) for y in x] if isinstance(x, (list, tuple)) else x


def lines_of(v):
    return v.splitlines()


def walk_rows(v):
    out, open_ = [], None
    for x in lines_of(v):
        if open_ is None and re.match(grammar.ROW_START, x):
            open_ = [x, [], None]
        elif open_ is None:
            out.append([None, [], x])
        elif re.match(grammar.ROW_END, x):
            out.append([open_[0], open_[1], x])
            open_ = None
        else:
            open_[1].append(x)
    return out + ([open_] if open_ else [])


def test_rows(spark):
    both(spark, made(["[[VISUAL_ROW id=1 groups=2]]", "[[/VISUAL_ROW]]", "1=a", "2=b", "x", ""], 200), grammar.row_blocks, walk_rows)


@pytest.mark.parametrize("ragged", ["stop", "skip"])
def test_tables(spark, ragged):
    texts = made(["| a | b |", "|---|---|", "| x |", "|---|", "text", "", "<!-- PAGE 3 -->", "| 1 | 2 |", "| \\| | 2 |"], 300)
    both(spark, texts, lambda v: tables.markdown_tables(v, ragged), lambda v: [[t.page, t.line, t.header, t.rows] for t in Page(v).scan(ragged == "skip")])


def walk_segments(v):
    out, open_, rows = [], [], lines_of(v)
    for i, x in enumerate(rows):
        row, rule = (bool(re.match(p, x)) for p in (r"^\|.*\|\s*$", r"^\|[\s:\-|]+\|\s*$"))
        follows = i + 1 < len(rows) and bool(re.match(r"^\|[\s:\-|]+\|\s*$", rows[i + 1]))
        if open_ and (row or len(open_) == 1):
            open_.append(x)
        else:
            out += [(True, y) for y in open_]
            open_ = [x] if row and follows else []
            out += [] if open_ else [(False, x)]
    return out + [(True, y) for y in open_]


def test_segments(spark):
    flat = lambda v: F.flatten(F.transform(tables.segments(v), lambda s: F.transform(s["lines"], lambda x: F.struct(s["table"], x))))
    both(spark, made(["| a | b |", "|---|---|", "| x |", "text", "", "|--|"], 200), flat, lambda v: [list(x) for x in walk_segments(v)])


def walk_fences(v):
    out, open_ = [], ""
    for x in lines_of(v):
        mark = (re.match(r"^\s*(```|~~~)", x) or [None, ""])[1]
        out.append([x, bool(open_), bool(mark)])
        if mark and not open_:
            open_ = mark
        elif mark and x.lstrip().startswith(open_):
            open_ = ""
    return out


def test_fences(spark):
    both(spark, made(["```", "~~~", "  ```", "``` x", "text", "", "<!-- PAGE 2 -->", "~~~~", " a ```"], 300), text.outside_fences, walk_fences)


def walk_sections(v):
    rows, gone = lines_of(v), 0
    kept = []
    for i, x in enumerate(rows):
        after = next((y for y in rows[i + 1 :] if y.strip()), "## end")
        empty = re.match(r"##\s+\S", x.strip()) and (re.match(r"##\s+\S", after.strip()) or re.match(r"(?i)\s*<!--\s*PAGE", after))
        gone += bool(empty)
        kept += [] if empty else [x]
    return ["\n".join(kept) if gone else v, gone]


def test_sections(spark):
    both(spark, made(["## A", "## B", "", "  ", "text", "<!-- PAGE 2 -->", "### c"], 200), tables.remove_empty_sections, walk_sections)


def walk_events(v):
    out, open_ = [], []
    for x in [*re.split(r"\r\n|\n|\r", v), ""]:
        if x == "" and open_:
            out.append("\n".join(open_))
            open_ = []
        elif x.startswith("data:"):
            open_.append(x[5:].lstrip(" "))
        elif re.match(r"\s*(\{|\[DONE\])", x):
            open_.append(x.strip())
    return out


def test_events(spark):
    both(spark, made(['data: {"a":1}', "data: x", "", ": c", '{"choices":[]}', "[DONE]", "data: [DONE]", "event: e"], 200, ("\n", "\r\n")), transport.sse_events, walk_events)


CASES = {
    "rows": (grammar.row_blocks, "[[VISUAL_ROW id=R groups=1]]\n1=a\n[[/VISUAL_ROW]]\n"),
    "tables": (tables.markdown_tables, "| a | b |\n|---|---|\n| 1 | 2 |\n\n"),
    "segments": (tables.segments, "| a | b |\n|---|---|\n| 1 | 2 |\n\n"),
    "fences": (text.outside_fences, "```\nx\n```\ny\n"),
    "events": (transport.sse_events, "data: x\n\n"),
}


@pytest.mark.parametrize("name", CASES)
def test_time_grows_with_the_lines(spark, name):
    column, part = CASES[name]

    def seconds(times):
        df = spark.range(1).select(F.repeat(F.lit(part), times).alias("v")).repartition(1)
        found = []
        for _ in range(3):
            start = time.time()
            df.select(F.size(column(F.col("v")))).collect()
            found.append(time.time() - start)
        return min(found)

    few = seconds(2_000)
    assert seconds(20_000) < max(12 * few, 2.0)  # a copied array would take a hundred times as long
