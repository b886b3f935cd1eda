"""The page store under replays and failures, and one file for each document."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from sheafline.operators import state
from sheafline.sources import checkpoints, files, named_files

RECORD = "checkpoint_version int, checkpoint_schema string, pipeline_fingerprint string, source_id string, page_count int, page int, status string, updated_at timestamp, normalized_canonical string, markdown string, quality string, stats string"


def record(source, page, minute, body, status="done", mark="f", count=2):
    at = dt.datetime(2026, 1, 1, 0, minute) if minute is not None else None
    return (3, "s", mark, source, count, page, status, at, "c", body, "q", "s")


def bodies(df):
    return sorted((r["source_id"] or "", r["page"], r["markdown"]) for r in df.collect())


def test_newest_record_wins_and_compaction_keeps_it(spark, tmp_path):
    path = str(tmp_path / "store")
    first = [record("a", 1, 0, "old"), record("a", 2, 0, "two"), record("b", 1, 0, "other"), record("a", 1, 0, "of f2", mark="f2"), record(None, 1, None, "no source")]
    checkpoints.append(spark.createDataFrame(first, RECORD), path)
    checkpoints.append(spark.createDataFrame([record("a", 1, 5, "new"), record("a", 1, 3, "between")], RECORD), path)
    expected = [("", 1, "no source"), ("a", 1, "new"), ("a", 1, "of f2"), ("a", 2, "two"), ("b", 1, "other")]
    assert bodies(checkpoints.read(spark, path)) == expected
    own = checkpoints.read(spark, path, "f", "a")
    assert bodies(own) == [("a", 1, "new"), ("a", 2, "two")]
    assert "PartitionFilters: [isnotnull(pipeline_fingerprint" in own._jdf.queryExecution().executedPlan().toString()
    untouched = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/pipeline_fingerprint=f2/**/*.parquet", recursive=True)}
    assert checkpoints.compact(spark, path) == 1 and checkpoints.compact(spark, path) == 0
    assert bodies(checkpoints.read(spark, path)) == expected and spark.read.parquet(path).count() == 5
    assert untouched == {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/pipeline_fingerprint=f2/**/*.parquet", recursive=True)}


def test_failed_and_repeated_append(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = spark.createDataFrame([record("a", p, 1, f"text {p}") for p in range(1, 9)], RECORD)

    def fails(batches):
        for b in batches:
            yield b
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        checkpoints.append(rows.repartition(4).mapInArrow(fails, rows.schema), path)
    assert not glob.glob(f"{path}/**/*.parquet", recursive=True)
    for _ in range(3):  # the job's result was lost, so it is run again
        checkpoints.append(rows, path)
    once = checkpoints.read(spark, path)
    assert bodies(once) == [("a", p, f"text {p}") for p in range(1, 9)]
    docs = state.assemble_documents(once.withColumn("doc_id", F.col("source_id")), audit=None).collect()
    assert len(docs) == 1 and docs[0]["document"].count("text 3") == 1


def test_resume_needs_the_newest_record_to_be_whole(spark):
    done = [record("a", 1, 0, "good"), record("a", 1, 1, None), record("a", 2, 1, "good"), record("b", 1, 1, "good", count=7), record("c", 1, 1, "good", mark="stale"), record("d", 1, 1, "x", status="failed")]
    pages = spark.createDataFrame([(s, p, 2) for s in "abcd" for p in (1, 2)], "source_id string, page int, page_count int")
    kept, left = checkpoints.resume(spark.createDataFrame(done, RECORD), pages, 3, "s", "f")
    assert bodies(kept) == [("a", 2, "good")]
    assert sorted((r["source_id"], r["page"]) for r in left.collect()) == [("a", 1), ("b", 1), ("b", 2), ("c", 1), ("c", 2), ("d", 1), ("d", 2)]


def test_equally_new_records_give_the_same_one_however_dealt(spark):
    rows = spark.createDataFrame([record("a", 1, 0, f"v{i}") for i in range(40)], RECORD)
    assert len({bodies(checkpoints.newest(rows.repartition(n)))[0] for n in (1, 3, 7)}) == 1
    assert checkpoints.newest(rows.limit(0)).count() == 0


def test_modes_of_records_and_their_way_back(spark):
    result = spark.createDataFrame([("s", 1, "raw", "ocr", "why", "md", "q")], "source_id string, page_num int, raw_response string, raw_ocr string, ocr_reasoning string, markdown string, quality string")
    plain, annex, diagnostic = (checkpoints.page_records(result, **m) for m in ({}, {"ocr_annex": True}, {"diagnostic": True}))
    assert "raw_response" not in plain.columns and "ocr_reasoning" not in annex.columns and {"raw_response", "raw_ocr"} <= set(annex.columns)
    assert {"ocr_reasoning", "markdown_reasoning", "sanitized_canonical", "markdown_raw_response"} <= set(diagnostic.columns)
    back = checkpoints.restored_results(plain).first()
    assert (back["raw_response"], back["raw_ocr"], back["ocr_reasoning"], back["markdown"], back["quality"]) == ("ocr", "ocr", "", "md", "q")
    assert checkpoints.restored_results(diagnostic).first()["raw_response"] == "raw"


def test_progress_documents_are_read_back(spark, tmp_path):
    rows = spark.createDataFrame([record("in/a.pdf", 1, 0, "old"), record("in/a.pdf", 1, 4, "new"), record("in/a.pdf", 2, 0, "two"), record("in/b/c.pdf", 1, 0, "x")], RECORD).drop("quality", "stats")
    docs = checkpoints.progress_documents(rows).withColumn("name", named_files.document_name("source_id", ".progress.json"))
    named_files.write_documents(docs, str(tmp_path))
    assert sorted(json.load(open(tmp_path / "a.progress.json"))["pages"]) == ["1", "2"]
    back = files.read_checkpoint(spark, str(tmp_path / "a.progress.json"))
    assert sorted((r["page"], r["markdown"], r["status"]) for r in back.collect()) == [(1, "new", "done"), (2, "two", "done")]


def tree(path):
    return sorted(os.path.relpath(f, path) for f in glob.glob(f"{path}/**/*", recursive=True) if os.path.isfile(f) and "/_staging/" not in f)


def test_each_document_has_its_own_file(spark, tmp_path):
    path = tmp_path / "out"
    docs = spark.range(40).select(F.concat(F.lit("d"), F.col("id") % 3, F.lit("/n"), F.col("id"), F.lit(".md")).alias("name"), F.when(F.col("id") != 7, F.concat(F.lit("é\n"), F.col("id"))).alias("document")).repartition(6)
    for _ in range(2):
        named_files.write_documents(docs, str(path))
        assert tree(path) == sorted(f"d{i % 3}/n{i}.md" for i in range(40))
    back = {r["name"]: r["document"] for r in named_files.read_documents(spark, str(path)).collect()}
    assert back["d2/n5.md"] == "é\n5" and (path / "d1/n7.md").read_bytes() == b"" and len(back) == 39


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    path = tmp_path / "out"
    path.mkdir()
    (path / "kept.md").write_text("earlier")
    docs = spark.range(40).select(F.col("id").cast("string").alias("name"), F.when(F.col("id") == 39, F.raise_error(F.lit("lost")).cast("string")).otherwise("x").alias("document")).repartitionByRange(4, "id")
    with pytest.raises(Exception, match="lost"):
        named_files.write_documents(docs.select("name", "document"), str(path))
    assert tree(path) == ["kept.md"]


def test_names_must_be_unique_and_inside(spark, tmp_path):
    for names in (["a", "a"], [None], ["../x"], ["/etc/x"], ["_staging/x"]):
        with pytest.raises(Exception, match="names are not unique|not a name"):
            named_files.write_documents(spark.createDataFrame([(n, "x") for n in names], "name string, document string"), str(tmp_path))
    assert tree(tmp_path) == []
    named_files.write_documents(spark.createDataFrame([], "name string, document string"), str(tmp_path))
    assert tree(tmp_path) == []
