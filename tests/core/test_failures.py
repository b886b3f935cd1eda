"""Failures of a recognition client: rows, repeated attempts, and an end for all."""

import zlib

import pytest
from pyspark.sql import functions as F

from sheafline.operators import state
from sheafline.sources import recognizer

CALLS = "calls"


def client(folder):
    """A client that fails as each request asks, and notes every call in a folder. Made here, so that workers get it by value."""

    class Client:
        def __init__(self, attempt):
            self.attempt = attempt

        def __call__(self, request):
            with open(f"{folder}/{zlib.crc32(request.encode())}-{self.attempt}", "a") as f:
                f.write(".")
            kind, _, message = request.partition("|")
            if message and self.attempt < int(kind):
                raise RuntimeError(message)
            return request.upper(), "{}"

    return Client


def asked(spark, folder, requests, parts=1, **kw):
    rows = spark.createDataFrame([(i, 1, r) for i, r in enumerate(requests)], "doc_id long, page int, request string").repartitionByRange(parts, "doc_id")
    waits = str(folder / "waits")
    (folder / CALLS).mkdir()
    calls = str(folder / CALLS)

    def wait(seconds):
        with open(waits, "a") as f:
            f.write(f"{seconds:.1f} ")

    out = recognizer.ask_with_policy(rows, client(calls), folder=f"file://{folder}/rounds", wait=wait, **kw)
    return out, {r["doc_id"]: (r["attempt"], r["outcome"], r["response"], r["status"]) for r in out.collect()}


def test_only_failed_rows_are_asked_again(spark, tmp_path):
    out, got = asked(spark, tmp_path, ["plain", "2|HTTP 503", "9|HTTP 500", "9|HTTP 400 no", "2|connection reset", None], parts=2)
    assert got == {0: (1, "done", "PLAIN", None), 1: (2, "done", "2|HTTP 503", None), 2: (3, "failed", None, 500), 3: (1, "failed", None, 400), 4: (2, "done", "2|CONNECTION RESET", None), 5: (1, "done", "", None)}
    calls = [f.read_text() for f in (tmp_path / CALLS).iterdir()]
    assert len(calls) == 6 + 3 + 1 and set(calls) == {"."}  # every attempt once, whatever was read afterwards
    assert out.count() == 6 and recognizer.answered(out).count() == 6
    with pytest.raises(RuntimeError, match="document 2, page 1"):
        recognizer.answered(out, publish_partial=False)
    pages = state.with_placeholders(out.select("doc_id", "page"), out.where("outcome = 'done'").select("doc_id", "page", F.lit("complete").alias("status"), F.col("response").alias("markdown")), ["doc_id", "page"])
    assert pages.where("status = 'unavailable'").count() == 2


def test_a_failure_of_all_requests_stops_the_rest(spark, tmp_path):
    out, got = asked(spark, tmp_path, ["a", "9|HTTP 500", "9|HTTP 401 invalid api key", "b", "c"])
    assert {k: v[:2] for k, v in got.items()} == {0: (1, "done"), 1: (1, "cancelled"), 2: (1, "global"), 3: (None, "cancelled"), 4: (None, "cancelled")}
    assert len(list((tmp_path / CALLS).iterdir())) == 3
    with pytest.raises(RuntimeError, match="document 2, page 1.*invalid api key"):
        recognizer.answered(out)


def test_rate_limits_may_fail_fast_and_no_requests_give_no_rows(spark, tmp_path):
    assert asked(spark, tmp_path, ["2|HTTP 429 rate limit"], fail_fast=True)[1] == {0: (1, "failed", None, 429)}
    none = spark.createDataFrame([], "doc_id long, page int, request string")
    assert recognizer.ask_with_policy(none, client("")).count() == 0


def test_delays_are_waited_for_once(spark, tmp_path):
    asked(spark, tmp_path, ["2|HTTP 503", "2|HTTP 429 rate limit"])
    waits = [float(x) for x in (tmp_path / "waits").read_text().split()]
    assert sorted(waits)[:2] == [0.0, 0.0] and max(waits) <= 10.0 and len(waits) == 4
