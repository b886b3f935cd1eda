"""The boundary to a recognition model. Rendering and the model itself are outside this engine."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.functions import text as t
from sheafline.operators.markdown import tidy_markdown
from sheafline.operators.transport import retry_policy
from sheafline.session import shared_folder

#: What a reader answers for a page without content; it is never asked again for it.
BLANK = "[PAGE VIDE]"
_TOKEN_LINE = re.compile(t.MODEL_PAGE)


class Recognizer(Protocol):
    """Turns one page's request into text and a usage record (JSON)."""

    def __call__(self, request: str) -> tuple[str, str]: ...


class Recorded:
    """Answers from earlier responses: for tests and replays without a network."""

    def __init__(self, responses: dict[str, tuple[str, str]]) -> None:
        self.responses = responses

    def __call__(self, request: str) -> tuple[str, str]:
        return self.responses.get(request, ("", "{}"))


def recognize(requests: DataFrame, make: Callable[[], Recognizer]) -> DataFrame:
    """(doc_id, page, response, usage): ``make`` runs once in each task, so a client is reused over its pages."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for batch in batches:
            answers = [model(r) for r in batch["request"]]
            yield batch[["doc_id", "page"]].assign(response=[a for a, _ in answers], usage=[u for _, u in answers])

    return requests.select("doc_id", "page", "request").mapInPandas(run, "doc_id long, page int, response string, usage string")


def _length(answer: str) -> int:
    """Characters of an answer without its code fence and page tokens; a blank page counts as long enough."""
    body = re.sub(r"\A```[\w-]*\n?|\n?```\n?\Z", "", answer.strip(), flags=re.ASCII) if answer.strip().startswith("```") else answer
    shown = "\n".join(x for x in body.splitlines() if not _TOKEN_LINE.match(x)).strip()
    return 10**9 if shown == BLANK else len(shown)


def read_then_write(requests: DataFrame, reader: Callable[[], Recognizer], writer: Callable[[], Recognizer], ask: Callable[[Column, Column], Column], least_chars: int = 40, retries: int = 2) -> DataFrame:
    """(doc_id, page, text, text_usage, too_short, markdown, markdown_usage): the page's text first, then Markdown from that text alone.

    The reader is asked up to ``retries`` times more while its answer has under ``least_chars`` characters; the last answer
    counts. A page that stays too short gets no Markdown (null). ``ask(page, text)`` is the writer's request. Null requests
    are asked as ''. Both passes are narrow, so a page costs its calls once; write the result before using it twice.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = reader()
        for batch in batches:
            answers = []
            for request in batch["request"]:
                answer = model(request)
                for _ in range(retries):
                    if _length(answer[0]) >= least_chars:
                        break
                    answer = model(request)
                answers.append((*answer, _length(answer[0]) < least_chars))
            texts, usages, short = zip(*answers, strict=True) if answers else ((), (), ())
            yield batch[["doc_id", "page"]].assign(answer=list(texts), text_usage=list(usages), too_short=list(short))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = writer()
        for batch in batches:
            answers = [(None, None) if short else model(r) for short, r in zip(batch["too_short"], batch["request"], strict=True)]
            yield batch.drop(columns="request").assign(answer=[a for a, _ in answers], markdown_usage=[u for _, u in answers])

    asked = requests.select("doc_id", "page", t.text("request").alias("request"))
    first = asked.mapInPandas(read, "doc_id long, page int, answer string, text_usage string, too_short boolean")
    shown = t.strip_model_page_tokens(t.normalize_placeholders(t.strip_triple_backticks("answer")))
    first = first.select("doc_id", "page", shown.alias("text"), "text_usage", "too_short")
    second = first.withColumn("request", ask(F.col("page"), F.col("text")))
    kept = "doc_id long, page int, text string, text_usage string, too_short boolean"
    done = second.mapInPandas(write, f"{kept}, answer string, markdown_usage string")
    done = tidy_markdown(done, "answer")
    return done.select("doc_id", "page", "text", "text_usage", "too_short", F.when(~F.col("too_short"), F.col("answer")).alias("markdown"), "markdown_usage")


#: What became of a request: answered; failed for good; a failure that concerns all requests; not asked (any more) because of one.
DONE, FAILED, GLOBAL, CANCELLED, AGAIN = "done", "failed", "global", "cancelled", "again"
_ASKED = "doc_id long, page int, request string, attempt int, response string, usage string, status int, error string"
_STATUS = re.compile(r"\bhttp[ :]*(\d{3})\b", re.I)
_GLOBAL = re.compile(t.GLOBAL_FAILURE, re.I)


def _attempt(make: Callable[[int], Recognizer], attempt: int, wait: Callable[[float], None]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, began, over = make(attempt), time.monotonic(), False
        for batch in batches:
            out = []
            for request, delay in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                response = usage = status = error = None
                if not over:
                    wait(max(0.0, began + delay - time.monotonic()))
                    try:
                        response, usage = model(request)
                    except Exception as e:  # a failed request is a row, whatever the client raises
                        error = f"{type(e).__name__}: {e}"[:1000]
                        said = _STATUS.search(error)
                        status = getattr(e, "status", None) or (int(said[1]) if said else None)
                        over = bool(_GLOBAL.search(error))
                out.append((None if over and error is None else attempt, response, usage, status, error))
            kinds = (pa.int32(), pa.string(), pa.string(), pa.int32(), pa.string())
            cols = list(zip(*out, strict=True)) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], [*batch.schema.names[:3], "attempt", "response", "usage", "status", "error"])

    return run


def ask_with_policy(requests: DataFrame, make: Callable[[int], Recognizer], attempts: int = 3, fail_fast: bool = False, folder: str | None = None, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """(doc_id, page, attempt, outcome, response, usage, status, error): one row for each request, with the attempt that decided it.

    Errors are rows, not failed tasks. After each attempt its rows are written to ``folder`` (None: a new shared one), so no answer is asked
    for twice when an executor is lost, and only those that the retry policy gives another chance are asked again, each after its
    delay (a task waits once for all its rows). ``make(attempt)`` runs once a task: later attempts may ask for less. A failure that
    concerns every request (no permission, no such model) ends its task's calls at once and all further attempts: what was not
    answered by then is cancelled.

    Null requests are asked as ''. Repeated rows are asked each. A client's error may tell its HTTP status as ``status`` or in its text; without
    one it counts as no response. An empty table gives no rows.
    """
    spark = requests.sparkSession
    folder = folder or shared_folder(spark, "asked")
    left = requests.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("page").cast("int").alias("page"), t.text("request").alias("request"), F.lit(0.0).alias("delay"))
    results = []
    for attempt in range(1, attempts + 1):
        path = f"{folder}/attempt-{attempt}"
        left.mapInArrow(_attempt(make, attempt, wait), _ASKED).write.parquet(path)
        policy = retry_policy(F.col("status"), F.col("error"), F.lit(attempt), attempts, fail_fast=fail_fast)
        fate = F.when(F.col("attempt").isNull(), CANCELLED).when(F.col("error").isNull(), DONE).when(t.is_global_failure("error"), GLOBAL).when(policy["retry"], AGAIN).otherwise(FAILED)
        asked = spark.read.schema(_ASKED).parquet(path).withColumn("outcome", fate).withColumn("delay", policy["delay"])
        found = {r["outcome"] for r in asked.select("outcome").distinct().collect()}  # five values at most
        over = bool({GLOBAL, CANCELLED} & found)
        results.append(asked.withColumn("outcome", F.when(F.col("outcome") == AGAIN, CANCELLED).otherwise(F.col("outcome"))) if over else asked.where(F.col("outcome") != AGAIN))
        if over or AGAIN not in found:
            break
        left = asked.where(F.col("outcome") == AGAIN).select("doc_id", "page", "request", "delay")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out.select("doc_id", "page", "attempt", "outcome", "response", "usage", "status", "error")


def answered(outcomes: DataFrame, publish_partial: bool = True) -> DataFrame:
    """The outcomes, if a document may be published from them: a failure of all requests, or any without ``publish_partial``, is an error that names its page. Failed pages get placeholders from :func:`sheafline.operators.state.with_placeholders`."""
    bad = F.col("outcome") == GLOBAL if publish_partial else F.col("outcome") != DONE
    first = outcomes.where(bad).orderBy(F.col("outcome") != GLOBAL, "doc_id", "page").select("doc_id", "page", "error").limit(1).collect()
    if first:
        raise RuntimeError(f"document {first[0]['doc_id']}, page {first[0]['page']}: {first[0]['error']}")
    return outcomes
