"""Transport policies as expressions: retries, payload profiles, event streams, views and requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.functions.text import let, text

# ---- fixed values: crops of a page (label, left, top, right, bottom as shares) --------------
AUDIT_VIEWS = [("full", 0.0, 0.0, 1.0, 1.0), ("upper", 0.0, 0.0, 1.0, 0.55), ("lower", 0.0, 0.45, 1.0, 1.0), ("right", 0.45, 0.0, 1.0, 1.0)]
MARKDOWN_VIEWS = [("full", 0.0, 0.0, 1.0, 1.0), ("upper", 0.0, 0.0, 1.0, 0.45), ("middle", 0.0, 0.30, 1.0, 0.75), ("lower", 0.0, 0.60, 1.0, 1.0), ("right", 0.45, 0.0, 1.0, 1.0), ("geometry", 0.0, 0.0, 1.0, 1.0)]
#: stage -> (full dpi, detail dpi, jpeg quality, least quality); the geometry view's quality is 18 lower, 72 at least.
LIMITS = {"audit": (280, 420, 90, 80), "markdown": (300, 500, 94, 84)}
#: stage -> profile -> (full dpi floor, full dpi less, detail floor, detail less, quality less)
PROFILES = {
    "audit": [("quality", 0, 0, 0, 0, 0), ("balanced", 250, 20, 380, 30, 2), ("compact", 230, 40, 350, 60, 5), ("emergency", 210, 60, 320, 90, 8)],
    "markdown": [("quality", 0, 0, 0, 0, 0), ("balanced", 270, 20, 410, 30, 2), ("compact", 250, 50, 380, 60, 4), ("emergency", 230, 80, 350, 90, 8)],
}
# ----------------------------------------------------------------------------------------------


def retry_policy(status: Column, message: Column, attempt: Column, attempts: int = 3, base: float = 2.0, most: float = 20.0, fail_fast: bool = False) -> Column:
    """struct<retry, delay>: what to do after a failed attempt (null status: no response)."""
    m = F.lower(text(message))
    has = lambda s: F.contains(m, F.lit(s))
    never = (attempt >= attempts) | m.rlike("invalid api key|authentication failed|permission denied") | (status.isNotNull() & ~status.isin(408, 409, 425, 429) & (status < 500))
    limited = F.coalesce(status == 429, F.lit(False)) | has("rate limit")
    delay = F.when(limited, F.least(F.lit(10.0) * attempt, F.lit(20.0))).when(has("overloaded"), F.least(F.lit(5.0) * attempt, F.lit(15.0))).otherwise(F.least(F.pow(F.lit(base), attempt), F.lit(most)))
    retry = ~F.coalesce(never, F.lit(False)) & ~(limited & F.lit(fail_fast))
    return F.struct(retry.alias("retry"), F.when(retry, delay).otherwise(F.lit(0.0)).cast("double").alias("delay"))


def legacy_retry_policy(message: Column, attempt: Column, attempts: int = 3, base: int = 2, most: int = 20) -> Column:
    """struct<retry, delay> of the earlier policy: longer waits after a rate limit (60 s) or overload (30 s)."""
    m = F.lower(text(message))
    wait = F.least(F.pow(F.lit(base), attempt), F.lit(most)).cast("int")
    delay = F.when(F.contains(m, F.lit("timeout")), wait).when(m.rlike("429|rate limit"), F.greatest(wait, F.lit(60))).when(F.contains(m, F.lit("overloaded")), F.greatest(wait, F.lit(30))).otherwise(wait)
    retry = ~m.rlike("invalid api key|authentication failed|permission denied") & (attempt < attempts)
    return F.struct(retry.alias("retry"), F.when(retry, delay).otherwise(0).alias("delay"))


def retry_after_seconds(header: Column, now: Column) -> Column:
    """Seconds of a Retry-After header: a number, or an HTTP date less ``now``; never negative, null if unreadable."""
    seconds = header.try_cast("double")
    at = F.try_to_timestamp(F.regexp_replace(F.trim(header), r"^[A-Za-z]+, | GMT$", ""), F.lit("d MMM yyyy HH:mm:ss"))
    wait = F.coalesce(seconds, (F.unix_timestamp(at) - F.unix_timestamp(now)).cast("double"))
    return F.when(wait.isNotNull(), F.greatest(F.lit(0.0), wait))


def profiles(stage: str, most: int = 4) -> list[tuple[int, str, int, int, int]]:
    """(rank, name, full dpi, detail dpi, jpeg quality) from best to lightest, equal ones once."""
    full, detail, quality, least_quality = LIMITS[stage]
    seen: dict[tuple[int, int, int], str] = {}
    for name, floor, less, detail_floor, detail_less, worse in PROFILES[stage][:most]:
        values = (max(floor, full - less), max(detail_floor, detail - detail_less), quality if not worse else max(least_quality, quality - worse))
        seen.setdefault(values, name)
    return [(i, name, *values) for i, (values, name) in enumerate(seen.items())]


def first_fitting_profile(pages: DataFrame, stage: str, size_mb: Column, budget_mb: float = 14.0) -> DataFrame:
    """Each page with the best profile whose body fits the budget, the lightest (and fits false) if none does or its size is unknown.

    ``size_mb`` may use full_dpi, detail_dpi and quality. The profiles are tried inside the row: no shuffle, repeated pages stay.
    """
    rows, found = pages, []
    for rank, name, full, detail, quality in profiles(stage):
        tried = rows.select("*", F.lit(full).alias("full_dpi"), F.lit(detail).alias("detail_dpi"), F.lit(quality).alias("quality"))
        rows = tried.select(*rows.columns, size_mb.alias(f"_mb{rank}"))
        found.append((F.lit(name), F.col(f"_mb{rank}")))
    made = lambda name, mb, fits: F.struct(name.alias("profile"), mb.alias("body_mb"), F.lit(fits).alias("fits"))
    choice = F.coalesce(*[F.when(mb <= budget_mb, made(name, mb, True)) for name, mb in found], made(*found[-1], False))
    return rows.withColumn("_c", choice).select(*pages.columns, "_c.profile", "_c.body_mb", "_c.fits")


def use_prompt_cache(pages: Column, workers: int, forced: bool = False) -> Column:
    """The provider's prompt cache pays only with more pages than workers."""
    return (pages > workers) | F.lit(forced)


def view_rows(stage: str, rank: int = 0) -> list[tuple[int, str, list[float], int, int]]:
    """(position, label, rect, dpi, quality): the crops of a page, four for the audit and six for the Markdown, under the profile of a rank."""
    _, _, full, detail, quality = profiles(stage)[rank]
    views = AUDIT_VIEWS if stage == "audit" else MARKDOWN_VIEWS
    return [(i, v[0], list(v[1:]), full if v[0] in ("full", "geometry") else detail, max(72, quality - 18) if v[0] == "geometry" else quality) for i, v in enumerate(views)]


def page_views(stage: Column, rank: int = 0) -> Column:
    """array<struct<position, label, rect, dpi, quality>>: the views that a page needs for its stage (audit or markdown; null for others). Literals in the page's row: no join."""

    def listed(name: str) -> Column:
        one = lambda v: F.struct(F.lit(v[0]).alias("position"), F.lit(v[1]).alias("label"), F.array(*map(F.lit, v[2])).alias("rect"), F.lit(v[3]).alias("dpi"), F.lit(v[4]).alias("quality"))
        return F.array(*map(one, view_rows(name, rank)))

    return F.when(stage == "audit", listed("audit")).when(stage == "markdown", listed("markdown"))


def view_specifications(spark: SparkSession, stage: str, rank: int = 0) -> DataFrame:
    """The views of a stage as a table."""
    return spark.createDataFrame(view_rows(stage, rank), "position int, label string, rect array<double>, dpi int, quality int")


def sse_events(stream: Column | str) -> Column:
    """array<string>: the data of each server-sent event. Comments are skipped, data lines of one event joined, and bare JSON or [DONE] lines tolerated.

    Blank lines divide events, so each is a piece of the text between them.
    """
    data = lambda x: F.when(F.startswith(x, F.lit("data:")), F.ltrim(F.substring(x, F.lit(6), F.length(x)))).when(x.rlike(r"^\s*(\{|\[DONE\])") & ~F.startswith(x, F.lit(":")), F.trim(x))
    found = lambda piece: F.array_compact(F.transform(F.split(piece, "\n", -1), data))
    pieces = F.split(F.regexp_replace(text(stream), r"\r\n|\r", "\n"), r"\n{2,}", -1)
    return F.transform(F.filter(F.transform(pieces, found), lambda e: F.size(e) > 0), lambda e: F.array_join(e, "\n"))


def stream_text(stream: Column | str) -> Column:
    """struct<content, reasoning, finish_reason, error> accumulated over the events of a response, which are taken apart once."""

    def of(events: Column) -> Column:
        joined = lambda path: F.array_join(F.transform(events, lambda e: F.coalesce(F.get_json_object(e, path), F.lit(""))), "")
        reasons = F.array_compact(F.transform(events, lambda e: F.get_json_object(e, "$.choices[0].finish_reason")))
        return F.struct(
            joined("$.choices[0].delta.content").alias("content"),
            joined("$.choices[0].delta.reasoning_content").alias("reasoning"),
            let(reasons, lambda r: F.get(r, F.size(r) - 1)).alias("finish_reason"),
            F.get(F.filter(F.transform(events, stream_error), lambda m: m != ""), F.lit(0)).alias("error"),
        )

    return let(F.filter(sse_events(stream), lambda e: e != "[DONE]"), of)


def stream_error(event: Column) -> Column:
    """The error that an event carries, at most 800 characters; '' if none."""
    error, code, message = (F.get_json_object(event, f"$.{k}") for k in ("error", "code", "message"))
    coded = F.to_json(F.struct(code.alias("code"), message.alias("message")))
    return F.coalesce(F.left(F.when(F.coalesce(error, F.lit("")) != "", error).when(code.isNotNull() | message.isNotNull(), coded), F.lit(800)), F.lit(""))


def request_messages(prompt: Column, views: Column) -> Column:
    """Chat messages as JSON: the prompt, then each view's label and image."""
    first = F.to_json(F.struct(F.lit("text").alias("type"), prompt.alias("text")))
    each = F.transform(views, lambda v: F.concat(F.to_json(F.struct(F.lit("text").alias("type"), v["label"].alias("text"))), F.lit(","), F.to_json(F.struct(F.lit("image_url").alias("type"), F.struct(v["data_url"].alias("url")).alias("image_url")))))
    return F.concat(F.lit('[{"role":"user","content":['), F.concat_ws(",", F.concat(F.array(first), each)), F.lit("]}]"))


