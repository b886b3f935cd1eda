"""Mixing sources to target weights by Poisson replication, in DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import join_with_hot, neutral_names

#: Repetitions that one Poisson draw stands for at most; a larger rate is the sum of several independent draws.
DRAW_RATE = 64.0
#: Weighted sources up to which their rows (about 1.5 KB each) are broadcast.
BROADCAST_SOURCES = 5000
#: Rows of the result in a partition, about, where the session's number of shuffle partitions would give more.
PARTITION_ROWS = 100_000


def uniform(*parts: Column | str, seed: str) -> Column:
    """A number in [0, 1) from the first 52 bits of md5 over the parts and the seed, joined by ':'."""
    text = F.concat_ws(":", *[(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts], F.lit(seed))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


@neutral_names
def mix_sources(
    documents: DataFrame,
    weights: dict[str, float] | None = None,
    total: float | None = None,
    source: str = "source",
    doc_id: str = "doc_id",
    seed: str = "mix-1",
    max_rate: float | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Each document as often as a Poisson draw with its source's repetition rate says, globally shuffled.

    A source's rate is ``total * weight / rows``: ``weights`` (normalised over the sources
    present; None: all alike) say what share of the result each should make up, ``total``
    (None: the number of rows) how many rows. However few rows a source has, it reaches its share; only a
    ``max_rate`` that the caller sets holds rates, and the result then falls short. Sources without a weight have rate 0.

    The count inverts the Poisson distribution: how many values of its distribution function
    do not exceed a uniform number hashed from id and seed, so the same seed gives the same
    mixture on any cluster. A rate above DRAW_RATE is dealt evenly over ceil(rate / DRAW_RATE) draws, each with a
    uniform number of its own, whose sum has the Poisson distribution of the whole rate. The functions stand in one row for each weighted source; those rows
    are broadcast up to BROADCAST_SOURCES of them. Beyond, sources of a thousandth of all rows or more are, and the others joined by a shuffle.

    Adds rate (double), copy (int, from 0), order_key (double): rows come partitioned by
    ranges of order_key and sorted by (order_key, doc_id, copy), a global random order. The keys are uniform, so the ranges are equal
    and need no sampling pass: rows are drawn once and texts move once. Null sources form a source of
    their own, named '' in ``weights``. Null ids hash as ''. Rows that share an id share their draw.
    Columns with these names are replaced. An empty table gives no rows.
    """
    docs = documents.drop("rate", "copy", "order_key").withColumn("_s", F.coalesce(F.col(source).cast("string"), F.lit("")))
    sizes = docs.groupBy("_s").agg(F.count("*").alias("_n"))
    if weights is None:
        sizes = sizes.withColumn("_w", F.lit(1.0))
    else:
        share = F.create_map(*[F.lit(x) for k, w in weights.items() for x in (k, float(w))]) if weights else None
        sizes = sizes.withColumn("_w", F.coalesce(F.try_element_at(share, F.col("_s")), F.lit(0.0)) if weights else F.lit(0.0))
    whole = sizes.agg(F.sum("_n"), F.sum("_w"), F.sum((F.col("_w") > 0).cast("int"))).first()
    target, weight, named = float(total if total is not None else whole[0] or 0), whole[1] or 1.0, whole[2] or 0
    rate = F.lit(target) * F.col("_w") / F.lit(float(weight)) / F.col("_n")
    if max_rate is not None:
        rate = F.least(F.lit(float(max_rate)), rate)
    rates = sizes.where("_w > 0").select("_s", rate.alias("rate"), F.col("_n").alias("_rows"))
    rates = rates.withColumn("_draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / DRAW_RATE)).cast("int"))
    one = F.col("rate") / F.col("_draws")
    # distribution function, term by term: p(0) = exp(-rate), p(k) = p(k-1) * rate / k; less than one row in 2**52 lies beyond its last
    k = F.sequence(F.lit(1), F.ceil(one + 9 * F.sqrt(one) + 25).cast("int"))
    start = F.struct(F.exp(-one).alias("p"), F.array(F.exp(-one)).alias("c"))
    grown = F.aggregate(
        k, start, lambda acc, i: F.struct((acc["p"] * one / i).alias("p"), F.concat(acc["c"], F.array(F.element_at(acc["c"], -1) + acc["p"] * one / i)).alias("c")), lambda acc: acc["c"]
    )
    rates = rates.withColumn("_cdf", grown)
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    drawn = docs.join(F.broadcast(rates), "_s") if named <= BROADCAST_SOURCES else join_with_hot(docs, rates, ["_s"], F.col("_rows") * 1000 >= F.lit(whole[0] or 0))

    def count(u: Column) -> Column:
        """How many values of the distribution function do not exceed u; u stands once in the expression, so it is computed once."""
        start = F.struct(u.alias("u"), F.lit(0).alias("n"))
        return F.aggregate("_cdf", start, lambda acc, c: F.struct(acc["u"].alias("u"), (acc["n"] + (c <= acc["u"]).cast("int")).alias("n")), lambda acc: acc["n"])

    more = F.transform(F.sequence(F.lit(1), F.col("_draws") - 1), lambda j: uniform(key, j, seed=seed + "-draw"))
    more = F.aggregate(more, F.lit(0), lambda n, u: n + F.size(F.filter("_cdf", lambda c: c <= u)))
    times = count(uniform(key, seed=seed)) + F.when(F.col("_draws") > 1, more).otherwise(0)
    out = drawn.select("*", F.posexplode(F.array_repeat(F.lit(True), times)).alias("copy", "_one")).drop("_cdf", "_draws", "_rows", "_s", "_one")
    out = out.withColumn("order_key", uniform(key, "copy", seed=seed + "-order"))
    parts = partitions or max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(target / PARTITION_ROWS))
    return out.repartitionById(parts, F.floor(F.col("order_key") * parts).cast("int")).sortWithinPartitions("order_key", doc_id, "copy")
