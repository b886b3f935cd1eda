"""Exact top-k inner products through a pivot-distance index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheafline.llm.common import discard, stored

#: Vectors in a block of the index, about.
BLOCK = 1024
#: Queries that meet a block of vectors in one task, about.
QUERIES = 8192
#: Blocks and query blocks whose bounds one task compares, about.
PLANNED = 2048
#: Scores beyond 64-bit integers are held at their ends.
LEAST, MOST = -(2**63), 2**63 - 1


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, v array<double>): floor(scale * x) of each component as double, whole numbers. Null ids or vectors, and vectors with null or non-finite components (also after scaling), are left out."""
    v = F.transform(F.col(embedding).cast("array<double>"), lambda c: c * F.lit(float(scale)))
    fine = F.col(vec_id).isNotNull() & v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    # floor() gives longs; doubles of 2**53 and more are whole already
    whole = F.transform(v, lambda c: F.when(F.abs(c) < 2.0**53, F.floor(c).cast("double")).otherwise(c))
    return vectors.where(F.coalesce(fine, F.lit(False))).select(F.col(vec_id).cast("long").alias("vec_id"), whole.alias("v"))


def choose_pivots(vectors: DataFrame, pivots: int, sample: int = 4096) -> np.ndarray:
    """Pivots by farthest-first traversal of about ``sample`` vectors chosen by hashed id; only pruning depends on them, never the result."""
    n = vectors.count()
    rows = vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) <= int(min(1.0, sample / max(1, n)) * (1 << 30))).collect()
    if not rows:
        return np.empty((0, 1))
    rows.sort(key=lambda r: (r["vec_id"], r["v"]))
    width = max(len(r["v"]) for r in rows)
    x = np.array([r["v"] for r in rows if len(r["v"]) == width], np.float64)
    with np.errstate(over="ignore", invalid="ignore"):
        chosen, far = [0], np.nan_to_num(np.linalg.norm(x - x[0], axis=1), nan=0.0)
        while len(chosen) < min(pivots, len(x)) and far.max() > 0:
            chosen.append(int(np.argmax(far)))
            far = np.minimum(far, np.nan_to_num(np.linalg.norm(x - x[chosen[-1]], axis=1), nan=0.0))
    return x[chosen]


def distances(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper ends of each vector's distance from each pivot, as wide as rounding can reach. Pivots of another width tell nothing: 0 to infinity."""
    if not len(pivots) or pivots.shape[1] != x.shape[1]:
        return np.zeros((len(x), 1)), np.full((len(x), 1), np.inf)
    with np.errstate(over="ignore", invalid="ignore"):
        size = (x**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)
        square, error = size - 2 * x @ pivots.T, 1e-15 * (x.shape[1] + 8) * size
        return np.sqrt(np.nan_to_num(np.maximum(square - error, 0), nan=0.0)), np.sqrt(np.nan_to_num(np.maximum(square, 0) + error, nan=np.inf))


def upper_bound(q_norm: np.ndarray, norm: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """What an inner product can be at most: (|q|^2 + |x|^2 - |q - x|^2) / 2, with room for rounding."""
    with np.errstate(over="ignore", invalid="ignore"):
        found = ((q_norm**2 + norm**2) * (1 + 1e-12) - gap**2 * (1 - 1e-12)) / 2 + 1e-3
    return np.nan_to_num(found, nan=np.inf, posinf=np.inf)


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products (queries x vectors): in doubles while every partial sum is below 2**52, else in Python's integers, held within 64 bits."""
    if not len(q) or not len(x) or np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, q.shape[1]) < 2**52:
        return (q @ x.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(whole(q) @ whole(x).T, LEAST, MOST).astype(np.int64)


def _lists(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each width that occurs in a column of lists."""
    rows = col.to_pylist()
    for width in sorted({len(r) for r in rows}):
        at = np.array([i for i, r in enumerate(rows) if len(r) == width])
        yield at, np.array([rows[i] for i in at], np.float64).reshape(len(at), width)


_KEYED = "vec_id long, v array<double>, width int, pivot int, dist double, low double, high double, norm double"


def _keyed(points):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width, pivot = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int32)
            low, high, norm = (np.zeros(batch.num_rows) for _ in range(3))
            for at, x in _lists(batch.column(1)):
                near, far = distances(x, points.value)
                nearest = np.argmin(near, axis=1)
                width[at], pivot[at], low[at], high[at] = x.shape[1], nearest, near[np.arange(len(at)), nearest], far[np.arange(len(at)), nearest]
                with np.errstate(over="ignore"):
                    norm[at] = np.sqrt((x**2).sum(axis=1))
            dist = np.where(np.isfinite(high), (low + high) / 2, low)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, (width, pivot, dist, low, high, norm))], [c.split()[0] for c in _KEYED.split(", ")])

    return run


def _planned(k: int):
    """Blocks that a block of queries must still search: bounds of some thousand blocks of vectors against some thousand blocks of queries."""

    def run(blocks: pa.Table, asked: pa.Table) -> pa.Table:
        found: list[tuple[str, str]] = []
        if blocks.num_rows and asked.num_rows:
            b = {c: blocks[c].to_numpy() for c in ("pivot", "near", "far", "norm")}
            names, own = np.array(blocks["block"].to_pylist(), object), blocks["cell"].to_pylist()
            for qblock, cell, near, far, norm, floor in zip(*(asked[c].to_pylist() for c in ("qblock", "cell", "near", "far", "norm", "floor")), strict=True):
                near, far = np.array(near), np.array(far)
                pivot = np.minimum(b["pivot"], len(near) - 1)
                gap = np.maximum(0, np.maximum(b["near"] - far[pivot], near[pivot] - b["far"]))
                wanted = upper_bound(norm, b["norm"], gap) >= (-np.inf if floor is None else floor)
                found += [(qblock, names[i]) for i in np.flatnonzero(wanted) if own[i] != cell]
        return pa.table({"qblock": pa.array([x[0] for x in found], pa.string()), "block": pa.array([x[1] for x in found], pa.string())})

    return run


def _ranges(points):
    """A block of queries by what planning needs: its distances from every pivot (least, greatest), its largest norm and its least k-th score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None

        def out() -> pa.RecordBatch:
            width, cell, near, far, norm, floor = state
            return pa.RecordBatch.from_arrays(
                [pa.array([at]), pa.array([width], pa.int32()), pa.array([cell]), pa.array([near.tolist()], pa.list_(pa.float64())), pa.array([far.tolist()], pa.list_(pa.float64())), pa.array([norm]), pa.array([floor], pa.int64())],
                ["qblock", "width", "cell", "near", "far", "norm", "floor"],
            )

        for batch in batches:
            rows = batch.to_pydict()
            for i, name in enumerate(rows["qblock"]):
                x = np.array([rows["v"][i]], np.float64).reshape(1, -1)
                near, far = (d[0] for d in distances(x, points.value))
                norm, floor = rows["norm"][i], rows["floor"][i]
                if name != at:
                    if at is not None:
                        yield out()
                    at, state = name, (rows["width"][i], rows["cell"][i], near, far, norm, floor)
                else:
                    width, cell, a, b, c, d = state
                    state = width, cell, np.minimum(a, near), np.maximum(b, far), max(c, norm), None if d is None or floor is None else min(d, floor)
        if at is not None:
            yield out()

    return run


def _scanned(k: int):
    """Rows (block, part, kind, id, v), sorted: the queries of a part, then the vectors of its block. k best of each query."""

    def best(ids: list[int], q: list, xs: list[int], x: list) -> pa.RecordBatch:
        xi, xm, found = np.array(xs, np.int64), np.array(x, np.float64).reshape(len(x), len(x[0])), []
        order = np.argsort(xi, kind="stable")
        xi, xm = xi[order], xm[order]
        for i in range(0, len(q), BLOCK):
            part = np.array(q[i : i + BLOCK], np.float64).reshape(len(q[i : i + BLOCK]), xm.shape[1])
            for one, row in zip(ids[i : i + BLOCK], exact_scores(part, xm), strict=True):
                usable = np.flatnonzero(xi != one)
                if len(usable) > k:
                    edge = np.partition(row[usable], len(usable) - k)[len(usable) - k]
                    usable = usable[row[usable] >= edge]
                top = usable[np.argsort(~row[usable], kind="stable")][:k]  # ~s falls as s rises, without overflow; ids are in order
                found += [(one, int(xi[j]), int(row[j])) for j in top]
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(3)], ["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, q, xs, x = None, [], [], [], []
        for batch in batches:
            for block, part, kind, i, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (block, part) != at:
                    if xs and ids:
                        yield best(ids, q, xs, x)
                    at, ids, q, xs, x = (block, part), [], [], [], []
                if not kind:
                    ids.append(i)
                    q.append(v)
                    continue
                xs.append(i)
                x.append(v)
                if len(xs) >= 4 * BLOCK:  # a block larger than planned goes on in pieces
                    yield best(ids, q, xs, x)
                    xs, x = [], []
        if xs and ids:
            yield best(ids, q, xs, x)

    return run


def exact_top_k(vectors: DataFrame, k: int = 5, every: int = 50, pivots: int = 32, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): the k highest integer inner products of each query (ids divisible by ``every``) with all other vectors; ties go to the smaller id.

    Index: each vector is keyed by its nearest pivot and its distance to it; a pivot's vectors, sorted by
    distance, are cut into annuli of about BLOCK vectors. For a query at distance d from the pivot, a vector at
    distance r is at least |d - r| away, so its inner product is at most
    (|q|^2 + N^2 - |d - r|^2) / 2 with N the annulus's largest norm. Queries first search the annulus they lie in
    themselves, which gives a floor for the k-th score; then the search goes on to all annuli whose bound
    reaches the floor, and stops there. Bounds leave room for rounding, so results are exact for any data.

    Queries of one annulus form a block; bounds hold for whole blocks of queries and of vectors, and tasks compare some
    thousand of each. A task that searches holds a block of vectors and about QUERIES queries. Nothing is broadcast but the
    pivots and a row for each of them. Vectors of differing widths are only compared with their own width.

    Vectors null or holding null or non-finite components take no part; empty vectors score 0 with each other. Fewer than k
    others: all of them. Scores beyond 64 bits are held at the ends of that range, and ranked so. Repeated rows with one id
    stay separate candidates, but no candidate of the query's own id counts; rows that share a query id give one result, that of the
    least vector (component by component). An empty table gives no rows; extra columns are ignored.
    """
    base = quantised(vectors, vec_id, embedding, scale)
    points = vectors.sparkSession.sparkContext.broadcast(choose_pivots(base, pivots))
    keyed = stored(base.mapInArrow(_keyed(points), _KEYED), "keyed")
    # annuli: equal shares of each pivot's distances, cut at approximate quantiles (their exactness does not matter); a row for each width and pivot
    cells = keyed.groupBy("width", "pivot").agg(F.count("*").alias("n"), F.percentile_approx("dist", [i / 64 for i in range(1, 64)], 1000).alias("edges"))
    rings = F.least(F.lit(64), F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCK))).cast("int")
    edges = F.array_distinct(F.filter("edges", lambda e, i: (i + 1) % F.greatest(F.lit(1), F.floor(64 / rings)) == 0))
    cells = cells.select("width", "pivot", edges.alias("edges"), F.ceil(F.col("n") / rings / BLOCK).cast("long").alias("salts"))
    blocked = keyed.join(F.broadcast(cells), ["width", "pivot"]).withColumn("cell", F.concat_ws("-", "width", "pivot", F.size(F.filter("edges", lambda e: e < F.col("dist")))))
    blocked = blocked.withColumn("block", F.concat_ws("-", "cell", F.pmod(F.xxhash64("vec_id"), "salts"))).drop("edges", "salts")
    annuli = stored(blocked.groupBy("block", "cell", "width", "pivot").agg(F.min("low").alias("near"), F.max("high").alias("far"), F.max("norm").alias("norm")), "annuli")
    asked = keyed.where(F.col("vec_id") % every == 0).select("vec_id").distinct()
    asked = blocked.join(asked, "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("v", "width", "norm", "cell", "block")).alias("q")).select(F.col("vec_id").alias("query_id"), "q.*")
    asked = stored(asked.withColumnRenamed("block", "qblock"), "asked")

    def search(wanted: DataFrame) -> DataFrame:
        """k best of each query in each block that is wanted by its block of queries."""
        parts = asked.groupBy("qblock").agg(F.count("*").alias("n")).join(wanted, "qblock")
        per = parts.groupBy("block").agg(F.ceil(F.sum("n") / QUERIES).alias("parts"))
        dealt = parts.join(per, "block").select("qblock", "block", F.pmod(F.xxhash64("qblock"), "parts").alias("part"))
        q = dealt.join(asked, "qblock").select("block", "part", F.lit(0).alias("kind"), F.col("query_id").alias("id"), "v")
        x = blocked.join(dealt.select("block", "part").distinct(), "block").select("block", "part", F.lit(1).alias("kind"), F.col("vec_id").alias("id"), "v")
        rows = q.unionByName(x).repartition("block", "part").sortWithinPartitions("block", "part", "kind")
        return rows.mapInArrow(_scanned(k), "query_id long, vec_id long, score long")

    def ranked(found: DataFrame) -> DataFrame:
        by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)

    own = asked.select("qblock", "cell").distinct().join(annuli.select("cell", "block"), "cell").select("qblock", "block")
    first = stored(ranked(stored(search(own), "found")).drop("rank"), "first")
    floor = first.groupBy("query_id").agg(F.min("score").alias("floor"), F.count("*").alias("n")).select("query_id", F.when(F.col("n") >= k, F.col("floor")).alias("floor"))
    ranges = asked.join(floor, "query_id", "left").select("qblock", "width", "cell", "v", "norm", "floor").repartition("qblock").sortWithinPartitions("qblock")
    ranges = stored(ranges.mapInArrow(_ranges(points), "qblock string, width int, cell string, near array<double>, far array<double>, norm double, floor long"), "ranges")
    # every block of queries meets every block of vectors of its width, PLANNED of each at a time
    sizes = [max(1, -(-t.count() // PLANNED)) for t in (annuli, ranges)]
    up_to = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    mine = annuli.withColumn("deal", F.pmod(F.xxhash64("block"), F.lit(sizes[0])).cast("int")).withColumn("qdeal", up_to(sizes[1]))
    theirs = ranges.withColumn("qdeal", F.pmod(F.xxhash64("qblock"), F.lit(sizes[1])).cast("int")).withColumn("deal", up_to(sizes[0]))
    to = ["width", "deal", "qdeal"]
    rest = stored(mine.groupBy(*to).cogroup(theirs.groupBy(*to)).applyInArrow(_planned(k), "qblock string, block string"), "rest")
    found = first.unionByName(stored(search(rest), "second"))
    discard(annuli, ranges, rest)
    return ranked(found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
