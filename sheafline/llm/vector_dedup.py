"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations, with multiprobe buckets and exact verification."""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import discard, join_with_hot, mix, stored
from sheafline.llm.components import components

#: Vectors are padded with zeros to a power of two, at least this.
LEAST_WIDTH = 64
#: Chance that all tables miss a pair exactly at the threshold; closer pairs are missed less.
MISS = 1e-8
#: Vectors of one label that a bucket holds, about, were they spread evenly; more vectors take longer keys.
BUCKET = 128
#: Bits of a vector's signature: two longs.
SIGNS = 128
#: Hash values in a sharp key, and sharp keys of a vector; vectors that share one may form a ball.
SHARP, SHARP_KEYS, CROWD, SAMPLE = 3, 4, 8, 256
#: Vectors that one task of a pair of balls holds of either ball.
BLOCK = 1024
#: Angles closer to a bound than this are settled by the cosine itself.
SLACK = 1e-6
#: Rows up to which a table of centres is broadcast (24 bytes a row and a hash entry).
BROADCAST_ROWS = 200_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal Walsh-Hadamard transform of each row, in n log n steps."""
    n, h = x.shape[1], 1
    while h < n:
        pairs = x.reshape(len(x), -1, 2, h)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x / math.sqrt(n)


def rotated(x: np.ndarray, number: int) -> np.ndarray:
    """Pseudo-random rotation ``number``: three rounds of hashed signs and a Hadamard transform."""
    for signs in _signs(x.shape[1], number):
        x = hadamard(x * signs)
    return x


@functools.lru_cache(4096)
def _signs(width: int, number: int) -> np.ndarray:
    return np.random.default_rng((number, width)).choice([-1.0, 1.0], (3, width))


def table_keys(x: np.ndarray, table: int, hashes: int, probes: int) -> np.ndarray:
    """(rows, probes): the keys of a table, best first.

    A hash is the nearest of the 2 n unit vectors along the axes after a rotation; a key joins ``hashes`` of them. Further
    keys take other near axes, in ascending order of the squared distances lost.
    """
    near = probes if hashes == 1 else min(4, probes)
    values, lost = [], []
    for k in range(hashes):
        z = rotated(x, table * 16 + k)
        best = np.argsort(-np.abs(z), axis=1, kind="stable")[:, :near]
        at = np.take_along_axis(z, best, 1)
        values.append((2 * best + (at > 0)).astype(np.uint64))
        lost.append((np.abs(at[:, :1]) - np.abs(at)) ** 2)
    choices = list(itertools.product(range(near), repeat=hashes))
    cost = np.stack([sum(lost[k][:, c[k]] for k in range(hashes)) for c in choices], 1)
    first = np.argsort(cost, axis=1, kind="stable")[:, :probes]
    keys = np.full((len(x), len(choices)), np.uint64(table + 1))
    for k in range(hashes):
        keys = mix(keys + values[k][:, [c[k] for c in choices]])
    return np.take_along_axis(keys, first, 1)


def signatures(x: np.ndarray) -> np.ndarray:
    """(rows, 2) longs: which of SIGNS rotated coordinates are positive."""
    width = x.shape[1]
    z = np.concatenate([rotated(x, 10_000_000 + i) for i in range(-(-SIGNS // width))], 1)[:, :SIGNS]
    return np.packbits(z > 0, axis=1).view(np.int64)


def signature_limit(angle: float) -> int:
    """Bits in which two vectors at this angle differ at most, but for seven standard deviations."""
    share = min(0.5, angle / math.pi)
    return math.ceil(SIGNS * share + 7 * math.sqrt(SIGNS * share * (1 - share)))


def plan_tables(width: int, rows: int, cosine: float) -> tuple[int, int, int]:
    """(hashes in a key, probes, tables) for ``rows`` vectors of one label: the share of seeded random pairs exactly at ``cosine`` that one table brings
    together gives how many tables miss a pair with a chance of MISS."""
    hashes = max(1, math.ceil(math.log(max(rows, 2) / BUCKET) / math.log(2 * width)))
    probes = 2 * hashes + 1
    rng = np.random.default_rng(7)
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in rng.normal(size=(2, 4096, width)))
    y -= (x * y).sum(1, keepdims=True) * x
    y = cosine * x + math.sqrt(max(0.0, 1 - cosine**2)) * y / np.linalg.norm(y, axis=1, keepdims=True)
    a, b = table_keys(x, 0, hashes, probes), table_keys(y, 0, hashes, probes)
    found = float(((a == b[:, :1]).any(1) | (b == a[:, :1]).any(1)).mean())
    return hashes, probes, math.ceil(math.log(MISS) / math.log(1 - min(0.999, max(0.01, found))))


def _padded(rows: list[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Power of two -> (which rows, their vectors side by side)."""
    width = np.array([max(LEAST_WIDTH, 1 << max(0, len(r) - 1).bit_length()) for r in rows], np.int64)
    out = {}
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        x = np.zeros((len(at), w))
        for n, i in enumerate(at):
            x[n, : len(rows[i])] = rows[i]
        out[w] = at, x
    return out


def _vectors(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(b, np.float64) for b in column.to_pylist()]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, dim, h1, h2, unit): unit vectors as bytes with 128 bits over the vector itself; null where a vector takes no part."""
    for batch in batches:
        rows = []
        for label, v in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            x = np.array([np.nan if c is None else c for c in v], np.float64) if v is not None and label is not None else np.empty(0)
            most = np.abs(x).max(initial=0.0)
            if not len(x) or not 0 < most < math.inf:  # also where a component is no number
                rows.append((None, None, None, None))
                continue
            x = x / most + 0.0  # huge and tiny components have finite squares; no negative zero
            h = np.frombuffer(xxhash.xxh3_128_digest(x.tobytes()), np.int64)
            rows.append((len(x), int(h[0]), int(h[1]), (x / math.sqrt(x @ x)).tobytes()))
        dim, h1, h2, unit = zip(*rows, strict=True) if rows else ([], [], [], [])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(dim, pa.int32()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(unit, pa.binary())], ["vec_id", "label", "dim", "h1", "h2", "unit"])


_KEYED = "cid long, label string, dim int, w long, unit binary, s1 long, s2 long, own array<long>, probes array<long>, sharp array<long>"


def _keyed(plans: dict[int, tuple[int, int, int]]):
    """Keys of each vector, mixed with its label and length: vectors of different labels or lengths share none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 2048):
                batch = whole.slice(k, 2048)
                own, probes, sharp, signs = ([None] * batch.num_rows for _ in range(4))
                kinds = [xxhash.xxh3_64_intdigest(f"{d}:{label}") for label, d in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
                kinds = np.array(kinds, np.uint64)
                for width, (at, x) in _padded(_vectors(batch.column(4))).items():
                    hashes, n, tables = plans[width]
                    kind = kinds[at][:, None]
                    keys = [mix(table_keys(x, t, hashes, n) ^ kind) for t in range(tables)]
                    tight = np.concatenate([mix(table_keys(x, 1_000 + t, SHARP, 1) ^ kind) for t in range(SHARP_KEYS)], 1)
                    first, more = np.concatenate([z[:, :1] for z in keys], 1), np.concatenate([z[:, 1:] for z in keys], 1)
                    for target, found in ((own, first), (probes, more), (sharp, tight), (signs, signatures(x))):
                        for i, row in zip(at, found.view(np.int64).tolist(), strict=True):
                            target[i] = row
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array([s[0] for s in signs], pa.int64()), pa.array([s[1] for s in signs], pa.int64()), *(pa.array(c, longs) for c in (own, probes, sharp))],
                    [*batch.schema.names, "s1", "s2", "own", "probes", "sharp"],
                )

    return run


def _means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k, label, dim, n, unit) come sorted by k, of each k a sample: its mean direction as (cid, label, dim, w, unit), named by k."""
    last: tuple | None = None
    total, out = None, []

    def close() -> None:
        norm = math.sqrt(total @ total) if last else 0.0
        if norm:
            out.append((*last, (total / norm).tobytes()))

    def batch_of() -> pa.RecordBatch:
        k, label, dim, n, unit = zip(*out, strict=True) if out else ([],) * 5
        return pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(label, pa.string()), pa.array(dim, pa.int32()), pa.array(n, pa.int64()), pa.array(unit, pa.binary())], ["cid", "label", "dim", "w", "unit"])

    for batch in batches:
        for k, label, dim, n, unit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            x = np.frombuffer(unit, np.float64)
            if last != (k, label, dim, n):
                close()
                last, total = (k, label, dim, n), np.zeros(dim)
            total = total + x
        yield batch_of()
        out.clear()
    close()
    yield batch_of()


def _angle(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def _angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(..., unit, other) -> (..., cosine) of the two."""
    for batch in batches:
        names = batch.schema.names[:-2]
        a, b = _vectors(batch.column(batch.num_columns - 2)), _vectors(batch.column(batch.num_columns - 1))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array([float(x @ y) for x, y in zip(a, b, strict=True)], pa.float64())], [*names, "cosine"])


def _open_pairs(cosine: float):
    """Rows (a, b, i, j, right, cid, w, unit) come sorted by (a, b, i, j), one block of either ball: (cid, links) of each vector that has links in the other block."""

    def links(left: list[tuple], right: list[tuple]) -> Iterator[tuple[int, int]]:
        if left and right:
            x, y = (np.stack([np.frombuffer(r[2], np.float64) for r in side]) for side in (left, right))
            met = x @ y.T >= cosine
            for side, other, m in ((left, right, met), (right, left, met.T)):
                yield from ((r[0], int(n)) for r, n in zip(side, m @ np.array([r[1] for r in other], np.int64), strict=True) if n)

    def batch_of(at: tuple, sides: tuple[list, list]) -> pa.RecordBatch:
        found = list(links(*sides))
        names = [pa.array([at[k]] * len(found), pa.int64()) for k in (0, 1)]
        return pa.RecordBatch.from_arrays([*names, pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], ["a", "b", "cid", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sides = None, ([], [])
        for batch in batches:
            for a, b, i, j, right, cid, w, unit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (a, b, i, j) != at:
                    if at:
                        yield batch_of(at, sides)
                    at, sides = (a, b, i, j), ([], [])
                sides[right].append((cid, w, unit))
        if at:
            yield batch_of(at, sides)

    return run


def _checked(pairs: DataFrame, a: DataFrame, b: DataFrame, schema: str) -> DataFrame:
    """The cosine of each pair: ``a`` and ``b`` bring the two vectors, each with the column that names it in ``pairs``."""
    left, right = (next(c for c in x.columns if c in pairs.columns) for x in (a, b))
    return pairs.join(a, left).join(b, right).select(*pairs.columns, "unit", "other").mapInArrow(_angles, f"{schema}, cosine double")


def _differ() -> F.Column:
    return F.bit_count(F.col("s1").bitwiseXOR(F.col("t1"))) + F.bit_count(F.col("s2").bitwiseXOR(F.col("t2")))


def vector_links(embeddings: DataFrame, cosine: float = 0.93, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``embeddings``.

    Vectors of one label and length are linked when their cosine in double precision reaches ``cosine`` (over 0). n_links counts
    the other vectors linked directly; a component is what links connect, named by its smallest id.

    1. Equal vectors (up to a positive factor that leaves them equal when divided by their largest component) are one class.
    2. Groups of near copies become balls: classes that share one of a few sharp keys give a mean direction, from a sample of about
       SAMPLE of them, and every class that lies within half the threshold's angle of a mean joins the most crowded such ball.
       All of a ball are linked with one another by the triangle inequality; no pair of them is formed.
    3. Cross-polytope hashes of fast Hadamard rotations, several in a key, deal classes into the buckets of a number of tables; a class also visits
       its next-best buckets. A pair of balls (most are one class) that meets is a candidate if its signatures of signs agree about well
       enough. Keys grow longer with the number of vectors, tables with the chance of a miss (:func:`plan_tables`).
    4. Candidates are verified: the angle of their centres settles a pair of balls, or else all cosines between their
       classes, a block of either at a time. So a pair of balls is counted once, in whatever tables it was met.

    A pair just at the threshold is missed with a chance of MISS; every link counted is exact. Null labels, null, empty, zero vectors and those with null or
    non-finite components have no links and form a component of their own. Rows without an id have null component and kept, and no
    links. Rows that share an id and a vector are one vector; different vectors are separate even where they share an id. Ties
    in crowds go to the smaller name. Long vectors are padded to a power of two. Further columns are ignored. An empty table gives no rows.
    """
    if not 0 < cosine < 1:
        raise ValueError("the cosine lies between 0 and 1")
    theta = math.acos(cosine)
    rows = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(embedding).cast("array<double>").alias("v"))
    read = stored(rows.mapInArrow(_read, "vec_id long, label string, dim int, h1 long, h2 long, unit binary"), "vectors")
    names = ["label", "dim", "h1", "h2"]
    single = read.where("dim is not null and vec_id is not null").groupBy(*names, "vec_id").agg(F.first("unit").alias("unit"))
    classes = stored(single.groupBy(*names).agg(F.min("vec_id").alias("first"), F.count("*").alias("w"), F.first("unit").alias("unit")), "classes")
    # a class is named by its smallest id, or where that would name several classes by a number of its own
    shared = classes.groupBy("first").agg(F.count("*").alias("n")).where("n > 1").select("first")
    many = shared.limit(1).count()
    if many:
        odd = classes.join(shared, "first", "left_semi").withColumn("cid", F.lit(-(2**62)) - F.monotonically_increasing_id())
        classes = stored(classes.join(shared, "first", "left_anti").withColumn("cid", F.col("first")).unionByName(odd), "classes")
    else:
        classes = classes.withColumn("cid", F.col("first"))
    width = F.greatest(F.lit(LEAST_WIDTH), F.pow(F.lit(2), F.ceil(F.log2(F.col("dim")) - 1e-9)).cast("int"))
    sizes = classes.groupBy("label", width.alias("width")).agg(F.count("*").alias("n")).groupBy("width").agg(F.max("n").alias("n")).collect()  # a row for each power of two
    keyed = _keyed({r["width"]: plan_tables(r["width"], r["n"], cosine) for r in sizes})
    keys = stored(classes.select("cid", "label", "dim", "w", "unit").mapInArrow(keyed, _KEYED), "keys")

    # balls
    sharp = keys.select("cid", F.explode("sharp").alias("k"))
    crowds = sharp.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") >= CROWD)
    sample = join_with_hot(sharp, crowds, ["k"], F.col("n") * 1000 >= F.lit(keys.count())).where(F.pmod(F.xxhash64("cid"), F.ceil(F.col("n") / SAMPLE)) == 0)
    sample = sample.join(keys.select("cid", "label", "dim", "unit"), "cid").select("k", "label", "dim", "n", "unit")
    means = sample.repartition("k").sortWithinPartitions("k", "label", "dim").mapInArrow(_means, "cid long, label string, dim int, w long, unit binary")
    centres = stored(means.mapInArrow(keyed, _KEYED), "centres")
    mine = keys.select("cid", "s1", "s2", F.explode(F.concat("own", "probes")).alias("k"))
    at = centres.select(F.col("cid").alias("centre"), F.col("w").alias("crowd"), F.col("s1").alias("t1"), F.col("s2").alias("t2"), F.explode("own").alias("k"))
    at = F.broadcast(at) if centres.count() * 64 <= BROADCAST_ROWS else at
    near = mine.join(at, "k").where(_differ() <= signature_limit(theta / 2)).select("cid", "centre", "crowd").distinct()
    near = _checked(near, keys.select("cid", "unit"), centres.select(F.col("cid").alias("centre"), F.col("unit").alias("other")), "cid long, centre long, crowd long")
    near = near.where(F.acos(F.least(F.lit(1.0), "cosine")) <= theta / 2 - SLACK)
    chosen = stored(near.groupBy("cid").agg(F.max_by(F.struct("centre", "cosine"), F.struct("crowd", (-F.col("centre")).alias("x"))).alias("c")).select("cid", "c.centre", "c.cosine"), "chosen")
    balls = chosen.groupBy("centre").agg(F.min("cid").alias("ball"), F.greatest(F.lit(SLACK), F.max(F.acos(F.least(F.lit(1.0), "cosine")))).alias("radius"), F.count("*").alias("n_in")).where("n_in > 1")
    balls = stored(balls, "balls")
    members = join_with_hot(chosen, balls, ["centre"], F.col("n_in") * 1000 >= F.lit(keys.count())).select("cid", "ball", "centre", "radius")
    place = keys.join(members, "cid", "left").select("cid", "w", "unit", "s1", "s2", "own", "probes", F.coalesce("ball", "cid").alias("ball"), "centre", F.coalesce("radius", F.lit(0.0)).alias("radius"))
    place = stored(place, "places")
    middle = centres.select(F.col("cid").alias("centre"), F.col("unit").alias("middle"), F.col("s1").alias("m1"), F.col("s2").alias("m2"))
    grouped = place.where("centre is not null").groupBy("ball", "centre", "radius").agg(F.sum("w").alias("weight"), F.count("*").alias("n_in")).join(middle, "centre")
    ball = place.where("centre is null").select("ball", "radius", F.col("w").alias("weight"), F.lit(1).cast("long").alias("n_in"), F.col("unit").alias("middle"), F.col("s1").alias("m1"), F.col("s2").alias("m2"))
    ball = stored(ball.unionByName(grouped.drop("centre")), "ball-table")

    # candidate pairs of balls
    def entries(keys_of: str) -> DataFrame:
        alone = place.where("centre is null").select("ball", "radius", "s1", "s2", F.explode(keys_of).alias("k"))
        crowd = place.where("centre is not null").select("ball", F.explode(keys_of).alias("k")).distinct()
        return alone.unionByName(crowd.join(grouped.select("ball", "radius", F.col("m1").alias("s1"), F.col("m2").alias("s2")), "ball"))

    other = entries("own").select(F.col("ball").alias("other"), F.col("radius").alias("far"), F.col("s1").alias("t1"), F.col("s2").alias("t2"), "k")
    limit = F.lit(signature_limit(theta))
    for n in (1, 2):  # a grouped ball's centre lies up to half the angle away from its members
        limit = F.when((F.col("radius") > 0).cast("int") + (F.col("far") > 0).cast("int") == n, signature_limit(theta * (1 + n / 2))).otherwise(limit)
    visits = entries("own").withColumn("home", F.lit(True)).unionByName(entries("probes").withColumn("home", F.lit(False)))
    met = visits.join(other, "k").where((F.col("ball") < F.col("other")) | ((F.col("ball") > F.col("other")) & ~F.col("home"))).where(_differ() <= limit)
    pairs = met.select(F.least("ball", "other").alias("a"), F.greatest("ball", "other").alias("b")).distinct()
    sides = lambda x, unit: ball.select(F.col("ball").alias(x), F.col("middle").alias(unit))
    pairs = _checked(pairs, sides("a", "unit"), sides("b", "other"), "a long, b long")
    figures = lambda x: ball.select(F.col("ball").alias(x), F.col("radius").alias(f"r{x}"), F.col("weight").alias(f"w{x}"), F.col("n_in").alias(f"n{x}"))
    reach = F.col("ra") + F.col("rb")
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), "cosine")))
    verdict = F.when(reach == 0, F.when(F.col("cosine") >= cosine, "all").otherwise("none")).when(angle + reach <= theta - SLACK, "all").when(angle - reach > theta + SLACK, "none").otherwise("open")
    judged = stored(pairs.join(figures("a"), "a").join(figures("b"), "b").withColumn("verdict", verdict).where("verdict <> 'none'"), "judged")
    sure, open_ = judged.where("verdict = 'all'"), judged.where("verdict = 'open'")
    whole = sure.select(F.explode(F.array(F.struct(F.col("a").alias("ball"), F.col("wb").alias("links")), F.struct(F.col("b").alias("ball"), F.col("wa").alias("links")))).alias("x")).select("x.*")
    whole = whole.groupBy("ball").agg(F.sum("links").alias("whole"))

    # pairs of balls that no bound settles: a block of either at a time
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("long")
    up_to = lambda n: F.sequence(F.lit(0).cast("long"), blocks(n) - 1)
    inside = place.select("ball", "cid", "w", "unit")

    def side(own: str, n_own: str, n_other: str, right: bool) -> DataFrame:
        dealt = open_.select("a", "b", F.col(own).alias("ball"), F.col(n_own).alias("n_own"), F.explode(up_to(n_other)).alias("with")).join(inside, "ball")
        block = F.pmod(F.xxhash64("cid"), blocks("n_own"))
        i, j = (F.col("with"), block) if right else (block, F.col("with"))
        return dealt.select("a", "b", i.alias("i"), j.alias("j"), F.lit(right).alias("right"), "cid", "w", "unit")

    both = side("a", "na", "nb", False).unionByName(side("b", "nb", "na", True))
    counted = both.repartition("a", "b", "i", "j").sortWithinPartitions("a", "b", "i", "j").mapInArrow(_open_pairs(cosine), "a long, b long, cid long, links long")
    counted = stored(counted, "counted")
    part = counted.groupBy("cid").agg(F.sum("links").alias("part"))

    edges = sure.select("a", "b").unionByName(counted.select("a", "b")).distinct()
    comp = components(edges, name="vectors")
    result = place.select("cid", "ball").join(ball.select("ball", "weight", "n_in"), "ball").join(whole, "ball", "left").join(comp.withColumnRenamed("node", "ball"), "ball", "left").join(part, "cid", "left")
    zero = F.lit(0).cast("long")
    result = result.select("cid", F.coalesce("component", "ball").alias("component"), (F.col("weight") - 1 + F.coalesce("whole", zero) + F.coalesce("part", zero)).alias("n_links"))
    result = classes.select(*names, "cid", "first", "w").join(result, "cid")
    if many:
        least = result.groupBy("component").agg(F.min("first").alias("least"), F.count("*").alias("n"))
        result = join_with_hot(result, least, ["component"], F.col("n") * 1000 >= F.lit(read.count())).withColumn("component", F.col("least"))
    result = stored(result.select(*names, "w", "n_links", "component"), "class-results")
    fine = read.where("dim is not null and vec_id is not null").select("vec_id", *names)
    linked = join_with_hot(fine, result, names, F.col("w") * 1000 >= F.lit(read.count())).select("vec_id", "n_links", F.col("component").alias("component_id"))
    rest = read.where("dim is null or vec_id is null").select("vec_id", zero.alias("n_links"), F.col("vec_id").alias("component_id"))
    discard(keys, centres, chosen, balls, place, ball, judged, counted)
    return linked.unionByName(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))
