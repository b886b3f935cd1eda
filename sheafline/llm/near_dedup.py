"""Near-duplicate groups by fast similarity sketches, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import discard, join_with_hot, mix, shingle_set, slices, stored, text_bytes
from sheafline.llm.components import components

#: Distinct document ids up to which the ids that need verification are broadcast (8 MB of longs); beyond, they are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Members that one task checks against a hub, and documents of a block that is compared with another.
BLOCK = 256
#: Differing shingles (8 bytes each) that a block of documents holds, about.
BLOCK_SHINGLES = 500_000


def sketches(sets: list[np.ndarray], t: int, seed: int = 0) -> np.ndarray:
    """The fast similarity sketch of each set: (len(sets), t) uint64.

    Round i < t throws each element into a hashed bin with a hashed value to which i is
    prefixed, so an earlier round's value always wins; round t + j throws every element
    into bin j. A set takes part until its bins are full, so 2t rounds fill every bin of
    every non-empty set, most in one or two rounds.
    """
    out = np.full((len(sets), t), np.iinfo(np.uint64).max, np.uint64)
    sizes = np.array([len(s) for s in sets])
    values, owner = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64), np.repeat(np.arange(len(sets)), sizes)
    for i in range(2 * t):
        if not len(values):
            break
        x = mix(values + np.uint64(((seed << 20) + 2 * i + 1) * 0xD6E8FEB86659FD93 % 2**64))
        v = (np.uint64(i) << np.uint64(48)) | (x >> np.uint64(16))
        bins = (mix(x) % np.uint64(t)).astype(np.int64) if i < t else np.full(len(x), i - t)
        np.minimum.at(out.reshape(-1), owner * t + bins, v)
        going = (out == np.iinfo(np.uint64).max).any(axis=1)[owner]
        if not going.all():
            values, owner = values[going], owner[going]
    return out


def band_keys(sketch: np.ndarray, bands: int) -> np.ndarray:
    """(n, bands) hashes of the bands' coordinates; the band's number is part of its hash."""
    n, t = sketch.shape
    rows = sketch.reshape(n, bands, t // bands)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (n, bands))
    for k in range(t // bands):
        key = mix(key + rows[:, :, k])
    return key


def set_digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits over a whole sorted shingle set, as two signed longs."""
    both = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64)
    return int(both[0]), int(both[1])


def _sketched(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(x, width) for x in batch.column(1).to_pylist()]
            keys = band_keys(sketches(sets, bands * rows), bands).view(np.int64)
            h1, h2 = zip(*map(set_digest, sets), strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.ListArray.from_arrays(np.arange(0, keys.size + 1, bands, dtype=np.int32), keys.reshape(-1))],
                ["doc_id", "n_shingles", "h1", "h2", "bands"],
            )

    return run


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, exactly."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], schema=_LINKS)


def _members_with_hub(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[list[tuple[int, list[np.ndarray], int, np.ndarray]]]:
    """(hub, the hub's sets, id, its set), a slice at a time. Rows (hub, salt, member, id, text) come sorted, hub texts first; a hub has several sets only if rows share its id."""
    at, hub_sets = None, []
    for batch in slices(batches):
        out = []
        for hub, salt, member, i, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (hub, salt) != at:
                at, hub_sets = (hub, salt), []
            own = shingle_set(text, width)
            if member:
                out.append((hub, hub_sets, i, own))
            else:
                hub_sets.append(own)
        yield out


def _against_hubs(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _members_with_hub(batches, width):
            yield _links([(hub, i) for hub, sets, i, own in rows if any(_similar(own, x, percent) for x in sets)])

    return run


_DIFFERENCES = "hub long, id long, n long, hub_n long, d array<long>"


def _differences(width: int):
    """(hub, id, sizes of the document's and the hub's set, the shingles that only one of them has)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _members_with_hub(batches, width):
            base = [min(sets, key=set_digest) for _, sets, _, _ in rows]
            apart = [np.setxor1d(r[3], x, assume_unique=True).view(np.int64) for r, x in zip(rows, base, strict=True)]
            longs = [[r[0] for r in rows], [r[2] for r in rows], [len(r[3]) for r in rows], list(map(len, base))]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in longs), pa.array(apart, pa.list_(pa.int64()))], ["hub", "id", "n", "hub_n", "d"])

    return run


def _within_blocks(percent: int):
    """Rows (hub, e, i, j, block, id, c, g, d, prefix) come sorted by group (hub, e, i, j); a group is two blocks at most.

    ``d`` is how a document differs from the hub, ``prefix`` the shingles it is indexed by, rarest first: a pair is compared
    under the first of them that both have. Documents of one component need no further link.
    """

    def links(group: list[tuple], e: int, i: int, j: int) -> list[tuple[int, int]]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.get(x, x) != x:
                root[x] = root.get(root[x], root[x])
                x = root[x]
            return x

        # one pass over all shingles of the group gives what a document's differences share with every later one's
        sizes = np.array([len(x[4]) for x in group])
        ends, g = np.cumsum(sizes), np.array([x[3] for x in group])
        _, shingles = np.unique(np.concatenate([x[4] for x in group]), return_inverse=True)
        own, found = np.zeros(shingles.max() + 1, bool), []
        for n, (block, a, ca, _, _, indexed) in enumerate(group[:-1]):
            mine = shingles[ends[n] - sizes[n] : ends[n]]
            own[mine] = True
            both = np.add.reduceat(own[shingles[ends[n] :]].astype(np.int64), ends[n:-1] - ends[n])
            own[mine] = False
            for other, b, cb, _, _, pb in (group[m] for m in np.flatnonzero(2 * (100 + percent) * both >= g[n] + g[n + 1 :]) + n + 1):
                if (i == j or block != other) and find(ca) != find(cb) and next(filter(set(pb).__contains__, indexed)) == e:
                    found.append((a, b))
                    root[find(ca)] = find(cb)
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group = None, []
        for batch in batches:
            for hub, e, i, j, block, d, c, g, apart, prefix in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (hub, e, i, j) != at:
                    if len(group) > 1:
                        yield _links(links(group, *at[1:]))
                    at, group = (hub, e, i, j), []
                group.append((block, d, c, g, np.array(apart, np.int64), prefix))
        if len(group) > 1:
            yield _links(links(group, *at[1:]))

    return run


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of the documents that need exact verification."""
    some = ids.select(F.col("id").alias("doc_id")).distinct()
    n = some.count()
    return docs.join(F.broadcast(some) if n <= BROADCAST_IDS else some, "doc_id", "left_semi").select(F.col("doc_id").alias("id"), "text")


def _dealt_to_hubs(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(hub, salt, member, id, text) for (hub, id) pairs: a hub's members dealt into salts of about BLOCK, its own text once for each salt, in front."""
    salts = pairs.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).alias("salts"))
    members = pairs.join(salts, "hub").select("hub", F.pmod(F.xxhash64("id"), "salts").alias("salt"), F.lit(True).alias("member"), "id")
    hubs = salts.select("hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(False).alias("member"), F.col("hub").alias("id"))
    assigned = stored(members.unionByName(hubs), "assigned")
    ready = assigned.join(_texts(docs, assigned), "id").select("hub", "salt", "member", "id", "text")
    return ready.repartition("hub", "salt").sortWithinPartitions("hub", "salt", "member")


def _beyond_hubs(docs: DataFrame, members: DataFrame, comp: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between members of one bucket that the hub did not bring together, by an exact prefix filter.

    Every document is known by its differences d from the hub. Two documents x, y share |x| + |y| - |dx ^ dy| over 2
    shingles, so they are linked if and only if 2 (100 + percent) |dx & dy| >= g(x) + g(y), where
    g = (100 + percent) |d| - (100 - percent) |set|. One of them, x, is not linked with the hub, which makes
    the right side positive: shingles that the whole bucket has in common lie in no d and bring nobody together, and a
    document whose differences are not found elsewhere meets nobody. Of those found elsewhere, rarest
    first, only as many are indexed as must hold one that the two share: two linked sets differ in at most
    (100 - percent) / percent |x| shingles, so they share all but so many of either's differences.
    """
    to = comp.withColumnRenamed("component", "c")
    at = members.join(to.withColumnRenamed("node", "cid"), "cid", "left").select("key", "hub", F.col("cid").alias("id"), F.coalesce("c", "cid").alias("c"))
    split = at.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("key")
    open_ = at.join(split, "key", "left_semi").select("hub", "id", "c").distinct().join(to.select(F.col("node").alias("hub"), F.col("c").alias("hc")), "hub", "left")
    open_ = at = stored(open_.select("hub", "id", "c", (F.col("c") != F.coalesce("hc", "hub")).alias("apart")), "open")
    d = _dealt_to_hubs(docs, open_.select("hub", "id")).mapInArrow(_differences(width), _DIFFERENCES)
    d = d.withColumn("g", (100 + percent) * F.size("d") - (100 - percent) * F.col("n"))
    d = stored(d.join(open_, ["hub", "id"]), "differences")
    # how many differences a partner must share: a partner y has g(y) >= 2 percent |dy| - (100 - percent) |hub| and at least as many
    # differences as are shared; one of the two is apart from the hub, so a member that is not meets the least g of those
    spare = F.floor(F.col("n") * (100 - percent) / percent + 1e-9)
    base = (100 - percent) * F.col("hub_n")
    least = d.groupBy("hub").agg(F.count("*").alias("n_members"), F.min(F.when(F.col("apart"), F.col("g"))).alias("least"))
    shared = F.when(F.col("apart"), (F.col("g") - base) / 200.0).otherwise((F.col("g") + F.col("least")) / (2.0 * (100 + percent)))
    need = F.greatest(F.lit(1), F.size("d") - spare, F.ceil(shared - 1e-9)).cast("int")
    open_ = join_with_hot(d, least, ["hub"], F.col("n_members") * 1000 >= d.count()).select("hub", "id", "apart", "g", need.alias("need"), "d").where(F.size("d") >= F.col("need"))
    one = open_.select("hub", "id", "apart", "g", "need", F.explode("d").alias("e"))
    often = one.groupBy("hub", "e").agg(F.count("*").alias("n"), F.max("apart").alias("any")).where("n > 1 and any").select("hub", "e", "n")
    held = F.sort_array(F.collect_list(F.struct("n", "e")))  # within one document's differences
    prefix = one.join(often, ["hub", "e"]).groupBy("hub", "id", "apart", "g", "need").agg(held.alias("held")).where(F.size("held") >= F.col("need"))
    prefix = prefix.select("hub", "id", "apart", "g", F.size("held").alias("n_held"), F.transform(F.slice("held", 1, F.size("held") - F.col("need") + 1), lambda x: x["e"]).alias("prefix"))
    prefix = stored(prefix, "prefixes")

    # a pair meets under the first shingle that both index, so they share no more than what follows it in either; in its list, the
    # partner that asks least is known, and who cannot share so much with that one leaves
    listed = prefix.select("hub", "id", "apart", "g", "n_held", F.posexplode("prefix").alias("pos", "e"))
    ask = listed.groupBy("hub", "e").agg(F.min("g").alias("any"), F.min(F.when(F.col("apart"), F.col("g"))).alias("least")).where("least is not null")
    listed = listed.join(ask, ["hub", "e"])
    able = (F.col("n_held") - F.col("pos")) * (2 * (100 + percent)) >= F.col("g") + F.when(F.col("apart"), F.col("any")).otherwise(F.col("least"))
    listed = listed.where(able).select("hub", "id", "apart", "e")
    size = F.size("d")
    blocks = lambda which: F.ceil(F.greatest(F.count_if(which) / F.lit(BLOCK), F.sum(F.when(which, F.col("size")).otherwise(0)) / F.lit(BLOCK_SHINGLES)))
    sizes = d.select("hub", "id", size.alias("size"))
    lists = listed.join(sizes, ["hub", "id"]).groupBy("hub", "e").agg(F.count("*").alias("n"), blocks(F.col("apart")).alias("others"), blocks(~F.col("apart")).alias("mains")).where("n > 1 and others > 0")
    listed = listed.join(lists.drop("n"), ["hub", "e"]).withColumn("block", F.pmod(F.xxhash64("id"), F.when(F.col("apart"), F.col("others")).otherwise(F.col("mains"))))
    none = F.array().cast("array<long>")
    up_to = lambda n: F.sequence(F.lit(1).cast("long"), F.col(n))
    # members linked with the hub need not meet each other: they meet the blocks of those apart from it
    met = F.concat(
        F.transform(up_to("others"), lambda j: F.struct((j - 1).alias("with"), F.lit(False).alias("main"))),
        F.transform(F.when(F.col("apart") & (F.col("mains") > 0), up_to("mains")).otherwise(none), lambda j: F.struct((j - 1).alias("with"), F.lit(True).alias("main"))),
    )
    listed = listed.select("hub", "e", "apart", "block", "id", F.explode(met).alias("m"))
    # a pair of blocks is named (i, j): i is of those apart; j = -1 - block where it is of the others
    own = F.when(F.col("apart"), F.col("block")).otherwise(-1 - F.col("block"))
    i = F.when(~F.col("apart"), F.col("m.with")).when(F.col("m.main"), F.col("block")).otherwise(F.least("block", "m.with"))
    j = F.when(~F.col("apart"), own).when(F.col("m.main"), -1 - F.col("m.with")).otherwise(F.greatest("block", "m.with"))
    rows = listed.select("hub", "e", i.alias("i"), j.alias("j"), own.alias("block"), "id")
    rows = rows.join(d.join(prefix.select("hub", "id", "prefix"), ["hub", "id"]), ["hub", "id"]).select("hub", "e", "i", "j", "block", "id", "c", "g", "d", "prefix")
    rows = rows.repartition("hub", "e", "i", "j").sortWithinPartitions("hub", "e", "i", "j")
    more = stored(rows.mapInArrow(_within_blocks(percent), "a long, b long"), "more")
    discard(at, d, prefix)
    return more


def near_duplicates(documents: DataFrame, width: int = 5, percent: int = 80, bands: int = 40, rows: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``documents``.

    A document's set holds its distinct ``width``-word shingles. Two documents are linked
    when 100 * |intersection| >= percent * |union|; a component is what links connect.

    1. Each set gets a sketch of ``bands * rows`` coordinates; sets of equal size and 128-bit digest collapse
       to the smallest id. With 40 bands of 4, a pair at 0.8 misses all bands with probability 7e-10.
    2. In each bucket every member is checked, on full sets, against the bucket's hub, the member that
       meets most others in all its buckets (a star, never all pairs); a hub's members are salted over tasks.
    3. Where members of a bucket still lie in different components, an exact prefix filter over their
       differences from the hub finds who can reach ``percent`` at all (:func:`_beyond_hubs`).

    Null or wordless texts have no shingles and are linked with nothing; null ids stay apart, with
    null results for component and kept. Rows that share an id count as one node. Very long texts are read whole,
    one at a time; a task holds one hub's set, or two blocks of at most about BLOCK_SHINGLES differences and one document
    more. Further columns are ignored; an empty table gives no rows.
    """
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(text).alias("text"))
    sk = stored(docs.mapInArrow(_sketched(width, bands, rows), "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>"), "sketches")
    classes = sk.where("n_shingles > 0 and doc_id is not null").groupBy("h1", "h2", "n_shingles").agg(F.min("doc_id").alias("cid"), F.min("bands").alias("bands"))
    classes = stored(classes, "classes")

    keyed = classes.select("cid", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    crowds = stored(keyed.join(buckets, "key"), "crowds")
    met = crowds.groupBy("cid").agg(F.sum("n").alias("met"))
    hubs = crowds.join(met, "cid").groupBy("key").agg(F.max(F.struct("met", (-F.col("cid")).alias("least"))).alias("x")).select("key", (-F.col("x.least")).alias("hub"))
    members = stored(crowds.join(hubs, "key").where("cid <> hub").select("key", "hub", "cid"), "members")

    pairs = members.select("hub", F.col("cid").alias("id")).distinct()
    links = stored(_dealt_to_hubs(docs, pairs).mapInArrow(_against_hubs(width, percent), "a long, b long"), "links")
    comp = stored(components(links, name="near"), "components")
    more = _beyond_hubs(docs, members, comp, width, percent)
    if more.limit(1).count():
        comp = stored(components(links.unionByName(more), name="near"), "components")
    discard(crowds, members, links, more)

    named = sk.join(classes.select("h1", "h2", "n_shingles", "cid"), ["h1", "h2", "n_shingles"], "left")
    named = named.join(comp.withColumnRenamed("node", "cid"), "cid", "left").select("doc_id", "n_shingles", F.coalesce("component", "cid", "doc_id").alias("component_id"))
    return named.withColumn("kept", F.col("doc_id") == F.col("component_id"))
