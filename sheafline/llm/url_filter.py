"""URL rules and path-template trees per host, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import discard, join_with_hot, neutral_names, stored

#: (verdict, host, path) rules of the registered query.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: A segment that varies from page to page: it has a digit or is long.
VARIABLE = r"(?s)[0-9]|^.{25,}$"
#: What merged branches are called: those that rules mostly block, mostly allow, and say nothing about. No segment holds a '/'.
MERGED = {"block": "/*block", "allow": "/*allow", "none": "*"}
#: Code points of the longest DNS name; a longer host has no parent domains.
DNS_NAME = 253


def host(url: Column) -> Column:
    """After the first '://' up to '/', '?', '#' or the end, A-Z lower-cased; '' without '://' or for null."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    """From the host's end up to '?', '#' or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule (host and path together) that fits; among equals the last in alphabetical order; nulls if none. ``rules`` is a short list (a parameter)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1], r[2])):  # the longest stands outermost
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def _purity(inherited: Column, smoothing: float, silent: float) -> Column:
    """Smoothed share of blocked pages: what is inherited counts as ``smoothing`` labelled pages and ``silent`` of each page without a label."""
    rest = smoothing + silent * (F.col("n") - F.col("bad") - F.col("good"))
    return (F.col("bad") + rest * inherited) / (F.col("bad") + F.col("good") + rest)


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("n", "bad", "good")]


def _hosts(table: DataFrame, smoothing: float, silent: float) -> DataFrame:
    """(host, purity): inherited from the whole table through the parent domains down to the host; a domain that holds all pages of its parent says nothing new."""
    hosts = table.groupBy("host").agg(*_sums())
    total = hosts.agg(*_sums()).first()
    bad, labelled, n = total["bad"] or 0, (total["bad"] or 0) + (total["good"] or 0), total["n"] or 0
    rest = smoothing + silent * (n - labelled)
    prior = (bad + rest / 2) / (labelled + rest)
    labels = F.split("host", r"\.", -1)
    known = F.when(F.char_length("host") <= DNS_NAME, F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, F.size(labels) - i + 1, i), "."))).otherwise(F.array("host"))
    chain = hosts.select("host", "n", "bad", "good", F.posexplode(known).alias("level", "domain"))
    domains = chain.groupBy("domain").agg(*_sums())
    met = join_with_hot(chain.select("host", "level", "domain"), domains, ["domain"], F.col("n") * 1000 >= F.lit(n))  # at most 1000 rows for each label of a name
    ways = met.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("level", "n", "bad", "good"))).alias("way"))  # as many as the name has labels

    def down(acc: Column, x: Column) -> Column:
        rest = smoothing + silent * (x["n"] - x["bad"] - x["good"])
        p = (x["bad"] + rest * acc["p"]) / (x["bad"] + x["good"] + rest)
        return F.struct(F.when(x["n"] < acc["n"], p).otherwise(acc["p"]).alias("p"), x["n"].alias("n"))

    start = F.struct(F.lit(float(prior)).alias("p"), F.lit(n).cast("long").alias("n"))
    return ways.select("host", F.aggregate("way", start, down, lambda acc: acc["p"]).alias("purity"))


def _tree(table: DataFrame, z: float, slack: float, smoothing: float, silent: float) -> DataFrame:
    """Generalises segment after segment: gen is the template of ``segs`` and purity the one of its node. Ends when every node holds one raw template.

    Segments that all of a node's raw templates share are taken in one step: with a single child there is nothing to merge and the purity stays.
    """
    t = table.join(_hosts(table, smoothing, silent), "host").withColumn("gen", F.array().cast("array<string>"))
    t = stored(t, "templates")
    shared = F.coalesce(F.nullif(F.array_position(F.zip_with("low", "high", lambda a, b: F.coalesce(a == b, F.lit(False))), F.lit(False)), F.lit(0)) - 1, F.size("low"))  # of the least and the greatest, so of all between
    while True:
        nodes = t.groupBy("host", "gen").agg(F.count("*").alias("templates"), F.sum("n").alias("all"), F.min("segs").alias("low"), F.max("segs").alias("high"))
        nodes = nodes.select("host", "gen", "templates", "all", F.when(F.col("templates") > 1, F.greatest(shared.cast("int"), F.size("gen"))).otherwise(F.size("gen")).alias("depth"))
        at = t.join(nodes, ["host", "gen"]).withColumn("gen", F.concat("gen", F.slice("segs", F.size("gen") + 1, F.col("depth") - F.size("gen"))))
        at = at.withColumn("open", (F.col("templates") > 1) & (F.size("segs") > F.col("depth")))
        if not at.where("open").limit(1).count():
            break
        at = at.withColumn("seg", F.when(F.col("open"), F.try_element_at("segs", F.col("depth") + 1)))
        ends = F.when(F.size("segs") == F.col("depth") + 1, F.col("n")).otherwise(0)
        varies = F.when(F.try_element_at("segs", F.col("depth") + 2) == "*", F.col("n")).otherwise(0)
        kids = at.where("open").groupBy("host", "gen", "seg").agg(*_sums(), F.sum(ends).alias("ends"), F.sum(varies).alias("varies"))
        kids = kids.withColumn("kind", F.when(F.col("bad") + F.col("good") == 0, "none").when(F.col("bad") >= F.col("good"), "block").otherwise("allow"))
        pools = kids.groupBy("host", "gen", "kind").agg(F.count("*").alias("kids"), *[F.sum(c).alias("_" + c) for c in ("n", "bad", "good", "ends", "varies")])
        kids = kids.join(pools, ["host", "gen", "kind"])

        def near(part: Column, whole: Column, pool_part: Column, pool: Column) -> Column:
            rate = pool_part / F.greatest(pool, F.lit(1))
            return F.abs(part / F.greatest(whole, F.lit(1)) - rate) <= slack + z * F.sqrt(rate * (1 - rate) / F.greatest(whole, F.lit(1)))

        similar = (F.col("kids") > 1) & near(F.col("ends"), F.col("n"), F.col("_ends"), F.col("_n")) & near(F.col("varies"), F.col("n"), F.col("_varies"), F.col("_n"))
        similar = similar & near(F.col("bad"), F.col("bad") + F.col("good"), F.col("_bad"), F.col("_bad") + F.col("_good"))
        name = F.coalesce(*[F.when(F.col("kind") == k, F.lit(v)) for k, v in MERGED.items()])
        names = kids.select("host", "gen", "seg", F.when(similar, name).otherwise(F.col("seg")).alias("as"))
        named = at.join(names, ["host", "gen", "seg"], "left").withColumn("parent", F.col("gen"))
        named = named.withColumn("gen", F.when(F.col("open"), F.concat("gen", F.array("as"))).otherwise(F.col("gen")))
        new = named.where("open").groupBy("host", "gen").agg(*_sums(), F.first("all").alias("all"), F.first("purity").alias("purity"))
        new = new.select("host", "gen", F.when(F.col("n") < F.col("all"), _purity(F.col("purity"), smoothing, silent)).otherwise(F.col("purity")).alias("own"))
        # a page that ends at an inner node keeps that node's template, which differs from all longer ones
        named = named.drop("as", "seg", "parent", "all", "templates", "depth").join(new, ["host", "gen"], "left")
        last, t = t, stored(named.select("host", "segs", "n", "bad", "good", F.when(F.col("open"), F.col("own")).otherwise(F.col("purity")).alias("purity"), "gen"), "templates")
        discard(last)
    # a node of one raw template: what is left of it is kept as it is
    left = F.when((F.col("templates") == 1) & (F.size("segs") > F.size("gen")), F.concat("gen", F.slice("segs", F.size("gen") + 1, F.greatest(F.size("segs") - F.size("gen"), F.lit(0))))).otherwise(F.col("gen"))
    return at.withColumn("gen", left).select("host", "segs", "n", "bad", "good", "gen", "purity")


@neutral_names
def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str, str]], z: float = 1.96, slack: float = 0.05, smoothing: float = 2.0, silent: float = 1.0, reject: float = 0.8, learn_from: Column | None = None, url: str = "url"
) -> DataFrame:
    """``pages`` with host, path, rule, template (array<string>), purity (double) and verdict ('allow' or 'block').

    A page that a rule fits gets the rule's verdict, and is a labelled page. Every host has a tree of
    path segments of any depth: variable segments (with a digit, or of 25 characters or more) are '*' from the start; then,
    from the root down, a node's children of one kind (rules mostly block their pages, mostly allow them, or say nothing)
    merge where they are statistically similar to all children of that kind together: their shares of blocked
    pages, of pages that end there and of pages that go on with a variable segment each lie within ``z`` standard
    errors plus ``slack``. A labelled branch never lends its labels to siblings without any.

    A node's purity is its smoothed share of blocked pages: (bad + w * inherited) / (bad + good + w) with
    w = ``smoothing`` + ``silent`` * (pages without a label). It inherits from its parent node, a root from its host, a
    host from its parent domains, these from all pages together, and all pages from even odds; a node that holds all pages of its parent has its
    purity. So templates without labels follow their nearest labelled ancestor, which
    condemns them only if blocked pages make up a large part of it. A page that no rule fits is blocked if its template's purity
    is ``reject`` or more. Where ``learn_from`` is given, only pages for which it is true count as labelled.

    Pages are first summed to one row for each host and raw template (map-side combined); the tree works on those rows,
    and templates that hold a thousandth of all pages or more (so at most 1000) are broadcast back, others joined by
    a shuffle. Null urls and urls without '://' have empty host and path and an empty template. Rules of equal length: the
    last in alphabetical order wins. Very long urls are read whole; a path needs no more rounds than there are
    places where it parts from others of its host. Repeated pages count each time. Extra columns pass through; columns with these
    names are replaced. An empty table gives no rows.
    """
    names = ("host", "path", "rule", "template", "purity", "verdict")
    rows = pages.drop(*names).withColumn("host", host(F.col(url))).withColumn("path", path(F.col(url)))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("_ruled", verdict).withColumn("_label", F.when(learn_from, F.col("_ruled")) if learn_from is not None else F.col("_ruled"))
    rows = rows.withColumn("_segs", F.transform(F.filter(F.split("path", "/", -1), lambda s: s != ""), lambda s: F.when(s.rlike(VARIABLE), "*").otherwise(s)))
    table = rows.groupBy("host", F.col("_segs").alias("segs")).agg(F.count("*").alias("n"), F.count_if(F.col("_label") == "block").alias("bad"), F.count_if(F.col("_label") == "allow").alias("good"))
    table = stored(table, "raw-templates")
    total = table.agg(F.sum("n")).first()[0] or 0
    judged = stored(_tree(table, z, slack, smoothing, silent).select("host", F.col("segs").alias("_segs"), F.col("n").alias("_n"), F.col("gen").alias("template"), "purity"), "judged")
    discard(table)
    out = join_with_hot(rows, judged, ["host", "_segs"], F.col("_n") * 1000 >= total)
    return out.withColumn("verdict", F.coalesce("_ruled", F.when(F.col("purity") >= reject, "block").otherwise("allow"))).select(*pages.drop(*names).columns, *names)
