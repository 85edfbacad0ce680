"""Op 2: URL filters by a path-template tree. DataFrame functions only.

Rules come first: a rule ``host/path`` fits its host and all subdomains of it where the path starts with the
rule's; the longest that fits decides. Other URLs are judged by the template of their path, learnt per host, level by
level from the root:

* Variability: the segments below a node are counted. A segment is a branch of its own if at least ``min_urls`` of
  the node's URLs have it and at least half the square root of their number; so a node of N URLs has some
  ``2 * sqrt(N)`` branches at most. All other segments are variable ones, which become ``*``.
* Merging: siblings are put in the order of their labelled share of bad URLs and swept once. A branch joins the
  cluster before it unless a two-proportion z test tells the two, which share no URL, apart. A cluster of several
  branches is one template step, ``{first,+more}``; branches without labels join ``*``.
* Purity: a template is rejected if its smoothed share of bad among labelled URLs,
  ``(bad + k * prior) / (labelled + k)``, reaches ``reject``; the prior of a template is the smoothed share of its host,
  and that of a host the overall share.

A node ends, all its remaining segments being ``*``, where nothing below can be told apart: too few URLs, or labels
that are all alike. So the levels go as deep as a node still holds mixed labels, whatever the depth of single paths.

Work is on distinct (host, path) with their counts, so a URL that many rows share is one row of the tree. Counts are
partial aggregates by (host, template, segment); a host of any size is spread over its segments, and only the
branches, a bounded list per node, meet. They are joined back by broadcast up to BROADCAST_BRANCHES, beyond that by
shuffle.

Cases: a null URL, or one without ``://``, has an empty host and path; empty paths are a template of their own;
without labels nothing is rejected; null labels are none; a null label key has no label; repeated rows count each; an
empty table gives an empty result; only the named columns are read. A very long URL is a path of as many levels as it has
segments; only hosts that still branch are followed, so it costs the others nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, cut

#: URLs of a branch at least.
MIN_URLS = 4
#: z at which two siblings differ; labelled URLs that the smoothing counts for; share that rejects.
Z, SMOOTHING, REJECT = 2.6, 4.0, 0.5
#: Branches of a level, or templates, up to which they are sent to all tasks.
BROADCAST_BRANCHES = 100_000


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(ascii_lower(rest), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest of ``rules`` (verdict, ``host/path``) that fits, as a struct (n, rule, verdict), else null.

    The rules are a literal map by host, looked up for the host and each of its parents.
    """
    by_host = defaultdict(list)
    for verdict, rule in rules:
        by_host[rule.split("/", 1)[0].lower()].append((rule, verdict))
    if not by_host:
        return F.lit(None).cast("struct<n: int, rule: string, verdict: string, path: string>")

    def one(rule, verdict):
        return F.struct(F.lit(len(rule)).alias("n"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"), F.lit("/" + rule.partition("/")[2]).alias("path"))

    book = F.create_map(*[x for h, rs in by_host.items() for x in (F.lit(h), F.array(*[one(*r) for r in rs]))])
    labels = F.split(host, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    known = F.flatten(F.filter(F.transform(parents, lambda h: F.try_element_at(book, h)), lambda r: r.isNotNull()))
    return F.array_max(F.filter(known, lambda r: F.startswith(path, r["path"])))


def small(df: DataFrame) -> DataFrame:
    """A written table, to be broadcast if it is short enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_BRANCHES else df


def differ(a: Column, b: Column, z: float) -> Column:
    """Whether the bad shares of two disjoint counts (labelled, bad) differ: a pooled two-proportion z test."""
    n, m = a["labelled"].cast("double"), b["labelled"].cast("double")
    pooled = (a["bad"] + b["bad"]) / (n + m)
    spread = F.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m))
    return F.abs(a["bad"] / n - b["bad"] / m) > z * spread


def clusters_of(branches: Column, z: float) -> Column:
    """Sweep labelled sibling branches (part, labelled, bad), in the order of bad share: array of
    (parts, labelled, bad), each a cluster of branches that aren't told apart."""
    kind = "array<struct<parts: array<string>, labelled: bigint, bad: bigint>>"
    order = lambda x, y: F.when(x["bad"] * y["labelled"] < y["bad"] * x["labelled"], -1).when(x["bad"] * y["labelled"] > y["bad"] * x["labelled"], 1).when(x["part"] < y["part"], -1).when(x["part"] > y["part"], 1).otherwise(0)
    alone = lambda b: F.struct(F.array(b["part"]).alias("parts"), b["labelled"].alias("labelled"), b["bad"].alias("bad"))

    def step(acc: Column, b: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        joined = F.struct(F.concat(last["parts"], F.array(b["part"])).alias("parts"), (last["labelled"] + b["labelled"]).alias("labelled"), (last["bad"] + b["bad"]).alias("bad"))
        apart = (F.size(acc) == 0) | F.coalesce(differ(last, b, z), F.lit(False))
        return F.when(apart, F.concat(acc, F.array(alone(b)))).otherwise(F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(joined))).cast(kind)

    return F.aggregate(F.array_sort(branches, order), F.array().cast(kind), step)


def branches_of(front: DataFrame, nodes: DataFrame, min_urls: int, z: float) -> DataFrame:
    """(h, t, p, step): the segments of open nodes that are branches, and the template step of their cluster."""
    counts = front.groupBy("host", "template", "part").agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "bad")]).where(F.col("n") >= min_urls)
    frequent = counts.join(nodes, ["host", "template"]).where((F.col("labelled") > 0) & (4 * F.col("n") * F.col("n") >= F.col("node_n")))
    lists = frequent.groupBy("host", "template").agg(F.collect_list(F.struct("part", "labelled", "bad")).alias("branches"))
    each = lists.select(F.col("host").alias("h"), F.col("template").alias("t"), F.explode(clusters_of(F.col("branches"), z)).alias("c"))
    first = F.array_min("c.parts")
    step = F.when(F.size("c.parts") == 1, first).otherwise(F.concat(F.lit("{"), first, F.lit(",+"), (F.size("c.parts") - 1).cast("string"), F.lit("}")))
    return each.select("h", "t", F.explode("c.parts").alias("p"), step.alias("step"))


def template_tree(paths: DataFrame, min_urls: int = MIN_URLS, z: float = Z) -> DataFrame:
    """(host, path, n, labelled, bad, template) of distinct (host, path) with their counts of URLs, labelled and bad ones."""
    parts = F.filter(F.split("path", "/"), lambda s: s != "")
    front = cut(paths.select("host", "path", "n", "labelled", "bad", parts.alias("parts"), F.lit("").alias("template")), "url-paths")
    level, done = 0, []
    while True:
        open_ = front.where(F.size("parts") > level).withColumn("part", F.get("parts", F.lit(level)))
        nodes = open_.groupBy("host", "template").agg(F.sum("n").alias("node_n"), F.sum("labelled").alias("l"), F.sum("bad").alias("b"))
        # Labels that are all alike, or too few URLs for two branches: nothing below is told apart.
        nodes = cut(nodes.where((F.col("b") > 0) & (F.col("b") < F.col("l")) & (F.col("node_n") >= 2 * min_urls)).select("host", "template", "node_n"), "url-nodes")
        if nodes.isEmpty():
            rest = F.repeat(F.lit("/*"), F.greatest(F.size("parts") - level, F.lit(0)))
            return _all([*done, front.withColumn("template", F.concat("template", rest)).drop("parts")])
        branches = cut(branches_of(open_, nodes, min_urls, z), "url-branches")
        here = small(nodes.select(F.col("host").alias("nh"), F.col("template").alias("nt")))
        rows = front.join(here, (F.size("parts") > level) & (F.col("host") == F.col("nh")) & (F.col("template") == F.col("nt")), "left")
        rest = F.repeat(F.lit("/*"), F.greatest(F.size("parts") - level, F.lit(0)))
        done.append(cut(rows.where("nh IS NULL").select("host", "path", "n", "labelled", "bad", F.concat("template", rest).alias("template")), "url-done"))
        on = (F.col("host") == F.col("h")) & (F.col("template") == F.col("t")) & (F.get("parts", F.lit(level)) == F.col("p"))
        rows = rows.where("nh IS NOT NULL").drop("nh", "nt").join(small(branches), on, "left")
        rows = rows.withColumn("template", F.concat("template", F.lit("/"), F.coalesce("step", F.lit("*")))).drop("h", "t", "p", "step")
        front, level = cut(rows, "url-front"), level + 1


def _all(tables: Sequence[DataFrame]) -> DataFrame:
    """The union of written tables of the same columns."""
    found = tables[0]
    for t in tables[1:]:
        found = found.unionByName(t)
    return found


def judged_templates(paths: DataFrame, smoothing: float = SMOOTHING, reject: float = REJECT) -> DataFrame:
    """(host, template, n, labelled, bad, badness, rejected) of ``template_tree``'s rows."""
    one = cut(paths.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "bad")]), "templates")
    total = one.agg(F.try_divide(F.sum("bad"), F.sum("labelled"))).first()[0]
    hosts = one.groupBy(F.col("host").alias("h")).agg(((F.sum("bad") + F.lit(smoothing * (total or 0.0))) / (F.sum("labelled") + smoothing)).alias("prior"))
    badness = (F.col("bad") + smoothing * F.col("prior")) / (F.col("labelled") + smoothing)
    return one.join(hosts, F.col("host") == F.col("h")).select("host", "template", "n", "labelled", "bad", badness.alias("badness"), (badness >= reject).alias("rejected"))


def judge(
    pages: DataFrame,
    labels: DataFrame | None,
    rules: Sequence[tuple[str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    label_key: Column | None = None,
    min_urls: int = MIN_URLS,
    z: float = Z,
    smoothing: float = SMOOTHING,
    reject: float = REJECT,
) -> DataFrame:
    """id, host, path, rule, verdict, template and badness of every URL.

    ``labels``: (id, bad) with bad 0 or 1, joined by ``label_key``, a column of ``pages`` (its id by default).
    """
    key = F.col(id_col) if label_key is None else label_key
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), key.alias("key"))
    urls = urls.select("id", "key", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if labels is None:
        known = urls.withColumn("bad", F.lit(None).cast("int"))
    else:
        told = labels.where("bad IS NOT NULL").groupBy(F.col("id").alias("l_id")).agg(F.max("bad").cast("int").alias("bad")).withColumn("l_deal", F.lit(0).cast("bigint"))
        # URLs without a key are dealt by their path, so they don't meet in one task.
        deal = F.when(F.col("key").isNull(), F.xxhash64("host", "path")).otherwise(0)
        known = urls.withColumn("deal", deal).join(told, (F.coalesce("key", F.lit(0)) == F.col("l_id")) & F.col("key").isNotNull() & (F.col("deal") == F.col("l_deal")), "left")
    counts = known.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).cast("bigint").alias("bad"))
    paths = cut(template_tree(counts, min_urls, z), "url-templates")
    templates = cut(judged_templates(paths, smoothing, reject).select(F.col("host").alias("h"), F.col("template").alias("t"), "badness", "rejected"), "url-judged")
    paths = paths.join(small(templates), (F.col("host") == F.col("h")) & (F.col("template") == F.col("t")))
    paths = paths.select(F.col("host").alias("p_host"), F.col("path").alias("p_path"), "template", "badness", "rejected")
    rows = urls.join(paths, (F.col("host") == F.col("p_host")) & (F.col("path") == F.col("p_path"))).withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce("r.verdict", F.when(F.col("rejected"), "block").otherwise("allow"))
    return rows.select(F.col("id").alias(id_col), "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"), "template", "badness")
