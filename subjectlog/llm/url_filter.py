"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest.

All of it is DataFrame work.  Trees are grown by histograms: each level of a tree is one aggregation of the
labelled rows by (node, feature, bin), whose few thousand rows are all that the driver sees; gradients are summed
as whole numbers, so any partitioning grows the same trees.  Scoring is a Column.
"""

from __future__ import annotations

import math
from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, threshold_sample, written

# The rules of the registered query.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

FIT_ROWS = 200_000  # labelled rows that the trees are grown on; suffix statistics count all of them
FOLDS = 4  # a labelled url sees the suffix statistics of the other folds only
SUFFIXES = 3  # labels of a host whose suffixes have statistics
TREES, DEPTH, BINS = 10, 3, 16
RATE, RIDGE, LEAST = 0.3, 1.0, 1.0
UNIT = 1 << 20  # gradients are whole multiples of 1 / UNIT
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def address(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url: what follows the first ``://`` up to ``/ ? #``, A-Z lower-cased, then up to ``? #``.
    Both are empty for null and for a text without ``://``."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, shape, k), F.lit("")) for k in (1, 2))
    return F.translate(host, UPPER, LOWER), path


def ruling(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """(rule, its verdict) that fits: its host or a subdomain, a path that starts with the rule's.  The longest
    wins, of equally long ones the smaller; null if none fits.  Rules are a list given in code."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Bits a character; 0 for an empty text.  Characters are sorted, then one pass adds up n log n of each run."""
    chars = F.array_sort(F.split(text, ""))
    nlogn = lambda n: F.when(n > 1, n * F.log2(n)).otherwise(0.0)
    start = F.struct(F.lit("").alias("c"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))

    def step(held: Column, c: Column) -> Column:
        run = F.when(held["c"] == c, held["run"] + 1.0).otherwise(F.lit(1.0))
        return F.struct(c.alias("c"), run.alias("run"), (held["sum"] + nlogn(run) - nlogn(run - 1.0)).alias("sum"))

    n = F.length(text)
    return F.when(n > 0, F.log2(n.cast("double")) - F.aggregate(chars, start, step)["sum"] / n).otherwise(0.0)


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    text = F.coalesce(url, F.lit(""))
    digits = lambda c: F.length(c) - F.length(F.translate(c, "0123456789", ""))
    share = lambda part, c: F.when(F.length(c) > 0, part / F.length(c)).otherwise(0.0)
    query = F.regexp_extract(text, r"(?s)^[^?#]*\?([^#]*)", 1)
    count = lambda c, one: F.length(c) - F.length(F.translate(c, one, ""))
    found = {
        "url_length": F.length(text),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": count(path, "/"),
        "labels": F.when(F.length(host) > 0, count(host, ".") + 1).otherwise(0),
        "hyphens": count(host, "-"),
        "digit_ratio": share(digits(text), text),
        "host_digit_ratio": share(digits(host), host),
        "url_entropy": entropy(text),
        "host_entropy": entropy(host),
        "parameters": F.when(F.length(query) > 0, count(query, "&") + 1).otherwise(0),
        "fragment": F.contains(text, F.lit("#")).cast("int"),
    }
    return {k: F.round(v.cast("double"), 6) for k, v in found.items()}


_COUNTS = [f"{what}{f}" for what in "nb" for f in range(FOLDS)]


def host_statistics(judged: DataFrame) -> DataFrame:
    """(host, blocked 0/1 or null, fold) of every url -> one row a host, with the labelled (``n``) and blocked
    (``b``) urls of each fold under each of its ``SUFFIXES`` suffixes, as ``s<k>_n<fold>``.

    Urls are summed by host first; suffixes, hot as they may be, meet one row a host and task.
    """
    inside = {f: (F.col("fold") == f) & F.col("blocked").isNotNull() for f in range(FOLDS)}
    sums = [F.count(F.when(inside[f], 1)).alias(f"n{f}") for f in range(FOLDS)]
    sums += [F.coalesce(F.sum(F.when(inside[f], F.col("blocked").cast("long"))), F.lit(0)).alias(f"b{f}") for f in range(FOLDS)]
    hosts = written(judged.groupBy("host").agg(*sums), "url-hosts")
    levels = [
        F.struct(F.lit(k).alias("k"), F.substring_index("host", ".", -k).alias("suffix")) for k in range(1, SUFFIXES + 1)
    ]
    each = hosts.select("host", F.explode(F.array(*levels)).alias("s"), *_COUNTS).select("host", "s.*", *_COUNTS)
    total = each.groupBy("k", "suffix").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    back = each.select("host", "k", "suffix").join(total, ["k", "suffix"])
    names = [(k, c) for k in range(1, SUFFIXES + 1) for c in _COUNTS]
    wide = back.groupBy("host").agg(*[F.max(F.when(F.col("k") == k, F.col(c))).alias(f"s{k}_{c}") for k, c in names])
    return written(wide, "url-suffixes")


def suffix_features(own_fold: Column) -> dict[str, Column]:
    """Of each suffix the share of blocked urls and how many there are, without those of ``own_fold`` (null: with all)."""
    found = {}
    for k in range(1, SUFFIXES + 1):
        sums = []
        for what in "nb":
            parts = [F.col(f"s{k}_{what}{f}") for f in range(FOLDS)]
            own = F.element_at(F.array(*parts), own_fold + 1)
            sums.append(sum(parts[1:], parts[0]) - F.coalesce(own, F.lit(0)))
        found[f"suffix{k}_share"] = F.round((sums[1] + 1.0) / (sums[0] + 2.0), 6)
        found[f"suffix{k}_urls"] = F.round(F.log2(sums[0] + 1.0), 6)
    return found


class Trees(NamedTuple):
    base: float
    trees: list  # a tree is a float, or (feature, edge, tree if value <= edge, tree if not)


def _value(tree) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    feature, edge, low, high = tree
    return F.when(F.col(feature) <= edge, _value(low)).otherwise(_value(high))


def margin(model: Trees) -> Column:
    return sum((_value(t) for t in model.trees), F.lit(model.base))


def fit(rows: DataFrame, features: list[str], trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosted trees for ``blocked`` (0 or 1) in ``rows``, which are read once a level.

    Without rows the margin is -1 everywhere (allow); where all have one label, there is no tree.
    """
    told = rows.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum("blocked"), F.lit(0)).alias("blocked"),
        *[F.percentile(f, [i / BINS for i in range(1, BINS)]).alias(f) for f in features],
    ).head()
    if not told["n"]:
        return Trees(-1.0, [])
    base = math.log((told["blocked"] + 0.5) / (told["n"] - told["blocked"] + 0.5))
    edges = {f: sorted(set(told[f])) for f in features}
    model = Trees(base, [])
    if told["blocked"] in (0, told["n"]):
        return model
    bins = F.array(*[sum(((F.col(f) > e).cast("int") for e in edges[f]), F.lit(0)) for f in features])
    binned = written(rows.select("blocked", *features, bins.alias("bins")), "url-fit")
    for _ in range(trees):
        chance = (1.0 / (1.0 + F.exp(-margin(model)))).alias("chance")
        slope = F.round((F.col("chance") - F.col("blocked")) * UNIT).cast("long").alias("g")
        bend = F.round(F.col("chance") * (1.0 - F.col("chance")) * UNIT).cast("long").alias("h")
        sloped = binned.select("*", chance).select("*", slope, bend)
        splits, totals = {}, {}
        for level in range(depth):
            node = _node(splits, 1, level)
            each = sloped.select(node.alias("node"), "g", "h", F.posexplode("bins").alias("feature", "bin"))
            sums = each.where("node is not null").groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
            _split(sums.collect(), features, edges, splits, totals)  # nodes x features x bins, whatever the rows
        if not splits:
            break
        model.trees.append(_tree(splits, totals, 1))
    return model


def _node(splits: dict, at: int, level: int) -> Column:
    """Number of the node that a row is in; null if that is no longer split."""
    if not level:
        return F.lit(at)
    if at not in splits:
        return F.lit(None).cast("int")
    feature, edge = splits[at]
    return F.when(F.col(feature) <= edge, _node(splits, 2 * at, level - 1)).otherwise(_node(splits, 2 * at + 1, level - 1))


def _split(sums: list, features: list[str], edges: dict, splits: dict, totals: dict) -> None:
    """Choose the best split of each node; of equal gains the first feature and the lowest edge."""
    by = defaultdict(lambda: defaultdict(dict))
    for r in sums:
        by[r["node"]][r["feature"]][r["bin"]] = (r["g"] / UNIT, r["h"] / UNIT)
    for node, histograms in by.items():
        g, h = (sum(v[i] for v in histograms[0].values()) for i in (0, 1))
        totals[node] = (g, h)
        best = (1e-6, None)
        for k, feature in enumerate(features):
            left_g = left_h = 0.0
            for b, edge in enumerate(edges[feature]):
                more = histograms[k].get(b, (0.0, 0.0))
                left_g, left_h = left_g + more[0], left_h + more[1]
                rest = h - left_h
                if left_h < LEAST or rest < LEAST:
                    continue
                gain = left_g**2 / (left_h + RIDGE) + (g - left_g) ** 2 / (rest + RIDGE) - g * g / (h + RIDGE)
                if gain > best[0] + 1e-9:
                    best = (gain, (feature, edge, left_g, left_h))
        if best[1]:
            feature, edge, left_g, left_h = best[1]
            splits[node] = (feature, edge)
            totals[2 * node], totals[2 * node + 1] = (left_g, left_h), (g - left_g, h - left_h)


def _tree(splits: dict, totals: dict, node: int):
    if node not in splits:
        g, h = totals[node]
        return -RATE * g / (h + RIDGE)
    return (*splits[node], _tree(splits, totals, 2 * node), _tree(splits, totals, 2 * node + 1))


def judge(pages: DataFrame, rules: tuple = RULES, labelled: DataFrame | None = None, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Every row of ``pages`` (page_id, url) with host, path, rule, verdict and score (the trees' probability of
    ``block``, also where a rule decides).

    Labels come from ``labelled`` (url, blocked 0/1) or, without it, from the rules: a url that a rule decides is
    a labelled one.  A null url has an empty host and path and is judged like any other; repeated rows are judged
    alike and all returned; an empty table gives no rows; other columns are ignored.  Without any labelled url all
    that no rule decides is allowed.  A url without ``://`` has features of its text only.
    """
    names = ["page_id", "url"]
    seen = _judged(pages.select(*names), rules)
    known = seen if labelled is None else _judged(labelled.select("url", "blocked"), rules)
    counted = known if labelled is None else known.unionByName(seen.drop("page_id").withColumn("blocked", F.lit(None).cast("int")))
    hosts = host_statistics(counted.select("host", "blocked", "fold"))
    with_labels = threshold_sample(known.where("blocked is not null"), fit_rows, F.coalesce("url", F.lit("")))
    text = lexical(F.col("url"), F.col("host"), F.col("path"))
    features = [*text, *suffix_features(F.lit(None))]
    own = suffix_features(F.col("fold"))
    model = fit(with_labels.join(hosts, "host").select("blocked", *[(text | own)[f].alias(f) for f in features]), features)
    every = seen.join(hosts, "host").select(
        "page_id", "host", "path", "rule", "says", *[v.alias(f) for f, v in (text | suffix_features(F.lit(None))).items()]
    )
    z = margin(model)
    verdict = F.coalesce("says", F.when(z > 0, "block").otherwise("allow"))
    return every.select("page_id", "host", "path", "rule", verdict.alias("verdict"), (1 / (1 + F.exp(-z))).alias("score"))


def _judged(urls: DataFrame, rules: tuple) -> DataFrame:
    host, path = address(F.col("url"))
    rule, says = ruling(F.col("host"), F.col("path"), rules)
    placed = urls.withColumns({"host": host, "path": path})
    fold = (F.crc32(F.coalesce("url", F.lit("")).cast("binary")) % FOLDS).cast("int")
    found = placed.withColumns({"rule": rule, "says": says, "fold": fold})
    return found if "blocked" in urls.columns else found.withColumn("blocked", (F.col("says") == "block").cast("int"))


def op12_url_filter(spark, sf_dir):
    """The verdict on every page's url."""
    return judge(table(spark, sf_dir, "pages"))
