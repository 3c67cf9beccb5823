"""Mix sources to target weights by nested hash thresholds: sums and filters, no sort of documents.

Each document has a hash key of ``LEVELS * LEVEL_BITS`` bits.  A source that is to give a part of its words
takes the documents below a threshold key.  The threshold is found by histograms: words summed by (source,
leading bits), then the one bucket that the budget ends in is refined by the next bits, and so on.  A source
of any size costs 2**LEVEL_BITS histogram rows a level; thresholds of growing budgets are nested, since a
larger budget ends at a larger key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

LEVEL_BITS = 10
LEVELS = 4
WEIGHTS = (3, 1, 2)
MOST = 2
SHARE = 1.5
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Words of a text; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def hash_key(doc_id: Column, text: Column) -> Column:
    """40 evenly spread bits of a document id (without one: of its text), the same in SQL: the leading hex
    digits of an md5."""
    named = F.coalesce(doc_id.cast("string"), F.concat(F.lit("t"), text), F.lit("null"))
    digest = F.md5(named.cast("binary"))
    return F.conv(F.substring(digest, 1, LEVELS * LEVEL_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, share: float = SHARE, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size) -> (source, source_size, target), one row per source.

    Sources by code point, null last, get ``weights`` in turn and share ``share`` of all words by them.  A
    target above ``most`` times its source's size stops there and the excess goes to the others by weight.
    In closed form: a level L with target = min(cap, L * weight); it is found where the sources, ordered by
    cap / weight, stop being capped.  One row per source meets in one task here, never documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    which = (F.row_number().over(by_name) - 1) % len(weights)
    listed = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.select("source", "source_size", F.element_at(listed, which + 1).alias("weight"))
    ranked = ranked.withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    ratio = F.col("cap") / F.col("weight")
    order = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    levelled = ranked.select(
        "*",
        ratio.alias("ratio"),
        (F.lit(float(share)) * F.sum("source_size").over(all_rows)).alias("total"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("capped"),
        (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("open"),
    ).withColumn("level", (F.col("total") - F.col("capped")) / F.col("open"))
    # the first source whose cap is not reached sets the level
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(all_rows)["level"]
    target = F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap")))
    return levelled.select("source", "source_size", target.alias("target"))


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, size, key) and (source, budget) -> (source, threshold): take the keys below it.

    Descends ``LEVELS`` histograms.  The last bucket (rows whose keys tie) is taken if that ends nearer to the
    budget.  A source with a budget of 0 or less gets threshold 0; one whose words do not fill it, 2**40.
    """
    top = 1 << (LEVELS * LEVEL_BITS)
    same_source = F.col("source").eqNullSafe(F.col("s"))
    open_ = budgets.where("budget > 0").select(
        F.col("source").alias("s"), "budget", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below")
    )
    for level in range(1, LEVELS + 1):
        left = (LEVELS - level) * LEVEL_BITS
        inside = F.shiftright("key", left + LEVEL_BITS) == F.col("prefix")
        rows = sized.select("source", "size", "key").join(open_, same_source & inside)
        summed = rows.groupBy("s", "budget", "below", F.shiftright("key", left).alias("bucket")).agg(
            F.sum("size").alias("words")
        )
        up_to = Window.partitionBy("s").orderBy("bucket")
        run = summed.withColumn("end", F.col("below") + F.sum("words").over(up_to))
        ends_in = run.where(F.col("end") > F.col("budget")).groupBy("s", "budget").agg(
            F.min(F.struct("bucket", "end", "words")).alias("b")
        )
        step = ends_in.select(
            "s",
            "budget",
            F.col("b.bucket").alias("prefix"),
            (F.col("b.end") - F.col("b.words")).alias("below"),
            F.col("b.words").alias("words"),
        )
        found = written(step, f"mix-level{level}")
        open_ = found.drop("words")
    overshoot = F.col("below") + F.col("words") - F.col("budget")
    nearer = overshoot < F.col("budget") - F.col("below")
    last = found.select("s", (F.col("prefix") + nearer.cast("long")).alias("threshold"))
    taken = F.when(F.col("budget") > 0, F.coalesce("threshold", F.lit(top))).otherwise(F.lit(0))
    return budgets.join(last, same_source, "left").select("source", taken.cast("long").alias("threshold"))


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size`` (words) and ``key`` (40 hash bits)."""
    return docs.withColumns({"size": n_words(F.col("text")), "key": hash_key(F.col("doc_id"), F.col("text"))})


def mix_plan(narrow: DataFrame, share: float = SHARE, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source: ``source_size``, ``target``, ``full`` (passes over the whole source) and the ``threshold``
    below which a document is taken once more.  ``narrow`` has source, size and key and is read several times."""
    sizes = narrow.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    targets = written(source_targets(sizes, share, weights, most), "mix-targets")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    targets = targets.withColumn("full", passes.cast("long"))
    budgets = targets.select("source", (F.col("target") - F.col("full") * F.col("source_size")).alias("budget"))
    cut = thresholds(narrow, budgets).select(F.col("source").alias("cut_source"), "threshold")
    planned = targets.join(cut, F.col("source").eqNullSafe(F.col("cut_source"))).drop("cut_source")
    return written(planned.withColumnRenamed("source", "plan_source"), "mix-plan")


def mix(narrow: DataFrame, share: float = SHARE, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """Rows with source, size and key -> the same with source_size, target, copies and taken (size * copies).

    Empty input gives no rows.  A null or unknown source is a source like any other; an empty or null text has
    size 0.  Repeated rows have one key, so all or none of them are taken.  Columns of the same names are
    replaced.  The plan has a row per source; Spark broadcasts it when it is small and else shuffles, splitting
    a hot source.
    """
    plan = mix_plan(narrow, share, weights, most)
    rows = narrow.drop("source_size", "target", "copies", "taken", "full", "threshold", "plan_source")
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
    copies = F.col("full") + (F.col("key") < F.col("threshold")).cast("long")
    return joined.withColumn("copies", copies).withColumn("taken", F.col("size") * F.col("copies")).drop(
        "plan_source", "full", "threshold"
    )


def mixed_documents(docs: DataFrame, share: float = SHARE, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """The documents that the mix takes, each as often as it is taken, with the columns of ``docs``."""
    names = docs.columns
    held = docs.select(F.struct(*names).alias("row"), "doc_id", "source", "text")
    marked = sized(held)
    narrow = written(marked.select("source", "size", "key"), "mix-sizes")
    plan = mix_plan(narrow, share, weights, most)
    joined = marked.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
    copies = F.col("full") + (F.col("key") < F.col("threshold")).cast("long")
    often = F.explode(F.array_repeat(F.lit(0), copies.cast("int")))
    return joined.select("row", often.alias("copy")).select("row.*")


def op2_mixing(spark, sf_dir):
    """Every document with its size and the words of it that a mix of 150 % of all words takes."""
    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    narrow = written(sized(docs).select("doc_id", "source", "size", "key"), "mix-sizes")
    return mix(narrow).select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^ 	-]+')) END::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 't' || text, 'null')), 1, 10))::BIGINT AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, ([3.0, 1.0, 2.0]::DOUBLE[])[1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS weight
      FROM s),
o AS (SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS ratio,
             1.5::DOUBLE * sum(source_size) OVER () AS total, sum(weight) OVER () AS weights FROM r),
l AS (SELECT *, (total - coalesce(sum(cap) OVER w, 0)) / (weights - coalesce(sum(weight) OVER w, 0)) AS level
      FROM o WINDOW w AS (ORDER BY ratio, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size,
             least(cap, coalesce((SELECT arg_min(level, ratio) FROM l WHERE level <= ratio) * weight, cap)) AS target
      FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS full_passes FROM t),
b AS (SELECT *, target - full_passes * source_size AS budget FROM p),
k AS (SELECT d.source, key, sum(size) AS words FROM d GROUP BY d.source, key),
e AS (SELECT k.source, key, words, budget,
             sum(words) OVER (PARTITION BY k.source ORDER BY key) AS upto
      FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source),
c AS (SELECT source, min(key) AS bound FROM e WHERE upto > budget GROUP BY source),
f AS (SELECT e.source, bound + CASE WHEN upto - budget < budget - (upto - words) THEN 1 ELSE 0 END AS threshold
      FROM e JOIN c ON e.source IS NOT DISTINCT FROM c.source AND e.key = c.bound)
SELECT doc_id, size, b.source_size, b.target,
       (size * (full_passes + CASE WHEN budget > 0 AND key < coalesce(threshold, 1099511627776) THEN 1 ELSE 0 END))::BIGINT
         AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
LEFT JOIN f ON d.source IS NOT DISTINCT FROM f.source
"""
