"""Positions by the counts a log keeps: where a bounded read ends is looked up, not counted.

A log keeps how many messages each subject has in each bucket of numbers.  The bucket in which a split's bound falls
follows from these; only that bucket, and the one its start falls into, are read to find the last number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import materialise, scratch_path
from ..sources.log import COUNT_BUCKET, read_counts, read_log
from .attach import attach, local_frame, small_rows
from .match import match
from .subscribe import WITHIN_BOUND, positioned, select_splits, subscribe

_COARSE = 1 << 12  # buckets of counts that are first taken together


def split_buckets(spark: SparkSession, path: str, positions: DataFrame, rows: list[Row] | None = None) -> DataFrame:
    """(split_id, stream, bucket, rows, first, last, from_seq, remaining) of the counts that a split reads of, written
    once.  ``rows`` are those of ``positions``, if they are few."""
    counts = read_counts(spark, path).where("bucket IS NOT NULL").withColumnRenamed("rows", "n").withColumn("seq", F.col("last"))
    hits = match(counts, positions, rows=rows).where(F.col("last") >= F.col("from_seq"))
    held = hits.groupBy("split_id", "stream", "bucket", "from_seq", "remaining").agg(
        F.sum("n").alias("rows"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    return materialise(held, scratch_path(spark, "buckets"))


def _numbers_only(spark: SparkSession, positions: DataFrame) -> tuple[DataFrame, list[Row] | None]:
    """Positions without a start in time, and their rows if they are few: then as a local table."""
    bare = positions.withColumn("from_time", F.lit(None).cast("timestamp_ntz"))
    rows = small_rows(bare)
    return (bare if rows is None else local_frame(spark, rows, bare.schema)), rows


def ends_by_counts(spark: SparkSession, path: str, positions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((split_id, __last): the number of the last message within the bound, for splits with more; the log's rows that
    were read for it).  Splits without a bound have no row."""
    log = read_log(spark, path)
    bare, listed = _numbers_only(spark, positions.where("remaining > 0"))
    held = split_buckets(spark, path, bare, listed)
    # A bucket that begins before the start counts from there on.
    cut = held.where("first < from_seq")
    counted = held
    if not cut.isEmpty():
        begun = _rows_of(log, cut, bare, listed).groupBy("split_id", "bucket").agg(F.count("*").alias("begun"))
        exact = F.when(F.col("first") < F.col("from_seq"), F.coalesce("begun", F.lit(0))).otherwise(F.col("rows"))
        counted = held.join(begun, ["split_id", "bucket"], "left").withColumn("rows", exact)
    coarse = counted.select("split_id", "stream", "bucket", "remaining", "rows", F.floor(F.col("bucket") / _COARSE).alias("coarse"))
    steps = coarse.groupBy("split_id", "remaining", "coarse").agg(F.sum("rows").alias("rows"))
    found = _passed(steps, "coarse", F.col("remaining"), ["split_id"])
    inside = coarse.join(found.select("split_id", "coarse", "need"), ["split_id", "coarse"])
    edge = _passed(inside, "bucket", F.col("need"), ["split_id"]).select("split_id", "stream", "bucket", "need")
    edge = materialise(edge, scratch_path(spark, "edges"))
    read = _rows_of(log, edge, bare, listed)
    ranked = attach(read, edge.select("split_id", "need"), ["split_id"]).withColumn(
        "rank", F.row_number().over(Window.partitionBy("split_id").orderBy("seq"))
    )
    last = ranked.where("rank <= greatest(need, 1)").groupBy("split_id").agg(
        F.when(F.max("need") > 0, F.max("seq")).otherwise(F.min("seq") - 1).alias("__last")
    )
    return materialise(last, scratch_path(spark, "ends")), read


def _passed(steps: DataFrame, step: str, need: Column, keys: list[str]) -> DataFrame:
    """The step in which the running count of ``rows`` goes beyond ``need``, with what is needed of it."""
    upto = F.sum("rows").over(Window.partitionBy(*keys).orderBy(step))
    before = upto - F.col("rows")
    run = steps.select("*", need.alias("__need"), upto.alias("__upto"), before.alias("__before"))
    found = run.where("__upto > __need AND __before <= __need AND rows > 0")
    return found.withColumn("need", F.col("__need") - F.col("__before")).drop("__need", "__upto", "__before")


def _rows_of(log: DataFrame, buckets: DataFrame, positions: DataFrame, listed: list[Row] | None) -> DataFrame:
    """(split_id, bucket, seq) of the messages in some buckets of some splits; the ranges reach the scan."""
    wanted = buckets.select("stream", "bucket").distinct()
    rows = small_rows(wanted, 64)
    slim = log.where("seq IS NOT NULL").select("stream", "subject", "seq", "ts", F.floor(F.col("seq") / COUNT_BUCKET).alias("bucket"))
    if rows is None:
        slim = attach(slim, wanted, ["stream", "bucket"])
    else:
        ranges = F.lit(False)
        for r in rows:
            low = r["bucket"] * COUNT_BUCKET
            ranges |= (F.col("stream") == r["stream"]) & F.col("seq").between(low, low + COUNT_BUCKET - 1)
        slim = slim.where(ranges)
    hits = select_splits(slim, positions, rows=listed)
    return attach(hits, buckets.select("split_id", "bucket"), ["split_id", "bucket"]).select("split_id", "bucket", "seq")


def subscribe_stored(spark: SparkSession, path: str, subs: DataFrame, progress: DataFrame | None = None, acks: DataFrame | None = None) -> DataFrame:
    """``subscribe`` over the log at ``path``: the same rows; ends come from the log's counts.

    A bounded split that starts at a time has its end counted, since counts know numbers only.  So have explicit durable
    consumers: what they acknowledged does not count.
    """
    log = read_log(spark, path)
    positions = positioned(subs, progress, acks)
    counted = F.col("remaining").isNotNull() & F.col("from_time").isNull()
    if acks is not None:
        counted &= F.col("durable_name").isNull()
    told = positions.agg(F.count_if(counted).alias("own"), F.count("*").alias("all")).head()
    if not told["own"]:
        return subscribe(log, subs, progress, acks)
    own, listed = _numbers_only(spark, positions.where(counted))
    ends, _ = ends_by_counts(spark, path, own)
    reach = ends.agg(F.count("*").alias("ends"), F.max("__last").alias("last")).head()
    bounded = log.where(F.col("seq") <= reach["last"]) if told["own"] == reach["ends"] else log
    hits = select_splits(bounded, own, rows=listed).where(WITHIN_BOUND)
    cut = attach(hits, ends, ["split_id"], "left").where("__last IS NULL OR seq <= __last").select(*log.columns, "split_id")
    if told["own"] == told["all"]:
        return cut
    rest = subs.join(positions.where(counted).select("split_id"), "split_id", "left_anti")
    return cut.unionByName(subscribe(log, rest, progress, acks))


def progress_by_counts(spark: SparkSession, path: str, subs: DataFrame, upto: int) -> DataFrame:
    """Last number and messages of splits that have read all up to ``upto``: counts of whole buckets, and the messages
    of the buckets that ``upto`` and a start fall into."""
    bare, listed = _numbers_only(spark, positioned(subs))
    held = split_buckets(spark, path, bare, listed).where(F.col("first") <= upto)
    within = (F.col("first") >= F.col("from_seq")) & (F.col("last") <= upto)
    read = _rows_of(read_log(spark, path), held.where(~within), bare, listed).where(F.col("seq") <= upto)
    parts = held.where(within).select("split_id", "rows", "last").unionByName(
        read.select("split_id", F.lit(1).cast("long").alias("rows"), F.col("seq").alias("last"))
    )
    return parts.groupBy("split_id").agg(F.max("last").alias("last_emitted_seq"), F.sum("rows").alias("messages"))
