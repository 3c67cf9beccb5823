r"""Prefix trie of rebuilt conversations, by composable fingerprints.

Conversation c is rebuilt as the first h turns of another one, its base, and its own turns after its first h.  Turns are
elements of a monoid: (length, sum of x[i] * B**i modulo a prime), where (l, s) * (m, t) = (l + m, s + B**l * t).  So the
running sums S of the original conversations are enough: the first d turns of a rebuilt one have the fingerprint

    S_base(d)                                           up to the head's end, and behind it
    S_base(k) + B**(k - h) * (S_own(i) - S_own(h))       with d = k + i - h, k turns of the head.

No rebuilt text is made anywhere.  Running sums are taken over range partitions and joined by what each partition
carries into the next, so a conversation of any length spans as many tasks as it needs.

Prefixes of one depth and fingerprint are a node.  Equality is not left to the hash: a node's members must have the
same parent and last turns of the same hash, which is grouped by; that turns of one hash have one role and text is
checked on the stored turns that the nodes refer to.

Sums over subtrees need no walk through the depths.  A node belongs to its smallest member, and the nodes of a conversation
are the deep end of its path.  Hence what lies below a node is the sum, over its members, of the totals of their own
nodes, less those of its own conversation above it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.attach import local_frame
from .common import slices, table, written
from .mixing import n_words

GROUP, HEADS = 20, 4  # the base of c is c - c % GROUP; its head has crc32(c) % HEADS turns
PRIME = (1 << 127) - 1
BASE = 0x5DEECE66D1B54A32D192ED03A3C59AC3 % PRIME
INVERSE = pow(BASE, -1, PRIME)
ROOT = bytes(16)  # fingerprint of no turns
DEPTH_BUCKET = 1 << 12
CHUNK = 1 << 15  # ids joined at a time


def head_length(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def _power(k: int) -> int:
    return pow(BASE, k, PRIME) if k >= 0 else pow(INVERSE, -k, PRIME)


def _element(a: int, b: int) -> int:
    """A turn's value, out of two 64-bit hashes."""
    return ((a & (1 << 64) - 1) << 64 | b & (1 << 64) - 1) % PRIME


def _number(value: bytes | None) -> int:
    return int.from_bytes(value, "big") if value else 0


def _bytes(value: int) -> bytes:
    return (value % PRIME).to_bytes(16, "big")


def stored_turns(conversations: DataFrame) -> DataFrame:
    """The turns as they are stored: ``ref``, conv_id, turn, role, text, two hashes ``a`` and ``b``, words, and ``tie``,
    which orders turns of one number and role."""
    held = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    hashed = held.select(
        F.monotonically_increasing_id().alias("ref"),
        "*",
        F.xxhash64(F.lit(1), "role", "text").alias("a"),
        F.xxhash64(F.lit(2), "text", "role").alias("b"),
        n_words(F.col("text")).alias("words"),
        F.substring(F.sha2(F.col("text").cast("binary"), 256), 1, 16).alias("tie"),
    )
    return written(hashed, "turns")


def _verify_turns(turns: DataFrame) -> None:
    """Stop if different turns share their hashes; each text is shuffled once, copies of it not at all."""
    different = turns.select("a", "b", "role", "text").distinct()
    if not different.groupBy("a", "b").count().where("count > 1").isEmpty():
        raise RuntimeError("two different turns have the same 128 bits of hash: take other seeds")


_SCANNED = "part int, conv_id long, pos long, sum binary, ref long, a long, b long, words long"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and running sum of each turn in its conversation, as far as this partition has it."""
    part, conv, pos, total, power = TaskContext.get().partitionId(), None, 0, 0, 1
    for batch in slices(batches, 4096):
        places, sums = [], []
        columns = {name: batch.column(name).to_pylist() for name in ("conv_id", "a", "b")}
        for c, a, b in zip(columns["conv_id"], columns["a"], columns["b"]):
            if c != conv:
                conv, pos, total, power = c, 0, 0, 1
            pos, power = pos + 1, power * BASE % PRIME
            total = (total + _element(a, b) * power) % PRIME
            places.append(pos)
            sums.append(_bytes(total))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part] * len(places), pa.int32()), batch.column("conv_id"), pa.array(places, pa.int64()),
                pa.array(sums, pa.binary()), *[batch.column(n) for n in ("ref", "a", "b", "words")],
            ],
            names=["part", "conv_id", "pos", "sum", "ref", "a", "b", "words"],
        )


def running_sums(turns: DataFrame) -> DataFrame:
    """``pos`` and ``sum`` (S) of every turn of every original conversation, in turn order, null first."""
    spark = turns.sparkSession
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "tie", "ref"]
    slim = turns.select("conv_id", "turn", "role", "tie", "ref", "a", "b", "words")
    ordered = slim.repartitionByRange(*order).sortWithinPartitions(*order)
    scanned = written(ordered.mapInArrow(_scan, _SCANNED), "running")
    last = F.max(F.struct("conv_id", "pos", "sum"))
    ends = scanned.groupBy("part").agg(F.min("conv_id").alias("first"), last.alias("last")).collect()  # a row a partition
    carried, conv, pos, total = [], None, 0, 0
    for r in sorted(ends, key=lambda r: r["part"]):
        if r["first"] == conv:
            carried.append((r["part"], conv, pos, _bytes(total)))
        else:
            pos = total = 0
        if r["last"]["conv_id"] != r["first"]:
            pos = total = 0
        total = (total + _power(pos) * _number(r["last"]["sum"])) % PRIME
        conv, pos = r["last"]["conv_id"], pos + r["last"]["pos"]
    schema = "part int, conv_id long, before long, carry binary"
    table_ = local_frame(spark, carried, spark.createDataFrame([], schema).schema)
    joined = scanned.join(F.broadcast(table_), ["part", "conv_id"], "left")  # at most a row a partition
    fields = ["conv_id", "pos", "sum", "ref", "a", "b", "words"]

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            at = {name: k for k, name in enumerate(batch.schema.names)}
            places, sums = batch.column(at["pos"]).to_pylist(), batch.column(at["sum"]).to_pylist()
            for k, before in enumerate(batch.column(at["before"]).to_pylist()):
                if before:
                    more = _number(batch.column(at["carry"])[k].as_py())
                    sums[k] = _bytes(more + _power(before) * _number(sums[k]))
                    places[k] += before
            new = {"pos": pa.array(places, pa.int64()), "sum": pa.array(sums, pa.binary())}
            yield pa.RecordBatch.from_arrays([new[n] if n in new else batch.column(at[n]) for n in fields], names=fields)

    return joined.mapInArrow(carry, _SCANNED.removeprefix("part int, "))


def rebuilt(sums: DataFrame) -> DataFrame:
    """One row a conversation: its length, ``h``, the base's first turns (``heads``), ``k`` of which are its head, S_own(h)
    and S_base(k), and the length it has when rebuilt."""
    length = sums.groupBy("conv_id").agg(F.max("pos").alias("length"))
    turn = F.struct("pos", "sum", "ref", "a", "b", "words")
    first = sums.where(F.col("pos") < HEADS).groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("heads"))  # 3 turns at most
    convs = written(length.join(first, "conv_id").withColumn("h", head_length(F.col("conv_id")).cast("int")), "conversations")
    base = convs.select(F.col("conv_id").alias("base"), F.col("heads").alias("base_heads"))
    joined = convs.join(base, F.col("conv_id") - F.col("conv_id") % GROUP == F.col("base"), "left")
    k = F.least(F.col("h"), F.coalesce(F.size("base_heads"), F.lit(0)))
    at = lambda turns, n: F.when(n > 0, F.get(F.col(turns), n - 1)["sum"])
    found = joined.select(
        "conv_id",
        "h",
        k.cast("int").alias("k"),
        F.when(k > 0, F.slice("base_heads", F.lit(1), k)).alias("head"),
        at("base_heads", k).alias("head_sum"),
        at("heads", F.col("h")).alias("own_sum"),
        (k + F.greatest(F.col("length") - F.col("h"), F.lit(0))).alias("total"),
    )
    return written(found, "rebuilt")


_MEMBERS = "conv_id long, depth long, print binary, parent_print binary, a long, b long, words long, ref long, last boolean"


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints behind the head."""
    names = [x.split()[0] for x in _MEMBERS.split(", ")]
    for batch in slices(batches, 4096):
        rows = []
        for r in batch.to_pylist():
            shift, here = r["k"] - r["h"], _number(r["sum"])
            start = _number(r["head_sum"]) - _power(shift) * _number(r["own_sum"])
            above = here - _element(r["a"], r["b"]) * _power(r["pos"])
            depth = shift + r["pos"]
            prints = [_bytes(start + _power(shift) * s) if d else ROOT for d, s in ((depth, here), (depth - 1, above))]
            rows.append((r["conv_id"], depth, *prints, r["a"], r["b"], r["words"], r["ref"], depth == r["total"]))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 4, pa.bool_()]
        columns = [pa.array(v, kind) for v, kind in zip(zip(*rows) if rows else [()] * len(kinds), kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def memberships(sums: DataFrame, convs: DataFrame) -> DataFrame:
    """(conversation, depth) with the fingerprints of its prefix of that depth and of the one above."""
    slim = convs.select("conv_id", "h", "k", "head_sum", "own_sum", "total")
    own = sums.join(slim, "conv_id").where("pos > h").mapInArrow(_own, _MEMBERS)
    each = convs.where("k > 0").select("conv_id", "total", "head", F.posexplode("head").alias("at", "t"))
    above = F.when(F.col("at") > 0, F.get("head", F.col("at") - 1)["sum"]).otherwise(F.lit(ROOT))
    depth = F.col("at").cast("long") + 1
    head = each.select(
        "conv_id", depth.alias("depth"), F.col("t.sum").alias("print"), above.alias("parent_print"),
        "t.a", "t.b", "t.words", "t.ref", (depth == F.col("total")).alias("last"),
    )
    return written(own.union(head), "members")


def _digests(ends: DataFrame) -> DataFrame:
    """(depth, print, conv_id) -> (depth, print, ends_sha256).

    Ids are put in order and joined over range partitions, so a node where very many conversations end comes to the
    task that digests it as few long texts, which it reads one after the other.
    """
    key = ["depth", "print"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, first, ids = [], None, None, []
        for batch in batches:
            for depth, node, conv in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if (depth, node) != held or len(ids) >= CHUNK:
                    if ids:
                        rows.append((*held, first, ",".join(map(str, ids))))
                    held, first, ids = (depth, node), conv, []
                ids.append(conv)
            if rows:
                yield chunk(rows)
                rows = []
        if ids:
            yield chunk([(*held, first, ",".join(map(str, ids)))])

    def chunk(rows: list) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.large_string()]
        columns = [pa.array(v, kind) for v, kind in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays([*columns[:3], columns[3].cast(pa.string())], names=["depth", "print", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None
        for batch in batches:
            done = []
            for depth, node, _, ids in zip(*(batch.column(c) for c in range(4))):
                if (key := (depth.as_py(), node.as_py())) != held:
                    if held:
                        done.append((*held, state.hexdigest()))
                    held, state = key, hashlib.sha256(ids.as_py().encode())
                else:
                    state.update(b"," + ids.as_py().encode())
            if done:
                yield digests(done)
        if held:
            yield digests([(*held, state.hexdigest())])

    def digests(rows: list) -> pa.RecordBatch:
        columns = [pa.array(v, kind) for v, kind in zip(zip(*rows), [pa.int64(), pa.binary(), pa.string()])]
        return pa.RecordBatch.from_arrays(columns, names=["depth", "print", "ends_sha256"])

    order = [*key, "conv_id"]
    listed = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    chunks = listed.mapInArrow(join, "depth long, print binary, first long, ids string")
    gathered = chunks.repartition(*key).sortWithinPartitions(*key, "first")
    return gathered.mapInArrow(digest, "depth long, print binary, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256, and ``ref``, a stored turn that is the node's last.

    Rows without conv_id belong to no conversation.  A null turn comes first; turns of one number come by role, then by
    the digest of their text; repeated rows are turns of their own.  Null roles and texts are empty ones.  A conversation whose
    base has no rows keeps its own turns after the first h, and may have none.  An empty table has no node, not even a
    root.  Other columns are ignored.
    """
    turns = stored_turns(conversations.select("conv_id", "turn", "role", "text"))
    _verify_turns(turns)
    sums = running_sums(turns)
    convs = rebuilt(sums)
    everyone = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    members = memberships(sums, convs)
    node = ["depth", "print"]
    grouped = members.groupBy(*node, "parent_print", "a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"), F.min("ref").alias("ref")
    )
    root = everyone.where("n_convs > 0").select(
        F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("print"), F.lit(None).cast("binary").alias("parent_print"),
        "conv_id", "n_convs", F.lit(0).cast("long").alias("words"), F.lit(None).cast("long").alias("ref"),
    )
    nodes = written(grouped.drop("a", "b").unionByName(root), "nodes")
    if not nodes.groupBy(*node).count().where("count > 1").isEmpty():
        raise RuntimeError("different prefixes have one fingerprint: take another base")

    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_print").alias("print"))
    nodes = written(nodes.join(children.agg(F.count("*").alias("n_children")), node, "left"), "parents")

    # Of each conversation's own nodes: what they save, in all and above a node, and whether one is a leaf.
    bucket = F.floor(F.col("depth") / DEPTH_BUCKET).alias("bucket")
    shared = nodes.where("n_convs > 1").select(*node, "conv_id", bucket, ((F.col("n_convs") - 1) * F.col("words")).alias("saves"))
    per_bucket = shared.groupBy("conv_id", "bucket").agg(F.sum("saves").alias("saves"))
    earlier = Window.partitionBy("conv_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = per_bucket.select("conv_id", "bucket", F.coalesce(F.sum("saves").over(earlier), F.lit(0)).alias("before"))
    higher = Window.partitionBy("conv_id", "bucket").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    within = shared.withColumn("above", F.coalesce(F.sum("saves").over(higher), F.lit(0)))
    above = within.join(buckets, ["conv_id", "bucket"]).select(*node, (F.col("above") + F.col("before")).alias("above"))
    leaves = nodes.where("n_children is null").select("conv_id", F.lit(0).cast("long").alias("saves"), F.lit(1).alias("leaf"))
    saving = per_bucket.select("conv_id", "saves", F.lit(0).alias("leaf"))
    marks = saving.union(leaves).groupBy("conv_id").agg(F.sum("saves").alias("saves"), F.sum("leaf").alias("leaf"))
    marks = written(marks, "marks")
    below = members.join(marks, "conv_id").groupBy(*node).agg(F.sum("saves").alias("saves"), F.sum("leaf").alias("leaves"))
    all_marks = marks.agg(F.sum("saves").alias("saves"), F.sum("leaf").alias("leaves"))
    below = below.union(all_marks.select(F.lit(0).cast("long"), F.lit(ROOT), "saves", "leaves"))

    turnless = convs.where("total = 0").select(F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("print"), "conv_id")
    digests = _digests(members.where("last").select(*node, "conv_id").union(turnless))
    top = everyone.select(F.lit(1).cast("long").alias("depth"), F.lit(ROOT).alias("parent_print"), F.col("conv_id").alias("parent_conv_id"))
    inner = nodes.where("n_children is not null and depth > 0")
    parents = inner.select((F.col("depth") + 1).alias("depth"), F.col("print").alias("parent_print"), F.col("conv_id").alias("parent_conv_id"))
    first = nodes.where("depth <= 1").join(F.broadcast(top), ["depth", "parent_print"], "left")  # one row
    deeper = nodes.where("depth > 1").join(parents, ["depth", "parent_print"], "left")
    whole = first.unionByName(deeper).join(below, node, "left").join(above, node, "left").join(digests, node, "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return whole.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.coalesce("leaves", F.lit(0)).cast("long").alias("n_leaves"),
        F.when(F.col("n_convs") > 1, F.col("saves") - F.coalesce("above", F.lit(0))).otherwise(0).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        "ref",
    )


def op13_prefix_trie(spark, sf_dir):
    """The trie of all conversations."""
    return trie(table(spark, sf_dir, "conversations")).drop("ref")


OP13_SQL = r"""
WITH o AS (
  SELECT conv_id AS c, md5(json_array(coalesce(role, ''), coalesce(text, ''))::VARCHAR) AS m,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, encode(coalesce(role, '')), substr(sha256(coalesce(text, '')), 1, 16)) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
g AS (SELECT DISTINCT c FROM o),
k AS (
  SELECT c, c - c % 20 AS base,
         xor(list_reduce(list_transform(range(1, len(c::VARCHAR) + 1), lambda i: ord(substr(c::VARCHAR, i::INT, 1))::BIGINT),
           lambda crc, byte: list_reduce(range(8)::BIGINT[],
             lambda a, i: xor(a >> 1, 3988292384 * (a & 1)), xor(crc, byte)), 4294967295), 4294967295) % 4 AS h
  FROM g),
t AS (
  SELECT k.c, o.pos AS d, m, words FROM k JOIN o ON o.c = k.base AND o.pos <= k.h
  UNION ALL
  SELECT k.c, o.pos - k.h + least(k.h, (SELECT count(*) FROM o b WHERE b.c = k.base)), m, words
  FROM k JOIN o ON o.c = k.c AND o.pos > k.h),
p AS (
  SELECT c, d, words, string_agg(m, '') OVER (PARTITION BY c ORDER BY d) AS node FROM t
  UNION ALL SELECT c, 0, 0, '' FROM g),
e AS (SELECT c, max(d) AS total FROM p GROUP BY c),
n AS (
  SELECT node, p.d, min(p.c) AS conv_id, count(*) AS n_convs, max(words) AS words,
         sha256(coalesce(string_agg(p.c::VARCHAR, ',' ORDER BY p.c) FILTER (WHERE p.d = e.total), '')) AS ends_sha256
  FROM p JOIN e ON e.c = p.c GROUP BY node, p.d),
ch AS (SELECT left(node, (32 * (d - 1))::BIGINT) AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch USING (node)),
s AS (
  SELECT left(node, (32 * a)::BIGINT) AS node, sum((n_convs - 1) * words) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM f) GROUP BY 1)
SELECT f.conv_id, f.d::BIGINT AS depth, CASE WHEN f.d > 0 THEN up.conv_id END AS parent_conv_id, f.n_convs::BIGINT AS n_convs,
       f.n_children::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN s USING (node) LEFT JOIN f up ON up.node = left(f.node, (32 * (f.d - 1))::BIGINT) AND up.d = f.d - 1
"""
