"""Sharding by balanced label propagation.

Documents with equal texts are linked through a hub, their text's digest.  Each
round the hub takes, among the shards with room left, the one where most of its
documents stand, and the documents standing where fewer do ask to move there.
A shard's quota is the place it has left; requests are admitted by the number
of documents that wait there, in whole lots, until the quota is used up.  Lots
are small groups whole, or slices of a large group.  A shard that had to refuse
counts as full from then on, so a group larger than a shard fills one shard
after another instead of staying scattered.

Unlinked documents then fill every shard to its size: law ``rows``, counts at
most one apart.  Places are numbered without a window over a shard: rows are
numbered inside about sqrt(rows) ranges of a hash, and a range starts where the
ranges before it end.  Hot texts are counted before they are shuffled, and the
joins on them are plain equi-joins that Spark may split.  Every round is a
written table.  DataFrame functions only; the driver sees one row per shard.

Defined results: null text counts as empty (size 8, crc 0) and groups with the
empty text; null or repeated ids are rows like others; rows equal in id and text
may swap places; fewer rows than shards leave shards empty; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored

SLICES = 64  # lots that a large group is cut into
LOTS = 256  # lots a shard tells apart at one number of waiting documents


def numbered(rows: DataFrame, within: list[str], n: int, name: str) -> DataFrame:
    """Add ``name``: place of each row, from 0, among the rows equal in
    ``within``, in the order of the column ``mark`` (a 64-bit hash)."""
    ranges = max(1, math.isqrt(n))
    part = F.floor((F.col("mark") / F.lit(2.0 ** 64) + 0.5) * ranges).cast("int")
    rows = rows.withColumn("part", F.least(part, F.lit(ranges - 1)))
    parts = rows.groupBy(*within, "part").agg(F.count(F.lit(1)).alias("in_part"))
    ahead = (Window.partitionBy(*within).orderBy("part")
             .rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(*within, "part", F.coalesce(F.sum("in_part").over(ahead), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy(*within, "part").orderBy("mark", "doc_id", "grp")
    rows = rows.withColumn("inside", F.row_number().over(inside) - 1)
    out = rows.join(parts, [*within, "part"])
    return out.withColumn(name, F.col("ahead") + F.col("inside")).drop("part", "ahead", "inside")


def grouped(docs: DataFrame, text: str, seed: int) -> DataFrame:
    """doc_id, size, text_crc32, grp (text digest), mark (hash of the row) and
    n_group (documents with that text)."""
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(body) + 8).cast("long").alias("size"),
                       F.crc32(body).cast("long").alias("text_crc32"),
                       F.md5(body).alias("grp"))
    rows = stored(rows.withColumn("mark", F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), "grp")),
                  "shard-rows")
    # Stored, so that the join below is one of plain exchanges, which Spark may split.
    many = stored(rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n_group")).filter("n_group > 1"),
                  "shard-texts")
    return rows.join(many, "grp", "left").na.fill({"n_group": 1})


def sizes(n: int, shards: int) -> list[int]:
    return [n // shards + (s < n % shards) for s in range(shards)]


def pick(values: list[int], index: Column) -> Column:
    """The value of a short list at an index from 0."""
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), (index + 1).cast("int"))


def per_shard(rows: DataFrame, shards: int) -> list[int]:
    """Rows in each shard; one number a shard reaches the driver."""
    got = {r["shard"]: r["n"] for r in rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [got.get(s, 0) for s in range(shards)]


def propagate(linked: DataFrame, room: list[int]) -> DataFrame:
    """One round: ``linked`` (with shard) after the admitted moves.

    room: places left in each shard.
    """
    votes = linked.groupBy("grp", "shard").agg(F.count(F.lit(1)).alias("here"))
    open_votes = votes.filter(pick(room, F.col("shard")) > 0)
    best = (open_votes.groupBy("grp").agg(F.max(F.struct(
        F.col("here"), F.xxhash64("grp", "shard").alias("toss"), F.col("shard"))).alias("b"))
        .select("grp", F.col("b.shard").alias("goal"), F.col("b.here").alias("there"),
                F.col("b.toss").alias("toss")))
    # Who stands where fewer documents of the group do asks to move.
    asks = stored(votes.join(best, "grp").filter(
        (F.col("shard") != F.col("goal"))
        & (F.struct("here", F.xxhash64("grp", "shard")) < F.struct("there", "toss")))
        .select("grp", "shard", "goal", "there",
                F.sum("here").over(Window.partitionBy("grp")).alias("asking")), "shard-asks")
    slice_ = F.when(F.col("asking") > SLICES, F.pmod(F.col("mark"), F.lit(SLICES))).otherwise(F.lit(0))
    moving = linked.join(asks, ["grp", "shard"], "left").withColumn(
        "waits", -F.log2(F.col("there").cast("double")).cast("int")).withColumn(
        "lot", F.pmod(F.xxhash64("grp", slice_), F.lit(LOTS)))
    lots = moving.filter("goal IS NOT NULL").groupBy("goal", "waits", "lot").agg(
        F.count(F.lit(1)).alias("n"))
    queue = Window.partitionBy("goal").orderBy("waits", "lot")
    admitted = (lots.withColumn("upto", F.sum("n").over(queue))
                .filter(F.col("upto") <= pick(room, F.col("goal")))
                .select("goal", "waits", "lot", F.lit(True).alias("admitted")))
    return moving.join(admitted, ["goal", "waits", "lot"], "left").select(
        "doc_id", "size", "text_crc32", "grp", "mark", "n_group",
        F.when(F.col("admitted"), F.col("goal")).otherwise(F.col("shard")).cast("int").alias("shard"),
        F.coalesce("admitted", F.lit(False)).alias("moved"),
        F.when(F.col("admitted").isNull(), F.col("goal")).alias("refused"))


def shard(docs: DataFrame, shards: int = 24, text: str = "text", seed: int = 7) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    Rounds follow until none moves a document or fills a shard.  That comes: each
    admitted document joins a shard that holds no fewer of its group than the one
    it leaves, so the sum of squares of the groups' counts rises, and a shard that
    refused stays closed."""
    all_rows = stored(grouped(docs, text, seed), "shard-groups")
    n = all_rows.count()
    target = sizes(n, shards)
    linked = stored(all_rows.filter("n_group > 1").withColumn(
        "shard", F.pmod(F.xxhash64("mark"), F.lit(shards)).cast("int")), "shard-round")
    held = per_shard(linked, shards)
    full: set[int] = set()  # shards that had to refuse: their quota is used up
    while True:
        room = [0 if s in full else max(0, t - h) for s, (t, h) in enumerate(zip(target, held))]
        linked = stored(propagate(linked, room), "shard-round")
        held = per_shard(linked, shards)
        moved = linked.agg(F.count_if("moved").alias("n"), F.collect_set("refused").alias("by")).collect()[0]
        if not moved["n"] and full.issuperset(moved["by"]):
            break
        full.update(moved["by"])
    # Linked documents keep their shard up to its size; the others fill up.
    placed = stored(numbered(linked, ["shard"], n, "slot"), "shard-linked")
    fits = F.col("slot") < pick(target, F.col("shard"))
    columns = ["doc_id", "size", "text_crc32", "grp", "mark"]
    free = placed.filter(~fits).select(*columns).unionByName(
        all_rows.filter("n_group = 1").select(*columns))
    held = [min(t, h) for t, h in zip(target, held)]
    starts = [sum(t - h for t, h in zip(target[:s], held[:s])) for s in range(shards)]
    lane = F.array(*[F.lit(x).cast("long") for x in starts])
    # The last shard that starts at or before the place and is not full.
    filled = (numbered(free, [], n, "place")
              .withColumn("shard", F.size(F.filter(lane, lambda x: x <= F.col("place"))) - 1)
              .withColumn("slot", F.col("place") - pick(starts, F.col("shard"))
                          + pick(held, F.col("shard"))))
    out = ["doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
           F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
           F.lit(None).cast("int").alias("grown_shard")]
    return placed.filter(fits).select(*out).unionByName(filled.select(*out))
