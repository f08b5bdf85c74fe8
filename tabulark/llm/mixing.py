"""Mixing sources to target weights by Sainte-Laguë apportionment.

Every source is a stream of its documents in a seeded order, cut into blocks of
``block`` words.  The blocks of the whole mix are seats: they go to the highest
quotients target / (2k - 1), source by source, which gives each output shard an
integer quota of blocks per source.  Highest averages are house monotone, so
the quotas of one shard are the difference of two apportionments.  A source
then gives whole passes over its stream and, for the rest, the first blocks of
its seeded order.

Seats are not enumerated.  With quota q = seats * share, a source surely wins
the seats below q * (1 - S / 2T) + 1/2 and never one above q * (1 + S / 2T)
+ 1/2 (S sources, T seats), so only about two seats a source are ranked.

A document's place in its stream is a running sum over the seeded order.  It is
taken in two steps, over about sqrt(rows) ranges of the order and inside each
range, so a source with a third of all rows is spread over all tasks.
DataFrame functions only.

Defined results: null text has size 0; a null source is a source, ordered last;
a null doc_id is ordered as the text 'null'; rows with equal id, source and
text share one place in the order and may swap results; an empty table gives an
empty mix; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(text: str) -> Column:
    """64-bit name of a row's id and text."""
    return F.xxhash64(F.col("doc_id").cast("string"), F.col(text).cast("string"))


def sized(docs: DataFrame, seed: int, text: str = "text") -> DataFrame:
    """doc_id, source, size and the row's place marks in the seeded order."""
    body = F.col(text).cast("string")
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
                  .cast("binary"))
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"),
                       n_words(body).alias("size"), order.alias("mark"), row_key(text).alias("tie"))
    return stored(rows, "mix-sizes")


def streams(sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents with ``before``: words of their source ahead of them in the
    seeded order; sources with their size)."""
    n = sizes.count()
    ranges = max(1, math.isqrt(n))
    part = F.floor(F.conv(F.substring("mark", 1, 8), 16, 10).cast("long") * F.lit(ranges)
                   / F.lit(2.0 ** 32)).cast("int")
    rows = sizes.withColumn("part", part)
    parts = rows.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("ahead", F.coalesce(F.sum("part_size").over(ahead), F.lit(0)))
    inside = (Window.partitionBy("source", "part").orderBy("mark", "doc_id", "tie", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    p = parts.select(F.col("source").alias("p_source"), F.col("part").alias("p_part"), "ahead")
    rows = rows.join(p, rows["source"].eqNullSafe(p["p_source"]) & (rows["part"] == p["p_part"]))
    placed = rows.select("doc_id", "source", "size", "tie", (F.col("ahead") + F.col("inside")).alias("before"))
    return placed, parts.groupBy("source").agg(F.sum("part_size").alias("source_size"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS,
            max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Add source_no (code point order, null last), weight, total and target.

    Targets share the sum of all sizes by weight, stop at ``max_repeats`` times
    the source's size, and what that leaves goes to the others by weight.  The
    windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    no = F.row_number().over(by_name)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.col("source_no") - 1) % len(weights) + 1).cast("int"))
    rows = (sources.withColumn("source_no", no).withColumn("weight", weight.cast("long"))
            .withColumn("cap", F.col("source_size") * max_repeats)
            .withColumn("total", F.sum("source_size").over(every)))
    # Sources reach their cap in the order of cap / weight.
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    upto = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(upto), F.lit(0)))
                           / F.sum("weight").over(rest))
    capped = F.col("cap") < F.col("weight") * F.col("level")
    rows = rows.withColumn("capped", capped)
    rows = rows.withColumn("level", F.coalesce(
        (F.col("total") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(every))
        / F.nullif(F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(every),
                   F.lit(0).cast("long")), F.lit(0.0)))
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        F.col("weight") * F.col("level"))
    return rows.withColumn("target", target).select("source", "source_no", "source_size", "weight",
                                                    "cap", "total", "target")


def quotas(with_targets: DataFrame, block: int, shards: int) -> DataFrame:
    """Blocks of each source in each shard: shard, source_no, blocks."""
    every = Window.partitionBy()
    seats = F.round(F.col("total") / F.lit(block)).cast("long")
    house = (with_targets.withColumn("seats", seats).withColumn("n", F.count(F.lit(1)).over(every))
             .withColumn("all", F.sum("target").over(every))
             .withColumn("upto", F.explode(F.sequence(F.lit(1), F.lit(shards))))
             .withColumn("house", F.floor(F.col("seats") * F.col("upto") / F.lit(shards)).cast("long")))
    q = F.coalesce(F.col("target") / F.nullif(F.col("all"), F.lit(0.0)), F.lit(0.0)) * F.col("house")
    slack = F.when(F.col("house") > 0, F.col("n") / (2.0 * F.col("house"))).otherwise(F.lit(0.0))
    sure = F.greatest(F.lit(0), F.ceil(q * F.greatest(F.lit(0.0), 1.0 - slack) - 0.5) - 1).cast("long")
    most = F.when(F.col("house") > 0, F.floor(q * (1.0 + slack) + 0.5) + 1).otherwise(F.lit(0)).cast("long")
    house = house.withColumn("sure", sure).withColumn("most", most)
    one = Window.partitionBy("upto")
    house = house.withColumn("open", F.col("house") - F.sum("sure").over(one))
    bids = house.filter("most > sure AND target > 0").select(
        "upto", "source_no", "target", "open",
        F.explode(F.sequence(F.col("sure") + 1, F.col("most"))).alias("k"))
    best = Window.partitionBy("upto").orderBy((F.col("target") / (2 * F.col("k") - 1)).desc(), "source_no")
    won = (bids.withColumn("place", F.row_number().over(best)).filter("place <= open")
           .groupBy("upto", "source_no").agg(F.count(F.lit(1)).alias("won")))
    seats = house.join(won, ["upto", "source_no"], "left").withColumn(
        "held", F.col("sure") + F.coalesce("won", F.lit(0)))
    before = Window.partitionBy("source_no").orderBy("upto")
    return seats.select((F.col("upto") - 1).alias("shard"), "source_no",
                        (F.col("held") - F.coalesce(F.lag("held").over(before), F.lit(0))).alias("blocks"))


def plan(docs: DataFrame, seed: int = 1, block: int = 16, shards: int = 8,
         weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, text: str = "text") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, passes
    (whole copies taken), part (words taken once more from the front of the
    text), taken = passes * size + part, and row_key."""
    placed, sources = streams(sized(docs, seed, text))
    sources = targets(sources, weights, max_repeats)
    blocks = quotas(sources, block, shards).groupBy("source_no").agg(F.sum("blocks").alias("blocks"))
    want = F.least(F.col("blocks") * block, F.col("cap"))
    passes = F.coalesce(F.floor(want / F.nullif(F.col("source_size"), F.lit(0).cast("long"))),
                        F.lit(0)).cast("long")
    given = (sources.join(blocks, "source_no", "left").na.fill({"blocks": 0})
             .withColumn("want", want).withColumn("passes", passes)
             .withColumn("more", F.round((F.col("want") - F.col("passes") * F.col("source_size"))
                                         / F.lit(block)).cast("long") * block))
    g = given.select(F.col("source").alias("g_source"), "source_size", "target", "passes", "more")
    rows = placed.join(g, placed["source"].eqNullSafe(g["g_source"]))
    room = F.when(F.col("passes") < max_repeats, F.col("more") - F.col("before")).otherwise(F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), room)).cast("long")
    return rows.withColumn("part", part).select(
        "doc_id", "source", "size", "source_size", "target", "passes", "part",
        (F.col("passes") * F.col("size") + F.col("part")).alias("taken"), F.col("tie").alias("row_key"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to its n-th word, white space between them kept."""
    blank = r"[\x20\x09-\x0D]"
    pieces = F.split(F.regexp_replace(text, f"^{blank}+", ""), f"(?<={blank})(?=[^\\x20\\x09-\\x0D])")
    return F.regexp_replace(F.array_join(F.slice(pieces, F.lit(1), n.cast("int")), ""), f"{blank}+$", "")


def mixed(docs: DataFrame, text: str = "text", seed: int = 1, block: int = 16, shards: int = 8) -> DataFrame:
    """The rows of the mix: every document as often as it is taken, the last time
    perhaps its first words alone; columns as in ``docs``, with n_chars, where
    there is one, counted again.  Rows equal in id and text are told apart by
    their number, so each takes its own share."""
    own = Window.partitionBy("row_key").orderBy("taken")
    takes = plan(docs, seed, block, shards, text=text).select(
        "row_key", "passes", "part", "size", "taken").filter("taken > 0")
    takes = takes.withColumn("copy", F.row_number().over(own)).drop("taken")
    takes = takes.toDF(*[f"__{c}" for c in takes.columns])
    rows = docs.withColumn("__key", row_key(text))
    rows = rows.withColumn("__copy_of", F.row_number().over(Window.partitionBy("__key").orderBy(F.lit(1))))
    rows = rows.join(takes, (rows["__key"] == takes["__row_key"]) & (rows["__copy_of"] == takes["__copy"]))
    body = F.col(text)
    last = F.when(F.col("__part") == F.col("__size"), body).otherwise(first_words(body, F.col("__part")))
    none = F.array().cast("array<string>")
    copies = F.concat(F.array_repeat(body, F.col("__passes").cast("int")),
                      F.when(F.col("__part") > 0, F.array(last)).otherwise(none))
    rows = rows.withColumn("__text", F.explode(copies))
    out = {text: F.col("__text")} | ({"n_chars": F.length("__text").cast("long")} if "n_chars" in docs.columns else {})
    return rows.select(*[out[c].alias(c) if c in out else F.col(c) for c in docs.columns])
