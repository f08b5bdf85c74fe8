"""N-gram Jaccard join with a token-group matrix.

Two documents link when the Jaccard similarity of their sets of word n-grams is
at least ``percent`` / 100.  A set is held as 64-bit hashes.

1. Equal sets are one node, whatever their number of documents.
2. Nodes are partitioned into groups of similar documents: a one-permutation
   sketch puts nodes into buckets, the node that stands in the largest buckets
   leads, and a leader's followers are cut into groups of at most ``GROUP``.
3. The token-group matrix holds the tokens of each group's union.  A node meets
   a group only through rare tokens: of a set of n tokens, of which a partner
   must share ``need`` = ceil(percent * n / 100), any n - need + SHARED tokens
   hold SHARED tokens of every partner (``need``, where that is less).  These
   are taken in one global order, tokens that many documents repeat last, so
   common passages seldom make candidates.
4. For each candidate query and group, the query's overlap with the group's
   union bounds its overlap with every member; only groups whose bound reaches
   ``need`` are opened, and their members are compared exactly.
5. Every two groups meet once, and every link between two sets is stored.  A task
   compares at most about ``QUERIES`` sets with ``GROUP`` others, so pairs of a large
   group of near copies, the square of its size as its links are, are dealt evenly.
6. Components come from the ``tree`` links: those that joined what the links of
   their task had not joined before, so all links connect no more than these do.

The order of tokens changes cost alone, never results.  It comes from repeats
counted in all documents; the ``ORDER_TOKENS`` most repeated ones are sent to the
tasks (8 MB at most), the others are ordered by hash.  Sets are computed from
the text again where needed instead of being shuffled for all documents.

Defined results: a document with fewer than n words has its whole sequence as
its one n-gram; null text, or text without words, has an empty set and links
with nothing.  Rows with a null id count like others but are never a
component's name; a component without any id has a null one.  Repeated rows get
a row each.  Other columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmap import Bitmap
from .components import components
from .tables import bounded_batches, stored, tidied, tidy
from .words import Words, chunks, combine, text_bytes

GROUP = 128  # nodes in a group at most, about
QUERIES = 256  # queries compared with a group in one task, about
BINS = 16  # sketch: least token of each sixteenth of the hash range
SHARED = 3  # rare tokens a candidate shares at least
ORDER_TOKENS = 1 << 20
TIDY = 32  # groups after which a task gives free memory back
WINDOW = 4_000_000  # tokens among which repeats are counted at once


def shingle_sets(texts: list[bytes], n: int):
    """Sorted distinct n-gram hashes of each text (uint64)."""
    for lo, hi in chunks(texts):
        w = Words(texts[lo:hi], lower=True)
        h = w.hashes()
        grams = combine(h, n)
        for d in range(hi - lo):
            a, b = w.first[d], w.first[d + 1]
            if b - a >= n:
                yield np.unique(grams[a:b - n + 1])
            elif b > a:
                yield combine(h[a:b], int(b - a)) ^ np.uint64(b - a)
            else:
                yield np.zeros(0, dtype=np.uint64)


def node_of(tokens: np.ndarray) -> int:
    """64-bit name of a set."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def need(n, percent: int):
    """Least overlap of a set of n tokens with any partner."""
    return -(-percent * n // 100)


def may_link(n, percent: int):
    """Whether a set of n tokens can link with another: its nearest partner
    holds it and one token more."""
    return 100 * n >= percent * (n + 1)


def rare_shared(n: int, percent: int) -> int:
    """Rare tokens that a set of n tokens shares at least with any partner."""
    return min(SHARED, need(n, percent))


def _texts(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col(text).cast("string").alias("t"))


def _distinct_sets(batches, column: int, n: int):
    """(node, set) of the non-empty sets of a task, each once."""
    seen = set()
    for batch in batches:
        for tokens in shingle_sets(text_bytes(batch.column(column)), n):
            if len(tokens):
                node = node_of(tokens)
                if node not in seen:
                    seen.add(node)
                    yield node, tokens


def row_key(text: str):
    """64-bit name of a row's id and text."""
    return F.xxhash64(F.col("doc_id").cast("string"), F.col(text).cast("string"))


def profiles(docs: DataFrame, text: str, n: int) -> DataFrame:
    """doc_id, row_key, n_shingles, node and sketch of every document."""
    slim = docs.select("doc_id", F.col(text).cast("string").alias("t"), row_key(text).alias("row_key"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    starts = np.arange(BINS, dtype=np.uint64) << np.uint64(60)

    def run(batches):
        for batch in batches:
            sizes, nodes, sketches = [], [], []
            for tokens in shingle_sets(text_bytes(batch.column(1)), n):
                sizes.append(len(tokens))
                if len(tokens):
                    nodes.append(node_of(tokens))
                    first = np.searchsorted(tokens, starts) % len(tokens)
                    sketches.append(tokens[first].view(np.int64).tolist())
                else:
                    nodes.append(None)
                    sketches.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.array(sketches, pa.list_(pa.int64()))],
                ["doc_id", "row_key", "n_shingles", "node", "sketch"])

    return slim.mapInArrow(tidied(run), f"doc_id {kind}, row_key long, n_shingles long, node long, sketch array<long>")


def repeats(docs: DataFrame, text: str, n: int) -> DataFrame:
    """(token, count): tokens that stand in several sets of one task's window."""

    def run(batches):
        held, size = [], 0

        def counted():
            tokens, count = np.unique(np.concatenate(held), return_counts=True)
            many = count > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(tokens[many].view(np.int64)), pa.array(count[many].astype(np.int64))],
                ["token", "count"])

        for _, tokens in _distinct_sets(batches, 0, n):
            held.append(tokens)
            size += len(tokens)
            if size >= WINDOW:
                yield counted()
                held, size = [], 0
        if held:
            yield counted()

    rows = _texts(docs, text).mapInArrow(tidied(run), "token long, count long")
    return rows.groupBy("token").agg(F.sum("count").alias("count"))


def token_order(docs: DataFrame, text: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted tokens, level): the most repeated tokens, level = log2 of repeats."""
    counted = stored(repeats(docs, text, n), "join-order").withColumn(
        "level", F.floor(F.log2("count")).cast("int"))
    sizes = {r["level"]: r["n"] for r in counted.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()}
    least, total = 64, 0
    for level in sorted(sizes, reverse=True):
        if total + sizes[level] > ORDER_TOKENS:
            break
        least, total = level, total + sizes[level]
    table = counted.filter(F.col("level") >= least).select("token", "level").toArrow()
    tokens = table["token"].to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], table["level"].to_numpy()[order].astype(np.int8)


def rare_tokens(docs: DataFrame, text: str, n: int, percent: int,
                order: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(token, node): the tokens by which a node is found."""
    known, levels = order

    def run(batches):
        nodes, found = [], []
        size = 0
        for node, tokens in _distinct_sets(batches, 0, n):
            m = len(tokens)
            if not may_link(m, percent):
                continue  # only an equal set can be its partner
            take = m - need(m, percent) + SHARED
            level = np.zeros(m, dtype=np.int8)
            if len(known):
                at = np.searchsorted(known, tokens)
                at[at == len(known)] = 0
                level = np.where(known[at] == tokens, levels[at], 0)
            first = tokens if take >= m else tokens[np.argsort(level, kind="stable")[:take]]
            nodes.append(np.full(len(first), node, dtype=np.int64))
            found.append(first)
            size += len(first)
            if size >= 200_000:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(nodes))],
                    ["token", "node"])
                nodes, found, size = [], [], 0
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(nodes))],
                ["token", "node"])

    return _texts(docs, text).mapInArrow(tidied(run), "token long, node long")


def wanted_sets(docs: DataFrame, text: str, n: int, nodes: DataFrame) -> DataFrame:
    """(node, tokens): the sets of ``nodes``, as little-endian 64-bit values.

    A bounded bitmap keeps most others from leaving their task; the join then
    keeps the wanted ones alone.
    """
    wanted = Bitmap(nodes, "node")

    def run(batches):
        names, sets, size = [], [], 0
        for node, tokens in _distinct_sets(batches, 0, n):
            if wanted.may_hold(np.array([node]))[0]:
                names.append(node)
                sets.append(tokens.tobytes())
                size += len(tokens)
                if size >= 500_000:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sets, pa.binary())],
                                                     ["node", "tokens"])
                    names, sets, size = [], [], 0
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sets, pa.binary())],
                                             ["node", "tokens"])

    found = _texts(docs, text).mapInArrow(tidied(run), "node long, tokens binary")
    return found.join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"])


def leaders(nodes: DataFrame) -> DataFrame:
    """(node, leader): the leading node of the buckets that a node shares most."""
    bands = nodes.select("node", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(BINS - 2), F.lit(2)),
        lambda i: F.xxhash64(i, F.element_at("sketch", i + 1), F.element_at("sketch", i + 2)))
    ).alias("band", "bucket")).drop("band")
    sizes = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("here")).filter("here > 1")
    shared = stored(bands.join(sizes, "bucket"), "join-buckets")
    scores = shared.groupBy("node").agg(F.sum("here").alias("score"))
    heads = (shared.join(scores, "node").groupBy("bucket")
             .agg(F.max(F.struct("score", "node")).alias("head")).select("bucket", F.col("head.node").alias("leader")))
    best = (shared.select("bucket", "node").join(heads, "bucket")
            .groupBy("node", "leader").agg(F.count(F.lit(1)).alias("times"))
            .groupBy("node").agg(F.max(F.struct("times", "leader")).alias("best")))
    return nodes.select("node", "n_shingles", "min_id").join(
        best.select("node", F.col("best.leader").alias("leader")), "node", "left").withColumn(
        "leader", F.coalesce("leader", "node"))


def grouped(led: DataFrame) -> DataFrame:
    """Add gid: the group of a node, a part of its leader's followers."""
    # Sums by group are stored, so that joins on them are of plain exchanges,
    # which Spark may split where one group is large.
    followers = stored(led.groupBy("leader").agg(F.count(F.lit(1)).alias("followers")), "join-followers")
    cut = F.pmod(F.xxhash64("node"), F.ceil(F.col("followers") / GROUP).cast("long"))
    return led.join(followers, "leader").withColumn("gid", F.xxhash64("leader", cut)).drop("followers")


LINK = "a long, b long, tree boolean"


def compare(percent: int):
    """Compare queries with a group's members: the cogroup function.  All their links,
    each once: of two nodes of the group the lesser asks."""
    groups = [0]  # of this task, so far

    def run(queries: pa.Table, members: pa.Table) -> pa.Table:
        groups[0] += 1
        if groups[0] % TIDY == 0:
            tidy()
        links_a: list[np.ndarray] = []
        links_b: list[np.ndarray] = []
        trees: list[np.ndarray] = []
        if queries.num_rows and members.num_rows:
            sets = [np.frombuffer(v, dtype=np.uint64) for v in members["tokens"].to_pylist()]
            name = members["node"].to_numpy()
            joined = np.arange(len(sets))  # by member: what the links so far connect
            size = np.array([len(s) for s in sets])
            union, at = np.unique(np.concatenate(sets), return_inverse=True)  # the group's row of the matrix
            owner = np.repeat(np.arange(len(sets)), size)[np.argsort(at, kind="stable")]
            length = np.bincount(at, minlength=len(union))
            start = np.cumsum(length) - length
            for q, raw, inside in zip(queries["node"].to_pylist(), queries["tokens"].to_pylist(),
                                      queries["inside"].to_pylist()):
                tokens = np.frombuffer(raw, dtype=np.uint64)
                hit = np.searchsorted(union, tokens)
                hit[hit == len(union)] = 0
                hit = hit[union[hit] == tokens]
                if len(hit) < need(len(tokens), percent):
                    continue  # the union shares too little, so does every member
                many = length[hit]
                ends = np.cumsum(many)
                flat = np.arange(ends[-1]) + np.repeat(start[hit] - ends + many, many)
                overlap = np.bincount(owner[flat], minlength=len(sets))
                similar = 100 * overlap >= percent * (len(tokens) + size - overlap)
                found = np.flatnonzero(similar & (name > q)) if inside else np.flatnonzero(similar)
                if not len(found):
                    continue
                parts, first = np.unique(joined[found], return_index=True)
                tree = np.zeros(len(found), dtype=bool)
                tree[first] = True
                if inside:  # the query is a member too, which earlier links may connect
                    own = joined[name == q][0]
                    tree[first[parts == own]] = False
                    parts = np.append(parts, own)
                joined[np.isin(joined, parts)] = parts[0]
                links_a.append(np.full(len(found), q, dtype=np.int64))
                links_b.append(name[found])
                trees.append(tree)
        if not links_a:
            links_a, links_b, trees = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
        return pa.table({"a": pa.array(np.concatenate(links_a)), "b": pa.array(np.concatenate(links_b)),
                         "tree": pa.array(np.concatenate(trees))})

    return run


def opened(pairs: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between queries and the members of their candidate groups.

    pairs: node, gid, inside (whether gid is the node's own group); members: gid, node.
    """
    many = stored(pairs.groupBy("gid").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("lots")),
                  "join-lots")
    left = (pairs.join(many, "gid").withColumn("lot", F.pmod(F.xxhash64("node"), F.col("lots")).cast("int"))
            .drop("lots").join(sets, "node"))
    right = (members.join(many, "gid").withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)))
             .drop("lots").join(sets, "node"))
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)  # both hold columns of sets
    return left.groupBy("gid", "lot").cogroup(right.groupBy("gid", "lot")).applyInArrow(
        compare(percent), LINK)


def link_nodes(docs: DataFrame, nodes: DataFrame, text: str, n: int, percent: int) -> DataFrame:
    """Every link (a, b) of two nodes, once, and whether it is one of the ``tree``."""
    order = token_order(docs, text, n)
    led = stored(grouped(leaders(nodes.filter(may_link(F.col("n_shingles"), percent)))), "join-groups")
    rare = rare_tokens(docs, text, n, percent, order).repartition("token")
    several = (rare.groupBy("token").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
               .filter("lo <> hi").select("token"))
    found = stored(rare.join(several, "token").distinct(), "join-tokens")
    named = found.join(led.select("node", "gid"), "node")
    matrix = named.groupBy("token", "gid").agg(F.count(F.lit(1)).alias("holders"))
    groups = stored(led.groupBy("gid").agg(F.min("n_shingles").alias("least"),
                                           F.max("n_shingles").alias("most")), "join-sizes")
    smallest = max(1, -(-percent // max(1, 100 - percent)))  # the least size that may link
    fewest = rare_shared(smallest, percent)
    met = (named.withColumnRenamed("gid", "own").join(matrix, "token")
           .filter((F.col("own") != F.col("gid")) | (F.col("holders") > 1))
           .groupBy("node", "gid").agg(F.count(F.lit(1)).alias("shared")).filter(F.col("shared") >= fewest))
    size = F.col("n_shingles")
    required = F.least(F.lit(SHARED), F.ceil(size * percent / 100))
    # A partner's group meets the node's own as well: of two groups the lesser asks.
    pairs = stored(met.join(led.select("node", "n_shingles", F.col("gid").alias("own")), "node").join(groups, "gid")
                   .filter(F.col("shared") >= required)
                   .filter((100 * F.col("most") >= percent * size) & (percent * F.col("least") <= 100 * size))
                   .filter(F.col("own") <= F.col("gid"))
                   .select("node", "gid", (F.col("own") == F.col("gid")).alias("inside")), "join-pairs")
    members = led.join(pairs.select("gid").distinct(), "gid", "left_semi").select("gid", "node")
    involved = stored(pairs.select("node").union(members.select("node")).distinct(), "join-involved")
    sets = stored(wanted_sets(docs, text, n, involved), "join-sets")
    return opened(pairs, members, sets, percent)


def joined(docs: DataFrame, text: str, n: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with node and n_shingles; nodes with their component's label; every
    link (a, b) of two nodes, once)."""
    rows = stored(profiles(bounded_batches(docs), text, n), "join-profiles")
    nodes = stored(rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("min_id"), F.first("n_shingles").alias("n_shingles"),
        F.first("sketch").alias("sketch")), "join-nodes")
    links = stored(link_nodes(docs, nodes, text, n, percent), "join-links")
    labels = components(links.filter("tree"))
    named = nodes.select("node", "min_id").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    return rows.drop("sketch"), stored(named, "join-labels"), links.select("a", "b")


def partners(rows: DataFrame, links: DataFrame) -> DataFrame:
    """(node, n_links): documents that each document of a node links with: those of
    linked nodes, and the others of its own."""
    copies = stored(rows.filter("node IS NOT NULL").groupBy("node").agg(F.count(F.lit(1)).alias("copies")),
                    "join-copies")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = (both.join(copies.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
              .agg(F.sum("copies").alias("others")))
    return copies.join(linked, "node", "left").select(
        "node", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))


def join_components(docs: DataFrame, text: str = "text", n: int = 4, percent: int = 85,
                    counted: bool = False) -> DataFrame:
    """doc_id, n_shingles and component_id (least doc_id reachable by links); ``counted``:
    n_links too, the number of documents that a document links with."""
    rows, named, links = joined(docs, text, n, percent)
    least = named.groupBy("label").agg(F.min("min_id").alias("component_id"))
    by_node = stored(named.join(least, "label").select("node", "component_id"), "join-named")
    full = rows.filter("node IS NOT NULL").select("doc_id", "n_shingles", "node").join(by_node, "node")
    bare = rows.filter("node IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    if counted:
        full = full.join(partners(rows, links), "node")
        bare = bare.withColumn("n_links", F.lit(0).cast("long"))
    return full.drop("node").unionByName(bare)


def deduplicated(docs: DataFrame, text: str = "text", n: int = 4, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` with one document of each component: the least id
    (an id before none, then the least text hash).  Documents without words all
    stay.  Rows equal in id and text count as one document."""
    rows, named, _ = joined(docs, text, n, percent)
    first = (rows.filter("node IS NOT NULL").join(named.select("node", "label"), "node").groupBy("label")
             .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("first"))
             .select(F.col("first.row_key").alias("row_key")))
    keyed = docs.withColumn("__row_key", row_key(text))
    some = F.coalesce(F.col(text).cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = (keyed.filter(some).join(first, keyed["__row_key"] == first["row_key"], "left_semi")
            .dropDuplicates(["__row_key"]).drop("__row_key"))
    return kept.unionByName(docs.filter(~some))
