"""Token-id files: the ids of a corpus, entropy coded, in the order of its keys.

``write`` leaves a folder of three Parquet tables, written by Spark so that any
store will do:

* ``blocks/file=<k>``: encoded blocks of whole documents, about ``BLOCK`` ids each
  (a longer document is a block by itself): number, ids before it in the file, the
  documents' keys and lengths, and the payload of ``rans.Block``;
* ``table``: the shared frequency table, one row an id that occurs;
* ``files``: documents and ids of every file, and the ids before it.

Keys are ranged over the files and sorted within them.  Ties of the key are dealt
by text and then by place, so a key that holds a third of all rows spreads over
files; rows of one key stand in the order of their texts' hashes.  The texts are
encoded once, their ids are stored as raw blocks, counted, and then coded.  Every
stage is a written table, so a lost executor costs its tasks alone.

Defined results: null or empty texts hold the end id alone; null keys come first;
rows of equal key and text are interchangeable; other columns are ignored; an
empty table gives files without blocks.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import rans
from .tables import bounded_batches, stored, tidied
from .words import chunks, hash_ranges, text_bytes

BLOCK = 65_536  # ids
END = 2
RUN, LISTED = 4_096, 64  # bytes of parts encoded as one text; texts handed to the library at once
KNOWN, SHORT = 1 << 20, 48  # parts of texts that a worker remembers, and their bytes
CHUNK = 1 << 20  # bytes of texts whose parts are looked up together
_MAY_BE_SPACE = np.array([0xC2, 0xE1, 0xE2, 0xE3], dtype=np.uint8)  # lead bytes of other white space


@lru_cache(maxsize=2)
def tokenizer(spec: str):
    """The tokenizers library's encoder of a vocabulary, made once in each worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
    from tokenizers import Tokenizer
    made = Tokenizer.from_str(spec)
    made.no_truncation()
    made.no_padding()
    return made


def cuts(buffer: bytes) -> np.ndarray:
    """Places of the spaces before which a text may be cut: lone ones between two
    characters that are no white space.  The byte-level pre-tokenizer cuts there
    whatever stands around, so the parts encode by themselves."""
    buf = np.frombuffer(buffer, dtype=np.uint8)
    at = np.flatnonzero(buf == 32)
    at = at[(at > 0) & (at < len(buf) - 1)]
    lead = np.maximum.accumulate(np.where((buf & 0xC0) != 0x80, np.arange(len(buf)), 0))
    before, after = buf[lead[at - 1]], buf[at + 1]
    return at[(before > 32) & (after > 32) & ~np.isin(before, _MAY_BE_SPACE) & ~np.isin(after, _MAY_BE_SPACE)]


def pieces(text: str, size: int) -> list[str]:
    """The text cut, at ``cuts`` alone, into parts of at least ``size`` bytes (the last
    may be shorter): their ids, joined, are those of the text."""
    raw, out, low = text.encode("utf-8", "replace"), [], 0
    for at in cuts(raw).tolist() if raw else []:
        if at - low >= size:
            out.append(raw[low:at].decode("utf-8"))
            low = at
    return [*out, raw[low:].decode("utf-8")]


def joinable(parts: list[bytes]) -> np.ndarray:
    """Whether a part begins and ends as ``cuts`` asks, so that one after another they are cut apart."""
    raw = b"".join(parts) + b"\0\0"
    size = np.array([len(p) for p in parts], dtype=np.int64)
    buf, end = np.frombuffer(raw, dtype=np.uint8), np.cumsum(size)
    lead = np.maximum.accumulate(np.where((buf & 0xC0) != 0x80, np.arange(len(buf)), 0))
    first, after, last = buf[end - size], buf[end - size + 1], buf[lead[end - 1]]
    return ((size > 1) & (first == 32) & (after > 32) & (last > 32)
            & ~np.isin(after, _MAY_BE_SPACE) & ~np.isin(last, _MAY_BE_SPACE))


def token_bytes(library) -> np.ndarray:
    """Bytes of text that each id of a byte-level vocabulary stands for (one a character of its name)."""
    size = {i: len(token) for token, i in library.get_vocab(with_added_tokens=False).items()}
    size.update((i, len(t.content.encode("utf-8"))) for i, t in library.get_added_tokens_decoder().items())
    out = np.zeros(max(size, default=0) + 1, dtype=np.int64)
    out[list(size)] = list(size.values())
    return out


def taken(flat: np.ndarray, low: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The ranges ``flat[low:low + count]``, one after another."""
    ends = np.cumsum(count)
    return flat[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(low - (ends - count), count)]


class Encoder:
    """Ids of texts: the distinct parts between cuts are looked up by their hashes, new ones are
    encoded by the tokenizers library, in runs of many parts.  The first ``KNOWN`` short parts
    are remembered."""

    def __init__(self, spec: str):
        self.library = tokenizer(spec)
        self.bytes_of = token_bytes(self.library)
        # Of each known part, by hash: hash, length, last bytes, and where its ids stand in ``flat``:
        # no more than one a byte, so ``SHORT`` bounds them.
        self.known = [np.empty(0, kind) for kind in (np.uint64, np.uint8, np.uint64, np.int32, np.uint8)]
        self.flat = np.empty(0, "<u4")

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of texts, or of runs of parts, as the library gives them."""
        out = []
        for lo in range(0, len(texts), LISTED):
            some = [t.decode("utf-8", "replace") for t in texts[lo:lo + LISTED]]
            out += [np.array(e.ids, dtype="<u4") for e in self.library.encode_batch_fast(some, add_special_tokens=False)]
        return out

    def parts(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct parts, one after another, with the place and number of each part's.

        Parts that begin and end as at a cut stand together in runs of about ``RUN`` bytes, in
        which each is cut from the next; the bytes of the ids tell which are whose.  Others
        are encoded alone, as are all where the bytes do not meet the ends of the parts."""
        lone = ~joinable(parts)
        order = np.argsort(lone, kind="stable")
        listed = [parts[i] for i in order.tolist()]
        raw, end = b"".join(listed), np.cumsum([len(p) for p in listed])
        run = np.where(lone[order], len(raw) + np.arange(len(listed)), end // RUN)
        upto = end[np.append(np.flatnonzero(np.diff(run)), len(run) - 1)].tolist() if parts else []
        made = self.ids([raw[a:b] for a, b in zip([0, *upto], upto)])
        flat = np.concatenate([np.empty(0, "<u4"), *made])
        told = np.append(0, np.cumsum(self.bytes_of[flat]))
        high = np.searchsorted(told, end, "right") - 1
        if (told[high] != end).any() or told[-1] != len(raw):
            made = self.ids(listed)
            flat, high = np.concatenate([np.empty(0, "<u4"), *made]), np.cumsum([len(x) for x in made])
        low, count = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        low[order], count[order] = np.append(0, high)[:-1], np.diff(high, prepend=0)
        return flat, low, count

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text."""
        raw = b"\n".join(texts) + b"\n"
        at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        start = np.sort(np.concatenate([at[:-1], cuts(raw)]))
        text = np.searchsorted(at, start, "right") - 1
        end = np.minimum(np.append(start[1:], len(raw)), at[text + 1] - 1)
        names = hash_ranges(raw, start, end)
        name, first, same = np.unique(names, return_index=True, return_inverse=True)
        one = first[same]
        # Parts of one name are one part: length and last bytes must agree.
        eights = np.ndarray((len(raw) + 1,), dtype="<u8", buffer=bytes(8) + raw + bytes(8), strides=(1,))
        size = end - start
        last = eights[end] >> (8 * (8 - np.clip(size, 1, 8))).astype(np.uint64)  # the part's own bytes alone
        last[size == 0] = 0
        if (size != size[one]).any() or (last != last[one]).any():
            ids, low, count = self.parts([raw[a:b] for a, b in zip(start.tolist(), end.tolist())])
        else:
            ids, low, count = self.looked_up(raw, name, start[first], size[first], last[first])
            low, count = low[same], count[same]
        ids = taken(ids, low, count)
        per_text = np.bincount(text, weights=count, minlength=len(texts)).astype(np.int64)
        return np.split(ids, np.cumsum(per_text)[:-1])


    def looked_up(self, raw, name, start, size, last) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct parts as ``parts`` gives them; the new ones are remembered."""
        names, sizes, lasts, lows, counts = self.known
        at = np.searchsorted(names, name)
        met = np.flatnonzero(at < len(names))
        met = met[names[at[met]] == name[met]]
        held = met[(sizes[at[met]] == size[met]) & (lasts[at[met]] == last[met])]
        new = np.ones(len(name), bool)
        new[held] = False
        new = np.flatnonzero(new)
        flat, some, many = self.parts([raw[a:a + n] for a, n in zip(start[new].tolist(), size[new].tolist())])
        low, count = np.empty(len(name), np.int64), np.empty(len(name), np.int64)
        low[held], count[held] = lows[at[held]], counts[at[held]]
        low[new], count[new] = len(self.flat) + some, many
        out = np.concatenate([self.flat, flat]), low, count
        add = new[(size[new] <= SHORT) & ~np.isin(new, met)][:KNOWN - len(names)]
        if len(add):
            more = taken(out[0], low[add], count[add])
            place = len(self.flat) + np.cumsum(count[add]) - count[add]
            self.known = [np.insert(x, at[add], y) for x, y in
                          zip(self.known, (name[add], size[add], last[add], place, count[add]))]
            self.flat = np.concatenate([self.flat, more])
        return out


@lru_cache(maxsize=2)
def encoder(spec: str) -> Encoder:
    """One in each worker: its tasks share what it remembers."""
    return Encoder(spec)


def raw_blocks(docs: DataFrame, vocabulary: str, key: str, text: str, end: int, block: int) -> DataFrame:
    """file, block, start (ids before it in the file), keys, sizes and raw ids of
    blocks of whole documents, in ascending order of the key."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()  # shipped with the task: executors need no such file
    slim = bounded_batches(docs).select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).select(
        "k", "t", F.xxhash64("t").alias("h"), F.monotonically_increasing_id().alias("m"))
    ranged = slim.repartitionByRange("k", "h", "m").sortWithinPartitions("k", "h", "m").select(
        "k", "t", F.spark_partition_id().alias("file"))
    kind = slim.schema["k"].dataType.simpleString()
    tail = np.array([end], dtype="<u4")

    def run(batches):
        keys, ids, held, number, start, file = [], [], 0, 0, 0, 0
        known = encoder(spec)

        def closed():
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([number], pa.int64()), pa.array([start], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.concat_arrays(keys)),
                 pa.array([[len(x) for x in ids]], pa.list_(pa.int32())),
                 pa.array([np.concatenate(ids).tobytes()], pa.binary())],
                ["file", "block", "start", "keys", "sizes", "ids"])

        for batch in batches:
            texts = text_bytes(batch.column(1))
            for lo, hi in chunks(texts, CHUNK):
                for at, made in enumerate(known.encode(texts[lo:hi]), lo):
                    file = batch.column(2)[0].as_py()
                    keys.append(batch.column(0).slice(at, 1))
                    ids.append(np.concatenate([made, tail]))
                    held += len(ids[-1])
                    if held >= block:
                        yield closed()
                        keys, ids, number, start, held = [], [], number + 1, start + held, 0
        if ids:
            yield closed()

    schema = f"file int, block long, start long, keys array<{kind}>, sizes array<int>, ids binary"
    return ranged.mapInArrow(tidied(run), schema)


def id_counts(raw: DataFrame) -> DataFrame:
    """(id, n) of all ids of raw blocks."""
    def run(batches):
        total = np.zeros(1, dtype=np.int64)
        for batch in batches:
            for ids in batch.column(0).to_pylist():
                n = np.bincount(np.frombuffer(ids, dtype="<u4"))
                if len(n) > len(total):
                    n, total = total, n
                total[:len(n)] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    return raw.select("ids").mapInArrow(tidied(run), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


BLOCK_FIELDS = ("block long, start long, keys array<{kind}>, sizes array<int>, tokens int, words binary, "
                "states binary, offsets array<int>, crc long, ids_crc long, file int")


def coded(raw: DataFrame, table: tuple[np.ndarray, np.ndarray, int]) -> DataFrame:
    """Raw blocks with their ids replaced by the payload of ``rans.Block``."""
    kept = ["block", "start", "keys", "sizes"]
    schema = BLOCK_FIELDS.format(kind=raw.schema["keys"].dataType.elementType.simpleString())

    def run(batches):
        coder = rans.Coder(*table)
        for batch in batches:
            ids = [np.frombuffer(x, dtype="<u4") for x in batch.column("ids").to_pylist()]
            for lo, hi in alike([len(x) for x in ids]):
                made = coder.encode(ids[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(lo, hi - lo) for c in kept]
                    + [pa.array([b.tokens for b in made], pa.int32()), pa.array([b.words for b in made], pa.binary()),
                       pa.array([b.states for b in made], pa.binary()),
                       pa.array([b.offsets for b in made], pa.list_(pa.int32())),
                       pa.array([b.crc for b in made], pa.int64()), pa.array([b.ids_crc for b in made], pa.int64()),
                       batch.column("file").slice(lo, hi - lo)],
                    [*kept, "tokens", "words", "states", "offsets", "crc", "ids_crc", "file"])

    return raw.mapInArrow(tidied(run), schema)


def alike(sizes: list[int]) -> list[tuple[int, int]]:
    """Ranges of consecutive blocks that share one array: none above four times the least."""
    out, lo = [], 0
    for k in range(1, len(sizes) + 1):
        if k == len(sizes) or max(sizes[lo:k + 1]) > 4 * min(sizes[lo:k + 1]):
            out.append((lo, k))
            lo = k
    return out


def write(docs: DataFrame, folder: str, vocabulary: str, key: str = "doc_id", text: str = "text",
          end: int = END, block: int = BLOCK) -> None:
    """Token-id files of every row's whole text, each followed by ``end``."""
    raw = stored(raw_blocks(docs, vocabulary, key, text, end, block), "token-blocks")
    # One number an id of the vocabulary.
    rows = sorted(id_counts(raw).collect())
    ids, n = np.array([r[0] for r in rows], dtype=np.uint32), np.array([r[1] for r in rows], dtype=np.int64)
    share, bits = rans.frequencies(n) if len(ids) else (n, 12)
    spark = docs.sparkSession
    (spark.createDataFrame([(int(i), int(f), bits) for i, f in zip(ids, share)], "id long, share long, bits int")
     .coalesce(1).write.parquet(f"{folder}/table"))
    coded(raw, (ids, share, bits)).write.partitionBy("file").option("compression", "none").parquet(f"{folder}/blocks")
    # One row a file.
    sizes = raw.groupBy("file").agg(F.sum(F.size("sizes")).alias("docs"),
                                    F.sum(F.expr("aggregate(sizes, 0L, (a, x) -> a + x)")).alias("tokens"))
    before, out = 0, []
    for r in sorted(sizes.collect()):
        out.append((r["file"], r["docs"], r["tokens"], before))
        before += r["tokens"]
    (spark.createDataFrame(out, "file int, docs long, tokens long, before long").coalesce(1)
     .write.parquet(f"{folder}/files"))


def read(spark: SparkSession, folder: str, key: str = "doc_id", kind: str = "long") -> DataFrame:
    """key, start (ids of all documents before it), n_tokens and ids (little-endian
    uint32 values) of every document of the files; damaged blocks raise ``rans.Damaged``."""
    table = sorted(spark.read.parquet(f"{folder}/table").collect())  # one row an id of the vocabulary
    ids, share = np.array([r["id"] for r in table], np.uint32), np.array([r["share"] for r in table], np.int64)
    bits = table[0]["bits"] if table else 12
    blocks = spark.read.schema(BLOCK_FIELDS.format(kind=kind)).parquet(f"{folder}/blocks")

    def run(batches):
        coder = rans.Coder(ids, share, bits)
        for batch in batches:
            c = {name: batch.column(name).to_pylist() for name in
                 ("tokens", "words", "states", "offsets", "crc", "ids_crc", "sizes", "start", "file")}
            made = [rans.Block(*row) for row in zip(c["tokens"], c["words"], c["states"], c["offsets"], c["crc"],
                                                    c["ids_crc"])]
            for lo, hi in alike(c["tokens"]):
                for k, whole in enumerate(coder.decode(made[lo:hi]), lo):
                    sizes = np.array(c["sizes"][k], dtype=np.int64)
                    at = np.cumsum(sizes) - sizes
                    raw = pa.Array.from_buffers(pa.binary(), len(sizes), [
                        None, pa.py_buffer(np.append(4 * at, 4 * sizes.sum()).astype(np.int32).tobytes()),
                        pa.py_buffer(whole.astype("<u4").tobytes())])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("keys").slice(k, 1).flatten(), pa.array(np.full(len(sizes), c["file"][k], np.int32)),
                         pa.array(c["start"][k] + at), pa.array(sizes), raw], ["k", "file", "at", "n_tokens", "ids"])

    rows = bounded_batches(blocks).mapInArrow(tidied(run), f"k {kind}, file int, at long, n_tokens long, ids binary")
    files = spark.read.schema("file int, docs long, tokens long, before long").parquet(f"{folder}/files")
    return rows.join(F.broadcast(files.select("file", "before")), "file").select(
        F.col("k").alias(key), (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids")


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from its files."""
    folder = scratch_path(docs.sparkSession, "token-files")
    write(docs, folder, vocabulary)
    back = read(docs.sparkSession, folder, kind=docs.schema["doc_id"].dataType.simpleString())
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
