"""Token ids in files: frequency-ranked, byte-aligned, with separate control bytes.

Ids are replaced by their rank of frequency in the whole corpus, so that common
ids take one byte and all others two to four.  The lengths are kept apart from
the data: two bits an id, four ids a control byte.  A reader finds the place of
every id by a table lookup of control bytes and a running sum, and gathers all
ids of a block with numpy; there is no loop over ids.

A *file* is one partition of documents in ascending order of their id, and
holds *blocks* of about ``BLOCK`` ids.  A block is

    "RVB1", then five little-endian 32-bit numbers (documents, ids, bytes of
    control, bytes of data, crc32 of the rest), the ids of each document as
    32-bit numbers, control bytes, data bytes

Blocks are rows of a Parquet table that Spark's committer writes (``file``,
``block``, ``docs``, ``bytes``): whole files or none after a lost task, on every
store that Spark can write.  The rank table lies beside it.

Steps: encode every text once and stage the ids; count them (one row an id and
task); range-partition by id, sort, write blocks; read the files back.  Nothing
but the rank table, which is as large as the vocabulary, passes through the
driver.

Defined cases: a null text counts as empty and has the end id only; null ids
come first, equal ids in the order of a hash of their text; a very long text fills as
many ids of a block as it has; every input row
gives one result row; the columns read are picked by name, whatever further columns
there are; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowgate.llm.common import map_batches, map_rows, mixed, pieces, table, vocabulary, word_hashes
from rowgate.session import fresh_dir

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
#: Ids of one block, about.
BLOCK = 1 << 18
#: Slots of a worker's table of pre-tokens, as a power of two (about 130 MB).
TABLE_BITS = 22
_MAGIC = b"RVB1"
_HEAD = struct.Struct("<4s5I")
#: Blanks next to blanks, or at an end: pre-tokens aren't just cut at spaces.
_TANGLED = re.compile(r"\s\s|\s\Z|\A\s|[^\S \n]")
_SPACED = np.uint64(0x5BD1E9955BD1E995)

#: Bytes of the four ids of every control byte, and their sum.
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


class IdTable:
    """Ids of pre-tokens by their 64-bit fingerprints: open addressing in numpy
    arrays, about 30 bytes a pre-token; emptied when it is full."""

    def __init__(self, bits: int, kind: np.dtype) -> None:
        self.bits, self.kind = bits, kind
        self.mask = np.uint64((1 << bits) - 1)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.start = np.zeros(1 << self.bits, np.uint32)
        self.size = np.zeros(1 << self.bits, np.uint32)
        self.pool = np.empty(4 << self.bits, self.kind)
        self.held = self.used = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slots of the keys, -1 for those that aren't here."""
        out = np.full(len(keys), -1, np.int64)
        todo, at = np.arange(len(keys)), keys & self.mask
        while len(todo):
            there = self.keys[at]
            hit = there == keys[todo]
            out[todo[hit]] = at[hit].astype(np.int64)
            go_on = ~hit & (there != 0)
            todo, at = todo[go_on], (at[go_on] + np.uint64(1)) & self.mask
        return out

    def room_for(self, n: int, n_ids: int) -> bool:
        return self.held + n <= 0.6 * len(self.keys) and self.used + n_ids <= len(self.pool)

    def add(self, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Distinct keys that aren't here yet, and their ids one after another."""
        starts = self.used + np.cumsum(sizes) - sizes
        self.pool[self.used:self.used + len(ids)] = ids
        self.held, self.used = self.held + len(keys), self.used + len(ids)
        todo, at = np.arange(len(keys)), keys & self.mask
        while len(todo):
            free = self.keys[at] == 0
            slots, first = np.unique(at[free], return_index=True)
            now = todo[free][first]
            self.keys[slots], self.start[slots], self.size[slots] = keys[now], starts[now], sizes[now]
            left = np.ones(len(keys), bool)
            left[now] = False
            stay = left[todo]
            todo, at = todo[stay], at[stay]
            at = np.where(self.keys[at] != 0, (at + np.uint64(1)) & self.mask, at)


class Encoder:
    """Ids of texts by the tokenizer, with a bounded table of pre-tokens."""

    def __init__(self, model: bytes, bits: int = TABLE_BITS) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model.decode("utf-8"))
        self.type = np.dtype("<u2") if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.dtype("<u4")
        self.table = IdTable(bits, self.type)
        self.line_end = word_hashes([b"\n"])[0]

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after another, and how many each has."""
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), self.type, int(sizes.sum())), sizes

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as bytes of ``self.type``.

        A space between two other characters always begins a pre-token, and a
        line end between two others is one, so texts are cut there and each
        distinct cut is encoded once; texts with blanks in a row are encoded
        whole.
        """
        plain = [bool(t) and not _TANGLED.search(t) for t in texts]
        cut = [t.encode().replace(b"\n", b" \n ").split(b" ") for t, p in zip(texts, plain) if p]
        own = iter(self._cuts(cut))
        whole = [t for t, p in zip(texts, plain) if not p]
        ids, sizes = self._ids(whole)
        others = iter(np.split(ids, np.cumsum(sizes)[:-1])) if whole else iter(())
        return [(next(own) if p else next(others)).tobytes() for p in plain]

    def _cuts(self, cut: list[list[bytes]]) -> list[np.ndarray]:
        if not cut:
            return []
        words = list(chain.from_iterable(cut))
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        keys = word_hashes(words)
        # a word has its space in front, but at the start of a text or line
        end = keys == self.line_end
        bare = end | np.append(True, end[:-1])
        bare[np.cumsum(counts) - counts] = True
        keys = np.maximum(np.where(bare, keys, mixed(keys ^ _SPACED)), np.uint64(1))  # 0 marks a free slot
        slots = self.table.find(keys)
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            new, first = np.unique(keys[missing], return_index=True)
            asked = [words[i].decode() if bare[i] else " " + words[i].decode() for i in missing[first].tolist()]
            ids, sizes = self._ids(asked)
            if not self.table.room_for(len(new), len(ids)):
                self.table.clear()
                if self.table.room_for(len(new), len(ids)):  # a fresh table takes all of this batch
                    return self._cuts(cut)
                step = max(1, len(cut) // 2)
                if step < len(cut):
                    return self._cuts(cut[:step]) + self._cuts(cut[step:])
                all_ids, _ = self._ids([b" ".join(cut[0]).replace(b" \n ", b"\n").decode()])
                return [all_ids]
            self.table.add(new, ids, sizes)
            slots[missing] = self.table.find(keys[missing])
        sizes = self.table.size[slots].astype(np.int64)
        ends = np.cumsum(sizes)
        places = np.repeat(self.table.start[slots].astype(np.int64) - (ends - sizes), sizes) + np.arange(int(ends[-1]))
        return np.split(self.table.pool[places], ends[np.cumsum(counts)[:-1] - 1])


#: Encoders of this worker process, by model: their caches outlive a task.
_ENCODERS: dict[int, Encoder] = {}


def encoder_of(model: bytes) -> Encoder:
    key = zlib.crc32(model)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(model)
    return _ENCODERS[key]


def encode_block(docs: list[np.ndarray]) -> bytes:
    """A block of documents' ranks (unsigned 32-bit)."""
    ranks = np.concatenate([*docs, np.empty(0, np.uint32)]).astype("<u4")
    size = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    two_bits = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    two_bits[:len(ranks)] = size - 1
    control = (two_bits.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8).tobytes()
    all_bytes = ranks.view(np.uint8).reshape(-1, 4)
    data = all_bytes[np.arange(4, dtype=np.uint8) < size[:, None]].tobytes()
    body = np.array([len(d) for d in docs], "<u4").tobytes() + control + data
    return _HEAD.pack(_MAGIC, len(docs), len(ranks), len(control), len(data), zlib.crc32(body)) + body


def decode_block(block: bytes) -> list[np.ndarray]:
    """The ranks of each document of a block."""
    magic, n_docs, n_ids, n_control, n_data, crc = _HEAD.unpack_from(block)
    body = memoryview(block)[_HEAD.size:]
    if magic != _MAGIC or len(body) != 4 * n_docs + n_control + n_data or zlib.crc32(body) != crc:
        raise ValueError("not a whole block")
    sizes = np.frombuffer(body, "<u4", n_docs)
    control = np.frombuffer(body, np.uint8, n_control, 4 * n_docs)
    data = np.append(np.frombuffer(body, np.uint8, n_data, 4 * n_docs + n_control), np.zeros(3, np.uint8))
    size = _LENGTHS[control].reshape(-1)[:n_ids]
    at = np.cumsum(size, dtype=np.int64) - size
    ranks = data[at].astype(np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        if not len(more):
            break
        ranks[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return np.split(ranks, np.cumsum(sizes[:-1])) if n_docs else []


def token_ids(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> tuple[DataFrame, np.dtype]:
    """``doc_id, tie, ids`` (bytes of the type given back) for every row."""
    model = vocabulary(tokenizer)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = Encoder(model, 4).type
    last = np.array([end_id], kind).tobytes()

    def make():
        encoder = encoder_of(shared.value)

        def run(rows: dict[str, list]) -> dict[str, list]:
            return {"doc_id": rows["doc_id"], "tie": rows["tie"], "ids": [x + last for x in encoder.encode([t or "" for t in rows["text"]])]}

        return run

    return map_rows(docs.select("doc_id", F.xxhash64("text").alias("tie"), "text"), make, "doc_id long, tie long, ids binary"), kind


def id_ranks(ids: DataFrame, kind: np.dtype, size: int) -> np.ndarray:
    """Rank of every id by its count in all of ``ids``; ties to the smaller id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(size, np.int64)
        for batch in batches:
            for part in pieces(batch):
                n += np.bincount(np.frombuffer(b"".join(part.column(0).to_pylist()), kind), minlength=size)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(n[some], pa.int64())], ["id", "n"])

    rows = map_batches(ids.select("ids"), count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(size, np.int64)
    for r in rows:
        n[r["id"]] = r["n"]
    rank = np.empty(size, np.uint32)
    rank[np.argsort(-n, kind="stable")] = np.arange(size, dtype=np.uint32)
    return rank


def write_token_files(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID, block: int = BLOCK) -> None:
    """Write the files of ``docs`` and their rank table under ``path``."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    ids, kind = token_ids(docs, tokenizer, end_id)
    staged_at = f"{path}/ids"
    ids.write.option("compression", "zstd").parquet(staged_at)
    ids = spark.read.schema(ids.schema).parquet(staged_at)
    size = Tokenizer.from_str(vocabulary(tokenizer).decode("utf-8")).get_vocab_size(with_added_tokens=True)
    rank = id_ranks(ids, kind, size)
    by_rank = np.argsort(rank).tolist()
    spark.createDataFrame([(i, r) for r, i in enumerate(by_rank)], "id int, rank int").coalesce(1).write.parquet(f"{path}/ranks")
    shared = spark.sparkContext.broadcast(rank)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, names, own, held, n = shared.value, [], [], 0, 0
        schema = pa.schema([("file", pa.int32()), ("block", pa.int32()), ("docs", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("bytes", pa.binary())])

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"file": file, "block": n, "docs": names, "n_ids": held, "bytes": encode_block(own)}], schema=schema)

        for batch in batches:
            for part in pieces(batch):
                for doc_id, file, raw in zip(*(part.column(i).to_pylist() for i in range(3))):
                    names.append(doc_id)
                    own.append(rank[np.frombuffer(raw, kind)])
                    held += len(own[-1])
                    if held >= block:
                        yield done()
                        names, own, held, n = [], [], 0, n + 1
        if names:
            yield done()

    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    in_order = ids.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    in_order = in_order.select("doc_id", F.spark_partition_id().alias("file"), "ids")
    map_batches(in_order, blocks, "file int, block int, docs array<bigint>, n_ids long, bytes binary").write.parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files.

    Blocks know their ids, so the ids before a block are a running sum within
    its file over blocks, and over files' sums (one row a file).
    """
    by_rank = [r["id"] for r in spark.read.schema("id int, rank int").parquet(f"{path}/ranks").orderBy("rank").collect()]
    shared = spark.sparkContext.broadcast(np.array(by_rank, np.uint32))
    rows = spark.read.schema("file int, block int, docs array<bigint>, n_ids long, bytes binary").parquet(f"{path}/blocks")
    files = rows.groupBy("file").agg(F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")).alias("file_start"))
    inside = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.select("file", "block", "n_ids")
              .withColumn("block_start", F.coalesce(F.sum("n_ids").over(inside), F.lit(0).cast("long")))
              .join(files, "file").select("file", "block", (F.col("file_start") + F.col("block_start")).alias("block_start")))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = shared.value
        schema = pa.schema([("doc_id", pa.int64()), ("file", pa.int32()), ("block", pa.int32()), ("offset", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for row in range(batch.num_rows):
                file, block, names, raw = (batch.column(i)[row].as_py() for i in range(4))
                found = [ids[x].astype("<u4") for x in decode_block(raw)]
                sizes = [len(x) for x in found]
                yield pa.RecordBatch.from_arrays([
                    pa.array(names, pa.int64()), pa.array([file] * len(names), pa.int32()), pa.array([block] * len(names), pa.int32()),
                    pa.array(np.cumsum([0, *sizes[:-1]]) if sizes else [], pa.int64()), pa.array(sizes, pa.int64()),
                    pa.array([zlib.crc32(x.tobytes()) for x in found], pa.int64())], schema=schema)

    found = map_batches(
        rows.select("file", "block", "docs", "bytes"), decode, "doc_id long, file int, block int, offset long, n_tokens long, ids_crc32 long")
    return (found.join(starts, ["file", "block"])
            .select("doc_id", (F.col("block_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path)
    return read_token_files(spark, path)
