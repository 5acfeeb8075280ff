"""Token ids in bit-plane shuffled, zstandard-compressed blocks with a chunk index (op 10).

A store is a Parquet folder that Spark writes (so it may lie in any store that Spark reaches, and a
lost executor's part is written again by the committer). One row is one *chunk*: whole documents in
ascending id order, closed when it holds ``CHUNK_IDS`` ids. Columns ``shard``, ``chunk``, ``first``
(ids of the shard before it), ``n_ids``, ``n_docs`` and ``crc32`` are the chunk index, read without
the payload by column pruning. ``payload`` is binary, little-endian:

    magic b"TIDP", u8 version, u8 mode (1 byte planes, 2 bit planes), u16 planes a block,
    u32 ids a block, u64 ids, u32 documents,
    i64 doc ids, u32 ids of each document,
    u32 compressed size of each plane of each block, then the zstandard frames.

A block holds ``BLOCK_IDS`` ids (the last one fewer). In byte planes, plane ``p`` holds byte ``p`` of every id;
in bit planes, plane ``p`` holds bit ``p`` of every id, eight ids a byte. High planes of a
vocabulary under 65,536 ids are all zeros and shrink to nothing.

Each document ends with ``end_id``. Null and empty texts hold that id alone; null document ids sort
first and are kept as a flagged smallest value; ties in the id are ordered by text.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import checkpoint_folder, slices, table
from folio.llm.pieces import Pieces, Ragged

MAGIC, BYTE_PLANES, BIT_PLANES = b"TIDP", 1, 2
BLOCK_IDS = 1 << 16
CHUNK_IDS = 1 << 20
NULL_ID = -(1 << 63)
_HEAD = struct.Struct("<4sBBHIQI")


def to_planes(ids: np.ndarray, mode: int) -> list[bytes]:
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if mode == BYTE_PLANES:
        return [raw[:, p].tobytes() for p in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, p]).tobytes() for p in range(32)]


def from_planes(planes: list[bytes], n: int, mode: int) -> np.ndarray:
    if mode == BYTE_PLANES:
        raw = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p in planes], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").ravel()


def pack(doc_ids: np.ndarray, sizes: np.ndarray, ids: np.ndarray, mode: int = BYTE_PLANES, level: int = 3) -> bytes:
    planes = 4 if mode == BYTE_PLANES else 32
    squeeze = zstandard.ZstdCompressor(level=level).compress
    frames = [squeeze(p) for i in range(0, len(ids), BLOCK_IDS) for p in to_planes(ids[i : i + BLOCK_IDS], mode)]
    head = _HEAD.pack(MAGIC, 1, mode, planes, BLOCK_IDS, len(ids), len(doc_ids))
    lengths = np.array([len(f) for f in frames], "<u4").tobytes()
    return b"".join([head, np.asarray(doc_ids, "<i8").tobytes(), np.asarray(sizes, "<u4").tobytes(), lengths, *frames])


def unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, ids of each document, ids)."""
    magic, version, mode, planes, block, n, docs = _HEAD.unpack_from(payload)
    if magic != MAGIC or version != 1:
        raise ValueError("not a token chunk")
    at = _HEAD.size
    doc_ids = np.frombuffer(payload, "<i8", docs, at)
    sizes = np.frombuffer(payload, "<u4", docs, at + 8 * docs)
    at += 12 * docs
    blocks = -(-n // block)
    lengths = np.frombuffer(payload, "<u4", blocks * planes, at)
    at += 4 * len(lengths)
    expand = zstandard.ZstdDecompressor().decompress
    out = []
    for b in range(blocks):
        own = []
        for size in lengths[b * planes : (b + 1) * planes]:
            own.append(expand(payload[at : at + int(size)]))
            at += int(size)
        out.append(from_planes(own, min(block, n - b * block), mode))
    return doc_ids, sizes, np.concatenate(out) if out else np.zeros(0, np.uint32)


class Library:
    """The tokenizers library behind a memory of pieces."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known = Ragged(np.uint32)
        (self.newline,) = self.tokenizer.encode("\n", add_special_tokens=False).ids

    def _whole(self, p: Pieces, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # a piece without inner white space can't reach across a line feed: thousands go in as the lines of one text
        texts = [p.word(k).decode() for k in places]
        plain = [t.split() == [t[t[0] == " " :]] for t in texts]
        lines = [t for t, a in zip(texts, plain) if a]
        odd = [t for t, a in zip(texts, plain) if not a]
        sizes, values = np.zeros(len(texts), np.int64), [None] * len(texts)
        where = [k for k, a in enumerate(plain) if a]
        for i in range(0, len(lines), 4096):
            part = lines[i : i + 4096]
            ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            cuts = np.flatnonzero(ids == self.newline)
            if len(cuts) != len(part) - 1:
                odd_ids = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            else:
                odd_ids = [x[1:] if k else x for k, x in enumerate(np.split(ids, cuts))]
            for k, x in zip(where[i : i + 4096], odd_ids):
                values[k] = x
        rest = [k for k, a in enumerate(plain) if not a]
        for k, e in zip(rest, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False) if odd else []):
            values[k] = np.array(e.ids, np.uint32)
        sizes[:] = [len(v) for v in values]
        return sizes, np.concatenate(values)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = Pieces(data, offsets)
        ids, size = self.known.gather(p.hashes(lower=False), p.data, p.start, p.end, lambda places: self._whole(p, places))
        return ids, np.concatenate([[0], np.cumsum(size)])[p.at]


@lru_cache(maxsize=1)
def library(path: str) -> Library:
    return Library(path)


STORE = "shard int, chunk int, first long, n_ids long, n_docs int, crc32 long, payload binary"


def _write(path: str, end_id: int, mode: int, level: int):
    def run(batches):
        from pyspark import TaskContext

        lib, shard = library(path), TaskContext.get().partitionId()
        doc_ids, sizes, ids, held, first, chunk = [], [], [], 0, 0, 0

        def close():
            nonlocal doc_ids, sizes, ids, held, first, chunk
            flat = np.concatenate(ids)
            payload = pack(np.concatenate(doc_ids), np.concatenate(sizes), flat, mode, level)
            row = [[shard], [chunk], [first], [len(flat)], [sum(map(len, sizes))], [zlib.crc32(payload)], [payload]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            out = pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names=[c.split()[0] for c in STORE.split(", ")])
            first, chunk, held = first + len(flat), chunk + 1, 0
            doc_ids, sizes, ids = [], [], []
            return out

        for batch in batches:
            own = pa.compute.fill_null(batch.column(0), NULL_ID).to_numpy(zero_copy_only=False)
            for i, j, data, offsets in slices(batch.column(1)):
                got, at = lib.encode(data, offsets)
                # the end id after each document's ids
                flat = np.insert(got, at[1:], end_id) if j > i else got
                doc_ids.append(own[i:j])
                sizes.append(np.diff(at) + 1)
                ids.append(flat.astype(np.uint32))
                held += len(flat)
                if held >= CHUNK_IDS:
                    yield close()
        if sizes:
            yield close()

    return run


def write_tokens(
    docs: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", mode: int = BYTE_PLANES, level: int = 3
) -> None:
    """Encode every text of ``docs`` into the store ``folder``, in ascending order of the id."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = texts.repartitionByRange(parts, F.col("id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    ordered.mapInArrow(_write(path, end_id, mode, level), STORE).write.mode("overwrite").parquet(folder)


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of a store. ``start`` counts the ids of all documents before."""
    store = spark.read.schema(STORE).parquet(folder)
    # one number a shard comes to the driver: shards are Spark partitions, not data
    shards = {r.shard: r.n for r in store.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()}
    before, total = {}, 0
    for s in sorted(shards):
        before[s], total = total, total + shards[s]

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                payload = batch.column(3)[k].as_py()
                if zlib.crc32(payload) != batch.column(2)[k].as_py():
                    raise ValueError("a chunk is damaged")
                doc_ids, sizes, ids = unpack(payload)
                ends = np.cumsum(sizes, dtype=np.int64)
                base = before[batch.column(0)[k].as_py()] + batch.column(1)[k].as_py()
                raw = memoryview(ids.astype("<u4").tobytes())
                columns = [
                    pa.array(doc_ids, pa.int64(), mask=doc_ids == NULL_ID),
                    pa.array(base + ends - sizes, pa.int64()),
                    pa.array(sizes.astype(np.int64)),
                    pa.array([zlib.crc32(raw[4 * (e - s) : 4 * e]) for e, s in zip(ends.tolist(), sizes.tolist())], pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids, pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return store.select("shard", "first", "crc32", "payload").mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: every text of ``documents``, written in ascending doc_id order and read back."""
    import public_tokenizers

    folder = f"{checkpoint_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_tokens(spark, folder)
