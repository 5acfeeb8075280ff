"""Pieces that several training-data operators share: checkpoints, word and shingle hashing on
Arrow buffers, and connected components.

A *word* is a maximal run of bytes outside ``\\x20\\x09-\\x0D``. Words are hashed straight from
the UTF-8 buffer of an Arrow column (no Python object per word), eight bytes at a time: each block is
xored into the state and mixed before the next one, so that no sum or power of bytes can cancel.
Different words share a hash with a chance of about 2**-64; whoever remembers results by such a hash
compares the bytes before use (``same_runs``).
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 21  # text worked on at a time
MAPPED_BYTES = 1 << 24  # an array of this size gets memory of its own from the system
LONG_RUN = 64  # bytes; longer runs are hashed and compared one by one
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where none is set, a local session uses its warehouse; a cluster is an error."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints")
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


@contextmanager
def arrow_rows(spark: SparkSession, most: int):
    """Within, actions hand Python that many rows at a time at most: a batch of whole texts is held by the JVM and by the worker, twice over while it grows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(most, int(before)) if int(before) > 0 else most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def tidy(kernel):
    """``kernel(batches)``, with large arrays mapped apart, and with all that is free given back at its end: a worker lives on, through stages without Python too."""

    @functools.wraps(kernel)
    def run(batches):
        libc = ctypes.CDLL(None)
        with suppress(AttributeError):  # another C library than glibc
            libc.mallopt(-3, MAPPED_BYTES)  # M_MMAP_THRESHOLD, which would else rise to the largest array ever freed
            libc.mallopt(-1, 2 * MAPPED_BYTES)  # M_TRIM_THRESHOLD, which would else be 128 KB from now on
        yield from kernel(batches)
        pa.default_memory_pool().release_unused()
        with suppress(AttributeError):
            libc.malloc_trim(0)

    return run


def hot_join(big: DataFrame, small: DataFrame, keys: list[str], count: str, by: str, how: str = "inner") -> DataFrame:
    """``big`` joined with ``small`` (one row for each key, ``count`` its rows in ``big``) without one task for a hot key.

    A key with over a 500th of all rows is salted: its row in ``small`` is repeated, its rows in ``big`` are dealt out by the
    hash of the column ``by``. There are at most 500 such keys, so their broadcast is bounded.
    """
    total = small.agg(F.sum(count)).first()[0] or 0
    share = max(1, total // 500)
    salts = F.ceil(F.col(count) / share).cast("int")
    hot = small.where(F.col(count) > share).select(*keys, salts.alias("__salts"))
    spread = F.coalesce(F.pmod(F.xxhash64(by), F.col("__salts")).cast("int"), F.lit(0))
    dealt = big.join(F.broadcast(hot), keys, "left").withColumn("__salt", spread).drop("__salts")
    repeated = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.when(F.col(count) > share, salts - 1).otherwise(F.lit(0)))))
    return dealt.join(repeated, [*keys, "__salt"], how).drop("__salt")


def heaviest(df: DataFrame, weight: str, most: int) -> DataFrame:
    """Rows of ``df`` with the largest weights (1 or more), ``most`` of them at most: all above a least weight.

    The least weight comes from a histogram in eighths of powers of two, so that no task and no driver sorts rows.
    """
    bucket = F.floor(8 * F.log2(weight)).cast("int")
    counts = {r.b: r.n for r in df.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect() if r.b is not None}  # some 500 rows
    taken, least = 0, None
    for b in sorted(counts, reverse=True):
        taken += counts[b]
        if taken > most:
            break
        least = b
    return df.where(bucket >= least) if least is not None else df.where("false")


def hashed_share(column: str, share: float):
    """Condition that holds for about this share of a column's values, by their hash."""
    return F.pmod(F.xxhash64(column), F.lit(1 << 40)) < int(min(1.0, share) * (1 << 40))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(8)] + [_MASK], dtype=np.uint64)  # the first k of eight bytes


def _padded(data: np.ndarray) -> np.ndarray:
    """Every eight bytes of ``data`` as one number, by the place of the first; behind the end are zeros."""
    room = np.zeros(len(data) + 8, np.uint8)
    room[: len(data)] = data
    return np.ndarray(len(data) + 1, "<u8", room, strides=(1,))


def hash_runs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each run: eight bytes at a time through a multiply and xor chain; long runs by XXH3."""
    size = end - start
    out = mix64(size.astype(np.uint64) * np.uint64(_BASE) + np.uint64(0x2545F4914F6CDD1D))
    eight = _padded(data)
    some = np.flatnonzero((size > 0) & (size <= LONG_RUN))
    at = 0
    while len(some):
        block = eight[start[some] + at] & _KEEP[np.minimum(size[some] - at, 8)]
        out[some] = mix64((out[some] ^ block) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(_BASE))
        at += 8
        some = some[size[some] > at]
    for k in np.flatnonzero(size > LONG_RUN).tolist():
        out[k] = xxhash.xxh3_64_intdigest(data[start[k] : end[k]])
    return out


def same_runs(a: np.ndarray, a_start: np.ndarray, b: np.ndarray, b_start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether ``size`` bytes of ``a`` and of ``b`` are the same, for each pair of runs."""
    out = np.ones(len(size), bool)
    left, right = _padded(a), _padded(b)
    some, at = np.flatnonzero((size > 0) & (size <= LONG_RUN)), 0
    while len(some):
        keep = _KEEP[np.minimum(size[some] - at, 8)]
        out[some] &= (left[a_start[some] + at] & keep) == (right[b_start[some] + at] & keep)
        at += 8
        some = some[size[some] > at]
    for k in np.flatnonzero(size > LONG_RUN).tolist():
        out[k] = np.array_equal(a[a_start[k] : a_start[k] + size[k]], b[b_start[k] : b_start[k] + size[k]])
    return out


class Words:
    """Words of a run of texts: ``start`` and ``end`` in ``data``; text ``i`` has the words ``at[i]:at[i + 1]``."""

    __slots__ = ("data", "offsets", "start", "end", "at")

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        solid = ~_SPACE[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        before, after = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
        if n:
            before[1:] = ~solid[:-1] | edge[1:n]
            after[:-1] = ~solid[1:] | edge[1:n]
        self.data, self.offsets = data, offsets
        self.start = np.flatnonzero(solid & before)
        self.end = np.flatnonzero(solid & after) + 1
        self.at = np.searchsorted(self.start, offsets)

    def hashes(self, lower: bool) -> np.ndarray:
        return hash_runs(_LOWER[self.data] if lower else self.data, self.start, self.end)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets) for runs of texts of about ``most`` bytes; a null text has no bytes."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    n = len(column)
    if not n:
        return
    _, where, body = column.buffers()
    offsets = np.frombuffer(where, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1))
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def list_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, values) of a list column, so that row ``i`` is ``values[offsets[i]:offsets[i + 1]]``; null is empty."""
    at = np.concatenate([[0], np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False))])
    return at.astype(np.int64), column.flatten().to_numpy(zero_copy_only=False)


def combine(hashes: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of ``k`` neighbouring word hashes."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    acc = np.full(n, (salt * 0xD1B54A32D192ED03 + k) & _MASK, dtype=np.uint64)
    for j in range(k):
        acc += hashes[j : j + n] * np.uint64(((2 * j + 3) * 0xA0761D6478BD642F) & _MASK | 1)
    return mix64(acc)


def few(df: DataFrame, rows: int, most: int) -> DataFrame:
    """``df`` in one task a core, or as many as keep to ``most`` rows each: for tasks that each report a table of fixed size."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // most), 1))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id reachable over ``edges(a, b)``; only ids that an edge names.

    Alternating stars: every vertex hands its larger neighbours, then its smaller ones, to the
    smallest of them. Each step is one aggregation and one join, no row holds a neighbour list, and
    a vertex with very many neighbours is summed up before the shuffle. Rounds grow with the
    logarithm of a component's diameter.
    """
    edges = checkpoint(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    )
    state = None
    for _ in range(max_rounds):
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        ).distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u")
        edges = checkpoint(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(small.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        seen = edges.agg(
            F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(cast(xxhash64(v, u) as decimal(38, 0)))")
        ).first()
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.groupBy("u").agg(F.min("v").alias("component"))
    return roots.select(F.col("u").alias("id"), "component").union(
        roots.select(F.col("component").alias("id"), "component").distinct()
    )
