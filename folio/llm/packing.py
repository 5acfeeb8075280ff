"""Variable-capacity best-fit packing (op 4).

Documents become sequences of permitted lengths (``SIZES`` tokens). A document's length is the number of its byte-level BPE ids
(``byte_bpe``) and one end. One longer than the largest length is cut into pieces of that length; nothing is dropped. Pieces are
dealt by hash into shards of about ``SHARD`` pieces, so no task packs more than that at a time, whatever the input or a repeated id.

In a shard, pieces go longest first into the open bin with the least room that holds them; if none does, a bin is
opened. The permitted lengths are optimised jointly:

* **Opening.** A bin of length ``s`` costs ``s + s * s / SPAN + OVERHEAD``: its tokens, attention among them, and its handling, so
  neither the shortest nor the longest length is the cheapest for a token. Of a bin's room beside the piece only that counts as used which pieces still to
  come can fill: those short enough for the room, less what the room of the open bins takes of them. The length with the least cost for
  each used token is opened: with many short pieces to come the cheapest that holds the piece, with few of them the tightest.
* **Subsets.** That is done for every subset of the lengths that holds the longest piece, and the subset with the lowest total
  cost after downsizing wins. A smaller subset can win, since an opening does not foresee the order of the pieces.
* **Downsizing.** Each bin shrinks to the smallest permitted length that holds its contents.

A null or empty text is one token, its end. Rows with one id and text are alike: they are counted and numbered, so which of them
is in which bin means nothing. Ties are broken by id, the text's hash, number and piece, so bins do not depend on how the table is
dealt out. Null ids are packed as an id of their own; of extra columns none is read; an empty table gives no piece.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.byte_bpe import sizes as token_sizes
from folio.llm.common import checkpoint, table

SIZES = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 32
SPAN = 32_768  # tokens over which attention costs as much as all else of a token
SHARD = 10_000
COPIES = 10_000  # alike rows that one row is spread into at a time


def _lengths(path: str, pattern: str):
    """(id, key, text) -> (id, key, n): BPE ids and one end."""

    def run(batches):
        known = token_sizes(path, pattern)
        for batch in batches:
            n = [known.count(text.as_py() or "") + 1 for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], names=["id", "key", "n"])

    return run


def cost(size: int, overhead: int = OVERHEAD) -> float:
    return size + size * size / SPAN + overhead


class Supply:
    """Tokens of the pieces still to come, by length; pieces come longest first."""

    def __init__(self, lengths: list[int], top: int):
        self.count = np.bincount(lengths, minlength=top + 1)
        self.tokens = np.cumsum(self.count * np.arange(top + 1)).tolist()  # of pieces up to a length

    def useful(self, room: int, n: int, left: int, taken: int) -> int:
        """Tokens of ``room`` that pieces after the one of ``n`` can fill; ``left``: tokens of all of those, ``taken``: room of open bins."""
        return max(0, min(room, min(self.tokens[min(room, n)], left) - taken))


def opening(n: int, subset: tuple[int, ...], overhead: int, useful) -> int:
    """The length of ``subset`` that costs least for each token of it that gets used by a piece of ``n`` and those to come."""
    fit = subset[bisect_left(subset, n) :]
    return min(fit, key=lambda s: (cost(s, overhead) / (n + useful(s - n)), s))


def best_fit(lengths: list[int], subset: tuple[int, ...], overhead: int) -> tuple[list[int], list[int]]:
    """(bin of each piece, contents of each bin). ``lengths`` descend and the longest fits."""
    top = subset[-1]
    supply = Supply(lengths, top)
    by_room: list[list[int]] = [[] for _ in range(top + 1)]
    rooms = 0  # bit r: some open bin has room r
    of, filled = [], []
    left, free = sum(lengths), 0
    for n in lengths:
        left -= n
        wide = rooms >> n
        if wide:
            room = n + (wide & -wide).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            room -= n
            free -= n
            filled[b] += n
        else:
            b, room = len(filled), opening(n, subset, overhead, lambda r, n=n: supply.useful(r, n, left, free)) - n
            free += room
            filled.append(n)
        of.append(b)
        if room:
            by_room[room].append(b)
            rooms |= 1 << room
    return of, filled


def subsets(sizes: tuple[int, ...], longest: int) -> list[tuple[int, ...]]:
    """All that hold the longest piece, small ones first."""
    return [c for k in range(1, len(sizes) + 1) for c in combinations(sizes, k) if c[-1] >= longest]


def pack(lengths: list[int], sizes: tuple[int, ...] = SIZES, overhead: int = OVERHEAD) -> tuple[list[int], list[int]]:
    """(bin of each piece, final length of each bin), over the cheapest subset of lengths; the first of several."""
    best = None
    for subset in subsets(sizes, lengths[0]):
        of, filled = best_fit(lengths, subset, overhead)
        final = [sizes[bisect_left(sizes, f)] for f in filled]
        total = sum(cost(s, overhead) for s in final)
        if best is None or total < best[0]:
            best = (total, of, final)
    return best[1], best[2]


ORDER = ("n", "id", "key", "copy", "piece")


def _pack_shard(sizes: tuple[int, ...], overhead: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "descending" if c == "n" else "ascending") for c in ORDER])
        lengths = rows.column("n").to_pylist()
        of, final = pack(lengths, sizes, overhead)
        at, start = [0] * len(final), []
        for b, n in zip(of, lengths):
            start.append(at[b])
            at[b] += n
        columns = {c: rows.column(c) for c in ("id", "piece", "first", "n", "shard")}
        return pa.table(columns | {"bin": pa.array(of, pa.int32()), "bin_start": pa.array(start, pa.int32()), "bin_size": pa.array([final[b] for b in of], pa.int32())})

    return run


def best_fit_packing(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sizes: tuple[int, ...] = SIZES,
    overhead: int = OVERHEAD,
    shard: int = SHARD,
) -> DataFrame:
    """(id_col, piece, first_token, n_tokens, bin_id, bin_start, bin_size): one row for each piece of each row of ``docs``.

    ``path`` and ``pattern``: the BPE ranks and pre-token pattern that lengths are counted by.
    """
    sizes = tuple(sorted(set(sizes)))
    top = sizes[-1]
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("key"), text.alias("text"))
    counted = texts.mapInArrow(_lengths(path, pattern), "id long, key long, n long")
    lengths = checkpoint(counted.groupBy("id", "key", "n").agg(F.count("*").alias("copies")))
    pieces = lengths.agg(F.sum(F.expr(f"copies * ceil(n / {top})"))).first()[0] or 0
    shards = max(1, -(-int(pieces) // shard))
    dealt = (
        lengths.withColumn("block", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES})")))
        .withColumn("copy", F.explode(F.expr(f"sequence(block * {COPIES}, least(copies, (block + 1) * {COPIES}) - 1)")))
        .withColumn("piece", F.explode(F.expr(f"sequence(0, cast(ceil(n / {top}) as int) - 1)")))
        .select(
            "id",
            "key",
            "copy",
            "piece",
            (F.col("piece").cast("long") * top).alias("first"),
            F.least(F.lit(top), F.col("n") - F.col("piece").cast("long") * top).cast("int").alias("n"),
            F.expr(f"cast(pmod(xxhash64(id, key, copy, piece), {shards}) as int)").alias("shard"),
        )
        # a number of its own keeps small rows with long work from being put together into a few tasks
        .repartition(max(1, min(shards, 100_000)), "shard")
    )
    schema = "id long, piece int, first long, n int, shard int, bin int, bin_start int, bin_size int"
    return (
        dealt.groupBy("shard")
        .applyInArrow(_pack_shard(sizes, overhead), schema)
        .select(
            F.col("id").alias(id_col),
            "piece",
            F.col("first").alias("first_token"),
            F.col("n").cast("long").alias("n_tokens"),
            F.concat_ws("-", "shard", "bin").alias("bin_id"),
            "bin_start",
            "bin_size",
        )
    )


def pack_documents(docs: DataFrame) -> DataFrame:
    """``docs`` by the public 50k ranks."""
    import public_tokenizers

    return best_fit_packing(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: every text of ``documents``, measured in ids of op 2."""
    return pack_documents(table(spark, sf_dir, "documents"))
