"""Embedding near-duplicates by product quantisation (op 3).

Vectors are compared within one label only, as unit vectors in double precision. ``cosine >= t`` is
a distance of at most ``delta = sqrt(2 - 2 t)``.

* **Codes.** A vector is coded by its nearest codebook entry in each subspace of about two components; ``rest`` is the length
  of what the codes leave out. Two vectors within ``delta`` have coded vectors within ``delta`` and both rests, so no link is lost by that test.
* **Cells.** A table gives a coded vector a cell: the widths of ``STEP`` that its projections on a few random directions fall in. Vectors
  meet in the cells that they share in any table. The number of directions follows the number of vectors, so that a cell holds about ``CELL``
  of a label; the number of tables follows from it, so that a link at the very threshold is missed with a chance of at most
  ``MISS``, and a closer one with less. **Up to ``EXACT`` different vectors a label there is one cell, and nothing is missed.** A cell ships codes and not vectors.
* **Rerank.** Vectors that met a partner by their codes are looked up and meet again in that cell; the exact cosine decides. A pair that
  shares several cells counts in the first table's. Cells follow from the codes in whole numbers, so both steps agree on which that is.

Codebooks are fitted on about ``SAMPLE`` vectors (a share by hash of the id); all vectors are indexed. Rows for a vector grow with the
number of tables (some 20 for millions of vectors a label) and not with the number of vectors. Equal vectors of one label are one entry
with a multiplicity. A large cell is cut into blocks, and each pair of blocks is a task group of its own, so a hot cell or a large group of near
copies needs no large task. A group returns its link counts and a spanning forest of its links, not the links: rows grow with vectors and not with pairs.

Vectors that are null, empty, zero or hold a null or non-finite component, and those without a label, link with nothing.
Vectors of different lengths don't link. Labels are compared as text, components keep their precision. A repeated id is one
vertex; its rows' links add up. Rows without an id link with nothing. Ties at the threshold link. Of extra columns none is read,
whatever its name; an empty table gives an empty one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import checkpoint, connected_components, hashed_share, hot_join, list_parts, mix64, table

SAMPLE = 8192
CODES = 256
EXACT = 8192  # different vectors of a label that are one cell
CELL = 512  # vectors of a label that a cell is meant to hold where there are more
STEP = 2.0  # of projections on directions whose length is the square root of the width
MISS = 1e-3
MAX_DIRECTIONS = 16
MEET_BLOCK = 4096  # coded vectors of a cell that meet others at a time
BLOCK = 1024
SLACK = 1e-5  # of a cosine, for rounding
ROUNDED = 1e-3  # of a distance, for rounding to four bytes


def _unit(flat: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Unit rows, filled with zeros up to ``width``."""
    out = np.zeros((len(at) - 1, width))
    size = np.diff(at)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(at[:-1], size)] = flat
    top = np.abs(out).max(axis=1, keepdims=True)  # against overflow
    out /= np.where(top > 0, top, 1)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    centre = x[np.unique(np.linspace(0, len(x) - 1, k).astype(int))].copy()
    for _ in range(rounds):
        near = _nearest(x, centre)
        total = np.zeros_like(centre)
        np.add.at(total, near, x)
        count = np.bincount(near, minlength=len(centre))[:, None]
        centre = np.where(count > 0, total / np.maximum(count, 1), centre)
    return centre


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    x, c = x.astype(np.float32), c.astype(np.float32)
    out, square = [np.zeros(0, int)], (c * c).sum(1)
    for i in range(0, len(x), 4096):
        d = x[i : i + 4096] @ (-2 * c.T)
        d += square
        out.append(d.argmin(1))
    return np.concatenate(out)


def _together(apart: float) -> float:
    """The chance that the projections of two points fall in one step."""
    r = STEP / apart
    return math.erf(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


class Quantiser:
    """Codebooks, and the cells of codes: ``directions`` of each of ``tables`` tables."""

    def __init__(self, sample: np.ndarray, most: int, delta: float, exact: int = EXACT, cell: int = CELL):
        """``most``: vectors of the most frequent label."""
        self.width = sample.shape[1]
        self.parts = np.array_split(np.arange(self.width), min(128, -(-self.width // 2)))
        self.books = [_kmeans(sample[:, p], min(CODES, len(sample)), 6) for p in self.parts]
        codes, rest = self.encode(sample)
        self.directions, self.tables = 0, 1
        self._direct(np.random.default_rng(3), MAX_DIRECTIONS)
        steps = self._steps(codes)
        while self.directions < MAX_DIRECTIONS and most > exact:
            self.directions += 1
            _, where, n = np.unique(steps[:, : self.directions], axis=0, return_inverse=True, return_counts=True)
            if float(np.median(n[where.ravel()])) / len(sample) * most <= cell:  # the median: large groups of near copies stay together anyway
                break
        if self.directions:
            met = _together(math.sqrt(delta**2 + 2 * float((rest**2).mean()))) ** self.directions
            self.tables = math.ceil(math.log(MISS) / math.log1p(-met))
        self._direct(np.random.default_rng(5), self.directions * self.tables)

    def _direct(self, rng, n: int) -> None:
        """``shares[s][code]``: what a code of a subspace adds to the projections, as whole numbers."""
        lines, scale = rng.standard_normal((n, self.width)), 1 << 24
        self.step = int(STEP * scale)
        self.shares = [np.rint(b @ lines[:, p].T * scale).astype(np.int64) for p, b in zip(self.parts, self.books)]
        self.shift = rng.integers(0, self.step, n)

    def _steps(self, codes: np.ndarray) -> np.ndarray:
        total = np.tile(self.shift, (len(codes), 1))
        for k, share in enumerate(self.shares):
            total += share[codes[:, k]]
        return total // self.step

    def cells(self, codes: np.ndarray, group: np.ndarray) -> np.ndarray:
        """(vector, table): names of cells; ``group`` is a hash of what else has to agree."""
        out = np.repeat(group.astype(np.uint64)[:, None], self.tables, axis=1) + np.arange(self.tables, dtype=np.uint64)[None]
        out = mix64(out)
        if self.directions:
            steps = self._steps(codes).reshape(len(codes), self.tables, self.directions).astype(np.uint64)
            for k in range(self.directions):
                out = mix64((out ^ steps[:, :, k]) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(k))
        return out.view(np.int64)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, length of the rest)."""
        codes = np.stack([_nearest(x[:, p], b) for p, b in zip(self.parts, self.books)], axis=1).astype(np.uint8)
        return codes, np.linalg.norm(x - self.decode(codes), axis=1)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([b[codes[:, k]] for k, b in enumerate(self.books)], axis=1)


def _coded(quantiser):
    """(id, label, dim, times, group, vector) -> the same and codes with the rest's four bytes behind them."""

    def run(batches):
        q = quantiser.value
        for batch in batches:
            at, flat = list_parts(batch.column(5))
            x = _unit(flat.astype(float), at, q.width)
            codes, rest = q.encode(x) if len(x) else (np.zeros((0, 1), np.uint8), np.zeros(0))
            rest = np.nextafter(rest.astype("<f4"), np.float32(np.inf))
            both = np.concatenate([codes, rest[:, None].view(np.uint8)], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([c.tobytes() for c in both], pa.binary())], names=[*batch.schema.names, "codes"])

    return run


def _read(column) -> tuple[np.ndarray, np.ndarray]:
    """(codes, rests)."""
    both = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    return both[:, :-4], np.ascontiguousarray(both[:, -4:]).view("<f4").ravel().astype(float)


def _in_cells(quantiser):
    """(id, group, codes) -> (cell, id, group, codes), a row for every table."""

    def run(batches):
        q = quantiser.value
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                cells = q.cells(_read(part.column(2))[0], part.column(1).to_numpy())
                take = pa.array(np.repeat(np.arange(part.num_rows), q.tables))
                yield pa.RecordBatch.from_arrays([pa.array(cells.ravel()), *(c.take(take) for c in part.columns)], names=["cell", "id", "group", "codes"])

    return run


def _first_here(q, cell: int, codes: np.ndarray, group: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Whether ``cell`` is the first one that the pairs (u, v) share."""
    if q.tables == 1 or not len(u):
        return np.ones(len(u), bool)
    used, back = np.unique(np.concatenate([u, v]), return_inverse=True)
    cells = q.cells(codes[used], group[used])
    a, b = back[: len(u)], back[len(u) :]
    out = np.empty(len(u), bool)
    for i in range(0, len(u), 1 << 16):
        x, y = cells[a[i : i + (1 << 16)]], cells[b[i : i + (1 << 16)]]
        first = (x == y).argmax(1)
        out[i : i + (1 << 16)] = (x[np.arange(len(x)), first] == cell) & (y[np.arange(len(x)), first] == cell)
    return out


def _sides(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Places of the two blocks that meet; the same ones if a block meets itself."""
    if rows.column("p")[0].as_py() == rows.column("q")[0].as_py():
        every = np.arange(rows.num_rows)
        return every, every
    own, p = rows.column("own").to_numpy(), rows.column("p")[0].as_py()
    return np.flatnonzero(own == p), np.flatnonzero(own != p)


def _meet(quantiser, delta: float):
    """Two blocks of a cell by their codes -> (cell, id): who has a partner that may be near and isn't met in an earlier table."""

    def run(rows: pa.Table) -> pa.Table:
        q = quantiser.value
        rows = rows.combine_chunks()
        left, right = _sides(rows)
        cell = rows.column("cell")[0].as_py()
        some = np.zeros(rows.num_rows, bool)
        if rows.num_rows > 1 and len(left) and len(right):
            codes, rest = _read(rows.column("codes"))
            x, group = q.decode(codes).astype(np.float32), rows.column("group").to_numpy()
            square, room = (x * x).sum(1), (delta + ROUNDED + rest).astype(np.float32)
            for i in range(0, len(left), 256):
                a = left[i : i + 256]
                d = x[a] @ x[right].T  # near if |x|^2 + |y|^2 - 2 d <= (delta + both rests)^2
                far = room[a][:, None] + rest[right].astype(np.float32)
                far *= far
                d *= 2
                d += far
                u, v = np.nonzero(d >= square[a][:, None] + square[right])
                u, v = a[u], right[v]
                new = ~(some[u] & some[v])
                if left is right:
                    new &= u < v
                u, v = u[new], v[new]
                ok = group[u] == group[v]
                ok[ok] = _first_here(q, cell, codes, group, u[ok], v[ok])
                some[u[ok]] = some[v[ok]] = True
        return pa.table({"cell": pa.array(np.full(int(some.sum()), cell), pa.int64()), "id": rows.column("id").filter(pa.array(some))})

    return run


def _link(quantiser, least: float):
    """Two blocks of a cell -> (id, root, n): local component and number of links."""

    def run(rows: pa.Table) -> pa.Table:
        q = quantiser.value
        rows = rows.combine_chunks()
        left, right = _sides(rows)
        ids, times = rows.column("id").to_numpy(), rows.column("times").to_numpy()
        links, root = np.zeros(len(ids)), ids.copy()
        if len(ids) > 1 and len(left) and len(right):
            cell = rows.column("cell")[0].as_py()
            codes, group = _read(rows.column("codes"))[0], rows.column("group").to_numpy()
            at, flat = list_parts(rows.column("vector").combine_chunks())
            x = _unit(flat.astype(float), at, q.width)
            found = []
            for i in range(0, len(left), 128):
                u, v = np.nonzero(x[left[i : i + 128]] @ x[right].T >= least - SLACK)
                u, v = left[i + u], right[v]
                some = (u < v) if left is right else ids[u] != ids[v]
                u, v = u[some], v[some]
                for k in range(0, len(u), 1 << 16):
                    uu, vv = u[k : k + (1 << 16)], v[k : k + (1 << 16)]
                    ok = (np.einsum("ij,ij->i", x[uu], x[vv]) >= least) & (ids[uu] != ids[vv])
                    ok[ok] = _first_here(q, cell, codes, group, uu[ok], vv[ok])
                    found.append((uu[ok], vv[ok]))
            a, b = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, int) for k in range(2))
            links = np.bincount(a, times[b], minlength=len(ids)) + np.bincount(b, times[a], minlength=len(ids))
            while True:
                before = root.copy()
                np.minimum.at(root, a, root[b])
                np.minimum.at(root, b, root[a])
                if (before == root).all():
                    break
        some = np.flatnonzero((links > 0) | (root != ids))
        return pa.table({"id": ids[some], "root": root[some], "n": links[some].astype(np.int64)})

    return run


def _dealt(rows: DataFrame, blocks) -> DataFrame:
    """Rows with ``own``, a block of the cell, repeated for every pair (p, q) of blocks that it is part of."""
    return (
        rows.withColumn("__n", blocks)
        .withColumn("own", F.expr("int(pmod(xxhash64(id), __n))"))
        .withColumn("__other", F.explode(F.expr("sequence(0, __n - 1)")))
        .withColumns({"p": F.least("own", "__other"), "q": F.greatest("own", "__other")})
        .drop("__n", "__other")
    )


def embedding_near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.98, exact: int = EXACT, cell: int = CELL) -> DataFrame:
    """(id_col, n_links, component_id, kept) for every row of ``vectors``."""
    spark = vectors.sparkSession
    delta = float(np.sqrt(2 - 2 * least))
    kind = vectors.schema[vector_col].dataType.elementType.simpleString()
    number = kind if kind in ("float", "double") else "double"  # no vector loses digits
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{number}>").alias("vector"), F.col(label_col).cast("string").alias("label"))
    usable = F.expr(
        "id is not null and label is not null and vector is not null and size(vector) > 0 and "
        "forall(vector, x -> x is not null and not isnan(x) and abs(x) < float('infinity')) and exists(vector, x -> x <> 0)"
    )
    key = [F.xxhash64("label", "vector").alias("k1"), F.xxhash64(F.lit(1), "vector", "label").alias("k2")]
    good = rows.where(usable).select("id", "label", "vector", *key)
    classes = checkpoint(good.groupBy("label", "k1", "k2").agg(F.min("id").alias("rep"), F.countDistinct("id").alias("times")))
    entries = (
        good.join(classes.select("label", "k1", "k2", F.col("rep").alias("id"), "times"), ["label", "k1", "k2", "id"])
        .select("label", F.size("vector").alias("dim"), "id", "times", "vector", "k1", "k2")
        .dropDuplicates(["label", "k1", "k2"])
        .drop("k1", "k2")
    )
    entries = entries.withColumn("group", F.xxhash64("label", "dim"))
    shape = entries.groupBy("label").agg(F.count("*").alias("n"), F.max("dim").alias("width")).agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.max("width").alias("width")).first()
    n, width = shape.n, shape.width or 1
    nothing = F.lit(0).cast("long")
    if not n:
        return rows.select(F.col("id").alias(id_col), nothing.alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    got = entries.where(hashed_share("id", max(SAMPLE, 64) / n)).select("vector").toArrow().column("vector").combine_chunks()
    at, flat = list_parts(got)
    if not len(got):
        at, flat = np.array([0, 1]), np.ones(1)
    quantiser = spark.sparkContext.broadcast(Quantiser(_unit(flat.astype(float), at, width), shape.most, delta, exact, cell))

    fields = f"id long, label string, dim int, times long, group long, vector array<{number}>"
    coded = checkpoint(entries.select("id", "label", "dim", "times", "group", "vector").mapInArrow(_coded(quantiser), fields + ", codes binary"))
    cells = coded.select("id", "group", "codes").mapInArrow(_in_cells(quantiser), "cell long, id long, group long, codes binary")
    # which cells are cut: counted on a share of the ids, as it decides nothing but the size of tasks
    share = min(1.0, max(1 / 16, 200_000 / n))
    part = coded.where(hashed_share("id", share)).select("id", "group", "codes").mapInArrow(_in_cells(quantiser), "cell long, id long, group long, codes binary")
    large = part.groupBy("cell").agg(F.ceil(F.count("*") / (share * MEET_BLOCK)).cast("int").alias("blocks")).where("blocks > 1")
    met = (
        _dealt(cells.join(F.broadcast(large), "cell", "left"), F.coalesce("blocks", F.lit(1)))
        .select("cell", "p", "q", "own", "id", "group", "codes")
        .groupBy("cell", "p", "q")
        .applyInArrow(_meet(quantiser, delta), "cell long, id long")
    )
    met = checkpoint(met.distinct())
    blocks = met.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    looked_up = coded.join(met.join(blocks, "cell"), "id")
    found = checkpoint(
        _dealt(looked_up, F.col("blocks"))
        .select("cell", "label", "dim", "p", "q", "own", "id", "times", "group", "vector", "codes")
        .groupBy("cell", "label", "dim", "p", "q")
        .applyInArrow(_link(quantiser, least), "id long, root long, n long")
    )
    links = checkpoint(found.groupBy(F.col("id").alias("rep")).agg(F.sum("n").alias("n")))
    # copies of one vector may be a third of all rows: they look up their class, with all that is known of it, by a salted key
    keyed = rows.where(usable).select("id", "label", *key).distinct()
    several = checkpoint(classes.where("times > 1").join(links, "rep", "left"))
    members = hot_join(keyed, several, ["label", "k1", "k2"], "times", "id", "left").select("id", F.coalesce("rep", "id").alias("rep"), F.coalesce("times", F.lit(1)).alias("times"), "n")
    members = members.join(links.select(F.col("rep").alias("own"), F.col("n").alias("n1")), F.col("id") == F.col("own"), "left")
    of_id = checkpoint(members.groupBy("id").agg(F.sum(F.coalesce("n", "n1", nothing) + F.col("times") - 1).alias("n_links"), F.min("rep").alias("rep"), F.collect_set("rep").alias("reps")))
    # an id with several vectors connects their classes
    same = of_id.where("size(reps) > 1").select(F.explode("reps").alias("a"), F.col("rep").alias("b"))
    component = connected_components(found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")).union(same)).withColumnRenamed("id", "rep")
    linked = checkpoint(of_id.groupBy("rep").agg(F.count("*").alias("rows")).join(component, "rep"))
    counted = hot_join(of_id, linked, ["rep"], "rows", "id", "left").select(F.col("id").alias("m"), "n_links", F.coalesce("component", "rep").alias("component"))
    out = rows.join(counted, F.col("id") == F.col("m"), "left")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", nothing).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.coalesce("component", "id") == F.col("id"), F.lit(True)).alias("kept"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: all vectors of ``embeddings`` at cosine 0.98 within their label."""
    return embedding_near_duplicates(table(spark, sf_dir, "embeddings"))
