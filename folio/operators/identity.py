"""Names and identities: similarity, clusters, aliases, a registry."""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce
from itertools import repeat
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from folio.sources.tables import shared_folder


def jaro(a: str, b: str) -> float:
    """Share of characters that match within half the longer length, less half of those out of order."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(len(a), len(b)) // 2 - 1
    free = [True] * len(b)
    mine = []
    for i, c in enumerate(a):
        j = next((j for j in range(max(0, i - reach), min(len(b), i + reach + 1)) if free[j] and b[j] == c), None)
        if j is not None:
            free[j] = False
            mine.append(c)
    if not mine:
        return 0.0
    theirs = [c for c, unused in zip(b, free) if not unused]
    m, moved = len(mine), sum(x != y for x, y in zip(mine, theirs)) / 2
    return (m / len(a) + m / len(b) + (m - moved) / m) / 3


def jaro_bonus(a: str, b: str, weight: float = 0.1) -> float:
    """Jaro raised by every equal character among the first four, wherever the first difference is."""
    base = jaro(a, b)
    return base + sum(x == y for x, y in zip(a[:4], b[:4])) * weight * (1 - base)


def jaro_bonus_rows(a: np.ndarray, b: np.ndarray, weight: float = 0.1) -> np.ndarray:
    """``jaro_bonus`` of each row of ``a`` with the same row of ``b``: a name's code points in a row, all rows of a matrix of one length."""
    (n, la), lb = a.shape, b.shape[1]
    reach = max(la, lb) // 2 - 1
    rows, free, mine = np.arange(n), np.ones(b.shape, bool), np.zeros(a.shape, bool)
    for i in range(la):
        low, high = max(0, i - reach), min(lb, i + reach + 1)
        if low < high:
            equal = (b[:, low:high] == a[:, i : i + 1]) & free[:, low:high]
            j = equal.argmax(1)
            mine[:, i] = hit = equal[rows, j]
            free[rows[hit], low + j[hit]] = False
    m, k = mine.sum(1), min(la, lb)
    x = np.take_along_axis(a, np.argsort(~mine, axis=1, kind="stable")[:, :k], 1)
    y = np.take_along_axis(b, np.argsort(free, axis=1, kind="stable")[:, :k], 1)
    moved = ((x != y) & (np.arange(k) < m[:, None])).sum(1) / 2
    base = np.where(m > 0, (m / la + m / lb + (m - moved) / np.maximum(m, 1)) / 3, 0.0)
    base[(x == y).all(1) & (m == la) & (la == lb)] = 1.0
    return base + (a[:, : min(4, k)] == b[:, : min(4, k)]).sum(1) * weight * (1 - base)


def _shared_least(la: int, lb: int, base: float) -> int:
    """Equal characters that two names of these lengths need for a ``jaro`` of ``base``: m / la + m / lb + 1 >= 3 * base."""
    return max(1, math.ceil((3 * base - 1) * la * lb / (la + lb) - 1e-9))


def _base(least: float, same: int) -> float:
    """The ``jaro`` that ``least`` takes when ``same`` of the first four characters are equal."""
    return (least - 0.1 * same) / (1 - 0.1 * same)


def _masks(names: list[str]) -> np.ndarray:
    """64 bits a name: one for each of its characters, numbered when they repeat. The 48 most frequent of these have bits of their own.

    Two names' masks differ in no more bits than the names have characters that the other lacks.
    """
    marks = []
    for name in names:
        met: dict[str, int] = {}
        for c in name:
            met[c] = met.get(c, 0) + 1
        marks.append([(c, k) for c, n in met.items() for k in range(1, n + 1)])
    order = Counter(mark for own in marks for mark in own).most_common()
    bit = {mark: 1 << (k if k < 48 else 48 + k % 16) for k, (mark, _) in enumerate(order)}
    return np.array([reduce(or_, (bit[mark] for mark in own), 0) for own in marks], np.uint64)


PAIRS_AT_ONCE = 1 << 17
LONGEST_IN_ROWS = 64  # longer names are few, and scored one by one


def _alike(names: list[str], side: np.ndarray, group: np.ndarray | None, least: float, reach: int):
    """Yields (a, b, score) arrays of places in the sorted ``names``: pairs alike by ``jaro_bonus``, of two sides unless there is one only.

    Every pair's masks are compared, and for what that leaves the first four characters; only pairs that can still reach ``least`` are scored.
    """
    length, mask = np.array([len(x) for x in names]), _masks(names)
    head = np.array([[ord(c) for c in x[:4].ljust(4, "\0")] for x in names], np.uint32).reshape(-1, 4)
    of = {l: np.flatnonzero(length == l) for l in np.unique(length).tolist()}
    spelt = {l: np.array([[ord(c) for c in names[k]] for k in at], np.uint32) for l, at in of.items() if l <= LONGEST_IN_ROWS}
    place = np.zeros(len(names), np.int64)
    for at in of.values():
        place[at] = np.arange(len(at))
    two = side.any() and not side.all()

    def scored(a: np.ndarray, b: np.ndarray, differ: np.ndarray, la: int, lb: int):
        """Pairs of names of ``la`` and ``lb`` characters whose masks differ by so many bits."""
        same = (head[a] == head[b])[:, : min(4, la, lb)].sum(1)
        some = differ <= np.array([la + lb - 2 * _shared_least(la, lb, _base(least, s)) for s in range(5)])[same]
        if group is not None:
            some &= group[a] != group[b]
        low, high = a[some], b[some]
        out = []
        for turned in (False, True):  # the score may depend on the order: the first name by its characters comes first
            x, y = (high, low) if turned else (low, high)
            x, y = x[now := x < y], y[now]
            if max(la, lb) <= LONGEST_IN_ROWS:
                u, v = (spelt[lb], spelt[la]) if turned else (spelt[la], spelt[lb])
                score = jaro_bonus_rows(u[place[x]], v[place[y]])
            else:
                score = np.array([jaro_bonus(names[i], names[j]) for i, j in zip(x, y)], np.float64)
            out.append((x[good := score >= least], y[good], score[good]))
        return tuple(map(np.concatenate, zip(*out)))

    for la, left in of.items():
        for lb in range(la - reach if two else la, la + reach + 1):
            most = lb in of and min(la, lb) >= _shared_least(la, lb, _base(least, 4)) and la + lb - 2 * _shared_least(la, lb, _base(least, 4))
            if most is False:
                continue
            first, second = (left[side[left] == 0], of[lb][side[of[lb]] == 1]) if two else (left, of[lb])
            masks, found, n = mask[second], [], 0
            for k, i in enumerate(first):
                start = k + 1 if la == lb and not two else 0
                differ = np.bitwise_count(masks[start:] ^ mask[i])
                (at,) = (differ <= most).nonzero()
                if len(at):
                    found.append((i, at + start, differ[at]))
                    n += len(at)
                if n >= PAIRS_AT_ONCE or k == len(first) - 1 and found:
                    i, at, differ = zip(*found)
                    yield scored(np.repeat(i, [*map(len, at)]), second[np.concatenate(at)], np.concatenate(differ), la, lb)
                    found, n = [], 0


BLOCK_NAMES = 25_000  # names of a block; two blocks meet in one group


def similar_pairs(names: DataFrame, least: float = 0.92, reach: int = 3, groups: DataFrame | None = None, stars: bool = False) -> DataFrame:
    """(a, b, score): all pairs of names alike by ``jaro_bonus`` whose lengths differ by at most ``reach``; empty and null names have none.

    Names are dealt over blocks, every two blocks meet in one group, and there each pair is looked at by its masks (see ``_alike``). With
    ``groups(name, group)`` only pairs of different groups are given. With ``stars`` the pairs that two blocks give come as one star (a, b) for each of
    their components, so that what is reachable stays the same.
    """
    spark = names.sparkSession
    shared_folder(spark)
    names = names.select("name").where("name <> ''").distinct()
    names = (names if groups is None else names.join(groups.select("name", F.col("group").cast("string").alias("group")), "name")).checkpoint()
    size = names.count()
    blocks = max(1, -(-size // BLOCK_NAMES), min(8, -(-size // 500)))
    own = names.withColumn("block", F.expr(f"int(pmod(xxhash64(name), {blocks}))")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    own = own.select(F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), F.expr("int(block > other)").alias("side"), *names.columns)
    # small rows make much work: a number of partitions that isn't lowered by the rows' size
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(blocks * (blocks + 1) // 2, 4 * spark.sparkContext.defaultParallelism))

    grouped = groups is not None

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["name"].to_pylist(), table["side"].to_pylist(), table["group"].to_pylist() if grouped else repeat(None)))
        known = [r[0] for r in rows]
        group = np.unique(np.array([r[2] for r in rows], object).astype(str), return_inverse=True)[1] if grouped else None
        two = table["x"][0] != table["y"][0]
        side = np.array([r[1] for r in rows])
        if two and (side.all() or not side.any()):
            return pa.table({"a": [], "b": [], **({} if stars else {"score": []})}, schema)
        found = [*zip(*_alike(known, side, group, least, reach))]
        a, b, score = map(np.concatenate, found) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        if stars:
            a, b = (np.array(x, np.int64) for x in zip(*_roots(zip(a.tolist(), b.tolist())))) if len(a) else (a, b)
        text = pa.array(known, pa.string())
        return pa.table([text.take(pa.array(a)), text.take(pa.array(b)), *([] if stars else [pa.array(score)])], schema)

    schema = pa.schema([("a", pa.string()), ("b", pa.string()), *([] if stars else [("score", pa.float64())])])
    return own.repartition(parts, "x", "y").groupBy("x", "y").applyInArrow(run, "a string, b string" + ", score double" * (not stars))


def _roots(pairs) -> list[tuple]:
    """Edges as one star for each of their components, around the smallest id."""
    root: dict = {}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in pairs:
        x, y = find(root.setdefault(a, a)), find(root.setdefault(b, b))
        root[max(x, y)] = min(x, y)
    return [(find(x), x) for x in root if find(x) != x]


def _stars(parts):
    """(a, b) -> (a, b): a partition's edges as stars."""
    ends = _roots((a, b) for part in parts for a, b in zip(part["a"].tolist(), part["b"].tolist()))
    if ends:
        yield pd.DataFrame(ends, columns=["a", "b"])


MERGED_IDS = 1_000_000  # of so many ids a task holds all; of more, labels go along the edges, with the same result


def components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable.

    Each partition's edges become stars. If a task can hold the ids, eight partitions' stars are merged into one partition's until all are; otherwise
    labels go along edges and then jump to their own labels.
    """
    shared_folder(vertices.sparkSession)
    edges = edges.where("a is not null and b is not null").select("a", "b")
    edges = edges.mapInPandas(_stars, edges.schema).checkpoint()
    ids = vertices.select("id").distinct().checkpoint()
    if ids.count() <= MERGED_IDS:
        parts = edges.rdd.getNumPartitions()
        while parts > 1:
            parts = -(-parts // 8)
            edges = edges.coalesce(parts).mapInPandas(_stars, edges.schema).checkpoint()
        return ids.join(edges, F.col("id") == F.col("b"), "left").select("id", F.coalesce("a", "id").alias("component"))
    both = edges.union(edges.select("b", "a")).distinct().checkpoint()
    label = ids.select("id", F.col("id").alias("component"))
    while True:
        near = both.join(label, F.col("b") == F.col("id")).groupBy("a").agg(F.min("component").alias("low"))
        new = label.join(near, F.col("id") == F.col("a"), "left").select("id", F.least("component", F.coalesce("low", "component")).alias("component"), F.col("component").alias("was"))
        jump = new.select(F.col("id").alias("j"), F.col("component").alias("further"))
        new = new.join(jump, F.col("component") == F.col("j"), "left").select("id", F.least("component", F.coalesce("further", "component")).alias("component"), "was").checkpoint()
        label = new.select("id", "component")
        if new.where("component <> was").isEmpty():
            return label


def clusters(names: DataFrame) -> DataFrame:
    """(name, n) -> cluster: its canonical name (the longest, then the first), its members and their count."""
    shared_folder(names.sparkSession)
    names = names.checkpoint()  # several uses below, one scan of the texts
    pairs = similar_pairs(names, stars=True)
    found = components(names.select(F.col("name").alias("id")), pairs).toDF("name", "component")
    own = names.join(found, "name")
    return own.groupBy("component").agg(
        F.min_by("name", F.struct(-F.length("name"), F.col("name"))).alias("canonical"), F.count("*").alias("members"), F.sum("n").alias("mentions")
    )


def alias_owner(claims: DataFrame) -> DataFrame:
    """(alias, kind, owner, n): each alias of a kind goes to the owner with most mentions, then to the first."""
    by = W.partitionBy("alias", "kind").orderBy(F.desc("n"), "owner")
    return claims.withColumn("r", F.row_number().over(by)).where("r = 1").select("alias", "kind", "owner", "n")


def ambiguous(claims: DataFrame, least: int = 2) -> DataFrame:
    """Aliases that several owners wear."""
    return claims.groupBy("alias").agg(F.count_distinct("owner").alias("owners")).where(f"owners >= {least}")


def page_titles(entities: DataFrame) -> DataFrame:
    """(name, kind): a title that several kinds share gets its kind behind it."""
    kinds = entities.groupBy("name").agg(F.count_distinct("kind").alias("kinds"))
    return entities.join(kinds, "name").select("name", "kind", F.expr("if(kinds > 1, concat(name, ' (', kind, ')'), name)").alias("title"))


def slug_ids(names: DataFrame, slug) -> DataFrame:
    """Stable ids: the slug, and a number from the second of its kind on."""
    s = names.withColumn("slug", slug)
    r = F.row_number().over(W.partitionBy("slug").orderBy("name"))
    return s.select("name", F.when(r == 1, F.col("slug")).otherwise(F.concat_ws("_", "slug", r.cast("string"))).alias("entity_id"))


def decision_id(*columns: str):
    """An id made from a decision's content."""
    return F.substring(F.sha1(F.concat_ws("\u001f", *columns)), 1, 12)


def unresolved(claims: DataFrame, registry: DataFrame, key: str) -> DataFrame:
    """Invariant: rows whose owner the registry lacks; a sound registry gives none."""
    return claims.join(registry.select(key), key, "left_anti")
