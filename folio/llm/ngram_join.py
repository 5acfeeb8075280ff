"""N-gram Jaccard self join by set relations (op 5).

Sets of word shingles are joined exactly at ``100 * |A & B| >= percent * |A | B|``.

* **Index.** A set keeps its shingles in one global order, rare ones first. The order comes from counts over
  all documents; only the most frequent shingles (``HEAVY`` at most) get a weight (a bounded table), the rest count as rare.
  The order changes the work, never the result.
* **Block skipping.** By position: behind position ``n - ceil(percent * n / 100)`` a first common shingle leaves too
  small an overlap, so that block of a set is skipped and never indexed, but for ``n / MORE`` positions: with them, sets that
  qualify meet in as many lists more, and a set that meets others in fewer lists is skipped. By size: a list is run through in
  order of size, blocks beyond the size ratio are skipped, and an entry whose neighbours in that order are both
  beyond it leaves its list.
* **Answers from a similar set.** Sets that meet in a list go to the group of the list's pivot, its smallest id. A group
  counts one set's overlaps with all others at a time, and derives from these answers what it can of the rest: they
  bound ``|S & R| >= |S & P| + |R & P| - |P|``, which settles most pairs of near copies; and for any S and R it bounds
  ``|S & R| <= min(|S & P|, |R & P|) + min(|S - P|, |R - P|)``, which settles most of the others. The next set is the one with
  most open pairs, until no pair is open.

Identical sets are one class (its smallest id stands for it), found by a 128-bit fingerprint. Nothing is capped: lists
are dealt out by shingle, groups of over ``GROUP`` sets are cut into blocks and each pair of blocks is verified on its
own, and a group returns a forest over its sets and each set's number of links, and not the pairs. A pair is decided in the
group of the smallest pivot that both sets have; a link to a class counts as often as the class has ids.

Null, empty and blank texts have the empty set and link with nothing; repeated ids are one vertex, rows without an id link with
nothing. Ties of size are ordered by id. A very long text is one set in one task, of eight bytes a word. Of extra columns none
is read, whatever its name; an empty table gives an empty one. Shingles are compared by 64 bits of hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from folio.llm.common import (
    Words,
    checkpoint,
    combine,
    connected_components,
    heaviest,
    hot_join,
    mix64,
    signed,
    slices,
    table,
)

HEAVY = 200_000  # most shingles that get a weight
CHUNK = 2_000_000  # shingles counted at a time in a task
MORE = 50  # one more prefix shingle for each so many in the set
GROUP = 500  # texts verified together
PAIRED = 100  # most sets of a pivot whose pairs are looked at before texts travel
FILTER_BITS = 1 << 23  # of the map of documents that take part in a verification
LOCAL = 4  # times that a chunk must hold a shingle to report it


def shingle_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than ``n``: the whole sequence as one."""
    for i, j, data, offsets in slices(column):
        words = Words(data, offsets)
        h = words.hashes(lower=True)
        all_n = combine(h, n)
        for d in range(j - i):
            a, b = words.at[d], words.at[d + 1]
            if b - a >= n:
                yield np.unique(all_n[a : b - n + 1])
            elif b > a:
                yield combine(h[a:b], int(b - a), salt=1)
            else:
                yield np.zeros(0, dtype=np.uint64)


def _profile(n: int):
    """Rows of two kinds in one scan: each text's set size and fingerprint (kind 0), frequent shingles with counts (kind 1)."""

    def counted(chunk: list[np.ndarray]) -> pa.RecordBatch:
        key, count = np.unique(np.concatenate(chunk), return_counts=True)
        key, count = key[count >= LOCAL], count[count >= LOCAL]
        return _rows(1, signed(key), count, np.zeros(len(key), np.int64), np.zeros(len(key), np.int64))

    def run(batches):
        chunk, held = [], 0
        for batch in batches:
            ids, sizes, one, two = batch.column(0), [], [], []  # an Arrow array: ids may be null
            for s in shingle_sets(batch.column(1), n):
                sizes.append(len(s))
                one.append(np.add.reduce(s) if len(s) else np.uint64(0))
                two.append(np.add.reduce(mix64(s ^ np.uint64(0x5851F42D4C957F2D))) if len(s) else np.uint64(0))
                chunk.append(s)
                held += len(s)
                if held >= CHUNK:
                    yield counted(chunk)
                    chunk, held = [], 0
            yield _rows(0, ids, np.array(sizes, np.int64), signed(np.array(one, np.uint64)), signed(np.array(two, np.uint64)))
        if chunk:
            yield counted(chunk)

    return run


def _rows(kind: int, key, count, one, two) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(key), kind, np.int32)), key if isinstance(key, pa.Array) else pa.array(key, pa.int64()), pa.array(count, pa.int64()), pa.array(one), pa.array(two)],
        names=["kind", "key", "n", "one", "two"],
    )


def _prefixes(n: int, percent: int, heavy):
    """(id, prefix): the part of each set that is indexed, in the global order."""

    def run(batches):
        keys, weights = heavy.value
        for batch in batches:
            values, at = [], [0]
            for s in shingle_sets(batch.column(1), n):
                size = len(s)
                keep = min(size, size + (-percent * size // 100) + 1 + size // MORE) if size else 0
                if size and len(keys):
                    where = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
                    weight = np.where(keys[where] == s, weights[where], 0)
                    if weight.any():
                        s = s[np.argsort(weight, kind="stable")]
                values.append(s[:keep])
                at.append(at[-1] + keep)
            flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(signed(flat)))], names=["id", "prefix"]
            )

    return run


def _involved(wanted):
    """(id, bit, text) -> (id, packed): the compressed texts whose bit is set, smaller than their sets."""

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            batch = batch.filter(pa.array(wanted.value[batch.column(1).to_numpy(zero_copy_only=False)]))
            packed = [squeeze((t.as_py() or "").encode()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["id", "packed"])

    return run


def all_links(sets: list[np.ndarray], open_: np.ndarray, percent: int) -> np.ndarray:
    """Which of the pairs that ``open_`` (symmetric) names qualify; every one of them is decided."""
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    need = -(-percent * (size[:, None] + size[None]) // (100 + percent))
    open_ = open_ & (need <= np.minimum(size[:, None], size[None]))
    np.fill_diagonal(open_, False)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), size)
    link = np.zeros((n, n), bool)
    while True:
        degree = open_.sum(1)
        p = int(degree.argmax())
        if not degree[p]:
            return link
        at = np.minimum(np.searchsorted(sets[p], flat), size[p] - 1)
        shared = np.bincount(owner[sets[p][at] == flat], minlength=n)
        linked = open_[p] & (shared >= need[p])
        link[p] |= linked
        link[:, p] |= linked
        open_[p], open_[:, p] = False, False
        rest = size - shared
        sure = open_ & (shared[:, None] + shared[None] - size[p] >= need)  # what both share with P overlaps by so much at least
        link |= sure
        open_ &= ~sure & (np.minimum(shared[:, None], shared[None]) + np.minimum(rest[:, None], rest[None]) >= need)


def _spanning(link: np.ndarray) -> np.ndarray:
    """For each vertex the first one that it is connected with."""
    root = np.full(len(link), -1)
    for k in range(len(link)):
        if root[k] < 0:
            reach = new = np.arange(len(link)) == k
            while new.any():
                new = link[new].any(0) & ~reach
                reach = reach | new
            root[reach] = k
    return root


def _verify(n: int, percent: int):
    """Rows of a bucket, texts (packed, pivs, w) and places (piv, i, j, own) -> (a, b) that connect what qualifies, and (a, no b, links).

    A pair is decided in the group of the smallest pivot that both have, so it is counted once.
    """

    def run(rows: pa.Table) -> pa.Table:
        whole = pa.compute.is_valid(rows.column("packed"))
        texts, places = rows.filter(whole), rows.filter(pa.compute.invert(whole))
        expand = zstandard.ZstdDecompressor().decompress
        plain = pa.array([expand(t).decode() for t in texts.column("packed").to_pylist()], pa.large_string())
        sets = dict(zip(texts.column("id").to_pylist(), shingle_sets(plain, n)))
        pivots = dict(zip(texts.column("id").to_pylist(), texts.column("pivs").to_pylist()))
        weight = dict(zip(texts.column("id").to_pylist(), texts.column("w").to_pylist()))
        groups: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
        for piv, i, j, own, x in zip(*(places.column(c).to_pylist() for c in ("piv", "i", "j", "own", "id"))):
            groups.setdefault((piv, i, j), []).append((x, own))
        a, b, count = [], [], []
        for (piv, i, j), members in groups.items():
            members.sort()
            ids = [x for x, _ in members]
            side = np.array([o == j for _, o in members])
            open_ = np.ones((len(ids), len(ids)), bool) if i == j else side[:, None] != side[None]
            earlier: dict[int, list[int]] = {}
            for k, x in enumerate(ids):
                for p in pivots[x]:
                    if p < piv:
                        earlier.setdefault(p, []).append(k)
            for same in earlier.values():
                open_[np.ix_(same, same)] = False
            link = all_links([sets[x] for x in ids], open_, percent)
            root = _spanning(link)
            for x in np.flatnonzero(root != np.arange(len(ids))).tolist():
                a.append(ids[x])
                b.append(ids[root[x]])
                count.append(0)
            links = link @ np.array([weight[x] for x in ids], np.int64)
            for x in np.flatnonzero(links).tolist():
                a.append(ids[x])
                b.append(None)
                count.append(int(links[x]))
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(count, pa.int64())], names=["a", "b", "links"])

    return run


def _once(meets: DataFrame, percent: int) -> DataFrame:
    """(piv, id) of ``meets(piv, id, n, c)``, ``c`` lists in common with the pivot: what it takes for each pair that may qualify to meet once at least.

    Long texts meet by chance, and near copies under several pivots, but a text travels to all of its pivots. Within pivots of up to ``PAIRED`` sets (so the
    pairs grow with the rows) two sets share at most the smaller ``c`` of lists for each common pivot. Pairs that qualify share 1 + min(n, m) div MORE, so pairs
    that can reach it are kept at their smallest common pivot of these. All stay in larger groups, so a pair that meets in one of them still meets there.
    """
    sizes = meets.groupBy("piv").agg(F.count("*").alias("members")).where("members > 1")
    each = checkpoint(meets.join(sizes, "piv"))
    small = each.where(f"members <= {PAIRED}")
    one = small.select("piv", F.col("id").alias("a"), F.col("n").alias("na"), F.col("c").alias("ca"))
    two = small.select("piv", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("c").alias("cb"))
    pairs = (
        one.join(two, "piv")
        .where(f"a < b and 100 * least(na, nb) >= {percent} * greatest(na, nb)")
        .groupBy("a", "b", "na", "nb")
        .agg(F.min("piv").alias("piv"), F.sum(F.least("ca", "cb")).alias("shared"))
        .where(f"shared >= 1 + least(na, nb) div {MORE}")
    )
    kept = pairs.select("piv", F.explode(F.array("a", "b")).alias("id"))
    return kept.union(each.where(f"members > {PAIRED}").select("piv", "id")).distinct()


def _links(texts: DataFrame, meets: DataFrame, weights: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b): links among the sets that ``meets(piv, id)`` brings together, enough to connect all that qualify; (a, no b, links): counts by ``weights(id, w)``."""
    k = meets.groupBy("piv").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("k"))
    total = meets.join(k, "piv").agg(F.sum("k")).first()[0] or 0
    places = (
        meets.join(k, "piv")
        .withColumn("own", F.expr("cast(pmod(xxhash64(id), k) as int)"))
        .withColumn("other", F.explode(F.expr("sequence(0, k - 1)")))
        .select("piv", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id")
        .withColumn("bucket", F.expr(f"cast(pmod(xxhash64(piv, i, j), {-(-total // GROUP) or 1}) as int)"))
    )
    # a bit map of fixed size keeps most other texts out of the shuffle; the join below decides
    bit = F.expr(f"cast(pmod(xxhash64(id), {FILTER_BITS}) as int)")
    wanted = np.zeros(FILTER_BITS, bool)
    wanted[meets.select(bit.alias("bit")).distinct().toArrow().column("bit").to_numpy()] = True
    kernel = _involved(texts.sparkSession.sparkContext.broadcast(wanted))
    packed = texts.where("id is not null").select("id", bit.alias("bit"), "text").mapInArrow(kernel, "id long, packed binary")
    needed = places.select("bucket", "id").distinct().join(packed, "id").join(meets.groupBy("id").agg(F.collect_set("piv").alias("pivs")), "id").join(weights, "id")
    none = F.lit(None)
    rows = needed.select("bucket", *(none.cast(t).alias(c) for c, t in (("piv", "long"), ("i", "int"), ("j", "int"), ("own", "int"))), "id", "packed", "pivs", "w")
    rows = rows.union(places.select("bucket", "piv", "i", "j", "own", "id", none.cast("binary"), none.cast("array<long>"), none.cast("long")))
    return rows.groupBy("bucket").applyInArrow(_verify(n, percent), "a long, b long, links long")


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """(id_col, n_shingles, n_links, component_id) for every row of ``docs``; links are those to other ids."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    profile = checkpoint(texts.mapInArrow(_profile(n), "kind int, key long, n long, one long, two long"))
    sizes = profile.where("kind = 0").select(F.col("key").alias("id"), "n", "one", "two")
    heavy = heaviest(checkpoint(profile.where("kind = 1").groupBy("key").agg(F.sum("n").alias("w"))), "w", HEAVY).collect()
    keys = np.array([r.key for r in heavy], np.int64).view(np.uint64)
    order = np.argsort(keys)
    table_ = spark.sparkContext.broadcast((keys[order], np.array([r.w for r in heavy], np.int64)[order]))

    classes = sizes.where("n > 0 and id is not null").groupBy("n", "one", "two").agg(F.min("id").alias("rep"), F.count_distinct("id").alias("w"))
    reps = classes.select(F.col("rep").alias("id"), "n")
    postings = (
        texts.mapInArrow(_prefixes(n, percent, table_), "id long, prefix array<long>")
        .join(reps, "id")
        .select("id", F.col("n").cast("int").alias("n"), F.explode("prefix").alias("tok"))
    )
    # a list's pivot and neighbours come from one sort of it: a join with the pivots would shuffle all entries once more
    whole = W.partitionBy("tok")
    by_size = W.partitionBy("tok").orderBy("n", "id")
    # in order of size, the nearest neighbour is the most alike in size; alone beyond the ratio, an entry meets nobody
    # sets of sizes n and m that qualify share 1 + min(n, m) div MORE of the longer prefixes: whoever meets others less often meets none
    least = f"1 + (({percent} * n + 99) div 100) div {MORE}"
    met = (
        postings.withColumns({"below": F.lag("n").over(by_size), "above": F.lead("n").over(by_size)})
        .withColumns({"piv": F.min("id").over(whole), "last": F.max("id").over(whole)})
        .where("piv < last")
        .where(f"100 * below >= {percent} * n or 100 * n >= {percent} * above")
        .groupBy("piv", "id", "n")
        .agg(F.count("*").alias("c"))
        .withColumn("all", F.sum("c").over(W.partitionBy("id")))
        .where(f"all >= {least}")
    )
    meets = checkpoint(_once(checkpoint(met.select("piv", "id", "n", "c")), percent))
    weights = classes.select(F.col("rep").alias("id"), "w")
    links = checkpoint(_links(texts, meets, weights, n, percent))
    found = connected_components(links.where("b is not null").select("a", "b")).withColumnRenamed("id", "rep")
    counts = links.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    info = checkpoint(found.join(counts, "rep", "full"))
    # copies of one text may be a third of all rows: they look up their class, with all that is known of it, by a salted key
    keys = ["n", "one", "two"]
    several = sizes.where("n > 0 and id is not null").groupBy(*keys).agg(F.min("id").alias("rep"), F.count_distinct("id").alias("w"), F.count("*").alias("rows"))
    several = checkpoint(several.where("rows > 1").join(info, "rep", "left"))
    members = hot_join(sizes, several, keys, "rows", "id", "left").select("id", "n", "rep", "w", "component", "links")
    alone = info.select(F.col("rep").alias("own"), F.col("component").alias("component1"), F.col("links").alias("links1"))
    return members.join(alone, F.col("id") == F.col("own"), "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.expr("if(id is null, 0, coalesce(links, links1, 0) + coalesce(w, 1) - 1)").alias("n_links"),
        F.expr("if(id is null, null, coalesce(component, component1, rep, id))").alias("component_id"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: four-word shingles, 85 per cent, every text of ``documents``."""
    return ngram_jaccard_join(table(spark, sf_dir, "documents"), n=4, percent=85)
