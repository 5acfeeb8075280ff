"""Substring dedup by relative Lempel-Ziv parsing (op 7).

Every document is parsed against all documents before it (in id order, then position) into *factors*: copies
``(first word, end, source document, first word there)`` of at least ``window`` words, and words of its own between them.

* **Reference blocks.** The reference is the whole corpus, cut at content-defined anchors: an anchor
  is the ``GRAM``-word run with the smallest hash among the runs of some window. Equal windows have
  the same anchor at the same place, so a window can repeat only if its anchor does. Anchors (about
  2 in ``window - GRAM + 2`` words) are indexed in Spark over all documents.
* **Longest matches.** Windows that hold a repeated anchor are looked up against *every* indexed block by 96 bits of hash,
  and the answer is a place, not a yes: the document and word where the window starts earlier. A match is grown
  greedily while the next window's answer is the next word of the same source, which gives the longest copy of that source.
* **Factor boundaries.** Every window that crosses the end of a factor is looked up like any other and becomes a factor of its own,
  which overlaps its neighbours; so the words of all factors are exactly those covered by a window that starts earlier somewhere.

Windows are first looked up within the slice of texts that a task holds: of equal windows there only the earliest asks the index, and the
others' source is its place. So a passage that a third of all documents share costs a row a slice, not a row a document, at
its key. Which of several earlier places is a factor's source may thus depend on how the table is dealt out; what is removed doesn't.

Documents with identical texts are settled first by SHA-256 (every later copy is one factor), and only the first of them is
parsed. Null and empty texts have no words; a text shorter than the window keeps all its words. Different texts under one id
are ordered by a hash of them; null ids come before all others. A row that is there
twice (same id, same text) is one document, and each of its rows has the same result. An empty table gives an empty one. All
other columns are returned untouched, whatever their names; the result is one struct column, whose name must be new.
A very long text is hashed whole, at some thirty bytes a word in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import Words, checkpoint, combine, hot_join, signed, slices, table

WINDOW = 20
GRAM = 8
RUN = np.dtype([("first", ">i4"), ("windows", ">i4"), ("id", ">u8"), ("key", ">u8"), ("at", ">i4")])
FOUND = "met boolean, h long, g int, place binary"


def _anchors(h: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(the grams' hashes, for each window start the place of its smallest gram, the last if several)."""
    grams = combine(h, gram, salt=7)
    span = window - gram + 1
    starts = len(h) - window + 1
    if starts <= 0:
        return grams, np.zeros(0, np.int64)
    best, where = grams[:starts].copy(), np.arange(starts)
    for j in range(1, span):
        other = grams[j : j + starts]
        less = other <= best
        best[less] = other[less]
        where[less] = np.flatnonzero(less) + j
    return grams, where


class _Slice:
    """Places of a slice's texts: a text's head is its id and key as big-endian bytes, so that bytes sort as the corpus does."""

    def __init__(self, batch, i: int, j: int, words: Words):
        ids = pa.compute.fill_null(batch.column(2)[i:j], -(1 << 63)).to_numpy(zero_copy_only=False).view(np.uint64) ^ np.uint64(1 << 63)
        self.keys = [k or b"\0" * 8 for k in batch.column(0)[i:j].to_pylist()]
        raw = ids.astype(">u8").tobytes()
        self.heads = [raw[8 * d : 8 * d + 8] + k for d, k in enumerate(self.keys)]
        by = sorted(range(j - i), key=self.heads.__getitem__)
        self.rank = np.empty(j - i, np.int64)
        self.rank[by] = np.arange(j - i)
        again = [d for a, d in zip(by, by[1:]) if self.heads[a] == self.heads[d]]
        self.once = np.ones(j - i, bool)  # a row that is there again asks nothing: its answer comes by its key
        self.once[again] = False
        self.at = words.at

    def groups(self, h: np.ndarray, g: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order of the places by hash, document and place; for each in that order the position of its group's first)."""
        order = np.lexsort((self.rank[doc] << 32 | place, h))
        new = np.ones(len(order), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
        return order, np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))

    def asked(self, h: np.ndarray, g: np.ndarray, doc: np.ndarray, place: np.ndarray) -> list:
        raw = place.astype(">i4").tobytes()
        return [np.zeros(len(h), bool), signed(h), g, [self.heads[d] + raw[4 * k : 4 * k + 4] for k, d in enumerate(doc.tolist())]]

    def met(self, doc: np.ndarray, payload: list[bytes]) -> list:
        """Rows for the documents themselves: they lie at their key's hash, and so evenly."""
        own = [self.keys[d] for d in doc.tolist()]
        h = np.frombuffer(b"".join(own), ">i8").astype(np.int64)
        return [np.ones(len(own), bool), h, np.zeros(len(own), np.int32), [k + p for k, p in zip(own, payload)]]


def _batch(*parts: list) -> pa.RecordBatch:
    columns = [pa.array(np.concatenate([p[c] for p in parts]), t) for c, t in enumerate((pa.bool_(), pa.int64(), pa.int32()))]
    return pa.RecordBatch.from_arrays([*columns, pa.array([x for p in parts for x in p[3]], pa.binary())], names=[c.split()[0] for c in FOUND.split(", ")])


def _index(window: int, gram: int):
    """(k, text, id, row) -> FOUND: anchors that are once in the slice ask whether others have them; repeated ones are known to be."""

    def run(batches):
        for batch in batches:
            for i, j, data, offsets in slices(batch.column(1)):
                words = Words(data, offsets)
                h, own = words.hashes(lower=False), _Slice(batch, i, j, words)
                doc, place, hashes = [], [], []
                for d in np.flatnonzero(own.once).tolist():
                    grams, where = _anchors(h[words.at[d] : words.at[d + 1]], window, gram)
                    at = np.unique(where)
                    doc.append(np.full(len(at), d))
                    place.append(at)
                    hashes.append(grams[at])
                doc, place, hashes = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (doc, place, hashes))
                none = np.zeros(len(doc), np.int32)
                order, first = own.groups(hashes.astype(np.uint64), none, doc, place)
                lead = first == np.arange(len(order))
                size = np.bincount(first, minlength=len(order))[first]
                ask, same = order[lead], order[size > 1]
                same = same[np.lexsort((place[same], doc[same]))]
                cuts = np.flatnonzero(np.append(True, doc[same][1:] != doc[same][:-1])) if len(same) else np.zeros(0, np.int64)
                payload = [p.astype(">i4").tobytes() for p in np.split(place[same], cuts[1:])] if len(same) else []
                yield _batch(own.asked(hashes[ask].astype(np.uint64), none[ask], doc[ask], place[ask]), own.met(doc[same][cuts], payload))

    return run


def _windows(window: int, gram: int):
    """(k, text, id, row, places of repeated anchors) -> FOUND: the slice's earliest of equal windows asks, the others have their source."""

    def run(batches):
        for batch in batches:
            anchors = batch.column(4).to_pylist()
            for i, j, data, offsets in slices(batch.column(1)):
                words = Words(data, offsets)
                h, own = words.hashes(lower=False), _Slice(batch, i, j, words)
                doc, place, one, two = [], [], [], []
                for d in np.flatnonzero(own.once).tolist():
                    mine = h[words.at[d] : words.at[d + 1]]
                    _, where = _anchors(mine, window, gram)
                    hot = np.flatnonzero(np.isin(where, np.frombuffer(b"".join(anchors[i + d] or []), ">i4")))
                    if len(hot):
                        doc.append(np.full(len(hot), d))
                        place.append(hot)
                        one.append(combine(mine, window, salt=11)[hot])
                        two.append((combine(mine, window, salt=23)[hot] >> np.uint64(32)).astype(np.uint32).view(np.int32))
                if not doc:
                    continue
                doc, place, one, two = (np.concatenate(x) for x in (doc, place, one, two))
                order, first = own.groups(one, two, doc, place)
                lead = first == np.arange(len(order))
                ask, rest, source = order[lead], order[~lead], order[first[~lead]]
                by = np.lexsort((place[rest], doc[rest]))
                rest, source = rest[by], source[by]
                runs = _runs(doc[rest], place[rest], doc[source], place[source])
                firsts, sizes = rest[runs[:, 0]], runs[:, 1]
                at = source[runs[:, 0]]
                near = place[firsts].astype(">i4").tobytes(), sizes.astype(">i4").tobytes(), place[at].astype(">i4").tobytes()
                payload = [near[0][4 * k : 4 * k + 4] + near[1][4 * k : 4 * k + 4] + own.heads[d] + near[2][4 * k : 4 * k + 4] for k, d in enumerate(doc[at].tolist())]
                yield _batch(own.asked(one[ask], two[ask], doc[ask], place[ask]), own.met(doc[firsts], payload))

    return run


def _runs(doc: np.ndarray, place: np.ndarray, source: np.ndarray, at: np.ndarray, size: np.ndarray | None = None) -> np.ndarray:
    """(first, windows) of maximal runs whose next match is the next word of the same source; matches are sorted by document and place."""
    if not len(doc):
        return np.zeros((0, 2), np.int64)
    size = np.ones(len(doc), np.int64) if size is None else size
    follows = (doc[1:] == doc[:-1]) & (place[1:] == place[:-1] + size[:-1]) & (source[1:] == source[:-1]) & (at[1:] == at[:-1] + size[:-1])
    first = np.flatnonzero(np.append(True, ~follows))
    return np.stack([first, np.add.reduceat(size, first)], axis=1)


def parse(runs: np.ndarray, window: int) -> list[tuple[int, int, int, int]]:
    """The factors (first word, end, source id, first word there) of a document from its matches (``RUN``), in order."""
    runs = runs[np.argsort(runs["first"], kind="stable")]
    place, size, at = (runs[c].astype(np.int64) for c in ("first", "windows", "at"))
    source = runs["key"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ runs["id"].astype(np.uint64)
    ids = (runs["id"].astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)
    return [(int(place[k]), int(place[k]) + int(n) + window - 1, int(ids[k]), int(at[k])) for k, n in _runs(np.zeros(len(runs), int), place, source, at, size)]


def _keep(window: int):
    """(row, text, source of a whole copy, matches) -> (row, result): the words that stay, and the factors that go."""

    def run(batches):
        for batch in batches:
            copy = batch.column(2).to_pylist()
            found = batch.column(3).to_pylist()
            n_words, n_removed, kept, factors = [], [], [], []
            for i, j, data, offsets in slices(batch.column(1)):
                words = Words(data, offsets)
                for d in range(j - i):
                    a, b = int(words.at[d]), int(words.at[d + 1])
                    if copy[i + d] is not None and b - a >= window:
                        cuts = [(0, b - a, copy[i + d], 0)]
                    else:
                        cuts = parse(np.unique(np.frombuffer(b"".join(found[i + d] or []), RUN)), window)
                    stay, at, gone = [], 0, 0
                    for first, end, _, _ in cuts:
                        if first > at:
                            stay.append(b" ".join(words.data[words.start[a + at] : words.end[a + first - 1]].tobytes().split()))
                        gone += max(0, end - max(at, first))
                        at = max(at, end)
                    if at < b - a:
                        stay.append(b" ".join(words.data[words.start[a + at] : words.end[b - 1]].tobytes().split()))
                    n_words.append(b - a)
                    n_removed.append(gone)
                    kept.append(b" ".join(stay).decode())
                    factors.append([dict(zip(("first", "end", "source", "at"), c)) for c in cuts])
            shape = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("source", pa.int64()), ("at", pa.int32())]))
            result = pa.StructArray.from_arrays(
                [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()), pa.array(factors, shape)],
                names=["n_words", "n_removed", "kept_text", "factors"],
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), result], names=["row", "result"])

    return run


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, result: str = "dedup"
) -> DataFrame:
    """Every row of ``docs`` without its text, and a struct ``result`` of n_words, n_removed, kept_text and factors."""
    if result.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"there is a column {result} already")
    own = [c for c in docs.columns if c.lower() != text_col.lower()]
    texts = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in own)).alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
    ).withColumn("sha", F.sha2(F.coalesce("text", F.lit("")), 256))
    texts = texts.withColumn("k", F.unhex(F.lpad(F.hex(F.xxhash64("id", "sha")), 16, "0")))
    order = F.struct(F.coalesce("id", F.lit(-(1 << 63))).alias("id"), "k")
    first = texts.groupBy("sha").agg(F.min(order).alias("f"), F.max("k").alias("hi"), F.min("k").alias("lo"), F.count("*").alias("n"))
    several = checkpoint(first.where("lo < hi").select("sha", "f", "n"))
    shas = texts.select("k", "sha")
    copies = checkpoint(hot_join(shas, several, ["sha"], "n", "k").where("k <> f.k").select("k", F.col("f.id").alias("copy")).distinct())
    # every use below reads the same columns of this exchange, and asks nothing of a key before it, so Spark shuffles the texts once
    keyed = texts.select("k", "text", "id", "row").where("k is not null").repartition("k").join(copies, "k", "left")
    alone = keyed.where("copy is null").select("k", "text", "id", "row")
    # all that later joins ask of a row is asked before the exchange, and ``met`` only in conditions that can't be pushed below it
    key = "if(met, substring(place, 1, 8), substring(place, 9, 8))"
    solid = f"h is not null and g is not null and {key} is not null"
    index = alone.mapInArrow(_index(window, gram), FOUND).where(solid).repartition("h", "g")
    asks = F.expr("if(met, null, place)")
    spread = [F.min(asks).alias("e"), F.max(asks).alias("l")]
    # a row that is there twice is one document: the same place twice is no repeat
    many = index.groupBy("h", "g").agg(*spread).where("e < l").select("h", "g", F.lit(True).alias("hot"))
    anchors = (
        index.join(many, ["h", "g"], "left")
        .where("met or hot")
        .select(F.expr(key).alias("k"), F.expr("if(met, substring(place, 9), substring(place, 17))").alias("at"))
        .groupBy("k")
        .agg(F.collect_set("at").alias("anchors"))
    )
    windows = alone.join(anchors, "k").select("k", "text", "id", "row", "anchors").mapInArrow(_windows(window, gram), FOUND).where(solid).repartition("h", "g")
    earliest = windows.groupBy("h", "g").agg(*spread).where("e < l").select("h", "g", "e")
    matches = (
        windows.join(earliest, ["h", "g"], "left")
        .where("met or place > e")
        .select(
            F.expr(key).alias("k"),
            F.expr("if(met, substring(place, 9), concat(substring(place, 17), X'00000001', e))").alias("run"),
        )
        .groupBy("k")
        .agg(F.collect_set("run").alias("runs"))
    )
    shape = "struct<n_words:bigint,n_removed:bigint,kept_text:string,factors:array<struct<first:int,end:int,source:bigint,at:int>>>"
    kept = keyed.join(matches, "k", "left").select("row", "text", "copy", "runs", "k", "id")
    kind = docs.select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("row")).schema["row"].dataType.simpleString()
    return kept.mapInArrow(_keep(window), f"row {kind}, result {shape}").select("row.*", F.col("result").alias(result))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: 20-word windows over every text of ``documents``."""
    out = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "dedup.n_words", "dedup.n_removed", F.sha2("dedup.kept_text", 256).alias("kept_sha256"))
