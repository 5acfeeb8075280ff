"""Co-occurrence and relation graphs."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from folio.functions import text as T
from folio.sources.tables import shared_folder


def sentence_table(sections: DataFrame) -> DataFrame:
    """(book, section_id, lang, i, sentence): one row a sentence."""
    return sections.select("book", "section_id", "lang", F.posexplode(T.sentences(F.col("content"))).alias("i", "sentence"))


def roster(sections: DataFrame, floor: int, least: int = 6) -> DataFrame:
    """(name, n): every token of at least ``least`` characters with ``floor`` mentions or more. It grows with the texts."""
    words = sections.select(F.explode(T.tokens(F.col("content"))).alias("name")).where(f"length(name) >= {least}")
    return words.groupBy("name").agg(F.count("*").alias("n")).where(f"n >= {floor}")


def hits(sections: DataFrame, names: DataFrame) -> DataFrame:
    """(section_id, i, name): which sentences hold which name, counted once. How to join is left to the roster's size at run time."""
    words = sentence_table(sections).select("book", "section_id", "i", F.explode(F.array_distinct(T.tokens(F.col("sentence")))).alias("name"))
    return words.join(names.select("name"), "name")


def cooccurrence(found: DataFrame, window: int, threshold: int, min_sections: int) -> DataFrame:
    """Pairs by the number of sentence windows that hold both; a window starts at every sentence and shrinks at the end.

    Starts are exploded from hits, so only sentences with names cost anything, and pairs meet within one section.
    """
    starts = found.select("section_id", F.explode(F.expr(f"sequence(greatest(0, i - {window - 1}), i)")).alias("start"), "name").distinct()
    bags = starts.groupBy("section_id", "start").agg(F.array_sort(F.collect_set("name")).alias("names")).where("size(names) > 1")
    pairs = bags.select("section_id", F.posexplode("names").alias("at", "a"), "names").select(
        "section_id", "a", F.explode(F.expr("slice(names, at + 2, size(names))")).alias("b")
    )
    # first within a section, then over sections: partial sums before the shuffle by pair
    per = pairs.groupBy("a", "b", "section_id").agg(F.count("*").alias("n"))
    return per.groupBy("a", "b").agg(F.sum("n").alias("windows"), F.count("*").alias("sections")).where(f"windows >= {threshold} and sections >= {min_sections}")


def free_hits(sections: DataFrame, names: DataFrame) -> DataFrame:
    """(section_id, i, name, sentence): names in sentences but for those right after "of ", which belong to an artefact."""
    free = F.regexp_extract_all(F.lower("sentence"), F.lit(r"(?<!of )(?<![\p{L}\p{N}_])[\p{L}\p{N}_]+"), F.lit(0))
    words = sentence_table(sections).select("section_id", "i", "sentence", F.explode(F.array_distinct(free)).alias("name"))
    return words.join(names.select("name"), "name")


def near_pairs(found: DataFrame, negations: str | None) -> DataFrame:
    """(section_id, a, b, lo, gap, span): pairs of names in one sentence or in neighbours; spans that deny a relation are no context.

    A row joins its own sentence and the next one, so only neighbours meet.
    """
    x = found.select("section_id", F.col("i").alias("lo"), F.col("name").alias("n1"), F.col("sentence").alias("s1"))
    y = found.select("section_id", "i", F.col("name").alias("n2"), F.col("sentence").alias("s2")).withColumn("lo", F.explode(F.array("i", F.col("i") - 1)))
    clean = F.lit(True)
    if negations is not None:  # settled once a sentence and not for every pair
        x = x.join(_clean_spans(found, negations), ["section_id", "lo"])
        clean = F.when(F.col("i") == F.col("lo"), F.col("alone")).otherwise(F.col("with_next"))
    met = x.join(y, ["section_id", "lo"]).where("n1 <> n2 and (i > lo or n1 < n2)").where(clean)
    span = F.when(F.col("i") == F.col("lo"), F.col("s1")).otherwise(F.concat_ws(" ", "s1", "s2"))
    return met.select("section_id", F.least("n1", "n2").alias("a"), F.greatest("n1", "n2").alias("b"), "lo", (F.col("i") - F.col("lo")).alias("gap"), span.alias("span"))


def _clean_spans(found: DataFrame, negations: str) -> DataFrame:
    """(section_id, lo, alone, with_next): whether a sentence denies no relation, by itself and together with the next one."""
    sentences = found.groupBy("section_id", F.col("i").alias("lo")).agg(F.min("sentence").alias("sentence"))
    by = W.partitionBy("section_id").orderBy("lo")
    following = F.when(F.lead("lo").over(by) == F.col("lo") + 1, F.lead("sentence").over(by))
    denied = lambda x: F.lower(x).rlike(negations)
    return sentences.withColumn("next", following).select("section_id", "lo", (~denied(F.col("sentence"))).alias("alone"), (~denied(F.concat_ws(" ", "sentence", "next"))).alias("with_next"))


BROADCAST_NAMES = 1_000_000  # a larger roster is joined by a shuffle; the result is the same
PAIR_ROWS = 1 << 18


def _closest(rows: list[dict], denied) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Of a section's hits by sentence (i, sentence, names): (names, a, b, span, spans) with the closest context of each pair, the first of several."""
    rows = sorted(rows, key=lambda r: (r["i"], r["sentence"]))
    known = sorted({x for r in rows for x in r["names"]}, key=str.encode)
    rank = {x: k for k, x in enumerate(known)}
    own = [np.array([rank[x] for x in r["names"]], np.int64) for r in rows]
    at: dict[int, list[int]] = {}
    for k, r in enumerate(rows):
        at.setdefault(r["i"], []).append(k)
    keys, which, spans = [], [], []
    for gap in (0, 1):  # so that the first place of a pair is its closest one
        for i, left in at.items():
            for x in left:
                for y in at.get(i + gap, ()):
                    span = rows[x]["sentence"] + (" " + rows[y]["sentence"] if gap else "")
                    if denied and denied.search(span.lower()):
                        continue
                    u, v = np.repeat(own[x], len(own[y])), np.tile(own[y], len(own[x]))
                    some = u != v if gap else u < v
                    keys.append((np.minimum(u, v) * len(known) + np.maximum(u, v))[some])
                    which.append(np.full(len(keys[-1]), len(spans)))
                    spans.append((gap, span))
    if not keys:
        return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), []
    key, first = np.unique(np.concatenate(keys), return_index=True)
    return pa.array(known, pa.string()), key // len(known), key % len(known), np.concatenate(which)[first], spans


def _closest_rows(negations: str | None, digest: bool):
    def run(batches):
        denied = re.compile(negations) if negations is not None else None
        kind = None
        held, size = [], 0

        def report():
            columns = [pa.concat_arrays([h[k] for h in held]) for k in range(len(held[0]))]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=["section_id", "a", "b", "gap", *["digest"] * digest])

        for batch in batches:
            kind = batch.column(0).type
            for k in range(batch.num_rows):
                texts = {(r["i"], r["h"]): r["sentence"] for r in batch.column(2)[k].as_py()}
                names: dict = {}
                for r in batch.column(1)[k].as_py():
                    names.setdefault((r["i"], r["h"]), []).append(r["name"])
                known, a, b, which, spans = _closest([{"i": i, "sentence": texts[i, h], "names": x} for (i, h), x in names.items()], denied)
                if not len(a):
                    continue
                gaps = pa.array([g for g, _ in spans], pa.int32()).take(pa.array(which))
                digests = [pa.array([hashlib.md5(t.encode()).hexdigest() for _, t in spans]).take(pa.array(which))] if digest else []
                held.append([pa.array([batch.column(0)[k].as_py()], kind).take(pa.array(np.zeros(len(a), np.int64))), known.take(pa.array(a)), known.take(pa.array(b)), gaps, *digests])
                size += len(a)
                if size >= PAIR_ROWS:
                    yield report()
                    size = 0
        if held:
            yield report()

    return run


def closest_pairs(sections: DataFrame, names: DataFrame, negations: str | None, digest: bool = True) -> DataFrame:
    """(section_id, a, b, gap, digest): ``tightest`` of ``near_pairs`` of ``free_hits``, with the span's md5 for the span.

    A sentence's text travels once, with its section, and not with every name and pair; pairs are made where the section lies
    and are not dealt out again. ``negations`` is in the syntax that Java and Python share.
    """
    shared_folder(sections.sparkSession)
    names = names.select("name").distinct().checkpoint()
    names = F.broadcast(names) if names.count() <= BROADCAST_NAMES else names
    free = F.regexp_extract_all(F.lower("sentence"), F.lit(r"(?<!of )(?<![\p{L}\p{N}_])[\p{L}\p{N}_]+"), F.lit(0))
    texts = sentence_table(sections).where("section_id is not null").select("section_id", "i", F.xxhash64("sentence").alias("h"), "sentence")
    found = texts.select("section_id", "i", "h", F.explode(F.array_distinct(free)).alias("name")).join(names, "name")
    hits_ = found.groupBy("section_id").agg(F.collect_set(F.struct("i", "h", "name")).alias("hits"))
    own = texts.groupBy("section_id").agg(F.collect_set(F.struct("i", "h", "sentence")).alias("texts"))
    kind = sections.schema["section_id"].dataType.simpleString()
    return hits_.join(own, "section_id").select("section_id", "hits", "texts").mapInArrow(_closest_rows(negations, digest), f"section_id {kind}, a string, b string, gap int" + ", digest string" * digest)


def tightest(contexts: DataFrame) -> DataFrame:
    """A section's closest context of a pair, the first of several."""
    return contexts.groupBy("section_id", "a", "b").agg(F.min(F.struct("gap", "lo", "span")).alias("c")).select("section_id", "a", "b", "c.gap", "c.span")


def sample_contexts(contexts: DataFrame, n: int) -> DataFrame:
    """Of ``contexts(section_id, a, b, gap)`` up to ``n`` a pair at the places int(i * size / n): gap 0 first, gap 1 fills up."""
    own = W.partitionBy("a", "b", "gap")
    rows = contexts.withColumns({"r": F.row_number().over(own.orderBy("section_id")) - 1, "size": F.count("*").over(own), "same": F.count(F.expr("if(gap = 0, 1, null)")).over(W.partitionBy("a", "b"))})
    rows = rows.withColumn("k", F.when(F.col("gap") == 0, n).otherwise(n - F.least(F.lit(n), "same"))).where("k > 0")
    i = F.ceil(F.col("r") * F.col("k") / F.col("size"))
    return rows.where((F.col("size") <= F.col("k")) | ((F.floor(i * F.col("size") / F.col("k")) == F.col("r")) & (i < F.col("k"))))


def with_context(pairs: DataFrame, contexts: DataFrame) -> DataFrame:
    """Only pairs that have a context, with the number of sections that give one."""
    return pairs.join(contexts.groupBy("a", "b").agg(F.count_distinct("section_id").alias("contexts")), ["a", "b"])


def unordered(df: DataFrame, a: str = "src", b: str = "dst") -> DataFrame:
    """Pairs in one order, with the direction turned where they were swapped."""
    return df.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), F.when(F.col(a) < F.col(b), "a->b").otherwise("b->a").alias("direction"), *[c for c in df.columns if c not in (a, b)])


def fold(edges: DataFrame) -> DataFrame:
    """One row a pair: counts add up, volumes unite, a type stays only if all agree."""
    return edges.groupBy("a", "b").agg(
        F.count("*").alias("n"),
        F.array_sort(F.collect_set("volume")).alias("volumes"),
        F.when(F.count_distinct("type") == 1, F.max("type")).alias("type"),
        F.when(F.count_distinct("direction") == 1, F.max("direction")).alias("direction"),
    )


def vote(edges: DataFrame, order: list[str]) -> DataFrame:
    """Majority type and direction of a pair; a tie goes to what was seen first."""
    def top(column: str, name: str) -> DataFrame:
        n = edges.groupBy("a", "b", column).agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("first"))
        by = W.partitionBy("a", "b").orderBy(F.desc("n"), "first", column)
        return n.withColumn("r", F.row_number().over(by)).where("r = 1").select("a", "b", F.col(column).alias(name), F.col("n").alias(f"{name}_votes"))

    return top("type", "top_type").join(top("direction", "top_direction"), ["a", "b"])


def merge_volumes(edges: DataFrame) -> DataFrame:
    """The series graph from per-volume deltas: counts add up, the first volume's type fills in, weights by volume."""
    per = edges.groupBy("a", "b", "volume").agg(F.count("*").alias("n"), F.min_by("type", F.struct("chunk", "seq", "type")).alias("type"))
    return per.groupBy("a", "b").agg(
        F.sum("n").alias("n"), F.min_by("type", "volume").alias("type"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("volume", "n")))).alias("weights")
    )


def direct(graph: DataFrame, node) -> DataFrame:
    """Edges of a node, from either end."""
    return graph.where((F.col("a") == node) | (F.col("b") == node)).withColumn("other", F.when(F.col("a") == node, F.col("b")).otherwise(F.col("a")))


def indirect(graph: DataFrame, least: float = 0.1) -> DataFrame:
    """Two-hop relations of pairs without an edge: strength is the product of counts over the largest count; the strongest path."""
    top = graph.agg(F.max("n").alias("top"))
    both = graph.select("a", "b", "n", "type").union(graph.select(F.col("b").alias("a"), F.col("a").alias("b"), "n", "type")).where("type is not null")
    one = both.select(F.col("a").alias("x"), F.col("b").alias("via"), F.col("n").alias("n1"), F.col("type").alias("t1"))
    two = both.select(F.col("a").alias("via"), F.col("b").alias("y"), F.col("n").alias("n2"), F.col("type").alias("t2"))
    paths = one.join(two, "via").where("x < y").join(graph.select(F.col("a").alias("x"), F.col("b").alias("y")), ["x", "y"], "left_anti")
    paths = paths.join(F.broadcast(top)).withColumn("strength", F.col("n1") * F.col("n2") / (F.col("top").cast("double") * F.col("top"))).where(f"strength >= {least}")
    by = W.partitionBy("x", "y").orderBy(F.desc("strength"), "via")
    return paths.withColumn("r", F.row_number().over(by)).where("r = 1").select("x", "y", "via", "t1", "t2", "strength")


def weighted_degree(graph: DataFrame) -> DataFrame:
    ends = graph.select(F.col("a").alias("node"), "n").union(graph.select("b", "n"))
    return ends.groupBy("node").agg(F.count("*").alias("degree"), F.sum("n").alias("weight"))


def delta(old: DataFrame, new: DataFrame) -> DataFrame:
    """Added, removed and reweighted edges between two graphs (a, b, n)."""
    o, n = old.select("a", "b", F.col("n").alias("was")), new.select("a", "b", F.col("n").alias("now"))
    both = o.join(n, ["a", "b"], "full_outer")
    change = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("was") != F.col("now"), "reweighted")
    return both.withColumn("change", change).where("change is not null").select("a", "b", "change", "was", "now")
