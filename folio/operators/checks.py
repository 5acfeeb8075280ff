"""Page detectors, verdict checks, samples and keyed lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from folio.functions import text as T

CAPITALS = r"\p{Lu}[\p{L}]{3,}"


def even_sample(df: DataFrame, key: str, order: list[str], k: int) -> DataFrame:
    """Of a key's ``n`` rows in order those at ``int(i * n / k)`` for i below ``k``; all of them if there are fewer."""
    rank = F.row_number().over(W.partitionBy(key).orderBy(*order)) - 1
    at = df.withColumns({"r": rank, "n": F.count("*").over(W.partitionBy(key))}).withColumn("i", F.expr(f"(r * {k} + n - 1) div n"))
    return at.where(f"i < {k} and (i * n) div {k} = r").drop("i", "n")


def with_neighbours(sentences: DataFrame) -> DataFrame:
    """Each sentence with the one before and the one after it."""
    w = W.partitionBy("section_id").orderBy("i")
    return sentences.withColumn("context", F.concat_ws(" ", F.lag("sentence").over(w), "sentence", F.lead("sentence").over(w)))


def window_around(text: Column, word: str, radius: int) -> Column:
    """``radius`` characters to either side of the first place of ``word``; null where it isn't found."""
    at = F.locate(word, text)
    first = F.greatest(F.lit(1), at - radius)
    return F.when(at > 0, F.substring(text, first, at + len(word) + radius - first))


def weighted_type(df: DataFrame, key: str, kind: str, weight: str) -> DataFrame:
    """The kind with the greatest sum of weights; of equal ones the first by name."""
    per = df.groupBy(key, kind).agg(F.sum(weight).alias("w"))
    by = W.partitionBy(key).orderBy(F.desc("w"), kind)
    return per.withColumn("r", F.row_number().over(by)).where("r = 1").select(key, kind, "w")


def rewrite_pairs(edges: DataFrame, owner: DataFrame) -> DataFrame:
    """(a, b, n) with names replaced by their owner (name, owner): self pairs go, counts of equal pairs are added."""
    o = lambda end: owner.select(F.col("name").alias(end), F.col("owner").alias(f"o{end}"))
    mapped = edges.join(o("a"), "a", "left").join(o("b"), "b", "left").select(F.coalesce("oa", "a").alias("x"), F.coalesce("ob", "b").alias("y"), "n")
    return mapped.where("x <> y").groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.sum("n").alias("n"))


def value_at_share(df: DataFrame, key: str, value: str, share: float) -> DataFrame:
    """The value at index ``max(0, int(n * share) - 1)`` of a key's ascending values: one below the usual discrete percentile."""
    ranked = df.withColumns({"r": F.row_number().over(W.partitionBy(key).orderBy(value)) - 1, "n": F.count("*").over(W.partitionBy(key))})
    return ranked.where(F.col("r") == F.greatest(F.lit(0), F.floor(F.col("n") * F.lit(share)) - 1)).select(key, F.col(value).alias("value"), "n")


def corrected(entities: DataFrame, corrections: DataFrame) -> DataFrame:
    """(entity, alias, kind): the kind that (name, kind) gives the entity's name, else its alias, else its own."""
    fix = lambda on: corrections.select(F.col("name").alias(on), F.col("kind").alias(f"by_{on}"))
    out = entities.join(fix("entity"), "entity", "left").join(fix("alias"), "alias", "left")
    return out.select("entity", "alias", F.coalesce("by_entity", "by_alias", "kind").alias("kind"))


def ungrounded(texts: DataFrame, sources: DataFrame, key: str, k: int) -> DataFrame:
    """The first ``k`` capitalised words of a text, in order, that no source holds as a capitalised word."""
    words = lambda df: F.posexplode(F.array_distinct(F.regexp_extract_all("text", F.lit(CAPITALS), F.lit(0))))
    known = sources.select(words(sources).alias("at", "word")).select("word").distinct()
    missing = texts.select(key, words(texts).alias("at", "word")).join(known, "word", "left_anti")
    by = W.partitionBy(key).orderBy("at")
    return missing.withColumn("r", F.row_number().over(by)).where(f"r <= {k}").select(key, F.col("r").cast("long").alias("r"), "word")


def quoted(verdicts: DataFrame, snippets: DataFrame, key: str) -> DataFrame:
    """Verdicts (key, quote) whose folded quote stands in a snippet (key, snippet) of the same key; blank quotes never do."""
    q = verdicts.withColumn("q", T.fold(F.col("quote"))).where("q <> ''")
    return q.join(snippets.select(key, T.fold(F.col("snippet")).alias("s")), key).where(F.col("s").contains(F.col("q"))).select(key, "quote").distinct()


def page_codes(rules: dict[str, Column]) -> Column:
    """The codes of the rules that hold, in the rules' order, joined by commas."""
    return F.concat_ws(",", *(F.when(rule, F.lit(code)) for code, rule in rules.items()))


def same_name(pages: DataFrame, name: Column) -> DataFrame:
    """Names that several pages would be filed under."""
    return pages.groupBy(name.alias("file")).agg(F.count("*").alias("n")).where("n > 1")


def batches(df: DataFrame, key: str, order: str, size: str, most: int, limit: int) -> DataFrame:
    """Items of a key dealt in order to batches of ``most`` items and ``limit`` characters; a larger item is a batch alone.

    A key's items (a tier's pages) are folded in one array, so a key has to be bounded: id and size of each.
    """
    items = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).cast("long").alias("id"), F.col(size).cast("long").alias("size")))).alias("items"))
    fold = f"""aggregate(items, cast(array() as array<struct<id: bigint, batch: int, n: int, used: bigint>>), (done, x) -> concat(done, array(
        if(size(done) = 0, named_struct('id', x.id, 'batch', 1, 'n', 1, 'used', x.size),
        if(element_at(done, -1).n >= {most} or element_at(done, -1).used + x.size > {limit},
            named_struct('id', x.id, 'batch', element_at(done, -1).batch + 1, 'n', 1, 'used', x.size),
            named_struct('id', x.id, 'batch', element_at(done, -1).batch, 'n', element_at(done, -1).n + 1, 'used', element_at(done, -1).used + x.size))))))"""
    return items.select(key, F.explode(F.expr(fold)).alias("x")).select(key, F.col("x.id").alias("id"), F.col("x.batch").alias("batch"))
