"""Notability, summaries, events, copy checks, verdict snippets, bundles and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from folio.functions import text as T
from folio.operators.graph import sentence_table

CUES = ("then", "suddenly", "finally", "ensuite", "enfin", "dann", "entonces")
FIRST_PERSON = ("i", "me", "my", "je", "moi", "ich", "mir", "yo")


def rate(tokens, words: tuple[str, ...]):
    return F.size(F.filter(tokens, lambda w: w.isin(*words))) / F.greatest(F.size(tokens), F.lit(1))


def point_of_view(sections: DataFrame) -> DataFrame:
    """Share of first-person words in a section, and the voice that it speaks for."""
    out = sections.withColumn("first_share", rate(T.tokens(F.col("content")), FIRST_PERSON))
    voice = F.when(F.col("first_share") > 0.05, "first").when(F.col("first_share") > 0.01, "first_weak").otherwise("third")
    return out.select("book", "section_id", "first_share", voice.alias("pov"))


def modal(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """The commonest value of each key; a tie goes to the one met first."""
    n = df.groupBy(key, value).agg(F.count("*").alias("n"), F.min(order).alias("at"))
    return n.groupBy(key).agg(F.max_by(value, F.struct("n", -F.col("at"))).alias(value), F.max("n").alias("n"))


def narrative_position(sections: DataFrame, least: int) -> DataFrame:
    """Sections of at least ``least`` characters numbered from 1 in their book; the others get no number."""
    counted = F.when(F.length("content") >= least, 1).otherwise(0)
    running = F.sum(counted).over(W.partitionBy("book").orderBy("section_id").rowsBetween(W.unboundedPreceding, 0))
    return sections.select("book", "section_id", F.when(counted == 1, running).alias("number"))


def tiers(entities: DataFrame, shares: tuple[float, ...] = (0.9, 0.6, 0.1), least: int = 4, fixed: tuple[int, ...] = (20, 10, 3)) -> DataFrame:
    """(entity, kind, n) -> importance by the counts of the kind: the value at index max(0, int(size * share) - 1)."""
    ranked = entities.withColumns({"r": F.row_number().over(W.partitionBy("kind").orderBy("n", "entity")) - 1, "size": F.count("*").over(W.partitionBy("kind"))})
    at = [F.max(F.when(F.col("r") == F.greatest(F.lit(0), F.floor(F.col("size") * F.lit(p)) - 1), F.col("n"))) for p in shares]
    marks = ranked.groupBy("kind").agg(F.max("size").alias("size"), *(x.alias(f"t{k}") for k, x in enumerate(at)))
    marks = marks.select("kind", *(F.when(F.col("size") < least, F.lit(f)).otherwise(F.col(f"t{k}")).alias(f"t{k}") for k, f in enumerate(fixed)))
    word = F.when(F.col("n") >= F.col("t0"), "principal").when(F.col("n") >= F.col("t1"), "secondary").when(F.col("n") >= F.col("t2"), "figurant").otherwise("ignored")
    return entities.join(marks, "kind").select("entity", "kind", "n", word.alias("importance"))


def summaries(sections: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` best sentences of a section in text order: scored by distinct words, place and cue words; noise is left out."""
    s = sentence_table(sections).withColumn("t", T.tokens(F.col("sentence")))
    last = F.max("i").over(W.partitionBy("section_id"))
    s = s.withColumn("last", last).where("length(sentence) between 25 and 320 and length(regexp_replace(sentence, '[^\\\\p{L}]', '')) >= 12")
    cues = F.size(F.filter("t", lambda w: w.isin(*CUES)))
    score = F.size(F.array_distinct("t")) / F.greatest(F.size("t"), F.lit(1)) + 0.25 * F.col("i") / F.greatest("last", F.lit(1)) + 0.15 * cues
    top = s.withColumn("score", score).withColumn("r", F.row_number().over(W.partitionBy("section_id").orderBy(F.desc("score"), "i"))).where(f"r <= {k}")
    return top.select("section_id", F.row_number().over(W.partitionBy("section_id").orderBy("i")).alias("bullet"), "i", "sentence")


def top_events(events: DataFrame, k: int) -> DataFrame:
    """The ``k`` events of a type and day with the highest value, in time order, each with its rank."""
    day = events.withColumn("day", F.to_date("ts"))
    by = W.partitionBy("event_type", "day").orderBy(F.desc("value"), "event_id")
    return day.withColumn("rank", F.row_number().over(by)).where(f"rank <= {k}").select("event_type", "day", "rank", "event_id", "value")


def neighbours(turns: DataFrame, k: int) -> DataFrame:
    """Up to ``k`` turns before and after each turn of a conversation, as lengths."""
    w = W.partitionBy("conv_id").orderBy("turn")
    size = F.length("text")
    return turns.select(
        "conv_id", "turn", F.sum(size).over(w.rowsBetween(-k, -1)).alias("before"), F.sum(size).over(w.rowsBetween(1, k)).alias("after")
    )


def carry_forward(turns: DataFrame, silence: int) -> DataFrame:
    """The last speaker of role 'user' at each turn, forgotten after ``silence`` turns."""
    w = W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, 0)
    last = F.last(F.when(F.col("role") == "user", F.col("turn")), ignorenulls=True).over(w)
    return turns.select("conv_id", "turn", F.when(F.col("turn") - last <= silence, last).alias("anchor"))


def latest_snippets(events: DataFrame, marker: str, k: int) -> DataFrame:
    """Per user ``k`` events: those of the marker's type first, the latest first within both."""
    marked = (F.col("event_type") == marker).cast("int")
    by = W.partitionBy("user_id").orderBy(marked.desc(), F.desc("ts"), "event_id")
    return events.withColumn("r", F.row_number().over(by)).where(f"r <= {k}").select("user_id", "r", "event_id", "event_type")


def capped_prefix(df: DataFrame, key: str, order: list[str], size: str, limit: int) -> DataFrame:
    """Rows of a key in order up to the first that would pass ``limit``; it and all after it go."""
    w = W.partitionBy(key).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("used", F.sum(size).over(w)).where(f"used <= {limit}")


def grams(df: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """(key, at, gram): every run of ``n`` tokens."""
    t = df.select(key, T.tokens(F.coalesce(F.col(text), F.lit(""))).alias("t")).where(f"size(t) >= {n}")
    return t.select(key, F.posexplode(F.expr(f"transform(sequence(1, size(t) - {n - 1}), k -> array_join(slice(t, k, {n}), ' '))")).alias("at", "gram"))


def copied_runs(pages: DataFrame, sources: DataFrame, page: str, source: str, n: int) -> DataFrame:
    """Maximal runs of ``n``-grams of a page that are in a source: start, words, and the first source of the first gram.

    Only the sources' grams are indexed and the pages' joined to them by hash; a gram is read once. Runs are islands of
    consecutive hits, and a start inside a run never opens another.
    """
    index = grams(sources, source, "text", n).groupBy("gram").agg(F.min(F.struct(source, "at")).alias("s"))
    hit = grams(pages, page, "text", n).join(index, "gram").select(page, "at", F.col(f"s.{source}").alias("source"))
    island = hit.withColumn("g", F.col("at") - F.row_number().over(W.partitionBy(page).orderBy("at")))
    return island.groupBy(page, "g").agg(F.min("at").alias("start"), (F.count("*") + n - 1).alias("words"), F.min_by("source", "at").alias("source")).drop("g")


def confusion(gold: DataFrame, predicted: DataFrame, key: str) -> DataFrame:
    """Counts of (true, predicted); a missing prediction counts as null."""
    both = gold.join(predicted, key, "left")
    return both.groupBy("truth", "guess").agg(F.count("*").alias("n"))


def class_scores(table: DataFrame) -> DataFrame:
    """Precision, recall and F1 of each label from confusion counts."""
    labels = table.select(F.col("truth").alias("label")).union(table.select("guess")).where("label is not null").distinct()
    joined = labels.join(table, (F.col("label") == F.col("truth")) | (F.col("label") == F.col("guess")))
    s = joined.groupBy("label").agg(
        F.sum(F.expr("if(truth = label and guess = label, n, 0)")).alias("tp"),
        F.sum(F.expr("if(guess = label, n, 0)")).alias("p"),
        F.sum(F.expr("if(truth = label, n, 0)")).alias("t"),
    )
    return s.select(
        "label", "tp", F.expr("if(p = 0, 0D, tp / p)").alias("precision"), F.expr("if(t = 0, 0D, tp / t)").alias("recall"), F.expr("if(p + t = 0, 0D, 2 * tp / (p + t))").alias("f1")
    )


def exact_split(df: DataFrame, key: str, share: float) -> DataFrame:
    """A reproducible split with an exact size: ids by hash, the first round(n * share) are held out."""
    n = df.count()
    held = df.select(key).orderBy(F.md5(F.col(key).cast("string")), key).limit(round(n * share)).withColumn("dev", F.lit(True))
    return df.select(key).join(held, key, "left").select(key, F.coalesce("dev", F.lit(False)).alias("dev"))


def field_report(events: DataFrame, column: str) -> DataFrame:
    """Keys of a JSON column: rows that hold it, share of all rows, distinct values, and whether it looks like an enumeration."""
    total = events.agg(F.count("*").alias("total"))
    pairs = events.select(F.explode(F.from_json(column, "map<string,string>")).alias("field", "value"))
    per = pairs.groupBy("field").agg(F.count("*").alias("rows"), F.count_distinct("value").alias("values"))
    return per.join(F.broadcast(total)).select("field", "rows", "values", (F.col("rows") / F.col("total")).alias("share"), F.expr("values <= 12 and rows >= 5").alias("is_enum"))


def centroids(vectors: DataFrame) -> DataFrame:
    """Mean vector of each label, one row a dimension."""
    return vectors.select("label", F.posexplode("embedding").alias("dim", "x")).groupBy("label", "dim").agg(F.avg(F.col("x").cast("double")).alias("mean"))


def centroid_cosines(vectors: DataFrame) -> DataFrame:
    c = centroids(vectors)
    norm = c.groupBy("label").agg(F.sqrt(F.sum(F.col("mean") * F.col("mean"))).alias("norm"))
    a, b = (c.join(norm, "label").select(F.col("label").alias(x), "dim", (F.col("mean") / F.col("norm")).alias(f"u{x}")) for x in ("a", "b"))
    return a.join(b, "dim").where("a < b").groupBy("a", "b").agg(F.sum(F.col("ua") * F.col("ub")).alias("cosine"))


def span_scores(gold: DataFrame, found: DataFrame) -> DataFrame:
    """Spans (key, start, end) by overlap: recall counts gold spans that are met, precision found spans that are."""
    g, f = gold.alias("g"), found.alias("f")
    overlap = F.expr("g.key = f.key and g.start < f.end and f.start < g.end")
    met = g.join(f, overlap, "left_semi").agg(F.count("*").alias("gold_met"))
    good = f.join(g, overlap, "left_semi").agg(F.count("*").alias("found_good"))
    sizes = gold.agg(F.count("*").alias("gold")).join(found.agg(F.count("*").alias("found")))
    return sizes.join(met).join(good)
