"""Summaries and events: sentence scores, salience, selections, collation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def noisy(sentence: Column) -> Column:
    """Under 25 or over 320 characters, or with fewer than 12 letters."""
    s = F.trim(sentence)
    return (F.length(s) < 25) | (F.length(s) > 320) | (F.length(F.regexp_replace(s, r"[^\p{L}]", "")) < 12)


def dialogue_heavy(sentence: Column) -> Column:
    """Starts with a quote, or over a twentieth of it is quotes."""
    s = F.trim(sentence)
    quotes = F.length(s) - F.length(F.translate(s, "\"'“”", ""))
    return (s != "") & (F.substring(s, 1, 1).isin("“", '"', "'") | (quotes > 0.05 * F.length(s)))


def sentence_score(sentence: Column, index: Column, total: Column, cues: list[str], bonus: Column) -> Column:
    """Capitals twice, variety, a little for being early, cues and named entities, less for dialogue; null without a token."""
    tokens = F.regexp_extract_all(sentence, F.lit("([A-Za-zÀ-ÿ']+)"), F.lit(1))
    n = F.size(tokens)
    proper = F.size(F.filter(tokens, lambda t: t.rlike(r"^\p{Lu}")))
    unique = F.size(F.array_distinct(F.transform(tokens, F.lower)))
    cue = sum((F.when(F.lower(sentence).contains(c), 0.15).otherwise(0.0) for c in cues), F.lit(0.0))
    early = F.greatest(F.lit(0.0), 1 - index / F.greatest(total, F.lit(1)))
    return F.when(n > 0, 2.0 * proper / n + unique / n + 0.25 * early + cue + bonus - F.when(dialogue_heavy(sentence), 0.75).otherwise(0.0))


def entity_bonus(weights: Column) -> Column:
    """The largest weight, and a tenth for each further entity; 0 for none."""
    return F.when(F.size(weights) > 0, F.array_max(weights) + 0.1 * (F.size(weights) - 1)).otherwise(0.0)


def sanitise_bullets(bullets: Column, most: int) -> Column:
    flat = F.transform(bullets, lambda b: F.trim(F.regexp_replace(b, r"\s+", " ")))
    return F.slice(F.filter(flat, lambda b: b != ""), 1, most)


def salience(cue: Column, weights: Column, chapter: Column, total: Column) -> Column:
    """.35 for a cue, .45 of the mean weight of participants, .20 of the place in the book; at most 1."""
    mean = F.when(F.size(weights) > 0, F.aggregate(weights, F.lit(0.0), lambda a, w: a + w) / F.size(weights)).otherwise(0.0)
    place = F.when((total > 0) & (chapter > 0), 0.20 * chapter / total).otherwise(0.0)
    return F.round(F.least(F.when(cue, 0.35).otherwise(0.0) + 0.45 * mean + place, F.lit(1.0)), 3)


def top_events(events: DataFrame, key: str, least: float, most: int, order: list) -> DataFrame:
    """Of each key the ``most`` most salient events of at least that salience, with participants."""
    good = events.where((F.col("salience") >= least) & (F.col("participants") > 0))
    return good.withColumn("rank", F.row_number().over(W.partitionBy(key).orderBy(F.desc("salience"), *order))).where(F.col("rank") <= most)


def salience_label(x: Column) -> Column:
    return F.when(x >= 0.6, "high").when(x >= 0.35, "medium").otherwise("low")


def collate(entities: DataFrame, events: DataFrame, modes: dict[str, tuple[str, float | None]]) -> DataFrame:
    """``entities(name, tier)`` with a mode by tier: dedicated, collective or drop; an event above the tier's threshold promotes.

    ``events(name, salience)``: a row for each participant or place. An unknown tier has a page of its own.
    """
    top = events.groupBy("name").agg(F.max("salience").alias("top"))
    mode, bar = F.lit("dedicated"), F.lit(None).cast("double")
    for tier, (m, above) in modes.items():
        mode = F.when(F.col("tier") == tier, F.lit(m)).otherwise(mode)
        bar = F.when(F.col("tier") == tier, F.lit(above).cast("double")).otherwise(bar)
    joined = entities.join(top, "name", "left")
    return joined.select("name", "tier", F.when(F.coalesce(F.col("top") > bar, F.lit(False)), "dedicated").otherwise(mode).alias("mode"))


def detect_pov(text: Column, lang: Column, first_person: dict[str, list[str]], thoughts: dict[str, list[str]]) -> Column:
    """Struct (pov, confidence) by the share of first-person words; below a hundredth thought markers decide."""
    n = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    edge = r"(?:^|[^\p{L}\p{N}_])"

    def hits(words: list[str]) -> Column:
        # one word may end where the next one starts, so its right edge is only looked at
        return F.size(F.regexp_extract_all(text, F.lit(rf"(?i){edge}({'|'.join(words)})(?=$|[^\p{{L}}\p{{N}}_])"), F.lit(1)))

    first, thought = F.lit(0), F.lit(False)
    for name, words in first_person.items():
        first = F.when(lang == name, hits(words)).otherwise(first)
    for name, words in thoughts.items():
        thought = F.when(lang == name, hits(words) > 0).otherwise(thought)
    ratio = F.when(n > 0, first / n).otherwise(0.0)
    pov = F.when(ratio > 0.01, "first_person").when((n > 0) & thought, "third_limited").otherwise("omniscient")
    sure = F.when(n == 0, "low").when(ratio > 0.05, "high").when(ratio > 0.01, "medium").when(ratio > 0, "low").otherwise("high")
    return F.struct(pov.alias("pov"), sure.alias("confidence"))


def temporal_context(text: Column, lang: Column, cues: dict[str, list[str]]) -> Column:
    """flashback, present, or unknown for a language without cues."""
    out = F.lit("unknown")
    for name, words in cues.items():
        found = F.lit(False)
        for w in words:
            found = found | F.lower(text).contains(w)
        out = F.when(lang == name, F.when(found, "flashback").otherwise("present")).otherwise(out)
    return out


def ungrounded(bullet: Column, chapter: Column) -> Column:
    """Capitalised tokens of a bullet, but for its first, that the chapter lacks."""
    tokens = F.regexp_extract_all(bullet, F.lit(r"([\p{L}']+)"), F.lit(1))
    caps = F.filter(F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0))), lambda t: t.rlike(r"^\p{Lu}"))
    return F.array_sort(F.array_except(F.array_distinct(caps), F.regexp_extract_all(chapter, F.lit(r"([\p{L}']+)"), F.lit(1))))
