"""Votes, grades, gold scores, and validation with reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

TIERS = ("inferred", "implicit", "explicit")


def vote_reason(a: Column, b: Column, kind: Column, direction: Column, on_roster: Column, kinds: list[str], directions: list[str]) -> Column:
    """Why a relation vote is rejected, or null; the first reason that holds."""

    def blank(c: Column) -> Column:
        return c.isNull() | (F.trim(c) == "")

    return (
        F.when(blank(a) | blank(b) | blank(kind) | blank(direction), "blank")
        .when(~on_roster, "off-roster")
        .when(F.trim(a) == F.trim(b), "self-pair")
        .when(~kind.isin(kinds), "type")
        .when(~direction.isin(directions), "direction")
    )


def confidence(kind: Column, evidence: Column, graded: Column) -> Column:
    """inferred without type or evidence; else the grade, explicit where there is none that is known."""
    typed = kind.isNotNull() & (F.trim(kind) != "") & (F.trim(F.coalesce(evidence, F.lit(""))) != "")
    grade = F.lower(F.trim(graded))
    return F.when(~typed, "inferred").when(grade.isin(*TIERS), grade).otherwise("explicit")


def rank(tier: Column) -> Column:
    out = F.lit(-1)
    for k, name in enumerate(TIERS):
        out = F.when(tier == name, k).otherwise(out)
    return out


def stronger(tier: Column, than: Column) -> Column:
    return rank(tier) > rank(than)


def verdicts(gold: DataFrame, predictions: DataFrame, key: list[str]) -> DataFrame:
    """Of each gold pair (label; null expects none; ``alternates``) its prediction's verdict; a missing one counts as none and is flagged."""
    rows = gold.join(predictions.withColumn("__seen", F.lit(True)), key, "left")
    none, predicted = F.col("label").isNull(), F.col("predicted").isNotNull()
    right = F.when(none, ~predicted).otherwise(predicted & ((F.col("predicted") == F.col("label")) | F.array_contains("alternates", F.col("predicted"))))
    verdict = F.when(right, "ok").when(~none & ~predicted, "false_null").when(none & predicted, "hallucination").otherwise("wrong_type")
    scored = rows.withColumn("verdict", verdict).withColumn("missing", F.col("__seen").isNull())
    # an accepted alternate is credited to the primary label
    return scored.withColumn("credited", F.when(F.col("verdict") == "ok", F.col("label")).otherwise(F.col("predicted"))).drop("__seen")


def class_metrics(scored: DataFrame) -> DataFrame:
    """(label, tp, fp, fn, support) from scored pairs; no label is a class too."""
    of = scored.select(F.coalesce("label", F.lit("null")).alias("t"), F.coalesce("credited", F.lit("null")).alias("p"))
    by_true = of.groupBy(F.col("t").alias("label")).agg(F.sum(F.expr("if(t = p, 1, 0)")).alias("tp"), F.sum(F.expr("if(t <> p, 1, 0)")).alias("fn"), F.count("*").alias("support"))
    by_pred = of.where("t <> p").groupBy(F.col("p").alias("label")).agg(F.count("*").alias("fp"))
    zero = F.lit(0).cast("long")
    return by_true.join(by_pred, "label", "full").select("label", *(F.coalesce(c, zero).alias(c) for c in ("tp", "fp", "fn", "support")))


def span_scores(gold: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """One row: matched gold and matched found spans, by overlap and exactly, with and without the label.

    ``gold``, ``found``: key, start, end, label. Spans meet within one key only. Recall is anchored in gold, precision in what was found.
    """
    g = gold.select(key, *(F.col(c).alias(f"g_{c}") for c in ("start", "end", "label")))
    f = found.select(key, *(F.col(c).alias(f"f_{c}") for c in ("start", "end", "label")))
    met = g.join(f, key).where("g_start < f_end and f_start < g_end")
    kinds = {"overlap": "true", "exact": "g_start = f_start and g_end = f_end"}
    out = []
    for name, rule in kinds.items():
        for typing, same in (("detection", "true"), ("typing", "g_label = f_label")):
            hit = met.where(f"{rule} and {same}")
            out.append(
                hit.agg(
                    F.countDistinct(key, "g_start", "g_end", "g_label").alias("gold_hits"), F.countDistinct(key, "f_start", "f_end", "f_label").alias("found_hits")
                ).select(F.lit(f"{name}_{typing}").alias("metric"), "gold_hits", "found_hits")
            )
    rows = out[0]
    for o in out[1:]:
        rows = rows.unionByName(o)
    return rows


def span_faults(spans: DataFrame, key: str) -> DataFrame:
    """``spans(key, start, end, surface, text)`` with a fault: bounds, mismatch, overlap (with an earlier span of the key), or null."""
    bounds = (F.col("start") < 0) | (F.col("end") <= F.col("start")) | (F.col("end") > F.length("text"))
    other = F.substr("text", F.col("start") + 1, F.col("end") - F.col("start")) != F.col("surface")
    before = F.max("end").over(W.partitionBy(key).orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1))
    return spans.withColumn("fault", F.when(bounds, "bounds").when(other, "mismatch").when(F.coalesce(before > F.col("start"), F.lit(False)), "overlap"))


def arbitrate(claims: DataFrame, key: str) -> DataFrame:
    """Of ``claims(key, value, authority, primary)`` the value of the highest authority if it is one, else the primary source's, else a flag."""
    top = claims.withColumn("top", F.max("authority").over(W.partitionBy(key))).where("authority = top")
    return top.groupBy(key).agg(
        F.when(F.count_distinct("value") == 1, F.max("value"))
        .when(F.count_distinct(F.expr("if(primary, value, null)")) == 1, F.max(F.expr("if(primary, value, null)")))
        .alias("value"),
        ((F.count_distinct("value") > 1) & (F.count_distinct(F.expr("if(primary, value, null)")) != 1)).alias("flagged"),
    )


def thresholds(counts: DataFrame, shares: dict[str, float], absolute: dict[str, int], least: int = 4) -> DataFrame:
    """A type's least counts by tier: the value at place ``max(0, int(n * p) - 1)`` of the ascending counts, or absolute ones for few entities.

    Counts are tallied first, so a type of any size is a cumulated histogram and never one sorted task.
    """
    tally = counts.groupBy("type", "n").agg(F.count("*").alias("times"))
    ends = tally.withColumn("upto", F.sum("times").over(W.partitionBy("type").orderBy("n"))).withColumn("total", F.sum("times").over(W.partitionBy("type")))
    out = [
        F.when(F.max("total") < least, F.lit(absolute[tier])).otherwise(F.min(F.when(F.col("upto") > F.greatest(F.lit(0), F.floor(F.col("total") * p).cast("int") - 1), F.col("n")))).cast("long").alias(tier)
        for tier, p in shares.items()
    ]
    return ends.groupBy("type").agg(*out)
