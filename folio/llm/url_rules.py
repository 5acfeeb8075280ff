"""URL filters: given host and path rules, then mined association rules (op 6).

**Given rules** are strings ``host/path``. One fits a URL whose host is the rule's or a subdomain of
it, if the URL's path starts with the rule's path; the longest that fits decides.

**Mined rules.** URLs that no given rule fits are judged by token combinations. A URL's tokens are its
scheme, the suffixes of its host, its path's words, its file ending and the names of its parameters. Spark's
FP-growth runs over labelled URLs with their label as one more token; a combination becomes a block rule if
it holds often enough (``min_support`` of the labelled URLs, and ``MIN_COUNT`` of them) and the label is bad in at least
``min_confidence`` of them, and if no part of it is a rule with the same confidence or more. Rules are matched by an
inverted index: a rule stands under its rarest token, a URL looks up its tokens and checks the rest of
each rule it finds. URLs without any rule are allowed.

Everything runs in DataFrame functions. A null or empty URL, or one without ``://``, has an empty host and path and is allowed; empty
labels mine nothing, an empty table gives an empty one. Each different URL is judged once, so repeated URLs cost a join and no more.
Of given rules of one length the later in the alphabet decides, of mined ones that hold the one with most confidence, then the
later. Null ids are judged like others and learn nothing; a very long URL is one row of tokens. Of extra columns none is read.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import checkpoint, table

BAD = "label=bad"
MIN_COUNT = 20  # labelled URLs that a combination must be met in, whatever the share
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def given_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest fitting rule's text, or null. Rules come from the caller's configuration and sit in the plan."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):  # a longer one, tested later, wraps the shorter
        name, _, path_start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + path_start)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.concat(F.lit("host="), F.array_join(F.slice(labels, k, F.size(labels)), "."))
    )
    words = F.transform(F.filter(F.split(path, r"[/._\-]+"), lambda w: w.rlike(r"^\D+$")), lambda w: F.concat(F.lit("path="), w))
    ending = F.regexp_extract(path, r"\.([A-Za-z]{1,5})$", 1)
    names = F.transform(F.regexp_extract_all(url, F.lit(r"[?&]([^=&#]+)="), F.lit(1)), lambda n: F.concat(F.lit("name="), n))
    scheme = F.concat(F.lit("scheme="), F.regexp_extract(url, r"(?s)^(.*?)://", 1))
    empty = F.array().cast("array<string>")
    found = F.concat(F.array(scheme), suffixes, words, F.when(ending != "", F.array(F.concat(F.lit("ending="), ending))).otherwise(empty), names)
    return F.when(host == "", empty).otherwise(F.array_distinct(found))


def mine(labelled: DataFrame, min_support: float, min_confidence: float) -> DataFrame:
    """(rule, items, confidence, rarest) from ``labelled(tokens, bad)``; the tables it returns come from aggregates over all rows."""
    baskets = labelled.select(F.when(F.col("bad"), F.array_append("tokens", F.lit(BAD))).otherwise(F.col("tokens")).alias("items")).where("size(items) > 0")
    empty = labelled.sparkSession.sql("SELECT '' AS rule, array('') AS items, 0D AS confidence, '' AS rarest WHERE false")
    baskets = checkpoint(baskets)
    n = baskets.count()
    if not n:
        return empty
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(min_support, MIN_COUNT / n)), minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.where(F.col("consequent") == F.array(F.lit(BAD))).select(F.array_sort("antecedent").alias("items"), "confidence")
    rules = checkpoint(rules.withColumn("rule", F.array_join("items", " ")))
    # a part of a rule that is a rule of the same confidence makes it superfluous: look the parts up, one token left out
    parts = rules.select("rule", "confidence", F.explode(F.transform("items", lambda x: F.array_join(F.array_remove("items", x), " "))).alias("part"))
    weaker = parts.join(rules.select(F.col("rule").alias("part"), F.col("confidence").alias("c")), "part").where("c >= confidence").select("rule")
    rules = rules.join(weaker.distinct(), "rule", "left_anti")
    single = model.freqItemsets.where("size(items) = 1").select(F.col("items")[0].alias("item"), "freq")
    rarest = rules.select("rule", F.explode("items").alias("item")).join(single, "item").groupBy("rule").agg(F.min_by("item", F.struct("freq", "item")).alias("rarest"))
    return rules.join(rarest, "rule").select("rule", "items", "confidence", "rarest")


def url_filter(
    pages: DataFrame,
    rules: dict[str, str],
    labels: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    label_id: str = "doc_id",
    bad: str = "quality = 0 or toxic = 1",
    min_support: float = 0.002,
    min_confidence: float = 0.8,
) -> DataFrame:
    """id_col, host, path, rule, verdict, mined (the association rule that blocks, or null) for every row of ``pages``."""
    url = F.col("u")
    rows = pages.select(F.col(id_col).alias("i"), F.col(url_col).cast("string").alias("u"))
    rows = rows.withColumns({"host": host_of(url), "path": path_of(url)})
    rows = rows.withColumn("rule", given_rule(F.col("host"), F.col("path"), rules))
    tokens = tokens_of(url, F.col("host"), F.col("path"))
    if labels is not None:
        known = labels.select(F.col(label_id).alias("l"), F.expr(bad).alias("bad")).where("bad is not null and l is not null")
        found = mine(rows.withColumn("tokens", tokens).join(known, F.col("i") == F.col("l")).select("tokens", "bad"), min_support, min_confidence)
        hits = (
            rows.where("rule is null and host <> ''")
            .select("u", "host", "path")
            .distinct()
            .select("u", tokens.alias("tokens"))
            .select("u", "tokens", F.explode("tokens").alias("token"))
            .join(found.select("rarest", "items", F.col("rule").alias("name"), "confidence"), F.col("token") == F.col("rarest"))
            .where(F.forall("items", lambda x: F.array_contains("tokens", x)))
            .groupBy(F.col("u").alias("hit"))
            .agg(F.max_by("name", F.struct("confidence", "name")).alias("mined"))
        )
        rows = rows.join(hits, F.col("u") == F.col("hit"), "left")
    else:
        rows = rows.withColumn("mined", F.lit(None).cast("string"))
    verdict = F.when(F.col("mined").isNotNull() & F.col("rule").isNull(), F.lit("block")).otherwise(F.lit("allow"))
    for rule, word in rules.items():
        verdict = F.when(F.col("rule") == rule, F.lit(word)).otherwise(verdict)
    return rows.select(F.col("i").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), F.when(F.col("rule").isNull(), F.col("mined")).alias("mined"))


RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: all ``pages``; a page's labels are those of the document with its id."""
    return url_filter(table(spark, sf_dir, "pages"), RULES, table(spark, sf_dir, "labels"))
