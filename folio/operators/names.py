"""Name rules: tokens, titles, matching, look-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters with marks and the plain letters under them.
MARKED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"


def normalise(name: Column) -> Column:
    """Lower case, marks dropped, sharp s as two, trimmed."""
    return F.trim(F.replace(F.translate(F.lower(name), MARKED, PLAIN), F.lit("ß"), F.lit("ss")))


def surface_key(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(normalise(name), "[^0-9a-z ]", " "), " +", " "))


def slug(name: Column) -> Column:
    out = F.trim(F.regexp_replace(normalise(name), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.when(out == "", F.lit("unnamed")).otherwise(out)


def words(name: Column) -> Column:
    return F.split(F.trim(F.lower(name)), r"\s+")


def leading(tokens: Column, titles: list[str]) -> Column:
    """How many of the first tokens are titles."""
    first_other = F.array_position(F.transform(tokens, lambda t: t.isin(titles)), F.lit(False))
    return F.when(first_other == 0, F.size(tokens)).otherwise(first_other - 1).cast("int")


def name_tokens(name: Column, titles: list[str]) -> Column:
    """Tokens without leading titles; the last one always stays."""
    t = words(name)
    return F.slice(t, F.least(leading(t, titles), F.size(t) - 1) + 1, F.size(t))


def leading_titles(name: Column, titles: list[str]) -> Column:
    t = words(name)
    return F.array_sort(F.array_distinct(F.slice(t, F.lit(1), leading(t, titles))))


def gender_conflict(a: Column, b: Column, titles: list[str], masculine: list[str], feminine: list[str]) -> Column:
    def has(name: Column, own: list[str]) -> Column:
        return F.arrays_overlap(leading_titles(name, titles), F.array(*map(F.lit, own)))

    return (has(a, masculine) & has(b, feminine)) | (has(a, feminine) & has(b, masculine))


def surname(name: Column, titles: list[str]) -> Column:
    return F.element_at(F.transform(name_tokens(name, titles), normalise), -1)


def first_names(name: Column, titles: list[str]) -> Column:
    t = F.transform(name_tokens(name, titles), normalise)
    return F.slice(t, F.lit(1), F.size(t) - 1)


def token_match(a: Column, b: Column, titles: list[str]) -> Column:
    """Equal sets; a subset, unless it is a bare title or both are single given names; a shared token where one side is single."""
    x, y = F.array_distinct(a), F.array_distinct(b)
    shared = F.size(F.array_intersect(x, y))
    equal = (shared == F.size(x)) & (shared == F.size(y))
    subset = (shared == F.size(x)) | (shared == F.size(y))
    smaller = F.when(F.size(x) <= F.size(y), a).otherwise(b)
    bare = (F.size(smaller) == 1) & smaller[0].isin(titles)

    def given(t: Column) -> Column:
        return (F.size(t) == 1) & (F.length(t[0]) <= 8)

    both = given(a) & given(b)
    return equal | F.when(subset, ~bare & ~both).otherwise((shared > 0) & ((F.size(x) == 1) | (F.size(y) == 1)) & ~both)


def matching_pairs(names: DataFrame, titles: list[str], masculine: list[str], feminine: list[str]) -> DataFrame:
    """(a, b) of ``names(name)`` that match by tokens and have no conflicting titles; only names that share a token meet."""
    own = names.select("name", name_tokens(F.col("name"), titles).alias("tokens"))
    met = own.select("name", "tokens", F.explode(F.array_distinct("tokens")).alias("t"))
    pairs = met.select("t", F.col("name").alias("a"), F.col("tokens").alias("ta")).join(met.select("t", F.col("name").alias("b"), F.col("tokens").alias("tb")), "t").where("a < b")
    kept = pairs.where(token_match(F.col("ta"), F.col("tb"), titles) & ~gender_conflict(F.col("a"), F.col("b"), titles, masculine, feminine))
    return kept.select("a", "b").distinct()


def toponym_in_title(place: Column, person: Column, connectors: list[str], titles: list[str]) -> Column:
    """A place's token right after a connector within a person's name."""
    p, q = name_tokens(person, titles), name_tokens(place, titles)
    return F.exists(F.sequence(F.lit(2), F.greatest(F.size(p), F.lit(2))), lambda i: F.coalesce(F.array_contains(q, F.get(p, i - 1)) & F.get(p, i - 2).isin(connectors), F.lit(False)))


def name_lookup(entities: DataFrame, least: int = 4) -> DataFrame:
    """(key, canonical) from ``entities(order, canonical, aliases)``: a canonical name owns its key, else the first that claims an alias."""
    own = entities.groupBy(F.lower("canonical").alias("key")).agg(F.max_by("canonical", "order").alias("canonical"))
    alias = entities.select("order", "canonical", F.explode("aliases").alias("alias")).where(F.length("alias") >= least)
    claimed = alias.groupBy(F.lower("alias").alias("key")).agg(F.min_by("canonical", F.struct("order", "canonical")).alias("canonical"))
    return own.unionByName(claimed.join(own, "key", "left_anti"))


def has_marker(text: Column, markers: list[str]) -> Column:
    """Any of the markers as a whole word, in any case."""
    alternatives = "|".join(sorted(markers, key=lambda m: (-len(m), m)))
    return text.rlike(rf"(?i)(^|[^\p{{L}}\p{{N}}_])(?:{alternatives})($|[^\p{{L}}\p{{N}}_])")


def word_pattern(words_: list[str]) -> str:
    """An alternation that tries longer words first."""
    return "(?i)(?:" + "|".join(sorted(set(words_), key=lambda w: (-len(w), w))) + ")"


def merge_drop_caps(blocks: Column) -> Column:
    """A block of one capital is glued to the next one if that starts in lower case."""
    following = F.concat(F.slice(blocks, F.lit(2), F.greatest(F.size(blocks) - 1, F.lit(0))), F.array(F.lit("")))
    glued = F.zip_with(blocks, following, lambda b, f: F.when(b.rlike(r"^\p{Lu}$") & f.rlike(r"^\p{Ll}"), F.concat(b, f)))
    before = F.concat(F.array(F.lit(None).cast("string")), glued)  # one longer: its last element meets no block
    own = F.zip_with(blocks, glued, lambda b, g: F.coalesce(g, b))
    return F.filter(F.zip_with(own, before, lambda o, g: F.when(g.isNull(), o)), lambda o: o.isNotNull())
