"""Quality rules with an n-gram perplexity (op 8).

**Model.** For each language a modified Kneser-Ney model of ``ORDER`` characters. A character is one of 4096 symbols: code
points below 2048 (Latin, Greek, Cyrillic, Hebrew, Arabic, ...) are themselves but that digits are one, wider ones share the
upper half by hash. An n-gram is one number of 12 bits a symbol, so contexts and shorter n-grams are shifts and masks.
Spark counts the n-grams of *all* whole documents, and from them the continuation counts of the lower orders, each order's
counts of counts (which give its three discounts) and each context's total and freed mass.

**Storage.** The model is two pairs of sorted hash arrays, for all languages and orders together: 64-bit hashes of n-grams
with their log2 probabilities, and of contexts with their log2 back-off weights. Every lookup of a score is a binary search in them, from
the longest n-gram down. At most ``ENTRIES`` n-grams are broadcast. Where there are more, over all languages, the probabilities of all n-grams are made by
joins; the most frequent ones of the highest order are broadcast as a sorted hash array, and a text's others meet theirs in a shuffled join, so no n-gram is left out.

**Rules.** ``base_failed`` holds for texts under ``MIN_WORDS`` words, or with over half of the words in
repeated three-word windows. Otherwise a text is rejected if its log2 perplexity is outside its language's band, by character
(``bits``) or by word (``word_bits``). A band's ends come from the texts of the language that pass the base: the median, less ``WIDTH``
robust standard deviations of the texts below it, and plus as many of the texts above it, but at least a ``LEAST`` share of
the median to either side. Low perplexity is text made of a pattern, high perplexity text unlike the language.

Null and empty texts have no words and fail the base; their perplexity is null. A null language is a
language of its own. A language without a text that passes has no band, and rejects nothing. Ties (equal perplexities) fall on
the same side; repeated rows are counted and judged each; null ids stay null; of extra columns none is read; an empty table
gives an empty one. A very long text is counted and scored whole, a slice of about half a megabyte of texts at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import Words, checkpoint, combine, heaviest, mix64, signed, slices, table

MIN_WORDS = 50
ORDER = 4
ENTRIES = 1_000_000
FLUSH = 1 << 19  # n-grams that a task holds before it reports
SLICE = 1 << 19  # bytes of text worked on at a time, each of which takes some hundred in a worker
WIDTH = 8.0
LEAST = 0.1
SYMBOL_BITS = 12
_SIGNS = np.zeros(256, dtype=bool)
_SIGNS[list(b"#*$%&|<>")] = True
_BREAK = 10  # a text is framed by line feeds


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all texts, each after ``ORDER - 1`` breaks and before one; offsets of those)."""
    first = (data & 0xC0) != 0x80
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.uint64)
    flat = np.where(points < 2048, points, np.uint64(2048) + (mix64(points) >> np.uint64(53)))
    flat[(points >= 48) & (points < 58)] = 48
    ends = np.concatenate([[0], np.cumsum(first)])[offsets]
    sizes = np.diff(ends)
    at = np.concatenate([[0], np.cumsum(sizes + ORDER)])
    out = np.full(int(at[-1]), _BREAK, np.uint64)
    out[np.repeat(at[:-1] + ORDER - 1 - ends[:-1], sizes) + np.arange(len(flat))] = flat
    return out, at


def grams(flat: np.ndarray, at: np.ndarray, langs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(language in the upper bits and n-gram in the lower ones, the text it belongs to); texts without a character have none."""
    which = np.repeat(np.arange(len(langs)), np.diff(at))
    code = np.zeros(len(flat), np.uint64)
    for k in range(ORDER):
        code[ORDER - 1 :] |= flat[ORDER - 1 - k : len(flat) - k] << np.uint64(SYMBOL_BITS * k)
    inside = np.arange(len(flat)) - at[:-1][which] >= ORDER - 1
    inside &= np.diff(at)[which] > ORDER
    return (langs.astype(np.uint64)[which] << np.uint64(SYMBOL_BITS * ORDER) | code)[inside], which[inside]


def _numbered(names: list) -> tuple[list, np.ndarray]:
    known = {x: k for k, x in enumerate(dict.fromkeys(names))}
    return list(known), np.array([known[x] for x in names], np.int64)


def _count(batches):
    """(lang, text) -> (lang, code, n), summed up over ``FLUSH`` n-grams."""
    held: list[tuple[list, np.ndarray, np.ndarray]] = []

    def report():
        names, which = _numbered([x for langs, _, _ in held for x in langs])
        first, keys = 0, []
        for langs, key, _ in held:
            own = which[first + (key >> np.uint64(SYMBOL_BITS * ORDER)).astype(np.int64)]
            keys.append(own.astype(np.uint64) << np.uint64(SYMBOL_BITS * ORDER) | key & np.uint64((1 << SYMBOL_BITS * ORDER) - 1))
            first += len(langs)
        key, back = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(back, np.concatenate([c for _, _, c in held])).astype(np.int64)
        held.clear()
        lang = pa.DictionaryArray.from_arrays(pa.array((key >> np.uint64(SYMBOL_BITS * ORDER)).astype(np.int32)), pa.array(names, pa.string())).cast(pa.string())
        return pa.RecordBatch.from_arrays([lang, pa.array(signed(key & np.uint64((1 << SYMBOL_BITS * ORDER) - 1))), pa.array(n)], names=["lang", "code", "n"])

    for batch in batches:
        names, which = _numbered(batch.column(0).to_pylist())
        for i, j, data, offsets in slices(batch.column(1), SLICE):
            key, n = np.unique(grams(*symbols(data, offsets), which[i:j])[0], return_counts=True)
            if len(key):
                held.append((names, key, n))
            if sum(len(key) for _, key, _ in held) >= FLUSH:
                yield report()
    if held:
        yield report()


def discounts(counts: dict[int, int]) -> np.ndarray:
    """D1, D2, D3+ of modified Kneser-Ney from the numbers of n-grams counted 1, 2, 3 and 4 times; else 0.5, 0.75, 0.9."""
    n1, n2, n3, n4 = (float(counts.get(k, 0)) for k in (1, 2, 3, 4))
    if not (n1 and n2 and n3 and n4):
        return np.array([0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    return np.clip([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], [0.05, 0.05, 0.05], [0.95, 1.9, 2.9])


class Hashed:
    """Sorted hashes with a value each, and ``default`` for what isn't there."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray, default: float):
        by = np.argsort(hashes)
        self.hashes, self.values, self.default = hashes[by], values[by].astype(np.float32), np.float32(default)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(hashes), self.default)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.values[at], self.default)


def _hash(lang: np.ndarray, order: int, code: np.ndarray) -> np.ndarray:
    return mix64(mix64(lang.astype(np.uint64) * np.uint64(16) + np.uint64(order)) ^ code.astype(np.uint64))


class Model:
    """All languages' n-grams. ``kept(lang, k, code, n, d)``: stored n-grams with their discounts; ``contexts(lang, k, ctx, total, free)``."""

    def __init__(self, kept: dict[str, np.ndarray], contexts: dict[str, np.ndarray]):
        share = contexts["free"] / contexts["total"]
        keys = [_hash(contexts["lang"][own], k, contexts["ctx"][own]) for k in range(1, ORDER + 1) for own in [contexts["k"] == k]]
        own = np.concatenate([np.flatnonzero(contexts["k"] == k) for k in range(1, ORDER + 1)])
        self.back = Hashed(np.concatenate(keys), np.log2(share[own]), 0.0)
        totals = Hashed(np.concatenate(keys), contexts["total"][own], np.nan)
        totals.values = contexts["total"][own][np.argsort(np.concatenate(keys))].astype(np.float64)
        self.stored = Hashed(np.zeros(0, np.uint64), np.zeros(0), np.nan)
        hashes, values = np.zeros(0, np.uint64), np.zeros(0, np.float64)
        for k in range(1, ORDER + 1):  # an order's probabilities need those of the order below
            some = kept["k"] == k
            lang, code, n, d = (kept[c][some] for c in ("lang", "code", "n", "d"))
            h = _hash(lang, k, code >> SYMBOL_BITS)
            lower = np.exp2(self._log2(lang, code & ((1 << SYMBOL_BITS * (k - 1)) - 1), k - 1).astype(np.float64))
            p = (n - d) / totals(h) + np.exp2(self.back(h).astype(np.float64)) * lower
            hashes, values = np.concatenate([hashes, _hash(lang, k, code)]), np.concatenate([values, np.log2(p)])
            self.stored = Hashed(hashes, values, np.nan)

    def _log2(self, lang: np.ndarray, code: np.ndarray, order: int) -> np.ndarray:
        """log2 p(last symbol | those before it): the longest stored n-gram, after the back-off weights of all longer contexts."""
        out = np.zeros(len(code), np.float32)
        left = np.arange(len(code))
        for k in range(order, 0, -1):
            own, name = code[left] & ((1 << SYMBOL_BITS * k) - 1), lang[left]
            p = self.stored(_hash(name, k, own))
            met = ~np.isnan(p)
            out[left[met]] += p[met]
            left, own, name = left[~met], own[~met], name[~met]
            out[left] += self.back(_hash(name, k, own >> SYMBOL_BITS))
        out[left] -= SYMBOL_BITS  # no order has it: all symbols alike
        return out

    def log2(self, key: np.ndarray, lang: np.ndarray) -> np.ndarray:
        """Of keys as ``grams`` makes them; ``lang``: the model's number of each language there."""
        key = signed(key)
        return self._log2(lang[key >> SYMBOL_BITS * ORDER], key & ((1 << SYMBOL_BITS * ORDER) - 1), ORDER)


def _score(model, numbers: dict):
    """(id, lang, text) -> base counts, number of symbols, their bits, and the n-grams that the model has no word of: language's number, codes and times."""

    def run(batches):
        known = model.value
        for batch in batches:
            names, which = _numbered(batch.column(1).to_pylist())
            own = np.array([numbers.get(x, -1) for x in names], np.int64)
            for i, j, data, offsets in slices(batch.column(2), SLICE):
                rows = base_counts(data, offsets)
                key, text = grams(*symbols(data, offsets), which[i:j])
                distinct, back = np.unique(key, return_inverse=True)
                found = known.log2(distinct, own)
                bits = -np.bincount(text, np.nan_to_num(found)[back], minlength=j - i)
                n = np.bincount(text, minlength=j - i)
                rare = np.isnan(found)[back]  # in the order of texts
                ends = np.concatenate([[0], np.cumsum(np.bincount(text[rare], minlength=j - i))])
                codes = signed(key[rare] & np.uint64((1 << SYMBOL_BITS * ORDER) - 1))
                none = (n == 0) | (own[which[i:j]] < 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[i:j],
                        batch.column(1)[i:j],
                        *(pa.array(c, pa.int64()) for c in rows),
                        pa.array(n, pa.int64()),
                        pa.array(bits, mask=none),
                        pa.array(own[which[i:j]], pa.int32()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(codes)),
                    ],
                    names=["id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "grams", "bits", "number", "rare"],
                )

    return run


def base_counts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    w = Words(data, offsets)
    h = w.hashes(lower=False)
    three = combine(h, 3, salt=3)
    inside = np.zeros(len(data) + 1, np.int32)
    np.add.at(inside, w.start, 1)
    np.add.at(inside, w.end, -1)
    solid = np.cumsum(inside[:-1]).astype(bool)

    def total(flags):
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])

    lines, repeats = [], []
    for d in range(len(offsets) - 1):
        a, b = int(w.at[d]), int(w.at[d + 1])
        seen: set[bytes] = set()
        dup = 0
        for line in w.text(d).split(b"\n"):
            if line in seen:
                dup += 1
            elif line and line.split(None, 1):
                seen.add(line)
        lines.append(dup)
        again = 0
        if b - a > 3:
            _, where, n = np.unique(three[a : b - 2], return_inverse=True, return_counts=True)
            start = np.flatnonzero(n[where] > 1)
            if len(start):
                cover = np.zeros(b - a, bool)
                for k in range(3):
                    cover[start + k] = True
                again = int(cover.sum())
        repeats.append(again)
    return [np.diff(w.at), total(solid & ((data & 0xC0) != 0x80)), total(_SIGNS[data]), np.array(lines), np.array(repeats)]


def count(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, dict, list]:
    """((number, k, code, n, d) of all n-grams of all whole texts, each language's number, a histogram of their counts)."""
    top = docs.select(F.col(lang_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(_count, "lang string, code long, n long")
    level = checkpoint(top.groupBy("lang", "code").agg(F.sum("n").alias("n")))
    orders = [level.withColumn("k", F.lit(ORDER))]
    for k in range(ORDER - 1, 0, -1):  # how many different symbols stand before it
        shorter = F.col("code").bitwiseAND(F.lit((1 << SYMBOL_BITS * k) - 1)).alias("code")
        level = level.select("lang", shorter).groupBy("lang", "code").agg(F.count("*").alias("n"))
        orders.append(level.withColumn("k", F.lit(k)))
    counted = orders[0]
    for o in orders[1:]:
        counted = counted.unionByName(o)
    counted = checkpoint(counted)
    few = F.least("n", F.lit(5)).cast("int")
    rows = counted.groupBy("lang", "k", few.alias("n"), F.floor(F.log2("n")).cast("int").alias("power")).count().collect()  # a few rows an order and language
    numbers = {x: i for i, x in enumerate(sorted({r.lang for r in rows}, key=lambda x: (x is not None, x)))}
    of: dict = {}
    for r in rows:
        own = of.setdefault((r.lang, r.k), {})
        own[r.n] = own.get(r.n, 0) + r["count"]
    cut = {key: discounts(own) for key, own in of.items()}
    spark = docs.sparkSession
    table_ = spark.createDataFrame([(x, k, numbers[x], *map(float, d)) for (x, k), d in cut.items()] or [(None, 0, 0, 0.0, 0.0, 0.0)], "l string, o int, number int, d1 double, d2 double, d3 double")
    with_d = (
        counted.join(F.broadcast(table_), F.col("lang").eqNullSafe(F.col("l")) & (F.col("k") == F.col("o")))
        .withColumn("d", F.expr("case n when 1 then d1 when 2 then d2 else d3 end"))
    )
    return with_d.select("number", "k", "code", "n", "d"), numbers, rows


def model_of(counted: DataFrame, rows: list, entries: int) -> Model:
    least = 1
    while sum(r["count"] for r in rows if r.k == 1 or 2**r.power >= least) > entries and least < 1 << 40:
        least *= 2
    with_d = counted.withColumn("stored", F.expr(f"k = 1 or n >= {least}"))
    kept = with_d.where("stored").select(F.col("number").alias("lang"), "k", "code", "n", "d").toArrow()
    contexts = (
        with_d.groupBy(F.col("number").alias("lang"), "k", F.shiftright("code", SYMBOL_BITS).alias("ctx"))
        .agg(F.sum("n").alias("total"), F.sum(F.expr("if(stored, d, n)")).alias("free"), F.max("stored").alias("any"))
        .where("any")
        .drop("any")
        .toArrow()
    )
    return Model(*({c: t.column(c).to_numpy() for c in t.column_names} for t in (kept, contexts)))


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", entries: int = ENTRIES) -> tuple[Model, dict]:
    """(the model of all languages, each language's number), from all whole texts."""
    counted, numbers, rows = count(docs, lang_col, text_col)
    return model_of(counted, rows, entries), numbers


def probabilities(counted: DataFrame) -> DataFrame:
    """(number, code, n, log2) of all n-grams of the highest order, by joins from the lowest order up."""
    lower = None
    for k in range(1, ORDER + 1):
        own = counted.where(F.col("k") == k).withColumn("ctx", F.shiftright("code", SYMBOL_BITS))
        totals = own.groupBy("number", "ctx").agg(F.sum("n").alias("total"), F.sum("d").alias("free"))
        own = own.join(totals, ["number", "ctx"])
        if lower is None:
            below = F.lit(2.0**-SYMBOL_BITS)
        else:
            own = own.withColumn("suffix", F.col("code").bitwiseAND(F.lit((1 << SYMBOL_BITS * (k - 1)) - 1))).join(lower, ["number", "suffix"])
            below = F.col("below")
        p = own.select("number", "code", "n", ((F.col("n") - F.col("d") + F.col("free") * below) / F.col("total")).alias("p"))
        lower = p.select("number", F.col("code").alias("suffix"), F.col("p").alias("below"))
    return checkpoint(p.select("number", "code", "n", F.log2("p").alias("log2")))


class Frequent:
    """The most frequent n-grams of the highest order as sorted hashes with their log2 probabilities; others are NaN."""

    def __init__(self, rows: pa.Table):
        code = rows.column("code").to_numpy()
        self.stored = Hashed(_hash(rows.column("number").to_numpy(), ORDER, code), rows.column("log2").to_numpy(), np.nan)

    def log2(self, key: np.ndarray, lang: np.ndarray) -> np.ndarray:
        key = signed(key)
        return self.stored(_hash(lang[key >> SYMBOL_BITS * ORDER], ORDER, key & ((1 << SYMBOL_BITS * ORDER) - 1)))


def _band(rows: DataFrame, measure: str, width: float, least: float) -> DataFrame:
    """(of, low, high) of a measure for each language, from the texts that pass the base."""
    good = rows.where("not base_failed").select(F.col("lang").alias("of"), F.col(measure).alias("x")).where("x is not null")
    middle = good.groupBy(F.col("of").alias("l")).agg(F.percentile_approx("x", 0.5, 10_000).alias("mid"))
    return (
        good.join(F.broadcast(middle), F.col("of").eqNullSafe(F.col("l")))  # a row a language
        .groupBy("of", "mid")
        .agg(*(F.percentile_approx(F.expr(f"if({side}, abs(x - mid), null)"), 0.5, 10_000).alias(c) for c, side in (("below", "x <= mid"), ("above", "x >= mid"))))
        .select(
            "of",
            *(
                (F.col("mid") + sign * F.greatest(F.lit(least) * F.col("mid"), width * 1.4826 * F.col(c))).alias(f"{measure}_{end}")
                for sign, c, end in ((-1, "below", "low"), (1, "above", "high"))
            ),
        )
    )


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", width: float = WIDTH, least: float = LEAST, entries: int = ENTRIES
) -> DataFrame:
    """id_col, lang, base counts, bits (a character), word_bits, both bands, base_failed, kept."""
    counted, numbers, histogram = count(docs, lang_col, text_col)
    whole = sum(r["count"] for r in histogram) <= entries
    if not whole:
        table_ = probabilities(counted)
    model = model_of(counted, histogram, entries) if whole else Frequent(heaviest(table_, "n", entries).select("number", "code", "log2").toArrow())
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _score(sent, numbers), f"id {kind}, lang string, {', '.join(f'{c} long' for c in counts)}, grams long, bits double, number int, rare array<long>"
    )
    if not whole:  # n-grams that aren't broadcast meet their probabilities in a join, whose rows know their text by a number
        rows = checkpoint(rows.withColumn("at", F.monotonically_increasing_id()))
        met = rows.select("at", "number", F.explode("rare").alias("code")).groupBy("at", "number", "code").agg(F.count("*").alias("times"))
        others = met.join(table_.drop("n"), ["number", "code"]).groupBy("at").agg(F.sum(F.col("times") * F.col("log2")).alias("more"))
        rows = rows.join(others, "at", "left").withColumn("bits", F.col("bits") - F.coalesce("more", F.lit(0.0)))
    rows = checkpoint(
        rows.select(
            "id",
            "lang",
            *counts,
            (F.col("bits") / F.greatest("grams", F.lit(1))).alias("bits"),
            (F.col("bits") / F.greatest("n_words", F.lit(1))).alias("word_bits"),
            F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words").alias("base_failed"),
        )
    )
    out = rows
    for measure in ("bits", "word_bits"):
        band = _band(rows, measure, width, least)
        out = out.join(F.broadcast(band), F.col("lang").eqNullSafe(F.col("of")), "left").drop("of")
    ends = [f"{m}_{e}" for m in ("bits", "word_bits") for e in ("low", "high")]
    inside = " and ".join(f"coalesce({m} between {m}_low and {m}_high, true)" for m in ("bits", "word_bits"))
    return out.select(F.col("id").alias(id_col), "lang", *counts, "bits", "word_bits", *ends, "base_failed", F.expr(f"not base_failed and {inside}").alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: every text of ``documents``."""
    return quality_rules(table(spark, sf_dir, "documents")).drop("lang")
