"""Toxicity by a weighted lexicon and Aho-Corasick (op 1).

**Folding.** Homoglyphs (Greek and Cyrillic look-alikes, full-width forms) and digits or signs in
the place of letters become Latin letters, case is dropped, every other character becomes one space. A
digit or sign is a letter only next to letters, so numbers stay numbers (that is: they vanish).

**Lexicon.** Entries are learned from *all* labelled documents: whole words and word beginnings of
``STEMS`` letters, taken where the labels depend on them (likelihood ratio at least ``MIN_G``, support at least
``MIN_SHARE`` of the toxic documents), weighted by the log odds of their document counts. Documents of one label that
share ``MIN_HASHES`` smallest hashes of their words (near copies) count once, or copies of one toxic text would make all its words
entries; of their words those count that any of them has. Toxic documents are counted first: what has too little support there is no
entry, so the others are counted for the rest only, whose number the floor bounds whatever the corpus. *Exception
phrases* are word pairs that hold an entry and are not toxic more often than labelled documents are (support at least ``PAIR_SHARE`` of
the labelled documents); an entry inside one doesn't count.

**Score.** One automaton finds entries and exceptions in one pass. Matched weight over text length,
matched weight alone and the presence of a match go through a logistic curve fitted on all labelled documents
(a Newton step is a sum in Spark), so the score is 0 to 1 and rises with the weight in a text of a given length.

Null and empty texts have no match and get the curve's lowest score. Without any toxic label the lexicon
is empty and all scores are 0. Labels, language, source and id are no inputs of a score. Several labels of one id count as the
highest; equal scores are ties that need no order. A very long text is folded and matched whole, in time that grows with its length and
matches. Null ids are scored and learn nothing; repeated rows are scored each; of extra columns none is read, whatever its name; an
empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import Words, checkpoint, few, mix64, table

STEMS = (4, 5, 6)
MIN_G = 20.0
MIN_SHARE = 0.01
PAIR_SHARE = 1 / 2400
MIN_HASHES = 4
SENT = 1_000_000  # labels that are broadcast; more of them meet their texts in a shuffled join
FLUSH = 200_000  # entries that a task holds before it reports
FILTER_BITS = 1 << 23  # of the map of texts that may have near copies
TASK_ROWS = 1_000_000  # rows that a task sums for a step of the curve, or more if there are fewer tasks than cores

# Look-alike letters and the Latin letters they stand for.
_GREEK_CYRILLIC = "αβγεικνοπρτυχѕіјаеорсухкмнтвԁɡ"
_LATIN_FOR_THEM = "abyeiknopptuxsijaeopcyxkmhtbdg"
# Digits and signs that stand for letters.
_DIGITS = "0134578@$!"
_LETTERS_FOR_DIGITS = "oieastbasi"

_ODD, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
_LETTER = {ord(a): b for a, b in zip(_GREEK_CYRILLIC, _LATIN_FOR_THEM)}
_SIGN = {ord(a): b for a, b in zip(_DIGITS, _LETTERS_FOR_DIGITS)}


class _Folder(dict):
    """Code point -> folded character, filled on demand; signs keep their place until their neighbours are known."""

    def __missing__(self, c: int) -> str:
        ch = chr(c - 0xFEE0) if 0xFF01 <= c <= 0xFF5E else chr(c)
        ch = ch.lower()
        if len(ch) > 1:
            ch = ch[0]
        if ord(ch) in _LETTER:
            out = _LETTER[ord(ch)]
        elif ch.isalpha() or ord(ch) in _SIGN:
            out = ch
        else:
            out = " "
        self[c] = out
        return out


_FOLD = _Folder()
_ASCII = bytes(ord(_FOLD[c]) if c < 128 else 32 for c in range(256))


def fold(text: str) -> str:
    """The folded text with one space before, between and after its words."""
    flat = text.encode().translate(_ASCII).decode() if text.isascii() else text.translate(_FOLD)
    words = flat.split()
    if not flat.isascii() or any(d in flat for d in _DIGITS):
        words = [u for w in words if (u := w if w.isalpha() else _unmask(w))]
    return f" {' '.join(words)} " if words else " "


def _unmask(word: str) -> str:
    edge = word.strip("!@$")  # signs at a word's edge are punctuation
    if not any(c.isalpha() for c in edge):
        return ""
    return edge.translate(_SIGN)


def _folded(batches):
    """(text, toxic) -> (folded, near, toxic); near: what near copies share, null for a text without words."""
    for batch in batches:
        folded = [fold(t or "") for t in batch.column(0).to_pylist()]
        near = []
        for text in folded:
            raw = np.frombuffer(text.encode(), np.uint8)
            h = np.unique(Words(raw, np.array([0, len(raw)])).hashes(lower=False))
            near.append(b"".join(int(mix64(h ^ np.uint64(k * _ODD & _MASK)).min()).to_bytes(8, "big") for k in range(1, MIN_HASHES + 1)) if len(h) else None)
        yield pa.RecordBatch.from_arrays([pa.array(folded, pa.string()), pa.array(near, pa.binary()), batch.column(1)], names=["folded", "near", "toxic"])


def _entries(several, among):
    """(folded, near, bit) -> (near, found, n): entries of a task's texts, of those without near copies summed up under no near."""

    def run(batches):
        alone: Counter[str] = Counter()
        held: dict[bytes, set[str]] = {}

        def report():
            near, found = [None] * len(alone) + list(held), [[e] for e in alone] + [list(s) for s in held.values()]
            out = [pa.array(near, pa.binary()), pa.array(found, pa.list_(pa.string())), pa.array([*alone.values(), *(1 for _ in held)], pa.int64())]
            alone.clear()
            held.clear()
            return pa.RecordBatch.from_arrays(out, names=["near", "found", "n"])

        size = 0
        for batch in batches:
            shared = several.value[batch.column(2).to_numpy(zero_copy_only=False)].tolist()
            for text, near, again in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), shared):
                words = set(text.split())
                found = {f"{w} " for w in words} | {w[:k] for w in words for k in STEMS if len(w) > k}
                if among is not None:
                    found &= among.value
                if again:
                    own = held.setdefault(near, set())
                    size += len(found - own)
                    own |= found
                else:
                    alone.update(found)
                if len(alone) + size + len(held) >= FLUSH:
                    yield report()
                    size = 0
        if alone or held:
            yield report()

    return run


def _pairs(entries: set[str]):
    """Word pairs around an entry, with the label."""

    def run(batches):
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = text.split()
                held = [f"{w} " in entries or any(w[:k] in entries for k in STEMS) for w in words]
                pairs = sorted({f"{a} {b}" for a, b, x, y in zip(words, words[1:], held, held[1:]) if x or y})
                if pairs:
                    yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.string()), pa.array([toxic] * len(pairs), pa.int32())], names=["pair", "toxic"])

    return run


class Lexicon:
    """Entries with weights, exceptions, and the automaton over both."""

    def __init__(self, weights: dict[str, float], exceptions: list[str]):
        self.automaton = ahocorasick.Automaton()
        for e, w in weights.items():
            self.automaton.add_word(" " + e, (len(e) + 1, w))
        for e in exceptions:
            self.automaton.add_word(f" {e} ", (len(e) + 2, 0.0))
        if len(self.automaton):
            self.automaton.make_automaton()

    def weigh(self, text: str) -> tuple[float, int, int]:
        """(matched weight, matches, words) of a text; of overlapping entries at one place the heaviest counts."""
        return self.weigh_folded(fold(text))

    def weigh_folded(self, folded: str) -> tuple[float, int, int]:
        words = folded.count(" ") - 1 if len(folded) > 1 else 0
        if not len(self.automaton):
            return 0.0, 0, words
        best: dict[int, float] = {}
        free: list[tuple[int, int]] = []
        for end, (size, weight) in self.automaton.iter(folded):
            start = end - size + 1
            if weight:
                best[start] = max(best.get(start, 0.0), weight)
            else:
                free.append((start, end))
        if free:  # the exceptions as one union of spans, so that a long text costs no more than its matches
            inside, reach, spans = [], -1, iter(sorted(free))
            a, b = next(spans)
            for start in sorted(best):
                while a is not None and a <= start:
                    reach = max(reach, b)
                    a, b = next(spans, (None, None))
                if start < reach:
                    inside.append(start)
            for start in inside:
                del best[start]
        return math.fsum(best.values()), len(best), words


def inputs(weight: np.ndarray, hits: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(weight)), np.log1p(100 * weight / (words + 20)), np.log1p(weight), np.minimum(hits, 1)], axis=1)


def _step(beta: np.ndarray):
    """(toxic, weight, hits, words, n) -> (slope and curvature of the likelihood at ``beta``, summed in the task)."""

    def run(batches):
        total = np.zeros(len(beta) * (len(beta) + 1))
        for batch in batches:
            y, weight, hits, words, n = (batch.column(k).to_numpy(zero_copy_only=False).astype(float) for k in range(5))
            x = inputs(weight, hits, words)
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            total += np.concatenate([x.T @ (n * (y - p)), ((x * (n * p * (1 - p))[:, None]).T @ x).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["x"])

    return run


def _curve(rows: DataFrame, k: int = 4, ridge: float = 0.05) -> np.ndarray:
    """Logistic regression by Newton steps; slopes are kept at or above 0, so more weight never lowers a score."""
    active = np.ones(k, bool)
    while True:
        beta = np.zeros(k)
        for _ in range(50):
            got = rows.mapInArrow(_step(beta), "x array<double>").collect()  # a row a task, of which there are few
            total = np.sum([r.x for r in got], axis=0)
            slope, curvature = total[:k], total[k:].reshape(k, k)
            step = np.linalg.solve(curvature[np.ix_(active, active)] + ridge * np.eye(int(active.sum())), slope[active] - ridge * beta[active])
            beta[active] += step
            if np.abs(step).max() < 1e-8:
                break
        wrong = (beta < 0) & (np.arange(k) > 0)
        if not wrong.any():
            return beta
        active &= ~wrong


class Model:
    def __init__(self, weights: dict[str, float], exceptions: list[str], curve: list[float]):
        self.weights, self.exceptions, self.curve = weights, exceptions, curve

    def lexicon(self) -> Lexicon:
        return Lexicon(self.weights, self.exceptions)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn from labelled rows (``labels``: id and a 0/1 label, null is no label)."""
    known = labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("toxic")).where("toxic in (0, 1) and i is not null")
    known = checkpoint(known.groupBy("i").agg(F.max("toxic").alias("toxic")))
    few_labels = known.count() <= SENT
    texts = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(known) if few_labels else known, "i").select("text", "toxic")
    texts = checkpoint(texts.mapInArrow(_folded, "folded string, near binary, toxic int"))
    bit = F.expr(f"cast(pmod(xxhash64(near, toxic), {FILTER_BITS}) as int)").alias("bit")
    groups = checkpoint(texts.groupBy("near", "toxic").agg(F.count("*").alias("n")))
    sizes = {r.toxic: (r.groups, r.texts) for r in groups.groupBy("toxic").agg(F.count("near").alias("groups"), F.sum("n").alias("texts")).collect()}
    n1, n0 = (sizes.get(k, (0, 0))[0] for k in (1, 0))
    if not n1 or not n0:
        return Model({}, [], [-30.0 if not n1 else 30.0, 0.0, 0.0, 0.0])
    # a bit map of fixed size: whoever isn't in it has no near copy and is summed up in its task; the others are told apart by what they share
    map_ = np.zeros(FILTER_BITS, bool)
    map_[groups.where("n > 1 and near is not null").select(bit).distinct().toArrow().column("bit").to_numpy()] = True
    context = docs.sparkSession.sparkContext
    several = context.broadcast(map_)

    def counted(toxic: int, among=None) -> DataFrame:
        own = texts.where((F.col("toxic") == toxic) & F.col("near").isNotNull()).select("folded", "near", bit)
        found = own.mapInArrow(_entries(several, among), "near binary, found array<string>, n long").select("near", F.explode("found").alias("e"), "n")
        once = found.groupBy("near", "e").agg(F.sum("n").alias("n"))
        return once.groupBy("e").agg(F.sum(F.expr("if(near is null, n, 1)")).alias("n"))

    least = max(3, math.ceil(MIN_SHARE * n1))
    rows = counted(1).where(F.col("n") >= least).collect()  # at most what toxic documents have on average over MIN_SHARE
    others = {r.e: r.n for r in counted(0, context.broadcast({r.e for r in rows})).collect()}
    rows.sort(key=lambda r: r.e)
    t, c = np.array([r.n for r in rows], float), np.array([others.get(r.e, 0) for r in rows], float)

    def cell(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / expected), 0.0)

    # likelihood ratio of the 2 x 2 table, for entries that speak for the label
    share, n = n1 / (n1 + n0), t + c
    rest = np.maximum(n1 + n0 - n, 1e-300)
    g = 2 * (cell(t, n * share) + cell(c, np.maximum(n * (1 - share), 1e-300)) + cell(n1 - t, rest * share) + cell(n0 - c, rest * (1 - share)))
    odds = np.log(((t + 0.5) / (n1 + 1)) / ((c + 0.5) / (n0 + 1)))
    weights = {rows[k].e: float(odds[k]) for k in np.flatnonzero((odds > 2.5) & (g >= MIN_G)).tolist()}
    pairs = texts.select("folded", "toxic").mapInArrow(_pairs(set(weights)), "pair string, toxic int").groupBy("pair").agg(F.avg("toxic").alias("share"), F.count("*").alias("n"))
    support = max(5, math.ceil(PAIR_SHARE * sum(x for _, x in sizes.values())))
    exceptions = sorted(r.pair for r in pairs.where(f"n >= {support} and share <= {share / 2}").collect())

    raw = texts.select("folded", "toxic").mapInArrow(_weigher(weights, exceptions, keep=["toxic"], folded=True), "toxic int, weight double, hits long, words long")
    raw = raw.withColumn("words", F.expr("if(hits = 0, 0, words)"))  # which a text without a match doesn't depend on
    raw = checkpoint(raw.groupBy("toxic", "weight", "hits", "words").agg(F.count("*").alias("n")))
    curve = _curve(few(raw, raw.count(), TASK_ROWS))
    return Model(weights, exceptions, [float(b) for b in curve])


def _weigher(weights: dict[str, float], exceptions: list[str], keep: list[str], text: int = 0, folded: bool = False):
    def run(batches):
        lexicon = Lexicon(weights, exceptions)
        weigh = lexicon.weigh_folded if folded else lexicon.weigh
        for batch in batches:
            out = [weigh(batch.column(text)[k].as_py() or "") for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in keep), *(pa.array([r[k] for r in out], t) for k, t in enumerate((pa.float64(), pa.int64(), pa.int64())))],
                names=[*keep, "weight", "hits", "words"],
            )

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score, predicted, weight, hits, words) for every row of ``docs``."""
    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(F.col(text_col).cast("string").alias("__text"), id_col).mapInArrow(
        _weigher(model.weights, model.exceptions, [id_col]), f"`{id_col}` {kind}, weight double, hits long, words long"
    )
    b = model.curve
    z = F.lit(b[0]) + b[1] * F.log1p(100 * F.col("weight") / (F.col("words") + 20)) + b[2] * F.log1p("weight") + b[3] * F.least("hits", F.lit(1))
    found = found.withColumn("score", 1 / (1 + F.exp(-z)))
    return found.select(id_col, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "weight", "hits", "words")


def held_out(id_col: str = "doc_id", folds: int = 5):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: learned outside the fold crc32(doc_id) mod 5 = 0, applied to every text of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted", "weight", "hits", "words")
