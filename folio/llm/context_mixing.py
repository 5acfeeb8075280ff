"""LM scoring by logistic context mixing over bits (op 9).

A text is a sequence of lower-cased words and one end. A word is spelt bit by bit, each byte from its high bit on, with a
closing zero byte. For every bit, predictors look into hashed tables of bit counts under contexts of
``ORDERS`` bytes before it in the word (and the word's beginning so far); each gives a stretched
probability and a confidence. A gate (the byte's place in the word and the bit's place in the byte) picks a set of
weights; the weighted sum is squashed, and a last adaptive stage refines it by interpolating in a
table over (gate, probability). The bits of a word multiply to ``s(w)``, which sums to 1 over all words.

Before a word is chosen its class is: ``word_contexts`` mixes predictors whose contexts are the words before it into
``q(class | words before)``, and an expert's probability of the word becomes ``p(w) / P(class) * q(class | words before)``, where ``P`` is the expert's own sum
over the class; words that training never met are taken to fall in all classes alike. So contexts cross words, and the sum over all words stays 1.

Over the spelling stands the word's own count, interpolated by absolute discounting:
``p(w) = (c - d) / N + d * V / N * s(w)``, so that words which training never met are spelt out. Above
it stand experts, one for each value of a training column (a language), whose
counts are interpolated with ``p`` in the same way. The experts are mixed online within a text: before
each word a gate holds every expert's weight, and after it the weight is multiplied by the probability
that the expert gave. The product of these mixed predictions over a text is ``sum_k prior_k * prod_i p_k(w_i)``
whatever the order of the words (and times the classes' ``q``, which all experts share), which is how it is computed: by one sum for each expert and text. A text's score
is its log10; bits per byte follow from it. The column is read of training texts only.

**Learning.** Word counts come from *all* whole training texts (a shuffle by word that grows with the
corpus); the predictors' tables count the bits of *all* distinct training words, summed in Spark. The
mixing weights are learned online in two passes over *all* distinct training words, each with its own counts left
out (a word would else be predicted from itself): after every chunk of words a task makes a Newton step for each gate with all curvature it has met. Tasks'
weights are merged by their curvature, their refining tables by their sums. A distinct word counts once there, as in the tables: the mass that the discount frees for spelling is one share for each distinct
word, whatever its frequency. The word contexts are learned from all tokens of all training texts, in two passes more.

**Scale.** The most frequent words (``HEAD`` at most) with their scores are broadcast; all others
are summed per text, shuffled by word and joined with the vocabulary. The tables' size is fixed. The merged weights depend a little on how words are dealt out to tasks.

Null and empty texts consist of the end alone. Ties of the head's counts are in or out of it together, which changes no score. Repeated
rows are scored each; null ids are scored too; a null language has no expert of its own; of extra columns none is read; an empty table gives
an empty one; a very long text is scored whole, a slice at a time. Without any training text all counts are 0: the base
score is then -log10 V of a vocabulary of one unknown, and the model only spells.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import word_contexts
from folio.llm.common import Words, arrow_rows, checkpoint, few, heaviest, mix64, signed, slices, table, tidy

ORDERS = (1, 2, 3, 4)
BITS = 17  # log2 of a table's slots
HEAD = 200_000
RIDGE = 20.0  # pull of a pass to the weights it starts from
PASSES = 2
ALL = 0.05  # prior of the expert that knows no language
TASK_WORDS = 1_000_000  # distinct words that a task learns from, or more if there are fewer tasks than cores
FLUSH = 400_000  # distinct words that a task counts before it reports
FLUSH_BYTES = 1 << 25  # and their bytes
RUN_BYTES = 1 << 20  # bytes that are copied out of texts at a time
END = b"\n"  # no word contains it
CELLS = 33
LN10 = float(np.log(10))


def _squash(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _paired(x: np.ndarray) -> np.ndarray:
    """Pairs of inputs, in the last dimension, as numbers of 64 bits, which a lookup copies at once."""
    return np.ascontiguousarray(x, np.float32).view(np.int64)[..., 0]


def _spelling(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all words, each after a zero and closed by one, as one row a byte; lengths with the closing zero)."""
    data = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
    return data, np.array([len(w) + 1 for w in words], np.int64)


class Bits:
    """The bits of words in spelling order: slots of every predictor, gates and values."""

    def __init__(self, words: list[bytes]):
        data, sizes = _spelling(words)
        n = len(data)
        start = np.cumsum(sizes) - sizes
        self.word = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(n) - start[self.word]
        wide = data.astype(np.uint64)
        contexts = []
        history = np.zeros(n, np.uint64)
        for k in range(1, max(ORDERS) + 1):  # byte k before, within the word; before its beginning a mark
            before = np.zeros(n, np.uint64)
            before[k:] = wide[:-k]
            before[place < k] = 256
            history = history * np.uint64(0x100000001B3) + before + np.uint64(1)
            if k in ORDERS:
                contexts.append(mix64(history + np.uint64(k << 48)))
        total = np.zeros(n + 1, np.uint64)  # the beginning so far, with the places of its bytes
        np.cumsum(mix64((wide << np.uint64(8)) + np.minimum(place, 255).astype(np.uint64)), out=total[1:])
        contexts.append(mix64(total[:-1] - total[start][self.word] + np.uint64(77)))
        self.value = np.unpackbits(data).reshape(n, 8)
        node = np.ones((n, 8), np.uint64)  # the byte's bits so far
        for b in range(1, 8):
            node[:, b] = node[:, b - 1] * np.uint64(2) + self.value[:, b - 1]
        shift = np.uint64(64 - BITS)
        self.slots = [((c[:, None] ^ (node * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93) >> shift).astype(np.int32) for c in contexts]
        self.gate = (np.minimum(place, 7)[:, None] * 8 + np.arange(8)).astype(np.int32)


PREDICTORS = len(ORDERS) + 1


def count_bits(words: list[bytes]) -> np.ndarray:
    """(predictor, bit, slot) counts of the bits of distinct words."""
    out = np.zeros((PREDICTORS, 2, 1 << BITS), np.int32)
    bits = Bits(words)
    one = bits.value.astype(bool)
    for k, s in enumerate(bits.slots):
        out[k, 0] += np.bincount(s[~one], minlength=1 << BITS).astype(np.int32)
        out[k, 1] += np.bincount(s[one], minlength=1 << BITS).astype(np.int32)
    return out


class Speller:
    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.weights = np.full((64, 2 * PREDICTORS), 0.0)
        self.weights[:, ::2] = 0.4
        self.refine = self.prior = np.tile(_squash((np.arange(CELLS) - CELLS // 2) / 2.0), (64, 1)).astype(np.float32)
        self._tables: np.ndarray | None = None
        self._without: np.ndarray | None = None

    def __getstate__(self):
        return self.__dict__ | {"_tables": None, "_without": None}

    @staticmethod
    def _inputs(n0, n1):
        st = np.log((n1 + 0.2) / (n0 + 0.2))  # not by way of a probability, which single precision rounds to 1 from some 8 million bits of one value on
        return st, st * np.minimum(1, (n0 + n1) / (n0 + n1 + 8.0))

    def _left_out(self) -> np.ndarray:
        """(predictor, slot * 2 + value): the inputs of a counted bit without itself, each pair as one number."""
        if self._without is None:
            n0, n1 = self.counts[:, 0].astype(np.float32), self.counts[:, 1].astype(np.float32)
            zero = np.stack(self._inputs(np.maximum(n0 - 1, 0), n1), axis=-1)
            one = np.stack(self._inputs(n0, np.maximum(n1 - 1, 0)), axis=-1)
            self._without = _paired(np.stack([zero, one], axis=2).reshape(PREDICTORS, -1, 2))
        return self._without

    def _learning(self, words: list[bytes]):
        """(inputs, values, gates) of the bits of words that the tables have counted, each without itself, gate by gate."""
        bits, tables = Bits(words), self._left_out()
        gate = bits.gate.ravel()
        by = np.argsort(gate.astype(np.uint8), kind="stable")
        y = bits.value.ravel()[by]
        x = np.empty((len(y), PREDICTORS), np.int64)
        for k, s in enumerate(bits.slots):
            x[:, k] = tables[k][s.ravel()[by] * 2 + y]
        return x.view(np.float32), y.astype(np.float32), gate[by]

    def learn(self, chunks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One online pass over chunks of words: (curvature, weights, refining sums).

        After every chunk each gate makes a Newton step with all curvature it has met, of at most a half; the bits' shares between two
        cells are summed with the weights of before the step.
        """
        weights = self.weights.copy()
        curve = np.tile(RIDGE * np.eye(2 * PREDICTORS), (64, 1, 1))
        sums = np.zeros((2, 64, CELLS))
        for words in chunks:
            x, y, gate = self._learning(words)
            ends = np.searchsorted(gate, np.arange(65))
            for g in range(64):
                z, v = x[ends[g] : ends[g + 1]], y[ends[g] : ends[g + 1]]
                if not len(v):
                    continue
                dot = z @ weights[g].astype(np.float32)
                q = _squash(dot)
                low, part = self._cell(dot)
                for cell, share in ((low, 1 - part), (low + 1, part)):
                    sums[0, g] += np.bincount(cell, share * v, minlength=CELLS)
                    sums[1, g] += np.bincount(cell, share, minlength=CELLS)
                curve[g] += (z * (q * (1 - q))[:, None]).T @ z
                change = np.linalg.solve(curve[g], ((v - q) @ z).astype(np.float64))
                weights[g] += change / max(1, 2 * np.abs(change).max())  # far from the maximum a whole step overshoots
        return curve, weights, sums

    def set(self, curve: np.ndarray, pulled: np.ndarray, sums: np.ndarray) -> None:
        """Weights merged by curvature, from the tasks' sums of curvature and of curvature times weights; then the refining table."""
        self.weights = np.linalg.solve(curve, pulled[:, :, None])[:, :, 0]
        self.refine = ((sums[0] + 2 * self.prior) / (sums[1] + 2)).astype(np.float32)

    @staticmethod
    def _cell(dot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.clip(dot * 2 + CELLS // 2, 0, CELLS - 1.001)
        low = at.astype(np.int32)
        return low, at - low

    def log10(self, words: list[bytes]) -> np.ndarray:
        """log10 s(w) of each word, with the frozen weights."""
        if self._tables is None:
            tables = [self._inputs(c[0].astype(np.float32), c[1].astype(np.float32)) for c in self.counts]
            self._tables = _paired(np.stack([np.stack(t, axis=1) for t in tables]))
        bits = Bits(words)
        gate = bits.gate.ravel()
        dot, weights = np.zeros(len(gate), np.float32), _paired(self.weights.reshape(64, PREDICTORS, 2))
        for k, s in enumerate(bits.slots):
            x = self._tables[k][s.ravel()].view(np.float32)
            x *= np.ascontiguousarray(weights[:, k])[gate].view(np.float32)
            dot += x[::2] + x[1::2]
        low, part = self._cell(dot)
        p = 0.5 * _squash(dot) + 0.5 * ((1 - part) * self.refine[gate, low] + part * self.refine[gate, low + 1])
        p = np.clip(p, 1e-6, 1 - 1e-6).reshape(bits.value.shape)
        chosen = np.log(np.where(bits.value == 1, p, 1 - p)).sum(1)
        return np.bincount(bits.word, chosen, minlength=len(words)) / LN10


def _runs(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of runs, one after the other; every byte takes 24 more while its place is looked up, so ``RUN_BYTES`` of them at a time."""
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    i = 0
    while i < len(size):
        done = int(ends[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(ends, done + RUN_BYTES, side="right")))
        if j == i + 1:
            out[done : ends[i]] = data[start[i] : start[i] + size[i]]
        else:
            out[done : ends[j - 1]] = data[np.repeat(start[i:j] - (ends[i:j] - size[i:j]), size[i:j]) + np.arange(done, int(ends[j - 1]))]
        i = j
    return out


def _count_words(batches):
    """(text, expert; -1 for a text that isn't learned from) -> (h, word, e, c): distinct words of a run of texts with their counts."""
    held: list[tuple] = []  # of a slice: its words' hashes, experts, counts, lengths and bytes
    room = [FLUSH, FLUSH_BYTES]

    def merge():
        h, e, c, size, text = (np.concatenate([own[k] for own in held]) for k in range(5))
        _, first, back = np.unique(mix64(h + (e + 2).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True, return_inverse=True)
        start = np.cumsum(size) - size
        held[:] = [(h[first], e[first], np.bincount(back, c, len(first)).astype(np.int64), size[first], _runs(text, start[first], size[first]))]
        return len(first) >= FLUSH or len(held[0][4]) >= FLUSH_BYTES

    def report():
        h, e, c, size, text = held.pop()
        word = pa.Array.from_buffers(pa.binary(), len(h), [None, pa.py_buffer(np.append(0, np.cumsum(size)).astype(np.int32)), pa.py_buffer(text)])
        return pa.RecordBatch.from_arrays([pa.array(signed(h)), word, pa.array(e, pa.int32()), pa.array(c)], names=["h", "word", "e", "c"])

    for batch in batches:
        expert = batch.column(1).to_numpy(zero_copy_only=False)
        for i, j, data, offsets in slices(batch.column(0), word_contexts.TEXT_BYTES):
            w = Words(data, offsets)
            h = w.hashes(lower=True)
            e = np.repeat(expert[i:j], np.diff(w.at))
            _, first, counts = np.unique(mix64(h + (e + 2).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True, return_counts=True)
            size = (w.end - w.start)[first]
            held.append((h[first], e[first], counts, size, _runs(np.frombuffer(data.tobytes().lower(), np.uint8), w.start[first], size)))
            if sum(len(own[0]) for own in held) >= room[0] or sum(len(own[4]) for own in held) >= room[1]:
                if merge():
                    yield report()
                # half as much again, or words that come in every slice would be merged over and over
                room = [max(FLUSH, len(held[0][0]) + FLUSH // 2), max(FLUSH_BYTES, len(held[0][4]) + FLUSH_BYTES // 2)] if held else [FLUSH, FLUSH_BYTES]
    if held:
        merge()
        yield report()


def _bit_counts(batches):
    """(word, c) of training words -> (slot, zeros, ones) of all tables, summed in the task."""
    total = np.zeros((PREDICTORS, 2, 1 << BITS), np.int32)
    for batch in batches:
        words = batch.column(0).to_pylist()
        for i in range(0, len(words), 8192):
            total += count_bits(words[i : i + 8192])
    zeros, ones = total[:, 0].ravel(), total[:, 1].ravel()
    used = np.flatnonzero(zeros + ones)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(zeros[used], pa.int64()), pa.array(ones[used], pa.int64())], names=["slot", "zeros", "ones"])


def _learned(speller):
    """(word) of all distinct training words -> (at, x): a task's curvature, pulled weights and refining sums, by place in the flat array."""

    def run(batches):
        def chunks():
            for batch in batches:
                words = batch.column(0).to_pylist()
                for i in range(0, len(words), 4096):
                    yield words[i : i + 4096]

        curve, weights, sums = speller.value.learn(chunks())
        if sums.any():
            flat = np.concatenate([curve.ravel(), np.einsum("gij,gj->gi", curve, weights).ravel(), sums.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat)], names=["at", "x"])

    return run


def _learn(words: DataFrame, speller: Speller) -> None:
    """Weights and refining table from all distinct training words, online within tasks; what comes to the driver has a fixed size."""
    k = 2 * PREDICTORS
    sizes = [64 * k * k, 64 * k, 2 * 64 * CELLS]
    for _ in range(PASSES):  # the second one starts from the merged weights, so that its refining table fits what is scored with
        model = words.sparkSession.sparkContext.broadcast(speller)
        got = words.mapInArrow(tidy(_learned(model)), "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).toArrow()
        model.unpersist()
        if not len(got):
            return
        flat = np.zeros(sum(sizes))
        flat[got.column("at").to_numpy()] = got.column("x").to_numpy()
        curve, pulled, sums = np.split(flat, np.cumsum(sizes)[:-1])
        speller.set(curve.reshape(64, k, k), pulled.reshape(64, k), sums.reshape(2, 64, CELLS))


class Counts:
    """N and V of all training tokens and of each expert's, the discount, and the experts' priors."""

    def __init__(self, n: int, v: int, own_n: list[int], own_v: list[int], discount: float, texts: list[int]):
        self.n, self.v, self.own_n, self.own_v, self.discount = n, v, own_n, own_v, discount
        total = max(1, sum(texts))
        self.prior = [np.log10(ALL), *(np.log10((1 - ALL) * t / total) if t else -np.inf for t in texts)]
        if not n:
            self.prior[0] = 0.0

    def log10(self, c: np.ndarray, own: np.ndarray, spelt: np.ndarray) -> np.ndarray:
        """One row for the expert of all, and one for each expert."""

        def discounted(c, n, v, lower):
            if not n:
                return lower
            return np.logaddexp(np.log(np.maximum(np.maximum(c - self.discount, 0) / n, 1e-300)), np.log(self.discount * v / n) + lower * LN10) / LN10

        whole = discounted(c, self.n, self.v, spelt)
        return np.stack([whole, *(discounted(own[k], n, v, whole) for k, (n, v) in enumerate(zip(self.own_n, self.own_v)))])


def _word_scores(speller, counts: Counts):
    """(h, word, c, own) -> (h, c, p0, p1, ...): log10 p(w) by each expert."""

    def run(batches):
        model = speller.value
        for batch in batches:
            words, c = batch.column(1).to_pylist(), batch.column(2).to_numpy(zero_copy_only=False)
            spelt = np.concatenate([model.log10(words[i : i + 2048]) for i in range(0, len(words), 2048)]) if words else np.zeros(0)
            own = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(len(words), -1).T
            p = counts.log10(c, own, spelt)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array(x) for x in p)], names=["h", "c", *(f"p{k}" for k in range(len(p)))])

    return run


def base_log10(c, n: int, v: int):
    return np.log10((c + 0.1) / (n + 0.1 * (v + 1)))


def _texts(head, end: tuple[float, np.ndarray, int], contexts):
    """(id, text) -> one summary row a text (no h), and its words outside the head (h, n)."""

    def run(batches):
        keys, base, model, known = head.value
        mixer, in_class = contexts.value  # and each expert's log10 P(class)
        for batch in batches:
            for i, j, data, offsets in slices(batch.column(1), word_contexts.TEXT_BYTES):
                w = Words(data, offsets)
                h = w.hashes(lower=True)
                tokens = word_contexts.Tokens(w, h)
                chosen = np.bincount(tokens.text, mixer.log10(tokens), minlength=j - i)
                shared = [chosen - np.bincount(tokens.text, p[tokens.of], minlength=j - i) for p in in_class]
                h = signed(h)
                at = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
                inside = keys[at] == h if len(keys) else np.zeros(len(h), bool)
                which = np.repeat(np.arange(j - i), np.diff(w.at))
                met, where = which[inside], at[inside]
                ids = batch.column(0)[i:j]
                out = which[~inside]
                order = np.lexsort((h[~inside], out))
                o, k = out[order], h[~inside][order]
                new = np.ones(len(o), bool)
                new[1:] = (o[1:] != o[:-1]) | (k[1:] != k[:-1])
                first = np.flatnonzero(new)
                m = len(first)

                def column(summary, other=0, kind=np.float64, m=m):
                    return pa.array(np.concatenate([summary, np.broadcast_to(other, m)]).astype(kind))

                def total(values, plus, met=met, where=where, n=j - i):
                    return (np.bincount(met, values[where], minlength=n) if len(values) else np.zeros(n)) + plus

                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([ids, ids.take(pa.array(o[first]))]),
                        pa.array(np.concatenate([np.zeros(j - i, np.int64), k[first]]), mask=np.arange(j - i + m) < j - i),
                        column(np.diff(w.at) + 1, np.diff(np.append(first, len(o))), np.int64),
                        column(np.diff(offsets), kind=np.int64),
                        column(total(known, end[2]), kind=np.int64),
                        column(total(base, end[0])),
                        *(column(total(p, e) + x) for p, e, x in zip(model, end[1], shared)),
                    ],
                    names=["id", "h", "n", "bytes", "known", "base", *(f"m{k}" for k in range(len(model)))],
                )

    return run


def lm_scores(docs: DataFrame, trains, id_col: str = "doc_id", text_col: str = "text", expert_col: str | None = "lang") -> DataFrame:
    """id_col, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every row of ``docs``.

    ``trains``: boolean column, who is learned from. Different texts under one id are scored apart.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    group = F.col(expert_col).cast("string") if expert_col else F.lit(None).cast("string")
    texts = docs.select(
        F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("t")).alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.coalesce(trains, F.lit(False)).alias("trains"),
        group.alias("of"),
    )
    sizes = texts.where("trains").groupBy("of").count()
    ends = sizes.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n")).first().n
    top = [r for r in sizes.where("of is not null").orderBy(F.desc("count"), "of").collect()]
    own_ends = [r["count"] for r in top] or [0]
    expert = F.when(~F.col("trains"), -1)
    for k, r in enumerate(top):
        expert = expert.when(F.col("of") == r.of, k)
    k_all = range(len(own_ends))
    with arrow_rows(spark, word_contexts.TEXT_ROWS):
        vocabulary = checkpoint(
            texts.select("text", expert.otherwise(len(own_ends)).alias("e"))
            .mapInArrow(tidy(_count_words), "h long, word binary, e int, c long")
            .groupBy("h", "word")
            .agg(F.sum(F.expr("if(e < 0, 0, c)")).alias("c"), F.array(*(F.sum(F.expr(f"if(e = {k}, c, 0)")) for k in k_all)).alias("own"))
        )
    met = vocabulary.where("c > 0")
    total = met.agg(
        *(F.coalesce(F.sum(x), F.lit(0)) for x in ("c", "1", "if(c = 1, 1, 0)", "if(c = 2, 1, 0)") for x in [F.expr(x)]),
        *(F.coalesce(F.sum(F.expr(x)), F.lit(0)) for k in k_all for x in (f"own[{k}]", f"if(own[{k}] > 0, 1, 0)")),
    ).first()
    n, v, once, twice = total[0] + ends, total[1] + (ends > 0), total[2], total[3]
    own_n, own_v = [x + e for x, e in zip(total[4::2], own_ends)], [x + (e > 0) for x, e in zip(total[5::2], own_ends)]
    counts = Counts(n, v, own_n, own_v, min(0.95, max(0.1, once / max(1, once + 2 * twice))), own_ends)

    slots = PREDICTORS << BITS
    learned_from = few(met.select("word"), total[1], TASK_WORDS)
    got = learned_from.mapInArrow(tidy(_bit_counts), "slot int, zeros long, ones long").groupBy("slot").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones")).toArrow()
    bits = np.zeros((2, slots), np.int64)
    where = got.column("slot").to_numpy()
    bits[0, where], bits[1, where] = got.column("zeros").to_numpy(), got.column("ones").to_numpy()
    speller = Speller(np.ascontiguousarray(np.minimum(bits, 1 << 30).astype(np.int32).reshape(2, PREDICTORS, 1 << BITS).transpose(1, 0, 2)))
    _learn(learned_from, speller)
    spelt = spark.sparkContext.broadcast(speller)

    p_names = [f"p{k}" for k in range(len(own_ends) + 1)]
    scored = checkpoint(vocabulary.mapInArrow(tidy(_word_scores(spelt, counts)), ", ".join(["h long, c long", *(f"{p} double" for p in p_names)])))
    head = heaviest(scored.where("c > 0"), "c", HEAD).toArrow()
    by = np.argsort(head.column("h").to_numpy())
    c = head.column("c").to_numpy()[by]
    known = spark.sparkContext.broadcast((head.column("h").to_numpy()[by], base_log10(c, n, v), [head.column(p).to_numpy()[by] for p in p_names], np.ones(len(c))))
    end_own = np.array([[e] for e in own_ends])
    end = (float(base_log10(ends, n, v)), counts.log10(np.array([ends]), end_own, speller.log10([END]))[:, 0], int(ends > 0))

    of = F.shiftrightunsigned("h", 64 - word_contexts.DEPTH).cast("int").alias("of")
    sums = scored.where("c > 0").groupBy(of).agg(*(F.sum(F.pow(F.lit(10.0), p)).alias(p) for p in p_names)).collect()  # a row a class
    in_class = np.zeros((len(p_names), word_contexts.CLASSES))
    for r in sums:
        in_class[:, r.of] = [r[p] for p in p_names]
    in_class[:, word_contexts.END_CLASS] += 10.0 ** end[1]
    in_class += np.maximum(1 - in_class.sum(1, keepdims=True), 1e-12) / word_contexts.CLASSES
    mixer = word_contexts.train(texts.where("trains").select("text"), n)
    contexts = spark.sparkContext.broadcast((mixer, np.log10(in_class)))

    m_names = [f"m{k}" for k in range(len(p_names))]
    rows = texts.select("id", "text").mapInArrow(
        tidy(_texts(known, end, contexts)), f"id struct<id:{kind},t:bigint>, h long, n long, bytes long, known long, base double, " + ", ".join(f"{m} double" for m in m_names)
    )
    weight = float(np.log10(n + 0.1 * (v + 1)))
    # texts' own rows go through the join without a partner, under keys of their own that spread them: so the texts are scored once, not for each side of a union
    keyed = rows.withColumn("own", F.col("h").isNull()).withColumn("h", F.coalesce("h", F.xxhash64("id")))
    met = keyed.join(scored.withColumnRenamed("c", "met").withColumnRenamed("h", "w"), (F.col("h") == F.col("w")) & ~F.col("own"), "left")
    zero, none = F.lit(0).cast("long"), F.lit(0.0)
    each = met.select(
        "id",
        F.when(F.col("own"), F.col("n")).otherwise(zero).alias("n_tokens"),
        F.when(F.col("own"), F.col("bytes")).otherwise(zero).alias("bytes"),
        F.when(F.col("own"), F.col("known")).when(F.col("met") > 0, F.col("n")).otherwise(zero).alias("known"),
        F.when(F.col("own"), F.col("base")).otherwise(F.col("n") * (F.log10(F.coalesce("met", zero) + 0.1) - weight)).alias("base"),
        *(F.when(F.col("own"), F.col(m)).otherwise(F.coalesce(F.col("n") * F.col(p), none)).alias(m) for p, m in zip(p_names, m_names)),
    )
    # rows that are there several times share a key: their sums are divided among them
    sums = each.groupBy("id").agg(*(F.sum(x).alias(x) for x in ("n_tokens", "bytes", "known", "base", *m_names)), F.sum(F.expr("if(n_tokens > 0, 1, 0)")).alias("times"))
    parts = [F.col(m) / F.col("times") + F.lit(float(b)) for m, b in zip(m_names, counts.prior) if np.isfinite(b)]
    most = F.greatest(*parts) if len(parts) > 1 else parts[0]
    out = sums.withColumn("most", most).select(
        "id",
        F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))),
        *(F.expr(f"{x} div times").alias(x) for x in ("n_tokens", "known", "bytes")),
        (F.col("base") / F.col("times")).alias("base_score"),
        (F.col("most") + F.log10(sum((F.pow(F.lit(10.0), x - F.col("most")) for x in parts), F.lit(0.0)))).alias("score"),
    )
    return out.select(
        F.col("id.id").alias(id_col),
        "n_tokens",
        F.col("known").alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.when(F.col("bytes") > 0, -F.col("score") * float(np.log2(10)) / F.col("bytes")).alias("bits_per_byte"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: learned outside the fold crc32(doc_id) mod 10 = 0, every text of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    scores = lm_scores(docs, ~out)
    return scores.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
