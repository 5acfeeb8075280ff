"""Online logistic mixing of word contexts (part of op 9): which class the next word falls in.

A word's class is the first ``DEPTH`` bits of its hash. The bits are predicted one by one from the words before it: predictors whose contexts
are nothing, the word before, and the two words before look into tables of bit counts, whose rows are hashes of ``CONTEXT_BITS`` bits; each gives
a stretched probability and one scaled by its confidence. A gate (the bit's place, and how often it was met after the word before) picks the
weights; the weighted sum is squashed, and a last adaptive stage refines it by interpolating in a table over (gate, probability).

* **Counts** are sums of (context, class) over all training tokens; bits' counts follow from the classes'. A task reports each pair once.
* **Weights** are learned online in one pass over all training texts, each bit with its own count left out: after every slice of texts a task
  makes a Newton step for each gate with all curvature it has met, and refines its table with the weights of the moment. Tasks' weights are
  merged by their curvature, their tables by their sums. So they depend a little on how the texts are dealt out to tasks.
* **Scoring** uses the merged weights, the same for every text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import Words, arrow_rows, few, mix64, slices, tidy

DEPTH = 6
CLASSES = 1 << DEPTH
CONTEXT_BITS = (0, 14, 12)  # log2 of each predictor's contexts
CONTEXTS = len(CONTEXT_BITS)
SIZES = [CLASSES << b for b in CONTEXT_BITS]
BUCKETS = 3
GATES = DEPTH * BUCKETS
INPUTS = 2 * CONTEXTS
CELLS = 33
RIDGE = 50.0
TASK_TOKENS = 50_000_000
TEXT_BYTES = 1 << 19  # text worked on at a time; some 300 bytes of arrays go with a token
TEXT_ROWS = 500  # texts in an Arrow batch, where an action runs here
HELD_TOKENS = 400_000  # tokens that a task counts at a time, as the tables are long
LN10 = float(np.log(10))
_START, _END = np.uint64(0x5D1F8C2B9A3E4706), np.uint64(0xB3C64E0F9D2A1785)


def _squash(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def classes_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - DEPTH)).astype(np.int64)


END_CLASS = int(classes_of(np.array([_END]))[0])


class Tokens:
    """Tokens of a slice of texts, each text's words and one end: their classes, contexts and texts."""

    def __init__(self, words: Words, hashes: np.ndarray):
        n = len(words.at) - 1
        h = np.insert(hashes, words.at[1:], _END)
        first = words.at[:-1] + np.arange(n)
        one, two = np.empty_like(h), np.empty_like(h)
        one[1:], two[2:] = h[:-1], h[:-2]
        one[first], two[first] = _START, _START
        two[first[np.diff(words.at) > 0] + 1] = _START
        self.text = np.repeat(np.arange(n), np.diff(words.at) + 1)
        self.of = classes_of(h)
        names = [mix64(one + np.uint64(1)), mix64(mix64(one + np.uint64(2)) ^ two)]
        # the place of a context's row of classes
        self.rows = [np.zeros(len(h), np.int64)] + [(x >> np.uint64(64 - b)).astype(np.int64) << DEPTH for x, b in zip(names, CONTEXT_BITS[1:])]

    def bit(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(each token's node at a depth, its bit there)."""
        return (1 << depth) | (self.of >> (DEPTH - depth)), self.of >> (DEPTH - 1 - depth) & 1


def count_classes(*tokens: Tokens) -> np.ndarray:
    """Counts of all predictors' (context, class), one table after the other."""
    out = np.zeros(sum(SIZES), np.int64)
    for k, own in enumerate(np.split(out, np.cumsum(SIZES)[:-1])):
        own += np.bincount(np.concatenate([t.rows[k] + t.of for t in tokens]), minlength=SIZES[k])
    return out


def node_counts(classes: np.ndarray) -> np.ndarray:
    """(context * CLASSES + node, value) from a table of (context, class)."""
    own = classes.reshape(-1, CLASSES)
    out = np.zeros((len(own), CLASSES, 2))
    for d in range(DEPTH):
        out[:, 1 << d : 2 << d] = own.reshape(len(own), 1 << d, 2, -1).sum(3)
    return out.reshape(-1, 2)


class Mixer:
    def __init__(self, counts: np.ndarray):
        n = [node_counts(c).astype(np.float32) for c in np.split(counts, np.cumsum(SIZES)[:-1])]
        self.met = np.minimum(n[1].sum(1), 255).astype(np.int16)
        self.tables = [self._inputs(x[:, 0], x[:, 1]) for x in n]
        # the inputs of a bit that is itself counted, without it: by node and value
        self.left_out = [
            np.stack([self._inputs(np.maximum(x[:, 0] - 1, 0), x[:, 1]), self._inputs(x[:, 0], np.maximum(x[:, 1] - 1, 0))], axis=1).reshape(-1, 2) for x in n
        ]
        self.weights = np.zeros((GATES, INPUTS))
        self.weights[:, 0] = 1.0
        self.refine = np.tile(_squash((np.arange(CELLS) - CELLS // 2) / 2.0), (GATES, 1))
        self._shares: list[np.ndarray] | None = None

    @staticmethod
    def _inputs(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
        st = np.log((n1 + 0.4) / (n0 + 0.4))  # see context_mixing: a probability would be rounded to 1
        return np.stack([st, st * (n0 + n1) / (n0 + n1 + 4.0)], axis=-1).astype(np.float32)

    @staticmethod
    def _bucket(met: np.ndarray) -> np.ndarray:
        return (met > 0).astype(np.int64) + (met >= 4)

    @staticmethod
    def _cell(dot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.clip(dot * 2 + CELLS // 2, 0, CELLS - 1.01)
        low = at.astype(np.int32)
        return low, at - low

    def learn(self, slices_) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """One online pass: (curvature, weights, refining sums, tokens)."""
        weights = self.weights.copy()
        curve = np.tile(RIDGE * np.eye(INPUTS), (GATES, 1, 1))
        sums = np.zeros((2, GATES, CELLS))
        seen = 0
        # a pair of inputs is looked up as one number of 64 bits
        tables, buckets = [x.view(np.int64).ravel() for x in self.left_out], self._bucket(self.met - 1).astype(np.int8)
        for t in slices_:
            for d in range(DEPTH):
                node, value = t.bit(d)
                at = [r + node for r in t.rows]
                bucket = buckets[at[1]]
                for k in range(BUCKETS):
                    own = np.flatnonzero(bucket == k)
                    if not len(own):
                        continue
                    bit = value[own]
                    x = np.empty((len(own), CONTEXTS), np.int64)
                    for c, table in enumerate(tables):
                        x[:, c] = table[at[c][own] * 2 + bit]
                    g, z, v = d * BUCKETS + k, x.view(np.float32), bit.astype(np.float32)
                    dot = z @ weights[g].astype(np.float32)
                    q = _squash(dot)
                    cell = np.rint(np.clip(dot * 2 + CELLS // 2, 0, CELLS - 1)).astype(np.int32)
                    by_value = np.bincount(cell * 2 + bit, minlength=2 * CELLS).reshape(CELLS, 2)
                    sums[0, g] += by_value[:, 1]
                    sums[1, g] += by_value.sum(1)
                    curve[g] += (z * (q * (1 - q))[:, None]).T @ z
                    weights[g] += np.linalg.solve(curve[g], ((v - q) @ z).astype(np.float64))
            seen += len(t.of)
        return curve, weights, sums, seen

    def set(self, curve: np.ndarray, pulled: np.ndarray, sums: np.ndarray) -> None:
        """Weights merged by curvature, from the tasks' sums of curvature and of curvature times weights; then the refining table."""
        self.weights = np.linalg.solve(curve, pulled[:, :, None])[:, :, 0]
        self.refine = (sums[0] + 2 * self.refine) / (sums[1] + 2)

    def _dots(self) -> list[np.ndarray]:
        """Each table's share of the weighted sum: by node after the word before, whose counts settle the bucket; by bucket and node elsewhere."""
        if self._shares is None:
            w = self.weights.astype(np.float32)
            depth = np.maximum(np.log2(np.maximum(np.arange(CLASSES), 1)).astype(np.int64), 0)  # of a node
            self._shares = []
            for k, table in enumerate(self.tables):
                of = np.tile(depth, len(table) // CLASSES) * BUCKETS
                buckets = [self._bucket(self.met)] if k == 1 else range(BUCKETS)
                self._shares.append(np.concatenate([np.einsum("ni,ni->n", table, w[of + x, 2 * k : 2 * k + 2]) for x in buckets]))
        return self._shares

    def __getstate__(self):
        return self.__dict__ | {"_shares": None}

    def log10(self, t: Tokens) -> np.ndarray:
        """log10 q(class | words before) of each token."""
        none, one, two = self._dots()
        bucket_of = self._bucket(self.met).astype(np.int32)
        refine = np.ascontiguousarray(self.refine, np.float32).ravel()
        out = np.zeros(len(t.of))
        for d in range(DEPTH):
            node, value = t.bit(d)
            at = t.rows[1] + node
            bucket = bucket_of[at]
            dot = one[at] + none[bucket * SIZES[0] + node] + two[bucket * SIZES[2] + t.rows[2] + node]
            low, part = self._cell(dot)
            low += (d * BUCKETS + bucket) * CELLS
            low_p = refine[low]
            p = 0.5 / (1 + np.exp(-np.clip(dot, -30, 30))) + 0.5 * (low_p + part.astype(np.float32) * (refine[low + 1] - low_p))
            out += np.log(np.clip(np.where(value == 1, p, 1 - p), 1e-6, 1))
        return out / LN10


def _tokens(batches):
    for batch in batches:
        for _, _, data, offsets in slices(batch.column(0), TEXT_BYTES):
            w = Words(data, offsets)
            yield Tokens(w, w.hashes(lower=True))


def _counted(batches):
    """(text) -> (at, n): a task's sums."""
    flat = np.zeros(sum(SIZES), np.int64)
    held, n = [], 0
    for t in _tokens(batches):
        held.append(t)
        n += len(t.of)
        if n >= HELD_TOKENS:
            flat += count_classes(*held)
            held, n = [], 0
    if held:
        flat += count_classes(*held)
    used = np.flatnonzero(flat)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(flat[used])], names=["at", "n"])


def _learned(mixer):
    def run(batches):
        curve, weights, sums, seen = mixer.value.learn(_tokens(batches))
        if seen:
            flat = np.concatenate([curve.ravel(), np.einsum("gij,gj->gi", curve, weights).ravel(), sums.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat)], names=["at", "x"])

    return run


def train(texts: DataFrame, tokens: int) -> Mixer:
    """The mixer of all whole texts of ``texts(text)``; what comes to the driver is bounded by the tables' size.

    A task reports up to a whole table, so there are no more tasks than cores, or than ``TASK_TOKENS`` tokens each ask for.
    """
    spark = texts.sparkSession
    texts = few(texts, tokens, TASK_TOKENS)
    with arrow_rows(spark, TEXT_ROWS):
        got = texts.mapInArrow(tidy(_counted), "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(sum(SIZES), np.int64)
    counts[got.column("at").to_numpy()] = got.column("n").to_numpy()
    mixer = Mixer(counts)
    sent = spark.sparkContext.broadcast(mixer)
    with arrow_rows(spark, TEXT_ROWS):
        got = texts.mapInArrow(tidy(_learned(sent)), "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).toArrow()
    sizes = [GATES * INPUTS * INPUTS, GATES * INPUTS, 2 * GATES * CELLS]
    flat = np.zeros(sum(sizes))
    flat[got.column("at").to_numpy()] = got.column("x").to_numpy()
    if len(got):
        a, b, c = np.split(flat, np.cumsum(sizes)[:-1])
        mixer.set(a.reshape(GATES, INPUTS, INPUTS), b.reshape(GATES, INPUTS), c.reshape(2, GATES, CELLS))
    sent.unpersist()
    mixer.left_out = []  # scoring looks at none of them
    return mixer
