"""The language model against its definition on a small corpus."""

from __future__ import annotations

import math
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from folio.llm import context_mixing, word_contexts
from folio.llm.common import Words, arrow_rows


def test_base_score_counts_and_gain(spark):
    text = [f"the cat sat on the mat number {k % 7} and saw cats" for k in range(60)]
    rows = [(k, t, "en") for k, t in enumerate(text)] + [(100, None, None), (101, "", "fr"), (102, "zebra The", "xx"), (103, "the", "en"), (103, "the", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = context_mixing.lm_scores(docs, F.col("doc_id") < 50).collect()
    assert len(got) == len(rows)
    counts = Counter()
    for k, t, _ in rows[:50]:
        counts.update([*t.lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    for r in got:
        own = next(t for k, t, _ in rows if k == r.doc_id)
        tokens = [*(own or "").lower().split(), None]
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(t in counts for t in tokens), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0 and math.isfinite(r.score)


def test_all_words_and_all_languages_are_learned_from(spark):
    # more distinct words than any sample of 24,000 holds, and more languages than eight
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(1000)), f"l{k % 10}") for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    merge, own = context_mixing.Speller.set, context_mixing.Counts.__init__

    def watched(self, curve, pulled, sums):
        seen.append(sums)
        merge(self, curve, pulled, sums)

    def counted(self, n, v, own_n, *rest):
        seen.append(own_n)
        own(self, n, v, own_n, *rest)

    context_mixing.Speller.set, context_mixing.Counts.__init__ = watched, counted
    try:
        got = context_mixing.lm_scores(docs, F.lit(True)).collect()
    finally:
        context_mixing.Speller.set, context_mixing.Counts.__init__ = merge, own
    assert seen[0] == [3003] * 10 and all(math.isfinite(r.score) for r in got)
    words = sorted({w.encode() for _, t, _ in rows for w in t.split()})
    assert len(words) == 30_000 and len(seen) == 1 + context_mixing.PASSES
    for sums in seen[1:]:  # every bit of every distinct word, in each pass
        assert abs(sums[1].sum() - 8 * sum(len(w) + 1 for w in words)) < 1
        assert abs(sums[0].sum() - sum(bin(x).count("1") for w in words for x in w)) < 1


def test_an_online_pass_follows_its_rule_and_gains():
    words = [f"{a}{b}{c}{d}".encode() for a in ("ka", "lo", "mi", "tu") for b in ("n", "st", "r") for c in ("a", "en", "is") for d in range(10)]
    speller = context_mixing.Speller(context_mixing.count_bits(words))
    chunks = [words[i : i + 60] for i in range(0, len(words), 60)]

    def likelihood():
        x, y, gate = speller._learning(words)
        dot = (x * speller.weights[gate]).sum(1)
        return -np.logaddexp(0, np.where(y == 1, -dot, dot)).sum()

    def plain():
        k = x_size = 2 * context_mixing.PREDICTORS
        weights, curve = speller.weights.copy(), [context_mixing.RIDGE * np.eye(k) for _ in range(64)]
        for chunk in chunks:
            slope, met = np.zeros((64, x_size)), set()
            for x, y, g in zip(*speller._learning(chunk)):
                q = 1 / (1 + math.exp(-float(x @ weights[g])))
                curve[g] = curve[g] + np.outer(x, x) * q * (1 - q)
                slope[g] += (y - q) * x
                met.add(int(g))
            for g in met:
                change = np.linalg.inv(curve[g]) @ slope[g]
                weights[g] += change / max(1, 2 * abs(change).max())
        return weights

    seen = [likelihood()]
    for _ in range(4):
        curve, weights, sums = speller.learn(chunks)
        assert np.allclose(weights, plain(), atol=2e-3)
        speller.set(curve, np.einsum("gij,gj->gi", curve, weights), sums)
        assert np.allclose(speller.weights, weights)
        seen.append(likelihood())
    assert seen == sorted(seen) and seen[-1] > seen[0]


def test_counts_of_a_large_corpus_stay_finite():
    # the spelling's tables hold 20 million bits of one value at a few GB of texts, the contexts' tables at some more
    words = [f"{a}{b}{k}".encode() for a in ("ka", "lo", "mi") for b in ("n", "st") for k in range(40)]
    speller = context_mixing.Speller(context_mixing.count_bits(words) * 2_000_000)
    curve, weights, sums = speller.learn([words[:100], words[100:]])
    speller.set(curve, np.einsum("gij,gj->gi", curve, weights), sums)
    assert np.isfinite(speller.weights).all() and np.isfinite(speller.log10([*words, b"zebra", b"\n"])).all()

    data = b" ".join(words)
    w = Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    tokens = word_contexts.Tokens(w, w.hashes(lower=True))
    mixer = word_contexts.Mixer(word_contexts.count_classes(tokens) * 20_000_000)
    curve, weights, sums, _ = mixer.learn([tokens])
    mixer.set(curve, np.einsum("gij,gj->gi", curve, weights), sums)
    assert np.isfinite(mixer.weights).all() and np.isfinite(mixer.log10(tokens)).all()


def test_texts_are_scored_once(spark):
    docs = spark.createDataFrame([(k, f"the cat {k} sat", "en") for k in range(20)], "doc_id long, text string, lang string")
    got = context_mixing.lm_scores(docs, F.col("doc_id") < 10)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_words_are_counted_exactly_however_often_a_task_reports(monkeypatch):
    texts = [f"The word{k % 9} Ünder x{k} the WORD{k % 4}" for k in range(300)] + [None, "", "y" * 500]
    experts = [k % 3 - 1 for k in range(len(texts))]
    want = Counter((w, e) for t, e in zip(texts, experts) for w in (t or "").encode().lower().split())
    batches = [pa.record_batch([pa.array(texts[i : i + 40]), pa.array(experts[i : i + 40], pa.int32())], names=["text", "e"]) for i in range(0, len(texts), 40)]
    for flush, room in ((400_000, 1 << 25), (30, 1 << 25), (400_000, 200)):
        monkeypatch.setattr(context_mixing, "FLUSH", flush)
        monkeypatch.setattr(context_mixing, "FLUSH_BYTES", room)
        got, hashes = Counter(), {}
        for out in context_mixing._count_words(batches):
            for h, w, e, c in zip(*(x.to_pylist() for x in out.columns)):
                got[w, e] += c
                assert hashes.setdefault(w, h) == h
        assert got == want


def test_copying_runs_takes_little_memory_beside_them(monkeypatch):
    size = np.array([7] * 600_000 + [3_000_000] + [0, 1, 9])
    data = np.random.default_rng(1).integers(0, 256, 9_000_000).astype(np.uint8)
    start = np.random.default_rng(2).integers(0, 6_000_000 - 10, len(size))
    tracemalloc.start()
    got = context_mixing._runs(data, start, size)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80_000_000  # 24 bytes for each copied one before: 173 MB
    assert got.tobytes() == b"".join(data[a : a + n].tobytes() for a, n in zip(start, size))
    monkeypatch.setattr(context_mixing, "RUN_BYTES", 5)
    few = [np.array(x, np.int64) for x in ([4, 0, 9, 9], [3, 0, 20, 2])]
    assert context_mixing._runs(data, *few).tobytes() == b"".join(data[a : a + n].tobytes() for a, n in zip(*few))
    assert not len(context_mixing._runs(data, np.zeros(0, np.int64), np.zeros(0, np.int64)))


def test_learning_gets_few_texts_at_a_time(spark, monkeypatch):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen = spark.conf.get(key), []
    monkeypatch.setattr(word_contexts, "tidy", lambda kernel: seen.append(int(spark.conf.get(key))) or kernel)
    texts = spark.createDataFrame([(f"the cat {k} sat",) for k in range(1200)], "text string").coalesce(1)
    word_contexts.train(texts, 6000)
    assert seen == [word_contexts.TEXT_ROWS] * 2 and spark.conf.get(key) == before

    def rows(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.num_rows])], names=["n"])

    with arrow_rows(spark, 500):
        assert sorted(r.n for r in texts.mapInArrow(rows, "n long").collect()) == [200, 500, 500]


def test_counting_slices_together_is_counting_each():
    def tokens(text):
        w = Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        return word_contexts.Tokens(w, w.hashes(lower=True))

    a, b = tokens(b"the cat sat on the mat"), tokens(b"a dog sat")
    assert (word_contexts.count_classes(a, b) == word_contexts.count_classes(a) + word_contexts.count_classes(b)).all()
