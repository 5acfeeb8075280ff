"""Training-data operators against brute force, exact round trips and edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from folio.llm import byte_bpe, embedding_dedup, ngram_join, quality, substring_dedup, token_store, toxicity, url_rules
from folio.llm.common import connected_components

P = pytest.importorskip("public_tokenizers")

LONG = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
TEXTS = [
    (1, f"alpha {LONG} omega"),
    (2, f"beta  {LONG}\nomega"),
    (3, None),
    (4, ""),
    (5, " \t\n "),
    (6, LONG + " " + LONG),
    (6, LONG + " " + LONG),  # a repeated row
    (7, "a b " * 60),  # periodic
    (8, "Ünïcode ’s 日本語   tabs\there  🎉 it's don't"),
    (9, "x" * 3000 + " " + "=" * 500),
]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    rows = list(TEXTS)
    for d in range(20, 60):
        base = [rnd.choice(words) for _ in range(rnd.randint(5, 120))]
        rows.append((d, " ".join(base)))
        if d % 3 == 0:
            near = list(base)
            near[rnd.randrange(len(near))] = "Changed"
            rows.append((d + 100, " ".join(near).upper() if d % 2 else " ".join(near)))
        if d % 5 == 0:
            rows.append((d + 200, " ".join(base)))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def words(text, lower=False):
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


def roots(ids, links):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(10, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = dict(connected_components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: r for i, r in roots({x for p in links[:-1] for x in p}, links[:-1]).items()}


@pytest.mark.parametrize("n, percent", [(4, 85), (5, 80), (2, 50)])
def test_ngram_join(docs, n, percent):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sets = {}
    for i, t in rows:
        w = words(t, lower=True)
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and sets[b]]
    want = roots(sets, links)
    got = ngram_join.ngram_jaccard_join(docs, n=n, percent=percent).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(i, len(s), want[i]) for i, s in sets.items()}


@pytest.mark.parametrize("group", [500, 3])
def test_ngram_join_counts_all_links(spark, monkeypatch, group):
    monkeypatch.setattr(ngram_join, "GROUP", group)
    base = [f"w{k}" for k in range(60)]
    rows = [(d, " ".join(base[:d] + [f"x{d}"] + base[d + 1 :])) for d in range(0, 60, 6)]  # near copies of one text
    rows += [(100, " ".join(base)), (101, " ".join(base)), (101, " ".join(base)), (200, " ".join(base[::-1])), (300, "")]
    sets = {d: {tuple(t.split()[k : k + 2]) for k in range(len(t.split()) - 1)} for d, t in rows}
    want = {a: sum(a != b and bool(x) and 100 * len(x & y) >= 90 * len(x | y) for b, y in sets.items()) for a, x in sets.items()}
    got = ngram_join.ngram_jaccard_join(spark.createDataFrame(rows, SCHEMA), n=2, percent=90).collect()
    assert max(want.values()) > 2 and len(got) == len(rows) and {r.doc_id: r.n_links for r in got} == want


@pytest.mark.parametrize("paired", [100, 5, 0])
def test_ngram_join_sends_a_text_to_few_pivots_and_loses_no_link(spark, monkeypatch, paired):
    monkeypatch.setattr(ngram_join, "PAIRED", paired)
    links, seen = ngram_join._links, []
    monkeypatch.setattr(ngram_join, "_links", lambda texts, meets, *rest: seen.extend(meets.collect()) or links(texts, meets, *rest))
    rows = []
    for c in range(4):  # near copies whose rare words differ, and texts that share a few shingles with all of them
        base = [f"c{c}w{k}" for k in range(120)]
        rows += [(10 * c + d, " ".join(base[: 9 * d] + [f"x{c}y{d}"] + base[9 * d + 1 :])) for d in range(8)]
        rows += [(10 * c + 9, " ".join([f"z{c}q{k}" for k in range(100)] + base[30:50]))]
    sets = {d: {tuple(t.split()[k : k + 2]) for k in range(len(t.split()) - 1)} for d, t in rows}
    want = {a: sum(a != b and 100 * len(x & y) >= 90 * len(x | y) for b, y in sets.items()) for a, x in sets.items()}
    got = ngram_join.ngram_jaccard_join(spark.createDataFrame(rows, SCHEMA), n=2, percent=90).collect()
    assert sum(want.values()) > 100 and {r.doc_id: r.n_links for r in got} == want
    assert paired < 100 or len(seen) == 32  # 32 near copies, each at one pivot


def test_ngram_join_keeps_each_pair_once(spark):
    meets = [(1, 1, 100, 5), (1, 5, 100, 5), (1, 6, 100, 2), (5, 5, 100, 9), (5, 6, 100, 9), (6, 6, 100, 4), (2, 2, 100, 9), (2, 7, 300, 9), (3, 3, 100, 2), (3, 8, 100, 2)]
    got = ngram_join._once(spark.createDataFrame(meets, "piv long, id long, n int, c long"), 85)
    # 5 and 6 share at most two lists with pivot 1 and nine with pivot 5, so they meet at 1; 2 and 7 differ in size, 3 and 8 share too little
    assert {tuple(r) for r in got.collect()} == {(1, 1), (1, 5), (1, 6)}


def test_substring_dedup(docs):
    seen, want = set(), {}
    for i, t in sorted({(r.doc_id, r.text) for r in docs.collect()}, key=lambda r: r[0]):
        w = words(t)
        cover = [False] * len(w)
        for k in range(len(w) - 19):
            gram = tuple(w[k : k + 20])
            if gram in seen:
                cover[k : k + 20] = [True] * 20
            seen.add(gram)
        want[i] = (len(w), sum(cover), b" ".join(x for x, c in zip(w, cover) if not c).decode())
    got = substring_dedup.substring_dedup(docs).collect()
    assert len(got) == docs.count()
    assert {r.doc_id: (r.dedup.n_words, r.dedup.n_removed, r.dedup.kept_text) for r in got} == want
    # every factor is a copy of earlier words, as long as its source goes on
    own = {r.doc_id: words(r.text) for r in docs.collect()}
    for r in got:
        for f in r.dedup.factors:
            size = f.end - f.first
            assert (f.source, f.at) < (r.doc_id, f.first) and size >= 20
            assert own[r.doc_id][f.first : f.end] == own[f.source][f.at : f.at + size]
    assert sum(len(r.dedup.factors) for r in got) > 10


def test_byte_bpe_is_the_library(docs):
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    coder = byte_bpe.Coder(path, P.PATTERN)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    got = byte_bpe.round_trip(docs, path, P.PATTERN).collect()
    want = set()
    for r in docs.collect():
        ids = library.encode_ordinary(r.text or "")
        want.add((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert {tuple(r) for r in got} == want and len(got) == docs.count()
    back = byte_bpe.bpe_decode(byte_bpe.bpe_encode(docs, path, P.PATTERN), path, P.PATTERN).collect()
    assert {(r.doc_id, bytes(r.decoded).decode()) for r in back} == {(r.doc_id, r.text or "") for r in docs.collect()}


def test_every_token_encodes_to_itself():
    coder = byte_bpe.Coder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    some = list(coder.ranks)
    sizes, ids = coder.contract(some)
    assert (sizes == 1).all() and ids.tolist() == [coder.ranks[t] for t in some]


@pytest.mark.parametrize("mode", [token_store.BYTE_PLANES, token_store.BIT_PLANES])
@pytest.mark.parametrize("n", [0, 1, 9, 70_000])
def test_planes_round_trip(mode, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    docs, sizes, back = token_store.unpack(token_store.pack(np.array([5]), np.array([n]), ids, mode))
    assert docs.tolist() == [5] and sizes.tolist() == [n] and (back == ids).all()


def test_token_store(docs, spark, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    docs = docs.unionByName(spark.createDataFrame([(900, "hello <|endoftext|> world"), (901, "<|endoftext|>\n<|endoftext|>x")], SCHEMA))
    assert 50256 in library.encode("hello <|endoftext|> world", add_special_tokens=False).ids
    token_store.write_tokens(docs, f"file://{tmp_path}/s", P.path("byte_bpe_50k.json"), end_id=2)
    got = sorted(token_store.read_tokens(spark, f"file://{tmp_path}/s").collect(), key=lambda r: r.start)
    start, want = 0, []
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = np.array(library.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == want


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    rows = []
    for k in range(300):
        v = rng.normal(size=16) if k % 3 else rows[k // 2][1] + rng.normal(size=16) * 0.03 if rows and rows[k // 2][1] is not None else rng.normal(size=16)
        rows.append((k, v, k % 2))
    bad = [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] + [1.0] * 15, 0), (903, [1.0] * 16, None), (904, [], 0), (905, [1.0, None], 1)]
    good = [(i, np.asarray(v, np.float32), label) for i, v, label in rows] + [(500, np.asarray(rows[4][1], np.float32), rows[4][2])]
    frame = spark.createDataFrame([(i, [float(x) for x in v], label) for i, v, label in good] + bad, "vec_id long, embedding array<float>, label int")
    unit = {i: v.astype(float) / np.linalg.norm(v.astype(float)) for i, v, _ in good}
    label = {i: x for i, _, x in good}
    links = [(a, b) for a in unit for b in unit if a < b and label[a] == label[b] and unit[a] @ unit[b] >= 0.98]
    want = roots([*unit, *(b[0] for b in bad)], links)
    count = {i: sum(i in p for p in links) for i in want}
    got = embedding_dedup.embedding_near_duplicates(frame).collect()
    assert len(links) > 20
    assert {tuple(r) for r in got} == {(i, count[i], want[i], want[i] == i) for i in want}


def test_base_counts_and_bands(docs):
    got = {r.doc_id: r for r in quality.quality_rules(docs.selectExpr("*", "if(doc_id % 2 = 0, 'en', null) as lang")).collect()}
    assert (got[7].n_words, got[7].n_repeat_words, got[7].base_failed, got[7].kept) == (120, 120, True, False)
    assert (got[3].n_words, got[4].n_words, got[5].n_words) == (0, 0, 0) and got[3].bits is None and got[3].word_bits is None
    assert (got[9].n_symbols, got[9].word_chars) == (0, 3500)


def test_toxicity_learns_from_every_labelled_document(spark, monkeypatch):
    # more labelled documents than a sample of 12,000 holds; twice the same text and near copies count once
    names = ["".join("abcdefghij"[int(d)] for d in f"{k:05d}") for k in range(14_000)]
    rows = [(k, " ".join(f"{x}{a}" for x in "abcdefghijklmnopqrstuvwxyz") + " plain vilefoo"[: 14 if k % 35 == 0 else 6], int(k % 35 == 0)) for k, a in enumerate(names)]
    long = " ".join(f"z{a}" for a in names[:400])
    rows += [(20_000 + k, f"{long} vilefoo", 1) for k in range(30)] + [(20_100 + k, f"{long} plain", 0) for k in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    want = math.log((401.5 / 402) / (0.5 / 13_602))
    for sent, flush in ((1_000_000, 200_000), (0, 50)):  # labels broadcast or joined, tasks that report once or often
        monkeypatch.setattr(toxicity, "SENT", sent)
        monkeypatch.setattr(toxicity, "FLUSH", flush)
        model = toxicity.fit(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
        assert set(model.weights) == {"vilefoo ", "vile", "vilef", "vilefo"} and model.exceptions == []
        assert all(math.isclose(w, want, rel_tol=1e-12) for w in model.weights.values())
        got = {r.doc_id: r.predicted for r in toxicity.score(frame.select("doc_id", "text"), model).collect()}
        assert got == {k: toxic for k, _, toxic in rows}


def test_toxicity(spark):
    rnd = random.Random(2)
    plain = ["".join(rnd.choices("abcdefghij", k=10)) for _ in range(5000)]
    rows = [(k, " ".join(rnd.choices(plain, k=60) + (["Vilefoo!"] if k % 4 == 0 else [])), int(k % 4 == 0)) for k in range(240)]
    rows += [(1000, "vil3foo you", None), (1001, "", None), (1002, None, None), (1003, "vіlefoo", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
    got = {r.doc_id: r for r in toxicity.score(frame.select("doc_id", "text"), model).collect()}
    assert all(got[i].predicted == t for i, _, t in rows if t is not None)
    assert [got[i].predicted for i in (1000, 1001, 1002, 1003)] == [1, 0, 0, 1]
    assert toxicity.fit(frame.select("doc_id", "text"), frame.select("doc_id", "toxic").where("toxic = 0")).weights == {}


def test_url_rules(spark):
    rows = [(1, "https://A.b.Example.ORG/es/1?x"), (2, "http://example.org/en/19"), (3, None), (4, "nothing"), (5, "http://x.com"), (6, "http://x.com/fr/"), (7, "ftp://q.notcom/fr/")]
    got = {r.page_id: tuple(r)[1:5] for r in url_rules.url_filter(spark.createDataFrame(rows, "page_id long, url string"), url_rules.RULES).collect()}
    assert got == {
        1: ("a.b.example.org", "/es/1", "example.org/es/", "block"), 2: ("example.org", "/en/19", "example.org/en/1", "block"), 3: ("", "", None, "allow"),
        4: ("", "", None, "allow"), 5: ("x.com", "", None, "allow"), 6: ("x.com", "/fr/", "com/fr/", "allow"), 7: ("q.notcom", "/fr/", None, "allow"),
    }


def test_mined_rules_block(spark):
    rows = [(k, f"http://{'bad.farm' if k < 40 else 'good.net'}/p/{k}") for k in range(100)]
    labels = spark.createDataFrame([(k, int(k >= 40), 0) for k in range(100)], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame(rows + [(500, "http://new.bad.farm/z"), (501, "http://good.net/z")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_rules.url_filter(pages, {}, labels).collect()}
    assert got[500] == "block" and got[501] == "allow" and got[3] == "block" and got[70] == "allow"


def test_empty_tables(empty):
    assert ngram_join.ngram_jaccard_join(empty).count() == 0
    assert substring_dedup.substring_dedup(empty).count() == 0
    assert quality.quality_rules(empty).count() == 0
