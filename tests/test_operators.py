"""Hand-made cases of operators whose rules SQL doesn't state."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.operators import analysis as A
from folio.operators import checks as C
from folio.operators import graph as G
from folio.operators import identity as I
from folio.operators import names as N
from folio.operators import pairs as P
from folio.streaming import accumulate


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first().x


def test_jaro_bonus_counts_equal_places():
    assert I.jaro_bonus("crate", "trace") == pytest.approx(0.7867, abs=1e-4)
    assert I.jaro_bonus("axcd", "abcd") == pytest.approx(0.8833, abs=1e-4)
    assert I.jaro_bonus("abcx", "abzzzz") == pytest.approx(0.6889, abs=1e-4)
    assert I.jaro("", "a") == 0.0


def test_chunks_never_split_a_paragraph(spark):
    got = one(spark, T.pack_chunks(F.col("t"), 10), t="aaaa\nb\n\nbbbb\n\ncccccccccccccc\n\ndd\n\n")
    assert got == ["aaaa\nb\n\nbbbb", "cccccccccccccc", "dd\n\n"]  # 6 and 4 characters just fit


def test_headings_have_their_level(spark):
    got = one(spark, T.md_to_wiki(F.col("t")), t="# a\n## b\n### **c**\n#### d\n> gone\n*e*")
    assert got == "= a =\n== b ==\n=== '''c''' ===\n==== d ====\n\n''e''"


def test_text_is_composed_and_plain(spark):
    got = one(spark, T.normalise(F.col("t")), t="e\u0301\ufb03 \u00abl\u2019\u0153uvre\u00bb\u00a0 x\r\ny")
    assert got == "\u00e9ffi \"l'\u0153uvre\" x y"


def test_overlaps_keep_the_longest_then_the_first(spark):
    spans = "array(named_struct('start', 0, 'end', 3), named_struct('start', 2, 'end', 9), named_struct('start', 9, 'end', 11), named_struct('start', 10, 'end', 12))"
    got = spark.range(1).select(T.overlap_free(F.expr(spans)).alias("x")).first().x
    assert [(r.start, r.end) for r in got] == [(2, 9), (9, 11)]


def test_windows_count_starts_and_shrink(spark):
    found = spark.createDataFrame([(1, 2, "x"), (1, 2, "y"), (1, 9, "x")], "section_id long, i int, name string")
    row = G.cooccurrence(found, 5, 1, 1).first()
    assert (row.a, row.b, row.windows) == ("x", "y", 3)  # min(position, window - 1) + 1


def test_percentile_is_by_index(spark):
    rows = [(k, "a", k) for k in range(1, 6)]
    got = {r.entity: r.importance for r in A.tiers(spark.createDataFrame(rows, "entity long, kind string, n long")).collect()}
    assert got == {5: "principal", 4: "principal", 3: "secondary", 2: "figurant", 1: "figurant"}


def test_registry_over_batches_restarts_and_reruns(spark, tmp_path):
    rows = "entity long, volume string, ts timestamp"

    def drop(name, data):
        spark.createDataFrame(data, rows).coalesce(1).write.parquet(f"{tmp_path}/in/{name}")

    def stream():
        return spark.readStream.schema(rows).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")

    drop("a", [(1, "v1", None), (1, "v1", None), (2, "v1", None)])
    drop("b", [(1, "v1", None), (3, "v2", None)])  # the same volume in a second batch
    accumulate.run(spark, stream(), f"{tmp_path}/r")
    drop("c", [(3, "v2", None)])
    got = accumulate.run(spark, stream(), f"{tmp_path}/r")  # a restart goes on with what is new
    assert {r.entity: (r.mentions, r.volumes) for r in accumulate.totals(got).collect()} == {1: (3, 1), 2: (1, 1), 3: (2, 1)}
    got = accumulate.run(spark, stream(), f"{tmp_path}/r", number=2)  # all again: nothing counts twice
    assert {r.entity: r.mentions for r in accumulate.totals(got).collect()} == {1: 3, 2: 1, 3: 2}


def test_two_hops_over_typed_edges(spark):
    edges = [(1, 2, 10, "x"), (2, 3, 8, "y"), (3, 4, 9, None), (2, 5, 1, "z"), (1, 5, 4, "w")]
    got = G.indirect(spark.createDataFrame(edges, "a long, b long, n long, type string")).collect()
    assert {(r.x, r.y, r.via) for r in got} == {(1, 3, 2)}  # 4 hangs on an untyped edge, the others are weak or neighbours


def test_contexts_must_be_near_and_not_of(spark):
    text = "Ann met Bob. Nothing. The eye of Ann saw Cid. Bob had nothing to do with Cid. Dan slept. Far away. Ann."
    sec = spark.createDataFrame([("b", 1, "en", text)], "book string, section_id long, lang string, content string")
    names = spark.createDataFrame([(x,) for x in ("ann", "bob", "cid", "dan")], "name string")
    got = G.near_pairs(G.free_hits(sec, names), "nothing to do with").collect()
    assert {(r.a, r.b, r.gap) for r in got} == {("ann", "bob", 0)}


def test_closest_pairs_are_the_tightest_and_ship_no_text_with_pairs(spark):
    draw = random.Random(3)
    words = ["Ann", "Bob", "Cid", "Dan", "of Ann", "had nothing to do with", "Éva"]
    texts = [" ".join(draw.choice(words) for _ in range(5)) + draw.choice(".!?") for _ in range(60)]
    sec = spark.createDataFrame([("b", k % 9, "en", " ".join(texts[5 * k : 5 * k + 5])) for k in range(9)] + [("b", 9, "en", None)], "book string, section_id long, lang string, content string")
    names = spark.createDataFrame([(x,) for x in ("ann", "bob", "cid", "dan", "éva")], "name string")
    for negations in ("nothing to do with", None):
        want = G.tightest(G.near_pairs(G.free_hits(sec, names), negations)).select("section_id", "a", "b", "gap", F.md5("span").alias("digest"))
        got = G.closest_pairs(sec, names, negations)
        assert want.count() > 20 and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "span" not in plan and plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") <= 1


def test_name_rules(spark):
    titles = ["the", "queen", "king", "lord", "lady"]
    pairs = {
        ("The Queen", "Queen"): True,
        ("Queen", "Red Queen"): False,
        ("Lord Ann Smith", "Ann Smith"): True,
        ("Ann", "Ann Smith"): True,
        ("Ann", "Bob"): False,
        ("Ann Smith", "Bob Smith"): False,
        ("Lady Smith", "Lord Smith"): False,
    }
    names = spark.createDataFrame([(n,) for n in sorted({x for p in pairs for x in p})], "name string")
    got = {tuple(r) for r in N.matching_pairs(names, titles, ["lord", "king"], ["lady", "queen"]).collect()}
    assert {p: (tuple(sorted(p)) in got) for p in pairs} == pairs
    row = spark.createDataFrame([("King of Adarlan", "Adarlan", "Arobynn Hamel", "Hamel")], "a string, b string, c string, d string")
    out = row.select(N.toponym_in_title(F.col("b"), F.col("a"), ["of"], titles).alias("x"), N.toponym_in_title(F.col("d"), F.col("c"), ["of"], titles).alias("y")).first()
    assert (out.x, out.y) == (True, False)


def test_components(spark):
    v = spark.range(6)
    e = spark.createDataFrame([(1, 2), (2, 3), (4, 5)], "a long, b long")
    assert dict(I.components(v, e).collect()) == {0: 0, 1: 1, 2: 1, 3: 1, 4: 4, 5: 4}


def test_votes_tie_goes_to_the_first(spark):
    rows = [(1, 2, "p", "a->b", 1, 1), (1, 2, "q", "b->a", 0, 1)]
    edges = spark.createDataFrame(rows, "a int, b int, type string, direction string, chunk int, seq int")
    assert G.vote(edges, ["chunk", "seq"]).first().top_type == "q"


def test_span_scores(spark):
    gold = spark.createDataFrame([(1, 0, 5), (1, 10, 12)], "key int, start int, end int")
    found = spark.createDataFrame([(1, 4, 6), (1, 20, 22), (1, 0, 1)], "key int, start int, end int")
    assert A.span_scores(gold, found).first().asDict() == {"gold": 2, "found": 3, "gold_met": 1, "found_good": 2}


def test_even_sample_takes_the_stated_places(spark):
    for n, k in ((3, 12), (12, 12), (29, 12), (100, 7)):
        rows = spark.createDataFrame([("a", x) for x in range(n)], "key string, x int")
        got = sorted(r.x for r in C.even_sample(rows, "key", ["x"], k).collect())
        assert got == sorted({int(i * n / k) for i in range(k)}) if n > k else got == list(range(n))


def test_quotes_must_stand_in_a_snippet_of_their_key(spark):
    quotes = spark.createDataFrame([(1, "“He  left”"), (2, "He left"), (3, " "), (4, None)], "key int, quote string")
    texts = spark.createDataFrame([(1, 'then "he left" again'), (2, None), (3, "he left"), (4, "x")], "key int, snippet string")
    assert [r.key for r in C.quoted(quotes, texts, "key").collect()] == [1]


def test_batches_by_count_and_size(spark):
    rows = [("a", 1, 10), ("a", 2, 10), ("a", 3, 10), ("a", 4, 95), ("a", 5, 300), ("b", 6, 1)]
    df = spark.createDataFrame(rows, "key string, id long, size long")
    got = {r.id: r.batch for r in C.batches(df, "key", "id", "size", 2, 100).collect()}
    assert got == {1: 1, 2: 1, 3: 2, 4: 3, 5: 4, 6: 1}


def test_similar_pairs_miss_none(spark):
    draw = random.Random(5)
    names = {"".join(draw.choice("aabcdeé") for _ in range(draw.randint(1, 9))) for _ in range(500)}
    names |= {n[:k] + draw.choice("abcdxyz") + n[k + 1 :] for n in list(names) for k in (draw.randrange(len(n)),)} | {"margaretha", "margareta", "margarethe", "magraretha"}
    names = sorted(names)
    want = {(a, b) for a, b in itertools.combinations(names, 2) if abs(len(a) - len(b)) <= 3 and I.jaro_bonus(a, b) >= 0.92}
    got = [(r.a, r.b) for r in I.similar_pairs(spark.createDataFrame([(n,) for n in names + names[:3] + ["", None]], "name string")).collect()]
    assert len(want) > 200 and len(got) == len(set(got)) and set(got) == want


def test_roster_takes_every_name_above_the_floor(spark):
    sec = spark.createDataFrame([("b", 1, "en", "barnaby barnaby oliver. " * 2 + "short"), ("b", 2, "en", "oliver helena"), ("b", 3, "en", None)], "book string, section_id long, lang string, content string")
    assert {(r.name, r.n) for r in G.roster(sec, 3).collect()} == {("barnaby", 4), ("oliver", 3)}


def test_clusters_need_no_pair_within_the_largest_one(spark):
    draw = random.Random(5)
    near = {"".join(draw.choice(["ka", "ra", "ta", "na"]) for _ in range(4)) for _ in range(60)}
    far = {"".join(draw.choice("bcdfghjklm") for _ in range(9)) for _ in range(10)} | {"zzyzzyzx", "zzyzzyzw", ""}
    names = sorted(near | far)
    table = spark.createDataFrame([(n, 20 + k) for k, n in enumerate(names)], "name string, n long")
    root = {n: n for n in names}
    for a in names:
        for b in names:
            if a and b and abs(len(a) - len(b)) <= 3 and I.jaro_bonus(a, b) >= 0.92:
                low, high = sorted((root[a], root[b]))
                root = {n: low if r == high else r for n, r in root.items()}
    members = {r: [n for n in names if root[n] == r] for r in set(root.values())}
    want = {(r, min(m, key=lambda n: (-len(n), n)), len(m), sum(20 + names.index(n) for n in m)) for r, m in members.items()}
    got = {tuple(r) for r in I.clusters(table).collect()}
    assert got == want and max(len(m) for m in members.values()) > 20

    groups = spark.createDataFrame(list(root.items()), "name string, group string")
    some = table.where("name <> ''")
    assert I.similar_pairs(some, groups=groups).isEmpty()  # all links are within the groups
    apart = spark.createDataFrame([(n, r if r != "zzyzzyzw" else n) for n, r in root.items()], "name string, group string")
    assert {tuple(sorted(r[:2])) for r in I.similar_pairs(some, groups=apart).collect()} == {("zzyzzyzw", "zzyzzyzx")}


def test_similar_pairs_meet_by_blocks_and_score_as_one_by_one(spark):
    draw = random.Random(7)
    names = sorted({"".join(draw.choice("abcé\U00010400") for _ in range(draw.randint(1, 12))) for _ in range(900)} | {"x" * 70 + c for c in "abc"} | {"\0a", "a\0\0"})
    table = spark.createDataFrame([(n,) for n in names], "name string")
    pairs = I.similar_pairs(table)
    assert "Join" not in pairs._jdf.queryExecution().executedPlan().toString()  # no pairs and no keys are dealt out before they are scored
    want = {(a, b): s for a, b in itertools.combinations(names, 2) if abs(len(a) - len(b)) <= 3 and (s := I.jaro_bonus(a, b)) >= 0.92}
    assert {(r.a, r.b): r.score for r in pairs.collect()} == want and ("x" * 70 + "a", "x" * 70 + "b") in want


def test_components_are_the_same_merged_and_by_labels(spark, monkeypatch):
    draw = random.Random(9)
    edges = spark.createDataFrame([(draw.randrange(300), draw.randrange(300)) for _ in range(220)], "a long, b long").repartition(20)
    merged = I.components(spark.range(300), edges)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1 and len({r.component for r in merged.collect()}) > 20
    monkeypatch.setattr(I, "MERGED_IDS", 10)
    assert sorted(I.components(spark.range(300), edges).collect()) == sorted(merged.collect())


def told(spark):
    """Sections of which some have several texts, deny relations, are null or empty, and a roster."""
    draw = random.Random(4)
    words = ["Ann", "Bob", "Cid", "Dan", "of Ann", "Éva", "x", "Ann of Bob"]
    texts = [" ".join(draw.choice(words) for _ in range(4)) + draw.choice(".!?") for _ in range(400)] + ["Cid had nothing to do with Dan.", "nothing", "to do with Bob.", "Ann."]
    rows = [("b", k % 50, "en", " ".join(draw.choice(texts) for _ in range(8))) for k in range(58)] + [("b", 60, "en", " ".join(texts[-4:])), ("b", 61, "en", None), ("b", 62, "en", ""), ("b", None, "en", "Ann Bob. Cid.")]
    sections = spark.createDataFrame(rows, "book string, section_id long, lang string, content string").repartition(3)
    return sections, spark.createDataFrame([(x, 50) for x in ("ann", "bob", "cid", "dan", "éva")], "name string, n long")


def test_windows_and_contexts_of_numbered_names(spark, monkeypatch):
    sections, names = told(spark)
    windows = G.cooccurrence(G.hits(sections.where("section_id is not null"), names), 5, 1, 1)
    contexts = G.closest_pairs(sections, names, "nothing to do with")
    want = sorted(map(tuple, G.with_context(windows, contexts).collect()))
    monkeypatch.setattr(P, "PAIRS_AT_ONCE", 40)
    got = P.cooccurrence_with_context(sections, names, 5, 1, 1, "nothing to do with")
    assert len(want) == 10 and sorted(map(tuple, got.collect())) == want
    assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()  # no row a mention or a pair is dealt out


def test_samples_of_numbered_names(spark, monkeypatch):
    sections, names = told(spark)
    for n in (3, 12):
        want = G.sample_contexts(G.closest_pairs(sections, names, "nothing to do with", digest=False), n).select("a", "b", "section_id", F.col("gap").cast("long"))
        got = P.context_sample(sections, names, "nothing to do with", n)
        assert want.count() >= 30 and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()  # no row a pair and section is dealt out
    monkeypatch.setattr(P, "ROSTER_NAMES", 2)
    assert sorted(map(tuple, P.context_sample(sections, names, "nothing to do with", n).collect())) == sorted(map(tuple, want.collect()))


def test_packed_columns_come_back():
    columns = [P.np.array(x, P.np.int64) for x in ([0, 1, 1 << 40], [7, 7, 300], [0, 0, 0])]
    assert [x.tolist() for x in P._unpack(P._pack(*columns))] == [x.tolist() for x in columns]
