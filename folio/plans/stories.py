"""Queries over summaries, events, bundles, pages, gates and gold scores, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from folio.functions import text as T
from folio.operators import checks as C
from folio.operators import graph as G
from folio.operators import narrative as R
from folio.operators import pairs as P
from folio.operators import scores as S
from folio.plans.catalog import PRINCIPAL, _ROSTER, _SENTENCES, _TOK, _TRADE, _sections, _trade, query
from folio.plans.rules import _SQL_BEATS, _SQL_ENT, _SQL_SPANS, _beats, _entities, _spans
from folio.sources.tables import load

# ---- H: summaries ---------------------------------------------------------------------------------------------------------

_SQL_NOISY = r"(length(trim({0})) < 25 OR length(trim({0})) > 320 OR length(regexp_replace(trim({0}), '[^\p{{L}}]', '', 'g')) < 12)"
_SQL_DIALOGUE = r"""(trim({0}) <> '' AND (substr(trim({0}), 1, 1) IN ('“', '"', '''') OR length(trim({0})) - length(translate(trim({0}), '"''“”', '')) > 0.05::DOUBLE * length(trim({0}))))"""
_SQL_WORDS = r"regexp_extract_all({0}, '([A-Za-zÀ-ÿ'']+)')"


def _sentences(s, d):
    return G.sentence_table(_sections(s, d)).select("section_id", F.col("i").cast("long").alias("i"), "sentence")


@query("H1_noisy", f"WITH {_SENTENCES} SELECT section_id, i, {_SQL_NOISY.format('sentence')} AS noisy FROM sent")
def noisy(s, d):
    return _sentences(s, d).select("section_id", "i", R.noisy(F.col("sentence")).alias("noisy"))


@query("H2_dialogue", f"WITH {_SENTENCES} SELECT section_id, i, {_SQL_DIALOGUE.format('sentence')} AS dialogue FROM sent")
def dialogue(s, d):
    return _sentences(s, d).select("section_id", "i", R.dialogue_heavy(F.col("sentence")).alias("dialogue"))


_SQL_SCORED = f"""{_SENTENCES}, t AS (SELECT section_id, i, sentence, {_SQL_WORDS.format('sentence')} AS t, count(*) OVER (PARTITION BY section_id) AS total FROM sent),
    scored AS (SELECT section_id, i, sentence, CASE WHEN len(t) > 0 THEN 2.0::DOUBLE * len(list_filter(t, lambda x: regexp_matches(x, '^\\p{{Lu}}'))) / len(t) + len(list_distinct(list_transform(t, lambda x: lower(x))))::DOUBLE / len(t) + 0.25::DOUBLE * greatest(0.0::DOUBLE, 1 - i::DOUBLE / greatest(total, 1))
      + CASE WHEN contains(lower(sentence), 'ting') THEN 0.15::DOUBLE ELSE 0 END + CASE WHEN contains(lower(sentence), 'ver') THEN 0.15::DOUBLE ELSE 0 END - CASE WHEN {_SQL_DIALOGUE.format('sentence')} THEN 0.75::DOUBLE ELSE 0 END END AS score, {_SQL_NOISY.format('sentence')} AS noisy FROM t)"""


def _scored(s, d):
    t = _sentences(s, d).withColumn("total", F.count("*").over(W.partitionBy("section_id")))
    score = R.sentence_score(F.col("sentence"), F.col("i"), F.col("total"), ["ting", "ver"], F.lit(0.0))
    return t.select("section_id", "i", "sentence", score.alias("score"), R.noisy(F.col("sentence")).alias("noisy"))


@query("H3_sentence_score", f"WITH {_SQL_SCORED} SELECT section_id, i, round(score, 6) AS score FROM scored")
def sentence_score(s, d):
    return _scored(s, d).select("section_id", "i", F.round("score", 6).alias("score"))


@query("H4_entity_bonus", "WITH w AS (SELECT l_orderkey, CASE l_returnflag WHEN 'R' THEN 0.6::DOUBLE ELSE 0.3::DOUBLE END AS w FROM lineitem WHERE l_returnflag <> 'A') SELECT o_orderkey, round(coalesce(max(w) + 0.1::DOUBLE * (count(w) - 1), 0.0), 6) AS bonus FROM orders LEFT JOIN w ON l_orderkey = o_orderkey GROUP BY o_orderkey")
def entity_bonus(s, d):
    w = load(s, d, "lineitem").where("l_returnflag <> 'A'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(F.when(F.col("l_returnflag") == "R", 0.6).otherwise(0.3)).alias("w"))
    all_ = load(s, d, "orders").select("o_orderkey").join(w, "o_orderkey", "left")
    return all_.select("o_orderkey", F.round(R.entity_bonus(F.coalesce("w", F.array().cast("array<double>"))), 6).alias("bonus"))


@query("H5_top_sentences", f"""WITH {_SQL_SCORED}, r AS (SELECT section_id, i, row_number() OVER (PARTITION BY section_id ORDER BY round(score, 9) DESC, i) AS r FROM scored WHERE NOT noisy AND score IS NOT NULL),
    k AS (SELECT section_id, i FROM r WHERE r <= 3) SELECT section_id, row_number() OVER (PARTITION BY section_id ORDER BY i) AS bullet, i, false AS low_signal FROM k
    UNION ALL SELECT doc_id, 1, NULL, true FROM documents WHERE doc_id NOT IN (SELECT section_id FROM k)""")
def top_sentences(s, d):
    """The best sentences in text order; a section without one gets a fallback bullet, flagged as low signal."""
    good = _scored(s, d).where("not noisy and score is not null")
    r = good.withColumn("r", F.row_number().over(W.partitionBy("section_id").orderBy(F.round("score", 9).desc(), "i"))).where("r <= 3")
    kept = r.select("section_id", F.row_number().over(W.partitionBy("section_id").orderBy("i")).alias("bullet"), "i", F.lit(False).alias("low_signal"))
    none = _sections(s, d).select("section_id").distinct().join(kept, "section_id", "left_anti")
    return kept.unionByName(none.select("section_id", F.lit(1).alias("bullet"), F.lit(None).cast("long").alias("i"), F.lit(True).alias("low_signal")))


@query("H6_bullets", r"WITH b AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '')[1:5] AS b FROM documents WHERE text IS NOT NULL) SELECT doc_id, len(b) AS n, md5(array_to_string(b, chr(10))) AS digest FROM b")
def bullets(s, d):
    b = load(s, d, "documents").where("text is not null").select("doc_id", R.sanitise_bullets(F.split("text", "\n"), 5).alias("b"))
    return b.select("doc_id", F.size("b").cast("long").alias("n"), F.md5(F.array_join("b", "\n")).alias("digest"))


@query("H8_ungrounded", r"""WITH c AS (SELECT conv_id, turn, text AS b, string_agg(text, ' ') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS src FROM conversations WHERE text IS NOT NULL)
    SELECT conv_id, turn, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(b, '([\p{L}'']+)')[2:], lambda t: regexp_matches(t, '^\p{Lu}') AND NOT list_contains(regexp_extract_all(coalesce(src, ''), '([\p{L}'']+)'), t)))), ' ') AS names FROM c""")
def ungrounded(s, d):
    own = load(s, d, "conversations").where("text is not null")
    before = F.array_join(F.collect_list("text").over(W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)), " ")
    return own.withColumn("src", before).select("conv_id", "turn", F.array_join(R.ungrounded(F.col("text"), F.coalesce("src", F.lit(""))), " ").alias("names"))


# ---- I: events ------------------------------------------------------------------------------------------------------------


@query("I3_salience", f"WITH {_SQL_BEATS} SELECT event_id, salience FROM beats")
def salience(s, d):
    return _beats(s, d).select("event_id", "salience")


@query("I5_event_pages", f"WITH {_SQL_BEATS} SELECT user_id, event_id, r AS rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY salience DESC, chapter, event_id) AS r FROM beats WHERE salience >= 0.7 AND participants > 0) WHERE r <= 20")
def event_pages(s, d):
    return R.top_events(_beats(s, d), "user_id", 0.7, 20, ["chapter", "event_id"]).select("user_id", "event_id", "rank")


@query("I8_unique_titles", f"WITH {_SQL_BEATS} SELECT event_id, event_type || CASE WHEN count(*) OVER (PARTITION BY user_id, event_type) > 1 THEN ' (ch. ' || chapter || ')' ELSE '' END AS title FROM beats")
def unique_titles(s, d):
    many = F.count("*").over(W.partitionBy("user_id", "event_type")) > 1
    return _beats(s, d).select("event_id", F.concat("event_type", F.when(many, F.concat(F.lit(" (ch. "), "chapter", F.lit(")"))).otherwise("")).alias("title"))


@query("I9_synopsis", f"WITH {_SQL_BEATS} SELECT user_id, chapter, event_id, row_number() OVER (PARTITION BY user_id, chapter ORDER BY event_id) AS place FROM (SELECT * FROM beats QUALIFY row_number() OVER (PARTITION BY user_id, chapter ORDER BY salience DESC, event_id) <= 3)")
def synopsis(s, d):
    """The three most salient beats of a chapter, back in the order they happened."""
    top = _beats(s, d).withColumn("r", F.row_number().over(W.partitionBy("user_id", "chapter").orderBy(F.desc("salience"), "event_id"))).where("r <= 3")
    return top.select("user_id", "chapter", "event_id", F.row_number().over(W.partitionBy("user_id", "chapter").orderBy("event_id")).alias("place"))


@query("I10_salience_label", f"WITH {_SQL_BEATS} SELECT event_id, CASE WHEN salience >= 0.6 THEN 'high' WHEN salience >= 0.35 THEN 'medium' ELSE 'low' END AS label FROM beats")
def salience_label(s, d):
    return _beats(s, d).select("event_id", R.salience_label(F.col("salience")).alias("label"))


@query("I12_character_arc", f"WITH {_SQL_BEATS} SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY chapter, event_id) AS place FROM (SELECT * FROM beats QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY salience DESC, event_id) <= 18)")
def character_arc(s, d):
    top = _beats(s, d).withColumn("r", F.row_number().over(W.partitionBy("user_id").orderBy(F.desc("salience"), "event_id"))).where("r <= 18")
    return top.select("user_id", "event_id", F.row_number().over(W.partitionBy("user_id").orderBy("chapter", "event_id")).alias("place"))


_MODES = {"AUTOMOBILE": ("dedicated", None), "BUILDING": ("collective", 0.9), "FURNITURE": ("drop", 0.95), "MACHINERY": ("collective", None)}
_SQL_COLLATED = f"""{_SQL_BEATS}, top AS (SELECT user_id, max(salience) AS top FROM beats GROUP BY user_id), collated AS (SELECT c_custkey AS name, c_mktsegment AS tier, c_nationkey AS nation,
    CASE WHEN (c_mktsegment = 'BUILDING' AND top > 0.9) OR (c_mktsegment = 'FURNITURE' AND top > 0.95) THEN 'dedicated' WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'collective' WHEN c_mktsegment = 'FURNITURE' THEN 'drop' ELSE 'dedicated' END AS mode FROM customer LEFT JOIN top ON user_id = c_custkey)"""


def _collated(s, d):
    entities = load(s, d, "customer").select(F.col("c_custkey").alias("name"), F.col("c_mktsegment").alias("tier"))
    return R.collate(entities, _beats(s, d).select(F.col("user_id").alias("name"), "salience"), _MODES)


@query("I13_collation", f"WITH {_SQL_COLLATED} SELECT name, tier, mode FROM collated")
def collation(s, d):
    return _collated(s, d)


@query("I14_collective_pages", f"WITH {_SQL_COLLATED} SELECT tier, count(*) AS n, md5(string_agg(name::VARCHAR, '|' ORDER BY name)) AS digest FROM collated WHERE mode = 'collective' GROUP BY tier")
def collective_pages(s, d):
    own = _collated(s, d).where("mode = 'collective'").groupBy("tier").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("name")).alias("names"))
    return own.select("tier", "n", F.md5(F.array_join("names", "|")).alias("digest"))


# ---- J, K, L: rosters, bundles, pages -------------------------------------------------------------------------------------


@query("J4_roster_rows", f"WITH {_SQL_ENT} SELECT nation, string_agg(name || ' [' || type || ']', '; ' ORDER BY name) AS roster FROM ent WHERE type <> 'OTHER' GROUP BY nation")
def roster_rows(s, d):
    rows = _entities(s, d).where("type <> 'OTHER'").select("nation", F.concat("name", F.lit(" ["), "type", F.lit("]")).alias("row"), "name")
    return rows.groupBy("nation").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", "row"))), lambda x: x["row"]), "; ").alias("roster"))


@query("J5_quote_verified", r"""WITH q AS (SELECT doc_id - doc_id % 2 AS doc_id, trim(regexp_replace(lower(substr(text, 5, 40)), '\s+', ' ', 'g')) AS q FROM documents)
    SELECT DISTINCT d.doc_id FROM documents d JOIN q USING (doc_id) WHERE q <> '' AND contains(trim(regexp_replace(lower(d.text), '\s+', ' ', 'g')), q) AND d.doc_id % 3 > 0""")
def quote_verified(s, d):
    """Quotes of a document and of its odd neighbour, looked up in the even one: a neighbour's quote has to fail unless it is a copy."""
    docs = load(s, d, "documents")
    quotes = docs.select((F.col("doc_id") - F.col("doc_id") % 2).alias("doc_id"), F.substring("text", 5, 40).alias("quote"))
    return C.quoted(quotes, docs.where("doc_id % 3 > 0").select("doc_id", F.col("text").alias("snippet")), "doc_id").select("doc_id").distinct()


@query("J8_roster_cache_key", f"WITH {_SQL_ENT} SELECT nation, sha256('v1|' || string_agg(name, '|' ORDER BY name)) AS key FROM ent GROUP BY nation")
def roster_cache_key(s, d):
    return _entities(s, d).groupBy("nation").agg(F.array_sort(F.collect_list("name")).alias("names")).select("nation", F.sha2(F.concat(F.lit("v1|"), F.array_join("names", "|")), 256).alias("key"))


@query("J9_status_labels", "SELECT doc_id, CASE quality WHEN 0 THEN CASE lang WHEN 'fr' THEN 'décédé' ELSE 'deceased' END ELSE CASE lang WHEN 'fr' THEN 'vivant' ELSE 'alive' END END AS label FROM documents JOIN labels USING (doc_id)")
def status_labels(s, d):
    words = {"deceased": {"fr": "décédé"}, "alive": {"fr": "vivant"}}

    def label(key):
        out = F.lit(key)
        for lang, word in words[key].items():
            out = F.when(F.col("lang") == lang, word).otherwise(out)
        return out

    joined = load(s, d, "documents").join(load(s, d, "labels"), "doc_id")
    return joined.select("doc_id", F.when(F.col("quality") == 0, label("deceased")).otherwise(label("alive")).alias("label"))


@query("K3_first_seen", "SELECT o_custkey, min(o_orderkey::VARCHAR) AS first_seen FROM orders GROUP BY o_custkey")
def first_seen(s, d):
    return load(s, d, "orders").groupBy("o_custkey").agg(F.min(F.col("o_orderkey").cast("string")).alias("first_seen"))


@query("K5_related", f"WITH {_TRADE}, n AS (SELECT src, dst, count(*) AS n FROM trade WHERE src <> dst GROUP BY ALL) SELECT src, dst, n FROM n QUALIFY row_number() OVER (PARTITION BY src ORDER BY n DESC, dst) <= 5")
def related(s, d):
    n = _trade(s, d).where("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))
    return n.withColumn("r", F.row_number().over(W.partitionBy("src").orderBy(F.desc("n"), "dst"))).where("r <= 5").select("src", "dst", "n")


@query("K8_bundle_size", f"WITH {_SQL_ENT}, t AS (SELECT o_custkey, sum(length(o_orderpriority) + length(o_orderstatus))::BIGINT AS c FROM orders GROUP BY 1) SELECT id, length(name) + length(type) + coalesce(c, 0) AS chars FROM ent LEFT JOIN t ON o_custkey = id")
def bundle_size(s, d):
    t = load(s, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.sum(F.length("o_orderpriority") + F.length("o_orderstatus")).alias("c"))
    return _entities(s, d).join(t, "id", "left").select("id", (F.length("name") + F.length("type") + F.coalesce("c", F.lit(0))).cast("long").alias("chars"))


@query("K9_batches", """WITH RECURSIVE o AS (SELECT o_custkey, o_orderkey, 1000 + o_orderkey % 9000 AS size, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders),
    b AS (SELECT o_custkey, o_orderkey, r, 1 AS batch, 1 AS n, size AS total FROM o WHERE r = 1
      UNION ALL SELECT o.o_custkey, o.o_orderkey, o.r, CASE WHEN n + 1 > 3 OR total + size > 20000 THEN batch + 1 ELSE batch END, CASE WHEN n + 1 > 3 OR total + size > 20000 THEN 1 ELSE n + 1 END, CASE WHEN n + 1 > 3 OR total + size > 20000 THEN size ELSE total + size END FROM b JOIN o ON o.o_custkey = b.o_custkey AND o.r = b.r + 1)
    SELECT o_custkey, o_orderkey, batch FROM b""")
def batches(s, d):
    orders = load(s, d, "orders").withColumn("size", F.lit(1000) + F.col("o_orderkey") % 9000)
    return C.batches(orders, "o_custkey", "o_orderkey", "size", 3, 20000).select("o_custkey", F.col("id").alias("o_orderkey"), "batch")


@query("K10_page_worthy", f"WITH {_SQL_ENT} SELECT id FROM ent WHERE n > 0 AND type <> 'OTHER'")
def page_worthy(s, d):
    return _entities(s, d).where("n > 0 and type <> 'OTHER'").select("id")


@query("L1_template", "SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'custom' WHEN c_mktsegment = 'BUILDING' AND c_acctbal > 5000 THEN 'place_principal' WHEN c_mktsegment = 'BUILDING' THEN 'place' ELSE 'generic' END AS template FROM customer")
def template(s, d):
    override = F.when(F.col("c_custkey") % 10 == 0, "custom")
    by_tier = F.when((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 5000), "place_principal")
    by_type = F.when(F.col("c_mktsegment") == "BUILDING", "place")
    return load(s, d, "customer").select("c_custkey", F.coalesce(override, by_tier, by_type, F.lit("generic")).alias("template"))


@query("L7_resume", "SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'new' WHEN l.quality = 0 THEN 'incomplete' WHEN d.doc_id % 7 = 0 THEN 'forced' WHEN sha256(d.lang) <> sha256('en') THEN 'stale' ELSE 'kept' END AS state FROM documents d LEFT JOIN labels l USING (doc_id)")
def resume_pages(s, d):
    """A page stays if it is complete, has today's fingerprint and is not forced."""
    j = load(s, d, "documents").select("doc_id", F.sha2("lang", 256).alias("fp")).join(load(s, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    state = F.when(F.col("quality").isNull(), "new").when(F.col("quality") == 0, "incomplete").when(F.col("doc_id") % 7 == 0, "forced").when(F.col("fp") != F.sha2(F.lit("en"), 256), "stale").otherwise("kept")
    return j.select("doc_id", state.alias("state"))


@query("L9_relation_gate", f"WITH {_TRADE}, p AS (SELECT a AS x, count(*) AS n FROM (SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges) GROUP BY a) SELECT n_nationkey, CASE WHEN coalesce(n, 0) = 0 THEN 'drop' WHEN n >= 3 THEN 'add' ELSE 'as is' END AS section FROM nation LEFT JOIN p ON x = n_nationkey")
def relation_gate(s, d):
    t = _trade(s, d).where("src <> dst")
    p = t.select(F.explode(F.array("src", "dst")).alias("n_nationkey")).groupBy("n_nationkey").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return load(s, d, "nation").select("n_nationkey").join(p, "n_nationkey", "left").select("n_nationkey", F.when(n == 0, "drop").when(n >= 3, "add").otherwise("as is").alias("section"))


@query("L10_fingerprint", "SELECT doc_id, sha256(coalesce(text, '') || chr(31) || coalesce(lang, '') || chr(31) || 'config-1') AS fingerprint FROM documents")
def fingerprint(s, d):
    return load(s, d, "documents").select("doc_id", F.sha2(F.concat_ws("\x1f", F.coalesce("text", F.lit("")), F.coalesce("lang", F.lit("")), F.lit("config-1")), 256).alias("fingerprint"))


# ---- M, N: gates and shaping ----------------------------------------------------------------------------------------------


@query("M14_span_faults", r"""WITH p AS (SELECT conv_id, turn, text, instr(text, 'the') - 1 AS a FROM conversations WHERE text IS NOT NULL), s AS (SELECT conv_id * 1000 + turn AS id, unnest([a, a + 2, length(text) - 1]) AS "start", unnest([a + 3, a + 5, length(text) + 1]) AS "end", text FROM p WHERE a >= 0),
    f AS (SELECT id, "start", "end", CASE WHEN "start" < 0 OR "end" <= "start" OR "end" > length(text) THEN 'bounds' WHEN substr(text, ("start" + 1)::BIGINT, ("end" - "start")::BIGINT) <> 'the' THEN 'mismatch' WHEN coalesce(max("end") OVER (PARTITION BY id ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > "start", false) THEN 'overlap' END AS fault FROM s)
    SELECT coalesce(fault, 'ok') AS fault, count(*) AS n FROM f GROUP BY 1""")
def span_faults(s, d):
    p = load(s, d, "conversations").where("text is not null").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text", (F.instr("text", "the") - 1).alias("a")).where("a >= 0")
    at = F.expr("explode(array(struct(a as start, a + 3 as end), struct(a + 2 as start, a + 5 as end), struct(length(text) - 1 as start, length(text) + 1 as end)))")
    spans = p.select("id", "text", at.alias("s")).select("id", "text", "s.start", "s.end", F.lit("the").alias("surface"))
    return S.span_faults(spans, "id").groupBy(F.coalesce("fault", F.lit("ok")).alias("fault")).agg(F.count("*").alias("n"))


@query("M15_record_routing", "SELECT doc_id, CASE WHEN text IS NULL OR length(trim(text)) < 50 THEN 'rejected' WHEN crc % 20 = 0 THEN 'eval' ELSE 'train' END AS route FROM (SELECT doc_id, text, ('0x' || substr(md5(doc_id::VARCHAR), 1, 6))::INT AS crc FROM documents)")
def record_routing(s, d):
    h = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 6), 16, 10).cast("int")
    bad = F.col("text").isNull() | (F.length(F.trim("text")) < 50)
    return load(s, d, "documents").select("doc_id", F.when(bad, "rejected").when(h % 20 == 0, "eval").otherwise("train").alias("route"))


@query("M16_forbidden_names", f"WITH f AS (SELECT DISTINCT lower(split_part(p_name, ' ', 2)) AS name FROM part UNION SELECT 'the' UNION SELECT 'que') SELECT doc_id, array_to_string(list_sort(list(DISTINCT t)), ',') AS hits FROM (SELECT doc_id, unnest({_TOK.format('text')}) AS t FROM documents) JOIN f ON t = name GROUP BY doc_id")
def forbidden_names(s, d):
    names = load(s, d, "part").select(F.lower(F.split_part("p_name", F.lit(" "), F.lit(2))).alias("name")).union(s.createDataFrame([("the",), ("que",)], "name string")).distinct()
    tokens = load(s, d, "documents").select("doc_id", F.explode(F.array_distinct(T.tokens(F.col("text")))).alias("name"))
    return tokens.join(names, "name").groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_set("name")), ",").alias("hits"))


@query("M17_placeholders", r"SELECT page_id, len(regexp_extract_all(url || html, '(?i)\{\{[^}]*\}\}|\[insert [^\]]*\]|lorem|ref=x')) AS leaks FROM pages WHERE url IS NOT NULL AND html IS NOT NULL")
def placeholders(s, d):
    pages = load(s, d, "pages").where("url is not null and html is not null")
    return pages.select("page_id", F.size(F.regexp_extract_all(F.concat("url", "html"), F.lit(r"(?i)\{\{[^}]*\}\}|\[insert [^\]]*\]|lorem|ref=x"), F.lit(0))).cast("long").alias("leaks"))


@query("N2_category_tags", "SELECT o_custkey, string_agg('[[Category:Volume ' || y || ']]', '' ORDER BY y) AS tags FROM (SELECT DISTINCT o_custkey, year(o_orderdate) AS y FROM orders) GROUP BY o_custkey")
def category_tags(s, d):
    years = load(s, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_set(F.year("o_orderdate"))).alias("y"))
    return years.select("o_custkey", F.array_join(F.transform("y", lambda y: F.concat(F.lit("[[Category:Volume "), y, F.lit("]]"))), "").alias("tags"))


@query("N3_main_page", f"WITH {_SQL_ENT} SELECT type, name, r AS place FROM (SELECT *, row_number() OVER (PARTITION BY type ORDER BY n DESC, name) AS r FROM ent WHERE type IN ('PERSON', 'PLACE')) WHERE r <= 10")
def main_page(s, d):
    e = _entities(s, d).where("type in ('PERSON', 'PLACE')")
    return e.withColumn("place", F.row_number().over(W.partitionBy("type").orderBy(F.desc("n"), "name"))).where("place <= 10").select("type", "name", "place")


@query("N4_spoiler_wrap", "SELECT o_orderkey, CASE WHEN year(o_orderdate) > 1997 THEN '{{Spoiler|' || year(o_orderdate) || '|' || o_orderpriority || '}}' ELSE o_orderpriority END AS body FROM orders")
def spoiler_wrap(s, d):
    y = F.year("o_orderdate")
    return load(s, d, "orders").select("o_orderkey", F.when(y > 1997, F.concat(F.lit("{{Spoiler|"), y, F.lit("|"), "o_orderpriority", F.lit("}}"))).otherwise(F.col("o_orderpriority")).alias("body"))


@query("N6_relation_lines", f"WITH {_TRADE} SELECT a, b, '* ' || max(type) || ' (ch. ' || min(volume) || CASE WHEN max(volume) > min(volume) THEN '–' || max(volume) ELSE '' END || ')' AS line, row_number() OVER (PARTITION BY a ORDER BY max(volume) DESC, b) AS place FROM edges GROUP BY a, b")
def relation_lines(s, d):
    e = G.unordered(_trade(s, d)).groupBy("a", "b").agg(F.max("type").alias("t"), F.min("volume").alias("lo"), F.max("volume").alias("hi"))
    span = F.concat(F.col("lo"), F.when(F.col("hi") > F.col("lo"), F.concat(F.lit("–"), F.col("hi"))).otherwise(""))
    return e.select("a", "b", F.concat(F.lit("* "), "t", F.lit(" (ch. "), span, F.lit(")")).alias("line"), F.row_number().over(W.partitionBy("a").orderBy(F.desc("hi"), "b")).alias("place"))


# ---- O: scores ------------------------------------------------------------------------------------------------------------

_SQL_GOLD = """gold AS (SELECT o_orderkey AS k, CASE o_orderstatus WHEN 'P' THEN NULL ELSE o_orderstatus END AS label FROM orders), pred AS (SELECT l_orderkey AS k, CASE max(l_returnflag) WHEN 'N' THEN NULL WHEN 'R' THEN 'F' ELSE 'O' END AS predicted FROM lineitem WHERE l_linenumber = 2 GROUP BY 1),
    scored AS (SELECT gold.k, label, predicted, pred.k IS NULL AS missing, CASE WHEN (label IS NULL AND predicted IS NULL) OR (label IS NOT NULL AND predicted IS NOT NULL AND (predicted = label OR (gold.k % 9 = 0 AND predicted = 'F'))) THEN 'ok' WHEN label IS NOT NULL AND predicted IS NULL THEN 'false_null' WHEN label IS NULL THEN 'hallucination' ELSE 'wrong_type' END AS verdict FROM gold LEFT JOIN pred ON gold.k = pred.k)"""


def _verdicts(s, d):
    gold = load(s, d, "orders").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("label"), F.when(F.col("o_orderkey") % 9 == 0, F.array(F.lit("F"))).otherwise(F.array().cast("array<string>")).alias("alternates"))
    flag = F.max("l_returnflag")
    pred = load(s, d, "lineitem").where("l_linenumber = 2").groupBy(F.col("l_orderkey").alias("k")).agg(F.when(flag == "N", None).when(flag == "R", "F").otherwise("O").alias("predicted"))
    return S.verdicts(gold, pred, ["k"])


@query("O1_verdicts", f"WITH {_SQL_GOLD} SELECT k, verdict, missing FROM scored")
def verdicts(s, d):
    return _verdicts(s, d).select("k", "verdict", "missing")


@query("O1_class_metrics", f"""WITH {_SQL_GOLD}, c AS (SELECT coalesce(label, 'null') AS t, coalesce(CASE WHEN verdict = 'ok' THEN label ELSE predicted END, 'null') AS p FROM scored), n AS (SELECT t, p, count(*) AS n FROM c GROUP BY ALL), k AS (SELECT t AS label FROM n UNION SELECT p FROM n)
    SELECT label, coalesce(sum(CASE WHEN t = label AND p = label THEN n END), 0)::BIGINT AS tp, coalesce(sum(CASE WHEN t <> label AND p = label THEN n END), 0)::BIGINT AS fp, coalesce(sum(CASE WHEN t = label AND p <> label THEN n END), 0)::BIGINT AS fn, coalesce(sum(CASE WHEN t = label THEN n END), 0)::BIGINT AS support FROM k, n GROUP BY label""")
def class_metrics(s, d):
    return S.class_metrics(_verdicts(s, d))


@query("O2_overgraded", """WITH g AS (SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'inferred' WHEN 'N' THEN 'implicit' ELSE 'explicit' END AS sup, CASE l_linenumber % 4 WHEN 0 THEN NULL WHEN 1 THEN 'inferred' WHEN 2 THEN 'implicit' ELSE 'explicit' END AS pred FROM lineitem)
    SELECT CASE WHEN pred IS NULL THEN 'ungraded' WHEN list_position(['inferred', 'implicit', 'explicit'], pred) > list_position(['inferred', 'implicit', 'explicit'], sup) THEN 'overgraded' ELSE 'ok' END AS verdict, count(*) AS n FROM g GROUP BY 1""")
def overgraded(s, d):
    sup = F.when(F.col("l_returnflag") == "A", "inferred").when(F.col("l_returnflag") == "N", "implicit").otherwise("explicit")
    k = F.col("l_linenumber") % 4
    pred = F.when(k == 1, "inferred").when(k == 2, "implicit").when(k == 3, "explicit")
    verdict = F.when(pred.isNull(), "ungraded").when(S.stronger(pred, sup), "overgraded").otherwise("ok")
    return load(s, d, "lineitem").groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


@query("O3_predictions", f"WITH {_TRADE} SELECT least(src, dst) AS a, greatest(src, dst) AS b, arg_max(type, {{'c': chunk, 's': seq, 't': type}}) AS type FROM trade WHERE src <> dst GROUP BY ALL")
def predictions(s, d):
    """The last prediction of an unordered pair stands."""
    t = _trade(s, d).where("src <> dst")
    return t.groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).agg(F.max_by("type", F.struct("chunk", "seq", "type")).alias("type"))


@query("O4_gate", f"WITH {_SQL_GOLD}, r AS (SELECT sum((verdict = 'false_null')::INT)::DOUBLE / nullif(sum((label IS NOT NULL)::INT), 0) AS fn, sum((verdict = 'hallucination')::INT)::DOUBLE / nullif(sum((label IS NULL)::INT), 0) AS ha FROM scored) SELECT round(fn, 6) AS false_null_rate, round(ha, 6) AS hallucination_rate, coalesce(fn <= 0.3, true) AND coalesce(ha <= 0.3, true) AS passed FROM r")
def gate(s, d):
    v = _verdicts(s, d)

    def rate(verdict, among):
        return F.sum(F.expr(f"if(verdict = '{verdict}', 1, 0)")) / F.nullif(F.sum(F.expr(f"if({among}, 1, 0)")), F.lit(0))

    r = v.agg(rate("false_null", "label is not null").alias("fn"), rate("hallucination", "label is null").alias("ha"))
    return r.select(F.round("fn", 6).alias("false_null_rate"), F.round("ha", 6).alias("hallucination_rate"), (F.coalesce(F.col("fn") <= 0.3, F.lit(True)) & F.coalesce(F.col("ha") <= 0.3, F.lit(True))).alias("passed"))


@query("O5_mention_deltas", "WITH y AS (SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY ALL), o AS (SELECT o_custkey, n FROM y WHERE y = 1996), w AS (SELECT o_custkey, n FROM y WHERE y = 1997) SELECT o_custkey, coalesce(w.n, 0) - coalesce(o.n, 0) AS delta FROM o FULL JOIN w USING (o_custkey)")
def mention_deltas(s, d):
    n = load(s, d, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))
    old, new = (n.where(F.col("y") == y).select("o_custkey", F.col("n").alias(c)) for y, c in ((1996, "was"), (1997, "now")))
    zero = F.lit(0).cast("long")
    return old.join(new, "o_custkey", "full").select("o_custkey", (F.coalesce("now", zero) - F.coalesce("was", zero)).alias("delta"))


_SQL_TWO = """g AS (SELECT l_orderkey AS k, l_linenumber * 3 AS a, l_linenumber * 3 + 2 AS b, l_returnflag AS t FROM lineitem WHERE l_linenumber <= 3), f AS (SELECT l_orderkey AS k, l_linenumber * 3 + l_partkey % 2 AS a, l_linenumber * 3 + 2 AS b, CASE WHEN l_partkey % 5 = 0 THEN 'A' ELSE l_returnflag END AS t FROM lineitem WHERE l_linenumber >= 2),
    m AS (SELECT g.k, g.a AS ga, g.b AS gb, g.t AS gt, f.a AS fa, f.b AS fb, f.t AS ft FROM g JOIN f ON g.k = f.k AND g.a < f.b AND f.a < g.b)"""
_SQL_ROW = "SELECT '{0}' AS metric, (SELECT count(*) FROM (SELECT DISTINCT k, ga, gb, gt FROM m WHERE {1})) AS gold_hits, (SELECT count(*) FROM (SELECT DISTINCT k, fa, fb, ft FROM m WHERE {1})) AS found_hits"


@query("O8_span_scores", f"WITH {_SQL_TWO} " + " UNION ALL ".join(_SQL_ROW.format(n, c) for n, c in (("overlap_detection", "true"), ("overlap_typing", "gt = ft"), ("exact_detection", "ga = fa AND gb = fb"), ("exact_typing", "ga = fa AND gb = fb AND gt = ft"))))
def span_scores(s, d):
    line = load(s, d, "lineitem")
    at = F.col("l_linenumber") * 3
    gold = line.where("l_linenumber <= 3").select("l_orderkey", at.alias("start"), (at + 2).alias("end"), F.col("l_returnflag").alias("label"))
    found = line.where("l_linenumber >= 2").select("l_orderkey", (at + F.col("l_partkey") % 2).alias("start"), (at + 2).alias("end"), F.when(F.col("l_partkey") % 5 == 0, "A").otherwise(F.col("l_returnflag")).alias("label"))
    return S.span_scores(gold, found, "l_orderkey")


@query("O20_chunk_census", r"SELECT source, count(*) AS chapters, sum(length(text))::BIGINT AS chars, sum(ceil(length(text) / 6000))::BIGINT AS chunks FROM documents WHERE text IS NOT NULL AND length(text) > 0 GROUP BY source")
def chunk_census(s, d):
    docs = load(s, d, "documents").where("length(text) > 0")
    return docs.groupBy("source").agg(F.count("*").alias("chapters"), F.sum(F.length("text")).alias("chars"), F.sum(F.ceil(F.length("text") / 6000)).alias("chunks"))


@query("P3_cache_key", "SELECT source, sha256(string_agg(md5(coalesce(text, '')), '' ORDER BY doc_id, md5(coalesce(text, ''))) || '|config-1') AS key FROM documents GROUP BY source")
def cache_key(s, d):
    """A book's key over its chapters' digests and the configuration: digests travel, texts don't."""
    h = load(s, d, "documents").select("source", "doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("h"))
    own = h.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("doc_id", "h"))).alias("hs"))
    return own.select("source", F.sha2(F.concat(F.array_join(F.transform("hs", lambda x: x["h"]), ""), F.lit("|config-1")), 256).alias("key"))


# ---- F: contexts ----------------------------------------------------------------------------------------------------------

_SQL_ROSTER = _ROSTER.format(tok=_TOK.format("text"), floor=PRINCIPAL)
_NEGATIONS = "it wasn.t with|it was not with|nothing to do with|not involved with|wasn.t involved with|had no connection"
# a name right after "of " is part of an artefact's name and doesn't count: the two together become one mark before words are taken
_SQL_FREE = f"""free AS (SELECT section_id, i, name, sentence FROM (SELECT section_id, i, sentence, unnest(list_distinct({_TOK.format('sentence')})) AS w FROM sent) JOIN roster ON w = name WHERE list_contains({_TOK.format("replace(lower(sentence), 'of ' || name, chr(1))")}, name)),
    near AS (SELECT x.section_id, x.name AS a, y.name AS b, least(x.i, y.i) AS lo, abs(x.i - y.i) AS gap, CASE WHEN x.i = y.i THEN x.sentence WHEN x.i < y.i THEN x.sentence || ' ' || y.sentence ELSE y.sentence || ' ' || x.sentence END AS span FROM free x JOIN free y ON x.section_id = y.section_id AND x.name < y.name AND abs(x.i - y.i) <= 1),
    ctx AS (SELECT * FROM near WHERE NOT regexp_matches(lower(span), '{_NEGATIONS}'))"""


def _near(s, d):
    sec = _sections(s, d)
    return G.near_pairs(G.free_hits(sec, G.roster(sec, PRINCIPAL)), _NEGATIONS)


@query("F3_tightest_span", f"WITH {_SENTENCES}, {_SQL_ROSTER}, {_SQL_FREE} SELECT section_id, a, b, gap, md5(span) AS digest FROM ctx QUALIFY row_number() OVER (PARTITION BY section_id, a, b ORDER BY gap, lo) = 1")
def tightest_span(s, d):
    sec = _sections(s, d)
    return G.closest_pairs(sec, G.roster(sec, PRINCIPAL), _NEGATIONS).withColumn("gap", F.col("gap").cast("long"))


@query("F5_context_sample", f"""WITH {_SENTENCES}, {_SQL_ROSTER}, {_SQL_FREE}, one AS (SELECT section_id, a, b, gap FROM ctx QUALIFY row_number() OVER (PARTITION BY section_id, a, b ORDER BY gap, lo) = 1),
    r AS (SELECT *, row_number() OVER (PARTITION BY a, b, gap ORDER BY section_id) - 1 AS r, count(*) OVER (PARTITION BY a, b, gap) AS n, count(CASE WHEN gap = 0 THEN 1 END) OVER (PARTITION BY a, b) AS same FROM one),
    k AS (SELECT *, CASE WHEN gap = 0 THEN 12 ELSE 12 - least(12, same) END AS k FROM r)
    SELECT a, b, section_id, gap FROM k WHERE k > 0 AND (n <= k OR floor(ceil(r * k / n) * n / k) = r AND ceil(r * k / n) < k)""")
def context_sample(s, d):
    """Of a pair's contexts, one a section, twelve evenly spaced: those of one sentence first, then neighbours."""
    sec = _sections(s, d)
    return P.context_sample(sec, G.roster(sec, PRINCIPAL), _NEGATIONS, 12)


@query("F26_proximity", f"WITH {_SENTENCES}, {_SQL_ROSTER}, {_SQL_FREE} SELECT a, b, count(*) AS n, count(CASE WHEN gap = 0 THEN 1 END) AS same FROM near GROUP BY a, b")
def proximity(s, d):
    sec = _sections(s, d)
    near = G.near_pairs(G.free_hits(sec, G.roster(sec, PRINCIPAL)), None)
    return near.groupBy("a", "b").agg(F.count("*").alias("n"), F.count(F.expr("if(gap = 0, 1, null)")).alias("same"))


@query("F1_cooccurrence", f"""WITH {_SENTENCES}, {_SQL_ROSTER}, {_SQL_FREE},
    hits AS (SELECT DISTINCT section_id, i, w AS name FROM (SELECT section_id, i, unnest({_TOK.format("sentence")}) AS w FROM sent) JOIN roster ON w = name),
    starts AS (SELECT DISTINCT section_id, st, name FROM hits, range(greatest(0, i - 4), i + 1) r(st)),
    pairs AS (SELECT x.section_id, x.name AS a, y.name AS b FROM starts x JOIN starts y ON x.section_id = y.section_id AND x.st = y.st AND x.name < y.name),
    counted AS (SELECT a, b, count(*) AS windows, count(DISTINCT section_id) AS sections FROM pairs GROUP BY a, b HAVING count(*) >= 5 AND count(DISTINCT section_id) >= 2)
    SELECT a, b, windows, sections, count(DISTINCT section_id) AS contexts FROM counted JOIN ctx USING (a, b) GROUP BY ALL""")
def cooccurrence(s, d):
    """Pairs by sentence windows, of those that have a context: both names within neighbouring sentences, no denial."""
    sec = _sections(s, d)
    return P.cooccurrence_with_context(sec, G.roster(sec, PRINCIPAL), 5, 5, 2, _NEGATIONS)
