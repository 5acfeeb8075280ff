"""Queries over the rule operators: names, cleaning, narrative, votes and scores, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from folio.functions import text as T
from folio.operators import checks as C
from folio.operators import graph as G
from folio.operators import names as N
from folio.operators import narrative as R
from folio.operators import scores as S
from folio.plans.catalog import _GRAPH, _SENTENCES, _TRADE, _edges, _graph, _sections, query
from folio.sources.tables import first_success, load

# ---- shared inputs -------------------------------------------------------------------------------------------------------

TITLES = ["economy", "large", "medium", "promo", "small", "standard"]
MASCULINE, FEMININE = ["economy", "promo"], ["large", "standard"]
_LIST = "[" + ", ".join(f"'{t}'" for t in TITLES) + "]"
_SQL_NAMES = f"""names AS (SELECT DISTINCT p_type || ' ' || p_name AS name FROM part),
    w AS (SELECT name, string_split(trim(lower(name)), ' ') AS w FROM names),
    l AS (SELECT name, w, coalesce(nullif(list_position(list_transform(w, lambda x: list_contains({_LIST}, x)), false), 0), len(w) + 1) - 1 AS lead FROM w),
    tok AS (SELECT name, w, lead, w[least(lead, len(w) - 1) + 1:] AS t FROM l)"""
_SQL_NORM = "replace(translate(lower({0}), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), 'ß', 'ss')"
_KINDS = {"AUTOMOBILE": "PERSON", "HOUSEHOLD": "PERSON", "BUILDING": "PLACE", "FURNITURE": "ORG"}
_SQL_KIND = "CASE {0} WHEN 'AUTOMOBILE' THEN 'PERSON' WHEN 'HOUSEHOLD' THEN 'PERSON' WHEN 'BUILDING' THEN 'PLACE' WHEN 'FURNITURE' THEN 'ORG' ELSE 'OTHER' END"
_SQL_ENT = f"""ent AS (SELECT c_custkey AS id, c_name AS name, {_SQL_KIND.format('c_mktsegment')} AS type, c_nationkey AS nation, count(o_orderkey) AS n, count(DISTINCT o_orderdate) AS chapters
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL)"""


def _names(s, d) -> DataFrame:
    return load(s, d, "part").select(F.concat_ws(" ", "p_type", "p_name").alias("name")).distinct()


def _kind(c):
    out = F.lit("OTHER")
    for segment, kind in _KINDS.items():
        out = F.when(c == segment, F.lit(kind)).otherwise(out)
    return out


def _entities(s, d) -> DataFrame:
    """Customers as entities: their orders are mentions, their order days chapters."""
    mentions = load(s, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("n"), F.count_distinct("o_orderdate").alias("chapters"))
    own = load(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), _kind(F.col("c_mktsegment")).alias("type"), F.col("c_nationkey").alias("nation"))
    return own.join(mentions, "id", "left").withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n", "chapters")})


_FIRST = r"regexp_extract(text, '^\s*([^\s]+)', 1)"  # a turn's first word as a span


def _spans(s, d) -> DataFrame:
    return load(s, d, "conversations").select("conv_id", "turn", "role", F.regexp_extract("text", r"^\s*([^\s]+)", 1).alias("surface")).where("surface <> ''")


_SQL_SPANS = f"spans AS (SELECT conv_id, turn, role, {_FIRST} AS surface FROM conversations WHERE {_FIRST} <> '')"


def _beats(s, d) -> DataFrame:
    """Events as beats: chapter = hour of day + 1 of 24, weight by type, cue = purchase."""
    weight = F.when(F.col("event_type") == "purchase", 1.0).when(F.col("event_type") == "signup", 0.6).when(F.col("event_type") == "click", 0.3)
    e = load(s, d, "events").select("event_id", "user_id", "event_type", (F.hour("ts") + 1).alias("chapter"), weight.alias("w"))
    weights = F.when(F.col("w").isNull(), F.array().cast("array<double>")).otherwise(F.array("w"))
    return e.select("event_id", "user_id", "event_type", "chapter", F.size(weights).alias("participants"), R.salience(F.col("event_type") == "purchase", weights, F.col("chapter"), F.lit(24)).alias("salience"))


_SQL_BEATS = """beats AS (SELECT event_id, user_id, event_type, hour(ts) + 1 AS chapter, CASE WHEN event_type IN ('purchase', 'signup', 'click') THEN 1 ELSE 0 END AS participants,
    round(least(CASE WHEN event_type = 'purchase' THEN 0.35 ELSE 0 END::DOUBLE + 0.45::DOUBLE * CASE event_type WHEN 'purchase' THEN 1.0 WHEN 'signup' THEN 0.6 WHEN 'click' THEN 0.3 ELSE 0.0 END::DOUBLE + 0.20::DOUBLE * (hour(ts) + 1) / 24, 1.0::DOUBLE), 3) AS salience FROM events)"""

# ---- A: sources ----------------------------------------------------------------------------------------------------------


@query("A2_chapter_cap", "SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 12")
def chapter_cap(s, d):
    docs = load(s, d, "documents").select("source", "doc_id")
    return docs.withColumn("r", F.row_number().over(W.partitionBy("source").orderBy("doc_id"))).where("r <= 12").drop("r")


@query("A3_toc_titles", "SELECT n_nationkey, CASE WHEN length('N' || n_nationkey) <= 6 THEN (CASE WHEN length(r_name) <= 6 THEN 'World — ' || r_name ELSE r_name END) || ' — N' || n_nationkey END AS title FROM nation JOIN region ON n_regionkey = r_regionkey")
def toc_titles(s, d):
    def titled(own, parent):
        return F.when(F.length(own) <= 6, F.concat(parent, F.lit(" — "), own)).otherwise(own)

    region = load(s, d, "region").select(F.col("r_regionkey").alias("n_regionkey"), titled(F.col("r_name"), F.lit("World")).alias("parent"))
    return load(s, d, "nation").join(F.broadcast(region), "n_regionkey").select("n_nationkey", titled(F.concat(F.lit("N"), "n_nationkey"), F.col("parent")).alias("title"))


@query("A4_chapter_title", r"""SELECT page_id, coalesce(nullif(trim(regexp_extract(html, '(?is)<h[1-3][^>]*>(.*?)</h[1-3]>', 1)), ''), nullif(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), ''), regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1)) AS title FROM pages""")
def chapter_title(s, d):
    def part(tag):
        return F.nullif(F.trim(F.regexp_extract("html", rf"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1)), F.lit(""))

    base = F.regexp_extract(F.regexp_replace("url", r"[?#].*$", ""), r"([^/]*)$", 1)
    return load(s, d, "pages").select("page_id", F.coalesce(part("h[1-3]"), part("title"), base).alias("title"))


@query("A10_tolerant_json", r"SELECT event_id, (regexp_extract(CASE WHEN event_id % 3 = 0 THEN props ELSE 'Sure: ' || props || ' Done.' END, '(?s)\{.*\}') ->> 'k')::INTEGER AS k FROM events")
def tolerant_json(s, d):
    raw = F.when(F.col("event_id") % 3 == 0, F.col("props")).otherwise(F.concat(F.lit("Sure: "), "props", F.lit(" Done.")))
    e = load(s, d, "events").select("event_id", raw.alias("raw"))
    return e.select("event_id", F.coalesce(F.from_json("raw", "k int")["k"], F.from_json(F.regexp_extract("raw", r"(?s)\{.*\}", 0), "k int")["k"]).alias("k"))


@query("A11_first_success", "SELECT role AS stage, arg_min(text, conv_id * 1000 + turn) AS output FROM conversations WHERE text IS NOT NULL AND length(text) % 2 = 0 GROUP BY role")
def run_log(s, d):
    log = load(s, d, "conversations").where("text is not null").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("line_no"), F.lit("stage_complete").alias("event"), F.col("role").alias("stage"), F.expr("if(length(text) % 2 = 0, 'success', 'failed')").alias("status"), F.col("text").alias("output")
    )
    stages = [first_success(log, x).withColumn("stage", F.lit(x)) for x in ("assistant", "system", "user")]
    return stages[0].unionByName(stages[1]).unionByName(stages[2]).where("output is not null")


@query("A14_resolve_query", """WITH q AS (SELECT n_name AS q FROM nation UNION SELECT substr(n_name, 4) FROM nation), hit AS (SELECT q, n.n_name AS slug, q = n.n_name AS exact FROM q JOIN nation n ON contains(lower(n.n_name), lower(q)))
    SELECT q, CASE WHEN bool_or(exact) THEN q WHEN count(*) = 1 THEN max(slug) END AS slug FROM hit GROUP BY q""")
def resolve_query(s, d):
    nation = load(s, d, "nation").select(F.col("n_name").alias("slug"))  # a library's slugs: one row a book
    asked = nation.select(F.explode(F.array("slug", F.expr("substr(slug, 4)"))).alias("q")).distinct()
    hit = asked.join(F.broadcast(nation), F.lower("slug").contains(F.lower("q")))
    exact = F.bool_or(F.col("q") == F.col("slug"))
    return hit.groupBy("q").agg(F.when(exact, F.first("q")).when(F.count("*") == 1, F.max("slug")).alias("slug"))


@query("A16_reading_order", r"""WITH v AS (SELECT p_partkey, p_brand, CASE WHEN p_partkey % 5 = 0 THEN p_name ELSE (p_size // 2) || CASE WHEN p_size % 2 = 1 THEN '.5' ELSE '' END || '-' || p_name END AS stem FROM part)
    SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY try_cast(nullif(regexp_extract(stem, '^(\d+(?:\.\d+)?)', 1), '') AS DOUBLE) NULLS LAST, stem, p_partkey) AS position FROM v""")
def reading_order(s, d):
    stem = F.expr("if(p_partkey % 5 = 0, p_name, concat(p_size div 2, if(p_size % 2 = 1, '.5', ''), '-', p_name))")
    number = F.nullif(F.regexp_extract(stem, r"^(\d+(?:\.\d+)?)", 1), F.lit("")).try_cast("double")
    by = W.partitionBy("p_brand").orderBy(number.asc_nulls_last(), stem, "p_partkey")
    return load(s, d, "part").select("p_partkey", F.row_number().over(by).alias("position"))


# ---- B: cleaning ---------------------------------------------------------------------------------------------------------


@query("B2_drop_caps", r"""WITH b AS (SELECT doc_id, string_split(regexp_replace(text, '\s+', ' ', 'g'), ' ') AS b FROM documents WHERE text IS NOT NULL),
    f AS (SELECT doc_id, b, list_transform(range(1, len(b) + 1), lambda i: i < len(b) AND regexp_matches(b[i], '^\p{Lu}$') AND regexp_matches(b[i + 1], '^\p{Ll}')) AS cap FROM b)
    SELECT doc_id, len(b) - len(list_filter(cap, lambda c: c)) AS blocks, md5(array_to_string(list_transform(list_filter(range(1, len(b) + 1), lambda i: i = 1 OR NOT cap[i - 1]), lambda i: CASE WHEN cap[i] THEN b[i] || b[i + 1] ELSE b[i] END), ' ')) AS digest FROM f""")
def drop_caps(s, d):
    # words stand for leaf blocks: single capitals before lower case occur among them
    blocks = F.split(F.regexp_replace("text", r"\s+", " "), " ")
    merged = load(s, d, "documents").where("text is not null").select("doc_id", N.merge_drop_caps(blocks).alias("m"))
    return merged.select("doc_id", F.size("m").alias("blocks"), F.md5(F.array_join("m", " ")).alias("digest"))


@query("B4_clean_text", r"""SELECT doc_id, md5(regexp_replace(translate(replace(replace(replace(replace(replace(replace(replace(nfc_normalize(text), 'ﬀ', 'ff'), 'ﬁ', 'fi'), 'ﬂ', 'fl'), 'ﬃ', 'ffi'), 'ﬄ', 'ffl'), 'ﬅ', 'st'), 'ﬆ', 'st'),
    'ʻ’‘ʼ′＇«»' || chr(160) || chr(8239) || chr(13) || chr(10), '''''''''''''""' || '    '), '[ \t]{2,}', ' ', 'g')) AS digest FROM documents WHERE text IS NOT NULL""")
def clean_text(s, d):
    return load(s, d, "documents").where("text is not null").select("doc_id", F.md5(T.normalise(F.col("text"))).alias("digest"))


@query("B6_normalise_name", f"SELECT doc_id, md5(trim({_SQL_NORM.format('text')})) AS digest FROM documents WHERE text IS NOT NULL")
def normalise_name(s, d):
    return load(s, d, "documents").where("text is not null").select("doc_id", F.md5(N.normalise(F.col("text"))).alias("digest"))


@query("B7_surface_key", f"WITH {_SQL_SPANS} SELECT DISTINCT surface, trim(regexp_replace(regexp_replace(trim({_SQL_NORM.format('surface')}), '[^0-9a-z ]', ' ', 'g'), ' +', ' ', 'g')) AS key FROM spans")
def surface_key(s, d):
    return _spans(s, d).select("surface", N.surface_key(F.col("surface")).alias("key")).distinct()


@query("B8_entity_slug", f"WITH {_SQL_SPANS}, n AS (SELECT DISTINCT surface, coalesce(nullif(trim(regexp_replace(trim({_SQL_NORM.format('surface')}), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'unnamed') AS slug FROM spans) SELECT surface, slug || CASE WHEN row_number() OVER w = 1 THEN '' ELSE '_' || row_number() OVER w END AS entity_id FROM n WINDOW w AS (PARTITION BY slug ORDER BY surface)")
def entity_slug(s, d):
    n = _spans(s, d).select("surface").distinct().withColumn("slug", N.slug(F.col("surface")))
    r = F.row_number().over(W.partitionBy("slug").orderBy("surface"))
    return n.select("surface", F.concat("slug", F.when(r == 1, F.lit("")).otherwise(F.concat(F.lit("_"), r))).alias("entity_id"))


_SQL_PLAIN = "translate(text, '’‘', '''''')"


@query("B10_stance_fold", f"SELECT doc_id, md5({_SQL_NORM.format(_SQL_PLAIN)}) AS digest FROM documents WHERE text IS NOT NULL")
def stance_fold(s, d):
    plain = F.translate("text", "’‘", "''")
    return load(s, d, "documents").where("text is not null").select("doc_id", F.md5(F.replace(F.translate(F.lower(plain), N.MARKED, N.PLAIN), F.lit("ß"), F.lit("ss"))).alias("digest"))


@query("B18_markers", r"SELECT conv_id, turn FROM conversations WHERE regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])(?:tion|the|que|der)($|[^\p{L}\p{N}_])')")
def markers(s, d):
    return load(s, d, "conversations").where(N.has_marker(F.col("text"), ["the", "que", "der", "tion"])).select("conv_id", "turn")


@query("B19_word_pattern", "SELECT doc_id, len(regexp_extract_all(text, '(?i)(?:tions|tion|the|th)')) AS hits FROM documents WHERE text IS NOT NULL")
def word_pattern(s, d):
    return load(s, d, "documents").where("text is not null").select("doc_id", F.size(F.regexp_extract_all("text", F.lit(N.word_pattern(["th", "the", "tion", "tions"])), F.lit(0))).cast("long").alias("hits"))


@query("B20_chunks", r"""WITH p AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: {'done': []::VARCHAR[], 'now': x}) AS p FROM documents WHERE text IS NOT NULL),
    r AS (SELECT doc_id, list_reduce(p, lambda a, b: CASE WHEN a.now <> '' AND length(a.now) + length(b.now) > 600 THEN {'done': list_append(a.done, a.now), 'now': b.now} ELSE {'done': a.done, 'now': CASE WHEN a.now = '' THEN b.now ELSE a.now || chr(10) || chr(10) || b.now END} END) AS r FROM p),
    c AS (SELECT doc_id, CASE WHEN r.now = '' THEN r.done ELSE list_append(r.done, r.now) END AS c FROM r)
    SELECT doc_id, i - 1 AS chunk, md5(c[i]) AS digest FROM c, range(1, len(c) + 1) t(i)""")
def chunks(s, d):
    text = F.replace("text", F.lit("\n"), F.lit("\n\n"))  # the texts' lines stand for paragraphs
    packed = load(s, d, "documents").where("text is not null").select("doc_id", F.posexplode(T.pack_chunks(text, 600)).alias("chunk", "body"))
    return packed.select("doc_id", F.col("chunk").cast("long").alias("chunk"), F.md5("body").alias("digest"))


@query("B23_wiki_to_text", r"SELECT page_id, trim('See ' || regexp_replace(url, '[\[\]{}|]', '', 'g') || ' at ' || regexp_replace(url, '[\[\]{}|]', '', 'g') || ' end') AS body FROM pages WHERE url IS NOT NULL")
def wiki_text(s, d):
    u = F.regexp_replace("url", r"[\[\]{}|]", "")
    raw = F.concat(F.lit("See [[Page|"), u, F.lit("]] at [["), u, F.lit("]]{{Infobox|a=1}} end<ref>r</ref>[[Category:N]]"))
    return load(s, d, "pages").where("url is not null").select("page_id", T.wiki_to_text(raw).alias("body"))


@query("B25_md_to_wiki", r"""WITH m AS (SELECT doc_id, i, CASE (doc_id + i) % 6 WHEN 0 THEN '# ' || l WHEN 1 THEN '## ' || l WHEN 2 THEN '### ' || l WHEN 3 THEN '#### ' || l WHEN 4 THEN '> ' || l ELSE '**' || l || '**' END AS l FROM (SELECT doc_id, i, string_split(text, chr(10))[i] AS l FROM documents, range(1, len(string_split(text, chr(10))) + 1) r(i) WHERE text IS NOT NULL)),
    c AS (SELECT doc_id, i, l, regexp_replace(regexp_replace(regexp_replace(l, '^#+ ', ''), '\*\*(.+?)\*\*', '''''''\1''''''', 'g'), '\*(.+?)\*', '''''\1''''', 'g') AS x FROM m)
    SELECT doc_id, md5(string_agg(CASE WHEN l LIKE '>%' THEN '' WHEN regexp_matches(l, '^#{1,4} ') THEN repeat('=', length(regexp_extract(l, '^#+'))) || ' ' || x || ' ' || repeat('=', length(regexp_extract(l, '^#+'))) ELSE x END, chr(10) ORDER BY i)) AS digest FROM c GROUP BY doc_id""")
def md_to_wiki(s, d):
    marks = F.array(*map(F.lit, ("# ", "## ", "### ", "#### ", "> ", "**")))
    line = F.transform(F.split("text", "\n"), lambda t, i: F.concat(F.get(marks, ((F.col("doc_id") + i + 1) % 6).cast("int")), t, F.when((F.col("doc_id") + i + 1) % 6 == 5, "**").otherwise("")))
    return load(s, d, "documents").where("text is not null").select("doc_id", F.md5(T.md_to_wiki(F.array_join(line, "\n"))).alias("digest"))


@query("B26_infobox_call", "SELECT c_custkey, '{{Infobox' || chr(10) || '|name=' || c_name || CASE WHEN c_acctbal >= 0 THEN chr(10) || '|segment=' || c_mktsegment ELSE '' END || chr(10) || '}}' AS call FROM customer")
def infobox_call(s, d):
    fields = {"name": F.col("c_name"), "segment": F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).otherwise("")}
    lines = [F.when(v != "", F.concat(F.lit(f"|{k}="), v)) for k, v in fields.items()]  # empty values are left out
    return load(s, d, "customer").select("c_custkey", F.concat_ws("\n", F.lit("{{Infobox"), *lines, F.lit("}}")).alias("call"))


@query("B29_redirect_or_stub", "SELECT doc_id, coalesce(starts_with(lower(trim(text)), '#redirect'), false) AS redirect, length(coalesce(text, '')) < 200 AS stub FROM documents")
def redirect_or_stub(s, d):
    t = F.coalesce("text", F.lit(""))
    return load(s, d, "documents").select("doc_id", F.lower(F.trim(t)).startswith("#redirect").alias("redirect"), (F.length(t) < 200).alias("stub"))


# ---- C: position, point of view ------------------------------------------------------------------------------------------

FIRST_PERSON = {"en": ["i", "me", "it"], "de": ["ich", "die"], "fr": ["je", "le"]}
THOUGHTS = {"en": ["thought", "this"], "de": ["dachte", "ver"]}


def _sql_hits(words: list[str]) -> str:
    # each hit eats its left neighbour only: a space is doubled so that neighbouring words have one each
    return rf"len(regexp_extract_all(regexp_replace(text, '([^\p{{L}}\p{{N}}_])', '\1\1', 'g'), '(?i)(?:^|[^\p{{L}}\p{{N}}_])(?:{'|'.join(words)})(?:$|[^\p{{L}}\p{{N}}_])'))"


@query("C3_point_of_view", rf"""WITH c AS (SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS n,
      CASE lang WHEN 'en' THEN {_sql_hits(FIRST_PERSON['en'])} WHEN 'de' THEN {_sql_hits(FIRST_PERSON['de'])} WHEN 'fr' THEN {_sql_hits(FIRST_PERSON['fr'])} ELSE 0 END AS f,
      CASE lang WHEN 'en' THEN {_sql_hits(THOUGHTS['en'])} > 0 WHEN 'de' THEN {_sql_hits(THOUGHTS['de'])} > 0 ELSE false END AS t FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, CASE WHEN n > 0 AND f / n > 0.01 THEN 'first_person' WHEN n > 0 AND t THEN 'third_limited' ELSE 'omniscient' END AS pov,
      CASE WHEN n = 0 THEN 'low' WHEN f / n > 0.05 THEN 'high' WHEN f / n > 0.01 THEN 'medium' WHEN f > 0 THEN 'low' ELSE 'high' END AS confidence FROM c""")
def point_of_view(s, d):
    docs = load(s, d, "documents").where("text is not null")
    return docs.select("doc_id", R.detect_pov(F.col("text"), F.col("lang"), FIRST_PERSON, THOUGHTS).alias("p")).select("doc_id", "p.pov", "p.confidence")


@query("C7_temporal_context", "SELECT doc_id, CASE WHEN lang = 'en' THEN CASE WHEN contains(lower(text), 'thatand') OR contains(lower(text), 'erst') THEN 'flashback' ELSE 'present' END WHEN lang = 'de' THEN CASE WHEN contains(lower(text), 'einst') THEN 'flashback' ELSE 'present' END ELSE 'unknown' END AS context FROM documents WHERE text IS NOT NULL")
def temporal_context(s, d):
    docs = load(s, d, "documents").where("text is not null")
    return docs.select("doc_id", R.temporal_context(F.col("text"), F.coalesce("lang", F.lit("")), {"en": ["thatand", "erst"], "de": ["einst"]}).alias("context"))


@query("C8_front_matter", "SELECT d.doc_id, coalesce(max(l.quality) = 0, false) AS front_matter FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY d.doc_id")
def front_matter(s, d):
    verdict = load(s, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("q"))  # ids that no section has fall out of the left join
    return load(s, d, "documents").select("doc_id").distinct().join(verdict, "doc_id", "left").select("doc_id", F.coalesce(F.col("q") == 0, F.lit(False)).alias("front_matter"))


@query("C10_revealed", f"WITH {_TRADE} SELECT a, b, min(volume) AS revealed, max(volume) AS unit FROM edges GROUP BY a, b")
def revealed(s, d):
    return _edges(s, d).groupBy("a", "b").agg(F.min("volume").alias("revealed"), F.max("volume").alias("unit"))


# ---- D: mentions ---------------------------------------------------------------------------------------------------------


@query("D1_label_map", f"SELECT c_mktsegment AS label, {_SQL_KIND.format('c_mktsegment')} AS kind, c_mktsegment = 'MACHINERY' AS unmapped, count(*) AS n FROM customer GROUP BY ALL")
def label_map(s, d):
    label = F.col("c_mktsegment")
    return load(s, d, "customer").groupBy(label.alias("label"), _kind(label).alias("kind"), (~label.isin(*_KINDS)).alias("unmapped")).agg(F.count("*").alias("n"))


@query("D2_extract_entities", f"""WITH {_SQL_SPANS}, k AS (SELECT lower(trim(surface)) AS key, * FROM spans), c AS (SELECT key, sum(kept)::BIGINT AS contexts FROM (SELECT key, conv_id, least(3, count(*)) AS kept FROM k GROUP BY ALL) GROUP BY key)
    SELECT key, arg_min(role, {{'c': conv_id, 't': turn}}) AS type, array_to_string(list_sort(list(DISTINCT surface)), '|') AS variants, count(*) AS mention_count, any_value(contexts) AS contexts FROM k JOIN c USING (key) GROUP BY key""")
def extract_entities(s, d):
    spans = _spans(s, d).withColumn("key", F.lower(F.trim("surface")))
    kept = spans.groupBy("key", "conv_id").agg(F.least(F.lit(3), F.count("*")).alias("kept")).groupBy("key").agg(F.sum("kept").alias("contexts"))
    own = spans.groupBy("key").agg(
        F.min_by("role", F.struct("conv_id", "turn")).alias("type"), F.array_join(F.array_sort(F.collect_set("surface")), "|").alias("variants"), F.count("*").alias("mention_count")
    )
    return own.join(kept, "key")


@query("D4_mention_validity", rf"WITH {_SQL_SPANS} SELECT surface, count(*) AS n FROM spans WHERE length(surface) >= 3 AND regexp_matches(surface, '^\p{{Lu}}') AND NOT regexp_matches(surface, '(?i)^(?:the|and|der|die|das|les|que)$') AND NOT regexp_matches(surface, '^I(?:would|will|have)') GROUP BY surface")
def mention_validity(s, d):
    ok = (F.length("surface") >= 3) & F.col("surface").rlike(r"^\p{Lu}") & ~F.col("surface").rlike("(?i)^(?:the|and|der|die|das|les|que)$") & ~F.col("surface").rlike("^I(?:would|will|have)")
    return _spans(s, d).where(ok).groupBy("surface").agg(F.count("*").alias("n"))


@query("D10_overlap_free", """WITH s AS (SELECT l_orderkey, l_linenumber AS a, l_linenumber + l_partkey % 3 + 1 AS b FROM lineitem),
    o AS (SELECT l_orderkey, list_transform(list_sort(list(DISTINCT {'k': a - b, 'a': a, 'b': b})), lambda x: [{'a': x.a, 'b': x.b}]) AS o FROM s GROUP BY l_orderkey)
    SELECT l_orderkey, len(list_reduce(o, lambda acc, x: CASE WHEN len(list_filter(acc, lambda y: x[1].a < y.b AND y.a < x[1].b)) > 0 THEN acc ELSE list_concat(acc, x) END)) AS kept FROM o""")
def overlap_free(s, d):
    span = F.struct(F.col("l_linenumber").cast("int").alias("start"), (F.col("l_linenumber") + F.pmod("l_partkey", F.lit(3)) + 1).cast("int").alias("end"))
    spans = load(s, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set(span)).alias("spans"))
    return spans.select("l_orderkey", F.size(T.overlap_free(F.col("spans"))).cast("long").alias("kept"))


@query("D12_partition_by_type", f"WITH {_SQL_ENT} SELECT type, count(*) AS entities, sum(n)::BIGINT AS mentions FROM ent WHERE type IN ('PERSON', 'PLACE', 'ORG') GROUP BY type")
def partition_by_type(s, d):
    return _entities(s, d).where(F.col("type").isin("PERSON", "PLACE", "ORG")).groupBy("type").agg(F.count("*").alias("entities"), F.sum("n").alias("mentions"))


# ---- E: identity ---------------------------------------------------------------------------------------------------------


@query("E1_name_tokens", f"WITH {_SQL_NAMES} SELECT name, array_to_string(t, ' ') AS tokens FROM tok")
def name_tokens(s, d):
    return _names(s, d).select("name", F.array_join(N.name_tokens(F.col("name"), TITLES), " ").alias("tokens"))


@query("E2_titles", f"WITH {_SQL_NAMES} SELECT name, array_to_string(list_sort(list_distinct(w[1:lead])), ' ') AS titles FROM tok")
def leading_titles(s, d):
    return _names(s, d).select("name", F.array_join(N.leading_titles(F.col("name"), TITLES), " ").alias("titles"))


@query("E3_surname", f"WITH {_SQL_NAMES} SELECT name, t[len(t)] AS surname, array_to_string(t[1:len(t) - 1], ' ') AS first_names FROM tok")
def surname(s, d):
    return _names(s, d).select("name", N.surname(F.col("name"), TITLES).alias("surname"), F.array_join(N.first_names(F.col("name"), TITLES), " ").alias("first_names"))


_SQL_MATCH = f"""CASE WHEN len(list_intersect(ta, tb)) = len(list_distinct(ta)) AND len(list_intersect(ta, tb)) = len(list_distinct(tb)) THEN true
    WHEN len(list_intersect(ta, tb)) IN (len(list_distinct(ta)), len(list_distinct(tb))) THEN NOT (len(sm) = 1 AND list_contains({_LIST}, sm[1])) AND NOT both_given
    ELSE len(list_intersect(ta, tb)) > 0 AND (len(list_distinct(ta)) = 1 OR len(list_distinct(tb)) = 1) AND NOT both_given END"""
_SQL_MET = """met AS (SELECT x.name AS a, y.name AS b, x.t AS ta, y.t AS tb, x.w[1:x.lead] AS la, y.w[1:y.lead] AS lb,
    CASE WHEN len(list_distinct(x.t)) <= len(list_distinct(y.t)) THEN x.t ELSE y.t END AS sm, len(x.t) = 1 AND length(x.t[1]) <= 8 AND len(y.t) = 1 AND length(y.t[1]) <= 8 AS both_given FROM tok x JOIN tok y ON x.name < y.name)"""


@query("E5_token_match", f"WITH {_SQL_NAMES}, {_SQL_MET} SELECT a, b FROM met WHERE {_SQL_MATCH}")
def token_match(s, d):
    return N.matching_pairs(_names(s, d), TITLES, [], [])


@query("E7_should_cluster", f"""WITH {_SQL_NAMES}, {_SQL_MET} SELECT a, b FROM met WHERE {_SQL_MATCH}
    AND NOT (list_has_any(la, ['economy', 'promo']) AND list_has_any(lb, ['large', 'standard'])) AND NOT (list_has_any(la, ['large', 'standard']) AND list_has_any(lb, ['economy', 'promo']))""")
def should_cluster(s, d):
    """The gender veto and the token rule; E4 and E9 hold the rule by similarity."""
    return N.matching_pairs(_names(s, d), TITLES, MASCULINE, FEMININE)


@query("E8_toponym_in_title", f"""WITH {_SQL_NAMES}, p AS (SELECT DISTINCT split_part(p_name, ' ', 1) || ' of ' || split_part(p_name, ' ', 2) AS person FROM part)
    SELECT person, name AS place FROM p, tok WHERE list_contains(t, split_part(person, ' ', 3))""")
def toponym_in_title(s, d):
    person = load(s, d, "part").select(F.concat_ws(" of ", F.split_part("p_name", F.lit(" "), F.lit(1)), F.split_part("p_name", F.lit(" "), F.lit(2))).alias("person")).distinct()
    place = _names(s, d).select(F.col("name").alias("place"))
    # only names that share a token meet
    met = person.withColumn("t", F.explode(N.words(F.col("person")))).join(place.withColumn("t", F.explode(N.words(F.col("place")))), "t").select("person", "place").distinct()
    return met.where(N.toponym_in_title(F.col("place"), F.col("person"), ["of"], TITLES))


@query("E14_reduction", "SELECT count(*) AS mentions, count(DISTINCT p_name) AS clusters, round(100.0 * (count(*) - count(DISTINCT p_name)) / count(*), 1) AS reduction_pct FROM part")
def reduction(s, d):
    return load(s, d, "part").agg(F.count("*").alias("mentions"), F.count_distinct("p_name").alias("clusters")).withColumn("reduction_pct", F.round(100.0 * (F.col("mentions") - F.col("clusters")) / F.col("mentions"), 1))


@query("E15_split_clusters", "SELECT p_type, sum((n = 1)::INT)::BIGINT AS singles, sum((n > 1)::INT)::BIGINT AS multi FROM (SELECT p_type, p_name, count(DISTINCT p_brand) AS n FROM part GROUP BY ALL) GROUP BY p_type")
def split_clusters(s, d):
    c = load(s, d, "part").groupBy("p_type", "p_name").agg(F.count_distinct("p_brand").alias("n"))
    return c.groupBy("p_type").agg(F.sum(F.expr("if(n = 1, 1L, 0L)")).alias("singles"), F.sum(F.expr("if(n > 1, 1L, 0L)")).alias("multi"))


@query("E16_relevance", rf"WITH {_SQL_SPANS} SELECT DISTINCT surface, length(surface) >= 2 AND NOT list_contains(['the', 'and', 'it', 'as'], lower(surface)) AND NOT regexp_matches(surface, '^\p{{Ll}}') AS relevant FROM spans")
def relevance(s, d):
    ok = (F.length("surface") >= 2) & ~F.lower("surface").isin("the", "and", "it", "as") & ~F.col("surface").rlike(r"^\p{Ll}")
    return _spans(s, d).select("surface", ok.alias("relevant")).distinct()


@query("E33_retired_aliases", "WITH y AS (SELECT DISTINCT o_custkey, year(o_orderdate) AS y FROM orders) SELECT o_custkey, y FROM y WHERE y < (SELECT max(y) FROM y) AND NOT EXISTS (SELECT 1 FROM y z WHERE z.o_custkey = y.o_custkey AND z.y = y.y + 1)")
def retired(s, d):
    """An owner's alias of one volume that the next volume lacks, for all volumes that have a next one."""
    y = load(s, d, "orders").select("o_custkey", F.year("o_orderdate").cast("long").alias("y")).distinct()
    next_ = y.select("o_custkey", (F.col("y") - 1).alias("y"))
    return y.join(F.broadcast(y.agg(F.max("y").alias("last")))).where("y < last").drop("last").join(next_, ["o_custkey", "y"], "left_anti")


@query("E35_invariants", "WITH c AS (SELECT p_brand AS owner, lower(p_name) AS alias, p_type AS kind FROM part) SELECT alias, kind, count(DISTINCT owner) AS owners FROM c GROUP BY ALL HAVING count(DISTINCT owner) > 1")
def invariants(s, d):
    """Aliases that several owners of one type claim; other types may share them."""
    return load(s, d, "part").groupBy(F.lower("p_name").alias("alias"), F.col("p_type").alias("kind")).agg(F.count_distinct("p_brand").alias("owners")).where("owners > 1")


@query("E39_arbitration", """WITH c AS (SELECT o_custkey, o_orderstatus AS value, 6 - substr(o_orderpriority, 1, 1)::INT AS authority, o_orderkey % 7 = 0 AS prim FROM orders),
    t AS (SELECT * FROM c QUALIFY authority = max(authority) OVER (PARTITION BY o_custkey)), g AS (SELECT o_custkey, count(DISTINCT value) AS v, max(value) AS mv, count(DISTINCT CASE WHEN prim THEN value END) AS p, max(CASE WHEN prim THEN value END) AS mp FROM t GROUP BY o_custkey)
    SELECT o_custkey, CASE WHEN v = 1 THEN mv WHEN p = 1 THEN mp END AS value, v > 1 AND p <> 1 AS flagged FROM g""")
def arbitration(s, d):
    claims = load(s, d, "orders").select("o_custkey", F.col("o_orderstatus").alias("value"), (6 - F.substring("o_orderpriority", 1, 1).cast("int")).alias("authority"), (F.col("o_orderkey") % 7 == 0).alias("primary"))
    return S.arbitrate(claims, "o_custkey")


# ---- F: relations --------------------------------------------------------------------------------------------------------


@query("F2_name_lookup", """WITH o AS (SELECT lower(p_name) AS key, arg_max(p_name, p_partkey) AS canonical FROM part GROUP BY 1),
    al AS (SELECT lower(a) AS key, arg_min(p_name, {'o': p_partkey, 'c': p_name}) AS canonical FROM (SELECT p_partkey, p_name, unnest(string_split(p_name, ' ')) AS a FROM part) WHERE length(a) >= 4 GROUP BY 1)
    SELECT * FROM o UNION ALL SELECT * FROM al WHERE key NOT IN (SELECT key FROM o)""")
def name_lookup(s, d):
    return N.name_lookup(load(s, d, "part").select(F.col("p_partkey").alias("order"), F.col("p_name").alias("canonical"), F.split("p_name", " ").alias("aliases")))


_SQL_TYPED = f"typed AS (SELECT a, b, n, CASE a % 5 WHEN 0 THEN 'PLACE' WHEN 1 THEN 'OTHER' WHEN 2 THEN NULL ELSE 'PERSON' END AS ta, CASE b % 5 WHEN 0 THEN 'PLACE' WHEN 1 THEN 'OTHER' WHEN 2 THEN NULL ELSE 'PERSON' END AS tb FROM graph)"


def _typed(s, d):
    def kind(c):
        return F.when(F.col(c) % 5 == 0, "PLACE").when(F.col(c) % 5 == 1, "OTHER").when(F.col(c) % 5 > 2, "PERSON")

    return _graph(s, d).withColumns({"ta": kind("a"), "tb": kind("b")})


@query("F8_interpersonal", f"WITH {_GRAPH}, {_SQL_TYPED} SELECT a, b, n FROM typed WHERE coalesce(ta, '') NOT IN ('PLACE', 'OTHER') AND coalesce(tb, '') NOT IN ('PLACE', 'OTHER')")
def interpersonal(s, d):
    keep = [~F.coalesce(c, F.lit("")).isin("PLACE", "OTHER") for c in ("ta", "tb")]  # unknown types stay
    return _typed(s, d).where(keep[0] & keep[1]).select("a", "b", "n")


@query("F11_intra_entity", "SELECT p_name AS a, upper(q) AS b, count(*) AS n FROM (SELECT p_name, unnest([p_name, p_type]) AS q FROM part) WHERE lower(p_name) <> lower(q) GROUP BY ALL")
def intra_entity(s, d):
    pairs = load(s, d, "part").select(F.col("p_name").alias("a"), F.explode(F.array("p_name", "p_type")).alias("q")).select("a", F.upper("q").alias("b"))
    return pairs.where(F.lower("a") != F.lower("b")).groupBy("a", "b").agg(F.count("*").alias("n"))


@query("F13_roster", f"WITH {_SQL_ENT} SELECT name AS canonical, '- ' || name || CASE WHEN n > 0 THEN ' (' || n || ')' ELSE '' END AS line FROM ent WHERE type = 'PERSON'")
def roster_lines(s, d):
    return _entities(s, d).where("type = 'PERSON'").select(F.col("name").alias("canonical"), F.concat(F.lit("- "), "name", F.when(F.col("n") > 0, F.concat(F.lit(" ("), "n", F.lit(")"))).otherwise("")).alias("line"))


@query("F14_vote_reasons", f"""WITH {_TRADE}, v AS (SELECT CASE WHEN chunk % 11 = 0 THEN '' ELSE src::VARCHAR END AS a, dst::VARCHAR AS b, type, CASE WHEN seq % 4 = 0 THEN 'c->a' ELSE 'a->b' END AS dir FROM trade)
    SELECT coalesce(CASE WHEN trim(a) = '' OR trim(b) = '' THEN 'blank' WHEN a::INT >= 20 OR b::INT >= 20 THEN 'off-roster' WHEN a = b THEN 'self-pair' WHEN type NOT IN ('N', 'R') THEN 'type' WHEN dir <> 'a->b' THEN 'direction' END, 'kept') AS reason, count(*) AS n FROM v GROUP BY 1""")
def vote_reasons(s, d):
    from folio.plans.catalog import _trade

    v = _trade(s, d).select(F.when(F.col("chunk") % 11 == 0, "").otherwise(F.col("src").cast("string")).alias("a"), F.col("dst").cast("string").alias("b"), "type", F.when(F.col("seq") % 4 == 0, "c->a").otherwise("a->b").alias("dir"))
    known = (F.col("a").try_cast("int") < 20) & (F.col("b").try_cast("int") < 20)
    reason = S.vote_reason(F.col("a"), F.col("b"), F.col("type"), F.col("dir"), known, ["N", "R"], ["a->b", "b->a", "mutual"])
    return v.groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query("F15_map_output", "SELECT c_custkey AS chunk, CASE WHEN count(o_orderkey) = 0 THEN 'failed' WHEN count(CASE WHEN o_orderstatus = 'P' THEN 1 END) = 0 THEN 'empty' ELSE 'votes' END AS state, count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS votes FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def map_output(s, d):
    """A chunk without a result has failed; one whose result holds no vote is empty."""
    got = load(s, d, "orders").groupBy(F.col("o_custkey").alias("chunk")).agg(F.count(F.expr("if(o_orderstatus = 'P', 1, null)")).alias("votes"))
    all_ = load(s, d, "customer").select(F.col("c_custkey").alias("chunk")).join(got, "chunk", "left")
    state = F.when(F.col("votes").isNull(), "failed").when(F.col("votes") == 0, "empty").otherwise("votes")
    return all_.select("chunk", state.alias("state"), F.coalesce("votes", F.lit(0).cast("long")).alias("votes"))


@query("F17_uncached", "SELECT doc_id FROM documents WHERE text IS NOT NULL AND md5(text) NOT IN (SELECT md5(text) FROM documents WHERE text IS NOT NULL AND lang = 'en')")
def uncached(s, d):
    docs = load(s, d, "documents").where("text is not null").select("doc_id", "lang", F.md5("text").alias("h"))
    return docs.join(docs.where("lang = 'en'").select("h").distinct(), "h", "left_anti").select("doc_id")


@query("F19_book_graph", f"WITH {_GRAPH}, {_SQL_TYPED} SELECT a, b, n FROM typed WHERE ta = 'PERSON' AND tb = 'PERSON' AND n > 0")
def book_graph(s, d):
    return _typed(s, d).where("ta = 'PERSON' and tb = 'PERSON' and n > 0").select("a", "b", "n")


@query("F20_stale_roster", "WITH o AS (SELECT o_orderpriority AS g, year(o_orderdate) AS y, o_custkey FROM orders), van AS (SELECT DISTINCT x.g FROM o x WHERE x.y = 1996 AND NOT EXISTS (SELECT 1 FROM o z WHERE z.g = x.g AND z.y = 1997 AND z.o_custkey = x.o_custkey)) SELECT g, count(*) AS written FROM o WHERE y = 1997 AND g NOT IN (SELECT g FROM van) GROUP BY g UNION ALL SELECT g, 0 FROM van")
def stale_roster(s, d):
    """A graph (here an order priority's) is written only if every name of the roster before is still there."""
    o = load(s, d, "orders").select(F.col("o_orderpriority").alias("g"), F.year("o_orderdate").alias("y"), "o_custkey")
    old, new = (o.where(F.col("y") == y) for y in (1996, 1997))
    gone = old.join(new, ["g", "o_custkey"], "left_anti").select("g").distinct().withColumn("stale", F.lit(True))
    written = new.groupBy("g").agg(F.count("*").alias("n"))
    return written.join(gone, "g", "full").select("g", F.when(F.col("stale"), F.lit(0)).otherwise(F.col("n")).cast("long").alias("written"))


_SQL_GRADED = "graded AS (SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'A') AS kind, CASE WHEN l_linenumber % 3 = 0 THEN ' ' ELSE 'seen' END AS evidence, CASE l_linestatus WHEN 'O' THEN ' Implicit' ELSE 'odd' END AS grade FROM lineitem)"
_SQL_TIER = "CASE WHEN kind IS NULL OR trim(evidence) = '' THEN 'inferred' WHEN lower(trim(grade)) IN ('inferred', 'implicit', 'explicit') THEN lower(trim(grade)) ELSE 'explicit' END"


def _graded(s, d):
    g = load(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.nullif("l_returnflag", F.lit("A")).alias("kind"), F.when(F.col("l_linenumber") % 3 == 0, " ").otherwise("seen").alias("evidence"), F.when(F.col("l_linestatus") == "O", " Implicit").otherwise("odd").alias("grade"))
    return g.withColumn("tier", S.confidence(F.col("kind"), F.col("evidence"), F.col("grade")))


@query("F24_confidence", f"WITH {_SQL_GRADED} SELECT l_orderkey, l_linenumber, {_SQL_TIER} AS tier FROM graded")
def confidence(s, d):
    return _graded(s, d).select("l_orderkey", "l_linenumber", "tier")


@query("F25_stronger", f"WITH {_SQL_GRADED}, t AS (SELECT l_orderkey, l_linenumber, {_SQL_TIER} AS tier FROM graded) SELECT l_orderkey, l_linenumber FROM t WHERE list_position(['inferred', 'implicit', 'explicit'], tier) > 2")
def stronger(s, d):
    return _graded(s, d).where(S.stronger(F.col("tier"), F.lit("implicit"))).select("l_orderkey", "l_linenumber")


# ---- G: notability -------------------------------------------------------------------------------------------------------

_SHARES, _FIXED = {"principal": 0.9, "secondary": 0.6, "figurant": 0.1}, {"principal": 20, "secondary": 10, "figurant": 3}


@query("G1_surface_index", f"WITH {_SQL_NAMES}, k AS (SELECT DISTINCT lower(p_name) AS key, p_brand FROM part) SELECT key, array_to_string(list_sort(list(p_brand)), ',') AS entries FROM k GROUP BY key")
def surface_index(s, d):
    keys = load(s, d, "part").select(N.surface_key(F.col("p_name")).alias("key"), "p_brand").distinct()
    return keys.groupBy("key").agg(F.array_join(F.array_sort(F.collect_set("p_brand")), ",").alias("entries"))


@query("G4_thresholds", f"""WITH {_SQL_ENT}, t AS (SELECT type, list_sort(list(n)) AS c FROM ent GROUP BY type)
    SELECT type, CASE WHEN len(c) < 4 THEN 20 ELSE c[1 + greatest(0, floor(len(c) * 0.9::DOUBLE)::INT - 1)] END::BIGINT AS principal, CASE WHEN len(c) < 4 THEN 10 ELSE c[1 + greatest(0, floor(len(c) * 0.6::DOUBLE)::INT - 1)] END::BIGINT AS secondary, CASE WHEN len(c) < 4 THEN 3 ELSE c[1 + greatest(0, floor(len(c) * 0.1::DOUBLE)::INT - 1)] END::BIGINT AS figurant FROM t""")
def thresholds(s, d):
    return S.thresholds(_entities(s, d).select("type", "n"), _SHARES, _FIXED)


@query("G6_classify", f"""WITH {_SQL_ENT}, e AS (SELECT *, CASE WHEN id % 4 = 0 THEN 0 ELSE n END AS m FROM ent), t AS (SELECT type, list_sort(list(m)) AS c FROM e GROUP BY type),
    k AS (SELECT type, CASE WHEN len(c) < 4 THEN 20 ELSE c[1 + greatest(0, floor(len(c) * 0.9::DOUBLE)::INT - 1)] END AS p, CASE WHEN len(c) < 4 THEN 10 ELSE c[1 + greatest(0, floor(len(c) * 0.6::DOUBLE)::INT - 1)] END AS s, CASE WHEN len(c) < 4 THEN 3 ELSE c[1 + greatest(0, floor(len(c) * 0.1::DOUBLE)::INT - 1)] END AS f FROM t)
    SELECT id, CASE WHEN id % 4 = 0 THEN 'ignored' WHEN m >= p AND chapters >= 2 THEN 'principal' WHEN m >= s THEN 'secondary' WHEN m >= f THEN 'figurant' ELSE 'ignored' END AS importance FROM e JOIN k USING (type)""")
def classify(s, d):
    """Irrelevant entities count 0, stay among the counts that thresholds come from, and are ignored; the first tier has a chapter gate."""
    e = _entities(s, d).withColumn("n", F.when(F.col("id") % 4 == 0, 0).otherwise(F.col("n")).cast("long"))
    marked = e.join(F.broadcast(S.thresholds(e.select("type", "n"), _SHARES, _FIXED)), "type")
    tier = F.when(F.col("id") % 4 == 0, "ignored").when((F.col("n") >= F.col("principal")) & (F.col("chapters") >= 2), "principal").when(F.col("n") >= F.col("secondary"), "secondary").when(F.col("n") >= F.col("figurant"), "figurant").otherwise("ignored")
    return marked.select("id", tier.alias("importance"))


@query("G8_role_entities", f"WITH {_GRAPH}, {_SQL_TYPED}, e AS (SELECT a AS x, tb AS t, b AS o FROM typed UNION ALL SELECT b, ta, a FROM typed) SELECT n_nationkey, coalesce(count(DISTINCT CASE WHEN t = 'PERSON' THEN o END), 0) >= 3 AS kept FROM nation LEFT JOIN e ON x = n_nationkey GROUP BY n_nationkey")
def role_entities(s, d):
    t = _typed(s, d)
    ends = t.select(F.col("a").alias("x"), F.col("tb").alias("t"), F.col("b").alias("o")).unionByName(t.select(F.col("b").alias("x"), F.col("ta").alias("t"), F.col("a").alias("o")))
    partners = ends.where("t = 'PERSON'").groupBy(F.col("x").alias("n_nationkey")).agg(F.count_distinct("o").alias("p"))
    return load(s, d, "nation").select("n_nationkey").join(partners, "n_nationkey", "left").select("n_nationkey", F.coalesce(F.col("p") >= 3, F.lit(False)).alias("kept"))


@query("G9_overrides", f"WITH {_GRAPH}, m AS (SELECT CASE WHEN a IN (3, 4) THEN 1 ELSE a END AS a, CASE WHEN b IN (3, 4) THEN 1 ELSE b END AS b, n FROM graph WHERE a <> 7 AND b <> 7) SELECT least(a, b) AS a, greatest(a, b) AS b, sum(n)::BIGINT AS n FROM m WHERE a <> b GROUP BY ALL")
def overrides(s, d):
    """Excluded nodes go with their edges; merged ones hand them on, and an edge within a merger vanishes."""
    def owner(c):
        return F.when(F.col(c).isin(3, 4), 1).otherwise(F.col(c))

    m = _graph(s, d).where("a <> 7 and b <> 7").select(owner("a").alias("a"), owner("b").alias("b"), "n").where("a <> b")
    return m.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("n").alias("n"))
