"""All queries over the reference operators, each with its SQL. Keys start with the inventory's row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.operators import analysis as A
from folio.operators import graph as G
from folio.operators import identity as I
from folio.sources.tables import load, resume, sections, trade
from folio.streaming import accumulate

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def _sections(s: SparkSession, d: str) -> DataFrame:
    return sections(load(s, d, "documents"))


def _trade(s: SparkSession, d: str) -> DataFrame:
    return trade(*(load(s, d, t) for t in ("lineitem", "orders", "customer", "supplier")))


def _edges(s: SparkSession, d: str) -> DataFrame:
    return G.unordered(_trade(s, d))


def _graph(s: SparkSession, d: str) -> DataFrame:
    """The nation graph of all trade; an edge's type is its greatest return flag."""
    return _edges(s, d).groupBy("a", "b").agg(F.count("*").alias("n"), F.max("type").alias("type"))


MENTIONED, NAMED, PRINCIPAL = 3, 20, 50  # fewest mentions of a name in the gazetteer, in similarity, and in the graph

# pieces of SQL shared by several oracles
_DOC = "documents"
_TOK = r"list_filter(string_split(regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'), ' '), lambda w: w <> '')"
_SENT = r"list_filter(string_split(regexp_replace(trim(regexp_replace({0}, '\s+', ' ', 'g')), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: s <> '')"
_SENTENCES = f"sent AS (SELECT source AS book, doc_id AS section_id, i - 1 AS i, s[i] AS sentence FROM (SELECT source, doc_id, {_SENT.format('text')} AS s FROM documents), range(1, len(s) + 1) r(i))"
_ROSTER = "roster AS (SELECT name FROM (SELECT unnest({tok}) AS name FROM documents) WHERE length(name) >= 6 GROUP BY name HAVING count(*) >= {floor})"
_TRADE = (
    "trade AS (SELECT c_nationkey AS src, s_nationkey AS dst, year(o_orderdate) AS volume, l_returnflag AS type, l_orderkey AS chunk, l_linenumber AS seq "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey), "
    "edges AS (SELECT least(src, dst) AS a, greatest(src, dst) AS b, CASE WHEN src < dst THEN 'a->b' ELSE 'b->a' END AS direction, volume, type, chunk, seq FROM trade WHERE src <> dst)"
)
_GRAPH = _TRADE + ", graph AS (SELECT a, b, count(*) AS n, max(type) AS type FROM edges GROUP BY a, b)"


@query("B1_flatten_inline", r"SELECT page_id, md5(regexp_replace(html, '(?i)</?(?:span|em|i|b|strong|small|sup|sub|a|u|cite|abbr)(?:\s[^>]*)?/?>', '', 'g')) AS digest FROM pages")
def flatten(s, d):
    return load(s, d, "pages").select("page_id", F.md5(T.flatten_inline(F.col("html"))).alias("digest"))


@query("B3_block_count", r"SELECT page_id, len(regexp_extract_all(html, '(?i)</(?:p|div|h[1-6]|blockquote|li)\s*>')) AS blocks FROM pages")
def blocks(s, d):
    marked = T.mark_blocks(F.col("html"))
    return load(s, d, "pages").select("page_id", (F.length(marked) - F.length(F.replace(marked, F.lit("\u0001"), F.lit("")))).cast("long").alias("blocks"))


@query("A4_page_title", r"SELECT page_id, coalesce(nullif(trim(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)), ''), nullif(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), ''), url) AS title FROM pages")
def page_title(s, d):
    part = lambda tag: F.nullif(F.trim(F.regexp_extract("html", rf"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1)), F.lit(""))
    return load(s, d, "pages").select("page_id", F.coalesce(part("h1"), part("title"), "url").alias("title"))


@query("A19_resume", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_scan(s, d):
    return resume(load(s, d, "documents").select("doc_id"), load(s, d, "labels"), "doc_id")


@query("A22_batch_filter", "SELECT p_brand, p_partkey, p_name FROM part WHERE p_brand IN (SELECT min(p_brand) FROM part UNION SELECT max(p_brand) FROM part) AND contains(lower(p_name), 'a')")
def batch_filter(s, d):
    part = load(s, d, "part")
    ends = part.agg(F.min("p_brand").alias("lo"), F.max("p_brand").alias("hi")).select(F.explode(F.array("lo", "hi")).alias("p_brand"))
    return part.join(F.broadcast(ends), "p_brand", "left_semi").where(F.lower("p_name").contains("a")).select("p_brand", "p_partkey", "p_name")


@query("B8_slug_ids", r"SELECT name, CASE WHEN r = 1 THEN slug ELSE slug || '_' || r END AS entity_id FROM (SELECT c_name AS name, slug, row_number() OVER (PARTITION BY slug ORDER BY c_name) AS r FROM (SELECT DISTINCT c_name, coalesce(nullif(trim(regexp_replace(lower(substr(c_name, 1, 15)), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'unnamed') AS slug FROM customer))")
def slug_ids(s, d):
    names = load(s, d, "customer").select(F.col("c_name").alias("name")).distinct()
    return I.slug_ids(names, T.slug(F.substring("name", 1, 15)))


_PLAIN = "translate(text, '’‘“”«»–—', '''''" + '"' * 4 + "--')"


@query("B9_fold", rf"SELECT doc_id, md5(lower(trim(regexp_replace(replace({_PLAIN}, '…', '...'), '\s+', ' ', 'g')))) AS digest FROM documents")
def folded(s, d):
    return load(s, d, "documents").select("doc_id", F.md5(T.fold(F.col("text"))).alias("digest"))


@query("B11_tokens", f"SELECT doc_id, len(t) AS n, len(list_distinct(t)) AS n_distinct FROM (SELECT doc_id, {_TOK.format('text')} AS t FROM documents)")
def tokens(s, d):
    t = T.tokens(F.col("text"))
    return load(s, d, "documents").select("doc_id", F.size(t).cast("long").alias("n"), F.size(F.array_distinct(t)).cast("long").alias("n_distinct"))


@query("B13_sentences", f"WITH {_SENTENCES} SELECT section_id, i, md5(sentence) AS digest FROM sent")
def sentences(s, d):
    return G.sentence_table(_sections(s, d)).select("section_id", F.col("i").cast("long").alias("i"), F.md5("sentence").alias("digest"))


@query("B16_section_rows", r"SELECT doc_id, length(text) AS chars, substr(trim(regexp_replace(text, '\s+', ' ', 'g')), 1, 200) AS head FROM documents")
def section_rows(s, d):
    head = F.substring(F.trim(F.regexp_replace("text", r"\s+", " ")), 1, 200)
    return load(s, d, "documents").select("doc_id", F.length("text").cast("long").alias("chars"), head.alias("head"))


@query("B17_contains_run", "SELECT doc_id FROM documents WHERE contains(' ' || lower(text) || ' ', ' of the ') OR contains(' ' || lower(text) || ' ', ' de la ')")
def contains_run(s, d):
    low = F.lower("text")
    return load(s, d, "documents").where(T.contains_run(low, F.lit("of the")) | T.contains_run(low, F.lit("de la"))).select("doc_id")


@query("B32_filename", "SELECT p_partkey, translate(p_name || '/' || p_brand, ' /', '__') AS file FROM part")
def filename(s, d):
    return load(s, d, "part").select("p_partkey", T.page_filename(F.concat("p_name", F.lit("/"), "p_brand")).alias("file"))


@query("B33_first_number", r"SELECT page_id, try_cast(regexp_extract(url, '\d+', 0) AS INTEGER) AS number FROM pages")
def first_number(s, d):
    return load(s, d, "pages").select("page_id", T.first_number(F.col("url")).alias("number"))


@query("C1_narrative_position", "SELECT source AS book, doc_id AS section_id, CASE WHEN length(text) >= 1000 THEN sum(CASE WHEN length(text) >= 1000 THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY doc_id)::BIGINT END AS number FROM documents")
def position(s, d):
    return A.narrative_position(_sections(s, d), 1000)


_FIRST = "('i','me','my','je','moi','ich','mir','yo')"
_POV = f"pov AS (SELECT source AS book, doc_id AS section_id, len(list_filter(t, lambda w: w IN {_FIRST})) / greatest(len(t), 1) AS first_share FROM (SELECT *, {_TOK.format('text')} AS t FROM documents))"


@query("C3_point_of_view", f"WITH {_POV} SELECT *, CASE WHEN first_share > 0.05 THEN 'first' WHEN first_share > 0.01 THEN 'first_weak' ELSE 'third' END AS pov FROM pov")
def point_of_view(s, d):
    return A.point_of_view(_sections(s, d))


@query("C4_modal_pov", f"WITH {_POV}, v AS (SELECT book, section_id, CASE WHEN first_share > 0.05 THEN 'first' WHEN first_share > 0.01 THEN 'first_weak' ELSE 'third' END AS pov FROM pov), c AS (SELECT book, pov, count(*) AS n, min(section_id) AS p FROM v GROUP BY ALL) SELECT book, pov, n FROM c QUALIFY row_number() OVER (PARTITION BY book ORDER BY n DESC, p) = 1")
def modal_pov(s, d):
    return A.modal(A.point_of_view(_sections(s, d)), "book", "pov", "section_id")


@query("C7_cues", "SELECT doc_id, CASE WHEN contains(lower(text), 'then') OR contains(lower(text), 'enfin') OR contains(lower(text), 'dann') THEN 'flashback' ELSE 'present' END AS context FROM documents")
def cues(s, d):
    hit = F.exists(F.array(*(F.lit(c) for c in ("then", "enfin", "dann"))), lambda c: F.lower("text").contains(c))
    return load(s, d, "documents").select("doc_id", F.when(hit, "flashback").otherwise("present").alias("context"))


@query("D7_min_mentions", f"SELECT name, count(*) AS n FROM (SELECT unnest({_TOK.format('text')}) AS name FROM documents) WHERE length(name) >= 6 GROUP BY name HAVING count(*) >= 3")
def min_mentions(s, d):
    words = _sections(s, d).select(F.explode(T.tokens(F.col("content"))).alias("name")).where("length(name) >= 6")
    return words.groupBy("name").agg(F.count("*").alias("n")).where("n >= 3")


@query("D9_gazetteer", f"WITH {_SENTENCES}, {_ROSTER.format(tok=_TOK.format('text'), floor=MENTIONED)} SELECT DISTINCT section_id, i, w AS name FROM (SELECT section_id, i, unnest({_TOK.format('sentence')}) AS w FROM sent) JOIN roster ON w = name")
def gazetteer(s, d):
    sec = _sections(s, d)
    return G.hits(sec, G.roster(sec, MENTIONED)).select("section_id", F.col("i").cast("long").alias("i"), "name")


@query("D13_carry_forward", "SELECT conv_id, turn, CASE WHEN turn - anchor <= 5 THEN anchor END AS anchor FROM (SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS anchor FROM conversations)")
def carry_forward(s, d):
    return A.carry_forward(load(s, d, "conversations"), 5)


@query("E4_similar_names")
def similar_names(s, d):
    return I.similar_pairs(G.roster(_sections(s, d), NAMED))


@query("E9_clusters")
def name_clusters(s, d):
    return I.clusters(G.roster(_sections(s, d), NAMED))


_CLAIMS = "claims AS (SELECT p_brand AS owner, regexp_extract(p_name, '^\\S+', 0) AS alias, split_part(p_type, ' ', 1) AS kind, count(*) AS n FROM part GROUP BY ALL)"


def _claims(s, d):
    return load(s, d, "part").groupBy(F.col("p_brand").alias("owner"), F.regexp_extract("p_name", r"^\S+", 0).alias("alias"), F.substring_index("p_type", " ", 1).alias("kind")).agg(F.count("*").alias("n"))


@query("E19_ambiguous", f"WITH {_CLAIMS} SELECT alias, count(DISTINCT owner) AS owners FROM claims GROUP BY alias HAVING count(DISTINCT owner) >= 2")
def ambiguous(s, d):
    return I.ambiguous(_claims(s, d))


@query("E32_alias_owner", f"WITH {_CLAIMS} SELECT alias, kind, owner, n FROM claims QUALIFY row_number() OVER (PARTITION BY alias, kind ORDER BY n DESC, owner) = 1")
def alias_owner(s, d):
    return I.alias_owner(_claims(s, d))


@query("E37_decision_id", "SELECT a, b, substr(sha1(concat_ws(chr(31), a, b)), 1, 12) AS decision_id FROM (SELECT n_name AS a, r_name AS b FROM nation JOIN region ON n_regionkey = r_regionkey)")
def decision_id(s, d):
    pair = load(s, d, "nation").join(load(s, d, "region"), F.expr("n_regionkey = r_regionkey")).select(F.col("n_name").alias("a"), F.col("r_name").alias("b"))
    return pair.select("a", "b", I.decision_id("a", "b").alias("decision_id"))


@query("E38_page_titles", "WITH e AS (SELECT DISTINCT p_brand AS name, split_part(p_type, ' ', 1) AS kind FROM part) SELECT name, kind, CASE WHEN count(*) OVER (PARTITION BY name) > 1 THEN name || ' (' || kind || ')' ELSE name END AS title FROM e")
def page_titles(s, d):
    return I.page_titles(load(s, d, "part").select(F.col("p_brand").alias("name"), F.substring_index("p_type", " ", 1).alias("kind")).distinct())


@query("F12_fold", f"WITH {_TRADE} SELECT a, b, count(*) AS n, array_to_string(list_sort(list(DISTINCT volume)), ',') AS volumes, CASE WHEN count(DISTINCT type) = 1 THEN max(type) END AS type, CASE WHEN count(DISTINCT direction) = 1 THEN max(direction) END AS direction FROM edges GROUP BY a, b")
def fold(s, d):
    return G.fold(_edges(s, d)).withColumn("volumes", F.array_join("volumes", ","))


@query(
    "F16_votes",
    f"""WITH {_TRADE}, t AS (SELECT a, b, type, count(*) AS n, min((chunk, seq)) AS f FROM edges GROUP BY a, b, type QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY count(*) DESC, min((chunk, seq)), type) = 1),
    v AS (SELECT a, b, direction, count(*) AS n, min((chunk, seq)) AS f FROM edges GROUP BY a, b, direction QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY count(*) DESC, min((chunk, seq)), direction) = 1)
    SELECT a, b, type AS top_type, t.n AS top_type_votes, direction AS top_direction, v.n AS top_direction_votes FROM t JOIN v USING (a, b)""",
)
def votes(s, d):
    return G.vote(_edges(s, d), ["chunk", "seq"])


@query("F21_merge", f"WITH {_TRADE}, p AS (SELECT a, b, volume, count(*) AS n, arg_min(type, (chunk, seq, type)) AS type FROM edges GROUP BY a, b, volume) SELECT a, b, sum(n)::BIGINT AS n, arg_min(type, volume) AS type, string_agg(volume || ':' || n, ',' ORDER BY volume) AS weights FROM p GROUP BY a, b")
def merge(s, d):
    out = G.merge_volumes(_edges(s, d))
    return out.withColumn("weights", F.array_join(F.transform(F.map_entries("weights"), lambda e: F.concat_ws(":", e["key"], e["value"])), ","))


@query("F22_direct", f"WITH {_GRAPH} SELECT a, b, n, type, CASE WHEN a = 3 THEN b ELSE a END AS other FROM graph WHERE a = 3 OR b = 3")
def direct(s, d):
    return G.direct(_graph(s, d), 3)


@query(
    "F23_indirect",
    f"""WITH {_GRAPH}, g AS (SELECT * FROM graph), two AS (SELECT a, b, n, type FROM g UNION ALL SELECT b, a, n, type FROM g), top AS (SELECT max(n) AS t FROM g)
    SELECT x.a AS x, y.b AS y, x.b AS via, x.type AS t1, y.type AS t2, x.n * y.n / (t::DOUBLE * t) AS strength FROM two x JOIN two y ON x.b = y.a, top
    WHERE x.a < y.b AND NOT EXISTS (SELECT 1 FROM g WHERE g.a = x.a AND g.b = y.b) AND x.n * y.n / (t::DOUBLE * t) >= 0.1
    QUALIFY row_number() OVER (PARTITION BY x.a, y.b ORDER BY x.n * y.n / (t::DOUBLE * t) DESC, x.b) = 1""",
)
def indirect(s, d):
    return G.indirect(_graph(s, d))


@query("F27_weighted_degree", f"WITH {_GRAPH} SELECT node, count(*) AS degree, sum(n)::BIGINT AS weight FROM (SELECT a AS node, n FROM graph UNION ALL SELECT b, n FROM graph) GROUP BY node")
def degree(s, d):
    return G.weighted_degree(_graph(s, d))


_TIERS = """WITH e AS ({e}), r AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n, entity) - 1 AS r, count(*) OVER (PARTITION BY kind) AS size FROM e),
m AS (SELECT kind, max(size) AS size, max(CASE WHEN r = greatest(0, floor(size * 0.9) - 1) THEN n END) AS a, max(CASE WHEN r = greatest(0, floor(size * 0.6) - 1) THEN n END) AS b, max(CASE WHEN r = greatest(0, floor(size * 0.1) - 1) THEN n END) AS c FROM r GROUP BY kind)
SELECT entity, e.kind, n, CASE WHEN n >= CASE WHEN size < 4 THEN 20 ELSE a END THEN 'principal' WHEN n >= CASE WHEN size < 4 THEN 10 ELSE b END THEN 'secondary' WHEN n >= CASE WHEN size < 4 THEN 3 ELSE c END THEN 'figurant' ELSE 'ignored' END AS importance FROM e JOIN m USING (kind)"""


@query("G5_importance", _TIERS.format(e="SELECT user_id AS entity, event_type AS kind, count(*) AS n FROM events GROUP BY ALL"))
def importance(s, d):
    return A.tiers(load(s, d, "events").groupBy(F.col("user_id").alias("entity"), F.col("event_type").alias("kind")).agg(F.count("*").alias("n")))


@query("G11_histogram", "SELECT kind, importance, count(*) AS entities FROM (" + _TIERS.format(e="SELECT user_id AS entity, event_type AS kind, count(*) AS n FROM events GROUP BY ALL") + ") GROUP BY ALL")
def histogram(s, d):
    return importance(s, d).groupBy("kind", "importance").agg(F.count("*").alias("entities"))


@query("H5_summaries")
def summaries(s, d):
    return A.summaries(_sections(s, d)).select("section_id", "bullet", "i", F.md5("sentence").alias("digest"))


@query("I9_top_events", "SELECT event_type, ts::DATE AS day, row_number() OVER (PARTITION BY event_type, ts::DATE ORDER BY value DESC, event_id) AS rank, event_id, value FROM events QUALIFY rank <= 3")
def top_events(s, d):
    return A.top_events(load(s, d, "events"), 3)


@query("I6_neighbours", "SELECT conv_id, turn, (sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))::BIGINT AS before, (sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING))::BIGINT AS after FROM conversations")
def neighbours(s, d):
    return A.neighbours(load(s, d, "conversations"), 3)


@query("J2_snippets", "SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY (event_type = (SELECT max(event_type) FROM events))::INT DESC, ts DESC, event_id) AS r, event_id, event_type FROM events QUALIFY r <= 5")
def snippets(s, d):
    events = load(s, d, "events")
    marker = events.agg(F.max("event_type")).first()[0]
    return A.latest_snippets(events, marker, 5)


@query("K1_capped_context", "SELECT user_id, event_id, used FROM (SELECT user_id, event_id, (sum(length(props)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))::BIGINT AS used FROM events) WHERE used <= 200")
def capped(s, d):
    events = load(s, d, "events").select("user_id", "event_id", "ts", F.length("props").alias("size"))
    return A.capped_prefix(events, "user_id", ["ts", "event_id"], "size", 200).select("user_id", "event_id", "used")


@query(
    "M2_copied_runs",
    f"""WITH dt AS (SELECT doc_id, {_TOK.format("text")} AS t FROM documents), bt AS (SELECT item_id, {_TOK.format("text")} AS t FROM benchmark),
    dg AS (SELECT doc_id, i AS p, array_to_string(t[i + 1:i + 15], ' ') AS gram FROM dt, range(0, len(t) - 14) r(i)),
    bg AS (SELECT gram, min((item_id, p)) AS s FROM (SELECT item_id, i AS p, array_to_string(t[i + 1:i + 15], ' ') AS gram FROM bt, range(0, len(t) - 14) r(i)) GROUP BY gram),
    h AS (SELECT doc_id, p, s[1] AS source, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS g FROM dg JOIN bg USING (gram))
    SELECT doc_id, min(p) AS start, count(*) + 14 AS words, arg_min(source, p) AS source FROM h GROUP BY doc_id, g""",
)
def copied(s, d):
    out = A.copied_runs(load(s, d, "documents"), load(s, d, "benchmark"), "doc_id", "item_id", 15)
    return out.withColumn("start", F.col("start").cast("long"))


@query("M12_violations", "SELECT doc_id, CASE WHEN text IS NULL OR text = '' THEN 'empty' WHEN length(text) <> n_chars THEN 'length' ELSE 'short' END AS code FROM documents WHERE text IS NULL OR text = '' OR length(text) <> n_chars OR length(text) < 100")
def violations(s, d):
    code = F.when(F.coalesce(F.col("text"), F.lit("")) == "", "empty").when(F.length("text") != F.col("n_chars"), "length").when(F.length("text") < 100, "short")
    return load(s, d, "documents").select("doc_id", code.alias("code")).where("code is not null")


_GUESS = "SELECT doc_id, quality AS truth, CASE WHEN len(regexp_extract_all(text, '[#*$%&|<>]')) > 20 THEN 0 ELSE 1 END AS guess FROM labels LEFT JOIN documents USING (doc_id)"


def _confusion(s, d):
    guess = F.when(F.regexp_count("text", F.lit(r"[#*$%&|<>]")) > 20, 0).otherwise(1)
    return A.confusion(load(s, d, "labels").select("doc_id", F.col("quality").alias("truth")), load(s, d, "documents").select("doc_id", guess.alias("guess")), "doc_id")


@query("O1_confusion", f"SELECT truth, guess, count(*) AS n FROM ({_GUESS}) GROUP BY ALL")
def confusion(s, d):
    return _confusion(s, d)


@query("O1_class_scores", f"WITH c AS ({_GUESS}), l AS (SELECT DISTINCT truth AS label FROM c UNION SELECT DISTINCT guess FROM c WHERE guess IS NOT NULL), x AS (SELECT label, count(*) FILTER (truth = label AND guess = label) AS tp, count(*) FILTER (guess = label) AS p, count(*) FILTER (truth = label) AS t FROM l, c GROUP BY label) SELECT label, tp, CASE WHEN p = 0 THEN 0 ELSE tp / p END AS precision, CASE WHEN t = 0 THEN 0 ELSE tp / t END AS recall, CASE WHEN p + t = 0 THEN 0 ELSE 2 * tp / (p + t) END AS f1 FROM x")
def class_scores(s, d):
    return A.class_scores(_confusion(s, d))


@query("O6_edge_delta", f"WITH {_TRADE}, o AS (SELECT a, b, count(*) AS was FROM edges WHERE volume = 1996 GROUP BY a, b), n AS (SELECT a, b, count(*) AS now FROM edges WHERE volume = 1997 GROUP BY a, b) SELECT a, b, CASE WHEN was IS NULL THEN 'added' WHEN now IS NULL THEN 'removed' ELSE 'reweighted' END AS change, was, now FROM o FULL JOIN n USING (a, b) WHERE was IS DISTINCT FROM now")
def edge_delta(s, d):
    year = lambda y: _edges(s, d).where(F.col("volume") == y).groupBy("a", "b").agg(F.count("*").alias("n"))
    return G.delta(year(1996), year(1997))


@query("O12_centroid_cosines", "WITH e AS (SELECT label, generate_subscripts(embedding, 1) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings), c AS (SELECT label, dim, avg(x) AS m FROM e GROUP BY ALL), n AS (SELECT label, sqrt(sum(m * m)) AS norm FROM c GROUP BY label), u AS (SELECT label, dim, m / norm AS u FROM c JOIN n USING (label)) SELECT x.label AS a, y.label AS b, round(sum(x.u * y.u), 6) AS cosine FROM u x JOIN u y ON x.dim = y.dim AND x.label < y.label GROUP BY ALL")
def cosines(s, d):
    return A.centroid_cosines(load(s, d, "embeddings")).withColumn("cosine", F.round("cosine", 6))


@query("O18_field_report", "WITH p AS (SELECT unnest(json_keys(props)) AS field, props FROM events), v AS (SELECT field, json_extract_string(props, '$.' || field) AS value FROM p) SELECT field, count(*) AS rows, count(DISTINCT value) AS values, count(*) / (SELECT count(*) FROM events) AS share, count(DISTINCT value) <= 12 AND count(*) >= 5 AS is_enum FROM v GROUP BY field")
def field_report(s, d):
    return A.field_report(load(s, d, "events"), "props")


@query("O21_split", "SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id::VARCHAR), doc_id) <= round((SELECT count(*) FROM documents) * 0.1) AS dev FROM documents")
def split(s, d):
    return A.exact_split(load(s, d, "documents"), "doc_id", 0.1)


@query("P1_accumulate", "SELECT user_id AS entity, count(*) AS mentions, count(DISTINCT event_type) AS volumes, min(ts) AS first_seen FROM events GROUP BY user_id")
def registry_stream(s, d):
    schema = load(s, d, "events").schema
    source = s.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d).selectExpr("user_id as entity", "event_type as volume", "ts")
    return accumulate.totals(accumulate.run(s, source))
