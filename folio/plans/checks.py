"""Further queries over the reference operators: detectors, samples, lookups, shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.functions import text as T
from folio.operators import checks as C
from folio.operators import graph as G
from folio.plans.catalog import _SENTENCES, _sections, query
from folio.sources.tables import load


@query("C9_chapter_marker", "SELECT n_nationkey, n_nationkey::INTEGER AS chapter, n_name AS rest FROM nation")
def chapter_marker(s, d):
    raw = F.concat(F.lit("Ch"), F.col("n_nationkey").cast("string"), F.lit(": "), F.col("n_name"))
    mark = r"^Ch(\d+):\s*"
    return load(s, d, "nation").select("n_nationkey", F.regexp_extract(raw, mark, 1).cast("int").alias("chapter"), F.regexp_replace(raw, mark, "").alias("rest"))


@query("D3_sentence_context", f"WITH {_SENTENCES} SELECT section_id, i, md5(concat_ws(' ', lag(sentence) OVER w, sentence, lead(sentence) OVER w)) AS digest FROM sent WINDOW w AS (PARTITION BY section_id ORDER BY i)")
def sentence_context(s, d):
    return C.with_neighbours(G.sentence_table(_sections(s, d))).select("section_id", F.col("i").cast("long").alias("i"), F.md5("context").alias("digest"))


@query("D16_char_window", "SELECT doc_id, substr(text, greatest(1, p - 40), p + 3 + 40 - greatest(1, p - 40)) AS around FROM (SELECT doc_id, text, instr(text, 'the') AS p FROM documents) WHERE p > 0")
def char_window(s, d):
    return load(s, d, "documents").select("doc_id", C.window_around(F.col("text"), "the", 40).alias("around")).where("around is not null")


@query("E10_cluster_type", "SELECT l_suppkey, l_returnflag, sum(l_linenumber)::BIGINT AS w FROM lineitem GROUP BY l_suppkey, l_returnflag QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY sum(l_linenumber) DESC, l_returnflag) = 1")
def cluster_type(s, d):
    return C.weighted_type(load(s, d, "lineitem"), "l_suppkey", "l_returnflag", "l_linenumber")


@query("F6_even_sample", "SELECT o_custkey, o_orderkey FROM (SELECT *, (r * 5 + n - 1) // n AS i FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS r, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)) WHERE i < 5 AND (i * n) // 5 = r")
def even_sample(s, d):
    return C.even_sample(load(s, d, "orders").select("o_custkey", "o_orderkey"), "o_custkey", ["o_orderkey"], 5).select("o_custkey", "o_orderkey")


_PAIRS = "p AS (SELECT c_nationkey AS a, s_nationkey AS b, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)"


@query("F10_rewrite_pairs", f"WITH {_PAIRS} SELECT least(x.n_regionkey, y.n_regionkey) AS a, greatest(x.n_regionkey, y.n_regionkey) AS b, sum(n)::BIGINT AS n FROM p JOIN nation x ON a = x.n_nationkey JOIN nation y ON b = y.n_nationkey WHERE x.n_regionkey <> y.n_regionkey GROUP BY ALL")
def rewrite_pairs(s, d):
    lines = load(s, d, "lineitem").select("l_orderkey", "l_suppkey")
    pairs = (
        lines.join(load(s, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey")), "l_orderkey")
        .join(load(s, d, "customer").select("c_custkey", F.col("c_nationkey").alias("a")), "c_custkey")
        .join(load(s, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("b")), "l_suppkey")
        .groupBy("a", "b").agg(F.count("*").alias("n"))
    )
    return C.rewrite_pairs(pairs, load(s, d, "nation").select(F.col("n_nationkey").alias("name"), F.col("n_regionkey").alias("owner")))


@query("G3_value_at_share", "SELECT source, n_chars AS value, n FROM (SELECT source, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM documents) WHERE r = greatest(0, floor(n * 0.9::DOUBLE) - 1)")
def value_at_share(s, d):
    return C.value_at_share(load(s, d, "documents").select("source", "n_chars"), "source", "n_chars", 0.9)


@query("G10_corrections", "SELECT c_custkey AS entity, c_nationkey AS alias, CASE WHEN c_custkey % 7 = 0 THEN 'P' ELSE coalesce(a.kind, c_mktsegment) END AS kind FROM customer LEFT JOIN (SELECT n_nationkey, 'N' AS kind FROM nation WHERE n_regionkey = 1) a ON c_nationkey = n_nationkey")
def corrections(s, d):
    # the two name spaces are kept apart by their sign
    people = load(s, d, "customer").select(F.col("c_custkey").alias("entity"), (-1 - F.col("c_nationkey")).alias("alias"), F.col("c_mktsegment").alias("kind"))
    fixes = people.where("entity % 7 = 0").select(F.col("entity").alias("name"), F.lit("P").alias("kind"))
    places = load(s, d, "nation").where("n_regionkey = 1").select((-1 - F.col("n_nationkey")).alias("name"), F.lit("N").alias("kind"))
    return C.corrected(people, fixes.union(places)).withColumn("alias", -1 - F.col("alias"))


@query("G13_length_tier", "SELECT doc_id, CASE WHEN length(text) > 2000 THEN 'principal' WHEN length(text) > 500 THEN 'secondary' ELSE 'figurant' END AS tier FROM documents")
def length_tier(s, d):
    n = F.length("text")
    return load(s, d, "documents").select("doc_id", F.when(n > 2000, "principal").when(n > 500, "secondary").otherwise("figurant").alias("tier"))


@query("J1_latest_first", r"SELECT page_id, row_number() OVER (ORDER BY coalesce(try_cast(regexp_extract(url, '\d+', 0) AS BIGINT), 0) DESC, page_id) AS r FROM pages QUALIFY r <= 50")
def latest_first(s, d):
    pages = load(s, d, "pages").select("page_id", F.coalesce(F.expr(r"try_cast(regexp_extract(url, '\\d+', 0) as bigint)"), F.lit(0)).alias("c"))
    top = pages.orderBy(F.desc("c"), "page_id").limit(50)  # a report of fifty rows, so that one task may number them
    by = C.W.partitionBy(F.lit(0)).orderBy(F.desc("c"), "page_id")
    return top.select("page_id", F.row_number().over(by).cast("long").alias("r"))


@query("L8_item_key", "SELECT conv_id, turn, sha256(role || chr(10) || text) AS key FROM conversations")
def item_key(s, d):
    return load(s, d, "conversations").select("conv_id", "turn", F.sha2(F.concat("role", F.lit("\n"), "text"), 256).alias("key"))


@query("M6_ungrounded", r"WITH k AS (SELECT DISTINCT unnest(regexp_extract_all(text, '\p{Lu}[\p{L}]{3,}')) AS word FROM documents), w AS (SELECT item_id, word, min(pos) AS pos FROM (SELECT item_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM (SELECT item_id, regexp_extract_all(text, '\p{Lu}[\p{L}]{3,}') AS ws FROM benchmark)) GROUP BY ALL) SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY pos) AS r, word FROM w WHERE word NOT IN (SELECT word FROM k) QUALIFY r <= 5")
def ungrounded(s, d):
    return C.ungrounded(load(s, d, "benchmark"), load(s, d, "documents"), "item_id", 5)


@query("M7_page_codes", r"SELECT page_id, concat_ws(',', CASE WHEN length(html) < 500 THEN 'short' END, CASE WHEN contains(lower(html), 'lorem ipsum') THEN 'placeholder' END, CASE WHEN NOT regexp_matches(html, '(?i)<title') THEN 'untitled' END, CASE WHEN contains(url, '?') THEN 'query' END) AS codes FROM pages")
def page_codes(s, d):
    html = F.col("html")
    rules = {"short": F.length(html) < 500, "placeholder": F.lower(html).contains("lorem ipsum"), "untitled": ~html.rlike("(?i)<title"), "query": F.col("url").contains("?")}
    return load(s, d, "pages").select("page_id", C.page_codes(rules).alias("codes"))


@query("M13_same_file", "SELECT translate(p_type, ' /', '__') AS file, count(*) AS n FROM part GROUP BY ALL HAVING count(*) > 1")
def same_file(s, d):
    return C.same_name(load(s, d, "part"), T.page_filename(F.col("p_type")))


@query("O9_support", "SELECT lang, source, count(*) AS n, sum(CASE WHEN toxic = 1 THEN 1 ELSE 0 END)::BIGINT AS toxic FROM documents JOIN labels USING (doc_id) GROUP BY ALL")
def support(s, d):
    both = load(s, d, "documents").select("doc_id", "lang", "source").join(load(s, d, "labels").select("doc_id", "toxic"), "doc_id")
    return both.groupBy("lang", "source").agg(F.count("*").alias("n"), F.sum(F.expr("if(toxic = 1, 1, 0)")).alias("toxic"))


@query("O19_maturity", "SELECT source, count(*) AS pages, avg(length(text)) AS chars, count(*) FILTER (WHERE length(text) > 2000) AS long_pages FROM documents GROUP BY source")
def maturity(s, d):
    return load(s, d, "documents").groupBy("source").agg(
        F.count("*").alias("pages"), F.avg(F.length("text")).alias("chars"), F.count_if(F.length("text") > 2000).alias("long_pages")
    )
