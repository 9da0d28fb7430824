"""Queries: texts and licences, catalogue graph, records, spans, reports over documents, pages, orders and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import licensing as L
from ..functions import scan as X
from ..functions import text as T
from ..operators import graph as G
from ..operators import records as R
from ..operators import report as P
from ..operators import scans as C
from ..operators import sketches as Q
from ..operators import select as S
from ..operators import spans as N
from ..operators import votes as V
from ..scratch import materialize, scratch_path
from ..sources.buckets import BucketStore
from ..operators import catalogue as K
from .registry import Tables, query
from .turns import TURNS_SQL, turns
from .turns import quoted as _words

NAMED = [("mit", r"(?i)MIT License"), ("apache-2.0", r"(?i)Apache License"), ("gpl", r"(?i)GNU General Public"), *L.PATTERNS]
NAMED_HINTS = ["mit license", "apache license", "gnu general", *L.HINTS]
DETECT_SQL = "CASE WHEN regexp_matches(text, '(?i)MIT License') THEN 'mit' WHEN regexp_matches(text, '(?i)Apache License') THEN 'apache-2.0' WHEN regexp_matches(text, '(?i)GNU General Public') THEN 'gpl' WHEN regexp_matches(text, '(?i)creativecommons.org/publicdomain/zero|cc0[\\s-]1.0') THEN 'cc0' WHEN regexp_matches(text, '(?i)creativecommons.org/licenses/by-nc-nd|cc[\\s-]by[\\s-]nc[\\s-]nd') THEN 'cc-by-nc-nd' WHEN regexp_matches(text, '(?i)creativecommons.org/licenses/by-nc-sa|cc[\\s-]by[\\s-]nc[\\s-]sa') THEN 'cc-by-nc-sa' WHEN regexp_matches(text, '(?i)creativecommons.org/licenses/by-nc[^-\\w]|cc[\\s-]by[\\s-]nc') THEN 'cc-by-nc' WHEN regexp_matches(text, '(?i)creativecommons.org/licenses/by-nd|cc[\\s-]by[\\s-]nd') THEN 'cc-by-nd' WHEN regexp_matches(text, '(?i)creativecommons.org/licenses/by-sa|cc[\\s-]by[\\s-]sa') THEN 'cc-by-sa' WHEN regexp_matches(text, '(?i)creativecommons.org/licenses/by/|cc[\\s-]by[^\\s-]') THEN 'cc-by' END"
PRIORITY = ["cc-by", "cc-by-nc", "cc0", "http://creativecommons.org/licenses/by-sa/4.0/", "publisher"]
LICENSE_SQL = "CASE left(o_orderpriority, 1) WHEN '1' THEN 'cc-by' WHEN '2' THEN 'cc-by-nc' WHEN '3' THEN 'cc0' WHEN '4' THEN 'http://creativecommons.org/licenses/by-sa/4.0/' ELSE 'publisher' END"
TIER_SQL = "CASE WHEN len({0}) = 0 THEN 'unspecified' WHEN list_has_any({0}, ['cc0', 'cc-by', 'cc-by-sa', 'cc-by-4.0', 'public-domain']) AND len(list_filter({0}, lambda x: contains(x, 'nc') OR contains(x, 'nd'))) = 0 THEN 'permissive_cc' WHEN len(list_filter({0}, lambda x: starts_with(x, 'cc-'))) > 0 THEN 'restricted_cc' ELSE 'custom_or_arxiv' END"



def papers(t: Tables):
    """Orders of a customer as the licences of a paper."""
    name = F.element_at(F.array(*(F.lit(x) for x in PRIORITY)), F.left("o_orderpriority", F.lit(1)).cast("int"))
    return t.orders.groupBy(F.col("o_custkey").alias("paper")).agg(F.array_sort(F.collect_set(F.when(F.col("o_orderkey") % 3 == 0, name))).alias("source"), F.array_sort(F.collect_set(F.when(F.col("o_orderkey") % 3 == 1, name))).alias("catalogue"))


PAPERS_SQL = f"papers AS (SELECT o_custkey AS paper, list_sort(list_distinct(coalesce(list({LICENSE_SQL}) FILTER (o_orderkey % 3 = 0), []))) AS source, list_sort(list_distinct(coalesce(list({LICENSE_SQL}) FILTER (o_orderkey % 3 = 1), []))) AS catalogue FROM orders GROUP BY o_custkey)"


@query(f"SELECT doc_id, {DETECT_SQL} AS license FROM documents")
def p6_detect_license(t):
    return t.documents.select("doc_id", L.detect_in_source(F.col("text"), NAMED, NAMED_HINTS).alias("license"))


@query(f"WITH d AS (SELECT source, {DETECT_SQL} AS x FROM documents) SELECT source, string_agg(DISTINCT x, ',' ORDER BY x) AS licenses FROM d GROUP BY source")
def p7_scan_licenses(t):
    found = t.documents.select("source", L.detect_in_source(F.col("text"), NAMED, NAMED_HINTS).alias("x"))
    lists = found.groupBy("source").agg(F.array_sort(F.collect_set("x")).alias("x"))
    return lists.select("source", F.when(F.size("x") > 0, F.array_join("x", ",")).alias("licenses"))


@query(f"""WITH {PAPERS_SQL}, r AS (SELECT *, CASE WHEN len(source) > 0 THEN source WHEN len(catalogue) > 0 THEN catalogue ELSE [] END AS chosen FROM papers)
SELECT paper, array_to_string(chosen, ',') AS licenses, chosen[1] AS effective, CASE WHEN len(source) > 0 THEN 'tex_source' WHEN len(catalogue) > 0 THEN 'openalex_locations' ELSE 'none' END AS origin, {TIER_SQL.format('chosen')} AS tier, len(source) > 0 AND len(catalogue) > 0 AND source != catalogue AS has_conflict FROM r""")
def p8_resolve_license(t):
    none = F.array().cast("array<string>")
    row = papers(t).select("paper", L.resolve_license(F.col("source"), none, none, F.col("catalogue")).alias("r"))
    return row.select("paper", F.array_join("r.licenses", ",").alias("licenses"), "r.effective", "r.origin", "r.tier", "r.has_conflict")


@query(f"""WITH {PAPERS_SQL}, n AS (SELECT paper, source, list_sort(list_distinct(list_transform(source, lambda x: CASE WHEN contains(x, '/by-sa') THEN 'cc-by-sa' ELSE x END))) AS now FROM papers)
SELECT paper, array_to_string(now, ',') AS licenses, {TIER_SQL.format('now')} AS tier, now != source OR {TIER_SQL.format('now')} != {TIER_SQL.format('source')} AS changed FROM n""")
def p9_reclassify_license(t):
    row = papers(t).select("paper", L.reclassify(F.col("source"), L.license_tier(F.col("source"))).alias("r"))
    return row.select("paper", F.array_join("r.licenses", ",").alias("licenses"), "r.tier", "r.changed")


@query(f"WITH {PAPERS_SQL} SELECT {TIER_SQL.format('source')} AS tier, count(*)::BIGINT AS n_all, count(*) FILTER (len(catalogue) > 0)::BIGINT AS with_catalogue, count(*) FILTER (len(source) > 1)::BIGINT AS several FROM papers GROUP BY 1")
def a3_license_report(t):
    rows = papers(t).withColumn("tier", L.license_tier(F.col("source")))
    return P.conditional_counts(rows, "tier", {"with_catalogue": F.size("catalogue") > 0, "several": F.size("source") > 1})


@query(f"""WITH {PAPERS_SQL}, n AS (SELECT paper, {TIER_SQL.format('source')} AS tier, source[1] AS eff, list_transform(source, lambda x: CASE WHEN contains(x, '/by-sa') THEN 'cc-by-sa' ELSE x END) AS names FROM papers)
SELECT paper, coalesce(list_filter(names, lambda y: CASE WHEN y IN ('cc0', 'cc-by', 'cc-by-sa') THEN 'permissive_cc' WHEN starts_with(y, 'cc-') THEN 'restricted_cc' ELSE 'custom_or_arxiv' END = tier)[1], CASE WHEN contains(eff, '/by-sa') THEN 'cc-by-sa' ELSE eff END) AS license FROM n""")
def p10_p11_license_of(t):
    rows = papers(t).withColumn("tier", L.license_tier(F.col("source")))
    return rows.select("paper", L.license_of(F.col("source"), F.col("tier"), F.get("source", F.lit(0))).alias("license"))


@query(
    "WITH w AS (SELECT doc_id, text, regexp_extract_all(lower(regexp_replace(text, '\\\\[A-Za-z]+|\\$[^$]*\\$', ' ', 'g')), '\\p{L}+') AS words FROM documents), c AS (SELECT doc_id, len(regexp_extract_all(text, '[ğışĞİŞ]')) AS tr, "
    f"len(list_filter(words, lambda x: list_contains({_words(T.ENGLISH)}, x))) AS en, greatest({', '.join(f'len(list_filter(words, lambda x: list_contains({_words(v)}, x)))' for v in T.OTHER_WORDS.values())}) AS other FROM w) "
    "SELECT doc_id, NOT (tr >= 3 OR (other >= 2 AND other > en)) AS english FROM c"
)
def p12_is_english(t):
    return t.documents.select("doc_id", T.is_english(F.col("text")).alias("english"))


@query("""WITH e AS (SELECT *, (props->>'$.k')::INT % 4 AS k FROM events) SELECT event_id, k < 2 OR (k = 2 AND value <= 50) AS fragment, user_id % 5 IN (0, 1) OR (event_id % 3 = 0 AND user_id % 5 != 4) AS cut FROM e""")
def p13_is_fragment(t):
    """Operators alone, with bounds and brackets in several ways or with what they apply to; rows that begin or end with a connective."""
    k, lit = F.get_json_object("props", "$.k").cast("int") % 4, F.lit
    operator = F.when(F.col("user_id") % 3 == 0, r"\square").when(F.col("user_id") % 3 == 1, r"\mathbf{G}").otherwise(r"F")
    bounds = F.concat(F.when(F.col("value") > 70, "_{[").otherwise("^{("), lit("0, "), F.col("event_id").cast("string"), lit("]}"))
    rest = F.when(k == 0, "").when(k == 1, r" \left( \right) .").when(k == 2, F.when(F.col("value") > 50, r" \phi").otherwise(r" $ : $")).otherwise(F.concat(lit(" ("), F.col("event_type"), lit(" > 3)")))
    u = F.col("user_id") % 5
    end = F.when(u == 0, r" \wedge ").when(u == 1, " = ").when(u == 2, r" \wedge q").otherwise("")
    start = F.when((F.col("event_id") % 3 == 0) & (u != 4), r" \lor ").when(F.col("event_id") % 3 == 0, r" \lorem ").otherwise("")
    row = F.concat(start, lit("p_"), F.col("event_type"), end)
    return t.events.select("event_id", T.is_fragment(F.concat(operator, bounds, rest)).alias("fragment"), T.looks_cut(row).alias("cut"))


@query("""SELECT doc_id, CASE WHEN l.doc_id IS NULL THEN 'undecided' WHEN d.n > 1 THEN 'same text' WHEN lang != 'en' THEN 'not English' WHEN contains(text, '%%%') THEN 'not transcribed alike' WHEN quality = 0 THEN 'operator alone' END AS reason
FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM documents) d LEFT JOIN labels l USING (doc_id)""")
def p14_exclusion_reason(t):
    docs = S.mark_duplicates(t.documents.select("doc_id", "lang", "text"), "text", "doc_id", "doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    reason = R.exclusion_reason(
        (F.col("quality").isNull(), "undecided"), (F.col("duplicate_of").isNotNull(), "same text"), (F.col("lang") != "en", "not English"), (F.contains("text", F.lit("%%%")), "not transcribed alike"), (F.col("quality") == 0, "operator alone"),
    )
    return docs.select("doc_id", reason.alias("reason"))


@query("SELECT user_id || ':D' || row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS id, event_type AS label, event_id AS seq FROM events WHERE event_type != 'error'")
def p15_pair_rows(t):
    e = t.events.where("event_type != 'error'").select(F.col("user_id").alias("id"), F.col("event_type").alias("label"), F.col("event_id").alias("seq"))
    return R.numbered_pairs(e, "id", "seq")


@query(f"WITH {PAPERS_SQL}, n AS (SELECT paper, source, catalogue, unnest(range(1, greatest(len(source), len(catalogue)) + 1)) AS i FROM papers) SELECT paper || ':D' || i AS id, source[i] AS source, catalogue[i] AS catalogue FROM n")
def p15_aligned_pairs(t):
    """A row per place of two aligned lists of a record."""
    return R.pair_rows(papers(t).withColumnRenamed("paper", "id"), "id", ["source", "catalogue"])


@query("""WITH c AS (SELECT conv_id, turn, text, first_value(text) OVER w AS original, row_number() OVER w AS n FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
f AS (SELECT *, row_number() OVER (PARTITION BY conv_id, text ORDER BY n) AS again FROM c WHERE n > 1)
SELECT conv_id || ':A' || (n - 1) AS id, conv_id AS augmented_from, text FROM f WHERE again = 1 AND text != original""")
def p16_augmented_pairs(t):
    """Later turns as rewritings of the first one."""
    return R.augmented_rows(t.conversations.select("conv_id", "turn", "text"), "conv_id", "turn", "text")


@query("SELECT doc_id FROM documents d LEFT JOIN labels l USING (doc_id) WHERE (doc_id % 3 = 0 AND quality = 1) OR (doc_id % 3 != 0 AND (quality IS NULL OR quality = 1))")
def p17_dataset_rows(t):
    rows = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return rows.where(F.when(F.col("doc_id") % 3 == 0, F.coalesce(F.col("quality") == 1, F.lit(False))).otherwise(F.col("quality").isNull() | (F.col("quality") == 1))).select("doc_id")


@query("""WITH s AS (SELECT doc_id, ('0x' || substr(md5(md5(text)), 1, 8))::BIGINT % 100 AS place FROM documents) SELECT doc_id, CASE WHEN place < 80 THEN 'train' WHEN place < 90 THEN 'valid' ELSE 'test' END AS split FROM s""")
def p18_leak_safe_split(t):
    return t.documents.select("doc_id", S.split_of(F.md5(F.col("text").cast("binary")), [("train", 80), ("valid", 10), ("test", 10)]).alias("split"))


@query("""WITH p AS (SELECT *, page_id % 5 AS k, lpad((page_id % 10000)::VARCHAR, 4, '0') AS n FROM pages)
SELECT page_id, 'W' || page_id AS paper_id, CASE WHEN k = 0 THEN '2001.' || n WHEN k = 1 THEN 'cs/000' || n WHEN k = 2 THEN '1902.' || n || '1' END AS arxiv_id, CASE WHEN k = 3 THEN '10.1/' || page_id END AS doi, page_id % 90 AS cited_by,
page_id % 2 = 0 AS is_oa, CASE k WHEN 0 THEN url WHEN 1 THEN 'https://arxiv.org/pdf/cs/000' || n || '|' || url WHEN 2 THEN 'http://arxiv.org/pdf/1902.' || n || '1|' || url WHEN 3 THEN url || '|' || url || '?oa' ELSE '' END AS pdf_mirrors, CASE k WHEN 0 THEN '' WHEN 1 THEN 'cc-by' WHEN 2 THEN 'cc-by,cc0' WHEN 3 THEN 'cc-by-nc' ELSE '' END AS licenses,
regexp_extract(html, '<html lang="(\\w+)"', 1) AS lang FROM p""")
def p1_project_work(t):
    """Works of a catalogue, as JSON made of the pages: with an arXiv id of their own, in a location's link, or with none."""
    k, n, url, none = F.col("page_id") % 5, F.lpad((F.col("page_id") % 10000).cast("string"), 4, "0"), F.col("url"), F.lit(None).cast("string")
    place = lambda license, landing, pdf: F.struct(license.alias("license"), landing.alias("landing_page_url"), pdf.alias("pdf_url"))
    cs, new = F.concat(F.lit("https://arxiv.org/pdf/cs/000"), n), F.concat(F.lit("http://arxiv.org/pdf/1902."), n, F.lit("1"))
    places = (
        F.when(k == 0, F.array(place(none, F.lit("https://host/x"), url))).when(k == 1, F.array(place(F.lit("CC-BY"), F.lit("https://arxiv.org/nothing"), cs), place(F.lit("cc-by"), url, url)))
        .when(k == 2, F.array(place(F.lit("CC0"), F.concat(F.lit("https://arxiv.org/abs/1902."), n, F.lit("1")), new), place(F.lit("cc-by"), cs, url))).when(k == 3, F.array(place(F.lit("cc-by-nc"), none, url), place(F.lit(""), none, url)))
    )
    oa = F.struct((F.col("page_id") % 2 == 0).alias("is_oa"), F.when(k == 3, F.concat(url, F.lit("?oa"))).when(k == 1, cs).alias("oa_url"))
    ids = F.when(k == 0, F.struct(F.concat(F.lit("https://arxiv.org/abs/2001."), n).alias("arxiv")))
    work = F.struct(
        F.concat(F.lit("https://openalex.org/W"), F.col("page_id").cast("string")).alias("id"), ids.alias("ids"), F.when(k == 3, F.concat(F.lit("10.1/"), F.col("page_id").cast("string"))).alias("doi"),
        F.regexp_extract("html", '<html lang="(\\w+)"', 1).alias("display_name"), (F.col("page_id") % 90).alias("cited_by_count"), oa.alias("open_access"), places.alias("locations"),
    )
    rows = t.pages.select("page_id", T.project_work(F.to_json(work)).alias("w"))
    return rows.select("page_id", "w.paper_id", "w.arxiv_id", "w.doi", "w.cited_by", "w.is_oa", F.array_join("w.pdf_mirrors", "|").alias("pdf_mirrors"), F.array_join("w.licenses", ",").alias("licenses"), F.col("w.title").alias("lang"))


@query("SELECT doc_id, regexp_matches(lower(text), '" + "|".join(T.RELEVANCE_TERMS) + "') AS relevant FROM documents")
def p2_is_relevant(t):
    return t.documents.select("doc_id", T.is_relevant(F.col("text")).alias("relevant"))


LOOKUPS_SQL = "look AS (SELECT o_custkey AS paper, 's' || (o_orderkey % 3) AS service, max(CASE WHEN o_orderstatus = 'P' THEN 'no_answer' WHEN o_orderstatus = 'F' THEN 'found' ELSE 'not_found' END) AS status FROM orders GROUP BY ALL)"


def lookups(t: Tables):
    status = F.when(F.col("o_orderstatus") == "P", "no_answer").when(F.col("o_orderstatus") == "F", "found").otherwise("not_found")
    return t.orders.groupBy(F.col("o_custkey").alias("paper"), F.concat(F.lit("s"), (F.col("o_orderkey") % 3).cast("string")).alias("service")).agg(F.max(status).alias("status"))


def lookup_maps(t: Tables):
    return lookups(t).groupBy("paper").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("service", "status")))).alias("lookups"))


@query(f"""WITH {LOOKUPS_SQL}, m AS (SELECT paper, max(status) FILTER (service = 's0') AS a, max(status) FILTER (service = 's1') AS b, max(status) FILTER (service = 's2') AS c FROM look GROUP BY paper),
p AS (SELECT c_custkey AS paper, CASE WHEN c_custkey % 3 = 0 THEN '10.1/x' END AS doi, CASE WHEN c_custkey % 5 = 0 THEN '2001.1' END AS arxiv, left(c_name, 8 + c_custkey % 12) AS title, CASE WHEN c_custkey % 7 = 0 THEN 'downloaded_pdf' ELSE 'pending' END AS state FROM customer)
SELECT p.paper, coalesce(a = 'no_answer', true) AND doi IS NOT NULL AS semantic_scholar, coalesce(b = 'no_answer', true) AND arxiv IS NULL AND length(title) >= 15 AS arxiv_title, coalesce(c = 'no_answer', true) AND arxiv IS NULL AND state = 'pending' AS hal FROM p LEFT JOIN m USING (paper)""")
def p3_needs_lookup(t):
    """What each of three services could still tell about the customers, taken as papers."""
    c, names = F.col("c_custkey"), {"s0": "semantic_scholar", "s1": "arxiv_title", "s2": "hal"}
    asked = lookups(t).withColumn("service", F.element_at(F.create_map(*(F.lit(x) for pair in names.items() for x in pair)), F.col("service")))
    maps = asked.groupBy("paper").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("service", "status")))).alias("lookups"))
    p = t.customer.select(c.alias("paper"), F.when(c % 3 == 0, "10.1/x").alias("doi"), F.when(c % 5 == 0, "2001.1").alias("arxiv"), F.left("c_name", (c % 12 + 8).cast("int")).alias("title"), F.when(c % 7 == 0, "downloaded_pdf").otherwise("pending").alias("state"))
    needs = lambda s: G.needs_lookup(F.col("lookups"), s, F.col("doi"), F.col("arxiv"), F.col("title"), F.col("state")).alias(s)
    return p.join(maps, "paper", "left").select("paper", *(needs(s) for s in names.values()))


@query(f"""WITH {LOOKUPS_SQL} SELECT s.service, (SELECT count(DISTINCT paper) FROM look) - count(*) FILTER (status != 'no_answer')::BIGINT AS still_to_ask, count(*) FILTER (status = 'found')::BIGINT AS found, count(*) FILTER (status = 'no_answer')::BIGINT AS no_answer, count(*) FILTER (status = 'not_found')::BIGINT AS not_found FROM look s GROUP BY s.service""")
def a5_lookup_matrix(t):
    return P.lookup_matrix(lookup_maps(t), "lookups", ["s0", "s1", "s2"], ["found", "no_answer", "not_found"])


REASON_SQL = "CASE event_type WHEN 'error' THEN 'HTTP ' || (400 + (props->>'$.k')::INT) WHEN 'view' THEN 'Connection Timeout' WHEN 'click' THEN 'HTTP 503' WHEN 'signup' THEN 'No Link Found' END"


def _reason():
    e = F.col("event_type")
    return F.when(e == "error", F.concat(F.lit("HTTP "), (F.get_json_object("props", "$.k").cast("int") + 400).cast("string"))).when(e == "view", "Connection Timeout").when(e == "click", "HTTP 503").when(e == "signup", "No Link Found")


# Reasons worth another try, and what HTTP answers mean.
TRANSIENT = "Connection Error|Connection Timeout|Network/System Exception|HTTP 429|HTTP 500|HTTP 502|HTTP 503|HTTP 504"
NOTES = {202: "Bot Protection Challenge", 401: "Login Required", 405: "Bot Protection", 406: "Bot Protection", 410: "Removed by Host", 418: "Bot Protection", 429: "Rate Limited"}
# End of fixed values.


@query(f"""WITH r AS (SELECT event_id, {REASON_SQL} AS reason FROM events) SELECT event_id, coalesce(regexp_matches(reason, '{TRANSIENT}'), false) AS transient, CASE reason WHEN 'HTTP 202' THEN 'HTTP 202 (Bot Protection Challenge)' WHEN 'HTTP 401' THEN 'HTTP 401 (Login Required)' WHEN 'HTTP 405' THEN 'HTTP 405 (Bot Protection)' WHEN 'HTTP 406' THEN 'HTTP 406 (Bot Protection)'
WHEN 'HTTP 410' THEN 'HTTP 410 (Removed by Host)' WHEN 'HTTP 418' THEN 'HTTP 418 (Bot Protection)' WHEN 'HTTP 429' THEN 'HTTP 429 (Rate Limited)' ELSE reason END AS reason FROM r""")
def p5_classify_failure(t):
    rows = t.events.select("event_id", _reason().alias("reason"))
    note = F.element_at(F.create_map(*(F.lit(x) for kv in NOTES.items() for x in kv)), F.regexp_extract("reason", r"HTTP (\d{3})$", 1).try_cast("int"))
    return rows.select("event_id", F.coalesce(F.col("reason").rlike(TRANSIENT), F.lit(False)).alias("transient"), F.coalesce(F.concat("reason", F.lit(" ("), note, F.lit(")")), "reason").alias("reason"))


@query(f"""WITH r AS (SELECT event_id, user_id % 4 AS k, value, {REASON_SQL} AS reason FROM events), q AS (SELECT *, CASE k WHEN 0 THEN 'pending' WHEN 1 THEN 'unavailable' WHEN 2 THEN 'downloaded_pdf' ELSE 'downloaded_latex' END AS state FROM r)
SELECT event_id, 'transient' AS queue FROM q WHERE state = 'pending' OR (state = 'unavailable' AND coalesce(regexp_matches(reason, '{TRANSIENT}'), false)) UNION ALL SELECT event_id, 'all' FROM q WHERE state IN ('pending', 'unavailable')
UNION ALL SELECT event_id, 'upgrade' FROM q WHERE state = 'downloaded_pdf' AND event_id % 3 != 0 AND value <= 50""")
def p4_download_queue(t):
    """The queues of both modes, and that of PDFs for which a source may exist: no answer is recorded for values up to 50."""
    k = F.col("user_id") % 4
    state = F.when(k == 0, "pending").when(k == 1, "unavailable").when(k == 2, "downloaded_pdf").otherwise("downloaded_latex")
    rows = t.events.select("event_id", state.alias("state"), _reason().alias("reason"), F.when(F.col("event_id") % 3 != 0, "u").alias("link"), F.when(F.col("value") > 50, "no source").alias("answer"))
    again = F.col("reason").rlike(TRANSIENT)
    queues = [("transient", G.download_queue(rows, "state", again, "transient")), ("all", G.download_queue(rows, "state", again, "all")), ("upgrade", G.upgrade_queue(rows, "state", "link", "answer"))]
    named = [q.select("event_id", F.lit(n).alias("queue")) for n, q in queues]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query(f"""WITH {LOOKUPS_SQL}, r AS (SELECT user_id % 4 AS status, {REASON_SQL} AS reason FROM events), u AS (SELECT paper % 4 AS status, count(DISTINCT paper) AS n FROM look WHERE status = 'no_answer' GROUP BY 1)
SELECT r.status::BIGINT AS status, count(*)::BIGINT AS n_all, count(*) FILTER (reason IS NOT NULL)::BIGINT AS with_reason, count(*) FILTER (regexp_matches(reason, '{TRANSIENT}'))::BIGINT AS transient, coalesce(any_value(u.n), 0)::BIGINT AS unanswered FROM r LEFT JOIN u ON u.status = r.status GROUP BY 1""")
def a38_download_report(t):
    """Downloads by status, how many failures may pass, and how many papers of the status have a lookup without an answer."""
    rows = t.events.select((F.col("user_id") % 4).alias("status"), _reason().alias("reason"))
    counts = P.conditional_counts(rows, "status", {"with_reason": F.col("reason").isNotNull(), "transient": F.col("reason").rlike(TRANSIENT)})
    open_ = P.conditional_counts(lookup_maps(t).withColumn("status", F.col("paper") % 4), "status", {"unanswered": F.exists(F.map_values("lookups"), lambda x: x == "no_answer")}).drop("n_all")
    return counts.join(open_, "status", "left").na.fill(0, ["unanswered"])


@query("""WITH f AS (SELECT o_custkey AS paper, bool_or(o_orderstatus = 'F' AND o_orderkey % 4 = 0) AS l, bool_or(o_orderstatus = 'P' AND o_totalprice / 100 > 1024) AS p FROM orders GROUP BY 1)
SELECT c_custkey AS paper, CASE WHEN l THEN 'downloaded_latex' WHEN p THEN 'downloaded_pdf' WHEN c_acctbal < 0 OR c_custkey % 7 = 0 THEN 'unavailable' ELSE 'pending' END AS state FROM customer LEFT JOIN f ON c_custkey = paper""")
def s5_sync_inventory(t):
    files = t.orders.select(F.col("o_custkey").alias("paper"), F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 4 == 0), "latex").when(F.col("o_orderstatus") == "P", "pdf").alias("kind"), (F.col("o_totalprice") / 100).alias("size"))
    known = t.customer.select(F.col("c_custkey").alias("paper"), F.when((F.col("c_acctbal") < 0) | (F.col("c_custkey") % 7 == 0), "unavailable").otherwise("pending").alias("state"))
    return G.sync_status(known, files, "paper", "state", "kind", "size")


@query(f"""WITH RECURSIVE {LOOKUPS_SQL}, links AS (SELECT o_custkey AS paper, min('u' || (o_orderkey % 400)) FILTER (o_orderstatus = 'F') AS link FROM orders GROUP BY 1),
g AS (SELECT paper, count(*) AS n FROM look GROUP BY paper),
p AS (SELECT c_custkey AS paper, coalesce(n, 0) AS answered, c_custkey % 2 != 0 AND link IS NOT NULL AS gained, CASE WHEN c_custkey % 2 = 0 THEN 'u' || c_custkey ELSE link END AS link,
  CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 != 0 AND link IS NOT NULL THEN 'pending' WHEN c_custkey % 3 = 0 THEN 'unavailable' ELSE 'pending' END AS state FROM customer LEFT JOIN g ON g.paper = c_custkey LEFT JOIN links l ON l.paper = c_custkey),
o AS (SELECT link, arg_min(paper, (gained, paper)) AS owner FROM p WHERE link IS NOT NULL GROUP BY link),
e AS (SELECT paper AS a, owner AS b FROM p JOIN o USING (link) WHERE gained AND paper != owner UNION SELECT c_custkey, c_custkey - c_custkey % 10 FROM customer WHERE c_custkey % 10 IN (1, 2)),
two AS (SELECT a, b FROM e UNION SELECT b, a FROM e), reach(a, b) AS (SELECT a, b FROM two UNION SELECT r.a, t.b FROM reach r JOIN two t ON r.b = t.a), c AS (SELECT a, least(a, min(b)) AS component FROM reach GROUP BY a)
SELECT paper, answered::BIGINT AS answered, link, state, coalesce(component, paper) AS same_work FROM p LEFT JOIN c ON a = paper""")
def j5_apply_lookups(t):
    """Answers of lookups; a paper that gains a link that another one owns becomes one work with it, beside works that are known to be one."""
    c = F.col("c_custkey")
    known = t.customer.select(c.alias("paper"), F.when(c % 2 == 0, F.concat(F.lit("u"), c.cast("string"))).alias("link_known"), F.when(c % 3 == 0, "unavailable").otherwise("pending").alias("state"))
    links = t.orders.where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("paper")).agg(F.min(F.concat(F.lit("u"), (F.col("o_orderkey") % 400).cast("string"))).alias("link"))
    merged = materialize(G.apply_lookups(known, lookups(t).join(links, "paper", "left"), "paper", "service", "status", "link", "state"), "lookups")
    stored = G.connected(t.customer.where("c_custkey % 10 in (1, 2)").select("c_custkey", (F.col("c_custkey") - F.col("c_custkey") % 10).alias("kept")), "c_custkey", "kept")
    changed = materialize(G.duplicates_by_owner(merged, "paper", "link", "gained", stored), "labels")
    labels = stored.join(changed.select("node"), "node", "left_anti").unionByName(changed).withColumnRenamed("node", "paper")
    return merged.join(labels, "paper", "left").select("paper", F.coalesce(F.size(F.map_keys("lookups")), F.lit(0)).cast("long").alias("answered"), "link", "state", F.coalesce("component", "paper").alias("same_work"))


KEYS_SQL = "keys AS (SELECT doc_id, 1 AS p, md5(text) AS key FROM documents UNION ALL SELECT doc_id, 2, split_part(text, chr(10), 1) FROM documents WHERE length(split_part(text, chr(10), 1)) > 15)"


def keys(t: Tables):
    d = t.documents.select("doc_id", "text")
    return d.select("doc_id", F.lit("hash").alias("type"), F.md5(F.col("text").cast("binary")).alias("key")).unionByName(d.where(F.char_length(F.substring_index("text", "\n", 1)) > 15).select("doc_id", F.lit("title").alias("type"), F.substring_index("text", "\n", 1).alias("key")))


#: Documents as papers: even ones are known, odd ones come in. Copies share an arXiv id or a DOI, some ids are aliases.
PAPER_SQL = """SELECT doc_id, split_part(text, chr(10), 1) AS title, md5(text) AS h, n_chars,
CASE WHEN doc_id % 2 = 0 THEN CASE WHEN doc_id % 4 = 0 THEN 'W' ELSE 'V' END || doc_id WHEN doc_id % 16 = 1 THEN 'W' || (doc_id - 1) ELSE 'P' || doc_id END AS paper_id,
CASE WHEN doc_id % 3 = 0 OR doc_id % 7 = 1 THEN left(md5(text), 12) END AS arxiv_id, CASE WHEN doc_id % 5 < 2 THEN CASE WHEN doc_id % 2 = 0 THEN '10.A/' ELSE '10.a/' END || left(md5(text), 10) END AS doi,
CASE WHEN doc_id % 8 = 0 THEN 'P' || (doc_id + 1) END AS alias, CASE doc_id % 3 WHEN 0 THEN 'no_answer' WHEN 1 THEN 'found' ELSE 'not_found' END AS answer, 'W' || (4 * (doc_id % 50)) AS parent FROM documents"""


def paper_rows(t: Tables):
    """Documents as rows of a catalogue, with seq."""
    d, one = F.col("doc_id"), lambda c: F.array_compact(F.array(c))
    name = lambda p, n: F.concat(F.lit(p), n.cast("string"))
    h, none = F.md5(F.col("text").cast("binary")), F.array().cast("array<string>")
    return t.documents.select(
        d.alias("seq"), F.when(d % 4 == 0, name("W", d)).when(d % 2 == 0, name("V", d)).when(d % 16 == 1, name("W", d - 1)).otherwise(name("P", d)).alias("paper_id"), F.when((d % 3 == 0) | (d % 7 == 1), F.left(h, F.lit(12))).alias("arxiv_id"),
        F.when(d % 5 < 2, F.concat(F.when(d % 2 == 0, "10.A/").otherwise("10.a/"), F.left(h, F.lit(10)))).alias("doi"), F.substring_index("text", "\n", 1).alias("title"), one(F.when(d % 8 == 0, name("P", d + 1))).alias("alternate_ids"),
        none.alias("alternate_dois"), F.col("n_chars").cast("long").alias("cited_by"), (d % 2 == 0).alias("is_oa"), F.array("lang").alias("methods"), (d % 4).cast("int").alias("hop"), F.array(name("W", 4 * (d % 50))).alias("parent_ids"),
        F.array("source").alias("pdf_mirrors"), F.create_map(F.lit("s"), F.when(d % 3 == 0, "no_answer").when(d % 3 == 1, "found").otherwise("not_found")).alias("lookups"), F.lit("pending").alias("status"),
    )


@query(f"""WITH RECURSIVE p AS ({PAPER_SQL}), n AS (SELECT *, CASE WHEN doc_id % 2 = 0 THEN '0:' || paper_id ELSE '1:' || lpad(doc_id::VARCHAR, 20, '0') END AS paper, regexp_replace(lower(title), '[^\\p{{L}}\\p{{M}}\\p{{Nd}}_]+', '', 'g') AS nt FROM p),
k AS (SELECT paper, doc_id % 2 = 0 AS known, r, key FROM (SELECT paper, doc_id, unnest([0, 1, 1, 2, 3, 4]) AS r, unnest([paper_id, CASE WHEN doc_id % 2 = 0 THEN alias END, CASE WHEN doc_id % 2 = 1 THEN paper_id END, arxiv_id, lower(doi), CASE WHEN length(nt) >= 16 THEN nt END]) AS key FROM n) WHERE key IS NOT NULL AND key != ''),
owner AS (SELECT r, key, min(paper) AS owner FROM k WHERE known GROUP BY ALL),
m AS (SELECT paper, r, owner FROM k JOIN owner USING (r, key) WHERE NOT known QUALIFY row_number() OVER (PARTITION BY paper ORDER BY r, owner) = 1),
br AS (SELECT m.paper, m.owner, n.arxiv_id AS key FROM m JOIN n USING (paper) JOIN n o ON o.paper = m.owner WHERE m.r != 2 AND o.arxiv_id IS NULL AND n.arxiv_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY m.owner ORDER BY m.paper) = 1),
alone AS (SELECT paper FROM n WHERE doc_id % 2 = 1 AND paper NOT IN (SELECT paper FROM m)),
held AS (SELECT paper, r, key FROM k WHERE paper IN (SELECT paper FROM alone) AND r != 1 UNION ALL SELECT paper, 2, key FROM br), lead AS (SELECT r, key, min(paper) AS leader FROM held GROUP BY ALL),
led AS (SELECT k.paper, leader FROM k JOIN lead USING (r, key) WHERE k.paper IN (SELECT paper FROM alone) AND leader < k.paper QUALIFY row_number() OVER (PARTITION BY k.paper ORDER BY r, leader) = 1),
e AS (SELECT paper AS a, owner AS b FROM m UNION SELECT paper, leader FROM led UNION SELECT br.owner, o.owner FROM br JOIN owner o ON o.r = 2 AND o.key = br.key WHERE br.owner != o.owner),
two AS (SELECT a, b FROM e UNION SELECT b, a FROM e), reach(a, b) AS (SELECT a, b FROM two UNION SELECT x.a, t.b FROM reach x JOIN two t ON x.b = t.a), comp AS (SELECT a AS paper, least(a, min(b)) AS c FROM reach GROUP BY a),
g AS (SELECT n.*, coalesce(c, paper) AS c, doc_id % 2 = 0 AS known FROM n LEFT JOIN comp USING (paper)),
top AS (SELECT c, arg_max(paper, (known, CASE WHEN known THEN starts_with(paper_id, 'W') END, CASE WHEN known THEN doi IS NOT NULL END, CASE WHEN known THEN n_chars END, CASE WHEN known THEN paper_id ELSE lpad((1000000000 - doc_id)::VARCHAR, 12, '0') END)) AS kept FROM g GROUP BY c),
w AS (SELECT g.*, kept, k.paper_id AS kept_id, known OR g.paper = kept AS base FROM g JOIN top USING (c) JOIN n k ON k.paper = kept),
d AS (SELECT paper_id AS old, kept_id FROM w WHERE known AND paper_id != kept_id),
par AS (SELECT c, kept_id, string_agg(DISTINCT coalesce(d.kept_id_d, w.parent), ',' ORDER BY coalesce(d.kept_id_d, w.parent)) FILTER (coalesce(d.kept_id_d, w.parent) != w.kept_id) AS parents FROM w LEFT JOIN (SELECT old, kept_id AS kept_id_d FROM d) d ON d.old = w.parent GROUP BY ALL),
out AS (SELECT c, kept_id AS paper_id, arg_min(arxiv_id, (paper != kept, NOT known, paper)) FILTER (arxiv_id IS NOT NULL) AS arxiv_id, arg_min(doi, (paper != kept, NOT known, paper)) FILTER (doi IS NOT NULL AND base) AS doi, max(n_chars)::BIGINT AS cited_by, min(doc_id % 4)::INT AS hop,
  coalesce(arg_min(answer, (paper != kept, NOT known, paper)) FILTER (answer != 'no_answer'), 'no_answer') AS answer, list_concat(list(alias) FILTER (base AND alias IS NOT NULL), list(paper_id) FILTER (paper_id != kept_id)) AS aliases, count(*)::BIGINT AS n FROM w GROUP BY ALL)
SELECT paper_id, arxiv_id, doi, cited_by, hop, answer, coalesce(array_to_string(list_sort(list_distinct(aliases)), ','), '') AS aliases, coalesce(parents, '') AS parents FROM out JOIN par USING (c)""")
def j1_upsert_papers(t):
    """Papers that come in, merged into a stored catalogue or added to it; the catalogue afterwards."""
    store = BucketStore(t.spark, scratch_path(t.spark, "catalogue"), K.SCHEMA, ["paper_id"])
    rows = paper_rows(t)
    store.change(materialize(rows.where("seq % 2 = 0"), "known"))
    K.upsert(store, rows.where("seq % 2 = 1"))
    joined = lambda c: F.array_join(c, ",").alias(c.replace("alternate_ids", "aliases").replace("parent_ids", "parents"))
    return store.read().select("paper_id", "arxiv_id", "doi", "cited_by", "hop", F.element_at("lookups", F.lit("s")).alias("answer"), joined("alternate_ids"), joined("parent_ids"))


MERGE_SQL = f"""{KEYS_SQL}, g AS (SELECT p, key, min(doc_id) AS x FROM keys GROUP BY ALL), e AS (SELECT DISTINCT doc_id AS a, x AS b FROM keys JOIN g USING (p, key)), two AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach(a, b) AS (SELECT a, b FROM two UNION SELECT r.a, e.b FROM reach r JOIN two e ON r.b = e.a), comp AS (SELECT a AS doc_id, min(b) AS component FROM reach GROUP BY a)"""


def merged(t: Tables):
    return G.merge_groups(keys(t).select("doc_id", F.concat_ws(":", "type", "key").alias("key")), "doc_id", "key")


@query(f"WITH RECURSIVE {MERGE_SQL} SELECT doc_id, component FROM comp")
def j2_merge_duplicates(t):
    return merged(t)


@query(f"""WITH RECURSIVE {MERGE_SQL}, r AS (SELECT component, d.*, 's' || (doc_id % 3) AS service, CASE doc_id % 5 WHEN 0 THEN 'found' WHEN 1 THEN 'not_found' ELSE 'no_answer' END AS status FROM comp JOIN documents d USING (doc_id)),
pick AS (SELECT component, arg_max(doc_id, (n_chars, -doc_id)) AS kept, max(n_chars) AS n_chars, list_sort(list_distinct(list(source))) AS sources, bool_or(lang = 'en') AS any_en FROM r GROUP BY component),
look AS (SELECT component, string_agg(service || '=' || status, ',' ORDER BY service) AS lookups FROM (SELECT component, service, arg_min(status, (status = 'no_answer', -n_chars, doc_id)) AS status FROM r GROUP BY ALL) GROUP BY component),
meth AS (SELECT component, string_agg(lang, ',' ORDER BY o) AS methods FROM (SELECT component, lang, min(row(-n_chars, doc_id)) AS o FROM r GROUP BY ALL) GROUP BY component)
SELECT component, kept, n_chars, array_to_string(sources, ',') AS sources, any_en, lookups, methods FROM pick JOIN look USING (component) JOIN meth USING (component)""")
def a1_merge_fields(t):
    """Copies as one record: an answered lookup beats one without an answer, methods stay in the order of the copies."""
    d = F.col("doc_id")
    status = F.when(d % 5 == 0, "found").when(d % 5 == 1, "not_found").otherwise("no_answer")
    docs = t.documents.select("doc_id", "n_chars", "lang", F.array("source").alias("sources"), (F.col("lang") == "en").alias("any_en"), F.array("lang").alias("methods"), F.create_map(F.concat(F.lit("s"), (d % 3).cast("string")), status).alias("lookups"), F.struct(-F.col("n_chars"), d).alias("place"))
    docs = materialize(docs.join(merged(t), "doc_id"), "copies")
    out = G.merge_fields(docs.withColumn("kept", F.col("doc_id")), "component", ["sources"], ["n_chars"], ["lang"], ["any_en"], ["kept"], F.struct("n_chars", -F.col("doc_id")))
    out = out.join(R.merged_lookups(docs, "component", "lookups", "place"), "component").join(R.ordered_union(docs, "component", "methods", "place"), "component")
    found = F.array_join(F.transform(F.array_sort(F.map_entries("lookups")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return out.select("component", "kept", "n_chars", F.array_join("sources", ",").alias("sources"), "any_en", found.alias("lookups"), F.array_join("methods", ",").alias("methods"))


@query("""WITH e AS (SELECT o_custkey AS paper, o_orderkey % 1500 AS parent FROM orders), m AS (SELECT c_custkey AS old, c_custkey - c_custkey % 10 AS kept FROM customer WHERE c_custkey % 10 IN (1, 2)),
r AS (SELECT DISTINCT paper, coalesce(kept, parent) AS p FROM e LEFT JOIN m ON parent = old) SELECT paper, coalesce(string_agg(p::VARCHAR, ',' ORDER BY p) FILTER (p != paper), '') AS parents FROM r GROUP BY paper""")
def j3_remap_ids(t):
    df = t.orders.groupBy(F.col("o_custkey").alias("paper")).agg(F.collect_set(F.col("o_orderkey") % 1500).alias("parents"))
    mapping = t.customer.where("c_custkey % 10 in (1, 2)").select(F.col("c_custkey").cast("long").alias("old"), (F.col("c_custkey") - F.col("c_custkey") % 10).cast("long").alias("kept"))
    return G.remap_ids(df, "paper", "parents", mapping, "old", "kept").select("paper", F.array_join("parents", ",").alias("parents"))


@query("""WITH e AS (SELECT DISTINCT o_custkey AS src, o_orderkey % 1500 AS dst FROM orders), h1 AS (SELECT src AS node, 1 AS hop, string_agg(dst::VARCHAR, ',' ORDER BY dst) AS parents FROM e WHERE dst < 20 GROUP BY src),
f AS (SELECT node FROM h1 JOIN customer ON c_custkey = node WHERE c_acctbal >= 5000), h2 AS (SELECT src AS node, 2 AS hop, string_agg(dst::VARCHAR, ',' ORDER BY dst) AS parents FROM e WHERE dst IN (SELECT node FROM f) AND src NOT IN (SELECT node FROM h1) GROUP BY src)
SELECT * FROM h1 UNION ALL SELECT * FROM h2""")
def j4_expand_hops(t):
    edges = t.orders.select(F.col("o_custkey").alias("src"), (F.col("o_orderkey") % 1500).alias("dst")).distinct()
    seeds = t.customer.where("c_custkey < 20").select(F.col("c_custkey").alias("paper"))
    cited = t.customer.select(F.col("c_custkey").alias("paper"), "c_acctbal")
    found = G.expand_hops(edges, seeds, "src", "dst", cited, "paper", "c_acctbal", 5000)
    return found.select("node", "hop", F.array_join("parents", ",").alias("parents"))


@query("SELECT event_type AS method, count(DISTINCT user_id)::BIGINT AS n FROM events GROUP BY 1")
def a4_discovery_report(t):
    return P.counts_of_each(t.events, "user_id", "event_type", "method")


@query("SELECT source, count(*)::BIGINT AS records, count(DISTINCT lang)::BIGINT AS papers FROM documents GROUP BY source")
def a8_distinct_papers(t):
    return t.documents.groupBy("source").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("lang").alias("papers"))


@query("SELECT 'same as another record' AS masked, count(*)::BIGINT AS n FROM (SELECT row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r > 1 HAVING count(*) > 0")
def a9_reason_counts(t):
    marked = S.mark_duplicates(t.documents.select("doc_id", "text"), "text", "doc_id", "doc_id")
    rows = marked.select(F.concat(F.lit("same as D"), F.col("duplicate_of").cast("string")).alias("reason"))
    return P.reason_counts(rows, "reason", r"D\d+")


@query("SELECT CASE WHEN grouping(source) = 1 THEN 'all' ELSE source END AS source, CASE WHEN grouping(lang) = 1 THEN 'all' ELSE lang END AS lang, count(*)::BIGINT AS n, count(DISTINCT text)::BIGINT AS n_distinct FROM documents GROUP BY GROUPING SETS ((source, lang), ())")
def a39_outcome_summary(t):
    return P.totals(t.documents.select("source", "lang", F.md5(F.col("text").cast("binary")).alias("text")), ["source", "lang"], "text")


FORMULA = "concat('G[0,', get_json_object(props, '$.k'), '] (', event_type, ' > ', cast(cast(value as int) as string), ' -> F[1,', if(event_id % 2 = 0, 'inf', 'T'), '] (x', cast(user_id % 3 as string), ' < ', event_type, '))')"
FORMULA_SQL = "'G[0,' || (props->>'$.k') || '] (' || event_type || ' > ' || trunc(value)::INT || ' -> F[1,' || CASE WHEN event_id % 2 = 0 THEN 'inf' ELSE 'T' END || '] (x' || (user_id % 3) || ' < ' || event_type || '))'"
#: Formulas with operators that depend on three columns.
PATTERN = "concat(if(value > 50, '!', ''), 'G[0,', get_json_object(props, '$.k'), '] ', event_type, if(user_id % 2 = 0, ' <-> ', ' -> '), if(event_type < 'f', 'F[1,2] p && q', 'p || q'))"
PATTERN_SQL = "CASE WHEN value > 50 THEN '!' ELSE '' END || 'G[0,' || (props->>'$.k') || '] ' || event_type || CASE WHEN user_id % 2 = 0 THEN ' <-> ' ELSE ' -> ' END || CASE WHEN event_type < 'f' THEN 'F[1,2] p && q' ELSE 'p || q' END"
TOKENS_SQL = f"tokens AS (SELECT event_id, regexp_extract_all({PATTERN_SQL}, '<->|->|&&|\\|\\||!|[GFUR]') AS x FROM events)"


@query(f"""WITH f AS (SELECT event_id, {FORMULA_SQL} AS f, event_type, 'x' || (user_id % 3) AS x FROM events)
SELECT event_id, replace(replace(regexp_replace(regexp_replace(regexp_replace(f, '\\[[^,]*,(inf)\\]', '[#,\\1]', 'g'), '\\[[^,]*,(\\d+|T)\\]', '[#,#]', 'g'), ' [0-9]+', ' #', 'g'), event_type, 'a'), x, 'b') AS template FROM f""")
def f6_template(t):
    return t.events.select("event_id", F.expr(FORMULA).alias("f")).select("event_id", T.template_of(F.col("f")).alias("template"))


@query(f"WITH {TOKENS_SQL} SELECT event_id, array_to_string(x, ',') AS operators FROM tokens")
def f7_pattern_tokens(t):
    return t.events.select("event_id", F.array_join(T.pattern_tokens(F.expr(PATTERN)), ",").alias("operators"))


@query(f"WITH {TOKENS_SQL}, o(operator, op) AS (VALUES ('G', 'G'), ('F', 'F'), ('implies', '->'), ('iff', '<->'), ('and', '&&'), ('or', '||'), ('not', '!')) SELECT operator, round(avg(list_contains(x, op)::INT), 9) AS share FROM tokens, o GROUP BY operator")
def a12_operator_share(t):
    rows = t.events.select(F.expr(PATTERN).alias("pattern"))
    shares = P.operator_share(rows, T.pattern_tokens(F.col("pattern")), {"G": "G", "F": "F", "implies": "->", "iff": "<->", "and": "&&", "or": "||", "not": "!"})
    return shares.select("operator", F.round("share", 9).alias("share"))


@query("SELECT doc_id, regexp_replace(lower(split_part(text, chr(10), 1)), '[^\\p{L}\\p{M}\\p{Nd}_]+', '', 'g') AS title FROM documents")
def f1_normalize_title(t):
    return t.documents.select("doc_id", T.normalize_title(F.substring_index("text", "\n", 1)).alias("title"))


@query(r"""WITH e AS (SELECT *, (props->>'$.k')::INT % 4 AS k FROM events)
SELECT event_id, CASE user_id % 3 WHEN 2 THEN '\Diamond' ELSE '\Box' END || '_[0,' || k || ']' || CASE WHEN k = 3 THEN 'x_' || k || '=' ELSE '' END || event_type || CASE event_id % 4 WHEN 3 THEN '\ge' ELSE '\le' END || trunc(value)::INT || CASE k WHEN 0 THEN '\rightarrow' WHEN 1 THEN '\Leftrightarrow' WHEN 2 THEN '\wedge' ELSE '\neg' END || 'U\phi' AS key FROM e""")
def f2_formula_key(t):
    """Formulas whose operators, relations, connectives, fonts and layout are written in different ways, by five columns."""
    k, lit = F.get_json_object("props", "$.k").cast("int") % 4, F.lit
    box = F.when(F.col("user_id") % 3 == 0, r"\square").when(F.col("user_id") % 3 == 1, r"\Box").otherwise(r"\lozenge")
    relation = F.when(F.col("event_id") % 4 == 0, r" \le ").when(F.col("event_id") % 4 == 1, r"\leq ").when(F.col("event_id") % 4 == 2, r"\,\leqslant ").otherwise(r" \geqslant ")
    arrow = F.when(k == 0, F.when(F.col("value") > 50, r" \implies ").otherwise(r" \to ")).when(k == 1, r"\iff ").when(k == 2, r" \land ").otherwise(r" \lnot ")
    name = F.when(F.col("value") > 30, F.concat(lit(r"\mathrm{"), F.col("event_type"), lit("}"))).otherwise(F.col("event_type"))
    until = F.when(F.col("value") > 60, r"\mathcal{U}").when(F.col("value") > 40, r"\until ").otherwise("U")
    phi = F.when(F.col("user_id") % 2 == 0, r"\varphi").otherwise(r"\phi ")
    end = F.when(F.col("event_id") % 3 == 0, r" \quad .$").when(F.col("event_id") % 3 == 1, r" \\ & ,").otherwise(r"\label{eq} \nonumber")
    written = F.concat(F.when(F.col("event_id") % 3 == 0, "$ ").otherwise(r"\begin{align} "), box, lit("_{[0, "), k.cast("string"), lit(r"]}\left "), F.when(k == 3, F.concat(lit("x_{"), k.cast("string"), lit(r"} \coloneqq "))).otherwise(""), name, relation, F.col("value").cast("int").cast("string"), arrow, until, phi, end)
    return t.events.select("event_id", T.formula_key(written).alias("key"))


@query("SELECT doc_id, length(regexp_replace(text, '%[^\\n]*', '', 'g'))::BIGINT + 1 + (doc_id % 2 = 0)::INT AS n_kept FROM documents")
def f4_strip_comments(t):
    """Texts between a comment environment (with a commented-out end in it) and, for even ones, a disabled block."""
    off = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("\\iffalse "), F.col("source"), F.lit(" % \\fi x\n\\fi "))).otherwise("")
    text = F.concat(F.lit("\\begin{comment}a % \\end{comment}\n"), F.col("source"), F.lit("\\end{comment}"), F.col("text"), F.lit("\n"), off)
    return t.documents.select("doc_id", F.char_length(T.strip_disabled(text)).cast("long").alias("n_kept"))


@query("""WITH j AS (SELECT event_id, (props->>'$.k')::INT % 2 AS k, value, CASE WHEN value > 30 THEN 'yes' WHEN value > 5 THEN 'no' ELSE event_type END AS describes, CASE event_type WHEN 'click' THEN 'correct' WHEN 'view' THEN 'ambiguous' WHEN 'signup' THEN 'wrong' WHEN 'error' THEN event_type END AS faithful FROM events),
p AS (SELECT *, CASE WHEN value > 90 THEN 'not the expected JSON' WHEN k = 1 THEN 'ids differ' WHEN describes NOT IN ('yes', 'no') THEN 'unknown answer' WHEN describes = 'no' AND faithful IS NOT NULL THEN 'no with a label' WHEN describes = 'yes' AND coalesce(faithful, 'error') = 'error' THEN 'yes without a label' END AS problem FROM j)
SELECT event_id, problem, CASE WHEN problem IS NULL THEN CASE WHEN describes = 'no' THEN 'no' ELSE faithful END END AS label FROM p""")
def f12_validate_judgment(t):
    """Answers written from the log's columns, some in a fence, some cut short."""
    e, v = F.col("event_type"), F.col("value")
    describes = F.when(v > 30, "yes").when(v > 5, "no").otherwise(e)
    faithful = F.when(e == "click", "correct").when(e == "view", "ambiguous").when(e == "signup", "wrong").when(e == "error", e)
    one = F.struct(F.concat(F.lit("D"), (F.get_json_object("props", "$.k").cast("int") % 2 + 1).cast("string")).alias("id"), describes.alias("describes"), faithful.alias("faithful"))
    answer = F.to_json(F.struct(F.array(one).alias("judgments")))
    answer = F.when(v > 90, F.substring(answer, 1, 20)).when(F.col("user_id") % 2 == 0, F.concat(F.lit("```json\n"), answer, F.lit("\n```"))).otherwise(answer)
    rows = t.events.select("event_id", T.validate_judgment(answer, F.lit(1)).alias("problem"), T.judged_label(describes, faithful).alias("label"))
    return rows.withColumn("label", F.when(F.col("problem").isNull(), F.col("label")))


@query(f"WITH {TURNS_SQL}, n AS (SELECT conv_id, turn, trim(regexp_replace(a, '\\s+', ' ', 'g')) AS x, trim(regexp_replace(b, '\\s+', ' ', 'g')) AS y, length(a) % 3 AS k FROM turns) SELECT conv_id, turn, CASE WHEN k = 0 AND x != '' AND y != '' THEN x || '|' || y END AS texts FROM n")
def f13_validate_paraphrases(t):
    """Two turns as an answer with two texts; others with one text, or with an empty third one."""
    k = F.char_length("a") % 3
    texts = F.when(k == 0, F.array("a", "b")).when(k == 1, F.array("a")).otherwise(F.array("a", F.lit(" ")))
    return turns(t).select("conv_id", "turn", F.array_join(T.validate_paraphrases(F.to_json(F.struct(texts.alias("paraphrases"))), 2), "|").alias("texts"))


@query(f"WITH {TURNS_SQL}, w AS (SELECT conv_id, turn, list_transform(regexp_extract_all(a, '[A-Za-z0-9_''\\-*@]+'), lambda x: lower(x)) AS words, list_transform(regexp_extract_all(b, '[A-Za-z0-9_''\\-*@]+'), lambda x: lower(x)) AS other FROM turns), f AS (SELECT *, coalesce(list_sort(list_distinct(list_filter(words, lambda w: list_contains({_words(T.KEYWORDS)}, w) OR w = 'the' OR length(w) = 1 OR regexp_matches(w, '[_0-9]')))), []) AS frozen FROM w) SELECT conv_id, turn, array_to_string(frozen, ' ') AS frozen, coalesce(array_to_string(list_filter(frozen, lambda w: len(list_filter(other, lambda x: x = w)) < len(list_filter(words, lambda x: x = w))), ' '), '') AS lost FROM f")
def f15_frozen_words(t):
    frozen = T.frozen_words(F.col("a"), F.lit("G[0,1] the > 3"))
    rows = turns(t).withColumn("f", frozen)
    return rows.select("conv_id", "turn", F.array_join("f", " ").alias("frozen"), F.array_join(T.lost_words(F.col("a"), F.col("b"), F.col("f")), " ").alias("lost"))


@query(f"WITH {TURNS_SQL}, w AS (SELECT conv_id, turn, list_transform(regexp_extract_all(a, '\\d+(?:\\.\\d+)?|[A-Za-z_][A-Za-z0-9_'']*'), lambda x: lower(x)) AS x, list_transform(regexp_extract_all(b, '\\d+(?:\\.\\d+)?|[A-Za-z_][A-Za-z0-9_'']*'), lambda x: lower(x)) AS y FROM turns) SELECT conv_id, turn, len(list_distinct(list_filter(x, lambda w: (regexp_matches(w, '[_0-9]') OR w IN ('the', 'de', 'of')) AND NOT list_contains(y, w))))::BIGINT AS missing FROM w")
def f16_missing_symbols(t):
    return turns(t).select("conv_id", "turn", F.size(T.missing_symbols(F.col("a"), F.col("b"), F.lit("G[0,1] (the > de) U of"))).cast("long").alias("missing"))


@query("""WITH m AS (SELECT doc_id, text, length(text)::BIGINT AS n, regexp_extract(text, 'o\\s*f\\s*t\\s*h\\s*e') AS hit FROM documents)
SELECT doc_id, n, hit != '' AS has, CASE WHEN hit != '' THEN strpos(text, hit) - 1 END AS start, CASE WHEN hit != '' THEN strpos(text, hit) - 1 + length(hit) END AS stop FROM m""")
def f19_f23_clean_and_contains(t):
    """Texts without control characters, and where they first hold two words, however spaced."""
    noisy = F.concat(F.char(F.lit(7)), F.col("text"))
    rows = t.documents.select("doc_id", F.char_length(T.clean_text(noisy)).cast("long").alias("n"), T.contains_ignoring_spaces(F.col("text"), F.lit("of the")).alias("has"), T.find_ignoring_spaces(F.col("text"), F.lit("of\nthe ")).alias("s"))
    return rows.select("doc_id", "n", "has", "s.start", "s.stop")


@query("""WITH b AS (SELECT event_id, props->>'$.k' AS lo, CASE WHEN event_type < 'f' THEN value::VARCHAR ELSE event_type END AS hi, CASE WHEN value > 50 THEN ')' ELSE ']' END AS closing, user_id % 2 = 0 AS named FROM events),
n AS (SELECT event_id, regexp_full_match(CASE WHEN named THEN 't' || lo ELSE lo END, '\\d+(\\.\\d+)?') AS l, regexp_full_match(hi, '\\d+(\\.\\d+)?') AS h, closing FROM b)
SELECT event_id, CASE WHEN l AND h THEN 'concrete' WHEN l OR h OR closing = ']' THEN 'symbolic' END AS kind FROM n""")
def f20_classify_bounds(t):
    k = F.get_json_object("props", "$.k")
    low = F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("t"), k)).otherwise(k)
    high = F.when(F.col("event_type") < "f", F.col("value").cast("string")).otherwise(F.col("event_type"))
    return t.events.select("event_id", T.classify_bounds(low, high, F.when(F.col("value") > 50, ")").otherwise("]")).alias("kind"))


@query("""WITH n AS (SELECT event_id, (props->>'$.k') AS k, user_id::VARCHAR AS u, (event_id % 7)::VARCHAR AS m, trunc(value)::INT::VARCHAR AS v FROM events), g AS (SELECT *, [k, u] AS x, [m, v] AS y, [u, m] AS z FROM n)
SELECT event_id, CASE WHEN list_has_all(z, x) OR list_has_all(z, y) THEN '' ELSE coalesce(array_to_string([p FOR p, i IN list_concat(x, y) IF NOT list_contains(z, p) AND NOT list_contains(list_concat(x, y)[1:i - 1], p)], ','), '') END AS missing FROM g""")
def f11_missing_bounds(t):
    """Two operators with bounds from four columns, against a transcription that holds two of them."""
    k, u, m, v = F.get_json_object("props", "$.k"), F.col("user_id").cast("string"), (F.col("event_id") % 7).cast("string"), F.col("value").cast("int").cast("string")
    text = F.concat(F.lit("G_{["), u, F.lit(","), m, F.lit("]} p"))
    return t.events.select("event_id", F.array_join(T.missing_bounds(text, F.array(F.array(k, u), F.array(m, v))), ",").alias("missing"))


@query("WITH a AS (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS x FROM documents) SELECT doc_id, CASE WHEN length(x) > 300 THEN regexp_replace(left(x, 300), '\\s+\\S*$', '') ELSE x END AS abstract FROM a")
def f21_find_abstract(t):
    paper = F.concat(F.lit("\\begin{abstract}\n"), F.col("text"), F.lit("\\end{abstract} rest"))
    return t.documents.select("doc_id", T.first_abstract(paper, 300).alias("abstract"))


@query("WITH w AS (SELECT conv_id, turn, lag(text) OVER o AS p, text, lead(text) OVER o AS n FROM conversations WINDOW o AS (PARTITION BY conv_id ORDER BY turn)) SELECT conv_id, turn, coalesce(right(p, 100), '') || text || coalesce(left(n, 100), '') AS context, length(coalesce(right(p, 100), ''))::BIGINT AS offset FROM w")
def w9_page_context(t):
    return N.page_context(t.conversations, "conv_id", "turn", "text", 100).select("conv_id", "turn", "context", "offset")


@query("""WITH s AS (SELECT user_id, event_id * 10 AS a, event_id * 10 + value::INT * 10 AS b FROM events), r AS (SELECT *, max(b) OVER (PARTITION BY user_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s),
n AS (SELECT *, sum((reach IS NULL OR a > reach + 200)::INT) OVER (PARTITION BY user_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS run FROM r),
c AS (SELECT *, row_number() OVER (PARTITION BY user_id, run ORDER BY a, b) - 1 AS rk, count(*) OVER (PARTITION BY user_id, run) AS size FROM n)
SELECT user_id, run::BIGINT AS run, (rk * ceil(size / 3)::BIGINT // size)::BIGINT AS chunk, min(a)::BIGINT AS a, max(b)::BIGINT AS b, count(*)::BIGINT AS n FROM c GROUP BY 1, 2, 3""")
def w10_merge_windows(t):
    spans = t.events.select("user_id", (F.col("event_id") * 10).alias("a"), (F.col("event_id") * 10 + F.rint("value").cast("long") * 10).alias("b"))
    return N.merge_windows(spans, ["user_id"], "a", "b", 200, 3)


@query("SELECT doc_id, row_number() OVER (PARTITION BY source, lang ORDER BY n_chars, doc_id)::BIGINT AS number FROM documents")
def w12_number_formulas(t):
    return S.number_rows(t.documents.select("doc_id", "source", "lang", "n_chars"), ["source", "lang"], ["n_chars", "doc_id"]).select("doc_id", "number")


@query("WITH f AS (SELECT source, split_part(text, chr(10), 1) AS k, min(doc_id) AS first FROM documents GROUP BY ALL) SELECT doc_id, CASE WHEN first != doc_id THEN first END AS same_as FROM documents d JOIN f ON f.source = d.source AND f.k = split_part(d.text, chr(10), 1)")
def w5_dedupe_records(t):
    docs = t.documents.select("doc_id", "source", F.substring_index("text", "\n", 1).alias("k"))
    return R.dedupe_records(docs, ["source", "k"], "doc_id", ["doc_id"]).select("doc_id", "same_as")


@query("WITH f AS (SELECT *, min(event_id) OVER (PARTITION BY user_id, props, event_type) AS first FROM events) SELECT event_id, CASE WHEN first != event_id THEN first END AS same_as FROM f")
def w6_same_formula_in_region(t):
    return R.dedupe_records(t.events.select("event_id", "user_id", "props", "event_type"), ["user_id", "props", "event_type"], "event_id", ["event_id"]).select("event_id", "same_as")


@query("SELECT user_id, props, min(event_id) AS event_id, coalesce(string_agg(event_id::VARCHAR, ',' ORDER BY event_id) FILTER (event_id != first), '') AS also_at FROM (SELECT *, min(event_id) OVER (PARTITION BY user_id, props) AS first FROM events) GROUP BY user_id, props")
def a28_collect_locations(t):
    rows = t.events.select("user_id", "props", "event_id")
    return R.collect_locations(rows, ["user_id", "props"], ["event_id"], F.col("event_id")).select("user_id", "props", "event_id", F.array_join("also_at", ",").alias("also_at"))


@query("""WITH p AS (SELECT user_id, props, max(event_id) AS m FROM events WHERE event_type = 'view' GROUP BY ALL) SELECT e.event_id, 'paired as ' || m AS reason FROM events e LEFT JOIN p USING (user_id, props) WHERE event_type = 'click'""")
def j9_drop_if_paired(t):
    rows = t.events.select("user_id", "props", "event_id", "event_type")
    return R.drop_if_paired(rows.where("event_type = 'click'"), rows.where("event_type = 'view'"), ["user_id", "props"], "event_id", "event_id").select("event_id", "reason")


DESCRIBED_SQL = """m AS (SELECT doc_id % 50 AS file, arg_min(text, doc_id) AS text, min(doc_id) AS record FROM documents WHERE text IS NOT NULL GROUP BY 1),
f AS (SELECT d.doc_id, m.record FROM documents d LEFT JOIN m ON m.file = d.doc_id % 50 AND regexp_replace(m.text, '^\\s+|\\s+$', '', 'g') = regexp_replace(coalesce(d.text, ''), '^\\s+|\\s+$', '', 'g') AND d.doc_id % 7 != 6),
r AS (SELECT f.doc_id AS formula, f.record, c.turn, c.text AS nl FROM f LEFT JOIN conversations c ON c.conv_id = f.doc_id)"""


def described(t: Tables):
    """Documents as formulas read from numbered files, turns as their descriptions, the first document of a file as what it holds."""
    file = lambda p: F.concat(F.lit(p), (F.col("doc_id") % 50).cast("string"), F.lit(".stl"))
    path = F.when(F.col("doc_id") % 7 == 6, F.lit("/x/other.stl")).otherwise(file("/x/f"))
    formulas = t.documents.select(F.col("doc_id").alias("formula"), F.col("doc_id").alias("number"), path.alias("path"), F.concat(F.col("text"), F.lit("\n")).alias("text"))
    pairs = t.conversations.select(F.col("conv_id").alias("formula"), F.col("turn").alias("realization"), F.col("text").alias("nl"))
    manifest = t.documents.where("text is not null").groupBy(file("stl/f").alias("file")).agg(F.min("doc_id").alias("record"), F.min_by("text", "doc_id").alias("text"))
    return R.described_rows(formulas, pairs, manifest)


@query(f"WITH {DESCRIBED_SQL} SELECT formula, CASE WHEN nl IS NOT NULL THEN CASE WHEN record IS NULL THEN 'stlnl_' || formula ELSE record::VARCHAR END || ':R' || turn END AS id, record, length(nl)::BIGINT AS n_chars FROM r")
def j10_link_by_file(t):
    return described(t).select("formula", "id", "record", F.char_length("nl").cast("long").alias("n_chars"))


@query(f"WITH {DESCRIBED_SQL}, g AS (SELECT formula, count(nl) AS n, bool_or(record IS NOT NULL) AS linked FROM r GROUP BY formula) SELECT count(*)::BIGINT AS formulas, count(*) FILTER (n = 0)::BIGINT AS without_description, count(*) FILTER (n > 0 AND NOT linked)::BIGINT AS not_linked, sum(n)::BIGINT AS descriptions FROM g")
def j10_conversion_counts(t):
    return R.conversion_counts(described(t))


@query("""WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents), j AS (SELECT 'src' || user_id AS source, list(event_type ORDER BY event_id) AS x FROM events GROUP BY user_id)
SELECT doc_id, x[n] AS judgment FROM r LEFT JOIN j USING (source)""")
def j11_attach_judgments(t):
    given = t.events.select(F.concat(F.lit("src"), F.col("user_id").cast("string")).alias("source"), "event_id", F.col("event_type").alias("judgment"))
    return R.attach_rows_by_position(t.documents.select("doc_id", "source"), given, "source", "doc_id", "event_id", "judgment").select("doc_id", "judgment")


@query("""SELECT e.event_id, s.a, s.b FROM (SELECT event_id, user_id, event_id AS pos FROM events WHERE event_type != 'signup') e
LEFT JOIN (SELECT user_id, event_id AS a, event_id + 900 AS b FROM events WHERE event_type = 'signup' AND value < 20) s ON s.user_id = e.user_id AND s.a <= e.pos AND e.pos < s.b
QUALIFY row_number() OVER (PARTITION BY e.event_id ORDER BY s.a, s.b) = 1""")
def j13_point_in_interval(t):
    e = t.events
    points = e.where("event_type != 'signup'").select("event_id", "user_id", F.col("event_id").alias("pos"))
    spans = e.where("event_type = 'signup' and value < 20").select("user_id", F.col("event_id").alias("a"), (F.col("event_id") + 900).alias("b"))
    return N.point_in_interval(points, spans, ["user_id"], "pos", "a", "b").select("event_id", "a", "b")


@query("""WITH h AS (SELECT user_id, event_id AS pos, CASE event_type WHEN 'signup' THEN 0 ELSE 1 END AS level FROM events WHERE event_type IN ('signup', 'purchase')), p AS (SELECT event_id, user_id FROM events WHERE event_type = 'view'),
x AS (SELECT p.event_id, max(h.pos) FILTER (level = 0) AS t0, max(h.pos) FILTER (level = 1) AS t1 FROM p LEFT JOIN h ON h.user_id = p.user_id AND h.pos <= p.event_id GROUP BY p.event_id)
SELECT event_id, concat_ws('/', 'h' || t0, CASE WHEN t0 IS NULL OR t1 > t0 THEN 'h' || t1 END) AS section FROM x""")
def j14_asof_heading(t):
    e = t.events.select("event_id", "user_id", "event_type", F.col("event_id").alias("pos"))
    heads = e.where("event_type in ('signup', 'purchase')").select("user_id", "pos", F.when(F.col("event_type") == "signup", 0).otherwise(1).alias("level"), F.concat(F.lit("h"), F.col("pos").cast("string")).alias("title"))
    found = N.asof_heading(e.where("event_type = 'view'").drop("event_type"), heads, ["user_id"], "pos", "level", "title", 2)
    return found.select("event_id", F.array_join("section", "/").alias("section"))


@query("""SELECT a.event_id, arg_min(b.event_id, (abs(b.value - a.value), abs(b.event_id - a.event_id), b.event_id)) AS nearest FROM events a JOIN events b ON a.user_id = b.user_id AND a.props = b.props AND b.event_type = 'click' WHERE a.event_type = 'purchase' GROUP BY a.event_id""")
def j15_nearest_occurrence(t):
    """The click of each purchase's user and props that is nearest by value, then by place in the log."""
    e = t.events.select("event_id", "user_id", "props", "value", "event_type")
    a = e.where("event_type = 'purchase'").select("event_id", F.col("event_id").alias("place"), "user_id", "props", "value")
    b = e.where("event_type = 'click'").select("user_id", "props", F.col("event_id").alias("nearest"), F.col("event_id").alias("at"), F.col("value").alias("v"))
    return C.nearest(a, b, ["user_id", "props"], "event_id", [("value", "v"), ("place", "at")], "nearest")


@query("SELECT l_orderkey, bool_or(l_returnflag = 'R') AS concrete, count(*)::BIGINT AS operators FROM lineitem GROUP BY l_orderkey")
def a7_pdf_line_formulas(t):
    ops = t.lineitem.select("l_orderkey", F.when(F.col("l_returnflag") == "R", "concrete").otherwise("symbolic").alias("kind"))
    return N.line_formulas(ops, ["l_orderkey"], "kind")


@query("""WITH s AS (SELECT source, list(n_chars ORDER BY n_chars) AS x FROM documents GROUP BY source) SELECT source, x[1 + floor(0.5 * (len(x) - 1))::INT] AS median, x[1 + floor(0.9 * (len(x) - 1))::INT] AS p90, x[len(x)] AS most FROM s""")
def a32_region_sizes(t):
    return N.quantile_at(t.documents.select("source", "n_chars"), ["source"], "n_chars", {"median": 0.5, "p90": 0.9, "most": 1.0})


@query("""SELECT source, count(n_chars)::BIGINT AS n, true AS median_near, true AS p90_near, true AS texts_near FROM documents WHERE lang IN ('en', 'de', 'fr') GROUP BY source HAVING count(n_chars) > 0""")
def a32_a8_size_profiles(t):
    """Profiles per source and language, kept as a table and added up for some languages, against the exact ranks and counts:
    quantiles by 2 % of the rank, distinct texts by 10 %."""
    docs = t.documents.select("source", "lang", "n_chars", F.md5(F.col("text").cast("binary")).alias("text"))
    kept = materialize(Q.profiles(docs, ["source", "lang"], "n_chars", "text"), "profiles")
    found = Q.merged(kept.where("lang in ('en', 'de', 'fr')"), ["source"], {"median": 0.5, "p90": 0.9}).withColumnRenamed("source", "_source")
    rows = docs.where("lang in ('en', 'de', 'fr') and n_chars is not null").join(found, F.col("source").eqNullSafe(F.col("_source")))
    exact = rows.groupBy("source", "n", "n_keys").agg(*(F.count_if(F.col("n_chars") < F.col(q)).alias(f"{q}_low") for q in ("median", "p90")), *(F.count_if(F.col("n_chars") <= F.col(q)).alias(f"{q}_high") for q in ("median", "p90")), F.count_distinct("text").alias("texts"))
    near = lambda q, share: ((F.col(f"{q}_low") <= (share + 0.02) * F.col("n") + 1) & (F.col(f"{q}_high") >= (share - 0.02) * F.col("n") - 1)).alias(f"{q}_near")
    return exact.select("source", "n", near("median", 0.5), near("p90", 0.9), (F.abs(F.col("n_keys") - F.col("texts")) <= 0.1 * F.col("texts")).alias("texts_near"))


@query("SELECT 'documents' AS set, 0::BIGINT AS set_rank, doc_id AS id, lang FROM documents UNION ALL SELECT 'pages', 1, page_id, NULL FROM pages UNION ALL SELECT 'benchmark', 2, item_id, NULL FROM benchmark")
def u1_concat_sets(t):
    both = R.concat_sets(("documents", t.documents.select(F.col("doc_id").alias("id"), "lang")), ("pages", t.pages.select(F.col("page_id").alias("id"))), ("benchmark", t.benchmark.select(F.col("item_id").alias("id"))))
    return both.select("set", "set_rank", "id", "lang")


@query(f"WITH {PAPERS_SQL} SELECT paper, array_to_string(list_sort(list_distinct(list_concat(source, catalogue))), ',') AS either, array_to_string(list_sort(list_filter(source, lambda x: NOT list_contains(catalogue, x))), ',') AS only_source, list_has_any(source, ['cc0', 'cc-by']) AS free FROM papers")
def u2_array_set_algebra(t):
    free = F.coalesce(F.arrays_overlap("source", F.array(F.lit("cc0"), F.lit("cc-by"))), F.lit(False))
    return papers(t).select("paper", F.array_join(F.array_sort(F.array_union("source", "catalogue")), ",").alias("either"), F.array_join(F.array_sort(F.array_except("source", "catalogue")), ",").alias("only_source"), free.alias("free"))


@query("""WITH p AS (SELECT doc_id FROM documents WHERE lang = 'en' UNION ALL SELECT doc_id FROM labels WHERE quality = 1 UNION ALL SELECT page_id FROM pages), c AS (SELECT doc_id, count(*) AS n FROM p GROUP BY 1)
SELECT (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM c))::BIGINT AS missing, count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM documents))::BIGINT AS extra, count(*) FILTER (n > 1)::BIGINT AS doubled FROM c""")
def u3_partition_check(t):
    """Parts that are no partition: English documents, good ones, and the ids of the pages."""
    return R.partition_check(t.documents, [t.documents.where("lang = 'en'"), t.labels.where("quality = 1"), t.pages.select(F.col("page_id").alias("doc_id"))], "doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def u4_unjudged_rest(t):
    return t.documents.select("doc_id").join(t.labels.select("doc_id"), "doc_id", "left_anti")


def _marks_sql(name: str, pattern: str) -> str:
    """Where a pattern stands, as DuckDB counts it."""
    return f"""{name} AS (SELECT doc_id, stop - length(regexp_extract(s, '(?s)^.*?({pattern})$', 1)) AS pos, stop FROM (SELECT doc_id, s, sum(length(s)) OVER (PARTITION BY doc_id ORDER BY i)::BIGINT AS stop FROM (SELECT doc_id, x[i] AS s, i FROM (SELECT doc_id, x, unnest(range(1, len(x) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(text, '(?s).*?(?:{pattern})') AS x FROM documents)))))"""


@query(f"""WITH {_marks_sql("hard", "[|]")}, {_marks_sql("par", "[.] *[\n]")}, {_marks_sql("line", "[.]")}, {_marks_sql("math", ",[^,.]+,")},
p AS (SELECT doc_id, text, length(text) AS n, length(text) // 2 AS s, least(length(text) // 2 + 10, length(text)) AS e FROM documents WHERE text IS NOT NULL),
a AS (SELECT *, coalesce((SELECT max(pos) FROM hard h WHERE h.doc_id = p.doc_id AND pos <= s), 0) AS lowest, coalesce((SELECT min(pos) FROM hard h WHERE h.doc_id = p.doc_id AND pos > s), n) AS top FROM p),
b AS (SELECT *, greatest(lowest, s - 500) AS l, least(top, e + 700) AS h FROM a),
c AS (SELECT *, (SELECT max(stop) FROM par m WHERE m.doc_id = b.doc_id AND stop <= l) AS lp, coalesce((SELECT max(stop) FROM line m WHERE m.doc_id = b.doc_id AND stop <= l), 0) AS ll, (SELECT min(stop) FROM par m WHERE m.doc_id = b.doc_id AND stop >= h) AS hp, coalesce((SELECT min(pos) FROM line m WHERE m.doc_id = b.doc_id AND pos >= h), top) AS hl FROM b),
d AS (SELECT *, CASE WHEN l <= lowest THEN l WHEN lp >= greatest(lowest, l - 200) THEN lp ELSE greatest(lowest, ll) END AS l2, CASE WHEN h >= top THEN h WHEN hp <= least(top, h + 200) THEN hp ELSE least(top, hl) END AS h2 FROM c)
SELECT doc_id, least(s, coalesce((SELECT max(pos) FROM math m WHERE m.doc_id = d.doc_id AND pos < l2 AND l2 < stop), l2))::BIGINT AS lo, greatest(e, coalesce((SELECT max(stop) FROM math m WHERE m.doc_id = d.doc_id AND pos < h2 AND h2 < stop), h2))::BIGINT AS hi FROM d""")
def w11_window_bounds(t):
    """The window around the middle of each text: bars part sections, sentences at line ends paragraphs, sentences lines; commas enclose formulas."""
    docs = t.documents.where("text is not null").select("doc_id", "text")
    n = F.char_length("text").cast("long")
    middle = docs.select("doc_id", F.floor(n / 2).cast("long").alias("s"), F.least(F.floor(n / 2) + 10, n).cast("long").alias("e"))
    return N.window_bounds(middle, docs, ["doc_id"], "s", "e", "text", "[|]", "[.] *[\n]", "[.]", ",[^,.]+,", 500, 700, 200).select("doc_id", "lo", "hi")


@query("""WITH e AS (SELECT user_id % 10 AS config, event_type AS level, event_id % 3 AS run, props->>'$.k' AS entry, avg((value > 20)::INT) > 0.5 AS ok, avg(value) AS seconds, sum(value) AS cost FROM events GROUP BY ALL),
r AS (SELECT config, level, run, count(*) FILTER (ok) AS n, median(seconds) AS seconds, sum(cost) AS cost FROM e GROUP BY ALL),
u AS (SELECT config, level, count(*) AS unstable FROM (SELECT config, level, entry FROM e GROUP BY ALL HAVING count(DISTINCT ok) > 1) GROUP BY ALL)
SELECT config::BIGINT AS config, level, count(*)::BIGINT AS runs, round(avg(n), 6) AS mean_right, min(n)::BIGINT AS least, max(n)::BIGINT AS most, round(avg(seconds), 6) AS seconds, round(avg(cost), 4) AS cost, coalesce(any_value(unstable), 0)::BIGINT AS unstable FROM r LEFT JOIN u USING (config, level) GROUP BY config, level""")
def a30_benchmark_summary(t):
    of = [(F.col("user_id") % 10).alias("config"), F.col("event_type").alias("level"), (F.col("event_id") % 3).alias("run"), F.get_json_object("props", "$.k").alias("entry")]
    scores = t.events.groupBy(*of).agg((F.avg((F.col("value") > 20).cast("double")) > 0.5).alias("ok"), F.avg("value").alias("seconds"), F.sum("value").alias("cost"))
    found = P.benchmark_summary(scores, ["config", "level"], "run", "entry", "ok", "seconds", "cost")
    return found.withColumns({"mean_right": F.round("mean_right", 6), "seconds": F.round("seconds", 6), "cost": F.round("cost", 4)})


@query("""WITH c AS (SELECT user_id AS entry, event_id % 4 AS config, avg((value < 40)::INT) AS wrong FROM events GROUP BY ALL),
f AS (SELECT entry, count(*)::BIGINT AS configs, count(*) FILTER (wrong > 0.5)::BIGINT AS mostly_wrong FROM c GROUP BY entry HAVING count(*) FILTER (wrong > 0.5) * 2 >= count(*)),
v AS (SELECT user_id AS entry, event_type AS answer, count(*) AS n FROM events WHERE value < 40 GROUP BY ALL), w AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY entry ORDER BY n DESC, answer) <= 4)
SELECT entry, configs, mostly_wrong, string_agg(answer || ' ' || n, ',' ORDER BY n DESC, answer) AS answers FROM f JOIN w USING (entry) GROUP BY ALL""")
def a31_entries_to_review(t):
    rows = t.events.select(F.col("user_id").alias("entry"), (F.col("event_id") % 4).alias("config"), F.col("event_type").alias("answer"), (F.col("value") < 40).alias("wrong"))
    return P.entries_to_review(rows, "entry", "config", "answer", "wrong", 4)


WORDS_SQL = """words AS (SELECT user_id, event_type AS w, event_id % 2 = 0 AS labelled, CASE WHEN max(value) > 90 THEN 'specific' ELSE 'generic' END AS kind FROM events WHERE event_id % 2 = 0 OR value > 60 GROUP BY ALL)"""


def labelled_and_given(t: Tables):
    """Passages of two annotators of each user: the labelled ones (even events), and the given ones, some of them with a letter more."""
    kind = F.when(F.max("value") > 90, "specific").otherwise("generic")
    e = t.events.where("event_id % 2 = 0 or value > 60").groupBy("user_id", (F.col("event_id") % 2 == 0).alias("labelled"), F.col("event_type").alias("text")).agg(kind.alias("kind"))
    text = F.when(~F.col("labelled") & (F.col("user_id") % 2 == 0), F.concat("text", F.lit("s"))).otherwise(F.col("text"))
    return e.select("user_id", "labelled", text.alias("text"), "kind")


@query(f"""WITH {WORDS_SQL}, e AS (SELECT user_id, count(*) AS n FROM words WHERE labelled GROUP BY 1), g AS (SELECT user_id, count(*) AS m FROM words WHERE NOT labelled GROUP BY 1),
b AS (SELECT user_id, count(*) AS n_both, count(*) FILTER (a.kind = c.kind) AS kinds FROM words a JOIN words c USING (user_id, w) WHERE a.labelled AND NOT c.labelled GROUP BY 1)
SELECT user_id, CASE WHEN n IS NULL THEN 'invented' WHEN m IS NULL THEN 'missed' WHEN n_both IS NULL THEN 'other' WHEN n_both < n OR n_both < m THEN 'partly' WHEN user_id % 2 = 0 THEN 'overlap' ELSE 'exact' END AS verdict,
coalesce(n_both, 0)::BIGINT AS found, (coalesce(m, 0) - coalesce(n_both, 0))::BIGINT AS extra, coalesce(kinds, 0)::BIGINT AS kinds_right
FROM (SELECT DISTINCT user_id FROM words) LEFT JOIN e USING (user_id) LEFT JOIN g USING (user_id) LEFT JOIN b USING (user_id)""")
def a29_score_entry(t):
    rows = labelled_and_given(t)
    return V.score_entries(rows.where("labelled"), rows.where("not labelled"), "user_id", "text", "kind")


@query(f"""WITH {WORDS_SQL}, e AS (SELECT user_id, count(*) AS n FROM words WHERE labelled GROUP BY 1), g AS (SELECT user_id, count(*) AS m FROM words WHERE NOT labelled GROUP BY 1),
b AS (SELECT user_id, count(*) AS n_both FROM words a JOIN words c USING (user_id, w) WHERE a.labelled AND NOT c.labelled GROUP BY 1), u AS (SELECT DISTINCT user_id FROM events)
SELECT user_id, CASE WHEN user_id % 7 = 0 THEN 'not answered' WHEN n IS NULL AND m IS NULL THEN 'n_both none' WHEN n IS NULL OR m IS NULL THEN 'one gives none' WHEN n_both = n AND n_both = m THEN 'same passages' WHEN n_both > 0 THEN 'partly the same' ELSE 'different passages' END AS agreement
FROM u LEFT JOIN e USING (user_id) LEFT JOIN g USING (user_id) LEFT JOIN b USING (user_id)""")
def a21_agreement(t):
    rows = labelled_and_given(t)
    items = t.events.select("user_id").distinct().withColumn("answered", F.col("user_id") % 7 != 0)
    return V.agreement(items, "answered", rows.where("labelled"), rows.where("not labelled"), "user_id", "text")


@query("""WITH p AS (SELECT user_id, 'm' || (event_id % 3) AS model, event_type AS w, CASE WHEN max(value) > 60 THEN 'specific' ELSE 'generic' END AS kind, min(value) < 50 AS copy FROM events GROUP BY ALL),
g AS (SELECT user_id, CASE arg_min(model, (NOT copy, model != 'm2', model)) WHEN 'm1' THEN w || 's' ELSE w END AS w, count(*) AS models, count(*) FILTER (kind = 'specific') AS s FROM p GROUP BY user_id, p.w HAVING count(*) >= 2),
k AS (SELECT *, CASE WHEN 2 * s > models THEN 'specific' WHEN 2 * s < models THEN 'generic' ELSE 'unclear' END AS kind FROM g),
d AS (SELECT * FROM k QUALIFY kind != 'generic' OR count(*) FILTER (kind = 'specific') OVER (PARTITION BY user_id) = 0),
asked AS (SELECT user_id, count(DISTINCT event_id % 3) AS asked FROM events GROUP BY 1), gave AS (SELECT user_id, count(DISTINCT model) AS gave FROM p GROUP BY 1),
kept AS (SELECT user_id, count(*) AS n, string_agg(w || ':' || kind, ',' ORDER BY w) AS passages FROM d GROUP BY 1)
SELECT user_id, CASE WHEN n > 0 THEN 'requirement' WHEN asked - coalesce(gave, 0) >= 2 THEN 'none' ELSE 'open' END AS outcome, coalesce(passages, '') AS passages FROM asked LEFT JOIN gave USING (user_id) LEFT JOIN kept USING (user_id)""")
def a23_requirement_vote(t):
    """Three models' passages of each user; the second model writes a letter more, the third one is preferred."""
    model = F.concat(F.lit("m"), (F.col("event_id") % 3).cast("string")).alias("model")
    given = t.events.groupBy("user_id", model, F.col("event_type").alias("w")).agg(F.when(F.max("value") > 60, "specific").otherwise("generic").alias("kind"), (F.min("value") < 50).alias("copy"))
    given = given.withColumn("text", F.when(F.col("model") == "m1", F.concat("w", F.lit("s"))).otherwise(F.col("w"))).drop("w")
    return V.requirement_vote(t.events.select("user_id", model).distinct(), given, "user_id", "model", "text", "kind", "copy", ["m2"])


def sources(t: Tables):
    """Formula sources made of the log: one paper per user with a main file, a part, an unused draft and a style file."""
    low, high = F.when(F.col("value") > 50, "a").otherwise("0"), F.when(F.col("event_id") % 2 == 0, r"\infty").otherwise("T")
    k = F.get_json_object("props", "$.k")
    line = F.concat(F.lit(r"$\alw_{["), low, F.lit(","), k, F.lit("]} ("), F.col("event_type"), F.lit(r" > 3 \rightarrow \ev_{[1, "), high, F.lit(r"]} x)$ % \Box_{[0,1]}"))
    body = t.events.groupBy(F.col("user_id").alias("paper_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", line.alias("l")))), lambda x: x["l"]), "\n").alias("text"))
    whole = [("main.tex", F.lit("\\begin{document}\n\\input{part}\n\\end{document}")), ("part.tex", F.col("text")), ("old.tex", F.lit(r"\Box_{[0,1]} draft")), ("own.sty", F.lit(r"\newcommand{\alw}{\square}\def\ev{\mathop{\mathbf{F}}}\newcommand{\red}[1]{#1}"))]
    return body.select("paper_id", F.explode(F.array(*(F.struct(F.lit(n).alias("path"), x.alias("text")) for n, x in whole))).alias("f")).select("paper_id", "f.*")


@query("""SELECT user_id AS paper_id, sum((value <= 50)::INT + (event_id % 2 = 0)::INT)::BIGINT AS concrete, sum((value > 50)::INT + (event_id % 2 = 1)::INT)::BIGINT AS symbolic,
count(*) FILTER (value <= 50 OR event_id % 2 = 0)::BIGINT AS formulas_concrete, count(*) FILTER (value > 50 AND event_id % 2 = 1)::BIGINT AS formulas_symbolic FROM events GROUP BY user_id""")
def a6_formula_counts(t):
    """Operators and formulas of each paper, in the files of its document."""
    return P.formula_counts(X.scan_papers(sources(t)), "paper_id")
