"""Queries with helpers that SQL has no function for, scans, readers and the streaming log."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import passages as H
from ..functions import scan as X
from ..functions import text as T
from ..functions.passages import check_passage, nearly_equal, same_passage
from ..operators.fuzzy import fuzzy_title_join
from ..operators.spans import point_in_interval
from ..scratch import scratch_path
from ..sources import readers as R
from ..streaming.ingest import ingest
from ..operators import report as P
from .corpus import FORMULA, sources
from .registry import Tables, query
from .selection import log
from .turns import turns


def _scratch(t: Tables, name: str) -> str:
    return scratch_path(t.spark, name)


@query()
def f17_word_difference(t):
    """Each turn against the next."""
    return turns(t).select("conv_id", "turn", H.word_difference("a", "b").alias("difference"))


@query()
def a34_paraphrase_stats(t):
    """Turns as paraphrases of the turn before, kept if they aren't short, in sets by the conversation's number."""
    rows = turns(t).select((F.col("conv_id") % 3).alias("part"), F.concat_ws(":", "conv_id", "turn").alias("original"), "conv_id", (F.char_length("b") >= 40).alias("kept"), (F.size(T.missing_symbols(F.col("a"), F.col("b"), F.lit("G[0,1] (the > de) U of"))) > 0).alias("missing"), H.word_difference("a", "b").alias("difference"))
    return P.paraphrase_stats(rows, "part", "original", "conv_id", "kept", "missing", "difference")


@query()
def f8_same_passage(t):
    """Each turn against the next: the longest common substring, and what follows from it."""
    both = turns(t).withColumn("n", H.longest_common("a", "b"))
    return both.select("conv_id", "turn", "n", same_passage(F.col("n"), F.col("a"), F.col("b")).alias("same"), nearly_equal(F.col("n"), F.col("a"), F.col("b")).alias("near"))


@query()
def f9_check_passage(t):
    """The middle of each turn, the ends of each turn joined, or the turn itself, against the turn or the next one."""
    k, n = F.col("turn") % 4, F.char_length("a")
    text = F.when(k == 0, F.substring("a", F.lit(5), F.lit(40))).when(k == 1, F.concat(F.substring("a", F.lit(1), F.lit(30)), F.substring("a", n - 20, F.lit(30)))).otherwise(F.col("a"))
    return turns(t).select("conv_id", "turn", check_passage(H.ordered_pieces(text, F.when(k == 3, F.col("b")).otherwise(F.col("a")))).alias("state"))


@query("""WITH c AS (SELECT conv_id, turn, event_type, (props->>'$.k') AS k, regexp_replace(text, '-\\s+([a-z])', '\\1', 'g') AS text FROM conversations c JOIN events e ON e.event_id = c.conv_id)
SELECT conv_id, turn, regexp_replace(nfc_normalize(text), '[{}_^~$]|``|\\x27\\x27|["“”]|⟦/?[A-Z]\\d+⟧|\\s+', '', 'g') || 'φ1≤' || k || '%-x' || event_type AS core FROM c""")
def f3_passage_core(t):
    """Turns with a formula after them as they are compared with a copy."""
    e = t.events.select(F.col("event_id").alias("conv_id"), "event_type", F.get_json_object("props", "$.k").alias("k"))
    text = F.concat(F.col("text"), F.lit(" “$\\varphi_{1} \\leq "), F.col("k"), F.lit("$\\%\n−\\mathbf{x}"), F.col("event_type"))
    return t.conversations.select("conv_id", "turn", "text").join(e, "conv_id").select("conv_id", "turn", T.passage_core(text).alias("core"))


@query()
def j12_fuzzy_title_join(t):
    """For every document the first one before it whose first line is alike (ratio of at least 0.88)."""
    docs = t.documents.select("doc_id", F.substring_index("text", "\n", 1).alias("title"))
    return fuzzy_title_join(docs, "doc_id", "title")


@query("""SELECT user_id AS paper_id, 2 * count(*)::BIGINT AS operators, sum((value <= 50)::INT + (event_id % 2 = 0)::INT)::BIGINT AS concrete, sum((value > 50)::INT + (event_id % 2 = 1)::INT)::BIGINT AS symbolic, 1::BIGINT AS outside FROM events GROUP BY user_id""")
def x1_x3_x5_scan_sources(t):
    found, own = X.scan_papers(sources(t)), F.col("in_document")
    return found.groupBy("paper_id").agg(F.count_if(own).alias("operators"), F.count_if(own & (F.col("kind") == "concrete")).alias("concrete"), F.count_if(own & (F.col("kind") == "symbolic")).alias("symbolic"), F.count_if(~own).alias("outside"))


@query("SELECT user_id, count(*)::BIGINT AS lines, count(*)::BIGINT AS concrete FROM events GROUP BY user_id")
def x4_scan_pages(t):
    pages = t.events.select("user_id", "event_id", F.expr(FORMULA).alias("text"))
    found = X.scan_pages(pages, ["user_id", "event_id"], "text")
    lines = found.groupBy("user_id", "event_id", "line").agg(F.bool_or(F.col("kind") == "concrete").alias("c"))
    return lines.groupBy("user_id").agg(F.count(F.lit(1)).alias("lines"), F.count_if("c").alias("concrete"))


@query("SELECT user_id AS id, max(event_id) AS last, count(*)::BIGINT AS n FROM events GROUP BY user_id")
def s1_read_keyed_json(t):
    path = _scratch(t, "keyed")
    each = t.events.groupBy("user_id").agg(F.max("event_id").alias("last"), F.count(F.lit(1)).alias("n"))
    files = each.groupBy((F.col("user_id") % 16).alias("file")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("user_id").cast("string"), F.struct("last", "n"))))).alias("value"))
    files.repartition("file").write.partitionBy("file").text(path)  # a keyed object per file
    return R.read_keyed_json(t.spark, path, "struct<last:long,n:long>").withColumn("id", F.col("id").cast("long"))


@query("SELECT event_id, event_type, value FROM events WHERE event_id % 10 != 0")
def s2_read_jsonl(t):
    path = _scratch(t, "jsonl")
    line = F.to_json(F.struct("event_id", "event_type", "value"))
    cut = F.when(F.col("event_id") % 10 == 0, F.substring(line, 1, 15)).otherwise(line)  # every tenth line is cut short
    t.events.select(cut.alias("value")).write.text(path)
    return R.read_jsonl(t.spark, path, "event_id long, event_type string, value double")


@query("SELECT count(*) FILTER (event_id % 10 != 0)::BIGINT AS good, count(*) FILTER (event_id % 10 = 0)::BIGINT AS malformed FROM events")
def s2_count_malformed(t):
    path = _scratch(t, "jsonl")
    line = F.to_json(F.struct("event_id", "event_type", "value"))
    t.events.select(F.when(F.col("event_id") % 10 == 0, F.substring(line, 1, 15)).otherwise(line).alias("value")).write.text(path)
    return R.count_malformed(t.spark, path, "event_id long, event_type string, value double")


@query("SELECT user_id::VARCHAR AS paper_id, '.txt' AS ext, sum(length(event_type) + 1)::BIGINT AS n_chars FROM events GROUP BY user_id")
def s3_read_source_tree(t):
    """A folder of text files per user, read back as files."""
    path = _scratch(t, "tree")
    t.events.select("user_id", F.col("event_type").alias("value")).repartition("user_id").write.partitionBy("user_id").text(path)
    files = R.read_source_tree(t.spark, path, r"/user_id=([^/]+)/[^/]+$", [".txt"])
    return files.groupBy("paper_id", "ext").agg(F.sum(F.char_length("text")).alias("n_chars"))


@query("SELECT page_id, url FROM pages")
def s4_read_feed_xml(t):
    path = _scratch(t, "feed")
    entry = F.concat(F.lit("<feed><entry><id>"), F.col("page_id").cast("string"), F.lit("</id><link>"), F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")), F.lit("</link></entry></feed>"))
    t.pages.select(entry.alias("value")).write.text(path)
    return R.read_feed(t.spark, path, "id:long,link:string").select(F.col("id").alias("page_id"), F.col("link").alias("url"))


@query("SELECT doc_id, lang, source FROM documents")
def s7_write_csv(t):
    path = _scratch(t, "csv")
    R.write_csv(t.documents.select("doc_id", F.array("lang").alias("lang"), "source"), path, ["lang"])
    return t.spark.read.schema("doc_id long, lang string, source string").option("header", True).csv(path)


@query("SELECT doc_id, lang FROM documents WHERE lang IN ('de', 'fr')")
def s9_tier_subset(t):
    path = _scratch(t, "tier")
    R.write_by_tier(t.documents.select("doc_id", "lang"), path, "lang", ["de", "fr"])
    return t.spark.read.parquet(path)


@query("SELECT part, count(*)::BIGINT AS n FROM (SELECT CASE WHEN quality IS NULL THEN 'unpaired' WHEN quality = 1 THEN 'paired' ELSE 'excluded' END AS part FROM documents LEFT JOIN labels USING (doc_id)) GROUP BY part")
def s10_write_partition_of_records(t):
    path = _scratch(t, "parts")
    part = F.when(F.col("quality").isNull(), "unpaired").when(F.col("quality") == 1, "paired").otherwise("excluded")
    rows = t.documents.select("doc_id", "source").join(t.labels.select("doc_id", "quality"), "doc_id", "left").withColumn("part", part)
    rows.repartitionByRange("part", "source", "doc_id").sortWithinPartitions("part", "source", "doc_id").write.partitionBy("part").parquet(path)
    return t.spark.read.parquet(path).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT user_id AS item, event_id AS seq, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY (event_type != 'error') DESC, CASE WHEN event_type != 'error' THEN -event_id ELSE event_id END) = 1")
def t1_ingest_answers(t):
    """The log in two deliveries, each taken in as a stream; the result is that of all rows at once."""
    files, state, marks = (_scratch(t, x) for x in ("log", "state", "marks"))
    rows = log(t).select("item", "seq", "event_type")
    ok, out = F.col("event_type") != "error", None
    for half in (0, 1):
        rows.where(F.pmod(F.xxhash64("seq"), F.lit(2)) == half).write.mode("append").json(files)
        out = ingest(t.spark, files, "item long, seq long, event_type string", state, marks, ["item"], "seq", ok)
    return out


@query("""WITH s AS (SELECT user_id, event_id AS a, event_id + 900 AS b FROM events WHERE event_type = 'signup' AND value < 20), e AS (SELECT event_id, user_id, props FROM events WHERE event_type = 'purchase'),
x AS (SELECT e.*, min(s.a) AS a FROM e LEFT JOIN s ON s.user_id = e.user_id AND s.a <= e.event_id AND e.event_id < s.b GROUP BY ALL),
r AS (SELECT x.event_id, count(*) AS n, count(*) FILTER (v.event_id >= a AND v.event_id < a + 900) AS inside FROM x JOIN events v ON v.event_type = 'view' AND v.user_id = x.user_id AND v.props = x.props GROUP BY 1),
y AS (SELECT CASE WHEN a IS NULL THEN 'in no region' WHEN EXISTS (SELECT 1 FROM events c WHERE c.event_type = 'click' AND c.user_id = x.user_id AND c.props = x.props AND c.event_id >= a AND c.event_id < a + 900) THEN 'marked' ELSE 'inside, not marked' END AS state, r.n, r.inside FROM x LEFT JOIN r USING (event_id))
SELECT state, CASE WHEN n IS NULL THEN 'none' WHEN state = 'marked' AND inside = n THEN 'inside' ELSE 'outside' END AS requirement, count(*)::BIGINT AS n FROM y GROUP BY ALL""")
def a36_eval_coverage(t):
    """Purchases as labelled formulas: in a region, marked there by a click, and with all their requirements (views) in it."""
    e = t.events.select("event_id", "user_id", "props", "event_type", "value")
    spans = e.where("event_type = 'signup' and value < 20").select("user_id", F.col("event_id").alias("a"), (F.col("event_id") + 900).alias("b"))
    entries = point_in_interval(e.where("event_type = 'purchase'").select("user_id", "props", F.col("event_id").alias("pos")), spans, ["user_id"], "pos", "a", "b")
    of = lambda kind: e.where(F.col("event_type") == kind).select("user_id", "props", F.col("event_id").alias("mark"))
    return P.eval_coverage(entries, of("click"), of("view"), ["user_id", "props"], "pos", "a", "b", "mark")


@query("SELECT event_id, CASE WHEN value > 80 THEN '\\phi := ' ELSE '' END || 'G_{[0, ' || (props->>'$.k') || ']} ' || event_type || CASE WHEN value > 80 THEN ' rest ' ELSE '' END AS formula, value <= 80 AS found FROM events")
def f5_trim_formula(t):
    """Marked lines with two copies, the first of which is of another line; where neither is found the whole line is cleaned."""
    k = F.get_json_object("props", "$.k")
    written = F.concat(F.lit("G_{[0, "), k, F.lit("]} "), F.col("event_type"))
    source = F.concat(F.lit("$ \\phi := "), written, F.lit(" \\\\ & rest .$"))
    copy = F.concat(F.lit("G_{[0,"), k, F.lit("]}"), F.when(F.col("value") > 80, F.lit("q")).otherwise(F.col("event_type")))
    return t.events.select("event_id", T.trim_formula(source, F.array(F.lit("F_{[0,1]}none"), copy)).alias("x")).select("event_id", "x.*")


@query("""WITH e AS (SELECT *, user_id % 5 = 0 AS none, event_id % 4 = 3 AS transcribed, event_id % 3 = 0 AS two, CASE WHEN k % 3 = 0 THEN 'passage joined' WHEN k % 3 = 1 THEN 'passage not a copy' END AS state FROM (SELECT *, (props->>'$.k')::INT AS k FROM events))
SELECT event_id, concat_ws('|', CASE WHEN none THEN 'no formula' WHEN transcribed AND value > 50 THEN 'bounds missing: 1000, 1001' WHEN NOT transcribed AND value > 50 THEN 'not a copy' END,
CASE WHEN state IS NOT NULL THEN state || CASE WHEN two THEN ' (passage 1)' ELSE '' END END, CASE WHEN event_id % 2 = 1 THEN 'unknown kind: ' || event_type || CASE WHEN two THEN ' (passage 1)' ELSE '' END END,
CASE WHEN two AND event_id % 5 = 0 THEN 'unknown kind: (none) (passage 2)' END, CASE WHEN two AND (event_id % 2 = 1 OR event_id % 5 = 0) THEN 'mixed kinds' END,
CASE WHEN value <= 20 THEN 'unknown domain: ' || event_type WHEN value > 95 THEN 'unknown domain: (none)' END, CASE WHEN none THEN 'symbol not in formula: ' || event_type END,
CASE WHEN user_id % 3 = 0 OR none THEN 'symbol not in formula: ' || CASE WHEN user_id % 3 = 0 THEN 'q_9' ELSE 'x_{3}' END END) AS flags FROM e""")
def f10_check_extraction(t):
    """Answers whose formula is none, no copy, or a transcription without its line's bounds; with one or two passages, some joined
    or not copies, of kinds and domains that are none; and with a symbol of an indexed family or a strange one."""
    e, k = F.col("event_type"), F.get_json_object("props", "$.k")
    formula = F.when(F.col("user_id") % 5 == 0, " ").otherwise(F.concat(F.lit("G_{[0,"), k, F.lit("]}"), e, F.lit(" > x_{i}")))
    source = F.concat(F.lit("$G_{[0, "), F.when(F.col("value") > 50, F.lit("1000")).otherwise(k), F.lit("]} "), e, F.lit(" > x_{i}$"))
    n = k.cast("int") % 3
    state = F.when(n == 0, "joined").when(n == 1, "not a copy").otherwise("copy")
    passage = lambda kind, state: F.struct(kind.alias("kind"), state.alias("state"))
    first = passage(F.when(F.col("event_id") % 2 == 1, e).otherwise("generic"), state)
    second = passage(F.when(F.col("event_id") % 5 == 0, "").otherwise("generic"), F.lit("copy"))
    passages = F.when(F.col("event_id") % 3 == 0, F.array(first, second)).otherwise(F.array(first))
    domain = F.when(F.col("value") <= 20, e).when(F.col("value") > 95, "").when(F.col("event_id") % 2 == 0, "aerial robotics").otherwise("smart home")
    symbols = F.array(e, F.when(F.col("user_id") % 3 == 0, F.lit("q_9")).otherwise(F.lit("x_{3}")))
    operators = F.when(F.col("value") > 50, F.array(F.array(F.lit("1000"), F.lit("1001")))).otherwise(F.array(F.array(k)))
    flags = T.check_extraction(formula, source, passages, domain, symbols, F.col("event_id") % 4 == 3, operators)
    return t.events.select("event_id", F.array_join(flags, "|").alias("flags"))
