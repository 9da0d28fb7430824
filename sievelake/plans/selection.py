"""Queries: selection, counting and answers, over documents, events and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import answers as A
from ..operators import records as R
from ..operators import report as P
from ..operators import select as S
from ..operators import votes as V
from ..scratch import scratch_path
from ..sources.named import read_named_texts, write_named_texts
from ..sources.readers import numbered_names
from .registry import Tables, query
from .turns import TURNS_SQL, turns
from .turns import quoted as _words

LABELS = {"view": "correct", "click": "ambiguous", "purchase": "wrong", "signup": "no"}
LABEL_SQL = "CASE event_type WHEN 'view' THEN 'correct' WHEN 'click' THEN 'ambiguous' WHEN 'purchase' THEN 'wrong' WHEN 'signup' THEN 'no' END"


def ok():
    return F.col("event_type") != "error"



def log(t: Tables):
    """events as an answer log: item, model, seq, label (null for a failed call), key and cost."""
    label = F.coalesce(*(F.when(F.col("event_type") == k, F.lit(v)) for k, v in LABELS.items()))
    return t.events.select(
        F.col("event_id").alias("seq"), F.col("user_id").alias("item"), F.concat(F.lit("m"), (F.col("event_id") % 3).cast("string")).alias("model"), label.alias("label"), "event_type", F.col("props").alias("content"),
        F.col("value").alias("cost"), F.get_json_object("props", "$.k").cast("long").alias("k"), "ts",
    )


LOG_SQL = f"log AS (SELECT event_id AS seq, user_id AS item, 'm' || (event_id % 3)::VARCHAR AS model, {LABEL_SQL} AS label, event_type, props AS content, value AS cost, (props->>'$.k')::BIGINT AS k, ts FROM events)"
LATEST_SQL = """latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item, model ORDER BY (event_type != 'error') DESC, CASE WHEN event_type != 'error' THEN -seq ELSE seq END) AS r FROM log) WHERE r = 1)"""
VOTE_SQL = """three AS (SELECT item, max(label) FILTER (model = 'm0') AS a, max(label) FILTER (model = 'm1') AS b, max(label) FILTER (model = 'm2') AS c FROM latest GROUP BY item),
voted AS (SELECT *, CASE WHEN a IS NULL OR b IS NULL THEN NULL WHEN a = b THEN a WHEN c IS NULL THEN NULL WHEN c = a OR c = b THEN c WHEN list_sort([a, b, c]) = ['ambiguous', 'correct', 'wrong'] THEN 'ambiguous' END AS final,
  CASE WHEN a IS NULL OR b IS NULL THEN 'unjudged' WHEN a = b THEN 'agreed' WHEN c IS NULL THEN 'disputed' WHEN c = a OR c = b THEN 'third decides' WHEN list_sort([a, b, c]) = ['ambiguous', 'correct', 'wrong'] THEN 'middle one' ELSE 'undecided' END AS how FROM three)"""


def latest(t: Tables):
    return A.latest_answer(log(t), ["item", "model"], "seq", ok())


def voted(t: Tables):
    three = latest(t).groupBy("item").agg(*(F.max(F.when(F.col("model") == m, F.col("label"))).alias(c) for m, c in (("m0", "a"), ("m1", "b"), ("m2", "c"))))
    return three.withColumn("v", V.label_vote(F.col("a"), F.col("b"), F.col("c"))).select("item", "a", "b", "c", F.col("v.label").alias("final"), F.col("v.how").alias("how"))


@query("SELECT lang, count(*)::BIGINT AS n, round(count(*) / sum(count(*)) OVER (), 9) AS share FROM documents GROUP BY lang")
def a2_value_counts(t):
    return P.value_counts(t.documents, "lang").withColumn("share", F.round("share", 9))


@query("""SELECT source, count(*) FILTER (lang = 'de')::BIGINT AS de, count(*) FILTER (lang = 'en')::BIGINT AS en, count(*) FILTER (lang = 'es')::BIGINT AS es, count(*) FILTER (lang = 'fr')::BIGINT AS fr,
  count(*) FILTER (lang IN ('de', 'en', 'es', 'fr'))::BIGINT AS total, round(count(*) FILTER (lang IN ('de', 'en', 'es', 'fr')) / sum(count(*) FILTER (lang IN ('de', 'en', 'es', 'fr'))) OVER (), 9) AS share FROM documents GROUP BY source""")
def a10_counts_by_set(t):
    return P.counts_by_set(t.documents.select("source", "lang"), "source", "lang", ["de", "en", "es", "fr"]).withColumn("share", F.round("share", 9))


@query("""WITH c AS (SELECT user_id, count(*) AS n FROM events WHERE user_id IS NOT NULL GROUP BY user_id),
top AS (SELECT sum(n) AS s FROM (SELECT n FROM c ORDER BY n DESC, user_id LIMIT 10))
SELECT sum(n)::BIGINT AS n_rows, count(*)::BIGINT AS n_values, count(*) FILTER (n = 1)::BIGINT AS seen_once, any_value(top.s)::BIGINT AS top_rows, round(any_value(top.s) / sum(n), 9) AS top_share FROM c, top""")
def a11_coverage(t):
    return P.coverage(t.events, "user_id", 10).withColumn("top_share", F.round("top_share", 9))


@query("""WITH f AS (SELECT text, min(doc_id) AS first FROM documents GROUP BY text)
SELECT doc_id, CASE WHEN f.first != doc_id THEN f.first END AS duplicate_of FROM documents d LEFT JOIN f ON d.text = f.text""")
def w3_mark_duplicates(t):
    return S.mark_duplicates(t.documents.select("doc_id", "text"), "text", "doc_id", "doc_id").select("doc_id", "duplicate_of")


@query("""WITH a AS (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang, source ORDER BY md5('s:' || doc_id), doc_id) AS turn FROM documents),
b AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY turn, md5('s:' || source), source, doc_id) AS slot FROM a WHERE turn <= 10)
SELECT a.doc_id, a.lang, a.source, CASE WHEN b.slot <= 10 THEN 'kept' ELSE 'template_cap' END AS selection FROM a LEFT JOIN b USING (doc_id)""")
def w4_cap_per_group(t):
    return S.cap_per_group(t.documents.select("doc_id", "lang", "source"), "lang", "source", "doc_id", 10, "s")


@query("""SELECT lang, doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY (NOT contains(text, ','))::INT + (NOT contains(text, '.'))::INT, length(text) < 15, length(text), doc_id) AS r FROM documents) WHERE r = 1""")
def w13_best_example(t):
    docs = t.documents.select("lang", "doc_id", "n_chars", "text")
    return S.best_example(docs, "lang", [F.contains("text", F.lit(",")), F.contains("text", F.lit("."))], "text", "doc_id").select("lang", "doc_id", "n_chars")


def _examples_sql(n: int) -> str:
    """The greedy choice, a step at a time: first of the kinds in their order, then of all rows."""
    steps = ["c0 AS (SELECT lang, NULL::BIGINT AS doc_id, NULL AS source, NULL::BIGINT AS o FROM d WHERE false)"]
    for i in range(1, 2 * n + 1):
        of_kind = f"AND d.o > coalesce((SELECT max(o) FROM c{i - 1} c WHERE c.lang = d.lang), 0)" if i <= n else ""
        order = "d.o, doc_id" if i <= n else "doc_id"
        steps.append(f"""c{i} AS (SELECT * FROM c{i - 1} UNION ALL (SELECT lang, doc_id, source, o FROM d WHERE source NOT IN (SELECT source FROM c{i - 1} c WHERE c.lang = d.lang) AND (SELECT count(*) FROM c{i - 1} c WHERE c.lang = d.lang) < {n} {of_kind} QUALIFY row_number() OVER (PARTITION BY lang ORDER BY {order}) = 1))""")
    return f"""WITH k AS (SELECT doc_id, lang, source, CASE WHEN n_chars > 4000 THEN 'long' ELSE 'short' END AS kind FROM documents), s AS (SELECT *, count(*) OVER (PARTITION BY lang, kind) AS kind_size, min(doc_id) OVER (PARTITION BY lang, kind) AS first FROM k),
d AS (SELECT *, dense_rank() OVER (PARTITION BY lang ORDER BY kind_size DESC, first) AS o FROM s), {', '.join(steps)} SELECT c.lang, d.kind, c.source, c.doc_id, d.kind_size::BIGINT AS kind_size FROM c{2 * n} c JOIN d USING (doc_id)"""


@query(_examples_sql(3))
def w14_diverse_examples(t):
    docs = t.documents.select("lang", F.when(F.col("n_chars") > 4000, "long").otherwise("short").alias("kind"), "source", "doc_id")
    return S.diverse_examples(docs, "lang", "kind", "source", "doc_id").select("lang", "kind", "source", "doc_id", "kind_size")


@query("SELECT source, lang, min(doc_id) AS doc_id FROM documents GROUP BY ALL")
def w15_first_per_formula(t):
    return S.first_n(t.documents.select("source", "lang", "doc_id"), ["source", "lang"], ["doc_id"], 1)


@query("SELECT o_custkey, count(*)::BIGINT AS orders, count(DISTINCT o_orderpriority)::BIGINT AS priorities FROM orders GROUP BY o_custkey ORDER BY orders DESC, priorities DESC, o_custkey LIMIT 20")
def o1_top_papers(t):
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.count_distinct("o_orderpriority").alias("priorities"))
    return counts.orderBy(F.desc("orders"), F.desc("priorities"), "o_custkey").limit(20)


@query("SELECT doc_id, lang FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 50")
def o2_stable_sample(t):
    return S.stable_sample(t.documents.select("doc_id", "lang"), "doc_id", 50, "7")


@query("""WITH c AS (SELECT doc_id, CASE WHEN lang = 'de' THEN 'german' WHEN n_chars > 5000 THEN 'long' ELSE 'rest' END AS class FROM documents),
q AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY md5('3:' || doc_id), doc_id) AS r FROM c),
chosen AS (SELECT doc_id, class FROM q WHERE (class = 'german' AND r <= 20) OR (class = 'long' AND r <= 14)),
rest AS (SELECT doc_id, 'rest' AS class FROM c WHERE doc_id NOT IN (SELECT doc_id FROM chosen) ORDER BY md5('3:' || doc_id), doc_id LIMIT 66)
SELECT * FROM chosen UNION ALL SELECT * FROM rest""")
def o3_quota_sample(t):
    docs = t.documents.select("doc_id", "lang", "n_chars")
    return S.quota_sample(docs, "doc_id", [("german", F.col("lang") == "de", 20), ("long", F.col("n_chars") > 5000, 14)], 100, "3").select("doc_id", "class")


@query("SELECT event_id, event_type FROM events WHERE event_type LIKE 'p%' ORDER BY md5('1:' || event_id), event_id LIMIT 20")
def o4_reason_sample(t):
    return S.stable_sample(t.events.where(F.startswith("event_type", F.lit("p"))).select("event_id", "event_type"), "event_id", 20, "1")


@query("SELECT event_type, event_id, times::BIGINT AS times FROM (SELECT event_type, event_id, count(*) OVER (PARTITION BY event_type) AS times, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS r FROM events) WHERE r <= 5")
def o5_first_n_per_check(t):
    return S.first_n_of_frequent(t.events.select("event_type", "event_id"), "event_type", ["event_id"], 5).select("event_type", "event_id", "times")


@query(f"WITH {LOG_SQL}, {LATEST_SQL}, {VOTE_SQL} SELECT item, a, b, c FROM voted WHERE how IN ('undecided', 'disputed') ORDER BY item LIMIT 20")
def o6_undecided_list(t):
    return voted(t).where(F.col("how").isin("undecided", "disputed")).select("item", "a", "b", "c").orderBy("item").limit(20)


@query("SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY lang, doc_id)::BIGINT AS number FROM documents")
def o7_deterministic_order(t):
    return S.number_rows(t.documents.select("doc_id", "source", "lang"), ["source"], ["lang", "doc_id"]).select("doc_id", "source", "number")


@query("""WITH k AS (SELECT event_id, event_type || chr(10) || props AS text, CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'ok' END AS status FROM events WHERE value > 90)
SELECT status, status || '-f' || printf('%05d', row_number() OVER (PARTITION BY status ORDER BY event_id NULLS FIRST, text NULLS FIRST)) || '.txt' AS file, text FROM k""")
def s8_numbered_export(t):
    """Texts in numbered files, separately per status, written together and read back. Numbers have five digits or more."""
    status = F.when(F.col("event_type") == "error", "rejected").otherwise("ok")
    rows = t.events.where("value > 90").select("event_id", status.alias("status"), F.concat("event_type", F.lit("\n"), "props").alias("text"))
    numbered = S.number_rows(rows, ["status"], ["event_id", "text"], "number")
    named = numbered_names(numbered, "number").withColumn("file", F.concat("status", F.lit("-"), "file"))
    path = scratch_path(t.spark, "export")
    write_named_texts(named, path, "file", "text")
    # no text is empty, so an empty file stands for a missing one
    return read_named_texts(t.spark, path, empty=True).select(F.regexp_extract("file", "^([a-z]+)-", 1).alias("status"), "file", F.nullif("text", F.lit("")).alias("text"))


@query(f"""WITH {LOG_SQL}, {LATEST_SQL}, {VOTE_SQL}, s AS (SELECT item % 4 AS set, item, final, bool_or(final IS NULL) OVER (PARTITION BY item % 4) AS open FROM voted WHERE how != 'undecided' AND item % 4 != 3 OR item % 4 = 3)
SELECT set::BIGINT AS set, item, CASE WHEN open OR final = 'correct' THEN 'pairs' WHEN final = 'ambiguous' THEN 'pairs_ambiguous' ELSE 'dropped' END AS part FROM s""")
def s6_split_parts(t):
    """Judged sets in parts by label, written as JSON Lines and read back."""
    rows = voted(t).withColumn("set", F.col("item") % 4).where((F.col("how") != "undecided") & (F.col("set") != 3) | (F.col("set") == 3))
    path = scratch_path(t.spark, "split")
    R.write_split(rows.select("set", "item", "final"), path, "set", "final", "json")
    return t.spark.read.schema("item long, final string, set long, part string").json(path).select("set", "item", "part")


@query(f"WITH {LOG_SQL} SELECT item, model, seq, event_type, cost FROM (SELECT *, row_number() OVER (PARTITION BY item, model ORDER BY (event_type != 'error') DESC, CASE WHEN event_type != 'error' THEN -seq ELSE seq END) AS r FROM log) WHERE r = 1")
def w1_latest_answer(t):
    return latest(t).select("item", "model", "seq", "event_type", "cost")


@query(f"""WITH {LOG_SQL}, g AS (SELECT *, max(CASE WHEN event_type != 'error' THEN seq END) OVER w AS good, max(CASE WHEN event_type = 'error' THEN seq END) OVER w AS fail FROM log WINDOW w AS (PARTITION BY item, model)),
k AS (SELECT *, max(CASE WHEN seq = good THEN content END) OVER w AS kg, max(CASE WHEN seq = fail THEN content END) OVER w AS kf FROM g WINDOW w AS (PARTITION BY item, model))
SELECT item, model, seq, content FROM k WHERE seq = CASE WHEN good IS NULL OR (fail > good AND kf != kg) THEN fail ELSE good END""")
def w2_latest_usable(t):
    return A.latest_usable(log(t), ["item", "model"], "seq", ok(), "content").select("item", "model", "seq", "content")


@query(f"WITH {LOG_SQL}, s AS (SELECT item, seq, cost, coalesce(sum(cost) OVER (PARTITION BY item ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM log) SELECT item, seq, round(spent, 4) AS spent_before FROM s WHERE spent < 200")
def w7_budget_cut(t):
    return A.budget_cut(log(t), "item", "seq", "cost", 200.0).select("item", "seq", F.round("spent_before", 4).alias("spent_before"))


@query(f"WITH {LOG_SQL} SELECT item, seq, sum((event_type = 'signup')::INT) OVER (PARTITION BY item ORDER BY seq ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM log")
def w8_log_runs(t):
    return A.log_runs(log(t), "item", "seq", F.col("event_type") == "signup").select("item", "seq", "run")


@query(f"""WITH {LOG_SQL}, m AS (SELECT *, max(CASE WHEN event_type = 'error' THEN seq END) OVER w AS lw, max(CASE WHEN event_type != 'error' THEN seq END) OVER w AS lr,
  last_value(CASE WHEN event_type = 'error' THEN ts END IGNORE NULLS) OVER w AS lt FROM log WINDOW w AS (PARTITION BY item ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT item, seq, (lw IS NULL OR coalesce(lr, -1) > lw) AND (lt IS NULL OR epoch_us(ts) >= epoch_us(lt) + 86400000000) AS answered FROM m WHERE event_type != 'error'""")
def j16_cooldown_join(t):
    return A.cooldown_answers(log(t), ["item"], "seq", "ts", F.col("event_type") == "error", ok(), 86400).select("item", "seq", "answered")


@query(f"WITH {LOG_SQL} SELECT item, model, seq, event_type != 'error' AS answered FROM log QUALIFY row_number() OVER (PARTITION BY item, model ORDER BY (event_type != 'error') DESC, seq DESC) = 1")
def a35_lookup_evidence(t):
    rows = log(t).select("item", "model", "seq", ok().alias("answered"))
    return A.lookup_evidence(rows, ["item", "model"], "seq", "answered")


def _items(t):
    return log(t).groupBy("item").agg(F.max_by("content", "seq").alias("content"))


ITEMS_SQL = "items AS (SELECT item, max_by(content, seq) AS content FROM log GROUP BY item)"


@query(f"""WITH {LOG_SQL}, {ITEMS_SQL}, asked AS (SELECT item, model, max_by(content, seq) FILTER (event_type != 'error') AS c, bool_or(event_type != 'error') AS u FROM log GROUP BY ALL)
SELECT i.item, m.model, CASE WHEN u IS NULL THEN 'new' WHEN NOT u THEN 'incomplete' WHEN c != i.content THEN 'outdated' ELSE 'stored' END AS state
FROM items i CROSS JOIN (SELECT DISTINCT model FROM log) m LEFT JOIN asked a ON a.item = i.item AND a.model = m.model""")
def j6_plan_tasks(t):
    return _tasks(t).select("item", "model", "state")


def _tasks(t):
    models = t.spark.createDataFrame([("m0",), ("m1",), ("m2",)], "model string")
    best = log(t).groupBy("item", "model").agg(F.max_by("content", F.when(ok(), F.col("seq"))).alias("content"), F.max(F.when(ok(), 1).otherwise(0)).alias("u"))
    return A.plan_tasks(_items(t), models, best, "item", "model", "content", F.col("u") == 1)


@query(f"WITH {LOG_SQL}, {ITEMS_SQL} SELECT l.item, l.seq FROM log l JOIN items i ON l.item = i.item AND l.content = i.content")
def j7_current_answers(t):
    return A.current_answers(log(t), _items(t), "item", "content").select("item", "seq")


@query(f"WITH {LOG_SQL}, {LATEST_SQL} SELECT item, max(label) FILTER (model = 'm0') AS m0, max(label) FILTER (model = 'm1') AS m1, max(label) FILTER (model = 'm2') AS m2 FROM latest GROUP BY item")
def j8_side_by_side(t):
    wide = A.side_by_side(latest(t), "item", "model", "label", ["m0", "m1", "m2"])
    return wide.select("item", *(F.element_at("answers", F.lit(m)).alias(m) for m in ("m0", "m1", "m2")))


@query(f"WITH {LOG_SQL}, {LATEST_SQL}, {VOTE_SQL} SELECT item, a, b, c, final, how FROM voted")
def a27_label_vote(t):
    return voted(t)


@query(f"WITH {LOG_SQL}, {LATEST_SQL}, {VOTE_SQL} SELECT item FROM voted WHERE a IS NOT NULL AND b IS NOT NULL AND a != b")
def j18_disputed_items(t):
    return V.disputed_items(latest(t).withColumn("part", F.lit(1)), "item", "part", "model", "label", "m0", "m1")


@query(f"""WITH {LOG_SQL}, {LATEST_SQL}, {VOTE_SQL} SELECT v.item, v.final, coalesce(min(seq) FILTER (l.label = v.final AND l.model = (SELECT min(model) FROM latest x WHERE x.item = v.item AND x.label = v.final)), min_by(seq, l.model)) AS reason_seq
FROM voted v JOIN latest l ON l.item = v.item GROUP BY ALL""")
def j19_answer_by_label(t):
    answers = latest(t).groupBy("item").agg(F.array_sort(F.collect_list(F.struct("model", "label", "seq"))).alias("answers"))
    return voted(t).join(answers, "item").select("item", "final", V.answer_by_label(F.col("answers"), F.col("final"))["seq"].alias("reason_seq"))


@query(f"""WITH {LOG_SQL}, {ITEMS_SQL}, asked AS (SELECT item, model, max_by(content, seq) FILTER (event_type != 'error') AS c, bool_or(event_type != 'error') AS u FROM log GROUP BY ALL),
todo AS (SELECT m.model, count(*) FILTER (u IS NULL OR NOT u OR c != i.content) AS n FROM items i CROSS JOIN (SELECT DISTINCT model FROM log) m LEFT JOIN asked a ON a.item = i.item AND a.model = m.model GROUP BY 1),
r AS (SELECT model, count(*)::BIGINT AS calls, count(*) FILTER (event_type = 'error')::BIGINT AS failures, round(sum(cost), 2) AS total_cost, avg(cost) AS mean_cost, round(avg(k), 6) AS mean_seconds FROM log GROUP BY model)
SELECT model, calls, failures, total_cost, round(mean_cost, 6) AS mean_cost, mean_seconds, n::BIGINT AS to_do, round(mean_cost * n, 4) AS planned_cost FROM r JOIN todo USING (model)""")
def a18_cost_report(t):
    """What the calls of each model cost, and what the tasks that are still to be asked will."""
    report = A.planned_cost(A.cost_report(log(t), "model", ok(), "cost", "k"), _tasks(t), "model")
    return report.select("model", "calls", "failures", F.round("total_cost", 2).alias("total_cost"), F.round("mean_cost", 6).alias("mean_cost"), F.round("mean_seconds", 6).alias("mean_seconds"), "to_do", F.round("planned_cost", 4).alias("planned_cost"))


@query(f"""WITH {LOG_SQL}, p AS (SELECT DISTINCT seq, model, 'check ' || x AS c FROM (SELECT seq, model, unnest([k % 5, k % 7, k % 5]) AS x FROM log))
SELECT c AS check_name, count(*) FILTER (model = 'm0')::BIGINT AS m0, count(*) FILTER (model = 'm1')::BIGINT AS m1, count(*) FILTER (model = 'm2')::BIGINT AS m2 FROM p GROUP BY c""")
def a19_failed_checks(t):
    made = lambda n: F.concat(F.lit("check "), (F.col("k") % n).cast("string"), F.lit(" (D"), F.col("item").cast("string"), F.lit("): detail "), F.col("k").cast("string"))
    return A.failed_checks(log(t).withColumn("problems", F.array(made(5), made(7), made(5))), "problems", "model", ["m0", "m1", "m2"])


@query(f"""WITH {LOG_SQL}, {LATEST_SQL}, {VOTE_SQL}, x AS (SELECT CASE WHEN c IS NULL THEN 'not asked' WHEN c = a AND c = b THEN 'both' WHEN c = a THEN 'first' WHEN c = b THEN 'second' ELSE 'neither' END AS verdict, how FROM voted)
SELECT verdict, count(*) FILTER (how = 'agreed')::BIGINT AS agreed, count(*) FILTER (how = 'undecided')::BIGINT AS undecided, count(*) FILTER (how = 'third decides')::BIGINT AS "third decides",
count(*) FILTER (how IN ('agreed', 'undecided', 'third decides'))::BIGINT AS total FROM x GROUP BY verdict""")
def a20_verdict_matrix(t):
    rows = voted(t).withColumn("verdict", F.coalesce(V.verdict_of(F.col("c"), F.col("a"), F.col("b")), F.lit("neither")))
    return V.verdict_matrix(rows, "verdict", "how", ["agreed", "undecided", "third decides"])


@query(f"""WITH {LOG_SQL}, g AS (SELECT item, k % 10 AS key, count(*) AS n, min(seq) AS first, min_by(content, seq) AS value FROM log GROUP BY ALL)
SELECT item, value, n::BIGINT AS votes FROM g WHERE n >= 2 QUALIFY row_number() OVER (PARTITION BY item ORDER BY n DESC, first) = 1""")
def a24_formula_vote(t):
    return V.formula_vote(log(t).select("item", (F.col("k") % 10).alias("key"), F.col("content").alias("value"), "seq"), "item", "key", "value", "seq")


@query(f"WITH {LOG_SQL}, g AS (SELECT item, event_type, count(*) AS n, min(seq) AS first FROM log GROUP BY ALL) SELECT item, event_type, n::BIGINT AS votes FROM g QUALIFY row_number() OVER (PARTITION BY item ORDER BY n DESC, first) = 1")
def a25_domain_vote(t):
    return V.majority_value(log(t).select("item", "event_type", "seq"), "item", "event_type", "seq")


@query(f"""WITH {LOG_SQL}, f AS (SELECT item, event_type AS symbol, min_by(k, seq) AS meaning FROM log GROUP BY ALL)
SELECT item, string_agg(symbol || '=' || meaning, ',' ORDER BY symbol) AS meanings FROM f GROUP BY item""")
def a26_first_meaning(t):
    rows = log(t).select("item", "seq", F.create_map("event_type", F.col("k").cast("string")).alias("meanings"))
    merged = V.first_meaning(rows, "item", "meanings", "seq")
    return merged.select("item", F.array_join(F.transform(F.array_sort(F.map_entries("meanings")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("meanings"))


@query(f"""WITH {LOG_SQL}, {LATEST_SQL}, {VOTE_SQL} SELECT item % 5 AS set, count(final)::BIGINT AS judged, round(avg((final = 'correct')::INT), 9) AS share_correct, round(avg((final = 'ambiguous')::INT), 9) AS share_ambiguous FROM voted WHERE final IS NOT NULL GROUP BY ALL""")
def a13_label_distribution(t):
    rows = P.distribution(voted(t).withColumn("set", F.col("item") % 5), "set", "final", ["correct", "ambiguous"])
    return rows.select("set", "judged", F.round("share_correct", 9).alias("share_correct"), F.round("share_ambiguous", 9).alias("share_ambiguous"))


@query("""SELECT coalesce(event_type, 'all') AS event_type, count(*) FILTER (user_id % 3 = 0)::BIGINT AS "0", count(*) FILTER (user_id % 3 = 1)::BIGINT AS "1", count(*) FILTER (user_id % 3 = 2)::BIGINT AS "2", count(*)::BIGINT AS total FROM events GROUP BY ROLLUP (event_type)""")
def a33_label_by_method(t):
    return P.with_all_row(t.events.select("event_type", (F.col("user_id") % 3).alias("x")), "event_type", "x", [0, 1, 2])


@query("SELECT event_type AS rule, count(*)::BIGINT AS n FROM events WHERE user_id % 2 = 0 GROUP BY event_type")
def a14_rejection_report(t):
    reasons = F.when(F.col("user_id") % 2 == 0, F.array(F.concat(F.col("event_type"), F.lit(": "), F.col("props")), F.lit("other: x"))).otherwise(F.array().cast("array<string>"))
    return P.rule_counts(t.events.select(reasons.alias("reasons")), "reasons")


@query("SELECT (props->>'$.k') AS detail, count(*)::BIGINT AS n, count(*) FILTER (contains(props, '9'))::BIGINT AS with_text FROM events WHERE event_type = 'error' GROUP BY ALL")
def a15_unknown_command_report(t):
    reason = F.concat(F.lit("unknown command: "), F.get_json_object("props", "$.k"))
    rows = t.events.where("event_type = 'error'").select(F.regexp_extract(reason, r"^unknown command: (.*)$", 1).alias("detail"), "props")
    return rows.groupBy("detail").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.contains("props", F.lit("9"))).alias("with_text"))


@query("""WITH u AS (SELECT user_id, list_distinct(list(event_type) FILTER (value > 50)) AS rules FROM events GROUP BY user_id)
SELECT r AS rule, count(*)::BIGINT AS n, (SELECT count(*) FROM u WHERE list_has_any(rules, ['click', 'purchase', 'signup']))::BIGINT AS rows_using FROM (SELECT unnest(rules) AS r FROM u) WHERE r IN ('click', 'purchase', 'signup') GROUP BY r""")
def a16_extension_report(t):
    rules = t.events.where("value > 50").groupBy("user_id").agg(F.collect_set("event_type").alias("rules"))
    some = F.array(*(F.lit(x) for x in ("click", "purchase", "signup")))
    using = rules.agg(F.count_if(F.arrays_overlap("rules", some)).alias("rows_using"))
    return P.exploded_counts(rules.withColumn("rules", F.array_intersect("rules", some)), "rules", "rule").crossJoin(using)


@query("""SELECT lang, count(*)::BIGINT AS n_all, count(*) FILTER (contains(text, '|'))::BIGINT AS n_table, count(*) FILTER (contains(text, '%%%'))::BIGINT AS n_junk, count(*) FILTER (contains(text, 'License'))::BIGINT AS n_license FROM documents GROUP BY lang""")
def a17_description_report(t):
    subsets = {"n_table": F.contains("text", F.lit("|")), "n_junk": F.contains("text", F.lit("%%%")), "n_license": F.contains("text", F.lit("License"))}
    return P.conditional_counts(t.documents.select("lang", "text"), "lang", subsets)


AGREE_SQL = "CASE WHEN {0} IS NULL OR {1} IS NULL THEN 'not answered' WHEN {0} IN ('wrong', 'no') AND {1} IN ('wrong', 'no') THEN 'both none' WHEN {0} IN ('wrong', 'no') OR {1} IN ('wrong', 'no') THEN 'one gives none' WHEN {0} = {1} THEN 'same passages' ELSE 'partly the same' END"


@query(f"""WITH {LOG_SQL}, {LATEST_SQL}, {VOTE_SQL}, g AS (SELECT *, {AGREE_SQL.format('a', 'b')} AS ab, {AGREE_SQL.format('c', 'a')} AS ca, {AGREE_SQL.format('c', 'b')} AS cb FROM voted),
v AS (SELECT CASE WHEN ab = 'not answered' THEN NULL WHEN ab = 'one gives none' THEN 'requirement' WHEN a != b THEN 'kind' END AS dispute,
CASE WHEN c IS NULL THEN 'not asked' WHEN ca IN ('same passages', 'both none') AND cb IN ('same passages', 'both none') THEN 'agrees with both' WHEN ca IN ('same passages', 'both none') THEN 'sides with the first' WHEN cb IN ('same passages', 'both none') THEN 'sides with the second'
  WHEN ca = 'partly the same' OR cb = 'partly the same' THEN 'partly agrees' ELSE 'agrees with neither' END AS verdict FROM g) SELECT dispute, verdict, count(*)::BIGINT AS n FROM v GROUP BY ALL""")
def a22_dispute_and_verdict(t):
    """What two answers differ in, and whom the third one supports, by how far each two agree."""
    none = lambda c: F.col(c).isin("wrong", "no")

    def agreement(x: str, y: str):
        state = F.when(F.col(x).isNull() | F.col(y).isNull(), "not answered").when(none(x) & none(y), "both none").when(none(x) | none(y), "one gives none")
        return state.when(F.col(x) == F.col(y), "same passages").otherwise("partly the same")

    ab = agreement("a", "b")
    dispute = F.when(ab != "not answered", V.dispute_of(ab, F.col("a"), F.col("b"), F.lit(1), F.lit(1)))
    verdict = F.when(F.col("c").isNull(), "not asked").otherwise(T.verdict_by_agreement(agreement("c", "a"), agreement("c", "b")))
    return voted(t).groupBy(dispute.alias("dispute"), verdict.alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH e AS (SELECT event_id, event_id % 4 AS k, event_type, 'p' || user_id AS p FROM events)
SELECT event_id, event_type || '|' || p AS texts FROM e""")
def f14_answer_passages(t):
    """Passages of answers: one that says there is none, a blank one and one that is given twice (spaces aside) don't count."""
    e, k = F.col("event_type"), F.col("event_id") % 4
    odd = F.when(k == 0, " None ").when(k == 1, "null").when(k == 2, F.concat(F.left(e, F.lit(2)), F.lit(" "), F.substring(e, 3, 100))).otherwise("")
    given = F.array(*(F.struct(x.alias("text"), F.lit("generic").alias("kind")) for x in (e, odd, F.concat(F.lit("p"), F.col("user_id").cast("string")))))
    return t.events.select("event_id", F.array_join(F.transform(T.given_passages(given), lambda p: p["text"]), "|").alias("texts"))


@query("""WITH e AS (SELECT user_id AS region, (event_id % 40) AS id, event_id AS pos FROM events WHERE event_type = 'view'), q AS (SELECT DISTINCT user_id AS region, (event_id % 40) AS id FROM events WHERE event_type IN ('view', 'click') AND event_id % 2 = 0),
g AS (SELECT e.*, row_number() OVER (PARTITION BY e.region, e.id ORDER BY pos) AS r, q.id IS NOT NULL AS known FROM e LEFT JOIN q ON q.region = e.region AND q.id = e.id)
SELECT region, id, pos, CASE WHEN NOT known THEN 'unknown id' WHEN r > 1 THEN 'answered twice' ELSE 'ok' END AS state FROM g
UNION ALL SELECT region, id, NULL, 'unanswered' FROM q WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.region = q.region AND e.id = q.id)""")
def f14_check_answer_entries(t):
    base = t.events.select(F.col("user_id").alias("region"), (F.col("event_id") % 40).alias("id"), F.col("event_id").alias("pos"), "event_type")
    return A.check_entries(base.where("event_type = 'view'").drop("event_type"), base.where("event_type IN ('view', 'click') AND pos % 2 = 0"), "region", "id", "pos")


@query("SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS joined, substr(sha256(string_agg(text, chr(10) ORDER BY turn)), 1, 16) AS key FROM conversations GROUP BY conv_id")
def a37_judge_items(t):
    return R.items_of(t.conversations, ["conv_id"], "turn", "text").select("conv_id", F.array_join("texts", "\n").alias("joined"), "key")


@query("""SELECT u.conv_id, count(*)::BIGINT AS n, string_agg(DISTINCT split_part(a.text, ' ', 1), '|' ORDER BY split_part(a.text, ' ', 1)) AS starts FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.text != u.text WHERE u.role = 'user' GROUP BY u.conv_id""")
def j17_paraphrase_items(t):
    c = t.conversations
    answers = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    both = c.where("role = 'user'").join(answers, ["conv_id", "turn"]).where("text != answer")
    return both.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set(F.substring_index("answer", " ", 1))), "|").alias("starts"))


@query(f"""WITH {TURNS_SQL}, r AS (SELECT *, CASE WHEN length(b) % 5 = 0 THEN a WHEN length(b) % 7 = 0 THEN a ELSE b END AS t FROM turns),
w AS (SELECT *, list_transform(regexp_extract_all(a, '[A-Za-z0-9_\\x27\\-*@]+'), lambda x: lower(x)) AS wa, list_transform(regexp_extract_all(t, '[A-Za-z0-9_\\x27\\-*@]+'), lambda x: lower(x)) AS wt, list_transform(regexp_extract_all(a, '\\d+(?:\\.\\d+)?|[A-Za-z_][A-Za-z0-9_\\x27]*'), lambda x: lower(x)) AS sa, list_transform(regexp_extract_all(t, '\\d+(?:\\.\\d+)?|[A-Za-z_][A-Za-z0-9_\\x27]*'), lambda x: lower(x)) AS st FROM r),
f AS (SELECT *, list_distinct(list_filter(wa, lambda w: list_contains({_words(T.KEYWORDS)}, w) OR w IN ('the', 'de', 'of', 'g', 'u') OR length(w) = 1 OR regexp_matches(w, '[_0-9]'))) AS frozen FROM w)
SELECT conv_id, turn, CASE WHEN t = a THEN 'unchanged' WHEN length(b) % 3 != 0 THEN CASE WHEN length(b) % 2 = 0 THEN 'correct' ELSE 'wrong' END END AS label, len(list_filter(frozen, lambda w: len(list_filter(wt, lambda x: x = w)) < len(list_filter(wa, lambda x: x = w))))::BIGINT AS lost,
len(list_distinct(list_filter(sa, lambda w: (regexp_matches(w, '[_0-9]') OR w IN ('the', 'de', 'of')) AND NOT list_contains(st, w))))::BIGINT AS missing FROM f""")
def j20_label_paraphrases(t):
    """Next turns as rewritings of turns: their label by the vote on the text, the words and symbols that they lost."""
    n = F.char_length("b")
    both = turns(t)
    rows = both.withColumns({"text": F.when(n % 5 == 0, F.lit(None)).when(n % 7 == 0, F.col("a")).otherwise(F.col("b")), "original": F.col("a")})
    votes = both.where(n % 3 != 0).select("conv_id", "turn", F.col("b").alias("text"), F.when(n % 2 == 0, "correct").otherwise("wrong").alias("label"))
    found = R.label_rewritings(rows, votes, ["conv_id", "turn"], "text", "original", "label")
    formula, text = F.lit("G[0,1] (the > de) U of"), F.coalesce("text", "original")
    found = found.withColumns({"_text": text, "_frozen": T.frozen_words(F.col("original"), formula)})
    lost = T.lost_words(F.col("original"), F.col("_text"), F.col("_frozen"))
    return found.select("conv_id", "turn", "label", F.size(lost).cast("long").alias("lost"), F.size(T.missing_symbols(F.col("original"), F.col("_text"), formula)).cast("long").alias("missing"))


@query(f"""WITH {LOG_SQL}, s AS (SELECT item, seq, substr(sha256(content), 1, 16) AS key, 'p/' || event_type || CASE WHEN seq % 2 = 0 THEN ':high' ELSE '' END AS name FROM log)
SELECT seq, key, substr(sha256('{{"p0":"' || name || '","p1":' || seq || ',"p2":["a","' || item || '"]}}'), 1, 16) AS item_key, CASE WHEN contains(name, ':') THEN split_part(name, ':', 1) ELSE name END AS model, CASE WHEN contains(name, ':') THEN split_part(name, ':', 2) ELSE 'off' END AS level FROM s""")
def f18_f22_keys_and_labels(t):
    name = F.concat(F.lit("p/"), F.col("event_type"), F.when(F.col("seq") % 2 == 0, ":high").otherwise(""))
    model, level = T.split_model_label(name)
    return log(t).select("seq", T.content_key_text(F.col("content")).alias("key"), T.content_key(name, F.col("seq"), F.array(F.lit("a"), F.col("item").cast("string"))).alias("item_key"), model.alias("model"), level.alias("level"))
