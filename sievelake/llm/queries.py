"""The registered queries of the training-data operators: op<N>_<name> over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, conversations, cotraining, language, licenses, warc
from .common import materialize
from .decontaminate import matches
from .fingerprints import edited
from .html import extract
from .jaccard import similarity_components
from .mixing import mix_sources
from .sharding import assign_shards
from .substrings import remove_repeats

SHARD_BYTES = 1 << 20


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's places in the mixture (source weights: characters^0.8)."""
    # the text is reduced to its length before anything is shuffled
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", F.char_length("text").alias("chars"))
    return mix_sources(docs, length="chars")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 13-word windows that a smaller document holds."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, width=13, with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256", F.size("removed").cast("long").alias("n_intervals"))


OP2_SQL = """
WITH w AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS words FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(list_slice(words, i, i + 12), ' ') AS seq
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13)),
least AS (SELECT seq, min(doc_id) AS d FROM win GROUP BY seq),
gone AS (
  SELECT DISTINCT doc_id, j FROM (
    SELECT win.doc_id, unnest(range(i, i + 13)) AS j FROM win JOIN least USING (seq) WHERE least.d < win.doc_id)),
each AS (SELECT doc_id, words, CASE WHEN len(words) > 0 THEN unnest(range(1, len(words) + 1)) END AS j FROM w WHERE len(words) > 0),
kept AS (
  SELECT e.doc_id, string_agg(CASE WHEN g.j IS NULL THEN e.words[e.j] END, ' ' ORDER BY e.j) AS kept,
         count(g.j)::BIGINT AS n_removed,
         count(*) FILTER (WHERE g.j IS NOT NULL AND NOT EXISTS (SELECT 1 FROM gone p WHERE p.doc_id = e.doc_id AND p.j = e.j - 1))::BIGINT AS n_intervals
  FROM each e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.j = e.j GROUP BY e.doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256, coalesce(n_intervals, 0)::BIGINT AS n_intervals
FROM w LEFT JOIN kept USING (doc_id)
"""


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from the documents that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(~language.held_out()))
    found = language.classify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op4_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of at most 1 MiB of text."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return assign_shards(docs, limit_bytes=SHARD_BYTES).select("doc_id", "n_bytes", "shard", "depth", "shard_bytes", "shard_rows")


OP4_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
p AS (SELECT d.*, k::BIGINT AS depth, h >> (60 - k)::BIGINT AS prefix FROM d, range(0, 61) t(k)),
s AS (SELECT depth, prefix, sum(n_bytes)::BIGINT AS shard_bytes, count(*)::BIGINT AS shard_rows FROM p GROUP BY ALL),
f AS (SELECT * FROM s WHERE shard_bytes <= {SHARD_BYTES} OR shard_rows <= 1),
j AS (SELECT p.doc_id, p.n_bytes, p.depth, p.prefix, f.shard_bytes, f.shard_rows,
             row_number() OVER (PARTITION BY p.doc_id ORDER BY p.depth) AS r
      FROM p JOIN f ON p.depth = f.depth AND p.prefix = f.prefix)
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth::INT, '0') END AS shard, depth, shard_bytes, shard_rows
FROM j WHERE r = 1
"""

def op5_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op6_exact_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's canonical fingerprint, and that of its edited text."""
    return edited(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, read back from the archives."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    archives = materialize(warc.write_archives(pages, least_revisit_bytes=0), "warc")
    return warc.read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


OP7_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS top FROM p)
SELECT page_id, payload_bytes,
  array_to_string(flatten(list_transform(range(0, 8), lambda i: list_transform([15, 10, 5, 0], lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((('0x' || substr(hex, 5 * i + 1, 5))::BIGINT >> k) & 31))::INT, 1)))), '') AS payload_digest,
  CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < top THEN top END AS refers_to, true AS digest_ok
FROM g
"""

def op8_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score; labels of held-out documents are not used."""
    labels = _table(spark, sf_dir, "labels").where(~language.held_out()).select("doc_id", "quality")
    found = cotraining.classify(_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"), labels)
    return found.withColumn("held_out", language.held_out())


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component under links of 3-word shingle sets with a Jaccard similarity of 0.9 or more."""
    return similarity_components(_table(spark, sf_dir, "documents").select("doc_id", "text"), width=3, percent=90)


OP9_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 3 THEN array_to_string(words, ' ') ELSE array_to_string(list_slice(words, i, i + 2), ' ') END AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*)::BIGINT AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b USING (shingle) GROUP BY ALL),
link AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * shared >= 90 * (p.n + q.n - shared)),
reach(x, y) AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(min(r.y), w.doc_id)::BIGINT AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN reach r ON r.x = w.doc_id GROUP BY w.doc_id, n.n
"""


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) where the document holds the item with edits of at most a tenth of its length."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return matches(docs, _table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op11_align_tokenizers(spark: SparkSession, sf_dir: str, folder: str = "/opt/tokenizers") -> DataFrame:
    """Every document's groups and links of two public tokenizers."""
    found = alignment.align(_table(spark, sf_dir, "documents").select("doc_id", "text"), f"{folder}/byte_bpe_50k.json", f"{folder}/piece_bpe_32k.model")
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's planted faults and its cheapest repair."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversations.all_conversations(rows, conversations.repair(conversations.damage(rows)))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's licence phrases and the licences whose texts or notices it holds."""
    found = licenses.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    labels = [F.array_join(c, ",").alias(c) for c in ("base_labels", "labels")]
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", *labels, "score")


QUERIES = {"op1_mix_sources": op1_mix_sources, "op2_substring_dedup": op2_substring_dedup, "op3_language_id": op3_language_id, "op4_extendible_shards": op4_extendible_shards, "op5_html_main_text": op5_html_main_text, "op6_exact_fingerprint": op6_exact_fingerprint, "op7_warc_roundtrip": op7_warc_roundtrip, "op8_quality_cotraining": op8_quality_cotraining, "op9_jaccard_join": op9_jaccard_join, "op10_decontamination": op10_decontamination, "op11_align_tokenizers": op11_align_tokenizers, "op12_repair_conversations": op12_repair_conversations, "op13_license_scan": op13_license_scan}

ORACLES = {"op2_substring_dedup": OP2_SQL, "op4_extendible_shards": OP4_SQL, "op7_warc_roundtrip": OP7_SQL, "op9_jaccard_join": OP9_SQL}
