"""A catalogue of papers: incoming records are merged with those they belong to, or added, and duplicates are joined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_title
from ..scratch import materialize
from ..sources.buckets import BucketStore
from .graph import connected
from .records import merged_lookups, ordered_union

SCHEMA = (
    "paper_id string, arxiv_id string, doi string, title string, alternate_ids array<string>, alternate_dois array<string>, cited_by long, is_oa boolean, methods array<string>, hop int, parent_ids array<string>, pdf_mirrors array<string>, "
    "lookups map<string,string>, status string"
)
#: Keys by strength; a weaker one counts only where no stronger one leads anywhere.
KEYS = ["id", "alias", "arxiv", "doi", "title"]
LEAST_TITLE = 16
#: Downloads from the worst to the best; an unknown state counts as pending.
STATES = ["unavailable", "pending", "downloaded_pdf", "downloaded_latex"]


def keys_of(papers: DataFrame, known: bool) -> DataFrame:
    """(paper, rank, key): what a record can be found by. An incoming record asks for its id as an alias of a known one, too."""
    arrays = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    aliases = arrays(F.col("alternate_ids")) if known else F.array("paper_id")
    dois = F.concat(F.array("doi"), arrays(F.col("alternate_dois"))) if known else F.array("doi")
    title = normalize_title(F.col("title"))
    lists = [F.array("paper_id"), aliases, F.array("arxiv_id"), F.transform(dois, F.lower), F.array(F.when(F.char_length(title) >= LEAST_TITLE, title))]
    by_rank = papers.select("paper", F.posexplode(F.array(*lists)).alias("rank", "_keys"))
    each = by_rank.select("paper", "rank", F.explode("_keys").alias("key"))
    return each.where("key is not null and key != ''").distinct()


def _links(known: DataFrame, new: DataFrame) -> DataFrame:
    """(a, b, matched_by): each new record with what it belongs to, by its strongest key; and known records that turn out to be one.

    A new record belongs to a known one, else to an earlier new one. Where it brings an arXiv id to a known record without
    one (the first such), and another known record owns that id, the two are one work. New records of one id are one.
    """
    have, ask = keys_of(known, True), keys_of(new, False)
    owners = materialize(have.groupBy("rank", "key").agg(F.min("paper").alias("owner")), "owners")
    found = ask.join(owners, ["rank", "key"]).groupBy("paper").agg(F.min(F.struct("rank", "owner")).alias("m")).select("paper", "m.*")
    found = materialize(found, "matched")
    lacking = known.where("arxiv_id is null").select(F.col("paper").alias("owner"))
    brings = found.where("rank != 2").join(lacking, "owner").join(new.where("arxiv_id != ''").select("paper", F.col("arxiv_id").alias("key")), "paper")
    brings = materialize(brings.groupBy("owner").agg(F.min(F.struct("paper", "key")).alias("m")).select("owner", "m.*"), "brings")
    same = brings.join(owners.where("rank = 2").select("key", F.col("owner").alias("other")), "key").where("owner != other").select(F.col("owner").alias("a"), F.col("other").alias("b"), F.lit("arxiv").alias("matched_by"))
    # new records among themselves: the earliest holder of the strongest key that an earlier one holds
    alone = new.join(found, "paper", "left_anti").select("paper")
    held = ask.where("rank != 1").join(alone, "paper", "left_semi").unionByName(brings.select("paper", F.lit(2).alias("rank"), "key"))
    leaders = materialize(held.groupBy("rank", "key").agg(F.min("paper").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1"), "leaders")
    twins = new.groupBy("paper_id").agg(F.min("paper").alias("b")).join(new.select("paper_id", F.col("paper").alias("a")), "paper_id").where("a != b").select("a", "b", F.lit("id").alias("matched_by"))
    led = ask.join(alone, "paper", "left_semi").join(leaders, ["rank", "key"]).where("leader < paper").groupBy("paper").agg(F.min(F.struct("rank", "leader")).alias("m"))
    names = F.array(*(F.lit(k) for k in KEYS))
    by = lambda c: F.get(names, c).alias("matched_by")
    return found.select(F.col("paper").alias("a"), F.col("owner").alias("b"), by(F.col("rank"))).unionByName(led.select(F.col("paper").alias("a"), F.col("m.leader").alias("b"), by(F.col("m.rank")))).unionByName(same).unionByName(twins)


def merge_records(rows: DataFrame, group: str) -> DataFrame:
    """One record per group of catalogue rows. ``_new`` marks incoming rows, ``paper`` orders the rows of each kind.

    The record of the best known row is kept: one with a catalogue id, a published DOI, the most citations, the last id; of
    new rows alone the first. Lists are joined, counts are maxima, an answered lookup beats one without an answer, and the best
    download wins. Ids of rows that go become alternate ids, by which the same row is found again; other DOIs of known rows alternate ones.
    """
    preprint = F.coalesce(F.contains(F.lower("doi"), F.lit("10.48550/arxiv")), F.lit(False))
    # of known rows the largest by preference, of new rows the first
    better = F.struct((~F.col("_new")).alias("k"), F.when(~F.col("_new"), F.startswith("paper_id", F.lit("W"))).alias("w"), F.when(~F.col("_new"), F.coalesce(F.col("doi") != "", F.lit(False)) & ~preprint).alias("d"), F.when(~F.col("_new"), F.coalesce("cited_by", F.lit(0))).alias("c"))
    kept = rows.groupBy(group).agg(F.max(better).alias("_b"), F.count_if(~F.col("_new")).alias("_n"))
    rows = rows.join(kept, group).withColumn("_top", better.eqNullSafe(F.col("_b")))
    chosen = rows.where("_top").groupBy(group).agg(F.when(F.max("_n") > 0, F.max("paper_id")).otherwise(F.min_by("paper_id", "paper")).alias("_kept"), F.when(F.max("_n") > 0, F.max_by("paper", "paper_id")).otherwise(F.min("paper")).alias("_row"))
    # the kept row first, then known ones by id, then new ones
    rows = rows.drop("_b", "_n", "_top").join(chosen, group).withColumn("_place", F.struct((F.col("paper") != F.col("_row")).alias("o"), F.col("_new").alias("n"), F.col("paper").alias("p")))
    rows = materialize(rows, "records")
    first = lambda c, when=None: F.min_by(c, F.when(F.col(c).isNotNull() & (F.lit(True) if when is None else when), F.col("_place"))).alias(c)
    known = ~F.col("_new") | (F.col("paper") == F.col("_row"))
    state = F.coalesce(*(F.when(F.col("status") == s, F.lit(i)) for i, s in enumerate(STATES)), F.lit(1))
    out = rows.groupBy(group, F.col("_kept").alias("paper_id")).agg(
        first("arxiv_id"), first("doi", known), first("title", known), F.max("cited_by").alias("cited_by"), F.bool_or("is_oa").alias("is_oa"), F.min("hop").alias("hop"), F.max(F.when(known, state)).alias("_state"),
    )
    out = out.withColumn("status", F.get(F.array(*(F.lit(s) for s in STATES)), F.col("_state"))).drop("_state")
    none = F.array().cast("array<string>")
    gone = F.when(F.col("paper_id") != F.col("_kept"), F.array("paper_id")).otherwise(none)
    lists = {
        "alternate_ids": F.concat(F.when(known, F.coalesce("alternate_ids", none)).otherwise(none), gone), "alternate_dois": F.when(known, F.concat(F.coalesce("alternate_dois", none), F.array("doi"))), "parent_ids": F.col("parent_ids"), "pdf_mirrors": F.col("pdf_mirrors"),
    }
    for name, values in lists.items():
        each = rows.select(group, F.explode(values).alias("_v")).where("_v is not null").groupBy(group).agg(F.array_sort(F.collect_set("_v")).alias(name))
        out = out.join(each, group, "left").withColumn(name, F.coalesce(name, none))
    out = out.withColumn("alternate_dois", F.filter("alternate_dois", lambda d: F.lower(d) != F.lower(F.coalesce("doi", F.lit("")))))
    out = out.withColumn("parent_ids", F.filter("parent_ids", lambda p: (p != F.col("paper_id")) & ~F.array_contains("alternate_ids", p)))
    out = out.join(ordered_union(rows, group, "methods", "_place"), group, "left").withColumn("methods", F.coalesce("methods", none))
    return out.join(merged_lookups(rows, group, "lookups", "_place"), group, "left")


def upsert(store: BucketStore, incoming: DataFrame) -> dict[str, int]:
    """Merge incoming records into a stored catalogue, or add them; returns how many were matched and added, and the buckets written.

    ``incoming`` has the columns of ``SCHEMA`` and ``seq``, a unique number that says which record came first. Records are
    found by id, alternate id, arXiv id, DOI (case aside) or title (16 letters or more), the strongest key that leads anywhere. Where several known records share
    a key it leads to the smallest id. Parents that name a record that went follow it to the one it was merged with. Only touched
    buckets are written; the same records again change no row. Null and empty keys lead nowhere.
    """
    columns = [c.strip().split()[0] for c in SCHEMA.replace("map<string,string>", "map").split(", ")]
    known = materialize(store.read().select(F.concat(F.lit("0:"), "paper_id").alias("paper"), *columns).withColumn("_new", F.lit(False)), "known")
    # names that sort as their numbers do, behind the known ones
    new = materialize(incoming.select(F.concat(F.lit("1:"), F.lpad(F.col("seq").cast("string"), 20, "0")).alias("paper"), *columns).withColumn("_new", F.lit(True)), "incoming")
    links = materialize(_links(known, new), "links")
    labels = connected(links, "a", "b")
    both = known.join(labels.select(F.col("node").alias("paper"), "component"), "paper").unionByName(new.join(labels.select(F.col("node").alias("paper"), "component"), "paper", "left").withColumn("component", F.coalesce("component", "paper")))
    merged = materialize(merge_records(both, "component"), "merged")
    dropped = merged.join(both.where("not _new").select("component", F.col("paper_id").alias("old")), "component").where("old != paper_id").select(F.col("old"), F.col("paper_id").alias("kept"))
    dropped = materialize(dropped, "dropped")
    # records that stay but name one that went as their parent
    rest = known.drop("paper", "_new").join(both.where("not _new").select("paper_id"), "paper_id", "left_anti").unionByName(merged.select(*columns))
    moved = rest.select("paper_id", F.explode("parent_ids").alias("old")).join(dropped, "old").groupBy("paper_id").agg(F.collect_list(F.struct("old", "kept")).alias("_moves"))
    touched = merged.select(*columns).unionByName(known.select(*columns).join(moved.select("paper_id"), "paper_id", "left_semi").join(both.where("not _new").select("paper_id"), "paper_id", "left_anti"))
    touched = touched.join(moved, "paper_id", "left")
    follow = lambda p: F.coalesce(F.get(F.filter("_moves", lambda m: m["old"] == p), F.lit(0))["kept"], p)
    parents = F.array_sort(F.array_distinct(F.filter(F.transform("parent_ids", follow), lambda p: p != F.col("paper_id"))))
    touched = touched.withColumn("parent_ids", F.when(F.col("_moves").isNotNull(), parents).otherwise(F.col("parent_ids"))).drop("_moves")
    # what is the same as before is not written
    changed = materialize(touched.join(known.select(*columns, F.lit(True).alias("_same")), [F.to_json(F.struct(*(touched[c] for c in columns))) == F.to_json(F.struct(*(known[c] for c in columns)))], "left_anti"), "changed")
    written = store.change(changed, dropped.select(F.col("old").alias("paper_id")))
    n = new.count()
    added = merged.join(known.select("paper_id"), "paper_id", "left_anti").count()
    return {"incoming": n, "added": added, "changed": changed.count(), "buckets": len(written)}
