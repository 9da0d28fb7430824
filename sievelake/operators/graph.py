"""Catalogue records: keys, merging, citation expansion, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize


def _roots(hook: DataFrame) -> DataFrame:
    """Hooks (component, to) followed to their ends; what is followed doubles with each turn."""
    while True:
        ahead = hook.select(F.col("component").alias("to"), F.col("to").alias("_next"))
        if not hook.join(ahead, "to", "left_semi").limit(1).count():
            return hook
        twice = hook.join(ahead, "to", "left").select("component", F.coalesce("_next", "to").alias("to"))
        hook = materialize(twice, "hook")


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node that edges lead to; a hub costs one aggregated row per round.

    In each round every component hooks to its smallest neighbour if that is smaller, and hooks are followed to their
    ends. What is left are components without a smaller neighbour, half of them at most, so the rounds, and the turns of
    following in each, are few for long chains too. Edges with a null end connect nothing.
    """
    edges = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a is not null and b is not null and a != b").distinct()
    edges = materialize(edges, "edges")
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node"))
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = materialize(both.groupBy(F.col("a").alias("component")).agg(F.min("b").alias("to")).where("to < component"), "hook")
        hook = _roots(hook)
        labels = materialize(labels.join(hook, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "labels")
        for side in ("a", "b"):
            edges = edges.join(hook.select(F.col("component").alias(side), F.col("to").alias("_to")), side, "left").withColumn(side, F.coalesce("_to", side)).drop("_to")
        edges = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct(), "edges")
    return labels


def merge_groups(keys: DataFrame, id: str, key: str) -> DataFrame:
    """(id, component) of records that share a key, transitively; null and empty keys connect nothing.

    Each key links its records to its smallest record, so a hub key of n records gives n - 1 edges.
    """
    real = keys.where(F.col(key).isNotNull() & (F.col(key).cast("string") != "")).select(id, key).distinct()
    least = materialize(real.groupBy(key).agg(F.min(id).alias("_least"), F.count(F.lit(1)).alias("_n")).where("_n > 1"), "keys")
    found = connected(real.join(least, key).select(id, "_least"), id, "_least")
    every = keys.select(id).distinct()
    return every.join(found, every[id] == found["node"], "left").select(id, F.coalesce("component", id).alias("component"))


def upsert_match(incoming: DataFrame, known: DataFrame, new: str, old: str, key_type: str, key: str, priority: list[str]) -> DataFrame:
    """(new, old, matched_by): the known record an incoming one belongs to by its strongest matching key type."""
    rank = F.coalesce(*(F.when(F.col(key_type) == t, F.lit(i)) for i, t in enumerate(priority)))
    known = known.groupBy(key_type, key).agg(F.min(old).alias(old))  # a key that many records share leads to the smallest
    both = incoming.select(new, key_type, key).join(known, [key_type, key]).withColumn("_rank", rank).where("_rank is not null")
    best = both.groupBy(new).agg(F.min_by(F.struct(old, key_type), F.struct("_rank", old)).alias("_m"))
    return incoming.select(new).distinct().join(best, new, "left").select(new, F.col(f"_m.{old}").alias(old), F.col(f"_m.{key_type}").alias("matched_by"))


def extend_components(labels: DataFrame, edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) that change or come in when edges are added to stored components; all other labels stay.

    Edges are lifted to the components of their ends, so the work grows with the new edges and the components they join, not
    with the graph. ``labels`` should be a written table. Edges with a null end connect nothing.
    """
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    ends = materialize(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "ends")
    found = materialize(ends.join(labels, "node", "left").select("node", "component"), "found")
    at = found.select("node", F.coalesce("component", "node").alias("top"))
    lifted = edges.join(at.withColumnsRenamed({"node": "a", "top": "x"}), "a").join(at.withColumnsRenamed({"node": "b", "top": "y"}), "b")
    moves = materialize(connected(lifted, "x", "y").where("node != component").select(F.col("node").alias("component"), F.col("component").alias("_to")), "moves")
    moved = labels.join(moves, "component").select("node", F.col("_to").alias("component"))
    fresh = found.where("component is null").select("node").join(moves.select(F.col("component").alias("node"), "_to"), "node", "left").select("node", F.coalesce("_to", "node").alias("component"))
    return moved.unionByName(fresh)


def remap_ids(df: DataFrame, id: str, parents: str, mapping: DataFrame, old: str, kept: str) -> DataFrame:
    """Parent lists follow merged ids; self references go; sorted and distinct."""
    each = df.select(id, F.explode(parents).alias("_p"))
    moved = each.join(mapping.select(F.col(old).alias("_p"), F.col(kept).alias("_k")), "_p", "left").withColumn("_p", F.coalesce("_k", "_p")).where(F.col("_p") != F.col(id))
    lists = moved.groupBy(id).agg(F.array_sort(F.collect_set("_p")).alias(parents))
    return df.drop(parents).join(lists, id, "left").withColumn(parents, F.coalesce(parents, F.array()))


def expand_hops(edges: DataFrame, seeds: DataFrame, source: str, target: str, cited_by: DataFrame, node: str, citations: str, least: int, hops: int = 2) -> DataFrame:
    """(node, hop, parents): hop 1 cites a seed; hop h cites a work of hop h - 1 with enough citations; the least hop counts."""
    frontier, reached = seeds.select(F.col(node).alias("node")).distinct(), None
    for hop in range(1, hops + 1):
        if hop > 1:
            frontier = reached.where(F.col("hop") == hop - 1).join(cited_by.where(F.col(citations) >= least).select(F.col(node).alias("node")), "node", "left_semi").select("node")
        found = edges.join(frontier.select(F.col("node").alias(target)), target).groupBy(F.col(source).alias("node")).agg(F.array_sort(F.collect_set(target)).alias("parents")).withColumn("hop", F.lit(hop))
        if reached is not None:
            found = reached.unionByName(found.join(reached.select("node"), "node", "left_anti"))
        reached = materialize(found.select("node", "hop", "parents"), f"hop{hop}")
    return reached


def merge_fields(df: DataFrame, component: str, sets: list[str], maxima: list[str], minima: list[str], flags: list[str], best: list[str], rank: Column) -> DataFrame:
    """Fields of merged records: distinct sorted unions, maxima, minima, any-of flags, and fields of the best-ranked copy."""
    out = [F.max(c).alias(c) for c in maxima] + [F.min(c).alias(c) for c in minima] + [F.bool_or(c).alias(c) for c in flags]
    merged = df.groupBy(component).agg(*out, F.max_by(F.struct(*best), rank).alias("_b"))
    for c in sets:  # of a component only the distinct values meet
        values = df.select(component, F.explode(c).alias("_v")).distinct().groupBy(component).agg(F.array_sort(F.collect_set("_v")).alias(c))
        merged = merged.join(values, component, "left").withColumn(c, F.coalesce(c, F.array()))
    return merged.select(component, *sets, *maxima, *minima, *flags, *(F.col(f"_b.{c}").alias(c) for c in best))


def apply_lookups(papers: DataFrame, answers: DataFrame, id: str, service: str, status: str, link: str, state: str) -> DataFrame:
    """Answers recorded as a map; a gained link turns an unavailable paper into a pending one."""
    got = answers.groupBy(id).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(service, status)))).alias("lookups"), F.min(link).alias("_link"))
    merged = papers.join(got, id, "left")
    gained = F.col(f"{link}_known").isNull() & F.col("_link").isNotNull()
    return merged.withColumns({link: F.coalesce(F.col(f"{link}_known"), F.col("_link")), state: F.when((F.col(state) == "unavailable") & gained, "pending").otherwise(F.col(state)), "gained": gained}).drop("_link", f"{link}_known")


def duplicates_by_owner(papers: DataFrame, id: str, link: str, gained: str, labels: DataFrame) -> DataFrame:
    """(node, component) that change because a gained link is another paper's: the two are one work.

    The owner is the smallest paper that had the link before, else the smallest that gained it.
    """
    owners = materialize(papers.where(F.col(link).isNotNull()).groupBy(link).agg(F.min_by(id, F.struct(gained, id)).alias("_owner"), F.count(F.lit(1)).alias("_n")).where("_n > 1"), "owners")
    edges = papers.where(gained).select(id, link).join(owners, link).where(F.col(id) != F.col("_owner"))
    return extend_components(labels, edges, id, "_owner")


def sync_status(papers: DataFrame, files: DataFrame, id: str, state: str, kind: str, size: str, least_pdf: int = 1024) -> DataFrame:
    """Paper status from the files that exist: source before PDF before pending; small PDFs don't count."""
    have = files.groupBy(id).agg(F.max(F.when(F.col(kind) == "latex", 1).otherwise(0)).alias("_l"), F.max(F.when((F.col(kind) == "pdf") & (F.col(size) > least_pdf), 1).otherwise(0)).alias("_p"))
    status = F.when(F.col("_l") == 1, "downloaded_latex").when(F.col("_p") == 1, "downloaded_pdf").when(F.col(state) == "unavailable", "unavailable").otherwise("pending")
    return papers.join(have, id, "left").withColumn(state, status).drop("_l", "_p")


def needs_lookup(lookups: Column, service: str, doi: Column, arxiv_id: Column, title: Column, state: Column, least_title: int = 15) -> Column:
    """Whether a service could tell something new: it was not asked or gave no answer, and the paper has what it is asked by.

    ``semantic_scholar`` is asked by DOI; the title lookups serve papers without an arXiv id: ``arxiv_title`` by titles of
    ``least_title`` characters, others by any title of a paper that is not downloaded.
    """
    status = F.element_at(lookups, F.lit(service))
    open_ = F.coalesce(status == "no_answer", F.lit(True))
    some = lambda c: F.coalesce(c != "", F.lit(False))
    if service == "semantic_scholar":
        return open_ & some(doi)
    if service == "arxiv_title":
        return open_ & ~some(arxiv_id) & (F.char_length(F.coalesce(title, F.lit(""))) >= least_title)
    return open_ & ~some(arxiv_id) & some(title) & ~F.coalesce(state.isin("downloaded_latex", "downloaded_pdf"), F.lit(False))


def download_queue(papers: DataFrame, state: str, transient: Column, mode: str) -> DataFrame:
    """Pending papers, and of the unavailable ones all (mode ``all``) or those whose failure may pass (mode ``transient``)."""
    if mode not in ("all", "transient"):
        raise ValueError(f"unknown mode: {mode}")
    again = F.lit(True) if mode == "all" else F.coalesce(transient, F.lit(False))
    return papers.where((F.col(state) == "pending") | ((F.col(state) == "unavailable") & again))


def upgrade_queue(papers: DataFrame, state: str, link: str, answer: str) -> DataFrame:
    """Papers held as PDF that have a source link and for which no answer (such as that there is no source) is recorded."""
    return papers.where((F.col(state) == "downloaded_pdf") & F.coalesce(F.col(link) != "", F.lit(False)) & F.col(answer).isNull())
