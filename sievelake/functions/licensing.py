"""Licence functions on columns."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import once, strip_comments

# Licence names and the patterns that show them, tried in this order.
PATTERNS = [
    ("cc0", r"(?i)creativecommons\.org/publicdomain/zero|cc0[\s\-]1\.0|\\cczero"),
    ("cc-by-nc-nd", r"(?i)creativecommons\.org/licenses/by-nc-nd|cc[\s\-]by[\s\-]nc[\s\-]nd|\\ccbyncnd"),
    ("cc-by-nc-sa", r"(?i)creativecommons\.org/licenses/by-nc-sa|cc[\s\-]by[\s\-]nc[\s\-]sa|\\ccbyncsa"),
    ("cc-by-nc", r"(?i)creativecommons\.org/licenses/by-nc(?![-\w])|cc[\s\-]by[\s\-]nc(?![\s\-](?:sa|nd))|\\ccbync(?![a-z])"),
    ("cc-by-nd", r"(?i)creativecommons\.org/licenses/by-nd|cc[\s\-]by[\s\-]nd|\\ccbynd"),
    ("cc-by-sa", r"(?i)creativecommons\.org/licenses/by-sa|cc[\s\-]by[\s\-]sa|\\ccbysa"),
    ("cc-by", r"(?i)creativecommons\.org/licenses/by(?![-\w])|cc[\s\-]by(?![\s\-](?:nc|sa|nd))|\\ccby(?![a-z])|creative\s+commons\s+attribution\s+(?:4\.0|3\.0|international)|type=\{cc\}[\s,]*modifier=\{by\}|\\acmlicense\{cc-by\}"),
    ("arxiv-nonexclusive", r"(?i)arxiv\.org/licenses/nonexclusive-distrib"),
]
PERMISSIVE = ["cc0", "cc-by", "cc-by-sa", "cc-by-4.0", "public-domain"]
HINTS = ["cc", "creative", "arxiv.org"]  # in each match of a pattern
# End of fixed values.


def detect_license(text: Column, patterns: list[tuple[str, str]] | None = None) -> Column:
    """The first licence in the order of the patterns that the text names; null if none."""
    return once(text, lambda t: F.coalesce(*(F.when(t.rlike(p), F.lit(name)) for name, p in patterns or PATTERNS)))


def detect_in_source(text: Column, patterns: list[tuple[str, str]] | None = None, hints: list[str] | None = None) -> Column:
    """The licence that a source text names outside its comments.

    ``hints``: lower-case literals on one line, one of which each match of a pattern holds. A text without any of them, as
    most are, is searched no further; comments are taken out of the others once.
    """
    low = F.lower(text)
    hinted = functools.reduce(lambda a, b: a | b, (F.contains(low, F.lit(h)) for h in hints or HINTS))
    return F.when(hinted, detect_license(strip_comments(text), patterns))


def normalize_license(value: Column) -> Column:
    """Short name of a licence, or the text as it is."""
    return F.coalesce(detect_license(value), value)


def license_tier(licenses: Column) -> Column:
    """permissive_cc, restricted_cc, custom_or_arxiv, or unspecified for none; any nc or nd blocks permissive."""
    low = F.transform(F.coalesce(licenses, F.array().cast("array<string>")), F.lower)
    blocked = F.exists(low, lambda x: F.coalesce(x.contains("nc") | x.contains("nd"), F.lit(False)))
    free = F.exists(low, lambda x: F.coalesce(x.isin(PERMISSIVE), F.lit(False)))
    creative = F.exists(low, lambda x: F.coalesce(x.startswith("cc-"), F.lit(False)))
    return F.when(F.size(low) == 0, "unspecified").when(free & ~blocked, "permissive_cc").when(creative, "restricted_cc").otherwise("custom_or_arxiv")


def license_name(value: Column) -> Column:
    """``http://creativecommons.org/licenses/by/4.0/`` as ``cc-by``; other texts as they are."""
    kind = F.regexp_extract(value, r"creativecommons\.org/licenses/([a-z-]+)", 1)
    return F.when(value.rlike(r"creativecommons\.org/publicdomain/zero"), "cc0").when(kind != "", F.concat(F.lit("cc-"), kind)).otherwise(value)


def license_of(all_names: Column, tier: Column, effective: Column) -> Column:
    """The first licence whose own tier is the paper's, else the effective one."""
    names = F.transform(all_names, license_name)
    return F.coalesce(F.get(F.filter(names, lambda n: license_tier(F.array(n)) == tier), F.lit(0)), license_name(effective))


def resolve_license(source: Column, pdf: Column, archive: Column, catalogue: Column) -> Column:
    """Struct (licenses, effective, origin, tier, has_conflict) by priority: source files, PDF, archive, catalogue."""
    some = lambda c: F.size(F.coalesce(c, F.array().cast("array<string>"))) > 0
    origin = F.when(some(source), "tex_source").when(some(pdf), "pdf_metadata").when(some(archive), "arxiv_oai").when(some(catalogue), "openalex_locations").otherwise("none")
    chosen = F.array_sort(F.when(some(source), source).when(some(pdf), pdf).when(some(archive), archive).when(some(catalogue), catalogue).otherwise(F.array().cast("array<string>")))
    conflict = origin.isin("tex_source", "pdf_metadata", "arxiv_oai") & some(catalogue) & (chosen != F.array_sort(F.array_distinct(catalogue)))
    return F.struct(chosen.alias("licenses"), F.get(chosen, F.lit(0)).alias("effective"), origin.alias("origin"), license_tier(chosen).alias("tier"), F.coalesce(conflict, F.lit(False)).alias("has_conflict"))


def reclassify(licenses: Column, tier: Column) -> Column:
    """Struct (licenses, tier, changed) re-derived from stored values."""
    now = F.array_sort(F.array_distinct(F.transform(licenses, normalize_license)))
    return F.struct(now.alias("licenses"), license_tier(now).alias("tier"), (~(now.eqNullSafe(licenses) & license_tier(now).eqNullSafe(tier))).alias("changed"))
