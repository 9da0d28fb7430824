"""Main text of web pages by nearest-URL page differencing.

A page is read as lines (block elements end a line), each with the region it stands in: the chain of its container
elements. Each page is paired with the page of its host whose URL path is nearest and that is no copy of it, and the two
line sequences are aligned by longest common subsequence. Shared lines belong to the site's template:

* a shared line outside an article is deleted;
* a region whose text is mostly shared, over all pairs of the host, is a part of the template, and all its lines are
  deleted; inside an article only where a container's name there says so too (a share box, related links): a quotation or an
  opening that all articles of a host repeat is text, and so is a line that two articles share in a region of otherwise different text.

Markup confirms: menus, headers, footers, sidebars, notices, adverts, forms and reader comments go by their elements and
names also where they differ from page to page or where a page has no partner, and a page with an article is its article.

Pairing works on URLs alone and alignment on 64-bit line hashes. A page is parsed once; its text is moved once, compressed.
"""

from __future__ import annotations

import html as entities
import os
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from .common import materialize

# Element, role and class names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small span strong sub sup time tt u var wbr br".split())
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tfoot tr td th caption figure figcaption address html body".split())
MAIN = frozenset("article main".split())
CHROME = frozenset("nav header footer aside menu dialog button select object head".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
READERS = "comment comments reply replies disqus"
NOTICES = "nav navbar navigation menu menubar sidebar footer ad ads advert adverts advertisement sponsor sponsored promo cookie cookies consent notice alert popup modal newsletter subscribe"
LAYOUT = "header masthead side aside banner breadcrumb breadcrumbs share sharing social related recommended widget toolbar pagination pager login search"
# End of fixed values.

KEEP, SOFT, HARD = 0, 1, 2
MAIN_LINE, CHROME_LINE, LOOSE_LINE = "m", "c", "l"


def _names(words: str) -> re.Pattern:
    return re.compile(rf"(?:^|[\s_-])(?:{'|'.join(words.split())})(?:$|[\s_-])", re.I)


_READERS, _NOTICES, _LAYOUT = _names(READERS), _names(NOTICES), _names(LAYOUT)
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"\"[^\"]*\"|'[^']*'|([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")
_OPENERS = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}


def _role(name: str, attributes: list[tuple[str, str]], inside: bool) -> int:
    """What an element's markup says of its lines: KEEP, or chrome that an article within it overrides (SOFT) or not (HARD)."""
    if name in CHROME:
        return HARD
    found = (HARD if inside else SOFT) if name == "form" else KEEP
    for key, value in attributes:
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return HARD
        if key in ("class", "id") and _READERS.search(value):
            return HARD
        if name in MAIN or name in ("html", "body"):
            continue
        if (key == "role" and value.lower() in ROLES) or (key in ("class", "id") and _NOTICES.search(value)):
            found = HARD if inside else SOFT
        elif key in ("class", "id") and not inside and _LAYOUT.search(value):
            found = max(found, SOFT)
    return found


def page_lines(html: str | None) -> list[tuple[str, str, int]]:
    """(line, role, region) of every line of a page.

    An end tag closes up to its element; without one an element lasts until an ancestor ends. An inline element does not
    keep a block that follows from standing on a line of its own. The region is a hash of the chain of containers, with
    their names and classes but without digits, which number posts; its last bit says that one of them, within the article,
    is named like a part of a layout.
    """
    if not html:
        return []
    out: list[tuple[str, str, int]] = []
    stack: list[tuple[str, int, bool, int]] = []  # name, chrome, inside an article, region
    words: list[str] = []
    at = 0

    def flush() -> None:
        text = _SPACE.sub(" ", entities.unescape("".join(words))).strip() if words else ""
        if text:
            _, chrome, inside, region = stack[-1] if stack else ("", KEEP, False, 0)
            out.append((text, CHROME_LINE if chrome else MAIN_LINE if inside else LOOSE_LINE, region))
        words.clear()

    def pop(names: tuple[str, ...], within: frozenset[str] = frozenset()) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                if stack[i][0] not in INLINE:
                    flush()
                del stack[i:]
                return
            if stack[i][0] in within:
                return

    while at < len(html):
        match = _TAG.search(html, at)
        start = match.start() if match else len(html)
        if start > at:
            words.append(html[at:start])
        if not match:
            break
        at = match.end()
        name = (match[2] or "").lower()
        if not name:
            continue
        if match[1]:
            pop((name,))
            continue
        if name in ("br", "wbr"):
            words.append(" ")
            continue
        if name in VOID:
            if name == "hr":
                flush()
            continue
        if name in RAW:  # its content is no markup; it doesn't end a line
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        if name not in INLINE:
            flush()
            if name in _OPENERS:
                pop(_OPENERS[name], frozenset({"ul", "ol", "dl", "table", "div", "section", "article", "main", "body", "td", "blockquote"} - {name}))
            elif name not in ("html", "head", "body"):
                pop(("p",), frozenset({"div", "section", "article", "main", "body", "td", "li", "blockquote"} - {name}))
            if name == "body":
                stack[:] = [x for x in stack if x[0] == "html"]
        if match[3].endswith("/"):
            continue
        _, chrome, inside, region = stack[-1] if stack else ("", KEEP, False, 0)
        attributes = [(k.lower(), a or b or c) for k, a, b, c in _ATTRIBUTE.findall(match[3]) if k] if match[3] else []
        if name in MAIN and not inside and chrome == SOFT:
            chrome = KEEP  # a wrapper's name doesn't make the article chrome
        chrome = max(chrome, _role(name, attributes, inside))
        if name not in INLINE and (name not in TEXTUAL or attributes):
            own = " ".join(v for k, v in attributes if k in ("class", "id"))
            if own or name not in TEXTUAL:
                layout = 0 if name in MAIN and not inside else region & 1 | bool(_LAYOUT.search(own))
                region = xxhash.xxh3_64_intdigest(f"{region}/{name} {_DIGITS.sub('', own)}".encode("utf-8", "surrogatepass")) >> 2 << 1 | layout
        stack.append((name, chrome, inside or name in MAIN, region))
    flush()
    return out


def article_role(roles: str) -> str:
    """The role of the lines that may be main text: those in an article, on a page without one the loose ones."""
    return MAIN_LINE if MAIN_LINE in roles else LOOSE_LINE


def main_text(texts: list[str], roles: str, regions: list[int], shared: set[int], template: set[int]) -> str:
    """The lines that may be main text and that neither a template region (in an article: one named like it) nor, outside an article, sharing deletes."""
    role = article_role(roles)
    gone = {g for g in template if role == LOOSE_LINE or g & 1}
    return "\n\n".join(t for i, (t, r, g) in enumerate(zip(texts, roles, regions, strict=True)) if r == role and g not in gone and (role == MAIN_LINE or i not in shared))


def shared_lines(own: np.ndarray, other: np.ndarray) -> list[int]:
    """Positions in ``own`` of a longest common subsequence with ``other`` (bit-parallel rows, exact)."""
    where: dict[int, int] = {}
    for j, x in enumerate(other.tolist()):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(other)) - 1
    rows, row = [], full
    for x in own.tolist():
        hit = where.get(x, 0)
        met = row & hit
        row = ((row + met) | (row - met)) & full
        rows.append(row)
    out, i, j = [], len(own) - 1, len(other)
    while i >= 0 and j > 0:
        # bit j - 1 of a row is 0 where the prefix of j lines has one more common line than that of j - 1
        before = rows[i - 1] if i else full
        mask = (1 << j) - 1
        here, above = (~rows[i] & mask).bit_count(), (~before & mask).bit_count()
        if here == above:
            i -= 1
        elif (~rows[i] & (mask >> 1)).bit_count() == here:
            j -= 1
        else:
            out.append(i)
            i, j = i - 1, j - 1
    return out[::-1]


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """Path without its fragment, query, trailing slash and extension; numbers padded, so that near numbers share digits."""
    path = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"[?#].*$", ""), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*", "")
    padded = F.regexp_replace(F.regexp_replace(path, r"\.\w{1,5}$|/$", ""), r"(?<!\d)(\d{1,11})(?!\d)", "00000000000$1")
    return F.regexp_replace(padded, r"(?<!\d)0*(\d{12})(?!\d)", "$1")


@F.pandas_udf(IntegerType())
def nearness(a: pd.Series, b: pd.Series) -> pd.Series:
    """How many leading characters two paths share: their depth in the tree of the host's paths; -1 where one is missing."""
    return pd.Series([-1 if x is None or y is None else len(os.path.commonprefix((x, y))) for x, y in zip(a, b, strict=True)], dtype="int32")


def neighbours(lines: DataFrame) -> DataFrame:
    """(page, partner) where partner is the page of the same host with the nearest path; pages alone on a host are left out.

    ``lines``: (page, host, path, lines), one row per page. Near are paths that share many leading characters. In the
    order of the paths, no path shares more with a given one than one of the two beside it, so these two are compared;
    of equally near ones the one before counts. A run of pages that are each mostly the same as the one before is passed
    over: the partners of its pages are the nearest before and after the run, however long it is.

    Pages are sorted by host and path in ranges; a page's neighbour beyond the end of a range is the first or last page
    of the range beside it, so a host of any size is spread over many tasks.
    """
    rows = lines.select("page", "host", "path")
    rows = rows.repartitionByRange("host", "path", "page").withColumn("part", F.spark_partition_id())
    rows = materialize(rows, "html-sorted")
    order = ["host", "path", "page"]
    ends = rows.groupBy("part").agg(F.max(F.struct(*order)).alias("high"))
    beside = Window.orderBy("part")  # one row per range
    ends = ends.select("part", F.lag("high").over(beside).alias("left"))
    within, back = Window.partitionBy("part").orderBy(*order), Window.partitionBy("part").orderBy(*(F.desc(c) for c in order))
    own = F.struct("host", "path", "page")
    near = rows.withColumn("before", F.lag(own).over(within)).join(F.broadcast(ends.select("part", "left")), "part").withColumn("before", F.coalesce("before", "left")).drop("left")
    texts = lines.select("page", "lines")
    both = near.where("before.host = host").select("page", F.col("before.page").alias("partner")).join(texts, "page").join(texts.select(F.col("page").alias("partner"), F.col("lines").alias("other")), "partner")
    copies = both.select("page", "lines", "other").mapInArrow(_copies, "page long").withColumn("copy", F.lit(True))
    near = materialize(near.join(copies, "page", "left").withColumn("starts", F.col("copy").isNull()).drop("copy"), "html-runs")
    first = F.when(F.col("starts"), F.struct(F.col("before").alias("x")))
    after = F.when(F.col("starts"), F.struct(own.alias("x")))
    ends = near.where("starts").groupBy("part").agg(F.max_by(F.struct(F.col("before").alias("x")), own).alias("left"), F.min_by(F.struct(own.alias("x")), own).alias("right"))
    ends = near.select("part").distinct().join(ends, "part", "left")
    ends = ends.select("part", F.last("left", True).over(beside.rowsBetween(Window.unboundedPreceding, -1)).alias("left"), F.last("right", True).over(Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)).alias("right"))
    near = near.withColumns({"_b": F.last(first, True).over(within.rowsBetween(Window.unboundedPreceding, 0)), "_a": F.last(after, True).over(back.rowsBetween(Window.unboundedPreceding, -1))})  # a frame to the end would be read anew for every row
    near = near.join(F.broadcast(ends), "part").withColumns({"before": F.coalesce("_b", "left")["x"], "after": F.coalesce("_a", "right")["x"]})
    shares = lambda c: nearness(F.col("path"), F.when(F.col(f"{c}.host") == F.col("host"), F.col(f"{c}.path")))
    near = near.withColumns({"n0": shares("before"), "n1": shares("after")})
    partner = F.when(F.greatest("n0", "n1") >= 0, F.when(F.col("n0") >= F.col("n1"), F.col("before.page")).otherwise(F.col("after.page")))
    return near.select("page", partner.alias("partner")).where("partner is not null")


_PARSED = [("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("path", pa.string()), ("size", pa.int64()), ("data", pa.binary()), ("roles", pa.string()), ("regions", pa.binary()), ("lines", pa.binary())]


def _parse(batches):
    """Each page's text (compressed), roles and regions, and ``lines``: hashes, lengths and regions, 64 bits each.

    The length is 0 for lines that can't be main text.
    """
    for batch in batches:
        rows = []
        for page, url, host, path, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "host", "path", "html")), strict=True):
            found = page_lines(html)
            body = "\n".join(t for t, _, _ in found).encode("utf-8", "surrogatepass")
            roles = "".join(r for _, r, _ in found)
            role = article_role(roles)
            regions = np.array([g for _, _, g in found], np.int64)
            hashes = np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) >> 1 for t, _, _ in found], np.int64)
            lengths = np.array([len(t) * (r == role) for t, r, _ in found], np.int64)
            rows.append((page, url, host, path, len(body), pa.compress(body, codec="zstd", asbytes=True), roles, regions.tobytes(), np.concatenate((hashes, lengths, regions)).tobytes()))
        columns = zip(*rows, strict=True) if rows else [()] * len(_PARSED)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _PARSED, strict=True)], names=[n for n, _ in _PARSED])


def _split(data: bytes) -> np.ndarray:
    """Rows of hashes, lengths and regions."""
    return np.frombuffer(data, np.int64).reshape(3, -1)


def mostly_same(a: bytes, b: bytes) -> bool:
    """Whether over half of the characters of the page with less main text are in lines that both have."""
    (own, n, _), (other, m, _) = _split(a), _split(b)
    least = min(n.sum(), m.sum())
    return bool(least and 2 * min(n[np.isin(own, other)].sum(), m[np.isin(other, own)].sum()) > least)


def _copies(batches):
    for batch in batches:
        pages = [p for p, a, b in zip(*(batch.column(c).to_pylist() for c in ("page", "lines", "other")), strict=True) if mostly_same(a, b)]
        yield pa.RecordBatch.from_pydict({"page": pa.array(pages, pa.int64())})


def compared(a: bytes, b: bytes) -> tuple[list[int], list[tuple[int, int, int]]]:
    """Positions of the lines that page ``a`` shares with ``b``, and per region its characters that are shared, and all."""
    own, n, region = _split(a)
    if mostly_same(a, b):
        return [], []
    positions = shared_lines(own, _split(b)[0])
    names, where = np.unique(region[n > 0], return_inverse=True)
    common = np.zeros(len(own), np.int64)
    common[positions] = 1
    weight = n[n > 0]
    same, every = np.bincount(where, weight * common[n > 0], len(names)), np.bincount(where, weight, len(names))
    return positions, [(g, int(s), int(t)) for g, s, t in zip(names.tolist(), same, every, strict=True)]


_REGIONS = pa.list_(pa.struct([("region", pa.int64()), ("same", pa.int64()), ("every", pa.int64())]))


def _compare(batches):
    for batch in batches:
        found = [compared(a, b) for a, b in zip(batch.column("lines").to_pylist(), batch.column("other").to_pylist(), strict=True)]
        regions = pa.array([[{"region": g, "same": s, "every": t} for g, s, t in x] for _, x in found], _REGIONS)
        yield pa.RecordBatch.from_arrays([batch.column("page"), batch.column("host"), pa.array([p for p, _ in found], pa.list_(pa.int32())), regions], names=["page", "host", "shared", "regions"])


def _main_texts(batches):
    for batch in batches:
        texts = []
        for size, data, roles, regions, shared, template in zip(*(batch.column(c).to_pylist() for c in ("size", "data", "roles", "regions", "shared", "template")), strict=True):
            body = pa.decompress(data, size, codec="zstd", asbytes=True).decode("utf-8", "surrogatepass") if size else ""
            lines = body.split("\n") if roles else []
            texts.append(main_text(lines, roles, np.frombuffer(regions, np.int64).tolist(), set(shared or ()), set(template or ())))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``df``.

    Null or empty html, and pages without main text, give an empty text. A null URL is a host of its own kind (empty
    name); rows with a null id, and pages alone on their host, are read by their markup. Rows that repeat an id are
    compared as one page, by the smallest of their host, path and lines; of equally near pages the one before in the
    order of paths is the partner. An empty table gives no rows; other columns are not read.
    """
    pages = df.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    pages = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    parsed = materialize(pages.mapInArrow(_parse, "page_id long, url string, host string, path string, size long, data binary, roles string, regions binary, lines binary"), "html-parsed")
    one = F.struct("host", "path", "lines")
    lines = parsed.where("page_id is not null").groupBy(F.col("page_id").alias("page")).agg(F.min(one).alias("x")).select("page", "x.*")
    lines = materialize(lines, "html-lines")
    both = neighbours(lines).join(lines.select("page", "host", "lines"), "page").join(lines.select(F.col("page").alias("partner"), F.col("lines").alias("other")), "partner")
    found = materialize(both.select("page", "host", "lines", "other").mapInArrow(_compare, "page long, host string, shared array<int>, regions array<struct<region:long,same:long,every:long>>"), "html-compared")
    regions = found.select("page", "host", F.inline("regions"))
    template = materialize(regions.groupBy("host", "region").agg(F.sum("same").alias("same"), F.sum("every").alias("every")).where("2 * same > every").select("host", "region"), "html-template")
    own = regions.join(template, ["host", "region"], "left_semi").groupBy("page").agg(F.collect_set("region").alias("template"))  # of one page's regions
    gone = found.select("page", "shared").join(own, "page", "left")
    placed = parsed.drop("lines", "host", "path").join(gone, parsed["page_id"] == gone["page"], "left")
    return placed.select("page_id", "url", "size", "data", "roles", "regions", "shared", "template").mapInArrow(_main_texts, "page_id long, url string, text string").withColumn("n_chars", F.char_length("text").cast("long"))
