"""Page differencing against a brute-force version, with odd pages."""

import random
import re

import numpy as np
import pyarrow.parquet as pq

from sievelake.llm import html


def roles(page):
    return [(t, r) for t, r, _ in html.page_lines(page)]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><div id="cookie-notice">We use cookies</div><header>H</header>
<nav><ul><li><a href="/">Home</a></li></ul></nav><p>Site of {site}</p>{main}<div class="comments"><p>nice!</p></div><aside>S</aside><form><p>mail?</p></form><footer>&copy; F</footer></body></html>"""


def test_html(spark):
    article = "<article><h1>T &amp; U</h1><p>One\n two<br>three<p><b>Four &lt;5&gt;<script>x<y</script> six</article>"
    loose = "<div><p>Story {0} alone</p><p>Another {0} line</p></div>"
    rows = [(1, "http://a.com/en/1", PAGE.format(site="a", main=article)), (2, "http://a.com/en/2", PAGE.format(site="a", main=loose.format("two"))), (3, "http://a.com/en/3?x=1", PAGE.format(site="a", main=loose.format("three"))),
            (4, "http://b.com/", PAGE.format(site="b", main=loose.format("b"))), (5, None, None), (6, "http://a.com/en/9", ""), (None, "http://a.com/en/2", "<p>no id</p>"), (2, "http://a.com/en/2", PAGE.format(site="a", main=loose.format("two")))]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, text string")
    found = {}
    for r in html.extract(pages).collect():
        found.setdefault(r["page_id"], []).append(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert found[1] == ["T & U\n\nOne two three\n\nFour <5> six"]
    assert found[2] == ["Story two alone\n\nAnother two line"] * 2 and found[3] == ["Story three alone\n\nAnother three line"]
    assert found[4] == ["Site of b\n\nStory b alone\n\nAnother b line"] and found[5] == [""] and found[6] == [""] and found[None] == ["no id"]
    assert html.extract(pages.where("false")).count() == 0


def test_html_attribute_values_are_no_attributes():
    for attributes in ('style="overflow:hidden"', 'title="a hidden track"', 'data-id="comments"', "data-role='navigation'", 'alt="x" title="id=menu"'):
        assert roles(f"<div {attributes}><article><p>kept</p></article></div>") == [("kept", html.MAIN_LINE)]
    for attributes in ("hidden", 'style="x" HIDDEN', "ID=menu", 'title="a" class="x sidebar"', "aria-hidden=true", 'role="navigation"'):
        assert roles(f"<div {attributes}><p>gone</p></div>") == [("gone", html.CHROME_LINE)]


def test_html_copies_are_no_template(spark):
    page = "<body><div>Site of a</div><p>{0} tells a story of some length</p><p>and {0} ends it here</p>{1}</body>"
    one, two = page.format("one", ""), page.format("two", "")
    rows = [(1, "http://a.com/p/1", one), (2, "http://a.com/p/1?print=1", one), (3, "http://a.com/p/1?x=2", page.format("one", "<p>printed</p>")), (4, "http://a.com/p/2", two), (5, "http://b.com/1", one), (6, "http://b.com/2", one)]
    rows += [(10 + i, f"http://c.com/{i}", one) for i in range(30)] + [(40, "http://c.com/99", two)]
    found = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    text = "{0} tells a story of some length\n\nand {0} ends it here"
    assert found[1] == found[2] == text.format("one") and found[3] == text.format("one") + "\n\nprinted" and found[4] == text.format("two")
    assert found[5] == found[6] == "Site of a\n\n" + text.format("one")  # nothing else tells this host's template
    assert {found[10 + i] for i in range(30)} == {text.format("one")} and found[40] == text.format("two")


def test_lcs():
    r = random.Random(0)
    for _ in range(300):
        a, b = ([r.randrange(5) for _ in range(r.randrange(14))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        got = html.shared_lines(np.array(a, np.int64), np.array(b, np.int64))
        rest = iter(b)
        assert len(got) == table[-1][-1] and all(a[i] in rest for i in got)


def test_neighbours_are_nearest_on_their_host(spark):
    rows = [(i, f"h{i % 2}", f"/p/{i // 2:012d}", i) for i in range(40)] + [(99, "alone", "/x", 99)]
    lines = [(p, h, path, np.array([[n], [1], [0]], np.int64).tobytes()) for p, h, path, n in rows]
    found = {r["page"]: r["partner"] for r in html.neighbours(spark.createDataFrame(lines, "page long, host string, path string, lines binary")).collect()}
    assert 99 not in found and set(found) == set(range(40)) and all(abs(k - v) == 2 for k, v in found.items())


def test_wrappers_dont_hide_an_article():
    for wrapper in ("class='ads-free side'", 'class="widget search"', 'role="form"', "id=banner"):
        assert roles(f"<div {wrapper}><p>gone</p><article><p>Hi</p></article></div>") == [("gone", html.CHROME_LINE), ("Hi", html.MAIN_LINE)]
    assert roles("<form action=x><article><p>Hi</p><form><p>mail?</p></form></article></form>") == [("Hi", html.MAIN_LINE), ("mail?", html.CHROME_LINE)]
    # what an article names search, share or related is left to the differencing; adverts and comments are not its text
    assert roles('<article><p>a</p><div class="related">b</div><div class="ad">c</div><div class="comments"><article>d</article></div></article>') == [
        ("a", html.MAIN_LINE), ("b", html.MAIN_LINE), ("c", html.CHROME_LINE), ("d", html.CHROME_LINE)]
    assert roles("<aside><article>teaser</article></aside>") == [("teaser", html.CHROME_LINE)]


def lcs(a, b):
    """Positions in ``a`` of a longest common subsequence, by the table of lengths."""
    size = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            size[i + 1][j + 1] = size[i][j] + 1 if x == y else max(size[i][j + 1], size[i + 1][j])
    return size[-1][-1]


def brute(pages):
    """{page: text} of unique (page, url, html): nearest path by trying all pages of the host, then the same rules."""
    parsed = {p: html.page_lines(h) for p, _, h in pages}
    place, hosts = {}, {}
    for p, url, _ in pages:
        host, path = re.match(r"https?://([^/]*)([^?#]*)", url).groups()
        path = re.sub(r"\.\w{1,5}$|/$", "", path)
        place[p] = (host, re.sub(r"\d+", lambda m: m[0].zfill(12), path), p)
        hosts.setdefault(host, []).append(p)

    def main(p):
        role = "m" if any(r == "m" for _, r, _ in parsed[p]) else "l"
        return [t if r == role else None for t, r, _ in parsed[p]]

    def same(p, q):
        a, b = main(p), main(q)
        n, m = sum(len(t) for t in a if t), sum(len(t) for t in b if t)
        every = [{t for t, _, _ in parsed[x]} for x in (p, q)]
        both = min(sum(len(t) for t in a if t and t in every[1]), sum(len(t) for t in b if t and t in every[0]))
        return min(n, m) > 0 and 2 * both > min(n, m)

    def common(p, q):
        return next((i for i, (x, y) in enumerate(zip(place[p][1], place[q][1])) if x != y), min(len(place[p][1]), len(place[q][1])))

    partner = {}
    for ids in hosts.values():
        ids.sort(key=place.get)
        run = {}
        for before, p in zip([None, *ids], ids):
            run[p] = run[before] if before is not None and same(before, p) else p
        for p in ids:
            others = [q for q in ids if run[q] != run[p]]
            if others:
                most = max(common(p, q) for q in others)
                before = [q for q in others if place[q] < place[p]]
                after = [q for q in others if place[q] > place[p]]
                partner[p] = before[-1] if before and common(p, before[-1]) == most else after[0]
                assert common(p, partner[p]) == most  # one of the two beside the run is nearest of all
    stats, shared = {}, {}
    for p, q in partner.items():
        if same(p, q):
            continue
        shared[p] = html.shared_lines(*(np.array([hash(t) for t, _, _ in parsed[x]], np.int64) for x in (p, q)))
        assert len(shared[p]) == lcs([t for t, _, _ in parsed[p]], [t for t, _, _ in parsed[q]])
        for i, (t, (_, _, region)) in enumerate(zip(main(p), parsed[p])):
            if t:
                s = stats.setdefault((place[p][0], region), [0, 0])
                s[0] += len(t) * (i in shared[p])
                s[1] += len(t)
    out = {}
    for p, lines in parsed.items():
        own = place[p][0]
        article = any(r == "m" for _, r, _ in lines)
        gone = {g for h, g in stats if h == own and 2 * stats[h, g][0] > stats[h, g][1]} if shared.get(p) is not None else set()
        out[p] = "\n\n".join(t for i, (t, (_, r, g)) in enumerate(zip(main(p), lines)) if t and g not in gone and (article or i not in shared.get(p, ())))
    return out


def test_html_brute_force(spark):
    """Wrapped articles, pages without one, copies, template regions inside articles, nested paths."""
    rng = random.Random(5)
    texts = [f"Sentence {i} of some length, which is all there is to it." for i in range(90)]
    pages = []
    for i in range(160):
        host = rng.choice("abc")
        own = "".join(f"<p>{t}</p>" for t in rng.sample(texts, rng.randint(2, 9)))
        more = "<div class=share><p>Tell your friends</p><p>or print it</p></div>" if host == "b" else ""
        body = rng.choice([f"<article>{own}{more}</article>", f"<div class='search box'><article>{own}{more}</article></div>", f"<div>{own}</div>", f"<main><section class=post-{i}>{own}</section>{more}</main>"])
        page = f"<body><div class=top-{i}>Site {host}</div><p>Menu {rng.randint(0, 3)}</p>{body}<footer>{rng.random()}</footer></body>"
        if pages and rng.random() < 0.15:
            page = rng.choice(pages)[2]
        pages.append((i, f"http://{host}.com/{rng.choice(['en', 'en/news', 'de'])}/{rng.randint(1, 50)}", page))
    found = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert found == brute(pages)
    told = [p for p, _, h in pages if "Tell your friends" in h]
    assert len(told) > 30 and sum("friends" in found[p] for p in told) * 2 < len(told)  # the rest are copies on other hosts


def test_text_that_all_articles_repeat_stays(spark):
    """A quotation and an opening that every article of a host has are text; a share box is not, though it stands in the articles too."""
    pages = []
    for i in range(4):
        own = " ".join(f"word{i}x{k}" for k in range(80))
        pages.append((i, f"http://a.com/{i}", f"<body><nav>Menu</nav><article><section class='lead'><p>The same opening</p></section><p>{own}</p><div class='quote'><p>The same words quoted</p></div><div class='share'><p>Tell your friends</p></div></article></body>"))
    found = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for i in range(4):
        own = " ".join(f"word{i}x{k}" for k in range(80))
        assert found[i] == f"The same opening\n\n{own}\n\nThe same words quoted"


def test_the_partner_decides(spark):
    page = "<body><p>Only on a</p><p>Story of the first page</p><p>It goes on for a while, and ends</p></body>"
    other = "<body><p>{}</p><p>Another story of the site</p><p>It is told at some length here</p></body>"
    texts = []
    for line in ("Only on a", "Something else"):
        rows = [(1, "http://a.com/1", page), (2, "http://a.com/2", other.format(line))]
        texts.append({r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}[1])
    assert texts == ["Story of the first page\n\nIt goes on for a while, and ends", "Only on a\n\nStory of the first page\n\nIt goes on for a while, and ends"]


def test_given_pages_keep_their_articles(spark, small):
    """On the given pages the main text is all of the article: no line goes because another article has it too."""
    from sievelake.llm.queries import QUERIES

    given = {r["page_id"]: r["html"] for r in pq.read_table(f"{small}/pages.parquet").to_pylist()}
    for r in QUERIES["op5_html_main_text"](spark, small).collect():
        assert r["text"] == "\n\n".join(t for t, role, _ in html.page_lines(given[r["page_id"]]) if role == html.MAIN_LINE)
