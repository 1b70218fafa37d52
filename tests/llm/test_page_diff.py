"""Page differencing: alignment, pairing and markup on small pages."""

import random
import re
import time

from salesight.llm import page_diff as P

SCHEMA = "page_id bigint, url string, html string, text string, shared int"


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(6)
    for _ in range(2000):
        a = [rng.randrange(6) for _ in range(rng.randrange(14))]
        b = [rng.randrange(6) for _ in range(rng.randrange(14))]
        met = P.common_lines(a, b)
        assert met == sorted(set(met)) and len(met) == lcs_length(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in met)


def extract(spark, rows, parts=3):
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)
    return sorted(((r.page_id, r.url, r.text, r.n_shared) for r in P.extract(pages).collect()), key=str)


def test_shared_lines_go_from_pages_without_a_main_element(spark):
    rows, expected = [], {}
    for host in ("a.org", "b.org"):
        for i in range(40):
            body = [f"Story {host} {i} line {k} has words of its own" for k in range(3)]
            frame = [f"Welcome to {host}", f"All rights at {host}"]
            html = "".join(f"<div>{x}</div>" for x in (frame[0], *body, frame[1]))
            rows.append((len(rows), f"https://{host}/s/{i:03}", f"<body>{html}"))
            expected[len(rows) - 1] = "\n\n".join(body)
    rows.append((900, "https://alone.org/", "<p>Only&nbsp;page <b>here</b>"))
    expected[900] = "Only page here"
    twin = "<div>One long article that a neighbour copied word for word</div><div>Menu</div>"
    rows += [(901, "http://copy.org/x", twin), (902, "http://copy.org/y", twin + "<div>tail</div>")]
    expected |= {901: "One long article that a neighbour copied word for word\n\nMenu"}
    expected[902] = expected[901] + "\n\ntail"
    for parts in (1, 5):
        found = extract(spark, rows, parts)
        assert {r[0]: r[2] for r in found} == expected
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert extract(spark, rows, 2) == found
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_markup():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar ad-free">
    <header>Site</header><nav><ul><li><a href="/">Home</a></ul></nav><!-- <p>no</p> -->
    <script>var t="<p>no</p>";</script><div class="cookie-banner"><p>We use cookies</div>
    <article class=post><h1>The &amp; title</h1><p>One <b>bold<br>and
    more</b> text&nbsp;&copy; &#233;<p>Two <a href='x>y'>link</a>.<ul><li>a<li>b</ul>
    <div class="ad">Buy</div><form><p>Mail</p></form><section id="user-comments"><p>first!</p></section>
    <table><tr><td>1<td>2</table></article><aside>Side</aside><footer>&copy; foot</footer></body></html>"""
    text = P.main_text(P.blocks(page), set())
    assert text.split("\n\n") == ["The & title", "One bold and more text © é", "Two link.", "a", "b", "1", "2"]


def test_broken_and_odd_pages(spark):
    article = "<article><p>Kept text"
    pages = {
        1: None, 2: "", 3: "plain text only", 4: article + "</p></article", 5: article + "<footer>no", 6: article + " &am",
        7: "<p class=\"ad>never closed", 8: "<" * 50, 9: "<article></article><p>x</p>", 10: "a<br>b<p></p></div></nav>c",
        11: "<article>" + "<p>long line of text " * 20000, 12: "<nav><p>only menu",
    }
    urls = {1: None, 2: "not a url", 3: "HTTP://H.org", 4: "https://é.example/ä?q=1#x"}
    rows = [(i, urls.get(i, f"http://h.org/{i}"), h) for i, h in pages.items()]
    rows += [(None, None, None), (3, "HTTP://H.org", "plain text only"), (3, "other", "<p>same id")]
    found = extract(spark, rows)
    assert len(found) == len(rows)
    text = {}
    for i, url, t, _ in found:
        text.setdefault(i, []).append(t)
    assert text[1] == [""] and text[2] == [""] and sorted(text[3]) == ["plain text only"] * 2 + ["same id"]
    assert text[4] == text[5] == ["Kept text"] and text[6] == ["Kept text &am"] and text[12] == [""] and text[None] == [""]
    assert text[9] == ["x"] and text[10] == ["a b\n\nc"] and text[11][0].count("\n\n") == 19999
    empty = spark.createDataFrame([], SCHEMA)
    assert P.extract(empty).count() == 0


def test_query_gives_the_articles(spark, small_dir):
    from salesight.llm.queries import op7_page_text

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{small_dir}/pages.parquet").collect()}
    import html

    for row in op7_page_text(spark, small_dir).collect():
        article = re.search(r"<article>(.*?)(?:</article>|<footer|\Z)", pages[row.page_id], re.S)[1]
        parts = [re.sub(r"<[^>]*(>|\Z)", "", x) for x in re.split(r"</?(?:p|h1)>|<br>", article)]
        parts = [" ".join(html.unescape(x).split()) for x in parts]
        assert row.text == "\n\n".join(x for x in parts if x) and row.n_chars == len(row.text)


def test_stray_closing_tags_cost_no_search_of_the_stack():
    """Closing tags of elements that are not open change nothing, however deep the page is."""
    n = 20_000
    page = "<div>" * n + "<p>one</p>" + "</section>" * n + "two" + "</b>" * n
    started = time.process_time()
    found = P.blocks(page)
    assert time.process_time() - started < 5
    assert found == P.blocks("<div><p>one</p></div>two") and [b.text for b in found] == ["one", "two"]
    assert [b.text for b in P.blocks("<nav>a</b></p><p>b</nav>c</p>d")] == ["a", "b", "c", "d"]
    assert [b.furniture for b in P.blocks("<nav>a</b></p><p>b</nav>c</p>d")] == [True, True, False, False]
