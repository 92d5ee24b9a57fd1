"""Main text by wrappers, on pages whose article is known."""

import duckdb
import re
from html import unescape

from talkgrain.llm import html_wrappers as hw

SETTINGS = hw.Settings()


def page(k, extra=""):
    paragraphs = "".join(f"<p class='t{k}'>Paragraph {k}.{j} &amp; <b>bold</b>\n text&nbsp;here</p>" for j in range(k % 4))
    return f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a = "</p>";</script></head><body>
    <header class="site"><a href="/">Logo</a></header><nav><ul><li><a href="a">A</a></li><li><a href="b">B</a></li></ul></nav>
    <div class="cookie-notice">We use cookies</div><!-- <p>hidden</p> -->
    <article><header><h1>Title {k} &lt;x&gt;</h1></header>{paragraphs}{extra}<aside>Side</aside><form><p>Sign up</p></form></article>
    <div id="comments"><p>A reader says</p></div><div class="ad-box">Buy</div><footer>&copy; 2026</footer></body></html>"""


def want(k, extra=()):
    return "\n".join([f"Title {k} <x>", *(f"Paragraph {k}.{j} & bold text here" for j in range(k % 4)), *extra])


def test_pages_of_a_host(spark):
    rows = [(k, f"https://Site{k % 2}.example:80/p{k}", page(k)) for k in range(20)]
    rows += [(90, "https://site0.example/x", page(3, "<table><tr><td>cell one<td>cell two</table>")), (91, None, None), (92, "no url", ""), (93, "https://alone.example/", "<p>only <b>this<p>and that"), (3, rows[3][1], rows[3][2])]
    pages = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, text string, host string").repartition(4)
    got = [(r["page_id"], r["text"], r["host"]) for r in hw.extracted(pages).collect()]
    assert len(got) == len(rows) and all(h == "clash" for *_, h in got)
    texts = {i: t for i, t, _ in got}
    assert all(texts[k] == want(k) for k in range(20))
    assert texts[90] == want(3, ["cell one", "cell two"]) and texts[91] == texts[92] == "" and texts[93] == "only this\nand that"


def test_empty(spark):
    assert hw.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    got = {r["page_id"]: r["text"] for r in hw.extracted(spark.read.parquet(f"{folder}/pages.parquet")).collect()}
    rows = duckdb.sql(f"select page_id, html from '{folder}/pages.parquet'").fetchall()
    assert len(got) == len(rows)
    for page_id, html in rows:
        article = re.search(r"<article>(.*?)</article>", html, re.S)[1]
        parts = [" ".join(unescape(re.sub(r"</?b>", "", x).replace("<br>", " ")).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert got[page_id] == "\n".join(x for x in parts if x)


def test_alignment():
    a, b, c = ("#", "a"), ("#", "b"), ("#", "c")
    assert hw.folded([a, b, a, b, a, b, c], 8) == (("+", (a, b)), c)
    assert hw.folded([a, a, a], 8) == (("+", (a,)),)
    assert hw.aligned((a, b, c), (a, c)) == (a, ("?", (b,)), c)
    assert hw.aligned((a, ("+", (b,)), c), (a, b, c)) == (a, ("+", (b,)), c)
    both = hw.aligned(hw.aligned((a, b), (b, c)), (a, b, b, c))
    assert hw.slots(both) == ["a", "b", "c"]


def test_odd_markup():
    for html in ("<", "<a", "<p <p>x", "a < b > c", "<!-- open", "<script>never closed", "&#xZZ; &amp", "<p class=\"x>y", "\x00<p>\x00</p>", "<p>" * 3000 + "deep", "<" * 5000):
        assert isinstance(hw.blocks(html), list)
    assert hw.outside("html/body/div.ad") and hw.outside("html/body/aside/p") and not hw.outside("html/body/article/header/h1") and hw.outside("html/body/header/h1")


def test_templates_and_words_around_the_article(spark):
    body = "".join(f"<p>Paragraph {j} of a long story about the harbour and its ships</p>" for j in range(6))
    story = "\n".join(f"Paragraph {j} of a long story about the harbour and its ships" for j in range(6))
    side = "<nav><a href='/'>Home</a></nav><div class='related'><article><p>Read this too</p></article></div><div id='comments'><p>Nice</p></div>"
    pages = {
        "article": f"<html><body><article>{body}</article>{side}</body></html>",
        "old": f"<html><body><div class='content'>{body}</div>{side}</body></html>",
        "body": f"<html><body class='has-sidebar'><article>{body}</article>{side}</body></html>",
        "content": f"<html><body><div class='content no-sidebar'>{body}</div>{side}</body></html>",
        "share": f"<html><body><article class='post share-enabled'>{body}</article><article><p>Teaser</p></article>{side}</body></html>",
        "wrapper": f"<html><body><div id='page-comments-open'><article>{body}</article>{side}</div></body></html>",
    }
    rows = [(f"{host} {name}", f"https://{host}/{name}" if host else None, html) for host in ("one.example", "") for name, html in pages.items()]
    got = {r["id"]: r["text"] for r in hw.extracted(spark.createDataFrame(rows, "id string, url string, html string")).collect()}
    assert len(got) == len(rows)
    for name, text in got.items():
        assert text == story + ("\nTeaser" if name.endswith("share") else ""), name


def test_many_comments_are_no_article():
    comments = "".join(f"<p>A reader says number {j} at some length</p>" for j in range(20))
    html = f"<body><div class='content'><p>{'A short story of the day. ' * 6}</p></div><div class='comments'>{comments}</div></body>"
    assert hw.main_text(html, frozenset(), SETTINGS) == ("A short story of the day. " * 6).strip()


def site(k, middle=None):
    body = middle or "".join(f"<p>Story {k} has a paragraph {j} of its own, about ship {k * 7 + j}</p>" for j in range(1 + k % 3))
    return f"<html><body><div class='site-top'>The harbour paper since 1890</div><div class='content'>{body}</div><div class='bottom'>Printed by the harbour press</div></body></html>"


def test_equal_text_is_template_and_differing_text_a_slot(spark):
    rows = [(k, "https://harbour.example/%d" % k, site(k)) for k in range(6)]
    rows += [(10 + k, "https://copies.example/%d" % k, site(1)) for k in range(5)]  # equal pages tell nothing
    rows += [(20 + k, "https://alone.example/%d" % k, site(k)) for k in range(2)]  # too few to tell
    got = {r["page_id"]: r["text"].split("\n") for r in hw.extracted(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    for k in range(6):
        assert got[k] == [f"Story {k} has a paragraph {j} of its own, about ship {k * 7 + j}" for j in range(1 + k % 3)]
    for k in (*range(10, 15), 20, 21):
        assert got[k][0] == "The harbour paper since 1890" and got[k][-1] == "Printed by the harbour press"


def test_a_page_is_parsed_with_its_wrapper():
    pages = [hw.stream(hw.blocks(site(k)), SETTINGS)[0] for k in range(5)]
    wrapper = pages[0]
    for own in pages[1:]:
        wrapper = hw._joined(wrapper, own, SETTINGS)
    for own in pages:
        told = hw.parsed(own, wrapper)
        assert [f.digest is not None for f in told] == [True, *[False] * (len(told) - 2), True] and all(len(f.pages) == 3 for f in (told[0], told[-1]))
    odd = hw.stream(hw.blocks(site(9, "<table><tr><td>one<td>two</table>")), SETTINGS)[0]
    assert [f is None for f in hw.parsed(odd, wrapper)] == [False, True, False]
