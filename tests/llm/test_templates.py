from __future__ import annotations

import json
import re

from conftest import SMALL

from indexday.llm.markup import clean, pieces
from indexday.llm.templates import _blocks, _container, deduce, extract
from indexday.llm.queries import op1_main_text
from indexday.sources import StageStore


def page(i, body, foot="</body></html>"):
    menu = "".join(f'<li><a href="/{j}">item {j}</a></li>' for j in range(i % 3 + 2))
    return (
        f'<!DOCTYPE html><html><head><title>t{i}</title><script>var a = "</p><article>";</script></head><body>'
        f'<div class="cookie-notice">We use cookies</div><nav><ul>{menu}</ul></nav><!-- ad --><div class="ad">Buy {i}</div>'
        f"<article><h1>Title {i}</h1>{body}</article><section id=comments><p>Comment {i}</p></section>"
        f"<aside>Side {i}</aside><footer>&copy; site {i}</footer>{foot}"
    )


def html_rows(n=12):
    rows = [(i, f"http://Site.example.com:80/{i}", page(i, f"<p><b>Body  {i}\n of &amp; text<br>end</p><p>more &lt;{i}&gt;"))
            for i in range(n)]
    rows[3] = (3, rows[3][1], page(3, "<p>cut", ""))
    return rows


def want(i):
    return "Title 3\ncut" if i == 3 else f"Title {i}\nBody {i} of & text end\nmore <{i}>"


def test_article_of_a_host(frame):
    df = frame([(*r, "x") for r in html_rows()], "page_id long, url string, html string, template string").repartition(3)
    found = {r.page_id: r for r in extract(df).collect()}
    assert {i: r.text for i, r in found.items()} == {i: want(i) for i in range(12)}
    assert all(r.n_chars == len(r.text) and r.url == f"http://Site.example.com:80/{i}" for i, r in found.items())
    template = json.loads(deduce(df).first().template)
    assert template["container"] == "/html/body/article" and "/html/body/article<h1>" in template["order"]
    # the menu's tokens take turns and nest in the slot behind the list's start
    assert [t.split("/")[-1] for t in template["nested"]["/html/body/nav<ul>"]][:2] == ["ul<li>", "ul<a>"]


def test_edge_cases(frame):
    rows = [
        (1, "http://a/", None), (2, "http://b/", ""), (3, None, page(3, "<p>alone</p>")), (4, "not a url", "just text &eacute;"),
        (5, "http://c/", "<p>one<p>two"), (5, "http://c/", "<p>one<p>two"), (None, "http://d/", "<main><p>m</main><p>out"),
        (7, "http://e/", "<article><p>" + "word " * 100_000 + "</article>"), (8, "http://f/", "<<a <b>> x < y"),
        (9, "http://g/", "<div class='sidebar'>s</div><div>kept<form>no</form></div><script>never closed"),
    ]
    found = sorted(((r.page_id or 0), r.text, r.n_chars) for r in extract(frame(rows, "page_id long, url string, html string")).collect())
    texts = [t for _, t, _ in found]
    assert texts[:7] == ["m", "", "", "Title 3\nalone", "just text \xe9", "one\ntwo", "one\ntwo"]
    assert found[7][2] == 499_999 and texts[9] == "kept"
    assert all(len(t) == n for _, t, n in found)


def test_copies_of_one_page_keep_their_text(frame):
    same = page(1, "<p>all the same</p>")
    rows = [(i, f"http://one/{i}", same) for i in range(40)]
    found = extract(frame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in found} == {"Title 1\nall the same"} and len(found) == 40


def test_empty(frame):
    assert extract(frame([], "page_id long, url string, html string")).collect() == []


def test_only_shared_tokens_of_small_hosts_are_gathered(frame, monkeypatch):
    rows = [(i, f"http://small{i // 2}/{i}", page(i, "".join(f"<p>{f'word{i}x{j} ' * 20}</p>" for j in range(30)))) for i in range(60)]
    gathered, put = [], StageStore.put

    def spy(self, name, df, *args, **kwargs):
        out = put(self, name, df, *args, **kwargs)
        if name == "roles":
            gathered.extend(len(r.roles) for r in out.select("roles").distinct().collect())
        return out

    monkeypatch.setattr(StageStore, "put", spy)
    found = extract(frame(rows, "page_id long, url string, html string").repartition(7)).collect()
    assert all(f"word{r.page_id}x29" in r.text and r.text.startswith(f"Title {r.page_id}") for r in found) and len(found) == 60
    assert gathered and max(gathered) < 100  # a page has about 70 tokens, the group 1,800 paragraphs


def test_classes_that_only_mention_boilerplate():
    for start, end in [
        ('<body class="has-sidebar"><article>', "</article></body>"), ('<body class="no-banner">', "</body>"),
        ('<main class="with-sidebar">', "</main>"), ('<article class="widget">', "</article>"), ('<html id="login"><body>', ""),
        ('<div class="content has-sidebar">', "</div>"),
    ]:
        assert _blocks(f'{start}<p>text</p><div class="sidebar">side</div><div class="page-share">s</div>{end}', None) == ["text"]


def test_container_holds_the_whole_text():
    mixed = "<body><div id=content><p>intro</p><ul><li>a much longer list</li></ul><p>end</p></div></body>"
    assert _blocks(mixed, None) == ["intro", "a much longer list", "end"]
    sections = "<body><section class=one><p>a longer first part</section><section class=two><p>second</section></body>"
    assert _blocks(sections, None) == ["a longer first part", "second"]
    assert _blocks("<div><ul><li>only a list</ul></div>", None) == ["only a list"]
    outer = _container([("/html/body/div.tail", False, 5), ("/html/body/div.text/section", False, 600), ("/html/body/div.text/ul", False, 400)])
    assert outer == "/html/body/div.text"


def test_pieces():
    found = [(p.kind, p.name, p.path, p.cut) for p in pieces('<div id="a>b"><P>x<!-- <p> --></div>y</nav>')]
    assert found[0][:2] == ("open", "div") and ("text", "x", "/div.a.b", False) in found and ("text", "y", "", False) in found
    assert clean(" a&nbsp;b\n&#65; ") == "a b A"


def built(i, inner=""):
    """A page of a host whose boilerplate no word list knows."""
    return (
        "<html><body><div class=hd>Welcome to the ACME times online edition</div>"
        f"<div class=c1><p>Story {i} begins here</p><p>{' '.join(f'word{i}x{j}' for j in range(30))}</p>{inner}</div>"
        "<div class=bx><p>Call us at 555 1234 for anything</p></div></body></html>"
    )


def story(i):
    return f"Story {i} begins here\n{' '.join(f'word{i}x{j}' for j in range(30))}"


def texts_of(frame, pages):
    rows = [(i, f"http://acme.test/{i}", html) for i, html in enumerate(pages)]
    return {r.page_id: r.text for r in extract(frame(rows, "page_id long, url string, html string").repartition(3)).collect()}


def test_text_of_the_template_is_cut_by_its_class(frame):
    found = texts_of(frame, [built(i) for i in range(30)])
    # "Story", "begins" and "here" stand once on every page too: they are the template's words among those of the slot
    assert all(f"word{i}x29" in t and "ACME" not in t and "555" not in t for i, t in found.items())
    # without a template the same page keeps all of it
    alone = "\n".join(_blocks(built(3), None))
    assert "ACME" in alone and "555" in alone


def test_a_line_in_every_article_is_the_template_s(frame):
    line = "Follow the ACME times on every channel there is and never miss a single story again"
    found = texts_of(frame, [f"<html><body><article><h1>{i}</h1><p>{built(i)[100:300]}</p><p>{line}</p></article></body></html>" for i in range(30)])
    assert all(line not in t and f"word{i}x2" in t for i, t in found.items())


def test_few_or_like_pages_have_no_template_text(frame):
    few = texts_of(frame, [built(i) for i in range(5)] * 8)  # 40 pages, five different ones
    assert all("ACME" in t for t in few.values())
    like = texts_of(frame, [f"<html><body><article><p>{'all the same words ' * 20}</p><p>{i}</p></article></body></html>" for i in range(30)])
    assert all("all the same words" in t for t in like.values())


def test_formulas_and_lists_of_commands_in_an_article_stay():
    page = "<body><menu><li>top</li></menu><article><p>The formula <math><mi>x</mi><mo>=</mo><mn>5</mn></math> holds</p><menu><li>first</li><li>then</li></menu></article></body>"
    assert _blocks(page, None) == ["The formula x=5 holds", "first", "then"]


def test_query_gives_the_articles(spark):
    """The articles of the given pages, cut out by their own tags, are what the query returns."""
    rows = {r.page_id: r for r in op1_main_text(spark, SMALL).collect()}
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    assert len(rows) == len(pages)
    right = 0
    for p in pages:
        inner = re.search(r"<article[^>]*>(.*?)</article>", p.html or "", re.S)
        if inner is None:
            continue
        inner = re.sub(r"<!--.*?-->|<(script|style|aside|form|nav)\b.*?</\1>", "", inner[1], flags=re.S)
        inner = re.sub(r"<br\s*/?>", " ", inner)
        blocks = re.split(r"</?(?:p|h\d|li|ul|ol|div|section|table|tr|td|blockquote|pre|header|footer|figure)\b[^>]*>", inner)
        blocks = [clean(re.sub(r"<[^>]*>", "", b)) for b in blocks]
        right += rows[p.page_id].text == "\n".join(b for b in blocks if b)
        assert rows[p.page_id].n_chars == len(rows[p.page_id].text)
    assert right >= 0.9 * len(pages)
