from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from pubwatch.llm import html_text

CASES = [
    ("", ""),
    ("plain &amp; simple", "plain & simple"),
    ("<p>one<p>two  \n three<br>four", "one\ntwo three four"),
    ("<nav><ul><li>a<li>b</ul></nav><article><h1>T</h1><p><b>x<p>y</b></article><footer>f", "T\nx\ny"),
    ("<script>if(a<b)'</p>'</script><style>p{}</style><p>k<!-- <p>no</p> --></p>", "k"),
    ("<div class='cookie-notice'>c</div><div id=content><p>t&eacute;xt &#8212; &#x41;</p></div>", "téxt — A"),
    ("<article><p>a</p><section id='comments'><p>c</p></section></article><aside>s</aside>", "a"),
    ("<header><h1>site</h1></header><main><header><h1>T</h1></header><p>a</p><form>f<input></form></main>", "T\na"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
    ("<p>cut off <b", "cut off <b"),
    ("<title>t &am</title><p a='>' hidden>h</p><p>v</p><p style='display: none'>n", "v"),
    ("<article class='ad-free'><p>kept</p></article>", "kept"),
    ("<p>a&nbsp;b</p>", "a b"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_one_page(page, text):
    assert html_text.main_text(page, []) == text


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, text string")


def shop(i):
    teaser = "".join(f"<div class=t{j}><p>offer number {i * j} today</p></div>" for j in range(2))
    story = "".join(f"<p>story {i} sentence {j} with many more words than any teaser has</p>" for j in range(5 + i % 4))
    return f"<html><body><div class='k9'>{teaser}</div><div class='z{i}'><div class='q'>{story}</div></div></body></html>"


def test_template_finds_the_slot_without_any_hint(spark):
    rows = [(i, f"http://h.example/{i}", shop(i)) for i in range(40)]
    found = {r["page_id"]: r for r in html_text.extract(pages(spark, rows)).collect()}
    for i in range(40):
        want = [f"story {i} sentence {j} with many more words than any teaser has" for j in range(5 + i % 4)]
        assert found[i]["text"].split("\n") == want
        assert found[i]["n_chars"] == len(found[i]["text"])


def test_headings_and_single_paragraphs_stay(spark):
    page = "<body><div class=menu>m</div><div id=c><h1>Title {0}</h1><div class=t>{1}</div></div><div class=z>other {0}</div></body>"
    paragraph = "<p>" + "words of the story " * 20 + "</p>"
    rows = [(i, f"http://h.example/{i}", page.format(i, paragraph * (1 + i % 2 * (i < 9)))) for i in range(30)]
    found = {r["page_id"]: r["text"].split("\n") for r in html_text.extract(pages(spark, rows)).collect()}
    for i in range(30):
        assert found[i][0] == f"Title {i}"
        assert set(found[i][1:]) == {("words of the story " * 20).strip()}
        assert len(found[i]) == 2 + i % 2 * (i < 9)


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "no url", "<p>x"), (2, "http://H.example:80/a", "<p>y</p>"), (2, "http://H.example:80/a", "<p>y</p>"), (3, "http://u@h.example", "<p>" + "long " * 200_000)]
    found = html_text.extract(pages(spark, rows)).collect()
    assert sorted(r["n_chars"] for r in found) == [0, 1, 1, 1, 999_999]
    assert html_text.extract(pages(spark, [])).count() == 0


def test_repeated_article_is_not_a_template(spark):
    page = "<body><nav>m</nav><article><p>same words</p></article></body>"
    rows = [(i, f"http://h.example/{i}", page) for i in range(6)]
    assert {r["text"] for r in html_text.extract(pages(spark, rows)).collect()} == {"same words"}


def test_every_page_picks_its_own_slot(spark):
    """Some pages have their article elsewhere, and few have an element that the others lack."""
    line, story = "an intro of one line", [f"sentence {j} of the article with some more words" for j in range(12)]
    body = "".join(f"<p>{s}</p>" for s in story)
    usual = "<body><div class=wrap><div class=content>{1}</div></div><div class=low>call {0}</div></body>"
    other = "<body><div class=wrap><div class=content><p>{0}</p></div><div class=story>{1}</div></div></body>"
    odd = "<body><div class=lone><p>only {0} here</p></div></body>"
    rows = [(i, f"http://h.example/{i}", usual.format(i, body.replace("sentence", f"{i} sentence") * 3)) for i in range(60)]
    rows += [(i, f"http://h.example/{i}", other.format(line, body)) for i in range(60, 65)]
    rows += [(65, "http://h.example/65", odd.format(65))]
    found = {r["page_id"]: r["text"].split("\n") for r in html_text.extract(pages(spark, rows)).collect()}
    assert all(found[i] == [s.replace("sentence", f"{i} sentence") for s in story] * 3 for i in range(60))
    assert all(found[i][-12:] == story for i in range(60, 65))
    assert found[65] == ["only 65 here"]


LONG = "<p>" + "words of the article " * 20 + "</p>"
NAMED = [
    f"<div class='content-sidebar-wrap'><article>{LONG}</article></div>",
    f"<div class='sidebar'><article>{LONG}</article></div>",
    f"<div class='no-sidebar'>{LONG}</div><p>low</p>",
    f"<div class='page-with-sidebar'><p>k</p></div>{LONG}",
    f"<div class='widget'><p>all of it</p>{LONG}</div><p>low</p>",
    f"<article><h2 id='search'>Search</h2>{LONG}<section id='related-work'><h2>Related work</h2><p>r</p></section></article>",
    f"<article>{LONG}<section id='search'><p>s</p></section><div class='section' id='notice'><p>n</p></div></article>",
    f"<article>{LONG}<div id='comments-on-x'><p>c</p></div><section id='social-networks'><p>n</p></section></article>",
]


@pytest.mark.parametrize("page", NAMED)
def test_names_drop_no_article(page):
    assert html_text.main_text(page, []) == html_text.main_text(re.sub(r" (class|id)='[^']*'", "", page), [])


def test_names_drop_what_they_say():
    low = "<div class='related-posts'><article>a card</article></div><div id='nav-main'>n</div><div class='x sidebarLeft'>s</div>"
    low += "<section class='comment-list'>" + "<p>a long comment</p>" * 30 + "</section><div class='site-header'>h</div>"
    assert html_text.main_text(f"<article>{LONG}</article>{low}", []) == ("words of the article " * 20).strip()


def brute_templates(rows):
    """page -> template texts, by occurrence vectors over all pages of a host."""
    hosts = defaultdict(list)
    for key, url, page in rows:
        hosts[re.match(r"http://([^/:]*)", url)[1]].append((key, [b for b in html_text.blocks(page) if not b[2]]))
    out = {}
    for members in hosts.values():
        elements, texts = defaultdict(Counter), defaultdict(Counter)
        for key, found in members:
            for place in html_text._containers(found):
                elements[place][key] += 1
            for b in found:
                if not html_text._in_body(b):
                    for token in set(html_text._text_keys(b)):
                        texts[token][key] += 1  # how often it stands on the page
        least = min(html_text.MIN_SUPPORT, len(members))
        classes = {frozenset(v.items()) for v in elements.values() if len(v) >= least}
        for key, _ in members:
            out[key] = {
                t for t, v in texts.items()
                if v[key] and len(v) >= html_text.MIN_SUPPORT and len({*v.values()}) == 1
                and frozenset((k, 1) for k in v) in classes
            }
    return out


def blog(i, sections=2):
    """A page without any hint in its markup: menu, notice and footer around what is its own."""
    own = "".join(
        f"<div class=s{j}><h2>Part {j} of {i}</h2>" + "".join(f"<p>words {i * 7 + k} of part {j} told at some length</p>" for k in range(1 + (i + j) % 3)) + "</div>"
        for j in range(sections + i % 2)
    )
    note = "<div class=x1><p>we use small files on your device</p></div>" if i % 3 == 0 else ""
    return (
        f"<body><div class=top><div class=l1>Home</div><div class=l2>Archive</div><div class=l3>{i} comments</div></div>{note}"
        f"<div class=mid>{own}<p>Call our office for offers</p></div><div class=low>All rights with the house since {1990 + i}</div></body>"
    )


def own_blocks(i, sections=2):
    return [
        text for j in range(sections + i % 2)
        for text in [f"Part {j} of {i}", *(f"words {i * 7 + k} of part {j} told at some length" for k in range(1 + (i + j) % 3))]
    ]


def test_template_alone_tells_the_article_from_the_rest(spark, monkeypatch):
    monkeypatch.setattr(html_text, "APART_WORDS", set())
    rows = [(i, f"http://h{i % 2}.example/{i}", blog(i)) for i in range(36)]
    templates = brute_templates(rows)
    for i, _, page in rows:
        found = html_text.main_text(page, templates[i]).split("\n")
        assert found[: len(own_blocks(i))] == own_blocks(i)
        assert set(found) - set(own_blocks(i)) <= {f"All rights with the house since {1990 + i}"}


def test_templates_equal_brute_force(spark):
    rows = [(i, f"http://h{i % 3}.example/{i}", blog(i) if i % 5 else shop(i)) for i in range(45)]
    want = brute_templates(rows)
    assert any(want.values())
    found = {r["page_id"]: r["text"] for r in html_text.extract(pages(spark, rows)).collect()}
    assert found == {i: html_text.main_text(page, want[i]) for i, _, page in rows}


def test_nothing_outside_the_template_is_lost(spark):
    """Ten paragraphs in one container and the conclusion in another, both on every page."""
    page = "<body><div class=a>{0}</div><div class=b><p>what follows from all this is number {1} here</p></div><div class=c>the house</div></body>"
    story = ["".join(f"<p>page {i} says in sentence {j} what it says</p>" for j in range(10)) for i in range(12)]
    rows = [(i, f"http://h.example/{i}", page.format(story[i], i)) for i in range(12)]
    for r in html_text.extract(pages(spark, rows)).collect():
        i = r["page_id"]
        want = [f"page {i} says in sentence {j} what it says" for j in range(10)]
        assert r["text"].split("\n") == [*want, f"what follows from all this is number {i} here"]


def test_template_texts_inside_the_slot_go(spark):
    page = "<body><div class=a><p>story {0} begins here and goes on</p><p>Call our office for offers</p><p>story {0} ends</p></div></body>"
    rows = [(i, f"http://h.example/{i}", page.format(f"{i} {'abcdefgh'[i]}")) for i in range(8)]
    found = {r["page_id"]: r["text"] for r in html_text.extract(pages(spark, rows)).collect()}
    assert all("office" not in t and t.count("story") == 2 for t in found.values())


def test_an_advert_larger_than_the_article_goes():
    page = f"<div class='ad'>{LONG}</div><article><p>short</p></article>"
    assert html_text.main_text(page) == "short"
