"""Main text of web pages by template deduction from the pages of a host.

A token is an element in its place (its tag, class and id below those of its ancestors) or a block
of running text in its place; a short text that differs in its numbers only is one token as well.
The occurrence vector of a token tells how often it stands on each page of its host. Tokens with
equal vectors form an equivalence class. A class is valid if it has an element and stands once on
each of at least ``MIN_SUPPORT`` pages; a text that stands twice where its class stands once belongs
to it as well, and so on. Valid classes nest, as a token's place names its ancestors,
and make up the template; what stands between their tokens are slots. All slots of a page together
are its text: every block that is no text of the template, in page order.

Where a class cannot tell, as a part differs from page to page, the page's own markup does: menus,
adverts, forms, comments and so on are left out by tag, role, class and id. Texts inside an
``article`` or ``main`` are never the template's, and a page of which nothing would be left is kept
whole: it then is one of several copies.

An occurrence vector never leaves its page: each page adds a random number of its own per token,
and equal sums stand for equal vectors. Pages with the same containers share a layout, and what a
page needs to know comes by its layout, so a host with a third of all pages costs no more than any
other, and no list is longer than a page.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Collection, Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubwatch.llm.common import materialise

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
NUMBER = re.compile(r"\d+")
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW = ("script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes", "plaintext")
VOID = {*"area base br col embed hr img input link meta param source track wbr".split()}
INLINE = {
    *"a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var nobr label".split()
}
#: parts of a page that are not running text, by tag, by role and by words in class or id
APART_TAGS = {
    *"head script style title nav footer aside form noscript template iframe svg canvas button select"
    " textarea dialog menu object audio video datalist fieldset option noembed noframes".split()
}
APART_ROLES = {*"navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split()}
APART_WORDS = {
    *"ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar"
    " navigation menu menubar breadcrumb breadcrumbs sidebar aside footer cookie cookies consent gdpr notice"
    " notification alert popup modal overlay newsletter subscribe subscription signup login search share"
    " sharing social related recommended recommendations comment comments disqus respond reply replies"
    " pagination pager widget toolbar skip topbar masthead".split()
}
#: words that stand beside those in a name without changing what it says
PLAIN_WORDS = {
    *"post posts link links item items list lists wrap wrapper container box block area section inner outer left"
    " right center top bottom main primary secondary site page global slot unit button buttons bar icon icons"
    " panel group header title text form fixed sticky mobile desktop large small mini first last thread js wp".split()
}
COMMENT_WORDS = {*"comment comments disqus respond reply replies".split()}
BODY = ("article", "main")
CLOSES_P = {
    *"address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2"
    " h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: elements that hold one block; a slot holds many
SINGLE = {*"p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figcaption caption summary address tr ul ol dl".split()}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: pages that a valid class stands on at least, or all pages of a host with fewer
MIN_SUPPORT = 3
#: a text of more words is never one with others that differ in their numbers
FIELD_WORDS = 5
#: a name says nothing about an element with more than this share of the page's running text
MOST, MOST_COMMENTS = 0.5, 0.9

#: tag, place, apart, inside article or main, number on the page
Element = tuple[str, str, bool, bool, int]
Block = tuple[str, int, bool, tuple[Element, ...]]


def _attributes(text: str) -> dict[str, str]:
    if not text or text.isspace():
        return {}
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)}


def _name(tag: str, attributes: dict[str, str]) -> str:
    """The element in its template: numbers in class or id differ from page to page."""
    words = f".{attributes['class']}" if attributes.get("class") else ""
    words += f"#{attributes['id']}" if attributes.get("id") else ""
    return tag + re.sub(r"\d+", "0", " ".join(words.split())).replace("/", "_")


def _apart(tag: str, attributes: dict[str, str], in_body: bool) -> bool:
    """Whether tag, role or style declare the element to be something else."""
    if tag in APART_TAGS or (tag == "header" and not in_body):
        return True
    if not attributes or tag in BODY or tag in ("html", "body"):
        return False
    if attributes.get("role", "").lower() in APART_ROLES or "hidden" in attributes:
        return True
    return bool(re.search(r"display\s*:\s*none", attributes.get("style", "")))


def _named_apart(tag: str, attributes: dict[str, str], in_body: bool) -> set[str]:
    """The words by which a whole class name or id says that the element is something else.

    All words of the name have to say so or be plain. The id of a heading or of a section inside an
    article may be a slug of its title; of a section only comments are told by it.
    """
    if not attributes or tag in BODY or tag in HEADINGS or tag in ("html", "body"):
        return set()
    classes = attributes.get("class", "").split()
    said = APART_WORDS if in_body else APART_WORDS | {"header"}
    titled = in_body and (tag == "section" or "section" in classes)
    found: set[str] = set()
    for name, known in [*((c, said) for c in classes), (attributes.get("id", ""), COMMENT_WORDS if titled else said)]:
        words = set(re.findall(r"[^\W\d_]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()))
        if words <= known | PLAIN_WORDS:
            found |= words & known
    return found


def _really_apart(out: list[Block], named: dict[int, set[str]]) -> set[int]:
    """Those of the elements named to be apart that are: not what holds most of the article or of the page.

    Where a page has an article, an element without any of it is what its name says, whatever its size.
    """
    if not named:
        return set()
    page, article = 0, 0
    held: dict[int, list[int]] = {number: [0, 0, 0] for number in named}
    for text, linked, apart, elements in out:
        if apart:
            continue
        n, in_body = len(text) - linked, bool(elements) and elements[-1][3]
        page, article = page + n, article + n * in_body
        outside = True
        for tag, _, _, _, number in elements:
            if number in held:
                held[number][0] += n
                # below the element, not around it
                held[number][1] += n if in_body and outside else 0
                held[number][2] += n * in_body
            outside = outside and tag not in BODY
    return {
        number
        for number, words in named.items()
        if (article and not held[number][2])
        or not held[number][1] > MOST * article
        and not held[number][0] > (MOST_COMMENTS if words <= COMMENT_WORDS else MOST) * page
    }


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order: text, characters of it inside links, apart or not, elements.

    What class or id call apart is judged when the whole page is known: not if it holds most of the
    page's running text, or of what its articles hold.

    Character references are decoded, white space is one space, markup is gone. Ends of elements
    that HTML lets authors leave out are supplied; a page may break off anywhere.
    """
    out: list[Block] = []
    stack: list[Element] = []
    named: dict[int, set[str]] = {}
    opened = 0
    parts: list[str] = []
    link_parts: list[str] = []
    in_link, at, size = False, 0, len(page)

    def flush() -> None:
        nonlocal parts, link_parts
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                linked = len(" ".join(html.unescape("".join(link_parts)).split()))
                apart = stack[-1][2] if stack else False
                out.append((text, linked, apart, tuple(stack)))
            parts, link_parts = [], []

    def close(index: int) -> None:
        flush()
        del stack[index:]

    while at < size:
        match = TAG.search(page, at)
        start = match.start() if match else size
        if start > at:
            parts.append(page[at:start])
            if in_link:
                link_parts.append(page[at:start])
        if match is None:
            break
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if match[1]:
            if tag == "a":
                in_link = False
            elif tag == "br":
                parts.append(" ")
            if tag in INLINE or tag in VOID:
                continue
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
            else:
                flush()
            continue
        if tag == "a":
            in_link = True
        if tag in VOID or tag in INLINE:
            if tag in ("br", "img", "wbr", "input"):
                parts.append("" if tag == "wbr" else " ")
            elif tag == "hr":
                flush()
            continue
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    close(i)
                    break
        if tag in SIBLINGS:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ("ul", "ol", "dl", "table", "select"):
                    break
                if stack[i][0] in SIBLINGS[tag]:
                    close(i)
                    break
        if tag == "body" or (tag in CLOSES_P and stack and stack[-1][0] == "head"):
            for i, entry in enumerate(stack):
                if entry[0] == "head":
                    close(i)
                    break
        flush()
        attributes = _attributes(match[3])
        _, above, apart, in_body, _ = stack[-1] if stack else ("", "", False, False, 0)
        apart = apart or _apart(tag, attributes, in_body)
        opened += 1
        if words := set() if apart else _named_apart(tag, attributes, in_body):
            named[opened] = words
        place = f"{above}/{_name(tag, attributes)}"
        stack.append((tag, place, apart, in_body or tag in BODY, opened))
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            parts.append(page[at : end.start() if end else size])
            close(len(stack) - 1)
            at = end.end() if end else size
    flush()
    gone = _really_apart(out, named)
    if gone:
        out = [(t, n, apart or any(e[4] in gone for e in elements), elements) for t, n, apart, elements in out]
    return out


def _hash(text: str) -> int:
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


def _text_keys(block: Block) -> tuple[int, int]:
    """The tokens of a text in its place: as it is, and if it is short and no heading without its numbers."""
    text, elements = block[0], block[3]
    place = elements[-1][1] if elements else ""
    exact = _hash(f"{place}\n{text}")
    if (elements and elements[-1][0] in HEADINGS) or len(text.split(maxsplit=FIELD_WORDS)) > FIELD_WORDS:
        return exact, exact
    return exact, _hash(f"{place}\n{NUMBER.sub('0', text)}")


def _in_body(block: Block) -> bool:
    return bool(block[3]) and block[3][-1][3]


def _containers(found: list[Block]) -> dict[str, int]:
    """Place to number of the containers that stand once on the page."""
    numbers: dict[str, set[int]] = {}
    for block in found:
        for tag, place, _, _, number in block[3]:
            if tag not in SINGLE:
                numbers.setdefault(place, set()).add(number)
    return {place: next(iter(n)) for place, n in numbers.items() if len(n) == 1}


def _layout(host: str, places: Iterable[str]) -> tuple[int, list[int]]:
    """The layout of a page, and hashes of the containers that stand on it once."""
    tokens = sorted(map(_hash, places))
    return _hash(f"{host}\n{tokens}"), tokens


def _host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))


def templates(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """layout, template: hashes of the template's texts, for pages of that layout."""
    rows = pages.select(
        _host(F.col(url_col)).alias("host"),
        F.coalesce(F.xxhash64(id_col, url_col), F.lit(0)).alias("mark"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[tuple[int, bool, int], list] = {}
            for name, mark, page in zip(*(batch.column(i) for i in range(3)), strict=True):
                host, found = name.as_py(), [b for b in blocks(page.as_py()) if not b[2]]
                mixed = (mark.as_py() & (1 << 64) - 1) * 0x9E3779B97F4A7C15
                layout, tokens = _layout(host, _containers(found))
                texts = Counter()
                for block in found:
                    if not _in_body(block):
                        texts.update(set(_text_keys(block)))
                entries = [(layout, False, tokens, 1), *((k, True, None, n) for k, n in texts.items())]
                for key, is_text, inside, times in entries:
                    s = sums.setdefault((_hash(host), is_text, key), [inside, times, times, 0, 0, 0])
                    s[1], s[2] = min(s[1], times), max(s[2], times)
                    s[3] += 1
                    s[4] += mixed >> 7 & 0x3FFFFFFF
                    s[5] += mixed >> 37 & 0x3FFFFFFF
            if sums:
                hosts, kinds, keys = zip(*sums, strict=True)
                columns = [pa.array(hosts, pa.int64()), pa.array(kinds), pa.array(keys, pa.int64())]
                columns += [pa.array([s[0] for s in sums.values()], pa.list_(pa.int64()))]
                columns += [pa.array([s[i] for s in sums.values()], pa.int64()) for i in range(1, 6)]
                yield pa.RecordBatch.from_arrays(columns, [*names[:4], "fewest", "most", *names[4:]])

    names = ["host", "is_text", "key", "tokens", "pages", "sum1", "sum2"]
    schema = "host bigint, is_text boolean, key bigint, tokens array<bigint>, fewest bigint, most bigint"
    vector = [F.sum(c).alias(c) for c in names[4:]]
    stats = rows.mapInArrow(run, f"{schema}, pages bigint, sum1 bigint, sum2 bigint").groupBy(*names[:3])
    often = [F.min("fewest").alias("fewest"), F.max("most").alias("most")]
    stats = stats.agg(F.first("tokens").alias("tokens"), *often, *vector)
    # a text on fewer pages is never the template's, nor one that stands more often on some than on others
    steady = (F.col("pages") >= MIN_SUPPORT) & (F.col("fewest") == F.col("most"))
    stats = materialise(stats.where(~F.col("is_text") | steady).drop("fewest", "most"), "html-tokens")
    layouts = stats.where(~F.col("is_text")).drop("is_text")
    whole = layouts.groupBy("host").agg(F.sum("pages").alias("host_pages"))
    carried = layouts.select("host", F.col("key").alias("layout"), F.explode("tokens").alias("token"), *names[4:])
    valid = carried.groupBy("host", "token").agg(*vector).join(whole, "host")
    valid = valid.where(F.col("pages") >= F.least(F.lit(MIN_SUPPORT), "host_pages")).drop("host_pages")
    carried = materialise(carried.select("host", "layout", "token").join(valid, ["host", "token"]), "html-classes")
    texts = stats.where("is_text").select("host", "key", *names[4:])
    same = carried.select("host", "layout", *names[4:]).distinct()
    return same.join(texts, ["host", *names[4:]]).groupBy("layout").agg(F.collect_set("key").alias("template"))


def main_text(page: str, template: Collection[int] = ()) -> str:
    """The blocks of the page that are no texts of the template, or all if none are left."""
    found = [b for b in blocks(page) if not b[2]]
    left = [b for b in found if _in_body(b) or not any(k in template for k in _text_keys(b))]
    return "\n".join(b[0] for b in left or found)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text, n_chars, per row of ``pages``.

    * NULL or empty html gives an empty text. A NULL or odd URL belongs to the host "".
    * A host with one page is its own template. Repeated rows and NULL ids pass through as they are.
    * An empty table gives an empty result; other columns are neither read nor returned.
    """
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
        _host(F.col(url_col)).alias("host"),
    )
    kind = rows.schema["id"].dataType.simpleString()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            layouts, texts, keys = [], [], []
            for host, page in zip(batch.column("host"), batch.column("html"), strict=True):
                found = [b for b in blocks(page.as_py()) if not b[2]]
                layouts.append(_layout(host.as_py(), _containers(found))[0])
                texts.append([b[0] for b in found])
                keys.append([[] if _in_body(b) else [*_text_keys(b)] for b in found])
            columns = [batch.column("id"), batch.column("url"), pa.array(layouts, pa.int64())]
            columns += [pa.array(texts, pa.list_(pa.string())), pa.array(keys, pa.list_(pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "url", "layout", "texts", "keys"])

    parsed = rows.mapInArrow(
        parse, f"id {kind}, url string, layout bigint, texts array<string>, keys array<array<bigint>>"
    )
    joined = parsed.join(templates(pages, id_col, url_col, html_col), "layout", "left")
    known = F.coalesce("template", F.array().cast("array<bigint>"))
    left = F.filter(F.arrays_zip("texts", "keys"), lambda b: ~F.arrays_overlap(b["keys"], known))
    kept = F.when(F.size(left) > 0, F.transform(left, lambda b: b["texts"])).otherwise(F.col("texts"))
    texts = joined.select("id", "url", F.array_join(kept, "\n").alias("text"))
    return texts.select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.char_length("text").cast("long").alias("n_chars")
    )
