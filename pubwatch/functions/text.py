"""Text functions for labels, links, recipients, sentences and templates."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pubwatch.functions import fixed

SENTENCE_PATTERN = r"[^.!?]+[.!?]*"
TOKEN_PATTERN = r"[\p{L}\p{N}]{4,}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a lambda variable, so that ``body`` may use it often at one evaluation."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip_space(text: Column) -> Column:
    """Remove all leading and trailing whitespace; ``trim`` alone removes only spaces."""
    return F.btrim(text, F.lit(fixed.WHITESPACE))


def words(text: Column) -> Column:
    """Whitespace-separated words of a text, none of them empty."""
    return F.filter(F.split(text, fixed.WHITESPACE_PATTERN), lambda word: word != "")


def parse_labels(text: Column, fallback_he: str) -> Column:
    """``struct<en, he>`` of a labelled response; an unlabelled one is all English."""
    cleaned = strip_space(text)
    labelled = F.contains(cleaned, F.lit(fixed.ENGLISH_LABEL)) & F.contains(
        cleaned, F.lit(fixed.HEBREW_LABEL)
    )
    before = F.split_part(cleaned, F.lit(fixed.HEBREW_LABEL), F.lit(1))
    after = F.split_part(cleaned, F.lit(fixed.HEBREW_LABEL), F.lit(2))
    english = strip_space(F.replace(before, F.lit(fixed.ENGLISH_LABEL), F.lit("")))
    return F.struct(
        F.when(labelled, english).otherwise(cleaned).alias("en"),
        F.when(labelled, strip_space(after)).when(cleaned.isNotNull(), F.lit(fallback_he)).alias("he"),
    )


def absolutise_links(html: Column, page_url: Column | str) -> Column:
    """Point links to article anchors at ``page_url``; other links stay as they are."""
    url = F.lit(page_url) if isinstance(page_url, str) else page_url
    escaped = F.replace(F.replace(url, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
    return F.regexp_replace(
        html, F.lit(fixed.ANCHOR_LINK_PATTERN), F.concat(F.lit('href="'), escaped, F.lit('#$1"'))
    )


def extract_anchors(html: Column) -> Column:
    """All article anchors that a text links to, in order, repeats included."""
    return F.regexp_extract_all(html, F.lit(fixed.ANCHOR_LINK_PATTERN), F.lit(1))


def split_recipients(text: Column) -> Column:
    """Comma-separated addresses as an array, stripped, without empty ones."""
    parts = F.transform(F.split(text, ","), strip_space)
    return F.filter(parts, lambda part: part != "")


def escape_html(text: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def title_preview(title: Column, length: int = 40) -> Column:
    """Start of a title for the run log."""
    return F.concat(F.left(title, F.lit(length)), F.lit("..."))


def sentences(text: Column) -> Column:
    """Sentences of a text in reading order; a trailing piece without a full stop counts."""
    flat = F.regexp_replace(text, fixed.WHITESPACE_PATTERN, " ")
    found = F.transform(F.regexp_extract_all(flat, F.lit(SENTENCE_PATTERN), F.lit(0)), lambda s: F.trim(s))
    return F.filter(found, lambda sentence: sentence != "")


def lead_sentences(text: Column, count: int) -> Column:
    """Extractive summary: the first ``count`` sentences. The rest of the text is not split."""
    lead = F.regexp_extract(text, rf"^[.!?]*((?:{SENTENCE_PATTERN}){{1,{count}}})", 1)
    return F.array_join(sentences(lead), " ")


def tokens(text: Column) -> Column:
    """Distinct lower-case words of four characters or more."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0)))


def fill(template: str, **values: Column) -> Column:
    """A template with ``{name}`` slots as one concatenation; values are never re-scanned."""
    pieces = re.split(r"\{(\w+)\}", template)
    parts = [
        F.coalesce(values[piece], F.lit("")) if i % 2 else F.lit(piece)
        for i, piece in enumerate(pieces)
        if piece
    ]
    return F.concat(*parts)
