"""Inverted indexes: word -> positions, and back.

Both directions work inside one row with higher-order functions, so no text is shuffled by word.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pubwatch.functions.text import let, strip_space, words


def restore_abstract(index: Column) -> Column:
    """Text of an inverted index, or NULL where there is none.

    Of two words at one position the later declared wins; each missing position leaves an empty
    word, so a gap of n positions shows as n + 1 spaces.
    """
    placed = F.flatten(
        F.transform(
            F.map_entries(index),
            lambda entry, order: F.transform(
                F.coalesce(entry["value"], F.array().cast("array<int>")),
                lambda position: F.struct(
                    position.alias("position"), order.alias("order"), entry["key"].alias("word")
                ),
            ),
        )
    )

    def spaced(all_: Column) -> Column:
        def word(x: Column, after: Column) -> Column:
            gap = after["position"] - x["position"]
            return (
                F.when(gap == 1, F.concat(x["word"], F.lit(" ")))
                .when(gap > 1, F.concat(x["word"], F.repeat(F.lit(" "), gap)))
                .when(gap.isNull(), x["word"])
            )

        # A word that a later one replaces has gap 0 and becomes NULL, which the join leaves out.
        following = F.slice(all_, 2, F.greatest(F.size(all_), F.lit(1)))
        return F.array_join(F.zip_with(all_, following, word), "")

    text = let(F.sort_array(placed), spaced)
    return F.nullif(strip_space(text), F.lit(""))


def index_entries(text: Column) -> Column:
    """``array<struct<key, value>>``: each word once, with its ascending positions from 0."""
    placed = F.sort_array(
        F.transform(words(text), lambda word, i: F.struct(word.alias("word"), i.alias("position")))
    )

    def entries(sorted_: Column) -> Column:
        starts = F.filter(
            F.transform(
                sorted_,
                lambda x, i: F.when(~F.get(sorted_, i - 1)["word"].eqNullSafe(x["word"]), i),
            ),
            lambda start: start.isNotNull(),
        )
        return let(
            starts,
            lambda firsts: F.transform(
                firsts,
                lambda start, j: F.struct(
                    F.get(sorted_, start)["word"].alias("key"),
                    # not by a slice, which copies the whole array for every word
                    F.transform(
                        F.sequence(start, F.coalesce(F.get(firsts, j + 1), F.size(sorted_)) - 1),
                        lambda i: F.get(sorted_, i)["position"],
                    ).alias("value"),
                ),
            ),
        )

    return let(placed, entries)


def build_inverted_index(text: Column) -> Column:
    """``map<word, positions>`` of a text."""
    return F.map_from_entries(index_entries(text))
