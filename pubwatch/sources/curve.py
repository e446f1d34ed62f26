"""Row order along a space-filling curve, so that files and row groups are narrow in several columns."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: values looked at per column to find the cuts
SAMPLE = 20_000


def cuts(rows: DataFrame, bits: Mapping[str, int], n_rows: int) -> dict[str, list]:
    """Per column up to 2**bits - 1 values that deal a sample of the rows out evenly, in order."""
    fraction = min(1.0, SAMPLE / max(n_rows, 1))
    sample = rows.select(*bits).sample(fraction, seed=1).toPandas()  # about SAMPLE rows
    found = {}
    for name, count in bits.items():
        values = sorted(sample[name].dropna())
        parts = 1 << count
        picked = [values[len(values) * i // parts] for i in range(1, parts)] if values else []
        found[name] = sorted(set(picked))
    return found


def position(bits: Mapping[str, int], cut: Mapping[str, list]) -> Column:
    """Place on a Z-order curve: the bits of the columns' ranks, interleaved by their weight.

    A column's rank is the number of cuts not above its value, 0 for NULL. The first bit of each
    column comes early, so a range in any of them meets few stretches of the curve.
    """
    turns = sorted((((i + 0.5) / count, name, i) for name, count in bits.items() for i in range(count)))
    ranks = {}
    for name in bits:
        above = [F.coalesce(F.col(name) >= F.lit(c), F.lit(False)).cast("int") for c in cut[name]]
        ranks[name] = reduce(Column.__add__, above, F.lit(0))
    place = F.lit(0).cast("long")
    for _, name, i in turns:
        bit = F.shiftright(ranks[name], bits[name] - 1 - i).bitwiseAND(F.lit(1))
        place = F.shiftleft(place, 1).bitwiseOR(bit.cast("long"))
    return place
