"""Ordered rewrite rules over HTML, applied in one projection."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``kind`` is ``regex`` or ``literal``. A regex replacement is literal text too."""

    kind: str
    pattern: str
    replacement: str

    def apply(self, html: Column) -> Column:
        if self.kind == "literal":
            return F.replace(html, F.lit(self.pattern), F.lit(self.replacement))
        if self.kind == "regex":
            literal = self.replacement.replace("\\", "\\\\").replace("$", "\\$")
            return F.regexp_replace(html, F.lit(self.pattern), F.lit(literal))
        raise ValueError(f"unknown rule kind: {self.kind}")


def apply_rules(html: Column, rules: Iterable[Rule]) -> Column:
    """The page after all rules, each working on the result of the one before."""
    return reduce(lambda text, rule: rule.apply(text), rules, html)
