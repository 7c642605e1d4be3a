"""Text expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from camstat.functions.ids import ColLike, _c


def replace_all(c: ColLike, pattern: str, repl: str, fixed: bool = False) -> Column:
    """replace every match (regex unless ``fixed``)."""
    if fixed:
        return F.replace(_c(c), F.lit(pattern), F.lit(repl))
    return F.regexp_replace(_c(c), pattern, repl)


def remove_first(c: ColLike, pattern: str, fixed: bool = False) -> Column:
    """remove the first match only."""
    pat = re.escape(pattern) if fixed else pattern
    # (?s) lets '.' span lines; the lazy prefix keeps the earliest match.
    return F.regexp_replace(_c(c), f"(?s)^(.*?)(?:{pat})(.*)$", "$1$2")


def detect(c: ColLike, pattern: str, fixed: bool = False) -> Column:
    """F3."""
    return _c(c).contains(pattern) if fixed else _c(c).rlike(pattern)


def thousands(c: ColLike) -> Column:
    """``1,234,567``."""
    return F.format_number(_c(c).cast("double"), 0)


def pct2(num: ColLike, den: ColLike) -> Column:
    """percent rounded half-even to two places."""
    return F.bround(_c(num) * 100.0 / _c(den), 2)
