"""Code, key and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Number of trailing characters that a key loses on the way up the FARM-LOT-HOUSE-PEN hierarchy.
LEVEL_SUFFIX = {"pen": 0, "house": 3, "lot": 6}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parent_key(c: str | Column, level: str) -> Column:
    c = _col(c)
    cut = LEVEL_SUFFIX[level]
    return F.substring(c, F.lit(1), F.length(c) - F.lit(cut)) if cut else c


def entity_code(*cols: str | Column) -> Column:
    """Upper-case parts without trailing blanks, joined by dashes."""
    return F.concat_ws("-", *[F.upper(F.rtrim(_col(c).cast("string"))) for c in cols])


def like_label(c: str | Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """Label of the first LIKE pattern that the text matches."""
    c = _col(c)
    (pattern, label), *rest = rules
    out = F.when(c.like(pattern), label)
    for pattern, label in rest:
        out = out.when(c.like(pattern), label)
    return out.otherwise(F.lit(default))


def string_list(c: str | Column, sep: str = ",") -> Column:
    """Aggregate: distinct values, sorted, as one delimited text. Feed it distinct rows (see ``agg_string_list``)."""
    return F.concat_ws(sep, F.sort_array(F.collect_set(_col(c).cast("string"))))


def zero_blank(c: str | Column) -> Column:
    """Text that is NULL or blank becomes '0'."""
    return F.coalesce(F.nullif(F.trim(_col(c).cast("string")), F.lit("")), F.lit("0"))
