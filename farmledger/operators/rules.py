"""Rule tables: classification rules as rows, so that a rule is added by adding a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farmledger.operators.joins import join_same


def classify(
    df: DataFrame, rules: DataFrame, on: Sequence[str], value: str, out: str, priority: str = "priority",
    ranged: str | None = None, lo: str = "lo", hi: str = "hi", default: str | None = None,
) -> DataFrame:
    """Value of the first rule (lowest ``priority``, ties by the lowest value) that fits each row, else ``default``.

    A rule fits where each of its ``on`` columns is null (a wildcard) or equal to the row's, and the row's ``ranged`` value
    lies in its ``lo``..``hi`` (inclusive; a null end is open). Rules with the same wildcards are met by one equality join,
    so the plan grows with the sorts of wildcards (2 to the number of columns at most), not with the rules. Rules are met by
    the distinct values of the rows' columns, and one rule a combination goes back to the rows: no row multiplies.
    """
    names = [*on, *([ranged] if ranged else [])]
    cases = df.select(*names).distinct()
    shapes = rules.select(*[F.col(c).isNull().alias(c) for c in on]).distinct().collect()  # at most 2 ^ len(on) rows
    found = None
    for shape in sorted(shapes):
        equal = [c for c in on if not shape[c]]
        same = F.lit(True)
        for c in on:
            same = same & (F.col(c).isNull() if shape[c] else F.col(c).isNotNull())
        side = rules.where(same).select(*[F.col(c).alias(f"__r_{c}") for c in equal], *([lo, hi] if ranged else []), F.struct(priority, value).alias("__rule"))
        fits = F.lit(True)
        for c in equal:
            fits = fits & (F.col(c) == F.col(f"__r_{c}"))
        if ranged:
            fits = fits & (F.col(lo).isNull() | (F.col(ranged) >= F.col(lo))) & (F.col(hi).isNull() | (F.col(ranged) <= F.col(hi)))
        met = cases.join(side, fits).select(*names, "__rule")
        found = met if found is None else found.unionByName(met)
    fallback = F.lit(default).cast(rules.schema[value].dataType)
    if found is None:
        return df.withColumn(out, fallback)
    first = found.groupBy(*names).agg(F.min("__rule").alias("__rule"))
    joined = join_same(df, first, names)
    chosen = F.when(F.col("__rule").isNull(), fallback).otherwise(F.col(f"__rule.{value}")).alias(out)
    return joined.select(*df.columns, chosen)
