"""Production indicators. ``cols`` names the input columns; constants are parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farmledger.functions import ratios
from farmledger.operators.joins import lag_join, std_lookup
from farmledger.operators.ordered import cumulate


def kpi_efficiency_index(df: DataFrame, cols: Mapping[str, str], out: str = "efficiency_index") -> DataFrame:
    c = {k: F.col(v) for k, v in cols.items()}
    return df.withColumn(out, ratios.efficiency_index(c["mort_pct"], c["weight"], c["age"], c["conversion"]))


def kpi_adjusted_conversion(
    df: DataFrame,
    cols: Mapping[str, str],
    rules: Sequence[tuple[Column, float, float]],
    default: tuple[float, float],
    out: str = "adjusted_conversion",
) -> DataFrame:
    """``rules`` are (condition, reference weight, divisor); the first that holds applies."""
    ref, div = F.lit(default[0]), F.lit(default[1])
    for cond, r, d in reversed(rules):
        ref, div = F.when(cond, r).otherwise(ref), F.when(cond, d).otherwise(div)
    return df.withColumn(out, ratios.adjusted_conversion(F.col(cols["weight"]), F.col(cols["conversion"]), ref, div))


def kpi_use_per_thousand(
    heads: DataFrame,
    use: DataFrame,
    key: str,
    cols: Mapping[str, str],
    factors: Mapping[str, Mapping[str, float]],
    scale: int = 4,
) -> DataFrame:
    """Utility use per 1000 heads: each utility is a weighted sum of products (``factors``: utility -> product -> factor).

    ``cols``: ``heads`` in the placement frame, ``product`` and ``quantity`` in the usage frame. All placements stay; no
    use is 0. Placements and usage are reduced to one row per entity before they meet.
    """
    product, qty = F.col(cols["product"]), F.col(cols["quantity"])
    sums = [
        F.sum(
            F.coalesce(*[F.when(product == p, qty * f) for p, f in parts.items()], F.lit(0.0))
        ).alias(f"__{utility}")
        for utility, parts in factors.items()
    ]
    used = use.groupBy(key).agg(*sums)
    placed = heads.groupBy(key).agg(F.max(cols["heads"]).alias("__heads"))
    return placed.join(used, key, "left").select(
        key, *[ratios.per_thousand(F.coalesce(F.col(f"__{u}"), F.lit(0.0)), "__heads", scale).alias(u) for u in factors]
    )


def kpi_per_thousand_by_state(
    df: DataFrame, cols: Mapping[str, str], denominators: Sequence[tuple[Column, str]], default: str,
    out: str = "per_thousand", scale: int = 4,
) -> DataFrame:
    """Quantity per 1000 with the denominator chosen by the row's state."""
    denominator = F.col(default)
    for cond, name in reversed(denominators):
        denominator = F.when(cond, F.col(name)).otherwise(denominator)
    return df.withColumn(out, ratios.per_thousand(F.col(cols["quantity"]), denominator, scale))


def phase_from_rules(
    df: DataFrame, cols: Mapping[str, str], rules: Sequence[tuple[Mapping[str, str], int | None, int | None, str]],
    out: str = "phase",
) -> DataFrame:
    """Feed phase from age and attributes. A rule is ({column: value}, first day, last day, label); None is open."""
    age = F.col(cols["age"])
    label = F.lit(None).cast("string")
    for attributes, lo, hi, name in reversed(rules):
        test = F.lit(True)
        for c, v in attributes.items():
            test = test & (F.upper(F.col(c)) == v.upper())
        if lo is not None:
            test = test & (age >= lo)
        if hi is not None:
            test = test & (age <= hi)
        label = F.when(test, name).otherwise(label)
    return df.withColumn(out, label)


def kpi_stage_denominator(
    df: DataFrame, cols: Mapping[str, str], early_stage, measures: Mapping[str, str], scale: int = 4
) -> DataFrame:
    """Percentages over the intake during the early stage and over the capitalised heads afterwards."""
    base = F.when(F.col(cols["stage"]) == early_stage, F.col(cols["intake"])).otherwise(F.col(cols["capitalised"]))
    return df.withColumns({out: ratios.safe_pct(F.col(m), base, scale) for out, m in measures.items()})


def kpi_vs_standard(
    df: DataFrame, std: DataFrame, keys: Sequence[str], cols: Mapping[str, str], scale: int = 4
) -> DataFrame:
    """Actual against the standard of the age rounded up: value, standard and difference; a missing standard counts 0."""
    met = std_lookup(df, std, keys, F.col(cols["age"]), cols["std_age"])
    actual, standard = F.col(cols["actual"]), F.coalesce(F.col(cols["standard"]), F.lit(0.0))
    return met.select(
        *df.columns, cols["std_age"], standard.alias("standard"), ratios.fixed(actual - standard, scale).alias("difference")
    )


def row_extremes(df: DataFrame, cols: Sequence[str], scale: int = 4) -> DataFrame:
    """Highest, lowest and mean of several columns of one row."""
    cs = [F.col(c) for c in cols]
    total = cs[0]
    for c in cs[1:]:
        total = total + c
    return df.withColumns(
        {"row_max": F.greatest(*cs), "row_min": F.least(*cs), "row_mean": ratios.fixed(total / len(cs), scale)}
    )


def opening_balance(
    df: DataFrame, key: Sequence[str], day: str, exits: str, population: str, out: str = "opening"
) -> DataFrame:
    """Population less everything that left up to the day before; NULL when that day has no row.

    One row per key and day is expected.
    """
    run = cumulate(df, key, [day], [], {"__exits": ("sum", exits)})
    closing = run.withColumn("__closing", F.col(population) - F.col("__exits")).select(*df.columns, "__closing")
    return lag_join(closing, key, day, {out: "__closing"}).drop("__closing")
