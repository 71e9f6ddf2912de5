"""Join shapes beyond the plain equi-join.

No join carries a broadcast hint: the optimiser broadcasts a side only when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, with skewed partitions split at run time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farmledger.operators.merge import one_per_key
from farmledger.operators.ordered import cumulate
from farmledger.session import scratch_path

Expr = str | Column


def _col(c: Expr) -> Column:
    return F.col(c) if isinstance(c, str) else c


def join_same(a: DataFrame, b: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on which NULL keys match each other, as they do in a window partition."""
    side = b.withColumnsRenamed({k: f"__j_{k}" for k in on})
    cond = [F.col(k).eqNullSafe(F.col(f"__j_{k}")) for k in on]
    return a.join(side, cond, how).drop(*[f"__j_{k}" for k in on])


def left_chain(df: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Left joins against several dimensions, fact first."""
    for dim, on in dims:
        df = df.join(dim, list(on), "left")
    return df


def salted_join(
    big: DataFrame, small: DataFrame, on: Sequence[str], spread: Sequence[str], salts: int, how: str = "left"
) -> DataFrame:
    """Equi-join that spreads each key over ``salts`` tasks: ``small`` is repeated, ``big`` is dealt out by ``spread``.

    For sides that are too large to broadcast and whose hot key is known beforehand.
    """
    dealt = big.withColumn("__salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
    repeated = small.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return dealt.join(repeated, [*on, "__salt"], how).drop("__salt")


def with_scalar(df: DataFrame, one_row: DataFrame, names: Sequence[str]) -> DataFrame:
    """Put the columns of a one-row aggregate on every row, as scalar subqueries (more than one row is an error)."""
    pack = one_row.select(F.struct(*names).alias("__pack")).scalar()
    return df.withColumn("__pack", pack).select(*df.columns, *[F.col(f"__pack.{n}").alias(n) for n in names])


def lookahead_max(df: DataFrame, key: Sequence[str], day: str, col: str, n: int, out: str) -> DataFrame:
    """Highest ``col`` of the days ``day`` .. ``day + n`` of the same key, on every row.

    Readings are reduced to one per day, and each is offered to the ``n + 1`` days that can see it, so the work is
    spread over (key, day) and a key with a long history needs no task of its own.
    """
    daily = df.groupBy(*key, day).agg(F.max(col).alias("__best"))
    offered = daily.select(
        *key, F.explode(F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: F.col(day) - i)).alias(day), "__best"
    )
    best = offered.groupBy(*key, day).agg(F.max("__best").alias(out))
    return df.join(best, [*key, day], "left")


def asof_max(left: DataFrame, right: DataFrame, key: Sequence[str], day: str, cols: Mapping[str, str]) -> DataFrame:
    """Highest right-hand values dated on or before each left-hand day; 0 when there are none.

    The days of both sides form one timeline per key, at most one row per day, on which a running maximum answers every
    day at once; the left-hand rows then look their day up.
    """
    probes = left.select(*key, day).distinct()
    daily = right.groupBy(*key, day).agg(*[F.max(F.col(c).cast("double")).alias(o) for o, c in cols.items()])
    line = probes.unionByName(daily, allowMissingColumns=True).groupBy(*key, day).agg(*[F.max(o).alias(o) for o in cols])
    held = cumulate(line.withColumnsRenamed({o: f"__r_{o}" for o in cols}), key, [day], [], {o: ("max", f"__r_{o}") for o in cols})
    found = join_same(left, held.select(*key, day, *cols), [*key, day])
    return found.select(*left.columns, *[F.coalesce(o, F.lit(0.0)).alias(o) for o in cols])


def interval_join(
    events: DataFrame,
    entities: DataFrame,
    key: Sequence[str],
    ts: str,
    lo: str,
    hi: str,
    bucket_days: int = 32,
    long_span: int = 64,
) -> DataFrame:
    """Events joined to the entities of the same key whose span ``lo``..``hi`` (inclusive) holds the event date.

    The equi-key gains a time bucket: an entity is listed in every bucket it spans, an event falls into one, so a key
    with many events and many spans does not compare all of them with each other. Spans of more than ``long_span``
    buckets, such as open-ended ones, are not listed there: :func:`sweep_join` cuts their keys' timelines by the number of
    events instead. It is given the events between the first begin and the last end of such spans, so without any it has none.
    """
    origin = F.lit(dt.date(1900, 1, 1))

    def bucket(c: Column) -> Column:
        return F.floor(F.datediff(c.cast("date"), origin) / bucket_days)

    def met(e: DataFrame, s: DataFrame, on: Sequence[str]) -> DataFrame:
        e, s = e.alias("e"), s.alias("s")
        cond = (F.col(f"e.{ts}") >= F.col(f"s.{lo}")) & (F.col(f"e.{ts}") <= F.col(f"s.{hi}"))
        for k in on:
            cond = cond & (F.col(f"e.{k}") == F.col(f"s.{k}"))
        extra = [F.col(f"s.{c}") for c in entities.columns if c not in key]
        return e.join(s, cond).select(*[F.col(f"e.{c}") for c in events.columns], *extra)

    valid = entities.where(F.col(lo) <= F.col(hi))
    length = bucket(F.col(hi)) - bucket(F.col(lo))
    listed = valid.where(length <= long_span).withColumn("__bucket", F.explode(F.sequence(bucket(F.col(lo)), bucket(F.col(hi)))))
    short = met(events.withColumn("__bucket", bucket(F.col(ts))), listed, (*key, "__bucket"))
    long = valid.where(length > long_span)
    first, last = long.agg(F.min(lo)).scalar(), long.agg(F.max(hi)).scalar()
    reached = events.where((F.col(ts) >= first) & (F.col(ts) <= last))
    return short.unionByName(sweep_join(reached, long, key, ts, lo, hi))


def sweep_join(events: DataFrame, entities: DataFrame, key: Sequence[str], ts: str, lo: str, hi: str, slice_rows: int = 65_536) -> DataFrame:
    """Events joined to the spans ``lo``..``hi`` (inclusive) of the same key that hold them, for spans of any length.

    A key's timeline is cut into slices of about ``slice_rows`` events (an hour's events stay together). An event lies in
    one slice; a span is listed in each slice that it meets, once for every border it crosses. Both sides meet on (key,
    slice), so a hot key with open-ended spans is spread over as many tasks as it has slices, and in a slice nearly every
    pair that is looked at is a result. Null keys, times and ends meet nothing.
    """
    origin = F.lit(dt.date(1900, 1, 1))

    def hour(c: str) -> Column:
        return F.datediff(F.col(c).cast("date"), origin) * 24 + F.hour(F.col(c))

    valid = entities.where(F.col(lo) <= F.col(hi))
    at = events.where(F.col(ts).isNotNull()).withColumn("__at", hour(ts))
    # only keys with a span are cut
    hours = at.join(valid.select(*key).distinct(), list(key), "left_semi").groupBy(*key, "__at").agg(F.count(F.lit(1)).alias("__n"))
    # one row a key and hour, so the calendar bounds a key's rows and plain windows serve
    before = cumulate(hours, key, ["__at"], [], {"__so_far": ("sum", "__n")}, exclude_current=True)
    sliced = before.select(*key, "__at", F.floor(F.coalesce("__so_far", F.lit(0)) / slice_rows).alias("__slice"))
    # the slice at the beginning and at the end of a span: the last one that has begun by then
    borders = sliced.groupBy(*key, "__slice").agg(F.min("__at").alias("__at"))
    ends = valid.select(*key, F.explode(F.array(hour(lo), hour(hi))).alias("__at")).distinct()
    line = borders.unionByName(ends, allowMissingColumns=True).groupBy(*key, "__at").agg(F.max("__slice").alias("__slice"))
    held = cumulate(line, key, ["__at"], [], {"__in": ("max", "__slice")}).select(*key, "__at", "__in")
    spans = valid.withColumns({"__lo": hour(lo), "__hi": hour(hi)})
    for end in ("__lo", "__hi"):
        spans = spans.join(held.withColumnsRenamed({"__at": end, "__in": f"{end}_slice"}), [*key, end], "left")
    first = F.coalesce("__lo_slice", F.lit(0).cast("long"))  # the key's events begin later
    listed = spans.where(F.col("__hi_slice").isNotNull()).withColumn("__slice", F.explode(F.sequence(first, F.col("__hi_slice"))))
    extra = [c for c in entities.columns if c not in key]
    dealt = at.join(sliced, [*key, "__at"])
    met = dealt.join(listed.select(*key, "__slice", *extra), [*key, "__slice"]).where((F.col(ts) >= F.col(lo)) & (F.col(ts) <= F.col(hi)))
    return met.select(*events.columns, *extra)


def join_where(a: DataFrame, b: DataFrame, on: Sequence[str], residual: Column, how: str = "inner") -> DataFrame:
    """Equi-join with an inequality left over; ``residual`` uses the aliases ``a`` and ``b``."""
    cond = residual
    for k in on:
        cond = cond & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    extra = [F.col(f"b.{c}") for c in b.columns if c not in on]
    return a.alias("a").join(b.alias("b"), cond, how).select("a.*", *extra)


def lag_join(df: DataFrame, key: Sequence[str], ord_col: str, cols: Mapping[str, str], step: int = 1) -> DataFrame:
    """Values of the row exactly ``step`` positions earlier (NULL when that position is absent).

    The predecessor of a position is one row per (key, position), aggregated before the shuffle and joined to the rows, so
    no rows of a key are gathered. Several rows at one position all stay; as predecessor the highest of them counts. A row
    without a position has no predecessor and is none; it is not shuffled.
    """
    field = df.schema[ord_col]
    placed = df.where(F.col(ord_col).isNotNull()) if field.nullable else df
    prior = F.struct(*[F.col(c).alias(o) for o, c in cols.items()])
    after = placed.groupBy(*key, (F.col(ord_col) + step).cast(field.dataType).alias(ord_col)).agg(F.max(prior).alias("__prior"))
    met = join_same(placed, after, [*key, ord_col]).select(*df.columns, *[F.col(f"__prior.{o}").alias(o) for o in cols])
    if not field.nullable:
        return met
    rest = df.where(F.col(ord_col).isNull())
    return met.unionByName(rest.select(*df.columns, *[F.lit(None).cast(df.schema[c].dataType).alias(o) for o, c in cols.items()]))


def join_norm(a: DataFrame, b: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on trimmed, case-folded text keys; of ``b`` the highest row of each normalised key counts."""

    def norm(c: Column) -> Column:
        return F.upper(F.trim(c.cast("string")))

    left = a.withColumns({f"__n_{k}": norm(F.col(k)) for k in on})
    rest = [c for c in b.columns if c not in on]
    right = one_per_key(b.select(*[norm(F.col(k)).alias(f"__n_{k}") for k in on], *rest), [f"__n_{k}" for k in on], rest)
    return left.join(right, [f"__n_{k}" for k in on], how).drop(*[f"__n_{k}" for k in on])


def either_side(
    df: DataFrame, mapping: DataFrame, key: str, src: str, dst: str, value: str, out: str, flag: str
) -> DataFrame:
    """Look ``key`` up as a transfer source first and as a destination second; ``flag`` tells whether either matched."""
    as_source = mapping.groupBy(F.col(src).alias(key)).agg(F.max(value).alias("__src"))
    as_target = mapping.groupBy(F.col(dst).alias(key)).agg(F.max(value).alias("__dst"))
    found = F.coalesce("__src", "__dst")
    return (
        df.join(as_source, key, "left")
        .join(as_target, key, "left")
        .select(*df.columns, found.alias(out), F.when(found.isNotNull(), 1).otherwise(0).alias(flag))
    )


def reattribute(df: DataFrame, mapping: DataFrame, on: str, cols: Mapping[str, str], latest: str | None = None) -> DataFrame:
    """Rows of a moved entity take the destination's attributes; all others keep their own.

    Of several transfers of an entity the one with the highest ``latest`` counts, then the one with the highest attributes.
    """
    mapping = one_per_key(mapping, [on], list(dict.fromkeys(cols.values())), latest)
    side = mapping.select(
        F.col(on), *[F.col(src).alias(f"__d_{c}") for c, src in cols.items()], F.lit(True).alias("__moved")
    )
    moved = F.col("__moved").isNotNull()
    return df.join(side, on, "left").select(
        *[F.when(moved, F.col(f"__d_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns]
    )


NEVER = dt.date(9999, 12, 31)
MOST_ROUNDS = 24


def _written(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "moves")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def resolved_moves(
    moves: DataFrame, source: str, target: str, moved_on: str, store: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """(source, lo, hi, target): where what was in ``source`` is from ``lo`` until before ``hi``, chains followed.

    A move holds until the entity's next one; several moves of an entity on one day count as the one with the highest
    target. What arrives somewhere goes on with the moves of that place from its arrival on. Chains double their reach each
    round, so a chain of a thousand moves takes ten. Between rounds the intervals are written and read again, below the
    shared folder or by ``store``. Moves that go round in a circle within one day have no end and raise an error.
    """
    store = store or _written
    day = F.col(moved_on).cast("date")
    known = moves.where(F.col(source).isNotNull() & day.isNotNull()).groupBy(F.col(source).alias("src"), day.alias("lo")).agg(F.max(target).alias("dst"))
    until = F.lead("lo").over(Window.partitionBy("src").orderBy("lo"))
    now = store(known.select("src", F.col("lo").alias("root"), "lo", F.coalesce(until, F.lit(NEVER)).alias("hi"), "dst"))
    for _ in range(MOST_ROUNDS):
        a, b = now.alias("a"), now.alias("b")
        # the moves of the place since the arrival; they follow one another without a gap
        onward = (F.col("a.dst") == F.col("b.src")) & (F.col("b.root") >= F.col("a.lo")) & (F.col("b.lo") < F.col("a.hi"))
        met = store(a.join(b, onward).select(
            F.col("a.src").alias("src"), F.col("a.root").alias("root"), F.col("a.lo").alias("from_lo"), F.greatest("a.lo", "b.lo").alias("lo"),
            F.least("a.hi", "b.hi").alias("hi"), F.col("b.dst").alias("dst"),
        ).where("lo < hi"))
        if met.isEmpty():
            return now.select(F.col("src").alias(source), "lo", "hi", F.col("dst").alias(target))
        left = met.groupBy("src", F.col("from_lo").alias("lo")).agg(F.min("lo").alias("left_on"))
        stays = now.join(left, ["src", "lo"], "left").withColumn("hi", F.least("hi", F.coalesce("left_on", F.lit(NEVER)))).where("lo < hi")
        now = store(stays.select("src", "root", "lo", "hi", "dst").unionByName(met.select("src", "root", "lo", "hi", "dst")))
    raise ValueError(f"{source}: moves within one day go round in a circle")


def reattribute_dated(df: DataFrame, resolved: DataFrame, on: str, date: str, source: str, target: str, out: str) -> DataFrame:
    """``out``: the entity that each row belongs to as of its date, by :func:`resolved_moves`; rows before a move stay."""
    side = resolved.select(F.col(source).alias("__src"), F.col("lo").alias("__lo"), F.col("hi").alias("__hi"), F.col(target).alias("__dst"))
    day = F.col(date).cast("date")
    met = df.join(side, (F.col(on) == F.col("__src")) & (day >= F.col("__lo")) & (day < F.col("__hi")), "left")
    return met.select(*df.columns, F.coalesce("__dst", F.col(on)).alias(out))


def lookup_by_level(
    df: DataFrame, level: str, dims: Mapping[str, tuple[DataFrame, str]], value: str, out: str
) -> DataFrame:
    """Value of the dimension that belongs to the row's own level code.

    ``dims`` maps a level to (dimension, key column of the row). The level is part of the join key, so a row probes the
    one dimension that can answer it.
    """
    pick = None
    for code, (dim, key) in dims.items():
        side = dim.select(F.col(key).alias(f"__k_{code}"), F.col(value).alias(f"__v_{code}"))
        df = df.join(side, (F.col(level) == code) & (F.col(key) == F.col(f"__k_{code}")), "left").drop(f"__k_{code}")
        pick = F.col(f"__v_{code}") if pick is None else F.coalesce(pick, F.col(f"__v_{code}"))
    return df.withColumn(out, pick).drop(*[f"__v_{c}" for c in dims])


def std_lookup(df: DataFrame, std: DataFrame, keys: Sequence[str], age: Column, std_age: str) -> DataFrame:
    """Standard values for the age rounded up to the next whole step."""
    stamped = df.withColumn(std_age, F.ceil(age).cast(std.schema[std_age].dataType))
    return stamped.join(std, [*keys, std_age], "left")


def push_down(child: DataFrame, parent: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Parent values on every child row; the parent is reduced to one row per key first, so no child row multiplies."""
    one = parent.groupBy(*keys).agg(*[F.max(c).alias(c) for c in cols])
    return child.join(one, list(keys), "left")
