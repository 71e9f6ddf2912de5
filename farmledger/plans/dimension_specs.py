"""Conformed dimensions as specifications: what a dimension's key, attributes and default member are, and one way to publish.

A run takes the published table and the source of the day. Known members keep their surrogate key, new ones are numbered
after the highest key in use, and the attributes of all are refreshed. The specifications below map the farm concepts onto
the driver tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farmledger.functions import fixed
from farmledger.functions.calendar import age_days
from farmledger.operators import dims
from farmledger.operators.merge import one_per_key
from farmledger.plans.registry import query
from farmledger.plans.standins import fx
from farmledger.sources.tables import Tables


@dataclass(frozen=True)
class DimensionSpec:
    """Key, attributes and default member of a dimension; ``known`` says which members an earlier run had published."""

    name: str
    key: tuple[str, ...]
    attributes: tuple[str, ...]
    default: Mapping[str, Any]
    source: Callable[[Tables], DataFrame]
    sql: str
    known: str


def publish(spec: DimensionSpec, published: DataFrame | None, source: DataFrame, sk: str = "sk") -> DataFrame:
    """The dimension after a run: default member included, one member a key, keys stable, attributes refreshed."""
    members = dims.build_dimension(source, [*spec.key, *spec.attributes], spec.default)
    members = one_per_key(members, spec.key, spec.attributes)
    if published is None:
        return dims.assign_sk(members, spec.key, sk).select(*spec.key, *spec.attributes, sk)
    extended = dims.extend_sk(published, members, spec.key, sk)
    return dims.scd1_refresh(extended, members, spec.key, spec.attributes)


def _ages(t: Tables) -> DataFrame:
    born = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return dims.age_dim(t.lineitem.join(born, "l_orderkey"), age_days("l_shipdate", "o_orderdate"))


_AGES = "(SELECT DISTINCT date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
_WEEK = "CASE WHEN d = 0 THEN 1 ELSE CAST(CEIL(d / 7.0) AS INTEGER) + 1 END"

SPECS = [
    DimensionSpec(
        "farm", ("code",), ("name", "division"), {"code": -1, "name": "Sin Plantel", "division": "Sin"},
        lambda t: t.customer.select(F.col("c_custkey").alias("code"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("division")),
        "SELECT c_custkey AS code, c_name AS name, c_mktsegment AS division FROM customer", "code % 3 <> 0",
    ),
    DimensionSpec(
        "lot", ("code",), ("name", "status"), {"code": -1, "name": "Sin Lote", "status": "Sin"},
        lambda t: t.orders.select(F.col("o_orderkey").alias("code"), F.concat(F.lit("L"), F.col("o_orderkey")).alias("name"), F.col("o_orderstatus").alias("status")),
        "SELECT o_orderkey AS code, 'L' || o_orderkey AS name, o_orderstatus AS status FROM orders", "code % 4 <> 1",
    ),
    DimensionSpec(
        "house", ("farm", "house"), ("name",), {"farm": -1, "house": -1, "name": "Sin Galpon"},
        lambda t: t.lineitem.select(F.col("l_suppkey").alias("farm"), F.col("l_linenumber").alias("house"), F.concat_ws("-", "l_suppkey", "l_linenumber").alias("name")),
        "SELECT DISTINCT l_suppkey AS farm, l_linenumber AS house, l_suppkey || '-' || l_linenumber AS name FROM lineitem", "house <= 4",
    ),
    DimensionSpec(
        "product", ("code",), ("name", "family"), {"code": -1, "name": "Sin Producto", "family": "Sin"},
        lambda t: t.part.select(F.col("p_partkey").alias("code"), F.col("p_name").alias("name"), F.col("p_type").alias("family")),
        "SELECT p_partkey AS code, p_name AS name, p_type AS family FROM part", "family <> 'PROMO'",
    ),
    DimensionSpec(
        "vendor", ("code",), ("name", "country"), {"code": -1, "name": "Sin Proveedor", "country": "Sin"},
        lambda t: t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("code"), F.col("s_name").alias("name"), F.col("n_name").alias("country")),
        "SELECT s_suppkey AS code, s_name AS name, n_name AS country FROM supplier JOIN nation ON s_nationkey = n_nationkey", "code % 2 = 0",
    ),
    DimensionSpec(
        "standard", ("breed", "age"), ("value",), {"breed": "Sin", "age": -1, "value": 0.0},
        lambda t: t.part.groupBy(F.col("p_type").alias("breed"), F.col("p_size").alias("age")).agg(fixed(F.avg("p_retailprice")).alias("value")),
        f"SELECT p_type AS breed, p_size AS age, {fx('AVG(p_retailprice)')} AS value FROM part GROUP BY 1, 2", "age > 10",
    ),
    DimensionSpec(
        "age", ("age_day",), ("age_code", "age_label", "age_week"), {"age_day": -1, "age_code": "Sin", "age_label": "Sin Dia", "age_week": 0},
        _ages,
        f"SELECT CAST(d AS INTEGER) AS age_day, CASE WHEN d > 9 THEN 'D' || d ELSE 'D0' || d END AS age_code, 'Dia ' || d AS age_label, {_WEEK} AS age_week FROM {_AGES} WHERE d >= 0",
        "age_day % 5 <> 0",
    ),
    DimensionSpec(
        "week", ("age_week",), ("name",), {"age_week": 0, "name": "Sin Semana"},
        lambda t: _ages(t).select("age_week", F.concat(F.lit("Semana "), F.col("age_week")).alias("name")),
        f"SELECT DISTINCT {_WEEK} AS age_week, 'Semana ' || {_WEEK} AS name FROM {_AGES} WHERE d >= 0", "age_week > 2",
    ),
]


def _literal(value: Any) -> str:
    return "NULL" if value is None else f"'{value}'" if isinstance(value, str) else str(value)


def _twin(spec: DimensionSpec) -> str:
    key, cols = ", ".join(spec.key), ", ".join([*spec.key, *spec.attributes])
    default = ", ".join(f"{_literal(spec.default[c])} AS {c}" for c in [*spec.key, *spec.attributes])
    missing = " AND ".join(f"{k} = {_literal(spec.default[k])}" for k in spec.key)
    return f"""WITH src AS ({spec.sql}), m AS (SELECT {cols} FROM src UNION SELECT {default}),
    old AS (SELECT {key}, row_number() OVER (ORDER BY {key}) AS sk FROM m WHERE {spec.known} OR ({missing})),
    fresh AS (SELECT {key}, (SELECT max(sk) FROM old) + row_number() OVER (ORDER BY {key}) AS sk FROM m ANTI JOIN old USING ({key}))
    SELECT {cols}, sk FROM m JOIN (SELECT * FROM old UNION ALL SELECT * FROM fresh) USING ({key})"""


def register_dimension(spec: DimensionSpec) -> None:
    """Register the query of a dimension: a first run on the known members, and a second one on all of them."""

    @query(f"dim_{spec.name}", _twin(spec))
    def build(t: Tables) -> DataFrame:
        source = spec.source(t)
        stale = source.where(spec.known).withColumns({a: F.lit(None).cast(dict(source.dtypes)[a]) for a in spec.attributes})
        return publish(spec, publish(spec, None, stale), source)


for _spec in SPECS:
    register_dimension(_spec)
