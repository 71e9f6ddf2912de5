"""More conformed dimensions of the farm: places, kinds, states and machines, each by the one way to publish."""

from __future__ import annotations

from pyspark.sql import functions as F

from farmledger.plans.dimension_specs import DimensionSpec, register_dimension
from farmledger.plans.standins import day

_NAMES = {"F": "Cerrado", "O": "Activo", "P": "Parcial"}  # Fixed values: states of a lot


def _state(c: str):
    out = F.lit("Otro")
    for code, name in _NAMES.items():
        out = F.when(F.col(c) == code, name).otherwise(out)
    return out


_STATE = "CASE o_orderstatus " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _NAMES.items()) + " ELSE 'Otro' END"

CATALOG = [
    DimensionSpec(
        "company", ("code",), ("name",), {"code": -1, "name": "Sin Empresa"},
        lambda t: t.region.select(F.col("r_regionkey").alias("code"), F.col("r_name").alias("name")),
        "SELECT r_regionkey AS code, r_name AS name FROM region", "code < 3",
    ),
    DimensionSpec(
        "zone", ("code",), ("name", "company"), {"code": -1, "name": "Sin Zona", "company": "Sin"},
        lambda t: t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name"), F.col("r_name").alias("company")),
        "SELECT n_nationkey AS code, n_name AS name, r_name AS company FROM nation JOIN region ON n_regionkey = r_regionkey", "code % 4 <> 2",
    ),
    DimensionSpec(
        "subzone", ("zone", "division"), ("name", "farms"), {"zone": -1, "division": "Sin", "name": "Sin Subzona", "farms": 0},
        lambda t: t.customer.groupBy(F.col("c_nationkey").alias("zone"), F.col("c_mktsegment").alias("division")).agg(F.count(F.lit(1)).alias("farms")).withColumn("name", F.concat_ws("/", "zone", "division")),
        "SELECT c_nationkey AS zone, c_mktsegment AS division, c_nationkey || '/' || c_mktsegment AS name, COUNT(*) AS farms FROM customer GROUP BY 1, 2", "zone % 2 = 1",
    ),
    DimensionSpec(
        "division", ("code",), ("name",), {"code": "Sin", "name": "Sin Division"},
        lambda t: t.customer.select(F.col("c_mktsegment").alias("code"), F.initcap(F.lower("c_mktsegment")).alias("name")).distinct(),
        "SELECT DISTINCT c_mktsegment AS code, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS name FROM customer", "code < 'F'",
    ),
    DimensionSpec(
        "pen", ("farm", "house", "pen"), ("name",), {"farm": -1, "house": "Sin", "pen": -1, "name": "Sin Corral"},
        lambda t: t.lineitem.select(F.col("l_suppkey").alias("farm"), F.col("l_returnflag").alias("house"), F.col("l_linenumber").alias("pen"), F.concat_ws("-", "l_suppkey", "l_returnflag", "l_linenumber").alias("name")).distinct(),
        "SELECT DISTINCT l_suppkey AS farm, l_returnflag AS house, l_linenumber AS pen, l_suppkey || '-' || l_returnflag || '-' || l_linenumber AS name FROM lineitem", "pen <> 2",
    ),
    DimensionSpec(
        "species", ("code",), ("name", "members"), {"code": "0", "name": "Sin Especie", "members": 0},
        lambda t: t.part.groupBy(F.col("p_brand").alias("code")).agg(F.max("p_type").alias("name"), F.count(F.lit(1)).alias("members")),
        "SELECT p_brand AS code, MAX(p_type) AS name, COUNT(*) AS members FROM part GROUP BY 1", "code > 'Brand#2'",
    ),
    DimensionSpec(
        "product_type", ("code",), ("lightest", "heaviest"), {"code": "Sin", "lightest": 0, "heaviest": 0},
        lambda t: t.part.groupBy(F.col("p_type").alias("code")).agg(F.min("p_size").alias("lightest"), F.max("p_size").alias("heaviest")),
        "SELECT p_type AS code, MIN(p_size) AS lightest, MAX(p_size) AS heaviest FROM part GROUP BY 1", "code <> 'LARGE'",
    ),
    DimensionSpec(
        "use_subgroup", ("kind", "code"), ("name",), {"kind": "Sin", "code": "Sin", "name": "Sin Subgrupo"},
        lambda t: t.part.select(F.col("p_type").alias("kind"), F.col("p_brand").alias("code"), F.concat_ws(" ", "p_type", "p_brand").alias("name")).distinct(),
        "SELECT DISTINCT p_type AS kind, p_brand AS code, p_type || ' ' || p_brand AS name FROM part", "kind < 'P'",
    ),
    DimensionSpec(
        "lot_state", ("code",), ("name",), {"code": "0", "name": "Sin Estado"},
        lambda t: t.orders.select(F.col("o_orderstatus").alias("code"), _state("o_orderstatus").alias("name")).distinct(),
        f"SELECT DISTINCT o_orderstatus AS code, {_STATE} AS name FROM orders", "code <> 'P'",
    ),
    DimensionSpec(
        "administrator", ("code",), ("name", "lots"), {"code": "0", "name": "Sin Administrador", "lots": 0},
        lambda t: t.orders.groupBy(F.substring_index("o_orderpriority", "-", 1).alias("code")).agg(F.max(F.substring("o_orderpriority", 3, 40)).alias("name"), F.count(F.lit(1)).alias("lots")),
        "SELECT split_part(o_orderpriority, '-', 1) AS code, MAX(substr(o_orderpriority, 3)) AS name, COUNT(*) AS lots FROM orders GROUP BY 1", "code <> '3'",
    ),
    DimensionSpec(
        "sex", ("code",), ("name",), {"code": "0", "name": "Sin Sexo"},
        lambda t: t.lineitem.select(F.col("l_returnflag").alias("code"), F.concat(F.lit("Sexo "), F.col("l_returnflag")).alias("name")).distinct(),
        "SELECT DISTINCT l_returnflag AS code, 'Sexo ' || l_returnflag AS name FROM lineitem", "code <> 'R'",
    ),
    DimensionSpec(
        "hatchery", ("code",), ("name", "vendors"), {"code": -1, "name": "Sin Incubadora", "vendors": 0},
        lambda t: t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).groupBy(F.col("s_nationkey").alias("code")).agg(F.max("n_name").alias("name"), F.count(F.lit(1)).alias("vendors")),
        "SELECT s_nationkey AS code, MAX(n_name) AS name, COUNT(*) AS vendors FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1", "code % 3 = 0",
    ),
    DimensionSpec(
        "setter", ("hatchery", "machine"), ("name",), {"hatchery": -1, "machine": -1, "name": "Sin Maquina"},
        lambda t: t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("s_nationkey").alias("hatchery"), F.col("l_linenumber").alias("machine")).distinct().withColumn("name", F.concat(F.lit("Maquina "), F.col("machine"))),
        "SELECT DISTINCT s_nationkey AS hatchery, l_linenumber AS machine, 'Maquina ' || l_linenumber AS name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey", "machine < 5",
    ),
    DimensionSpec(
        "generation", ("year",), ("name", "lots"), {"year": 0, "name": "Sin Generacion", "lots": 0},
        lambda t: t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("lots")).withColumn("name", F.concat(F.lit("Generacion "), F.col("year"))),
        "SELECT CAST(YEAR(o_orderdate) AS INTEGER) AS year, COUNT(*) AS lots, 'Generacion ' || YEAR(o_orderdate) AS name FROM orders GROUP BY 1, 3", "year < 2000",
    ),
    DimensionSpec(
        "sensor_kind", ("code",), ("first_seen", "readings"), {"code": "Sin", "first_seen": None, "readings": 0},
        lambda t: t.events.groupBy(F.col("event_type").alias("code")).agg(F.min(day("ts")).alias("first_seen"), F.count(F.lit(1)).alias("readings")),
        "SELECT event_type AS code, MIN(CAST(ts AS DATE)) AS first_seen, COUNT(*) AS readings FROM events GROUP BY 1", "code <> 'error'",
    ),
    DimensionSpec(
        "cost_centre", ("company", "centre"), ("name",), {"company": "Sin", "centre": -1, "name": "Sin Centro"},
        lambda t: t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("company"), F.col("s_suppkey").alias("centre"), F.col("s_name").alias("name")),
        "SELECT r_name AS company, s_suppkey AS centre, s_name AS name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey", "centre % 5 <> 1",
    ),
]

for _spec in CATALOG:
    register_dimension(_spec)
