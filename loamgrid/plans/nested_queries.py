"""Queries of nested documents: an entry for each order, with its lines two levels down, walked as VARIANT."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import nested
from ..session import table
from .base import query

_TYPE = "CASE l_linenumber % 5 WHEN 0 THEN 'Ranged Weapons' WHEN 1 THEN 'Melee Weapons' WHEN 2 THEN 'Abilities' WHEN 3 THEN 'Transport' ELSE 'Other' END"
_KIND = "CASE l_returnflag WHEN 'A' THEN 'unit' WHEN 'R' THEN 'UNIT' ELSE 'upgrade' END"
_SAID = "CASE WHEN l_tax = 0 THEN '' ELSE 'line of ' || CAST(l_suppkey AS STRING) END"


def _entries(spark, sf_dir) -> DataFrame:
    """o_orderkey, o_custkey, lowest (its smallest part) and the entry as JSON."""
    named = lambda name, value: F.struct(F.lit(name).alias("name"), value.alias("$text"))
    cost = lambda name, value: F.struct(F.lit(name).alias("name"), value.cast("int").alias("value"))
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.struct(
            F.concat(F.lit("Part "), "l_partkey").alias("name"),
            F.expr(_KIND).alias("type"),
            F.array(cost("pts", F.col("l_quantity")), cost("other", F.lit(1))).alias("costs"),
            F.array(F.struct(F.col("l_linestatus").alias("name"), F.expr(_TYPE).alias("typeName"), F.array(named("Description", F.expr(_SAID)), named("Capacity", F.col("l_quantity").cast("int").cast("string"))).alias("characteristics"))).alias("profiles"),
        ).alias("line"),
    )
    lines = line.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list("line").alias("lines"), F.min("l_partkey").alias("lowest"))
    orders = table(spark, sf_dir, "orders").join(lines, "o_orderkey", "left")
    entry = F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("Order "), "o_orderkey").alias("name"),
        F.when(F.col("o_orderstatus") == "F", "Unit").otherwise("model").alias("type"),
        F.array(F.struct(F.col("o_orderpriority").alias("name")), F.struct(F.lit(None).cast("string").alias("name"))).alias("categoryLinks"),
        F.array(cost("pts", F.col("o_custkey"))).alias("costs"),
        F.array(F.struct(F.lit("selections").alias("field"), F.col("o_orderstatus").alias("scope"), F.lit(2).alias("value"))).alias("constraints"),
        F.array(F.struct(F.lit("Order").alias("name"), F.lit("Unit").alias("typeName"), F.array(named("T", F.col("o_custkey").cast("string"))).alias("characteristics"))).alias("profiles"),
        F.struct(F.col("lines").alias("group")).alias("entries"),
    )
    return orders.select("o_orderkey", "o_custkey", "lowest", F.to_json(entry).alias("entry"))


_SQL_TYPE, _SQL_KIND, _SQL_SAID = (x.replace("STRING", "VARCHAR") for x in (_TYPE, _KIND, _SAID))
_PROFILES_SQL = f"""
    profiles AS (
        SELECT o_orderkey, 'unit' AS class, 'Order' AS name, 'Unit' AS type, 'T=' || o_custkey AS characteristics, NULL AS text_sha256 FROM orders
        UNION ALL SELECT l_orderkey, CASE WHEN l_linenumber % 5 < 2 THEN 'weapon' ELSE 'semantic' END, l_linestatus, {_SQL_TYPE},
               CASE WHEN l_linenumber % 5 < 2 THEN 'Capacity=' || CAST(l_quantity AS INT) || ';Description=' || {_SQL_SAID} END,
               CASE WHEN l_linenumber % 5 >= 2 THEN sha256(CASE WHEN l_tax = 0 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) ELSE {_SQL_SAID} END) END
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_linenumber % 5 < 4
    )"""


@query(f"WITH {_PROFILES_SQL} SELECT * FROM profiles")
def entry_profiles(spark, sf_dir):
    """Profiles of all entries at any depth, by type."""
    flat = F.array_join(F.transform("characteristics", lambda c: F.concat(c["name"], F.lit("="), c["text"])), ";")
    return nested.profiles(_entries(spark, sf_dir), "o_orderkey", "entry").withColumn("characteristics", flat)


@query(f"""
WITH {_PROFILES_SQL}
SELECT CAST(o_orderkey AS VARCHAR) AS id, 'Order ' || o_orderkey AS name, CASE WHEN o_orderstatus = 'F' THEN 'Unit' ELSE 'model' END AS type, o_orderpriority AS categories, 'pts=' || o_custkey AS costs,
       'selections/' || o_orderstatus || '/2' AS constraints, coalesce(u, 0) AS units, coalesce(w, 0) AS weapons, coalesce(s, 0) AS semantics
FROM orders LEFT JOIN (
    SELECT o_orderkey, count(*) FILTER (class = 'unit') AS u, count(*) FILTER (class = 'weapon') AS w, count(*) FILTER (class = 'semantic') AS s FROM (SELECT DISTINCT * FROM profiles) GROUP BY o_orderkey
) USING (o_orderkey)
""")
def entry_summaries(spark, sf_dir):
    """One summary for each entry; profiles that stand in it more than once count once."""
    rows = nested.entry_summaries(_entries(spark, sf_dir), "o_orderkey", "entry")
    joined = lambda c, sep, *names: F.array_join(F.transform(c, lambda x: F.concat_ws(sep, *[x[n] for n in names])), ";")
    size = lambda c: F.coalesce(F.size(F.coalesce(c, F.expr(f"slice({c}, 1, 0)"))), F.lit(0)).cast("long")
    return rows.select("id", "name", "type", F.array_join("categories", ";").alias("categories"), joined("costs", "=", "name", "value").alias("costs"), joined("constraints", "/", "field", "scope", "type", "value").alias("constraints"), size("unit_profiles").alias("units"), size("weapon_profiles").alias("weapons"), size("semantic_profiles").alias("semantics"))


@query("""
SELECT o_orderkey, 'Order ' || o_orderkey AS name FROM orders WHERE o_orderstatus = 'F'
UNION SELECT l_orderkey, 'Part ' || l_partkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag IN ('A', 'R')
""")
def entry_units(spark, sf_dir):
    """Names of everything whose type is a unit, in whatever case, at any depth."""
    return nested.typed_names(_entries(spark, sf_dir), "o_orderkey", "entry", "unit")


@query("""
SELECT l_orderkey AS o_orderkey, string_agg(DISTINCT CAST(l_quantity AS INT), ';' ORDER BY CAST(l_quantity AS INT)) AS costs, CASE WHEN count(DISTINCT CAST(l_quantity AS INT)) = 1 THEN min(CAST(l_quantity AS INT)) END AS cost
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN (SELECT l_orderkey AS k, min(l_partkey) AS lowest FROM lineitem GROUP BY l_orderkey) ON k = l_orderkey AND lowest = l_partkey GROUP BY l_orderkey
""")
def entry_costs(spark, sf_dir):
    """Points of each entry's smallest part, found by its name however deep it stands."""
    found = nested.named_costs(_entries(spark, sf_dir), "o_orderkey", "entry", F.concat(F.lit("PART "), "lowest"), "pts")
    return found.withColumn("costs", F.array_join(F.col("costs").cast("array<string>"), ";"))


@query("SELECT DISTINCT o_orderkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_partkey = o_custkey % 40")
def entries_holding(spark, sf_dir):
    """Entries in which some text is the name asked for."""
    return nested.holding(_entries(spark, sf_dir), "o_orderkey", "entry", F.concat(F.lit("part "), F.col("o_custkey") % 40))
