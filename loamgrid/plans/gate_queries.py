"""Queries of gates, state machines, solvers and contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import contracts as V
from ..operators import gates as G
from ..operators import solver as S
from ..operators.graph import typed_path, walk_json
from ..operators.relational import edition_score
from ..session import table
from .base import query


@query("""
WITH x AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS norm, CAST(l_quantity AS BIGINT) + CASE WHEN l_partkey % 7 = 0 THEN 1 ELSE 0 END AS mirror, CAST(l_quantity AS BIGINT) + CASE WHEN l_partkey % 3 = 0 THEN 2 ELSE 0 END AS pinned,
 CAST(l_quantity AS BIGINT) + CASE WHEN l_partkey % 6 = 0 THEN 2 ELSE 0 END AS live, CAST(l_quantity AS BIGINT) + CASE WHEN l_partkey % 2 = 0 OR l_partkey % 3 = 0 THEN 2 ELSE 0 END AS runtime FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN runtime = norm THEN 'NORMATIVE_MATCH' WHEN mirror = norm AND pinned <> live AND runtime = pinned AND live = norm THEN 'UPSTREAM_REVISION_DRIFT'
 WHEN mirror = norm AND pinned = runtime AND live = runtime THEN 'IMPLEMENTATION_DRIFT' WHEN mirror = norm AND pinned = norm AND live = norm THEN 'RUNTIME_PROJECTION_DRIFT' ELSE 'UNKNOWN_RUNTIME_DRIFT' END AS drift FROM x
""")
def drift_lineage_class(spark, sf_dir):
    q = F.col("l_quantity").cast("long")
    plus = lambda cond, n: q + F.when(F.expr(cond), n).otherwise(0)
    drift = G.drift_lineage(q, plus("l_partkey % 7 = 0", 1), plus("l_partkey % 3 = 0", 2), plus("l_partkey % 6 = 0", 2), plus("l_partkey % 2 = 0 or l_partkey % 3 = 0", 2))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", drift.alias("drift"))


def _transitions(spark, sf_dir) -> DataFrame:
    by = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.bool_or(F.col("event_type") == "purchase").alias("confirmed"), F.bool_or(F.col("event_type") == "error").alias("changed"), F.bool_or((F.col("event_type") == "signup") & (F.col("value") > 50)).alias("scoped"),
        F.max(F.col("value") > 95).alias("applied"), F.min(F.to_date("ts")).alias("first"), F.count("*").alias("n"),
    )
    release = F.when(F.col("n") % 3 == 0, None).otherwise(F.date_add("first", (F.col("n") % 5).cast("int")))
    state, eligible = G.transition(F.col("confirmed") & (F.col("n") % 2 == 0), F.col("scoped"), F.col("applied"), F.col("changed"), release, F.date_add("first", 2))
    return by.select("user_id", state.alias("state"), eligible.alias("candidate_eligible"))


_TRANSITION_SQL = """
b AS (SELECT user_id, bool_or(event_type = 'purchase') AND count(*) % 2 = 0 AS confirmed, bool_or(event_type = 'error') AS changed, bool_or(event_type = 'signup' AND value > 50) AS scoped, bool_or(value > 95) AS applied,
      min(CAST(ts AS DATE)) AS first, count(*) AS n FROM events GROUP BY user_id),
st AS (SELECT user_id, CASE WHEN scoped AND applied THEN 'CURRENT_SCOPED_RECONCILED' WHEN confirmed AND changed THEN 'READY_FOR_GUARDED_REINGESTION' WHEN confirmed THEN 'CURRENT_LEGAL_CONFIRMED_WAITING_UPSTREAM_PROJECTION'
  WHEN n % 3 = 0 THEN 'UPCOMING_HOLD_NO_RELEASE_DATE' WHEN n % 5 > 2 THEN 'PRE_RELEASE_HOLD' ELSE 'RELEASE_DATE_REACHED_AWAITING_OFFICIAL_CURRENTNESS' END AS state FROM b)
"""


@query(f"WITH {_TRANSITION_SQL} SELECT user_id, state, state = 'READY_FOR_GUARDED_REINGESTION' AS candidate_eligible FROM st")
def transition_state(spark, sf_dir):
    return _transitions(spark, sf_dir)


@query(f"""
WITH {_TRANSITION_SQL} SELECT user_id, CASE state WHEN 'CURRENT_SCOPED_RECONCILED' THEN 'NO_ACTION_SCOPED_CURRENT' WHEN 'READY_FOR_GUARDED_REINGESTION' THEN 'BUILD_ISOLATED_CANDIDATE' WHEN 'CURRENT_LEGAL_CONFIRMED_WAITING_UPSTREAM_PROJECTION' THEN 'WAIT_FOR_UPSTREAM_CHANGE'
 WHEN 'UPCOMING_HOLD_NO_RELEASE_DATE' THEN 'WAIT_FOR_OFFICIAL_CURRENT_LEGAL_EVIDENCE' WHEN 'PRE_RELEASE_HOLD' THEN 'WAIT_UNTIL_RELEASE_DATE_THEN_RECHECK_OFFICIAL_CURRENTNESS' ELSE 'REQUIRE_OFFICIAL_CURRENT_LEGAL_CONFIRMATION' END AS action FROM st
""")
def transition_action(spark, sf_dir):
    return _transitions(spark, sf_dir).select("user_id", G.transition_action(F.col("state")).alias("action"))


@query(f"""
WITH {_TRANSITION_SQL}, w AS (SELECT CASE state WHEN 'READY_FOR_GUARDED_REINGESTION' THEN 'READY_FOR_CANDIDATE' WHEN 'RELEASE_DATE_REACHED_AWAITING_OFFICIAL_CURRENTNESS' THEN 'ACTION_REQUIRED'
  WHEN 'CURRENT_LEGAL_CONFIRMED_WAITING_UPSTREAM_PROJECTION' THEN 'MONITORING' ELSE 'NO_ACTION' END AS s, user_id % 10 AS fleet FROM st)
SELECT fleet, CASE WHEN bool_or(s = 'READY_FOR_CANDIDATE') THEN 'READY_FOR_GUARDED_CANDIDATE' WHEN bool_or(s = 'ACTION_REQUIRED') THEN 'ACTION_REQUIRED' WHEN bool_or(s = 'MONITORING') THEN 'MONITORING_UPSTREAM_PROJECTION' ELSE 'NO_ACTION_REQUIRED' END AS status
FROM w GROUP BY fleet
""")
def fleet_status(spark, sf_dir):
    status, _ = G.watch(F.col("state"))
    return _transitions(spark, sf_dir).select((F.col("user_id") % 10).alias("fleet"), status.alias("s")).groupBy("fleet").agg(G.fleet_status(F.col("s")).alias("status"))


@query("""
SELECT page_id, CASE WHEN contains(p, 'blog') THEN 'ASTARTES' WHEN starts_with(p, 'data/') THEN 'MFM_DATA' WHEN ends_with(p, '.json') THEN 'FACTION_OR_LIBRARY_DATA' WHEN ends_with(p, '.md') OR contains(p, 'readme') THEN 'DOCUMENTATION' WHEN contains(p, '.github/') THEN 'CI' ELSE 'OTHER' END AS kind
FROM (SELECT page_id, lower(CASE page_id % 5 WHEN 0 THEN 'Data/' || page_id WHEN 1 THEN page_id || '.json' WHEN 2 THEN 'docs/README' WHEN 3 THEN '.github/ci.yml' ELSE url END) AS p FROM pages)
WHERE NOT contains(p, 'blog')
""")
def changed_path_class(spark, sf_dir):
    path = F.expr("case page_id % 5 when 0 then 'Data/' || page_id when 1 then page_id || '.json' when 2 then 'docs/README' when 3 then '.github/ci.yml' else url end")
    return table(spark, sf_dir, "pages").filter(~F.contains(F.lower(path), F.lit("blog"))).select("page_id", G.path_class(path).alias("kind"))


@query("""
SELECT o_orderkey, NOT coalesce(r IN ('identical', 'behind'), false) AS changed FROM (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'identical' WHEN 1 THEN 'behind' WHEN 2 THEN 'ahead' WHEN 3 THEN 'diverged' END AS r FROM orders)
""")
def upstream_changes(spark, sf_dir):
    relation = F.expr("case o_orderkey % 5 when 0 then 'identical' when 1 then 'behind' when 2 then 'ahead' when 3 then 'diverged' end")
    return table(spark, sf_dir, "orders").select("o_orderkey", G.upstream_changed(relation).alias("changed"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'CANDIDATE_FAILED' WHEN o_orderkey % 3 > 0 OR o_orderstatus = 'P' THEN 'BLOCKED_AUTHORITY_REVALIDATION' ELSE 'ELIGIBLE_FOR_REVIEWED_PROMOTION' END AS gate,
 CASE WHEN o_orderstatus = 'F' THEN 'FAIL' WHEN o_orderkey % 3 > 0 OR o_orderstatus = 'P' THEN 'PASS_WITH_BLOCKER' ELSE 'PASS' END AS status FROM orders
""")
def candidate_gate(spark, sf_dir):
    gate, status = G.candidate_gate(F.col("o_orderstatus") == "F", F.col("o_orderkey") % 3, F.col("o_orderstatus") == "P")
    return table(spark, sf_dir, "orders").select("o_orderkey", gate.alias("gate"), status.alias("status"))


@query("""
SELECT page_id, CASE WHEN page_id % 9 = 0 THEN 'HANDLED_BY_WAVE_A_MFM' WHEN page_id % 7 = 0 THEN 'NO_PUBLIC_ASSET_DECLARED' WHEN NOT starts_with(url, 'https://') THEN 'NON_OFFICIAL_ASSET_URL' WHEN page_id % 4 <> 0 AND page_id % 3 <> 0 THEN 'PASS' ELSE 'FAIL' END AS verification FROM pages
""")
def asset_verification(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    name, link = F.expr("case when page_id % 9 = 0 then 'separate' else 'pack' end"), F.expr("case when page_id % 7 = 0 then '' else url end")
    return p.select("page_id", G.asset_class(name, link, F.expr("case when page_id % 4 <> 0 then 200 else 404 end"), F.expr("page_id % 3 <> 0"), "https://", "separate").alias("verification"))


@query("""
WITH x AS (SELECT l_orderkey, l_linenumber, l_linenumber % 6 AS kind, CAST(l_quantity AS BIGINT) % 3 AS n, l_partkey % 3 AS m, l_returnflag = 'A' AS a, l_linestatus = 'O' AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE kind WHEN 0 THEN CASE WHEN n = 0 OR a THEN 'YES' ELSE 'NO' END WHEN 1 THEN CASE WHEN greatest(1 - n, 0) >= m THEN 'YES' ELSE 'NO' END
 WHEN 2 THEN CASE WHEN (n > 0 AND NOT a) OR (m > 0 AND NOT b) THEN 'NO' ELSE 'YES' END WHEN 3 THEN CAST(CASE WHEN a AND b THEN 0 WHEN a THEN greatest(n - 1, 0) ELSE n END AS VARCHAR)
 WHEN 4 THEN 'SEPARATE_UNIT' ELSE 'UNKNOWN' END AS result FROM x
""")
def interaction_answers(spark, sf_dir):
    kinds = ["can_make_normal_move", "gain_extra_cp", "can_use_stratagem", "adjust_stratagem_cp_cost", "revived_character_attachment", "other"]
    kind = F.element_at(F.array(*map(F.lit, kinds)), (F.col("l_linenumber") % 6 + 1).cast("int"))
    answer = G.interaction(kind, F.col("l_quantity").cast("long") % 3, F.col("l_partkey") % 3, F.col("l_returnflag") == "A", F.col("l_linestatus") == "O")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", answer.alias("result"))


@query("""
WITH RECURSIVE edges AS (SELECT s_suppkey AS parent, s_suppkey // 2 AS child FROM supplier WHERE s_suppkey > 1 UNION ALL SELECT 1, 3),
reach AS (SELECT s_suppkey AS profile, s_suppkey AS needs FROM supplier UNION SELECT profile, child FROM reach JOIN edges ON parent = needs),
reasons AS (SELECT profile, needs || '.content_state=' || CASE WHEN s_acctbal < 0 THEN 'STALE' ELSE 'None' END AS reason FROM reach LEFT JOIN supplier ON s_suppkey = needs WHERE s_acctbal < 0 OR s_suppkey IS NULL
 UNION SELECT profile, 's' || s_nationkey || '=FAIL' FROM reach JOIN supplier ON s_suppkey = needs WHERE s_nationkey % 10 = 3)
SELECT CAST(s_suppkey AS VARCHAR) AS profile, CASE WHEN count(reason) = 0 THEN 'PASS' ELSE 'PENDING' END AS result, coalesce(string_agg(reason, '; ' ORDER BY reason), '') AS reasons
FROM supplier LEFT JOIN reasons ON profile = s_suppkey GROUP BY s_suppkey
""")
def profile_currentness(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").withColumn("name", F.col("s_suppkey").cast("string"))
    names = s.select("name", F.expr("case when s_acctbal < 0 then 'STALE' else 'PASS' end").alias("content_state"))
    edges = s.filter("s_suppkey > 1").select(F.col("name").alias("parent"), F.expr("cast(s_suppkey div 2 as string)").alias("child")).union(s.filter("s_suppkey = 1").selectExpr("'1'", "'3'"))
    sources = s.select("name", F.concat(F.lit("s"), "s_nationkey").alias("source"), F.expr("case when s_nationkey % 10 = 3 then 'FAIL' else 'PASS' end").alias("state"))
    return G.currentness(G.closure(names, edges), names, sources)


@query("""
SELECT s_suppkey, CAST(CASE WHEN s_suppkey % 2 = 0 THEN CASE WHEN s_suppkey % 3 = 0 THEN 20 ELSE 0 END + CASE WHEN s_suppkey % 4 < 2 THEN 5 ELSE 0 END ELSE CASE WHEN s_suppkey % 4 = 3 THEN 20 ELSE 0 END + CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE 5 END END AS BIGINT) AS score FROM supplier
""")
def edition_scores(spark, sf_dir):
    source, edition = F.expr("case when s_suppkey % 3 = 0 then 'Old Legends' else 'Pack' end"), F.expr("case s_suppkey % 4 when 0 then '0' when 1 then '10' when 2 then '9' else '11' end")
    return table(spark, sf_dir, "supplier").select("s_suppkey", edition_score(F.expr("s_suppkey % 2 = 0"), source, edition).cast("long").alias("score"))


def _pools(spark) -> DataFrame:
    rows = [
        ("p1", "A", "DIRECT", 6, 4, 6, 10), ("p1", "B", "CONVERSION_REQUIRED", 4, 4, 6, 10), ("p2", "B", "DIRECT", 5, 3, 2, 5), ("p3", "N", "DIRECT", 20, 10, 10, 20), ("p3", "R", "CONVERSION_REQUIRED", 20, 10, 10, 20),
    ]
    return spark.createDataFrame(rows, "pool_id string, unit string, mode string, max_from_pool int, ready int, buildable int, bodies int")


def _demand(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").cast("string").alias("roster_id"), F.when(F.col("l_quantity") > 48, "X").otherwise(F.col("l_returnflag")).alias("unit"), (F.col("l_linenumber") + 1).alias("models"))


@query()
def allocation_flow(spark, sf_dir):
    """Least-cost allocation of pool bodies for every order as a roster; no SQL form."""
    return S.allocations(_demand(spark, sf_dir), _pools(spark))


@query("""
WITH d AS (SELECT CAST(l_orderkey AS VARCHAR) AS roster_id, CASE WHEN l_quantity > 48 THEN 'X' ELSE l_returnflag END AS unit, sum(l_linenumber + 1) AS need FROM lineitem GROUP BY ALL),
f AS (SELECT roster_id, bool_or(unit = 'X') AS unmodeled, coalesce(max(need) FILTER (WHERE unit = 'A'), 0) AS a, coalesce(max(need) FILTER (WHERE unit = 'N'), 0) AS n, coalesce(max(need) FILTER (WHERE unit = 'R'), 0) AS r FROM d GROUP BY roster_id)
SELECT roster_id, CASE WHEN unmodeled OR a > 6 OR n > 20 OR r > 20 OR n + r > 20 THEN 'INFEASIBLE_FROM_SNAPSHOT' WHEN (a > 4 OR n + r > 10) AND r > 0 THEN 'FEASIBLE_WITH_BUILD_AND_CONVERSION_PROVISIONAL'
  WHEN a > 4 OR n + r > 10 THEN 'FEASIBLE_WITH_BUILD_PROVISIONAL' WHEN r > 0 THEN 'FEASIBLE_WITH_CONVERSION_PROVISIONAL' ELSE 'FEASIBLE_PROVISIONAL' END AS physical_state FROM f
""")
def roster_feasibility(spark, sf_dir):
    demand, pools = _demand(spark, sf_dir), _pools(spark)
    made = S.allocations(demand, pools)
    none = spark.createDataFrame([], "roster_id string, component_id string, required long, capacity long, status string")
    unknown = spark.createDataFrame([], "roster_id string, constraint_id string")
    return S.physical_state(demand, S.body_deficits(demand, made, pools), none, unknown, made).select("roster_id", "physical_state")


@query("""
SELECT CAST(l_orderkey AS VARCHAR) AS roster_id, l_returnflag AS component_id, CAST(sum(l_linenumber) AS BIGINT) AS required, CAST(CASE l_returnflag WHEN 'A' THEN 5 WHEN 'N' THEN 10 END AS BIGINT) AS capacity,
 CASE WHEN l_returnflag = 'R' THEN 'UNKNOWN_COMPONENT' WHEN sum(l_linenumber) <= CASE l_returnflag WHEN 'A' THEN 5 ELSE 10 END THEN 'PASS' ELSE 'FAIL' END AS status FROM lineitem GROUP BY l_orderkey, l_returnflag
""")
def component_capacity(spark, sf_dir):
    need = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("roster_id"), F.col("l_returnflag").alias("component_id"), F.col("l_linenumber").cast("long").alias("count"))
    return S.component_checks(need, spark.createDataFrame([("A", 5), ("N", 10)], "component_id string, capacity long"))


@query("""
SELECT CAST(o_custkey AS VARCHAR) AS roster_id, count(*) FILTER (WHERE CASE WHEN r > 1 THEN true WHEN o_orderstatus = 'P' THEN true WHEN copy_no >= 4 AND models = 10 THEN true ELSE false END) AS failed FROM (
 SELECT *, CASE WHEN r = 1 AND o_orderstatus <> 'P' THEN row_number() OVER (PARTITION BY o_custkey, o_orderstatus, r = 1 ORDER BY o_orderkey) END AS copy_no FROM (
  SELECT o_custkey, o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN 5 ELSE 10 END AS models, row_number() OVER (PARTITION BY o_custkey, o_orderkey % 10 ORDER BY o_orderkey) AS r FROM orders)) GROUP BY o_custkey
""")
def roster_scoped_checks(spark, sf_dir):
    units = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("roster_id"), F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).alias("row_id"), (F.col("o_orderkey") % 10).cast("string").alias("id"), F.col("o_orderstatus").alias("unit"), F.expr("case when o_orderkey % 2 = 0 then 5 else 10 end").alias("models"))
    catalog = spark.createDataFrame([("F",), ("O",)], "unit string")
    bands = [(u, b, r, m, m * p) for u in "FO" for b, r, p, sizes in ((0, "[1,3]", 2, (5, 10)), (1, "[4,)", 3, (5,))) for m in sizes]
    checks = S.scoped_checks(units, catalog, spark.createDataFrame(bands, "unit string, band_no int, range string, models int, points int"))
    return checks.groupBy("roster_id").agg(F.count_if(F.col("status") == "FAIL").alias("failed"))


@query("SELECT event_id, '$.k' AS path, 'k' AS name, 'number' AS kind, json_extract_string(props, '$.k') AS value FROM events")
def json_walk(spark, sf_dir):
    """Every scalar of the events' JSON properties with its path, whatever their depth."""
    return walk_json(table(spark, sf_dir, "events"), "event_id", "props")


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_path(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", typed_path("props", "$.k", "string").alias("k"))


@query("""
SELECT 'order_status' AS contract, CAST(o_orderkey AS VARCHAR) AS subject, 'o_orderstatus=' || o_orderstatus AS detail, 'ERROR' AS severity FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
UNION ALL SELECT 'line_number', CAST(l_orderkey AS VARCHAR) || '|' || l_linenumber, 'rows=' || count(*), 'ERROR' FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'order_of_line', CAST(l_orderkey AS VARCHAR), 'rows=' || count(*), 'ERROR' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY l_orderkey
UNION ALL SELECT 'totals', 'regions', 'got=5 want=6', 'ERROR' FROM (SELECT count(*) AS n FROM region) WHERE n = 5
UNION ALL SELECT 'balance', CAST(c_custkey AS VARCHAR), 'c_acctbal below zero', 'WARNING' FROM customer WHERE NOT c_acctbal >= 0
""")
def contract_violations(spark, sf_dir):
    """Rules of rows, keys, references and totals, with one scan for each table."""
    tables = {t: table(spark, sf_dir, t) for t in ("orders", "lineitem", "region", "customer")}
    rules = V.Contracts(**tables).vocabulary("orders", "order_status", "o_orderkey", "o_orderstatus", ["F", "O"]).unique("lineitem", "line_number", "l_orderkey", "l_linenumber")
    rules.reference("lineitem", "order_of_line", "l_orderkey", "orders", "o_orderkey").total("region", "totals", "regions", 6)
    return rules.every("customer", "balance", "c_custkey", F.col("c_acctbal") >= 0, "c_acctbal below zero", "WARNING").report()


@query("SELECT count(*) = 0 AS unused, bool_and(r_regionkey >= 0) AS keys, bool_and(length(r_name) > 0) AS names, CASE WHEN bool_and(r_regionkey >= 0) AND bool_and(length(r_name) > 0) AND count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS result FROM region")
def completeness(spark, sf_dir):
    return V.complete(table(spark, sf_dir, "region"), unused=F.lit(False), keys=F.col("r_regionkey") >= 0, names=F.length("r_name") > 0)


@query("""
SELECT 'part' AS contract, CAST(p_partkey AS VARCHAR) AS subject, 'p_size.maximum' AS detail, 'ERROR' AS severity FROM part WHERE p_size > 40
UNION ALL SELECT 'part', CAST(p_partkey AS VARCHAR), 'p_brand.enum', 'ERROR' FROM part WHERE p_brand NOT IN ('Brand#1', 'Brand#2')
""")
def schema_contract(spark, sf_dir):
    schema = {"required": ["p_partkey", "p_name"], "properties": {"p_size": {"minimum": 1, "maximum": 40}, "p_brand": {"enum": ["Brand#1", "Brand#2"]}}}
    return V.schema_violations(table(spark, sf_dir, "part"), "part", "p_partkey", schema)


@query("""
WITH o AS (SELECT o_orderkey AS k, o_custkey % 5 + 1 AS d, CASE WHEN o_orderkey % 7 <> 0 THEN 60 END AS points_limit, CASE o_orderstatus WHEN 'P' THEN 'INFEASIBLE_FROM_SNAPSHOT' WHEN 'F' THEN 'UNKNOWN_COMPONENT_FEASIBILITY' ELSE 'FEASIBLE_PROVISIONAL' END AS physical_state FROM orders),
u AS (SELECT l_orderkey AS k, n, CASE WHEN l_partkey % 11 <> 0 THEN n % 6 END AS id, l_returnflag AS unit, l_linestatus AS name, CASE WHEN n % 2 = 0 THEN 5 ELSE 10 END AS models, l_suppkey % 3 AS item, CAST(l_quantity AS BIGINT) % 3 AS quantity FROM
 (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_linestatus) AS n FROM lineitem)),
g AS (SELECT *, id IS NOT NULL AND unit <> 'R' AND row_number() OVER (PARTITION BY k, id ORDER BY n) = 1 AS usable FROM u),
c AS (SELECT *, row_number() OVER (PARTITION BY k, unit, usable ORDER BY n) AS copy_no FROM g),
p AS (SELECT *, CASE WHEN usable AND copy_no <= 3 THEN models * 2 WHEN usable AND models = 5 THEN 15 END AS base, CASE WHEN usable AND item = 0 THEN quantity * CASE unit WHEN 'A' THEN 4 ELSE 3 END END AS paid FROM c),
t AS (SELECT k, count(*) FILTER (WHERE base IS NULL) + count(*) FILTER (WHERE usable AND item = 1) AS failed, sum(CASE WHEN base IS NULL THEN 0 ELSE base + coalesce(paid, 0) END) AS unit_points,
 max(CASE WHEN usable AND id = 1 THEN unit END) AS leader, max(CASE WHEN usable AND id = 2 THEN unit END) AS bodyguard, max(CASE WHEN n = 1 THEN name END) AS name FROM p GROUP BY k),
e AS (SELECT o.*, coalesce(failed, 0) AS failed, coalesce(unit_points, 0) AS unit_points, leader, bodyguard, name, CASE WHEN d = 1 AND name = 'O' THEN 10 WHEN d = 2 AND name = 'F' THEN 15 END AS bonus FROM o LEFT JOIN t USING (k)),
f AS (SELECT *, unit_points + coalesce(bonus, 0) AS points, failed + CASE WHEN d > 3 THEN 1 ELSE 0 END + CASE WHEN name IS NOT NULL AND bonus IS NULL THEN 1 ELSE 0 END + CASE WHEN bodyguard = 'A' AND leader IS NOT NULL THEN 0 ELSE 1 END AS before FROM e),
s AS (SELECT *, before + CASE WHEN points > points_limit THEN 1 ELSE 0 END AS total_failed FROM f)
SELECT CAST(k AS VARCHAR) AS roster_id, CAST(unit_points AS BIGINT) AS unit_points, CAST(coalesce(bonus, 0) AS BIGINT) AS enhancement_points, CAST(points AS BIGINT) AS points, CAST(points_limit AS BIGINT) AS points_limit, CAST(total_failed AS BIGINT) AS failed,
 CASE WHEN total_failed > 0 THEN 'FAIL' ELSE 'PASS' END AS scoped_legality, physical_state, CASE WHEN total_failed > 0 THEN 'INVALID_SCOPED_RULES' WHEN physical_state LIKE 'INF%' THEN 'SCOPED_RULES_PASS_PHYSICAL_INFEASIBLE' WHEN physical_state LIKE 'UNK%' THEN 'SCOPED_RULES_PASS_PHYSICAL_UNKNOWN' ELSE 'SCOPED_RULES_PASS_PHYSICAL_FEASIBLE' END AS status FROM s
""")
def roster_evaluation(spark, sf_dir):
    """All eight scoped checks of every order as a roster, with one status."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    rosters = orders.select(F.col("o_orderkey").cast("string").alias("roster_id"), (F.col("o_custkey") % 5 + 1).alias("detachment"), F.expr("case when o_orderkey % 7 <> 0 then 60 end").alias("points_limit"), "o_orderstatus")
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"))
    u = lines.withColumns({"roster_id": F.col("l_orderkey").cast("string"), "row_id": place})
    frame = spark.createDataFrame
    requests = {
        "rosters": rosters,
        "units": u.select("roster_id", "row_id", F.expr("case when l_partkey % 11 <> 0 then cast(row_id % 6 as string) end").alias("id"), F.col("l_returnflag").alias("unit"), F.expr("case when row_id % 2 = 0 then 5 else 10 end").alias("models")),
        "wargear": u.filter("l_suppkey % 3 < 2").select("roster_id", "row_id", F.expr("case when l_suppkey % 3 = 0 then 'blade' else 'relic' end").alias("item"), (F.col("l_quantity").cast("long") % 3).alias("quantity")),
        "enhancements": u.filter("row_id = 1").select("roster_id", F.col("l_linestatus").alias("name")),
        "attachments": rosters.select("roster_id", F.lit("1").alias("leader_ref"), F.lit("2").alias("bodyguard_ref")),
    }
    bands = [(x, b, r, m, m * p) for x in "AN" for b, r, p, sizes in ((0, "[1,3]", 2, (5, 10)), (1, "[4,)", 3, (5,))) for m in sizes]
    rules = {
        "units": frame([("A",), ("N",)], "unit string"),
        "bands": frame(bands, "unit string, band_no int, range string, models int, points int"),
        "detachments": frame([(1,), (2,), (3,), (4,), (4,)], "detachment long"),
        "wargear": frame([("A", "blade", 4), ("N", "blade", 3)], "unit string, item string, points int"),
        "enhancements": frame([(1, "O", 10), (2, "F", 15), (4, "O", 20)], "detachment long, name string, points int"),
        "leads": frame([("A", "A"), ("N", "A")], "leader string, bodyguard string"),
    }
    state = F.expr("case o_orderstatus when 'P' then 'INFEASIBLE_FROM_SNAPSHOT' when 'F' then 'UNKNOWN_COMPONENT_FEASIBILITY' else 'FEASIBLE_PROVISIONAL' end")
    return S.evaluate(requests, rules, rosters.select("roster_id", state.alias("physical_state")))
