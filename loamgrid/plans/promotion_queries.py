"""Queries of plans, candidates and promotions; reports and documents are JSON texts made of the customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import audit
from ..operators import promotion as P
from ..session import cut, spread, table
from ..sources import paths
from .base import query

def _k() -> Column:
    return F.col("c_custkey")


def _every(n: int) -> Column:
    return _k() % n == 0


def _reports(spark, sf_dir) -> DataFrame:
    """c_custkey, candidate_snapshot_date and a watch report for each customer."""
    changed = lambda source, n, **more: F.struct(F.lit(source).alias("source_id"), _every(n).alias("changed"), *[v.alias(k) for k, v in more.items()])
    file = lambda name, when: F.when(when, F.struct(F.lit(name).alias("file"), F.lit("CHANGED").alias("status")))
    report = F.struct(
        F.when(_every(7), "NO_CHANGE").otherwise("CHANGE_DETECTED").alias("status"),
        F.lit("2026-09-29").alias("baseline_snapshot"),
        F.array(changed("BSDATA_WH40K_11E", 4, pinned=F.lit("p"), live=F.concat(F.lit("l"), _k())), changed("BSDATA_MFM_11E", 10, pinned=F.lit("p"), live=F.lit("q"))).alias("github_sources"),
        F.array(changed("GW_MFM", 13)).alias("official_sources"),
        F.struct(F.array_compact(F.array(file("Datasheets.csv", _every(3)), file("Source.csv", _every(6)))).alias("changed_files"), F.lit("new").alias("live_last_update")).alias("wahapedia"),
        F.struct(_every(11).alias("wahapedia_last_update_changed")).alias("change_summary"),
    )
    customers = spread(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey")
    return customers.select("c_custkey", F.lit("2026-10-20").alias("candidate_snapshot_date"), F.to_json(report).alias("report"))


_PLANS_SQL = """
    facts AS (
        SELECT c_custkey AS k, c_custkey % 7 <> 0 AS active, c_custkey % 3 = 0 OR c_custkey % 11 = 0 AS mirror, c_custkey % 6 = 0 AS catalog, c_custkey % 4 = 0 AS code, c_custkey % 13 = 0 AS official, c_custkey % 10 = 0 AS derived FROM customer
    ), planned AS (
        SELECT *, CASE WHEN active THEN list_filter([CASE WHEN mirror THEN 'WAHAPEDIA_INGEST' END, CASE WHEN mirror OR code THEN 'WAVE_B_RECONCILE' END, CASE WHEN mirror THEN 'WAVE_B_ROSTER_VIEWS' END, CASE WHEN mirror THEN 'WAHAPEDIA_SEMANTIC_AUDIT' END,
                    CASE WHEN catalog THEN 'OFFICIAL_ASSET_AUDIT' END, CASE WHEN code THEN 'BSDATA_FALLBACK_REBUILD' END, CASE WHEN official OR derived THEN 'MFM_NORMATIVE_REVALIDATION' END], lambda x: x IS NOT NULL) ELSE [] END AS stages,
               CASE WHEN NOT active THEN '' WHEN official OR derived THEN 'MFM_OFFICIAL_REVALIDATION_REQUIRED' WHEN NOT (mirror OR code) THEN 'UNCLASSIFIED_WATCH_CHANGE' ELSE '' END AS blockers
        FROM facts
    )"""


@query(f"""
WITH {_PLANS_SQL}
SELECT k AS c_custkey, CASE WHEN active THEN 'CANDIDATE_REQUIRED' ELSE 'NO_ACTION' END AS state,
       CASE WHEN active THEN concat_ws(',', CASE WHEN mirror THEN 'WAHAPEDIA_11E' END, CASE WHEN code THEN 'BSDATA_WH40K_11E' END, CASE WHEN official THEN 'GW_MFM' END, CASE WHEN derived THEN 'BSDATA_MFM_11E' END) ELSE '' END AS changed_sources,
       array_to_string(stages, ',') AS stages, len(list_filter(stages, lambda s: s = 'MFM_NORMATIVE_REVALIDATION')) AS manual, blockers,
       CASE WHEN NOT active THEN 'NOT_APPLICABLE' WHEN blockers <> '' THEN 'BLOCKED_AUTHORITY_REVALIDATION' ELSE 'REVIEW_REQUIRED_AFTER_CANDIDATE_PASS' END AS promotion_state,
       CASE WHEN active THEN 'l' || k END AS candidate, CASE WHEN active THEN (k % 3 = 0)::INT + (k % 6 = 0)::INT END AS files
FROM planned
""")
def reingestion_plans(spark, sf_dir):
    """What every watch report leads to: ordered stages with reasons, blockers, revisions."""
    rows = P.plans(_reports(spark, sf_dir))
    named = lambda c: F.array_join(F.transform(c, lambda x: x["id"]), ",")
    reasoned = F.filter("stages", lambda s: (s["automation"] == "MANUAL_AUTHORITY_GATE") & (F.length(s["reason"]) > 0))
    return rows.select("c_custkey", "state", F.array_join("changed_sources", ",").alias("changed_sources"), named("stages").alias("stages"), F.size(reasoned).cast("long").alias("manual"), named("blockers").alias("blockers"), "promotion_state", F.col("candidate_revisions.bsdata_wh40k_11e.candidate").alias("candidate"), F.col("candidate_revisions.wahapedia.changed_files").alias("files"))


@query(f"""
WITH {_PLANS_SQL}, ran AS (
    SELECT k, blockers, s, n, (k + length(s)) % 9 = 0 AND s <> 'MFM_NORMATIVE_REVALIDATION' AS bad FROM (SELECT k, blockers, unnest(stages) AS s, generate_subscripts(stages, 1) AS n FROM planned WHERE active)
), stops AS (
    SELECT k, min(n) FILTER (bad) AS stop FROM ran GROUP BY k
), counted AS (
    SELECT k, count(*) AS stages_run, bool_or(bad) AS failed, bool_or(s = 'MFM_NORMATIVE_REVALIDATION') AS manual FROM ran JOIN stops USING (k) WHERE n <= coalesce(stop, n) GROUP BY k
)
SELECT p.k AS c_custkey, coalesce(stages_run, 0) AS stages_run, CASE WHEN p.k % 17 = 0 THEN 'sources/registry.json' ELSE '' END AS mutations,
       CASE WHEN coalesce(failed, false) OR p.k % 17 = 0 THEN 'CANDIDATE_FAILED' WHEN blockers <> '' OR coalesce(manual, false) THEN 'BLOCKED_AUTHORITY_REVALIDATION' ELSE 'ELIGIBLE_FOR_REVIEWED_PROMOTION' END AS promotion_gate,
       CASE WHEN coalesce(failed, false) OR p.k % 17 = 0 THEN 'FAIL' WHEN blockers <> '' OR coalesce(manual, false) THEN 'PASS_WITH_BLOCKER' ELSE 'PASS' END AS status
FROM planned p LEFT JOIN counted USING (k) WHERE active
""")
def candidate_reports(spark, sf_dir):
    """Stages of all plans with their results: the first failure stops a plan, a file that no candidate may touch fails it."""
    plans = cut(P.plans(_reports(spark, sf_dir)).filter("state = 'CANDIDATE_REQUIRED'"))
    ids = plans.select("plan_id", "c_custkey", F.explode("stages.id").alias("id")).filter("id <> 'MFM_NORMATIVE_REVALIDATION'")
    results = ids.select("plan_id", "id", F.when((_k() + F.length("id")) % 9 == 0, "FAIL").otherwise("PASS").alias("status"))
    files = plans.select("plan_id", F.explode(F.array_compact(F.array(F.lit("x.json"), F.when(_every(17), "sources/registry.json")))).alias("file"))
    rows = P.candidates(plans, results, files).join(plans.select("plan_id", "c_custkey"), "plan_id")
    return rows.select("c_custkey", F.col("stages_run").cast("long").alias("stages_run"), F.array_join("forbidden_current_authority_mutations", ",").alias("mutations"), "promotion_gate", "status")


#: What is wrong with the documents of customer k, by k modulo their number, and the refusal that it leads to.
_FAULTS = (
    ("", None),
    ("state", "the plan asks for no candidate"),
    ("id", "the report is about another plan"),
    ("fingerprint", "the plan changed since the report"),
    ("status", "the candidate did not pass"),
    ("gate", "the gate is closed"),
    ("auto", "promotion must be reviewed"),
    ("blockers", "the plan has blockers"),
    ("mutations", "the candidate touched current authority"),
    ("no mutations", "the candidate touched current authority"),
    ("derived", "derived prices need the official gate"),
    ("key", "the plan's keys are unsafe"),
    ("rosters", "the roster views are incomplete"),
    ("partial", "roster views are partial"),
    ("reconciliation", "reconciliation did not pass"),
    ("problems", "the fingerprint audit did not pass"),
    ("fingerprints", "fingerprints are missing"),
    ("revision", "audit and manifest differ in revision"),
    ("no assets", "changed sources need an asset audit"),
    ("drift", "the asset audit did not pass"),
    ("commit", "the fallback is of another revision"),
    ("broken", "the plan asks for no candidate"),
)


def _documents(spark, sf_dir) -> DataFrame:
    fault = F.element_at(F.array(*[F.lit(x) for x, _ in _FAULTS]), (_k() % len(_FAULTS)).cast("int") + 1)
    pick = lambda name, bad, good: F.when(fault == name, bad).otherwise(good)
    text = F.lit
    none = F.array().cast("array<string>")
    plan_id, mark = F.concat(text("REINGEST_"), _k()), F.sha2(_k().cast("string"), 256)
    plan = F.struct(
        pick("state", text("NO_ACTION"), text("CANDIDATE_REQUIRED")).alias("state"), plan_id.alias("plan_id"), mark.alias("plan_fingerprint"), F.struct(F.lit(False).alias("auto_promote")).alias("promotion"),
        pick("blockers", F.array(text("b")), none).alias("blockers"), pick("key", text("../up"), text("2026-10-20")).alias("candidate_snapshot_date"),
        pick("derived", F.array(text("BSDATA_MFM_11E")), F.array(text("WAHAPEDIA_11E"), text("BSDATA_WH40K_11E"))).alias("changed_sources"),
        F.struct(F.struct(F.array(F.struct(text("Source.csv").alias("file"))).alias("changed_files_detail")).alias("wahapedia"), F.struct(text("abc").alias("candidate")).alias("bsdata_wh40k_11e")).alias("candidate_revisions"),
    )
    report = F.struct(
        pick("id", text("other"), plan_id).alias("plan_id"), pick("fingerprint", text("other"), mark).alias("plan_fingerprint"), pick("status", text("FAIL"), text("PASS")).alias("status"), pick("gate", text("CANDIDATE_FAILED"), text("ELIGIBLE_FOR_REVIEWED_PROMOTION")).alias("promotion_gate"),
        pick("auto", F.lit(True), F.lit(False)).alias("auto_promote"), F.when(fault == "mutations", F.array(text("x"))).when(fault != "no mutations", none).alias("forbidden_current_authority_mutations"),
    )
    views = F.struct(F.struct(pick("rosters", F.lit(36), F.lit(37)).alias("roster_identities"), pick("partial", F.lit(1), F.lit(0)).alias("structural_partial")).alias("counts"))
    semantic = F.struct(text("PASS").alias("status"), pick("problems", F.array(text("p")), none).alias("problems"), F.struct(pick("fingerprints", F.lit(8), F.lit(9)).alias("MATCH")).alias("counts"), F.lit(9).alias("expected_fingerprints"), text("r1").alias("snapshot_last_update"))
    assets = F.struct(text("PASS").alias("status"), F.struct(pick("drift", F.lit(2), F.lit(0)).alias("catalog_drift_count")).alias("live_source_csv"))
    made = {
        "plan": F.when(fault == "broken", "{").otherwise(F.to_json(plan)),
        "report": F.to_json(report),
        "manifest": F.to_json(F.struct(F.struct(pick("revision", text("r2"), text("r1")).alias("last_update")).alias("source"))),
        "views": F.to_json(views),
        "reconciliation": F.to_json(F.struct(pick("reconciliation", text("FAIL"), text("PASS_WITH_CONFLICTS")).alias("status"))),
        "semantic": F.to_json(semantic),
        "official_assets": F.when(fault != "no assets", F.to_json(assets)),
        "fallback": F.to_json(F.struct(pick("commit", text("old"), text("abc")).alias("commit_sha"))),
    }
    return spread(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey").select("c_custkey", *[v.alias(k) for k, v in made.items()])


@query(f"SELECT c_custkey, CASE c_custkey % {len(_FAULTS)} " + " ".join(f"WHEN {i} THEN '{r.replace(chr(39), chr(39) * 2)}'" for i, (_, r) in enumerate(_FAULTS) if r) + " END AS refusal FROM customer")
def promotion_refusals(spark, sf_dir):
    """Why each customer's documents may not be promoted; every condition meets both outcomes."""
    return P.refusals(_documents(spark, sf_dir)).select("c_custkey", "refusal")


@query("SELECT o_orderkey, o_custkey + 1 AS o_custkey, 'ALREADY_CURRENT' AS replay, 'failed' AS third, 'REINGEST_2' AS version FROM orders")
def promoted_orders(spark, sf_dir):
    """Two versions promoted, the second once more, a third that fails in its second table; what readers see then."""
    root = paths.new_folder(spark, "promotion")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    versions = {f"REINGEST_{n}": {"orders": lambda n=n: orders.withColumn("o_custkey", F.col("o_custkey") + n - 1), "sums": lambda: orders.groupBy("o_custkey").count()} for n in (1, 2)}
    done = [P.promote(spark, root, name, tables, "2026-10-20") for name, tables in [*versions.items(), ("REINGEST_2", versions["REINGEST_2"])]]
    try:
        P.promote(spark, root, "REINGEST_3", {"orders": lambda: orders.limit(1), "sums": lambda: orders.select(F.raise_error(F.lit("no source")).alias("x"))}, "2026-10-21")
        third = "promoted"
    except Exception as e:  # noqa: BLE001  the engine's own error, whatever its class
        third = "failed" if "no source" in str(e) and not paths.exists(spark, f"{root}/versions/REINGEST_3") else "left over"
    rows = P.read_current(spark, root, "orders").withColumns({"replay": F.lit(done[2]), "third": F.lit(third), "version": F.lit(P.current(spark, root)["version"])})
    return paths.read_and_removed(rows, root)


_COVERAGE = ("points", "balance", "segment", "orders")
_COVERAGE_SQL = """
    covered AS (
        SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 3 = 0 THEN 100 WHEN c_custkey % 3 = 1 THEN 40 ELSE 0 END AS points, CASE WHEN c_acctbal > 0 THEN 100 ELSE 0 END AS balance,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE 100 END AS segment, CASE WHEN c_nationkey < 20 THEN 100 ELSE 0 END AS orders FROM customer
    ), long AS (
        SELECT c_custkey, unnest(['points', 'balance', 'segment', 'orders']) AS dimension, unnest([points, balance, segment, orders]) AS v FROM covered
    )"""


@query(f"""
WITH {_COVERAGE_SQL}
SELECT 'gap' AS section, CAST(c_custkey AS VARCHAR) AS subject, dimension, CASE WHEN v = 0 THEN 'OPEN' ELSE 'PARTIAL' END AS state, CAST(v AS BIGINT) AS n FROM long WHERE v <> 100
UNION ALL SELECT 'dimension', '', dimension, 'COMPLETE', count(*) FILTER (v = 100) FROM long GROUP BY dimension
UNION ALL SELECT 'dimension', '', dimension, 'MISSING', count(*) FILTER (v = 0) FROM long GROUP BY dimension
UNION ALL SELECT 'layer', 'KEYS', '', CASE WHEN bool_and(c_custkey >= 0) THEN 'CLOSED' ELSE 'PENDING' END, count(*) FROM covered
UNION ALL SELECT 'layer', 'BALANCES', '', CASE WHEN bool_and(balance = 100) THEN 'CLOSED' ELSE 'PENDING' END, count(*) FROM covered
UNION ALL SELECT 'next', 'BALANCE_REVIEW', '', '', 0
""")
def gap_audit(spark, sf_dir):
    """Coverage of all customers, four dimensions, after a promotion of one of them by exact counts: gaps, counts and conjunctions of one pass."""
    customers = table(spark, sf_dir, "customer")
    complete = F.col("c_nationkey") < 20
    start = F.create_map(F.lit("points"), F.when(_every(3), 100).when(_k() % 3 == 1, 40).otherwise(0), F.lit("balance"), F.when(F.col("c_acctbal") > 0, 100).otherwise(0), F.lit("segment"), F.when(F.col("c_mktsegment") == "BUILDING", 0).otherwise(100))
    rows = customers.withColumn("coverage", start)
    want = customers.agg(F.count_if(complete), F.count_if(~complete)).first()
    rows = audit.structural_promotion(rows, "coverage", complete, ["orders"], (want[0], want[1]))
    path = paths.new_folder(spark, "audit")
    found = audit.gap_audit(rows, "c_custkey", "coverage", list(_COVERAGE), {"KEYS": _k() >= 0, "BALANCES": F.col("c_acctbal") > 0}, path)
    milestone = found.next_milestone({"KEYS": "KEY_REVIEW", "BALANCES": "BALANCE_REVIEW"}, "NONE")
    report = found.report()
    return paths.read_and_removed(report.unionAll(spark.createDataFrame([("next", milestone, "", "", 0)], report.schema)), path)
