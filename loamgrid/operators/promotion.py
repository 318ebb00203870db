"""From watch reports to plans, candidates and reviewed promotions.

Plans and checks are plans over rows: a report is a JSON text, read as VARIANT, and as many as there are pass in one job. A promotion has two phases:
tables are staged under the plan's name with a manifest read back from what was written, and one pointer is replaced at the end. Before
that readers see the old version, after it the new one; a stage that fails leaves nothing behind, and the same plan once more does nothing.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import paths
from .aggregates import table_hash


class Refused(ValueError):
    """A promotion that a check stops."""


# Stages with their source, automation and reason, and files that a candidate must not touch.
STAGES = {
    "WAHAPEDIA_INGEST": ("WAHAPEDIA_11E", "AUTOMATED_CANDIDATE", "Download current Wahapedia 11E CSV export into an isolated candidate snapshot."),
    "WAVE_B_RECONCILE": ("MULTI_SOURCE", "AUTOMATED_CANDIDATE", "Reconcile candidate/current Wahapedia structure against current MFM and candidate/current BSData."),
    "WAVE_B_ROSTER_VIEWS": ("WAHAPEDIA_11E", "AUTOMATED_CANDIDATE", "Build candidate roster-specific structural views."),
    "WAHAPEDIA_SEMANTIC_AUDIT": ("WAHAPEDIA_11E", "AUTOMATED_CANDIDATE", "Verify candidate semantic fingerprints against the live Wahapedia export."),
    "OFFICIAL_ASSET_AUDIT": ("GW_40K_DOWNLOADS", "AUTOMATED_CANDIDATE", "When the mirror source catalog changes, verify its referenced official Games Workshop PDF assets before promotion."),
    "BSDATA_FALLBACK_REBUILD": ("BSDATA_WH40K_11E", "AUTOMATED_CANDIDATE", "Rebuild structured-implementation fallback views at the candidate BSData revision."),
    "MFM_NORMATIVE_REVALIDATION": ("GW_MFM", "MANUAL_AUTHORITY_GATE", "Revalidate the official MFM revision before any normative promotion from official or derived MFM drift."),
}
FORBIDDEN = ("coverage/current.json", "rules/11e/current.json", "sources/currentness_gate.json", "sources/registry.json", "reports/CURRENT_HANDOFF.md")
BLOCKERS = {
    "MFM_OFFICIAL_REVALIDATION_REQUIRED": ("GW_MFM", "Official or derived MFM drift requires explicit current Games Workshop revision verification before normative MFM promotion."),
    "UNCLASSIFIED_WATCH_CHANGE": (None, "Watcher reported change but no supported source class was resolved."),
}


def fingerprint(document: dict) -> str:
    """Hash of the canonical JSON: sorted keys, no spaces."""
    return hashlib.sha256(json.dumps(document, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def _get(value: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(value, path, kind)


def _yes(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _listed(value: Column, path: str) -> Column:
    return F.coalesce(_get(value, path, "array<variant>"), F.array().cast("array<variant>"))


def plans(reports: DataFrame, report: str = "report", date: str = "candidate_snapshot_date") -> DataFrame:
    """The reports' rows with state, changed_sources, revisions, stages (in order, each once, with source, automation and reason), blockers, promotion_state,
    required_review, plan_fingerprint and plan_id. Equal reports give equal plans; a text that is no JSON is an unclassified change."""
    watch = F.col("_watch")
    of = lambda field, source: F.get(F.filter(F.concat(_listed(watch, "$.github_sources"), _listed(watch, "$.official_sources")), lambda s: _get(s, "$.source_id") == source), F.lit(0)).alias(field)
    files = F.filter(F.transform(_listed(watch, "$.wahapedia.changed_files"), lambda f: F.struct(_get(f, "$.file").alias("file"), _get(f, "$.status").alias("status"))), lambda f: F.coalesce(f["file"], F.lit("")) != "")
    found = reports.withColumn("_watch", F.try_parse_json(F.col(report))).select("*", of("_bs", "BSDATA_WH40K_11E"), of("_mfm", "GW_MFM"), of("_derived", "BSDATA_MFM_11E"), files.alias("_files"))
    changed = {s: _yes(_get(F.col(c), "$.changed", "boolean")) for s, c in (("BSDATA_WH40K_11E", "_bs"), ("GW_MFM", "_mfm"), ("BSDATA_MFM_11E", "_derived"))}
    mirror = (F.size("_files") > 0) | _yes(_get(watch, "$.change_summary.wahapedia_last_update_changed", "boolean"))
    catalog = mirror & F.exists("_files", lambda f: f["file"] == "Source.csv")
    prices = changed["GW_MFM"] | changed["BSDATA_MFM_11E"]
    active = ~_yes(_get(watch, "$.status") == "NO_CHANGE")
    keep = lambda pairs: F.filter(F.array(*[F.when(active & c, v) for c, v in pairs]), lambda x: x.isNotNull())
    stage = lambda s: F.struct(F.lit(s).alias("id"), *[F.lit(v).alias(n) for n, v in zip(("source", "automation", "reason"), STAGES[s], strict=True)])
    blocker = lambda b: F.struct(F.lit(b).alias("id"), F.lit(BLOCKERS[b][0]).cast("string").alias("source"), F.lit("BLOCKING").alias("severity"), F.lit(BLOCKERS[b][1]).alias("reason"))
    bs = changed["BSDATA_WH40K_11E"]
    when = {"WAHAPEDIA_INGEST": mirror, "WAVE_B_RECONCILE": mirror | bs, "WAVE_B_ROSTER_VIEWS": mirror, "WAHAPEDIA_SEMANTIC_AUDIT": mirror, "OFFICIAL_ASSET_AUDIT": catalog, "BSDATA_FALLBACK_REBUILD": bs, "MFM_NORMATIVE_REVALIDATION": prices}
    sources = {"WAHAPEDIA_11E": mirror, **changed}
    revision = lambda c, was, now, also: F.struct(_get(F.col(c), f"$.{was}").alias(was), _get(F.col(c), f"$.{now}").alias(now.replace("live", "candidate")), _get(F.col(c), f"$.{also}").alias(also))
    revisions = F.struct(
        F.struct(_get(watch, "$.wahapedia.snapshot_last_update").alias("baseline_last_update"), _get(watch, "$.wahapedia.live_last_update").alias("candidate_last_update"), F.size("_files").alias("changed_files"), F.col("_files").alias("changed_files_detail")).alias("wahapedia"),
        revision("_bs", "pinned", "live", "relation_from_pinned_to_live").alias("bsdata_wh40k_11e"),
        revision("_mfm", "pinned_updated_at", "live_updated_at", "state").alias("gw_mfm"),
        revision("_derived", "pinned", "live", "relation_from_pinned_to_live").alias("bsdata_mfm_11e"),
    )
    planned = found.select(
        *reports.columns,
        _get(watch, "$.baseline_snapshot").alias("baseline_snapshot"),
        F.when(active, "CANDIDATE_REQUIRED").otherwise("NO_ACTION").alias("state"),
        keep([(c, F.lit(s)) for s, c in sources.items()]).alias("changed_sources"),
        F.when(active, revisions).alias("candidate_revisions"),
        keep([(c, stage(s)) for s, c in when.items()]).alias("stages"),
        keep([(prices, blocker("MFM_OFFICIAL_REVALIDATION_REQUIRED")), (~(mirror | bs | prices), blocker("UNCLASSIFIED_WATCH_CHANGE"))]).alias("blockers"),
    )
    state = F.when(F.col("state") == "NO_ACTION", "NOT_APPLICABLE").when(F.size("blockers") > 0, "BLOCKED_AUTHORITY_REVALIDATION").otherwise("REVIEW_REQUIRED_AFTER_CANDIDATE_PASS")
    planned = planned.withColumns({"promotion_state": state, "required_review": F.col("state") != "NO_ACTION", "auto_promote": F.lit(False)})
    content = ("baseline_snapshot", "blockers", "candidate_revisions", date, "changed_sources", "promotion_state", "stages", "state")
    marked = planned.withColumn("plan_fingerprint", F.sha2(F.to_json(F.struct(*content)), 256))
    return marked.withColumn("plan_id", F.concat(F.lit("REINGEST_"), F.substring("plan_fingerprint", 1, 12)))


def touched(files: DataFrame, key: str, file: str = "file") -> DataFrame:
    """Of changed files (key, file) those that no candidate may touch, once each."""
    return files.filter(F.col(file).isin(*FORBIDDEN)).select(key, file).distinct()


def candidates(plans: DataFrame, results: DataFrame, files: DataFrame) -> DataFrame:
    """One report for each plan (plan_id, plan_fingerprint, stages, blockers): status, promotion_gate and forbidden_current_authority_mutations.

    results has plan_id, id and status of the stages that ran. Stages count in the plan's order up to the first failure; one without a result awaits its manual gate.
    """
    staged = plans.select("plan_id", F.posexplode("stages.id").alias("nth", "id")).join(results.select("plan_id", "id", "status"), ["plan_id", "id"], "left")
    order = F.col("nth") <= F.coalesce(F.col("stop"), F.col("nth"))
    stop = staged.filter("status = 'FAIL'").groupBy("plan_id").agg(F.min("nth").alias("stop"))
    ran = staged.join(stop, "plan_id", "left").filter(order)
    by = ran.groupBy("plan_id").agg(F.bool_or(F.col("stop").isNotNull()).alias("failed"), F.bool_or(F.col("status").isNull()).alias("manual"), F.count("*").alias("stages_run"))
    bad = touched(files, "plan_id").groupBy("plan_id").agg(F.sort_array(F.collect_set("file")).alias("mutations"))
    rows = plans.join(by, "plan_id", "left").join(bad, "plan_id", "left")
    failed, blocked = _yes(F.col("failed")) | F.col("mutations").isNotNull(), (F.size("blockers") > 0) | _yes(F.col("manual"))
    return rows.select(
        "plan_id",
        "plan_fingerprint",
        F.coalesce("stages_run", F.lit(0)).alias("stages_run"),
        F.coalesce("mutations", F.array().cast("array<string>")).alias("forbidden_current_authority_mutations"),
        F.when(failed, "CANDIDATE_FAILED").when(blocked, "BLOCKED_AUTHORITY_REVALIDATION").otherwise("ELIGIBLE_FOR_REVIEWED_PROMOTION").alias("promotion_gate"),
        F.when(failed, "FAIL").when(blocked, "PASS_WITH_BLOCKER").otherwise("PASS").alias("status"),
        F.lit(False).alias("auto_promote"),
    )


#: Documents that a check reads, as JSON texts; those after the first two are evidence that only some changes ask for.
DOCUMENTS = ("plan", "report", "manifest", "views", "reconciliation", "semantic", "official_assets", "fallback")


def refusals(rows: DataFrame, rosters: int = 37) -> DataFrame:
    """The rows of DOCUMENTS with `refusal`, the first condition of a promotion that doesn't hold, or null. What a document doesn't say doesn't hold.

    Every document is parsed once; the conditions read what was parsed.
    """
    d = {n: F.col(f"_{n}") for n in DOCUMENTS}
    parsed = rows.select("*", *[F.try_parse_json(F.col(n)).alias(f"_{n}") for n in DOCUMENTS])
    text = lambda n, path: _get(d[n], path)
    number = lambda n, path: _get(d[n], path, "long")
    flag = lambda n, path: _get(d[n], path, "boolean")
    none_of = lambda n, path: F.size(_get(d[n], path, "array<variant>")) == 0
    changed = _get(d["plan"], "$.changed_sources", "array<string>")
    has = lambda s: _yes(F.array_contains(changed, s))
    mirror, code = has("WAHAPEDIA_11E"), has("BSDATA_WH40K_11E")
    # an empty place asks for nothing, a document of whatever content asks for a pass
    assets = F.col("official_assets").isNotNull()
    catalog = F.exists(_listed(d["plan"], "$.candidate_revisions.wahapedia.changed_files_detail"), lambda f: _yes(_get(f, "$.file") == "Source.csv"))
    key = lambda path: text("plan", path).rlike(r"^[A-Za-z0-9][A-Za-z0-9._-]*$") & ~text("plan", path).contains("..")
    every = F.lit(True)
    conditions: list[tuple[Column, Column, str]] = [
        (every, text("plan", "$.state") == "CANDIDATE_REQUIRED", "the plan asks for no candidate"),
        (every, text("report", "$.plan_id") == text("plan", "$.plan_id"), "the report is about another plan"),
        (every, text("report", "$.plan_fingerprint") == text("plan", "$.plan_fingerprint"), "the plan changed since the report"),
        (every, text("report", "$.status") == "PASS", "the candidate did not pass"),
        (every, text("report", "$.promotion_gate") == "ELIGIBLE_FOR_REVIEWED_PROMOTION", "the gate is closed"),
        (every, ~flag("report", "$.auto_promote") & ~flag("plan", "$.promotion.auto_promote"), "promotion must be reviewed"),
        (every, none_of("plan", "$.blockers"), "the plan has blockers"),
        (every, none_of("report", "$.forbidden_current_authority_mutations"), "the candidate touched current authority"),
        (every, changed.isNotNull() & ~has("BSDATA_MFM_11E"), "derived prices need the official gate"),
        (every, key("$.plan_id") & key("$.candidate_snapshot_date"), "the plan's keys are unsafe"),
        (mirror, number("views", "$.counts.roster_identities") == rosters, "the roster views are incomplete"),
        (mirror, number("views", "$.counts.structural_partial") == 0, "roster views are partial"),
        (mirror, text("reconciliation", "$.status").isin("PASS", "PASS_WITH_CONFLICTS"), "reconciliation did not pass"),
        (mirror, (text("semantic", "$.status") == "PASS") & none_of("semantic", "$.problems"), "the fingerprint audit did not pass"),
        (mirror, number("semantic", "$.counts.MATCH") == number("semantic", "$.expected_fingerprints"), "fingerprints are missing"),
        (mirror, text("semantic", "$.snapshot_last_update") == text("manifest", "$.source.last_update"), "audit and manifest differ in revision"),
        (mirror & catalog, assets, "changed sources need an asset audit"),
        (mirror & assets, (text("official_assets", "$.status") == "PASS") & (number("official_assets", "$.live_source_csv.catalog_drift_count") == 0), "the asset audit did not pass"),
        (code, text("fallback", "$.commit_sha") == text("plan", "$.candidate_revisions.bsdata_wh40k_11e.candidate"), "the fallback is of another revision"),
    ]
    first = F.coalesce(*[F.when(asked & ~_yes(holds), reason) for asked, holds, reason in conditions])
    return parsed.select(*[F.col(c) for c in rows.columns], first.alias("refusal"))


# --- two phases -----------------------------------------------------------------------------------------------------------


def safe_key(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", name or "") or ".." in name:
        raise Refused(f"unsafe key {name!r}")
    return name


def current(spark: SparkSession, root: str) -> dict:
    """What the pointer says: version, previous, promoted_at; {} before the first promotion."""
    return json.loads(paths.read_text(spark, f"{root}/current.json") or "{}")


def read_current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the version that the pointer names now."""
    return spark.read.parquet(f"{root}/versions/{current(spark, root)['version']}/{name}")


def _manifest(spark: SparkSession, folder: str, names: list[str]) -> dict:
    """Rows and hash of each table, read from what was written."""
    found = {}
    for name in names:
        row = table_hash(spark.read.parquet(f"{folder}/{name}")).first()
        found[name] = {"rows": row["rows"], "hash": str(row["hash"])}
    return found


def stage(spark: SparkSession, root: str, plan_id: str, tables: dict[str, Callable[[], DataFrame]]) -> dict:
    """First phase: writes every table under the plan's name and a manifest of what can be read back. A failure removes all of it and is raised again."""
    folder = f"{root}/versions/{safe_key(plan_id)}"
    if written := paths.read_text(spark, f"{folder}/manifest.json"):
        return json.loads(written)
    paths.delete(spark, folder)  # what an interrupted run has left
    try:
        for name, make in tables.items():
            make().write.mode("errorifexists").parquet(f"{folder}/{safe_key(name)}")
        manifest = {"plan_id": plan_id, "tables": _manifest(spark, folder, list(tables))}
        paths.write_text(spark, f"{folder}/manifest.json", json.dumps(manifest, sort_keys=True))
    except BaseException:
        paths.delete(spark, folder)
        raise
    return manifest


def promote(spark: SparkSession, root: str, plan_id: str, tables: dict[str, Callable[[], DataFrame]], promoted_at: str) -> str:
    """Both phases: "PROMOTED", or "ALREADY_CURRENT" if the pointer names the plan. Staged tables are read once more and must equal their manifest before the pointer is replaced."""
    now = current(spark, root)
    if now.get("version") == plan_id:
        return "ALREADY_CURRENT"
    manifest = stage(spark, root, plan_id, tables)
    folder = f"{root}/versions/{plan_id}"
    if _manifest(spark, folder, list(manifest["tables"])) != manifest["tables"]:
        raise Refused("staged tables differ from their manifest")
    if current(spark, root) != now:
        raise Refused("another promotion came first")
    paths.write_text(spark, f"{root}/current.json", json.dumps({"version": plan_id, "previous": now.get("version"), "promoted_at": promoted_at}, sort_keys=True))
    return "PROMOTED"


def roll_back(spark: SparkSession, root: str) -> str:
    """The pointer back to the version before; returns its name."""
    now = current(spark, root)
    if not now.get("previous"):
        raise Refused("no version before")
    paths.write_text(spark, f"{root}/current.json", json.dumps({"version": now["previous"], "previous": None, "promoted_at": now["promoted_at"]}, sort_keys=True))
    return now["previous"]
