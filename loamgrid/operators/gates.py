"""State machines and gates: currentness, releases, drift lineage, candidates, promotion. All fail closed."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .classify import case

yes = lambda c: F.coalesce(c, F.lit(False))  # noqa: E731  only a real true confirms


def drift_lineage(norm: Column, mirror: Column, pinned: Column, live: Column, runtime: Column) -> Column:
    """Where a runtime value that differs from the normative one comes from."""
    mirror_ok = mirror == norm
    return case(
        [
            (runtime == norm, "NORMATIVE_MATCH"),
            (mirror_ok & (pinned != live) & (runtime == pinned) & (live == norm), "UPSTREAM_REVISION_DRIFT"),
            (mirror_ok & (pinned == runtime) & (live == runtime), "IMPLEMENTATION_DRIFT"),
            (mirror_ok & (pinned == norm) & (live == norm), "RUNTIME_PROJECTION_DRIFT"),
        ],
        "UNKNOWN_RUNTIME_DRIFT",
    )


# What to do about each class of drift.
ADVICE = {
    "NORMATIVE_MATCH": "No action required.",
    "IMPLEMENTATION_DRIFT": "Do not change normative KB data. Investigate/fix BSData implementation and then verify downstream projection.",
    "RUNTIME_PROJECTION_DRIFT": "Do not change normative KB data. Investigate New Recruit projection/cache synchronization against current BSData.",
    "UPSTREAM_REVISION_DRIFT": "Do not change normative KB data. Run normal ingestion/reconciliation before moving the pinned revision, then verify runtime catch-up.",
    "UNKNOWN_RUNTIME_DRIFT": "Do not change normative KB data. Gather additional source-lineage evidence before assigning ownership.",
}


def advice(drift: Column) -> Column:
    return case([(drift == k, v) for k, v in ADVICE.items()])


def path_class(path: Column) -> Column:
    """The kind of a changed file."""
    p = F.lower(F.coalesce(path, F.lit("")))
    chapter = p.rlike("space marine|black templar|blood angel|dark angel|space wolves")
    return case(
        [(chapter, "ASTARTES"), (p.startswith("data/"), "MFM_DATA"), (p.endswith(".json"), "FACTION_OR_LIBRARY_DATA"), (p.endswith(".md") | p.contains("readme"), "DOCUMENTATION"), (p.contains(".github/"), "CI")],
        "OTHER",
    )


def upstream_changed(relation: Column) -> Column:
    """A live head that is the same as the pinned one or behind it is no drift."""
    return ~yes(relation.isin("identical", "behind"))


def official_changed(state: Column, live: Column, pinned: Column) -> Column:
    """A page that can't be read counts as changed."""
    return ~yes(state == "PASS") | ~live.eqNullSafe(pinned)


def transition(confirmed: Column, scoped: Column, applied: Column, changed: Column, release: Column, as_of: Column) -> tuple[Column, Column]:
    """Release state and whether a candidate may be built. A date alone never promotes."""
    state = case(
        [
            (yes(scoped) & yes(applied), "CURRENT_SCOPED_RECONCILED"),
            (yes(confirmed) & yes(changed), "READY_FOR_GUARDED_REINGESTION"),
            (yes(confirmed), "CURRENT_LEGAL_CONFIRMED_WAITING_UPSTREAM_PROJECTION"),
            (release.isNull(), "UPCOMING_HOLD_NO_RELEASE_DATE"),
            (as_of < release, "PRE_RELEASE_HOLD"),
        ],
        "RELEASE_DATE_REACHED_AWAITING_OFFICIAL_CURRENTNESS",
    )
    return state, state == "READY_FOR_GUARDED_REINGESTION"


# The action that each release state asks for.
ACTION = {
    "CURRENT_SCOPED_RECONCILED": "NO_ACTION_SCOPED_CURRENT",
    "READY_FOR_GUARDED_REINGESTION": "BUILD_ISOLATED_CANDIDATE",
    "CURRENT_LEGAL_CONFIRMED_WAITING_UPSTREAM_PROJECTION": "WAIT_FOR_UPSTREAM_CHANGE",
    "UPCOMING_HOLD_NO_RELEASE_DATE": "WAIT_FOR_OFFICIAL_CURRENT_LEGAL_EVIDENCE",
    "PRE_RELEASE_HOLD": "WAIT_UNTIL_RELEASE_DATE_THEN_RECHECK_OFFICIAL_CURRENTNESS",
    "RELEASE_DATE_REACHED_AWAITING_OFFICIAL_CURRENTNESS": "REQUIRE_OFFICIAL_CURRENT_LEGAL_CONFIRMATION",
}


def transition_action(state: Column) -> Column:
    """What a release state asks for; another state gives null."""
    return case([(state == k, v) for k, v in ACTION.items()])


# Watch status and action of each release state.
WATCH = {
    "PRE_RELEASE_HOLD": ("NO_ACTION", "WAIT_PRE_RELEASE"),
    "UPCOMING_HOLD_NO_RELEASE_DATE": ("NO_ACTION", "WAIT_OFFICIAL_RELEASE_SIGNAL"),
    "RELEASE_DATE_REACHED_AWAITING_OFFICIAL_CURRENTNESS": ("ACTION_REQUIRED", "VERIFY_AND_RECORD_OFFICIAL_CURRENT_LEGAL_EVIDENCE"),
    "CURRENT_LEGAL_CONFIRMED_WAITING_UPSTREAM_PROJECTION": ("MONITORING", "WAIT_FOR_UPSTREAM_PROJECTION_CHANGE"),
    "READY_FOR_GUARDED_REINGESTION": ("READY_FOR_CANDIDATE", "BUILD_GUARDED_REINGESTION_CANDIDATE"),
    "CURRENT_SCOPED_RECONCILED": ("NO_ACTION", "ALREADY_CURRENT_SCOPED"),
}


def watch(state: Column) -> tuple[Column, Column]:
    return case([(state == k, v[0]) for k, v in WATCH.items()]), case([(state == k, v[1]) for k, v in WATCH.items()])


def fleet_status(status: Column) -> Column:
    """One status over all transitions (an aggregate)."""
    any_ = lambda s: yes(F.bool_or(status == s))
    return case([(any_("READY_FOR_CANDIDATE"), "READY_FOR_GUARDED_CANDIDATE"), (any_("ACTION_REQUIRED"), "ACTION_REQUIRED"), (any_("MONITORING"), "MONITORING_UPSTREAM_PROJECTION")], "NO_ACTION_REQUIRED")


def candidate_gate(hard_fail: Column, blockers: Column, manual_block: Column) -> tuple[Column, Column]:
    """Promotion gate and status of a candidate run."""
    blocked = (blockers > 0) | yes(manual_block)
    gate = case([(yes(hard_fail), "CANDIDATE_FAILED"), (blocked, "BLOCKED_AUTHORITY_REVALIDATION")], "ELIGIBLE_FOR_REVIEWED_PROMOTION")
    return gate, case([(yes(hard_fail), "FAIL"), (blocked, "PASS_WITH_BLOCKER")], "PASS")


def asset_class(name: Column, link: Column, status: Column, magic_ok: Column, prefix: str, separate: str) -> Column:
    """How a published asset was verified."""
    return case(
        [(name == separate, "HANDLED_BY_WAVE_A_MFM"), (F.coalesce(link, F.lit("")) == "", "NO_PUBLIC_ASSET_DECLARED"), (~link.startswith(prefix), "NON_OFFICIAL_ASSET_URL"), (yes(status == 200) & yes(magic_ok), "PASS")],
        "FAIL",
    )


def view_status(available: Column, unresolved: Column) -> Column:
    return case([(~yes(available), "UNAVAILABLE"), (unresolved == 0, "STRUCTURAL_COMPLETE")], "STRUCTURAL_PARTIAL")


def feasibility(infeasible: Column, unknown: Column, build: Column, conversion: Column) -> Column:
    return case(
        [
            (yes(infeasible), "INFEASIBLE_FROM_SNAPSHOT"),
            (yes(unknown), "UNKNOWN_COMPONENT_FEASIBILITY"),
            ((build > 0) & (conversion > 0), "FEASIBLE_WITH_BUILD_AND_CONVERSION_PROVISIONAL"),
            (build > 0, "FEASIBLE_WITH_BUILD_PROVISIONAL"),
            (conversion > 0, "FEASIBLE_WITH_CONVERSION_PROVISIONAL"),
        ],
        "FEASIBLE_PROVISIONAL",
    )


def overall_status(failed: Column, physical: Column) -> Column:
    return case(
        [(failed > 0, "INVALID_SCOPED_RULES"), (physical == "INFEASIBLE_FROM_SNAPSHOT", "SCOPED_RULES_PASS_PHYSICAL_INFEASIBLE"), (physical == "UNKNOWN_COMPONENT_FEASIBILITY", "SCOPED_RULES_PASS_PHYSICAL_UNKNOWN")],
        "SCOPED_RULES_PASS_PHYSICAL_FEASIBLE",
    )


def exit_code(status: Column) -> Column:
    """What a command line returns for a roster's status."""
    return case([(status == "SCOPED_RULES_PASS_PHYSICAL_FEASIBLE", F.lit(0)), (status == "INVALID_SCOPED_RULES", F.lit(2)), (status == "SCOPED_RULES_PASS_PHYSICAL_INFEASIBLE", F.lit(3))], F.lit(4))


def interaction(kind: Column, n: Column, m: Column, first: Column, second: Column) -> Column:
    """Answers to five kinds of rule questions; n and m are counts, first and second exceptions that the rules name."""
    n, m, first, second = F.coalesce(n, F.lit(0)), F.coalesce(m, F.lit(0)), yes(first), yes(second)
    return case(
        [
            (kind == "can_make_normal_move", F.when((n < 1) | first, "YES").otherwise("NO")),
            (kind == "gain_extra_cp", F.when(F.greatest(F.lit(0), 1 - n) >= m, "YES").otherwise("NO")),
            (kind == "can_use_stratagem", F.when(((n >= 1) & ~first) | ((m >= 1) & ~second), "NO").otherwise("YES")),
            (kind == "adjust_stratagem_cp_cost", F.when(first & second, F.lit(0)).when(first, F.greatest(F.lit(0), n - 1)).otherwise(n).cast("string")),
            (kind == "revived_character_attachment", "SEPARATE_UNIT"),
        ],
        "UNKNOWN",
    )


def roster_limits(units: DataFrame, key: str, caps: DataFrame) -> DataFrame:
    """Copies of each unit in a roster against its kind's cap (kind, cap); battleline units may come twice as often."""
    n = units.groupBy(key, "unit", "kind").agg(F.count("*").alias("copies"))
    cap = F.when(F.col("kind") == "BATTLELINE", F.col("cap") * 2).otherwise(F.col("cap"))
    return n.join(caps, "kind", "left").select(key, "unit", "copies", cap.alias("cap"), case([(F.col("cap").isNull(), "UNKNOWN"), (F.col("copies") <= cap, "PASS")], "FAIL").alias("status"))


#: Rules that a composition takes at most.
MOST_RULES = 10_000


def composition(units: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """Composition rules (rule, kind, keyword, cap) against rosters' units (keywords array): caps count units with a keyword, a forbidding rule allows none.

    Every roster meets every rule, a rule without units too: rules are a list of at most MOST_RULES (more are refused), which stands in the plan.
    """
    listed = rules.select("rule", "kind", "keyword", "cap").limit(MOST_RULES + 1).collect()
    if len(listed) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    constant = F.from_json(F.lit(json.dumps([r.asDict() for r in listed])), "array<struct<rule:string,kind:string,keyword:string,cap:int>>")
    words = units.select(key, F.explode(F.array_distinct("keywords")).alias("keyword")).groupBy(key, "keyword").agg(F.count("*").alias("n"))
    every = units.select(key).distinct().select(key, F.inline(constant))
    n = every.join(words, [key, "keyword"], "left").groupBy(key, "rule", "kind", "cap").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("units"))
    status = case(
        [
            ((F.col("kind") == "boolean_forbid") & (F.col("units") == 0), "PASS"),
            (F.col("kind") == "boolean_forbid", "FAIL"),
            (F.col("kind").isin("ally_unit_name_cap", "keyword_grant_selection", "marks_of_chaos"), "UNKNOWN"),  # kinds of `faction_rules`
            (F.col("units") <= F.col("cap"), "PASS"),
        ],
        "FAIL",
    )
    return n.select(key, "rule", "units", status.alias("status"))


def transport(passengers: DataFrame, profiles: DataFrame, key: str) -> DataFrame:
    """Space that passengers (transport, keywords, models) take and whether a transport may hold them.

    A profile has capacity, requires_all, excludes, multipliers (keyword to space) and, where a passenger needs one keyword of
    each of several groups, requires_any_groups. Unknown keywords never fit.
    """
    if "requires_any_groups" not in profiles.columns:
        profiles = profiles.withColumn("requires_any_groups", F.lit(None).cast("array<array<string>>"))
    joined = passengers.join(profiles, key)
    space = F.coalesce(F.array_max(F.transform(F.map_entries("multipliers"), lambda e: F.when(F.array_contains(F.col("keywords"), e["key"]), e["value"]))), F.lit(1))
    fits = (F.size(F.array_except("requires_all", "keywords")) == 0) & ~F.arrays_overlap("excludes", "keywords")
    fits = yes(fits & F.coalesce(F.forall("requires_any_groups", lambda g: F.arrays_overlap(g, F.col("keywords"))), F.col("requires_any_groups").isNull()))
    by = joined.groupBy(key).agg(F.sum(F.col("models") * space).alias("used"), F.max("capacity").alias("capacity"), F.bool_and(fits).alias("allowed"))
    return by.withColumn("status", F.when(F.col("allowed") & (F.col("used") <= F.col("capacity")), "PASS").otherwise("FAIL"))


# --- rosters against the core limits and the rules of their faction ---------------------------------------------------


def core_limits(rosters: DataFrame, units: DataFrame, enhancements: DataFrame, sizes: DataFrame) -> DataFrame:
    """(roster_id, check, subject, value, cap, status) of the core limits; a limit or a value that isn't known is UNKNOWN.

    rosters: roster_id, battle_size, detachments (array of name, cost); units: roster_id, id, unit, keywords, points, role (LEADER, SUPPORT or
    null), attached_to (id of its bodyguard); enhancements: roster_id, unit_ref, enhancement, upgrade, points; sizes: battle_size,
    points_limit, detachment_points_limit, enhancement_limit, unit_limit, lone_detachment (what a roster's only detachment may cost at most).
    """
    base = rosters.join(sizes, "battle_size", "left")
    has = lambda k: yes(F.array_contains("keywords", k))
    enhancements = enhancements.withColumn("upgrade", yes(F.col("upgrade")))

    def check(df: DataFrame, name: str, subject: Column, value: Column, cap: Column) -> DataFrame:
        value, cap = value.cast("long"), cap.cast("long")
        status = case([(value.isNull() | cap.isNull(), "UNKNOWN"), (value <= cap, "PASS")], "FAIL")
        return df.select("roster_id", F.lit(name).alias("check"), subject.cast("string").alias("subject"), value.alias("value"), cap.alias("cap"), status.alias("status"))

    whole = F.lit(None)
    paid = units.select("roster_id", "points").unionAll(enhancements.select("roster_id", "points"))
    paid = paid.groupBy("roster_id").agg(F.when(F.count_if(F.col("points").isNull()) == 0, F.sum("points")).alias("used"), F.lit(1).alias("any"))
    points = base.join(paid, "roster_id", "left").withColumn("used", F.when(F.col("any").isNull(), F.lit(0)).otherwise(F.col("used")))
    cost = F.aggregate(F.coalesce("detachments.cost", F.array().cast("array<int>")), F.lit(0), lambda a, x: a + x)
    lone = F.when((F.size("detachments") == 1) & yes(F.col("lone_detachment") > F.col("detachment_points_limit")), F.col("lone_detachment")).otherwise(F.col("detachment_points_limit"))
    names = rosters.select("roster_id", F.explode("detachments.name").alias("name")).groupBy("roster_id", "name").count()
    copies = units.withColumn("kind", case([(has("EPIC HERO"), "EPIC"), (has("BATTLELINE") | has("DEDICATED TRANSPORT"), "DOUBLE")], "ONCE"))
    copies = copies.groupBy("roster_id", "unit").agg(F.count("*").alias("n"), F.max(F.col("kind") == "EPIC").alias("epic"), F.max(F.col("kind") == "DOUBLE").alias("double"))
    copies = copies.join(base.select("roster_id", "unit_limit"), "roster_id")
    per_unit = F.when(F.col("epic"), F.lit(1)).when(F.col("double"), F.col("unit_limit") * 2).otherwise(F.col("unit_limit"))
    same = enhancements.groupBy("roster_id", "enhancement").agg(F.count("*").alias("n"), F.bool_and("upgrade").alias("upgrade"))
    counted = same.groupBy("roster_id").agg(F.sum(F.when(F.col("upgrade"), F.lit(1)).otherwise(F.col("n"))).alias("used"))  # second and third copies of an upgrade are free
    counted = base.join(counted, "roster_id", "left")
    bearers = enhancements.join(units.select("roster_id", F.col("id").alias("unit_ref"), "keywords"), ["roster_id", "unit_ref"], "left")
    bearers = bearers.groupBy("roster_id", "unit_ref").agg(F.count("*").alias("n"), F.max(has("CHARACTER") & ~has("EPIC HERO")).alias("may"))
    # equality of ids is within a roster; a null reference is no attachment
    guards = units.select("roster_id", F.col("id").alias("attached_to"), F.lit(True).alias("found")).distinct()
    joined = units.filter("attached_to IS NOT NULL").join(guards, ["roster_id", "attached_to"], "left")
    leads = joined.groupBy("roster_id", "attached_to", "role").agg(F.count("*").alias("n"), F.max(yes(F.col("found")) & F.col("role").isin("LEADER", "SUPPORT")).alias("may"))
    loose = units.filter((F.col("role") == "SUPPORT") & F.col("attached_to").isNull())
    checks = [
        check(points, "points", whole, F.col("used"), F.col("points_limit")),
        check(base, "detachment_points", whole, cost, lone),
        check(names, "same_detachment", F.col("name"), F.col("count"), F.lit(1)),
        check(copies, "unit_copies", F.col("unit"), F.col("n"), per_unit),
        check(counted, "enhancements", whole, F.coalesce("used", F.lit(0)), F.col("enhancement_limit")),
        check(same, "enhancement_copies", F.col("enhancement"), F.col("n"), F.when(F.col("upgrade"), F.lit(3)).otherwise(F.lit(1))),
        check(bearers, "enhancement_bearer", F.col("unit_ref"), F.col("n"), F.when(yes(F.col("may")), F.lit(1)).otherwise(F.lit(0))),
        check(leads, "attachment", F.col("attached_to"), F.col("n"), F.when(yes(F.col("may")), F.lit(1)).otherwise(F.lit(0))),
        check(loose, "support_attached", F.col("id"), F.lit(1), F.lit(0)),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionAll(c)
    return out


#: Columns of the rules' file that `faction_rules` reads.
RULES = (
    "id string, army_faction string, detachment_required string, kind string, required_all array<string>, excluded array<string>, point_caps map<string,int>, point_cap int, "
    "allied_warlord_forbidden boolean, allowed_source_faction string, allowed_units array<string>, roster_flag string, forbidden_value boolean, selection_field string, max_selected int, "
    "grant array<string>, warlord_allowed boolean, allowed_marks array<string>, non_epic_heretic_astartes_requires_mark boolean, khorne_forbidden_for_psyker boolean, "
    "attached_units_must_share_mark boolean, transport_and_passengers_must_share_mark boolean"
)


def applied_rules(rosters: DataFrame, rules: DataFrame) -> DataFrame:
    """The rules (RULES) of each roster's faction and detachments."""
    asked = F.col("detachment_required").isNull() | yes(F.array_contains("detachments", F.col("detachment_required")))
    return rosters.join(rules.withColumnRenamed("id", "rule"), "army_faction").filter(asked)


def _selected(applied: DataFrame) -> DataFrame:
    return applied.filter("kind = 'keyword_grant_selection'").withColumn("chosen", F.array_distinct(F.coalesce(F.col("selections")[F.col("selection_field")], F.array().cast("array<string>"))))


def granted(rosters: DataFrame, units: DataFrame, rules: DataFrame) -> DataFrame:
    """Units with the keywords that a selection grants them, where they qualify."""
    chosen = _selected(applied_rules(rosters, rules)).select("roster_id", F.explode("chosen").alias("id"), "required_all", "grant")
    fit = chosen.join(units.select("roster_id", "id", "keywords"), ["roster_id", "id"]).filter(F.size(F.array_except("required_all", "keywords")) == 0)
    more = fit.groupBy("roster_id", "id").agg(F.flatten(F.collect_list("grant")).alias("_more"))
    both = units.join(more, ["roster_id", "id"], "left")
    return both.withColumn("keywords", F.when(F.col("_more").isNull(), F.col("keywords")).otherwise(F.array_union("keywords", "_more"))).select(units.columns)


def faction_rules(rosters: DataFrame, units: DataFrame, rules: DataFrame) -> DataFrame:
    """(roster_id, rule, kind, status, reasons) for every rule (RULES) that applies to a roster; what can't be decided is UNKNOWN.

    rosters: roster_id, army_faction, battle_size, detachments (array of names), flags (map to boolean), selections (map to arrays of unit ids);
    units: roster_id, id, unit, faction, keywords, points, warlord, mark, attached_to and transported_in (ids of units).
    """
    applied = applied_rules(rosters, rules)
    none = F.array().cast("array<string>")
    words = F.coalesce("keywords", none)
    ally = applied.join(units, "roster_id")
    needed = F.size(F.array_except("required_all", words)) == 0
    out = F.arrays_overlap(F.coalesce("excluded", none), words)
    foreign = ~F.col("faction").eqNullSafe(F.col("army_faction"))
    by_word = ally.filter((F.col("kind") == "ally_keyword_cap") & needed & (~out | foreign))
    by_word = by_word.select("*", out.alias("barred"), F.col("point_caps")[F.col("battle_size")].alias("most"))
    by_name = ally.filter((F.col("kind") == "ally_unit_name_cap") & (F.col("faction") == F.col("allowed_source_faction")))
    by_name = by_name.select("*", (~yes(F.array_contains("allowed_units", F.col("unit")))).alias("barred"), F.col("point_cap").alias("most"))
    caps = by_word.unionByName(by_name).groupBy("roster_id", "rule").agg(
        F.sum("points").alias("used"),
        F.count_if(F.col("points").isNull()).alias("unpriced"),
        F.max("most").alias("most"),
        F.max("barred").alias("barred"),
        F.max(yes(F.col("allied_warlord_forbidden")) & yes(F.col("warlord"))).alias("led"),
    )
    reason = lambda test, name: F.when(test, F.lit(name))  # noqa: E731  unknown ones end in "?"
    found = [caps.select("roster_id", "rule", F.array(reason(F.col("used") > F.col("most"), "OVER_CAP"), reason(F.col("barred"), "UNIT_NOT_ALLOWED"), reason(F.col("led"), "ALLIED_WARLORD"), reason(F.col("most").isNull(), "CAP?"), reason(F.col("unpriced") > 0, "POINTS?")).alias("r"))]

    flag = F.col("flags")[F.col("roster_flag")]
    found.append(applied.filter("kind = 'boolean_forbid'").select("roster_id", "rule", F.array(reason(flag == F.col("forbidden_value"), "FORBIDDEN"), reason(flag.isNull(), "FLAG?")).alias("r")))

    chosen = _selected(applied)
    found.append(chosen.select("roster_id", "rule", F.array(reason(F.size("chosen") > F.col("max_selected"), "TOO_MANY"), reason(F.col("max_selected").isNull(), "MAX?")).alias("r")))
    picked = chosen.select("roster_id", "rule", "required_all", "warlord_allowed", F.explode("chosen").alias("id")).join(units.withColumn("found", F.lit(True)), ["roster_id", "id"], "left")
    found.append(picked.select("roster_id", "rule", F.array(reason(F.col("found").isNull(), "UNKNOWN_REF"), reason(F.col("found") & ~needed, "NOT_ELIGIBLE"), reason(yes(F.col("warlord")) & ~F.coalesce("warlord_allowed", F.lit(True)), "WARLORD")).alias("r")))

    # a unit's mark is the chosen one, else the one among its keywords
    marked = ally.filter("kind = 'marks_of_chaos'").withColumn("own", F.coalesce("mark", F.get(F.array_intersect("allowed_marks", words), F.lit(0))))
    has = lambda k: F.array_contains(words, k)
    found.append(
        marked.select(
            "roster_id",
            "rule",
            F.array(
                reason(~F.array_contains("allowed_marks", F.col("mark")), "MARK_NOT_ALLOWED"),
                reason(yes(F.col("non_epic_heretic_astartes_requires_mark")) & has("HERETIC ASTARTES") & ~has("EPIC HERO") & F.col("own").isNull(), "NO_MARK"),
                reason(yes(F.col("khorne_forbidden_for_psyker")) & has("PSYKER") & (F.col("own") == "KHORNE"), "KHORNE_PSYKER"),
            ).alias("r"),
        )
    )
    for ref, asked, name in (("attached_to", "attached_units_must_share_mark", "ATTACHED_MARK"), ("transported_in", "transport_and_passengers_must_share_mark", "TRANSPORT_MARK")):
        other = marked.select("roster_id", "rule", F.col("id").alias(ref), F.col("own").alias("theirs"), F.lit(True).alias("found"))
        pairs = marked.filter(yes(F.col(asked)) & F.col(ref).isNotNull()).join(other, ["roster_id", "rule", ref], "left")
        found.append(pairs.select("roster_id", "rule", F.array(reason(F.col("found").isNull(), "UNKNOWN_REF"), reason(F.col("found") & ~F.col("own").eqNullSafe(F.col("theirs")), name)).alias("r")))

    rows = found[0]
    for x in found[1:]:
        rows = rows.unionAll(x)
    by = rows.groupBy("roster_id", "rule").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list(F.array_compact("r"))))).alias("reasons"))
    known = F.col("kind").isin("ally_keyword_cap", "ally_unit_name_cap", "boolean_forbid", "keyword_grant_selection", "marks_of_chaos")
    all_ = applied.select("roster_id", "rule", "kind").join(by, ["roster_id", "rule"], "left").withColumn("reasons", F.when(yes(known), F.coalesce("reasons", none)).otherwise(F.array(F.lit("KIND?"))))
    status = case([(F.exists("reasons", lambda x: ~x.endswith("?")), "FAIL"), (F.size("reasons") > 0, "UNKNOWN")], "PASS")
    return all_.select("roster_id", "rule", "kind", status.alias("status"), "reasons")


# --- currentness ---------------------------------------------------------------------------------------------------


def closure(names: DataFrame, edges: DataFrame) -> DataFrame:
    """(profile, needs) for every profile (name) and what it needs directly or through others by edges (parent, child), itself included.

    Pairs are joined with themselves until none is new: the rounds follow the logarithm of the longest way, cycles end, and many ways
    between two profiles are one pair.
    """
    reach = names.select(F.col("name").alias("profile"), F.col("name").alias("needs"))
    reach = cut(reach.union(reach.join(edges, F.col("needs") == F.col("parent")).select("profile", "child")).distinct())
    known = reach.count()
    while True:
        further = reach.select(F.col("profile").alias("needs"), F.col("needs").alias("further"))
        reach = cut(reach.union(reach.join(further, "needs").select("profile", "further")).distinct())
        if (now := reach.count()) == known:
            return reach
        known = now


def currentness(reach: DataFrame, profiles: DataFrame, sources: DataFrame) -> DataFrame:
    """PASS or PENDING for each profile: its own content and that of all it needs, and all their sources must pass.

    reach: profile, needs; profiles: name, content_state; sources: name, source, state.
    """
    content = reach.join(profiles, reach["needs"] == profiles["name"], "left").select("profile", F.when(F.coalesce("content_state", F.lit("")) != "PASS", F.concat("needs", F.lit(".content_state="), F.coalesce("content_state", F.lit("None")))).alias("reason"))
    source = reach.join(sources, reach["needs"] == sources["name"]).select("profile", F.when(F.coalesce("state", F.lit("MISSING")) != "PASS", F.concat("source", F.lit("="), F.coalesce("state", F.lit("MISSING")))).alias("reason"))
    by = content.union(source).groupBy("profile").agg(F.sort_array(F.collect_set("reason")).alias("reasons"))
    return by.select("profile", F.when(F.size("reasons") == 0, "PASS").otherwise("PENDING").alias("result"), F.array_join("reasons", "; ").alias("reasons"))


def coverage_gate(result: Column, coverage: Column, required: bool) -> Column:
    return F.when((result == "PASS") & (F.lit(not required) | (F.coalesce(coverage, F.lit(0)) >= 100)), "PASS").otherwise("PENDING")


#: Report states that may be synced.
SYNCABLE = ("PASS", "PASS_WITH_KNOWN_RUNTIME_DRIFT")


def runtime_sync(report: DataFrame) -> DataFrame:
    """What a runtime report (one row) adds to the release state; reading fails on another schema, an unresolved state or new drift.

    report: schema_version, status, resolved, and points and surfaces as structs of checks, matched, known_drift_count, new_drift_count (null: 0) and
    known_drifts (array of structs with known_drift_id; null and empty ids are left out).
    """
    count = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0))
    new = count("points.new_drift_count") + count("surfaces.new_drift_count")
    anew = (count("points.new_drift_count") != 0) | (count("surfaces.new_drift_count") != 0)
    refuse = lambda why: F.raise_error(why).cast("boolean")
    fine = (
        F.when(~F.col("schema_version").eqNullSafe("2.0"), refuse(F.lit("the report's schema must be 2.0")))
        .when(~F.coalesce(F.col("status").isin(*SYNCABLE), F.lit(False)), refuse(F.concat(F.lit("unresolved state: "), F.coalesce("status", F.lit("none")))))
        .when(anew, refuse(F.lit("unclassified drift"))).otherwise(True)
    )
    none = F.array().cast("array<string>")
    ids = F.concat(*[F.coalesce(F.col(f"{side}.known_drifts.known_drift_id"), none) for side in ("points", "surfaces")])
    return report.filter(fine).select(
        F.col("status").alias("state"), F.col("resolved").alias("roster_identities_resolved"),
        F.col("points.checks").alias("representative_point_checks"), F.col("points.matched").alias("representative_point_matches"), F.col("points.known_drift_count").alias("known_point_drifts"),
        F.col("surfaces.checks").alias("representative_surface_checks"), F.col("surfaces.matched").alias("representative_surface_matches"), F.col("surfaces.known_drift_count").alias("known_surface_drifts"),
        (count("points.known_drift_count") + count("surfaces.known_drift_count")).alias("known_runtime_drifts"), new.alias("new_runtime_drifts"),
        F.filter(ids, lambda x: x.isNotNull() & (x != "")).alias("active_known_drift_ids"),
    )
