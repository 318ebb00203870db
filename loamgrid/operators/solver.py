"""Physical feasibility of rosters against finite pools, and scoped legality of requests, for many rosters at once."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from .flow import Network
from .gates import feasibility, overall_status
from .pricing import parse_bands, price
from .relational import only_one

BUILD_COST, CONVERSION_COST = 10, 100
ALLOCATION = "roster_id string, pool_id string, unit string, readiness string, mode string, bodies long"


def allocate(demand: dict[str, int], pools: Iterable[tuple[str, str, str, int, int, int, int]], conversion: bool) -> list[tuple[str, str, str, str, int]]:
    """Cheapest allocation of pool bodies to demanded units.

    A pool row is (pool, unit, mode, most from the pool, ready, buildable, bodies). Ready bodies are free, built ones cost, converted ones cost more.
    Returns (pool, unit, readiness, mode, bodies) with bodies above 0.
    """
    net, uses, drawn = Network(), {}, set()
    for pool, unit, mode, most, ready, buildable, bodies in pools:
        if unit not in demand or mode == "CONVERSION_REQUIRED" and not conversion:
            continue
        net.edge(("role", pool, unit), ("unit", unit), most)
        for readiness, amount, cost in (("READY", ready, 0), ("BUILD_REQUIRED", buildable, BUILD_COST)):
            if amount:
                if (pool, readiness) not in drawn:
                    drawn.add((pool, readiness))
                    net.edge("all", ("part", pool, readiness), amount, cost)
                uses[pool, unit, readiness, mode] = net.edge(("part", pool, readiness), ("role", pool, unit), bodies, CONVERSION_COST if mode == "CONVERSION_REQUIRED" else 0)
    for unit, n in demand.items():
        net.edge(("unit", unit), "roster", n)
    net.solve("all", "roster")
    return [(*k, net.flow(e)) for k, e in uses.items() if net.flow(e)]


def allocations(demand: DataFrame, pools: DataFrame, conversion: DataFrame | None = None) -> DataFrame:
    """ALLOCATION rows for every roster's demand (roster_id, unit, models) from the pools (pool_id, unit, mode, max_from_pool, ready, buildable, bodies).

    One small network for each distinct demand: rosters that ask for the same meet its solution by a hash of what they ask for. Demand meets its pools by unit
    before it is grouped, so a group holds one roster's units only.
    """
    ship(demand.sparkSession)
    need = demand.groupBy("roster_id", "unit").agg(F.sum("models").cast("long").alias("models"))
    rows = need.join(pools, "unit")
    rows = rows.join(conversion, "roster_id", "left").withColumn("allow", F.coalesce("allow_conversion", F.lit(False))) if conversion is not None else rows.withColumn("allow", F.lit(True))

    item = F.struct("pool_id", "unit", "mode", "max_from_pool", "ready", "buildable", "bodies", "models")
    asked = rows.groupBy("roster_id").agg(F.bool_and("allow").alias("allow"), F.sort_array(F.collect_list(item)).alias("rows"))
    asked = asked.withColumn("network", F.sha2(F.to_json(F.struct("allow", "rows"), {"ignoreNullFields": "false"}), 256))
    networks = asked.groupBy("network").agg(F.first("allow").alias("allow"), F.first("rows").alias("rows"))
    solved = "network string, " + ALLOCATION.split(", ", 1)[1]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in solved.split(", ")]
        for batch in batches:
            made = []
            for network, allow, own in zip(*[batch.column(c).to_pylist() for c in ("network", "allow", "rows")], strict=True):
                wanted = {r["unit"]: r["models"] for r in own}
                pools_ = [tuple(r[c] for c in ("pool_id", "unit", "mode", "max_from_pool", "ready", "buildable", "bodies")) for r in own]
                made += [(network, *m) for m in allocate({u: wanted[u] for u in sorted(wanted)}, pools_, allow)]
            if made:
                kinds = [pa.string()] * 5 + [pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)], names)

    return asked.select("roster_id", "network").join(networks.mapInArrow(solve, solved), "network").drop("network")


def body_deficits(demand: DataFrame, made: DataFrame, pools: DataFrame) -> DataFrame:
    """Each demanded unit: required and allocated bodies, the deficit, and whether any pool knows it."""
    need = demand.groupBy("roster_id", "unit").agg(F.sum("models").alias("required"))
    got = made.groupBy("roster_id", "unit").agg(F.sum("bodies").alias("allocated"))
    known = pools.select("unit").distinct().withColumn("modeled", F.lit(True))
    full = need.join(got, ["roster_id", "unit"], "left").join(known, "unit", "left")
    allocated = F.coalesce("allocated", F.lit(0))
    return full.select("roster_id", "unit", "required", allocated.alias("allocated"), (F.col("required") - allocated).alias("deficit"), F.coalesce("modeled", F.lit(False)).alias("modeled"))


def component_checks(demand: DataFrame, capacity: DataFrame) -> DataFrame:
    """Components (roster_id, component_id, count) against capacities."""
    need = demand.groupBy("roster_id", "component_id").agg(F.sum("count").alias("required"))
    status = F.when(F.col("capacity").isNull(), "UNKNOWN_COMPONENT").when(F.col("required") <= F.col("capacity"), "PASS").otherwise("FAIL")
    return need.join(capacity, "component_id", "left").select("roster_id", "component_id", "required", "capacity", status.alias("status"))


def unknown_triggers(components: DataFrame, wargear: DataFrame, constraints: DataFrame, support: DataFrame) -> DataFrame:
    """Unknown constraints that a roster's components or paid wargear set off.

    Constraints and support are rules, of a size that doesn't follow the rosters; they go to the rows, which have few different components and items.
    """
    named = F.broadcast(constraints.filter("component_id is not null").select("constraint_id", "component_id").distinct())
    by_component = components.join(named, "component_id").select("roster_id", "constraint_id")
    unknown = F.broadcast(support.filter(F.startswith(F.col("status"), F.lit("UNKNOWN"))).select("unit", "item", "constraint_id").distinct())
    return by_component.union(wargear.join(unknown, ["unit", "item"]).select("roster_id", "constraint_id")).distinct()


def physical_state(rosters: DataFrame, deficits: DataFrame, components: DataFrame, unknown: DataFrame, made: DataFrame) -> DataFrame:
    """Each roster's feasibility and how many bodies must be built and converted."""
    short = deficits.groupBy("roster_id").agg(F.bool_or((F.col("deficit") > 0) | ~F.col("modeled")).alias("short"))
    parts = components.groupBy("roster_id").agg(F.bool_or(F.col("status") == "FAIL").alias("parts_short"), F.bool_or(F.col("status") == "UNKNOWN_COMPONENT").alias("parts_unknown"))
    open_ = unknown.groupBy("roster_id").agg(F.lit(True).alias("open"))
    work = made.groupBy("roster_id").agg(
        F.coalesce(F.sum(F.when(F.col("readiness") == "BUILD_REQUIRED", F.col("bodies"))), F.lit(0)).alias("build"),
        F.coalesce(F.sum(F.when(F.col("mode") == "CONVERSION_REQUIRED", F.col("bodies"))), F.lit(0)).alias("conversion"),
    )
    out = rosters.select("roster_id").distinct()
    for part in (short, parts, open_, work):
        out = out.join(part, "roster_id", "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("short", "parts_short", "parts_unknown", "open")} | {c: F.coalesce(c, F.lit(0)) for c in ("build", "conversion")})
    state = feasibility(F.col("short") | F.col("parts_short"), F.col("parts_unknown") | F.col("open"), F.col("build"), F.col("conversion"))
    return out.select("roster_id", "build", "conversion", state.alias("physical_state"))


def scoped_checks(units: DataFrame, catalog: DataFrame, bands: DataFrame) -> DataFrame:
    """Requested units (roster_id, row_id, id, unit, models; names normalised) with uniqueness, resolution, copy number, points and status.

    Copies are numbered among resolved units with a unique id, in request order; a unit without a price fails but keeps its place. Blank ids fail.
    """
    first = F.row_number().over(Window.partitionBy("roster_id", "id").orderBy("row_id")) == 1
    marked = units.withColumn("id_status", F.when(first & F.col("id").isNotNull() & (F.col("id") != ""), "PASS").otherwise("FAIL"))
    known = only_one(catalog.select("unit", F.lit(True).alias("known")), "unit")
    found = marked.join(F.broadcast(known), "unit", "left")
    usable = (F.col("id_status") == "PASS") & F.col("known")
    numbered = found.filter(usable).withColumn("copy_no", F.row_number().over(Window.partitionBy("roster_id", "unit").orderBy("row_id")))
    priced = price(numbered, parse_bands(bands), "unit", "models")
    rest = found.filter(~F.coalesce(usable, F.lit(False))).withColumns({"copy_no": F.lit(None).cast("int"), "points": F.lit(None).cast("int")})
    every = priced.select(*rest.columns).union(rest)
    check = F.when(F.col("id_status") == "FAIL", "unique_unit_id").when(F.col("known").isNull(), "unit_exists").otherwise("unit_size_and_copy_tier")
    return every.select("roster_id", "row_id", "id", "unit", "models", "copy_no", "points", check.alias("check"), F.when((check == "unit_size_and_copy_tier") & F.col("points").isNotNull(), "PASS").otherwise("FAIL").alias("status"))


def wargear_costs(items: DataFrame, catalog: DataFrame) -> DataFrame:
    """Paid items (unit, item, quantity) with points each and in total; an item without a price fails."""
    out = items.join(F.broadcast(catalog.select("unit", "item", F.col("points").alias("points_each"))), ["unit", "item"], "left")
    return out.withColumns({"points": F.col("points_each") * F.col("quantity"), "status": F.when(F.col("points_each").isNull(), "FAIL").otherwise("PASS")})


def attachments(pairs: DataFrame, units: DataFrame, leads: DataFrame) -> DataFrame:
    """Leader and bodyguard references (roster_id, leader_ref, bodyguard_ref) against leader relations (leader, bodyguard)."""
    known = units.select("roster_id", "id", "unit")
    a = known.select("roster_id", F.col("id").alias("leader_ref"), F.col("unit").alias("leader"))
    b = known.select("roster_id", F.col("id").alias("bodyguard_ref"), F.col("unit").alias("bodyguard"))
    named = pairs.join(a, ["roster_id", "leader_ref"], "left").join(b, ["roster_id", "bodyguard_ref"], "left")
    allowed = leads.select("leader", "bodyguard").distinct().withColumn("_ok", F.lit(True))
    reason = F.when(F.col("leader").isNull() | F.col("bodyguard").isNull(), "UNKNOWN_REF").when(F.col("_ok").isNull(), "NOT_ALLOWED")
    out = named.join(F.broadcast(allowed), ["leader", "bodyguard"], "left")
    return out.select("roster_id", "leader_ref", "bodyguard_ref", "leader", "bodyguard", F.when(reason.isNull(), "PASS").otherwise("FAIL").alias("status"), reason.alias("reason"))


def scoped_rows(requests: dict[str, DataFrame], rules: dict[str, DataFrame]) -> DataFrame:
    """Every scoped check of every roster but the points limit: (roster_id, check, subject, points, status).

    `requests` has rosters (roster_id, detachment, points_limit), units (as in scoped_checks), wargear (roster_id, row_id of its unit, item, quantity),
    enhancements (roster_id, name) and attachments (roster_id, leader_ref, bodyguard_ref). `rules` has units, bands, detachments (detachment),
    wargear (unit, item, points), enhancements (detachment, name, points) and leads (leader, bodyguard). Names are normalised; a price is the largest
    where its key repeats. A detachment that isn't named once is none, and no enhancement is in it. Wargear of a unit that isn't resolved is not
    looked at; that of a unit without a price is checked, but adds no points. A quantity that isn't given is one. Rules are of a size that doesn't follow the
    rosters and go to the rows, which have few different units, items and detachments.
    """
    units = scoped_checks(requests["units"], rules["units"], rules["bands"])
    resolved = units.filter(F.col("check") == "unit_size_and_copy_tier").select("roster_id", "row_id", "id", "unit", F.col("points").alias("base"))
    detachments = only_one(rules["detachments"].select("detachment", F.lit(True).alias("known")), "detachment")
    rosters = requests["rosters"].select("roster_id", "detachment").join(F.broadcast(detachments), "detachment", "left")

    paid = requests["wargear"].select("roster_id", "row_id", "item", F.coalesce("quantity", F.lit(1)).alias("quantity")).join(resolved, ["roster_id", "row_id"])
    paid = wargear_costs(paid, rules["wargear"].groupBy("unit", "item").agg(F.max("points").alias("points")))
    offered = rules["enhancements"].groupBy("detachment", "name").agg(F.max("points").alias("points"))
    chosen = requests["enhancements"].select("roster_id", "name").join(rosters.filter("known").select("roster_id", "detachment"), "roster_id", "left").join(F.broadcast(offered), ["detachment", "name"], "left")
    leaders = attachments(requests["attachments"], resolved, rules["leads"])

    def rows(df: DataFrame, check: Column, subject: Column, points: Column, status: Column) -> DataFrame:
        return df.select("roster_id", check.alias("check"), subject.cast("string").alias("subject"), points.cast("long").alias("points"), status.alias("status"))

    passed = lambda ok: F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise("FAIL")
    none = F.lit(None)
    out = rows(rosters, F.lit("detachment_exists"), F.col("detachment"), none, passed(F.col("known")))
    out = out.union(rows(units, F.col("check"), F.col("id"), F.col("points"), F.col("status")))
    out = out.union(rows(paid, F.lit("paid_wargear_cost"), F.col("item"), F.when(F.col("base").isNotNull(), F.col("points")), F.col("status")))
    out = out.union(rows(chosen, F.lit("enhancement_exists_in_detachment"), F.col("name"), F.col("points"), passed(F.col("points").isNotNull())))
    return out.union(rows(leaders, F.lit("leader_relation"), F.concat_ws("|", "leader_ref", "bodyguard_ref"), none, F.col("status")))


def evaluate(requests: dict[str, DataFrame], rules: dict[str, DataFrame], physical: DataFrame) -> DataFrame:
    """One row for each requested roster: its points, the number of failed checks (the points limit among them, where there is one), legality and status.

    `requests` and `rules` are those of scoped_rows; `physical` (roster_id, physical_state) has every roster. A roster id that is requested twice is an error of
    the caller's: it gives two rows.
    """
    sums = lambda name, own: F.coalesce(F.sum(F.when(own, F.col("points"))), F.lit(0)).alias(name)
    bonus = F.col("check") == "enhancement_exists_in_detachment"
    totals = scoped_rows(requests, rules).groupBy("roster_id").agg(F.count_if(F.col("status") == "FAIL").alias("failed"), sums("unit_points", ~bonus), sums("enhancement_points", bonus))
    out = requests["rosters"].select("roster_id", F.col("points_limit").cast("long").alias("points_limit")).join(totals, "roster_id", "left").join(physical.select("roster_id", "physical_state"), "roster_id", "left")
    total = F.col("unit_points") + F.col("enhancement_points")
    out = out.withColumn("points", total).withColumn("failed", F.col("failed") + F.coalesce(F.col("points") > F.col("points_limit"), F.lit(False)).cast("long"))
    legality = F.when(F.col("failed") > 0, "FAIL").otherwise("PASS")
    return out.select("roster_id", "unit_points", "enhancement_points", "points", "points_limit", "failed", legality.alias("scoped_legality"), "physical_state", overall_status(F.col("failed"), F.col("physical_state")).alias("status"))


def roster_status(checks: DataFrame, physical: DataFrame) -> DataFrame:
    """One status for each roster from its failed checks and its feasibility."""
    failed = checks.groupBy("roster_id").agg(F.count_if(F.col("status") == "FAIL").alias("failed"))
    both = physical.join(failed, "roster_id", "left").withColumn("failed", F.coalesce("failed", F.lit(0)))
    return both.select("roster_id", "failed", "physical_state", overall_status(F.col("failed"), F.col("physical_state")).alias("status"))
