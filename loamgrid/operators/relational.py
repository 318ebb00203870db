"""Relational operators: projections, predicates, lookups, reconciliation, diffs, ranges and rankings.

Keys are equality keys wherever the semantics have one, so big sides hash to the same partitions; only dimensions that stay under Spark's
broadcast threshold are broadcast, and Spark decides that by their size. Nothing here is collected.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.unicode import casefold

from ..functions.text import non_empty, text_hash


# --- projections ---------------------------------------------------------------------------------------------------


def prose_hashes(df: DataFrame, keep: Sequence[str], prose: Sequence[str]) -> DataFrame:
    """Kept columns with blanks as null; each prose column as its hash and whether it is there."""
    made = [non_empty(c).alias(c) if dict(df.dtypes)[c] == "string" else F.col(c) for c in keep]
    for c in prose:
        made += [text_hash(c).alias(f"{c}_sha256"), non_empty(c).isNotNull().alias(f"{c}_present")]
    return df.select(*made)


def nest(parent: DataFrame, key: str, children: dict[str, tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Parents with one array of structs for each child table (foreign key, columns), ordered by these columns; no child gives an empty array.

    Each child is aggregated before it is joined, so rows never multiply.
    """
    out = parent
    for name, (child, foreign, columns) in children.items():
        rows = child.filter(F.col(foreign).isNotNull()).groupBy(F.col(foreign).alias(key)).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name))
        out = out.join(rows, key, "left").withColumn(name, F.coalesce(name, F.array()))
    return out


def nested_counts(df: DataFrame, array: str, **conditions: Callable[[Column], Column]) -> DataFrame:
    """The size of a nested array and how many elements meet each condition."""
    return df.withColumns({f"{array}_count": F.size(array), **{n: F.size(F.filter(array, f)) for n, f in conditions.items()}})


def explode_tiers(units: DataFrame) -> DataFrame:
    """One row for each (unit, band, cost) of nested prices: the five-part key and points."""
    bands = units.select(F.col("name").alias("unit"), F.posexplode("pricing").alias("band_no", "band"))
    costs = bands.select("unit", "band_no", F.col("band.range").alias("range"), F.col("band.label").alias("label"), F.explode("band.costs").alias("cost"))
    return costs.select("unit", "band_no", "range", "label", F.col("cost.models").alias("models"), F.col("cost.desc").alias("desc"), F.col("cost.points").alias("points"))


def characteristics(pairs: str, name: str = "name", value: str = "value") -> Column:
    """A list of name/value structs as a map; entries without a name are left out, of equal names the last stays."""
    named = F.filter(pairs, lambda x: x[name].isNotNull())
    last = F.filter(named, lambda x, i: ~F.exists(F.slice(named, i + 2, F.greatest(F.size(named) - i - 1, F.lit(0))), lambda y: y[name] == x[name]))
    return F.map_from_entries(F.transform(last, lambda x: F.struct(x[name], x[value])))


def filled(df: DataFrame, *columns: str) -> DataFrame:
    """Only these columns, nulls as empty text, for comparisons."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns])


# --- predicates ----------------------------------------------------------------------------------------------------


def numeric_id(c: str) -> Column:
    return F.col(c).rlike(r"(?U)^\d+$")


def visible(mode: str, group: Column, wanted: str | None) -> Column:
    """Which units a view shows: ungrouped ones only, these and one group's, or all."""
    if mode == "base_only":
        return group.isNull() | (group == "")
    if mode == "base_plus_group":
        return group.isNull() | (group == "") | (group == F.lit(wanted))
    return F.lit(True)


def same_fold(c: str | Column, value: str) -> Column:
    """Equality whatever the case, by full case folding."""
    return casefold(c) == value.casefold()


def has_any(needle: str, *columns: str, arrays: Sequence[str] = ()) -> Column:
    """Whether any text column or array element contains the needle, whatever the case."""
    low = needle.lower()
    tests = [F.contains(F.lower(F.col(c)), F.lit(low)) for c in columns] + [F.exists(a, lambda x: F.contains(F.lower(x), F.lit(low))) for a in arrays]
    return reduce(lambda a, b: a | b, [F.coalesce(t, F.lit(False)) for t in tests])


def enough_evidence(text: str = "text", chars: int = 40, tokens: int = 6) -> Column:
    return (F.length(text) >= chars) & (F.size(F.split(text, " ")) >= tokens)


def trusted_host(url: str, *suffixes: str) -> Column:
    """An https address whose host is one of the suffixes or ends with a dot and one of them."""
    host = F.lower(F.regexp_extract(F.try_parse_url(F.col(url), F.lit("AUTHORITY")), r"^([^:@]+)", 1))
    ends = reduce(lambda a, b: a | b, [(host == s) | host.endswith(f".{s}") for s in suffixes])
    return F.coalesce((F.try_parse_url(F.col(url), F.lit("PROTOCOL")) == "https") & ends, F.lit(False))


def safe_key(c: str) -> Column:
    """A name that can be part of a path."""
    return F.col(c).rlike(r"^[A-Za-z0-9][A-Za-z0-9._-]*$") & ~F.contains(F.col(c), F.lit(".."))


def recent(day: str, as_of: Column, days: int = 21) -> Column:
    return (F.col(day) >= F.date_sub(as_of, days)) & (F.col(day) <= as_of)


def forbidden_fields(schema, names: set[str], path: str = "") -> list[str]:
    """Paths of a schema, at any depth, whose last name is forbidden."""
    from pyspark.sql import types as T

    found = []
    if isinstance(schema, T.StructType):
        for f in schema.fields:
            here = f"{path}.{f.name}".lstrip(".")
            found += ([here] if f.name in names else []) + forbidden_fields(f.dataType, names, here)
    elif isinstance(schema, T.ArrayType):
        found += forbidden_fields(schema.elementType, names, path + "[]")
    elif isinstance(schema, T.MapType):
        found += forbidden_fields(schema.valueType, names, path + "{}")
    return found


# --- lookups and reconciliation ------------------------------------------------------------------------------------


def only_one(df: DataFrame, *key: str) -> DataFrame:
    """Rows whose key occurs once."""
    return df.withColumn("_n", F.count("*").over(Window.partitionBy(*key))).filter("_n = 1").drop("_n")


def unique_match(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Pairs that share a key which is unique on both sides."""
    return only_one(left.filter(f"{key} is not null and {key} <> ''"), key).join(only_one(right.filter(f"{key} is not null"), key), key)


def resolve_unique(requests: DataFrame, catalog: DataFrame, key: str) -> DataFrame:
    """Requests with the catalogue row of their key if there is exactly one, else nulls."""
    return requests.join(only_one(catalog, key), key, "left")


def last_by_key(df: DataFrame, order: str | Column, *key: str) -> DataFrame:
    """The last row of each key: later duplicates overwrite earlier ones."""
    ranked = df.withColumn("_r", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(order) if isinstance(order, str) else order)))
    return ranked.filter("_r = 1").drop("_r")


def first_by_key(df: DataFrame, order: Sequence[str | Column], *key: str) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("_r = 1").drop("_r")


def mismatches(left: DataFrame, right: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Shared keys whose values differ as text, null-safely."""
    a, b = left.select(*key, F.col(value).alias("left_value")), right.select(*key, F.col(value).alias("right_value"))
    return a.join(b, list(key)).filter(~F.col("left_value").cast("string").eqNullSafe(F.col("right_value").cast("string")))


def added_removed(old: DataFrame, new: DataFrame, *key: str) -> DataFrame:
    """Keys in only one of two snapshots, with the change."""
    a, b = old.select(*key).distinct(), new.select(*key).distinct()
    return b.join(a, list(key), "left_anti").withColumn("change", F.lit("ADDED")).unionByName(a.join(b, list(key), "left_anti").withColumn("change", F.lit("REMOVED")))


def value_changes(old: DataFrame, new: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Keys (null parts match) in both snapshots whose number changed: old, new and delta."""
    a = old.select(*[F.col(k).alias(f"_a_{k}") for k in key], F.col(value).alias("old_value"))
    b = new.select(*key, F.col(value).alias("new_value"))
    on = reduce(lambda x, y: x & y, [F.col(f"_a_{k}").eqNullSafe(F.col(k)) for k in key])
    both = a.join(b, on).filter(F.col("old_value") != F.col("new_value"))
    return both.select(*key, "old_value", "new_value", (F.col("new_value") - F.col("old_value")).alias("delta"))


def catalog_drift(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Every key of both sides whose compared columns aren't all the same; a missing side counts as different."""
    a = left.select(key, F.struct(*columns).alias("_a"))
    b = right.select(key, F.struct(*columns).alias("_b"))
    kind = F.when(F.col("_a").isNull(), "ONLY_RIGHT").when(F.col("_b").isNull(), "ONLY_LEFT").otherwise("CHANGED")
    return a.join(b, key, "full_outer").filter(~F.col("_a").eqNullSafe(F.col("_b"))).select(key, kind.alias("drift"))


def alias_lookup(rows: DataFrame, catalog: DataFrame, aliases: DataFrame, key: str, value: str) -> DataFrame:
    """value by key, else by the key's alias (key, alias), with how it was found.

    Rows never multiply: of a key's catalogue rows the smallest value counts, of its aliases the smallest that the catalogue has.
    """
    known = catalog.groupBy(key).agg(F.min(value).alias("_direct"))
    other = aliases.select(key, "alias").join(known.select(F.col(key).alias("alias"), F.col("_direct").alias("_value")), "alias")
    by_alias = other.groupBy(key).agg(F.min_by("_value", "alias").alias("_by_alias"))
    joined = rows.join(known, key, "left").join(by_alias, key, "left")
    how = F.when(F.col("_direct").isNotNull(), "DIRECT").when(F.col("_by_alias").isNotNull(), "ALIAS").otherwise("UNRESOLVED")
    return joined.select(*rows.columns, F.coalesce("_direct", "_by_alias").alias(value), how.alias("resolution"))


def precedence_lookup(rows: DataFrame, catalog: DataFrame, steps: Sequence[tuple[str, str]], key: str) -> DataFrame:
    """The catalogue key that the first matching column of `rows` names; `steps` are (column, state) in precedence order."""
    out = rows
    for i, (column, _) in enumerate(steps):
        out = out.join(catalog.select(F.col(key).alias(f"_k{i}")).distinct(), F.col(column) == F.col(f"_k{i}"), "left")
    state = F.lit("NO_MAPPING")
    for i, (_, name) in reversed(list(enumerate(steps))):
        state = F.when(F.col(f"_k{i}").isNotNull(), name).otherwise(state)
    return out.select(*rows.columns, F.coalesce(*[F.col(f"_k{i}") for i in range(len(steps))]).alias("candidate"), state.alias("mapping_state"))


def either_key(rows: DataFrame, wanted: DataFrame, first: str, second: str) -> DataFrame:
    """Rows whose first key or whose second key is wanted. Two flagged equality joins, not one join on OR, which would meet all pairs."""
    a = wanted.select(F.col(first)).distinct().withColumn("_f", F.lit(True))
    b = wanted.select(F.col(second)).distinct().withColumn("_s", F.lit(True))
    return rows.join(a, first, "left").join(b, second, "left").filter("_f or _s").select(*rows.columns)


def best_candidate(pairs: DataFrame, key: str, score: Column, order: Sequence[str]) -> DataFrame:
    """For each key the candidate with the highest score; ties keep input order."""
    return pairs.withColumn("_s", score).withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("_s"), *order))).filter("_r = 1").drop("_r", "_s")


def edition_score(legends: Column, source: Column, edition: Column) -> Column:
    """How well a source fits a unit: legendary units want legends of old editions, others the current edition."""
    is_legends = F.contains(F.lower(source), F.lit("legends"))
    old = F.when(is_legends, 20).otherwise(0) + F.when(edition.isin("0", "10"), 5).otherwise(0)
    now = F.when(edition == "11", 20).otherwise(0) + F.when(is_legends, 0).otherwise(5)
    return F.when(legends, old).otherwise(now)


def inside_spans(points: DataFrame, spans: DataFrame, key: Sequence[str]) -> DataFrame:
    """Ranges (line_start, line_end, char_start, char_end) that lie inside any span of the same key."""
    p, s = points.alias("p"), spans.alias("s")
    on = reduce(lambda a, b: a & b, [F.col(f"p.{k}") == F.col(f"s.{k}") for k in key])
    on &= (F.col("p.line_start") >= F.col("s.line_start")) & (F.col("p.line_end") <= F.col("s.line_end"))
    on &= (F.col("p.char_start") >= F.col("s.char_start")) & (F.col("p.char_end") <= F.col("s.char_end"))
    return p.join(s, on, "left_semi")


def labels_to_lines(labels: DataFrame, lines: DataFrame, key: Sequence[str]) -> DataFrame:
    """Each label's line if exactly one line of its key equals it, else a gap."""
    hits = lines.groupBy(*key, F.col("clean").alias("label")).agg(F.count("*").alias("hits"), F.min("line").alias("line"))
    found = labels.join(hits, [*key, "label"], "left")
    return found.select(*labels.columns, F.when(F.col("hits") == 1, F.col("line")).alias("line"), F.when(F.col("hits") == 1, "RESOLVED").otherwise("HEADING_LINE_RECOVERY_GAP").alias("state"))


def same_identity(left: DataFrame, right: DataFrame, *key: str) -> DataFrame:
    """One row: whether both have the same set of keys, and how many each lacks."""
    a, b = left.select(*key).distinct(), right.select(*key).distinct()
    gone, extra = a.join(b, list(key), "left_anti"), b.join(a, list(key), "left_anti")
    both = gone.select(F.lit(1).alias("m"), F.lit(0).alias("e")).union(extra.select(F.lit(0), F.lit(1)))
    row = both.agg(F.coalesce(F.sum("m"), F.lit(0)).cast("long").alias("missing"), F.coalesce(F.sum("e"), F.lit(0)).cast("long").alias("extra"))
    return row.withColumn("same", (F.col("missing") == 0) & (F.col("extra") == 0))


def joined_if_same(first: DataFrame, others: dict[str, DataFrame], key: str, order: str) -> DataFrame:
    """Rows of `first` with a struct of each other table's columns; reading fails unless all have the same set of keys.

    Where another table repeats a key its last row in `order` counts. A null key meets nothing, so it fails too. Everything hashes to one partitioning.
    """
    out, same = first.withColumn("_in_first", F.lit(True)), F.col("_in_first")
    for name, df in others.items():
        last = last_by_key(df, order, key).select(key, F.struct(*[c for c in df.columns if c not in (key, order)]).alias(name))
        out, same = out.join(last, key, "full_outer"), same & F.col(name).isNotNull()
    fine = F.when(F.coalesce(same, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit("identity sets differ")).cast("boolean"))
    return out.filter(fine).drop("_in_first")


def fingerprint_status(expected: DataFrame, live: DataFrame) -> DataFrame:
    """MATCH, DRIFT or MISSING_LIVE for every expected (id, group, hash) against live (id, group, hash).

    A row with a blank group that has no live row of its own may match its id in any group.
    """
    exact = live.groupBy("id", "group").agg(F.collect_set("hash").alias("_exact"))
    loose = live.groupBy("id").agg(F.collect_set("hash").alias("_loose"))
    found = expected.join(exact, ["id", "group"], "left").join(loose, "id", "left")
    seen = F.coalesce("_exact", F.when(F.col("group") == "", F.col("_loose")))
    status = F.when(seen.isNull(), "MISSING_LIVE").when(F.array_contains(seen, F.col("hash")), "MATCH").otherwise("DRIFT")
    return found.select(*expected.columns, status.alias("status"))


def known_drift(observed: DataFrame, registry: DataFrame, key: Sequence[str]) -> DataFrame:
    """Observed drift against a registry: known if key and classification are the same."""
    reg = registry.select(*key, F.col("classification").alias("_known"))
    state = F.when(F.col("_known") == F.col("classification"), "KNOWN_ACTIVE").otherwise("UNCLASSIFIED_OR_CHANGED")
    return observed.join(reg, list(key), "left").select(*observed.columns, state.alias("drift_state"))


def resolved_drift(observed: DataFrame, registry: DataFrame, key: Sequence[str]) -> DataFrame:
    """Registered drift that is no longer observed."""
    return registry.join(observed, list(key), "left_anti")


def closed_world(queries: DataFrame, facts: DataFrame, complete: DataFrame, entity: str, keyword: str) -> DataFrame:
    """PRESENT, ABSENT (only where the entity's facts are complete) or UNKNOWN."""
    hit = facts.select(entity, keyword).distinct().withColumn("_hit", F.lit(True))
    answer = F.when(F.col("_hit"), "PRESENT").when(F.col("complete"), "ABSENT").otherwise("UNKNOWN")
    return queries.join(hit, [entity, keyword], "left").join(complete.select(entity, "complete"), entity, "left").select(*queries.columns, answer.alias("answer"))


def unresolved_references(references: DataFrame, known: DataFrame, aliases: DataFrame, key: str) -> DataFrame:
    """References that exist neither by name nor by alias."""
    return references.join(known, key, "left_anti").join(aliases.join(known.select(F.col(key).alias("alias")), "alias").select(key), key, "left_anti")


def all_present(text: Column, expected: Column) -> Column:
    return F.forall(expected, lambda x: F.contains(text, x))


# --- numbering, ranking, deduplication -----------------------------------------------------------------------------


def copy_number(df: DataFrame, unit: str, *order: str) -> DataFrame:
    return df.withColumn("copy_no", F.row_number().over(Window.partitionBy(unit).orderBy(*order)))


def duplicate_ids(df: DataFrame, key: str, *order: str) -> DataFrame:
    """Every row with PASS for the first of its key and FAIL for later ones and blank keys."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("status", F.when((place == 1) & F.col(key).isNotNull() & (F.col(key).cast("string") != ""), "PASS").otherwise("FAIL"))


def keep_last(df: DataFrame, order: str, *key: str) -> DataFrame:
    return last_by_key(df, order, *key)


def top_counts(df: DataFrame, key: str, k: int) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(k)


def stable_unique(array: str) -> Column:
    return F.array_distinct(array)


def set_operation(left: DataFrame, right: DataFrame, kind: str) -> DataFrame:
    """Set union, intersection or difference."""
    return {"union": lambda: left.union(right).distinct(), "intersect": lambda: left.intersect(right), "difference": lambda: left.subtract(right)}[kind]()
