"""Walks over nested documents of unknown depth as VARIANT: parsed once, then peeled level by level without leaving the JVM.

A level explodes the objects and arrays of the one before. `nodes` cuts what holds further levels in the shared folder, so no level parses
again and the loop ends with the deepest document. `picked`, for what only looks for something in every node, peels LEVELS levels in one plan
and cuts what it found with what goes deeper. Text that is no JSON (or repeats a key in an object) gives no node.

Names, profiles and summaries are looked for in Arrow batches first, one walk for each document: exploding every node costs far more. `Unlike`
is raised wherever Python's parser and VARIANT may read a text differently or write a value differently; such documents are walked as VARIANT.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import cut, ship

CONTAINERS = ("object", "array")
#: Levels that one pass peels before it is seen whether a document goes deeper. Results don't depend on it.
LEVELS = 10


def kind_of(value: Column) -> Column:
    """object, array, string, number, boolean or null."""
    return kind_of_shape(F.schema_of_variant(value))


def kind_of_shape(shape: Column) -> Column:
    return (
        F.when(shape.startswith("OBJECT"), "object")
        .when(shape.startswith("ARRAY"), "array")
        .when(shape == "STRING", "string")
        .when(shape == "BOOLEAN", "boolean")
        .when(shape == "VOID", "null")
        .otherwise("number")
    )


def _levels(df: DataFrame, key: str, column: str, skip: Iterable[str], leaves: bool) -> DataFrame:
    """Nodes of all levels, or only the objects and arrays; of these each level but the documents themselves is kept, and worked out once."""
    spark, skip = df.sparkSession, list(skip)
    level = df.select(key, F.lit("$").alias("path"), F.lit("").alias("name"), F.lit(0).alias("depth"), F.try_parse_json(F.col(column)).alias("value")).filter("value IS NOT NULL")
    found, inner = [], None
    while True:
        level = level.withColumn("_shape", F.schema_of_variant("value")).withColumn("kind", kind_of_shape(F.col("_shape"))).select(key, "path", "name", "depth", "kind", "value")
        held = level.filter(F.col("kind").isin(*CONTAINERS))
        if inner is not None:  # documents themselves are read from their source again
            held = cut(held)
        found.append(level if leaves else held)
        if inner is not None and held.isEmpty():
            return reduce(DataFrame.unionByName, found)
        inner = held.filter(~F.col("name").isin(skip)) if skip else held
        parent = inner.select(key, F.col("path").alias("_path"), F.col("name").alias("_name"), F.col("depth").alias("_depth"), F.col("value").alias("_node"))
        made = parent.lateralJoin(spark.tvf.variant_explode(F.col("_node").outer()).toDF("_pos", "_key", "_value"))
        step = F.when(F.col("_key").isNull(), F.concat(F.lit("["), "_pos", F.lit("]"))).otherwise(F.concat(F.lit("."), "_key"))
        level = made.select(key, F.concat("_path", step).alias("path"), F.coalesce("_key", "_name").alias("name"), (F.col("_depth") + 1).alias("depth"), F.col("_value").alias("value"))


def nodes(df: DataFrame, key: str, column: str, skip: Iterable[str] = ()) -> DataFrame:
    """(key, path, name, depth, kind, value) of every node of a JSON text, the root too; what stands under the keys `skip` is not entered.

    name is the key that a node, or the array around it, stands under.
    """
    return _levels(df, key, column, skip, leaves=True)


def objects(df: DataFrame, key: str, column: str, skip: Iterable[str] = ()) -> DataFrame:
    """The objects among `nodes`."""
    return _levels(df, key, column, skip, leaves=False).filter("kind = 'object'")


def scalars(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, path, name, kind, value) of every scalar; a null is empty text."""
    leaves = nodes(df, key, column).filter(~F.col("kind").isin(*CONTAINERS))
    return leaves.select(key, "path", "name", "kind", F.coalesce(text("value"), F.lit("")).alias("value"))


def text(value: str, path: str = "$") -> Column:
    return F.try_variant_get(F.col(value), path, "string")


def items(value: str, path: str) -> Column:
    """The elements of an array inside a variant; none where it is missing or no array."""
    return F.coalesce(F.try_variant_get(F.col(value), path, "array<variant>"), F.array().cast("array<variant>"))


def inside(value: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(value, path, kind)


def picked(df: DataFrame, keep: list[str], column: str, pick: Callable[[Column], Column], skip: Iterable[str] = (), root: Callable[[Column], Column] | None = None) -> DataFrame:
    """(keep, x) for each element of the arrays that `pick` (and `root`, for documents themselves) gives for the nodes; what stands under the keys `skip` is not entered.

    What a node gives travels with its first child, so that a pass is one chain of explodes over one reading of the source.
    """
    spark, skip = df.sparkSession, list(skip)
    own = lambda v: F.coalesce(pick(v), F.array())
    value, first = F.col("_value"), F.col("_pos").isNull() | (F.col("_pos") == 0)
    entered = ~F.coalesce(F.col("_name").isin(skip), F.lit(False)) if skip else F.lit(True)
    rows = df.select(*keep, F.lit("").alias("_name"), F.try_parse_json(F.col(column)).alias("_value")).filter("_value IS NOT NULL")
    rows = rows.withColumn("_found", F.concat(own(value), root(value)) if root else own(value))
    parts = []
    while True:
        for _ in range(LEVELS):
            open_ = rows.select(*keep, "_name", "_found", F.when(entered, value).alias("_node"))
            made = open_.lateralJoin(spark.tvf.variant_explode_outer(F.col("_node").outer()).toDF("_pos", "_key", "_value"))
            found = F.when(first, F.col("_found")).otherwise(F.slice("_found", 1, 0))
            rows = made.select(*keep, F.coalesce("_key", "_name").alias("_name"), F.when(value.isNull(), found).otherwise(F.concat(found, own(value))).alias("_found"), "_value").filter("_value IS NOT NULL OR size(_found) > 0")
        deeper = F.when(entered & kind_of(value).isin(*CONTAINERS), value)
        kept = cut(rows.select(*keep, "_name", "_found", deeper.alias("_value")).filter("_value IS NOT NULL OR size(_found) > 0"))
        parts.append(kept.select(*keep, F.explode("_found").alias("x")))
        rest = kept.filter("_value IS NOT NULL")
        if rest.isEmpty():
            return reduce(DataFrame.unionAll, parts)
        rows = rest.withColumn("_found", F.slice("_found", 1, 0))


class Unlike(ValueError):
    """A text or value that Python and VARIANT may take differently."""


#: Far below the parser's bounds for depth, keys and size, beyond which VARIANT has no value.
PLAIN_DEPTH, PLAIN_KEY, PLAIN_CHARS = 400, 10_000, 2_000_000
#: Rows handed on at a time.
PLAIN_ROWS = 4096
FRACTION, SURROGATE = object(), re.compile(r"\\u[dD][89a-fA-F]")


def _plain_object(pairs: list) -> dict:
    made = dict(pairs)
    if len(made) != len(pairs):
        raise Unlike
    return made


def _plain_int(digits: str) -> int:
    if len(digits) > 18:
        raise Unlike
    return int(digits)


def _plain_fraction(digits: str) -> object:
    """A number that is read alike, but not written alike."""
    if len(digits) > 30 or "e" in digits or "E" in digits:
        raise Unlike
    return FRACTION


def _plain_constant(name: str) -> None:
    raise Unlike


DECODER = json.JSONDecoder(object_pairs_hook=_plain_object, parse_int=_plain_int, parse_float=_plain_fraction, parse_constant=_plain_constant)


def plain_text(node: object, name: str) -> str | None:
    """What `inside` gives for a key as a string."""
    value = node.get(name) if type(node) is dict else None
    if value is None or type(value) is str:
        return value
    if value is True or value is False:
        return "true" if value else "false"
    if type(value) is int:
        return str(value)
    raise Unlike


def plain_items(node: object, name: str) -> list | None:
    """The elements of an array under a key, None where it is missing or no array."""
    value = node.get(name) if type(node) is dict else None
    if type(value) is not list:
        return None
    if None in value:
        raise Unlike
    return value


def plain_walk(text: str, pick: Callable[[dict], Iterable], skip: frozenset[str], root: Callable[[object], Iterable] | None) -> list:
    """What `pick` (and `root`) gives for the objects of a document, as `picked` finds it."""
    if len(text) > PLAIN_CHARS or SURROGATE.search(text):
        raise Unlike
    value = DECODER.decode(text)
    found = list(root(value)) if root else []
    long = len(text) > PLAIN_KEY
    # what isn't entered is read all the same where it could hold a level or a key that VARIANT has no value for
    whole = long or text.count("[") + text.count("{") > PLAIN_DEPTH
    stack = [("", value, 0, True)]
    while stack:
        name, node, depth, open_ = stack.pop()
        if depth > PLAIN_DEPTH:
            raise Unlike
        inner = open_ and name not in skip
        if type(node) is dict:
            if open_:
                found.extend(pick(node))
            if long and any(len(k) > PLAIN_KEY for k in node):
                raise Unlike
            if inner or whole:
                stack.extend([(k, x, depth + 1, inner) for k, x in node.items() if type(x) is dict or type(x) is list])
        elif type(node) is list and (inner or whole):
            stack.extend([(name, x, depth + 1, inner) for x in node if type(x) is dict or type(x) is list])
    return found


def plainly(df: DataFrame, keep: list[str], column: str, kind: str, plain: Callable[[dict], Iterable], pick: Callable[[Column], Column], skip: Iterable[str] = (), root: Callable[[Column], Column] | None = None, plain_root: Callable[[object], Iterable] | None = None) -> DataFrame:
    """`picked`, by `plain` (and `plain_root`) where Python reads a document as VARIANT does; x has the type `kind`."""
    ship(df.sparkSession)
    schema = T.StructType([*df.select(*keep).schema.fields, *T.StructType.fromDDL(f"x {kind}, _left string").fields])
    arrow, skipped = to_arrow_schema(schema), frozenset(skip)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PLAIN_ROWS):
                part = batch.slice(at, PLAIN_ROWS)
                rows, found, left = [], [], []
                for i, text in enumerate(part.column(len(keep)).to_pylist()):
                    if text is None:
                        continue
                    try:
                        some = plain_walk(text, plain, skipped, plain_root)
                    except (ValueError, RecursionError):
                        rows.append(i)
                        found.append(None)
                        left.append(text)
                        continue
                    rows.extend([i] * len(some))
                    found.extend(some)
                    left.extend([None] * len(some))
                of = pa.array(rows, pa.int32())
                yield pa.RecordBatch.from_arrays([*[part.column(j).take(of).cast(arrow.field(j).type) for j in range(len(keep))], pa.array(found, arrow.field(len(keep)).type), pa.array(left, arrow.field(len(keep) + 1).type)], schema=arrow)

    kept = cut(df.select(*keep, column).mapInArrow(run, schema))
    sure, rest = kept.filter("_left IS NULL").select(*keep, "x"), kept.filter("_left IS NOT NULL")
    if rest.isEmpty():
        return sure
    return sure.unionAll(picked(rest.select(*keep, F.col("_left").alias(column)), keep, column, pick, skip, root))


def typed_names(df: DataFrame, key: str, column: str, kind: str) -> DataFrame:
    """(key, name) of all objects, at any depth, whose `type` is the given one in whatever case and that have a name."""

    def pick(v: Column) -> Column:
        name = F.try_variant_get(v, "$.name", "variant")
        return F.when((F.lower(inside(v, "$.type")) == kind.lower()) & (kind_of(name) == "string"), F.array(inside(v, "$.name")))

    wanted = kind.lower()

    def plain(node: dict) -> Iterable:
        type_ = plain_text(node, "type")
        if type_ is not None and not type_.isascii():
            raise Unlike
        return (node["name"],) if type_ is not None and type_.lower() == wanted and type(node.get("name")) is str else ()

    return plainly(df, [key], column, "string", plain, pick).select(key, F.col("x").alias("name")).distinct()


def named_costs(df: DataFrame, key: str, column: str, name: Column, cost: str, norm=F.lower) -> DataFrame:
    """(key, costs, cost): the distinct whole values of one kind of cost in all objects of that name (a column of df), and the value if there is just one."""

    def pick(v: Column) -> Column:
        costs = F.filter(F.try_variant_get(v, "$.costs", "array<variant>"), lambda c: inside(c, "$.name") == cost)
        return F.when(norm(inside(v, "$.name")) == F.col("_wanted"), F.transform(costs, lambda c: inside(c, "$.value", "int")))

    values = picked(df.withColumn("_wanted", norm(name)), [key, "_wanted"], column, pick).select(key, F.col("x").alias("v")).filter("v IS NOT NULL")
    by = values.groupBy(key).agg(F.sort_array(F.collect_set("v")).alias("costs"))
    return by.select(key, "costs", F.when(F.size("costs") == 1, F.col("costs")[0]).alias("cost"))


def holding(df: DataFrame, key: str, column: str, wanted: Column, norm=F.lower) -> DataFrame:
    """Keys of the documents in which some string, normalised, is the wanted one (a column of df).

    A JSON text without a backslash has every string in it as it is, between quotes; where case is all that differs, a text that lacks it isn't walked.
    """
    asked = df.withColumn("_wanted", norm(wanted))
    if norm is F.lower:
        asked = asked.filter(F.contains(F.col(column), F.lit("\\")) | F.contains(F.lower(column), F.concat(F.lit('"'), "_wanted", F.lit('"'))))

    def pick(v: Column) -> Column:
        return F.when(F.when(kind_of(v) == "string", norm(inside(v, "$")) == F.col("_wanted")), F.array(F.lit(True)))

    return picked(asked, [key, "_wanted"], column, pick).select(key).distinct()


# Kinds of profiles by type name.
PROFILE_CLASSES = {"Unit": "unit", "Ranged Weapons": "weapon", "Melee Weapons": "weapon", "Abilities": "semantic", "Transport": "semantic"}


def _characteristics(profile: Column) -> Column:
    """Names and texts by name; of repeated names the last one, and only those that have both."""
    listed = F.coalesce(inside(profile, "$.characteristics", "array<variant>"), F.array().cast("array<variant>"))
    pairs = F.filter(F.transform(listed, lambda c: F.struct(inside(c, "$.name").alias("name"), inside(c, '$["$text"]').alias("text"))), lambda c: (F.coalesce(c["name"], F.lit("")) != "") & c["text"].isNotNull())
    last = F.filter(pairs, lambda c, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda d: d["name"] == c["name"]))
    return F.array_sort(last)


def _profiles(v: Column) -> Column:
    """What an object lists as profiles: name, type and characteristics."""
    one = lambda p: F.struct(inside(p, "$.name").alias("name"), inside(p, "$.typeName").alias("type"), _characteristics(p).alias("c"))
    return F.transform(F.try_variant_get(v, "$.profiles", "array<variant>"), one)


PROFILE = "struct<name:string,type:string,c:array<struct<name:string,text:string>>>"


def _plain_profiles(node: object) -> Iterator[dict]:
    """`_profiles` of a parsed object."""
    for p in plain_items(node, "profiles") or ():
        said = {}
        for c in plain_items(p, "characteristics") or ():
            name, text_ = plain_text(c, "name"), plain_text(c, "$text")
            if name and text_ is not None:
                said[name] = text_
        yield {"name": plain_text(p, "name"), "type": plain_text(p, "typeName"), "c": [{"name": n, "text": said[n]} for n in sorted(said)]}


def _classed(typed: DataFrame, *keep: str) -> DataFrame:
    """Profiles (keep, name, type, c) with their class, as `profiles` returns them."""
    kind = reduce(lambda c, x: c.when(F.col("type") == x[0], x[1]), list(PROFILE_CLASSES.items())[1:], F.when(F.col("type") == "Unit", "unit"))
    said = lambda n: F.nullif(F.element_at(F.filter("c", lambda x: x["name"] == n), F.lit(1))["text"], F.lit(""))
    semantic = F.col("class") == "semantic"
    one = lambda n: F.when(F.exists("c", lambda x: x["name"] == n), said(n))
    return typed.withColumn("class", kind).select(*keep, "class", "name", "type", F.when(~semantic, F.col("c")).alias("characteristics"), F.when(semantic, F.sha2(F.coalesce(one("Description"), one("Capacity")), 256)).alias("text_sha256"))


def profiles(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, class, name, type, characteristics, text_sha256) of the profiles that any object lists, by type; other types are left out, and nothing under a profile is entered.

    Units and weapons keep their characteristics; of semantic ones only the hash of the description (or else the capacity) is kept, null where there is none.
    """
    return _classed(plainly(df, [key], column, PROFILE, _plain_profiles, _profiles, ["profiles"]).select(key, "x.*"), key).filter("class IS NOT NULL")


def _plain_entry(node: object) -> dict:
    """What a summary says of a parsed document itself."""
    texts = lambda v, *names: {n: plain_text(v, n) for n in names}
    return texts(node, "id", "name", "type") | {
        "categories": [n for c in plain_items(node, "categoryLinks") or () if (n := plain_text(c, "name"))],
        "costs": [x for c in plain_items(node, "costs") or () if (x := texts(c, "name", "value"))["name"]],
        "constraints": [texts(c, "field", "scope", "type", "value") for c in plain_items(node, "constraints") or ()],
    }


def entry_summaries(df: DataFrame, key: str, column: str) -> DataFrame:
    """One row for each document: id, name, type, categories, costs, constraints, and its distinct profiles by class, in order."""

    def flat(v: Column) -> Column:
        items_ = lambda path: F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))
        names = F.filter(F.transform(items_("$.categoryLinks"), lambda c: inside(c, "$.name")), lambda n: F.coalesce(n, F.lit("")) != "")
        costs = F.filter(F.transform(items_("$.costs"), lambda c: F.struct(inside(c, "$.name").alias("name"), inside(c, "$.value").alias("value"))), lambda c: F.coalesce(c["name"], F.lit("")) != "")
        limits = F.transform(items_("$.constraints"), lambda c: F.struct(*[inside(c, f"$.{n}").alias(n) for n in ("field", "scope", "type", "value")]))
        return F.struct(*[inside(v, f"$.{n}").alias(n) for n in ("id", "name", "type")], names.alias("categories"), costs.alias("costs"), limits.alias("constraints"))

    profile, entry = lambda v: F.transform(_profiles(v), lambda p: F.struct(p.alias("p"), F.when(F.lit(False), flat(v)).alias("e"))), lambda v: F.array(F.struct(F.get(_profiles(v), F.lit(-1)).alias("p"), flat(v).alias("e")))
    kind = f"struct<p:{PROFILE},e:struct<id:string,name:string,type:string,categories:array<string>,costs:array<struct<name:string,value:string>>,constraints:array<struct<field:string,scope:string,type:string,value:string>>>>"
    found = _classed(plainly(df, [key], column, kind, lambda v: ({"p": p, "e": None} for p in _plain_profiles(v)), profile, ["profiles"], entry, lambda v: ({"p": None, "e": _plain_entry(v)},)).select(key, F.col("x.e").alias("e"), "x.p.*"), key, "e")
    # of one reading: documents and profiles meet by key; a document without a key, or whose key has no profile, has none
    packed, any_ = F.struct("name", "type", "characteristics", "text_sha256"), F.col(key).isNotNull() & (F.col("_n") > 0)
    grouped = found.groupBy(key).agg(F.collect_list("e").alias("_e"), F.count("class").alias("_n"), *[F.array_sort(F.collect_set(F.when(F.col("class") == c, packed))).alias(f"{c}_profiles") for c in ("unit", "weapon", "semantic")])
    return grouped.select(key, F.explode("_e").alias("_e"), *[F.when(any_, F.col(f"{c}_profiles")).alias(f"{c}_profiles") for c in ("unit", "weapon", "semantic")]).select(key, "_e.*", "unit_profiles", "weapon_profiles", "semantic_profiles")
