"""The query surface: what a user asks of the knowledge base, over snapshot DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import norm_strip, quote_norm
from ..operators import relational as R


def points(snapshot: DataFrame, faction: str, unit: str | None = None, detachment: str | None = None, mode: str = "all", group: str | None = None) -> DataFrame:
    """Units with their tiers, or one detachment's enhancements, or a summary when neither is named."""
    doc = snapshot.filter(R.same_fold(F.col("faction.slug"), faction))
    if detachment is not None:
        found = doc.select(F.explode("detachments").alias("d")).filter(R.same_fold(F.col("d.name"), detachment))
        return found.select("d.name", "d.dp", F.explode_outer("d.enhancements").alias("e")).select("name", "dp", F.col("e.name").alias("enhancement"), F.col("e.points").alias("points"))
    units = doc.select(F.explode("units").alias("u")).select("u.*").filter(R.visible(mode, F.col("groupTitle"), group))
    if unit is not None:
        return R.explode_tiers(units.filter(R.same_fold("name", unit)))
    return units.agg(F.count("*").alias("units"), F.count_if(F.size("pricing") > 0).alias("priced_units"))


def semantics(expected: DataFrame, live: DataFrame, kind: str, **identity: str) -> DataFrame:
    """SNAPSHOT_MATCH, SOURCE_DRIFT or NO_SNAPSHOT_FINGERPRINT of the entities that match an identity."""
    keep = F.lit(True)
    for k, v in identity.items():
        keep &= F.col(k) == v
    asked = live.filter((F.col("kind") == kind) & keep).select("kind", "identity", F.col("hash").alias("live_hash"))
    found = asked.join(expected.select("kind", "identity", F.col("hash").alias("_h")), ["kind", "identity"], "left")
    state = F.when(F.col("_h").isNull(), "NO_SNAPSHOT_FINGERPRINT").when(F.col("_h") == F.col("live_hash"), "SNAPSHOT_MATCH").otherwise("SOURCE_DRIFT")
    return found.select("kind", "identity", state.alias("state"))


def leaders(relations: DataFrame, name: str) -> DataFrame:
    """Who a unit leads and who leads it."""
    want = name.lower()
    return relations.filter((quote_norm("leader") == want) | (quote_norm("bodyguard") == want))


def search(df: DataFrame, needle: str, *columns: str) -> DataFrame:
    return df.filter(R.has_any(needle, *columns))


def stratagems(df: DataFrame, fragment: str) -> DataFrame:
    """Stratagems whose name or detachment contains a fragment, both normalised."""
    part = norm_strip(F.lit(fragment))
    return df.filter(F.contains(norm_strip("name"), part) | F.contains(norm_strip("detachment"), part))


def keyword(facts: DataFrame, complete: DataFrame, entity: str, word: str) -> DataFrame:
    asked = facts.sparkSession.createDataFrame([(entity, word)], "entity string, keyword string")
    return R.closed_world(asked, facts, complete, "entity", "keyword")
