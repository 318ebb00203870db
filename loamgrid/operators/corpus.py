"""Page corpora: lines and spans with offsets, paragraphs, sections, running headers, and exact overlap of short units with pages."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.text import clean_short_label, fingerprint_normalize, name_norm, rule_refs, token_count
from ..session import cut, ship
from .relational import last_by_key


def lines(pages: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """line (from 1), text, char_start and char_end (half-open) of every line; CRLF counts as two characters of the line break."""
    split = F.regexp_replace(F.col(text), "\n$", "")
    rows = pages.filter((F.col(text).isNotNull()) & (F.col(text) != "")).select(*key, F.posexplode(F.split(split, "\n")).alias("_i", "_raw"))
    before = Window.partitionBy(*key).orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("_raw") + 1).over(before), F.lit(0)).cast("long")
    content = F.regexp_replace("_raw", "\r+$", "")
    return rows.select(*key, (F.col("_i") + 1).alias("line"), content.alias("text"), start.alias("char_start"), (start + F.length(content)).alias("char_end"))


def is_blank(text: str = "text") -> Column:
    return clean_short_label(text) == ""


def paragraphs(line_rows: DataFrame, key: list[str], separator: Column) -> DataFrame:
    """Runs of lines between separator lines: ordinal, first and last line and character, number of lines and tokens."""
    w = Window.partitionBy(*key).orderBy("line")
    marked = line_rows.withColumn("_sep", separator.cast("int")).withColumn("_island", F.sum("_sep").over(w.rowsBetween(Window.unboundedPreceding, 0))).filter("_sep = 0")
    grouped = marked.groupBy(*key, "_island").agg(
        F.min("line").alias("line_start"), F.max("line").alias("line_end"), F.min("char_start").alias("char_start"), F.max("char_end").alias("char_end"),
        F.count("*").alias("line_count"), F.sum(token_count("text")).alias("token_count"),
    )
    return grouped.withColumn("ordinal", F.row_number().over(Window.partitionBy(*key).orderBy("_island"))).drop("_island")


def trimmed(line_rows: DataFrame, key: list[str], blank: Column) -> DataFrame:
    """Lines without the blank ones at the start and the end; inner ones stay."""
    w = Window.partitionBy(*key)
    used = F.when(~blank, F.col("line"))
    return line_rows.withColumns({"_a": F.min(used).over(w), "_b": F.max(used).over(w)}).filter("line between _a and _b").drop("_a", "_b")


def between(line_rows: DataFrame, bounds: DataFrame, key: list[str]) -> DataFrame:
    """Lines strictly between two (page, line) places; a null end is open."""
    here = F.struct("page", "line")
    joined = line_rows.join(bounds, key)
    return joined.filter((here > F.struct("start_page", "start_line")) & (F.col("end_page").isNull() | (here < F.struct(F.col("end_page").alias("page"), F.col("end_line").alias("line"))))).select(*line_rows.columns, "section")


def next_anchor(anchors: DataFrame, family: list[str], order: list[str], last: Column) -> DataFrame:
    """Each anchor with where the next one of its family stands, or the family's end."""
    nxt = F.lead(F.struct(*order)).over(Window.partitionBy(*family).orderBy(*order))
    return anchors.withColumn("next", nxt).withColumn("ends_with_family", F.col("next").isNull()).withColumn("end_page", F.coalesce(F.col(f"next.{order[0]}"), last))


def family_ends(families: DataFrame, document: list[str], start: str, pages: Column) -> DataFrame:
    """A family ends one page before the next starts, but not before its own start."""
    follow = F.lead(start).over(Window.partitionBy(*document).orderBy(start))
    return families.withColumn("end_page", F.greatest(F.col(start), F.coalesce(follow - 1, pages)))


def section_ends(sections: DataFrame, document: list[str]) -> DataFrame:
    """Of every section (ordinal, depth): the ordinal of the next one that isn't deeper, and how many direct children stand before it.

    One ordered pass with a stack of the open sections, whose depths only rise: a document of any length streams by in memory that follows its depth.
    Sections of one ordinal neither end nor hold each other; one without ordinal or depth has no end and no children, and ends nothing.
    """
    spark = sections.sparkSession
    ship(spark)
    names = [*document, "ordinal", "depth"]
    kinds = dict(sections.dtypes)
    rows = sections.select(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, stack, group = None, [], []  # an open section is [ordinal, depth, children, columns]
        out: list[tuple] = []

        def close(section, following) -> None:
            out.append((*section[3], section[0], section[1], following, section[2]))

        def take() -> None:
            """The sections of one ordinal: they end what isn't less deep, are children of what is one less deep, and then stand open themselves."""
            if group:
                least = min(g[1] for g in group)
                while stack and stack[-1][1] >= least:
                    close(stack.pop(), group[0][0])
                for g in group:
                    for s in reversed(stack):
                        if s[1] < g[1] - 1:
                            break
                        s[2] += s[1] == g[1] - 1
                stack.extend(sorted(group, key=lambda g: g[1]))
                group.clear()

        def finish() -> None:
            take()
            while stack:
                close(stack.pop(), None)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key, ordinal, depth = row[:-2], row[-2], row[-1]
                if key != doc:
                    finish()
                    doc = key
                if ordinal is None or depth is None:
                    out.append((*row, None, 0))
                    continue
                if group and group[0][0] != ordinal:
                    take()
                group.append([ordinal, depth, 0, key])
            yield made(out)
            out.clear()
        finish()
        yield made(out)

    def made(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [()] * len(arrow)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    schema = ", ".join(f"`{n}` {kinds[n]}" for n in names) + f", next_ordinal {kinds['ordinal']}, children long"
    arrow = to_arrow_schema(spark.createDataFrame([], schema).schema)
    dealt = rows.repartition(*document).sortWithinPartitions(*document, "ordinal", "depth")
    return dealt.mapInArrow(run, schema)


def definition_start(anchors: DataFrame, seen: DataFrame, key: list[str], back: int = 4) -> DataFrame:
    """The first page within `back` pages before an anchor on which its reference is seen, else the anchor's own page."""
    hits = anchors.join(seen.select(*key, F.col("page").alias("_p")), key, "left").filter("_p is null or _p <= page")
    near = F.min(F.when((F.col("_p") >= F.col("page") - back) & (F.col("_p") <= F.col("page")), F.col("_p")))
    start = hits.groupBy(*key, "page").agg(near.alias("_s"))
    return anchors.join(start, [*key, "page"], "left").select(*anchors.columns, F.coalesce("_s", "page").alias("start_page"))


def running_header_filter(labels: DataFrame, document: list[str], most: int = 4, first: int = 16, keep: int = 10) -> DataFrame:
    """Labels (page, place, label) that stand on at most `most` pages, of the first 16 of each page at most ten.

    A label is counted once a page and over all of them, before either limit.
    """
    page = [*document, "page"]
    once = labels.groupBy(*page, "label").agg(F.min("place").alias("place"))
    # only the counts of the labels that stay meet the pages, not the pages of a label that stands on most of them
    rare = once.groupBy(*document, "label").agg(F.count("*").alias("pages")).filter(F.col("pages") <= most)
    order = Window.partitionBy(*page).orderBy("place")
    head = once.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= first).join(rare, [*document, "label"])
    return head.withColumn("_k", F.row_number().over(order)).filter(F.col("_k") <= keep).drop("_n", "_k")


def occurrence_ordinals(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    return rows.withColumn("ordinal", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))


def outline_rows(outline: DataFrame, pages: Column) -> DataFrame:
    """Outline entries on existing pages, the first of each (title, depth, page), in order."""
    first = F.row_number().over(Window.partitionBy("doc_id", "title", "depth", "page").orderBy("ordinal"))
    return outline.filter((F.col("page") >= 1) & (F.col("page") <= pages)).withColumn("_r", first).filter("_r = 1").drop("_r")


def fallback_sections(headings: DataFrame) -> DataFrame:
    """Without an outline the first heading of each page is a section at depth 0."""
    return headings.withColumn("_r", F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("place"))).filter("_r = 1").select("doc_id", "page", F.col("label").alias("title"), F.lit(0).alias("depth"))


def reference_atoms(pages: DataFrame, families: DataFrame) -> DataFrame:
    """Every rule reference (00.00): pages that mention it, inside its family's range (heading) and outside (cross reference)."""
    seen = pages.select("doc_id", "page", F.explode(F.array_distinct(rule_refs("text"))).alias("ref")).withColumn("family", F.split("ref", r"\.")[0])
    joined = seen.join(families, ["doc_id", "family"], "left")
    inside = F.col("page").between(F.col("start_page"), F.col("end_page"))
    return joined.groupBy("doc_id", "ref").agg(
        F.sort_array(F.collect_set("page")).alias("pages"),
        F.sort_array(F.collect_set(F.when(inside, F.col("page")))).alias("family_pages"),
        F.sort_array(F.collect_set(F.when(~F.coalesce(inside, F.lit(False)), F.col("page")))).alias("cross_pages"),
    )


def span_text(pages: Column, start: Column, end: Column, outer_start: Column, outer_end: Column) -> Column:
    """The characters of a child span; a span outside its parent fails."""
    ok = (start >= outer_start) & (start < end) & (end <= outer_end)
    return F.when(ok, F.substring(pages, start + 1, end - start)).otherwise(F.raise_error(F.lit("span outside its parent")))


# --- exact overlap of units with pages -----------------------------------------------------------------------------


#: Tokens are told apart by this many hash values where their numbers are counted: a bound for what is sent to the driver and to the tasks.
TOKEN_SLOTS = 1 << 16


def _slot(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(TOKEN_SLOTS)).cast("int")


def _tokens(text: str) -> Column:
    return F.filter(F.split(text, " "), lambda w: w != "")


def _anchored(units: DataFrame, page_rows: DataFrame, size: int) -> DataFrame:
    """Pairs of units and pages where the page contains the unit.

    A unit's anchor is its run of `size` tokens that begins with the token rarest on the pages (by slots of a hash, whose counts are at most TOKEN_SLOTS
    numbers). Pages make only the runs that begin with a token of some anchor's slot, without their texts; pages and units that share a run meet
    and only then are texts compared. Page texts are read twice, so they should be kept (`kept`), not made anew.
    """
    keys = [c for c in page_rows.columns if c != "text"]
    counted = page_rows.select(F.explode(F.transform(_tokens("text"), _slot)).alias("slot")).groupBy("slot").agg(F.count("*").alias("n"))
    often = [0] * TOKEN_SLOTS
    for slot, n in counted.collect():
        often[slot] = n
    numbers = F.from_json(F.lit(json.dumps(often)), "array<long>")
    heads = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - size + 1), lambda i: F.struct(F.element_at(numbers, _slot(F.element_at(w, i)) + 1).alias("n"), i.alias("i")))
    tokens = units.select("unit_key", F.col("text").alias("unit_text"), _tokens("text").alias("w")).filter(F.size("w") >= size)
    first = tokens.withColumn("at", F.array_min(heads(F.col("w")))["i"])
    anchors = cut(first.select("unit_key", "unit_text", F.array_join(F.slice("w", F.col("at"), size), " ").alias("anchor"), _slot(F.element_at("w", F.col("at"))).alias("slot")))
    slots = [r[0] for r in anchors.select("slot").distinct().collect()]
    begins = lambda w: F.filter(F.sequence(F.lit(1), F.size(w) - size + 1), lambda i: _slot(F.element_at(w, i)).isin(slots))
    runs = F.transform(F.array(_tokens("text")), lambda w: F.when(F.size(w) >= size, F.transform(begins(w), lambda i: F.array_join(F.slice(w, i, size), " "))))[0]
    found = page_rows.select(*keys, F.explode(F.array_distinct(runs)).alias("anchor")).join(anchors.drop("slot"), "anchor").join(page_rows, keys)
    inside = F.contains(F.concat(F.lit(" "), F.col("text"), F.lit(" ")), F.concat(F.lit(" "), F.col("unit_text"), F.lit(" ")))
    return found.filter(inside).select("unit_key", *keys).distinct()


def kept(pages: DataFrame) -> DataFrame:
    """Normalised pages, worked out once and kept in the shared folder, for the passes of `page_hits` and `page_pair_hits`."""
    return cut(pages)


def page_hits(units: DataFrame, pages: DataFrame, min_chars: int = 40, min_tokens: int = 6) -> DataFrame:
    """unit_key, doc_id, page_start, page_end of units inside single pages. Both texts must be normalised the same way."""
    good = units.filter((F.length("text") >= min_chars) & (F.size(F.split("text", " ")) >= min_tokens))
    return _anchored(good, pages.select("doc_id", F.col("page").alias("page_start"), F.col("page").alias("page_end"), "text"), min_tokens)


def page_pair_hits(units: DataFrame, pages: DataFrame, matched: DataFrame, min_chars: int = 40, min_tokens: int = 6, strict: bool = False) -> DataFrame:
    """Units without a hit on a single page, found across two neighbouring pages. `strict` leaves the length minimum to the first pass."""
    rest = units.join(matched.select("unit_key").distinct(), "unit_key", "left_anti").filter(F.size(F.split("text", " ")) >= min_tokens)
    rest = rest if strict else rest.filter(F.length("text") >= min_chars)
    w = Window.partitionBy("doc_id").orderBy("page")
    pairs = pages.withColumns({"_n": F.lead("page").over(w), "_t": F.lead("text").over(w)}).filter("_n = page + 1")
    return _anchored(rest, pairs.select("doc_id", F.col("page").alias("page_start"), F.col("_n").alias("page_end"), F.concat_ws(" ", "text", "_t").alias("text")), min_tokens)


def provenance(hits: DataFrame, units: DataFrame) -> DataFrame:
    """Each hit unit's scope: hits in its own source's document, else its faction's, else a core document, else anywhere; and how many documents.

    hits: unit_key, doc_id, doc_type; units: unit_key, source_doc, faction_doc (the documents expected, or null).
    """
    by = hits.join(units, "unit_key").groupBy("unit_key").agg(
        F.count_if(F.col("doc_id") == F.col("source_doc")).alias("own"), F.count_if(F.col("doc_id") == F.col("faction_doc")).alias("faction"),
        F.count_if(F.col("doc_type") == "CORE_RULES").alias("core"), F.count_distinct("doc_id").alias("documents"),
    )
    scope = F.when(F.col("own") > 0, "DIRECT_SOURCE_SCOPED").when(F.col("faction") > 0, "DIRECT_FACTION_SCOPED").when(F.col("core") > 0, "CORE_PUBLIC_TEXT_ONLY").otherwise("GLOBAL_PUBLIC_TEXT_ONLY")
    match = F.when(F.col("documents") > 1, "EXACT_NORMALIZED_TEXT_MATCH_MULTI_OFFICIAL").otherwise("EXACT_NORMALIZED_TEXT_MATCH")
    return by.select("unit_key", "documents", scope.alias("provenance_scope"), match.alias("match_class"))


def pack_mapping(factions: DataFrame, sources: DataFrame, documents: DataFrame, aliases: dict[str, str], order: str, edition: str = "11", kind: str = "Faction Pack") -> DataFrame:
    """(faction_id, source_id, document_id): each faction's pack by its normalised name or that name's alias, if a document of it is there.

    factions: id, name; sources: id, name, edition, type; documents: source_id, document_id; all with `order`, by which the last of equal names, sources
    or ids counts (a name's last source counts even where it has no document). A null name is an empty one. `aliases` is a fixed table of normalised names.
    """
    name = name_norm(F.coalesce("name", F.lit("")))
    other = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair]) if aliases else None
    packs = sources.filter((F.col("edition").cast("string") == edition) & (F.col("type") == kind))
    packs = last_by_key(packs.select(name.alias("_name"), F.col("id").alias("source_id"), order), order, "_name").drop(order)
    held = last_by_key(documents.filter("source_id is not null and cast(source_id as string) <> ''").select("source_id", "document_id", order), order, "source_id").drop(order)
    asked = factions.withColumn("_n", name).select(F.col("id").alias("faction_id"), (F.coalesce(F.try_element_at(other, "_n"), "_n") if aliases else F.col("_n")).alias("_name"), order)
    return last_by_key(asked.join(packs, "_name").join(held, "source_id"), order, "faction_id").select("faction_id", "source_id", "document_id")


def document_hash(pages: DataFrame) -> DataFrame:
    """SHA-256 of a document's normalised pages in order."""
    from .aggregates import ordered_hash

    return ordered_hash(pages.withColumn("text", fingerprint_normalize("text")), "doc_id", "page", "text")
