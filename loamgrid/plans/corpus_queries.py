"""Queries of the text corpus: lines, paragraphs, sections, headers, overlap, lexical classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import unicode as U
from ..operators import classify as K
from ..operators import corpus as C
from ..session import table
from ..sources.readers import page_corpus
from .base import query

#: A stand-in lexicon of frequent tokens: the test prose hardly has the words of the fixed one.
LEXICON = {
    "PROHIBITION_CANNOT": ("PROHIBITION", r"\bfrom\b"),
    "OBLIGATION_MUST": ("OBLIGATION", r"\bwith\b"),
    "PERMISSION_CAN": ("PERMISSION", r"\bby\b"),
    "CONDITION_IF": ("CONDITION_OR_TRIGGER", r"\bor\b"),
    "SEQUENCE_THEN": ("PROCEDURE_OR_SEQUENCE", r"\bthen\b"),
    "DEFINITION_MEANS": ("DEFINITION", r"\bmeans\b"),
    "REPLACEMENT_INSTEAD": ("MODIFICATION_OR_REPLACEMENT", r"\binstead\b"),
    "REFERENCE_SEE": ("REFERENCE_OR_CROSS_REFERENCE", r"\bthis\b"),
}
_NORM = "trim(regexp_replace(replace(lower(regexp_replace(replace({c}, chr(173), ''), '<[^>]*>', ' ', 'g')), 'ß', 'ss'), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
# &amp; and the like stay out of the test texts, so the twins don't decode them


def _n(c: str) -> str:
    return _NORM.format(c=c)


_PAGES_SQL = f"""
pages0 AS (SELECT doc_id, unnest(generate_series(0, len(l) - 1, 4)) AS i, l FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)),
corpus AS (SELECT doc_id, CAST(i / 4 AS BIGINT) + 1 AS page, {_n("array_to_string(list_slice(l, i + 1, i + 4), chr(10))")} AS text FROM pages0),
units AS (SELECT 'item-' || item_id AS unit_key, {_n("text")} AS text FROM benchmark WHERE text IS NOT NULL),
good AS (SELECT * FROM units WHERE length(text) >= 40 AND len(string_split(text, ' ')) >= 6),
hits AS (SELECT DISTINCT unit_key, doc_id, page AS page_start, page AS page_end FROM good JOIN corpus ON contains(' ' || corpus.text || ' ', ' ' || good.text || ' ')),
pairs AS (SELECT doc_id, page, lead(page) OVER w AS n, text || ' ' || lead(text) OVER w AS text FROM corpus WINDOW w AS (PARTITION BY doc_id ORDER BY page)),
hits2 AS (SELECT DISTINCT unit_key, doc_id, page AS page_start, n AS page_end FROM good JOIN pairs ON n = page + 1 AND contains(' ' || pairs.text || ' ', ' ' || good.text || ' ')
          WHERE unit_key NOT IN (SELECT unit_key FROM hits))
"""


def _corpus(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id")  # as the windows over neighbouring pages need it
    return C.kept(page_corpus(docs).withColumns({"text": T.overlap_normalize("text"), "page": F.col("page").cast("long")}))


def _units(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "benchmark").filter("text is not null").select(F.concat(F.lit("item-"), "item_id").alias("unit_key"), T.overlap_normalize("text").alias("text"))


def _lines(spark, sf_dir) -> DataFrame:
    return C.lines(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])


_LINES_SQL = """
raw AS (SELECT doc_id, string_split(regexp_replace(text, '\\n$', ''), chr(10)) AS l FROM documents WHERE text IS NOT NULL AND text <> ''),
one AS (SELECT doc_id, unnest(generate_series(1, len(l))) AS line, unnest(l) AS text FROM raw),
lines AS (SELECT doc_id, line, text, CAST(coalesce(sum(length(text) + 1) OVER (PARTITION BY doc_id ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS char_start FROM one)
"""


@query(f"WITH {_LINES_SQL} SELECT doc_id, CAST(line AS BIGINT) AS line, sha256(text) AS text_sha256, char_start, char_start + length(text) AS char_end FROM lines")
def line_records(spark, sf_dir):
    return _lines(spark, sf_dir).select("doc_id", F.col("line").cast("long").alias("line"), F.sha2("text", 256).alias("text_sha256"), "char_start", "char_end")


@query(f"""
WITH {_LINES_SQL}, marked AS (SELECT *, CAST(length(text) < 12 AS INTEGER) AS sep FROM lines),
isl AS (SELECT *, sum(sep) OVER (PARTITION BY doc_id ORDER BY line) AS island FROM marked), kept AS (SELECT * FROM isl WHERE sep = 0)
SELECT doc_id, CAST(min(line) AS BIGINT) AS line_start, CAST(max(line) AS BIGINT) AS line_end, min(char_start) AS char_start, max(char_start + length(text)) AS char_end, count(*) AS line_count,
       row_number() OVER (PARTITION BY doc_id ORDER BY min(line)) AS ordinal FROM kept GROUP BY doc_id, island
""")
def paragraph_islands(spark, sf_dir):
    out = C.paragraphs(_lines(spark, sf_dir), ["doc_id"], F.length("text") < 12).drop("token_count")
    return out.select("doc_id", *[F.col(c).cast("long").alias(c) for c in ("line_start", "line_end", "char_start", "char_end", "line_count", "ordinal")])


@query(f"""
WITH {_LINES_SQL}, b AS (SELECT doc_id, min(line) AS a, max(line) AS z FROM lines WHERE length(text) >= 30 GROUP BY doc_id)
SELECT doc_id, CAST(line AS BIGINT) AS line FROM lines JOIN b USING (doc_id) WHERE line BETWEEN a AND z
""")
def trimmed_lines(spark, sf_dir):
    return C.trimmed(_lines(spark, sf_dir), ["doc_id"], F.length("text") < 30).select("doc_id", F.col("line").cast("long").alias("line"))


@query("""
WITH s AS (SELECT conv_id AS doc_id, turn AS ordinal, CAST(length(coalesce(text, '')) % 3 AS BIGINT) AS depth FROM conversations),
e AS (SELECT a.doc_id, a.ordinal, a.depth, min(b.ordinal) AS next_ordinal FROM s a LEFT JOIN s b ON b.doc_id = a.doc_id AND b.ordinal > a.ordinal AND b.depth <= a.depth GROUP BY ALL)
SELECT e.doc_id, e.ordinal, e.depth, e.next_ordinal, count(b.ordinal) AS children FROM e LEFT JOIN s b ON b.doc_id = e.doc_id AND b.ordinal > e.ordinal AND (e.next_ordinal IS NULL OR b.ordinal < e.next_ordinal) AND b.depth = e.depth + 1
GROUP BY ALL
""")
def section_ranges(spark, sf_dir):
    s = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("ordinal"), (F.length(F.coalesce("text", F.lit(""))) % 3).cast("long").alias("depth"))
    return C.section_ends(s, ["doc_id"])


@query(f"""
WITH {_LINES_SQL}, lab AS (SELECT source AS d, doc_id AS page, line AS place, trim(regexp_replace(lines.text, '\\s+', ' ', 'g')) AS label FROM lines JOIN documents USING (doc_id)),
once AS (SELECT d, page, label, min(place) AS place FROM lab WHERE label <> '' GROUP BY d, page, label), cnt AS (SELECT *, count(*) OVER (PARTITION BY d, label) AS pages FROM once),
f AS (SELECT *, row_number() OVER (PARTITION BY d, page ORDER BY place) AS n FROM cnt), g AS (SELECT *, row_number() OVER (PARTITION BY d, page ORDER BY place) AS k FROM f WHERE n <= 16 AND pages <= 4)
SELECT d AS source, page, CAST(place AS BIGINT) AS place, sha256(label) AS label_sha256, pages FROM g WHERE k <= 10
""")
def heading_frequency_filter(spark, sf_dir):
    labels = _lines(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    labels = labels.select("source", F.col("doc_id").alias("page"), F.col("line").alias("place"), F.trim(F.regexp_replace("text", r"\s+", " ")).alias("label")).filter("label <> ''")
    out = C.running_header_filter(labels, ["source"])
    return out.select("source", "page", F.col("place").cast("long").alias("place"), F.sha2("label", 256).alias("label_sha256"), "pages")


@query(f"WITH {_PAGES_SQL} SELECT unit_key, doc_id, page_start, page_end FROM hits")
def shingle_overlap(spark, sf_dir):
    return C.page_hits(_units(spark, sf_dir), _corpus(spark, sf_dir))


@query(f"WITH {_PAGES_SQL} SELECT unit_key, doc_id, page_start, page_end FROM hits2")
def page_pair_overlap(spark, sf_dir):
    units, corpus = _units(spark, sf_dir), _corpus(spark, sf_dir)
    return C.page_pair_hits(units, corpus, C.page_hits(units, corpus))


def _hits(spark, sf_dir):
    units, corpus = _units(spark, sf_dir), _corpus(spark, sf_dir)
    one = C.page_hits(units, corpus)
    return one.union(C.page_pair_hits(units, corpus, one))


_SCOPE_SQL = f"""
{_PAGES_SQL}, every AS (SELECT * FROM hits UNION ALL SELECT * FROM hits2),
typed AS (SELECT unit_key, doc_id, CASE WHEN doc_id % 5 = 0 THEN 'CORE_RULES' ELSE 'PACK' END AS doc_type FROM every),
want AS (SELECT unit_key, min(doc_id) FILTER (WHERE doc_id % 2 = 0) AS source_doc, min(doc_id) FILTER (WHERE doc_id % 3 = 0) AS faction_doc FROM typed GROUP BY unit_key),
scope AS (SELECT t.unit_key, count(DISTINCT doc_id) AS documents,
  CASE WHEN bool_or(coalesce(doc_id = source_doc, false)) THEN 'DIRECT_SOURCE_SCOPED' WHEN bool_or(coalesce(doc_id = faction_doc, false)) THEN 'DIRECT_FACTION_SCOPED' WHEN bool_or(doc_type = 'CORE_RULES') THEN 'CORE_PUBLIC_TEXT_ONLY' ELSE 'GLOBAL_PUBLIC_TEXT_ONLY' END AS provenance_scope
  FROM typed t JOIN want USING (unit_key) GROUP BY t.unit_key)
"""


@query(f"WITH {_SCOPE_SQL} SELECT unit_key, documents, provenance_scope, CASE WHEN documents > 1 THEN 'EXACT_NORMALIZED_TEXT_MATCH_MULTI_OFFICIAL' ELSE 'EXACT_NORMALIZED_TEXT_MATCH' END AS match_class FROM scope")
def provenance_scope(spark, sf_dir):
    hits = _hits(spark, sf_dir).select("unit_key", "doc_id", F.expr("case when doc_id % 5 = 0 then 'CORE_RULES' else 'PACK' end").alias("doc_type"))
    want = hits.groupBy("unit_key").agg(F.min(F.expr("case when doc_id % 2 = 0 then doc_id end")).alias("source_doc"), F.min(F.expr("case when doc_id % 3 = 0 then doc_id end")).alias("faction_doc"))
    return C.provenance(hits, want)


@query(f"""
WITH {_SCOPE_SQL} SELECT u.unit_key, CASE WHEN s.unit_key IS NOT NULL THEN 'MATCHED' WHEN length(u.text) < 40 OR len(string_split(u.text, ' ')) < 6 THEN 'TOO_SHORT_FOR_SAFE_AUTO_MATCH'
 WHEN CAST(substr(u.unit_key, 6) AS BIGINT) % 4 = 0 THEN 'NON_11_OR_LEGENDS_SOURCE_NO_EXACT' WHEN CAST(substr(u.unit_key, 6) AS BIGINT) % 4 = 1 THEN 'EDITION_11_SOURCE_NO_EXACT_PUBLIC_OVERLAP'
 WHEN CAST(substr(u.unit_key, 6) AS BIGINT) % 4 = 2 THEN 'UNKNOWN_SOURCE_ID_NO_EXACT' ELSE 'NO_SOURCE_OR_FACTION_NO_EXACT' END AS residual_class
FROM units u LEFT JOIN scope s USING (unit_key)
""")
def residual_classes(spark, sf_dir):
    matched = _hits(spark, sf_dir).select("unit_key").distinct().withColumn("hit", F.lit(True))
    u = _units(spark, sf_dir).join(matched, "unit_key", "left").withColumn("k", F.substring("unit_key", 6, 20).cast("long") % 4)
    source = F.when(F.col("k") < 3, F.concat(F.lit("s"), "k"))
    edition = F.when(F.col("k") == 0, "10").when(F.col("k") == 1, "11")
    kind = K.no_exact_class(F.length("text"), F.size(F.split("text", " ")), source, edition, F.lit(None).cast("string"))
    return u.select("unit_key", F.when(F.col("hit"), "MATCHED").otherwise(kind).alias("residual_class"))


def _signals(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.withColumns(K.signal_columns("text", LEXICON)).withColumns(K.family_columns(LEXICON))


def _count(word: str) -> str:
    return f"CAST(len(regexp_extract_all(lower(coalesce(text, '')), '\\b{word}\\b')) AS INTEGER)"


_STEP = "CAST(len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '^\\s*(?:\\d{1,2}[.)]|[A-Z][.)])\\s+'))) AS INTEGER)"
_BULLETS = "CAST(len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '^\\s*(?:[•●▪◦‣⁃*-])\\s+'))) AS INTEGER)"
_SIGNALS_SQL = f"""
sig AS (SELECT doc_id, text, {_count("from")} AS prohibition, {_count("with")} AS obligation, {_count("by")} AS permission, {_count("or")} AS condition, {_count("then")} + {_STEP} AS sequence,
        {_count("means")} AS definition, {_count("instead")} AS modification, {_count("this")} AS reference, CASE WHEN {_BULLETS} >= 2 THEN {_BULLETS} ELSE 0 END AS list FROM documents),
strong AS (SELECT *, CAST(prohibition > 0 AS INT) + CAST(obligation > 0 AS INT) + CAST(permission > 0 AS INT) AS modals,
           CAST(prohibition > 0 AS INT) + CAST(obligation > 0 AS INT) + CAST(permission > 0 AS INT) + CAST(condition > 0 AS INT) + CAST(sequence > 0 AS INT) + CAST(definition > 0 AS INT) + CAST(modification > 0 AS INT) AS n FROM sig),
roles AS (SELECT *, CASE WHEN n > 1 THEN 'MIXED' WHEN n = 1 THEN CASE WHEN prohibition > 0 THEN 'PROHIBITION' WHEN obligation > 0 THEN 'OBLIGATION' WHEN permission > 0 THEN 'PERMISSION' WHEN condition > 0 THEN 'CONDITION_OR_TRIGGER'
   WHEN sequence > 0 THEN 'PROCEDURE_OR_SEQUENCE' WHEN definition > 0 THEN 'DEFINITION' ELSE 'MODIFICATION_OR_REPLACEMENT' END WHEN reference > 0 THEN 'REFERENCE_OR_CROSS_REFERENCE' ELSE 'UNCLASSIFIED' END AS role,
   CASE WHEN n > 1 THEN 'MIXED' WHEN n = 1 OR reference > 0 THEN 'HIGH' ELSE 'NONE' END AS confidence,
   CASE modals WHEN 0 THEN 'NONE' WHEN 1 THEN CASE WHEN prohibition > 0 THEN 'PROHIBITION' WHEN obligation > 0 THEN 'OBLIGATION' ELSE 'PERMISSION' END ELSE 'MULTI_MODAL' END AS modal_axis,
   CASE WHEN modals >= 2 THEN 'MULTI_MODAL_REVIEW_REQUIRED' WHEN n > 0 THEN 'AXIS_PROFILE_READY' ELSE 'NO_STRONG_SIGNAL_REVIEW_REQUIRED' END AS review_state FROM strong)
"""


@query(f"WITH {_SIGNALS_SQL} SELECT doc_id, prohibition, obligation, permission, condition, sequence, definition, modification, reference, list FROM sig")
def lexical_signals(spark, sf_dir):
    names = {"PROHIBITION": "prohibition", "OBLIGATION": "obligation", "PERMISSION": "permission", "CONDITION_OR_TRIGGER": "condition", "PROCEDURE_OR_SEQUENCE": "sequence", "DEFINITION": "definition", "MODIFICATION_OR_REPLACEMENT": "modification", K.REFERENCE: "reference", K.LIST: "list"}
    return _signals(spark, sf_dir).select("doc_id", *[F.col(k).cast("int").alias(v) for k, v in names.items()])


@query(f"WITH {_SIGNALS_SQL} SELECT doc_id, role, confidence FROM roles")
def role_assignment(spark, sf_dir):
    name, confidence = K.role()
    return _signals(spark, sf_dir).select("doc_id", name.alias("role"), confidence.alias("confidence"))


@query(f"WITH {_SIGNALS_SQL} SELECT doc_id, modal_axis, review_state, condition > 0 AS condition_trigger_present, sequence > 0 AS procedure_sequence_present, reference > 0 AS reference_present, list > 0 AS structural_list_present FROM roles")
def review_axes(spark, sf_dir):
    r = K.review()
    keep = ("modal_axis", "review_state", "condition_trigger_present", "procedure_sequence_present", "reference_present", "structural_list_present")
    return _signals(spark, sf_dir).select("doc_id", *[r[k].alias(k) for k in keep])


@query(f"""
WITH {_SIGNALS_SQL}, shape AS (SELECT *, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) AS t FROM roles),
gate AS (SELECT CASE WHEN review_state <> 'AXIS_PROFILE_READY' THEN 'BLOCKED_PARENT_REVIEW' WHEN modal_axis = 'NONE' THEN 'BLOCKED_NO_NORMATIVE_MODAL' WHEN prohibition + obligation + permission <> 1 THEN 'BLOCKED_MODAL_MULTIPLICITY'
 WHEN sequence > 0 OR definition > 0 OR modification > 0 OR reference > 0 OR list > 0 THEN 'BLOCKED_COMPLEX_SEMANTIC_AXES' WHEN condition > 1 THEN 'BLOCKED_MULTIPLE_CONDITION_CUES' WHEN doc_id % 10 = 0 THEN 'BLOCKED_REPEATED_VARIANT'
 WHEN len(regexp_extract_all(t || ' ', '[.!?]["''”’)\\]]*\\s')) <> 1 OR NOT regexp_matches(t, '[.!?]["''”’)\\]]*$') THEN 'BLOCKED_SENTENCE_SHAPE' WHEN regexp_matches(t, '[:;]') THEN 'BLOCKED_COMPLEX_DELIMITERS' WHEN regexp_matches(t, '[()\\[\\]]') THEN 'BLOCKED_PARENTHETICAL_SCOPE'
 WHEN condition = 1 THEN 'PILOT_READY_CONDITIONAL_MODAL' ELSE 'PILOT_READY_DIRECT_MODAL' END AS gate FROM shape)
SELECT gate, count(*) AS n FROM gate GROUP BY gate
""")
def readiness_funnel(spark, sf_dir):
    rows = _signals(spark, sf_dir).withColumns(K.review())
    gate = K.readiness(F.expr("doc_id % 10 = 0"), K.shape("text"))
    return rows.groupBy(gate.alias("gate")).agg(F.count("*").alias("n"))


@query("""
SELECT doc_id, array_to_string(list_filter([CASE WHEN regexp_matches(h, '\\bthe\\b') THEN 'EN' END, CASE WHEN regexp_matches(h, '\\bder\\b|\\bdie\\b') THEN 'DE' END, CASE WHEN regexp_matches(h, '\\brights reserved\\b') THEN 'LICENCE' END], lambda x: x IS NOT NULL), '|') AS classes
FROM (SELECT doc_id, lower(array_to_string(list_slice(string_split(text, chr(10)), 1, 35), chr(10))) AS h FROM documents WHERE text IS NOT NULL)
""")
def page_class_labels(spark, sf_dir):
    patterns = {"EN": r"\bthe\b", "DE": r"\bder\b|\bdie\b", "LICENCE": r"\brights reserved\b"}
    docs = table(spark, sf_dir, "documents").filter("text is not null")
    lowered = F.lower(F.translate("text", "\u0130", "i"))  # one letter for one, as in the SQL
    return docs.select("doc_id", F.array_join(K.page_classes(lowered, patterns), "|").alias("classes"))


@query(f"""
WITH {_LINES_SQL}, c AS (SELECT doc_id, line, left(trim(regexp_replace(regexp_replace(text, '[\\p{{C}}•·⋅…]+', ' ', 'g'), '\\s+', ' ', 'g')), 160) AS t FROM lines),
f AS (SELECT *, string_split(t, ' ') AS w, len(regexp_extract_all(t, '\\p{{L}}')) AS letters, len(regexp_extract_all(t, '\\p{{Lu}}')) AS capitals FROM c)
SELECT doc_id, CAST(line AS BIGINT) AS line FROM f WHERE length(t) BETWEEN 3 AND 120 AND NOT regexp_full_match(t, '\\d{{1,3}}') AND len(w) <= 14 AND NOT regexp_matches(t, '[.;,]$') AND letters > 0
 AND (capitals >= 0.72 * letters OR len(list_filter(w, lambda x: regexp_matches(x, '^\\p{{Lu}}'))) >= greatest(1, len(w) - 1) OR regexp_matches(t, '^(?:\\d+|[A-Z])(?:[.)]|\\s)'))
""")
def heading_candidates(spark, sf_dir):
    return _lines(spark, sf_dir).filter(K.heading_candidate("text")).select("doc_id", F.col("line").cast("long").alias("line"))


@query("""
WITH o AS (SELECT lang, source, count(*) AS n, bool_or(n_chars > 20000) AS gap, bool_or(n_chars < 5) AS empty, count(DISTINCT coalesce(sha256(text), '')) AS h FROM documents GROUP BY ALL)
SELECT lang, source, n AS occurrences, CASE WHEN gap THEN 'HEADING_LINE_RECOVERY_GAP' WHEN empty THEN 'EMPTY_BODY_BOUNDARY' WHEN n = 1 THEN 'SINGLE_OCCURRENCE_BOUNDARY' WHEN h = 1 THEN 'REPEATED_OCCURRENCE_BOUNDARIES_IDENTICAL_HASH' ELSE 'REPEATED_OCCURRENCE_BOUNDARIES_VARIANT_HASH' END AS occurrence_class,
 CASE WHEN n > 1 THEN 'REPEATED_OCCURRENCE_PARAGRAPH_VARIANT' ELSE 'SINGLE_OCCURRENCE_PARAGRAPH' END AS paragraph_class FROM o
""")
def occurrence_classes(spark, sf_dir):
    state = F.when(F.col("n_chars") > 20000, "HEADING_LINE_RECOVERY_GAP").when(F.col("n_chars") < 5, "EMPTY_BODY_BOUNDARY").otherwise("RESOLVED")
    rows = table(spark, sf_dir, "documents").select("lang", "source", state.alias("state"), F.sha2("text", 256).alias("body_hash"))
    return K.occurrence_class(rows, ["lang", "source"])


_SENTENCES = ("Units can move", "That unit can fall back", "models can shoot if near and", "Player can dance", "cannot and can not can", "Vehicles can set up", "infantry can be", "can use")
_TOKEN = "'[a-z0-9]+(?:''[a-z0-9]+)?'"


def _listed(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_ACTION_SQL = " ".join(f"WHEN regexp_matches(head, '^(?:{'|'.join(words)}) ') THEN '{name}'" for name, words in K.ACTIONS.items())
_CUE_SQL = ", ".join(f"CASE WHEN list_has_any(tokens, {_listed(words)}) THEN '{name}' END" for name, words in K.CUES.items())


@query(f"""
WITH s AS (SELECT doc_id, list_extract({_listed(_SENTENCES)}, CAST(doc_id % {len(_SENTENCES)} AS INT) + 1) || ' ' || replace(replace(strip_accents(coalesce(text, '')), 'ß', 'ss'), chr(10), ' ') AS t FROM documents),
cut AS (SELECT doc_id, len(regexp_extract_all(t, '(?i)\\bcan\\b')) = 1 AND trim(regexp_extract(t, '(?is)^(.*?)\\bcan\\b', 1)) <> '' AND trim(regexp_extract(t, '(?is)\\bcan\\b(.*)$', 1)) <> '' AS ok,
        regexp_extract_all(lower(regexp_extract(t, '(?is)^(.*?)\\bcan\\b', 1)), {_TOKEN}) AS who, regexp_extract_all(lower(regexp_extract(t, '(?is)\\bcan\\b(.*)$', 1)), {_TOKEN}) AS tokens FROM s),
act AS (SELECT *, CASE {_ACTION_SQL} END AS action FROM (SELECT *, array_to_string(tokens, ' ') || ' ' AS head FROM cut))
SELECT doc_id, CASE WHEN ok AND len(who) = 1 THEN CASE {" ".join(f"WHEN who[1] IN {_listed(words).replace('[', '(').replace(']', ')')} THEN '{name}'" for name, words in K.SUBJECTS.items())} END END AS subject, CASE WHEN ok THEN action END AS action,
       CASE WHEN ok THEN array_to_string(list_sort(list_filter([{_CUE_SQL}, CASE WHEN action IS NULL THEN 'UNRECOGNIZED_ACTION_HEAD' END], lambda x: x IS NOT NULL)), '|') END AS blockers
FROM act
""")
def modal_split(spark, sf_dir):
    """Sentences that begin with a modal clause and go on with a whole text of the table, taken apart at their only `can`."""
    start = F.element_at(F.array(*[F.lit(x) for x in _SENTENCES]), (F.pmod("doc_id", F.lit(len(_SENTENCES))) + 1).cast("int"))
    text = F.replace(F.replace(U.without_marks(F.coalesce("text", F.lit(""))), F.lit("ß"), F.lit("ss")), F.lit("\n"), F.lit(" "))
    parts = table(spark, sf_dir, "documents").select("doc_id", F.concat(start, F.lit(" "), text).alias("text")).withColumn("p", K.split_modal("text"))
    parts = parts.withColumn("tokens", T.canonical_tokens(F.col("p.predicate.text")))
    out = parts.withColumns({"subject": K.subject_type(F.col("p.subject.text")), **K.predicate_type(F.col("p.predicate.text"), F.col("tokens"))})
    return out.select("doc_id", "subject", F.when(F.col("p").isNotNull(), F.col("action_type")).alias("action"), F.when(F.col("p").isNotNull(), F.array_join("blockers", "|")).alias("blockers"))


_FOLDED = "replace(lower(coalesce(text, '')), 'ß', 'ss')"


@query(f"""
SELECT doc_id, sha256(trim(regexp_replace(strip_accents({_FOLDED}), '[^a-z0-9]+', ' ', 'g'))) AS stripped, sha256(trim(regexp_replace(strip_accents({_FOLDED}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))) AS named,
       sha256({_FOLDED}) AS folded, sha256(nfc_normalize({_FOLDED})) AS composed, length(strip_accents(coalesce(text, ''))) AS bare
FROM documents
""")
def unicode_forms(spark, sf_dir):
    """Normal forms of all texts, accented ones among them: case folded, marks dropped, taken apart and put together again."""
    text = F.coalesce("text", F.lit(""))
    sha = lambda c: F.sha2(c, 256)
    return table(spark, sf_dir, "documents").select(
        "doc_id", sha(T.norm_strip(text)).alias("stripped"), sha(T.name_norm(text)).alias("named"), sha(U.casefold(text)).alias("folded"), sha(U.nfkc(U.nfkd(U.casefold(text)))).alias("composed"), F.length(U.without_marks(text)).cast("long").alias("bare")
    )
