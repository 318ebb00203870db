"""A corpus pipeline of five operators; each stage works on all rows that the stage before it kept.

Every stage but the last returns the columns of documents. The stages that choose documents name each row by a key made of all its
columns, so rows that repeat an id, or have none, are judged each for itself; equal rows are told apart by their number.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamgrid.llm import bpe, jaccard, langid, mixing, substring
from loamgrid.sources import paths

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near duplicates share words in runs of five, at a similarity of 0.8 or more.
NEAR = jaccard.Rule(width=5, num=80, den=100)


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language identification: documents whose language is rejected go."""
    docs = docs.select(*COLUMNS)
    return langid.keep_known(docs, langid.fit(langid.training(docs)))


def _keyed(docs: DataFrame) -> DataFrame:
    """The rows with `_key`, a number that only equal rows share; another seed is taken where a second hash shows a clash."""
    nulls = F.concat(*(F.when(F.col(c).isNull(), "0").otherwise("1") for c in COLUMNS))  # hashes pass over nulls
    for seed in itertools.count():
        hashed = lambda s: F.xxhash64(F.lit(s), nulls, *COLUMNS)
        keyed = docs.select(*COLUMNS, hashed(2 * seed).alias("_key"))
        check = docs.select(hashed(2 * seed).alias("_key"), hashed(2 * seed + 1).alias("check")).groupBy("_key").agg(F.min("check").alias("lo"), F.max("check").alias("hi"))
        if check.filter("lo <> hi").isEmpty():
            return keyed
    raise AssertionError


def _nth(key: str) -> Column:
    """The number of a row among its equals, from 1."""
    return F.row_number().over(Window.partitionBy(key).orderBy(key))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of every group of near duplicates the row with the smallest id stays (rows without an id come last). Rows without words all stay."""
    keyed = _keyed(docs)
    found = jaccard.join(keyed.select(F.col("_key").alias("doc_id"), "text"), NEAR).withColumnRenamed("doc_id", "_key")
    named = found.join(keyed.select("_key", F.col("doc_id").alias("id")).distinct(), "_key")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "_key")).alias("first")
    stay = named.groupBy("component_id").agg(first, F.max("n_shingles").alias("n")).select("first._key", "n")
    return keyed.join(stay, "_key").withColumn("_nth", _nth("_key")).filter("n = 0 OR _nth = 1").select(*COLUMNS)


def repeats_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup: passages that an earlier document has are cut out of the texts; every document stays."""
    return substring.kept_texts(docs.select(*COLUMNS))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights: a row comes as often as the mix takes it, once for each pass."""
    keyed = _keyed(docs)
    mixed = mixing.mix(keyed.withColumn("doc_id", F.col("_key")), F.array("source"))
    passes = mixed.filter("passes > 0").groupBy(F.col("doc_id").alias("_key")).agg(F.sort_array(F.collect_list(F.col("passes").cast("int")), asc=False).alias("passes"))
    taken = keyed.join(passes, "_key").withColumn("_nth", _nth("_key")).withColumn("_times", F.get("passes", F.col("_nth") - 1)).filter("_times > 0")
    return taken.withColumn("_pass", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE encoding and decoding: token ids of every text, and the digest of what they decode to."""
    import public_tokenizers

    return bpe.digest(docs, public_tokenizers.path("word_bpe_49k.json"), ["lang", "source"], ids_too=True)


STAGES = [
    ("language_id", known_languages),
    ("ngram_jaccard_join", one_of_each_group),
    ("suffix_array_dedup", repeats_removed),
    ("mixing", mixed_sources),
    ("bpe", encoded),
]

#: Learned centroids and vocabulary merges have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written as Parquet to the shared folder before the next one reads it.

    A stage's folder goes once the next one is written, the last one's once the result is kept as a checkpoint.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = paths.new_folder(spark, "pipeline")
    before = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            paths.delete(spark, f"{folder}/{before}")
        before = name
    return paths.read_and_removed(STAGES[-1][1](spark, docs, sf_dir), folder)
