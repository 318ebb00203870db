"""Findings of round three."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

from loamgrid import session
from loamgrid.operators import nested
from loamgrid.plans.registry import ORACLES, QUERIES


@pytest.mark.parametrize(("text", "classes"), [("| die\u00f6lic", "DE"), ("the\u0301 e", "EN"), ("\u00fcthe\u00df r\u0130ghts RESERVED", "EN|LICENCE"), ("der\u212a the_ D\u0130E", "DE"), ("der\u212a derx", ""), (None, None)])
def test_page_classes_end_words_as_the_sql_does(spark, tmp_path, text, classes):
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [r["classes"] for r in QUERIES["page_class_labels"](spark, str(tmp_path)).collect()]
    duck = duckdb.connect()
    duck.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert got == [r[1] for r in duck.sql(ORACLES["page_class_labels"]).fetchall()] == ([] if classes is None else [classes])


def _deep(depth, leaf):
    text = leaf
    for i in range(depth):
        text = '{"in":%s}' % text if i % 2 else "[%s]" % text
    return text


def test_walks_read_their_source_once_and_reach_any_depth(spark, monkeypatch):
    leaf = '{"type":"UNIT","name":"Deep \\u0041","costs":[{"name":"pts","value":7}],"profiles":[{"typeName":"Unit","name":"P"}]}'
    df = spark.createDataFrame([(1, leaf, "deep a"), (2, _deep(7, leaf), "deep b"), (3, _deep(23, leaf), "deep a"), (4, "{", "x"), (None, leaf, "deep a")], "k long, doc string, wanted string")
    cuts, cut = [], nested.cut
    monkeypatch.setattr(nested, "cut", lambda d: cuts.append(1) or cut(d))
    shallow = df.filter("k < 3")
    assert {tuple(r) for r in nested.typed_names(shallow, "k", "doc", "unit").collect()} == {(1, "Deep A"), (2, "Deep A")}
    assert {r["k"] for r in nested.holding(shallow, "k", "doc", F.col("wanted")).collect()} == {1}
    assert len(cuts) == 2
    assert {tuple(r) for r in nested.typed_names(df, "k", "doc", "unit").collect()} == {(1, "Deep A"), (2, "Deep A"), (3, "Deep A"), (None, "Deep A")}
    assert {r["k"] for r in nested.holding(df, "k", "doc", F.col("wanted")).collect()} == {1, 3, None}
    assert {(r["k"], r["cost"]) for r in nested.named_costs(df, "k", "doc", F.lit("DEEP A"), "pts").collect()} == {(1, 7), (2, 7), (3, 7), (None, 7)}
    assert sorted((r["k"] or 0, r["name"]) for r in nested.profiles(df, "k", "doc").collect()) == [(0, "P"), (1, "P"), (2, "P"), (3, "P")]


def test_summaries_of_documents_that_share_a_key(spark):
    df = spark.createDataFrame([(1, '{"id":"a","profiles":[{"typeName":"Unit","name":"P"}]}'), (1, '{"id":"b"}'), (2, '{"id":"c","profiles":[{"typeName":"Odd"}]}'), (None, '{"id":"d","profiles":[{"typeName":"Unit"}]}')], "k long, doc string")
    got = {r["id"]: r["unit_profiles"] and [p["name"] for p in r["unit_profiles"]] for r in nested.entry_summaries(df, "k", "doc").collect()}
    assert got == {"a": ["P"], "b": ["P"], "c": None, "d": None}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rules_go_to_the_rows_of_unknown_constraints(spark, data):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the rows are many
    try:
        assert "SortMergeJoin" not in _plan(QUERIES["unknown_constraints"](spark, data))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rules_go_to_the_rows_of_rosters(spark, data):
    joins = re.findall(r"SortMergeJoin \[(\w+?)#", _plan(QUERIES["roster_evaluation"](spark, data)))
    assert not {"unit", "detachment", "leader", "item"} & set(joins)


def test_hashes_are_shuffled_once(spark, data):
    plan = _plan(QUERIES["stored_hashes"](spark, data))
    assert plan.count("Exchange hashpartitioning(identity") == 1 and "hashpartitioning(kind" not in plan


def test_documents_of_a_promotion_are_parsed_once_and_by_several_tasks(spark, data):
    df = QUERIES["promotion_refusals"](spark, data)
    assert len(re.findall("parse_json|parseJson", df._jdf.queryExecution().optimizedPlan().toString())) <= 8
    assert df.rdd.getNumPartitions() >= 4


def test_watch_reports_are_read_by_several_tasks(spark, data):
    assert QUERIES["reingestion_plans"](spark, data).rdd.getNumPartitions() >= 4


@pytest.mark.parametrize("keys", [2000, 3])
def test_composite_keys_are_dealt_by_the_size_of_the_table(spark, tmp_path, monkeypatch, keys):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    rows = [(3 * (i % keys) if i % 7 else None, i % 5, float(i % 11)) for i in range(4000)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    made = QUERIES["composite_key_mismatch"](spark, str(tmp_path))
    got = made.withColumn("task", F.spark_partition_id()).collect()
    duck = duckdb.connect()
    duck.sql(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
    assert sorted(tuple(r)[:4] for r in got) == sorted(duck.sql(ORACLES["composite_key_mismatch"]).fetchall())
    assert len({r["task"] for r in got}) > (20 if keys > 3 else 4)  # one task joined all before
