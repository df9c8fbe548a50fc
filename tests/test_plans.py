"""Plan-shape checks: the properties the scale design relies on, read from executed plans."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from labelgraph.operators.sequence import sequence_number
from labelgraph.plans.catalog import QUERIES
from labelgraph.plans.fixtures import fixture


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cross_or_nested_loop_join(spark, key):
    p = plan_of(E.queries()[key](spark, SF_SMALL))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_sequence_offsets_broadcast_not_shuffled(spark):
    df = spark.range(0, 10_000).withColumn("k", F.col("id") * 7 % 10_007)
    out = sequence_number(df, ["k"], num_partitions=8)
    out.write.format("noop").mode("overwrite").save()
    p = plan_of(out)
    assert "BroadcastHashJoin" in p
    assert "SortMergeJoin" not in p


def test_triples_stored_partitioned_by_predicate(spark):
    t = fixture(spark, SF_SMALL, "fx_triples")
    p = t.where(F.col("p") == "isDefinedBy")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in p and "isDefinedBy" in p


def test_projection_pruned_at_scan(spark):
    from labelgraph.plans.fixtures import register_tables

    d = register_tables(spark, SF_SMALL)["documents"]
    p = plan_of(d.select("doc_id", "source").where(F.col("doc_id") > 5))
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in p
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThan(doc_id,5)]" in p
