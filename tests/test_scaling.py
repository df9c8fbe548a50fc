"""Steps that must not grow with what a query does not use, or with one long group."""

import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from labelgraph.operators import batch as B
from labelgraph.operators import graph as G
from labelgraph.operators import predictions as P
from labelgraph.operators import reach as R
from labelgraph.operators import sequence as Q
from labelgraph.plans import fixtures as FX
from labelgraph.plans.catalog import QUERIES
from labelgraph.streaming import ingest as I


def labels(spark):
    rows = [(1, "Area", "a", 0), (1, "Area", "b", 1), (1, "Area", "a", 2), (2, "Area", "x", 0), (2, None, "a", 1), (3, "Scope", None, 0), (3, "Scope", "a", 1), (None, "Area", "a", 0)]
    return spark.createDataFrame(rows, "sample_id long, dim string, term string, pos int")


def test_only_terms_in_use_are_joined(spark):
    vocab = spark.createDataFrame([("a", "Area"), ("b", "Area")] + [(f"unused {i}", "Area") for i in range(500)], "term string, dim string")
    assert sorted(r.term for r in G.occurring(vocab, labels(spark), "term").collect()) == ["a", "b"]
    wrong = [(r.sample_id, r.dim, r.term) for r in P.wrong_dimension(labels(spark), vocab).collect()]
    assert sorted(wrong) == [(2, None, "a"), (3, "Scope", "a")]
    unknown = [(r.sample_id, r.term) for r in P.unknown_terms(labels(spark), vocab).collect()]
    assert sorted(unknown) == [(2, "x"), (3, None)]


def test_pruning_shuffles_labels_once_and_keeps_samples(spark):
    edges = spark.createDataFrame([("Area|b", "Area|a"), ("Area|c", "Area|b")], "child string, parent string")
    stored = labels(spark)
    index = R.reach_index(edges)
    marked = R.prune_covered(stored, index, drop=False)
    kept = sorted(map(tuple, R.prune_covered(stored, index).collect()), key=str)
    assert kept == sorted((tuple(r)[:4] for r in marked.where("not covered").collect()), key=str)
    assert [(r.sample_id, r.term) for r in marked.where("covered").collect()] == [(1, "a")]
    assert marked.select("sample_id").distinct().count() == 4
    plan = marked.groupBy("sample_id").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_labels_are_dealt_out_before_they_are_merged(spark):
    got = P.dedupe(labels(spark))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "HashAggregate" not in plan.split("Exchange hashpartitioning")[1]  # no map of a whole split's labels
    kept = [(1, "Area", "a", 0), (1, "Area", "b", 1), (2, "Area", "x", 0), (2, None, "a", 1), (3, "Scope", None, 0), (3, "Scope", "a", 1), (None, "Area", "a", 0)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(kept, key=str)


def test_dedupe_reads_its_labels_without_storing_them(spark, tmp_path, monkeypatch):
    tables = {
        "region": ("r_regionkey int, r_name string", [(0, "NORTH SIDE")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "N0", 0)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int", [(1, "S#1", 0), (1, "S#1", 0), (2, None, None)]),
        "customer": ("c_custkey long, c_mktsegment string", [(5, "SEG")]),
        "part": ("p_partkey long, p_brand string, p_type string", [(7, "B#1", "T")]),
        "orders": ("o_orderkey long, o_custkey long", [(10, 5), (31, 5)]),
        "lineitem": (
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int",
            [(10, 7, 1, 2), (10, 7, 1, 1), (10, 7, 1, 2), (None, 7, 2, 3), (11, None, 1, 6)],
        ),
    }
    for t, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{t}.parquet")
    monkeypatch.setattr(FX, "TABLES", tuple(tables))
    monkeypatch.setattr("labelgraph.session.scratch_path", lambda *a: pytest.fail("stored to be read once"))
    want = [
        (10, "Area", "S_1", 1), (10, "Area", "N0", 102), (10, "Area", "NORTH_SIDE", 201), (10, "Scope", "B_1", 1), (10, "Ability", "SEG", 1),
        (11, "Area", "S_1", 6), (11, "Area", "N0", 106), (31, "Ability", "ASIA", 1),
        (None, "Area", None, 3), (None, "Scope", "B_1", 3), (None, "Scope", "T", 103),
    ]
    assert sorted(map(tuple, QUERIES["pred_dedupe"](spark, str(tmp_path)).collect()), key=str) == sorted(want, key=str)


def test_ranges_follow_bytes(spark, monkeypatch):
    df = spark.createDataFrame([("g", i, "x" * 100) for i in range(200)], "g string, i int, text string")
    monkeypatch.setattr(Q, "BYTES_PER_PARTITION", 2000)
    asked = []
    plain = type(df).repartitionByRange
    monkeypatch.setattr(type(df), "repartitionByRange", lambda self, n, *k: asked.append(n) or plain(self, n, *k))
    out = Q.sequence_number(df, ["i"], group_cols=["g"], col="k").collect()
    assert sorted((r.i, r.k) for r in out) == [(i, i) for i in range(200)] and asked == [11]


def test_words_of_one_text_at_a_time(monkeypatch):
    monkeypatch.setattr(pd.Series.str, "split", lambda *a, **k: pytest.fail("all words of a batch are held"))
    got = B.python_token_counts(pd.DataFrame({"doc_id": [1, 2, 3], "text": ["a  b\tc", None, " "]}))
    assert got.n_tokens.tolist() == [3, 0, 0]


def test_an_image_alone_gives_no_frame():
    class State:
        hasTimedOut, exists, value = False, False, None

        def update(self, value):
            self.value = value

    state = State()
    cols = ["meta_path", "pos", "image", "labels_json", "reason"]
    image = pd.DataFrame([(None,) * 5], columns=cols)
    assert list(I._match(None)(("k", 0), iter([image]), state)) == [] and state.value == (True, [])
    both = pd.DataFrame([("m", 0, "i", "{}", None), ("n", None, None, None, "bad_json"), (None,) * 5], columns=cols)
    (out,) = I._match(None)(("k", 0), iter([both]), State())
    assert out.values.tolist() == [["n", None, None, None, "bad_json"], ["m", 0, "i", "{}", "accepted"]]


def test_stored_steps_leave_no_shuffle_files(spark):
    from labelgraph.session import SHUFFLE_CLEANUP_CONF, cut_lineage

    files = spark._jsc.sc().env().blockManager().diskBlockManager()

    def shuffles():
        return sum(f.getName().startswith("shuffle_") for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(files.getAllFiles()))

    before, conf = shuffles(), spark.conf.get(SHUFFLE_CLEANUP_CONF)
    kept = cut_lineage(spark.range(5000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count(), "freed")
    for _ in range(50):  # files go in the background
        if shuffles() <= before:
            break
        time.sleep(0.2)
    assert shuffles() <= before
    assert kept.count() == 7
    assert spark.conf.get(SHUFFLE_CLEANUP_CONF) == conf


def test_vocabulary_and_hierarchy_do_not_store_the_texts(spark, tmp_path):
    from labelgraph.plans import q_graph, q_predictions
    from labelgraph.session import scratch_path

    os.symlink("/root/testdata/sf0.001", sf := str(tmp_path / "sf"))  # a folder of its own: nothing of it is stored yet
    root = os.path.dirname(scratch_path(spark, "x")).removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    assert q_predictions.vocab(spark, sf).count() > 0 and q_graph._named_edges(spark, sf).count() > 0
    new = (set(os.listdir(root)) if os.path.isdir(root) else set()) - before
    assert not [f for f in new if f.startswith("fx_triples")]
    # what a query before has stored is read
    FX.fixture(spark, sf, "fx_triples")
    assert FX.fixture(spark, sf, "fx_triples", store=False) is FX.fixture(spark, sf, "fx_triples")
