"""List values as segments: hubs spread over tasks, order, repeats, and the value put together."""

import random

from pyspark.sql import functions as F

from labelgraph.operators import ontology as O
from labelgraph.operators import qa as Q
from labelgraph.operators import segments as SG

V = O.Vocab.bare()
SCHEMA = "s string, p string, o string, o_kind string, pos int"


def test_a_hub_is_spread_and_keeps_its_order(spark, monkeypatch):
    from labelgraph.operators import sequence

    rng = random.Random(4)
    rows = [("hub" if i % 3 == 0 else f"g{i % 41}", rng.randrange(2_000), f"x{i}") for i in range(6_000)]
    df = spark.createDataFrame(rows, "g string, k int, v string").repartition(6)
    real, stored, frames = sequence.sequence_number, sequence.cut_lineage, []

    def kept(frame, name):
        frames.append(stored(frame, name))
        return frames[-1]

    monkeypatch.setattr(sequence, "cut_lineage", kept)
    monkeypatch.setattr(SG, "sequence_number", lambda *args, **kw: real(*args, **kw, rows_per_partition=500))
    segs = SG.list_segments(df, "g", ["k", "v"], F.col("v"), "|", size=100)
    got = {(r.g, r.segment): (r.n, r.text.split("|")) for r in segs.collect()}
    ranged = next(f for f in frames if "_seq_idx" in f.columns)
    assert ranged.where("_group = 'hub'").select("_seq_pid").distinct().count() >= 3  # a third of twelve ranges, not one
    for g in {r[0] for r in rows}:
        want = [v for _, v in sorted((k, v) for h, k, v in rows if h == g)]
        own = [got[g, i] for i in range(-(-len(want) // 100))]
        assert [v for _, part in own for v in part] == want
        assert all(n == 100 for n, _ in own[:-1]) and sum(n for n, _ in own) == len(want)
    assert len(got) == 20 + 41
    whole = {r.g: (r.n, r.text) for r in SG.put_together(segs, "g", "|").collect()}
    assert whole["hub"] == (2_000, "|".join(v for _, v in sorted((k, v) for h, k, v in rows if h == "hub")))


def test_nulls_repeats_and_empty(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("a", 0, None), ("a", 2, ""), (None, 1, "y")], "g string, k int, v string")
    got = {(r.g, r.segment, r.n, r.text) for r in SG.list_segments(df, "g", ["k"], F.col("v"), ",", size=2).collect()}
    assert got == {("a", 0, 2, "x,x"), ("a", 1, 1, "")}
    assert SG.list_segments(df.limit(0), "g", ["k"], F.col("v"), ",").count() == 0


def test_qa_from_segments_equals_the_lists(spark):
    rng = random.Random(6)
    rows = [(f"urn:c#p{i}", "type", V.dim_classes[i % 3], "iri", 0) for i in range(10)]
    rows += [(f'urn:c#é"{rng.randrange(200)}', V.part_of[rng.randrange(3)], f"urn:c#p{rng.randrange(14)}", "iri", 0) for _ in range(400)]
    t = spark.createDataFrame(rows, SCHEMA)
    for size in (1, 7, 1_000):
        got = sorted(map(tuple, SG.qa_parent_children(t, V, size=size).collect()))
        assert got == sorted(map(tuple, Q.qa_parent_children(t, V).collect())) and len(got) == 10
