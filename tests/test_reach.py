"""Closure by doubling, components of cycles and the reachability index against plain searches."""

import random

import pytest
from pyspark.sql import functions as F

from labelgraph.operators import cycles as C
from labelgraph.operators import graph as G
from labelgraph.operators import predictions as P
from labelgraph.operators import reach as R


def links(spark, edges):
    return spark.createDataFrame(edges, "child string, parent string")


def depths(edges):
    """{(child, ancestor): least depth} by breadth-first search."""
    up = {}
    for c, p in edges:
        up.setdefault(c, set()).add(p)
    out = {}
    for start in up:
        level, d = {start}, 0
        while level:
            d += 1
            level = {p for c in level for p in up.get(c, ()) if (start, p) not in out}
            out.update({(start, p): d for p in level})
    return out


def brute_cycles(edges):
    far = depths(edges)
    out = {}
    for a, b in far:
        if (b, a) in far:
            out.setdefault(a, set()).add(b)
    return sorted((a, min(bs), len(bs)) for a, bs in out.items())


def random_graph(rng, n, m, acyclic):
    out = []
    for _ in range(m):
        a, b = rng.randrange(n), rng.randrange(n)
        out.append((f"n{max(a, b)}", f"n{min(a, b)}") if acyclic else (f"n{a}", f"n{b}"))
    return [e for e in out if not acyclic or e[0] != e[1]]


@pytest.mark.parametrize("seed", [0, 1])
def test_closure_has_least_depths(spark, seed):
    rng = random.Random(seed)
    edges = random_graph(rng, 25, 40, acyclic=seed % 2 == 0) + [(f"c{i}", f"c{i + 1}") for i in range(13)]
    want = depths(edges)
    df = links(spark, edges + edges[:3])
    assert {(r.child, r.ancestor): r.depth for r in G.closure(df).collect()} == want
    got = {(r.child, r.ancestor): r.depth for r in G.closure(df, max_depth=5).collect()}
    assert got == {k: d for k, d in want.items() if d <= 5}


def test_closure_of_a_deep_chain_takes_few_rounds(spark, monkeypatch):
    rounds = []
    keep = G.cut_lineage
    monkeypatch.setattr(G, "cut_lineage", lambda df, *a: rounds.append(1) or keep(df, *a))
    n = 1500
    chain = spark.range(n).select(F.col("id").alias("child"), (F.col("id") + 1).alias("parent"))
    c = G.closure(chain)
    assert c.count() == n * (n + 1) // 2
    assert c.where("ancestor - child <> depth").isEmpty()
    assert len(rounds) <= 13  # 2 + log2(1500)


@pytest.mark.parametrize("seed", [1, 3])
def test_cycles_and_condensed_closure(spark, seed):
    rng = random.Random(seed)
    edges = random_graph(rng, 30, (20, 30, 40, 70)[seed], acyclic=False)
    edges += [(f"r{i}", f"r{(i + 1) % 12}") for i in range(12)] + [("r3", "n1"), ("n2", "r5"), ("s", "s"), ("r1", "r1"), ("t", "s"), (None, "x"), ("x", None)]
    df = links(spark, edges)
    whole = [e for e in edges if None not in e]
    cyclic = C.strongly_connected(df)
    assert sorted(tuple(r) for r in cyclic.collect()) == brute_cycles(whole)
    assert sorted(tuple(r) for r in C.ancestors(links(spark, whole), cyclic).collect()) == sorted(depths(whole))


def test_no_cycles_no_rows(spark):
    assert C.strongly_connected(links(spark, [("a", "b"), ("b", "c"), ("a", "c")])).count() == 0
    assert C.strongly_connected(links(spark, [])).count() == 0


def below(index):
    nodes = {r.node: (r.pre, r.last) for r in index.nodes.collect()}
    extra = {}
    for r in index.extra.collect():
        extra.setdefault(r.node, []).append((r.lo, r.hi))
    out = set()
    for a, (pre, last) in nodes.items():
        for d, (at, _) in nodes.items():
            if pre < at <= last or any(lo <= at <= hi for lo, hi in extra.get(a, ())):
                out.add((d, a))
    return out


@pytest.mark.parametrize("seed", [1, 4])
def test_index_equals_closure(spark, seed):
    rng = random.Random(seed)
    edges = random_graph(rng, 40, (30, 45, 60, 90, 50)[seed], acyclic=seed < 4)
    far = set(depths(edges))
    want = {(d, a) for d, a in far if (a, d) not in far and a != d}
    assert below(R.reach_index(links(spark, edges))) == want


def test_index_of_a_chain_and_a_star(spark):
    chain = [(f"k{i:03d}", f"k{i + 1:03d}") for i in range(70)]
    star = [(f"leaf{i}", "hub") for i in range(90)]
    index = R.reach_index(links(spark, chain + star))
    assert index.extra.count() == 0
    assert below(index) == set(depths(chain + star))
    empty = R.reach_index(links(spark, []))
    assert empty.nodes.count() == 0 and empty.extra.count() == 0


@pytest.mark.parametrize("seed", [0, 2])
def test_prune_equals_closure_version(spark, seed):
    rng = random.Random(seed)
    edges = [("Area|" + c, "Area|" + p) for c, p in random_graph(rng, 30, 45, acyclic=seed < 2)]
    edges += [("Scope|" + c, "Scope|" + p) for c, p in random_graph(rng, 12, 14, acyclic=True)]
    df = links(spark, edges)
    rows = [(s, rng.choice(["Area", "Scope"]), f"n{rng.randrange(35)}", i) for s in range(25) for i in range(rng.randint(0, 9))]
    rows += [(99, "Area", f"n{i % 30}", i) for i in range(400)] + [(7, None, "n1", 0), (7, "Area", None, 1), (None, "Area", "n2", 1), (None, "Area", "n3", 2)]
    labels = spark.createDataFrame(rows, "sample_id int, dim string, term string, pos int")
    c = G.closure(df)
    names = c.select(F.substring_index("child", "|", 1).alias("dim"), F.substring_index("child", "|", -1).alias("child"), F.substring_index("ancestor", "|", -1).alias("ancestor"))
    got = sorted(map(str, map(tuple, R.prune_covered(labels, R.reach_index(df)).collect())))
    want = sorted(map(str, map(tuple, P.prune_ancestors(labels.where("dim is not null and term is not null and sample_id is not null"), names).collect())))
    strange = [r for r in got if "None" in r]
    assert [r for r in got if "None" not in r] == want
    assert "(7, None, 'n1', 0)" in strange and "(7, 'Area', None, 1)" in strange


def test_leaves_of_the_same_parents_are_one_exception(spark):
    """Every third of 300 leaves is below two hubs: one interval, not a row for each, so a label of a hub stays few rows."""
    edges = [(f"x{i:03d}", "hub") for i in range(300)] + [(f"x{i:03d}", "second") for i in range(0, 300, 3)] + [("second", "top"), ("x001", "y"), ("x004", "y")]
    index = R.reach_index(links(spark, edges))
    assert below(index) == set(depths(edges))
    assert index.extra.count() <= 4
    labels = spark.createDataFrame([(s, "Area", t, i) for s in range(50) for i, t in enumerate(("top", "second", "hub", f"x{s:03d}"))], "sample_id int, dim string, term string, pos int")
    named = R.ReachIndex(*(t.withColumn("node", F.concat(F.lit("Area|"), "node")) for t in index))
    kept = sorted((r.sample_id, r.term) for r in R.prune_covered(labels, named).collect())
    want = [(s, f"x{s:03d}") for s in range(50)] + [(s, "second") for s in range(50) if s % 3]
    assert kept == sorted(want)


def test_the_tour_visits_what_has_children(spark, monkeypatch):
    arcs = []
    keep = R._rank
    monkeypatch.setattr(R, "_rank", lambda a, n: arcs.append(n) or keep(a, n))
    R.reach_index(links(spark, [(f"leaf{i}", f"hub{i % 3}") for i in range(60)]))
    assert arcs == [8]  # three hubs and the root, entered and left


def test_pruning_deals_labels_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(R, "LABELS_PER_TASK", 100)
    index = R.reach_index(links(spark, [("Area|b", "Area|a")]))
    labels = spark.range(4000).select(F.col("id").alias("sample_id"), F.lit("Area").alias("dim"), F.lit("a").alias("term"), F.lit(0).alias("pos"))
    got = R.prune_covered(labels, index)
    assert "hashpartitioning(sample_id" in (plan := got._jdf.queryExecution().executedPlan().toString()) and ", 40)" in plan
    assert got.count() == 4000
