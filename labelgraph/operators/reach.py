"""Reachability index of a hierarchy (PV-08, JN-08): who is below whom, without the closure.

Every node gets an interval of positions on a tour of a spanning forest: the positions between
entering and leaving it. A node is below another in the forest when its entry lies in the other's
interval. Edges outside the forest give their parent, and all that are above it, the child's interval
as an exception. So the index is one row for each node and one for each exception, not one for each
pair, and "is any of these below that one" is a comparison with the next entry in order.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelgraph.operators.cycles import condense, strongly_connected
from labelgraph.operators.graph import broadcast_if_small, occurring
from labelgraph.operators.sequence import sequence_number
from labelgraph.session import cut_lineage

#: Steps of the tour that one round of the ranking takes at once.
JUMPS = 4
#: Labels that one task of the pruning holds, about: they are merged, sorted and grouped in it.
LABELS_PER_TASK = 400_000


class ReachIndex(NamedTuple):
    """``nodes(node, pre, last)`` and ``extra(node, lo, hi)``: below a node are the nodes whose
    ``pre`` lies in ``(pre, last]`` or in one of its extra intervals ``[lo, hi]``."""

    nodes: DataFrame
    extra: DataFrame


def _rank(arcs: DataFrame, n: int) -> DataFrame:
    """(a, behind): the weight of each arc and all that come after it, by jumping along ``(a, next, behind)``,
    where ``behind`` is an arc's own weight; every round multiplies the reach, so a tour of any shape takes a
    logarithmic number of rounds. ``n`` arcs."""
    state = cut_lineage(arcs, "reach-tour")
    reach = 1
    while reach < n:
        out = state
        for _ in range(JUMPS - 1):
            far = state.select(F.col("a").alias("next"), F.col("next").alias("after"), F.col("behind").alias("more"))
            out = out.join(far, "next", "left").select("a", F.col("after").alias("next"), (F.col("behind") + F.coalesce("more", F.lit(0))).alias("behind"))
        state = cut_lineage(out, "reach-tour")
        reach *= JUMPS
    return state.select("a", "behind")


def reach_index(edges: DataFrame) -> ReachIndex:
    """Index of ``edges(child, parent)``; nodes of a cycle share one interval, so none is below
    another. The tables are stored in the shared folder; build them once for a hierarchy."""
    e = cut_lineage(edges.select("child", "parent").where("child is not null and parent is not null").distinct(), "reach-edges")
    cyclic = strongly_connected(e)
    dag = cut_lineage(condense(e, cyclic), "reach-dag")
    every = e.select(F.col("child").alias("node")).union(e.select("parent")).distinct().join(cyclic.select("node", "component"), "node", "left")
    every = cut_lineage(every.select("node", F.coalesce("component", "node").alias("rep")), "reach-nodes")
    reps = sequence_number(every.select("rep").distinct(), ["rep"], col="id")
    reps = cut_lineage(reps, "reach-ids")
    n = reps.count()

    def numbered(df: DataFrame, c: str, out: str) -> DataFrame:
        return df.join(reps.select(F.col("rep").alias(c), F.col("id").alias(out)), c).drop(c)

    links = cut_lineage(numbered(numbered(dag, "child", "c"), "parent", "p"), "reach-links")
    # a spanning forest under one root (-1); children of any number are ranked without one task
    tree = links.groupBy("c").agg(F.min("p").alias("p"))
    kids = reps.select(F.col("id").alias("c")).join(tree, "c", "left").select("c", F.coalesce("p", F.lit(-1)).alias("p"))
    kids = kids.join(tree.select(F.col("p").alias("c")).distinct().withColumn("leaf", F.lit(False)), "c", "left")
    # leaves of the same parents stand together: nothing tells them apart, so they are one exception
    bits = [F.bit_xor(F.xxhash64("p", F.lit(i))).cast("string") for i in (0, 1)]
    same = links.groupBy("c").agg(F.concat_ws(" ", F.count(F.lit(1)).cast("string"), *bits).alias("parents"))
    kids = kids.fillna(True, ["leaf"]).join(same, "c", "left").withColumn("parents", F.when(F.col("leaf"), F.coalesce("parents", F.lit(""))).otherwise(""))
    kids = cut_lineage(sequence_number(kids, ["parents", "c"], group_cols=["p", "leaf"], col="k"), "reach-kids")
    # the tour visits what has children: entering c is arc 2c and counts c and its leaves, which stand
    # behind it in order; leaving c is arc 2c + 1 and counts nothing
    inner, leaves = kids.where("not leaf").select("c", "p", "k"), kids.where("leaf").select("c", "p", "k", "parents")
    root = reps.groupBy().agg(F.lit(-1).cast("long").alias("c"), F.lit(None).cast("long").alias("p"), F.lit(0).cast("long").alias("k"))
    visited = cut_lineage(inner.unionByName(root), "reach-inner")
    first = inner.where("k = 0").select(F.col("p").alias("c"), F.col("c").alias("first"))
    held = leaves.groupBy(F.col("p").alias("c")).agg(F.count(F.lit(1)).alias("held"))
    enter = visited.select("c").join(first, "c", "left").join(held, "c", "left").select(
        (2 * F.col("c")).alias("a"), F.coalesce(2 * F.col("first"), 2 * F.col("c") + 1).alias("next"), (1 + F.coalesce("held", F.lit(0))).cast("long").alias("behind")
    )
    sibling = inner.select("p", (F.col("k") - 1).alias("k"), F.col("c").alias("s"))
    leave = visited.join(sibling, ["p", "k"], "left").select(
        (2 * F.col("c") + 1).alias("a"), F.coalesce(2 * F.col("s"), 2 * F.col("p") + 1).alias("next"), F.lit(0).cast("long").alias("behind")
    )
    ranked = _rank(enter.unionByName(leave), 2 * visited.count())
    at = F.lit(n + 1) - F.col("behind")  # the root has an entry too
    spans = ranked.groupBy(F.floor(F.col("a") / 2).alias("c")).agg(F.min(at).alias("pre"), (F.max(at) - 1).alias("last"))
    at = F.col("pre") + 1 + F.col("k")
    ends = leaves.join(spans.select(F.col("c").alias("p"), "pre"), "p").select("c", at.alias("pre"), at.alias("last"))
    spans = cut_lineage(spans.where("c >= 0").unionByName(ends), "reach-spans")
    # exceptions: intervals of children outside the forest, handed up until they are covered
    own = spans.select(F.col("c").alias("p"), "pre", "last")

    def uncovered(df: DataFrame) -> DataFrame:
        return df.join(own, "p").where("not (pre <= lo and hi <= last)").select("p", "lo", "hi").distinct()

    other = links.join(tree, ["c", "p"], "left_anti").join(spans, "c").select("c", "p", F.col("pre").alias("lo"), F.col("last").alias("hi"))
    single = other.join(inner.select("c"), "c", "left_semi").select("p", "lo", "hi")
    beside = other.join(leaves.select("c", F.col("p").alias("under"), "parents"), "c").groupBy("p", "under", "parents")
    beside = beside.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count(F.lit(1)).alias("held"))
    whole = F.when(F.col("hi") - F.col("lo") + 1 == F.col("held"), F.col("lo")).otherwise(F.raise_error(F.lit("different parents share a digest")).cast("long"))
    frontier = cut_lineage(uncovered(single.unionByName(beside.select("p", whole.alias("lo"), "hi"))), "reach-extra")
    extra = frontier
    while not frontier.isEmpty():
        up = frontier.select(F.col("p").alias("c"), "lo", "hi").join(links, "c").select("p", "lo", "hi")
        frontier = cut_lineage(uncovered(up).join(extra, ["p", "lo", "hi"], "left_anti"), "reach-extra")
        extra = extra.unionByName(frontier)
    ids = every.join(reps, "rep").select("node", F.col("id").alias("c"))
    nodes = cut_lineage(ids.join(spans, "c").select("node", "pre", "last"), "reach-index")
    extra = cut_lineage(ids.join(extra.withColumnRenamed("p", "c"), "c").select("node", "lo", "hi"), "reach-index-extra")
    return ReachIndex(nodes, extra)


def terms_in_use(labels: DataFrame) -> DataFrame:
    """``(term, n)`` of the labels, stored: what a vocabulary is cut to, and how many labels there are."""
    return cut_lineage(labels.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "terms-in-use")


def prune_covered(labels: DataFrame, index: ReachIndex, drop: bool = True, used: DataFrame | None = None) -> DataFrame:
    """Drop a term when a term below it is in the same (sample, dim) list; also dedupes (first
    position kept). Nodes of ``index`` are ``dim|term``; terms it doesn't know stay. Without ``drop`` covered
    rows stay too, told apart by a column ``covered``. ``used`` is :func:`terms_in_use` of the labels if there already.

    Distinct labels of a list stand in order of their entries, so a group holds no more rows than
    its dimension has terms, whatever the sample's size. A term is covered when the next entry after
    its own is in its interval; an extra interval asks the same from a row at its lower end. Labels are
    shuffled once, by sample: all that follows here, and a grouping by sample after it, finds them in place. As it
    all happens in one task, tasks are as many as keep the labels of one in memory.
    """
    used = terms_in_use(labels) if used is None else used
    tasks = -(-(used.agg(F.sum("n")).first()[0] or 0) // LABELS_PER_TASK)
    parts = int(labels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    term = F.split(F.col("node"), r"\|", 2)
    key = [F.col("node"), term[0].alias("dim"), term[1].alias("term")]
    marks = index.nodes.select(*key, F.col("pre").alias("at"), F.col("pre").alias("mark"), F.col("last").alias("end"))
    # every node of an extra interval is in ``nodes`` as well
    marks = marks.unionByName(index.extra.select(*key, (F.col("lo") - 1).alias("at"), F.lit(None).cast("long").alias("mark"), F.col("hi").alias("end")))
    marks = broadcast_if_small(occurring(marks.drop("node"), used, "term"))
    dealt = labels.repartition(max(tasks, parts), "sample_id") if tasks > 1 else labels.repartition("sample_id")
    own = dealt.groupBy("sample_id", "dim", "term").agg(F.min("pos").alias("pos"))
    rows = own.join(marks, ["dim", "term"], "left")
    after = Window.partitionBy("sample_id", "dim").orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, -1)
    flagged = rows.withColumn("covered", F.coalesce(F.min("mark").over(after) <= F.col("end"), F.lit(False)))
    out = flagged.groupBy("sample_id", "dim", "term").agg(F.min("pos").alias("pos"), F.max("covered").alias("covered"))
    out = out.select("sample_id", "dim", "term", "pos", "covered")
    return out.where(~F.col("covered")).drop("covered") if drop else out
