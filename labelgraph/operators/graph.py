"""Graph operators over the triple table (GR-01..08).

The closure doubles paths: each round joins the pairs of the greatest depth with all known pairs,
removes pairs already known with an anti join, and writes the result to the shared checkpoint
folder, so lineage stays one round deep. The driver loops over powers of two of the depth, never
over rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelgraph.session import cut_lineage

MAX_BYTES_FOR_BROADCAST = 32 << 20


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BYTES_FOR_BROADCAST) -> DataFrame:
    """Broadcast hint only after measuring the rows' bytes: a vocabulary table is small in
    practice, not by proof. Beyond the bound the join is a shuffle join with the same rows."""
    sizes = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 8 for c in df.columns]
    total = df.agg(F.sum(reduce(Column.__add__, sizes))).first()[0] or 0
    return F.broadcast(df) if total <= max_bytes else df


def occurring(table: DataFrame, df: DataFrame, on: str) -> DataFrame:
    """The rows of ``table`` whose ``on`` occurs in ``df``, stored: a join of ``df`` with them gives what one with
    the whole table gives. A vocabulary grows with its concepts, few of which need be in use; a
    join that must shuffle ``df`` by term puts all rows of a frequent term into one task."""
    return cut_lineage(table.join(df.select(on).distinct(), on, "left_semi").select(*table.columns), "occurring")


def closure(edges: DataFrame, child: str = "child", parent: str = "parent", max_depth: int | None = None) -> DataFrame:
    """Transitive closure ``(child, ancestor, depth)`` with the minimum depth of each pair.

    Paths double: with all pairs up to depth k known, a pair of depth k < d <= 2k is one of depth k
    followed by one of depth d - k, so each round joins the pairs of depth exactly k with all known
    ones, and a hierarchy of depth d takes about log2(d) rounds. One reliable checkpoint per round
    (the new pairs); the known set is the union of the stored rounds, so every plan stays shallow
    and a lost executor recomputes one round. Cycles terminate because a pair is only new once.
    """
    e = edges.select(F.col(child).alias("child"), F.col(parent).alias("ancestor")).distinct()
    known = last = cut_lineage(e.withColumn("depth", F.lit(1)))
    reach = 1
    while max_depth is None or reach < max_depth:
        far = last.where(F.col("depth") == reach).select("child", F.col("ancestor").alias("_mid"))
        up = known.select(F.col("child").alias("_mid"), "ancestor", (F.col("depth") + reach).alias("depth"))
        if max_depth is not None:
            up = up.where(F.col("depth") <= max_depth)
        step = far.join(up, "_mid").groupBy("child", "ancestor").agg(F.min("depth").alias("depth"))
        last = cut_lineage(step.join(known.select("child", "ancestor"), ["child", "ancestor"], "left_anti"))
        if last.isEmpty():
            break
        known = known.unionByName(last)
        reach *= 2
    return known


def inverse_edges(triples: DataFrame, inverses: DataFrame) -> DataFrame:
    """Materialise inverse triples: for ``(s, p, o)`` with ``p`` in ``inverses(p, inverse)``
    emit ``(o, inverse, s)``; both directions of each pair are honoured."""
    both = inverses.select("p", "inverse").unionByName(inverses.select(F.col("inverse").alias("p"), F.col("p").alias("inverse")))
    both = broadcast_if_small(both.distinct())
    t = triples.join(both, "p")
    return t.select(F.col("o").alias("s"), F.col("inverse").alias("p"), F.col("s").alias("o")).distinct()


def subproperty_lift(triples: DataFrame, subprops: DataFrame) -> DataFrame:
    """Entailed ``(s, super_p, o)`` from ``subprops(sub, super)`` (transitively), not already present."""
    sup = closure(subprops, "sub", "super").select(F.col("child").alias("p"), F.col("ancestor").alias("super_p"))
    lifted = triples.join(broadcast_if_small(sup), "p").select("s", F.col("super_p").alias("p"), "o").distinct()
    return lifted.join(triples.select("s", "p", "o"), ["s", "p", "o"], "left_anti")


def superclass_types(types: DataFrame, subclasses: DataFrame) -> DataFrame:
    """All ``(s, class)`` typings including those implied by ``subclasses(sub, super)``."""
    sup = closure(subclasses, "sub", "super").select(F.col("child").alias("class"), F.col("ancestor").alias("super"))
    implied = types.join(broadcast_if_small(sup), "class").select("s", F.col("super").alias("class"))
    return types.select("s", "class").unionByName(implied).distinct()


def domain_range_violations(triples: DataFrame, types: DataFrame, axioms: DataFrame) -> DataFrame:
    """Edges whose subject lacks the declared domain class or whose object lacks the range class.

    ``axioms(p, domain, range)``; ``types(s, class)`` should already include superclasses.
    Output ``(s, p, o, side, expected)``.
    """
    ax = broadcast_if_small(axioms)
    t = triples.join(ax, "p")
    dom = t.where(F.col("domain").isNotNull()).select("s", "p", "o", F.lit("domain").alias("side"), F.col("s").alias("node"), F.col("domain").alias("expected"))
    rng = t.where(F.col("range").isNotNull()).select("s", "p", "o", F.lit("range").alias("side"), F.col("o").alias("node"), F.col("range").alias("expected"))
    checks = dom.unionByName(rng)
    typed = types.select(F.col("s").alias("node"), F.col("class").alias("expected"))
    return checks.join(typed, ["node", "expected"], "left_anti").select("s", "p", "o", "side", "expected")


def cardinality_violations(
    targets: DataFrame, term_types: DataFrame, rules: list[tuple[str, int, int | None]], subjects: DataFrame | None = None
) -> DataFrame:
    """Qualified cardinality over ``targets(subject, term)`` typed by ``term_types(term, class)``.

    ``rules`` are ``(class, min, max)``. ``subjects(subject)`` names all subjects the rules hold
    for: one without any target is reported with count 0 (without the table, only subjects that
    have some target can be seen). One partial aggregation per subject; rules become columns,
    never a cross join. Output ``(subject, class, n, min_n, max_n)`` for each broken rule.
    """
    types = broadcast_if_small(occurring(term_types.select("term", "class").distinct(), targets, "term"))
    typed = targets.select("subject", "term").distinct().join(types, "term", "left")
    if subjects is not None:
        # a row without term or class: it adds the subject and counts for no rule
        none = subjects.select("subject").distinct().withColumns({"term": F.lit(None).cast("string"), "class": F.lit(None).cast("string")})
        typed = typed.select("subject", "term", "class").unionByName(none)
    # (subject, term) and (term, class) are distinct, so each (subject, term, class) row is
    # unique and a conditional count equals the distinct-term count (no Expand, one aggregate)
    aggs = [F.count(F.when(F.col("class") == F.lit(c), F.lit(1))).alias(f"n_{i}") for i, (c, _, _) in enumerate(rules)]
    per = typed.groupBy("subject").agg(*aggs)
    checks = []
    for i, (c, lo, hi) in enumerate(rules):
        n = F.col(f"n_{i}")
        broken = (n < F.lit(lo)) if hi is None else ((n < F.lit(lo)) | (n > F.lit(hi)))
        checks.append(
            F.when(broken, F.struct(F.lit(c).alias("class"), n.cast("long").alias("n"), F.lit(lo).alias("min_n"), F.lit(hi).cast("int").alias("max_n")))
        )
    out = per.select("subject", F.explode(F.array_compact(F.array(*checks))).alias("v"))
    return out.select("subject", "v.class", "v.n", "v.min_n", "v.max_n")
