"""Mixing sources to target weights: min-cost flow over membership patterns, then seeded choice.

Documents that belong to the same set of sources form one pattern. A small flow network routes
each pattern's words to the quotas of its sources; the first copy of a word is free and every
further one costs more than the one before, so repetition is spread as thinly as quotas allow.
Which documents supply a partly used copy is decided by a seeded hash of id and text.
"""

from __future__ import annotations

import heapq
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgraph.llm.common import carried, only, prefix_sums, stored

#: Columns that ``mix`` adds; columns of these names are replaced.
RESULT = ("mix_size", "mix_copies", "mix_source_size", "mix_target")
#: 60 bits of MD5, so that SQL and Spark order documents alike.
ORDER_HEX = 15


# ---- targets -----------------------------------------------------------------------------
def quotas(sizes: dict[str | None, int], weights: list[int], share: Fraction, repeat: int) -> dict[str | None, Fraction]:
    """Target words per source: ``share`` of all words by weight, at most ``repeat`` times a source.

    Sources in code point order, null last, take the weights in turn. What a source can't take
    is shared again by weight among the others until none is above its limit.
    """
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), list(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > repeat * sizes[s]]
        if not over:
            out.update({s: left * weight[s] / total for s in open_})
            break
        for s in over:
            out[s] = Fraction(repeat * sizes[s])
        left -= sum(out[s] for s in over)
        open_ = [s for s in open_ if s not in out]
    return out


# ---- flow --------------------------------------------------------------------------------
def route(capacity: dict[tuple, int], quota: dict[str | None, Fraction], repeat: int) -> dict[tuple, Fraction]:
    """Words that each pattern supplies, repeats included, by a min-cost flow.

    Edges: start -> pattern, one for each copy with the pattern's words as capacity and the copy's
    number as cost (convex); pattern -> its sources; source -> end with its quota. Successive
    shortest paths with potentials; the network has one node for each pattern and source.
    """
    pats, names = list(capacity), list(quota)
    start, end = 0, 1 + len(pats) + len(names)
    graph: list[list[list]] = [[] for _ in range(end + 1)]

    def edge(a, b, cap, cost):
        graph[a].append([b, cap, cost, len(graph[b])])
        graph[b].append([a, Fraction(0), -cost, len(graph[a]) - 1])

    at = {s: 1 + len(pats) + i for i, s in enumerate(names)}
    for i, p in enumerate(pats):
        for copy in range(repeat):
            edge(start, 1 + i, Fraction(capacity[p]), copy * copy)
        for s in p:
            edge(1 + i, at[s], Fraction(repeat * capacity[p]), 0)
    for s in names:
        edge(at[s], end, Fraction(quota[s]), 0)
    potential = [0] * (end + 1)
    while True:
        dist, via = [None] * (end + 1), [None] * (end + 1)
        dist[start], heap = 0, [(0, start)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > dist[a]:
                continue
            for k, (b, cap, cost, _) in enumerate(graph[a]):
                if cap > 0 and (dist[b] is None or d + cost + potential[a] - potential[b] < dist[b]):
                    dist[b] = d + cost + potential[a] - potential[b]
                    via[b] = (a, k)
                    heapq.heappush(heap, (dist[b], b))
        if dist[end] is None:
            break
        potential = [p + (d if d is not None else dist[end]) for p, d in zip(potential, dist)]
        path, b = [], end
        while b != start:
            path.append(via[b])
            b = via[b][0]
        push = min(graph[a][k][1] for a, k in path)
        for a, k in path:
            graph[a][k][1] -= push
            graph[graph[a][k][0]][graph[a][k][3]][1] += push
    return {p: sum((e[1] for e in graph[1 + i] if e[0] == start), Fraction(0)) for i, p in enumerate(pats)}


# ---- Spark -------------------------------------------------------------------------------
def seeded_order(key: str, text: str, seed: str):
    """60 bits of MD5 over seed, id and text; rows equal in both are one class."""
    k = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    inner = F.concat_ws(":", F.lit(seed), k, F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    return F.conv(F.substring(F.md5(inner), 1, ORDER_HEX), 16, 10).cast("long")


def mix(
    docs: DataFrame,
    sources: str = "source",
    weights: tuple[int, ...] = (3, 1, 2),
    share: str = "1.5",
    repeat: int = 2,
    seed: str = "mix",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``docs`` with mix_size, mix_copies, and the source's mix_source_size and mix_target.

    ``sources`` names a string column (one source each, null being one) or an array column
    (memberships; null or empty is the null source alone, repeated entries count once). A
    document belongs to every source of its pattern; mix_source_size and mix_target are those of
    its first source in code point order. Size is the number of words between ASCII white space
    (0 for null); a document is taken whole mix_copies times, at most ``repeat``. An empty table
    gives an empty result, sources without words a target of 0.

    Of each pattern all documents are taken as often as its supply reaches round, and those first
    in the seeded order once more, up to the one whose middle the supply reaches; so a pattern
    misses its supply by half a document at most. The texts are never shuffled: the order's
    cut-off is found on (hash, size) classes, one cut-off row for each pattern is broadcast, and
    only rows of a class that a cut-off splits (rows equal in id and text) are numbered.
    """
    spark = docs.sparkSession
    words = F.size(F.array_remove(F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")
    col = F.col(f"`{sources}`")
    if dict(docs.dtypes)[sources].startswith("array"):
        member = F.array_sort(F.array_distinct(F.coalesce(col, F.array(F.lit(None).cast("string")))))
        member = F.when(F.size(member) == 0, F.array(F.lit(None).cast("string"))).otherwise(member)
    else:
        member = F.array(col.cast("string"))
    docs, restore = carried(docs, *dict.fromkeys((key, text, sources)))
    add = {"mix_size": words, "_member": member, "_order": seeded_order(key, text, seed)}
    own = docs.withColumns(add)
    classes = stored(
        own.groupBy("_member", "_order").agg(F.sum("mix_size").alias("words"), F.count(F.lit(1)).alias("n")), "mix-classes"
    )
    # one row for each pattern: bounded by the number of source combinations, not by rows
    patterns = {tuple(r["_member"]): r["words"] for r in classes.groupBy("_member").agg(F.sum("words").alias("words")).collect()}
    sizes: dict[str | None, int] = {}
    for p, w in patterns.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + w
    quota = quotas(sizes, list(weights), Fraction(share), repeat)
    supply = route(patterns, quota, repeat)
    rows = []
    for p, w in patterns.items():
        whole = min(repeat, int(supply[p] // w)) if w else 0
        rest = supply[p] - whole * w if w and whole < repeat else Fraction(0)
        rows.append((list(p), whole, float(rest), sizes[p[0]], float(quota[p[0]])))
    plan = spark.createDataFrame(rows, "_member array<string>, _whole int, _rest double, _source_size long, _target double")
    # where the running sum of a pattern's classes crosses its rest: one class, or none
    run = prefix_sums(classes, ["_order"], {"before": "words"}, groups=["_member"], name="mix-run")
    run = run.join(F.broadcast(plan), run["_member"].eqNullSafe(plan["_member"])).drop(plan["_member"])
    cross = run.filter((F.col("before") < F.col("_rest")) & (F.col("before") + F.col("words") >= F.col("_rest")) & (F.col("words") > 0))
    cuts = {tuple(r["_member"]): r for r in cross.select("_member", "_order", "before", "n").collect()}
    full = [
        (
            *row,
            cuts[tuple(row[0])]["_order"] if tuple(row[0]) in cuts else None,
            cuts[tuple(row[0])]["before"] if tuple(row[0]) in cuts else None,
            cuts[tuple(row[0])]["n"] if tuple(row[0]) in cuts else None,
        )
        for row in rows
    ]
    schema = "_p array<string>, _whole int, _rest double, mix_source_size long, mix_target double, _cut long, _cut_before long, _cut_n long"
    table = spark.createDataFrame(full, schema)
    placed = own.join(F.broadcast(table), own["_member"].eqNullSafe(table["_p"]))
    at_cut = F.coalesce(F.col("_order") == F.col("_cut"), F.lit(False))
    once_more = F.when(F.col("_cut").isNull(), F.lit(False)).otherwise(F.col("_order") < F.col("_cut"))
    middle = 2 * F.col("_cut_before") + F.col("mix_size") <= 2 * F.col("_rest")
    single = placed.filter(~(at_cut & (F.col("_cut_n") > 1)))
    single = single.withColumn("mix_copies", F.col("_whole") + F.when(at_cut, middle).otherwise(once_more).cast("int"))
    out = restore(single, *RESULT, without=RESULT)
    if any(r["n"] > 1 for r in cuts.values()):
        shared = placed.filter(at_cut & (F.col("_cut_n") > 1))
        shared = prefix_sums(shared, ["_order", "mix_size"], {"_in": "mix_size"}, groups=["_member"], name="mix-cut")
        more = 2 * (F.col("_cut_before") + F.col("_in")) + F.col("mix_size") <= 2 * F.col("_rest")
        shared = shared.withColumn("mix_copies", F.col("_whole") + more.cast("int"))
        out = out.unionByName(restore(shared, *RESULT, without=RESULT))
    return out


def repeat_rows(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the named columns."""
    own, restore = carried(mixed, "mix_copies")
    rows = restore(own.filter("mix_copies > 0").select("*", F.explode(F.sequence(F.lit(1), F.col("mix_copies"))).alias("copy")))
    return only(rows, *columns)
