"""Exact splits of a growing table: increments, replays, ties, against a plain sort."""

import hashlib
import math
from collections import Counter

from pyspark.sql import functions as F

from labelgraph.operators import growing_split as G

SCHEMA = "id string"


def score(key):
    return int(hashlib.md5(f"s:{key}".encode() if key is not None else b"s").hexdigest()[:12], 16)


def frame(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], SCHEMA).repartition(3)


def expected(keys):
    ranked = sorted(keys, key=lambda k: (score(k), k is not None, k or ""))
    return sorted(((k, "eval" if i < math.ceil(0.1 * len(keys) - 1e-9) else "train") for i, k in enumerate(ranked)), key=str)


def counted(rows):
    return Counter(rows)


def split(spark, path, cut):
    return sorted((tuple(r) for r in G.split_at(spark, path, cut).collect()), key=str)


def test_increments_equal_one_split_and_moves_are_their_difference(spark, tmp_path):
    path = str(tmp_path / "g")
    parts = [[f"k{i}" for i in range(0, 700)], [f"k{i}" for i in range(700, 760)], [], [f"k{i}" for i in range(760, 3000)]]
    seen, cuts, before = [], [], {}
    for n, keys in enumerate(parts):
        G.append_batch(frame(spark, keys), "id", path, n, "s")
        seen += keys
        cuts.append(G.find_cut(spark, path))
        assert cuts[-1].rows == len(seen) and split(spark, path, cuts[-1]) == expected(seen)
        now = dict(expected(seen))
        if n:
            got = {r.key: (r.was, r.split) for r in G.moved(spark, path, cuts[-2], cuts[-1]).collect()}
            assert got == {k: (before[k], now[k]) for k in before if before[k] != now[k]}
        before = now
    assert G.find_cut(spark, path, batches=cuts[1].batches) == cuts[1]  # an older cut can be found again


def test_a_repeated_append_replaces_its_batch(spark, tmp_path):
    path = str(tmp_path / "g")
    for n, keys in ((0, ["a", "b"]), (1, [f"x{i}" for i in range(50)]), (1, [f"x{i}" for i in range(40)])):
        G.append_batch(frame(spark, keys), "id", path, n, "s")
    cut = G.find_cut(spark, path)
    assert cut.rows == 42 and split(spark, path, cut) == expected(["a", "b"] + [f"x{i}" for i in range(40)])


def test_hot_and_null_keys_are_split_row_by_row(spark, tmp_path):
    path = str(tmp_path / "g")
    keys = ["hot"] * 300 + [None] * 100 + [f"k{i}" for i in range(100)]
    for n in range(2):
        G.append_batch(frame(spark, keys[n::2]), "id", path, n, "s")
    cuts = [G.find_cut(spark, path, batches=b) for b in ((0,), (0, 1))]
    assert split(spark, path, cuts[1]) == expected(keys)
    first, whole = (dict(counted(split(spark, path, c))) for c in cuts)
    assert sum(n for (_, side), n in first.items() if side == "eval") == 25
    got = [(r.was, r.split) for r in G.moved(spark, path, *cuts).collect()]
    # ties go to the older batch, so no row of it leaves the side of the smaller scores for a later one
    old_in_new = dict(counted(split(spark, path, G.Cut(cuts[1].score, cuts[1].at_cut, 0, (0,)))))
    gain = sum(max(0, old_in_new.get(k, 0) - first.get(k, 0)) for k in old_in_new if k[1] == "eval")
    loss = sum(max(0, first.get(k, 0) - old_in_new.get(k, 0)) for k in first if k[1] == "eval")
    assert (got.count(("train", "eval")), got.count(("eval", "train"))) == (gain, loss)


def test_empty_table_and_only_near_scores_are_read(spark, tmp_path):
    path = str(tmp_path / "g")
    G.append_batch(frame(spark, []), "id", path, 0, "s")
    cut = G.find_cut(spark, path)
    assert cut == G.Cut(0, 0, 0, (0,)) or cut.rows == 0
    assert G.split_at(spark, path, cut).count() == 0
    G.append_batch(frame(spark, [f"k{i}" for i in range(500)]), "id", path, 1, "s")
    rows = G._stored(spark, path, "scores", (1,)).where(F.col("score").between(5, 9))
    assert "GreaterThanOrEqual(score,5)" in rows._jdf.queryExecution().executedPlan().toString()
