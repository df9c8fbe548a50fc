"""Near-duplicate classes against brute force, and the sketch's estimates against real overlaps."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelgraph.llm import hyper_minhash as HM


def shingles(t):
    low = (t or "").encode().lower().split()
    return {tuple(low[i : i + 2]) for i in range(max(1, len(low) - 1))} if low else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (k, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        c = min(ids) if ids else None
        out.append((k, len(sets[i]), c, k == c))
    return sorted(map(str, out))


def words(rng, n, vocab=5000):
    return [f"w{rng.randrange(vocab)}" for _ in range(n)]


def edited(rng, ws, n):
    ws = list(ws)
    for _ in range(n):
        ws[rng.randrange(len(ws))] = f"e{rng.randrange(10**9)}"
    return ws


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    out = []
    for size in (3, 5, 6, 9, 12, 20, 40, 90, 300, 1500):
        for _ in range(6):
            base = words(rng, size)
            out.append(" ".join(base))
            for k in (1, 1, 2, size // 40 + 1, size // 20 + 1, size // 12 + 1):
                out.append(" ".join(edited(rng, base, k)))
            out.append(" ".join(base[:-1]))
            out.append(" ".join([*base, "more"]))
    base = words(rng, 150)
    out += [" ".join(edited(rng, base, rng.randint(1, 9))).upper() for _ in range(150)]  # copies of one original that is missing
    out += ["one", "One", "two", "", None, " \n\t ", "a b", "A  B", "a b a b", "x y", "é É"]
    rng.shuffle(out)
    keyed = [(i, t) for i, t in enumerate(out)]
    return keyed + [(3, keyed[3][1]), (None, keyed[5][1]), (None, None), (None, "lone text without key"), (7, "other text")]


def run(df):
    return sorted(str(tuple(r)) for r in HM.near_duplicates(df).select("doc_id", "n_shingles", "component_id", "kept").collect())


def test_equals_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("k", "t", "c", "key", "hi", "lo", "h1", "h2", "n", "regs", "root", "m", "a", "b", "_x", "x.y"):
        df = df.withColumn(c, F.lit(1))
    assert run(df.repartition(3)) == brute(rows)
    assert HM.near_duplicates(df.limit(0)).count() == 0


def test_large_buckets_in_chunks_and_windows(spark, rows, monkeypatch):
    monkeypatch.setattr(HM, "TILE", 4)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert run(df) == brute(rows)


def test_registers_of_a_union():
    rng = np.random.default_rng(1)
    for n, m in ((0, 5), (1, 1), (40, 300), (5000, 20)):
        a, b = (np.unique(rng.integers(0, 1 << 63, k, dtype=np.uint64) * np.uint64(2)) for k in (n, m))
        assert (HM.merge(HM.registers(a), HM.registers(b)) == HM.registers(np.union1d(a, b))).all()
    assert HM.registers(np.array([0], dtype=np.uint64))[0] == HM.HASH_BITS << HM.MANTISSA


def test_estimates_and_collisions():
    rng = np.random.default_rng(2)
    errors, chance = [], []
    for _ in range(300):
        both, one = rng.integers(0, 1 << 63, 4000, dtype=np.uint64), rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
        a, b = np.concatenate([both, one[:500]]), np.concatenate([both, one[500:]])
        x, y = HM.registers(HM.mix64(a)), HM.registers(HM.mix64(b))
        c = HM.expected_collisions(np.array([4500]), np.array([4500]))[0]
        same, filled = (x == y).sum(), HM.BUCKETS
        errors.append((same - c) / (filled - c) - 0.8)
        u, v = (HM.registers(HM.mix64(rng.integers(0, 1 << 63, 4500, dtype=np.uint64))) for _ in range(2))
        chance.append((u == v).sum())
        ok = HM.passes(np.array([same, (u == v).sum()]), np.array([filled] * 2), np.array([4500] * 2), np.array([4500] * 2))
        assert ok.tolist() == [True, False]
    assert abs(np.mean(errors)) < 0.006 and np.std(errors) < 0.04
    assert abs(np.mean(chance) - c) < 0.1


def test_recall_of_bands_at_the_threshold():
    """Pairs at exactly 0.8 share a band, for sets from 5 to 2000 elements."""
    rng = np.random.default_rng(3)
    missed = 0
    for size in (4, 8, 20, 40, 100, 400, 2000):
        for _ in range(300):
            s = HM.mix64(rng.integers(0, 1 << 63, size + size // 4, dtype=np.uint64))
            keys = HM.band_keys(np.stack([HM.registers(s[:size]), HM.registers(s)]))
            missed += not (keys[0] == keys[1]).any()
    assert missed == 0


def test_bitmaps_never_rule_out_a_link():
    rng = np.random.default_rng(4)
    for size in (1, 4, 9, 63, 64, 200, 1000):
        for extra in (size // 4, size // 3 + 1):
            s = HM.mix64(rng.integers(0, 1 << 63, size + extra, dtype=np.uint64))
            small, large = np.unique(s[:size]), np.unique(s)
            x, y = HM.bitmap(small), HM.bitmap(large)
            sides = [(int.from_bytes(b, "little"), 8 * len(b), len(own)) for b, own in ((x, small), (y, large))]
            ok = HM.bitmaps_allow(*sides[0], *sides[1])
            assert ok == HM.bitmaps_allow(*sides[1], *sides[0])
            assert ok or not HM.is_link(small, large)
            if size >= 200:
                assert ok == HM.is_link(small, large)
