"""Periodic runs against a direct reading of the definition."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from labelgraph.llm import periodic_runs as PR
from labelgraph.llm import queries as Q
from labelgraph.llm.common import read_table


def brute_runs(words):
    """Every maximal stretch of each period with enough words; a span keeps its smallest period."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def brute_row(words):
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    head = (len(runs), *best, 1000 * best[1] // best[2]) if best else (0, None, None, None, None)
    return (*head, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def planted(doc_id, words):
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def random_words(rng):
    """Words with nested, adjacent, overlapping and interrupted repeats."""
    out = []
    for _ in range(rng.randint(1, 6)):
        kind = rng.randint(0, 3)
        if kind == 0:
            out += [rng.randint(0, 50) for _ in range(rng.randint(0, 30))]
        else:
            period = [rng.randint(0, 4) for _ in range(rng.randint(1, 9))]
            if kind == 2:
                period = period * rng.randint(1, 4) + [rng.randint(0, 4)]
            part = period * rng.randint(2, 8)
            out += part[: len(part) - rng.randint(0, len(period))]
            if kind == 3 and out:
                out[rng.randrange(len(out))] = 77
    return out


def test_runs_equal_the_definition():
    rng = random.Random(3)
    for _ in range(1500):
        w = random_words(rng)
        got = PR.runs_of(np.array(w, dtype=np.int64), np.zeros(len(w), dtype=np.int64))
        assert got == brute_runs(w), w


def test_words_over_few_letters():
    rng = random.Random(4)
    for letters in (1, 2, 3):
        for _ in range(300):
            w = [rng.randrange(letters) for _ in range(rng.randint(0, 90))]
            assert PR.runs_of(np.array(w, dtype=np.int64), np.zeros(len(w), dtype=np.int64)) == brute_runs(w), w


def test_texts_of_a_group_stay_apart():
    w = np.array([1, 2] * 5 + [1, 2] * 5, dtype=np.int64)
    assert PR.runs_of(w, np.repeat([0, 1], 10)) == []  # ten words each are too few
    assert PR.runs_of(w, np.zeros(20, dtype=np.int64)) == [(0, 20, 2)]


def test_prose_falls_apart_and_runs_survive():
    rng = random.Random(5)
    prose = [rng.randint(0, 3000) for _ in range(20_000)]
    w = np.array(prose[:9000] + [5, 6, 7] * 10 + prose[9000:], dtype=np.int64)
    spans = PR.surviving_segments(w, np.zeros(len(w), dtype=np.int64))
    assert sum(e - s for s, e in spans) < 200  # little is left for the scan
    assert PR.runs_of(w, np.zeros(len(w), dtype=np.int64)) == [(9000, 30, 3)]


def test_one_word_repeated_very_often():
    w = np.zeros(200_000, dtype=np.int64)
    assert PR.runs_of(w, w) == [(0, 200_000, 1)]
    w = np.tile(np.arange(1000), 200)
    assert PR.runs_of(w, np.zeros(len(w), dtype=np.int64)) == [(0, 200_000, 1000)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    out = [(i, " ".join(f"w{x}" for x in random_words(rng))) for i in range(60)]
    out += [(100, None), (101, ""), (102, " \n\t "), (None, "a b " * 9), (None, None), (103, "x " * 40), (103, "x " * 40)]
    out += [(104, "X x " * 12), (105, "a b c d " * 7), (106, "a\x1cb\x85c " * 12), (107, "one\n" * 11), (108, "one\n" * 12)]
    out += [(109, " ".join(f"v{i % 1500}" for i in range(7_000)))]
    return out


def test_operator_on_edge_rows(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("k", "t", "runs", "collapsed", "n_words", "_x", "a.b"):
        df = df.withColumn(c, F.lit(1))
    got = sorted(map(str, map(tuple, PR.summary(PR.periodic_runs(df.repartition(3))).collect())))
    assert got == sorted(str((i, *brute_row(words_of(t)))) for i, t in rows)
    one = PR.periodic_runs(df.where("doc_id = 103")).first()
    assert one.collapsed == "x" and [tuple(r) for r in one.runs] == [(0, 40, 1)]
    assert PR.periodic_runs(df.limit(0)).count() == 0


def words_of(t):
    return [w.decode() for w in (t or "").encode().split()]


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in Q.QUERIES["op11_periodic_runs"](spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    assert any(r[0] for r in got.values())
    for i, t in docs:
        words = planted(i, words_of(t))
        if len(words) > 3000:  # the definition is quadratic; a long text is checked above
            continue
        assert got[i] == brute_row(words), i


def test_planted_words_with_ties_and_nulls(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.text.encode().split()) for r in Q.planted_repeats(df).collect())
    assert got == sorted((str(i), [w.encode() for w in planted(i, words_of(t))]) for i, t in rows)
