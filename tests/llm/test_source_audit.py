"""Source audit against a direct reading of the definition."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from labelgraph.llm import source_audit as SA

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs=10, top=10):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))) for lang, source, t in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(w for _, _, ws in own for w in set(ws))
        kept = [w for w, n in df.items() if n >= min_docs]
        sources = sorted({d[1] for d in own}, key=str.encode)

        def shares(ds):
            c = Counter(w for _, _, ws in ds for w in ws if df[w] >= min_docs)
            total = sum(c.values()) + 2 * len(kept)
            return c, {w: 1 + 10**9 * (c[w] + 2) // total for w in kept}

        _, q = shares(own)
        per = {s: shares([d for d in own if d[1] == s]) for s in sources}

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in sources:
            c, p = per[s]
            pair = [(o, sum(f(p[w], per[o][1][w]) for w in kept)) for o in sources if o != s]
            term = [(w, f(p[w], q[w])) for w in kept if c[w] and p[w] > q[w]]
            for part, items, n in (("pair", pair, None), ("term", term, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(items[:n])]
    return sorted(out)


def table(rng, n=400):
    vocab = ["".join(rng.choice("abcéüß日") for _ in range(rng.randint(1, 4))) for _ in range(80)]
    rows = []
    for _ in range(n):
        lang = rng.choice(["en", "en", "de", None])
        source = "hot" if rng.random() < 0.4 else rng.choice(["s1", "s2", "sé", "", None, "Z"])
        k = rng.choice([0, 1, 5, 30])
        rows.append((lang, source, " ".join(rng.choice(vocab[: rng.choice([5, 80])]).upper() + rng.choice(["", "1", "-x"]) for _ in range(k))))
    rows += [("xx", "one", "too rare to keep"), ("xx", "two", None), ("yy", "alone", "word"), ("en", "empty", None), ("en", "empty2", " 12 _ "), (None, None, None)]
    rows += [("en", "long", "lettersonly" * 5000 + " a " + "b c " * 3000)] * 2
    return rows


@pytest.fixture(scope="module")
def rows():
    return table(random.Random(8))


def collected(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


@pytest.mark.parametrize("bits", [64, 5])
def test_equals_definition_also_with_shared_digests(spark, rows, bits):
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    for c in ("lh", "gh", "raw", "digest", "n", "d", "term", "doc_id", "_x", "a.b"):
        df = df.withColumn(c, F.lit(1))
    got = collected(SA.audit(df.repartition(3), digest_bits=bits))
    want = brute(rows)
    assert len(got) == len(want)
    assert got == want


def test_small_blocks_pieces_and_reports(spark, rows, monkeypatch):
    monkeypatch.setattr(SA, "BLOCK", 2)  # plan side: several tiles for a language
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(2)
    assert collected(SA.audit(df, min_docs=3, top=4)) == brute(rows, 3, 4)


def test_terms_of_a_long_text_are_cut_at_gaps(monkeypatch):
    rng = random.Random(9)
    text = "".join(rng.choice("aB é1") for _ in range(5000)).encode()
    whole = [t for part in SA.terms_in(text) for t in part]
    monkeypatch.setattr(SA, "PIECE", 7)
    assert [t for part in SA.terms_in(text) for t in part] == whole
    assert [t.decode() for t in whole] == re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.decode().translate(LOWER))


def test_empty_table(spark):
    assert SA.audit(spark.createDataFrame([], "lang string, source string, text string")).count() == 0


def test_tiles_pass_over_batches(spark, rows, monkeypatch):
    # rows of a tile come in many batches, with terms cut between them
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.createDataFrame(rows, "lang string, source string, text string").coalesce(1)
        assert collected(SA.audit(df)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
