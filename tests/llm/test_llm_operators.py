"""Training-data operators on small inputs: brute force, round trips and edge cases.

The edge table has nulls in every column, empty and long texts, ties, repeated rows and extra
columns whose names the operators use themselves.
"""

import hashlib
import os
import random
import re
import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from labelgraph.llm import chat_repair as CR
from labelgraph.llm import decontaminate as DE
from labelgraph.llm import jaccard_join as JJ
from labelgraph.llm import mixing as MX
from labelgraph.llm import paragraph_dedup as PD
from labelgraph.llm import quality_rules as QR
from labelgraph.llm import queries as Q
from labelgraph.llm import sharding as SH
from labelgraph.llm import token_blocks as TB
from labelgraph.llm import url_filter as UF
from labelgraph.llm import warc as WA
from labelgraph.llm.common import prefix_sums
from labelgraph.llm.components import components
from labelgraph.llm.shingles import shingle_set

CLASH = ["k", "t", "d", "th", "node", "n", "key", "size", "token", "whole", "rest", "cut", "p", "pid", "u", "start", "value", "contamination", "mix_size"]


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def edge_rows():
    rng = random.Random(5)
    base = prose(rng, 120)
    near = base.replace(base.split()[60], "changed")
    shared = prose(rng, 60)
    rows = [
        (1, base, "a"), (2, base, "a"), (3, near, "b"), (3, near, "b"), (None, base, None), (4, None, "b"), (5, "", None), (6, " \n\t ", "c"),
        (7, "One", "c"), (8, "one", "c"), (9, "Émile “ß” x\u00a0y\u2003z 日本語 Σ", "a"), (10, prose(rng, 30) + " " + shared + " " + prose(rng, 30), "a"),
        (11, prose(rng, 25) + "\n" + shared + " " + prose(rng, 40), "b"), (12, prose(rng, 20_000), "c"), (13, "line one two\n" * 30, "a"),
        (None, None, None), (None, None, None), (14, "don't 42 <|endoftext|> a\x1cb", "b"),
    ]
    return rows


@pytest.fixture(scope="module")
def edge(spark, edge_rows):
    df = spark.createDataFrame(edge_rows, "doc_id long, text string, source string")
    for i, c in enumerate(CLASH):
        df = df.withColumn(c, F.lit(i))
    return df.repartition(3)


@pytest.fixture(scope="module")
def empty(edge):
    return edge.limit(0)


# ---- helpers -----------------------------------------------------------------------------
def test_prefix_sums_with_ties_nulls_and_a_hot_group(spark):
    rows = [(None if i % 7 == 0 else i % 3 // 2, i % 5, 1 + i % 4) for i in range(600)]
    df = spark.createDataFrame(rows, "g int, o int, v int")
    got = prefix_sums(df, ["o"], {"before": "v", "rank": None}, groups=["g"]).collect()
    for g in {r[0] for r in rows}:
        own = sorted((r for r in got if r.g == g), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(sum(x[0] == g for x in rows)))
        assert [r.o for r in own] == sorted(r.o for r in own)
        total = 0
        for r in own:
            assert r.before == total
            total += r.v


def test_components_of_long_and_repeated_links(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- 1 -----------------------------------------------------------------------------------
def test_paragraph_dedup_finds_passages_and_nothing_else(spark, edge, empty):
    found = PD.repeated_passages(edge).collect()
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append(r)
    assert set(by) == {1, 2, 3, 11}  # 10 keeps the shared passage, the null id the copied text
    assert by[11][0].kept == 10 and by[11][0].n_words >= PD.LEAST_WORDS
    assert PD.repeated_passages(empty).count() == 0
    cut = {r.doc_id: r.text for r in PD.remove_passages(edge.where("doc_id in (10, 11)")).collect()}
    text = {r.doc_id: r.text for r in edge.where("doc_id in (10, 11)").collect()}
    assert cut[10] == text[10] and len(cut[11]) < len(text[11]) - 100


def test_paragraph_dedup_misses_no_passage_of_over_50_words(spark):
    rng = random.Random(11)
    rows, want = [], set()
    for i in range(60):
        p = prose(rng, 51)
        rows.append((2 * i, prose(rng, rng.randint(0, 80)) + " " + p + " " + prose(rng, rng.randint(0, 80))))
        rows.append((2 * i + 1, prose(rng, rng.randint(0, 80)) + " " + p + "\n" + prose(rng, rng.randint(0, 80))))
        want.add(2 * i + 1)
    rows += [(1000 + i, prose(rng, 150)) for i in range(60)]
    got = {r.doc_id for r in PD.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_near_lines_join_by_bands(spark):
    rng = random.Random(3)
    rows, want = [], set()
    for i in range(40):
        words = prose(rng, 80).split()
        other = list(words)
        other[rng.randrange(80)] = "edited"
        rows += [(2 * i, "first line\n" + " ".join(words)), (2 * i + 1, " ".join(other))]
        want.add(2 * i + 1)
    got = {r.doc_id for r in PD.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_a_hot_bucket_is_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(PD, "TILE", 8, raising=False)
    rng = random.Random(9)
    head, bodies = prose(rng, 60), []
    for _ in range(30):  # lines of one template, and a near copy of each
        words = (head + " " + prose(rng, 30)).split()
        bodies += [" ".join(words), " ".join(words[:-2] + ["edited", "here"])]
    sets = [set(shingle_set(t).tolist()) for t in bodies]
    links = {(i, j) for i in range(60) for j in range(i) if 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j])}
    assert links == {(2 * i + 1, 2 * i) for i in range(30)}
    rows = [(1, 100 + i, None) for i in range(60)] + [(None, 100 + i, t) for i, t in enumerate(bodies)]
    got = {r.line - 100: r.root - 100 for r in PD._similar_lines(spark.createDataFrame(rows, "key long, line long, body string")).collect()}
    assert got == {i: i // 2 * 2 for i in range(60)}


def test_short_lines_and_wrapped_passages_are_paragraphs(spark):
    rng = random.Random(21)
    rows, want = [], set()
    for i, n in enumerate((5, 6, 7, 12, 19, 20, 24, 28)):  # one equal line
        line = prose(rng, n)
        rows += [(2 * i, prose(rng, 40) + "\n" + line + "\n" + prose(rng, 30)), (2 * i + 1, line + "\n\n" + prose(rng, 25))]
        want.add((2 * i + 1, n))
    for i in range(20, 40):  # a near copy wrapped over short lines, with an edit in its middle
        words = prose(rng, 60).split()
        other = [w if k != 30 else "edited" for k, w in enumerate(words)]
        wrap = lambda w, n: "\n".join(" ".join(w[k : k + n]) for k in range(0, 60, n))
        rows += [(2 * i, prose(rng, 30) + "\n" + wrap(words, 10)), (2 * i + 1, wrap(other, 12) + "\n\n" + prose(rng, 30))]
        want.add((2 * i + 1, 60))
    rows += [(1000, prose(rng, 4) + "\n\n" + prose(rng, 30)), (1001, "four words of it\n" + prose(rng, 30)), (1002, "four words of it\n" + prose(rng, 30))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = PD.repeated_passages(df, least_words=PD.LINE_WORDS).collect()
    assert {(r.doc_id, r.n_words) for r in got} == want and all(r.kept == r.doc_id - 1 for r in got)
    # a removal has the words of a passage: lone short lines stay in their documents
    removed = PD.repeated_passages(df).collect()
    assert {(r.doc_id, r.n_words) for r in removed} == {x for x in want if x[1] >= PD.LEAST_WORDS} and len(removed) == 21


def test_removals_against_brute_force(spark):
    # every stretch of 51 words that an earlier document has is cut for the most part, and documents
    # that share no stretch of LEAST_WORDS words and no line with another keep their text
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rng = random.Random(13)
    rows += [(10_000 + i, prose(rng, 30) + " " + " ".join(t.split()[:70]) + " " + prose(rng, 30)) for i, (_, t) in enumerate(rows[:20]) if t]
    found = {}
    for r in PD.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect():
        found.setdefault(r.doc_id, []).append((r.start, r.end))
    seen, lines = {}, {}
    for i, t in sorted(rows):
        for line in (t or "").lower().split("\n"):
            lines.setdefault(tuple(line.split()), set()).add(i)
    for i, t in sorted(rows):
        spans = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", t or "")]
        words = [t[a:b].lower() for a, b in spans]
        grams = {n: [tuple(words[k : k + n]) for k in range(len(words) - n + 1)] for n in (51, PD.LEAST_WORDS)}
        repeated = [k for k, g in enumerate(grams[51]) if seen.get(g, i) != i]
        hit = {k + j for k in repeated for j in range(51)}
        cut = {k for k in hit if any(a <= spans[k][0] and spans[k][1] <= b for a, b in found.get(i, []))}
        assert len(cut) >= 0.5 * len(hit), i
        near = any(len(own) > 1 and i in own and len(line) >= PD.LEAST_WORDS for line, own in lines.items())
        if i in found and not hit:
            assert near or any(seen.get(g, i) != i for g in grams[PD.LEAST_WORDS]), i
        for own in grams.values():
            for g in own:
                seen.setdefault(g, i)


def test_the_worst_cut_passage_of_51_words_is_found(spark):
    rng, rows = random.Random(17), []
    while len(rows) < 6:
        words = prose(rng, 51)
        cuts = PD.cut_points(PD.shingle_hashes(PD.word_hashes(words)[0]))
        if (cuts[0], cuts[-1]) != (11, 51 - 16):
            continue
        pair = [prose(rng, 40) + " " + words + " " + prose(rng, 40) for _ in range(2)]
        a, b = (PD.Paragraphs(t) for t in pair)
        both = np.isin(b.piece_key, a.piece_key)
        if b.piece_end[both].max() - b.piece_start[both].min() == 28:
            rows += [(len(rows) + i, t) for i, t in enumerate(pair)]
    got = PD.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.kept, r.n_words) for r in got} == {(i + 1, i, 28) for i in (0, 2, 4)}


def test_a_removal_is_held_by_the_document_it_names(spark):
    rng = random.Random(31)
    one, two = prose(rng, 60), prose(rng, 60)
    chain = prose(rng, 84).split()
    common = [" ".join(chain[12 * i : 12 * i + 24]) for i in range(6)]
    rows = [(i, prose(rng, 30) + " " + c + " " + prose(rng, 30)) for i, c in enumerate(common)]
    rows += [(10, prose(rng, 30) + " " + " ".join(chain) + " " + prose(rng, 30))]  # chained short phrases of six documents
    rows += [(20, one), (21, prose(rng, 20) + "\n" + two), (22, one + "\n" + two + "\n" + prose(rng, 30))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = PD.Paragraphs(rows[6][1])
    held = np.isin(whole.piece_key, np.concatenate([PD.Paragraphs(t).piece_key for _, t in rows[:6]]))
    assert np.diff(np.flatnonzero(np.diff(np.concatenate([[0], held, [0]]))))[::2].max() >= 4  # touching pieces
    got = PD.repeated_passages(df).collect()
    text = dict(rows)
    assert {(r.doc_id, r.kept, r.n_words) for r in got} == {(22, 20, 60), (22, 21, 60)}
    assert all(text[r.doc_id][r.start : r.end] in text[r.kept] for r in got)
    cut = {r.doc_id: r.text for r in PD.remove_passages(df).collect()}
    assert cut[10] == text[10] and cut[22].split() == text[22].split()[120:]


# ---- 2 -----------------------------------------------------------------------------------
def brute_contamination(text, items, window=13):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    w, hit, ids = words(text), set(), set()
    for item, t in items:
        own = words(t)
        n = min(window, len(own))
        for i in range(len(own) - n + 1 if own else 0):
            for j in range(len(w) - n + 1):
                if w[j : j + n] == own[i : i + n]:
                    hit.update(range(j, j + n))
                    if item is not None:
                        ids.add(str(item))
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


ITEMS = [(1, "line one two line"), (10, "ONE"), (2, ""), (3, None), (None, "ß x"), (4, "日本語"), (10, "one"), (5, "the " * 20)]


@pytest.mark.parametrize("block", [DE.BLOCK_BYTES, 100])
def test_decontamination_equals_brute_force(spark, edge, empty, edge_rows, monkeypatch, block):
    monkeypatch.setattr(DE, "BLOCK_BYTES", block)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("k", F.lit(1))
    got = sorted((tuple(r) for r in DE.judge(edge, bench).collect()), key=str)
    want = sorted(((i, *brute_contamination(t, ITEMS)) for i, t, _ in edge_rows), key=str)
    assert got == want
    assert DE.judge(empty, bench).count() == 0
    assert DE.judge(edge, bench.limit(0)).where("n_hit > 0").count() == 0
    cut = {r.doc_id: r.text for r in DE.remove_spans(edge.where("doc_id in (7, 9, 13)"), bench).collect()}
    assert cut[7] == "" and "日本語" not in cut[9] and "line one" not in cut[13]
    kept = DE.remove_documents(edge, bench)
    assert kept.count() == sum(not w[5] for w in want) and kept.columns == edge.columns  # its own column of that name included


# ---- 3 -----------------------------------------------------------------------------------
def brute_cost(roles):
    best = 1 << 60

    def go(i, state, cost):
        nonlocal best
        if cost >= best:
            return
        if i == len(roles):
            best = min(best, cost + CR.INSERT * len(CR._CLOSE[state]))
            return
        for label in CR.ROLES:
            change = 0 if label == roles[i] else (CR.RELABEL if roles[i] else CR.NAME_ROLE)
            if CR._LAST.get(state) == label:
                go(i + 1, state, cost + change + CR.MERGE)
            for n in range(3):
                for empties in product(("user", "assistant"), repeat=n):
                    at = state
                    for r in empties:
                        at = CR._NEXT.get((at, r), -1)
                    if (at, label) in CR._NEXT:
                        go(i + 1, CR._NEXT[at, label], cost + change + n * CR.INSERT)

    go(0, CR.START, 0)
    return best


def closing(role):
    return CR.INSERT * len(CR._CLOSE[{"system": CR.SYSTEM, "user": CR.USER, "assistant": CR.ASSISTANT}[role]])


def test_role_repair_costs_least():
    rng = random.Random(1)
    for _ in range(200):
        roles = [rng.choice([*CR.ROLES, None]) for _ in range(rng.randint(1, 6))]
        steps = CR.repair(roles)
        assert sum(s[0] for s in steps) + closing(steps[-1][2]) == brute_cost(roles)


def test_conversations_over_several_ranges_and_odd_rows(spark):
    rng = random.Random(2)
    rows = [(1, i, rng.choice([*CR.ROLES, "bot", None]), f"t{i}") for i in range(2000)]
    rows += [(2, None, "user", "a"), (2, None, "user", "a"), (2, 1, "assistant", None), (None, 1, "user", "x"), (3, 1, "system", "s"), (3, 1, "system", "s2")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for c in ("c", "r", "h", "pid"):
        df = df.withColumn(c, F.lit(0))
    got = CR.repair_conversations(df.repartition(4)).collect()
    assert len(got) == 2006
    long = sorted((r for r in got if r.conv_id == 1), key=lambda r: r.seq)
    assert [r.seq for r in long] == list(range(2000)) == [r.turn for r in long]
    steps = CR.repair([r.role if r.role in CR.ROLES else None for r in long])
    assert sum(r.cost for r in long) == sum(s[0] for s in steps) + closing(steps[-1][2])
    for c in (1, 2, 3, None):
        own = sorted((r for r in got if r.conv_id == c), key=lambda r: r.seq)
        text, state = "".join(r.rendered for r in own), CR.START
        for role in re.findall(r"<\|(system|user|assistant)\|>", text):
            state = CR._NEXT[state, role]
        assert state == CR.ASSISTANT and text.endswith(CR.CLOSING)
    # a turn said twice stays twice in the text, also where many equal turns span several ranges
    two = sorted((r for r in got if r.conv_id == 2), key=lambda r: r.seq)
    assert [r.turn for r in two] == [None, None, 1] and "".join(r.rendered for r in two).startswith("<|user|>\na\na<|end|>\n")
    same = spark.createDataFrame([(7, None, "user", "ok")] * 900 + [(7, 1, "assistant", "done")], "conv_id long, turn long, role string, text string")
    said = sorted(CR.repair_conversations(same.repartition(4)).collect(), key=lambda r: r.seq)
    assert [r.seq for r in said] == list(range(901)) and "".join(r.rendered for r in said).count("ok") == 900
    assert CR.repair_conversations(df.limit(0)).count() == 0


# ---- 4 -----------------------------------------------------------------------------------
def test_differencing_balances():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 5000, 3000)
    for parts in (1, 2, 7, 40):
        sums = np.bincount(SH.difference(sizes, parts), weights=sizes, minlength=parts)
        assert sums.max() - sums.min() <= 5
    assert sorted(SH.difference(np.array([8, 7, 6, 5, 4]), 2).tolist()) in ([0, 0, 0, 1, 1], [0, 0, 1, 1, 1])
    giant = np.append(rng.integers(1, 50, 500), 100_000)
    part = SH.difference(giant, 4)
    assert (part == part[-1]).sum() == 1


def test_sharding_keeps_groups_and_numbers_rows(spark, edge, empty, edge_rows):
    got = SH.shard(edge, 4).collect()
    assert sorted((r.doc_id or -1, r["size"], r.text_crc32) for r in got) == sorted(
        (i or -1, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in edge_rows
    )
    for s in {r.shard for r in got}:
        own = sorted((r for r in got if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        assert [r.doc_id or -1 for r in own] == sorted(r.doc_id or -1 for r in own)
    shards = {}
    for r in got:
        shards.setdefault((r["size"], r.text_crc32), set()).add(r.shard)
    assert all(len(s) == 1 for k, s in shards.items() if k[0] > 16)
    assert SH.shard(empty, 4).count() == 0


def test_sharding_is_even_on_the_test_table(spark):
    g = {r.shard: r.b for r in Q.op4(spark, SF_SMALL).groupBy("shard").agg(F.sum("size").alias("b")).collect()}
    size = {r[0]: r[1] for r in Q.op4(spark, SF_SMALL).groupBy("text_crc32").agg(F.sum("size")).collect()}
    assert max(g.values()) - min(g.values()) <= max(size.values())


# ---- 5 -----------------------------------------------------------------------------------
@pytest.mark.parametrize("split", ["100", "777", "128m"])
def test_warc_round_trip_with_records_inside_payloads(spark, split):
    inner = WA.records(spark.createDataFrame([(7, "http://x", "<p>inner</p>" * 9)], "page_id long, url string, html string")).first()[0]
    rows = []
    for i in range(60):
        html = [f"é {i} " * (i % 50), inner + WA.END + f"tail {i}", WA.MAGIC * (i % 7) + "x" * i, "same payload " * 20, None,
                f"a{WA.END}{WA.MAGIC}Content-Length: 3\r\nWARC-Type: response{WA.END}abc{WA.END}" + "z" * i][i % 6]
        rows.append((i, f"http://h/{i}", html))
    rows += [(3, "u", "same payload " * 20), (None, None, "same payload " * 20), (5, "a\r\nX: y", rows[5][2])]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).coalesce(2)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = sorted((tuple(r) for r in WA.round_trip(df).collect()), key=str)
        assert WA.round_trip(df.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    count, low = {}, {}
    for i, _, h in rows:
        count[h or ""] = count.get(h or "", 0) + 1
        if i is not None:
            low[h or ""] = min(low.get(h or "", i), i)
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        again = len(raw) >= 100 and count[h or ""] > 1 and i != low[h or ""]
        page = None if i is None else str(i)
        want.append((page, "revisit" if again else "response", len(raw), hashlib.sha256(raw).hexdigest(), str(low[h or ""]) if again else None))
    assert got == sorted(want, key=str)


def test_a_file_that_starts_with_junk_has_no_records(spark, tmp_path):
    record = WA.records(spark.createDataFrame([(7, "u", "x")], "page_id long, url string, html string")).first()[0] + WA.END
    (tmp_path / "a.warc").write_text("junk" + record)
    (tmp_path / "b.warc").write_text(record * 2)
    (tmp_path / "c.warc").write_text("")
    assert [r.page for r in WA.read_archives(spark, str(tmp_path)).collect()] == ["7", "7"]


# ---- 6 -----------------------------------------------------------------------------------
def brute_components(rows):
    sets = [set(shingle_set(t).tolist()) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((r[0], len(sets[i]), min(ids) if ids and sets[i] else r[0]))
    return sorted(out, key=str)


def test_jaccard_join_equals_brute_force(spark, edge, empty, edge_rows):
    got = sorted((tuple(r) for r in JJ.similar_components(edge).collect()), key=str)
    assert got == brute_components(edge_rows)
    assert JJ.similar_components(empty).count() == 0
    kept = JJ.keep_one(edge)
    assert kept.columns == edge.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted(map(str, [1, None, None, 4, 5, 6, 7, 9, 10, 11, 12, 13, 14]))


def test_jaccard_join_of_a_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(JJ, "SHORT_LIST", 6)
    monkeypatch.setattr(JJ, "TILE_MEMBERS", 30)
    rng = random.Random(8)
    base = prose(rng, 110).split()
    rows = [(0, " ".join(base))]
    for i in range(1, 160):
        own = list(base)
        for _ in range(rng.randint(1, 7)):
            own[rng.randrange(len(own))] = prose(rng, 1)
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, " ".join(base[:40]) + " " + prose(rng, 100)) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted((tuple(r) for r in JJ.similar_components(df).collect()), key=str) == brute_components(rows)


def test_set_ids_and_filter_bits(spark):
    nodes = np.array([0, 1, -5, 1 << 60], dtype=np.int64)
    spark_side = [r[0] for r in spark.createDataFrame([(int(x),) for x in nodes], "node long").select(F.pmod(F.xxhash64("node"), F.lit(1 << JJ.FILTER_BITS))).collect()]
    assert JJ.spark_bits(nodes).tolist() == spark_side
    rng = random.Random(4)
    for _ in range(200):
        a = shingle_set(prose(rng, rng.randint(1, 60)))
        b = np.unique(np.concatenate([a[rng.randint(0, 3) :], shingle_set(prose(rng, rng.randint(1, 8)))]))
        if JJ.is_link(a, b):
            assert JJ.bitmaps_allow(JJ.bitmap(a), len(a), JJ.bitmap(b), len(b))


# ---- 7 -----------------------------------------------------------------------------------
def brute_url(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fit = [r for r in rules if r[0] and (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1] or "")]
    best = max(fit, key=lambda r: (len(r[0] + (r[1] or "")), len(r[0]), r[2]), default=None)
    return host, path, best and best[0] + (best[1] or ""), best[2] if best else "allow"


@pytest.mark.parametrize("small", [True, False])
def test_url_filter_equals_brute_force(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(UF, "BROADCAST_RULES", 0)
    rules = [*Q.URL_RULES, ("b.com", "", "block"), ("b.com", "", "allow"), ("c.b.com", None, "allow"), (None, "/x", "block"), ("", "/", "block"), ("com", "en/", "block")]
    urls = [None, "", "nothing", "http://Example.COM/en/x?q", "https://www.example.com/en/", "http://com/", "http://xcom/", "http://a.net/es/1", "http://net/fr",
            "http://u@c.b.com:80/", "http://b.com", "http://c.b.com/q#f", "x://y://z/en/", "http://www.example.com/en/#t", "http://" + "a." * 500 + "com/" + "p" * 5000]
    rows = [(i % 9 if i % 4 else None, u) for i, u in enumerate(urls)] + [(1, "http://a.net/es/1")] * 5
    df = spark.createDataFrame(rows, "page_id long, url string")
    for c in ("host", "path", "rule", "labels", "digest"):
        df = df.withColumn(c, F.lit(0))
    table = spark.createDataFrame(rules, "host string, path string, action string")
    got = sorted((tuple(r) for r in UF.judge_urls(df, table).collect()), key=str)
    assert got == sorted(((i, *brute_url(u, rules)) for i, u in rows), key=str)
    assert UF.judge_urls(df.limit(0), table).count() == 0
    assert {r.verdict for r in UF.judge_urls(df, table.limit(0)).collect()} == {"allow"}


# ---- 8 -----------------------------------------------------------------------------------
def brute_quality(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    rep = {p for at in seen.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep)


def test_quality_measures_and_ledger(spark, edge, empty, edge_rows):
    led = QR.apply_policy(QR.ledger(QR.measure(edge)))
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in led.collect()), key=str)
    want = []
    for i, t, _ in edge_rows:
        m = brute_quality(t)
        want.append((i, *m, m[0] < 20 or 100 * m[4] > 30 * m[0]))
    assert got == sorted(want, key=str)
    assert QR.measure(empty).count() == 0
    rows = led.collect()
    for r in QR.ablation(led).collect():
        bit = 1 << list(QR.RULES).index(r.rule)
        assert r.failed == sum(bool(x.failed_bits & bit) for x in rows)
        assert r.rejected_alone == sum(x.failed_bits == bit for x in rows)
    assert led.where("kept").count() <= QR.apply_policy(led, "v1").where("kept").count()


# ---- 9 -----------------------------------------------------------------------------------
def test_mix_meets_targets(spark, edge, empty, edge_rows):
    got = MX.mix(edge).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in got) == sorted((str(i), t or "") for i, t, _ in edge_rows)
    by = {}
    for r in got:
        assert 0 <= r.mix_copies <= 2
        by.setdefault(r.source, []).append(r)
    size = {s: sum(r.mix_size for r in rows) for s, rows in by.items()}
    for s, rows in by.items():
        assert all(r.mix_source_size == size[s] and r.mix_target <= 2 * size[s] + 1e-6 for r in rows)
        taken = sum(r.mix_size * r.mix_copies for r in rows)
        assert abs(taken - rows[0].mix_target) <= max(r.mix_size for r in rows) / 2 + 1e-6
    assert sum(rows[0].mix_target for rows in by.values()) == pytest.approx(1.5 * sum(size.values()))
    again = sorted((str(r.doc_id), r.mix_copies, r.text or "") for r in MX.mix(edge.repartition(7)).collect())
    assert again == sorted((str(r.doc_id), r.mix_copies, r.text or "") for r in got)
    assert MX.mix(empty).count() == 0
    assert MX.repeat_rows(MX.mix(edge), ["doc_id"]).count() == sum(r.mix_copies for r in got)


def test_mix_splits_a_class_of_equal_rows(spark):
    rows = [(1, "one two three", "a")] * 100 + [(2, "x " * 100, "b")]
    got = MX.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1, 1), share="0.5").collect()
    own = [r for r in got if r.source == "a"]
    assert abs(sum(3 * r.mix_copies for r in own) - own[0].mix_target) <= 1.5


def test_overlapping_sources_route_by_least_repetition():
    capacity = {("a",): 100, ("a", "b"): 100, ("b",): 50}
    supply = MX.route(capacity, {"a": 150, "b": 150}, 2)
    assert sum(supply.values()) == 300
    assert supply[("a",)] >= 100 and supply[("a", "b")] >= 100 and 50 <= supply[("b",)] <= 100


def test_overlapping_sources_in_documents(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, 20), [["a"], ["a", "b"], ["b", "b"], None, []][i % 5]) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    got = MX.mix(df).collect()
    assert len(got) == 200 and max(r.mix_copies for r in got) <= 2


# ---- 10 ----------------------------------------------------------------------------------
def test_blocks_round_trip():
    rng = np.random.default_rng(2)
    for ids in ([0], [7] * 2048, [0, 2**32 - 1], rng.integers(0, 50_000, 2048), np.append(rng.integers(0, 30, 500), [70_000, 2**31])):
        ids = np.array(ids, dtype=np.uint32)
        assert TB.decode_block(memoryview(TB.encode_block(ids)), 0).tolist() == ids.tolist()


def test_token_files_equal_the_tokenizer(spark, edge, empty, edge_rows, tmp_path):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(Q.tokenizer_path())
    path = str(tmp_path / "tokens")
    index = TB.encode_documents(edge, Q.tokenizer_path(), Q.END_ID, path).collect()
    full = TB.read_tokens(spark, path, with_ids=True).collect()
    expect = {}
    for i, t, _ in edge_rows:
        expect.setdefault(i, []).append(tok.encode(t or "", add_special_tokens=False).ids + [Q.END_ID])
    for i, own in expect.items():
        assert sorted(r.ids for r in full if r.doc_id == i) == sorted(own)
        want = sorted((len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in own)
        assert sorted((r.n_tokens, r.ids_crc32) for r in index if r.doc_id == i) == want
    start = 0
    for r in sorted(index, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    order = [r.doc_id or -1 for r in sorted(index, key=lambda r: r.start)]
    assert order == sorted(order)
    assert TB.encode_documents(empty, Q.tokenizer_path(), Q.END_ID).count() == 0


def test_the_shortcut_equals_the_tokenizer_for_every_character_it_takes():
    from tokenizers import Tokenizer

    tok, enc = Tokenizer.from_file(Q.tokenizer_path()), TB.WordEncoder(Q.tokenizer_path())
    taken = [chr(c) for c in range(0x110000) if not TB._OTHER.search(chr(c))]
    odd = [chr(c) for c in (0x130, 0x131, 0x178, 0x17F, 0x1E9E, 0x212A, 0x212B)]
    texts = ["\u0130stanbul and \u0130zmir"] + [f"{c} x{c}y {c}A 1{c}2 {c}{c}. {c}" for c in dict.fromkeys(taken + odd)]
    got = [np.frombuffer(raw, "<u4").tolist() for raw in enc(texts)]
    assert got == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert enc.by_words and len(taken) == 128 + 62 and not set(odd) & set(taken)
    assert all(TB._OTHER.search(t) for t in ("it'S", "we'RE", "<|x"))


def test_another_kind_of_tokenizer_is_encoded_whole():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["Hello  World, it's 42!", "", None, "é\n\nß"]
    got = [np.frombuffer(x, "<u4").tolist() for x in TB.WordEncoder(path)(texts)]
    tok = Tokenizer.from_file(path)
    assert got == [tok.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_entry_point_has_every_query(spark):
    import __spark_entry__ as E

    names = E.queries()
    assert {f"op{n}_" for n in range(1, 11)} <= {re.match(r"op\d+_", k)[0] for k in names if k.startswith("op")}
    assert "pipeline" in names and os.path.exists(os.path.join(os.path.dirname(E.__file__), "corpus_pipeline.py"))


# ---- clashing column names ---------------------------------------------------------------
HARD = ["_words", "_lines", "_at", "_member", "_order", "_whole", "_cut", "_p", "_copy", "_cut_of", "_cuts", "_cut_hash", "_join_th", "_join_k", "carried", "row"]
HARD += ["n_words", "kept", "failed_bits", "mix_size", "mix_copies", "mix_target", "contamination", "a.b", "c d", "th", "node", "k", "t", "text2"]


def test_pipeline_stages_pass_any_columns(spark, edge_rows):
    import corpus_pipeline as CP
    from labelgraph.llm.common import read_table, stored

    plain = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in edge_rows], "doc_id long, text string, lang string, source string, n_chars long")
    plain = plain.unionByName(read_table(spark, SF_SMALL, "documents").limit(60))
    more = plain.select("*", *[F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in HARD])
    for name, stage in CP.STAGES:
        a, b = stored(stage(spark, plain, SF_SMALL), f"plain-{name}"), stored(stage(spark, more, SF_SMALL), f"more-{name}")
        if name == "token_blocks":
            assert a.count() == b.count()
            break
        assert b.columns == more.columns
        assert sorted(map(str, b.select(*plain.columns).collect())) == sorted(map(str, a.collect()))
        for r in b.collect():
            for c in HARD:
                assert r[c] == f"{c}:{'-' if r.doc_id is None else r.doc_id}"
        plain, more = a, b


def test_operators_pass_any_columns(spark, edge_rows):
    from labelgraph.llm.common import read_table

    plain = spark.createDataFrame(edge_rows, "doc_id long, text string, source string")
    more = plain.select("*", *[F.lit(c).alias(c) for c in HARD])
    bench = read_table(spark, SF_SMALL, "benchmark")
    for op in (PD.remove_passages, lambda d: DE.remove_spans(d, bench), lambda d: DE.remove_documents(d, bench)):
        a, b = op(plain), op(more)
        assert b.columns == more.columns
        assert sorted(map(str, b.select(*plain.columns).collect())) == sorted(map(str, a.collect()))
    for op, new in ((QR.measure, QR.MEASUREMENTS), (MX.mix, MX.RESULT)):
        a, b = op(plain), op(more)
        assert set(b.columns) == {*more.columns, *new} and len(b.columns) == len(set(b.columns))
        assert sorted(map(str, b.select(*a.columns).collect())) == sorted(map(str, a.collect()))
