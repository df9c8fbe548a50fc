"""Registered queries against their DuckDB twins, and the pipeline against brute force."""

import zlib

import duckdb
import numpy as np
import pytest

from conftest import SF_SMALL
from labelgraph.llm import queries as Q
from test_llm_operators import brute_components, brute_contamination, brute_quality


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_equals_sql(spark, con, name):
    df = Q.QUERIES[name](spark, SF_SMALL)
    cur = con.execute(Q.ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)

    def row(values, names):
        return str([round(v, 6) if isinstance(v, float) else v for _, v in sorted(zip(names, values))])

    assert sorted(row(r, df.columns) for r in df.collect()) == sorted(row(r, cols) for r in cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.ORACLE)))
def test_runs(spark, name):
    assert Q.QUERIES[name](spark, SF_SMALL).count() >= 0


def test_pipeline_equals_brute_force(spark, con):
    import corpus_pipeline as P
    from tokenizers import Tokenizer

    from labelgraph.llm import quality_rules
    from labelgraph.llm.common import read_table, stored

    docs = read_table(spark, SF_SMALL, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    results = []
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, SF_SMALL), f"test-{name}")
        results.append(docs)
        if name != "token_blocks":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = [sorted(r.doc_id for r in df.collect()) for df in results]

    def passes(t):
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        found = dict(zip(names, brute_quality(t)))
        found["n_lines"] = sum(bool(x.strip(" \t\n\x0b\f\r")) for x in (t or "").split("\n"))
        return not any(eval(rule, {}, found) for rule in quality_rules.RULES.values())

    kept = sorted(i for i, r in rows.items() if passes(r.text))
    assert ids[0] == kept
    kept = sorted({c for _, _, c in brute_components([(i, rows[i].text) for i in kept])})
    assert ids[1] == kept
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    kept = [i for i in kept if not brute_contamination(rows[i].text, items)[4]]
    assert ids[2] == kept
    taken = {i: ids[3].count(i) for i in kept}
    assert set(ids[3]) <= set(kept) and max(taken.values()) <= 2
    words = {i: len((rows[i].text or "").split()) for i in kept}
    assert abs(sum(words[i] * n for i, n in taken.items()) - 1.5 * sum(words.values())) <= 20 * max(words.values()) / 2
    assert ids[4] == ids[3]
    tok = Tokenizer.from_file(Q.tokenizer_path())
    for r in results[4].collect():
        own = tok.encode(rows[r.doc_id].text or "", add_special_tokens=False).ids + [Q.END_ID]
        assert (r.n_tokens, r.ids_crc32) == (len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
