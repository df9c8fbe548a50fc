"""Batched user-code keys (UD-01, UD-02) over the documents table."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelgraph import constants as K
from labelgraph.functions.text import WS_CLASS
from labelgraph.operators import batch as B
from labelgraph.operators import predictions as P
from labelgraph.plans.fixtures import register_tables
from labelgraph.plans.q_predictions import _PARSE, _VERDICT, _VOCAB, vocab
from labelgraph.plans.registry import CONCEPT_CTES, query, strip_sql

# stand-in model for the batch scorer: keyword -> (dimension, term)
KEYWORDS = {
    "the": ("Area", "NATION_1"),
    "und": ("Area", "NATION_2"),
    "que": ("Scope", "Brand_1"),
    "le": ("Scope", "Brand_2"),
    "in": ("Ability", "BUILDING"),
}


@query(
    "batched_map",
    f"""SELECT doc_id, CAST(CASE WHEN {strip_sql('text')} = '' THEN 0
        ELSE len(regexp_split_to_array({strip_sql('text')}, '{WS_CLASS}+')) END AS BIGINT) AS n_tokens FROM documents""",
)
def batched_map(spark, sf):
    d = register_tables(spark, sf)["documents"].select("doc_id", "text")
    return B.batched_map(d, B.python_token_counts, "doc_id long, n_tokens long")


_WORDS_SQL = f"regexp_split_to_array({strip_sql('lower(text)')}, '{WS_CLASS}+')"


def _terms_sql(dim: str) -> str:
    own = [f"CASE WHEN list_contains(w, '{k}') THEN '{t}' END" for k, (d, t) in sorted(KEYWORDS.items()) if d == dim]
    return f"list_filter([{', '.join(own)}], lambda x: x IS NOT NULL)"


_SCORED = f"""ws AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
scored AS (SELECT doc_id, {', '.join(f'{_terms_sql(d)} AS {k}' for d, k in zip(K.DIM_NAMES, K.LABEL_KEYS))} FROM ws),
fx_responses AS (
  SELECT doc_id AS sample_id, 'assistant' || chr(10) || CASE WHEN len(Areas) + len(Scopes) + len(Abilities) = 0
    THEN '{{"Error": "NotMathMaterial"}}' ELSE CAST(to_json({{'Areas': Areas, 'Scopes': Scopes, 'Abilities': Abilities}}) AS VARCHAR) END AS response
  FROM scored)"""


@query(
    "batch_classify",
    f"""WITH {_SCORED}, {CONCEPT_CTES}, {_VOCAB}, {_PARSE}, {_VERDICT}
    SELECT sample_id, len(reasons) = 0 AS valid, array_to_string(reasons, ',') AS reasons FROM vv""",
    ("fx_triples",),
)
def batch_classify(spark, sf):
    d = register_tables(spark, sf)["documents"].select(F.col("doc_id").alias("sample_id"), "text")
    resp = B.batch_classify(d, B.keyword_scorer(KEYWORDS))
    parsed = P.parse_response(resp.select("sample_id", P.extract_answer("response").alias("answer")))
    v = P.verdicts(parsed, vocab(spark, sf))
    return v.select("sample_id", "valid", F.array_join("reasons", ",").alias("reasons"))
