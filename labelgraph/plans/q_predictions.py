"""Prediction post-processing keys (FN-14, PV-01..10, JN-08/09, SO-03) over fx_predictions / fx_responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelgraph import constants as K
from labelgraph.operators import graph as G
from labelgraph.operators import ontology as O
from labelgraph.operators import predictions as P
from labelgraph.operators import reach as R
from labelgraph.plans.fixtures import fixture
from labelgraph.plans.q_graph import term_index
from labelgraph.plans.registry import CONCEPT_CTES, WS, lname_sql, query
from labelgraph.session import cut_lineage

V = O.Vocab.bare()
FP = ("fx_triples", "fx_predictions")
FR = ("fx_triples", "fx_responses")


def preds(spark, sf):
    return fixture(spark, sf, "fx_predictions")


def vocab(spark, sf):
    return P.vocabulary(O.concept_types(fixture(spark, sf, "fx_triples", store=False), V))  # types are few of the triples


_VOCAB = f"vocab AS (SELECT DISTINCT {lname_sql('iri')} AS term, dim FROM ctypes)"
_DD = "dd AS (SELECT sample_id, dim, term, min(pos) AS pos FROM fx_predictions GROUP BY sample_id, dim, term)"
_PRUNE = f"""
r(dim, child, ancestor) AS (
  SELECT dim, child, parent FROM edges UNION SELECT r.dim, r.child, e.parent FROM r JOIN edges e ON r.ancestor = e.child AND r.dim = e.dim),
cl0 AS (SELECT DISTINCT dim, {lname_sql('child')} AS c, {lname_sql('ancestor')} AS a FROM r),
cl AS (SELECT x.* FROM cl0 x LEFT JOIN cl0 y ON y.dim = x.dim AND y.c = x.a AND y.a = x.c WHERE x.c <> x.a AND y.c IS NULL),
anc AS (SELECT DISTINCT d.sample_id, d.dim, cl.a AS term FROM dd d JOIN cl ON d.term = cl.c AND d.dim = cl.dim),
pruned AS (SELECT d.* FROM dd d WHERE NOT EXISTS
  (SELECT 1 FROM anc WHERE anc.sample_id = d.sample_id AND anc.dim = d.dim AND anc.term = d.term))"""


@query("pred_dedupe", f"WITH {_DD} SELECT sample_id, dim, term, pos FROM dd", ("fx_predictions",))
def pred_dedupe(spark, sf):
    return P.dedupe(fixture(spark, sf, "fx_predictions", store=False))  # read once


@query("pred_prune_ancestors", f"WITH RECURSIVE {CONCEPT_CTES}, {_DD}, {_PRUNE} SELECT sample_id, dim, term, pos FROM pruned", FP)
def pred_prune_ancestors(spark, sf):
    return R.prune_covered(preds(spark, sf), term_index(spark, sf))


@query(
    "pred_vocab_unknown",
    f"WITH {CONCEPT_CTES}, {_VOCAB} SELECT sample_id, dim, term, pos FROM fx_predictions p WHERE NOT EXISTS (SELECT 1 FROM vocab v WHERE v.term = p.term)",
    FP,
)
def pred_vocab_unknown(spark, sf):
    return P.unknown_terms(preds(spark, sf), vocab(spark, sf)).select("sample_id", "dim", "term", "pos")


@query(
    "pred_vocab_wrong_dim",
    f"""WITH {CONCEPT_CTES}, {_VOCAB}
    SELECT sample_id, dim, term, pos FROM fx_predictions p
    WHERE EXISTS (SELECT 1 FROM vocab v WHERE v.term = p.term)
      AND NOT EXISTS (SELECT 1 FROM vocab v WHERE v.term = p.term AND v.dim = p.dim)""",
    FP,
)
def pred_vocab_wrong_dim(spark, sf):
    return P.wrong_dimension(preds(spark, sf), vocab(spark, sf)).select("sample_id", "dim", "term", "pos")


def _json_by_dim(dim_col: str = "dim") -> str:
    parts = [
        f"'{key}': coalesce(list(term ORDER BY pos, term) FILTER (WHERE {dim_col} = '{d}'), []::VARCHAR[])"
        for d, key in zip(K.DIM_NAMES, K.LABEL_KEYS)
    ]
    return "CAST(to_json({" + ", ".join(parts) + "}) AS VARCHAR)"


@query(
    "pred_clean_json",
    f"""WITH RECURSIVE {CONCEPT_CTES}, {_VOCAB}, {_DD}, {_PRUNE},
    clean AS (SELECT d.* FROM pruned d WHERE EXISTS (SELECT 1 FROM vocab v WHERE v.term = d.term AND v.dim = d.dim))
    SELECT s.sample_id, {_json_by_dim()} AS labels_json FROM (SELECT DISTINCT sample_id FROM fx_predictions) s
    LEFT JOIN clean c ON c.sample_id = s.sample_id GROUP BY s.sample_id""",
    FP,
)
def pred_clean_json(spark, sf):
    """What is pruned or unknown stays as rows without a dimension: so every sample has its row."""
    labels = preds(spark, sf)
    used = R.terms_in_use(labels)
    known = G.broadcast_if_small(G.occurring(vocab(spark, sf).withColumn("known", F.lit(True)), used, "term"))
    pruned = R.prune_covered(labels, term_index(spark, sf), drop=False, used=used).join(known, ["term", "dim"], "left")
    clean = pruned.withColumn("dim", F.when(F.col("known") & ~F.col("covered"), F.col("dim")))
    return P.clean_json(clean)


# ---- responses ------------------------------------------------------------------------------
def _first(plural: str, singular: str) -> str:
    """The first value that is there and no JSON null, as JSON text."""
    paths = (plural, singular, f"labels.{plural}", f"labels.{singular}")
    return "coalesce(" + ", ".join(f"nullif(json_extract(answer, '$.{p}')::VARCHAR, 'null')" for p in paths) + ")"


def _strings(c: str) -> str:
    """Whether JSON text is an array of strings."""
    return f"coalesce(json_type({c}) = 'ARRAY' AND len(list_filter(json_extract({c}, '$[*]'), lambda x: json_type(x) <> 'VARCHAR')) = 0, FALSE)"


_PARSE = f"""
r0 AS (SELECT sample_id, trim(string_split(response, 'assistant' || chr(10))[2], {WS}) AS answer FROM fx_responses),
r1 AS (SELECT *, coalesce(json_valid(answer), FALSE) AS valid_json FROM r0),
r2 AS (SELECT *, CASE WHEN valid_json AND json_type(answer) = 'OBJECT' THEN TRUE ELSE FALSE END AS obj FROM r1),
r3 AS (SELECT sample_id, answer, valid_json, obj,
  CASE WHEN obj THEN coalesce(json_extract_string(answer, '$.Error'), json_extract_string(answer, '$.error')) END AS error,
  CASE WHEN obj THEN {_first('Areas', 'Area')} END AS a0, CASE WHEN obj THEN {_first('Scopes', 'Scope')} END AS s0,
  CASE WHEN obj THEN {_first('Abilities', 'Ability')} END AS b0,
  CASE WHEN obj THEN json_keys(answer) END AS keys
  FROM r2),
r4 AS (SELECT * EXCLUDE (a0, s0, b0),
  CASE WHEN {_strings('a0')} THEN a0 END AS areas, CASE WHEN {_strings('s0')} THEN s0 END AS scopes, CASE WHEN {_strings('b0')} THEN b0 END AS abilities,
  (a0 IS NULL OR {_strings('a0')}) AND (s0 IS NULL OR {_strings('s0')}) AND (b0 IS NULL OR {_strings('b0')}) AS typed,
  error IS NOT NULL AS has_error,
  coalesce(len(list_intersect(keys, ['Areas','Scopes','Abilities','Area','Scope','Ability','labels'])) > 0, FALSE) AS has_labels
  FROM r3),
parsed AS (SELECT *,
  CASE WHEN answer IS NULL THEN 'no_response' WHEN NOT valid_json THEN 'invalid' WHEN NOT obj THEN 'not_object'
       WHEN has_error AND has_labels THEN 'mixed' WHEN has_error THEN 'error' WHEN list_contains(keys, 'labels') THEN 'nested'
       WHEN len(list_intersect(keys, ['Areas','Scopes','Abilities'])) > 0 THEN 'plural'
       WHEN len(list_intersect(keys, ['Area','Scope','Ability'])) > 0 THEN 'singular' ELSE 'other' END AS shape
  FROM r4)"""


def parsed(spark, sf):
    r = fixture(spark, sf, "fx_responses")
    return P.parse_response(r.select("sample_id", P.extract_answer("response").alias("answer")))


@query("response_extract", f"WITH {_PARSE} SELECT sample_id, answer FROM parsed", ("fx_responses",))
def response_extract(spark, sf):
    r = fixture(spark, sf, "fx_responses")
    return r.select("sample_id", P.extract_answer("response").alias("answer"))


@query("pred_parse", f"WITH {_PARSE} SELECT sample_id, valid_json, error, areas, scopes, abilities, typed FROM parsed", ("fx_responses",))
def pred_parse(spark, sf):
    return parsed(spark, sf).select("sample_id", "valid_json", "error", "areas", "scopes", "abilities", "typed")


_CODES = ", ".join(f"'{c}'" for c in K.ERROR_CODES)


@query(
    "pred_errors",
    f"WITH {_PARSE} SELECT sample_id, error, error IN ({_CODES}) AS known_error FROM parsed WHERE error IS NOT NULL",
    ("fx_responses",),
)
def pred_errors(spark, sf):
    p = parsed(spark, sf).where(F.col("error").isNotNull())
    return p.select("sample_id", "error", F.col("error").isin(*K.ERROR_CODES).alias("known_error"))


@query("pred_alias", f"WITH {_PARSE} SELECT sample_id, shape FROM parsed", ("fx_responses",))
def pred_alias(spark, sf):
    return parsed(spark, sf).select("sample_id", "shape")


@query(
    "pred_exclusive",
    f"WITH {_PARSE} SELECT sample_id, has_error, has_labels, has_error <> has_labels AS exclusive FROM parsed WHERE valid_json",
    ("fx_responses",),
)
def pred_exclusive(spark, sf):
    p = parsed(spark, sf).where("valid_json")
    return p.select("sample_id", "has_error", "has_labels", (F.col("has_error") != F.col("has_labels")).alias("exclusive"))


_MIN = K.MIN_COUNTS


@query(
    "pred_min_counts",
    f"""WITH {_PARSE}, c AS (SELECT sample_id, CAST(coalesce(json_array_length(areas), 0) AS INTEGER) AS n_areas,
      CAST(coalesce(json_array_length(scopes), 0) AS INTEGER) AS n_scopes, CAST(coalesce(json_array_length(abilities), 0) AS INTEGER) AS n_abilities
      FROM parsed WHERE has_labels)
    SELECT *, n_areas >= {_MIN['Area']} AND n_scopes >= {_MIN['Scope']} AND n_abilities >= {_MIN['Ability']} AS meets_min FROM c""",
    ("fx_responses",),
)
def pred_min_counts(spark, sf):
    p = parsed(spark, sf).where("has_labels")
    c = p.select(
        "sample_id",
        P.json_list_size("areas").alias("n_areas"),
        P.json_list_size("scopes").alias("n_scopes"),
        P.json_list_size("abilities").alias("n_abilities"),
    )
    meets = (F.col("n_areas") >= _MIN["Area"]) & (F.col("n_scopes") >= _MIN["Scope"]) & (F.col("n_abilities") >= _MIN["Ability"])
    return c.withColumn("meets_min", meets)


_VERDICT = f"""
lab AS (
  SELECT sample_id, 'Area' AS dim, unnest(from_json(areas, '["VARCHAR"]')) AS term FROM parsed WHERE areas IS NOT NULL
  UNION ALL SELECT sample_id, 'Scope', unnest(from_json(scopes, '["VARCHAR"]')) FROM parsed WHERE scopes IS NOT NULL
  UNION ALL SELECT sample_id, 'Ability', unnest(from_json(abilities, '["VARCHAR"]')) FROM parsed WHERE abilities IS NOT NULL),
flags AS (
  SELECT l.sample_id, bool_or(k.term IS NULL) AS any_unknown, bool_or(k.term IS NOT NULL AND v.term IS NULL) AS any_wrong_dim,
         count(*) > count(DISTINCT l.dim || chr(31) || l.term) AS any_duplicate
  FROM lab l LEFT JOIN (SELECT DISTINCT term FROM vocab) k ON l.term = k.term
  LEFT JOIN vocab v ON l.term = v.term AND l.dim = v.dim
  WHERE l.term IS NOT NULL GROUP BY l.sample_id),
vv AS (
  SELECT p.sample_id, list_filter([
    CASE WHEN shape = 'no_response' THEN 'no_response' END,
    CASE WHEN shape = 'invalid' THEN 'invalid_json' END,
    CASE WHEN shape = 'not_object' THEN 'not_an_object' END,
    CASE WHEN NOT typed THEN 'wrong_type' END,
    CASE WHEN valid_json AND has_error = has_labels THEN 'not_exclusive' END,
    CASE WHEN has_error AND NOT coalesce(error IN ({_CODES}), FALSE) THEN 'unknown_error' END,
    CASE WHEN has_labels AND NOT has_error AND (coalesce(json_array_length(areas), 0) < {_MIN['Area']}
      OR coalesce(json_array_length(scopes), 0) < {_MIN['Scope']} OR coalesce(json_array_length(abilities), 0) < {_MIN['Ability']})
      THEN 'below_min_counts' END,
    CASE WHEN coalesce(any_unknown, FALSE) THEN 'unknown_term' END,
    CASE WHEN coalesce(any_wrong_dim, FALSE) THEN 'wrong_dimension' END,
    CASE WHEN coalesce(any_duplicate, FALSE) THEN 'duplicate_term' END], lambda x: x IS NOT NULL) AS reasons
  FROM parsed p LEFT JOIN flags f ON p.sample_id = f.sample_id)"""


@query(
    "pred_verdicts",
    f"WITH {CONCEPT_CTES}, {_VOCAB}, {_PARSE}, {_VERDICT} SELECT sample_id, len(reasons) = 0 AS valid, array_to_string(reasons, ',') AS reasons FROM vv",
    FR,
)
def pred_verdicts(spark, sf):
    v = P.verdicts(parsed(spark, sf), vocab(spark, sf))
    return v.select("sample_id", "valid", F.array_join("reasons", ",").alias("reasons"))


@query(
    "pred_report",
    f"""WITH {CONCEPT_CTES}, {_VOCAB}, {_PARSE}, {_VERDICT},
    ex AS (SELECT CASE WHEN len(reasons) = 0 THEN ['valid'] ELSE reasons END AS rs FROM vv)
    SELECT reason, count(*) AS n FROM (SELECT unnest(rs) AS reason FROM ex) GROUP BY reason""",
    FR,
)
def pred_report(spark, sf):
    return P.verdict_report(P.verdicts(parsed(spark, sf), vocab(spark, sf)))


# ---- responses to clean labels, end to end ---------------------------------------------------
_LONG = "lab AS (" + " UNION ALL ".join(
    f"SELECT sample_id, '{d}' AS dim, unnest(from_json({c}, '[\"VARCHAR\"]')) AS term, "
    f"unnest(range(json_array_length({c})::BIGINT)) AS pos FROM parsed WHERE {c} IS NOT NULL"
    for d, c in zip(K.DIM_NAMES, ("areas", "scopes", "abilities"))
) + ")"


@query(
    "pred_pipeline",
    f"""WITH RECURSIVE {CONCEPT_CTES}, {_VOCAB}, {_PARSE}, {_LONG},
    known AS (SELECT l.* FROM lab l JOIN vocab v ON v.term = l.term AND v.dim = l.dim),
    dd AS (SELECT sample_id, dim, term, min(pos) AS pos FROM known GROUP BY sample_id, dim, term),
    {_PRUNE}
    SELECT p.sample_id, any_value(p.error) AS error, {_json_by_dim()} AS labels_json
    FROM parsed p LEFT JOIN pruned c ON c.sample_id = p.sample_id GROUP BY p.sample_id""",
    FR,
)
def pred_pipeline(spark, sf):
    """Extract, parse, keep known terms of the right dimension, dedupe, prune, write again: a row per response."""
    # parsed once: labels, samples and errors are read from what is stored
    p = cut_lineage(parsed(spark, sf).select("sample_id", "error", "areas", "scopes", "abilities"), "parsed")
    known = P.long_labels(p).join(vocab(spark, sf), ["term", "dim"], "left_semi")
    clean = P.clean_json(R.prune_covered(known, term_index(spark, sf)), p.select("sample_id"))
    return p.select("sample_id", "error").join(clean, "sample_id")
