"""Ontology and Q&A query keys over ``fx_triples``."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelgraph import constants as K
from labelgraph.functions.json import label_json, label_struct
from labelgraph.functions.text import example_prefix_always, example_prefix_if_missing, local_name, strip
from labelgraph.operators import ontology as O
from labelgraph.operators import qa as Q
from labelgraph.operators import segments as SG
from labelgraph.plans.fixtures import fixture
from labelgraph.plans.registry import CONCEPT_CTES, NL2, label_json_sql, lname_sql, query, strip_sql

V = O.Vocab.bare()
FX = ("fx_triples",)
SEP = chr(30)  # record separator used to flatten string lists for value hashing


def tri(spark, sf):
    return fixture(spark, sf, "fx_triples")


@query("triple_match", "SELECT s, o FROM fx_triples WHERE p = 'type' AND o = 'urn:t#Area'", FX)
def triple_match(spark, sf):
    return O.match(tri(spark, sf), p="type", o="urn:t#Area").select("s", "o")


@query("concepts", f"WITH {CONCEPT_CTES} SELECT iri, name FROM concepts", FX)
def concepts(spark, sf):
    return O.concepts(tri(spark, sf), V)


@query("local_name", f"SELECT DISTINCT s, {lname_sql('s')} AS name FROM fx_triples", FX)
def local_name_q(spark, sf):
    return tri(spark, sf).select("s", local_name("s").alias("name")).distinct()


@query(
    "concept_definition",
    f"WITH {CONCEPT_CTES} SELECT c.iri, d.definition FROM concepts c LEFT JOIN defs d ON c.iri = d.iri",
    FX,
)
def concept_definition(spark, sf):
    t = tri(spark, sf)
    return O.concepts(t, V).join(O.definitions(t, V), "iri", "left").select("iri", "definition")


@query(
    "concept_comments",
    f"""WITH {CONCEPT_CTES}
    SELECT c.iri, CAST(coalesce(len(m.comments), 0) AS INTEGER) AS n_comments, array_to_string(m.comments, chr(30)) AS comments
    FROM concepts c LEFT JOIN cmts m ON c.iri = m.iri""",
    FX,
)
def concept_comments(spark, sf):
    t = tri(spark, sf)
    df = O.concepts(t, V).join(O.comments(t, V), "iri", "left")
    return df.select(
        "iri",
        F.coalesce(F.size("comments"), F.lit(0)).alias("n_comments"),
        F.array_join("comments", SEP).alias("comments"),
    ).withColumn("n_comments", F.when(F.col("comments").isNull(), 0).otherwise(F.col("n_comments")))


@query("concept_dim", f"WITH {CONCEPT_CTES} SELECT iri, dim FROM cdim", FX)
def concept_dim(spark, sf):
    return O.concept_dim(tri(spark, sf), V)


@query(
    "concept_text",
    f"""WITH {CONCEPT_CTES}
    SELECT iri, has_text_source, text, CAST(len(rest) AS INTEGER) AS n_rest, array_to_string(rest, chr(30)) AS rest FROM ctext""",
    FX,
)
def concept_text(spark, sf):
    t = O.concept_text(tri(spark, sf), V)
    return t.select("iri", "has_text_source", "text", F.size("rest").alias("n_rest"), F.array_join("rest", SEP).alias("rest"))


@query("fn_strip", f"SELECT s, pos, {strip_sql('o')} AS text FROM fx_triples WHERE p = 'isDefinedBy'", FX)
def fn_strip(spark, sf):
    return O.match(tri(spark, sf), p="isDefinedBy").select("s", "pos", strip("o").alias("text"))


@query(
    "fn_example_cond",
    f"""SELECT s, pos, CASE WHEN starts_with(lower({strip_sql('o')}), 'example:') THEN {strip_sql('o')}
                          ELSE 'Example: '||{strip_sql('o')} END AS text
        FROM fx_triples WHERE p = 'comment'""",
    FX,
)
def fn_example_cond(spark, sf):
    return O.match(tri(spark, sf), p="comment").select("s", "pos", example_prefix_if_missing("o").alias("text"))


@query(
    "fn_example_always",
    f"SELECT s, pos, 'Example: '||{strip_sql('o')} AS text FROM fx_triples WHERE p = 'comment'",
    FX,
)
def fn_example_always(spark, sf):
    return O.match(tri(spark, sf), p="comment").select("s", "pos", example_prefix_always("o").alias("text"))


@query(
    "label_struct",
    f"""WITH {CONCEPT_CTES}
    SELECT c.iri,
      array_to_string(CASE WHEN dim = 'Area' THEN [c.name] ELSE []::VARCHAR[] END, ',') AS areas,
      array_to_string(CASE WHEN dim = 'Scope' THEN [c.name] ELSE []::VARCHAR[] END, ',') AS scopes,
      array_to_string(CASE WHEN dim = 'Ability' THEN [c.name] ELSE []::VARCHAR[] END, ',') AS abilities
    FROM concepts c JOIN cdim d ON c.iri = d.iri""",
    FX,
)
def label_struct_q(spark, sf):
    t = tri(spark, sf)
    df = O.concepts(t, V).join(O.concept_dim(t, V), "iri")
    s = label_struct(F.col("dim"), F.array("name"))
    return df.select(
        "iri",
        *[F.array_join(s[key], ",").alias(alias) for key, alias in zip(K.LABEL_KEYS, ("areas", "scopes", "abilities"))],
    )


@query(
    "label_json",
    f"""WITH {CONCEPT_CTES}
    SELECT c.iri, {label_json_sql('dim', '[c.name]')} AS label FROM concepts c JOIN cdim d ON c.iri = d.iri""",
    FX,
)
def label_json_q(spark, sf):
    t = tri(spark, sf)
    df = O.concepts(t, V).join(O.concept_dim(t, V), "iri")
    return df.select("iri", label_json(F.col("dim"), F.array("name")).alias("label"))


@query(
    "children_per_parent",
    f"""WITH {CONCEPT_CTES}
    SELECT parent, CAST(count(*) AS INTEGER) AS n_children,
           array_to_string(list_sort(list({lname_sql('child')})), ',') AS children
    FROM edges GROUP BY parent""",
    FX,
)
def children_per_parent(spark, sf):
    c = O.children_per_parent(tri(spark, sf), V)
    return c.select("parent", F.size("children").alias("n_children"), F.array_join("children", ",").alias("children"))


@query("parent_per_child", f"WITH {CONCEPT_CTES} SELECT child, min(parent) AS parent FROM edges GROUP BY child", FX)
def parent_per_child(spark, sf):
    return O.parent_per_child(tri(spark, sf), V)


@query("edges", f"WITH {CONCEPT_CTES} SELECT child, parent, dim FROM edges", FX)
def edges(spark, sf):
    return O.edges(tri(spark, sf), V)


# ---- Q&A generators ---------------------------------------------------------------------
_QA_FORWARD_SQL = f"""
SELECT iri, 'What is the ontological concept '''||name||'''?' AS instruction,
  array_to_string(list_concat([text], list_transform(rest, lambda c:
      CASE WHEN starts_with(lower({strip_sql('c')}), 'example:') THEN {strip_sql('c')} ELSE 'Example: '||{strip_sql('c')} END)),
    {NL2}) AS output
FROM ctext WHERE has_text_source"""

_QA_REVERSE_SQL = f"""
qr AS (SELECT iri, name, text||array_to_string(list_transform(rest, lambda c: {NL2}||'Example: '||{strip_sql('c')}), '')
              AS instruction FROM ctext)
SELECT q.iri, q.instruction, {label_json_sql('d.dim', '[q.name]')} AS output
FROM qr q JOIN cdim d ON q.iri = d.iri WHERE length(q.instruction) > 0"""

_QA_DEF_SQL = f"""
SELECT t.iri, t.text AS instruction, {label_json_sql('d.dim', '[t.name]')} AS output
FROM ctext t JOIN cdim d ON t.iri = d.iri WHERE length(t.text) > 0"""

_PC_CTE = "pc AS (SELECT child, min(parent) AS parent FROM edges GROUP BY child)"
_CP_CTE = f"cp AS (SELECT parent, list_sort(list({lname_sql('child')})) AS children FROM edges GROUP BY parent)"

_QA_CHILD_SEL = f"""
SELECT pc.child, 'What is the parent of the concept '''||{lname_sql('pc.child')}||'''?' AS instruction,
       {label_json_sql('d.dim', f"[{lname_sql('pc.parent')}]")} AS output
FROM pc JOIN cdim d ON pc.parent = d.iri"""

_QA_PARENT_SEL = f"""
SELECT cp.parent, 'What are the children of the concept '''||{lname_sql('cp.parent')}||'''?' AS instruction,
       {label_json_sql('d.dim', 'cp.children')} AS output
FROM cp JOIN cdim d ON cp.parent = d.iri"""


@query("qa_forward", f"WITH {CONCEPT_CTES} {_QA_FORWARD_SQL}", FX)
def qa_forward(spark, sf):
    return Q.qa_forward(tri(spark, sf), V)


@query("qa_reverse", f"WITH {CONCEPT_CTES}, {_QA_REVERSE_SQL}", FX)
def qa_reverse(spark, sf):
    return Q.qa_reverse(tri(spark, sf), V)


@query("qa_def_label", f"WITH {CONCEPT_CTES} {_QA_DEF_SQL}", FX)
def qa_def_label(spark, sf):
    return Q.qa_def_label(tri(spark, sf), V)


@query("qa_child_parent", f"WITH {CONCEPT_CTES}, {_PC_CTE} {_QA_CHILD_SEL}", FX)
def qa_child_parent(spark, sf):
    return Q.qa_child_parent(tri(spark, sf), V)


@query("qa_parent_children", f"WITH {CONCEPT_CTES}, {_CP_CTE} {_QA_PARENT_SEL}", FX)
def qa_parent_children(spark, sf):
    return Q.qa_parent_children(tri(spark, sf), V)


# small segments, so that ordinary parents have several
_SEGMENT = 3


@query(
    "children_segments",
    f"""WITH {CONCEPT_CTES}, n AS (SELECT parent, {lname_sql('child')} AS name,
      row_number() OVER (PARTITION BY parent ORDER BY {lname_sql('child')}) - 1 AS i FROM edges)
    SELECT parent, CAST(i // {_SEGMENT} AS BIGINT) AS segment, count(*) AS n, string_agg(name, ',' ORDER BY name) AS text
    FROM n GROUP BY parent, i // {_SEGMENT}""",
    FX,
)
def children_segments(spark, sf):
    return SG.child_segments(tri(spark, sf), V, size=_SEGMENT)


@query(
    "comment_segments",
    f"""WITH n AS (SELECT s, o, pos, row_number() OVER (PARTITION BY s ORDER BY pos, o) - 1 AS i FROM fx_triples WHERE p = 'comment')
    SELECT s AS iri, CAST(i // {_SEGMENT} AS BIGINT) AS segment, count(*) AS n, string_agg(o, chr(30) ORDER BY pos, o) AS text
    FROM n GROUP BY s, i // {_SEGMENT}""",
    FX,
)
def comment_segments(spark, sf):
    return SG.comment_segments(tri(spark, sf), V, sep=SEP, size=_SEGMENT)


@query("qa_parent_children_segments", f"WITH {CONCEPT_CTES}, {_CP_CTE} {_QA_PARENT_SEL}", FX)
def qa_parent_children_segments(spark, sf):
    return SG.qa_parent_children(tri(spark, sf), V, size=_SEGMENT)


_QA_FULL_SQL = f"""WITH {CONCEPT_CTES}, {_PC_CTE}, {_CP_CTE},
qdef AS ({_QA_DEF_SQL}),
qchild AS ({_QA_CHILD_SEL}),
qpar AS ({_QA_PARENT_SEL}),
qa_full AS (
  SELECT 'definition' AS part, iri AS key, instruction, output FROM qdef
  UNION ALL SELECT 'child_parent', child, instruction, output FROM qchild
  UNION ALL SELECT 'parent_children', parent, instruction, output FROM qpar)
"""


@query("qa_full", _QA_FULL_SQL + "SELECT part, key, instruction, output FROM qa_full", FX)
def qa_full(spark, sf):
    return Q.qa_full(tri(spark, sf), V)


@query("qa_ordered", f"WITH {CONCEPT_CTES} {_QA_DEF_SQL} ORDER BY t.iri", FX)
def qa_ordered(spark, sf):
    # global order only at the sink: range-partitioned sort, no single-partition window
    return Q.qa_def_label(tri(spark, sf), V).orderBy("iri")


@query("qa_counts", _QA_FULL_SQL + "SELECT part, count(*) AS n FROM qa_full GROUP BY part", FX)
def qa_counts(spark, sf):
    return Q.qa_counts(Q.qa_full(tri(spark, sf), V))


# ---- RDF/XML scan (SRC-01): serialise the fixture graph, scan it back ---------------------------
@query("triple_scan", "SELECT DISTINCT s, p, o, o_kind FROM fx_triples", FX)
def triple_scan(spark, sf):
    from labelgraph.session import scratch_path
    from labelgraph.sources.rdf import scan_rdfxml, write_rdfxml

    path = scratch_path(spark, "rdfxml")
    write_rdfxml(tri(spark, sf), path)
    return scan_rdfxml(spark, path, prefixes={"p": ""}).select("s", "p", "o", "o_kind")
