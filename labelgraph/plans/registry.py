"""Query registry: each key pairs a Spark plan ``(spark, sf_dir) -> DataFrame`` with an
optional DuckDB twin (ANSI-ish SQL over the driver's tables, fixtures inlined as CTEs).
Keys without a twin are checked rows-only by the driver and by pytest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from labelgraph import constants as K
from labelgraph.plans.fixtures import with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, fixtures: tuple[str, ...] = ()):
    """Register a Spark plan under ``name`` and (when given) its DuckDB twin."""

    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_fixtures(sql, *fixtures)
        return fn

    return deco


# ---- SQL snippets shared by the DuckDB twins --------------------------------------------
WS = "||".join(f"chr({ord(c)})" for c in K.PY_WHITESPACE)


def strip_sql(x: str) -> str:
    return f"trim({x}, {WS})"


def lname_sql(x: str) -> str:
    return f"string_split({x}, '#')[-1]"


NL2 = "chr(10)||chr(10)"

CONCEPT_CTES = f"""
ctypes AS (
  SELECT DISTINCT s AS iri,
    CASE o WHEN 'urn:t#Area' THEN 'Area' WHEN 'urn:t#Scope' THEN 'Scope' ELSE 'Ability' END AS dim,
    CASE o WHEN 'urn:t#Area' THEN 1 WHEN 'urn:t#Scope' THEN 2 ELSE 3 END AS priority
  FROM fx_triples
  WHERE p = 'type' AND o IN ('urn:t#Area','urn:t#Scope','urn:t#Ability')
    AND NOT starts_with(s, '_:') AND s NOT IN ('urn:t#Area','urn:t#Scope','urn:t#Ability')),
concepts AS (SELECT DISTINCT iri, {lname_sql('iri')} AS name FROM ctypes),
cdim AS (SELECT iri, CASE min(priority) WHEN 1 THEN 'Area' WHEN 2 THEN 'Scope' ELSE 'Ability' END AS dim
         FROM ctypes GROUP BY iri),
defs AS (SELECT s AS iri, (list(o ORDER BY pos, o))[1] AS definition FROM fx_triples WHERE p = 'isDefinedBy' GROUP BY s),
cmts AS (SELECT s AS iri, list(o ORDER BY pos, o) AS comments FROM fx_triples WHERE p = 'comment' GROUP BY s),
ctext0 AS (
  SELECT c.iri, c.name, d.definition, coalesce(m.comments, []::VARCHAR[]) AS comments,
         (d.definition IS NOT NULL AND length(d.definition) > 0) AS def_ok
  FROM concepts c LEFT JOIN defs d ON c.iri = d.iri LEFT JOIN cmts m ON c.iri = m.iri),
ctext AS (
  SELECT iri, name, definition, comments, (def_ok OR len(comments) > 0) AS has_text_source,
    CASE WHEN def_ok THEN {strip_sql('definition')} WHEN len(comments) > 0 THEN {strip_sql('comments[1]')} ELSE '' END AS text,
    CASE WHEN def_ok THEN comments ELSE comments[2:] END AS rest
  FROM ctext0),
edges AS (
  SELECT s AS child, o AS parent,
    CASE p WHEN 'partOfArea' THEN 'Area' WHEN 'partOfScope' THEN 'Scope' ELSE 'Ability' END AS dim
  FROM fx_triples WHERE p IN ('partOfArea','partOfScope','partOfAbility'))
"""


def py_string_sql(x: str) -> str:
    """DuckDB text of a string as Python's ``json.dumps`` writes it, code point by code point."""
    short = {'"': r'\"', "\\": "\\\\", "\n": r"\n", "\r": r"\r", "\t": r"\t", "\b": r"\b", "\f": r"\f"}
    cases = " ".join(f"WHEN {ord(c)} THEN '{e}'" for c, e in short.items())
    unit = r"printf('\u%04x', {})"
    pair = f"{unit.format('55296 + (u - 65536) // 1024')} || {unit.format('56320 + (u - 65536) % 1024')}"
    one = f"CASE u {cases} ELSE CASE WHEN u BETWEEN 32 AND 126 THEN chr(u) WHEN u < 65536 THEN {unit.format('u')} ELSE {pair} END END"
    points = f"list_transform(range(1, length({x}) + 1), lambda i: CAST(unicode(substring({x}, CAST(i AS INT), 1)) AS INT))"
    slow = f"array_to_string(list_transform({points}, lambda u: {one}), '')"
    plain = f"regexp_full_match({x}, '[ !#-\\[\\]-~]*')"
    return f"""('"' || CASE WHEN {plain} THEN {x} ELSE {slow} END || '"')"""


def py_list_sql(items: str) -> str:
    return f"('[' || array_to_string(list_transform({items}, lambda s: {py_string_sql('s')}), ', ') || ']')"


def label_json_sql(dim: str, names: str) -> str:
    parts = []
    for d, key in zip(K.DIM_NAMES, K.LABEL_KEYS):
        parts.append(f""" '"{key}": ' || CASE WHEN {dim} = '{d}' THEN {py_list_sql(names)} ELSE '[]' END """)
    return "('{' || " + "|| ', ' ||".join(parts) + "|| '}')"
