"""Training-sample query keys over fx_entries / fx_meta_files / fx_images."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelgraph import constants as K
from labelgraph.functions.json import has_key
from labelgraph.functions.pyjson import json_of
from labelgraph.operators import samples as S
from labelgraph.plans.fixtures import fixture
from labelgraph.plans.registry import py_list_sql, py_string_sql, query
from labelgraph.session import scratch_path
from labelgraph.sources import jsonl
from labelgraph.sources.meta import explode_entries, quarantine

FE = ("fx_entries", "fx_images")
FM = ("fx_meta_files", "fx_images")


def entries(spark, sf):
    return fixture(spark, sf, "fx_entries")


def images(spark, sf):
    return fixture(spark, sf, "fx_images")


def meta_files(spark, sf):
    return fixture(spark, sf, "fx_meta_files")


# ---- DuckDB twin building blocks ----------------------------------------------------------
def canon_sql(p: str) -> str:
    body = (
        f"array_to_string(list_reduce(string_split({p}, '/'), lambda acc, x: "
        f"CASE WHEN x = '' OR x = '.' OR (x = '..' AND starts_with({p}, '/') AND len(acc) = 0) THEN acc "
        f"WHEN x = '..' AND len(acc) > 0 AND acc[-1] <> '..' THEN acc[1:len(acc)-1] "
        f"ELSE list_append(acc, x) END, []::VARCHAR[]), '/')"
    )
    return f"(CASE WHEN starts_with({p}, '/') THEN '/' ELSE '' END || {body})"


def canon_final(p: str) -> str:
    return f"(CASE WHEN {canon_sql(p)} = '' THEN '.' ELSE {canon_sql(p)} END)"


def lists_object_sql(doc: str, path: str) -> str:
    """An object of string lists inside a JSON text, as Python writes it."""
    own = py_list_sql(f"CAST(json_extract({doc}, '{path}.' || k) AS VARCHAR[])")
    keys = f"list_transform(json_keys({doc}, '{path}'), lambda k: {py_string_sql('k')} || ': ' || {own})"
    return f"('{{' || array_to_string({keys}, ', ') || '}}')"


# labels of the fixture: an object of string lists, a string, or null
_LABELS_SQL = f"""CASE json_type(entry, '$.labels')
      WHEN 'OBJECT' THEN {lists_object_sql('entry', '$.labels')}
      WHEN 'VARCHAR' THEN {py_string_sql("json_extract_string(entry, '$.labels')")}
      ELSE 'null' END"""

CHECK_CTES = f"""
e0 AS (
  SELECT meta_path, pos, entry,
    CASE WHEN position('/' IN meta_path) > 0 THEN regexp_extract(meta_path, '^(.*)/[^/]*$', 1) ELSE '' END AS dir,
    json_valid(entry) AS ok_json
  FROM src_entries),
e1 AS (
  SELECT *, CASE WHEN ok_json AND json_type(entry) = 'OBJECT' THEN TRUE ELSE FALSE END AS is_obj FROM e0),
e2 AS (
  SELECT *,
    CASE WHEN is_obj THEN list_contains(json_keys(entry), 'questionImage') END AS has_image,
    CASE WHEN is_obj THEN list_contains(json_keys(entry), 'labels') END AS has_labels,
    CASE WHEN is_obj THEN json_extract_string(entry, '$.questionImage') END AS rel
  FROM e1),
e3 AS (
  SELECT *,
    CASE WHEN NOT ok_json THEN 'bad_json' WHEN NOT is_obj THEN 'not_an_object'
         WHEN NOT (has_image AND has_labels) THEN 'missing_field'
         WHEN rel IS NULL OR rel = '' OR json_type(entry, '$.questionImage') <> 'VARCHAR' THEN 'bad_image' END AS reason
  FROM e2),
checked AS (
  SELECT meta_path, pos, reason,
    CASE WHEN reason IS NULL THEN replace(CASE WHEN starts_with(rel, '/') OR dir = '' THEN rel
         WHEN ends_with(dir, '/') THEN dir || rel ELSE dir || '/' || rel END, chr(92), '/') END AS image,
    CASE WHEN reason IS NULL THEN {_LABELS_SQL} END AS labels_json
  FROM e3),
checked2 AS (SELECT *, CASE WHEN image IS NOT NULL THEN {canon_final('image')} END AS image_path FROM checked),
listing AS (SELECT DISTINCT {canon_final('path')} AS image_path FROM fx_images),
accepted AS (SELECT c.* FROM checked2 c WHERE c.reason IS NULL AND c.image_path IN (SELECT image_path FROM listing)),
missing AS (SELECT c.* FROM checked2 c WHERE c.reason IS NULL AND c.image_path NOT IN (SELECT image_path FROM listing)),
numbered AS (SELECT *, printf('sample_%06d', row_number() OVER (ORDER BY meta_path, pos) - 1) AS id FROM accepted),
samples AS (
  SELECT id, image, [{{'from': 'human', 'value': '{K.HUMAN_TURN.replace(chr(10), "'||chr(10)||'")}'}},
                     {{'from': 'gpt', 'value': labels_json}}] AS conversations, meta_path, pos, labels_json
  FROM numbered)
"""


def with_entries(body: str, src: str = "SELECT meta_path, pos, entry FROM fx_entries") -> str:
    return f"WITH src_entries AS ({src}), {CHECK_CTES} {body}"


# ---- queries ---------------------------------------------------------------------------------
@query("entries_quarantine", "SELECT meta_path, json_valid(value) AS json_ok FROM fx_meta_files", ("fx_meta_files",))
def entries_quarantine(spark, sf):
    return quarantine(meta_files(spark, sf)).select("meta_path", "json_ok")


_EXPLODE_SQL = """
WITH f AS (SELECT meta_path, value, json_valid(value) AS ok FROM fx_meta_files),
good AS (SELECT meta_path, value FROM f WHERE ok AND json_type(value) = 'ARRAY'),
ex AS (SELECT meta_path, unnest(range(json_array_length(value)::BIGINT)) AS pos, value FROM good),
el AS (SELECT meta_path, pos, json_extract(value, '$[' || pos || ']') AS e FROM ex)
SELECT meta_path, CAST(pos AS INTEGER) AS pos, NULL::VARCHAR AS file_reason,
       CASE WHEN json_type(e) = 'OBJECT' THEN array_to_string(json_keys(e), ',') END AS keys FROM el
UNION ALL
SELECT meta_path, NULL, CASE WHEN NOT ok THEN 'bad_json' ELSE 'not_a_list' END, NULL FROM f
WHERE NOT ok OR json_type(value) <> 'ARRAY'
"""


@query("entries_explode", _EXPLODE_SQL, ("fx_meta_files",))
def entries_explode(spark, sf):
    ex = explode_entries(meta_files(spark, sf))
    return ex.select("meta_path", "pos", "file_reason", F.array_join(F.json_object_keys("entry"), ",").alias("keys"))


@query(
    "entries_required",
    with_entries("SELECT meta_path, pos, has_image, has_labels, coalesce(has_image AND has_labels, FALSE) AS required_ok FROM e2"),
    FE,
)
def entries_required(spark, sf):
    e = entries(spark, sf)
    hi, hl = has_key("entry", "questionImage"), has_key("entry", "labels")
    return e.select("meta_path", "pos", hi.alias("has_image"), hl.alias("has_labels"), F.coalesce(hi & hl, F.lit(False)).alias("required_ok"))


@query("entries_paths", with_entries("SELECT meta_path, pos, image, image_path FROM checked2 WHERE reason IS NULL"), FE)
def entries_paths(spark, sf):
    c = S.check_entries(entries(spark, sf))
    return c.where(F.col("reason").isNull()).select("meta_path", "pos", "image", "image_path")


@query("entries_image_semi", with_entries("SELECT meta_path, pos, image_path FROM accepted"), FE)
def entries_image_semi(spark, sf):
    c = S.check_entries(entries(spark, sf)).where(F.col("reason").isNull())
    return S.image_exists_filtered(c, images(spark, sf), keep=True).select("meta_path", "pos", "image_path")


@query("entries_image_anti", with_entries("SELECT meta_path, pos, image_path FROM missing"), FE)
def entries_image_anti(spark, sf):
    c = S.check_entries(entries(spark, sf)).where(F.col("reason").isNull())
    return S.image_exists_filtered(c, images(spark, sf), keep=False).select("meta_path", "pos", "image_path")


@query("entries_labels_json", with_entries("SELECT meta_path, pos, labels_json FROM checked2 WHERE reason IS NULL"), FE)
def entries_labels_json(spark, sf):
    c = S.check_entries(entries(spark, sf))
    return c.where(F.col("reason").isNull()).select("meta_path", "pos", "labels_json")


@query("sample_ids", with_entries("SELECT meta_path, pos, id FROM numbered"), FE)
def sample_ids(spark, sf):
    acc, _ = S.accept_and_reject(entries(spark, sf), images(spark, sf))
    return S.assign_ids(acc).select("meta_path", "pos", "id")


@query("conversation_struct", with_entries("SELECT id, CAST(to_json(conversations) AS VARCHAR) AS conversations_json FROM samples"), FE)
def conversation_struct(spark, sf):
    s = S.training_samples(entries(spark, sf), images(spark, sf))
    return s.select("id", F.to_json("conversations").alias("conversations_json"))


_SAMPLE_COLS = "SELECT id, image, conversations[1].value AS human, conversations[2].value AS gpt FROM samples"


def _sample_cols(df, *more):
    return df.select("id", "image", df.conversations[0]["value"].alias("human"), df.conversations[1]["value"].alias("gpt"), *more)


def _sample_line_sql() -> str:
    """The whole line of the output file, byte for byte."""
    turns = ", ".join(
        f"""{{"from": "{role}", "value": ' || {py_string_sql(f'conversations[{i}].value')} || '}}""" for i, role in enumerate((K.HUMAN_ROLE, K.ASSISTANT_ROLE), 1)
    )
    return f"""('{{"id": "' || id || '", "image": ' || {py_string_sql('image')} || ', "conversations": [{turns}]}}')"""


@query("train_samples", with_entries(f"{_SAMPLE_COLS.replace(' FROM samples', '')}, {_sample_line_sql()} AS line FROM samples"), FE)
def train_samples(spark, sf):
    s = S.training_samples(entries(spark, sf), images(spark, sf))
    row = F.struct("id", "image", "conversations")
    return _sample_cols(s.select("id", "image", "conversations", json_of(row, jsonl.SAMPLE_SCHEMA).alias("line")), "line")


@query("jsonl_roundtrip", with_entries(_SAMPLE_COLS), FE)
def jsonl_roundtrip(spark, sf):
    """Write the samples as JSONL into the shared folder, read them back with a declared schema."""
    s = S.training_samples(entries(spark, sf), images(spark, sf)).select("id", "image", "conversations")
    path = scratch_path(spark, "jsonl_roundtrip")
    jsonl.write_jsonl(s, path)
    return _sample_cols(jsonl.read_samples(spark, path))


_ANNOT_SQL = f"""
ann AS (
  SELECT id, CASE WHEN CAST(substr(id, 8) AS BIGINT) % 2 = 0 AND starts_with(labels_json, '{{')
    THEN '{{"id":"' || id || '","image":"' || image || '","conversations":' || labels_json || '}}'
    ELSE to_json({{'id': id, 'image': image, 'conversations': conversations}}) END AS line
  FROM samples),
conv AS (SELECT id, line, json_type(line, '$.conversations') AS kind FROM ann)
SELECT id, CASE kind WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'list' END AS shape,
       CASE kind WHEN 'OBJECT' THEN {lists_object_sql('line', '$.conversations')} ELSE json_extract_string(line, '$.conversations[1].value') END AS answer
FROM conv"""


def annotation_lines(samples):
    """Annotation JSONL text in both shapes: label object (even ids) or two-turn list."""
    gpt = samples.conversations[1]["value"]
    even = (F.substring("id", 8, 100).cast("long") % 2 == 0) & F.startswith(gpt, F.lit("{"))
    obj = F.concat(F.lit('{"id":"'), "id", F.lit('","image":"'), "image", F.lit('","conversations":'), gpt, F.lit("}"))
    lst = F.to_json(F.struct("id", "image", "conversations"))
    return samples.select("id", F.when(even, obj).otherwise(lst).alias("line"))


@query("annotation_normalise", with_entries(", " + _ANNOT_SQL.strip()), FE)
def annotation_normalise(spark, sf):
    lines = annotation_lines(S.training_samples(entries(spark, sf), images(spark, sf)))
    return lines.select("id", S.annotation_shape("line").alias("shape"), S.normalise_annotation("line").alias("answer"))


@query("answer_pick", with_entries("SELECT id, conversations[2].value AS answer FROM samples"), FE)
def answer_pick(spark, sf):
    s = S.training_samples(entries(spark, sf), images(spark, sf))
    return s.select("id", S.answer_pick("conversations").alias("answer"))


_REPORT_SQL = f"""
WITH f AS (SELECT meta_path, value, json_valid(value) AS ok FROM fx_meta_files),
good AS (SELECT meta_path, value FROM f WHERE ok AND json_type(value) = 'ARRAY'),
ex AS (SELECT meta_path, unnest(range(json_array_length(value)::BIGINT)) AS pos, value FROM good),
src_entries AS (SELECT meta_path, CAST(pos AS INTEGER) AS pos, json_extract(value, '$[' || pos || ']')::VARCHAR AS entry FROM ex),
{CHECK_CTES},
all_rejects AS (
  SELECT reason FROM checked2 WHERE reason IS NOT NULL
  UNION ALL SELECT 'image_not_found' FROM missing
  UNION ALL SELECT CASE WHEN NOT ok THEN 'bad_json' ELSE 'not_a_list' END FROM f WHERE NOT ok OR json_type(value) <> 'ARRAY'
  UNION ALL SELECT 'accepted' FROM accepted)
SELECT reason, count(*) AS n FROM all_rejects GROUP BY reason
"""


@query("entries_reject_report", _REPORT_SQL, FM)
def entries_reject_report(spark, sf):
    ex = explode_entries(meta_files(spark, sf))
    return S.reject_report(S.outcomes(ex, images(spark, sf), from_valid_file=True))
