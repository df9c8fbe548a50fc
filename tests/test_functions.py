"""Column-level helpers on literal inputs (edge cases named in SURVEY §2 and §7.4)."""

import os

from pyspark.sql import functions as F

from conftest import DATA
from labelgraph.functions import chat as C
from labelgraph.functions.json import json_is_valid
from labelgraph.functions.text import local_name, strip, ws_tokens
from labelgraph.operators import predictions as P
from labelgraph.operators import samples as S
from labelgraph.operators import tokens as T
from labelgraph.sources.prompt import read_prompt


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_strip_and_split_follow_python(spark):
    s = " \t a  b c\x1f\n"
    assert one(spark, strip("v"), s) == s.strip()
    assert one(spark, ws_tokens("v"), s) == s.split()
    assert one(spark, ws_tokens("v"), " \n ") == []


def test_local_name(spark):
    assert one(spark, local_name("v"), "urn:a#b#c") == "c"
    assert one(spark, local_name("v"), "_:b0") == "_:b0"


def test_json_validity_is_strict(spark):
    cases = {'{"a": 1}': True, "[1] x": False, "1],[2": False, "": False, '"s"': True, "{": False, " [1] ": True}
    for text, want in cases.items():
        assert one(spark, json_is_valid("v"), text) is want, text


def test_response_extract_modes(spark):
    r = "system\ns\nuser\nu\nassistant\n {\"a\": 1} \nassistant\nmore"
    assert one(spark, P.extract_answer("v"), r) == '{"a": 1}'
    assert one(spark, P.extract_answer("v", tail=True), r) == '{"a": 1} \nassistant\nmore'
    assert one(spark, P.extract_answer("v"), "no marker") is None


def test_canonical_path(spark):
    import posixpath

    for p in ["a/b/../c", "/../x", "../../a/./b//c/", "a/..", "", "./", "/", "x/../../y"]:
        assert one(spark, S.canonical_path("v"), p) == posixpath.normpath(p), p


def test_token_helpers(spark):
    df = spark.createDataFrame([([1, 2, 3],)], "ids array<int>")
    ids, mask = T.truncate_pad("ids", max_length=5)
    row = df.select(ids.alias("i"), mask.alias("m"), T.argmax(F.array(F.lit(1.0), F.lit(3.0), F.lit(3.0))).alias("a")).first()
    assert row.i == [1, 2, 3, 0, 0] and row.m == [1, 1, 1, 0, 0] and row.a == 1
    lab = df.select(T.causal_labels(ids, mask).alias("l")).first().l
    assert lab == [1, 2, 3, -100, -100]


def test_chat_layouts(spark):
    t = one(spark, C.two_turn_text(F.lit("q"), F.lit("a")), "x")
    assert t == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\na<|im_end|>"
    inf = one(spark, C.inference_layout(F.lit("P")), "x")
    assert inf.endswith("<|im_start|>assistant\n") and "<|vision_start|><|image_pad|><|vision_end|>P" in inf


def test_read_prompt(spark):
    assert read_prompt(spark, os.path.join(DATA, "prompt.txt")) == open(os.path.join(DATA, "prompt.txt")).read()


def test_ws_class_equals_python_isspace(spark):
    # every code point up to U+3000 (the largest whitespace one): 'a<c>b' splits like Python
    rows = [(i, "a" + chr(i) + "b") for i in range(1, 0x3001) if not 0xD800 <= i <= 0xDFFF]
    df = spark.createDataFrame(rows, "i int, v string")
    got = {r.i: r.n for r in df.select("i", F.size(ws_tokens("v")).alias("n")).collect()}
    assert all(got[i] == len(v.split()) for i, v in rows)
