"""JSON text against Python's own ``json`` module."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelgraph.functions import pyjson as J
from labelgraph.sources import jsonl

STRINGS = [
    "", "plain", 'quo"te', "back\\slash", "\\u00e9 stays", "tab\t nl\n cr\r bs\b ff\f", "\x00\x01\x1f\x7f\x80", "é ü ß", "日本語", "😀 astral \U0001f9ea\U0010ffff",
    "a😀b", "  ﻿", "mixed é\n\"\\", "é", "/slash/", "x" * 3000 + "é", "\n\n", " ", "~\x7f~", "\U00010000", "퟿￿",
]


def test_strings(spark):
    rng = random.Random(1)
    alphabet = ['"', "\\", "\n", "a", "Z", "~", " ", "é", "😀", "\x7f", "\x1b", " ", "u", "0"]
    rows = [(s,) for s in [*STRINGS, *("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(400)), None]]
    got = spark.createDataFrame(rows, "s string").select("s", J.json_string("s").alias("j")).collect()
    for r in got:
        assert r.j == json.dumps(r.s), repr(r.s)


def test_floats(spark):
    rng = random.Random(2)
    values = [0.0, -0.0, 1.0, -1.5, 0.1, 1e15, 1e16, 123456789012345680.0, 9999999999999998.0, 1e-4, 1e-5, 1.5e-7, 1e22, 1e23, 5e-324, 1.7976931348623157e308, 100.0]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-30, 30) for _ in range(500)] + [float(rng.randint(-(10**17), 10**17)) for _ in range(100)]
    values += [float("inf"), float("-inf"), float("nan"), None]
    got = spark.createDataFrame([(v,) for v in values], "x double").select("x", J.json_float("x").alias("j")).collect()
    for v, r in zip(values, got):
        assert r.j == json.dumps(v), v


def test_values_of_any_type(spark):
    schema = T.StructType.fromDDL("i long, b boolean, d double, s string, l array<string>, o struct<x: int, y: array<struct<z: string>>>, m map<string, double>, e array<int>")
    rows = [
        (1, True, 2.5, "é\n", ["a", None, "😀"], (1, [("z",), (None,)]), {"k é": 1e20}, []),
        (None, None, None, None, None, None, None, None),
        (-(2**62), False, 1e-9, "", [], (None, None), {}, [1, None]),
    ]
    df = spark.createDataFrame(rows, schema)
    lines = [r.j for r in df.select(J.json_of(F.struct(*df.columns), df.schema).alias("j")).collect()]
    for line, r in zip(lines, df.collect()):
        assert line == json.dumps(r.asDict(recursive=True))


JSON_TEXTS = [
    '{"Areas":["A","B"],"Scopes":[],"Abilities":["x, y: z"]}', "[]", "{}", "null", "true", "5", "-0", "1.50", "1e5", "-2E-7", "12345678901234567890123", '"text"', '""',
    '{"a" : [ 1 , 2.0,{"b":null} ] }', '["\\u00e9","\\/","\\ud83d\\ude00","q\\"uote\\\\","tab\\t","\\u007f"]', '["é😀 "]', '{"k:,k":",:"}', '[" a"," ,","x ]"]',
    '{"nested":{"deep":[[["é"]]],"n":[-1,0,1e400,-1e400]}}', '  [1]  ', '["1.5e3",{"-0":"-0"}]', '[0.1,100.0,1E2]', '["' + "long " * 2000 + 'é"]',
]


def test_rewritten_text(spark):
    got = spark.createDataFrame([(t,) for t in JSON_TEXTS], "t string").select("t", J.rewritten("t").alias("j")).collect()
    for r in got:
        assert r.j == json.dumps(json.loads(r.t)), r.t


def test_random_documents(spark):
    rng = random.Random(3)

    def value(depth):
        kind = rng.randint(0, 7 if depth else 4)
        if kind == 0:
            return rng.choice([None, True, False])
        if kind == 1:
            return rng.randint(-(10**6), 10**6)
        if kind == 2:
            return rng.choice([0.5, 1e18, -3.25e-9, 2.0])
        if kind in (3, 4):
            return rng.choice(STRINGS)
        if kind in (5, 6):
            return [value(depth - 1) for _ in range(rng.randint(0, 3))]
        return {rng.choice(STRINGS) + str(i): value(depth - 1) for i in range(rng.randint(0, 3))}

    values = [value(3) for _ in range(300)]
    texts = [json.dumps(v, ensure_ascii=rng.random() < 0.5, separators=rng.choice([(",", ":"), (", ", ": "), (" , ", " : ")])) for v in values]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", J.rewritten("t").alias("j")).collect()
    for r in rows:
        assert r.j == json.dumps(values[r.i]), texts[r.i]


def test_lines_equal_python_files(spark, tmp_path):
    rows = [(f"sample_{i:06d}", f"data/é/{i}.png", [("human", "<image>\nClassify"), ("gpt", json.dumps({"Areas": [s]}))]) for i, s in enumerate(STRINGS)]
    df = spark.createDataFrame(rows, jsonl.SAMPLE_SCHEMA)
    path = str(tmp_path / "lines")
    assert jsonl.write_jsonl(df.coalesce(1), path) == len(rows)
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "lines").glob("part-*")))
    want = "".join(json.dumps({"id": i, "image": im, "conversations": [{"from": a, "value": b} for a, b in c]}) + "\n" for i, im, c in rows)
    assert raw.decode() == want
    assert sorted(map(str, jsonl.read_samples(spark, path).collect())) == sorted(map(str, df.collect()))


@pytest.mark.parametrize("skip", [True, False])
def test_empty_output(spark, tmp_path, skip):
    df = spark.createDataFrame([], jsonl.QA_SCHEMA)
    assert jsonl.write_jsonl(df, str(tmp_path / "none"), skip_empty=skip) == 0
    assert (tmp_path / "none").exists() is not skip
