"""JSON functions (FN-07..09, PV-01 helpers) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelgraph import constants as K
from labelgraph.functions.pyjson import json_list, json_object, json_string
from labelgraph.functions.text import col_


STRICT = {"allowSingleQuotes": "false"}


def json_is_valid(c: Column | str) -> Column:
    """Validity as Python's ``json.loads`` judges it (the whole text must be one JSON value).

    The JSON reader ignores text behind the first value, so the value is read inside an array
    wrapper (which must hold exactly one element) and inside an object wrapper: trailing text
    breaks at least one of them. Repeated keys are valid whatever the session's settings.
    NULL -> false.
    """
    v = col_(c)
    as_array = F.from_json(F.concat(F.lit("["), v, F.lit("]")), "array<string>", STRICT)
    as_object = F.from_json(F.concat(F.lit('{"v":'), v, F.lit("}")), "map<string,string>", STRICT)
    return F.coalesce((F.size(as_array) == 1) & as_object.isNotNull(), F.lit(False))


def is_json_string(text: Column, value: Column, key: str) -> Column:
    """Whether ``value``, the text of ``key`` in the JSON object ``text``, was a JSON string.

    ``value`` comes from a string column of ``from_json``, which unquotes strings; only a value
    that could be something else is read again as that.
    """

    def read(kind: str) -> Column:
        return F.from_json(text, f"struct<`{key}`:{kind}>", STRICT)[key]

    number = read("double")
    other = (
        F.when(F.startswith(value, F.lit("[")), read("array<string>").isNotNull())
        .when(F.startswith(value, F.lit("{")), read("map<string,string>").isNotNull())
        .when(value.isin("true", "false"), read("boolean").isNotNull())
        .when(F.rlike(value, F.lit(r"^-?[0-9]")), number.isNotNull())
        .otherwise(F.lit(False))
    )
    return value.isNotNull() & ~other


def has_key(entry: Column | str, key: str) -> Column:
    """Key presence in a JSON object (``"k": null`` counts as present). NULL when not an object."""
    return F.array_contains(F.json_object_keys(col_(entry)), key)


def json_value_text(entry: Column | str, key: str) -> Column:
    """Compact JSON text of ``entry[key]``, ``'null'`` for an explicit JSON null, NULL when absent."""
    e = col_(entry)
    raw = F.get_json_object(e, f"$.{key}")
    return F.when(has_key(e, key), F.coalesce(raw, F.lit("null")))


def label_struct(dim: Column, names: Column) -> Column:
    """Fixed-shape label object: ``names`` under the one dimension ``dim``, empty lists elsewhere."""
    empty = F.array().cast("array<string>")
    return F.struct(
        *[F.when(dim == F.lit(d), names).otherwise(empty).alias(key) for d, key in zip(K.DIM_NAMES, K.LABEL_KEYS)]
    )


def label_json(dim: Column, names: Column) -> Column:
    """JSON of :func:`label_struct`, byte-equal to the original's ``json.dumps``."""
    return label_json_listed(dim, json_list(names, json_string))


def label_json_listed(dim: Column, listed: Column) -> Column:
    """:func:`label_json` of a list that is JSON text already."""
    return json_object({key: F.when(dim == F.lit(d), listed).otherwise("[]") for d, key in zip(K.DIM_NAMES, K.LABEL_KEYS)})
