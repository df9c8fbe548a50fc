"""JSON text exactly as Python's ``json.dumps`` writes it (FN-08, SNK-01), in built-in expressions.

``", "`` and ``": "`` as separators, keys in order, everything outside printable ASCII as lower-case
``\\uXXXX`` with surrogate pairs, floats in Python's shortest form. Files of these lines are equal
byte for byte, so they can be compared or hashed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelgraph.functions.text import col_

#: FIXED VALUES: the short escapes of JSON strings as Python writes them
ESCAPES = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}

_STRING = r'"(?:[^"\\]++|\\.)*+"'
_TOKEN = _STRING + r"|[-+.0-9eE]++|[A-Za-z]++|[\[\]{}:,]"


def _replaced(c: Column, pairs) -> Column:
    return reduce(lambda out, p: F.replace(out, F.lit(p[0]), F.lit(p[1])), pairs, c)


def _escaped_run(run: Column) -> Column:
    """Characters outside printable ASCII: their UTF-16 units in hex are the escapes' digits, so
    characters beyond the basic plane come out as surrogate pairs."""
    units = F.regexp_replace(F.lower(F.hex(F.encode(run, "UTF-16BE"))), "(.{4})", r"\\u$1")
    return _replaced(units, [(f"\\u{ord(c):04x}", e) for c, e in ESCAPES.items() if not c.isprintable()])


def json_string(c: Column | str) -> Column:
    """A string as Python's JSON; null as ``null``.

    Text of printable ASCII and short escapes takes plain replacements; other text is cut between
    printable and other characters, and only the latter are looked at by unit.
    """
    s = col_(c)
    runs = F.split(s, r"(?<=[ -~])(?=[^ -~])|(?<=[^ -~])(?=[ -~])")
    quotes = [(k, e) for k, e in ESCAPES.items() if k.isprintable()]
    mixed = F.array_join(F.transform(runs, lambda r: F.when(F.rlike(r, F.lit("^[ -~]")), _replaced(r, quotes)).otherwise(_escaped_run(r))), "")
    plain = F.rlike(s, F.lit(r"^[ -~\n\r\t\x08\f]*+\z"))
    body = F.when(plain, _replaced(s, ESCAPES.items())).otherwise(mixed)
    return F.coalesce(F.concat(F.lit('"'), body, F.lit('"')), F.lit("null"))


def _with(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once, however often ``fn`` names it."""
    return F.transform(F.array(value), fn)[0]


def json_float(c: Column | str) -> Column:
    """A double as Python's ``repr``: fewest digits, exponents from 1e16 and below 1e-4."""

    def written(size: Column) -> Column:
        # the JVM's own text has a digit too many at times: the first of 1 to 17 digits that gives the value back
        tries = F.transform(F.sequence(F.lit(0), F.lit(16)), lambda d: F.call_function("format_string", F.concat(F.lit("%."), d.cast("string"), F.lit("E")), size))
        return _with(F.filter(tries, lambda r: r.try_cast("double") == size)[0], in_place)

    def in_place(text: Column) -> Column:  # 1.2345E+10
        digits = F.rtrim(F.replace(F.substring_index(text, "E", 1), F.lit("."), F.lit("")), F.lit("0"))
        return _with(F.struct(digits.alias("digits"), (F.substring_index(text, "E", -1).cast("int") + 1).alias("point")), spread)

    def spread(v: Column) -> Column:  # 0.digits * 10^point
        digits, point, n, power = v["digits"], v["point"], F.length(v["digits"]), v["point"] - 1
        fixed = (
            F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
            .when(point >= n, F.concat(digits, F.repeat(F.lit("0"), point - n), F.lit(".0")))
            .otherwise(F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, n)))
        )
        tail = F.when(n > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), n))).otherwise("")
        science = F.concat(F.substring(digits, 1, 1), tail, F.lit("e"), F.when(power < 0, "-").otherwise("+"), F.format_string("%02d", F.abs(power)))
        return F.when((point > -4) & (point <= 16), fixed).otherwise(science)

    def signed(x: Column) -> Column:
        minus = F.when(F.startswith(x.cast("string"), F.lit("-")), "-").otherwise("")
        size = F.abs(x)
        body = F.when(size == 0, "0.0").when(size == float("inf"), "Infinity").otherwise(written(size))
        return F.when(x.isNull(), "null").when(F.isnan(x), "NaN").otherwise(F.concat(minus, body))

    return _with(col_(c).cast("double"), signed)


def json_list(items: Column, of) -> Column:
    """A list of already typed values, each written by ``of``."""
    return F.coalesce(F.concat(F.lit("["), F.array_join(F.transform(items, of), ", "), F.lit("]")), F.lit("null"))


def json_object(fields: dict[str, Column]) -> Column:
    """An object of JSON texts, keys in the order given."""
    parts: list[Column] = []
    for k, v in fields.items():
        parts += [json_string(F.lit(k)), F.lit(": "), v, F.lit(", ")]
    return F.concat(F.lit("{"), *parts[:-1], F.lit("}"))


def json_of(c: Column, kind: T.DataType) -> Column:
    """JSON of a value of any type JSON has a form for; other types as their text."""
    if isinstance(kind, T.StructType):
        body = json_object({f.name: json_of(c[f.name], f.dataType) for f in kind.fields}) if kind.fields else F.lit("{}")
        return F.when(c.isNull(), "null").otherwise(body)
    if isinstance(kind, T.ArrayType):
        return json_list(c, lambda x: json_of(x, kind.elementType))
    if isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(c), lambda e: F.concat(json_string(e["key"].cast("string")), F.lit(": "), json_of(e["value"], kind.valueType)))
        return F.coalesce(F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}")), F.lit("null"))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return json_float(c)
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return F.coalesce(c.cast("string"), F.lit("null"))
    return json_string(c.cast("string"))


def rewritten(text: Column | str) -> Column:
    """Valid JSON text as ``json.dumps(json.loads(text))`` gives it, without parsing into a type.

    Most text holds printable ASCII without escapes, floats or blanks between tokens, and only
    needs a blank after commas and colons outside strings: one replacement that skips over strings.
    Other text is cut into tokens, and strings and numbers are written anew. An object that repeats
    a key keeps the repeats; a lone surrogate escape becomes ``?`` as Spark's strings hold none.
    """
    t = col_(text)
    simple = F.rlike(t, F.lit(r"^[ -\[\]-~]*+\z")) & ~F.rlike(t, F.lit(r"[-0-9][0-9]*+[.eE]|-0|[\[{,:] | [\]},:]|^ | $"))
    spaced = F.regexp_replace(t, r"\G((?:" + _STRING + r'|[^",:])*+)([,:])', "$1$2 ")

    def token(x: Column) -> Column:
        inner = F.substring(x, F.lit(2), F.length(x) - 2)
        decoded = F.from_json(F.concat(F.lit("["), x, F.lit("]")), "array<string>")[0]
        number = F.when(F.rlike(x, F.lit(r"^-?[0-9]+$")), F.when(x == "-0", "0").otherwise(x)).otherwise(json_float(x.try_cast("double")))
        return (
            F.when(F.startswith(x, F.lit('"')), json_string(F.when(F.contains(x, F.lit("\\")), decoded).otherwise(inner)))
            .when(x.isin(",", ":"), F.concat(x, F.lit(" ")))
            .when(F.rlike(x, F.lit("^-?[0-9]")), number)
            .otherwise(x)
        )

    tokens = F.regexp_extract_all(t, F.lit(_TOKEN), 0)
    return F.when(simple, spaced).otherwise(F.array_join(F.transform(tokens, token), ""))
