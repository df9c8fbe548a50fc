"""String functions (FN-01..06, FN-10, PRJ-03) as Column -> Column expressions.

All of these stay inside whole-stage codegen: built-in Spark expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelgraph import constants as K


def _ws_class() -> str:
    """Regex character class of Python whitespace, written with \\x{..} escapes.

    The same text is understood by Java regex (Spark) and RE2 (DuckDB oracle).
    """
    return "[" + "".join(f"\\x{{{ord(c):X}}}" for c in K.PY_WHITESPACE) + "]"


WS_CLASS = _ws_class()


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Python ``str.strip()``: drop leading/trailing Unicode whitespace (``trim`` drops spaces only)."""
    return F.btrim(col_(c), F.lit(K.PY_WHITESPACE))


def local_name(c: Column | str) -> Column:
    """Text after the last ``#``; the whole string when there is none."""
    return F.substring_index(col_(c), "#", -1)


# Python's whitespace set as a compact class with ranges (same members as PY_WHITESPACE)
WS_RANGES = r"[ \x{9}-\x{D}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def ws_tokens(c: Column | str) -> Column:
    """Python ``str.split()`` with no argument: runs of whitespace, no empty tokens.

    One split on runs of the whitespace class (written with ranges, which the regex engine
    matches faster than a 29-member list), then the empty strings that leading/trailing
    whitespace leave at the ends are removed.
    """
    return F.array_remove(F.split(col_(c), WS_RANGES + "+"), "")


def example_prefix_if_missing(c: Column | str) -> Column:
    """Strip, then prefix ``Example: `` unless the text already starts with ``example:`` (any case)."""
    s = strip(c)
    return F.when(F.startswith(F.lower(s), F.lit(K.EXAMPLE_MARKER)), s).otherwise(F.concat(F.lit(K.EXAMPLE_PREFIX), s))


def example_prefix_always(c: Column | str) -> Column:
    """Strip, then always prefix ``Example: `` (the reversed Q&A variant yields double prefixes)."""
    return F.concat(F.lit(K.EXAMPLE_PREFIX), strip(c))


def paragraphs(parts: Column) -> Column:
    """Join text parts with a blank line."""
    return F.array_join(parts, K.PARAGRAPH_SEP)


def zero_padded_id(n: Column | str, fmt: str = K.SAMPLE_ID_FORMAT) -> Column:
    """``sample_000042``; grows past six digits instead of truncating like ``lpad``."""
    return F.format_string(fmt, col_(n).cast("long"))


def question(template: str, name: Column) -> Column:
    """Fill a ``{name}`` question template."""
    head, tail = template.split("{name}")
    return F.concat(F.lit(head), name, F.lit(tail))


def md5_bucket(*parts: Column | str, seed: str = K.DEFAULT_SEED) -> Column:
    """Stable 32-bit hash from the first 8 hex digits of md5(seed:part1:part2...)."""
    text = F.concat_ws(":", F.lit(seed), *[col_(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
