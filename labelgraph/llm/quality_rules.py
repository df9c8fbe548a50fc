"""Quality rules as a bitmask ledger: measure once, judge under any policy version later.

``measure`` computes every measurement once per document, ``ledger`` turns them into failure bits,
``apply_policy`` keeps or rejects by a versioned mask, and ``ablation`` counts through bitwise
aggregation what each rule does alone and with the others. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelgraph.llm.common import carried, words_of

WINDOW = 8
MEASUREMENTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

#: Rule name -> condition on the measurements that fails a document; the position is its bit.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "symbols": "4 * n_symbols > n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
}
BASE = ("few_words", "repeated_words")
#: Policy version -> rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": BASE,
    "v2": tuple(RULES),
}


def mask_of(names: tuple[str, ...]) -> int:
    order = list(RULES)
    return sum(1 << order.index(n) for n in names)


def _window_hashes(words: str) -> Column:
    """One 64-bit hash for each run of 8 words; null when there is none."""
    w = F.col(words)
    n = F.size(w)
    starts = F.sequence(F.lit(1), n - (WINDOW - 1))
    return F.when(n >= WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, F.lit(WINDOW)))))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words (all long).

    A null or empty text measures 0 everywhere. Repeated words are those inside an 8-word window
    that occurs twice or more in the text, the first occurrence included. Lines count when they
    have a word; a duplicate line equals an earlier one of the text. Rows are measured one by one,
    without a shuffle, so repeated rows and long texts need nothing special. A column that already
    has the name of a measurement is replaced; others pass through, whatever their names.
    """
    docs, restore = carried(docs, text)
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumns({"_words": words_of(F.col(f"`{text}`")), "_lines": lines})
    out = out.withColumn("_hashes", _window_hashes("_words"))
    # only a text whose hashes repeat sorts them; each step is a column of its own, so that
    # the functions of the next step read it instead of computing it for every element
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    out = out.withColumn("_at", F.when(repeats, F.array_sort(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twice = F.transform(
        "_at", lambda x, k: F.when((F.get("_at", k + 1)["h"] == x["h"]) | (F.get("_at", k - 1)["h"] == x["h"]), x["i"])
    )
    out = out.withColumn("_starts", F.sort_array(F.array_compact(twice)))
    # every start covers its 8 words, or those before the next start
    steps = F.transform("_starts", lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", k + 1) - s, F.lit(WINDOW))))
    rep = F.aggregate(steps, F.lit(0), lambda a, b: a + b)
    # 0, but not deterministic to the optimiser: a later filter on the measurements stays above
    # them instead of being rewritten into all the expressions they come from
    never = F.when(F.spark_partition_id() < 0, 1).otherwise(0)
    out = out.withColumns(
        {
            "n_words": (F.size("_words") + never).cast("long"),
            "word_chars": F.length(F.concat_ws("", "_words")).cast("long"),
            "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]", ""))).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.coalesce(rep, F.lit(0)).cast("long"),
        }
    )
    return restore(out, *MEASUREMENTS, without=MEASUREMENTS)


def ledger(measured: DataFrame) -> DataFrame:
    """Add ``failed_bits``: bit k is set when rule k of ``RULES`` fails the document."""
    bits = [F.when(F.expr(cond), F.lit(1 << k)).otherwise(F.lit(0)) for k, cond in enumerate(RULES.values())]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measured.withColumn("failed_bits", total.cast("long"))


def apply_policy(led: DataFrame, version: str = "v2") -> DataFrame:
    """Add ``base_failed`` (a base rule fails) and ``kept`` (no rule of the policy fails)."""
    bits = F.col("failed_bits")
    return led.withColumns(
        {
            "base_failed": bits.bitwiseAND(F.lit(mask_of(BASE))) != 0,
            "kept": bits.bitwiseAND(F.lit(mask_of(tuple({*BASE, *POLICIES[version]})))) == 0,
        }
    )


def ablation(led: DataFrame, version: str = "v2") -> DataFrame:
    """Per rule of the policy: documents it fails, and documents that only it rejects.

    Ledgers are pre-aggregated by their bits: at most 2^rules rows remain, whatever the input.
    """
    mask = mask_of(POLICIES[version])
    by_bits = led.groupBy(F.col("failed_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << k).cast("long").alias("bit")) for k, r in enumerate(RULES) if mask >> k & 1])
    return (
        by_bits.select("bits", "n", F.inline(rules))
        .groupBy("rule")
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
            F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("rejected_alone"),
        )
    )
