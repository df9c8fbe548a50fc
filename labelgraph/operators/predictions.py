"""Model output -> checked, cleaned labels (FN-14, PV-01..10, JN-08, JN-09, SO-03).

Label lists are handled in long form ``(sample_id, dim, term, pos)`` so that dedupe, ancestor
pruning and vocabulary checks are joins and aggregations keyed by (sample, dim, term); no
sample's labels are collected until the final per-sample JSON, whose size is the sample's
own response.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelgraph import constants as K
from labelgraph.functions.json import json_is_valid
from labelgraph.functions.text import col_, strip
from labelgraph.operators.graph import broadcast_if_small, occurring


# ---- responses ------------------------------------------------------------------------------
def extract_answer(response: Column | str, marker: str = K.ASSISTANT_MARKER, tail: bool = False) -> Column:
    """Text between the first and second ``assistant\\n`` marker, stripped; NULL when absent.

    ``tail=True`` takes everything after the first marker instead.
    """
    r = col_(response)
    if tail:
        pos = F.instr(r, marker)
        return F.when(pos > 0, strip(F.substring(r, pos + len(marker), 1 << 30)))
    parts = F.split(r, _regex_quote(marker))
    return strip(F.get(parts, 1))


def _regex_quote(s: str) -> str:
    import re

    return re.escape(s).replace("\\\n", "\n")


def _first_present(answer: Column, paths: list[str]) -> Column:
    return F.coalesce(*[F.get_json_object(answer, p) for p in paths])


def parse_response(df: DataFrame, answer: str = "answer") -> DataFrame:
    """Typed parse: ``valid_json``, ``error``, ``areas``/``scopes``/``abilities`` (JSON text of the
    list under any accepted key spelling; NULL when it is no array of strings), ``typed`` (every
    list that is there is one), ``shape`` and the key-presence flags. A JSON null counts as absent,
    for an error as for a list."""
    a = F.col(answer)
    valid = json_is_valid(a)
    keys = F.when(valid, F.json_object_keys(a))  # parsed once; NULL unless a valid object
    obj = keys.isNotNull()

    def any_key(*names: str) -> Column:
        # built-in array test (no lambda), false when not an object
        return F.coalesce(F.arrays_overlap(keys, F.array(*[F.lit(n) for n in names])), F.lit(False))

    names = list(zip(K.LABEL_KEYS, K.LABEL_KEYS_SINGULAR))
    own = ",".join(f"`{n}`:array<string>" for pair in names for n in pair)
    as_lists = F.from_json(a, f"struct<{own},labels:struct<{own}>>")

    def raw(plural: str, singular: str) -> Column:
        return F.when(obj, _first_present(a, [f"$.{plural}", f"$.{singular}", f"$.labels.{plural}", f"$.labels.{singular}"]))

    def strings(plural: str, singular: str) -> Column:
        return F.to_json(F.coalesce(*[as_lists[n] for n in (plural, singular)], *[as_lists["labels"][n] for n in (plural, singular)]))

    raws = [raw(*pair) for pair in names]
    # an array of strings reads the same as strings and as raw JSON
    good = [F.coalesce(strings(*pair) == r, F.lit(False)) for pair, r in zip(names, raws)]
    typed = good[0] | raws[0].isNull()
    for g, r in zip(good[1:], raws[1:]):
        typed = typed & (g | r.isNull())
    error = F.when(obj, _first_present(a, ["$.Error", "$.error"]))
    has_err = error.isNotNull()
    has_lab = any_key(*K.LABEL_KEYS, *K.LABEL_KEYS_SINGULAR, "labels")
    shape = (
        F.when(~valid, "invalid")
        .when(~obj, "not_object")
        .when(has_err & has_lab, "mixed")
        .when(has_err, "error")
        .when(any_key("labels"), "nested")
        .when(any_key(*K.LABEL_KEYS), "plural")
        .when(any_key(*K.LABEL_KEYS_SINGULAR), "singular")
        .otherwise("other")
    )
    return df.select(
        "*",
        valid.alias("valid_json"),
        error.alias("error"),
        *[F.when(g, r).alias(c) for g, r, c in zip(good, raws, ("areas", "scopes", "abilities"))],
        typed.alias("typed"),
        has_err.alias("has_error"),
        has_lab.alias("has_labels"),
        F.when(F.col(answer).isNull(), "no_response").otherwise(shape).alias("shape"),
    )


def json_list_size(c: Column | str) -> Column:
    return F.coalesce(F.json_array_length(col_(c)), F.lit(0))


def long_form(df: DataFrame, key: str, lists: dict[str, Column]) -> DataFrame:
    """``(key, dim, term, pos)`` from one string-array column per dimension, in one explode
    (a single pass over ``df``, no union of per-dimension copies)."""
    empty = F.array().cast("array<string>")

    def tag(d: str):
        return lambda t, i: F.struct(F.lit(d).alias("dim"), t.alias("term"), i.alias("pos"))

    parts = [F.transform(F.coalesce(arr, empty), tag(d)) for d, arr in lists.items()]
    out = df.select(key, F.explode(F.concat(*parts)).alias("_x")).select(key, "_x.dim", "_x.term", "_x.pos")
    return out.where(F.col("term").isNotNull())


def long_labels(parsed: DataFrame) -> DataFrame:
    """Parsed responses -> ``(sample_id, dim, term, pos)`` (pos is the 0-based list index)."""
    cols = {dim: F.from_json(F.col(c), "array<string>") for dim, c in zip(K.DIM_NAMES, ("areas", "scopes", "abilities"))}
    return long_form(parsed, "sample_id", cols)


# ---- long-form label clean-up ------------------------------------------------------------
def dedupe(labels: DataFrame) -> DataFrame:
    """Keep the first occurrence of each (sample, dim, term).

    Dealt out first, then aggregated: few labels repeat, so merging before the shuffle keeps nearly all rows of an
    input split in a hash map, which spills, and a split of a compact file holds many. A hot sample is
    spread over its terms; only equal labels meet in one task, as one entry.
    """
    key = ["sample_id", "dim", "term"]
    return labels.repartition(*key).groupBy(*key).agg(F.min("pos").alias("pos"))


def vocabulary(concept_types: DataFrame) -> DataFrame:
    """``(term, dim)`` from concept typings ``(iri, dim, ...)``: every typing counts."""
    from labelgraph.functions.text import local_name

    return concept_types.select(local_name("iri").alias("term"), "dim").distinct()


def unknown_terms(labels: DataFrame, vocab: DataFrame) -> DataFrame:
    """Labels whose term is not an ontology term at all (vocabulary broadcast after a size check)."""
    return labels.join(broadcast_if_small(occurring(vocab.select("term").distinct(), labels, "term")), "term", "left_anti")


def wrong_dimension(labels: DataFrame, vocab: DataFrame) -> DataFrame:
    """Labels whose term exists but not under the stated dimension."""
    vocab = occurring(vocab, labels, "term")
    known = labels.join(broadcast_if_small(vocab.select("term").distinct()), "term", "left_semi")
    return known.join(broadcast_if_small(vocab), ["term", "dim"], "left_anti")


def prune_ancestors(labels: DataFrame, closure_names: DataFrame) -> DataFrame:
    """Drop a term when one of its descendants is in the same (sample, dim) list; also dedupes
    (first position kept). ``closure_names(dim, child, ancestor)``: a hierarchy holds within its
    dimension. Terms of a cycle are each other's ancestors and stand for one another, so none of
    them drops the other.

    One aggregation instead of a self join: every label row, plus one "covered" row per
    ancestor of each label (closure broadcast after a size check), grouped by
    (sample, dim, term). A term survives when it is present and never covered. Partial
    aggregation runs before the single shuffle, and a hot sample is spread over its terms.
    """
    cl = closure_names.where(F.col("child") != F.col("ancestor")).select("dim", F.col("child").alias("term"), "ancestor").distinct()
    back = cl.select("dim", F.col("ancestor").alias("term"), F.col("term").alias("ancestor"))
    cl = broadcast_if_small(cl.join(back, ["dim", "term", "ancestor"], "left_anti"))
    own = labels.select("sample_id", "dim", "term", "pos", F.lit(True).alias("_own"))
    covered = labels.select("sample_id", "dim", "term").join(cl, ["dim", "term"]).select(
        "sample_id", "dim", F.col("ancestor").alias("term"), F.lit(None).cast(own.schema["pos"].dataType).alias("pos"), F.lit(False).alias("_own")
    )
    g = own.unionByName(covered).groupBy("sample_id", "dim", "term").agg(
        F.min("pos").alias("pos"), F.max("_own").alias("_present"), F.min("_own").alias("_all_own")
    )
    return g.where(F.col("_present") & F.col("_all_own")).select("sample_id", "dim", "term", "pos")


def clean_json(labels: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Per sample v2-shape JSON ``{"Areas":[..],"Scopes":[..],"Abilities":[..]}`` in position order;
    every sample of ``samples(sample_id)`` has a row, with empty lists when no label is left."""
    if samples is not None:
        none = {c: F.lit(None).cast(labels.schema[c].dataType) for c in ("dim", "term", "pos")}
        labels = labels.select("sample_id", "dim", "term", "pos").unionByName(samples.select("sample_id").distinct().withColumns(none))
    aggs = []
    for dim, key in zip(K.DIM_NAMES, K.LABEL_KEYS):
        items = F.collect_list(F.when(F.col("dim") == F.lit(dim), F.struct("pos", "term")))
        aggs.append(F.transform(F.array_sort(items), lambda x: x["term"]).alias(key))
    per = labels.groupBy("sample_id").agg(*aggs)
    return per.select("sample_id", F.to_json(F.struct(*K.LABEL_KEYS)).alias("labels_json"))


def verdicts(parsed: DataFrame, vocab: DataFrame, min_counts: dict[str, int] | None = None) -> DataFrame:
    """Per response: ``valid`` and ``reasons`` (fixed order), from the typed parse plus
    vocabulary flags computed in long form and joined back by sample."""
    mins = min_counts if min_counts is not None else K.MIN_COUNTS
    lab = long_labels(parsed)
    flags = (
        lab.join(broadcast_if_small(vocab.select("term", F.lit(True).alias("_known")).distinct()), "term", "left")
        .join(broadcast_if_small(vocab.select("term", "dim", F.lit(True).alias("_dim_ok")).distinct()), ["term", "dim"], "left")
        .groupBy("sample_id")
        .agg(
            F.max(F.col("_known").isNull()).alias("any_unknown"),
            F.max(F.col("_known").isNotNull() & F.col("_dim_ok").isNull()).alias("any_wrong_dim"),
            (F.count(F.lit(1)) > F.count_distinct("dim", "term")).alias("any_duplicate"),
        )
    )
    p = parsed.join(flags, "sample_id", "left")
    below = (
        (json_list_size("areas") < mins.get("Area", 0))
        | (json_list_size("scopes") < mins.get("Scope", 0))
        | (json_list_size("abilities") < mins.get("Ability", 0))
    )
    known_error = F.col("error").isin(*K.ERROR_CODES)
    reasons = F.array_compact(
        F.array(
            F.when(F.col("shape") == "no_response", F.lit("no_response")),
            F.when(F.col("shape") == "invalid", F.lit("invalid_json")),
            F.when(F.col("shape") == "not_object", F.lit("not_an_object")),
            F.when(~F.col("typed"), F.lit("wrong_type")),
            F.when(F.col("valid_json") & (F.col("has_error") == F.col("has_labels")), F.lit("not_exclusive")),
            F.when(F.col("has_error") & ~F.coalesce(known_error, F.lit(False)), F.lit("unknown_error")),
            F.when(F.col("has_labels") & ~F.col("has_error") & below, F.lit("below_min_counts")),
            F.when(F.coalesce(F.col("any_unknown"), F.lit(False)), F.lit("unknown_term")),
            F.when(F.coalesce(F.col("any_wrong_dim"), F.lit(False)), F.lit("wrong_dimension")),
            F.when(F.coalesce(F.col("any_duplicate"), F.lit(False)), F.lit("duplicate_term")),
        )
    )
    return p.select("sample_id", (F.size(reasons) == 0).alias("valid"), reasons.alias("reasons"))


def verdict_report(v: DataFrame) -> DataFrame:
    """Counts per reason, plus ``valid`` for responses with none."""
    r = v.select(F.explode(F.when(F.col("valid"), F.array(F.lit("valid"))).otherwise(F.col("reasons"))).alias("reason"))
    return r.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
