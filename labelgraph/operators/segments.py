"""List values as ordered segments (AG-02, JN-02, QA-05): a hub's list is never one row of a task.

A group's items are numbered in order over range partitions, and every ``size`` consecutive ones
make a row ``(group, segment, n, text)``. A group with a third of all items is thus spread over as many rows
and tasks as its share asks for. Segments are put together at the sink alone, where the output format
asks for one value, and there as texts, not as items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelgraph import constants as K
from labelgraph.functions.json import label_json_listed
from labelgraph.functions.pyjson import json_string
from labelgraph.functions.text import local_name, question
from labelgraph.operators import ontology as O
from labelgraph.operators.sequence import sequence_number

#: Items of a segment.
SEGMENT_ITEMS = 1_000


def list_segments(df: DataFrame, group: str, order: list[str], item: Column, sep: str, size: int = SEGMENT_ITEMS) -> DataFrame:
    """``(group, segment, n, text)``: the items of each group in ``order``, ``size`` to a segment, joined by ``sep``.

    Segments count from 0 without gaps and all but a group's last are full. Items equal in all of ``order`` are
    interchangeable; null items are skipped and rows without a group left out.
    """
    src = df.select(F.col(group).alias("_group"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], item.alias("_item"))
    src = src.where("_group is not null and _item is not null")
    numbered = sequence_number(src, [f"_o{i}" for i in range(len(order))], group_cols=["_group"], col="_i")
    at = F.floor(F.col("_i") / F.lit(size)).cast("long")
    # a group of this aggregation has at most ``size`` rows
    rows = numbered.groupBy("_group", at.alias("segment")).agg(F.array_sort(F.collect_list(F.struct("_i", "_item"))).alias("_items"))
    text = F.array_join(F.transform("_items", lambda x: x["_item"]), sep)
    return rows.select(F.col("_group").alias(group), "segment", F.size("_items").cast("long").alias("n"), text.alias("text"))


def put_together(segments: DataFrame, group: str, sep: str) -> DataFrame:
    """``(group, n, text)``: one value per group, for a sink whose format asks for it."""
    parts = F.array_sort(F.collect_list(F.struct("segment", "text")))
    whole = segments.groupBy(group).agg(F.sum("n").alias("n"), parts.alias("_parts"))
    return whole.select(group, "n", F.array_join(F.transform("_parts", lambda x: x["text"]), sep).alias("text"))


def child_segments(triples: DataFrame, vocab: O.Vocab, json: bool = False, size: int = SEGMENT_ITEMS) -> DataFrame:
    """Children's names per parent in code point order, duplicates kept; ``json`` writes each as a JSON string."""
    names = O.edges(triples, vocab).select("parent", local_name("child").alias("name"))
    item = json_string(F.col("name")) if json else F.col("name")
    return list_segments(names, "parent", ["name"], item, ", " if json else ",", size)


def comment_segments(triples: DataFrame, vocab: O.Vocab, sep: str = K.PARAGRAPH_SEP, size: int = SEGMENT_ITEMS) -> DataFrame:
    """Comments per subject in (pos, text) order."""
    c = triples.where(F.col("p") == vocab.comment_p).select(F.col("s").alias("iri"), "pos", "o")
    return list_segments(c, "iri", ["pos", "o"], F.col("o"), sep, size)


def qa_parent_children(triples: DataFrame, vocab: O.Vocab, size: int = SEGMENT_ITEMS) -> DataFrame:
    """'What are the children of X?' with the list built from segments ``(parent, instruction, output)``."""
    whole = put_together(child_segments(triples, vocab, json=True, size=size), "parent", ", ")
    dims = O.concept_dim(triples, vocab).withColumnRenamed("iri", "parent")
    listed = F.concat(F.lit("["), F.col("text"), F.lit("]"))
    return whole.join(dims, "parent").select(
        "parent",
        question(K.Q_CHILDREN, local_name("parent")).alias("instruction"),
        label_json_listed(F.col("dim"), listed).alias("output"),
    )
