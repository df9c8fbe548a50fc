"""Retrieval-augmented samples (JN-06, JN-07, CST-04): the correct definition of each label
("oracle") plus k definitions of other concepts ("distractors").

Distractors never pair every sample with every concept. Each sample walks its own
permutation of the C concept slots, ``idx_j = (b + j * a) mod C`` with ``b`` and ``a`` from
hashes of the sample and ``a`` coprime with C: the first
``k + |labels|`` slots are distinct, at most ``|labels|`` of them are the sample's own labels,
so exactly ``min(k, C - |labels|)`` distractors remain. Work per sample is O(k + |labels|).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelgraph import constants as K
from labelgraph.operators.sequence import sequence_number
from labelgraph.session import cut_lineage


def _h32(seed: str, *parts: Column | str) -> Column:
    text = F.concat_ws(":", F.lit(seed), *[(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def oracle(labels: DataFrame, definitions: DataFrame) -> DataFrame:
    """``labels(sample, dim, term)`` ⋈ ``definitions(term, definition)`` -> the correct definitions."""
    return labels.join(definitions, "term", "inner").select("sample", "dim", "term", "definition")


def index_concepts(definitions: DataFrame) -> tuple[DataFrame, int]:
    """Dense slot numbers 0..C-1 over terms in term order ``(term, idx)``, and C; no texts."""
    idx = sequence_number(definitions.select("term"), ["term"], col="idx")
    return idx, definitions.count()


def strides(c: int) -> list[int]:
    """Strides coprime with ``c`` by construction: powers of a prime larger than any ``c``, mod ``c``."""
    return [pow(K.STRIDE_PRIME, e, c) for e in range(1, K.STRIDES + 1)]


def draw_terms(labels: DataFrame, definitions: DataFrame, k: int = 3, seed: str = K.DEFAULT_SEED) -> DataFrame:
    """``(sample, j, term)``: k terms not among the sample's labels; terms and slot numbers only."""
    idx, c = index_concepts(definitions)
    if c == 0:
        return idx.select(F.lit(None).cast("string").alias("sample"), F.lit(0).alias("j"), "term").limit(0)
    per = labels.groupBy("sample").agg(F.count_distinct("term").alias("n_labels"))
    m = F.least(F.lit(c), F.col("n_labels") + k)
    pick = (_h32(seed, F.lit("stride"), "sample") % K.STRIDES + 1).cast("int")
    draws = per.select(
        "sample",
        (_h32(seed, "sample") % c).alias("b"),
        F.element_at(F.array(*[F.lit(p) for p in strides(c)]), pick).cast("long").alias("a"),
        F.explode(F.sequence(F.lit(0), m - 1)).alias("j"),
    )
    draws = draws.select("sample", "j", ((F.col("b") + F.col("j").cast("long") * F.col("a")) % c).alias("idx"))
    from labelgraph.operators.graph import broadcast_if_small

    cand = draws.join(broadcast_if_small(idx), "idx").join(labels.select("sample", "term").distinct(), ["sample", "term"], "left_anti")
    w = Window.partitionBy("sample").orderBy("j")  # group size <= k + |labels|
    return cand.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).select("sample", "j", "term")


def distractors(labels: DataFrame, definitions: DataFrame, k: int = 3, seed: str = K.DEFAULT_SEED) -> DataFrame:
    """``(sample, j, term, definition)``: k concepts not among the sample's labels."""
    return draw_terms(labels, definitions, k, seed).join(definitions, "term").select("sample", "j", "term", "definition")


def samples(labels: DataFrame, definitions: DataFrame, answers: DataFrame, k: int = 3, seed: str = K.DEFAULT_SEED) -> DataFrame:
    """Per sample: oracle + distractor definitions in hash order joined as one context text.

    Which terms a sample gets is decided on terms alone; the texts are joined once, to the kept
    (sample, term) rows. The collected group per sample holds at most ``|labels| + k`` definitions.
    The label and definition tables are each read several times, so they are stored once.
    """
    labels = cut_lineage(labels, "raft-labels")
    definitions = cut_lineage(definitions, "raft-definitions")
    own = labels.select("sample", "term").distinct().withColumn("is_oracle", F.lit(True))
    drawn = draw_terms(labels, definitions, k, seed).select("sample", "term").withColumn("is_oracle", F.lit(False))
    docs = own.unionByName(drawn).join(definitions.select("term", "definition"), "term")
    docs = docs.withColumn("_o", F.struct(_h32(seed, "sample", "term").alias("h"), F.col("term").alias("t"), F.col("definition").alias("d")))
    per = docs.groupBy("sample").agg(F.array_sort(F.collect_list("_o")).alias("_docs"), F.count_if("is_oracle").alias("n_oracle"), F.count(F.lit(1)).alias("n_docs"))
    ctx = F.array_join(F.transform("_docs", lambda x: x["d"]), K.PARAGRAPH_SEP)
    return per.join(answers, "sample").select("sample", "n_docs", "n_oracle", ctx.alias("context"), "answer")
