"""Ontology -> question/answer rows (QA-01..06, SL-01, AG-04)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgraph import constants as K
from labelgraph.functions.json import label_json
from labelgraph.functions.text import example_prefix_always, example_prefix_if_missing, local_name, paragraphs, question, strip
from labelgraph.operators import ontology as O
from labelgraph.session import cut_lineage


def qa_forward(triples: DataFrame, vocab: O.Vocab) -> DataFrame:
    """Concept name -> definition plus remaining comments as examples ``(iri, instruction, output)``.

    Kept whenever any text source exists, even if the definition strips to ''.
    """
    t = O.concept_text(triples, vocab).where("has_text_source")
    parts = F.concat(F.array("text"), F.transform("rest", example_prefix_if_missing))
    return t.select("iri", question(K.Q_CONCEPT, F.col("name")).alias("instruction"), paragraphs(parts).alias("output"))


def _with_dim(df: DataFrame, triples: DataFrame, vocab: O.Vocab, key: str) -> DataFrame:
    dims = O.concept_dim(triples, vocab).withColumnRenamed("iri", key)
    return df.join(dims, key, "inner")


def qa_reverse(triples: DataFrame, vocab: O.Vocab) -> DataFrame:
    """Definition + every remaining comment (always prefixed) -> label JSON ``(iri, instruction, output)``."""
    t = O.concept_text(triples, vocab)
    examples = F.transform("rest", lambda c: F.concat(F.lit(K.PARAGRAPH_SEP), example_prefix_always(c)))
    instr = F.concat(F.col("text"), F.array_join(examples, ""))
    t = t.select("iri", "name", instr.alias("instruction")).where(F.length("instruction") > 0)
    t = _with_dim(t, triples, vocab, "iri")
    return t.select("iri", "instruction", label_json(F.col("dim"), F.array("name")).alias("output"))


def qa_def_label(triples: DataFrame, vocab: O.Vocab) -> DataFrame:
    """Definition text -> label JSON, no examples ``(iri, instruction, output)``."""
    t = O.concept_text(triples, vocab).select("iri", "name", F.col("text").alias("instruction"))
    t = _with_dim(t.where(F.length("instruction") > 0), triples, vocab, "iri")
    return t.select("iri", "instruction", label_json(F.col("dim"), F.array("name")).alias("output"))


def qa_child_parent(triples: DataFrame, vocab: O.Vocab) -> DataFrame:
    """'What is the parent of X?' -> parent under the parent's dimension ``(child, instruction, output)``.

    Only rows whose chosen parent is typed survive; the child is not checked.
    """
    pc = O.parent_per_child(triples, vocab)
    pc = _with_dim(pc, triples, vocab, "parent")
    return pc.select(
        "child",
        question(K.Q_PARENT, local_name("child")).alias("instruction"),
        label_json(F.col("dim"), F.array(local_name("parent"))).alias("output"),
    )


def qa_parent_children(triples: DataFrame, vocab: O.Vocab) -> DataFrame:
    """'What are the children of X?' -> sorted child names under the parent's dimension."""
    cp = _with_dim(O.children_per_parent(triples, vocab), triples, vocab, "parent")
    return cp.select(
        "parent",
        question(K.Q_CHILDREN, local_name("parent")).alias("instruction"),
        label_json(F.col("dim"), F.col("children")).alias("output"),
    )


def node_facts(triples: DataFrame, vocab: O.Vocab) -> DataFrame:
    """One row per node ``(node, dim, text, parent, children)`` from one scan and one shuffle.

    Each triple becomes a tagged row of its subject; an edge becomes one of its object as well. So
    all lookups of the Q&A parts are aggregates of one grouping: the first type in priority order
    (null for nodes that are no concept), the definition or else the first comment (stripped, ''
    without either), the smallest parent (null without edges) and the children's sorted names.
    """
    s, p, o = F.col("s"), F.col("p"), F.col("o")
    is_edge = p.isin(*vocab.part_of)
    is_type = (p == vocab.type_p) & o.isin(*vocab.dim_classes) & O.is_iri(s, vocab) & ~s.isin(*vocab.dim_classes)
    first = F.struct("pos", "o")
    none = F.lit(None).cast("string")
    of_subject = F.struct(
        s.alias("node"),
        F.when(is_type, vocab.class_to_priority(o)).alias("priority"),
        F.when(p == vocab.definition_p, first).alias("definition"),
        F.when(p == vocab.comment_p, first).alias("comment"),
        F.when(is_edge, o).alias("parent"),
        none.alias("child"),
    )
    empty = [F.lit(None).cast(t).alias(c) for c, t in (("priority", "int"), ("definition", _FIRST), ("comment", _FIRST), ("parent", "string"))]
    of_object = F.struct(o.alias("node"), *empty, local_name("s").alias("child"))
    known = triples.where(p.isin(vocab.type_p, vocab.definition_p, vocab.comment_p, *vocab.part_of))
    known = known.select("s", "p", "o", F.col("pos").cast("long").alias("pos"))
    rows = known.select(F.explode(F.when(is_edge, F.array(of_subject, of_object)).otherwise(F.array(of_subject))).alias("row")).select("row.*")
    smallest = [F.min(c).alias(c) for c in ("priority", "definition", "comment", "parent")]
    facts = rows.groupBy("node").agg(*smallest, F.array_sort(F.collect_list("child")).alias("children"))
    text = F.when(F.length("definition.o") > 0, strip("definition.o")).when(F.col("comment").isNotNull(), strip("comment.o")).otherwise(F.lit(""))
    # element_at of a literal array gives its last element for a null index in Spark 4.1 [checked]
    dim = F.when(F.col("priority").isNotNull(), O.priority_to_dim(F.col("priority")))
    return facts.select("node", dim.alias("dim"), text.alias("text"), "parent", "children")


_FIRST = "struct<pos:bigint,o:string>"


def qa_full(triples: DataFrame, vocab: O.Vocab) -> DataFrame:
    """All v3 parts, duplicates kept, tagged ``part`` and keyed by the concept IRI.

    The triples are read once, into the stored :func:`node_facts`; the parts read that table.
    """
    nodes = cut_lineage(node_facts(triples, vocab), "qa-nodes")
    typed = nodes.where("dim is not null")

    def part(df: DataFrame, name: str, instruction, names) -> DataFrame:
        return df.select(F.lit(name).alias("part"), F.col("node").alias("key"), instruction.alias("instruction"), label_json(F.col("dim"), names).alias("output"))

    parents = typed.select(F.col("node").alias("parent"), "dim")
    children = nodes.where("parent is not null").select("node", "parent").join(parents, "parent")
    out = part(typed.where("length(text) > 0"), "definition", F.col("text"), F.array(local_name("node")))
    out = out.unionByName(part(children, "child_parent", question(K.Q_PARENT, local_name("node")), F.array(local_name("parent"))))
    return out.unionByName(
        part(typed.where("size(children) > 0"), "parent_children", question(K.Q_CHILDREN, local_name("node")), F.col("children"))
    )


def qa_counts(qa: DataFrame) -> DataFrame:
    """Row count per part."""
    return qa.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
