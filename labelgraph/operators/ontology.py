"""Triple-table operators: pattern match, concepts, property lookups, typing, edges.

Input is the D1 triple table ``(s, p, o, o_kind, pos)``. Every per-concept lookup of the
original (a probe per concept in a Python loop) becomes one set-wise aggregation or join;
all aggregations are partial (map-side) before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelgraph import constants as K
from labelgraph.functions.text import local_name, strip

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"


@dataclass(frozen=True)
class Vocab:
    """Predicate and class names of an ontology, in dimension priority order."""

    type_p: str
    definition_p: str
    comment_p: str
    dim_classes: tuple[str, ...]  # class IRIs for DIM_NAMES, same order (priority)
    part_of: tuple[str, ...]  # per-dimension partOf predicates, same order
    expands: tuple[str, ...] = ()
    blank_prefix: str = "_:"
    inverse_p: str = OWL + "inverseOf"
    subproperty_p: str = RDFS + "subPropertyOf"
    subclass_p: str = RDFS + "subClassOf"
    domain_p: str = RDFS + "domain"
    range_p: str = RDFS + "range"
    on_class_p: str = OWL + "onClass"
    exactly_p: str = OWL + "qualifiedCardinality"
    at_least_p: str = OWL + "minQualifiedCardinality"
    at_most_p: str = OWL + "maxQualifiedCardinality"

    @staticmethod
    def for_namespace(ns: str) -> "Vocab":
        """RDF serialisation: full IRIs for rdf/rdfs terms, ``ns`` for the ontology's own."""
        return Vocab(
            type_p=RDF + "type",
            definition_p=RDFS + "isDefinedBy",
            comment_p=RDFS + "comment",
            dim_classes=tuple(ns + d for d in K.DIM_NAMES),
            part_of=tuple(ns + "partOf" + d for d in K.DIM_NAMES),
            expands=tuple(ns + "expands" + d for d in K.DIM_NAMES),
        )

    @staticmethod
    def bare(ns: str = "urn:t#") -> "Vocab":
        """Short predicate names (as in the test fixture), class IRIs under ``ns``."""
        return Vocab(
            type_p="type",
            definition_p="isDefinedBy",
            comment_p="comment",
            dim_classes=tuple(ns + d for d in K.DIM_NAMES),
            part_of=tuple("partOf" + d for d in K.DIM_NAMES),
            expands=tuple("expands" + d for d in K.DIM_NAMES),
            inverse_p="inverseOf",
            subproperty_p="subPropertyOf",
            subclass_p="subClassOf",
            domain_p="domain",
            range_p="range",
            on_class_p="onClass",
            exactly_p="qualifiedCardinality",
            at_least_p="minQualifiedCardinality",
            at_most_p="maxQualifiedCardinality",
        )

    def class_to_priority(self, c: Column) -> Column:
        """1, 2, 3 for the dimension classes in priority order, NULL otherwise."""
        expr = None
        for i, iri in enumerate(self.dim_classes, start=1):
            expr = F.when(c == F.lit(iri), F.lit(i)) if expr is None else expr.when(c == F.lit(iri), F.lit(i))
        return expr

    def predicate_to_dim(self, c: Column, predicates: tuple[str, ...]) -> Column:
        expr = None
        for p, d in zip(predicates, K.DIM_NAMES):
            expr = F.when(c == F.lit(p), F.lit(d)) if expr is None else expr.when(c == F.lit(p), F.lit(d))
        return expr


def priority_to_dim(c: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in K.DIM_NAMES]), c)


def match(triples: DataFrame, s: str | None = None, p: str | None = None, o: str | None = None) -> DataFrame:
    """Triple pattern ``(s?, p?, o?)``: None is a wildcard. Pushed down to the scan."""
    cond = F.lit(True)
    for name, value in (("s", s), ("p", p), ("o", o)):
        if value is not None:
            cond = cond & (F.col(name) == F.lit(value))
    return triples.where(cond)


def is_iri(c: Column, vocab: Vocab) -> Column:
    return ~F.startswith(c, F.lit(vocab.blank_prefix))


def concept_types(triples: DataFrame, vocab: Vocab) -> DataFrame:
    """Every (iri, dim, priority) typing of an individual: IRIs only, class nodes excluded."""
    t = triples.where((F.col("p") == vocab.type_p) & F.col("o").isin(*vocab.dim_classes))
    t = t.where(is_iri(F.col("s"), vocab) & ~F.col("s").isin(*vocab.dim_classes))
    prio = vocab.class_to_priority(F.col("o"))
    return t.select(F.col("s").alias("iri"), priority_to_dim(prio).alias("dim"), prio.alias("priority")).distinct()


def concepts(triples: DataFrame, vocab: Vocab) -> DataFrame:
    """Distinct concepts ``(iri, name)`` over the three dimensions."""
    return concept_types(triples, vocab).select("iri").distinct().withColumn("name", local_name("iri"))


def concept_dim(triples: DataFrame, vocab: Vocab) -> DataFrame:
    """One dimension per concept, first hit in priority order Area > Scope > Ability."""
    best = concept_types(triples, vocab).groupBy("iri").agg(F.min("priority").alias("priority"))
    return best.select("iri", priority_to_dim(F.col("priority")).alias("dim"))


def definitions(triples: DataFrame, vocab: Vocab) -> DataFrame:
    """Single-valued lookup: lowest-position definition literal per subject ``(iri, definition)``."""
    d = triples.where(F.col("p") == vocab.definition_p)
    return d.groupBy(F.col("s").alias("iri")).agg(F.min(F.struct("pos", "o"))["o"].alias("definition"))


def comments(triples: DataFrame, vocab: Vocab) -> DataFrame:
    """Multi-valued lookup: comments per subject in (pos, text) order ``(iri, comments)``."""
    c = triples.where(F.col("p") == vocab.comment_p)
    agg = c.groupBy(F.col("s").alias("iri")).agg(F.array_sort(F.collect_list(F.struct("pos", "o"))).alias("_c"))
    return agg.select("iri", F.transform("_c", lambda x: x["o"]).alias("comments"))


def concept_text(triples: DataFrame, vocab: Vocab) -> DataFrame:
    """Concept text with fallback: definition, else first comment (consumed from the rest).

    Columns: iri, name, definition, comments, has_text_source, text, rest. An empty
    definition literal counts as missing; a whitespace-only one is kept and strips to ''.
    """
    c = concepts(triples, vocab)
    df = c.join(definitions(triples, vocab), "iri", "left").join(comments(triples, vocab), "iri", "left")
    cm = F.coalesce(F.col("comments"), F.array().cast("array<string>"))
    def_ok = F.col("definition").isNotNull() & (F.length("definition") > 0)
    has_comments = F.size(cm) > 0
    text = F.when(def_ok, strip("definition")).when(has_comments, strip(F.element_at(cm, 1))).otherwise(F.lit(""))
    # drop the first element by index: slice(cm, 2, <huge>) under a later transform() comes
    # back empty in Spark 4.1 [checked], an index filter does not
    rest = F.when(def_ok, cm).otherwise(F.filter(cm, lambda x, i: i >= 1))
    return df.select(
        "iri",
        "name",
        "definition",
        cm.alias("comments"),
        (def_ok | has_comments).alias("has_text_source"),
        text.alias("text"),
        rest.alias("rest"),
    )


def edges(triples: DataFrame, vocab: Vocab, predicates: tuple[str, ...] | None = None) -> DataFrame:
    """Hierarchy edges ``(child, parent, dim)`` over the per-dimension partOf predicates."""
    preds = predicates or vocab.part_of
    e = triples.where(F.col("p").isin(*preds))
    return e.select(
        F.col("s").alias("child"), F.col("o").alias("parent"), vocab.predicate_to_dim(F.col("p"), preds).alias("dim")
    )


def children_per_parent(triples: DataFrame, vocab: Vocab) -> DataFrame:
    """``(parent, children)``: child local names sorted by code point, duplicates kept."""
    e = edges(triples, vocab)
    return e.groupBy("parent").agg(F.array_sort(F.collect_list(local_name("child"))).alias("children"))


def parent_per_child(triples: DataFrame, vocab: Vocab, all_parents: bool = False) -> DataFrame:
    """``(child, parent)``: one parent per child (smallest IRI, a fixed tie-break), or every edge."""
    e = edges(triples, vocab)
    if all_parents:
        return e.select("child", "parent").distinct()
    return e.groupBy("child").agg(F.min("parent").alias("parent"))


# ---- axioms, read from the graph -----------------------------------------------------------
def inverses(triples: DataFrame, vocab: Vocab) -> DataFrame:
    """``(p, inverse)`` pairs of properties."""
    return match(triples, p=vocab.inverse_p).select(F.col("s").alias("p"), F.col("o").alias("inverse")).distinct()


def subproperties(triples: DataFrame, vocab: Vocab) -> DataFrame:
    """``(sub, super)`` of properties."""
    return match(triples, p=vocab.subproperty_p).select(F.col("s").alias("sub"), F.col("o").alias("super")).distinct()


def subclasses(triples: DataFrame, vocab: Vocab) -> DataFrame:
    """``(sub, super)`` of named classes; restrictions (blank nodes) are no superclass here."""
    t = match(triples, p=vocab.subclass_p).where(is_iri(F.col("o"), vocab))
    return t.select(F.col("s").alias("sub"), F.col("o").alias("super")).distinct()


def domains_ranges(triples: DataFrame, vocab: Vocab) -> DataFrame:
    """``(p, domain, range)``, one row per declared pair; a side that isn't declared is null."""
    dom = match(triples, p=vocab.domain_p).select(F.col("s").alias("p"), F.col("o").alias("domain")).distinct()
    rng = match(triples, p=vocab.range_p).select(F.col("s").alias("p"), F.col("o").alias("range")).distinct()
    return dom.join(rng, "p", "full").select("p", "domain", "range")


def cardinality_rules(triples: DataFrame, vocab: Vocab) -> DataFrame:
    """``(owner, class, min_n, max_n)`` from restriction nodes: the class that has the restriction
    as a superclass, the class counted, and the bounds (null when there is none)."""
    node = F.col("s")
    bound = triples.where(F.col("p").isin(vocab.on_class_p, vocab.exactly_p, vocab.at_least_p, vocab.at_most_p)).groupBy(node.alias("node"))

    def value(*ps: str) -> Column:
        return F.max(F.when(F.col("p").isin(*ps), F.col("o")))

    rules = bound.agg(
        value(vocab.on_class_p).alias("class"),
        value(vocab.exactly_p, vocab.at_least_p).cast("int").alias("min_n"),
        value(vocab.exactly_p, vocab.at_most_p).cast("int").alias("max_n"),
    ).where("class is not null and (min_n is not null or max_n is not null)")
    owners = match(triples, p=vocab.subclass_p).select(F.col("s").alias("owner"), F.col("o").alias("node"))
    return owners.join(rules, "node").select("owner", "class", "min_n", "max_n").distinct()
