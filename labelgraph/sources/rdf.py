"""RDF/XML triple scan (SRC-01) and writer.

Flat ``rdf:Description`` serialisation. The file is read as text rows that end with
``</rdf:Description>``, so one large file is split over tasks like any text; each row holds one
block. Attributes ``rdf:about`` / ``rdf:nodeID`` name the subject, every child element is a triple:
``rdf:resource`` and ``rdf:nodeID`` give references, anything else is a literal with an optional
``rdf:datatype``. All predicates are read; a caller may restrict them. One scan, no shuffle, but for
``distinct`` on (s, p, o, o_kind), since a graph is a set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RDF_NS = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS_NS = "http://www.w3.org/2000/01/rdf-schema#"
OWL_NS = "http://www.w3.org/2002/07/owl#"
XSD_NS = "http://www.w3.org/2001/XMLSchema#"
DEFAULT_PREFIXES = {"rdf": RDF_NS, "rdfs": RDFS_NS, "owl": OWL_NS, "xsd": XSD_NS}

# an attribute list, a child element (name, attributes, content) and one attribute's value
_ATTRS = r"""((?:[^>"']|"[^"]*"|'[^']*')*)"""
_BLOCK = r"(?s).*<rdf:Description\b" + _ATTRS + r">(.*)$"
_CHILD = r"""(?s)<([A-Za-z_][\w.-]*(?::[\w.-]+)?)((?:[^>"'/]|/(?!>)|"[^"]*"|'[^']*')*)(?:/>|>(.*?)</\1\s*>)"""


def expand(qname: str, prefixes: dict[str, str]) -> str:
    """``rdfs:comment`` -> full IRI using ``prefixes``; unknown prefixes are kept as written."""
    if ":" in qname:
        pre, local = qname.split(":", 1)
        if pre in prefixes:
            return prefixes[pre] + local
    return qname


def _unescape(c: Column) -> Column:
    """XML text as its reader gives it; only text with entities is parsed."""
    plain = F.regexp_replace(c, "\r\n?", "\n")
    parsed = F.from_xml(F.concat(F.lit("<x>"), c, F.lit("</x>")), "struct<_VALUE:string>", {"ignoreSurroundingSpaces": "false"})
    return F.when(F.instr(c, "&") > 0, parsed["_VALUE"]).otherwise(plain)


def _attribute(attrs: Column, name: str) -> Column:
    """The attribute's value, null when it isn't there."""
    quoted = F.regexp_extract(attrs, rf"""(?s)\b{name}\s*=\s*("[^"]*"|'[^']*')""", 1)
    return F.when(quoted != F.lit(""), _unescape(F.substr(quoted, F.lit(2), F.length(quoted) - 2)))


TRIPLE_SCHEMA = "s string, p string, o string, o_kind string, o_datatype string, pos int"


def scan_rdfxml(
    spark: SparkSession,
    path: str,
    predicates: dict[str, str] | list[str] | None = None,
    prefixes: dict[str, str] | None = None,
    distinct: bool = True,
    missing_ok: bool = True,
) -> DataFrame:
    """Read RDF/XML into the triple table ``(s, p, o, o_kind, o_datatype, pos)``.

    Every child element is read; ``predicates`` (``prefix:local`` names) restricts them.
    ``prefixes`` expands names (defaults: rdf, rdfs, owl, xsd). ``pos`` is the element's position in
    its block. A missing path gives an empty table when ``missing_ok`` (the original prints and stops).
    """
    pre = {**DEFAULT_PREFIXES, **(prefixes or {})}
    try:
        raw = spark.read.option("lineSep", "</rdf:Description>").text(path)
    except Exception as e:  # noqa: BLE001  (PATH_NOT_FOUND is an AnalysisException)
        if missing_ok and "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], TRIPLE_SCHEMA)
        raise
    text = F.regexp_replace("value", r"(?s)<!--.*?-->", "")
    blocks = raw.select(F.regexp_extract(text, _BLOCK, 1).alias("head"), F.regexp_extract(text, _BLOCK, 2).alias("body")).where("head <> ''")
    subject = F.coalesce(_attribute(F.col("head"), "rdf:about"), F.concat(F.lit("_:"), _attribute(F.col("head"), "rdf:nodeID")))
    parts = [F.regexp_extract_all("body", F.lit(_CHILD), F.lit(i)).alias(n) for i, n in ((1, "name"), (2, "attrs"), (3, "inner"))]
    rows = blocks.select(subject.alias("s"), F.posexplode(F.arrays_zip(*parts)).alias("pos", "e")).select("s", "pos", "e.*")
    if predicates is not None:
        rows = rows.where(F.col("name").isin(*predicates))
    rows = rows.select(
        "s", "pos", "name", "inner", *[_attribute(F.col("attrs"), f"rdf:{a}").alias(a) for a in ("resource", "nodeID", "datatype")]
    )
    prefix, local = F.substring_index("name", ":", 1), F.substring_index("name", ":", -1)
    iri = F.col("name")
    for name, full in pre.items():
        iri = F.when((prefix == F.lit(name)) & F.contains("name", F.lit(":")), F.concat(F.lit(full), local)).otherwise(iri)
    o = F.coalesce("resource", F.concat(F.lit("_:"), F.col("nodeID")), _unescape(F.col("inner")))
    kind = F.when(F.col("resource").isNotNull(), "iri").when(F.col("nodeID").isNotNull(), "bnode").otherwise("literal")
    t = rows.select("s", iri.alias("p"), o.alias("o"), kind.alias("o_kind"), F.col("datatype").alias("o_datatype"), "pos")
    t = t.where("s is not null and o is not null")
    return t.dropDuplicates(["s", "p", "o", "o_kind"]) if distinct else t


def discover_predicates(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> dict[str, str]:
    """Opt-in discovery of predicate elements and their kinds with Spark's XML schema inference
    (one extra pass over the sampled input). Library scans take the explicit mapping instead.

    An element that occurs both as plain text and with ``rdf:resource`` cannot be typed by one
    column and raises; pass ``predicates`` explicitly for such files.
    """
    inferred = (
        spark.read.format("xml")
        .option("rowTag", "rdf:Description")
        .option("samplingRatio", str(sampling_ratio))
        .load(path)
        .schema
    )
    kinds: dict[str, str] = {}
    for f in inferred.fields:
        if f.name.startswith("_"):
            continue
        t = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
        if not isinstance(t, T.StructType):
            kinds[f.name] = "literal"
            continue
        names = set(t.fieldNames())
        has_ref = bool(names & {"_rdf:resource", "_rdf:nodeID"})
        has_text = "_VALUE" in names
        if has_ref and has_text:
            raise ValueError(f"element {f.name} is both a literal and a reference; pass predicates explicitly")
        kinds[f.name] = "ref" if has_ref else "typed"
    return kinds


def _xml_escape(c: Column) -> Column:
    out = F.replace(c, F.lit("&"), F.lit("&amp;"))
    for a, b in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\r", "&#13;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def write_rdfxml(triples: DataFrame, path: str, element_prefix: str = "p") -> None:
    """Write triples as RDF/XML text, one ``rdf:Description`` per triple (valid RDF/XML: blocks
    for the same subject merge on read). No grouping by subject, so no shuffle and no skew.

    Predicates must be XML local names; they are written as ``element_prefix:predicate``.
    """
    s, p, o, kind = F.col("s"), F.col("p"), F.col("o"), F.col("o_kind")
    subj = F.when(F.startswith(s, F.lit("_:")), F.concat(F.lit(' rdf:nodeID="'), _xml_escape(F.substring(s, 3, 1 << 30)), F.lit('"'))).otherwise(
        F.concat(F.lit(' rdf:about="'), _xml_escape(s), F.lit('"'))
    )
    el = F.concat(F.lit(element_prefix + ":"), p)
    body = (
        F.when(kind == "literal", F.concat(F.lit("<"), el, F.lit(">"), _xml_escape(o), F.lit("</"), el, F.lit(">")))
        .when(F.startswith(o, F.lit("_:")), F.concat(F.lit("<"), el, F.lit(' rdf:nodeID="'), _xml_escape(F.substring(o, 3, 1 << 30)), F.lit('"/>')))
        .otherwise(F.concat(F.lit("<"), el, F.lit(' rdf:resource="'), _xml_escape(o), F.lit('"/>')))
    )
    line = F.concat(F.lit("<rdf:Description"), subj, F.lit(">"), body, F.lit("</rdf:Description>"))
    header = f'<?xml version="1.0" encoding="utf-8"?>\n<rdf:RDF xmlns:rdf="{RDF_NS}" xmlns:{element_prefix}="urn:{element_prefix}#">\n'
    footer = "\n</rdf:RDF>"
    lines = triples.select(line.alias("value")).mapInPandas(_wrap_root(header, footer), "value string")
    lines.write.mode("overwrite").text(path)


def _wrap_root(header: str, footer: str):
    """Per partition: prefix the first line with the XML header/root and suffix the last with the
    closing tag, so every part file is one well-formed document. Only two rows are touched."""

    def run(batches):
        pending = None
        started = False
        for pdf in batches:
            if len(pdf) == 0:
                continue
            if not started:
                pdf = pdf.copy()
                pdf.iloc[0, 0] = header + pdf.iloc[0, 0]
                started = True
            if pending is not None:
                yield pending
            pending = pdf
        if pending is not None:
            pending = pending.copy()
            pending.iloc[-1, 0] = pending.iloc[-1, 0] + footer
            yield pending

    return run
