"""Derived test views over the driver tables (FIXTURES.md §3).

Each view is one portable SQL text. Spark runs it over temp views of the parquet tables; the
DuckDB oracle inlines the same text as a CTE, so both engines see identical inputs. Texts are
used whole (no prefixes). Backslashes are written as ``chr(92)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

FX_SQL: dict[str, str] = {}

FX_SQL["fx_triples"] = """
SELECT 'urn:t#'||replace(r_name,' ','_') AS s,'type' AS p,'urn:t#Area' AS o,'iri' AS o_kind,0 AS pos FROM region
UNION ALL SELECT 'urn:t#'||n_name,'type','urn:t#Area','iri',0 FROM nation
UNION ALL SELECT 'urn:t#'||replace(s_name,'#','_'),'type','urn:t#Area','iri',0 FROM supplier
UNION ALL SELECT 'urn:t#'||n_name||' é😀','type','urn:t#Area','iri',0 FROM nation
UNION ALL SELECT 'urn:t#'||n_name||' é😀','partOfArea','urn:t#'||n_name,'iri',0 FROM nation
UNION ALL SELECT DISTINCT 'urn:t#'||p_type,'type','urn:t#Scope','iri',0 FROM part
UNION ALL SELECT DISTINCT 'urn:t#'||replace(p_brand,'#','_'),'type','urn:t#Scope','iri',0 FROM part
UNION ALL SELECT DISTINCT 'urn:t#'||c_mktsegment,'type','urn:t#Ability','iri',0 FROM customer
UNION ALL SELECT 'urn:t#'||replace(c_name,'#','_'),'type','urn:t#Ability','iri',0 FROM customer
UNION ALL SELECT 'urn:t#Area','type','urn:t#Class','iri',0 FROM region WHERE r_regionkey=0
UNION ALL SELECT '_:b'||CAST(r_regionkey AS STRING),'type','urn:t#Area','iri',0 FROM region
UNION ALL SELECT 'urn:t#'||n_name,'partOfArea','urn:t#'||replace(r_name,' ','_'),'iri',0 FROM nation JOIN region ON n_regionkey=r_regionkey
UNION ALL SELECT 'urn:t#'||replace(s_name,'#','_'),'partOfArea','urn:t#'||n_name,'iri',0 FROM supplier JOIN nation ON s_nationkey=n_nationkey
UNION ALL SELECT 'urn:t#'||replace(s_name,'#','_'),'partOfArea','urn:t#'||n_name,'iri',1 FROM supplier JOIN nation ON (s_nationkey+1)%25=n_nationkey WHERE s_suppkey%10=0
UNION ALL SELECT DISTINCT 'urn:t#'||replace(p_brand,'#','_'),'partOfScope','urn:t#'||p_type,'iri',0 FROM part
UNION ALL SELECT 'urn:t#'||replace(c_name,'#','_'),'partOfAbility','urn:t#'||c_mktsegment,'iri',0 FROM customer
UNION ALL SELECT 'urn:t#'||replace(a.s_name,'#','_'),'expandsArea','urn:t#'||replace(b.s_name,'#','_'),'iri',0 FROM supplier a JOIN supplier b ON b.s_suppkey=a.s_suppkey-1 WHERE a.s_suppkey%8<>0
UNION ALL SELECT 'urn:t#'||n_name,'isDefinedBy',text,'literal',0 FROM nation JOIN benchmark ON item_id=n_nationkey
UNION ALL SELECT 'urn:t#'||replace(c_name,'#','_'),'comment','example: '||text,'literal',100 FROM customer JOIN benchmark ON item_id=c_custkey
UNION ALL SELECT 'urn:t#'||replace(c_name,'#','_'),'isDefinedBy',text,'literal',0 FROM customer JOIN documents ON doc_id=c_custkey
UNION ALL SELECT 'urn:t#'||replace(c_name,'#','_'),'comment',text,'literal',CAST(turn AS INT) FROM customer JOIN conversations ON conv_id=c_custkey
UNION ALL SELECT 'urn:t#'||replace(c_name,'#','_'),'partOfArea','urn:t#'||n_name,'iri',0 FROM customer JOIN nation ON c_nationkey=n_nationkey WHERE c_custkey%50=0
UNION ALL SELECT 'urn:t#'||replace(c_name,'#','_'),'partOfAbility','urn:t#Ghost','iri',0 FROM customer WHERE c_custkey%60=1
UNION ALL SELECT 'urn:t#'||replace(c_name,'#','_'),'type','urn:t#Area','iri',1 FROM customer WHERE c_custkey%70=0
UNION ALL SELECT 'urn:t#'||replace(s_name,'#','_'),'isDefinedBy',CASE WHEN s_suppkey%11=0 THEN '' WHEN s_suppkey%13=0 THEN ' '||chr(10) ELSE text||chr(10) END,'literal',0 FROM supplier JOIN documents ON doc_id=s_suppkey WHERE s_suppkey%4<>0
UNION ALL SELECT 'urn:t#'||replace(s_name,'#','_'),'isDefinedBy','second definition of '||s_name,'literal',1 FROM supplier WHERE s_suppkey%4<>0 AND s_suppkey%5=0
UNION ALL SELECT 'urn:t#'||replace(s_name,'#','_'),'comment',CASE WHEN turn%4=0 THEN 'EXAMPLE: ' ELSE '' END||text,'literal',CAST(turn AS INT) FROM supplier JOIN conversations ON conv_id=s_suppkey
UNION ALL SELECT 'partOf'||k,'inverseOf','hasPart'||k,'iri',0 FROM (SELECT DISTINCT CASE WHEN r_regionkey=0 THEN 'Area' WHEN r_regionkey=1 THEN 'Scope' ELSE 'Ability' END AS k FROM region) AS d
UNION ALL SELECT 'partOf'||k,'subPropertyOf','partOf','iri',0 FROM (SELECT DISTINCT CASE WHEN r_regionkey=0 THEN 'Area' WHEN r_regionkey=1 THEN 'Scope' ELSE 'Ability' END AS k FROM region) AS d
UNION ALL SELECT 'partOf'||k,'domain','urn:t#'||k,'iri',0 FROM (SELECT DISTINCT CASE WHEN r_regionkey=0 THEN 'Area' WHEN r_regionkey=1 THEN 'Scope' ELSE 'Ability' END AS k FROM region) AS d
UNION ALL SELECT 'partOf'||k,'range','urn:t#'||k,'iri',0 FROM (SELECT DISTINCT CASE WHEN r_regionkey=0 THEN 'Area' WHEN r_regionkey=1 THEN 'Scope' ELSE 'Ability' END AS k FROM region) AS d
UNION ALL SELECT 'urn:t#'||k,'subClassOf','urn:t#Descriptor','iri',0 FROM (SELECT DISTINCT CASE WHEN r_regionkey=0 THEN 'Area' WHEN r_regionkey=1 THEN 'Scope' ELSE 'Ability' END AS k FROM region) AS d
UNION ALL SELECT 'expandsArea','inverseOf','expandedByArea','iri',0 FROM region WHERE r_regionkey=0
UNION ALL SELECT 'expandsArea','subPropertyOf','expands','iri',0 FROM region WHERE r_regionkey=0
UNION ALL SELECT 'expandsArea','domain','urn:t#Area','iri',0 FROM region WHERE r_regionkey=0
UNION ALL SELECT 'expandsArea','range','urn:t#Area','iri',0 FROM region WHERE r_regionkey=0
UNION ALL SELECT 'urn:t#Sample','subClassOf','_:areas','bnode',0 FROM region WHERE r_regionkey=0
UNION ALL SELECT 'urn:t#Sample','subClassOf','_:abilities','bnode',0 FROM region WHERE r_regionkey=0
UNION ALL SELECT '_:areas','onProperty','hasArea','iri',0 FROM region WHERE r_regionkey=0
UNION ALL SELECT '_:areas','onClass','urn:t#Area','iri',0 FROM region WHERE r_regionkey=0
UNION ALL SELECT '_:areas','qualifiedCardinality','1','literal',0 FROM region WHERE r_regionkey=0
UNION ALL SELECT '_:abilities','onProperty','hasAbility','iri',0 FROM region WHERE r_regionkey=0
UNION ALL SELECT '_:abilities','onClass','urn:t#Ability','iri',0 FROM region WHERE r_regionkey=0
UNION ALL SELECT '_:abilities','minQualifiedCardinality','1','literal',0 FROM region WHERE r_regionkey=0
"""

FX_SQL["fx_entries"] = """
SELECT 'data/'||source||'/'||CAST(d.doc_id AS STRING)||'/meta.json' AS meta_path, 0 AS pos,
 CASE WHEN d.doc_id%23=0 THEN '{"questionImage": ' WHEN d.doc_id%29=0 THEN '"a string"' ELSE
 '{"n":'||CAST(d.doc_id AS STRING)||CASE WHEN d.doc_id%17=0 THEN '' WHEN d.doc_id%31=0 THEN ',"questionImage":["img.png"]' WHEN d.doc_id%37=0 THEN ',"questionImage":"[5].png"' WHEN d.doc_id%2=0 THEN ',"questionImage":"..'||chr(92)||chr(92)||'img'||chr(92)||chr(92)||CAST(d.doc_id AS STRING)||'.png"' ELSE ',"questionImage":"img/'||CAST(d.doc_id AS STRING)||'.png"' END
 ||CASE WHEN l.doc_id IS NULL THEN '' WHEN d.doc_id%19=0 THEN ',"labels":null' WHEN d.doc_id%11=0 THEN ',"labels":"text label é😀 '||chr(92)||'u00e9'||chr(92)||'n'||chr(92)||'"q'||chr(92)||'""' ELSE ',"labels":{"Areas":["'||CASE WHEN d.doc_id%7=3 THEN 'Zoë 😀, '||chr(92)||'"x'||chr(92)||'": ' ELSE 'NATION_'||CAST(d.doc_id%25 AS STRING) END||'"],"Scopes":["Brand_'||CAST(1+d.doc_id%25 AS STRING)||'"],"Abilities":["'||CASE WHEN toxic=1 THEN 'MACHINERY' ELSE 'BUILDING' END||'"]}' END||'}' END AS entry
FROM documents d LEFT JOIN labels l ON d.doc_id=l.doc_id
"""

FX_SQL["fx_meta_files"] = """
SELECT meta_path, CASE WHEN length(meta_path)%2=0 AND entry LIKE '%null%' THEN entry ELSE '['||entry||',{"labels":{}}]' END AS value FROM fx_entries
"""

FX_SQL["fx_images"] = """
SELECT 'data/'||source||CASE WHEN doc_id%2=0 THEN '' ELSE '/'||CAST(doc_id AS STRING) END||'/img/'||CAST(doc_id AS STRING)||'.png' AS path, n_chars AS length FROM documents WHERE doc_id%9<>0
"""

FX_SQL["fx_predictions"] = """
SELECT l_orderkey AS sample_id,'Area' AS dim,replace(s_name,'#','_') AS term, l_linenumber AS pos FROM lineitem JOIN supplier ON l_suppkey=s_suppkey
UNION ALL SELECT l_orderkey,'Area',n_name,100+l_linenumber FROM lineitem JOIN supplier ON l_suppkey=s_suppkey JOIN nation ON s_nationkey=n_nationkey WHERE l_linenumber%2=0
UNION ALL SELECT l_orderkey,'Area',replace(r_name,' ','_'),200+l_linenumber FROM lineitem JOIN supplier ON l_suppkey=s_suppkey JOIN nation ON s_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey WHERE l_linenumber=1
UNION ALL SELECT l_orderkey,'Scope',replace(p_brand,'#','_'),l_linenumber FROM lineitem JOIN part ON l_partkey=p_partkey
UNION ALL SELECT l_orderkey,'Scope',CASE WHEN l_orderkey%5=0 THEN 'UNKNOWN' ELSE p_type END,100+l_linenumber FROM lineitem JOIN part ON l_partkey=p_partkey WHERE l_linenumber%3=0
UNION ALL SELECT o_orderkey,'Ability',CASE WHEN o_orderkey%31=0 THEN 'ASIA' ELSE c_mktsegment END,1 FROM orders JOIN customer ON o_custkey=c_custkey
"""

FX_SQL["fx_responses"] = """
SELECT conv_id*1000+turn AS sample_id,'system'||chr(10)||'s'||chr(10)||'user'||chr(10)||text||chr(10)||CASE WHEN turn%7=6 THEN '' ELSE 'assistant'||chr(10) END||CASE (conv_id*8+turn)%17 WHEN 0 THEN '{"Error":"NotMathMaterial"}' 
 WHEN 1 THEN '{"Error":"Other"}' WHEN 2 THEN '{"Areas":["NATION_1","NATION_1"],"Scopes":["Brand_1"],"Abilities":[]}' WHEN 3 THEN '{"Area":["NATION_2"],"Scope":[],"Ability":["BUILDING"]}' WHEN 4 THEN '{"Areas":["NATION_3"' WHEN 5 THEN ' {"Areas":["NATION_4","Nope"],"Scopes":["Brand_1","Brand_2","Brand_3"],"Abilities":["BUILDING"]} ' WHEN 6 THEN '{"labels":{"Areas":["NATION_5"],"Scopes":["Brand_1"],"Abilities":["BUILDING"]}}' WHEN 7 THEN '{"Error":"NotMathMaterial","Areas":["NATION_1"]}' WHEN 8 THEN '{"error":"AreaNotCovered"}' WHEN 9 THEN '["NATION_1"]' WHEN 10 THEN '{"error":null,"labels":{"Areas":["NATION_6","ASIA"],"Scopes":["Brand_4","Brand_5","Brand_6"],"Abilities":["MACHINERY"]}}' WHEN 11 THEN '{"Areas":"A","Scopes":{},"Abilities":5}' WHEN 12 THEN '{"Areas":["BUILDING"],"Scopes":["NATION_1"],"Abilities":["Brand_1"]}' WHEN 13 THEN '{"note":1}' WHEN 14 THEN '{"Areas":["'||md5(text)||'"],"Scopes":[1,2],"Abilities":["BUILDING"]}' WHEN 15 THEN text ELSE '{"Areas":null,"Scopes":["Brand_1"],"Abilities":["BUILDING"]}' END AS response FROM conversations
"""

FX_SQL["fx_tokens"] = """
SELECT l_orderkey AS seq, l_linenumber AS pos, CAST(l_partkey%10 AS INT) AS pred, CAST(CASE WHEN l_returnflag='N' THEN -100 ELSE l_suppkey%10 END AS INT) AS label FROM lineitem
"""

FX_SQL["fx_frames"] = """
SELECT user_id AS media_id, event_id, ts FROM events
"""

FX_SQL["fx_pages"] = """
SELECT doc_id, CAST(1+floor(n_chars/2000) AS INT) AS n_pages FROM documents
"""

# a graph with planted cycles: chains of suppliers that close, nations that are below some of their
# customers, customers below themselves
FX_SQL["fx_links"] = """
SELECT 'S'||CAST(s_suppkey AS STRING) AS child, 'S'||CAST(s_suppkey-1 AS STRING) AS parent FROM supplier WHERE s_suppkey%8<>0
UNION ALL SELECT 'S'||CAST(s_suppkey-5 AS STRING), 'S'||CAST(s_suppkey AS STRING) FROM supplier WHERE s_suppkey%24=7
UNION ALL SELECT 'S'||CAST(s_suppkey AS STRING), 'N'||CAST(s_nationkey AS STRING) FROM supplier
UNION ALL SELECT 'C'||CAST(c_custkey AS STRING), 'N'||CAST(c_nationkey AS STRING) FROM customer
UNION ALL SELECT 'N'||CAST(c_nationkey AS STRING), 'C'||CAST(c_custkey AS STRING) FROM customer WHERE c_custkey%40=7
UNION ALL SELECT 'C'||CAST(c_custkey AS STRING), 'C'||CAST(c_custkey AS STRING) FROM customer WHERE c_custkey%97=0 OR c_custkey%80=7
UNION ALL SELECT 'N'||CAST(n_nationkey AS STRING), 'R'||CAST(n_regionkey AS STRING) FROM nation
"""

# fixture -> fixtures it reads (besides base tables)
FX_DEPS = {"fx_meta_files": ["fx_entries"]}

# Fixtures stored once per session as parquet in the shared folder, like the production
# layout: the triple table partitioned by predicate so ``p = ...`` filters prune whole folders.
# The first query that uses one pays for the write; later queries read the stored table. A query that
# reads one only once takes the plan itself.
MATERIALISED = {"fx_triples": ["p"], "fx_predictions": []}


# Lazy DataFrames (plans, not data) memoised per session and folder: reading a parquet
# footer and analysing a fixture is driver work that every query would otherwise repeat.
_TABLES: dict[tuple[str, str], dict[str, DataFrame]] = {}
_FIXTURES: dict[tuple[str, str, str], DataFrame] = {}


def _session_key(spark: SparkSession) -> str:
    """Application id + session object: a stopped and restarted session never reuses plans."""
    return f"{spark.sparkContext.applicationId}:{id(spark)}"


def register_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Register the driver's parquet tables as temp views; return them by name."""
    key = (_session_key(spark), sf_dir.rstrip("/"))
    if key not in _TABLES:
        _TABLES[key] = {t: spark.read.parquet(f"{key[1]}/{t}.parquet") for t in TABLES}
    out = _TABLES[key]
    for t, df in out.items():
        df.createOrReplaceTempView(t)
    return out


def fixture(spark: SparkSession, sf_dir: str, name: str, store: bool = True) -> DataFrame:
    """Build fixture view ``name`` over ``sf_dir`` (registers base tables and dependencies). Without ``store`` the
    view stays a plan even if it is in ``MATERIALISED``, unless a query before has stored it: for a query that reads
    its rows once, or few of them."""
    stored = (_session_key(spark), sf_dir.rstrip("/"), name)
    store = name in MATERIALISED and (store or stored in _FIXTURES)
    key = stored if store or name not in MATERIALISED else (*stored[:2], f"{name} as a plan")
    if key not in _FIXTURES:
        register_tables(spark, sf_dir)
        for dep in FX_DEPS.get(name, []):
            fixture(spark, sf_dir, dep).createOrReplaceTempView(dep)
            register_tables(spark, sf_dir)
        df = spark.sql(FX_SQL[name])
        if store:
            from labelgraph.session import scratch_path, shuffles_freed

            path = scratch_path(spark, name)
            w = df.write.mode("overwrite")
            if MATERIALISED[name]:
                w = w.partitionBy(*MATERIALISED[name])
            with shuffles_freed(spark):
                w.parquet(path)
            df = spark.read.schema(df.schema).parquet(path).select(*df.columns)
        _FIXTURES[key] = df
    return _FIXTURES[key]


def derived(spark: SparkSession, sf_dir: str, name: str, build):
    """What ``build()`` derives from fixtures and stores, once for a session and folder."""
    key = (_session_key(spark), sf_dir.rstrip("/"), name)
    if key not in _FIXTURES:
        _FIXTURES[key] = build()
    return _FIXTURES[key]


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix an oracle query with the fixture views it needs, as DuckDB CTEs."""
    ordered: list[str] = []
    for n in names:
        for dep in FX_DEPS.get(n, []):
            if dep not in ordered:
                ordered.append(dep)
        if n not in ordered:
            ordered.append(n)
    body = sql.strip()
    if not ordered:
        return body
    ctes = ",\n".join(f"{n} AS ({FX_SQL[n].strip()})" for n in ordered)
    head = body[:15].upper()
    if head.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if head.startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
