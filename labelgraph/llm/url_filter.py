"""URL filters: host-suffix and path-prefix expressions against a rule table, by hash prefix.

Every URL is expanded into the expressions ``host suffix # path prefix`` that a rule could have,
the expressions are joined with the rules on a short prefix of their SHA-256 digest, full digests
confirm the hits, and the longest rule wins. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgraph.llm.common import lower_ascii, only

#: Hex digits of the digest that the join uses (32 bits).
PREFIX_HEX = 8
#: A rule table up to this size is broadcast; a larger one is shuffled.
BROADCAST_RULES = 50_000
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` and ``path``; both are empty for a null URL or one without ``://``."""
    u = F.coalesce(F.col(url), F.lit(""))
    return df.withColumns({"host": lower_ascii(F.regexp_extract(u, _URL, 1)), "path": F.regexp_extract(u, _URL, 2)})


def _keyed(rules: DataFrame) -> DataFrame:
    """One row per rule expression: digest, its prefix, rank and verdict.

    A rule without host fits nothing and goes; a null path is empty and fits every path. Of
    repeated rules for one expression, ``block`` wins over ``allow``.
    """
    host = lower_ascii(F.col("host"))
    path = F.coalesce(F.col("path"), F.lit(""))
    r = only(rules, "host", "path", "action").filter("host is not null and host <> '' and action is not null")
    r = r.select(host.alias("r_host"), path.alias("r_path"), "action")
    r = r.groupBy("r_host", "r_path").agg(F.max("action").alias("action"))  # 'block' > 'allow'
    digest = F.sha2(F.concat("r_host", F.lit("#"), "r_path"), 256)
    return r.select(
        digest.alias("r_digest"),
        F.substring(digest, 1, PREFIX_HEX).alias("r_prefix"),
        F.concat("r_host", "r_path").alias("r_rule"),
        "action",
        F.size(F.split("r_host", r"\.")).alias("labels"),
        F.length("r_path").alias("chars"),
        F.length("r_host").alias("r_host_len"),
    )


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", default: str = "allow") -> DataFrame:
    """Per row of ``pages``: ``key``, host, path, rule (``host/path`` or null), verdict.

    ``rules`` has host, path, action (``allow`` or ``block``). A rule fits its host and all
    subdomains when the path starts with its path. The longest expression wins, then the longer
    host; without a fitting rule the verdict is ``default``. Rows with a null or repeated key are
    judged like others, one result row each; columns besides key and url are ignored.

    The verdict depends on (host, path) alone, so distinct pairs are expanded, and only into the
    shapes (labels of the host suffix, characters of the path prefix) that rules have; Spark's
    skew join spreads a pair that very many rows share.
    """
    spark = pages.sparkSession
    urls = url_parts(only(pages, key, "url")).select(key, "host", "path")
    keyed = _keyed(rules)
    n_rules = keyed.limit(BROADCAST_RULES + 1).count()
    small = n_rules <= BROADCAST_RULES
    # shapes: distinct (labels, chars); at most one for each rule, in practice a few dozen
    shapes = keyed.groupBy("labels", "chars").agg(F.lit(1).alias("one")).drop("one")
    pairs = urls.select("host", "path").distinct()
    fits = (F.size(F.split("host", r"\.")) >= F.col("labels")) & (F.length("path") >= F.col("chars"))
    if small:
        # one array of shapes beside every pair, exploded in place
        shape_rows = [(r["labels"], r["chars"]) for r in shapes.collect()]
        shape_arr = (
            F.array(*[F.struct(F.lit(a).alias("labels"), F.lit(b).alias("chars")) for a, b in sorted(shape_rows)])
            if shape_rows
            else F.from_json(F.lit("[]"), "array<struct<labels:int,chars:int>>")
        )
        wide = pairs.select("host", "path", F.inline(shape_arr))
    else:
        # many rules: the URL's own label count and every shape of it come from a shuffled join
        own = pairs.withColumn("labels", F.explode(F.sequence(F.lit(1), F.size(F.split("host", r"\.")))))
        by_label = shapes.groupBy("labels").agg(F.sort_array(F.collect_set("chars")).alias("sizes"))
        wide = own.join(by_label, "labels").select("host", "path", "labels", F.explode("sizes").alias("chars"))
    suffix = F.expr("substring_index(host, '.', -labels)")
    expr = F.concat(suffix, F.lit("#"), F.expr("left(path, chars)"))
    wide = wide.filter(fits).select("host", "path", F.sha2(expr, 256).alias("digest"))
    wide = wide.withColumn("prefix", F.substring("digest", 1, PREFIX_HEX))
    lookup = keyed.drop("labels", "chars")
    hits = wide.join(F.broadcast(lookup) if small else lookup, wide["prefix"] == lookup["r_prefix"])
    hits = hits.filter(F.col("digest") == F.col("r_digest"))
    rank = F.struct(F.length("r_rule").alias("a"), F.col("r_host_len").alias("b"), F.col("action").alias("c"))
    best = hits.groupBy("host", "path").agg(F.max_by(F.struct("r_rule", "action"), rank).alias("hit"))
    out = urls.join(best, ["host", "path"], "left")
    return out.select(
        key,
        "host",
        "path",
        F.col("hit.r_rule").alias("rule"),
        F.coalesce("hit.action", F.lit(default)).alias("verdict"),
    )
