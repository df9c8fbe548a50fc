"""Source divergence audit with late string materialization.

Term counts of each source are compared with their language and with every other source of it. Terms
are shuffled as fixed-width digests only: tasks count by term and send (language, group, digest,
occurrences, documents), all longs. Once the rare digests are gone, a second scan finds the smallest
and largest term of each kept digest; where the two differ the digest stands for several terms, and a
third scan counts those by their full text, so the digest is split. Digests stay in use for all
arithmetic; the text of a term is joined back just for rows that are kept in the output.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelgraph.llm.common import in_filter, low_bits_filter, stored, task_count, tidy

#: Terms once A-Z are a-z: ASCII letters and everything beyond ASCII, as bytes of UTF-8.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_GAP = re.compile(rb"[^a-z\x80-\xff]")
#: Bytes of a text that are cut into terms at once, and different terms that a task holds.
PIECE, HELD_TERMS = 1 << 20, 400_000
#: Probabilities are in units of one in this many.
SCALE = 1_000_000_000
#: Sources whose pairs one tile holds, and rows that a tile's task handles at once.
BLOCK, TILE_ROWS = 128, 200_000
DIGEST_BITS = 64


def terms_in(raw: bytes):
    """Lists of the terms of a text, piece by piece."""
    low, at = raw.lower(), 0  # bytes: A-Z alone change
    while at < len(low):
        gap = _GAP.search(low, min(at + PIECE, len(low)))
        end = gap.start() if gap else len(low)
        yield _TERM.findall(low[at:end])
        at = end + 1


def digest_of(term: bytes, mask: int) -> int:
    d = xxhash.xxh3_64_intdigest(term) & mask
    return d - (1 << 64) if d >> 63 else d


# ---- scans -------------------------------------------------------------------------------
def _counts(src: DataFrame, mask: int, split=None) -> DataFrame:
    """(lh, gh, digest, n, d) summed by digest; with ``split``, a filter of digests, the rows of
    those digests by full term as well."""

    def scan(batches):
        held: dict[tuple[int, int], tuple[Counter, Counter]] = {}

        def report():
            cols: list[list[np.ndarray]] = [[], [], [], [], []]
            text: list[bytes] = []
            for (lh, gh), (times, docs) in held.items():
                terms = list(times)
                digest = np.array([digest_of(t, mask) for t in terms], dtype=np.int64)
                n, d = (np.fromiter(map(c.__getitem__, terms), np.int64, len(terms)) for c in (times, docs))
                if split is not None:
                    take = in_filter(split.value, digest)
                    digest, n, d = digest[take], n[take], d[take]
                    text.extend(t for t, k in zip(terms, take.tolist()) if k)
                for own, x in zip(cols, (np.full(len(digest), lh), np.full(len(digest), gh), digest, n, d)):
                    own.append(x)
            arrays = [pa.array(np.concatenate(x)) for x in cols]
            names = ["lh", "gh", "digest", "n", "d"]
            if split is not None:
                arrays, names = [*arrays, pa.array(text, pa.binary())], [*names, "term"]
            held.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for lh, gh, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                times, docs = held.setdefault((lh, gh), (Counter(), Counter()))
                own: set[bytes] = set()
                for terms in terms_in(t.as_py()):
                    times.update(terms)
                    own.update(terms)
                docs.update(own)
            if sum(len(times) for times, _ in held.values()) > HELD_TERMS:
                yield report()
        if held:
            yield report()

    schema = "lh long, gh long, digest long, n long, d long"
    if split is None:
        return src.mapInArrow(tidy(scan), schema).groupBy("lh", "gh", "digest").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    found = src.mapInArrow(tidy(scan), schema + ", term binary")
    return found.groupBy("lh", "gh", "digest", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def _texts(src: DataFrame, mask: int, kept) -> DataFrame:
    """(lh, digest, lo, hi): smallest and largest term of the digests in the filter ``kept``."""

    def scan(batches):
        seen: dict[int, set[bytes]] = {}

        def report():
            cols: tuple[list, list, list] = ([], [], [])
            for lh, own in seen.items():
                terms = list(own)
                digest = np.array([digest_of(t, mask) for t in terms], dtype=np.int64)
                take = in_filter(kept.value, digest)
                cols[0].append(np.full(int(take.sum()), lh))
                cols[1].append(digest[take])
                cols[2].extend(t for t, k in zip(terms, take.tolist()) if k)
            seen.clear()
            arrays = [pa.array(np.concatenate(cols[0])), pa.array(np.concatenate(cols[1])), pa.array(cols[2], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, names=["lh", "digest", "term"])

        for batch in batches:
            for lh, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = seen.setdefault(lh, set())
                for terms in terms_in(t.as_py()):
                    own.update(terms)
            if sum(map(len, seen.values())) > HELD_TERMS:
                yield report()
        if seen:
            yield report()

    found = src.select("lh", "raw").mapInArrow(tidy(scan), "lh long, digest long, term binary")
    return found.groupBy("lh", "digest").agg(F.min("term").alias("lo"), F.max("term").alias("hi"))


# ---- arithmetic --------------------------------------------------------------------------
def _share(n: str, total: str, terms: str):
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)), in decimals that no count overflows."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10,0)) * cast({n} + 2 as decimal(20,0))) div cast({total} + 2 * {terms} as decimal(20,0))")


def _gain(p: str, q: str):
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def gain(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class _Tile:
    """Sums of gain over terms for the pairs of sources in one tile.

    A pair's sum starts from all its terms being absent in both; a term that one source has adds the
    difference that makes, and a term that both have corrects it. So work follows the sources that
    have a term, not all sources.
    """

    def __init__(self, left: int, source: np.ndarray, block: np.ndarray, p0: np.ndarray, terms: int):
        self.left, self.source, self.block, self.p0, self.terms = left, source, block, p0, terms
        self.base = gain(p0[:, None], p0[None, :])
        n = len(source)
        self.both, self.one = np.zeros((n, n), dtype=np.int64), np.zeros((n, n), dtype=np.int64)

    def add(self, term: np.ndarray, source: np.ndarray, p: np.ndarray) -> None:
        """Rows of whole terms: the term's number and its sources in ascending order."""
        s = np.searchsorted(self.source, source)
        cand, lag = np.arange(len(term)), 1
        while True:
            cand = cand[cand + lag < len(term)]
            cand = cand[term[cand] == term[cand + lag]]
            if not len(cand):
                break
            a, b, pa_, pb = s[cand], s[cand + lag], p[cand], p[cand + lag]
            value = gain(pa_, pb) - gain(pa_, self.p0[b]) - gain(self.p0[a], pb) + self.base[a, b]
            np.add.at(self.both, (a, b), value)
            lag += 1
        order = np.lexsort((p, s))
        s, p = s[order], p[order]
        new = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]) | (p[1:] != p[:-1])])) if len(s) else np.zeros(0, np.int64)
        times = np.diff(np.append(new, len(s)))
        for at in range(0, len(new), 4096):
            i = new[at : at + 4096]
            value = gain(p[i][:, None], self.p0[None, :]) - self.base[s[i]]
            np.add.at(self.one, s[i], value * times[at : at + 4096, None])

    def rows(self, with_base: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The tile's pairs: one side in the left block, the other behind it in the right block."""
        total = self.both + self.one + self.one.T
        if with_base:
            total = total + self.base * self.terms
        right = self.block.max() if len(self.block) else self.left
        i, j = np.triu_indices(len(self.source), 1)
        take = (self.block[i] == self.left) & (self.block[j] == right)
        i, j = i[take], j[take]
        return self.source[i], self.source[j], total[i, j]


def _pairs(rows: DataFrame, groups: DataFrame, tasks: int) -> DataFrame:
    """(lh, a, b, value) for every pair of sources of a language, numbered a < b.

    Sources are cut into blocks; a tile holds two blocks (or one twice) and a share of the terms,
    and streams through its rows, so neither a frequent term nor a language with many sources
    ever meets in memory. Every tile begins with a row for each of its sources.
    """
    tiles = groups.groupBy("lh").agg((F.max("block") + 1).alias("k")).agg(F.sum(F.expr("k * (k + 1) div 2"))).first()[0] or 1
    shares = max(1, -(-2 * tasks // int(tiles)))
    head = groups.select("lh", "i", "block", "blocks", "p0", F.col("terms"), F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"))
    none = F.lit(0).cast("long")
    head = head.select("lh", "i", "block", "blocks", "share", F.lit(0).alias("kind"), none.alias("digest"), none.alias("sub"), F.col("p0").alias("p"), "terms")
    own = groups.select("gh", "i", "block", "blocks")
    body = rows.join(own, "gh").select(
        "lh", "i", "block", "blocks", F.pmod(F.xxhash64("digest", "sub"), F.lit(shares)).cast("int").alias("share"), F.lit(1).alias("kind"), "digest", "sub", "p", none.alias("terms")
    )
    both = head.unionByName(body).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    both = both.select("lh", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "share", "kind", "digest", "sub", "i", "block", "p", "terms")
    both = both.repartition(max(tasks, 1), "lh", "x", "y", "share").sortWithinPartitions("lh", "x", "y", "share", "kind", "digest", "sub", "i")

    def scan(batches):
        tile, at = None, None  # the open tile and its name
        kept: list[np.ndarray] | None = None  # rows of the open tile that are still to be added
        heads: list[tuple] = []

        def close():
            lh, _, _, share = at
            a, b, value = tile.rows(share == 0)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), lh)), pa.array(a), pa.array(b), pa.array(value)], names=["lh", "a", "b", "value"])

        def feed(rows, last):
            """Add all whole terms; of the last term only when it is complete."""
            digest, sub, i, p = rows
            if not len(digest):
                return None
            new = np.concatenate([[True], (digest[1:] != digest[:-1]) | (sub[1:] != sub[:-1])])
            end = len(digest) if last else int(np.flatnonzero(new)[-1])
            if end:
                tile.add(np.cumsum(new)[:end], i[:end], p[:end])
            return [x[end:] for x in rows]

        def open_tile():
            i, block, p0, terms = (np.array(x, dtype=np.int64) for x in zip(*heads))
            return _Tile(at[1], i, block, p0, int(terms[0]))

        for batch in batches:
            cols = [c.to_numpy() for c in batch.columns]
            name = np.stack(cols[:4])
            cut = np.flatnonzero(np.concatenate([[True], (name[:, 1:] != name[:, :-1]).any(axis=0)])) if batch.num_rows else []
            for lo, hi in zip(cut, [*cut[1:], batch.num_rows]):
                key = tuple(int(x) for x in name[:, lo])
                if key != at:
                    if at is not None:
                        tile = tile or open_tile()
                        if kept is not None:
                            feed(kept, True)
                        yield close()
                    at, tile, kept, heads = key, None, None, []
                kind, digest, sub, i, block, p, terms = (c[lo:hi] for c in cols[4:])
                n_head = int((kind == 0).sum())
                heads.extend(zip(*(x[:n_head].tolist() for x in (i, block, p, terms))))
                rows = [x[n_head:] for x in (digest, sub, i, p)]
                if len(rows[0]):
                    tile = tile or open_tile()
                    kept = rows if kept is None else [np.concatenate(x) for x in zip(kept, rows)]
                    if len(kept[0]) >= TILE_ROWS:
                        kept = feed(kept, False)
        if at is not None:
            tile = tile or open_tile()
            if kept is not None:
                feed(kept, True)
            yield close()

    casts = [F.col(c).cast("long") for c in ("lh", "x", "y", "share", "kind", "digest", "sub", "i", "block", "p", "terms")]
    found = both.select(*casts).mapInArrow(tidy(scan), "lh long, a long, b long, value long")
    return found.groupBy("lh", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 10, top: int = 10, digest_bits: int = DIGEST_BITS) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source's terms differ.

    Terms are runs of ASCII letters and characters beyond ASCII, A-Z as a-z; a language keeps those
    in at least ``min_docs`` of its documents. In each source of a language, and in the language,
    a kept term has the share p = 1 + floor(1e9 (count + 2) / (N + 2 V)), N its occurrences of
    kept terms and V the number of kept terms; shares p and q differ by floor((p - q)^2 / (p + q)).
    Part ``pair``: for each other source of the language the sum over all kept terms (0 when there
    are none), all ranks. Part ``term``: the ``top`` kept terms that occur and whose share is above
    the language's. Ranks count from 1 by value descending, then item ascending by UTF-8 bytes.

    Null text, lang and source are read as ''; a text without terms still makes its group occur;
    repeated rows count as often as they come; other columns, whatever their names, are ignored; an
    empty table gives no rows. ``digest_bits`` below 64 forces shared digests, for tests: results
    are the same for any number.
    """
    spark = docs.sparkSession
    mask = (1 << digest_bits) - 1

    def plain(c: str):
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))

    src = docs.select(plain(lang).alias("lang"), plain(source).alias("source"), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("raw"))
    names = stored(src.select("lang", "source").distinct(), "audit-groups")
    for salt in count():  # digests of groups are checked to be unique, with another salt if not
        lh, gh = F.xxhash64(F.lit(salt), "lang").alias("lh"), F.xxhash64(F.lit(salt), "lang", "source").alias("gh")
        keyed = names.select(lh, gh, "lang", "source")
        same_group = keyed.groupBy("gh").count().filter("count > 1")
        same_lang = keyed.groupBy("lh").agg(F.min("lang").alias("lo"), F.max("lang").alias("hi")).filter("lo <> hi")
        if same_group.isEmpty() and same_lang.isEmpty():
            break
    src = src.select(lh, gh, "raw")

    # first scan: digests alone
    counts = stored(_counts(src, mask), "audit-counts")
    kept = stored(counts.groupBy("lh", "digest").agg(F.sum("n").alias("ln"), F.sum("d").alias("ld")).filter(F.col("ld") >= min_docs).drop("ld"), "audit-kept")
    # second scan: smallest and largest term of kept digests
    held = spark.sparkContext.broadcast(low_bits_filter(kept, "digest"))  # 8 MB
    texts = _texts(src, mask, held).join(kept.select("lh", "digest"), ["lh", "digest"], "left_semi")
    texts = stored(texts, "audit-texts")
    zero = F.lit(0).cast("long").alias("sub")
    rows = counts.join(kept, ["lh", "digest"]).select("lh", "gh", "digest", zero, "n", "ln")
    words = texts.filter("lo = hi").select("lh", "digest", zero, F.col("lo").alias("term"))
    shared = texts.filter("lo <> hi").select("lh", "digest")
    if not shared.isEmpty():
        # third scan: digests of several terms are split by the terms themselves
        split = spark.sparkContext.broadcast(low_bits_filter(shared, "digest"))
        by_term = stored(_counts(src, mask, split).join(shared, ["lh", "digest"], "left_semi"), "audit-split")
        sums = by_term.groupBy("lh", "digest", "term").agg(F.sum("n").alias("ln"), F.sum("d").alias("ld")).filter(F.col("ld") >= min_docs)
        sub = F.row_number().over(Window.partitionBy("lh", "digest").orderBy("term")).cast("long")
        sums = stored(sums.select("lh", "digest", "term", "ln", sub.alias("sub")), "audit-split-terms")
        more = by_term.join(sums, ["lh", "digest", "term"]).select("lh", "gh", "digest", "sub", "n", "ln")
        rows = rows.join(shared, ["lh", "digest"], "left_anti").unionByName(more)
        words = words.unionByName(sums.select("lh", "digest", "sub", "term"))
        held_terms = words
    else:
        held_terms = kept
    # totals of languages and groups
    terms = held_terms.groupBy("lh").agg(F.count(F.lit(1)).alias("terms"))
    rows = stored(rows, "audit-rows")
    totals = rows.groupBy("lh", "gh").agg(F.sum("n").alias("total"))
    langs = totals.groupBy("lh").agg(F.sum("total").alias("l_total"))
    order = Window.partitionBy("lh").orderBy("source")
    every = Window.partitionBy("lh")
    groups = keyed.join(totals.drop("lh"), "gh", "left").join(terms, "lh", "left").join(langs, "lh", "left")
    groups = groups.na.fill(0, ["total", "terms", "l_total"])
    groups = groups.withColumn("i", (F.row_number().over(order) - 1).cast("long")).withColumn("sources", F.count(F.lit(1)).over(every))
    groups = groups.withColumns({"block": F.floor(F.col("i") / BLOCK), "blocks": F.ceil(F.col("sources") / BLOCK), "zero": F.lit(0)})
    groups = groups.withColumn("p0", F.when(F.col("terms") > 0, _share("zero", "total", "terms")).otherwise(1))
    groups = stored(groups, "audit-totals")
    # shares
    shares = rows.join(groups.select("gh", "total", "terms", "l_total"), "gh")
    shares = shares.withColumns({"p": _share("n", "total", "terms"), "q": _share("ln", "l_total", "terms")})
    shares = shares.select("lh", "gh", "digest", "sub", "p", "q")
    # terms: all rows up to the rank by digest, texts for them alone, then ties by text
    best = shares.filter("p > q").select("lh", "gh", "digest", "sub", _gain("p", "q").alias("value"))
    by_value = Window.partitionBy("gh").orderBy(F.desc("value"))
    best = best.withColumn("r", F.rank().over(by_value)).filter(F.col("r") <= top).drop("r")
    best = best.join(words, ["lh", "digest", "sub"]).select("gh", F.col("term").alias("item"), "value")
    by_item = Window.partitionBy("gh").orderBy(F.desc("value"), "item")
    best = best.withColumn("rank", F.row_number().over(by_item)).filter(F.col("rank") <= top)
    best = best.join(keyed, "gh").select("lang", "source", F.lit("term").alias("part"), F.col("item").cast("string").alias("item"), "value", "rank")
    # pairs
    n_rows = rows.count()
    several = groups.filter("sources > 1")
    pairs = _pairs(shares.select("lh", "gh", "digest", "sub", "p"), several, task_count(spark, n_rows, TILE_ROWS * 10))
    pairs = stored(pairs, "audit-pairs")
    both = pairs.select("lh", F.col("a").alias("i"), F.col("b").alias("j"), "value").unionByName(pairs.select("lh", F.col("b").alias("i"), F.col("a").alias("j"), "value"))
    mine = groups.select("lh", "i", "lang", "source")
    other = groups.select("lh", F.col("i").alias("j"), F.col("source").alias("item"))
    both = both.join(mine, ["lh", "i"]).join(other, ["lh", "j"])
    ranks = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    both = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", ranks.alias("rank"))
    return both.unionByName(best)
