"""Exact n-gram Jaccard join of documents with set-relation skipping, as connected components.

A document is the set of its word shingles; equal sets are one node. Under one global order of
shingles (rare ones first) two sets that are similar enough share a shingle of their prefixes, so
the prefixes' inverted lists hold every link. Two relations between sets skip most of the work:

* Index level: a list's entries carry set size and position. Entries are cut into blocks, and a
  block is skipped when no entry of it can reach the overlap that a probe needs.
* Answer level: in each list the set with the smallest share of rare shingles is the pivot, the
  likely original of its near copies. Every entry is compared with the pivot first; entries that
  the pivot's answers already connect need no comparison among themselves. Before texts are
  fetched, bitmaps of the sets rule out pairs that only share a chance shingle. What is left of long
  lists is compared in tiles, where the overlaps of a set are derived from its pivot's overlaps:
  |C & B| = |C & P| - |C & (P - B)| + |C & (B - P)|, and B differs from P in few shingles.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelgraph.llm.common import packed_longs, stored, tidy
from labelgraph.llm.components import components
from labelgraph.llm.shingles import mix64, shingle_set

#: Jaccard similarity of a link, as a fraction.
NUM, DEN = 3, 4
#: Shingles counted together by a task before it reports the repeated ones.
COUNT_CHUNK = 4_000_000
#: Repeated shingles that a chunk reports, and that the broadcast order holds. Both only bound the
#: order's size: any order finds all links, a shingle outside it merely counts as rare.
CHUNK_SHINGLES, ORDER_SHINGLES = 100_000, 1_000_000
#: Entries of a list up to which all pairs are listed; longer ones are compared in tiles.
SHORT_LIST = 48
#: Entries of an index block that is skipped at once.
SKIP_BLOCK = 16
#: Members and shingles of one side of a tile.
TILE_MEMBERS, TILE_SHINGLES = 2048, 2_000_000
#: Bits of the filter that says which sets are needed again.
FILTER_BITS = 26


def node_of(s: np.ndarray) -> int:
    """64-bit id of a set (0 for the empty one); equal sets have equal ids."""
    if not len(s):
        return 0
    both = np.array([s.sum(dtype=np.uint64), mix64(s ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64), len(s)], dtype=np.uint64)
    h = mix64(mix64(mix64(both[:1]) + both[1:2]) + both[2:])
    return int(h.view(np.int64)[0]) or 1


def prefix_length(n: int) -> int:
    """Elements of a set of size n among which a similar set has one, under any common order."""
    return n - -(-NUM * n // DEN) + 1


def needed_overlap(a, b):
    """Least overlap of two sets of these sizes that makes a link."""
    return -(-NUM * (a + b) // (NUM + DEN))


def bitmap(s: np.ndarray) -> bytes:
    """Two bits or more for each element, a power of two in all; elements set the bit of their low bits."""
    bits = np.zeros(1 << max(6, (2 * len(s)).bit_length()), dtype=bool)
    bits[(s & np.uint64(len(bits) - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def bitmaps_allow(a: bytes, na: int, b: bytes, nb: int) -> bool:
    """Whether two sets can be a link: every bit that only one bitmap has is an element that only
    one set has. The wider bitmap is folded to the width of the other."""
    x, y, wide = int.from_bytes(a, "little"), int.from_bytes(b, "little"), 8 * max(len(a), len(b))
    least = 8 * min(len(a), len(b))
    if len(a) > len(b):
        x, y = y, x
    while wide > least:
        wide //= 2
        y = (y >> wide) | (y & ((1 << wide) - 1))
    return (x ^ y).bit_count() <= na + nb - 2 * needed_overlap(na, nb)


def is_link(a: np.ndarray, b: np.ndarray) -> bool:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or DEN * len(small) < NUM * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return DEN * both >= NUM * (len(a) + len(b) - both)


# An entry's set size, position and share of rare shingles in one long: sorts by share first.
def pack(n, pos, share):
    return (share << 56) | (n << 28) | pos


def unpack(p: Column) -> tuple[Column, Column]:
    """Set size and position."""
    return F.shiftright(p, 28).bitwiseAND(F.lit(0xFFFFFFF)), p.bitwiseAND(F.lit(0xFFFFFFF))


# ---- pass 1: sets, ids, repeated shingles -----------------------------------------------
def _sets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """A row k, th (text hash), node, n, bits for every document; and token, n for repeated shingles.
    A task gives the bitmap of equal sets once."""
    src = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"), F.xxhash64(F.col(f"`{text}`")).alias("th"))
    key_type = src.schema["k"].dataType.simpleString()

    def scan(batches):
        kind, held, size, seen = None, [], 0, set()

        def report():
            u, c = np.unique(np.concatenate(held), return_counts=True)
            u, c = u[c > 1], c[c > 1]
            if len(u) > CHUNK_SHINGLES:
                top = np.argpartition(-c, CHUNK_SHINGLES)[:CHUNK_SHINGLES]
                u, c = u[top], c[top]
            none = pa.nulls(len(u))
            return pa.RecordBatch.from_arrays(
                [none.cast(kind), none.cast(pa.int64()), none.cast(pa.int64()), pa.array(c, pa.int64()), pa.array(u.view(np.int64)), none.cast(pa.binary())],
                names=["k", "th", "node", "n", "token", "bits"],
            )

        for batch in batches:
            kind = batch.schema.field(0).type
            nodes, counts, bits = [], [], []
            for t in batch.column(1):
                s = shingle_set(t.as_py())
                node = node_of(s)
                nodes.append(node)
                counts.append(len(s))
                bits.append(None if node in seen or not node else bitmap(s))
                if node not in seen:
                    seen.add(node)
                    held.append(s)
                    size += len(s)
            n = len(nodes)
            cols = [batch.column(0), batch.column(2), pa.array(nodes, pa.int64()), pa.array(counts, pa.int64())]
            cols += [pa.nulls(n, pa.int64()), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["k", "th", "node", "n", "token", "bits"])
            if size >= COUNT_CHUNK:
                yield report()
                held, size, seen = [], 0, set()
        if held:
            yield report()

    return src.mapInArrow(tidy(scan), f"k {key_type}, th long, node long, n long, token long, bits binary")


def _order(found: DataFrame):
    """The most repeated shingles with their counts: at most ORDER_SHINGLES, sorted for lookup.

    A histogram of the counts, in steps of an eighth of a power of two, tells from which count on
    all shingles fit.
    """
    sums = found.filter("token is not null").groupBy("token").agg(F.sum("n").alias("n"))
    sums = sums.withColumn("step", F.floor(8 * F.log2("n")))
    least, room = None, ORDER_SHINGLES
    for r in sorted(sums.groupBy("step").agg(F.count(F.lit(1)).alias("c")).collect(), key=lambda r: -r["step"]):
        if r["c"] > room:
            break
        least, room = r["step"], room - r["c"]
    if least is None:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    token, n = packed_longs(sums.filter(F.col("step") >= least), "token", "n")  # at most ORDER_SHINGLES rows
    token = token.view(np.uint64)
    by = np.argsort(token)
    return token[by], n[by]


# ---- pass 2: inverted lists of the prefixes ----------------------------------------------
def _postings(docs: DataFrame, text: str, order) -> DataFrame:
    """(token, node, entry) for the prefix of each set; a task lists equal sets once."""

    def scan(batches):
        tokens, times = order.value
        seen: set[int] = set()
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], []]
            for t in batch.column(0):
                s = shingle_set(t.as_py())
                n = len(s)
                node = node_of(s)
                if n == 0 or node in seen:
                    continue
                seen.add(node)
                if len(tokens):
                    at = np.searchsorted(tokens, s)
                    at[at == len(tokens)] = 0
                    often = np.where(tokens[at] == s, times[at], 0)
                else:
                    often = np.zeros(n, dtype=np.int64)
                p = prefix_length(n)
                first = np.argsort(often, kind="stable")[:p]  # ties in shingle order
                share = int((often == 0).sum()) * 127 // n
                out[0].append(s[first].view(np.int64))
                out[1].append(np.full(p, node, dtype=np.int64))
                out[2].append(pack(n, np.arange(p, dtype=np.int64), share))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["token", "node", "entry"])

    return docs.select(F.col(f"`{text}`")).mapInArrow(tidy(scan), "token long, node long, entry long")


def _with_pivots(postings: DataFrame) -> DataFrame:
    """Entries of lists that have two nodes or more, each with its list's pivot (the first entry).

    Lists are read in order, one entry after the other, so a list of any length passes through.
    """
    by_token = postings.repartition("token").sortWithinPartitions("token", "entry", "node")

    def scan(batches):
        last = None  # token, node and entry of the pivot, node of the last row
        for batch in batches:
            token, node, entry = (batch.column(i).to_numpy() for i in range(3))
            n = len(token)
            if not n:
                continue
            new = np.concatenate([[last is None or token[0] != last[0]], token[1:] != token[:-1]])
            # pivot of each row: the row that opened its list, or the one carried over
            open_ = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            p_node = np.where(open_ >= 0, node[open_], last[1] if last else 0)
            p_entry = np.where(open_ >= 0, entry[open_], last[2] if last else 0)
            again = ~new & (node == np.concatenate([[last[3] if last else 0], node[:-1]]))  # equal sets of two tasks
            keep = ~new & ~again & (node != p_node)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[keep]) for x in (token, node, entry, p_node, p_entry)], names=["token", "node", "entry", "pivot", "p_entry"]
            )
            last = (token[-1], p_node[-1], p_entry[-1], node[-1])

    return by_token.mapInArrow(tidy(scan), "token long, node long, entry long, pivot long, p_entry long")


def _reachable(n1, pos1, n2, pos2):
    """Whether sets of these sizes whose first common element has these positions can be a link."""
    fits = DEN * np.minimum(n1, n2) >= NUM * np.maximum(n1, n2)
    return fits & (np.minimum(n1 - pos1, n2 - pos2) >= needed_overlap(n1, n2))


# ---- comparing ---------------------------------------------------------------------------
def _needed_filter(nodes: DataFrame) -> np.ndarray:
    """Bit map of the nodes' hashes: fixed size whatever their number; a false hit only costs work."""
    bit = F.pmod(F.xxhash64("node"), F.lit(1 << FILTER_BITS))
    words = nodes.select(F.shiftright(bit, 6).alias("w"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(node), {1 << FILTER_BITS}) & 63 as int))").alias("b"))
    w, b = packed_longs(words.groupBy("w").agg(F.bit_or("b").alias("b")), "w", "b")  # at most 2^20 rows
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    out[w] = b
    return out


def _texts_of(docs: DataFrame, text: str, nodes: DataFrame) -> DataFrame:
    """(node, body): one text for each wanted node; a filter of fixed size keeps most others back."""
    bits = docs.sparkSession.sparkContext.broadcast(_needed_filter(nodes))
    plain = docs.select(F.col(f"`{text}`").alias("body")).filter("body is not null")

    def scan(batches):
        held = bits.value
        seen: set[int] = set()
        for batch in batches:
            keep, ids = [], []
            for i, t in enumerate(batch.column(0)):
                node = node_of(shingle_set(t.as_py()))
                if node and node not in seen:
                    seen.add(node)
                    keep.append(i)
                    ids.append(node)
            if keep:
                at = spark_bits(np.array(ids, dtype=np.int64))
                hit = (held[at >> 6] >> (at & 63)) & 1 == 1
                rows = batch.take(pa.array(np.array(keep, dtype=np.int64)[hit]))
                yield pa.RecordBatch.from_arrays([pa.array(np.array(ids, dtype=np.int64)[hit]), rows.column(0)], names=["node", "body"])

    found = plain.mapInArrow(tidy(scan), "node long, body string")
    return found.groupBy("node").agg(F.first("body").alias("body"))


def spark_bits(nodes: np.ndarray) -> np.ndarray:
    """``pmod(xxhash64(node), 2^FILTER_BITS)`` of Spark for longs."""
    import xxhash

    raw = np.ascontiguousarray(nodes, dtype="<i8").tobytes()
    out = [xxhash.xxh64_intdigest(raw[i : i + 8], 42) & ((1 << FILTER_BITS) - 1) for i in range(0, len(raw), 8)]
    return np.array(out, dtype=np.int64)


def _possible(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """The pairs (a, b) that the sets' bitmaps allow; drops nearly all that share a chance shingle."""
    left = bits.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bits").alias("bits_a"))
    right = bits.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bits_b"))
    full = pairs.select("a", "b").join(left, "a").join(right, "b")

    def check(batches):
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in ("bits_a", "na", "bits_b", "nb")])
            take = pa.array([i for i, r in enumerate(rows) if bitmaps_allow(*r)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(take), batch.column("b").take(take)], names=["a", "b"])

    return full.mapInArrow(tidy(check), "a long, b long")


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are a link; both texts meet in a join on the nodes."""
    left = texts.select(F.col("node").alias("b"), F.col("body").alias("body_b"))
    right = texts.select(F.col("node").alias("a"), F.col("body").alias("body_a"))
    full = pairs.join(left, "b").join(right, "a").select("a", "b", "body_a", "body_b")

    def check(batches):
        last, own = None, None
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            good = []
            for i, (x, ta, tb) in enumerate(zip(a.to_pylist(), batch.column(2), batch.column(3))):
                if x != last:
                    last, own = x, shingle_set(ta.as_py())
                if is_link(own, shingle_set(tb.as_py())):
                    good.append(i)
            take = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([a.take(take), b.take(take)], names=["a", "b"])

    return full.mapInArrow(tidy(check), "a long, b long")


def _open_pairs(lists: DataFrame) -> DataFrame:
    """Besides the pairs with pivots. Short lists: pairs (a, b) of entries that can be links, job
    null. Long lists: their entries (job = pivot, a = node), to be compared in tiles.
    """
    by_token = lists.repartition("token").sortWithinPartitions("token", "n", "node")

    def pairs(node, n, pos):
        """Entries by ascending size: for each, whole blocks of larger ones are skipped by their
        least size and their greatest rest behind the position."""
        m = len(node)
        rest = n - pos
        edges = np.arange(0, m, SKIP_BLOCK)
        least, most = np.minimum.reduceat(n, edges), np.maximum.reduceat(rest, edges)
        out = []
        for i in range(m - 1):
            for k in range((i + 1) // SKIP_BLOCK, len(edges)):
                if DEN * n[i] < NUM * least[k]:
                    break
                if min(rest[i], most[k]) < needed_overlap(n[i], max(n[i], least[k])):
                    continue
                j = np.arange(max(i + 1, edges[k]), min(m, edges[k] + SKIP_BLOCK))
                j = j[_reachable(n[i], pos[i], n[j], pos[j])]
                out.extend((node[i], node[x]) for x in j)
        return out

    def scan(batches):
        last, rows, job = None, [], False

        def close():
            if len(rows) < 2:
                return []
            node, n, pos = (np.array(x) for x in zip(*[r[:3] for r in rows]))
            return [(None, min(a, b), max(a, b)) for a, b in pairs(node, n, pos)]

        def batch_of(out):
            j, a, b = zip(*out) if out else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(j, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["job", "a", "b"])

        for batch in batches:
            out = []
            cols = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for token, node, n, pos, pivot in zip(*cols):
                if token != last:
                    if not job:
                        out.extend(close())
                    last, rows, job = token, [], False
                if job:
                    out.append((pivot, node, None))
                    continue
                rows.append((node, n, pos, pivot))
                if len(rows) > SHORT_LIST:
                    job = True
                    out.extend((r[3], r[0], None) for r in rows)
                    rows = []
            yield batch_of(out)
        if not job:
            yield batch_of(close())

    cols = by_token.select("token", "node", "n", "pos", "pivot")
    return cols.mapInArrow(tidy(scan), "job long, a long, b long")


def tile_links(texts: list[str], roots: np.ndarray, left: np.ndarray, right: np.ndarray, pivot: str) -> list[tuple[int, int]]:
    """Links between unconnected members of the two sides, as far as they join components.

    All overlaps are derived from the pivot's: each set is held as what it lacks of the pivot and
    what it has besides, and a set's overlap with every other one is the pivot's own overlap with
    that one less the lacking and plus the additional shingles it has.
    """
    sets = [shingle_set(t) for t in texts]
    hub = shingle_set(pivot)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    li, ri = np.flatnonzero(left), np.flatnonzero(right)
    base = np.array([np.isin(sets[j], hub, assume_unique=True).sum() for j in ri], dtype=np.float32)
    over = np.repeat(base[None, :], len(li), axis=0)

    def add(own: list[np.ndarray], sign: int) -> None:
        flat = np.concatenate(own) if own else np.zeros(0, np.uint64)
        cols = np.unique(flat)
        for c in range(0, len(cols), 1024):
            part = cols[c : c + 1024]
            rows = [(x >= part[0]) & (x <= part[-1]) for x in own]
            a = np.zeros((len(li), len(part)), dtype=np.float32)
            for i, (x, keep) in enumerate(zip(own, rows)):
                a[i, np.searchsorted(part, x[keep])] = 1
            b = np.zeros((len(ri), len(part)), dtype=np.float32)
            for k, j in enumerate(ri):
                s = sets[j]
                at = np.searchsorted(s, part)
                at[at == len(s)] = 0
                b[k] = s[at] == part
            np.add(over, sign * (a @ b.T), out=over)

    add([np.setdiff1d(hub, sets[i], assume_unique=True) for i in li], -1)
    gained = [np.setdiff1d(sets[i], hub, assume_unique=True) for i in li]
    # what a set has besides the pivot matters only where a set of the other side has it too
    other = np.unique(np.concatenate([np.setdiff1d(sets[j], hub, assume_unique=True) for j in ri])) if len(ri) else np.zeros(0, np.uint64)
    count_l = np.concatenate(gained) if gained else np.zeros(0, np.uint64)
    both = np.intersect1d(np.unique(count_l), other, assume_unique=True)
    if len(li) == len(ri) and np.array_equal(li, ri):
        u, c = np.unique(count_l, return_counts=True)
        both = u[c > 1]  # a set's overlap with itself isn't asked for
    add([g[np.isin(g, both, assume_unique=True)] for g in gained], 1)
    total = size[li][:, None] + size[ri][None, :]
    link = (DEN * over >= NUM * (total - over)) & (roots[li][:, None] != roots[ri][None, :])
    out: list[tuple[int, int]] = []
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    for i, j in zip(*np.nonzero(link)):
        a, b = find(int(roots[li[i]])), find(int(roots[ri[j]]))
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((int(li[i]), int(ri[j])))
    return out


def _tiles(jobs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links among a job's members that have different roots.

    A job's members are those of all long lists with one pivot. Members of its most frequent
    component are major, the others minor; a job without minor members is done. Minor members are
    compared with each other and with the major ones, in tiles of bounded members and shingles,
    so a job of any size spreads over tasks.
    """
    by_root = jobs.groupBy("job", "root").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("w"))
    top = by_root.groupBy("job").agg(F.max_by("root", F.struct("m", "root")).alias("major"), F.count(F.lit(1)).alias("roots"))
    top = top.filter("roots > 1")
    stats = by_root.join(top, "job").groupBy("job", "major").agg(
        F.sum(F.when(F.col("root") != F.col("major"), F.col("m")).otherwise(0)).alias("m1"),
        F.sum(F.when(F.col("root") != F.col("major"), F.col("w")).otherwise(0)).alias("w1"),
        F.sum(F.when(F.col("root") == F.col("major"), F.col("m")).otherwise(0)).alias("m2"),
        F.sum(F.when(F.col("root") == F.col("major"), F.col("w")).otherwise(0)).alias("w2"),
    )

    def chunks(m: str, w: str):
        return F.greatest(F.ceil(F.col(m) / TILE_MEMBERS), F.ceil(F.col(w) / TILE_SHINGLES), F.lit(1)).cast("int")

    stats = stats.select("job", "major", chunks("m1", "w1").alias("k1"), chunks("m2", "w2").alias("k2"))
    rows = jobs.join(stats, "job").withColumn("minor", F.col("root") != F.col("major"))
    rows = rows.withColumn("c", F.pmod(F.xxhash64("node"), F.when(F.col("minor"), F.col("k1")).otherwise(F.col("k2"))).cast("int"))
    # a minor chunk c meets minor chunks in tiles (0, low, high) and major chunk d in (1, c, d)
    among = F.transform(
        F.sequence(F.lit(0), F.col("k1") - 1),
        lambda d: F.struct(F.lit(0).alias("x"), F.least(F.col("c"), d).alias("i"), F.greatest(F.col("c"), d).alias("j")),
    )
    across = F.transform(F.sequence(F.lit(0), F.col("k2") - 1), lambda d: F.struct(F.lit(1).alias("x"), F.col("c").alias("i"), d.alias("j")))
    as_major = F.transform(F.sequence(F.lit(0), F.col("k1") - 1), lambda d: F.struct(F.lit(1).alias("x"), d.alias("i"), F.col("c").alias("j")))
    rows = rows.withColumn("tile", F.explode(F.when(F.col("minor"), F.concat(among, across)).otherwise(as_major)))
    rows = rows.select("job", "tile", "node", "root", "minor", "c")
    none = {"node": F.col("job"), "root": F.lit(None).cast("long"), "minor": F.lit(None).cast("boolean"), "c": F.lit(None).cast("int")}
    hubs = rows.select("job", "tile").distinct().withColumns(none)  # the pivot itself, once in each tile
    rows = rows.unionByName(hubs).join(texts, "node").select("job", "tile.x", "tile.i", "tile.j", "node", "root", "minor", "c", "body")

    def compare(key, table):
        _, x, i, j = (k.as_py() for k in key)
        hub = table.filter(pc.is_null(table["minor"]))["body"][0].as_py()
        table = table.filter(pc.is_valid(table["minor"])).combine_chunks()
        node, root = table["node"].to_numpy(), table["root"].to_numpy()
        minor, c = table["minor"].to_numpy(zero_copy_only=False), table["c"].to_numpy()
        left = minor & (c == i)
        right = (minor & (c == j)) if x == 0 else ~minor
        found = tile_links(table["body"].to_pylist(), root, left, right, hub)
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array([int(node[k]) for k in a], pa.int64()), "b": pa.array([int(node[k]) for k in b], pa.int64())})

    return rows.groupBy("job", "x", "i", "j").applyInArrow(compare, "a long, b long")


def _named(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(k, th, n, component_id) of every document."""
    spark = docs.sparkSession
    found = stored(_sets(docs, key, text), "join-sets")
    light = found.filter("token is null").select("k", "th", "node", "n")
    order = spark.sparkContext.broadcast(_order(found))
    lists = stored(_with_pivots(_postings(docs, text, order)), "join-lists")
    n, pos = unpack(F.col("entry"))
    p_n, p_pos = unpack(F.col("p_entry"))
    lists = lists.select("token", "node", "pivot", n.alias("n"), pos.alias("pos"), p_n.alias("p_n"), p_pos.alias("p_pos"))
    fits = (DEN * F.least("n", "p_n") >= NUM * F.greatest("n", "p_n")) & (
        F.least(F.col("n") - F.col("pos"), F.col("p_n") - F.col("p_pos")) * (NUM + DEN) >= NUM * (F.col("n") + F.col("p_n"))
    )
    bits = found.filter("bits is not null").groupBy("node").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))
    bits = stored(bits, "join-bits")
    with_pivot = lists.filter(fits).select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    with_pivot = stored(_possible(with_pivot, bits), "join-pivot-pairs")
    beside = stored(_open_pairs(lists).distinct(), "join-beside")
    others = stored(_possible(beside.filter("job is null"), bits), "join-other-pairs")
    jobs = beside.filter("job is not null").select("job", F.col("a").alias("node"))
    ends = [df.select(F.col(c).alias("node")) for df, c in ((with_pivot, "a"), (with_pivot, "b"), (others, "a"), (others, "b"), (jobs, "job"), (jobs, "node"))]
    wanted = reduce(DataFrame.union, ends).distinct()
    texts = stored(_texts_of(docs, text, wanted), "join-texts")
    # answer level, first part: everything against its pivot
    links = stored(_verify(with_pivot, texts), "join-links")
    roots = stored(components(links), "join-roots")
    # second part: what the pivots left unconnected
    for end in ("a", "b"):
        own = roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
        others = others.join(own, end, "left").withColumn(f"root_{end}", F.coalesce(f"root_{end}", end))
    more = _verify(others.filter("root_a <> root_b").select("a", "b"), texts)
    size = bits.select("node", "n")
    jobs = jobs.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).join(size, "node")
    more = more.unionByName(_tiles(stored(jobs, "join-jobs"), texts))
    joined = components(links.unionByName(more))
    # names: the smallest key of each component
    classes = light.filter("n > 0").groupBy("node").agg(F.min("k").alias("k"), F.count(F.lit(1)).alias("c"))
    classes = classes.join(joined, "node", "left").filter("c > 1 or root is not null").withColumn("root", F.coalesce("root", "node"))
    names = classes.groupBy("root").agg(F.min("k").alias("component_id"))
    named = classes.select("node", "root").join(names, "root").select("node", "component_id")
    out = light.join(named, "node", "left")
    return out.select("k", "th", "n", F.coalesce("component_id", "k").alias("component_id"))


def similar_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_shingles, component_id (the smallest key of its component).

    Words stand between ASCII white space, A-Z count as a-z; a document's set holds its distinct
    runs of five words, a shorter one's the whole sequence. Sets with a Jaccard similarity of 0.75
    or more are linked, exactly. Null and text without words have an empty set, 0 shingles and
    their own key; null keys take part in links but never name a component that has another key.
    Repeated rows, ties and equal sets are one node; extra columns are ignored; an empty table
    gives an empty result. Sets are told apart by 64-bit ids of 64-bit shingle hashes.
    """
    named = _named(docs, key, text)
    return named.select(F.col("k").alias(key), F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, all columns unchanged; rows without words all stay.

    It is the row with the smallest key, of several such rows that with the smallest text hash,
    of equal rows any. A component of null keys alone keeps one row.
    """
    named = stored(_named(docs, key, text), "join-names")
    first = named.filter("n > 0 and k <=> component_id").groupBy("k").agg(F.min("th").alias("th"), F.count(F.lit(1)).alias("c"))
    worded = F.coalesce(F.col(f"`{text}`").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    k, th = F.col(f"`{key}`"), F.xxhash64(F.col(f"`{text}`"))
    first = first.select(F.col("k").alias("_join_k"), F.col("th").alias("_join_th"), "c")
    kept = docs.filter(worded).join(first, k.eqNullSafe(F.col("_join_k")) & (th == F.col("_join_th")), "left_semi")
    if first.filter("c > 1").limit(1).count():
        kept = kept.withColumn("_join_th", th).dropDuplicates([key, "_join_th"]).drop("_join_th")
    return docs.filter(~worded).unionByName(kept)
