"""Near-duplicate classes with HyperMinHash: banded compressed registers, corrected estimates, full sets.

A document is its set of two-word shingles. The sketch deals the shingles' hashes to 256 buckets and
stores of each bucket's smallest hash only the number of leading zeros and the ten bits behind the
first one: 16 bits instead of 64, and sketches of unions follow from sketches. Different hashes may
share a register, so an estimate counts equal registers and takes off those that two unrelated sets
of these sizes share on average.

Equal sets are one class. Bands of six registers (empty ones borrow from a filled one) say which
classes may be alike. In each band bucket the class with most company is the pivot, the likely
original; every class is compared with its closest pivot first. Buckets whose members that leaves in
several components are compared whole, in tiles that carry registers and bitmaps, not texts, and only
members of different components whose sizes allow a link. The tiles run twice: first each class
outside its bucket's main component names the one partner that is likeliest, then, with the
components that gives, all pairs that are still apart are named. Pairs whose estimate is far below
the threshold are dropped, as are those whose bitmaps differ in more places than a link allows; all
others are verified on the full shingle sets of the texts.
"""

from __future__ import annotations

import math
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgraph.llm.common import in_filter, low_bits_filter, stored, tidy
from labelgraph.llm.components import components
from labelgraph.llm.shingles import mix64, shingle_hashes, word_hashes

SHINGLE = 2
#: Jaccard similarity of a link, as a fraction.
NUM, DEN = 4, 5
#: Buckets, bits of a hash below its bucket, and mantissa bits of a register.
BUCKETS, HASH_BITS, MANTISSA = 256, 52, 10
EMPTY = 0xFFFF
#: Bands and registers of a band: a pair at the threshold misses all bands with probability
#: (1 - 0.8^6)^42 = 3e-6, a closer pair with less.
BANDS, BAND_SIZE = 42, 6
#: A pair is dropped when its estimate is this many standard errors below the threshold.
MARGIN = 6.0
#: Bits of a bitmap for each element, at least.
BITS_EACH = 8
#: Members of a bucket up to which it is one tile, and members of a tile's side beyond that.
TILE = 1024
#: Texts whose sketch a task remembers, so that copies are not sketched again.
REMEMBERED = 100_000

_FILL = np.random.Generator(np.random.PCG64(20250313)).permuted(np.tile(np.arange(BUCKETS, dtype=np.uint16), (BUCKETS, 1)), axis=1)
_MIX = np.random.Generator(np.random.PCG64(20250314)).integers(1, 1 << 63, BANDS * BAND_SIZE, dtype=np.uint64) | np.uint64(1)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the text's two-word shingles; a single word is one."""
    return np.unique(shingle_hashes(word_hashes(text)[0], SHINGLE))


# ---- sketches ----------------------------------------------------------------------------
def registers(s: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a set of hashes: leading zeros and mantissa of each bucket's least."""
    out = np.full(BUCKETS, EMPTY, dtype=np.uint16)
    if not len(s):
        return out
    low = np.uint64((1 << HASH_BITS) - 1)
    by = np.sort(((s & np.uint64(BUCKETS - 1)) << np.uint64(HASH_BITS)) | (s >> np.uint64(64 - HASH_BITS)))
    bucket = (by >> np.uint64(HASH_BITS)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    part, bits = np.frexp((by[first] & low).astype(np.float64))  # exact: the values have 52 bits
    mantissa = np.maximum(np.floor((2 * part - 1) * (1 << MANTISSA)), 0)
    out[bucket[first]] = ((HASH_BITS - bits) * (1 << MANTISSA) + mantissa).astype(np.uint16)
    return out


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union: more leading zeros, or the smaller mantissa, is the smaller hash."""

    def rank(x):  # smaller for smaller hashes, largest for empty ones
        x = x.astype(np.int64)
        return np.where(x == EMPTY, 1 << 20, (HASH_BITS - (x >> MANTISSA)) * (1 << MANTISSA) + (x & ((1 << MANTISSA) - 1)))

    return np.where(rank(a) <= rank(b), a, b)


_CELLS = 8
_EDGES = np.concatenate([2.0 ** -(i + 1) * (1 + np.arange(_CELLS) / _CELLS) for i in range(HASH_BITS)])
_ENDS = np.concatenate([2.0 ** -(i + 1) * (1 + (np.arange(_CELLS) + 1) / _CELLS) for i in range(HASH_BITS)])


@lru_cache(maxsize=4096)
def _cells(size: int) -> np.ndarray:
    """Probability of each cell to hold a bucket's least value, for a set of this size."""
    return np.exp(size * np.log1p(-_EDGES / BUCKETS)) - np.exp(size * np.log1p(-_ENDS / BUCKETS))


def expected_collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Registers that two sets of n and m unrelated elements share on average.

    A bucket's least value lies in a cell with a probability given by the set's size; an eighth of
    a power of two holds 2^MANTISSA / 8 registers that are about equally likely.
    """
    if not len(n):
        return np.zeros(0)
    (sizes_n, at_n), (sizes_m, at_m) = (np.unique(x, return_inverse=True) for x in (n, m))
    cells_n, cells_m = (np.stack([_cells(int(k)) for k in sizes]) for sizes in (sizes_n, sizes_m))
    if len(sizes_n) * len(sizes_m) <= len(n):
        chance = (cells_n @ cells_m.T)[at_n, at_m]
    else:
        chance = np.concatenate([(cells_n[at_n[i : i + 2048]] * cells_m[at_m[i : i + 2048]]).sum(axis=1) for i in range(0, len(n), 2048)])
    return BUCKETS * chance * _CELLS / (1 << MANTISSA)


def passes(same: np.ndarray, filled: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Whether pairs may be links: equal registers, registers that either has, set sizes.

    The estimate (same - c) / (filled - c), with c expected collisions, must not lie more than
    MARGIN standard errors below the threshold; so few registers rule nothing out.
    """
    filled = np.maximum(filled, 1)
    least = NUM / DEN - MARGIN * np.sqrt(NUM / DEN * (1 - NUM / DEN) / filled)
    ok = (DEN * np.minimum(n, m) >= NUM * np.maximum(n, m)) & (same >= least * filled)  # c only lowers it
    at = np.flatnonzero(ok)
    c = expected_collisions(n[at], m[at])
    ok[at] = same[at] - c >= least[at] * (filled[at] - c)
    return ok


def band_keys(regs: np.ndarray) -> np.ndarray:
    """Keys of all bands for rows of registers, one column for each band.

    An empty register takes the value of the first filled bucket in an order of its own, the same
    for all sets, so filled-up registers agree about as often as the sets do.
    """
    regs = regs.copy()
    for row in np.flatnonzero((regs == EMPTY).any(axis=1)):
        own = regs[row]
        have = np.flatnonzero(own != EMPTY)
        if len(have):
            none = np.flatnonzero(own == EMPTY)
            own[none] = own[have[_FILL[none][:, have].argmin(axis=1)]]
    used = regs[:, : BANDS * BAND_SIZE].astype(np.uint64) + np.uint64(1)
    sums = (used * _MIX).reshape(len(regs), BANDS, BAND_SIZE).sum(axis=2, dtype=np.uint64)
    return mix64(sums + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def is_link(a: np.ndarray, b: np.ndarray) -> bool:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or DEN * len(small) < NUM * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return DEN * both >= NUM * (len(a) + len(b) - both)


# ---- classes of equal sets ---------------------------------------------------------------
def _sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """A row k, h1, h2 (of the text), hi, lo (of the set), n for each document; a task adds the
    registers of equal sets once."""
    t = F.col(f"`{text}`")
    src = docs.select(F.col(f"`{key}`").alias("k"), F.xxhash64(t).alias("h1"), F.xxhash64(F.lit(1), t).alias("h2"), t.alias("t"))
    key_type = src.schema["k"].dataType.simpleString()

    def scan(batches):
        known: dict[tuple[int, int], tuple[int, int, int]] = {}
        given: set[tuple[int, int]] = set()
        for batch in batches:
            out, regs = [], []
            for h1, h2, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                row, raw = known.get((h1, h2)), None
                if row is None:
                    s = shingle_set(t.as_py())
                    ids = np.array([s.sum(dtype=np.uint64), mix64(s ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)], dtype=np.uint64)
                    hi, lo = mix64(ids).view(np.int64).tolist()
                    row = known[(h1, h2)] = (hi, lo, len(s))
                    if len(s) and (hi, lo) not in given:
                        given.add((hi, lo))
                        raw = registers(s).tobytes()
                out.append(row)
                regs.append(raw)
            if len(known) > REMEMBERED:
                known, given = {}, set()
            hi, lo, n = (pa.array(x, pa.int64()) for x in (zip(*out) if out else ([], [], [])))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], hi, lo, n, pa.array(regs, pa.binary())], names=["k", "h1", "h2", "hi", "lo", "n", "regs"])

    return src.mapInArrow(tidy(scan), f"k {key_type}, h1 long, h2 long, hi long, lo long, n long, regs binary")


def _matrix(raw: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(raw.to_pylist()), dtype=np.uint16).reshape(-1, BUCKETS)


def _bands(classes: DataFrame) -> DataFrame:
    """(key, c) for every band of every class."""

    def scan(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                keys = band_keys(_matrix(part.column(1)))
                own = np.repeat(part.column(0).to_numpy(), BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(own)], names=["key", "c"])

    return classes.select("c", "regs").mapInArrow(tidy(scan), "key long, c long")


# ---- candidates --------------------------------------------------------------------------
def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose estimate allows a link."""
    left = classes.select(F.col("c").alias("a"), F.col("n").alias("na"), F.col("regs").alias("ra"))
    right = classes.select(F.col("c").alias("b"), F.col("n").alias("nb"), F.col("regs").alias("rb"))
    full = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "ra", "rb")

    def check(batches):
        for batch in batches:
            x, y = _matrix(batch.column("ra")), _matrix(batch.column("rb"))
            same = ((x == y) & (x != EMPTY)).sum(axis=1)
            filled = ((x != EMPTY) | (y != EMPTY)).sum(axis=1)
            ok = passes(same, filled, batch.column("na").to_numpy(), batch.column("nb").to_numpy())
            take = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(take), batch.column("b").take(take)], names=["a", "b"])

    return full.mapInArrow(tidy(check), "a long, b long")


def _star_pairs(rows: DataFrame) -> DataFrame:
    """(a, b): each class b of a shared bucket with the pivot a that it shares most buckets with.

    A bucket's pivot is its class with most company over all bands: in a group of near copies the
    original, which its copies resemble more than each other.
    """
    company = rows.groupBy("c").agg(F.sum("m").alias("company"))
    ranked = rows.join(company, "c").select("key", "c", "company")
    pivots = ranked.groupBy("key").agg(F.max(F.struct("company", "c")).alias("p"))
    met = ranked.join(pivots, "key").filter("p.c <> c").groupBy("c", "p").agg(F.count(F.lit(1)).alias("times"))
    best = met.groupBy("c").agg(F.max(F.struct("times", "p")).alias("best"))
    return best.select(F.col("best.p.c").alias("a"), F.col("c").alias("b"))


def bitmap(s: np.ndarray) -> bytes:
    """A power of two of bits, BITS_EACH or more for each element; elements set a bit by their hash."""
    bits = np.zeros(1 << max(6, (BITS_EACH * len(s) - 1).bit_length()), dtype=bool)
    bits[((s >> np.uint64(20)) & np.uint64(len(bits) - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def bitmaps_allow(x: int, wide_x: int, n: int, y: int, wide_y: int, m: int) -> bool:
    """Whether sets with these bitmaps and sizes can be a link: a bit that one of them has alone is
    an element that one set has alone. The wider bitmap is folded to the width of the other."""
    while wide_x != wide_y:
        if wide_x < wide_y:
            x, wide_x, y, wide_y = y, wide_y, x, wide_x
        wide_x //= 2
        x = (x >> wide_x) | (x & ((1 << wide_x) - 1))
    return (x ^ y).bit_count() <= n + m - 2 * -(-NUM * (n + m) // (NUM + DEN))


def tile_pairs(regs: np.ndarray, bits: list[bytes], n: np.ndarray, root: np.ndarray, left: np.ndarray, right: np.ndarray, best: bool, step: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (index left, index right, equal registers) that have different roots and that registers
    and bitmaps allow to be links; with ``best`` one for each left index, that with most equal ones.
    Members of one size step meet in two windows and are compared in that of the lower step."""
    out: list[tuple[int, int, int]] = []
    filled = regs != EMPTY
    maps: dict[int, int] = {}

    def as_int(k: int) -> int:
        if k not in maps:
            maps[k] = int.from_bytes(bits[k], "little")
        return maps[k]

    for i in left.tolist():
        fits = (root[right] != root[i]) & (np.minimum(step[right], step[i]) == window) & (DEN * np.minimum(n[right], n[i]) >= NUM * np.maximum(n[right], n[i]))
        at = right[fits]
        if not len(at):
            continue
        same = ((regs[at] == regs[i]) & filled[i]).sum(axis=1)
        ok = passes(same, (filled[at] | filled[i]).sum(axis=1), n[at], np.full(len(at), n[i]))
        at, same = at[ok], same[ok]
        if best:
            order = np.argsort(-same, kind="stable")
            at, same = at[order], same[order]
        for j, score in zip(at.tolist(), same.tolist()):
            if bitmaps_allow(as_int(i), 8 * len(bits[i]), int(n[i]), as_int(j), 8 * len(bits[j]), int(n[j])):
                out.append((i, j, score))
                if best:
                    break
    i, j, score = (np.array(x, dtype=np.int64) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
    return i, j, score


def _bitmaps(bodies: DataFrame) -> DataFrame:
    def scan(batches):
        for batch in batches:
            raw = [bitmap(shingle_set(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["c", "bits"])

    return bodies.select("c", "body").mapInArrow(tidy(scan), "c long, bits binary")


def _tile_pairs(rows: DataFrame, classes: DataFrame, best: bool) -> DataFrame:
    """Pairs (a, b) of classes that share a bucket, have different roots and may be links; with
    ``best`` one pair for each class outside the main roots of its buckets.

    ``rows`` are the members (key, c, root) of buckets with several roots, ``classes`` have n, regs
    and bits. A small bucket is one
    tile. In a large one the members of its most frequent root are major, the others minor; minor
    ones meet each other and the major ones, in chunks, and only where their sizes, in steps that
    cover the threshold, are neighbours. So a bucket of any size spreads over tasks.
    """
    by_root = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("m"))
    per_key = by_root.groupBy("key").agg(F.max_by("root", F.struct("m", "root")).alias("major"), F.sum("m").alias("m"))
    sized = rows.join(classes.select("c", "n", "regs", "bits"), "c").join(per_key, "key").withColumn("minor", F.col("root") != F.col("major"))
    small = sized.filter(F.col("m") <= TILE).select(
        "key", F.lit(2).alias("x"), F.lit(0).alias("w"), F.lit(0).alias("i"), F.lit(0).alias("j"), "c", "n", "root", "minor", F.lit(0).alias("s"), F.lit(0).alias("chunk"), "regs", "bits"
    )
    large = sized.filter(F.col("m") > TILE).withColumn("s", F.floor(F.log("n") / math.log(DEN / NUM * 1.01)).cast("int"))
    counts = large.groupBy("key", "s").agg(F.count(F.when(F.col("minor"), 1)).alias("m1"), F.count(F.when(~F.col("minor"), 1)).alias("m2"))

    def chunks(m: str):
        return F.greatest(F.ceil(F.max(m) / TILE), F.lit(1)).cast("int")

    counts = counts.groupBy("key").agg(chunks("m1").alias("k1"), chunks("m2").alias("k2"))
    large = large.join(counts, "key").withColumn("chunk", F.pmod(F.xxhash64("c"), F.when(F.col("minor"), F.col("k1")).otherwise(F.col("k2"))).cast("int"))
    own = F.col("chunk")

    def tiles(kind: int, k: str, ends):
        return F.transform(F.sequence(F.lit(0), F.col(k) - 1), lambda d: F.struct(F.lit(kind).alias("x"), *[e.alias(name) for e, name in zip(ends(d), "ij")]))

    among = tiles(0, "k1", lambda d: (F.least(own, d), F.greatest(own, d)))
    across = tiles(1, "k2", lambda d: (own, d))
    as_major = tiles(1, "k1", lambda d: (d, own))
    large = large.withColumn("tile", F.explode(F.when(F.col("minor"), F.concat(among, across)).otherwise(as_major)))
    large = large.withColumn("w", F.explode(F.array(F.col("s") - 1, F.col("s"))))
    large = large.select("key", "tile.x", "w", "tile.i", "tile.j", "c", "n", "root", "minor", "s", "chunk", "regs", "bits")
    every = small.unionByName(large).repartition("key", "x", "w", "i", "j").sortWithinPartitions("key", "x", "w", "i", "j")

    def compare(x, w, i, j, c, n, root, minor, s, chunk, regs, bits):
        if x == 2:
            left, right = np.flatnonzero(minor), np.arange(len(c))
        elif x == 0 and i == j:
            left = right = np.flatnonzero(minor)
        else:
            left = np.flatnonzero(minor & (chunk == i))
            right = np.flatnonzero(minor & (chunk == j)) if x == 0 else np.flatnonzero(~minor)
        a, b, score = tile_pairs(regs, bits, n, root, left, right, best, s, w)
        if best and x == 0 and i != j:  # either side looks for its partner
            a2, b2, score2 = tile_pairs(regs, bits, n, root, right, left, best, s, w)
            a, b, score = np.append(a, a2), np.append(b, b2), np.append(score, score2)
        return c[a], c[b], score

    def scan(batches):
        held: list[pa.RecordBatch] = []
        last = None

        def close():
            part = pa.Table.from_batches(held).combine_chunks()
            plain = {name: part[name].to_numpy() for name in ("c", "n", "root", "minor", "s", "chunk")}
            regs = np.frombuffer(b"".join(part["regs"].to_pylist()), dtype=np.uint16).reshape(-1, BUCKETS)
            found = compare(*last[1:], **plain, regs=regs, bits=part["bits"].to_pylist())
            return pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["a", "b", "score"])

        for batch in batches:
            if not batch.num_rows:
                continue
            name = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("key", "x", "w", "i", "j")])
            cut = np.flatnonzero(np.concatenate([[True], (name[:, 1:] != name[:, :-1]).any(axis=0)]))
            for lo, hi in zip(cut, [*cut[1:], batch.num_rows]):
                at = tuple(int(v) for v in name[:, lo])
                if at != last:
                    if held:
                        yield close()
                    last, held = at, []
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield close()

    found = every.mapInArrow(tidy(scan), "a long, b long, score long")
    if best:
        found = found.groupBy("a").agg(F.max_by("b", F.struct("score", "b")).alias("b"))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


# ---- verification ------------------------------------------------------------------------
def _bodies(docs: DataFrame, text: str, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(c, body): one text of each wanted class, found by the 128-bit hash of its text; a filter of
    fixed size keeps most other texts out of the join."""
    reps = classes.join(wanted, "c", "left_semi").select("c", "h1", "h2")
    held = docs.sparkSession.sparkContext.broadcast(low_bits_filter(reps, "h1"))  # 8 MB
    t = F.col(f"`{text}`")
    src = docs.select(F.xxhash64(t).alias("h1"), F.xxhash64(F.lit(1), t).alias("h2"), t.alias("body")).filter("body is not null")

    def scan(batches):
        given: set[tuple[int, int]] = set()
        for batch in batches:
            h1, h2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            take = []
            for i in np.flatnonzero(in_filter(held.value, h1)).tolist():
                if (int(h1[i]), int(h2[i])) not in given:  # copies once for each task
                    given.add((int(h1[i]), int(h2[i])))
                    take.append(i)
            if take:
                yield batch.take(pa.array(take))

    found = src.mapInArrow(tidy(scan), "h1 long, h2 long, body string").join(reps, ["h1", "h2"])
    return found.groupBy("c").agg(F.first("body").alias("body"))


def _verify(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are a link; both texts meet in joins on the classes."""
    left = bodies.select(F.col("c").alias("b"), F.col("body").alias("body_b"))
    right = bodies.select(F.col("c").alias("a"), F.col("body").alias("body_a"))
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


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_shingles, component_id (the smallest key of its component), kept.

    Words stand between ASCII white space, A-Z count as a-z; a document's set holds its distinct
    runs of two words, that of a single word the word. Sets with a Jaccard similarity of 0.8 or
    more are linked; every link is confirmed on the full sets. A pair at the threshold is missed by
    all bands with probability 3e-6, and then only matters if no other link joins its classes.
    Null and text without words have an empty set, 0 shingles and their own key; null keys take
    part in links but never name a component that has another key. ``kept`` says whether the
    component is named by the row's key (null-safe). Repeated rows, ties and equal sets are one
    class; other columns, whatever their names, are ignored; an empty table gives an empty result.
    Texts and sets are told apart by 128-bit hashes, shingles of one pair by 64-bit hashes.
    """
    found = stored(_sketches(docs, key, text), "hmh-sketches")
    light = found.select("k", "hi", "lo", "n")
    classes = found.filter("regs is not null").groupBy("hi", "lo")
    classes = classes.agg(F.first("n").alias("n"), F.first("regs").alias("regs"), F.min(F.struct("h1", "h2")).alias("rep"))
    classes = classes.select("hi", "lo", "n", "regs", "rep.h1", "rep.h2", F.monotonically_increasing_id().alias("c"))
    classes = stored(classes, "hmh-classes")  # the numbers are fixed from here on
    bands = stored(_bands(classes), "hmh-bands")
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    rows = stored(bands.join(shared, "key"), "hmh-shared")
    # first every class with its closest pivot
    star = stored(_estimated(_star_pairs(rows), classes), "hmh-star")
    bodies = stored(_bodies(docs, text, classes, _ends(star)), "hmh-star-texts")
    links = stored(_verify(star, bodies), "hmh-links")
    roots = stored(components(links), "hmh-roots")
    # then what is still apart in some bucket: the likeliest partners, then all
    apart = _apart(rows, roots)
    bodies = stored(_bodies(docs, text, classes, apart.select("c").distinct()), "hmh-texts")
    sized = stored(classes.select("c", "n", "regs").join(_bitmaps(bodies), "c"), "hmh-bitmaps")
    partners = stored(_tile_pairs(apart, sized, best=True).join(_ordered(star), ["a", "b"], "left_anti"), "hmh-partners")
    # components that are known are stars, which are joined in fewer rounds than their links
    roots = stored(components(_stars(roots).unionByName(_verify(partners, bodies))), "hmh-roots")
    apart = _apart(apart, roots)
    done = _ordered(star).unionByName(partners)
    more = stored(_tile_pairs(apart, sized, best=False).join(done, ["a", "b"], "left_anti"), "hmh-pairs")
    joined = components(_stars(roots).unionByName(_verify(more, bodies)))
    # names: the smallest key of each component
    sets = light.filter("n > 0").groupBy("hi", "lo").agg(F.min("k").alias("k"), F.count(F.lit(1)).alias("times"))
    sets = sets.join(classes.select("hi", "lo", "c"), ["hi", "lo"]).join(joined.withColumnRenamed("node", "c"), "c", "left")
    sets = sets.filter("times > 1 or root is not null").withColumn("root", F.coalesce("root", "c"))
    names = sets.groupBy("root").agg(F.min("k").alias("component_id"))
    named = sets.select("hi", "lo", "root").join(names, "root").select("hi", "lo", F.lit(1).alias("some"), "component_id")
    out = light.withColumn("some", F.when(F.col("n") > 0, 1)).join(named, ["hi", "lo", "some"], "left")
    component = F.coalesce("component_id", "k")
    return out.select(F.col("k").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("k").eqNullSafe(component).alias("kept"))


def _apart(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, c, root) of the members of all buckets that hold several roots."""
    own = rows.select("key", "c").join(roots.select(F.col("node").alias("c"), "root"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    several = own.groupBy("key").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).filter("r1 <> r2").select("key")
    return stored(own.join(several, "key", "left_semi"), "hmh-apart")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _stars(roots: DataFrame) -> DataFrame:
    return roots.filter("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b"))


def _ends(pairs: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, [pairs.select(F.col(end).alias("c")) for end in ("a", "b")]).distinct()
