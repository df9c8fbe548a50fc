"""Substring dedup: paragraphs by MinHash bands, verified exactly, removed by components.

Paragraphs are the lines of a text, the blocks of consecutive short lines between blank or long
ones and, so that a passage inside another line is found too, the pieces between content-defined
cut points: of every CUT_WINDOW consecutive word shingles the
one with the smallest hash starts a piece, so equal passages are cut alike wherever they stand.
A line's or block's bands are runs of MinHash values; a piece has one band of all its shingles.
Colliding lines are compared exactly and lines that are similar enough form components. Pieces count as runs
of LEAST_WORDS words, told apart by a digest of their words. Of a component (or of equal runs) the
occurrence in the first document stays and the others are to be removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelgraph.llm.common import carried, stored, tidy
from labelgraph.llm.components import components
from labelgraph.llm.jaccard_join import DEN, NUM, is_link
from labelgraph.llm.shingles import SHINGLE, mix64, shingle_hashes, shingle_set, word_hashes

#: Words of a line that makes a paragraph: one shingle. Consecutive lines of fewer than SHORT_WORDS
#: words make a block, which is treated as one more line.
LINE_WORDS, SHORT_WORDS = SHINGLE, 20
#: Bands of ROWS MinHash values: lines of similarity 0.75 collide with probability 0.996, of 0.9
#: with 0.9999998.
BANDS, ROWS = 10, 3
#: Shingles among which a cut point is chosen. A passage of W words contains whole pieces of at
#: least W - 2 * CUT_WINDOW + 1 words: the first cut is at CUT_WINDOW - 1 at most, the last one at
#: W - CUT_WINDOW - 4 at least, and a piece's words end 4 behind its last shingle's start.
CUT_WINDOW = 12
#: Words of a run of pieces, and the fewest words of a removal: with CUT_WINDOW, no shared passage of
#: more than 50 words is missed.
LEAST_WORDS = 28
#: Lines of a bucket's chunk; two chunks are compared at a time.
TILE = 256
#: Characters of the texts that a worker treats together; a longer text is one chunk.
CHUNK_CHARS = 1_000_000
#: Bits of the filter that says which band values occur in several documents.
FILTER_BITS, PART_BITS = 27, 20

_SEEDS = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)


def cut_points(h: np.ndarray, window: int = CUT_WINDOW, own: np.ndarray | None = None) -> np.ndarray:
    """Positions that hold the minimum (the last one, of equals) of a window of ``window`` hashes;
    ``own`` tells the windows that count."""
    if len(h) < window:
        return np.zeros(0, dtype=np.int64)
    views = np.lib.stride_tricks.sliding_window_view(h, window)[:, ::-1]
    at = np.arange(len(views)) + window - 1 - views.argmin(axis=1)
    return np.unique(at if own is None else at[own])


def _combine(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One hash for each run of shingles that begins at ``starts`` and ends before the next."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    return mix64(np.add.reduceat(mix64(h + np.uint64(1)), starts) + np.diff(np.append(starts, len(h))).astype(np.uint64))


class Paragraphs:
    """The paragraphs of some texts: pieces and lines with word spans, content hashes and bands.

    Words are numbered through all the texts, which an empty line keeps apart; ``doc`` is the text
    that a word is in. Many texts at once cost about as many array operations as one.
    """

    def __init__(self, *texts: str | None):
        whole = "\n\n".join(t or "" for t in texts)
        words, self.starts, self.ends = word_hashes(whole)
        self.raw = whole.encode("utf-8", "surrogatepass")
        b = np.frombuffer(self.raw, dtype=np.uint8)
        size = np.array([len((t or "").encode("utf-8", "surrogatepass")) + 2 for t in texts], dtype=np.int64)
        self.base = np.cumsum(size) - size
        self.doc = np.searchsorted(self.base, self.starts, side="right") - 1
        self.first_word = np.searchsorted(self.starts, self.base)
        n = len(words)
        h = shingle_hashes(words) if n >= SHINGLE else np.zeros(0, dtype=np.uint64)
        reach = CUT_WINDOW + SHINGLE - 2  # words from a window's first to its last
        cuts = cut_points(h, CUT_WINDOW, self.doc[: max(0, n - reach)] == self.doc[reach:])
        # a piece: the shingles from one cut point to the next of the same text, and the words they cover
        same = self.doc[cuts[1:]] == self.doc[cuts[:-1]]
        self.piece_start = cuts[:-1][same]
        self.piece_end = cuts[1:][same] + (SHINGLE - 1)
        self.piece_key = _combine(h[cuts[0] : cuts[-1]], cuts[:-1] - cuts[0])[same] if len(cuts) > 1 else np.zeros(0, np.uint64)
        # lines by the line feeds before each word
        row = np.cumsum(b == 10)[self.starts] if n else np.zeros(0, np.int64)
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if n else np.zeros(0, np.int64)
        last = np.append(first[1:], n)
        self.line_start, self.line_end = self._lines(first, last, row[first])
        self.line_key = np.zeros(0, dtype=np.uint64)
        self.bands = np.zeros((0, BANDS), dtype=np.uint64)
        if len(self.line_start):
            # shingles inside each line, one line after the other
            size = self.line_end - self.line_start - (SHINGLE - 1)
            at = np.cumsum(size) - size
            own = h[np.repeat(self.line_start - at, size) + np.arange(size.sum())]
            self.line_key = _combine(own, at)
            # the hashes are scrambled already: an odd factor orders them anew
            low = np.stack([np.minimum.reduceat(own * seed, at) for seed in _SEEDS], axis=1)
            bands = np.zeros((len(at), BANDS), dtype=np.uint64)
            for k in range(ROWS):
                bands = mix64(bands + low[:, k::ROWS])
            self.bands = mix64(bands + np.arange(1, BANDS + 1, dtype=np.uint64))
            # up to two shingles are similar to equal sets alone, and those share every band
            self.bands[size <= 2] = self.bands[size <= 2, :1]

    @staticmethod
    def _lines(first: np.ndarray, last: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word spans of the lines, and of the blocks of two or more consecutive short lines."""
        short = last - first < SHORT_WORDS
        joined = short[1:] & short[:-1] & (np.diff(row) == 1)
        begin = np.flatnonzero(np.concatenate([[True], ~joined])) if len(first) else np.zeros(0, np.int64)
        stop = np.append(begin[1:], len(first)) - 1
        block = stop > begin
        start = np.concatenate([first, first[begin[block]]])
        end = np.concatenate([last, last[stop[block]]])
        keep = end - start >= LINE_WORDS
        return start[keep], end[keep]

    def windows(self, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word spans of the shortest runs of held pieces that have LEAST_WORDS words, from each
        piece onwards and from each piece back; they cover every longer run."""
        n = len(self.piece_start)
        one = np.concatenate([np.arange(n), np.searchsorted(self.piece_start, self.piece_end - LEAST_WORDS, side="right") - 1])
        two = np.concatenate([np.searchsorted(self.piece_end, self.piece_start + LEAST_WORDS), np.arange(n)])
        inside = (one >= 0) & (two < n)
        pair = np.unique(one[inside] * n + two[inside])
        one, two = pair // max(n, 1), pair % max(n, 1)
        missing = np.concatenate([[0], np.cumsum(~held)])
        own = self.doc[self.piece_start]
        whole = (missing[two + 1] == missing[one]) & (own[one] == own[two])
        return self.piece_start[one[whole]], self.piece_end[two[whole]]

    def chars(self) -> np.ndarray:
        """Characters before each byte, over all texts."""
        b = np.frombuffer(self.raw, dtype=np.uint8)
        return np.concatenate([[0], np.cumsum((b & 0xC0) != 0x80)])


def _chunks(batch):
    """Texts of a batch by the million characters, with their row numbers and document hashes."""
    rows, texts, held = [], [], 0
    owners = batch.column(2).to_numpy()
    for i, t in enumerate(batch.column(1)):
        text = t.as_py()
        rows.append(i)
        texts.append(text)
        held += len(text or "")
        if held >= CHUNK_CHARS:
            yield np.array(rows), Paragraphs(*texts), owners[rows]
            rows, texts, held = [], [], 0
    if rows:
        yield np.array(rows), Paragraphs(*texts), owners[rows]


def _keys(docs: DataFrame) -> DataFrame:
    """(key, d) of all pieces and bands; d is the document's hash."""

    def scan(batches):
        for batch in batches:
            for _, p, d in _chunks(batch):
                key = np.concatenate([p.piece_key, p.bands.reshape(-1)])
                doc = np.concatenate([p.doc[p.piece_start], np.repeat(p.doc[p.line_start], BANDS)])
                order = np.lexsort((key, doc))
                key, doc = key[order], doc[order]
                new = np.ones(len(key), dtype=bool)
                new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(key[new].view(np.int64)), pa.array(d[doc[new]])], names=["key", "d"])

    return docs.select("k", "t", "d").mapInArrow(tidy(scan), "key long, d long")


def _bits(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two filter bits of a key."""
    mask = np.uint64((1 << FILTER_BITS) - 1)
    return (key & mask).astype(np.int64), ((key >> np.uint64(FILTER_BITS)) & mask).astype(np.int64)


def _shared_filter(keys: DataFrame) -> np.ndarray:
    """Bit map, of fixed size, of two bits for each key that more than one document has."""
    shared = keys.groupBy("key").agg(F.min("d").alias("d1"), F.max("d").alias("d2")).filter("d1 <> d2")
    mask = F.lit((1 << FILTER_BITS) - 1)
    both = F.array(F.col("key").bitwiseAND(mask), F.shiftright("key", FILTER_BITS).bitwiseAND(mask))
    bits = shared.select(F.explode(both).alias("bit")).withColumn("part", F.shiftright("bit", PART_BITS).cast("int"))
    parts = bits.repartition(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), "part")

    def pack(batches):
        # a task holds the parts it gets, a share of the filter with one byte for a bit
        maps: dict[int, np.ndarray] = {}
        for batch in batches:
            bit, part = batch.column("bit").to_numpy(), batch.column("part").to_numpy()
            order = np.argsort(part, kind="stable")
            edges = np.flatnonzero(np.diff(part[order], prepend=-1))
            for own in np.split(bit[order], edges[1:]) if len(bit) else ():
                at = int(own[0]) >> PART_BITS
                held = maps.setdefault(at, np.zeros(1 << PART_BITS, dtype=bool))
                held[own & ((1 << PART_BITS) - 1)] = True
        for at, held in maps.items():
            raw = np.packbits(held, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([raw])], names=["part", "raw"])

    out = np.zeros((1 << FILTER_BITS) // 8, dtype=np.uint8)
    size = (1 << PART_BITS) // 8
    for r in parts.mapInArrow(tidy(pack), "part int, raw binary").toLocalIterator():  # the filter, part by part
        out[r["part"] * size : (r["part"] + 1) * size] = np.frombuffer(r["raw"], np.uint8)
    return out


_UNIT = "d long, key long, line long, start long, end long, char_start long, char_end long, body string"
_UNIT_NAMES = [c.split()[0] for c in _UNIT.split(", ")]


def _digest(raw: bytes) -> str:
    """A digest of the words, as ``word_hashes`` tells them apart."""
    return hashlib.md5(b" ".join(raw.lower().split()), usedforsecurity=False).hexdigest()


def _units(docs: DataFrame, held) -> DataFrame:
    """Paragraphs whose keys are in the filter, with k, d and their spans. Runs of pieces: key and
    line null, a digest of the words in ``body``. Lines: one row for each (line = content hash; the
    line itself in ``body``, once for equal lines read together), and one with key and line alone
    for each of its bands that may collide."""
    kind = docs.schema["k"].dataType.simpleString()

    def scan(batches):
        bits = held.value

        def inside(keys: np.ndarray) -> np.ndarray:
            one, two = _bits(keys)
            return ((bits[one >> 3] >> (one & 7)) & (bits[two >> 3] >> (two & 7)) & 1) == 1

        def spans(batch, rows, p, d, s, e, line, body):
            """Rows of paragraphs from word ``s`` up to word ``e``."""
            doc = p.doc[s]
            before = p.chars()
            b0, b1, zero = p.starts[s], p.ends[e - 1], before[p.base[doc]]
            word = p.first_word[doc]
            none = pa.nulls(len(s), pa.int64())
            cols = [batch.column(0).take(pa.array(rows[doc])), d[doc], none, none if line is None else line]
            cols += [s - word, e - word, before[b0] - zero, before[b1] - zero]
            texts = [p.raw[x:y] for x, y in zip(b0.tolist(), b1.tolist())]
            if body is None:
                cols.append(pa.array([_digest(x) for x in texts], pa.string()))
            else:
                cols.append(pa.array([x.decode("utf-8", "replace") if own else None for x, own in zip(texts, body)], pa.string()))
            return [c if isinstance(c, pa.Array) else pa.array(c) for c in cols]

        names = ["k", *_UNIT_NAMES]
        for batch in batches:
            for rows, p, d in _chunks(batch):
                s, e = p.windows(inside(p.piece_key))
                if len(s):
                    yield pa.RecordBatch.from_arrays(spans(batch, rows, p, d, s, e, None, None), names=names)
                band = inside(p.bands)
                line = np.flatnonzero(band.any(axis=1))
                if not len(line):
                    continue
                key = p.line_key[line].view(np.int64)
                once = np.unique(key, return_index=True)[1]
                own = np.zeros(len(line), dtype=bool)
                own[once] = True
                yield pa.RecordBatch.from_arrays(spans(batch, rows, p, d, p.line_start[line], p.line_end[line], key, own), names=names)
                line = line[once]
                at, which = np.nonzero(band[line])
                at = line[at]
                first = (which == 0) | (p.bands[at, which] != p.bands[at, 0])
                at, which = at[first], which[first]
                n = len(at)
                cols = [pa.nulls(n, batch.schema.field(0).type), pa.nulls(n, pa.int64())]
                cols += [pa.array(p.bands[at, which].view(np.int64)), pa.array(p.line_key[at].view(np.int64))]
                cols += [pa.nulls(n, pa.int64())] * 4 + [pa.nulls(n, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select("k", "t", "d").mapInArrow(tidy(scan), f"k {kind}, {_UNIT}")


def tile_links(sets: list[np.ndarray], roots: list[int]) -> list[tuple[int, int]]:
    """Links between members of different roots, as far as they join components; every such pair
    is compared by its exact overlap unless links found before connect it."""
    size = np.array([len(x) for x in sets])
    root = np.array(roots)
    owner = np.repeat(np.arange(len(sets)), size)
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    order = np.argsort(ids, kind="stable")
    posting, edge = owner[order], np.concatenate([[0], np.cumsum(np.bincount(ids))])
    at = np.cumsum(size) - size
    out = []
    for i in range(1, len(sets)):
        own = ids[at[i] : at[i] + size[i]]
        n = edge[own + 1] - edge[own]
        take = np.repeat(edge[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        both = np.bincount(posting[take], minlength=len(sets))[:i]
        for j in np.flatnonzero(DEN * both >= NUM * (size[i] + size[:i] - both)):
            if root[i] != root[j]:
                out.append((i, int(j)))
                root[root == root[j]] = root[i]
    return out


def _tiled(bands: DataFrame, ends: DataFrame, roots: DataFrame, bodies: DataFrame) -> DataFrame:
    """(a, b): links between lines of one bucket that the pivots leave in different components.

    An open bucket is cut into chunks by hash, and every two chunks meet in a tile of bounded
    size, so all its pairs are compared and a hot bucket is spread over many tasks."""
    rest = bands.join(ends, "key").filter("line <> lo and line <> hi").select("key", "line").join(roots, "line")
    rest = stored(rest, "dedup-rest")
    left = rest.groupBy("key").agg(F.min("root").alias("r1"), F.max("root").alias("r2"), F.count(F.lit(1)).alias("n")).filter("r1 <> r2")
    left = stored(left.select("key", F.ceil(F.col("n") / TILE).cast("int").alias("chunks")), "dedup-open")
    at = F.pmod(F.xxhash64("line", "key"), F.col("chunks")).cast("int")
    member = rest.join(left, "key").withColumn("at", at).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    member = member.select(F.xxhash64("key", F.least("at", "other"), F.greatest("at", "other")).alias("tile"), "line", "root")
    member = member.join(bodies, "line")
    by_tile = member.repartition(int(bands.sparkSession.conf.get("spark.sql.shuffle.partitions")), "tile").sortWithinPartitions("tile")

    def links_of(rows):
        name, roots, texts = zip(*rows)
        found = tile_links([shingle_set(x) for x in texts], list(roots)) if len(set(roots)) > 1 else []
        return [(name[i], name[j]) for i, j in found]

    def scan(batches):
        last, rows = None, []
        for batch in batches:
            out = []
            for tile, *row in zip(*[batch.column(c).to_pylist() for c in ("tile", "line", "root", "body")]):
                if tile != last and rows:
                    out += links_of(rows)
                    rows = []
                last = tile
                rows.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])
        if rows:
            out = links_of(rows)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return by_tile.mapInArrow(tidy(scan), "a long, b long")


def _similar_lines(units: DataFrame) -> DataFrame:
    """(line, root): lines joined to components by exact similarity of colliding pairs.

    In each band bucket every line meets two pivots first, the ends of an order that differs from
    bucket to bucket. Where the others of a bucket are then in different components, all its pairs
    that no link connects are compared in tiles.
    """
    bands = stored(units.filter("key is not null and line is not null").select("key", "line").distinct(), "dedup-bands")
    turned = F.col("line").bitwiseXOR(F.col("key"))
    ends = bands.groupBy("key").agg(F.min(turned).alias("lo"), F.max(turned).alias("hi")).filter("lo <> hi")
    ends = stored(ends.select("key", *[F.col(c).bitwiseXOR(F.col("key")).alias(c) for c in ("lo", "hi")]), "dedup-pivots")
    met = bands.join(ends, "key").select("line", F.explode(F.array("lo", "hi")).alias("a")).filter("line <> a")
    pairs = met.select(F.least("line", "a").alias("a"), F.greatest("line", "a").alias("b")).distinct()
    bodies = units.filter("key is null and line is not null").groupBy("line").agg(F.max("body").alias("body"))
    bodies = stored(bodies, "dedup-lines")
    left, right = (bodies.select(F.col("line").alias(c), F.col("body").alias(f"body_{c}")) for c in ("a", "b"))
    full = pairs.join(left, "a").join(right, "b").select("a", "b", "body_a", "body_b")

    def check(batches):
        for batch in batches:
            texts = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            take = pa.array([i for i, (x, y) in enumerate(texts) if is_link(shingle_set(x), shingle_set(y))], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take)], names=["a", "b"])

    def rooted(links):
        found = components(links).withColumnRenamed("node", "line")
        roots = bodies.select("line").join(found, "line", "left").select("line", F.coalesce("root", "line").alias("root"))
        return stored(roots, "dedup-roots")

    links = stored(full.mapInArrow(tidy(check), "a long, b long"), "dedup-links")
    roots = rooted(links)
    more = stored(_tiled(bands, ends, roots, bodies), "dedup-tiles")
    return roots if more.isEmpty() else rooted(links.unionByName(more))


def _runs(spans: DataFrame, owner: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """``spans`` with the number of the run of touching spans that each is in, by owner; an owner's
    rows are one document's own paragraphs."""
    by = Window.partitionBy(*owner).orderBy(start, end)
    reach = F.max(end).over(by.rowsBetween(Window.unboundedPreceding, -1))
    return spans.withColumn("new", F.when(F.col(start) <= reach, 0).otherwise(1)).withColumn("run", F.sum("new").over(by)).drop("new")


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """Passages to remove, one row each: key, text_hash, start and end (characters of the text),
    n_words, kept (the key of a document that keeps the passage).

    A passage is a run of repeated lines, blocks and stretches of LEAST_WORDS words or more that
    all have their first occurrence (by key, null first, then text hash) in one other document,
    which keeps them, and that cover at least ``least_words`` words. A lone short line that recurs
    in many documents is no passage: with ``least_words=LINE_WORDS`` every verified repeat of a
    line is a row, as a list of repeated lines. Passages that different documents keep are rows of their own and can
    overlap; one that lies inside another is left out. Repeats inside one document alone are
    no removals; rows equal in key and text are one document. Null, empty and short texts have no
    passages. Extra columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    t = F.col(f"`{text}`")
    src = docs.select(F.col(f"`{key}`").alias("k"), t.alias("t")).withColumn("d", F.xxhash64("k", "t"))
    held = spark.sparkContext.broadcast(_shared_filter(_keys(src)))
    units = stored(_units(src, held), "dedup-units")
    place = F.struct("k", "d")
    # equal runs of pieces, and similar lines, as classes with their first document
    pieces = units.filter("key is null and line is null").withColumn("class", F.col("body"))
    lines = units.filter("key is null and line is not null").join(_similar_lines(units), "line").withColumn("class", F.col("root"))
    spans = []
    for part in (pieces, lines):
        first = part.groupBy("class").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first.d <> last.d").drop("last")
        first = stored(first, "dedup-first")  # a plain side of the join, so Spark can split a class that many rows share
        own = part.join(first, "class").filter(F.col("d") != F.col("first.d"))
        spans.append(own.select("k", "d", "start", "end", "char_start", "char_end", F.col("first").alias("keeper")))
    spans = spans[0].unionByName(spans[1]).distinct()
    # runs of touching spans of one keeper in each document
    runs = _runs(spans, ["k", "d", "keeper"]).groupBy("k", "d", "keeper", "run")
    runs = runs.agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("char_start").alias("char_start"), F.max("char_end").alias("char_end"))
    runs = runs.filter(F.col("end") - F.col("start") >= least_words)
    before = Window.partitionBy("k", "d").orderBy("start", F.desc("end"), "keeper").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("end").over(before), F.lit(-1))
    runs = runs.withColumn("reach", reach).filter("end > reach")
    return runs.select(
        F.col("k").alias(key),
        F.col("d").alias("text_hash"),
        F.col("char_start").alias("start"),
        F.col("char_end").alias("end"),
        (F.col("end") - F.col("start")).alias("n_words"),
        F.col("keeper.k").alias("kept"),
    )


def remove_passages(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All documents, each text without its repeated passages; columns unchanged otherwise.

    Null texts and keys stay as they are, repeated rows are cut alike, an empty table stays empty.
    """
    found = _runs(repeated_passages(docs, key, text), ["text_hash"]).groupBy("text_hash", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    cuts = found.groupBy(F.col("text_hash").alias("_cut_of")).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_cuts"))  # one document's
    t = F.col(f"`{text}`")
    own, restore = carried(docs, key, text)
    src = own.withColumn("_cut_hash", F.xxhash64(F.col(f"`{key}`"), t))
    out = src.join(cuts, F.col("_cut_hash") == F.col("_cut_of"), "left")
    begin = F.concat(F.array(F.lit(0).cast("long")), F.transform("_cuts", lambda c: c["end"]))
    stop = F.concat(F.transform("_cuts", lambda c: c["start"]), F.array(F.length(t).cast("long")))
    kept = F.transform(
        F.arrays_zip(begin.alias("a"), stop.alias("b")), lambda p: F.substr(t, (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int"))
    )
    return restore(out.withColumn(text, F.when(F.col("_cuts").isNull(), t).otherwise(F.concat_ws("", kept))))
