"""Token ids in binary files of patched frame-of-reference blocks.

Documents are dealt out by range of their id, so each task holds a consecutive run of documents
and writes one file of bounded size; files in order, and documents in a file in order, give the
ascending sequence of ids. A block subtracts its minimum, packs the rest at the bit width that a
percentile of its values needs, and keeps wider values in an exception list.

File, little-endian (Spark's text writer ends every part with one ``\\n`` byte, which offsets count):

    part 0   magic ``PFORTOK1``, u32 file number, u32 ids per block
    parts    blocks: u32 minimum, u8 width, u8 0, u16 ids, u16 exceptions, packed bits,
             u16 exception positions, u32 exception values
    last     index: u64 block offsets; u8 null marks, i64 keys and u64 id counts of the
             documents; then u64 index offset, u64 blocks, u64 documents, u64 ids, magic
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelgraph.llm.common import stored, tidy
from labelgraph.llm.shingles import span_hashes
from labelgraph.session import scratch_path

MAGIC = b"PFORTOK1"
BLOCK = 2048
PERCENTILES = (50, 75, 90, 95, 99, 100)
#: Text bytes for one file; its ids, decoded, take a few times as much in a task.
FILE_BYTES = 24 << 20
#: Bytes of blocks gathered before they leave the Python worker.
PART_BYTES = 1 << 20
#: Characters of texts whose words are looked up together.
CHARS_AT_ONCE = 1 << 19
#: Entries and ids of a worker's cache of encoded words (some 30 bytes a word); it starts anew when full.
CACHE_WORDS, CACHE_IDS = 800_000, 4_000_000
#: Entries of the cache's recent part, which is sorted anew whenever words are added.
RECENT_WORDS = 40_000
_HEAD, _BLOCK, _FOOT = struct.Struct("<8sII"), struct.Struct("<IBBHH"), struct.Struct("<QQQQ8s")


# ---- blocks ------------------------------------------------------------------------------
def encode_block(ids: np.ndarray) -> bytes:
    """One block of up to 65,535 unsigned 32-bit ids."""
    base = int(ids.min())
    rest = (ids - np.uint32(base)).astype(np.uint32)
    ordered = np.sort(rest.astype(np.uint16), kind="stable") if rest.max() < 1 << 16 else np.sort(rest)
    best = None
    for p in PERCENTILES:
        width = int(ordered[min(len(ordered) - 1, len(ordered) * p // 100)]).bit_length()
        wide = len(ordered) - int(np.searchsorted(ordered, (1 << width) - 1, side="right"))
        size = (len(rest) * width + 7) // 8 + 6 * wide
        if best is None or size < best[0]:
            best = (size, width, wide)
    _, width, wide = best
    at = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.zeros(0, dtype=np.int64)
    if width == 16:  # two bytes for each id are the same bits
        packed = rest.astype("<u2").tobytes()
    else:
        bits = np.unpackbits(rest.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
        packed = np.packbits(bits.reshape(-1), bitorder="little").tobytes()
    return b"".join(
        [_BLOCK.pack(base, width, 0, len(rest), wide), packed, at.astype("<u2").tobytes(), rest[at].astype("<u4").tobytes()]
    )


def decode_block(data: memoryview, at: int) -> np.ndarray:
    base, width, _, n, wide = _BLOCK.unpack_from(data, at)
    at += _BLOCK.size
    size = (n * width + 7) // 8
    if width == 16:
        rest = np.frombuffer(data, "<u2", n, at).astype(np.uint32)
    else:
        bits = np.zeros((n, 32), dtype=np.uint8)
        if width:
            raw = np.unpackbits(np.frombuffer(data, np.uint8, size, at), bitorder="little")
            bits[:, :width] = raw[: n * width].reshape(n, width)
        rest = np.packbits(bits, axis=1, bitorder="little").view("<u4").reshape(-1).copy()
    at += size
    rest[np.frombuffer(data, "<u2", wide, at)] = np.frombuffer(data, "<u4", wide, at + 2 * wide)
    return rest + np.uint32(base)


class FileParts:
    """The parts of one file, in order; the writer puts one ``\\n`` byte behind each."""

    def __init__(self, number: int):
        self.at, self.starts, self.keys, self.counts = 0, [], [], []
        self.buffer, self.held, self.blocks, self.block_bytes, self.total = [], 0, [], 0, 0
        self.head = _HEAD.pack(MAGIC, number, BLOCK)

    def _part(self, data: bytes) -> bytes:
        self.at += len(data) + 1
        return data

    def add(self, key: int | None, ids: np.ndarray) -> Iterator[bytes]:
        if self.at == 0:
            yield self._part(self.head)
        self.keys.append(key)
        self.counts.append(len(ids))
        self.total += len(ids)
        self.buffer.append(ids)
        self.held += len(ids)
        if self.held >= 16 * BLOCK:
            yield from self._cut(False)

    def _cut(self, everything: bool) -> Iterator[bytes]:
        ids = np.concatenate(self.buffer) if self.buffer else np.zeros(0, np.uint32)
        whole = len(ids) if everything else len(ids) // BLOCK * BLOCK
        for i in range(0, whole, BLOCK):
            self.starts.append(self.at + self.block_bytes)
            self.blocks.append(encode_block(ids[i : min(i + BLOCK, whole)]))
            self.block_bytes += len(self.blocks[-1])
            if self.block_bytes >= PART_BYTES:
                yield self._flush()
        self.buffer, self.held = [ids[whole:]], len(ids) - whole

    def _flush(self) -> bytes:
        data = b"".join(self.blocks)
        self.blocks, self.block_bytes = [], 0
        return self._part(data)

    def close(self) -> Iterator[bytes]:
        if self.at == 0:
            return
        yield from self._cut(True)
        if self.blocks:
            yield self._flush()
        index = self.at
        null = np.array([k is None for k in self.keys], dtype=np.uint8)
        keys = np.array([k or 0 for k in self.keys], dtype="<i8")
        yield b"".join(
            [
                np.array(self.starts, dtype="<u8").tobytes(),
                null.tobytes(),
                keys.tobytes(),
                np.array(self.counts, dtype="<u8").tobytes(),
                _FOOT.pack(index, len(self.starts), len(self.keys), self.total, MAGIC),
            ]
        )


def read_file(data: bytes) -> tuple[int, list[int | None], np.ndarray, Iterator[np.ndarray]]:
    """File number, document keys, where each document's ids start (one more at the end), and the
    ids block by block."""
    view = memoryview(data)
    magic, number, _ = _HEAD.unpack_from(view, 0)
    foot = len(data) - 1 - _FOOT.size
    index, n_blocks, n_docs, total, end = _FOOT.unpack_from(view, foot)
    if magic != MAGIC or end != MAGIC:
        raise ValueError("not a token block file")
    starts = np.frombuffer(view, "<u8", n_blocks, index)
    at = index + 8 * n_blocks
    null = np.frombuffer(view, np.uint8, n_docs, at)
    keys = np.frombuffer(view, "<i8", n_docs, at + n_docs)
    counts = np.frombuffer(view, "<u8", n_docs, at + 9 * n_docs)
    edges = np.concatenate([[0], np.cumsum(counts.astype(np.int64))])
    if edges[-1] != total:
        raise ValueError("a token block file's counts differ")
    return number, [None if x else int(k) for k, x in zip(keys, null)], edges, (decode_block(view, int(s)) for s in starts)


def checksums(edges: np.ndarray, blocks: Iterator[np.ndarray]) -> list[int]:
    """CRC-32 of each document's ids as little-endian unsigned 32-bit integers; one block is held."""
    out, doc, at = [0] * (len(edges) - 1), 0, 0
    for ids in blocks:
        raw = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
        end = at + len(ids)
        while at < end:
            while edges[doc + 1] <= at:
                doc += 1
            stop = min(end, int(edges[doc + 1]))
            out[doc] = zlib.crc32(raw[4 * (at - end + len(ids)) : 4 * (stop - end + len(ids))], out[doc])
            at = stop
    if at != edges[-1]:
        raise ValueError("a token block file lacks ids")
    return out


# ---- encoding ----------------------------------------------------------------------------
# Texts of ASCII and Latin-1 letters are cut into the tokenizer's words here: after lower-casing,
# runs of letters, single digits, and runs of anything else but white space (which U+001C to U+001F
# are not to it). Special tokens and its contractions need the tokenizer's own pattern. Case is
# ignored in the contractions alone: a class that ignores it lets U+0130 and others through.
_OTHER = re.compile("[^\x00-\x7fÀ-ÖØ-öø-ÿ]|<[|]|(?i:'(?:s|t|re|ve|m|ll|d))")
_CHUNKS = re.compile(rb"[^\x09-\x0d ]+")
_LETTER, _DIGIT, _REST, _SPACE = 1, 2, 3, 0
_CLASS = np.full(256, _REST, dtype=np.uint8)
_CLASS[97:123] = _CLASS[128:] = _LETTER
_CLASS[48:58] = _DIGIT
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE


class WordCache:
    """Ids of words by the words' 64-bit hashes: sorted hashes with the place of the ids in one array."""

    def __init__(self):
        self.flat, self.used = np.zeros(1 << 16, dtype=np.uint32), 0
        none = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.parts = [none, none]  # settled, recent: hashes, starts, sizes

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of each hash's ids; size -1 when it isn't there."""
        start, size = np.zeros(len(h), np.int64), np.full(len(h), -1, np.int64)
        for hashes, starts, sizes in self.parts:
            if len(hashes):
                at = np.searchsorted(hashes, h)
                at[at == len(hashes)] = 0
                hit = hashes[at] == h
                start[hit], size[hit] = starts[at[hit]], sizes[at[hit]]
        return start, size

    def add(self, h: np.ndarray, ids: list[bytes]) -> None:
        new = np.frombuffer(b"".join(ids), "<u4")
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        if self.used + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(self.used + 2 * len(new), np.uint32)])
        self.flat[self.used : self.used + len(new)] = new
        start = np.cumsum(size) - size + self.used
        self.used += len(new)
        settled, recent = self.parts
        if len(recent[0]) > RECENT_WORDS:
            to = np.searchsorted(settled[0], recent[0])
            settled = tuple(np.insert(x, to, y) for x, y in zip(settled, recent))
            recent = tuple(x[:0] for x in recent)
        recent = [np.concatenate([x, y]) for x, y in zip(recent, (h, start, size))]
        order = np.argsort(recent[0])
        self.parts = [settled, tuple(x[order] for x in recent)]

    def full(self) -> bool:
        return sum(len(p[0]) for p in self.parts) > CACHE_WORDS or self.used > CACHE_IDS


class WordEncoder:
    """Encodes texts with a lower-casing tokenizer whose words never reach across white space.

    Such a tokenizer (white space dropped before the merges, a mark at each word's end) gives a
    text the ids of its words one after the other, so every word is encoded once and cached. The
    words of many texts are found together: one 64-bit hash each, and only distinct ones are looked
    up. Texts with other characters than ASCII and Latin-1 letters are cut at ASCII white space,
    and the tokenizer sees each such chunk whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.tok.no_padding()
        self.tok.no_truncation()
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        for token, i in vocab.items():
            self.ends[i] = token.endswith("</w>")
        # the same tokenizer, with the same model in memory, for words that are already normalised and cut
        self.plain = Tokenizer(self.tok.model)
        added = self.tok.get_added_tokens_decoder()
        self.plain.add_special_tokens([t for _, t in sorted(added.items()) if t.special])
        self.plain.add_tokens([t for _, t in sorted(added.items()) if not t.special])
        cut = [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(cut)
        self.forget()
        probe = "It is a TEST, caf\u00e9 (42)!"
        # another kind of tokenizer: every text is encoded whole
        self.by_words = self._whole([probe])[0] == self._many([probe])[0]

    def forget(self) -> None:
        """Drop the words; the tokenizer stays."""
        self.cache = WordCache()
        self.chunks: dict[bytes, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of cut words: all in one call, told apart by the marks at their ends."""
        ids = np.array(self.plain.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
        if len(ends) != len(words):
            return self._whole(words)
        raw = ids.tobytes()
        return [raw[i:j] for i, j in zip([0, *ends], ends)]

    def _chunk_ids(self, text: str) -> bytes:
        own = _CHUNKS.findall(text.encode("utf-8", "surrogatepass"))
        if len(self.chunks) > RECENT_WORDS:
            self.chunks.clear()
        new = list({c for c in own if c not in self.chunks})
        self.chunks.update(zip(new, self._whole([c.decode("utf-8", "surrogatepass") for c in new])))
        return b"".join(map(self.chunks.__getitem__, own))

    def _many(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that are cut by classes of bytes, all texts at once."""
        raw = [t.lower().encode() for t in texts]
        edges = np.cumsum([0] + [len(r) + 1 for r in raw])
        text = b" ".join(raw)
        b = np.frombuffer(text, dtype=np.uint8)
        kind = np.concatenate([[_SPACE], _CLASS[b], [_SPACE]])
        cut = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        at = np.flatnonzero(cut)
        word = kind[1:][at] != _SPACE
        starts, ends = at[word], np.append(at[1:], len(b))[word]
        if not len(starts):
            return [b""] * len(texts)
        h, first, which = np.unique(span_hashes(b, starts, ends), return_index=True, return_inverse=True)
        start, size = self.cache.find(h)
        new = np.flatnonzero(size < 0)
        if len(new):
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist())
            self.cache.add(h[new], self._words([text[i:j].decode() for i, j in spans]))
            start[new], size[new] = self.cache.find(h[new])
        own = size[which]
        before = np.concatenate([[0], np.cumsum(own)])
        take = np.repeat(start[which] - before[:-1], own) + np.arange(before[-1])
        out = self.cache.flat[take].astype("<u4").tobytes()
        bound = (before[np.searchsorted(starts, edges)] * 4).tolist()
        return [out[i:j] for i, j in zip(bound, bound[1:])]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; none for null."""
        if not self.by_words:
            return self._whole([t or "" for t in texts])
        if self.cache.full():
            self.cache = WordCache()
        out: list[bytes] = [b""] * len(texts)
        plain = []
        for i, t in enumerate(texts):
            if t and _OTHER.search(t):
                out[i] = self._chunk_ids(t)
            elif t:
                plain.append(i)
        for i, ids in zip(plain, self._many([texts[i] for i in plain])):
            out[i] = ids
        return out


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """This worker's encoder for a tokenizer file; loaded once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


# ---- Spark -------------------------------------------------------------------------------
def _groups(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about CHARS_AT_ONCE of text."""
    sizes = np.asarray(pc.fill_null(pc.utf8_length(batch.column(1)), 0))
    turn = np.flatnonzero(np.diff(np.cumsum(sizes) // CHARS_AT_ONCE)) + 1
    edges = [0, *turn.tolist(), batch.num_rows]
    for i, j in zip(edges, edges[1:]):
        if i < j:
            yield batch.slice(i, j - i)


def write_tokens(
    docs: DataFrame, path: str, encoder: Callable[[], Callable[[list[str | None]], list[bytes]]], end_id: int, key: str = "doc_id"
) -> None:
    """Encode ``text``, append ``end_id`` and write the files of ``path`` in ascending ``key`` order.

    Null keys come first; rows with equal keys follow in input order. A null or empty text has
    the end id alone. Extra columns are not written; an empty table writes no file with content.
    The number of files follows the text's bytes, and a row number ends the range key, so neither
    size nor repeated keys overfill a task.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col("text"), F.monotonically_increasing_id().alias("tie"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // FILE_BYTES))
    ranged = rows.repartitionByRange(n, "key", "tie").sortWithinPartitions("key", "tie").select("key", "text")

    def encode(batches):
        parts, enc = FileParts(TaskContext.get().partitionId()), encoder()
        last = struct.pack("<I", end_id)
        for batch in batches:
            for some in _groups(batch):
                for k, raw in zip(some.column(0).to_pylist(), enc(some.column(1).to_pylist())):
                    for part in parts.add(k, np.frombuffer(raw + last, "<u4")):
                        yield pa.RecordBatch.from_arrays([pa.array([part], pa.binary())], names=["part"])
        for part in parts.close():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.binary())], names=["part"])
        # workers live on, idle ones beside those at work, and each would hold words of its own
        getattr(enc, "forget", lambda: None)()

    ranged.mapInArrow(tidy(encode), "part binary").select(F.col("part").cast("string").alias("value")).write.text(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document of the files: doc_id, file, at (ids before it in its file), n_tokens, ids_crc32
    and, when asked for, ids. One task reads whole files, whose size the writer bounds."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).filter("length > 0").select("content")
    schema = "doc_id long, file long, at long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def decode(batches):
        for batch in batches:
            for content in batch.column(0):
                number, keys, edges, blocks = read_file(content.as_py())
                if with_ids:
                    held = list(blocks)
                    blocks, ids = iter(held), np.concatenate(held)
                crc = checksums(edges, blocks)
                cols = [
                    pa.array(keys, pa.int64()),
                    pa.array(np.full(len(keys), number, np.int64)),
                    pa.array(edges[:-1]),
                    pa.array(np.diff(edges)),
                    pa.array(crc, pa.int64()),
                ]
                names = ["doc_id", "file", "at", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids.astype(np.int64))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return files.mapInArrow(tidy(decode), schema)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    read = stored(read_tokens(spark, path), "token-index")
    totals = read.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = Window.partitionBy(F.lit(0)).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"))  # one row per file
    out = read.join(F.broadcast(offs), "file")
    return out.select("doc_id", (F.col("off") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int, path: str | None = None, key: str = "doc_id") -> DataFrame:
    """Write all documents' ids with a tokenizer file and return the index read back from the files."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write_tokens(docs, path, lambda: word_encoder(tokenizer_path), end_id, key)
    return token_index(spark, path)
