"""Benchmark decontamination: broadcast set of benchmark n-grams against all training windows.

The windows of the benchmark become a hash set of bounded size that every task holds; a task
scans the token windows of its documents against it, verifies each hit on the words themselves,
and reports hit words, items and spans. Documents or spans are then removed.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelgraph.llm.common import carried, only, stored, tidy

WINDOW = 13
#: Text bytes of the benchmark that one broadcast set may hold; more is scanned in blocks of it.
BLOCK_BYTES = 32 << 20

# A word is a run of digits, lower-case letters and non-ASCII characters; every other ASCII byte
# separates. In UTF-8 all bytes of a non-ASCII character are above 0x7F, so bytes can be mapped.
_WORD_BYTES = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_MAP = bytes(b + 32 if 65 <= b <= 90 else (b if b in _WORD_BYTES else 32) for b in range(256))
_WORD_CHARS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_PRIME = 0x9E3779B97F4A7C15

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
        T.StructField(
            "hit_spans",
            T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])),
        ),
    ]
)


def words_bytes(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_MAP).split() if text else []


class WindowSet:
    """Distinct benchmark windows by length: sorted hashes, the windows' word ids, their items."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.vocab: dict[bytes, int] = {}
        self.items: list[str | None] = []
        found: dict[int, dict[tuple[int, ...], set[int]]] = {}
        for item, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words_bytes(text)]
            if not ids:
                continue
            n, at = min(window, len(ids)), len(self.items)
            self.items.append(item)
            own = found.setdefault(n, {})
            for i in range(len(ids) - n + 1):
                own.setdefault(tuple(ids[i : i + n]), set()).add(at)
        self.by_len = []
        for n, own in sorted(found.items()):
            grams = np.array(list(own), dtype=np.int64).reshape(len(own), n)
            mult = np.uint64(_PRIME)
            while True:
                powers = np.array([pow(int(mult), k + 1, 1 << 64) for k in range(n)], dtype=np.uint64)
                h = ((grams + 1).astype(np.uint64) * powers).sum(axis=1, dtype=np.uint64)
                if len(np.unique(h)) == len(h):
                    break
                mult += np.uint64(2)
            order = np.argsort(h)
            lists = list(own.values())
            self.by_len.append((n, powers, h[order], grams[order], [sorted(lists[i]) for i in order]))

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """Mark of hit words; indexes of the items whose windows occur."""
        mark, hit_items = np.zeros(len(words), dtype=bool), set()
        get = self.vocab.get
        ids = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
        unknown = np.concatenate([[0], np.cumsum(ids < 0)])
        for n, powers, hashes, grams, owners in self.by_len:
            if len(ids) < n:
                continue
            starts = np.flatnonzero(unknown[n:] == unknown[:-n])
            if not len(starts):
                continue
            h = np.zeros(len(starts), dtype=np.uint64)
            for k in range(n):
                h += (ids[starts + k] + 1).astype(np.uint64) * powers[k]
            at = np.searchsorted(hashes, h)
            at[at == len(hashes)] = 0
            same = hashes[at] == h
            for s, g in zip(starts[same].tolist(), at[same].tolist()):
                if np.array_equal(ids[s : s + n], grams[g]):
                    mark[s : s + n] = True
                    hit_items.update(owners[g])
        return mark, hit_items


def _spans(text: str, mark: np.ndarray) -> list[dict]:
    """Character spans of the runs of hit words."""
    at = [m.span() for m in _WORD_CHARS.finditer(text)]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mark.view(np.int8), [0]])))
    return [{"start": at[a][0], "end": at[b - 1][1]} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]


def _blocks(spark: SparkSession, bench: DataFrame) -> list[DataFrame]:
    """The benchmark as one block, or split by item hash into blocks of at most about BLOCK_BYTES."""
    total = bench.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = -(-total // BLOCK_BYTES) if total > BLOCK_BYTES else 1
    if n == 1:
        return [bench]
    n = 2 * n  # hash blocks differ in size
    return [bench.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b) for b in range(n)]


def annotate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """``docs`` with a struct column ``contamination``: n_words, n_hit, item_ids (sorted), hit_spans.

    A window is ``window`` consecutive words of an item, or the whole item when it has fewer; a
    document word inside any occurrence of a window is hit. Null and empty texts have no words
    and no hits; an item without words has no window; an item whose id is null marks words but is
    not listed; repeated items count once. Rows are handled one by one, so repeated documents,
    ties and null ids need nothing special, and extra columns pass through unchanged (one that is
    called ``contamination`` is replaced).

    The set is broadcast: its source is at most BLOCK_BYTES of benchmark text. A larger benchmark
    is scanned block by block, each pass adding its hits to the stored result of the one before.
    """
    spark = docs.sparkSession
    bench = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("item_id"), F.col(f"`{item_text}`").alias("text"))
    blocks = _blocks(spark, bench)
    out = docs.drop("contamination").withColumn("contamination", F.lit(None).cast(RESULT))
    for k, block in enumerate(blocks):
        items = [(r["item_id"], r["text"]) for r in block.collect()]  # at most about BLOCK_BYTES
        held = spark.sparkContext.broadcast(WindowSet(items, window))
        out = _scan_pass(out, held, text)
        if len(blocks) > 1:
            out = stored(out, f"decontaminate-{k}")
            held.unpersist()
    return out


def _scan_pass(docs: DataFrame, held, text: str) -> DataFrame:
    schema = docs.schema
    at = docs.columns.index(text)

    def scan(batches):
        windows: WindowSet = held.value
        kind = None
        for batch in batches:
            texts = batch.column(at)
            before = batch.column(batch.num_columns - 1).to_pylist()
            rows = []
            for value, old in zip(texts, before):
                t = value.as_py()
                words = words_bytes(t)
                mark, hits = windows.scan(words)
                ids = {windows.items[i] for i in hits} - {None}
                if old is not None:
                    ids |= set(old["item_ids"])
                    if old["hit_spans"]:
                        mark |= _mark_of(t, old["hit_spans"])
                n_hit = int(mark.sum())
                spans = _spans(t, mark) if n_hit else []
                rows.append({"n_words": len(words), "n_hit": n_hit, "item_ids": sorted(ids), "hit_spans": spans})
            kind = kind or batch.schema.field(batch.num_columns - 1).type
            done = pa.array(rows, type=kind)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], done], schema=batch.schema)

    return docs.mapInArrow(tidy(scan), schema)


def _mark_of(text: str, spans: list[dict]) -> np.ndarray:
    starts = np.array([m.start() for m in _WORD_CHARS.finditer(text)])
    mark = np.zeros(len(starts), dtype=bool)
    for s in spans:
        mark |= (starts >= s["start"]) & (starts < s["end"])
    return mark


def verdicts(annotated: DataFrame) -> DataFrame:
    """Flatten ``contamination`` and add ``contaminated``: hit words are 5 % of the words or more."""
    c = "contamination"
    return annotated.withColumns(
        {
            "n_words": F.col(f"{c}.n_words"),
            "n_hit": F.col(f"{c}.n_hit"),
            "n_items": F.size(f"{c}.item_ids").cast("long"),
            "items_sha256": F.sha2(F.concat_ws(",", f"{c}.item_ids"), 256),
            "contaminated": (F.col(f"{c}.n_hit") > 0) & (20 * F.col(f"{c}.n_hit") >= F.col(f"{c}.n_words")),
        }
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """The documents that are not contaminated, with their own columns only, whatever their names."""
    own, restore = carried(docs, kw.get("text", "text"))
    judged = annotate(own, benchmark, **kw)
    c = F.col("contamination")
    bad = (c["n_hit"] > 0) & (20 * c["n_hit"] >= c["n_words"])
    return restore(judged.filter(~bad))


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **kw) -> DataFrame:
    """All documents, each text without its hit spans; what stands between two spans is kept."""
    own, restore = carried(docs, text)
    judged = annotate(own, benchmark, text=text, **kw)
    t, spans = F.col(f"`{text}`"), F.col("contamination.hit_spans")
    ends = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    starts = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(t)))
    pieces = F.transform(F.arrays_zip(ends.alias("a"), starts.alias("b")), lambda p: F.substr(t, p["a"] + 1, p["b"] - p["a"]))
    cut = F.when(F.size(spans) > 0, F.concat_ws("", pieces)).otherwise(t)
    return restore(judged.withColumn(text, cut))


def items_digest(ids: list[str]) -> str:
    """The digest that ``verdicts`` gives for these item ids (for callers outside Spark)."""
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


def judge(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document: key, n_words, n_hit, n_items, items_sha256, contaminated."""
    judged = verdicts(annotate(only(docs, key, "text"), benchmark))
    return judged.select(key, "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
