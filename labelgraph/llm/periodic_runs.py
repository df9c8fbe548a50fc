"""Periodic run detection by recursive frequency splitting and a lag scan of what survives.

A run is a stretch of consecutive words with smallest period q and at least ``max(12, 2 * q)``
words that no neighbouring word extends. Every word of a run has an equal word q places away inside
the run, and q is at most half the run. So a word that occurs once in a segment, or whose nearest
equal word lies more than half the segment away, is in no run of that segment: it splits the segment
in two. Where no word is that rare, windows of six words are counted in the same way. The parts are
shorter, their words are rarer still, and splitting recurs until nothing changes or a part is too
short for any run. Ordinary prose falls apart in a few rounds, for all documents of a batch at once;
only the few segments left are scanned lag by lag.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgraph.llm.common import tidy
from labelgraph.llm.shingles import mix64

#: Least words of a run, and least repeats of its period.
MIN_WORDS, MIN_REPEATS = 12, 2
#: Words that are split together; a longer text is a group by itself.
GROUP_WORDS = 500_000


def _repeats(at: np.ndarray, seg: np.ndarray, room: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which positions have an equal key in their segment, at most half the segment away."""
    order = np.lexsort((at, keys[at], seg))
    s, k, p = seg[order], keys[at[order]], at[order]
    same = (s[1:] == s[:-1]) & (k[1:] == k[:-1])
    far = np.iinfo(np.int64).max // MIN_REPEATS
    gap = np.where(same, p[1:] - p[:-1], far)
    near = np.minimum(np.concatenate([[far], gap]), np.concatenate([gap, [far]]))
    out = np.empty(len(at), dtype=bool)
    out[order] = near * MIN_REPEATS <= room[order]
    return out


def _edges(at: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and size of each segment; ``seg`` is ascending."""
    edge = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]])) if len(seg) else np.zeros(0, dtype=np.int64)
    return edge, np.diff(np.append(edge, len(seg)))


def surviving_segments(words: np.ndarray, texts: np.ndarray) -> list[tuple[int, int]]:
    """Spans (start, end) of ``words`` that may hold runs; ``texts`` (ascending) keeps texts apart.

    Rounds by single words alternate with rounds by windows of six words (a run repeats at least
    that many words in a row, so each of its words lies in a window that repeats); the latter take
    the segments in which no single word is rare. A segment that neither splits is stable.
    """
    done: list[tuple[int, int]] = []
    n, width = len(words), MIN_WORDS // MIN_REPEATS
    windows = mix64(words.astype(np.uint64) + np.uint64(1))
    for k in range(1, width):
        windows = mix64(windows * np.uint64(0x9E3779B97F4A7C15) + np.append(words[k:], np.zeros(min(k, n), words.dtype)).astype(np.uint64))
    at = np.arange(n, dtype=np.int64)  # positions in segments still to be split
    seg = texts.astype(np.int64)  # their segments: ascending with the position
    by_window = np.zeros(n, dtype=bool)  # whether the segment is to be split by windows
    while len(at):
        edge, size = _edges(at, seg)
        long = np.repeat(size >= MIN_WORDS, size)  # shorter segments hold no run
        room = np.repeat(size, size)[long]
        at, seg, by_window = at[long], seg[long], by_window[long]
        if not len(at):
            break
        edge, size = _edges(at, seg)
        keep = np.zeros(len(at), dtype=bool)
        one = ~by_window
        keep[one] = _repeats(at[one], seg[one], room[one], words)
        starts = by_window & (at + width <= np.repeat(at[edge] + size, size))
        again = np.flatnonzero(starts)[_repeats(at[starts], seg[starts], room[starts], windows)]
        for k in range(width):  # a window and all its words; it ends in its own segment
            keep[again + k] = True
        # segments kept whole: by words, they go to the windows; by windows, they are stable
        whole = np.logical_and.reduceat(keep, edge)
        ready = whole & by_window[edge]
        done.extend(zip(at[edge[ready]].tolist(), (at[edge[ready]] + size[ready]).tolist()))
        by_window = np.repeat(whole, size)
        keep &= ~np.repeat(ready, size)
        at, seg, by_window = at[keep], seg[keep], by_window[keep]
        if len(at):
            seg = np.cumsum(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (seg[1:] != seg[:-1])]))
    done.sort()
    return done


def _window_hashes(w: np.ndarray, most: int) -> list[np.ndarray]:
    """Hashes of all windows of 1, 2, 4 ... words, the widest at most ``most`` words."""
    out = [mix64(w.astype(np.uint64) + np.uint64(1))]
    size = 1
    while 2 * size <= most and len(out[-1]) > size:
        low = out[-1]
        out.append(mix64(low[: len(low) - size] * np.uint64(0x9E3779B97F4A7C15) + low[size:]))
        size *= 2
    return out


def _matching(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common prefix of two arrays, by growing steps."""
    n, done, step = min(len(a), len(b)), 0, 16
    while done < n:
        end = min(done + step, n)
        differ = np.flatnonzero(a[done:end] != b[done:end])
        if len(differ):
            return done + int(differ[0])
        done, step = end, step * 4
    return n


def lag_scan(w: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of one segment, by start, then period.

    For lag q a run is a stretch of at least ``max(12 - q, q)`` places where the word equals the one
    q places on. A stretch of that length covers a whole aligned block of about half of it, so only
    the blocks' hashes are compared, m / q of them for lag q; a block that agrees is extended word
    by word to the stretch's exact ends. Stretches inside a run whose period divides q are that run
    again, as are stretches with the span of a run found at a smaller lag.
    """
    m = len(w)
    runs: dict[tuple[int, int], int] = {}
    by_period: dict[int, list[tuple[int, int]]] = {}
    top = m // MIN_REPEATS
    hashes = _window_hashes(w, max(1, (max(MIN_WORDS, top) + 1) // 2))
    for q in range(1, top + 1):
        least = max(MIN_WORDS - q, q)
        k = min(((least + 1) // 2).bit_length() - 1, len(hashes) - 1)  # 2 * 2^k - 1 <= least
        h, block = hashes[k], 1 << k
        first = h[: len(h) - q : block]
        if not len(first):
            continue
        hit = np.flatnonzero(first == h[q::block][: len(first)]) * block
        if not len(hit):
            continue
        behind = -1  # end of the last stretch handled
        i = 0
        while i < len(hit):
            x = int(hit[i])
            if x < behind:
                i = int(np.searchsorted(hit, behind))
                continue
            again = _inside(by_period, q, x, x + q + block)
            if again is not None:
                behind = again - q - block + 1  # blocks that end inside the known run
                i = max(i + 1, int(np.searchsorted(hit, behind)))
                continue
            end = x + _matching(w[x : m - q], w[x + q :])
            start = x - _matching(w[:x][::-1], w[q : x + q][::-1])
            behind = max(end, x + 1)
            if end - start >= least and (start, end + q) not in runs:
                runs[(start, end + q)] = q
                by_period.setdefault(q, []).append((start, end + q))
            i += 1
    return sorted((s, e - s, q) for (s, e), q in runs.items())


def _inside(by_period: dict[int, list[tuple[int, int]]], q: int, low: int, high: int) -> int | None:
    """End of a known run of at least 2q words, with a period dividing q, that holds [low, high)."""
    for p, spans in by_period.items():
        if p < q and q % p == 0:
            for s, e in spans:
                if s <= low and high <= e and e - s >= 2 * q:
                    return e
    return None


def runs_of(words: np.ndarray, texts: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) in the words of all texts; starts count over all words."""
    out = []
    for s, e in surviving_segments(words, texts):
        out.extend((s + a, n, q) for a, n, q in lag_scan(words[s:e]))
    return sorted(out)


def _dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words lie in a run after that run's first period."""
    gone = np.zeros(n + 1, dtype=np.int64)
    for s, length, q in runs:
        gone[s + q] += 1
        gone[s + length] -= 1
    return np.cumsum(gone[:-1]) > 0


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_words, runs (array of start, length, period), collapsed text.

    Words stand between ASCII white space and are numbered from 0; words are equal when their bytes
    are. ``runs`` holds every run by start, then period; ``collapsed`` is the text's words joined by
    one space without those that lie in a run after that run's first period. Null and text without
    words have no words, no runs and an empty collapsed text. Null keys and repeated rows stay, one
    row each; other columns, whatever their names, are ignored; an empty table gives no rows. No
    shuffle: a task handles whole texts, splitting some half a million words at a time.
    """
    src = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("binary").alias("t"))
    key_type = src.schema["k"].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def solve(keys: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        ids: dict[bytes, int] = {}
        flat = np.array([ids.setdefault(w, len(ids)) for t in texts for w in t], dtype=np.int64)
        own = np.repeat(np.arange(len(texts)), sizes)
        first = np.cumsum(sizes) - sizes
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for s, n, q in runs_of(flat, own):
            found[own[s]].append((int(s - first[own[s]]), n, q))
        collapsed = []
        for t, runs in zip(texts, found):
            if runs:
                gone = _dropped(len(t), runs)
                t = [w for w, g in zip(t, gone.tolist()) if not g]
            collapsed.append(b" ".join(t))
        rows = [[{"start": s, "length": n, "period": q} for s, n, q in runs] for runs in found]
        cols = [keys, pa.array(sizes), pa.array(rows, run_type), pa.array(collapsed, pa.binary())]
        return pa.RecordBatch.from_arrays(cols, names=["k", "n_words", "runs", "collapsed"])

    def scan(batches):
        for batch in batches:
            held, start, words = [], 0, 0
            for i, t in enumerate(batch.column(1)):
                raw = t.as_py()
                own = raw.split() if raw else []  # bytes split at ASCII white space alone
                if held and words + len(own) > GROUP_WORDS:
                    yield solve(batch.column(0).slice(start, len(held)), held)
                    held, start, words = [], i, 0
                held.append(own)
                words += len(own)
            if held:
                yield solve(batch.column(0).slice(start, len(held)), held)

    schema = f"k {key_type}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"
    out = src.mapInArrow(tidy(scan), schema)
    return out.select(F.col("k").alias(key), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def summary(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document of :func:`periodic_runs`: number of runs, the longest one (ties: smallest start,
    then period; nulls when there is none) with its exponent in thousandths, and digests of the runs
    and of the collapsed text."""
    best = F.expr("array_min(transform(runs, r -> struct(-r.length as l, r.start as s, r.period as p)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    out = found.select(F.col(f"`{key}`").alias("k"), F.size("runs").cast("long").alias("n"), best.alias("best"), lines.alias("lines"), "collapsed")
    length, period = -F.col("best.l"), F.col("best.p")
    return out.select(
        F.col("k").alias(key),
        F.col("n").alias("n_runs"),
        F.col("best.s").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
