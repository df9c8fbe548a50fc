"""WARC archives: writing with revisits of equal payloads, reading with verified record boundaries.

Records are written as the rows of Spark's text sink with the record end as line separator, and
read as the rows of its text source with the record's first line as separator, so archives of any
size are split over tasks and no task holds a file. A first line inside a payload looks like a
record; tasks therefore emit candidates (offset, offset of the successor by Content-Length), and
pointer jumping from the start of each file keeps only those that its chain of records reaches.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelgraph.llm.common import stored, tidy, utf8_bytes
from labelgraph.session import scratch_path

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
#: Payloads below this size are never revisits.
REVISIT_BYTES = 100
#: Repeated payloads up to this number are broadcast, more are joined by a shuffle.
BROADCAST_PAYLOADS = 100_000
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ---- writing -----------------------------------------------------------------------------
def records(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """One column ``value``: the WARC record of each row, without the blank lines at its end.

    Of rows with equal payloads of REVISIT_BYTES or more, those with the smallest key are
    responses and the others revisit it, without a payload of their own; a null key is larger than
    any. A null payload is empty. Line ends inside a URL are percent-encoded; a null URL is left
    out. Repeated rows are records of their own, extra columns are not written.
    """
    body = F.coalesce(F.col(f"`{payload}`"), F.lit(""))
    rows = pages.select(
        F.col(f"`{key}`").cast("string").alias("id"),
        F.col(f"`{key}`").alias("k"),
        F.col(f"`{url}`").alias("u"),
        body.alias("body"),
        F.sha2(body.cast("binary"), 256).alias("digest"),
        utf8_bytes(body).alias("size"),
    )
    light = rows.filter(F.col("size") >= REVISIT_BYTES).select("digest", "k")
    repeated = light.groupBy("digest").agg(F.min("k").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 and first is not null")
    repeated = stored(repeated.select("digest", "first"), "warc-repeated")
    if repeated.limit(BROADCAST_PAYLOADS + 1).count() <= BROADCAST_PAYLOADS:
        repeated = F.broadcast(repeated)
    rows = rows.join(repeated, "digest", "left")
    again = F.col("first").isNotNull() & (F.col("k").isNull() | (F.col("k") != F.col("first")))
    uri = F.regexp_replace(F.regexp_replace("u", "\r", "%0D"), "\n", "%0A")
    head = F.concat(
        F.lit(MAGIC + "WARC-Type: "),
        F.when(again, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce("id", F.lit("")),
        F.lit(f">\r\nWARC-Date: {date}"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), uri), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha256:"),
        F.col("digest"),
        F.lit("\r\nX-Payload-Length: "),
        F.col("size"),
        F.when(again, F.concat(F.lit(f"\r\nWARC-Profile: {_PROFILE}\r\nWARC-Refers-To: <urn:page:"), F.col("first"), F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.when(again, F.lit(0)).otherwise(F.col("size")),
        F.lit(END),
    )
    return rows.select(F.concat(head, F.when(again, "").otherwise(F.col("body"))).alias("value"))


def write_archives(pages: DataFrame, path: str, **columns: str) -> None:
    """One archive for each input partition; records in input order."""
    records(pages, **columns).write.option("lineSep", END).text(path)


# ---- reading -----------------------------------------------------------------------------
def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """The bytes behind each MAGIC up to the next, with file and the split that read them; a
    split's rows are in file order, and its first row may start behind the split's start."""
    rows = spark.read.option("lineSep", MAGIC).text(path)
    meta = F.col("_metadata")
    return rows.select(meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), F.col("value").cast("binary").alias("body"))


_HEADS = {b"warc-type": "type", b"warc-record-id": "id", b"warc-refers-to": "refers", b"warc-payload-digest": "digest", b"x-payload-length": "size", b"content-length": "length"}


def _header(body: bytes) -> tuple[int, dict[str, str]] | None:
    """Length of the header with its blank line, and the fields; None when it isn't one."""
    end = body.find(b"\r\n\r\n")
    if end < 0:
        return None
    found = {}
    for line in body[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        if name.lower() in _HEADS:
            found[_HEADS[name.lower()]] = value.strip().decode("utf-8", "replace")
    if "type" not in found or not found.get("length", "").isdigit():
        return None
    return end + 4, found


def _page(urn: str | None) -> str | None:
    """The page of ``<urn:page:...>``, null when it has none."""
    return urn.removeprefix("<urn:page:").removesuffix(">") or None if urn else None


_CANDIDATE = (
    "file string, block long, total long, rel long, succ long, exit long, whole boolean, "
    "type string, page string, refers string, digest string, size long, head long, length long"
)
_SEP = len(MAGIC)


def _candidate(body: bytes, rel: int) -> dict:
    """The record that the MAGIC at ``rel`` would start. ``whole``: it ends with this fragment."""
    found = _header(body)
    if found is None:
        return {"rel": rel}
    head, fields = found
    length = int(fields["length"])
    end = head + length + len(END)
    out = {"rel": rel, "succ": rel + _SEP + end, "head": head, "length": length, "type": fields["type"]}
    out |= {"page": _page(fields.get("id")), "refers": _page(fields.get("refers")), "whole": len(body) == end and body.endswith(END.encode())}
    if fields["type"] == "revisit":
        size = fields.get("size", "")
        out |= {"digest": fields.get("digest", "").removeprefix("sha256:"), "size": int(size) if size.isdigit() else None}
    elif out["whole"]:
        out |= {"digest": hashlib.sha256(body[head : head + length]).hexdigest(), "size": length}
    return out


def _table(rows: list[dict], spec: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    names = [c.split() for c in spec.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds[t]) for n, t in names], names=[n for n, _ in names])


def _candidates(fragments: DataFrame) -> DataFrame:
    """A row for each MAGIC, offsets relative to the first row of its split: its own (rel), its
    successor's (succ), and the first one outside the split that successors lead to (exit; null
    when they lead to no record). ``total``: the bytes of the split's rows with their separators;
    a split without MAGIC has one row with a null ``rel``."""

    def scan(batches):
        at, rows, place = None, [], 0

        def close():
            leads: dict[int, int | None] = {}
            for r in reversed(rows):
                succ = r.get("succ")
                r["exit"] = leads[r["rel"]] = succ if succ is None or succ >= place - _SEP else leads.get(succ)
            every = rows or [{}]
            for r in every:
                r.update(file=at[0], block=at[1], total=place)
            return _table(every, _CANDIDATE)

        for batch in batches:
            for file, block, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                body = value.as_py()
                opens = (file, block) != at
                if opens:
                    if at is not None:
                        yield close()
                    at, rows, place = (file, block), [], 0
                if not (opens and block == 0):  # what stands before a file's first MAGIC is no record
                    rows.append(_candidate(body, place - _SEP))
                place += len(body) + _SEP
        if at is not None:
            yield close()

    return fragments.mapInArrow(tidy(scan), _CANDIDATE)


def _reached(candidates: DataFrame) -> DataFrame:
    """(file, off) of the records at which the chain from a file's start enters a split.

    Pointer jumping: the reached offsets take every step of the jump table at once, then the table
    is joined with itself, so the rounds are the logarithm of a file's splits. Only offsets that
    some exit leads to take part.
    """
    jumps = candidates.filter("exit is not null").select("file", "off", F.col("exit_off").alias("next"))
    targets = jumps.select("file", F.col("next").alias("off")).union(candidates.select("file", F.lit(0).cast("long").alias("off"))).distinct()
    jumps = stored(jumps.join(targets, ["file", "off"], "left_semi"), "warc-jumps")
    reached = stored(candidates.filter("off = 0").select("file", "off").distinct(), "warc-reached")
    n = reached.count()
    while True:
        steps = reached.join(jumps, ["file", "off"]).select("file", F.col("next").alias("off"))
        reached = stored(reached.union(steps).distinct(), "warc-reached")
        now = reached.count()
        if now == n:
            return reached
        n = now
        far = jumps.select("file", F.col("off").alias("next"), F.col("next").alias("far"))
        jumps = stored(jumps.join(far, ["file", "next"]).select("file", "off", F.col("far").alias("next")), "warc-jumps")


def _on_chain(candidates: DataFrame, reached: DataFrame) -> DataFrame:
    """The candidates that the chain reaches: within each split, from where it enters."""
    marked = candidates.join(reached.withColumn("enters", F.lit(True)), ["file", "off"], "left").select(*candidates.columns, "enters")
    marked = marked.filter("rel is not null")

    def walk(key, table):
        rel, succ = table["rel"].to_pylist(), table["succ"].to_pylist()
        place = {r: i for i, r in enumerate(rel)}
        keep = []
        for i, enters in enumerate(table["enters"].to_pylist()):
            while enters and i is not None and succ[i] is not None:
                keep.append(i)
                i = place.get(succ[i])
        return table.drop_columns(["enters"]).take(pa.array(sorted(set(keep)), pa.int64()))

    return marked.groupBy("file", "block").applyInArrow(walk, candidates.schema)


def _payloads(spark: SparkSession, path: str, broken: DataFrame, splits: DataFrame) -> DataFrame:
    """(file, off, digest, size) of records whose payload contains MAGIC: their fragments, which
    may lie in several splits, are read again, assigned to their record and put together."""
    spans = broken.withColumn("until", F.col("off") + _SEP + F.col("head") + F.col("length"))
    over = (spans["file"] == splits["file"]) & (splits["base"] < F.col("until")) & (splits["base"] + splits["total"] > F.col("off"))
    spans = stored(spans.join(splits, over).select(splits["file"], splits["block"], "base", "off", "until", "head", "length"), "warc-spans")
    blocks = spans.select("file", "block", "base").distinct()  # at most one row for each split
    again = _fragments(spark, path).join(F.broadcast(blocks), ["file", "block"]).select("file", "block", "base", "body")

    def place_them(batches):
        at, place = None, 0
        for batch in batches:
            rows = []
            for file, block, base, value in zip(*[batch.column(i).to_pylist() for i in range(3)], batch.column(3)):
                if (file, block) != at:
                    at, place = (file, block), base
                body = value.as_py()
                rows.append({"file": file, "block": block, "start": place, "body": body})
                place += len(body) + _SEP
            yield _table(rows, "file string, block long, start long, body binary")

    pieces = again.mapInArrow(tidy(place_them), "file string, block long, start long, body binary")
    pieces = pieces.groupBy("file", "block")

    def assign(left, right):
        offs = np.sort(np.unique(right["off"].to_numpy()))
        until = dict(zip(right["off"].to_pylist(), right["until"].to_pylist()))
        rows = []
        for file, start, body in zip(left["file"].to_pylist(), left["start"].to_pylist(), left["body"]):
            k = int(np.searchsorted(offs, start, side="right")) - 1
            if k >= 0 and start < until[int(offs[k])]:
                rows.append({"file": file, "off": int(offs[k]), "start": start, "body": body.as_py()})
        return pa.Table.from_batches([_table(rows, "file string, off long, start long, body binary")])

    owned = pieces.cogroup(spans.groupBy("file", "block")).applyInArrow(assign, "file string, off long, start long, body binary")
    owned = owned.join(spans.select("file", "off", "head", "length").distinct(), ["file", "off"])

    def join_up(key, table):
        table = table.sort_by("start")  # one record's fragments
        head, length = table["head"][0].as_py(), table["length"][0].as_py()
        payload = MAGIC.encode().join(table["body"].to_pylist())[head : head + length]
        row = {"file": key[0].as_py(), "off": key[1].as_py(), "digest": hashlib.sha256(payload).hexdigest(), "size": len(payload)}
        return pa.Table.from_batches([_table([row], "file string, off long, digest string, size long")])

    return owned.groupBy("file", "off").applyInArrow(join_up, "file string, off long, digest string, size long")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Per verified record: page (string), type, size and digest of the full payload, refers (string).

    The digest of a response is computed from its payload; a revisit states that of its original.
    MAGIC inside payloads starts no record; bytes that the chain from a file's start doesn't reach
    are no records, so a file that doesn't begin with a record has none. Empty files have none.
    """
    found = stored(_candidates(_fragments(spark, path)), "warc-candidates")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = found.groupBy("file", "block").agg(F.first("total").alias("total"))  # one row for each split
    splits = splits.withColumn("base", F.coalesce(F.sum("total").over(before), F.lit(0)))
    splits = stored(splits, "warc-splits")
    rows = found.drop("total").join(F.broadcast(splits.drop("total")), ["file", "block"])
    rows = rows.withColumns({"off": F.col("base") + F.col("rel"), "exit_off": F.col("base") + F.col("exit")})
    chain = stored(_on_chain(rows, _reached(rows)), "warc-chain")
    out = chain.filter("whole").select("page", "type", "size", "digest", "refers")
    broken = chain.filter("not whole").select("file", "off", "head", "length", "page", "type", "refers")
    if broken.limit(1).count():
        full = _payloads(spark, path, broken, splits)
        out = out.unionByName(broken.join(full, ["file", "off"]).select("page", "type", "size", "digest", "refers"))
    return out


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write all rows as archives and return what reading them back gives."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path)
