"""Chat formatting: minimum-cost repair of turn roles, then rendering of the repaired sequence.

A legal conversation is an optional system turn, then user and assistant turns in alternation, an
assistant turn last. Dynamic programming over this automaton chooses for every turn whether it is
kept, merged into the turn before, relabelled, or preceded by empty turns.

The cost of a run of turns is a matrix (state before, state after), and matrices combine, so a
conversation of any length is split over tasks: only conversations that lie in several ranges send
one matrix for each range; the states at the range borders follow from those alone.
"""

from __future__ import annotations

from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from labelgraph.llm.common import stored, task_count, tidy

ROLES = ("system", "user", "assistant")
#: Costs of the repairs. A role that is none of ROLES has to be relabelled, which costs less.
MERGE, INSERT, RELABEL, NAME_ROLE = 1, 2, 3, 1
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {(START, "system"): SYSTEM, (START, "user"): USER, (SYSTEM, "user"): USER, (USER, "assistant"): ASSISTANT, (ASSISTANT, "user"): USER}
_LAST = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
#: Empty turns that close a conversation in each state.
_CLOSE = {START: (), SYSTEM: ("user", "assistant"), USER: ("assistant",), ASSISTANT: ()}
_INF = 1 << 60


def _steps() -> dict[str | None, list[list[tuple[int, str, str, tuple[str, ...]] | None]]]:
    """role -> [before][after] -> cheapest (cost, action, role after, empty turns before)."""
    table = {}
    for role in (*ROLES, None):
        rows: list[list] = [[None] * 4 for _ in range(4)]

        def offer(s, t, step, rows=rows):
            if rows[s][t] is None or step[0] < rows[s][t][0]:
                rows[s][t] = step

        for label in (role, *[r for r in ROLES if r != role]) if role else ROLES:
            change = 0 if label == role else (RELABEL if role else NAME_ROLE)
            for s in range(4):
                if (s, label) in _NEXT:
                    offer(s, _NEXT[s, label], (change, "keep" if not change else "relabel", label, ()))
                if _LAST.get(s) == label:
                    offer(s, s, (change + MERGE, "merge" if not change else "relabel_merge", label, ()))
                for n in (1, 2):
                    for empty in product(("user", "assistant"), repeat=n):
                        at = s
                        for r in empty:
                            at = _NEXT.get((at, r), -1)
                        if (at, label) in _NEXT:
                            offer(s, _NEXT[at, label], (change + n * INSERT, "insert" if not change else "relabel_insert", label, empty))
        table[role] = rows
    return table


STEPS = _steps()


def forward(roles: list[str | None], cost: list[int]) -> list[list[int]]:
    """Least cost of each state before the first turn and after every turn."""
    out = [cost]
    for role in roles:
        rows, old = STEPS[role], out[-1]
        out.append([min([old[s] + rows[s][t][0] for s in range(4) if rows[s][t]], default=_INF) for t in range(4)])
    return out


def repair(roles: list[str | None], before: int = START, after: int | None = None) -> list[tuple[int, str, str, tuple[str, ...]]]:
    """The chosen step of each turn; ``after`` None ends the conversation, closing turns included
    in the cost. Of equally cheap choices the one from the lowest state counts."""
    costs = forward(roles, [0 if s == before else _INF for s in range(4)])
    at = min(range(4), key=lambda t: costs[-1][t] + INSERT * len(_CLOSE[t])) if after is None else after
    out = []
    for i in range(len(roles) - 1, -1, -1):
        rows = STEPS[roles[i]]
        s = min((s for s in range(4) if rows[s][at]), key=lambda s: costs[i][s] + rows[s][at][0])
        out.append(rows[s][at])
        at = s
    return out[::-1]


def borders(segments: list[tuple[int, list[list[int]], int]]) -> dict[int, tuple[int, int | None, int]]:
    """range -> (state before, state after or None for the last, turns before) from the ranges'
    (number, matrix, turns) in order."""
    costs = [[0, _INF, _INF, _INF]]
    for _, m, _ in segments:
        costs.append([min(costs[-1][s] + m[s][t] for s in range(4)) for t in range(4)])
    at = min(range(4), key=lambda t: costs[-1][t] + INSERT * len(_CLOSE[t]))
    out, after = {}, None
    ahead = sum(n for _, _, n in segments)
    for i in range(len(segments) - 1, -1, -1):
        number, m, n = segments[i]
        s = min(range(4), key=lambda s: costs[i][s] + m[s][at])
        ahead -= n
        out[number] = (s, after, ahead)
        at = after = s
    return out


CLOSING = "<|end|>\n"


def _runs(batches, columns: list[str]):
    """Rows of each (pid, conversation) run, in order; one run is held at a time."""
    at, held = None, []
    for batch in batches:
        for row in batch.select(columns).to_pylist():
            here = (row["pid"], row["c"])
            if here != at:
                if held:
                    yield held
                at, held = here, []
            held.append(row)
    if held:
        yield held


def _role(r: str | None) -> str | None:
    return r if r in ROLES else None


def repair_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn of the repaired conversations: conv, seq (0, 1, ... in a conversation),
    turn, role, new_role, action, inserted (empty turns before it), closed (empty turns after the
    last one), cost, rendered.

    The rendered pieces of a conversation in seq order are its chat text; no conversation is
    gathered into one string. Turns are ordered by turn (null first), then role, then a hash of
    the text. Every row is a turn of its own: rows equal in all of these follow one another (a
    stored row number ends the order) and are merged like any neighbours of one role. A null or unknown role gets one of the three, a null text is empty; turns with a null
    conversation form one conversation. Extra columns are ignored; no rows give no rows.

    Roles and hashes alone are sorted and repaired; the texts are shuffled once, to their decisions.
    """
    spark = turns.sparkSession
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    src = turns.select(F.col(f"`{conv}`").alias("c"), F.col(f"`{turn}`").alias("n"), F.col(f"`{role}`").alias("r"), body.alias("t"))
    unit = F.struct("c", "n", "r", F.xxhash64("t").alias("h"))
    light = stored(src.select(unit.alias("u"), F.monotonically_increasing_id().alias("i")), "chat-turns")
    keys = ["u.c", "u.n", "u.r", "u.h", "i"]
    n = task_count(spark, light.count())
    ranged = light.repartitionByRange(n, *keys).select("u", "u.c", F.col("u.r").alias("r"), "i", F.spark_partition_id().alias("pid"))
    ranged = stored(ranged, "chat-ranges")
    split = ranged.groupBy("c").agg(F.count_distinct("pid").alias("pids")).filter("pids > 1").select(F.col("c").alias("sc"))
    parts = ranged.join(split, ranged["c"].eqNullSafe(split["sc"])).drop("sc").repartition(n, "pid").sortWithinPartitions("pid", "u", "i")

    def matrices(batches):
        for run in _runs(batches, ["pid", "c", "r"]):
            roles = [_role(x["r"]) for x in run]
            m = [forward(roles, [0 if s == k else _INF for s in range(4)])[-1] for k in range(4)]
            m = [min(v, _INF) for row in m for v in row]
            yield pa.RecordBatch.from_arrays(
                [pa.array([run[0]["pid"]], pa.int32()), pa.array([run[0]["c"]], kind), pa.array([m], pa.list_(pa.int64())), pa.array([len(run)], pa.int64())],
                names=["pid", "c", "m", "turns"],
            )

    c_type = ranged.schema["c"].dataType
    kind = to_arrow_type(c_type)
    found = parts.mapInArrow(tidy(matrices), f"pid int, c {c_type.simpleString()}, m array<long>, turns long")
    by_conv: dict = {}
    for r in sorted(found.collect(), key=lambda r: r["pid"]):  # at most two for each range
        m = [list(r["m"][i : i + 4]) for i in range(0, 16, 4)]
        by_conv.setdefault(r["c"], []).append((r["pid"], m, r["turns"]))
    known = {(pid, c): b for c, segments in by_conv.items() for pid, b in borders(segments).items()}
    held = spark.sparkContext.broadcast(known)
    ordered = ranged.repartition(n, "pid").sortWithinPartitions("pid", "u", "i")
    u_kind = to_arrow_type(ranged.schema["u"].dataType)
    schema = pa.schema(
        [("u", u_kind), ("seq", pa.int64()), ("new_role", pa.string()), ("action", pa.string()), ("inserted", pa.list_(pa.string())),
         ("closed", pa.list_(pa.string())), ("cost", pa.int64())]
    )

    def decide(batches):
        out: list[dict] = []
        for run in _runs(batches, ["pid", "c", "r", "u"]):
            before, after, ahead = held.value.get((run[0]["pid"], run[0]["c"]), (START, None, 0))
            steps = repair([_role(x["r"]) for x in run], before, after)
            for i, (x, (cost, action, new, empty)) in enumerate(zip(run, steps)):
                last = after is None and i == len(run) - 1
                closing = _CLOSE[{"system": SYSTEM, "user": USER, "assistant": ASSISTANT}[new]] if last else ()
                out.append(
                    {"u": x["u"], "seq": ahead + i, "new_role": new, "action": action, "inserted": list(empty), "closed": list(closing) if last else None,
                     "cost": cost + INSERT * len(closing)}
                )
            if len(out) > 10_000:
                yield from pa.Table.from_pylist(out, schema=schema).to_batches()
                out = []
        if out:
            yield from pa.Table.from_pylist(out, schema=schema).to_batches()

    spec = f"u {ranged.schema['u'].dataType.simpleString()}, seq long, new_role string, action string, inserted array<string>, closed array<string>, cost long"
    steps = ordered.mapInArrow(tidy(decide), spec)
    texts = src.select(unit.alias("u"), "t").groupBy("u").agg(F.first("t").alias("t"))
    rows = steps.join(texts, "u")
    empty_turns = lambda c: F.array_join(F.transform(c, lambda r: F.concat(F.lit("<|"), r, F.lit("|>\n" + CLOSING))), "")
    merged = F.col("action").isin("merge", "relabel_merge")
    opening = F.concat(F.when(F.col("seq") > 0, CLOSING).otherwise(""), empty_turns("inserted"), F.lit("<|"), F.col("new_role"), F.lit("|>\n"))
    end = F.when(F.col("closed").isNotNull(), F.concat(F.lit(CLOSING), empty_turns("closed"))).otherwise("")
    return rows.select(
        F.col("u.c").alias(conv),
        "seq",
        F.col("u.n").alias(turn),
        F.col("u.r").alias(role),
        "new_role",
        "action",
        F.size("inserted").cast("long").alias("inserted"),
        F.greatest(F.coalesce(F.size("closed"), F.lit(0)), F.lit(0)).cast("long").alias("closed"),
        "cost",
        F.concat(F.when(merged, "\n").otherwise(opening), "t", end).alias("rendered"),
    )
