"""Repair of damaged conversations by lightest derivations.

A repaired conversation has role initials ``(s?(ua)+)?``. Its edits are deductions of a weighted hypergraph: an item says that the rows
from one on can be finished from a state of that pattern, and each edit (keep, change role, delete, insert) derives an item from
the item behind it. Knuth's agenda pops items by (cost, rows taken, audit). An edit goes in front of an audit, so equally cheap audits keep
their order, and it costs something or takes a row, so what is popped is final; the agenda ends with its goal item.

Conversations of any length are cut into segments of at most SEGMENT turns: rows are range-partitioned by (conversation, turn, role, text), so
many tasks share a long conversation, identical rows are folded before, and earlier copies of a text are found by an aggregate. A
segment gives the lightest derivation between any two states; the segments of a conversation are items of the same kind once more.
An insertion never pays here (deleting a neighbour is cheaper), so cheapest audits have one letter per row and are compared piecewise.
What needs a conversation as one value, its audit and digest, is put together from segments or streamed row by row.

Cases: a null role or text is one space; null turns come first, rows of one turn by role, then text; a null conv_id is a conversation;
repeated rows are duplicates; an empty or missing role has no legal initial and is changed or deleted; an empty table gives no
conversations; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.functions.skew import join_per_key
from tillworks.session import cut_lineage

SEGMENT = 256
RETYPE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
NEW_ROLES = {"u": "user", "a": "assistant"}
#: States of the pattern: nothing yet, behind a system turn, behind a user's, behind an assistant's; {state: {initial: next state}}.
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
FINAL = (START, ASSISTANT)
LEGAL_PAIRS = ("su", "ua", "au")
BLANKS = " \t\n\x0b\x0c\r"
#: A null turn in the order of turns.
NO_TURN = -(2 ** 63)

_EDIT = pa.struct([("start", pa.int32()), ("goal", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_LINE = pa.struct([("role", pa.string()), ("text", pa.string()), ("copies", pa.int64())])
_COUNTS = ["rows", "blank", "duplicate", "truncated", "illegal", "turns"]


def lightest(rows: list[tuple[str, str, int]], goal: int, starts: frozenset[int] | set[int]) -> dict[int, tuple[int, str]]:
    """{start state: (cost, audit)} of the lightest derivations of ``rows`` that end in state ``goal``, for those of ``starts`` there are.

    A row is (initial, fault, copies): all copies but the first are duplicates.
    """
    before: dict[int, list[tuple[int, str]]] = {s: [] for s in STEPS}
    for state, steps in STEPS.items():
        for initial, then in steps.items():
            before[then].append((state, initial))
    n, agenda, final = len(rows), [(0, 0, "", goal)], set()
    out: dict[int, tuple[int, str]] = {}
    while agenda and len(out) < len(starts):
        cost, taken, audit, state = heappop(agenda)
        if (taken, state) in final:
            continue
        final.add((taken, state))
        if taken == n and state in starts:
            out[state] = cost, audit
        for earlier, initial in before[state]:
            if initial in NEW_ROLES:
                heappush(agenda, (cost + INSERT, taken, "I" + audit, earlier))
        if taken == n:
            continue
        own, fault, copies = rows[n - 1 - taken]
        cost += DELETE * (copies - 1)
        audit = "D" * (copies - 1) + audit
        heappush(agenda, (cost + DELETE, taken + 1, "D" + audit, state))
        if fault in ("blank", "duplicate"):
            continue
        cost += TRUNCATED * (fault == "truncated")
        for earlier, initial in before[state]:
            if initial == own:
                heappush(agenda, (cost, taken + 1, "K" + audit, earlier))
            if initial in NEW_ROLES:
                heappush(agenda, (cost + RETYPE, taken + 1, "R" + audit, earlier))
    return out


def chained(segments: list[list[dict]]) -> tuple[int, list[tuple[int, str]]]:
    """(cost, [(start state, audit) per segment]) of the lightest derivation through the segments' edits, from START to a final state."""
    # per state: (cost, place of the tail's audit among those of its cost and below, tail)
    tails: dict[int, tuple[int, tuple | None]] = {s: (0, None) for s in FINAL}

    def letters(tail):
        while tail:
            yield tail[1]
            tail = tail[2]

    for edits in reversed(segments):
        best: dict[int, tuple[int, tuple]] = {}
        for e in edits:
            if e["goal"] not in tails:
                continue
            cost, tail = tails[e["goal"]]
            cost += e["cost"]
            have = best.get(e["start"])
            if have is None or cost < have[0] or cost == have[0] and _less((e["audit"], tail), (have[1][1], have[1][2]), letters):
                best[e["start"]] = cost, (e["start"], e["audit"], tail)
        tails = best
    cost, tail = tails[START]
    out = []
    while tail:
        out.append((tail[0], tail[1]))
        tail = tail[2]
    return cost, out


def _less(a: tuple, b: tuple, letters) -> bool:
    """Whether one audit, given as its first piece and its tail, comes before another in ASCII order; shared tails are not read."""
    (x, more_x), (y, more_y) = a, b
    while x == y and more_x is not more_y and more_x and more_y:
        (_, x, more_x), (_, y, more_y) = more_x, more_y
    if x == y and (more_x is more_y):
        return False
    if x.startswith(y) or y.startswith(x):
        return x + "".join(letters(more_x)) < y + "".join(letters(more_y))
    return x < y


def replayed(lines: list[dict], audit: str, state: int) -> Iterator[tuple[str, str | None, str | None]]:
    """(edit, role, text) for each edit from a state on; deleted rows have neither."""
    copies = [line for line in lines for _ in range(line["copies"])]
    at = 0
    for edit in audit:
        line = copies[at] if edit != "I" else None
        at += edit != "I"
        if edit == "D":
            yield edit, None, None
            continue
        initial = line["role"][:1] if edit == "K" else "a" if state == USER else "u"
        state = STEPS[state][initial]
        yield edit, line["role"] if edit == "K" else NEW_ROLES[initial], line["text"] if line else ""


def marked_rows(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows folded into conv, turn (null: NO_TURN), role, text, copies, with their first fault (null: none)."""
    rows = rows.select(F.col(conv_id).alias("conv"), F.coalesce(F.col(turn).cast("long"), F.lit(NO_TURN)).alias("turn"),
                       F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"))
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumn("h", F.xxhash64("role", "text")).withColumn("g", F.xxhash64("text", F.lit(7), "role"))
    first = rows.groupBy("conv", "h", "g").agg(F.min("turn").alias("first"))
    ink = F.rtrim("text", F.lit(BLANKS))
    fault = (F.when(F.length(ink) == 0, "blank").when(F.col("turn") > F.col("first"), "duplicate")
             .when(~F.right(ink, F.lit(1)).isin(".", "!", "?"), "truncated"))
    return join_per_key(rows, first, ["conv", "h", "g"], "inner").withColumn("fault", fault).drop("h", "g", "first")


def segments(marked: DataFrame, size: int = SEGMENT) -> DataFrame:
    """Rows in order, cut into segments: conv, part and seq (their order), counts, first and last initial and turn, lines, and the lightest
    edits between states. ``part`` is the range partition, so a long conversation is shared by many tasks."""
    order = ["conv", "turn", "role", "text"]
    kind = marked.schema["conv"].dataType
    schema = T.StructType([
        T.StructField("conv", kind), T.StructField("part", T.IntegerType()), T.StructField("seq", T.LongType()),
        *[T.StructField(c, T.LongType()) for c in _COUNTS], T.StructField("ends", T.ArrayType(T.StringType())),
        T.StructField("turn_ends", T.ArrayType(T.LongType())),
        T.StructField("lines", T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                                                         T.StructField("copies", T.LongType())]))),
        T.StructField("edits", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("goal", T.IntegerType()),
                                                         T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, own, conv, opened = TaskContext.get().partitionId(), 0, [], None, False
        out: list[tuple] = []
        conv_type = None

        def closed(last: bool) -> None:
            """Summary of the gathered rows. A conversation that began in this task starts at START; one that ends in it, in a final state."""
            nonlocal seq
            out.append((conv, part, seq, *_summary(own, {START} if opened else set(STEPS), FINAL if last else tuple(STEPS))))
            seq += 1
            own.clear()

        def flushed() -> Iterator[pa.RecordBatch]:
            if out:
                kinds = [conv_type, pa.int32(), *[pa.int64()] * 7, pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(_LINE), pa.list_(_EDIT)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=schema.names)
                out.clear()

        begun = False
        for batch in batches:
            conv_type = batch.schema.field(0).type
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if not begun or row[0] != conv:
                    if begun:
                        closed(True)
                    # the first conversation of a task may have begun in the task before
                    conv, opened, begun = row[0], begun, True
                elif len(own) >= size:
                    closed(False)
                    opened = False
                own.append(row[1:])
            yield from flushed()
        if begun:
            closed(False)  # it may go on in the next task
            yield from flushed()

    rows = marked.select(*order, "copies", "fault")
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)


def _summary(own: list[tuple], starts, goals) -> tuple:
    """Counts, end initials, end turns, lines and edits of rows (turn, role, text, copies, fault)."""
    counts = dict.fromkeys(_COUNTS, 0)
    previous = None
    turns = set()
    for turn, role, _, copies, fault in own:
        initial = role[:1]
        counts["rows"] += copies
        counts["illegal"] += (copies - 1) + (previous is not None and previous + initial not in LEGAL_PAIRS)
        if fault == "blank":
            counts["blank"] += copies
        else:
            counts["duplicate"] += copies - (fault != "duplicate")
            counts["truncated"] += fault == "truncated"
        previous = initial
        if turn != NO_TURN:
            turns.add(turn)
    counts["turns"] = len(turns)
    rows = [(role[:1], fault, copies) for _, role, _, copies, fault in own]
    edits = [{"start": s, "goal": g, "cost": cost, "audit": audit} for g in goals for s, (cost, audit) in lightest(rows, g, starts).items()]
    lines = [{"role": role, "text": text, "copies": copies} for _, role, text, copies, _ in own]
    return (*counts.values(), [own[0][1][:1], previous], [min(turns), max(turns)] if turns else [], lines, edits)


def decisions(cut: DataFrame) -> DataFrame:
    """One row per conversation of its segments: conv, rows, blank, duplicate, truncated, illegal, gaps, cost, audit, pieces (part, seq, start
    state and audit of each segment)."""
    facts = [c for c in cut.columns if c not in ("conv", "lines")]
    schema = T.StructType([
        T.StructField("conv", cut.schema["conv"].dataType), *[T.StructField(c, T.LongType()) for c in [*_COUNTS[:5], "gaps", "cost"]],
        T.StructField("audit", T.StringType()),
        T.StructField("pieces", T.ArrayType(T.StructType([T.StructField("part", T.IntegerType()), T.StructField("seq", T.LongType()),
                                                          T.StructField("start", T.IntegerType()), T.StructField("audit", T.StringType())])))])
    kinds = [pa.int64()] * 7 + [pa.string(), pa.list_(pa.struct([("part", pa.int32()), ("seq", pa.int64()), ("start", pa.int32()), ("audit", pa.string())]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_decided(own) for own in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(zip(*out), kinds)]], names=schema.names)

    together = cut.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "seq", *[c for c in facts if c not in ("part", "seq")]))).alias("all"))
    return together.mapInArrow(run, schema)


def _decided(own: list[dict]) -> tuple:
    counts = {c: sum(s[c] for s in own) for c in _COUNTS}
    turns = counts.pop("turns")
    low = high = None
    for i, s in enumerate(own):
        if i and own[i - 1]["ends"][1] + s["ends"][0] not in LEGAL_PAIRS:
            counts["illegal"] += 1
        if s["turn_ends"]:
            first, last = s["turn_ends"]
            turns -= first == high
            low, high = first if low is None else low, last
    cost, path = chained([s["edits"] for s in own])
    pieces = [{"part": s["part"], "seq": s["seq"], "start": start, "audit": audit} for s, (start, audit) in zip(own, path)]
    return (*counts.values(), high - low + 1 - turns if turns else 0, cost, "".join(audit for _, audit in path), pieces)


def repair(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           size: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """(one row per conversation, the repaired turns).

    Conversations: conv, rows, blank, duplicate, truncated, illegal, gaps, cost, audit. Turns: conv, part, seq, place (their order), edit,
    role, text.
    """
    cut = cut_lineage(segments(marked_rows(rows, conv_id, turn, role, text), size))
    found = cut_lineage(decisions(cut))
    chosen = found.select("conv", F.explode("pieces").alias("p")).select("conv", "p.part", "p.seq", "p.start", "p.audit")
    pairs = join_per_key(cut.select("conv", "part", "seq", "lines"), chosen, ["conv", "part", "seq"], "inner")
    schema = T.StructType([T.StructField("conv", cut.schema["conv"].dataType), T.StructField("part", T.IntegerType()), T.StructField("seq", T.LongType()),
                           T.StructField("place", T.IntegerType()), *[T.StructField(c, T.StringType()) for c in ("edit", "role", "text")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for i, (lines, start, audit) in enumerate(zip(*[c.to_pylist() for c in batch.columns[3:]])):
                for place, (edit, own_role, own_text) in enumerate(replayed(lines, audit, start)):
                    if edit != "D":
                        for column, value in zip(out, (i, place, edit, own_role, own_text)):
                            column.append(value)
            whose = pa.array(out[0], pa.int32())
            columns = [batch.column(c).take(whose) for c in range(3)]
            columns += [pa.array(out[1], pa.int32()), *[pa.array(c, pa.string()) for c in out[2:]]]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return found.drop("pieces"), pairs.select("conv", "part", "seq", "lines", "start", "audit").mapInArrow(run, schema)


def turn_digests(turns: DataFrame) -> DataFrame:
    """(conv, sha256) of each conversation's ``role:text`` lines in order, streamed: no conversation is held in memory."""
    kind = turns.schema["conv"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sha, conv_type = None, None, None
        for batch in batches:
            done: tuple[list, list] = ([], [])
            conv_type = batch.schema.field(0).type
            for own, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if sha is None or own != conv:
                    if sha is not None:
                        done[0].append(conv)
                        done[1].append(sha.hexdigest())
                    conv, sha = own, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(line.encode())
            yield pa.RecordBatch.from_arrays([pa.array(done[0], conv_type), pa.array(done[1], pa.string())], names=["conv", "sha256"])
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], conv_type), pa.array([sha.hexdigest()], pa.string())], names=["conv", "sha256"])

    ordered = turns.repartition("conv").sortWithinPartitions("conv", "part", "seq", "place").select("conv", F.concat_ws(":", "role", "text").alias("line"))
    return ordered.mapInArrow(run, T.StructType([T.StructField("conv", kind), T.StructField("sha256", T.StringType())]))


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with planted faults, by crc32 of ``conv_id:turn`` modulo 20 (nulls: one space): 0 drops a row, 1 empties its text, 2 removes its
    `[.!?]`, 3 repeats it, 4 sets role user."""
    def told(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(told(conv_id), F.lit(":"), told(turn)).cast("binary")) % 20
    own = F.when(fault == 1, "").when(fault == 2, F.translate(told(text), ".!?", "")).otherwise(told(text))
    return rows.where(fault != 0).select(F.col(conv_id), F.col(turn), F.when(fault == 4, "user").otherwise(told(role)).alias(role), own.alias(text),
                                         F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("_copy")
                                         ).withColumn("_copy", F.explode("_copy")).drop("_copy")
