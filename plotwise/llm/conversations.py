"""Repair of conversations: Knuth's lightest derivation over edits, its agenda ordered by cost and audit."""

from __future__ import annotations

import hashlib
import heapq
from functools import cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

import plotwise
from plotwise.llm.spark import stored

# Python workers get this module with the function itself.
cloudpickle.register_pickle_by_value(plotwise)

WHITE = " \t\n\x0b\x0c\r"
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3  # faults, the first that holds counts
# The grammar `(s?(ua)+)?` as states: 0 nothing yet, 1 after s, 2 after u, 3 after a.
STATES = range(4)
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
GOALS = (0, 3)
LEGAL = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1  # costs; keeping costs nothing
INSERTS = [(p, q, INSERT, "I") for p in STATES for c, q in NEXT[p].items() if c in ROLES]
BLOCK = 64  # steps an agenda works on at a time
HELD_BYTES = 32 << 20  # text of one conversation held by a task; longer ones are streamed
SALTS = 32

ITEM = "array<struct<p int, q int, cost long, audit string>>"
COUNTS = ("blank", "duplicate", "truncated", "illegal")
CHUNK = (
    "conv_id {id}, part int, whole boolean, blank long, duplicate long, truncated long, illegal long, turns long, "
    f"first_turn {{turn}}, last_turn {{turn}}, first_role string, last_role string, items {ITEM}, "
    "cost long, audit string, repaired_sha256 string"
)


@cache
def row_steps(initial: str, fault: int) -> list:
    """Deductions over one row: (state before, state after, cost, edit)."""
    steps = [(p, p, DELETE, "D") for p in STATES]
    if fault in (BLANK, DUPLICATE):
        return steps
    extra = CUT_OFF if fault == TRUNCATED else 0
    for p in STATES:
        steps += [(p, q, extra, "K") for c, q in NEXT[p].items() if c == initial]
        steps += [(p, q, REROLE + extra, "R") for c, q in NEXT[p].items() if c in ROLES]
    return steps


def lightest(steps: list, start: int, inserts=(), goals=None) -> dict:
    """Best (cost, audit) of every item (all steps taken, state), from one start state.

    Items are [start, i, q]: the first i steps lead from start to q. A deduction joins an item
    with a step (i, q to r) or with an insertion. Weights are (cost, steps taken, audit); the
    joined weight is never less than either part's and grows with both, so the first time an
    item is popped its weight is final. With goals, only the first goal item that is popped.
    """
    n, done, found = len(steps), set(), {}
    by_state = [[[s for s in at if s[0] == p] for p in STATES] for at in steps]
    closing = [[s for s in inserts if s[0] == p] for p in STATES]
    agenda = [(0, 0, "", start)]
    while agenda:
        cost, i, audit, q = heapq.heappop(agenda)
        if (i, q) in done:
            continue
        done.add((i, q))
        if i == n:
            if goals is None:
                found[q] = (cost, audit)
            elif q in goals:
                return {q: (cost, audit)}
        else:
            for _, r, c, a in by_state[i][q]:
                if (i + 1, r) not in done:
                    heapq.heappush(agenda, (cost + c, i + 1, audit + a, r))
        for _, r, c, a in closing[q]:
            if (i, r) not in done:
                heapq.heappush(agenda, (cost + c, i, audit + a, r))
    return found


def closed(steps: list, inserts=()) -> list:
    """The steps as one: the lightest way from every state to every other."""
    return [(p, q, c, a) for p in STATES for q, (c, a) in lightest(steps, p, inserts).items()]


def shortened(steps: list, inserts=INSERTS) -> tuple[list, tuple]:
    """Steps in blocks until one agenda can take them; blocks hold their own insertions."""
    while len(steps) > BLOCK:
        steps, inserts = [closed(steps[i : i + BLOCK], inserts) for i in range(0, len(steps), BLOCK)], ()
    return steps, inserts


def cheapest(steps: list, inserts=INSERTS) -> tuple[int, str]:
    """Cost and audit of the cheapest edits, ties to the ASCII-least audit."""
    steps, inserts = shortened(steps, inserts)
    return next(iter(lightest(steps, 0, inserts, GOALS).values()))


def applied(audit: str, rows):
    """(role, text) of every repaired turn; rows are (role, text) in order."""
    rows, state = iter(rows), 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        initial = role[:1] if edit == "K" else next(c for c in NEXT[state] if c in ROLES)
        state = NEXT[state][initial]
        yield (role if edit == "K" else ROLES[initial]), text


class _Digest:
    """SHA-256 of `role:text` lines, fed turn by turn."""

    def __init__(self):
        self.hash, self.any = hashlib.sha256(), False

    def add(self, role: str, text: str):
        self.hash.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
        self.any = True


class _Chunk:
    """What consecutive rows of one conversation say, in any number of parts."""

    def __init__(self, conv_id):
        self.conv_id, self.steps, self.counts = conv_id, [], dict.fromkeys(COUNTS, 0)
        self.turns, self.first_turn, self.last_turn = 0, None, None
        self.first_role = self.last_role = None
        self.rows, self.held = [], 0

    def add(self, turn, role, text, copies, first, fault):
        initial = role[:1]
        for k in range(copies):
            now = DUPLICATE if fault != BLANK and (k or not first) else fault
            if now:
                self.counts[("blank", "duplicate", "truncated")[now - 1]] += 1
            if self.last_role is not None and self.last_role + initial not in LEGAL:
                self.counts["illegal"] += 1
            self.last_role = initial
            if self.first_role is None:
                self.first_role = initial
            self.steps.append(row_steps(initial if initial in "sua" else "", now))
            if self.rows is not None:
                self.rows.append((role, text))
                self.held += len(text)
                if self.held > HELD_BYTES:
                    self.rows = None
        if copies and turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def row(self, part: int, whole: bool) -> dict:
        whole = whole and self.rows is not None
        out = dict(conv_id=self.conv_id, part=part, whole=whole, **self.counts, turns=self.turns)
        out |= {n: getattr(self, n) for n in ("first_turn", "last_turn", "first_role", "last_role")}
        if not whole:
            steps, inserts = shortened(self.steps)
            items = closed(steps, inserts)
            return out | dict(items=[dict(zip("pq", i[:2]), cost=i[2], audit=i[3]) for i in items])
        cost, audit = cheapest(self.steps)
        digest = _Digest()
        for turn in applied(audit, self.rows):
            digest.add(*turn)
        return out | dict(items=[], cost=cost, audit=audit, repaired_sha256=digest.hash.hexdigest())


def _rows(batches):
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _batched(rows, schema: pa.Schema, size: int = 500):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _chunks(schema: pa.Schema):
    def run(batches):
        """One row per conversation of the partition; its first and last may go on elsewhere."""
        part = TaskContext.get().partitionId()

        def made():
            before, held = False, None
            for conv_id, rows in groupby(_rows(batches), key=lambda r: r[0]):
                if held is not None:
                    yield held.row(part, before)
                    before = True
                held = _Chunk(conv_id)
                for _, *row in rows:
                    held.add(*row)
            if held is not None:
                yield held.row(part, False)

        yield from _batched(made(), schema)

    return run


def _joined(schema: pa.Schema):
    names = schema.names

    def run(batches):
        """Chunks of a conversation, in order, as one."""

        def made():
            for _, rows in groupby((dict(zip(names, r)) for r in _rows(batches)), key=lambda r: r["conv_id"]):
                out, steps = None, []
                for row in rows:
                    steps.append([(i["p"], i["q"], i["cost"], i["audit"]) for i in row["items"]])
                    if out is None:
                        out = row
                        continue
                    for name in COUNTS:
                        out[name] += row[name]
                    if row["first_role"] is not None:
                        if out["last_role"] is not None and out["last_role"] + row["first_role"] not in LEGAL:
                            out["illegal"] += 1
                        out["last_role"] = row["last_role"]
                        out["first_role"] = row["first_role"] if out["first_role"] is None else out["first_role"]
                    if row["turns"]:
                        out["turns"] += row["turns"] - (row["first_turn"] == out["last_turn"])
                        out["first_turn"] = row["first_turn"] if out["first_turn"] is None else out["first_turn"]
                        out["last_turn"] = row["last_turn"]
                cost, audit = cheapest(steps, ())
                yield out | dict(items=[], cost=cost, audit=audit)

        yield from _batched(made(), schema, 1)

    return run


def _told(rows):
    """conv_id, audit and its rows, of a stream in which an audit stands before its rows."""
    for conv_id, mine in groupby(rows, key=lambda r: r[0]):
        audit = next(mine)[1]
        yield conv_id, audit, ((role, text) for _, _, role, text, copies in mine for _ in range(copies))


def _digests(schema: pa.Schema):
    def run(batches):
        def made():
            for conv_id, audit, rows in _told(_rows(batches)):
                digest = _Digest()
                for turn in applied(audit, rows):
                    digest.add(*turn)
                yield dict(conv_id=conv_id, repaired_sha256=digest.hash.hexdigest())

        yield from _batched(made(), schema)

    return run


def _turns(schema: pa.Schema):
    def run(batches):
        def made():
            for conv_id, audit, rows in _told(_rows(batches)):
                for place, (role, text) in enumerate(applied(audit, rows)):
                    yield dict(conv_id=conv_id, place=place, role=role, text=text)

        yield from _batched(made(), schema)

    return run


def _arrow(kinds: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(kinds))


def faulted(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, copies: Column) -> DataFrame:
    """conv_id, turn, role, text, copies, first, fault: rows alike are one; first: none alike has an earlier turn.

    Rows alike fold in the tasks that read them. A text that comes in many turns of one
    conversation is dealt by a hash of the turn, so no task takes all of its rows.
    """
    said = rows.select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit(" ")).alias("role"),
        F.coalesce(text_col, F.lit(" ")).alias("text"),
        copies.alias("copies"),
    )
    said = stored(said.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")), "turns")
    said = said.withColumn("digest", F.unhex(F.sha2("text", 256)))
    said = said.withColumn("salt", F.pmod(F.xxhash64("turn"), F.lit(SALTS)))
    firsts = (
        said.filter("copies > 0")
        .groupBy("conv_id", "role", "digest")
        .agg(F.min(F.struct("turn")).alias("earliest"), F.count("*").alias("n"), F.collect_set("salt").alias("salts"))
        .filter("n > 1")
        .select(
            F.col("conv_id").alias("of"),
            F.col("role").alias("by"),
            F.col("digest").alias("what"),
            "earliest",
            F.explode("salts").alias("dealt"),
        )
    )
    joined = said.join(
        firsts,
        said["conv_id"].eqNullSafe(firsts["of"])
        & (said["role"] == firsts["by"])
        & (said["digest"] == firsts["what"])
        & (said["salt"] == firsts["dealt"]),
        "left",
    )
    end = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    fault = F.when(end == "", BLANK).when(~end.isin(*".!?"), TRUNCATED).otherwise(0)
    first = F.col("earliest").isNull() | F.col("earliest.turn").eqNullSafe(F.col("turn"))
    return joined.select("conv_id", "turn", "role", "text", "copies", first.alias("first"), fault.alias("fault"))


def _audited(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Rows of conversations, each conversation in one partition, in order, its audit before them."""
    head = audits.select("conv_id", "audit", *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("turn", "role", "text", "copies")])
    tail = rows.select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", "text", "copies")
    both = head.withColumn("kind", F.lit(0)).unionByName(tail.withColumn("kind", F.lit(1)))
    dealt = both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "text")
    return dealt.select("conv_id", "audit", "role", "text", "copies")


def repair_conversations(
    rows: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    copies: Column | None = None,
) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    A conversation's rows stand by turn, nulls first, then by role and text in the order of
    their bytes. The first fault of a row counts: blank, duplicate (same role and text
    earlier), truncated. The cheapest edits that leave role initials `(s?(ua)+)?` are found:
    keep 0, rerole to user or assistant 2, delete 3 (required for blank and duplicate), insert
    an empty user or assistant text 2, and 1 for a truncated row that stays; ties fall to the
    ASCII-least audit (K, R, D, I in order). `repaired_turns` gives the repaired rows.

    Rows are sorted by range over conversations and turns, so a conversation of any length is
    several tasks' work: each gives, for every state before and after, the lightest way
    through its rows; these are joined in order. Only conversations cut by a range, at most
    two a partition, or of over 32 MB of text are read again for their digest, in order and
    without holding them (SHA-256 has one order, so that is one task each).

    Null roles and texts count as one space (so such a text is blank), a null turn comes
    first, rows with a null id are one conversation. Repeated rows are duplicates. `copies`
    says how often a row stands; with 0 it is gone but its conversation is still returned,
    with zeros and an empty audit if nothing is left. Further columns are ignored. An empty
    table gives an empty result.
    """
    said = stored(faulted(rows, id_col, turn_col, role_col, text_col, F.lit(1) if copies is None else copies), "faults")
    kinds = {f.name: f.dataType.simpleString() for f in said.schema}
    chunk = CHUNK.format(id=kinds["conv_id"], turn=kinds["turn"])
    # The bounds of the ranges are a sample of keys; a text gives its first characters to them.
    ranged = said.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32))
    ranged = ranged.sortWithinPartitions("conv_id", "turn", "role", "text")
    chunks = stored(ranged.mapInArrow(_chunks(_arrow(chunk)), chunk), "conversation-chunks")
    cut = chunks.filter("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    cut = stored(cut.mapInArrow(_joined(_arrow(chunk)), chunk), "conversations-joined").drop("repaired_sha256")
    # At most two ids a partition and those with over 32 MB of text: few beside the rows.
    own = said.join(cut.select(F.col("conv_id").alias("_cut")), F.col("conv_id").eqNullSafe(F.col("_cut")), "left_semi")
    made = f"conv_id {kinds['conv_id']}, repaired_sha256 string"
    digests = _audited(own, cut).mapInArrow(_digests(_arrow(made)), made).withColumnRenamed("conv_id", "_of")
    cut = cut.join(digests, F.col("conv_id").eqNullSafe(F.col("_of"))).drop("_of")
    every = chunks.filter("whole").unionByName(cut)
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0)).cast("long")
    return every.select("conv_id", gaps.alias("gaps"), *COUNTS, "cost", "audit", "repaired_sha256")


def repaired_turns(
    rows: DataFrame,
    found: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    copies: Column | None = None,
) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), role, text; found is repair_conversations of the rows."""
    said = rows.select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit(" ")).alias("role"),
        F.coalesce(text_col, F.lit(" ")).alias("text"),
        (F.lit(1) if copies is None else copies).cast("long").alias("copies"),
    )
    made = f"conv_id {said.schema['conv_id'].dataType.simpleString()}, place long, role string, text string"
    return _audited(said, found).mapInArrow(_turns(_arrow(made)), made)


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Conversations with a fault in one row of four or so, by crc32 of `conv_id:turn`, and how often each row stands."""
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    rows = rows.select("conv_id", "turn", "role", "text", (F.crc32(key) % 20).alias("_draw"))
    text, draw = F.coalesce("text", F.lit(" ")), F.col("_draw")
    made = rows.select(
        "conv_id",
        "turn",
        F.when(draw == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(draw == 1, "").when(draw == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(draw == 0, 0).when(draw == 3, 2).otherwise(1).alias("_stands"),
    )
    return made, F.col("_stands")
