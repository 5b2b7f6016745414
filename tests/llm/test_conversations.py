"""Conversation repair against every sequence of edits, on awkward rows, and cut over many partitions."""

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from plotwise.llm import conversations as c

WORDS = " \t\n\x0b\x0c\r"


def plain(rows):
    """The contract's columns by trying all edits, cheapest first; rows are (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        end = text.rstrip(WORDS)
        faults.append("b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    state = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    ways = {"": {(0, "", ())}}

    def inserted(ways):
        out = {}
        for q, found in ways.items():
            for cost, audit, kept in found:
                for k in range(3):
                    p, k_kept, ok = q, list(kept), True
                    for _ in range(k):
                        step = next((x for x in state[p] if x in "ua"), None)
                        p, ok = step, ok and step is not None
                        k_kept.append(({"u": "user", "a": "assistant"}[step], ""))
                    out.setdefault(p, set()).add((cost + 2 * k, audit + "I" * k, tuple(k_kept)))
        return {q: {min(found, key=lambda w: w[:2])} for q, found in out.items()}

    for (_, role, text), fault in zip(rows, faults):
        out = {}
        for q, found in inserted(ways).items():
            for cost, audit, kept in found:
                out.setdefault(q, set()).add((cost + 3, audit + "D", kept))
                if fault in ("b", "d"):
                    continue
                more = cost + (fault == "t")
                if role[:1] in state[q]:
                    out.setdefault(role[:1], set()).add((more, audit + "K", (*kept, (role, text))))
                for x in state[q]:
                    if x in "ua":
                        new = {"u": "user", "a": "assistant"}[x]
                        out.setdefault(x, set()).add((more + 2, audit + "R", (*kept, (new, text))))
        ways = out
    goals = [w for q, found in inserted(ways).items() if q in ("", "a") for w in found]
    cost, audit, kept = min(goals, key=lambda w: w[:2])
    turns = {t for t, _, _ in rows if t is not None}
    firsts = [r[1][:1] for r in rows]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *[faults.count(f) for f in "bdt"],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(),
    )


def conversation(draw, n):
    roles = ["system", "user", "assistant", "assistant", "user", "tool", "", "usher", " "]
    texts = ["Fine.", "so", " \n", "", "Yes!", "Why? ", "é ünï.", "z" * 50]
    return [(draw.choice([None, *range(8)]), draw.choice(roles), draw.choice(texts) + draw.choice(["", f"{i}."])) for i in range(n)]


def result(df):
    names = ("gaps", *c.COUNTS, "cost", "audit", "repaired_sha256")
    return {r.conv_id: tuple(r[n] for n in names) for r in df.collect()}


def frame(spark, convs):
    rows = [(i, t, r, x, "clash", 1) for i, rows in convs.items() for t, r, x in rows]
    kinds = "conv_id long, turn long, role string, text string, digest string, copies int"
    return spark.createDataFrame(rows, kinds)


def test_repair(spark):
    draw = random.Random(5)
    convs = {i: conversation(draw, draw.randint(1, 9)) for i in range(150)}
    convs[None] = conversation(draw, 12)
    got = result(c.repair_conversations(frame(spark, convs).repartition(5)))
    assert got == {i: plain(rows) for i, rows in convs.items()}


def test_cheapest_is_the_least_of_all_edits():
    """Every audit of up to five edits over three rows."""
    grammar = {""} | {s + "ua" * k for s in ("", "s") for k in (1, 2, 3)}
    for kinds in itertools.product("suax", (0, c.BLANK, c.TRUNCATED), repeat=2):
        rows = [("s", 0), (kinds[0], kinds[1]), (kinds[2], kinds[3])]
        found = []
        for edits in itertools.product("KRDI", repeat=5):
            for n in range(3, 6):
                audit = "".join(edits[:n])
                if n - audit.count("I") != 3:
                    continue
                own, cost, made = iter(rows), 0, [""]
                for e in audit:
                    kind, fault = ("", 0) if e == "I" else next(own)
                    if e != "D" and fault == c.BLANK:
                        break
                    cost += {"K": 0, "R": 2, "D": 3, "I": 2}[e] + (e != "D" and fault == c.TRUNCATED)
                    ends = {"K": [kind], "D": [""]}.get(e, ["u", "a"])
                    made = [m + x for m in made for x in ends]
                else:
                    if set(made) & grammar:
                        found.append((cost, audit))
        got = c.cheapest([c.row_steps(k if k in "sua" else "", f) for k, f in rows])
        assert got <= min(found) and (len(got[1]) > 5 or got == min(found))


def test_blocks_and_chunks_change_nothing(spark, monkeypatch):
    draw = random.Random(7)
    steps = [c.row_steps(draw.choice("suax").replace("x", ""), draw.choice((0, 0, 0, 1, 3))) for _ in range(300)]
    whole = next(iter(c.lightest(steps, 0, c.INSERTS, c.GOALS).values()))
    assert c.cheapest(steps) == whole
    long = {1: conversation(draw, 700), 2: conversation(draw, 3), 3: conversation(draw, 400)}
    # Texts of their own, so that few rows are alike; turns of their own, so that ranges cut within.
    long = {i: [(k, r, f"{t}{k}") for k, (_, r, t) in enumerate(rows)] for i, rows in long.items()}
    want = {i: plain(rows) for i, rows in long.items()}
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        df = frame(spark, long)
        found = c.repair_conversations(df)
        assert result(found) == want
        told = c.repaired_turns(df, found).orderBy("conv_id", "place").collect()
        for i in long:
            said = "\n".join(f"{r.role}:{r.text}" for r in told if r.conv_id == i)
            assert hashlib.sha256(said.encode()).hexdigest() == want[i][-1]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_long_texts_are_streamed(spark, monkeypatch):
    monkeypatch.setattr(c, "HELD_BYTES", 1000)
    convs = {1: [(0, "user", "x" * 200_000 + "."), (1, "assistant", "y.")], 2: [(0, "user", "a."), (1, "assistant", "b.")]}
    assert result(c.repair_conversations(frame(spark, convs))) == {i: plain(rows) for i, rows in convs.items()}


def test_nulls_empty_table_and_missing_rows(spark):
    kinds = "conv_id long, turn long, role string, text string, n int"
    rows = [(1, None, None, None, 1), (1, 0, "user", None, 1), (2, 5, "user", "a.", 0), (None, 1, None, "b", 2)]
    df = spark.createDataFrame(rows, kinds)
    got = result(c.repair_conversations(df, copies=F.col("n")))
    empty = hashlib.sha256(b"").hexdigest()
    assert got[2] == (0, 0, 0, 0, 0, 0, "", empty)
    assert got[1] == plain([(None, " ", " "), (0, "user", " ")])
    assert got[None] == plain([(1, " ", "b"), (1, " ", "b")])
    assert c.repair_conversations(df.limit(0), copies=F.col("n")).collect() == []


def test_damage(spark):
    kinds = "conv_id long, turn long, role string, text string, _draw int"
    rows = [(i, None if i % 7 == 0 else i, None if i % 5 == 0 else "assistant", None if i % 11 == 0 else "A. b! c", 0) for i in range(200)]
    made, copies = c.damaged(spark.createDataFrame(rows, kinds))
    import zlib

    for r in made.select("*", copies.alias("n")).collect():
        _, turn, role, text, _ = rows[r.conv_id]
        draw = zlib.crc32(f"{r.conv_id}:{' ' if turn is None else turn}".encode()) % 20
        text, role = text or " ", role or " "
        want = {1: "", 2: text.replace(".", "").replace("!", "")}.get(draw, text)
        assert (r.role, r.text, r.n) == ("user" if draw == 4 else role, want, {0: 0, 3: 2}.get(draw, 1))


@pytest.mark.parametrize("audit, rows, want", [("", [], []), ("DIK", [("a", "x"), ("assistant", "y")], [("user", ""), ("assistant", "y")])])
def test_applied(audit, rows, want):
    assert list(c.applied(audit, rows)) == want
