"""Repair of conversations against a plain search over edits."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from veilmark.llm import conversations as repair

TURN = "conv_id long, turn long, role string, text string, n string, section string, audit string, first string, copy string"
FORM = re.compile("(s?(ua)+)?")
STEPS = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}


def table_of(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], TURN)


def cheapest(rows):
    """Least (cost, audit) and the lines, by a search in that order; rows are (role, text, fault)."""
    queue = [(0, "", 0, "", ())]
    while queue:
        cost, audit, done, shape, lines = heapq.heappop(queue)
        if done == len(rows) and FORM.fullmatch(shape):
            return cost, audit, list(lines)

        def push(more, edit, used, line, cost=cost, audit=audit, done=done, shape=shape, lines=lines):
            initial = line[0][:1] if line else ""
            if not line or (shape[-1:], initial) in STEPS:
                heapq.heappush(queue, (cost + more, audit + edit, done + used, shape + initial, lines + ((line,) if line else ())))

        for role in ("user", "assistant"):
            push(2, "I", 0, (role, ""))
        if done < len(rows):
            role, text, fault = rows[done]
            push(3, "D", 1, None)
            if fault in (None, "truncated"):
                push(int(fault is not None), "K", 1, (role, text))
                for new in ("user", "assistant"):
                    push(2 + int(fault is not None), "R", 1, (new, text))
    raise AssertionError


def expected(rows):
    """Reports by conversation, straight from the definition."""
    found = {}
    for conv in {r[0] for r in rows}:
        own = [(t, r if r is not None else " ", " " if x is None else x) for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, faulty = set(), []
        for _, role, text in own:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faulty.append((role, text, fault))
        cost, audit, lines = cheapest(faulty)
        turns = [t for t, _, _ in own if t is not None]
        faults = [f for _, _, f in faulty]
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(faulty, faulty[1:])]
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        found[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest,
        )
    return found


def as_reports(df):
    return {r[0]: tuple(r)[1:] for r in df.select("conv_id", *repair.COUNTS, "audit", "repaired_sha256").collect()}


def random_rows(seed, many):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(many), None]:
        for _ in range(rng.randrange(1, 6)):
            role = rng.choice(["user", "assistant", "system", "user", "assistant", None, "", "tool", "ümlaut"])
            text = rng.choice(["a.", "b", "", None, " \t", "c! \n", "é?", "a."])
            rows.append((conv, rng.choice([None, 0, 1, 2, 3, 7]), role, text))
    return rows


def test_reports_match_a_search_over_edits(spark):
    rows = random_rows(1, 120)
    assert as_reports(repair.reports(table_of(spark, rows))) == expected(rows)


def test_every_short_signature(spark):
    """All sequences of three rows over roles and faults."""
    kinds = [(role, text) for role in ("system", "user", "assistant", "x") for text in ("ok.", "cut", "")]
    rows = [
        (c, turn, role, f"{turn} {text}" if text else "")
        for c, chosen in enumerate(product(kinds, repeat=3))
        for turn, (role, text) in enumerate(chosen)
    ]
    assert as_reports(repair.reports(table_of(spark, rows))) == expected(rows)


def test_damage_matches_the_definition(spark):
    rng = random.Random(4)
    rows = [(c, t, ["user", "assistant"][t % 2], f"Is it {c}.{t}? Yes!") for c in range(60) for t in range(rng.randrange(1, 6))]
    rows += [(None, None, None, None), (500, None, "user", None), (501, 3, None, "Hm.")]
    rows += [(c, 0, "user", "Alone.") for c in range(600, 3000) if zlib.crc32(f"{c}:0".encode()) % 200 == 0]
    damaged = []
    for c, t, role, text in rows:
        shown = ":".join(" " if v is None else str(v) for v in (c, t))
        kind = zlib.crc32(shown.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        damaged += [(c, t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    found = as_reports(repair.repair_damaged(table_of(spark, rows)))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found == {c: expected(damaged).get(c, nothing) for c, *_ in rows}
    assert nothing in found.values()


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "assistant", "Hi."), (1, 2, "user", "So."), (2, 0, "system", "S."), (3, 0, "user", " ")]
    found = sorted(tuple(r) for r in repair.repaired(table_of(spark, rows)).collect())
    # Insert, Keep, Delete, Keep, Insert; a system row alone and a blank one go.
    assert found == [
        (1, 1, "user", "", "I"), (1, 2, "assistant", "Hi.", "K"), (1, 3, "user", "So.", "K"), (1, 4, "assistant", "", "I"),
    ]
    text = "\n".join(f"{r[2]}:{r[3]}" for r in found if r[0] == 1)
    reports = as_reports(repair.reports(table_of(spark, rows)))
    assert reports[1][-1] == hashlib.sha256(text.encode()).hexdigest()
    assert reports[3][-2:] == ("D", hashlib.sha256(b"").hexdigest())


def test_a_conversation_longer_than_a_piece(spark):
    """140,000 turns and 70,000 equal rows of one conversation, over several ranges."""
    n = 140_000
    turns = spark.range(n).select(
        F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("turn "), "id", F.lit(".")).alias("text"),
    )
    equal = spark.range(70_000).select(
        F.lit(7).cast("long").alias("conv_id"), F.lit(n).cast("long").alias("turn"), F.lit("user").alias("role"),
        F.lit("again.").alias("text"),
    )
    found = as_reports(repair.reports(turns.union(equal)))[7]
    lines = [f"{['user', 'assistant'][i % 2]}:turn {i}." for i in range(n)] + ["user:again.", "assistant:"]
    audit = "K" * n + "K" + "D" * 69_999 + "I"
    ordered = [audit, "K" * n + "KI" + "D" * 69_999]
    assert found[:-2] == (0, 0, 69_999, 0, 69_999, 3 * 69_999 + 2)
    assert found[-2] == min(ordered) and found[-1] == hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_shared_suffixes_share_nodes():
    automaton = repair.Automaton()
    rng = random.Random(2)
    letters = [repair.symbol(i, f) for i in range(4) for f in range(4)]
    texts = sorted(("".join(rng.choices(letters, k=rng.randrange(0, 30))) for _ in range(3000)), key=lambda s: s[::-1])
    solved = {t: automaton.best(t) for t in texts}
    assert all(repair.Automaton().best(t) == solved[t] for t in rng.sample(texts, 200))
    assert len(automaton.nodes) < 200


@pytest.mark.parametrize("rows", [[], [(None, None, None, None)], [(1, 5, "user", "x" * 2_000_000 + ".")]])
def test_odd_tables(spark, rows):
    assert as_reports(repair.reports(table_of(spark, rows))) == expected(rows)
