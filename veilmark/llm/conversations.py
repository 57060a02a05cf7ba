"""Cheapest repair of conversations to the form ``(s?(ua)+)?`` over a suffix-shared automaton.

Every row has a symbol: its role's initial and its first fault.  A conversation's symbols, in order of the turns, are
its signature.  Edits, with cost: Keep 0, Rerole to user or assistant 2, Delete 3 (required for blank and duplicate
rows), Insert an empty user or assistant row 2; a truncated row that is not deleted adds 1.  The audit is the initials
of the cheapest edits, of equally cheap ones the least in ASCII.

Signatures are read from the end.  A node stands for a suffix; it holds, for each grammar state, the cost to go and the
first edit of the best audit, found once from the node behind it.  Suffixes whose costs differ by a constant share a
node, so there are few nodes however many conversations there are.  Distinct signatures are sorted by their reversed
text, so neighbours share the suffix path that is already built and only their own part is added.  An audit of one
letter more never costs the same, so the least first letter at each step gives the least audit.

Conversations of any length: symbols are built over ranges of the sorted rows, a long conversation over many tasks; what
a task holds of a conversation is one byte a row, like the audit itself.  The digest of the repaired text is computed
over sorted rows as they pass, one conversation in one task, as SHA-256 needs; no text is collected.

Rows with the same turn are taken by role, then by the SHA-256 of the text; a null turn comes first, a null role or text
counts as one space, rows with a null ``conv_id`` form one conversation.  Repeated rows are duplicates but for the
first.  Only the first letter of a role counts for the form; an empty role or another letter can be reroled or deleted.
Empty texts are blank.  An empty table gives no rows.  Other columns than ``conv_id, turn, role, text`` are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import stored
from .words import slices

#: White space of the blank and truncated faults.
WHITE = " \t\n\x0b\x0c\r"
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
INITIALS = "sua"
#: Symbols of a signature that leave a task in one row.
PIECE = 1 << 16

# Grammar states: nothing yet, after s, after u, after a.  A kept initial or a new role leads to the next state.
KEEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
NEW = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}


def symbol(initial: int, fault: int) -> str:
    """One letter for a row's initial (place in ``INITIALS``, 3 for others) and fault."""
    return chr(ord("A") + 4 * initial + fault)


class Node:
    """A suffix: costs to go above the least of them, and the best first edit, by grammar state."""

    __slots__ = ("costs", "edits", "before")

    def __init__(self, costs: tuple[int, ...], edits: tuple[str, ...]):
        self.costs, self.edits = costs, edits
        self.before: dict[str, tuple[Node, int]] = {}


class Automaton:
    """Nodes by their costs and edits, each computed once; the path of the last signature stays for the next one."""

    def __init__(self):
        self.nodes: dict[tuple, Node] = {}
        self.end, base = self._node([0, 4, 2, 0], ["", "I", "I", ""])
        self.path, self.sums, self.last = [self.end], [base], ""

    def _node(self, costs: list[int], edits: list[str]) -> tuple[Node, int]:
        least = min(costs)
        key = (tuple(c - least for c in costs), tuple(edits))
        if key not in self.nodes:
            self.nodes[key] = Node(*key)
        return self.nodes[key], least

    def prepend(self, node: Node, letter: str) -> tuple[Node, int]:
        """The node of ``letter`` before ``node``'s suffix, and what its least cost adds."""
        if letter not in node.before:
            initial, fault = divmod(ord(letter) - ord("A"), 4)
            choices = []
            for state in range(4):
                options = {"D": COSTS["D"] + node.costs[state]}
                if fault in (SOUND, TRUNCATED):
                    kept = KEEP[state].get(INITIALS[initial : initial + 1])
                    extra = int(fault == TRUNCATED)
                    if kept is not None:
                        options["K"] = COSTS["K"] + extra + node.costs[kept]
                    options["R"] = COSTS["R"] + extra + node.costs[NEW[state]]
                choices.append(options)
            costs = [min(options.values()) for options in choices]
            for _ in range(4):
                costs = [min(c, COSTS["I"] + costs[NEW[state]]) for state, c in enumerate(costs)]
            for state, options in enumerate(choices):
                options["I"] = COSTS["I"] + costs[NEW[state]]
            edits = [min(e for e, c in o.items() if c == costs[s]) for s, o in enumerate(choices)]
            node.before[letter] = self._node(costs, edits)
        return node.before[letter]

    def best(self, signature: str) -> tuple[int, str]:
        """Cost and audit of a signature."""
        backwards = signature[::-1]
        shared = len(os.path.commonprefix([backwards, self.last]))
        del self.path[shared + 1 :], self.sums[shared + 1 :]
        node, total = self.path[-1], self.sums[-1]
        for letter in backwards[shared:]:
            node, more = self.prepend(node, letter)
            total += more
            self.path.append(node)
            self.sums.append(total)
        self.last = backwards
        audit, state, place = [], 0, len(backwards)
        while edit := self.path[place].edits[state]:
            audit.append(edit)
            state = follow(state, edit, None if edit == "I" else signature[len(backwards) - place])
            place -= edit != "I"
        return total + node.costs[0], "".join(audit)


def follow(state: int, edit: str, letter: str | None) -> int:
    """The grammar state after an edit of a row with the symbol ``letter``."""
    if edit == "D":
        return state
    return KEEP[state][INITIALS[(ord(letter) - ord("A")) // 4]] if edit == "K" else NEW[state]


def _illegal(signature: str) -> int:
    initials = (np.frombuffer(signature.encode(), np.uint8).astype(int) - ord("A")) // 4
    pairs = initials[:-1] * 4 + initials[1:]
    legal = [4 * INITIALS.index(a) + INITIALS.index(b) for a, b in ("su", "ua", "au")]
    return int((~np.isin(pairs, legal)).sum())


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = Automaton()
    for batch in slices(batches):
        signatures = batch.column("signature").to_pylist()
        solved = [automaton.best(s) for s in signatures]
        counts = [[sum(s.count(symbol(i, fault)) for i in range(4)) for s in signatures] for fault in range(4)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("signature"),
                *[pa.array(counts[fault], pa.int64()) for fault in (BLANK, DUPLICATE, TRUNCATED)],
                pa.array([_illegal(s) for s in signatures], pa.int64()),
                pa.array([cost for cost, _ in solved], pa.int64()),
                pa.array([audit for _, audit in solved], pa.string()),
            ],
            names=["signature", "blank", "duplicate", "truncated", "illegal", "cost", "audit"],
        )


def solve(signatures: DataFrame) -> DataFrame:
    """``signature, blank, duplicate, truncated, illegal, cost, audit`` of each distinct ``signature``."""
    distinct = signatures.select("signature").distinct()
    order = F.reverse("signature")
    sorted_by_end = distinct.repartitionByRange(order).sortWithinPartitions(order)
    return sorted_by_end.mapInArrow(
        _solve,
        "signature string, blank long, duplicate long, truncated long, illegal long, cost long, audit string",
    )


def rows_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, digest`` with nulls in role and text as one space."""
    text = F.coalesce(F.col("text"), F.lit(" "))
    rows = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role"), F.lit(" ")).alias("role"), text.alias("text")
    )
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures of the conversations of a sorted range, a long one in several pieces."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    owner, piece, held, place, ids, places, pieces = None, [], 0, 0, [], [], []

    def close():
        nonlocal piece, held, place
        if piece:
            ids.append(owner[0])
            places.append(place)
            pieces.append("".join(piece))
            piece, held, place = [], 0, place + 1

    def flush():
        made = pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array([part] * len(ids), pa.int32()),
                pa.array(places, pa.int64()),
                pa.array(pieces, pa.string()),
            ],
            names=["conv_id", "part", "place", "piece"],
        )
        for held_rows in (ids, places, pieces):
            held_rows.clear()
        return made

    for batch in slices(batches):
        for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "first", "again", "n")), strict=True):
            if owner != (row[0],):
                close()
                owner = (row[0],)
            todo, letters = row[3], [row[1]]
            while todo:
                # The first of equal rows has its own symbol, the others that of a repeat.
                many = 1 if letters[0] != row[2] else min(todo, PIECE - held)
                piece.append(letters[0] * many)
                letters, todo, held = [row[2]], todo - many, held + many
                if held >= PIECE:
                    close()
        if ids:
            yield flush()
    close()
    if ids:
        yield flush()


def signatures(rows: DataFrame) -> DataFrame:
    """``conv_id, signature, gaps`` of every conversation of ``rows_of``."""
    trimmed = F.rtrim("text", F.lit(WHITE))
    last = F.right(trimmed, F.lit(1))
    own = F.when(trimmed == "", BLANK).when(last.isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    initial = F.left("role", F.lit(1))
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    equal = rows.groupBy(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "digest",
        place.alias("initial"), own.alias("fault"),
    ).agg(F.count(F.lit(1)).alias("n"))
    equal = stored(equal, "equal-rows")
    same = ["conv_id", "role", "digest"]
    # The struct is never null, so a null turn counts as the least.
    firsts = equal.groupBy(same).agg(F.min(F.struct("turn")).alias("least"), F.count(F.lit(1)).alias("turns"))
    firsts = firsts.filter("turns > 1").select(*[F.col(c).alias(f"first_{c}") for c in same], "least")
    matches = F.lit(True)
    for name in same:
        matches = matches & F.col(name).eqNullSafe(F.col(f"first_{name}"))
    marked = equal.join(firsts, matches, "left")
    repeats = F.col("least").isNotNull() & ~F.col("least.turn").eqNullSafe(F.col("turn"))
    first = F.when(repeats & (F.col("fault") != BLANK), DUPLICATE).otherwise(F.col("fault"))
    again = F.when(F.col("fault") == BLANK, BLANK).otherwise(DUPLICATE)
    order = ["conv_id", "turn", "role", "digest"]
    lettered = marked.select(*order, "n", _letter(first).alias("first"), _letter(again).alias("again"))
    ordered = lettered.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = ordered.select("conv_id", "first", "again", "n").mapInArrow(
        _pieces, "conv_id long, part int, place long, piece string"
    )
    joined = pieces.groupBy("conv_id").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("part", "place", "piece"))), lambda p: p["piece"]), ""
        ).alias("signature")
    )
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    gaps = equal.select("conv_id", "turn").distinct().groupBy("conv_id").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"))
    gaps = gaps.select(F.col("conv_id").alias("gaps_id"), "gaps")
    return joined.join(gaps, F.col("conv_id").eqNullSafe(F.col("gaps_id"))).select("conv_id", "signature", "gaps")


def _letter(fault: Column) -> Column:
    return F.char(F.lit(ord("A")) + 4 * F.col("initial") + fault)


def _audited(rows: DataFrame) -> DataFrame:
    found = stored(signatures(rows), "signatures")
    return found.join(solve(found), "signature").drop("signature")


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _passing(rows: DataFrame) -> DataFrame:
    """Every conversation's audit, then its rows in order, conversations dealt out by id."""
    audits = _audited(rows).select(
        "conv_id", F.lit(0).alias("section"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("string").alias("text"), "audit", *COUNTS,
    )
    nothing = [F.lit(None).cast("string").alias("audit"), *[F.lit(None).cast("long").alias(c) for c in COUNTS]]
    texts = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.lit(1).alias("section"), F.col("turn").cast("long"), "role",
        "digest", "text", *nothing,
    )
    order = ["conv_id", "section", "turn", "role", "digest"]
    passing = audits.unionByName(texts).repartition("conv_id").sortWithinPartitions(*order)
    return passing.select("conv_id", "section", "role", "text", "audit", *COUNTS)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(row, lines)``: with a conversation's first record its row, then lines ``(edit, role, text)`` one by one."""
    audit, at, state = "", 0, 0

    def inserts():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state, at = NEW[state], at + 1
            yield None, ("I", ROLE[state], "")

    for batch in slices(batches):
        for row in batch.to_pylist():
            if row["section"] == 0:
                yield from inserts()
                audit, at, state = row["audit"], 0, 0
                yield row, None
                continue
            yield from inserts()
            edit, at = audit[at], at + 1
            if edit == "D":
                continue
            state = KEEP[state][row["role"][:1]] if edit == "K" else NEW[state]
            yield None, (edit, row["role"] if edit == "K" else ROLE[state], row["text"])
    yield from inserts()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", *COUNTS, "audit"]
    done, row, running, lines = [], None, None, 0

    def close():
        if row is not None:
            done.append([*(row[c] for c in names), running.hexdigest()])

    def flush():
        columns = list(zip(*done, strict=True))
        done.clear()
        types = [pa.int64()] * (len(names) - 1) + [pa.string()] * 2
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[*names, "repaired_sha256"]
        )

    for head, line in _edited(batches):
        if head is not None:
            close()
            if len(done) >= 1024:
                yield flush()
            row, running, lines = head, hashlib.sha256(), 0
        else:
            running.update(("\n" if lines else "").encode() + f"{line[1]}:{line[2]}".encode())
            lines += 1
    close()
    if done:
        yield flush()


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done, owner, place = [], None, 0
    schema = pa.schema({"conv_id": pa.int64(), "place": pa.int64(), "role": pa.string(), "text": pa.string(), "edit": pa.string()})
    for head, line in _edited(batches):
        if head is not None:
            owner, place = head["conv_id"], 0
            continue
        place += 1
        done.append({"conv_id": owner, "place": place, "role": line[1], "text": line[2], "edit": line[0]})
        if len(done) >= 256:
            yield pa.RecordBatch.from_pylist(done, schema)
            done = []
    if done:
        yield pa.RecordBatch.from_pylist(done, schema)


def reports(conversations: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` per conversation.

    ``gaps``: missing turn numbers.  The digest is that of the repaired rows as ``role:text``, joined by line feeds.
    """
    schema = ", ".join(f"{c} long" for c in ("conv_id", *COUNTS)) + ", audit string, repaired_sha256 string"
    return _passing(rows_of(conversations)).mapInArrow(_digests, schema)


def repaired(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, role, text, edit``: the rows after the cheapest repair, with place from 1."""
    return _passing(rows_of(conversations)).mapInArrow(
        _lines, "conv_id long, place long, role string, text string, edit string"
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults, chosen by a checksum of ``conv_id:turn``; nulls count as one space.

    Of 20 remainders, 0 drops a row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats it, 4 makes it the user's.
    """
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", F.coalesce(F.col("role"), F.lit(" ")).alias("role"), text.alias("text"), kind.alias("kind"))
    rows = rows.filter("kind <> 0").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).alias("copies"),
    )
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies", "copy")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """``reports`` after ``damaged`` for every original ``conv_id``; without rows left: zeros and an empty text."""
    found = reports(damaged(conversations))
    ids = conversations.select(F.col("conv_id").cast("long").alias("asked_id")).distinct()
    joined = ids.join(found, F.col("asked_id").eqNullSafe(F.col("conv_id")), "left")
    return joined.select(
        F.col("asked_id").alias("conv_id"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
