"""Pack token sequences by dot-product vector bin packing, inside the tasks that read the texts: no shuffle.

A document's ids are cut into items of at most one sequence.  Items gather in a window; then one sequence after the
other is filled: among the items that fit the room left in tokens, segments and loss-bearing tokens, the one whose
demand has the largest dot product with that room goes in.  A gap that no item fits is filled with the head of the
largest item left, whose tail stays an item.  Items left in a window go on to the next one, so a task holds one window,
and only the last sequence of a partition can be short.

Null and empty texts have the end id alone; an empty table gives no rows.  A null id stays null.  Repeated rows are
packed like any others.  Texts of any length are encoded whole, runs of white space of any length included.  Items that
score alike go in the order they came.  Columns other than ``doc_id``, ``text`` and the given prompt are not read.  For
the same files and the same read settings, reruns and retried tasks give the same sequences.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import slices

#: Limits of a sequence: tokens, segments, loss-bearing tokens.
TOKENS, SEGMENTS, LOSS = 2048, 256, 2048
#: Items packed together in a task, and the smallest gap that is filled by cutting an item.
WINDOW, LEAST_GAP = 2048, 8
END = 1
VOCABULARY = "byte_bpe_50k.json"
#: White space as the tokenizer's pattern knows it.  The pattern looks back over a run of it, which fails for long runs,
#: so runs from this length on are cut out first.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = re.compile(f"[{SPACE}]{{1000,}}")


def encoder(path: str | None = None):
    """Byte-level BPE from a tokenizer file of the ``tokenizers`` library, run by the faster of the two libraries."""
    import tiktoken

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    # The file writes a byte as a printable character: itself where printable, else the next one from U+0100 on.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}
    special = {t["content"]: t["id"] for t in model["added_tokens"] if t["special"]}
    ranks = {bytes(byte[c] for c in w): i for w, i in model["model"]["vocab"].items() if w not in special}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def encode(encoding, text: str) -> list[int]:
    """Ids of a text of any length.

    In the tokenizer's pattern a run of white space is one piece, but for its last character where a word follows.
    """
    ids, at = [], 0
    for run in LONG_RUN.finditer(text):
        start, end = run.span()
        followed = end < len(text) and not text.startswith(tuple(encoding.special_tokens_set), end)
        ids += encoding.encode(text[at:start], allowed_special="all")
        at = end - followed
        ids += encoding._encode_single_piece(text[start:at].encode())
    return ids + encoding.encode(text[at:], allowed_special="all")


class Packer:
    """Fills sequences from the items it is given."""

    def __init__(self, limits: tuple[int, int, int]):
        self.limits = np.array(limits, float)
        self.items: list[tuple] = []  # document, start, length, first loss-bearing place
        self.sequence = 0

    def demand(self, start: int, length: int, free: int) -> tuple[int, int, int]:
        """Tokens, segments and loss-bearing tokens of a piece; the first ``free`` ids of a document bear no loss."""
        return length, 1, max(0, start + length - max(start, free))

    def add(self, document, total: int, free: int) -> Iterator[tuple]:
        """Cut a document into items; whole sequences are handed out at once."""
        start, tokens, loss = 0, int(self.limits[0]), int(self.limits[2])
        while start < total:
            length = min(tokens, total - start, max(0, free - start) + loss)
            if length == tokens:
                yield document, start, length, self.sequence, 0
                self.sequence += 1
            else:
                self.items.append((document, start, length, free))
            start += length

    def pack(self, keep: int) -> Iterator[tuple]:
        """Fill sequences until ``keep`` items or fewer are left."""
        items, self.items = self.items, []
        size = np.array([self.demand(*i[1:]) for i in items], float).reshape(-1, 3) / self.limits
        open_ = np.ones(len(items), bool)
        left = len(items)
        least = 1e-9
        while left > keep:
            room, offset = np.ones(3), 0
            while left:
                # Scores of items that don't fit, or are placed, are below any other.
                fits = open_ & (size <= room + least).all(1)
                best = int(np.argmax(np.where(fits, size @ room, -1.0)))
                if not fits[best]:
                    break
                document, start, length, _ = items[best]
                yield document, start, length, self.sequence, offset
                offset += length
                room = room - size[best]
                open_[best] = False
                left -= 1
            gap = int(round(room[0] * self.limits[0]))
            if left and gap >= LEAST_GAP and room[1] > least:
                largest = int(np.argmax(np.where(open_, size[:, 0], -1.0)))
                document, start, length, free = items[largest]
                bearing = int(round(room[2] * self.limits[2]))
                head = min(gap, length - 1, max(0, free - start) + bearing)
                if head > 0:
                    yield document, start, head, self.sequence, offset
                    items[largest] = (document, start + head, length - head, free)
                    size[largest] = np.array(self.demand(*items[largest][1:])) / self.limits
            self.sequence += 1
        self.items = [items[i] for i in np.flatnonzero(open_)]


def _packed(limits: tuple[int, int, int], path: str | None, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, packer = encoder(path), Packer(limits)
        base = TaskContext.get().partitionId() << 32

        def table(pieces: list[tuple]) -> pa.RecordBatch:
            documents = [p[0] for p in pieces]
            ids = [d[1][s : s + n] for d, s, n, _, _ in pieces]
            columns = {
                "doc_id": pa.array([d[0] for d in documents], pa.int64()),
                "start": pa.array([p[1] for p in pieces], pa.int64()),
                "length": pa.array([p[2] for p in pieces], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(i.tobytes()) for i in ids], pa.int64()),
                "doc_tokens": pa.array([len(d[1]) for d in documents], pa.int64()),
                "sequence_id": pa.array([base + p[3] for p in pieces], pa.int64()),
                "offset": pa.array([p[4] for p in pieces], pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array([i.view("<i4") for i in ids], pa.list_(pa.int32()))
            return pa.RecordBatch.from_pydict(columns)

        pieces: list[tuple] = []
        for batch in slices(batches):
            texts, prompts = batch.column("text").to_pylist(), batch.column("prompt").to_pylist()
            for doc_id, text, prompt in zip(batch.column("doc_id").to_pylist(), texts, prompts, strict=True):
                before = encode(encoding, prompt) if prompt else []
                ids = np.array([*before, *encode(encoding, text or ""), END], "<u4")
                pieces += packer.add((doc_id, ids), len(ids), len(before))
                if len(packer.items) >= WINDOW:
                    pieces += packer.pack(WINDOW // 8)
                if len(pieces) >= WINDOW // 4:
                    yield table(pieces)
                    pieces = []
        pieces += packer.pack(0)
        if pieces:
            yield table(pieces)

    return run


def pack(
    documents: DataFrame,
    limits: tuple[int, int, int] = (TOKENS, SEGMENTS, LOSS),
    prompt: Column | None = None,
    tokenizer: str | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """A row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and its ``ids``.

    ``prompt`` is text before ``text`` whose tokens bear no loss (instruction data).  ``tokenizer`` is a file that every
    executor can open, by default the installed public vocabulary.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        (F.lit(None) if prompt is None else prompt).cast("string").alias("prompt"),
    )
    schema = (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
        + ", ids array<int>" * with_ids
    )
    return rows.mapInArrow(_packed(limits, tokenizer, with_ids), schema)
