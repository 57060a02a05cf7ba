"""MinHash near-duplicates: a multi-index Hamming join over b-bit signatures.

1. One pass over the texts gives every document its number of distinct 5-word shingles, a 128-bit digest of that set and
   a signature of 40 symbols of 16 bits (b-bit MinHash).  Documents with equal sets form one class; only classes go on,
   so thousands of copies cost one row.
2. The signature is split into 8 chunks of 5 symbols.  By the pigeonhole principle two signatures that differ in at
   most 15 symbols have a chunk with at most one error; all single errors of a chunk are enumerated by leaving out each
   symbol in turn, so every such pair shares one of 40 keys.  A pair at similarity 0.85 differs in 6 symbols on average
   and shares no key with probability 6e-7 (2.3e-5 at 0.80).
3. Within a key every member is first compared with two pivots (smallest and largest id): linear in the members, and
   groups of near copies collapse into one component.  Then members of one key in different components are compared, all
   of them, on a second signature of 512 symbols of 8 bits in numpy; only pairs below its distance limit leave the task,
   which drops a pair at the threshold with a probability below ``LONG_MISS``, 1e-7, besides.
   Keys with very many members are dealt out as pairs of blocks, so no task holds more than two blocks.
4. Candidates are confirmed on their full shingle sets, and links become components by star contraction.

Links inside one component that cannot change the result are not tested.  Null and empty texts and texts without words
have an empty set and no links.  Rows without an id are never linked and have no component.  Rows that share an id are
separate texts that any link of the id joins; ``keep_one`` keeps such an id if one of its rows is kept.  Repeated rows
have equal sets and one component.  Texts of any length are read whole.  Of equal or linked texts the smallest id stands
for all, so nothing depends on ties.  An empty table gives no rows.  Columns other than ``doc_id`` and ``text`` are not
read; ``keep_one`` returns them all, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilmark.operators.detect import components

from .scratch import fresh, stored
from .words import constants, groups, mix, shingles, slices, words

CHUNKS, CHUNK = 8, 5
SYMBOLS = CHUNKS * CHUNK
LONG_SYMBOLS = 512
#: Chance that two texts at the threshold differ in more of the long symbols than ``long_distance`` allows.
LONG_MISS = 1e-7
#: Members of one key that are compared in one task.
BLOCK = 4096
#: Links need 100 * intersection >= LINK * union, if no other threshold is given.
LINK = 85

_FACTORS, _ADDENDS = constants(LONG_SYMBOLS + SYMBOLS, 11), constants(LONG_SYMBOLS + SYMBOLS, 12)


def minima(hashes: np.ndarray, starts: np.ndarray, first: int, count: int) -> np.ndarray:
    """Scrambled minima of ``count`` permutations, from number ``first`` on, for the non-empty runs at ``starts``."""
    found = np.empty((len(starts), count), np.uint64)
    for k in range(count):
        found[:, k] = np.minimum.reduceat(hashes * _FACTORS[first + k] + _ADDENDS[first + k], starts)
    return mix(found)


def long_distance(link: int) -> int:
    """Long symbols that may differ: at similarity ``link / 100`` more do with a probability below ``LONG_MISS``."""
    p = (1 - link / 100) * (1 - 1 / 256)
    limit, tail = LONG_SYMBOLS, 0.0
    while limit > 0:
        tail += math.comb(LONG_SYMBOLS, limit) * p**limit * (1 - p) ** (LONG_SYMBOLS - limit)
        if tail >= LONG_MISS:
            break
        limit -= 1
    return limit


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        sizes, digests, symbols = [], [], []
        for _, group in groups(texts):
            runs = shingles(words(group))
            full = np.flatnonzero(runs.counts)
            short = np.zeros((len(group), SYMBOLS), "<u2")
            if len(full):
                short[full] = minima(runs.hashes, runs.bounds[full], 0, SYMBOLS) >> np.uint64(48)
            for i in range(len(group)):
                own = np.unique(runs.hashes[runs.bounds[i] : runs.bounds[i + 1]])
                sizes.append(len(own))
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                symbols.append(short[i].tobytes())
        columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(symbols, pa.binary())], ["doc_id", "n_shingles", "digest", "symbols"]
        )


def _details(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        ids, texts = batch.column("doc_id"), batch.column("text").cast(pa.binary()).to_pylist()
        for start, group in groups(texts):
            runs = shingles(words(group))
            full = np.flatnonzero(runs.counts)
            if not len(full):
                continue
            short = (minima(runs.hashes, runs.bounds[full], 0, SYMBOLS) >> np.uint64(48)).astype("<u2")
            longs = minima(runs.hashes, runs.bounds[full], SYMBOLS, LONG_SYMBOLS).astype(np.uint8)
            sets = [np.unique(runs.hashes[runs.bounds[i] : runs.bounds[i + 1]]).view(np.int64) for i in full]
            columns = [ids.take(pa.array(start + full)), pa.array(sets, pa.list_(pa.int64()))]
            columns += [pa.array([x.tobytes() for x in symbols]) for symbols in (short, longs)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "shingles", "symbols", "long"])


def _close_pairs(batches: Iterator[pa.RecordBatch], link: int = LINK) -> Iterator[pa.RecordBatch]:
    """Pairs of one cell (rows come sorted by cell) in different components whose long signatures are close.

    A pair shares several keys as a rule; only the cell of its first shared key gives it out.
    """

    def compare(rows: pa.Table) -> pa.RecordBatch:
        cell = rows.column("cell").to_numpy()
        ids, component = rows.column("id").to_numpy(), rows.column("component").to_numpy()
        side, place = rows.column("side").to_numpy(), rows.column("place").to_numpy()
        symbols = np.frombuffer(b"".join(rows.column("symbols").to_pylist()), "<u2").reshape(len(rows), CHUNKS, CHUNK)
        longs = np.frombuffer(b"".join(rows.column("long").to_pylist()), np.uint8).reshape(len(rows), LONG_SYMBOLS)
        low, high = [], []
        left = np.arange(len(rows))
        for shift in range(1, len(rows)):
            left = left[left + shift < len(rows)]
            left = left[cell[left] == cell[left + shift]]
            if not len(left):
                break
            # Within a block (side 0) all pairs count, between two blocks those with one member of each.
            across = (side[left] == 0) | (side[left] != side[left + shift])
            here = left[across & (component[left] != component[left + shift])]
            for part in np.array_split(here, len(here) // 4096 + 1):
                near = part[(longs[part] != longs[part + shift]).sum(1) <= limit]
                wrong = symbols[near] != symbols[near + shift]
                chunk = np.argmax(wrong.sum(2) <= 1, axis=1)
                gap = np.argmax(wrong[np.arange(len(near)), chunk], axis=1)
                near = near[chunk * CHUNK + gap == place[near]]
                low.append(np.minimum(ids[near], ids[near + shift]))
                high.append(np.maximum(ids[near], ids[near + shift]))
        pairs = np.unique(np.array([np.concatenate(low or [ids[:0]]), np.concatenate(high or [ids[:0]])]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    limit, rest = long_distance(link), None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        cells = rows.column("cell").to_numpy()
        cut = int(np.searchsorted(cells, cells[-1])) if len(cells) else 0
        if cut:
            yield compare(rows.slice(0, cut))
        rest = rows.slice(cut)
    if rest is not None and len(rest):
        yield compare(rest)


def _keys(nodes: DataFrame) -> DataFrame:
    """``(place, key, id)``: every chunk with every symbol left out in turn."""
    keys = []
    for chunk in range(CHUNKS):
        start = 2 * CHUNK * chunk + 1
        for gap in range(CHUNK):
            before = F.substring("symbols", start, 2 * gap)
            after = F.substring("symbols", start + 2 * (gap + 1), 2 * (CHUNK - gap - 1))
            keys.append(F.xxhash64(F.lit(chunk * CHUNK + gap), before, after))
    return nodes.select(F.posexplode(F.array(*keys)).alias("place", "key"), "id")


def _confirmed(pairs: DataFrame, details: DataFrame, link: int) -> DataFrame:
    """The pairs whose full shingle sets meet the threshold, as ``(src, dst)``."""
    a = details.select(F.col("id").alias("a"), F.col("shingles").alias("left"))
    b = details.select(F.col("id").alias("b"), F.col("shingles").alias("right"))
    common = F.size(F.array_intersect("left", "right"))
    sides = pairs.join(a, "a").join(b, "b").withColumn("common", common)
    linked = F.lit(100) * F.col("common") >= F.lit(link) * (F.size("left") + F.size("right") - F.col("common"))
    return sides.filter(linked).select(F.col("a").alias("src"), F.col("b").alias("dst"))


def _cells(members: DataFrame, labels: DataFrame, details: DataFrame) -> DataFrame:
    """Members of keys that still hold several components, a cell per key, or per pair of blocks of a large key."""
    labelled = members.join(labels, members.id == labels.node, "left").select(
        "place", "key", "id", F.coalesce("component", "id").alias("component")
    )
    open_keys = (
        labelled.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low <> high")
        .select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    other = F.explode(F.expr("sequence(0, blocks - 1)"))
    dealt = labelled.join(open_keys, "key").withColumn("own", own).withColumn("other", other)
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    cell = F.when(F.col("blocks") == 1, F.col("key")).otherwise(F.xxhash64("key", low, high))
    dealt = dealt.select(cell.alias("cell"), "place", "id", "component", side.cast("int").alias("side"))
    return dealt.join(details.select("id", "symbols", "long"), "id")


def near_duplicates(documents: DataFrame, link: int = LINK) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``documents`` (columns ``doc_id, text``).

    ``component_id`` is the smallest id linked to the document directly or through others, itself included;
    ``kept`` marks the document with that id.  Texts are linked from a similarity of ``link`` percent on.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(
        texts.mapInArrow(_signatures, "doc_id long, n_shingles long, digest binary, symbols binary"), "signatures"
    )
    usable = signed.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = stored(usable.groupBy("digest", "symbols").agg(F.min("doc_id").alias("id")), "classes")
    keys = _keys(classes)
    shared = keys.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first <> last")
    members = stored(keys.join(shared, "key"), "members")
    candidates = members.select(F.col("id").alias("doc_id")).distinct()
    details = stored(
        texts.join(candidates, "doc_id", "left_semi")
        .mapInArrow(_details, "id long, shingles array<bigint>, symbols binary, long binary")
        .dropDuplicates(["id", "long"]),
        "details",
    )
    pivots = members.select(F.col("first").alias("a"), F.col("id").alias("b")).unionByName(
        members.select(F.col("id").alias("a"), F.col("last").alias("b"))
    )
    first = stored(_confirmed(pivots.filter("a < b").distinct(), details, link), "links")
    cells = _cells(members, components(first), details)
    close = partial(_close_pairs, link=link)
    across = cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(close, "a long, b long")
    second = stored(_confirmed(across, details, link), "links")
    labels = components(first.unionByName(second))
    of_class = classes.join(labels, classes.id == labels.node, "left").select(
        "digest", F.coalesce("component", "id").alias("component")
    )
    return signed.join(of_class, "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        F.expr("doc_id <=> if(doc_id IS NULL, NULL, coalesce(component, doc_id))").alias("kept"),
    )


def keep_one(documents: DataFrame, link: int = LINK) -> DataFrame:
    """The rows of ``documents`` whose id stays: one document of each group of near copies, all columns."""
    (own,) = fresh(documents.columns, "near_dup_id")
    kept = near_duplicates(documents, link).filter("kept").select(F.col("doc_id").alias(own)).distinct()
    return documents.join(kept, F.col("doc_id").eqNullSafe(F.col(own)), "left_semi")
