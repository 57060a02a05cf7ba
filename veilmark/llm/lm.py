"""Language-model scores: bigram counts of the whole corpus, an Elias-Fano trie, whole texts scored in place.

The model is absolute discounting with interpolation: after context c, word w has the probability
``(n(c, w) - D) / n(c) + L(c) * u(w)`` with ``L(c) = D * successors(c) / n(c)`` and the add-one unigram probability u; a
pair that was not seen has the second part only, and a context that was not seen has L = 1.

1. Tasks count the words of the training documents, Spark adds the counts up.  All words keep their exact counts in a
   table; the ``VOCABULARY`` most frequent ones get a rank.
2. Tasks count all pairs, packed by shard of the pair's hash, so a frequent pair costs one entry per task; every shard is
   added up by itself.  The trie takes the ``PAIRS`` most frequent pairs of ranked words; the other pairs of ranked words
   stay in their shards, pairs with a word without a rank in a table.  The two sizes bound what is broadcast and what one
   task builds; they decide where a pair is looked up, not what is scored: results do not depend on them but for the
   quantisation of probabilities to one byte.
3. A pass over all texts maps the trie into memory and adds up each document's probabilities.  A pair that is not in the
   trie is asked of its shard unless the trie holds all successors of its context.  Questions travel packed to the
   shards, which hold the same Elias-Fano level for their own pairs, and sums of documents travel back.  Words without a
   rank and pairs with such a word leave as rows, by their 64-bit hashes, and are joined with the tables.  A word is as
   often a context in its document as it is a word, so one row stands for both.

Tokens are the words in lower case and one end per document, which is also the context of the first word.  Null text is
empty: its only token is the end.  Without training documents every probability is one.  Repeated rows count as
documents of their own; a row without an id is a training document.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import held_out
from .scratch import stored
from .trie import DISCOUNT, Level, Trie, build
from .words import constants, groups, mix, slices, words

#: Words and pairs in the trie, and pairs that a task gathers before it passes them on.
VOCABULARY, PAIRS, GATHER = 1 << 19, 1 << 22, 1 << 22
#: Training tokens per shard of the pair counts, and rows whose sums come back to one task.
SHARD_TOKENS, BLOCK_BITS = 1 << 21, 10
#: Ranks whose successors are added up together.
RANKS = 1 << 13
#: Sums of logarithms travel as integers, so their order does not matter.
UNIT = float(1 << 24)
#: Word hashes have the top bit, so that as signed numbers they are negative and ranks are not.
TOP = np.uint64(1 << 63)
END = constants(1, 40)[0] | TOP


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a group with an end after every text, and each text's first place."""
    found = words(texts)
    bounds = found.bounds + np.arange(len(found.bounds))
    tokens = np.full(bounds[-1], END, np.uint64)
    inside = np.ones(len(tokens), bool)
    inside[bounds[1:] - 1] = False
    tokens[inside] = found.hashes | TOP
    return tokens, bounds


def _before(ranks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rank or hash of the token before each; a text's first token follows an end, as its last token is one."""
    context = np.roll(ranks, 1)
    context[bounds[:-1]] = ranks[-1]
    return context


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def counted(parts: list[np.ndarray]) -> pa.RecordBatch:
        word, n = np.unique(np.concatenate(parts), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], ["word", "n"])

    parts, size = [], 0
    for batch in slices(batches):
        for _, group in groups(_texts(batch)):
            parts.append(_tokens(group)[0])
            size += len(parts[-1])
            if size >= GATHER:
                yield counted(parts)
                parts, size = [], 0
    if parts:
        yield counted(parts)


def _vocabulary(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of the most frequent words."""
    least = _threshold(counts.select("n", F.lit(1).alias("of")), VOCABULARY)
    found = counts.filter(F.col("n") >= least).toArrow()
    hashes = found.column("word").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], found.column("n").to_numpy()[order]


def _threshold(counts: DataFrame, capacity: int) -> int:
    """Smallest count so that at most ``capacity`` things (``of`` per row) have it; counts above 64 go in steps."""
    step = F.when(F.col("n") <= 64, F.col("n")).otherwise(F.ceil(F.pow(2.0, F.ceil(F.log2("n") * 8) / 8 - 0.125)))
    histogram = counts.groupBy(step.cast("long").alias("step")).agg(F.sum("of").alias("of")).collect()
    least, room = 1 << 62, capacity
    for row in sorted(histogram, reverse=True):
        room -= row.of
        if room < 0:
            break
        least = row.step
    return least


def _planes(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit integers, bytes of equal weight together, compressed."""
    raw = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _columns(blob: bytes, n: int) -> list[np.ndarray]:
    """The ``n`` columns of a blob of :func:`_planes`."""
    raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(n, 8, -1)
    return [np.ascontiguousarray(p.T).view(np.int64).ravel() for p in planes]


def _packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as differences, and their counts."""
    return _planes(np.diff(keys, prepend=0), counts)


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, times = _columns(blob, 2)
    return np.cumsum(steps), times


def _named_pairs(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts, words and counts of the rest of a shard."""
    steps, word, times = _columns(blob, 3)
    return np.cumsum(steps), word, times


def _tallied(keys: list[np.ndarray], times: np.ndarray) -> list[np.ndarray]:
    """Distinct rows of the key columns, sorted, and the sums of their times."""
    order = np.lexsort(keys[::-1])
    keys, times = [k[order] for k in keys], times[order]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(new)
    return [*(k[first] for k in keys), np.add.reduceat(times, first) if len(first) else times]


def _ranks(hashes: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Ranks of word hashes, -1 for words without one."""
    if not len(hashes):
        return np.full(len(tokens), -1)
    place = np.minimum(np.searchsorted(hashes, tokens), len(hashes) - 1)
    return np.where(hashes[place] == tokens, place, -1)


def _named(ranks: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The rank of a word that has one, the hash of another."""
    return np.where(ranks >= 0, ranks, tokens.view(np.int64))


def _both(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One hash for the names of two words."""
    return mix(context.view(np.uint64) + mix(word.view(np.uint64))).view(np.int64)


def _shard(pairs: np.ndarray, shards: int) -> np.ndarray:
    return mix(pairs.astype(np.uint64)) % np.uint64(shards)


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Every shard that occurs, with the places of its elements."""
    order = np.argsort(shard, kind="stable")
    found, starts = np.unique(shard[order], return_index=True)
    return zip(found.tolist(), np.split(order, starts[1:]), strict=True) if len(order) else iter(())


def _pair_counts(vocabulary, shards: int):
    """Pairs of ranked words as ``context * V + word``, the rest as two names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = vocabulary.value

        def dealt(parts: list[np.ndarray], rare: list[np.ndarray]) -> pa.RecordBatch:
            pair, n = np.unique(np.concatenate(parts), return_counts=True)
            rows = [(s, _packed(pair[o], n[o]), None) for s, o in _by_shard(_shard(pair, shards))]
            both = np.concatenate(rare, axis=1)
            first, second, n = _tallied([both[0], both[1]], np.ones(both.shape[1], np.int64))
            shard = _shard(_both(first, second), shards)
            rows += [(s, None, _planes(np.diff(first[o], prepend=0), second[o], n[o])) for s, o in _by_shard(shard)]
            own, pairs, rest = zip(*rows, strict=True)
            columns = [pa.array(own, pa.int64()), pa.array(pairs, pa.binary()), pa.array(rest, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["shard", "pairs", "rest"])

        parts, rare, size = [], [], 0
        for batch in slices(batches):
            for _, group in groups(_texts(batch)):
                tokens, bounds = _tokens(group)
                word = _ranks(hashes, tokens)
                before = _before(word, bounds)
                both = (word >= 0) & (before >= 0)
                parts.append(before[both] * len(hashes) + word[both])
                named = _named(word, tokens)
                rare.append(np.stack([_before(named, bounds)[~both], named[~both]]))
                size += len(tokens)
                if size >= GATHER:
                    yield dealt(parts, rare)
                    parts, rare, size = [], [], 0
        if parts:
            yield dealt(parts, rare)

    return run


def _added(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, time = _tallied([np.concatenate(keys)], np.concatenate(times))
    return key, time


def _merged(shard: pa.Table) -> pa.Table:
    """All counts of a shard added up: a row per count with the pairs of ranked words, and one row with the rest."""
    found = [_unpacked(b) for b in shard.column("pairs").drop_null().to_pylist()]
    rest = [_named_pairs(b) for b in shard.column("rest").drop_null().to_pylist()]
    own_shard = shard.column("shard")[0].as_py()
    rows = []
    if found:
        key, time = _added(*map(list, zip(*found, strict=True)))
        for n in np.unique(time):
            own = time == n
            rows.append((int(n), int(own.sum()), _packed(key[own], time[own]), None))
    if rest:
        first, second, n = (np.concatenate(c) for c in zip(*rest, strict=True))
        first, second, n = _tallied([first, second], n)
        rows.append((None, None, None, _planes(np.diff(first, prepend=0), second, n)))
    n, of, pairs, rest = zip(*rows, strict=True)
    kinds = {"n": (n, pa.int64()), "of": (of, pa.int64()), "pairs": (pairs, pa.binary()), "rest": (rest, pa.binary())}
    columns = {name: pa.array(values, kind) for name, (values, kind) in kinds.items()}
    return pa.table({"shard": pa.array([own_shard] * len(rows), pa.int64()), **columns})


def _successor_counts(vocabulary):
    """Successors of ranked contexts as blocks of ranks, one set a task; those of other contexts as rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["block", "ranked", "context", "d"]
        hashes = vocabulary.value
        total = np.zeros(len(hashes), np.int64)
        for batch in batches:
            for pairs, rest in zip(batch.column("pairs").to_pylist(), batch.column("rest").to_pylist(), strict=True):
                if rest is None:
                    total += np.bincount(_unpacked(pairs)[0] // len(hashes), minlength=len(hashes))
                    continue
                contexts = _named_pairs(rest)[0]
                total += np.bincount(contexts[contexts >= 0], minlength=len(hashes))
                found, d = np.unique(contexts[contexts < 0], return_counts=True)
                none = [pa.nulls(len(found), pa.int64()), pa.nulls(len(found), pa.binary())]
                yield pa.RecordBatch.from_arrays([*none, pa.array(found), pa.array(d)], names)
        blocks = [b for b in range(0, len(hashes), RANKS) if total[b : b + RANKS].any()]
        packed = pa.array([_planes(total[b : b + RANKS]) for b in blocks], pa.binary())
        none = [pa.nulls(len(blocks), pa.int64())] * 2
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), packed, *none], names)

    return run


def _block_sums(vocabulary):
    def run(block: pa.Table) -> pa.Table:
        first = block.column("block")[0].as_py()
        hashes = vocabulary.value[first : first + RANKS].view(np.int64)
        total = np.zeros(len(hashes), np.int64)
        for blob in block.column("ranked").to_pylist():
            total += _columns(blob, 1)[0]
        return pa.table({"context": hashes, "d": total})

    return run


def _rest_rows(counts, successors, denominator: float):
    """``pair, part, context, word`` of pairs with an unranked word; ranked ones are null and divide ``part`` already.

    The gain of a pair is log10 of one and ``(n - D) / (D * d(context) * u(word))``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, d = counts.value, successors.value
        for batch in batches:
            for blob in batch.column("rest").to_pylist():
                context, word, times = _named_pairs(blob)
                first, second = context >= 0, word >= 0
                part = (times - DISCOUNT) * denominator / DISCOUNT
                part[first] /= d[context[first]]
                part[second] /= n[word[second]] + 1.0
                columns = [pa.array(_both(context, word)), pa.array(part.astype(np.float32))]
                columns += [pa.array(context, mask=first), pa.array(word, mask=second)]
                yield pa.RecordBatch.from_arrays(columns, ["pair", "part", "context", "word"])

    return run


def _looked_up(counts, successors, denominator: float):
    """Sums of what the pairs of a shard give to the rows that asked, a blob for each block of rows."""

    def run(asked: pa.Table, tail: pa.Table) -> pa.Table:
        keys, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for blob in tail.column("pairs").to_pylist():
            key, time = _unpacked(blob)
            keys.append(key)
            times.append(time)
        key, time = _added(keys, times)
        n, d = counts.value, successors.value
        context, word = key // max(len(n), 1), key % max(len(n), 1)
        gain = np.log10(1 + (time - DISCOUNT) * denominator / (DISCOUNT * d[context] * (n[word] + 1.0)))
        level = Level(len(n), key, gain)
        rows, sums = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for first, blob in zip(asked.column("row").to_pylist(), asked.column("asked").to_pylist(), strict=True):
            steps, row, time = _columns(blob, 3)
            value, found = level.values(np.cumsum(steps))
            row, value = _tallied([row[found]], np.rint(value[found] * time[found] * UNIT).astype(np.int64))
            rows.append(row + first)
            sums.append(value)
        row, value = _tallied([np.concatenate(rows)], np.concatenate(sums))
        blocks = list(_by_shard(row >> BLOCK_BITS))
        packed = [_packed(row[o], value[o]) for _, o in blocks]
        return pa.table({"block": pa.array([b for b, _ in blocks], pa.int64()), "sums": pa.array(packed, pa.binary())})

    return run


def _summed(block: pa.Table) -> pa.Table:
    row, value = _added(*map(list, zip(*(_unpacked(b) for b in block.column("sums").to_pylist()), strict=True)))
    return pa.table({"row": row, "more": value / UNIT})


def _built(hashes, counts, successors, total: int, distinct: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for batch in batches:
            for blob in batch.column("pairs").to_pylist():
                key, time = _unpacked(blob)
                keys.append(key)
                times.append(time)
        model = build(hashes.value, counts.value, total, distinct, *_added(keys, times), successors.value)
        yield pa.RecordBatch.from_pydict({"trie": [model]})

    return run


@dataclass
class Model:
    """A trained model.

    ``words``: all words as ``word, n, d`` (count and number of successors).  ``tail``: the pairs of ranked words outside
    the trie, packed, as ``shard, pairs``.  ``pairs``: those with a word without a rank as ``pair, gain``, log10 of how far
    the pair's probability is above its backoff.  ``counts`` and ``successors`` belong to the ranks.
    """

    trie: bytes
    words: DataFrame
    tail: DataFrame
    pairs: DataFrame
    shards: int
    counts: Broadcast
    successors: Broadcast


def trained(documents: DataFrame) -> Model:
    """The model of a corpus (``text``)."""
    context = documents.sparkSession.sparkContext
    counts = documents.mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = stored(counts, "words")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    hashes, times = _vocabulary(counts)
    shared, shared_times = context.broadcast(hashes), context.broadcast(times)
    shards = max(16, -(-total // SHARD_TOKENS))
    pairs = documents.mapInArrow(_pair_counts(shared, shards), "shard long, pairs binary, rest binary")
    merged = pairs.groupBy("shard").applyInArrow(_merged, "shard long, n long, of long, pairs binary, rest binary")
    merged = stored(merged, "pairs")
    least = _threshold(merged.filter("n IS NOT NULL").select("n", "of"), PAIRS)

    found = merged.select("pairs", "rest").mapInArrow(
        _successor_counts(shared), "block long, ranked binary, context long, d long"
    )
    found = stored(found, "successors")
    ranked = found.filter("block IS NOT NULL").select("block", "ranked").groupBy("block")
    other = found.filter("context IS NOT NULL").groupBy("context").agg(F.sum("d").alias("d"))
    successors = ranked.applyInArrow(_block_sums(shared), "context long, d long").unionByName(other)
    successors = successors.withColumnRenamed("context", "word")
    table = stored(counts.join(successors, "word", "left").select("word", "n", F.coalesce("d", F.lit(0)).alias("d")), "model")
    # The words with a rank, whose number is bounded, in the order of their ranks.
    ranked = table.filter(F.col("n") >= int(times.min())).select("word", "d").toArrow() if len(times) else None
    own = np.zeros(0, np.int64)
    if ranked is not None:
        own = ranked.column("d").to_numpy()[np.argsort(ranked.column("word").to_numpy().view(np.uint64))]
    # PAIRS bounds what this one task gathers.
    chosen = merged.filter(F.col("n") >= least).select("pairs").repartition(1)
    own = context.broadcast(own)
    trie = chosen.mapInArrow(_built(shared, shared_times, own, total, distinct), "trie binary").first()
    none = np.zeros(0, np.int64)
    trie = build(hashes, times, total, distinct, none, none, own.value) if trie is None else bytes(trie.trie)

    rest = merged.filter("n IS NULL").select("rest")
    rest = rest.mapInArrow(
        _rest_rows(shared_times, own, total + distinct + 1.0), "pair long, part float, context long, word long"
    )
    as_word = table.select("word", (F.col("n") + 1.0).alias("by"))
    key = F.coalesce("word", "context").alias("word")
    one = rest.filter("context IS NULL OR word IS NULL").select("pair", "part", key, F.col("word").isNotNull().alias("is_word"))
    one = one.join(table, "word").select("pair", (F.col("part") / F.when(F.col("is_word"), F.col("n") + 1).otherwise(F.col("d"))).alias("part"))
    two = rest.filter("context IS NOT NULL AND word IS NOT NULL").join(as_word, "word")
    two = two.select("pair", "context", (F.col("part") / F.col("by")).alias("part"))
    two = two.join(table.select(F.col("word").alias("context"), "d"), "context")
    rest = one.unionByName(two.select("pair", (F.col("part") / F.col("d")).alias("part")))
    rest = rest.select("pair", F.log10(1 + F.col("part")).cast("float").alias("gain"))
    tail = merged.filter(F.col("n") < least).select("shard", "pairs")
    return Model(trie, table, tail, rest, shards, shared_times, own)


def _scores(trie, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The levels are mapped from a file without a name, which goes with the task.
        file = tempfile.TemporaryFile()
        file.write(trie.value)
        file.flush()
        model = Trie(mmap.mmap(file.fileno(), 0, prot=mmap.PROT_READ))
        total, distinct = model.totals.tolist()
        base = np.log10((model.counts + 1.0) / (total + distinct + 1.0))
        row = TaskContext.get().partitionId() << 40
        types = [("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64())]
        types += [("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())]
        types += [("pair", pa.int64()), ("word", pa.int64()), ("times", pa.int64())]
        types += [("shard", pa.int64()), ("asked", pa.binary())]

        def table(**columns) -> pa.RecordBatch:
            n = max(map(len, columns.values()))
            arrays = [pa.array(columns[c], t) if columns.get(c) is not None else pa.nulls(n, t) for c, t in types]
            return pa.RecordBatch.from_arrays(arrays, [name for name, _ in types])

        def dealt(pairs: list[np.ndarray], rows: list[np.ndarray]) -> pa.RecordBatch:
            rows = np.concatenate(rows)
            first = rows[0]
            pair, asking, times = _tallied([np.concatenate(pairs), rows - first], np.ones(len(rows), np.int64))
            parts = list(_by_shard(_shard(pair, shards)))
            blobs = [_planes(np.diff(pair[o], prepend=0), asking[o], times[o]) for _, o in parts]
            return table(row=np.full(len(parts), first), shard=np.array([s for s, _ in parts]), asked=blobs)

        pairs, asking, size = [], [], 0
        for batch in slices(batches):
            ids, out = batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist()
            for start, group in groups(_texts(batch)):
                tokens, bounds = _tokens(group)
                word = model.words(tokens)
                before = _before(word, bounds)
                known = word >= 0
                ranked = before >= 0
                after, found = model.bigrams(before, word)
                unigram = np.where(known, model.unigram[word], 0) if len(base) else np.zeros(len(word))
                backoff = np.where(ranked, model.backoff[before], 0) if len(base) else np.zeros(len(word))
                score = np.where(found, after, unigram + backoff)
                plain = np.where(known, base[word], 0) if len(base) else np.zeros(len(word))
                sums = [np.add.reduceat(x, bounds[:-1]) for x in (known.astype(np.int64), plain, score)]
                stop = start + len(group)
                rows = row + np.arange(start, stop)
                documents = {"doc_id": ids[start:stop], "held_out": out[start:stop], "n_tokens": np.diff(bounds)}
                yield table(row=rows, **documents, n_known=sums[0], base=sums[1], score=sums[2])
                outside = ~found & ~ranked
                if len(base):
                    outside |= ~found & ranked & ~model.complete[before]
                text = np.repeat(np.arange(len(group)), np.diff(bounds))
                here = outside & ranked & known
                if here.any():
                    pairs.append(before[here] * len(base) + word[here])
                    asking.append(rows[text[here]])
                    size += len(pairs[-1])
                if size >= GATHER // 2:
                    yield dealt(pairs, asking)
                    pairs, asking, size = [], [], 0
                here = outside & ~(ranked & known)
                named = _named(word, tokens)
                both = _both(_before(named, bounds)[here], named[here])
                for name, there, keys in (("pair", here, both), ("word", ~known, tokens[~known].view(np.int64))):
                    if len(keys):
                        document, key, times = _tallied([text[there], keys], np.ones(len(keys), np.int64))
                        yield table(row=rows[document], times=times, **{name: key})
            row += len(batch)
        if pairs:
            yield dealt(pairs, asking)

    return run


def scored(documents: DataFrame, training: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``documents``.

    ``training`` has the texts to learn from; ``held_out`` is taken over from ``documents``.
    """
    model = trained(training)
    total, distinct = Trie(model.trie).totals.tolist()
    shared = documents.sparkSession.sparkContext.broadcast(model.trie)
    schema = (
        "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, "
        "pair long, word long, times long, shard long, asked binary"
    )
    scores = documents.select("doc_id", "held_out", "text").mapInArrow(_scores(shared, model.shards), schema)
    rows = stored(scores, "scores")
    unigram = F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(float(total + distinct + 1)))
    backoff = F.when(F.col("n").isNotNull(), F.log10(DISCOUNT * F.col("d") / F.col("n"))).otherwise(0.0)
    single = rows.filter("word IS NOT NULL").select("row", "word", "times").join(model.words, "word", "left")
    single = single.select(
        "row",
        F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0).alias("more_known"),
        (unigram * F.col("times")).alias("more_base"),
        ((unigram + backoff) * F.col("times")).alias("more"),
    )
    double = rows.filter("pair IS NOT NULL").select("row", "pair", "times").join(model.pairs, "pair").select(
        "row",
        F.lit(0).cast("long").alias("more_known"),
        F.lit(0.0).alias("more_base"),
        (F.col("gain") * F.col("times")).alias("more"),
    )
    asked = rows.filter("shard IS NOT NULL").select("shard", "row", "asked").groupBy("shard")
    find = _looked_up(model.counts, model.successors, total + distinct + 1.0)
    sums = asked.cogroup(model.tail.groupBy("shard")).applyInArrow(find, "block long, sums binary")
    sums = sums.groupBy("block").applyInArrow(_summed, "row long, more double")
    sums = sums.select("row", F.lit(0).cast("long").alias("more_known"), F.lit(0.0).alias("more_base"), "more")
    rest = single.unionByName(double).unionByName(sums).groupBy(F.col("row").alias("of_row"))
    rest = rest.agg(*(F.sum(c).alias(c) for c in ("more_known", "more_base", "more")))
    whole = rows.filter("n_tokens IS NOT NULL").join(rest, F.col("row") == F.col("of_row"), "left")
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"),
    )


def corpus_scores(documents: DataFrame) -> DataFrame:
    """Scores of all documents by a model of those whose id's crc32 modulo 7 is not 2."""
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id"), 7, 2).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    return scored(rows, rows.filter("NOT held_out").select("text"))
