"""Exact top-k inner products by a three-phase uniform threshold over lists of partial scores.

A vector's components are cut into ``LISTS`` groups; list j of a query holds every vector's partial score over group j.
Vectors lie in blocks of rows, queries in blocks of their own, and every pair of blocks is one cell that Spark deals out
by key.

1. Each cell gathers the k best entries of every list and adds up those vectors' lists; the k-th best sum over all cells
   of a query is a safe cutoff: at least k vectors reach it.
2. The cutoff goes back to all cells of the query.  A vector that reaches it has, in one list at least, an entry of
   cutoff / LISTS or more; each list gives all such entries, and a vector whose entries plus that share for the lists it
   is missing from stay below the cutoff is dropped.
3. The missing entries of the vectors left are looked up, so their scores are exact; the best k per query remain.

Components are floor(256 * x), with x as double.  Null vectors, vectors with null or non-finite components and rows
without an id take no part; shorter vectors count as padded with zeros.  Rows that repeat an id and its vector count
once, and no candidate has the query's own id.  Vectors so large that a score might not fit a long raise an error.  Of
equal scores the smaller id comes first.  An empty table, or one without queries, gives no rows.  Columns other than
``vec_id`` and ``embedding`` are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import stored

K = 5
LISTS = 4
#: Rows of a block of vectors and of a block of queries, and queries scored at once in a task.
VECTORS, QUERIES, AT_ONCE = 2048, 4096, 256


def _matrix(rows: pa.Table, width: int) -> np.ndarray:
    found = np.zeros((len(rows), width))
    for i, row in enumerate(rows.column("vector").to_pylist()):
        found[i, : len(row)] = row
    # Doubles add up exactly below 2**53; larger components go on as long integers.
    return found if np.abs(found).max(initial=0) < 2**20 else found.astype(np.int64)


def _cells(queries: pa.Table, vectors: pa.Table):
    """Per part of a cell's queries: ids, partial scores (lists x queries x vectors), cutoffs; and the vectors' ids."""
    width = max((len(v) for t in (queries, vectors) for v in t.column("vector").to_pylist()), default=0)
    left, right = _matrix(queries, width), _matrix(vectors, width)
    if width * float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) >= 2**62:
        raise OverflowError("an inner product may not fit a long")
    ids, own = vectors.column("vec_id").to_numpy(), queries.column("vec_id").to_numpy()
    edges = np.linspace(0, width, LISTS + 1).astype(int)
    for start in range(0, len(own), AT_ONCE):
        part = slice(start, start + AT_ONCE)
        scores = np.stack([left[part, a:b] @ right[:, a:b].T for a, b in zip(edges, edges[1:], strict=False)])
        yield part, own[part], scores, ids


def _gather(k: int):
    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        query, best = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(queries) and len(vectors):
            for _, own, scores, ids in _cells(queries, vectors):
                total = scores.sum(0)
                same = own[:, None] == ids
                seen = np.zeros(same.shape, bool)
                for partial in scores:
                    partial = np.where(same, np.iinfo(np.int64).min / 4, partial)
                    top = np.argpartition(-partial, min(k, len(ids)) - 1, axis=1)[:, :k]
                    np.put_along_axis(seen, top, True, 1)
                rows, columns = np.nonzero(seen & ~same)
                query.append(own[rows])
                best.append(total[rows, columns].astype(np.int64))
        return pa.table({"query_id": np.concatenate(query), "score": np.concatenate(best)})

    return run


def _resolve(queries: pa.Table, vectors: pa.Table) -> pa.Table:
    query, vector, score = ([np.zeros(0, np.int64)] for _ in range(3))
    if len(queries) and len(vectors):
        cutoffs = queries.column("cutoff").to_pylist()
        for part, own, scores, ids in _cells(queries, vectors):
            # Without k candidates there is no cutoff, and every vector counts.
            cutoff = np.array([np.iinfo(np.int64).min / 4 if c is None else c for c in cutoffs[part]], float)[:, None]
            share = cutoff / LISTS
            listed = scores >= share
            bound = np.where(listed, scores, share).sum(0)
            sufficient = listed.any(0) & (bound >= cutoff) & (own[:, None] != ids)
            rows, columns = np.nonzero(sufficient)
            exact = scores[:, rows, columns].sum(0)
            enough = exact >= cutoff[rows, 0]
            query.append(own[rows[enough]])
            vector.append(ids[columns[enough]])
            score.append(exact[enough].astype(np.int64))
    return pa.table(
        {"query_id": np.concatenate(query), "vec_id": np.concatenate(vector), "score": np.concatenate(score)}
    )


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id, vector``: usable vectors with integer components."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * 256).cast("long"))
    usable = embeddings.filter(F.col("vec_id").isNotNull() & x.isNotNull() & finite)
    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("vector")).distinct()


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best of ``vectors`` for each of ``queries``, both ``vec_id, vector``.

    Ties go to the smaller id.
    """
    vectors, queries = stored(vectors, "vectors"), stored(queries, "queries")
    blocks, parts = -(-vectors.count() // VECTORS) or 1, -(-queries.count() // QUERIES) or 1
    part = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    sides = vectors.withColumn("block", block).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    asked = queries.withColumn("part", part).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    sides = sides.groupBy("part", "block")
    gathered = asked.groupBy("part", "block").cogroup(sides).applyInArrow(_gather(k), "query_id long, score long")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"))
    cutoffs = (
        gathered.withColumn("place", F.row_number().over(by_score))
        .filter(F.col("place") <= k)
        .groupBy("query_id")
        .agg(F.min(F.when(F.col("place") == k, F.col("score"))).alias("cutoff"))
    )
    told = asked.join(cutoffs, asked.vec_id == cutoffs.query_id, "left").drop("query_id")
    sufficient = told.groupBy("part", "block").cogroup(sides).applyInArrow(
        _resolve, "query_id long, vec_id long, score long"
    )
    by_rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return sufficient.withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
