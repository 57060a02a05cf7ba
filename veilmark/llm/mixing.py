"""Mix sources to target weights: hash-random order, distributed prefix sums, a cut at each source's exact budget.

Every document gets a random key from its id.  A source's documents are dealt to ranges of that key (``RANGES`` per
source), each range is sorted, and a document's place is the sum of the ranges before plus the running sum in its own
range; so a source with a third of all rows is sorted by as many tasks.  A source takes its whole budget in words: full
epochs first, then documents in key order up to the exact word; the document at the cut gives its first words.

Sources come in code point order, null last.  Null text has no words.  Documents without words take no budget; they are
repeated with the full epochs.  Rows with equal id and size are interchangeable, so ties cannot change the result.
Rows without an id are ordered by their text.  Reruns agree, whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import fresh, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
#: Words of the mix as a multiple of all words, and the most a source is repeated.
SHARE, MOST = 1.5, 2.0
#: Ranges of the random key per source, as a power of two.
RANGE_BITS = 10
SEED = 20


def targets(sums: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source_key, source_size, target`` from ``source_key, part`` rows.

    Words are shared by weight; a source stops at ``most`` times its size and the excess is shared again among the
    others.  That is one common level for all: target = min(weight * level, most * size).  Each round asks for two sums.
    """
    spark = sums.sparkSession
    sizes = sums.groupBy("source_key").agg(F.sum("part").alias("source_size"))
    numbered = sizes.orderBy("source_key").rdd.zipWithIndex().map(lambda row: (row[0][0], row[0][1], row[1]))
    ranked = spark.createDataFrame(numbered, "source_key string, source_size long, place long")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = stored(ranked.withColumn("weight", weight), "sources")
    words, free = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    level, full = (share * words / free if free else 0.0), 0
    while True:
        above = F.col("weight") * level > most * F.col("source_size")
        capped, free, count = ranked.agg(
            F.sum(F.when(above, F.col("source_size"))), F.sum(F.when(~above, F.col("weight"))), F.count_if(above)
        ).first()
        if count == full:
            break
        full = count
        if not free:
            break
        level = (share * words - most * (capped or 0)) / free
    return ranked.select(
        "source_key", "source_size", F.least(F.col("weight") * level, most * F.col("source_size")).alias("target")
    )


def _placed(rows: DataFrame, doc_id: Column, text: Column, source: Column, bits: int) -> DataFrame:
    """Rows with ``size, source_key, key, range``."""
    key = F.xxhash64(F.lit(SEED), doc_id, F.when(doc_id.isNull(), text))
    return rows.withColumns(
        {
            "size": F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long"),
            "source_key": F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source)),
            "key": key,
            "range": F.shiftrightunsigned(key, 64 - bits).cast("int"),
        }
    )


def mix_sources(documents: DataFrame, bits: int = RANGE_BITS, **terms) -> DataFrame:
    """All columns of ``documents`` plus ``size, source_size, target, taken, epochs, rest``.

    The mix takes ``epochs`` whole copies of a document and the first ``rest`` words of one more.  An input column named
    like an added one is replaced.
    """
    names = documents.columns
    rows = documents.toDF(*[f"in_{i}" for i in range(len(names))])
    doc_id, text, source = (F.col(f"in_{names.index(n)}") for n in ("doc_id", "text", "source"))
    placed = _placed(rows, doc_id, text, source, bits)
    sums = stored(placed.groupBy("source_key", "range").agg(F.sum("size").alias("part")), "ranges")
    budget = F.floor(F.col("target") + 0.5)
    shares = targets(sums, **terms).withColumns(
        {
            "epochs": F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(1),
            "left": F.when(F.col("source_size") > 0, budget % F.col("source_size")).otherwise(0),
        }
    )
    ranges = Window.partitionBy("source_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.withColumn("before", F.coalesce(F.sum("part").over(ranges), F.lit(0))).drop("part")
    before = before.join(shares, "source_key")
    inside = (
        Window.partitionBy("source_key", "range")
        .orderBy("key", doc_id, "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    run = placed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = run.join(before, ["source_key", "range"])
    rest = F.least("size", F.greatest(F.lit(0), F.col("left") - F.col("before") - F.col("inside")))
    joined = joined.withColumn("rest", rest).withColumn("taken", F.col("epochs") * F.col("size") + F.col("rest"))
    added = ["size", "source_size", "target", "taken", "epochs", "rest"]
    kept = [F.col(f"in_{i}").alias(n) for i, n in enumerate(names) if n not in added]
    return joined.select(*kept, *[F.col(n) if n == "target" else F.col(n).cast("long").alias(n) for n in added])


def mixed(documents: DataFrame, **terms) -> DataFrame:
    """The mix itself: the columns of ``documents``, a row per copy; a cut copy has its first words only."""
    names = documents.columns
    added = ["size", "source_size", "target", "taken", "epochs", "rest"]
    clashing = [n for n in names if n.lower() in added]
    *renamed, copy = fresh([*names, *added], *[f"in_{n}" for n in clashing], "copy")
    clash = dict(zip(clashing, renamed, strict=True))
    rows = mix_sources(documents.withColumnsRenamed(clash), **terms)
    copies = F.col("epochs") + (F.col("rest") > 0).cast("long")
    rows = rows.filter(copies > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), copies)))
    # Pieces that end where a word ends, so the first words keep their white space.
    pieces = F.split("text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    first = F.concat_ws("", F.slice(pieces, 1, F.col("rest").cast("int")))
    cut = (F.col(copy) > F.col("epochs")) & (F.col("rest") < F.col("size"))
    rows = rows.withColumn("text", F.when(cut, first).otherwise(F.col("text")))
    if "n_chars" in names:
        rows = rows.withColumn("n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return rows.select(*[F.col(clash.get(n, n)).alias(n) for n in names])
