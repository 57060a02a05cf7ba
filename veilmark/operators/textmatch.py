"""Substring containment between two columns of names, without a nested loop."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words of one automaton and names read against it in one go; they bound the memory of a task.
SHARD_WORDS, BLOCK_NAMES = 50_000, 200_000
# Characters by which longer words are dealt; names visit the shards of the runs of so many characters that they hold.
HEAD = 4


def _dealt(names: DataFrame, words: DataFrame, shard_words: int, block_names: int) -> tuple[DataFrame, DataFrame]:
    """``(name, shard, block)`` and ``(word, shard, block)``: a word's shard and block hold all names that contain it."""
    names = names.select("name").filter(F.col("name").isNotNull()).distinct()
    words = words.select("word").filter(F.col("word").isNotNull() & (F.col("word") != "")).distinct()
    words = words.withColumn("head", F.regexp_extract("word", f"(?s)^(.{{{HEAD}}})", 1))
    is_short = F.col("head") == ""

    def shards_for(part: Column) -> Column:
        held = F.count_if(part)
        return words.agg(F.greatest(F.ceil(held / shard_words), F.lit(1)).cast("int")).scalar()

    def table(pairs: DataFrame) -> Column:
        """A few pairs ``(k, v)`` as a map."""
        return pairs.agg(F.map_from_entries(F.collect_list(F.struct("k", "v")))).scalar()

    shards, short_shards = shards_for(~is_short), shards_for(is_short)
    heads = words.filter(~is_short).groupBy(F.col("head").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    parts = table(heads.filter(F.col("n") > shard_words).select("k", F.ceil(F.col("n") / shard_words).cast("int").alias("v")))

    # Columns, as functions over arrays may not hold subqueries.
    counted = [shards.alias("shards"), short_shards.alias("short_shards"), parts.alias("parts")]
    names, words = names.select("*", *counted), words.select("*", *counted)

    def parts_of(head: Column) -> Column:
        return F.coalesce(F.try_element_at("parts", head), F.lit(1))

    def shard_of(head: Column, part: Column) -> Column:
        return F.pmod(F.xxhash64(head, part), F.col("shards")).cast("int")

    # Shards of short words are counted from -1 downwards.
    short_place = (-1 - F.pmod(F.xxhash64("word"), F.col("short_shards"))).cast("int")
    long_place = shard_of(F.col("head"), F.pmod(F.xxhash64("word"), parts_of(F.col("head"))).cast("int"))
    words = words.select("word", F.when(is_short, short_place).otherwise(long_place).alias("shard"))

    runs = F.array_distinct(F.regexp_extract_all("name", F.lit(f"(?s)(?=(.{{{HEAD}}}))"), F.lit(1)))
    visited = F.flatten(
        F.transform(runs, lambda r: F.transform(F.sequence(F.lit(0), parts_of(r) - 1), lambda p: shard_of(r, p)))
    )
    every = F.transform(F.sequence(F.lit(1), F.col("short_shards")), lambda i: -i)
    placed = names.select("name", F.array_distinct(F.concat(every, visited)).alias("visited"))

    # Nested, so that it travels with the job.
    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("visited").flatten().value_counts()
            yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], names=["k", "n"])

    read_by = placed.select("visited").mapInArrow(visits, "k int, n long").groupBy("k").agg(F.sum("n").alias("n"))
    blocks = table(read_by.filter(F.col("n") > block_names).select("k", F.ceil(F.col("n") / block_names).cast("int").alias("v")))
    blocks_of = F.coalesce(F.try_element_at(blocks, F.col("shard")), F.lit(1))
    left = placed.select("name", F.explode("visited").alias("shard"))
    left = left.withColumn("block", F.pmod(F.xxhash64("name"), blocks_of).cast("int"))
    right = words.select("word", "shard", F.explode(F.sequence(F.lit(0), blocks_of - 1)).alias("block"))
    return left, right


def containment(
    names: DataFrame, words: DataFrame, shard_words: int = SHARD_WORDS, block_names: int = BLOCK_NAMES
) -> DataFrame:
    """Pairs ``(name, word)`` where the text ``name`` contains ``word``.

    ``names`` and ``words`` are one-column DataFrames (``name`` / ``word``); both are made distinct first.  NULL and
    the empty word match nothing.  Words are dealt to shards by their first four characters, and a name goes only to
    the shards of the runs of four characters that it holds, at most one per character whatever the number of words.
    Heads with more than ``shard_words`` words are split by word; a name with such a head visits every part.  Shorter
    words, of which an alphabet has a bounded number, have shards of their own that every name visits.  The names of a
    shard are split into blocks by hash, each with a copy of the shard's words; a task builds the Aho-Corasick
    automaton of a shard and reads every name of a block once.  No substring is shuffled, no pair that does not match.
    The numbers of shards, parts and blocks come from counts inside the plan.  Tasks need ``pyahocorasick``.
    """
    left, right = (df.groupBy("shard", "block") for df in _dealt(names, words, shard_words, block_names))

    # Nested, so that it travels with the job.
    def read(block: pa.Table, shard: pa.Table) -> pa.Table:
        import ahocorasick

        found_names, found_words = [], []
        if block.num_rows and shard.num_rows:
            automaton = ahocorasick.Automaton()
            for word in shard.column("word").to_pylist():
                automaton.add_word(word, word)
            automaton.make_automaton()
            for name in block.column("name").to_pylist():
                hits = {word for _, word in automaton.iter(name)}
                found_names.extend([name] * len(hits))
                found_words.extend(hits)
        return pa.table({"name": pa.array(found_names, pa.string()), "word": pa.array(found_words, pa.string())})

    return left.cogroup(right).applyInArrow(read, "name string, word string")
