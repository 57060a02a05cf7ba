"""Stages and operators on tables whose other columns are called like internal ones."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from veilmark.llm import exact_dup, mixing, near_dup, packing, privacy, quality, topk
from veilmark.llm.scratch import fresh

#: Every name that the modules give to a column, read from their text.
SOURCES = [Path(m.__file__).read_text() for m in (exact_dup, mixing, near_dup, packing, privacy, quality, topk)]
INTERNAL = sorted(
    {n for text in SOURCES for n in re.findall(r"\"([a-z][a-z_0-9]*)\"", text)}
    - {"doc_id", "text", "source", "lang", "n_chars", "string", "long", "int", "double", "left", "inner"}
)


@pytest.fixture
def clashing(spark, odd_rows):
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in odd_rows if t is None or len(t) < 10_000]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return table.select("*", *[F.lit("mine").alias(n) for n in INTERNAL])


def test_names_are_found():
    assert {"near_dup_id", "found_id", "own_hash", "size", "copy", "hash"} <= set(INTERNAL)
    assert fresh(["A", "a_"], "a", "b", "b") == ["a__", "b", "b_"]


@pytest.mark.parametrize("stage", [exact_dup.keep_first, near_dup.keep_one, mixing.mixed, privacy.sanitised], ids=lambda f: f.__name__)
def test_stages_keep_every_column(clashing, stage):
    found = stage(clashing)
    assert found.columns == clashing.columns
    rows = found.collect()
    assert rows and all(r[n] == "mine" for r in rows for n in INTERNAL)


def test_operators_give_the_same_rows(spark, small, clashing):
    plain = clashing.select("doc_id", "text", "lang", "source", "n_chars")
    for operator in (exact_dup.exact_duplicates, near_dup.near_duplicates, privacy.personal_data):
        a, b = (sorted(map(repr, operator(t).collect())) for t in (clashing, plain))
        assert a == b
    a, b = (packing.pack(t.coalesce(1), with_ids=False).drop("sequence_id").collect() for t in (clashing, plain))
    assert a == b


def test_first_stage_keeps_every_column(spark, small, clashing):
    labels = spark.createDataFrame([(5, 1, 0), (6, 0, 0)], "doc_id long, quality int, toxic int")
    found = quality.keep_good(clashing, labels)
    assert found.columns == clashing.columns and found.count() >= 0
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality"


def test_texts_of_one_id_and_long_ones_are_learned_from(spark):
    long = "\n".join(f"Line {i} of a long text." for i in range(2000))
    rows = [(1, "Good words."), (1, "Other words."), (4, "\x00#$% %%"), (6, long)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (4, 0), (6, 1)], "doc_id long, quality int")
    first = sorted(map(tuple, quality.training_sample(documents, labels).collect()))
    again = sorted(map(tuple, quality.training_sample(documents.repartition(5), labels).collect()))
    assert first == again and [r[0] for r in first] == [1, 4, 6] and first[2][1] == long
    model = quality.fitted(documents, labels)
    assert (model.weights == quality.fitted(documents.repartition(5), labels).weights).all()
