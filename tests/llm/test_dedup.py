"""Exact and near duplicates against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from veilmark.llm import exact_dup, near_dup
from veilmark.llm.words import groups, shingles, words


def text_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def shingle_set(text):
    w = text_words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed, base_words, copies):
    """Texts around a few bases, at similarities on both sides of the threshold."""
    rng = random.Random(seed)
    rows = []
    for base in range(4):
        own = [f"b{base}w{rng.randrange(10**6)}" for _ in range(base_words)]
        for _ in range(copies):
            text = list(own)
            for _ in range(rng.randrange(0, base_words // 25)):
                text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
            rows.append((len(rows) * 3 + 1, " ".join(text)))
    rng.shuffle(rows)
    return rows


def test_words_and_shingles_match_the_definition():
    texts = ["A b\tc\x0bD", "", "é É e", "one two three four five six", "a a a a a a a", "\n", "x" * 3_000_000]
    found = words([t.encode() for t in texts])
    assert found.counts.tolist() == [len(text_words(t)) for t in texts]
    assert found.hashes[0] != found.hashes[1] and found.hashes[4] != found.hashes[5]
    runs = shingles(found)
    distinct = [len(set(runs.hashes[a:b].tolist())) for a, b in zip(runs.bounds, runs.bounds[1:], strict=False)]
    assert distinct == [len(shingle_set(t)) for t in texts]
    assert [len(g) for _, g in groups([b"a" * 10, None, b"b" * 10], 15)] == [2, 1]


def test_exact_matches_brute_force_with_and_without_collisions(documents, odd_rows):
    frame = documents(odd_rows)
    form = {(i, t): re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t, _ in odd_rows}
    sizes = Counter(form[i, t] for i, t, _ in odd_rows)
    expected = Counter()
    for i, t, _ in odd_rows:
        ids = [j for j, u, _ in odd_rows if form[j, u] == form[i, t] and j is not None]
        keep = min(ids) if ids else None
        expected[i, keep, sizes[form[i, t]], i == keep] += 1
    for bits in (128, 4):
        rows = exact_dup.exact_duplicates(frame, bits).drop("text_sha256").collect()
        assert Counter(tuple(r) for r in rows) == expected
    kept = exact_dup.keep_first(frame)
    assert kept.columns == frame.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 4, 5, 6, 7, None, 8])


def test_near_matches_brute_force(documents):
    rows = near_copies(5, 120, 30) + [(1000, "a b"), (1001, "A  B"), (1002, ""), (1003, "b a")]
    found = near_dup.near_duplicates(documents(rows)).collect()
    expected = brute_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found) and len(found) == len(rows)


def test_near_with_split_keys(documents, monkeypatch):
    """Keys with more members than a block are compared as pairs of blocks."""
    monkeypatch.setattr(near_dup, "BLOCK", 7)
    rows = near_copies(6, 100, 25)
    found = near_dup.near_duplicates(documents(rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(rows)


def test_near_odd_rows(documents, odd_rows):
    found = near_dup.near_duplicates(documents(odd_rows)).collect()
    got = Counter((r.doc_id, r.component_id, r.kept) for r in found)
    alone = [1, 2, 3, 6, 8]
    expected = Counter({(i, i, True): 1 for i in alone})
    expected += Counter({(4, 4, True): 2, (5, 4, False): 1, (9, 4, False): 1, (7, 6, False): 1, (None, None, True): 2})
    assert got == expected
    frame = documents(odd_rows)
    kept = near_dup.keep_one(frame)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 6, 8, None}


@pytest.mark.parametrize("operator", [exact_dup.exact_duplicates, exact_dup.keep_first, near_dup.near_duplicates, near_dup.keep_one])
def test_empty_table(documents, operator):
    assert operator(documents([])).count() == 0


def test_pairs_within_the_distance_are_found_by_a_key():
    """Pigeonhole: signatures that differ in 15 of 40 symbols agree in four of five symbols of some chunk."""
    rng = np.random.default_rng(1)
    for _ in range(500):
        wrong = np.zeros(near_dup.SYMBOLS, bool)
        wrong[rng.choice(near_dup.SYMBOLS, 15, replace=False)] = True
        assert (wrong.reshape(near_dup.CHUNKS, near_dup.CHUNK).sum(1) <= 1).any()


def test_close_pairs_are_given_out_once():
    long = np.zeros((3, near_dup.LONG_SYMBOLS), np.uint8)
    symbols = np.zeros((3, near_dup.SYMBOLS), "<u2")
    rows = []
    for place in (0, 1, 7):
        for i in range(3):
            rows.append((place, place, i, i, 0, symbols[i].tobytes(), long[i].tobytes()))
    names = ["cell", "place", "id", "component", "side", "symbols", "long"]
    batch = pa.RecordBatch.from_pydict({n: list(c) for n, c in zip(names, zip(*rows, strict=True), strict=True)})
    out = [p for b in near_dup._close_pairs(iter([batch.slice(0, 4), batch.slice(4)])) for p in b.to_pylist()]
    assert sorted((p["a"], p["b"]) for p in out) == [(0, 1), (0, 2), (1, 2)]


def test_threshold_is_an_argument_and_the_stage_takes_080(documents, spark):
    import corpus_pipeline

    words = [f"w{i}" for i in range(200)]
    copy = [f"e{i}" if i in (20, 70, 120, 170) else w for i, w in enumerate(words)]
    frame = documents([(1, " ".join(words)), (2, " ".join(copy))])
    assert sorted(r.component_id for r in near_dup.near_duplicates(frame).collect()) == [1, 2]
    assert [r.component_id for r in near_dup.near_duplicates(frame, link=80).collect()] == [1, 1]
    assert [r.doc_id for r in corpus_pipeline.distinct(spark, frame, "").collect()] == [1]


@pytest.mark.parametrize(("link", "mean"), [(85, 76.5), (80, 102)])
def test_long_distance_keeps_pairs_at_the_threshold(link, mean):
    p = (1 - link / 100) * 255 / 256
    limit, n = near_dup.long_distance(link), near_dup.LONG_SYMBOLS
    tail = sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(limit + 1, n + 1))
    assert mean < limit and tail < 1e-7
