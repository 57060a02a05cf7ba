"""Quality classifier and language model: held-out accuracy, brute force, edge cases."""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from veilmark.llm import lm, quality, trie

from .test_dedup import text_words


def test_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    found = quality.lines([b"one\ntwo words\n\n!!", b"", b"x"])
    assert np.diff(found.bounds).tolist() == [4, 1, 1]
    model = quality.Model(rng.normal(size=(quality.N_FEATURES, 2)), rng.normal(size=(2, 2)))
    got, moves = quality.marginals(model, found)
    scores = found.features @ model.weights
    paths = list(itertools.product((0, 1), repeat=4))
    weight = [
        math.exp(sum(scores[t, y] for t, y in enumerate(p)) + sum(model.transitions[a, b] for a, b in itertools.pairwise(p)))
        for p in paths
    ]
    for t in range(4):
        good = sum(w for w, p in zip(weight, paths, strict=True) if p[t]) / sum(weight)
        assert abs(good - got[t, 1]) < 1e-9
    assert abs(moves.sum() - 3) < 1e-9


def test_quality_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    rows = quality.quality(documents, labels).collect()
    assert len(rows) == documents.count()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.predicted == t for r, t in held) / len(held) > 0.95
    kept = quality.keep_good(documents, labels)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.predicted}


def test_quality_odd_rows(spark, documents, odd_rows):
    frame = documents(odd_rows)
    schema = "doc_id long, quality int, toxic int, score string"
    labels = [(i, i % 2, 0, "") for i in range(1, 9)] + [(None, 1, 0, ""), (4, 1, 0, ""), (4, 0, 0, ""), (5, None, 0, "")]
    for known in (spark.createDataFrame(labels, schema), spark.createDataFrame([], schema)):
        rows = quality.quality(frame, known).collect()
        assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
        assert all(r.held_out is False for r in rows if r.doc_id is None)
        assert quality.quality(documents([]), known).count() == 0
    assert all(r.score == 0.5 for r in rows)


def test_trie_finds_exactly_its_pairs():
    rng = np.random.default_rng(0)
    size = 3000
    dense = np.concatenate([rng.integers(0, size, 2500), rng.integers(0, size * size, 6000)])
    pairs = np.unique(dense)
    times = rng.integers(1, 9, len(pairs))
    counts = np.bincount(pairs // size, times, size).astype(np.int64) + 2
    hashes = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
    model = trie.Trie(trie.build(hashes, counts, int(counts.sum()), size, pairs, times))
    asked = np.concatenate([pairs, rng.integers(0, size * size, 30000)])
    got, found = model.bigrams(asked // size, asked % size)
    assert (found == np.isin(asked, pairs)).all()
    context, word = pairs // size, pairs % size
    left = trie.DISCOUNT * np.bincount(context, minlength=size) / counts
    unigram = (counts + 1) / (counts.sum() + size + 1)
    exact = np.log10((times - trie.DISCOUNT) / counts[context] + left[context] * unigram[word])
    assert model.complete.all()
    assert np.abs(got[: len(pairs)] - exact).max() <= np.ptp(exact) / 255
    assert (model.successors.get(np.arange(len(pairs))) == pairs).all()
    assert (model.words(hashes) == np.arange(size)).all() and model.words(np.array([1], np.uint64))[0] == -1
    assert not model.bigrams(np.array([-1, 2]), np.array([3, -1]))[1].any()


def test_probabilities_after_a_context_add_up(tmp_path):
    """Over the vocabulary and all other words; the file is read in place."""
    counts = np.array([50, 30, 20], np.int64)
    pairs, times = np.array([0 * 3 + 1, 0 * 3 + 2, 1 * 3 + 0]), np.array([40, 10, 30])
    path = tmp_path / "model"
    path.write_bytes(trie.build(np.array([5, 7, 9], np.uint64), counts, 100, 3, pairs, times))
    model = trie.Trie(np.memmap(path, np.uint8, "r"))
    other = 1 - ((counts + 1) / 104).sum()
    for context in range(2):
        after, found = model.bigrams(np.full(3, context), np.arange(3))
        p = np.where(found, 10**after, 10 ** (model.unigram + model.backoff[context]))
        assert abs(p.sum() + other * 10 ** model.backoff[context] - 1) < 0.03


def brute_scores(rows):
    tokens = {k: [*text_words(t), None] for k, (_, t) in enumerate(rows)}
    out = {k: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for k, (i, _) in enumerate(rows)}
    training = [tokens[k] for k in tokens if not out[k]]
    counts = Counter(w for words in training for w in words)
    pairs = Counter(p for words in training for p in itertools.pairwise([None, *words]))
    successors = Counter(c for c, _ in pairs)
    total = sum(counts.values())

    def unigram(w):
        return (counts[w] + 1) / (total + len(counts) + 1)

    def bigram(c, w):
        if not counts[c]:
            return unigram(w)
        seen = max(pairs[c, w] - trie.DISCOUNT, 0)
        return (seen + trie.DISCOUNT * successors[c] * unigram(w)) / counts[c]

    return [
        (i, out[k], len(tokens[k]), sum(w in counts for w in tokens[k]), total,
         sum(math.log10(unigram(w)) for w in tokens[k]),
         sum(math.log10(bigram(c, w)) for c, w in itertools.pairwise([None, *tokens[k]])))
        for k, (i, _) in enumerate(rows)
    ]


@pytest.mark.parametrize(("words", "pairs"), [(1 << 19, 1 << 22), (1 << 19, 12), (20, 12), (20, 0), (0, 0)])
def test_language_model_scores_do_not_depend_on_the_trie(documents, odd_rows, monkeypatch, words, pairs):
    """Words and pairs that find no room in the trie are scored like the others, but for its quantisation."""
    monkeypatch.setattr(lm, "VOCABULARY", words)
    monkeypatch.setattr(lm, "PAIRS", pairs)
    monkeypatch.setattr(lm, "GATHER", 500)
    rows = [r[:2] for r in odd_rows if r[0] != 6] + [(100 + i, f"the cat number {i} sat on mat {i % 7}") for i in range(60)]
    found = lm.corpus_scores(documents(rows)).collect()
    columns = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    got = sorted((tuple(r[c] for c in columns) for r in found), key=repr)
    expected = sorted(brute_scores(rows), key=repr)
    for a, b in zip(got, expected, strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 * max(1, abs(b[5]))
        # Steps of one byte over about seven orders of magnitude, for two parts of a probability.
        assert abs(a[6] - b[6]) < (0.03 if words else 1e-6) * a[2]


def test_language_model_beats_its_base_on_held_out_text(spark):
    rows = lm.corpus_scores(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).filter("held_out").collect()
    assert sum(r.score for r in rows) > 0.95 * sum(r.base_score for r in rows)


def test_language_model_on_an_empty_table(documents):
    assert lm.corpus_scores(documents([])).count() == 0


def test_packed_counts_round_trip():
    keys, times = np.array([0, 5, 1 << 40, (1 << 40) + 3]), np.array([1, 2, 3, 1 << 40])
    got = lm._unpacked(lm._packed(keys, times))
    assert got[0].tolist() == keys.tolist() and got[1].tolist() == times.tolist()
