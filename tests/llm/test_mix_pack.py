"""Mixing and packing: budgets, limits and round trips."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from veilmark.llm import mixing, packing


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def fair_targets(sizes, weights=mixing.WEIGHTS, share=mixing.SHARE, most=mixing.MOST):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > most * sizes[s]}
        if not full:
            return out | {s: weight[s] * level for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def corpus():
    rows = [(i, " ".join(["w"] * (i * 7 % 40)), ["a", "b", "é", None, "z"][i % 11 % 5]) for i in range(300)]
    return [*rows, (300, "q " * 5000, "a"), (7, rows[7][1], rows[7][2]), (None, None, "b"), (None, "one two", "c")]


def test_mix_meets_targets_and_reruns_agree(documents):
    rows = corpus()
    found = mixing.mix_sources(documents(rows))
    got = found.collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += size(text)
    goals, taken = fair_targets(sizes), defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and abs(r.target - goals[r.source]) < 1e-6
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == r.epochs * r["size"] + r.rest
    assert all(abs(taken[s] - goals[s]) <= 0.5 for s in goals)
    again = mixing.mix_sources(documents(rows[::-1]).repartition(7))
    key = ["doc_id", "size", "taken"]
    assert Counter(map(tuple, again.select(key).collect())) == Counter(map(tuple, found.select(key).collect()))


def test_mixed_rows_hold_the_words_taken(documents):
    frame = documents(corpus())
    out = mixing.mixed(frame)
    assert out.columns == frame.columns
    taken, words = defaultdict(int), defaultdict(int)
    for r in mixing.mix_sources(frame).collect():
        taken[r.source] += r.taken
    for r in out.collect():
        words[r.source] += size(r.text)
        assert r.size == "x" and r.copy == "x" and (r.text is None or r.n_chars == len(r.text))
    assert {s: n for s, n in words.items() if n} == {s: n for s, n in taken.items() if n}


def test_cut_copy_keeps_its_white_space(documents):
    rows = [(1, " a\tb  c\nd ", "x"), (2, "e " * 40, "y")]
    cut = [r for r in mixing.mixed(documents(rows)).collect() if r.doc_id == 1]
    assert all(" a\tb  c\nd ".startswith(r.text) for r in cut)


@pytest.mark.parametrize("rows", [[], [(1, "", "a"), (2, None, None)]])
def test_mix_without_words(documents, rows):
    frame = documents(rows)
    assert all(r.taken == 0 and r.target == 0 for r in mixing.mix_sources(frame).collect())
    assert mixing.mixed(frame).count() == len(rows)


def check_pieces(pieces, limits):
    by_sequence, by_document = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append(p)
        by_document[p.doc_id, p.doc_tokens].append(p)
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes()) and len(p.ids) == p.length > 0
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        ends = np.cumsum([p.length for p in own])
        assert [p.offset for p in own] == [0, *ends[:-1]] and ends[-1] <= limits[0] and len(own) <= limits[1]
    return by_sequence, by_document


def test_packing_round_trip(documents, odd_rows):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public.path(packing.VOCABULARY))
    rows = [r for r in odd_rows if r[0] not in (4, None)] + [(20 + i, "word " * i + "<|endoftext|> 中文 😀", "s") for i in range(200)]
    pieces = packing.pack(documents(rows).coalesce(1)).collect()
    sequences, by_document = check_pieces(pieces, (packing.TOKENS, packing.SEGMENTS))
    for doc_id, text, _ in rows:
        expected = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END]
        own = sorted(by_document[doc_id, len(expected)], key=lambda p: p.start)
        assert [i for p in own for i in p.ids] == expected
        assert [p.start for p in own] == [0, *np.cumsum([p.length for p in own])[:-1]]
    short = sorted(sum(p.length for p in own) for own in sequences.values())
    assert all(n > packing.TOKENS - packing.LEAST_GAP for n in short[1:])


def test_packing_under_three_limits():
    rng = np.random.default_rng(3)
    limits = (64, 3, 20)
    packer = packing.Packer(limits)
    pieces, totals = [], []
    for number in range(300):
        total = int(rng.integers(1, 200))
        free = int(rng.integers(0, total))
        totals.append((total, free))
        pieces += packer.add(number, total, free)
        if len(packer.items) > 50:
            pieces += packer.pack(5)
    pieces += packer.pack(0)
    tokens, segments, loss = Counter(), Counter(), Counter()
    covered = defaultdict(list)
    for number, start, length, sequence, offset in pieces:
        assert offset == tokens[sequence]
        tokens[sequence] += length
        segments[sequence] += 1
        loss[sequence] += packer.demand(start, length, totals[number][1])[2]
        covered[number] += range(start, start + length)
    assert max(tokens.values()) <= 64 and max(segments.values()) <= 3 and max(loss.values()) <= 20
    assert all(sorted(covered[i]) == list(range(total)) for i, (total, _) in enumerate(totals))


def test_packing_empty_table_and_repeated_rows(documents):
    assert packing.pack(documents([])).count() == 0
    twice = packing.pack(documents([(1, "a b c", "s"), (1, "a b c", "s"), (None, None, None)])).collect()
    assert sum(p.length for p in twice) == sum(p.doc_tokens for p in twice) == 2 * 4 + 1


def test_long_white_space_gives_the_ids_of_the_library():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tokenizer, encoding = Tokenizer.from_file(public.path(packing.VOCABULARY)), packing.encoder()

    def same(text):
        ids, expected = packing.encode(encoding, text), tokenizer.encode(text, add_special_tokens=False).ids
        assert len(ids) == len(expected) and ids == expected

    for space in (" ", "\t", "\n"):
        run = space * 1_500_000
        for text in (run, run + "word", "word" + run, f"a{run}b{run}"):
            same(text)
    for space in (" ", "\n", "\r\n", "\x0b", "\x85", "\xa0", " ", "　", " \n\t", "​", "\x1c"):
        for count in (998, 999, 1000, 1001):
            run = space * count
            for after in ("", "word", "7", "...", "'s", "<|endoftext|>", "é", "\x1c", "​", "😀"):
                same(f"Some text  {run}{after}{run} x")
