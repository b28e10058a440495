import binascii
import random
import struct
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from cartwright.llm.packing import _knapsack, pack, pack_counts, solve_lp

from .helpers import DOCS, awkward_docs, frame, words

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(JSON)


def check(rows, got, tokenizer, capacity):
    """An exact round trip: all ids of all documents, no gap, no overlap."""
    left = defaultdict(list)
    for r in rows:
        left[r[0]].append([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0])
    pieces = defaultdict(list)
    for g in got:
        assert 1 <= g.length <= capacity
        pieces[g.doc_id].append(g)
    assert set(pieces) == set(left)
    for doc_id, own in pieces.items():
        want = sorted((p, s, n, crc) for ids in left[doc_id] for p, s, n, crc in cut(ids, capacity))
        assert sorted((p.piece, p.start, p.length, p.ids_crc32) for p in own) == want
    sequences = defaultdict(list)
    for g in got:
        sequences[g.sequence_id].append((g.offset, g.length))
    for seats in sequences.values():
        at = 0
        for offset, length in sorted(seats):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def cut(ids, capacity):
    first = len(ids) % capacity or capacity
    at, piece = 0, 0
    while at < len(ids):
        stop = first if at == 0 else at + capacity
        part = ids[at:stop]
        yield piece, at, len(part), binascii.crc32(b"".join(struct.pack("<I", i) for i in part))
        at, piece = stop, piece + 1


@pytest.mark.parametrize("ranks", [None, RANKS])
def test_round_trip_of_awkward_rows(spark, tokenizer, ranks):
    rows = awkward_docs() + [(90, "a <|endoftext|> b", "en", "s", 1)]
    got = pack(frame(spark, rows), JSON, ranks=ranks).collect()
    check(rows, got, tokenizer, 2048)


def test_white_space_runs_of_any_length(spark, tokenizer):
    n = 1_500_000
    rows = [(1, " " * n, "en", "s", n), (2, "a" + "\n" * n + "b", "en", "s", n), (3, "a \u3000\x85" * (n // 4) + "\xa0 " * n, "en", "s", n),
            (4, (" " * 99_999 + "x") * 3, "en", "s", 300_000), (5, "plain words", "en", "s", 11)]
    got = pack(frame(spark, rows), JSON, ranks=RANKS).collect()
    check(rows, got, tokenizer, 2048)


def test_hot_length_over_many_tasks(spark, tokenizer):
    rows = [(i, "same text here" if i % 3 else words(1 + i % 50, i), "en", "s", 1) for i in range(600)]
    got = pack(frame(spark, rows).repartition(9), JSON, ranks=RANKS, capacity=64).collect()
    n = check(rows, got, tokenizer, 64)
    assert n <= 1.02 * -(-sum(g.length for g in got) // 64) + 1


def test_empty_table(spark):
    assert pack(frame(spark, [], DOCS), JSON, ranks=RANKS).count() == 0


def test_knapsack_pricing_is_optimal():
    r = np.random.default_rng(0)
    for _ in range(5):
        price = np.where(r.random(31) < 0.4, r.random(31), 0.0)
        price[0] = 0
        best = [0.0] * 31
        for room in range(1, 31):
            best[room] = max([best[room - 1], *(best[room - n] + price[n] for n in range(1, room + 1) if price[n])])
        last, room, worth = _knapsack(price, 30), 30, 0.0
        while room:
            worth += price[last[room]] if last[room] else 0
            room -= last[room] or 1
        assert worth == pytest.approx(best[30])


def exact_bins(items, capacity):
    """Fewest bins by search over partitions of a few items."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + items[i] <= capacity:
                bins[j] += items[i]
                place(i + 1, bins)
                bins[j] -= items[i]
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best[0]


def test_counts_are_used_up_in_nearly_the_fewest_bins():
    r = random.Random(3)
    for _ in range(20):
        items = [r.randrange(1, 21) for _ in range(9)]
        counts = np.bincount(items, minlength=21)
        plan = pack_counts(counts, 20)
        assert (sum(c * n for c, n in plan) == counts).all()
        assert all(c @ np.arange(21) <= 20 for c, _ in plan)
        assert sum(n for _, n in plan) <= exact_bins(items, 20) + 1


def test_programme_covers_the_histogram():
    counts = np.zeros(101, np.int64)
    counts[[7, 13, 29, 31, 50, 100]] = [900, 700, 500, 300, 200, 10]
    covered = np.zeros(101)
    for config, x in solve_lp(counts, 100).items():
        assert sum(n * c for n, c in config) <= 100
        for n, c in config:
            covered[n] += x * c
    assert (covered >= counts - 1e-6).all()
