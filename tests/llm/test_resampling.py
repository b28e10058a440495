import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest

from cartwright.llm import resampling
from cartwright.llm.resampling import Head, feature_buckets, importance, resample, word_lists

from .helpers import awkward_docs, frame, words


def brute_words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_buckets(text, buckets=10_000):
    w = brute_words(text)
    return [crc32(" ".join(w[i:i + k]).encode()) % buckets for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(rows, target, share=(5, 100), min_words=20):
    s = Counter(b for r in rows for b in brute_buckets(r[1]))
    t = Counter(b for x in target for b in brute_buckets(x))
    n, m = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n + 10_000) / ((s[b] + 1) * (m + 10_000))))
    out = []
    for r in rows:
        found = brute_buckets(r[1])
        h = int(hashlib.sha256(f"42:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, found))
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([r[0], len(found), weight, weight + noise, None, len(brute_words(r[1])) >= min_words])
    may = sorted((x for x in out if x[5]), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    for i, x in enumerate(may[: share[0] * len(may) // share[1]]):
        x[4] = i + 1
    return Counter(tuple(x[:5]) for x in out)


TARGET = [words(40, 77), words(25, 78), None, "", "River STONE, under-early"]


@pytest.mark.parametrize("share", [(5, 100), (60, 100), (1, 1), (0, 1)])
def test_matches_brute_force(spark, share):
    rows = awkward_docs() + [(200 + i, words(30, i % 7), "en", "s", 1) for i in range(60)]
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    got = importance(frame(spark, rows).repartition(5), target, share)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == brute(rows, TARGET, share)


def test_head_and_tail_give_the_same_buckets(monkeypatch):
    text = words(3000, 1).encode() + " Ünd 12x3 ÄÖ\x00ende".encode()
    common = [w for w, _ in Counter(w for part in word_lists(text) for w in part).most_common(12)]
    heads = [Head.of([], [], 10_000), Head.of(common, [(a, b) for a in range(6) for b in range(6)], 10_000)]
    want = Counter(brute_buckets(text.decode()))
    for piece in (1 << 20, 50, 7):
        monkeypatch.setattr(resampling, "PIECE", piece)
        for head in heads:
            found = list(feature_buckets(text, head, 10_000))
            assert Counter(b for _, f in found for b in f.tolist()) == want
            assert sum(n for n, _ in found) == len(brute_words(text.decode()))


def test_pieces_end_between_words(monkeypatch):
    monkeypatch.setattr(resampling, "PIECE", 5)
    for text in ("", "   ", "abc", "a" * 1000, "one two  three-four " * 30, " lead and trail "):
        assert [w.decode() for part in word_lists(text.encode()) for w in part] == brute_words(text)


def test_empty_tables(spark):
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    assert importance(frame(spark, []), target).count() == 0
    rows = awkward_docs()
    got = importance(frame(spark, rows), target.limit(0), (1, 2))
    assert Counter(map(tuple, got.collect())) == brute(rows, [], (1, 2))


def test_resample_keeps_all_columns(spark):
    rows = awkward_docs()
    docs = frame(spark, rows).selectExpr("*", "1 AS rank", "2 AS score", "3 AS row", "4 AS uid", "5 AS part")
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    got = resample(docs, target, (1, 2))
    assert got.columns == docs.columns
    want = [x[0] for x in brute(rows, TARGET, (1, 2)).elements() if x[4] is not None]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got.collect()) == sorted((i is None, i or 0) for i in want)
