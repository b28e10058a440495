import random
from zlib import crc32

import numpy as np
import pytest

from cartwright.llm import quality, toxicity
from cartwright.llm.labelled import held_out
from pyspark.sql import functions as F

from .helpers import DOCS, awkward_docs, frame, words

LABELS = "doc_id long, quality int, toxic int"
BAD = ("blorfing", "snarvle", "grumpfed", "yuckish")


def labelled(n=600):
    """Clean text, text with bad words, and text of broken structure."""
    docs, labels = [], []
    for i in range(n):
        r = random.Random(i)
        text = words(r.randrange(30, 90), i)
        toxic, good = int(i % 5 == 0), int(i % 4 != 0)
        if not good:
            text = r.choice([text.upper(), " | ".join(text.split()), (text.split()[0] + " ") * 60])
        if toxic:
            text = " ".join(w + (" " + r.choice(BAD) if r.random() < 0.1 else "") for w in text.split()) + " " + r.choice(BAD)
        docs.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, good, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def trained(spark):
    docs, labels = labelled()
    df, lb = frame(spark, docs), spark.createDataFrame(labels, LABELS)
    return docs, labels, toxicity.train(df, lb), quality.train(df, lb)


def scores(module, df, model):
    return [r.score for r in module.score(df, model).collect()]


def accuracy(spark, module, model, docs, want, modulus, remainder, threshold):
    held = [i for i, d in enumerate(docs) if crc32(str(d[0]).encode()) % modulus == remainder]
    got = scores(module, frame(spark, [docs[i] for i in held]), model)
    return np.mean([(s >= threshold) == bool(want[i]) for s, i in zip(got, held)])


def test_held_out_accuracy(spark, trained):
    docs, labels, tox, qual = trained
    assert accuracy(spark, toxicity, tox, docs, [x[2] for x in labels], 3, 1, 0.7) >= 0.97
    assert accuracy(spark, quality, qual, docs, [x[1] for x in labels], 5, 0, 0.3) >= 0.95


def test_held_out_rows_follow_the_checksum(spark):
    df = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long")
    got = {r[0]: r[1] for r in df.select("doc_id", held_out(F.col("doc_id"), 3, 1)).collect()}
    assert got == {None: False} | {i: crc32(str(i).encode()) % 3 == 1 for i in range(50)}


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = labelled(200)
    flipped = [(i, 1 - q, 1 - t) if crc32(str(i).encode()) % 3 == 1 else (i, q, t) for i, q, t in labels]
    df = frame(spark, docs)
    a = toxicity.train(df, spark.createDataFrame(labels, LABELS))
    b = toxicity.train(df, spark.createDataFrame(flipped, LABELS))
    assert np.array_equal(a[0], b[0]) and a[1] == b[1]


def test_swapping_identity_terms_moves_scores_less(spark):
    """Toxic labels go with one group; the penalty takes the group's weight away."""
    docs, labels = labelled(400)
    biased = [(i, t + (" gay" if labels[i][2] else " straight"), *rest) for i, t, *rest in docs]
    df, lb = frame(spark, biased), spark.createDataFrame(labels, LABELS)
    rows = toxicity.sample(df, lb, "toxic", held_out(F.col("label_id"), 3, 1), 1000, toxicity._extract,
                           "y int, features binary, terms string", [F.col("text").alias("text")])

    def gap(fairness):
        weights, bias = toxicity.fit(rows, fairness=fairness)
        hasher = toxicity.Hasher(toxicity.BITS)
        weight = lambda w: weights[sorted(set(hasher(toxicity.features_of(w))))].sum()
        return abs(weight("gay") - weight("straight"))

    assert gap(50.0) < 0.25 * gap(0.0)


def test_every_sampled_text_has_counterfactuals_and_the_default_penalty_works(spark):
    """No text names a group; terms are put in, and their weights held down."""
    docs, labels = labelled(400)
    df, lb = frame(spark, docs), spark.createDataFrame(labels, LABELS)
    rows = toxicity.sample(df, lb, "toxic", held_out(F.col("label_id"), 3, 1), 1000, toxicity._extract,
                           "y int, features binary, terms string", [F.col("text").alias("text")])
    assert len(rows) and (rows["terms"] != "").all()
    pair, feature, sign = toxicity._pairs(rows["terms"].tolist(), toxicity.Hasher(toxicity.BITS))
    assert len(set(pair.tolist())) >= 2 * len(rows)
    # labels follow the terms that were put in: without the penalty they get the weight
    rows["y"] = rows["terms"].str.len() % 2

    def change(**how):
        weights, _ = toxicity.fit(rows, **how)
        return float(np.mean(np.bincount(pair, weights=weights[feature] * sign) ** 2))

    assert 0 < change() < 0.8 * change(fairness=0.0)


def test_neutral_mentions_are_left_alone(spark, trained):
    _, _, tox, _ = trained
    rows = [(i, words(30, 900 + i) + f" {t} " + words(10, i), "en", "s", 1)
            for i, t in enumerate(("muslim", "gay", "women", "immigrants", "black", "jewish"))]
    assert max(scores(toxicity, frame(spark, rows), tox)) < 0.3


def test_awkward_rows_and_extra_columns(spark, trained):
    _, _, tox, qual = trained
    rows = awkward_docs()
    df = frame(spark, rows).withColumn("y", F.lit(1)).withColumn("label_id", F.lit(2)).withColumn("size", F.lit("x"))
    for module, model in ((toxicity, tox), (quality, qual)):
        got = scores(module, df, model)
        assert len(got) == len(rows) and all(0 <= s <= 1 for s in got)
        assert module.score(frame(spark, [], DOCS), model).count() == 0
    twice = scores(toxicity, frame(spark, rows[17:19]), tox)
    assert twice[0] == twice[1]


def test_sum_of_squares_identity():
    """The linear-time score equals the sum over all pairs."""
    r = np.random.default_rng(1)
    model = {"w": r.normal(size=quality._SIZE), "v": r.normal(size=(quality._SIZE, quality.RANK)), "b": 0.3}
    feature = r.choice(quality._SIZE, 12, replace=False)
    value = r.random(12)
    z, _, _ = quality._sums(model, feature, value, np.array([0, 5]))
    for row, want in ((slice(0, 5), z[0]), (slice(5, 12), z[1])):
        f, x = feature[row], value[row]
        pairs = sum(model["v"][f[i]] @ model["v"][f[j]] * x[i] * x[j] for i in range(len(f)) for j in range(i))
        assert 0.3 + model["w"][f] @ x + pairs == pytest.approx(want)


def test_no_labels_or_one_kind(spark):
    docs, labels = labelled(60)
    df = frame(spark, docs)
    none = spark.createDataFrame([], LABELS)
    assert set(scores(quality, df, quality.train(df, none))) == {0.5}
    assert max(scores(toxicity, df, toxicity.train(df, none))) < 1e-6
    one = spark.createDataFrame([(i, 1, 0) for i, _, _ in labels] + [(None, None, None), (5, None, 7)], LABELS)
    assert min(scores(quality, df, quality.train(df, one))) > 0.99
    assert max(scores(toxicity, df, toxicity.train(df, one))) < 1e-6


def test_sample_is_bounded_and_contradictions_count_once(spark):
    docs, labels = labelled(300)
    df = frame(spark, docs + docs[:50])
    lb = spark.createDataFrame(labels + [(i, 1 - q, 1 - t) for i, q, t in labels[:40]], LABELS)
    rows = toxicity.sample(df, lb, "toxic", held_out(F.col("label_id"), 3, 1), 40, toxicity._extract,
                           "y int, features binary, terms string", [F.col("text").alias("text")])
    assert len(rows) == 40
    few = toxicity.sample(df, lb, "toxic", held_out(F.col("label_id"), 3, 1), 40, toxicity._extract,
                          "y int, features binary, terms string", [F.col("text").alias("text")], max_bytes=5000)
    sizes = rows["features"].str.len() + rows["terms"].str.encode("utf-8").str.len()
    assert 0 < len(few) < 40 and few["features"].str.len().sum() <= 5000 < sizes.sum()
