"""The pipeline against brute force, stage by stage, on a small corpus."""

import random
from collections import Counter

import pytest
import public_tokenizers

import corpus_pipeline as pipeline

from .helpers import DOCS, awkward_docs, words
from .test_exact_dedup import STRIP
from .test_mixing import brute_targets, size_of
from .test_packing import check as check_packing
from .test_simhash import brute_components, fingerprint_of


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    r = random.Random(0)
    rows, labels = [], []
    for i in range(240):
        text = words(r.randrange(40, 120), i)
        good = int(i % 5 != 0)
        if not good:
            text = r.choice([text.upper() + "!!", " | ".join(text.split()), (text.split()[0] + " ") * 80])
        elif i % 7 == 3:
            text = rows[i - 3][1] if i % 5 != 3 else text
        elif i % 11 == 4 and rows:
            text = " ".join(rows[1][1].split()[:-1] + ["changed"])
        rows.append((1000 + i, text, "en", f"s{i % 3}", len(text)))
        labels.append((1000 + i, good, 0))
    rows += awkward_docs()
    spark.createDataFrame(rows, DOCS).write.parquet(str(root / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(root / "labels.parquet"))
    return str(root), rows


def test_stages(spark, corpus):
    root, rows = corpus
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns, seen = docs.columns, [tuple(r) for r in docs.collect()]
    out = {}
    for name, stage in pipeline.STAGES:
        docs = pipeline.materialize(stage(spark, docs, root), "test-stage")
        out[name] = [tuple(r) for r in docs.collect()]
        if name != "best-fit packing":
            assert docs.columns == columns
    # quality: rows are kept whole or dropped; bad structure goes, clean text stays
    kept = Counter(out["quality classifier"])
    assert not kept - Counter(seen)
    clean = [r for r in rows if r[0] is not None and r[0] >= 1000 and (r[0] - 1000) % 5 != 0]
    bad = [r for r in rows if r[0] is not None and r[0] >= 1000 and (r[0] - 1000) % 5 == 0]
    assert all(kept[r] for r in clean) and sum(kept[r] for r in bad) <= 0.1 * len(bad)
    # exact dedup: one row per normalised text, the longest, then the smallest id
    groups = {}
    for r in out["quality classifier"]:
        groups.setdefault((r[1] or "").translate(STRIP), []).append(r)
    best = [min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0)) for g in groups.values()]
    assert Counter(out["exact dedup"]) == Counter(best)
    # simhash: one row per component, the smallest id
    fps = [fingerprint_of(r[1], 4) for r in out["exact dedup"]]
    label = brute_components(fps, 4)
    first = {}
    for r, c in zip(out["exact dedup"], label):
        first[c] = min(first.get(c, r), r, key=lambda r: (r[0] is None, r[0] or 0))
    assert Counter(out["simhash near-dedup"]) == Counter(first.values())
    # mixing: whole rows, at most twice, near the targets
    sizes, taken, biggest = Counter(), Counter(), Counter()
    for r in out["simhash near-dedup"]:
        sizes[r[3]] += size_of(r[1])
        biggest[r[3]] = max(biggest[r[3]], size_of(r[1]))
    for r, n in Counter(out["mixing sources"]).items():
        assert n <= 2 and r in set(out["simhash near-dedup"])
        taken[r[3]] += n * size_of(r[1])
    target = brute_targets(dict(sizes))
    assert all(abs(taken[s] - target[s]) <= max(1, biggest[s]) for s in sizes)
    # packing: every token of every taken row, no gap
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    check_packing(out["mixing sources"], docs.collect(), tokenizer, 2048)


def test_run_gives_the_last_stage(spark, corpus):
    got = pipeline.run(spark, corpus[0])
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert got.count() > 0


def test_empty_documents_and_clashing_columns(spark, corpus, tmp_path):
    root, rows = corpus
    clash = ["score", "row", "rk", "rep", "fp", "component", "size", "taken", "piece"]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", *[f"'x' AS {c}" for c in clash])
    empty = docs.limit(0)
    for name, stage in pipeline.STAGES:
        assert stage(spark, empty, root).count() == 0
        got = stage(spark, docs, root)
        if name != "best-fit packing":
            assert got.columns == docs.columns and got.filter("score <> 'x' OR rk <> 'x'").count() == 0
