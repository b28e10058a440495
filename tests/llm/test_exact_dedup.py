import hashlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from cartwright.llm.exact_dedup import ContentTable, exact_dedup

from .helpers import DOCS, awkward_docs, frame, words

STRIP = str.maketrans("", "", " \t\n\x0b\x0c\r")


def brute(rows):
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[(r[1] or "").translate(STRIP)].append(i)
    out = []
    for content, members in groups.items():
        best = min(members, key=lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0] or 0, i))
        sha = hashlib.sha256(content.encode()).hexdigest()
        out += [(rows[i][0], rows[best][0], len(members), i == best, sha) for i in members]
    return Counter(out)


def result(df, **how):
    got = exact_dedup(df, **how).membership()
    return Counter(tuple(r) for r in got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())


def test_awkward_rows_match_brute_force(spark):
    rows = awkward_docs()
    assert result(frame(spark, rows)) == brute(rows)


def test_recursive_partitioning_of_small_buckets(spark):
    rows = [(i, words(5 + i % 40, i % 90), "en", "s", 1) for i in range(400)]
    df = frame(spark, rows).repartition(7)
    assert result(df, collapse_bytes=2000, bucket_bytes=300) == brute(rows)


def test_hot_group_of_a_third_of_all_rows(spark):
    rows = [(i, "the same text" if i % 3 == 0 else words(6, i), "en", "s", 1) for i in range(900)]
    assert result(frame(spark, rows).repartition(5), collapse_bytes=4000) == brute(rows)


def test_kept_rows_are_whole_and_unique(spark):
    rows = awkward_docs()
    df = frame(spark, rows).withColumn("rk", F.lit("x")).withColumn("row", F.lit(1)).withColumn("sha", F.lit(None))
    kept = exact_dedup(df).kept()
    assert kept.columns == df.columns
    want = Counter((k[0], k[4]) for k, n in brute(rows).items() for _ in range(n) if k[3])
    got = Counter((r.doc_id, hashlib.sha256((r.text or "").translate(STRIP).encode()).hexdigest()) for r in kept.collect())
    assert got == want
    assert {r.rk for r in kept.collect()} == {"x"}


def test_empty_table(spark):
    df = frame(spark, [], DOCS)
    assert exact_dedup(df).membership().count() == 0
    assert exact_dedup(df).kept().columns == df.columns


def test_table_compares_content_not_hashes():
    t = ContentTable(slots=2)
    seen = [t.find_or_add(7, c)[0] for c in (b"a", b"b", b"a", b"c", b"b", b"d")]
    assert seen == [0, 1, 0, 2, 1, 3]
    assert t.find_or_add(7 + len(t.slots), b"a") == (4, True)
