"""Small tables with every awkward row the operators must define."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "river stone under early light moves along quiet paths while people carry water home before noon talk bread".split()


def words(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", ",", "ing", "ed"]) for _ in range(n))


def awkward_docs():
    """Nulls in any column, empty, blank and long texts, ties, repeated rows."""
    rows = [(i, words(20 + i, i), "en", f"src{i % 3}", 100 + i) for i in range(12)]
    rows += [
        (20, None, "en", "src0", None), (21, "", None, "src1", 0), (22, " \t\n ", "en", None, 4), (23, "one", "en", "src0", 3),
        (24, words(20, 0), "en", "src2", 100), (25, words(20, 0).replace(" ", "\n "), "en", "src2", 100),
        (25, words(20, 0).replace(" ", "\n "), "en", "src2", 100), (None, words(20, 0), "en", "src1", 9),
        (None, None, None, None, None), (26, words(9000, 3), "en", "src0", 1), (27, words(9000, 3) + " end", "en", "src0", 1),
        (28, "ünïcödé ✓   " + words(30, 4), "xx", "Ünï", 1), (29, "a" * 5000, "en", "src0", 5000),
        (30, "ab " * 2000, "en", "src1", 6000), (31, "\x00null\x00 byte", "en", "src1", 9),
    ]
    return rows


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)
