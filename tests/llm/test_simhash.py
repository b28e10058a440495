import random
from collections import Counter

from xxhash import xxh64_intdigest

from cartwright.llm import simhash
from cartwright.llm.simhash import fingerprint_of, links, one_of_each, simhash_components

from .helpers import awkward_docs, frame, words


def brute_fingerprint(text, shingle=4):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    tokens, word = [], ""
    for c in lower + " ":
        if c in " \t\n\x0b\x0c\r":
            tokens += [word] if word else []
            word = ""
        else:
            word += c
    if not tokens:
        return 0
    grams = [tokens[i:i + shingle] for i in range(max(1, len(tokens) - shingle + 1))]
    hashes = [xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, max_bits):
    """Label of each position: smallest reachable position."""
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(fps):
            for j, b in enumerate(fps):
                if (a ^ b).bit_count() <= max_bits and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_fingerprints_match_brute_force():
    texts = [r[1] for r in awkward_docs()] + ["one two", "ONE two THREE four", "Ärger ÄRGER x y", words(700, 9)]
    for t in texts:
        if not t or len(t) < 20000:
            assert fingerprint_of(t, 4) == brute_fingerprint(t)


def test_long_text_in_chunks(monkeypatch):
    text = words(3000, 5)
    want = fingerprint_of(text, 4)
    monkeypatch.setattr(simhash, "_CHUNK", 100)
    assert fingerprint_of(text, 4) == want == brute_fingerprint(text)


def test_components_of_awkward_rows(spark):
    rows = awkward_docs()
    got = simhash_components(frame(spark, rows))
    fps = [fingerprint_of(r[1], 4) for r in rows]
    label = brute_components(fps, 4)
    lowest = {c: min((r[0] for r, x in zip(rows, label) if x == c and r[0] is not None), default=None) for c in set(label)}
    want = Counter((r[0], f, lowest[x]) for r, f, x in zip(rows, fps, label))
    assert Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got.collect()) == want


def planted(n_chains, seed):
    """Random fingerprints, chains of near ones, and a dense cluster."""
    r = random.Random(seed)
    fps = [r.getrandbits(64) for _ in range(200)] + [0, 1, (1 << 64) - 1]
    for _ in range(n_chains):
        f = r.getrandbits(64)
        for _ in range(r.randrange(2, 7)):
            fps.append(f)
            for b in r.sample(range(64), r.randrange(1, 6)):
                f ^= 1 << b
    centre = r.getrandbits(64)
    fps += [centre ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for _ in range(60)]
    return sorted(set(fps))


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def components_of(spark, fps, max_bits, **how):
    edges = links(spark.createDataFrame([(signed(f),) for f in fps], "fp long"), max_bits, **how).collect()
    at = {signed(f): i for i, f in enumerate(fps)}
    for e in edges:
        assert ((e.a ^ e.b) & ((1 << 64) - 1)).bit_count() <= max_bits
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for e in edges:
        a, b = sorted((root(at[e.a]), root(at[e.b])))
        label[b] = a
    return [root(i) for i in range(len(fps))], len(edges)


def test_no_link_is_lost(spark):
    for max_bits in (4, 1):
        fps = planted(30, max_bits)
        got, _ = components_of(spark, fps, max_bits)
        assert got == brute_components(fps, max_bits)


def test_reach_of_more_than_one_cell(spark, monkeypatch):
    """With 4 wide segments there are fewer groups than bits: cells in reach."""
    monkeypatch.setattr(simhash, "SEGMENT_BITS", 32)
    fps = planted(30, 7)
    got, _ = components_of(spark, fps, 4)
    assert got == brute_components(fps, 4)


def test_split_cells_lose_nothing_and_stay_small(spark):
    fps = planted(20, 11)
    got, n = components_of(spark, fps, 4, cell_rows=10)
    assert got == brute_components(fps, 4)


def test_dense_cell_gives_a_forest(spark):
    base = (1 << 63) | 12345
    fps = sorted({base ^ (1 << i) ^ (1 << j) for i in range(30) for j in range(30) if i != j} | {base})
    got, n = components_of(spark, fps, 4)
    assert set(got) == {0} and n < 5 * len(fps)


def test_one_of_each(spark):
    rows = awkward_docs()
    df = frame(spark, rows)
    kept = one_of_each(df)
    assert kept.columns == df.columns
    fps = [fingerprint_of(r[1], 4) for r in rows]
    label = brute_components(fps, 4)
    want = Counter()
    for c in set(label):
        members = [i for i, x in enumerate(label) if x == c]
        want[rows[min(members, key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))][0]] += 1
    assert Counter(r.doc_id for r in kept.collect()) == want
    assert one_of_each(df.limit(0)).count() == 0
