"""Pack tokenised documents into sequences by a configuration linear program.

1. *Pieces.* Every document becomes token ids plus an end id; only longer ones
   are cut, the first piece taking the remainder. A task numbers its pieces of
   each length, so that a piece is known by (length, task, number).
2. *Histogram.* Pieces per length: at most ``capacity`` rows, whatever the data.
3. *Configuration LP.* min sum x_c over configurations c (multisets of lengths
   that fit into a sequence) subject to covering the histogram, solved by
   multiplicative weights: lengths carry prices, a knapsack dynamic program over
   the capacity finds the dearest configurations, their lengths become cheaper.
4. *Rounding.* Configurations that leave no token empty are used floor(x) times,
   never beyond what is left of a length; the rest of the histogram is filled
   best fit, longest first.
   Both act on counts. Every configuration is filled exactly: no gaps.
5. *Seats.* Each length has a table of seat ranges; a piece's rank within its
   length (offset of its task + number in it) is its seat. One pass, no sort, and
   a length that a third of all pieces share is dealt like any other.

The driver holds a histogram of ``capacity`` counts and the configurations,
whose number is bounded by ``ROUNDS`` and the number of lengths.

Defined cases: a null or empty text is the end id alone; repeated rows are
separate documents; a null doc_id stays null; an empty table gives an empty
result.
"""

from __future__ import annotations

import base64
import binascii
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, once_per_worker

ROUNDS = 400
LEVELS = 3
#: White-space runs of this length are cut out before the pattern sees them: its
#: look-ahead tries every shorter run, and fails at about a million.
SPACE_RUN = 1000
#: What the pattern's \s matches (not all that Python's does).
_SPACE = "[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def _encoder(tokenizer: str, ranks: str | None):
    """text -> ids, as ``tokenizer`` (a tokenizers file) gives them.

    ``ranks`` names the same byte-level vocabulary as a rank file; with it text goes
    through the faster of the two libraries, special tokens as the file has them.
    """
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer)
    if ranks is None:
        return lambda text: whole.encode(text, add_special_tokens=False).ids
    import tiktoken

    from public_tokenizers import PATTERN

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    added = whole.get_added_tokens_decoder()
    if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
        raise ValueError("special tokens that take in their surroundings need the tokenizers library: pass no ranks")
    special = {t.content: i for i, t in added.items()}
    fast = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=table, special_tokens=special)
    special_only = re.compile("|".join(map(re.escape, special)) or r"(?!)")
    long_space = re.compile(rf"(?<!{_SPACE}){_SPACE}{{{SPACE_RUN},}}")  # looked for at a run's start only: linear
    three = re.compile(_SPACE + "{3}")  # of every 250th character, in any run of 1000

    def plain(text: str) -> list[int]:
        if len(text) < SPACE_RUN or not three.search(text[::SPACE_RUN // 4]):
            return fast.encode_ordinary(text)
        ids, at = [], 0
        for run in long_space.finditer(text):
            # of a run before other text, all but the last character are one piece
            stop = run.end() - (run.end() < len(text))
            ids += fast.encode_ordinary(text[at:run.start()])
            ids += fast._encode_single_piece(text[run.start():stop])  # noqa: SLF001 - one piece, no pattern
            at = stop
        return ids + fast.encode_ordinary(text[at:]) if at else fast.encode_ordinary(text)

    def encode(text: str) -> list[int]:
        ids, at = [], 0
        for token in special_only.finditer(text):
            ids += plain(text[at:token.start()])
            ids.append(special[token.group()])
            at = token.end()
        return ids + plain(text[at:]) if at else plain(text)

    return encode


def _cut(batches: Iterator[pa.RecordBatch], tokenizer: str, ranks: str | None, end_id: int,
         capacity: int) -> Iterator[pa.RecordBatch]:
    """Text by text: a task holds the ids of one document at a time, and one row a piece."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    encode = once_per_worker(("encoder", tokenizer, ranks), lambda: _encoder(tokenizer, ranks))
    seen = np.zeros(capacity + 1, np.int64)
    names = [c.split()[0] for c in _PIECES.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    out: list[tuple] = []
    for batch in batches:
        for doc_id, text in zip(*batch.columns):
            doc_id = doc_id.as_py()
            flat = np.array([*encode(text.as_py() or ""), end_id], "<u4")
            first = len(flat) % capacity or capacity
            start = 0
            for piece, stop in enumerate(range(first, len(flat) + 1, capacity)):
                length = stop - start
                out.append((doc_id, piece, start, length, binascii.crc32(flat[start:stop].tobytes()), part, int(seen[length])))
                seen[length] += 1
                start = stop
            if len(out) >= 5000:
                yield emit(out)
                out = []
    if out:
        yield emit(out)


def _knapsack(price: np.ndarray, capacity: int) -> np.ndarray:
    """Unbounded knapsack over the capacity: ``last[room]`` is the length to take
    next in the dearest filling of ``room`` (0: leave one token empty).

    ``price`` by length, 0 where there is no piece. Each step is one vector
    operation over the lengths.
    """
    lengths = np.flatnonzero(price)
    values = price[lengths]
    worth = np.zeros(capacity + 1)
    last = np.zeros(capacity + 1, np.int64)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        worth[room] = worth[room - 1]
        if k := upto[room]:
            gain = worth[room - lengths[:k]] + values[:k]
            j = int(gain.argmax())
            if gain[j] > worth[room]:
                worth[room], last[room] = gain[j], lengths[j]
    return last


def _filling(last: list[int], room: int) -> dict[int, int]:
    copies: dict[int, int] = {}
    while room:
        if length := last[room]:
            copies[length] = copies.get(length, 0) + 1
            room -= length
        else:
            room -= 1
    return copies


def solve_lp(counts: np.ndarray, capacity: int, rounds: int = ROUNDS,
             levels: int = LEVELS) -> dict[tuple[tuple[int, int], ...], float]:
    """Configurations ((length, copies), ...) with multiplicities x that cover
    ``counts`` up to the share that ``rounds`` pricings reach.

    Multiplicative weights for the covering programme. The price of a length is
    its size times exp(-its cover above the present level); one knapsack table
    under the prices gives, for every length that is behind, the dearest
    configuration that holds it. Each enters with the step that brings its length
    up to the level, or that takes some other length one level too far; the
    prices follow the cover, and the next pricing begins. When every length has
    reached the level, the level rises.
    """
    need = counts.astype(float)
    lengths = np.flatnonzero(counts)
    covered = np.zeros(len(counts))
    x: dict[tuple, float] = {}
    if not len(lengths):
        return x
    size = np.where(counts > 0, np.arange(len(counts)), 0).astype(float)
    level, rate = 1 / levels, 4.0 * levels
    for _ in range(rounds):
        share = covered[lengths] / need[lengths]
        while level < 1 and share.min() >= level - 1e-9:
            level = min(1.0, level + 1 / levels)
        behind = lengths[share < level - 1e-9][::-1]
        if not len(behind):
            break
        price = size.copy()
        price[lengths] *= np.exp(-rate * np.maximum(0, share - level + 1 / levels))
        last = _knapsack(price, capacity).tolist()
        moved = False
        for length in behind.tolist():
            lack = level * need[length] - covered[length]
            if lack <= 0:
                continue
            copies = _filling(last, capacity - length)
            copies[length] = copies.get(length, 0) + 1
            step = min(lack / copies[length], min((min(1.0, level + 1 / levels) * need[k] - covered[k]) / c
                                                  for k, c in copies.items()))
            if step <= 0:
                continue
            moved = True
            key = tuple(sorted(copies.items()))
            x[key] = x.get(key, 0.0) + step
            for k, c in copies.items():
                covered[k] += step * c
        if not moved:  # what is behind fits with nothing that is left: alone
            for length in behind.tolist():
                if (lack := level * need[length] - covered[length]) > 0:
                    k = capacity // length
                    x[((length, k),)] = x.get(((length, k),), 0.0) + lack / k
                    covered[length] += lack
    return x


def pack_counts(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[np.ndarray, int]]:
    """Configurations (copies per length) and whole multiplicities that use up
    ``counts`` exactly."""
    left = counts.astype(np.int64).copy()
    out = []
    full = lambda c: -sum(k * n for k, n in c[0])
    for config, x in sorted(solve_lp(counts, capacity, rounds).items(), key=lambda c: (full(c), c[0])):
        times = min(int(x + 1e-6), *(int(left[k]) // c for k, c in config))
        if times > 0 and full((config, x)) == -capacity:
            copies = np.zeros_like(left)
            for k, c in config:
                copies[k] = c
            out.append((copies, times))
            left -= times * copies
    while left.any():  # best fit, longest first, on counts
        copies, room = np.zeros_like(left), capacity
        rest = left.copy()
        while room and (fits := np.flatnonzero(rest[: room + 1])).size:
            length = int(fits[-1])
            k = min(int(rest[length]), room // length)
            copies[length] += k
            rest[length] -= k
            room -= k * length
        on = copies > 0
        times = int((left[on] // copies[on]).min())
        out.append((copies, times))
        left -= times * copies
    return out


def _seats(plan: list[tuple[np.ndarray, int]]) -> dict[str, np.ndarray]:
    """Seat ranges by length: rank -> configuration, place in it."""
    rows = []
    base = 0
    for copies, times in plan:
        offset = 0
        for length in np.flatnonzero(copies)[::-1]:
            rows.append((length, times * copies[length], copies[length], base, offset))
            offset += int(copies[length] * length)
        base += times
    names = ("length", "seats", "copies", "base", "offset")
    table = np.array(rows, np.int64).reshape(-1, 5)
    table = table[np.argsort(table[:, 0], kind="stable")]
    cols = dict(zip(names, table.T))
    cum = np.cumsum(cols["seats"]) - cols["seats"]
    first = np.searchsorted(cols["length"], cols["length"])  # first range of the same length
    cols["from"] = cum - cum[first] if len(cum) else cum
    return cols


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = 2048, end_id: int = 0, rounds: int = ROUNDS) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    pieces = materialize(texts.mapInArrow(lambda it: _cut(it, tokenizer, ranks, end_id, capacity), _PIECES),
                         "pack-pieces")
    by_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[r["length"]] = r["n"]
    seats = spark.sparkContext.broadcast(_seats(pack_counts(counts, capacity, rounds)))
    run = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = by_part.select("length", "part", F.coalesce(F.sum("n").over(run), F.lit(0)).alias("ahead"))
    ranked = pieces.join(ahead, ["length", "part"])

    def seat(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = seats.value
        starts = s["from"]
        bounds = {int(x): (int(np.searchsorted(s["length"], x)), int(np.searchsorted(s["length"], x, side="right")))
                  for x in np.unique(s["length"])}
        for df in batches:
            length = df["length"].to_numpy(np.int64)
            rank = df["ahead"].to_numpy(np.int64) + df["nth"].to_numpy(np.int64)
            at = np.empty(len(df), np.int64)
            for x in np.unique(length):
                lo, hi = bounds[int(x)]
                on = length == x
                at[on] = lo + np.searchsorted(starts[lo:hi], rank[on], side="right") - 1
            within = rank - s["from"][at]
            yield pd.DataFrame({
                **{c: df[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")},
                "sequence_id": s["base"][at] + within // s["copies"][at],
                "offset": s["offset"][at] + within % s["copies"][at] * length,
            }).astype({"doc_id": "Int64"})

    return ranked.mapInPandas(
        seat, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
