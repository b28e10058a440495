"""Exact deduplication by Grace hash partitioning.

Two texts are copies when they are identical after deleting white space.

1. *Collapse.* Every task runs its rows, a bounded number of bytes at a time,
   through an open-addressing table that compares complete content. One
   representative per content leaves with its text, the other rows leave as
   short membership records. A content that a third of all rows share is
   therefore shuffled once per task and flush, not once per row.
2. *Partition.* Representatives are partitioned by the leading bits of a 64-bit
   hash. Buckets whose distinct content exceeds ``bucket_bytes`` are split by
   further bits, again and again, until each fits or holds one hash only. The
   plan of the recursion is made on (hash, length) pairs, so the texts move
   through Spark's shuffle files once, straight into their final bucket.
3. *Table.* Each bucket streams through one open-addressing table that compares
   complete content; only distinct contents are held.
4. Group sizes and the staying row are combined with partial aggregation.

Defined cases: a null text is empty; empty texts form one group; of equal texts
the row with most code points stays, then the smallest doc_id (null last), then
the earliest row; rows repeated with the same doc_id are separate rows, one of
which stays; an empty table gives an empty result; other columns are untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACES, materialize, whole_row

COLLAPSE_BYTES = 48 << 20
BUCKET_BYTES = 32 << 20
SPLIT_BITS = 4
_DELETE = SPACES.encode()


class ContentTable:
    """Open addressing with linear probing; equality is of complete content."""

    def __init__(self, slots: int = 1024) -> None:
        self.mask = slots - 1
        self.slots = [-1] * slots
        self.hashes: list[int] = []
        self.contents: list[bytes] = []

    def find_or_add(self, h: int, content: bytes) -> tuple[int, bool]:
        """Index of ``content`` in order of first sight, and whether it is new."""
        at = h & self.mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == h and self.contents[entry] == content:
                return entry, False
            at = (at + 1) & self.mask
        entry = self.slots[at] = len(self.hashes)
        self.hashes.append(h)
        self.contents.append(content)
        if 5 * len(self.hashes) > 3 * len(self.slots):
            self._grow()
        return entry, True

    def _grow(self) -> None:
        self.mask = 2 * len(self.slots) - 1
        self.slots = [-1] * (self.mask + 1)
        for entry, h in enumerate(self.hashes):
            at = h & self.mask
            while self.slots[at] >= 0:
                at = (at + 1) & self.mask
            self.slots[at] = entry


def _content(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass").translate(None, _DELETE)


def _preference(cp: int, doc_id: int | None, rk: int) -> tuple:
    return (-cp, doc_id is None, doc_id if doc_id is not None else 0, rk)


def _collapse(batches: Iterator[pa.RecordBatch], limit: int, id_col: str, text_col: str) -> Iterator[pa.RecordBatch]:
    def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(held).combine_chunks()
        rows = pc.struct_field(whole["row"], [text_col]), pc.struct_field(whole["row"], [id_col])
        texts, ids = rows[0], rows[1].to_pylist()
        rk, cp, h = (whole[c].to_pylist() for c in ("rk", "cp", "h"))
        contents = ContentTable()
        entry_of, best, count = [], [], []
        for i, x in enumerate(h):
            entry, new = contents.find_or_add(x, _content(texts[i].as_py()))
            entry_of.append(entry)
            if new:
                best.append(i)
                count.append(1)
            else:
                count[entry] += 1
                j = best[entry]
                if _preference(cp[i], ids[i], rk[i]) < _preference(cp[j], ids[j], rk[j]):
                    best[entry] = i
        is_rep = [best[e] == i for i, e in enumerate(entry_of)]
        payload = pc.if_else(pa.array(is_rep), whole["row"], pa.scalar(None, whole["row"].type))
        out = pa.table({
            "rk": whole["rk"], "rep": pa.array([rk[best[e]] for e in entry_of], pa.int64()),
            "doc_id": pa.array(ids, pa.int64()), "cp": whole["cp"], "h": whole["h"], "sha": whole["sha"],
            "n": pa.array([count[e] if r else None for e, r in zip(entry_of, is_rep)], pa.int64()),
            "row": payload,
        })
        yield from out.to_batches(max_chunksize=2000)

    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= limit:
            yield from flush(held)
            held, size = [], 0
    if held:
        yield from flush(held)


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream buckets, one after another, through their tables."""
    bucket, contents, firsts = None, ContentTable(), []
    for b in batches:
        classes = []
        for bits, prefix, h, text, rep in zip(*(b[c].to_pylist() for c in ("bits", "prefix", "h", "text", "rep"))):
            if (bits, prefix) != bucket:
                bucket, contents, firsts = (bits, prefix), ContentTable(), []
            entry, new = contents.find_or_add(h, _content(text))
            if new:
                firsts.append(rep)
            classes.append(firsts[entry])
        yield pa.RecordBatch.from_pydict({
            "rep": b["rep"], "class": pa.array(classes, pa.int64()), "doc_id": b["doc_id"], "cp": b["cp"], "n": b["n"],
        })


def _bucketed(reps: DataFrame, bucket_bytes: int) -> DataFrame:
    """Add ``bits`` and ``prefix``: the bucket a representative ends up in."""
    sizes = reps.groupBy("h").agg(F.max("len").alias("len"))
    total = sizes.agg(F.sum("len")).first()[0] or 0
    bits = max(4, (2 * total // bucket_bytes).bit_length())
    prefix = lambda b: F.shiftrightunsigned("h", 64 - b)
    reps = reps.withColumn("bits", F.lit(bits)).withColumn("prefix", prefix(bits))
    sizes = sizes.withColumn("prefix", prefix(bits))
    while bits + SPLIT_BITS < 64:
        big = (sizes.groupBy("prefix").agg(F.sum("len").alias("bytes"), F.count("*").alias("hashes"))
               .filter((F.col("bytes") > bucket_bytes) & (F.col("hashes") > 1)).select(F.col("prefix").alias("big")))
        big = materialize(big, "dedup-oversize")
        if big.isEmpty():
            break
        deeper = bits + SPLIT_BITS
        split = (F.col("bits") == bits) & F.col("big").isNotNull()
        reps = (reps.join(big, F.col("prefix") == F.col("big"), "left")
                .withColumn("prefix", F.when(split, prefix(deeper)).otherwise(F.col("prefix")))
                .withColumn("bits", F.when(split, F.lit(deeper)).otherwise(F.col("bits"))).drop("big"))
        sizes = sizes.join(big, F.col("prefix") == F.col("big"), "left_semi").withColumn("prefix", prefix(deeper))
        bits = deeper
    return reps


class Dedup:
    """The result of :func:`exact_dedup`; every frame reads committed files."""

    def __init__(self, rows: DataFrame, classes: DataFrame, schema: T.StructType) -> None:
        self._rows, self._classes, self._schema = rows, classes, schema

    def membership(self) -> DataFrame:
        """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
        members = self._rows.select("rk", "rep", "doc_id", "sha")
        return (members.join(self._classes, "rep")
                .select("doc_id", "keep_id", "group_size", (F.col("rk") == F.col("best_rep")).alias("kept"),
                        F.col("sha").alias("text_sha256")))

    def kept(self) -> DataFrame:
        """The rows that stay, with all columns of the input."""
        stay = self._classes.filter(F.col("rep") == F.col("best_rep")).select("rep")
        rows = self._rows.filter("rk = rep").select("rep", "row").join(stay, "rep", "left_semi")
        return rows.select(*[F.col("row").getField(f.name).alias(f.name) for f in self._schema])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                collapse_bytes: int = COLLAPSE_BYTES, bucket_bytes: int = BUCKET_BYTES) -> Dedup:
    """Group the rows of ``docs`` whose texts are equal but for white space."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    keyed = (docs.select(whole_row(docs).alias("row"), F.length(text).cast("long").alias("cp"),
                         F.translate(text, SPACES, "").alias("content"))
             .select("row", "cp", F.xxhash64("content").alias("h"), F.sha2("content", 256).alias("sha"),
                     F.monotonically_increasing_id().alias("rk")))
    schema = T.StructType([
        T.StructField("rk", T.LongType()), T.StructField("rep", T.LongType()), T.StructField("doc_id", T.LongType()),
        T.StructField("cp", T.LongType()), T.StructField("h", T.LongType()), T.StructField("sha", T.StringType()),
        T.StructField("n", T.LongType()), T.StructField("row", keyed.schema["row"].dataType, True),
    ])
    rows = materialize(keyed.mapInArrow(lambda it: _collapse(it, collapse_bytes, id_col, text_col), schema),
                       "dedup-rows")
    reps = rows.filter("rk = rep").select(
        "rep", "doc_id", "cp", "n", "h", F.col("row").getField(text_col).alias("text"),
        F.col("cp").alias("len"))
    bucketed = (_bucketed(reps, bucket_bytes).repartition("bits", "prefix").sortWithinPartitions("bits", "prefix")
                .select("bits", "prefix", "h", "text", "rep", "doc_id", "cp", "n"))
    found = materialize(bucketed.mapInArrow(_match, "rep long, class long, doc_id long, cp long, n long"),
                        "dedup-classes")
    order = F.struct((-F.col("cp")).alias("c"), F.col("doc_id").isNull().alias("u"), F.col("doc_id").alias("d"),
                     F.col("rep").alias("r"))
    best = found.groupBy("class").agg(F.sum("n").alias("group_size"), F.min(order).alias("best"))
    classes = found.select("rep", "class").join(best, "class").select(
        "rep", "group_size", F.col("best.d").alias("keep_id"), F.col("best.r").alias("best_rep"))
    return Dedup(rows, classes, docs.schema)
