"""Mix sources to target weights with hash-threshold histograms (DataFrame only).

Every document gets a fixed 60-bit hash of its content. A source's mix is "all
of its documents ``whole`` times, and once more those with a hash below its
threshold", so a smaller target is always a subset of a larger one and no sort
of the documents is needed. Thresholds come from histograms: words are summed
by (source, leading hash bits); the bucket in which the running sum crosses the
budget is the only one that is refined by the next bits, until every boundary
bucket holds a single hash. Its documents, copies of one row as a rule, go in one by
one as long as that is nearer to the budget: they are counted by task, and only the
task in which the count is reached numbers its own. A histogram has at most
``2**LEVEL_BITS`` rows per source, however many documents a source holds; sums are
combined before the shuffle. So the words of a source come within half a document of
its target.

Targets: sources in code-point order (null last) weigh ``weights``, repeating,
and share ``share`` times all words; none takes more than ``cap`` times its own
words, the excess goes to the others by weight (water-filling, closed form over
the one-row-per-source table).

Defined cases: a null or blank text has size 0 and takes 0; a null source is a
source of its own; rows equal in id, source and text share one hash, and where that
is at the boundary some of them are taken once more than others; with no words at all every target is 0; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialize, whole_row

HASH_BITS = 60
LEVEL_BITS = 12
WEIGHTS = (3, 1, 2)


def n_words(text: Column) -> Column:
    """Words of a text: each becomes one character, white space goes."""
    shrunk = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "x")
    return F.length(F.translate(shrunk, " \t\n\x0b\x0c\r", "")).cast("long")


def _hash(doc_id: Column, source: Column, text: Column) -> Column:
    parts = F.concat_ws("\x1f", doc_id.cast("string"), F.md5(F.coalesce(text, F.lit(""))), source)
    return F.conv(F.substring(F.md5(parts), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], share: tuple[int, int], cap: int) -> DataFrame:
    """``sizes`` (source, source_size), one row per source -> with ``target``.

    A source is full when cap * size <= weight * level, where the level is what
    is left for it and all sources with a higher cap/weight ratio, per weight.
    Integers up to the last division keep this exact in any engine.
    """
    num, den = share
    order = Window.orderBy(F.col("source").isNull(), "source")
    pick = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    w = sizes.withColumn("weight", pick.cast("long"))
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), "weight", F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    w = (w.withColumn("total", F.sum("source_size").over(everything))
         .withColumn("filled", F.coalesce(F.sum("source_size").over(before), F.lit(0)))
         .withColumn("open", F.sum("weight").over(rest)))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    w = w.withColumn("full", wide("source_size") * wide("open") * (cap * den)
                     <= wide("weight") * (num * F.col("total") - cap * den * F.col("filled")).cast("decimal(19,0)"))
    w = (w.withColumn("taken_up", F.sum(F.when(F.col("full"), F.col("source_size")).otherwise(0)).over(everything))
         .withColumn("open_weight", F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(everything)))
    left = num * F.col("total") - cap * den * F.col("taken_up")
    level = (F.col("weight") * left).cast("double") / (den * F.col("open_weight")).cast("double")
    return w.select("source", "source_size",
                    F.when(F.col("full"), (cap * F.col("source_size")).cast("double")).otherwise(level).alias("target"))


def _thresholds(slim: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source: whole copies, the hash below which one more is taken (``cut``), and of
    how many rows with that very hash (``more``)."""
    has = F.col("source_size") > 0
    state = goals.select(
        "source", "target", "source_size",
        F.when(has, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("whole"))
    state = state.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    # low: first hash of the boundary bucket; used: words below it.
    state = state.withColumn("low", F.lit(0).cast("long")).withColumn("used", F.lit(0).cast("long"))
    words = slim.filter("size > 0").select("source", "h", "size")
    bits = 0
    while bits < HASH_BITS:
        bits = min(HASH_BITS, bits + LEVEL_BITS)
        width, outer = 1 << (HASH_BITS - bits), 1 << (HASH_BITS - bits + LEVEL_BITS)
        edge = state.select(F.col("source").alias("s"), "low", "used", "budget")
        inside = words.join(edge, F.col("source").eqNullSafe(F.col("s"))).filter(
            (F.col("h") >= F.col("low")) & (F.col("h") < F.col("low") + outer)).drop("s")
        bucket = (F.col("h") - F.col("h") % width).alias("bucket")
        hist = inside.groupBy("source", "low", "used", "budget", bucket).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"), F.min("h").alias("h0"), F.max("h").alias("h1"))
        run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.withColumn("start", F.col("used") + F.coalesce(F.sum("words").over(run), F.lit(0)))
        # the boundary: the last bucket that starts within the budget
        found = (hist.filter(F.col("start") <= F.col("budget")).groupBy("source")
                 .agg(F.max(F.struct("bucket", "start", "words", "rows", "h0", "h1")).alias("b"))
                 .select(F.col("source").alias("s"), F.col("b.bucket").alias("low2"), F.col("b.start").alias("used2"),
                         F.col("b.words").alias("words"), F.col("b.rows").alias("rows"), F.col("b.h0").alias("h0"),
                         F.col("b.h1").alias("h1")))
        state = materialize(
            state.select("source", "target", "source_size", "whole", "budget", "low", "used")
            .join(found, F.col("source").eqNullSafe(F.col("s")), "left")
            .withColumn("low", F.coalesce("low2", "low")).withColumn("used", F.coalesce("used2", "used"))
            .drop("s", "low2", "used2"), "mix-threshold")
        if state.filter("h0 < h1").isEmpty():
            break
    # of the rows with the boundary hash, all of one size but for a hash collision, so many
    each = F.col("words") / F.col("rows")
    more = F.least(F.floor((F.col("budget") - F.col("used")) / each + 0.5), F.col("rows"))
    return state.select(F.col("source").alias("s"), "source_size", "target", "whole", F.coalesce("h0", F.lit(-1)).alias("cut"),
                        F.greatest(F.coalesce(more, F.lit(0)), F.lit(0)).cast("long").alias("more"))


def _first_copies(edge: DataFrame) -> DataFrame:
    """Rows with their source's boundary hash -> with ``extra``, 1 for ``more`` of them.

    Rows are counted by (source, part), part being the task that wrote them; only where
    the count ends within a part are rows numbered, by their place in it."""
    by_part = edge.groupBy("s", "part").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("s").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = by_part.select(F.col("s").alias("s2"), F.col("part").alias("part2"), "n",
                           F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("ahead"))
    rows = edge.join(ahead, F.col("s").eqNullSafe(F.col("s2")) & (F.col("part") == F.col("part2"))).drop("s2", "part2")
    left = F.col("more") - F.col("ahead")
    within = (left > 0) & (left < F.col("n"))
    place = F.row_number().over(Window.partitionBy("s", "part").orderBy("uid"))
    numbered = rows.filter(within).withColumn("extra", (place <= left).cast("int"))
    return rows.filter(~within).withColumn("extra", (left > 0).cast("int")).unionByName(numbered)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = (3, 2), cap: int = 2,
                carry: bool = False) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (and ``row``, the
    whole input row, with ``carry``). ``share`` is a fraction (3, 2) = 150 %."""
    doc_id, text, source = (F.col(f"`{c}`") for c in (id_col, text_col, source_col))
    slim = docs.select(doc_id.alias("doc_id"), source.alias("source"), n_words(text).alias("size"),
                       _hash(doc_id, source, text).alias("h"),
                       F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("uid"),
                       *([whole_row(docs).alias("row")] if carry else []))
    slim = materialize(slim, "mix-slim")
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = materialize(targets(sizes, weights, share, cap), "mix-targets")
    cuts = materialize(_thresholds(slim.select("source", "size", "h"), goals), "mix-cuts")
    rows = slim.join(cuts, F.col("source").eqNullSafe(F.col("s")))
    at_edge = (F.col("h") == F.col("cut")) & (F.col("size") > 0)
    clear = rows.filter(~at_edge).withColumn("extra", (F.col("h") < F.col("cut")).cast("int"))
    edge = _first_copies(rows.filter(at_edge)).select(*clear.columns)
    taken = F.col("size") * (F.col("whole") + F.col("extra"))
    return clear.unionByName(edge).select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"), *(["row"] if carry else []))


def repeated(mixed: DataFrame) -> DataFrame:
    """The documents of a mix made with ``carry``, each as often as it is taken.
    Documents without words add nothing to a mix and are not part of it."""
    times = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0).cast("int")
    rows = mixed.filter(times > 0).select(F.explode(F.array_repeat("row", times)).alias("row"))
    return rows.select("row.*")
