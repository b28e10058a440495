"""Preference formatting of chosen and rejected conversations (DataFrame only).

The turns on which both sides agree, up to the first on which they do not, are
the prompt and are rendered once; what follows are two completions, of which only
the assistant's turns count for the loss.

The longest common prefix needs no gathered conversation: rows are grouped by
(pair, turn, role, text) with partial aggregation; a row that one side lacks
differs, and the prefix ends before the smallest such turn of its pair. The result
has one row per rendered turn, in (pair_id, part, turn) order when sorted, so that
a conversation of any length is spread over tasks like any other rows.

Defined cases: rows without pair, side or turn have no place and are left out;
rows repeated within a side count once; several rows with one turn number are one
step, equal when all its rows are; a null text or role is empty; identical sides
give a prompt and no completions; sides without a common first turn give no
prompt; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

HEADER = "<|{role}|>\n"
END = "\n<|end|>\n"


def _header(role: Column, template: str) -> Column:
    before, _, after = template.partition("{role}")
    return F.concat(F.lit(before), role, F.lit(after))


def preference_segments(turns: DataFrame, header: str = HEADER, end: str = END,
                        learns: str = "assistant") -> DataFrame:
    """``turns`` (pair_id, side 'chosen' | 'rejected', turn, role, text) ->
    pair_id, part 'prompt' | 'chosen' | 'rejected', turn, role, rendered, body_start
    (code points of the header), loss (1: the body counts for the loss), n_prompt
    (first turn behind the prompt, null when the sides agree throughout)."""
    rows = turns.select("pair_id", "side", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.filter(F.col("pair_id").isNotNull() & F.col("turn").isNotNull() & F.col("side").isin("chosen", "rejected"))
    has = lambda side: F.max(F.col("side") == side).alias(side)
    steps = rows.groupBy("pair_id", "turn", "role", "text").agg(has("chosen"), has("rejected"))
    differs = ~(F.col("chosen") & F.col("rejected"))
    split = steps.groupBy("pair_id").agg(F.min(F.when(differs, F.col("turn"))).alias("n_prompt"))
    prompt = F.col("n_prompt").isNull() | (F.col("turn") < F.col("n_prompt"))
    parts = F.when(prompt, F.array(F.lit("prompt"))).otherwise(F.array_compact(F.array(
        F.when(F.col("chosen"), F.lit("chosen")), F.when(F.col("rejected"), F.lit("rejected")))))
    head = _header(F.col("role"), header)
    return (steps.join(split, "pair_id").withColumn("part", F.explode(parts))
            .select("pair_id", "part", "turn", "role", F.concat(head, F.col("text"), F.lit(end)).alias("rendered"),
                    F.length(head).cast("long").alias("body_start"),
                    ((F.col("part") != "prompt") & (F.col("role") == learns)).cast("int").alias("loss"), "n_prompt"))


def preference_examples(segments: DataFrame) -> DataFrame:
    """The segments of each pair as one row: pair_id, prompt, chosen, rejected
    (texts, empty if there is nothing), and chosen_loss, rejected_loss: the spans
    (start, stop in code points) that count for the loss, the end mark included.
    For conversations that fit a row, as a training example has to."""
    one = F.struct("turn", "role", "rendered", "body_start", "loss")
    side = lambda part: F.sort_array(F.collect_list(F.when(F.col("part") == part, one))).alias(part)
    rows = segments.groupBy("pair_id").agg(side("prompt"), side("chosen"), side("rejected"))
    text = lambda part: F.array_join(F.transform(part, lambda x: x["rendered"]), "").alias(part)

    def spans(part: str) -> Column:
        none = F.array().cast("array<struct<start:bigint,stop:bigint>>")

        def add(seen: Column, x: Column) -> Column:
            stop = seen["at"] + F.length(x["rendered"])
            span = F.array(F.struct((seen["at"] + x["body_start"]).alias("start"), stop.alias("stop")))
            return F.struct(stop.alias("at"),
                            F.when(x["loss"] == 1, F.concat(seen["spans"], span)).otherwise(seen["spans"]).alias("spans"))

        start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans"))
        return F.aggregate(part, start, add)["spans"].alias(f"{part}_loss")

    return rows.select("pair_id", text("prompt"), text("chosen"), text("rejected"), spans("chosen"), spans("rejected"))


def swapped_replies(conversations: DataFrame) -> DataFrame:
    """Pairs from plain conversations, as turns of both sides.

    Chosen is a conversation as it stands; rejected is the same with its last
    assistant turn replaced by that of the next conversation (by conv_id, after the last
    one the first) that has one. Of several assistant rows with the last turn number the
    greatest text is the reply, and all are replaced. A conversation without an
    assistant turn has two equal sides, so all of it is prompt.
    """
    rows = conversations.select("conv_id", "turn", "role", "text").filter(
        F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    said = F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))
    last = rows.filter("role = 'assistant'").groupBy("conv_id").agg(F.max(said).alias("last"))
    both = rows.join(_next_replies(last), "conv_id", "left")
    here = (F.col("turn") == F.col("at")) & F.col("role").eqNullSafe(F.lit("assistant"))
    sides = F.array(F.struct(F.lit("chosen").alias("side"), F.col("text").alias("text")),
                    F.struct(F.lit("rejected").alias("side"),
                             F.when(here, F.col("reply")).otherwise(F.col("text")).alias("text")))
    return both.withColumn("s", F.explode(sides)).select(
        F.col("conv_id").alias("pair_id"), F.col("s.side").alias("side"), "turn", "role", F.col("s.text").alias("text"))


def _next_replies(last: DataFrame) -> DataFrame:
    """(conv_id, last) -> conv_id, at (its last assistant turn), reply (the next one's).

    Ids are range-partitioned; the last of a part looks into the first of the next,
    one row a part."""
    ranged = materialize(last.select("conv_id", F.col("last.turn").alias("at"), F.col("last.text").alias("own"))
                         .repartitionByRange("conv_id").withColumn("part", F.spark_partition_id()), "replies")
    firsts = ranged.groupBy("part").agg(F.min_by("own", "conv_id").alias("first"))
    parts = Window.orderBy("part")
    cyclic = F.coalesce(F.lead("first").over(parts), F.first("first").over(parts))
    after = firsts.select("part", cyclic.alias("beyond"))
    reply = F.coalesce(F.lead("own").over(Window.partitionBy("part").orderBy("conv_id")), F.col("beyond"))
    return ranged.join(after, "part").select("conv_id", "at", reply.alias("reply"))


def spans_text(spans: Column) -> Column:
    """Spans as ``start-stop`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"], s["stop"])), ",")
