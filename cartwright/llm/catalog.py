"""The thin ``opN_<name>`` queries and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    exact_dedup, html_text, mixing, packing, preference, quality, resampling, robust_rules, simhash, suffix_dedup, topk,
    toxicity, turn_repair,
)
from .common import table
from .labelled import held_out


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = html_text.train(html_text.labelled_blocks(spark))
    pages = table(spark, sf_dir, "pages")
    found = pages.select("page_id", "url", html_text.extract_text(F.col("html"), tree).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op4_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=200))


def op5_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.preference_segments(preference.swapped_replies(table(spark, sf_dir, "conversations")))


def preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference.preference_examples(op5_preference(spark, sf_dir))
    spans = {c: preference.spans_text(F.col(c)) for c in ("chosen_loss", "rejected_loss")}
    return pairs.withColumns(spans)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), modulus=3, remainder=1)
    return _decided(toxicity.score(docs.select("doc_id", "text"), model), held_out(F.col("doc_id"), 3, 1), 0.7)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), modulus=5, remainder=0)
    return _decided(quality.score(docs.select("doc_id", "text", "n_chars"), model), held_out(F.col("doc_id"), 5, 0), 0.3)


def _decided(scored: DataFrame, held: Column, threshold: float) -> DataFrame:
    return scored.select("doc_id", held.alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).membership()


def op9_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    hex16 = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", hex16.alias("fingerprint"), "component_id")


def op11_repair_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(turn_repair.damage(table(spark, sf_dir, "conversations")))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), share=(5, 100))


def op13_robust_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return robust_rules.verdicts(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_text": op1_html_text,
    "op2_mix_sources": op2_mix_sources,
    "op3_top_k": op3_top_k,
    "op4_remove_repeats": op4_remove_repeats,
    "op5_preference": op5_preference,
    "preference_pairs": preference_pairs,
    "op6_toxicity": op6_toxicity,
    "op7_quality": op7_quality,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_pack_sequences": op9_pack_sequences,
    "op10_simhash": op10_simhash,
    "op11_repair_turns": op11_repair_turns,
    "op12_resample": op12_resample,
    "op13_robust_rules": op13_robust_rules,
}

ORACLE: dict[str, str] = {}

ORACLE["op2_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(concat_ws(chr(31), CAST(doc_id AS VARCHAR), md5(coalesce(text, '')), source)), 1, 15)
              AS BIGINT) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS n,
         CASE (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3
              WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
  FROM d GROUP BY source),
r AS (
  SELECT *, CAST(sum(n) OVER () AS BIGINT) AS total,
         coalesce(sum(n) OVER (ORDER BY n / w, w, source IS NULL, encode(source)
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
         sum(w) OVER (ORDER BY n / w, w, source IS NULL, encode(source)
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM s),
f AS (SELECT *, 4 * n * open <= w * (3 * total - 4 * filled) AS full_up FROM r),
g AS (
  SELECT source, n,
         CASE WHEN full_up THEN CAST(2 * n AS DOUBLE)
              ELSE CAST(w * (3 * total - 4 * (SELECT coalesce(sum(n), 0) FROM f WHERE full_up)) AS DOUBLE)
                   / CAST(2 * (SELECT sum(w) FROM f WHERE NOT full_up) AS DOUBLE) END AS target
  FROM f),
b AS (
  SELECT *, CASE WHEN n > 0 THEN CAST(floor(target / n) AS BIGINT) ELSE 0 END AS whole FROM g),
h AS (
  SELECT source, h, sum(size) AS words, count(*) AS rows FROM d WHERE size > 0 GROUP BY source, h),
run AS (
  SELECT source, h, words, rows,
         coalesce(sum(words) OVER (PARTITION BY source ORDER BY h
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM h),
edge AS (
  SELECT b.source, max_by(struct_pack(h := run.h, words := run.words, start := run.start, rows := run.rows), run.h) AS e,
         any_value(target - whole * n) AS budget
  FROM b JOIN run ON b.source IS NOT DISTINCT FROM run.source
  WHERE run.start <= target - whole * n GROUP BY b.source),
cut AS (
  SELECT source, e.h AS cut, least(floor((budget - e.start) / (CAST(e.words AS DOUBLE) / e.rows) + 0.5), e.rows) AS more FROM edge),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source, h, size > 0) AS copy FROM d)
SELECT d.doc_id, d.size, b.n AS source_size, b.target,
       CAST(d.size * (b.whole + CASE WHEN d.h < cut.cut OR d.h = cut.cut AND d.copy <= cut.more THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM numbered d JOIN b ON d.source IS NOT DISTINCT FROM b.source
LEFT JOIN cut ON d.source IS NOT DISTINCT FROM cut.source
"""

ORACLE["op8_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS cp,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents),
g AS (
  SELECT content, count(*) AS group_size,
         first(doc_id ORDER BY cp DESC, doc_id NULLS LAST) AS keep_id
  FROM d GROUP BY content)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.content) AS text_sha256
FROM d JOIN g USING (content)
"""

ORACLE["op3_top_k"] = r"""
WITH v AS (
  SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM p)
SELECT * FROM r WHERE rank <= 20
"""

_SEGMENTS = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
last AS (
  SELECT conv_id, max(struct_pack(turn := turn, text := text)) AS said FROM rows WHERE role = 'assistant' GROUP BY conv_id),
pairs AS (
  SELECT conv_id, said.turn AS at, coalesce(lead(said.text) OVER w, first_value(said.text) OVER w) AS reply
  FROM last WINDOW w AS (ORDER BY conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
both_sides AS (
  SELECT r.conv_id, s.side, r.turn, r.role,
         CASE WHEN s.side = 'rejected' AND r.turn = p.at AND r.role = 'assistant' THEN p.reply ELSE r.text END AS text
  FROM rows r LEFT JOIN pairs p USING (conv_id) CROSS JOIN (VALUES ('chosen'), ('rejected')) s(side)),
steps AS (
  SELECT conv_id, turn, role, text, bool_or(side = 'chosen') AS chosen, bool_or(side = 'rejected') AS rejected
  FROM both_sides GROUP BY conv_id, turn, role, text),
split AS (
  SELECT conv_id, min(turn) FILTER (NOT (chosen AND rejected)) AS n_prompt FROM steps GROUP BY conv_id),
parts AS (
  SELECT steps.*, n_prompt, 'prompt' AS part FROM steps JOIN split USING (conv_id)
  WHERE n_prompt IS NULL OR turn < n_prompt
  UNION ALL
  SELECT steps.*, n_prompt, 'chosen' FROM steps JOIN split USING (conv_id) WHERE turn >= n_prompt AND chosen
  UNION ALL
  SELECT steps.*, n_prompt, 'rejected' FROM steps JOIN split USING (conv_id) WHERE turn >= n_prompt AND rejected),
segments AS (
  SELECT conv_id AS pair_id, part, turn, role,
         '<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10) AS rendered,
         CAST(length(role) + 5 AS BIGINT) AS body_start,
         CAST(part <> 'prompt' AND role = 'assistant' AS INTEGER) AS loss, n_prompt
  FROM parts)
"""

ORACLE["op5_preference"] = _SEGMENTS + "SELECT * FROM segments"

ORACLE["preference_pairs"] = _SEGMENTS + r""",
placed AS (
  SELECT *, coalesce(sum(length(rendered)) OVER (PARTITION BY pair_id, part ORDER BY turn, role, rendered
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM segments),
spans AS (
  SELECT *, CAST(before + body_start AS VARCHAR) || '-' || CAST(before + length(rendered) AS VARCHAR) AS span FROM placed)
SELECT pair_id,
       coalesce(string_agg(rendered, '' ORDER BY turn, role, rendered) FILTER (part = 'prompt'), '') AS prompt,
       coalesce(string_agg(rendered, '' ORDER BY turn, role, rendered) FILTER (part = 'chosen'), '') AS chosen,
       coalesce(string_agg(rendered, '' ORDER BY turn, role, rendered) FILTER (part = 'rejected'), '') AS rejected,
       coalesce(string_agg(span, ',' ORDER BY turn, role, rendered) FILTER (part = 'chosen' AND loss = 1), '') AS chosen_loss,
       coalesce(string_agg(span, ',' ORDER BY turn, role, rendered) FILTER (part = 'rejected' AND loss = 1), '') AS rejected_loss
FROM spans GROUP BY pair_id
"""

#: CRC-32 in SQL: the table of its 256 remainders, and one step a byte over a list of bytes.
_CRC_TABLE = """crc AS (
  SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY i) AS t
  FROM range(256) r(i))"""


def _crc(octets: str) -> str:
    return (f"xor(list_reduce([4294967295] || {octets}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)")


def _put(state: str, cost: str, edit: str) -> str:
    """A state of the walk below (cost in eight digits, then the audit) after one edit."""
    return f"(printf('%08d', CAST(left({state}, 8) AS BIGINT) + {cost}) || substr({state}, 9) || '{edit}')"


def _after(state: str, fits: str, edit: str, cost: str = "k") -> str:
    return _put(state, f"CASE WHEN {fits} THEN {cost} ELSE 80000000 END", edit)


_PUT_U = f"least(u, {_put('z', '2', 'I')}, {_put('s', '2', 'I')}"

ORACLE["op11_repair_turns"] = r"""
WITH RECURSIVE """ + _CRC_TABLE + r""",
hit AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, """ + _crc(
    "[ord(x) FOR x IN string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '')]"
) + r""" % 20 AS f
  FROM conversations, crc),
turns AS (
  SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
         CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE f WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hit WHERE f <> 0),
sorted AS (
  SELECT *, left(role, 1) AS c, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(concat_ws(':', length(role), role, text)), copy) AS i
  FROM turns),
judged AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut,
         lag(c) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM sorted),
faults AS (
  SELECT conv_id, i, role, text, c, blank, NOT blank AND again AS again, NOT blank AND NOT again AND cut AS cut,
         before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au') AS illegal, turn
  FROM judged),
-- cheapest cost and least audit, as one text, by what the repaired conversation ends in so far
walk(conv_id, i, z, s, u, a) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), '00000000', '90000000', '00000002I', '00000004II' FROM conversations
  UNION ALL
  SELECT conv_id, i, z, s, """ + _PUT_U + f", {_put('a', '2', 'I')}), least(a, {_put(_PUT_U + ')', '2', 'I')})" + r"""
  FROM (
    SELECT w.conv_id, f.i, """ + ", ".join(f"{x} AS {n}" for n, x in {
        "z": _put("w.z", "3", "D"),
        "s": f"least({_put('w.s', '3', 'D')}, {_after('w.z', "f.c = 's' AND may", 'K')})",
        "u": f"least({_put('w.u', '3', 'D')}, {_after('least(w.z, w.s, w.a)', "f.c = 'u' AND may", 'K')}, "
             f"{_after('least(w.z, w.s, w.a)', 'may', 'R', '2 + k')})",
        "a": f"least({_put('w.a', '3', 'D')}, {_after('w.u', "f.c = 'a' AND may", 'K')}, "
             f"{_after('w.u', 'may', 'R', '2 + k')})"}.items()) + r"""
    FROM walk w JOIN (SELECT *, NOT (blank OR again) AS may, CAST(cut AS INTEGER) AS k FROM faults) f
      ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1)),
found AS (
  SELECT conv_id, max_by(least(z, a), i) AS best FROM walk GROUP BY conv_id),
edits AS (
  SELECT conv_id, CAST(best[1:8] AS BIGINT) AS cost, best[9:] AS audit FROM found),
steps AS (
  SELECT conv_id, k, audit[k] AS e, len(replace(audit[1:k], 'I', '')) AS i
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS k FROM edits)),
placed AS (
  SELECT s.conv_id, s.k, s.e, f.role, f.text,
         sum(CASE WHEN s.e = 'K' AND f.c = 's' THEN 0 ELSE 1 END) OVER (PARTITION BY s.conv_id ORDER BY s.k) AS nth
  FROM steps s LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i AND s.e <> 'I'
  WHERE s.e <> 'D'),
texts AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN nth % 2 = 1 THEN 'user' ELSE 'assistant' END
                             || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS whole
  FROM placed GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (again) AS duplicate, count(*) FILTER (cut) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM faults GROUP BY conv_id)
SELECT e.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, e.cost, e.audit,
       sha256(coalesce(t.whole, '')) AS repaired_sha256
FROM edits e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM e.conv_id
"""
