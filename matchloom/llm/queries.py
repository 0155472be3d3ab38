"""One query per operator over its whole table, with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm import (
    byte_bpe,
    chat_format,
    decontamination,
    license_scan,
    line_dedup,
    merkle_manifest,
    packing,
    quality_classifier,
    quality_rules,
    simhash_dedup,
    structure_repair,
    substring_dedup,
    toxicity,
)
from matchloom.llm.common import stage

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"
# the fold whose labels no fit sees
FOLDS, HELD_OUT = 4, 2


def _table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def _is_held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def op1_quality_rules(spark: SparkSession, directory: str) -> DataFrame:
    judged = quality_rules.quality_rules(_table(spark, directory, "documents"))
    return judged.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op2_substring_dedup(spark: SparkSession, directory: str) -> DataFrame:
    found = substring_dedup.substring_dedup(_table(spark, directory, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_license_scan(spark: SparkSession, directory: str) -> DataFrame:
    return license_scan.license_scan(_table(spark, directory, "documents")).drop("expressions")


def _classified(spark: SparkSession, directory: str, classify, least: float) -> DataFrame:
    labels = _table(spark, directory, "labels").where(~_is_held_out())
    scored = classify(_table(spark, directory, "documents"), labels)
    return scored.select("doc_id", _is_held_out().alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def op4_quality_classifier(spark: SparkSession, directory: str) -> DataFrame:
    return _classified(spark, directory, quality_classifier.classify, 0.7)


def op5_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    return _classified(spark, directory, toxicity.classify, 0.3)


def op6_simhash_near_dedup(spark: SparkSession, directory: str) -> DataFrame:
    found = simhash_dedup.simhash_components(_table(spark, directory, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_chat_format(spark: SparkSession, directory: str) -> DataFrame:
    turns = _table(spark, directory, "conversations").select("conv_id", "turn", "role", "text")
    own = "</s>[INST] ok [/INST]"
    planted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(own).alias("text"),
    )
    read = chat_format.read_chats(chat_format.format_chats(turns.unionByName(planted)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_best_fit_packing(spark: SparkSession, directory: str) -> DataFrame:
    return packing.pack(_table(spark, directory, "documents"), public_tokenizers.path(TOKENIZER), added_tokens=True)


def op9_line_dedup(spark: SparkSession, directory: str) -> DataFrame:
    found = line_dedup.line_dedup(_table(spark, directory, "documents"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_benchmark_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    found = decontamination.benchmark_matches(_table(spark, directory, "documents"), _table(spark, directory, "benchmark"))
    return found.select("doc_id", "item_id", F.col("start").cast("long"), F.col("n_matched").cast("long"), F.col("n_windows").cast("long"))


def op11_merkle_manifest(spark: SparkSession, directory: str) -> DataFrame:
    # every second document is shown without its line ends; the manifest is that of the whole rows
    is_tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    cut = merkle_manifest.leaf(*[F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in merkle_manifest.FIELDS])
    proofs = merkle_manifest.manifest(_table(spark, directory, "documents"), {"tampered": F.when(is_tampered, cut)})
    found = proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle_manifest.proof_digest(F.col("proof")).alias("proof_sha256"),
        merkle_manifest.folded(F.coalesce("tampered", "leaf"), F.col("proof")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_byte_bpe(spark: SparkSession, directory: str) -> DataFrame:
    decoded = byte_bpe.encode(_table(spark, directory, "documents"), public_tokenizers.path(RANKS), decode_again=True)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Turns by a hash of their conversation and turn: lost, emptied, without ``.!?``, twice, or the user's."""
    rows = structure_repair.turns_of(turns)
    place = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(place.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1)))
    changed = rows.where(kind != 0).select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies)
    return changed.drop("col")


def op13_structure_repair(spark: SparkSession, directory: str) -> DataFrame:
    turns = _table(spark, directory, "conversations")
    rows = damaged(turns)
    plans = stage(structure_repair.plan_repairs(rows), "repair-plans")
    digests = structure_repair.conversation_digests(structure_repair.repaired_turns(rows, plans))
    every = turns.select(F.col("conv_id").cast("long").alias("of")).distinct()
    found = every.join(plans, F.col("of").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    found = found.join(digests, F.col("of").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(
        F.col("of").alias("conv_id"),
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_substring_dedup,
        op3_license_scan,
        op4_quality_classifier,
        op5_toxicity,
        op6_simhash_near_dedup,
        op7_chat_format,
        op8_best_fit_packing,
        op9_line_dedup,
        op10_benchmark_decontamination,
        op11_merkle_manifest,
        op12_byte_bpe,
        op13_structure_repair,
    )
}

_WORDS = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LINE = "length({0}) - length(translate({0}, '{1}', ''))"


def _line_good() -> str:
    n = "(length(trim(l)) - length(replace(trim(l), ' ', '')) + 1)"
    symbols, shouts, separators = (_LINE.format("l", s) for s in ("#*$%&<>", "!?", "|»•·"))
    phrases = "|".join(quality_rules.BOILERPLATE)
    return (
        f"NOT (({symbols}) > 0.3 * {n} OR ({shouts}) > greatest(3, 0.3 * {n})"
        f" OR (({separators}) >= 3 AND 10 * ({separators}) >= {n}) OR regexp_matches(lower(l), '{phrases}'))"
    )


ORACLES = {
    "op1_quality_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, {_WORDS.format("t")} AS w FROM d),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
gaps AS (SELECT doc_id, least(5, i - coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -5)) AS c FROM twice),
rep AS (SELECT doc_id, sum(c) AS n FROM gaps GROUP BY doc_id),
lines AS (SELECT doc_id, l, len({_WORDS.format("l")}) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)),
by_line AS (SELECT doc_id, count(l) FILTER (n > 0) - count(DISTINCT l) FILTER (n > 0) AS dup,
  coalesce(sum(n) FILTER ({_line_good()}), 0) AS good FROM lines GROUP BY doc_id),
all_of AS (SELECT w.doc_id, CAST(len(w) AS bigint) AS n_words,
  CAST(length(array_to_string(w, '')) AS bigint) AS word_chars,
  CAST({_LINE.format("t", quality_rules.SYMBOLS)} AS bigint) AS n_symbols,
  CAST(dup AS bigint) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS bigint) AS n_repeat_words, good
  FROM w JOIN by_line USING (doc_id) LEFT JOIN rep USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM all_of)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND good >= 0.5 * n_words AS kept FROM judged""",
    "op2_substring_dedup": rf"""
WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 34], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM w WHERE len(w) >= 35)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM twice),
one AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM w),
kept AS (SELECT one.doc_id, string_agg(x, ' ' ORDER BY one.p) AS k, count(*) AS n
  FROM one LEFT JOIN gone ON one.doc_id = gone.doc_id AND one.p = gone.p WHERE gone.p IS NULL GROUP BY one.doc_id)
SELECT w.doc_id, CAST(len(w) AS bigint) AS n_words, CAST(len(w) - coalesce(n, 0) AS bigint) AS n_removed,
  sha256(coalesce(k, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)""",
    "op7_chat_format": """
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(text, '([<\\[])(\\\\*)(/?s>|/?INST\\]|ROLE\\]|TEXT\\]|NEXT\\]|</?SYS>>)', '\\1\\\\\\2\\3', 'g') AS x,
  coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) = role, false) AS merged FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS bigint) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(length(x)) + sum(CASE WHEN merged THEN 6 ELSE 16 + length(role) END) AS bigint) AS formatted_chars
FROM e GROUP BY conv_id""",
    "op9_line_dedup": rf"""
WITH l AS (SELECT doc_id, i - 1 AS i, t[i] AS line FROM (SELECT doc_id, t, unnest(range(1, len(t) + 1)) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS t FROM documents))),
s AS (SELECT doc_id, i, line, list_sort(list_distinct({_WORDS.format("line")})) AS s FROM l),
firsts AS (SELECT s, min((doc_id, i)) AS f, len(s) AS n FROM s WHERE len(s) > 0 GROUP BY s),
ids AS (SELECT row_number() OVER (ORDER BY f) AS id, f, s, n FROM firsts),
words AS (SELECT id, f, n, unnest(s) AS w FROM ids),
rare AS (SELECT w, count(*) AS c FROM words GROUP BY w),
ranked AS (SELECT id, f, n, w, row_number() OVER (PARTITION BY id ORDER BY c, w) AS p FROM words JOIN rare USING (w)),
pre AS (SELECT * FROM ranked WHERE p <= n - (4 * n + 4) // 5 + 1),
pairs AS (SELECT DISTINCT y.id AS y, x.id AS x FROM pre y JOIN pre x ON y.w = x.w AND x.f < y.f
  AND 5 * x.n >= 4 * y.n AND 5 * y.n >= 4 * x.n),
gone AS (SELECT DISTINCT y FROM pairs JOIN ids a ON a.id = y JOIN ids b ON b.id = x
  WHERE 5 * len(list_intersect(a.s, b.s)) >= 4 * (a.n + b.n - len(list_intersect(a.s, b.s)))),
stay AS (SELECT f FROM ids WHERE id NOT IN (SELECT y FROM gone)),
judged AS (SELECT doc_id, i, line, len(s) > 0 AS full_line, len(s) = 0 OR (doc_id, i) IN (SELECT f FROM stay) AS kept FROM s)
SELECT doc_id, CAST(count(*) FILTER (full_line) AS bigint) AS n_lines, CAST(count(*) FILTER (NOT kept) AS bigint) AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (kept), '')) AS kept_sha256 FROM judged GROUP BY doc_id""",
}
