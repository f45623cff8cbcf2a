"""The registered queries of this subpackage: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.llm import (
    ann, bpe, chat, counts, hardnegatives, licences, linededup, mixing, records, runs, simhash, topk, toxicity,
)
from pagetrail.llm.common import WORD, shared_folder, table

Query = Callable[[SparkSession, str], DataFrame]


def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", toxicity.is_held_out().alias("held_out"), "score", predicted)


def mixing_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.curriculum(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "position")


MIXING_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, md5(concat('mix-', coalesce(CAST(doc_id AS VARCHAR), ''))) AS place,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
sources AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source)),
levels AS (
  SELECT *, 3 * source_size AS most, 2 - weight * 0.5 AS start,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE / sum(weight) OVER after AS level,
         row_number() OVER (ORDER BY (3 * source_size)::DOUBLE / weight, source NULLS LAST) AS place
  FROM sources
  WINDOW before AS (ORDER BY (3 * source_size)::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (ORDER BY (3 * source_size)::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
free AS (SELECT place, level FROM levels WHERE weight * level < most ORDER BY place LIMIT 1),
targets AS (
  SELECT l.*, CASE WHEN f.place IS NULL OR l.place < f.place THEN most::DOUBLE ELSE weight * f.level END AS target
  FROM levels l LEFT JOIN free f ON true),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.start::DOUBLE AS start,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(least(greatest(floor(target) - before, 0), size)
          + least(greatest(floor(target) - source_size - before, 0), size)
          + least(greatest(floor(target) - 2 * source_size - before, 0), size) AS BIGINT) AS taken,
       CASE WHEN start = 1 THEN least((before + size / 2.0::DOUBLE) / nullif(target, 0), 1)
            ELSE (sqrt(start * start + 4 * (1 - start) * least((before + size / 2.0::DOUBLE) / nullif(target, 0), 1)) - start)
                 / nullif(2 * (1 - start), 0) END AS position
FROM placed
"""


def top_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), every=50, k=5)


TOP_SQL = """
WITH usable AS (
  SELECT vec_id, [CAST(floor(256 * x::DOUBLE) AS BIGINT) for x in embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
ranked AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM ranked QUALIFY rank <= 5
"""


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), every=20, k=20)


def chat_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more, whose texts look like the template."""
    odd = "\\### Assistant: </turn> ok"
    schema = "conv_id bigint, turn bigint, role string, text string"
    more = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], schema)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more)
    return chat.digests(chat.formatted(turns))


def token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/records-{uuid.uuid4()}"
    records.write(table(spark, sf_dir, "documents"), folder)
    return records.index(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licences.scanned(docs, licences.fit(docs))


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def dropped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its number of lines and the places of those that repeat an earlier line within the edit limit."""
    found = linededup.line_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("dropped").cast("bigint").alias("n_dropped"), "dropped")


def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some labels are wrong: every seventh row has the next one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardnegatives.mined(table(spark, sf_dir, "embeddings"), label)


HARD_SQL = """
WITH usable AS (
  SELECT vec_id, row_number() OVER () AS number, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) for x in embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND vec_id IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.number, c.vec_id, c.number AS other, a.label = c.label AS alike,
         CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM usable a JOIN usable c ON a.vec_id % 100 = 0 AND a.number <> c.number),
positives AS (
  SELECT anchor_id, number, vec_id AS positive_id, other AS positive, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY number ORDER BY score DESC, vec_id, other) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.number, p.positive ORDER BY n.score DESC, n.vec_id, n.other) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.number = n.number AND NOT n.alike
  AND 100 * n.score BETWEEN 80 * p.positive_score AND 100 * p.positive_score
QUALIFY rank <= 5
"""


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(table(spark, sf_dir, "documents"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents the words from some place on repeat themselves."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(hashed % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(0)))
    docs = docs.select("doc_id", "text", F.floor(hashed / 10).alias("g"), words.alias("words"))
    n = F.nullif(F.size("words"), F.lit(0))
    docs = docs.select("*", n.alias("n"), (F.col("g") % n).alias("a"))
    docs = docs.select("*", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).alias("p"))
    a, p = F.col("a"), F.col("p")
    repeated = F.transform(
        "words", lambda w, i: F.when(i < a, w).otherwise(F.element_at(F.col("words"), (1 + a + (i - a) % p).cast("int")))
    )
    return docs.select("doc_id", F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def repeated_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_repeats(table(spark, sf_dir, "documents")))
    best = F.col("strongest")
    said = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def registry() -> dict[str, tuple[Query, str | None]]:
    return {
        "op1_simhash_near_dedup": (simhash_groups, None),
        "op2_toxicity": (toxicity_scores, None),
        "op3_mixing": (mixing_plan, MIXING_SQL),
        "op4_chat_format": (chat_digests, None),
        "op5_exact_top_k": (top_vectors, TOP_SQL),
        "op6_line_dedup": (dropped_lines, None),
        "op7_multiprobe_ann": (nearest_vectors, None),
        "op8_bpe": (bpe_round_trip, None),
        "op9_token_records": (token_records, None),
        "op10_licence_scan": (licence_scan, None),
        "op11_hard_negatives": (hard_negatives, HARD_SQL),
        "op12_token_counts": (token_counts, None),
        "op13_periodic_runs": (repeated_runs, None),
    }
