"""The operators on the given tables, with production settings, and SQL to compare with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment,
    decontaminate,
    lines,
    mixing,
    neardup,
    negatives,
    packing,
    preference,
    quality,
    secrets,
    substrings,
    toxicity,
    warc,
)
from tidemark.workspace import Workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


@query()
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    return decontaminate.contained_items(documents(spark, sf_dir), items)


@query()
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir), Workspace(spark))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept")


@query()
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(documents(spark, sf_dir))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(secrets.spans_text("base_spans"), 256).alias("base_sha256"),
        secrets.spans_text("all_spans").alias("spans"),
    )


@query()
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    captures = warc.archive_pages(pages, Workspace(spark))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op5_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark)
    held = workspace.store(preference.conversations(table(spark, sf_dir, "conversations")), "conversations")
    own = preference.stale_reply_pairs(held).withColumn("rejected_id", F.col("conv_id"))
    pairs = own.unionByName(preference.opening_pairs(held))
    return preference.format_pairs(pairs)


@query()
def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), Workspace(spark), tokenizer_path())


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substrings.remove_repeats(documents(spark, sf_dir), Workspace(spark))
    kept = F.sha2("kept_bytes", 256).alias("kept_sha256")
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", kept)


@query()
def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = lines.drop_repeated_lines(documents(spark, sf_dir), Workspace(spark))
    return left.select(
        "doc_id", F.col("__lines").alias("n_lines"), F.col("__gone").alias("n_dropped"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


@query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    score = F.col("__score")
    return toxicity.with_score(docs, model).select(
        "doc_id",
        F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"),
    )


@query()
def op10_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = neardup.Settings(words=3, percent=85)
    found = neardup.near_duplicates(documents(spark, sf_dir), Workspace(spark), settings)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query(
    r"""
    WITH sized AS (
        SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
               coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
        FROM documents
    ), sources AS (
        SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
    ), weighed AS (
        SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
        FROM sources
    ), levels AS (
        -- the level of the sources that are not capped, for each number of capped ones
        SELECT *, coalesce(sum(2 * source_size) OVER before, 0) AS cap_before,
               coalesce(sum(weight) OVER before, 0) AS weight_before,
               1.5 * sum(source_size) OVER () AS share, sum(weight) OVER () AS weights
        FROM weighed
        WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), flagged AS (
        SELECT *, 2.0::DOUBLE * source_size * (weights - weight_before)
                  <= weight * (share - cap_before)::DOUBLE AS is_full
        FROM levels
    ), targets AS (
        SELECT source, source_size,
               CASE WHEN is_full THEN (2 * source_size)::DOUBLE
                    ELSE weight::DOUBLE
                         * (100 * share - 200 * coalesce(sum(source_size) FILTER (is_full) OVER (), 0))::DOUBLE
                         / (weights - coalesce(sum(weight) FILTER (is_full) OVER (), 0))::DOUBLE / 100.0::DOUBLE
               END AS target
        FROM flagged
    ), placed AS (
        SELECT s.doc_id, s.size, t.source_size, t.target,
               least(floor(t.target + 1e-6)::BIGINT, 2 * t.source_size) AS budget,
               coalesce(sum(s.size) OVER (
                   PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
    ), epochs AS (
        SELECT *, budget // greatest(source_size, 1) AS whole FROM placed
    )
    SELECT doc_id, size, source_size, target,
           (whole * size + least(greatest(budget - whole * source_size - before, 0), size))::BIGINT AS taken
    FROM epochs
    """
)
def op11_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, Workspace(spark))


@query(
    """
    WITH typed AS (
        SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x,
               CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
        FROM embeddings
    ), eligible AS (
        SELECT id, label, list_transform(x, lambda v: floor(256 * v)) AS x
        FROM typed
        WHERE id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL
          AND len(list_filter(x, lambda v: v IS NULL OR NOT isfinite(v))) = 0
    ), scored AS (
        SELECT a.id AS anchor_id, r.id, a.label = r.label AS same,
               CAST(list_inner_product(a.x, r.x) AS BIGINT) AS score
        FROM eligible a JOIN eligible r ON r.id <> a.id
        WHERE a.id % 100 = 0
    ), positives AS (
        SELECT anchor_id, id AS positive_id, score AS positive_score
        FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
    ), negatives AS (
        SELECT p.anchor_id, p.positive_id, n.id AS negative_id, p.positive_score, n.score AS negative_score,
               CAST(row_number() OVER (
                   PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id) AS INT) AS rank
        FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
         AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
    )
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
    FROM negatives WHERE rank <= 5
    """
)
def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    vec_id, label = F.col("vec_id"), F.col("label").cast("bigint")
    label = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.mine(rows, Workspace(spark), anchor=vec_id % 100 == 0, label=label)


@query()
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    counted = alignment.count_pairs(alignment.align(documents(spark, sf_dir), *paths), Workspace(spark))
    return alignment.with_pair_counts(counted)
