"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm import (
    centroids,
    chat,
    decontaminate,
    minhash,
    mixing,
    ngrams,
    packing,
    resample,
    sharding,
    spans,
    suffixes,
    topk,
    toxicity,
)
from basketflow.llm.texts import table


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeated_bytes(table(spark, sf_dir, "documents")).drop("kept_text")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors.filter(F.col("vec_id") % 100 == 0), vectors, 10)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shards(table(spark, sf_dir, "documents"), 24)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "number",
    )


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = spans.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.perplexities(table(spark, sf_dir, "documents"))


def op9_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen, rejected = chat.swapped_answers(table(spark, sf_dir, "conversations"))
    pairs = chat.format_preferences(chosen, rejected)

    def mask(side: str) -> F.Column:
        """The mask as text: `+` and `-` with the length of each turn."""
        sign = lambda t: F.when(t["learn"], "+").otherwise("-")
        return F.array_join(F.transform(side, lambda t: F.concat(sign(t), t["length"].cast("string"))), "")

    return pairs.select(
        "pair_id",
        "prompt_turns",
        "prompt",
        "chosen",
        mask("chosen_mask").alias("chosen_mask"),
        "rejected",
        mask("rejected_mask").alias("rejected_mask"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "whole")


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_suffixes": op2_suffixes,
    "op3_toxicity": op3_toxicity,
    "op4_topk": op4_topk,
    "op5_packing": op5_packing,
    "op6_sharding": op6_sharding,
    "op7_substrings": op7_substrings,
    "op8_perplexity": op8_perplexity,
    "op9_preferences": op9_preferences,
    "op10_decontamination": op10_decontamination,
    "op11_mixing": op11_mixing,
    "op12_resampling": op12_resampling,
    "op13_centroids": op13_centroids,
}


def centroid_sql(rounds: int = centroids.ROUNDS) -> str:
    """Every round as two steps: all vectors against all centroids, then the
    means, rounded down."""
    steps = [
        """v AS (
            SELECT row_number() OVER () AS row, vec_id,
                   list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), c0 AS (
            SELECT row_number() OVER (ORDER BY hash, w) - 1 AS j, w
            FROM (SELECT sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS hash, w FROM v ORDER BY hash, w LIMIT 8)
        )"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
            SELECT row, min(8 * CAST(list_sum(list_transform(range(1, 65),
                       lambda i: (v.w[i] - c.w[i]) * (v.w[i] - c.w[i]))) AS HUGEINT) + j) AS d
            FROM v, c{i} c GROUP BY row
        )"""
        )
        if i < rounds:
            steps.append(
                f"""m{i} AS (
            SELECT d % 8 AS j, i, sum(w[i]) AS s, count(*) AS n
            FROM a{i} JOIN v USING (row), range(1, 65) AS r(i) GROUP BY 1, 2
        ), c{i + 1} AS MATERIALIZED (
            SELECT c.j, coalesce(m.w, c.w) AS w
            FROM c{i} c LEFT JOIN (
                SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS w FROM m{i} GROUP BY j
            ) m USING (j)
        )"""
            )
    return f"""
        WITH {", ".join(steps)}
        SELECT vec_id, CAST(d % 8 AS INTEGER) AS cluster, CAST(d // 8 AS BIGINT) AS distance,
               CAST(sum(d // 8) OVER (PARTITION BY d % 8) AS BIGINT) AS cluster_inertia,
               CAST(sum(d // 8) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c.w, ',')) AS centroid_sha256
        FROM a{rounds} JOIN v USING (row) JOIN c{rounds} c ON c.j = d % 8
    """


ORACLE = {
    "op4_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(range(1, least(len(q.w), len(c.w)) + 1), lambda i: q.w[i] * c.w[i]))
                        AS BIGINT) AS score
            FROM v q JOIN v c ON c.vec_id <> q.vec_id
            WHERE q.vec_id % 100 = 0
        ), ranked AS (
            SELECT query_id, vec_id, score,
                   CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op9_preferences": """
        WITH turns AS (
            SELECT conv_id AS pair_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
        ), answers AS (
            SELECT pair_id, turn AS until, max(text) AS text
            FROM turns WHERE role = 'assistant'
            GROUP BY pair_id, turn
            QUALIFY turn = max(turn) OVER (PARTITION BY pair_id)
        ), sides AS (
            SELECT 'chosen' AS side, pair_id, turn, role, text FROM turns
            UNION ALL
            SELECT 'rejected', t.pair_id, t.turn, t.role, t.text
            FROM turns t LEFT JOIN answers a USING (pair_id) WHERE a.until IS NULL OR t.turn < a.until
            UNION ALL
            SELECT 'rejected', a.pair_id, a.until, 'assistant', b.text
            FROM answers a JOIN answers b ON b.pair_id = xor(a.pair_id, 1)
        ), placed AS (
            SELECT side, pair_id, role, text, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS shown,
                   row_number() OVER (PARTITION BY side, pair_id ORDER BY turn, role, text) AS place
            FROM sides
        ), matched AS (
            SELECT pair_id, c.place AS a, r.place AS b,
                   c.role = r.role AND c.text = r.text AS same, place
            FROM (SELECT * FROM placed WHERE side = 'chosen') c
            FULL JOIN (SELECT * FROM placed WHERE side = 'rejected') r USING (pair_id, place)
        ), prompts AS (
            SELECT pair_id,
                   coalesce(min(place) FILTER (same IS NULL OR NOT same) - 1, max(place)) AS prompt_turns
            FROM matched GROUP BY pair_id
        )
        SELECT pair_id, CAST(prompt_turns AS BIGINT) AS prompt_turns,
               coalesce(string_agg(shown, '' ORDER BY place)
                        FILTER (side = 'chosen' AND place <= prompt_turns), '') AS prompt,
               coalesce(string_agg(shown, '' ORDER BY place)
                        FILTER (side = 'chosen' AND place > prompt_turns), '') AS chosen,
               coalesce(string_agg(CASE WHEN role = 'assistant' THEN '+' ELSE '-' END || length(shown), ''
                        ORDER BY place) FILTER (side = 'chosen' AND place > prompt_turns), '') AS chosen_mask,
               coalesce(string_agg(shown, '' ORDER BY place)
                        FILTER (side = 'rejected' AND place > prompt_turns), '') AS rejected,
               coalesce(string_agg(CASE WHEN role = 'assistant' THEN '+' ELSE '-' END || length(shown), ''
                        ORDER BY place) FILTER (side = 'rejected' AND place > prompt_turns), '') AS rejected_mask
        FROM placed JOIN prompts USING (pair_id)
        GROUP BY pair_id, prompt_turns
    """,
    # The level is found at one go: sources stand by words per weight at which
    # they are clamped, and those before the first that is not are.
    "op11_mixing": f"""
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
                   CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':'
                        || coalesce(text, '')), 1, 15) AS BIGINT) AS hash
            FROM documents
        ), s AS (
            SELECT source, CAST(sum(size) AS HUGEINT) AS source_size,
                   [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
            FROM d GROUP BY source
        ), ordered AS (
            SELECT *, row_number() OVER (ORDER BY source_size / weight, source) AS place FROM s
        ), levels AS (
            SELECT *, sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER before, 0) AS up,
                   sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS down
            FROM ordered
            WINDOW before AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), reached AS (
            SELECT up // gcd(up, down) AS up, down // gcd(up, down) AS down
            FROM levels WHERE up * weight < 3 * source_size * down ORDER BY place LIMIT 1
        ), t AS (
            SELECT source, source_size,
                   CASE WHEN 3 * source_size * down <= weight * up THEN CAST(3 * source_size AS DOUBLE)
                        ELSE CAST(weight * up AS DOUBLE) / CAST(down AS DOUBLE) END AS target,
                   CASE WHEN 3 * source_size * down <= weight * up THEN 3 * source_size
                        ELSE weight * up // down END AS words
            FROM s, reached
        ), laid AS (
            SELECT d.*, t.source_size, t.target, coalesce(t.words // nullif(t.source_size, 0), 0) AS whole,
                   coalesce(t.words % nullif(t.source_size, 0), 0) AS extra,
                   coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY hash
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
        )
        SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
               CAST(size * whole + greatest(0, least(size, extra - earlier)) AS BIGINT) AS taken,
               source, CAST(whole AS BIGINT) AS whole
        FROM laid
    """,
    "op13_centroids": centroid_sql(),
}
