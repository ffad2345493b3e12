"""Queries over the given tables that apply the operators, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers

from glosswork.llm import (
    bpe,
    chat,
    collocations,
    credentials,
    decontaminate,
    exact_dedup,
    licenses,
    near_dup,
    pitman_yor,
    sharding,
    simplex_clusters,
    toxicity,
    warc,
)
from glosswork.session import ship, staging_root

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BATCH_ROWS = 2000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(_table(spark, sf_dir, "documents"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"), width=3, percent=85)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    # Whole texts: a batch is held by the JVM, on its way and by the task at once.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return pitman_yor.score(_table(spark, sf_dir, "documents"), remainder == 2)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(spark, RANKS)
    encoded = bpe.encode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.digests(encoded, ranks)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"), keep="largest")


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = credentials.find_secrets(_table(spark, sf_dir, "documents"))
    return found.withColumn("base_sha256", F.sha2(F.col("base_spans").cast("binary"), 256)).drop("base_spans")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    probe = [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.createDataFrame(probe, "conv_id bigint, turn bigint, role string, text string"))
    return chat.conversation_digests(chat.format_turns(turns))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{staging_root(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    records = warc.read_archives(spark, path)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_passages(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simplex_clusters.clusters(_table(spark, sf_dir, "embeddings"))


def op12_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    path = f"{staging_root(spark)}/shards-{uuid.uuid4().hex}"
    sharding.write_shards(docs, path)
    rows = sharding.read_shards(spark, path, docs.schema)
    text = F.coalesce(F.col("record.text"), F.lit(""))
    return rows.select(
        "record.doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


_REGISTERED = [
    op1_toxicity, op2_license_scans, op3_near_dedup, op4_lm_scoring, op5_byte_bpe, op6_exact_dedup, op7_secret_scans,
    op8_chat_format, op9_warc, op10_decontamination, op11_centroid_clusters, op12_external_shuffle, op13_collocations,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _REGISTERED}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _clusters_sql(rounds: int = 10) -> str:
    """First centroids, then one assignment and one set of means per round, then the last assignment."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
        a{i} AS MATERIALIZED (
            SELECT row, any_value(k.vec_id) AS vec_id, any_value(k.q) AS q, min(8 * list_sum(list_transform(
                list_zip(k.q, m.q), lambda p: CAST((p[1] - p[2]) * (p[1] - p[2]) AS HUGEINT))) + m.c) AS best
            FROM k, m{i} m GROUP BY row
        ),""")
        if i < rounds:
            steps.append(f"""
        m{i + 1} AS MATERIALIZED (
            SELECT m.c, coalesce(n.q, m.q) AS q
            FROM m{i} m LEFT JOIN (
                SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS q
                FROM (SELECT c, i, sum(x) AS s, count(*) AS n
                    FROM (SELECT best % 8 AS c, unnest(q) AS x, unnest(range(64)) AS i FROM a{i}) GROUP BY c, i)
                GROUP BY c) n ON n.c = m.c
        ),""")
    return f"""
        WITH k AS MATERIALIZED (
            SELECT row_number() OVER () AS row, vec_id,
                list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
        ), m0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, q) - 1 AS c, q
            FROM k QUALIFY c < 8
        ),{"".join(steps)}
        f AS (SELECT vec_id, CAST(best % 8 AS INTEGER) AS cluster, CAST(best // 8 AS BIGINT) AS distance FROM a{rounds})
        SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
            CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m.q, ',')) AS centroid_sha256
        FROM f JOIN m{rounds} m ON m.c = f.cluster
    """


_SQL = {
    "op11_centroid_clusters": _clusters_sql(),
    "op6_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
             g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM d JOIN g USING (t)
    """,
    "op8_chat_format": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), r AS (
            SELECT *, CASE WHEN regexp_matches(text, '###|</turn>|\\\\')
                THEN length(regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g')) ELSE length(text) END
                + length(role) + length('### ' || ': ' || ' </turn>.') AS shown
            FROM c
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
                ORDER BY turn, role, text), '')) AS loss_sha256,
            CAST(sum(shown) AS BIGINT) AS formatted_chars
        FROM r GROUP BY conv_id
    """,
    "op9_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
             q AS (SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest,
                 CASE WHEN strlen(h) >= 100 THEN min(page_id) OVER (PARTITION BY h) ELSE page_id END AS first FROM p)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN page_id <> first THEN first END AS refers_to,
            TRUE AS digest_ok
        FROM q
    """,
    "op13_collocations": r"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), s AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p
        ), o AS (
            SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM s
        ), f AS (
            SELECT lang, list_slice(ws, i, i + k - 1) AS g, count(*) AS f
            FROM o, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(ws) GROUP BY ALL
        ), total AS (
            SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE len(g) = 1 GROUP BY lang
        ), c AS (
            SELECT lang, g, f AS a FROM f WHERE f >= 30 AND len(g) > 1
        ), cut AS (
            SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM c
        ), scored AS (
            SELECT c.lang, c.g, a, k, x.f AS l, y.f AS r,
                CAST(CAST(2000000 AS HUGEINT) * a // (x.f + y.f) AS BIGINT) AS score
            FROM cut c JOIN f x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, k)
                JOIN f y ON y.lang = c.lang AND y.g = list_slice(c.g, k + 1, len(c.g))
        ), low AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
        ), inside AS (
            SELECT lang, list_slice(g, i, i + m - 1) AS g, max(a) AS longer
            FROM c, (SELECT unnest([1, 2, 3]) AS i), (SELECT unnest([2, 3]) AS m)
            WHERE m < len(c.g) AND i + m - 1 <= len(c.g) GROUP BY ALL
        )
        SELECT low.lang, row_number() OVER (PARTITION BY low.lang
                ORDER BY score DESC, a DESC, array_to_string(low.g, ' ')) AS rank,
            array_to_string(low.g, ' ') AS phrase, a, l, r, n, score
        FROM low JOIN total USING (lang) LEFT JOIN inside USING (lang, g)
        WHERE longer IS NULL OR 100 * longer < 80 * a
        QUALIFY rank <= 2000
    """,
}
