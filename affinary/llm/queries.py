"""The numbered queries of this subpackage and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinary.llm import centroids, fingerprints, hard_negatives, host_trust, html_text, jaccard_join, language_id, mixing, near_vectors, packing, quality, secret_spans, tokens

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op10_source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixing.taken_words(mixed).select(
        F.col("kept.doc_id").alias("doc_id"), "size", "source_size", "target", "taken", "source", "slot"
    )


@query
def op7_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals, quantiles and truncated totals for every encoded length that occurs."""
    return tokens.length_histogram(tokens.encoded_lengths(_table(spark, sf_dir, "documents")))


@query
def op8_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids, one row per piece."""
    return packing.pack(_table(spark, sf_dir, "documents"))


@query
def op4_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every text: the plain kinds counted and digested, all spans listed."""

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda span: span["kind"].isin(*kinds))

    plain = of(*secret_spans.PLAIN_KINDS)
    counts = [F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in secret_spans.PLAIN_KINDS]
    return secret_spans.secret_spans(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        *counts,
        F.sha2(secret_spans.spans_text(plain).cast("binary"), 256).alias("base_sha256"),
        secret_spans.spans_text(F.col("spans")).alias("spans"),
    )


URL_RULES = (
    host_trust.Rule("allow", "org/"),
    host_trust.Rule("block", "example.org/es/"),
    host_trust.Rule("block", "example.org/en/1"),
    host_trust.Rule("allow", "com/fr/"),
    host_trust.Rule("block", "com/de/"),
)


@query
def op2_host_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for the url of every page."""
    return host_trust.judge(_table(spark, sf_dir, "pages"), URL_RULES)


@query
def op9_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(_table(spark, sf_dir, "pages"))


@query
def op1_order_min_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts and their edited texts, with likenesses."""
    return fingerprints.edited_fingerprints(_table(spark, sf_dir, "documents"))


@query
def op3_byte_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, learned from two thirds of the documents."""
    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit(docs)
    rows = docs.select(
        F.col("doc_id"), F.coalesce(language_id.fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), F.col("text")
    )
    return language_id.label(rows, model).drop("text")


@query
def op6_stable_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    return near_vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


@query
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by a Jaccard similarity of 0.9 or more on 3-word shingles."""
    return jaccard_join.components_of(_table(spark, sf_dir, "documents"))


@query
def op12_hadamard_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all integer vectors after three rounds."""
    return centroids.cluster(_table(spark, sf_dir, "embeddings"))


def _clustering_sql(rounds: int = 3, clusters: int = 16) -> str:
    """The same in SQL: distances by inner products, one set of tables per round."""
    parts = [
        """kept AS (
            SELECT vec_id, [floor(64 * x::DOUBLE) for x in embedding] AS v FROM embeddings
            WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0)""",
        f"""c0 AS (
            SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, v FROM kept
            QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id)) <= {clusters})""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""d{i} AS (
            SELECT vec_id, k.v, c, list_inner_product(k.v, k.v) - 2 * list_inner_product(k.v, m.v) + list_inner_product(m.v, m.v) AS d
            FROM kept k CROSS JOIN c{i} m)""")
        parts.append(f"""a{i} AS (
            SELECT * FROM d{i} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)""")
        parts.append(f"""s{i} AS (
            SELECT c, i, floor(sum(x) / count(*)) AS x
            FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{i}) GROUP BY c, i)""")
        parts.append(f"""c{i + 1} AS (
            SELECT c, coalesce(n.v, o.v) AS v
            FROM c{i} o LEFT JOIN (SELECT c, list(x ORDER BY i) AS v FROM s{i} GROUP BY c) n USING (c))""")
    return f"""WITH {", ".join(parts)}
        SELECT vec_id, c::INTEGER AS cluster, d::BIGINT AS distance,
            (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
            sha256(list_aggregate([x::BIGINT::VARCHAR for x in m.v], 'string_agg', ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} m USING (c)"""


ORACLE["op12_hadamard_clustering"] = _clustering_sql()


@query
def op13_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from three quarters of the labels."""
    docs = _table(spark, sf_dir, "documents")
    machine = quality.fit(docs, _table(spark, sf_dir, "labels"))
    held_out = F.coalesce(quality.fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out")
    return quality.score(docs.select("doc_id", held_out, "text", "n_chars"), machine).select("doc_id", "held_out", "score", "predicted")


@query
def op11_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, after every seventh has taken the next label."""
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), label=moved)


ORACLE["op11_inverted_multi_index"] = """
    WITH kept AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) for x in embedding] AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
    pairs AS (
        SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
        FROM kept a JOIN kept b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
    positives AS (SELECT * FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
    SELECT p.a AS anchor_id, p.b AS positive_id,
        (row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.b))::INTEGER AS rank,
        n.b AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM positives p JOIN pairs n ON n.a = p.a AND NOT n.same
    WHERE 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
    QUALIFY rank <= 5"""
