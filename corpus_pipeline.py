"""A corpus prepared for training: language, near duplicates, secrets, mixture, packing.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept, and
returns a table; all but the last return the columns of documents.  ``run`` writes each
stage's rows to the shared folder and reads them again for the next one.  No stage can be said
in SQL as a whole (a trained network, exact joins by pivots, tokenizers), so there is no ORACLE_SQL;
the tests hold each stage against a plain version.

Extra columns of any name without a dot go through untouched.  A null source is a source of its own, null and empty texts have no
language and end at the first stage, and very long texts are read whole in every stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinary.llm import jaccard_join, language_id, mixing, packing, secret_spans
from affinary.sources.scratch import materialize

ORACLE_SQL = None


def _kept_whole(docs: DataFrame) -> Column:
    """All columns of a row as one, so that no name of theirs meets one used here."""
    return F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")


def in_one_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language go on, with null languages filled in; texts without letters and texts that look more like
    shuffled or random bytes than like any learned language go.  With nothing to learn from all go."""
    model = language_id.fit(docs, reject=True)
    labelled = language_id.label(docs.select(_kept_whole(docs), F.col("text").alias("text")), model, language="found")
    kept = labelled.filter(F.col("found") != language_id.UNKNOWN)
    columns = [F.coalesce("row.lang", "found").alias("lang") if name == "lang" else F.col(f"row.`{name}`") for name in docs.columns]
    return kept.select(*columns)


def _own_ids(docs: DataFrame) -> DataFrame:
    """(row, id): ``id`` names one text: doc_id, or for the texts of an id that has several a free number."""
    rows = docs.select(_kept_whole(docs), F.col("doc_id").cast("bigint").alias("own"), F.xxhash64("text").alias("hash"))
    named = rows.filter("own is not null").select("own", "hash")
    several = named.groupBy("own").agg(F.min("hash").alias("least"), F.max("hash").alias("most")).filter("least != most")
    several = materialize(several.select("own"), "near-several")
    if several.isEmpty():
        return rows.select("row", F.col("own").alias("id"))
    texts = materialize(named.join(several, "own", "left_semi").distinct(), "near-texts")
    for seed in range(100):
        given = texts.withColumn("new", F.xxhash64(F.lit(seed), "own", "hash"))
        every = named.select(F.col("own").alias("new")).distinct().unionByName(given.select("new"))
        if every.groupBy("new").count().filter("count > 1").join(given, "new", "left_semi").isEmpty():
            break
    else:
        raise RuntimeError("no free numbers found for the texts of repeated ids")
    joined = rows.join(given, ["own", "hash"], "left")
    return materialize(joined.select("row", F.coalesce("new", "own").alias("id")), "near-rows")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates (five-word shingles, similarity 0.8 or more, linked through others) the row with
    the smallest id stays.  Rows are judged one by one: of rows that repeat an id and its text one stays, and texts
    that share an id are in groups of their own.  Documents without words stay once, documents without id always."""
    rows = _own_ids(docs)
    found = jaccard_join.components_of(rows.select(F.col("id").alias("doc_id"), F.col("row.text").alias("text")), percent=80, words=5)
    found = found.filter("doc_id is not null").groupBy(F.col("doc_id").alias("id"), "component_id").agg(F.count(F.lit(1)).alias("copies"))
    found = materialize(found, "near-groups")
    given = F.col("row.doc_id").cast("bigint")
    ids = rows.filter(F.col("id").isNotNull() & (F.col("id") != given)).select("id", given.alias("given")).distinct()
    found = found.join(ids, "id", "left").withColumn("place", F.struct(F.coalesce("given", "id").alias("given"), "id"))
    first = found.groupBy("component_id").agg(F.min("place").alias("first"))
    others = found.join(first, "component_id").filter(F.col("place") != F.col("first")).select("id")
    kept = rows.join(others, "id", "left_anti")
    repeated = materialize(found.filter("copies > 1").select("id"), "near-repeated")
    if repeated.isEmpty():
        return kept.select("row.*")
    once = kept.join(repeated, "id", "left_anti").select("row.*")
    several = kept.join(repeated, "id", "left_semi").groupBy("id").agg(F.min("row").alias("row"))
    return once.unionByName(several.select("row.*"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are replaced by a mark."""
    marked = secret_spans.redact(docs)
    return marked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def in_target_proportions(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all or up to three times."""
    return mixing.mixed_documents(docs)


def in_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences; a document that the mix repeats is packed as often."""
    return packing.pack(docs)


STAGES = [
    ("language_id", in_one_language),
    ("near_duplicates", one_of_each_group),
    ("secrets", without_secrets),
    ("source_mix", in_target_proportions),
    ("packing", in_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
