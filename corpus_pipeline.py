"""A corpus pipeline of five stages, each written as Parquet before the next reads it.

``documents`` (doc_id, text, lang, source, n_chars) -> sequences of at most 1024 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import language, mixing, near_dedup, packing, substring_dedup
from tidegate.llm.queries import tokenizer_path
from tidegate.llm.shared import only, stored
from tidegate.session import tune

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SCORE = 0.3


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identifiable language go: no letter, or a score below LEAST_SCORE."""
    docs = only(docs, *COLUMNS)
    named = language.identify(docs, language.fold(3) != 1)
    return only(named.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)), *COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays, with the least id (five words, 0.8).

    A row is known by its id and the digest of its text, so rows of one id are judged each by its own text; of
    rows of the least id in one group the one with the least digest stays, once. Rows without words or id stay.
    """
    key = ["doc_id", "mark"]
    docs = only(docs, *COLUMNS).withColumn("mark", F.md5(F.coalesce("text", F.lit(""))))
    named = docs.select(
        F.when(F.col("doc_id").isNotNull(), F.xxhash64(*key)).alias("doc_id"), "text", F.concat_ws(":", *key).alias("name")
    )
    judged = near_dedup.near_duplicates(named, mark="name").filter("n_shingles > 0 AND doc_id IS NOT NULL").select(
        "component_id", F.split_part("name", F.lit(":"), F.lit(1)).cast("long").alias("doc_id"), F.split_part("name", F.lit(":"), F.lit(2)).alias("mark")
    )
    rows = stored(judged.groupBy("component_id", *key).agg(F.count("*").alias("rows")), "pipeline-near-rows")
    groups = (
        rows.groupBy("component_id").agg(F.min(F.struct(*key, "rows")).alias("first"), F.sum("rows").alias("rows"))
        .filter("rows > 1").select("component_id", "first")
    )
    gone = rows.join(groups, "component_id").filter("doc_id <> first.doc_id OR mark <> first.mark").select(*key)
    repeated = groups.filter("first.rows > 1").select("first.doc_id", "first.mark")
    left = docs.join(gone, key, "left_anti")
    once = left.join(repeated, key).groupBy(*key).agg(F.min(F.struct(*COLUMNS)).alias("row"))
    return left.join(repeated, key, "left_anti").select(*COLUMNS).unionByName(once.select("row.*"))


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 50 words that a document with a smaller id has are cut out of the text."""
    docs = only(docs, *COLUMNS)
    cut = (
        substring_dedup.remove_repeated(docs).filter("n_removed > 0 AND doc_id IS NOT NULL")
        .groupBy("doc_id", "sha").agg(F.min("kept").alias("kept"))
    )
    text = F.coalesce("kept", "text")
    # Rows of one id can differ in their words, so the words' hash is part of the key.
    return docs.withColumn("sha", substring_dedup.sha_of_words(F.col("text"))).join(cut, ["doc_id", "sha"], "left").select(
        "doc_id",
        text.alias("text"),
        "lang",
        "source",
        F.when(F.col("kept").isNotNull(), F.length("kept")).otherwise(F.col("n_chars")).cast("long").alias("n_chars"),
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stands in the mix as often as it is taken whole; the last, partial turn counts from half its words.

    A document that the mix takes less than half of once leaves; one that it takes
    twice stands there twice.
    """
    docs = only(docs, *COLUMNS)
    taken = (
        mixing.mix(docs).filter("size > 0")
        .select("doc_id", "source", "size", F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("times"))
        # Rows of one id, source and size share a key; one value each, or the join would multiply them.
        .filter("times > 0").groupBy("doc_id", "source", "size").agg(F.max("times").alias("times"))
    )
    same = docs.withColumn("size", mixing.word_count(F.col("text"))).alias("d")
    return (
        same.join(
            taken.alias("t"),
            F.col("d.doc_id").eqNullSafe(F.col("t.doc_id")) & F.col("d.source").eqNullSafe(F.col("t.source"))
            & (F.col("d.size") == F.col("t.size")),
        )
        .select(*[F.col(f"d.{c}") for c in COLUMNS], F.explode(F.sequence(F.lit(1), F.col("times"))).alias("turn"))
        .select(*COLUMNS)
    )


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their sequences and places."""
    return packing.pack(only(docs, *COLUMNS), tokenizer_path(), added=True)


STAGES = [
    ("language_id", identify_languages),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", remove_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Language inference and tokenisation have no SQL form; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
