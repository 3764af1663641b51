"""From raw documents to token ids: the text operators as stages, each on what the last one kept.

Every stage reads the columns of documents (doc_id, text, lang, source, n_chars) by name
and returns them, whatever other columns there are; the last one returns token ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.llm.bpe import round_trip
from tidegate.llm.decontaminate import decontaminate
from tidegate.llm.language_id import UNKNOWN, identify, train_profiles, trained_on
from tidegate.llm.near_dups import near_duplicates
from tidegate.llm.suffix_dedup import suffix_dedup
from tidegate.llm.tables import documents, table
from tidegate.sources.package import send_package
from tidegate.sources.shared import fresh_dir

#: The tokenizer's file, read by the driver; the path is a parameter of the last stage.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def _key() -> Column:
    """Rows of one id and one text are judged alike, others apart."""
    return F.xxhash64("doc_id", "text")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a language that could be told: null, or without a letter.

    The profiles are learned from the documents' own ``lang``; a given ``lang`` stays, one
    that is null is filled in. A row without an id is kept if its text is. If nothing
    could be learned, every text with a letter stays.
    """
    send_package(spark)
    profiles = train_profiles(trained_on(docs))
    if not profiles:
        return _columns(docs).where(F.col("text").rlike(r"\p{L}"))
    told = identify(_columns(docs), profiles, passing=("lang", "source", "n_chars"))
    return told.where(F.col("lang_pred") != UNKNOWN).withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, the one with the smallest id; of rows that share an id, the first by text.

    Rows without an id are in no class and stay.
    """
    send_package(spark)
    kept = near_duplicates(docs).where("doc_id = group_id").select("doc_id")
    whole = _columns(docs)
    # the texts are shuffled once, by id, and rows that share an id are ranked where they meet
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.coalesce("text", F.lit(""))))
    named = whole.join(kept, "doc_id").withColumn("place", first).where("place = 1").select(*COLUMNS)
    return named.unionByName(whole.where("doc_id IS NULL"))


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of strings of 50 bytes are cut from the texts; a text that had words and has none left goes.

    Characters that a cut leaves incomplete go too. A null text stays null.
    """
    send_package(spark)
    given = _columns(docs).withColumn("given", F.col("text").isNotNull())
    cut = suffix_dedup(given, as_text=True, passing=("lang", "source", "n_chars", "given"))
    some = cut.where((F.col("n_removed") == 0) | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]"))
    n_chars = F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length("kept_text").cast("long"))
    return some.withColumn("n_chars", n_chars).withColumn("text", F.when(F.col("given"), F.col("kept_text"))).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    found = decontaminate(docs.withColumn("doc_id", _key()), table(spark, sf_dir, "benchmark"))
    hit = found.where("contaminated").select(F.col("doc_id").alias("row_key")).distinct()
    return _columns(docs).withColumn("row_key", _key()).join(hit, "row_key", "left_anti").select(*COLUMNS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, its token ids, their number, and digests of the ids and of the text they decode to."""
    send_package(spark)
    return round_trip(docs, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", identify_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeated_strings),
    ("benchmark_decontamination", drop_contaminated),
    ("bpe_encoding", encode_tokens),
]

#: Stage 1 trains profiles, stage 2 samples hashes and stage 5 applies merges: SQL says none of these.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
