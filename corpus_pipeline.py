"""A corpus from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in the shared
folder and gives what it reads back to the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, mixing, ngram_join, quality, secret_scan
from ledgerloom.llm.tables import Scratch, bound_batches, table, with_likely

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; it learns from ``labels``.

    Without a document that is labelled as good it rejects nothing. Null texts are empty ones.
    """
    bound_batches(spark)
    scored = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")), score_col="_score")
    return scored.where(F.col("_score") >= quality.THRESHOLD).drop("_score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 80 % of five-word shingles: that of least id, then of least text hash.

    Texts under one id are documents of their own where they aren't alike. Documents without words and those
    without an id have no group and stay.
    """
    bound_batches(spark)
    groups = Scratch(spark, "duplicates").write(ngram_join.ngram_groups(docs, words=5, percent=80).where("`group` is not null").select("doc_id", "text_key", "group"))
    named = F.struct("doc_id", "text_key").alias("document")
    first = groups.groupBy("group").agg(F.min(named).alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = first.select("first.*").withColumn("_first", F.lit(True))
    # Only rows that may go are dealt by document; the others stay where they are.
    several = groups.join(first.select("group"), "group", "left_semi").select("text_key").distinct()
    flagged = with_likely(docs.withColumn("text_key", F.xxhash64("text")), several, "text_key", "_check")
    flagged = flagged.withColumn("_check", F.col("_check") & F.col("doc_id").isNotNull())
    alone = groups.join(first.select("group"), "group", "left_anti").select("doc_id", "text_key", F.lit(True).alias("_alone"))
    key = ["doc_id", "text_key"]
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*key))
    checked = flagged.where("_check").join(firsts, key, "left").join(alone, key, "left").withColumn("_place", place)
    wordless = ~F.coalesce(F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    stays = checked.where((F.col("_first") & (F.col("_place") == 1)) | F.col("_alone") | wordless)
    return flagged.where("not _check").select(*docs.columns).unionByName(stays.select(*docs.columns))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with what the scan finds replaced by its kind in brackets."""
    bound_batches(spark)
    masked = secret_scan.mask_secrets(docs, VOCABULARY, public_tokenizers.PATTERN)
    return masked.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, once for each time, dealt by output shard and shuffled in it."""
    return mixing.mixed_rows(mixing.mix_sources(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's token ids, as little-endian 32-bit integers, their number, and whether they decode to the text."""
    coded = bpe.encode_decode(docs.select(F.struct("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")).alias("key"), "text"), VOCABULARY, public_tokenizers.PATTERN, id_col="key")
    return coded.select(
        F.col("key.doc_id").alias("doc_id"),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        (F.sha2("decoded", 256) == F.col("key.digest")).alias("round_trip"),
    )


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix),
    ("byte-level BPE encoding and decoding", encode),
]

# Training, components and merges are iterations that SQL over the tables can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over all documents."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir))
    return docs
