"""A corpus pipeline over `documents`: language, repeated lines, near duplicates, benchmark leaks, then token ids.

Each stage is written as Parquet to the shared folder and read again before the next one starts, so a lost executor
costs at most the running stage. Stages work on the five columns of `documents`; other columns of the input are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.llm import bpe, decontam, jaccard, langid, lines
from flowlab.llm.common import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Language ID rejects texts of at least LONG characters of which less than FAMILIAR of the byte pairs were learned, whose best two languages
#: are less than MIXED apart, or whose language is not the one they are labelled with, and SURE above every other. Shorter texts
#: tell too little: clean ones are unsure too.
LONG, FAMILIAR, MIXED, SURE = 100, 0.6, 0.1, 0.5


def rejection(lang: Column, n_chars: Column) -> Column:
    """Why language ID rejects a document (of `langid.identify`), or null."""
    long = n_chars >= LONG
    return (
        F.when(F.col("lang_pred") == langid.UNDETERMINED, "no letter")
        .when(long & (F.col("familiar") < FAMILIAR), "unlearned")
        .when(long & (F.col("margin") < MIXED), "mixed")
        .when(long & (F.col("margin") >= SURE) & (F.col("lang_pred") != lang), "mislabelled")
    )


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no letter, or at least LONG characters and a reason of `rejection`.

    Null and empty texts have no letter and go. A null label contradicts nothing. Repeated rows are each judged. With one learned
    language nothing is mixed or mislabelled as another one learned; with none every document goes. An empty table stays empty."""
    model = langid.fit(docs)
    scored = langid.identify(docs.select(*COLUMNS), model)
    learned = F.col("lang").isin(model.langs) if model else F.lit(False)
    lang = F.when(learned, F.col("lang"))  # a label that could not be learned contradicts nothing
    return scored.filter(rejection(lang, F.length("text")).isNull()).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line go from the texts. A document goes only if nothing is left of its text.

    Null texts stay null. Of repeated rows all get the same text. n_chars is counted anew."""
    out = lines.dedup_lines(docs.select(*COLUMNS)).filter((F.size("removed") == 0) | (F.trim("text") != ""))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: that of the smallest doc_id, of repeated rows one. Texts without a
    word (null, empty) all stay."""
    return jaccard.one_of_each(docs.select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item occurs go. Null and empty texts, and all documents if there is no item, stay."""
    return decontam.decontaminate(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what stays, with digests of the ids and of what they decode to. Null texts have no ids."""
    return bpe.encode_documents(docs.select("doc_id", "lang", "source", "text"))


STAGES = [
    ("language ID", identify_language),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", join_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("byte-level BPE encoding and decoding", encode),
]

#: SQL can express neither the network nor the encoding; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
