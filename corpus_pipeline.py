"""The corpus pipeline: quality, near duplicates, benchmark leaks, mixing, token files.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs. All but the last keep the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catlens.llm.decontaminate import contamination
from catlens.llm.importance import resample
from catlens.llm.mixing import mix
from catlens.llm.ngram_join import keep_one
from catlens.llm.shared import saved, ship, table
from catlens.llm.token_files import read_tokens, write_tokens


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Importance resampling towards the documents labelled good; documents that it rejects go."""
    ship(spark)
    return resample(docs, table(spark, sf_dir, "labels")).where("selected").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """n-gram Jaccard join (5 words, similarity 0.8): the least doc_id of each group stays."""
    ship(spark)
    return keep_one(docs, size=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    ship(spark)
    return contamination(docs, table(spark, sf_dir, "benchmark")).where(~F.col("contaminated")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Half of all words by equal weights of languages and of sources in them; a document taken in two epochs is there twice."""
    ship(spark)
    mixed = mix(docs)
    times = F.explode(F.array_repeat(F.lit(True), F.col("mix_copies").cast("int"))).alias("mix_time")
    return mixed.where("mix_copies > 0").select(*docs.columns, times).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-plane token files of the mixture; one row a document, read back from the files."""
    ship(spark)
    return read_tokens(spark, write_tokens(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mixing),
    ("token-ID binary output", tokens),
]

#: Trained weights, Gumbel noise, the latent space and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
