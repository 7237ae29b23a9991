"""From raw documents to encoded training data: five stages, each written as Parquet and read by the next.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of ``documents``;
other columns of the input are left behind.

1. ``quality_rules``: documents that fail the base or a rule of the cascade go.
2. ``language_id``: documents whose language is undetermined, or whose text takes more than ``MAX_BITS`` bits per
   byte under the best language (gibberish), go. Where no language can be learned, nothing is rejected.
3. ``near_dedup``: of documents alike in five-word shingles (0.8 or more), one of each group stays.
4. ``mix_sources``: the mix's stretches of documents; a document can come twice, or in part.
5. ``sentencepiece``: ids under merge-dropout beside the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickerloom.llm import langid, mixing, neardup, quality, sentencepieces
from tickerloom.staging import new_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MAX_BITS = 6.0

#: Trained models and agendas are beyond SQL; tests/llm compares the run with a brute-force version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.assess(docs, COLUMNS, only_kept=True).select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.learn(docs)
    return docs.select(*COLUMNS) if model is None else langid.predict(docs, model, COLUMNS, MAX_BITS).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.drawn_documents(docs.select(*COLUMNS))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepieces.encode_documents(docs, sentencepieces.load_vocabulary(), COLUMNS)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, as a written table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
