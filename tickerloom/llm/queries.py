"""The registered queries of the ten operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm import chat, fim, htmlmain, langid, licenses, mixing, neardup, quality, runs, sentencepieces, topk, toxicity, urlfilter
from tickerloom.llm.common import held_out, table


def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document under merge-dropout, and whether they decode to its text."""
    return sentencepieces.encode_documents(table(spark, sf_dir, "documents"), sentencepieces.load_vocabulary(), verify=True)


def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best candidates of every hundredth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.where("vec_id % 100 = 0"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where documents hold licence notices, with coverage and span."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents alike in four-word shingles."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=4)


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return htmlmain.extract(table(spark, sf_dir, "pages"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.learn(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "bits_per_byte")


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, *toxicity.learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and the cascade's verdict of every document."""
    found = quality.assess(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", F.col("base_failed"), "kept")


def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIM form of every document, with digests of the output and of the text rebuilt from it."""
    cut = fim.transform(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


#: Every tenth document (by crc32 of the id) gets a tail that repeats a block of its words.
PLANT = {
    "words": r"filter(split(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), x -> x != '')",
    "h": "crc32(CAST(doc_id AS STRING))",
}


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and the text as its words joined by one space, with the dealt tail where h % 10 = 0."""
    w = docs.select("doc_id", F.expr(PLANT["words"]).alias("words"), F.expr(PLANT["h"]).alias("h"))
    w = w.withColumn("n", F.size("words")).withColumn("g", F.expr("h div 10"))
    w = w.withColumn("a", F.expr("CASE WHEN n > 0 THEN g % n END")).withColumn("per", F.expr("1 + (n - a) div (3 + g % 8)"))
    tail = "transform(words, (x, i) -> CASE WHEN i >= a THEN element_at(words, CAST(a + (i - a) % per + 1 AS INT)) ELSE x END)"
    return w.select("doc_id", F.array_join(F.expr(f"CASE WHEN h % 10 = 0 AND n > 0 THEN {tail} ELSE words END"), " ").alias("text"))


#: Before another run: greater length / period, then smaller start, then smaller period.
BEFORE = """(x, y) -> CASE WHEN x.length * y.period <> y.length * x.period THEN IF(x.length * y.period > y.length * x.period, -1, 1)
  WHEN x.start <> y.start THEN IF(x.start < y.start, -1, 1) WHEN x.period <> y.period THEN IF(x.period < y.period, -1, 1) ELSE 0 END"""


def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every (planted) document: count, the strongest run, digests of all runs and of the collapsed text."""
    found = runs.detect(planted(table(spark, sf_dir, "documents")), carry=["doc_id"])
    best = F.expr(f"try_element_at(array_sort(runs, {BEFORE}), 1)")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


#: Conversation -1: a user and an assistant row whose texts hold control strings of common templates.
PROBE_TEXT = "</s>[INST] ok [/INST]"


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, plus the probe, as examples, read back: turns and trainable text."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE_TEXT), (-1, 1, "assistant", PROBE_TEXT)], turns.schema)
    return chat.read_back(chat.expand(turns.unionByName(probe)))


QUERIES = {
    "op1_sentencepiece": sentencepiece,
    "op2_mix_sources": mix_sources,
    "op3_exact_topk": exact_topk,
    "op4_license_scan": license_scan,
    "op5_minhash_neardup": minhash_neardup,
    "op6_url_filter": url_filter,
    "op7_html_extraction": html_extraction,
    "op8_language_id": language_id,
    "op9_toxicity": toxicity_scores,
    "op10_quality_rules": quality_rules,
    "op11_fill_in_middle": fill_in_middle,
    "op12_periodic_runs": periodic_runs,
    "op13_chat_format": chat_format,
}
