"""Corpus pipeline over ``documents``: classify, join near duplicates, cut repeats, mix, encode.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. Each works on all rows that the stage before kept, and all
but the last return the columns that they were given. Null texts count as
empty, rows with a null doc_id pass the duplicate stages unchanged, and an empty
table passes as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from torque.llm import line_crf
from torque.llm.columns import stored
from torque.llm.ngram_join import ngram_jaccard_join
from torque.llm.queries import table, tokenizer_path
from torque.llm.sentencepiece_codec import sentencepiece_round_trip
from torque.llm.source_mix import mix_sources
from torque.llm.substring_dedup import substring_dedup

SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
REPEAT_WORDS = 13


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents scored below the threshold go. The model is
    fitted on the labelled documents among ``docs``."""
    model = line_crf.train(docs, table(spark, sf_dir, "labels"))
    return (line_crf.score(docs, model, name="__score")
            .filter(F.col("__score") >= line_crf.THRESHOLD).select(*docs.columns))


def keep_one_of_a_kind(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each component one row of smallest id stays.

    Rows are told apart by id and text, and rows alike in both by number, so an
    id with two texts loses only the one that is a near copy. Rows without words
    or without an id stay.
    """
    found = ngram_jaccard_join(docs, percent=SIMILAR_PERCENT, words_each=SHINGLE_WORDS,
                               by_text=True)
    gone = found.filter("doc_id IS NOT NULL AND NOT stays").select(
        "doc_id", F.col("text_hash").alias("__hash")).distinct()
    keys = ["doc_id", "__hash"]
    alike = Window.partitionBy(*keys).orderBy(F.xxhash64(*docs.columns))
    single = (F.col("__copy") == 1) | F.col("doc_id").isNull() | ~F.coalesce(
        F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return (docs.withColumn("__hash", F.xxhash64(F.coalesce("text", F.lit(""))))
            .join(gone, keys, "left_anti").withColumn("__copy", F.row_number().over(alike))
            .filter(single).select(*docs.columns))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: repeated words go, and documents of which nothing is left.

    A text without repeats stays as it is; otherwise the kept words are joined
    by blanks and n_chars is set anew.
    """
    rest = [c for c in docs.columns if c != "text"]
    cut = substring_dedup(docs.withColumn("__no_text", F.col("text").isNull()),
                          window=REPEAT_WORDS, carry=[*rest, "__no_text"])
    changed = F.col("n_removed") > 0
    columns = {c: F.col("carried").getField(c) for c in rest}
    columns["text"] = F.when(~F.col("carried.__no_text"), F.col("kept_text"))
    if "n_chars" in rest:
        columns["n_chars"] = F.when(changed, F.char_length("kept_text").cast(
            docs.schema["n_chars"].dataType)).otherwise(columns["n_chars"])
    return cut.filter(~changed | (F.col("n_removed") < F.col("n_words"))).select(
        *[columns[c].alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Source mix: one row per document and pass with the words taken."""
    return mix_sources(docs).documents()


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every mixed text, with proof of the way back."""
    return sentencepiece_round_trip(docs, tokenizer_path("pieces"))


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram jaccard join", keep_one_of_a_kind),
    ("substring dedup", cut_repeats),
    ("source mix", mix),
    ("sentencepiece codec", encode),
]

# A fitted model, seeded draws and a tokenizer cannot be expressed in SQL; the
# tests check each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written before the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs)
    return docs
