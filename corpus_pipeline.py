"""From raw documents to packed training windows, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows of `docs`, and returns
the columns of `documents`, but for the last, which returns packed pieces. Its
result is written and read again before the next stage.

Nulls in any column, empty texts and empty tables are allowed everywhere. A
document without text is judged by the quality network like any other and has
no language, so it goes in the second stage at the latest.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lineloom.llm import language, linededup, packing, quality, setjoin
from lineloom.llm.common import keyed_mod, table
from lineloom.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_QUALITY, LEAST_CONFIDENCE = 0.5, 0.5
# Texts make long rows; small Arrow batches bound what a Python worker and its JVM hold of them at a time.
ARROW_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}
# Bits that a text may need: a multiple of what its language needs a byte, and what a few odd words cost.
MOST_BITS, SPARE_BITS = 1.5, 256


def bound_batches(spark: SparkSession) -> None:
    """Settings for stages that run Python; the session keeps them, as plans run after the stage returns."""
    for setting, value in ARROW_BATCHES.items():
        spark.conf.set(setting, value)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier gives an even chance or better of good quality."""
    bound_batches(spark)
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    net = quality.learn(docs.select("doc_id", "text"), labels.where(keyed_mod("doc_id", 3) != 1))
    scored = quality.score(docs.select(*COLUMNS), net, out="_score")
    return scored.where(F.col("_score") >= LEAST_QUALITY).select(*COLUMNS)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; a missing `lang` is filled in.

    A text is known if it needs few enough bits under its language, by what held
    back learning texts need. Without any labelled text all documents are kept.
    """
    bound_batches(spark)
    samples = language.sample(docs.where(keyed_mod("doc_id", 4) != 2), order_by=F.col("doc_id"))
    model = language.fit(samples)
    if model is None:
        return docs.select(*COLUMNS)
    found = language.identify(docs.select(*COLUMNS), model, pred="_lang", score="_score", bits="_bits")
    usual = F.lit(float("inf"))
    for name, bits in language.usual_bits(samples).items():
        usual = F.when(F.col("_lang") == name, bits).otherwise(usual)
    fluent = F.col("_bits") <= MOST_BITS * usual * F.octet_length("text") + SPARE_BITS
    known = found.where((F.col("_lang") != language.UNKNOWN) & (F.col("_score") >= LEAST_CONFIDENCE) & fluent)
    return known.withColumn("lang", F.coalesce("lang", "_lang")).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines that an earlier line says as well; those left without words go.

    All lines with a character besides white space count, and near copies are
    searched from the least length on that the join can search.
    """
    found = linededup.dedup_lines(
        docs.select(*COLUMNS), edits=2, least=1, least_near=linededup.shortest(2), stays=r"\A\s*\z"
    )
    emptied = (F.size("dropped") > 0) & F.col("text").rlike(r"\A\s*\z")
    left = found.where(~F.coalesce(emptied, F.lit(False)))
    changed = F.when(F.size("dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", changed).select(*COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    bound_batches(spark)
    return setjoin.one_of_each(docs.select(*COLUMNS), k=5, percent=80)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 1024 token ids."""
    bound_batches(spark)
    pieces = packing.pack(
        docs, tokenizer=public_tokenizers.path("byte_bpe_50k.json"), pattern=public_tokenizers.PATTERN
    )
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_stage),
    ("packing", packing_stage),
]
# A trained network decides in the first stage; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other, each written and read again."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
