"""The corpus pipeline: five stages over `documents`, each of which keeps what it does not refuse.

Every stage takes (spark, docs, folder of the given tables) and returns rows with the columns of
`documents`; its result is written and read back as the docs of the next.  The last one emits
documents as often as the mix takes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.llm import decontaminate, language, mixing, simhash, substring_dedup
from martweave.llm.queries import table
from martweave.llm.store import kept

# a text whose shortest code is longer than its plain bytes, by more bits than chance explains, is
# written in no learned language
PLAIN_BITS, SURPLUS_BITS = 8.0, 64.0


def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Leaves out texts without letters and texts that every learned language lengthens."""
    model = language.fit(docs.where(language.learnable()))
    judged = language.predict(docs, model)
    surplus = (F.col("bits_per_byte") - PLAIN_BITS) * F.octet_length("text")
    return judged.where((F.col("lang_pred") != language.UNKNOWN) & (surplus <= SURPLUS_BITS)).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps one document of each group of near copies, one with the smallest id."""
    return simhash.one_per_group(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Cuts passages that an earlier document holds; texts of which nothing is left go."""
    cut = substring_dedup.remove_repeats(docs).where("n_removed = 0 or n_removed < n_words")
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    columns = {"text": text}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(changed, F.length("kept_text")).otherwise(F.col("n_chars")).cast("long")
    return cut.select(*[columns.get(c, F.col(c)).alias(c) for c in docs.columns])


def without_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Leaves out documents that hold a benchmark passage."""
    return decontaminate.clean(docs, table(spark, folder, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Emits documents so that the sources come near their target weights."""
    return mixing.mix_rows(docs)


STAGES = [
    ("language", known_language),
    ("simhash", one_of_each_group),
    ("substrings", without_repeats),
    ("benchmark", without_benchmark),
    ("mix", mixed),
]

# models, XXH64 and digests have no SQL form; the pipeline is tested against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, folder), f"pipeline-{name}")
    return docs
