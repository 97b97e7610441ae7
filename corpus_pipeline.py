"""From raw documents to token files, in stages that each write their result for the next.

    python -c "import corpus_pipeline as p; p.run(spark, folder).show()"

Every stage takes (spark, docs, sf_dir) and returns a table. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmart.llm.common import Scratch, importable, table
from brookmart.llm.decontamination import clean, find_leaks
from brookmart.llm.jaccard_join import near_duplicates
from brookmart.llm.language import identify, learn
from brookmart.llm.mixing import mix_sources
from brookmart.llm.token_files import tokenise


PLACE = "_place_of_row"


def located(docs: DataFrame) -> DataFrame:
    """Documents with the file and number of each row, by which a decision finds its row again; texts need not travel with it."""
    return docs.withColumn(PLACE, F.struct("_metadata.file_path", "_metadata.row_index"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without text or letters go, and lang takes the prediction."""
    importable(spark)
    found = identify(docs, learn(docs), keep=docs.columns)
    return found.where("lang_pred <> 'und'").withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more): the one with the smallest identifier."""
    placed = located(docs)
    found = near_duplicates(placed, words=5, percent=80, keep=[PLACE]).where("stays").select(F.col("row")[PLACE].alias(PLACE))
    return placed.join(found, PLACE, "left_semi").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"), docs.columns)
    return found.where(clean(F.col("leaks"))).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the mix takes them; sources keep their words to the nearest document."""
    placed = located(docs)
    taken = mix_sources(placed, carry=[PLACE]).where("copies > 0").select(
        F.col("row")[PLACE].alias(PLACE), F.sequence(F.lit(1), "copies").alias("_copies_of_row"))
    return placed.join(taken, PLACE).withColumn("_copies_of_row", F.explode("_copies_of_row")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place and checksum of each document in the token files written."""
    return tokenise(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("language", language),
    ("near copies", near_copies),
    ("decontamination", decontaminated),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: Hashes, suffix automata and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written to the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        done = scratch.keep(stage(spark, docs, sf_dir), name)
        if name != STAGES[0][0]:
            scratch.drop(docs)
        docs = done
    return docs
