"""From raw documents to token files: each stage reads what the one before it kept, and its decisions take effect.

Columns beside doc_id, text and source pass through all stages but the last, whatever their names. An empty table gives an empty one in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftline.functions.sizing import store
from driftline.llm.aligning import without_leaks
from driftline.llm.languages import keep_known
from driftline.llm.mixing import mix
from driftline.llm.near_texts import keep_one
from driftline.llm.registry import table
from driftline.llm.token_files import write_and_read


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; null and empty texts, and texts without a letter, go. Equal rows are judged alike. Without a labelled text all rows stay."""
    return keep_known(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more.

    Of rows of equal id and text one stays, unlike texts of one id all stay, and so do rows of null id and texts without words.
    """
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, copied or edited; null and empty texts hold none, and a long text is searched whole."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks; a repeated document is a repeated row. A null source is a source, a null text has no size."""
    return mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all rows in doc_id order; what each row became, read back from them. Null and empty texts are an end id, equal rows follow each other."""
    import public_tokenizers

    return write_and_read(docs, public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [("language_id", language_id), ("minhash_near_dedup", near_dedup), ("decontamination", decontaminate),
          ("mix_sources", mix_sources), ("token_files", token_files)]

# Suffix automata, minhashes, alignments and a tokenizer are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = store(docs)
    return docs
