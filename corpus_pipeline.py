"""Documents to training tokens, in stages that each write and reread a table.

All stages take NULL in any column, empty and very long texts, repeated rows and
empty tables; further columns of any name pass through all but the last stage
unchanged. What that means is said with each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetforge.llm import byte_bpe, language_id, line_dedup, order_minhash, source_mixing
from facetforge.llm.common import quoted, set_aside
from facetforge.storage import materialise


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts without a letter, NULL and
    empty ones among them, go. The languages are learned from the rows that name
    one. A row that names none gets the language told; if no row names one, none
    can be learned, and every text with a letter stays as it is."""
    known, own = set_aside(docs, ["lang_pred", "score"])
    model = language_id.fit_languages(known)
    if not model.languages:
        return docs.filter(language_id.has_letter("text"))
    told = language_id.identify_languages(known, model)
    told = told.filter(told["lang_pred"] != language_id.UNDETERMINED)
    return told.select(
        *[
            (F.coalesce(quoted(n), F.col("lang_pred")) if c == "lang" else quoted(n)).alias(c)
            for c, n in own.items()
        ]
    )


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more repeat stay in the one of the largest
    id only. Rows with one id are one document; NULL texts become empty."""
    known, own = set_aside(docs, ["n_lines", "n_dropped"])
    deduped = line_dedup.dedup_lines(known)
    return deduped.select(*[quoted(n).alias(c) for c, n in own.items()])


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest
    id; of rows with equal id and text one stays."""
    return order_minhash.keep_one_of_each(docs)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents left out, kept or repeated as the weights of their sources ask.
    NULL is a source of its own."""
    known, own = set_aside(docs, ["size", "source_size", "target", "copies"])
    mixed = source_mixing.mix_sources(known)
    repeated = source_mixing.repeat_by_copies(mixed, list(own.values()))
    return repeated.select(*[quoted(n).alias(c) for c, n in own.items()])


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source and the ids of every document's text; NULL and empty texts
    have none."""
    return byte_bpe.encode_documents(
        docs.select("doc_id", "source", "text"), keep=("doc_id", "source")
    )


STAGES = [
    ("language ID", keep_known_language),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", keep_one_of_near_copies),
    ("mixing", mix_to_weights),
    ("byte BPE", tokenise),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = materialise(docs, "stage-" + name.replace(" ", "-"))
    return docs
