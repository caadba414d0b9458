"""A training-corpus pipeline of five operators: language, near duplicates, repeated passages, personal data, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents.  A stage's result is written as Parquet
and read again as the next one's input; extra columns of documents pass through,
and on a name clash with a column that an operator works with, the input's stays.
Null texts count as empty: the language stage drops both, as they hold no letter.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdancy.llm import jaccard_join, language_id, packing, pii_crf, substring_dedup
from verdancy.llm.common import Scratch, documents, saved

#: A document stays if this share of its letters is in scripts of the known languages, of one of them or of several.
LEAST_KNOWN_SHARE = 0.5


def _apart(docs: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """docs with the columns renamed that are called like a result column."""
    return docs.select(*[F.col(f"`{c}`").alias(_name(c, names)) for c in docs.columns])


def _name(column: str, names: tuple[str, ...]) -> str:
    return f"_input_{column}" if column.lower() in names else column


def _back(docs: DataFrame, result: DataFrame, names: tuple[str, ...], text: str | None = None) -> DataFrame:
    """The columns of docs from result, with the text of the column text in the place of text."""
    put = {"text": F.col(text).alias("text"), "n_chars": F.length(text).cast("long").alias("n_chars")} if text else {}
    return result.select(*[put[c] if c in put else F.col(f"`{_name(c, names)}`").alias(c) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the known languages; those without letters, or mostly in scripts that no known language uses, go.

    Rows are judged one by one: repeated ids, null ids and repeated rows make no difference.
    """
    model = language_id.train(docs)
    found = language_id.identify(_apart(docs, language_id.RESULT), model, with_spans=False)
    kept = found.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("known_share") >= LEAST_KNOWN_SHARE))
    return _back(docs, kept, language_id.RESULT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of each group of near duplicates; documents without an id stay.

    Unrelated texts of one doc_id are groups of their own and each stays; of a
    group's texts with its smallest doc_id, that of the smallest hash stays.
    """
    found = jaccard_join.grouped_rows(docs).where("doc_id = class_id")
    mark = f"text_hash_{uuid.uuid4().hex}"  # no input column is called so
    kept = found.groupBy("doc_id", "label").agg(F.min("th").alias(mark)).select("doc_id", mark)
    named = docs.where("doc_id is not null").withColumn(mark, F.xxhash64("text"))
    named = named.join(kept, ["doc_id", mark], "left_semi").dropDuplicates(["doc_id", mark]).select(*[F.col(f"`{c}`") for c in docs.columns])
    return named.unionByName(docs.where("doc_id is null"))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the passages that a document of smaller doc_id holds; those left without a word go.

    Rows without an id stay whole and are no source; of rows that repeat an id each is judged against smaller ids.
    """
    found = substring_dedup.substring_dedup(_apart(docs, substring_dedup.RESULT))
    left = found.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    return _back(docs, left, substring_dedup.RESULT, "kept_text")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked; rows are independent of each other and of their ids."""
    found = pii_crf.find_pii(_apart(docs, pii_crf.RESULT), pii_crf.train(docs))
    return _back(docs, found, pii_crf.RESULT, "masked")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batch and slot of each document; rows that repeat an id or have none are packed like others."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("passages", passages),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: Chosen paths, random fields and BPE have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every earlier stage's table goes once the next has been written."""
    docs = documents(spark, sf_dir)
    with Scratch(spark) as scratch:
        for name, stage in STAGES[:-1]:
            docs = scratch.saved(stage(spark, docs, sf_dir), name)
        name, stage = STAGES[-1]
        return saved(stage(spark, docs, sf_dir), name)
