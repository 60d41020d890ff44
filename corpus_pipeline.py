"""Corpus pipeline: language ID, near-duplicate removal, decontamination, mixing, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs. All but the last
return the columns of documents, whatever further columns those have. An empty
table gives an empty table at every stage; texts of any length are handled whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomdocs.llm._spark import materialize
from loomdocs.llm.decontamination import contaminated_documents
from loomdocs.llm.jaccard_join import shingle_components
from loomdocs.llm.language_id import UNKNOWN, fit_languages, held_out, predict_languages
from loomdocs.llm.mixing import in_mix_order, mix_sources
from loomdocs.llm.queries import tokenizer_path
from loomdocs.llm.token_output import token_output

#: Least probability of the predicted language.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or with no clear language, go.

    So null, empty and letterless texts go, and everything if no row is labelled.
    Ties between languages score half at most and go below LEAST_SCORE only if
    three tie. Null ids and languages and repeated rows are judged by their text.
    """
    trees = fit_languages(docs.where(~held_out()))
    predicted = predict_languages(docs, trees, docs.columns, ("stage_language", "stage_score"))
    return predicted.where((F.col("stage_language") != UNKNOWN) & (F.col("stage_score") >= LEAST_SCORE)).select(*docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document with the least doc_id stays.

    Null and empty texts are no duplicates and stay. Rows that repeat a doc_id are
    one document: they stay or go together. Rows without a doc_id stay.
    """
    others = shingle_components(docs).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts hold none. Rows that repeat a doc_id stay or go together;
    rows without a doc_id stay. With an empty benchmark all stay.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contaminated_documents(docs, benchmark).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their rows and files in the order of the mix to target weights.

    Nothing is dropped: null sources are a source of their own, repeated rows and
    rows without a doc_id keep their places.
    """
    return in_mix_order(mix_sources(docs)).select(*docs.columns)


def _by_number(name):
    """File names so that text order is that of their numbers: part-99999 before part-100000."""
    return F.concat(F.lpad(F.length(name).cast("string"), 5, "0"), name)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """ORC files of token ids in the order of the mix (that of the files read), and their digests.

    Null and empty texts have the end id alone. Repeated rows are written each.
    File names of one write differ in their numbers only; a shorter one is first.
    """
    order = ["doc_id"]
    if docs.inputFiles():
        order = ["mix_file", "mix_row"]
        docs = docs.select("doc_id", "text", _by_number(F.col("_metadata.file_name")).alias("mix_file"), F.col("_metadata.row_index").alias("mix_row"))
    return token_output(docs, tokenizer_path(), order=order)


STAGES = [("language ID", language_id), ("n-gram Jaccard join", jaccard_join), ("benchmark decontamination", decontamination), ("mixing sources to target weights", mixing), ("token-ID / binary output", token_files)]

#: SQL can't express fitted language models or the latent space; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.split()[0].lower().replace("-", "_"))
    return docs
