"""A training-data pipeline of the operators in ``subjectlog.llm``: each stage's rows are the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subjectlog.llm.common import free_name, table, written
from subjectlog.llm.mixing import mixed_documents
from subjectlog.llm.ngram_join import one_of_each
from subjectlog.llm.quality import quality_network, score
from subjectlog.llm.secrets import redact, trained_scanner
from subjectlog.llm.sentencepiece import encode_documents, public_model


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (a probability below one half) go."""
    name = free_name(docs, "quality")
    scored = score(docs, quality_network(spark, docs, sf_dir), as_column=name)
    return scored.where(F.col(name) >= 0.5).select(*docs.columns)


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by their word shingles one stays."""
    return one_of_each(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark; every document stays."""
    language, forest = trained_scanner(docs)
    return redact(docs, language, forest, path_column="source")


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Source mix: documents not taken go, those taken twice come twice."""
    return mixed_documents(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document that is left, with the text decoded from them."""
    return encode_documents(docs, public_model(), ("n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("quality", quality_stage),
    ("ngram_join", duplicates_stage),
    ("secrets", secrets_stage),
    ("mixing", mix_stage),
    ("sentencepiece", encode_stage),
]

# The classifiers are trained models, which SQL cannot express: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
