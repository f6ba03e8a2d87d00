"""A training corpus from ``documents``: five stages, each written as Parquet and read again.

quality   documents that the classifier rejects go; all others stay as they are
near      one document of each near-duplicate class stays
secrets   confirmed secrets are replaced in the texts; no document goes
mixing    sources are brought to their weights by repeated passes; every document is read at least once; rows are
          written in the order of the mixture's schedule
packing   the token streams are packed into windows, in that order

Null ids, null and empty texts, repeated rows and an empty table pass through every stage as its operator states;
columns of any name pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rostrum.llm import mixing, near, packing, quality, secrets
from rostrum.llm.common import fresh, id_crc, materialize

QUALITY_KEPT_FROM = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), id_crc() % 5 != 0)
    out = fresh(docs, "quality_score")
    return quality.score(docs, model, out=out).where(F.col(out) >= QUALITY_KEPT_FROM).drop(out)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.keep_one(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs, secrets.scan(docs, secrets.train(spark, secrets.statistics(docs)), path="source"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # the columns travel as one, so that those named like an output of the mixture keep their values
    mixed = mixing.mix(docs.select("doc_id", "source", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")))
    order = ["schedule", F.xxhash64("doc_id", "copy")]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order).select("document.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.public_tokenizer)


STAGES = [("quality", quality_stage), ("near", near_stage), ("secrets", secrets_stage), ("mixing", mixing_stage), ("packing", packing_stage)]
#: Models, hashes and a tokenizer decide: SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs
