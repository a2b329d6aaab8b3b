"""A corpus pipeline: five stages, each over all that the one before it kept.

Each stage takes ``(spark, docs, sf_dir)``; ``run`` applies them in order and reads each
stage's result back from Parquet, so a lost executor costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm import decontamination, mixing, secrets, simhash, toxicity
from pageloom.llm.text import unused
from pageloom.plans.staging import stage


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold; learnt from the labelled ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    own = unused(docs, "__tox")
    scored = toxicity.score(docs, toxicity.fit(docs, labels), own)
    return scored.where(F.col(f"{own}.score") < toxicity.THRESHOLD).drop(own)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints within two bits: the smallest id."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth occurs in the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    own = unused(docs, "__hits")
    found = decontamination.decontaminate(docs, benchmark, out=own)
    return found.where(~F.col(f"{own}.contaminated")).drop(own)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in the text."""
    new = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return new
    kind = docs.schema["n_chars"].dataType
    return new.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as columns: each document with the words taken and the shards that hold them.

    Rows and texts are those of the stage before.  Its reader applies the mix: documents
    with ``taken = 0`` are not part of it, of the others ``taken`` words are (more than
    ``size``: the text again from its start), and ``shards`` says where they go.  Columns
    that are there before keep their names and values; a new one of the same name gets an
    underscore behind its own.
    """
    own = unused(docs, "__mix")
    mixed = mixing.mix(docs, own)
    names = ("size", "source_size", "target", "taken")
    return mixed.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        *[F.col(f"{own}.{n}").alias(unused(docs, n)) for n in names],
        F.transform(F.col(f"{own}.parts"), lambda p: p["shard"]).alias(unused(docs, "shards")),
    )


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

#: SQL has no such classifier, hash or fingerprint search; tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
