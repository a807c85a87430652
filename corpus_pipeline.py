"""The corpus pipeline: five operators in a row over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run` writes what a
stage returns as Parquet under the shared folder and reads it again as the next one's
documents. All stages but the last return the columns of ``documents``; the last returns
the encoded corpus.

Every stage keeps null and empty texts unless its own verdict rejects them: a null or empty
text has no toxic feature and stays in the first stage, has no letter and goes in the second.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from scoutlens.llm import langid, mixing, sentencepiece, simhash, toxicity
from scoutlens.llm.common import fold_of, materialize

TOXIC = 0.7            # texts that score this much go
SURE = 0.5             # texts whose best language has a smaller share go
SHINGLE, BITS = 3, 3   # as the near-duplicate operator's contract
MIX = {"target_entropy": 0.95, "max_repeat": 4.0, "seed": 7}

#: not expressible in SQL: trained classifiers and sampled segmentations
ORACLE_SQL = None


def drop_toxic(spark, docs, sf_dir):
    """Toxicity (6): learns from the labels of two thirds of the rows; texts that score TOXIC or more go."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = toxicity.fit(docs.where(fold_of("doc_id", 3) != 1), labels.where(fold_of("doc_id", 3) != 1))
    return toxicity.where_clean(docs, model, TOXIC)


def keep_known_language(spark, docs, sf_dir):
    """Language ID (4): texts without a letter or without a sure language go."""
    model = langid.fit(docs.where(fold_of("doc_id", 4) != 2))
    return langid.where_known(docs, model, SURE)


def drop_near_duplicates(spark, docs, sf_dir):
    """SimHash near-dedup (5): the smallest doc_id of each group stays."""
    return simhash.keep_one(docs, words=SHINGLE, max_bits=BITS)


def mix_sources(spark, docs, sf_dir):
    """Mixing (8): rows are left out or repeated until each source has its target weight."""
    return mixing.mix(docs, **MIX)


def encode(spark, docs, sf_dir):
    """SentencePiece (3): sampled segmentations of every text."""
    return sentencepiece.encode(docs, keep=("source",))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_known_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]


def run(spark, sf_dir):
    """All stages over ``documents``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs.select("doc_id", "source", "sample", F.size("ids").cast("long").alias("n_pieces"), "ids",
                       F.round("log_prob", 6).alias("log_prob"), F.round("log_inclusion", 6).alias("log_inclusion"))
