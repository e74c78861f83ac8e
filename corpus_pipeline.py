"""Corpus pipeline over ``documents``: the stages and the run that chains them.

Each stage is a function (spark, docs, sf_dir) -> DataFrame. ``run`` writes a
stage's rows as Parquet in the shared folder and hands the reread table to the
next stage, so each stage starts from a committed table and works on all that
its predecessor kept. All stages but the last return the columns of
``documents``, further columns of the input included, with the values that
came in, whatever they are called.

Defined cases: a null or empty text is clean of the benchmark, has no near
copies, the toxicity of an empty passage, and size 0 in the mix (kept or left
by its source's rate); a document without an id stays in the near-copy stage
and sorts first in the store; rows that repeat an id are one document for the
near-copy stage, which keeps one of them; a null source is a source of its own;
without labels nothing is toxic, without a benchmark nothing is contaminated;
an empty table passes every stage and gives an empty store. A text of any
length goes through whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratecraft.llm.common import table
from ratecraft.llm.op01_token_store import token_store
from ratecraft.llm.op05_superminhash import drop_duplicates
from ratecraft.llm.op07_decontam import clean_documents
from ratecraft.llm.op08_mix import emit_mix
from ratecraft.llm.op10_toxicity import keep_clean
from ratecraft.session import materialize

#: Words of a shingle in the near-copy stage (``op5_minhash_dedup`` takes two).
SHINGLE = 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject (score below 0.5)."""
    return keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each near-duplicate group by shingles of ``SHINGLE`` words."""
    return drop_duplicates(docs, SHINGLE)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return emit_mix(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-ID store of every document that is left; its index is the result."""
    return token_store(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mix_sources", mix_sources),
    ("token_store", encode_tokens),
]

#: The stages hold a trained model, link search and encoded ids, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
