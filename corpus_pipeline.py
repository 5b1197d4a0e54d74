"""From documents to packed training sequences, stage by stage."""

from foliosift.llm.decontamination import contamination
from foliosift.llm.line_dedup import dedup_lines
from foliosift.llm.near_dedup import one_of_each
from foliosift.llm.packing import pack_documents
from foliosift.llm.toxicity import toxicity
from foliosift.session import scratch_path

# Near duplicates of the corpus: 100 * intersection >= NEAR_PERCENT * union.
NEAR_PERCENT = 80
# Words that a Python worker remembers for packing. It lives on beside the work of other
# stages, so it keeps fewer than where packing is all there is.
CACHE_WORDS = 250_000


def clean_documents(spark, docs, sf_dir):
    """Documents that the toxicity chain does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity(docs, labels).filter("not rejected").select(*docs.columns)


def unrepeated_lines(spark, docs, sf_dir):
    """Documents without the lines that an earlier document holds."""
    return dedup_lines(docs).select(*docs.columns)


def distinct_documents(spark, docs, sf_dir):
    """One document of each group of near duplicates."""
    return one_of_each(docs, percent=NEAR_PERCENT).select(*docs.columns)


def unseen_documents(spark, docs, sf_dir):
    """Documents without a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(docs, benchmark).filter("not contaminated").select(*docs.columns)


def packed_sequences(spark, docs, sf_dir):
    """Pieces of the documents in sequences."""
    return pack_documents(docs, cache_words=CACHE_WORDS)


STAGES = [
    ("toxicity", clean_documents),
    ("line dedup", unrepeated_lines),
    ("near dedup", distinct_documents),
    ("decontamination", unseen_documents),
    ("packing", packed_sequences),
]
# Trained models and tokenizers are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents of ``sf_dir``; each is stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
