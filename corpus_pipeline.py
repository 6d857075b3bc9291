"""Corpus pipeline: language, near-duplicates, benchmark passages, mix, tokens.

``run(spark, sf_dir)`` sends ``documents`` through STAGES. Each stage is written as
Parquet to the shared folder and read again as the next one's documents, so a lost
executor costs one stage's tasks and never the stages before. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innspark.llm import decontaminate, langid, minhash, mixing, token_store
from innspark.llm.common import scratch, ship, table, written
from innspark.llm.queries import byte_bpe, piece_bpe
from innspark.session import ensure_checkpoint_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SHINGLE_WORDS = 5
LEAST_SCORE = 0.5  # posterior of the best language


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a letter, and those whose best language isn't
    likelier than all others together, go. The model learns from the rows of
    ``docs`` that carry a lang and aren't held out; every document is scored."""
    _ready(spark)
    model = langid.fit(langid.held_out(docs).where("not held_out"), piece_bpe())
    scored = langid.predict(docs.select(*COLUMNS), model)
    return scored.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)
                        ).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: of each group linked by five-word shingles at a similarity
    of 0.8 or more, the document with the smallest doc_id stays. Rows without doc_id
    stay; rows that repeat a doc_id and text stay or go together."""
    _ready(spark)
    judged = minhash.near_duplicates(docs, words=SHINGLE_WORDS)
    gone = written(judged.where("doc_id > component_id").select("doc_id").distinct(), "gone")
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti")


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a window of ten words of a benchmark
    item (or the whole of a shorter item) go."""
    _ready(spark)
    return decontaminate.remove_documents(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights: a document appears as often as the mix takes it."""
    _ready(spark)
    docs = docs.select(*COLUMNS)
    return mixing.take(docs, mixing.mix(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-ID output: the store's documents, read back from its files."""
    _ready(spark)
    store = scratch(spark, "tokens")
    token_store.write_store(docs, store, byte_bpe())
    return token_store.read_documents(spark, store, ids=False)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark", clean_of_benchmark),
    ("mix", mix_sources),
    ("tokens", tokens),
]

ORACLE_SQL = None  # the first, second, fourth and fifth stage have no SQL


def _ready(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship(spark)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the documents in the token store."""
    _ready(spark)
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
