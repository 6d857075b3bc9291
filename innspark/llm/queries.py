"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from innspark.llm import (
    decontaminate, embedding_dedup, html_extract, langid, lexical_search, line_dedup, minhash, mixing,
    prefix_trie, quality_rules, secret_scan, substring_dedup, token_store)
from innspark.llm.common import ship, table
from innspark.session import ensure_checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _over(operator: Callable, *tables: str, **parameters: Callable) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        ship(spark)
        return operator(*(table(spark, sf_dir, t) for t in tables),
                        **{k: v() for k, v in parameters.items()})

    run.__name__ = operator.__name__
    return run


QUERIES: dict[str, Query] = {
    "op1_token_store": _over(token_store.op1_token_store, "documents", tokenizer=byte_bpe),
    "op2_mixing": _over(mixing.op2_mixing, "documents"),
    "op3_near_duplicates": _over(minhash.op3_near_duplicates, "documents"),
    "op4_language": _over(langid.op4_language, "documents", vocab=piece_bpe),
    "op5_secrets": _over(secret_scan.op5_secrets, "documents"),
    "op6_decontaminate": _over(decontaminate.op6_decontaminate, "documents", "benchmark"),
    "op7_line_dedup": _over(line_dedup.op7_line_dedup, "documents"),
    "op8_substrings": _over(substring_dedup.op8_substrings, "documents"),
    "op9_embeddings": _over(embedding_dedup.op9_embeddings, "embeddings"),
    "op10_html": _over(html_extract.op10_html, "pages"),
    "op11_lexical_search": _over(lexical_search.op11_lexical_search, "documents", "benchmark"),
    "op12_prefix_trie": _over(prefix_trie.op12_prefix_trie, "conversations"),
    "op13_quality": _over(quality_rules.op13_quality, "documents", "labels"),
}

ORACLE_SQL: dict[str, str] = {
    "op6_decontaminate": decontaminate.ORACLE,
    "op7_line_dedup": line_dedup.ORACLE,
    "op11_lexical_search": lexical_search.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
}
