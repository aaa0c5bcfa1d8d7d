"""op6: SentencePiece ids and decoded text of all documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from runledger.llm import pieces
from runledger.llm.common import table


def op6_sentencepiece(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256, covered_bytes."""
    path = model or public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode_pieces(table(spark, sf_dir, "documents"), path, arrays=())


QUERIES = {"op6_sentencepiece": op6_sentencepiece}
