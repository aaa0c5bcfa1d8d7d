"""op13: all documents in sequences of at most 1024 tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from runledger.llm import packing
from runledger.llm.common import table

CAPACITY, END_ID = 1024, 2


def op13_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), path, CAPACITY, END_ID)
    return packing.pack(pieces.drop("ids"), CAPACITY)


QUERIES = {"op13_packing": op13_packing}
