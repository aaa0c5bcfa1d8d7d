"""op4: token files of all documents, read back."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from runledger.llm import token_files
from runledger.llm.common import table


def op4_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    folder = token_files.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_files.read_tokens(spark, folder, token_files.ids_crc32, "ids_crc32 long")


QUERIES = {"op4_token_files": op4_token_files}
