"""Token counts of whole texts.

Batched pre-tokens are ragged numpy arrays; each round applies every pre-token's lowest-rank pair at once, and the
symbols that survive are counted (``merging``). No text is cut short and nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearcurve.llm.units import ASCII_SPACE, by_text, map_texts, schema_with
from wearcurve.llm.word_bpe import merged_counts
from wearcurve.llm.work import without


def count_tokens(docs: DataFrame, vocabulary: str, *, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``docs`` without its text, with the number of tokens of that text.

    ``vocabulary`` is a file of the tokenizers library, present on every node. Null and empty texts have 0 tokens;
    special strings inside a text count as the library's default has it, one token each. Rows stand for themselves:
    repeated rows are counted alike, null keys stay null, a column named ``out`` is replaced.
    """
    docs = without(docs, out)

    def work(texts: list[bytes]) -> list[pa.Array]:
        values, sizes = by_text(texts, ASCII_SPACE, merged_counts(vocabulary))
        ends = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
        return [pa.array(np.diff(ends[np.concatenate(([0], np.cumsum(sizes)))]), pa.int64())]

    return docs.mapInArrow(
        lambda batches: map_texts(batches, text, work, [out]), schema_with(docs, text, f"`{out}` long")
    )


def over_budget(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """Bytes, tokens and whether a text has more than ``limit`` tokens, for each document."""
    sized = docs.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text"
    )
    return count_tokens(sized, vocabulary).withColumn("over_limit", F.col("n_tokens") > limit)
