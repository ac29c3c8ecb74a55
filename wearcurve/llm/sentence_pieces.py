"""SentencePiece ids of whole texts and back.

Encoding runs merge rounds over flat symbol arrays of all distinct words of a batch (``merging``); decoding is the
library's. Nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearcurve.llm.piece_bpe import load, pieces
from wearcurve.llm.units import list_array, map_texts, schema_with, trimmed
from wearcurve.llm.work import without


def encode(docs: DataFrame, model: str, *, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` without its text, with the ids of that text and, if ``decoded`` names it, the text they decode to.

    ``model`` is a SentencePiece file, present on every node. No begin or end ids, no sampling. Null and empty texts
    have no ids and decode to the empty text. Rows stand for themselves; columns named as the outputs are replaced.
    """
    names = [ids] + ([decoded] if decoded else [])
    docs = without(docs, *names)

    def work(texts: list[bytes]) -> list[pa.Array]:
        values, sizes = pieces(model)(texts)
        out = [list_array(values, sizes)]
        if decoded:
            ends = np.cumsum(sizes)
            spans, library = zip((ends - sizes).tolist(), ends.tolist()), load(model).library
            out.append(pa.array((library.decode(values[a:b].tolist()) if b > a else "" for a, b in spans), pa.string()))
        return out

    added = f"`{ids}` array<int>" + (f", `{decoded}` string" if decoded else "")
    return docs.mapInArrow(
        lambda batches: trimmed(map_texts(batches, text, work, names)), schema_with(docs, text, added)
    )


def decode(docs: DataFrame, model: str, *, ids: str = "ids", text: str = "text") -> DataFrame:
    """``docs`` with the text its ids decode to; null ids decode to the empty text."""
    docs = without(docs, text)

    def run(batches):
        library = load(model).library
        for batch in batches:
            lists = batch.column(batch.schema.names.index(ids)).to_pylist()
            got = pa.array([library.decode(x) if x else "" for x in lists], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, got], names=[*batch.schema.names, text])

    return docs.mapInArrow(run, schema_with(docs, "", f"`{text}` string"))


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """Number and digest of each document's ids, and digest of the text they decode to."""
    coded = encode(docs.select("doc_id", "text"), model, decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
