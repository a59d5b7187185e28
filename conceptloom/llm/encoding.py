"""Problem 7: the whole corpus as token ids of a public tokenizer."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import spread
from .bytebpe import DEFAULT_VOCABULARY, Encoder


def encode_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """One row per input row: the id and ``ids`` array<int>, without special tokens.

    Null and empty texts get the empty list. Repeated rows come out as often as they came in; other columns
    are not read. No shuffle: texts are encoded where they are read, one Arrow batch at a time.
    """
    source = spread(docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")))
    schema = T.StructType([source.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def encode(batches):
        encoder = Encoder(path)
        for batch in batches:
            ids, sizes = encoder.encode([t or "" for t in batch.column(1).to_pylist()])
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[id_col, "ids"])

    return source.mapInArrow(encode, schema)


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """One row per input row: the id and ``n_tokens`` (0 for null and empty texts)."""
    source = spread(docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")))
    schema = T.StructType([source.schema[id_col], T.StructField("n_tokens", T.LongType(), False)])

    def count(batches):
        encoder = Encoder(path)
        for batch in batches:
            sizes = encoder.count([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=[id_col, "n_tokens"])

    return source.mapInArrow(count, schema)


def decode_corpus(encoded: DataFrame, id_col: str = "doc_id", path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """The inverse of ``encode_corpus``: the id, ``text`` and ``byte_offsets`` of each token in the text's UTF-8 form.

    A null list of ids gives a null text and null offsets.
    """
    source = encoded.select(id_col, "ids")
    schema = T.StructType([source.schema[id_col], T.StructField("text", T.StringType()), T.StructField("byte_offsets", T.ArrayType(T.IntegerType()))])

    def decode(batches):
        encoder = Encoder(path)
        for batch in batches:
            rows = batch.column(1).to_pylist()
            texts = [None if r is None else encoder.decode(r) for r in rows]
            at = [None if r is None else encoder.byte_offsets(r) for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(at, pa.list_(pa.int32()))], names=[id_col, "text", "byte_offsets"])

    return source.mapInArrow(decode, schema)
