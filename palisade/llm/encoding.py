"""Encoding of texts with a public byte-level BPE tokenizer, and decoding back.

The tokenizers library runs over Arrow batches. Byte-level vocabularies spell every byte as
a printable character; the byte table maps between them, gives each token its place in the
text, and reverses ids to bytes. A token may hold part of a character only: its offsets then
cover that character, and decoding joins bytes before it reads them as UTF-8.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_FILE = "byte_bpe_50k.json"


def vocabulary_path(spark: SparkSession, name: str = DEFAULT_FILE) -> str:
    """``palisade.tokenizer.dir`` of the session, else the folder of the installed vocabularies."""
    folder = spark.conf.get("palisade.tokenizer.dir", None)
    if not folder:
        import public_tokenizers

        return public_tokenizers.path(name)
    return os.path.join(folder, name)


@lru_cache(maxsize=1)
def byte_table() -> dict[str, int]:
    """Character → byte: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in set(plain)):
        table[chr(256 + n)] = b
    return table


@lru_cache(maxsize=4)
def _tokenizer(spec: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's one core is enough; forks stay safe
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(spec)
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    t.no_padding()
    t.no_truncation()
    return t


def token_bytes(spec: str) -> list[bytes]:
    """The bytes of each id; ids of special tokens give their text."""
    table, vocabulary = byte_table(), _tokenizer(spec).get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()
    return out


def _spec(spark: SparkSession, path: str | None) -> str:
    with open(path or vocabulary_path(spark), encoding="utf-8") as f:
        return f.read()


def encode(df: DataFrame, text: str = "text", path: str | None = None, ids: str = "ids", offsets: str | None = None) -> DataFrame:
    """Adds ``ids``, a list of integers without special tokens; null and empty texts give [].

    ``offsets`` names a further column, a list of (start, end) code-point offsets a token; the
    parts of a character split over tokens all have that character's offsets. Texts may be of
    any length and are encoded whole. Existing columns stay, whatever their names.
    """
    spec = df.sparkSession.sparkContext.broadcast(_spec(df.sparkSession, path))  # a vocabulary file, 1.5 MB
    rows = df.select(F.struct("*").alias("_row"), F.col(text).alias("_text"))
    with_offsets = offsets is not None
    kinds = [pa.field("ids", pa.list_(pa.int32()))] + ([pa.field("at", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))] if with_offsets else [])

    schema = T.StructType([rows.schema["_row"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if with_offsets:
        schema = schema.add("at", T.ArrayType(T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizer(spec.value)
        for batch in batches:
            texts = [x or "" for x in batch.column("_text").to_pylist()]
            found = t.encode_batch(texts, add_special_tokens=False) if with_offsets else t.encode_batch_fast(texts, add_special_tokens=False)
            columns = [pa.array([e.ids for e in found], kinds[0].type)]
            if with_offsets:
                columns.append(pa.array([[{"start": a, "end": b} for a, b in e.offsets] for e in found], kinds[1].type))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), *columns], names=["_row", *(f.name for f in kinds)])

    out = rows.mapInArrow(run, schema)
    kept = [F.col(f"_row.`{c}`") for c in df.columns if c not in (ids, offsets)]
    return out.select(*kept, F.col("ids").alias(ids), *([F.col("at").alias(offsets)] if with_offsets else []))


def decode(df: DataFrame, ids: str = "ids", path: str | None = None, text: str = "text") -> DataFrame:
    """Adds ``text`` decoded from ``ids``; null ids give null, unknown ids nothing.

    Bytes of all tokens are joined before they are read as UTF-8, so characters split over
    tokens come back whole; bytes that are no UTF-8 (a list cut within a character) give U+FFFD.
    """
    spec = df.sparkSession.sparkContext.broadcast(_spec(df.sparkSession, path))

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = token_bytes(spec.value)
        n = len(table)
        for s in batches:
            yield pd.Series([None if x is None else b"".join(table[i] for i in x if 0 <= i < n).decode("utf-8", "replace") for x in s])

    return df.withColumn(text, run(F.col(ids)))
