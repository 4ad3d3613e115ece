"""Byte-pair encoding and decoding of whole texts with a public vocabulary.

Method: contiguous rank arrays. A word is held as the ids of its parts and the merge rank
of every pair of neighbours. The least rank is looked for again and again; its boundary
is deleted and the ranks beside it are refreshed. Words are short, so scanning a few
cells beats a heap; words of over ``vocab.LONG_WORD`` bytes take a heap, with the same
result. The arrays of all distinct words of an Arrow batch are the rows of two matrices,
so that one round works on all of them.

Spark deals out the rows; each task encodes its own texts. Nothing is shuffled. The
vocabulary (one file of a few MB, whatever the data) is broadcast.

Cases: null text counts as empty; empty text has no ids and decodes to empty text;
null ids decode to empty text; ids outside the vocabulary are skipped by the decoder;
repeated rows give repeated results; an empty table gives an empty table; columns of
the input that are named like a result column are replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faceoff.llm.common import small_arrow_batches, text_of, without
from faceoff.llm.vocab import Vocabulary, broadcast_vocabulary, distinct, in_worker, spread

LOWER = "a-zß-öø-ſ"
SIGN = r"[^\s" + LOWER + "0-9]"


class WordCoder:
    """Encoder and decoder of a vocabulary with ends of words (lower case, white space dropped)."""

    #: Fixed value: how the vocabulary's file cuts text into words (here for usual characters).
    WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LOWER}]+|[0-9]|{SIGN}+")

    def __init__(self, spec: str):
        self.vocab = v = Vocabulary(spec)
        names = [" " + s for s in v.names]
        raw = [s.encode("utf-8") if v.names[i] else b"" for i, s in enumerate(names)]
        self.name_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.name_size = np.array([len(r) for r in raw], np.int64)
        self.name_start = np.cumsum(self.name_size) - self.name_size

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts as unsigned 32-bit integers, low byte first."""
        out = [b""] * len(texts)
        for words, docs, counts in self.vocab.batches(texts, self.WORDS, lower=True):
            if not words:
                continue
            known, code = distinct(words)
            ids, starts = self.vocab.merge(known)
            size = np.diff(starts)[code]
            flat = ids[spread(starts[code], size)].astype("<u4").tobytes()
            ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum(counts)] * 4
            for d, a, b in zip(docs.tolist(), [0, *ends.tolist()], ends.tolist()):
                out[d] += flat[a:b]
        return out

    def decode(self, packed: list[bytes | None]) -> list[str]:
        """The tokens of packed ids with a space between two: the vocabulary's file has no other decoder."""
        out = []
        for p in packed:
            ids = np.frombuffer(p or b"", "<u4", len(p or b"") // 4)
            ids = ids[ids < self.vocab.size]
            size = self.name_size[ids]
            out.append(self.name_bytes[spread(self.name_start[ids], size)].tobytes()[1:].decode("utf-8"))
        return out


def encoder(spark: SparkSession, vocabulary: str):
    """Column function text -> packed ids (binary)."""
    spec = broadcast_vocabulary(spark, vocabulary)
    small_arrow_batches(spark)

    @F.arrow_udf("binary")
    def bpe_ids(text: pa.Array) -> pa.Array:
        return pa.array(in_worker(WordCoder, spec).encode(text.to_pylist()), pa.binary())

    return bpe_ids


def decoder(spark: SparkSession, vocabulary: str):
    """Column function packed ids (binary) -> text."""
    spec = broadcast_vocabulary(spark, vocabulary)
    small_arrow_batches(spark)

    @F.arrow_udf("string")
    def bpe_text(ids: pa.Array) -> pa.Array:
        return pa.array(in_worker(WordCoder, spec).decode(ids.to_pylist()), pa.string())

    return bpe_text


def n_ids(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def encode(df: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` (binary, packed) and ``n_tokens`` (long)."""
    enc = encoder(df.sparkSession, vocabulary)
    out = without(df, "ids", "n_tokens").withColumn("ids", enc(text_of(df, text)))
    return out.withColumn("n_tokens", n_ids(F.col("ids")))


def decode(df: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded`` (string), the text of the packed ids."""
    dec = decoder(df.sparkSession, vocabulary)
    return without(df, "decoded").withColumn("decoded", dec(df[ids]))


def encode_decode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``docs`` with ``ids``, ``n_tokens`` and ``decoded``."""
    return decode(encode(docs, vocabulary), vocabulary)
