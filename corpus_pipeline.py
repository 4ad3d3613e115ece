"""The corpus pipeline: quality rules, near-duplicate removal, removal of repeated
passages, mixing of the sources to target weights, and byte-pair encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; each works on all rows that
its predecessor kept. All but the last return the columns of ``documents``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faceoff.llm import bpe, mixing, neardup, passages, quality
from faceoff.llm.common import discard, scope, written
from faceoff.llm.registry import vocabulary

#: Words in a shingle of the near-duplicate stage.
SHINGLE = 5
#: Passages of over 50 words that repeat are cut out.
PASSAGE_WORDS = 51


def _packed(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns and ``row``, the whole row: no column that an operator adds can clash with one of the table."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the votes reject go.

    Null and blank texts go; repeated rows are judged alike."""
    return quality.judge(_packed(docs, "text")).where("kept").select("row.*")


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays, the one of the smallest id.

    Of repeated rows one stays (the lowest hash of the row); documents without words all stay; a null id comes last."""
    return neardup.keep_one(docs, SHINGLE)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that start more than once, of over 50 words or of 400 bytes, are cut out of the
    texts; all documents stay, ``n_chars`` follows the text.

    A null text becomes an empty one; repeated rows repeat each other and lose what they share."""
    out = passages.remove_repeats(_packed(docs, "doc_id", "text"), words=PASSAGE_WORDS)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return out.select(*[new.get(c.lower(), F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them.

    A null source is one of its own and a null text has no words; repeated rows are taken one by one."""
    return mixing.mixed(docs)


def bpe_coding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ids (packed), n_tokens and the text that the ids decode to."""
    return bpe.encode_decode(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", minhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("mixing sources to target weights", source_mixing),
    ("BPE encoding and decoding", bpe_coding),
]
#: Learnt rules, components, balanced samples and merges are not expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again, and what it left
    in the shared folder is deleted. An empty table passes all stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        with scope() as keep:
            done = keep(written(spark, stage(spark, docs, sf_dir), f"stage-{number}"))
        discard(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
