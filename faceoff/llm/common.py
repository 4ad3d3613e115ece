"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters between words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD_SEPARATORS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(df: DataFrame, column: str = "text"):
    """The text column as a string; null counts as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def scratch_dir(spark: SparkSession, what: str) -> str:
    """A new folder name below the cluster's shared folder (``spark.checkpoint.dir``)."""
    from faceoff.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{what}-{uuid.uuid4().hex}"


#: Shuffle files of a query go as soon as it has ended.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders that ``written`` made inside the open scopes, innermost last.
_SCOPES: list[list[tuple[SparkSession, str]]] = []


def written(spark: SparkSession, df: DataFrame, what: str) -> DataFrame:
    """``df`` written to the shared folder and read back: the lineage ends here, and a
    lost executor costs a read of the files, not a new computation. What was shuffled for
    it is given up at once; the table itself stays until ``discard`` or the end of a ``scope``."""
    path = scratch_dir(spark, what)
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    if _SCOPES:
        _SCOPES[-1].append((spark, path))
    return out


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` whose last reader is done (all that read them has been written itself)."""
    for t in tables:
        path = t.__dict__.pop("_scratch", None)
        if path:
            _delete(t.sparkSession, path)


@contextmanager
def scope():
    """Deletes at its end what ``written`` made inside and has not been discarded: whoever uses an
    operator's result inside leaves nothing in the shared folder. Yields a function that takes a
    table out of the scope and returns it."""
    made: list[tuple[SparkSession, str]] = []

    def keep(table: DataFrame) -> DataFrame:
        at = next(k for k, m in enumerate(_SCOPES) if m is made)
        made[:] = [x for x in made if x[1] != table._scratch]
        if at:
            _SCOPES[at - 1].append((table.sparkSession, table._scratch))
        return table

    _SCOPES.append(made)
    try:
        yield keep
    finally:
        del _SCOPES[next(k for k, m in enumerate(_SCOPES) if m is made)]
        for spark, path in made:
            _delete(spark, path)


def doc_key(docs: DataFrame, text: str = "text") -> dict[str, Column]:
    """Columns that name a document by its id and a hash of its text and are never null, so that a
    join on them, and grouping by them after it, need one shuffle."""
    id_ = F.col("doc_id").cast("long")
    return {"_id": F.coalesce(id_, F.lit(0).cast("long")), "_no_id": id_.isNull(), "_mark": F.xxhash64(text_of(docs, text))}


def small_arrow_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound what one Arrow batch of documents can hold, unless the session already has a lower bound."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that an operator is about to add (names compare as Spark compares them)."""
    lower = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in lower])


def settled(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with the named columns computed once: the optimizer moves a later filter on
    them no further down than here, instead of computing them anew inside the filter."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in names]
    one = df.select(*rest, F.explode(F.array(F.struct(*[F.col(f"`{n}`") for n in names]))).alias("_settled"))
    return one.select(*rest, *[F.col(f"_settled.`{n}`").alias(n) for n in names])
