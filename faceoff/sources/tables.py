"""Readers for contest, play and request tables.

``read_contests`` / ``read_plays`` read real files (CSV with a header and ``NA`` null
tokens, or Parquet) into the fixed schemas, by column names. ``testdata_contests`` / ``testdata_plays`` build
stand-in tables of the same schemas from the provided TPC-H-style parquet files;
they only reshape rows and do none of the analytics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faceoff import schemas
from faceoff.functions.joins import by_key


def _conformed(df: DataFrame, schema, optional: set[str], aliases: dict[str, str] | None = None) -> DataFrame:
    """The columns of ``schema``, found by name (aliases apply where the own name is absent).

    Absent optional columns are NULL (extras runs of plays: 0); an absent required column
    is an error; values that don't fit the type are NULL; other columns are left out.
    """
    there = {c.strip().lower(): c for c in df.columns}
    other = {new: old for old, new in (aliases or {}).items()}
    found = {f.name: there.get(f.name) or there.get(other.get(f.name, "")) for f in schema.fields}
    missing = [n for n, c in found.items() if c is None and n not in optional]
    if missing:
        raise ValueError(f"required columns are missing: {', '.join(missing)}; found: {', '.join(df.columns)}")
    out = []
    for f in schema.fields:
        if found[f.name] is None:
            value = F.lit(0 if f.name in ("wide_runs", "noball_runs") else None).cast(f.dataType)
        else:
            value = F.col(f"`{found[f.name]}`")
            if f.dataType.simpleString() in ("int", "bigint"):  # also takes "4.0"
                value = F.coalesce(value.try_cast(f.dataType), value.try_cast("double").try_cast(f.dataType))
            else:
                value = value.try_cast(f.dataType)
        out.append(value.alias(f.name))
    return df.select(out)


def _read(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    if fmt == "csv":
        # without a schema Spark takes the header's names; all values are strings
        return normalise_na_strings(spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path))
    return spark.read.parquet(path)


def normalise_na_strings(df: DataFrame, tokens=("", "NA", "N/A", "NaN", "nan", "null", "NULL", "None")) -> DataFrame:
    """Trim string columns and turn the usual missing-value tokens into NULL."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.simpleString() == "string":
            cols.append(F.when(F.trim(f"`{f.name}`").isin(list(tokens)), F.lit(None)).otherwise(F.trim(f"`{f.name}`")).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(cols)


def read_contests(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Contest scan by column names. A missing ``season`` is the year of the date."""
    df = _conformed(_read(spark, path, fmt), schemas.CONTEST, schemas.CONTEST_OPTIONAL)
    return df.withColumn("season", F.coalesce("season", F.year("date").cast("string")))


def read_plays(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Play scan by column names; old names are mapped to the canonical ones."""
    return _conformed(_read(spark, path, fmt), schemas.PLAY, schemas.PLAY_OPTIONAL, schemas.PLAY_ALIASES)


def read_requests(spark: SparkSession, path: str, multiline: bool = False, schema=None) -> DataFrame:
    """JSON request batch.

    Default: one JSON value per line, where a line holding an array yields one
    row per element (the writer's format, and JSON lines). ``multiline=True``
    reads each file as one document, e.g. a pretty-printed array.
    """
    return spark.read.schema(schema or schemas.REQUEST).option("multiLine", multiline).json(path)


# ---------------------------------------------------------------------------
# Stand-in tables from the provided parquet files
# ---------------------------------------------------------------------------

def _tbl(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def testdata_contests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contests from orders ⋈ customer ⋈ nation (twice): one order = one contest.

    ``nation`` has a fixed 25 rows, so broadcasting it is bounded; customers
    grow with the input and meet orders by key.
    """
    o = _tbl(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    c = _tbl(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = _tbl(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    n1 = F.broadcast(n.withColumnsRenamed({"n_nationkey": "k1", "n_name": "team1"}))
    n2 = F.broadcast(n.withColumnsRenamed({"n_nationkey": "k2", "n_name": "team2"}))
    k = F.col("o_orderkey")
    st = F.col("o_orderstatus")
    base = (o.join(by_key(c), o.o_custkey == c.c_custkey)
            .withColumn("_k2", (F.col("c_nationkey") + 1 + k % 24) % 25)
            .join(n1, F.col("c_nationkey") == F.col("k1"))
            .join(n2, F.col("_k2") == F.col("k2")))
    return base.select(
        k.alias("id"),
        F.year(F.col("o_orderdate").cast("date")).alias("season"),
        F.col("o_orderdate").cast("date").alias("date"),
        "team1", "team2",
        F.col("c_mktsegment").alias("venue"),
        F.when(k % 2 == 0, F.col("team1")).otherwise(F.col("team2")).alias("toss_winner"),
        F.when(k % 3 == 0, F.lit("bat")).otherwise(F.lit("field")).alias("toss_decision"),
        F.when(st == "F", F.col("team1")).when(st == "O", F.col("team2")).alias("winner"),
        F.when((st == "P") & (k % 5 == 0), F.lit("no result"))
         .when((st == "P") & (k % 5 == 1), F.lit(None))
         .when(st == "P", F.lit("tie"))
         .when(k % 7 < 3, F.lit("wickets")).otherwise(F.lit("runs")).alias("result"),
        F.when(st == "P", F.lit(None).cast("double")).otherwise((k % 90 + 1).cast("double")).alias("result_margin"),
    )


def testdata_plays(spark: SparkSession, sf_dir: str, contests: DataFrame | None = None) -> DataFrame:
    """Plays from lineitem ⋈ contests: one line item = one play."""
    li = _tbl(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    ct = (contests if contests is not None else testdata_contests(spark, sf_dir)).select("id", "team1", "team2")
    ln = F.col("l_linenumber")
    q = F.col("l_quantity").cast("int") % 7
    rf = F.col("l_returnflag")
    even = ln % 2 == 0
    return li.join(by_key(ct), li.l_orderkey == ct.id).select(
        F.col("l_orderkey").alias("match_id"),
        F.when(ln == 7, F.lit(3)).otherwise(1 + ln % 2).cast("int").alias("inning"),
        ln.cast("int").alias("ball"),
        (F.col("l_partkey") % 400).cast("long").alias("batter"),
        F.when((ln == 6) & (rf == "N"), F.lit(None).cast("long")).otherwise(F.col("l_suppkey")).alias("bowler"),
        F.when(even, F.col("team1")).otherwise(F.col("team2")).alias("batting_team"),
        F.when(even, F.col("team2")).otherwise(F.col("team1")).alias("bowling_team"),
        q.cast("int").alias("batsman_runs"),
        (q + F.when(rf == "R", 1).otherwise(0)).cast("int").alias("total_runs"),
        F.when(rf == "A", 1).otherwise(0).cast("int").alias("is_wicket"),
        F.when(rf == "A", F.col("l_partkey") % 400).cast("long").alias("player_dismissed"),
        F.when((rf == "R") & (F.col("l_linestatus") == "F"), 1).otherwise(0).cast("int").alias("wide_runs"),
        F.when((rf == "R") & (F.col("l_linestatus") == "O"), 1).otherwise(0).cast("int").alias("noball_runs"),
    )


def testdata_requests(spark: SparkSession, sf_dir: str, form: DataFrame) -> DataFrame:
    """Request-shaped rows (S7 schema) from the form-feature table of the test data."""
    cols = [F.col(c).cast("string").alias(c) for c in schemas.REQUEST_STRINGS]
    cols += [F.col(c).cast("double").alias(c) for c in schemas.REQUEST_DOUBLES]
    return form.select(F.col("id"), *cols)


# One written copy of the stand-in tables per (session, sf_dir): queries then scan
# parquet like they would scan the real contest/play tables.
_STANDIN: dict[tuple[str, str], tuple[str, str]] = {}


def standin_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(contests, plays) stand-ins, written once under the shared checkpoint folder."""
    import uuid

    from faceoff.session import ensure_checkpoint_dir
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STANDIN:
        base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/faceoff-standin-{uuid.uuid4().hex[:12]}"
        c = testdata_contests(spark, sf_dir)
        c.write.mode("overwrite").parquet(f"{base}/contests")
        cw = spark.read.parquet(f"{base}/contests")
        testdata_plays(spark, sf_dir, cw).write.mode("overwrite").parquet(f"{base}/plays")
        _STANDIN[key] = (f"{base}/contests", f"{base}/plays")
    cp, pp = _STANDIN[key]
    return spark.read.parquet(cp), spark.read.parquet(pp)
