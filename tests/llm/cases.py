"""Small tables with the awkward cases every operator has to stand."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, schema=SCHEMA):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, schema)


def written(df, path):
    """A folder with ``df`` as its table ``documents``, as queries read it."""
    df.write.mode("overwrite").parquet(f"{path}/documents.parquet")
    return str(path)


ODD_TEXTS = [None, "", " ", "\n\t \r", "a", "Hello, World! it's", "<|endoftext|> x <|startoftext|><|endoftext|>",
             "Éá ΣΑΣ İ ﬁ ½² 中文 \U0001f600‍\U0001f525",
             "x" * 5000, "ab " * 3000, "\x1c\x85 a", "  two  spaces \n\n and   more ", "you'RE 'll 've"]
