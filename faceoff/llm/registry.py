"""The registered queries of this subpackage: each applies one operator, with production
parameters, to its whole table and derives digest columns from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faceoff.llm import audit, bpe, chat, fingerprint, langid, merkle, mixing, neardup, passages, quality, tokencount, toxicity, warc
from faceoff.llm.common import table


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted and read back from the output."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit("\\### Assistant: </turn> ok").alias("text"))
    out = chat.read_back(chat.format_chats(chat.events_of_turns(turns.unionByName(marks))))
    said = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit("\n"), m["text"], F.lit("\n"))), "")
    learned = F.array_join("loss_texts", "")
    return out.select("conv_id", F.size("messages").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                      F.length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))


def op2_minhash(spark: SparkSession, sf_dir: str, size: int = 4) -> DataFrame:
    """Components of near-duplicate documents: sets of 4-word shingles that are 80 % alike."""
    out = neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), size)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def op3_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Byte-pair ids of every document and the text they decode to, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.encode_decode(docs, path or vocabulary("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of an edited form of it, and their likeness."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = fingerprint.fingerprint(docs, "text", "print")
    d = fingerprint.with_next(d, "text", "print")
    d = d.withColumn("edited", fingerprint.edited(F.col("text"), F.col("next_text"))).drop("next_text")
    d = d.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                 "print", "next_print", "edited")
    d = fingerprint.fingerprint(d, "edited", "edited_print")
    a, b, c = F.col("print"), F.col("edited_print"), F.col("next_print")
    return d.select("doc_id", "n_chars", "edited_sha256", fingerprint.as_string(a).alias("fingerprint"),
                    fingerprint.as_string(b).alias("edited_fingerprint"),
                    fingerprint.likeness(a, b).alias("near_edited"), fingerprint.likeness(a, c).alias("near_next"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document and the verdict of weak supervision."""
    out = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), lean=True)
    return out.select("doc_id", *quality.BASE, "quality", "kept")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeated strings of 400 bytes cover, and what is left."""
    out = passages.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the confirmed labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score(docs, model).select("doc_id", "held_out", "score", "predicted")


def op8_token_counts(spark: SparkSession, sf_dir: str, path: str | None = None, limit: int = 1024) -> DataFrame:
    """Exact token count of every document by the prefix table, and whether it is over the limit."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = tokencount.count_tokens(docs, path or vocabulary("byte_bpe_50k.json"), limit)
    return out.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op9_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every revisit of every page, resolved to the latest earlier full response of its URL."""
    out = warc.resolve(warc.standin_records(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    lines = F.array_join(F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"])), "\n")
    return out.select("record_id", "canonical", "time", "resolution", "refers_to", F.size("headers").cast("long").alias("n_headers"),
                      F.sha2(lines, 256).alias("headers_sha256"), F.sha2("body", 256).alias("body_sha256"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix of all sources takes."""
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and path of every document, and what a tampered document's path leads to."""
    docs = table(spark, sf_dir, "documents")
    row = lambda text: merkle.leaf_of(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text)
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampers = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    leaves = docs.select("doc_id", "lang", row(F.col("text")).alias("leaf"), F.when(tampers, row(lowered)).alias("tampered"))
    out = merkle.manifest(leaves, "lang", "doc_id")
    out = out.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the labelled ones that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    out = langid.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes from every source, at every step of every order."""
    docs = table(spark, sf_dir, "documents")
    return audit.audit(audit.failures(docs, table(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_minhash": op2_minhash,
    "op3_bpe": op3_bpe,
    "op4_fingerprints": op4_fingerprints,
    "op5_quality_rules": op5_quality_rules,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_token_counts": op8_token_counts,
    "op9_revisits": op9_revisits,
    "op10_mixing": op10_mixing,
    "op11_merkle": op11_merkle,
    "op12_langid": op12_langid,
    "op13_filter_audit": op13_filter_audit,
}
