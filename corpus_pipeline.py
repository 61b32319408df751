"""Corpus pipeline: stages over ``documents``, each applying one operator of ``pressloom.llm``.

Every stage works on all that the one before kept. All but the last return the columns
of ``documents``. Null ids: such rows are judged by the quality rules, never dropped as
near copies, and kept once by the mixing. Repeated ids: each row is judged by its own text. An
empty table passes all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm import bpe_codec, jaccard_join, mixing, quality_rules, suffix_dedup
from pressloom.llm.common import maybe_among, stage, table

#: shares of the mixture's tokens, at most: the clean domain gets the tokens it has, the others KEEP times theirs if that is less
SHARES = {"clean": 0.993, "toxic": 0.002, "low": 0.005}
KEEP = 0.1


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject; cutoffs come from ``labels``."""
    packed = docs.select(F.struct("*").alias("_row"), "doc_id", "lang", "text")
    counted = stage(quality_rules.measures(packed, keep=("_row", "doc_id", "lang")), "quality-measures")
    cutoffs = quality_rules.choose_cutoffs(counted.drop("_row"), table(spark, sf_dir, "labels"))
    return quality_rules.judge(counted, cutoffs).where("kept").select("_row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of linked ones: that of the smallest id, of several texts of this id the one of the least hash.

    Rows are judged by their own texts, also where ids repeat: no text goes unless one of its group stays. Of equal rows
    one stays (if only other columns differ, the least). Rows with null ids or without words all stay.
    """
    groups = jaccard_join.jaccard_groups(docs.select("doc_id", "text")).where("doc_id is not null and group is not null")
    row = F.struct("doc_id", "ref")
    first = groups.groupBy("group").agg(F.min(row).alias("first"))
    rows = groups.groupBy("group", "doc_id", "ref").agg(F.count(F.lit(1)).alias("times")).join(first, "group")
    judged = stage(rows.select("doc_id", "ref", (F.col("first") == row).alias("stays"), "times").where("not stays or times > 1"), "copies-judged", narrow=True)
    named = maybe_among(docs.withColumn("_ref", F.xxhash64(F.coalesce("text", F.lit("")))), F.col("_ref"), judged.select("ref"))
    single = named.where("not _maybe").select(docs.columns)  # their texts don't move
    named = named.where("_maybe").drop("_maybe")
    of = lambda rows: rows.select(F.col("doc_id").alias("_id"), F.col("ref").alias("_r"))
    same = (F.col("doc_id") == F.col("_id")) & (F.col("_ref") == F.col("_r"))
    kept = named.join(of(judged.where("not stays")), same, "left_anti")
    again = of(judged.where("stays"))  # rows that are there several times
    if again.limit(1).count() == 0:
        return single.unionByName(kept.drop("_ref"))
    once = kept.join(again, same, "left_semi").groupBy("doc_id", "_ref").agg(F.min(F.struct(*docs.columns)).alias("_row")).select("_row.*")
    return single.unionByName(kept.join(again, same, "left_anti").drop("_ref")).unionByName(once)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated strings out of the texts; characters that a cut went through go as well."""
    others = F.struct(*(c for c in docs.columns if c != "text"))  # the text itself travels once
    cut = suffix_dedup.remove_repeats(docs.select(others.alias("_row"), "text"))
    valid = F.make_valid_utf8(F.col("kept").cast("string"))
    whole = F.when(F.contains("text", F.lit("�")), valid).otherwise(F.regexp_replace(valid, "�", ""))
    changed = F.when(F.col("n_removed") > 0, whole).otherwise(F.col("text"))
    return cut.withColumn("_text", changed).select(
        *(F.col("_text").alias("text") if c == "text"
          else F.when(F.col("n_removed") > 0, F.length("_text").cast("bigint")).otherwise(F.col("_row.n_chars")).alias(c) if c == "n_chars"
          else F.col(f"_row.{c}").alias(c) for c in docs.columns))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Thins out the documents of unwanted domains by the rates that meet their targets; none is taken twice."""
    rates = mixing.mix_rates(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), SHARES, anchor="clean", keep=KEEP)
    return mixing.sample_by_rate(docs, rates)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text and the digest of the bytes they decode to.

    The ids are staged before they are decoded: in one plan each task would hold two Python workers, and workers stay for the stages after.
    """
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = stage(bpe_codec.encode(docs.select("doc_id", "lang", "source", "text"), path, pattern).drop("text"), "tokens-encoded")
    return bpe_codec.decode(encoded, path, pattern).select(
        "doc_id", "lang", "source", F.size("token_ids").cast("bigint").alias("n_tokens"), "token_ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("near_copies", near_copies), ("repeated_strings", repeated_strings), ("mix", mix), ("tokens", tokens)]

#: byte-level BPE and column-wise suffix sorting have no SQL form; tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
