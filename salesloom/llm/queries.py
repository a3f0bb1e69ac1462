"""The registered queries of the package: one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm import decontam, fim, hardneg, jaccard, langid, licence, packing, pst, quality, secrets, substring, topk, warc
from salesloom.llm.shipping import ship
from salesloom.llm.sql import SQL as SQL

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document when passages of 35 words that repeat are cut out."""
    found = substring.factored(spark, table(spark, sf_dir, "documents"), with_text=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token sequences of 1024 ids."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), with_ids=False)


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the rows that aren't held out."""
    return langid.identify(spark, table(spark, sf_dir, "documents"))


def op4_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document."""
    return licence.scan(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from the labelled rows that aren't held out."""
    return quality.score(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all pages as WARC archives and reads them back by their index."""
    return warc.pages_round_trip(spark, table(spark, sf_dir, "pages"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best candidates of every 50th vector among all vectors."""
    return topk.top_k(spark, table(spark, sf_dir, "embeddings"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document under a suffix tree of the training rows."""
    return pst.score(spark, table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document that holds a benchmark item, or a long part of one, with the item."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under links of 80 % common word 5-grams."""
    found = jaccard.Join(spark, table(spark, sf_dir, "documents")).per_document()
    return found.select("doc_id", "n_shingles", "component_id")


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in its fill-in-the-middle form, and rebuilt from it, by their digests."""
    found = fim.restored(fim.transform(table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: matches of the patterns, and runs whose format was inferred."""
    found = secrets.scan(spark, table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.KINDS))
    said = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secrets.KINDS],
        F.sha2(said(base), 256).alias("base_sha256"),
        said("spans").alias("spans"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to 3 hard negatives for each of up to 5 positives of every 50th vector; some labels are moved."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(spark, table(spark, sf_dir, "embeddings").withColumn("label", moved))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_substring_dedup,
        op2_packing,
        op3_langid,
        op4_license,
        op5_quality,
        op6_warc,
        op7_topk,
        op8_lm_score,
        op9_decontamination,
        op10_jaccard_join,
        op11_fim,
        op12_secrets,
        op13_hard_negatives,
    )
}
