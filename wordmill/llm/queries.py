"""One thin query for each operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, gif, kneser_ney, langid, licenses, minhash, mixing, outliers, packing, periodic, pii, repair, warc
from .shared import Workspace, documents


def _spans_text(spans: str):
    """kind:start:end joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.with_spans(documents(spark, sf_dir).select("doc_id", "text")).withColumn("fixed", F.filter("pii_spans", lambda s: s["base"]))
    counts = [F.expr(f"cast(size(filter(fixed, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(_spans_text("fixed"), 256).alias("base_sha256"), _spans_text("pii_spans").alias("spans"))


def op2_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = Workspace(spark, "gif").keep(gif.store_texts(documents(spark, sf_dir)), "stored")
    return gif.digests(stored)


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), shingle=3, percent=85)


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", F.array_join("license_sentences", ",").alias("license_sentences"), F.array_join("licenses", ",").alias("licenses"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang").withColumn("held_out", langid.crc_remainder("doc_id", 5) == 0)
    profiles = langid.learn_profiles(docs.where("not held_out"))
    return langid.identify(docs.select("doc_id", "held_out", "text"), profiles).select("doc_id", "held_out", "lang_pred", "score")


def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text").withColumn("held_out", langid.crc_remainder("doc_id", 7) == 2)
    model = kneser_ney.train(docs.where("not held_out"), Workspace(spark, "kneser-ney"), order=3)
    return kneser_ney.score(docs, model).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.schedule(documents(spark, sf_dir))
    return out.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", *[F.round(c, 6).alias(c) for c in ("first_position", "last_position")])


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    files = warc.write_archives(pages, Workspace(spark, "warc"))
    kind = pages.schema["page_id"].dataType
    return (
        warc.read_chunks(files, with_data=False, own=True)
        .where("is_last")
        .select(F.col("record_id").cast(kind).alias("page_id"), F.col("payload_end").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
    )


def op10_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = outliers.mcd_outliers(documents(spark, sf_dir))
    return out.select("doc_id", *outliers.COUNTS, "base_failed", "kept", F.round("distance2", 6).alias("distance2"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    shards = repair.write_shards(docs, Workspace(spark, "repair"))
    return repair.read_documents(shards, docs.schema["doc_id"].dataType.simpleString())


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(documents(spark, sf_dir), rewrite=True)


QUERIES = {"op1_pii": op1_pii, "op2_gif": op2_gif, "op4_licenses": op4_licenses, "op5_langid": op5_langid, "op6_kneser_ney": op6_kneser_ney, "op7_mixing": op7_mixing, "op8_packing": op8_packing, "op9_warc": op9_warc, "op3_minhash": op3_minhash, "op10_outliers": op10_outliers, "op11_repair": op11_repair, "op12_collocations": op12_collocations, "op13_periodic": op13_periodic}

ORACLE_SQL: dict[str, str] = {"op3_minhash": minhash.SQL, "op4_licenses": licenses.sql(), "op7_mixing": mixing.SQL, "op9_warc": warc.SQL, "op12_collocations": collocations.SQL}
