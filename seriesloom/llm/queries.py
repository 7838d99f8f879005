"""The operators' queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import (
    bpe,
    chat,
    divergence,
    embedding_dedup,
    line_dedup,
    merkle,
    mixing,
    quality,
    simhash_dedup,
    substring_dedup,
    token_output,
    toxicity,
    warc,
)
from seriesloom.llm.common import new_path, written
from seriesloom.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha256(column: str):
    return F.sha2(F.col(column).cast("binary"), 256)


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.groups(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_decode(docs, path, keep=["doc_id"])
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        _sha256("decoded").alias("decoded_sha256"),
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.deduplicate(docs).select("doc_id", "n_lines", "n_removed", _sha256("text").alias("kept_sha256"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write(_table(spark, sf_dir, "pages"), path)
    records = warc.read(spark, path)
    response = F.col("record_type") == "response"
    return records.select(
        F.col("record_id").alias("page_id"),
        F.when(response, F.octet_length("payload")).otherwise(F.col("payload_length")).cast("long").alias("payload_bytes"),
        F.when(response, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    log = chat.streamed(chat.events_of_turns(turns.union(added)))
    formatted = written(chat.format_log(log), "chat")
    read = chat.parse(formatted)
    sizes = formatted.select(F.col("conv_id").alias("c"), F.length("formatted").cast("long").alias("formatted_chars"))
    turn = F.concat("role", F.lit("\n"), "text", F.lit("\n"))
    lists = read.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"), F.sort_array(F.collect_list(F.struct("turn", turn.alias("all"), "loss"))).alias("t")
    )
    whole = F.array_join(F.transform("t", lambda x: x["all"]), "")
    loss = F.array_join(F.transform("t", lambda x: F.coalesce(x["loss"], F.lit(""))), "")
    lists = lists.select("conv_id", "n_turns", whole.alias("whole"), loss.alias("loss"))
    both = lists.join(sizes, F.col("conv_id").eqNullSafe(F.col("c")))
    return both.select(
        "conv_id",
        "n_turns",
        _sha256("whole").alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        _sha256("loss").alias("loss_sha256"),
        "formatted_chars",
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.deduplicate(docs).select("doc_id", "n_words", "n_removed", _sha256("kept").alias("kept_sha256"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs).withColumn("uses", F.size("positions").cast("long"))
    first = F.round(F.try_element_at("positions", F.lit(1)), 6).alias("first_position")
    rows = mixed.select("doc_id", "size", "source_size", "target", "taken", "uses", first)
    return rows.orderBy(F.col("first_position").asc_nulls_last(), "doc_id")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.with_signals(docs, keep=["doc_id"]).select("doc_id", *quality.LONGS, "base_failed", "kept")


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    token_output.write(docs, public_tokenizers.path("word_bpe_49k.json"), path)
    return token_output.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents").select("text", "lang", "source"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.classify(docs, _table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    changed = merkle.leaf([F.col(f) + 1 if f == "n_chars" else F.col(f) for f in fields])
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found = merkle.manifest(docs, "lang", "doc_id", fields, {"tampered": F.when(picked, changed)})
    folded = merkle.folded(F.coalesce("tampered", "leaf"), F.col("proof"))
    rows = found.withColumn("folded_root", folded)
    return rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_hash(F.col("proof")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_bpe": op3_bpe,
    "op4_line_dedup": op4_line_dedup,
    "op5_warc": op5_warc,
    "op6_chat_format": op6_chat_format,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_mixing": op8_mixing,
    "op9_quality_rules": op9_quality_rules,
    "op10_token_output": op10_token_output,
    "op11_source_divergence": op11_source_divergence,
    "op12_toxicity": op12_toxicity,
    "op13_merkle_manifest": op13_merkle_manifest,
    "pipeline": pipeline,
}
