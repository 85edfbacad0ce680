"""The queries of the training-data operators with their production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, exact_dedup, fim, license_scan, line_dedup, merkle, mixing, near_dedup, quality, sharding, sql, substring_dedup, url_filter, warc
from tidemark.llm.common import scratch, table


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.round_trip(docs, bpe.build(spark, docs, tokenizer_file()))


#: Longest fitting rule first: (verdict, host/path).
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad"))
    # The number that ends a path names the document that the page shows.
    number = F.regexp_extract(url_filter.path_of(F.col("url")), r"/(\d{1,18})(?:\.html)?/?$", 1).try_cast("bigint")
    return url_filter.judge(table(spark, sf_dir, "pages"), labels, RULES, label_key=number)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = line_dedup.drop_frequent(docs, line_dedup.batches_of(docs, 4), threshold=10, min_chars=1)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "utf-8"), 256).alias("kept_sha256"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), PHRASES)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups_of(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), budget_percent=150, max_epochs=2)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write(warc.revisits(table(spark, sf_dir, "pages")), path)
    page = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1).try_cast("bigint")
    return warc.read(spark, path, payloads=False).select(page(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", page(F.col("refers_to")).alias("refers_to"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.components(table(spark, sf_dir, "documents"), size=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_spans(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.restore(fim.rearrange(table(spark, sf_dir, "documents"), seed="7", units="lines", rate=100, spm=50))
    digest = lambda c: F.sha2(F.encode(c, "utf-8"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output").alias("output_sha256"), digest("restored").alias("restored_sha256"))


#: Two regions of two racks of two shards.
SHARDS = sharding.uniform(2, 2, 2)


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents"), SHARDS, sharding.grown(SHARDS))


LEAF = ("doc_id", "source", "lang", "n_chars", "text")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    changed = merkle.leaf_of([F.col(c).cast("decimal(38,0)") + 1 if c == "n_chars" else F.col(c) for c in LEAF])
    manifest = merkle.build(docs, scratch(spark, "manifest"), [F.col(c) for c in LEAF], also={"presented": F.when(tampered, changed)})
    proofs = manifest.proofs().withColumn("folded_root", merkle.folded(F.coalesce("presented", "leaf"), F.col("siblings")))
    return proofs.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("siblings")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_url_filters": op2_url_filters,
    "op3_line_dedup": op3_line_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_license_scan": op5_license_scan,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_mixing": op7_mixing,
    "op8_warc": op8_warc,
    "op9_minhash": op9_minhash,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_sharding": op12_sharding,
    "op13_merkle": op13_merkle,
}

#: SQL has neither the tokenizer (1), the template tree (2) nor rolling hashes (10); tests hold those against brute force.
SQL: dict[str, str] = {
    "op3_line_dedup": sql.line_dedup(10),
    "op4_quality_rules": sql.quality(quality.RATES, quality.BITS, quality.SPREAD, quality.GUARD, quality.SIGMAS, quality.MIN_DOCS),
    "op5_license_scan": sql.license_scan(PHRASES, [(label, license_scan.template_words(t), license_scan.least_of(t), *license_scan.shape_of(t)) for label, t in license_scan.TEMPLATES]),
    "op6_exact_dedup": sql.exact_dedup(),
    "op7_mixing": sql.mixing((3, 1, 2), 150, 2, mixing.LEAST_WEIGHT),
    "op8_warc": sql.warc(),
    "op9_minhash": sql.near_dedup(3, 85),
    "op11_fill_in_middle": sql.fill_in_middle("7", fim.SENTINELS, 100, 50),
    "op12_sharding": sql.sharding(sharding.nodes_of(SHARDS), sharding.nodes_of(sharding.grown(SHARDS)), "shard"),
    "op13_merkle": sql.merkle(LEAF, "n_chars"),
}
