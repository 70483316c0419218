"""The registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from keelson.llm import (
    arc_to_warc, bag_search, bpe, decontaminate, link_graph, merkle_manifest, secret_grammar, simhash_pivots, soft_mixing,
    substring_dedup, target_ratio, toxicity, two_pass_shuffle)
from keelson.llm.sql import ORACLE
from keelson.llm.text import small_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the rules, else by its host's converged trust and distrust."""
    out = link_graph.judge(_table(spark, sf_dir, "pages").select("page_id", "url", "html"), steps=None)
    return out.select("page.page_id", "host", "path", "rule", "verdict", "trust", "distrust")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words in every document, by broadcast hash sets of the items' windows."""
    found = decontaminate.benchmark_hits(_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                         _table(spark, sf_dir, "benchmark"))
    return found.select("doc.doc_id", "n_words", decontaminate.n_hit().alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
                        decontaminate.contaminated().alias("contaminated"))


def op3_secret_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: the listed patterns, and candidates of a learned format."""
    out = secret_grammar.find_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != secret_grammar.ADDED)
    return out.select("doc.doc_id", *(F.expr(f"size(filter(spans, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}")
                                      for k in secret_grammar.KINDS),
                      F.sha2(F.encode(joined(base), "UTF-8"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op4_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash_pivots.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        "component_id")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled rows that are not held out."""
    out = toxicity.score(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))
    return out.select("doc.doc_id", "held_out", "score", "predicted")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows that start earlier in the corpus."""
    out = substring_dedup.dedup_substrings(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc.doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op7_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived as ARC, converted to WARC and read back."""
    return arc_to_warc.round_trip(_table(spark, sf_dir, "pages"))


def op8_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shuffled shards, by key."""
    out = two_pass_shuffle.shuffle_into_shards(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc.doc_id", two_pass_shuffle.record_size("doc.text").alias("size"),
                      F.crc32(F.encode(F.coalesce("doc.text", F.lit("")), "UTF-8")).alias("text_crc32"),
                      F.lit(two_pass_shuffle.LAW).alias("law"), "shard", "slot", "grown_shard")


def op9_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate and copies of every document so that the domains' expected tokens meet the targets."""
    out = soft_mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.select("doc.doc_id", "tokens", *(F.coalesce(F.col("posterior")[k], F.lit(0.0)).alias(f"p_{k}")
                                                for k in soft_mixing.TARGETS), "rate", "copies")


def op10_target_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counting rules and the trusted-against-raw ratio of every document."""
    out = target_ratio.score_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                       _table(spark, sf_dir, "labels"))
    return out.select("doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "ratio")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and root, and the root folded from a copy in which a third of the texts are lower-cased."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = _table(spark, sf_dir, "documents").select(*fields)
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = merkle_manifest.leaf([*(F.col(c) for c in fields[:-1]), lower])
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    out = merkle_manifest.manifest(docs, "doc_id", "lang", fields, seen=F.when(third, tampered))
    out = out.withColumn("folded_root", merkle_manifest.fold(F.coalesce("seen", "leaf"), F.col("path")))
    return out.select("doc_id", "leaf", "subroot", "root",
                      F.sha2(merkle_manifest.proof(F.col("path")), 256).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_rank_array_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text that they decode to."""
    import public_tokenizers
    vocabulary = bpe.read_vocabulary(spark, public_tokenizers.path("byte_bpe_50k.json"))
    coded = bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), "text", vocabulary)
    out = bpe.decode(coded.select("doc.doc_id", "ids"), "ids", vocabulary)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.encode(listed, "UTF-8"), 256).alias("ids_sha256"),
                      F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op13_bag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return bag_search.search(_table(spark, sf_dir, "documents").select("doc_id", "text"),
                             _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_link_graph, op2_decontaminate, op3_secret_grammar, op4_simhash_pivots, op5_toxicity, op6_substring_dedup,
        op7_arc_to_warc, op8_two_pass_shuffle, op9_soft_mixing, op10_target_ratio, op11_merkle_manifest,
        op12_rank_array_bpe, op13_bag_search)}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
