"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm import bpe_reuse, html_extract, merkle, ngram_join, packing, pii, quality_rules, secret_scan, substring_dedup, token_files, topk, toxicity, vector_codes
from slotwise.llm import spans as S
from slotwise.llm.common import table


def _span_digest(found: DataFrame, kinds: tuple[str, ...], n_base: int) -> DataFrame:
    """Counts, base hash and span list from base and all spans."""
    return found.select(
        "doc_id",
        *(S.n_of(F.col("base"), k).alias(f"n_{kinds[k]}") for k in range(n_base)),
        F.sha2(S.listed(F.col("base"), kinds), 256).alias("base_sha256"),
        S.listed(F.col("spans"), kinds).alias("spans"),
    )


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    lexicon = toxicity.learn(toxicity.sample(docs, labels.where(~held_out), toxicity.LexiconParams()))
    scored = toxicity.score(docs, lexicon)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicated(table(spark, sf_dir, "documents"), 13)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digest(secret_scan.find(table(spark, sf_dir, "documents")), secret_scan.KINDS, 3)


def op7_bpe_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_reuse.encode(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), _tokenizer("byte_bpe_50k.tiktoken"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digest(pii.find(table(spark, sf_dir, "documents")), pii.KINDS, 4)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return got.select("doc_id", *(F.col(f"m.{n}").alias(n) for n in names), "kept")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked(table(spark, sf_dir, "documents"))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    one_line = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    got = merkle.manifest(table(spark, sf_dir, "documents"), one_line, tampered)
    return got.drop("proof")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode(table(spark, sf_dir, "embeddings"))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op")}
