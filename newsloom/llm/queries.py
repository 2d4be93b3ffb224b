"""The operators over the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import (
    ball_codes, chat_format, decontamination, html_extraction, license_scan, minhash_dedup, mixing, quality_rules, secret_scan,
    spelling, substring_dedup, suffix_dedup, url_filter,
)
from newsloom.llm.texts import shown_id
from newsloom.session import materialize, spread

#: The rules of the URL query.
URL_RULES = [
    url_filter.UrlRule("block", "net", "/"),
    url_filter.UrlRule("allow", "example.net", "/en/"),
    url_filter.UrlRule("block", "example.com", "/de/"),
    url_filter.UrlRule("allow", "org", "/fr/"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(_table(spark, sf_dir, name))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, through a ledger of blobs."""
    docs = _texts(spark, sf_dir, "documents")
    ledger = materialize(secret_scan.scan(docs), "secret-ledger")
    found = secret_scan.findings(docs, ledger, keep=["doc_id"])
    return found.select("doc_id", *secret_columns())


def secret_columns() -> list[Column]:
    """Digest columns of rows with `spans`."""
    base = F.filter("spans", lambda s: s["rank"] < len(secret_scan.BASE_RULES))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return [*[count(rule.kind) for rule in secret_scan.BASE_RULES],
            F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
            secret_scan.joined(F.col("spans")).alias("spans")]


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the most similar window."""
    found = decontamination.leaks(_texts(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(shown_id("id").alias("doc_id"), "item_id", "start", "n_words", "similarity", "distance")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every byte under a 400-byte string that occurs elsewhere, removed from every document."""
    done, _ = suffix_dedup.dedup_strings(_texts(spark, sf_dir, "documents"), keep="none")
    return done.select(shown_id("id").alias("doc_id"), F.col("n").alias("n_bytes"), "n_removed", "n_spans", "kept_sha256")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url."""
    pages = spread(_table(spark, sf_dir, "pages").select("page_id", "url"))
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own or inherited licence of every document; source, language and hundreds of ids stand in for directories."""
    docs = _texts(spark, sf_dir, "documents")
    folder = F.floor(F.col("doc_id") / 100).cast("string")
    path = F.concat_ws("/", "source", "lang", folder, F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return license_scan.scan(docs.select("doc_id", path.alias("path"), "text"))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return minhash_dedup.near_duplicates(_texts(spark, sf_dir, "documents")).select(
        shown_id("id").alias("doc_id"), "n_shingles", shown_id("component_id").alias("component_id"), "kept")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word under a 50-word window that occurs in an earlier document, removed from every document."""
    done, _ = substring_dedup.dedup_passages(_texts(spark, sf_dir, "documents"))
    return done.select(shown_id("id").alias("doc_id"), F.col("n").alias("n_words"), "n_removed", "kept_sha256", "n_spans")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that says control strings, formatted and read back."""
    turns = _texts(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    more = spark.range(1).select(F.explode(F.array(F.lit("user"), F.lit("assistant"))).alias("role")).select(
        F.lit(-7).cast("long").alias("conv_id"), F.when(F.col("role") == "user", 0).otherwise(1).cast("long").alias("turn"),
        "role", F.lit(said).alias("text"))
    return chat_format.read_back(chat_format.format_conversations(turns.unionByName(more))).drop("n_tokens")


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    mixed = mixing.mix(_texts(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                        mixing.words_taken().cast("long").alias("taken"), "shards")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures and verdict of every document."""
    return quality_rules.apply_rules(_texts(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_removed")


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extraction.extract(_texts(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector."""
    coded, books = ball_codes.encode(_texts(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    return ball_codes.with_label_errors(coded).select(
        F.col("id").alias("vec_id"), ball_codes.code_text().alias("code"), "error", "label_error",
        F.lit(ball_codes.books_sha256(books)).alias("codebooks_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its form and root."""
    return spelling.group_variants(_texts(spark, sf_dir, "documents"))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_decontamination": op2_decontamination,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_license_scan": op5_license_scan,
    "op6_minhash_dedup": op6_minhash_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_chat_format": op8_chat_format,
    "op9_mix_sources": op9_mix_sources,
    "op10_quality_rules": op10_quality_rules,
    "op11_html_extraction": op11_html_extraction,
    "op12_vector_codes": op12_vector_codes,
    "op13_spelling_variants": op13_spelling_variants,
}
