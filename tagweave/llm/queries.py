"""The operators over the given tables, with production parameters; SQL where SQL can state the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.catalog import Catalog
from tagweave.llm import alignment, contamination, language, licenses, mixing, phrases, pii, quality, repeats, rules, secrets, simhash, sql, warc

CATALOG = Catalog()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and texts of all documents."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def digest(joined):
    """Lowercase hexadecimal SHA-256 of a string."""
    return F.sha2(joined, 256)


@CATALOG.query("op1_source_mixing")
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.taken_words(mixing.mix(docs))


@CATALOG.query("op2_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs.where(~language.held_out()))
    return language.identify(texts(spark, sf_dir), model).select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@CATALOG.query("op3_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels that are not held out."""
    docs, labels = texts(spark, sf_dir), table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.train(docs, labels.where(~language.held_out()))
    return quality.classify(docs, model).select("doc_id", language.held_out().alias("held_out"), "score", "predicted")


@CATALOG.query("op4_pii")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = texts(spark, sf_dir)
    found = pii.find(docs, pii.train(docs))
    return found.select(
        "doc_id",
        *[pii.count_of(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        digest(pii.listed("base")).alias("base_sha256"),
        pii.listed("found").alias("spans"),
    )


@CATALOG.query("op5_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-copy group of every document."""
    return simhash.near_duplicates(texts(spark, sf_dir))


@CATALOG.query("op6_secret_scan", sql.SECRETS)
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secrets.scan(texts(spark, sf_dir)).select(
        "doc_id",
        *[secrets.count_of(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        digest(secrets.listed("base")).alias("base_sha256"),
        secrets.listed("secrets").alias("spans"),
    )


@CATALOG.query("op7_benchmark_decontamination", sql.DECONTAMINATION)
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in benchmark windows."""
    found = contamination.contaminated(texts(spark, sf_dir), table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        digest(F.array_join("item_ids", ",")).alias("items_sha256"),
        "contaminated",
    )


@CATALOG.query("op8_license_scan", sql.LICENSES)
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every document."""
    found = licenses.scan(texts(spark, sf_dir))
    return found.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join("licenses.license", ",").alias("licenses"),
        F.array_max("licenses.dice").alias("best_dice"),
    )


@CATALOG.query("op9_quality_rules", sql.QUALITY_RULES)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of line-first cleaning for every document."""
    return rules.judge(texts(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@CATALOG.query("op10_suffix_array_dedup", sql.REPEATS)
def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that lie in repeated strings of 400 bytes."""
    found = repeats.remove_repeats(texts(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


@CATALOG.query("op11_phrase_collocations", sql.COLLOCATIONS)
def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


@CATALOG.query("op12_tokenizer_alignment")
def tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two vocabularies lie over each other in every document."""
    found = alignment.align(texts(spark, sf_dir))
    groups = F.when(F.col("groups") == "", "").otherwise(digest("groups")).alias("groups_sha256")
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", groups)


@CATALOG.query("op13_warc_archive", sql.ARCHIVE)
def warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived once by its payload, and read back."""
    pages, folder = table(spark, sf_dir, "pages").select("page_id", "url", "html"), warc.new_folder(spark)
    warc.write_archive(pages, folder)
    kind = pages.schema["page_id"].dataType
    return warc.read_archive(spark, folder).select(
        F.col("key").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")
    )
