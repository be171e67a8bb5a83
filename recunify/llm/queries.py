"""The registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recunify.llm import (collocations, decontam, jaccard, kneser_ney, langid, licenses, lines, pieces, secret_scan,
                          spelling, substring, toxicity, urls)
from recunify.llm.sql import SQL  # noqa: F401  (registered beside QUERIES)
from recunify.llm.store import stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op1_substring_dedup(spark, sf_dir):
    found = substring.dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_sentencepiece(spark, sf_dir):
    return pieces.digest(table(spark, sf_dir, "documents"), piece_model())


def op3_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return urls.url_filter(urls.sample_captures(pages), urls.sample_events(pages), lambda df: stage(df, "op3"))


def op4_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out(F.col("doc_id"), 5, 0))
    model = langid.fit(docs.filter("not held_out"))
    return langid.predict(docs, model, keep=("held_out",))


def op5_jaccard_join(spark, sf_dir):
    return jaccard.join(table(spark, sf_dir, "documents"), lambda df: stage(df, "op5"))


def op6_quality_rules(spark, sf_dir):
    return lines.quality(table(spark, sf_dir, "documents"), lambda df: stage(df, "op6"))


def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out(F.col("doc_id"), 3, 1))
    model = toxicity.fit(docs.filter("not held_out"), table(spark, sf_dir, "labels").filter(
        ~langid.held_out(F.col("doc_id"), 3, 1)))
    return toxicity.score(docs, model, keep=("held_out",))


def op8_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.findings(docs, secret_scan.fit(docs))


def op9_license_scan(spark, sf_dir):
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op10_decontamination(spark, sf_dir):
    return decontam.verdicts(decontam.occurrences(table(spark, sf_dir, "documents"),
                                                  table(spark, sf_dir, "benchmark")))


def op11_spelling_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"), lambda df: stage(df, "op11"))


def op12_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out(F.col("doc_id"), 7, 2))
    return kneser_ney.score(docs, kneser_ney.fit(docs.filter("not held_out")), keep=("held_out",))


def op13_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"), lambda df: stage(df, "op13"))


QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_sentencepiece, op3_url_filter, op4_language_id, op5_jaccard_join, op6_quality_rules,
    op7_toxicity, op8_secret_scan, op9_license_scan, op10_decontamination, op11_spelling_variants,
    op12_lm_scoring, op13_collocations)}
