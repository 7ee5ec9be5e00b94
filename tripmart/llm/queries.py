"""One named query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import quality_knn, toxicity
from tripmart.llm.bpe import token_digests
from tripmart.llm.collocations import Collocations, collocations
from tripmart.llm.decontaminate import Decontaminate, leaks
from tripmart.llm.language import LanguageId, identify, learn
from tripmart.llm.line_dedup import LineDedup, drop_boilerplate
from tripmart.llm.near_dedup import NearDedup, near_duplicates
from tripmart.llm.periodic_runs import PeriodicRuns, periodic_runs
from tripmart.llm.quality_rules import QualityRules, quality_verdicts
from tripmart.llm.site_style import SiteStyle, extract_main_text
from tripmart.llm.tables import held_out, table
from tripmart.llm.vantage_trees import VpSearch, build, search
from tripmart.llm.warc import WarcFormat, round_trip


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, aside = table(spark, sf_dir, "documents"), held_out("doc_id", 5, 0)
    model = toxicity.learn(docs.where(~aside), table(spark, sf_dir, "labels").where(~aside), toxicity.Toxicity())
    return toxicity.score(docs, model).select("doc_id", aside.alias("held_out"), "score", toxicity.predicted())


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that it contains; other documents have none."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Decontaminate())


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), NearDedup(shingle_words=2))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out("doc_id", 4, 2)), LanguageId())
    found = identify(docs, model)
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_main_text(table(spark, sf_dir, "pages"), SiteStyle())
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, aside = table(spark, sf_dir, "documents"), held_out("doc_id", 3, 1)
    model = quality_knn.learn(docs.where(~aside), table(spark, sf_dir, "labels").where(~aside), quality_knn.QualityKnn())
    return quality_knn.score(docs, model).select("doc_id", aside.alias("held_out"), "score", quality_knn.predicted())


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), vocabulary_path())


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), QualityRules())


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = drop_boilerplate(table(spark, sf_dir, "documents"), LineDedup())
    return cleaned.select("doc_id", "source", "text", "lines_dropped")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"), WarcFormat())


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), Collocations())


def op12_vantage_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(build(vectors, VpSearch()), vectors.where("vec_id % 20 = 0"), VpSearch())


def repeated_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): texts whose id hashes to a multiple of ten have their tail replaced by repeats of its first words."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[ \\t-\\r]+"), lambda word: word != "")
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("hash"))
    rows = rows.select("doc_id", "text", F.floor(F.col("hash") / 10).alias("g"), F.when(F.col("hash") % 10 == 0, words).alias("words"))
    n = F.size("words")
    at = F.col("g") % n
    period = (1 + F.floor((n - at) / (3 + F.col("g") % 8))).cast("int")
    tail = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("words", F.when(i < at, i).otherwise(at + (i - at) % period).cast("int")))
    return rows.select("doc_id", F.when(n > 0, F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(repeated_tails(table(spark, sf_dir, "documents")), PeriodicRuns())
    # The greatest exact quotient of two longs: compare l1 * p2 with l2 * p1, then start and period.
    whole = lambda value: value.cast("decimal(19,0)")

    def better(best, run):
        one, other = whole(run["length"]) * whole(best["period"]), whole(best["length"]) * whole(run["period"])
        return F.when(best.isNull() | (one > other), run).otherwise(best)

    best = F.aggregate("runs", F.expr("cast(null as struct<start: long, length: long, period: long>)"), better)
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    rows = found.select(F.col("key").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed")
    return rows.select(
        "doc_id",
        "n_runs",
        *(f"best.{name}" for name in ("start", "length", "period")),
        F.expr("(1000 * cast(best.length as decimal(19,0))) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join("lines", "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_language_id": op4_language_id,
    "op5_html_extraction": op5_html_extraction,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_bpe": op7_bpe,
    "op8_quality_rules": op8_quality_rules,
    "op9_line_dedup": op9_line_dedup,
    "op10_warc": op10_warc,
    "op11_collocations": op11_collocations,
    "op12_vantage_trees": op12_vantage_trees,
    "op13_periodic_runs": op13_periodic_runs,
}
