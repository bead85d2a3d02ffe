"""The operators bound to the driver's tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyrisk.llm import conversations, decontaminate, lexical, lm, neardup, neighbours, oracle, pieces, quality, repeats, secrets, toxicity, urlfilter, warc
from skyrisk.session import pin_settings
from skyrisk.sources import shared

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = dict(oracle.SQL)


def query(f: Query) -> Query:
    @wraps(f)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return f(spark, folder)

    QUERIES[f.__name__] = run
    return run


def ship(spark: SparkSession) -> None:
    """Send the code to the executors; Spark does so once per file name. Smaller batches keep
    the Python workers small, of which an executor holds more than it has cores."""
    pin_settings(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    shared.ship(spark)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def public_tokenizer(name: str) -> str:
    """A vocabulary file of this machine; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_model() -> str:
    return public_tokenizer("piece_bpe_32k.model")


@query
def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.token_digests(table(spark, folder, "documents"), piece_model())


@query
def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digests(table(spark, folder, "documents"))


@query
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return quality.score(documents, quality.fit(documents, labels))


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return toxicity.score(documents, toxicity.fit(documents, labels))


@query
def op10_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.groups(table(spark, folder, "documents"), size=2, percent=80)


@query
def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.derive(warc.responses(table(spark, folder, "pages")))


@query
def op1_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(table(spark, folder, "embeddings"))


@query
def op9_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score(table(spark, folder, "documents"), public_tokenizer("word_bpe_49k.json"))


@query
def op6_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.digests(table(spark, folder, "documents"), texts=True)


# The rules of the query, and words of site names whose pages it lists.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
LISTED_SITES = "pills|spam|adult|bets"


@query
def op11_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    listed = urlfilter.canonical_urls(pages).where(F.col("host").rlike(LISTED_SITES))
    return urlfilter.judge(pages, spark.createDataFrame(URL_RULES, "host string, path string, verdict string"), listed)


@query
def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair(table(spark, folder, "conversations"))
