"""A corpus cleaned, mixed and packed for training, in stages that each call one operator of ``dimflow.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.llm import lines, minhash, mixing, packing, toxicity
from dimflow.llm.common import stored, table
from dimflow.llm.queries import domain_mix, labelled, tokenizer


NEAR_PERCENT = 80  # of the shingles of two near duplicates
BATCH_ROWS = 500  # of whole texts that go to a worker at once: about a chunk. Spark's 10,000 are meant for short rows


def _short_batches(spark: SparkSession) -> None:
    """From here on, as stages run when their results are written. A smaller number that the session has stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars`` anew, where the table has it."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents scored toxic, by a lexicon learned from the labelled ones."""
    _short_batches(spark)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    lexicon = toxicity.learn(labelled(docs.select("doc_id", "text"), labels))
    return toxicity.scored(docs, lexicon).filter("predicted = 0").select(*docs.columns)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later copies of repeated runs of lines, and documents of which nothing else is left."""
    left = lines.without_repeated_runs(docs)
    emptied = (F.col("n_removed") > 0) & (F.trim(F.translate("text", "\n", " ")) == "")
    return _sized(left.filter(~F.coalesce(emptied, F.lit(False))).select(*docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    _short_batches(spark)
    return minhash.without_near_duplicates(docs, NEAR_PERCENT)


def target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that poor and good tokens come to their shares; the good ones' total stays as it is."""
    _short_batches(spark)
    return mixing.mixed(docs, domain_mix(spark, docs, sf_dir))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' token pieces into sequences."""
    _short_batches(spark)
    return packing.pack(packing.token_pieces(docs, tokenizer()))


STAGES = [("toxicity", toxic_documents), ("line dedup", repeated_lines), ("minhash near-dedup", near_duplicates),
          ("mixing to target weights", target_weights), ("best-fit packing", best_fit_packing)]

#: SQL can express neither the fitted stages nor the packing; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
