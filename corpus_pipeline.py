"""A training corpus in five stages, each a Spark job over all that its predecessor kept.

toxicity (toxic documents go), MinHash near-dedup (one document of each group
stays), suffix-array dedup (passages of over 50 words that occur again are cut out but for one), mixing sources to target
weights (documents are repeated or left out), byte-level BPE (texts become ids).

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``docs``.  Every stage takes null and empty texts, null
sources, repeated rows and further columns; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, mixing, neardup, queries, ship, suffixdedup, toxicity
from tidemark.session import scratch_path

#: Score from which a document is rejected; higher than where a label is predicted, so that clean documents stay (figures in the README).
REJECT = 0.5
#: Words of a repeat that is cut out, and bytes of one with fewer words (long words, scripts without blanks).
REPEAT_WORDS = 51
REPEAT_BYTES = 400


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not labelled toxic whose text scores below ``REJECT``; the model is learned from the labelled ones among them."""
    ship.ensure(spark)
    labels = queries.table(spark, sf_dir, "labels")
    confirmed = labels.where("toxic = 1").select("doc_id").distinct()
    return toxicity.below(docs, queries.toxicity_model(docs, labels), REJECT).join(confirmed, "doc_id", "left_anti").select(*docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles of five words and a similarity of 0.8."""
    ship.ensure(spark)
    return neardup.one_of_each(docs, neardup.Setting(width=5, similar=80))


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their long repeats but the first of each; documents of which nothing is left go.

    The first is that of the smallest row key and place, so what documents
    share stays in the corpus once.  A cut may fall inside a character; what is left of it is dropped, and
    ``n_chars`` follows the text.  Untouched documents stay as they are.
    """
    ship.ensure(spark)
    return suffixdedup.without_repeats(docs, REPEAT_BYTES, words=REPEAT_WORDS, keep_first=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    sized = docs.select(
        F.col("doc_id").alias("id"), "source", mixing.word_count(F.col("text").cast("string")).alias("size")
    )
    return mixing.repeat_rows(docs, mixing.mix(sized), "doc_id", "text", "source")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document taken, once for each time."""
    ship.ensure(spark)
    return bpe.digests(bpe.round_trip(docs, queries.RANK_FILE, queries.PATTERN))


STAGES = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("repeats", remove_repeats),
    ("mixing", mix_sources),
    ("tokens", encode),
]

#: The stages use trained scores, iterated components and sorted suffixes, which SQL cannot say.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
