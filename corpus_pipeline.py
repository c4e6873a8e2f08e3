"""A training corpus from documents: detoxified, without repeated lines and near copies, mixed and packed.

Every stage takes (spark, docs, sf_dir) and returns a table that is written and read again as the next
one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finchlake.llm.line_runs import drop_repeated_lines
from finchlake.llm.mixture import Mixture, words
from finchlake.llm.packing import place, token_pieces
from finchlake.llm.probminhash import one_of_each_class
from finchlake.llm.toxicity import fit_detector, with_toxicity
from finchlake.session import written

TOKENIZER = "word_bpe_49k.json"
END_ID = 0
CAPACITY = 2048
PIECES_KEPT = 250_000   # that a worker remembers, for it may still hold what the stages before took
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _named(docs: DataFrame) -> DataFrame:
    """The columns of documents; n_chars follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the detector does not reject; it learns from the labels of two folds of three."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 1
    detector = fit_detector(docs, "doc_id", "text", labels, "toxic", may_train=~held_out)
    return with_toxicity(docs, "text", detector).where(F.col("predicted") == 0).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that stand in ten and more of them."""
    return _named(drop_repeated_lines(docs, "text", limit=10))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return one_of_each_class(docs, "doc_id", "text").select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources takes them, once a row; the last of a source may be cut."""
    return _named(Mixture(docs, "doc_id", "source", words(F.col("text"))).documents("text"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their tokens, and their places in sequences.

    A repeated document has several copies. The ids of a sequence are those of its pieces by offset.
    """
    import public_tokenizers

    pieces = token_pieces(docs, "doc_id", "text", public_tokenizers.path(TOKENIZER), END_ID, CAPACITY, kept=PIECES_KEPT)
    tokens = written(pieces.withColumnRenamed("key", "doc_id"), "pieces")
    return place(tokens, "length", CAPACITY, ["doc_id", "piece", "ids_crc32"])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", source_mix),
    ("best-fit packing", packing),
]

#: SQL cannot express tokenizers, trained models or hash orders: tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
