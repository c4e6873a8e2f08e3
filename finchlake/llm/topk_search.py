"""Operator 6: exact top-k inner products by exhaustive term-at-a-time accumulation.

Vectors are sparse rows of integer weights. Within a block of candidates every term (dimension) has its
postings, the candidates that hold it and their weights. A query adds, term by term, its weight times the
postings into a dense array with one score per candidate; partition selection keeps its best k of the
block, and the bests of all blocks are merged. Every candidate is scored for every query.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finchlake.llm.common import column
from finchlake.session import fresh_path

QUERIES_AT_A_TIME = 16_384
BLOCK = 8_192
FOUND = "query_id long, vec_id long, score long"


def quantized(vector: Column) -> Column:
    """floor(256 x) of every component; null if the vector or a component is null or not finite."""
    usable = vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * 256)))


class Postings:
    """The postings of a block of vectors (ids ascending), each term's either listed or, if most hold it, dense."""

    def __init__(self, ids: np.ndarray, vectors: list[np.ndarray]):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.n = len(ids)
        width = max((len(v) for v in vectors), default=0)
        table = np.zeros((width, self.n), dtype=np.int64)
        for j, i in enumerate(order):
            table[:len(vectors[i]), j] = vectors[i]
        self.largest = int(np.abs(table).max(initial=0))
        self.terms: list[tuple[np.ndarray | None, np.ndarray]] = []
        for weights in table:
            held = np.flatnonzero(weights)
            dense = 2 * len(held) > self.n
            self.terms.append((None, weights) if dense else (held, weights[held]))

    def scores(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        total = np.zeros(self.n, dtype=np.int64)
        for term, weight in zip(terms.tolist(), weights.tolist()):
            if term < len(self.terms):
                held, values = self.terms[term]
                if held is None:
                    total += weight * values
                else:
                    total[held] += weight * values
        return total

    def best(self, scores: np.ndarray, own: int, k: int) -> np.ndarray:
        """Positions of the ``k`` highest scores, ties to the smaller id, without the query's own row."""
        allowed = np.flatnonzero(self.ids != own)
        values = scores[allowed]
        if len(values) > k:
            least = np.partition(values, len(values) - k)[len(values) - k]
            above = np.flatnonzero(values > least)
            ties = np.flatnonzero(values == least)[:k - len(above)]  # ids ascend
            allowed = allowed[np.concatenate((above, ties))]
        return allowed


def top_k(df: DataFrame, key: str, vector: str, is_query: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best other rows of each row for which ``is_query`` holds.

    ``vector`` holds integers; a null vector or key takes no part, and a shorter vector is filled up with
    zeros. Rows with the query's key are its own; candidates that repeat are found repeatedly. Scores must
    fit a long. Queries go to the tasks in batches of QUERIES_AT_A_TIME rows, one pass over the candidates
    for each, so what is broadcast does not grow with the table. An empty table gives no rows.
    """
    spark = df.sparkSession
    usable = df.select(column(key).cast("long").alias("id"), column(vector).alias("v"), is_query.alias("q")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull())
    queries = usable.where("q").select("id", "v").distinct()
    rounds = -(-queries.count() // QUERIES_AT_A_TIME)
    path = fresh_path(spark, "topk")
    for number in range(rounds):
        part = queries.where(F.pmod(F.xxhash64("id", "v"), F.lit(rounds)) == number).toArrow()
        rows = [np.array(v, dtype=np.int64) for v in part.column("v").to_pylist()]
        terms = [np.flatnonzero(v) for v in rows]
        sparse = [(i, t, v[t]) for i, t, v in zip(part.column("id").to_pylist(), terms, rows)]
        shared = spark.sparkContext.broadcast(sparse)

        def search(batches: Iterable[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for at in range(0, len(batch), BLOCK):
                    block = batch.iloc[at:at + BLOCK]
                    postings = Postings(block["id"].to_numpy(np.int64), list(block["v"]))
                    found = []
                    for own, held, weights in shared.value:
                        scores = postings.scores(held, weights)
                        best = postings.best(scores, own, k)
                        found.append((np.full(len(best), own), postings.ids[best], scores[best]))
                    columns = [np.concatenate(c) for c in zip(*found)] if found else [[], [], []]
                    yield pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)), dtype="int64")

        usable.select("id", "v").mapInPandas(search, FOUND).write.mode("append").parquet(path)
        shared.destroy()
    found = spark.read.schema(FOUND).parquet(path) if rounds else spark.createDataFrame([], FOUND)
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
