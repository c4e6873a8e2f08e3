"""The registered queries of this folder, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finchlake.llm.common import text_or_empty
from finchlake.llm.frames import read_token_frames, write_token_frames
from finchlake.llm.hypershuffle import hypergeometric_shuffle
from finchlake.llm.layout_text import with_layout_text
from finchlake.llm.line_runs import drop_repeated_lines
from finchlake.llm.mixture import Mixture, words
from finchlake.llm.order_minhash import order_minhash
from finchlake.llm.packing import crc32_of, pieces_of, place, sequences, token_pieces
from finchlake.llm.probminhash import near_duplicate_classes
from finchlake.llm.product_codes import product_codes
from finchlake.llm.quality_gam import fit_quality, with_quality
from finchlake.llm.resampling import importance_resample
from finchlake.llm.topk_search import quantized, top_k
from finchlake.llm.toxicity import fit_detector, with_toxicity
from finchlake.session import written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_deobfuscated_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 1
    detector = fit_detector(docs, "doc_id", "text", labels, "toxic", may_train=~held_out)
    return with_toxicity(docs, "text", detector).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


@query("op2_token_frames")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = write_token_frames(docs, "doc_id", "text", tokenizer_path("byte_bpe_50k.json"), end_id=2)
    return read_token_frames(manifest, "doc_id").select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


@query("op3_hypergeometric_shuffle")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    dealt = hypergeometric_shuffle(docs, ["doc_id"], shards=24)
    return dealt.select(
        "doc_id", (F.octet_length(text_or_empty("text")) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text_or_empty("text"), "UTF-8")).alias("text_crc32"), F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op4_layout_text")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return with_layout_text(pages, "html").select("page_id", "url", "text")


@query("op5_prob_minhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")


OP6_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
long AS (SELECT vec_id, unnest(v) AS w, unnest(range(len(v))) AS t FROM usable),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.w * c.w) AS BIGINT) AS score
  FROM long q JOIN long c ON q.t = c.t AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored QUALIFY rank <= 5
"""


@query("op6_exact_top_k", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", quantized(F.col("embedding")).alias("v"))
    return top_k(vectors, "vec_id", "v", F.col("vec_id") % 50 == 0, k=5)


OP7_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos FROM texts
),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
),
frequent AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT keyed.*, k IN (SELECT k FROM frequent) AS gone FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op7_line_runs", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_lines(docs, "text", limit=10).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


@query("op8_mixture")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "documents").select("doc_id", "source", words(F.col("text")).alias("n_words"))
    mix = Mixture(written(sizes, "sizes"), "doc_id", "source", F.col("n_words"))
    return mix.usage().select("doc_id", "size", "source_size", "target", "taken")


CAPACITY = 2048


@query("op9_histogram_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = token_pieces(docs, "doc_id", "text", tokenizer_path("word_bpe_49k.json"), 0, CAPACITY, id_bytes=2)
    tokens = written(pieces.withColumnRenamed("key", "doc_id"), "pieces")
    placed = place(tokens, "length", CAPACITY, ["doc_id", "piece", "ids_crc32"])
    packed = written(sequences(placed, ["doc_id", "piece", "start"]), "sequences")
    return pieces_of(packed, id_bytes=2).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"),
        crc32_of(F.col("ids"), id_bytes=2).alias("ids_crc32"),
        "sequence_id", "offset")


@query("op10_order_minhash")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return order_minhash(docs, "doc_id", "text")


OP11_SQL = r"""
WITH polynomial AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS v
    FROM (SELECT unnest(range(256)) AS i))
),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS found FROM documents
),
own AS (SELECT r, unnest(found) AS w FROM docs),
aims AS (
  SELECT unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark
),
vocabulary AS (
  SELECT w, xor(list_reduce(
      list_transform(range(octet_length(encode(w))), lambda j: ('0x' || substr(hex(encode(w)), (2 * j + 1)::INT, 2))::BIGINT),
      lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS b
  FROM (SELECT w FROM own UNION SELECT w FROM aims), polynomial
),
source AS (SELECT b, count(*) AS s FROM own JOIN vocabulary USING (w) GROUP BY b),
target AS (SELECT b, count(*) AS t FROM aims JOIN vocabulary USING (w) GROUP BY b),
totals AS (SELECT (SELECT count(*) FROM own)::DOUBLE AS all_s, (SELECT count(*) FROM aims)::DOUBLE AS all_t),
gain AS (
  SELECT b, floor(1000 * ln(((coalesce(t, 0) + 1.0::DOUBLE) * (all_s + 10000)) /
                            ((coalesce(s, 0) + 1.0::DOUBLE) * (all_t + 10000))))::BIGINT AS g
  FROM source FULL JOIN target USING (b), totals
),
weighed AS (
  SELECT r, count(*) AS n_features, sum(g)::BIGINT AS weight FROM own JOIN vocabulary USING (w) JOIN gain USING (b) GROUP BY r
),
scored AS (
  SELECT d.r, doc_id, len(found) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
           / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM docs d LEFT JOIN weighed USING (r)
),
ranked AS (
  SELECT *, n_words >= 20 AS fit, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS n,
         10 * count(*) OVER (PARTITION BY n_words >= 20) // 100 AS drawn FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND n <= drawn THEN n END AS rank FROM ranked
"""


@query("op11_bit_sliced_resampling", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance_resample(docs, "doc_id", "text", table(spark, sf_dir, "benchmark"), "text", buckets=10_000,
                               longest=1, seed=2024, least_words=20, percent=10)


def _codebook_round(n: int) -> str:
    """SQL of one assignment of all parts to the entries ``e<n>`` and of the entries that follow from it."""
    return f""",
near{n} AS (
  SELECT r, position, any_value(p.v) AS v, min(struct_pack(d := list_sum(list_transform(list_zip(p.v, e.v),
         lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, entry := e.entry)) AS best
  FROM parts p JOIN e{n} e USING (position) GROUP BY r, position
),
sums{n} AS (
  SELECT position, entry, i, sum(x)::BIGINT AS s, count(*) AS c FROM (
    SELECT position, best.entry AS entry, unnest(v) AS x, unnest(range(len(v))) AS i FROM near{n}) GROUP BY ALL
),
e{n + 1} AS (
  SELECT position, entry, coalesce(m.v, e{n}.v) AS v FROM e{n} LEFT JOIN (
    SELECT position, entry, list((s - ((s % c) + c) % c) // c ORDER BY i) AS v FROM sums{n} GROUP BY ALL
  ) m USING (position, entry)
)"""


OP12_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS r, vec_id, label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS (
  SELECT r, position, v[position * len(v) // 16 + 1:(position + 1) * len(v) // 16] AS v
  FROM kept, (SELECT unnest(range(16)) AS position)
),
e0 AS (SELECT position, r AS entry, v FROM parts WHERE r < 64){_codebook_round(0)}{_codebook_round(1)}{_codebook_round(2)},
coded AS (
  SELECT r, string_agg(printf('%02x', best.entry::INT), '' ORDER BY position) AS code, sum(best.d)::BIGINT AS error
  FROM near2 GROUP BY r
),
books AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY position, entry)) AS codebooks_sha256 FROM e2
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), books
"""


@query("op12_orchard_codes", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return product_codes(vectors, "vec_id", "embedding", "label", parts=16, entries=64, rounds=2).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")


@query("op13_additive_quality")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 4 == 2, F.lit(False))
    model = fit_quality(docs, "doc_id", "text", labels, "quality", may_train=~held_out)
    return with_quality(docs, "text", model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
