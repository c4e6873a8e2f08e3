"""Every registered query with the SQL that checks it.

A query takes (spark, sf_dir) and runs over its whole tables. Queries whose result depends on a fitted
model, and those with no SQL form, are registered without SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finchlake.constants import DETACHMENT_RULES, IRREGULAR_LEMMAS, NEGATIONS, STOPWORDS
from finchlake.functions import text as tx
from finchlake.functions import tokens as tk
from finchlake.functions import unicode as un
from finchlake.operators import lexicon as lx
from finchlake.operators import metrics, ordinal, sentences, terms, vocabulary
from finchlake.operators.lookup import substitute_tokens
from finchlake.operators.pieces import Pieces
from finchlake.operators.rows import element_rows, laid_out
from finchlake.plans import evaluate, exact, model, preprocess
from finchlake.plans.features import Embedding, WordTerms, character_profile, embed, hashed_projection
from finchlake.plans.hooks import Encoder
from finchlake.queries import fixtures as fx
from finchlake.queries import sql as q
from finchlake.queries import stem_sql
from finchlake.session import fresh_path, written
from finchlake.sources import labelled as src
from finchlake.sources import lexicon as lex_src

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


def text_query(name: str, fn, sql_expression: str) -> None:
    """A query that rewrites the text of every noisy tweet."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fx.noisy_tweets(spark, sf_dir).select("doc_id", fn(F.col("text")).alias("text"))

    query(name, q.with_(q.NOISY) + f"SELECT doc_id, {sql_expression} AS text FROM noisy")(run)


# ---------------------------------------------------------------- string functions

text_query("clean_urls", tx.remove_urls, q.no_urls("text"))
text_query("clean_mentions", tx.remove_mentions, f"regexp_replace(text, '@{q.W}+', ' ', 'g')")
text_query("hashtag_split", tx.hashtags, q.hashtag_split("text"))
text_query("hashtag_remove", lambda c: tx.hashtags(c, "remove"),
           f"regexp_replace(text, '#{q.W}+', ' ', 'g')")
text_query("hashtag_keep", lambda c: tx.hashtags(c, "keep"), "text")
text_query("emoji_text", un.emoji_to_text, q.emoji("text"))


@query("emoji_sequences", q.with_(q.WITH_EMOJI) + f"SELECT doc_id, {q.emoji_sequences('text')} AS text FROM with_emoji")
def _emoji_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.with_emoji(spark, sf_dir).select("doc_id", un.emoji_to_text(F.col("text")).alias("text"))


text_query("lower_text", tx.lowercase, "lower(text)")
text_query("strip_punct", tx.remove_punctuation,
           rf"regexp_replace(text, '[^\p{{L}}\p{{N}}_{q.S}]', '', 'g')")
text_query("strip_digits", tx.remove_digits, q.no_digits("text"))
text_query("nfkc", lambda c: un.normalize_nfkc(tx.as_text(c)), q.nfkc("text"))
@query("nfkc_forms", q.with_(q.WITH_FORMS) + "SELECT doc_id, text FROM with_forms")
def _nfkc_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.with_forms(spark, sf_dir).select("doc_id", un.normalize_nfkc(tx.as_text(F.col("text"))).alias("text"))


text_query("light_clean", preprocess.light_clean, q.emoji(q.no_urls(q.nfkc("text"))))
text_query("contractions", tx.expand_contractions, q.contractions("text"))
text_query("slang", tx.replace_slang, q.slang("text"))
text_query("clean_text", preprocess.clean_text, q.clean("text"))


@query("html_entities", q.with_(q.NOISY) + (
    "SELECT kind, id, replace(regexp_replace(replace(replace(replace(text, '&quot;', '\"'), '&middot;', '·'), "
    "'&copy;', '©'), '&amp;?', '&', 'g'), chr(1), '') AS text FROM "
    "(SELECT 'tweet' AS kind, doc_id AS id, text FROM noisy UNION ALL "
    "SELECT 'page', page_id, html FROM pages)"
))
def html_entities(spark, sf_dir):
    tweets = fx.noisy_tweets(spark, sf_dir).select(F.lit("tweet").alias("kind"), F.col("doc_id").alias("id"), "text")
    pages = fx.table(spark, sf_dir, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text")
    )
    return tweets.unionByName(pages).withColumn("text", un.unescape_html(F.col("text")))


@query("elongation", q.with_(
    q.NOISY,
    f"flat AS (SELECT doc_id, trim(regexp_replace(text, '[{q.S}]+', ' ', 'g')) AS text FROM noisy)",
    q.squeezed("two", "flat", 2),
) + "SELECT doc_id, text FROM two")
def elongation(spark, sf_dir):
    return fx.noisy_tweets(spark, sf_dir).select(
        "doc_id", tx.squeeze_elongation(F.col("text")).alias("text")
    )


@query("negation_join", q.with_(q.NOISY, q.WORD_ROWS, q.NEGATION) + (
    "SELECT doc_id, string_agg(CASE WHEN head AND nxt_alpha THEN 'not_' || nxt ELSE tok END, ' ' "
    "ORDER BY pos) AS text FROM near WHERE NOT (after_head AND alpha) GROUP BY doc_id"
))
def negation_join(spark, sf_dir):
    return fx.noisy_tweets(spark, sf_dir).select(
        "doc_id", tk.join_negations(F.col("text")).alias("text")
    )


@query("contrast_text", q.with_(
    q.NOISY, q.WORD_ROWS, q.contrast("scoped", "word_rows", "contrast_", "left(tok, 1) IN ('.', '!', '?')")
) + "SELECT doc_id, string_agg(tok, ' ' ORDER BY pos) AS text FROM scoped GROUP BY doc_id")
def contrast_text(spark, sf_dir):
    return fx.noisy_tweets(spark, sf_dir).select(
        "doc_id", tk.mark_contrast_text(F.col("text")).alias("text")
    )


@query("contrast_tokens", q.with_(
    *q.RAW, "raw_rows AS (SELECT doc_id, unnest(toks) AS tok, unnest(range(len(toks))) AS pos FROM raw)",
    q.contrast("scoped", "raw_rows", "BUT_", "tok IN ('.', '!', '?')"),
) + "SELECT doc_id, count(*) AS n, string_agg(tok, ' ' ORDER BY pos) AS tokens FROM scoped GROUP BY doc_id")
def contrast_tokens(spark, sf_dir):
    rows = fx.tweet_token_rows(spark, sf_dir).select(
        "doc_id", tk.mark_contrast_tokens(F.col("tokens")).alias("t")
    )
    return rows.select("doc_id", F.size("t").cast("long").alias("n"), fx.joined_tokens("t"))


# ---------------------------------------------------------------- tokens

@query("tweet_tokens", q.with_(*q.RAW)
       + "SELECT doc_id, len(toks) AS n, array_to_string(toks, ' ') AS tokens FROM raw")
def tweet_tokens(spark, sf_dir):
    rows = fx.tweet_token_rows(spark, sf_dir)
    return rows.select("doc_id", F.size("tokens").cast("long").alias("n"), fx.joined_tokens("tokens"))


@query("word_tokens", q.with_(q.NOISY) + (
    f"SELECT doc_id, array_to_string({q.treebank('text')}, ' ') AS tokens FROM noisy"
))
def word_tokens(spark, sf_dir):
    tokens = tk.word_tokens(F.lower("text"))
    return fx.noisy_tweets(spark, sf_dir).select("doc_id", fx.joined_tokens(tokens))


@query("sentence_words", q.with_(*q.SENTENCES) + (
    "SELECT 'a' AS kind, word, round(score, 6) AS score FROM s_abbr "
    "UNION ALL SELECT 's', word, round(score, 6) FROM s_starters"
))
def sentence_words(spark, sf_dir):
    learned = sentences.learn(fx.with_sentences(spark, sf_dir), "text")
    return learned.select("kind", "word", F.round("score", 6).alias("score"))


@query("sentence_word_tokens", q.with_(*q.SENTENCES) + (
    f"SELECT doc_id, array_to_string({q.treebank('text', stops=False)}, ' ') AS tokens FROM s_text"
))
def sentence_word_tokens(spark, sf_dir):
    docs = fx.with_sentences(spark, sf_dir)
    split = sentences.split_stops(docs, "doc_id", "text", sentences.learn(docs, "text"))
    return split.select("doc_id", fx.joined_tokens(tk.word_tokens(F.lower("text"), stops_split=True)))


_TAG_SQL = (
    "CASE WHEN tok LIKE '%ing' THEN 'v' WHEN tok LIKE '%ed' THEN 'v' WHEN tok LIKE '%ly' THEN 'r' "
    "WHEN tok LIKE '%er' THEN 'a' WHEN tok LIKE '%est' THEN 'a' ELSE 'n' END"
)
_BASE_ROWS = "base_rows AS (SELECT doc_id, unnest(toks) AS tok, unnest(range(len(toks))) AS pos FROM base)"


@query("wordnet_pos", q.with_(*q.PRE, _BASE_ROWS) + (
    f"SELECT doc_id, {_TAG_SQL} AS wn_class, count(*) AS n FROM base_rows GROUP BY ALL"
))
def wordnet_pos(spark, sf_dir):
    rows = element_rows(fx.tokenized(spark, sf_dir), ["doc_id"], "tokens", "token")
    classes = rows.select("doc_id", tk.wordnet_class(fx.suffix_tag(F.col("token"))).alias("wn_class"))
    return classes.groupBy("doc_id", "wn_class").agg(F.count(F.lit(1)).alias("n"))


DICTIONARY_SHARE = 5e-5


def corpus_tokens(spark, sf_dir) -> DataFrame:
    """doc_id, tokens, written once for queries that count the words first and then replace or look them up."""
    rows = fx.processed(spark, sf_dir, add_bigrams=False, add_lexicon_tokens=False)
    return written(rows.select("doc_id", "tokens"), "tokens")


def corpus_words(tokenized: DataFrame) -> DataFrame:
    """word, n over the corpus, written once because several steps start from it."""
    return written(vocabulary.word_counts(tokenized, "tokens"), "words")


def dictionary(words: DataFrame) -> DataFrame:
    """Words that make up enough of the corpus to count as correct."""
    total = words.agg(F.sum("n").alias("total")).scalar()
    return words.where(F.col("n") >= total * DICTIONARY_SHARE)


_COUNTS_SQL = "counts AS (SELECT tok AS word, count(*) AS n FROM base_rows GROUP BY tok)"
_DICT_SQL = "dict AS (SELECT word, n FROM counts WHERE n >= (SELECT sum(n) FROM counts)::DOUBLE * 5e-5::DOUBLE)"
_LEMMA_SQL = (
    "tagged AS (SELECT DISTINCT tok AS word, " + _TAG_SQL + " AS cls FROM base_rows),\n"
    "rules AS (SELECT * FROM (VALUES " + ", ".join(
        f"({q.text(c)}, {q.text(s)}, {q.text(e)})" for c, s, e in DETACHMENT_RULES
    ) + ") v(cls, suffix, ending)),\n"
    "forms AS (SELECT word, cls, word AS form FROM tagged UNION ALL "
    "SELECT t.word, t.cls, left(t.word, len(t.word) - len(r.suffix)) || r.ending FROM tagged t "
    "JOIN rules r ON r.cls = t.cls AND ends_with(t.word, r.suffix) AND len(t.word) > len(r.suffix)),\n"
    "lemmas AS (SELECT f.word, f.cls, first(f.form ORDER BY len(f.form), f.form) AS lemma FROM forms f "
    "JOIN dict d ON d.word = f.form GROUP BY ALL)"
)


@query("lemmas", q.with_(*q.PRE, _BASE_ROWS, _COUNTS_SQL, _DICT_SQL, _LEMMA_SQL) + (
    "SELECT doc_id, string_agg(coalesce(lemma, tok), ' ' ORDER BY pos) AS tokens FROM base_rows "
    f"LEFT JOIN lemmas ON word = tok AND cls = {_TAG_SQL} GROUP BY doc_id"
))
def lemmas(spark, sf_dir):
    rows = corpus_tokens(spark, sf_dir)
    words = corpus_words(rows)
    tagged = words.select("word", tk.wordnet_class(fx.suffix_tag(F.col("word"))).alias("wn_class"))
    table = written(vocabulary.lemma_map(tagged, dictionary(words)), "lemmas")
    out = preprocess.lemmatize(rows, "doc_id", "tokens", table, fx.suffix_tag(F.col("token")))
    return out.select("doc_id", fx.joined_tokens("tokens"))


@query("stems", q.with_(*q.PRE, _BASE_ROWS, stem_sql.STEMS) + (
    "SELECT doc_id, string_agg(stem, ' ' ORDER BY pos) AS tokens FROM base_rows "
    "JOIN stems ON word = tok GROUP BY doc_id"
))
def stems(spark, sf_dir):
    rows = corpus_tokens(spark, sf_dir)
    mapping = written(vocabulary.stem_map(corpus_words(rows)), "stems")
    return substitute_tokens(rows, "doc_id", "tokens", mapping).select("doc_id", fx.joined_tokens("tokens"))


# DuckDB measures distances in bytes: the accented letters of the texts are written as capitals first.
@query("spell_map", q.with_(*q.PRE, _BASE_ROWS, _COUNTS_SQL, _DICT_SQL) + r""",
known AS (SELECT *, translate(word, 'éóèñüçäêößí', 'ABCDEFGHIJK') AS w FROM dict WHERE regexp_full_match(word, '\p{L}+')),
unknown AS (SELECT word, translate(word, 'éóèñüçäêößí', 'ABCDEFGHIJK') AS w FROM counts
            WHERE regexp_full_match(word, '\p{L}+') AND word NOT IN (SELECT word FROM dict)),
pairs AS (SELECT u.word AS token, k.word AS candidate, k.n,
          CASE WHEN damerau_levenshtein(u.w, k.w) = 1 THEN 1
               WHEN levenshtein(u.w, k.w) <= 2 THEN 2 END AS edits
          FROM unknown u JOIN known k ON abs(len(u.word) - len(k.word)) <= 2)
SELECT token, first(candidate ORDER BY edits, n DESC, candidate DESC) AS replacement
FROM pairs WHERE edits IS NOT NULL GROUP BY token""")
def spell_map(spark, sf_dir):
    words = corpus_words(fx.tokenized(spark, sf_dir))
    return vocabulary.spelling_map(words, dictionary(words))


@query("spell_corrected", ORACLES["spell_map"].replace(
    "SELECT token, first(", ", best AS (SELECT token, first("
) + """)
SELECT doc_id, string_agg(coalesce(replacement, tok), ' ' ORDER BY pos) AS tokens
FROM base_rows LEFT JOIN best ON token = tok GROUP BY doc_id""")
def spell_corrected(spark, sf_dir):
    rows = corpus_tokens(spark, sf_dir)
    words = corpus_words(rows)
    mapping = written(vocabulary.spelling_map(words, dictionary(words)), "spellings")
    return substitute_tokens(rows, "doc_id", "tokens", mapping).select("doc_id", fx.joined_tokens("tokens"))


@query("stopwords_kept", q.with_(*q.PRE) + (
    "SELECT doc_id, array_to_string(list_filter(toks, lambda t: t NOT IN "
    f"{q.words(STOPWORDS)} OR t IN {q.words(NEGATIONS)}), ' ') AS tokens FROM base"
))
def stopwords_kept(spark, sf_dir):
    rows = fx.tokenized(spark, sf_dir)
    return rows.select("doc_id", fx.joined_tokens(tk.drop_stopwords(F.col("tokens"))))


_SENT = (
    "sents AS (SELECT doc_id, list_transform(list_filter(list_transform(string_split_regex(text, "
    rf"'[.!?]+'), lambda s: regexp_replace(s, '^[{q.S}]+|[{q.S}]+$', '', 'g')), lambda s: s <> ''), "
    f"lambda s: len({q.tweet_list('s')})) AS sizes FROM raw_sq),\n"
    "stats AS (SELECT doc_id, coalesce(list_min(sizes), 0) AS mn, coalesce(list_max(sizes), 0) AS mx, "
    "coalesce(list_avg(sizes), 0) AS av FROM sents)"
)


@query("sentence_stats", q.with_(q.NOISY, q.RAW_SQ, _SENT) + (
    "SELECT doc_id, mn::BIGINT AS min_len, mx::BIGINT AS max_len, round(av, 6) AS mean_len FROM stats"
))
def sentence_stats(spark, sf_dir):
    rows = fx.noisy_tweets(spark, sf_dir).select("doc_id", tk.sentence_stats(F.col("text")).alias("s"))
    return rows.select(
        "doc_id", F.col("s.min").cast("long").alias("min_len"), F.col("s.max").cast("long").alias("max_len"),
        F.round("s.mean", 6).alias("mean_len"),
    )


@query("length_tokens", q.with_(q.NOISY, q.RAW_SQ, _SENT) + (
    "SELECT doc_id, 'MIN_LEN<' || (mn // 5) || '> MAX_LEN<' || (mx // 5) || '> MEAN_LEN<' || "
    "floor(av / 5)::BIGINT || '>' AS tokens FROM stats"
))
def length_tokens(spark, sf_dir):
    rows = fx.noisy_tweets(spark, sf_dir).withColumn("s", tk.sentence_stats(F.col("text")))
    return rows.select("doc_id", fx.joined_tokens(tk.length_tokens(F.col("s"))))


@query("pre_process", q.with_(*q.PRE, q.BIGRAMS, q.FULL) + (
    "SELECT doc_id, len(toks) AS n, array_to_string(toks, ' ') AS tokens FROM full_tokens"
))
def pre_process(spark, sf_dir):
    rows = fx.processed(spark, sf_dir)
    return rows.select("doc_id", F.size("tokens").cast("long").alias("n"), fx.joined_tokens("tokens"))


_IRREGULAR_SQL = (
    "odd(cls, word, lemma) AS (VALUES " + ", ".join(
        f"({q.text(c)}, {q.text(w)}, {q.text(lemma)})" for c, forms in IRREGULAR_LEMMAS.items() for w, lemma in forms.items()
    ) + ")"
)
# The tokens with lemmas take the place of the plain ones from here on.
_LEMMA_CTES = [
    *q.PRE, _BASE_ROWS, _COUNTS_SQL, _DICT_SQL, _LEMMA_SQL, _IRREGULAR_SQL,
    "lemma_base AS (SELECT doc_id, list(coalesce(o.lemma, l.lemma, tok) ORDER BY pos) AS toks FROM base_rows b "
    f"LEFT JOIN lemmas l ON l.word = tok AND l.cls = {_TAG_SQL} "
    f"LEFT JOIN odd o ON o.word = tok AND o.cls = {_TAG_SQL} GROUP BY doc_id)",
    q.BIGRAMS.replace("FROM base", "FROM lemma_base"), q.FULL,
]


def lemmatized_rows(spark, sf_dir, lay_out: bool = True, **options) -> DataFrame:
    """Whole pre-processing with lemmas of the corpus's own words, looked up inside the row.

    The words are counted first, so the tokens are written, and laid out while they are one row a document, unless
    they are dealt otherwise next.
    """
    rows = corpus_tokens(spark, sf_dir)
    words = corpus_words(rows)
    tagged = words.select("word", tk.wordnet_class(fx.suffix_tag(F.col("word"))).alias("wn_class"))
    table = written(vocabulary.lemma_map(tagged, dictionary(words), IRREGULAR_LEMMAS), "lemmas")
    literals = vocabulary.lemma_literals(table)
    given = {"lemmas": table, "tags": fx.suffix_tag(F.col("token"))} if literals is None else {"lemmas": literals}
    return preprocess.finish(laid_out(rows, "doc_id") if lay_out else rows, "doc_id", "tokens", fx.LEXICON, **given, **options)


@query("pre_process_lemmas", q.with_(*_LEMMA_CTES) + (
    "SELECT doc_id, len(toks) AS n, array_to_string(toks, ' ') AS tokens FROM full_tokens"
))
def pre_process_lemmas(spark, sf_dir):
    rows = lemmatized_rows(spark, sf_dir)
    return rows.select("doc_id", F.size("tokens").cast("long").alias("n"), fx.joined_tokens("tokens"))


@query("tfidf_lemmas", q.with_(*_LEMMA_CTES, q.TERMS, q.tfidf("weights", "terms")) + (
    "SELECT doc_id, term, round(weight, 6) AS weight FROM weights"
))
def tfidf_lemmas(spark, sf_dir):
    rows = lemmatized_rows(spark, sf_dir, lay_out=False, add_bigrams=False, add_lexicon_tokens=False)
    counts = _word_pieces(spark, sf_dir, rows)
    weights = terms.tfidf(counts, "doc_id", _n_docs(spark, sf_dir))
    return weights.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query("bigrams", q.with_(*q.PRE, q.BIGRAMS) + (
    "SELECT doc_id, len(pairs) AS n, array_to_string(pairs, '|') AS grams FROM grams"
))
def bigrams(spark, sf_dir):
    rows = fx.tokenized(spark, sf_dir).select("doc_id", tk.token_ngrams(F.col("tokens"), 2).alias("g"))
    return rows.select("doc_id", F.size("g").cast("long").alias("n"), F.array_join("g", "|").alias("grams"))


@query("trigrams", q.with_(*q.PRE, _BASE_ROWS) + (
    "SELECT doc_id, count(c) AS n, string_agg(a || ' ' || b || ' ' || c, '|' ORDER BY pos) AS grams FROM "
    "(SELECT doc_id, pos, tok AS a, lead(tok) OVER w AS b, lead(tok, 2) OVER w AS c FROM base_rows "
    "WINDOW w AS (PARTITION BY doc_id ORDER BY pos)) WHERE c IS NOT NULL GROUP BY doc_id"
))
def trigrams(spark, sf_dir):
    rows = fx.tokenized(spark, sf_dir).select("doc_id", tk.token_ngrams(F.col("tokens"), 3).alias("g"))
    return rows.select("doc_id", F.size("g").cast("long").alias("n"), F.array_join("g", "|").alias("grams"))


@query("char_ngrams", q.with_(*q.CHAR_CTES) + (
    "SELECT term, sum(tf)::BIGINT AS n, count(*) AS df FROM grams_tf GROUP BY term"
))
def char_ngrams(spark, sf_dir):
    return char_term_totals(spark, sf_dir)


# ---------------------------------------------------------------- sources

@query("tsv_scan", q.with_(q.NOISY, q.LABELLED) + "SELECT label, text FROM labelled")
def tsv_scan(spark, sf_dir):
    path = fresh_path(spark, "labelled-tsv")
    rows = fx.noisy_labelled(spark, sf_dir).withColumnRenamed("doc_id", "id")
    src.write_labelled(rows, path)
    return src.read_labelled(spark, path)


@query("tsv_pieces", q.with_(q.NOISY, q.LABELLED) + "SELECT doc_id AS id, label, text FROM labelled")
def tsv_pieces(spark, sf_dir):
    path = fresh_path(spark, "labelled-tsv")
    src.write_labelled(fx.noisy_labelled(spark, sf_dir).withColumnRenamed("doc_id", "id"), path)
    return src.read_labelled_pieces(spark, path)


_WORD_LINE_SQL = (
    rf"list_words AS (SELECT DISTINCT l.quality, unnest(regexp_extract_all(d.text, '[^{q.S}]+')) AS w "
    "FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"
)


@query("lexicon_scan", q.with_(_WORD_LINE_SQL) + (
    "SELECT DISTINCT lower(w) AS word, CASE quality WHEN 1 THEN 'pos' ELSE 'neg' END AS polarity "
    "FROM list_words WHERE w NOT LIKE ';%' AND w NOT LIKE 'd%'"
))
def lexicon_scan(spark, sf_dir):
    """Word lists written from the labelled documents, with comments, blanks and padding, read back."""
    docs = fx.table(spark, sf_dir, "documents").join(fx.table(spark, sf_dir, "labels"), "doc_id")
    words = element_rows(docs, ["quality"], tx.space_words(F.col("text")), "w")
    line = F.when(F.col("w").startswith("d"), F.concat(F.lit("; "), "w")).otherwise(
        F.when(F.length("w") % 2 == 0, F.concat(F.lit("  "), "w", F.lit(" "))).otherwise(F.col("w"))
    )
    lines = words.select("quality", F.explode(F.array(line, F.lit(" "))).alias("line")).distinct()
    paths = {side: fresh_path(spark, f"lexicon-{side}") for side in ("pos", "neg")}
    lex_src.write_word_list(lines.where(F.col("quality") == 1), paths["pos"])
    lex_src.write_word_list(lines.where(F.col("quality") == 0), paths["neg"])
    return lex_src.read_lexicon(spark, paths["pos"], paths["neg"])


# ---------------------------------------------------------------- lexicon and term statistics

@query("lexicon_hits", q.with_(*q.PRE) + (
    f"SELECT doc_id, {q.hits('toks', 'pos')}::INT AS pos_hits, {q.hits('toks', 'neg')}::INT AS neg_hits FROM base"
))
def lexicon_hits(spark, sf_dir):
    hits = lx.with_hits(fx.tokenized(spark, sf_dir), "doc_id", "tokens", fx.LEXICON)
    return hits.select("doc_id", "pos_hits", "neg_hits")


@query("lexicon_join_hits", q.with_(*q.PRE, _BASE_ROWS, _COUNTS_SQL) + """,
lex AS (SELECT word, CASE WHEN len(word) % 2 = 0 THEN 1 ELSE 0 END AS is_pos FROM counts WHERE len(word) > 3)
SELECT b.doc_id, coalesce(sum(is_pos), 0)::INT AS pos_hits, coalesce(sum(1 - is_pos), 0)::INT AS neg_hits
FROM base_rows b LEFT JOIN lex ON word = tok GROUP BY b.doc_id""")
def lexicon_join_hits(spark, sf_dir):
    """A lexicon as large as the vocabulary: words of even length are positive, odd ones negative."""
    rows = corpus_tokens(spark, sf_dir)
    words = corpus_words(rows).where(F.length("word") > 3)
    even = F.length("word") % 2 == 0
    lexicon = words.select("word", F.when(even, "pos").otherwise("neg").alias("polarity"))
    return lx.join_hits(rows, "doc_id", "tokens", lexicon).select("doc_id", "pos_hits", "neg_hits")


@query("lexicon_tokens", q.with_(*q.PRE, q.BIGRAMS, q.FULL) + (
    "SELECT doc_id, array_to_string(list_filter(toks, lambda t: t IN ('LEX_POS', 'LEX_NEG')), ' ') "
    "AS tokens FROM full_tokens"
))
def lexicon_tokens(spark, sf_dir):
    rows = fx.processed(spark, sf_dir, add_bigrams=False, add_lexicon_tokens=False)
    hits = lx.with_hits(rows, "doc_id", "tokens", fx.LEXICON)
    return hits.select("doc_id", fx.joined_tokens(tk.lexicon_markers(F.col("pos_hits"), F.col("neg_hits"))))


def word_term_counts(spark, sf_dir) -> DataFrame:
    rows = fx.processed_by_id(spark, sf_dir, lowercase_first=True)
    return terms.term_counts(rows, "doc_id", "tokens")


def char_term_counts(spark, sf_dir) -> DataFrame:
    docs = fx.noisy_tweets_by_id(spark, sf_dir)
    return terms.char_gram_counts(docs, "doc_id", F.col("text"))


def _text_bytes(spark, sf_dir) -> int:
    """The bytes of all texts, by which counts in pieces choose the number of their buckets."""
    return fx.table(spark, sf_dir, "documents").agg(F.sum(F.octet_length("text"))).first()[0] or 0


def _word_pieces(spark, sf_dir, rows: DataFrame, keep: bool = False) -> Pieces:
    """Counts of the tokens of ``rows``, of their bigrams and of the lexicon markers."""
    marked = preprocess.with_markers(rows, "doc_id", "tokens", fx.LEXICON, "markers")
    return terms.term_piece_counts(marked, "doc_id", "tokens", _text_bytes(spark, sf_dir), "markers", pairs=True, keep=keep)


def word_term_pieces(spark, sf_dir, keep: bool = False) -> Pieces:
    rows = fx.processed(spark, sf_dir, lowercase_first=True, add_bigrams=False, add_lexicon_tokens=False)
    return _word_pieces(spark, sf_dir, rows, keep)


def char_term_pieces(spark, sf_dir, keep: bool = False) -> Pieces:
    docs = fx.noisy_tweets(spark, sf_dir)
    return terms.char_gram_piece_counts(docs, "doc_id", F.col("text"), _text_bytes(spark, sf_dir), keep)


def char_term_totals(spark, sf_dir) -> DataFrame:
    docs = fx.noisy_tweets_by_id(spark, sf_dir)
    return terms.char_gram_totals(docs, "doc_id", F.col("text"))


@query("term_counts", q.with_(*q.TERM_CTES) + "SELECT doc_id, term, tf FROM terms")
def term_counts(spark, sf_dir):
    return word_term_counts(spark, sf_dir)


@query("bag_of_words", q.with_(*q.TERM_CTES) + (
    "SELECT doc_id, count(*) AS n_terms, sum(tf)::BIGINT AS n_tokens, max(tf)::INT AS top FROM terms GROUP BY doc_id"
))
def bag_of_words(spark, sf_dir):
    bags = terms.bag_maps(word_term_counts(spark, sf_dir), "doc_id")
    counts = F.map_values("bag")
    return bags.select(
        "doc_id", F.size("bag").cast("long").alias("n_terms"),
        F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_tokens"),
        F.array_max(counts).alias("top"),
    )


def _block_frequency(spark, sf_dir) -> DataFrame:
    """block, term, df of both blocks; character grams are added up by piece, not written by document."""
    return terms.feature_names({
        "word": word_term_counts(spark, sf_dir), "char": char_term_totals(spark, sf_dir),
    }).select("block", "term", "df")


@query("doc_freq", q.with_(*q.TERM_CTES, *q.CHAR_CTES) + (
    "SELECT 'word' AS block, term, count(*) AS df FROM terms GROUP BY term UNION ALL "
    "SELECT 'char', term, count(*) FROM grams_tf GROUP BY term"
))
def doc_freq(spark, sf_dir):
    return _block_frequency(spark, sf_dir)


def _n_docs(spark, sf_dir) -> int:
    return fx.table(spark, sf_dir, "documents").count()


@query("tfidf_word", q.with_(*q.TERM_CTES, q.tfidf("weights", "terms")) + (
    "SELECT doc_id, term, round(weight, 6) AS weight FROM weights"
))
def tfidf_word(spark, sf_dir):
    weights = terms.tfidf(word_term_pieces(spark, sf_dir), "doc_id", _n_docs(spark, sf_dir))
    return weights.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query("tfidf_char", q.with_(*q.CHAR_CTES, q.tfidf("weights", "grams_tf")) + (
    "SELECT term, df, round(sum(weight), 6) AS weight FROM weights GROUP BY ALL"
))
def tfidf_char(spark, sf_dir):
    weights = terms.tfidf_by_term(char_term_pieces(spark, sf_dir), _n_docs(spark, sf_dir))
    return weights.select("term", "df", F.round("weight", 6).alias("weight"))


@query("tfidf_union", q.with_(
    *q.TERM_CTES, *q.CHAR_CTES, q.tfidf("ww", "terms"), q.tfidf("cw", "grams_tf")
) + (
    "SELECT doc_id, block, count(*) AS n_terms, round(sum(weight), 6) AS total, round(max(weight), 6) AS top "
    "FROM (SELECT 'word' AS block, doc_id, weight FROM ww UNION ALL SELECT 'char', doc_id, weight FROM cw) "
    "GROUP BY ALL"
))
def tfidf_union(spark, sf_dir):
    n = _n_docs(spark, sf_dir)
    both = terms.feature_union({
        "word": terms.tfidf(word_term_pieces(spark, sf_dir), "doc_id", n, by_document=True, only=("weight",)),
        "char": terms.tfidf(char_term_pieces(spark, sf_dir), "doc_id", n, by_document=True, only=("weight",)),
    })
    total = F.aggregate("weight", F.lit(0.0), lambda a, x: a + x)
    return both.select(
        "doc_id", "block", F.size("weight").cast("long").alias("n_terms"), F.round(total, 6).alias("total"),
        F.round(F.array_max("weight"), 6).alias("top"),
    )


def _block_counts(spark, sf_dir) -> dict[str, Pieces]:
    return {"word": word_term_pieces(spark, sf_dir, keep=True), "char": char_term_pieces(spark, sf_dir, keep=True)}


_INDEXED_SQL = (
    "indexed AS (SELECT 'word' AS block, term, df, row_number() OVER (ORDER BY term) - 1 AS index FROM ww_df "
    "UNION ALL SELECT 'char', term, df, row_number() OVER (ORDER BY term) - 1 FROM cw_df)"
)


@query("feature_names", q.with_(
    *q.TERM_CTES, *q.CHAR_CTES, q.tfidf("ww", "terms"), q.tfidf("cw", "grams_tf"), _INDEXED_SQL
) + (
    "SELECT block, index, term, df, round(ln((1 + n) / (1 + df)) + 1, 6) AS idf "
    "FROM indexed, (SELECT count(*)::DOUBLE AS n FROM documents)"
))
def feature_names(spark, sf_dir):
    """The exact vocabulary: every term of both blocks with its place in the vector."""
    names = exact.dictionary(_block_frequency(spark, sf_dir))[0]
    return names.select("block", "index", "term", "df", F.round(terms.idf(F.col("df"), _n_docs(spark, sf_dir)), 6).alias("idf"))


@query("tfidf_vectors", q.with_(
    *q.TERM_CTES, *q.CHAR_CTES, q.tfidf("ww", "terms"), q.tfidf("cw", "grams_tf"), _INDEXED_SQL
) + (
    "SELECT doc_id, block, count(*) AS n, min(index) AS first_index, max(index) AS last_index, "
    "round(sum(weight), 6) AS total, round(sum(weight * (index % 1009)), 3) AS moment "
    "FROM (SELECT 'word' AS block, doc_id, term, weight FROM ww UNION ALL SELECT 'char', doc_id, term, weight FROM cw) "
    "JOIN indexed USING (block, term) GROUP BY ALL"
))
def tfidf_vectors(spark, sf_dir):
    """Sparse vectors over the exact vocabulary, seen by sums over their entries."""
    counts = _block_counts(spark, sf_dir)
    fitted, sizes = exact.dictionary(terms.feature_names(counts))
    entries = exact.tfidf_entries(counts, fitted, "doc_id", _n_docs(spark, sf_dir))
    docs = fx.table(spark, sf_dir, "documents").select("doc_id")
    vectors = exact.sparse_vectors(entries.withColumnRenamed("weight", "value"), docs, "doc_id", sizes)
    back = exact.vector_entries(vectors, "doc_id", list(sizes))
    return back.groupBy("doc_id", "block").agg(
        F.count(F.lit(1)).alias("n"), F.min("index").cast("long").alias("first_index"),
        F.max("index").cast("long").alias("last_index"), F.round(F.sum("value"), 6).alias("total"),
        F.round(F.sum(F.col("value") * (F.col("index") % 1009)), 3).alias("moment"))


TOP_FEATURES = 200


@query("chi2_topk", q.with_(*q.TERM_CTES, q.LABELLED, q.tfidf("weights", "terms")) + f""",
per_class AS (SELECT w.term, l.label, sum(w.weight) AS obs FROM weights w JOIN labelled l USING (doc_id)
              GROUP BY ALL),
share AS (SELECT label, count(*) / sum(count(*)) OVER () AS share FROM labelled GROUP BY label),
grid AS (SELECT t.term, t.total, s.label, s.share FROM
         (SELECT term, sum(obs) AS total FROM per_class GROUP BY term) t, share s)
SELECT g.term, round(sum(pow(coalesce(p.obs, 0) - g.share * g.total, 2) / (g.share * g.total)), 6) AS chi2
FROM grid g LEFT JOIN per_class p ON p.term = g.term AND p.label = g.label
GROUP BY g.term ORDER BY chi2 DESC, g.term LIMIT {TOP_FEATURES}""")
def chi2_topk(spark, sf_dir):
    labels = fx.noisy_labelled(spark, sf_dir).select("doc_id", "label")
    weights = terms.tfidf_by_term(word_term_pieces(spark, sf_dir), _n_docs(spark, sf_dir), labels)
    return terms.chi2_top(weights, labels, "doc_id", TOP_FEATURES)


# ---------------------------------------------------------------- positions, splits, folds

@query("row_and_label_counts", q.with_(q.NOISY, q.LABELLED) + (
    "SELECT label, count(*) AS n, sum(count(*)) OVER ()::BIGINT AS total FROM labelled GROUP BY label"
))
def row_and_label_counts(spark, sf_dir):
    counts = fx.noisy_labelled(spark, sf_dir).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("total", counts.agg(F.sum("n")).scalar())


@query("ordinal", q.with_(q.placed("placed", "documents")) + "SELECT doc_id, ord FROM placed")
def ordinal_rows(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents").select("doc_id")
    return ordinal.ordinal(docs, "doc_id", buckets=16)[0]


@query("ordinal_turns", "SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id DESC, turn) - 1 AS ord FROM conversations")
def ordinal_turns(spark, sf_dir):
    """Positions by a key of two columns, one of them descending."""
    turns = fx.table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return ordinal.positions(turns, [F.desc("conv_id"), "turn"])[0]


@query("ordinal_text", "SELECT text, row_number() OVER (ORDER BY text) - 1 AS ord FROM (SELECT DISTINCT text FROM documents)")
def ordinal_text(spark, sf_dir):
    """Positions by a text key."""
    return ordinal.positions(fx.table(spark, sf_dir, "documents").select("text").distinct(), ["text"])[0]


@query("holdout_split", q.with_(q.NOISY, q.LABELLED, q.placed("placed", "labelled")) + (
    "SELECT doc_id, label, CASE WHEN ord < floor(0.8 * total) THEN 'train' ELSE 'test' END AS part FROM placed"
))
def holdout_split(spark, sf_dir):
    rows, total = ordinal.ordinal(fx.noisy_labelled(spark, sf_dir).select("doc_id", "label"), "doc_id")
    return rows.select(
        "doc_id", "label", F.when(ordinal.is_train(total, 0.8), "train").otherwise("test").alias("part")
    )


@query("kfold_assign", q.with_(q.NOISY, q.LABELLED, q.placed("placed", "labelled")) + (
    f"SELECT doc_id, (ord // (total // {fx.FOLDS} + 1))::INT AS fold, "
    f"CASE WHEN ord < total - 1 THEN (ord // (total // {fx.FOLDS} + 1))::INT ELSE -1 END AS legacy_fold FROM placed"
))
def kfold_assign(spark, sf_dir):
    rows, total = ordinal.ordinal(fx.noisy_labelled(spark, sf_dir).select("doc_id"), "doc_id")
    return rows.select(
        "doc_id", ordinal.fold_id(total, fx.FOLDS).alias("fold"),
        F.coalesce(ordinal.fold_id(total, fx.FOLDS, legacy_tail=True), F.lit(-1)).alias("legacy_fold"),
    )


@query("train_rows", q.with_(q.NOISY, q.LABELLED, q.placed("placed", "labelled")) + f""",
f AS (SELECT doc_id, (ord // (total // {fx.FOLDS} + 1))::INT AS fold FROM placed)
SELECT a.fold, count(*) AS n_train, sum(b.doc_id)::BIGINT AS id_sum
FROM (SELECT DISTINCT fold FROM f) a JOIN f b ON b.fold <> a.fold GROUP BY a.fold""")
def train_rows(spark, sf_dir):
    """Rows outside each test fold: a predicate on the fold, one per fold."""
    rows, total = ordinal.ordinal(fx.noisy_labelled(spark, sf_dir).select("doc_id"), "doc_id")
    folds = written(rows.select("doc_id", ordinal.fold_id(total, fx.FOLDS).alias("fold")), "folds", "fold")
    parts = [
        folds.where(F.col("fold") != k).agg(
            F.lit(k).alias("fold"), F.count(F.lit(1)).alias("n_train"), F.sum("doc_id").alias("id_sum")
        )
        for k in range(-(-total // ordinal.fold_width(total, fx.FOLDS)))
    ]
    return vocabulary.union_all(parts)


# ---------------------------------------------------------------- evaluation

@query("outcomes", q.with_(*q.RULE) + (
    "SELECT id, fold::INT AS fold, \"true\", pred, CASE WHEN \"true\" = pred THEN 'T' ELSE 'F' END || "
    "CASE pred WHEN 'positive' THEN 'P' ELSE 'N' END AS outcome FROM rule"
))
def outcomes(spark, sf_dir):
    return metrics.with_outcome(fx.rule_predictions(spark, sf_dir)).select("id", "fold", "true", "pred", "outcome")


@query("outcome_summary", q.with_(*q.RULE) + (
    "SELECT fold::INT AS fold, CASE WHEN \"true\" = pred THEN 'T' ELSE 'F' END || CASE pred WHEN 'positive' THEN 'P' "
    "ELSE 'N' END AS outcome, count(*) AS n, min(id) AS first_id, max(id) AS last_id FROM rule GROUP BY ALL"
))
def outcome_summary(spark, sf_dir):
    return metrics.outcome_summary(fx.rule_predictions(spark, sf_dir))


@query("fold_error_log", q.with_(*q.RULE) + (
    "SELECT fold::INT AS fold, CASE WHEN \"true\" = pred THEN 'T' ELSE 'F' END || CASE pred WHEN 'positive' THEN 'P' "
    "ELSE 'N' END AS outcome, id, \"true\", pred, text FROM rule"
))
def fold_error_log(spark, sf_dir):
    path = fresh_path(spark, "error-log")
    src.write_error_log(fx.rule_predictions(spark, sf_dir), path)
    return src.read_error_log(spark, path).select("fold", "outcome", "id", "true", "pred", "text")


@query("confusion", q.with_(*q.RULE) + """,
names(label, pos) AS (VALUES ('positive', 0), ('negative', 1))
SELECT t.pos::INT AS true_pos, p.pos::INT AS pred_pos, t.label AS "true", p.label AS pred, count(r.id) AS n
FROM names t CROSS JOIN names p LEFT JOIN rule r ON r."true" = t.label AND r.pred = p.label GROUP BY ALL""")
def confusion(spark, sf_dir):
    return metrics.confusion(fx.rule_predictions(spark, sf_dir), ["positive", "negative"])


@query("weighted_prf", q.with_(*q.RULE, q.PRF) + (
    "SELECT fold::INT AS fold, round(precision, 6) AS precision, round(recall, 6) AS recall, "
    "round(f1, 6) AS f1 FROM prf"
))
def weighted_prf(spark, sf_dir):
    scores = metrics.weighted_prf(fx.rule_predictions(spark, sf_dir))
    return scores.select("fold", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query("fold_mean", q.with_(*q.RULE, q.PRF) + (
    "SELECT round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round(avg(f1), 6) AS f1, "
    "(1 = 1) AS support_undefined FROM prf"
))
def fold_mean(spark, sf_dir):
    mean = metrics.fold_mean(metrics.weighted_prf(fx.rule_predictions(spark, sf_dir)))
    return mean.select(
        *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")],
        F.isnan("support").alias("support_undefined"),
    )


@query("class_weights", q.with_(q.NOISY, q.LABELLED) + (
    "SELECT label, count(*) AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight "
    "FROM labelled GROUP BY label"
))
def class_weights(spark, sf_dir):
    weights = metrics.class_weights(fx.noisy_labelled(spark, sf_dir))
    return weights.select("label", "n", F.round("weight", 6).alias("weight"))


# ---------------------------------------------------------------- models

@query("embed_batch", q.with_(q.NOISY) + """,
points AS (SELECT doc_id, unicode(unnest(string_split(text, ''))) % 64 AS cell FROM noisy),
counts AS (SELECT doc_id, cell, count(*)::DOUBLE AS n FROM points GROUP BY ALL),
unit AS (SELECT doc_id, cell, (n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)))::FLOAT::DOUBLE AS v FROM counts)
SELECT doc_id, 64 AS dim, round(max(v), 4) AS top, round(sum(cell * v), 2) AS moment
FROM unit GROUP BY doc_id""")
def embed_batch(spark, sf_dir):
    """Vectors of an encoder that SQL can recompute, seen by their largest component and first moment."""
    vectors = fx.noisy_tweets(spark, sf_dir).select(
        "doc_id", embed(F.col("text"), character_profile(64), batch_size=64, preprocess=None).alias("v")
    )
    weighted = F.transform("v", lambda x, i: x.cast("double") * i)
    return vectors.select(
        "doc_id", F.size("v").alias("dim"), F.round(F.array_max("v").cast("double"), 4).alias("top"),
        F.round(F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x), 2).alias("moment"))


_VOWELS = "regexp_replace(lower(text), '[^aeiou]+', '')"


@query("hook_tokens", q.with_(q.NOISY) + (
    "SELECT doc_id, array_to_string(list_filter(string_split(lower(text), ' '), lambda w: length(w) > 3), ' ') AS tokens "
    "FROM noisy"
))
def hook_tokens(spark, sf_dir):
    """Tokens by a user's SQL expression, from a stage that was saved and loaded."""
    path = fresh_path(spark, "stage")
    WordTerms(tokenizer="filter(split(lower(text), ' '), w -> length(w) > 3)").save(path)
    return WordTerms.load(path).transform(fx.noisy_tweets(spark, sf_dir)).select("doc_id", fx.joined_tokens("words"))


@query("hook_embedding", q.with_(q.NOISY) + """,
points AS (SELECT doc_id, unicode(unnest(string_split(regexp_replace(lower(text), '[^aeiou]+', '', 'g'), ''))) % 64 AS cell
FROM noisy),
counts AS (SELECT doc_id, cell, count(*)::DOUBLE AS n FROM points GROUP BY ALL)
SELECT doc_id, 64 AS dim, round(max(n) / sqrt(sum(n * n)), 4) AS top FROM counts GROUP BY doc_id""")
def hook_embedding(spark, sf_dir):
    """Vectors of the vowels of a text: encoder and preparation come from a stage that was saved and loaded."""
    path = fresh_path(spark, "stage")
    Embedding(Encoder(character_profile, dim=64), batch_size=64, preprocess=_VOWELS).save(path)
    vectors = Embedding.load(path).transform(fx.noisy_tweets(spark, sf_dir))
    values = vectors.select("doc_id", vector_to_array("embedding").alias("v"))
    return values.select("doc_id", F.size("v").alias("dim"), F.round(F.array_max("v"), 4).alias("top"))


FOLDS = 10


def _fitted(spark, sf_dir, architecture: str):
    encoder = hashed_projection(64) if architecture == "BERTweet" else None
    rows = fx.noisy_labelled(spark, sf_dir)
    return model.train(rows, architecture, fx.LEXICON, encoder)


@query("svm_base")
def svm_base(spark, sf_dir):
    rows = fx.noisy_labelled(spark, sf_dir)
    return model.score(_fitted(spark, sf_dir, "base"), rows).select("doc_id", "label", "pred")


@query("svm_hybrid")
def svm_hybrid(spark, sf_dir):
    rows = fx.noisy_labelled(spark, sf_dir)
    return model.score(_fitted(spark, sf_dir, "BERTweet"), rows).select("doc_id", "label", "pred")


@query("score_texts")
def score_texts(spark, sf_dir):
    texts = fx.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return model.score(_fitted(spark, sf_dir, "base"), texts).select("conv_id", "turn", "pred")


@query("holdout_eval")
def holdout_eval(spark, sf_dir):
    rows = fx.noisy_labelled(spark, sf_dir)
    predictions = evaluate.holdout(rows, "doc_id", lexicon=fx.LEXICON)[1]
    return metrics.weighted_prf(predictions).select("precision", "recall", "f1")


@query("kfold_eval")
def kfold_eval(spark, sf_dir):
    rows = fx.noisy_labelled(spark, sf_dir)
    predictions = evaluate.cross_validate(rows, "doc_id", folds=FOLDS, lexicon=fx.LEXICON)
    return evaluate.cv_scores(predictions).select("precision", "recall", "f1")
