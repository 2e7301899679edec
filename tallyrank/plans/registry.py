"""Named queries over the test tables: one per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrank.functions import text as text_fn
from tallyrank.functions import weights
from tallyrank.operators import corpus, lemma, profile
from tallyrank.operators.evaluate import evaluate, ndcg_per_query, predict_models
from tallyrank.operators.index import CorpusIndex
from tallyrank.operators.rankers import BM25Ranker, TfidfRanker, rank_variants, score_variants
from tallyrank.operators.sampling import sample_rows
from tallyrank.plans import experiment, judgements
from tallyrank.plans.dataset import build_dataset, vocabulary
from tallyrank.sources import tables
from tallyrank.sources.scratch import materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

ONE_QUERY = "That heron and the onesen, the erblest"
TIES = ["product_id", "line_no", "esci_label"]

_indexes: dict[tuple[str, str, str], CorpusIndex] = {}
_tables: dict[tuple[str, str, str], DataFrame] = {}
_queries: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _queries[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_queries)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "text")


def _benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of the benchmark as written, punctuation included."""
    words = _benchmark(spark, sf_dir).select(
        F.explode(text_fn.whitespace_tokens("query")).alias("term")
    )
    return words.distinct()


def _index(spark: SparkSession, sf_dir: str, kind: str) -> CorpusIndex:
    """Fit once per session and data set, then reuse: the index is a written table.

    The table that only ``rank`` reads comes with the first query that ranks (``_ranked``).
    """
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _indexes:
        if kind == "judgements":
            train = _processed_table(spark, sf_dir).where("split = 'train'")
            index = experiment.fit(train, scratch_path(spark, "judgements"))
        elif kind == "judgements-lemmas":
            train = _processed_table(spark, sf_dir, lemmas=True).where("split = 'train'")
            lemmas = _judgement_lemmas(spark, sf_dir)
            index = experiment.fit(train, scratch_path(spark, "judgements"), lemmas=lemmas)
        elif kind == "lemmas":
            forms = _index(spark, sf_dir, "normalize").terms.select(F.col("term").alias("form"))
            lemmas = materialize(lemma.corpus_lemma_map(forms), "lemmas")
            index = CorpusIndex.fit(
                _documents(spark, sf_dir), lemmas=lemmas, passes=2, ranked=False
            )
        else:
            index = CorpusIndex.fit(_documents(spark, sf_dir), tokenizer=kind, ranked=False)
        _indexes[key] = index
    return _indexes[key]


def _ranked(spark: SparkSession, sf_dir: str, kind: str) -> CorpusIndex:
    return _index(spark, sf_dir, kind).add_segments()


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# -- text ------------------------------------------------------------------------------


@query
def tokens_normalize(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    tokens = docs.select("doc_id", text_fn.raw_tokens("text").alias("t"))
    return tokens.select(
        "doc_id", F.size("t").cast("long").alias("n_tokens"), text_fn.join_tokens("t").alias("normalized")
    )


@query
def tokens_whitespace(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    tokens = docs.select("doc_id", text_fn.whitespace_tokens("text").alias("t"))
    return tokens.select(
        "doc_id", F.size("t").cast("long").alias("n_tokens"), text_fn.join_tokens("t").alias("words")
    )


@query
def clean_pages(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "html")
    return pages.select("page_id", text_fn.clean_text("html", unescape=False).alias("clean"))


@query
def clean_pages_unescaped(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "html")
    return pages.select("page_id", text_fn.clean_text("html").alias("clean"))


# -- corpus statistics -----------------------------------------------------------------


@query
def corpus_stats(spark, sf_dir):
    return _rounded(_index(spark, sf_dir, "normalize").stats, 6, "avgdl")


@query
def doc_lengths(spark, sf_dir):
    return _index(spark, sf_dir, "normalize").doc_stats


@query
def postings(spark, sf_dir):
    return _index(spark, sf_dir, "normalize").postings


@query
def term_df_idf(spark, sf_dir):
    idfs = ["idf_standard", "idf_smoothed", "idf_bm25"]
    terms = _index(spark, sf_dir, "normalize").terms.select("term", "df", *idfs)
    return _rounded(terms, 6, *idfs)


@query
def collection_tf(spark, sf_dir):
    index = _index(spark, sf_dir, "normalize")
    counted = corpus.collection_frequency(index.terms, index.stats)
    return _rounded(counted, 10, "frequency")


@query
def collection_lookup(spark, sf_dir):
    index = _index(spark, sf_dir, "normalize")
    found = corpus.collection_lookup(index.terms, index.stats, _words(spark, sf_dir))
    return _rounded(found, 10, "frequency")


@query
def idf_lookup(spark, sf_dir):
    found = _index(spark, sf_dir, "normalize").idf_lookup(_words(spark, sf_dir))
    return _rounded(found, 6, "idf_standard", "idf_smoothed", "idf_bm25")


@query
def idf_curve(spark, sf_dir):
    return _rounded(
        corpus.idf_curve(_documents(spark, sf_dir)), 6, "idf_standard", "idf_smoothed"
    )


@query
def vocabulary_sorted(spark, sf_dir):
    terms = _index(spark, sf_dir, "normalize").terms.select("term")
    return corpus.with_dense_index(terms, ["term"])


@query
def vocabulary_first_seen(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    first = corpus.first_occurrence(docs, text_fn.whitespace_tokens("text"))
    return corpus.with_dense_index(first, ["doc_id", "place"]).select("term", "term_index")


@query
def corpus_dedup(spark, sf_dir):
    return corpus.distinct_documents(_documents(spark, sf_dir), "doc_id", "text")


@query
def lemma_map_corpus(spark, sf_dir):
    forms = _index(spark, sf_dir, "normalize").terms.select(F.col("term").alias("form"))
    return lemma.corpus_lemma_map(forms)


# -- TF-IDF ----------------------------------------------------------------------------


def _weights_query(tf_method: str, idf_method: str) -> Query:
    def run(spark, sf_dir):
        index = _index(spark, sf_dir, "normalize")
        return _rounded(index.weights(tf_method, idf_method), 6, "weight")

    return run


for _tf in weights.TF_METHODS:
    for _idf in weights.IDF_METHODS:
        _queries[f"tfidf_weights_{_tf}_{_idf}"] = _weights_query(_tf, _idf)


@query
def tfidf_weights_whitespace(spark, sf_dir):
    return _rounded(_index(spark, sf_dir, "whitespace").weights(), 6, "weight")


@query
def tfidf_score(spark, sf_dir):
    ranker = TfidfRanker(_index(spark, sf_dir, "normalize"))
    return _rounded(ranker.score(_benchmark(spark, sf_dir)), 4, "score")


@query
def tfidf_topk(spark, sf_dir):
    return TfidfRanker(_ranked(spark, sf_dir, "normalize")).rank(_benchmark(spark, sf_dir))


@query
def tfidf_topk_text(spark, sf_dir):
    ranker = TfidfRanker(_ranked(spark, sf_dir, "normalize"))
    return ranker.rank(_benchmark(spark, sf_dir), texts=_documents(spark, sf_dir))


@query
def tfidf_topk_padded(spark, sf_dir):
    ranker = TfidfRanker(_ranked(spark, sf_dir, "normalize"), "log_scaled", "standard")
    return ranker.rank(_benchmark(spark, sf_dir), 200, pad_zero=True)


@query
def tfidf_search_repeat(spark, sf_dir):
    ranker = TfidfRanker(_ranked(spark, sf_dir, "whitespace"), count_repeats=True)
    return ranker.rank(_benchmark(spark, sf_dir), 3, pad_zero=True, ties="asc")


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a candidate of one benchmark query."""
    n_queries = _table(spark, sf_dir, "benchmark").count()
    return _documents(spark, sf_dir).withColumn("query_id", F.col("doc_id") % n_queries)


def _scored(ranker, spark, sf_dir) -> DataFrame:
    scored = ranker.score_docs(_candidates(spark, sf_dir), _benchmark(spark, sf_dir))
    return _rounded(scored.select("query_id", "doc_id", "predicted_score"), 4, "predicted_score")


@query
def tfidf_score_docs(spark, sf_dir):
    return _scored(TfidfRanker(_index(spark, sf_dir, "normalize")), spark, sf_dir)


# -- BM25+ -----------------------------------------------------------------------------


@query
def bm25_score(spark, sf_dir):
    ranker = BM25Ranker(_index(spark, sf_dir, "normalize"))
    return _rounded(ranker.score(_benchmark(spark, sf_dir)), 4, "score")


@query
def bm25_topk(spark, sf_dir):
    return BM25Ranker(_ranked(spark, sf_dir, "normalize")).rank(_benchmark(spark, sf_dir))


@query
def bm25_topk_text(spark, sf_dir):
    ranker = BM25Ranker(_ranked(spark, sf_dir, "normalize"))
    return ranker.rank(_benchmark(spark, sf_dir), texts=_documents(spark, sf_dir))


@query
def bm25_topk_reloaded(spark, sf_dir):
    """Ranks with an index that is opened again from its folder."""
    index = CorpusIndex.load(spark, _ranked(spark, sf_dir, "normalize").path)
    return BM25Ranker(index).rank(_benchmark(spark, sf_dir))


@query
def bm25_topk_reused(spark, sf_dir):
    """Ranks with an index that is reused because it is there already."""
    path = _ranked(spark, sf_dir, "normalize").path
    index = CorpusIndex.fit_or_load(_documents(spark, sf_dir), path)
    return BM25Ranker(index).rank(_benchmark(spark, sf_dir))


@query
def bm25_score_all(spark, sf_dir):
    ranker = BM25Ranker(_index(spark, sf_dir, "normalize"))
    return _rounded(ranker.score_all(ONE_QUERY), 4, "score")


@query
def bm25_topk_padded(spark, sf_dir):
    ranker = BM25Ranker(_ranked(spark, sf_dir, "normalize"))
    return ranker.rank(_benchmark(spark, sf_dir), 700, pad_zero=True)


@query
def bm25_topk_positive(spark, sf_dir):
    ranker = BM25Ranker(_ranked(spark, sf_dir, "normalize"))
    return ranker.rank(_benchmark(spark, sf_dir), 700, pad_zero=True, positive_only=True)


@query
def bm25_topk_lemmas(spark, sf_dir):
    return BM25Ranker(_ranked(spark, sf_dir, "lemmas")).rank(_benchmark(spark, sf_dir))


@query
def bm25_score_docs(spark, sf_dir):
    return _scored(BM25Ranker(_index(spark, sf_dir, "normalize")), spark, sf_dir)


@query
def bm25_score_docs_lemmas(spark, sf_dir):
    return _scored(BM25Ranker(_index(spark, sf_dir, "lemmas")), spark, sf_dir)


def _bm25_variants(index: CorpusIndex) -> dict:
    return {
        "bm25": BM25Ranker(index, delta=0.0),
        "bm25_plus": BM25Ranker(index),
        "k2_b50": BM25Ranker(index, k=2.0, b=0.5),
    }


@query
def bm25_param_sweep(spark, sf_dir):
    index = _index(spark, sf_dir, "normalize")
    scores = score_variants(index, _bm25_variants(index), _benchmark(spark, sf_dir))
    return _rounded(scores, 4, "score")


@query
def bm25_param_sweep_topk(spark, sf_dir):
    index = _ranked(spark, sf_dir, "normalize")
    return rank_variants(index, _bm25_variants(index), _benchmark(spark, sf_dir), 10)


# -- labelled queries ------------------------------------------------------------------


def _examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judgements.examples(
        spark, _table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "part")
    )


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judgements.products(spark, _table(spark, sf_dir, "part"))


def _written(spark: SparkSession, sf_dir: str, label: str, make: Callable) -> DataFrame:
    """A table that several queries of a session share, written once."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _tables:
        _tables[key] = materialize(make(), label)
    return _tables[key]


def _judgement_lemmas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lemma map in which the words of queries and products are the known words."""
    return _written(
        spark,
        sf_dir,
        "judgement-lemmas",
        lambda: lemma.corpus_lemma_map(
            vocabulary(_examples(spark, sf_dir), _products(spark, sf_dir))
        ),
    )


def _processed(spark: SparkSession, sf_dir: str, lemmas: bool = False) -> DataFrame:
    return build_dataset(
        _examples(spark, sf_dir),
        _products(spark, sf_dir),
        lemmas=_judgement_lemmas(spark, sf_dir) if lemmas else None,
        extra=["line_no", "esci_label"],
    )


def _processed_table(spark: SparkSession, sf_dir: str, lemmas: bool = False) -> DataFrame:
    """The processed data set as a written table, as the steps after the build expect it."""
    label = "processed-lemmas" if lemmas else "processed"
    return _written(spark, sf_dir, label, lambda: _processed(spark, sf_dir, lemmas))


def _predictions(spark: SparkSession, sf_dir: str, lemmas: bool = False) -> DataFrame:
    kind = "judgements-lemmas" if lemmas else "judgements"
    models = experiment.rankers(_index(spark, sf_dir, kind))
    test = _processed_table(spark, sf_dir, lemmas).where("split = 'test'")
    return predict_models(models, test, order=TIES)


@query
def esci_build(spark, sf_dir):
    return _processed(spark, sf_dir)


@query
def esci_build_lemmas(spark, sf_dir):
    return _processed(spark, sf_dir, lemmas=True)


@query
def esci_build_from_files(spark, sf_dir):
    """The build over judgement and product files, read and checked as a user's would be."""
    examples, items = scratch_path(spark, "examples"), scratch_path(spark, "products")
    _examples(spark, sf_dir).write.parquet(examples)
    _products(spark, sf_dir).write.parquet(items)
    return build_dataset(
        tables.read_examples(spark, examples),
        tables.read_products(spark, items),
        extra=["esci_label"],
    )


@query
def esci_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    tables.write_processed(_processed(spark, sf_dir), path, fmt="csv")
    back = tables.read_processed(spark, path, fmt="csv")
    return back.withColumn("line_no", F.col("line_no").cast("int"))


@query
def esci_csv_split(spark, sf_dir):
    """Written by as many tasks as the build has, read by byte ranges of the files."""
    path = scratch_path(spark, "csv")
    tables.write_processed(_processed(spark, sf_dir), path, fmt="csv")
    back = tables.read_processed(spark, path, fmt="csv", splits=True)
    return back.withColumn("line_no", F.col("line_no").cast("int"))


@query
def esci_label_counts(spark, sf_dir):
    return profile.value_counts(_examples(spark, sf_dir), "esci_label")


@query
def esci_distinct_locales(spark, sf_dir):
    return profile.distinct_values(_examples(spark, sf_dir), "product_locale")


@query
def esci_distinct_counts(spark, sf_dir):
    return profile.n_distinct(
        _examples(spark, sf_dir), ["query_id", "product_id", "product_locale", "esci_label"]
    )


@query
def esci_duplicates(spark, sf_dir):
    return profile.duplicated(_examples(spark, sf_dir), ["query_id", "product_id"])


@query
def esci_duplicate_counts(spark, sf_dir):
    return profile.duplicate_report(_examples(spark, sf_dir), ["query_id", "product_id"])


@query
def esci_profile(spark, sf_dir):
    return profile.profile(_processed(spark, sf_dir))


@query
def esci_head(spark, sf_dir):
    keys = ["query_id", *TIES, "small_version"]
    return profile.head(_examples(spark, sf_dir), 5, keys)


@query
def esci_tail(spark, sf_dir):
    keys = ["query_id", *TIES, "small_version"]
    return profile.tail(_examples(spark, sf_dir), 4, keys)


@query
def sample_documents(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return sample_rows(docs, 100, ["doc_id"])


@query
def predictions(spark, sf_dir):
    return _rounded(_predictions(spark, sf_dir), 4, "predicted_score")


@query
def predictions_lemmas(spark, sf_dir):
    return _rounded(_predictions(spark, sf_dir, lemmas=True), 4, "predicted_score")


@query
def ndcg_summary_lemmas(spark, sf_dir):
    scored = materialize(_predictions(spark, sf_dir, lemmas=True), "predictions")
    return evaluate(scored, 10, ties=TIES)


@query
def ndcg_queries(spark, sf_dir):
    scored = materialize(_predictions(spark, sf_dir), "predictions")
    return _rounded(ndcg_per_query(scored, 10, ties=TIES), 4, "ndcg")


@query
def ndcg_summary(spark, sf_dir):
    scored = materialize(_predictions(spark, sf_dir), "predictions")
    return evaluate(scored, 10, ties=TIES)


@query
def experiment_summary(spark, sf_dir):
    table = _processed_table(spark, sf_dir)
    return experiment.run(table, scratch_path(spark, "experiment"), order=TIES)
