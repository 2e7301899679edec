"""TF-IDF and BM25+ over a fitted corpus, for many queries in one job.

Queries are a DataFrame ``(query_id, query)`` with unique ids, or a single string, which
becomes query 0.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrank.functions import text as text_fn
from tallyrank.functions import weights
from tallyrank.operators import impacts
from tallyrank.operators.index import CorpusIndex, QueryTerms
from tallyrank.operators.skew import (
    broadcast_size,
    hot_keys,
    lookup_join,
    shuffle_partitions,
)


def _rank_order(ties: str) -> list[Column]:
    if ties not in ("desc", "asc"):
        raise ValueError("ties must be 'desc' (higher doc_id first) or 'asc'")
    doc = F.col("doc_id").desc() if ties == "desc" else F.col("doc_id").asc()
    return [weights.rank_key(F.col("score")).desc(), doc]


def top_documents(scores: DataFrame, top_n: int, ties: str = "desc") -> DataFrame:
    """The best ``top_n`` rows of each query, numbered from 1.

    The limit on the row number lets Spark cut each task's rows to ``top_n`` per query
    before the shuffle, so one query over a huge corpus does not land in one task.
    """
    return _cut(scores, ["query_id"], _rank_order(ties), top_n)


def _cut(scores: DataFrame, group: list[str], order: list[Column], top_n: int) -> DataFrame:
    window = Window.partitionBy(*group).orderBy(*order)
    return scores.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= top_n)


def _best_of_segments(
    index: CorpusIndex,
    rankers: dict[str, Ranker],
    terms: QueryTerms,
    top_n: int,
    ties: str,
    counts: bool = False,
) -> DataFrame:
    """The best ``top_n`` documents of each segment, by each ranker: one scan of the segments
    for all queries whose lists fit a broadcast."""
    variants = {n: (r.weight_of_arrays(), r.idf_column, r.count_repeats) for n, r in rankers.items()}
    kind = terms.rows.schema["query_id"].dataType
    parts = [
        impacts.top_of_segments(
            index.asked(part), variants, top_n, ties, kind, index.id_type, counts
        )
        for part in index.batches(terms, listed=True)
    ]
    return reduce(DataFrame.unionByName, parts)


class Ranker(ABC):
    """Shared scoring plans; a subclass says what one matched term is worth."""

    idf_column: str

    def __init__(self, index: CorpusIndex):
        self.index = index

    @abstractmethod
    def term_weight(self, tf: Column, dl: Column, idf: Column, avgdl: Column) -> Column:
        """Weight of a term that occurs ``tf`` times in a document of ``dl`` tokens."""

    count_repeats = True

    def query_weight(self, qtf: Column) -> Column:
        """How often a repeated query term counts in ``score`` and ``rank``."""
        return qtf if self.count_repeats else F.lit(1)

    def weight_of_arrays(self) -> impacts.Weight | None:
        """``term_weight`` over arrays; None if it cannot be bounded by count and length."""
        return None

    # -- whole corpus ----------------------------------------------------------------

    def _terms(self, queries: DataFrame | str) -> tuple[DataFrame, QueryTerms]:
        if not isinstance(queries, str):
            return queries, self.index.query_terms(queries)
        table = self.index.spark.createDataFrame([(0, queries)], "query_id long, query string")
        return table, self.index.query_terms(table, pushdown=True)

    def _scores(self, terms: QueryTerms) -> DataFrame:
        weight = self.term_weight(
            F.col("tf"), F.col("dl"), F.col(self.idf_column), F.col("avgdl")
        )
        return (
            self.index.match(terms)
            .groupBy("query_id", "doc_id")
            .agg(F.sum(self.query_weight(F.col("qtf")) * weight).alias("score"))
        )

    def score(self, queries: DataFrame | str) -> DataFrame:
        """(query_id, doc_id, score) of the documents that share a term with the query.

        Every other document scores 0.0; see ``score_all`` for those. The sums that a task holds
        are those of a bucket's documents for one batch of queries, however many there are.
        """
        parts = self.index.batches(self._terms(queries)[1])
        return reduce(DataFrame.unionByName, [self._scores(part) for part in parts])

    def score_all(self, query: str) -> DataFrame:
        """(doc_id, score) for one query and every document of the corpus."""
        scores = self.score(query).select("doc_id", "score")
        return self.index.doc_stats.select("doc_id").join(scores, "doc_id", "left").select(
            "doc_id", F.coalesce("score", F.lit(0.0)).alias("score")
        )

    def rank(
        self,
        queries: DataFrame | str,
        top_n: int = 5,
        *,
        pad_zero: bool = False,
        positive_only: bool = False,
        ties: str = "desc",
        texts: DataFrame | None = None,
    ) -> DataFrame:
        """(query_id, rank, doc_id, score): the best ``top_n`` documents of each query.

        ``pad_zero`` fills up a query that matches fewer documents with documents of score
        0, ``positive_only`` drops scores of 0 after the cut. ``texts(doc_id, text)`` adds
        the text of the surviving rows.
        """
        order = _rank_order(ties)  # refuses other names
        queries, terms = self._terms(queries)
        if top_n > 0 and self.index.impacts is not None and self.weight_of_arrays():
            best = _best_of_segments(self.index, {"": self}, terms, top_n, ties).drop("variant")
            ranked = _cut(best, ["query_id"], order, top_n)
        else:
            # Each part is cut to top_n rows per query before it meets the others.
            parts = [
                top_documents(self._scores(part), top_n, ties)
                for part in self.index.batches(terms)
            ]
            ranked = reduce(DataFrame.unionByName, parts)
        if pad_zero:
            ranked = top_documents(self._padded(ranked, queries, top_n, ties), top_n, ties)
        if positive_only:
            ranked = ranked.where(F.col("score") > 0)
        result = ranked.select(
            "query_id",
            F.col("rank").cast("long").alias("rank"),
            "doc_id",
            F.round("score", weights.SCORE_DIGITS).alias("score"),
        )
        if texts is None:
            return result
        with_text = lookup_join(
            texts.select("doc_id", "text"),
            result,
            ["doc_id"],
            dim_rows=terms.n_queries * top_n,
            limit=self.index.broadcast_limit,
        )
        return with_text.select("query_id", "rank", "doc_id", "score", "text")

    def _padded(
        self, ranked: DataFrame, queries: DataFrame, top_n: int, ties: str
    ) -> DataFrame:
        """Add the ``top_n`` documents that win a tie at score 0 to every query.

        If fewer than ``top_n`` of a query's documents score above 0, the zeros that fill
        it up are among those ids, whatever the corpus size. So no query meets the corpus.
        """
        first = F.col("doc_id").desc() if ties == "desc" else F.col("doc_id").asc()
        extreme = (
            self.index.doc_stats.select("doc_id")
            .orderBy(first)
            .limit(top_n)
            .agg(F.collect_list("doc_id").alias("ids"))
        )
        zeros = queries.select(
            "query_id", F.explode(extreme.scalar()).alias("doc_id"), F.lit(0.0).alias("score")
        )
        return (
            ranked.select("query_id", "doc_id", "score")
            .unionByName(zeros)
            .groupBy("query_id", "doc_id")
            .agg(F.max("score").alias("score"))
        )

    # -- given candidates ------------------------------------------------------------

    def score_docs(
        self,
        candidates: DataFrame,
        queries: DataFrame,
        *,
        text_col: str = "text",
        score_col: str = "predicted_score",
    ) -> DataFrame:
        """``candidates`` plus the score of each row's text for its ``query_id``.

        The texts need not be in the corpus; document frequencies and the mean length are
        those of the corpus.
        """
        return score_candidates({score_col: self}, candidates, queries, text_col=text_col)


class BM25Ranker(Ranker):
    """BM25+. A query term counts as often as it is repeated."""

    idf_column = "idf_bm25"

    def __init__(self, index: CorpusIndex, k: float = 1.2, b: float = 0.75, delta: float = 1.0):
        super().__init__(index)
        self.k, self.b, self.delta = k, b, delta

    def term_weight(self, tf: Column, dl: Column, idf: Column, avgdl: Column) -> Column:
        return weights.bm25_weight(tf, dl, avgdl, idf, self.k, self.b, self.delta)

    def weight_of_arrays(self) -> impacts.Weight | None:
        if self.k < 0 or not 0 <= self.b <= 1 or self.delta < 0:
            return None
        return partial(weights.bm25_weights, self.k, self.b, self.delta)


class TfidfRanker(Ranker):
    """TF-IDF. ``score`` and ``rank`` count a repeated query term once, unless
    ``count_repeats`` is set; ``score_docs`` always counts every repetition."""

    def __init__(
        self,
        index: CorpusIndex,
        tf_method: str = "normalized",
        idf_method: str = "smoothed",
        count_repeats: bool = False,
    ):
        super().__init__(index)
        if tf_method not in weights.TF_METHODS:
            raise ValueError(f"unknown TF method {tf_method!r}")
        if idf_method not in weights.IDF_METHODS:
            raise ValueError(f"unknown IDF method {idf_method!r}")
        self.tf_method = tf_method
        self.idf_column = f"idf_{idf_method}"
        self.count_repeats = count_repeats

    def term_weight(self, tf: Column, dl: Column, idf: Column, avgdl: Column) -> Column:
        return weights.tf_weight(self.tf_method, tf, dl) * idf

    def weight_of_arrays(self) -> impacts.Weight | None:
        return partial(weights.tf_weights, self.tf_method)


def score_variants(
    index: CorpusIndex, rankers: dict[str, Ranker], queries: DataFrame
) -> DataFrame:
    """(query_id, doc_id, variant, score) of several rankers from one pass over postings for
    each batch of queries.

    Each variant is one more sum in the same aggregation, so rows do not multiply before
    the scores exist.
    """
    names = list(rankers)
    sums = []
    for i, ranker in enumerate(rankers.values()):
        weight = ranker.term_weight(
            F.col("tf"), F.col("dl"), F.col(ranker.idf_column), F.col("avgdl")
        )
        sums.append(F.sum(ranker.query_weight(F.col("qtf")) * weight).alias(f"_s{i}"))
    summed = reduce(
        DataFrame.unionByName,
        [
            index.match(part).groupBy("query_id", "doc_id").agg(*sums)
            for part in index.batches(index.query_terms(queries))
        ],
    )
    variants = F.array(
        *[
            F.struct(F.lit(name).alias("variant"), F.col(f"_s{i}").alias("score"))
            for i, name in enumerate(names)
        ]
    )
    return summed.select("query_id", "doc_id", F.inline(variants))


def rank_variants(
    index: CorpusIndex, rankers: dict[str, Ranker], queries: DataFrame, top_n: int = 5
) -> DataFrame:
    """(query_id, variant, rank, doc_id, score): the best documents by each of several rankers."""
    bounded = top_n > 0 and all(r.weight_of_arrays() for r in rankers.values())
    if index.impacts is not None and bounded:
        terms = index.query_terms(queries)
        scores = _best_of_segments(index, rankers, terms, top_n, "desc")
    else:
        scores = score_variants(index, rankers, queries)
    ranked = _cut(scores, ["query_id", "variant"], _rank_order("desc"), top_n)
    return ranked.select(
        "query_id",
        "variant",
        F.col("rank").cast("long").alias("rank"),
        "doc_id",
        F.round("score", weights.SCORE_DIGITS).alias("score"),
    )


def scored_pairs(
    index: CorpusIndex, rankers: dict[str, Ranker], queries: DataFrame, top_n: int = 5
) -> DataFrame:
    """(query_id, variant, n_scored, n_matching): what ``rank`` scores of all that match."""
    found = _best_of_segments(
        index, rankers, index.query_terms(queries), top_n, "desc", counts=True
    )
    return found.groupBy("query_id", "variant").agg(
        F.sum("n_scored").alias("n_scored"), F.sum("n_matching").alias("n_matching")
    )


def score_candidates(
    rankers: dict[str, Ranker],
    candidates: DataFrame,
    queries: DataFrame,
    *,
    text_col: str = "text",
) -> DataFrame:
    """``candidates`` plus one score column per entry of ``rankers`` (same index for all).

    Each query is reduced to an array of its known terms, with their statistics. After one
    join on ``query_id`` every candidate is scored inside its own row, whatever its copies: the
    query's terms meet the tokens in one hashed intersection, and only the terms it holds are
    counted. A candidate without a matching term keeps its row and scores 0.0.
    """
    index = next(iter(rankers.values())).index
    if any(ranker.index is not index for ranker in rankers.values()):
        raise ValueError("rankers that score together must share one index")
    terms = index.query_terms(queries)
    tokens = text_fn.tokens(text_col, index.tokenizer)
    length = F.size("_tokens").cast("long")
    if index.lemmas is None:
        entries = terms.rows.withColumn("form", F.col("term"))
        size = {"dim_rows": terms.n_terms, "dim_bytes": 2 * terms.n_bytes}
        sized = candidates  # cut into tokens after the join, which may have to move them
    else:
        # One row per form of a query term: that many entries reach every task in a broadcast.
        entries = _with_forms(terms.rows, index.lemmas)
        size = broadcast_size(entries.select("form", "term"))
        # Tokens whose lemma is a stopword do not count; no form of a query term is among them.
        lost = F.aggregate(
            _occurrences(F.array_intersect("_dropped", "_tokens")),
            F.lit(0).cast("long"),
            lambda n, hit: n + hit["tf"],
        )
        sized = _with_dropped(candidates.withColumn("_tokens", tokens), index.lemmas)
        sized = sized.withColumn("_length", length - lost).drop("_dropped")
    statistics = F.struct("term", "qtf", "idf_standard", "idf_smoothed", "idf_bm25", "avgdl")
    profiles = entries.groupBy("query_id").agg(
        F.collect_list(F.struct("form", statistics.alias("q"))).alias("_query")
    )
    joined = lookup_join(
        sized, profiles, ["query_id"], "left", limit=index.broadcast_limit, **size
    )
    if index.lemmas is None:
        joined = joined.withColumn("_tokens", tokens).withColumn("_length", length)
    # The intersection is what is walked over: captured by a lambda it would run per element.
    held = F.array_intersect(F.col("_query.form"), "_tokens")

    def hit(form: Column) -> Column:
        entry = F.get(F.filter("_query", lambda e: e["form"] == form), F.lit(0))
        return F.struct(_count(form).alias("tf"), entry["q"].alias("q"))

    staged = joined.withColumn("_hits", F.transform(held, hit))
    if index.lemmas is not None:
        staged = staged.withColumn("_hits", _hits_by_term(F.col("_hits")))

    def total(ranker: Ranker) -> Column:
        def add(acc: Column, hit: Column) -> Column:
            q = hit["q"]
            weight = ranker.term_weight(
                hit["tf"], F.col("_length"), q[ranker.idf_column], q["avgdl"]
            )
            return acc + q["qtf"] * weight

        # A candidate without a query profile has NULL hits.
        return F.coalesce(F.aggregate("_hits", F.lit(0.0), add), F.lit(0.0))

    return staged.select(
        *candidates.columns, *[total(r).alias(name) for name, r in rankers.items()]
    )


def _count(form: Column) -> Column:
    """Occurrences of ``form`` among ``_tokens``."""
    return (F.size("_tokens") - F.size(F.array_remove("_tokens", form))).cast("long")


def _occurrences(forms: Column) -> Column:
    return F.transform(forms, lambda form: F.struct(_count(form).alias("tf")))


# Dropped forms that every row gets in a list; beyond it texts meet them in a join.
_LISTED_FORMS = 200


def _with_dropped(texts: DataFrame, lemmas: DataFrame) -> DataFrame:
    """``texts`` with ``_dropped``: forms whose lemma is a stopword, all of its own included."""
    dropped = lemmas.where("lemma is null").select("form")
    if dropped.limit(_LISTED_FORMS + 1).count() <= _LISTED_FORMS:
        return texts.withColumn("_dropped", dropped.agg(F.collect_set("form")).scalar())
    # What each different text has to drop is at most as long as the text.
    keyed = texts.withColumn(
        "_digest", F.unhex(F.sha2(F.array_join("_tokens", " "), 256))
    )
    words = keyed.select("_digest", F.explode(F.array_distinct("_tokens")).alias("form"))
    found = words.join(dropped, "form", "left_semi").groupBy("_digest").agg(
        F.collect_set("form").alias("_dropped")
    )
    tasks = shuffle_partitions(texts.sparkSession)
    copies = keyed.groupBy("_digest").agg(F.count(F.lit(1)).alias("_rows"))
    joined = lookup_join(
        keyed,
        found,
        ["_digest"],
        "left",
        hot=hot_keys(copies, ["_digest"], "_rows", tasks),
        spread_by=[F.col(c) for c in texts.columns],
    )
    none = F.array().cast("array<string>")
    return joined.select(*texts.columns, F.coalesce("_dropped", none).alias("_dropped"))


def _hits_by_term(hits: Column) -> Column:
    """Add up the counts of forms that stand for the same query term."""
    terms = F.array_distinct(F.transform(hits, lambda hit: hit["q"]))

    def counted(q: Column) -> Column:
        same = F.filter(hits, lambda hit: hit["q"]["term"] == q["term"])
        tf = F.aggregate(same, F.lit(0).cast("long"), lambda n, hit: n + hit["tf"])
        return F.struct(tf.alias("tf"), q.alias("q"))

    return F.transform(terms, counted)


def _with_forms(entries: DataFrame, lemmas: DataFrame) -> DataFrame:
    """One row per query term and word form that stands for it in a text."""
    terms = F.col("term")
    by_lemma = lemmas.where("lemma is not null").select("form", F.col("lemma").alias("term"))
    others = entries.join(by_lemma, "term").select(*entries.columns, "form")
    # A form that itself changes does not stand for the term of the same spelling.
    changing = lemmas.select(F.col("form").alias("term"))
    own = entries.join(changing, "term", "left_anti").select(
        *entries.columns, terms.alias("form")
    )
    return own.unionByName(others)
