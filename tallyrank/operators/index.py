"""A fitted corpus: written Parquet tables, and the joins that every ranker shares.

Layout of an index folder:

* ``postings(doc_id, term, tf, dl)``, bucketed by ``doc_id`` and sorted by ``term`` in
  each file. Buckets keep all postings of a document in one task, so scores are summed
  without a shuffle; the sort lets a filter on a few terms skip most pages of each file.
  A document without tokens has one row with a NULL term.
* ``impacts``, bucketed by segment and sorted by ``term``: the same postings once more, for
  ``rank`` (see ``operators/impacts.py``). Left out with ``ranked=False``; ``rank`` then joins.
  ``add_segments`` writes them later.
* ``doc_stats(doc_id, dl)``, ``terms(term, df, cf, max_tf, max_share, idf_*)``,
  ``corpus_stats`` (one row),
  ``lemma_map(form, lemma)`` if lemmas were given, ``index_info`` (one row, written last).
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyrank import schemas
from tallyrank.functions import text as text_fn
from tallyrank.functions import weights
from tallyrank.operators import corpus, impacts, lemma
from tallyrank.operators.skew import (
    BROADCAST_BYTES,
    BROADCAST_ROWS,
    broadcast_size,
    fits_broadcast,
    hot_keys,
    lookup_join,
    shuffle_partitions,
)
from tallyrank.sources.scratch import materialize, scratch_path

# The scores of a bucket's documents for a batch of queries share one task's memory, its postings
# are sorted in one task, and ``rank`` holds its segment in a Python worker. What a task needs
# follows from these numbers, not from the corpus.
DOCS_PER_BUCKET = 5_000
TOKENS_PER_BUCKET = 2_000_000
# Queries that are ranked in one pass: with the documents of a bucket they bound the number of
# sums a task holds (2 million; more spill).
QUERIES_PER_BATCH = 400
# Query terms whose lists are broadcast at once (12 bytes for each, besides ids that are strings).
LISTED_ROWS = 5_000_000

_INFO_SCHEMA = "tokenizer string, id_type string, n_buckets int, lemma_rows long"


@dataclass(frozen=True)
class QueryTerms:
    """The terms of a batch of queries found in the corpus, with the size of the batch."""

    rows: DataFrame
    n_queries: int
    n_terms: int
    n_bytes: int
    pushed: list[str] | None = None


def bucket_count(n_docs: int, n_tokens: int, least: int, most: int) -> int:
    """Buckets for a corpus: enough for its documents and tokens, and a legal number."""
    wanted = max(math.ceil(n_docs / DOCS_PER_BUCKET), math.ceil(n_tokens / TOKENS_PER_BUCKET))
    return max(1, min(most, max(least, wanted)))


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no fitted index table at {path}; fit it first") from error
        raise


def _write_info(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    info = spark.createDataFrame(rows, _INFO_SCHEMA).coalesce(1)
    info.write.mode("overwrite").parquet(f"{path}/index_info")


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _rename(spark: SparkSession, path: str, to: str) -> None:
    folder, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).rename(folder, target):
        raise OSError(f"cannot rename {path} to {to}")


def _write_segments(postings: DataFrame, doc_stats: DataFrame, n_buckets: int, path: str) -> None:
    rows = impacts.segment_rows(postings, doc_stats, n_buckets)
    table = f"tallyrank_{uuid.uuid4().hex}"
    (
        rows.write.mode("overwrite")
        .bucketBy(n_buckets, "segment")
        .sortBy("term")
        .option("path", path)
        .saveAsTable(table)
    )
    postings.sparkSession.sql(f"DROP TABLE {table}")


class CorpusIndex:
    """Tables of a fitted corpus. Use ``fit`` or ``load``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        info = _read(spark, f"{self.path}/index_info", _INFO_SCHEMA).first()
        if info is None:
            raise FileNotFoundError(f"the index at {self.path} was not completed; fit it first")
        self.tokenizer = info["tokenizer"]
        self.id_type = info["id_type"]
        self.n_buckets = info["n_buckets"]
        self.lemma_rows = info["lemma_rows"]
        self.doc_stats = _read(
            spark, f"{self.path}/doc_stats", f"doc_id {self.id_type}, dl long"
        )
        self.terms = _read(spark, f"{self.path}/terms", schemas.TERMS)
        self.stats = _read(spark, f"{self.path}/corpus_stats", schemas.CORPUS_STATS)
        self.lemmas = None
        if self.lemma_rows is not None:
            self.lemmas = _read(spark, f"{self.path}/lemma_map", schemas.LEMMA_MAP)
        self._postings = self._open_postings()
        self.impacts = self._open_impacts()
        self.broadcast_limit: int | None = None

    # -- fitting ---------------------------------------------------------------------

    @classmethod
    def fit(
        cls,
        docs: DataFrame,
        path: str | None = None,
        *,
        id_col: str = "doc_id",
        text_col: str = "text",
        tokenizer: str = "normalize",
        lemmas: DataFrame | None = None,
        passes: int = 1,
        n_buckets: int | None = None,
        ranked: bool = True,
    ) -> CorpusIndex:
        """Tokenize ``docs`` once and write the index tables.

        ``docs`` has one row per document and unique ids. ``path`` defaults to a new
        folder under the session's checkpoint folder. ``lemmas(form, lemma)`` is applied
        ``passes`` times after stopword removal. One bucket is one task when queries run;
        by default their number follows documents and tokens, up to the most that Spark allows.
        ``ranked=False`` leaves out the table that only ``rank`` reads.
        """
        spark = docs.sparkSession
        path = (path or scratch_path(spark, "index")).rstrip("/")
        # An index that is being written over counts as missing.
        _write_info(spark, path, [])
        id_type = docs.schema[id_col].dataType.simpleString()

        effective, lemma_rows = None, None
        if lemmas is not None:
            lemma.effective_map(lemmas, passes).write.mode("overwrite").parquet(
                f"{path}/lemma_map"
            )
            effective = _read(spark, f"{path}/lemma_map", schemas.LEMMA_MAP)
            lemma_rows = effective.count()

        # Counted where they are read and written once: what is shuffled afterwards has no
        # stopwords, punctuation or repeats, and a computed input is computed once.
        counted = materialize(
            corpus.token_runs(
                docs.select(
                    F.col(id_col).alias("doc_id"), text_fn.tokens(text_col, tokenizer).alias("tokens")
                ),
                "tokens",
            ),
            "tokenized",
        )
        if n_buckets is None:
            size = counted.agg(
                F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum("dl"), F.lit(0)).alias("n_tokens")
            ).first()
            cores = spark.sparkContext.defaultParallelism
            n_buckets = bucket_count(
                size["n_docs"],
                size["n_tokens"],
                min(shuffle_partitions(spark), cores),
                int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")),
            )
        postings = corpus.explode_runs(counted.repartition(n_buckets, "doc_id"), "runs")
        if effective is not None:
            postings = _lemmatized_postings(postings, effective, lemma_rows, n_buckets)
        table = f"tallyrank_{uuid.uuid4().hex}"
        (
            postings.select("doc_id", "term", "tf", "dl")
            .write.mode("overwrite")
            .bucketBy(n_buckets, "doc_id")
            .sortBy("term")
            .option("path", f"{path}/postings")
            .saveAsTable(table)
        )
        written = spark.table(table)
        written.groupBy("doc_id").agg(F.max("dl").alias("dl")).write.mode("overwrite").parquet(
            f"{path}/doc_stats"
        )
        doc_stats = _read(spark, f"{path}/doc_stats", f"doc_id {id_type}, dl long")
        corpus.corpus_stats(doc_stats).write.mode("overwrite").parquet(f"{path}/corpus_stats")
        stats = _read(spark, f"{path}/corpus_stats", schemas.CORPUS_STATS)
        found = corpus.term_statistics(written.where("term is not null"))
        corpus.with_idf(found, stats.select("n_docs").scalar()).sortWithinPartitions(
            "term"
        ).write.mode("overwrite").parquet(f"{path}/terms")
        if ranked:
            _write_segments(written.where("term is not null"), doc_stats, n_buckets, f"{path}/impacts")
        else:
            _remove(spark, f"{path}/impacts")
        spark.sql(f"DROP TABLE {table}")
        _write_info(spark, path, [(tokenizer, id_type, n_buckets, lemma_rows)])
        return cls(spark, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CorpusIndex:
        """Open a saved index; ``FileNotFoundError`` if a table is missing."""
        return cls(spark, path)

    @classmethod
    def exists(cls, spark: SparkSession, path: str) -> bool:
        try:
            cls(spark, path)
        except FileNotFoundError:
            return False
        return True

    @classmethod
    def fit_or_load(cls, docs: DataFrame, path: str, overwrite: bool = False, **options):
        """Reuse the index at ``path`` unless it is missing or ``overwrite`` is set."""
        spark = docs.sparkSession
        if not overwrite and cls.exists(spark, path):
            return cls.load(spark, path)
        return cls.fit(docs, path, **options)

    def add_segments(self) -> CorpusIndex:
        """This index with the table that ``rank`` reads, which is written if it is missing."""
        if self.impacts is None:
            # Moved to its place when it is whole: a write that stops half way leaves none.
            made = f"{self.path}/impacts-{uuid.uuid4().hex}"
            _write_segments(self.postings, self.doc_stats, self.n_buckets, made)
            _rename(self.spark, made, f"{self.path}/impacts")
            self.impacts = self._open_impacts()
        return self

    def _open_postings(self) -> DataFrame:
        """A scan of the postings that knows their buckets.

        Bucketing is a property of catalog tables, so the files get a table name just long
        enough to resolve the scan.
        """
        _read(self.spark, f"{self.path}/postings", "term string")
        columns = f"doc_id {self.id_type}, term string, tf bigint, dl bigint"
        return self._bucketed("postings", columns, "doc_id")

    def _open_impacts(self) -> DataFrame | None:
        try:
            _read(self.spark, f"{self.path}/impacts", "term string")
        except FileNotFoundError:
            return None
        return self._bucketed("impacts", impacts.impact_columns(self.id_type), "segment")

    def _bucketed(self, name: str, columns: str, by: str) -> DataFrame:
        table = f"tallyrank_{uuid.uuid4().hex}"
        location = self.path.replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE {table} ({columns})"
            f" USING parquet CLUSTERED BY ({by}) SORTED BY (term) INTO {self.n_buckets}"
            f" BUCKETS LOCATION '{location}/{name}'"
        )
        rows = self.spark.table(table)
        self.spark.sql(f"DROP TABLE {table}")
        return rows

    # -- tables ----------------------------------------------------------------------

    @property
    def postings(self) -> DataFrame:
        return self._postings.where("term is not null")

    def weights(self, tf_method: str = "normalized", idf_method: str = "smoothed") -> DataFrame:
        """The TF-IDF matrix as rows (doc_id, term, weight)."""
        if idf_method not in weights.IDF_METHODS:
            raise ValueError(f"unknown IDF method {idf_method!r}, expected one of {weights.IDF_METHODS}")
        tf = weights.tf_weight(tf_method, F.col("tf"), F.col("dl"))
        idf = self.terms.select("term", "df", F.col(f"idf_{idf_method}").alias("idf"))
        least = self._least_frequent()
        if least is None:
            joined = lookup_join(self.postings, idf, ["term"], hot=self._term_skew()["hot"], spread_by=[F.col("doc_id")])
        else:
            # The frequent terms hold most postings, which stay where they are; the others have few each.
            frequent = F.broadcast(idf.where(F.col("df") >= least))
            joined = self.postings.join(frequent, "term")
            if least > 1:
                rest = self.postings.join(F.broadcast(frequent.select("term")), "term", "left_anti")
                joined = joined.unionByName(rest.join(idf.where(F.col("df") < least), "term"))
        return joined.select("doc_id", "term", (tf * F.col("idf")).alias("weight"))

    def _least_frequent(self) -> int | None:
        """Terms of at least this many documents fit a broadcast; 1 if all do, None if none."""
        size = F.floor(F.log2("df") * 64)  # 64 * 63 sizes at most
        sizes = self.terms.groupBy(size.alias("size")).agg(
            F.min("df").alias("df"),
            F.count(F.lit(1)).alias("terms"),
            F.sum(F.octet_length("term")).alias("bytes"),
        )
        least, terms, text_bytes = None, 0, 0
        for row in sorted(sizes.collect(), key=lambda r: -r["df"]):
            terms, text_bytes = terms + row["terms"], text_bytes + row["bytes"]
            if not fits_broadcast(terms, self.broadcast_limit, text_bytes):
                return least
            least = row["df"]
        return 1

    def n_terms(self) -> int:
        return self.terms.count()

    def idf_lookup(self, words: DataFrame) -> DataFrame:
        """IDFs of the given ``words(term)``; a word in no document has df = 0."""
        n_docs = self.stats.select("n_docs").scalar()
        words = words.select("term").distinct()
        known = words.join(self.terms.select("term", "df"), "term", "left")
        df = known.select("term", F.coalesce("df", F.lit(0)).alias("df"))
        return df.select(
            "term",
            "df",
            weights.idf_standard_or_zero(n_docs, F.col("df")).alias("idf_standard"),
            weights.idf_weight("smoothed", n_docs, F.col("df")).alias("idf_smoothed"),
            weights.idf_bm25(n_docs, F.col("df")).alias("idf_bm25"),
        )

    def _term_skew(self) -> dict:
        tasks = shuffle_partitions(self.spark)
        return {
            "hot": hot_keys(self.terms.select("term", "df"), ["term"], "df", tasks),
            "spread_by": [F.col("doc_id")],
            "limit": self.broadcast_limit,
        }

    # -- queries ---------------------------------------------------------------------

    def query_terms(self, queries: DataFrame, pushdown: bool = False) -> QueryTerms:
        """Distinct terms of ``queries(query_id, query)`` with their count ``qtf``, joined
        to the statistics of the corpus; unknown terms have none and are left out.

        ``pushdown`` is for a single short query: its terms also become a filter on the
        scan of the postings, whose files are sorted by term.
        """
        split = queries.select(
            "query_id", text_fn.tokens("query", self.tokenizer).alias("tokens")
        )
        terms = corpus.term_counts(split, "tokens", tf="qtf").where("term is not null")
        terms = terms.select("query_id", "term", "qtf")
        if self.lemmas is not None:
            terms = (
                lemma.lemmatize(terms, "term", self.lemmas, self.lemma_rows)
                .where("term is not null")
                .groupBy("query_id", "term")
                .agg(F.sum("qtf").alias("qtf"))
            )
        size = split.agg(
            F.count(F.lit(1)).alias("n_queries"),
            F.coalesce(F.sum(F.size(F.array_distinct("tokens"))), F.lit(0)).alias("n_terms"),
            F.coalesce(
                F.sum(F.octet_length(F.array_join(F.array_distinct("tokens"), ""))), F.lit(0)
            ).alias("n_bytes"),
        ).first()
        if fits_broadcast(size["n_terms"], self.broadcast_limit, size["n_bytes"]):
            found = self.terms.join(F.broadcast(terms), "term")
        else:
            uses = terms.groupBy("term").agg(F.count(F.lit(1)).alias("uses"))
            found = lookup_join(
                terms,
                self.terms,
                ["term"],
                hot=hot_keys(uses, ["term"], "uses", shuffle_partitions(self.spark)),
                spread_by=[F.col("query_id")],
            )
        pushed = None
        if pushdown:
            pushed = [r["term"] for r in terms.select("term").collect()]
        avgdl = self.stats.select("avgdl").scalar()
        return QueryTerms(
            found.withColumn("avgdl", avgdl),
            size["n_queries"],
            size["n_terms"],
            size["n_bytes"],
            pushed,
        )

    def batches(self, terms: QueryTerms, listed: bool = False) -> list[QueryTerms]:
        """``terms`` in parts of whole queries that each fit a broadcast.

        A task then holds the sums of one bucket's documents for at most about
        ``QUERIES_PER_BATCH`` queries, and postings are never shuffled: each part is a pass
        over them. Only a single query too large for a broadcast is left to a shuffle join.
        ``listed``: for ``uses``, which takes queries one by one and is some five times
        smaller, so that a part holds as many queries as the bytes allow.
        """
        rows = LISTED_ROWS if listed else BROADCAST_ROWS
        rows = rows if self.broadcast_limit is None else max(1, self.broadcast_limit)
        size = terms.n_bytes + (12 if listed else 60) * terms.n_terms
        n = max(
            0 if listed else math.ceil(terms.n_queries / QUERIES_PER_BATCH),
            math.ceil(terms.n_terms / rows),
            math.ceil(size / BROADCAST_BYTES),
        )
        if n <= 1:
            return [terms]
        part = F.pmod(F.xxhash64("query_id"), F.lit(2 * n)).cast("int")
        numbered = materialize(terms.rows.withColumn("_part", part), "query-terms")
        sizes = numbered.groupBy("_part").agg(
            F.countDistinct("query_id").alias("n_queries"),
            F.count(F.lit(1)).alias("n_terms"),
            F.sum(F.octet_length("term")).alias("n_bytes"),
        )
        return [
            QueryTerms(
                numbered.where(F.col("_part") == s["_part"]).drop("_part"),
                s["n_queries"],
                s["n_terms"],
                s["n_bytes"],
            )
            for s in sorted(sizes.collect(), key=lambda s: s["_part"])  # a row per part
        ]

    def asked(self, terms: QueryTerms) -> DataFrame:
        """The rows of ``impacts`` that a part of queries needs, each with its queries.

        A term's queries are one list, so a row of a segment is read once for all of them.
        """
        lists = terms.rows.groupBy("term").agg(
            F.collect_list(F.struct("query_id", "qtf")).alias("uses"),
            *[F.first(c).alias(c) for c in ("idf_standard", "idf_smoothed", "idf_bm25", "avgdl")],
        )
        # The row of no term asks for the documents of every segment.
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in lists.schema.fields]
        documents = self.spark.range(1).select(*nothing)
        lists = materialize(lists.unionByName(documents), "query-lists")
        lists = lists.withColumnRenamed("term", "asked_term")
        rows = self.impacts
        if terms.pushed is not None:
            rows = rows.where(F.col("term").isNull() | F.col("term").isin(terms.pushed))
        limit = LISTED_ROWS if self.broadcast_limit is None else self.broadcast_limit
        if terms.n_terms <= limit and terms.n_bytes + 12 * terms.n_terms <= BROADCAST_BYTES:
            lists = F.broadcast(lists)
        return rows.join(lists, F.col("term").eqNullSafe(F.col("asked_term"))).drop("asked_term")

    def match(self, terms: QueryTerms) -> DataFrame:
        """One row per query term and document that holds it."""
        postings = self.postings
        if terms.pushed is not None:
            postings = postings.where(F.col("term").isin(terms.pushed))
        return lookup_join(
            postings,
            terms.rows,
            ["term"],
            dim_rows=terms.n_terms,
            dim_bytes=terms.n_bytes,
            **self._term_skew(),
        )


def _lemmatized_postings(
    postings: DataFrame, effective: DataFrame, rows: int, n_buckets: int
) -> DataFrame:
    """Replace terms by lemmas and count again. Dropped tokens no longer count as length."""
    mapped = lemma.lemmatize(postings.drop("dl"), "term", effective, rows)
    if not fits_broadcast(rows):
        # The join moved the rows by term; bring each document's rows together again.
        mapped = mapped.repartition(n_buckets, "doc_id")
    counted = mapped.groupBy("doc_id", "term").agg(
        F.sum(F.when(F.col("term").isNotNull(), F.col("tf")).otherwise(0)).alias("tf")
    )
    # All rows of a document are in one task by now: the window adds no shuffle.
    whole = counted.withColumn("dl", F.sum("tf").over(Window.partitionBy("doc_id")))
    return whole.where(F.col("term").isNotNull() | (F.col("dl") == 0))
