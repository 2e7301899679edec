"""The SQL twin of each named query, for DuckDB over the same tables.

Texts first replace U+0130, which lower-cases to different characters in the two engines.
"""

from __future__ import annotations

from tallyrank.functions.text import STOPWORDS
from tallyrank.operators.lemma import NOUN_SUFFIXES
from tallyrank.plans.registry import ONE_QUERY

_STOP = ", ".join(f"'{w}'" for w in STOPWORDS)

_WHITESPACE = (
    r"[\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def _lower(column: str) -> str:
    return f"lower(replace(coalesce({column}, ''), chr(304), 'I '))"


def _tokens(column: str) -> str:
    return (
        f"[t FOR t IN regexp_split_to_array({_lower(column)}, '[^a-z0-9]+')"
        f" IF t <> '' AND t NOT IN ({_STOP})]"
    )


def _words(column: str) -> str:
    return f"[t FOR t IN regexp_split_to_array({_lower(column)}, '{_WHITESPACE}') IF t <> '']"


def _strip(column: str) -> str:
    return f"regexp_replace({column}, '<[^>\\n]*>|&nbsp;', ' ', 'g')"


def _unescape(column: str) -> str:
    """The entities that occur in the test pages; ``&amp;`` last, so that none unfolds twice."""
    result = column
    for pattern, char in (("&quot;?", '"'), ("&middot;?", "·"), ("&copy;?", "©"), ("&amp;?", "&")):
        result = f"regexp_replace({result}, '{pattern}', '{char}', 'g')"
    return result


def _corpus(tokens: str, docs: str = "documents") -> str:
    return f"""
tok AS MATERIALIZED (SELECT doc_id, {tokens} AS tokens FROM {docs}),
lens AS (SELECT doc_id, len(tokens) AS dl FROM tok),
stats AS (
  SELECT count(*) AS n_docs, coalesce(sum(dl), 0)::BIGINT AS total_tokens,
         CASE WHEN count(*) > 0 THEN sum(dl) / count(*) ELSE 0.0 END AS avgdl FROM lens),
post AS MATERIALIZED (
  SELECT doc_id, term, count(*) AS tf, any_value(dl) AS dl
  FROM (SELECT doc_id, len(tokens) AS dl, unnest(tokens) AS term FROM tok)
  GROUP BY doc_id, term),
terms AS MATERIALIZED (
  SELECT term, df, log10(n_docs / greatest(df, 1)) AS idf_standard,
         log10((n_docs + 1) / (df + 1)) + 1 AS idf_smoothed,
         ln((n_docs - df + 0.5) / (df + 0.5) + 1) AS idf_bm25
  FROM (SELECT term, count(*) AS df FROM post GROUP BY term), stats)"""


def _query_terms(tokens: str) -> str:
    return f"""
qt AS (
  SELECT query_id, term, count(*) AS qtf
  FROM (SELECT item_id AS query_id, unnest({tokens}) AS term FROM benchmark)
  GROUP BY query_id, term)"""


_NORMALIZED = _corpus(_tokens("text"))
_SPLIT = _corpus(_words("text"))
_QT = _query_terms(_tokens("text"))


def _bm25(k: float = 1.2, b: float = 0.75, delta: float = 1.0) -> str:
    return (
        f"idf_bm25 * ({delta} + tf * ({k} + 1) / (tf + {k} * (1 - {b} + {b} * dl / avgdl)))"
    )


def _scores(weight: str, match: str = "post JOIN terms USING (term) JOIN qt USING (term), stats"):
    return f"""
scores AS (
  SELECT query_id, doc_id, sum({weight}) AS score FROM {match} GROUP BY query_id, doc_id)"""


def _top(n: int, scores: str = "scores", ties: str = "DESC") -> str:
    return f"""
top AS (
  SELECT query_id, doc_id, score, rank FROM (
    SELECT query_id, doc_id, score, row_number() OVER (
      PARTITION BY query_id ORDER BY score::FLOAT DESC, doc_id {ties}) AS rank
    FROM {scores}) WHERE rank <= {n})"""


_TOP_COLUMNS = "SELECT query_id, rank, doc_id, round(score, 4) AS score FROM top"

# Every query with every document: the plain meaning of a ranking that keeps zeros.
_DENSE = """
dense AS (
  SELECT item_id AS query_id, d.doc_id, coalesce(score, 0.0) AS score
  FROM benchmark CROSS JOIN documents d
  LEFT JOIN scores s ON s.query_id = item_id AND s.doc_id = d.doc_id)"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


_TF = {
    "normalized": "tf / dl",
    "boolean": "1.0::DOUBLE",
    "summation": "tf::DOUBLE",
    "log_scaled": "log10(1 + tf)",
}

def _candidate_scores(*parts: str) -> str:
    asked = "doc_id % (SELECT count(*) FROM benchmark)"
    own = f"own AS (SELECT * FROM scores WHERE query_id = {asked})"
    return _with(
        *parts,
        own,
        select=f"""SELECT d.{asked} AS query_id, d.doc_id,
       round(coalesce(score, 0.0), 4) AS predicted_score
FROM documents d LEFT JOIN own ON own.doc_id = d.doc_id""",
    )


_VARIANTS = "(VALUES ('bm25', 1.2, 0.75, 0.0), ('bm25_plus', 1.2, 0.75, 1.0), ('k2_b50', 2.0, 0.5, 1.0)) v(variant, k, b, delta)"

_RULES = ", ".join(f"('{s}', '{e}', {i})" for i, (s, e) in enumerate(NOUN_SUFFIXES, 1))



def _lemma_map(words: str) -> str:
    return f"""
rules(suffix, ending, ord) AS (VALUES {_RULES}),
candidates AS (
  SELECT term AS form, term AS candidate, 0 AS ord FROM {words}
  UNION ALL
  SELECT term, left(term, len(term) - len(suffix)) || ending, ord
  FROM {words} JOIN rules ON right(term, len(suffix)) = suffix AND len(term) >= len(suffix)),
lemma_map AS MATERIALIZED (
  SELECT form, arg_min(candidate, len(candidate) * 100 + ord) AS lemma
  FROM candidates SEMI JOIN {words} ON candidate = term GROUP BY form)"""


_LEMMAS = _lemma_map("terms")

# Two rounds of "drop stopwords, then lemmatize".
_LEMMA_CORPUS = f"""
twice AS MATERIALIZED (
  SELECT a.form, CASE WHEN a.lemma IN ({_STOP}) THEN NULL ELSE b.lemma END AS lemma
  FROM lemma_map a LEFT JOIN lemma_map b ON b.form = a.lemma),
raw AS (
  SELECT doc_id, lemma AS term, sum(tf)::BIGINT AS tf
  FROM post JOIN twice ON form = term WHERE lemma IS NOT NULL GROUP BY doc_id, lemma),
lens2 AS (SELECT doc_id, sum(tf) AS dl FROM raw GROUP BY doc_id),
stats2 AS (SELECT n_docs, (SELECT sum(dl) FROM lens2) / n_docs AS avgdl FROM stats),
terms2 AS (
  SELECT term, ln((n_docs - df + 0.5) / (df + 0.5) + 1) AS idf_bm25
  FROM (SELECT term, count(*) AS df FROM raw GROUP BY term), stats2),
qt2 AS (
  SELECT query_id, coalesce(lemma, term) AS term, sum(qtf) AS qtf
  FROM qt LEFT JOIN twice ON form = term
  WHERE form IS NULL OR lemma IS NOT NULL GROUP BY ALL)"""

_LEMMA_SCORES = _scores(
    f"qtf * {_bm25()}",
    "raw JOIN lens2 USING (doc_id) JOIN terms2 USING (term) JOIN qt2 USING (term), stats2",
)

# The labelled queries in another wording than the plan's own.
_EXAMPLES = """
examples AS MATERIALIZED (
  SELECT o.l_orderkey AS query_id, q.p_name AS query, o.l_partkey::VARCHAR AS product_id,
         o.l_linenumber AS line_no, if(o.l_linestatus = 'O', 'us', 'es') AS product_locale,
         (o.l_quantity <= 40)::INTEGER AS small_version,
         coalesce(MAP {'A': 'E', 'R': 'S'}[o.l_returnflag],
                  ['I', 'C', 'X'][1 + o.l_linenumber % 3]) AS esci_label,
         if(o.l_orderkey % 5 = 0, 'test', 'train') AS split
  FROM lineitem o, part q
  WHERE o.l_orderkey % (SELECT count(*) FROM part) = q.p_partkey)"""
_PRODUCTS = """
products AS (
  SELECT p_partkey::VARCHAR AS product_id,
         ['es', 'us', 'us', 'us'][1 + p_partkey % 4] AS product_locale,
         p_name AS product_title, nullif([NULL, p_type, p_type][1 + p_partkey % 3], '') AS product_description,
         p_size::VARCHAR AS product_bullet_point, p_brand AS product_brand,
         if(p_partkey % 2 = 1, string_split(p_name, ' ')[1], NULL) AS product_color
  FROM part)"""

_PRODUCT_TEXT = (
    "coalesce(product_title, '') || ' ' || coalesce(product_description, '') || ' ' ||"
    " coalesce(product_bullet_point, '') || ' ' || coalesce(product_brand, '') || ' ' ||"
    " coalesce(product_color, '')"
)


def _clean(column: str) -> str:
    return f"array_to_string({_tokens(_strip(column))}, ' ')"


_PROCESSED = f"""
processed AS MATERIALIZED (
  SELECT query_id, product_id, {_clean('query')} AS clean_query,
         {_clean('document')} AS clean_product_document,
         CASE lower(esci_label) WHEN 'e' THEN 1.0 WHEN 's' THEN 0.6 WHEN 'i' THEN 0.1
              WHEN 'c' THEN 0.0 END::DOUBLE AS relevance_score,
         split, line_no, esci_label
  FROM (
    SELECT e.*, {_PRODUCT_TEXT} AS document
    FROM examples e LEFT JOIN products p USING (product_locale, product_id)
    WHERE small_version = 1 AND product_locale = 'us'))"""


# The same with lemmas: every different text is taken apart, lemmatized and put together.
_JUDGEMENT_LEMMAS = (
    f"""
raw_texts AS MATERIALIZED (
  SELECT DISTINCT text FROM (
    SELECT query AS text FROM examples UNION ALL SELECT {_PRODUCT_TEXT} FROM products)),
raw_words AS MATERIALIZED (
  SELECT text, unnest(t) AS term, unnest(range(len(t))) AS pos
  FROM (SELECT text, {_tokens(_strip('text'))} AS t FROM raw_texts)),
vocabulary AS MATERIALIZED (SELECT DISTINCT term FROM raw_words)""",
    _lemma_map("vocabulary"),
    """
cleaned AS MATERIALIZED (
  SELECT text, string_agg(lemma, ' ' ORDER BY pos) AS clean
  FROM raw_words JOIN lemma_map ON form = term GROUP BY text)""",
    f"""
processed AS MATERIALIZED (
  SELECT query_id, product_id, coalesce(q.clean, '') AS clean_query,
         coalesce(d.clean, '') AS clean_product_document,
         CASE lower(esci_label) WHEN 'e' THEN 1.0 WHEN 's' THEN 0.6 WHEN 'i' THEN 0.1
              WHEN 'c' THEN 0.0 END::DOUBLE AS relevance_score,
         split, line_no, esci_label
  FROM (
    SELECT e.*, CASE WHEN p.product_id IS NOT NULL THEN {_PRODUCT_TEXT} END AS document
    FROM examples e LEFT JOIN products p USING (product_locale, product_id)
    WHERE small_version = 1 AND product_locale = 'us') j
  LEFT JOIN cleaned q ON q.text = j.query LEFT JOIN cleaned d ON d.text = j.document)""",
)


def _whole(split: str) -> str:
    return f"\n{split}_rows AS (SELECT * FROM processed WHERE split = '{split}')"


def _prediction_parts(lemmas: bool = False) -> list[str]:
    # The second pass over cleaned text drops stopwords and lemmatizes once more.
    def tokens(column: str) -> str:
        plain = _tokens(column)
        return f"[coalesce(lemma_of[t], t) FOR t IN {plain}]" if lemmas else plain

    also = ", lemma_maps" if lemmas else ""
    lemma_maps = "lemma_maps AS (SELECT map_from_entries(list((form, lemma))) AS lemma_of FROM lemma_map)"

    docs = """
train_docs AS (
  SELECT clean_product_document AS doc_id, clean_product_document AS text FROM train_rows
  WHERE clean_product_document <> '' GROUP BY ALL)"""
    predictions = f"""
numbered AS (SELECT *, row_number() OVER () AS row_no FROM test_rows),
firsts AS (
  SELECT query_id, arg_min(clean_query, (product_id, line_no, esci_label)) AS query
  FROM numbered GROUP BY query_id),
fq AS (
  SELECT query_id, term, count(*) AS qtf
  FROM (SELECT query_id, unnest({tokens('query')}) AS term FROM firsts{also}) GROUP BY ALL),
cand AS (
  SELECT row_no, query_id, term, count(*) AS tf, any_value(dl) AS dl
  FROM (SELECT row_no, query_id, len(toks) AS dl, unnest(toks) AS term
        FROM (SELECT *, {tokens('clean_product_document')} AS toks FROM numbered{also}))
  GROUP BY row_no, query_id, term),
found AS (
  SELECT row_no, sum(qtf * tf / dl * idf_smoothed) AS tfidf, sum(qtf * {_bm25()}) AS bm25
  FROM cand JOIN fq USING (query_id, term) JOIN terms USING (term), stats GROUP BY row_no),
predictions AS MATERIALIZED (
  SELECT model, query_id, product_id, line_no, esci_label, relevance_score,
         coalesce(CASE model WHEN 'tfidf' THEN tfidf ELSE bm25 END, 0.0) AS predicted_score
  FROM numbered LEFT JOIN found USING (row_no), (VALUES ('tfidf'), ('bm25')) m(model))"""
    return [
        _EXAMPLES,
        _PRODUCTS,
        *([*_JUDGEMENT_LEMMAS, lemma_maps] if lemmas else [_PROCESSED]),
        _whole("train"),
        _whole("test"),
        docs,
        _corpus(tokens("text"), f"train_docs{also}"),
        predictions,
    ]


_NDCG = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY model, query_id ORDER BY predicted_score::FLOAT DESC,
           product_id DESC, line_no DESC, esci_label DESC) AS r,
         row_number() OVER (PARTITION BY model, query_id ORDER BY relevance_score DESC) AS ideal
  FROM predictions),
gains AS (
  SELECT model, query_id, count(*) - count(relevance_score) AS missing,
         sum(CASE WHEN r <= 10 THEN relevance_score / log2(r + 1) END) AS dcg,
         sum(CASE WHEN ideal <= 10 THEN relevance_score / log2(ideal + 1) END) AS idcg
  FROM ranked GROUP BY model, query_id),
per_query AS (
  SELECT model, query_id,
         CASE WHEN missing = 0 AND idcg > 0 THEN dcg / idcg ELSE 0.0 END AS ndcg FROM gains)"""

_SUMMARY = "SELECT model, round(avg(ndcg), 4) AS ndcg_at_k FROM per_query GROUP BY model"

_PROFILE_TYPES = (
    ("query_id", "bigint"),
    ("product_id", "string"),
    ("clean_query", "string"),
    ("clean_product_document", "string"),
    ("relevance_score", "double"),
    ("split", "string"),
    ("line_no", "int"),
    ("esci_label", "string"),
)


def queries() -> dict[str, str]:
    idfs = (
        "round(idf_standard, 6) AS idf_standard, round(idf_smoothed, 6) AS idf_smoothed,"
        " round(idf_bm25, 6) AS idf_bm25"
    )
    normalized, split = _tokens("text"), _words("text")
    words = f"words AS (SELECT DISTINCT unnest({split}) AS term FROM benchmark)"
    tfidf = _scores("tf / dl * idf_smoothed")
    bm25 = _scores(f"qtf * {_bm25()}")
    padded = _scores("log10(1 + tf) * idf_standard")
    search = _scores("qtf * tf / dl * idf_smoothed")
    sweep = f"""
sweep AS (
  SELECT query_id, doc_id, variant, sum(qtf * idf_bm25 *
         (delta + tf * (k + 1) / (tf + k * (1 - b + b * dl / avgdl)))) AS score
  FROM post JOIN terms USING (term) JOIN qt USING (term), stats, {_VARIANTS}
  GROUP BY query_id, doc_id, variant)"""
    dup_keys = "count(*) OVER (PARTITION BY query_id, product_id) AS copies"
    order = "query_id, product_id, line_no, esci_label, small_version"
    example_columns = (
        "query_id, query, product_id, line_no, product_locale, small_version, esci_label, split"
    )
    whole, lemmatized = _prediction_parts(), _prediction_parts(lemmas=True)
    one = f"qt AS (SELECT 0 AS query_id, unnest({_tokens(repr(ONE_QUERY))}) AS term, 1 AS qtf)"
    result = {
        "tokens_normalize": f"""
SELECT doc_id, len(t) AS n_tokens, array_to_string(t, ' ') AS normalized
FROM (SELECT doc_id, {normalized} AS t FROM documents)""",
        "tokens_whitespace": f"""
SELECT doc_id, len(t) AS n_tokens, array_to_string(t, ' ') AS words
FROM (SELECT doc_id, {split} AS t FROM documents)""",
        "clean_pages": f"SELECT page_id, {_clean('html')} AS clean FROM pages",
        "clean_pages_unescaped": f"""
SELECT page_id, {_clean(_unescape('html'))} AS clean FROM pages""",
        "corpus_stats": _with(
            _NORMALIZED, select="SELECT n_docs, total_tokens, round(avgdl, 6) AS avgdl FROM stats"
        ),
        "doc_lengths": _with(_NORMALIZED, select="SELECT doc_id, dl FROM lens"),
        "postings": _with(_NORMALIZED, select="SELECT doc_id, term, tf, dl FROM post"),
        "term_df_idf": _with(_NORMALIZED, select=f"SELECT term, df, {idfs} FROM terms"),
        "collection_tf": _with(
            _NORMALIZED,
            select="""SELECT term, sum(tf)::BIGINT AS term_count,
       round(sum(tf) / any_value(total_tokens), 10) AS frequency
FROM post, stats GROUP BY term""",
        ),
        "collection_lookup": _with(
            _NORMALIZED,
            words,
            "totals AS (SELECT term, sum(tf)::BIGINT AS n FROM post GROUP BY term)",
            select="""SELECT term, coalesce(n, 0) AS term_count,
       round(coalesce(n, 0) / total_tokens, 10) AS frequency
FROM words LEFT JOIN totals USING (term), stats""",
        ),
        "idf_lookup": _with(
            _NORMALIZED,
            words,
            "known AS (SELECT term, coalesce(df, 0) AS df FROM words LEFT JOIN terms USING (term))",
            select="""SELECT term, df,
       round(CASE WHEN df > 0 THEN log10(n_docs / df) ELSE 0.0 END, 6) AS idf_standard,
       round(log10((n_docs + 1) / (df + 1)) + 1, 6) AS idf_smoothed,
       round(ln((n_docs - df + 0.5) / (df + 0.5) + 1), 6) AS idf_bm25
FROM known, stats""",
        ),
        "idf_curve": """
SELECT df, round(log10(n / df), 6) AS idf_standard,
       round(log10((n + 1) / (df + 1)) + 1, 6) AS idf_smoothed
FROM (SELECT count(*) AS n, unnest(range(1, count(*) + 1)) AS df FROM documents)""",
        "vocabulary_sorted": _with(
            _NORMALIZED,
            select="SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_index FROM terms",
        ),
        "vocabulary_first_seen": f"""
SELECT term, row_number() OVER (ORDER BY first) - 1 AS term_index
FROM (
  SELECT term, min((doc_id, pos)) AS first
  FROM (SELECT doc_id, unnest(t) AS term, unnest(range(len(t))) AS pos
        FROM (SELECT doc_id, {split} AS t FROM documents))
  GROUP BY term)""",
        "corpus_dedup": """
SELECT min(doc_id) AS doc_id, text FROM documents
WHERE text IS NOT NULL AND text <> '' GROUP BY text""",
        "lemma_map_corpus": _with(
            _NORMALIZED, _LEMMAS, select="SELECT form, lemma FROM lemma_map"
        ),
        "tfidf_weights_whitespace": _with(
            _SPLIT,
            select="""SELECT doc_id, term, round(tf / dl * idf_smoothed, 6) AS weight
FROM post JOIN terms USING (term)""",
        ),
        "tfidf_score": _with(
            _NORMALIZED,
            _QT,
            tfidf,
            select="SELECT query_id, doc_id, round(score, 4) AS score FROM scores",
        ),
        "tfidf_topk": _with(_NORMALIZED, _QT, tfidf, _top(5), select=_TOP_COLUMNS),
        "tfidf_topk_padded": _with(
            _NORMALIZED, _QT, padded, _DENSE, _top(200, "dense"), select=_TOP_COLUMNS
        ),
        "tfidf_search_repeat": _with(
            _SPLIT,
            _query_terms(split),
            search,
            _DENSE,
            _top(3, "dense", "ASC"),
            select=_TOP_COLUMNS,
        ),
        "tfidf_score_docs": _candidate_scores(_NORMALIZED, _QT, search),
        "bm25_score": _with(
            _NORMALIZED,
            _QT,
            bm25,
            select="SELECT query_id, doc_id, round(score, 4) AS score FROM scores",
        ),
        "bm25_topk": _with(_NORMALIZED, _QT, bm25, _top(5), select=_TOP_COLUMNS),
        "bm25_topk_reused": _with(_NORMALIZED, _QT, bm25, _top(5), select=_TOP_COLUMNS),
        "bm25_topk_reloaded": _with(_NORMALIZED, _QT, bm25, _top(5), select=_TOP_COLUMNS),
        "bm25_score_all": _with(
            _NORMALIZED,
            one,
            bm25,
            select="""SELECT doc_id, round(coalesce(score, 0.0), 4) AS score
FROM lens LEFT JOIN scores USING (doc_id)""",
        ),
        "tfidf_topk_text": _with(
            _NORMALIZED,
            _QT,
            tfidf,
            _top(5),
            select=_TOP_COLUMNS.replace("AS score", "AS score, text")
            + " JOIN documents USING (doc_id)",
        ),
        "bm25_topk_text": _with(
            _NORMALIZED,
            _QT,
            bm25,
            _top(5),
            select=_TOP_COLUMNS.replace("AS score", "AS score, text")
            + " JOIN documents USING (doc_id)",
        ),
        "bm25_topk_padded": _with(
            _NORMALIZED, _QT, bm25, _DENSE, _top(700, "dense"), select=_TOP_COLUMNS
        ),
        "bm25_topk_positive": _with(
            _NORMALIZED,
            _QT,
            bm25,
            _DENSE,
            _top(700, "dense"),
            select=_TOP_COLUMNS + " WHERE score > 0",
        ),
        "bm25_topk_lemmas": _with(
            _NORMALIZED,
            _LEMMAS,
            _QT,
            _LEMMA_CORPUS,
            _LEMMA_SCORES,
            _top(5),
            select=_TOP_COLUMNS,
        ),
        "bm25_score_docs": _candidate_scores(_NORMALIZED, _QT, bm25),
        "bm25_score_docs_lemmas": _candidate_scores(
            _NORMALIZED, _LEMMAS, _QT, _LEMMA_CORPUS, _LEMMA_SCORES
        ),
        "bm25_param_sweep": _with(
            _NORMALIZED,
            _QT,
            sweep,
            select="SELECT query_id, doc_id, variant, round(score, 4) AS score FROM sweep",
        ),
        "bm25_param_sweep_topk": _with(
            _NORMALIZED,
            _QT,
            sweep,
            select="""SELECT query_id, variant, rank, doc_id, round(score, 4) AS score FROM (
  SELECT *, row_number() OVER (
    PARTITION BY query_id, variant ORDER BY score::FLOAT DESC, doc_id DESC) AS rank FROM sweep)
WHERE rank <= 10""",
        ),
        "esci_build": _with(
            _EXAMPLES,
            _PRODUCTS,
            _PROCESSED,
            select="""SELECT query_id, product_id, clean_query, clean_product_document,
       relevance_score, split, line_no, esci_label FROM processed""",
        ),
        "esci_csv_roundtrip": _with(
            _EXAMPLES,
            _PRODUCTS,
            _PROCESSED,
            select="""SELECT query_id, product_id, clean_query, clean_product_document,
       relevance_score, split, line_no, esci_label FROM processed""",
        ),
        "esci_csv_split": _with(
            _EXAMPLES,
            _PRODUCTS,
            _PROCESSED,
            select="""SELECT query_id, product_id, clean_query, clean_product_document,
       relevance_score, split, line_no, esci_label FROM processed""",
        ),
        "esci_label_counts": _with(
            _EXAMPLES,
            select="SELECT esci_label, count(*) AS count FROM examples GROUP BY esci_label",
        ),
        "esci_distinct_locales": _with(
            _EXAMPLES, select="SELECT DISTINCT product_locale FROM examples"
        ),
        "esci_distinct_counts": _with(
            _EXAMPLES,
            select="""SELECT count(DISTINCT query_id) AS query_id,
       count(DISTINCT product_id) AS product_id,
       count(DISTINCT product_locale) AS product_locale,
       count(DISTINCT esci_label) AS esci_label FROM examples""",
        ),
        "esci_duplicates": _with(
            _EXAMPLES,
            select=f"SELECT {example_columns} FROM (SELECT *, {dup_keys} FROM examples)"
            " WHERE copies > 1",
        ),
        "esci_duplicate_counts": _with(
            _EXAMPLES,
            select=f"SELECT {example_columns}, count(*) AS count"
            f" FROM (SELECT *, {dup_keys} FROM examples) WHERE copies > 1"
            f" GROUP BY {example_columns}",
        ),
        "esci_profile": _with(
            _EXAMPLES,
            _PRODUCTS,
            _PROCESSED,
            select="\nUNION ALL\n".join(
                f"SELECT '{name}' AS column_name, '{kind}' AS data_type,"
                f" count(*) AS row_count, count({name}) AS non_null_count FROM processed"
                for name, kind in _PROFILE_TYPES
            ),
        ),
        "esci_head": _with(
            _EXAMPLES, select=f"SELECT * FROM examples ORDER BY {order} LIMIT 5"
        ),
        "esci_tail": _with(
            _EXAMPLES,
            select="SELECT * FROM examples ORDER BY "
            + ", ".join(f"{c} DESC" for c in order.split(", "))
            + " LIMIT 4",
        ),
        "sample_documents": """
SELECT doc_id, lang, source FROM documents
ORDER BY md5(concat_ws('|', '42', doc_id::VARCHAR)), doc_id LIMIT 100""",
        "predictions": _with(
            *whole,
            select="""SELECT model, query_id, product_id, round(predicted_score, 4) AS predicted_score,
       relevance_score, line_no, esci_label FROM predictions""",
        ),
        "ndcg_queries": _with(
            *whole,
            _NDCG,
            select="SELECT model, query_id, round(ndcg, 4) AS ndcg FROM per_query",
        ),
        "ndcg_summary": _with(*whole, _NDCG, select=_SUMMARY),
        "ndcg_summary_lemmas": _with(*lemmatized, _NDCG, select=_SUMMARY),
        "predictions_lemmas": _with(
            *lemmatized,
            select="""SELECT model, query_id, product_id, round(predicted_score, 4) AS predicted_score,
       relevance_score, line_no, esci_label FROM predictions""",
        ),
        "esci_build_from_files": _with(
            _EXAMPLES,
            _PRODUCTS,
            _PROCESSED,
            select="""SELECT query_id, product_id, clean_query, clean_product_document,
       relevance_score, split, esci_label FROM processed""",
        ),
        "esci_build_lemmas": _with(
            _EXAMPLES,
            _PRODUCTS,
            *_JUDGEMENT_LEMMAS,
            select="""SELECT query_id, product_id, clean_query, clean_product_document,
       relevance_score, split, line_no, esci_label FROM processed""",
        ),
        "experiment_summary": _with(*whole, _NDCG, select=_SUMMARY),
    }
    for tf, weight in _TF.items():
        for idf in ("standard", "smoothed"):
            result[f"tfidf_weights_{tf}_{idf}"] = _with(
                _NORMALIZED,
                select=f"SELECT doc_id, term, round({weight} * idf_{idf}, 6) AS weight"
                " FROM post JOIN terms USING (term)",
            )
    return result
