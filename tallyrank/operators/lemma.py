"""Noun lemmas by joining the vocabulary, not by looking at tokens one at a time.

The work runs on distinct word forms. ``nouns(word)`` says which candidates are words and
``exceptions(form, lemma)`` lists irregular forms; both are tables of the user. Without
them, ``corpus_lemma_map`` takes the vocabulary itself as the list of words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrank.functions.text import STOPWORDS
from tallyrank.operators.skew import fits_broadcast, hot_keys, lookup_join, shuffle_partitions

# Noun endings and their replacements, in order.
NOUN_SUFFIXES = (
    ("s", ""),
    ("ses", "s"),
    ("ves", "f"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
)


def _candidates(forms: DataFrame) -> DataFrame:
    """(form, candidate, ord): the form itself first, then each suffix rule that fits."""
    form = F.col("form")
    options = [F.struct(form.alias("candidate"), F.lit(0).alias("ord"))]
    for ord_, (suffix, ending) in enumerate(NOUN_SUFFIXES, 1):
        stem = F.left(form, F.length(form) - len(suffix))
        candidate = F.when(F.endswith(form, F.lit(suffix)), F.concat(stem, F.lit(ending)))
        options.append(F.struct(candidate.alias("candidate"), F.lit(ord_).alias("ord")))
    exploded = forms.select("form", F.explode(F.array(*options)).alias("c"))
    return exploded.select("form", "c.candidate", "c.ord").where(F.col("candidate").isNotNull())


def lemma_map(
    forms: DataFrame, nouns: DataFrame, exceptions: DataFrame | None = None
) -> DataFrame:
    """(form, lemma) for every distinct form.

    The shortest candidate that is a noun wins, earlier candidates first among equals; a
    form without such a candidate is its own lemma. A form listed in ``exceptions`` takes
    its candidates from there instead of the suffix rules.
    """
    forms = forms.select("form").distinct()
    candidates = _candidates(forms)
    if exceptions is not None:
        listed = exceptions.select("form", F.col("lemma").alias("candidate"))
        irregular = listed.select("form").distinct()
        by_rule = candidates.where("ord > 0").join(irregular, "form", "left_anti")
        by_list = listed.join(forms, "form", "left_semi").withColumn("ord", F.lit(1))
        candidates = candidates.where("ord = 0").unionByName(by_rule).unionByName(by_list)
    words = nouns.select(F.col("word").alias("candidate")).distinct()
    kept = candidates.join(words, "candidate", "left_semi")
    best = kept.groupBy("form").agg(
        F.min(F.struct(F.length("candidate").alias("len"), "ord", "candidate")).alias("best")
    )
    return forms.join(best, "form", "left").select(
        "form", F.coalesce("best.candidate", "form").alias("lemma")
    )


def corpus_lemma_map(forms: DataFrame) -> DataFrame:
    """Lemma map in which a candidate counts as a word if the corpus itself uses it."""
    return lemma_map(forms, forms.select(F.col("form").alias("word")))


def effective_map(lemmas: DataFrame, passes: int = 1) -> DataFrame:
    """What ``passes`` rounds of (drop stopwords, lemmatize) do to a form.

    Only forms that change are kept. The lemma is NULL where a later round drops the
    token, because its lemma from the round before is a stopword. Of a form listed with
    several lemmas the first one in order counts.
    """
    if passes < 1:
        raise ValueError("passes must be at least 1")
    step = lemmas.groupBy("form").agg(F.min("lemma").alias("lemma"))
    result = step
    for _ in range(passes - 1):
        again = step.select(F.col("form").alias("lemma"), F.col("lemma").alias("next"))
        kept = F.when(~F.col("lemma").isin(*STOPWORDS), F.coalesce("next", "lemma"))
        result = result.join(again, "lemma", "left").select("form", kept.alias("lemma"))
    changed = F.col("lemma").isNull() | (F.col("lemma") != F.col("form"))
    return result.where(changed & ~F.col("form").isin(*STOPWORDS))


def lemmatize(
    df: DataFrame, term: str, effective: DataFrame, dim_rows: int | None, dim_bytes: int = 0
) -> DataFrame:
    """Replace ``term`` by its lemma; NULL where the token is dropped.

    Beyond the broadcast limit the terms that many rows share are spread over tasks, and so
    are the rows without a term.
    """
    mapped = effective.select(
        F.col("form").alias(term), F.struct(F.col("lemma").alias("to")).alias("_lemma")
    )
    skew = {}
    if not fits_broadcast(dim_rows, None, dim_bytes):
        counts = df.groupBy(term).agg(F.count(F.lit(1)).alias("_rows"))
        hot = hot_keys(counts, [term], "_rows", shuffle_partitions(df.sparkSession))
        skew = {"hot": hot, "spread_by": [F.col(c) for c in df.columns if c != term]}
    joined = lookup_join(df, mapped, [term], "left", dim_rows=dim_rows, dim_bytes=dim_bytes, **skew)
    lemma = F.when(F.col("_lemma").isNull(), F.col(term)).otherwise(F.col("_lemma.to"))
    return joined.withColumn(term, lemma).drop("_lemma").select(*df.columns)


def text_digest(col: Column | str) -> Column:
    """A 32-byte key for a text, so that long texts are not carried along with each token."""
    text = F.col(col) if isinstance(col, str) else col
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def join_lemmas(
    texts: DataFrame, effective: DataFrame, dim_rows: int | None, dim_bytes: int = 0
) -> DataFrame:
    """(digest, clean): the tokens of each text, lemmatized and joined in order.

    ``texts(digest, tokens)`` may repeat a text; each is handled once. A text is regrouped
    from its own tokens only.
    """
    placed = texts.dropDuplicates(["digest"]).select("digest", F.posexplode_outer("tokens").alias("pos", "term"))
    mapped = lemmatize(placed, "term", effective, dim_rows, dim_bytes)
    kept = F.when(F.col("term").isNotNull(), F.struct("pos", "term"))
    regrouped = mapped.groupBy("digest").agg(F.sort_array(F.collect_list(kept)).alias("kept"))
    return regrouped.select("digest", F.array_join("kept.term", " ").alias("clean"))
