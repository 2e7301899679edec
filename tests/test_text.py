from __future__ import annotations

import html
import re

import brute
import pytest
from pyspark.sql import functions as F

from tallyrank.functions import text


def _one(spark, rows, fn):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(fn("x")).collect()]


def test_clean_text_fixed_cases(spark):
    cases = {
        "Caf&eacute; <b>The</b> Shoe's": "caf shoe",
        "a &amp;nbsp; b": "b",
        "&lt;i&gt;Red&lt;/i&gt;": "red",
        "x <b\n> y": "x b y",
        "İstanbul": "stanbul",
        "": "",
        None: "",
    }
    assert _one(spark, list(cases), text.clean_text) == list(cases.values())


def test_unescape_equals_standard_library(spark):
    rows = [
        "no entity", "a & b", "&copy;&middot;", "&ampx", "&notit;", "&#65;&#x42;", "&#128;",
        "&quot fish", "&unknown;", "&&amp;&", "&#0;", "&lt;b&gt;", None,
    ]
    expected = [html.unescape(r or "") for r in rows]
    assert _one(spark, rows, text.html_unescape) == expected


def test_clean_text_equals_python_on_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html")
    got = pages.select("page_id", "html", text.clean_text("html").alias("clean")).collect()
    for row in got:
        plain = re.sub(r"<.*?>|&nbsp;", " ", html.unescape(row["html"]))
        assert row["clean"] == " ".join(brute.split(plain))


def test_stopwords_and_repeats(spark):
    (tokens,) = _one(spark, ["The dog, the DOG and a cat-dog"], text.raw_tokens)
    assert tokens == ["dog", "dog", "cat", "dog"]


def test_whitespace_tokens_equal_python_split(spark):
    rows = ["My dog is\tthe BEST!", " \x1c lead \x85 trail  ", "", "a　b​c"]
    got = _one(spark, rows, text.whitespace_tokens)
    assert got == [r.lower().split() for r in rows]


def test_null_and_empty_give_no_tokens(spark):
    assert _one(spark, [None, "", "  ", "the"], text.raw_tokens) == [[], [], [], []]


def test_unknown_tokenizer(spark):
    with pytest.raises(ValueError, match="tokenizer"):
        text.tokens(F.lit("x"), "stem")
