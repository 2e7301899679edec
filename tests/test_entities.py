"""HTML character references against the standard library."""

from __future__ import annotations

import html
from html.entities import html5

from pyspark.sql import functions as F

from tallyrank.functions import entities

NUMBERS = [
    *range(260), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFDEF, 0xFFFE, 0xFFFF, 0x10000, 0x1FFFE,
    0x10FFFF, 0x110000, 99_999_999, 10**21,
]
ODD = [
    "", "no", "&", "&&", "&;", "&#;", "&#x;", "&#xg;", "a&b", "&notit;", "&amp;amp;", "&AMP", "&lt&gt",
    "&#00065;", "&#X41", "&copy2013", "&" + "a" * 50 + ";", "&é;", "x & y", "&amp", "&am", "a\n&lt;\n",
]


def test_equals_the_library(spark):
    cases = [f"a&{name}b" for name in html5]
    cases += [f"&{name.rstrip(';')}x; &{name.rstrip(';')}" for name in html5]
    cases += [f"&#{n};z" for n in NUMBERS] + [f"&#x{n:x}z" for n in NUMBERS] + ODD
    df = spark.createDataFrame(list(enumerate(cases)), "i int, t string")
    got = {r[0]: r[1] for r in df.select("i", entities.unescape(F.col("t"))).collect()}
    assert [c for i, c in enumerate(cases) if got[i] != html.unescape(c)] == []


def test_no_python_worker(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    plan = pages.select(entities.unescape(F.col("html")))._jdf.queryExecution().executedPlan()
    assert "EvalPython" not in plan.toString() and "MapIn" not in plan.toString()
