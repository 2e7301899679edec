from __future__ import annotations

import random

import pytest

from tallyrank import schemas
from tallyrank.operators import profile
from tallyrank.operators.index import CorpusIndex
from tallyrank.plans import experiment, judgements, registry
from tallyrank.plans.dataset import build_dataset
from tallyrank.sources import tables

EXAMPLES = [
    (1, "Red <b>Shoes</b>", "p1", "us", 1, "E", "train"),
    (1, "Red <b>Shoes</b>", "p2", "us", 1, "s", "train"),
    (2, None, "gone", "us", 1, "C", "test"),
    (2, None, "p1", "us", 1, "x", "test"),
    (3, "hat", "p1", "es", 1, "E", "test"),
    (3, "hat", "p1", "us", 0, "E", "test"),
    (4, "hat", "p3", "us", 1, None, "test"),
]
PRODUCTS = [
    ("p1", "us", "Shoe &amp; Box", None, "of wood", "Acme", "red"),
    ("p1", "es", "zapato", None, None, None, None),
    ("p2", "us", "Blue shoe", "The best", None, None, None),
    ("p3", "us", "one", None, None, None, None),
    ("p3", "us", "two", None, None, None, None),
]


@pytest.fixture(scope="module")
def built(spark):
    examples = spark.createDataFrame(EXAMPLES, schemas.EXAMPLES)
    products = spark.createDataFrame(PRODUCTS, schemas.PRODUCTS)
    return build_dataset(examples, products)


def test_build(built):
    got = {tuple(r) for r in built.collect()}
    assert got == {
        (1, "p1", "red shoes", "shoe box wood acme red", 1.0, "train"),
        (1, "p2", "red shoes", "blue shoe best", 0.6, "train"),
        (2, "gone", "", "", 0.0, "test"),
        (2, "p1", "", "shoe box wood acme red", None, "test"),
        (4, "p3", "hat", "one", None, "test"),
        (4, "p3", "hat", "two", None, "test"),
    }
    assert built.columns == schemas.PROCESSED.fieldNames()


def test_build_with_lemmas(spark):
    examples = spark.createDataFrame(EXAMPLES, schemas.EXAMPLES)
    products = spark.createDataFrame(PRODUCTS, schemas.PRODUCTS)
    lemmas = spark.createDataFrame([("shoes", "shoe"), ("best", "good")], "form string, lemma string")
    rows = build_dataset(examples, products, lemmas=lemmas).collect()
    assert len(rows) == 6
    got = {(r["product_id"], r["clean_query"], r["clean_product_document"]) for r in rows}
    assert ("p2", "red shoe", "blue shoe good") in got
    assert ("gone", "", "") in got


def test_filters_reach_both_scans(spark, tmp_path):
    spark.createDataFrame(EXAMPLES, schemas.EXAMPLES).write.parquet(f"{tmp_path}/ex")
    spark.createDataFrame(PRODUCTS, schemas.PRODUCTS).write.parquet(f"{tmp_path}/pr")
    built = build_dataset(
        tables.read_examples(spark, f"{tmp_path}/ex"), tables.read_products(spark, f"{tmp_path}/pr")
    )
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(small_version,1)" in plan
    assert plan.count("EqualTo(product_locale,us)") == 2
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_processed_round_trip(spark, built, tmp_path, fmt):
    path = f"{tmp_path}/new/folder/{fmt}"
    tables.write_processed(built, path, fmt)
    back = tables.read_processed(spark, path, fmt)
    assert back.schema.fieldNames() == schemas.PROCESSED.fieldNames()
    assert [f.dataType for f in back.schema] == [f.dataType for f in schemas.PROCESSED]
    key = lambda r: tuple(str(v or "") for v in r)
    assert sorted(map(key, back.collect())) == sorted(map(key, built.collect()))


def test_pandas_missing_words(spark, tmp_path):
    rows = [(1, "p", "nan", "none", 1.0, "train"), (1, "q", "null", "NA", 1.0, "train")]
    df = spark.createDataFrame(rows, schemas.PROCESSED)
    tables.write_processed(df, f"{tmp_path}/c", "csv")
    kept = tables.read_processed(spark, f"{tmp_path}/c", "csv").collect()
    assert {r["clean_query"] for r in kept} == {"nan", "null"}
    lost = tables.read_processed(spark, f"{tmp_path}/c", "csv", csv_na_compat=True).collect()
    assert {(r["clean_query"], r["clean_product_document"]) for r in lost} == {
        (None, "none"), (None, None)
    }


def test_missing_columns_are_named(spark, built, tmp_path):
    broken = built.drop("split", "query_id")
    with pytest.raises(ValueError, match="query_id.*split"):
        experiment.run(broken, f"{tmp_path}/m")
    tables.write_processed(broken, f"{tmp_path}/b", "csv")
    with pytest.raises(ValueError, match="columns not found"):
        tables.read_processed(spark, f"{tmp_path}/b", "csv")
    with pytest.raises(ValueError, match="format"):
        tables.write_processed(built, f"{tmp_path}/x", "json")


def test_sources_csv(spark, tmp_path):
    (tmp_path / "s.csv").write_text("query_id,source\n1,web\n")
    assert tables.read_sources(spark, f"{tmp_path}/s.csv").first().asDict() == {
        "query_id": "1", "source": "web"
    }


def test_experiment_fit_load_reuse(spark, built, tmp_path):
    model = f"{tmp_path}/model"
    with pytest.raises(FileNotFoundError):
        experiment.run(built, model, do_fit=False)
    assert experiment.run(built, model, do_predict=False) is None
    first = CorpusIndex.load(spark, model).stats.first()
    assert first["n_docs"] == 2
    summary = experiment.run(built, model, do_fit=False).collect()
    assert {r["model"] for r in summary} == {"tfidf", "bm25"}
    # A fit over other data reuses the saved index, unless told to overwrite it.
    more = built.unionByName(
        spark.createDataFrame([(9, "p9", "x", "new words", 1.0, "train")], schemas.PROCESSED)
    )
    experiment.fit(more.where("split = 'train'"), model)
    assert CorpusIndex.load(spark, model).stats.first()["n_docs"] == 2
    experiment.fit(more.where("split = 'train'"), model, overwrite=True)
    assert CorpusIndex.load(spark, model).stats.first()["n_docs"] == 3


def test_load_names_the_missing_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="fit it first"):
        CorpusIndex.load(spark, f"{tmp_path}/nothing")


def test_csv_cells_of_any_kind_come_back(spark, tmp_path):
    cells = ['a "big" one, red', "two\nlines", "comma, quote\" ", " blanks ", "", None, "back\\slash"]
    rows = [(i, f"p{i}", c, c, 0.5, "train") for i, c in enumerate(cells)]
    df = spark.createDataFrame(rows, schemas.PROCESSED)
    tables.write_processed(df, f"{tmp_path}/q", "csv")
    back = tables.read_processed(spark, f"{tmp_path}/q", "csv")
    assert sorted(map(str, map(tuple, back.collect()))) == sorted(map(str, rows))


def test_csv_of_another_writer(spark, tmp_path):
    text = 'name,note\n"a ""big"" one, red","x\ny"\n'
    (tmp_path / "s.csv").write_text(text)
    (row,) = tables.read_sources(spark, f"{tmp_path}/s.csv").collect()
    assert tuple(row) == ('a "big" one, red', "x\ny")


def test_examples_with_other_integer_types(spark, tmp_path):
    rows = [(1, "q", "p", "us", 1, "E", "train")]
    names = schemas.EXAMPLES.fieldNames()
    wide = spark.createDataFrame(rows, names)  # every number is a BIGINT
    wide.withColumn("more", wide.query_id).write.parquet(f"{tmp_path}/e")
    got = tables.read_examples(spark, f"{tmp_path}/e")
    assert got.schema == schemas.EXAMPLES
    assert [tuple(r) for r in got.collect()] == rows
    wide.drop("split").write.parquet(f"{tmp_path}/f")
    with pytest.raises(ValueError, match="split"):
        tables.read_examples(spark, f"{tmp_path}/f")


def test_judgements_use_every_product_and_query(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    examples = judgements.examples(spark, lines, part)
    assert examples.count() == lines.count()
    joined = lines.selectExpr("l_orderkey AS query_id").distinct()
    assert examples.select("query_id").distinct().count() == joined.count()
    names = {r[0] for r in part.select("p_name").collect()}
    assert {r[0] for r in examples.select("query").distinct().collect()} == names
    assert judgements.products(spark, part).count() == part.count()


CELLS = ["a", "", None, "nan", 'say "hi"', "two\nlines", "three\n\n\"lines\"\n", "a,b", " c ", '"', "\n", '"\n"', "ü\n字" * 40]


@pytest.mark.parametrize("most", [60, 700])
def test_split_csv_equals_the_one_task_reader(spark, tmp_path, most):
    rng = random.Random(4)
    rows = [(str(i), rng.choice(CELLS), rng.choice(CELLS), "end") for i in range(150)]
    df = spark.createDataFrame(rows, "id string, x string, y string, z string")
    for name, parts in (("one", 1), ("many", 3)):
        path = f"{tmp_path}/{name}"
        df.repartition(parts).write.options(**tables._CSV).csv(path)
        want = tables.read_sources(spark, path).collect()
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        try:
            tasks = spark.read.text(path, lineSep="\n").rdd.getNumPartitions()
            back = tables.read_sources(spark, path, splits=True)
            got = back.collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert tasks > 5
        assert back.columns == df.columns
        assert len(want) == 150
        assert sorted(map(tuple, got), key=lambda r: int(r[0])) == sorted(map(tuple, want), key=lambda r: int(r[0]))


@pytest.mark.parametrize("text", ["a,b\n", "a,b", 'a,b\r\n1,"x\r\ny"\r\n\r\n2,z\r\n', 'a,b\n1\n2,"",\n3,,\n\n4,"q"'])
def test_split_csv_of_odd_files(spark, tmp_path, text):
    (tmp_path / "s.csv").write_bytes(text.encode())
    want = tables.read_sources(spark, f"{tmp_path}/s.csv").collect()
    got = tables.read_sources(spark, f"{tmp_path}/s.csv", splits=True).collect()
    assert sorted(got, key=str) == sorted(want, key=str)


def test_split_csv_sends_no_file_through_one_task(spark, tmp_path):
    for part in ("one", "two"):
        (tmp_path / f"{part}.csv").write_text('a,b\n1,"x\ny"\n2,z\n')
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        back = tables.read_sources(spark, str(tmp_path), splits=True)
        plan = back._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, back.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert got == [("1", "x\ny"), ("1", "x\ny"), ("2", "z"), ("2", "z")]


def test_the_split_csv_query_writes_by_many_tasks(spark, sf_dir, monkeypatch):
    plans = []
    write = tables.write_processed

    def watched(df, *args, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, *args, **options)

    monkeypatch.setattr(tables, "write_processed", watched)
    registry.queries()["esci_csv_split"](spark, sf_dir)
    assert len(plans) == 1 and "Coalesce 1" not in plans[0]


def test_distinct_counts_repeat_no_rows(spark):
    rows = [(i % 7 if i % 5 else None, str(i % 3), float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "a long, b string, c double")
    counted = profile.n_distinct(df, ["a", "b", "c"])
    assert counted.first().asDict() == {"a": 7, "b": 3, "c": 100}
    assert "Expand" not in counted._jdf.queryExecution().executedPlan().toString()
    assert profile.n_distinct(df.limit(0), ["a", "b"]).first().asDict() == {"a": 0, "b": 0}
