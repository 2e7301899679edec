"""Labelled queries derived from the order and part tables, in the shape of the data set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

EXAMPLES_SQL = """
SELECT l.l_orderkey AS query_id, p0.p_name AS query,
       cast(l.l_partkey AS varchar(20)) AS product_id, l.l_linenumber AS line_no,
       CASE WHEN l.l_linestatus = 'O' THEN 'us' ELSE 'es' END AS product_locale,
       CASE WHEN l.l_quantity <= 40 THEN 1 ELSE 0 END AS small_version,
       CASE WHEN l.l_returnflag = 'A' THEN 'E' WHEN l.l_returnflag = 'R' THEN 'S'
            WHEN l.l_linenumber % 3 = 0 THEN 'I'
            WHEN l.l_linenumber % 3 = 1 THEN 'C' ELSE 'X' END AS esci_label,
       CASE WHEN l.l_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS split
FROM (SELECT *, l_orderkey % (SELECT count(*) FROM {part}) AS query_part FROM {lineitem}) l
JOIN {part} p0 ON p0.p_partkey = l.query_part
"""

PRODUCTS_SQL = """
SELECT cast(p_partkey AS varchar(20)) AS product_id,
       CASE WHEN p_partkey % 4 = 0 THEN 'es' ELSE 'us' END AS product_locale,
       p_name AS product_title,
       CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_type END AS product_description,
       cast(p_size AS varchar(20)) AS product_bullet_point,
       p_brand AS product_brand,
       CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE split_part(p_name, ' ', 1) END AS product_color
FROM {part}
"""


def examples(spark: SparkSession, lineitem: DataFrame, part: DataFrame) -> DataFrame:
    return spark.sql(EXAMPLES_SQL, lineitem=lineitem, part=part)


def products(spark: SparkSession, part: DataFrame) -> DataFrame:
    return spark.sql(PRODUCTS_SQL, part=part)
