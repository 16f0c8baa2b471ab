"""Listings in the raw shape, derived from the star-schema tables.

One SELECT that reads the same in Spark SQL and in DuckDB. It holds NULL and blank
titles, NULL and non-http urls, urls repeated within and across sources, every
spelling of a location, and the salary shapes that the dialects treat apart.
"""

from pyspark.sql import DataFrame, SparkSession

from rolecall.sources.readers import parquet_scan

LISTING_FIELDS = """
  CASE WHEN l_linenumber % 2 = 0 THEN 'itviec' ELSE 'topcv' END AS source,
  CASE l_orderkey % 5 WHEN 0 THEN 'data-engineer' WHEN 1 THEN 'big-data'
       WHEN 2 THEN 'data-science' ELSE 'data analyst' END AS keyword,
  CASE WHEN l_orderkey % 101 = 0 THEN NULL WHEN l_orderkey % 103 = 0 THEN '   '
       ELSE '  ' || CASE p_partkey % 6
            WHEN 0 THEN 'Senior Data Engineer (Python/Spark)'
            WHEN 1 THEN 'Data Analyst - SQL, Power BI'
            WHEN 2 THEN 'Java/JavaScript Developer'
            WHEN 3 THEN 'DevOps Engineer AWS & Docker'
            WHEN 4 THEN 'C# .NET Developer' ELSE 'Golang Backend' END
            || ' ' || p_name || ' ' END AS title,
  CASE WHEN l_orderkey % 97 = 0 THEN NULL
       WHEN l_orderkey % 89 = 0 THEN 'ftp://jobs.example.test/' || CAST(l_partkey AS STRING)
       ELSE 'https://jobs.example.test/' || CAST(l_partkey AS STRING) END AS url,
  CASE WHEN l_suppkey % 17 = 0 THEN NULL ELSE s_name END AS company,
  CASE s_nationkey % 9 WHEN 0 THEN 'Hồ Chí Minh' WHEN 1 THEN 'Quận 1, HCM'
       WHEN 2 THEN 'Hà Nội' WHEN 3 THEN 'Hanoi' WHEN 4 THEN 'Đà Nẵng'
       WHEN 5 THEN 'Danang' WHEN 6 THEN 'Remote' WHEN 7 THEN 'Binh Duong'
       ELSE NULL END AS location,
  CASE l_linenumber % 3 WHEN 0 THEN 'At office' WHEN 1 THEN 'Remote'
       ELSE 'Hybrid' END AS work_type,
  CASE l_orderkey % 10
       WHEN 0 THEN '$1,' || CAST(500 + CAST(l_quantity AS INT) AS STRING) || ' - $3,000'
       WHEN 1 THEN '1,' || CAST(100 + CAST(l_quantity AS INT) AS STRING) || ' - 3,000 USD'
       WHEN 2 THEN CAST(CAST(l_quantity AS INT) AS STRING) || ' - '
                   || CAST(CAST(l_quantity AS INT) + 15 AS STRING) || ' triệu'
       WHEN 3 THEN 'Up to $2,000' WHEN 4 THEN 'From $1,000'
       WHEN 5 THEN 'Thỏa thuận' WHEN 6 THEN 'Login to view'
       WHEN 7 THEN CAST(20 + l_linenumber AS STRING) || ',000,000 - 35,000,000 VND'
       WHEN 8 THEN '15k' ELSE NULL END AS salary,
  CASE p_partkey % 4 WHEN 0 THEN '["Kafka","Airflow","ETL"]'
       WHEN 1 THEN '["SQL","Tableau"]' WHEN 2 THEN '[]' ELSE NULL END AS tags,
  'Posted ' || CAST(l_linenumber AS STRING) || ' days ago' AS posted"""

# crawl order and the yearly batch of a listing
BATCH_FIELDS = """,
  l_orderkey AS crawl_order, l_linenumber AS crawl_line,
  substr(CAST(CAST(l_shipdate AS DATE) AS STRING), 1, 4) || '-01-01' AS batch_date"""


def _table(name: str, braces: bool) -> str:
    return f"{{{name}}}" if braces else name


def listings_sql(batches: bool = False, braces: bool = False) -> str:
    fields = LISTING_FIELDS + (BATCH_FIELDS if batches else "")
    return (
        f"SELECT {fields}\nFROM {_table('lineitem', braces)} JOIN {_table('part', braces)} ON l_partkey = p_partkey\n"
        f"  JOIN {_table('supplier', braces)} ON l_suppkey = s_suppkey"
    )


def listings(spark: SparkSession, sf_dir: str, batches: bool = False) -> DataFrame:
    tables = {t: parquet_scan(spark, f"{sf_dir}/{t}.parquet") for t in ("lineitem", "part", "supplier")}
    return spark.sql(listings_sql(batches, braces=True), **tables)
