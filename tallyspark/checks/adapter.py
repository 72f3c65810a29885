"""Transactions derived from the order and part tables.

The given tables hold no bank transactions, so each order becomes one raw
transaction row of text columns: its description is a phrase chosen by the
order key, the name of a part and, for some, a payee name or a reference
number.  Missing, malformed and contradictory values are mixed in by further
keys.  Every order is read, and every part that an order's key falls to, counted round all parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators import clean

AS_OF = "2026-01-01"
LOADED_BEFORE = "1999-01-01"

# The same text runs on Spark and on the SQL oracle.
RAW_SQL = """
SELECT
  CAST(k AS STRING) AS id,
  CAST(k + 1 AS STRING) AS voucher_id,
  CASE WHEN k % 113 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS consumer_id,
  CASE WHEN k % 79 = 0 THEN 'Refund' WHEN k % 83 = 0 THEN NULL
       WHEN o_orderstatus = 'F' THEN ' Expense' WHEN o_orderstatus = 'O' THEN 'Income '
       ELSE 'Transfer' END AS vch_type,
  CASE WHEN k % 109 = 0 THEN 'abc'
       ELSE CAST(CAST(CASE WHEN k % 89 = 0 THEN -o_totalprice WHEN k % 97 = 0 THEN 0
                           ELSE o_totalprice END AS DECIMAL(18,2)) AS STRING) END AS vch_amount,
  CASE WHEN k % 73 = 0 THEN NULL WHEN k % 71 = 0 THEN '2099-01-01' WHEN k % 127 = 0 THEN '2026-13-40'
       ELSE CAST(d AS STRING) END AS vch_date,
  CAST(CASE WHEN k % 107 = 0 THEN year(d) + 1 ELSE year(d) END AS STRING) AS vch_year,
  CAST(month(d) AS STRING) AS vch_month,
  CAST(day(d) AS STRING) AS vch_day,
  CASE WHEN k % 131 = 0 THEN 'soon' ELSE CAST(d AS STRING) || ' 12:30:00' END AS vch_created_on,
  CASE WHEN k % 101 = 0 THEN NULL WHEN k % 103 = 0 THEN '   '
       ELSE CASE CAST(k % 17 AS INT)
              WHEN 0 THEN 'Petrol' WHEN 1 THEN 'petrol 500' WHEN 2 THEN 'KFC  dinner'
              WHEN 3 THEN 'careem ride' WHEN 4 THEN 'electricity bill'
              WHEN 5 THEN 'medicine, doctor' WHEN 6 THEN 'daraz shopping'
              WHEN 7 THEN 'cash withdrawal' WHEN 8 THEN 'monthly salary'
              WHEN 9 THEN 'milk & bread' WHEN 10 THEN 'sabzi' WHEN 11 THEN 'cash'
              WHEN 12 THEN 'toll tax' WHEN 13 THEN 'netflix subscription'
              WHEN 14 THEN 'petrol + milk' WHEN 15 THEN 'online deposit' ELSE 'adjustment' END
           || CASE WHEN k % 3 = 0 THEN '' ELSE ' ' || p_name END
           || CASE WHEN k % 5 = 0 THEN ' from ' || translate(CAST(o_custkey AS STRING), '0123456789', 'abcdefghij')
                   ELSE '' END
           || CASE WHEN k % 7 = 0 THEN ' #' || CAST(k AS STRING) ELSE '' END END AS vch_desc,
  CASE WHEN k % 10 = 3 THEN CAST(CAST(o_totalprice / 100 AS DECIMAL(18,4)) AS STRING) ELSE '0' END AS fc_amount,
  CASE WHEN k % 10 = 3 THEN CAST(CAST(o_totalprice / 1000000 AS DECIMAL(18,8)) AS STRING) ELSE NULL END AS fc_rate,
  CAST(p_size AS STRING) AS account_id,
  CAST(d AS STRING) || ' 08:00:00' AS record_created_on,
  CASE WHEN k % 61 = 0 THEN NULL WHEN k % 137 = 0 THEN 'n/a' WHEN k % 139 = 0 THEN '20000'
       ELSE CAST((k % 17) * 3 + (CASE WHEN k % 10 = 0 THEN 1 ELSE 0 END) AS STRING)
            || CASE WHEN k % 4 = 0 THEN '.0' ELSE '' END END AS category_id,
  CASE WHEN k % 9 = 0 THEN '' WHEN k % 11 = 0 THEN NULL WHEN k % 149 = 0 THEN 'nan' ELSE ' ' || o_orderpriority || ' ' END
    AS use_case_title
FROM (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_totalprice,
         CAST(o_orderdate AS DATE) AS d, o_orderpriority, p_name, p_size
  FROM {orders} JOIN {part} ON p_partkey = o_orderkey % (SELECT count(*) FROM {part})
) AS base
"""

# Messages as one JSON text each; some are cut off, some lack or misspell a field.
MESSAGE_SQL = """
SELECT CAST(k + 1 AS BIGINT) AS seq,
  CASE WHEN k % 53 = 0 THEN '{{"voucher_id": '
  ELSE '{{"voucher_id": ' || CASE WHEN k % 59 = 0 THEN 'null' WHEN k % 41 = 0 THEN '7' ELSE CAST(k + 1 AS STRING) END
    || ', "consumer_id": ' || CAST(o_custkey AS STRING)
    || ', "transaction_type": ' || CASE WHEN o_orderstatus = 'F' THEN '"Expense"' WHEN o_orderstatus = 'O' THEN '"Income"' ELSE '"Transfer"' END
    || ', "amount": ' || CASE WHEN k % 67 = 0 THEN 'null' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END
    || ', "transaction_date": ' || CASE WHEN k % 43 = 0 THEN '"2026-13-03"' WHEN k % 47 = 0 THEN '"2026-9-3"' WHEN k % 37 = 0 THEN 'null' WHEN k % 31 = 0 THEN '""' ELSE '"' || CAST(d AS STRING) || '"' END
    || ', "description": "order ' || CAST(k AS STRING) || '"}}' END AS value
FROM (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS d
  FROM {orders}
) AS base
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_of():
    return F.lit(AS_OF).cast("date")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text rows."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    return spark.sql(RAW_SQL, orders=table(spark, sf_dir, "orders"), part=part)


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.typed(raw(spark, sf_dir))


def production(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.to_production(raw(spark, sf_dir), as_of())


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(MESSAGE_SQL, orders=table(spark, sf_dir, "orders"))


def loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an earlier load left in the target: production rows dated before the cut-over."""
    return production(spark, sf_dir).filter(
        F.col("transaction_date") < F.lit(LOADED_BEFORE).cast("date")
    )


def edge(df: DataFrame) -> DataFrame:
    """Plain types for comparison with other engines: decimals as doubles, dates as text."""
    out = {}
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind == "decimal":
            out[field.name] = F.col(field.name).cast("double")
        elif kind in ("date", "timestamp", "timestamp_ntz"):
            out[field.name] = F.col(field.name).cast("string")
    return df.withColumns(out) if out else df
