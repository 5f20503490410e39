"""The batch flagship: integrate, cleanse, type, report."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.plans import cleanse
from millrace.queries.registry import query, table

ORDER = ("InvoiceNo", "InvoiceDate", "StockCode", "Quantity", "UnitPrice")


def _clean(spark, sf_dir, with_income: bool):
    """Order lines as all-text retail rows, with country and person columns."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation")

    def lines():
        return (
            table(spark, sf_dir, "lineitem")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("l_orderkey").cast("string").alias("InvoiceNo"),
                F.col("l_linenumber").cast("string").alias("StockCode"),
                F.date_format("l_shipdate", "yyyy-MM").alias("InvoiceDate"),
                F.col("l_quantity").cast("string").alias("Quantity"),
                F.col("l_extendedprice").cast("string").alias("UnitPrice"),
                F.col("o_custkey").cast("string").alias("CustomerID"),
                F.col("n_name").alias("Country"),
            )
        )

    # Countries of three regions are in the list; those of the others stay unmatched.
    countries = cleanse.country_codes(
        nation.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .where("r_name IN ('AFRICA', 'ASIA', 'EUROPE')")
        .select(
            F.upper(F.col("r_name")).alias("OFFICIAL LANG CODE"),
            F.substring("n_name", 1, 2).alias("ISO2 CODE"),
            F.col("n_name").alias("LABEL EN"), F.lit("x").alias("ONU CODE"),
        )
    )
    income = None
    if with_income:
        income = table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").cast("string").alias("age"), F.col("s_name").alias("workclass")
        )
    return cleanse.cleanse(
        cleanse.integrate([lines()], countries, income, ORDER, ["workclass"]),
        order=["Quantity", "UnitPrice", "CustomerID"],
        types={"UnitPrice": "double", "Quantity": "double"},
        names={"InvoiceNo": "invoice_num", "StockCode": "stock_code",
               "InvoiceDate": "invoice_date", "Quantity": "quantity", "UnitPrice": "unit_price",
               "CustomerID": "customer_id", "CountryCode": "country_code",
               "CountryName": "country_name", "workclass": "work_class"},
    )


_ROWS = """
    WITH l AS (
      SELECT CAST(l_orderkey AS VARCHAR) AS invoice_num, CAST(l_linenumber AS VARCHAR) AS stock_code,
             strftime(l_shipdate, '%Y-%m') AS invoice_date, CAST(l_quantity AS VARCHAR) AS q,
             CAST(l_extendedprice AS VARCHAR) AS p, CAST(o_custkey AS VARCHAR) AS customer_id,
             n_name, n_regionkey,
             row_number() OVER (ORDER BY CAST(l_orderkey AS VARCHAR), strftime(l_shipdate, '%Y-%m'), CAST(l_linenumber AS VARCHAR),
                                CAST(l_quantity AS VARCHAR), CAST(l_extendedprice AS VARCHAR)) AS pos
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey),
    clean AS (
      SELECT invoice_num, stock_code, invoice_date, CAST(q AS DOUBLE) AS quantity,
             CAST(p AS DOUBLE) AS unit_price, customer_id, r_name AS country_code, pos,
             CASE WHEN r_name IS NOT NULL THEN n_name END AS country_name
      FROM l LEFT JOIN (SELECT * FROM region WHERE r_name IN ('AFRICA', 'ASIA', 'EUROPE'))
        ON n_regionkey = r_regionkey
      QUALIFY row_number() OVER (PARTITION BY invoice_num, invoice_date, stock_code
                                 ORDER BY q, p, customer_id) = 1)"""


@query("retail_clean", _ROWS + """
    SELECT invoice_num, stock_code, invoice_date, quantity, unit_price, customer_id, country_code,
           country_name FROM clean""")
def retail_clean(spark, sf_dir):
    return _clean(spark, sf_dir, with_income=False).select(
        "invoice_num", "stock_code", "invoice_date", "quantity", "unit_price", "customer_id",
        "country_code", "country_name",
    )


@query("retail_report", _ROWS + """
    SELECT country_name, count(*) AS n_lines,
           count(*) FILTER (WHERE pos <= (SELECT count(*) FROM supplier)) AS n_people, sum(quantity) AS quantity,
           round(sum(unit_price * quantity), 2) AS revenue
    FROM clean GROUP BY country_name""")
def retail_report(spark, sf_dir):
    return cleanse.country_report(_clean(spark, sf_dir, with_income=True))
