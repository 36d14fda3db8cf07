"""Payment-file rows derived from the TPC-H-like test tables.

The monthly payment feed itself is not part of the test data, so the raw
8-column shape is projected from ``orders ⋈ customer ⋈ nation``: one payment
per order, the customer as beneficiary, the nation as municipality/UF and the
order date as the period. Every order becomes exactly one row (nothing is
filtered or sampled); the order-key moduli below only choose which rows
carry a planted defect, so every Silver rule has work: invalid UF, NULL NIS,
malformed and negative values, padded lower-case text. Customers with
several orders in a month give the natural-key duplicates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.schemas import VALID_UFS

# UF assigned to nation keys 0..24.
FEED_UFS = VALID_UFS[:25]
# Order-key moduli that choose which rows carry a planted defect.
BAD_UF_EVERY = 83
NULL_NIS_EVERY = 97
MALFORMED_VALUE_EVERY = 101
NEGATIVE_VALUE_EVERY = 89
MASKED_CPF = "***.000.000-**"


def _brl_text(amount: Column) -> Column:
    """``1234.5`` -> ``'1.234,50'`` (swap the separators of ``format_number``)."""
    return F.translate(F.format_number(amount, 2), ",.", ".,")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def payments_feed(spark: SparkSession, sf_dir: str, with_row_id: bool = False) -> DataFrame:
    """All-string raw rows (``RAW_COLUMNS``), one per order.

    Joins: ``nation`` is broadcast (25 rows by definition); ``orders ⋈
    customer`` is an equality join on the customer key.
    """
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    cust = customer.join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey, "inner")
    # customer grows with the data, so no hint: a sort-merge join spills, and AQE
    # converts it where the measured sides allow.
    rows = orders.join(cust, orders.o_custkey == cust.c_custkey, "inner")

    k = F.col("o_orderkey")
    uf_code = F.element_at(F.array(*[F.lit(u) for u in FEED_UFS]), F.col("n_nationkey") + 1)
    brl = _brl_text(F.col("o_totalprice"))
    cols = [
        F.date_format(F.col("o_orderdate").cast("date"), "yyyyMM").alias("MES_COMPETENCIA"),
        F.when(k % BAD_UF_EVERY == 0, F.lit("XX"))
        .otherwise(F.concat(F.lit(" "), F.lower(uf_code)))
        .alias("UF"),
        F.lpad(F.col("n_nationkey").cast("string"), 7, "0").alias("CODIGO_MUNICIPIO_SIAFI"),
        F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")).alias("NOME_MUNICIPIO"),
        F.lit(MASKED_CPF).alias("CPF_FAVORECIDO"),
        F.when(k % NULL_NIS_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(F.lpad(F.col("o_custkey").cast("string"), 11, "0"))
        .alias("NIS_FAVORECIDO"),
        F.col("c_name").alias("NOME_FAVORECIDO"),
        F.when(k % MALFORMED_VALUE_EVERY == 0, F.lit("abc"))
        .when(k % NEGATIVE_VALUE_EVERY == 0, F.concat(F.lit("-"), brl))
        .otherwise(brl)
        .alias("VALOR_PARCELA"),
    ]
    if with_row_id:
        cols = [k] + cols
    return rows.select(*cols)
