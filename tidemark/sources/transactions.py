"""Raw retail transactions: CSV files, or a star schema of orders and lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import any_of

# Everything is read as text; cleaning parses it and counts what does not parse.
RAW_CSV_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "InvoiceNo",
            "StockCode",
            "Description",
            "Quantity",
            "InvoiceDate",
            "UnitPrice",
            "CustomerID",
            "Country",
        )
    ]
)


def read_transactions_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV scan of files in UTF-8 or ISO-8859-1, also of both in one folder.

    A file is UTF-8 if all its values are valid UTF-8, else ISO-8859-1; one file never
    changes how another one is read.  Every byte is a character of ISO-8859-1, so that
    reading loses nothing before that is known.  Nothing is scanned here: a query reads
    the files once to find those that are not UTF-8 (a row for each of these) and once for itself.
    """
    # Columns are matched by header name, so extra or reordered columns are fine.
    raw = (
        spark.read.option("header", True)
        .option("encoding", "ISO-8859-1")
        .option("escape", '"')
        .option("inferSchema", False)
        .csv(path)
    )
    names = raw.columns
    filed = raw.select("*", F.col("_metadata.file_path").alias("__file"))

    def as_read(name: str) -> Column:
        return F.encode(F.col(f"`{name}`"), "ISO-8859-1")

    wrong = any_of([~F.coalesce(F.is_valid_utf8(as_read(c)), F.lit(True)) for c in names])
    latin = filed.where(wrong).select("__file").distinct().withColumn("__latin", F.lit(True))
    marked = filed.join(F.broadcast(latin), "__file", "left")

    def decoded(name: str) -> Column:
        return F.when(F.col("__latin").isNull(), F.decode(as_read(name), "UTF-8")).otherwise(F.col(f"`{name}`"))

    def plain(name: str) -> str:
        try:
            return name.encode("iso-8859-1").decode("utf-8").removeprefix("\ufeff")
        except UnicodeError:
            return name

    return marked.select(*[decoded(c).alias(plain(c)) for c in names])


def transactions_from_star(spark: SparkSession, folder: str) -> DataFrame:
    """Retail transactions derived from lineitem, orders, customer, nation and part.

    Returns, cancellations, free items, bulk lines and guests follow from the
    keys alone, so the same rows come out wherever this is evaluated.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")

    lines = table("lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"
    )
    orders = table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table("customer").select("c_custkey", "c_nationkey")
    nations = table("nation").select("n_nationkey", "n_name")
    parts = table("part").select("p_partkey", "p_name")

    key = F.col("l_orderkey")
    returned = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    invoice = F.concat(
        F.when(returned & (key % 2 == 0), F.lit("C")).otherwise(F.lit("")), key.cast("string")
    )
    quantity = (
        F.col("l_quantity")
        * F.when(returned, F.lit(-1.0)).otherwise(F.lit(1.0))
        * F.when(key % 97 == 0, F.lit(100.0)).otherwise(F.lit(1.0))
    )
    price = F.when(key % 211 == 0, F.lit(0.0)).otherwise(
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    )
    # Dimensions first: orders carry customer and country, then meet the lines once.
    headed = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_custkey", "o_orderdate", "n_name")
    )
    return (
        lines.join(headed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .select(
            invoice.alias("InvoiceNo"),
            F.col("l_partkey").cast("string").alias("StockCode"),
            F.col("p_name").alias("Description"),
            quantity.alias("Quantity"),
            (
                F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (key % 24).cast("int"))
            ).alias("InvoiceDate"),
            price.alias("UnitPrice"),
            F.when(key % 10 == 3, F.lit(None)).otherwise(F.col("o_custkey")).cast("double").alias(
                "CustomerID"
            ),
            F.col("n_name").alias("Country"),
        )
    )
