import datetime as dt
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-"))  # one machine
        # Small tables: joins are shuffled, so that all cores work on them.
        .config("spark.sql.autoBroadcastJoinThreshold", "1m")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def make_lines(spark):
    """Cleaned lines from (customer, invoice, product, 'yyyy-mm-dd hh:mm:ss', quantity, price)."""

    def make(rows):
        df = spark.createDataFrame(
            [(c, str(i), str(p), t, float(q), float(u)) for c, i, p, t, q, u in rows],
            "CustomerID long, InvoiceNo string, StockCode string, at string, "
            "Quantity double, UnitPrice double",
        )
        return df.select(
            "CustomerID",
            "InvoiceNo",
            "StockCode",
            F.to_timestamp("at").alias("InvoiceDate"),
            "Quantity",
            "UnitPrice",
            (F.col("Quantity") * F.col("UnitPrice")).alias("Revenue"),
            (F.col("Quantity") < 0).alias("is_return"),
        )

    return make


@pytest.fixture(scope="session")
def make_snapshots(spark):
    def make(*times):
        return spark.createDataFrame([(t,) for t in times], "at string").select(
            F.to_timestamp("at").alias("snapshot_date")
        )

    return make


def utc(text: str) -> dt.datetime:
    return dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S")
