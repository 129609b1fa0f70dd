"""Input tables: explicit schemas, CSV and Parquet scans, splits, CSV and Parquet sinks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Calendar

# Ids are strings so that leading zeros survive. CSV columns are found by name,
# in whatever order the files have them, and further columns are never parsed.
TRANSACTIONS = {"t_dat": "date", "customer_id": "string", "article_id": "string", "price": "double"}
ARTICLES = {
    "article_id": "string", "prod_name": "string", "product_type_no": "int",
    "colour_group_code": "int", "department_no": "int", "perceived_colour_value_id": "int",
}
SUBMISSION = {"customer_id": "string", "prediction": "string"}
CUSTOMERS = {
    "customer_id": "string", "age": "double", "club_member_status": "string",
    "fashion_news_frequency": "string",
}


@dataclass(frozen=True)
class Inputs:
    """The three tables and the two training cuts of the purchases."""

    transactions: DataFrame
    articles: DataFrame
    customers: DataFrame
    calendar: Calendar

    @property
    def train_tx(self) -> DataFrame:
        """Purchases before the test period."""
        return self.transactions.where(F.col("t_dat") < F.lit(self.calendar.test_start))

    @property
    def train_tx_clean(self) -> DataFrame:
        """Purchases before the label week."""
        return self.transactions.where(F.col("t_dat") < F.lit(self.calendar.val_start))

    @property
    def label_tx(self) -> DataFrame:
        """Purchases of the label week, both ends included."""
        return self.transactions.where(
            F.col("t_dat").between(F.lit(self.calendar.val_start), F.lit(self.calendar.val_end))
        )

    @property
    def test_tx(self) -> DataFrame:
        return self.transactions.where(F.col("t_dat") >= F.lit(self.calendar.test_start))


def read_csv(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Read named columns of headed CSV files with fixed types.

    All files of ``path`` must have the same header; one with other columns, or
    with the same ones in another order, is an error and never read by place.
    """
    header = spark.read.option("header", True).option("inferSchema", False).csv(path).schema
    # Columns are chosen after parsing: the header of a file is only compared whole.
    raw = spark.read.schema(header).option("header", True).option("enforceSchema", False).csv(path)
    return raw.select(*[_parse(name, kind).alias(name) for name, kind in columns.items()])


def _parse(name: str, kind: str):
    if kind == "date":
        return F.to_date(F.col(name), "yyyy-MM-dd")
    return F.col(name).cast(kind)


def load_inputs(spark: SparkSession, data_dir: str, calendar: Calendar) -> Inputs:
    """The three CSV files of a data directory."""
    return Inputs(
        read_csv(spark, f"{data_dir}/transactions_train.csv", TRANSACTIONS),
        read_csv(spark, f"{data_dir}/articles.csv", ARTICLES),
        read_csv(spark, f"{data_dir}/customers.csv", CUSTOMERS),
        calendar,
    )


def read_tables(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet from one directory, many files, or a glob."""
    return spark.read.parquet(*paths)


def read_submission(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, SUBMISSION)


def table_sizes(inputs: Inputs) -> DataFrame:
    """Rows and columns of each input table, one aggregate per table."""
    tables = {
        "transactions": inputs.transactions,
        "train_tx_clean": inputs.train_tx_clean,
        "articles": inputs.articles,
        "customers": inputs.customers,
    }
    sizes = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in tables.items()
    ]
    out = sizes[0]
    for size in sizes[1:]:
        out = out.unionByName(size)
    return out


def write_parquet(df: DataFrame, path: str, *partition_by: str) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
