"""Table scans, control lists and the metadata-driven loader."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession


def read_table(spark: SparkSession, directory: str, name: str, glob: str | None = None) -> DataFrame:
    """Parquet scan of ``directory/name``; ``glob`` restricts the files of a folder."""
    reader = spark.read
    if glob is not None:
        return reader.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").parquet(
            f"{directory.rstrip('/')}/{name}"
        )
    return reader.parquet(f"{directory.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy access to the Parquet tables of one folder: ``tables.orders`` is a scan, whose footer is read once."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        table = read_table(self.spark, self.directory, name)
        setattr(self, name, table)
        return table


def read_table_list(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    """Control list: one row per table to process, all columns text, header in the first line."""
    return spark.read.csv(path, sep=sep, header=True)


@dataclass(frozen=True)
class LoadOutcome:
    entry: Row
    loaded: bool
    reason: str = ""


def run_table_list(entries: Iterable[Row], loader: Callable[[Row], None]) -> list[LoadOutcome]:
    """Run ``loader`` for each control row; a table whose source is absent is reported and skipped.

    The driver walks only the control list; every loader call is a Spark job of its own.
    """
    outcomes = []
    for entry in entries:
        try:
            loader(entry)
        except AnalysisException as error:
            missing = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"}
            if error.getCondition() not in missing:
                raise
            outcomes.append(LoadOutcome(entry, False, error.getCondition()))
        else:
            outcomes.append(LoadOutcome(entry, True))
    return outcomes


def load_list(control: DataFrame) -> Iterator[Row]:
    """Walk a control list on the driver, one row per table, in parts."""
    return control.toLocalIterator()


def strip_prefix(df: DataFrame) -> DataFrame:
    """Rename ``table.column`` headers to ``column``."""
    return df.toDF(*[name.rsplit(".", 1)[-1] for name in df.columns])
