"""Numbered pages of JSON records under ``page=<n>`` folders, as one array per page or one record per line."""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from urllib.request import urlopen

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# tasks receive this module's classes by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAGE = "page"
_FULL_TIMES = {f: "yyyy-MM-dd'T'HH:mm:ss.SSSSSS" for f in ("timestampFormat", "timestampNTZFormat")}


def read_pages(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records of pages 1, 2, … up to the first page that is empty or absent.

    All pages are read in parallel; the reader flattens a page that is one JSON array. The stop page is
    found among the page numbers alone, and later pages are left out by partition pruning at run time.
    """
    rows = spark.read.schema(schema).json(path).withColumn(PAGE, F.col(PAGE).cast("int"))
    filled = rows.select(PAGE).distinct()
    candidates = filled.select((F.col(PAGE) + 1).alias(PAGE)).union(
        spark.range(1, 2).select(F.col("id").cast("int").alias(PAGE))
    )
    stop = candidates.join(filled, PAGE, "left_anti").agg(F.min(PAGE))
    return rows.where(F.col(PAGE) < stop.scalar())


def write_pages(df: DataFrame, path: str, page: str, columns: list[str]) -> None:
    """Store records under page folders, the counterpart of ``read_pages``; a page much larger than others is split."""
    (
        df.select(F.col(page).cast("int").alias(PAGE), *columns)
        .hint("rebalance", F.col(PAGE))
        .write.partitionBy(PAGE).options(**_FULL_TIMES).json(path)
    )


class _PageReader(DataSourceReader):
    """Reader i of n asks for pages i, i + n, i + 2n, … until one is empty."""

    def __init__(self, template: str, readers: int):
        self.template, self.readers = template, readers

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in range(1, self.readers + 1)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        page = partition.value
        while True:
            with urlopen(self.template.format(page=page), timeout=30) as response:
                records = json.load(response)
            if not records:
                return
            yield page, json.dumps(records)
            page += self.readers


class PageSource(DataSource):
    """Spark data source ``numbered_pages``: option ``template`` is an address with ``{page}`` in it.

    A request that fails fails its task, which Spark repeats.
    """

    @classmethod
    def name(cls) -> str:
        return "numbered_pages"

    def schema(self) -> str:
        return "page int, value string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _PageReader(self.options["template"], int(self.options.get("readers", "8")))


def land_pages(spark: SparkSession, template: str, path: str, readers: int = 8) -> None:
    """Fetch all pages in parallel and store each as it came; ``read_pages`` then applies the stop rule."""
    spark.dataSource.register(PageSource)
    pages = spark.read.format("numbered_pages").option("template", template).option("readers", readers).load()
    pages.write.partitionBy(PAGE).text(path)
