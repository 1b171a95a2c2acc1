"""spark.read.format("form_page"): landing pages of form-driven sites, each fetched where a task runs."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from leafline.sources.forms import HttpOptions


class FormPageReader(DataSourceReader):
    def __init__(self, options):
        self.urls = [u for u in options.get("url", "").split() if u]
        self.kept = {k: kind(options[k.lower()]) for k, kind in (("retries", int), ("timeout", float), ("backoff", float), ("encoding", str), ("proxy", str)) if k.lower() in options}
        if not self.urls:
            raise ValueError("option url is missing: one address or several with spaces between")

    def partitions(self):
        return [InputPartition(u) for u in self.urls]

    def read(self, partition):
        status, html = HttpOptions(partition.value, **self.kept).session()(None)
        yield partition.value, status, html


class FormPageSource(DataSource):
    """Options: url (required), retries, timeout, backoff, encoding, proxy."""

    @classmethod
    def name(cls):
        return "form_page"

    def schema(self):
        return "url string, status int, html string"

    def reader(self, schema):
        return FormPageReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FormPageSource)
