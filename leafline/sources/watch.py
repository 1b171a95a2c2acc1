"""spark.readStream.format("form_page_changes"): landing pages that are watched over time, each given when it has changed.

Every trigger asks for each address once. The offset holds each address's round and the digest of what was last
given of it, so a page whose digest is the same makes no new offset and no batch. What has changed is written to a
folder before its offset is told, under the name of its digest: a batch is read from there, never fetched, so a
batch that is repeated after a failure, and a query that goes on from its checkpoint, give the same rows, and a query that goes on gives
nothing twice. A changed page's text goes once through the driver, as the offset's process is there: addresses are the sites'
landing pages, tens of kB each, and as many as options name. The pages behind them are fetched by tasks (sources/pages.py, sources/forms.py).

A fetch that fails changes nothing and is tried again at the next trigger. An address that is named twice counts once.
A page that changes and changes back is given each time. An address that is added to the option is given at the
next trigger; one that is taken out is asked for no more. An empty page is a page. A folder is of one query.
"""

from __future__ import annotations

import hashlib
import os
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from leafline.sources.forms import HttpOptions

SCHEMA = "url string, round long, digest string, status int, html string"


def digest_of(html: str) -> str:
    return hashlib.sha256(html.encode("utf-8", "surrogatepass")).hexdigest()


class Kept:
    """Pages by the digest of their text, in a folder that driver and tasks share. A page is renamed into its place when it
    is whole, so one that is there is whole."""

    def __init__(self, at: str):
        self.at = at

    def put(self, html: str) -> str:
        digest = digest_of(html)
        path = self.path(digest)
        if not os.path.exists(path):
            os.makedirs(self.at, exist_ok=True)
            part = f"{path}.{uuid.uuid4().hex}.part"
            pq.write_table(pa.table({"html": pa.array([html], pa.large_string())}), part)
            os.replace(part, path)
        return digest

    def get(self, digest: str) -> str:
        return pq.read_table(self.path(digest)).column("html")[0].as_py()

    def path(self, digest: str) -> str:
        return f"{self.at}/{digest}.parquet"


class ChangeReader(DataSourceStreamReader):
    """Offsets: {url: [round, digest, status]}. round counts the changes of an address from 1."""

    def __init__(self, urls: list[str], kept: Kept, options: dict):
        self.urls, self.kept, self.options = list(dict.fromkeys(urls)), kept, options
        # What was last told; after a restart the checkpoint's offset comes by partitions() before anything is asked for.
        self.told: dict | None = None

    def initialOffset(self):
        return {}

    def latestOffset(self):
        told = self.told or {}
        now = {}
        for url in self.urls:
            before = told.get(url)
            status, html = HttpOptions(url, **self.options).session()(None)
            if status != 200:
                if before:
                    now[url] = before
                continue
            digest = self.kept.put(html)
            now[url] = before if before and before[1] == digest else [before[0] + 1 if before else 1, digest, status]
        self.told = now
        return now

    def partitions(self, start, end):
        if self.told is None:
            self.told = end
        return [InputPartition((url, *held)) for url, held in sorted(end.items()) if start.get(url) != held]

    def read(self, partition):
        url, turn, digest, status = partition.value
        yield url, turn, digest, status, self.kept.get(digest)


class ChangeSource(DataSource):
    """Options: url (required: one or several with spaces between), kept (required: a folder that is shared), retries,
    timeout, backoff, encoding, proxy."""

    @classmethod
    def name(cls):
        return "form_page_changes"

    def schema(self):
        return SCHEMA

    def streamReader(self, schema):
        urls = self.options.get("url", "").split()
        if not urls or not self.options.get("kept"):
            raise ValueError("options url (one address or several with spaces between) and kept (a shared folder) are needed")
        more = {k: kind(self.options[k]) for k, kind in (("retries", int), ("timeout", float), ("backoff", float), ("encoding", str), ("proxy", str)) if k in self.options}
        return ChangeReader(urls, Kept(self.options["kept"].rstrip("/")), more)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ChangeSource)
