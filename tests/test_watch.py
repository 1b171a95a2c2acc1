"""Watched landing pages: each change once, nothing again after a restart."""

import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from leafline.sources import watch


@pytest.fixture
def site():
    """(address of a path, pages by path: text, or a status to fail with)."""
    pages = {}

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            page = pages.get(self.path, 404)
            body = page.encode() if isinstance(page, str) else b""
            self.send_response(200 if isinstance(page, str) else page)
            self.send_header("Content-Type", "text/html; charset=utf-8")
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield (lambda path: f"http://127.0.0.1:{server.server_port}{path}"), pages
    server.shutdown()


def once(spark, urls, at, kept=None):
    """Starts the query on its checkpoint, takes what there is, and ends it."""
    watch.register(spark)
    stream = spark.readStream.format("form_page_changes").option("url", " ".join(urls)).option("kept", kept or f"{at}/kept").option("retries", "0").load()
    query = stream.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination(120)
    return spark.read.parquet(f"{at}/out").collect() if list((at / "out").glob("*.parquet")) else []


def seen(rows):
    return sorted((r.url.rsplit("/", 1)[1], r.round, r.html) for r in rows)


def test_changes_are_given_once_over_restarts(spark, site, tmp_path):
    url, pages = site
    urls = [url("/a"), url("/b"), url("/a")]
    pages |= {"/a": "one", "/b": "é\n\"x\""}
    assert seen(once(spark, urls, tmp_path)) == [("a", 1, "one"), ("b", 1, "é\n\"x\"")]
    first = [("a", 1, "one"), ("b", 1, "é\n\"x\"")]
    assert seen(once(spark, urls, tmp_path)) == first  # nothing changed
    pages["/a"] = "two"
    assert seen(once(spark, urls, tmp_path)) == sorted([*first, ("a", 2, "two")])
    assert seen(once(spark, urls, tmp_path)) == sorted([*first, ("a", 2, "two")])  # a later round isn't given again either
    pages |= {"/a": 503, "/b": ""}
    assert seen(once(spark, urls, tmp_path)) == sorted([*first, ("a", 2, "two"), ("b", 2, "")])
    pages["/a"] = "one"  # up again, as it was at first
    third = sorted([*first, ("a", 2, "two"), ("b", 2, ""), ("a", 3, "one")])
    assert seen(once(spark, urls, tmp_path)) == third
    pages["/c"] = "new"
    assert seen(once(spark, [*urls, url("/c")], tmp_path)) == sorted([*third, ("c", 1, "new")])


def test_a_batch_is_read_from_what_was_kept(site, tmp_path):
    url, pages = site
    pages["/a"] = "one"
    reader = watch.ChangeReader([url("/a")], watch.Kept(str(tmp_path / "kept")), {"retries": 0})
    end = json.loads(json.dumps(reader.latestOffset()))
    pages["/a"] = "two"
    # Whoever repeats the batch, in another process, gets what it was.
    again = watch.ChangeReader([url("/a")], watch.Kept(str(tmp_path / "kept")), {"retries": 0})
    (part,) = again.partitions({}, end)
    assert [r[-1] for r in again.read(part)] == ["one"]
    assert again.latestOffset()[url("/a")][0] == 2
    assert again.partitions(end, end) == []


def test_a_site_that_is_down_gives_nothing(site, tmp_path):
    url, pages = site
    pages["/a"] = 500
    reader = watch.ChangeReader([url("/a")], watch.Kept(str(tmp_path / "kept")), {"retries": 0})
    assert reader.latestOffset() == {} == reader.initialOffset()


def test_options_are_needed(spark):
    with pytest.raises(ValueError, match="needed"):
        watch.ChangeSource({"url": "http://x"}).streamReader(None)
