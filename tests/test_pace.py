"""A site is never asked more often than it may be, by however many tasks, and is left alone while it is down."""

import random
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pyarrow as pa
import pytest

from leafline.sources import forms
from leafline.sources.pace import LATE, Breaker, Pace


@pytest.fixture
def server():
    """(address, times of the requests, the status that is answered)."""
    asked, status = [], [200]

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append(time.time())
            self.send_response(status[0])
            self.send_header("Content-Length", "0")
            self.end_headers()

        def log_message(self, *args):
            pass

    running = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=running.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{running.server_port}/", asked, status
    running.shutdown()


def most_in_a_second(times):
    times = sorted(times)
    return max(sum(1 for u in times if t <= u < t + 1) for t in times)


def test_tasks_share_one_budget(spark, server):
    url, asked, _ = server
    options = forms.HttpOptions(url, pace=Pace(8, 4))

    def run(batches):
        send = options.session()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([send(None)[0] for _ in range(batch.num_rows)], pa.int32())], names=["status"])

    got = spark.range(0, 40, 1, 4).mapInArrow(run, "status int").collect()
    assert [r.status for r in got] == [200] * 40 and len(asked) == 40
    assert most_in_a_second(asked) <= 8
    assert max(asked) - min(asked) < 2 * 40 / 8  # and the budget is used


def test_slots_are_each_sent_in_once_whatever_the_clock_says():
    rng = random.Random(3)
    for per_second, tasks in ((1, 1), (1, 5), (3, 2), (10, 7), (50, 4)):
        pace, sent = Pace(per_second, tasks), []
        for owner in range(tasks):
            now, used = 1000 + rng.random(), -1
            for _ in range(60):
                slot = pace.next_slot(now, owner, used)
                assert slot % tasks == owner and slot > used and now <= (slot + LATE) * pace.width + 1e-6
                now, used = max(now, (slot + LATE * rng.random()) * pace.width), slot
                sent.append(now)
                now += rng.choice([0, 0, rng.random() * 3])
        assert most_in_a_second(sent) <= per_second


def test_a_site_that_is_down_is_left_alone(server):
    url, asked, status = server
    status[0] = 503
    send = forms.HttpOptions(url, retries=1, backoff=0, failures=3, cool=0.5).session()
    assert [send(None)[0] for _ in range(6)] == [503, 0, 0, 0, 0, 0] and len(asked) == 3
    time.sleep(0.6)
    assert send(None)[0] == 0 and len(asked) == 4  # one is let through, and fails
    status[0] = 200
    time.sleep(0.6)
    assert [send(None)[0] for _ in range(3)] == [200] * 3 and len(asked) == 7


def test_the_breaker_closes_when_one_works():
    now = [0.0]
    breaker = Breaker(2, 10, lambda: now[0])
    breaker.tell(False)
    breaker.tell(True)
    breaker.tell(False)
    assert breaker.closed()
    breaker.tell(False)
    assert not breaker.closed()
    now[0] = 10.0
    assert breaker.closed()
    breaker.tell(False)
    assert not breaker.closed()
    assert Breaker(0, 10).closed()


def test_a_pace_for_fewer_tasks_than_fetch_is_refused(spark):
    options = forms.HttpOptions("http://example.invalid/", pace=Pace(5, 2))
    with pytest.raises(ValueError, match="2 tasks, and 4 fetch"):
        forms.Live(spark, options.session, parallel=4)
    for bad in ((0, 1), (1, 0)):
        with pytest.raises(ValueError):
            Pace(*bad)
