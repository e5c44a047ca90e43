import random
import time

import pytest

from leadpanel.streaming import jobs as J
from leadpanel.streaming import resume as R

SCHEMA = "key string, ok boolean"


@pytest.fixture
def feed(spark, tmp_path):
    """Writes batches as files and runs the stream over what is new; every run is a restart from its checkpoint."""

    class Feed:
        source, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")

        def add(self, rows):
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.source)

        def run(self, **settings):
            events = J.file_stream(spark, self.source, SCHEMA, files_per_trigger=1)
            R.resume_available(events, "key", "ok", self.out, self.state, **settings)
            return sorted((r["key"], r["attempt"], r["reason"]) for r in J.read_appends(spark, self.out).collect())

    return Feed()


def test_stream_equals_batch(feed):
    """Shuffled, repeated rows over several batches and restarts: what is open at the end is what is wanted and not done."""
    rng = random.Random(4)
    wanted = [f"k{i}" for i in range(60)]
    done = [f"k{i}" for i in range(0, 90, 3)]
    failed = [f"k{i}" for i in range(0, 60, 4)]
    rows = [(k, None) for k in wanted] * 2 + [(k, True) for k in done] * 2 + [(k, False) for k in failed] + [(None, None), (None, True)]
    rng.shuffle(rows)
    for at in range(0, len(rows), 60):
        feed.add(rows[at:at + 60])
        if at % 120 == 0:
            found = feed.run(retry_after_ms=0)
    found = feed.run(retry_after_ms=0)
    assert {k for k, *_ in found} - set(done) == set(wanted) - set(done)
    for key in {k for k, *_ in found}:
        attempts = [a for k, a, _ in found if k == key]
        assert attempts == list(range(attempts[0], attempts[0] + len(attempts)))


def test_done_is_known_before_a_request_of_the_same_batch(feed):
    feed.add([("a", None), ("a", True), ("b", None), ("b", False), ("c", None), ("d", False), ("d", True)])
    assert feed.run() == [("b", 2, "failed"), ("c", 1, "new")]
    feed.add([("a", None), ("c", None), ("d", None)])
    assert feed.run() == [("b", 2, "failed"), ("c", 1, "new")]


def test_a_failed_key_comes_again_after_its_time(feed):
    feed.add([("a", None), ("b", None)])
    assert feed.run(retry_after_ms=4000) == [("a", 1, "new"), ("b", 1, "new")]
    feed.add([("a", False), ("b", True)])
    first = feed.run(retry_after_ms=4000)
    assert [r for r in first if r[1] > 1] == []
    time.sleep(4.5)
    feed.add([("z", True)])  # any batch lets timers go off
    assert [r for r in feed.run(retry_after_ms=4000) if r[1] > 1] == [("a", 2, "failed")]


def test_what_is_done_expires(feed):
    feed.add([("a", None), ("a", True)])
    assert feed.run(keep_ms=3000) == []
    time.sleep(3.5)
    feed.add([("a", None)])
    assert feed.run(keep_ms=3000) == [("a", 1, "new")]
