"""Paged source: stop rules, retries, error policy, parity with a sequential read."""

import pytest

from stratalake.sources import PagedReadError, parse_records, read_paged

from .conftest import SF_SMALL


class ListPages:
    """Pages from a fixed list; ``fail`` maps page -> number of failures before success
    (-1 = always fails). ``task`` gives the failures of the copies that travel to tasks."""

    def __init__(self, pages, fail=None, task=None, task_pages=None):
        self.pages = pages
        self.fail = dict(fail or {})
        self.task = self.fail if task is None else task
        self.task_pages = pages if task_pages is None else task_pages
        self.calls = {}

    def __getstate__(self):
        return {"pages": self.task_pages, "fail": dict(self.task), "task": self.task, "task_pages": self.task_pages, "calls": {}}

    def __call__(self, page, per_page):
        n = self.calls.get(page, 0)
        self.calls[page] = n + 1
        f = self.fail.get(page, 0)
        if f == -1 or n < f:
            raise ConnectionError(f"page {page} unavailable")
        return self.pages[page - 1] if page <= len(self.pages) else []


def records(df):
    import json

    return sorted((r.page, json.loads(r.record)["id"]) for r in df.collect())


def test_uneven_pages_then_empty(spark):
    f = ListPages([[{"id": 5}], [{"id": 6}, {"id": 7}, {"id": 8}], [{"id": 9}], []])
    assert records(read_paged(spark, f, per_page=3, base_wait=0)) == [(1, 5), (2, 6), (2, 7), (2, 8), (3, 9)]


def test_first_page_empty(spark):
    assert read_paged(spark, ListPages([]), base_wait=0).count() == 0


PAGES = [[{"id": 10 * p + i} for i in range(3)] for p in range(1, 21)]
ALL = sorted((p, r["id"]) for p, rows in enumerate(PAGES, start=1) for r in rows)


def complete_or_fail(spark, fetch, **kw):
    """All rows, or a PagedReadError; never a part."""
    try:
        return records(read_paged(spark, fetch, per_page=3, base_wait=0, **kw))
    except PagedReadError:
        return None


@pytest.mark.parametrize("page", [1, 2, 4, 15, 16, 20])
def test_a_page_that_fails_only_while_probing(spark, page):
    got = complete_or_fail(spark, ListPages(PAGES, fail={page: 1}, task={}), retries=1, pages_per_partition=4)
    assert got in (ALL, None)


@pytest.mark.parametrize("page", [1, 4, 19, 20])
def test_a_page_that_fails_only_in_the_task(spark, page):
    with pytest.raises(PagedReadError, match=f"page {page} failed"):
        read_paged(spark, ListPages(PAGES, task={page: -1}), retries=1, base_wait=0, pages_per_partition=3)


def test_pages_that_come_after_the_probe_are_read(spark):
    got = complete_or_fail(spark, ListPages(PAGES[:7], task_pages=PAGES), pages_per_partition=2)
    assert got == ALL


def test_page_that_turns_empty_before_the_end_fails(spark):
    later = [*PAGES[:5], [], *PAGES[6:]]
    with pytest.raises(PagedReadError, match="page 6 is empty"):
        read_paged(spark, ListPages(PAGES, task_pages=later), base_wait=0, pages_per_partition=2)


def test_gap_is_never_a_silent_end(spark):
    gap = [*PAGES[:5], [], *PAGES[6:]]
    assert complete_or_fail(spark, ListPages(gap)) in (None, [r for r in ALL if r[0] < 6])


def test_errors_beyond_the_end_do_not_matter(spark):
    f = ListPages(PAGES[:5], fail={p: -1 for p in range(7, 70)})
    assert complete_or_fail(spark, f, retries=1) == [r for r in ALL if r[0] < 6]


def test_failing_first_page(spark):
    with pytest.raises(PagedReadError, match="page 1"):
        read_paged(spark, ListPages(PAGES, fail={1: -1}), retries=1, base_wait=0)


def test_retries_and_end_are_logged(spark, caplog):
    import logging

    with caplog.at_level(logging.INFO, logger="stratalake.sources.paged"):
        read_paged(spark, ListPages(PAGES, fail={2: 1}, task={}), retries=2, base_wait=0)
    assert "page 2, try 1 of 2" in caplog.text and "page 21 is empty" in caplog.text
    assert "read 60 records from 20 pages" in caplog.text


def test_partition_size_follows_the_data(spark):
    from stratalake.sources import raw_pages

    tasks = raw_pages(spark, ListPages([[{"id": i}] for i in range(2000)]), per_page=1).rdd.getNumPartitions()
    assert 2 <= tasks <= 4 * spark.sparkContext.defaultParallelism + 1


def test_failing_page_fails_by_default(spark):
    pages = [[{"id": i}] for i in range(1, 10)]
    with pytest.raises(PagedReadError, match="page 4"):
        read_paged(spark, ListPages(pages, fail={4: -1}), per_page=1, retries=1, base_wait=0)


def test_transient_failures_are_retried(spark):
    pages = [[{"id": i}] for i in range(1, 6)]
    f = ListPages(pages, fail={2: 2, 3: 1})
    got = records(read_paged(spark, f, per_page=1, retries=3, base_wait=0))
    assert got == [(i, i) for i in range(1, 6)]


def test_event_pages_refuse_gaps(spark, tmp_dir):
    from stratalake.plans.catalog import _EventPages

    spark.read.parquet(f"{SF_SMALL}/events.parquet").where("event_id <> 7").write.parquet(f"{tmp_dir}/events.parquet")
    with pytest.raises(ValueError, match="dense"):
        _EventPages(spark, tmp_dir)


def test_parse_records_is_permissive(spark):
    from pyspark.sql import types as T

    f = ListPages([[{"id": 2, "latitude": "41.5", "extra": 1}, {"id": "x", "latitude": 3.5}], []])
    schema = T.StructType.fromDDL("id string, latitude float")
    got = sorted(tuple(r) for r in parse_records(read_paged(spark, f, base_wait=0), schema).collect())
    assert got == [(1, "2", None), (1, "x", 3.5)]


def test_non_serialisable_record_fails_the_read(spark):
    class Opaque:
        pass

    f = ListPages([[{"id": 1, "blob": Opaque()}], []])
    with pytest.raises(Exception, match="not JSON serialisable"):
        read_paged(spark, f, base_wait=0)


def test_http_pages_url_building():
    from stratalake.sources import HttpPages

    f = HttpPages("https://api.example.test/v1/items", {"region": "north east"})
    assert f.request_url(3, 200) == "https://api.example.test/v1/items?page=3&per_page=200&region=north+east"
    g = HttpPages("https://h.test/x?key=1")
    assert g.request_url(1, 5) == "https://h.test/x?key=1&page=1&per_page=5"
    h = HttpPages("https://h.test/x?page={page}&n={per_page}", {"region": "north"})
    assert h.request_url(4, 9) == "https://h.test/x?page=4&n=9&region=north"
    with pytest.raises(ValueError, match="page"):
        HttpPages("https://h.test/x", {"page": "1"})


def test_http_pages_through_the_paged_reader(spark, tmp_dir):
    """file:// URLs stand in for the endpoint (no network, no server)."""
    import json
    import os

    from stratalake.sources import HttpPages

    pages = [[{"id": 1}, {"id": 2}], [{"id": 3}], []]
    for i, p in enumerate(pages, start=1):
        with open(os.path.join(tmp_dir, f"{i}.json"), "w") as fh:
            json.dump(p, fh)
    with open(os.path.join(tmp_dir, "bad-1.json"), "w") as fh:
        fh.write("<html>oops</html>")
    f = HttpPages("file://" + tmp_dir + "/{page}.json")
    assert records(read_paged(spark, f, per_page=2, base_wait=0)) == [(1, 1), (1, 2), (2, 3)]
    with pytest.raises(ValueError, match="not JSON"):
        HttpPages("file://" + tmp_dir + "/bad-{page}.json")(1, 2)


def test_http_pages_unreachable_endpoint(spark, tmp_dir):
    """A fetch that cannot connect raises; the paged read then fails."""
    from urllib.error import URLError

    from stratalake.sources import HttpPages

    f = HttpPages("file://" + tmp_dir + "/missing-{page}.json")
    with pytest.raises(URLError):
        f(1, 2)
    with pytest.raises(PagedReadError, match="page 1"):
        read_paged(spark, f, per_page=2, retries=1, base_wait=0).collect()
