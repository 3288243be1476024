"""Paged sources (a REST-style "page 1, 2, 3 ... until an empty page") as a
Spark Python Data Source.

The caller supplies a *fetcher*: any picklable callable
``fetch(page: int, per_page: int) -> list[dict]`` (an HTTP client, a table
slicer, ...). It may also offer ``prefetch(first, last, per_page)``, called
once per input partition before its pages are fetched.

How the pages are read in parallel while keeping the sequential rule "pages 1, 2,
... up to the first empty page", completely or not at all:

1. the driver finds an empty page whose predecessor has records, with an exponential
   probe and a binary search -- O(log pages) fetches. A page that fails is not taken
   for the end: if the search ends at one, the read fails;
2. the pages before that end are dealt to tasks; every one of them must have records.
   A page that fails (after ``retries`` tries with exponential back-off and full
   jitter) or is empty fails the read;
3. the last task has no upper end: it goes on past the probed end until it sees an
   empty page itself, so records that came meanwhile are not lost.

A probed page is fetched again by its task; besides that a page is fetched once per
evaluation. :func:`read_paged` therefore checkpoints what it read.

A source whose records only grow at the end can also be followed: :func:`stream_pages`.
Its offset is a page and how many of that page's records are taken, so a last page that
was partly filled is read again from there, and a micro-batch that is replayed reads
exactly the records it stood for.

Records leave the source as their JSON text (``record`` column), so typing is
schema-on-read exactly as for a JSON file (see :func:`parse_records`).

This module runs inside Python workers and is pickled by value, so it only
imports the standard library and PySpark at module level.
"""

from __future__ import annotations

import json
import logging
import random
import re
import sys
import time
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

# Default page size and retry policy of the paged source.
DEFAULT_PER_PAGE = 200
DEFAULT_RETRIES = 5
RAW_SCHEMA = "page int, record string"
TASKS_PER_CORE = 4

log = logging.getLogger("stratalake.sources.paged")


class PagedReadError(RuntimeError):
    """A page could not be read, or the pages do not fit together; nothing is returned."""


@contextmanager
def paged_errors():
    """Turn a Spark job's failure caused by a :class:`PagedReadError` in a task into one."""
    try:
        yield
    except PagedReadError:
        raise
    except Exception as e:
        m = re.search(r"PagedReadError: (page .*)", str(e))
        if m:
            raise PagedReadError(m[1]) from e
        raise


def _jsonable(v):
    if isinstance(v, datetime | date):
        return v.isoformat()
    raise TypeError(f"not JSON serialisable: {type(v).__name__}")


def fetch_with_retry(fetch, page: int, per_page: int, retries: int, base_wait: float):
    """Call ``fetch`` up to ``retries`` times; wait ~ U(0, base_wait * 2**try)."""
    for attempt in range(retries):
        try:
            return fetch(page, per_page)
        except Exception as e:
            log.warning("page %s, try %s of %s: %s: %s", page, attempt + 1, retries, type(e).__name__, e)
            if attempt + 1 >= retries:
                raise
            time.sleep(random.uniform(0, base_wait * (2**attempt)))
    return None


def probe_end(fetch, per_page: int, retries: int, base_wait: float, first: int = 1) -> int:
    """Some empty page p whose predecessor has records (or p == ``first``)."""
    errors: dict[int, Exception] = {}

    def has_records(page: int) -> bool:
        try:
            return bool(fetch_with_retry(fetch, page, per_page, retries, base_wait))
        except Exception as e:
            errors[page] = e  # perhaps only beyond the end; the search goes on below it
            return False

    lo, span = first - 1, 1  # lo has records (or is before the first)
    while has_records(first - 1 + span):
        lo, span = first - 1 + span, 2 * span
    hi = first - 1 + span
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if has_records(mid):
            lo = mid
        else:
            hi = mid
    if hi in errors:
        raise PagedReadError(f"page {hi} failed: {type(errors[hi]).__name__}: {errors[hi]}") from errors[hi]
    log.info("probe: page %s is empty, page %s is the last with records", hi, hi - 1)
    return hi


@dataclass
class PageRange(InputPartition):
    first: int
    last: int | None  # None: until an empty page


class _Reader(DataSourceReader):
    def __init__(self, fetch, per_page, pages_per_partition, end, retries, base_wait):
        self.fetch = fetch
        self.per_page = per_page
        self.ppp = pages_per_partition
        self.end = end
        self.retries = retries
        self.base_wait = base_wait

    def partitions(self):
        starts = list(range(1, self.end, self.ppp)) or [1]
        return [PageRange(a, a + self.ppp - 1) for a in starts[:-1]] + [PageRange(starts[-1], None)]

    def read(self, partition: PageRange):
        """One Arrow batch per page (no per-row conversion on the way to the JVM)."""
        prefetch = getattr(self.fetch, "prefetch", None)
        if prefetch is not None:
            prefetch(partition.first, partition.last or self.end, self.per_page)
        page = partition.first
        while partition.last is None or page <= partition.last:
            try:
                recs = fetch_with_retry(self.fetch, page, self.per_page, self.retries, self.base_wait)
            except Exception as e:
                raise PagedReadError(f"page {page} failed: {type(e).__name__}: {e}") from e
            if not recs:
                if page < self.end:
                    raise PagedReadError(f"page {page} is empty, but page {self.end - 1} had records when probed")
                return
            yield _batch(page, recs)
            page += 1


def _batch(page: int, recs: list):
    import pyarrow as pa

    records = [json.dumps(r, default=_jsonable) for r in recs]
    return pa.RecordBatch.from_arrays(
        [pa.array([page] * len(records), pa.int32()), pa.array(records, pa.string())], names=["page", "record"]
    )


@dataclass
class PageSlice(InputPartition):
    """Pages ``first`` to ``last``, without the first ``skip`` records of the first and
    only the first ``upto`` of the last (None: all)."""

    first: int
    last: int
    skip: int
    upto: int | None


class _StreamReader(DataSourceStreamReader):
    """Offsets ``{"page": p, "taken": n}``: everything before page p and n records of it."""

    def __init__(self, fetch, per_page, pages_per_partition, retries, base_wait):
        self.fetch = fetch
        self.per_page = per_page
        self.ppp = pages_per_partition
        self.retries = retries
        self.base_wait = base_wait
        self.known = None  # an offset that pages are known to reach; probing goes on there

    def initialOffset(self):
        return {"page": 1, "taken": 0}

    def latestOffset(self):
        at = self.known or self.initialOffset()
        end = probe_end(self.fetch, self.per_page, self.retries, self.base_wait, first=at["page"])
        if end == at["page"]:
            if at["taken"]:
                raise PagedReadError(f"page {end} is empty, but had {at['taken']} records before")
        else:
            n = len(self._page(end - 1))
            at = {"page": end, "taken": 0} if n >= self.per_page else {"page": end - 1, "taken": n}
        self.known = at
        return at

    def partitions(self, start, end):
        last, upto = (end["page"], end["taken"]) if end["taken"] else (end["page"] - 1, None)
        firsts = list(range(start["page"], last + 1, self.ppp))
        return [
            PageSlice(a, min(a + self.ppp - 1, last), start["taken"] if a == firsts[0] else 0, upto if a == firsts[-1] else None)
            for a in firsts
        ]

    def _page(self, page: int) -> list:
        try:
            return fetch_with_retry(self.fetch, page, self.per_page, self.retries, self.base_wait) or []
        except Exception as e:
            raise PagedReadError(f"page {page} failed: {type(e).__name__}: {e}") from e

    def read(self, partition: PageSlice):
        prefetch = getattr(self.fetch, "prefetch", None)
        if prefetch is not None:
            prefetch(partition.first, partition.last, self.per_page)
        for page in range(partition.first, partition.last + 1):
            recs = self._page(page)
            skip = partition.skip if page == partition.first else 0
            upto = partition.upto if page == partition.last else None
            least = max(skip, upto or 1)
            if len(recs) < least:
                raise PagedReadError(f"page {page} has {len(recs)} records, but had {least} before")
            if recs[skip:upto]:
                yield _batch(page, recs[skip:upto])

    def commit(self, end):
        if self.known is None:
            self.known = dict(end)


SOURCE_NAME = "stratalake_paged"


class PagedSource(DataSource):
    """Registered once per session; the fetcher travels (pickled) in the options."""

    @classmethod
    def name(cls):
        return SOURCE_NAME

    def schema(self):
        return RAW_SCHEMA

    def reader(self, schema):
        import base64

        from pyspark import cloudpickle

        o = self.options
        return _Reader(
            cloudpickle.loads(base64.b64decode(o["fetcher"])),
            int(o.get("per_page", DEFAULT_PER_PAGE)),
            int(o["pages_per_partition"]),
            int(o["end"]),
            int(o.get("retries", DEFAULT_RETRIES)),
            float(o.get("base_wait", 0.5)),
        )

    def streamReader(self, schema):
        import base64

        from pyspark import cloudpickle

        o = self.options
        return _StreamReader(
            cloudpickle.loads(base64.b64decode(o["fetcher"])),
            int(o.get("per_page", DEFAULT_PER_PAGE)),
            int(o["pages_per_partition"]),
            int(o.get("retries", DEFAULT_RETRIES)),
            float(o.get("base_wait", 0.5)),
        )


def _with_options(source, fetch, **options):
    """A reader (batch or stream) of :class:`PagedSource` with its options."""
    import base64

    from pyspark import cloudpickle

    # Ship this module by value: executors need not have the package installed.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    options["fetcher"] = base64.b64encode(cloudpickle.dumps(fetch)).decode("ascii")
    return source.format(SOURCE_NAME).options(**options)


def raw_pages(
    spark: SparkSession,
    fetch,
    *,
    per_page: int = DEFAULT_PER_PAGE,
    pages_per_partition: int | None = None,
    retries: int = DEFAULT_RETRIES,
    base_wait: float = 0.5,
) -> DataFrame:
    """Lazy ``(page, record)`` rows straight from the source (not checkpointed).

    ``pages_per_partition`` defaults to what gives every core a few tasks. Run actions
    inside :func:`paged_errors` to get a :class:`PagedReadError` from a failing page.
    """
    end = probe_end(fetch, per_page, retries, base_wait)
    if pages_per_partition is None:
        pages_per_partition = max(1, -(-(end - 1) // (TASKS_PER_CORE * spark.sparkContext.defaultParallelism)))
    spark.dataSource.register(PagedSource)
    return _with_options(
        spark.read, fetch, per_page=per_page, pages_per_partition=pages_per_partition, end=end, retries=retries, base_wait=base_wait
    ).load()


def stream_pages(
    spark: SparkSession,
    fetch,
    *,
    per_page: int = DEFAULT_PER_PAGE,
    pages_per_partition: int = 50,
    retries: int = DEFAULT_RETRIES,
    base_wait: float = 0.5,
) -> DataFrame:
    """A streaming frame ``(page, record)`` of a source that grows at its end only.

    A micro-batch holds the records that came since the one before, each exactly once
    (also after a restart from the query's checkpoint): full pages once, a last page that
    was partly filled again, without the records taken. A micro-batch reads what its
    offsets say, so one that is replayed is the same. A page that cannot be read, or has
    lost records, fails the micro-batch; nothing is passed over. ``per_page`` must stay
    the same for one checkpoint. Each micro-batch probes O(log new pages) pages, the first
    one after a restart O(log all pages).
    """
    spark.dataSource.register(PagedSource)
    return _with_options(
        spark.readStream, fetch, per_page=per_page, pages_per_partition=pages_per_partition, retries=retries, base_wait=base_wait
    ).load()


def read_paged(
    spark: SparkSession,
    fetch,
    *,
    per_page: int = DEFAULT_PER_PAGE,
    pages_per_partition: int | None = None,
    retries: int = DEFAULT_RETRIES,
    base_wait: float = 0.5,
) -> DataFrame:
    """All records of the pages before the first empty one: ``(page, record)``, checkpointed.

    Raises :class:`PagedReadError` if any page before the end cannot be read, or is
    empty although a later one had records. There is no partial result.
    """
    from .storage import shared_dir

    shared_dir(spark)  # make sure a reliable checkpoint folder is configured
    with paged_errors():
        raw = raw_pages(
            spark, fetch, per_page=per_page, pages_per_partition=pages_per_partition,
            retries=retries, base_wait=base_wait,
        ).checkpoint(eager=True)
    if log.isEnabledFor(logging.INFO):
        total = raw.agg(F.count(F.lit(1)).alias("rows"), F.max("page").alias("last")).first()
        log.info("read %s records from %s pages", total["rows"], total["last"] or 0)
    return raw


def parse_records(df: DataFrame, schema: T.StructType, record_col: str = "record", damaged: str | None = None) -> DataFrame:
    """Type JSON record text with a declared schema (permissive, like a JSON file read).

    Fields absent from the record are NULL, undeclared fields are dropped and
    a value that does not fit its declared type is NULL in that field only. ``damaged``
    names a column for the text of records that do not fit (null for all others).
    """
    options = {"mode": "PERMISSIVE"}
    if damaged:
        schema = T.StructType([*schema.fields, T.StructField(damaged, T.StringType())])
        options["columnNameOfCorruptRecord"] = damaged
    parsed = F.from_json(F.col(record_col), schema, options)
    keep = [c for c in df.columns if c != record_col]
    return df.select(*keep, parsed.alias("_r")).select(*keep, "_r.*")


class HttpPages:
    """Fetcher for a JSON REST endpoint that pages with query parameters.

    ``fetch(page, per_page)`` issues ``GET url?page=..&per_page=..&<params>``
    (or fills the ``{page}`` / ``{per_page}`` placeholders in ``url`` and adds
    ``params``; they may not name the paging parameters) and returns
    the decoded JSON list. HTTP errors (4xx and 5xx alike), connection errors and
    timeouts raise, so the paged reader retries them; a body that is not JSON
    raises ``ValueError``. ``timeout`` is applied to connecting and to each read.
    """

    def __init__(self, url: str, params: dict | None = None, *, page_param: str = "page",
                 per_page_param: str = "per_page", timeout: float = 30.0,
                 headers: dict | None = None):
        clash = {page_param, per_page_param} & set(params or {})
        if clash:
            raise ValueError(f"reserved for paging: {', '.join(sorted(clash))}")
        self.url = url
        self.params = dict(params or {})
        self.page_param = page_param
        self.per_page_param = per_page_param
        self.timeout = timeout
        self.headers = dict(headers or {})

    def request_url(self, page: int, per_page: int) -> str:
        from urllib.parse import urlencode

        if "{page}" in self.url:
            url, query = self.url.replace("{page}", str(page)).replace("{per_page}", str(per_page)), dict(self.params)
        else:
            url, query = self.url, {self.page_param: page, self.per_page_param: per_page, **self.params}
        return f"{url}{'&' if '?' in url else '?'}{urlencode(query)}" if query else url

    def __call__(self, page: int, per_page: int) -> list:
        from urllib.request import Request, urlopen

        req = Request(self.request_url(page, per_page), headers=self.headers)
        with urlopen(req, timeout=self.timeout) as resp:  # raises HTTPError for >= 400
            body = resp.read()
        try:
            data = json.loads(body)
        except ValueError as e:
            raise ValueError(f"page {page}: response is not JSON") from e
        if data is None:
            return []
        if not isinstance(data, list):
            raise ValueError(f"page {page}: expected a JSON list, got {type(data).__name__}")
        return data
