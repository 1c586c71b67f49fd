"""Chapter feeds over HTTP: a session with retries, parsers of feed payloads, a Spark data source.

The parsers are DataFrame operators over columns of JSON text, so a landed feed is read without
any HTTP. The data source runs an adapter with one partition per chapter and yields a row per page
or per error, so one bad chapter or page does not fail the read.
"""

from __future__ import annotations

import importlib
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from pagemill.functions.text import non_blank
from pagemill.schemas import FEED_INFO, FEED_LATEST, FEED_PAGES

# The statuses that are tried again.
RETRY_STATUSES = frozenset({408, 429, 500, 502, 503, 504})


@dataclass
class Response:
    status: int
    content: bytes = b""

    def check(self) -> Response:
        if self.status >= 400:
            raise RuntimeError(f"HTTP {self.status}: {self.content[:200].decode('utf-8', 'replace')}")
        return self

    def json(self) -> Any:
        return json.loads(self.content.decode("utf-8"))


def with_query(url: str, params: dict[str, Any] | None) -> str:
    """The URL with parameters appended; those that are None are left out."""
    given = {k: v for k, v in (params or {}).items() if v is not None}
    return url + (("&" if "?" in url else "?") + urllib.parse.urlencode(given) if given else "")


def _open(url: str, headers: dict[str, str], timeout: float) -> Response:
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=timeout) as r:
            return Response(r.status, r.read())
    except urllib.error.HTTPError as e:
        return Response(e.code, e.read())


@dataclass
class HttpSession:
    """GET with merged headers; retries on RETRY_STATUSES and transport errors with doubling waits.
    The last answer is returned whatever its status; the last error is raised."""

    headers: dict[str, str] = field(default_factory=dict)
    retries: int = 3
    backoff: float = 0.5
    timeout: float = 30.0
    transport: Callable[[str, dict[str, str], float], Response] = _open
    sleep: Callable[[float], None] = time.sleep

    def get(self, url: str, params: dict[str, Any] | None = None, headers: dict[str, str] | None = None, timeout: float | None = None) -> Response:
        for attempt in range(self.retries + 1):
            last = attempt == self.retries
            try:
                r = self.transport(with_query(url, params), {**self.headers, **(headers or {})}, timeout or self.timeout)
                if r.status not in RETRY_STATUSES or last:
                    return r
            except (urllib.error.URLError, TimeoutError, OSError):
                if last:
                    raise
            self.sleep(self.backoff * 2**attempt)
        raise AssertionError("unreachable")


@dataclass
class Page:
    source_id: str
    series_id: str
    chapter_id: str
    page_index: int
    image_ref: str
    domain: str = "manga"
    metadata: dict[str, Any] = field(default_factory=dict)


class ChapterAdapter(ABC):
    """What a site must offer: chapters by cursor, the pages of one, the bytes of a page."""

    @abstractmethod
    def list_chapters(self, cursor: str | None = None) -> tuple[list[dict[str, Any]], str | None]: ...

    def series_chapters(self, series_id: str) -> list[dict[str, Any]]:
        raise NotImplementedError(f"{type(self).__name__} does not list the chapters of a series")

    @abstractmethod
    def chapter_pages(self, chapter_id: str) -> Sequence[Page]: ...

    @abstractmethod
    def download(self, page: Page) -> bytes: ...


class Request(NamedTuple):
    url: str
    params: dict[str, Any] | None = None
    headers: dict[str, str] | None = None


class RequestAdapter(ChapterAdapter):
    """A template for sites with a JSON interface. A site says what to ask (the three ``ask`` hooks) and
    how to read an answer (the two ``read`` hooks); sending, retries and failures are here."""

    def __init__(self, session: HttpSession | None = None):
        self.session = session or HttpSession()

    @abstractmethod
    def ask_chapters(self, cursor: str | None) -> Request: ...

    @abstractmethod
    def read_chapters(self, answer: Any) -> tuple[list[dict[str, Any]], str | None]: ...

    @abstractmethod
    def ask_pages(self, chapter_id: str) -> Request: ...

    @abstractmethod
    def read_pages(self, chapter_id: str, answer: Any) -> Sequence[Page]: ...

    @abstractmethod
    def ask_image(self, page: Page) -> Request: ...

    def list_chapters(self, cursor: str | None = None) -> tuple[list[dict[str, Any]], str | None]:
        return self.read_chapters(self.session.get(*self.ask_chapters(cursor)).check().json())

    def chapter_pages(self, chapter_id: str) -> Sequence[Page]:
        return self.read_pages(chapter_id, self.session.get(*self.ask_pages(chapter_id)).check().json())

    def download(self, page: Page) -> bytes:
        return self.session.get(*self.ask_image(page)).check().content


class JsonFeedAdapter(ChapterAdapter):
    """A feed with ``/latest``, ``/info`` and ``/read``."""

    def __init__(self, base_url: str, source_id: str = "feed", referer: str = "", session: HttpSession | None = None):
        self.base_url, self.source_id, self.referer = base_url.rstrip("/"), source_id, referer
        self.session = session or HttpSession()

    def _json(self, path: str, **params: Any) -> Any:
        return self.session.get(f"{self.base_url}/{path}", params, {"Referer": self.referer} if self.referer else None).check().json()

    def list_chapters(self, cursor: str | None = None) -> tuple[list[dict[str, Any]], str | None]:
        page = cursor_page(cursor)
        latest = self._json("latest", page=page)
        out = []
        for item in latest:
            series = str(item.get("id") or "").strip()
            chapters = [c for c in ((self._json("info", id=series).get("chapters") or [])[:1] if series else []) if str(c.get("id") or "").strip()]
            out += [{"series_id": series, "chapter_id": str(c["id"]).strip(), "title": item.get("title"), "last_update": item.get("last_update")} for c in chapters]
        return out, str(page + 1) if latest else None

    def chapter_pages(self, chapter_id: str) -> list[Page]:
        payload = self._json("read", chapterId=chapter_id)
        pages = [Page(self.source_id, chapter_id.split("/", 1)[0], chapter_id, int(p.get("page", 0)), str(p.get("img") or ""), metadata={"headers": p.get("headerForImage") or {}}) for p in payload.get("pages", [])]
        return sorted(pages, key=lambda p: p.page_index)

    def download(self, page: Page) -> bytes:
        """The image; a refusal is tried once more with the page's own referer if that differs."""
        r = self.session.get(page.image_ref, headers={"Referer": self.referer} if self.referer else None)
        own = str((page.metadata.get("headers") or {}).get("Referer") or "").strip()
        if r.status == 403 and own and own != self.referer:
            r = self.session.get(page.image_ref, headers={str(k): str(v) for k, v in page.metadata["headers"].items()})
        return r.check().content


    def series_info(self, series_id: str) -> dict[str, Any]:
        return self._json("info", id=series_id)

    def series_chapters(self, series_id: str) -> list[dict[str, Any]]:
        """The chapters of a series as listed, without those that have no id."""
        info = self.series_info(series_id)
        rows = [{"series_id": series_id, "chapter_id": str(c.get("id") or "").strip(), "title": c.get("title"), "is_new": bool(c.get("isNew"))} for c in info.get("chapters") or []]
        return [r for r in rows if r["chapter_id"]]


def chosen_chapters(adapter: ChapterAdapter, series: Sequence[str] | None = None, pages: int = 1, most: int | None = None) -> list[str]:
    """Chapter ids of the given series, or else of the first ``pages`` pages of the latest feed; each
    once, ``most`` of them at most. A feed that gives no further cursor has ended."""
    ids: list[str] = []
    if series:
        for s in series:
            ids += [c["chapter_id"] for c in adapter.series_chapters(s)]
    else:
        cursor: str | None = None
        for _ in range(max(pages, 1)):
            rows, cursor = adapter.list_chapters(cursor)
            ids += [c["chapter_id"] for c in rows]
            if cursor is None:
                break
    return list(dict.fromkeys(ids))[:most]


def cursor_page(cursor: str | None) -> int:
    """The page number of a cursor: none is 1, never below 1; anything but a number is an error."""
    return 1 if cursor is None else max(1, int(cursor))


def cursor_column(c: Column) -> Column:
    return F.greatest(F.lit(1), F.coalesce(c.cast("int"), F.lit(1)))


def load_class(path: str) -> type:
    """A class by ``module:Name``."""
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def load_adapter(path: str, kwargs: dict[str, Any]) -> ChapterAdapter:
    """The adapter of a class path; an object of another kind is an error."""
    adapter = load_class(path)(**kwargs)
    if not isinstance(adapter, ChapterAdapter):
        raise TypeError(f"{path} is no {ChapterAdapter.__name__}")
    return adapter


def latest_items(feed: DataFrame, payload: str = "payload") -> DataFrame:
    """The items of landed ``/latest`` payloads that have an id."""
    items = feed.select(F.inline(F.from_json(payload, FEED_LATEST)))
    return items.withColumn("id", non_blank(F.col("id"))).where("id is not null")


def info_chapters(feed: DataFrame, payload: str = "payload", limit: int | None = None) -> DataFrame:
    """The chapters of landed ``/info`` payloads: the first ``limit`` as listed, then without those
    that have no id; series without an id give none."""
    info = feed.select(F.from_json(payload, FEED_INFO).alias("i")).where(non_blank(F.col("i.id")).isNotNull())
    chapters = F.col("i.chapters") if limit is None else F.slice("i.chapters", 1, max(limit, 0))
    rows = info.select(non_blank(F.col("i.id")).alias("series_id"), F.col("i.title").alias("series_title"), F.col("i.status").alias("status"), F.posexplode(chapters).alias("position", "c"))
    return rows.select("series_id", "series_title", "status", "position", non_blank(F.col("c.id")).alias("chapter_id"), F.col("c.title").alias("chapter_title"), F.coalesce("c.isNew", F.lit(False)).alias("is_new")).where("chapter_id is not null")


def latest_chapters(latest: DataFrame, info: DataFrame) -> DataFrame:
    """The first chapter of each series of a landed latest feed, with merged metadata: a field of the
    latest feed if it says something, else that of the series."""
    first = info_chapters(info, limit=1)
    pick = lambda a, b: F.coalesce(non_blank(F.col(a)), F.col(b))
    return latest_items(latest).alias("l").join(first.alias("f"), F.col("l.id") == F.col("f.series_id")).select(
        "f.series_id", "f.chapter_id", pick("l.title", "f.series_title").alias("title"), pick("l.status", "f.status").alias("status"), pick("l.last_chapter", "f.chapter_title").alias("last_chapter"), "l.last_update",
    )


def read_pages(feed: DataFrame, chapter: str = "chapter_id", payload: str = "payload") -> DataFrame:
    """The pages of landed ``/read`` payloads; the series is what stands before the first slash."""
    p = feed.select(chapter, F.from_json(payload, f"struct<{FEED_PAGES.replace(' array', ':array').replace(' string', ':string')}>").alias("p"))
    rows = p.select(chapter, F.col("p.next").alias("next_chapter"), F.col("p.prev").alias("prev_chapter"), F.explode("p.pages").alias("g"))
    return rows.select(F.substring_index(chapter, "/", 1).alias("series_id"), chapter, F.coalesce("g.page", F.lit(0)).alias("page_index"), F.coalesce("g.img", F.lit("")).alias("image_ref"), F.col("g.headerForImage").alias("image_headers"), "next_chapter", "prev_chapter")


class _Chapter(InputPartition):
    def __init__(self, chapter_id: str):
        super().__init__(chapter_id)
        self.chapter_id = chapter_id


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.adapter, self.kwargs = options["adapter"], json.loads(options.get("kwargs", "{}"))
        self.chapters = json.loads(options["chapters"])
        self.fail_fast = options.get("failfast", "false").lower() == "true"

    def partitions(self) -> list[InputPartition]:
        return [_Chapter(c) for c in self.chapters]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        adapter, chapter = load_adapter(self.adapter, self.kwargs), partition.chapter_id
        try:
            pages = adapter.chapter_pages(chapter)
        except Exception as e:
            if self.fail_fast:
                raise
            yield (None, None, chapter, None, None, None, None, "list_pages", str(e))
            return
        for p in sorted(pages, key=lambda p: p.page_index):
            try:
                yield (p.source_id, p.series_id, chapter, p.page_index, p.image_ref, p.domain, adapter.download(p), None, None)
            except Exception as e:
                if self.fail_fast:
                    raise
                yield (p.source_id, p.series_id, chapter, p.page_index, p.image_ref, p.domain, None, "download_page", str(e))


class ChapterSource(DataSource):
    """``spark.read.format("chapters")`` with options adapter (module:Class), kwargs (JSON), chapters
    (JSON list), failfast. A row is a page with its bytes, or an error with its stage."""

    @classmethod
    def name(cls) -> str:
        return "chapters"

    def schema(self) -> str:
        return "source_id string, series_id string, chapter_id string, page_index int, image_ref string, domain string, content binary, error_stage string, error string"

    def reader(self, schema: Any) -> DataSourceReader:
        return _Reader({k.lower(): v for k, v in self.options.items()})


def chapter_report(rows: DataFrame) -> DataFrame:
    """Per chapter: pages, page errors, status and first page, of what the source delivered."""
    ok = F.col("error").isNull()
    return rows.groupBy("chapter_id").agg(
        F.count_if(ok).alias("pages"), F.count_if(~ok).alias("page_errors"), F.min(F.when(ok, F.col("page_index"))).alias("first_page"),
    ).withColumn("status", F.when(F.col("page_errors") == 0, "ok").when(F.col("pages") > 0, "partial").otherwise("failed"))
