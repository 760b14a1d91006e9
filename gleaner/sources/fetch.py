"""Polite fetching of URLs: one task for each host's URLs, robots.txt, a delay per host and retries.

Errors become rows, never exceptions. The transport is a callable, so that tests and other clients
can bring their own; the default uses the standard library.
"""

from __future__ import annotations

import random
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from urllib.parse import urlsplit
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "url string, final_url string, status int, content_type string, text string, content binary, elapsed_ms int, from_robots_block boolean, error string"


@dataclass(frozen=True)
class Response:
    """What a transport gives: status, final URL, content type and body."""

    status: int
    url: str
    content_type: str
    body: bytes


Transport = Callable[[str, dict, float], Response]


def http_transport(url: str, headers: dict, timeout: float) -> Response:
    """A GET by the standard library; an HTTP error status is a response."""
    request = urllib.request.Request(url, headers=headers)
    try:
        with urllib.request.urlopen(request, timeout=timeout) as r:
            return Response(r.status, r.geturl(), r.headers.get("Content-Type", ""), r.read())
    except urllib.error.HTTPError as e:
        return Response(e.code, url, e.headers.get("Content-Type", ""), e.read())


@dataclass(frozen=True)
class Settings:
    user_agent: str = "gleaner"
    timeout: float = 30.0
    attempts: int = 3
    delay: float = 1.0
    backoff: float = 2.0
    jitter: float = 0.25
    respect_robots: bool = True
    headers: dict = field(default_factory=lambda: {"Accept-Language": "en-IN"})
    transport: Transport = http_transport
    #: Renders a page in a browser: (url, timeout) to its HTML. There is none in this library.
    renderer: Callable[[str, float], str] | None = None
    sleep: Callable[[float], None] = time.sleep


def retry(call: Callable[[], Response], attempts: int, delay: float, backoff: float, jitter: float, sleep: Callable[[float], None]) -> Response:
    """`call` until it succeeds, at most `attempts` times, with growing waits; the last exception goes on."""
    for n in range(attempts):
        try:
            return call()
        except Exception:
            if n + 1 == attempts:
                raise
            sleep(delay * backoff**n * (1 + random.uniform(-jitter, jitter)))
    raise ValueError("attempts must be positive")


def decoded(r: Response) -> str:
    """The body as text: by the stated charset, but a missing one or Latin-1 is tried as UTF-8 first."""
    m = re.search(r"charset=[\"']?([\w.:-]+)", r.content_type, re.IGNORECASE)
    stated = m[1].lower() if m else ""
    for charset in [stated] * (stated not in ("", "iso-8859-1", "latin-1")) + ["utf-8"]:
        try:
            return r.body.decode(charset)
        except (UnicodeDecodeError, LookupError):
            continue
    return r.body.decode("latin-1")


class HostFetcher:
    """Fetches of one task: robots rules and the time of the last fetch are kept for each host."""

    def __init__(self, settings: Settings) -> None:
        self.s, self.robots, self.last = settings, {}, {}

    def _headers(self) -> dict:
        return {"User-Agent": self.s.user_agent, **self.s.headers}

    def rules(self, host: str) -> RobotFileParser:
        if host not in self.robots:
            p = RobotFileParser()
            p.parse([])
            try:
                r = self.s.transport(f"{host}/robots.txt", self._headers(), self.s.timeout)
                text = r.body.decode("utf-8", "replace")
                if r.status == 200 and not text.lstrip()[:1] == "<":  # a page in place of the rules says nothing
                    p.parse(text.splitlines())
            except Exception:
                pass  # no rules: all is allowed
            self.robots[host] = p
        return self.robots[host]

    def fetch(self, url: str) -> dict:
        row = {"url": url, "final_url": url, "status": None, "content_type": None, "text": None, "content": None, "elapsed_ms": 0, "from_robots_block": False, "error": None}
        began = time.monotonic()
        try:
            parts = urlsplit(url)
            if not parts.scheme or not parts.netloc:
                raise ValueError("no absolute URL")
            host = f"{parts.scheme}://{parts.netloc}"
            pause = self.s.delay
            if self.s.respect_robots:
                rules = self.rules(host)
                if not rules.can_fetch(self.s.user_agent, url):
                    return row | {"from_robots_block": True, "error": "robots-disallowed"}
                pause = max(pause, float(rules.crawl_delay(self.s.user_agent) or 0))
            wait = self.last.get(host, -1e9) + pause - time.monotonic()
            if wait > 0:
                self.s.sleep(wait)
            self.last[host] = time.monotonic()
            r = retry(lambda: self.s.transport(url, self._headers(), self.s.timeout), self.s.attempts, self.s.delay, self.s.backoff, self.s.jitter, self.s.sleep)
            text = decoded(r) if not re.search(r"pdf|image|octet", r.content_type, re.IGNORECASE) else None
            row |= {"final_url": r.url, "status": r.status, "content_type": r.content_type, "text": text, "content": r.body}
            if not 200 <= r.status < 300:
                row["error"] = f"http-{r.status}"
        except Exception as e:
            row["error"] = f"{type(e).__name__}: {e}"
        return row | {"elapsed_ms": int((time.monotonic() - began) * 1000)}


def fetch(urls: DataFrame, settings: Settings | None = None) -> DataFrame:
    """A row of SCHEMA for each distinct URL of `urls` (url).

    The URLs of a host go to one task, in order, so its delay holds however many tasks there are; a
    host with very many URLs is slow by intent. Null URLs are left out.
    """
    s = settings or Settings()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = HostFetcher(s)
        for b in batches:
            yield pd.DataFrame([f.fetch(u) for u in b["url"]], columns=[c.split()[0] for c in SCHEMA.split(", ")]).astype({"status": "Int32"})

    host = F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    return urls.where("url is not null").select("url").distinct().repartition(host).sortWithinPartitions(host, "url").mapInPandas(run, SCHEMA)


def crawl(urls: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The same as `fetch`: the given URLs only, no links are followed."""
    return fetch(urls, settings)


def render(urls: DataFrame, settings: Settings) -> DataFrame:
    """(url, text, error) of each distinct URL by the renderer of `settings`; its failures, and its absence, are errors in the row."""

    def one(url: str) -> tuple[str | None, str | None]:
        if settings.renderer is None:
            return None, "RendererUnavailable: no renderer is set"
        try:
            return settings.renderer(url, settings.timeout), None
        except Exception as e:
            return None, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(u, *one(u)) for u in b["url"]]
            yield pd.DataFrame(out, columns=["url", "text", "error"])

    return urls.where("url is not null").select("url").distinct().mapInPandas(run, "url string, text string, error string")


def extract_or_render(pages: DataFrame, extract: Callable[[DataFrame], DataFrame], settings: Settings) -> DataFrame:
    """What `extract` gives of pages (url, text, method): rows that keep `url`; pages without a row are rendered and extracted once more.

    The rows get `method`: the page's own, or 'dynamic' after rendering. Which pages gave rows is found by an anti join on url.
    """
    first = extract(pages)
    empty = pages.join(first.select("url").distinct(), "url", "left_anti").select("url")
    rendered = render(empty, settings).where("text is not null").select("url", "text", F.lit("dynamic").alias("method"))
    return first.join(pages.select("url", "method"), "url").unionByName(extract(rendered).withColumn("method", F.lit("dynamic")))


def with_snapshots(urls: DataFrame, snapshots: DataFrame, settings: Settings | None = None) -> DataFrame:
    """(url, text, method): pages from the snapshot table (url, text) where it has them, fetched where not."""
    kept = urls.join(snapshots.select("url", "text"), "url").select("url", "text", F.lit("cache").alias("method"))
    missing = urls.join(snapshots.select("url"), "url", "left_anti")
    return kept.unionByName(fetch(missing, settings).select("url", "text", F.lit("static").alias("method")))
