"""The remote service: row counts, keys and pages, over HTTP.

A page is the body of an answer as it was sent, a JSON list of records; what it holds is read in
Spark. Pages are asked for by key, the next one from the last key of the one before, so that
rows which come or go meanwhile neither double nor hide others.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from dataclasses import dataclass

# Fixed values of the remote query protocol.
COUNT_SELECT = "count(*)"
SYSTEM_AND_OTHERS = ":*,*"
ROW_ID = ":id"
CREATED_AT = ":created_at"
UPDATED_AT = ":updated_at"
TOKEN_HEADER = "X-App-Token"


# Answers that a later call may mend, and seconds to wait before each further call.
RETRIED = (429, 500, 502, 503, 504)
WAITS = (1, 4, 16)
LONGEST_WAIT = 120


class PageError(RuntimeError):
    """The remote answered with something other than a list of rows."""


@dataclass(frozen=True)
class Page:
    body: str
    rows: int
    last_key: str | None


class HttpClient:
    """Pages over HTTP. A call that keeps failing raises, and Spark retries the task."""

    def __init__(self, url: str, token: str | None = None, timeout: int = 300):
        if urllib.parse.urlsplit(url).scheme not in ("http", "https"):
            raise ValueError(f"not an http(s) address: {url}")
        self.url = url
        self.timeout = timeout
        self._headers = {TOKEN_HEADER: token} if token else {}

    def count(self, since: str | None) -> int:
        return int(self._rows({"$select": COUNT_SELECT, **_where(_changed(since))})[1][0]["count"])

    def key_at(self, offset: int, since: str | None) -> str | None:
        """The key of the row at ``offset`` in the order of keys; None beyond the last."""
        paging = {"$select": ROW_ID, "$order": ROW_ID, "$limit": 1, "$offset": offset}
        rows = self._rows({**paging, **_where(_changed(since))})[1]
        return rows[0][ROW_ID] if rows else None

    def page(
        self, since: str | None, limit: int, start: str | None, after: str | None, stop: str | None
    ) -> Page:
        """The first ``limit`` rows from the key ``start`` on, or behind ``after``, before ``stop``."""
        bounds = [(">=", start if after is None else None), (">", after), ("<", stop)]
        keys = [f"{ROW_ID}{sign}{_literal(key)}" for sign, key in bounds if key is not None]
        where = _where(_changed(since), *keys)
        body, rows = self._rows({"$select": SYSTEM_AND_OTHERS, **where, "$order": ROW_ID, "$limit": limit})
        return Page(body, len(rows), rows[-1][ROW_ID] if rows else None)

    def _rows(self, query: dict[str, object]) -> tuple[str, list[dict]]:
        text = urllib.parse.urlencode(query, safe="$:", quote_via=urllib.parse.quote)
        request = urllib.request.Request(f"{self.url}?{text}", headers=self._headers)
        body = self._fetch(request).decode()
        rows = json.loads(body)
        if not isinstance(rows, list):
            raise PageError(f"{self.url} answered with {body[:500]}")
        return body, rows

    def _fetch(self, request: urllib.request.Request) -> bytes:
        """The answer; a busy or failing service is asked again after a growing wait."""
        for wait in (*WAITS, None):
            try:
                with urllib.request.urlopen(request, timeout=self.timeout) as response:
                    return response.read()
            except urllib.error.HTTPError as error:
                if wait is None or error.code not in RETRIED:
                    raise
                asked = error.headers.get("Retry-After", "")
                time.sleep(min(int(asked) if asked.isdigit() else wait, LONGEST_WAIT))
        raise AssertionError("unreachable")


def _literal(key: str) -> str:
    return "'" + key.replace("'", "''") + "'"


def _changed(since: str | None) -> str | None:
    if since is None:
        return None
    dt.date.fromisoformat(since)
    return f"{CREATED_AT}>='{since}' OR {UPDATED_AT}>='{since}'"


def _where(changed: str | None, *keys: str) -> dict[str, str]:
    parts = [f"({changed})" if keys and changed else changed, *keys]
    text = " AND ".join(part for part in parts if part)
    return {"$where": text} if text else {}
