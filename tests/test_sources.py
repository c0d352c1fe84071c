from __future__ import annotations

import io
import json
import urllib.error
import urllib.parse

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.casts import CORRUPT, coerce
from tidemark.functions.json_text import flatten_pages, page_records
from tidemark.operators.changes import changed_since
from tidemark.operators.pages import ROW_NO, number_rows, one_page, page_offsets
from tidemark.sources import clients, paged
from tidemark.sources.clients import HttpClient, PageError
from tidemark.sources.landing import drift_of, land, land_pages, read_landed
from tidemark.sources.table_pages import TablePages

SCHEMA = StructType().add("num", "long").add("name", "string")


@pytest.fixture(scope="module")
def rows_35(spark):
    return spark.range(35).select(
        F.format_string("row-%04d", 34 - F.col("id")).alias(":id"),
        (34 - F.col("id")).alias("num"),
        F.concat(F.lit("n"), 34 - F.col("id")).alias("name"),
    )


@pytest.mark.parametrize("parts", [1, 5])
def test_rows_are_numbered_in_order(rows_35, workspace, parts):
    numbered = number_rows(rows_35.repartition(parts), ":id", workspace)
    assert sorted((r[ROW_NO], r["num"]) for r in numbered.collect()) == [(n, n) for n in range(35)]
    assert sorted(r["num"] for r in one_page(numbered, 20, 10).collect()) == list(range(20, 30))
    assert one_page(numbered, 35, 10).collect() == []
    assert number_rows(rows_35.limit(0), ":id", workspace).collect() == []


def test_no_task_sees_all_rows(rows_35, workspace):
    plan = number_rows(rows_35, ":id", workspace)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_page_starts(spark, rows_35):
    assert [r[0] for r in page_offsets(rows_35, 10).collect()] == list(paged.page_starts(35, 10)) == [0, 10, 20, 30]
    assert page_offsets(rows_35.limit(0), 10).collect() == [] == list(paged.page_starts(0, 10))


def test_table_pages(rows_35, workspace):
    source = TablePages(rows_35.repartition(4), ":id", hidden=(":id",), stride=10)
    pages = sorted(source.pages(None, workspace).collect(), key=lambda p: int(p["after"]))
    sent = [[int(r["num"]) for r in json.loads(p["body"])] for p in pages]
    assert sent == [list(range(k, min(k + 10, 35))) for k in range(0, 40, 10)]
    assert json.loads(pages[0]["body"])[1] == {"num": "1", "name": "n1"}
    assert source.serving(rows_35.limit(0)).pages(None, workspace).collect() == []


DELTA_EDGES = [
    (1, "2024-01-01", "2024-01-01"),
    (2, "2024-01-01", "2024-01-02"),
    (3, "2024-01-01", "2024-01-03"),
    (4, "2024-01-02", "2024-01-01"),
    (5, "2024-01-03", "2024-01-01"),
    (6, None, "2024-01-01"),
    (7, None, "2024-01-02"),
]


@pytest.mark.parametrize("kind", ["string", "timestamp", "timestamp_ntz", "date"])
def test_changed_since_is_inclusive_and_either_way(spark, kind):
    df = spark.createDataFrame(DELTA_EDGES, "n int, c string, u string")
    df = df.select("n", F.col("c").cast(kind).alias("c"), F.col("u").cast(kind).alias("u"))
    got = changed_since(df, "c", "u", "2024-01-02")
    assert sorted(r["n"] for r in got.collect()) == [2, 3, 4, 5, 7]


def test_delta_pages(spark, workspace):
    df = spark.createDataFrame(DELTA_EDGES, "num int, c string, u string").withColumn("name", F.lit("x"))
    source = TablePages(df, "num", "c", "u", hidden=("c", "u"), stride=2)
    pages = source.pages("2024-01-02", workspace)
    got = coerce(flatten_pages(pages, "body", SCHEMA), SCHEMA)
    assert sorted(r["num"] for r in got.collect()) == [2, 3, 4, 5, 7]
    assert pages.count() == 3


class Remote:
    """Stands in for the service: keeps each call, answers with ``body``."""

    def __init__(self, body):
        self.body = body
        self.calls = []

    def __call__(self, request, timeout):
        query = urllib.parse.urlsplit(request.full_url).query
        self.calls.append((dict(urllib.parse.parse_qsl(query)), dict(request.header_items())))
        return io.BytesIO(json.dumps(self.body).encode())


def http(monkeypatch, body, **options):
    remote = Remote(body)
    monkeypatch.setattr(clients.urllib.request, "urlopen", remote)
    return HttpClient("https://example.org/rows.json", **options), remote


def test_http_count(monkeypatch):
    client, remote = http(monkeypatch, [{"count": "35"}])
    assert client.count(None) == 35
    assert client.count("2022-05-02") == 35
    full, delta = (query for query, _ in remote.calls)
    assert full == {"$select": "count(*)"}
    assert delta["$where"] == ":created_at>='2022-05-02' OR :updated_at>='2022-05-02'"


def test_http_page(monkeypatch):
    body = [{":id": "a", "num": 1.50, "name": None}, {":id": "it's", "extra": "e"}]
    client, remote = http(monkeypatch, body, token="secret")
    page = client.page("2022-05-02", 100, "k", None, "z")
    assert (page.rows, page.last_key, json.loads(page.body)) == (2, "it's", body)
    client.page(None, 100, "k", "it's", None)
    (first, headers), (second, _) = remote.calls
    assert first["$order"] == ":id" and first["$limit"] == "100" and first["$select"] == ":*,*"
    changed = ":created_at>='2022-05-02' OR :updated_at>='2022-05-02'"
    assert first["$where"] == f"({changed}) AND :id>='k' AND :id<'z'"
    assert second["$where"] == ":id>'it''s'"
    assert headers["X-app-token"] == "secret"


def test_http_without_token_sends_no_header(monkeypatch):
    client, remote = http(monkeypatch, [{"count": "1"}])
    client.count(None)
    assert "X-app-token" not in remote.calls[0][1]


def test_http_error_body_raises(monkeypatch):
    client, _ = http(monkeypatch, {"message": "bad query"})
    with pytest.raises(PageError, match="bad query"):
        client.page(None, 10, None, None, None)


def test_http_refuses_other_addresses_and_dates(monkeypatch):
    with pytest.raises(ValueError):
        HttpClient("file:///etc/passwd")
    client, _ = http(monkeypatch, [])
    with pytest.raises(ValueError):
        client.count("2022-05-02' OR '1'='1")


class Service(Remote):
    """Serves ``rows`` by key; ``moves`` come and go before the call of that number."""

    def __init__(self, rows, most=1000, moves=()):
        super().__init__(None)
        self.rows = {row[":id"]: row for row in rows}
        self.most, self.moves = most, dict(moves)

    def __call__(self, request, timeout):
        super().__call__(request, timeout)
        query, _ = self.calls[-1]
        for change, row in self.moves.pop(len(self.calls), ()):
            self.rows.pop(row[":id"], None) if change == "delete" else self.rows.update({row[":id"]: row})
        keys = sorted(self.rows)
        for part in query.get("$where", "").split(" AND "):
            for sign, holds in ((">=", str.__ge__), (">", str.__gt__), ("<", str.__lt__)):
                if part.startswith(":id" + sign):
                    bound = part.removeprefix(":id" + sign).strip("'")
                    keys = [k for k in keys if holds(k, bound)]
                    break
        if query.get("$select") == "count(*)":
            answer = [{"count": str(len(keys))}]
        else:
            first = int(query.get("$offset", 0))
            answer = [self.rows[k] for k in keys[first : first + min(int(query["$limit"]), self.most)]]
        return io.BytesIO(json.dumps(answer).encode())


def served(n):
    return [{":id": f"row-{k:04d}", "num": k, "name": f"n{k}"} for k in range(n)]


def read_all(monkeypatch, remote, **options):
    monkeypatch.setattr(clients.urllib.request, "urlopen", remote)
    options = {"location": "https://example.org/rows.json", "token": "t", **options}
    reader = paged.PagedReader(options)
    ranges = reader.partitions()
    bodies = [body for part in ranges for batch in reader.read(part) for body in batch["body"].to_pylist()]
    return ranges, [row["num"] for body in bodies for row in json.loads(body)]


@pytest.mark.parametrize("since", [None, "2022-05-02"])
def test_reader_over_http(monkeypatch, since):
    remote = Service(served(35))
    options = {"since": since} if since else {}
    ranges, got = read_all(monkeypatch, remote, page_stride="10", page_limit="4", **options)
    assert len(ranges) == 4 and got == list(range(35))
    assert ranges[1] == paged.KeyRange("row-0010", "row-0020")
    assert all(headers["X-app-token"] == "t" for _, headers in remote.calls)
    assert all((":created_at" in query.get("$where", "")) == (since is not None) for query, _ in remote.calls)


def test_several_pages_per_task(monkeypatch):
    ranges, got = read_all(monkeypatch, Service(served(35)), page_stride="10", pages_per_task="3")
    assert len(ranges) == 2 and got == list(range(35))


def test_service_that_sends_fewer_rows_than_asked_for(monkeypatch):
    _, got = read_all(monkeypatch, Service(served(35), most=3), page_stride="10")
    assert got == list(range(35))


def test_no_rows(monkeypatch):
    assert read_all(monkeypatch, Service([])) == ([], [])


@pytest.mark.parametrize("at", range(2, 16))
def test_rows_that_come_and_go_while_reading(monkeypatch, at):
    rows = served(35)
    moves = [("delete", rows[2]), ("delete", rows[10]), ("delete", rows[20])]
    moves += [("insert", {":id": f"row-{k:04d}-new", "num": 1000 + k}) for k in (0, 9, 19, 34)]
    _, got = read_all(monkeypatch, Service(rows, moves={at: moves}), page_stride="10", page_limit="4")
    assert len(got) == len(set(got))
    assert set(range(35)) - {2, 10, 20} <= set(got) <= set(range(35)) | {1000, 1009, 1019, 1034}


@pytest.mark.parametrize("options", [{"page_stride": "10", "page_limit": "11"}, {"page_stride": "0"}])
def test_overlapping_or_empty_pages_are_refused(options):
    with pytest.raises(ValueError, match="page_limit"):
        paged.PagedReader({"location": "https://example.org", **options})


def test_source_has_a_schema_of_its_own(spark):
    paged.register(spark)
    df = spark.read.format(paged.FORMAT).load(location="https://example.org/rows.json")
    assert df.columns == ["after", "body"]


def test_busy_service_is_asked_again(monkeypatch):
    waits, answers = [], [429, 503, 200]

    def opened(request, timeout):
        code = answers.pop(0)
        if code != 200:
            raise urllib.error.HTTPError(request.full_url, code, "busy", {"Retry-After": "7"}, None)
        return io.BytesIO(b'[{"count": "35"}]')

    monkeypatch.setattr(clients.urllib.request, "urlopen", opened)
    monkeypatch.setattr(clients.time, "sleep", waits.append)
    assert HttpClient("https://example.org/rows.json").count(None) == 35
    assert waits == [7, 7]


def test_all_that_records_hold_is_landed(spark, tmp_path):
    body = """[ {"num": "007", "f": 1.50, "big": 12345678901234567890.123456789012345678, "z": null},
        {"name": "a \\n b \\u00e9 ü", "nested": {"a": [1, {"b": 2.0}]},
         "num": null}, {} ]"""
    pages = spark.createDataFrame([(body,), ("[]",)], "body string")
    land_pages(pages, str(tmp_path), "rows", "2024-01-02")
    landed = spark.read.text(f"{tmp_path}/rows/2024/1/2")
    lines = [r[0] for r in landed.collect()]
    assert [json.loads(line) for line in lines] == json.loads(body)
    assert "12345678901234567890.123456789012345678" in lines[0]
    schema = StructType().add("num", "string").add("f", "string").add("nested", "string").add("gone", "string")
    schema = schema.add("big", "string")
    raw = read_landed(spark, str(tmp_path), "rows", "2024-01-02", schema)
    assert [r["big"] for r in raw.filter("big is not null").collect()] == ["12345678901234567890.123456789012345678"]
    found = {tuple(r)[:4] for r in raw.select(*schema.names).collect()}
    assert ("007", "1.5", None, None) in found and (None, None, None, None) in found
    assert any(r[2] and json.loads(r[2]) == {"a": [1, {"b": 2.0}]} for r in found)
    drift = drift_of(spark, str(tmp_path), "rows", "2024-01-02", schema)
    assert drift.undeclared == ("name", "z") and drift.absent == ("gone",)


def test_lines_that_are_no_records(spark, tmp_path):
    path = tmp_path / "rows/2024/1/2"
    path.mkdir(parents=True)
    (path / "part").write_text('{"num": "1"}\n\n{"num": \nnot json\n[1]\n')
    raw = read_landed(spark, str(tmp_path), "rows", "2024-01-02", SCHEMA)
    rows = {(r["num"], r[CORRUPT]) for r in raw.collect()}
    assert rows == {("1", None), (None, '{"num": '), (None, "not json"), (None, "[1]")}


def test_an_error_answer_is_no_page(spark):
    pages = spark.createDataFrame([('{"message": "bad"}',)], "body string")
    with pytest.raises(Exception, match="expected a JSON list"):
        page_records(pages).collect()


def test_landing_keeps_microseconds_and_replaces_the_day(spark, tmp_path):
    schema = StructType().add("n", "long").add("at", "timestamp_ntz").add("z", "timestamp")
    text = "2024-01-01 00:00:07.179575"
    df = spark.sql(f"select 1L n, timestamp_ntz '{text}' at, timestamp '{text}' z")
    land(df.union(df), str(tmp_path), "events", "2024-01-02")
    path = land(df, str(tmp_path), "events", "2024-01-02")
    assert path.endswith("events/2024/1/2")
    back = coerce(read_landed(spark, str(tmp_path), "events", "2024-01-02", schema), schema)
    assert back.collect() == df.collect()
