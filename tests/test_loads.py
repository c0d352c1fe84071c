"""Full and incremental loads, page by page, on hand-made eviction rows."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark import storage
from tidemark.operators.merge import MultipleMatchError
from tidemark.plans.evictions import MAIN_SCHEMA, REFERENCE_SCHEMA, evictions_spec
from tidemark.plans.loads import Loader
from tidemark.plans.merges import merge_stored
from tidemark.plans.spec import LoadSpec
from tidemark.sources import tables
from tidemark.sources.landing import DriftError
from tidemark.sources.table_pages import TablePages
from tidemark.sources.tables import NO_MONTH, MissingTable, StoredTable
from tidemark.workspace import shared_root

NAME = "geographic_area_neighborhood_tabulation_area_nta_name"
POPULATION = "total_population_2010_number"
AREAS = [("Park", "100"), ("Hill", "200"), ("Park", "100")]

SYSTEM = ("row_id", "created", "updated")


def eviction(docket, court="c", day="2022-04-01T00:00:00.000", created="2022-04-01", **values):
    """Text as the remote sends it; ``created`` doubles as the update time."""
    base = {"docket_number": docket, "court_index_number": court, "executed_date": day}
    return {**base, "nta": "Park", "eviction_possession": "P", "_created": created, **values}


class Site:
    """A remote with two datasets, and a loader that reads it."""

    def __init__(self, spark, folder, **options):
        self.spark = spark
        self.loader = Loader(spark, evictions_spec({}, {}, **options), str(folder / "lake"))

    def serve(self, rows, areas=AREAS, extra=()):
        """``rows`` from now on, and ``areas``; without these, reading them fails."""
        names = [*MAIN_SCHEMA.names, *extra]
        data = [
            (f"{i:05d}", r["_created"], r["_created"], *[r.get(n) for n in names])
            for i, r in enumerate(rows)
        ]
        schema = StructType()
        for name in [*SYSTEM, *names]:
            schema.add(name, "string")
        main = self.spark.createDataFrame(data, schema)
        pages = TablePages(main, "row_id", "created", "updated", SYSTEM, stride=2)
        reference = None
        if areas is not None:
            ref = self.spark.createDataFrame(areas, f"{NAME} string, {POPULATION} string")
            reference = TablePages(ref, NAME, stride=2)
        spec = self.loader.spec
        self.loader.spec = replace(
            spec, main=replace(spec.main, table=pages), reference=replace(spec.reference, table=reference)
        )

    def rows(self, *columns):
        columns = columns or ("docket_number", "eviction_possession", "bin", "nta")
        return sorted(
            (tuple(r) for r in self.loader.target.read().select(*columns).collect()), key=repr
        )


@pytest.fixture(params=[None, "executed_date"], ids=["whole", "monthly"])
def site(request, spark, tmp_path):
    return Site(spark, tmp_path, month_of=request.param)


def test_full_load(spark, site):
    copies = [eviction("1", bin="7")] * 3
    site.serve([*copies, eviction("2", nta="Nowhere"), eviction("3", nta=None)])
    report = site.loader.full_load("2022-04-05")
    assert site.rows() == [
        (1, "P", 7, ("Park", 100)),
        (2, "P", None, ("Nowhere", None)),
        (3, "P", None, (None, None)),
    ]
    assert report.null_key_rows == 0
    target = site.loader.target.read()
    assert target.columns == list(site.loader.spec.target_columns)
    assert target.schema["nta"].dataType.simpleString() == "struct<nta:string,population:bigint>"
    assert target.first()["executed_date"] == dt.datetime(2022, 4, 1)


def test_full_load_one_after_the_other(site):
    site.serve([eviction("1")])
    site.loader.full_load("2022-04-05", concurrent=False)
    assert len(site.rows()) == 1


def test_delta_load(site):
    site.serve([eviction("1", bin="1"), eviction("2", bin="2", day="2022-03-01")])
    site.loader.full_load("2022-04-05")
    changed = [
        eviction("2", day="2022-03-01", created="2022-04-06", eviction_possession="new"),
        eviction("3", day="2022-05-01", created="2022-04-06", eviction_possession="new"),
        eviction("4", created="2022-04-03"),
    ]
    # The reference dataset is not read again.
    site.serve(changed, areas=None)
    site.loader.delta_load("2022-04-06")
    expected = [
        (1, "P", 1, ("Park", 100)),
        (2, "P", None, ("Park", 100)),
        (3, "new", None, ("Park", 100)),
    ]
    assert site.rows() == expected
    site.loader.delta_load("2022-04-06")
    assert site.rows() == expected


def test_null_key_rows_are_reported_and_inserted_again(site):
    site.serve([eviction("1"), eviction(None), eviction("2", day=None)])
    assert site.loader.full_load("2022-04-05").null_key_rows == 2
    site.serve([eviction(None), eviction("2", day=None)])
    assert site.loader.delta_load("2022-04-06", "36").null_key_rows == 2
    assert sorted(r[0] for r in site.rows() if r[0]) == [1, 2, 2]
    assert len(site.rows()) == 5


def test_empty_delta_changes_nothing(site):
    site.serve([eviction("1")])
    site.loader.full_load("2022-04-05")
    before = site.rows()
    site.serve([], areas=None)
    site.loader.delta_load("2022-04-06")
    assert site.rows() == before


def test_full_load_starts_anew(site):
    site.serve([eviction("1"), eviction("2")])
    site.loader.full_load("2022-04-05")
    site.serve([eviction("2")])
    site.loader.full_load("2022-04-05")
    assert [r[0] for r in site.rows()] == [2]


def test_delta_without_full_load(site):
    with pytest.raises(MissingTable, match="full load"):
        site.loader.delta_load("2022-04-06")


def test_delta_onto_created_tables(spark, site):
    site.loader.create_tables()
    site.serve([eviction("1")], areas=None)
    site.loader.delta_load("2022-04-06")
    assert site.rows() == []
    site.serve([eviction("1", created="2022-04-04")], areas=None)
    site.loader.delta_load("2022-04-06")
    assert site.rows() == [(1, "P", None, ("Park", None))]
    site.loader.create_views()
    count = "select count(*) from evictions join stg_evictions using (docket_number)"
    assert spark.sql(count).first()[0] == 1


def test_names_follow_the_loads(spark, site):
    site.serve([eviction("1")])
    site.loader.full_load("2022-04-05")
    site.loader.create_views()
    for n in (2, 3):
        site.serve([eviction(str(k)) for k in range(n)])
        site.loader.full_load("2022-04-06")
        assert spark.sql("select count(*) from evictions").first()[0] == n
    site.serve([eviction("9", created="2022-04-06")], areas=None)
    site.loader.delta_load("2022-04-07")
    assert spark.sql("select count(*) from evictions").first()[0] == 4
    assert spark.sql("select count(*) from stg_evictions").first()[0] == 1


def test_names_last_beyond_a_loader_and_a_session(spark, tmp_path):
    folder = tmp_path / "a, 'b'"
    site = Site(spark, folder, month_of="executed_date")
    site.loader.create_tables()
    site.loader.create_views()
    other = spark.newSession()
    assert other.table("evictions").collect() == []
    assert other.table("evictions").schema.names == list(site.loader.spec.target_columns)
    for n, day in ((2, "2022-04-05"), (3, "2022-04-06")):
        # Each load is that of a loader of its own.
        site = Site(spark, folder, month_of="executed_date")
        site.serve([eviction(str(k), day=f"2022-0{k + 1}-01") for k in range(n)])
        site.loader.full_load(day)
        assert other.table("evictions").count() == n
    site = Site(spark, folder, month_of="executed_date")
    site.serve([eviction("9", day="2022-01-01", created="2022-04-06")], areas=None)
    site.loader.delta_load("2022-04-07")
    assert sorted(r[0] for r in other.sql("select docket_number from evictions").collect()) == [0, 1, 2, 9]
    assert other.table("evictions").schema["nta"].dataType.simpleString() == "struct<nta:string,population:bigint>"


def test_names_of_another_lake_are_left(spark, tmp_path):
    first, second = Site(spark, tmp_path / "first"), Site(spark, tmp_path / "second")
    first.serve([eviction("1")])
    first.loader.full_load("2022-04-05")
    first.loader.create_views()
    second.serve([eviction("1"), eviction("2")])
    second.loader.full_load("2022-04-05")
    assert spark.table("evictions").count() == 1
    second.loader.create_views()
    first.loader.full_load("2022-04-05")
    assert spark.table("evictions").count() == 2


def test_failed_cast_leaves_the_target(site):
    site.serve([eviction("1")])
    site.loader.full_load("2022-04-05")
    site.serve([eviction("2"), eviction("x9")])
    with pytest.raises(Exception, match="docket_number: cannot read 'x9'"):
        site.loader.full_load("2022-04-06")
    assert [r[0] for r in site.rows()] == [1]


def test_missed_runs_lose_nothing(site):
    site.serve([eviction("1")])
    site.loader.full_load("2022-04-05")
    assert site.loader.target.mark() == "2022-04-05"
    # Changes of a week without a run, all before the look-back of the next one.
    rows = [eviction("1", created="2022-04-06", eviction_possession="x"), eviction("2", created="2022-04-08")]
    rows.append(eviction("3", day="2022-03-01", created="2022-04-05"))
    site.serve(rows, areas=None)
    site.loader.delta_load("2022-04-15")
    after_delta = site.rows("docket_number", "nta")
    assert [r[0] for r in after_delta] == [1, 2, 3] and site.loader.target.mark() == "2022-04-15"
    # A run without changes, and one for an earlier day, keep the mark and the rows.
    site.serve([], areas=None)
    site.loader.delta_load("2022-04-16")
    site.loader.delta_load("2022-04-10")
    assert site.loader.target.mark() == "2022-04-16"
    assert site.rows("docket_number", "nta") == after_delta
    site.serve(rows)
    site.loader.full_load("2022-04-17")
    assert site.rows("docket_number", "nta") == after_delta


def test_created_tables_have_no_mark(site):
    site.serve([eviction("1")])
    site.loader.full_load("2022-04-05")
    site.loader.create_tables()
    assert site.loader.target.mark() is None
    site.loader.delta_load("2022-04-05")
    assert site.loader.target.mark() is None
    site.loader.delta_load("2022-04-05", days_ago=0)
    assert site.loader.target.mark() == "2022-04-05"


def test_records_without_a_mark_are_read(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "t"), StructType().add("n", "long"))
    table.publish(spark.range(3).select(F.col("id").alias("n")))
    record = tmp_path / "t/_records/00000001.json"
    record.unlink()
    (tmp_path / "t/_records/.00000001.json.crc").unlink(missing_ok=True)
    record.write_text('{"": "v00000001"}')
    assert table.read().count() == 3 and table.mark() is None


def test_all_that_is_sent_is_landed(spark, site):
    site.serve([every_column("1", fee="7.50", note="x"), eviction("2", bin="3")], extra=("fee", "note"))
    report = site.loader.full_load("2022-04-05")
    main = site.loader.spec.main
    assert report.drift[main.name].undeclared == ("fee", "note")
    landed = spark.read.json(f"{site.loader.root}/landing/{main.name}/2022/4/5")
    assert {"fee", "note"} <= set(landed.columns)
    assert [r["fee"] for r in landed.filter("docket_number = '1'").collect()] == ["7.50"]


def every_column(docket, **values):
    full = {name: "1" for name in MAIN_SCHEMA.names}
    full |= {"executed_date": "2022-04-01", "nta": "Park", "docket_number": docket}
    return {**full, "_created": "2022-04-01", **values}


def test_renamed_key_fails_a_strict_load(spark, tmp_path):
    site = Site(spark, tmp_path)
    site.serve([every_column("1")])
    site.loader.full_load("2022-04-05")
    before = site.rows()
    renamed = [every_column(str(n), latitude=None, lat="1") for n in range(3)]
    site.serve(renamed, extra=("lat",))
    with pytest.raises(DriftError, match="lat"):
        site.loader.full_load("2022-04-06")
    assert site.rows() == before
    # One record that still has the key, or a key that is only new, is no rename.
    site.serve([*renamed, every_column("9")], extra=("lat",))
    report = site.loader.full_load("2022-04-07")
    assert report.drift[site.loader.spec.main.name].undeclared == ("lat",)


def test_permissive_load_reports_a_renamed_key(spark, tmp_path):
    site = Site(spark, tmp_path, strict=False)
    site.serve([every_column("1", latitude=None, lat="1")], extra=("lat",))
    drift = site.loader.full_load("2022-04-05").drift[site.loader.spec.main.name]
    assert (drift.undeclared, drift.absent) == (("lat",), ("latitude",))


def test_two_populations(site):
    areas = [("Park", "100"), ("Park", "101")]
    site.serve([eviction("1")], areas)
    site.loader.full_load("2022-04-05")
    assert [r[3] for r in site.rows()] == [("Park", 100), ("Park", 101)]
    site.serve([eviction("1")], areas=None)
    site.serve([eviction("1", created="2022-04-06")], areas=None)
    with pytest.raises(MultipleMatchError):
        site.loader.delta_load("2022-04-06")
    assert len(site.rows()) == 2


def test_rejects(spark, tmp_path):
    site = Site(spark, tmp_path, strict=False)
    site.serve([eviction("1"), eviction("x1")])
    assert site.loader.full_load("2022-04-05").rejected_rows == 1
    assert [r[0] for r in site.rows()] == [1]
    (reject,) = site.loader.rejects(site.loader.spec.main).read().collect()
    assert reject["columns"] == "docket_number" and '"x1"' in reject["record"]


def test_kept_column_can_be_turned_off(spark, tmp_path):
    site = Site(spark, tmp_path, keep_target=())
    site.serve([eviction("1")])
    site.loader.full_load("2022-04-05")
    site.serve([eviction("1", eviction_possession="new")])
    site.loader.delta_load("2022-04-05", 35)
    assert [r[1] for r in site.rows()] == ["new"]


def test_month_column_must_be_a_key():
    with pytest.raises(ValueError, match="month_of"):
        evictions_spec({}, {}, month_of="bin")


def test_token_stays_out_of_the_text_of_a_spec():
    spec: LoadSpec = evictions_spec({"token": "secret"}, {})
    assert "secret" not in repr(spec)


def test_session_zone_is_checked(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="UTC"):
            Loader(spark, evictions_spec({}, {}), str(tmp_path))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


ONE = StructType().add("day", "timestamp_ntz").add("n", "long")
WIDE = StructType([*ONE, StructField("v", StringType())])


def days(spark, *rows):
    df = spark.createDataFrame(rows, "day string, n long")
    return df.select(df["day"].cast("timestamp_ntz").alias("day"), "n")


def wide(spark, *rows):
    df = spark.createDataFrame(rows, "day string, n long, v string")
    return df.select(df["day"].cast("timestamp_ntz").alias("day"), "n", "v")


def test_publish_versions(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "t"), ONE)
    assert not table.exists()
    assert table.create_empty() == 1
    assert table.read().count() == 0
    for n in range(3):
        table.publish(days(spark, ("2024-01-01", n)).select("n", "day"))
    assert table.versions() == [3, 4]
    assert [r["n"] for r in table.read().collect()] == [2]


def test_uncommitted_version_is_not_read(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "t"), ONE)
    table.publish(days(spark, ("2024-01-01", 1)))
    (tmp_path / "t" / "v00000002").mkdir()
    assert [r["n"] for r in table.read().collect()] == [1]
    assert table.publish(days(spark, ("2024-01-01", 2))) == 3


def test_months(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "t"), ONE, month_of="day")
    table.publish(days(spark, ("2024-01-01", 1), ("2024-02-01", 2), (None, 3)))
    assert sorted(r["n"] for r in table.read(["2024-01", None]).collect()) == [1, 3]
    files = table.read(["2024-01"]).inputFiles()
    assert files and all("/load_month=2024-01/" in name for name in files)
    assert table.read(["1999-01"]).collect() == [] and table.read([]).collect() == []
    table.replace_months(days(spark, ("2024-02-05", 20)))
    assert sorted(r["n"] for r in table.read().collect()) == [1, 3, 20]


@pytest.mark.parametrize("step", ["written", "recorded", "cleaned"])
def test_a_dead_run_leaves_the_table_old_or_new(spark, tmp_path, monkeypatch, step):
    table = StoredTable(spark, str(tmp_path / "t"), ONE, month_of="day")
    table.publish(days(spark, ("2024-01-01", 1), ("2024-02-01", 2), (None, 3)))
    before = table.read()

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        if step == "written":
            patch.setattr(storage, "put_text", dies)
        elif step == "recorded":
            patch.setattr(StoredTable, "_clean", dies)
        else:
            patch.setattr(storage, "delete", dies)
        months = days(spark, ("2024-01-05", 10), ("2024-02-05", 20))
        try:
            table.replace_months(months)
        except RuntimeError:
            pass
    found = sorted(r["n"] for r in table.read().collect())
    assert found == ([1, 2, 3] if step == "written" else [3, 10, 20])
    # A reader that started before still finds its files.
    assert sorted(r["n"] for r in before.collect()) == [1, 2, 3]
    table.replace_months(days(spark, ("2024-02-07", 30), (None, 31)))
    assert sorted(r["n"] for r in table.read().collect()) == [found[0] if step == "written" else 10, 30, 31]


def test_replaced_months_and_dead_writes_are_cleaned(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "t"), ONE, month_of="day")
    table.publish(days(spark, ("2024-01-01", 1), ("2024-02-01", 2)))
    (tmp_path / "t" / "v00000002").mkdir()
    for n in (20, 21, 22):
        table.replace_months(days(spark, ("2024-02-05", n)))
    left = sorted(str(p.relative_to(tmp_path / "t")) for p in (tmp_path / "t").glob("v*/load_month=*"))
    assert left == [
        "v00000001/load_month=2024-01", "v00000004/load_month=2024-02", "v00000005/load_month=2024-02"
    ]
    assert not (tmp_path / "t" / "v00000002").exists()
    assert sorted(r["n"] for r in table.read().collect()) == [1, 22]


def folders(table):
    return sorted(folder[len(table.path) + 1 :] for folder in table.folders())


@pytest.mark.parametrize("month_of", [None, "day"])
def test_appended_rows_are_all_that_is_written(spark, tmp_path, month_of):
    table = StoredTable(spark, str(tmp_path / "t"), ONE, month_of)
    table.publish(days(spark, ("2024-01-01", 1), (None, 2)))
    before = folders(table)
    assert table.append(days(spark, ("2024-01-05", 3), ("2024-03-05", 4))) == 2
    assert sorted(r["n"] for r in table.read().collect()) == [1, 2, 3, 4]
    new = ["v00000002/load_month=2024-01", "v00000002/load_month=2024-03"] if month_of else ["v00000002"]
    assert folders(table) == sorted(before + new)
    if month_of:
        assert sorted(r["n"] for r in table.read(["2024-01"]).collect()) == [1, 3]
        table.replace_months(days(spark, ("2024-01-02", 5)), days(spark, ("2024-01-03", 6), (None, 7)))
        assert sorted(r["n"] for r in table.read().collect()) == [2, 4, 5, 6, 7]
        assert [f for f in before if f.endswith(NO_MONTH)][0] in folders(table)
    else:
        table.publish(days(spark, ("2024-01-02", 5)))
        assert [r["n"] for r in table.read().collect()] == [5]


@pytest.mark.parametrize("month_of", [None, "day"])
def test_many_segments_become_one(spark, tmp_path, monkeypatch, month_of):
    monkeypatch.setattr(tables, "SEGMENTS", 2)
    table = StoredTable(spark, str(tmp_path / "t"), ONE, month_of)
    table.publish(days(spark, ("2024-01-01", 0), ("2024-02-01", -1)))
    held = []
    for n in range(1, 6):
        table.append(days(spark, ("2024-01-05", n)))
        assert sorted(r["n"] for r in table.read().collect()) == list(range(-1, n + 1))
        held.append(len(table.read(["2024-01"]).inputFiles() if month_of else table.folders()))
    assert held == [2, 1, 2, 1, 2]
    if month_of:
        assert "v00000001/load_month=2024-02" in folders(table)
    left = {p.parent.name + "/" + p.name if month_of else p.name for p in (tmp_path / "t").glob("v*/load_month=*" if month_of else "v*")}
    assert set(folders(table)) <= left and len(left) <= 5


def test_records_with_one_folder_a_month_are_read(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "t"), ONE, month_of="day")
    table.publish(days(spark, ("2024-01-01", 1)))
    record = tmp_path / "t/_records/00000001.json"
    record.write_text('{"folders": {"2024-01": "v00000001/load_month=2024-01"}, "mark": "2024-01-02"}')
    (tmp_path / "t/_records/.00000001.json.crc").unlink(missing_ok=True)
    table.append(days(spark, ("2024-01-02", 2)), mark=table.mark())
    assert sorted(r["n"] for r in table.read().collect()) == [1, 2] and table.mark() == "2024-01-02"


def test_a_merge_writes_months_with_a_match_and_what_is_new(spark, tmp_path, workspace):
    table = StoredTable(spark, str(tmp_path / "t"), WIDE, month_of="day")
    rows = [("2024-01-01", 1, "a"), ("2024-02-01", 2, "b"), ("2024-02-02", 3, "c"), (None, 4, "d")]
    table.publish(wide(spark, *rows))
    batch = [("2024-01-03", 9, "new"), ("2024-02-01", 2, "changed"), (None, 4, "again"), ("2024-05-01", 5, "e")]
    merge_stored(table, workspace.store(wide(spark, *batch), "batch"), ["day", "n"], workspace=workspace)
    kept = [("2024-01-01", 1, "a"), ("2024-02-02", 3, "c"), (None, 4, "d")]
    found = [(r["day"] and str(r["day"].date()), r["n"], r["v"]) for r in table.read().collect()]
    assert sorted(found, key=repr) == sorted(kept + batch, key=repr)
    assert folders(table) == [
        "v00000001/load_month=2024-01", f"v00000001/load_month={NO_MONTH}", "v00000002/load_month=2024-02",
        "v00000003/load_month=2024-01", "v00000003/load_month=2024-05", f"v00000003/load_month={NO_MONTH}",
    ]


@pytest.mark.parametrize("month_of", [None, "day"])
def test_a_merge_without_a_match_writes_its_own_rows(spark, tmp_path, workspace, month_of):
    table = StoredTable(spark, str(tmp_path / "t"), WIDE, month_of)
    table.publish(wide(spark, ("2024-01-01", 1, "a"), (None, 2, "b")))
    before = folders(table)
    batch = workspace.store(wide(spark, ("2024-01-01", 7, "c"), (None, 2, "d")), "batch")
    merge_stored(table, batch, ["day", "n"], workspace=workspace)
    assert sorted(r["v"] for r in table.read().collect()) == ["a", "b", "c", "d"]
    assert set(before) < set(folders(table))


def test_null_safe_keys_match_in_the_folder_without_a_month(spark, tmp_path, workspace):
    table = StoredTable(spark, str(tmp_path / "t"), WIDE, "day")
    table.publish(wide(spark, ("2024-01-01", 1, "a"), (None, 2, "b")))
    batch = workspace.store(wide(spark, (None, 2, "d")), "batch")
    merge_stored(table, batch, ["day", "n"], workspace=workspace, null_safe_keys=True)
    assert sorted(r["v"] for r in table.read().collect()) == ["a", "d"]


def test_hot_month_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 60_000, 1, 16).select(
        F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(if(id % 3 = 0, 0, id % 300))").alias(
            "day"
        ),
        F.col("id").alias("n"),
    )
    table = StoredTable(spark, str(tmp_path / "t"), ONE, month_of="day")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        table.publish(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {
        folder.name: len(list(folder.glob("*.parquet")))
        for folder in (tmp_path / "t" / "v00000001").glob("load_month=*")
    }
    assert len(files) == 10
    assert files["load_month=2024-01"] > 2
    assert table.read().count() == 60_000


def test_workspace_is_dropped_after_a_load(spark, site):
    before = storage.child_names(spark, shared_root(spark))
    site.serve([eviction("1")])
    site.loader.full_load("2022-04-05")
    site.serve([eviction("2", created="2022-04-05")], areas=None)
    site.loader.delta_load("2022-04-06")
    assert storage.child_names(spark, shared_root(spark)) == before
