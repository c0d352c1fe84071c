"""Merge semantics: hand-made cases, a row-by-row model, and DuckDB's own MERGE."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import sizes
from tidemark.operators.merge import MultipleMatchError, merge, multi_match_keys
from tidemark.workspace import Workspace

SCHEMA = "day string, num long, code string, kept string, val long, box struct<a: string, b: long>"
KEYS = ["day", "num", "code"]


def row(day="d1", num=1, code="c1", kept="k", val=10, box=("a", 1)):
    return (day, num, code, kept, val, box)


def stored(spark, workspace, rows, name="t"):
    return workspace.store(spark.createDataFrame(rows, SCHEMA), name)


def rows_of(df):
    return Counter((*r[:-1], None if r[-1] is None else tuple(r[-1])) for r in df.collect())


def run(spark, workspace, target, source, **options):
    merged = merge(
        stored(spark, workspace, target),
        spark.createDataFrame(source, SCHEMA),
        KEYS,
        workspace=workspace,
        **options,
    )
    return rows_of(merged)


# Both physical forms: a batch that fits a broadcast, and one that does not.
@pytest.fixture(params=[64 * 1024 * 1024, 0], ids=["broadcast", "shuffle"])
def limit(request, spark, monkeypatch):
    monkeypatch.setattr(sizes, "WORTH_SPARING", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_update_insert_and_stay(spark, workspace, limit):
    target = [row(num=1), row(num=2)]
    source = [row(num=2, val=99, box=("z", None)), row(num=3, val=7)]
    got = run(spark, workspace, target, source, broadcast_limit=limit)
    assert got == Counter([row(num=1), row(num=2, val=99, box=("z", None)), row(num=3, val=7)])


def test_source_null_overwrites(spark, workspace, limit):
    got = run(spark, workspace, [row(val=5)], [row(val=None, box=None)], broadcast_limit=limit)
    assert got == Counter([row(val=None, box=None)])


def test_kept_column(spark, workspace, limit):
    source = [row(num=1, kept="new", val=11), row(num=2, kept="new")]
    got = run(
        spark, workspace, [row(kept="old")], source, keep_target=("kept",), broadcast_limit=limit
    )
    assert got == Counter([row(kept="old", val=11), row(num=2, kept="new")])


def test_null_key_is_inserted_every_time(spark, workspace, limit):
    null_key = row(num=None)
    target = [null_key, row(num=1)]
    once = run(spark, workspace, target, [null_key], broadcast_limit=limit)
    assert once == Counter({null_key: 2, row(num=1): 1})


def test_null_safe_keys_match(spark, workspace, limit):
    got = run(
        spark,
        workspace,
        [row(num=None), row(day=None, code=None)],
        [row(num=None, val=77)],
        null_safe_keys=True,
        broadcast_limit=limit,
    )
    assert got == Counter([row(num=None, val=77), row(day=None, code=None)])


def test_target_duplicates_are_both_updated(spark, workspace, limit):
    got = run(
        spark, workspace, [row(val=1), row(val=2)], [row(val=3)], broadcast_limit=limit
    )
    assert got == Counter({row(val=3): 2})


def test_multiple_match_raises_and_names_the_key(spark, workspace, limit):
    with pytest.raises(MultipleMatchError, match="'num': 4"):
        run(
            spark,
            workspace,
            [row(num=4)],
            [row(num=4, val=1), row(num=4, val=2)],
            broadcast_limit=limit,
        )


def test_multiple_rows_of_a_new_key_are_all_inserted(spark, workspace, limit):
    source = [row(num=4, val=1), row(num=4, val=2)]
    got = run(spark, workspace, [row(num=1)], source, broadcast_limit=limit)
    assert got == Counter([row(num=1), *source])


def test_empty_source_and_empty_target(spark, workspace, limit):
    assert run(spark, workspace, [row()], [], broadcast_limit=limit) == Counter([row()])
    assert run(spark, workspace, [], [row()], broadcast_limit=limit) == Counter([row()])


def test_columns_are_bound_by_name(spark, workspace):
    target = stored(spark, workspace, [row(val=1)])
    source = spark.createDataFrame([row(val=2)], SCHEMA).select(*reversed(target.columns))
    merged = merge(target, source, KEYS, workspace=workspace)
    assert merged.columns == target.columns
    assert rows_of(merged) == Counter([row(val=2)])


def test_repeat_changes_nothing(spark, workspace, limit):
    target = [row(num=1), row(num=2)]
    source = [row(num=2, val=5), row(num=3)]
    once = run(spark, workspace, target, source, broadcast_limit=limit)
    twice = run(spark, workspace, list(once.elements()), source, broadcast_limit=limit)
    assert once == twice


def test_multi_match_keys(spark, workspace):
    target = stored(spark, workspace, [row(num=1), row(num=1), row(num=2)])
    source = stored(spark, workspace, [row(num=1), row(num=2), row(num=2), row(num=3), row(num=3)])
    got = multi_match_keys(target, source, KEYS).collect()
    assert [(r["num"], r["source_rows"]) for r in got] == [(2, 2)]


def model(target, source, keep=("kept",)):
    """MERGE read literally, one row at a time."""
    key = lambda r: None if None in r[:3] else r[:3]
    by_key = {}
    for r in source:
        by_key.setdefault(key(r), []).append(r)
    out, hit = [], set()
    for t in target:
        found = by_key.get(key(t), []) if key(t) else []
        if len(found) > 1:
            return None
        if found:
            hit.add(key(t))
            out.append((*t[:3], t[3] if "kept" in keep else found[0][3], *found[0][4:]))
        else:
            out.append(t)
    return Counter(out + [s for s in source if key(s) is None or key(s) not in hit])


ROWS = st.tuples(
    st.sampled_from(["d1", "d2", None]),
    st.sampled_from([1, 2, 3, None]),
    st.sampled_from(["c1", "c2"]),
    st.sampled_from(["x", "y", None]),
    st.one_of(st.none(), st.integers(0, 3)),
    st.sampled_from([("a", 1), ("a", None), (None, None)]),
)


@settings(
    max_examples=15,
    deadline=None,
    derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(target=st.lists(ROWS, max_size=8), source=st.lists(ROWS, max_size=8))
def test_against_model(spark, tmp_path, monkeypatch, target, source):
    monkeypatch.setattr(sizes, "WORTH_SPARING", 0)
    expected = model(target, source)
    workspace = Workspace(spark, str(tmp_path))
    for limit in (64 * 1024 * 1024, 0):
        options = {"keep_target": ("kept",), "broadcast_limit": limit}
        if expected is None:
            with pytest.raises(MultipleMatchError):
                run(spark, workspace, target, source, **options)
        else:
            assert run(spark, workspace, target, source, **options) == expected


def test_against_native_merge(spark, workspace):
    import random

    random.seed(7)
    days = ["d1", "d2", None]

    def some(n, mark):
        return [
            (random.choice(days), random.randint(0, 400), f"c{random.randint(0, 1)}", mark, i)
            for i in range(n)
        ]

    schema = "day string, num long, code string, kept string, val long"
    target, source = some(500, "t"), some(300, "s")
    unique = {}
    for s in source:
        unique[s[:3] if None not in s[:3] else s] = s
    source = list(unique.values())
    con = duckdb.connect()
    ddl = "(day varchar, num bigint, code varchar, kept varchar, val bigint)"
    for name, data in (("t", target), ("s", source)):
        con.execute(f"create table {name} {ddl}")
        con.executemany(f"insert into {name} values (?, ?, ?, ?, ?)", data)
    con.execute(
        """
        merge into t using s on t.day = s.day and t.num = s.num and t.code = s.code
        when matched then update set kept = t.kept, val = s.val
        when not matched then insert values (s.day, s.num, s.code, s.kept, s.val)
        """
    )
    merged = merge(
        workspace.store(spark.createDataFrame(target, schema), "t"),
        spark.createDataFrame(source, schema),
        KEYS,
        workspace=workspace,
        keep_target=("kept",),
    )
    assert Counter(map(tuple, merged.collect())) == Counter(con.execute("from t").fetchall())
