import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wardflow.operators import checks
from wardflow.operators.history import with_previous
from wardflow.operators.latest import latest_per_key

SCHEMA = "id string, who string, day date, left date"


def make_history(n, seed):
    """Ids in random order; one person has half of the rows, others are unknown."""
    pick = random.Random(seed)
    start = dt.date(2024, 1, 1)
    data = []
    for i in range(n):
        who = pick.choice(["busy", "busy", None, *[f"p{j}" for j in range(8)]])
        day = None if pick.random() < 0.1 else start + dt.timedelta(pick.randrange(20))
        left = None if pick.random() < 0.1 else start + dt.timedelta(pick.randrange(40))
        data.append((str(i), who, day, left))
    pick.shuffle(data)
    return data


def brute_force(data):
    """id -> (id, left) of the row before, in plain Python."""
    previous, groups = {}, {}
    for row in data:
        groups.setdefault(row[1], []).append(row)
    for members in groups.values():
        members.sort(key=lambda r: (r[2] is not None, r[2] or dt.date.min, len(r[0]), r[0]))
        for before, row in zip([None, *members], members):
            previous[row[0]] = before and (before[0], before[3])
    return previous


@pytest.mark.parametrize("rows_per_slice", [1_000_000, 400, 40, 3, 1])
def test_previous_equals_brute_force_however_cut(rows, rows_per_slice):
    data = make_history(1200, seed=rows_per_slice)
    result = with_previous(
        rows(data, SCHEMA),
        "who",
        ["day", F.length("id"), "id"],
        ["id", "left"],
        rows_per_slice=rows_per_slice,
    )
    got = {r["id"]: r["previous"] and tuple(r["previous"]) for r in result.collect()}
    assert got == brute_force(data)


def test_previous_keeps_rows_and_columns(rows):
    df = rows(make_history(300, 1), SCHEMA)
    result = with_previous(df, "who", ["day", "id"], ["id"], rows_per_slice=2)
    assert result.columns == [*df.columns, "previous"]
    assert sorted(map(str, result.drop("previous").collect())) == sorted(map(str, df.collect()))


def test_previous_row_with_unknown_values_is_not_a_first_row(rows):
    data = [("1", "a", dt.date(2024, 1, 1), None), ("2", "a", dt.date(2024, 1, 2), None)]
    for rows_per_slice in (1_000_000, 1):
        result = with_previous(
            rows(data, SCHEMA), "who", ["day", "id"], ["left"], rows_per_slice=rows_per_slice
        )
        got = {r["id"]: r["previous"] for r in result.collect()}
        assert got["1"] is None
        assert got["2"] is not None and got["2"]["left"] is None


def test_latest_per_key(rows):
    df = rows(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), (None, 1, "k"), (None, 2, "l")],
        "key string, year int, version string",
    )
    kept = latest_per_key(
        df, "key", [F.col("year").desc_nulls_last(), F.col("version").desc_nulls_last()]
    )
    assert sorted(map(str, [tuple(r) for r in kept.collect()])) == sorted(
        map(str, [("a", 2, "z"), ("b", None, "n"), (None, 2, "l")])
    )


def counts(df):
    return {r["check"]: r["violations"] for r in df.collect()}


def test_checks_find_defects(rows):
    df = rows(
        [(1, "a"), (1, "a"), (2, "b"), (2, "x"), (None, "x"), (None, "y"), (None, None)],
        "k int, v string",
    )
    assert counts(checks.not_null(df, "m", ["k", "v"])) == {"not_null_m_k": 3, "not_null_m_v": 1}
    assert counts(checks.unique(df, "m", "k")) == {"unique_m_k": 2}
    assert counts(checks.unique_combination(df, "m", ["k", "v"])) == {
        "unique_combination_m_k_v": 1
    }
    assert counts(checks.accepted_values(df, "m", "v", ["a", "b"])) == {"accepted_values_m_v": 2}
    parent = rows([(1,), (3,)], "id int")
    assert counts(checks.relationships(df, "m", "k", parent, "id")) == {"relationships_m_k": 2}


def test_checks_pass(rows):
    df = rows([(1, "a"), (2, "b")], "k int, v string")
    parent = rows([(1,), (2,)], "id int")
    result = checks.all_of(
        [
            checks.not_null(df, "m", ["k"]),
            checks.unique(df, "m", "k"),
            checks.unique_combination(df, "m", ["k", "v"]),
            checks.accepted_values(df, "m", "v", ["a", "b"]),
            checks.relationships(df, "m", "k", parent, "id"),
        ]
    )
    assert set(counts(result).values()) == {0}


def test_checks_on_empty_table(rows):
    df = rows([], "k int, v string")
    result = checks.all_of(
        [
            checks.not_null(df, "m", ["k"]),
            checks.unique(df, "m", "k"),
            checks.relationships(df, "m", "k", df, "k"),
        ]
    )
    assert set(counts(result).values()) == {0}
