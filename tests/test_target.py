"""Dated target: own cases around the horizon, the debut and odd rows (top league LEC)."""

import datetime as dt

import pytest

from scoutlens.operators import target

CASES = [
    # (rows of one player, date of the judged row, expected)
    ([("LFL", "2021-02-10"), ("LEC", "2021-08-20")], "2021-02-10", True),          # half a year later
    ([("LFL", "2021-02-10"), ("LEC", "2022-08-11")], "2021-02-10", False),         # a day past 18 months
    ([("LFL", "2021-02-10"), ("LEC", "2022-08-10")], "2021-02-10", True),          # the last day
    ([("LEC", "2020-01-20"), ("LFL", "2021-02-10")], "2021-02-10", False),         # came from the top
    ([("LEC", "2020-01-20"), ("LFL", "2021-02-10"), ("LEC", "2021-06-01")], "2021-02-10", False),
    ([("LFL", "2021-02-10"), ("PRM", "2021-06-01")], "2021-02-10", False),         # sideways
    ([("LFL", "2020-08-31 23:59:59"), ("LEC", "2022-02-28 23:59:59")], "2020-08-31 23:59:59", True),   # month end
    ([("LFL", "2021-05-05 09:00:00"), ("LEC", "2021-05-05 09:00:00")], "2021-05-05 09:00:00", False),  # same instant
    ([("LFL", "2021-05-05 09:00:00"), ("LEC", "2021-05-05 09:00:01")], "2021-05-05 09:00:00", True),
    ([("LFL", "no date"), ("LEC", "2021-06-01")], "no date", False),
    ([("LFL", None), ("LEC", "2021-06-01")], None, False),
    ([("LFL", "2021-02-10"), ("LEC", "not yet")], "2021-02-10", False),            # debut unknown
]


@pytest.fixture(scope="module")
def flags(spark):
    rows = [(f"p{i:02d}", league, date) for i, (rs, _, _) in enumerate(CASES) for league, date in rs]
    rows += [(None, "LFL", "2021-02-10"), (None, "LEC", "2021-06-01")]
    df = spark.createDataFrame(rows, "playername string, league string, date string")
    return target.dated_target(df).collect()


@pytest.mark.parametrize("i", range(len(CASES)))
def test_feeder_row(flags, i):
    _, date, expected = CASES[i]
    got = [r.promoted_to_lec for r in flags if r.playername == f"p{i:02d}" and r.league == "LFL" and r.date == date]
    assert got == [expected]


def test_top_rows_and_nameless_rows_are_never_positive(flags):
    assert not any(r.promoted_to_lec for r in flags if r.league == "LEC" or r.playername is None)
    assert all(r.promoted_to_lec is not None for r in flags)


def test_debut_is_the_first_parseable_top_date(spark):
    rows = [("z", "LEC", "2022-04-04"), ("z", "LEC", "2021-11-30 18:00:00"), ("z", "LEC", "??"), ("z", "LFL", "2019-01-01")]
    d = target.debut_dates(spark.createDataFrame(rows, "playername string, league string, date string")).collect()
    assert [r.debut for r in d] == [dt.datetime(2021, 11, 30, 18)]
