import datetime as dt

import pytest

from tidewire.plans import schedule as S


def at(minute, hour=3):
    return dt.datetime(2024, 1, 2, hour, minute, tzinfo=dt.UTC)


def test_runs_are_hourly_and_between():
    assert S.due(at(5)).mode == "recluster" and {S.due(at(m)).mode for m in (20, 35, 50)} == {"assign"} and S.due(at(6)) is None
    assert S.next_run(at(5)) == (at(20), S.SCHEDULES[1]) and S.next_run(at(50))[0] == at(5, 4)
    assert S.window_of(at(0)) == ("2024-01-01", "2024-01-02")
    assert S.window_of(dt.datetime(2024, 1, 2, 3, tzinfo=dt.timezone(dt.timedelta(hours=9)))) == ("2023-12-31", "2024-01-01")


def test_one_run_at_a_time(spark, tmp_path):
    lock = lambda **k: S.RunLock(spark, str(tmp_path), k.pop("limit", dt.timedelta(minutes=1)), dt.timedelta(0), **k)
    with lock():
        with pytest.raises(S.Busy):
            lock().__enter__()
        # a lock that is older than a run may last is taken over
        with lock(limit=dt.timedelta(seconds=-1)):
            pass
    called = []
    run = lambda *a: called.append(a[1:]) or {"status": "done"}
    assert S.run_due(spark, str(tmp_path), ["p"], at(6), run=run) is None
    assert S.run_due(spark, str(tmp_path), ["p"], at(20), run=run) == {"status": "done"}
    assert called == [(str(tmp_path), "2024-01-01", "2024-01-02", ["p"], "assign", None)]
    with lock():
        pass
