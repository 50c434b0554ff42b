"""The ledger of loaded windows against a plain walk over minutes."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quakeloom.sources import windows

DAY = datetime(2024, 1, 1)


def at(n):
    return DAY + timedelta(hours=n)


def frame(spark, rows):
    return spark.createDataFrame([(f, None if a is None else at(a), None if b is None else at(b)) for f, a, b in rows], windows.SCHEMA)


def wanted(spark, *rows):
    return spark.createDataFrame([(f, at(a), at(b)) for f, a, b in rows], "feed STRING, since TIMESTAMP, until TIMESTAMP")


def hours(df):
    return sorted((r.feed, (r.start - DAY) // timedelta(hours=1), (r.end - DAY) // timedelta(hours=1)) for r in df.collect())


def stretches(held):
    found = []
    for h in sorted(held):
        if found and found[-1][1] == h:
            found[-1][1] = h + 1
        else:
            found.append([h, h + 1])
    return [tuple(x) for x in found]


def test_union_gaps_and_overlaps(spark):
    loaded = frame(spark, [("a", 6, 9), ("a", 0, 3), ("a", 2, 4), ("a", 2, 4), ("a", 9, 10), ("b", 1, 2), ("a", 5, 5), ("a", 8, 7), ("a", None, 3), (None, None, None)])
    assert hours(windows.covered(loaded)) == [("a", 0, 4), ("a", 6, 10), ("b", 1, 2)]
    asked = wanted(spark, ("a", -2, 12), ("b", 1, 2), ("c", 0, 5), ("c", 3, 3))
    assert hours(windows.missing(loaded, asked)) == [("a", -2, 0), ("a", 4, 6), ("a", 10, 12), ("c", 0, 5)]
    assert [(*h, r.most) for h, r in zip(hours(windows.overlaps(loaded)), windows.overlaps(loaded).collect())] == [("a", 2, 4, 3)]
    assert hours(windows.missing(frame(spark, []), asked)) == [("a", -2, 12), ("b", 1, 2), ("c", 0, 5)]
    assert hours(windows.in_steps(windows.missing(loaded, wanted(spark, ("c", 0, 5))), "2 hours")) == [("c", 0, 2), ("c", 2, 4), ("c", 4, 5)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 20), st.integers(0, 20)), max_size=8), st.integers(0, 10), st.integers(0, 20))
def test_missing_equals_a_walk(spark, rows, since, until):
    held = {f: {h for g, a, b in rows if g == f for h in range(a, b)} for f in "ab"}
    found = hours(windows.missing(frame(spark, rows), wanted(spark, ("a", since, until), ("b", since, until))))
    assert found == sorted((f, *s) for f in "ab" for s in stretches(set(range(since, until)) - held[f]))


def test_a_load_cut_off_is_done_again(spark, folder):
    ledger, seen = windows.WindowLedger(spark, f"{folder}/ledger"), []

    def load(start, end):
        if len(seen) == 1 and start not in [s for s, _ in seen]:
            seen.append((start, None))
            raise OSError("no answer")
        seen.append((start, end))

    with pytest.raises(OSError):
        ledger.load("a", at(0), at(6), load, "3 hours")
    assert ledger.load("a", at(0), at(6), load, "3 hours") == 1
    assert ledger.load("a", at(0), at(6), load, "3 hours") == 0
    assert ledger.load("a", at(0), at(8), load, "3 hours") == 1
    assert seen == [(at(0), at(3)), (at(3), None), (at(3), at(6)), (at(6), at(8))]
    assert hours(ledger.compacted(f"{folder}/compact").loaded()) == [("a", 0, 8)]
