"""Ratings through the CSV reader: equal to the plain split on plain rows, and quoted fields besides."""

import tempfile

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from rateflow.schemas import RATING
from rateflow.sources import text


def _file(lines):
    path = tempfile.mkdtemp(prefix="rf-csv-") + "/r.txt"
    with open(path, "w", newline="") as f:
        f.write("".join(x + "\n" for x in lines))
    return path


def _both(frames):
    good, bad = frames
    return sorted(map(tuple, good.collect()), key=repr), sorted(map(tuple, bad.collect()), key=repr)


PLAIN = ["1,2,3.5,100", "1,2,3.5,100,extra", "1,2,3.5,100,extra,more,", "1,2", "1,2,3.0,", "x,2,3.0,4", "1,,3.0,4", "1,2,y,4", " 1,2 , 3,4",
         "1,2,3.0,4.5", "99999999999,1,1.0,1", "1,2,3.0,", ",,,", "a", "1,2,x,4,5", "1,2,x,4,5,6"]


def test_plain_rows_as_by_splitting(spark):
    path = _file(PLAIN)
    plain, quoted = _both(text.read_ratings_text(spark, path)), _both(text.read_ratings_text(spark, path, quoted=True))
    assert plain[0] == quoted[0] and plain[1] == quoted[1] and len(plain[0]) == 4


def test_a_field_far_behind_empty_ones(spark):
    path = _file(["1,1,1,,,1", "1,2,,,,", '"a,,,b",2', "1,2,3.0,,,,x"])
    reasons = {v: r for v, r in _both(text.read_ratings_text(spark, path, quoted=True))[1]}
    assert reasons == {"1,1,1,,,1": "bad_value", "1,2,,,,": "short_row", '"a,,,b",2': "short_row", "1,2,3.0,,,,x": "bad_value"}


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["1", "22", "3.5", "x", "-4", ""]), min_size=1, max_size=6).map(",".join).filter(bool), min_size=1, max_size=20))
def test_any_plain_rows_as_by_splitting(spark, lines):
    path = _file(lines)
    plain, quoted = _both(text.read_ratings_text(spark, path)), _both(text.read_ratings_text(spark, path, quoted=True))
    assert plain[0] == quoted[0]
    # Empty fields at a row's end may be reported with or without their commas.
    strip = lambda rows: sorted((v.rstrip(","), r) for v, r in rows)
    assert strip(plain[1]) == strip(quoted[1])


@pytest.mark.parametrize("lines,want", [
    (['"1","2","3.5","100"', '1,"2",3.0,"7"', '3,"4",1.0,2,"x, ""y"""'], [(1, 2, 3.0, 7), (1, 2, 3.5, 100), (3, 4, 1.0, 2)]),
    (['"1","2","3.5","100"', '1,"2",3.0,"7"'], [(1, 2, 3.0, 7), (1, 2, 3.5, 100)]),
    (['1,2,4.0,"9","a, b ""c"""', '2,2,4.0,9,"two', 'lines"'], [(1, 2, 4.0, 9), (2, 2, 4.0, 9)]),
])
def test_quoted_fields(spark, lines, want):
    good, bad = _both(text.read_ratings_text(spark, _file(lines), quoted=True, multi_line="lines\"" in lines[-1]))
    assert good == want and bad == []


def test_bad_quoted_rows_are_quarantined_as_written(spark):
    good, bad = _both(text.read_ratings_text(spark, _file(['1,2', '"x",2,3.0,4', '1,2,3.0,4', '5,"6', '7",1.0,2']), quoted=True, multi_line=True))
    assert good == [(1, 2, 3.0, 4)]
    assert sorted((r, v.count('"')) for v, r in bad) == [("bad_value", 2), ("bad_value", 2), ("short_row", 0)]


def test_an_empty_file(spark):
    good, bad = text.read_ratings_text(spark, _file([]), quoted=True)
    assert good.schema.fieldNames() == RATING.fieldNames() and good.collect() == bad.collect() == []
