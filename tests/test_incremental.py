import random

import pytest
from pyspark.sql import functions as F

from weekmart.operators.calendar import WEEK
from weekmart.plans import incremental as inc
from weekmart.plans.analysis import analyze

DIMS = ["city", "seg"]
SCHEMA = f"city string, seg string, {WEEK} int, lbs double"
BEGIN, END = 201901, 201910


def plain_dependents(weeks, changed, sources, begin, end):
    """Cells by definition: which weeks see a changed week through a window, a carried value, or the pre-period."""
    out = set()
    for k, w in enumerate(weeks):
        seen = set(weeks[max(0, k - 11): k + 1])
        seen |= {x for v in seen for x in sources.get(v, ())}
        if seen & changed or any(begin <= c <= end for c in changed):
            out.add(w)
    return out


def test_dependents_equal_the_definition():
    rng = random.Random(1)
    for _ in range(300):
        weeks = sorted(rng.sample(range(1, 120), rng.randint(1, 80)))
        sources = {w: (w - 52, rng.choice([None, rng.randint(1, 30)])) for w in weeks}
        changed = set(rng.sample(weeks, min(len(weeks), rng.randint(0, 3))))
        assert inc.dependents(weeks, changed, sources, 115, 119) == plain_dependents(weeks, changed, sources, 115, 119)
    assert inc.windows_of([1, 2, 3, 5, 8], [5], 3) == [2, 3, 5]
    assert inc.dependents([1, 2, 5, 8], [3], {}, 100, 100, 2) == {5, 8}  # a vanished week moves those after it


def some_rows(rng, weeks, segments):
    return [(rng.choice(["X", "Y", None]), rng.choice(segments), w, float(rng.randint(0, 50))) for w in weeks for _ in range(rng.randint(1, 6))]


def same_as_full(spark, path, rows, calendar):
    full = analyze(spark.createDataFrame(rows, SCHEMA), DIMS, calendar, BEGIN, END)
    kept = inc.read_report(spark, path).select(*full.columns)
    return sorted(map(str, full.collect())) == sorted(map(str, kept.collect()))


def test_any_redelivery_equals_a_full_run(spark, calendar, tmp_path):
    rng = random.Random(12)
    path = f"{tmp_path}/state"
    every = [201900 + k for k in range(1, 53)] + [202000 + k for k in range(1, 54)] + [0, 202099]
    start = sorted(rng.sample(every, 60))
    rows = some_rows(rng, start, ["a", "b", "c"]) + [("X", None, start[0], 5.0), ("X", "a", None, 7.0)]
    first = inc.refresh(spark.createDataFrame(rows, SCHEMA), path, DIMS, calendar, begin=BEGIN, end=END)
    assert first.version == 1 and same_as_full(spark, path, rows, calendar)
    rows = [r for r in rows if r[2] is not None and r[1] is not None]
    late = [w for w in every if w > END]
    steps = [
        ([rng.choice([w for w in start if w > 202020])], ["a", "b", "c"], []),  # one week, the same segments
        ([w for w in late if w not in start][:1], ["a", "b"], []),  # a new week between others
        ([rng.choice([w for w in start if w > 202000])], ["d"], []),  # only a new segment
        ([], [], [max(w for w in start if w < 202099)]),  # a week vanishes
        ([rng.choice([w for w in start if BEGIN <= w <= END])], ["a", "e"], []),  # inside the pre-period
        ([0], ["a", "f"], [rng.choice([w for w in start if w > 201930])]),
    ]
    for weeks, segments, gone in steps:
        more = some_rows(rng, weeks, segments) if weeks else []
        rows = [r for r in rows if r[2] not in weeks and r[2] not in gone] + more
        inc.refresh(spark.createDataFrame(more, SCHEMA), path, DIMS, calendar, [*weeks, *gone], begin=BEGIN, end=END)
        assert same_as_full(spark, path, rows, calendar), (weeks, segments, gone)


def test_only_dependent_weeks_are_read_and_computed(spark, calendar, tmp_path):
    path = f"{tmp_path}/state"
    weeks = [202000 + k for k in range(1, 54)] + [202100 + k for k in range(1, 53)]
    rows = [("X", seg, w, float(w % 7)) for w in weeks for seg in "ab"]
    inc.refresh(spark.createDataFrame(rows, SCHEMA), path, DIMS, calendar, begin=BEGIN, end=END)
    done = inc.refresh(spark.createDataFrame([("X", "a", 202150, 9.0), ("X", "b", 202150, 8.0)], SCHEMA), path, DIMS, calendar, begin=BEGIN, end=END)
    assert done.renewed == [202150, 202151, 202152]
    assert set(done.read) <= {w for w in weeks if 202135 <= w} | {w for w in weeks if 202030 <= w <= 202053} and len(done.read) < 35
    files = {f.split("calendar_week_year=")[1][:6] for f in inc.read_report(spark, path).filter(F.col(WEEK) == 202110).inputFiles()}
    assert "202110" in files
    old = {f for f in inc.read_report(spark, path, 1).inputFiles() if not any(str(w) in f for w in done.renewed)}
    assert old <= set(inc.read_report(spark, path).inputFiles())  # the other weeks' folders are the same as before


def test_a_run_that_died_between_the_tables_is_made_good(spark, calendar, tmp_path, monkeypatch):
    path = f"{tmp_path}/state"
    rows = [("X", seg, 202000 + k, float(k)) for k in range(1, 40) for seg in "ab"]
    inc.refresh(spark.createDataFrame(rows, SCHEMA), path, DIMS, calendar, begin=BEGIN, end=END)
    more = [("X", "a", 202040, 3.0), ("X", "new", 202030, 4.0)]
    replace = inc.snapshots.replace_partitions

    def dies(df, target, *args, **kw):
        if target.endswith("report"):
            raise RuntimeError("lost")
        return replace(df, target, *args, **kw)

    monkeypatch.setattr(inc.snapshots, "replace_partitions", dies)
    with pytest.raises(RuntimeError):
        inc.refresh(spark.createDataFrame(more, SCHEMA), path, DIMS, calendar, begin=BEGIN, end=END)
    monkeypatch.undo()
    inc.refresh(spark.createDataFrame(more, SCHEMA), path, DIMS, calendar, begin=BEGIN, end=END)
    left = [r for r in rows if r[2] != 202030] + more
    assert same_as_full(spark, path, left, calendar)
