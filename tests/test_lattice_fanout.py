import itertools
import random

import pytest
from pyspark.sql import functions as F

from weekmart.operators import quality as q
from weekmart.operators.calendar import WEEK
from weekmart.operators.mapping import map_left
from weekmart.plans import analysis as a

GRAINS = {"all": ["x"], "wide": ["x", "y", "z"], "pair": ["x", "y"], "other": ["z"], "same": ["y", "x"]}


def folders(df):
    return {f.rsplit("/", 2)[1] for f in df.inputFiles()}


@pytest.fixture(scope="module")
def fact(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.choice(["c", "d", None]), rng.choice("efgh"), rng.choice("mnop"), 202000 + rng.randint(1, 30), float(rng.randint(0, 9)))
            for _ in range(3000)]
    return spark.createDataFrame(rows, f"x string, y string, z string, unused string, {WEEK} int, lbs double")


def test_coarse_grains_start_from_their_smallest_parent(fact):
    sums = a.grain_lattice(fact, GRAINS)
    assert list(sums) == list(GRAINS)
    read = {name: folders(df) for name, df in sums.items()}
    assert all(len(f) == 1 for f in read.values())
    start = {name: next(iter(f)).rsplit("-", 1)[0] for name, f in read.items()}
    assert start == {"wide": "series", "pair": "grain-pair", "same": "grain-pair", "all": "grain-pair", "other": "series"}


def test_the_lattice_changes_no_sum(fact, rows):
    for name, df in a.grain_lattice(fact, GRAINS).items():
        plain = fact.groupBy(*GRAINS[name], WEEK).agg(F.sum("lbs").alias("lbs"))
        assert rows(df.select(*GRAINS[name], WEEK, "lbs")) == rows(plain)


def test_reports_of_several_grains_equal_single_ones(fact, calendar, rows):
    spec = a.ReportSpec(202001, 202010, label="N", segment_column=None)
    grains = {"wide": ["x", "z"], "all": ["x"]}
    reports = a.several_grains(fact, grains, calendar, spec)
    for name, dims in grains.items():
        assert rows(reports[name]) == rows(a.segment_report(fact, dims, calendar, spec))


def test_added_rows_and_volume_sum_to_the_gap(spark, rows):
    rng = random.Random(6)
    fact = spark.createDataFrame([(rng.choice(["a", "b", "c", None]), rng.randint(1, 4), float(rng.randint(1, 9))) for _ in range(500)], "k string, n int, lbs double")
    labels = spark.createDataFrame([("A", "1"), ("a", "2"), ("a", "2"), (None, "3"), (None, "4"), ("b", "5"), ("z", "6"), ("z", "7")], "k string, label string")
    sizes = spark.createDataFrame([(1, "s"), (2, "t"), (2, "u"), (2, "v")], "n int, size string")
    joined = map_left(fact, labels, {"k": "k"}, ["label"], normalize={"k": F.lower}, copy="c1")
    joined = map_left(joined, sizes, {"n": "n"}, ["size"], copy="c2")
    found = q.fan_out(joined, {"labels": ("c1", ["k"]), "sizes": ("c2", ["n"])})
    plain = fact.collect()
    copies = {"a": 2, None: 2}
    expected = []
    for k in ("a", None):
        mine = [r for r in plain if r.k == k]
        expected.append(("labels", f"k={k or '?'}", len(mine), sum(r.lbs for r in mine)))
    sized = list(itertools.chain.from_iterable([r] * copies.get(r.k, 1) for r in plain if r.n == 2))
    expected.append(("sizes", "n=2", 2 * len(sized), 2 * sum(r.lbs for r in sized)))
    assert rows(found) == sorted(expected, key=lambda r: tuple((False, str(v)) for v in r))
    gap = found.agg(F.sum("rows"), F.sum("lbs")).first()
    assert tuple(gap) == (joined.count() - len(plain), joined.agg(F.sum("lbs")).first()[0] - sum(r.lbs for r in plain))


def test_keys_without_copies_are_not_listed(spark):
    fact = spark.createDataFrame([("a", 1.0), ("q", 2.0)], "k string, lbs double")
    joined = map_left(fact, spark.createDataFrame([("a", "1")], "k string, label string"), {"k": "k"}, ["label"], copy="c")
    assert q.fan_out(joined, {"labels": ("c", ["k"])}).count() == 0 and joined.count() == 2
