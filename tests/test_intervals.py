"""Loaded keys as intervals: merging, gaps, rows in gaps, and increments that find late keys."""

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starmill.operators import intervals as iv
from starmill.plans.extract import Journal, extract_history, extract_increment
from starmill.sources.catalog import FrameSource


def keys_of(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "k long")


def runs_by_force(keys):
    out = []
    for k in sorted(set(keys)):
        if out and out[-1][1] == k - 1:
            out[-1] = (out[-1][0], k)
        else:
            out.append((k, k))
    return out


BOUND = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@BOUND
@given(st.lists(st.integers(-40, 60), max_size=60), st.integers(1, 4))
def test_islands_and_gaps(spark, keys, bits):
    before, iv.BUCKET_BITS = iv.BUCKET_BITS, bits
    try:
        held = iv.islands(keys_of(spark, [*keys, *keys[:3], None]).repartition(3), "k")
        assert sorted(map(tuple, held.collect())) == runs_by_force(keys)
        missing = runs_by_force(set(range(-20, 41)) - set(keys))
        assert sorted(map(tuple, iv.gaps(held, -20, 40).collect())) == missing
        found = iv.in_gaps(keys_of(spark, range(-50, 70)), "k", iv.gaps(held, -20, 40), most=2)
        assert sorted(r.k for r in found.collect()) == sorted(set(range(-20, 41)) - set(keys))
    finally:
        iv.BUCKET_BITS = before


def test_overlapping_intervals_merge(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 3), ("a", 6, 6), ("a", 8, 9), ("b", 1, 1), ("a", 100, 2 ** 40), ("a", 2 ** 39, 2 ** 41)],
                               "t string, low long, high long")
    assert rows(iv.merged(df, ["t"])) == sorted([("a", 1, 6), ("a", 100, 2 ** 41), ("a", 8, 9), ("b", 1, 1)], key=lambda r: [str(x) for x in r])


def test_few_gaps_reach_the_scan(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    held = spark.createDataFrame([(0, 99), (110, 500)], "low long, high long")
    df = iv.in_gaps(spark.read.parquet(str(tmp_path / "t")), "id", iv.gaps(held, 0, 999))
    assert sorted(r.id for r in df.collect()) == [*range(100, 110), *range(501, 1000)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan and "Join" not in plan


def test_many_gaps_far_apart(spark):
    held = spark.range(0, 10_000_000, 100_000).select(F.col("id").alias("low"), (F.col("id") + 99_990).alias("high"))
    source = spark.range(0, 10_000_000, 3)
    found = iv.in_gaps(source, "id", iv.gaps(held, 0, 9_999_999), most=3)
    want = [k for k in range(0, 10_000_000, 3) if k % 100_000 > 99_990]
    assert sorted(r.id for r in found.collect()) == want


def run(spark, journal, path, there, n, **options):
    source = FrameSource(spark, {"t": spark.createDataFrame([(k, f"v{k}") for k in there], "id long, v string")}, {"t": ("id",)})
    if n == 1:
        return extract_history(source, path, journal, **options)
    return extract_increment(source, path, journal, f"2024-01-0{n}", run_id=str(n), **options)


def loaded(spark, path, fmt="parquet"):
    reader = spark.read.option("recursiveFileLookup", "true")
    df = reader.parquet(f"{path}/t") if fmt == "parquet" else reader.csv(f"{path}/t", header=True, quote='"', escape='"')
    return sorted(int(r.id) for r in df.collect())


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_late_keys_come_once(spark, tmp_path, fmt):
    path, journal = str(tmp_path / "raw"), Journal(spark, str(tmp_path / "journal"))
    steps = [{1, 2, 3, 5, 9}, {1, 2, 3, 5, 9, 4, 12}, {1, 2, 3, 4, 5, 9, 12}, {*range(-2, 14)}]
    seen = []
    for n, there in enumerate(steps, 1):
        out = run(spark, journal, path, there, n, fmt=fmt, late_keys=True)
        seen.append(out[0].rows)
    assert seen == [5, 2, 0, 9] and loaded(spark, path, fmt) == sorted(steps[-1])


def test_settled_gaps_are_not_read_again(spark, tmp_path):
    path, journal = str(tmp_path / "raw"), Journal(spark, str(tmp_path / "journal"))
    steps = [{1, 5}, {1, 5, 8}, {1, 5, 8, 3, 6, 11}]
    for n, there in enumerate(steps, 1):
        run(spark, journal, path, there, n, fmt="parquet", late_keys=True, **({} if n == 1 else {"settle_runs": 2}))
    assert loaded(spark, path) == [1, 5, 6, 8, 11]  # 3 came two runs after 5


def test_seeded_keys_are_not_loaded(spark, tmp_path):
    path, journal = str(tmp_path / "raw"), Journal(spark, str(tmp_path / "journal"))
    for n, there in ((2, {1, 5}), (3, {1, 5, 4, 7})):
        run(spark, journal, path, there, n, fmt="parquet", late_keys=True)
    assert loaded(spark, path) == [4, 7]
    assert run(spark, journal, path, set(), 4, fmt="parquet", late_keys=True)[0].rows == 0
