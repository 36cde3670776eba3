"""The stream forms, with late and far repeats."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wagelens.streaming import demand, feeds

DAY = datetime(2024, 1, 1)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Every partition of a state costs files and a Python worker in each batch."""
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


SCHEMA = "id int, ts timestamp, seq int, note string"


def run(spark, tmp_path, batches, delay, **options):
    """Rows (id, day, seq) out after each batch; every start goes on where the last one ended."""
    source, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    steps = []
    for batch in batches:
        rows = [(k, None if d is None else DAY + timedelta(days=d), s, None) for k, d, s in batch]
        df = spark.createDataFrame(rows, SCHEMA)
        df.coalesce(1).write.mode("append").parquet(source)
        feed = feeds.read_feed(spark, source, df.schema)
        kept = feeds.first_seen_feed(feed, "id", F.col("ts"), delay, ("seq",), **options)
        feeds.append_feed(kept, out, state).awaitTermination()
        steps.append(sorted((r["id"] is None, r["id"], (r["ts"] - DAY).days, r["seq"]) for r in spark.read.schema(SCHEMA).parquet(out).collect()))
    return [[r[1:] for r in step] for step in steps]


def test_the_earliest_row_wins_whatever_the_order_of_arrival(spark, tmp_path):
    batches = [[(1, 5, 0), (2, 3, 0)], [(1, 0, 9), (1, 0, 4), (2, 1, 0), (3, 6, 0)], [(None, 7, 0), (None, 2, 1), (3, 6, -1), (4, None, 0)], [(99, 200, 0)]]
    steps = run(spark, tmp_path, batches, "100 days")
    assert steps[-2] == []  # nothing is certain until the watermark is there
    assert steps[-1] == [(1, 0, 4), (2, 1, 0), (3, 6, -1), (None, 2, 1)]


def test_late_rows_do_not_count(spark, tmp_path):
    steps = run(spark, tmp_path, [[(1, 10, 0)], [(1, 9, 0), (2, 20, 0)], [(1, 8, 0), (2, 3, 0), (2, 19, 0)], [(99, 60, 0)]], "2 days")
    assert steps[-1] == [(1, 9, 0), (2, 19, 0)]


def test_a_key_is_forgotten_after_the_horizon(spark, tmp_path):
    batches = [[(1, 0, 0)], [(1, 4, 0), (2, 10, 0)], [(1, 12, 0), (3, 40, 0)], [(1, 41, 0)], [(4, 80, 0)]]
    steps = run(spark, tmp_path, batches, "1 days", horizon=timedelta(days=20))
    assert [r for r in steps[-1] if r[0] == 1] == [(1, 0, 0), (1, 41, 0)]
    assert [r for r in steps[-1] if r[0] == 2] == [(2, 10, 0)]


def test_without_a_horizon_a_key_is_held(spark, tmp_path):
    steps = run(spark, tmp_path, [[(1, 0, 0)], [(2, 10, 0)], [(1, 500, 0)], [(1, 1000, 0), (3, 1001, 0)], [(4, 2000, 0)]], "1 days")
    assert [r for r in steps[-1] if r[0] == 1] == [(1, 0, 0)]


def test_append_reads_each_file_once(spark, tmp_path):
    source, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    spark.range(5).write.parquet(source)
    for _ in range(2):
        feeds.append_feed(feeds.read_feed(spark, source, spark.range(1).schema), out, state).awaitTermination()
    assert spark.read.parquet(out).count() == 5


def test_a_hot_key_is_thinned_before_the_shuffle(spark):
    rows = [("hot", DAY + timedelta(seconds=i), 500 - i) for i in range(500)] + [(f"k{i}", DAY, i) for i in range(20)]
    rows += [(None, DAY, 1), (None, DAY, None), ("hot", DAY, 7)]
    df = spark.createDataFrame(rows, "id string, t timestamp, seq int").withColumn("g", F.date_trunc("minute", "t")).coalesce(1)
    got = [(r["id"], r["t"], r["seq"]) for r in feeds.thin_repeats(df, "id", "t", ["seq"], "g").collect()]
    hot = sorted((t, s) for k, t, s in got if k == "hot")
    assert hot[0] == (DAY, 7) and hot[1:] == [(DAY + timedelta(minutes=i), 500 - 60 * i) for i in range(1, 9)]
    assert [s for k, _, s in got if k is None] == [None] and len(got) == 30
    assert feeds.thin_repeats(df.limit(0), "id", "t", ["seq"], "g").count() == 0


def demanded(spark, tmp_path, batches, width="10 days", delay="5 days", slide=None):
    """Rows (first day of the window, skill, n, status) out after each batch of (day, skill)."""
    source, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    epoch, steps = datetime(1970, 1, 1), []
    for batch in batches:
        df = spark.createDataFrame([(None if d is None else epoch + timedelta(days=d), s) for d, s in batch], "ts timestamp, skill string")
        df.coalesce(1).write.mode("append").parquet(source)
        found = demand.windowed_demand(feeds.read_feed(spark, source, df.schema), ["skill"], F.col("ts"), width, delay, slide)
        feeds.append_feed(found, out, state).awaitTermination()
        rows = spark.read.schema(found.schema).parquet(out).collect()
        steps.append(sorted(((r["window_start"] and (r["window_start"] - epoch).days, r["skill"], r["n"], r["status"]) for r in rows), key=repr))
    return steps


def test_a_window_goes_out_once_and_late_rows_after_it(spark, tmp_path):
    batches = [
        [(100, "sql"), (109, "sql"), (103, "go"), (None, "sql"), (114, None)],
        [(101, "sql"), (112, "sql"), (116, "go")],  # the watermark is at 109: still in time
        [(102, "sql"), (102, "sql"), (119, None), (111, "sql")],  # the first window is out
        [(200, "go")],
    ]
    steps = demanded(spark, tmp_path, batches)
    untimed, late = (None, "sql", 1, "untimed"), (100, "sql", 2, "late")
    first = [(100, "go", 1, "closed"), (100, "sql", 3, "closed")]
    last = [(110, "go", 1, "closed"), (110, "sql", 2, "closed"), (110, None, 2, "closed")]
    assert steps == [[untimed], [*first, untimed], [first[0], late, first[1], untimed], sorted([*first, late, untimed, *last], key=repr)]


def test_sliding_windows_count_a_row_in_each(spark, tmp_path):
    steps = demanded(spark, tmp_path, [[(107, "go"), (None, "go")], [(300, "sql")]], slide="5 days")
    assert steps[-1] == [(100, "go", 1, "closed"), (105, "go", 1, "closed"), (None, "go", 1, "untimed")]


def test_hot_keys_are_counted_before_the_shuffle(spark):
    df = spark.range(5000, numPartitions=1).select((F.col("id") % 2).alias("_start"), F.when(F.col("id") % 3 > 0, "hot").alias("skill"))
    rows = demand.count_in_batches(df).collect()
    assert len(rows) == 4 and sum(r["_n"] for r in rows) == 5000
    assert demand.count_in_batches(df.limit(0)).count() == 0


def test_reserved_names_are_refused(spark):
    with pytest.raises(ValueError):
        demand.windowed_demand(spark.range(1).withColumnRenamed("id", "n"), ["n"], F.current_timestamp(), "1 day", "1 day")


def test_trend_with_gaps(spark):
    rows = [(0, "go", 1), (0, "sql", 3), (1, "sql", 2), (2, "go", 4), (4, "go", 5)]
    df = spark.createDataFrame([(DAY + timedelta(days=w), DAY + timedelta(days=w + 1), k, n) for w, k, n in rows],
                               "window_start timestamp, window_end timestamp, skill string, n long")
    got = {((r["window_start"] - DAY).days, r["skill"]): (r["share"], r["n_before"], r["share_change"]) for r in demand.demand_trend(df, "skill").collect()}
    assert got == {(0, "go"): (0.25, None, None), (0, "sql"): (0.75, None, None), (1, "sql"): (1.0, 3, 0.25),
                   (2, "go"): (1.0, 0, 1.0), (4, "go"): (1.0, None, None)}
