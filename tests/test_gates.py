import datetime as d

from conftest import rows

from callops.operators import gates


def table(spark, counts):
    """{day of January 2023: number of rows}; day None is a NULL date."""
    data = [(None if day is None else d.date(2023, 1, day),) for day, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(data, "date date")


def actions(df):
    return {r["date"].day: r["action"] for r in df.collect()}


def test_count_parity(spark):
    out = gates.count_parity(table(spark, {1: 1, 2: 2, 3: 3, None: 4}), table(spark, {1: 1, 2: 5, 9: 9}))
    assert actions(out) == {1: "skip", 2: "reload", 3: "reload", 9: "skip"}


def test_count_diff_list(spark):
    out = gates.count_diff_list(table(spark, {1: 1, 2: 2, 3: 3}), table(spark, {1: 1, 2: 5, 9: 9}))
    assert actions(out) == {2: "reload", 3: "reload", 9: "purge"}


def test_equal_totals_do_not_hide_differences(spark):
    out = gates.count_diff_list(table(spark, {1: 1, 2: 3}), table(spark, {1: 3, 2: 1}))
    assert actions(out) == {1: "reload", 2: "reload"}


def test_count_diff_range(spark):
    out = gates.count_diff_range(table(spark, {1: 1, 3: 2, 5: 1, 6: 1}), table(spark, {3: 2, 4: 1, 6: 1, 9: 1}))
    assert actions(out) == {1: "reload", 2: "purge", 3: "reload", 4: "purge", 5: "reload", 9: "purge"}


def test_count_diff_range_without_difference(spark):
    assert actions(gates.count_diff_range(table(spark, {1: 1}), table(spark, {1: 1}))) == {}
    assert actions(gates.count_diff_range(table(spark, {1: 1}), table(spark, {1: 1, 4: 1}))) == {4: "purge"}


def test_symmetric_diff(spark):
    out = gates.symmetric_diff(table(spark, {1: 1, 2: 2, 3: 1}), table(spark, {1: 1, 2: 7, 9: 1}))
    assert actions(out) == {3: "reload", 9: "purge"}


def test_insert_if_absent(spark):
    out = gates.insert_if_absent(table(spark, {1: 1, 2: 2}), table(spark, {2: 1, 3: 1}))
    assert actions(out) == {1: "insert"}


def test_month_parity_knows_the_year(spark):
    def dates(*texts):
        return spark.createDataFrame([(d.date.fromisoformat(t),) for t in texts], "date date")

    out = gates.month_parity(dates("2023-05-01", "2023-06-01", "2023-06-02"), dates("2022-05-09", "2023-05-30", "2023-06-01"))
    assert {str(r["date"]): r["action"] for r in out.collect()} == {
        "2022-05-01": "purge", "2023-05-01": "skip", "2023-06-01": "reload"}


def test_always_and_series(spark):
    out = gates.always(table(spark, {2: 1}), table(spark, {2: 1}), "2023-01-01", "2023-01-03")
    assert [(r[0].day, r[1], r[2], r[3]) for r in sorted(out.collect())] == [
        (1, 0, 0, "reload"), (2, 1, 1, "reload"), (3, 0, 0, "reload")]
    assert gates.date_series(spark, "2023-01-31", "2023-02-02").count() == 3


def test_month_start(spark):
    frame = table(spark, {5: 2})
    assert gates.on_month_start(frame, "2023-02-01").count() == 2
    assert gates.on_month_start(frame, "2023-02-02").count() == 0


def test_same_dates_and_counts(spark):
    same = gates.same_dates_and_counts(table(spark, {1: 2}), table(spark, {1: 2})).first()
    other = gates.same_dates_and_counts(table(spark, {1: 2}), table(spark, {1: 1, 2: 1})).first()
    assert (same["equal"], other["equal"], other["different_dates"]) == (True, False, 2)


def test_new_rows_counts_duplicates(spark):
    def frame(values):
        return spark.createDataFrame([(v, "x") for v in values], "a int, b string")

    source, target = frame([1, 1, 1, 2, None, None, 4]), frame([1, 2, 2, None, 5])
    assert rows(gates.new_rows(source, target)) == sorted([(1, "x"), (1, "x"), (None, "x"), (4, "x")], key=repr)


def test_new_rows_looks_at_changed_dates_only(spark):
    def frame(*values):
        return spark.createDataFrame([(d.date(2023, 1, n) if n else None, v) for n, v in values], "date date, v string")

    source = frame((1, "a"), (1, "a"), (2, "b"), (2, None), (3, "c"), (None, "n"), (None, "m"), (5, "x"))
    target = frame((1, "a"), (1, "a"), (2, "b"), (2, "z"), (3, "c"), (None, "n"), (4, "gone"))
    assert rows(gates._changed_dates(source, target, "date")) == sorted(
        [(d.date(2023, 1, 2),), (None,), (d.date(2023, 1, 4),), (d.date(2023, 1, 5),)], key=repr)
    assert rows(gates.new_rows(source, target, date="date")) == rows(gates.new_rows(source, target))
    assert rows(gates.new_rows(source, source, date="date")) == []


def test_new_rows_splits_a_very_frequent_row(spark):
    source = spark.range(10_000).selectExpr("'same' a").union(spark.range(5).selectExpr("cast(id as string) a"))
    out = gates.new_rows(source, source.limit(0), rows_per_task=300)
    assert out.count() == 10_005 and out.where("a = 'same'").count() == 10_000
    sizes = [n for n in out.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()]
    assert max(sizes) < 8_000


def test_actions_partition_the_dates(spark):
    source, target = table(spark, {1: 1, 2: 2, 3: 3}), table(spark, {2: 2, 3: 1, 4: 1})
    assert set(actions(gates.count_parity(source, target))) == {1, 2, 3, 4}
