
from tallyhouse.operators.periods import month_index, week_index, with_changes


def test_gaps_stay_gaps(spark, local):
    rows = [("a", 2023, 1, 10), ("a", 2023, 2, 15), ("a", 2023, 4, 30), ("a", 2024, 1, 20), ("b", 2023, 2, 7), ("a", 2023, 12, 0)]
    df = local(rows, "shop string, y int, m int, net long")
    got = {(r.shop, r.y, r.m): r for r in with_changes(
        df, ["shop"], month_index("y", "m"), "net", {"month": 1, "year": 12}).collect()}
    assert (got["a", 2023, 2].month_net, got["a", 2023, 2].month_change, got["a", 2023, 2].month_ratio) == (10, 5, 0.5)
    assert got["a", 2023, 4].month_net is None and got["b", 2023, 2].month_net is None
    january = got["a", 2024, 1]
    assert (january.month_net, january.month_ratio) == (0, None)  # December is the month before, nothing divides by 0
    assert (january.year_net, january.year_change) == (10, 10)


def test_week_index_runs_over_the_year_end(spark, local):
    df = spark.sql("select explode(array(date'2024-12-23', date'2024-12-30', date'2025-01-05', date'2025-01-06')) as d")
    index = [r[0] for r in df.select(week_index("d")).collect()]
    assert [i - index[0] for i in index] == [0, 1, 1, 2]
