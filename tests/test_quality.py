from datetime import date

from pyspark.sql import functions as F

from tablestream.operators import quality

FIELDS = {"temperature": (-50.0, 60.0)}


def temps(spark, values):
    return spark.createDataFrame([(v,) for v in values], "temperature double")


def test_profiles(spark):
    df = temps(spark, [-50.0, 60.0, 60.1, None])
    row = quality.profile(df, FIELDS).first()
    assert (row.total, row.null_count, row.non_null, row.out_of_range) == (4, 1, 3, 1)
    assert row.null_percentage == 25.0 and abs(row.out_of_range_percentage - 100 / 3) < 1e-9


def test_empty_table_has_zero_percent(spark):
    row = quality.profile(temps(spark, []), FIELDS).first()
    assert (row.total, row.null_percentage, row.out_of_range_percentage) == (0, 0.0, 0.0)
    assert quality.null_profile(temps(spark, []), ["temperature"]).first().null_percentage == 0.0


def test_row_tests(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, None)], "id int, name string")
    assert quality.null_rows(df, "id").count() == 1
    assert [r.id for r in quality.repeated_values(df, ["id"]).collect()] == [1]
    assert [r.name for r in quality.unaccepted_rows(df, "name", ["a"]).collect()] == ["b"]
    assert not quality.passes(quality.null_rows(df, "id"))
    assert quality.passes(df.filter("id > 5"))


def test_seed_passes_its_tests(spark):
    names = ["ValidName1", "ValidName2", "ValidName3"]
    seed = spark.createDataFrame(list(enumerate(names, 1)), "id int, name string")
    found = quality.column_tests(
        seed, {"not_null": F.col("id").isNull(), "accepted": ~F.col("name").isin(names)}
    ).unionByName(quality.unique_test(seed, ["id"], "unique"))
    assert {r.test: r.failures for r in found.collect()} == {
        "not_null": 0, "accepted": 0, "unique": 0,
    }


def checked(spark, rows):
    df = spark.createDataFrame(rows, "city string, day date, temperature double")
    return quality.Checked(df, F.col("day"), ["temperature"])


def test_report_statuses(spark):
    days = [date(2024, 1, d) for d in range(1, 11)]
    cities = spark.createDataFrame([("a",), ("b",)], "city string")
    full = [(c, d, 20.0) for c in "ab" for d in days]
    tables = {
        "fine": checked(spark, full),
        "one_gap": checked(spark, full[1:]),
        "gaps": checked(spark, full[3:]),
        "some_nulls": checked(spark, full[2:] + [(c, d, None) for c, d, _ in full[:2]]),
        "hot": checked(spark, full[:-2] + [(c, d, 61.0) for c, d, _ in full[-2:]]),
        "absent": quality.Checked(None, F.col("day"), []),
        "broken": quality.Checked(cities, F.col("day"), ["temperature"]),
    }

    def statuses(names):
        report = quality.quality_report(
            spark, {n: tables[n] for n in names}, cities, "city", days[-1], 10
        )
        return {r.table: (r.missing, r.status) for r in report.collect()}

    assert statuses(["fine", "absent"]) == {
        "fine": (0, "PASS"), "absent": (None, "NOT_FOUND"), "overall": (None, "PASS"),
    }
    assert statuses(["fine", "one_gap", "some_nulls"]) == {
        "fine": (0, "PASS"), "one_gap": (1, "WARNING"), "some_nulls": (0, "WARNING"),
        "overall": (None, "WARNING"),
    }
    got = statuses(["gaps", "hot", "broken"])
    assert got["gaps"] == (3, "FAIL") and got["hot"] == (0, "FAIL")
    assert got["broken"] == (None, "ERROR") and got["overall"] == (None, "FAIL")


def test_undecodable_messages_are_kept(spark):
    lines = ['{"k": 1}', "not json", '{"k": "x"}', '{"k": 2, "more": true}', "{", '{"j": 1}']
    df = spark.createDataFrame(list(enumerate(lines)), "id int, value string")
    good, dead = quality.split_undecodable(df, "k double")
    assert {r.id: r.k for r in good.collect()} == {0: 1.0, 3: 2.0, 5: None}
    assert sorted(r.dead_letter for r in dead.collect()) == sorted([lines[i] for i in (1, 2, 4)])
