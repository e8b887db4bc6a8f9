"""Sources and sinks, in fresh folders and managed tables."""

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablestream import schemas
from tablestream.sources import readers, writers

_names = iter(f"t{i}" for i in range(1000))


@pytest.fixture
def table(spark):
    name = next(_names)
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_csv_typed_and_text(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1.5), (2, None, 2.5)], "id int, s string, x double")
    path = str(tmp_path / "csv")
    writers.write_csv(df, path)
    assert sorted(readers.read_csv(spark, path, df.schema).collect()) == sorted(df.collect())
    assert dict(readers.read_csv(spark, path).dtypes)["x"] == "double"
    text = readers.read_csv_text(spark, path)
    assert {kind for _, kind in text.dtypes} == {"string"}
    assert readers.with_types(text, {"x": "double"}).agg(F.sum("x")).first()[0] == 4.0
    writers.append_files(df, path)
    assert readers.read_csv(spark, path, df.schema).count() == 4


def test_microseconds_survive_text_files(spark, tmp_path):
    moment = datetime(2024, 1, 2, 3, 4, 5, 678901)
    df = spark.createDataFrame([(moment,)], "t timestamp")
    writers.write_csv(df, str(tmp_path / "c"))
    assert readers.read_csv(spark, str(tmp_path / "c"), df.schema).first().t == moment


def test_landing_reads_indented_documents(spark, tmp_path):
    for day, temp in (("2024-01-01", 1), ("2024-01-02", 2)):
        folder = tmp_path / day
        folder.mkdir()
        record = {"city_name": "x", "main": {"temp": temp},
                  "weather": [{"main": "Rain", "description": "r"}]}
        (folder / "x.json").write_text(json.dumps(record, indent=2))
    every = readers.read_landing(spark, str(tmp_path))
    assert sorted(r.main.temp for r in every.collect()) == [1.0, 2.0]
    one = readers.read_landing(spark, str(tmp_path), "2024-01-02").first()
    assert one.main.temp == 2.0 and json.loads(one.weather)[0]["main"] == "Rain"
    lines = tmp_path / "lines.json"
    lines.write_text('{"a": {"b": 1}}\n{"a": {"b": 2}}\n')
    inferred = readers.read_json(spark, str(lines))
    assert inferred.agg(F.sum("a.b")).first()[0] == 3


OPPORTUNITY = {
    "Date": "1/5/2024", "Salesperson": "s", "Lead Name": "l", "Segment": "g", "Region": "r",
    "Target Close": "02/01/2024", "Forecasted Monthly Revenue": "10.5", "Opportunity Stage": "Won",
    "Weighted Revenue": "", "Closed Opportunity": "true", "Active Opportunity": "FALSE",
    "Latest Status Entry": "TRUE",
}


def test_opportunities(spark):
    ddl = ", ".join(f"`{name}` string" for name in OPPORTUNITY)
    rows = [tuple(OPPORTUNITY.values()), (*list(OPPORTUNITY.values())[:9], None, "x", "no")]
    df = readers.ingest_opportunities(spark.createDataFrame(rows, ddl), "2024-02-02 00:00:00")
    assert df.schema.simpleString() == spark.createDataFrame(
        [], schemas.OPPORTUNITY
    ).schema.simpleString()
    first, second = df.collect()
    assert first["Date"] == date(2024, 1, 5) and first["Target Close"] == date(2024, 2, 1)
    assert (first["Closed Opportunity"], first["Active Opportunity"]) == (True, False)
    assert first["Latest Status Entry"] == datetime(2024, 2, 2)
    assert first["Weighted Revenue"] is None
    assert second["Latest Status Entry"] is None and second["Closed Opportunity"] is False
    with pytest.raises(ValueError):
        readers.ingest_opportunities(spark.createDataFrame([], ddl), "2024-02-02")


def test_seed_views_and_tables(spark, tmp_path, table):
    path = tmp_path / "seed.csv"
    path.write_text("id,name,created_at,updated_at\n1,ValidName1,2021-01-01,2021-01-01\n"
                    "2,ValidName2,,2021-01-02\n")
    readers.read_seed(spark, str(path), "seed", schemas.SEED)
    assert spark.sql("SELECT id FROM seed WHERE created_at IS NOT NULL").count() == 1
    rows = readers.literal_rows(spark, [(3, "c"), (1, "a"), (2, "b")], "id int, s string")
    writers.save_model(rows, table)
    got = readers.scan_table(spark, table, ["s"], ["s"], 2).collect()
    assert [r.s for r in got] == ["a", "b"]
    writers.create_view(rows.filter("id > 1"), "some_view")
    assert readers.resolve_table(spark, ["absent", "some_view", table]) == "some_view"
    with pytest.raises(ValueError):
        readers.resolve_table(spark, ["absent"])


def test_load_dispositions(spark, table):
    tables = {"BATCH": table}
    rows = spark.range(5).select(F.col("id"), F.lit("x").alias("s"))
    assert writers.load_table(rows, tables, "BATCH", "EMPTY") == 5
    assert writers.load_table(rows.select("s", "id"), tables, "BATCH") == 5
    assert spark.table(table).count() == 10
    with pytest.raises(ValueError):
        writers.load_table(rows, tables, "BATCH", "EMPTY")
    assert writers.load_table(rows.limit(2), tables, "BATCH", "TRUNCATE") == 2
    assert spark.table(table).count() == 2
    with pytest.raises(ValueError):
        writers.load_table(rows, tables, "UNKNOWN")
    with pytest.raises(ValueError):
        writers.load_table(rows, tables, "BATCH", "MERGE")
    writers.append_table(rows, table)
    assert spark.table(table).count() == 7


def days(spark, count):
    start = date(2024, 1, 1)
    rows = [(start + timedelta(days=i % count), f"c{i % 3}", float(i)) for i in range(60)]
    return spark.createDataFrame(rows, "date date, city string, v double")


def test_layout_prunes_and_expires(spark, table):
    writers.create_layout(days(spark, 10), table, ["date"], ["city"])
    one = spark.table(table).filter("date = DATE'2024-01-03'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    dropped = writers.expire_partitions(spark, table, "date", 4, date(2024, 1, 10))
    assert dropped == [f"2024-01-0{d}" for d in range(1, 6)]
    left = [r.date.day for r in spark.table(table).select("date").distinct().collect()]
    assert sorted(left) == [6, 7, 8, 9, 10]


def test_partition_reload_replaces_one_day(spark, tmp_path):
    path = str(tmp_path / "p")
    writers.write_partitions(days(spark, 3), path, ["date"], ["city"])
    again = days(spark, 3).filter("date = DATE'2024-01-02'").withColumn("v", F.lit(-1.0))
    writers.write_partitions(again, path, ["date"], ["city"])
    writers.write_partitions(again, path, ["date"], ["city"])
    got = readers.read_parquet(spark, path).groupBy("date").agg(F.count("*"), F.min("v"))
    rows = {r[0].day: (r[1], r[2]) for r in got.collect()}
    assert rows[2] == (20, -1.0) and rows[1] == (20, 0.0) and rows[3] == (20, 2.0)


def test_columns_are_added_never_dropped(spark, table):
    assert writers.ensure_table(spark, table, "event_id string, count long") == []
    added = writers.ensure_table(spark, table, "event_id string, browser string, os string")
    assert added == ["browser", "os"]
    assert spark.table(table).columns == ["event_id", "count", "browser", "os"]
    assert writers.ensure_table(spark, table, "os string") == []


def test_relational_options():
    assert readers.jdbc_partitions("id", 0, 100, 4) == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4",
    }
    with pytest.raises(ValueError):
        readers.jdbc_partitions("id", 0, 1, 0)
    options = writers.jdbc_options("jdbc:x", "t", 200, {"user": "u"})
    assert options == {"url": "jdbc:x", "dbtable": "t", "batchsize": "200", "user": "u"}


def test_all_schemas_parse(spark):
    names = [n for n in dir(schemas) if n.isupper() and n != "CONDITIONS"]
    assert len(names) > 15
    for name in names:
        assert spark.createDataFrame([], getattr(schemas, name)).columns


def test_landing_reads_both_forms(spark, tmp_path):
    schema = "city string, n long, date string"
    spark.createDataFrame([("a", 1), ("b", 2)], "city string, n long").coalesce(1).write.json(
        str(tmp_path / "date=2024-01-02")
    )
    (tmp_path / "2024-01-02").mkdir()
    (tmp_path / "2024-01-02" / "paris.json").write_text('{\n "city": "c",\n "n": 3\n}')
    found = readers.read_landing(spark, str(tmp_path), "2024-01-02", schema)
    assert sorted((r.city, r.n) for r in found.collect()) == [("a", 1), ("b", 2), ("c", 3)]


def test_messages_keep_what_the_broker_says(spark):
    messages = spark.createDataFrame([('{"n": 1}', 7), ("broken", 8)], "value string, offset long")
    found = readers.decode_json(messages, "n long", metadata=["offset"]).collect()
    assert [tuple(r) for r in found] == [(7, 1), (8, None)]


def test_an_end_with_a_time_ends_there(spark):
    from tablestream.functions.predicates import date_range

    rows = spark.sql("SELECT explode(sequence(TIMESTAMP'2024-01-01', TIMESTAMP'2024-01-03', INTERVAL 6 HOUR)) AS t")
    assert date_range(rows, "t", "2024-01-01", "2024-01-02").count() == 8
    assert date_range(rows, "t", "2024-01-01", "2024-01-02 06:00:00").count() == 6


def test_landing_reads_every_name(spark, tmp_path):
    names = ["p", "pa", "par", "part", "pb", "paris", "parts", "part-0", "x"]
    (tmp_path / "2024-01-02").mkdir()
    for n, name in enumerate(names):
        (tmp_path / "2024-01-02" / f"{name}.json").write_text(f'{{"n": {n}}}\n')
    found = readers.read_landing(spark, str(tmp_path), "2024-01-02", "n long")
    assert sorted(r.n for r in found.collect()) == list(range(len(names)))
