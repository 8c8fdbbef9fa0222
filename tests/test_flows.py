"""The jobs end to end, on rows in the tables' own formats."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops import schemas
from lakeops.flows import box_scores, salaries, shots, tables
from lakeops.flows import sales as sales_flow
from lakeops.operators.incremental import current_status, status_history
from lakeops.sources.files import write_table
from lakeops.sources.layers import Lake
from lakeops.sources.streams import read_files
from lakeops.streaming.ingest import UNTIL_DONE
from lakeops.workspace import new_folder

COUNTERS = [f.name for f in schemas.BOX_SCORE_LANDING.fields if f.dataType == T.IntegerType()]


def box_row(person, game, when, first, last, team, **values):
    row = {f.name: "0" for f in schemas.BOX_SCORE_LANDING.fields}
    row |= dict(
        personId=person, gameId=game, gameDateTimeEst=when, firstName=first, lastName=last,
        playerteamName=team, opponentteamName="Rest", gameType="Regular", gameLabel=None,
        numMinutes="30", win="1", home="0",
    )
    row |= values
    row["plusMinusPoints"] = row.pop("plusMinus")
    return row


@pytest.fixture
def lake(spark):
    lake = Lake(new_folder(spark, "lake"))
    tables.create_tables(spark, lake)
    return lake


def write_feed(spark, rows):
    names = [schemas.BOX_SCORE_FILE_NAMES.get(f.name, f.name) for f in schemas.BOX_SCORE_LANDING.fields]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    path = new_folder(spark, "feed")
    write_table(spark.createDataFrame([[r[n] for n in names] for r in rows], schema), path, fmt="csv")
    return path


def land(spark, lake, csv, checkpoint, topic):
    messages = box_scores.box_score_messages(spark, lake, csv)
    messages.write.mode("append").json(topic)
    schema = T.StructType().add("key", "string").add("value", "string")
    stream = read_files(spark, topic, schema, fmt="json")
    box_scores.land_box_scores(stream, lake, checkpoint, UNTIL_DONE).awaitTermination()


def test_box_scores(spark, lake, rows):
    day = ["2025-10-21 19:00:00", "2025-10-22 19:00:00", "2025-11-01 19:00:00", "2025-11-02 19:00:00"]
    first = [
        box_row("7.0", "100", day[0], "Santiago", "Aldama", "A", points="10", plusMinus="4.0"),
        box_row("8", "100", day[0], "Ana", "Bo", "A", points="x", numMinutes=""),
        box_row("7", "101", day[1], "Santiago", "Aldama", "A", points="21"),
        box_row("7", "90", "2025-10-01 19:00:00", "Santiago", "Aldama", "A", points="99"),
    ]
    checkpoint, topic = new_folder(spark, "cp"), new_folder(spark, "topic")
    land(spark, lake, write_feed(spark, first), checkpoint, topic)
    landed = lake.read(spark, "landing", tables.BOX)
    # the game before the default start date is not loaded; bad numbers are 0
    assert rows(landed, "personId", "gameId", "points", "plusMinus", "numMinutes") == [
        ("7", "100", 10, 4, 30), ("7", "101", 21, 0, 30), ("8", "100", 0, 0, 0),
    ]
    assert box_scores.merge_box_scores(spark, lake) == [dt.date(2025, 10, 1)]

    second = [
        *first,
        box_row("7", "101", day[2], "Santiago", "Aldama", "A", points="22"),
        box_row("7", "102", day[3], "Santiago", "Aldama", "B", points="5", reboundsOffensive="2"),
    ]
    land(spark, lake, write_feed(spark, second), checkpoint, topic)
    assert lake.read(spark, "landing", tables.BOX).count() == 5
    # game 101 moves to November
    for _ in range(2):
        box_scores.merge_box_scores(spark, lake)
        processed = lake.read(spark, "processed", tables.BOX)
        assert rows(processed, "personId", "gameId", "points", "month") == [
            (7, 100, 10, dt.date(2025, 10, 1)), (7, 101, 22, dt.date(2025, 11, 1)),
            (7, 102, 5, dt.date(2025, 11, 1)), (8, 100, 0, dt.date(2025, 10, 1)),
        ]

    wide = spark.createDataFrame(
        [("Santi Aldama", "A", 1e6, 2e6, None, 0.0), ("Nobody Known", "B", 5.0, None, None, None)],
        T.StructType(schemas.SALARY_LANDING.fields[:6]),
    )
    for _ in range(2):
        report = salaries.process_salaries(spark, lake, wide).first()
    assert report.asDict() == {
        "total": 3, "matched": 2, "unmatched": 1, "coverage_pct": 66.7, "low_confidence": 2,
    }
    paid = lake.read(spark, "processed", tables.SALARIES)
    assert rows(paid, "personid", "season", "salary_usd") == [(7, "2025-26", 1000000), (7, "2026-27", 2000000)]

    for _ in range(2):
        box_scores.refresh_warehouse(spark, lake)
        logs = lake.read(spark, "warehouse", "game_logs")
        assert rows(logs, "personid", "gameid", "prev_game_date", "is_back_to_back", "player_name") == [
            (7, 100, None, False, "Santiago Aldama"),
            (7, 101, dt.date(2025, 10, 21), False, "Santiago Aldama"),
            (7, 102, dt.date(2025, 11, 1), True, "Santiago Aldama"),
        ]
        stats = lake.read(spark, "warehouse", "player_season_stats")
        # a traded player has a row per team, both with the greatest salary of any season
        columns = ("playerteamname", "season_start_year", "total_games_played", "avg_points", "total_rebounds_sum", "salary_usd")
        assert rows(stats, *columns) == [("A", 2025, 2, 16.0, 0, 2000000), ("B", 2025, 1, 5.0, 2, 2000000)]


def test_merge_needs_landed_rows(spark, lake):
    with pytest.raises(ValueError, match="landing table has no rows"):
        box_scores.merge_box_scores(spark, lake)


def test_sales(spark, rows):
    lake = Lake(new_folder(spark, "lake"))
    day = lambda d: dt.datetime.fromisoformat(d)
    sales = spark.createDataFrame(
        [
            (1, day("2018-02-27"), 10, 5, 3, 2, 2000.0, 0.1),
            (1, day("2018-02-27"), 10, 5, 3, 2, 2000.0, 0.1),
            (2, day("2018-03-01"), 11, 6, 3, 1, 100.25, 0.0),
            (3, day("2018-03-02"), 99, 6, 4, 1, 50.0, 0.2),
        ],
        "SalesID int, SalesDate timestamp, SalesPersonID int, CustomerID int, ProductID int,"
        " Quantity int, TotalPrice double, Discount double",
    )
    employees = spark.createDataFrame(
        [(10, "Ana", "Bo", day("2010-01-01")), (11, "Cy", "Di", day("2018-01-01"))],
        "EmployeeID int, FirstName string, LastName string, HireDate timestamp",
    )
    customers = spark.createDataFrame([(5, "x"), (6, "y"), (6, "y"), (7, "z")], "CustomerID int, Name string")
    for name, df in (("sales", sales), ("employees", employees), ("customers", customers)):
        write_table(df, lake.path("landing", name))

    for run in (1, 2):
        checks = sales_flow.process_sales(
            spark, lake, run=run, timestamp=f"2026-01-0{run}T08:00:00", as_of="2020-01-01"
        )
        assert [r.status for r in checks.collect()] == ["PASS"] * 5
        stored = lake.read(spark, "processed", "sales")
        assert rows(stored, "SalesID", "month", "EmployeeFirstName", "CommissionRate", "Commission") == [
            (1, 2, "Ana", 0.06, 120.0), (2, 3, "Cy", 0.03, 3.01), (3, 3, None, 0.03, 1.5),
        ]
    status = lake.path("processed", "_processing_status")
    assert current_status(spark, status).first().last_processed_month == "2018-03"
    assert [r.seq for r in status_history(spark, status).collect()] == [2, 1]
    # purchases are counted on the raw sales
    assert rows(lake.read(spark, "processed", "customers"), "CustomerID", "TotalPurchases") == [(5, 2), (6, 2), (7, 0)]
    assert lake.read(spark, "processed", "employees").where("EmployeeID = 10").first().DaysEmployed == 3652
    top = lake.read(spark, "processed", "products_by_period")
    assert rows(top.where("year = 2018 and month = 3"), "productid", "total_revenue") == [(3, 100.25), (4, 50.0)]


def test_the_second_run_processes_new_months_only(spark, lake, rows):
    kind = (
        "SalesID int, SalesPersonID int, CustomerID int, ProductID int, Quantity int, Discount double,"
        " TotalPrice double, SalesDate timestamp"
    )

    def land(*made):
        sales = spark.createDataFrame([(i, 10, 5, p, 1, 0.0, x, d) for i, p, x, d in made], kind.replace("timestamp", "string"))
        write_table(sales.withColumn("SalesDate", F.col("SalesDate").cast("timestamp")), lake.path("landing", "sales"), mode="append")

    people = spark.createDataFrame([(10, "Ana", "B", "2010-01-01")], "EmployeeID int, FirstName string, LastName string, HireDate string")
    write_table(people.withColumn("HireDate", F.col("HireDate").cast("date")), lake.path("landing", "employees"))
    write_table(spark.createDataFrame([(5, "x")], "CustomerID int, Name string"), lake.path("landing", "customers"))

    def run(n, **how):
        sales_flow.process_sales(spark, lake, run=n, timestamp=f"2026-01-0{n}T08:00:00", as_of="2020-01-01", **how)
        newest = current_status(spark, lake.path("processed", "_processing_status")).first()
        month = {(r.year, r.month): r.total_revenue for r in lake.read(spark, "processed", "products_by_period").collect()}
        whole = lake.read(spark, "processed", "products_global").first().total_revenue
        return newest.last_processed_month, newest.total_records_processed, month, whole

    land((1, 3, 10.0, "2018-02-03"), (2, 3, 20.0, "2018-03-04"))
    assert run(1) == ("2018-03", 2, {(2018, 2): 10.0, (2018, 3): 20.0}, 30.0)
    # more of the last month, a new month, and a change in a month that is done
    land((3, 3, 1.0, "2018-03-31 23:59:59"), (4, 3, 5.0, "2019-01-01"), (5, 3, 7.0, "2018-02-28"))
    assert run(2) == ("2019-01", 3, {(2018, 2): 10.0, (2018, 3): 21.0, (2019, 1): 5.0}, 36.0)
    assert run(3) == ("2019-01", 1, {(2018, 2): 10.0, (2018, 3): 21.0, (2019, 1): 5.0}, 36.0)
    assert run(4, full=True) == ("2019-01", 5, {(2018, 2): 17.0, (2018, 3): 21.0, (2019, 1): 5.0}, 43.0)
    # files of one month are read, and the filter on the landed rows reaches their scan
    stored = sales_flow.from_period(lake.read(spark, "processed", "sales"), "2019-01")
    folders = {f.split("year=")[1].rsplit("/", 1)[0] for f in (r.f for r in stored.select(F.input_file_name().alias("f")).distinct().collect())}
    assert folders == {"2019/month=1"}
    landed = sales_flow.from_month(spark.read.parquet(lake.path("landing", "sales")), "2019-01")
    assert "GreaterThanOrEqual(SalesDate" in landed._jdf.queryExecution().executedPlan().toString()


def test_tables_by_name_in_sql(spark, lake):
    lake.register(spark, "processed", tables.BOX, tables.BOX_MONTHLY)
    assert spark.sql(f"SELECT COUNT(*) FROM {tables.BOX} WHERE points >= 30").first()[0] == 0
    with pytest.raises(ValueError, match="unknown layer"):
        lake.path("gold", "x")


def write_csv(spark, rows, names):
    path = new_folder(spark, "csv")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    write_table(spark.createDataFrame(rows, schema), path, fmt="csv")
    return path


def test_salaries_land_and_grow(spark, lake, rows):
    names = ["player", "team", *schemas.SALARY_SEASONS]
    csv = write_csv(spark, [
        (" Santi Aldama ", "A", "1000000", "2000000.5", "x", None, None, None),
        ("santi aldama", "B", "5", "6", "7", "8", "9", "10"),
        ("Nene", "C", "1", None, None, None, None, None),
    ], names)
    for _ in range(2):
        salaries.land_salaries(spark, lake, csv)
    wide = lake.read(spark, "landing", tables.SALARIES_RAW)
    assert wide.schema.fieldNames() == schemas.SALARY_LANDING.fieldNames()
    assert rows(wide, "fullname", "`2026-27`", "`2027-28`") == [
        ("Nene", None, None), ("Santi Aldama", 2000000.5, None), ("santi aldama", 6.0, 7.0),
    ]
    table = spark.createDataFrame([("SANTI", "Aldama", 1.0), ("Nene", "Nene", 2.0)], "firstname string, lastname string, salary_usd double")
    grown = salaries.add_later_seasons(table, wide, ["playerteamName"])
    assert grown.columns[3:] == ["salary_2026_27", "salary_2027_28", "salary_2028_29", "salary_2029_30"]
    assert rows(grown, "lastname", "salary_usd", "salary_2026_27", "salary_2027_28") == [
        ("Aldama", 1.0, 2000000.5, None), ("Nene", 2.0, None, None),
    ]


def test_tiers(spark, lake, rows):
    feed = spark.createDataFrame(
        [("A", 1, dt.datetime(1947, 1, 2), None, 3), ("A", 1, dt.datetime(2015, 10, 1), 5, None), ("B", 2, None, 5, 4)],
        "playerteamName string, personId int, gameDateTimeEst timestamp, points int, win int",
    )
    box_scores.write_tiers(lake, feed)
    assert rows(lake.read(spark, "processed", "players_full"), "month", "points") == [
        (None, 5), (dt.date(1947, 1, 1), None), (dt.date(2015, 10, 1), 5),
    ]
    assert rows(lake.read(spark, "processed", "players_500k"), "points") == [(5,)]
    zero = {c: F.lit(0) for c in ("assists", "numMinutes")}
    wide = feed.withColumns({**zero, "gameType": F.lit("x"), "reboundsDefensive": F.col("points"), "reboundsOffensive": F.col("win")})
    got = {r.column_name: r.null_count for r in box_scores.feed_null_rates(wide).collect()}
    assert got == {"points": 1, "assists": 0, "gameType": 0, "win": 1, "numMinutes": 0, "rebounds_total": 0}


def test_shots(spark, lake, rows):
    actions = spark.createDataFrame(
        [
            ("g", 1, 2, None, None), ("g", 2, 4, "2", "0"), ("g", 3, 7, "", "0"), ("g", 4, 8, "2", "3"),
            ("g", 5, 4, None, None), ("h", 1, 4, "9", "9"), ("g", 6, 9, "5", None),
        ],
        "GAME_ID string, position int, actionNumber int, scoreHome string, scoreAway string",
    )
    want = [("g", 2, "0 - 0"), ("g", 4, "2 - 3"), ("g", 7, "2 - 0"), ("g", 8, "2 - 3"), ("g", 9, "2 - 3"), ("h", 4, "9 - 9")]
    assert rows(shots.running_scores(actions)) == want
    assert rows(shots.running_scores(actions, max_rows=2)) == want
    names = [*shots.SHOT_FIELDS, "GAME_EVENT_ID", "SHOT_TYPE", "EVENT_TYPE"]
    values = {"GAME_ID": "g", "PERIOD": 1, "SHOT_DISTANCE": 24, "LOC_X": 1, "LOC_Y": 2, "MINUTES_REMAINING": 3, "SECONDS_REMAINING": 4}
    base = [values.get(n, "t") for n in shots.SHOT_FIELDS]
    feed = spark.createDataFrame([(*base, 7, "3PT Field Goal", "Made Shot"), (*base, 99, "2PT Field Goal", "Missed Shot")], names)
    chart = shots.shot_chart(feed, actions)
    assert [(f.name, f.dataType) for f in chart.schema] == [(f.name, f.dataType) for f in schemas.SHOT_CHART_MESSAGE]
    assert rows(chart, "valor_tiro", "anotado", "marcador_previo") == [(2, 0, "0 - 0"), (3, 1, "2 - 0")]

    csv = write_csv(spark, [tuple(str(i) for i in range(20))], list(schemas.SHOT_LOG_NAMES))
    shots.load_shot_log(spark, lake, csv)
    log = lake.read(spark, "landing", "shots")
    assert sorted(log.columns) == sorted(schemas.SHOT_LOG_NAMES.values()) and log.first().jugador_id == 19


def test_new_table_from_csv(spark, lake):
    csv = write_csv(spark, [("1", "Arena")], ["gameid", "arenaname"])
    tables.load_csv_table(spark, lake, csv, "processed", "dim_schedule")
    assert dict(lake.read(spark, "processed", "dim_schedule").dtypes)["gameid"] == "int"
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.load_csv_table(spark, lake, csv, "processed", "dim_schedule")
