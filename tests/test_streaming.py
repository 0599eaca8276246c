"""Streams over several micro-batches, in files that overlap in time, against their batch answer."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from tillworks.operators import riders
from tillworks.operators.loads import stored_orders
from tillworks.plans import streams
from tillworks.streaming import hourly, sessions
from tillworks.streaming.state import finish, state_figures
from tillworks.streaming.upsert import order_tables, start_upsert

T0 = dt.datetime(2024, 1, 1, 8)
OK = ("paid", "fulfilled", "success", "Walk In")
SALES = ("transaction_id long, order_id long, outlet_code string, transaction_date timestamp_ntz, payment_status string, fulfillment_status string, "
         "transactions_status string, sales_type string, total_amount double")


def _stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def _write(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


EVENTS = "id long, rider_code string, timestamp timestamp_ntz, is_stationed string"


def _sessions(spark, tmp_path, parts):
    """(sessions, the finished query) of files in turn."""
    path = str(tmp_path / "in")
    for part in parts:
        _write(spark.createDataFrame(part, EVENTS), path)
        time.sleep(0.05)  # files are taken by time
    done = finish(sessions.start_sessions(_stream(spark, path, EVENTS), str(tmp_path / "out"), str(tmp_path / "ck")))
    return sessions.sessions(spark, str(tmp_path / "out")), done


def _batch_sessions(spark, rows):
    return riders.session_summary(riders.flag_sessions(spark.createDataFrame(rows, EVENTS)))


def _same_rows(got, want):
    got = got.select(*want.columns)
    return got.schema.simpleString() == want.schema.simpleString() and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("order", ["in time", "dealt", "backwards", "repeated"])
def test_sessions_do_not_depend_on_the_files(spark, tmp_path, order):
    rows = [(i, f"r{i % 3}", T0 + dt.timedelta(minutes=i * 37, seconds=i), ["true", "true", "false", "?"][i * 7 % 13 % 4]) for i in range(150)]
    rows += [(None, "r1", T0 + dt.timedelta(minutes=5), "true"), (901, "r1", None, "true"), (902, "r2", None, "false"), (903, None, T0, "true")]
    parts = {"in time": [rows[:50], rows[50:100], rows[100:]], "dealt": [rows[i::3] for i in range(3)], "backwards": [rows[100:], rows[50:100], rows[:50]],
             "repeated": [rows[:80], [r for r in rows[60:120] if r[0] is not None], rows[120:] + rows[:40]]}[order]
    got, done = _sessions(spark, tmp_path, parts)
    assert done.lastProgress["batchId"] == 2 and _same_rows(got, _batch_sessions(spark, rows))
    figures = state_figures(done)
    assert figures["rows"] == len({(r[1], r[2] and r[2].date()) for r in rows}) and figures["bytes"] > 0


def test_a_late_event_cuts_and_joins_sessions(spark, tmp_path):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    first = [(1, "r", at(0), "true"), (2, "r", at(10), "true"), (3, "r", at(60 * 24), "true"), (4, "r", at(60 * 24 + 5), "false")]
    cut, joined = [(5, "r", at(5), "false")], [(6, "r", at(60 * 24 - 1), "false")]
    got, done = _sessions(spark, tmp_path, [first, cut, joined])
    assert sorted((r.session_id, r.session_start, r.session_end, r.total_logs) for r in got.collect()) == [
        ("r_S0001", at(0), at(5), 2), ("r_S0002", at(10), at(60 * 24 - 1), 2), ("r_S0003", at(60 * 24), at(60 * 24 + 5), 2)]
    # each later batch touched one day, and its row alone went out
    assert [spark.read.parquet(f"{tmp_path}/out/batch={b}").count() for b in range(3)] == [2, 1, 1]


def test_sessions_before_the_first_event(spark, tmp_path):
    (tmp_path / "in").mkdir()
    got, _ = _sessions(spark, tmp_path, [])
    assert got.isEmpty()


def test_of_deliveries_of_an_event_the_first_counts(spark, tmp_path):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    got, _ = _sessions(spark, tmp_path, [[(1, "r", at(0), "true"), (2, "r", at(9), "true")], [(2, "r", at(9), "false"), (3, "r", at(20), "false")]])
    assert [(r.session_start, r.session_end, r.total_logs, r.total_true_logs) for r in got.collect()] == [(at(0), at(20), 3, 2)]


def test_sessions_are_told_without_python_workers(spark, tmp_path):
    (tmp_path / "in").mkdir()
    days = sessions.day_runs(_stream(spark, str(tmp_path / "in"), EVENTS))
    assert days.isStreaming and "python" not in days._jdf.queryExecution().logical().toString().lower()
    assert days.schema.simpleString() == spark.createDataFrame([], sessions.SLOTS).schema.simpleString()


def test_upsert_across_batches(spark, tmp_path):
    schema = "order_id long, transaction_id long, order_date timestamp_ntz, n_details long, v string"
    path = str(tmp_path / "in")
    old = T0 - dt.timedelta(days=9)
    versions = [
        [(1, 1, T0, 2, "v1"), (2, 1, T0, 1, "v1"), (7, 1, old, 1, "v1")],
        [(1, 1, T0, 3, "v2"), (2, 1, T0, 0, "v2"), (3, 1, T0, 1, "v2")],
        [(3, 1, T0, 1, "v3"), (3, 2, T0, 1, "v3")],
    ]
    for rows in versions:
        _write(spark.createDataFrame(rows, schema), path)

    def split(batch):
        details = (batch.filter("n_details > 0").dropDuplicates(["order_id"]).withColumn("line", F.explode(F.expr("sequence(1, n_details)")))
                   .select("order_id", "line", "order_date", "v"))
        return batch.drop("n_details"), details

    tables = order_tables(spark, str(tmp_path / "tables"), 4)
    cutoff = "2024-01-01 00:00:00"
    finish(start_upsert(_stream(spark, path, spark.createDataFrame(versions[0], schema).schema), tables, split, str(tmp_path / "ck"), cutoff))
    headers = sorted((r.order_id, r.transaction_id, r.v) for r in stored_orders(tables, "headers", cutoff).collect())
    assert headers == [(1, 1, "v2"), (2, 1, "v1"), (3, 1, "v3"), (3, 2, "v3")]
    assert stored_orders(tables, "details", cutoff).count() == 3 + 1 + 1


def _sales(spark, rows):
    df = spark.createDataFrame(rows, SALES)
    for c in ("total_order_amount", "total_discount_amount", "total_promotion_amount", "subtotal", "total_tax_amount"):
        df = df.withColumn(c, F.col("total_amount"))
    return df


def _hourly(spark, tmp_path, batches, delay="2 hours"):
    """One run of intake and hours for each batch, as an hourly job would; returns the hours and the hours' queries."""
    path, folder, done = str(tmp_path / "in"), str(tmp_path / "out"), []
    for rows in batches:
        _write(_sales(spark, rows), path)
        stream = spark.readStream.schema(_sales(spark, rows[:1]).schema).parquet(path)
        finish(hourly.start_intake(stream, folder, str(tmp_path / "intake"), delay))
        done.append(finish(hourly.start_hours(spark, folder, str(tmp_path / "hours"), delay, 4)))
    return hourly.hours(spark, folder), done


def test_hourly_sales_keep_late_rows_and_count_deliveries_once(spark, tmp_path):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    batches = [[(1, 1, "A", at(5), *OK, 10.0), (2, 1, "A", at(6), *OK, 5.0), (7, 7, "A", at(125), *OK, 3.0)],
               [(1, 1, "A", at(5), *OK, 10.0), (4, 3, "A", at(61), *OK, 2.0), (5, 3, "B", at(62), *OK, 4.0), (7, 7, "A", at(125), *OK, 3.0)],
               [(3, 2, "A", at(59), *OK, 1.0), (9, 9, "A", at(600), *OK, 1.0), (None, 8, "A", at(601), *OK, 1.0), (None, 8, "A", at(601), *OK, 1.0)],
               [(4, 3, "A", at(61), *OK, 2.0), (6, 4, "A", at(61), *OK, 2.5), (10, None, "A", at(599), *OK, 0.5), (11, 5, None, None, *OK, 9.0)]]
    got, done = _hourly(spark, tmp_path, batches)
    assert sorted(((r.hour_start, r.outlet_code, r.total_collected, r.total_order) for r in got.collect()), key=str) == sorted([
        (at(0), "A", 16.0, 2), (at(60), "A", 4.5, 2), (at(60), "B", 4.0, 1), (at(120), "A", 3.0, 1), (at(540), "A", 0.5, 0), (at(600), "A", 3.0, 2),
        (None, None, 9.0, 1)], key=str)
    # behind the watermark: the first sale again, and two of an hour long past; without an id or a time: three
    assert hourly.side_rows(spark, str(tmp_path / "out")).count() == 1 + 2 + 3
    assert all(state_figures(q)["dropped"] == 0 for q in done)
    # the state forgets hours behind the watermark
    assert state_figures(done[-1])["rows"] < state_figures(done[1])["rows"] + 4


@pytest.mark.parametrize("seed", [1, 2])
def test_hours_equal_the_batch_answer(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(i if rng.random() < 0.95 else None, i // 2, rng.choice("AAB"), T0 + dt.timedelta(minutes=rng.randrange(40) + 20 * i), *OK, i / 3) for i in range(120)]
    batches = [rows[:40], rows[40:80] + rng.sample(rows[:40], 10), rows[80:] + rng.sample(rows[:80], 15)]
    rng.shuffle(batches)
    got, done = _hourly(spark, tmp_path, batches, "90 minutes")
    want = hourly.hourly_sums(hourly.sale_rows(_sales(spark, [r for part in batches for r in part])))
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert all(state_figures(q)["dropped"] == 0 for q in done)


def test_an_intake_batch_that_runs_again_changes_nothing(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], "at long, of long").write.parquet(f"{folder}/newest/b=-1")
    rows = [(i, i // 2, "A", T0 + dt.timedelta(minutes=90 * i), *OK, float(i)) for i in range(40)]
    apply = hourly.intake_batches(folder, "1 hours")
    for batch_id, part in ((0, rows[:20]), (1, rows[15:]), (1, rows[15:])):
        apply(_sales(spark, part), batch_id)
    assert spark.read.parquet(f"{folder}/rows").groupBy("late").count().orderBy("late").collect() == [("false", 41), ("true", 4)]


def test_dealt_rows_come_in_pieces_in_turn(spark, tmp_path):
    rows = spark.range(900).withColumn("_file", (F.col("id") % 3).cast("int"))
    stream = streams._written(rows, str(tmp_path / "in"), "id")
    seen = []
    finish(stream.writeStream.foreachBatch(lambda batch, _: seen.append({r["id"] % 3 for r in batch.collect()}))
           .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    assert seen == [{0}, {1}, {2}]
    assert all(len(list((tmp_path / "in" / f"_part={i}").glob("*.parquet"))) == streams.PIECES for i in range(3))


def test_lines_find_their_orders_before_their_products(spark):
    lines = spark.createDataFrame([(1, 1, 7, 3, 2.0, 10.0, 0.1, 0.02, "A", "F", T0), (2, 1, 8, 3, 1.0, 5.0, 0.0, 0.0, "N", "O", T0), (2, 1, 8, 3, 1.0, 5.0, 0.0, 0.0, "N", "O", T0)],
                                  "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, "
                                  "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    parts = spark.createDataFrame([(7, "cup", "B1", 9.0, "hot"), (8, "tea", "B2", 4.0, "cold")], "p_partkey long, p_name string, p_brand string, p_retailprice double, p_type string")
    headers = spark.createDataFrame([(2, 21, T0), (2, 22, T0), (3, 31, T0)], "order_id long, transaction_id long, order_date timestamp_ntz")
    got = streams._lines_of(headers, lines, parts)
    assert [(r.order_id, r.order_detail_id, r.product_name, r.order_date) for r in got.collect()] == [(2, 21, "tea", T0)] * 2
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner, (l_partkey") < plan.index("Join Inner, (l_orderkey")
