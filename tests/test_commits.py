"""Tables in parts, loads and their gates; no job while a plan is built."""

import datetime as dt

import pytest
from oracle import TESTDATA
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillworks.functions.scalars import array_money_sum, money_sum, money_total
from tillworks.operators import dedup, landlord, loads
from tillworks.operators.commission import force_scheme
from tillworks.plans import load_all
from tillworks.sources.tables_on_disk import EMPTY, PART, Tables, by_bucket, by_month, months_between
from tillworks.streaming.upsert import order_tables

DAY = dt.date(2024, 1, 1)


def tables_at(spark, tmp_path, **layouts):
    return Tables(spark, str(tmp_path / "tables"), layouts)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def files_of(tmp_path, name):
    """{part: names of its data files} of a stored table."""
    return {d.name: sorted(f.name for f in d.iterdir() if f.name.startswith("part-")) for d in (tmp_path / "tables" / name).iterdir() if d.is_dir()}


@pytest.fixture
def read_rows(spark):
    """Counts how many times rows of a frame made by it are read."""
    seen = spark.sparkContext.accumulator(0)

    def watched(df):
        def run(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch
        return df.mapInArrow(run, df.schema)

    watched.seen = seen
    return watched


# --- tables in parts

def test_loads_are_whole_or_not_at_all(spark, tmp_path):
    tables = tables_at(spark, tmp_path, a=by_bucket("id", 4), b=by_bucket("id", 4))
    assert not tables.has("a")
    assert tables.load({"a": spark.range(3), "b": spark.range(3)}) == {"a": 3, "b": 3}

    def refuse(written):
        assert written["a"].count() == 5
        raise ValueError("no")

    with pytest.raises(ValueError):
        tables.load({"a": spark.range(5), "b": spark.range(5)}, gates=(refuse,))
    assert tables.read("a").count() == tables.read("b").count() == 3
    tables.load({"a": tables.read("a").unionAll(spark.range(5))})  # reads what it replaces
    assert rows(tables.read("a"), "id") == [(i,) for i in (0, 0, 1, 1, 2, 2, 3, 4)] and tables.read("b").count() == 3
    tables.load({"a": spark.range(0)})
    assert tables.read("a").count() == 0 and tables.read("a").columns == ["id"]


def test_parts_are_replaced_alone(spark, tmp_path):
    tables = tables_at(spark, tmp_path, t=by_bucket("id", 8))
    df = spark.range(100).withColumn("v", F.lit(1))
    tables.load({"t": df})
    before, part = files_of(tmp_path, "t"), df.filter(by_bucket("id", 8) == "3")
    tables.load({"t": part.limit(2).withColumn("v", F.lit(2))}, {"t": ["3"]})
    after = files_of(tmp_path, "t")
    assert {p for p in before if before[p] != after[p]} == {f"{PART}=3", f"{PART}={EMPTY}"}
    left = tables.read("t")
    assert left.filter("v = 2").count() == 2 and left.count() == 100 - part.count() + 2 and tables.read("t", ["3"]).count() == 2
    tables.load({"t": df.limit(0)}, {"t": ["3"]})
    assert tables.read("t", ["3"]).count() == 0 and tables.read("t").count() == 100 - part.count()
    assert "PartitionFilters: [" in tables.read("t", ["3"])._jdf.queryExecution().toString()


def test_a_load_that_stopped_is_finished(spark, tmp_path, monkeypatch):
    tables = tables_at(spark, tmp_path, t=by_bucket("id", 4))
    tables.load({"t": spark.range(10)})
    with monkeypatch.context() as m:  # stops behind its pointer
        m.setattr(Tables, "finish", lambda self: None)
        tables.load({"t": spark.range(20, 25)}, {"t": ["0", "1", "2", "3"]})
        assert spark.read.parquet(str(tmp_path / "tables" / "t")).count() == 10
    assert rows(tables.read("t"), "id") == [(i,) for i in range(20, 25)]
    assert not (tmp_path / "tables" / "pointer.json").exists() and not (tmp_path / "tables" / "_staged").exists()


def test_a_load_reads_its_input_once(spark, tmp_path, read_rows):
    orders = read_rows(spark.range(50).withColumnRenamed("id", "order_id"))
    tables = tables_at(spark, tmp_path, t=by_bucket("order_id", 4))
    loads.load_joined(tables, "t", orders, lambda r: r.withColumn("flag", F.lit(True)))
    assert read_rows.seen.value == 50
    stream = order_tables(spark, str(tmp_path / "orders"), 4)
    headers = read_rows(spark.range(30).select(F.col("id").alias("order_id"), F.col("id").alias("transaction_id")))
    assert loads.load_new_orders(stream, headers, spark.range(5).withColumnRenamed("id", "order_id")) == {
        "headers_inserted": 30, "details_inserted": 5, "headers_known": 0}
    assert read_rows.seen.value == 80
    more = spark.range(20, 40).select(F.col("id").alias("order_id"), F.col("id").alias("transaction_id"))
    assert loads.load_new_orders(stream, more, spark.range(25, 35).withColumnRenamed("id", "order_id")) == {
        "headers_inserted": 10, "details_inserted": 5, "headers_known": 10}
    assert stream.read("headers").count() == 40 and stream.read("details").count() == 10


def test_a_load_of_known_orders_rewrites_nothing(spark, tmp_path):
    store = order_tables(spark, str(tmp_path / "tables"), 4)
    headers = spark.range(30).select(F.col("id").alias("order_id"), F.col("id").alias("transaction_id"))
    details = spark.range(40).select((F.col("id") % 30).alias("order_id"))
    loads.load_new_orders(store, headers, details)
    before = files_of(tmp_path, "headers"), files_of(tmp_path, "details")
    assert loads.load_new_orders(store, headers, details) == {"headers_inserted": 0, "details_inserted": 0, "headers_known": 30}
    assert (files_of(tmp_path, "headers"), files_of(tmp_path, "details")) == before
    one = spark.range(30, 31).select(F.col("id").alias("order_id"), F.col("id").alias("transaction_id"))
    assert loads.load_new_orders(store, headers.unionAll(one), details) == {"headers_inserted": 1, "details_inserted": 0, "headers_known": 30}
    part = f"{PART}=" + one.select(by_bucket("order_id", 4)).first()[0]
    after = files_of(tmp_path, "headers"), files_of(tmp_path, "details")
    assert {p for p in after[0] if after[0][p] != before[0].get(p)} <= {part, f"{PART}={EMPTY}"} and after[1] == before[1]
    assert store.read("headers").count() == 31 and store.read("details").count() == 40


def test_a_window_load_rewrites_its_months(spark, tmp_path):
    tables = tables_at(spark, tmp_path, t=by_month("d"))
    days = spark.range(366).select(F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias("d"), F.lit(1).alias("v"))
    tables.load({"t": days.unionAll(spark.createDataFrame([(None, 7)], "d date, v int"))})
    before = files_of(tmp_path, "t")
    loads.load_window(tables, "t", days.filter("d BETWEEN DATE'2024-02-20' AND DATE'2024-03-05'").withColumn("v", F.lit(2)), "d", "2024-02-20", "2024-03-05")
    after = files_of(tmp_path, "t")
    assert {p for p in before if before[p] != after[p]} == {f"{PART}=2024-02", f"{PART}=2024-03", f"{PART}={EMPTY}"}
    assert rows(tables.read("t").groupBy("v").count(), "v", "count") == [(1, 351), (2, 15), (7, 1)]
    with pytest.raises(ValueError, match="outside"):
        loads.load_window(tables, "t", days.limit(3), "d", "2024-02-20", "2024-03-05")
    assert months_between("2023-11-30", "2024-02-01") == ["2023-11", "2023-12", "2024-01", "2024-02"]


def test_scans_list_only_the_months_they_need(spark, tmp_path):
    tables = tables_at(spark, tmp_path, t=by_month("d"))
    days = spark.range(731).select(F.col("id").alias("k"), F.date_add(F.lit(dt.date(2023, 1, 1)), F.col("id").cast("int")).alias("d"))
    tables.load({"t": days})
    got = tables.window("t", "d", "2023-12-31", "2024-01-02", 1, 0)
    assert rows(got, "d") == [(dt.date(2023, 12, 30) + dt.timedelta(i),) for i in range(4)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [{PART}#" in plan and f"IN (2023-12,2024-01,{EMPTY})" in plan
    spark.createDataFrame([(395, dt.datetime(2024, 1, 30), "x"), (396, dt.datetime(2024, 2, 2), "x"), (9, dt.datetime(2023, 1, 10), "y")],
                          "k long, at timestamp_ntz, kind string").write.parquet(str(tmp_path / "keys"))
    keys = spark.read.parquet(str(tmp_path / "keys")).where("kind = 'x'")
    found = tables.of_keys("t", keys, "k", "at", 2)
    assert rows(found, "k") == [(395,), (396,)]
    found.collect()
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()


def test_dates_and_batches_are_replaced_in_their_months(spark, tmp_path):
    tables = tables_at(spark, tmp_path, t=by_month("d"))
    at = lambda m, day: dt.date(2024, m, day)
    tables.load({"t": spark.createDataFrame([(at(1, 1), "a", 1), (at(1, 2), "a", 1), (at(2, 1), "a", 1), (at(2, 1), "b", 1)], "d date, batch string, v int")})
    before = files_of(tmp_path, "t")
    new = spark.createDataFrame([(at(2, 1), "a", 2)], "d date, batch string, v int")
    loads.load_batch(tables, "t", new, "d", "batch", "a")
    assert rows(tables.read("t").where("d = DATE'2024-02-01'"), "batch", "v") == [("a", 2), ("b", 1)]
    loads.load_dates(tables, "t", new, "d")
    assert rows(tables.read("t"), "d", "batch", "v") == [(at(1, 1), "a", 1), (at(1, 2), "a", 1), (at(2, 1), "a", 2)]
    loads.load_dates(tables, "t", new.limit(0), "d")
    assert tables.read("t").count() == 3 and files_of(tmp_path, "t")[f"{PART}=2024-01"] == before[f"{PART}=2024-01"]


# --- gates: the target is untouched

def test_empty_window_is_refused(spark, tmp_path):
    store = tables_at(spark, tmp_path, t=by_month("d"))
    t = spark.createDataFrame([(DAY, "A", 1), (DAY, "B", 2)], "d date, owner string, v int")
    loads.load_table(store, "t", t)
    owned = F.col("owner") == "A"
    with pytest.raises(RuntimeError):
        loads.load_window(store, "t", t.limit(0), "d", "2024-01-01", "2024-01-02", owned)
    assert store.read("t").count() == 2
    loads.load_window(store, "t", t.limit(0), "d", "2024-02-01", "2024-02-02", owned)
    assert rows(store.read("t"), "v") == [(1,), (2,)]
    with pytest.raises(ValueError):
        loads.load_window(store, "t", t, "d", "2024-01-02", "2024-01-01")
    with pytest.raises(ValueError, match="no columns"):
        loads.load_window(store, "t", t.withColumn("w", F.lit(1)), "d", "2024-01-01", "2024-01-02")


def test_doubled_orders_and_details_are_refused(spark, tmp_path):
    store = order_tables(spark, str(tmp_path / "tables"), 4)
    h = spark.createDataFrame([(1, 1), (1, 1)], "order_id long, transaction_id long")
    key = [c for c in __import__("tillworks.fixed_values", fromlist=["x"]).DETAIL_KEY]
    d = spark.createDataFrame([(1, 7)], "order_id long, order_detail_id long").select(
        *[F.col(c) if c in ("order_id", "order_detail_id") else F.lit("comboset" if c == "type" else "x").alias(c) for c in key])
    with pytest.raises(ValueError, match="orders loaded twice"):
        loads.load_new_orders(store, h, d)
    parts = spark.createDataFrame([(7, 2)], "order_detail_id long, n_components long")
    with pytest.raises(ValueError, match="details loaded twice"):
        loads.load_new_orders(store, h.distinct(), d, parts)
    assert not store.has("headers")
    loads.load_new_orders(store, h.distinct(), d.unionAll(d), parts)
    assert store.read("details").count() == 2


def test_row_counts_and_totals_are_gates(spark, tmp_path):
    store = tables_at(spark, tmp_path, t=by_bucket("id", 4), order_income=by_bucket("order_id", 4))
    with pytest.raises(ValueError, match="row count"):
        loads.load_joined(store, "t", spark.range(3), lambda r: r.unionAll(spark.range(3)))
    income = spark.createDataFrame([(1, 1)], "order_id long, transaction_id long")
    with pytest.raises(ValueError, match="totals differ"):
        loads.load_order_income(store, income, spark.createDataFrame([("x",)], "side string"))
    with pytest.raises(ValueError, match="orders loaded twice"):
        loads.load_order_income(store, income.unionAll(income), income.limit(0))
    assert not store.has("t") and not store.has("order_income")
    assert loads.load_joined(store, "t", spark.range(3), lambda r: r) == {"t": 3}


def _payload(spark, *numbers):
    data = [("A", n, DAY, "Cash", 1.0, 0.1, 0.9, "r") for n in numbers]
    return spark.createDataFrame(data, "jilid string, transaction_number string, transaction_date date, payment_type string, total_sales double, "
                                       "total_tax double, amount double, remarks string")


def test_send_log_gates(spark, tmp_path):
    store = tables_at(spark, tmp_path, send_log=by_month("transaction_date"))
    with pytest.raises(ValueError, match="doubled or too long"):
        loads.load_pending(store, _payload(spark, "A_1_090000", "A_1_090000"), "2024-01-01 09:00:00")
    with pytest.raises(ValueError, match="doubled or too long"):
        loads.load_pending(store, _payload(spark, "A" * 60), "2024-01-01 09:00:00")
    loads.load_pending(store, _payload(spark, "A_1_090000", "A_2_090000"), "2024-01-01 09:00:00")
    result = lambda *n: spark.createDataFrame([("A", x, "success", "M", None) for x in n],
                                              "jilid string, transaction_number string, status string, mall_transaction_id string, error_message string")
    for wrong in (result("A_9_090000"), result("A_1_090000", "A_1_090000")):
        with pytest.raises(ValueError, match="pending row"):
            loads.load_results(store, wrong)
    loads.load_results(store, result("A_1_090000"))
    assert rows(store.read("send_log"), "transaction_number", "status") == [("A_1_090000", "success"), ("A_2_090000", "pending")]
    with pytest.raises(ValueError, match="pending row"):
        loads.load_results(store, result("A_1_090000"))
    loads.load_table(store, "send_log", store.read("send_log").withColumn("transaction_number", F.lit("OLD")).withColumn("status", F.lit("success")))
    with pytest.raises(ValueError, match="old format"):
        loads.load_pending(store, _payload(spark, "A_3_090000"), "2024-01-02 09:00:00")


def test_duplicate_answer_with_any_white_space_is_accepted(spark):
    log = spark.createDataFrame([("A", "A_1_090000", "error", "duplicate\n")], "jilid string, transaction_number string, status string, error_message string")
    assert landlord.log_keys(log).first()["accepted"]


def test_commission_week_rules(spark, tmp_path):
    store = tables_at(spark, tmp_path, weekly=by_month("start_date"), daily=by_month("transaction_date"), products=by_month("transaction_date"))
    days = spark.createDataFrame([(1, dt.date(2024, 1, 1) + dt.timedelta(days=i), 1) for i in range(7)], "rider_id int, transaction_date date, qty int")
    weeks = spark.createDataFrame([(1, dt.date(2024, 1, 1), dt.date(2024, 1, 7), 7)], "rider_id int, start_date date, end_date date, qty int")
    new = days.filter("transaction_date <= DATE'2024-01-05'").withColumn("qty", F.lit(5))
    store.load({"weekly": weeks, "daily": days, "products": days})
    for bad in (("2024-01-02", "2024-01-08", "2024-01-05"), ("2024-01-01", "2024-01-07", "2024-01-08"), ("2024-01-01", "2024-01-08", "2024-01-05")):
        with pytest.raises(ValueError):
            loads.load_commission(store, weeks, new, new, *bad)
    loads.load_commission(store, weeks, new, new, "2024-01-01", "2024-01-07", "2024-01-05")
    assert [q for _, q in rows(store.read("daily"), "transaction_date", "qty")] == [5, 5, 5, 5, 5, 1, 1] and store.read("weekly").count() == 1


def test_unknown_types_stop_the_cleaning(spark):
    d = spark.createDataFrame([("standard",), ("mystery",)], "type string")
    with pytest.raises(PySparkException, match="mystery"):
        dedup.checked_types(d).collect()
    assert dedup.checked_types(d.filter("type = 'standard'")).count() == 1


def test_forced_scheme_needs_schemes(spark):
    s = spark.createDataFrame([("r", "9", "x")], "rider_id string, commission_scheme_id string, commission_type string")
    schemes, tiers = spark.createDataFrame([("2", "b"), ("1", "a")], "id string, type string"), spark.createDataFrame([(5, "4"), (3, "7")], "id int, commission_scheme_id string")
    assert [tuple(r) for r in force_scheme(s, schemes, tiers).collect()] == [("r", "7", "a")]
    with pytest.raises(PySparkException, match="no commission scheme"):
        force_scheme(s, schemes, tiers.limit(0)).collect()


# --- exact money

@pytest.mark.parametrize("values, total", [
    ([1e13, 2e13, 1.0], 30000000000001.0), ([4e-7] * 1000, 4e-4), ([0.1] * 10, 1.0), ([-0.5, 0.25, None], -0.25), ([-1e13, 1e13, 1e-6], 1e-6),
    ([9e15, 0.5], 9000000000000000.5), ([-0.0000015, 0.0000015], 0.0), ([5e17, 5e17, 5e17], 1.5e18), ([], None), ([None], None)])
def test_money_sums_are_exact(spark, values, total):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    total = total if total is None else pytest.approx(total, rel=1e-15 if abs(total) >= 1e-3 else 1e-12, abs=1e-18)
    assert df.agg(money_sum("v")).first()[0] == total and df.agg(money_total("v")).first()[0] == (0.0 if total is None else total)
    folded = spark.createDataFrame([([(v,) for v in values],)], "a array<struct<v:double>>")
    assert folded.select(array_money_sum("a", lambda x: x["v"])).first()[0] == (0.0 if total is None else total)


@pytest.mark.parametrize("value", [float("nan"), float("inf"), -float("inf"), 1e19])
def test_amounts_without_an_exact_sum_raise(spark, value):
    df = spark.createDataFrame([(value,), (1.0,)], "v double")
    with pytest.raises(PySparkException, match="outside the range"):
        df.agg(money_sum("v")).collect()


# --- plans

def test_building_a_plan_runs_nothing(spark, monkeypatch):
    """No action in the queries that join small tables, scheme values or key lists."""
    sf = f"{TESTDATA}/sf0.001"
    names = ["commission_weekly", "commission_weekly_forced", "orders_to_tables", "tier_range_join", "scan_by_keys", "replace_window", "dedup_details"]
    queries = {n: load_all()[0][n] for n in names}
    ran = []
    for name in ("collect", "count", "first", "head", "take", "isEmpty", "toPandas", "toLocalIterator"):
        monkeypatch.setattr(type(spark.range(1)), name, lambda self, *a, n=name, **k: ran.append(n))
    for name, q in queries.items():
        q(spark, sf)
        assert not ran, (name, ran)


# --- upsert: only what changes is rewritten

def _versions(spark, orders):
    """(headers, details) of orders, given as {order: (day, amounts of its details)}."""
    at = lambda day: dt.datetime(2024, 1, day)
    headers = spark.createDataFrame([(k, k, at(day)) for k, (day, _) in orders.items()], "order_id long, transaction_id long, order_date timestamp_ntz")
    details = spark.createDataFrame([(k, x, at(day)) for k, (day, amounts) in orders.items() for x in amounts],
                                    "order_id long, amount double, order_date timestamp_ntz")
    return headers, details


@pytest.mark.parametrize("spread", [True, False])
def test_an_upsert_rewrites_the_buckets_of_changed_orders_only(spark, tmp_path, spread):
    store, cutoff = order_tables(spark, str(tmp_path / "tables"), 4), "2024-01-02 00:00:00"
    orders = {k: (1 if k < 3 else 5, [1.0, 1.0, 2.0]) for k in range(40)}
    loads.load_upsert(store, *_versions(spark, orders))
    before = files_of(tmp_path, "headers"), files_of(tmp_path, "details")
    assert loads.load_upsert(store, *_versions(spark, orders), cutoff, spread=spread) == {"headers": 0, "details": 0}
    held = orders | {7: (5, [9.0])}  # shrank
    assert loads.load_upsert(store, *_versions(spark, held), cutoff, spread=spread) == {"headers": 0, "details": 0}
    assert (files_of(tmp_path, "headers"), files_of(tmp_path, "details")) == before
    orders |= {20: (5, [1.0, 2.0, 2.0])}  # the same values, in other numbers
    loads.load_upsert(store, *_versions(spark, orders), cutoff, spread=spread)
    part = f"{PART}=" + spark.range(20, 21).select(by_bucket("id", 4)).first()[0]
    after = files_of(tmp_path, "headers"), files_of(tmp_path, "details")
    for old, new in zip(before, after):
        assert {p for p in old if old[p] != new[p]} - {f"{PART}={EMPTY}"} == {part}
    expected = sorted((k, x) for k, (_, amounts) in orders.items() for x in amounts)
    assert rows(store.read("details"), "order_id", "amount") == expected and store.read("headers").count() == 40
    with pytest.raises(ValueError, match="orders loaded twice"):
        headers, details = _versions(spark, orders)
        loads.load_upsert(store, headers.unionAll(headers), details, cutoff, staged=True)


@pytest.mark.parametrize("few", [True, False])
def test_many_decisions_are_not_broadcast(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(loads, "FEW_ORDERS", 40 if few else 39, raising=False)
    plans, upsert = [], loads.sinks.upsert_hold_shrink

    def seen(*args, **named):
        out = upsert(*args, **named)
        plans.extend(x._jdf.queryExecution().executedPlan().toString() for x in (out.headers, out.details))
        return out

    monkeypatch.setattr(loads.sinks, "upsert_hold_shrink", seen)
    store = order_tables(spark, str(tmp_path / "tables"), 4)
    loads.load_upsert(store, *_versions(spark, {k: (5, [1.0]) for k in range(20)}))
    loads.load_upsert(store, *_versions(spark, {k: (5, [2.0, 3.0]) for k in range(40)}))
    assert len(plans) == 2 and all(("BroadcastHashJoin" in p) == few for p in plans)
    assert rows(store.read("details"), "order_id", "amount") == sorted((k, x) for k in range(40) for x in (2.0, 3.0))


def test_a_first_upsert_of_doubled_orders_leaves_no_tables(spark, tmp_path):
    store, (headers, details) = order_tables(spark, str(tmp_path / "tables"), 4), _versions(spark, {1: (1, [1.0])})
    with pytest.raises(ValueError, match="orders loaded twice"):
        loads.load_upsert(store, headers.unionAll(headers), details)
    assert not store.has("headers") and not store.has("details")
