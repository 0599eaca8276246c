"""Literal rows for semantics that a naive translation gets wrong."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks import fixed_values as fv
from tillworks.functions import scalars as sc
from tillworks.operators import commission, dedup, documents, income, landlord, orders, outlets, riders, sinks, summaries
from tillworks.sources.tables import ORDER_DOCUMENT, check_window, order_documents, window_scan, write_reports


def value(spark, column, **row):
    fields = ", ".join(f"{k} {t}" for k, (t, _) in row.items()) or "x int"
    values = [tuple(v for _, v in row.values()) or (1,)]
    return spark.createDataFrame(values, fields).select(column.alias("v")).first().v


# --- scalars --------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("text,expected", [("12", "00012"), ("123456", "123456"), ("-7", "-0007"), (None, None), ("", "00000")])
def test_zero_pad_never_truncates(spark, text, expected):
    assert value(spark, sc.zero_pad("c"), c=("string", text)) == expected


@pytest.mark.parametrize("text,expected", [("12.0", "12"), ("007", "7"), ("12.75", "12"), (" x1 ", "x1"), (None, "NaN"), (".", "."), (".5", "0"), ("-3", "-3")])
def test_canonical_id(spark, text, expected):
    assert value(spark, sc.canonical_id("c"), c=("string", text)) == expected


@pytest.mark.parametrize("text,expected", [("Go Food", "Go_Food"), ("(a)-b", "a_-b"), ("  ", "UNKNOWN"), ("é x", "é_x"), ("__a__", "a")])
def test_identifier(spark, text, expected):
    assert value(spark, sc.identifier("c"), c=("string", text)) == expected


@pytest.mark.parametrize("text,expected", [(" None\t", None), ("null", None), ("", None), (" ok ", "ok"), (None, None)])
def test_null_like(spark, text, expected):
    assert value(spark, sc.null_like("c"), c=("string", text)) == expected


def _week7(day: dt.date) -> int:
    """Week counted from the year's first Monday, continuing the old year before it."""
    monday = day - dt.timedelta(days=day.weekday())
    first = dt.date(monday.year, 1, 1)
    first += dt.timedelta(days=(7 - first.weekday()) % 7)
    return (monday - first).days // 7 + 1


def test_week_from_monday_is_not_the_iso_week(spark):
    days = [dt.date(2019, 12, 25) + dt.timedelta(days=i) for i in range(2600)]
    rows = spark.createDataFrame([(d,) for d in days], "d date").select("d", sc.week_from_monday("d").alias("w"), sc.iso_week("d").alias("i")).collect()
    assert all(r.w == _week7(r.d) for r in rows)
    assert all(r.i == r.d.isocalendar().week for r in rows)
    assert any(r.w != r.i for r in rows)


def test_exact_sum_does_not_depend_on_order_and_takes_negatives(spark):
    values = [0.1, -0.3, 123456789.123456, -0.000001, 1e9, 2.5, None]
    for rows in (values, values[::-1]):
        df = spark.createDataFrame([(v,) for v in rows], "v double")
        assert df.agg(sc.money_sum("v").alias("s")).first().s == 1123456791.423455
    empty = spark.createDataFrame([(None,)], "v double").agg(sc.money_sum("v").alias("s"), sc.money_total("v").alias("z")).first()
    assert empty.s is None and empty.z == 0.0


def test_micros_round_trip(spark):
    ts = dt.datetime(1969, 12, 31, 23, 59, 59, 123456)
    df = spark.createDataFrame([(ts,), (dt.datetime(2024, 2, 29, 1, 2, 3, 4),)], "t timestamp_ntz")
    for r in df.select("t", sc.from_micros(sc.micros("t")).alias("b"), sc.from_instant(sc.as_instant("t")).alias("i")).collect():
        assert r.t == r.b == r.i


def test_haversine_null_and_known_distance(spark):
    assert value(spark, sc.haversine("a", "b", "c", "d"), a=("double", 0.0), b=("double", 0.0), c=("double", 0.0), d=("double", 1.0)) == 111194.93
    assert value(spark, sc.haversine("a", "b", "c", "d"), a=("double", None), b=("double", 0.0), c=("double", 0.0), d=("double", 1.0)) is None


def test_np_round_is_half_even_on_the_scaled_value(spark):
    assert value(spark, sc.np_round("v", 2), v=("double", 0.125)) == 0.12
    assert value(spark, sc.np_round("v", 2), v=("double", 0.375)) == 0.38


# --- outlets and filters --------------------------------------------------------------------------------------------

def test_effective_date_with_null_old_value_stays_null(spark):
    dim = spark.createDataFrame(
        [("00001", "A", "R", "P", "K", "OWN", "Brand", dt.date(2020, 1, 2), None, None), ("00002", None, None, "P", "K", None, "Brand", None, "OLD", "OB")],
        "jilid string, outlet_name string, region string, provinsi string, kota string, ownership_model string, outlet_brand string, "
        "start_date date, old_ownership_model string, old_outlet_brand string")
    rows = spark.createDataFrame([("00001", dt.date(2020, 1, 1)), ("00001", dt.date(2020, 1, 2)), ("00002", dt.date(2020, 1, 1)), ("00009", dt.date(2020, 1, 1))],
                                 "outlet_code string, day date")
    out = {(r.outlet_code, r.day.day): r for r in outlets.with_outlet(rows, dim, "day").collect()}
    assert out["00001", 1].ownership_model is None
    assert out["00001", 2].ownership_model == "OWN"
    assert out["00002", 1].ownership_model == "-" and out["00002", 1].outlet_name == "-"
    assert out["00009", 1].outlet_brand == "-"


def test_app_sales_are_dropped_in_any_case_and_null_too(spark):
    df = spark.createDataFrame([(x,) for x in ["Walk In", fv.APP_CHANNEL.upper(), "x " + fv.APP_CHANNEL.lower(), None]], "sales_type string")
    assert [r.sales_type for r in df.filter(summaries.not_app_sale()).collect()] == ["Walk In"]


def test_free_row_with_null_modifier_is_dropped(spark):
    df = spark.createDataFrame([(None, 0.0), ("", 0.0), ("m", 0.0), ("m", 1.0), (None, 1.0), (None, None)], "product_modifier_id string, base_price double")
    left = {(r.product_modifier_id, r.base_price) for r in orders.drop_zero_modifiers(df).collect()}
    assert left == {("", 0.0), ("m", 1.0), (None, 1.0), (None, None)}


def test_prefix_filter(spark):
    df = spark.createDataFrame([("BLITZ1",), ("HMS2",), ("XHMS",), (None,)], "rider_code string")
    assert {r.rider_code for r in riders.prefix_filter(df).collect()} == {"BLITZ1", "HMS2"}


# --- payments -------------------------------------------------------------------------------------------------------

PAY = "order_id int, transaction_id int, pos int, transactions_type string, transactions_status string, tx_amount double, total_amount double"


def test_split_payment_with_ghost_and_refund(spark):
    df = spark.createDataFrame([
        (1, 11, 0, "sale", "success", 30.0, 100.0), (1, 12, 1, "sale", "success", 0.0, 100.0), (1, 13, 2, "sale", "success", 70.0, 100.0),
        (1, 14, 3, "refund", "success", 100.0, 100.0),
        (2, 21, 0, "sale", "success", 0.0, 0.0), (2, 22, 1, "sale", "success", None, 0.0),
        (3, 31, 0, "sale", "failed", 5.0, 5.0), (3, 32, 1, "sale", "success", 5.0, 5.0),
        (4, 41, 0, "sale", "success", 50.0, 100.0), (4, 42, 1, "sale", "success", 50.0, 100.0)], PAY)
    allocated = {r.transaction_id: r.total_amount for r in orders.allocate_split_payment(df).collect()}
    assert allocated == {11: 30.0, 13: 70.0, 14: 100.0, 21: 0.0, 31: 5.0, 32: 5.0, 41: 50.0, 42: 50.0}
    carriers = {r.transaction_id for r in orders.primary_payment(df).collect()}
    assert carriers == {13, 14, 21, 31, 32, 41}


def test_mixed_order_gets_one_channel(spark):
    h = spark.createDataFrame([(1, "Go Food"), (2, "QPON"), (3, None)], "order_id int, transactions_payment_type_name string")
    d = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b")], "order_id int, product_id string")
    out = {r.order_id: r.sales_type for r in orders.classify_sales_type(h, d, ["a"]).collect()}
    assert out == {1: fv.LISTED_PRODUCT_CHANNEL, 2: "Qpon", 3: fv.WALK_IN}


# --- documents ------------------------------------------------------------------------------------------------------

def _doc(spark, tmp_path, *docs):
    import json

    path = tmp_path / "orders.json"
    path.write_text("\n".join(json.dumps(d) for d in docs))
    return order_documents(spark, str(path))


def _detail(n, kind, **more):
    return {"order_detail_id": f"d{n}", "product_id": f"p{n}", "type": kind, "quantity": 1, "base_price": 10, "total_order_amount": 100.0,
            "product_modifier_id": "", "modifier_product_sku": "", "tax_percentage": 10, **more}


SALE = {"transaction_id": "t1", "transaction_date": "2024-01-01T20:00:00", "type": "sale", "status": "success", "payment_type_name": "QPON", "amount": 110}


def test_three_identical_components_are_all_kept(spark, tmp_path):
    part = {"product_id": "c", "product_name": "C", "product_sku": "s", "variant_name": "v", "quantity": 1}
    docs = _doc(spark, tmp_path, {"order_id": "o1", "outlet_code": "7", "total_amount": 110, "transactions": [SALE],
                                  "order_details": [_detail(1, "comboset", product_combos=[part] * 3, discounts=[{"discount_name": "x", "discount_amount": 33}])]})
    prices = spark.createDataFrame([("c", 5.0)], "product_id string, price double")
    rows = documents.order_details(docs, prices).collect()
    assert len(rows) == 3 and {r.bundling_id for r in rows} == {"p1"} and {r.product_id for r in rows} == {"c"}
    assert sum(r.total_order_amount for r in rows) == pytest.approx(100.0)
    assert sum(r.discount_amount for r in rows) == pytest.approx(30.0)
    assert {r.outlet_code for r in rows} == {"00007"}
    assert rows[0].transaction_date == dt.datetime(2024, 1, 2, 3, 0)


def test_unpriced_component_gives_equal_shares_and_refund_gets_its_own_set(spark, tmp_path):
    parts = [{"product_id": p, "product_name": p, "product_sku": p, "quantity": 1} for p in ("a", "b")]
    refund = {**SALE, "transaction_id": "t2", "type": "refund"}
    docs = _doc(spark, tmp_path, {"order_id": "o1", "outlet_code": "7", "transactions": [SALE, refund], "order_details": [_detail(1, "comboset", product_combos=parts)]})
    prices = spark.createDataFrame([("a", 5.0)], "product_id string, price double")
    rows = documents.order_details(docs, prices).collect()
    assert sorted((r.transactions_type, r.product_id, r.total_order_amount) for r in rows) == [
        ("refund", "a", 50.0), ("refund", "b", 50.0), ("sale", "a", 50.0), ("sale", "b", 50.0)]


def test_discount_base_differs_between_segments(spark, tmp_path):
    docs = _doc(spark, tmp_path, {"order_id": "o1", "outlet_code": "7", "transactions": [SALE], "order_details": [
        _detail(1, "standard", discount_order_amount=11, discounts=[{"discount_name": "a", "discount_amount": 22}, {"discount_name": "a", "discount_amount": 22}])]})
    prices = spark.createDataFrame([], "product_id string, price double")
    assert documents.order_details(docs, prices, "discounts").first().discount_amount == pytest.approx(40.0)
    assert documents.order_details(docs, prices, "order").first().discount_amount == pytest.approx(10.0)
    assert documents.order_details(docs, prices).first().discount_name == "a"


def test_unpaid_order_gives_neither_header_nor_detail(spark, tmp_path):
    docs = _doc(spark, tmp_path, {"order_id": "o1", "outlet_code": "7", "transactions": [], "order_details": [_detail(1, "standard")]},
                {"order_id": "o2", "outlet_code": "7", "order_details": [_detail(2, "standard")]})
    prices = spark.createDataFrame([], "product_id string, price double")
    h, d = documents.orders_to_tables(docs, prices)
    assert h.count() == 0 and d.count() == 0


def test_overlapping_pulls_keep_the_last_version(spark, tmp_path):
    docs = _doc(spark, tmp_path, *[{"order_id": "o1", "outlet_code": "7", "total_amount": a, "transactions": [SALE], "order_details": [_detail(1, "standard")]}
                                   for a in (1.0, 2.0, 2.0)])
    pulled = docs.withColumn("pull", F.monotonically_increasing_id())
    prices = spark.createDataFrame([], "product_id string, price double")
    h, d = documents.orders_to_tables(pulled, prices, sequence="pull")
    assert [r.total_amount for r in h.collect()] == [2.0] and d.count() == 1


def test_promo_texts_keep_their_first_seen_order(spark, tmp_path):
    promos = [{"promotion_id": i, "promotion_name": n, "promotion_type": "T", "promotion_amount": a} for i, n, a in
              (("b", "B", 1), ("a", "A", 2), ("b", "", 3), (None, None, None))]
    docs = _doc(spark, tmp_path, {"order_id": "o1", "order_details": [_detail(1, "standard", promotions=promos)]})
    r = documents.collapse_promos(docs).first()
    assert (r.promotion_id, r.promotion_name, r.promotion_amount, r.discount_name) == ("b, a", "B-A", 6.0, None)


def test_split_allocation_keeps_the_order_total(spark, tmp_path):
    pays = [{**SALE, "transaction_id": f"t{i}", "amount": a} for i, a in enumerate((10, 0, 25, 65))]
    docs = _doc(spark, tmp_path, {"order_id": "o1", "outlet_code": "7", "total_amount": 100, "subtotal": 90, "transactions": pays, "order_details": []})
    rows = documents.order_headers(docs).collect()
    assert len(rows) == 3 and sum(r.total_amount for r in rows) == pytest.approx(100)


# --- de-duplication -------------------------------------------------------------------------------------------------

DETAIL = ("order_id int, order_detail_id int, type string, bundling_id string, product_id string, sku string, status string, "
          "payment_status string, transactions_type string, product_generic_name string, product_name string, n int")


def _row(kind, bundle, product, n=1, order=1, detail=1, sku="s"):
    return (order, detail, kind, bundle, product, sku, None, "paid", "sale", "B", product, n)


def _dedup(spark, rows, slots):
    df = spark.createDataFrame(rows, DETAIL)
    master = spark.createDataFrame(slots, "bundling_id string, bundling_slot_count int")
    work = dedup.dedup_work(df, master, ["n"], F.col("n"))
    return dedup.dedup_details(df, master, ["n"], F.col("n")).collect(), work


def test_sixteen_rows_of_a_four_slot_bundle_become_four(spark):
    rows = [_row("comboset", "b", p) for p in "wxyz"] * 4
    kept, work = _dedup(spark, rows, [("b", 4)])
    assert sorted(r.product_id for r in kept) == ["w", "x", "y", "z"]
    assert work.first().dup_factor == 4


def test_identical_components_survive_a_double_load(spark):
    rows = ([_row("comboset", "b", "x")] * 3 + [_row("comboset", "b", "y")]) * 2
    kept, _ = _dedup(spark, rows, [("b", 4)])
    assert sorted(r.product_id for r in kept) == ["x", "x", "x", "y"]


def test_uncertain_bundles_are_not_cut(spark):
    rows = [_row("comboset", "b", "x")] * 3 + [_row("comboset", "u", "x", order=2)] * 2
    kept, work = _dedup(spark, rows, [("b", 2)])
    assert len(kept) == 5
    assert {r.dup_factor_source for r in work.collect()} == {"slot_mismatch", "not_in_master"}
    assert all(r.needs_manual_check for r in work.collect())


def test_single_items_keep_one_row_and_null_keys_match(spark):
    rows = [_row("standard", "", "x", n=2), _row("standard", "", "x", n=1), _row("standard", "", "y"), (1, 1, "variant", None, None, None, None, None, None, "B", "p", 1)] * 2
    kept, _ = _dedup(spark, rows, [("b", 2)])
    assert sorted((r.product_id or "", r.n) for r in kept) == [("", 1), ("x", 1), ("y", 1)]


@pytest.mark.parametrize("flood", [0, 3, 1000])
def test_small_and_large_groups_are_cleaned_alike(spark, monkeypatch, flood):
    monkeypatch.setattr(dedup, "FLOOD", flood, raising=False)
    rows = ([_row("comboset", "b", p, n) for p, n in (("x", 12), ("x", 12), ("x", 3), ("y", 25))] * 2 + [_row("comboset", None, "x", order=None)] * 3
            + [_row("comboset", "b", "z", n, order=2) for n in (5, 31, 5)] + [_row("standard", "", "y", n, order=3) for n in (14, 2, 14)]
            + [_row(None, "", "y", n, order=3) for n in (4, 2)])
    df, master = spark.createDataFrame(rows, DETAIL), spark.createDataFrame([("b", 4)], "bundling_id string, bundling_slot_count int")
    tens = F.floor(F.col("n") / 10)
    kept = dedup.dedup_details(df, master, ["n"], tens, strict=False)
    assert sorted((r.order_id or 0, r.type or "", r.product_id, r.n) for r in kept.collect()) == sorted(
        [(1, "comboset", "x", 3), (1, "comboset", "x", 3), (1, "comboset", "x", 12), (1, "comboset", "y", 25), *[(0, "comboset", "x", 1)] * 3,
         (2, "comboset", "z", 5), (2, "comboset", "z", 5), (2, "comboset", "z", 31), (3, "standard", "y", 2), (3, "", "y", 2)])
    work = dedup.dedup_work(df, master, ["n"], tens).groupBy("order_id", "type", "dup_factor", "dup_factor_source", "combo_group_rows", "bundling_slot_count",
                                                             "needs_manual_check").agg(F.sum("_copies").cast("int").alias("n"))
    assert {tuple(r) for r in work.collect()} == {
        (1, "comboset", 2, "bundling", 8, 4, False, 8), (None, "comboset", 1, "not_in_master", 3, None, True, 3), (2, "comboset", 1, "slot_mismatch", 3, 4, True, 3),
        (3, "standard", 1, "not_in_master", None, None, False, 3), (3, None, 1, "not_in_master", None, None, None, 2)}
    stats = sorted((r.order_id or 0, r.type or "", r.product_id, r.rows_per_key, r.row_seq_in_key, r.n) for r in dedup.dedup_key_stats(df, ["n"], tens).collect())
    assert stats == sorted((o or 0, kind or "", p, len(ns), i, n) for (o, kind, p), ns in _by_key(rows).items() for i, n in enumerate(sorted(ns)))


def _by_key(rows):
    out = {}
    for r in rows:
        out.setdefault((r[0], r[2], r[4]), []).append(r[-1])
    return out


def test_rows_of_small_groups_are_shuffled_once(spark):
    rows = [_row("comboset" if i % 3 else "standard", "b", f"p{i % 7}", i, order=i % 50) for i in range(400)]
    df, master = spark.createDataFrame(rows, DETAIL), spark.createDataFrame([("b", 4)], "bundling_id string, bundling_slot_count int")
    kept = dedup.dedup_details(df, master, ["n"], F.floor(F.col("n") / 10))
    kept.collect()
    plan = kept._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning(order_id") == 1, plan


def test_unknown_type_and_missing_master_stop_the_job(spark):
    df = spark.createDataFrame([_row("package", "b", "x")], DETAIL)
    master = spark.createDataFrame([("b", 1)], "bundling_id string, bundling_slot_count int")
    with pytest.raises(PySparkException, match="package"):
        dedup.dedup_details(df, master, ["n"], F.col("n")).collect()
    with pytest.raises(ValueError, match="master"):
        dedup.dedup_details(df, None, ["n"], F.col("n"))


def test_gate_reports_violations(spark):
    df = spark.createDataFrame([_row("standard", "", "x")] * 2 + [_row("comboset", "b", "x", detail=2)] * 2, DETAIL)
    parts = spark.createDataFrame([(2, 3)], "order_detail_id int, n_components int")
    bad = dedup.violations_details(df, parts)
    assert {(r.kind, r.n_rows, r.expected) for r in bad.collect()} == {("single", 2, 1), ("bundle", 2, 3)}
    with pytest.raises(ValueError, match="single"):
        dedup.stop_on(bad, "load stopped")


# --- grouping -------------------------------------------------------------------------------------------------------

def test_items_with_a_missing_key_are_left_out(spark):
    h = spark.createDataFrame([(1, "00001", dt.datetime(2024, 1, 1), "paid", "fulfilled", "success", "Walk In")],
                              "order_id int, outlet_code string, transaction_date timestamp_ntz, payment_status string, fulfillment_status string, transactions_status string, sales_type string")
    d = spark.createDataFrame([(1, "s", "A", 1.0), (1, None, "B", 1.0), (1, "s", "A", None)], "order_id int, sku string, product_name string, quantity double")
    for c in ("total_order_amount", "discount_amount", "promotion_amount", "subtotal", "tax_amount", "total_amount"):
        d = d.withColumn(c, F.lit(1.0))
    dim = spark.createDataFrame([], "jilid string, outlet_name string, region string, provinsi string, kota string, ownership_model string, outlet_brand string, "
                                    "start_date date, old_ownership_model string, old_outlet_brand string")
    out = summaries.daily_items(h, d, dim, filter_details=False).collect()
    assert [(r.item_name, r.total_quantity, r.total_collected, r.ownership_model) for r in out] == [("A", 1.0, 2.0, "-")]


# --- income ---------------------------------------------------------------------------------------------------------

def test_payment_labels(spark):
    df = spark.createDataFrame([(x,) for x in (" go FOOD ", None, "Odd One ", "ISELLER pay qris")], "p string")
    out = [r.v for r in df.select(income.normalize_payment_type("p").alias("v")).collect()]
    assert out == ["Go Food", "Unknown", "Odd One", "iSeller QRIS"]


def test_guard_reads_old_and_new_numbers(spark):
    log = spark.createDataFrame([
        ("00570", "00570_R1_Cash_101010", "success", None), ("00570", "00570_R2_Cash_20260101_101010", "error", " duplicate "),
        ("00570", "00570_R3_Cash_101010", "pending", None), ("00570", "00570_R4_Cash_101010", "http_error", "x"),
        ("00570", "Tenant_00570_Cash_20260101_101010", "success", None), ("00570", "00570_R3_Cash_101011", "timeout_error", None)],
        "jilid string, transaction_number string, status string, error_message string")
    pay = spark.createDataFrame([(f"00570_R{i}_Cash",) for i in range(1, 6)], "key string")
    out = {r.key[6:8]: r.action for r in landlord.resend_guard(pay, log).collect()}
    assert out == {"R1": "already", "R2": "already", "R3": "uncertain", "R4": "send", "R5": "send"}
    assert {r.action for r in landlord.resend_guard(pay, log, resend_uncertain=True).collect()} == {"already", "send"}


def test_log_update_hits_pending_rows_only(spark):
    log = spark.createDataFrame([("j", "n1", "pending", None, None), ("j", "n1", "error", None, "old"), ("j", "n2", "pending", None, None)],
                                "jilid string, transaction_number string, status string, mall_transaction_id string, error_message string")
    result = spark.createDataFrame([("j", "n1", "success", "m", None), ("j", "n9", "error", None, "e")],
                                   "jilid string, transaction_number string, status string, mall_transaction_id string, error_message string")
    out = sorted((r.transaction_number, r.status, r.mall_transaction_id) for r in landlord.finalize_log(log, result).collect())
    assert out == [("n1", "error", None), ("n1", "success", "m"), ("n2", "pending", None)]
    assert [r.transaction_number for r in landlord.unmatched_results(log, result).collect()] == ["n9"]


# --- riders and commission ------------------------------------------------------------------------------------------

def test_shift_past_midnight_gives_clock_hours(spark):
    df = spark.createDataFrame([("r", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 15, 30), dt.datetime(2024, 1, 1, 18, 5)), ("x", dt.date(2024, 1, 1), None, dt.datetime(2024, 1, 1))],
                               "rider_code string, date date, checkin timestamp_ntz, checkout timestamp_ntz")
    assert [r.hour_slot for r in riders.shift_hour_slots(df).collect()] == [22, 23, 0, 1]


def test_false_rows_belong_to_the_session_until_the_next_start(spark):
    t = lambda m: dt.datetime(2024, 1, 1, 9, 50) + dt.timedelta(minutes=m)
    rows = [(1, "r", t(0), "false"), (2, "r", t(1), "true"), (3, "r", t(2), "TRUE"), (4, "r", t(20), "false"), (5, "r", t(40), "False"), (6, "r", t(41), "?"),
            (7, "r", t(50), "true")]
    flagged = riders.flag_sessions(spark.createDataFrame(rows, "id int, rider_code string, timestamp timestamp_ntz, is_stationed string"))
    assert [r.session_id for r in flagged.orderBy("id").collect()] == [None] + ["r_S0001"] * 5 + ["r_S0002"]
    a, b = riders.session_summary(flagged).orderBy("session_seq").collect()
    assert (a.session_duration_minutes, a.total_logs, a.total_true_logs, a.total_false_logs) == (39.0, 5, 2, 2)
    assert (b.session_duration_minutes, b.session_last_false) == (0.0, None)


def test_missing_rider_join_keeps_matches_without_an_outlet(spark):
    t = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "rider_code string, rider_name string") \
        .withColumn("transaction_status", F.lit("COMPLETED")).withColumn("ownership_status", F.lit("KBN")).withColumn("transaction_date", F.lit(dt.date(2024, 1, 30)))
    m = spark.createDataFrame([("a", "1", "H"), ("b", None, "H2")], "rider_id string, jilid string, hub_name string")
    out = {(r.rider_code, r.outlet_name) for r in riders.missing_riders(t, m, "2024-01-31", "KBN").collect()}
    assert out == {("b", "H2"), ("c", None)}


def test_tier_edges_belong_to_both_tiers_and_gaps_to_none(spark):
    tiers = spark.createDataFrame([("1", 0.0, 10.0, 1, 1.0, None), ("1", 10.0, 20.0, 2, 2.0, None), ("1", 30.0, 40.0, 3, 3.0, None)],
                                  "commission_scheme_id string, start_range double, end_range double, tier int, commission_in_percentage double, attendance_commission_in_idr double")
    week = spark.createDataFrame([("a", "1", 10.0), ("b", "1", 25.0), ("c", "NaN", 5.0)], "rider_id string, commission_scheme_id string, total_revenue double")
    out = sorted((r.rider_id, r.tier, r.next_start_range) for r in commission.tier_range_join(week, tiers).collect() if r.rider_id == "a")
    assert out == [("a", 1, 10.0), ("a", 2, 30.0)]
    assert [r.tier for r in commission.tier_range_join(week, tiers).filter("rider_id <> 'a'").collect()] == [None, None]


def test_week_gate():
    commission.check_week("2024-01-01", "2024-01-07")
    with pytest.raises(ValueError):
        commission.check_week("2024-01-02", "2024-01-08")


# --- windows and loads ----------------------------------------------------------------------------------------------

def test_window_scan_is_a_plain_range_on_the_column(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 2, 23, 59),), (dt.datetime(2024, 1, 3),)], "ts timestamp_ntz").write.parquet(path)
    df = window_scan(spark.read.parquet(path), "ts", "2024-01-01", "2024-01-02")
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_window_arguments():
    assert check_window("2024-01-01", "2024-01-02") == ("2024-01-01", "2024-01-02")
    for bad in (("", "2024-01-01"), ("2024-01-02", "2024-01-01")):
        with pytest.raises(ValueError):
            check_window(*bad)
    with pytest.raises(ValueError):
        check_window("2024-01-01", "2024-02-20", max_days=31)
    with pytest.raises(ValueError):
        check_window("2024-01-01", "2024-01-05", not_after="2024-01-04")


def test_unknown_ownership_is_not_replaced_and_empty_result_does_not_wipe(spark):
    day = dt.date(2024, 1, 1)
    t = spark.createDataFrame([(day, "A", 1), (day, None, 2), (day, "B", 3), (dt.date(2024, 1, 9), "A", 4)], "d date, owner string, v int")
    owned = F.col("owner") == "A"
    new = spark.createDataFrame([(day, "A", 10)], "d date, owner string, v int")
    once = sinks.replace_window(t, new, "d", "2024-01-01", "2024-01-02", owned)
    assert sorted(r.v for r in once.collect()) == [2, 3, 4, 10]
    twice = sinks.replace_window(once, new, "d", "2024-01-01", "2024-01-02", owned)
    assert sorted(r.v for r in twice.collect()) == [2, 3, 4, 10]
    with pytest.raises(RuntimeError):
        sinks.refuse_empty(t, new.limit(0), "d", "2024-01-01", "2024-01-02", owned)
    sinks.refuse_empty(t, new.limit(0), "d", "2024-01-05", "2024-01-06", owned)


def test_dates_replace_is_idempotent_and_empty_is_a_no_op(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "d string, v int")
    new = spark.createDataFrame([("a", 5)], "d string, v int")
    once = sinks.replace_dates(t, new, "d")
    assert sorted(r.v for r in once.collect()) == [2, 3, 5] == sorted(r.v for r in sinks.replace_dates(once, new, "d").collect())
    assert sinks.replace_dates(t, new.limit(0), "d").count() == 3


def test_upsert_holds_shrunk_orders_and_is_idempotent(spark):
    h = lambda rows: spark.createDataFrame(rows, "order_id int, tx int, order_date timestamp_ntz, v string")
    d = lambda rows: spark.createDataFrame(rows, "order_id int, line int, order_date timestamp_ntz, v string")
    day, old = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 1)
    sh = h([(1, 1, day, "o"), (2, 1, day, "o"), (2, 2, day, "o"), (9, 1, old, "o")])
    sd = d([(1, 1, day, "o"), (1, 2, day, "o"), (9, 1, old, "o")])
    nh = h([(1, 1, day, "n"), (2, 1, day, "n"), (3, 1, day, "n")])
    nd = d([(1, 1, day, "n"), (1, 2, day, "n"), (1, 3, day, "n"), (3, 1, day, "n")])
    r = sinks.upsert_hold_shrink(sh, sd, nh, nd, "2024-01-02 00:00:00")
    assert {x.order_id: x.decision for x in r.decisions.collect()} == {1: "update", 2: "held", 3: "new"}
    expected = [(1, 1, "n"), (2, 1, "o"), (2, 2, "o"), (3, 1, "n")]
    assert sorted((x.order_id, x.tx, x.v) for x in r.headers.collect()) == expected
    assert r.details.count() == 4
    again = sinks.upsert_hold_shrink(r.headers, r.details, nh, nd, "2024-01-02 00:00:00")
    assert sorted((x.order_id, x.tx, x.v) for x in again.headers.collect()) == expected


def test_writers(spark, tmp_path):
    path = str(tmp_path / "t")
    row = lambda *r: spark.createDataFrame(list(r), "d string, v int")
    sinks.overwrite_partitions(row(("a", 1), ("b", 2)), path, "d")
    sinks.overwrite_partitions(row(("a", 3)), path, "d")
    assert sorted((r.d, r.v) for r in spark.read.parquet(path).collect()) == [("a", 3), ("b", 2)]
    assert sinks.write_mirrors(row(("a", 1)), [str(tmp_path / "m1"), str(tmp_path / "m2")]) == 1
    assert spark.read.parquet(str(tmp_path / "m2")).count() == 1
    assert sinks.write_mirrors(row(("a", 1)).limit(0), [str(tmp_path / "m3")]) == 0
    assert write_reports({"full": row(("a", 1)), "empty": row(("a", 1)).limit(0)}, str(tmp_path / "reports")) == ["full"]


def test_order_document_schema_reads_missing_fields_as_null(spark, tmp_path):
    docs = _doc(spark, tmp_path, {"order_id": "o"})
    assert isinstance(ORDER_DOCUMENT, T.StructType) and docs.first().transactions is None
