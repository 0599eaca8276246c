"""JSON documents with broken lines, key scans, sorted files, labels, and the header cube."""

import datetime as dt
import json
import random

import pytest
from oracle import TESTDATA
from pyspark.sql import functions as F

from tillworks.functions.scalars import as_name, casefold, lookup, money_sum, money_value
from tillworks.functions.skew import among
from tillworks.operators import cube, sinks
from tillworks.operators.documents import one_document_per_order
from tillworks.plans import orders as order_plans
from tillworks.sources import tables
from tillworks.sources.standin import order_documents

T0 = dt.datetime(2024, 1, 1, 8)


# --- JSON documents

LINES = [
    '{"order_id":"1","order_date":"2024-01-01T10:00:00","total_amount":1.5,"transactions":[{"transaction_id":"a","amount":2}]}',
    '{"order_id":"2","order_date":"2024-01-01T10:0', "", "   ", "not json at all", '[{"order_id":"3"}]', '"4"', "null",
    '{"order_id":"5","order_date":"soon"}', '{"order_id":"6","transactions":"none"}', '{"total_amount":1.0}', '{"order_id":null}',
    '{"order_id":"7","drawer":7,"tip":{"a":1}}', '{"order_id":"8","drawer":null,"notes":"Größe ☕"}', '{"order_id":"8"}',
]
REASONS = {"not JSON": 2, "not a document": 3, "wrong type": 2, "no order id": 2}


@pytest.fixture
def lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(LINES[:8]))
    (tmp_path / "in" / "b.json").write_text("\n".join(LINES[8:]) + "\n")
    return tables.document_lines(spark, str(tmp_path / "in"))


def test_broken_lines_cost_one_line_each(lines):
    good = tables.good_documents(lines)
    assert good.schema == tables.ORDER_DOCUMENT
    assert sorted(r["order_id"] for r in good.collect()) == ["1", "7", "8", "8"]
    first = good.where("order_id = '1'").first()
    assert first["order_date"] == dt.datetime(2024, 1, 1, 10) and first["transactions"][0]["amount"] == 2.0 and first["total_amount"] == 1.5
    broken = tables.quarantined(lines).collect()
    assert {r["reason"]: sum(x["reason"] == r["reason"] for x in broken) for r in broken} == REASONS
    assert all(r["value"] in LINES and r["file"].endswith((".json",)) for r in broken)


def test_staged_documents_are_counted_while_they_are_written(lines, tmp_path):
    good, broken, counts = tables.stage_documents(lines, str(tmp_path / "out"))
    assert counts == {"good": 4, **REASONS}
    assert good.schema == tables.ORDER_DOCUMENT and good.count() == 4 and broken.count() == sum(REASONS.values())
    assert sorted(r["value"] for r in broken.collect()) == sorted(r["value"] for r in tables.quarantined(lines).collect())


def test_fields_the_schema_lacks(lines):
    assert sorted(tuple(r) for r in tables.unknown_fields(lines).collect()) == [("drawer", 2), ("tip", 1)]


def test_a_line_is_parsed_once(lines, tmp_path):
    good = tables.good_documents(lines).select("order_id", F.explode("transactions"))
    staged = lines.where("reason IS NULL OR reason = 'not JSON'").select("doc", "reason")
    for plan in (x._jdf.queryExecution().optimizedPlan().toString() for x in (good, staged, tables.quarantined(lines))):
        assert plan.count("from_json(") <= 1 and plan.count("parseJson(") == 1, plan


def test_only_objects_are_documents(spark, tmp_path):
    good = [' \t{"order_id":"1"}', '\r {"order_id":"2"} ', '{ }']
    odd = [' [1]', ' "{"', '\t7', '{', '\ufeff{"order_id":"3"}', '\x0b{"order_id":"4"}', '\u00a0{"order_id":"5"}', '{"order_id":"6","order_id":"6"}']
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_bytes("\n".join(good + odd).encode())
    out = {r["value"]: r["reason"] for r in tables.document_lines(spark, str(tmp_path / "in")).collect()}
    v = F.try_parse_json("value")
    before = F.when(v.isNull(), "not JSON").when(~F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), "not a document")
    expected = {r[0]: r[1] for r in spark.createDataFrame([(x,) for x in out], "value string").select("value", before).collect()}
    assert {k: r if r in ("not JSON", "not a document") else None for k, r in out.items()} == expected
    assert sorted(map(str, out.values())) == ["None", "None", "no order id", *["not JSON"] * 5, *["not a document"] * 3]


def test_no_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n\n")
    good, broken, counts = tables.stage_documents(tables.document_lines(spark, str(tmp_path / "in")), str(tmp_path / "out"))
    assert good.count() == broken.count() == 0 and set(counts.values()) == {0}


def test_documents_go_through_json_unchanged(spark, tmp_path):
    docs = order_documents(spark, f"{TESTDATA}/sf0.001").limit(200)
    docs.select(F.to_json(F.struct(*docs.columns))).write.text(str(tmp_path / "json"))
    text = lambda df: sorted(json.dumps(r.asDict(True), default=str, sort_keys=True) for r in df.collect())
    back = tables.good_documents(tables.document_lines(spark, str(tmp_path / "json")))
    assert text(back.select(*docs.columns)) == text(docs)


# --- documents pulled more than once

def test_the_last_document_of_an_order_stays(spark):
    rows = [("1", T0, "a"), ("1", T0 + dt.timedelta(hours=1), "b"), ("2", T0, "c"), ("3", None, "d"), ("3", T0, "e"), ("4", T0, "f"), ("4", T0, "f"),
            (None, T0, "x"), (None, T0, "x")]
    docs = spark.createDataFrame(rows, "order_id string, closed_date timestamp_ntz, notes string")
    got = one_document_per_order(docs)
    assert got.columns == docs.columns
    assert sorted((r[0] or "", r[2]) for r in got.collect()) == [("", "x"), ("", "x"), ("1", "b"), ("2", "c"), ("3", "e"), ("4", "f")]


def test_documents_pulled_once_are_not_shuffled(spark):
    docs = spark.range(500).select(F.col("id").cast("string").alias("order_id"), F.lit(T0).alias("closed_date"), F.lit("a").alias("notes"))
    plan = one_document_per_order(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and "LeftSemi" not in plan
    again = docs.where("order_id % 50 = 0").withColumn("notes", F.lit("b")).withColumn("closed_date", F.lit(T0 + dt.timedelta(hours=1)))
    got = {r["order_id"]: r["notes"] for r in one_document_per_order(docs.unionAll(again)).collect()}
    assert got == {str(i): "a" if i % 50 else "b" for i in range(500)}


def test_columns_nobody_reads_are_not_shuffled_with_documents(spark):
    rows = [("1", T0, "a", "x"), ("1", T0, "b", None), ("1", None, "c", "y"), ("2", None, None, "z"), ("2", None, "d", None), ("3", T0, "e", "w")]
    docs = spark.createDataFrame(rows, "order_id string, closed_date timestamp_ntz, notes string, customer_id string")
    got = [tuple(r) for r in one_document_per_order(docs).collect()]
    assert sorted(r[0] for r in got) == ["1", "2", "3"] and set(got) <= set(rows) and ("1", None, "c", "y") not in got
    plan = one_document_per_order(docs).select("order_id", "notes")._jdf.queryExecution().optimizedPlan().toString()
    picks = [line for line in plan.splitlines() if "Aggregate" in line and "max_by" in line]
    assert len(picks) == 1 and picks[0].count("max_by") == 1 and "max_by(notes" in picks[0]


@pytest.mark.parametrize("words", [1, 64])
def test_no_key_is_left_out_of_a_key_filter(spark, words):
    keys = spark.range(0, 3000, 7).select(F.col("id").cast("string").alias("k"))
    rows = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    hit = {int(r["k"]) for r in rows.filter(among(keys, "k", words)).collect()}
    assert hit >= set(range(0, 3000, 7)) and (words == 1 or len(hit) < 1500)
    assert rows.filter(among(keys.limit(0), "k", words)).count() == 0


def test_json_lines_are_packed_in_files_of_bounded_length(spark, monkeypatch):
    monkeypatch.setattr(order_plans, "JSON_LINES", 100)
    path = order_plans._json_lines(spark, f"{TESTDATA}/sf0.001")
    files = spark.read.text(path).groupBy(F.col("_metadata.file_name").alias("file")).count().collect()
    assert all(r["file"].endswith(".gz") and r["count"] <= 100 for r in files)


# --- key scans

LARGE = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0", "spark.sql.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def large(spark):
    """Settings under which the small test tables count as large."""
    old = {k: spark.conf.get(k, None) for k in LARGE}
    for k, v in LARGE.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_large_scan_is_filtered_before_its_shuffle(spark, large, tmp_path):
    rows = spark.range(0, 30000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, F.lit(None)).otherwise(F.col("id")).alias("k"),
                                        F.col("id").alias("v"))
    rows.write.parquet(str(tmp_path / "rows"))
    spark.range(0, 3000).select(F.when(F.col("id") == 5, F.lit(None)).otherwise(F.col("id")).alias("k"), (F.col("id") % 10).alias("kind")).write.parquet(
        str(tmp_path / "keys"))
    keys = spark.read.parquet(str(tmp_path / "keys")).where("kind = 7")
    got = tables.scan_by_keys(spark.read.parquet(str(tmp_path / "rows")), keys, "k")
    assert got.count() == rows.where("k % 10 = 7 AND k < 3000").count()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    scan = plan[plan.index("might_contain"):]
    assert "Relation" in scan and "Join" not in scan[:scan.index("Relation")]


# --- sorted files

def test_files_are_in_order(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.randrange(50), i) for i in range(5000)] + [(None, 5000), (None, 5001)]
    df = spark.createDataFrame(rows, "a int, b long")
    sinks.write_sorted(df, str(tmp_path / "t"), "a", "b", files=7)
    files = sorted(sinks.file_ranges(spark, str(tmp_path / "t"), "a").collect())
    assert len(files) == 7 and sum(f["rows"] for f in files) == len(rows)
    assert all(x["greatest"] <= y["least"] for x, y in zip(files, files[1:]))
    back = sorted((r["place"], r["a"], r["b"]) for r in sinks.read_sorted(spark, str(tmp_path / "t")).collect())
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert back == [(i, *r) for i, r in enumerate(want, 1)]


# --- labels

def test_case_folding_is_that_of_programs(spark):
    cherokee = range(0x13A0, 0x1400), range(0xAB70, 0xABC0)  # folded to capitals there, to small letters here; both of one letter alike
    letters = [chr(i) for i in range(1, 0x1F000) if not 0xD800 <= i < 0xE000 and not any(i in r for r in cherokee)]
    texts = [x for x in letters if x.casefold() != x or x.upper() != x] + ["Straße", "ΟΔΟΣ", "İstanbul", "ﬁn", "GoPay ", "", "ẞ"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select("t", casefold("t").alias("f")).collect() if r["f"] != r["t"].casefold()] == []


def test_names_compare_as_in_the_database(spark):
    rows = [("Straße", "STRASSE  ", True), ("cafe", "Café", True), (" a", "a", False), ("a", "b", False), ("i", "İ", True), ("", "  ", True)]
    df = spark.createDataFrame(rows, "a string, b string, same boolean")
    assert df.where((as_name("a") == as_name("b")) != F.col("same")).isEmpty()
    assert df.select(lookup("a", {"STRASSE": "street"}, F.lit("-"), fold=True).alias("x")).first()["x"] == "street"


# --- the cube of headers

HEADER = ("order_id long, outlet_code string, payment_type string, transaction_date timestamp_ntz, payment_status string, fulfillment_status string, "
          "transactions_status string, sales_type string, amount double")


def _headers(spark, rows):
    df = spark.createDataFrame([(*r[:4], "paid", "fulfilled", "success", "Walk In", r[4]) for r in rows], HEADER)
    return df.select("*", *[F.col("amount").alias(c) for c in dict.fromkeys(cube.HEADER_SUMS.values())])


def test_merged_orders_are_the_distinct_ones(spark):
    rng = random.Random(8)
    rows = [(rng.choice([rng.randrange(-200, 5000), 2 ** 62 + rng.randrange(70), None]), "A" if rng.random() < 0.7 else rng.choice(["B", None]),
             rng.choice(["Cash", "GoFood", None]), T0 + dt.timedelta(minutes=rng.randrange(4000)), rng.randrange(10 ** 6) / 7) for _ in range(6000)]
    headers = _headers(spark, rows)
    folded = cube.header_cube(headers)
    day, hour = F.to_date("transaction_date").alias("_day"), F.hour("transaction_date").alias("transaction_hour")
    for keys in (["_day", "outlet_code"], ["_day", "transaction_hour", "outlet_code"], ["_day", "outlet_code", "payment_type"], ["_day"], ["outlet_code"]):
        got = cube.rolled_up(folded, keys).select(*keys, "total_order", money_value("total_collected").alias("total_collected"))
        want = headers.select("*", day, hour).groupBy(*keys).agg(F.countDistinct("order_id").alias("total_order"), money_sum("amount").alias("total_collected"))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_order_ids_that_are_no_numbers_have_no_bitmap(spark):
    with pytest.raises(TypeError, match="whole number"):
        cube.header_cube(_headers(spark, [(1, "A", "Cash", T0, 1.0)]).withColumn("order_id", F.lit("x")))


def test_the_cube_reads_headers_once(spark):
    headers = _headers(spark, [(1, "A", "Cash", T0, 1.0)])
    plan = cube.header_cube(headers)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") == 1
