"""Loads: read the parts of stored tables that change, work out the new ones, pass the gates, put them in place.

Every function returns row counts, observed while the rows were written. A gate that finds something raises, and the stored tables stay as
they were.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillworks.operators import dedup, landlord, sinks
from tillworks.operators.audit import missing_columns
from tillworks.operators.commission import check_week
from tillworks.session import observed
from tillworks.sources.tables import check_window
from tillworks.sources.tables_on_disk import Gate, Tables, months_between

#: Orders up to which the planner may broadcast a load's decisions. It knows them by the size of their files, which pack them to a few bytes
#: each, while a broadcast takes 150 bytes for an order on the driver and on every executor.
FEW_ORDERS = 100_000


def load_table(tables: Tables, name: str, frame: DataFrame, gates: tuple[Gate, ...] = ()) -> dict[str, int]:
    """Replace a whole table."""
    return tables.load({name: frame}, gates=gates)


def load_window(tables: Tables, name: str, new: DataFrame, column: str, start: str, end: str, owned: Column | None = None) -> dict[str, int]:
    """Delete the job's rows of the window and insert the new ones; the table is cut by months of ``column``, and only those of the window
    are read and rewritten. Gates: no column that the table lacks, no row outside the window, and an empty result must not wipe a filled
    window."""
    check_window(start, end)
    parts = months_between(start, end)
    target = tables.read(name, parts)
    if unknown := missing_columns(new, target):
        raise ValueError(f"{name} has no columns {unknown}: nothing was written")
    told = Observation()
    outside = F.count_if(~F.coalesce(sinks.in_window(column, start, end), F.lit(False)))
    staged = tables.stage(new.observe(told, F.count(F.lit(1)).alias("n"), outside.alias("outside")))
    seen = observed(told)
    if seen.get("outside"):
        raise ValueError(f"{seen['outside']} rows lie outside {start}..{end}: nothing was written")
    if not seen.get("n"):
        sinks.refuse_empty(target, staged, column, start, end, owned)
    return tables.load({name: sinks.replace_window(target, staged, column, start, end, owned)}, {name: parts})


def load_dates(tables: Tables, name: str, new: DataFrame, column: str) -> dict[str, int]:
    """Replace exactly the dates that the result holds; only their months are rewritten, and an empty result changes nothing."""
    return _rewritten(tables, name, new, lambda rows, staged: sinks.replace_dates(rows, staged, column))


def load_batch(tables: Tables, name: str, new: DataFrame, column: str, batch: str, label: str) -> dict[str, int]:
    """Replace one batch of the result's dates, other batches of these days stay; only their months are rewritten."""
    return _rewritten(tables, name, new, lambda rows, staged: sinks.replace_batch_log(rows, staged, column, batch, label))


def unique_orders(headers: str = "headers") -> Gate:
    """Gate: (order, transaction) is unique."""
    return lambda written: dedup.stop_on(dedup.duplicate_transactions(written[headers]), "orders loaded twice, nothing was written")


def clean_details(component_counts: DataFrame, details: str = "details") -> Gate:
    """Gate: single items are unique on their key and bundles have a row per component."""
    return lambda written: dedup.stop_on(dedup.violations_details(written[details], component_counts), "details loaded twice, nothing was written")


def load_new_orders(tables: Tables, headers: DataFrame, details: DataFrame, component_counts: DataFrame | None = None) -> dict[str, int]:
    """Append the orders the tables do not know; headers and details go together or not at all. Both tables are cut by buckets of the order
    id; only those that get new rows are rewritten, the rows they hold are copied without a shuffle. Returns what was appended and how many
    headers were known."""
    told = Observation(), Observation(), Observation()
    n = F.count(F.lit(1)).alias("n")
    headers, details = tables.stage(headers.observe(told[0], n)), tables.stage(details)
    unique_orders()({"headers": headers})
    if component_counts is not None:
        clean_details(component_counts)({"details": details})
    if not tables.has("headers"):
        counts = tables.load({"headers": headers, "details": details})
        return {"headers_inserted": counts["headers"], "details_inserted": counts["details"], "headers_known": 0}
    known = tables.read("headers", sorted({*tables.parts(headers, "headers"), *tables.parts(details, "details")}))
    new_headers, new_details = sinks.append_new_orders(known, headers, details)
    new = {"headers": tables.stage(new_headers.observe(told[1], n), "headers"), "details": tables.stage(new_details.observe(told[2], n), "details")}
    own = {name: tables.parts(frame, name) for name, frame in new.items()}
    grown = {name: tables.read(name, own[name]).unionByName(frame) for name, frame in new.items() if own[name]}
    if grown:
        tables.load(grown, own, spread=False)
    given, inserted, lines = (observed(x).get("n", 0) for x in told)
    return {"headers_inserted": inserted, "details_inserted": lines, "headers_known": given - inserted}


def load_upsert(tables: Tables, headers: DataFrame, details: DataFrame, cutoff: str | None = None, staged: bool = False, spread: bool = True) -> dict[str, int]:
    """Put new versions of whole orders in place unless they shrank; the same load again changes nothing. Both tables are cut by the same
    buckets of the order id; only those that the new orders fall into are read, and only those with an order that is not stored row for row
    as it comes in are rewritten. Orders before ``cutoff`` leave a bucket when it is rewritten and are filtered by :func:`stored_orders`
    until then. Returns the rows of the rewritten buckets. ``staged``: the new rows are stored already and are read from there. Without
    ``spread``, rows are written by the tasks that joined them, so a rewritten bucket gets a file of each of these tasks, but no further
    shuffle: for large loads into few buckets."""
    if not tables.has("headers"):
        return tables.load({"headers": headers, "details": details}, gates=(unique_orders(),), spread=spread)
    if not staged:
        headers, details = tables.stage(headers), tables.stage(details)
    unique_orders()({"headers": headers})
    own = sorted({*tables.parts(headers, "headers"), *tables.parts(details, "details")})
    told = Observation()
    states = tables.stage(sinks.upsert_states(tables.read("headers", own), tables.read("details", own), headers, details, cutoff)
                          .observe(told, F.count(F.lit(1)).alias("n")))
    changed = states.filter("changes")
    own = sorted({*tables.parts(changed, "headers"), *tables.parts(changed, "details")})
    if not own:
        return {"headers": 0, "details": 0}
    mine = lambda rows, name: rows.filter(tables.layouts[name].isin(own))
    decisions = states.select("order_id", "decision")
    if observed(told).get("n", 0) > FEW_ORDERS:
        decisions = decisions.hint("merge")
    result = sinks.upsert_hold_shrink(tables.read("headers", own), tables.read("details", own), mine(headers, "headers"), mine(details, "details"),
                                      cutoff, decisions=decisions)
    return tables.load({"headers": result.headers, "details": result.details}, {"headers": own, "details": own}, spread=spread)


def stored_orders(tables: Tables, name: str, cutoff: str | None = None, order_date: str = "order_date") -> DataFrame:
    """A table of :func:`load_upsert` without the orders before ``cutoff``."""
    rows = tables.read(name)
    return rows if cutoff is None else rows.filter(F.coalesce(F.col(order_date) >= F.lit(cutoff).cast("timestamp_ntz"), F.lit(True)))


def _rewritten(tables: Tables, name: str, by: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame]) -> dict[str, int]:
    """Change the parts of a table that the rows of ``by`` fall into; ``change`` gets their rows and ``by``, worked out once."""
    by = tables.stage(by)
    parts = tables.parts(by, name)
    return tables.load({name: change(tables.read(name, parts), by)}, {name: parts})


def load_fulfilled(tables: Tables, done: DataFrame, name: str = "headers") -> dict[str, int]:
    """Set orders fulfilled, with their sales type where one is known; only the buckets of these orders are rewritten."""
    return _rewritten(tables, name, done, sinks.update_fulfilled)


def load_patch(tables: Tables, name: str, patch: DataFrame, keys: list[str], column: str, only: Column | None = None) -> dict[str, int]:
    """Overwrite one column where the patch has the key; only the parts of these keys are rewritten."""
    return _rewritten(tables, name, patch, lambda rows, new: sinks.patch_column(rows, new, keys, column, only))


def load_commission(tables: Tables, weekly: DataFrame, daily: DataFrame, products: DataFrame, start: str, end: str, data_end: str) -> dict[str, int]:
    """The week's rows by (start_date, end_date); daily and product rows only up to ``data_end`` (yesterday), later ones are not touched.
    All three tables change together, each cut by months. Gates: the week runs Monday to Sunday, ``data_end`` lies in it."""
    check_week(start, end)
    check_window(start, data_end, max_days=7, not_after=end)
    out, parts = {}, {"weekly": months_between(start, start), "daily": months_between(start, data_end), "products": months_between(start, data_end)}
    for name, new in (("weekly", weekly), ("daily", daily), ("products", products)):
        if not tables.has(name):
            out[name] = new
            continue
        old = tables.read(name, parts[name])
        if name == "weekly":
            gone = (F.col("start_date") == F.to_date(F.lit(start))) & (F.col("end_date") == F.to_date(F.lit(end)))
        else:
            gone = sinks.in_window("transaction_date", start, data_end)
        out[name] = old.filter(~F.coalesce(gone, F.lit(False))).unionByName(new)
    return tables.load(out, parts)


def load_pending(tables: Tables, payload: DataFrame, created_at: str, name: str = "send_log", legacy: bool = True) -> dict[str, int]:
    """Write the payload to the send log as pending, before anything is sent. The log is cut by months of the day; only those of the
    payload are rewritten. Gates: numbers are unique and short enough, and no day of the payload was accepted in the old number format."""
    payload = tables.stage(payload)
    dedup.stop_on(landlord.payload_violations(payload), "payload numbers doubled or too long, nothing was sent")
    rows = landlord.pending_rows(payload, created_at)
    if not tables.has(name):
        return tables.load({name: rows})
    if legacy:
        dedup.stop_on(landlord.legacy_conflicts(payload, tables.read(name)), "days already sent in the old format")
    parts = tables.parts(rows, name)
    return tables.load({name: tables.read(name, parts).unionByName(rows)}, {name: parts})


def load_results(tables: Tables, result: DataFrame, name: str = "send_log") -> dict[str, int]:
    """Set pending rows of the send log to their final status; only the months with such rows are rewritten. Gate: every result hits
    exactly one pending row and comes once."""
    log, result = tables.read(name), tables.stage(result)
    dedup.stop_on(landlord.unmatched_results(log, result), "results without one pending row each, the log was not changed")
    parts = tables.parts(log.join(result.select("jilid", "transaction_number").distinct(), ["jilid", "transaction_number"], "left_semi"), name)
    return tables.load({name: landlord.finalize_log(tables.read(name, parts), result)}, {name: parts})


def load_order_income(tables: Tables, orders: DataFrame, differences: DataFrame, name: str = "order_income") -> dict[str, int]:
    """Store the income per order. Gates: (order, transaction) is unique, and no day's totals differ from the daily table.
    ``differences``: rows of the comparison that are not alike."""
    dedup.stop_on(differences, "order and daily totals differ, nothing was written")
    return tables.load({name: orders}, gates=(unique_orders(name),))


def load_joined(tables: Tables, name: str, rows: DataFrame, support: Callable[[DataFrame], DataFrame]) -> dict[str, int]:
    """Store rows with what ``support`` joins to them. Gate: as many rows come out as went in; both are counted while the table is staged."""
    before = Observation()
    joined = support(rows.observe(before, F.count(F.lit(1)).alias("n")))
    told = Observation()

    def same_rows(_: Mapping[str, DataFrame]) -> None:
        given, kept = observed(before).get("n", 0), observed(told).get("n", 0)
        if given != kept:
            raise ValueError(f"row count changed from {given} to {kept}: a support frame has duplicate keys")

    return tables.load({name: joined.observe(told, F.count(F.lit(1)).alias("n"))}, gates=(same_rows,))
