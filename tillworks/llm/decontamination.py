"""Benchmark decontamination by winnowing.

A fingerprint is the least hash of K consecutive words in every window of W such hashes, so two texts that share K + W - 1 = 13
words share a fingerprint at the same place in the shared words. Documents and items are joined on fingerprints, and each hit is
extended word by word, within the reach of a 13-word window, before it counts: results are exact.

Cases: a null text has no words; an item of fewer than 13 words is one window as long as itself (its fingerprint is all of it), an
item without words never occurs; an empty table of items contaminates nothing; repeated rows of a document get a row each; items
with a null id count as hits, but are not listed. Columns besides the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.llm.text import Texts, filter_bits, in_filter, run_hashes, small_batches, span_hashes, worded
from tillworks.session import cut_lineage

WINDOW = 13
K = 5

PRINT = "struct<h:bigint,p:int,left:array<string>,mid:array<string>,right:array<string>>"
ARROW_PRINTS = pa.list_(pa.struct([("h", pa.int64()), ("p", pa.int32())] + [(c, pa.list_(pa.string())) for c in ("left", "mid", "right")]))


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions of the least hash of each window, the rightmost of equal ones."""
    if len(hashes) < window:
        return np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)[:, ::-1]
    return np.unique(np.arange(len(views)) + window - 1 - views.argmin(axis=1))


def _prints(texts: Texts, i: int, places: np.ndarray, hashes: np.ndarray, n: int, reach: int) -> list[dict]:
    first, last = int(texts.words[i]), int(texts.words[i + 1])
    out = []
    for p, h in zip(places.tolist(), hashes.view(np.int64).tolist()):
        at = first + p
        out.append({"h": h, "p": p,
                    "left": [texts.word_text(j) for j in range(at - 1, max(first, at - reach) - 1, -1)],
                    "mid": [texts.word_text(j) for j in range(at, at + n)],
                    "right": [texts.word_text(j) for j in range(at + n, min(last, at + n + reach))]})
    return out


def fingerprints(texts: Texts, window: int, k: int, short: list[int] | None, table: np.ndarray | None) -> Iterator[list[dict]]:
    """The fingerprints of each text. ``short``: lengths below ``window`` at which every run is one; None: only a whole text that is
    that short. ``table``: keep those that the filter may hold."""
    all_words = span_hashes(texts.data, texts.starts, texts.ends)
    for i in range(len(texts)):
        words = all_words[texts.words[i]:texts.words[i + 1]]
        n, found = len(words), []
        wanted = [(window, k)] if n >= window else []
        wanted += [(m, m) for m in ([n] if 0 < n < window else []) if short is None]
        wanted += [(m, m) for m in short or [] if m <= n]
        for size, grams in wanted:
            hashes = run_hashes(words, grams)
            places = winnow(hashes, size - grams + 1)
            own = hashes[places] ^ np.uint64(size)  # runs of different kinds never meet
            if table is not None:
                keep = in_filter(table, own)
                places, own = places[keep], own[keep]
            if len(places):
                found += _prints(texts, i, places, own, grams, size - grams)
        yield found


def _mapper(window: int, k: int, short, table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None if table is None else table.value
        for batch in batches:
            counts, prints = [], []
            for texts in worded(batch.column(1)):
                counts += np.diff(texts.words).tolist()
                prints += list(fingerprints(texts, window, k, short, held))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(prints, ARROW_PRINTS)],
                                             names=["id", "n_words", "prints"])
    return run


def _same(a: Column, b: Column) -> Column:
    """How many leading words are equal."""
    equal = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    at = F.array_position(equal, F.lit(False))
    return F.when(at == 0, F.size(equal)).otherwise(at.cast("int") - 1)


def covered(spans: Column) -> Column:
    """Words below a sorted array of (s, e)."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(F.sort_array(spans), start, lambda a, x: F.struct(
        (a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], a["end"]))).alias("n"),
        F.greatest(a["end"], x["e"]).alias("end")))["n"]


def benchmark_hits(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                   item_text: str = "text", window: int = WINDOW, k: int = K) -> DataFrame:
    """One row per document row: id, text_key, n_words, spans (word ranges that occur in items), n_hit, items (sorted ids as text).

    Documents are read once. Only fingerprints that pass a filter of fixed size, built of the items' fingerprints, are shuffled;
    what else passes it falls out in the join. ``text_key`` tells documents of the same id apart.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = items.schema[item_id].dataType.simpleString()
    short = items.select(F.col(item_id).alias("id"), F.col(item_text).alias("text"))
    item_prints = cut_lineage(short.mapInArrow(_mapper(window, k, None, None), f"id {kind}, n_words bigint, prints array<{PRINT}>"))
    lengths = sorted(r[0] for r in item_prints.where((F.col("n_words") > 0) & (F.col("n_words") < window)).select("n_words").distinct().collect())
    size = F.least(F.col("n_words"), F.lit(window)).alias("size")
    bench = item_prints.select(F.col("id").cast("string").alias("item"), size, F.explode("prints").alias("b"))
    # items that share a passage and its surroundings are one row with the set of their ids, and a set is known by a digest
    bench = bench.groupBy("size", *[F.col(f"b.{c}").alias(c) for c in ("h", "left", "mid", "right")]).agg(F.sort_array(F.collect_set("item")).alias("items"))
    bench = cut_lineage(bench.withColumn("items_key", F.sha2(F.to_json("items"), 256)))
    sets = bench.select("items_key", "items").dropDuplicates(["items_key"])
    bench = bench.select("size", F.struct("h", "left", "mid", "right").alias("b"), "items_key")
    table = spark.sparkContext.broadcast(filter_bits(bench.select(F.col("b.h").alias("h")), "h"))

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.struct(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("k")).alias("id"), F.col(text).alias("text"))
    rows = rows.mapInArrow(_mapper(window, k, lengths, table), f"id struct<id:{kind},k:bigint>, n_words bigint, prints array<{PRINT}>")
    rows = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()))

    found = rows.select("row", F.explode("prints").alias("d"))
    left, right = _same(F.col("d.left"), F.col("b.left")), _same(F.col("d.right"), F.col("b.right"))
    spans = (found.join(bench, F.col("d.h") == F.col("b.h"))
             .where(F.col("d.mid") == F.col("b.mid"))
             .select("row", "items_key", "size", (F.col("d.p") - left).alias("s"), (F.col("d.p") + F.size("d.mid") + right).alias("e"))
             .where(F.col("e") - F.col("s") >= F.col("size")))
    per_row = cut_lineage(spans.groupBy("row").agg(F.collect_set(F.struct("s", "e")).alias("spans"), F.collect_set("items_key").alias("keys")))
    listed = (per_row.select("row", F.explode("keys").alias("items_key")).join(sets, "items_key").groupBy("row")
              .agg(F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")))
    none = F.array().cast("array<struct<s:int,e:int>>")
    return (rows.select("row", "id", "n_words").join(per_row.drop("keys"), "row", "left").join(listed, "row", "left")
            .select(F.col("id.id").alias("id"), F.col("id.k").alias("text_key"), "n_words",
                    F.coalesce(F.sort_array("spans"), none).alias("spans"),
                    F.coalesce(F.sort_array("items"), F.array().cast("array<string>")).alias("items"))
            .withColumn("n_hit", covered(F.col("spans"))))


def is_contaminated(n_hit: str = "n_hit", n_words: str = "n_words", share: int = 20) -> Column:
    """At least one word in ``share`` lies in a benchmark passage."""
    return (F.col(n_hit) > 0) & (F.col(n_hit) * share >= F.col(n_words))


def without_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The documents that are not contaminated, all columns as they are."""
    hits = benchmark_hits(docs, items, doc_id, text, **names).where(is_contaminated())
    bad = hits.select(F.struct(F.col("id"), F.col("text_key")).alias("_bad")).distinct()
    key = F.struct(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("text_key"))
    return docs.join(bad, key == F.col("_bad"), "left_anti")
