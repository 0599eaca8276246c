"""Substring de-duplication with sliding sentence spans.

A text is cut into sentences. A span is a run of consecutive sentences: from each sentence on, and back from each sentence, the shortest
run of at least ``min_sentences`` sentences and ``min_words`` words; a single sentence of ``long_sentence`` words or more is a span as
well. Spans with the same words are the same span wherever they stand. The first one (by document id, text and place) stays, and every
sentence that a later one covers is removed. Where a passage is cut into the same sentences again, these spans cover what all its runs
would: a sentence from which no span fits into the passage lies in the one that ends with it.

Cases: a null text is empty and keeps nothing; texts without a span are kept whole; repeated rows (same id and text)
are one document, cleaned alike; a null id comes before all others; columns besides
the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.functions.skew import join_per_key
from tillworks.llm.text import IS_WORD, LOWER, chunks, run_hashes, small_batches, span_hashes, spans_of
from tillworks.session import cut_lineage

MIN_SENTENCES = 2
MIN_WORDS = 25
LONG_SENTENCE = 40

#: Bytes that may end a sentence; `.`, `!` and `?` do before white space only.
ENDS = np.zeros(256, dtype=bool)
ENDS[[ord(c) for c in ".!?"]] = True
BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def sentence_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin of every sentence and the end of all; index of each text's first sentence). A sentence ends after a line break, or after
    an end mark with white space behind it; the pieces of a text make up the text."""
    if not len(data):
        return np.zeros(1, np.int64), np.zeros(len(bounds), np.int64)
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[1:-1] = (ENDS[data[:-1]] & BLANK[data[1:]]) | (data[:-1] == 10)
    cut[bounds] = True
    begins = np.flatnonzero(cut)
    return begins, np.searchsorted(begins, bounds)


def span_rows(data: np.ndarray, bounds: np.ndarray, min_sentences: int, min_words: int, long_sentence: int):
    """For all texts: (text, first sentence, sentences, two hashes) of every span, and the sentence bounds."""
    begins, per_text = sentence_bounds(data, bounds)
    starts, ends = spans_of(IS_WORD[data], bounds)
    one = span_hashes(data, starts, ends)
    two = run_hashes(one, 1)
    first = np.searchsorted(starts, begins)  # first word of each sentence
    n = len(begins) - 1
    text_of = np.searchsorted(per_text, np.arange(n), side="right") - 1 if n else np.zeros(0, np.int64)
    begin, limit = (per_text[text_of], per_text[text_of + 1]) if n else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    # the sentence after the shortest run that is long enough
    reach = np.maximum(np.searchsorted(first, first[:-1] + min_words, side="left"), np.arange(n) + min_sentences)
    has_words = np.diff(first) > 0
    run = np.flatnonzero((reach <= limit) & has_words)
    single = np.flatnonzero((np.diff(first) >= long_sentence) & has_words)
    # the first sentence of the shortest run that is long enough and ends with a sentence; like all runs it begins with words
    back = np.minimum(np.searchsorted(first, first[1:] - min_words, side="right") - 1, np.arange(1, n + 1) - min_sentences)
    worded = np.maximum.accumulate(np.where(has_words, np.arange(n), -1))
    back = np.where(back >= 0, worded[np.maximum(back, 0)], -1) if n else back
    tail = np.flatnonzero((back >= begin) & has_words)
    both = np.unique(np.concatenate((run * (n + 1) + reach[run], single * (n + 1) + single + 1, back[tail] * (n + 1) + tail + 1)))
    at, to = both // (n + 1), both % (n + 1)
    low, high = first[at], first[to]
    return text_of[at], at - per_text[text_of[at]], to - at, _range_hashes(one, low, high), _range_hashes(two, low, high), begins, per_text


def _range_hashes(words: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hash of the words low to high, the same for the same words wherever they stand."""
    base = 0xD1342543DE82EF95
    n = len(words) + 1
    up = np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, np.uint64(base)))))
    down = np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, np.uint64(pow(base, -1, 1 << 64))))))
    sums = np.concatenate(([np.uint64(0)], np.cumsum(words * up[:len(words)], dtype=np.uint64)))
    return (sums[high] - sums[low]) * down[low] + (high - low).astype(np.uint64)


def _spans_mapper(min_sentences: int, min_words: int, long_sentence: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, raw, bounds in chunks(batch.column(2)):
                text, at, n, one, two, _, _ = span_rows(LOWER[raw], bounds, min_sentences, min_words, long_sentence)
                rows = pa.array(text + first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                     pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))], names=["id", "row", "h1", "h2", "at", "n"])
    return run


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, spans to remove) to the cleaned rows."""
    for batch in batches:
        gone = batch.column(2).to_pylist()
        n, removed, words, clean = [], [], [], []
        for first, raw, bounds in chunks(batch.column(1)):
            begins, per_text = sentence_bounds(raw, bounds)
            starts, _ = spans_of(IS_WORD[LOWER[raw]], bounds)
            count = np.diff(np.searchsorted(starts, begins))
            for i in range(len(bounds) - 1):
                a, b = int(per_text[i]), int(per_text[i + 1])
                out = np.zeros(b - a, dtype=bool)
                for at, k in ((x["at"], x["n"]) for x in gone[first + i] or []):
                    out[at:at + k] = True
                n.append(b - a)
                removed.append(int(out.sum()))
                words.append(int(count[a:b][out].sum()))
                pieces = (raw[begins[a + j]:begins[a + j + 1]] for j in np.flatnonzero(~out))
                clean.append((b"".join(p.tobytes() for p in pieces) if out.any() else raw[bounds[i]:bounds[i + 1]].tobytes()).decode("utf-8"))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(words, pa.int64()),
                                          pa.array(clean, pa.string())], names=["id", "n_sentences", "n_removed", "words_removed", "text"])


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_sentences: int = MIN_SENTENCES,
                    min_words: int = MIN_WORDS, long_sentence: int = LONG_SENTENCE) -> DataFrame:
    """One row per document row: id, n_sentences, n_removed, words_removed, text (what is left).

    Spans are shuffled as two hashes and a place, once for the counts and once, where a span occurs again, to find all but the first.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("row"), F.col(text).cast("string").alias("text"))
    spans = cut_lineage(rows.mapInArrow(_spans_mapper(min_sentences, min_words, long_sentence),
                                        f"id {kind}, row bigint, h1 bigint, h2 bigint, at int, n int"))
    often = spans.groupBy("h1").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") > 1).drop("times")
    again = cut_lineage(join_per_key(spans, often, ["h1"], "inner"))
    place = F.struct("id", "row", "at")
    first = again.groupBy("h1", "h2").agg(F.min(place).alias("first"))
    later = join_per_key(again, first, ["h1", "h2"], "inner").where(place != F.col("first"))
    gone = later.groupBy(F.struct("id", "row").alias("_doc")).agg(F.collect_set(F.struct("at", "n")).alias("gone"))
    source = rows.select("id", "text", F.struct("id", "row").alias("_at")).join(gone, F.col("_at") == F.col("_doc"), "left")
    return source.select("id", "text", "gone").mapInArrow(
        _clean, f"id {kind}, n_sentences bigint, n_removed bigint, words_removed bigint, text string")
