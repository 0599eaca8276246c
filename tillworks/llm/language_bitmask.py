"""Language identification with a bit-sliced Bloom filter of character n-grams.

Every slot of the filter holds one bit per language, so the AND of an n-gram's slots tells at once which languages contain it. Learning
counts the three-character grams of words in all training texts; a language contains a gram that makes up at least ``min_share`` of
its grams, which bounds its grams by 1 / min_share. A text's language is the one that contains the largest share of its grams, after
the share that the filter would wrongly report (fill ** probes) is taken off.

Cases: a null text and a text without letters are ``und`` with score 0; without training texts all are; equal shares go to the first
language by name; languages are learned only from rows with a language and at least one letter; columns besides the named ones are
ignored; repeated rows get a row each.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.text import chunks, mix, small_batches
from tillworks.session import cut_lineage

SLOTS = 1 << 18
PROBES = 3
MIN_SHARE = 2e-5
LANGUAGES_PER_WORD = 63
FLUSH = 200_000
UNKNOWN = "und"

_CHARS: list[np.ndarray] = []


def characters() -> np.ndarray:
    """For every code point its simple lower-case letter, or 0 if it is no letter."""
    if not _CHARS:
        table = np.zeros(0x110000, dtype=np.uint32)
        for c in range(0x110000):
            if unicodedata.category(ch := chr(c))[0] == "L":
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _CHARS.append(table)
    return _CHARS[0]


def grams(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, one gram for every letter, bounds of the texts in them): the letter between its neighbours, 0 for no letter."""
    table = characters()
    for first, raw, bounds in chunks(column):
        points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        begin = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))[bounds]
        letters = table[points].astype(np.uint64)
        left = np.concatenate((np.zeros(1, np.uint64), letters[:-1])) if len(letters) else letters
        right = np.concatenate((letters[1:], np.zeros(1, np.uint64))) if len(letters) else letters
        edges = begin[(begin > 0) & (begin < len(letters))]
        left[edges] = 0
        right[edges - 1] = 0
        at = np.flatnonzero(letters)
        keys = (left[at] << np.uint64(42)) | (letters[at] << np.uint64(21)) | right[at]
        yield first, keys, np.searchsorted(at, begin)


def slots_of(keys: np.ndarray) -> Iterator[np.ndarray]:
    """The slots of each gram, one probe after the other."""
    for probe in range(PROBES):
        yield (mix(keys ^ np.uint64(0x9E3779B97F4A7C15 * (probe + 1) & 0xFFFFFFFFFFFFFFFF)) & np.uint64(SLOTS - 1)).astype(np.int64)


@dataclass(frozen=True)
class LanguageModel:
    """languages by bit; words[i][slot]: bits of the languages from 63 i on; fill: the share of set slots by language."""

    languages: tuple[str, ...]
    words: tuple[np.ndarray, ...]
    fill: np.ndarray

    def shares(self, keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Per text and language the share of its grams, freed of false positives."""
        places = list(slots_of(keys))
        n = np.diff(bounds)
        out = np.zeros((len(n), len(self.languages)))
        for i, word in enumerate(self.words):
            bits = word[places[0]]
            for place in places[1:]:
                bits &= word[place]
            for j in range(min(LANGUAGES_PER_WORD, len(self.languages) - i * LANGUAGES_PER_WORD)):
                sums = np.concatenate(([0], np.cumsum((bits >> np.uint64(j)) & np.uint64(1), dtype=np.int64)))
                out[:, i * LANGUAGES_PER_WORD + j] = (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(n, 1)
        wrong = self.fill ** PROBES
        return np.clip((out - wrong) / np.maximum(1 - wrong, 1e-9), 0, 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, gram, times), folded in the task."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def flush(lang: str) -> pa.RecordBatch:
        keys, times = _folded(held.pop(lang))
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(times)],
                                          names=["lang", "gram", "times"])

    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), dtype=object)
        for first, keys, bounds in grams(batch.column(1)):
            own = langs[first:first + len(bounds) - 1]
            of_text = np.repeat(np.arange(len(own)), np.diff(bounds))
            for lang in set(own):
                found = np.unique(keys[(own == lang)[of_text]], return_counts=True)
                if len(found[0]):
                    held.setdefault(lang, []).append(found)
                    if sum(len(k) for k, _ in held[lang]) > FLUSH:
                        held[lang] = [_folded(held[lang])]
                        if len(held[lang][0][0]) > FLUSH // 2:
                            yield flush(lang)
    for lang in sorted(held):
        yield flush(lang)


def _folded(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(place, weights=np.concatenate([t for _, t in parts]), minlength=len(keys)).astype(np.int64)


def learn(training: DataFrame, text: str = "text", lang: str = "lang", min_share: float = MIN_SHARE) -> LanguageModel:
    """Learn from all rows that have a language. Grams are counted and the filter is filled in Spark; the driver receives at most SLOTS
    rows for each 63 languages."""
    spark = training.sparkSession
    small_batches(spark)
    rows = training.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    counts = rows.mapInArrow(_count, "lang string, gram bigint, times bigint").groupBy("lang", "gram").agg(F.sum("times").alias("times"))
    counts = cut_lineage(counts)
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("times").alias("n")).collect()}
    languages = tuple(sorted(totals))
    if not languages:
        return LanguageModel((), (), np.zeros(0))
    facts = spark.createDataFrame([(x, i, totals[x]) for i, x in enumerate(languages)], "lang string, bit int, total bigint")
    members = counts.join(facts, "lang").where(F.col("times") >= F.col("total") * min_share).select("gram", "bit")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, bits = batch.column(0).to_numpy().view(np.uint64), batch.column(1)
            for slots in slots_of(keys):
                yield pa.RecordBatch.from_arrays([pa.array(slots), bits], names=["slot", "bit"])

    slots = members.mapInArrow(place, "slot bigint, bit int")
    word, bit = F.expr(f"bit div {LANGUAGES_PER_WORD}").alias("word"), F.expr(f"shiftleft(1L, bit % {LANGUAGES_PER_WORD})")
    table = slots.groupBy(word, "slot").agg(F.bit_or(bit).alias("bits")).toArrow()
    words = [np.zeros(SLOTS, dtype=np.uint64) for _ in range(-(-len(languages) // LANGUAGES_PER_WORD))]
    which, slot, bits = (table[c].to_numpy() for c in ("word", "slot", "bits"))
    for i, w in enumerate(words):
        w[slot[which == i]] = bits[which == i].view(np.uint64)
    fill = np.array([((words[i // LANGUAGES_PER_WORD] >> np.uint64(i % LANGUAGES_PER_WORD)) & np.uint64(1)).mean() for i in range(len(languages))])
    return LanguageModel(languages, tuple(words), fill)


def identify(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, lang_pred, score (the corrected share of the language told)."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            told, scores = [], []
            for _, keys, bounds in grams(batch.column(1)):
                some = np.diff(bounds) > 0
                if not model.languages:
                    told += [UNKNOWN] * len(some)
                    scores += [0.0] * len(some)
                    continue
                shares = model.shares(keys, bounds)
                best = shares.argmax(axis=1)
                told += [model.languages[b] if s else UNKNOWN for b, s in zip(best, some)]
                scores += np.where(some, shares[np.arange(len(best)), best], 0.0).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(told, pa.string()), pa.array(scores, pa.float64())],
                                             names=["id", "lang_pred", "score"])

    out = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"id {kind}, lang_pred string, score double")
    return out.withColumnRenamed("id", doc_id)
