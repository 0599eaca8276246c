"""SentencePiece encoding and decoding with a table of distinct chunks.

Where no piece of a model holds a white-space mark behind another character, merges cannot cross the place before a run of marks. A text
is then cut there into marked words, each distinct one is segmented once by the sentencepiece library, and its ids are put back by
position. The table lives in the Python worker, which Spark uses again for later tasks, and starts anew once it holds TABLE_CHARS
characters, so its memory is bounded and no text is shuffled. Models that normalise text, drop white space or have pieces across marks
are encoded text by text.

Cases: a null or empty text has no pieces but the asked begin and end ids; null ids decode to an empty text; ids outside the vocabulary
and null ids within a list count as unknown; a literal U+2581 is a space, as for the library; a long text without spaces is one chunk;
rows are independent, so repeated rows and ties give equal rows; an empty table stays empty; a column named as the output is replaced,
all others are kept.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.llm.text import chunks, small_batches

#: The model file of the registered query, by default where the public vocabularies lie.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
TABLE_CHARS = 1 << 22


@functools.cache
def load(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


@functools.cache
def cuts_at_marks(model: bytes) -> bool:
    """Whether a text may be cut before its runs of marks: the normaliser only puts a mark in front and for each space, and no piece of
    the vocabulary has a mark behind another character."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto.FromString(model)
    rule = proto.normalizer_spec
    plain = not rule.precompiled_charsmap and rule.add_dummy_prefix and rule.escape_whitespaces and not rule.remove_extra_whitespaces
    known = load(model).piece_to_id(MARK) != load(model).unk_id()
    return bool(plain and known and proto.trainer_spec.model_type == proto.trainer_spec.BPE and not proto.trainer_spec.treat_whitespace_as_suffix
                and not any(MARK in p.piece.lstrip(MARK) for p in proto.pieces))


class ChunkTable:
    """Ids of distinct marked words, each segmented when it is first met. A word is known by what stands behind its first mark, as the library
    itself puts a mark before a text; a lone mark has nothing left."""

    def __init__(self, model: bytes, most_chars: int = TABLE_CHARS):
        self.processor, self.most = load(model), most_chars
        self.whole = not cuts_at_marks(model)
        self.lone = [self.processor.piece_to_id(MARK)]
        self._empty()

    def _empty(self) -> None:
        self.code: dict[str, int] = {}
        self.chars, self.bounds, self.ids = 0, np.zeros(1, np.int64), np.zeros(0, np.int32)

    def _codes(self, words: list[str]) -> np.ndarray:
        """The place of each distinct word in the table; unknown ones are segmented."""
        if self.chars > self.most:
            self._empty()
        new = [w for w in words if w not in self.code]
        found = [self.lone if not w else x for w, x in zip(new, self.processor.encode(new, num_threads=1))]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(sizes)))
        self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))))
        self.code.update(zip(new, range(len(self.code), len(self.code) + len(new))))
        self.chars += sum(map(len, new))
        return np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, the bounds of each text's ids)."""
        if self.whole:
            found = self.processor.encode(texts.to_pylist(), num_threads=1)
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum())), np.concatenate(([0], np.cumsum(sizes)))
        parts, sizes = [], []
        for _, raw, bounds in chunks(pc.replace_substring(texts, MARK, " ")):
            ids, own = self._encoded(raw, bounds)
            parts.append(ids)
            sizes.append(own)
        return np.concatenate([np.zeros(0, np.int32), *parts]), np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *sizes]))])

    def _encoded(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per text) of some texts by their bytes."""
        if not len(raw):
            return np.zeros(0, np.int32), np.zeros(len(bounds) - 1, np.int64)
        blank = raw == 32
        cut = np.concatenate(([False], blank[1:] & ~blank[:-1]))  # the first mark of a word within a text: it is left out
        begins = np.unique(bounds[:-1][bounds[:-1] < bounds[1:]])
        cut[begins] = False
        starts = cut.copy()
        starts[begins] = True
        places = np.flatnonzero(starts)
        left = np.concatenate(([0], np.cumsum(~cut)))
        offsets = np.append(left[places], left[-1])
        words = pa.LargeStringArray.from_buffers(len(places), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw[~cut]))
        distinct = words.dictionary_encode()
        codes = self._codes(distinct.dictionary.to_pylist())[distinct.indices.to_numpy()]
        sizes = self.bounds[codes + 1] - self.bounds[codes]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        ids = self.ids[np.arange(ends[-1]) + np.repeat(self.bounds[codes] - ends[:-1], sizes)]
        return ids, np.diff(ends[np.searchsorted(places, bounds)])


@functools.cache
def _table(model: bytes) -> ChunkTable:
    return ChunkTable(model)


def _framed(ids: np.ndarray, bounds: np.ndarray, first: list[int], last: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The same with ids put before and behind those of each text."""
    more = len(first) + len(last)
    wide = bounds + more * np.arange(len(bounds))
    out = np.empty(wide[-1], np.int32)
    out[np.arange(len(ids)) + np.repeat(more * np.arange(len(bounds) - 1) + len(first), np.diff(bounds))] = ids
    for own, at in [(x, wide[:-1] + i) for i, x in enumerate(first)] + [(x, wide[1:] - len(last) + i) for i, x in enumerate(last)]:
        out[at] = own
    return out, wide


def _with_column(docs: DataFrame, name: str, value: Column, kind: T.DataType) -> tuple[DataFrame, T.StructType, list[str]]:
    """``docs`` with a column for the tasks to work on, their result's schema, and the names to give it. Columns go by number meanwhile, as
    names with dots cannot be sent to Python."""
    kept = [f for f in docs.schema.fields if f.name.lower() != name.lower()]
    rows = docs.select(*[F.col(f"`{f.name}`").alias(f"_{i}") for i, f in enumerate(kept)], value.alias("_out"))
    schema = T.StructType([*[T.StructField(f"_{i}", f.dataType) for i, f in enumerate(kept)], T.StructField("_out", kind)])
    return rows, schema, [*[f.name for f in kept], name]


def read_model(path: str) -> bytes:
    """A model file, read by the driver; its bytes (less than a megabyte) travel with the tasks."""
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, model: bytes, text: str = "text", out: str = "token_ids", bos: bool = False, eos: bool = True) -> DataFrame:
    """``docs`` with the ids of each text as the library gives them, without sampling; ``bos`` and ``eos`` add the begin and end ids."""
    small_batches(docs.sparkSession)
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows, schema, names = _with_column(docs, out, whole, T.ArrayType(T.IntegerType()))
    first, last = ([i] if on else [] for on, i in ((bos, load(model).bos_id()), (eos, load(model).eos_id())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(model)
        for batch in batches:
            ids, bounds = _framed(*table.encode(batch.columns[-1]), first, last)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=schema.names)

    return rows.mapInArrow(run, schema).toDF(*names)


def decode(docs: DataFrame, model: bytes, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text of each list of ids as the library's decode() gives it."""
    small_batches(docs.sparkSession)
    size, unknown = load(model).vocab_size(), load(model).unk_id()
    safe = F.transform(F.col(ids), lambda x: F.when((x >= 0) & (x < size), x).otherwise(F.lit(unknown)).cast("int"))
    rows, schema, names = _with_column(docs, out, F.coalesce(safe, F.array().cast("array<int>")), T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = load(model)
        for batch in batches:
            lists = batch.columns[-1]
            ids, bounds = lists.flatten().to_numpy(), lists.value_lengths().to_numpy().cumsum()
            texts = [processor.decode(own.tolist()) if len(own) else "" for own in np.split(ids, bounds[:-1])] if len(lists) else []
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema).toDF(*names)
