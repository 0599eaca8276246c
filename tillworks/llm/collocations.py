"""Collocations: phrases of two and more words whose words are found together far more often than apart, per language.

Words that occur often enough get the rank of their frequency as their id. Pairs of neighbours are tallied within the tasks: where both
ranks are below RANKS, the pair is an address in a dense table of rank pairs, tile after tile, counted with bincount; all other pairs are
sorted coordinates with their counts. Spark adds up what the tasks send. Frequent pairs are ranked anew and take the place of words: two
phrases of L words that overlap in all but one are a pair again, namely a phrase of L + 1 words. Phrases that are not frequent cannot
be part of a frequent one, so pairs are dropped before they are tallied unless both halves are known to be frequent.

The ranks of up to TABLE phrases of one length are held by the driver and every task, eight bytes each for the id behind a rank and
four for the rank. Where more are frequent than that, the phrases beyond the first RANKS go by a 64-bit hash of their language and words
instead, a pair by both hashes, and a filter of at most MAX_BITS bits drops pairs; what the filter lets through by mistake fails the
exact count. So what is held is bounded, and results do not depend on it.

Cases: a null text is empty; a null language counts as ``und``; texts without words give nothing; a phrase never crosses a piece or a
text; repeated rows count each; overlapping occurrences all count; equal scores are told apart by count, then by the bytes of the phrase;
an empty table gives no phrases; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillworks.llm.text import LOWER, chunks, filter_bits, in_filter, mix, run_hashes, small_batches, span_hashes, spans_of
from tillworks.session import cut_lineage

#: Ranks with a direct address, in tiles of TILE x TILE counters.
RANKS, TILE = 1024, 256
#: Pairs that a task gathers before it sorts and sends them, and distinct words that it holds.
GATHERED, HELD_WORDS = 3 << 19, 1 << 19
MAX_BITS = 1 << 24
#: Phrases of one length that are known by their rank.
TABLE = 1 << 22
#: Words of the first cut of a top list, per salt.
SALTS = 64

# Bytes that end a word, and those of them that end a piece as well.
IS_WORD = np.ones(256, dtype=bool)
ENDS_PIECE = np.zeros(256, dtype=bool)
ENDS_PIECE[list(b".,;:!?\n\x0b\x0c\r")] = True
IS_WORD[list(b" \t")] = False
IS_WORD[ENDS_PIECE] = False


def _words(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(bytes, starts, ends, ids, goes on, text of each word) of some texts: a word's id holds its language; whether the next word follows
    in its piece."""
    salts = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
    for first, raw, bounds in chunks(batch.column(0)):
        data = LOWER[raw]
        starts, ends = spans_of(IS_WORD[data], bounds)
        if not len(starts):
            continue
        own = np.searchsorted(bounds, starts, side="right") - 1
        breaks = np.concatenate(([0], np.cumsum(ENDS_PIECE[data])))
        goes_on = np.append((own[1:] == own[:-1]) & (breaks[starts[1:]] == breaks[ends[:-1]]), False)
        yield data, starts, ends, mix(span_hashes(data, starts, ends) + salts[first + own]), goes_on, first + own


def _texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The stretches of the bytes as strings."""
    sizes = ends - starts
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    place = np.arange(bounds[-1]) + np.repeat(starts - bounds[:-1], sizes)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[place])).cast(pa.string())


def _prepared(docs: DataFrame, text: str, lang: str) -> DataFrame:
    small_batches(docs.sparkSession)
    tongue = F.coalesce(F.col(lang).cast("string"), F.lit("und"))
    return docs.select(F.col(text).cast("string").alias("text"), F.xxhash64(tongue).alias("salt"), tongue.alias("lang"))


def count_words(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(id, lang, word, n): how often each word occurs in the texts of each language; a null word stands for all words of its language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, parts, rows = ["id", "lang", "word", "n"], [], 0
        for batch in batches:
            for data, starts, ends, ids, _, own in _words(batch):
                _, at, n = np.unique(ids, return_index=True, return_counts=True)
                tongue = batch.column(2).take(pa.array(own[at]))
                parts.append(pa.table([pa.array(ids[at].view(np.int64)), tongue, _texts(data, starts[at], ends[at]), pa.array(n)], names=names))
                own, n = np.unique(own, return_counts=True)
                parts.append(pa.table([pa.array(np.zeros(len(own), np.int64)), batch.column(2).take(pa.array(own)), pa.nulls(len(own), pa.string()),
                                       pa.array(n)], names=names))
                rows += len(at) + len(own)
                if rows > HELD_WORDS:
                    parts = [_folded(parts)]
                    rows = len(parts[0])
                    if rows > HELD_WORDS // 2:
                        yield from parts[0].to_batches()
                        parts, rows = [], 0
        if parts:
            yield from _folded(parts).to_batches()

    found = _prepared(docs, text, lang).mapInArrow(run, "id bigint, lang string, word string, n bigint")
    return found.groupBy("lang", "word", "id").agg(F.sum("n").alias("n"))


def _folded(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).combine_chunks().group_by(["id", "lang", "word"], use_threads=False).aggregate([("n", "sum")]).rename_columns(
        ["id", "lang", "word", "n"])


class Symbols:
    """The frequent phrases of one length as the tasks know them: by rank, or the first ones by rank and all by a filter."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray | None = None, ranks: int = RANKS):
        """``ids``: by rank; all of them, unless ``bits`` is the filter."""
        self.ids, self.bits, self.dense = ids, bits, min(len(ids), ranks)
        self.rank_of = np.argsort(ids, kind="stable").astype(np.int32)
        self.ordered = ids[self.rank_of]

    def rank(self, ids: np.ndarray) -> np.ndarray:
        """Rank of each id, -1 where it has none."""
        if not len(self.ids):
            return np.full(len(ids), -1, dtype=np.int64)
        place = np.minimum(np.searchsorted(self.ordered, ids), len(self.ids) - 1)
        return np.where(self.ordered[place] == ids, self.rank_of[place], np.int32(-1)).astype(np.int64)

    def told(self, ids: np.ndarray) -> np.ndarray:
        """What a pair is made of: the rank of each id, or the id itself where not all have a rank; -1 where it is not frequent."""
        return self.rank(ids) if self.bits is None else np.where(in_filter(self.bits, ids), ids.view(np.int64), np.int64(-1))


class Tally:
    """Counts of pairs: an address for the first ranks, sorted coordinates for the rest. A pair goes by its ranks in one number, or by
    the ids of its halves where not all have a rank, see :meth:`Symbols.told`."""

    def __init__(self, symbols: Symbols):
        self.symbols, self.by_rank = symbols, symbols.bits is None
        self.tiles = -(-symbols.dense // TILE)
        self.counts = np.zeros(self.tiles * self.tiles * TILE * TILE, dtype=np.int64)
        self.left, self.right, self.gathered = [], [], 0

    def add(self, left: np.ndarray, right: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.left.append(left)
        self.right.append(right)
        self.gathered += len(left)
        if self.gathered >= GATHERED:
            yield from self._counted()

    def _counted(self) -> Iterator[pa.RecordBatch]:
        left, right = np.concatenate(self.left), np.concatenate(self.right)
        self.left, self.right, self.gathered = [], [], 0
        a, b = (left, right) if self.by_rank else (self.symbols.rank(left.view(np.uint64)), self.symbols.rank(right.view(np.uint64)))
        near = (a >= 0) & (b >= 0) & (a < self.symbols.dense) & (b < self.symbols.dense)
        if near.any():
            x, y = a[near], b[near]
            address = ((x // TILE) * self.tiles + y // TILE) * (TILE * TILE) + (x % TILE) * TILE + y % TILE
            self.counts += np.bincount(address, minlength=len(self.counts))
        far = ~near
        if self.by_rank:
            pairs, n = np.unique(a[far] << 32 | b[far], return_counts=True)
            yield from _batches(pairs, n)
            return
        left, right = left[far], right[far]
        order = np.lexsort((right, left))
        left, right = left[order], right[order]
        first = np.flatnonzero(np.concatenate(([True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])))) if len(left) else np.zeros(0, np.int64)
        yield from _batches(left[first], right[first], np.diff(np.append(first, len(left))))

    def rest(self) -> Iterator[pa.RecordBatch]:
        """What is not sent yet, the dense tiles last."""
        if self.gathered:
            yield from self._counted()
        address = np.flatnonzero(self.counts)
        tile, place = np.divmod(address, TILE * TILE)
        a, b = (tile // max(self.tiles, 1)) * TILE + place // TILE, (tile % max(self.tiles, 1)) * TILE + place % TILE
        n = self.counts[address]
        yield from _batches(a << 32 | b, n) if self.by_rank else _batches(*(self.symbols.ids[x].view(np.int64) for x in (a, b)), n)


def _batches(*columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    names = ["pair", "n"] if len(columns) == 2 else ["left", "right", "n"]
    for i in range(0, len(columns[0]), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(c[i:i + (1 << 16)].view(np.int64)) for c in columns], names=names)


def joined_ids(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The id of the phrase that two overlapping phrases make."""
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1))


def count_pairs(docs: DataFrame, known: list[Symbols], text: str = "text", lang: str = "lang") -> DataFrame:
    """(pair, f), or (left, right, f), of neighbouring phrases of len(known) words, both frequent as far as ``known`` tells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(known[-1])
        for batch in batches:
            for _, _, _, ids, goes_on, _ in _words(batch):
                told = known[0].told(ids)
                for longer in known[1:]:
                    # a phrase from each word on, one word longer than before; the last ones reach past the end and are not frequent
                    whole = np.flatnonzero((told != -1) & goes_on & (np.append(told[1:], -1) != -1))
                    ids = joined_ids(ids, np.append(ids[1:], np.uint64(0)))
                    told = np.full(len(ids), -1, dtype=np.int64)
                    told[whole] = longer.told(ids[whole])
                at = np.flatnonzero((told[:-1] != -1) & (told[1:] != -1) & goes_on[:-1])
                yield from tally.add(told[at], told[at + 1])
        yield from tally.rest()

    keys = ["pair"] if known[-1].bits is None else ["left", "right"]
    found = _prepared(docs, text, lang).mapInArrow(run, ", ".join(f"{k} bigint" for k in [*keys, "n"]))
    return found.groupBy(*keys).agg(F.sum("n").alias("f"))


def _named(pairs: DataFrame, symbols: Symbols) -> DataFrame:
    """(left, right, f, id): frequent pairs by the ids of their halves, with the id of their phrase."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *own, f = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            left, right = (symbols.ids[own[0] >> 32], symbols.ids[own[0] & 0xFFFFFFFF]) if symbols.bits is None else (x.view(np.uint64) for x in own)
            columns = (left, right, f, joined_ids(left, right))
            yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], names=["left", "right", "f", "id"])

    return pairs.mapInArrow(run, "left bigint, right bigint, f bigint, id bigint")


def known_symbols(phrases: DataFrame, ranks: int = RANKS, table: int = TABLE) -> Symbols:
    """What tasks are told of the frequent phrases: all by rank, or beyond ``table`` the first and a filter with some 32 bits for each."""
    n = phrases.count()
    best = phrases.orderBy(F.desc("f"), "id").select("id")
    ids = (best if n <= table else best.limit(ranks)).toArrow().column("id").to_numpy().view(np.uint64)
    if n <= table:
        return Symbols(ids, ranks=ranks)
    return Symbols(ids, filter_bits(phrases, "id", min(MAX_BITS, max(1 << 12, 1 << (32 * n).bit_length()))), ranks)


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = 30, longest: int = 4,
                     ranks: int = RANKS, table: int = TABLE) -> tuple[DataFrame, list[DataFrame]]:
    """((lang, n) of all words, frequent phrases of 1, 2, ... ``longest`` words), each table written once.

    Phrases: id, lang, phrase, last (its last word), f, heads and tails (how often its first and last 1, 2, ... words occur, itself last),
    and from two words on left and right, the ids of the phrases without its last and first word.
    """
    words = cut_lineage(count_words(docs, text, lang).where(F.col("word").isNull() | (F.col("n") >= min_count)))
    totals = words.where(F.col("word").isNull()).select("lang", "n")
    alone = F.array("n")
    levels = [words.where(F.col("word").isNotNull()).select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"),
                                                            F.col("n").alias("f"), alone.alias("heads"), alone.alias("tails"))]
    known: list[Symbols] = []
    for _ in range(longest - 1):
        known.append(known_symbols(levels[-1], ranks, table))
        found = count_pairs(docs, known, text, lang).where(F.col("f") >= min_count)
        head = levels[-1].select(F.col("id").alias("left"), "lang", F.col("phrase").alias("start"), "heads")
        tail = levels[-1].select(F.col("id").alias("right"), "last", "tails")
        levels.append(cut_lineage(_named(found, known[-1]).join(head, "left").join(tail, "right").select(
            "id", "lang", F.concat_ws(" ", "start", "last").alias("phrase"), "last", "f", F.concat("heads", F.array("f")).alias("heads"),
            F.concat("tails", F.array("f")).alias("tails"), "left", "right")))
    return totals, levels


def weakest_cut(scale: int) -> Column:
    """struct(score, k, l, r) of the cut with the least score floor(scale * f / (l + r)), the first of equal ones. The product is a decimal."""
    def cut(k: Column) -> Column:
        l, r = F.get("heads", k - 1), F.get("tails", F.size("heads") - k - 1)
        score = F.call_function("div", F.col("f").cast("decimal(20,0)") * F.lit(scale).cast("decimal(10,0)"), l + r)
        return F.struct(score.cast("long").alias("score"), k.alias("k"), l.alias("l"), r.alias("r"))

    return F.array_min(F.transform(F.sequence(F.lit(1), F.size("heads") - 1), cut))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = 30, longest: int = 4, scale: int = 2000000,
                 absorbed: tuple[int, int] = (80, 100), top: int = 2000, ranks: int = RANKS, table: int = TABLE) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a (occurrences), l and r (of the parts of its weakest cut), n (words of the
    language), score, k (words before the cut).

    A phrase goes if one longer frequent phrase with all its words holds at least ``absorbed`` of its occurrences. Phrases longer by
    one word settle that: a still longer one occurs no more often than the one within it.
    """
    totals, levels = frequent_phrases(docs, text, lang, min_count, longest, ranks, table)
    share, whole = absorbed
    kept = []
    for level, longer in zip(levels[1:], [*levels[2:], None]):
        if longer is not None:
            around = longer.select(F.col("left").alias("id"), F.col("f").alias("around")).unionByName(
                longer.select(F.col("right").alias("id"), F.col("f").alias("around"))).groupBy("id").agg(F.max("around").alias("around"))
            level = level.join(around, "id", "left").where(
                F.col("around").isNull() | (F.col("around").cast("decimal(20,0)") * whole < F.col("f").cast("decimal(20,0)") * share))
        kept.append(level.select("lang", "phrase", "f", weakest_cut(scale).alias("cut"), F.pmod("id", F.lit(SALTS)).alias("salt")))
    rows = kept[0]
    for more in kept[1:]:
        rows = rows.unionByName(more)
    # ranked in two rounds: no task sorts more of a language than a few times ``top`` phrases
    order = [F.desc("cut.score"), F.desc("f"), F.asc("phrase")]
    for keys in (["lang", "salt"], ["lang"]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return rows.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("f").alias("a"), F.col("cut.l").alias("l"),
                                            F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"), F.col("cut.k").alias("k"))


def oracle_sql(table: str = "documents", min_count: int = 30, longest: int = 4, scale: int = 2000000, absorbed: tuple[int, int] = (80, 100),
               top: int = 2000) -> str:
    """The same in SQL, by counting every phrase."""
    share, whole = absorbed
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')), '[^ 	]+') AS w FROM {table}),
f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM pieces, unnest(range(1, {longest + 1})) AS u(k), unnest(range(1, len(w) - k + 2)) AS v(i) WHERE len(w) >= k GROUP BY ALL),
found AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= {min_count}),
around AS (
  SELECT lang, array_to_string(w[i:i + n - 1], ' ') AS phrase, max(f) AS around
  FROM found, unnest(range(2, k)) AS u(n), unnest(range(1, k - n + 2)) AS v(i) GROUP BY ALL),
cuts AS (
  SELECT c.lang, c.phrase, c.f, j, x.f AS l, y.f AS r, CAST({scale}::HUGEINT * c.f // (x.f + y.f) AS BIGINT) AS score
  FROM found c, unnest(range(1, c.k)) AS u(j)
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:j], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[j + 1:], ' ')),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (
  SELECT c.*, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, f DESC, c.phrase) AS rank
  FROM weakest c LEFT JOIN around a ON a.lang = c.lang AND a.phrase = c.phrase WHERE a.around IS NULL OR a.around * {whole}::HUGEINT < c.f * {share}::HUGEINT)
SELECT lang, rank, phrase, f AS a, l, r, n, score, CAST(j AS INTEGER) AS k
FROM ranked JOIN (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang) t USING (lang) WHERE rank <= {top}"""
