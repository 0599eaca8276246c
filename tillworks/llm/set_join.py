"""N-gram Jaccard join along chosen paths.

A text is the set of its five-word shingles; texts of one set are one class and only its first document goes on. In each run a set
walks down a tree: at a node it picks each of its (sketched) tokens with chance 1 / (threshold x tokens), the same choice for every set
that has the token, and goes to one child per token picked. A pair at the threshold shares one child on average, unlike sets soon part.
A small node is compared by brute force. A large node is dealt into small blocks: sets that a block finds alike are tied to the least
of them, which walks on for them, and what is left walks down the children. Runs are repeated until the pairs' recall is reached.

What the walk finds are only groups of candidates, by an estimate with a margin. Inside a group all pairs are compared exactly, block
against block, so every pair in a group counts whether or not a node held both. Pairs are never emitted: a comparison yields, per set,
its number of links and one tie.

Cases: words are lower-cased; a text of one to four words is one shingle; null texts and texts without words are alike to nothing and
are classes of their own; repeated rows are copies; null ids are kept apart by their text; columns besides the named ones are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.functions.skew import join_per_key
from tillworks.llm.text import Texts, mix, run_hashes, small_batches, span_hashes, worded
from tillworks.session import cut_lineage

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.999
SKETCH = 64
MARGIN = 0.2
BLOCK = 256
EMPTY = np.uint32(0xFFFFFFFF)


def runs_for(recall: float, depth: int = 2) -> int:
    """Independent runs after which a pair at the threshold has met with chance ``recall`` in a node of this depth. With one shared child
    on average, the chance to meet follows 1 - exp(-chance one level up)."""
    chance = 1.0
    for _ in range(depth):
        chance = 1 - math.exp(-chance)
    return math.ceil(math.log(1 - recall) / math.log(1 - chance))


def shingles(texts: Texts, i: int, words: np.ndarray, n: int) -> np.ndarray:
    """The sorted hashes of the shingles of one text."""
    own = words[texts.words[i]:texts.words[i + 1]]
    return np.unique(run_hashes(own, min(n, max(len(own), 1)))) if len(own) else np.zeros(0, np.uint64)


def sketch(hashes: np.ndarray, size: int) -> np.ndarray:
    """One permutation cut into ``size`` bins: the least hash of each bin. ``hashes`` are sorted."""
    out = np.full(size, EMPTY, dtype=np.uint32)
    bins = (hashes >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)
    at = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1]))) if len(bins) else np.zeros(0, np.int64)
    out[bins[at].astype(np.int64)] = np.minimum(hashes[at] & np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFE)).astype(np.uint32)
    return out


def alike(sketches: np.ndarray, least: float) -> np.ndarray:
    """For each set the least set it is tied to, by estimated similarity: labels of the connected groups."""
    filled = sketches != EMPTY
    label = np.arange(len(sketches))
    for i in range(len(sketches) - 1):
        same = ((sketches[i + 1:] == sketches[i]) & filled[i]).sum(axis=1)
        either = (filled[i + 1:] | filled[i]).sum(axis=1)
        near = np.flatnonzero(same >= least * np.maximum(either, 1)) + i + 1
        if len(near):
            old = np.unique(np.append(label[near], label[i]))
            if len(old) > 1:
                label[np.isin(label, old)] = old[0]
    return label


def children(nodes: np.ndarray, sketches: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child) for each token that a row picks at its node."""
    filled = sketches != EMPTY
    places = np.arange(sketches.shape[1], dtype=np.uint64) << np.uint64(32)
    tokens = mix((sketches.astype(np.uint64) | places) ^ np.uint64(0x5851F42D4C957F2D))
    picks = mix(tokens ^ mix(nodes)[:, None])
    most = np.minimum(2.0 ** 64 / (threshold * np.maximum(filled.sum(axis=1), 1)), 2.0 ** 64 - 2049).astype(np.uint64)
    row, place = np.nonzero(filled & (picks <= most[:, None]))
    return row, mix(picks[row, place] + np.uint64(0x2545F4914F6CDD1D))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """Rows that are in key order (first column): tables of whole groups, and where each group begins and ends."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
        keys = table.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist()]
        if len(cuts) > 1:
            yield table, list(zip(cuts, cuts[1:]))
        held = table.slice(cuts[-1])
    if held is not None:
        yield held.combine_chunks(), [(0, held.num_rows)]


def _sketches(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), -1)


def _batch(names: list[str], columns: list[list[np.ndarray]]) -> pa.RecordBatch:
    """Lists of arrays as long columns."""
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *c]).astype(np.int64)) for c in columns], names=names)


def _grouped(rows: DataFrame, run: Callable, schema: str) -> DataFrame:
    """Rows of a key (first column, a long hash) side by side in one task, in batches."""
    key = rows.columns[0]
    return rows.repartition(F.col(key)).sortWithinPartitions(key).mapInArrow(run, schema)


# --- classes --------------------------------------------------------------------------------------------------------

def _classes_mapper(shingle: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, many, sketches = [], [], []
            for texts in worded(batch.column(2)):
                words = span_hashes(texts.data, texts.starts, texts.ends)
                for i in range(len(texts)):
                    own = shingles(texts, i, words, shingle)
                    many.append(len(own))
                    digests.append(int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "big", signed=True) if len(own) else None)
                    sketches.append(sketch(own, size).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.int64()), pa.array(many, pa.int64()),
                                              pa.array(sketches, pa.binary())], names=["id", "key", "cid", "n", "sketch"])
    return run


def text_classes(docs: DataFrame, doc_id: str, text: str, shingle: int = SHINGLE, size: int = SKETCH) -> tuple[DataFrame, DataFrame]:
    """(rows: id, key, cid; classes: cid, id and key of the first document, sketch, copies). ``cid`` is a 64-bit digest of the set of
    shingles, NULL for a text without words."""
    small_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("key"), F.col(text).cast("string").alias("text"))
    rows = cut_lineage(rows.mapInArrow(_classes_mapper(shingle, size), f"id {kind}, key bigint, cid bigint, n bigint, sketch binary"))
    classes = rows.where(F.col("cid").isNotNull()).groupBy("cid").agg(
        F.min(F.struct("id", "key")).alias("first"), F.first("sketch").alias("sketch"), F.count(F.lit(1)).alias("copies"))
    return rows.select("id", "key", "cid"), cut_lineage(classes.select("cid", "first.id", "first.key", "sketch", "copies"))


# --- the walk -------------------------------------------------------------------------------------------------------

def _start(runs: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cids, sketches = batch.column(0).to_numpy(), _sketches(batch.column(1))
            nodes, ids = [], []
            for r in range(runs):
                row, child = children(np.full(len(cids), r + 1, np.uint64), sketches, threshold)
                nodes.append(child.view(np.int64))
                ids.append(cids[row])
            yield _batch(["node", "cid"], [nodes, ids])
    return run


def _compare(threshold: float, margin: float):
    """Compare a block; kind 0: (cid, the set it is tied to); kind 1: (cid, the child it walks to from a large node)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, groups in _groups(batches):
            nodes, all_cids, large = (table[c].to_numpy() for c in ("node", "cid", "large"))
            all_sketches = _sketches(table["sketch"])
            a, b, walk, walkers = [], [], [], []
            for start, end in groups:
                if end - start == 1 and not large[start]:
                    continue
                order = start + np.argsort(all_cids[start:end], kind="stable")
                cids, sketches = all_cids[order], all_sketches[order]
                label = alike(sketches, threshold - margin)
                tied = np.flatnonzero(label != np.arange(len(label)))
                a.append(cids[tied])
                b.append(cids[label[tied]])
                if large[start]:
                    left = np.flatnonzero(label == np.arange(len(label)))
                    row, child = children(nodes[order][left].view(np.uint64), sketches[left], threshold)
                    walk.append(child.view(np.int64))
                    walkers.append(cids[left][row])
            yield _batch(["kind", "cid", "other"], [[np.zeros(len(x)) for x in a] + [np.ones(len(x)) for x in walk], a + walkers, b + walk])
    return run


def candidate_ties(classes: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, margin: float = MARGIN,
                   block: int = BLOCK) -> DataFrame:
    """(a, b): ties between classes that a node found alike by their sketches, at most one per class and node."""
    sketches = classes.select("cid", "sketch")
    walk = cut_lineage(sketches.mapInArrow(_start(runs_for(recall), threshold), "node bigint, cid bigint"))
    ties = None
    while True:
        sizes = walk.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
        met = join_per_key(walk, sizes, ["node"], "inner")
        met = join_per_key(met, sketches, ["cid"], "inner")
        blocks = F.ceil(F.col("size") / block)
        place = F.pmod(F.xxhash64("cid", "node", F.lit(1)), blocks)
        met = met.select(F.xxhash64("node", place).alias("key"), "node", "cid", (F.col("size") > block).alias("large"), "sketch")
        out = cut_lineage(_grouped(met, _compare(threshold, margin), "kind bigint, cid bigint, other bigint"))
        found = out.where("kind = 0").select(F.col("cid").alias("a"), F.col("other").alias("b")).distinct()
        ties = found if ties is None else ties.unionByName(found)
        walk = out.where("kind = 1").select(F.col("other").alias("node"), "cid")
        if walk.isEmpty():
            return cut_lineage(ties.distinct())


# --- connected components -------------------------------------------------------------------------------------------

def components(ties: DataFrame) -> DataFrame:
    """(cid, root): for every cid of ``ties`` (a, b) the least cid it is connected with.

    Large star and small star in turn until nothing changes: every neighbour is tied to the least one around it. Each round is a pair
    of aggregates and joins over the ties, written to the shared folder once a round.
    """
    def tidy(edges: DataFrame) -> DataFrame:
        return edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    edges, before = cut_lineage(tidy(ties)), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = tidy(join_per_key(both.where(F.col("b") > F.col("a")), least, ["a"], "inner").select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = join_per_key(large, least, ["a"], "inner").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut_lineage(tidy(small.unionByName(least.select("a", F.col("m").alias("b")))))
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("a").alias("cid"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("cid"), F.col("b").alias("root")).distinct())


# --- the exact comparison -------------------------------------------------------------------------------------------

def shared_counts(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """How many shingles each two sets share."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count[place] > 1
    owner, place = owner[keep], (np.cumsum(count > 1) - 1)[place[keep]]
    out, order = np.zeros((n, n), dtype=np.float32), np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    for low in range(0, int(place[-1]) + 1 if len(place) else 0, columns):
        a, b = np.searchsorted(place, [low, low + columns])
        table = np.zeros((n, columns), dtype=np.float32)
        table[owner[a:b], place[a:b] - low] = 1
        out += table @ table.T
    return out


def _verify(threshold: float, shingle: int):
    """Exact links of a block with itself (side 0 only) or between two blocks: per set its number of links and a set it is tied to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, groups in _groups(batches):
            all_cids, all_sides = table["cid"].to_numpy(), table["side"].to_numpy()
            all_sets = []
            for texts in worded(table["text"]):
                words = span_hashes(texts.data, texts.starts, texts.ends)
                all_sets += [shingles(texts, i, words, shingle) for i in range(len(texts))]
            out = [[], [], []]
            for start, end in groups:
                cids, first = np.unique(all_cids[start:end], return_index=True)  # repeated rows count once
                if len(cids) < 2:
                    continue
                sets, side = [all_sets[start + i] for i in first], all_sides[start + first]
                sizes = np.array([len(x) for x in sets], dtype=np.float64)
                both = shared_counts(sets).astype(np.float64)
                linked = both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-9
                np.fill_diagonal(linked, False)
                if side.any():
                    linked &= side[:, None] != side[None, :]
                links = linked.sum(axis=1)
                some, label = np.flatnonzero(links), np.arange(len(cids))
                for i in some:
                    old = np.unique(np.append(label[np.flatnonzero(linked[i])], label[i]))
                    if len(old) > 1:
                        label[np.isin(label, old)] = old[0]
                out[0].append(cids[some])
                out[1].append(links[some])
                out[2].append(cids[label[some]])
            yield _batch(["cid", "links", "tie"], out)
    return run


def exact_links(docs: DataFrame, classes: DataFrame, groups: DataFrame, doc_id: str, text: str, threshold: float = THRESHOLD,
                shingle: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """(cid, links, tie): within each group of candidates, how many classes are at least ``threshold`` alike, block against block."""
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    members = join_per_key(groups, sizes, ["root"], "inner")
    members = join_per_key(members, classes.select("cid", "id", "key"), ["cid"], "inner")
    source = docs.select(F.struct(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("key")).alias("_doc"),
                         F.col(text).cast("string").alias("text"))
    wanted = members.select("cid", "root", "size", F.struct("id", "key").alias("_at"))
    rows = source.join(wanted, F.col("_doc") == F.col("_at")).drop("_doc", "_at")
    n = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("cid", F.lit(2)), n).cast("int")
    rows = rows.select("root", "cid", "text", n.alias("n"), own.alias("own")).select(
        "root", "cid", "text", "own", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    rows = rows.select(F.xxhash64("root", low, high).alias("key"), "cid", (F.col("own") > F.col("other")).cast("int").alias("side"), "text")
    return cut_lineage(_grouped(rows, _verify(threshold, shingle), "cid bigint, links bigint, tie bigint"))


def jaccard_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL,
                    shingle: int = SHINGLE) -> DataFrame:
    """One row per document row: id, key (64-bit hash of the text), first_id and first_key (the least document connected with it by
    links), copies (rows with the same shingles, itself included), n_links (other classes at least ``threshold`` alike)."""
    rows, classes = text_classes(docs, doc_id, text, shingle)
    groups = components(candidate_ties(classes, threshold, recall))
    found = exact_links(docs, classes, groups, doc_id, text, threshold, shingle)
    links = found.groupBy("cid").agg(F.sum("links").alias("n_links"))
    roots = components(found.select(F.col("cid").alias("a"), F.col("tie").alias("b")))
    linked = join_per_key(classes.select("cid", "id", "key", "copies"), links, ["cid"])
    linked = join_per_key(linked, roots, ["cid"]).withColumn("root", F.coalesce("root", "cid"))
    heads = linked.groupBy("root").agg(F.min(F.struct("id", "key")).alias("head"))
    linked = join_per_key(linked, heads, ["root"], "inner").select("cid", "head", "copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    out = join_per_key(rows, cut_lineage(linked), ["cid"])
    alone = F.struct("id", "key")
    return out.select("id", "key", F.coalesce(F.col("head"), alone).alias("head"), F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")).select(
        "id", "key", F.col("head.id").alias("first_id"), F.col("head.key").alias("first_key"), "copies", "n_links")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The first document of each group of linked texts, all columns as they are; of repeated rows one."""
    found = jaccard_classes(docs, doc_id, text, **options)
    firsts = found.where(F.col("id").eqNullSafe(F.col("first_id")) & (F.col("key") == F.col("first_key")))
    firsts = firsts.select(F.struct("id", "key").alias("_first")).distinct()
    doc = F.struct(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("key"))
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), doc.alias("_doc")).join(firsts, F.col("_doc") == F.col("_first"))
    return kept.groupBy("_first").agg(F.first("_row").alias("_row")).select("_row.*")
