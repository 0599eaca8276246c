"""Conversation repair, collocations and SentencePiece pieces on odd, long, tied and hot inputs, against plain versions."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from tillworks.llm import collocations, conversation_repair, pieces

CONV = "conv_id long, turn long, role string, text string, cost string, part int"


def _repaired(spark, rows, size=conversation_repair.SEGMENT):
    found, turns = conversation_repair.repair(spark.createDataFrame([(*r, "x", 1) for r in rows], CONV), size=size)
    sums = {r["conv"]: r["sha256"] for r in conversation_repair.turn_digests(turns).collect()}
    return {r["conv"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], sums.get(r["conv"]))
            for r in found.collect()}


def _plain(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    for conv, own in out.items():
        *facts, text = brute.repaired(sorted(own, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])))
        # a conversation without repaired turns has no digest in the stream
        out[conv] = (*facts, brute.sha(text) if set(facts[-1]) - {"D"} else None)
    return out


def _random_rows(rng, convs, turns):
    rows = []
    for conv in range(convs):
        for i in range(rng.randint(1, turns)):
            rows.append((None if conv == 3 else conv, rng.choice([i, i, i, None, i + 2]), rng.choice(["user", "assistant", "assistant", "user", "system", "tool", "", None]),
                         rng.choice(["Yes.", "Yes.", f"No {i}!", f"so {i}", "", " \t", None, f"Why {i}?", f"Good {i}. \n"])))
    return rows


@pytest.mark.parametrize("size", [2, 256])
def test_repair_of_random_conversations(spark, size):
    rows = _random_rows(random.Random(size), 60, 14)
    rows += rows[:5]
    assert _repaired(spark, rows, size) == _plain(rows)


@pytest.fixture
def uncoalesced(spark):
    """Small range partitions stay apart, as large ones do."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


def test_a_long_conversation_is_shared_by_tasks(spark, uncoalesced):
    rows = [(7, t, r, x) for _, t, r, x in _random_rows(random.Random(9), 40, 14)]
    rows += [(7, 5, "user", "Again.")] * 50 + [(8, 1, "user", "Hi."), (8, 2, "assistant", "Hello.")]
    want = _plain(rows)
    for size in (3, 7):
        assert _repaired(spark, rows, size) == want
    cut = conversation_repair.segments(conversation_repair.marked_rows(spark.createDataFrame([(*r, "x", 1) for r in rows], CONV)), 4)
    assert cut.where("conv = 7").select("part").distinct().count() > 3


def test_repair_literal_cases(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "user", "U?"), (1, 2, "assistant", "A."),
            (2, 0, "user", "U?"), (3, 0, "assistant", "A."), (3, 1, "user", "U."),
            (4, 0, "user", "cut"), (4, 1, "assistant", "A."), (5, 0, "system", "S."), (6, None, "user", None)]
    got = {k: v[5:7] for k, v in _repaired(spark, rows).items()}
    assert got == {1: (0, "KKK"), 2: (2, "D"), 3: (2, "RR"), 4: (4, "DD"), 5: (2, "D"), 6: (2, "D")}
    assert _repaired(spark, []) == {}


def test_lightest_inserts_where_a_state_must_be_reached():
    assert conversation_repair.lightest([("u", None, 1)], conversation_repair.ASSISTANT, {conversation_repair.ASSISTANT}) == {
        conversation_repair.ASSISTANT: (2, "D")}
    assert conversation_repair.lightest([], conversation_repair.USER, {conversation_repair.START, conversation_repair.USER}) == {
        conversation_repair.START: (5, "I"), conversation_repair.USER: (0, "")}


def test_damage(spark):
    rows = [(c, t, r, x) for c in (0, 1, None) for t in (*range(30), None) for r, x in [("assistant", "A. b! c?"), (None, None)]]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], CONV)
    got = {}
    for conv, turn, role, text in conversation_repair.damaged(df).collect():
        got.setdefault(conv, []).append((turn, role, text))
    order = lambda own: sorted(own, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
    assert {c: order(own) for c, own in got.items()} == brute.crc_damaged(rows)


# --- collocations

DOCS = "text string, lang string, rank long, f string"


def _phrases(spark, docs, **options):
    rows = collocations.collocations(spark.createDataFrame([(*d, 1, "x") for d in docs], DOCS), **options).collect()
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in rows)


def _random_texts(rng, n):
    words = ["a", "New", "york", "CITY", "of", "é", "İ", "x\x00y", "z z", "\x1f", "ab"]
    seps = [" ", " ", " ", "\t ", ". ", ",", "\n", "\x0b", " ! "]
    return ["".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("ranks, table", [(0, 0), (3, 0), (3, 10 ** 6), (2048, 0), (2048, 10 ** 6), (0, 10 ** 6)])
def test_collocations_of_random_texts(spark, ranks, table):
    rng = random.Random(ranks)
    docs = [(t, rng.choice(["en", "fr", None, "und"])) for t in _random_texts(rng, 250)] + [(None, "en"), ("", None), (None, None)]
    docs += docs[:20]
    want = brute.collocations(docs, 30, 4, 25)
    assert want and _phrases(spark, docs, top=25, ranks=ranks, table=table) == want


def test_collocations_literal_cases(spark):
    assert _phrases(spark, []) == []
    assert _phrases(spark, [("a b. a", "en")] * 29) == []
    # the pair goes into the triple that holds four fifths of it; "a a a" holds overlapping pairs
    got = _phrases(spark, [("x y z", "en")] * 40 + [("x y", "en")] * 10 + [("a a a", "de")] * 30)
    assert [(r[0], r[2], r[3]) for r in got] == [("de", "a a", 60), ("de", "a a a", 30), ("en", "x y z", 40)]
    assert got == brute.collocations([("x y z", "en")] * 40 + [("x y", "en")] * 10 + [("a a a", "de")] * 30)


def test_scores_beyond_64_bits(spark):
    row = spark.createDataFrame([(10 ** 17, [10 ** 18, 10 ** 17], [3, 10 ** 17])], "f long, heads array<long>, tails array<long>")
    cut = row.select(collocations.weakest_cut(2000000)).first()[0]
    assert (cut["score"], cut["k"], cut["l"], cut["r"]) == (2000000 * 10 ** 17 // (10 ** 18 + 3), 1, 10 ** 18, 3)


@pytest.mark.parametrize("by_rank", [True, False])
def test_tally_counts_what_a_plain_count_counts(by_rank):
    rng = np.random.default_rng(1)
    ids = np.unique(rng.integers(0, 2 ** 63, 3000, dtype=np.uint64))
    rng.shuffle(ids)
    left, right = ids[rng.zipf(1.3, 50000) % len(ids)], ids[rng.zipf(1.3, 50000) % len(ids)]
    symbols = collocations.Symbols(ids) if by_rank else collocations.Symbols(ids[:700], np.full(64, 2 ** 64 - 1, dtype=np.uint64))
    tally = collocations.Tally(symbols)
    a, b = symbols.told(left), symbols.told(right)
    batches = [x for i in range(0, 50000, 5000) for x in tally.add(a[i:i + 5000], b[i:i + 5000])] + list(tally.rest())
    got = {}
    for batch in batches:
        for *pair, n in zip(*[c.to_pylist() for c in batch.columns]):
            key = (int(ids[pair[0] >> 32]), int(ids[pair[0] & 0xFFFFFFFF])) if by_rank else tuple(np.array(pair, dtype=np.int64).view(np.uint64).tolist())
            got[key] = got.get(key, 0) + n
    pairs, n = np.unique(np.column_stack((left, right)), axis=0, return_counts=True)
    assert got == {(int(a), int(b)): int(k) for (a, b), k in zip(pairs, n)}


# --- pieces

@pytest.fixture(scope="module")
def model():
    return pieces.read_model(pieces.MODEL)


PARTS = [" ", "  ", "▁", "a", "the", "é", "漢", "🙂", "\n", "\t", "\0", "</s>", "<s>", "<unk>", "<0x0A>", " ", "　", " of", "ing", "\r", "​", "﻿"]


def _lists(found):
    ids, bounds = found
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]


def test_chunks_give_the_ids_of_whole_texts(model):
    rng = random.Random(2)
    whole, table = sentencepiece.SentencePieceProcessor(model_proto=model), pieces.ChunkTable(model, 500)
    assert pieces.cuts_at_marks(model) and not table.whole
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(15))) for _ in range(4000)]
    texts += [" ", "▁", "", " " * 200_000 + "a", "a" * 100_000, "\0" * 99, "ab " * 50_000]
    for i in range(0, len(texts), 100):
        assert _lists(table.encode(pa.array(texts[i:i + 100]))) == whole.encode(texts[i:i + 100])
    assert _lists(table.encode(pa.array([], pa.string()))) == []


def test_encode_and_decode_columns(spark, model):
    whole = sentencepiece.SentencePieceProcessor(model_proto=model)
    rows = [(1, "Hello  world ", "x", "kept"), (2, None, "y", None), (3, "", "z", ""), (4, "▁a\0漢", None, "k"), (4, "▁a\0漢", None, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, token_ids string, `a.b` string")
    out = pieces.encode(df, model, bos=True)
    assert out.columns == ["doc_id", "text", "a.b", "token_ids"]
    got = [(r["text"], r["a.b"], list(r["token_ids"]), r["decoded"]) for r in pieces.decode(out, model).orderBy("doc_id").collect()]
    assert got == [(t, k, whole.encode(t or "", add_bos=True, add_eos=True), whole.decode(whole.encode(t or "", add_bos=True, add_eos=True))) for _, t, _, k in rows]
    odd = spark.createDataFrame([([5, None, -1, 32000, 13],), (None,), ([],)], "token_ids array<long>")
    assert [r["decoded"] for r in pieces.decode(odd, model).collect()] == [whole.decode([5, 0, 0, 0, 13]), "", ""]
    assert pieces.encode(df.limit(0), model).count() == 0


def test_other_models_are_encoded_whole(model, monkeypatch):
    monkeypatch.setattr(pieces, "cuts_at_marks", lambda m: False)
    whole, table = sentencepiece.SentencePieceProcessor(model_proto=model), pieces.ChunkTable(model)
    assert _lists(table.encode(pa.array(["a b", "", "c"]))) == whole.encode(["a b", "", "c"])
