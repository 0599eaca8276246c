"""Repeated passages go to their last sentence: against all runs of sentences, not the shortest ones."""

import random

import brute

from tillworks.llm import sentence_dedup


def all_runs(docs):
    """[(id, n_removed, text)]"""
    return [(doc, gone, text) for doc, _, gone, text in brute.without_repeats(docs)]


def cleaned(spark, docs):
    rows = sentence_dedup.without_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    return sorted((r["id"], r["n_removed"], r["text"]) for r in rows)


def sentence(name, n):
    return " ".join(f"{name}{i}" for i in range(n)) + "."


def test_short_last_sentences_go_with_their_passage(spark):
    passage = " ".join(sentence(c, n) for c, n in zip("abcd", (20, 20, 20, 4)))
    docs = [(1, passage), (2, f"{passage} {sentence('tail', 5)}"), (3, f"{sentence('head', 5)} {passage}")]
    got = cleaned(spark, docs)
    assert got == [(1, 0, passage), (2, 4, f" {sentence('tail', 5)}"), (3, 4, sentence("head", 5))]
    assert got == all_runs(docs)


def test_spans_cover_what_all_runs_cover(spark):
    rng = random.Random(5)
    known = [sentence(f"s{k}x", rng.choice((1, 3, 8, 12, 20, 26, 45))) for k in range(60)]
    docs = []
    for doc in range(60):
        parts = []
        for _ in range(rng.randint(1, 5)):
            at = rng.randrange(len(known))
            parts += known[at:at + rng.randint(1, 7)] + [sentence(f"own{doc}y{rng.randrange(10**6)}z", rng.randint(1, 9))]
        docs.append((doc, " ".join(parts)))
    assert cleaned(spark, docs) == sorted(all_runs(docs))
