"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, for every operator and stage."""

import base64
import gzip
import hashlib
import random
import re
import zlib
from urllib.parse import quote

import brute
import numpy as np
import pytest

import corpus_pipeline
from tillworks.llm import (chat, decontamination, language_bitmask, licenses, mixing, quality_discriminant, quality_rules, secrets,
                           sentence_dedup, set_join, text)
from tillworks.llm.queries import mix_levels, mix_weights
from tillworks.llm.text import is_training

PASSAGE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from the old oak tree near the quiet river bank tonight"
LONG = " ".join(f"w{i % 977}x{i % 1009}" for i in range(60_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, n_words int, _t string, id string, row int, stats int, mix int, _qstats int"


def rows_of(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    data = [(i, t, "en", "src1", len(t or ""), -1, "x", "y", 7, 8, 9, 10) for i, t in zip(ids, texts)]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Null and empty texts, one word, blanks, non-ASCII, a very long text, repeated rows, a null id, null language and source."""
    near = PASSAGE + " " + " ".join(f"tail{i}" for i in range(40))
    texts = [None, "", "word", " \t\n ", "Ünïcode wörd ÄÖ 日本 語", LONG, PASSAGE, near, near + " more", near, None, "!!! ... ???"]
    ids = [0, 1, 2, 3, 4, 5, 6, 7, 8, 7, None, 11]
    data = [(i, t, None if k == 4 else "en", None if k == 5 else "src1", None, 1, "x", "y", 1, 1, 1, 1) for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, PASSAGE), (2, "lazy dog"), (3, None), (4, ""), (None, PASSAGE), (2, "lazy dog")], "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(7, 1, 0), (7, 1, 0), (6, 0, 0), (None, 1, None), (8, None, 1), (99, 0, 0)], "doc_id long, quality int, toxic int")


# --- decontamination

def test_windows_of_short_and_null_items(spark, odd, items):
    got = sorted(tuple(r) for r in decontamination.benchmark_hits(odd, items).select("id", "n_words", "n_hit", "items").collect() if r["n_hit"])
    n = len(PASSAGE.split())
    assert [(r[0], r[1], r[2], tuple(r[3])) for r in got] == [(6, n, n, ("1", "2")), (7, n + 40, n, ("1", "2")), (7, n + 40, n, ("1", "2")),
                                                              (8, n + 41, n, ("1", "2"))]


def test_hits_equal_brute_force_on_mixed_spans(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"v{i}" for i in range(12)]
    items = [(i, " ".join(rng.choice(vocabulary, rng.integers(1, 40)))) for i in range(30)]
    docs = []
    for d in range(60):
        a, b = items[int(rng.integers(30))][1].split(), items[int(rng.integers(30))][1].split()
        docs.append((d, " ".join(list(rng.choice(vocabulary, 9)) + a[:int(rng.integers(1, len(a) + 1))] + ["zz"] + b)))
    got = decontamination.benchmark_hits(rows_of(spark, [t for _, t in docs]), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in got) == brute.decontaminated(docs, items)


def test_winnowing_meets_in_every_shared_span():
    rng = np.random.default_rng(5)
    for _ in range(200):
        shared = rng.integers(0, 6, 13).astype(np.uint64)
        a, b = (np.concatenate((rng.integers(0, 6, rng.integers(0, 9)).astype(np.uint64), shared, rng.integers(0, 6, rng.integers(0, 9)).astype(np.uint64)))
                for _ in range(2))
        one, two = (set(text.run_hashes(x, 5)[decontamination.winnow(text.run_hashes(x, 5), 9)].tolist()) for x in (a, b))
        assert one & two


def test_decontamination_of_nothing(spark, odd, empty, items):
    assert decontamination.benchmark_hits(empty, items).count() == 0
    assert all(r["n_hit"] == 0 for r in decontamination.benchmark_hits(odd, items.limit(0)).collect())
    assert decontamination.without_contaminated(odd, items.limit(0)).count() == odd.count()
    kept = decontamination.without_contaminated(odd, items)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == [1, 2, 3, 4, 5, 11]


# --- quality rules

def test_statistics_of_odd_texts(spark, odd):
    got = quality_rules.with_statistics(odd, "text", "q").select("doc_id", "text", "q.*").collect()
    assert len(got) == odd.count()
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute.statistics(r["text"])[:5]


def test_repeated_windows_and_lines(spark):
    texts = ["a b c d e f g h " * 2, "a " * 30, "x\nx\n\n \nx y\nx y\r\nx y", "one two\n" * 5, "\x0b a\x0cb \x1f c d", "# * $ % & | < > #"]
    for r in quality_rules.with_statistics(rows_of(spark, texts), "text", "q").select("text", "q.*").collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute.statistics(r["text"])[:5], r["text"]


def test_rules_without_labels_keep_all(spark, odd, empty, labels):
    rows, learned = quality_rules.judged(odd, labels.limit(0))
    assert learned.rules == () and all(r[0] != r[1] for r in rows.select(f"{rows.columns[-1]}.kept", f"{rows.columns[-1]}.base_failed").collect())
    assert quality_rules.keep_good(empty, labels).collect() == []
    assert quality_rules.keep_good(odd, labels).columns == odd.columns


def test_rules_are_grown_and_cut_back(spark):
    rng = np.random.default_rng(1)
    data = [(float(x), float(y), int(not (x > 0.7 and y > 0.5)), bool(i % 3 == 0)) for i, (x, y) in enumerate(rng.random((3000, 2)))]
    learned = quality_rules.learn_decision_list(spark.createDataFrame(data, "x double, y double, label int, prune boolean"), ["x", "y"])
    first = {c.statistic: c for c in learned.rules[0]}
    assert first["x"].at_least and abs(first["x"].threshold - 0.7) < 0.08 and first["y"].at_least and abs(first["y"].threshold - 0.5) < 0.08
    assert str(learned).startswith("reject if ")


# --- n-gram Jaccard join

def test_join_of_odd_rows(spark, odd, empty):
    got = {(r["id"], r["key"]): (r["first_id"], r["copies"], r["n_links"]) for r in set_join.jaccard_classes(odd).collect()}
    by_id = {k[0]: v for k, v in got.items()}
    assert by_id[7] == (7, 2, 1) and by_id[8] == (7, 1, 1) and by_id[6] == (6, 1, 0) and by_id[0] == (0, 1, 0)
    assert set_join.jaccard_classes(empty).collect() == []
    kept = set_join.one_of_each(odd)
    assert kept.columns == odd.columns and sorted((r["doc_id"] for r in kept.collect()), key=str) == [0, 1, 11, 2, 3, 4, 5, 6, 7, None]


def test_join_of_many_copies_and_one_large_group(spark):
    """More near copies than a block holds: links and groups as by brute force."""
    rng = np.random.default_rng(7)
    base = [f"b{i}" for i in range(120)]
    texts = ["same words here and there " * 3] * 300
    for i in range(600):
        own = list(base)
        own[int(rng.integers(120))] = f"n{i}"
        texts.append(" ".join(own))
    for i in range(200):
        texts.append(" ".join(base[:3] + [f"u{i}_{j}" for j in range(60)]))
    docs = list(enumerate(texts))
    got = {r["id"]: (r["first_id"], r["n_links"]) for r in set_join.jaccard_classes(rows_of(spark, texts)).collect()}
    assert got == {doc: (first, n) for doc, first, n in brute.jaccard_classes(docs)}


def test_walk_meets_pairs_at_the_threshold():
    rng, met, n = np.random.default_rng(2), 0, 300
    runs = set_join.runs_for(set_join.RECALL)
    for _ in range(n):
        common = rng.integers(0, 2 ** 63, 400).astype(np.uint64)
        a, b = (set_join.sketch(np.unique(np.concatenate((common, rng.integers(0, 2 ** 63, 50).astype(np.uint64)))) * np.uint64(2), 64) for _ in range(2))
        nodes = [set(set_join.children(np.full(1, r + 1, np.uint64), x[None, :], 0.8)[1].tolist()) for r in range(runs) for x in (a, b)]
        met += any(x & y for x, y in zip(nodes[::2], nodes[1::2]))
    assert met / n >= 0.99


# --- sentence spans

def test_spans_of_odd_rows(spark, odd, empty):
    repeated = "One first sentence that has a good many words in it for sure. And a second sentence follows that has as many words again, friend."
    texts = [None, "", repeated, f"Intro line here. {repeated} Outro.", f"{repeated}\n{repeated}", "no marks at all " * 5, LONG]
    want = {doc: (n, gone, rest) for doc, n, gone, rest in brute.without_repeats(list(enumerate(texts)))}
    got = {r["id"]: (r["n_sentences"], r["n_removed"], r["text"]) for r in sentence_dedup.without_repeats(rows_of(spark, texts)).collect()}
    assert got == want and got[3][1] == 2 and got[4][2] == "\n" and got[2][1] == 0
    assert sentence_dedup.without_repeats(odd).count() == odd.count() and sentence_dedup.without_repeats(empty).count() == 0


def test_repeated_rows_are_one_document(spark):
    passage = "A sentence of quite some words stands here for all to see. Another sentence of many words comes right behind it, as it really should do."
    got = sentence_dedup.without_repeats(rows_of(spark, [passage, passage, passage], [1, 1, 2])).collect()
    assert sorted((r["id"], r["n_removed"]) for r in got) == [(1, 0), (1, 0), (2, 2)]


# --- secrets

KEY = "AKIA" + "ABCDEFGH12345678"
SECRET = "password = hunter2secret"


@pytest.mark.parametrize("hidden", [
    quote(SECRET, safe=""), quote(quote(SECRET, safe=""), safe=""), "".join(f"\\u{ord(c):04x}" for c in SECRET),
    "".join(f"&#{ord(c)};" for c in SECRET), base64.b64encode(SECRET.encode()).decode(), base64.b64encode(gzip.compress(SECRET.encode())).decode(),
    base64.urlsafe_b64encode(zlib.compress(SECRET.encode())).decode(), base64.b64encode(base64.b64encode(base64.b64encode(SECRET.encode()))).decode(),
    quote(base64.b64encode(gzip.compress(base64.b64encode(SECRET.encode()))).decode(), safe="")])
def test_hidden_secrets_map_to_where_they_stand(hidden):
    whole = f"Some words before {hidden} and after."
    spans, complete = secrets.secret_spans(whole)
    at = whole.index(hidden)
    found = [s for s in spans if s[0] == "assign"]
    assert complete and found and all(at - 1 <= s and e <= at + len(hidden) for _, s, e, _ in found)
    assert secrets.secret_spans(secrets.redacted(whole, spans))[0] == [] and secrets.redacted(whole, spans).startswith("Some words before ")


def test_spans_point_at_escaped_characters():
    whole = f"x token%3D{'a' * 8} y \\u0041KIA{'Q' * 16} z"
    spans = {(k, whole[s:e]) for k, s, e, _ in secrets.secret_spans(whole)[0]}
    assert ("assign", f"token%3D{'a' * 8}") in spans and ("access", f"\\u0041KIA{'Q' * 16}") in spans


def test_base_patterns():
    cases = ["token: abcde", "TOKEN='abcdef'", "api-key=1234567", 'api_key" : "1234567', f"x{KEY}yz {KEY}{KEY}", "AKIA123", "f" * 23 + " " + "0" * 24,
             "ſecret = abcdefgh", "toKen = abcdefgh", "password=password=abcdef", "secret:token:abcdef", None, ""]
    for case in cases:
        got = [(k, s, e) for k, s, e, base in secrets.secret_spans(case or "")[0] if base]
        assert got == brute.base_secrets(case), case


def test_worklist_ends():
    nested = SECRET
    for _ in range(12):
        nested = base64.b64encode(nested.encode()).decode()
    assert any(k == "assign" for k, *_ in secrets.secret_spans(nested)[0])
    bomb = base64.b64encode(gzip.compress(b"\0" * 1_000_000)).decode()
    assert secrets.secret_spans(f"{bomb} {KEY}", most=10_000) == ([("access", len(bomb) + 1, len(bomb) + 21, True)], False)
    assert secrets.secret_spans("%25" * 200)[0] == [] and secrets.secret_spans("\\ud83d\\ude00 \\ud83d &#99999999;")[0] == []


def test_secrets_of_odd_rows(spark, odd, empty):
    assert secrets.scan_secrets(odd).count() == odd.count() and secrets.scan_secrets(empty).count() == 0
    out = secrets.redact_secrets(odd)
    assert out.columns == odd.columns and sorted(map(str, out.collect())) == sorted(map(str, odd.collect()))
    spoiled = secrets.redact_secrets(rows_of(spark, [f"a {SECRET} b {KEY}", None])).collect()
    assert sorted((r["text"] or "") for r in spoiled) == ["", f"a {secrets.REDACTED} b {secrets.REDACTED}"]


# --- mixing

def mixed(spark, rows, weights, share, epochs=2):
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string, lang string, source string")
    from pyspark.sql import functions as F
    levels = {"d": F.col("domain"), "l": F.col("lang"), "s": F.col("source")}
    own = [mixing.weight_of("d", weights, 1), F.lit(1).cast("long"), F.lit(1).cast("long")]
    return mixing.mixture(docs, levels, own, budget_share=share, max_epochs=epochs).collect()


def test_shortage_goes_to_siblings_first(spark):
    """In domain a one language is short: the other language of a takes over, b's part stays as it was."""
    rows = [(i, "w " * 100, "a", "en", "s1") for i in range(20)] + [(100 + i, "w " * 10, "a", "de", "s2") for i in range(10)]
    rows += [(200 + i, "w " * 100, "b", "en", "s3") for i in range(40)]
    took = {}
    for r in mixed(spark, rows, {}, 0.5, 1):
        took[r["source"]] = took.get(r["source"], 0) + r["mix"]["tokens"] * r["mix"]["epochs"] + r["mix"]["part_tokens"]
    assert took == {"s1": 1425, "s2": 100, "s3": 1525}


def test_shortage_of_a_domain_goes_to_others(spark):
    rows = [(i, "w " * 10, "a", "en", "s1") for i in range(5)] + [(200 + i, "w " * 100, "b", "en", "s3") for i in range(40)]
    took = {}
    for r in mixed(spark, rows, {"a": 9}, 0.5, 2):
        took[r["source"]] = took.get(r["source"], 0) + r["mix"]["tokens"] * r["mix"]["epochs"] + r["mix"]["part_tokens"]
    assert took == {"s1": 100, "s3": 1925}


def test_prefix_ends_inside_a_document_and_ties_share(spark):
    rows = [(1, "w " * 10, "a", None, None)] * 4
    got = mixed(spark, rows, {}, 0.5, 1)
    assert [r["mix"]["part_tokens"] for r in got] == [5, 5, 5, 5]
    got = mixed(spark, [(i, "w " * 10, "a", "en", "s") for i in range(7)], {}, 0.5, 1)
    assert sum(r["mix"]["part_tokens"] for r in got) == 35 and all(r["mix"]["epochs"] == 0 for r in got)


def test_mixture_of_odd_rows(spark, odd, empty):
    got = mixing.mixture(odd, mix_levels(), mix_weights(), budget_share=1.0, max_epochs=3)
    assert got.columns[:-1] == odd.columns and "mix" in odd.columns and got.columns[-1] != "mix"
    assert all((r["text"] or "").strip() for r in got.collect())
    assert mixing.mixture(empty, mix_levels(), mix_weights()).collect() == []
    assert mixing.mixture(odd, mix_levels(), mix_weights(), budget_share=0.0).collect() == []


# --- licences

def test_licence_rules_claim_in_order(spark):
    mit = ("MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
           "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
           "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
           "subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or "
           "substantial portions of the Software.")
    texts = ["Nice.\nReleased under the MIT License.", mit, "Licensed under the Apache License, Version 2.0. Released under the MIT License.",
             "SPDX-License-Identifier: Apache-2.0\ncode", "Some licence nobody knows.", None, "", "plain text", "Licensed under CC BY-NC 4.0.\n" * 3]
    got = {r["doc_id"]: r for r in licenses.scan_licences(rows_of(spark, texts)).collect()}
    assert [got[i]["licences"] for i in range(9)] == ["MIT", "MIT", "Apache-2.0,MIT", "Apache-2.0", "", "", "", "", "CC-BY-NC-4.0"]
    assert got[1]["sentence_ids"] == "mit_title,mit_grant,mit_notice" and got[4]["n_unknown"] == 1


def test_known_sentences_are_normal_and_reachable(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(s,) for s in licenses.SENTENCES], "s string")
    assert all(r[0] == r[1] and r[2] for r in rows.select("s", licenses.normalised(F.col("s")), F.col("s").rlike(licenses.ANY_WORD)).collect())
    assert {i for _, ids in licenses.RULES for i in ids} <= set(licenses.SENTENCES.values())


def test_licences_of_odd_rows(odd, empty):
    assert licenses.scan_licences(odd).count() == odd.count() and licenses.scan_licences(empty).count() == 0


# --- language

def test_language_of_odd_rows(spark, odd, empty):
    rows = rows_of(spark, ["the cat and the dog", "der hund und die katze", "the hat", "das haus und der baum"] * 5).drop("lang")
    from pyspark.sql import functions as F
    model = language_bitmask.learn(rows.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("de")))
    assert model.languages == ("de", "en")
    got = {r["doc_id"]: r for r in language_bitmask.identify(rows_of(spark, ["the cat", "der baum und", None, "", "123 !!", "ΩΨΧ", "THE DOG"]), model).collect()}
    assert [got[i]["lang_pred"] for i in range(7)] == ["en", "de", "und", "und", "und", "de", "en"] and got[5]["score"] == 0
    assert language_bitmask.identify(odd, model).count() == odd.count()
    none = language_bitmask.learn(empty)
    assert {r["lang_pred"] for r in language_bitmask.identify(odd, none).collect()} == {"und"}


def test_filter_has_no_false_negatives_and_corrects_false_positives(spark):
    model = language_bitmask.LanguageModel(("a", "b"), (np.full(language_bitmask.SLOTS, 2, np.uint64),), np.array([0.0, 1.0]))
    keys = np.arange(10, dtype=np.uint64)
    assert model.shares(keys, np.array([0, 10])).tolist() == [[0.0, 0.0]]  # a filter that holds everything tells nothing


# --- quality classifier

def test_discriminant_of_odd_rows(spark, odd, empty):
    vectors = quality_discriminant.with_vectors(odd)
    rows = vectors.collect()
    assert len(rows) == odd.count() and all(len(r["x"]) == len(quality_discriminant.STATISTICS) and np.isfinite(r["x"]).all() for r in rows)
    assert all(not any(r["x"]) for r in rows if r["id"] in (0, 1, None))
    assert {r["score"] for r in quality_discriminant.scored(vectors, None).collect()} == {0.5}
    assert quality_discriminant.with_vectors(empty).count() == 0


def test_discriminant_equals_the_densities():
    rng = np.random.default_rng(0)
    d = 3
    parts = {0: rng.normal(0, 1, (400, d)), 1: rng.normal(1, 2, (600, d))}
    moments = {k: (float(len(x)), x.sum(axis=0), x.T @ x) for k, x in parts.items()}
    model = quality_discriminant.fit(moments, 0.0, 0.0)
    x = rng.normal(0, 2, (50, d))
    logs = []
    for k in (0, 1):
        mean, cov = parts[k].mean(axis=0), np.cov(parts[k].T, bias=True)
        z = x - mean
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z) - 0.5 * np.log(np.linalg.det(cov)) + np.log(len(parts[k])))
    assert np.allclose(model.score(x), 1 / (1 + np.exp(logs[0] - logs[1])))
    assert quality_discriminant.fit({0: moments[0]}) is None


# --- chat

def test_control_strings_in_texts(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>assistant<|im_sep|>mine", "<\\/s> <\\\\|im_sep|>", "<<SYS>> <</SYS>> <s>", "<|endoftext|>",
             "\n\n  leading", "trailing \n", "", None, "日本語 😀 é", "[[INST]]", "a\\"]
    data = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(nasty)] + [(2, i, "assistant", t) for i, t in enumerate(nasty)]
    data += [(3, 0, None, "hello"), (3, 0, "assistant", "same turn"), (None, None, "<|im_sep|>odd\nrole", "x"), (4, 0, "system", "s")]
    rows = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(rows).collect()
    for r in formatted:
        own = sorted([(d[1], d[2] or "", d[3] or "") for d in data if d[0] == r["conv_id"]], key=lambda x: (x[0] or 0, x[1], x[2]))
        assert chat.read_back(r["formatted"]) == [(a, b) for _, a, b in own]
        assert "".join(chat.unescape(r["formatted"][s["start"]:s["end"]]) for s in r["loss_spans"]) == "".join(t for _, a, t in own if a == "assistant")
        assert len(r["token_ids"]) == len(r["loss_mask"])
        assert r["formatted"].count("</s>") == 0 and r["formatted"].count(chat.END) == len(own)
    assert chat.format_conversations(rows.limit(0)).count() == 0


def test_offsets_cover_the_text_and_agree_with_another_library():
    import os

    from tokenizers import Tokenizer

    own = Tokenizer.from_file(os.path.join(os.path.dirname(chat.TOKENIZER), "byte_bpe_50k.json"))
    for sample in ("Hello  world, it's 2024!\n\n ok", "日本語 😀 é and Ünïcode\t tabs   ", "", "a"):
        ids, offsets = chat.encode(sample, chat.TOKENIZER)
        other = own.encode(sample, add_special_tokens=False)
        assert ids.tolist() == other.ids and [tuple(x) for x in offsets.tolist()] == other.offsets
    whole, spans = chat.render([("user", "x"), ("assistant", " y\n")])
    ids, offsets = chat.encode(whole, chat.TOKENIZER)
    assert offsets[0][0] == 0 and offsets[-1][1] == len(whole) and (offsets[1:, 0] == offsets[:-1, 1]).all()
    assert [whole[s:e] for s, e in chat.masked_spans(offsets, chat.aligned(offsets, spans))] == [" y\n"]


def test_spans_are_found_by_search():
    offsets = np.array([[0, 2], [2, 5], [5, 5], [5, 7], [7, 9], [8, 10]])
    assert chat.aligned(offsets, np.array([[2, 7], [8, 10]])).tolist() == [False, True, False, True, False, True]
    assert chat.aligned(offsets, np.zeros((0, 2), int)).tolist() == [False] * 6
    assert chat.masked_spans(np.array([[2, 5], [5, 7], [8, 9], [8, 9]]), np.ones(4, bool)) == [(2, 7), (8, 9)]


# --- shared

def test_training_rows(spark):
    import zlib as z

    got = spark.range(50).withColumn("t", is_training("id")).collect()
    assert all(r["t"] == (z.crc32(str(r["id"]).encode()) % 4 != 2) for r in got)


def test_stages_take_odd_and_empty_documents(spark, odd, empty, tmp_path):
    for name, schema in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns[:len(docs.columns)] == docs.columns, name
            out.count()


def test_long_runs_of_blanks_keep_their_tokens(monkeypatch):
    encoding, piece, _ = chat.load_tokenizer(chat.TOKENIZER)
    plain = lambda t: encoding.encode(t, allowed_special={chat.START, chat.SEP, chat.END}, disallowed_special=())
    rng = random.Random(3)
    parts = [" ", "   ", "\n", "\n\n\n", "\t\t\t\t", "a", "word", " x", "'s", "1", "^^", chat.END, chat.START, "\x85", "　　　", "\x1c\x1d\x1e", "é"]
    with monkeypatch.context() as m:
        m.setattr(chat, "_LONG", re.compile(f"[{chat.BLANK}]{{3,}}"))
        for _ in range(5000):
            text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
            assert chat._ids(text, encoding, piece) == plain(text)
    for text in (" " * 300_000 + "a", "\n" * 300_000 + chat.END + "b"):
        assert chat._ids(text, encoding, piece) == plain(text)


@pytest.mark.parametrize("blank", [" ", "\t", "\n"])
def test_five_million_blanks_in_a_text(spark, blank):
    text = blank * 5_000_000 + "end"
    rows = spark.createDataFrame([(1, 0, "user", "x"), (1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    out = chat.digests(chat.format_conversations(rows)).first()
    assert (out["loss_chars"], out["loss_sha256"]) == (len(text), hashlib.sha256(text.encode()).hexdigest())


def test_a_passage_in_many_items_and_documents(spark):
    """Rows in proportion to both, not to their product: items that share a passage are one row of the join."""
    n = 600
    items = [(i, f"{PASSAGE} {PASSAGE}" if i % 3 else f"own{i} {PASSAGE} tail{i}") for i in range(n)] + [(None, PASSAGE), (n, "short words"), (n + 1, None)]
    docs = [(i, f"start{i} {PASSAGE} {PASSAGE} end" if i % 2 else f"x{i} {PASSAGE} and short words") for i in range(n)] + [(n, "nothing here")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["id"]: r for r in decontamination.benchmark_hits(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    for doc, n_words, n_hit, found in brute.decontaminated(docs[:4] + docs[-1:], [(i, t) for i, t in items if i is not None]):
        assert (got[doc]["n_words"], got[doc]["n_hit"], tuple(got[doc]["items"])) == (n_words, n_hit, found)
    assert all(len(got[i]["items"]) == len(got[i % 2]["items"]) for i in range(n)) and not got[n]["items"]
