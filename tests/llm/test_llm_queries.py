"""The registered training-data queries on the smallest tables: against SQL, brute force, round trips and held-out rows."""

import hashlib
import os

import brute
import duckdb
import pytest
import sentencepiece
from oracle import TESTDATA, compare, duck

import corpus_pipeline
from tillworks.llm import pieces, quality_rules, secrets
from tillworks.llm.queries import MIX_SQL, ORACLES, QUERIES
from tillworks.sources.tables import table

SF = f"{TESTDATA}/sf{os.environ.get('TILLWORKS_SF', '0.001')}"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r[0], r[1]) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    message, _ = compare(QUERIES[name](spark, SF), duck(SF), ORACLES[name])
    assert message is None, message


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_decontamination_against_brute_force(spark, docs):
    items = [(r[0], r[1]) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    got = {r["doc_id"]: r for r in QUERIES["op2_winnowing"](spark, SF).collect()}
    for doc, n, hit, found in brute.decontaminated(docs, items):
        r = got[doc]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == (n, hit, len(found), brute.sha(",".join(found)))
        assert r["contaminated"] == (hit > 0 and 20 * hit >= n)


def test_quality_rules(spark, docs):
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op3_decision_list"](spark, SF).collect()}
    for doc, text in docs:
        assert got[doc][:6] == brute.statistics(text)
        assert not (got[doc][5] and got[doc][6])
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    assert all(got[d][6] for d, q in labels.items() if q == 1 and not got[d][5])


def test_learned_rules_hold_for_unseen_rows(spark):
    """Learned on two thirds of the labels, judged on the rest."""
    docs, labels = table(spark, f"{TESTDATA}/sf0.01", "documents"), table(spark, f"{TESTDATA}/sf0.01", "labels")
    rows, learned = quality_rules.judged(docs, labels.where("doc_id % 3 <> 0"))
    assert learned.rules and all(1 <= len(r) <= 3 for r in learned.rules)
    stats = rows.columns[-1]
    seen = rows.join(labels.where("doc_id % 3 = 0"), "doc_id").where(f"NOT `{stats}`.base_failed").select(f"{stats}.kept", "quality").collect()
    assert sum(r[0] == (r[1] == 1) for r in seen) / len(seen) > 0.97


def test_set_join_against_brute_force(spark, docs):
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in QUERIES["op8_chosen_path"](spark, SF).collect()}
    assert got == {doc: (first, n) for doc, first, n in brute.jaccard_classes(docs)}


def test_sentence_spans_against_brute_force(spark, docs):
    got = {r["doc_id"]: (r["n_sentences"], r["n_removed"], r["text_sha256"]) for r in QUERIES["op9_sentence_spans"](spark, SF).collect()}
    assert got == {doc: (n, gone, brute.sha(text)) for doc, n, gone, text in brute.without_repeats(docs)}


def test_secrets_against_brute_force(spark, docs):
    got = {r["doc_id"]: r for r in QUERIES["op10_worklist"](spark, SF).collect()}
    for doc, text in docs:
        want = brute.base_secrets(text)
        r = got[doc]
        assert r["base_sha256"] == brute.sha(",".join(f"{k}:{s}:{e}" for k, s, e in want))
        assert [r[f"n_{k}"] for k in secrets.KINDS] == [sum(x[0] == k for x in want) for k in secrets.KINDS]
        assert {f"{k}:{s}:{e}" for k, s, e in want} <= set(r["spans"].split(","))


def test_language_on_held_out_rows(spark):
    sf = f"{TESTDATA}/sf0.01"
    rows = QUERIES["op1_bitmask_filters"](spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"] and r["lang"]]
    assert len(held) > 100 and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.98


def test_quality_classifier_on_held_out_rows(spark):
    sf = f"{TESTDATA}/sf0.01"
    rows = QUERIES["op4_quadratic_discriminant"](spark, sf).join(table(spark, sf, "labels"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 50 and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.93
    bad, good = [r["score"] for r in held if r["quality"] == 0], [r["score"] for r in held if r["quality"] == 1]
    assert sum(b < g for b in bad for g in good) / (len(bad) * len(good)) > 0.95


def test_chat_reads_back(spark):
    want = {}
    for r in sorted(table(spark, SF, "conversations").collect(), key=lambda r: (r["conv_id"], r["turn"], r["role"])):
        want.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    want[-1] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    got = {r["conv_id"]: r for r in QUERIES["op6_offset_masks"](spark, SF).collect()}
    assert set(got) == set(want)
    for conv, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[conv]["n_turns"] == len(turns) and got[conv]["loss_chars"] == len(loss)
        assert got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_pipeline_against_brute_force(spark, docs):
    labels, raw = table(spark, SF, "labels"), table(spark, SF, "documents")
    items = [(r[0], r[1]) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    rows, _ = quality_rules.judged(raw, labels)
    good = {r[0] for r in rows.where(rows[rows.columns[-1]]["kept"]).select("doc_id").collect()}
    left = [d for d in docs if d[0] in good]
    left = [d for d, (_, first, _) in zip(left, brute.jaccard_classes(left)) if d[0] == first]
    left = [d for d, (_, n, hit, _) in zip(left, brute.decontaminated(left, items)) if not (hit and 20 * hit >= n)]
    clean = {}
    for doc, text in left:
        while spans := secrets.secret_spans(text)[0]:
            text = secrets.redacted(text, spans)
        assert not brute.base_secrets(text)
        clean[doc] = text
    facts = {r["doc_id"]: r for r in raw.collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", [(d, t, facts[d]["lang"], facts[d]["source"]) for d, t in clean.items()])
    want = {r[0]: tuple(r[4:]) for r in con.execute(
        f"SELECT doc_id, domain, lang, source, tokens, epochs, part_tokens FROM ({MIX_SQL}) AS x").fetchall()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"]: (r["mix"]["tokens"], r["mix"]["epochs"], r["mix"]["part_tokens"]) for r in got} == want
    assert all(r["text"] == clean[r["doc_id"]] and r["n_chars"] == len(r["text"]) for r in got)


def test_stages_keep_the_columns(spark):
    raw = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, raw, SF).columns == raw.columns


def test_repair_against_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: r for r in QUERIES["op11_lightest_derivation"](spark, SF).collect()}
    damaged = brute.crc_damaged(rows)
    assert set(got) == set(damaged)
    for conv, own in damaged.items():
        *facts, text = brute.repaired(own)
        names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
        assert [got[conv][c] for c in names] == facts and got[conv]["repaired_sha256"] == brute.sha(text)


def test_collocations_against_brute_force(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("text", "lang").collect()]
    got = QUERIES["op12_direct_address_tiling"](spark, SF).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    assert sorted(tuple(r) for r in got) == brute.collocations(docs) and got


def test_pieces_against_the_library(spark, docs):
    whole = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op13_distinct_chunks"](spark, SF).collect()}
    for doc, text in docs:
        ids = whole.encode(text or "", add_eos=True)
        assert got[doc] == (len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(whole.decode(ids)))
