"""Language, quality classifier and its statistics against versions that use nothing of the package."""

import math
import os
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from oracle import TESTDATA

from tillworks.llm import quality_discriminant
from tillworks.llm.queries import QUERIES
from tillworks.sources.tables import table

SF = f"{TESTDATA}/sf{os.environ.get('TILLWORKS_SF', '0.001')}"
BLANK = b"\t\n\x0b\x0c\r "


def training(doc):
    return zlib.crc32(str(doc).encode()) % 4 != 2


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text", "lang").collect()]


# --- quality

def statistics(text):
    raw = (text or "").encode()
    words, own = [], bytearray()
    for b in raw + b" ":
        if b in BLANK:
            if own:
                words.append(bytes(own))
            own = bytearray()
        else:
            own.append(b)
    n, chars = len(words), max(1, sum(b not in BLANK for b in raw))
    share = lambda kind: math.sqrt(sum(b in kind for b in raw) / chars)
    count, pairs = Counter(words), Counter(zip(words, words[1:]))
    return [math.log1p(n), math.log1p(chars / max(n, 1)) * (n > 0), share(b"#*$%&|<>"), share(bytes(range(65, 91))), share(bytes(range(48, 58))),
            share(b"!?.,;:"), math.sqrt(raw.count(10) / max(n, 1)), math.log1p(n) - math.log1p(len(count)),
            math.sqrt(max(count.values(), default=0) / max(n, 1)), math.sqrt((max(n - 1, 0) - len(pairs)) / max(n, 1))]


def test_statistics(docs):
    texts = [t for _, t, _ in docs[:60]] + ["", None, " \n\t", "a a a a", "É É\x0bß 12 #$", "x" * 10_000, "a b a b a b\n\n"]
    got = quality_discriminant.statistics(pa.array(texts, pa.string()))
    assert np.allclose(got, [statistics(t) for t in texts], atol=1e-12)


def test_scores_are_those_of_shrunk_densities(spark, docs):
    labels = {(r["doc_id"], r["quality"]) for r in table(spark, SF, "labels").collect() if r["quality"] in (0, 1) and training(r["doc_id"])}
    x = {doc: np.array(statistics(text)) for doc, text, _ in docs}
    own = {k: np.array([x[d] for d, q in labels if q == k and d in x]) for k in (0, 1)}
    spread = {k: (v - v.mean(axis=0)).T @ (v - v.mean(axis=0)) for k, v in own.items()}
    common = (spread[0] + spread[1]) / (len(own[0]) + len(own[1]))
    eye = np.eye(len(common)) * max(np.trace(common) / len(common), 1e-6)
    density = {}
    for k in (0, 1):
        cov = 0.99 * (0.9 * spread[k] / len(own[k]) + 0.1 * common) + 0.01 * eye
        inverse, half = np.linalg.inv(cov), np.linalg.slogdet(cov)[1] / 2
        density[k] = {d: -0.5 * (v - own[k].mean(axis=0)) @ inverse @ (v - own[k].mean(axis=0)) - half for d, v in x.items()}
    odds = math.log(len(own[1]) / len(own[0]))
    got = {r["doc_id"]: r for r in QUERIES["op4_quadratic_discriminant"](spark, SF).collect()}
    assert set(got) == set(x)
    for d, r in got.items():
        score = 1 / (1 + math.exp(-max(-500, min(500, density[1][d] - density[0][d] + odds))))
        assert r["score"] == pytest.approx(score, abs=1e-6) and r["held_out"] == (not training(d))
        assert abs(score - 0.7) < 1e-6 or r["predicted"] == (score >= 0.7)


# --- language

def letter_grams(text):
    """Each letter, in lower case where that is one letter, between its neighbours; None for what is no letter."""
    folded = [(c.lower() if len(c.lower()) == 1 else c) if unicodedata.category(c)[0] == "L" else None for c in text or ""]
    padded = [None, *folded, None]
    return [tuple(padded[i:i + 3]) for i in range(len(folded)) if padded[i + 1] is not None]


def test_languages_are_those_of_exact_gram_sets(spark, docs):
    count = {}
    for doc, text, lang in docs:
        if training(doc) and lang is not None:
            count.setdefault(lang, Counter()).update(letter_grams(text))
    known = {lang: {g for g, n in c.items() if n >= sum(c.values()) * 2e-5} for lang, c in count.items()}
    got = {r["doc_id"]: r for r in QUERIES["op1_bitmask_filters"](spark, SF).collect()}
    for doc, text, _ in docs:
        own = letter_grams(text)
        r = got[doc]
        if not own:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        shares = sorted(((sum(g in grams for g in own) / len(own), lang) for lang, grams in known.items()), reverse=True)
        assert abs(r["score"] - dict((x, s) for s, x in shares)[r["lang_pred"]]) < 0.02
        assert r["lang_pred"] == shares[0][1] or shares[0][0] - dict((x, s) for s, x in shares)[r["lang_pred"]] < 0.02
