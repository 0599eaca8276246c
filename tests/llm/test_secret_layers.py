"""Secrets in wrapped base64, in later and broken streams, and in decoded layers that are not plain text."""

import base64
import bz2
import gzip
import lzma
import random
import time
import zlib
from urllib.parse import quote

import pytest

from tillworks.llm import secrets

SECRET = "password = hunter2secret"
NOISE = "".join(random.Random(1).choices("abcdefghij klmnop\n", k=3000))
LONG = f"{NOISE}\n{SECRET}\n{NOISE[:500]}".encode()
PACK = [gzip.compress, zlib.compress, bz2.compress, lzma.compress]


def found(text):
    spans, complete = secrets.secret_spans(text)
    return any(k == "assign" for k, *_ in spans), complete


def coded(raw):
    return base64.b64encode(raw).decode()


@pytest.mark.parametrize("pack", PACK)
@pytest.mark.parametrize("width, end", [(76, "\n"), (64, "\r\n"), (50, "\n  ")])
def test_wrapped_base64(pack, width, end):
    for raw in (pack(LONG), LONG[2950:3100]):
        lines = [coded(raw)[i:i + width] for i in range(0, len(coded(raw)), width)]
        whole = f"Before it{end}{end.join(lines)}\nand after"
        assert found(whole) == (True, True)
        spans, _ = secrets.secret_spans(whole)
        assert all(s >= len("Before it") and e <= len(whole) - len("and after") for _, s, e, _ in spans)
        assert secrets.secret_spans(secrets.redacted(whole, spans))[0] == []


@pytest.mark.parametrize("pack", PACK)
def test_all_of_a_stream_is_read(pack):
    assert found(coded(pack(b"nothing here ") + pack(SECRET.encode()))) == (True, True)
    assert found(coded(pack(b"nothing here ") + SECRET.encode())) == (True, True)
    assert found(f"some data={quote(pack(LONG))}&x=1 more") == (True, True)
    assert found("some " + "".join(f"\\x{x:02x}" for x in pack(SECRET.encode())) + " more") == (True, True)
    assert found(coded(pack(LONG)[:-20]))[1] is False
    assert found("f(x) = x^2 + y and x^3 or x^abcdefgh") == (False, True)


@pytest.mark.parametrize("raw", [
    f"\ufeff{SECRET}".encode(), f"a\u00a0b {SECRET}".encode(), f"\x1b[31m{SECRET}\x1b[0m".encode(), f"x\0y\f\u200b {SECRET}".encode(),
    f"caf\xe9 {SECRET}".encode("latin-1"), SECRET.encode("utf-16"), SECRET.encode("utf-16-be"), SECRET.encode("utf-32-le")])
def test_decoded_layers_need_not_be_plain_text(raw):
    for hidden in (coded(raw), coded(coded(raw).encode()), coded(b"\xff\0" + coded(raw).encode()), coded(gzip.compress(raw))):
        assert found(f"Before {hidden} and after") == (True, True)


def test_streams_not_read_whole_are_redacted(spark):
    bomb, packed = coded(gzip.compress(bytes(1_000_000))), coded(gzip.compress(SECRET.encode()))
    broken = coded(lzma.compress(LONG)[:-20])
    whole = f"one {bomb} two {packed} three {broken} four"
    assert any(whole[s:e] == packed for _, s, e, _ in secrets.secret_spans(whole, most=10_000)[0])  # a bomb does not use up what others may yield
    rows = secrets.redact_secrets(spark.createDataFrame([(1, whole)], "doc_id long, text string"), most=10_000).collect()
    assert rows[0]["text"] == f"one {secrets.REDACTED} two {secrets.REDACTED} three {secrets.REDACTED} four"


def test_words_that_look_like_streams_stay(spark):
    """Their letters, taken as base64, have a zlib header at the start or inside."""
    words = ["eJyabcdefghijklmnopq", "eNoabcdefghijklmnopqrstuv", coded(b"\xb5\x9ex\x9c\x8a\x18\xad\x9e\xd7\xa8\xb6\x17").rstrip("=")]
    assert all(secrets.secret_spans(f"one {w} two")[1] for w in words)


# --- layers that only the scan of hidden characters, other alignments or long chains finds

@pytest.mark.parametrize("before", ["", "id_", "k-", "x/", "https://h/a/", "/v1/", "zz"])
@pytest.mark.parametrize("pack", [bytes, gzip.compress, zlib.compress])
def test_base64_behind_other_characters(before, pack):
    for after in ("", "-tail", "/"):
        assert found(before + coded(pack(SECRET.encode() * 3)) + after)[0]


def escaped_whole(text):
    return "".join(f"%{b:02x}" for b in text.encode())


NESTS = [lambda t: quote(t, safe=""), escaped_whole, lambda t: "".join(f"\\u{ord(c):04x}" for c in t), lambda t: "".join(f"&#{ord(c)};" for c in t),
         lambda t: coded(t.encode()), lambda t: "k-" + coded(gzip.compress(t.encode())), lambda t: "\0".join(t),
         lambda t: "ab " + zlib.compress(t.encode()).decode("latin-1"), lambda t: coded(t.encode("utf-16"))]


def test_scans_of_tables_find_what_was_hidden(spark):
    """Secrets behind up to three encodings, and the table's scan tells what the scan of one text tells."""
    rng = random.Random(11)
    texts = []
    for i in range(250):
        text = SECRET
        for _ in range(rng.randint(1, 3)):
            text = rng.choice(NESTS)(text)
        texts.append(f"start {i} {text} end")
    texts += ["".join(rng.choice(["%25", "41", "\0", "x^", "a", "&#", "\\u", " ", "=", "(µ/ý", "BZh9"]) for _ in range(12)) for _ in range(300)]
    got = secrets.scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    rows = {r["doc_id"]: ([tuple(s) for s in r["spans"]], r["complete"]) for r in got}
    assert all(rows[i] == secrets.secret_spans(t) for i, t in enumerate(texts))
    lost = [t for i, t in enumerate(texts[:250]) if not any(k == "assign" for k, *_ in rows[i][0])]
    assert lost == []


@pytest.mark.parametrize("chain", ["%" + "25" * 400_000 + "41", "&" + "#38;" * 200_000 + "#65;", "\\u005c" + "u005c" * 150_000 + "u0041"])
def test_long_chains_of_escapes_take_linear_time(chain):
    start = time.time()
    assert found(f"{SECRET[:-1]}{chain}")[0]
    assert time.time() - start < 30


def test_a_chain_hides_a_secret():
    for depth in (1, 3, 4, 5, 40):
        assert found("password%" + "25" * depth + "3Dhunter2secret")[0]
        assert found("password&" + "#38;" * depth + "#61;hunter2secret")[0]
