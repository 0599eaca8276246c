"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with character offsets, and the sorted spans of the assistant's texts are intersected
with the token spans by binary search. Turns are marked by control tokens, which the tokenizer never merges with text, so masks end
where texts do. Control strings inside a text or role are escaped: a backslash goes behind their first character, one more where
backslashes stand there already, so nothing in a text can end a turn and every text can be read back.

Cases: rows are taken by turn, equal turns by role and text; a null text or role is empty; null turns come first; an empty assistant
text has no tokens under the mask; an empty table gives no conversations; a null conv_id is a conversation; repeated rows are turns of
their own; columns besides the named ones are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.text import small_batches

#: A file of byte-level BPE ranks: a token in base64 and its id on each line.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how that vocabulary cuts text into pieces.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# Control strings of common chat templates. Each begins with `<` or `[`.
CONTROLS = [START, SEP, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
TRAINED_ROLES = ("assistant",)
#: White space of so many characters is cut out before the pieces are looked for, as that search goes back over a run of white space
#: character by character. The vocabulary takes such a run as one piece, but for its last character before other text.
LONG_RUN = 1 << 14
BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LONG = re.compile(f"[{BLANK}]{{{LONG_RUN},}}")

_REST = "|".join(re.escape(c[1:]) for c in CONTROLS)
_ESCAPE = re.compile(rf"([<\[])(\\*)(?={_REST})")
_UNESCAPE = re.compile(rf"([<\[])\\(\\*)(?={_REST})")
_TURN = re.compile(rf"{re.escape(START)}(.*?){re.escape(SEP)}(.*?){re.escape(END)}\n", re.S)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def render(turns: list[tuple[str, str]], trained=TRAINED_ROLES) -> tuple[str, np.ndarray]:
    """The formatted conversation and the (start, end) of each trained text in it."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEP}", escape(text)
        if role in trained:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(out), np.array(spans, dtype=np.int64).reshape(-1, 2)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def aligned(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """For each token (start, end) whether it lies in one of the sorted spans."""
    if not len(spans) or not len(offsets):
        return np.zeros(len(offsets), dtype=bool)
    place = np.searchsorted(spans[:, 1], offsets[:, 0], side="right")
    inside = place < len(spans)
    own = spans[np.minimum(place, len(spans) - 1)]
    return inside & (own[:, 0] <= offsets[:, 0]) & (offsets[:, 1] <= own[:, 1]) & (offsets[:, 0] < offsets[:, 1])


def masked_spans(offsets: np.ndarray, mask: np.ndarray) -> list[tuple[int, int]]:
    """The stretches of text under the mask; tokens that touch or share a character are one stretch."""
    out: list[tuple[int, int]] = []
    for start, end in offsets[mask].tolist():
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


@functools.cache
def load_tokenizer(path: str, pieces: str = PIECES):
    """(encoding, one that takes a text as one piece, bytes of each token by id). The control tokens get the ids behind the vocabulary's."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    last = max(ranks.values())
    controls = {token: last + 2 + i for i, token in enumerate((START, SEP, END))}
    sizes = np.zeros(last + 2 + len(controls), dtype=np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    for token, rank in controls.items():
        sizes[rank] = len(token)
    return (tiktoken.Encoding("own", pat_str=pieces, mergeable_ranks=ranks, special_tokens=controls),
            tiktoken.Encoding("piece", pat_str="(?s).+", mergeable_ranks=ranks, special_tokens={}), sizes)


def _ids(text: str, encoding, piece) -> list[int]:
    """Token ids; long runs of white space are encoded apart, to the same ids."""
    out, at = [], 0
    for run in _LONG.finditer(text):
        start, end = run.span()
        if end < len(text) and not text.startswith((START, SEP, END), end):
            end -= 1  # the last blank goes with what follows
        out += encoding.encode(text[at:start], allowed_special={START, SEP, END}, disallowed_special=())
        out += piece.encode_ordinary(text[start:end])
        at = end
    return out + encoding.encode(text[at:], allowed_special={START, SEP, END}, disallowed_special=())


def encode(text: str, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Token ids and their (start, end) in code points. Tokens that split a character all have that character."""
    encoding, piece, sizes = load_tokenizer(path)
    ids = np.array(_ids(text, encoding, piece), dtype=np.int32)
    ends = np.cumsum(sizes[ids])
    raw = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
    character = np.cumsum((raw & 0xC0) != 0x80) - 1
    return ids, np.column_stack((character[ends - sizes[ids]], character[ends - 1] + 1)) if len(ids) else np.zeros((0, 2), np.int64)


def format_conversations(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                         tokenizer: str = TOKENIZER, trained=TRAINED_ROLES) -> DataFrame:
    """One row per conversation: id, n_turns, formatted, token_ids, loss_mask (per token), loss_spans (code points of ``formatted`` under
    the mask). ``tokenizer`` is a file that every executor can read."""
    small_batches(rows.sparkSession)
    kind = rows.schema[conv_id].dataType.simpleString()
    turns = rows.groupBy(F.col(conv_id).alias("id")).agg(F.sort_array(F.collect_list(F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")))).alias("turns"))
    turns = turns.select("id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            formatted, ids, masks, spans, n = [], [], [], [], []
            for roles, texts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                whole, trained_spans = render(list(zip(roles, texts)), trained)
                tokens, offsets = encode(whole, tokenizer)
                mask = aligned(offsets, trained_spans)
                n.append(len(roles))
                formatted.append(whole)
                ids.append(tokens)
                masks.append(mask)
                spans.append([{"start": a, "end": b} for a, b in masked_spans(offsets, mask)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(formatted, pa.string()), pa.array(ids, pa.list_(pa.int32())),
                 pa.array(masks, pa.list_(pa.bool_())), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["id", "n_turns", "formatted", "token_ids", "loss_mask", "loss_spans"])

    out = turns.mapInArrow(run, f"id {kind}, n_turns bigint, formatted string, token_ids array<int>, loss_mask array<boolean>, "
                                "loss_spans array<struct<start:bigint,end:bigint>>")
    return out.withColumnRenamed("id", conv_id)


def digests(formatted: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """What can be read back from formatted conversations: turns, and the text under the loss mask, as digests and lengths."""
    kind = formatted.schema[conv_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], [], [], []]
            for whole, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns = read_back(whole)
                loss = "".join(unescape(whole[x["start"]:x["end"]]) for x in spans)
                out[0].append(len(turns))
                out[1].append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
                out[2].append(len(loss))
                out[3].append(hashlib.sha256(loss.encode()).hexdigest())
                out[4].append(len(whole))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(out, kinds)], batch.column(3), batch.column(4)],
                                             names=["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "n_loss"])

    rows = formatted.select(F.col(conv_id).alias("id"), "formatted", "loss_spans", F.size("token_ids").cast("long").alias("n_tokens"),
                            F.size(F.filter("loss_mask", lambda x: x)).cast("long").alias("n_loss"))
    return rows.mapInArrow(run, f"id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, "
                                "n_tokens bigint, n_loss_tokens bigint").withColumnRenamed("id", conv_id)
