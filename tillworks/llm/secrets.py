"""Secret scans with a worklist of decoded layers.

Base patterns run over the raw text. Then every layer on the worklist is unwrapped: percent and Unicode escapes are replaced over the
whole layer, base64 runs are decoded, compressed bytes are unpacked, NULs are left out (UTF-16). What comes out, text or not, is scanned
as UTF-8 or else Latin-1 and put on the worklist in turn, until nothing new comes. A layer is known by its text and the place it came
from, so a cycle ends and no layer is read twice. Each character of a layer knows the range of the raw text it stands for, which gives
the spans. Escapes inside escapes are unwrapped LEVELS times layer by layer, then all at once in one pass, so a long chain of them takes
time in proportion to its length. A base64 run is decoded from each of its first four characters, whatever stands before its content.

Cases: a null text is empty and has no secrets; repeated rows get a row each; other columns pass through :func:`redact_secrets` as they
are and are not read by :func:`scan_secrets`. MAX_UNPACKED bytes for each stream that a text holds, with all inside it, bounds what
decompression may yield (a bomb); what lies beyond is not scanned, ``complete`` is false, and :func:`redact_secrets` replaces the
stream, as it does one that breaks off.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.text import small_batches

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a shorter run fails whole, so the length can be part of the pattern
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Base64 wrapped into lines: the last one may be short.
BLOCK = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:[ \t]*(?:\r\n|\r|\n)[ \t]*[A-Za-z0-9+/_-]{16,})*(?:[ \t]*(?:\r\n|\r|\n)[ \t]*(?:[A-Za-z0-9+/_-]+={0,2}|={1,2})|={1,2})?")
LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}|={1,2}")
#: Where a compressed stream may begin among characters that each stand for a byte.
MAGIC = re.compile("\x1f\x8b\x08|x[\x01^\x9c\xda]|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\xfd7zXZ\x00|\\(\xb5/\xfd")
WIDE = re.compile("[^\x00-\xff]")
STEP = 4096
#: Two bytes are a zlib header, so other bytes may look like a stream: one that breaks off within so many is scanned but not missed.
FIRST = 64
MAX_UNPACKED = 64 << 20
#: Layers of escapes inside escapes that are read one by one.
LEVELS = 4
#: A text without any of these has neither secrets nor layers. RE2, over whole columns; the same for Python's matcher.
ANY = (r"(?i)password|passwd|secret|token|api_?key|AKIA|[0-9a-f]{24}|[A-Za-z0-9+/_-]{16}|%[0-9a-f]{2}|\\[ux]|&#|\x00"
       r"|\x1f\x{8b}\x08|x[\x01^\x{9c}\x{da}]|BZh[1-9]|\x{fd}7zXZ|\(\x{b5}/\x{fd}")
_ANY = re.compile(re.sub(r"\\x\{(..)\}", r"\\x\1", ANY))
REDACTED = "<redacted>"

SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the base patterns, by kind."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


@dataclass
class Layer:
    """A text and, for each of its characters, the range of the raw text it stands for."""

    text: str
    starts: np.ndarray
    ends: np.ndarray
    budget: list[int] | None = None  # bytes that streams inside may still yield, if it came out of one
    streams: bool = True  # whether characters below 256 may stand for bytes
    level: int = 0  # escapes unwrapped in a row to get here

    def raw(self, start: int, end: int) -> tuple[int, int]:
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())

    def key(self) -> tuple[int, int, bytes]:
        return *self.raw(0, len(self.text)), hashlib.sha256(self.text.encode("utf-8", "surrogatepass")).digest()


def _replaced(layer: Layer, pieces: list[tuple[int, int, str, list[tuple[int, int]]]]) -> Layer | None:
    """The layer with each (start, end) replaced by a text whose characters stand for the given ranges of the layer."""
    if not pieces:
        return None
    out, low, high, at = [], [], [], 0
    for start, end, text, ranges in pieces:
        out += [layer.text[at:start], text]
        low += [np.arange(at, start), np.array([r[0] for r in ranges], dtype=np.int64)]
        high += [np.arange(at, start), np.array([r[1] - 1 for r in ranges], dtype=np.int64)]
        at = end
    out.append(layer.text[at:])
    tail = np.arange(at, len(layer.text))
    return Layer("".join(out), layer.starts[np.concatenate([*low, tail])], layer.ends[np.concatenate([*high, tail])], layer.budget)


def _characters(raw: bytes, width: int, start: int) -> tuple[str, list[tuple[int, int]]]:
    """Bytes that each take ``width`` characters from ``start`` on, as text: UTF-8, or one character for each byte."""
    try:
        text = raw.decode("utf-8")
        sizes = [len(c.encode("utf-8")) for c in text]
    except UnicodeDecodeError:
        text, sizes = raw.decode("latin-1"), [1] * len(raw)
    ranges, at = [], start
    for n in sizes:
        ranges.append((at, at + n * width))
        at += n * width
    return text, ranges


def _decoded(raw: bytes) -> str:
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _percent(layer: Layer) -> Layer | None:
    if "%" not in layer.text:
        return None
    return _replaced(layer, [(*m.span(), *_characters(bytes.fromhex(m[0].replace("%", "")), 3, m.start())) for m in PERCENT.finditer(layer.text)])


def _percent_bytes(layer: Layer) -> Layer | None:
    """With a character for each byte, if a compressed stream may be among them."""
    if "%" not in layer.text:
        return None
    out = _replaced(layer, [(*m.span(), bytes.fromhex(m[0].replace("%", "")).decode("latin-1"), [(i, i + 3) for i in range(*m.span(), 3)])
                            for m in PERCENT.finditer(layer.text)])
    return out if out is not None and MAGIC.search(out.text) else None


def _without_nuls(layer: Layer) -> Layer | None:
    """UTF-16 and UTF-32 bytes as the ASCII text in them."""
    if "\0" not in layer.text:
        return None
    keep = np.array([c != "\0" for c in layer.text])
    return Layer(layer.text.replace("\0", ""), layer.starts[keep], layer.ends[keep], layer.budget, False)


def _wide(layer: Layer) -> Layer | None:
    """UTF-16 bytes as the text they spell, if nearly every second one is NUL."""
    if "\0" not in layer.text or len(layer.text) < 4 or WIDE.search(layer.text):
        return None
    codes = np.frombuffer(layer.text.encode("latin-1"), dtype=np.uint8).astype(np.int64)
    half = len(codes) // 2
    for high in (1, 0):  # little-endian first
        if (codes[high::2] == 0).mean() > 0.8:
            units = codes[1 - high:2 * half:2] + 256 * codes[high:2 * half:2]
            units[(units >= 0xD800) & (units < 0xE000)] = 0xFFFD
            return Layer("".join(map(chr, units.tolist())), layer.starts[0:2 * half:2], layer.ends[1:2 * half:2], layer.budget)
    return None


def _unicode(layer: Layer) -> Layer | None:
    if "\\" not in layer.text and "&#" not in layer.text:
        return None
    pieces, high = [], None
    for m in UNICODE.finditer(layer.text):
        digits = next(g for g in m.groups() if g is not None)
        code = int(digits, 10 if m[6] is not None else 16)
        if code > 0x10FFFF:
            continue
        if high and high[1] == m.start() and 0xDC00 <= code < 0xE000:  # the second half of a pair
            code = 0x10000 + ((high[2] - 0xD800) << 10) + (code - 0xDC00)
            pieces[-1] = (high[0], m.end(), chr(code), [(high[0], m.end())])
            high = None
            continue
        high = (*m.span(), code) if 0xD800 <= code < 0xDC00 else None
        pieces.append((*m.span(), chr(code) if not 0xD800 <= code < 0xE000 else "\ufffd", [m.span()]))
    return _replaced(layer, pieces)


_ESCAPE = re.compile(r"(?:%([0-7][0-9A-Fa-f])|\\u\{0{0,4}([0-7]?[0-9A-Fa-f])\}|\\u00([0-7][0-9A-Fa-f])|\\U000000([0-7][0-9A-Fa-f])|\\x([0-7][0-9A-Fa-f])"
                     r"|&#x0{0,4}([0-7]?[0-9A-Fa-f]);|&#0{0,4}([0-9]{1,3});)\Z")
#: The longest escape of an ASCII character.
ESCAPE_CHARS = 12
#: Characters that end one.
_ENDS = frozenset("0123456789ABCDEFabcdef};")


def _resolved(layer: Layer) -> Layer | None:
    """The layer with every escape of an ASCII character replaced, also those that come out of replaced ones, in one pass: an escape that
    ends where the output ends is replaced there, and what follows is read behind it."""
    out, low, high, changed = [], [], [], False
    for i, c in enumerate(layer.text):
        out.append(c)
        low.append(i)
        high.append(i)
        while out[-1] in _ENDS and (m := _ESCAPE.search("".join(out[-ESCAPE_CHARS:]))):
            code = int(m[7]) if m[7] else int(next(g for g in m.groups() if g), 16)
            if code > 127:
                break
            size, changed = len(m[0]), True
            out[-size:] = [chr(code)]
            low[-size:] = [low[-size]]
            high[-size:] = [i]
    if not changed:
        return None
    return Layer("".join(out), layer.starts[np.array(low)], layer.ends[np.array(high)], layer.budget)


def _tool(raw: bytes):
    """A decompressor for what the bytes begin with, or None."""
    if raw[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if len(raw) > 2 and raw[0] == 0x78 and (raw[0] * 256 + raw[1]) % 31 == 0:
        return zlib.decompressobj()
    if raw[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if raw[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return _Zstd() if raw[:4] == b"\x28\xb5\x2f\xfd" else None


class _Zstd:
    """Like the other tools; without its library nothing comes out and the end is never reached."""

    needs_input = True

    def __init__(self) -> None:
        try:
            import zstandard
        except ImportError:
            self.tool = None
        else:
            self.tool, self.error = zstandard.ZstdDecompressor().decompressobj(), zstandard.ZstdError

    @property
    def eof(self) -> bool:
        return self.tool is not None and self.tool.eof

    @property
    def unused_data(self) -> bytes:
        return self.rest if self.eof else b""

    def decompress(self, piece: bytes, most: int) -> bytes:
        out, size = [], 0
        for i in range(0, len(piece) if self.tool else 0, 64):  # it has no limit of its own, but a block is bounded
            try:
                out.append(self.tool.decompress(piece[i:i + 64]))
            except self.error:
                if not size:
                    raise ValueError from None
                break
            size += len(out[-1])
            if self.tool.eof:
                self.rest = self.tool.unused_data + piece[i + 64:]
                break
            if size > most:
                break
        return b"".join(out)


def _unpacked(raw: bytes, most: int) -> tuple[bytes, bool | None, int] | None:
    """What the compressed streams at the start of ``raw`` hold, one after the other, up to ``most`` bytes; whether that is all of them
    (None: it may be no stream); and how many bytes they take. None: there is no stream."""
    out, size, at, whole = [], 0, 0, True
    while whole and at < len(raw):
        if (tool := _tool(raw[at:at + 6])) is None:
            break
        begin, here, bad = at, 0, False
        while not tool.eof and at < len(raw) and size <= most and not bad:  # in steps, so that what comes before an error is kept
            step = FIRST if at == begin else STEP
            piece, at = raw[at:at + step], at + step
            while not tool.eof and size <= most:
                try:
                    got = tool.decompress(piece, most + 1 - size)
                except (zlib.error, OSError, ValueError, lzma.LZMAError, EOFError):
                    bad = True
                    break
                out.append(got)
                size, here = size + len(got), here + len(got)
                piece = getattr(tool, "unconsumed_tail", b"")
                if not piece and (hasattr(tool, "unconsumed_tail") or tool.needs_input):
                    break
        at = min(at, len(raw)) - len(tool.unused_data)
        if bad and not here:  # only looks like a stream
            at = begin
            break
        whole = tool.eof and size <= most
        if not whole:
            whole = None if raw[begin] == 0x78 and at - begin <= FIRST and size <= most else False
            at = len(raw)
    return (b"".join(out)[:most], whole, at) if at else None


def _bytes_of(token: str) -> bytes | None:
    plain = token.rstrip("=").replace("-", "+").replace("_", "/")
    if len(plain) % 4 == 1:  # a character of what follows
        plain = plain[:-1]
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _runs(text: str) -> list[tuple[np.ndarray, str]]:
    """(places of the characters, characters) of all base64 runs: within a line, and joined over line breaks where lines follow each
    other. Joined are all lines of a block, and lines of one width with the line before and the rest behind. Longest first."""
    out = [(np.arange(*m.span()), m[0]) for m in BASE64.finditer(text)]
    seen = set()
    for block in BLOCK.finditer(text):
        lines = [(block.start() + m.start(), block.start() + m.end()) for m in LINE.finditer(block[0])]
        width = [e - s for s, e in lines]
        groups, a = [(0, len(lines)), (0, len(lines) - 1)], 0
        while a < len(lines):
            b = a + 1
            while b < len(lines) and width[b] == width[a]:
                b += 1
            groups += [(x, y) for x in (a, a - 1) for y in (b, b + 1) if x >= 0 and y <= len(lines)]
            a = b
        for x, y in groups:
            if y - x > 1 and (key := (lines[x][0], lines[y - 1][1])) not in seen:
                seen.add(key)
                out.append((np.concatenate([np.arange(*r) for r in lines[x:y]]), "".join(text[i:j] for i, j in lines[x:y])))
    return sorted(out, key=lambda x: -len(x[1]))


def _looks_packed(raw: bytes, whole: bool) -> bool:
    """`x^` is also plain text: a stream that breaks off counts only if bytes that are not text follow."""
    return whole or raw[:2] != b"x^" or any(c < 9 or 13 < c < 32 or 126 < c < 160 for c in raw[2:18])


def _packed_children(layer: Layer, most: int, unread: list[tuple[int, int]]) -> Iterator[Layer]:
    """Layers out of base64 runs, and out of compressed bytes among the layer's characters. Ranges of streams that were not read whole
    go to ``unread``."""

    def unpacked(raw: bytes) -> tuple[bytes, bool | None, int, list[int]] | None:
        budget = layer.budget or [most]  # of the outermost stream
        found = _unpacked(raw, budget[0])
        if found is None:
            return None
        out, whole, used = found
        budget[0] -= len(out)
        while out and whole and (inner := _unpacked(out, budget[0])) is not None:
            budget[0] -= len(inner[0])
            out, whole = inner[0] + out[inner[2]:], inner[1]
        return out, whole, used, budget

    def child(out: bytes, places: tuple[int, int], budget: list[int]) -> Layer:
        text, low, high = _decoded(out), *layer.raw(*places)
        return Layer(text, np.broadcast_to(np.int64(low), len(text)), np.broadcast_to(np.int64(high), len(text)), budget)

    done, broken = [], []
    # all runs from their first character, then from the next three: something may stand before the content
    aligned = [(at[k:], token[k:], k) for k in range(4) for at, token in _runs(layer.text) if len(token) - k > 2]
    for at, token, shift in aligned:
        start, end = int(at[0]), int(at[-1]) + 1
        if any(s <= start and end <= e for s, e in done) or not (raw := _bytes_of(token)):
            continue
        if shift and not _ANY.search(raw.decode("latin-1")):
            continue
        used = 0
        if (found := unpacked(raw)) is not None:
            out, whole, used, budget = found
            end = end if used == len(raw) else int(at[(used * 4 + 2) // 3 - 1]) + 1
            if whole:
                done.append((start, end))
            elif whole is False:
                broken.append((start, end))
            if out:
                yield child(out, (start, end), budget)
            if whole is None or not whole and not out:
                used = 0
        if used < len(raw):
            text, ranges = _characters(raw[used:], 1, used)
            low, high = np.array([r[0] for r in ranges]) * 4 // 3, (np.array([r[1] for r in ranges]) * 4 + 2) // 3
            yield Layer(text, layer.starts[at[low]], layer.ends[at[np.minimum(high, len(at)) - 1]], layer.budget)
    unread += [layer.raw(s, e) for s, e in broken if not any(x <= s and e <= y for x, y in done)]
    last, first, stop, view = 0, 0, 0, memoryview(b"")
    for m in MAGIC.finditer(layer.text) if layer.streams else ():
        at = m.start()
        if at < last:
            continue
        if at >= stop:
            wide = WIDE.search(layer.text, at)
            first, stop = at, wide.start() if wide else len(layer.text)
            view = memoryview(layer.text[first:stop].encode("latin-1"))
        raw = view[at - first:]
        if (found := unpacked(raw)) is not None and _looks_packed(raw, found[1]):
            out, whole, used, budget = found
            if whole is False:
                unread.append(layer.raw(at, at + used))
            if out:
                yield child(out, (at, at + used), budget)
            if whole is not None:
                last = at + used


def _scanned(text: str, most: int = MAX_UNPACKED) -> tuple[list[tuple[str, int, int, bool]], list[tuple[int, int]]]:
    """All (kind, start, end, whether a base pattern found it in the raw text), in order; ranges of streams that were not read whole."""
    base = set(base_spans(text))
    found, unread = set(base), []

    def children(layer: Layer) -> Iterator[Layer | None]:
        if not _ANY.search(layer.text):
            return
        deeper = layer.level + 1
        if deeper > LEVELS and (whole := _resolved(layer)) is not None:
            yield whole
        else:
            as_text, as_bytes, as_unicode = _percent(layer), _percent_bytes(layer), _unicode(layer)
            for own in (as_text, as_bytes, as_unicode):
                if own is not None:
                    own.level = deeper
            if as_bytes is not None:
                as_text.streams = False
                yield as_bytes
            yield as_text
            yield as_unicode
        yield _without_nuls(layer)
        yield _wide(layer)
        yield from _packed_children(layer, most, unread)

    root = Layer(text, np.arange(len(text)), np.arange(1, len(text) + 1))
    # depth first, so that only the layers on the way to one are held
    work, seen = [children(root)] if text else [], {root.key()} if text else set()
    while work:
        layer = next(work[-1], work)
        if layer is work:
            work.pop()
        elif layer is not None and layer.text and (key := layer.key()) not in seen:
            seen.add(key)
            found |= {(kind, *layer.raw(s, e)) for kind, s, e in base_spans(layer.text)}
            work.append(children(layer))
    ordered = sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))
    return [(*x, x in base) for x in ordered], unread


def secret_spans(text: str, most: int = MAX_UNPACKED) -> tuple[list[tuple[str, int, int, bool]], bool]:
    """All (kind, start, end, whether a base pattern found it in the raw text), in order; whether all layers were read whole."""
    spans, unread = _scanned(text, most)
    return spans, not unread


def redacted(text: str, spans: list[tuple[str, int, int, bool]], label: str = REDACTED) -> str:
    """The text with every run of overlapping spans replaced."""
    out, at, end = [], 0, -1
    for _, s, e, _ in spans:
        if s >= end:
            if end >= 0:
                out.append(label)
            out.append(text[at:s])
        end = at = max(end, e)
    if end >= 0:
        out.append(label)
    return "".join(out) + text[at:]


def _hits(column: pa.Array) -> tuple[list[int], pa.Array]:
    column = pc.fill_null(column, "")
    return np.flatnonzero(pc.match_substring_regex(column, ANY).to_numpy(zero_copy_only=False)).tolist(), column


def scan_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = MAX_UNPACKED) -> DataFrame:
    """Per row: id, spans (kind, start, end, base; code points, end exclusive), complete."""
    small_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, complete = [[]] * batch.num_rows, [True] * batch.num_rows
            places, texts = _hits(batch.column(1))
            for i in places:
                spans[i], complete[i] = secret_spans(texts[i].as_py(), most)
            rows = [[{"kind": k, "start": s, "end": e, "base": b} for k, s, e, b in x] for x in spans]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, SPANS), pa.array(complete, pa.bool_())], names=["id", "spans", "complete"])

    out = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>, complete boolean")
    return out.withColumnRenamed("id", doc_id)


def redact_secrets(docs: DataFrame, text: str = "text", most: int = MAX_UNPACKED, label: str = REDACTED) -> DataFrame:
    """The rows with their secrets and the streams that were not read whole replaced; encoded secrets go with the run that holds them.
    Other columns as they are."""
    small_batches(docs.sparkSession)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, texts = _hits(batch.column(at))
            changed = {}
            for i in places:
                value = texts[i].as_py()
                while any(found := _scanned(value, most)):
                    spans, unread = found
                    clean = redacted(value, sorted([*spans, *(("unread", *x, False) for x in unread)], key=lambda x: x[1]), label)
                    if clean == value:
                        break
                    value = changed[i] = clean
            if changed:
                values = batch.column(at).to_pylist()
                for i, value in changed.items():
                    values[i] = value
                columns = list(batch.columns)
                columns[at] = pa.array(values, batch.schema.field(at).type)
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch

    return docs.mapInArrow(run, docs.schema)
