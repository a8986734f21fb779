"""Secrets in texts and in what the texts encode: a worklist of decoded layers.

A text is scanned, then every layer that can be unwrapped from it is scanned and
unwrapped in turn until none is left: escapes (percent signs, ``\\u....``,
``\\x..``, ``&#..;``) are decoded in place, so that what stands around them stays
their context; base64 tokens become layers of their own, decompressed where they
hold gzip, zlib, bzip2 or xz data.  Each layer knows which characters of the layer
it came from a character stands for, so a find is mapped back, layer by layer, to
a span of the text.  A layer equal to one it came from is not entered again.

Defined results: null and empty texts have no spans (``base_sha256`` is that of
the empty string); repeated rows and rows with a null id are scanned each; an
empty table gives an empty result; other columns are not read.  Compressed data
that unpacks to more than ``LARGEST`` bytes is scanned up to there and counted in
``n_cut``, so that a decompression bomb cannot end the task.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import arrow_batches

# The kinds in the order of the contract, their patterns, the group judged and its least length.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LENGTH = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # a run is taken whole, so a run too short holds no longer one
HEX = re.compile(r"[0-9a-f]{16,}")

LARGEST = 64 << 20
# Escape levels that are scanned one by one; deeper nesting is decoded at once.
LEVELS = 32

_ESCAPE = re.compile(
    r"(?P<percent>(?:%[0-9A-Fa-f]{2})+)"
    r"|(?P<pair>\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2})"
    r"|\\u(?P<u4>[0-9A-Fa-f]{4})|\\u\{(?P<u>[0-9A-Fa-f]{1,6})\}|\\U(?P<u8>[0-9A-Fa-f]{8})|\\x(?P<x>[0-9A-Fa-f]{2})"
    r"|&#(?P<dec>[0-9]{1,7});|&#[xX](?P<hex>[0-9A-Fa-f]{1,6});"
)
# The shortest find has 16 characters, which are 22 of base64.
_ENCODED = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{60,}(?:\r?\n[A-Za-z0-9+/_-]+)+={0,2}|[A-Za-z0-9+/_-]{22,}={0,2})")
_PARTS = re.compile(r"[A-Za-z0-9]{22,}={0,2}")
_BREAK = re.compile(r"\r?\n")
_LINE = re.compile(r"[^\r\n]+")
_UNPRINTED = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")

Span = tuple[int, int, int]  # start, kind, end


def _classes(hexadecimal: bytes, encoded: bytes) -> bytes:
    table = bytearray(b" " * 256)
    table[ord("0") : ord("9") + 1] = hexadecimal * 10
    table[ord("a") : ord("f") + 1] = hexadecimal * 6
    for c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZghijklmnopqrstuvwxyz+/_-":
        table[c] = encoded[0]
    return bytes(table)


# Long runs are found by plain searches before any pattern is tried.
_HEX_RUNS, _TOKEN_RUNS = _classes(b"x", b" "), _classes(b"x", b"x")
_HEX_RUN, _TOKEN_RUN = b"x" * 16, b"x" * 22
_KEY_PARTS = ("passw", "secret", "token", "api")


def scanned(text: str, data: bytes) -> list[Span]:
    """Spans of the three patterns, each kind's leftmost ones that do not overlap, short ones dropped; ``data`` is the text in UTF-8."""
    found = []
    lowered = text.lower()
    if any(part in lowered for part in _KEY_PARTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    if _HEX_RUN in data.translate(_HEX_RUNS):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


@dataclass(frozen=True)
class Layer:
    """A decoded text and how its spans lie in the text: ``back`` maps a span one layer up, ``changed`` says whether it holds anything decoded."""

    text: str
    parent: Layer | None = None
    back: Callable[[int, int], tuple[int, int]] | None = None
    changed: Callable[[int, int], bool] = lambda start, end: True
    level: int = 0

    def origin(self, start: int, end: int) -> tuple[int, int]:
        layer: Layer | None = self
        while layer.parent is not None:
            start, end = layer.back(start, end)
            layer = layer.parent
        return start, end

    def seen(self, text: str) -> bool:
        """Whether this layer or one it came from has this text: a cycle."""
        layer: Layer | None = self
        while layer is not None:
            if layer.text == text:
                return True
            layer = layer.parent
        return False


def _characters(m: re.Match) -> str | None:
    """What one escape, or a run of percent escapes, stands for."""
    kind = m.lastgroup
    if kind == "percent":
        return bytes.fromhex(m[kind].replace("%", "")).decode("utf-8", "replace")
    if kind == "pair":
        high, low = int(m[kind][2:6], 16), int(m[kind][8:12], 16)
        return chr(0x10000 + ((high - 0xD800) << 10) + (low - 0xDC00))
    code = int(m[kind], 10 if kind == "dec" else 16)
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else None


def unescaped(layer: Layer) -> Layer | None:
    """The layer with one level of its escapes decoded; ``None`` if it has none."""
    text = layer.text
    if "%" not in text and "\\" not in text and "&#" not in text:
        return None
    parts: list[str] = []
    # Pieces of the new text: where they begin, where in the old one, and the old end where they are decoded ones.
    begins: list[int] = []
    olds: list[int] = []
    ends: list[int] = []
    at = new = 0

    def add(piece: str, old: int, end: int) -> None:
        nonlocal new
        parts.append(piece)
        begins.append(new)
        olds.append(old)
        ends.append(end)
        new += len(piece)

    for m in _ESCAPE.finditer(text):
        decoded = _characters(m)
        if not decoded:
            continue
        if m.start() > at:
            add(text[at : m.start()], at, -1)
        if m.lastgroup == "percent" and decoded.isascii():
            for k, c in enumerate(decoded):
                add(c, m.start() + 3 * k, m.start() + 3 * k + 3)
        else:
            add(decoded, m.start(), m.end())
        at = m.end()
    if not new and not at:
        return None
    if at < len(text):
        add(text[at:], at, -1)

    def back(start: int, end: int) -> tuple[int, int]:
        i, k = bisect_right(begins, start) - 1, bisect_right(begins, end - 1) - 1
        first = olds[i] if ends[i] >= 0 else olds[i] + start - begins[i]
        return first, ends[k] if ends[k] >= 0 else olds[k] + end - begins[k]

    def changed(start: int, end: int) -> bool:
        i, k = bisect_right(begins, start) - 1, bisect_right(begins, end - 1) - 1
        return k > i or ends[i] >= 0

    return Layer("".join(parts), layer, back, changed, layer.level + 1)


def flattened(layer: Layer) -> Layer:
    """All levels of escapes decoded at once, one character after another: linear however deep they nest."""
    held: list[tuple[str, int, int]] = []
    for at, c in enumerate(layer.text):
        held.append((c, at, at + 1))
        while c in "0123456789abcdefABCDEF;}":
            tail = "".join(x[0] for x in held[-12:])
            m = next((m for m in _ESCAPE.finditer(tail) if m.end() == len(tail)), None)
            decoded = m and _characters(m)
            if not decoded or len(decoded) != 1:
                break
            size = len(m[0]) if m.lastgroup != "percent" else 3
            first = held[-size][1]
            del held[-size:]
            c = decoded
            held.append((c, first, at + 1))
    spans = [(x[1], x[2]) for x in held]

    def back(start: int, end: int) -> tuple[int, int]:
        return spans[start][0], spans[end - 1][1]

    def changed(start: int, end: int) -> bool:
        first, last = back(start, end)
        return last - first > end - start

    return Layer("".join(x[0] for x in held), layer, back, changed, layer.level + 1)


def _inflated(data: bytes, largest: int) -> tuple[bytes, bool] | None:
    """Decompressed bytes and whether they were cut at ``largest``; ``None`` if this is no compressed data."""
    if data[:2] == b"\x1f\x8b":
        engine = zlib.decompressobj(31)
    elif len(data) > 2 and data[0] & 0x0F == 8 and data[0] >> 4 <= 7 and (data[0] << 8 | data[1]) % 31 == 0:
        engine = zlib.decompressobj()
    elif data[:3] == b"BZh":
        engine = bz2.BZ2Decompressor()
    elif data[:6] == b"\xfd7zXZ\x00":
        engine = lzma.LZMADecompressor(memlimit=256 << 20)
    else:
        return None
    try:
        out = engine.decompress(data, largest)
    except (zlib.error, OSError, lzma.LZMAError, EOFError):
        return None
    return (out, len(out) >= largest) if out else None


def _text_of(data: bytes) -> str | None:
    """UTF-8 (or UTF-16 with a mark) text that is mostly printable, else ``None``."""
    try:
        text = data.decode("utf-16" if data[:2] in (b"\xff\xfe", b"\xfe\xff") else "utf-8")
    except UnicodeDecodeError:
        return None
    return None if len(_UNPRINTED.findall(text[:4096])) * 10 > min(len(text), 4096) else text


def decoded_tokens(layer: Layer, data: bytes, largest: int) -> Iterator[tuple[Layer, bool]]:
    """Layers of the base64 tokens of a layer, and whether decompression cut one."""
    if _TOKEN_RUN not in data.translate(_TOKEN_RUNS):
        return
    for m in _ENCODED.finditer(layer.text):
        found = list(_token(layer, m.start(), m[0], largest))
        if not found and _BREAK.search(m[0]):  # a line of its own may end where other text begins
            for line in _LINE.finditer(m[0]):
                if len(line[0]) >= len(_TOKEN_RUN):
                    found += _token(layer, m.start() + line.start(), line[0], largest)
        if not found and not m[0].isalnum():  # a path or a name with hyphens may hold one between them
            for part in _PARTS.finditer(m[0]):
                if len(part[0]) < len(m[0]):
                    found += _token(layer, m.start() + part.start(), part[0], largest)
        yield from found


def _token(layer: Layer, at: int, token: str, largest: int) -> Iterator[tuple[Layer, bool]]:
    breaks = [(m.start(), m.end() - m.start()) for m in _BREAK.finditer(token)]
    plain = _BREAK.sub("", token).rstrip("=").replace("-", "+").replace("_", "/")
    if len(plain) % 4 == 1:
        return
    try:
        data = base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return
    end = at + len(token)
    cut, packed = False, False
    while (opened := _inflated(data, largest)) is not None and opened[0] != data:
        data, cut, packed = opened[0], cut or opened[1], True
        if cut:
            break
    text = _text_of(data) if not cut else data.decode("utf-8", "ignore")
    if not text or layer.seen(text):
        return

    def within(place: int) -> int:
        """The place in the token, line breaks counted."""
        for start, size in breaks:
            if start <= place:
                place += size
        return place

    def back(start: int, stop: int) -> tuple[int, int]:
        if packed or data[:2] in (b"\xff\xfe", b"\xfe\xff"):
            return at, end
        low, high = len(text[:start].encode()), len(text[:stop].encode())
        return at + within(8 * low // 6), at + within((8 * high - 1) // 6) + 1

    yield Layer(text, layer, back, level=layer.level + 1), cut


def secrets_of(text: str, largest: int = LARGEST) -> tuple[list[Span], list[Span], int, int]:
    """Spans of the text itself; spans with those of all layers; how many layers there were; how many were cut."""
    base: list[Span] = []
    found: set[Span] = set()
    layers = cuts = 0
    work = [Layer(text)]
    while work:
        layer = work.pop()
        data = layer.text.encode("utf-8", "replace")
        if layer.parent is None:
            base = sorted(scanned(text, data))
            found.update(base)
        else:
            layers += 1
            for start, kind, end in scanned(layer.text, data):
                if layer.changed(start, end):
                    first, last = layer.origin(start, end)
                    found.add((first, kind, last))
        below = unescaped(layer) if layer.level < LEVELS else flattened(layer)
        if below is not None and not layer.seen(below.text):
            work.append(below)
        for token, cut in decoded_tokens(layer, data, largest):
            cuts += cut
            work.append(token)
    return base, sorted(found), layers, cuts


def shown(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


SECRETS = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long, n_layers long, n_cut long"


def secret_spans(docs: DataFrame, largest: int = LARGEST) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): counts and digest of the plain spans, all spans, and what the layers added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                base, spans, layers, cuts = secrets_of(text or "", largest)
                kinds = [kind for _, kind, _ in base]
                rows.append((
                    doc_id, *(kinds.count(k) for k in range(3)), hashlib.sha256(shown(base).encode()).hexdigest(), shown(spans),
                    len(spans) - len(base), layers, cuts,
                ))
            columns = list(zip(*rows)) if rows else [()] * 9
            types = (*[pa.int64()] * 4, pa.string(), pa.string(), *[pa.int64()] * 3)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [c.split()[0] for c in SECRETS.split(", ")])

    arrow_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SECRETS)
