"""Secret scan with a recursive decoding worklist.

Each text is scanned for assignments, access keys and long hex strings.  Encoded layers
are then unwrapped, region by region: a region is what stands around pieces that can be decoded, up to where no match can
reach across.  A decoder rewrites every piece of a region that it can decode (percent escapes, Unicode and
character escapes, base64 on one or several lines, and compressed bytes inside base64) in place and keeps, for every
character of the new region, the range of the original text it came from.  A changed region joins the worklist,
is scanned like the text itself, and its matches become spans of the original.  Regions already met
(by digest and place) are not worked on again, so cycles end; the list runs until no decoder changes anything.  Encodings of
different regions do not multiply: the work grows with the regions, not with the ways to mix their layers.
Decoded bytes are read as UTF-8 with any characters, as UTF-16 (by its mark, or by its zero bytes), else one character per
byte where that may hold a match or a further layer.  Concatenated and doubly compressed streams are read to their end.
The base spans always stay.

A vectorised regular expression per Arrow batch picks the texts that need a closer look; the rest cost
one pass over their bytes.

Defined cases: a null text is empty; positions are code points of the original, end exclusive; equal spans
count once; a match inside decompressed bytes has the span of its whole base64 piece; ids may repeat or
be null; extra columns stay out; no rows give no rows.  A piece that decompresses to more than
``MOST_DECOMPRESSED`` bytes is never held whole: it is decompressed as a stream and scanned, and its layers
unwrapped, in overlapping windows; only a match that needs text outside the piece, or a layer longer than a window, is not seen there.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import html
import lzma
import re
import zlib
from collections.abc import Iterator
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm import store

KINDS = ("assign", "access", "hex")
# The patterns of the contract, and the least lengths of group 2 / the match.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

# Necessary for a match of any kind, and for a decoder to change something.
MAY_MATCH = (r"""(?i)(password|passwd|secret|token|api_?key)["']? *[:=] *["']?[A-Za-z0-9+/_.=-]{6}"""
             r"""|(?-i)AKIA[A-Z0-9]{16}|[0-9a-f]{24}""")
MAY_DECODE = r"%[0-9A-Fa-f]{2}|\\[ux]|&#|[A-Za-z0-9+/_-]{16}"

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|(?:\\x[0-9A-Fa-f]{2})+|&#(?:\d{1,7}|[xX][0-9A-Fa-f]{1,6});")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
# What bytes that are no text must show to be worked on.
SIGNS = re.compile(r"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{24}|" + MAY_DECODE)
MOST_DECOMPRESSED = 16 << 20
STREAM_WINDOW, STREAM_OVERLAP = 1 << 20, 64 << 10        # bytes
# What a match or an encoded piece can consist of, in pieces between spaces; and such a piece that no space before or
# after it can join to another, because it neither holds nor can become a colon or an equals sign.
TOKEN = re.compile(r"""[A-Za-z0-9+/_.=\-"':%\\&#;{}]+""")
PLAIN = re.compile(r"[A-Za-z0-9_.\-]{1,15}")

Span = tuple[int, int, int]           # start, kind, end


def scan(text: str) -> list[Span]:
    """The base spans: leftmost, not overlapping per kind, those of enough length."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST_HEX]
    return sorted(out)


def _utf16(data: bytes) -> str | None:
    """The encoding of bytes that look like UTF-16: a mark, or zeros in most high bytes."""
    if data[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return "utf-16-le" if data[0] == 0xFF else "utf-16-be"
    low, high = data[::2].count(0), data[1::2].count(0)
    half = len(data) // 4
    return "utf-16-le" if high > half > low else "utf-16-be" if low > half > high else None


def _readable(data: bytes) -> tuple[str, np.ndarray] | None:
    """The bytes as text, with the end of each character's bytes; None for other bytes without a sign of a match or a layer."""
    if not data:
        return None
    wide = _utf16(data)
    if wide:
        text = data[: len(data) // 2 * 2].decode(wide, errors="replace")
        return text, np.minimum(np.cumsum([4 if ord(c) > 0xFFFF else 2 for c in text]), len(data))
    try:
        text = data.decode()
        return text, np.cumsum([len(c.encode()) for c in text])
    except UnicodeDecodeError:
        text = data.decode("latin-1")
        return (text, np.arange(1, len(data) + 1)) if SIGNS.search(text) else None


MAKERS = ((b"\x1f\x8b", lambda: zlib.decompressobj(31)), (b"\x78", lambda: zlib.decompressobj()),
          (b"BZh", bz2.BZ2Decompressor), (b"\xfd7zXZ", lzma.LZMADecompressor))
BROKEN = (zlib.error, OSError, ValueError, lzma.LZMAError, EOFError)


def _maker(data: bytes):
    return next(((magic, make) for magic, make in MAKERS if data.startswith(magic)), None)


def _decompress(data: bytes) -> bytes | None:
    """The content of gzip, zlib, bzip2 or xz bytes: all their streams, and what follows them; cut behind ``MOST_DECOMPRESSED``."""
    found = _maker(data)
    if found is None:
        return None
    (magic, make), parts, room = found, [], MOST_DECOMPRESSED
    while data.startswith(magic) and room >= 0:
        try:
            d = make()
            part = d.decompress(data, room + 1)
        except BROKEN:
            break
        if not d.eof and not parts and len(part) <= room:
            return None
        parts.append(part)
        room -= len(part)
        data = d.unused_data.lstrip(b"\0") if d.eof else b""
    return b"".join([*parts, data]) if parts else None


def _content(data: bytes) -> bytes | None:
    """What is left when compressed bytes are unwrapped until they are none; None if nothing was; too long if a stage of it is."""
    out, met = _decompress(data), set()
    while out is not None and len(out) <= MOST_DECOMPRESSED and (key := hashlib.sha256(out).digest()) not in met:
        met.add(key)
        inner = _decompress(out)
        if inner is None:
            break
        out = inner
    return out


def _stream(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The bytes of ``chunks``, decompressed while they are compressed, a part at a time."""
    head = b""
    for c in chunks:
        head += c
        if len(head) >= 8:
            break
    found = _maker(head)
    if found is None:
        yield head
        yield from chunks
        return

    def parts() -> Iterator[bytes]:
        (magic, make), data = found, head
        while data.startswith(magic):
            d = make()
            try:
                while not d.eof:
                    piece = d.decompress(data, STREAM_OVERLAP)
                    data = getattr(d, "unconsumed_tail", b"")
                    if piece:
                        yield piece
                    elif not data and getattr(d, "needs_input", True):
                        data = next(chunks, b"")
                        if not data:
                            return
            except BROKEN:
                return
            data = d.unused_data.lstrip(b"\0")
            while len(data) < 8 and (more := next(chunks, b"")):
                data += more
        if data:
            yield data
        yield from chunks
    yield from _stream(parts())


def _stream_kinds(data: bytes) -> set[int]:
    """The kinds of match in the content of compressed bytes that is too long to hold, and in its layers."""
    kinds: set[int] = set()
    buffer = b""

    def look(window: bytes) -> None:
        got = _readable(window)
        if got is None:
            got = window.decode(errors="replace"), None     # a window may cut a character
        kinds.update(k for _, k, _ in scan(got[0]))
        kinds.update(k for _, k, _ in layered_spans(got[0]))

    for part in _stream(iter([data])):
        buffer += part
        if len(buffer) >= STREAM_WINDOW:
            look(buffer)
            buffer = buffer[-STREAM_OVERLAP:]
        if len(kinds) == len(KINDS):
            return kinds
    look(buffer)
    return kinds


class Long:
    """Instead of decoded text: the kinds of match in a piece whose content is too long to hold."""

    def __init__(self, kinds: set[int]):
        self.kinds = kinds


def _percent(m: re.Match) -> tuple[str, list[int], list[int]] | None:
    return _spread(unquote_to_bytes(m.group()), 3)


def _spread(data: bytes, width: int) -> tuple[str, list[int], list[int]] | None:
    """Decoded text with the source range of each character, where each byte took ``width`` characters."""
    text = data.decode(errors="replace")
    if "�" in text:                                  # not UTF-8: one character per byte
        text = data.decode("latin-1")
        ends = np.arange(1, len(data) + 1)
    else:
        ends = np.cumsum([len(c.encode()) for c in text])
    return text, [0, *(ends[:-1] * width).tolist()], (ends * width).tolist()


def _escape(m: re.Match) -> tuple[str, list[int], list[int]] | None:
    s = m.group()
    if s.startswith("\\x"):
        return _spread(bytes.fromhex(s.replace("\\x", "")), 4)
    if s.startswith("\\u{"):
        code = int(s[3:-1], 16)
        return (chr(code), [0], [len(s)]) if code < 0x110000 and not 0xD800 <= code < 0xE000 else None
    if s.startswith("&#"):
        text = html.unescape(s)
        return text, [0] * len(text), [len(s)] * len(text)
    units = bytes.fromhex(s.replace("\\u", ""))
    text = units.decode("utf-16-be", errors="replace")
    ends = np.cumsum([2 if ord(c) > 0xFFFF else 1 for c in text]) * 6
    return text, [0, *ends[:-1].tolist()], ends.tolist()


def _base64_body(s: str, at: np.ndarray, end: int) -> tuple[str, list[int], list[int]] | Long | None:
    """Decoded base64 characters, whose places in the piece are ``at``; the piece ends at ``end``."""
    body = s.replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        data = base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None
    plain = _content(data)
    if plain is not None and len(plain) > MOST_DECOMPRESSED:
        return Long(_stream_kinds(data))
    if plain is not None:
        got = _readable(plain)
        return (got[0], [0] * len(got[0]), [end] * len(got[0])) if got else None
    got = _readable(data)
    if got is None:
        return None
    text, ends = got
    first, last = np.append(0, ends[:-1]), ends - 1       # bytes of each character
    return text, at[first // 3 * 4 + first % 3].tolist(), (at[last // 3 * 4 + last % 3 + 1] + 1).tolist()


def _base64(m: re.Match) -> tuple[str, list[int], list[int]] | None:
    body = m.group().rstrip("=")
    return _base64_body(body, np.arange(len(body)), m.end() - m.start())


class _Wrapped:
    """Pieces of base64 that span lines of one width, the last of which may be shorter; used like a pattern."""

    RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]+(?=={0,2}[ \t]*(?:\r?\n|\Z)))+={0,2}")
    LINE = re.compile(r"[A-Za-z0-9+/_-]+")

    def finditer(self, text: str) -> Iterator[_Piece]:
        for run in self.RUN.finditer(text):
            lines = [(m.start(), m.end()) for m in self.LINE.finditer(text, run.start(), run.end())]
            i = 0
            while i + 1 < len(lines):
                width = lines[i][1] - lines[i][0]
                if i == 0 and text[text.rfind("\n", 0, lines[0][0]) + 1: lines[0][0]].strip():
                    width = max(16, lines[1][1] - lines[1][0])    # the first line holds other text too
                j = i + 1
                while j < len(lines) and lines[j][1] - lines[j][0] == width:
                    j += 1
                size = [z - a for a, z in lines[j: j + 2]]
                if size and size[0] < width and size[1:] != size[:1]:
                    j += 1                                # the end of the piece, not the start of the next
                if j > i + 1 and width >= 16:
                    yield _Piece(text, lines[i:j])
                    i = j
                else:
                    i += 1


class _Piece:
    def __init__(self, text: str, lines: list[tuple[int, int]]):
        self.text, self.lines = text, lines

    def start(self) -> int:
        return self.lines[0][0]

    def end(self) -> int:
        return self.lines[-1][1]


def _wrapped(m: _Piece) -> tuple[str, list[int], list[int]] | None:
    for lines in (m.lines, m.lines[:-1]):                 # a last line may be a word that is not of the piece
        got = _base64_body("".join(m.text[a:z] for a, z in lines),
                           np.concatenate([np.arange(a, z) for a, z in lines]) - m.start(), lines[-1][1] - m.start())
        if got is not None:
            return got
    return None


DECODABLE = re.compile("|".join(p.pattern for p in (PERCENT, ESCAPE)) + r"|[A-Za-z0-9+/_-]{16}")
WRAPPED = _Wrapped()
DECODERS = ((PERCENT, _percent), (ESCAPE, _escape), (BASE64, _base64), (WRAPPED, _wrapped))


def _runs(layer: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Stretches of a line that a match may reach across: tokens, and tokens between spaces unless both are plain words."""
    a = z = -1
    plain = alone = False
    for m in TOKEN.finditer(layer, start, end):
        word = PLAIN.fullmatch(layer, *m.span()) is not None
        if a >= 0 and not (plain and word) and not layer[z: m.start()].strip(" "):
            alone = False
        else:
            if a >= 0 and not alone:
                yield a, z
            a, alone = m.start(), word
        z, plain = m.end(), word
    if a >= 0 and not alone:
        yield a, z


def _regions(layer: str) -> list[tuple[int, int]]:
    """The stretches of a layer that hold something to decode, up to where no match and no piece reaches across.

    That is at any character that is in no match and no piece, and at spaces between plain words.
    """
    out, at = [], 0
    while m := DECODABLE.search(layer, at):                 # only lines with something to decode
        start = layer.rfind("\n", 0, m.start()) + 1
        end = layer.find("\n", m.start())
        end = len(layer) if end < 0 else end
        out += _runs(layer, max(start, at), end)
        at = end + 1
    # Pieces across lines, with the whole of their first and last line.
    for w in WRAPPED.finditer(layer):
        end = layer.find("\n", w.end())
        out.append((layer.rfind("\n", 0, w.start()) + 1, len(layer) if end < 0 else end))
    merged: list[tuple[int, int]] = []
    for a, z in sorted(out):
        if merged and a < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(z, merged[-1][1]))
        else:
            merged.append((a, z))
    return [(a, z) for a, z in merged if DECODABLE.search(layer, a, z)]


def _unwrap(layer: str, starts: np.ndarray, ends: np.ndarray, pattern: re.Pattern, decode, found: set[Span]):
    """The layer with every decodable piece decoded in place, and its map; None if nothing changed."""
    pieces, s, e, at = [], [], [], 0
    for m in pattern.finditer(layer):
        got = decode(m)
        if got is None:
            continue
        a = m.start()
        if isinstance(got, Long):
            found.update((int(starts[a]), k, int(ends[m.end() - 1])) for k in got.kinds)
            continue
        text, p, q = got
        pieces += [layer[at:a], text]
        s += [starts[at:a], starts[a + np.array(p, np.int64)]]
        e += [ends[at:a], ends[a + np.array(q, np.int64) - 1]]
        at = m.end()
    if not pieces:
        return None
    return ("".join([*pieces, layer[at:]]), np.concatenate([*s, starts[at:]]), np.concatenate([*e, ends[at:]]))


def layered_spans(text: str) -> set[Span]:
    """Spans found in the decoded layers of a text, as ranges of the text."""
    found: set[Span] = set()
    identity = np.arange(len(text) + 1)
    work = [(text, identity[:-1], identity[1:])]
    met: set[tuple[int, bytes]] = set()
    while work:
        whole, all_starts, all_ends = work.pop()
        for a, z in _regions(whole):
            layer, starts, ends = whole[a:z], all_starts[a:z], all_ends[a:z]
            for pattern, decode in DECODERS:
                new = _unwrap(layer, starts, ends, pattern, decode, found)
                if new is None:
                    continue
                key = (int(starts[0]), hashlib.sha256(new[0].encode(errors="surrogatepass")).digest())
                if key not in met:
                    met.add(key)
                    work.append(new)
                    found.update((int(new[1][x]), k, int(new[2][y - 1])) for x, k, y in scan(new[0]))
    return found


def join_spans(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for a, k, z in sorted(spans))


def _task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nothing = hashlib.sha256(b"").hexdigest()
    for batch in batches:
        texts = pc.fill_null(batch.column(1), "")
        look = np.asarray(pc.match_substring_regex(texts, MAY_MATCH))
        unwrap = np.asarray(pc.match_substring_regex(texts, MAY_DECODE))
        n = batch.num_rows
        counts, digests, spans = np.zeros((n, 3), np.int64), [nothing] * n, [""] * n
        for i in np.flatnonzero(look | unwrap):
            text = texts[i].as_py()
            base = scan(text) if look[i] else []
            every = set(base) | (layered_spans(text) if unwrap[i] else set())
            for _, k, _ in base:
                counts[i, k] += 1
            if base:
                digests[i] = hashlib.sha256(join_spans(base).encode()).hexdigest()
            if every:
                spans[i] = join_spans(every)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(counts[:, k]) for k in range(3)), pa.array(digests), pa.array(spans)],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex (base spans), base_sha256, and spans (base and decoded)."""
    store.small_batches(docs.sparkSession)
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(_task, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"))
