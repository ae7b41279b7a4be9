"""Secrets in texts and in what is encoded in them, by a recursive decoding worklist.

Every text is scanned as it stands. Then layers are unwrapped until nothing new comes up: runs of
percent escapes, Unicode escapes, character references and UTF-16 (characters that alternate with zero
bytes) are decoded in place, and base64 runs give a layer of their own, inflated as well if they hold
gzip or zlib data. Whatever bytes a layer holds, it is scanned: all patterns are ASCII, so each byte
stands for a character. Each layer is scanned again and
its finds are mapped back to the characters of the original text they were decoded from. A layer met
before at the same place is not followed again, so cycles end.

A find in a layer is added only if decoded characters take part in it; base spans always stay.

Compressed data are inflated to their end, all members. A layer of more than ``INFLATE_BYTES`` is not
held: it is made piece by piece, as often as needed, and gone through in windows that end where no
find, escape or base64 run can reach across. A run longer than a window is decoded as a layer made
piece by piece in turn. So memory is bounded, and time grows with what the data inflate to.

Null and empty texts have no spans. Ids are not looked at; repeated rows are scanned one by one.

Extra columns pass through; an empty table gives no rows. A very long text is scanned whole, as one string.
"""

from __future__ import annotations

import binascii
import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideglass.llm.arrowtext import byte_class, text_bytes
from tideglass.llm.common import with_text_column

#: Kinds in their order, their patterns, and the fewest characters (of the second
#: group for assignments, of the whole match otherwise).
KINDS = ("assign", "access", "hex")
PATTERNS = {
    "assign": re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE | re.ASCII,
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}
LEAST = {"assign": 6, "access": 20, "hex": 24}
_LONG_HEX = re.compile("[0-9a-f]{%d,}" % LEAST["hex"])
_NAMES = ("passw", "secret", "token", "api")

#: Bytes of an inflated layer that a worker holds at once, about, and of a step of inflating.
INFLATE_BYTES = 64 << 20
_PIECE = 1 << 18
#: Characters of base64 looked at to tell whether compressed data begin in a run too long to be held.
_PROBE = 4096

#: The fewest characters of a base64 run: twelve bytes hold the shortest assignment.
BASE64_RUN = 16
_ESCAPES = {
    "url": re.compile(r"(?:%[0-9A-Fa-f]{2})+"),
    "unicode": re.compile(
        r"(?:\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2})+"
    ),
    "reference": re.compile(r"(?:&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});)+"),
    "wide": re.compile(r"(?:[^\x00]\x00){4,}|(?:\x00[^\x00]){4,}"),
}
_UNIT = re.compile(r"\\u\{([0-9A-Fa-f]+)\}|\\[uUx]([0-9A-Fa-f]+)")
_REFERENCE = re.compile(r"&#(?:([0-9]+)|[xX]([0-9A-Fa-f]+));")
_BASE64 = re.compile(
    r"(?:[A-Za-z0-9+/]{60,76}\r?\n)+[A-Za-z0-9+/]+={0,2}|[A-Za-z0-9+/_-]{%d,}={0,2}" % BASE64_RUN
)
#: Where a payload may begin within a run: after a separator, and at heads of gzip and zlib data.
_STARTS = re.compile(rb"[/_-]|H4sI|e[AFJN]")
#: What a layer must hold for anything to be found in it.
_HOLDS = re.compile(
    rb"passw|secret|token|api|AKIA|[0-9a-f]{%d}|%%[0-9A-Fa-f]{2}|\\[uUx]|&#|[A-Za-z0-9+/_-]{%d}"
    rb"|(?:[^\x00]\x00){4}|(?:\x00[^\x00]){4}" % (LEAST["hex"], BASE64_RUN),
    re.IGNORECASE,
)
_ODD = re.compile(rb"[\x01-\x08\x0b\x0c\x0e-\x1f\x7f]")

_HEX_BYTES = ~byte_class([(0x30, 0x39), (0x61, 0x66)])
_RUN_BYTES = ~byte_class([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)] + [(ord(c), ord(c)) for c in "+/_-"])
_ESCAPE_BYTES = ~byte_class([(ord(c), ord(c)) for c in "%\\&\0"])


@dataclass(frozen=True)
class Layer:
    """A decoded text and where its characters come from: piece ``i`` starts at ``new[i]`` and stands
    for the original characters from ``start[i]`` to ``end[i]``. Characters of a ``literal`` piece
    stand one for one; any of another piece stands for the whole of it."""

    text: str
    new: list[int]
    start: list[int]
    end: list[int]
    literal: list[bool]
    is_bytes: bool = False

    def piece(self, at: int) -> int:
        return bisect_right(self.new, at) - 1

    def origin(self, begin: int, stop: int) -> tuple[int, int]:
        i, j = self.piece(begin), self.piece(stop - 1)
        first = self.start[i] + (begin - self.new[i] if self.literal[i] else 0)
        last = self.start[j] + (stop - self.new[j]) if self.literal[j] else self.end[j]
        return first, last

    def decoded(self, begin: int, stop: int) -> bool:
        return not all(self.literal[self.piece(begin) : self.piece(stop - 1) + 1])


def plain_layer(text: str) -> Layer:
    return Layer(text, [0], [0], [len(text)], [True])


def scan(text: str) -> Iterator[tuple[str, int, int]]:
    """Kind, start and end of the secrets that stand in ``text``, by kind."""
    low = text.lower()
    if any(name in low for name in _NAMES):
        for match in PATTERNS["assign"].finditer(text):
            if len(match.group(2)) >= LEAST["assign"]:
                yield "assign", match.start(), match.end()
    if "AKIA" in text:
        for match in PATTERNS["access"].finditer(text):
            if match.end() - match.start() >= LEAST["access"]:
                yield "access", match.start(), match.end()
    for match in _LONG_HEX.finditer(text):
        yield "hex", match.start(), match.end()


def _unicode(run: str) -> str:
    units = [int(a or b, 16) for a, b in _UNIT.findall(run)]
    raw = b"".join(
        u.to_bytes(2, "big") if u < 0x10000 else chr(u).encode("utf-16-be")
        for u in units
        if u < 0x110000
    )
    return raw.decode("utf-16-be", "replace")


def _references(run: str) -> str:
    codes = [int(a) if a else int(b, 16) for a, b in _REFERENCE.findall(run)]
    return "".join(chr(c) if c < 0x110000 and not 0xD800 <= c < 0xE000 else "\ufffd" for c in codes)


def _percent(run: str) -> str:
    return binascii.unhexlify(run.replace("%", "")).decode("utf-8", "replace")


def _wide(run: str) -> str:
    return run.replace("\0", "")


_DECODE = {"url": _percent, "unicode": _unicode, "reference": _references, "wide": _wide}


def unescape(layer: Layer, kind: str) -> Layer | None:
    """``layer`` with all runs of one kind of escape decoded in place, or None without any."""
    text = layer.text
    parts: list[str] = []
    new: list[int] = []
    start: list[int] = []
    end: list[int] = []
    literal: list[bool] = []
    at = size = 0

    def keep(a: int, b: int) -> None:
        nonlocal size
        while a < b:  # by the pieces of the layer
            i = layer.piece(a)
            stop = min(b, layer.new[i + 1]) if i + 1 < len(layer.new) else b
            first, last = layer.origin(a, stop)
            new.append(size)
            start.append(first)
            end.append(last)
            literal.append(layer.literal[i])
            parts.append(text[a:stop])
            size += stop - a
            a = stop

    for match in _ESCAPES[kind].finditer(text):
        keep(at, match.start())
        value = _DECODE[kind](match.group())
        if value:
            first, last = layer.origin(match.start(), match.end())
            new.append(size)
            start.append(first)
            end.append(last)
            literal.append(False)
            parts.append(value)
            size += len(value)
        at = match.end()
    if at == 0:
        return None
    keep(at, len(text))
    return Layer("".join(parts), new, start, end, literal) if size else None


def _bits(raw: bytes) -> int:
    """What zlib must be told to inflate data with this beginning; 0 if they are not compressed."""
    if raw[:2] == b"\x1f\x8b":
        return 31
    return 15 if len(raw) > 2 and raw[0] & 0x0F == 8 and ((raw[0] << 8) | raw[1]) % 31 == 0 else 0


def inflated(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """What compressed data inflate to, member after member, in pieces; of broken data, what comes
    before the break. Zero bytes may stand between members."""
    data = b""
    while True:
        while len(data) < 3 and (more := next(chunks, None)) is not None:
            data = (data + more).lstrip(b"\0")
        bits = _bits(data)
        if not bits:
            return
        member = zlib.decompressobj(bits)
        while not member.eof:
            before = member.copy()
            try:
                out = member.decompress(data, _PIECE)
            except zlib.error:
                yield from _until_break(before, data)
                return
            if out:
                yield out
            data = member.unconsumed_tail
            if not data and not member.eof and len(out) < _PIECE and not (data := next(chunks, b"")):
                return
        data = member.unused_data.lstrip(b"\0")


def _chunks(raw: bytes, begin: int) -> Iterator[bytes]:
    for at in range(begin, len(raw), _PIECE):
        yield raw[at : at + _PIECE]


def _members_size(raw: bytes, begin: int) -> int:
    """How many bytes the members from a place on take that end."""
    size = at = begin
    while bits := _bits(raw[at : at + 3]):
        member = zlib.decompressobj(bits)
        try:
            for data in _chunks(raw, at):
                at += len(data)
                while not member.eof and (data or out):
                    out = member.decompress(data, _PIECE)
                    data = member.unconsumed_tail
                if member.eof:
                    break
        except zlib.error:
            break
        if not member.eof:
            break
        size = at = at - len(member.unused_data)
        while raw[at : at + 1] == b"\0":
            at += 1
    return size - begin


def _is_utf8(raw: bytes) -> bool:
    try:
        raw.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return not _ODD.search(raw)


def _is_garbage(raw: bytes) -> bool:
    return bool(_ODD.search(raw)) or raw.decode("utf-8", "replace").count("\ufffd") * 10 > 3 * len(raw)


def _inflates(probe: bytes) -> bool:
    """Whether these first bytes of compressed data are sound, or give anything to scan."""
    try:
        zlib.decompressobj(_bits(probe)).decompress(probe, _PIECE)
        return True
    except zlib.error:
        return _HOLDS.search(b"".join(inflated(iter([probe])))) is not None


def _until_break(member, data: bytes) -> Iterator[bytes]:
    for i in range(len(data)):
        try:
            out = member.decompress(data[i : i + 1], _PIECE)
            while out:
                yield out
                out = member.decompress(member.unconsumed_tail, _PIECE)
        except zlib.error:
            return


@dataclass(frozen=True)
class Stream:
    """A layer too long to be held: its pieces can be made again and again. All of it stands for the
    original characters from ``start`` to ``end``."""

    pieces: Callable[[], Iterator[bytes]]
    start: int
    end: int

    def within(self, begin: int, stop: int) -> Iterator[bytes]:
        at = 0
        for piece in self.pieces():
            if at >= stop:
                return
            if at + len(piece) > begin:
                yield piece[max(begin - at, 0) : stop - at]
            at += len(piece)

    def digest(self) -> bytes:
        sums = hashlib.blake2b(digest_size=16)
        for piece in self.pieces():
            sums.update(piece)
        return sums.digest()


def _held(pieces: Callable[[], Iterator[bytes]]) -> bytes | None:
    """All bytes, if they are few enough to be held."""
    parts, size = [], 0
    for piece in pieces():
        parts.append(piece)
        size += len(piece)
        if size > INFLATE_BYTES:
            return None
    return b"".join(parts)


#: Where a text can be cut: after characters that are in no pattern, after a line too short to be one
#: of wrapped base64, among zero bytes, and between words.
_CUT = re.compile(
    rb"[^A-Za-z0-9+/_=\-.%\\&#;{}:\"'\x20\r\n\x00]|(?<![^\n])[^\n]{0,59}\n|\x00{4}"
    rb"|[A-Za-z0-9.]\x20(?=[A-Za-z0-9])"
)
_LEADS = re.compile(rb"[%\\&\x00]")


def _cut(data: bytes, last: bool) -> int:
    """The last place in the final megabyte, or the first of all, where ``data`` can be cut; 0 if none."""
    found = 0
    for match in _CUT.finditer(data, max(1, len(data) - (1 << 20)) if last else 1):
        at = match.end()
        if match.group()[-1:] == b" " and _LEADS.search(data, max(0, at - 200), at):
            continue  # perhaps an assignment in escapes
        found = at
        if not last:
            break
    return found


def _windows(stream: Stream) -> Iterator[tuple[int, int, bytes | None]]:
    """Begin, end and bytes of the parts of a stream; no bytes for parts too long to be held."""
    begin, parts, size, long = 0, [], 0, 0
    for piece in stream.pieces():
        parts.append(piece)
        size += len(piece)
        if long:  # only the last bytes are kept
            data = b"".join(parts)
            cut = _cut(data, last=False)
            if cut:
                stop = long + cut
                yield begin, stop, None
                begin, parts, size, long = stop, [data[cut:]], len(data) - cut, 0
            else:
                keep = data[-256:]
                long += len(data) - len(keep)
                parts, size = [keep], len(keep)
        elif size >= INFLATE_BYTES:
            data = b"".join(parts)
            cut = _cut(data, last=True) or _cut(data, last=False)
            if cut:
                yield begin, begin + cut, data[:cut]
                begin, parts, size = begin + cut, [data[cut:]], len(data) - cut
            else:
                keep = data[-256:]
                long = begin + len(data) - len(keep)
                parts, size = [keep], len(keep)
    if long:
        yield begin, long + size, None
    elif size:
        yield begin, begin + size, b"".join(parts)


def _scan_pieces(pieces: Iterator[bytes]) -> set[str]:
    """Kinds of the secrets in a text that comes in pieces."""
    kinds: set[str] = set()
    tail = ""
    for piece in pieces:
        text = re.sub(" {3,}", "  ", tail + piece.decode("latin-1"))
        kinds.update(kind for kind, _, _ in scan(text))
        start = max(0, len(text) - 96)
        for match in PATTERNS["assign"].finditer(text):
            if match.end() < len(text):
                start = max(start, match.end())
        tail = text[start:]
    return kinds


_ALTERNATING = re.compile(r"\x00?(?:[^\x00]\x00)*[^\x00]?\Z")


def _unescape_pieces(pieces: Iterator[bytes], kind: str) -> Iterator[bytes]:
    """A text that comes in pieces with all runs of one kind of escape decoded in place."""

    def decoded(text: str) -> bytes:
        return _ESCAPES[kind].sub(lambda m: _DECODE[kind](m.group()), text).encode("latin-1", "replace")

    tail = ""
    for piece in pieces:
        text = tail + piece.decode("latin-1")
        if kind == "wide":  # both sides of a cut keep enough of a run
            open_run = len(_ALTERNATING.search(text[-64:]).group())
            cut = len(text) - (open_run if open_run < 64 else 32)
        else:
            lead = max(text.rfind(c, max(0, len(text) - 12)) for c in "%\\&")
            cut = lead if lead >= 0 else len(text)
        yield decoded(text[:cut])
        tail = text[cut:]
    yield decoded(tail)


_ALPHABET = bytes.maketrans(b"-_", b"+/")
_RUN = re.compile(rb"[A-Za-z0-9+/_=\r\n-]+")
_NO_BASE64 = re.compile(rb"[^A-Za-z0-9+/]+")


def _base64_pieces(pieces: Iterator[bytes], skip: int) -> Iterator[bytes]:
    """The bytes in base64 that comes in pieces, without its first ``skip`` characters."""
    tail = b""
    for piece in pieces:
        clean = _NO_BASE64.sub(b"", piece.translate(_ALPHABET))
        drop = min(skip, len(clean))
        skip -= drop
        body = tail + clean[drop:]
        whole = len(body) - len(body) % 4
        yield binascii.a2b_base64(body[:whole])
        tail = body[whole:]
    if len(tail) > 1:
        yield binascii.a2b_base64(tail + b"=" * (4 - len(tail)))


def _long_part(stream: Stream, begin: int, stop: int) -> Iterator[Stream]:
    """The layers in a part of a stream that cannot be held."""
    escapes: set[str] = set()
    runs: list[list[int]] = []  # begin and end of base64 runs
    at, tail = begin, b""
    for piece in stream.within(begin, stop):
        text = (tail + piece).decode("latin-1")
        escapes.update(kind for kind, pattern in _ESCAPES.items() if pattern.search(text))
        tail = piece[-64:]
        for match in _RUN.finditer(piece):
            if runs and runs[-1][1] == at + match.start():
                runs[-1][1] = at + match.end()
                continue
            if runs and runs[-1][1] - runs[-1][0] < BASE64_RUN:
                runs.pop()
            runs.append([at + match.start(), at + match.end()])
        at += len(piece)
    for kind in sorted(escapes):
        made = lambda kind=kind: _unescape_pieces(stream.within(begin, stop), kind)
        yield Stream(made, stream.start, stream.end)
    for a, b in runs:
        if b - a >= BASE64_RUN:
            for skip in range(4):
                made = lambda a=a, b=b, skip=skip: _base64_pieces(stream.within(a, b), skip)
                yield Stream(made, stream.start, stream.end)
            yield from _heads(stream, a, b)


def _heads(stream: Stream, begin: int, stop: int) -> Iterator[Stream]:
    """What compressed data inflate to that begin within a long base64 run."""
    at, data = begin, b""
    for piece in chain(stream.within(begin, stop), [None]):
        last = piece is None
        data += piece or b""
        ready = len(data) if last else max(0, len(data) - _PROBE)
        for m in _STARTS.finditer(data, 0, ready):
            place = m.end() if len(m.group()) == 1 else m.start()
            probe = b"".join(_base64_pieces(iter([data[place : place + _PROBE]]), 0))
            if _bits(probe) and _inflates(probe):
                made = lambda a=at + place: inflated(_base64_pieces(stream.within(a, stop), 0))
                yield Stream(made, stream.start, stream.end)
        kept = max(0, ready - 3)  # of a head that is cut
        at, data = at + kept, data[kept:]


def _byte_layer(pieces: Callable[[], Iterator[bytes]], first: int, last: int) -> Layer | Stream:
    """Bytes as a layer. All patterns are ASCII, so each byte can stand for a character."""
    raw = _held(pieces)
    if raw is None:
        return Stream(pieces, first, last)
    return Layer(raw.decode("latin-1"), [0], [first], [last], [False], True)


def _inner(layer: Layer | Stream) -> Layer | Stream | None:
    """What the bytes of a layer inflate to."""
    if isinstance(layer, Stream):
        pieces, first, last = layer.pieces, layer.start, layer.end
        head = b""
        for piece in pieces():
            head += piece
            if len(head) > 2:
                break
    else:
        raw = layer.text.encode("latin-1")
        pieces, first, last, head = lambda: iter([raw]), layer.start[0], layer.end[-1], raw
    return _byte_layer(lambda: inflated(iter(pieces())), first, last) if _bits(head) else None


def _base64_layers(layer: Layer) -> Iterator[Layer | Stream]:
    """The layers in base64 runs, of either alphabet, padded or not. A run may be joined to a payload
    by characters of its own alphabet. Where a payload begins only matters modulo 4 for its bytes, so
    all four beginnings of a run are decoded, and finds are mapped to the likely payload."""
    for match in _BASE64.finditer(layer.text):
        whole = match.group().encode("ascii")
        places = None
        if b"\n" in whole:
            places = [m.start() for m in re.finditer(rb"[^\r\n]", whole)]
            whole = re.sub(rb"[\r\n]+", b"", whole)
        run = whole.rstrip(b"=")
        begins: list[list[int]] = [[], [], [], []]
        for m in _STARTS.finditer(run):
            at = m.end() if len(m.group()) == 1 else m.start()
            begins[at % 4].append(at)
        standard = run.translate(_ALPHABET)

        def origin(at: int) -> int:
            return layer.origin(match.start() + (places[at] if places else at), match.end())[0]

        last = layer.origin(match.start(), match.end())[1]
        for skip in range(4):
            body = standard[skip:]
            if len(body) % 4 == 1:
                body = body[:-1]
            raw = binascii.a2b_base64(body + b"=" * (-len(body) % 4))
            if not raw:
                continue
            new, start = [0], [origin(skip)]
            plain = _is_utf8(raw)
            before = done = 0
            open_head = None
            for at in [skip, *(at for at in begins[skip] if at > skip)]:
                byte = (at - skip) // 4 * 3
                if _bits(raw[byte : byte + 3]):
                    if open_head is not None:
                        done, open_head = open_head + _members_size(raw, open_head), None
                    if byte >= done:
                        made = lambda byte=byte, raw=raw: inflated(_chunks(raw, byte))
                        inner = _byte_layer(made, origin(at), last)
                        if isinstance(inner, Stream) or inner.text:
                            yield inner
                            open_head = byte
                if not plain and byte > before and _is_garbage(raw[before:byte]):
                    new.append(byte)  # the payload may begin here
                    start.append(origin(at))
                before = byte
            if _HOLDS.search(raw):
                size = len(new)
                yield Layer(raw.decode("latin-1"), new, start, [last] * size, [False] * size)


def _follow(worklist: list[Layer | Stream], seen: set[tuple[bytes, int, int]]) -> set[tuple[str, int, int]]:
    """Kind, start and end of all that is found in layers and in the layers within them."""
    added: set[tuple[str, int, int]] = set()
    while worklist:
        layer = worklist.pop()
        if isinstance(layer, Stream):
            mark = (layer.digest(), layer.start, layer.end)
            if mark not in seen:
                seen.add(mark)
                added |= _follow_stream(layer, seen)
                worklist.extend(filter(None, [_inner(layer)]))
            continue
        digest = hashlib.blake2b(layer.text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        mark = (digest, layer.start[0], layer.end[-1])
        if mark in seen:
            continue
        seen.add(mark)
        for kind, a, b in scan(layer.text):
            if layer.decoded(a, b):
                added.add((kind, *layer.origin(a, b)))
        for kind in _ESCAPES:
            inner = unescape(layer, kind)
            if inner is not None and inner.text != layer.text:
                worklist.append(inner)
        worklist.extend(_base64_layers(layer))
        if layer.is_bytes:
            worklist.extend(filter(None, [_inner(layer)]))
    return added


def _follow_stream(stream: Stream, seen: set[tuple[bytes, int, int]]) -> set[tuple[str, int, int]]:
    added: set[tuple[str, int, int]] = set()
    for begin, stop, data in _windows(stream):
        if data is None:
            kinds = _scan_pieces(stream.within(begin, stop))
            added |= {(kind, stream.start, stream.end) for kind in kinds}
            inner: list[Layer | Stream] = list(_long_part(stream, begin, stop))
        else:
            inner = [Layer(data.decode("latin-1"), [0], [stream.start], [stream.end], [False])]
        added |= _follow(inner, set(seen))  # what is seen in a window is not kept
    return added


def find_secrets(text: str, layers: bool = True) -> tuple[list, list]:
    """Base spans and added spans of one text: sorted lists of (start, kind's place, end)."""
    base = {(kind, a, b) for kind, a, b in scan(text)}
    added = _follow([plain_layer(text)], set()) if layers else set()
    order = lambda spans: sorted((a, KINDS.index(kind), b) for kind, a, b in spans)
    return order(base), order(added - base)


def _flags(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, least: int) -> np.ndarray:
    """Which texts hold a run of at least ``least`` bytes of a class."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = kind[data]
    change = np.flatnonzero(np.diff(inside))
    start, end = change[::2], change[1::2]
    hit = start[end - start >= least]
    out = np.zeros(len(offsets) - 1, dtype=bool)
    out[np.searchsorted(offsets, hit, side="right") - 1] = True
    return out


SPANS = "array<struct<start: long, kind: string, end: long, base: boolean>>"
_SPAN_TYPE = pa.list_(
    pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64()), ("base", pa.bool_())])
)


def _batch_spans(column: pa.Array, layers: bool) -> list[list[tuple]]:
    """Sorted (start, kind's place, end, base) of each text of a batch."""
    data, offsets = text_bytes(column)
    # Only texts that can hold anything are looked at one by one.
    wanted = (
        _flags(data, offsets, _HEX_BYTES, LEAST["hex"])
        | _flags(data, offsets, _RUN_BYTES, BASE64_RUN)
        | _flags(data, offsets, _ESCAPE_BYTES, 1)
    )
    found: list[list[tuple]] = []
    for at, value in enumerate(column):
        value = value.as_py() or ""
        low = value.lower()
        if wanted[at] or "AKIA" in value or any(name in low for name in _NAMES):
            base, added = find_secrets(value, layers)
            found.append(sorted([(*s, True) for s in base] + [(*s, False) for s in added]))
        else:
            found.append([])
    return found


def _masked(value: str, spans: list[tuple], mark: str) -> str:
    parts, at = [], 0
    for start, _, end, _ in spans:
        if end <= at:
            continue
        if start >= at:
            parts += [value[at:start], mark]
        at = end
    return "".join([*parts, value[at:]])


def secret_spans(documents: DataFrame, text: str = "text", layers: bool = True) -> DataFrame:
    """``documents`` with a column ``secrets``: spans in characters (code points) of the text, in
    order, each with its kind and whether it stands in the text as it is (``base``) or was found in
    a decoded layer. A column of that name is replaced."""

    def make(column: pa.Array) -> pa.Array:
        rows = [
            [{"start": a, "kind": KINDS[k], "end": b, "base": here} for a, k, b, here in spans]
            for spans in _batch_spans(column, layers)
        ]
        return pa.array(rows, type=_SPAN_TYPE)

    return with_text_column(documents, text, make, "secrets", SPANS)


def redact(documents: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``documents`` with every secret in ``text`` replaced by ``mark``; overlapping spans give one
    mark. Texts without secrets, and nulls, stay as they are."""

    def make(column: pa.Array) -> pa.Array:
        values = [
            _masked(value.as_py(), spans, mark) if spans else value.as_py()
            for value, spans in zip(column, _batch_spans(column, True))
        ]
        return pa.array(values, type=pa.string())

    cleaned = with_text_column(documents, text, make, text, "string")
    return cleaned.select(*[F.col(f"`{name}`") for name in documents.columns])
