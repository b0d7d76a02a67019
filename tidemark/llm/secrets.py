"""Secrets in texts, also under layers of encoding.

A worklist starts with the text itself. Every layer is scanned; then its encoded stretches are
unwrapped into new layers, which join the worklist until none is new:

* URL escapes (%41) and Unicode escapes (\\u0041, \\x41, \\101, \\U00000041, &#65;, &#x41;): the layer
  with all of them replaced, so that a secret split by escapes is seen in its surroundings;
* base64, plain or URL-safe, in one line or several, also behind other letters of its alphabet: the decoded stretch, if it holds a readable run (also in UTF-16) or a compressed stream;
* gzip, zlib, bzip2, xz and zstandard streams inside base64 or written in URL or backslash escapes: the expanded text of
  all members; raw deflate, which has no mark of its own, where it fills the rest of its base64.

A layer whose content was seen before in this document is not unwrapped again, which ends
cycles. Each layer maps its characters to spans of the layer it came from, hence in the end to
the original text: a secret is reported at the characters that hold it.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections import deque
from collections.abc import Iterator
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import per_batch, read_table, texts_of

KINDS = ("assign", "access", "hex")

# What counts as a secret.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
ASSIGN_VALUE = 12
ASSIGN_WORDS = ("passw", "secret", "token", "api")

URL_ESCAPE = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE_ESCAPE = re.compile(
    r"((?:\\u[0-9A-Fa-f]{4})+)|\\x([0-9A-Fa-f]{2})|\\U([0-9A-Fa-f]{8})|\\u\{([0-9A-Fa-f]{1,6})\}|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});|\\([0-3][0-7]{2})"
)
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
#: Base64 in lines: ends of lines as such or as in JSON, each line nothing but its stretch.
LINE_END = r"(?:\r?\n|(?:\\r)?\\n)[\x20\t>]*"
BASE64_LINES = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{4,}}+(?:{LINE_END}[A-Za-z0-9+/_-]++)++(?![A-Za-z0-9+/_-])={{0,2}}")
BREAK = re.compile(LINE_END)
#: Where a compressed stream may begin inside decoded bytes; zlib's two bytes are only tried after a separator.
MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9]1AY&SY|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
SEPARATOR = re.compile(r"[/_-]")
#: The first bytes of a stream; for zlib those of the usual levels.
FIRST_BYTES = (b"\x1f\x8b\x08", b"BZh", b"\xfd7zXZ\x00", b"\x28\xb5\x2f\xfd", b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda")
#: Bytes behind a backslash that stand for others.
NAMED = {"a": 7, "b": 8, "t": 9, "n": 10, "v": 11, "f": 12, "r": 13}
BACKSLASH = re.compile(r"\\(?:x([0-9A-Fa-f]{2})|u00([0-9A-Fa-f]{2})|([0-3][0-7]{2}|[0-7]{1,2})|([abtnvfr])|(.))", re.DOTALL)

#: A stream that holds more bytes than this and eight times the document's characters is never held
#: whole: it is read in windows of that size, each of which repeats the second half of the one
#: before, and is counted in ``n_folded``. Every byte is scanned; what a window cuts is whole in the
#: next one if it has up to half a window. This bounds the memory that one document takes.
MOST_CHARS = 1 << 22


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the secrets written openly in ``text``."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class Layer:
    """A text and, for each of its characters, the span of the original that holds it."""

    def __init__(self, text: str, begins: np.ndarray | None = None, ends: np.ndarray | None = None):
        self.text, self.begins, self.ends = text, begins, ends  # no arrays: the original itself
        self.packed = False  # from a compressed stream, so its size has no bound by its parent's

    def original(self, begin: int, end: int) -> tuple[int, int]:
        """The span of the original that holds the characters ``begin`` to ``end``."""
        if self.begins is None:
            return begin, end
        return int(self.begins[begin:end].min()), int(self.ends[begin:end].max())

    def child(self, text: str, begins: np.ndarray, ends: np.ndarray) -> Layer:
        """A layer whose characters lie at ``begins`` to ``ends`` of this one."""
        if self.begins is None:
            return Layer(text, begins, ends)
        return Layer(text, self.begins[begins], self.ends[ends - 1])


def _replaced(layer: Layer, matches: Iterator[re.Match], decode) -> Layer | None:
    """The layer with each match replaced by ``decode`` of it: (text, begins, ends of its characters in the match)."""
    texts, begins, ends, at = [], [], [], 0

    def copied(to: int) -> None:
        texts.append(layer.text[at:to])
        begins.append(np.arange(at, to))
        ends.append(np.arange(at + 1, to + 1))

    for m in matches:
        if (new := decode(m)) is None:
            continue
        text, inner_begins, inner_ends = new
        copied(m.start())
        texts.append(text)
        begins.append(np.asarray(inner_begins, np.int64) + m.start())
        ends.append(np.asarray(inner_ends, np.int64) + m.start())
        at = m.end()
    if not at:
        return None
    copied(len(layer.text))
    return layer.child("".join(texts), np.concatenate(begins), np.concatenate(ends))


def _utf8_places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """First byte and the byte behind the last of each character in UTF-8; a byte that is none has a character of its own."""
    if text.isascii():
        sizes = np.ones(len(text), np.int64)
    else:
        points = _points(text)
        sizes = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        sizes[(points >= 0xDC80) & (points <= 0xDCFF)] = 1
    ends = np.cumsum(sizes)
    return ends - sizes, ends


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _url_run(m: re.Match):
    text = unquote_to_bytes(m.group()).decode(errors="surrogateescape")
    begins, ends = _utf8_places(text)
    return text, 3 * begins, 3 * ends


def _unicode_run(m: re.Match):
    if m.group(1):
        units = bytes.fromhex(m.group(1).replace("\\u", ""))
        text = units.decode("utf-16-be", "surrogatepass")
        sizes = np.where(_points(text) < 0x10000, 6, 12).astype(np.int64)
        ends = np.cumsum(sizes)
        return text, ends - sizes, ends
    point = int(m.group(5)) if m.group(5) else int(m.group(7), 8) if m.group(7) else int(next(g for g in m.groups()[1:] if g), 16)
    if point > 0x10FFFF or 0xD800 <= point < 0xE000:
        return None
    return chr(point), [0], [m.end() - m.start()]


def _readings(data: bytes) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Texts that ``data`` may be, with the first byte and the byte behind the last of each character.

    No secret is shorter than ``SHORTEST`` characters, all of them printable ASCII, and neither is
    any encoded form of one. So data without such a run can be left alone, whatever its other
    bytes are; data with one is taken whole, bytes that are not UTF-8 as characters of their own.
    """
    text = data.decode(errors="surrogateescape")
    if RUN.search(data) or text and text.translate(_SPACES).isprintable():
        yield text, *_utf8_places(text)
    longest = {}
    for order, wide in WIDE.items():
        for m in wide.finditer(data):
            longest[order, m.start() % 2] = max(longest.get((order, m.start() % 2), 0), m.end() - m.start())
    # Text of the one order looks like that of the other a byte earlier or later.
    for pair in ((("utf-16-le", 0), ("utf-16-be", 1)), (("utf-16-be", 0), ("utf-16-le", 1))):
        order, skip = max(pair, key=lambda p: longest.get(p, 0))
        if (order, skip) not in longest:
            continue
        odd = (len(data) - skip) % 2
        whole = data[skip:] + b"\0" if odd and order == "utf-16-le" else data[skip : len(data) - odd]
        text = whole.decode(order, "surrogatepass")
        ends = skip + np.cumsum(np.where(_points(text) < 0x10000, 2, 4))
        yield text, np.concatenate(([skip], ends[:-1])), np.minimum(ends, len(data))


_SPACES = {9: " ", 10: " ", 13: " "}
SHORTEST = 16
RUN = re.compile(rb"[\x20-\x7e\t\r\n]{%d}" % SHORTEST)
WIDE = {
    "utf-16-le": re.compile(rb"(?:[\x20-\x7e\t\r\n]\x00){%d,}" % SHORTEST),
    "utf-16-be": re.compile(rb"(?:\x00[\x20-\x7e\t\r\n]){%d,}" % SHORTEST),
}


def _opened(data: bytes):
    """A decompressor of the stream that ``data`` begins with, or None."""
    if data[:2] == b"\x1f\x8b" or data[:1] == b"\x78" and len(data) > 2 and (data[0] << 8 | data[1]) % 31 == 0:
        return zlib.decompressobj(47)
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    if data[:4] == b"\x28\xb5\x2f\xfd" or data[1:4] == b"\x2a\x4d\x18" and data[0] >> 4 == 5:  # a frame, or one to be skipped
        return zstandard.ZstdDecompressor(max_window_size=1 << 27).stream_reader(data, read_across_frames=True)
    return None


def _pieces(data: bytes, raw: bool = False, size: int = 1 << 18) -> Iterator[bytes]:
    """What the compressed streams hold that ``data`` begins with, one member after another, up to a damaged place.

    ``raw``: the first one is deflate without a header.
    """
    while (stream := zlib.decompressobj(-15) if raw else _opened(data)) is not None:
        raw = False
        try:
            if hasattr(stream, "read"):
                while piece := stream.read(size):
                    yield piece
                return
            rest = data
            while not stream.eof:
                piece = stream.decompress(rest, size)
                rest = getattr(stream, "unconsumed_tail", b"")
                if piece:
                    yield piece
                elif not rest and getattr(stream, "needs_input", True):
                    return  # cut off
        except (zlib.error, OSError, lzma.LZMAError, EOFError, zstandard.ZstdError):
            return
        data = stream.unused_data.lstrip(b"\0")  # padding between members


def _windows(data: bytes, most: int, raw: bool = False) -> Iterator[bytes]:
    """What the compressed streams hold that ``data`` begins with: one window if that is at most ``most`` bytes, else overlapping ones."""
    held, size, fresh = [], 0, 0
    for piece in _pieces(data, raw):
        held.append(piece)
        size += len(piece)
        fresh += len(piece)
        if size > most:
            whole = b"".join(held)
            yield whole[:most]
            rest = whole[most // 2 :]
            while len(rest) > most:
                yield rest[:most]
                rest = rest[most // 2 :]
            held, size, fresh = [rest], len(rest), len(rest) - (most - most // 2)
    if fresh > 0:
        yield b"".join(held)


def _runs(text: str) -> Iterator[tuple[str, np.ndarray | int, list[int]]]:
    """Base64 runs of ``text``, each with the place of its characters, or of the first if they follow each other, and where its lines begin in it.

    Lines of one width, and a last one that is not wider, are one run; each of their lines is a run as well.
    """
    for m in BASE64.finditer(text):
        yield m.group().rstrip("="), m.start(), [0]
    if "\n" not in text and "\\n" not in text:
        return
    for m in BASE64_LINES.finditer(text):
        lines, at = [], m.start()
        for gap in BREAK.finditer(text, m.start(), m.end()):
            lines.append((at, gap.start()))
            at = gap.end()
        lines.append((at, at + len(text[at : m.end()].rstrip("="))))
        while len(lines) > 1:
            # The first line may have a key before it, and the lines behind the last one may be words.
            width = lines[1][1] - lines[1][0]
            n = 2
            while n < len(lines) and lines[n - 1][1] - lines[n - 1][0] == width >= lines[n][1] - lines[n][0]:
                n += 1
            if sum(e - b for b, e in lines[:n]) >= SHORTEST:
                begins = np.cumsum([0, *(e - b for b, e in lines[: n - 1])]).tolist()
                yield "".join(text[b:e] for b, e in lines[:n]), np.concatenate([np.arange(b, e) for b, e in lines[:n]]), begins
            lines = lines[n - 1 :] if n < len(lines) else []


def _unfolded(data: bytes, most: int, raw: bool = False) -> Iterator[tuple[bytes, bool]]:
    """Windows of the stream that ``data`` begins with, through all streams in streams; whether each is one of several.

    A stream that holds itself, directly or through others, is left where it repeats.
    """
    held, seen = None, set()
    while True:
        windows = _windows(data, most, raw)
        first = next(windows, None)
        if first is None:
            if held is not None:
                yield held, False
            return
        second = next(windows, None)
        mark = hashlib.sha256(first).digest()
        if second is not None or _opened(first) is None or mark in seen:
            break
        seen.add(mark)
        held, data, raw = first, first, False
    yield first, second is not None
    if second is not None:
        yield second, True
        for window in windows:
            yield window, True


def _fills(data: memoryview, size: int = 1 << 14) -> bool:
    """Whether ``data`` is raw deflate from its first byte to its last."""
    stream = zlib.decompressobj(-15)
    try:
        for at in range(0, len(data), size):
            rest = data[at : at + size]
            while not stream.eof and len(rest):
                stream.decompress(rest, 1 << 18)
                rest = stream.unconsumed_tail
            if stream.eof:
                return not stream.unused_data and at + size >= len(data)
    except zlib.error:
        pass
    return False


def _forms(escape: str) -> re.Pattern:
    """How ``FIRST_BYTES`` look where bytes may be written by ``escape``: "%", or a backslash."""

    def one(byte: int) -> str:
        ways = [f"%(?i:{byte:02x})"] if escape == "%" else [rf"\\(?:x|u00)(?i:{byte:02x})", rf"\\{byte:03o}"]
        if escape != "%" and byte < 0o100:
            ways.append(rf"\\{byte:o}(?![0-7])")
        if escape != "%" and byte in NAMED.values():
            ways += [rf"\\{letter}" for letter, value in NAMED.items() if value == byte]
        if 0x21 <= byte < 0x7F:
            ways.append(re.escape(chr(byte)))
        return f"(?:{'|'.join(ways)})"

    return re.compile("|".join("".join(map(one, first)) for first in FIRST_BYTES))


_BY_PERCENT, _BY_BACKSLASH = _forms("%"), _forms("\\")
_URL_STRETCH = re.compile(r"""[^\x00-\x20"'<>&=?#\x7f-\U0010ffff]*""")
_BARE = re.compile(r"(?:\\[^\r\n]|[^\\\s\"'])*")
_QUOTED = {q: re.compile(rf"(?:\\[^\r\n]|[^\\\r\n{q}])*") for q in "\"'"}


def _backslashed(text: str) -> bytes:
    """The bytes that ``text`` writes; other characters beyond one byte end it."""
    out, at = [], 0
    for m in BACKSLASH.finditer(text):
        digits = m.group(1) or m.group(2)
        byte = int(digits, 16) if digits else int(m.group(3), 8) if m.group(3) else NAMED[m.group(4)] if m.group(4) else None
        out.append(text[at : m.start()].encode("latin-1", "replace"))
        out.append(m.group(5).encode("latin-1", "replace") if byte is None else bytes([byte]))
        at = m.end()
    return b"".join([*out, text[at:].encode("latin-1", "replace")])


def _escaped_layers(layer: Layer, most: int) -> Iterator[Layer | None]:
    """Layers of the streams that are written in escapes; before those of one that expands beyond ``most``, None.

    In a URL a stream ends with its part of the URL; behind a quote it ends with the next one, elsewhere with the word.
    """
    text = layer.text
    for mark, pattern in (("%", _BY_PERCENT), ("\\", _BY_BACKSLASH)):
        if mark not in text:
            continue
        behind = 0
        for m in pattern.finditer(text):
            if m.start() < behind:
                continue
            if mark == "%":
                stretch = _URL_STRETCH.match(text, m.start())
                data = unquote_to_bytes(stretch.group().replace("+", " "))
            else:
                quote = text[m.start() - 1 : m.start()]
                stretch = _QUOTED.get(quote, _BARE).match(text, m.start())
                data = _backslashed(stretch.group())
            if mark not in stretch.group() or not _magic(data, 0):
                continue
            for number, (expanded, several) in enumerate(_unfolded(data, most)):
                behind = stretch.end()
                if several and not number:
                    yield None
                for inner, _, _ in _readings(expanded):
                    yield _packed(layer, inner, m.start(), behind)


def _packed(layer: Layer, text: str, begin: int, end: int) -> Layer:
    """What a stream holds: any of its characters may depend on the whole of ``begin`` to ``end``."""
    child = layer.child(text, np.full(len(text), begin, np.int32), np.full(len(text), end, np.int32))
    child.packed = True
    return child


def _base64_layers(layer: Layer, most: int) -> Iterator[Layer | None]:
    """Layers of the base64 stretches of ``layer``; before those of one that expands beyond ``most``, None.

    Other letters of the alphabet may stand before a stretch: each run is read from its first four
    places, one of which is in phase with it. A stream has to be met at its first byte.
    """
    for run, place, begins in _runs(layer.text):
        plain = run.replace("-", "+").replace("_", "/")
        separators = [*begins, *(m.end() for m in SEPARATOR.finditer(run))]
        for phase in range(4):
            size = len(run) - phase
            size -= size % 4 == 1
            if size < 2:
                continue
            data = binascii.a2b_base64(plain[phase : phase + size] + "=" * (-size % 4))

            def spans(first, behind, phase=phase):
                first, behind = phase + first * 8 // 6, phase - (-behind * 8 // 6)
                return (place + first, place + behind) if isinstance(place, int) else (place[first], place[behind - 1] + 1)

            streams = {(at - phase) // 4 * 3 for at in separators if at >= phase and (at - phase) % 4 == 0}
            streams |= {m.start() for m in MAGIC.finditer(data)}
            opened, last = False, b""
            for at in sorted(streams):
                if at < len(data) and _magic(data, at):
                    begin, end = spans(np.array([at]), np.array([len(data)]))
                    large = False
                    for number, (expanded, several) in enumerate(_unfolded(data[at:], most)):
                        opened |= at == 0
                        if not number and last.endswith(expanded) and not several:  # a later member of the same stream
                            break
                        if several and not large:
                            large = True
                            yield None
                        for text, _, _ in _readings(expanded):
                            yield _packed(layer, text, begin[0], end[0])
                        last = expanded
            for at in () if streams and opened else sorted((at - phase) // 4 * 3 for at in separators if at >= phase and (at - phase) % 4 == 0):
                if len(data) - at >= SHORTEST and _fills(memoryview(data)[at:]):
                    begin, end = spans(np.array([at]), np.array([len(data)]))
                    for number, (expanded, several) in enumerate(_unfolded(data[at:], most, raw=True)):
                        if several and not number:
                            yield None
                        for text, _, _ in _readings(expanded):
                            yield _packed(layer, text, begin[0], end[0])
            if opened or phase and not RUN.search(data) and not any(wide.search(data) for wide in WIDE.values()):
                continue
            for text, first, behind in _readings(data):
                yield layer.child(text, *spans(first, behind))


def _magic(data: bytes, at: int) -> bool:
    return bool(MAGIC.match(data, at)) or data[at : at + 1] == b"\x78" and len(data) > at + 2 and (data[at] << 8 | data[at + 1]) % 31 == 0


def unwrap(layer: Layer, most: int = MOST_CHARS) -> Iterator[Layer | None]:
    """The layers directly inside ``layer``; None for each stream that is too large to be one layer."""
    if "%" in layer.text and (new := _replaced(layer, URL_ESCAPE.finditer(layer.text), _url_run)):
        yield new
    if ("\\" in layer.text or "&#" in layer.text) and (new := _replaced(layer, UNICODE_ESCAPE.finditer(layer.text), _unicode_run)):
        yield new
    yield from _escaped_layers(layer, most)
    yield from _base64_layers(layer, most)


_DONE = object()


def find_secrets(text: str, most: int = MOST_CHARS) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int, int]:
    """(base spans, all spans, layers scanned, streams read in windows); a span is (start, kind's number, end)."""
    base = base_spans(text)
    spans, seen = set(base), {hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()}
    layers, folded, most = 1, 0, most + 8 * len(text)
    # Layers from streams are finished before the next one is expanded: one generator is open for each
    # stream inside a stream. The others take no more room than the layer that holds them.
    stack = [(None, deque([Layer(text)]))]
    while stack:
        inside, work = stack[-1]
        if inside is None:
            if not work:
                stack.pop()
                continue
            inside = unwrap(work.popleft(), most)
            stack[-1] = (inside, work)
        new = next(inside, _DONE)
        if new is _DONE:
            stack[-1] = (None, work)
            continue
        if new is None:
            folded += 1
            continue
        mark = hashlib.sha256(new.text.encode("utf-8", "surrogatepass") + b"|" + str(new.original(0, len(new.text)) if new.text else 0).encode()).digest()
        if mark in seen:
            continue
        seen.add(mark)
        layers += 1
        for begin, kind, end in base_spans(new.text):
            first, behind = new.original(begin, end)
            spans.add((first, kind, behind))
        if new.packed:
            stack.append((None, deque([new])))
        else:
            work.append(new)
    return base, sorted(spans), layers, folded


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{b}:{e}" for b, k, e in spans)


def scan(df: DataFrame, id_col: str = "doc_id", text: str = "text", most: int = MOST_CHARS) -> DataFrame:
    """One row per document: its open secrets, and all spans including those under encodings.

    Columns: doc_id, n_assign, n_access, n_hex (open secrets), base_sha256 and spans (kind:start:end
    in code points, by start and kind, comma-joined), n_layers, n_folded. NULL and empty texts have
    no spans; texts of any length are read whole; every row gives one row, whatever its id; no rows give none. Nothing is shuffled.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(7)]
        for value in texts_of(batch.column(1)):
            base, spans, layers, folded = find_secrets(value.as_py(), most)
            kinds = [k for _, k, _ in base]
            row = (*map(kinds.count, range(3)), hashlib.sha256(_written(base).encode()).hexdigest(), _written(spans), layers, folded)
            for column, value in zip(columns, row):
                column.append(value)
        kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()] * 2
        names = "doc_id n_assign n_access n_hex base_sha256 spans n_layers n_folded".split()
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=names)

    key = dict(df.dtypes)[id_col]
    schema = f"doc_id {key}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long, n_folded long"
    return per_batch(df.select(id_col, text), work, schema)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))


QUERIES = {"op1_secret_scan": op1_secret_scan}
ORACLE_SQL: dict[str, str] = {}
