"""Secrets in texts, also under layers of encoding."""

from __future__ import annotations

import base64
import bisect
import contextlib
import functools
import hashlib
import html
import itertools
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import unquote_to_bytes

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import ship_package

KINDS = ("assign", "access", "hex")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")

# Bytes of a layer that are decoded and scanned at a time.
CHUNK = 4 * 1024 * 1024

# So many levels of escapes of escapes are layers of their own; what is left is unwrapped in one pass.
ESCAPE_LEVELS = 4

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of the plain patterns, leftmost and without overlap per kind."""
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return found + [("hex", *m.span()) for m in _HEX.finditer(text)]


@dataclass
class Layer:
    """A text, and where each of its characters comes from: the span (start, end) in the document.

    ``starts`` and ``ends`` are either lists with an entry per character, or one number each for
    all of them, as in what a base64 run unfolds to. ``level`` counts the escapes unwrapped one
    after another.
    """

    text: str
    starts: list[int] | int
    ends: list[int] | int
    level: int = 0

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if isinstance(self.starts, int):
            return self.starts, self.ends
        return self.starts[start], self.ends[end - 1]


def _replaced(layer: Layer, pattern: re.Pattern, decode: Callable[[str], str | None]) -> Layer | None:
    """The layer with all matches decoded in place, or nothing if none could be."""
    parts, starts, ends, at, changed = [], [], [], 0, False
    whole = isinstance(layer.starts, int)

    def keep(a: int, b: int) -> None:
        parts.append(layer.text[a:b])
        if not whole:
            starts.extend(layer.starts[a:b])
            ends.extend(layer.ends[a:b])

    for m in pattern.finditer(layer.text):
        new = decode(m[0])
        if new is None:
            continue
        keep(at, m.start())
        parts.append(new)
        if not whole:
            start, end = layer.origin(*m.span())
            starts.extend([start] * len(new))
            ends.extend([end] * len(new))
        at, changed = m.end(), True
    if not changed:
        return None
    keep(at, len(layer.text))
    text = "".join(parts)
    level = layer.level + 1
    return Layer(text, layer.starts, layer.ends, level) if whole else Layer(text, starts, ends, level)


_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};|&(?:quot|apos|amp|lt|gt);|U\+[0-9A-F]{4,6})+"
)
_UNICODE_ONE = re.compile(
    r"\\u\{([0-9A-Fa-f]+)\}|\\[uUx]([0-9A-Fa-f]+)|U\+([0-9A-F]+)|(&#[0-9xXA-Fa-f]+;|&[a-z]+;)"
)
_BACKSLASH = re.compile(r"""(?:\\["'\\/nrt])+""")
_BACKSLASHED = {"n": "\n", "r": "\r", "t": "\t"}
# What a text may end in, before a bar and the character that comes next; its last eleven
# characters are enough to see it.
_ENDS_IN_ESCAPE = re.compile(
    r"""(?:%[0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}"""
    r"""|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};|&(?:quot|apos|amp|lt|gt);|\\["'\\/nrt]"""
    r"""|U\+[0-9A-F]{6}|U\+[0-9A-F]{4,5}(?=\|(?:[^0-9A-F]|\Z)))(?=\|.?\Z)""",
    re.DOTALL,
)
_ESCAPE_END = frozenset("0123456789abcdefABCDEF;}\"'\\/nrt")
# A run of either alphabet, and runs on lines one after another, which may be one wrapped run.
_RUN = re.compile(r"[A-Za-z0-9+/_-]+")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:\r?\n[\x20\t]*[A-Za-z0-9+/_-]++)++={0,2}")
# Sixteen characters make twelve bytes, less than any secret of the patterns needs with its name.
_LEAST = 16
# How gzip data and zlib data of the usual window begin in base64.
_PACKED_BASE64 = re.compile("H4sI|e(?:A[E-H]|F[4-7]|J[w-z]|N[o-r])")


def _url(run: str) -> str:
    return unquote_to_bytes(run).decode("utf-8", "replace")


def _unicode(run: str) -> str | None:
    def one(m: re.Match) -> str:
        if m[4]:
            return html.unescape(m[4])
        code = int(m[1] or m[2] or m[3], 16)
        return chr(code) if code < 0x110000 else m[0]

    joined = _UNICODE_ONE.sub(one, run)
    # Two escapes may be the halves of one character.
    new = joined.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return new if new != run else None


def _backslashes(run: str) -> str:
    return "".join(_BACKSLASHED.get(c, c) for c in run[1::2])


_ESCAPES = ((_URL, _url), (_UNICODE, _unicode), (_BACKSLASH, _backslashes))


def _one(escape: str) -> str:
    """The character of a single escape; bytes above 127 stay for themselves."""
    if escape[0] == "%":
        return chr(int(escape[1:], 16))
    if _BACKSLASH.fullmatch(escape):
        return _backslashes(escape)
    return _UNICODE_ONE.sub(lambda m: html.unescape(m[4]) if m[4] else _character(m), escape)


def _character(m: re.Match) -> str:
    code = int(m[1] or m[2] or m[3], 16)
    return chr(code) if code < 0x110000 else "\ufffd"


def _settled(layer: Layer) -> Layer | None:
    """The layer with escapes, and those they make with what stands around them, all decoded.

    One pass from left to right: whenever what was read so far ends in an escape, its character
    takes its place and may end another one. So the time grows with the length of the text,
    however deep escapes are nested.
    """
    text, whole = layer.text, isinstance(layer.starts, int)
    out: list[str] = []
    starts: list[int] = []
    ends: list[int] = []
    changed = False
    for i, c in enumerate(text):
        out.append(c)
        if not whole:
            starts.append(layer.starts[i])
            ends.append(layer.ends[i])
        after = text[i + 1 : i + 2]
        while out[-1] in _ESCAPE_END:
            m = _ENDS_IN_ESCAPE.search("".join(out[-11:]) + "|" + after)
            if m is None:
                break
            size = len(m[0])
            out[-size:] = [(_one(m[0]) or "\ufffd")[0]]
            if not whole:
                starts[-size:], ends[-size:] = [starts[-size]], [ends[-1]]
            changed = True
    if not changed:
        return None
    settled = "".join(out)
    return Layer(settled, layer.starts, layer.ends) if whole else Layer(settled, starts, ends)


Source = Callable[[], Iterator[bytes]]


def _packed(data: bytes) -> int | None:
    """Window bits for zlib if the data begins as gzip or zlib do."""
    if data[:2] == b"\x1f\x8b":
        return 31
    if len(data) > 2 and data[0] & 15 == 8 and (data[0] << 8 | data[1]) % 31 == 0:
        return 15
    return None


def _before_damage(reader, data: bytes) -> Iterator[bytes]:
    """What a reader makes of damaged data before the damage: by blocks, then by single bytes."""
    for step in (4096, 1):
        for i in range(0, len(data), step):
            before = reader.copy()
            try:
                out = reader.decompress(data[i : i + step])
            except zlib.error:
                reader, data = before, data[i : i + step]
                break
            if out:
                yield out
    with contextlib.suppress(zlib.error):
        while out := reader.decompress(data, 1):
            yield out
            data = reader.unconsumed_tail


def _members(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Content of gzip and zlib members one after another, in chunks, up to where it is damaged."""
    reader, rest = None, b""
    for chunk in chunks:
        rest += chunk
        while rest or reader:
            if reader is None:
                if len(rest) < 3:
                    break
                if (bits := _packed(rest)) is None:
                    return
                reader = zlib.decompressobj(bits)
            before = reader.copy()
            try:
                out = reader.decompress(rest, CHUNK)
            except zlib.error:
                yield from _before_damage(before, rest)
                return
            if out:
                yield out
            if reader.eof:
                rest, reader = reader.unused_data.lstrip(b"\0"), None  # zero bytes may fill up
            else:
                rest = reader.unconsumed_tail
                if not rest and len(out) < CHUNK:
                    break


def _unfolded(chunks: Iterator[bytes], limit: int | None, on_cut: Callable[[], None]) -> Iterator[bytes]:
    """The members, with a limit only so many bytes of them; ``on_cut`` is called if there are more."""
    left = limit
    for out in _members(chunks):
        if left is None:
            yield out
            continue
        if left < len(out):
            on_cut()
            if left:
                yield out[:left]
            return
        left -= len(out)
        yield out


def _levels(source: Source, limit: int | None, on_cut: Callable[[int], None]) -> Iterator[Source]:
    """The data, and what it unfolds to as long as that is gzip or zlib data again."""

    def inside(outer: Source, level: int) -> Source:
        return lambda: _unfolded(outer(), limit, lambda: on_cut(level))

    for level in itertools.count(1):
        yield source
        head = b""
        for chunk in source():
            head += chunk
            if len(head) > 2:
                break
        if _packed(head) is None or next(_unfolded(source(), limit, lambda: None), None) is None:
            return
        source = inside(source, level)


# The end of the last place that no match, encoded run or wrapped line goes across: a character
# that none of them has, also not as half of UTF-16; a blank after what ends no name, mark or escape
# of _ASSIGN; an empty line; three zero bytes.
_APART = re.compile(r"""(?s:.*)(?:[^A-Za-z0-9+/_.=\-"' :%\\{}&#;\r\n\t\x00]|[G-MO-SU-XZg-mo-su-xz]\x20|\n\n|\x00{3})""")


def _pieces(source: Source) -> Iterator[str]:
    """The data as Latin-1, in pieces of about a chunk between which no match or run is cut.

    What stays open at the end of a chunk goes into the next piece, however long it is.
    """
    parts: list[str] = []
    for chunk in source():
        if parts and (m := _APART.match(parts[-1])):
            last = parts.pop()
            yield "".join([*parts, last[: m.end()]])
            parts = [last[m.end() :]]
        text = chunk.decode("latin-1")
        # Any number of blanks is as good as one in the patterns.
        parts.append(re.sub("\x20{2,}", "\x20", text) if len(chunk) >= CHUNK else text)
    if parts:
        yield "".join(parts)


# ASCII characters in turn with zero bytes. The shortest secret of the patterns has twelve characters.
_WIDE = re.compile(r"(?:[\x01-\x7f]\x00){8}")


def _texts(text: str) -> Iterator[str]:
    """What bytes, given as Latin-1, may say: the patterns are ASCII, so Latin-1 loses nothing that
    UTF-8 or another such code has; UTF-16 is read in both byte orders from even and odd places."""
    yield text
    if _WIDE.search(text):
        data = text.encode("latin-1")
        for start in (0, 1):
            for code in ("utf-16-le", "utf-16-be"):
                yield data[start:].decode(code, "replace")


_STANDARD = str.maketrans("-_", "+/")


def _decoded(body: str, start: int) -> Source:
    """The base64 run from ``start`` on, decoded in blocks; a last character alone has no byte."""

    def blocks() -> Iterator[bytes]:
        end = len(body) - ((len(body) - start) % 4 == 1)
        at, size = start, 4096  # a short one first, which shows whether it is compressed data
        while at < end:
            block = body[at : min(at + size, end)].translate(_STANDARD)
            yield base64.b64decode(block + "=" * (-len(block) % 4))
            at, size = at + size, max(CHUNK // 4, 1) * 4

    return blocks


def _starts(body: str) -> list[tuple[int, bool]]:
    """Where in a run of base64 characters the encoded data may begin, and whether only if compressed.

    A run may have swallowed what stands before a '/', '_' or '-', or on a line before. Of the
    places with the same remainder by four, the first one gives all bytes of the others: the
    beginning of the run, the first place after such a mark, or else any. Compressed data needs
    its very beginning.
    """
    first = {0: 0}
    for m in re.finditer("[/_-]+", body):
        first.setdefault(m.end() % 4, m.end())
        if len(first) == 4:
            break
    for remainder in range(1, 4):
        first.setdefault(remainder, remainder)
    packed = (m.start() for m in _PACKED_BASE64.finditer(body))
    after = (m.end() for m in re.finditer("[/_-]", body))
    others = (at for at in (*packed, *after) if _packed(b"".join(_decoded(body[at : at + 4], 0)())))
    plain = set(first.values())
    return [(at, at not in plain) for at in sorted(plain.union(others)) if len(body) - at >= _LEAST]


def _candidates(text: str) -> Iterator[tuple[int, int, Source, bool]]:
    """Start, end and data of all that may be base64, runs and joined lines, and whether it counts
    only if it is compressed."""
    for m in _BASE64.finditer(text):
        body = m[0].rstrip("=")
        for at, packed in _starts(body):
            yield m.start() + at, m.end(), _decoded(body, at), packed
    for m in _WRAPPED.finditer(text):
        lines = [(r.start(), r.end()) for r in _RUN.finditer(text, *m.span())]
        body = "".join(text[a:b] for a, b in lines)
        ends = list(itertools.accumulate(b - a for a, b in lines))
        for at, packed in _starts(body):
            line = bisect.bisect_right(ends, at)
            yield lines[line][1] - (ends[line] - at), m.end(), _decoded(body, at), packed


def layers(text: str, limit: int | None = None, cuts: set | None = None) -> Iterator[tuple[Layer, bool]]:
    """All layers under a text and whether any was cut so far, without the text itself.

    Each layer is unwrapped in every way, and each new one likewise, until none is left; the inner
    ones come first, so that of each depth one piece of about ``CHUNK`` bytes is held. Escapes of
    escapes are layers of their own for ``ESCAPE_LEVELS`` levels; deeper ones are unwrapped in one
    pass, of which the last layer counts. A layer whose text and place were seen before is not taken again. Places that ``limit`` cut are
    added to ``cuts``.
    """
    cuts = set() if cuts is None else cuts
    seen, runs = set(), itertools.count()

    def is_new(layer: Layer) -> bool:
        place = (layer.starts, layer.ends) if isinstance(layer.starts, int) else None
        mark = (place, hashlib.sha256(layer.text.encode("utf-8", "surrogatepass")).digest())
        new = mark not in seen
        seen.add(mark)
        return new

    def under(layer: Layer) -> Iterator[Layer]:
        if layer.starts is None and ("%" in text or "\\" in text or "&" in text or "U+" in text):
            if any(pattern.search(text) for pattern, _ in _ESCAPES):
                layer = Layer(text, list(range(len(text))), list(range(1, len(text) + 1)))
        if layer.starts is not None:
            deep = layer.level >= ESCAPE_LEVELS
            ways = [_settled] if deep else [functools.partial(_replaced, pattern=p, decode=d) for p, d in _ESCAPES]
            for way in ways:
                if (found := way(layer)) and is_new(found):
                    yield found
        for start, end, data, packed in _candidates(layer.text):
            if layer.starts is not None:
                start, end = layer.origin(start, end)
            levels = _levels(data, limit, lambda level, run=next(runs): cuts.add((run, level)))
            for source in itertools.islice(levels, int(packed), None):
                any_new = False
                for piece in _pieces(source):
                    for found in (Layer(t, start, end) for t in _texts(piece)):
                        if is_new(found):
                            any_new = True
                            yield found
                if not any_new:  # as in data that unfolds to itself
                    break

    todo = [under(Layer(text, None, None))]
    while todo:
        layer = next(todo[-1], None)
        if layer is None:
            todo.pop()
            continue
        yield layer, bool(cuts)
        todo.append(under(layer))


def scan(text: str | None, limit: int | None = None) -> tuple[list[Span], list[Span], int]:
    """Plain spans, all spans with those of the layers, and the number of layers that were cut."""
    text = text or ""
    plain = base_spans(text)
    every, cuts = set(plain), set()
    for layer, _ in layers(text, limit, cuts):
        every.update((kind, *layer.origin(a, b)) for kind, a, b in base_spans(layer.text))
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    return sorted(plain, key=order), sorted(every, key=order), len(cuts)


def _found(text: Column, limit: int | None) -> Column:
    spans = "array<struct<kind:string,start:int,end:int>>"

    @F.pandas_udf(f"plain {spans}, every {spans}, n_cut int")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def rows(found: list[Span]) -> list[dict]:
            return [{"kind": k, "start": a, "end": b} for k, a, b in found]

        for texts in batches:
            results = [scan(t, limit) for t in texts]
            yield pd.DataFrame({
                "plain": [rows(r[0]) for r in results],
                "every": [rows(r[1]) for r in results],
                "n_cut": [r[2] for r in results],
            })

    return of(text)


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_unfolded: int | None = None
) -> DataFrame:
    """Secrets of each document as spans (kind, start, end) in code points.

    ``plain`` has the matches in the text itself; ``spans`` also those in its decoded layers, with
    the place of the outermost encoded run. Unwrapped are URL escapes, Unicode and numeric
    character escapes, the five entities of XML, backslashes as in JSON strings, base64 (both alphabets, also wrapped or after '/', '_' or '-'), gzip and
    zlib, in any nesting, until nothing new comes up. All members of a compressed layer are read as a stream to their end. Only with
    ``max_unfolded``, each is read up to so many bytes, and ``n_cut`` counts those that have more.

    A row per row. A null text is empty and has no spans.
    """
    ship_package(docs.sparkSession)
    found = docs.select(F.col(id_col).alias("doc_id"), _found(F.col(text_col), max_unfolded).alias("_f"))
    return found.select("doc_id", "_f.plain", F.col("_f.every").alias("spans"), "_f.n_cut")


def listed(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    one = lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))
    return F.array_join(F.transform(spans, one), ",")


