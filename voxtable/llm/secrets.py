r"""Secret scans with a recursive decoding worklist.

A text is layer 0. Every layer is scanned for secrets, then searched for encoded parts: lines with URL or Unicode
escapes, and base64 tokens, whose bytes may in turn be compressed, more than once. What they decode to goes on the worklist as a new
layer, until no layer gives a new one (fixpoint); a digest of every layer seen and its place breaks cycles. A finding in a decoded
layer is mapped back to the code points of the text that it came from: exactly through escapes, to the whole token through base64.

Escapes are `%41`, `%u0041`, `\x41`, `\u0041`, `\u{41}` and `\U00000041`. A line with some is decoded once a layer; after STEPS such layers it is decoded to its own fixpoint at once, in one pass over a
stack, so that chains of any form cost time in proportion to their length (no part of an escape can belong to another, so the fixpoint is the same in any order). Of the layers that this passes over only
the last is scanned; as findings of the kinds assign and access hold no character of an unfinished escape, later layers don't destroy them.

A base64 token is read whole. If that is neither text nor compressed, it is read from each of its first four characters on, and
its parts between `/`, `_` and `-`, between `_` and `-`, and between `+` and `/` are read whole. What it
decodes to may be UTF-8, hold UTF-16 (lines of READABLE characters of ASCII), be compressed by gzip, zlib, bzip2 or raw deflate, or hold gzip after up to LEAD other bytes.

Base kinds, leftmost and non-overlapping per kind, on layer 0: assign, access, hex (see the patterns). Decoded layers add findings; base ones stay.

Defined cases: null and empty texts have no findings; of decoded data that isn't all text, the stretches of READABLE characters and more are the layer, a line each (no pattern
matches less); a decompressed layer of any size is read whole, all members of it, in pieces that end with a line (a single line is held whole), up to the byte where the data breaks; base64 wrapped over lines is
tried joined, too; an escape of an escape of an escape of an escape is decoded at once; repeated rows are scanned each; an empty
table gives an empty result; extra columns are not read; the result's column takes a free name if a kept one is called findings.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("assign", "access", "hex")
#: Bytes inflated at a time, and characters from which an inflated layer is scanned in pieces; both bound memory, not what is read.
_CHUNK, PIECE = 1 << 20, 16 << 20
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
# a greedy run that is too short holds no longer one, so the lengths can stand in the patterns of these two
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_KEYWORDS = re.compile(r"passw|secret|token|api", re.I | re.A)
_ESCAPE = re.compile(r"%u?[0-9A-Fa-f]{2}|\\[ux][0-9A-Fa-f]{2}|\\u\{[0-9A-Fa-f]|\\U[0-9A-Fa-f]{8}")
#: An escape, or one whose own mark is escaped four times and more, and runs of these.
_URL = r"%(?:(?:25){4,}(?=[0-9A-Fa-f]{2}))?[0-9A-Fa-f]{2}"
_CODE = r"\\u005[cC](?:u005[cC]){3,}(?:u[0-9A-Fa-f]{4}|x[0-9A-Fa-f]{2})|[\\%]u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\u\{[0-9A-Fa-f]{1,8}\}|\\U[0-9A-Fa-f]{8}"
#: The digits of a single escape of these.
_DIGITS = re.compile(r"(?:[uxU]|u\{)([0-9A-Fa-f]+)\}?\Z")
#: Layers of escapes that are decoded one by one.
STEPS = 8
_URL_ONE, _URL_RUN = re.compile(_URL), re.compile(f"(?:{_URL})+")
_CODE_ONE, _CODE_RUN = re.compile(_CODE), re.compile(f"(?:{_CODE})+")
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_PART = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
_HEX_DIGITS = frozenset("0123456789abcdefABCDEF")
_URL_LAST = re.compile(r"%([0-9A-Fa-f]{2})\Z")
_CODE_LAST = re.compile(r"(?:[\\%]u(?=[0-9A-Fa-f]{4}\Z)|\\x(?=[0-9A-Fa-f]{2}\Z)|\\U(?=[0-9A-Fa-f]{8}\Z)|\\u(?=\{))([0-9A-Fa-f]+|\{[0-9A-Fa-f]{1,8}\})\Z")
#: Base64 characters up to a line's end, and the lines of them that follow.
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:\r?\n[\t\x20]*[A-Za-z0-9+/_-]++)+={0,2}")
#: A line after which no wrapped base64 goes on.
_ENDS = re.compile(r"^\s*$|\S[^A-Za-z0-9+/_-]+[A-Za-z0-9+/_-]{0,15}\r?$")
_URLSAFE = str.maketrans("-_", "+/")
_BETWEEN = tuple(re.compile(f"[^{x}]{{16,}}") for x in ("/_-", "_-", "+/"))
#: What parts of data that is no text.
_ODD = r"\x00-\x08\x0E-\x1F\x7F-\x9F\uFFFD"
_UNPRINTABLE = re.compile(f"[{_ODD}]+")
#: Characters that the shortest finding has, in any layer.
READABLE = 16
_STRETCH = re.compile(f"[^{_ODD}\n]{{{READABLE},}}")
_WIDE = re.compile(rb"(?:[\t\x20-\x7E]\x00){%d,}|(?:\x00[\t\x20-\x7E]){%d,}" % (READABLE, READABLE))
_ASCII = re.compile(rb"[\t\x20-\x7E]{%d}" % READABLE)
#: Bytes before gzip data that are skipped.
LEAD = 64

#: Where each character came from: first and end places.
Spans = tuple[np.ndarray, np.ndarray]


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base kinds in one layer, code points, end exclusive."""
    out = []
    if _KEYWORDS.search(text):
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return out


def _packer(data: bytes):
    """A decompressor for gzip, zlib or bzip2 data; None for other data."""
    if data[:2] == b"\x1f\x8b" or data[0] & 0x8F == 8 and (data[0] << 8 | data[1]) % 31 == 0:
        return zlib.decompressobj(47)
    return bz2.BZ2Decompressor() if data[:3] == b"BZh" else None


def _inflated(chunks: Iterator[bytes], broken: list[bool]) -> Iterator[bytes]:
    """The content of all members of compressed data, a chunk at a time, up to where it breaks (then broken gets an entry); nothing for other data. What follows the last whole member is left out."""
    packed, rest = None, b""
    for chunk in chunks:
        rest += chunk
        try:
            while rest:
                if packed is None:
                    if len(rest) < 3:
                        break
                    if (packed := _packer(rest)) is None:
                        return
                if out := packed.decompress(rest, _CHUNK):
                    yield out
                while not packed.eof and (len(out) == _CHUNK or getattr(packed, "unconsumed_tail", b"")):
                    if not (out := packed.decompress(getattr(packed, "unconsumed_tail", b""), _CHUNK)):
                        break
                    yield out
                rest = b""
                if packed.eof:
                    packed, rest = None, packed.unused_data
        except (zlib.error, OSError, ValueError, EOFError):
            broken.append(True)
            return


def _deflated(data: bytes) -> Iterator[bytes]:
    """The content of raw deflate data, a chunk at a time; an error or an end without eof tells other data."""
    packed = zlib.decompressobj(-15)
    while data and not packed.eof:
        if not (out := packed.decompress(data, _CHUNK)):
            break
        yield out
        data = packed.unconsumed_tail
    if not packed.eof:
        raise zlib.error("no deflate data")


def _is_deflated(data: bytes) -> bool:
    try:
        return sum(map(len, _deflated(data))) >= READABLE
    except zlib.error:
        return False


def _opened(data: bytes, depth: int, broken: list[bool], raw: bool) -> Iterator[bytes]:
    chunks = _deflated(data) if raw else iter((data,))
    for _ in range(depth):
        chunks = _inflated(chunks, broken)
    return chunks


def _wide(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Lines of UTF-16 in data, in either byte order, as ASCII. A line of them is held whole."""
    held = b""
    for chunk in chunks:
        if b"\0" not in chunk and b"\0" not in held:
            held = chunk[-2:]
            continue
        held, done = held + chunk, 0
        for m in _WIDE.finditer(held):
            if m.end() > len(held) - 2:
                break
            yield m[0].replace(b"\0", b"") + b"\n"
            done = m.end()
        else:
            done = max(done, len(held) - 2 * READABLE)
        held = held[done:]
    for m in _WIDE.finditer(held):
        yield m[0].replace(b"\0", b"") + b"\n"


def _plain(data: bytes) -> bool:
    """Whether data is all text, or compressed by its head."""
    return not _UNPRINTABLE.search(data.decode("utf-8", "replace")) or next(_inflated(iter((data,)), []), None) is not None


def _texts_of(data: bytes, odd: bool = True, raw: bool = False) -> Iterator[str]:
    """What can be read in data (but for data as it is with odd bytes, if these aren't wanted), through any number of compressions, in pieces that end with a line; data met before ends the search.
    Compressed data is read once to see what it is, and again for its pieces. Data that only looks compressed is read as it is, too."""
    seen, depth, levels = {hashlib.sha256(data).digest()}, 0, []
    while True:
        digest, some, broken = hashlib.sha256(), False, []
        for chunk in _opened(data, depth + 1, broken, raw):
            digest.update(chunk)
            some = True
        if broken or not some:
            levels.append(depth)
        if not some:
            break
        if digest.digest() in seen:
            break
        seen.add(digest.digest())
        depth += 1
    for level in levels:
        if level or raw or len(data) >= READABLE and (odd or not _UNPRINTABLE.search(data.decode("utf-8", "replace"))):
            yield from _pieces(_opened(data, level, [], raw))
            yield from _pieces(_wide(_opened(data, level, [], raw)))


def _may_say(data: bytes) -> bool:
    """Whether data holds as many characters of ASCII in a row as the shortest finding, or is compressed by its head."""
    return bool(_ASCII.search(data) or _WIDE.search(data)) or len(data) > 2 and _packer(data) is not None


def _texts_in(data: bytes, plain: bool) -> Iterator[str]:
    """As _texts_of, and what is compressed without a head or behind a few other bytes."""
    if _may_say(data):
        yield from _texts_of(data)
    if plain:
        return
    if _is_deflated(data):
        yield from _texts_of(data, raw=True)
    at = data.find(b"\x1f\x8b\x08", 1, LEAD + 3)
    while at > 0:
        yield from _texts_of(data[at:], False)
        at = data.find(b"\x1f\x8b\x08", at + 1, LEAD + 3)


def _pieces(chunks: Iterator[bytes]) -> Iterator[str]:
    decoder, text, read, odd = codecs.getincrementaldecoder("utf-8")("replace"), "", 0, False
    for chunk in chunks:
        new = decoder.decode(chunk)
        if _UNPRINTABLE.search(new):
            new, odd = _UNPRINTABLE.sub("\n", new), True
        text += new
        if len(text) >= PIECE and (end := _cut(text, read)):
            yield "\n".join(_STRETCH.findall(text[:end])) if odd else text[:end]
            text = text[end:]
        read = len(text)
    odd = odd or bool(decoder.decode(b"", True))
    yield "\n".join(_STRETCH.findall(text)) if odd else text


def _cut(text: str, since: int) -> int:
    """The last place after since where a text can be cut without parting a line or wrapped base64; 0 if there is none."""
    at = len(text)
    while (at := text.rfind("\n", since, at)) >= 0:
        if _ENDS.search(text[text.rfind("\n", 0, at) + 1 : at]):
            return at + 1
    return 0


def _units(point: int) -> bytes:
    return point.to_bytes(2, "big") if point < 1 << 16 else (chr(point) if point < 0x110000 else "\ufffd").encode("utf-16-be")


def _told(run: re.Match, one: re.Pattern) -> tuple[str, np.ndarray, np.ndarray]:
    """What a run of escapes says, and the first and end place of each character in it."""
    parts = list(one.finditer(run.string, run.start(), run.end()))
    width = 1 if one is _URL_ONE else 2
    units = [_units(int(_DIGITS.search(m[0])[1], 16)) for m in parts] if width == 2 else [bytes((int(m[0][-2:], 16),)) for m in parts]
    raw = b"".join(units)
    parts = [m for m, u in zip(parts, units, strict=True) for _ in range(len(u) // width)]
    text = raw.decode("utf-16-be" if width == 2 else "utf-8", "replace")
    if "\ufffd" in text:  # not one for one: in proportion
        edges = np.arange(len(text) + 1) * len(parts) // len(text)
    else:
        edges = np.cumsum([0, *(len(c.encode("utf-16-be" if width == 2 else "utf-8")) // width for c in text)])
    first, end = np.array([m.start() for m in parts]), np.array([m.end() for m in parts])
    return text, first[edges[:-1]], end[np.maximum(edges[1:], edges[:-1] + 1) - 1]


def _unescaped(line: str) -> tuple[str, Spans]:
    """A line with its escapes decoded once, and where each of its characters came from."""
    run, one = (_URL_RUN, _URL_ONE) if _URL_RUN.search(line) else (_CODE_RUN, _CODE_ONE)
    text, first, ends, at = [], [], [], 0
    for m in run.finditer(line):
        plain = np.arange(at, m.start())
        new, a, b = _told(m, one)
        text += [line[at : m.start()], new]
        first += [plain, a]
        ends += [plain + 1, b]
        at = m.end()
    plain = np.arange(at, len(line))
    return "".join((*text, line[at:])), (np.concatenate([*first, plain]), np.concatenate([*ends, plain + 1]))


def _reduced(top: list) -> tuple[int, str | int] | None:
    """The length of the escape that ends a stack, and what it says (a number: a byte over 127)."""
    c = top[-1]
    if type(c) is int or c not in _HEX_DIGITS and c != "}":
        return None
    tail = "".join(x if type(x) is str else "\x00" for x in top[-12:])
    if m := _URL_LAST.search(tail):
        value = int(m[1], 16)
        return 3, value if value > 127 else chr(value)
    if m := _CODE_LAST.search(tail):
        value = int(m[1].strip("{}"), 16)
        return len(m[0]), chr(value) if value < 0x110000 else "\ufffd"
    return None


def _settled(line: str) -> tuple[str, Spans]:
    """A line with its escapes decoded until none is left, and where each of its characters came from."""
    stack: list[str | int] = []
    first: list[int] = []
    ends: list[int] = []
    for i, c in enumerate(line):
        stack.append(c)
        first.append(i)
        ends.append(i + 1)
        while (got := _reduced(stack)) is not None:
            size, said = got
            start = first[-size]
            del stack[-size:], first[-size:], ends[-size:]
            stack.append(said)
            first.append(start)
            ends.append(i + 1)
    # bytes and surrogates join to characters
    text, a, b, k = [], [], [], 0
    while k < len(stack):
        n = k + 1
        if type(stack[k]) is int:
            while n < len(stack) and type(stack[n]) is int:
                n += 1
            at = k
            for char in bytes(stack[k:n]).decode("utf-8", "replace"):
                # a byte that is no part of a character has a sign of its own, or shares one with the next
                size = min(len(char.encode()) if char != "\ufffd" else 1, n - at)
                at, begin = min(at + size, n), min(at, n - 1)
                text.append(char)
                a.append(first[begin])
                b.append(ends[max(at - 1, begin)])
        else:
            char = stack[k]
            if "\ud800" <= char < "\udc00" and n < len(stack) and type(stack[n]) is str and "\udc00" <= stack[n] < "\ue000":
                char = (char + stack[n]).encode("utf-16", "surrogatepass").decode("utf-16")
                n += 1
            text.append("\ufffd" if "\ud800" <= char < "\ue000" else char)
            a.append(first[k])
            b.append(ends[n - 1])
        k = n
    return "".join(text), (np.array(a, np.int64), np.array(b, np.int64))


def _data(token: str) -> bytes | None:
    return _bytes(token.rstrip("=").translate(_URLSAFE))


def _bytes(body: str) -> bytes | None:
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4))
    except (binascii.Error, ValueError):
        return None


def _runs(text: str) -> Iterator[list[tuple[int, int]]]:
    """Base64 that is wrapped: the places of lines of one width, with a first of any width before and a shorter one after them."""
    for m in _WRAPPED.finditer(text):
        run: list[tuple[int, int]] = []
        for x in _PART.finditer(text, m.start(), m.end()):
            size, last = x.end() - x.start(), run[-1][1] - run[-1][0] if run else 0
            if len(run) > 1 and size > last:
                yield run
                run = []
            run.append(x.span())
            if len(run) > 2 and size < last:
                yield run
                run = []
        if len(run) > 1:
            yield run


def _of_token(token: str) -> Iterator[tuple[str, int, int]]:
    """What base64 says that may stand among other characters of its alphabet: (layer, start, end) in the token."""
    body, read = token.rstrip("=").translate(_URLSAFE), set()
    for start, end in ((0, len(token)), *((m.start(), m.end()) for p in _BETWEEN for m in p.finditer(token))):
        if (start, end) in read:
            continue
        read.add((start, end))
        data = _bytes(body[start:end])
        plain = data is not None and _plain(data)
        for layer in _texts_in(data, plain) if data is not None else ():
            yield layer, start, end
        if start or end < len(token):
            continue
        if plain:
            return
        for k in range(4):  # readable data at any place has one of these alignments
            rest = body[k:-1] if (len(body) - k) % 4 == 1 else body[k:]
            if (k or len(rest) < len(body)) and (data := _bytes(rest)) and _may_say(data):
                for layer in _texts_of(data):
                    yield layer, start, end


def decoded(text: str, settle: bool = False) -> Iterator[tuple[str, int, Spans | None, int]]:
    """Layers one step below a text: (layer, start, character spans relative to start or None for the whole part, end). settle: escapes are decoded until none is left."""
    last = -1
    for m in _ESCAPE.finditer(text) if "%" in text or "\\" in text else ():
        if m.start() < last:
            continue
        start = text.rfind("\n", 0, m.start()) + 1
        last = end if (end := text.find("\n", m.start())) >= 0 else len(text)
        layer, spans = (_settled if settle else _unescaped)(text[start:last])
        yield layer, start, spans, last
    for m in _TOKEN.finditer(text):
        for layer, a, b in _of_token(m[0]):
            if layer:
                yield layer, m.start() + a, None, m.start() + b
    for run in _runs(text):
        # the first and the last line may be words that are no part of it
        for lines, odd in ((run, False), (run[1:], False), (run[:-1], False), (run[1:-1], False), (run if len(run) > 2 else (), True)):
            data = _data("".join(text[a:b] for a, b in lines)) if len(lines) > 1 else None
            some = False
            for layer in _texts_of(data, odd) if data else ():
                if layer:
                    some = True
                    yield layer, lines[0][0], None, lines[-1][1]
            if some:
                break


def find_secrets(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, depth) in the code points of the text, by start, then kind; depth 0 is the base, others came out of so many decodings."""
    found: dict[tuple[str, int, int], int] = {x: 0 for x in scan(text)}
    seen = {hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()}
    # layers being read, outermost first: only these are held, however much a part decodes to. A layer came from the characters of the text, or as a whole from a stretch of it
    work: list[tuple[Iterator, Spans | tuple[int, int] | None, int, int]] = [(decoded(text), None, 0, 0)]
    while work:
        inners, origin, depth, steps = work[-1]
        if (step := next(inners, None)) is None:
            work.pop()
            continue
        inner, start, spans, end = step
        exact = origin is None or isinstance(origin[0], np.ndarray)
        whole = (start, end) if origin is None else (int(origin[0][start]), int(origin[1][end - 1])) if exact else origin
        digest = hashlib.sha256(inner.encode("utf-8", "surrogatepass")).digest() + b"%d:%d" % whole
        if not inner or digest in seen:
            continue
        seen.add(digest)
        if spans is None or not exact:
            where = whole
        else:
            where = (spans[0] + start, spans[1] + start) if origin is None else (origin[0][spans[0] + start], origin[1][spans[1] + start - 1])
        mapped = isinstance(where[0], np.ndarray)
        for kind, a, b in scan(inner):
            place = (kind, int(where[0][a]), int(where[1][b - 1])) if mapped else (kind, *where)
            found[place] = min(found.get(place, depth + 1), depth + 1)
        steps = 0 if spans is None else steps + 1
        work.append((decoded(inner, steps >= STEPS), where, depth + 1, steps))
    return [(*k, d) for k, d in sorted(found.items(), key=lambda x: (x[0][1], KINDS.index(x[0][0]), x[0][2]))]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("depth", pa.int32())])


def secrets(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep columns and findings, array<struct<kind, start, end, depth>>, of every row."""
    columns = docs.select(F.col("text").alias("scanned_text"), *keep)
    name = "findings"
    while name in keep:
        name += "_"
    kind = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), *(T.StructField(c, T.IntegerType()) for c in ("start", "end", "depth"))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[dict(zip(("kind", "start", "end", "depth"), x, strict=True)) for x in find_secrets(t)] if t else [] for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(found, pa.list_(_SPAN))], [*keep, name])

    return columns.mapInArrow(run, T.StructType([*columns.schema.fields[1:], T.StructField(name, kind)]))


def joined(findings: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def base(findings: Column, kind: str | None = None) -> Column:
    return F.filter(findings, lambda x: (x["depth"] == 0) & (x["kind"] == kind if kind else F.lit(True)))
