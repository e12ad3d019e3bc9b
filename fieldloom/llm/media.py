"""Media columns by signature sniffing.

An Aho-Corasick automaton finds magic bytes anywhere in a blob in one pass; a validator for each format then confirms
structure and lengths, so chance hits fall away. What is confirmed at offset 0 is the blob's type, whatever was declared;
what is confirmed further in can be carved out. Containers are walked by their own lengths, so an item's end is known.
What one hit has walked or searched is kept for the blob's other hits, so repeated magic bytes take linear time.

``store`` keeps a payload losslessly as 8-bit mono samples in a RIFF/WAVE container, and ``read_back`` finds it by sniffing.
Defined results: null counts as empty; an empty blob has no type; broken containers have none either; repeated rows give
repeated rows; an empty table gives an empty result; other columns, whatever their names, are ignored by ``text_media``
and carried by ``columns``.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import fresh, in_small_batches, row_pieces

ALIGN = 64
RATE = 8000


class Item(NamedTuple):
    type: str
    start: int
    end: int
    detail: str


@lru_cache(maxsize=4)
def _places(blob: bytes, mark: bytes) -> list[int]:
    """Where a mark stands in a blob."""
    out, at = [], blob.find(mark)
    while at >= 0:
        out.append(at)
        at = blob.find(mark, at + 1)
    return out


@lru_cache(maxsize=4)
def _walks(blob: bytes, kind: str) -> dict[int, tuple[int, int] | None]:
    """Ends of the chains walked so far in a blob."""
    return {}


def _chain(b: memoryview, kind: str, pos: int, step: Callable[[int], int | None]) -> tuple[int, int] | None:
    """(end, links) of the chain from pos: step gives the next place, its own place at the end, None where it breaks."""
    known, path = _walks(b.obj, kind), []
    while pos not in known:
        after = step(pos)
        if after is None or after == pos:
            known[pos] = None if after is None else (pos, 0)
        else:
            path.append(pos)
            pos = after
    found = known[pos]
    for k, p in enumerate(reversed(path), 1):
        known[p] = found and (found[0], found[1] + k)
    return known[path[0]] if path else found


def _png(b: memoryview, at: int) -> tuple[int, str] | None:
    pos, shape = at + 8, ""
    while pos + 12 <= len(b):
        size, kind = struct.unpack_from(">I4s", b, pos)
        end = pos + 12 + size
        if end > len(b) or zlib.crc32(b[pos + 4 : end - 4]) != struct.unpack_from(">I", b, end - 4)[0]:
            return None
        if not shape:
            if kind != b"IHDR" or size != 13:
                return None
            shape = "%dx%d" % struct.unpack_from(">II", b, pos + 8)
        if kind == b"IEND":
            return end, shape
        pos = end
    return None


def _gif(b: memoryview, at: int) -> tuple[int, str] | None:
    if at + 13 > len(b):
        return None
    width, height, flags = struct.unpack_from("<HHB", b, at + 6)
    pos = at + 13 + (3 << (flags & 7) + 1 if flags & 128 else 0)

    def block(pos: int) -> int | None:
        return None if pos >= len(b) else pos if b[pos] == 0 else pos + 1 + b[pos]

    def part(pos: int) -> int | None:
        """The place after an extension or an image; its own place at the trailer."""
        if pos >= len(b) or b[pos] == 0x3B:
            return pos if pos < len(b) else None
        if b[pos] == 0x2C and pos + 10 < len(b):
            local = b[pos + 9]
            pos += 11 + (3 << (local & 7) + 1 if local & 128 else 0)
        elif b[pos] == 0x21:
            pos += 2
        else:
            return None
        data = _chain(b, "gif blocks", pos, block)
        return data and data[0] + 1

    parts = _chain(b, "gif parts", pos, part)
    return parts and (parts[0] + 1, f"{width}x{height}")


#: A marker within coded data that is no stuffing and no restart.
_MARKER = re.compile(rb"\xff[^\x00\xd0-\xd7]", re.S)


@lru_cache(maxsize=4)
def _shapes(blob: bytes) -> dict[int, tuple[int, str] | None]:
    """For places where a JPEG segment starts: the end of the picture, and the last shape told from there on."""
    return {}


def _jpeg(b: memoryview, at: int) -> tuple[int, str] | None:
    known, path, pos = _shapes(b.obj), [], at + 2
    while pos not in known:
        own = ""
        if pos + 1 < len(b) and b[pos] == 0xFF and b[pos + 1] == 0xD9:
            known[pos] = pos + 2, ""
            break
        if pos + 4 > len(b) or b[pos] != 0xFF or (size := struct.unpack_from(">H", b, pos + 2)[0]) < 2 or pos + 2 + size > len(b):
            known[pos] = None
            break
        mark, after = b[pos + 1], pos + 2 + size
        if mark in (0xC0, 0xC1, 0xC2) and size >= 8:
            own = "{1}x{0}".format(*struct.unpack_from(">HH", b, pos + 5))
        if mark == 0xDA:
            found = _MARKER.search(b, after)
            after = found.start() if found else len(b)
        path.append((pos, own))
        pos = after
    found = known[pos]
    for p, own in reversed(path):
        found = known[p] = found and (found[0], found[1] or own)
    return found if found and found[1] else None


#: Parts of a RIFF container that its detail names; the rest are counted.
NAMED_PARTS = 8


def _riff_head(b: memoryview, at: int) -> tuple[int, bytes] | None:
    """End and form that a RIFF head tells, if they can be."""
    if at + 12 > len(b):
        return None
    end, form = at + 8 + struct.unpack_from("<I", b, at + 4)[0], bytes(b[at + 8 : at + 12])
    return (end, form) if end <= len(b) and form in (b"WAVE", b"WEBP", b"AVI ") else None


@lru_cache(maxsize=4)
def _riff_parts(blob: bytes) -> tuple[dict[int, int], dict[int, int], dict[int, tuple[int, int]]]:
    """All chains of parts that the blob's RIFF heads begin, as one forest: next place, depth, and span of each place.

    Where a part ends depends on its own place alone, so chains that meet go on together and each place is walked once.
    """
    b, after = memoryview(blob), {}
    for at in _places(blob, b"RIFF"):
        pos = at + 12
        if _riff_head(b, at):
            while pos not in after and pos + 8 <= len(b):
                size = struct.unpack_from("<I", b, pos + 4)[0]
                after[pos] = pos + 8 + size + size % 2
                pos = after[pos]
    below: dict[int, list[int]] = {}
    for pos, then in after.items():
        below.setdefault(then, []).append(pos)
    depth, span, count = {}, {}, 0
    for root in [p for p in below if p not in after]:
        todo = [(root, 0, False)]
        while todo:
            pos, level, done = todo.pop()
            if done:
                span[pos] = span[pos][0], count
                continue
            count += 1
            depth[pos], span[pos] = level, (count, count)
            todo.append((pos, level, True))
            todo += [(p, level + 1, False) for p in below.get(pos, ())]
    return after, depth, span


def _riff(b: memoryview, at: int) -> tuple[int, str] | None:
    head = _riff_head(b, at)
    if head is None:
        return None
    (end, form), pos = head, at + 12
    after, depth, span = _riff_parts(b.obj)
    if pos == end or pos not in span or end not in span or not span[end][0] <= span[pos][0] <= span[end][1]:
        return None  # its parts don't end where it does
    parts, n = [], depth[pos] - depth[end]
    for _ in range(min(n, NAMED_PARTS)):
        parts.append(bytes(b[pos : pos + 4]).decode("latin-1").strip())
        pos = after[pos]
    return end, f"{form.decode().strip()}:{'+'.join(parts)}" + (f"+{n - NAMED_PARTS}" if n > NAMED_PARTS else "")


def _bmp(b: memoryview, at: int) -> tuple[int, str] | None:
    if at + 26 > len(b):
        return None
    size, zero, offset, header, width, height = struct.unpack_from("<IIIIii", b, at + 2)
    fits = zero == 0 and header in (12, 40, 52, 56, 108, 124) and 14 + header <= offset <= size <= len(b) - at
    return (at + size, f"{width}x{abs(height)}") if fits else None


def _gzip(b: memoryview, at: int) -> tuple[int, str] | None:
    if at + 18 > len(b) or b[at + 2] != 8 or b[at + 3] > 31:
        return None
    inflate, pos, made = zlib.decompressobj(31), at, 0
    try:
        while not inflate.eof and pos < len(b):  # in pieces, so that a bomb can't fill the memory
            piece = bytes(b[pos : pos + 65536])
            pos += len(piece)
            while piece:
                made += len(inflate.decompress(piece, 1 << 20))
                piece = inflate.unconsumed_tail
    except zlib.error:
        return None
    return (pos - len(inflate.unused_data), f"{made}") if inflate.eof else None


def _zip(b: memoryview, at: int) -> tuple[int, str] | None:
    def local(pos: int) -> int | None:
        if pos + 30 > len(b) or bytes(b[pos : pos + 4]) != b"PK\x03\x04":
            return pos
        flags, packed, name, extra = *struct.unpack_from("<H", b, pos + 6), *struct.unpack_from("<I", b, pos + 18), *struct.unpack_from("<HH", b, pos + 26)
        return None if flags & 8 else pos + 30 + name + extra + packed

    def central(pos: int) -> int:
        return pos + 46 + sum(struct.unpack_from("<HHH", b, pos + 28)) if pos + 46 <= len(b) and bytes(b[pos : pos + 4]) == b"PK\x01\x02" else pos

    files = _chain(b, "zip files", at, local)
    pos = _chain(b, "zip entries", files[0], central)[0] if files else len(b)
    if pos + 22 > len(b) or bytes(b[pos : pos + 4]) != b"PK\x05\x06" or struct.unpack_from("<H", b, pos + 10)[0] != files[1]:
        return None
    return pos + 22 + struct.unpack_from("<H", b, pos + 20)[0], f"{files[1]}"


def _pdf(b: memoryview, at: int) -> tuple[int, str] | None:
    if at + 9 > len(b) or not (chr(b[at + 5]).isdigit() and b[at + 6] == 46):
        return None
    ends, starts = _places(b.obj, b"%%EOF"), _places(b.obj, b"startxref")
    e, s = bisect_right(ends, at), bisect_right(starts, at)
    if e == len(ends) or s == len(starts) or starts[s] > ends[e] - 9:
        return None
    return ends[e] + 5, bytes(b[at + 5 : at + 8]).decode("latin-1")


#: Magic bytes, type and validator; fixed values of the formats.
SIGNATURES: dict[bytes, tuple[str, Callable]] = {
    b"\x89PNG\r\n\x1a\n": ("image/png", _png),
    b"GIF87a": ("image/gif", _gif),
    b"GIF89a": ("image/gif", _gif),
    b"\xff\xd8\xff": ("image/jpeg", _jpeg),
    b"RIFF": ("riff", _riff),
    b"BM": ("image/bmp", _bmp),
    b"\x1f\x8b\x08": ("application/gzip", _gzip),
    b"PK\x03\x04": ("application/zip", _zip),
    b"%PDF-": ("application/pdf", _pdf),
}
#: Types of RIFF forms.
RIFF_TYPES = {"WAVE": "audio/wav", "WEBP": "image/webp", "AVI": "video/x-msvideo"}


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for magic in SIGNATURES:
        found.add_word(magic.decode("latin-1"), magic)
    found.make_automaton()
    return found


def sniff(blob: bytes) -> list[Item]:
    """Confirmed items by start; an item inside another one is listed after it."""
    view, items = memoryview(blob), []
    for last, magic in _automaton().iter(blob.decode("latin-1")):
        start = last - len(magic) + 1
        kind, validator = SIGNATURES[magic]
        if found := validator(view, start):
            end, detail = found
            items.append(Item(RIFF_TYPES[detail.split(":")[0]] if kind == "riff" else kind, start, end, detail))
    return sorted(items, key=lambda x: (x.start, -x.end))


def describe(blob: bytes | None, declared: str | None) -> dict:
    """Corrected type, whether the declared one was wrong, and the items that can be carved."""
    items = sniff(blob or b"")
    whole = next((x for x in items if x.start == 0), None)
    return {"type": whole.type if whole else None, "corrected": bool(whole and whole.type != declared), "detail": whole.detail if whole else None,
            "embedded": [x for x in items if x.start > 0]}


def store(payload: bytes) -> bytes:
    """Payload as 8-bit mono samples in a RIFF/WAVE container; its length must be even."""
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", len(payload))
    return head + payload


def read_back(blob: bytes) -> bytes:
    """The samples of a stored payload, found by sniffing and by the container's own lengths."""
    whole = next((x for x in sniff(blob) if x.start == 0 and x.type == "audio/wav"), None)
    if whole is None:
        raise ValueError("no sound enough RIFF/WAVE container")
    return _samples(blob, whole)


def _samples(blob: bytes, whole: Item) -> bytes:
    pos = 12
    while pos < whole.end:
        kind, size = struct.unpack_from("<4sI", blob, pos)
        if kind == b"data":
            return blob[pos + 8 : pos + 8 + size]
        pos += 8 + size + size % 2
    raise ValueError("no samples")


def columns(blobs: DataFrame, content: str = "content", declared: str = "declared") -> DataFrame:
    """blobs with media_type, type_corrected, media_detail and embedded (type, start, end, bytes) added.

    An item that overlaps one carved before it has its place alone (bytes null), so what is carved is never more than the blob.
    """
    kind = "media_type string, type_corrected boolean, media_detail string, embedded array<struct<type:string,start:long,end:long,content:binary>>"

    @F.pandas_udf(f"struct<{kind.replace(' string', ':string').replace(' boolean', ':boolean').replace(' array', ':array')}>")
    def look(content_: pd.Series, declared_: pd.Series) -> pd.DataFrame:
        out = []
        for blob, said in zip(content_, declared_, strict=True):
            blob = bytes(blob) if blob is not None else b""
            x = describe(blob, said)
            carved, upto = [], 0
            for e in x["embedded"]:
                carved.append({"type": e.type, "start": e.start, "end": e.end, "content": blob[e.start : e.end] if e.start >= upto else None})
                upto = max(upto, e.end)
            out.append((x["type"], x["corrected"], x["detail"], carved))
        return pd.DataFrame(out, columns=["media_type", "type_corrected", "media_detail", "embedded"])

    found = look(F.col(content), F.col(declared))
    name = fresh(blobs.columns, "media")
    return in_small_batches(blobs).withColumn(name, found).select(*[F.col(f"`{c}`") for c in blobs.columns], f"{name}.*")


def feature_of(items: list[Item], declared: str, payload: bytes) -> str:
    """The found type, whether the declared one was wrong, items further in, and mean, sign changes and entropy of the samples."""
    level = np.frombuffer(payload, np.uint8)
    counts = np.bincount(level, minlength=256)
    share = counts[counts > 0] / len(level)
    crossings = int(((level[1:] < 128) != (level[:-1] < 128)).sum())
    told = f"type={items[0].type};corrected={int(items[0].type != declared)};embedded={len(items) - 1}"
    return f"{told};mean={level.mean():.4f};crossings={crossings};entropy={-(share * np.log2(share)).sum():.4f}"


def text_media(docs: DataFrame) -> DataFrame:
    """Store each text's bytes as media, read them back and describe them; one row per row of docs."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in row_pieces(frames):
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"].fillna(""), strict=True):
                raw = text.encode()
                media = store(raw.ljust(max(ALIGN, -(-len(raw) // ALIGN) * ALIGN), b"\0"))
                items = sniff(media)
                payload = _samples(media, next(x for x in items if x.start == 0 and x.type == "audio/wav"))
                declared = "audio/wav" if len(raw) % 2 else "application/octet-stream"
                feature = feature_of(items, declared, payload)
                rows.append((doc_id, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature))
            out = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    kinds = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return in_small_batches(docs).select("doc_id", "text").mapInPandas(run, kinds)
