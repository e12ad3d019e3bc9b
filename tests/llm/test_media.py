import gzip
import hashlib
import io
import random
import struct
import time
import zipfile
import zlib

import pytest

from fieldloom.llm import media


def png(width=2, height=3):
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0" * 9)) + chunk(b"IEND", b"")


def gif():
    return b"GIF89a" + struct.pack("<HHBBB", 1, 1, 0x80, 0, 0) + b"\0\0\0\xff\xff\xff" + b"\x2c" + struct.pack("<HHHHB", 0, 0, 1, 1, 0) + b"\x02\x02\x44\x01\x00" + b"\x3b"


def jpeg():
    frame = b"\xff\xc0" + struct.pack(">HBHHB", 11, 8, 5, 7, 1) + b"\x01\x11\x00"
    return b"\xff\xd8\xff\xe0" + struct.pack(">H", 4) + b"ab" + frame + b"\xff\xda" + struct.pack(">H", 8) + b"\x01\x01\x00\x00\x3f\x00" + b"\x12\xff\x00\x34" + b"\xff\xd9"


def bmp():
    return b"BM" + struct.pack("<IIIIii", 58, 0, 54, 40, 1, 1) + b"\0" * 32


def zipped():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a.txt", "hello")
    return out.getvalue()


PDF = b"%PDF-1.4\nstuff\nstartxref\n9\n%%EOF"
ITEMS = {"image/png": png(), "image/gif": gif(), "image/jpeg": jpeg(), "image/bmp": bmp(), "application/gzip": gzip.compress(b"x" * 500), "application/zip": zipped(), "application/pdf": PDF, "audio/wav": media.store(b"\1\2" * 40)}


def test_types_and_lengths():
    for kind, blob in ITEMS.items():
        found = media.sniff(blob + b"tail")
        assert (found[0].type, found[0].start, found[0].end) == (kind, 0, len(blob)), kind


def test_carving():
    blob = b"junk BM RIFF \xff\xd8\xff PK\x03\x04 " + b"..".join(ITEMS.values()) + b" junk"
    carved = {x.type: blob[x.start : x.end] for x in media.sniff(blob)}
    assert carved == ITEMS


def test_damage_is_seen():
    for kind, blob in ITEMS.items():
        if kind != "application/pdf":
            assert not any(x.start == 0 for x in media.sniff(blob[: len(blob) - 6])), kind
    spoilt = bytearray(png())
    spoilt[-20] ^= 1
    assert media.sniff(bytes(spoilt)) == []


def test_repeated_magic_bytes_take_linear_time():
    import time

    tiny = b"PK\x03\x04" + b"\0" * 26
    blobs = [b"%PDF-1." * 1_400_000, b"GIF89a" + b"\0" * 7 + b"!\x01\x04abcd" * 300_000, (b"GIF89a" + b"\0" * 7 + b"!\x01\x02ab") * 100_000, tiny * 100_000, b"RIFF\x10\0\0\0WAVE" * 200_000]
    for blob in blobs:
        start = time.time()
        assert media.sniff(blob) == [] and time.time() - start < 15, blob[:20]


def plain_feature(raw, kind, embedded):
    """The described feature by plain Python."""
    from math import log2

    declared = "audio/wav" if len(raw) % 2 else "application/octet-stream"
    payload = raw + b"\0" * (64 - len(raw) if not raw else -len(raw) % 64)
    crossings = sum((a < 128) != (b < 128) for a, b in zip(payload, payload[1:], strict=False))
    entropy = -sum(n / len(payload) * log2(n / len(payload)) for n in (payload.count(v) for v in set(payload)))
    return {"type": kind, "corrected": str(int(declared != kind)), "embedded": str(embedded)}, (sum(payload) / len(payload), crossings, entropy)


def test_features(spark):
    rows = [(0, "", 0), (1, "abc é", 0), (2, "x" * 777, 0), (3, "lead " + PDF.decode() + " tail", 1), (4, PDF.decode() * 2, 2)]
    for r in media.text_media(spark.createDataFrame(rows, "doc_id long, text string, n int")).collect():
        told, (mean, crossings, entropy) = plain_feature(rows[r.doc_id][1].encode(), "audio/wav", rows[r.doc_id][2])
        found = dict(x.split("=") for x in r.feature.split(";"))
        assert {k: found[k] for k in told} == told and int(found["crossings"]) == crossings
        assert abs(float(found["mean"]) - mean) < 1e-3 and abs(float(found["entropy"]) - entropy) < 1e-3


def test_declared_types_are_corrected(spark):
    rows = [(1, png(), "image/gif"), (2, png(), "image/png"), (3, b"text", "image/png"), (4, None, None), (5, b"..." + png(), None)]
    out = {r.k: r for r in media.columns(spark.createDataFrame(rows, "k int, content binary, declared string")).collect()}
    assert (out[1].media_type, out[1].type_corrected, out[1].media_detail) == ("image/png", True, "2x3")
    assert not out[2].type_corrected and out[3].media_type is None and out[4].embedded == []
    assert bytes(out[5].embedded[0].content) == png()


def test_round_trip(docs, odd, none):
    for df in (docs, odd):
        texts = {}
        for r in df.collect():
            texts.setdefault(r.doc_id, set()).add(r.text or "")
        rows = media.text_media(df).collect()
        assert len(rows) == df.count()
        for r in rows:
            wanted = set()
            for t in texts[r.doc_id]:
                raw = t.encode()
                payload = raw + b"\0" * (64 - len(raw) if not raw else -len(raw) % 64)
                blob = media.store(payload)
                assert media.read_back(blob) == payload
                wanted.add((len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(blob), hashlib.sha256(blob).hexdigest()))
            assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes, r.media_sha256) in wanted
    assert media.text_media(none).count() == 0


def plain_riff(blob, at):
    """The container's parts walked one by one."""
    if at + 12 > len(blob):
        return None
    end, form, pos, parts = at + 8 + struct.unpack_from("<I", blob, at + 4)[0], blob[at + 8 : at + 12], at + 12, 0
    if end > len(blob) or form not in (b"WAVE", b"WEBP", b"AVI "):
        return None
    while pos + 8 <= end:
        size = struct.unpack_from("<I", blob, pos + 4)[0]
        pos, parts = pos + 8 + size + size % 2, parts + 1
    return (end, parts) if pos == end and parts else None


def test_riff_forest_against_walks():
    r = random.Random(4)
    for _ in range(300):
        blob = b"".join(r.choice([b"RIFF" + struct.pack("<I", r.choice([4, 12, 20, 28, 40, 60, 3])) + b"WAVE", b"data" + struct.pack("<I", r.choice([0, 1, 2, 4, 8, 16])), b"ab", b"\0\0\0\0"]) for _ in range(r.randint(1, 30)))
        for at in range(len(blob)):
            if blob.startswith(b"RIFF", at):
                found, want = media._riff(memoryview(blob), at), plain_riff(blob, at)
                assert (found and found[0]) == (want and want[0])


@pytest.mark.parametrize("kind", ["riff", "jpeg", "riff text"])
def test_nested_heads_take_linear_time(kind):
    n = 40_000
    if kind == "riff":  # each head's parts go on to the one end of all
        end = 24 * n
        blob = b"".join(b"RIFF" + struct.pack("<I", end - 24 * k - 8) + b"WAVE" + b"data" + struct.pack("<I", 4) + b"abcd" for k in range(n))
    elif kind == "riff text":  # lengths that are characters of UTF-8
        blob = b"".join(b"RIFF" + struct.pack("<I", 0x00010101 + k % 100) + b"WAVEdata\x04\0\0\0" for k in range(n))
        blob = media.store(blob.ljust(-(-len(blob) // 64) * 64, b"\0"))
    else:
        blob = b"\xff\xd8\xff\xc0\x00\x08\x08\x00\x01\x00\x01\x00\xff\xda\x00\x02" * n + b"\xff\xd9"
    began = time.process_time()
    items = media.sniff(blob)
    assert time.process_time() - began < 4 and sum(len(x.detail) for x in items) < 100 * max(1, len(items))
    assert kind != "riff" or len(items) == n


def test_carved_bytes_are_no_more_than_the_blob(spark):
    inner = media.store(b"x" * 64)
    outer = media.store((inner + b"y" * 64)[:172])
    blob = b"??" + outer + inner
    row = media.columns(spark.createDataFrame([(blob, "t")], "content binary, declared string")).first()
    assert [(e.start, e.content is not None) for e in row.embedded] == [(2, True), (46, False), (2 + len(outer), True)]
    assert sum(len(e.content or b"") for e in row.embedded) <= len(blob)
