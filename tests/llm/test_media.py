import gzip
import hashlib
import io
import struct
import time
import wave
import zipfile
import zlib

from pyspark.sql import functions as F

from loomsift.llm import media


def png():
    chunk = lambda kind, d: struct.pack(">I", len(d)) + kind + d + struct.pack(">I", zlib.crc32(kind + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0\7")) + chunk(b"IEND", b"")


def zipped():
    with zipfile.ZipFile(out := io.BytesIO(), "w") as z:
        z.writestr("a.txt", "hello " * 20)
    return out.getvalue()


SAMPLES = {
    "image/png": png(),
    "image/jpeg": b"\xff\xd8\xff\xe0\x00\x10JFIF\0\1\1\0\0\1\0\1\0\0\xff\xda\x00\x08\1\1\0\0\x3f\0\x12\xff\x00\x34\xff\xd9",
    "image/gif": b"GIF89a\1\0\1\0\x80\0\0\0\0\0\xff\xff\xff,\0\0\0\0\1\0\1\0\0\2\2D\1\0;",
    "image/bmp": b"BM" + struct.pack("<IIIIiiHHIIiiII", 58, 0, 54, 40, 1, 1, 1, 24, 0, 4, 0, 0, 0, 0) + b"\1\2\3\0",
    "audio/wav": media.wav(b"abc "),
    "application/pdf": b"%PDF-1.4\n1 0 obj\nendobj\nstartxref\n9\n%%EOF",
    "application/zip": zipped(),
    "application/gzip": gzip.compress(b"some text " * 50),
    "application/ogg": b"OggS\0\2" + b"\0" * 20 + b"\1\5hello",
    "audio/flac": b"fLaC\x80\0\0\x22" + b"\0" * 34 + b"\xff\xf8rest",
    "video/mp4": struct.pack(">I4s4sI", 16, b"ftyp", b"isom", 0) + struct.pack(">I4s", 8, b"moov"),
}


def test_formats_and_cut_off_ones():
    for kind, data in SAMPLES.items():
        assert media.sniff(data) == (kind, len(data), []), kind
        if kind != "audio/flac":
            assert media.sniff(data[:-1])[0] == media.UNKNOWN, kind
    broken = bytearray(png())
    broken[20] ^= 1
    assert media.sniff(bytes(broken))[0] == media.UNKNOWN


def test_carving():
    for kind, data in SAMPLES.items():
        if kind == "audio/flac":
            continue
        inside = b"text BM GIF89a RIFF PK\x03\x04 " + data + b" and %PDF- more " + data + b"."
        found = media.sniff(inside)[2]
        assert [(t, n) for t, _, n in found] == [(kind, len(data))] * 2, kind
        assert all(inside[a : a + n] == data for _, a, n in found)
    held = media.wav(b"\0" * 8 + png())
    assert media.sniff(held) == ("audio/wav", len(held), [("image/png", 52, len(png()))])


def test_declared_types_are_corrected(spark):
    rows = [(1, bytearray(png()), "image/jpeg"), (2, bytearray(png()), "image/png"), (3, None, "image/png"), (4, bytearray(b""), None), (5, bytearray(b"plain"), "text/plain")]
    values = spark.createDataFrame(rows, "id long, data binary, declared string").withColumn("length", F.lit("clash"))
    got = {r.id: (r.media_type, r.corrected, r.length) for r in media.sniffed(values).collect()}
    assert got == {1: ("image/png", True, len(png())), 2: ("image/png", False, len(png())), 3: (None, False, 0), 4: (media.UNKNOWN, True, 0), 5: (media.UNKNOWN, True, 0)}
    assert media.sniffed(values.limit(0)).count() == 0


def check(rows, texts):
    want = {}
    for i, t in texts:
        n = len((t or "").encode())
        payload = (t or "").encode() + b" " * (-n % 192 if n else 192)
        want[i] = (n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(payload) + 44)
    assert {r.doc_id: (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes) for r in rows} == want


def test_query_round_trip(spark, sf_dir):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = media.op10_media_columns(spark, sf_dir).collect()
    check(rows, texts)
    by_text = {}
    for r in rows:
        by_text.setdefault(r.payload_sha256, set()).add((r.media_sha256, r.feature))
    assert all(len(v) == 1 for v in by_text.values())


def test_edge_rows(spark):
    texts = [(1, None), (2, ""), (3, "é" * 96), (4, "a" * 193), (5, "x" * 1_000_000), (None, "n")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("media", F.lit("clash"))
    stored = media.store_text(docs)
    check(media.stored_features(stored).collect(), texts)
    data = stored.where("doc_id = 4").first().media
    with wave.open(io.BytesIO(bytes(data))) as file:
        assert (file.getnchannels(), file.getsampwidth(), file.getnframes()) == (1, 1, 384)
    assert media.stored_features(media.store_text(docs.limit(0))).count() == 0


def test_archives_of_many_entries_and_nested_ones():
    with zipfile.ZipFile(inner := io.BytesIO(), "w") as z:
        z.writestr("b.txt", "in")
    with zipfile.ZipFile(out := io.BytesIO(), "w") as z:
        for k in range(20_000):
            z.writestr(f"{k}.txt", "x")
        z.writestr("in.zip", inner.getvalue())
    data = out.getvalue()
    began = time.time()
    kind, size, embedded = media.sniff(data)
    assert (kind, size) == ("application/zip", len(data)) and [(t, n) for t, _, n in embedded] == [("application/zip", len(inner.getvalue()))]
    cut = b"PK\x03\x04" * 100_000
    assert media.sniff(cut) == (media.UNKNOWN, 0, [])
    assert time.time() - began < 5


def page(n, data=b"hello"):
    return b"OggS\0" + bytes([2 * (n == 0)]) + struct.pack("<QIII", n, 1, n, 0) + bytes([1, len(data)]) + data


def test_parts_of_a_medium_are_not_carved():
    ogg = b"".join(page(n) for n in range(3))
    members = gzip.compress(b"one " * 30) + gzip.compress(b"two " * 30) + gzip.compress(b"")
    for kind, data in (("application/ogg", ogg), ("application/gzip", members)):
        assert media.sniff(data) == (kind, len(data), [])
        assert media.sniff(b"text " + data + b" and more") == (media.UNKNOWN, 0, [(kind, 5, len(data))])
    # Another format inside is still carved, and a broken last part ends the medium.
    held = ogg + page(3, png())
    assert media.sniff(held) == ("application/ogg", len(held), [("image/png", len(ogg) + 28, len(png()))])
    assert media.sniff(ogg + page(3)[:-1]) == ("application/ogg", len(ogg), [])
    assert media.sniff(members + gzip.compress(b"x" * 99)[:-9])[:2] == ("application/gzip", len(members))


def test_chains_are_followed_once():
    """A million bytes of parts that never end well, each of which looks like a start."""
    box = struct.pack(">I4s8s", 16, b"ftyp", b"isom0000")
    flac = b"fLaC" + b"\0\0\0\x22" + b"fLaC\0\0\0\x22" * 4 + b"\0\0"
    gif = b"GIF89a\1\0\1\0\0\0\0\x21\xf9" + b"\x06GIF89a" * 8
    jpeg = b"\xff\xd8\xff\xe0\0\x04ab\xff\xda\0\x02xyz"
    for unit in (box, page(0)[:-5] + b"OggS\0", flac, gif, jpeg, b"\x1f\x8b\x08\0"):
        data = b"." + unit * (1_000_000 // len(unit))
        began = time.process_time()
        assert media.sniff(data)[0] == media.UNKNOWN
        assert time.process_time() - began < 8, unit
