"""Media columns: signature sniffing, validation, type correction and carving.

An Aho-Corasick automaton finds the magic bytes of all known formats in one pass over a value. At each place found a
validator of the format checks the structure from there (headers, chunk lengths, checksums, end marks) and gives the
length of the medium. A valid medium at the start decides the value's type, whatever was declared; valid media further
on are carved out as embedded ones. The pages of an Ogg and the members of a gzip file belong to it and are not carved.

Formats that are chains of parts (boxes, pages, blocks, segments) are followed by chain(): where a part ends does not
depend on the medium that it is read for, so a value's parts are read once, however many signatures point into them.

Texts can be stored as media without loss: store_text() writes their bytes as the 8-bit samples of a WAV file, padded
with spaces to a whole number of frames of FRAME bytes, and features are computed from the stored bytes read back.

Edge cases: null values have no type and no media; empty, cut-off and mislabelled values have the type their bytes prove
or `application/octet-stream`; a null text is stored like an empty one, one frame of spaces; texts up to the 4 GB of a
WAV are stored whole; equal values give equal results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.llm.common import small_batches, table

FRAME, RATE, UNKNOWN = 192, 16_000, "application/octet-stream"

# Magic bytes, how far into a medium they stand, and the format.
MAGIC = (
    (b"\x89PNG\r\n\x1a\n", 0, "png"),
    (b"\xff\xd8\xff", 0, "jpeg"),
    (b"GIF87a", 0, "gif"),
    (b"GIF89a", 0, "gif"),
    (b"BM", 0, "bmp"),
    (b"RIFF", 0, "riff"),
    (b"%PDF-", 0, "pdf"),
    (b"PK\x03\x04", 0, "zip"),
    (b"\x1f\x8b\x08", 0, "gzip"),
    (b"OggS", 0, "ogg"),
    (b"fLaC", 0, "flac"),
    (b"ftyp", 4, "mp4"),
)
TYPES = {
    "png": "image/png", "jpeg": "image/jpeg", "gif": "image/gif", "bmp": "image/bmp", "wav": "audio/wav", "webp": "image/webp", "avi": "video/x-msvideo",
    "pdf": "application/pdf", "zip": "application/zip", "gzip": "application/gzip", "ogg": "application/ogg", "flac": "audio/flac", "mp4": "video/mp4",
}


#: For a format and a place: where the chain of parts from there ends, and what was met on it.
Chains = dict[tuple[str, int], tuple[int, int]]


def chain(known: Chains, name: str, p: int, step: Callable[[int], tuple[int, int, bool]]) -> tuple[int, int]:
    """(end, facts) of the chain of parts at p. step(p) gives the next place, a part's facts (bits) and if more may follow."""
    path: list[tuple[int, int]] = []
    while (name, p) not in known:
        after, facts, more = step(p)
        path.append((p, facts))
        if not more:
            known[name, p] = (after, facts)
            break
        p = after
    end, met = known[name, p]
    for q, facts in reversed(path):
        met |= facts
        known[name, q] = (end, met)
    return end, met


def _png(d: bytes, at: int) -> int:
    p = at + 8
    first = True
    while p + 12 <= len(d):
        size, kind = int.from_bytes(d[p : p + 4], "big"), d[p + 4 : p + 8]
        if first and (kind != b"IHDR" or size != 13) or p + 12 + size > len(d):
            return 0
        if zlib.crc32(d[p + 4 : p + 8 + size]) != int.from_bytes(d[p + 8 + size : p + 12 + size], "big"):
            return 0
        p, first = p + 12 + size, False
        if kind == b"IEND":
            return p - at
    return 0


def _jpeg(d: bytes, at: int, known: Chains) -> int:
    def step(p: int) -> tuple[int, int, bool]:
        while d[p : p + 2] == b"\xff\xff":
            p += 1
        if p + 4 > len(d) or d[p] != 0xFF:
            return p, 0, False
        kind, size = d[p + 1], int.from_bytes(d[p + 2 : p + 4], "big")
        if kind < 0xC0 or 0xD0 <= kind <= 0xD9 or size < 2:
            return p, 0, False
        p += 2 + size
        while kind == 0xDA:  # picture data: to the next marker that is no stuffing or restart
            p = d.find(b"\xff", p)
            if p < 0 or p + 1 >= len(d):
                return len(d), 0, False
            if d[p + 1] == 0xD9:
                return p + 2, 1, False
            if d[p + 1] != 0 and not 0xD0 <= d[p + 1] <= 0xD7 and d[p + 1] != 0xFF:
                break
            p += 1 if d[p + 1] == 0xFF else 2
        return p, 0, True

    end, whole = chain(known, "jpeg", at + 2, step)
    return end - at if whole else 0


def _gif(d: bytes, at: int, known: Chains) -> int:
    if at + 13 > len(d):
        return 0
    table_size = lambda flags: 3 << (flags & 7) + 1 if flags & 0x80 else 0

    def data(p: int) -> tuple[int, int, bool]:
        if p >= len(d):
            return len(d) + 1, 0, False
        return p + 1 + d[p], 0, d[p] != 0

    def step(p: int) -> tuple[int, int, bool]:  # facts: 1 a picture, 2 the end mark
        if p < len(d) and d[p] == 0x3B:
            return p + 1, 2, False
        if p < len(d) and d[p] == 0x21:
            return chain(known, "gif data", p + 2, data)[0], 0, True
        if p + 10 <= len(d) and d[p] == 0x2C:
            return chain(known, "gif data", p + 11 + table_size(d[p + 9]), data)[0], 1, True
        return p, 0, False

    end, facts = chain(known, "gif", at + 13 + table_size(d[at + 10]), step)
    return end - at if facts == 3 else 0


def _bmp(d: bytes, at: int) -> int:
    if at + 26 > len(d):
        return 0
    size, reserved, offset, header = struct.unpack_from("<IIII", d, at + 2)
    if reserved or header not in (12, 40, 52, 56, 108, 124) or offset < 14 + header or offset > size or at + size > len(d):
        return 0
    if header == 12:
        width, height, planes, bits = struct.unpack_from("<HHHH", d, at + 18)
    else:
        if at + 34 > len(d):
            return 0
        width, height, planes, bits, packing = struct.unpack_from("<iiHHI", d, at + 18)
        if packing:
            return size if planes == 1 else 0
    if planes != 1 or bits not in (1, 4, 8, 16, 24, 32) or width <= 0:
        return 0
    return size if offset + (width * bits + 31) // 32 * 4 * abs(height) <= size else 0


def _riff(d: bytes, at: int) -> tuple[str, int]:
    if at + 12 > len(d):
        return "", 0
    size = 8 + int.from_bytes(d[at + 4 : at + 8], "little")
    name = {b"WAVE": "wav", b"WEBP": "webp", b"AVI ": "avi"}.get(d[at + 8 : at + 12], "")
    if not name or at + size > len(d) or size < 20:
        return "", 0
    p, kinds = at + 12, []
    while p + 8 <= at + size:
        kinds.append(d[p : p + 4])
        p += 8 + (n := int.from_bytes(d[p + 4 : p + 8], "little")) + n % 2
    if p not in (at + size, at + size + 1) or name == "wav" and not (b"fmt " in kinds and b"data" in kinds):
        return "", 0
    return name, size


def _pdf(d: bytes, at: int) -> int:
    if not d[at + 5 : at + 8].replace(b".", b"").isdigit():
        return 0
    stop = d.find(b"%PDF-", at + 5)
    end = d.rfind(b"%%EOF", at, stop if stop > 0 else len(d))
    return end + 5 - at if end > 0 and d.rfind(b"startxref", at, end) > 0 else 0


def _zips(d: bytes) -> dict[int, int]:
    """Start and length of each archive: every end record whose directory lies right before it names its archive's start."""
    found: dict[int, int] = {}
    end = d.find(b"PK\x05\x06")
    while 0 <= end and end + 22 <= len(d):
        entries, size, offset, note = struct.unpack_from("<HIIH", d, end + 10)
        at = end - size - offset
        if at >= 0 and entries and d[at + offset : at + offset + 4] == b"PK\x01\x02" and end + 22 + note <= len(d):
            found.setdefault(at, end + 22 + note - at)
        end = d.find(b"PK\x05\x06", end + 4)
    return found


def _member(d: bytes, at: int) -> int:
    if at + 18 > len(d) or d[at : at + 3] != b"\x1f\x8b\x08" or d[at + 3] & 0xE0:
        return 0
    stream, p = zlib.decompressobj(31), at
    try:
        while p < len(d) and not stream.eof:
            rest = d[p : p + 65_536]
            p += len(rest)
            while rest and not stream.eof:
                stream.decompress(rest, 1 << 20)  # the content is checked, not kept
                rest = stream.unconsumed_tail
    except zlib.error:
        return 0
    return p - len(stream.unused_data) - at if stream.eof else 0


def _gzip(d: bytes, at: int, known: Chains) -> int:
    def step(p: int) -> tuple[int, int, bool]:
        size = _member(d, p)
        return p + size, 0, size > 0

    return chain(known, "gzip", at, step)[0] - at


def _ogg(d: bytes, at: int, known: Chains) -> int:
    def step(p: int) -> tuple[int, int, bool]:
        if d[p : p + 5] != b"OggS\0" or p + 27 > len(d):
            return p, 0, False
        segments = d[p + 26]
        end = p + 27 + segments + sum(d[p + 27 : p + 27 + segments])
        whole = p + 27 + segments <= len(d) and end <= len(d)
        return end if whole else p, 0, whole

    return chain(known, "ogg", at, step)[0] - at


def _flac(d: bytes, at: int, known: Chains) -> int:
    def step(p: int) -> tuple[int, int, bool]:
        if p + 4 > len(d):
            return p, 0, False
        after = p + 4 + int.from_bytes(d[p + 1 : p + 4], "big")
        if not d[p] & 0x80:
            return after, 0, True
        # Frames carry no length: they reach to the end of the value.
        return len(d), int(after + 2 <= len(d) and d[after] == 0xFF and d[after + 1] & 0xFC == 0xF8), False

    if at + 8 > len(d) or d[at + 4] & 0x7F or d[at + 5 : at + 8] != b"\0\0\x22":
        return 0
    end, whole = chain(known, "flac", at + 4, step)
    return end - at if whole else 0


def _mp4(d: bytes, at: int, known: Chains) -> int:
    def step(p: int) -> tuple[int, int, bool]:
        size, kind = int.from_bytes(d[p : p + 4], "big"), d[p + 4 : p + 8]
        if p + 8 > len(d) or not kind.isalnum() or size < 8 or p + size > len(d):
            return p, 0, False
        return p + size, int(kind in (b"moov", b"moof")), True

    if int.from_bytes(d[at : at + 4], "big") < 16:
        return 0
    end, films = chain(known, "mp4", at, step)
    return end - at if films else 0


VALIDATORS = {"png": _png, "bmp": _bmp, "pdf": _pdf}
CHAINED = {"jpeg": _jpeg, "gif": _gif, "gzip": _gzip, "ogg": _ogg, "flac": _flac, "mp4": _mp4}
#: Formats of parts that each begin like a medium.
PAGED = ("gzip", "ogg")


def medium_at(data: bytes, at: int, name: str, zips: dict[int, int] | None = None, known: Chains | None = None) -> tuple[str, int]:
    """Format and length of the valid medium there, or ('', 0). zips: what _zips() gives, if it is known; known: the
    value's chains so far."""
    if at < 0:
        return "", 0
    if name == "zip":
        size = (_zips(data) if zips is None else zips).get(at, 0)
        return ("zip", size) if size else ("", 0)
    if name == "riff":
        return _riff(data, at)
    size = CHAINED[name](data, at, {} if known is None else known) if name in CHAINED else VALIDATORS[name](data, at)
    return (name, size) if size else ("", 0)


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for magic, depth, name in MAGIC:
        found.add_word(magic.decode("latin-1"), (len(magic) - 1 + depth, name))
    found.make_automaton()
    return found


def sniff(data: bytes | None) -> tuple[str | None, int, list[tuple[str, int, int]]]:
    """(type, length of the medium at the start, embedded media as (type, offset, length)) of a value."""
    if data is None:
        return None, 0, []
    kind, size, end, embedded, zips, known = UNKNOWN, 0, 0, [], None, {}
    for last, (back, name) in _automaton().iter(data.decode("latin-1")):
        at = last - back
        if at != 0 and at < end:
            continue  # inside a medium that is carved already
        if 0 < at < size and name in PAGED and kind == TYPES[name]:
            continue  # a part of the medium at the start
        if name == "zip" and zips is None:
            zips = _zips(data)
        found, length = medium_at(data, at, name, zips, known)
        if not length:
            continue
        if at == 0:
            kind, size = TYPES[found], length
        else:
            embedded.append((TYPES[found], at, length))
            end = at + length
    return kind, size, embedded


SNIFFED = "id long, declared string, media_type string, corrected boolean, length long, embedded array<struct<media_type:string,offset:long,length:long>>"


def sniffed(values: DataFrame) -> DataFrame:
    """id, declared, media_type, corrected, length, embedded: one row for each row of values (id, data, declared)."""
    small_batches(values.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inner = pa.struct([("media_type", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
        for batch in batches:
            rows = [sniff(d) for d in batch.column(1).to_pylist()]
            declared = batch.column(2).to_pylist()
            columns = [
                batch.column(0), batch.column(2), pa.array([r[0] for r in rows], pa.string()),
                pa.array([r[0] is not None and r[0] != d for r, d in zip(rows, declared)], pa.bool_()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([[dict(zip(("media_type", "offset", "length"), e)) for e in r[2]] for r in rows], pa.list_(inner)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "declared", "media_type", "corrected", "length", "embedded"])

    narrow = values.select(F.col("id").cast("long"), F.col("data").cast("binary"), F.col("declared").cast("string"))
    return narrow.mapInArrow(run, SNIFFED)


def wav(samples: bytes) -> bytes:
    """A WAV file of one channel of unsigned 8-bit samples."""
    pad = b"\0" * (len(samples) % 2)
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(samples) + len(pad), b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", len(samples))
    return head + samples + pad


def wav_samples(data: bytes) -> bytes:
    """The samples of a WAV file of one channel of unsigned 8-bit samples."""
    name, size = _riff(data, 0)
    if name != "wav":
        raise ValueError("no WAV file")
    p, kind = 12, ()
    while p + 8 <= size:
        chunk, n = struct.unpack_from("<4sI", data, p)
        if chunk == b"fmt ":
            kind = struct.unpack_from("<HHIIHH", data, p + 8)
        elif chunk == b"data":
            if kind[:2] != (1, 1) or kind[5] != 8:
                raise ValueError("other samples than 8-bit ones of one channel")
            return data[p + 8 : p + 8 + n]
        p += 8 + n + n % 2
    raise ValueError("no samples")


def store_text(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: the texts of docs (doc_id, text) as WAV files."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = [(t or "").encode() for t in batch.column(1).to_pylist()]
            media = [wav(p.ljust(max(1, -(-len(p) // FRAME)) * FRAME)) for p in payloads]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, payloads), pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def feature(samples: bytes, kind: str, embedded: list[tuple[str, int, int]]) -> str:
    """Type, samples, mean and deviation from the middle in hundredths, crossings of the middle, embedded media."""
    x = np.frombuffer(samples, np.uint8).astype(np.int64) - 128
    n = max(1, len(x))
    crossings = int((np.diff(np.signbit(x)) != 0).sum())
    inside = ",".join(f"{t}@{a}+{n}" for t, a, n in embedded)
    return f"{kind};n={len(x)};mean={100 * int(x.sum()) // n};square={100 * int((x * x).sum()) // n};crossings={crossings};embedded=[{inside}]"


FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def stored_features(stored: DataFrame) -> DataFrame:
    """What the stored bytes of store_text() say, read back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in FEATURES.split(", ")]
        kinds = [pa.string() if c.endswith("string") else pa.int64() for c in FEATURES.split(", ")]
        for batch in batches:
            rows = []
            for i, n, media in zip(*(batch.column(k).to_pylist() for k in range(3))):
                kind, _, embedded = sniff(media)
                payload = wav_samples(media)
                sha = lambda b: hashlib.sha256(b).hexdigest()
                rows.append((i, n, len(payload), sha(payload), zlib.crc32(payload[-16:]), len(media), sha(media), feature(payload, kind, embedded)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

    return stored.mapInArrow(run, FEATURES)


def op10_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_features(store_text(table(spark, sf_dir, "documents")))
