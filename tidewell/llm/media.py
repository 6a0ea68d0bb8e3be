"""Media columns: ISO base media containers.

``mux`` stores a payload losslessly as raw 8-bit samples in an ISO media file
(``ftyp``, ``moov`` with a full sample table, ``mdat``); ``parse`` walks the
nested boxes of any such file, decodes its sample tables and gives, for each
track, codec, duration, the byte range of every sample's chunk and the byte
ranges of key frames, without decoding a payload. Both work on one row at a
time, so memory is bounded by one file.
"""

from __future__ import annotations

import hashlib
import struct
import sys
import zlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from .common import sized_slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: One sample is a 24 x 24 picture of 8-bit grey values.
WIDTH, HEIGHT = 24, 24
FRAME = WIDTH * HEIGHT
TIMESCALE, TICKS = 25_000, 1_000
#: Every so many samples one is a sync sample, and a new chunk begins.
GOP = 12
#: Boxes whose content is boxes (fixed values).
CONTAINERS = frozenset("moov trak edts mdia minf dinf stbl mvex moof traf mfra udta".split())

#: Boxes within boxes, at most; a file nests about seven.
DEPTH = 32


class MediaError(ValueError):
    """The bytes are not a well-formed container."""


def pad(data: bytes, unit: int = FRAME) -> bytes:
    """``data`` and bytes 255 up to a positive multiple of ``unit``."""
    return data + b"\xff" * (-len(data) % unit or (0 if data else unit))


def _box(kind: str, *parts: bytes) -> bytes:
    body = b"".join(parts)
    size = len(body) + 8
    if size >= 1 << 32:
        return struct.pack(">I4sQ", 1, kind.encode(), size + 8) + body
    return struct.pack(">I4s", size, kind.encode()) + body


def _full(kind: str, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", version << 24 | flags), *parts)


_MATRIX = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def mux(payload: bytes) -> bytes:
    """An ISO media file with one track of raw grey pictures that hold ``payload`` (a positive multiple of 576)."""
    n, rest = divmod(len(payload), FRAME)
    if rest or not n:
        raise ValueError("the payload has to be a positive multiple of a frame")
    duration = n * TICKS
    chunks = -(-n // GOP)
    ftyp = _box("ftyp", b"isom", struct.pack(">I", 512), b"isomiso2")
    entry = _box("raw ", bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HHIIIH", WIDTH, HEIGHT, 0x480000, 0x480000, 0, 1), bytes(32), struct.pack(">Hh", 8, -1))
    stsc = [(1, GOP, 1)] if n >= GOP else []
    if n % GOP:
        stsc.append((chunks, n % GOP, 1))

    def moov(first: int) -> bytes:
        offsets = [first + k * GOP * FRAME for k in range(chunks)]
        wide = offsets[-1] >= 1 << 32
        stbl = _box(
            "stbl",
            _full("stsd", struct.pack(">I", 1), entry),
            _full("stts", struct.pack(">III", 1, n, TICKS)),
            _full("stss", struct.pack(">I", chunks), struct.pack(f">{chunks}I", *range(1, n + 1, GOP))),
            _full("stsc", struct.pack(">I", len(stsc)), *[struct.pack(">III", *x) for x in stsc]),
            _full("stsz", struct.pack(">II", FRAME, n)),
            _full("co64" if wide else "stco", struct.pack(">I", chunks), struct.pack(f">{chunks}{'Q' if wide else 'I'}", *offsets)),
        )
        minf = _box("minf", _full("vmhd", bytes(8), flags=1), _box("dinf", _full("dref", struct.pack(">I", 1), _full("url ", flags=1))), stbl)
        mdia = _box("mdia", _full("mdhd", struct.pack(">QQIQHH", 0, 0, TIMESCALE, duration, 0x55C4, 0), version=1), _full("hdlr", bytes(4), b"vide", bytes(12), b"samples\0"), minf)
        tkhd = _full("tkhd", struct.pack(">QQIIQ", 0, 0, 1, 0, duration), bytes(16), _MATRIX, struct.pack(">II", WIDTH << 16, HEIGHT << 16), version=1, flags=3)
        mvhd = _full("mvhd", struct.pack(">QQIQ", 0, 0, TIMESCALE, duration), struct.pack(">IH", 0x10000, 0x100), bytes(10), _MATRIX, bytes(24), struct.pack(">I", 2), version=1)
        return _box("moov", mvhd, _box("trak", tkhd, mdia))

    head = 16 if len(payload) + 8 >= 1 << 32 else 8
    front = len(ftyp) + len(moov(0)) + head
    return ftyp + moov(front) + _box("mdat", payload)


@dataclass
class Track:
    """What a track's boxes say."""

    codec: str = ""
    handler: str = ""
    timescale: int = 0
    duration: int = 0
    width: int = 0
    height: int = 0
    sizes: list[int] = field(default_factory=list)
    offsets: list[int] = field(default_factory=list)
    sync: list[int] = field(default_factory=list)

    def keyframes(self) -> list[tuple[int, int]]:
        """(first, after the last) byte of each sync sample; all samples where no table names them."""
        at = self.sync or range(1, len(self.sizes) + 1)
        return [(self.offsets[i - 1], self.offsets[i - 1] + self.sizes[i - 1]) for i in at]

    def seconds(self) -> float:
        return self.duration / self.timescale if self.timescale else 0.0


def boxes(data: memoryview):
    """(path, first byte of the content, end) of every box, depth first."""
    open_ = [(0, len(data), "")]
    while open_:
        at, end, path = open_.pop()
        if at == end:
            continue
        if end - at < 8:
            raise MediaError(f"{end - at} stray bytes in {path or 'the file'}")
        size, kind = struct.unpack_from(">I4s", data, at)
        body = at + 8
        if size == 1:
            if end - at < 16:
                raise MediaError("a cut large box")
            size = struct.unpack_from(">Q", data, at + 8)[0]
            body = at + 16
        elif size == 0:
            size = end - at
        if size < body - at or at + size > end:
            raise MediaError(f"a box of {size} bytes in {end - at}")
        name = kind.decode("latin-1")
        yield f"{path}/{name}", body, at + size
        open_.append((at + size, end, path))
        if name in CONTAINERS:
            if path.count("/") >= DEPTH:
                raise MediaError(f"boxes nested deeper than {DEPTH}")
            open_.append((body, at + size, f"{path}/{name}"))


def _numbers(view: memoryview, at: int, end: int, code: str, many: int) -> tuple[int, ...]:
    """So many big-endian numbers, which have to lie in their box."""
    if many * struct.calcsize(f">{code}") > end - at:
        raise MediaError(f"a table of {many} numbers in {max(0, end - at)} bytes")
    return struct.unpack_from(f">{many}{code}", view, at)


def _sizes(view: memoryview, kind: str, at: int, end: int) -> list[int]:
    """Sample sizes; together they are no more than the file, so a number in the table cannot ask for memory."""
    one, n = _numbers(view, at + 4, end, "I", 2)
    if kind == "stz2":
        bits = one & 0xFF
        if bits not in (4, 8, 16):
            raise MediaError(f"sample sizes of {bits} bits")
        if bits == 4:
            packed = _numbers(view, at + 12, end, "B", (n + 1) // 2)
            return [x for b in packed for x in (b >> 4, b & 15)][:n]
        return list(_numbers(view, at + 12, end, "B" if bits == 8 else "H", n))
    if one and one * n > len(view):
        raise MediaError(f"{n} samples of {one} bytes in {len(view)}")
    return [one] * n if one else list(_numbers(view, at + 12, end, "I", n))


def parse(data: bytes) -> list[Track]:
    """The tracks of a container. Raises ``MediaError`` on bytes that are none, whatever they are, and on fragmented files."""
    view = memoryview(data)
    tracks: list[Track] = []
    tables: list[dict] = []
    for path, at, end in boxes(view):
        kind = path.rsplit("/", 1)[1]
        if kind in ("moof", "mvex"):
            raise MediaError("fragments are not decoded")
        if kind == "trak":
            tracks.append(Track())
            tables.append({})
            continue
        if not tracks or not path.startswith("/moov/trak"):
            continue
        t, table = tracks[-1], tables[-1]
        if kind == "mdhd":
            wide = _numbers(view, at, end, "B", 1)[0] == 1
            t.timescale = _numbers(view, at + (20 if wide else 12), end, "I", 1)[0]
            t.duration = _numbers(view, at + (24 if wide else 16), end, "Q" if wide else "I", 1)[0]
        elif kind == "tkhd":
            t.width, t.height = (x >> 16 for x in _numbers(view, max(at, end - 8), end, "I", 2))
        elif kind == "hdlr":
            t.handler = bytes(_numbers(view, at + 8, end, "B", 4)).decode("latin-1")
        elif kind == "stsd":
            t.codec = bytes(_numbers(view, at + 12, end, "B", 4)).decode("latin-1")
        elif kind in ("stts", "stss", "stsc", "stco", "co64"):
            n = _numbers(view, at + 4, end, "I", 1)[0]
            width, code = {"stts": (2, "I"), "stss": (1, "I"), "stsc": (3, "I"), "stco": (1, "I"), "co64": (1, "Q")}[kind]
            table["offsets" if kind in ("stco", "co64") else kind] = _numbers(view, at + 8, end, code, n * width)
        elif kind in ("stsz", "stz2"):
            t.sizes = _sizes(view, kind, at, end)
    for t, table in zip(tracks, tables):
        if sum(t.sizes) > len(view):
            raise MediaError(f"samples of {sum(t.sizes)} bytes in {len(view)}")
        runs = table.get("stsc", ())
        chunks = table.get("offsets", ())
        firsts = [*runs[::3], len(chunks) + 1]
        if runs and (firsts[0] != 1 or any(a >= b for a, b in zip(firsts, firsts[1:]))):
            raise MediaError("runs of chunks out of order, or of chunks that are not there")
        i = 0
        for k in range(len(runs) // 3):
            for c in range(firsts[k], firsts[k + 1]):
                at = chunks[c - 1]
                for size in t.sizes[i : i + runs[3 * k + 1]]:
                    t.offsets.append(at)
                    at += size
                i = len(t.offsets)
        if i != len(t.sizes):
            raise MediaError(f"{len(t.sizes)} samples, {i} of them in chunks")
        t.sync = list(table.get("stss", ()))
        if any(not 1 <= s <= i for s in t.sync):
            raise MediaError("a key frame that is no sample")
    return tracks


def samples(data: bytes, track: Track) -> bytes:
    """The stored bytes of all samples of a track, in order."""
    view = memoryview(data)
    if any(o + s > len(view) for o, s in zip(track.offsets, track.sizes)):
        raise MediaError("a sample lies beyond the end")
    return b"".join(view[o : o + s] for o, s in zip(track.offsets, track.sizes))


def feature(track: Track) -> str:
    """codec;handler;width x height;seconds;samples;key frames as start-end byte ranges."""
    keys = ",".join(f"{a}-{b}" for a, b in track.keyframes())
    return f"codec={track.codec};type={track.handler};size={track.width}x{track.height};seconds={track.seconds():.3f};samples={len(track.sizes)};keyframes={keys}"


#: So many bytes of texts are stored or read at a time, or one longer text.
SLICE_BYTES = 32 << 20


def store(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with a binary column ``media``: each whole text (null: empty) as a container."""
    names = df.columns
    at = names.index(text)

    def run(batches):
        for b in sized_slices(batches, at, 512, SLICE_BYTES):
            media = [mux(pad((t or "").encode())) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(media, pa.binary())], names=[*b.schema.names, "media"])

    from pyspark.sql import types as T

    flat = df.toDF(*[f"c{i}" for i in range(len(names))])
    return flat.mapInArrow(run, T.StructType([*flat.schema.fields, T.StructField("media", T.BinaryType())])).toDF(*names, "media")


def inspect(df: DataFrame, media: str = "media") -> DataFrame:
    """All other columns, and of each container in ``media``: ``payload_bytes, payload_sha256, tail_crc32, media_bytes,
    media_sha256, codec, seconds, n_samples, keyframes`` (array of start and end bytes), ``feature, error``.

    Of the first track, from what is stored. Null media, or bytes that are no
    container, give nulls and say why in ``error``; an empty table no rows.
    """
    names = df.columns
    at = names.index(media)
    kept = [i for i in range(len(names)) if i != at]
    fields = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, codec string, seconds double, n_samples long, keyframes array<struct<start:long,end:long>>, feature string, error string"

    def run(batches):
        for b in sized_slices(batches, at, 512, SLICE_BYTES):
            rows = []
            for data in b.column(at).to_pylist():
                try:
                    if data is None:
                        raise MediaError("no media")
                    tracks = parse(data)
                    if not tracks:
                        raise MediaError("no track")
                    t = tracks[0]
                    own = samples(data, t)
                    keys = [{"start": a, "end": e} for a, e in t.keyframes()]
                    rows.append((len(own), hashlib.sha256(own).hexdigest(), zlib.crc32(own[-32:]), len(data), hashlib.sha256(data).hexdigest(), t.codec, t.seconds(), len(t.sizes), keys, feature(t), None))
                except MediaError as e:
                    rows.append((None,) * 10 + (str(e),))
            cols = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in kept), *cols], names=[*(b.schema.names[i] for i in kept), *out])

    from pyspark.sql import types as T

    extra = T._parse_datatype_string(fields)
    out = extra.names
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string(), pa.string()]
    flat = df.toDF(*[f"c{i}" for i in range(len(names))])
    return flat.mapInArrow(run, T.StructType([*(flat.schema.fields[i] for i in kept), *extra.fields])).toDF(*(names[i] for i in kept), *out)
