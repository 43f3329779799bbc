"""TIFF media columns: baseline TIFF 6.0 written and read in plain Python and numpy.

Reading walks the chain of image directories in either byte order, gathers strips or
tiles, undoes PackBits, LZW or deflate and then the horizontal predictor, and gives
one page for each directory.  Writing lays a payload out as 8-bit samples, so that
the operator can be checked by a round trip.

Defined cases: null and empty media give no page and ``error`` "empty"; bytes that
are no TIFF, or one that is cut off, has a directory loop or an unknown compression,
give one row with ``page`` null and ``error`` set, and never stop the job.  A payload
that is null counts as empty.  Other columns are passed through under their own
names; equal media give equal rows.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.llm.flat import flat, map_arrow

# Fixed values of TIFF 6.0: tags, compressions, and the size of each field type.
WIDTH, LENGTH, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS, PLANAR, PREDICTOR = 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_COUNTS = 322, 323, 324, 325
NONE, LZW, DEFLATE, PACKBITS, OLD_DEFLATE = 1, 5, 8, 32773, 32946
TYPE_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
ROW = 192
MOST_EXPANSION = 4096


class TiffError(ValueError):
    """The bytes are not a TIFF that this module reads."""


def pack_bits(data: bytes) -> bytes:
    """PackBits of one row."""
    out, i, n = bytearray(), 0, len(data)
    while i < n:
        j = i + 1
        while j < n and j - i < 128 and data[j] == data[i]:
            j += 1
        if j - i >= 2:
            out += bytes((257 - (j - i), data[i]))
        else:
            while j < n and j - i < 128 and not (j + 1 < n and data[j] == data[j + 1]):
                j += 1
            out.append(j - i - 1)
            out += data[i:j]
        i = j
    return bytes(out)


def unpack_bits(data: bytes, size: int) -> bytes:
    out, i, n = bytearray(), 0, len(data)
    while i < n and len(out) < size:
        c = data[i]
        if c < 128:
            out += data[i + 1 : i + 2 + c]
            i += 2 + c
        elif c > 128:
            if i + 1 >= n:
                raise TiffError("PackBits is cut off")
            out += data[i + 1 : i + 2] * (257 - c)
            i += 2
        else:
            i += 1
    return bytes(out)


def lzw(data: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits, high bit first, widened one code early; 256 clears, 257 ends."""
    out, acc, bits, width = bytearray(), 0, 0, 9

    def put(code: int) -> None:
        nonlocal acc, bits
        acc, bits = (acc << width) | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(acc >> bits & 255)
        acc &= (1 << bits) - 1

    table, after, prefix = {}, 258, -1
    put(256)
    for byte in data:
        if prefix < 0:
            prefix = byte
            continue
        if (code := table.get(prefix << 8 | byte)) is not None:
            prefix = code
            continue
        put(prefix)
        table[prefix << 8 | byte], after, prefix = after, after + 1, byte
        if after == 4095:
            put(256)
            table, after, width = {}, 258, 9
        elif after + 1 > 1 << width:
            width += 1
    if prefix >= 0:
        put(prefix)
        after += 1
        if after + 1 > 1 << width and width < 12:
            width += 1
    put(257)
    if bits:
        out.append(acc << (8 - bits) & 255)
    return bytes(out)


def unlzw(data: bytes, size: int) -> bytes:
    out, width, acc, bits = bytearray(), 9, 0, 0
    base = [bytes((k,)) for k in range(256)] + [b"", b""]
    table, before = list(base), b""
    for byte in data:
        acc, bits = (acc << 8) | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code = acc >> bits
        acc &= (1 << bits) - 1
        if code == 257 or len(out) >= size:
            return bytes(out)
        if code == 256:
            table, width, before = list(base), 9, b""
            continue
        if code < len(table):
            entry = table[code]
        elif code == len(table) and before:
            entry = before + before[:1]
        else:
            raise TiffError("LZW code out of range")
        out += entry
        if before:
            table.append(before + entry[:1])
            if len(table) + 1 >= 1 << width and width < 12:
                width += 1
        before = entry
    return bytes(out)


def _encode(block: np.ndarray, compression: int, predictor: int, level: int) -> bytes:
    """block: (rows, pixels, samples)."""
    if predictor == 2:
        block = np.concatenate([block[:, :1], block[:, 1:] - block[:, :-1]], axis=1)
    raw = np.ascontiguousarray(block).tobytes()
    if compression == NONE:
        return raw
    if compression == LZW:
        return lzw(raw)
    if compression == DEFLATE:
        return zlib.compress(raw, level)
    if compression == PACKBITS:
        wide = block.shape[1] * block.shape[2]
        return b"".join(pack_bits(raw[i : i + wide]) for i in range(0, len(raw), wide))
    raise TiffError(f"compression {compression}")


@dataclass(frozen=True)
class Layout:
    """How a payload is laid out: rows of 64 pixels of 3 samples, so many rows on a page, strips or square-ish tiles."""

    compression: int = DEFLATE
    predictor: int = 2
    level: int = 1
    rows_per_page: int = 4096
    rows_per_strip: int = 256
    tile: int = 0
    order: str = "<"


# Every codec, strips and tiles, both predictors and byte orders, and pages of several sizes.  LZW and PackBits are
# written and read in plain Python and have two places of sixteen each.
LAYOUTS = (
    Layout(),
    Layout(rows_per_page=16),
    Layout(rows_per_page=64, rows_per_strip=8, order=">"),
    Layout(predictor=1),
    Layout(predictor=1, rows_per_page=32, order=">"),
    Layout(tile=16, rows_per_page=64),
    Layout(tile=32, predictor=1),
    Layout(tile=64, order=">"),
    Layout(level=6),
    Layout(level=6, rows_per_page=128, rows_per_strip=32),
    Layout(rows_per_strip=1, rows_per_page=256),
    Layout(NONE, predictor=1, rows_per_page=512),
    Layout(LZW, predictor=1, rows_per_page=128, rows_per_strip=64),
    Layout(LZW, tile=32, order=">"),
    Layout(PACKBITS, predictor=1, rows_per_strip=16),
    Layout(PACKBITS, tile=16, rows_per_page=64, order=">"),
)


def layout_of(payload: bytes) -> Layout:
    """The layout of a payload, by its content: equal payloads have equal files."""
    return LAYOUTS[zlib.crc32(payload, 5) % len(LAYOUTS)]


def write_pages(pages: list[np.ndarray], how: Layout = Layout(), order: str | None = None) -> bytes:
    """A TIFF of pages of shape (rows, pixels, samples)."""
    order = order or how.order
    out = bytearray(b"II*\0" if order == "<" else b"MM\0*") + struct.pack(order + "I", 0)
    link = 4
    for page in pages:
        rows, wide, samples = page.shape
        blocks = []
        if how.tile:
            t = how.tile
            padded = np.zeros((-(-rows // t) * t, -(-wide // t) * t, samples), np.uint8)
            padded[:rows, :wide] = page
            blocks = [padded[y : y + t, x : x + t] for y in range(0, padded.shape[0], t) for x in range(0, padded.shape[1], t)]
        else:
            blocks = [page[y : y + how.rows_per_strip] for y in range(0, rows, how.rows_per_strip)]
        offsets, counts = [], []
        for b in blocks:
            data = _encode(b, how.compression, how.predictor, how.level)
            offsets.append(len(out))
            counts.append(len(data))
            out += data
            out += b"\0" * (len(out) % 2)
        entries = [(WIDTH, 4, [wide]), (LENGTH, 4, [rows]), (BITS, 3, [8] * samples), (COMPRESSION, 3, [how.compression]), (PHOTOMETRIC, 3, [2 if samples == 3 else 1])]
        if not how.tile:
            entries.append((STRIP_OFFSETS, 4, offsets))
        entries.append((SAMPLES, 3, [samples]))
        if not how.tile:
            entries += [(ROWS_PER_STRIP, 4, [how.rows_per_strip]), (STRIP_COUNTS, 4, counts)]
        entries += [(PLANAR, 3, [1]), (PREDICTOR, 3, [how.predictor])]
        if how.tile:
            entries += [(TILE_WIDTH, 4, [how.tile]), (TILE_LENGTH, 4, [how.tile]), (TILE_OFFSETS, 4, offsets), (TILE_COUNTS, 4, counts)]
        packed = []
        for tag, kind, values in entries:
            data = struct.pack(f"{order}{len(values)}{'H' if kind == 3 else 'I'}", *values)
            if len(data) > 4:
                spot = len(out)
                out += data
                data = struct.pack(order + "I", spot)
            packed.append(struct.pack(order + "HHI", tag, kind, len(values)) + data.ljust(4, b"\0"))
        struct.pack_into(order + "I", out, link, len(out))
        out += struct.pack(order + "H", len(packed)) + b"".join(packed)
        link = len(out)
        out += struct.pack(order + "I", 0)
    return bytes(out)


@dataclass
class Page:
    """One image directory and its samples, (rows, pixels, samples)."""

    pixels: np.ndarray
    compression: int
    predictor: int
    tags: dict[int, tuple] = field(default_factory=dict)


def _directory(data: bytes, at: int, order: str) -> tuple[dict[int, tuple], int]:
    try:
        (n,) = struct.unpack_from(order + "H", data, at)
        tags = {}
        for k in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
            size = TYPE_SIZE.get(kind, 1) * count
            spot = at + 10 + 12 * k if size <= 4 else struct.unpack_from(order + "I", data, at + 10 + 12 * k)[0]
            if spot + size > len(data):
                raise TiffError("a field lies outside the file")
            if kind in (1, 3, 4) and count:  # no field of another type is needed
                tags[tag] = struct.unpack_from(f"{order}{count}{ {1: 'B', 3: 'H', 4: 'I'}[kind] }", data, spot)
        return tags, struct.unpack_from(order + "I", data, at + 2 + 12 * n)[0]
    except struct.error as e:
        raise TiffError("a directory is cut off") from e


def _decode(part: bytes, compression: int, size: int) -> bytes:
    if compression == NONE:
        out = part
    elif compression in (DEFLATE, OLD_DEFLATE):
        try:
            out = zlib.decompressobj().decompress(part, size)
        except zlib.error as e:
            raise TiffError("broken deflate data") from e
    elif compression == LZW:
        out = unlzw(part, size)
    elif compression == PACKBITS:
        out = unpack_bits(part, size)
    else:
        raise TiffError(f"compression {compression} is not read")
    if len(out) < size:
        raise TiffError("a strip or tile is too short")
    return out[:size]


def read_pages(data: bytes) -> Iterator[Page]:
    """The pages of a TIFF with 8-bit samples, chunky."""
    order = {b"II*\0": "<", b"MM\0*": ">"}.get(bytes(data[:4]))
    if order is None or len(data) < 8:
        raise TiffError("no TIFF header")
    (at,) = struct.unpack_from(order + "I", data, 4)
    seen = set()
    while at:
        if at in seen:
            raise TiffError("the directories form a loop")
        seen.add(at)
        tags, at = _directory(data, at, order)
        one = lambda tag, default=None, tags=tags: tags[tag][0] if tag in tags else default
        wide, rows, samples, compression, predictor = one(WIDTH), one(LENGTH), one(SAMPLES, 1), one(COMPRESSION, 1), one(PREDICTOR, 1)
        if not wide or not rows or set(tags.get(BITS, (1,))) != {8} or one(PLANAR, 1) != 1 or predictor not in (1, 2):
            raise TiffError("only chunky 8-bit images with predictor 1 or 2 are read")
        # no codec here expands further, so a small file can't ask for a large picture
        if rows * wide * samples > MOST_EXPANSION * len(data):
            raise TiffError("the picture is larger than its data can be")
        if TILE_OFFSETS in tags:
            th, tw, offsets, counts = one(TILE_LENGTH), one(TILE_WIDTH), tags[TILE_OFFSETS], tags.get(TILE_COUNTS, ())
            if not th or not tw or th * tw * samples > MOST_EXPANSION * len(data):
                raise TiffError("tiles of a wrong size")
            spots = [(y, x) for y in range(0, rows, th) for x in range(0, wide, tw)]
        else:
            th, tw, offsets, counts = min(one(ROWS_PER_STRIP, rows), rows), wide, tags.get(STRIP_OFFSETS, ()), tags.get(STRIP_COUNTS, ())
            if not th:
                raise TiffError("strips without rows")
            spots = [(y, 0) for y in range(0, rows, th)]
        if len(offsets) != len(spots) or len(counts) != len(spots):
            raise TiffError("strips or tiles are missing")
        pixels = np.empty((rows, wide, samples), np.uint8)
        for (y, x), o, c in zip(spots, offsets, counts, strict=True):
            high = th if TILE_OFFSETS in tags else min(th, rows - y)
            block = np.frombuffer(_decode(data[o : o + c], compression, high * tw * samples), np.uint8).reshape(high, tw, samples)
            if predictor == 2:
                block = np.add.accumulate(block, axis=1, dtype=np.uint8)
            pixels[y : y + th, x : x + tw] = block[: rows - y, : wide - x]
        yield Page(pixels, compression, predictor, tags)


def payload_pages(payload: bytes, how: Layout) -> list[np.ndarray]:
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW // 3, 3)
    return [rows[k : k + how.rows_per_page] for k in range(0, len(rows), how.rows_per_page)]


def pad(data: bytes) -> bytes:
    """With bytes 32 up to a positive multiple of ROW."""
    return data.ljust(max(1, -(-len(data) // ROW)) * ROW, b" ")


def page_feature(pixels: np.ndarray) -> str:
    """An 8 by 8 grid of means against their median, as 16 hexadecimal digits, and the mean of the page."""
    rows, wide, samples = pixels.shape
    plain = pixels.reshape(rows, wide * samples).astype(np.int64)
    ys, xs = np.arange(8) * rows // 8, np.arange(8) * (wide * samples) // 8
    y1, x1 = np.maximum((np.arange(8) + 1) * rows // 8, ys + 1), (np.arange(8) + 1) * (wide * samples) // 8
    by_x = np.add.reduceat(plain, xs, axis=1)
    cells = np.stack([by_x[a:b].sum(0) / ((b - a) * (x1 - xs)) for a, b in zip(ys, y1, strict=True)])
    bits = (cells > np.median(cells)).ravel()
    return f"{int(''.join('1' if b else '0' for b in bits), 2):016x}:{plain.mean():.3f}"


PAGE_FIELDS = "page int, width int, height int, samples int, compression int, predictor int, pixels binary, feature string, error string"


def pages(df: DataFrame, media_col: str) -> DataFrame:
    """One row for each page of the TIFF in ``media_col``, with the other columns (under their names) before it; those named as a page's own give way."""
    own = set(T._parse_datatype_string(PAGE_FIELDS).names)
    names = [c for c in df.columns if c != media_col and c not in own]
    source = df.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{media_col}`").cast("binary").alias("__media"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = [(n, pa.int32()) for n in ("page", "width", "height", "samples", "compression", "predictor")]
        schema = pa.schema([*numbers, ("pixels", pa.binary()), ("feature", pa.string()), ("error", pa.string())])
        for b in batches:
            for k in range(b.num_rows):  # a row's pages leave before the next row is opened
                data, rows = b.column(b.num_columns - 1)[k].as_py(), []
                try:
                    for i, p in enumerate(read_pages(data or b"")):
                        h, w, s = p.pixels.shape
                        rows.append((i, w, h, s, p.compression, p.predictor, p.pixels.tobytes(), page_feature(p.pixels), None))
                except TiffError as e:
                    rows.append((None,) * 8 + (str(e) if data else "empty",))
                cols = [pa.array([r[j] for r in rows], f.type) for j, f in enumerate(schema)]
                left = b.slice(k, 1).columns[:-1]
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array([0] * len(rows))) for c in left), *cols], names=[*b.schema.names[:-1], *schema.names])

    return map_arrow(source, run, T.StructType([*source.schema.fields[:-1], *T._parse_datatype_string(PAGE_FIELDS).fields]))


STORED = "n_bytes long, payload_bytes long, media binary"


def store(df: DataFrame, text_col: str, how: Layout | None = None, carry: list[str] | None = None) -> DataFrame:
    """The carried columns and the text's padded bytes as a TIFF: n_bytes (unpadded), payload_bytes, media.

    Without a layout each payload has one of LAYOUTS, by its content.
    """
    source = df.select(*[F.col(f"`{c}`") for c in (carry or [])], F.col(f"`{text_col}`").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _parts(b, 4 << 20):
                raw, at = flat(part.column(part.num_columns - 1))
                whole = raw.tobytes()
                texts = [whole[at[k] : at[k + 1]] for k in range(part.num_rows)]
                padded = [pad(t) for t in texts]
                media = [write_pages(payload_pages(p, x), x) for p, x in ((p, how or layout_of(p)) for p in padded)]
                sizes = [pa.array([len(x) for x in rows], pa.int64()) for rows in (texts, padded)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *sizes, pa.array(media, pa.binary())], names=[*b.schema.names[:-1], "n_bytes", "payload_bytes", "media"])

    return map_arrow(source, run, T.StructType([*source.schema.fields[:-1], *T._parse_datatype_string(STORED).fields]))


def _parts(b: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose last column has about ``most`` bytes."""
    last = b.column(b.num_columns - 1)
    at = np.r_[0, np.cumsum([len(x.as_py() or b"") for x in last])] if pa.types.is_binary(last.type) else flat(last)[1]
    i = 0
    while i < b.num_rows:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield b.slice(i, j - i)
        i = j


DIGEST = "doc_id long, n_bytes long, payload_bytes long, media_bytes long, media_sha256 string, payload_sha256 string, tail_crc32 long, feature string"


class _Read:
    """What the pages of one file amount to."""

    def __init__(self, row: tuple) -> None:
        self.row, self.sha, self.tail = row, hashlib.sha256(), b""
        self.marks: list[str] = []
        self.wide = self.high = 0

    def add(self, pixels: bytes, wide: int, high: int, mark: str) -> None:
        self.sha.update(pixels)
        self.tail = (self.tail + pixels[-16:])[-16:]
        self.marks.append(mark)
        self.wide, self.high = wide, self.high + high

    def out(self) -> tuple:
        return (*self.row, self.sha.hexdigest(), zlib.crc32(self.tail), f"{len(self.marks)}x{self.wide}x{self.high}:" + ",".join(self.marks))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of pages in their order, five columns of the file before them -> DIGEST.  Holds one file's digests."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    names = [f.split()[0] for f in DIGEST.split(", ")]
    now, rows = None, []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    for b in batches:
        own = list(zip(*(c.to_pylist() for c in b.columns[:5]), strict=True))
        page, wide, high, mark, error = (b.column(b.schema.get_field_index(n)).to_pylist() for n in ("page", "width", "height", "feature", "error"))
        pixels = b.column(b.schema.get_field_index("pixels"))
        for k in range(b.num_rows):
            if error[k] is not None:
                raise TiffError(error[k])  # what store() wrote is read
            if page[k] == 0:
                if now is not None:
                    rows.append(now.out())
                now = _Read(own[k])
            now.add(pixels[k].as_py(), wide[k], high[k], mark[k])
        if rows:
            yield out()
            rows = []
    if now is not None:
        rows.append(now.out())
        yield out()


def op5_tiff(spark, sf_dir: str) -> DataFrame:
    """Query: every text as a TIFF of one of LAYOUTS, read back page by page; digests of what was read, and of the file."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stored = store(docs, "text", carry=["doc_id"])
    files = stored.select("doc_id", "n_bytes", "payload_bytes", F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "media")
    # the pages of a file come one after another within the task that wrote it: nothing is shuffled
    return pages(files, "media").mapInArrow(_digest, DIGEST)
