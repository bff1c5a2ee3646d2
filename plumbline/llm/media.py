"""Media columns: Netpbm and BMP decoded to numpy arrays, area-resized, kept as NPY tiles with difference hashes.

Defined results: a null or undecodable image gives null in every result column (decoded are Netpbm P1 to P6, and BMP without
compression but for 16 bits; not PAM); repeated rows and other columns pass
unchanged; columns named like the results are replaced by them; an empty table gives an empty table. Text stored as an
image: null is empty, the bytes are padded with spaces to whole rows of 64 RGB pixels.
"""

from __future__ import annotations

import io
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import others, table
from plumbline.llm.tokens import give_back

#: Bytes of a row of the images that hold text: 64 pixels of three samples.
ROW = 192
TILE = 32
_TOKEN = re.compile(rb"(?:\s|#[^\n]*\n)*([^\s#]+)")


#: Digits of a number in a header; a longer one is no size.
DIGITS = 9


def decode(data: bytes) -> np.ndarray:
    """Rows x columns x channels of 8 bits: Netpbm P1 to P6 (samples of 16 bits are scaled down), and BMP of 1, 4, 8, 24 or
    32 bits without compression. Anything else is a ValueError, as are sizes of 0, samples above the maximum and cut data.
    """
    if data[:2] == b"BM":
        return _bmp(data)
    if data[:1] != b"P" or data[1:2] not in b"123456" or len(data) < 3:
        raise ValueError("neither Netpbm nor BMP")
    kind, at, header = int(data[1:2]), 2, []
    for _ in range(2 if kind in (1, 4) else 3):
        m = _TOKEN.match(data, at)
        if not m or not m[1].isdigit() or len(m[1]) > DIGITS:
            raise ValueError("a header without three numbers")
        header.append(int(m[1]))
        at = m.end()
    width, height, most = [*header, 1][:3]
    channels = 3 if kind in (3, 6) else 1
    if not (width and height and 0 < most < 65536):
        raise ValueError("no pixels, or more than 16 bits")
    values = _samples(data, at, kind, width, height, channels, most)
    if values.size != width * height * channels:
        raise ValueError("cut samples")
    if values.max() > most:
        raise ValueError("a sample above the maximum")
    out = values.reshape(height, width, channels)
    if kind in (1, 4):
        return (1 - out) * np.uint8(255)
    return out.astype(np.uint8) if most == 255 else ((out.astype(np.uint32) * 510 + most) // (2 * most)).astype(np.uint8)


def _samples(data: bytes, at: int, kind: int, width: int, height: int, channels: int, most: int) -> np.ndarray:
    n = width * height * channels
    if kind == 1:
        found = np.frombuffer(data, np.uint8, offset=at)
        return found[(found == 48) | (found == 49)][:n] - 48
    if kind in (2, 3):
        words = data[at:].split(maxsplit=n)[:n]
        if not all(w.isdigit() and len(w) <= DIGITS for w in words):
            raise ValueError("samples that are no numbers")
        return np.array(list(map(int, words)), np.uint32)
    if kind == 4:
        packed = np.frombuffer(data, np.uint8, count=(width + 7) // 8 * height, offset=at + 1)
        return np.unpackbits(packed.reshape(height, -1), axis=1)[:, :width].ravel()
    return np.frombuffer(data, np.uint8 if most < 256 else ">u2", count=n, offset=at + 1)


def _bmp(data: bytes) -> np.ndarray:
    at, head, width, height, _, bits, packing, _, _, _, colours = struct.unpack_from("<IIiiHHIIiiI", data, 10)
    if packing not in (0, 3) or bits not in (1, 4, 8, 24, 32) or width < 1 or not height:
        raise ValueError("a BMP of another kind")
    rows_n, stride = abs(height), (width * bits + 31) // 32 * 4
    if head < 40 or stride * rows_n > len(data):
        raise ValueError("cut rows, or a header of another kind")
    rows = np.frombuffer(data, np.uint8, count=stride * rows_n, offset=at).reshape(rows_n, stride)
    rows = rows[::-1] if height > 0 else rows
    if bits >= 24:
        return rows[:, : width * bits // 8].reshape(rows_n, width, bits // 8)[..., 2::-1]
    places = rows if bits == 8 else np.packbits(np.unpackbits(rows, axis=1).reshape(rows_n, -1, bits), axis=2)[..., 0] >> (8 - bits)
    palette = np.frombuffer(data, np.uint8, count=4 * (colours or 1 << bits), offset=14 + head).reshape(-1, 4)[:, 2::-1]
    if places[:, :width].max() >= len(palette):
        raise ValueError("a colour that the palette lacks")
    return palette[places[:, :width]]


def encode_bmp(image: np.ndarray) -> bytes:
    height, width, _ = image.shape
    pad = -width * 3 % 4
    rows = np.pad(image[::-1, :, ::-1].reshape(height, width * 3), ((0, 0), (0, pad)))
    return struct.pack("<2sIHHIIiiHHIIiiII", b"BM", 54 + rows.size, 0, 0, 54, 40, width, height, 1, 24, 0, rows.size, 2835, 2835, 0, 0) + rows.tobytes()


def area_resize(gray: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean of the area that each target pixel covers, edges in part, from an integral image."""
    total = np.zeros((gray.shape[0] + 1, gray.shape[1] + 1))
    np.cumsum(np.cumsum(gray, axis=0, dtype=np.float64), axis=1, out=total[1:, 1:])

    def along(table: np.ndarray, n: int) -> np.ndarray:
        edge = np.linspace(0, table.shape[0] - 1, n + 1)
        low = np.minimum(edge.astype(np.int64), table.shape[0] - 2)
        part = (edge - low)[:, None]
        return np.diff(table[low] * (1 - part) + table[low + 1] * part, axis=0)

    sums = along(along(total, height).T, width).T
    return sums * (height * width / gray.size)


def features(image: np.ndarray) -> tuple[bytes, str]:
    """A gray tile as an NPY file, and the 64-bit difference hash (each of eight rows against its right neighbours)."""
    gray = image[..., :3].astype(np.float32).mean(axis=2) if image.shape[2] > 1 else image[..., 0]
    tile = io.BytesIO()
    np.save(tile, np.floor(area_resize(gray, TILE, TILE) + 0.5).astype(np.uint8))
    small = area_resize(gray, 8, 9)
    return tile.getvalue(), np.packbits(small[:, 1:] > small[:, :-1]).tobytes().hex()


RESULTS = T.StructType([T.StructField("height", T.IntegerType()), T.StructField("width", T.IntegerType()), T.StructField("samples", T.BinaryType()), T.StructField("tile", T.BinaryType()), T.StructField("dhash", T.StringType())])


def media_columns(df: DataFrame, media: str = "media") -> DataFrame:
    """df with height, width, samples (rows of 8-bit samples as decoded), tile (NPY) and dhash."""
    own = df.select(*others(df, *[c for c in RESULTS.names if c.lower() != media.lower()]))
    schema = T.StructType([*own.schema.fields, *RESULTS.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_bytes(whole, media):
                found = [_one(x) for x in batch.column(batch.schema.get_field_index(media))]
                kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.string())
                columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.names)

    return own.mapInArrow(run, schema)


def _one(value: pa.Scalar) -> tuple:
    buffer = value.as_buffer()
    if buffer is None:
        return (None,) * 5
    try:
        image = decode(buffer.to_pybytes())
    except (ValueError, struct.error):
        return (None,) * 5
    return image.shape[0], image.shape[1], image.tobytes(), *features(image)


def by_bytes(batch: pa.RecordBatch, column: str, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about so many bytes of a column; a longer value stands alone."""
    lengths = pc.binary_length(batch.column(batch.schema.get_field_index(column))).fill_null(0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(lengths, dtype=np.int64), 0
    while at < len(lengths):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, to - at)
        at = to
    give_back()


def text_payload(text: Column) -> Column:
    """UTF-8 bytes padded with spaces to a positive multiple of a row."""
    text = F.coalesce(text, F.lit(""))
    n = F.octet_length(text)
    pad = F.when(n == 0, F.lit(ROW)).otherwise(F.pmod(-n, F.lit(ROW)))
    return F.encode(F.concat(text, F.repeat(F.lit(" "), pad)), "UTF-8")


def text_as_ppm(text: Column) -> Column:
    payload = text_payload(text)
    rows = (F.octet_length(payload) / ROW).cast("int")
    return F.concat(F.encode(F.concat(F.lit(f"P6\n{ROW // 3} "), rows.cast("string"), F.lit("\n255\n")), "UTF-8"), payload)


def op10_media_columns(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), text_as_ppm(F.col("text")).alias("media"))
    out = media_columns(docs)
    return out.select(
        "doc_id", "n_bytes", F.octet_length("samples").cast("long").alias("payload_bytes"), F.sha2("samples", 256).alias("payload_sha256"),
        F.crc32(F.substring("samples", -16, 16)).alias("tail_crc32"), F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"), F.concat(F.col("dhash"), F.lit(":"), F.sha2("tile", 256)).alias("feature"),
    )
