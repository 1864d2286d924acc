"""Page images: decoding, average hashes, exact and near duplicates. PNG and portable maps, in numpy.

Images in other formats come through a decoder given by the caller (bytes to an array of rows of gray or RGB values).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonde.operators import firsts

Decoder = Callable[[bytes], np.ndarray]
SIDE, NEAR = 16, 6
#: Images in an Arrow batch: pages are some megabytes each.
IMAGES = 16


def png(data: bytes) -> np.ndarray:
    """Rows of gray or RGB values of a PNG of 8 bits that isn't interlaced; alpha is put over white."""
    at, head, body, palette = 8, None, b"", None
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + n]
        at += 12 + n
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"PLTE":
            palette = np.frombuffer(part, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body += part
    width, height, depth, colour, _, _, interlaced = head
    if depth != 8 or interlaced:
        raise ValueError("only PNG of 8 bits without interlacing")
    k = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour]
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, 1 + width * k)
    out = np.zeros((height + 1, width + 1, k), np.int32)  # a row and column of zeros before the first
    for y in range(height):
        way, line = raw[y, 0], raw[y, 1:].reshape(width, k).astype(np.int32)
        up = out[y]
        if way == 0:
            out[y + 1, 1:] = line
        elif way == 1:
            out[y + 1, 1:] = np.cumsum(line, axis=0) & 255
        elif way == 2:
            out[y + 1, 1:] = (line + up[1:]) & 255
        else:
            own = out[y + 1]
            for x in range(1, width + 1):
                a, b, c = own[x - 1], up[x], up[x - 1]
                if way == 3:
                    guess = (a + b) >> 1
                else:
                    p = a + b - c
                    pa_, pb, pc = np.abs(p - a), np.abs(p - b), np.abs(p - c)
                    guess = np.where((pa_ <= pb) & (pa_ <= pc), a, np.where(pb <= pc, b, c))
                own[x] = (line[x - 1] + guess) & 255
    image = out[1:, 1:].astype(np.uint8)
    if colour == 3:
        return palette[image[:, :, 0]]
    if colour in (4, 6):
        alpha = image[:, :, -1:].astype(float) / 255
        return (image[:, :, :-1] * alpha + 255 * (1 - alpha)).round().astype(np.uint8)
    return image


def decode(data: bytes) -> np.ndarray:
    """PNG, and portable gray and colour maps (P5, P6)."""
    if data[:8] == b"\x89PNG\r\n\x1a\n":
        return png(data)
    if data[:2] in (b"P5", b"P6"):
        parts = data.split(None, 4)
        width, height = int(parts[1]), int(parts[2])
        body = data[-width * height * (1 if data[:2] == b"P5" else 3) :]
        return np.frombuffer(body, np.uint8).reshape(height, width, -1)
    raise ValueError("not an image that is read here")


def gray(image: np.ndarray) -> np.ndarray:
    """Brightness in whole numbers: 0.299 red, 0.587 green and 0.114 blue, in 16-bit fractions."""
    if image.ndim == 2 or image.shape[2] == 1:
        return image.reshape(image.shape[:2])
    return ((image[:, :, :3].astype(np.int64) @ np.array([19595, 38470, 7471]) + 0x8000) >> 16).astype(np.uint8)


def cubic(x: np.ndarray) -> np.ndarray:
    x = np.abs(x)
    return np.where(x < 1, (1.5 * x - 2.5) * x * x + 1, np.where(x < 2, ((-0.5 * x + 2.5) * x - 4) * x + 2, 0))


def weights(n: int, m: int) -> np.ndarray:
    """How much each of n pixels counts for each of m, in 22-bit fractions: cubic interpolation, widened to cover all pixels where m is less."""
    scale = n / m
    wide = max(scale, 1.0)
    out = np.zeros((m, n), np.int64)
    for i in range(m):
        centre = (i + 0.5) * scale
        low, high = max(0, int(centre - 2 * wide + 0.5)), min(n, int(centre + 2 * wide + 0.5))
        w = cubic((np.arange(low, high) - centre + 0.5) / wide)
        w = w / w.sum() * (1 << 22)
        out[i, low:high] = np.trunc(w + np.where(w < 0, -0.5, 0.5))
    return out


def resized(g: np.ndarray, height: int, width: int) -> np.ndarray:
    """Gray values by `weights`, rows first, rounded to 0 ... 255 after each direction."""
    clip = lambda x: np.clip((x + (1 << 21)) >> 22, 0, 255)
    return clip(weights(g.shape[0], height) @ clip(g.astype(np.int64) @ weights(g.shape[1], width).T)).astype(np.uint8)


def average_hash(g: np.ndarray, side: int = SIDE) -> np.ndarray:
    """side * side bits as signed 64-bit numbers: which cells are as bright as the mean or brighter."""
    small = resized(g, side, side).astype(np.int64)
    return np.packbits((small * small.size >= small.sum()).ravel(), bitorder="little").view(np.int64)


def hashed(images: DataFrame, decoder: Decoder = decode, side: int = SIDE) -> DataFrame:
    """Rows (entity, name, sha1, hash array<long>) of rows (entity, name, content); hash is null where the image can't be read."""
    spark = images.sparkSession
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= IMAGES:
        spark.conf.set(key, str(IMAGES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for data in batch.column(3).to_pylist():
                try:
                    found.append(average_hash(gray(decoder(data)), side).tolist())
                except (ValueError, KeyError, TypeError, zlib.error, struct.error):
                    found.append(None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.list_(pa.int64()))], names=["entity", "name", "sha1", "hash"])

    return images.select("entity", "name", F.sha1("content").alias("sha1"), "content").mapInArrow(run, "entity string, name string, sha1 string, hash array<long>")


def without_duplicates(rows: DataFrame, most: int = NEAR, side: int = SIDE) -> DataFrame:
    """Rows (entity, name, kept, reason, matched_with) of `hashed`: in order of name, what is near an image of its entity that is kept goes, exact copies named as such.

    Images that can't be read stay, copies of them too.
    """
    return firsts.kept_in_order(rows, "entity", "name", "hash", side * side // 64, most, "sha1")
