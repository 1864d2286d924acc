"""Page images made ready for reading: white margins cut off, contrast evened by tiles, noise smoothed, black and white by a local threshold.

Rows of images become rows of images, one at a time in the tasks that read them; pages are portable gray maps on their way out. An image that
can't be decoded gives a row with an error and no content.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sonde.operators.images import IMAGES, Decoder, decode, gray

# What counts as white, the least share of darker pixels in a row or column, and the margin left.
WHITE, SHARE, FEWEST, MARGIN = 245, 0.001, 5, 8
# Tiles each way and the limit of a level's share, the window and offset of the threshold.
TILES, LIMIT = 8, 2.0
WINDOW, OFFSET = 31, 15
KEPT = "entity string, name string, x int, y int, width int, height int, content binary, error string"


def box(g: np.ndarray, white: int = WHITE, share: float = SHARE, margin: int = MARGIN) -> tuple[int, int, int, int]:
    """(x, y, width, height) of what isn't white margin: between the outer rows and columns with enough darker pixels, and a margin; all of an empty page.

    Sums of rows and columns are differences of one summed-area table.
    """
    height, width = g.shape
    area = np.pad((g < white).astype(np.int64).cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    rows = np.flatnonzero(np.diff(area[:, -1]) >= max(FEWEST, round(width * share)))
    cols = np.flatnonzero(np.diff(area[-1]) >= max(FEWEST, round(height * share)))
    if not len(rows) or not len(cols):
        return 0, 0, width, height
    y, x = max(0, int(rows[0]) - margin), max(0, int(cols[0]) - margin)
    return x, y, min(width - 1, int(cols[-1]) + margin) - x + 1, min(height - 1, int(rows[-1]) + margin) - y + 1


def tile_levels(tile: np.ndarray, limit: float = LIMIT) -> np.ndarray:
    """The new level of each of 256: by the tile's histogram, in which no level counts more than `limit` times the mean; what is cut goes to all alike."""
    n = np.bincount(tile.ravel(), minlength=256)
    most = max(1, int(limit * tile.size / 256))
    over = int(np.maximum(n - most, 0).sum())
    n = np.minimum(n, most) + over // 256
    rest = over % 256
    if rest:
        n[np.arange(rest) * max(256 // rest, 1)] += 1
    return np.clip(np.rint(n.cumsum() * np.float32(255 / tile.size)), 0, 255)


def evened(g: np.ndarray, tiles: int = TILES, limit: float = LIMIT) -> np.ndarray:
    """Contrast by tiles: a pixel's level is interpolated between those that the four nearest tiles give it. Edges are mirrored to whole tiles."""
    height, width = g.shape
    wide = np.pad(g, ((0, -height % tiles), (0, -width % tiles)), mode="reflect")
    th, tw = wide.shape[0] // tiles, wide.shape[1] // tiles
    levels = np.array([[tile_levels(wide[i * th : (i + 1) * th, j * tw : (j + 1) * tw], limit) for j in range(tiles)] for i in range(tiles)])

    def between(n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.arange(n) / size - 0.5
        low = np.floor(at).astype(int)
        return np.clip(low, 0, tiles - 1), np.clip(low + 1, 0, tiles - 1), at - low

    y0, y1, fy = between(height, th)
    x0, x1, fx = between(width, tw)
    of = lambda y, x: levels[y[:, None], x[None, :], g]
    top, low = of(y0, x0) * (1 - fx) + of(y0, x1) * fx, of(y1, x0) * (1 - fx) + of(y1, x1) * fx
    return np.clip(np.rint(top * (1 - fy[:, None]) + low * fy[:, None]), 0, 255).astype(np.uint8)


def filtered(g: np.ndarray, kernel: np.ndarray, mode: str) -> np.ndarray:
    """Weighted sums over rows, then over columns."""
    half = len(kernel) // 2
    wide = np.pad(g.astype(float), half, mode=mode)
    rows = sum(w * wide[:, i : i + g.shape[1]] for i, w in enumerate(kernel))
    return sum(w * rows[i : i + g.shape[0]] for i, w in enumerate(kernel))


def smoothed(g: np.ndarray) -> np.ndarray:
    return np.floor(filtered(g, np.array([1, 2, 1]) / 4, "reflect") + 0.5).astype(np.uint8)


def sharpened(g: np.ndarray) -> np.ndarray:
    w = np.pad(g.astype(int), 1, mode="reflect")
    return np.clip(5 * w[1:-1, 1:-1] - w[:-2, 1:-1] - w[2:, 1:-1] - w[1:-1, :-2] - w[1:-1, 2:], 0, 255).astype(np.uint8)


def local_threshold(g: np.ndarray, window: int = WINDOW, offset: int = OFFSET) -> np.ndarray:
    """255 where a pixel is above the bell-weighted mean of its window less the offset, else 0; edges are repeated."""
    sigma = 0.3 * ((window - 1) * 0.5 - 1) + 0.8
    bell = np.exp(-((np.arange(window) - window // 2) ** 2) / (2 * sigma * sigma))
    mean = np.clip(np.rint(filtered(g, bell / bell.sum(), "edge")), 0, 255)
    return np.where(g > mean - offset, 255, 0).astype(np.uint8)


def split_threshold(g: np.ndarray) -> np.ndarray:
    """255 above the level that parts the histogram into the two classes furthest apart, else 0."""
    n = np.bincount(g.ravel(), minlength=256).astype(float)
    below, sums = np.cumsum(n), np.cumsum(n * np.arange(256))
    above = below[-1] - below
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = below * above * (sums / below - (sums[-1] - sums) / above) ** 2
    return np.where(g > int(np.nan_to_num(apart).argmax()), 255, 0).astype(np.uint8)


def stretched(g: np.ndarray) -> np.ndarray:
    low, high = int(g.min()), int(g.max())
    return np.rint((g.astype(float) - low) * (255 / (high - low))).astype(np.uint8) if high > low else np.zeros_like(g)


def portable(g: np.ndarray) -> bytes:
    return b"P5\n%d %d\n255\n" % (g.shape[1], g.shape[0]) + g.tobytes()


def _each(images: DataFrame, decoder: Decoder, step: Callable[[np.ndarray], tuple[tuple[int, int, int, int], np.ndarray]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), IMAGES):  # what comes out isn't larger than some images either
                out = []
                for entity, name, data in zip(*(c.slice(low, IMAGES) for c in batch.columns), strict=True):
                    try:
                        where, g = step(gray(decoder(data.as_py())))
                        out.append((entity.as_py(), name.as_py(), *where, portable(g), None))
                    except (ValueError, KeyError, TypeError, IndexError, zlib.error, struct.error) as e:
                        out.append((entity.as_py(), name.as_py(), None, None, None, None, None, str(e)))
                kinds = [pa.string(), pa.string(), *[pa.int32()] * 4, pa.binary(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["entity", "name", "x", "y", "width", "height", "content", "error"])

    return images.select("entity", "name", "content").mapInArrow(run, KEPT)


def cropped(images: DataFrame, decoder: Decoder = decode, white: int = WHITE, share: float = SHARE, margin: int = MARGIN) -> DataFrame:
    """Rows (entity, name, x, y, width, height, content, error) of images (entity, name, content): the part within white margins, in gray."""
    def step(g: np.ndarray) -> tuple[tuple[int, int, int, int], np.ndarray]:
        x, y, width, height = box(g, white, share, margin)
        return (x, y, width, height), g[y : y + height, x : x + width]

    return _each(images, decoder, step)


def prepared(images: DataFrame, decoder: Decoder = decode, threshold: str = "adaptive", even: bool = True, smooth: bool = True, sharpen: bool = False, crop: bool = True) -> DataFrame:
    """Rows as of `cropped`, made ready for reading: contrast by tiles (or stretched), smoothed, sharpened, then black and white: adaptive, otsu or none."""
    finish = {"adaptive": local_threshold, "otsu": split_threshold, "none": lambda g: g}
    if threshold not in finish:
        raise ValueError(f"threshold: one of {', '.join(finish)}")

    def step(g: np.ndarray) -> tuple[tuple[int, int, int, int], np.ndarray]:
        x, y, width, height = box(g) if crop else (0, 0, g.shape[1], g.shape[0])
        g = g[y : y + height, x : x + width]
        g = evened(g) if even else stretched(g)
        g = smoothed(g) if smooth else g
        return (x, y, width, height), finish[threshold](sharpened(g) if sharpen else g)

    return _each(images, decoder, step)
