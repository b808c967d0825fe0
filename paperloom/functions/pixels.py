"""Pixel kernels: small numpy helpers applied to Arrow batches of rasters.

The rest of the raster work is column expressions.  These three loops over pixels are the exception
because array lambdas run interpreted, at some microseconds per pixel, where a vectorised pass takes
nanoseconds; Spark still partitions the rasters and every kernel sees one raster at a time.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.constants import DARK_BELOW

# kernels travel to the workers by value, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BOX = ("left", "top", "right", "bottom")
TRIM = T.StructType([T.StructField(name, T.IntegerType()) for name in BOX])
MEASURES = T.StructType(
    [T.StructField(name, T.IntegerType()) for name in ("width", "height")]
    + [T.StructField(name, T.DoubleType()) for name in ("dark_ratio", "contrast")]
    + [T.StructField(name, T.IntegerType()) for name in BOX]
    + [T.StructField(f"edge_{name}", T.DoubleType()) for name in ("left", "right", "top", "bottom")]
)


def _grid(pixels, width, height) -> np.ndarray:
    return np.asarray(pixels, dtype=np.int32).reshape(int(height), int(width))


def _wrapped_laplacian(grid: np.ndarray) -> float:
    """With wrap-around every pixel is added as often as subtracted, so the mean is zero and the
    variance is the mean square."""
    around = sum(np.roll(grid, step, axis) for axis in (0, 1) for step in (1, -1))
    edges = (around - 4 * grid).astype(np.float64)
    return float(np.mean(edges * edges))


def _measure(grid: np.ndarray) -> tuple:
    height, width = grid.shape
    dark = grid < DARK_BELOW
    rows, columns = np.flatnonzero(dark.any(axis=1)), np.flatnonzero(dark.any(axis=0))
    box = (columns[0], rows[0], columns[-1], rows[-1]) if rows.size else (None,) * 4
    band = max(1, min(width, height) // 12)
    sides = (dark[:, :band], dark[:, width - band:], dark[:band], dark[height - band:])
    return (width, height, dark.mean(), grid.std(), *box, *(side.mean() for side in sides))


def _trim(grid: np.ndarray, dense: float, share: float) -> tuple[int, int, int, int]:
    """Dense lines in a row from each side (left, top, right, bottom), up to a share of the side."""
    dark = grid < DARK_BELOW
    by_column, by_row = dark.mean(axis=0), dark.mean(axis=1)

    def run(ratios: np.ndarray) -> int:
        sparse = ratios[: int(len(ratios) * share)] < dense
        return int(sparse.argmax()) if sparse.any() else len(sparse)

    return run(by_column), run(by_row), run(by_column[::-1]), run(by_row[::-1])


@F.pandas_udf(T.DoubleType())
def laplacian_variance(pixels: pd.Series, width: pd.Series, height: pd.Series) -> pd.Series:
    scores = [None if p is None else _wrapped_laplacian(_grid(p, w, h)) for p, w, h in zip(pixels, width, height)]
    return pd.Series(scores, dtype="Float64")


def _dark_ratios(grid: np.ndarray, boxes) -> list[float]:
    """Share of dark pixels in each box (left, top, right, bottom), given one after another."""
    dark = grid < DARK_BELOW
    return [float(dark[top:bottom, left:right].mean()) for left, top, right, bottom in np.asarray(boxes, dtype=np.int64).reshape(-1, 4)]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def dark_ratios(pixels: pd.Series, width: pd.Series, height: pd.Series, boxes: pd.Series) -> pd.Series:
    return pd.Series([
        None if p is None or b is None else _dark_ratios(_grid(p, w, h), b) for p, w, h, b in zip(pixels, width, height, boxes)
    ], dtype=object)


#: Pixels that are measured at once.
STACKED = 1 << 20


def _page_measures(grids: np.ndarray, boxes) -> list[tuple[float, list[float]]]:
    """Blur and dark shares of pages of one shape and the same boxes; sums are of whole numbers, so exact in any order."""
    pages, height, width = grids.shape
    around = sum(np.roll(grids, step, axis) for axis in (1, 2) for step in (1, -1))
    edges = (around - 4 * grids).reshape(pages, -1).astype(np.float64)
    blurs = np.einsum("ij,ij->i", edges, edges) / (height * width)
    dark = grids < DARK_BELOW
    ratios = [dark[:, top:bottom, left:right].reshape(pages, -1).mean(axis=1) for left, top, right, bottom in np.asarray(boxes, dtype=np.int64).reshape(-1, 4)]
    return list(zip(blurs.tolist(), np.stack(ratios, axis=1).tolist() if ratios else [[] for _ in range(pages)]))


@F.pandas_udf(T.StructType([T.StructField("blur_score", T.DoubleType()), T.StructField("ratios", T.ArrayType(T.DoubleType()))]))
def page_measures(pixels: pd.Series, width: pd.Series, height: pd.Series, boxes: pd.Series) -> pd.DataFrame:
    """Blur and dark shares of a page in one pass over its pixels; pages of one shape are measured together."""
    rows, alike = [(None, None)] * len(pixels), {}
    pixels, boxes = pixels.to_list(), boxes.to_list()
    for i, (p, w, h) in enumerate(zip(pixels, width, height)):
        if p is not None:
            alike.setdefault((int(h), int(w), np.asarray(boxes[i], dtype=np.int64).tobytes()), []).append(i)
    for (h, w, _), places in alike.items():
        step = max(1, STACKED // max(1, h * w))
        for start in range(0, len(places), step):
            some = places[start:start + step]
            grids = np.stack([np.asarray(pixels[i], dtype=np.int32).reshape(h, w) for i in some])
            for i, found in zip(some, _page_measures(grids, boxes[some[0]])):
                rows[i] = found
    frame = pd.DataFrame(rows, columns=["blur_score", "ratios"])
    frame["blur_score"] = frame["blur_score"].astype("Float64")
    return frame


@F.pandas_udf(MEASURES)
def measure(pixels: pd.Series, width: pd.Series, height: pd.Series) -> pd.DataFrame:
    rows = [_measure(_grid(p, w, h)) for p, w, h in zip(pixels, width, height)]
    frame = pd.DataFrame(rows, columns=MEASURES.names)
    frame[list(BOX)] = frame[list(BOX)].astype("Int32")
    return frame


def trimmer(dense: float, share: float):
    @F.pandas_udf(TRIM)
    def trim(pixels: pd.Series, width: pd.Series, height: pd.Series) -> pd.DataFrame:
        rows = [_trim(_grid(p, w, h), dense, share) for p, w, h in zip(pixels, width, height)]
        return pd.DataFrame(rows, columns=TRIM.names)

    return trim


def trim_passes(dense: float, share: float, least_width: int, least_height: int, passes: int):
    """Repeated trimming: the cumulative cut and the measures after each pass that still trims and
    stays large enough.  Rows with null pixels give an empty list."""

    def follow(grid: np.ndarray) -> list[dict]:
        steps, cut = [], np.zeros(4, dtype=int)
        for _ in range(passes):
            left, top, right, bottom = step = _trim(grid, dense, share)
            height, width = grid.shape
            if not any(step) or width - left - right < least_width or height - top - bottom < least_height:
                break
            grid = grid[top: height - bottom, left: width - right]
            cut = cut + step
            measured = dict(zip(MEASURES.names, (None if v is None else v.item() if hasattr(v, "item") else v for v in _measure(grid))))
            steps.append({"cut": dict(zip(TRIM.names, cut.tolist())), "m": measured})
        return steps

    @F.pandas_udf(T.ArrayType(T.StructType([T.StructField("cut", TRIM), T.StructField("m", MEASURES)])))
    def passes_of(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for pixels, width, height in batches:
            yield pd.Series([[] if p is None else follow(_grid(p, w, h)) for p, w, h in zip(pixels, width, height)])

    return passes_of
