"""Page image clean-up: numpy kernels, fused into one Arrow pass over (doc_id, height, width, channels, data).

Each kernel takes and returns an array (height x width, or x 3 for RGB) with whether it changed something and a warning.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

Step = tuple[np.ndarray, bool, str | None]
#: The chain's steps and their parameters.
CHAIN = (("grayscale", {}), ("crop_to_content", {"threshold": 235, "margin": 16}), ("deskew", {"max_angle": 5.0, "min_angle": 3.0}), ("resize", {"max_width": 2480, "max_height": 3508}), ("normalize_to_a4", {"dpi": 300}), ("denoise", {"strength": "medium"}), ("contrast", {}), ("adaptive_binarization", {"window": 35, "offset": 10}))
STRENGTHS = {"low": 3, "medium": 5, "high": 7}
SCHEMA = "doc_id string, height int, width int, channels int, data binary, steps array<struct<step: string, applied: boolean, warning: string, elapsed_seconds: double>>"


def luma(a: np.ndarray) -> np.ndarray:
    """ITU-R 601 brightness in integers."""
    if a.ndim == 2:
        return a
    r, g, b = (a[..., i].astype(np.uint32) for i in range(3))
    return ((19595 * r + 38470 * g + 7471 * b + 32768) >> 16).astype(np.uint8)


def grayscale(a: np.ndarray) -> Step:
    return luma(a), a.ndim == 3, None


def _box(mask: np.ndarray) -> tuple[int, int, int, int] | None:
    """Left, top, right and bottom (exclusive) of what is true."""
    rows, columns = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
    return (int(columns[0]), int(rows[0]), int(columns[-1]) + 1, int(rows[-1]) + 1) if len(rows) else None


def crop_to_content(a: np.ndarray, threshold: int = 240, margin: int = 10) -> Step:
    box = _box(luma(a) < threshold)
    if box is None:
        return a, False, None
    h, w = a.shape[:2]
    l, t, r, b = max(0, box[0] - margin), max(0, box[1] - margin), min(w, box[2] + margin), min(h, box[3] + margin)
    return a[t:b, l:r], (l, t, r, b) != (0, 0, w, h), None


def regression_angle(gray: np.ndarray, max_angle: float) -> float | None:
    """Slope of the middle of dark pixels over sampled columns, in degrees."""
    h, w = gray.shape
    dark = gray < 240
    points = []
    for x in np.unique(np.linspace(0, w - 1, max(16, w // 40)).astype(int)):
        y = np.flatnonzero(dark[:, x])
        if len(y):
            points.append((x, (y[0] + y[-1]) / 2))
    if len(points) < 8:
        return None
    x, y = np.array(points, dtype=float).T
    spread = ((x - x.mean()) ** 2).sum()
    slope = ((x - x.mean()) * (y - y.mean())).sum() / spread if spread else 0.0
    return float(np.clip(np.degrees(np.arctan(slope)), -max_angle, max_angle))


def otsu(gray: np.ndarray) -> int:
    """The brightness that parts dark from light with the largest variance between them."""
    n = np.bincount(gray.ravel(), minlength=256).astype(float)
    below, total = n.cumsum(), (n * np.arange(256)).cumsum()
    with np.errstate(divide="ignore", invalid="ignore"):
        between = (total[-1] * below / below[-1] - total) ** 2 / (below * (below[-1] - below))
    return int(np.nanargmax(np.where(np.isfinite(between), between, -1)))


def hough_angle(gray: np.ndarray, max_angle: float, step: float = 0.1, most: int = 200_000) -> float | None:
    """The upper median angle of the strongest lines through the lower edges of dark areas, within max_angle + 1 degrees."""
    small = gray[:: max(1, gray.shape[0] // 1200), :: max(1, gray.shape[0] // 1200)]
    dark = small <= otsu(small)
    y, x = np.nonzero(dark[:-1] & ~dark[1:])
    if len(x) < 8:
        return None
    x, y = x[:: -(-len(x) // most)].astype(float), y[:: -(-len(x) // most)].astype(float)
    angles = np.arange(-max_angle - 1, max_angle + 1 + step / 2, step)
    peaks = [np.bincount(np.rint(y - x * np.tan(np.radians(t)) + small.shape[1]).astype(int)).max() for t in angles]
    found = angles[np.array(peaks) >= 0.9 * max(peaks)]
    return float(np.clip(np.sort(found)[len(found) // 2], -max_angle, max_angle))


def rectangle_angle(gray: np.ndarray) -> float | None:
    """The angle, within 45 degrees, of the smallest rectangle around all pixels that aren't white."""
    mask = gray < 255
    rows = np.flatnonzero(mask.any(axis=1))
    if len(rows) < 2:
        return None
    left, right = mask[rows].argmax(axis=1), mask.shape[1] - 1 - mask[rows, ::-1].argmax(axis=1)
    points = sorted({(int(a), int(b)) for a, b in zip(np.r_[left, right], np.r_[rows, rows], strict=True)})

    def chain(points: list[tuple[int, int]]) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for p in points:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]

    hull = np.array(chain(points) + chain(points[::-1]), dtype=float)
    if len(hull) < 3:
        return None
    edges = np.roll(hull, -1, axis=0) - hull
    best = None
    for t in np.unique(np.arctan2(edges[:, 1], edges[:, 0]) % (np.pi / 2)):
        along, across = hull @ [np.cos(t), np.sin(t)], hull @ [-np.sin(t), np.cos(t)]
        area = np.ptp(along) * np.ptp(across)
        if best is None or area < best[0]:
            best = (area, t)
    angle = float(np.degrees(best[1]))
    return angle - 90 if angle > 45 else angle


def rotate(a: np.ndarray, angle: float, fill: int = 255) -> np.ndarray:
    """Turned about the middle, by inverse bicubic sampling in bands, which bound the memory."""
    h, w = a.shape[:2]
    t = np.radians(angle)
    cy, cx = (h - 1) / 2, (w - 1) / 2
    out = np.empty_like(a)
    for top in range(0, h, 256):
        y, x = np.mgrid[top : min(h, top + 256), 0:w].astype(np.float32)
        out[top : top + 256] = sample(a, np.cos(t) * (x - cx) - np.sin(t) * (y - cy) + cx, np.sin(t) * (x - cx) + np.cos(t) * (y - cy) + cy, fill)
    return out


def cubic(d: np.ndarray) -> np.ndarray:
    """The cubic convolution kernel with slope -1/2."""
    d = np.abs(d)
    return np.where(d < 1, (1.5 * d - 2.5) * d * d + 1, np.where(d < 2, ((-0.5 * d + 2.5) * d - 4) * d + 2, 0.0)).astype(np.float32)


def sample(a: np.ndarray, x: np.ndarray, y: np.ndarray, fill: int) -> np.ndarray:
    """Bicubic values at places; fill outside."""
    h, w = a.shape[:2]
    x0, y0 = np.floor(x).astype(np.int32), np.floor(y).astype(np.int32)
    out = np.zeros((*x.shape, *a.shape[2:]), np.float32)
    for j in range(-1, 3):
        row, wy = np.clip(y0 + j, 0, h - 1), cubic(y - (y0 + j))
        for i in range(-1, 3):
            weight = wy * cubic(x - (x0 + i))
            out += (weight if a.ndim == 2 else weight[..., None]) * a[row, np.clip(x0 + i, 0, w - 1)]
    out[(x < 0) | (y < 0) | (x > w - 1) | (y > h - 1)] = fill
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def _along(a: np.ndarray, size: int) -> np.ndarray:
    """The first axis brought to a size by a cubic kernel, wider when it shrinks."""
    scale = a.shape[0] / size
    wide = max(scale, 1.0)
    middle = (np.arange(size) + 0.5) * scale - 0.5
    first = np.ceil(middle - 2 * wide).astype(int)
    taps = range(int(np.floor(4 * wide)) + 1)
    weights = np.stack([cubic((first + k - middle) / wide) * ((first + k >= 0) & (first + k < a.shape[0])) for k in taps])
    weights /= weights.sum(axis=0)
    out = np.zeros((size, *a.shape[1:]), np.float32)
    for k in taps:
        out += weights[k].reshape(-1, *[1] * (a.ndim - 1)) * a[np.clip(first + k, 0, a.shape[0] - 1)]
    return out


def candidate_angles(gray: np.ndarray, max_angle: float) -> list[float]:
    """What regression, lines and the smallest rectangle say of the skew."""
    return [x for x in (regression_angle(gray, max_angle), hough_angle(gray, max_angle), rectangle_angle(gray)) if x is not None]


def deskew(a: np.ndarray, max_angle: float = 5.0, min_angle: float = 1.0) -> Step:
    gray = luma(a)
    box = _box(gray < 240)
    if box is None:
        return a, False, "no content to deskew"
    if (box[2] - box[0]) * (box[3] - box[1]) < 0.3 * gray.size:
        return a, False, "content covers too little of the page"
    angle = min(candidate_angles(gray, max_angle), key=abs, default=None)
    if angle is None or abs(angle) < max(min_angle, 0.1):
        return a, False, "angle too small" if angle is not None else "no angle found"
    return rotate(a, float(np.clip(angle, -max_angle, max_angle))), True, None


def _resized(a: np.ndarray, width: int, height: int) -> np.ndarray:
    out = _along(np.swapaxes(_along(a, height), 0, 1), width)
    return np.clip(np.rint(np.swapaxes(out, 0, 1)), 0, 255).astype(np.uint8)


def resize(a: np.ndarray, max_width: int, max_height: int) -> Step:
    h, w = a.shape[:2]
    if max_width <= 0 or max_height <= 0 or (ratio := min(max_width / w, max_height / h, 1.0)) >= 0.999:
        return a, False, None
    return _resized(a, max(1, int(w * ratio)), max(1, int(h * ratio))), True, None


def a4_size(dpi: int) -> tuple[int, int]:
    return round(8.27 * dpi), round(11.69 * dpi)


def normalize_to_a4(a: np.ndarray, dpi: int = 300, enabled: bool = True) -> Step:
    if not enabled or dpi <= 0 or a.shape[1::-1] == a4_size(dpi):
        return a, False, None
    return _resized(a, *a4_size(dpi)), True, None


def denoise(a: np.ndarray, strength: str = "medium") -> Step:
    """Median filter of the strength's size."""
    size = STRENGTHS.get(strength, 5) | 1
    pad = size // 2
    wide = np.pad(a, [(pad, pad), (pad, pad)] + [(0, 0)] * (a.ndim - 2), mode="edge")
    out = np.empty_like(a)
    for top in range(0, a.shape[0], 128):  # bands bound the memory
        rows = wide[top : top + 128 + 2 * pad]
        views = np.lib.stride_tricks.sliding_window_view(rows, (size, size), axis=(0, 1))
        out[top : top + 128] = np.median(views, axis=(-2, -1)).astype(np.uint8)
    return out, True, None


def contrast(a: np.ndarray, factor: float = 1.2) -> Step:
    mean = int(luma(a).mean() + 0.5)
    return np.clip(mean + (a.astype(float) - mean) * factor, 0, 255).astype(np.uint8), True, None


def gaussian_mean(gray: np.ndarray, window: int) -> np.ndarray:
    """Means under a Gaussian window of odd size, edges repeated."""
    half = window // 2
    weights = np.exp(-(np.arange(-half, half + 1) ** 2) / (2 * (0.3 * ((window - 1) * 0.5 - 1) + 0.8) ** 2)).astype(np.float32)
    weights /= weights.sum()
    out = gray.astype(np.float32)
    for axis in (0, 1):
        wide = np.pad(out, [(half, half) if k == axis else (0, 0) for k in (0, 1)], mode="edge")
        out = sum(w * (wide[k : k + gray.shape[0]] if axis == 0 else wide[:, k : k + gray.shape[1]]) for k, w in enumerate(weights))
    return out


def adaptive_binarization(a: np.ndarray, window: int = 35, offset: int = 10, local: bool = False) -> Step:
    """Black and white about the blurred page's mean, less an offset; with local about each place's Gaussian mean."""
    if window < 3:
        return a, False, None
    gray = luma(a)
    if local:
        return np.where(gray > gaussian_mean(gray, window | 1) - offset, 255, 0).astype(np.uint8), True, None
    k = max(1, (window | 1) // 4)
    wide = np.pad(gray.astype(np.int64), k, mode="edge")
    sums = np.pad(wide.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    side = 2 * k + 1
    blurred = (sums[side:, side:] - sums[:-side, side:] - sums[side:, :-side] + sums[:-side, :-side]) / side**2
    return np.where(gray > blurred.mean() - offset, 255, 0).astype(np.uint8), True, None


KERNELS: dict[str, Callable[..., Step]] = {f.__name__: f for f in (grayscale, crop_to_content, deskew, resize, normalize_to_a4, denoise, contrast, adaptive_binarization)}


def run_chain(a: np.ndarray, chain=CHAIN) -> tuple[np.ndarray, list[dict]]:
    steps = []
    for name, options in chain:
        began = time.perf_counter()
        a, applied, warning = KERNELS[name](a, **options)
        steps.append({"step": name, "applied": bool(applied), "warning": warning, "elapsed_seconds": time.perf_counter() - began})
    return a, steps


def preprocess(images: DataFrame, chain=CHAIN, independent: bool = False) -> DataFrame:
    """SCHEMA rows: the chain's result for each image, or with independent=True one row for each step on the source."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                if r.data is None:
                    yield pd.DataFrame([{"doc_id": r.doc_id, "height": None, "width": None, "channels": None, "data": None, "steps": [{"step": "load", "applied": False, "warning": "not an image", "elapsed_seconds": 0.0}]}])
                    continue
                shape = (r.height, r.width) if r.channels == 1 else (r.height, r.width, r.channels)
                source = np.frombuffer(r.data, np.uint8).reshape(shape)[..., :3] if r.channels > 1 else np.frombuffer(r.data, np.uint8).reshape(shape)
                for part in [(s,) for s in chain] if independent else [chain]:
                    a, steps = run_chain(source, part)
                    yield pd.DataFrame([{"doc_id": r.doc_id, "height": a.shape[0], "width": a.shape[1], "channels": 1 if a.ndim == 2 else 3, "data": a.tobytes(), "steps": steps}])

    return images.select("doc_id", "height", "width", "channels", "data").mapInPandas(run, SCHEMA)


def png(a: np.ndarray, dpi: int = 0) -> bytes:
    """The bytes of a PNG file, with its resolution if dpi is above 0."""
    import struct
    import zlib

    h, w = a.shape[:2]
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    lines = np.concatenate([np.zeros((h, 1), np.uint8), a.reshape(h, -1)], axis=1).tobytes()
    size = chunk(b"pHYs", struct.pack(">IIB", *[round(dpi / 0.0254)] * 2, 1)) if dpi > 0 else b""
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0 if a.ndim == 2 else 2, 0, 0, 0)) + size + chunk(b"IDAT", zlib.compress(lines, 6)) + chunk(b"IEND", b"")


def png_files(done: DataFrame, dpi: int = 0) -> DataFrame:
    """name (stem, two underscores, the last step) and content of a PNG file for each row of preprocess that has an image."""
    from pyspark.sql import functions as F

    @F.pandas_udf("binary")
    def encode(height: pd.Series, width: pd.Series, channels: pd.Series, data: pd.Series) -> pd.Series:
        return pd.Series([png(np.frombuffer(d, np.uint8).reshape((h, w) if c == 1 else (h, w, c)), dpi) for h, w, c, d in zip(height, width, channels, data, strict=True)])

    stem = F.regexp_replace(F.element_at(F.split("doc_id", "/"), -1), r"\.[^.]*$", "")
    found = done.filter("data is not null")
    return found.select(F.concat(stem, F.lit("__"), F.element_at("steps", -1)["step"], F.lit(".png")).alias("name"), encode("height", "width", "channels", "data").alias("content"))


def applied_steps(docs: DataFrame) -> DataFrame:
    """The names of the steps that changed something, and all warnings."""
    from pyspark.sql import functions as F

    return docs.withColumns({"applied": F.transform(F.filter("steps", lambda s: s["applied"]), lambda s: s["step"]), "warnings": F.filter(F.transform("steps", lambda s: s["warning"]), lambda w: w.isNotNull())})
