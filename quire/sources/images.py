"""Quality and enhancement of page images.

Quality is measured on gray pixels with numpy, one image at a time within Arrow batches.
Enhancement needs an image library; without one it says so.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quire.sources.ocr import NotInstalled

GOOD, MEDIUM = 0.75, 0.50
PIXELS, CONTRAST, SHARPNESS, NOISE = 2000 * 3000, 128.0, 500.0, 30.0
_BLUR = np.outer([1, 4, 6, 4, 1], [1, 4, 6, 4, 1]) / 256.0
_EDGES = np.array([[0, 1, 0], [1, -4, 1], [0, 1, 0]], float)


def read_images(spark: SparkSession, folder: str) -> DataFrame:
    """``origin, height, width, nChannels, mode, data`` of the images of a folder."""
    return spark.read.format("image").load(folder).select("image.*")


def gray(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Gray values of pixels in blue, green, red order."""
    a = np.frombuffer(data, np.uint8).reshape(height, width, channels).astype(float)
    return a[:, :, 0] if channels == 1 else np.rint(a[:, :, 0] * 0.114 + a[:, :, 1] * 0.587 + a[:, :, 2] * 0.299)


def _filtered(a: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Correlation; beyond the edges the picture is mirrored without its edge line."""
    r = kernel.shape[0] // 2
    padded = np.pad(a, [(min(r, n - 1),) * 2 for n in a.shape], "reflect")
    padded = np.pad(padded, [((r - min(r, n - 1)),) * 2 for n in a.shape], "edge")
    out = np.zeros_like(a, float)
    for i in range(kernel.shape[0]):
        for j in range(kernel.shape[1]):
            if kernel[i, j]:
                out += kernel[i, j] * padded[i : i + a.shape[0], j : j + a.shape[1]]
    return out


def quality(a: np.ndarray) -> tuple[str, float]:
    """Level and mean of four scores: resolution, contrast, sharpness, absence of noise. An empty picture is poor."""
    if a.size == 0:
        return "poor", 0.0
    a = a.astype(float)
    noise = np.abs(a - np.rint(_filtered(a, _BLUR))).mean()
    score = float(np.mean([min(1.0, a.size / PIXELS), min(1.0, a.std() / CONTRAST), min(1.0, _filtered(a, _EDGES).var() / SHARPNESS), max(0.0, 1.0 - noise / NOISE)]))
    return ("good" if score >= GOOD else "medium" if score >= MEDIUM else "poor"), score


def assess(images: DataFrame, key: str) -> DataFrame:
    """``key, level, score`` of gray images (``key, height, width, pixels array<int>``); score to three digits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [quality(np.array(p or [], float).reshape((h or 0, w or 0)) if p else np.zeros((0, 0))) for h, w, p in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r[0] for r in rows], pa.string()), pa.array([round(r[1], 3) for r in rows], pa.float64())], names=[key, "level", "score"])

    kind = images.schema[key].dataType.simpleString()
    return images.select(key, "height", "width", "pixels").mapInArrow(run, f"{key} {kind}, level string, score double")


def _cv2():
    try:
        import cv2
    except ImportError as e:
        raise NotInstalled("enhancing images needs an image library, which isn't installed") from e
    return cv2


@dataclass(frozen=True)
class Enhancer:
    """Steps of image enhancement; each takes and returns pixels."""

    denoise: bool = True
    binarize: bool = True
    deskew: bool = True
    contrast: bool = True
    factor: float = 2

    @staticmethod
    def decode(image: bytes) -> np.ndarray:
        cv2 = _cv2()
        return cv2.imdecode(np.frombuffer(image, np.uint8), cv2.IMREAD_COLOR)

    @staticmethod
    def encode(a: np.ndarray) -> bytes:
        ok, out = _cv2().imencode(".png", a)
        if not ok:
            raise ValueError("the image can't be encoded")
        return out.tobytes()

    @staticmethod
    def as_gray(a: np.ndarray) -> np.ndarray:
        cv2 = _cv2()
        return cv2.cvtColor(a, cv2.COLOR_BGR2GRAY) if a.ndim == 3 else a

    def equalized(self, a: np.ndarray) -> np.ndarray:
        return _cv2().createCLAHE(clipLimit=2.0, tileGridSize=(8, 8)).apply(self.as_gray(a))

    @staticmethod
    def smoothed(a: np.ndarray, strength: int) -> np.ndarray:
        cv2 = _cv2()
        return cv2.fastNlMeansDenoisingColored(a, None, strength, strength) if a.ndim == 3 else cv2.fastNlMeansDenoising(a, None, strength)

    @staticmethod
    def skew(angles: list[float]) -> float:
        """Median of the angles that are nearly level; 0 if it is too small to matter."""
        level = [x for x in angles if abs(x) < 15]
        middle = float(np.median(level)) if level else 0.0
        return middle if abs(middle) >= 0.5 else 0.0

    def straightened(self, a: np.ndarray) -> np.ndarray:
        cv2 = _cv2()
        found = cv2.HoughLinesP(cv2.Canny(self.as_gray(a), 50, 150), 1, np.pi / 180, 100, minLineLength=100, maxLineGap=10)
        angle = self.skew([float(np.degrees(np.arctan2(y2 - y1, x2 - x1))) for x1, y1, x2, y2 in (x[0] for x in (found if found is not None else []))])
        if not angle:
            return a
        h, w = a.shape[:2]
        turn = cv2.getRotationMatrix2D((w // 2, h // 2), angle, 1.0)
        return cv2.warpAffine(a, turn, (w, h), flags=cv2.INTER_CUBIC, borderMode=cv2.BORDER_REPLICATE)

    def two_toned(self, a: np.ndarray) -> np.ndarray:
        cv2 = _cv2()
        return cv2.adaptiveThreshold(self.as_gray(a), 255, cv2.ADAPTIVE_THRESH_GAUSSIAN_C, cv2.THRESH_BINARY, 15, 10)

    def enlarged(self, a: np.ndarray) -> np.ndarray:
        cv2 = _cv2()
        return cv2.resize(a, None, fx=self.factor, fy=self.factor, interpolation=cv2.INTER_CUBIC)

    def light(self, a: np.ndarray) -> np.ndarray:
        return self.smoothed(self.equalized(a), 5)

    def full(self, a: np.ndarray) -> np.ndarray:
        steps = [(self.factor > 1, self.enlarged), (self.contrast, self.equalized), (self.denoise, lambda x: self.smoothed(x, 10)), (self.deskew, self.straightened), (self.binarize, self.two_toned)]
        for wanted, step in steps:
            a = step(a) if wanted else a
        return a

    def process(self, image: bytes, level: str) -> bytes:
        """Good images as they are, medium ones lightly, others fully enhanced."""
        if level == "good":
            return image
        a = self.decode(image)
        return self.encode(self.light(a) if level == "medium" else self.full(a))


def enhance(images: DataFrame, enhancer: Enhancer = Enhancer()) -> DataFrame:
    """``key columns, level, image``: images that aren't good, enhanced by their level; the good ones don't enter Python."""
    keys = [c for c in images.columns if c not in ("image", "level")]
    rest = images.where("level <> 'good'").select(*keys, "level", "image")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_columns
            done = [enhancer.process(x, level) for level, x in zip(batch.column(n - 2).to_pylist(), batch.column(n - 1).to_pylist())]
            yield batch.set_column(n - 1, "image", pa.array(done, pa.binary()))

    return images.where("level = 'good'").select(*keys, "level", "image").unionByName(rest.mapInArrow(run, rest.schema))
