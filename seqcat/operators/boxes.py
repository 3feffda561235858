"""Annotation geometry -> uniform ``x, y, width, height`` boxes (row-local, no shuffle)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqcat import config as C

_COORD_FIELDS = ("points", "xMin", "xMax", "yMin", "yMax")


def _rect(c):
    return (F.col(f"{c}.xMin"), F.col(f"{c}.yMin"), F.col(f"{c}.xMax") - F.col(f"{c}.xMin"),
            F.col(f"{c}.yMax") - F.col(f"{c}.yMin"))


def _polygon(c):
    # ``points.x`` extracts the field of every element without a lambda (compiled, no interpreted HOF)
    xs = F.col(f"{c}.points.x")
    ys = F.col(f"{c}.points.y")
    return (F.array_min(xs), F.array_min(ys), F.array_max(xs) - F.array_min(xs), F.array_max(ys) - F.array_min(ys))


def _finish(df: DataFrame, coords: str, x, y, w, h) -> DataFrame:
    return df.withColumns({"x": x, "y": y, "width": w, "height": h}).drop(coords, *_COORD_FIELDS)


def bbox_rect(df: DataFrame, type_col: str = "type", coords: str = "coords") -> DataFrame:
    """Rectangle rows: ``x = xMin, y = yMin, width = xMax - xMin, height = yMax - yMin``."""
    return _finish(df.where(F.col(type_col) == C.ANNOTATION_RECT), coords, *_rect(coords))


def bbox_polygon(df: DataFrame, type_col: str = "type", coords: str = "coords") -> DataFrame:
    """Polygon rows: bounding box of the row's own points (``array_min``/``array_max`` of ``points.x``/``points.y``;
    no explode, join or lambda)."""
    return _finish(df.where(F.col(type_col) == C.ANNOTATION_POLYGON), coords, *_polygon(coords))


def bbox_union(df: DataFrame, type_col: str = "type", coords: str = "coords") -> DataFrame:
    """Rectangles and polygons in one pass; other annotation types are dropped."""
    t = F.col(type_col)
    kept = df.where(t.isin(C.ANNOTATION_RECT, C.ANNOTATION_POLYGON))
    r, p = _rect(coords), _polygon(coords)
    is_rect = t == C.ANNOTATION_RECT
    return _finish(kept, coords, *[F.when(is_rect, a).otherwise(b) for a, b in zip(r, p)])
