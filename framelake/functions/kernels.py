"""Pixel kernels on row-major gray frames (arrays of integers), as SQL expressions over a dialect. All sums are of whole
numbers below 2^53, so they are exact. Borders reflect without repeating the edge pixel."""

from __future__ import annotations

from framelake.plans.dialect import Spark


def _px(d: Spark, px: str, w: int, h: int, dr: int, dc: int) -> str:
    """The pixel dr rows and dc columns from pixel i."""
    row, col = d.idiv("i", str(w)), f"(i % {w})"
    for what, by, most in (("row", dr, h), ("col", dc, w)):
        at = row if what == "row" else col
        if by < 0:
            at = f"abs({at} - 1)"
        elif by > 0:
            at = f"({most - 1} - abs({most - 2} - {at}))"
        if what == "row":
            row = at
        else:
            col = at
    return d.at(px, f"{row} * {w} + {col}")


def _cells(d: Spark, w: int, h: int, expr: str) -> str:
    return d.map(d.seq("0", str(w * h - 1)), "i", f"CAST({expr} AS DOUBLE)")


def laplacian(d: Spark, px: str = "px", w: int = 8, h: int = 8) -> str:
    """The 4-neighbour Laplacian of each pixel."""
    p = lambda r, c: _px(d, px, w, h, r, c)
    return _cells(d, w, h, f"{p(-1, 0)} + {p(1, 0)} + {p(0, -1)} + {p(0, 1)} - 4 * {p(0, 0)}")


def gradient(d: Spark, px: str = "px", w: int = 8, h: int = 8) -> str:
    """Squared length of the 3 x 3 Sobel gradient of each pixel."""
    p = lambda r, c: _px(d, px, w, h, r, c)
    gx = f"({p(-1, 1)} + 2 * {p(0, 1)} + {p(1, 1)} - {p(-1, -1)} - 2 * {p(0, -1)} - {p(1, -1)})"
    gy = f"({p(1, -1)} + 2 * {p(1, 0)} + {p(1, 1)} - {p(-1, -1)} - 2 * {p(-1, 0)} - {p(-1, 1)})"
    return _cells(d, w, h, f"{gx} * {gx} + {gy} * {gy}")


def variance(d: Spark, arr: str) -> str:
    """Population variance of an array of whole numbers."""
    n, s, q = d.size(arr), d.sum(arr), d.sum(d.map(arr, "q_", "q_ * q_"))
    return f"(({q}) / {n} - (({s}) / {n}) * (({s}) / {n}))"


def mean(d: Spark, arr: str) -> str:
    return f"({d.sum(arr)} / {d.size(arr)})"


def doubles(d: Spark, px: str = "px") -> str:
    return d.map(px, "z_", "CAST(z_ AS DOUBLE)")


def share(d: Spark, px: str, when: str) -> str:
    """Share of pixels z_ for which `when` holds."""
    return f"(CAST({d.size(d.keep(px, 'z_', when))} AS DOUBLE) / {d.size(px)})"


def percentile(d: Spark, px: str, p: float) -> str:
    """Linear interpolation in the sorted pixels."""
    s, at = d.sort(px), f"(CAST({p} AS DOUBLE) * ({d.size(px)} - 1))"
    low, high = d.at(s, f"floor({at})"), d.at(s, f"ceil({at})")
    return f"({low} + ({high} - {low}) * ({at} - floor({at})))"


def entropy(d: Spark, px: str = "px") -> str:
    """Bits of the histogram of values."""
    p = f"(CAST({d.size(d.keep(px, 'y_', 'y_ = v_'))} AS DOUBLE) / {d.size(px)})"
    return f"(- {d.sum(d.map(d.distinct(px), 'v_', f'{p} * log2({p})'))})"


def moment(d: Spark, px: str, w: int, h: int, axis: str) -> str:
    """Centroid of brightness along x or y; the middle if all is black."""
    at = f"(i % {w})" if axis == "x" else d.idiv("i", str(w))
    s = d.sum(d.map(d.seq("0", str(w * h - 1)), "i", f"CAST({d.at(px, 'i')} * {at} AS DOUBLE)"))
    total = d.sum(doubles(d, px))
    return f"CASE WHEN {total} = 0 THEN CAST({((w if axis == 'x' else h) - 1) / 2} AS DOUBLE) ELSE {s} / {total} END"
