"""Vector column builders and the NumPy kernels behind the quantiser."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def l2_normalize(c: Column | str, floor: float = 1e-12) -> Column:
    c = _col(c)
    norm = F.greatest(F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x)), F.lit(floor))
    return F.transform(c, lambda x: x / norm)


def codebook_from_sums(sums: Column | str, usage: Column | str, epsilon: float = 1e-5) -> Column:
    """Codeword = accumulated sum / max(usage, epsilon)."""
    size = F.greatest(_col(usage).cast("double"), F.lit(epsilon))
    return F.transform(_col(sums), lambda x: x / size)


def log_softmax_at(logits: Column | str, label: Column | str) -> Column:
    """Log-softmax at one label, shifted by the maximum so large logits do not overflow."""
    logits = _col(logits)
    top = F.array_max(logits)
    total = F.aggregate(logits, F.lit(0.0), lambda s, x: s + F.exp(x - top))
    return F.get(logits, _col(label).cast("int")) - top - F.log(total)


def log_sigmoid(z: Column) -> Column:
    """min(z, 0) - log1p(exp(-|z|)): finite for every finite z."""
    return F.least(z, F.lit(0.0)) - F.log1p(F.exp(-F.abs(z)))


# ---------------------------------------------------------------- kernels used inside Arrow functions


def nearest_rows(x: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the closest word for every row of ``x``; ties go to the lowest index.

    A matrix product ranks the words. Words within rounding of the best are measured again by direct
    differences, so equal distances really compare equal.
    """
    best = np.empty(len(x), np.int64)
    dist = np.empty(len(x), np.float64)
    norms = (words * words).sum(1)
    step = max(1, (1 << 22) // max(1, len(words)))
    for lo in range(0, len(x), step):
        part = x[lo : lo + step]
        own = (part * part).sum(1)
        rough = own[:, None] - 2.0 * (part @ words.T) + norms
        slack = 1e-9 * (own + norms.max() + 1.0)
        near = rough <= (rough.min(1) + slack)[:, None]
        pick = near.argmax(1)
        for r in np.flatnonzero(near.sum(1) > 1):
            rivals = np.flatnonzero(near[r])
            exact = ((part[r] - words[rivals]) ** 2).sum(1)
            pick[r] = rivals[exact.argmin()]
        best[lo : lo + step] = pick
        dist[lo : lo + step] = ((part - words[pick]) ** 2).sum(1)
    return best, dist


def matrix(column) -> np.ndarray:
    """Arrow list column of equal-length vectors as a float64 matrix; nulls are left out, other lengths are an error."""
    rows = len(column) - column.null_count
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    sizes = np.unique(pc.list_value_length(column).drop_null().to_numpy(zero_copy_only=False))
    if len(sizes) > 1:
        lengths = pc.list_value_length(column).to_pylist()
        odd = next(i for i, n in enumerate(lengths) if n is not None and n != lengths[0])
        raise ValueError(f"vectors of unequal length: row {odd} of the batch has {lengths[odd]} values")
    return flat.reshape(rows, -1) if rows else flat.reshape(0, 0)


def waves(column) -> list:
    """Arrow list column as NumPy arrays (null for null), sliced from the column's own buffer."""
    flat = column.values.to_numpy(zero_copy_only=False)
    ends = column.offsets.to_numpy()
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    return [flat[a:b] if ok else None for a, b, ok in zip(ends[:-1], ends[1:], valid)]


def list_column(rows: list):
    """NumPy arrays (or null) as an Arrow list column of floats; matrices become lists of rows."""
    sizes = np.array([0 if r is None else len(r) for r in rows], np.int64)
    offsets = pa.array(np.concatenate([[0], sizes.cumsum()]).astype(np.int32))
    nulls = pa.array([r is None for r in rows], pa.bool_())
    found = [np.asarray(r, np.float32) for r in rows if r is not None]
    values = np.concatenate(found) if found else np.empty(0, np.float32)
    inner = pa.array(values.ravel())
    if values.ndim == 2:
        inner = pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), inner)
    return pa.ListArray.from_arrays(offsets, inner, mask=nulls)
