"""Column expressions of the logistic model: score, sigmoid, residual, gradient, step, norm.

They take ``x ARRAY<DOUBLE>`` and a weights array column and are used by the per-row
operators. The training loop works on one DOUBLE column per slot instead, which stays inside
whole-stage codegen with no higher-order functions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference model.
WEIGHT_SLOTS = 64  # weight vector length; also the divisor of the gradient RMS
DEFAULT_LR = 0.01
DEFAULT_THRESHOLD = 1e-4
DEFAULT_ROUNDS = 10


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- array forms -------------------------------------------------------------------

def linear_score(x: Column | str, w: Column | str) -> Column:
    """``sum_j w_j * x_j`` over the sample's own width (no intercept).

    ``w`` is trimmed to ``size(x)`` first, since ``zip_with`` pads the shorter side with NULL.
    """
    x, w = _col(x), _col(w)
    pairs = F.zip_with(x, F.slice(w, 1, F.size(x)), lambda a, b: a * b)
    return F.aggregate(pairs, F.lit(0.0), lambda s, v: s + v)


def sigmoid(z: Column) -> Column:
    """``1 / (1 + e^-z)``; large negative z gives 0.0, never an error."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def residual(x: Column | str, w: Column | str, y: Column | str) -> Column:
    """``sigmoid(w.x) - y``."""
    return sigmoid(linear_score(x, w)) - _col(y)


def sample_gradient(x: Column | str, err: Column) -> Column:
    """``err * x_j`` for every slot of the sample."""
    return F.transform(_col(x), lambda v: err * v)


def weight_step(w: Column | str, g: Column | str, lr: Column | float) -> Column:
    """P5: ``w_j - lr * g_j``; slots of ``w`` beyond ``g`` are kept."""
    lr_c = lr if isinstance(lr, Column) else F.lit(float(lr))
    w, g = _col(w), _col(g)
    return F.transform(w, lambda a, i: a - lr_c * F.coalesce(F.get(g, i), F.lit(0.0)))


def zero_weights(k: int) -> Column:
    """K zero slots."""
    return F.array_repeat(F.lit(0.0), int(k))


def gradient_rms(g: Column | str, norm_slots: int = WEIGHT_SLOTS) -> Column:
    """A5: ``sqrt(sum g_j^2 / norm_slots)``; the divisor is the slot count, not k."""
    sq = F.aggregate(_col(g), F.lit(0.0), lambda s, v: s + v * v)
    return F.sqrt(sq / F.lit(float(norm_slots)))


def rms_of(values: Sequence[float], norm_slots: int = WEIGHT_SLOTS) -> float:
    """Driver-side A5 over a collected k-vector (O(k) work)."""
    return math.sqrt(sum(v * v for v in values) / float(norm_slots))
