"""Linear support vector machines with squared hinge loss by a distributed trust-region Newton method (L4).

Minimises half the squared norm of the coefficients, the intercept among them, plus the summed losses
cost * max(0, 1 - margin) ** 2, for several one-against-rest problems at once. Every pass over the data serves all
problems that are still open: one gives loss and gradient, each step of the conjugate gradients one product with
the generalised Hessian, whose rows are those inside the margin. Only sums of the size of the coefficients leave a
task.

The number of these steps follows the Hessian's condition, which grows with the rows. So they are preconditioned by
the inverse Hessian of some rows per column, drawn once: then their number depends on rows per column drawn, not on
the table. Losses, gradients and Hessian products are always those of all rows, and so is the minimum; drawn rows
that stand badly for the others cost steps, not precision.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame

from opinionmill.operators.vector_blocks import Block, block_sums, drawn_rows

# Shares of the predicted decrease: below the first a step is refused, beyond the others the region shrinks or grows.
ACCEPTED, POOR, GOOD = 1e-4, 0.25, 0.75
CONJUGATE_STEPS = 50
CONJUGATE_PRECISION = 0.1  # of the gradient's norm
DRAWN = 8  # rows per column in a preconditioner
LEAST_DRAWN = 4096  # rows
DRAWN_ENTRIES = 1 << 23  # of the drawn rows, 12 bytes each
COLUMNS = 6000  # of a preconditioner, those with the most weight; the others have the Hessian's diagonal
RIDGE = 1e-5  # on a diagonal of 1, far above the rounding of single precision
MANY_STEPS = 6  # a preconditioner that took more is made again at the coefficients reached
CHUNK = 512  # rows of a dense piece
STRIPE = 512  # columns that a dense matrix is worked on at a time


def _products(block: Block, vectors: np.ndarray) -> np.ndarray:
    """Of every row with every vector, whose last entry meets the intercept's 1."""
    return block.products(vectors[:, :-1]) + vectors[:, -1]


def _weighted_sums(block: Block, weights: np.ndarray) -> np.ndarray:
    return np.column_stack((block.weighted_sums(weights), weights.sum(axis=0)))


def _sides(labels: np.ndarray, costs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """+1 or -1 and the cost of every row for every problem; ``costs`` of a row's own class, 1 for all others."""
    own = labels[:, None] == np.arange(len(costs))
    return np.where(own, 1.0, -1.0), np.where(own, costs, 1.0)


def loss_and_gradient(blocks: DataFrame, weights: np.ndarray, costs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Objective, gradient and the Hessian's diagonal per problem (rows of ``weights``, the intercept last)."""
    def measure(block: Block) -> list[np.ndarray]:
        side, cost = _sides(block.labels, costs)
        short = np.maximum(0.0, 1.0 - side * _products(block, weights))
        return [(cost * short ** 2).sum(axis=0), _weighted_sums(block, -2.0 * cost * side * short),
                _weighted_sums(block.squared(), 2.0 * cost * (short > 0))]

    loss, slope, curvature = block_sums(blocks, measure)
    return loss + 0.5 * (weights ** 2).sum(axis=1), slope + weights, curvature + 1.0


def hessian_products(blocks: DataFrame, weights: np.ndarray, vectors: np.ndarray, costs: np.ndarray,
                     which: np.ndarray | None = None) -> np.ndarray:
    """Product of each problem's Hessian at ``weights`` with its vector; ``which`` numbers the problems if not all."""
    which = np.arange(len(costs)) if which is None else which

    def measure(block: Block) -> list[np.ndarray]:
        side, cost = (x[:, which] for x in _sides(block.labels, costs))
        inside = side * _products(block, weights) < 1.0
        return [_weighted_sums(block, 2.0 * cost * inside * _products(block, vectors))]

    return block_sums(blocks, measure)[0] + vectors


def _stripes(n: int) -> list[slice]:
    return [slice(at, min(at + STRIPE, n)) for at in range(0, n, STRIPE)]


def invert_in_place(matrix: np.ndarray) -> None:
    """A symmetric positive matrix becomes its inverse, without a second one beside it."""
    stripes = _stripes(len(matrix))
    for own in stripes:
        middle = np.linalg.inv(matrix[own, own].astype(np.float64)).astype(matrix.dtype)
        left = matrix[:, own].copy()
        left[own] = 0.0
        across = middle @ matrix[own]
        for other in stripes:
            if other != own:
                matrix[:, other] -= left @ across[:, other]
        matrix[own] = across
        matrix[:, own] = -left @ middle
        matrix[own, own] = middle


class Symmetric:
    """The upper half of a symmetric matrix, by stripes of columns."""

    def __init__(self, matrix: np.ndarray):
        self.parts = [(s, matrix[:s.stop, s].copy()) for s in _stripes(len(matrix))]

    def times(self, vector: np.ndarray) -> np.ndarray:
        out = np.zeros_like(vector)
        for stripe, part in self.parts:
            out[:stripe.stop] += part @ vector[stripe]
            out[stripe] += vector[:stripe.start] @ part[:stripe.start]
        return out


class Preconditioner:
    """Inverse Hessians of drawn rows, in coordinates in which the Hessian's diagonal is 1.

    All problems begin with that of all drawn rows, all weighing the same; ``make`` gives one its own. Kept in single
    precision on the driver: half of ``COLUMNS`` squared numbers per problem, and once for all, at most.
    """

    def __init__(self, drawn: Block, factor: float, costs: np.ndarray):
        self.drawn, self.factor, self.costs = drawn, factor, costs
        self.columns = np.arange(drawn.size)
        if drawn.size > COLUMNS:
            weight = np.bincount(drawn.indices, drawn.values ** 2, drawn.size)
            self.columns = np.sort(np.argpartition(-weight, COLUMNS)[:COLUMNS])
        self.kept = np.append(self.columns, drawn.size)  # with the intercept
        self.until = np.append(0, np.cumsum(drawn.many))
        self.own: dict[int, Symmetric | None] = {}
        self.common: Symmetric | None = self._inverse(lambda piece, rows: piece * np.float32(np.sqrt(2.0 * factor)))

    def _dense(self, rows: slice) -> np.ndarray:
        """The kept columns and the intercept's 1 of some drawn rows."""
        many, entries = self.drawn.many[rows], slice(self.until[rows.start], self.until[rows.stop])
        indices = self.drawn.indices[entries]
        out = np.zeros((len(many), len(self.kept)), np.float32)
        out[:, -1] = 1.0
        place = np.searchsorted(self.columns, indices)
        known = self.columns[np.minimum(place, len(self.columns) - 1)] == indices if len(self.columns) else np.zeros(0, bool)
        out[np.repeat(np.arange(len(many)), many)[known], place[known]] = self.drawn.values[entries][known]
        return out

    def _inverse(self, weigh: Callable[[np.ndarray, slice], np.ndarray]) -> Symmetric | None:
        """Of the Hessian that ``weigh`` makes of dense rows, in pieces; None where it has none in single precision."""
        hessian, stripes = np.eye(len(self.kept), dtype=np.float32), _stripes(len(self.kept))
        for at in range(0, len(self.drawn.many), CHUNK):
            rows = slice(at, min(at + CHUNK, len(self.drawn.many)))
            piece = weigh(self._dense(rows), rows)
            for stripe in stripes:  # the upper half
                hessian[:stripe.stop, stripe] += piece[:, :stripe.stop].T @ piece[:, stripe]
        for stripe in stripes:
            hessian[stripe, :stripe.start] = hessian[:stripe.start, stripe].T
        scale = 1.0 / np.sqrt(hessian.diagonal())
        hessian *= scale[:, None]
        hessian *= scale
        hessian[np.diag_indices(len(scale))] += np.float32(RIDGE)
        try:
            invert_in_place(hessian)
        except np.linalg.LinAlgError:
            return None
        return Symmetric(hessian) if np.isfinite(hessian.sum()) else None

    def make(self, problem: int, weights: np.ndarray) -> None:
        """One for a problem alone, at its coefficients."""
        self.own.pop(problem, None)
        side, cost = (x[:, problem] for x in _sides(self.drawn.labels, self.costs))

        def weigh(piece: np.ndarray, rows: slice) -> np.ndarray:
            inside = side[rows] * (piece @ weights[self.kept].astype(np.float32)) < 1.0
            return piece[inside] * np.sqrt(2.0 * self.factor * cost[rows][inside]).astype(np.float32)[:, None]

        if len(self.own) == len(self.costs) - 1:
            self.common = None  # every problem has its own from here on
        self.own[problem] = self._inverse(weigh)

    def solve(self, problem: int, rest: np.ndarray) -> np.ndarray:
        """``rest`` times the inverse; ``rest`` itself where there is none or it is not positive for it."""
        inverse, out = self.own.get(problem, self.common), rest.copy()
        if inverse is None:
            return out
        out[self.kept] = inverse.times(rest[self.kept].astype(np.float32))
        return out if out @ rest > 0 else rest.copy()


def _to_border(step: np.ndarray, direction: np.ndarray, radius: float) -> float:
    """How far ``direction`` leads from ``step`` to the border of the region."""
    a, b, c = direction @ direction, step @ direction, step @ step - radius ** 2
    return (-b + np.sqrt(max(0.0, b * b - a * c))) / a


def trust_region_steps(blocks: DataFrame, weights: np.ndarray, gradient: np.ndarray, scale: np.ndarray, radius: np.ndarray,
                       costs: np.ndarray, open_: np.ndarray, near: Preconditioner | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Steps inside each problem's region by preconditioned conjugate gradients, the residuals that give the predicted
    decrease, and how many products each problem took.

    All are in coordinates divided by ``scale``, as are the results and the radius: there every diagonal entry of
    the Hessian is 1, so that frequent and rare terms need the same number of steps.
    """
    gradient = gradient * scale
    step, rest, taken = np.zeros_like(weights), -gradient, np.zeros(len(weights), int)
    direction = np.array([near.solve(i, rest[i]) if near and open_[i] else rest[i] for i in range(len(rest))])
    size, going = (rest * direction).sum(axis=1), open_.copy()
    bar = CONJUGATE_PRECISION ** 2 * size
    for _ in range(CONJUGATE_STEPS):
        going &= size > bar
        which = np.flatnonzero(going)
        if not len(which):
            break
        product = scale[which] * hessian_products(blocks, weights[which], scale[which] * direction[which], costs, which)
        taken[which] += 1
        for i, curved in zip(which, product, strict=True):
            length = size[i] / (direction[i] @ curved)
            if np.linalg.norm(step[i] + length * direction[i]) > radius[i]:
                length, going[i] = _to_border(step[i], direction[i], radius[i]), False
            step[i] = step[i] + length * direction[i]
            rest[i] = rest[i] - length * curved
            if going[i]:
                turned = near.solve(i, rest[i]) if near else rest[i]
                before, size[i] = size[i], rest[i] @ turned
                direction[i] = turned + size[i] / before * direction[i]
    return step, rest, taken


def fit_squared_hinge(blocks: DataFrame, size: int, costs: Sequence[float], max_iter: int = 100, precision: float = 1e-5) -> np.ndarray:
    """Coefficients of one problem per cost, the intercept last.

    Problem i sets label i against all others; ``costs[i]`` weighs the losses of its own rows. A problem is done
    when its gradient has shrunk to ``precision`` of the first one.
    """
    cost = np.array(costs, float)
    weights = np.zeros((len(cost), size + 1))
    loss, gradient, curvature = loss_and_gradient(blocks, weights, cost)
    first = np.linalg.norm(gradient, axis=1)
    radius = np.full(len(cost), np.inf)
    drawn = drawn_rows(blocks, max(LEAST_DRAWN, DRAWN * (min(size, COLUMNS) + 1)), DRAWN_ENTRIES)
    near = Preconditioner(*drawn, cost) if drawn else None
    taken = np.zeros(len(cost), int)
    for _ in range(max_iter):
        open_ = np.linalg.norm(gradient, axis=1) > precision * first
        if not open_.any():
            break
        for i in np.flatnonzero(open_ & (taken > MANY_STEPS)) if near else ():
            near.make(i, weights[i])
        scale = 1.0 / np.sqrt(curvature)
        step, rest, taken = trust_region_steps(blocks, weights, gradient, scale, radius, cost, open_, near)
        moved = weights + scale * step
        new_loss, new_gradient, new_curvature = loss_and_gradient(blocks, moved, cost)
        for i in np.flatnonzero(open_):
            predicted = -0.5 * ((scale[i] * gradient[i]) @ step[i] - step[i] @ rest[i])
            decrease = loss[i] - new_loss[i]
            length = np.linalg.norm(step[i])
            if predicted <= 0 or abs(decrease) <= 1e-12 * abs(loss[i]):
                gradient[i] = 0.0  # no further progress in double precision
                if decrease > 0:
                    weights[i], loss[i] = moved[i], new_loss[i]
                continue
            ratio = decrease / predicted
            if ratio < POOR:
                radius[i] = 0.5 * min(length, radius[i])
            elif ratio > GOOD:
                radius[i] = max(radius[i], 3.0 * length)
            if ratio > ACCEPTED:
                weights[i], loss[i], gradient[i], curvature[i] = moved[i], new_loss[i], new_gradient[i], new_curvature[i]
    return weights
