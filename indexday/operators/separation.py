"""Which terms of a logistic model have no finite estimate, since the outcomes separate along them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_STEPS = 40
FIRST_LOOK = 6
SETTLED = 1e-8
# A row moves by about one in a separating step, by nothing if it is on the boundary.
MOVES = 0.1
STANDS = 1e-7
RANK = 1e-9

Moments = Callable[[DataFrame, Sequence[str], np.ndarray], list[tuple[float, np.ndarray, np.ndarray]]]


def predictor(terms: Sequence[str], weights: Sequence[float]) -> Column:
    """The linear predictor of a row; ``weights`` are those of the terms, then the intercept's."""
    return sum((F.lit(float(w)) * F.col(t) for t, w in zip(terms, weights) if w), F.lit(float(weights[-1])))


@dataclass(frozen=True)
class Separation:
    """Separating directions over the terms and the intercept, and the coefficients that have no finite estimate.

    Along a direction no row's predictor moves away from its outcome. Rows that move towards it are fitted
    without error in the limit; the rest is the data of the finite coefficients.
    """

    terms: tuple[str, ...] = ()
    directions: tuple[tuple[float, ...], ...] = ()
    infinite: frozenset[str] = frozenset()

    def decides(self) -> Column:
        """Whether some direction moves a row."""
        moved = F.lit(False)
        for direction in self.directions:
            moved = moved | (F.abs(predictor(self.terms, direction)) > STANDS)
        return moved


def _span(information: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(basis of the row space, basis of the null space) behind an information matrix, in units of its columns."""
    units = np.sqrt(np.diag(information))
    units = np.where(units > 0, units, 1.0)
    values, vectors = np.linalg.eigh(information / np.outer(units, units))
    seen = values > RANK * max(values.max(), 1.0)
    vectors = vectors / units[:, None]
    null, _ = np.linalg.qr(vectors[:, ~seen]) if (~seen).any() else (vectors[:, :0], None)
    return vectors[:, seen], null


def _certified(rows: DataFrame, terms: Sequence[str], step: np.ndarray, moments: Moments) -> np.ndarray | None:
    """A step made exact and checked on all rows: none moves the wrong way and some move, by one at the most."""
    side = F.col("label") * 2 - 1
    size = len(step)
    still = rows.filter(F.abs(predictor(terms, step)) <= MOVES)
    information = moments(still, terms, np.zeros((1, size)))[0][2]
    # The part that leaves the standing rows exactly where they are.
    null = _span(information)[1] if information.any() else np.eye(size)
    exact = null @ np.linalg.lstsq(null, step, rcond=None)[0] if null.shape[1] else np.zeros(size)
    shift = side * predictor(terms, exact)
    bounds = rows.agg(F.min(shift).alias("low"), F.max(shift).alias("high")).first()
    if bounds.high is None or bounds.high <= MOVES or bounds.low < -STANDS * bounds.high:
        return None
    exact = exact / bounds.high
    lost = rows.filter((F.abs(predictor(terms, exact)) > STANDS) & (side * predictor(terms, exact) < MOVES / 1e3)).isEmpty()
    return exact if lost else None


def _direction(rows: DataFrame, terms: Sequence[str], moments: Moments) -> np.ndarray | None:
    """A separating direction, or None if the likelihood has a maximum.

    Newton steps end at the maximum if there is one. If not, they go on for ever, and their step tends to a
    direction along which the separated rows move by one and the others stand.
    """
    size = len(terms) + 1
    basis, _ = _span(moments(rows, terms, np.zeros((1, size)))[0][2])
    point, last, level = np.zeros(size), np.zeros(size), -np.inf
    for i in range(MAX_STEPS):
        now, slope, information = moments(rows, terms, point[None])[0]
        if now < level - 1e-9 * abs(level):  # too far: half the way
            point = point - last / 2
            last = last / 2
            continue
        level = now
        inner = basis.T @ information @ basis
        try:
            step = basis @ np.linalg.solve(inner, basis.T @ slope)
        except np.linalg.LinAlgError:
            step = last
        reach = np.sqrt(max(step @ (basis @ basis.T) @ step, 0.0)) + np.abs(step).max()
        if reach < SETTLED * (1 + np.abs(point).max()):
            return None
        if i >= FIRST_LOOK and np.abs(step - last).max() < 1e-2 * np.abs(step).max():
            found = _certified(rows, terms, step, moments)
            if found is not None:
                return found
        point, last = point + step, step
    return None


def find_separation(rows: DataFrame, terms: Sequence[str], moments: Moments, intercept: str) -> Separation:
    """Separating directions of weighted patterns (``terms`` independent, label, weight), until what they leave has a maximum.

    A coefficient is infinite if a direction changes it. All directions that leave the remaining rows where they are
    belong to the same cone, so these are the coefficients with a part in the null space of the remaining rows.
    Each step is one pass over the patterns; the driver gets sums of the size of the terms.
    """
    names, size = [*terms, intercept], len(terms) + 1
    directions: list[tuple[float, ...]] = []
    left = rows
    while len(directions) < size and not left.isEmpty():
        found = _direction(left, terms, moments)
        if found is None:
            break
        directions.append(tuple(found.tolist()))
        left = rows.filter(~Separation(tuple(terms), tuple(directions)).decides())
    if not directions:
        return Separation(tuple(terms))
    information = moments(left, terms, np.zeros((1, size)))[0][2]
    null = _span(information)[1] if information.any() else np.eye(size)
    infinite = frozenset(n for n, part in zip(names, np.abs(null).max(axis=1)) if part > 1e-6)
    return Separation(tuple(terms), tuple(directions), infinite)
