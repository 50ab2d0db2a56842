"""Linear recurrences over series that are cut into blocks.

Exponential smoothing and moving-average residuals are linear in the state they
start from: whatever enters a block, the state that leaves it is ``A s + v`` and
the sum of its squared one-step errors is ``s' P s + 2 q' s + r``. A task works
one block out without knowing what comes before it, and the blocks of a series
are composed afterwards. ``A`` and ``P`` depend on the parameters only, ``v``,
``q`` and ``r`` on the data. Both sweeps take many parameter points at once.

A sweep carries ``c`` columns: the entering state's components, then a constant.
The first block of a series knows its state, so it has the constant only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_ROWS = 256


class _Squares:
    """Sum of the outer products of error rows (points x c), added up in blocks of rows."""

    def __init__(self, points: int, columns: int):
        self.total, self.rows, self.used = np.zeros((points, columns, columns)), np.empty((points, _ROWS, columns)), 0

    def add(self, e: np.ndarray) -> None:
        self.rows[:, self.used] = e
        self.used += 1
        if self.used == _ROWS:
            self.flush()

    def flush(self) -> np.ndarray:
        part = self.rows[:, :self.used]
        self.total += np.matmul(part.transpose(0, 2, 1), part)
        self.used = 0
        return self.total.copy()


def smoothing(x: np.ndarray, gain: np.ndarray, season: int, enter: np.ndarray, first: int, counted: int, weight: np.ndarray,
              stops: Sequence[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Level, slope and ``season`` seasonal terms corrected by ``gain`` times the error.

    ``x``: points x rows; ``gain``: points x 3; ``enter``: (2 + season) x points x c, not changed; rows from ``first``
    on are used, errors from ``counted`` on are added up, times ``weight`` (points x period, by row modulo period).
    Yields (stop, states points x (2 + season) x c, squares points x c x c) for every stop, in order.
    """
    s, squares, period = enter.copy(), _Squares(enter.shape[1], enter.shape[2]), weight.shape[1]
    a, b, g = (gain[:, i, None] for i in range(3))
    due = sorted(set(stops))
    for stop in [t for t in due if t <= first]:
        yield stop, s.transpose(1, 0, 2).copy(), squares.flush()
    due = [t for t in due if t > first]
    for t in range(first, due[-1] if due else 0):
        row = 2 + t % season
        e = -(s[0] + s[1] + s[row])
        e[:, -1] += x[:, t]
        s[0] += s[1] + a * e
        s[1] += b * e
        s[row] += g * e
        if t >= counted:
            squares.add(e * weight[:, t % period, None])
        if t + 1 == due[0]:
            yield due.pop(0), s.transpose(1, 0, 2).copy(), squares.flush()


def residuals(w: np.ndarray, before: np.ndarray, phi: np.ndarray, theta: np.ndarray, enter: np.ndarray, first: int,
              stops: Sequence[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``e = w - phi * before - theta * e'`` with the error before it as state (1 x points x c); yields as ``smoothing``."""
    e, squares = enter[0].copy(), _Squares(enter.shape[1], enter.shape[2])
    due = sorted(set(stops))
    for stop in [t for t in due if t <= first]:
        yield stop, e[:, None].copy(), squares.flush()
    due = [t for t in due if t > first]
    for t in range(first, due[-1] if due else 0):
        e = -theta[:, None] * e
        e[:, -1] += w[t] - phi * before[t]
        squares.add(e)
        if t + 1 == due[0]:
            yield due.pop(0), e[:, None].copy(), squares.flush()


def unknown(size: int, points: int) -> np.ndarray:
    """The entering state as itself: identity columns, no constant."""
    out = np.zeros((size, points, size + 1))
    out[np.arange(size), :, np.arange(size)] = 1.0
    return out


def advance(state: np.ndarray, squares: float, a: np.ndarray, v: np.ndarray, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, float]:
    """State and squares behind a block: ``q`` holds the mixed terms, then the constant one."""
    return a @ state + v, squares + float(state @ p @ state + 2.0 * q[:-1] @ state + q[-1])
