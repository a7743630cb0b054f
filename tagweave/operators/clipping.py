"""Areas and outlines of polygons laid over each other, a batch of pairs at a time: ``plane.pieces`` and ``plane.outline`` in arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Places of the pieces that an outline has: of the first polygon and of the second.
KEPT = {"intersection": ((1, 2), (1,)), "union": ((-1, 2), (-1,)), "difference": ((-1, -2), (1,))}
#: Numbers in an array at a time.
NUMBERS = 500_000


def _corners(batch: pa.RecordBatch, n: str) -> tuple[np.ndarray, np.ndarray]:
    """The corners (x, y) of all rows' polygons and the rows' first places in them."""
    x, y = (batch.column(batch.schema.get_field_index(f"{n}_{k}s")) for k in "xy")
    starts = np.concatenate([[0], np.cumsum(x.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    return np.stack([x.flatten().to_numpy(zero_copy_only=False), y.flatten().to_numpy(zero_copy_only=False)], 1), starts


def _next(starts: np.ndarray) -> np.ndarray:
    """The place of the corner after each one in its polygon."""
    after = np.arange(starts[-1]) + 1
    after[starts[1:] - 1] = starts[:-1]
    return after


def _sides(corners: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sides (x0, y0, x1, y1), anticlockwise, without those of no length, and the rows' first places in them."""
    row, b = np.repeat(np.arange(len(starts) - 1), np.diff(starts)), corners[_next(starts)]
    area = np.bincount(row, corners[:, 0] * b[:, 1] - b[:, 0] * corners[:, 1], len(starts) - 1)
    lines = np.where((area < 0)[row][:, None], np.concatenate([b, corners], 1), np.concatenate([corners, b], 1))
    held = (corners != b).any(1)
    return lines[held], np.concatenate([[0], np.cumsum(np.bincount(row[held], minlength=len(starts) - 1))]).astype(np.int64)


def _padded(rows: np.ndarray, starts: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that belong to each of ``wanted``, and which of them are there."""
    n = starts[wanted + 1] - starts[wanted]
    there = np.arange(max(n.max(initial=0), 1))[None, :] < n[:, None]
    return rows[np.where(there, starts[wanted][:, None] + np.arange(there.shape[1])[None, :], 0)], there


def _slices(width: np.ndarray) -> Iterator[np.ndarray]:
    """Places in order of their width, so many at a time that rows of the greatest width stay within NUMBERS."""
    order, at = np.argsort(width, kind="stable"), 0
    while at < len(order):
        n = max(1, NUMBERS // max(1, int(width[order[min(at + NUMBERS // max(1, int(width[order[at]])), len(order)) - 1]])))
        yield order[at : at + n]
        at += n


def _parted(own: np.ndarray, own_at: np.ndarray, sides: np.ndarray, row: np.ndarray, other: np.ndarray, other_at: np.ndarray) -> np.ndarray:
    """For each side whether its line has the row's own polygon on its one side and the other one on its other."""
    out = np.zeros(len(sides), bool)
    width = np.maximum(np.diff(own_at), np.diff(other_at))[row]
    for k in _slices(width):
        s = sides[k][:, None, :]
        turn = lambda c: (s[..., 2] - s[..., 0]) * (c[..., 1] - s[..., 1]) - (s[..., 3] - s[..., 1]) * (c[..., 0] - s[..., 0])  # noqa: B023, E731
        (p, held), (q, there) = _padded(own, own_at, row[k]), _padded(other, other_at, row[k])
        p, q = turn(p), turn(q)
        out[k] = (((p >= 0) | ~held).all(1) & ((q < 0) | ~there).all(1)) | (((p <= 0) | ~held).all(1) & ((q > 0) | ~there).all(1))
    return out


def _pieces(own: np.ndarray, row: np.ndarray, others: np.ndarray, at: np.ndarray, eps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``plane.pieces``: lines, their rows and their places."""
    lines, rows, wide = [np.empty((0, 4))], [np.empty(0, np.int64)], np.diff(at)
    for k in _slices(3 * wide[row] + 2):
        s, e = own[k], eps[row[k]][:, None]
        o, there = _padded(others, at, row[k])
        dx, dy = ((s[:, n + 2] - s[:, n])[:, None] for n in (0, 1))
        ox, oy, fx, fy = o[..., 2] - o[..., 0], o[..., 3] - o[..., 1], o[..., 0] - s[:, :1], o[..., 1] - s[:, 1:2]
        cross, long, slant = dx * oy - dy * ox, dx * dx + dy * dy, np.sqrt(ox * ox + oy * oy)
        met, on_other, slack = (fx * oy - fy * ox) / cross, (fx * dy - fy * dx) / cross, e / slant
        cuts = [np.where(there & (np.abs(cross) > 1e-14 * np.sqrt(long) * slant) & (on_other >= -slack) & (on_other <= 1 + slack), met, 1.0)]
        for n in (0, 2):
            gx, gy = o[..., n] - s[:, :1], o[..., n + 1] - s[:, 1:2]
            cuts.append(np.where(there & (np.abs(dx * gy - dy * gx) <= e * np.sqrt(long)), (gx * dx + gy * dy) / long, 1.0))
        t = np.concatenate([np.zeros((len(k), 1)), *cuts, np.ones((len(k), 1))], 1)
        t = np.sort(np.where((t > 0) & (t < 1), t, np.where(np.arange(t.shape[1])[None, :] == 0, 0.0, 1.0)), 1)
        x, y = (np.where(t == 1, s[:, n + 2 : n + 3], s[:, n : n + 1] + t * d) for n, d in ((0, dx), (1, dy)))
        i, j = np.nonzero(np.hypot(x[:, 1:] - x[:, :-1], y[:, 1:] - y[:, :-1]) > e)
        lines.append(np.stack([x[i, j], y[i, j], x[i, j + 1], y[i, j + 1]], 1))
        rows.append(row[k][i])
    line, row = np.concatenate(lines), np.concatenate(rows)
    place = np.empty(len(line), np.int64)
    for k in _slices(wide[row]):
        s, e = line[k], eps[row[k]][:, None]
        o, there = _padded(others, at, row[k])
        x, y, dx, dy = ((s[:, n] + s[:, n + 2])[:, None] / 2 if d == 0 else (s[:, n + 2] - s[:, n])[:, None] for d in (0, 1) for n in (0, 1))
        ox, oy = o[..., 2] - o[..., 0], o[..., 3] - o[..., 1]
        long = ox * ox + oy * oy
        turn, share = ox * (y - o[..., 1]) - oy * (x - o[..., 0]), ((x - o[..., 0]) * ox + (y - o[..., 1]) * oy) / long
        on = there & (np.abs(turn) <= e * np.sqrt(long)) & (share >= 0) & (share <= 1) & (np.abs(dx * oy - dy * ox) <= 1e-6 * np.sqrt(long * (dx * dx + dy * dy)))
        crossed = there & ((o[..., 1] > y) != (o[..., 3] > y)) & ((turn > 0) == (o[..., 3] > o[..., 1]))
        same = np.take_along_axis(dx * ox + dy * oy > 0, on.argmax(1)[:, None], 1)[:, 0]
        place[k] = np.where(on.any(1), np.where(same, 2, -2), np.where(crossed.sum(1) % 2 == 1, 1, -1))
    return line, row, place


def laid_over(kinds: tuple[str, ...], epsilon: float):
    """For ``mapInArrow`` over rows (a, b, a_xs, a_ys, b_xs, b_ys): rows (a, b, <kind>, <kind>_length) without those that a side's line parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            (p, p_at), (q, q_at) = _corners(batch, "a"), _corners(batch, "b")
            (own, own_at), (other, other_at) = _sides(p, p_at), _sides(q, q_at)
            n = batch.num_rows
            row, back = (np.repeat(np.arange(n), np.diff(at)) for at in (own_at, other_at))
            apart = np.zeros(n, bool)
            with np.errstate(all="ignore"):
                np.logical_or.at(apart, row, _parted(p, p_at, own, row, q, q_at))
                np.logical_or.at(apart, back, _parted(q, q_at, other, back, p, p_at))
                eps = epsilon * np.maximum(*(np.maximum.reduceat(np.abs(c).max(1), at[:-1]) for c, at in ((p, p_at), (q, q_at))))
                stay, mine = ~apart[row], ~apart[back]
                parts = [_pieces(own[stay], row[stay], other, other_at, eps), _pieces(other[mine], back[mine], own, own_at, eps)]
            found = {}
            for kind in kinds:
                area, around = np.zeros(n), np.zeros(n)
                for (line, at, place), kept, sign in zip(parts, KEPT[kind], (1, -1 if kind == "difference" else 1), strict=True):
                    held = np.isin(place, kept)
                    line, at = line[held], at[held]
                    area += sign * np.bincount(at, line[:, 0] * line[:, 3] - line[:, 2] * line[:, 1], n) / 2
                    around += np.bincount(at, np.hypot(line[:, 2] - line[:, 0], line[:, 3] - line[:, 1]), n)
                found |= {kind: area, f"{kind}_length": around}
            keys = {k: batch.column(batch.schema.get_field_index(k)) for k in "ab"}
            yield pa.RecordBatch.from_pydict(keys | {k: pa.array(v) for k, v in found.items()}).filter(pa.array(~apart))

    return run
