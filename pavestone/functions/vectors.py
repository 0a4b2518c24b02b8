"""Arrow batches of lines in numpy, for geometry that would be a fold over a line's vertices inside another (G-04, G-06, G-07, G-18, G-19, G-22, G-29).

Lines are arrays of struct<x, y>.  A batch of lines is two flat arrays and offsets; what runs along a line is
added up vertex by vertex, for all lines at once, in the order of the fold that it stands for.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

# tasks are sent what they run: their machines need not have this library
cloudpickle.register_pickle_by_value(sys.modules[__name__])

POINT = "struct<x:double,y:double>"
#: Pairs of segments that are compared at once.
PAIRS = 1 << 19


class Lines:
    """A batch of lines: vertices x, y; those of line i stand at start[i] .. start[i] + n[i]."""

    def __init__(self, column: pa.Array):
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        self.null = np.asarray(column.is_null())
        n = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        points = column.flatten()
        self.x, self.y = (points.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        self.n, self.start = n, np.concatenate([[0], np.cumsum(n)])[:-1]

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.n)), self.n)

    def segments(self) -> tuple[np.ndarray, np.ndarray]:
        """The line of each segment, and the place of its first vertex."""
        last = np.zeros(len(self.x), bool)
        last[(self.start + self.n - 1)[self.n > 0]] = True
        first = np.flatnonzero(~last)
        return self.owner()[first], first

    def running(self, step: np.ndarray) -> np.ndarray:
        """Sums of `step` (per vertex; that of a line's last one is not used) from a line's start to each vertex."""
        at = np.zeros(len(self.x))
        longest = np.argsort(-self.n, kind="stable")
        sizes = -self.n[longest]
        for k in range(1, int(self.n.max(initial=0))):
            i = self.start[longest[: np.searchsorted(sizes, -k)]] + k
            at[i] = at[i - 1] + step[i - 1]
        return at

    def steps(self) -> np.ndarray:
        dx, dy = np.diff(self.x, append=0.0), np.diff(self.y, append=0.0)
        return np.sqrt(dx * dx + dy * dy)

    def rows(self, values: np.ndarray, empty: float) -> np.ndarray:
        """The last of the values at the vertices of each line."""
        out = np.full(len(self.n), empty)
        some = self.n > 0
        out[some] = values[(self.start + self.n - 1)[some]]
        return out


def numbers(column: pa.Array) -> np.ndarray:
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False)


def points(x: np.ndarray, y: np.ndarray, null: np.ndarray) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(x, pa.float64()), pa.array(y, pa.float64())], ["x", "y"], mask=pa.array(null))


def lists(x: np.ndarray, y: np.ndarray, n: np.ndarray, null: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), points(x, y, np.zeros(len(x), bool)), mask=pa.array(null))


def _placed(l: Lines, at: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The point of each line at distance d; its last vertex where d lies behind the end."""
    x, y = l.rows(l.x, np.nan), l.rows(l.y, np.nan)
    owner, first = l.segments()
    reached = d[owner] <= at[first + 1]
    rows, where = np.unique(owner[reached], return_index=True)
    i = first[reached][where]
    step = l.steps()[i]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = np.where(step > 0, np.maximum(d[rows] - at[i], 0.0) / step, 0.0)
    x[rows], y[rows] = l.x[i] + (l.x[i + 1] - l.x[i]) * t, l.y[i] + (l.y[i + 1] - l.y[i]) * t
    return x, y


def _interpolate(line: pa.Array, d: pa.Array) -> pa.Array:
    l, d = Lines(line), numbers(d)
    x, y = _placed(l, l.running(l.steps()), d)
    return points(x, y, (l.n == 0) | np.isnan(d))


def _placed_many(l: Lines, owner: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The points of lines `owner` at distances d, as `_placed` finds them for one distance a line; lines and distances are sorted together, so neither is repeated for the other."""
    at = l.running(l.steps())
    first = np.zeros(len(l.x), bool)
    first[l.start[l.n > 0]] = True
    ends = np.flatnonzero(~first)
    line_of = l.owner()
    # a distance before the vertices of its line that do not lie before it
    order = np.lexsort([np.repeat([0, 1], [len(d), len(ends)]), np.concatenate([d, at[ends]]), np.concatenate([owner, line_of[ends]])])
    vertex = np.concatenate([np.full(len(d), len(l.x)), ends])[order]
    following = np.empty(len(order), np.int64)
    following[order] = np.minimum.accumulate(vertex[::-1])[::-1]
    j = following[: len(d)]
    reached = j < len(l.x)
    reached[reached] = line_of[j[reached]] == owner[reached]
    x, y = l.rows(l.x, np.nan)[owner], l.rows(l.y, np.nan)[owner]
    i, far = j[reached] - 1, d[reached]
    step = l.steps()[i]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = np.where(step > 0, np.maximum(far - at[i], 0.0) / step, 0.0)
    x[reached], y[reached] = l.x[i] + (l.x[i + 1] - l.x[i]) * t, l.y[i] + (l.y[i + 1] - l.y[i]) * t
    return x, y


def _stations(line: pa.Array, first: pa.Array, step: pa.Array, count: pa.Array, total: pa.Array, near: pa.Array) -> pa.Array:
    l, first, step, total, near = Lines(line), *map(numbers, (first, step, total, near))
    null = (l.n == 0) | np.isnan(first) | np.isnan(step) | np.isnan(total)
    n = np.where(null, 0, np.maximum(np.nan_to_num(numbers(count)), 0)).astype(np.int64)
    owner = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    at = np.minimum(np.maximum(first[owner] + step[owner] * k, 0.0), total[owner])
    before, after = np.maximum(at - near[owner], 0.0), np.minimum(at + near[owner], total[owner])
    none = np.zeros(len(owner), bool)
    places = [points(*_placed_many(l, owner, d), none) for d in (at, before, after)]
    rows = pa.StructArray.from_arrays([pa.array(k.astype(np.int32)), *places], ["k", "base", "lo", "hi"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), rows)


def _substring(line: pa.Array, a: pa.Array, b: pa.Array) -> pa.Array:
    l, a, b = Lines(line), numbers(a), numbers(b)
    at, owner = l.running(l.steps()), l.owner()
    inner = np.flatnonzero((at > a[owner]) & (at < b[owner]))
    null = (l.n == 0) | np.isnan(a) | np.isnan(b)
    (ax, ay), (bx, by) = _placed(l, at, a), _placed(l, at, b)
    ends = np.arange(len(l.n))
    rows, rank = np.concatenate([ends, owner[inner], ends]), np.repeat([0, 1, 2], [len(ends), len(inner), len(ends)])
    order = np.lexsort([rank, rows])  # stable: vertices stay in order
    x, y = np.concatenate([ax, l.x[inner], bx])[order], np.concatenate([ay, l.y[inner], by])[order]
    return lists(x, y, np.bincount(rows, minlength=len(ends)), null)


#: Rounds that hulls are looked for in together; what is left then is walked line by line.
ROUNDS = 16


def _chain(x: np.ndarray, y: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Places of the vertices of lower chains; points are sorted by owner, x and y, and differ.

    A point that does not lie right of the way between its neighbours is none, whatever else goes, so all of them go at once.
    """
    at = np.arange(len(x))
    for _ in range(ROUNDS):
        if len(at) < 3:
            return at
        a, b, c = at[:-2], at[1:-1], at[2:]
        inner = (owner[a] == owner[b]) & (owner[b] == owner[c])
        out = inner & ~((x[b] - x[a]) * (y[c] - y[a]) - (y[b] - y[a]) * (x[c] - x[a]) > 0)
        if not out.any():
            return at
        at = at[np.concatenate([[True], ~out, [True]])]
    px, py, po = x.tolist(), y.tolist(), owner.tolist()
    kept: list[int] = []
    for i in at.tolist():
        while len(kept) > 1 and po[kept[-2]] == po[i]:
            a, b = kept[-2], kept[-1]
            if (px[b] - px[a]) * (py[i] - py[a]) - (py[b] - py[a]) * (px[i] - px[a]) > 0:
                break
            kept.pop()
        kept.append(i)
    return np.array(kept, np.int64)


def _hull(line: pa.Array) -> pa.Array:
    l = Lines(line)
    owner = l.owner()
    order = np.lexsort([l.y, l.x, owner])
    x, y, owner = l.x[order] + 0.0, l.y[order] + 0.0, owner[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (owner[1:] != owner[:-1])
    x, y, owner = x[new], y[new], owner[new]
    last = np.append(owner[1:] != owner[:-1], True)[: len(x)]
    first = np.append(True, owner[1:] != owner[:-1])[: len(x)]
    lower = _chain(x, y, owner)
    # turned by half, the upper chain is a lower one, in the other direction
    upper = len(x) - 1 - _chain(-x[::-1], -y[::-1], -owner[::-1])
    lower, upper = lower[~last[lower] | first[lower]], upper[~first[upper]]
    at = np.concatenate([lower, upper])
    at = at[np.argsort(owner[at], kind="stable")]
    return lists(x[at], y[at], np.bincount(owner[at], minlength=len(l.n)), l.null)


ENVELOPE = ["area", "long", "short", "azimuth"]


def _envelope(ring: pa.Array) -> pa.Array:
    l = Lines(ring)
    owner, first = l.segments()
    step = l.steps()
    real = step[first] > 0
    owner, first = owner[real], first[real]
    best = np.full((len(l.n), 4), np.inf)
    base = l.start[owner]
    # each segment against all vertices of its ring, some segments at a time
    done = 0
    while done < len(first):
        to = max(done + 1, done + int(np.searchsorted(np.cumsum(l.n[owner[done : done + PAIRS]]), PAIRS, side="right")))
        o, f, b, n = owner[done:to], first[done:to], base[done:to], l.n[owner[done:to]]
        ux, uy = (l.x[f + 1] - l.x[f]) / step[f], (l.y[f + 1] - l.y[f]) / step[f]
        cut = np.concatenate([[0], np.cumsum(n)])[:-1]
        v = np.arange(int(n.sum())) - np.repeat(cut - b, n)
        px, py = l.x[v] - np.repeat(l.x[b], n), l.y[v] - np.repeat(l.y[b], n)
        ax, ay = np.repeat(ux, n), np.repeat(uy, n)
        along, across = px * ax + py * ay, py * ax - px * ay
        w, h = (np.maximum.reduceat(s, cut) - np.minimum.reduceat(s, cut) for s in (along, across))
        az = np.degrees(np.arctan2(ux, uy))
        found = np.stack([w * h, np.maximum(w, h), np.minimum(w, h), np.mod(np.where(w >= h, az, az + 90), 180.0)], 1)
        order = np.lexsort([*found.T[::-1], o])
        rows, where = np.unique(o[order], return_index=True)
        best[rows] = _least(best[rows], found[order][where])
        done = to
    null = np.isinf(best[:, 0])
    return pa.StructArray.from_arrays([pa.array(best[:, k]) for k in range(4)], ENVELOPE, mask=pa.array(null))


def _nearest(ax, ay, bx, by, px, py):
    """(distance, x, y) of the places of segments that are closest to points."""
    dx, dy = bx - ax, by - ay
    size = dx * dx + dy * dy
    with np.errstate(divide="ignore", invalid="ignore"):
        t = np.where(size > 0, np.minimum(np.maximum(((px - ax) * dx + (py - ay) * dy) / size, 0.0), 1.0), 0.0)
    qx, qy = ax + dx * t, ay + dy * t
    return np.sqrt((px - qx) * (px - qx) + (py - qy) * (py - qy)), qx, qy


def _firsts(rows: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least of the found tuples of each row."""
    order = np.lexsort([*found.T[::-1], rows])
    rows, where = np.unique(rows[order], return_index=True)
    return rows, found[order][where]


def _least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The lesser tuple of each pair of rows."""
    apart = a != b
    k, i = np.argmax(apart, 1), np.arange(len(a))
    return np.where((b[i, k] < a[i, k])[:, None], b, a)


def _connect(a: pa.Array, b: pa.Array) -> pa.Array:
    l, r = Lines(a), Lines(b)
    owner, first = l.segments()
    n = np.maximum(r.n - 1, 0)[owner]
    rows, best = np.zeros(0, np.int64), np.zeros((0, 5))
    done = 0
    while done < len(first):
        to = max(done + 1, done + int(np.searchsorted(np.cumsum(n[done : done + PAIRS]), PAIRS, side="right")))
        m = n[done:to]
        i, o = np.repeat(first[done:to], m), np.repeat(owner[done:to], m)
        j = np.arange(int(m.sum())) - np.repeat(np.concatenate([[0], np.cumsum(m)])[:-1], m) + r.start[o]
        done = to
        if not len(i):
            continue
        gax, gay, gbx, gby = l.x[i], l.y[i], l.x[i + 1], l.y[i + 1]
        hax, hay, hbx, hby = r.x[j], r.y[j], r.x[j + 1], r.y[j + 1]
        links = []
        for px, py in ((hax, hay), (hbx, hby)):
            d, qx, qy = _nearest(gax, gay, gbx, gby, px, py)
            links.append(np.stack([d, qx, qy, px, py], 1))
        for px, py in ((gax, gay), (gbx, gby)):
            d, qx, qy = _nearest(hax, hay, hbx, hby, px, py)
            links.append(np.stack([d, px, py, qx, qy], 1))
        dx, dy, ex, ey = gbx - gax, gby - gay, hbx - hax, hby - hay
        cross = dx * ey - dy * ex
        with np.errstate(divide="ignore", invalid="ignore"):
            t, u = ((hax - gax) * ey - (hay - gay) * ex) / cross, ((hax - gax) * dy - (hay - gay) * dx) / cross
        met = (cross != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
        mx, my = gax[met] + dx[met] * t[met], gay[met] + dy[met] * t[met]
        links = _least(_least(links[0], links[1]), _least(links[2], links[3]))
        links[met] = np.stack([np.zeros(len(mx)), mx, my, mx, my], 1)
        # only the nearest of a row are put in order
        edge = np.flatnonzero(np.append(True, o[1:] != o[:-1]))
        near = links[:, 0] == np.repeat(np.minimum.reduceat(links[:, 0], edge), np.diff(np.append(edge, len(o))))
        rows, best = _firsts(np.concatenate([rows, o[near]]), np.concatenate([best, links[near]]))
    out = np.full((len(l.n), 5), np.nan)
    out[rows] = best
    null = np.isnan(out[:, 0])
    none = np.zeros(len(null), bool)
    return pa.StructArray.from_arrays([pa.array(out[:, 0]), points(out[:, 1], out[:, 2], none), points(out[:, 3], out[:, 4], none)], ["d", "p", "q"], mask=pa.array(null))


def _middles(l: Lines) -> tuple[np.ndarray, np.ndarray]:
    """The centroid of each ring's area; its first point if it has none, and not a number if it has no points."""
    owner, first = l.segments()
    ox, oy = l.x[l.start[owner]], l.y[l.start[owner]]
    ax, ay, bx, by = l.x[first] - ox, l.y[first] - oy, l.x[first + 1] - ox, l.y[first + 1] - oy
    w = ax * by - bx * ay
    sums = []
    for v in ((ax + bx) * w, (ay + by) * w, w):
        step = np.zeros(len(l.x))
        step[first] = v
        sums.append(l.rows(l.running(step), 0.0))
    some = l.n > 0
    full = (sums[2] != 0) & some
    out = []
    for c, moment in ((l.x, sums[0]), (l.y, sums[1])):
        middle = np.full(len(l.n), np.nan)
        middle[some] = c[l.start[some]]
        middle[full] += moment[full] / (3 * sums[2][full])
        out.append(middle)
    return out[0], out[1]


def _centroid(ring: pa.Array) -> pa.Array:
    l = Lines(ring)
    return points(*_middles(l), l.n == 0)


def _label(polygon: pa.Array) -> pa.Array:
    polygon = polygon.combine_chunks() if isinstance(polygon, pa.ChunkedArray) else polygon
    n = polygon.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    l = Lines(polygon.flatten())
    owner, first = l.segments()
    cx, cy = np.full(len(n), np.nan), np.full(len(n), np.nan)
    cx[n > 0], cy[n > 0] = (c[(np.cumsum(n) - n)[n > 0]] for c in _middles(l))
    # the edges on the centroid's height, from left to right, two by two
    of = np.repeat(np.arange(len(n)), n)[owner]
    over = (l.y[first] > cy[of]) != (l.y[first + 1] > cy[of])
    i, of = first[over], of[over]
    xs = l.x[i] + (cy[of] - l.y[i]) * (l.x[i + 1] - l.x[i]) / (l.y[i + 1] - l.y[i])
    order = np.lexsort([xs, of])
    xs, of = xs[order], of[order]
    k = np.arange(len(of)) - np.searchsorted(of, of)
    left = np.flatnonzero((k % 2 == 0) & np.append(of[1:] == of[:-1], False)) if len(of) else np.zeros(0, np.int64)
    a, b, of = xs[left], xs[left + 1] if len(left) else xs[left], of[left]
    inside = np.ones(len(n), bool)
    inside[of] = False
    inside[of[(a < cx[of]) & (cx[of] < b)]] = True
    rows, widest = _firsts(of, np.stack([a - b, a, b], 1))
    x = cx.copy()
    x[rows] = np.where(inside[rows], cx[rows], (widest[:, 1] + widest[:, 2]) / 2)
    return points(x, cy, np.isnan(cy))


# arguments and results are Arrow arrays; a result is taken once, so no filter or projection repeats the work
def _udf(f, kind: str):
    def call(*columns):
        def task(*args: pa.Array) -> pa.Array:
            return f(*args)

        return F.arrow_udf(task, kind).asNondeterministic()(*columns)

    return call


interpolate_at = _udf(_interpolate, POINT)
#: (line, first, step, count, total, near): the places first + step * k, kept between 0 and total, with those `near` before and after.
stations = _udf(_stations, f"array<struct<k:int,base:{POINT},lo:{POINT},hi:{POINT}>>")
substring = _udf(_substring, f"array<{POINT}>")
convex_hull = _udf(_hull, f"array<{POINT}>")
oriented_envelope = _udf(_envelope, "struct<area:double,long:double,short:double,azimuth:double>")
connection = _udf(_connect, f"struct<d:double,p:{POINT},q:{POINT}>")
centroid = _udf(_centroid, POINT)
label_point = _udf(_label, POINT)
