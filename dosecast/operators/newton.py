"""Huber regression with a joint scale by Newton steps on sums over rows.

    f(w, b, sigma) = sum(sigma + sigma H_eps(r / sigma)) + alpha |w|^2,   r = y - Xw - b,

is convex in all of (w, b, sigma).  A step needs sums over the rows only (value,
gradient and Hessian at one point, values at a few points along the line), so
rows may be dealt over tasks at will: ``State.sums`` is added up over the parts
of a group and ``State.advance`` takes the step.

At eps near 1 the scale of small groups goes to zero and f becomes a sum of
absolute values.  The scale is therefore kept above a floor that is lowered
tenfold each time its problem is solved, which follows the optimum down in few
steps; where the scale leaves the floor, its optimum is inside and the descent
is over.  At the last floor the rows within it are those that the limit fits
exactly; ``model`` fits them.

Along the line the best of several step lengths is taken; without any that
lowers f the Hessian's diagonal is raised.  Past ``LONG`` steps it is lowered again by
any that does, as rows near the kinks can keep it high and the steps short.

``solve`` takes the steps of one group.  ``solve_many`` takes those of many groups with
the same number of rows at once, by the same operations in the same order on each
group's numbers, so both give the same state to the last bit.
"""

from __future__ import annotations

import numpy as np

SIGMA_FLOOR = float(np.finfo(np.float64).eps * 10)
LENGTHS = np.concatenate([[0.0], 2.0 ** np.arange(-20, 0, dtype=float), 4.0 ** np.arange(1, 5, dtype=float)])
DROP = 0.1                  # of the floor at each level
LAST = 1e-7                 # the last floor, for targets of size 1
DAMPING = 1e-11
LONG = 200
_OPEN, _CONVERGED, _STOPPED = 0.0, 1.0, 2.0


class State:
    """A model on its way: ``x`` is (w, b, sigma), ``d`` the direction to try."""

    def __init__(self, k: int, largest: float):
        """``k``: features and the intercept; ``largest``: the largest absolute target."""
        self.scale = max(1.0, largest)
        self.x, self.d = np.zeros(k + 1), np.zeros(k + 1)
        self.x[k] = self.floor = 4 * self.scale
        self.f, self.rho, self.steps, self.end = np.inf, DAMPING, 0, _OPEN
        self.left = np.inf              # half the decrement of the last step
        self.fit = np.zeros(k)          # from x to the coefficients that fit the rows within the last floor

    def values(self) -> list[float]:
        return [self.scale, self.floor, self.f, self.rho, float(self.steps), self.end, self.left, *self.x, *self.d, *self.fit]

    @staticmethod
    def of(values) -> State:
        v = np.asarray(values, float)
        k = (len(v) - 9) // 3
        s = State(k, 1.0)
        s.scale, s.floor, s.f, s.rho, s.steps, s.end, s.left = v[0], v[1], v[2], v[3], int(v[4]), v[5], v[6]
        s.x, s.d, s.fit = v[7:8 + k].copy(), v[8 + k:9 + 2 * k].copy(), v[9 + 2 * k:].copy()
        return s

    @property
    def done(self) -> bool:
        return self.end != _OPEN

    @property
    def converged(self) -> bool:
        return self.end == _CONVERGED

    def model(self) -> tuple[np.ndarray, float]:
        """Coefficients (the intercept last) and scale."""
        k = len(self.x) - 1
        if self.x[k] <= self._last * (1 + 1e-6):
            return self.x[:k] + self.fit, SIGMA_FLOOR
        return self.x[:k].copy(), float(self.x[k])

    @property
    def _last(self) -> float:
        return LAST * self.scale

    def _at(self, t: float) -> np.ndarray:
        z = self.x + t * self.d
        z[-1] = max(z[-1], self.floor)
        return z

    def sums(self, A: np.ndarray, y: np.ndarray, eps: float) -> np.ndarray:
        """What a part of the rows adds: rows, f, gradient, Hessian at x + d, then f along the line."""
        def loss(s, a):
            return np.sum(s + np.where(a <= eps * s, a * a / s, 2 * eps * a - eps * eps * s))

        z = self._at(1.0)
        s, here, by = z[-1], y - A @ self.x[:-1], A @ self.d[:-1]
        r = y - A @ z[:-1]
        near = np.abs(r) <= eps * s
        v = np.where(near, 2 * r / s, 2 * eps * np.sign(r))
        k = A.shape[1]
        g = np.append(-(v @ A), np.sum(1 - v * v / 4))
        Ai, ri = A[near], r[near]
        H = np.zeros((k + 1, k + 1))
        H[:k, :k] = 2 / s * (Ai.T @ Ai)
        H[:k, k] = H[k, :k] = 2 / s ** 2 * (ri @ Ai)
        H[k, k] = 2 / s ** 3 * (ri @ ri)
        along = [loss(self._at(t)[-1], np.abs(here - t * by)) for t in LENGTHS] if self.d.any() else [np.inf] * len(LENGTHS)
        return np.concatenate([[len(y), loss(s, np.abs(r))], g, H[np.triu_indices(k + 1)], along])

    def advance(self, total: np.ndarray, eps: float, alpha: float, most: int) -> None:
        """Take a step by the sums over all rows at ``x + d``."""
        k = len(self.x) - 1
        self.steps += 1
        n, f, g = total[0], total[1], total[2:3 + k].copy()
        H = np.zeros((k + 1, k + 1))
        H[np.triu_indices(k + 1)] = total[3 + k:-len(LENGTHS)]
        H = H + np.triu(H, 1).T
        z = self._at(1.0)
        penalty = lambda p: alpha * float(p[:k - 1] @ p[:k - 1])
        f += penalty(z)
        slack = 2e-15 * (1 + abs(f))            # of rounding
        if self.d.any():
            along = total[-len(LENGTHS):] + [penalty(self._at(t)) for t in LENGTHS]
            best = int(np.argmin(along))
            if f > min(along[best], self.f) + slack:
                if along[best] < self.f - slack:
                    self.x, self.f = self._at(LENGTHS[best]), float(along[best])
                    if self.steps > LONG:
                        self.rho = max(self.rho / 10, DAMPING)
                elif self.rho > 1e3:
                    self.end = _STOPPED
                    return
                else:
                    self.rho *= 100
                self.d = np.zeros(k + 1)            # the sums at x come next
                self._stop(most)
                return
            self.rho = max(self.rho / 10, DAMPING)
        self.x, self.f = z, f
        within = H[:k, :k].copy()
        if self.x[k] <= self._last * (1 + 1e-6):
            s = self.x[k]
            self.fit = np.linalg.pinv(within * (s / 2), rcond=1e-12, hermitian=True) @ (H[:k, k] * (s * s / 2))
        g[:k - 1] += 2 * alpha * self.x[:k - 1]
        H[range(k - 1), range(k - 1)] += 2 * alpha
        self.d = self._direction(g, H, n, self.rho)
        left = abs(float(g @ self._direction(g, H, n, DAMPING))) / 2
        inside, last = self.x[k] > self.floor * (1 + 1e-9), self.floor <= self._last * (1 + 1e-6)
        final, small = inside or last, left / (1 + abs(f))
        # The end is refined while a step still lowers what is left tenfold.
        if small <= (1e-22 if final else 1e-6) or final and small <= 1e-15 and left > 0.1 * self.left:
            if final:
                self.end = _CONVERGED
                return
            self.floor = max(self.floor * DROP, self._last)
            self.f = np.inf                         # another problem: any value is lower
            self.d = self._along_floor(g, H, self.floor - self.x[k], DAMPING)
            self.x[k], self.d[k] = self.floor, 0.0
            left = np.inf
        self.left = left
        self._stop(most)

    def _stop(self, most: int) -> None:
        if self.steps >= most:
            self.end = _STOPPED

    def _direction(self, g: np.ndarray, H: np.ndarray, n: float, rho: float) -> np.ndarray:
        k = len(self.x) - 1
        s = self.x[k]
        if s <= self.floor * (1 + 1e-12) and g[k] >= 0:
            return self._along_floor(g, H, 0.0, rho)
        more = rho * np.array([np.trace(H[:k, :k]) / k + 2 / s] * k + [H[k, k] + n / s])
        d = np.linalg.solve(H + np.diag(more), -g)
        if H[k, k] <= 0 or s + d[k] < self.floor:
            return self._along_floor(g, H, self.floor - s if g[k] > 0 else s, rho)
        return d

    def _along_floor(self, g: np.ndarray, H: np.ndarray, by: float, rho: float) -> np.ndarray:
        """The step of the coefficients while the scale moves by ``by``."""
        k = len(self.x) - 1
        more = rho * (np.trace(H[:k, :k]) / k + 2 / self.x[k])
        return np.append(np.linalg.solve(H[:k, :k] + more * np.eye(k), -g[:k] - H[:k, k] * by), by)


def solve(parts: list[tuple[np.ndarray, np.ndarray]], eps: float, alpha: float, most: int = 20_000) -> State:
    """The model of rows given as parts ([X, 1], y)."""
    s = State(parts[0][0].shape[1], max((float(np.abs(y).max()) for _, y in parts if len(y)), default=0.0))
    while not s.done:
        s.advance(sum(s.sums(A, y, eps) for A, y in parts), eps, alpha, most)
    return s


def solve_many(A: np.ndarray, y: np.ndarray, eps: float, alpha: float, most: int = 20_000) -> np.ndarray:
    """``solve`` of each group of ``A`` [groups, rows, k] and ``y`` [groups, rows]: their ``State.values``, a row each."""
    out = np.empty((len(A), 9 + 3 * A.shape[2]))
    plain = np.isfinite(A).all(axis=(1, 2)) & (np.abs(y) < 1e50).all(axis=1) if A.shape[1] else np.zeros(len(A), bool)
    for i in np.flatnonzero(~plain):
        out[i] = solve([(A[i], y[i])], eps, alpha, most).values()
    if plain.any():
        out[plain] = _Many(np.ascontiguousarray(A[plain]), np.ascontiguousarray(y[plain])).solved(eps, alpha, most)
    return out


def models(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``State.model`` of each row of ``State.values``: coefficients (the intercept last) and scales."""
    k = (values.shape[1] - 9) // 3
    x, fit = values[:, 7:8 + k], values[:, 9 + 2 * k:]
    on = x[:, k] <= LAST * values[:, 0] * (1 + 1e-6)
    return np.where(on[:, None], x[:, :k] + fit, x[:, :k]), np.where(on, SIGMA_FLOOR, x[:, k])


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b for stacks of vectors."""
    return (a[..., None, :] @ b[..., :, None])[..., 0, 0]


class _Many:
    """The ``State`` of many groups with the same number of rows, one row of each array for a group."""

    SLICE = 1 << 14             # numbers of an array over rows and step lengths that are worked on at once

    def __init__(self, A: np.ndarray, y: np.ndarray):
        b, _, k = A.shape
        self.A, self.y, self.at = A, y, np.arange(b)
        self.scale = np.maximum(1.0, np.abs(y).max(axis=1))
        self.x, self.d, self.fit = np.zeros((b, k + 1)), np.zeros((b, k + 1)), np.zeros((b, k))
        self.floor = 4 * self.scale
        self.x[:, k] = self.floor
        self.f, self.rho, self.end, self.left = np.full(b, np.inf), np.full(b, DAMPING), np.full(b, _OPEN), np.full(b, np.inf)
        self.within, self.toward, self.fits = np.zeros((b, k, k)), np.zeros((b, k)), np.zeros(b, bool)     # what ``fit`` is found from
        self.steps = 0

    def solved(self, eps: float, alpha: float, most: int) -> np.ndarray:
        k = self.A.shape[2]
        out = np.empty((len(self.at), 9 + 3 * k))
        while len(self.at):
            self._advance(eps, alpha, most)
            done = self.end != _OPEN
            if not done.any():
                continue
            for i in np.flatnonzero(done & self.fits):
                self.fit[i] = np.linalg.pinv(self.within[i], rcond=1e-12, hermitian=True) @ self.toward[i]
            out[self.at[done]] = np.column_stack([
                self.scale[done], self.floor[done], self.f[done], self.rho[done], np.full(done.sum(), float(self.steps)),
                self.end[done], self.left[done], self.x[done], self.d[done], self.fit[done]])
            for name in ("A", "y", "at", "scale", "x", "d", "fit", "floor", "f", "rho", "end", "left", "within", "toward", "fits"):
                setattr(self, name, getattr(self, name)[~done])
        return out

    def _scales(self, t: np.ndarray) -> np.ndarray:
        """The scale at x + t d [groups, t]."""
        s = self.x[:, -1:] + t * self.d[:, -1:]
        return np.where(self.floor[:, None] > s, self.floor[:, None], s)

    def _along(self, here: np.ndarray, by: np.ndarray, eps: float) -> np.ndarray:
        """f without its penalty along the line [groups, step lengths]."""
        scales = self._scales(LENGTHS)
        out = np.empty(scales.shape)
        n = max(1, here.shape[1])
        many, few = max(1, self.SLICE // (n * len(LENGTHS))), max(1, min(len(LENGTHS), self.SLICE // n))
        for i in range(0, len(out), many):
            for j in range(0, len(LENGTHS), few):
                s = scales[i:i + many, j:j + few, None]
                a = LENGTHS[j:j + few, None] * by[i:i + many, None, :]
                np.subtract(here[i:i + many, None, :], a, out=a)
                np.abs(a, out=a)
                inside = a <= eps * s
                far = 2 * eps * a
                far -= eps * eps * s
                a *= a
                a /= s
                np.copyto(far, a, where=inside)
                far += s
                out[i:i + many, j:j + few] = far.sum(axis=2)
        return out

    def _advance(self, eps: float, alpha: float, most: int) -> None:
        A, y, x, d = self.A, self.y, self.x, self.d
        b, n, k = A.shape
        self.steps += 1
        # the sums at x + d, as ``State.sums``
        z = x + 1.0 * d
        z[:, k] = np.where(self.floor > z[:, k], self.floor, z[:, k])
        s = z[:, k]
        r = y - (A @ z[:, :k, None])[..., 0]
        a = np.abs(r)
        near = a <= (eps * s)[:, None]
        v = np.where(near, 2 * r / s[:, None], 2 * eps * np.sign(r))
        f = np.sum(s[:, None] + np.where(near, a * a / s[:, None], 2 * eps * a - (eps * eps * s)[:, None]), axis=1)
        g = np.empty((b, k + 1))
        g[:, :k] = 0 + -(v[:, None, :] @ A)[:, 0]
        g[:, k] = np.sum(1 - v * v / 4, axis=1)
        H = self._hessian(r, near, s)
        f = f + alpha * _times(z[:, :k - 1], z[:, :k - 1])
        slack = 2e-15 * (1 + np.abs(f))
        moved = d.any(axis=1)
        accept = np.ones(b, bool)
        if moved.any():
            here, by = y - (A @ x[:, :k, None])[..., 0], (A @ d[:, :k, None])[..., 0]
            points = x[:, None, :k - 1] + LENGTHS[:, None] * d[:, None, :k - 1]
            along = self._along(here, by, eps) + alpha * _times(points, points)
            best = np.argmin(along, axis=1)
            least = along[np.arange(b), best]
            reject = moved & (f > np.where(self.f < least, self.f, least) + slack)
            shorter = reject & (least < self.f - slack)
            stop = reject & ~shorter & (self.rho > 1e3)
            raised = reject & ~shorter & ~stop
            t = LENGTHS[best][:, None]
            to = x + t * d
            to[:, k] = np.where(self.floor > to[:, k], self.floor, to[:, k])
            if self.steps > LONG:
                self.rho = np.where(shorter, np.maximum(self.rho / 10, DAMPING), self.rho)
            self.rho = np.where(raised, self.rho * 100, self.rho)
            self.f = np.where(shorter, least, self.f)
            x[shorter] = to[shorter]
            self.end[stop] = _STOPPED
            d[shorter | raised] = 0.0
            accept = ~reject
            self.rho = np.where(accept & moved, np.maximum(self.rho / 10, DAMPING), self.rho)
        i = np.flatnonzero(accept)
        if len(i):
            x[i], self.f[i] = z[i], f[i]
            self._step(i, g[i], H[i], n, alpha)
        if self.steps >= most:
            self.end[self.end == _OPEN] = _STOPPED

    def _hessian(self, r: np.ndarray, near: np.ndarray, s: np.ndarray) -> np.ndarray:
        """Over the rows within the scale: the groups that have the same number of them at once."""
        b, _, k = self.A.shape
        H = np.zeros((b, k + 1, k + 1))
        number = near.sum(axis=1)
        by = np.argsort(number, kind="stable")
        for i in np.split(by, np.flatnonzero(np.diff(number[by])) + 1):
            m = number[i[0]]
            if not m:
                continue
            Ai, ri = self.A[i][near[i]].reshape(len(i), m, k), r[i][near[i]].reshape(len(i), m)
            H[i, :k, :k] = Ai.swapaxes(1, 2) @ Ai
            H[i, :k, k] = (ri[:, None, :] @ Ai)[:, 0]
            H[i, k, k] = _times(ri, ri)
        # powers of one number each, as an array's may be rounded otherwise
        square, cube = np.array([v ** 2 for v in s.tolist()]), np.array([v ** 3 for v in s.tolist()])
        H[:, :k, :k] *= (2 / s)[:, None, None]
        H[:, :k, k] *= (2 / square)[:, None]
        H[:, k, k] *= 2 / cube
        H[:, k, :k] = H[:, :k, k]
        return 0 + H

    def _step(self, i: np.ndarray, g: np.ndarray, H: np.ndarray, n: int, alpha: float) -> None:
        """What ``State.advance`` does at a new point, for the groups ``i``."""
        k = self.A.shape[2]
        x, floor, f = self.x[i], self.floor[i], self.f[i]
        last = LAST * self.scale[i]
        on = x[:, k] <= last * (1 + 1e-6)
        s, j = x[on, k], i[on]
        self.within[j] = H[on, :k, :k] * (s / 2)[:, None, None]
        self.toward[j] = H[on, :k, k] * (s * s / 2)[:, None]
        self.fits[j] = True
        g[:, :k - 1] += 2 * alpha * x[:, :k - 1]
        H[:, range(k - 1), range(k - 1)] += 2 * alpha
        d = self._direction(x, floor, g, H, n, self.rho[i])
        plain = d.copy()
        damped = np.flatnonzero(self.rho[i] != DAMPING)
        if len(damped):
            plain[damped] = self._direction(x[damped], floor[damped], g[damped], H[damped], n, np.full(len(damped), DAMPING))
        left = np.abs(_times(g, plain)) / 2
        final = (x[:, k] > floor * (1 + 1e-9)) | (floor <= last * (1 + 1e-6))
        small = left / (1 + np.abs(f))
        solved = (small <= np.where(final, 1e-22, 1e-6)) | final & (small <= 1e-15) & (left > 0.1 * self.left[i])
        end, down = solved & final, np.flatnonzero(solved & ~final)
        self.d[i] = d
        self.end[i[end]] = _CONVERGED
        if len(down):
            j = i[down]
            self.floor[j] = np.where(last[down] > floor[down] * DROP, last[down], floor[down] * DROP)
            self.f[j] = np.inf
            self.d[j] = self._along_floor(x[down], g[down], H[down], self.floor[j] - x[down, k], np.full(len(j), DAMPING))
            self.x[j, k] = self.floor[j]
            self.d[j, k] = 0.0
            left[down] = np.inf
        self.left[i[~end]] = left[~end]

    def _direction(self, x, floor, g, H, n, rho) -> np.ndarray:
        k = self.A.shape[2]
        s = x[:, k]
        trace = np.trace(H[:, :k, :k], axis1=1, axis2=2)
        at_floor = (s <= floor * (1 + 1e-12)) & (g[:, k] >= 0)
        d, free = np.empty_like(x), np.flatnonzero(~at_floor)
        by = np.zeros(len(x))
        if len(free):
            h, t = H[free], s[free]
            more = rho[free][:, None] * np.column_stack([trace[free] / k + 2 / t] * k + [h[:, k, k] + n / t])
            h[:, range(k + 1), range(k + 1)] += more
            d[free] = np.linalg.solve(h, -g[free][..., None])[..., 0]
            low = free[(H[free, k, k] <= 0) | (t + d[free, k] < floor[free])]
            by[low] = np.where(g[low, k] > 0, floor[low] - s[low], s[low])
            at_floor[low] = True
        i = np.flatnonzero(at_floor)
        if len(i):
            d[i] = self._along_floor(x[i], g[i], H[i], by[i], rho[i])
        return d

    def _along_floor(self, x, g, H, by, rho) -> np.ndarray:
        k = self.A.shape[2]
        h = H[:, :k, :k].copy()
        more = rho * (np.trace(h, axis1=1, axis2=2) / k + 2 / x[:, k])
        h[:, range(k), range(k)] += more[:, None]
        return np.column_stack([np.linalg.solve(h, (-g[:, :k] - H[:, :k, k] * by[:, None])[..., None])[..., 0], by])
