"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Vectors are dealt into bands by length, each down to half of its longest, and put on a sphere: divided by the
band's greatest length, with one more component that makes up the rest; a query gets none and is stretched
to length 1. Then the nearest by distance are those of the largest inner product in the band. A query
visits all bands. Each of `tables` hash tables cuts `hashes` Gaussian projections into
cells of `width`; a query visits, in each table, its own cell and then others in the order of estimated
success, that is of the summed squared distances to the cell walls that lead there. The candidates of
all tables are merged and ranked by their exact inner products.

How far a query goes is measured, not assumed: some 192 queries are compared with all vectors first. The
share of the vectors that must lie in visited cells for them to meet `RECALL` of their nearest holds for all. The
number of `hashes`, which decides how small cells are, is the one that takes the least time by that measure; where
it takes less to visit all cells of one table, that is all vectors, that is done.

Vectors are sent once, dealt by their hash into parts that a task holds in memory with all its tables; the
queries go to each part in blocks. A cell is compared with all queries of a block that visit it at once, by a
product of matrices; only what may be among the nearest is scored exactly. No cell, however full, is cut short.

What is met counts from a score on that the measured queries suggest; a query with fewer than `k` such rows is
compared with all vectors, whatever their score, so that `k` return wherever there are as many others.

Equal vectors are one candidate, which stands for its least `k` + 1 ids: more can't be among the nearest.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor do
those whose length isn't the most common one; rows with equal id are one, with the least vector; a query
never finds itself; ties go to the smaller id.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.ship import ship
from tidemark.workspace import materialise

PART_BYTES = 96 << 20  # of vectors that a task holds, twice for a moment
LEAST_PART = 4096  # vectors; fewer aren't split for the sake of parallel tasks
BLOCK = 32768  # queries handed on at once
SAMPLE = 4096  # vectors that tell which share of all lies in the cells up to some cost
MEASURED = 192  # queries compared with all vectors beforehand
RECALL = 0.97  # of their nearest that the visited cells must hold
# Nanoseconds, as found on one core; only their ratios count.
PAIR = 2.7  # a vector and a query in a large product
VISIT = 7  # in that of a cell and the queries that visit it
LOOK = 5  # a cell and a query, visiting or not
CALL = 150_000  # a cell and a block of queries
SLACK = 12  # ranked beyond k before the exact ranking
PENDING = 1 << 20  # pairs that wait for a new bar

Batches = Iterator[pa.RecordBatch]


class Tables:
    """The hash functions."""

    def __init__(self, dim: int, tables: int, hashes: int, width: float, seed: int = 41):
        rng = np.random.default_rng(seed)
        self.tables, self.hashes, self.width = tables, hashes, width
        drawn = rng.standard_normal((dim + 1, tables * hashes))
        # Gaussian each, but at right angles to others as far as there is room: what one table misses another is likelier to meet.
        turned = [np.linalg.qr(drawn[:, a : a + dim + 1])[0] for a in range(0, drawn.shape[1], dim + 1)]
        self.directions = np.concatenate(turned, axis=1) * np.sqrt((drawn**2).sum(axis=0))
        self.offsets = rng.uniform(0, width, tables * hashes)
        self.codes = rng.integers(1, 2**63, (tables, hashes + 1), dtype=np.uint64) | np.uint64(1)

    def spots(self, x: np.ndarray, table: int) -> np.ndarray:
        """Projections of one table in units of cells: rows, hashes. Queries lack the last component."""
        own = slice(table * self.hashes, (table + 1) * self.hashes)
        return (x @ self.directions[: x.shape[1], own] + self.offsets[own]) / self.width

    def bucket(self, cells: np.ndarray, table: int, band: np.ndarray) -> np.ndarray:
        """A number for each cell of one table and band; cells: rows, hashes."""
        out = (cells.astype(np.int64).view(np.uint64) * self.codes[table, :-1]).sum(axis=1, dtype=np.uint64) + self.codes[table, -1]
        out += band.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(31)
        out *= np.uint64(0x9E3779B97F4A7C15)
        return (out ^ (out >> np.uint64(29))).view(np.int64)

    def probes(self, place: np.ndarray, count: int) -> np.ndarray:
        """Cells to visit, best first, for one query and table, by steps to next cells. place: hashes. `Cells` has the same order for many."""
        cell = np.floor(place)
        part = place - cell
        costs = np.concatenate([part**2, (1 - part) ** 2])  # to the cell below, to the cell above
        order = np.argsort(costs, kind="stable")
        cost = costs[order].tolist()
        which, delta = (order % self.hashes).tolist(), np.where(order < self.hashes, -1, 1).tolist()
        out = [cell]
        heap: list[tuple[float, tuple[int, ...]]] = [(cost[0], (0,))]
        while heap and len(out) < count:
            total, moves = heapq.heappop(heap)
            if len({which[m] for m in moves}) == len(moves):
                moved = cell.copy()
                for m in moves:
                    moved[which[m]] += delta[m]
                out.append(moved)
            last = moves[-1]
            if last + 1 < len(cost):
                heapq.heappush(heap, (total + cost[last + 1], (*moves, last + 1)))
                heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*moves[:-1], last + 1)))
        return np.stack(out)


class Cells:
    """Cells of one table that hold vectors."""

    def __init__(self, cells: np.ndarray):
        """cells: (cells, hashes)"""
        self.rows = cells
        self.low = cells.min(axis=0).astype(np.int64)
        span = cells.max(axis=0) - self.low + 1
        at = np.cumsum(span) - span
        self.hash = np.repeat(np.arange(cells.shape[1]), span)
        self.step = np.arange(span.sum()) - at[self.hash] + self.low[self.hash]
        self.chosen = np.zeros((len(cells), span.sum()), np.float32)
        self.chosen[np.arange(len(cells))[:, None], cells - self.low + at] = 1

    def walls(self, spots: np.ndarray) -> np.ndarray:
        """Squared distances of queries from each step of each hash: (steps, queries)."""
        place = spots.T[self.hash]
        away = np.maximum(0, np.maximum(self.step[:, None] - place, place - self.step[:, None] - 1))
        return (away**2).astype(np.float32)

    def costs(self, spots: np.ndarray) -> np.ndarray:
        """Summed squared distances to the walls that lead there: (queries, cells). spots: (queries, hashes)"""
        return self.walls(spots).T @ self.chosen.T


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _chunks(n: int, size: int) -> Iterator[slice]:
    return (slice(a, min(a + size, n)) for a in range(0, n, size))


def _hashed(x: np.ndarray) -> np.ndarray:
    """64 bits for each row."""
    codes = np.random.default_rng(7).integers(1, 2**63, x.shape[1], dtype=np.uint64) | np.uint64(1)
    out, bits = np.empty(len(x), np.uint64), np.dtype(f"u{x.itemsize}")
    for c in _chunks(len(x), 8192):
        mixed = x[c].view(bits).astype(np.uint64) * codes
        out[c] = (mixed ^ (mixed >> np.uint64(29))).sum(axis=1, dtype=np.uint64)
    out *= np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(32))


def _drawn(ids: np.ndarray, share: float, seed: int) -> np.ndarray:
    """True for about that share of the ids."""
    h = (ids.view(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(11)).astype(np.float64) < share * 2.0**53


def _alike(ids: np.ndarray, x: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in an order that puts equal vectors together, by id, and where each group starts."""
    order = np.lexsort((ids, hashed))
    same = np.zeros(len(ids), bool)
    at = np.flatnonzero(hashed[order[1:]] == hashed[order[:-1]]) + 1
    for c in _chunks(len(at), 8192):
        same[at[c]] = (x[order[at[c]]] == x[order[at[c] - 1]]).all(axis=1)
    return order, np.flatnonzero(~same)


def _few(ids: np.ndarray, x: np.ndarray, hashed: np.ndarray, most: int) -> np.ndarray:
    """Rows without those of a vector beyond its least `most` ids."""
    order, starts = _alike(ids, x, hashed)
    if len(starts) == len(ids):
        return np.arange(len(ids))
    nth = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
    return np.sort(order[nth < most])


PACK = "kind int, part int, ids binary, v binary"
VECTORS, QUERIES, SAMPLED, TRIED = range(4)


def _packing(parts: int, every: int, dtype: str, most: int, sampled: float, tried: float):
    def pack(kind: int, part: int, ids: np.ndarray, x: np.ndarray) -> list:
        return [kind, part, ids.tobytes(), x.tobytes()]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("id").to_numpy()
            x = np.ascontiguousarray(_matrix(batch.column("v")).astype(dtype) + np.dtype(dtype).type(0))  # no negative zeros
            rows = []
            asked = ids % every == 0
            for kind, these in ((QUERIES, asked), (TRIED, asked & _drawn(ids, tried, 3)), (SAMPLED, _drawn(ids, sampled, 5))):
                if these.any():
                    rows.append(pack(kind, -1, ids[these], x[these]))
            hashed = _hashed(x)
            keep = _few(ids, x, hashed, most)
            part = (hashed[keep] >> np.uint64(20)) % np.uint64(parts)
            keep = keep[np.argsort(part, kind="stable")]
            ends = np.cumsum(np.bincount(part.astype(np.int64), minlength=parts))
            for p, (a, b) in enumerate(zip([0, *ends.tolist()], ends.tolist())):
                if b > a:
                    rows.append(pack(VECTORS, p, ids[keep[a:b]], x[keep[a:b]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["kind", "part", "ids", "v"]
            )

    return run


def _unpacked(batch: pa.RecordBatch, dim: int, dtype: str, row: int) -> tuple[np.ndarray, np.ndarray]:
    ids, v = batch.column("ids")[row].as_buffer(), batch.column("v")[row].as_buffer()
    return np.frombuffer(ids, np.int64), np.frombuffer(v, dtype).reshape(-1, dim)


def _exact(q: np.ndarray, x: np.ndarray, qi: np.ndarray, xi: np.ndarray) -> np.ndarray:
    """Inner products of pairs, summed in double precision in the order of the components."""
    out = np.zeros(len(qi))
    for c in _chunks(len(qi), 16384):
        a, b = q[qi[c]].astype(np.float64), x[xi[c]].astype(np.float64)
        a *= b
        total = np.zeros(len(a))
        for j in range(a.shape[1]):
            total += a[:, j]
        out[c] = total
    return out


def _lengths(x: np.ndarray) -> np.ndarray:
    out = np.empty(len(x))
    for c in _chunks(len(x), 8192):
        out[c] = np.sqrt((x[c].astype(np.float64) ** 2).sum(axis=1))
    return out


def _first(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The rows of the best `k` of each query, in order."""
    order = np.lexsort((ids, -scores, q))
    q = q[order]
    return order[np.arange(len(q)) - np.searchsorted(q, q, "left") < k]


def _measuring(ids: np.ndarray, q: np.ndarray, k: int, dim: int, dtype: str):
    """The `k` nearest of a few queries among the rows of a task."""

    def run(batches: Batches) -> Batches:
        none = np.zeros(0, np.int64)
        at, found, scores, kept = none, none, np.zeros(0), np.zeros((0, dim), dtype)
        wide = q.astype(np.float64)
        for batch in batches:
            if not batch.num_rows:
                continue
            own, x = (np.concatenate(c) for c in zip(*(_unpacked(batch, dim, dtype, row) for row in range(batch.num_rows))))
            for c in _chunks(len(own), 8192):
                s = wide @ x[c].astype(np.float64).T
                s[ids[:, None] == own[c]] = -np.inf
                n = min(k, s.shape[1])
                top = np.argpartition(-s, n - 1, axis=1)[:, :n]
                at = np.append(at, np.repeat(np.arange(len(ids)), n))
                found = np.append(found, own[c][top].ravel())
                scores = np.append(scores, np.take_along_axis(s, top, 1).ravel())
                kept = np.concatenate([kept, x[c][top.ravel()]])
                best = _first(at, found, scores, k)
                at, found, scores, kept = at[best], found[best], scores[best], kept[best]
        real = scores > -np.inf
        v = [r.tobytes() for r in kept[real]]
        yield pa.RecordBatch.from_arrays([pa.array(at[real]), pa.array(found[real]), pa.array(scores[real]), pa.array(v, pa.binary())], ["q", "id", "score", "v"])

    return run


class Reach:
    """How far the queries go: measured on a few of them."""

    def __init__(self, tables: Tables, longest: float, sampled: np.ndarray):
        self.tables, self.longest = tables, longest
        sphere = _on_sphere(sampled, longest)
        self.cells = [Cells(np.floor(tables.spots(sphere, t)).astype(np.int64)) for t in range(tables.tables)]
        self.share = self.visited = None

    def held(self) -> float:
        """Cells of a table that hold vectors, estimated from those that hold one or two of the sample."""
        found = []
        for cells in self.cells:
            n = np.unique(cells.rows, axis=0, return_counts=True)[1]
            found.append(len(n) + (n == 1).sum() * ((n == 1).sum() - 1) / (2 * ((n == 2).sum() + 1)))
        return float(np.mean(found))

    def measure(self, queries: np.ndarray, at: np.ndarray, nearest: np.ndarray) -> None:
        """nearest: vectors that the queries of numbers `at` should find."""
        unit = queries / _lengths(queries)[:, None]
        sphere = _on_sphere(nearest, self.longest)
        least, held = np.ones(len(at)), []
        for t, cells in enumerate(self.cells):
            place = self.tables.spots(unit, t)
            held.append(np.sort(cells.costs(place), axis=1))
            to = np.floor(self.tables.spots(sphere, t))
            need = (np.maximum(0, np.maximum(to - place[at], place[at] - to - 1)) ** 2).sum(axis=1) + 1e-6
            for i, costs in enumerate(held[-1]):
                mine = at == i
                least[mine] = np.minimum(least[mine], np.searchsorted(costs, need[mine], "right") / len(costs))
        n = len(self.cells[0].rows)
        self.share = max(float(np.quantile(least, RECALL)), min(1.0, 8 / n))
        nth = self._nth()
        self.visited = sum(float((costs <= costs[:, nth : nth + 1] + 1e-6).mean()) for costs in held)

    def _nth(self) -> int:
        n = len(self.cells[0].rows)
        return min(n, math.ceil(self.share * n)) - 1

    def limits(self, unit: np.ndarray) -> np.ndarray:
        """The cost up to which a query visits cells: (queries, tables)."""
        out = np.empty((len(unit), self.tables.tables), np.float32)
        nth = self._nth()
        for t, cells in enumerate(self.cells):
            for c in _chunks(len(unit), 512):
                out[c, t] = np.partition(cells.costs(self.tables.spots(unit[c], t)), nth, axis=1)[:, nth] + 1e-6
        return out


def _bands(x: np.ndarray, longest: float) -> np.ndarray:
    """Halvings that a length needs from the longest; lengths that fall under a double's range share the last."""
    with np.errstate(divide="ignore", invalid="ignore"):
        band = np.floor(np.log2(longest / _lengths(x)))
    return np.clip(np.nan_to_num(band, nan=1000, posinf=1000), 0, 1000).astype(np.int64)


def _on_sphere(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors divided by the greatest length of their band, with their last component."""
    y = x.astype(np.float64) / longest * np.exp2(_bands(x, longest).astype(np.float64))[:, None]
    return np.column_stack([y, np.sqrt(np.maximum(0, 1 - (y**2).sum(axis=1)))])


def _reach(n: float, block: float, sampled: np.ndarray, asks: np.ndarray, at: np.ndarray, nearest: np.ndarray, longest: float, tables: int, width: float) -> Reach | None:
    """The hash functions that take the least time on parts of `n` vectors and blocks of so many queries, with what is
    measured; none if it takes less to compare all."""
    best, least = None, PAIR
    for hashes in range(2, 25):
        reach = Reach(Tables(sampled.shape[1], tables, hashes, width), longest, sampled)
        cells = reach.held() / n  # for each vector
        known = tables * cells * (LOOK + CALL / block)
        if known >= least:  # more hashes cut finer still
            break
        reach.measure(asks, at, nearest)
        cost = known + reach.visited * VISIT
        if cost < least:
            best, least = reach, cost
    return best


ASKED = "kind int, block bigint, ids binary, v binary, limits binary"


def _asking(reach: Reach | None, dim: int, dtype: str):
    """Queries in blocks, with their limits."""

    def block(ids: list[np.ndarray], q: list[np.ndarray]) -> Batches:
        ids, q = np.concatenate(ids), np.concatenate(q)
        for c in _chunks(len(ids), BLOCK):
            limits = reach.limits(q[c] / _lengths(q[c])[:, None]) if reach else np.zeros(0, np.float32)
            row = [[QUERIES], [int(ids[c][0])], [ids[c].tobytes()], [q[c].tobytes()], [limits.tobytes()]]
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds)], ["kind", "block", "ids", "v", "limits"])

    def run(batches: Batches) -> Batches:
        ids, q = [], []
        for batch in batches:
            for row in range(batch.num_rows):
                own, x = _unpacked(batch, dim, dtype, row)
                ids.append(own.copy())
                q.append(x.copy())
                if sum(map(len, ids)) >= BLOCK:
                    yield from block(ids, q)
                    ids, q = [], []
        if ids:
            yield from block(ids, q)

    return run


class _Part:
    """Vectors that a task holds, one of each equal ones, and the cells of all tables."""

    def __init__(self, ids: list[np.ndarray], x: list[np.ndarray], longest: float, tables: Tables | None, most: int):
        """Empties the lists, so that vectors are held twice at most."""
        own, packs = np.concatenate(ids), x
        ids.clear()
        x = np.concatenate(packs)
        packs.clear()
        order, starts = _alike(own, x, _hashed(x))
        if len(starts) < len(own):
            x = x[order[starts]]
        else:
            order = starts = np.arange(len(own))
        self.ids, self.starts = own[order], starts
        self.counts = np.minimum(np.diff(np.append(starts, len(own))), most)
        self.longest = longest
        self.band = np.concatenate([_bands(x[c], longest) for c in _chunks(len(x), 8192)])
        if self.band.any():  # longest first
            by = np.argsort(self.band, kind="stable")
            x, self.band, self.starts, self.counts = x[by], self.band[by], self.starts[by], self.counts[by]
        cells = [np.empty((len(x), tables.hashes), np.int16) for _ in range(tables.tables)] if tables else []
        for c in _chunks(len(x), 8192) if tables else ():
            sphere = _on_sphere(x[c], longest)
            for t, out in enumerate(cells):
                out[c] = np.floor(tables.spots(sphere, t))
        edges = [0, *(np.flatnonzero(self.band[1:] != self.band[:-1]) + 1).tolist(), len(x)]
        self.runs = [slice(a + c.start, a + c.stop) for a, b in zip(edges, edges[1:]) for c in _chunks(b - a, 512)]  # each of one band
        self.x, self.tables = x, []
        # A product may be off by so much, in units of the query's length times the longest: far more than rounding can do.
        self.unit = 1e-5 if x.dtype == np.float32 else 1e-12
        for t, out in enumerate(cells):
            key = tables.bucket(out, t, self.band)
            by = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.append(True, key[by[1:]] != key[by[:-1]]))
            ends = np.append(first[1:], len(by))
            self.tables.append((Cells(out[by[first]]), by.astype(np.int32), first.tolist(), ends.tolist()))
            cells[t] = None

    def search(self, own: np.ndarray, q: np.ndarray, limits: np.ndarray | None, functions: Tables | None, bar: float, k: int):
        """Rows of queries and vectors with their scores: all that can be among the `k` nearest and score `bar` at least."""
        norms = _lengths(q)
        with np.errstate(over="ignore", under="ignore"):
            unit = q.astype(np.float64) / norms[:, None]
            near = (unit / self.longest).astype(self.x.dtype)
        met = _Met(self, q, k + SLACK, bar)
        if len(self.x) > 4 * LEAST_PART and bar == -np.inf:  # a bar from some vectors first
            for run in self.runs[: LEAST_PART // 512]:
                met.meet(near, None, np.arange(run.start, run.stop), self.x[run])
            met.prune()
        if limits is None:
            for run in self.runs:
                met.meet(near, None, np.arange(run.start, run.stop), self.x[run])
        else:
            for t, (cells, by, first, ends) in enumerate(self.tables):
                walls = cells.walls(functions.spots(unit, t))
                for c in _chunks(len(first), 256):
                    visited = cells.chosen[c] @ walls <= limits[:, t]
                    for i in range(c.start, c.stop):
                        asks = np.flatnonzero(visited[i - c.start])
                        for a in range(first[i], ends[i], 512) if len(asks) else ():
                            own = by[a : min(a + 512, ends[i])]
                            met.meet(near, asks, own, self.x.take(own, axis=0))
        at, which = met.prune()
        scores = _exact(q, self.x, at, which)
        real = scores >= bar * norms[at] * self.longest if bar > -np.inf else np.ones(len(at), bool)
        return at[real], which[real], scores[real]


class _Met:
    """Pairs that can be among the best few of their queries, as far as known."""

    def __init__(self, part: _Part, q: np.ndarray, few: int, bar: float):
        self.part, self.q, self.few, self.least = part, q, few, bar
        self.bar = np.full(len(q), bar, part.x.dtype)
        self.parts, self.size, self.mark = [], 0, PENDING
        self.reach = 1.01 * np.exp2(-part.band.astype(np.float64))
        self.off = (part.unit * np.exp2(-part.band.astype(np.float64))).astype(part.x.dtype)
        self.even = not part.band.any()
        self.out, self.hit = np.empty(1 << 18, part.x.dtype), np.empty((1 << 18) + 8, bool)

    def meet(self, near: np.ndarray, asks: np.ndarray | None, by: np.ndarray, x: np.ndarray) -> None:
        """Vectors of one band, of numbers `by`, and all queries or those of numbers `asks`."""
        off = self.off[by[0]]
        if not self.even:  # those that the longest of the band can't help
            near_enough = self.bar <= self.reach[by[0]]
            asks = np.flatnonzero(near_enough) if asks is None else asks[near_enough[asks]]
        n = len(near) if asks is None else len(asks)
        for c in _chunks(n, max(64, (1 << 18) // len(by))):
            q = near[c] if asks is None else near.take(asks[c], axis=0)
            bar = self.bar[c] if asks is None else self.bar.take(asks[c])
            shape, size = (len(q), len(by)), len(q) * len(by)
            out, hit = self.out[:size], self.hit[: -(-size // 8) * 8]
            np.matmul(q, x.T, out=out.reshape(shape))
            hit[size:] = False
            np.greater_equal(out.reshape(shape), (bar - off)[:, None], out=hit[:size].reshape(shape))
            some = np.flatnonzero(hit.view(np.uint64) != 0)  # eight at once
            if len(some):
                at = (some[:, None] * 8 + np.arange(8)).ravel()
                at = at[hit[at]]
                who, which = np.divmod(at, len(by))
                who += c.start
                self.parts.append(((who if asks is None else asks[who]).astype(np.int32), by[which].astype(np.int32), out[at]))
                self.size += len(at)
                if self.size > self.mark:
                    self.prune()

    def prune(self) -> tuple[np.ndarray, np.ndarray]:
        """Drops what can't be among the best few and sets the bars to what the few have at least."""
        if not self.parts:
            return np.zeros(0, np.int32), np.zeros(0, np.int32)
        q, v, s = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        order = np.argsort((q.astype(np.int64) << 32) | v)  # one row for each pair
        q, v, s = q[order], v[order], s[order]
        new = np.append(True, (q[1:] != q[:-1]) | (v[1:] != v[:-1]))
        q, v, s = q[new], v[new], s[new]

        def nth(low: np.ndarray) -> np.ndarray:
            """The score of the last of the few for each query that has so many."""
            order = np.lexsort((-low, q))
            starts = np.searchsorted(q, np.arange(len(self.q)))
            full = np.flatnonzero(np.bincount(q, minlength=len(self.q)) >= self.few)
            bar = self.bar.copy()
            bar[full] = np.maximum(bar[full], low[order[starts[full] + self.few - 1]])
            return bar

        self.bar = nth(s - self.off[v])
        keep = s + self.off[v] >= self.bar[q]
        q, v, s = q[keep], v[keep], s[keep]
        if len(q) > 4 * self.few * len(self.q) + PENDING // 2:  # many that rounding can't tell apart
            best = _first(q, self.part.ids[self.part.starts[v]], _exact(self.q, self.part.x, q, v), self.few)
            q, v, s = q[best], v[best], s[best]
        self.parts, self.size = [(q, v, s)], len(q)
        self.mark = self.size + PENDING
        return q, v


FOUND = "block bigint, ids binary, counts binary, found binary, scores binary"
_FOUND = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary())


def _searching(functions: Tables | None, longest: float, bar: float, k: int, dim: int, dtype: str):
    """A part's vectors come before the blocks of queries."""

    def run(batches: Batches) -> Batches:
        ids, x, part = [], [], None
        for batch in batches:
            for row in range(batch.num_rows):
                own, v = _unpacked(batch, dim, dtype, row)
                if batch.column("kind")[row].as_py() == VECTORS:
                    ids.append(own.copy())
                    x.append(v.copy())
                    continue
                if part is None and ids:
                    part = _Part(ids, x, longest, functions, k + 1)
                if part is None:
                    continue
                limits = np.frombuffer(batch.column("limits")[row].as_buffer(), np.float32).reshape(-1, functions.tables) if functions else None
                at, which, scores = part.search(own, v, limits, functions, bar, k)
                n = part.counts[which]  # of equal vectors
                many = np.repeat(np.arange(len(at)), n)
                found = part.ids[part.starts[which][many] + np.arange(len(many)) - np.repeat(np.cumsum(n) - n, n)]
                at, scores = at[many], scores[many]
                other = found != own[at]
                at, found, scores = at[other], found[other], scores[other]
                best = _first(at, found, scores, k)
                counts = np.bincount(at[best], minlength=len(own)).astype(np.int32)
                out = [[batch.column("block")[row].as_py()], [own.tobytes()], [counts.tobytes()], [found[best].tobytes()], [scores[best].tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, _FOUND)], ["block", "ids", "counts", "found", "scores"])

    return run


def _merging(k: int, most: int):
    """Rows come sorted by block. A query with fewer than `most` gets one row, of rank 0."""

    def ranked(own: np.ndarray, parts: list) -> Batches:
        at, found, scores = (np.concatenate(c) for c in zip(*parts))
        best = _first(at, found, scores, k)
        at, found, scores = at[best], found[best], scores[best]
        counts = np.bincount(at, minlength=len(own))
        rank = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts) + 1
        full = counts[at] >= most
        at, found, scores, rank = at[full], found[full], scores[full], rank[full]
        short = own[counts < most]
        q = np.concatenate([own[at], short])
        rank = np.concatenate([rank, np.zeros(len(short), np.int64)]).astype(np.int32)
        found, scores = np.concatenate([found, short]), np.concatenate([scores, np.zeros(len(short))])
        for c in _chunks(len(q), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(v[c]) for v in (q, rank, found, scores)], ["query_id", "rank", "vec_id", "score"])

    def run(batches: Batches) -> Batches:
        key, own, parts = None, None, []
        for batch in batches:
            for row in range(batch.num_rows):
                block = batch.column("block")[row].as_py()
                if parts and block != key:
                    yield from ranked(own, parts)
                    parts = []
                counts, found, scores = (np.frombuffer(batch.column(c)[row].as_buffer(), t).copy() for c, t in (("counts", np.int32), ("found", np.int64), ("scores", np.float64)))
                key, own = block, np.frombuffer(batch.column("ids")[row].as_buffer(), np.int64).copy()
                parts.append((np.repeat(np.arange(len(own)), counts), found, scores))
                if sum(len(p[0]) for p in parts[1:]) > 2 * PENDING:
                    at, found, scores = (np.concatenate(c) for c in zip(*parts))
                    best = _first(at, found, scores, k)
                    parts = [(at[best], found[best], scores[best])]
        if parts:
            yield from ranked(own, parts)

    return run


def _usable(vectors: DataFrame) -> DataFrame:
    """id and v, with the table's precision if that is single, else double."""
    single = dict(vectors.dtypes)["embedding"] == "array<float>"
    v = F.col("embedding") if single else F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    )


def search(
    vectors: DataFrame, *, every: int, k: int = 20, tables: int = 8, width: float = 2.0
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by `every`, its `k` nearest."""
    spark = vectors.sparkSession
    ship(spark)
    rows = _usable(vectors)
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    sized = rows.select("id", F.size("v").alias("dim"), F.sqrt(square).alias("length"))
    seen = materialise(
        sized.groupBy("dim", "id").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("longest"), F.min("length").alias("shortest")), "seen"
    )
    size = seen.groupBy("dim").agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("n"), F.sum((F.col("id") % every == 0).cast("long")).alias("asked"),
        F.max("longest").alias("longest"), F.min("shortest").alias("shortest"),
    ).orderBy(F.desc("rows"), "dim").first()
    out = "query_id bigint, rank int, vec_id bigint, score double"
    if not size or not size["asked"] or size["n"] < 2:
        return spark.createDataFrame([], out)
    dim, n, longest = size["dim"], size["n"], size["longest"]
    rows = rows.filter(F.size("v") == dim)
    if size["rows"] > n:  # one row for each id
        twice = materialise(seen.filter((F.col("dim") == dim) & (F.col("n") > 1)).select("id"), "twice")
        least = rows.join(twice, "id", "left_semi").groupBy("id").agg(F.min("v").alias("v"))
        rows = rows.join(twice, "id", "left_anti").unionByName(least)

    # Single precision is only used where products can neither overflow nor vanish in it.
    single = dict(rows.dtypes)["v"] == "array<float>" and 1e-20 < size["shortest"] and longest < 1e15
    dtype = "<f4" if single else "<f8"
    bytes_ = n * dim * np.dtype(dtype).itemsize
    parallel = spark.sparkContext.defaultParallelism
    parts = max(-(-bytes_ // PART_BYTES), min(2 * parallel, -(-n // LEAST_PART)))
    packs = materialise(
        rows.mapInArrow(_packing(parts, every, dtype, k + 1, min(1.0, SAMPLE / n), min(1.0, MEASURED / size["asked"])), PACK), "packs", compression="none"
    )

    def drawn(kind: int) -> tuple[np.ndarray, np.ndarray]:
        got = packs.filter(F.col("kind") == kind).select("ids", "v").collect()
        ids = np.frombuffer(b"".join(r["ids"] for r in got), np.int64)
        x = np.frombuffer(b"".join(r["v"] for r in got), dtype).reshape(-1, dim)
        order = np.argsort(ids)
        return ids[order], x[order]

    tried, asks = drawn(TRIED)
    _, sampled = drawn(SAMPLED)
    sampled = np.unique(sampled, axis=0)
    blocks = max(-(-size["asked"] // BLOCK), min(parallel, -(-size["asked"] // 1024)))
    reach, bar = None, -math.inf
    held = packs.filter(F.col("kind") == VECTORS)
    if len(tried) and len(sampled):
        nearest = held.mapInArrow(_measuring(tried, asks, k, dim, dtype), "q bigint, id bigint, score double, v binary")
        first = Window.partitionBy("q").orderBy(F.desc("score"), "id")
        nearest = nearest.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k).select("q", "n", "score", "v").collect()
        at = np.array([r["q"] for r in nearest], np.int64)
        v = np.frombuffer(b"".join(r["v"] for r in nearest), dtype).reshape(-1, dim)
        reach = _reach(n / parts, size["asked"] / blocks, sampled, asks, at, v, longest, tables, width) if len(at) else None
        last = [r for r in nearest if r["n"] == k]
        if len(last) == len(tried):
            scores = np.array([r["score"] for r in last]) / (_lengths(asks)[[r["q"] for r in last]] * longest)
            bar = 2 * float(scores.min()) - float(np.median(scores)) - 1e-6
    most = min(k, n - 1)

    def found(packed: DataFrame, blocks: int, reach: Reach | None, bar: float, label: str) -> DataFrame:
        asked = packed.select("ids", "v").repartition(blocks).mapInArrow(_asking(reach, dim, dtype), ASKED)
        asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        both = held.withColumns({"block": F.lit(0).cast("long"), "limits": F.lit("").cast("binary")}).unionByName(asked)
        both = both.repartitionById(parts, F.col("part")).sortWithinPartitions("kind", "block")
        met = both.mapInArrow(_searching(reach.tables if reach else None, longest, bar, k, dim, dtype), FOUND)
        merged = met.repartition(blocks, "block").sortWithinPartitions("block").mapInArrow(_merging(k, most), out)
        return materialise(merged, label)

    by_cell = found(packs.filter(F.col("kind") == QUERIES), blocks, reach, bar, "ranked")
    short = by_cell.filter("rank = 0").select(F.col("query_id").alias("id"))
    n_short = short.count()
    if not n_short:
        return by_cell
    # The few that met fewer: compared with all.
    again = rows.join(short, "id", "left_semi").mapInArrow(_packing(1, every, dtype, k + 1, 0.0, 0.0), PACK).filter(F.col("kind") == QUERIES)
    return by_cell.filter("rank > 0").unionByName(found(again, -(-n_short // 1024), None, -math.inf, "ranked_all"))
