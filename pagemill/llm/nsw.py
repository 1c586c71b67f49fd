"""Navigable small-world graphs over 64-bit codes under Hamming distance, in numpy.

The codes are sorted once under each of ``ORDERS`` rotations of their bits. Points that are near share
a run of bits and stand side by side in some of these orders, so the nearest of a point's neighbours in
all orders become its links, without a search for each point that is inserted; a bounded number of
reverse links (the nearest) and some long links, over a half to a hundredth of an order, are added. The
orders are also the entry layer: a search begins at the places of the query in them, so beams start near
their goal and need not grow with the graph.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

LINKS = 20
REVERSE = 8
LONG = 4
DEGREE = LINKS + REVERSE + LONG
ORDERS = 16
#: Neighbours on each side in an order that may become links.
BESIDE = 3
EXPAND = 4
_FREE = np.int64(255) << 32


def rotated(codes: np.ndarray, order: int) -> np.ndarray:
    by = np.uint64(64 * order // ORDERS)
    return (codes << by) | (codes >> (np.uint64(64) - by)) if by else codes


def sorted_orders(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per order the rotated codes, sorted, and their points."""
    out = []
    for r in range(ORDERS):
        key = rotated(codes, r)
        p = np.argsort(key)
        out.append((key[p], p.astype(np.int32)))
    return out


@dataclass
class Graph:
    codes: np.ndarray  # uint64 (n,)
    links: np.ndarray  # int32 (n, DEGREE), -1 where free
    beam: int = 32
    orders: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list, repr=False)

    def __post_init__(self) -> None:
        if not self.orders:
            self.orders = sorted_orders(self.codes)

    def to_bytes(self) -> tuple[bytes, bytes]:
        """Codes and links, the latter in 16 bits where that is enough (0xFFFF where free)."""
        return self.codes.tobytes(), (self.links.astype(np.uint16) if len(self.codes) < 0xFFFF else self.links).tobytes()

    @staticmethod
    def from_bytes(codes: bytes, links: bytes, beam: int) -> Graph:
        c = np.frombuffer(codes, np.uint64)
        if len(c) >= 0xFFFF:
            return Graph(c, np.frombuffer(links, np.int32).reshape(len(c), DEGREE), beam)
        small = np.frombuffer(links, np.uint16).reshape(len(c), DEGREE)
        return Graph(c, np.where(small == 0xFFFF, -1, small.astype(np.int32)), beam)


def _where(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """np.nonzero of a table, at a third of its cost where few entries are set."""
    return np.divmod(np.flatnonzero(hit), hit.shape[1]) if hit.size else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _once(found: np.ndarray, keep: int) -> np.ndarray:
    """Of each row of (distance << 32 | point) the ``keep`` least, each once; 255 << 32 where there are fewer."""
    found.sort(axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = _FREE
    found.sort(axis=1)
    if found.shape[1] < keep:
        found = np.concatenate([found, np.full((len(found), keep - found.shape[1]), _FREE)], axis=1)
    return found[:, :keep]


def search(g: Graph, queries: np.ndarray, beam: int, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Beam search of all queries at once: every visited (query, point) within the radius, exactly
    measured. Points outside the beam count too; a pair may come more than once."""
    n, q = len(g.codes), len(queries)
    near: list[tuple[np.ndarray, np.ndarray]] = []
    # entries: ``beam`` points on each side of the query's place in every order
    w = min(n, 2 * beam)
    found = np.empty((q, ORDERS * w), dtype=np.int64)
    for r, (key, point) in enumerate(g.orders):
        mine = rotated(queries, r)
        at = np.clip(np.searchsorted(key, mine) - beam, 0, n - w)[:, None] + np.arange(w)
        found[:, r * w : (r + 1) * w] = (np.bitwise_count(key[at] ^ mine[:, None]).astype(np.int64) << 32) | point[at]
    row, col = _where(found < np.int64(radius + 1) << 32)
    near.append((row, found[row, col] & 0xFFFFFFFF))
    # a point stands in an order once, so some ORDERS of the nearest may be one point
    few = min(3 * beam, found.shape[1])
    found = _once(np.partition(found, few - 1, axis=1)[:, :few], beam)
    dist = (found >> 32).astype(np.int16)
    ids = np.where(dist < 255, found & 0xFFFFFFFF, -1).astype(np.int32)
    done = ids < 0
    live = np.arange(q)
    e = min(EXPAND, beam)
    while len(live):
        # the EXPAND nearest points of each beam that are not expanded yet
        open_ = np.where(done, 255, dist)
        best = np.argpartition(open_, e - 1, axis=1)[:, :e]
        ok = np.take_along_axis(open_, best, axis=1) < 255
        alive = ok.any(axis=1)
        if not alive.all():
            live, best, ok, ids, dist, done = (x[alive] for x in (live, best, ok, ids, dist, done))
            if not len(live):
                break
        src = np.take_along_axis(ids, best, axis=1)
        np.put_along_axis(done, best, True, axis=1)
        nb = g.links[np.where(ok, src, -1)].reshape(len(live), -1)  # a beam without open points left repeats others
        worst = dist.max(axis=1)
        row, col = _where(np.bitwise_count(g.codes[nb] ^ queries[live][:, None]) < np.maximum(worst, radius + 1).astype(np.uint8)[:, None])
        point = nb[row, col]
        row, point = row[point >= 0], point[point >= 0]
        d = np.bitwise_count(g.codes[point] ^ queries[live[row]])
        near.append((live[row[d <= radius]], point[d <= radius]))
        fresh = (d < worst[row]) & ~(ids[row] == point[:, None]).any(axis=1)
        row, point, d = row[fresh], point[fresh], d[fresh]
        if not len(row):
            continue
        # a point may be linked from several expanded ones
        _, once = np.unique(row * n + point, return_index=True)
        row, point, d = row[once], point[once], d[once]
        count = np.bincount(row, minlength=len(live))
        most = int(count.max())
        at = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        new_ids = np.full((len(live), most), -1, dtype=np.int32)
        new_dist = np.full((len(live), most), 255, dtype=np.int16)
        new_ids[row, at] = point
        new_dist[row, at] = d
        all_ids = np.concatenate([ids, new_ids], axis=1)
        all_dist = np.concatenate([dist, new_dist], axis=1)
        all_done = np.concatenate([done, new_ids < 0], axis=1)
        keep = np.argpartition(all_dist, beam - 1, axis=1)[:, :beam]
        ids, dist, done = (np.take_along_axis(x, keep, axis=1) for x in (all_ids, all_dist, all_done))
    return near


def build(codes: np.ndarray) -> Graph:
    """A graph of distinct codes, in the order given. Empty input gives an empty graph."""
    n = len(codes)
    orders = sorted_orders(codes)
    links = np.full((n, DEGREE), -1, dtype=np.int32)
    found = np.full((n, 2 * BESIDE * ORDERS), _FREE, dtype=np.int64)
    for r, (key, p) in enumerate(orders):
        for o in range(1, min(BESIDE, n - 1) + 1):
            d = np.bitwise_count(key[o:] ^ key[:-o]).astype(np.int64) << 32
            at = 2 * (r * BESIDE + o - 1)
            found[p[:-o], at], found[p[o:], at + 1] = d | p[o:], d | p[:-o]
    found = _once(found, LINKS)
    links[:, :LINKS] = to = np.where(found < _FREE, found & 0xFFFFFFFF, -1)
    # reverse links, the nearest, where the point has no link of its own
    last = found[:, -1]
    src, col = _where((to >= 0) & (((found >> 32 << 32) | np.arange(n)[:, None]) > last[to]))
    dst = to[src, col]
    by = np.argsort((dst << 8) | (found[src, col] >> 32), kind="stable")
    src, dst = src[by], dst[by]
    count = np.bincount(dst, minlength=n)
    at = np.arange(len(dst)) - np.repeat(np.cumsum(count) - count, count)
    take = at < REVERSE
    links[dst[take], LINKS + at[take]] = src[take]
    for k in range(LONG):
        if far := n >> (2 * k + 1):
            p = orders[k * ORDERS // LONG][1]
            links[p, LINKS + REVERSE + k] = np.roll(p, far)
    return Graph(codes, links, orders=orders)


def probes(codes: np.ndarray, radius: int, count: int, seed: int = 5) -> np.ndarray:
    """Stated test queries: points of the graph with 1 to ``radius`` random bits flipped."""
    rng = np.random.default_rng(seed)
    out = codes[rng.integers(0, len(codes), count)].copy()
    flips = rng.integers(1, radius + 1, count)
    bits = rng.permuted(np.tile(np.arange(64, dtype=np.uint64), (count, 1)), axis=1)
    for k in range(radius):
        out ^= np.where(k < flips, np.uint64(1) << bits[:, k], np.uint64(0))
    return out


def tune(g: Graph, radius: int, target: float = 0.998, count: int = 2048, most: int = 512) -> tuple[int, float]:
    """The smallest beam (8, 12, 18 and so on) whose recall of the points within ``radius`` of
    the test queries, found by exhaustive search, reaches the target; and that recall. Where no beam
    up to ``most`` does, the beam is 0, which stands for exhaustive search of the graph's codes."""
    n = len(g.codes)
    if not n:
        return 32, 1.0
    q = probes(g.codes, radius, count)
    truth = len(exhaustive(g.codes, q, radius)[0])
    beam = 8
    while beam <= most:
        beam = min(beam, n)
        recall = len(neighbours(g, q, radius, beam)[0]) / max(1, truth)  # measured, so all are true
        if recall >= target:
            return beam, recall
        if beam == n:
            break
        beam += beam // 2
    return 0, 1.0


def exhaustive(codes: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All (query, point) pairs within the radius, by blocks that stay in a core's cache."""
    rows, points = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a in range(0, len(queries), 64):
        for b in range(0, len(codes), 8192):
            i, j = _where(np.bitwise_count(queries[a : a + 64, None] ^ codes[None, b : b + 8192]) <= radius)
            rows.append(i + a)
            points.append(j + b)
    return np.concatenate(rows), np.concatenate(points)


def neighbours(g: Graph, queries: np.ndarray, radius: int, beam: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(query, point) pairs within the radius that the search visits, exactly measured, each once."""
    n, beam = len(g.codes), g.beam if beam is None else beam
    if not beam:
        return exhaustive(g.codes, queries, radius)
    rows, points = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if n:
        step = max(16, 32_768 // beam)  # the entries of a step stay below 10 MB
        for a in range(0, len(queries), step):
            for r, p in search(g, queries[a : a + step], min(n, beam), radius):
                rows.append(r + a)
                points.append(p.astype(np.int64))
    return np.divmod(np.unique(np.concatenate(rows) * n + np.concatenate(points)), max(1, n))
