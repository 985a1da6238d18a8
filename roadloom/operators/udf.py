"""Algorithms without a relational form, as grouped Arrow or Pandas functions.

Each works on one track, one segment's bounded sample, or one connected piece of a network.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Matching

# --- natural breaks -------------------------------------------------------------------


def jenks(values: np.ndarray, k: int) -> list[float]:
    """Natural breaks of k classes: minimum, then the maximum of each class.

    Dynamic programme over sorted distinct values with weights; divide and conquer on the
    monotone split point, O(k n log n). Fewer distinct values than classes: equal widths.
    """
    v, w = np.unique(np.asarray(values, float), return_counts=True)
    n = len(v)
    if n == 0:
        return []
    if n < k:
        return [float(v[0] + i * (v[-1] - v[0]) / k) for i in range(k + 1)]
    centre = v - v.mean()
    s0, s1, s2 = (np.concatenate([[0], np.cumsum(x)]) for x in (w, w * centre, w * centre**2))

    def cost(i, j):  # of v[i:j]
        return s2[j] - s2[i] - (s1[j] - s1[i]) ** 2 / (s0[j] - s0[i])

    best = np.array([np.inf] + [cost(0, j) for j in range(1, n + 1)])
    cuts = []
    for c in range(2, k + 1):
        new, arg = np.full(n + 1, np.inf), np.zeros(n + 1, int)
        todo = [(c, n, c - 1, n - 1)]
        while todo:
            lo, hi, a, b = todo.pop()
            if lo > hi:
                continue
            mid = (lo + hi) // 2
            i = np.arange(a, min(mid - 1, b) + 1)
            total = best[i] + cost(i, mid)
            m = int(total.argmin())
            new[mid], arg[mid] = total[m], i[m]
            todo += [(lo, mid - 1, a, arg[mid]), (mid + 1, hi, arg[mid], b)]
        best = new
        cuts.append(arg)
    ends, j = [], n
    for arg in reversed(cuts):
        j = int(arg[j])
        ends.append(j)
    return [float(v[0]), *[float(v[e - 1]) for e in reversed(ends)], float(v[-1])]


def natural_breaks(samples: DataFrame, key: str, x: str, k: int) -> DataFrame:
    """key and breaks (array<double>); samples must be bounded per key (see density_sample)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({key: [pdf[key].iloc[0]], "breaks": [jenks(pdf[x].to_numpy(), k)]})

    return samples.select(key, x).groupBy(key).applyInPandas(run, f"{key} {dict(samples.dtypes)[key]}, breaks array<double>")


def lane_search(values: np.ndarray, tagged: int | None, manual: int | None, link: bool, config: Matching = Matching()) -> tuple[int, list[float], str]:
    """(lanes, bounds, how): the first lane count whose class widths are all plausible.

    The search starts from the values' width over that of a lane, rounded; for links with a
    tagged count, from that. A manual count or a link's start is taken as it is; a single lane
    tries two and three at widths 1.6 to 4.5 m; others try k0 to k0 + 2 and then k0 - 1 and
    k0 - 2 at 1.75 to 4.5 m. One lane is the whole width. Too few values give an even grid.
    """
    values = np.asarray(values, float)
    if len(values) <= config.min_points:
        n = manual or max(1, tagged or 1)
        return n, [i * config.lane_width for i in range(n + 1)], "grid"
    low, high = float(values.min()), float(values.max())

    def bounds(k: int) -> list[float]:
        return [low, high] if k <= 1 else jenks(values, k)

    k0 = max(1, tagged if link and tagged else round((high - low) / config.lane_width))
    if manual or link:
        return manual or k0, bounds(manual or k0), "manual" if manual else "link"
    options, least = ([2, 3], 1.6) if k0 == 1 else ([k0, k0 + 1, k0 + 2, k0 - 1, k0 - 2], 1.75)
    for k in options:
        if k >= 1:
            found = jenks(values, k)
            if all(least <= b - a <= 4.5 for a, b in zip(found, found[1:], strict=False)):
                return k, found, "search"
    return k0, bounds(k0), "single" if k0 == 1 else "failed"


def detected_lanes(samples: DataFrame, defined: DataFrame, config: Matching = Matching()) -> DataFrame:
    """segment_id, lanes, bounds, how. samples: segment_id, D (bounded per segment); defined:
    segment_id, lanes, manual, is_link."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        manual = None if pd.isna(first["manual"]) else int(first["manual"])
        lanes, bounds, how = lane_search(pdf["D"].to_numpy(), None if pd.isna(first["lanes"]) else int(first["lanes"]), manual, bool(first["is_link"]), config)
        return pd.DataFrame({"segment_id": [first["segment_id"]], "lanes": [lanes], "bounds": [bounds], "how": [how]})

    facts = defined.select("segment_id", "lanes", "manual", "is_link")
    return samples.select("segment_id", "D").join(facts, "segment_id").groupBy("segment_id").applyInPandas(run, "segment_id string, lanes int, bounds array<double>, how string")


# --- map matching ---------------------------------------------------------------------


def viterbi(dist: list[np.ndarray], u: list[np.ndarray], v: list[np.ndarray], noise: float) -> list[int]:
    """The likeliest candidate of each point; ends where no candidate can follow.

    Emission: a normal density of the distance. Transition: staying on an edge costs
    nothing, going on to a following edge a little, anything else is not possible.
    """
    if not dist or not len(dist[0]):
        return []
    score, back = -0.5 * (dist[0] / noise) ** 2, []
    for i in range(1, len(dist)):
        if not len(dist[i]):
            break
        stay = (u[i - 1][:, None] == u[i][None]) & (v[i - 1][:, None] == v[i][None])
        move = v[i - 1][:, None] == u[i][None]
        step = score[:, None] + np.where(stay, 0.0, np.where(move, -0.7, -np.inf))
        prev = step.argmax(0)
        new = step[prev, np.arange(step.shape[1])] - 0.5 * (dist[i] / noise) ** 2
        if not np.isfinite(new).any():
            break
        back.append(prev)
        score = new
    out = [int(score.argmax())]
    for prev in reversed(back):
        out.append(int(prev[out[-1]]))
    return out[::-1]


def matched(candidates: DataFrame, noise: float = 20.0, first: float = 5.0, most: float = 50.0, step: float = 5.0) -> DataFrame:
    """track_id, row_id, segment_id, station, offset, dist of the likeliest path.

    candidates: track_id, t, row_id, segment_id, u, v, dist, station, offset (a grid join
    within ``most``). The radius grows by ``step`` until a track's whole path is matched; at
    ``most`` the matched beginning is kept.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["t", "row_id", "dist", "segment_id"], kind="stable")
        dist, u, v = (pdf[c].to_numpy() for c in ("dist", "u", "v"))
        row = pdf["row_id"].to_numpy()
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        ends = np.r_[starts[1:], len(row)]
        radius, path = first, []
        while True:
            # distances ascend within a point, so what is in reach is a prefix
            near = [slice(a, a + int(np.searchsorted(dist[a:b], radius, "right"))) for a, b in zip(starts, ends, strict=True)]
            path = viterbi([dist[x] for x in near], [u[x] for x in near], [v[x] for x in near], noise)
            if len(path) == len(starts) or radius >= most:
                break
            radius = min(most, radius + step)
        return pdf.iloc[[a + i for a, i in zip(starts, path, strict=False)]][["track_id", "row_id", "segment_id", "station", "offset", "dist"]]

    return candidates.groupBy("track_id").applyInPandas(run, "track_id string, row_id long, segment_id string, station double, offset double, dist double")


# --- hulls --------------------------------------------------------------------------


def hull(points: np.ndarray) -> np.ndarray:
    """Convex hull of points, counter-clockwise."""
    p = sorted(map(tuple, np.unique(points, axis=0)))
    if len(p) < 3:
        return np.array(p)

    def half(seq):
        out = []
        for q in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(q)
        return out[:-1]

    return np.array(half(p) + half(p[::-1]))


def convex_hulls(points: DataFrame, key: str) -> DataFrame:
    """key, n, area of the hull of each key's points (x, y)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        h = hull(pdf[["x", "y"]].to_numpy())
        area = abs((h[:, 0] * np.roll(h[:, 1], -1) - np.roll(h[:, 0], -1) * h[:, 1]).sum()) / 2 if len(h) > 2 else 0.0
        return pd.DataFrame({key: [pdf[key].iloc[0]], "n": [len(h)], "area": [float(area)]})

    return points.select(key, "x", "y").distinct().groupBy(key).applyInPandas(run, f"{key} {dict(points.dtypes)[key]}, n int, area double")


# --- greedy merges on one network -----------------------------------------------------


def merge_short(edges: DataFrame, piece: str, most: float) -> DataFrame:
    """(segment_id, into, length): junction segments up to ``most`` long are merged into the
    neighbour that turns least, in the order of their ids; each neighbour takes one at most,
    and a segment that has taken one is not merged itself.

    One task per connected piece: each choice depends on the choices before it.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("segment_id")
        rows = {r.segment_id: r for r in pdf.itertuples()}
        by_u, by_v = {}, {}
        for r in pdf.itertuples():
            by_u.setdefault(r.u, []).append(r.segment_id)
            by_v.setdefault(r.v, []).append(r.segment_id)
        used, into = set(), {}
        for s, r in rows.items():
            if not r.is_junction or r.length > most or s in used:
                continue
            near = [(abs((rows[o].h_in - r.h_out + 180) % 360 - 180), o) for o in by_u.get(r.v, []) if rows[o].v != r.u] + [(abs((r.h_in - rows[o].h_out + 180) % 360 - 180), o) for o in by_v.get(r.u, []) if rows[o].u != r.v]
            near = [x for x in near if x[1] not in used and x[1] not in into and not rows[x[1]].is_junction]
            if near:
                best = min(near)[1]
                into[s] = best
                used.add(best)
        out = [(s, o, rows[s].length + rows[o].length) for s, o in into.items()]
        return pd.DataFrame(out, columns=["segment_id", "into", "length"])

    return edges.select(piece, "segment_id", "u", "v", "length", "is_junction", "h_in", "h_out").groupBy(piece).applyInPandas(run, "segment_id string, into string, length double")


def merge_pairs(edges: DataFrame, piece: str) -> DataFrame:
    """(a, b): junction segments that follow each other, exactly one of them by shape, are
    paired in the order of their ids, each at most once. One task per connected piece."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[pdf["is_junction"]].sort_values("segment_id")
        by_u: dict = {}
        for r in pdf.itertuples():
            by_u.setdefault(r.u, []).append(r)
        used, out = set(), []
        for r in pdf.itertuples():
            if r.segment_id in used:
                continue
            for o in by_u.get(r.v, []):
                if o.segment_id not in used and o.segment_id != r.segment_id and o.v != r.u and bool(o.is_shape) != bool(r.is_shape):
                    used |= {r.segment_id, o.segment_id}
                    out.append((r.segment_id, o.segment_id))
                    break
        return pd.DataFrame(out, columns=["a", "b"])

    return edges.select(piece, "segment_id", "u", "v", "is_junction", "is_shape").groupBy(piece).applyInPandas(run, "a string, b string")


# --- closed shapes --------------------------------------------------------------------


def bridges(links: set[tuple]) -> set[tuple]:
    """The links (a < b) of a simple graph that lie on no cycle. Iterative depth-first search."""
    near: dict = {}
    for a, b in links:
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)
    seen, low, out = {}, {}, set()
    for root in sorted(near):
        if root in seen:
            continue
        seen[root] = low[root] = len(seen)
        stack = [(root, None, iter(near[root]))]
        while stack:
            node, parent, rest = stack[-1]
            for other in rest:
                if other == parent:
                    continue
                if other in seen:
                    low[node] = min(low[node], seen[other])
                else:
                    seen[other] = low[other] = len(seen)
                    stack.append((other, node, iter(near[other])))
                    break
            else:
                stack.pop()
                if parent is not None:
                    low[parent] = min(low[parent], low[node])
                    if low[node] > seen[parent]:
                        out.add((min(node, parent), max(node, parent)))
    return out


def closed_shapes(edges: DataFrame, piece: str) -> DataFrame:
    """(segment_id, is_closed): whether a segment lies on a closed way that doesn't go back
    between the same two nodes. One task for each connected piece (of junction segments)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pairs = [(min(a, b), max(a, b)) for a, b in zip(pdf["u"].tolist(), pdf["v"].tolist(), strict=True)]
        open_links = bridges({p for p in pairs if p[0] != p[1]})
        return pd.DataFrame({"segment_id": pdf["segment_id"], "is_closed": [p not in open_links for p in pairs]})

    return edges.select(piece, "segment_id", "u", "v").groupBy(piece).applyInPandas(run, "segment_id string, is_closed boolean")
