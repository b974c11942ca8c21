"""Plain single-machine forms of the grid and track operators, for small inputs only."""

import math
from collections import deque

import numpy as np


def smooth(frame, kernel):
    """Separable weights with mirrored borders; NaN counts as the mean and comes back as NaN."""
    gaps = np.isnan(frame)
    work = np.where(gaps, np.nanmean(frame), frame)
    reach = len(kernel) // 2
    for axis in (0, 1):
        padded = np.pad(work, [(reach, reach) if a == axis else (0, 0) for a in (0, 1)], mode="symmetric")
        work = np.apply_along_axis(lambda line: np.convolve(line, kernel, mode="valid"), axis, padded)
    work[gaps] = np.nan
    return work


def regions(mask):
    """Lists of cells (iy, ix), in the order of their first cell."""
    seen, found = set(), []
    ny, nx = mask.shape
    for start in zip(*np.nonzero(mask)):
        start = (int(start[0]), int(start[1]))
        if start in seen:
            continue
        seen.add(start)
        queue, cells = deque([start]), []
        while queue:
            y, x = queue.popleft()
            cells.append((y, x))
            for n in ((y - 1, x), (y + 1, x), (y, x - 1), (y, x + 1)):
                if 0 <= n[0] < ny and 0 <= n[1] < nx and mask[n] and n not in seen:
                    seen.add(n)
                    queue.append(n)
        found.append(sorted(cells))
    return found


def split(cells):
    """Interior and ring of a region."""
    inside = set(cells)
    interior = [
        (y, x) for y, x in cells if all(n in inside for n in ((y - 1, x), (y + 1, x), (y, x - 1), (y, x + 1)))
    ]
    return interior, [c for c in cells if c not in set(interior)]


def km(lon1, lat1, lon2, lat2, radius):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    c = math.sin(p1) * math.sin(p2) + math.cos(math.radians(lon1 - lon2)) * math.cos(p1) * math.cos(p2)
    return radius * math.acos(max(-1.0, min(1.0, c)))


def extent(ring, spec):
    points = [(spec.west + spec.res_lon * x, spec.north - spec.res_lat * y) for y, x in ring]
    return max(km(*a, *b, 6378.1) for a in points for b in points)


def levels(frame, spec, values, npix_min, npix_max, amp, d):
    """Level after level: label of the region (first cell), level and minimum of each storm."""
    field, found = frame.copy(), []
    for level in values:
        with np.errstate(invalid="ignore"):
            candidates = regions(field < level)
        for cells in candidates:
            interior, ring = split(cells)
            if not interior:
                continue
            low = min(field[c] for c in interior)
            edge = [field[c] for c in ring]
            if not (npix_min <= len(cells) <= npix_max and low < min(edge) and np.mean(edge) - low >= amp):
                continue
            if extent(ring, spec) >= d:
                continue
            found.append((level, cells[0][0] * spec.nx + cells[0][1], round(float(low), 6), len(cells)))
            for c in interior:
                field[c] = np.nan
    return found, {c for c in zip(*map(lambda a: a.tolist(), np.nonzero(np.isnan(field) & ~np.isnan(frame))))}


def tracks(frames, reach):
    """{(step, idx): number of its track}; frames are lists of (lon, lat)."""
    paths, live = [], []
    for step, dets in enumerate(frames):
        free, going = list(range(len(dets))), []
        for t in live:
            lon, lat = paths[t][-1][2]
            near = [(km(lon, lat, *dets[i], 6371.0), i) for i in free]
            near = [n for n in near if n[0] <= reach]
            if near:
                _, i = min(near)
                paths[t].append((step, i, dets[i]))
                free.remove(i)
                going.append(t)
        for i in free:
            paths.append([(step, i, dets[i])])
            going.append(len(paths) - 1)
        live = going
    return {(p[0], p[1]): n for n, path in enumerate(paths) for p in path}
