"""Array kernels over one 2-D plane: blur, labels, hulls, tiles, matching. Plain numpy."""

from __future__ import annotations

import math

import numpy as np


def odd(value: float) -> int:
    whole = int(value)
    return whole if value % 2 == 1 else whole + 1


def gaussian_kernel(size: int) -> np.ndarray:
    """Kernel of ``size`` taps whose deviation follows from its size."""
    sigma = 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    x = np.arange(size) - (size - 1) / 2
    k = np.exp(-(x * x) / (2 * sigma * sigma))
    return k / k.sum()


def convolve_axis(img: np.ndarray, kernel: np.ndarray, axis: int, mode: str = "reflect") -> np.ndarray:
    """Correlation along one axis; borders mirror without repeating the edge."""
    r, n = len(kernel) // 2, img.shape[axis]
    at = np.arange(-r, n + r)
    if mode == "reflect" and n > 1:
        period = 2 * (n - 1)
        at = np.abs(at) % period
        at = np.where(at >= n, period - at, at)
    else:
        at = np.clip(at, 0, n - 1)
    wide = np.take(img, at, axis=axis)
    out = np.zeros(img.shape, float)
    for i, w in enumerate(kernel):
        out += w * np.take(wide, range(i, i + n), axis=axis)
    return out


def gaussian_blur(img: np.ndarray, size: int) -> np.ndarray:
    k = gaussian_kernel(size)
    return convolve_axis(convolve_axis(np.asarray(img, float), k, 0), k, 1)


def clear_background(img: np.ndarray, sigma_r: float, unit: str = "pixel", method: str = "divide", pixel_size: float = 1.0) -> np.ndarray:
    """The plane over, or minus, its blur; never below 0."""
    if img.ndim != 2:
        raise ValueError("a plane has two dimensions")
    if method not in ("divide", "subtract") or unit not in ("pixel", "um"):
        raise ValueError(f"unknown method or unit: {method}, {unit}")
    ground = gaussian_blur(img, odd(sigma_r / pixel_size if unit == "um" else sigma_r))
    out = np.divide(img, ground, out=np.zeros(img.shape, float), where=ground != 0) if method == "divide" else img - ground
    return np.clip(out, 0, None)


def label(mask: np.ndarray, diagonal: bool = False) -> tuple[np.ndarray, int]:
    """Connected components numbered in the order of their first pixels, row by row.

    Runs of each row are joined to those they touch in the row before; roots are then numbered.
    """
    mask = np.asarray(mask, bool)
    h, w = mask.shape
    edges = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    ys, starts = np.nonzero(edges == 1)
    ends = np.nonzero(edges == -1)[1]
    parent = list(range(len(ys)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    first = np.searchsorted(ys, np.arange(h + 1))
    reach = 1 if diagonal else 0
    for y in range(1, h):
        i, j = first[y - 1], first[y]
        while i < first[y] and j < first[y + 1]:
            if starts[i] < ends[j] + reach and starts[j] < ends[i] + reach:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
            if ends[i] < ends[j]:
                i += 1
            else:
                j += 1
    out, number = np.zeros((h, w), np.int32), {}
    for k in range(len(ys)):
        r = root(k)
        out[ys[k], starts[k] : ends[k]] = number.setdefault(r, len(number) + 1)
    return out, len(number)


def fix_dark_border(img: np.ndarray, factor: float = 0.4, stride: int = 50, touch: int = 100) -> tuple[np.ndarray, bool]:
    """Fill dark regions at the border with the mean of the rest; whether any was found."""
    mean = float(img.mean())
    border = np.concatenate((img[0, ::stride], img[-1, ::stride], img[::stride, 0], img[::stride, -1]))
    if border.min() > mean * factor:
        return img, False
    parts, n = label(img < mean * factor, diagonal=True)
    sampled = np.concatenate((parts[0, ::touch], parts[-1, ::touch], parts[::touch, 0], parts[::touch, -1]))
    dark = np.isin(parts, np.setdiff1d(sampled, [0]))
    if not dark.any():
        return img, False
    out = img.copy()
    out[dark] = img[~dark].mean() if (~dark).any() else mean
    return out, True


def to_uint8(img: np.ndarray) -> np.ndarray:
    lo, hi = float(img.min()), float(img.max())
    if lo == hi:
        raise ValueError("image has zero variance")
    return ((img - lo) / (hi - lo) * 255).astype(np.uint8)


def equalise_z(img: np.ndarray) -> np.ndarray:
    """Histogram equalisation of the 8-bit plane, then mean 0 and deviation 1."""
    u8 = to_uint8(img)
    cdf = np.cumsum(np.bincount(u8.ravel(), minlength=256))
    low = cdf[u8.min()]
    flat = np.rint((cdf - low) * 255.0 / max(1, cdf[-1] - low))[u8]
    return (flat - flat.mean()) / (flat.std() or 1.0)


def sobel(img: np.ndarray, smooth: int = 0) -> np.ndarray:
    """Gradient magnitude scaled to 0..255, optionally of the blurred plane."""
    img = gaussian_blur(img, smooth * 4 + 1) if smooth else np.asarray(img, float)
    d, s = np.array([-1.0, 0, 1]), np.array([1.0, 2, 1])
    gx = convolve_axis(convolve_axis(img, d, 1), s, 0)
    gy = convolve_axis(convolve_axis(img, d, 0), s, 1)
    m = np.hypot(gx, gy)
    return (m / m.max() * 255).astype(np.uint8) if m.max() > 0 else m.astype(np.uint8)


def stretch(img: np.ndarray, low: float = 1, high: float = 99) -> np.ndarray:
    """0..255 between two percentiles."""
    lo, hi = np.percentile(img, (low, high))
    return (np.clip((img - lo) / max(hi - lo, 1e-12), 0, 1) * 255).astype(np.uint8)


def match_template(img: np.ndarray, template: np.ndarray) -> np.ndarray:
    """Normalised cross-correlation of the centred template at each place it fits; by FFT."""
    img, t = np.asarray(img, float), np.asarray(template, float) - np.mean(template)
    h, w = t.shape
    shape = (img.shape[0] + h - 1, img.shape[1] + w - 1)
    cross = np.fft.irfft2(np.fft.rfft2(img, shape) * np.fft.rfft2(t[::-1, ::-1], shape), shape)[h - 1 : img.shape[0], w - 1 : img.shape[1]]

    def box(a):
        c = np.pad(a.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
        return c[h:, w:] - c[:-h, w:] - c[h:, :-w] + c[:-h, :-w]

    var = box(img * img) - box(img) ** 2 / (h * w)
    norm = np.sqrt(np.clip(var, 0, None) * (t * t).sum())
    return np.divide(cross, norm, out=np.zeros_like(cross), where=norm > 1e-9)


def peaks(score: np.ndarray, most: int, separation: int, least: float) -> list[tuple[int, int, float]]:
    """Highest places (y, x, score), each blanking its surroundings; scores of ``least`` or more."""
    left, out = score.astype(float).copy(), []
    while len(out) < most:
        y, x = np.unravel_index(int(left.argmax()), left.shape)
        if left[y, x] < least:
            break
        out.append((int(y), int(x), float(left[y, x])))
        left[max(0, y - separation) : y + separation + 1, max(0, x - separation) : x + separation + 1] = -np.inf
    return out


def id_blocks(img: np.ndarray, template: np.ndarray, most: int = 10, separation: int = 100, least: float = 0.5, row_tolerance: float = 50) -> list[tuple[float, float, float]]:
    """Centres (y, x, score) of template matches on one row: that of the best match."""
    h, w = template.shape
    found = [(y + h / 2, x + w / 2, s) for y, x, s in peaks(match_template(img, template), most, separation, least)]
    return sorted((f for f in found if abs(f[0] - found[0][0]) <= row_tolerance), key=lambda f: f[1]) if found else []


def dips(profile: np.ndarray, smooth: int = 31, reach: int = 80, prominence: float = 0.0) -> list[tuple[int, float]]:
    """Local minima of the smoothed profile that lie below both shoulders: (place, depth)."""
    p = np.convolve(profile, np.ones(smooth) / smooth, mode="same") if smooth > 1 else np.asarray(profile, float)
    out = []
    for i in range(1, len(p) - 1):
        if p[i] <= p[i - 1] and p[i] < p[i + 1]:
            depth = min(p[max(0, i - reach) : i].max(), p[i + 1 : i + 1 + reach].max()) - p[i]
            if depth >= prominence:
                out.append((i, float(depth)))
    return out


def rotation(angle: float, centre: tuple[float, float]) -> np.ndarray:
    """2×3 affine that turns by ``angle`` degrees around ``centre`` (y, x); acts on (x, y)."""
    a, b = math.cos(math.radians(angle)), math.sin(math.radians(angle))
    cy, cx = centre
    return np.array([[a, b, (1 - a) * cx - b * cy], [-b, a, b * cx + (1 - a) * cy]])


def warp(img: np.ndarray, affine: np.ndarray) -> np.ndarray:
    """The plane under an affine, bilinear; 0 outside."""
    full = np.vstack((affine, [0, 0, 1]))
    inv = np.linalg.inv(full)
    ys, xs = np.mgrid[: img.shape[0], : img.shape[1]]
    sx, sy = (inv[i, 0] * xs + inv[i, 1] * ys + inv[i, 2] for i in (0, 1))
    x0, y0 = np.floor(sx).astype(int), np.floor(sy).astype(int)
    fx, fy = sx - x0, sy - y0
    out = np.zeros(img.shape, float)
    for dy, wy in ((0, 1 - fy), (1, fy)):
        for dx, wx in ((0, 1 - fx), (1, fx)):
            y, x = y0 + dy, x0 + dx
            ok = (y >= 0) & (y < img.shape[0]) & (x >= 0) & (x < img.shape[1])
            out[ok] += (wy * wx)[ok] * img[y[ok], x[ok]]
    return out


def shift_between(ref: np.ndarray, img: np.ndarray) -> tuple[int, int]:
    """Whole-pixel shift (dy, dx) that aligns ``img`` to ``ref``: the peak of the phase correlation."""
    f = np.fft.rfft2(ref - ref.mean()) * np.conj(np.fft.rfft2(img - img.mean()))
    c = np.fft.irfft2(f / np.maximum(np.abs(f), 1e-12), ref.shape)
    y, x = np.unravel_index(int(c.argmax()), c.shape)
    return (int(y - ref.shape[0]) if y > ref.shape[0] // 2 else int(y), int(x - ref.shape[1]) if x > ref.shape[1] // 2 else int(x))


def shifted(img: np.ndarray, dy: int, dx: int) -> np.ndarray:
    out = np.zeros_like(img)
    h, w = img.shape
    out[max(0, dy) : h + min(0, dy), max(0, dx) : w + min(0, dx)] = img[max(0, -dy) : h + min(0, -dy), max(0, -dx) : w + min(0, -dx)]
    return out


def resize(img: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear, pixel centres aligned."""
    def axis(n, m):
        at = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
        lo = np.minimum(at.astype(int), max(n - 2, 0))
        return lo, np.minimum(lo + 1, n - 1), at - lo

    y0, y1, fy = axis(img.shape[0], height)
    x0, x1, fx = axis(img.shape[1], width)
    rows = img[y0] * (1 - fy)[:, None] + img[y1] * fy[:, None]
    return rows[:, x0] * (1 - fx) + rows[:, x1] * fx


def fit_roi(img: np.ndarray, size: int) -> np.ndarray:
    """A crop within size×size: larger ones are shrunk, and all are padded around with 0."""
    h, w = img.shape
    scale = min(1.0, size / max(h, w))
    if scale < 1:
        img = resize(img, max(1, round(h * scale)), max(1, round(w * scale)))
    out = np.zeros((size, size), float)
    y, x = (size - img.shape[0]) // 2, (size - img.shape[1]) // 2
    out[y : y + img.shape[0], x : x + img.shape[1]] = img
    return out


#: Columns of :func:`region_table`, after the label.
REGION = ("area", "centroid_0", "centroid_1", "max_intensity", "min_intensity", "mean_intensity", "roi_std_dev", "roi_skewness", "bbox_y0", "bbox_x0", "bbox_y1", "bbox_x1", "major_axis_length", "minor_axis_length", "orientation")


def region_table(labels: np.ndarray, img: np.ndarray) -> dict[str, np.ndarray]:
    """Region properties of all labels above 0 of one plane, as columns; one pass over sorted pixels."""
    y, x = np.nonzero(labels)
    n = labels[y, x]
    order = np.argsort(n, kind="stable")
    y, x, n = y[order], x[order], n[order]
    v = img[y, x].astype(float)
    ids, first = np.unique(n, return_index=True)
    if not len(ids):
        return {"label": ids.astype(np.int32), **{c: np.zeros(0) for c in REGION}}
    add = lambda a: np.add.reduceat(a, first)
    area = np.diff(np.append(first, len(n))).astype(float)
    spread = lambda a: np.repeat(a, area.astype(int))
    cy, cx, m = add(y.astype(float)) / area, add(x.astype(float)) / area, add(v) / area
    dv = v - spread(m)
    m2, m3 = (add(a) / area for a in (dv * dv, dv**3))
    different = np.array([len(np.unique(p)) for p in np.split(v, first[1:])])
    with np.errstate(all="ignore"):
        skew = np.where(different < 10, 0.0, m3 / m2**1.5 * np.sqrt(area * (area - 1)) / (area - 2))
    # Second moments times area², in whole numbers of any size: axes that are equal must not differ by rounding.
    count, sy, sx, yy, xx, xy = (s.astype(object) for s in (area.astype(int), *map(add, (y, x, y * y, x * x, y * x))))
    a, c, cross = count * xx - sx * sx, count * yy - sy * sy, count * xy - sy * sx
    equal, falling, twice, wide = (a == c).astype(bool), (cross > 0).astype(bool), (2 * cross).astype(float), (c - a).astype(float)
    a, c, b = ((s / count**2).astype(float) for s in (a, c, cross))
    root = np.sqrt(((a - c) / 2) ** 2 + b * b)
    major, minor = 4 * np.sqrt(np.maximum((a + c) / 2 + root, 0)), 4 * np.sqrt(np.maximum((a + c) / 2 - root, 0))
    angle = np.where(equal, np.where(falling, np.pi / 4, -np.pi / 4), 0.5 * np.arctan2(twice, wide))
    low, high = (lambda w: np.minimum.reduceat(w, first)), (lambda w: np.maximum.reduceat(w, first))
    columns = (area, cy, cx, high(v), low(v), m, np.sqrt(m2), skew, low(y), low(x), high(y) + 1, high(x) + 1, major, minor, angle)
    return {"label": ids.astype(np.int32), **dict(zip(REGION, columns))}


def hull(points: np.ndarray) -> np.ndarray:
    """Convex hull of points (y, x), counter-clockwise from the least."""
    pts = np.unique(points, axis=0)
    if len(pts) < 3:
        return pts

    def half(seq):
        out = []
        for p in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(half(pts) + half(pts[::-1]))


def convex_area(ys: np.ndarray, xs: np.ndarray) -> int:
    """Pixels whose centres lie in the hull of the object's pixel corners."""
    corners = np.concatenate([np.stack((ys + dy, xs + dx), 1) for dy, dx in ((-0.5, 0), (0.5, 0), (0, -0.5), (0, 0.5))])
    p = hull(corners)
    gy, gx = np.mgrid[ys.min() : ys.max() + 1, xs.min() : xs.max() + 1]
    inside = np.ones(gy.shape, bool)
    for (y0, x0), (y1, x1) in zip(p, np.roll(p, -1, axis=0)):
        inside &= (y1 - y0) * (gx - x0) - (x1 - x0) * (gy - y0) >= -1e-9
    return int(inside.sum())


def boundary_length(mask: np.ndarray) -> float:
    """Length of the chain of boundary pixels: 1 for straight and √2 for diagonal steps."""
    m = np.pad(mask.astype(bool), 1)
    inner = m[1:-1, 1:-1] & m[:-2, 1:-1] & m[2:, 1:-1] & m[1:-1, :-2] & m[1:-1, 2:]
    edge = np.pad(m[1:-1, 1:-1] & ~inner, 1)
    straight = (edge[1:, :] & edge[:-1, :]).sum() + (edge[:, 1:] & edge[:, :-1]).sum()
    diagonal = (edge[1:, 1:] & edge[:-1, :-1] & ~edge[1:, :-1] & ~edge[:-1, 1:]).sum() + (edge[1:, :-1] & edge[:-1, 1:] & ~edge[1:, 1:] & ~edge[:-1, :-1]).sum()
    return float(straight + math.sqrt(2) * diagonal)


def border_complexity(mask: np.ndarray) -> float:
    """Boundary length over the hull's; 0 without a boundary, 1 for a hull without length."""
    length = boundary_length(mask)
    if length == 0:
        return 0.0
    p = hull(np.argwhere(mask))
    around = float(np.hypot(*(np.roll(p, -1, axis=0) - p).T).sum()) if len(p) > 1 else 0.0
    return length / around if around else 1.0


def skeleton(mask: np.ndarray) -> np.ndarray:
    """Thin a mask to lines, peeling the two kinds of border pixels in turn until none is left."""
    m = np.pad(mask.astype(np.uint8), 1)
    while True:
        changed = False
        for turn in (0, 1):
            n = [m[:-2, 1:-1], m[:-2, 2:], m[1:-1, 2:], m[2:, 2:], m[2:, 1:-1], m[2:, :-2], m[1:-1, :-2], m[:-2, :-2]]
            total = sum(x.astype(int) for x in n)
            rises = sum(((a == 0) & (b == 1)).astype(int) for a, b in zip(n, n[1:] + n[:1]))
            a, b = ((n[0] * n[2] * n[4], n[2] * n[4] * n[6]), (n[0] * n[2] * n[6], n[0] * n[4] * n[6]))[turn]
            gone = (m[1:-1, 1:-1] == 1) & (total >= 2) & (total <= 6) & (rises == 1) & (a == 0) & (b == 0)
            if gone.any():
                m[1:-1, 1:-1][gone] = 0
                changed = True
        if not changed:
            return m[1:-1, 1:-1].astype(bool)


def rod_shape(mask: np.ndarray) -> float:
    """R² of a line through the skeleton; 0 for fewer than two points, 1 for an upright line."""
    y, x = np.nonzero(skeleton(mask))
    if len(x) < 2:
        return 0.0
    if x.std() == 0:
        return 1.0
    if y.std() == 0:
        return 0.0
    return float(np.corrcoef(x, y)[0, 1] ** 2)


def dilate(mask: np.ndarray, size: int = 5, times: int = 1) -> np.ndarray:
    m = mask.astype(bool)
    for _ in range(times):
        p = np.pad(m, size // 2)
        m = np.any([p[dy : dy + m.shape[0], dx : dx + m.shape[1]] for dy in range(size) for dx in range(size)], axis=0)
    return m


def dilated_measures(mask: np.ndarray, img: np.ndarray, times: int = 1) -> tuple[float, float, float, float, int]:
    """std, mean, min, max and area over the mask dilated by 5×5."""
    v = img[dilate(mask, 5, times)]
    return float(v.std()), float(v.mean()), float(v.min()), float(v.max()), int(v.size)


def scale_image(img: np.ndarray, mode: str = "range01", low: float = 1, high: float = 99.8, fixed: tuple[float, float] = (0, 65535)) -> tuple[np.ndarray, tuple[float, float]]:
    """A plane as a model wants it, and (offset, factor) that take it back.

    ``range01`` stretches between the percentiles taken along rows first, then over those;
    ``zscore`` uses the sample deviation; ``combined`` is both; ``fixed_range`` a given range.
    """
    x = np.asarray(img, float)
    if mode == "fixed_range":
        off, by = fixed[0], (fixed[1] - fixed[0]) or 1.0
        return (x - off) / by, (off, by)
    off, by = 0.0, 1.0
    if mode in ("range01", "combined"):
        lo = float(np.percentile(np.percentile(x, low, axis=0), low))
        hi = float(np.percentile(np.percentile(x, high, axis=0), high))
        off, by = lo, (hi - lo) or 1.0
        x = (x - off) / by
    if mode in ("zscore", "combined"):
        m, s = float(x.mean()), float(x.std(ddof=1)) + 1e-6
        x, off, by = (x - m) / s, off + m * by, by * s
    elif mode != "range01":
        raise ValueError(f"unknown mode: {mode}")
    return x, (off, by)


def tile_positions(length: int, tile: int, overlap: float) -> list[int]:
    """Starts of tiles along one side; the last is flush with the end."""
    if length <= tile:
        return [0]
    step = max(int(tile * (1 - overlap)), 1)
    at = list(range(0, length - tile + 1, step))
    return at if at[-1] == length - tile else [*at, length - tile]


def pad_to_tiles(img: np.ndarray, tile: int, overlap: float, fill: float | None = None) -> np.ndarray:
    """Padded below and right so that whole steps cover it; with ``fill``, to one tile only."""
    step = max(int(tile * (1 - overlap)), 1)
    if fill is None:
        size = [tile if n <= tile else math.ceil((n - tile) / step) * step + tile for n in img.shape]
        fill = float(img.mean())
    else:
        size = [max(n, tile) for n in img.shape]
    out = np.full(size, fill, float)
    out[: img.shape[0], : img.shape[1]] = img
    return out


def cosine_basis(n: int) -> np.ndarray:
    """Orthonormal cosines of n samples, the constant first, as rows."""
    rows = np.cos(np.pi * (np.arange(n) + 0.5) * np.arange(n)[:, None] / n) * math.sqrt(2 / n)
    rows[0] /= math.sqrt(2)
    return rows


def low_rank_field(stack: np.ndarray, smooth: float = 0.1, rounds: int = 40) -> np.ndarray:
    """A field of mean 1 that all planes (n, h, w) share, up to a factor each, beside what is sparse.

    A rank-one fit of least absolute deviations: each round weighs pixels by the inverse of their
    residual, fits the planes' factors and then the field, and shrinks the field's cosines but the mean.
    """
    n, h, w = stack.shape
    rows, columns = cosine_basis(h), cosine_basis(w)
    field, weight = np.ones((h, w)), np.ones(stack.shape)
    for _ in range(rounds):
        factor = (weight * stack * field).sum(axis=(1, 2)) / np.maximum((weight * field * field).sum(axis=(1, 2)), 1e-12)
        scaled = factor[:, None, None]
        rough = (weight * stack * scaled).sum(axis=0) / np.maximum((weight * scaled * scaled).sum(axis=0), 1e-12)
        spectrum = rows @ rough @ columns.T
        mean = spectrum[0, 0]
        spectrum = np.sign(spectrum) * np.maximum(np.abs(spectrum) - smooth, 0)
        spectrum[0, 0] = mean
        new = np.maximum(rows.T @ spectrum @ columns, 1e-3)
        new /= new.mean()
        rest = np.abs(stack - scaled * new) / max(float(np.abs(stack).mean()), 1e-12)
        weight = 1 / (rest + 0.01)
        done, field = float(np.abs(new - field).max()) < 1e-4, new
        if done:
            break
    return field
