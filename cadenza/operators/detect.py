"""What one frame shows: pitch, players, ball candidates, lines, goal, edges, artifact measures.

Helpers in numpy for Arrow batches; frames are (h, w, 3) uint8 in RGB order. Contours are replaced by
runs of pixels: areas follow from pixel and border counts, outlines from border following.
"""
import numpy as np

#: The weights of the three channels, and the thresholds of the detectors.
WEIGHTS = (0.114, 0.587, 0.299)
BRIGHT_BALL, BRIGHT_LINE, BRIGHT_GOAL, BRIGHT_NET = 180, 190, 215, 200
PITCH_SHARE = 0.15


def gray(rgb):
    return np.rint(rgb.astype(float) @ WEIGHTS)


def green(rgb):
    """Hue from yellow over green to cyan, not too pale or dark."""
    x = rgb.astype(np.int32)
    most, least = x.max(-1), x.min(-1)
    return (x[..., 1] == most) & (most >= 40) & ((most - least) * 255 >= 39.5 * most)


def coverage(mask):
    """Share of a mask on a 320 x 180 grid of nearest pixels."""
    h, w = mask.shape
    return float(mask[np.ix_(np.arange(180) * h // 180, np.arange(320) * w // 320)].mean())


def box_sum(mask, h, w):
    """Sum over the h x w box around each pixel; outside counts as 0."""
    p = np.pad(mask.astype(np.int64), ((h // 2 + 1, h // 2), (w // 2 + 1, w // 2))).cumsum(0).cumsum(1)
    return p[h:, w:] - p[:-h, w:] - p[h:, :-w] + p[:-h, :-w]


def erode(mask, h, w):
    return box_sum(~mask, h, w) == 0


def dilate(mask, h, w):
    return box_sum(mask, h, w) > 0


def label(mask, diagonal=True):
    """(labels, n): connected parts, numbered from 1 by first pixel, from the runs of each row."""
    h, w = mask.shape
    edge = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, start = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1]
    if not len(row):
        return np.zeros((h, w), np.int32), 0
    wide, reach = w + 2, int(diagonal)
    first, last = row * wide + start, row * wide + end
    lo = np.searchsorted(last, first - wide + 1 - reach, "left")
    hi = np.searchsorted(first, last - wide - 1 + reach, "right")
    n = np.maximum(hi - lo, 0)
    i = np.repeat(np.arange(len(row)), n)
    j = np.repeat(lo - np.concatenate([[0], n.cumsum()[:-1]]), n) + np.arange(n.sum())
    root = np.arange(len(row))
    while len(i):
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        while (new != new[new]).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    name = np.unique(root, return_inverse=True)[1] + 1
    out = np.zeros(h * w + 1, np.int32)
    np.add.at(out, row * w + start, name)
    np.add.at(out, row * w + end, -name)
    return out[:-1].cumsum().reshape(h, w).astype(np.int32), int(name.max())


def parts(mask, diagonal=True):
    """(labels, boxes): boxes has x, y, w, h, pixels and border pixels of each part."""
    lab, n = label(mask, diagonal)
    if not n:
        return lab, np.zeros((0, 6), int)
    y, x = np.nonzero(lab)
    k = lab[y, x] - 1
    lo, hi = np.full((2, n), 1 << 30), np.full((2, n), -1)
    for a, v in enumerate((x, y)):
        np.minimum.at(lo[a], k, v)
        np.maximum.at(hi[a], k, v)
    p = np.pad(mask, 1)
    inner = p[:-2, 1:-1] & p[2:, 1:-1] & p[1:-1, :-2] & p[1:-1, 2:]
    border = np.bincount(k[~inner[y, x]], minlength=n)
    return lab, np.stack([lo[0], lo[1], hi[0] - lo[0] + 1, hi[1] - lo[1] + 1, np.bincount(k, minlength=n), border], 1)


def outline(mask):
    """(y, x) of the outer border of the part that holds the mask's first pixel, in order."""
    p = np.pad(mask, 1)
    around = ((0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1), (-1, 0), (-1, 1))
    y, x = (int(v[0]) for v in np.nonzero(p))
    first, at, way, out = (y, x), (y, x), 0, []
    for _ in range(4 * int(mask.sum()) + 4):
        out.append(at)
        for turn in range(8):
            k = (way + 5 + turn) % 8 if len(out) > 1 else turn
            z = at[0] + around[k][0], at[1] + around[k][1]
            if p[z]:
                at, way = z, k
                break
        else:
            break
        if at == first and len(out) > 1:
            break
    return np.array(out) - 1


def length(points, closed=True):
    d = np.diff(np.vstack([points, points[:1]]) if closed else points, axis=0)
    return float(np.hypot(d[:, 0], d[:, 1]).sum())


def corners(points, apart):
    """How many points of an outline remain if none left out is farther than `apart` from the line between kept ones."""
    n = len(points)
    far = int(np.hypot(*(points - points[0]).T).argmax())
    todo, keep = [(0, far), (far, n)], {0, far}
    loop = np.vstack([points, points[:1]]).astype(float)
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        p, d = loop[a + 1 : b] - loop[a], loop[b] - loop[a]
        size = np.hypot(*d)
        off = np.abs(p[:, 0] * d[1] - p[:, 1] * d[0]) / size if size else np.hypot(*p.T)
        k = int(off.argmax())
        if off[k] > apart:
            keep.add(a + 1 + k)
            todo += [(a, a + 1 + k), (a + 1 + k, b)]
    return len(keep)


def hull_area(points):
    """Area of the convex hull."""
    p = np.unique(points, axis=0)

    def half(rows):
        out = []
        for q in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(q)
        return out[:-1]

    h = np.array(half(p.tolist()) + half(p[::-1].tolist()), float)
    return abs(float((h[:, 0] * np.roll(h[:, 1], -1) - h[:, 1] * np.roll(h[:, 0], -1)).sum())) / 2 if len(h) > 2 else 0.0


def sobel(g):
    p = np.pad(g, 1, mode="reflect")
    across = p[:, 2:] - p[:, :-2]
    down = p[2:] - p[:-2]
    return across[:-2] + 2 * across[1:-1] + across[2:], down[:, :-2] + 2 * down[:, 1:-1] + down[:, 2:]


def laplacian(g):
    p = np.pad(g, 1, mode="reflect")
    return p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * g


def edges(g, low, high):
    """Ridges of the gradient over `low` that are connected with one over `high`."""
    gx, gy = sobel(g)
    size = np.abs(gx) + np.abs(gy)
    p = np.pad(size, 1)
    way = (np.round(np.arctan2(gy, gx) / (np.pi / 4)) % 4).astype(int)
    h, w = g.shape
    ridge = np.zeros((h, w), bool)
    for k, (dy, dx) in enumerate(((0, 1), (1, 1), (1, 0), (1, -1))):
        ahead, behind = (p[1 + s * dy : 1 + s * dy + h, 1 + s * dx : 1 + s * dx + w] for s in (1, -1))
        ridge |= (way == k) & (size >= ahead) & (size > behind)
    ridge &= size > low
    lab, n = label(ridge)
    strong = np.zeros(n + 1, bool)
    strong[lab[ridge & (size > high)]] = True
    strong[0] = False
    return strong[lab]


def players(rgb, mask=None):
    """Boxes with area and solidity of parts off the pitch colour that have a player's size and shape."""
    off = ~(green(rgb) if mask is None else mask)
    off = dilate(erode(off, 5, 3), 5, 3)
    lab, boxes = parts(off)
    out = []
    for k, (x, y, w, h, n, border) in enumerate(boxes.tolist(), 1):
        area = n - border / 2 - 1
        if 200 <= area <= 25000 and 25 <= h <= 300 and 10 <= w <= 180 and 1.2 <= h / w <= 5:
            own = lab[y : y + h, x : x + w] == k
            sides = [(i, f(np.flatnonzero(r))) for i, r in enumerate(own) for f in (np.min, np.max)]
            hull = hull_area(np.array(sides))
            out.append({"x": x, "y": y, "w": w, "h": h, "area": float(area), "solidity": float(area / hull) if hull else 1.0})
    return out


def field(mask):
    """The largest part of the pitch without its holes, seven pixels' square eroded."""
    lab, boxes = parts(mask)
    if not len(boxes):
        return np.zeros_like(mask)
    own = lab == 1 + boxes[:, 4].argmax()
    out, _ = label(~np.pad(own, 1), diagonal=False)
    return erode(out[1:-1, 1:-1] != out[0, 0], 7, 7) if out[0, 0] else np.ones_like(mask)


def balls(rgb, least, people=None, lines=(), mask=None):
    """cx, cy, r and circularity of bright round parts on the pitch, off players and lines."""
    mask = green(rgb) if mask is None else mask
    if not mask.any():
        return []
    zone = field(mask)
    for p in players(rgb, mask) if people is None else people:
        zone[max(0, p["y"] - 5) : p["y"] + p["h"] + 16, max(0, p["x"] - 10) : p["x"] + p["w"] + 11] = False
    if len(lines):
        y, x = np.nonzero(zone)
        for a in lines:
            d = np.array([a["x2"] - a["x1"], a["y2"] - a["y1"]], float)
            t = np.clip(((x - a["x1"]) * d[0] + (y - a["y1"]) * d[1]) / max(1.0, d @ d), 0, 1)
            near = np.hypot(x - a["x1"] - t * d[0], y - a["y1"] - t * d[1]) <= 7
            zone[y[near], x[near]] = False
    lab, boxes = parts((gray(rgb) > BRIGHT_BALL) & zone)
    out = []
    for k, (x, y, w, h, n, border) in enumerate(boxes.tolist(), 1):
        if 20 <= n - border / 2 - 1 and n <= 1500:
            line = outline(lab[y : y + h, x : x + w] == k)
            area, around = n - len(line) / 2 - 1, length(line)
            if 20 <= area <= 600 and around > 0 and 4 * np.pi * area / around**2 >= least:
                middle = (line.max(0) + line.min(0)) / 2
                r = float(np.hypot(*(line - middle).T).max())
                out.append({"cx": float(x + middle[1]), "cy": float(y + middle[0]), "r": r, "circ": float(min(1.0, 4 * np.pi * area / around**2))})
    return out


def line_mask(rgb, mask=None):
    """White markings on or beside the pitch."""
    return (gray(rgb) > BRIGHT_LINE) & dilate(green(rgb) if mask is None else mask, 15, 15)


def segments(mask, votes=60, least=40, gap=15, most=40):
    """Straight segments of a line mask's borders: strongest line first, its points leave the vote."""
    y, x = np.nonzero(edges(mask * 255.0, 50, 150))
    angle = np.arange(180) * np.pi / 180
    out, live = [], np.ones(len(x), bool)
    if len(x) < votes:
        return out
    cos, sin = np.cos(angle), np.sin(angle)
    rho = np.round(x[:, None] * cos + y[:, None] * sin).astype(int)
    base = int(rho.min())
    n = int(rho.max()) - base + 1
    cell = (rho - base) + np.arange(180) * n
    count = np.bincount(cell.ravel(), minlength=180 * n)
    for _ in range(most):
        k = int(count.argmax())
        if count[k] < votes:
            break
        t, r = k // n, k % n + base
        at = np.flatnonzero(live & (np.abs(x * cos[t] + y * sin[t] - r) <= 1.5))
        along = -x[at] * sin[t] + y[at] * cos[t]
        order = np.argsort(along, kind="stable")
        at, along = at[order], along[order]
        for stretch in np.split(np.arange(len(at)), np.flatnonzero(np.diff(along) > gap) + 1):
            if len(stretch) and along[stretch[-1]] - along[stretch[0]] >= least:
                a, b = at[stretch[0]], at[stretch[-1]]
                out.append({"x1": int(x[a]), "y1": int(y[a]), "x2": int(x[b]), "y2": int(y[b])})
        live[at] = False
        if len(at):
            count -= np.bincount(cell[at].ravel(), minlength=len(count))
        count[k] = 0
    return out


def _bent(own):
    """95th percentile of the distances of an outline from its principal axis."""
    p = own.astype(float) - own.mean(0)
    axis = np.linalg.svd(p, full_matrices=False)[2][0]
    return float(np.percentile(np.abs(p[:, 0] * axis[1] - p[:, 1] * axis[0]), 95))


def pitch_triplet(a, x, b, difference):
    """Marking residual and newly bent lines of x against the frames around it; None off the pitch or across a cut."""
    ma, mx, mb = (green(f) for f in (a, x, b))
    if min(coverage(ma), coverage(mb), float(mx.mean())) < PITCH_SHARE or difference >= 0.35:
        return None
    la, lx, lb = (line_mask(f, m) for f, m in ((a, ma), (x, mx), (b, mb)))
    residual = float(np.abs(lx[mx] - 0.5 * (la[mx].astype(float) + lb[mx])).mean())
    lab, boxes = parts(lx)
    warps, most, lines = 0, 0.0, 0
    for k, (px, py, w, h, n, _) in enumerate(boxes.tolist(), 1):
        if 2 * (w + h) < 80:
            continue
        line = outline(lab[py : py + h, px : px + w] == k)
        if length(line, False) < 80:
            continue
        lines += 1
        bend = _bent(line)
        if bend <= 2.2:
            continue
        curved = False
        for m in (la, lb):
            sub, inner = parts(m[py : py + h, px : px + w])
            for j, (qx, qy, qw, qh, _, _) in enumerate(inner.tolist(), 1):
                ref = outline(sub[qy : qy + qh, qx : qx + qw] == j)
                curved |= length(ref, False) >= 60 and _bent(ref) > 1.8
        if not curved:
            warps, most = warps + 1, max(most, bend)
    return {"residual": residual, "warps": warps, "bend": most, "lines": lines}


def goal(rgb):
    """Box around posts and crossbar with room for the net, or None."""
    white = gray(rgb) > BRIGHT_GOAL
    h, w = white.shape
    white[int(h * 0.85) :] = False
    _, boxes = parts(white)
    x, y, bw, bh = boxes[:, :4].T
    post = (bh >= 70) & (bw <= 25) & (bh >= 3.5 * bw) & (bw * bh >= 100)
    bar = (bw >= 120) & (bh <= 30) & (bw >= 4.5 * bh) & (bw * bh >= 100)
    own = post | bar
    if not (bar.any() or post.sum() >= 2):
        return None
    x0, y0 = max(0, int(x[own].min()) - 40), max(0, int(y[own].min()) - 20)
    x1, y1 = min(w, int((x + bw)[own].max()) + 80), min(h, int((y + bh)[own].max()) + 40)
    return {"x": x0, "y": y0, "w": x1 - x0, "h": y1 - y0}


def occlusions(g, people):
    """(players that overlap, of these blurred ones): the overlap's texture against that of both."""
    texture = lambda y0, y1, x0, x1: float(laplacian(g[y0:y1, x0:x1]).var())
    seen = failed = 0
    for i, p in enumerate(people):
        for q in people[i + 1 :]:
            x0, y0 = max(p["x"], q["x"]), max(p["y"], q["y"])
            x1, y1 = min(p["x"] + p["w"], q["x"] + q["w"]), min(p["y"] + p["h"], q["y"] + q["h"])
            if x1 - x0 > 8 and y1 - y0 > 15:
                seen += 1
                own = sum(texture(z["y"], z["y"] + z["h"], z["x"], z["x"] + z["w"]) for z in (p, q)) / 2
                failed += own > 65 and texture(y0, y1, x0, x1) < max(25.0, 0.35 * own)
    return seen, int(failed)


def artifacts(g):
    """Ghosting, double contour, tearing and deformation of a gray frame."""
    gx, gy = sobel(g)
    size = np.hypot(gx, gy)
    e = edges(g, 50, 150)
    near = dilate(e, 3, 3)
    double = float(np.abs(laplacian(g))[near].mean()) / 255 if near.any() else 0.0
    lab, boxes = parts(e)
    jagged = []
    for k, (x, y, w, h, _, _) in list(enumerate(boxes.tolist(), 1))[:30]:
        line = outline(lab[y : y + h, x : x + w] == k)
        if len(line) > 20 and (n := corners(line, 0.02 * length(line))) > 4:
            jagged.append(min(1.0, len(line) / (n * 5) / 2))
    tearing = float(np.mean(jagged)) if jagged else 0.05
    return {"ghosting": float(((size > 5) & (size < 20)).mean()), "double_contour": double, "edge_tearing": tearing, "deformation": (double + tearing) / 2}


def net_texture(g, box):
    """Laplacian variance of the bright parts inside a box; None outside the frame."""
    crop = g[box["y"] : box["y"] + box["h"], box["x"] : box["x"] + box["w"]]
    return float(laplacian((crop > BRIGHT_NET) * 255.0).var()) if crop.size else None
