"""Pixels in numpy: decoding, edges, components, colours and shapes.

Images are ``uint8`` arrays, RGB or grey.  No image library is needed; values
may differ slightly from those of one.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

# Hue (0-180), saturation and value ranges of seal colours.
RED = (((0, 100, 100), (10, 255, 255)), ((160, 100, 100), (180, 255, 255)))
BLUE = (((100, 100, 100), (130, 255, 255)),)
BLACK = (((0, 0, 0), (180, 50, 80)),)


def decode_png(data: bytes) -> np.ndarray:
    """An 8-bit, non-interlaced PNG as an array (alpha dropped)."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, body, head, palette = 8, b"", None, None
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        chunk = data[at + 8 : at + 8 + size]
        at += 12 + size
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", chunk)
        elif kind == b"PLTE":
            palette = np.frombuffer(chunk, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body += chunk
    if head is None or head[2] != 8 or head[6] or head[3] not in (0, 2, 3, 4, 6):
        raise ValueError("unsupported PNG")
    w, h, channels = head[0], head[1], {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[head[3]]
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, 1 + w * channels)
    out = np.zeros((h, w * channels), np.uint8)
    for y in range(h):
        kind, line = raw[y, 0], raw[y, 1:].astype(np.int32)
        up = out[y - 1].astype(np.int32) if y else np.zeros(w * channels, np.int32)
        if kind == 0:
            out[y] = line
        elif kind == 2:
            out[y] = (line + up) & 255
        else:
            row = np.zeros(w * channels, np.int32)
            for x in range(w * channels):
                a = row[x - channels] if x >= channels else 0
                if kind == 1:
                    guess = a
                elif kind == 3:
                    guess = (a + up[x]) >> 1
                else:
                    c = up[x - channels] if x >= channels else 0
                    pa, pb, pc = abs(up[x] - c), abs(a - c), abs(a + up[x] - 2 * c)
                    guess = a if pa <= pb and pa <= pc else up[x] if pb <= pc else c
                row[x] = (line[x] + guess) & 255
            out[y] = row
    img = out.reshape(h, w, channels)
    if head[3] == 3:
        return palette[img[..., 0]]
    return img[..., 0] if channels <= 2 else img[..., :3]


def decode_bmp(data: bytes) -> np.ndarray:
    """An uncompressed bitmap of 8, 24 or 32 bits a pixel."""
    offset, head, width, height, _, bits, packed = struct.unpack("<IIiiHHI", data[10:34])
    if bits not in (8, 24, 32) or packed not in (0, 3):
        raise ValueError("unsupported BMP")
    step = (width * bits // 8 + 3) // 4 * 4
    rows = np.frombuffer(data, np.uint8, step * abs(height), offset).reshape(abs(height), step)
    rows = rows[::-1] if height > 0 else rows
    if bits == 8:
        used = struct.unpack("<I", data[46:50])[0] or 256
        return np.frombuffer(data, np.uint8, 4 * used, 14 + head).reshape(-1, 4)[:, 2::-1][rows[:, :width]]
    return rows[:, : width * bits // 8].reshape(abs(height), width, bits // 8)[..., 2::-1].copy()


def decode_tiff(data: bytes) -> np.ndarray:
    """An uncompressed 8-bit grey or RGB strip image."""
    order = {b"II": "<", b"MM": ">"}[data[:2]]
    at = struct.unpack(order + "I", data[4:8])[0]
    tags = {}
    for i in range(struct.unpack(order + "H", data[at : at + 2])[0]):
        entry = data[at + 2 + 12 * i : at + 14 + 12 * i]
        tag, kind, n = struct.unpack(order + "HHI", entry[:8])
        form = {1: "B", 3: "H", 4: "I"}.get(kind)
        if form is None:
            continue
        size = struct.calcsize(form) * n
        raw = entry[8 : 8 + size] if size <= 4 else data[(start := struct.unpack(order + "I", entry[8:])[0]) : start + size]
        tags[tag] = struct.unpack(f"{order}{n}{form}", raw)
    width, height, channels = tags[256][0], tags[257][0], tags.get(277, (1,))[0]
    if tags.get(259, (1,))[0] != 1 or set(tags.get(258, (1,))) != {8} or channels not in (1, 3, 4):
        raise ValueError("unsupported TIFF")
    body = b"".join(data[o : o + n] for o, n in zip(tags[273], tags[279], strict=True))
    img = np.frombuffer(body, np.uint8, width * height * channels).reshape(height, width, channels)
    if channels == 1:
        return 255 - img[..., 0] if tags.get(262, (1,))[0] == 0 else img[..., 0]
    return img[..., :3]


def decode(data: bytes) -> np.ndarray:
    """An image of any format known here; others are tried with an image library where one is installed."""
    for start, read in ((b"\x89PNG", decode_png), (b"BM", decode_bmp), (b"II*\x00", decode_tiff), (b"MM\x00*", decode_tiff)):
        if data.startswith(start):
            return read(data)
    try:
        from PIL import Image
    except ImportError:
        raise ValueError("unknown image format") from None
    import io

    return np.asarray(Image.open(io.BytesIO(data)).convert("RGB"))


def encode_png(img: np.ndarray) -> bytes:
    """A grey or RGB array as PNG."""
    h, w = img.shape[:2]
    rows = np.concatenate([np.zeros((h, 1), np.uint8), img.reshape(h, -1)], axis=1).tobytes()
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    head = struct.pack(">IIBBBBB", w, h, 8, 0 if img.ndim == 2 else 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows, 6)) + chunk(b"IEND", b"")


def grey(img: np.ndarray) -> np.ndarray:
    return img if img.ndim == 2 else np.rint(img @ np.array([0.299, 0.587, 0.114])).astype(np.uint8)


def edges(img: np.ndarray, low: float = 50, high: float = 150) -> np.ndarray:
    """Canny edges: Sobel gradient, non-maximum suppression, hysteresis."""
    g = np.pad(grey(img).astype(np.float64), 1, mode="edge")
    gx = g[:-2, 2:] + 2 * g[1:-1, 2:] + g[2:, 2:] - g[:-2, :-2] - 2 * g[1:-1, :-2] - g[2:, :-2]
    gy = g[2:, :-2] + 2 * g[2:, 1:-1] + g[2:, 2:] - g[:-2, :-2] - 2 * g[:-2, 1:-1] - g[:-2, 2:]
    size = np.abs(gx) + np.abs(gy)
    angle = (np.rint(np.arctan2(gy, gx) / (np.pi / 4)) % 4).astype(int)
    p = np.pad(size, 1)
    h, w = size.shape
    peak = np.zeros((h, w), bool)
    for k, (dy, dx) in enumerate(((0, 1), (1, 1), (1, 0), (1, -1))):
        before, after = p[1 - dy : 1 - dy + h, 1 - dx : 1 - dx + w], p[1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w]
        peak |= (angle == k) & (size > before) & (size >= after)
    weak = peak & (size > low)
    labels, n = label(weak)
    strong = np.zeros(n + 1, bool)
    strong[np.unique(labels[weak & (size > high)])] = True
    strong[0] = False
    return strong[labels]


def label(mask: np.ndarray) -> tuple[np.ndarray, int]:
    """8-connected components of a mask, numbered in scan order: labels (0 outside) and their number."""
    h, w = mask.shape
    index = np.flatnonzero(mask)
    number = np.full(h * w, -1)
    number[index] = np.arange(len(index))
    grid = number.reshape(h, w)
    pairs = []
    for dy, dx in ((0, 1), (1, 0), (1, 1), (1, -1)):
        a = grid[: h - dy, max(0, -dx) : w - max(0, dx)]
        b = grid[dy:, max(0, dx) : w + min(0, dx)]
        both = (a >= 0) & (b >= 0)
        pairs.append(np.stack([a[both], b[both]]))
    a, b = np.concatenate(pairs, axis=1)
    root = np.arange(len(index))
    while len(a):
        # hook the larger root onto the smaller, then let every pixel point at its root
        ra, rb = root[a], root[b]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    names, inverse = np.unique(root, return_inverse=True)
    out = np.zeros(h * w, int)
    out[index] = inverse + 1
    return out.reshape(h, w), len(names)


def otsu(img: np.ndarray) -> int:
    """The grey level that separates dark from light best."""
    count = np.bincount(grey(img).ravel(), minlength=256).astype(np.float64)
    total, levels = count.sum(), np.arange(256)
    below, mass = count.cumsum(), (count * levels).cumsum()
    above = total - below
    ok = (below > 0) & (above > 0)
    between = np.zeros(256)
    between[ok] = below[ok] * above[ok] * (mass[ok] / below[ok] - (mass[-1] - mass[ok]) / above[ok]) ** 2
    return int(between.argmax())


def stroke_density(img: np.ndarray) -> float:
    return float(edges(img).sum()) / max(1, img.shape[0] * img.shape[1])


def components(img: np.ndarray) -> int:
    """Connected dark parts."""
    return label(grey(img) <= otsu(img))[1]


def hsv(img: np.ndarray) -> np.ndarray:
    """Hue 0-180, saturation and value 0-255 of an RGB image."""
    rgb = img.astype(np.float64)
    top, span = rgb.max(-1), np.ptp(rgb, axis=-1)
    safe = np.where(span == 0, 1, span)
    r, g, b = rgb[..., 0], rgb[..., 1], rgb[..., 2]
    hue = np.where(top == r, (g - b) / safe, np.where(top == g, 2 + (b - r) / safe, 4 + (r - g) / safe)) * 30
    return np.stack([np.rint(hue % 180), np.rint(255 * span / np.where(top == 0, 1, top)), top], -1)


def color_mask(img: np.ndarray, ranges) -> np.ndarray:
    if img.ndim == 2:
        img = np.repeat(img[..., None], 3, -1)
    x, out = hsv(img), np.zeros(img.shape[:2], bool)
    for lo, hi in ranges:
        out |= ((x >= lo) & (x <= hi)).all(-1)
    return out


def color_score(img: np.ndarray) -> float:
    """Share of the pixels that are red, blue or black."""
    return float(color_mask(img, (*RED, *BLUE, *BLACK)).mean()) if img.size else 0.0


def _outline(mask: np.ndarray) -> float:
    """Length of a part's outline: half its steps between boundary pixels, diagonal ones longer."""
    p = np.pad(mask, 1)
    inner = p[1:-1, 1:-1] & p[:-2, 1:-1] & p[2:, 1:-1] & p[1:-1, :-2] & p[1:-1, 2:]
    rim = np.pad(mask & ~inner, 1)
    straight = (rim[1:-1, 1:-1] & rim[1:-1, 2:]).sum() + (rim[1:-1, 1:-1] & rim[2:, 1:-1]).sum()
    corner = lambda a, b, c, d: (a & b & ~c & ~d).sum()
    diagonal = corner(rim[1:-1, 1:-1], rim[2:, 2:], rim[1:-1, 2:], rim[2:, 1:-1]) + corner(rim[1:-1, 2:], rim[2:, 1:-1], rim[1:-1, 1:-1], rim[2:, 2:])
    return float(straight + diagonal * np.sqrt(2))


def _fill(mask: np.ndarray) -> np.ndarray:
    """A mask with its holes filled."""
    outside, _ = label(np.pad(~mask, 1, constant_values=True))
    return (outside != outside[0, 0])[1:-1, 1:-1]


def contour_area(part: np.ndarray) -> float:
    """Area inside the outline through the centres of a filled part's boundary pixels."""
    p = np.pad(part, 1)
    inner = p[1:-1, 1:-1] & p[:-2, 1:-1] & p[2:, 1:-1] & p[1:-1, :-2] & p[1:-1, 2:]
    return max(0.0, float(part.sum()) - float((part & ~inner).sum()) / 2 - 1)


def _parts(mask: np.ndarray):
    """Per connected part: its box, its pixels with holes filled, and its contour area."""
    labels, n = label(mask)
    if not n:
        return
    ys, xs = np.nonzero(labels)
    own = labels[ys, xs]
    by = np.argsort(own, kind="stable")
    for at in np.split(by, np.flatnonzero(np.diff(own[by])) + 1):
        y, x = ys[at], xs[at]
        box = [int(x.min()), int(y.min()), int(np.ptp(x) + 1), int(np.ptp(y) + 1)]
        part = np.zeros((box[3], box[2]), bool)
        part[y - box[1], x - box[0]] = True
        part = _fill(part)
        yield box, part, contour_area(part)


def shape_scores(img: np.ndarray) -> tuple[float, float]:
    """Circularity (4 pi area / outline^2, 1 at most) and rectangularity (area / bounding box) of the largest bright part.

    The bright side of the threshold counts, as documented: a dark seal on white
    paper is measured by the paper around it.
    """
    largest = max(_parts(grey(img) > otsu(img)), key=lambda found: found[2], default=None)
    if largest is None:
        return 0.0, 0.0
    _, part, area = largest
    around = _outline(part)
    return (min(1.0, 4 * np.pi * area / around**2) if around else 0.0), area / part.size


def signature_boxes(img: np.ndarray, most: int = 5) -> list[list[int]]:
    """Boxes of edge contours of plausible area and shape for a signature."""
    total = img.shape[0] * img.shape[1]
    return [b for b, _, area in _parts(edges(img)) if 0.001 < area / total < 0.15 and 1.5 < b[2] / b[3] < 8][:most]


def stamp_boxes(img: np.ndarray, most: int = 3) -> list[list[int]]:
    """Boxes of red or blue parts of plausible area for a seal."""
    total = img.shape[0] * img.shape[1]
    return [b for b, _, area in _parts(color_mask(img, (*RED, *BLUE))) if 0.002 < area / total < 0.10][:most]


def crop(img: np.ndarray, box: list[int], padding: float = 0.0, most: int | None = None) -> np.ndarray:
    """An xywh box cut out with a relative margin; reduced by whole steps if a side exceeds ``most``."""
    x, y, w, h = box
    px, py = int(w * padding), int(h * padding)
    out = img[max(0, y - py) : y + h + py, max(0, x - px) : x + w + px]
    step = -(-max(out.shape[:2]) // most) if most and max(out.shape[:2], default=0) > most else 1
    return out[::step, ::step]


def draw_signature(rng: np.random.Generator, w: int = 200, h: int = 60) -> np.ndarray:
    """Random pen strokes on white."""
    img = np.full((h, w), 255, np.uint8)
    for _ in range(int(rng.integers(6, 12))):
        t = np.linspace(0, 1, 4 * w)
        x = rng.uniform(0, w * 0.8) + t * rng.uniform(10, w * 0.2)
        y = h / 2 + np.sin(t * rng.uniform(3, 9) + rng.uniform(0, 6)) * rng.uniform(4, h / 2 - 3)
        img[np.clip(y, 0, h - 1).astype(int), np.clip(x, 0, w - 1).astype(int)] = 20
    return img


def draw_stamp(rng: np.random.Generator, size: int = 100) -> np.ndarray:
    """A coloured ring or frame on white."""
    img = np.full((size, size, 3), 255, np.uint8)
    y, x = np.mgrid[:size, :size]
    c = (size - 1) / 2
    away = np.hypot(x - c, y - c) if rng.random() < 0.5 else np.maximum(abs(x - c), abs(y - c))
    img[(away < size * 0.45) & (away > size * 0.38)] = (200, 20, 30) if rng.random() < 0.5 else (20, 40, 200)
    return img


def augment(img: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Seeded rotation (15 degrees at most), brightness, contrast, noise and an occluding bar."""
    h, w = img.shape[:2]
    a = np.deg2rad(rng.uniform(-15, 15))
    y, x = np.mgrid[:h, :w]
    u = np.rint(np.cos(a) * (x - w / 2) + np.sin(a) * (y - h / 2) + w / 2).astype(int)
    v = np.rint(-np.sin(a) * (x - w / 2) + np.cos(a) * (y - h / 2) + h / 2).astype(int)
    inside = (u >= 0) & (u < w) & (v >= 0) & (v < h)
    out = np.full(img.shape, 255.0)
    out[inside] = img[v[inside], u[inside]]
    out = (out - 128) * rng.uniform(0.8, 1.2) + 128 + rng.uniform(-30, 30) + rng.normal(0, 5, img.shape)
    if rng.random() < 0.3:
        at = int(rng.integers(0, max(1, w - w // 8)))
        out[:, at : at + w // 8] = 255
    return np.clip(out, 0, 255).astype(np.uint8)


def blend(page: np.ndarray, mark: np.ndarray, x: int, y: int) -> np.ndarray:
    """A mark multiplied onto a page (white is transparent)."""
    out = page.copy()
    h, w = min(mark.shape[0], page.shape[0] - y), min(mark.shape[1], page.shape[1] - x)
    part = mark[:h, :w] if mark.ndim == page.ndim else np.repeat(mark[:h, :w, None], 3, -1)
    out[y : y + h, x : x + w] = (out[y : y + h, x : x + w].astype(np.uint16) * part // 255).astype(np.uint8)
    return out
