"""Hashes of words and shingles, computed over whole batches of texts."""

from __future__ import annotations

#: Bytes hashed at once; longer texts are cut at blanks.
STRETCH = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list = []


def mix(values):
    """A bijection of 64-bit numbers that spreads every bit."""
    import numpy as np

    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers(n: int):
    """Powers of the base and of its inverse up to ``n``."""
    import numpy as np

    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(n + 1, STRETCH + 1)
        _POWERS[:] = [np.full(size, b, "uint64") for b in (_BASE, _INVERSE)]
        for p in _POWERS:
            p[0] = 1
            np.multiply.accumulate(p, out=p)
    return _POWERS


def _hashed(data, offsets, lower: bool):
    """(hash, text) of each word of texts that lie one after another in ``data``; ``offsets`` from 0."""
    import numpy as np

    if lower:
        data = data + (((data >= 65) & (data <= 90)) * np.uint8(32))
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    starts = ~blank
    starts[1:] &= blank[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    starts[inner] = ~blank[inner]
    at = np.flatnonzero(starts)
    if not len(at):
        return np.zeros(0, "uint64"), np.zeros(0, "int64")
    ends = ~blank
    ends[:-1] &= blank[1:]
    ends[inner - 1] = ~blank[inner - 1]
    stop = np.flatnonzero(ends) + 1
    up, down = _powers(len(data))
    total = np.concatenate((np.zeros(1, "uint64"), np.cumsum((data.astype("uint64") + np.uint64(0x3D4D51CB)) * up[: len(data)], dtype="uint64")))
    hashes = (total[stop] - total[at]) * down[at]
    return mix(hashes + (stop - at).astype("uint64") * np.uint64(0xA24BAED4963EE407)), np.searchsorted(offsets, at, "right") - 1


def word_hashes(data, offsets, lower: bool = True):
    """Per stretch of texts: (first text, hash of each word, text of each word); words are runs of bytes other than 9 to 13 and 32."""
    import numpy as np

    i, n = 0, len(offsets) - 1
    while i < n:
        j = i + 1
        while j < n and offsets[j + 1] - offsets[i] <= STRETCH:
            j += 1
        a, b = int(offsets[i]), int(offsets[j])
        if b - a <= STRETCH:
            hashes, text = _hashed(data[a:b], offsets[i : j + 1] - a, lower)
            yield i, j, hashes, text
        else:
            parts, at = [], a
            while at < b:
                to = min(at + STRETCH, b)
                if to < b:
                    some = data[at:to]
                    blanks = np.flatnonzero((some == 32) | ((some >= 9) & (some <= 13)))
                    if len(blanks):
                        to = at + int(blanks[-1]) + 1
                    else:
                        rest = data[to:b]
                        blanks = np.flatnonzero((rest == 32) | ((rest >= 9) & (rest <= 13)))
                        to = to + int(blanks[0]) + 1 if len(blanks) else b
                parts.append(_hashed(data[at:to], np.array([0, to - at]), lower)[0])
                at = to
            hashes = np.concatenate(parts)
            yield i, j, hashes, np.zeros(len(hashes), "int64")
        i = j


def shingle_sets(data, offsets, size: int):
    """Per text its distinct word shingles as sorted 64-bit hashes; fewer words make one shingle, none make none."""
    import numpy as np

    factors = mix(np.arange(1, size + 1, dtype="uint64") * np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)
    for i, j, hashes, text in word_hashes(data, offsets):
        if len(hashes) >= size:
            windows = hashes[: len(hashes) - size + 1] * factors[0]
            for k in range(1, size):
                windows = windows + hashes[k : len(hashes) - size + 1 + k] * factors[k]
            windows = mix(windows)
        bounds = np.searchsorted(text, np.arange(j - i + 1))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a >= size:
                yield np.unique(windows[a : b - size + 1])
            elif b > a:
                short = (hashes[a:b] * factors[: b - a]).sum(dtype="uint64") + np.uint64(b - a)
                yield mix(np.array([short], "uint64"))
            else:
                yield np.zeros(0, "uint64")
