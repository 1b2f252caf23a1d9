"""XXH64 of many spans of a byte array at once: spans of one length go through the published steps
together, lane by lane; long and rare lengths use the xxhash library."""

from __future__ import annotations

import numpy as np
import xxhash

# The five primes of XXH64.
P1, P2, P3, P4, P5 = (
    np.uint64(x)
    for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)
#: Longer spans, and lengths with fewer spans, go to the library.
LONGEST, FEWEST = 128, 64


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _lane(acc, lane):
    return _turn(acc + lane * P2, 31) * P1


def _same_length(data: np.ndarray, starts: np.ndarray, n: int, seed: int) -> np.ndarray:
    wide = (n + 7) // 8 * 8
    block = np.zeros((len(starts), wide), dtype=np.uint8)
    block[:, :n] = np.lib.stride_tricks.sliding_window_view(data, n)[starts]
    lanes, at, seed = block.view("<u8"), 0, np.uint64(seed)
    with np.errstate(over="ignore"):
        if n >= 32:
            acc = [np.full(len(starts), x, dtype=np.uint64) for x in (seed + P1 + P2, seed + P2, seed, seed - P1)]
            while at + 32 <= n:
                acc = [_lane(a, lanes[:, at // 8 + j]) for j, a in enumerate(acc)]
                at += 32
            h = _turn(acc[0], 1) + _turn(acc[1], 7) + _turn(acc[2], 12) + _turn(acc[3], 18)
            for a in acc:
                h = (h ^ _lane(np.uint64(0), a)) * P1 + P4
        else:
            h = np.full(len(starts), seed + P5, dtype=np.uint64)
        h += np.uint64(n)
        while at + 8 <= n:
            h = _turn(h ^ _lane(np.uint64(0), lanes[:, at // 8]), 27) * P1 + P4
            at += 8
        if at + 4 <= n:
            h = _turn(h ^ (block[:, at : at + 4].copy().view("<u4").ravel().astype(np.uint64) * P1), 23) * P2 + P3
            at += 4
        while at < n:
            h = _turn(h ^ (block[:, at].astype(np.uint64) * P5), 11) * P1
            at += 1
        h = (h ^ (h >> np.uint64(33))) * P2
        h = (h ^ (h >> np.uint64(29))) * P3
        return h ^ (h >> np.uint64(32))


def xxh64_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    out = np.empty(len(starts), dtype=np.uint64)
    if not len(starts):
        return out
    sizes = ends - starts
    order = np.argsort(sizes, kind="stable")
    kinds, first = np.unique(sizes[order], return_index=True)
    raw = None
    for n, a, b in zip(kinds.tolist(), first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
        own = order[a:b]
        if 0 < n <= LONGEST and len(own) >= FEWEST:
            out[own] = _same_length(data, starts[own], n, seed)
        else:
            raw = memoryview(data.tobytes()) if raw is None else raw
            out[own] = [xxhash.xxh64_intdigest(raw[s : s + n], seed) for s in starts[own].tolist()]
    return out
