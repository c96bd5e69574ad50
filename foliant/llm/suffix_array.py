"""Suffix arrays by linear grouping, and the repeated windows of a small collection of byte strings.

`suffix_array` sorts suffixes in two phases without recursive renaming. The first sorts them into groups by their longest
Lyndon prefix: groups are processed in descending order; each suffix of the group points to the previous suffix of a lower
group, and suffixes pointed to leave their groups upwards, those pointed to most often highest. The second walks the
array in ascending order and places, for each suffix met, the chain of previous-smaller pointers that ends before it.

`repeated_windows` sorts the suffixes of a prefix-free parse of the strings instead of all bytes: phrases begin at
triggers, which eight bytes decide, and each includes the trigger that ends it, so that no phrase is the start of
another and the order of phrase ranks is the order of the bytes. The suffixes between triggers follow from the phrase
suffix behind them.
"""

from __future__ import annotations

import numpy as np

#: Bytes that decide a trigger, and one of how many positions is one on average.
TRIGGER, RARITY = 8, 16
_MIX, _BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)


def loads(text: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """The eight bytes from each position (of `at`) on as an integer; text must go on eight bytes behind the last."""
    if at is None:
        words = np.zeros(max(len(text) - 7, 0), np.uint64)
        for j in range(8):
            words |= text[j : len(words) + j].astype(np.uint64) << np.uint64(8 * j)
        return words
    words = np.zeros(len(at), np.uint64)
    for j in range(8):
        words |= text[at + j].astype(np.uint64) << np.uint64(8 * j)
    return words


def mixed(words: np.ndarray) -> np.ndarray:
    x = words * _MIX
    x ^= x >> np.uint64(32)
    x *= _BASE
    return x ^ (x >> np.uint64(29))


def triggers(text: np.ndarray) -> np.ndarray:
    """Positions at which the next eight bytes are a trigger."""
    return np.flatnonzero(mixed(loads(text)) >> np.uint64(32) < np.uint64(2**32 // RARITY))


def suffix_array(symbols: list[int]) -> list[int]:
    """The suffix array of symbols, of which the last must be the smallest and occur once."""
    n = len(symbols)
    unset = -2
    names = {c: g for g, c in enumerate(sorted(set(symbols)))}
    group = [names[c] for c in symbols]
    members: list[list[int]] = [[] for _ in names]
    for i, g in enumerate(group):
        members[g].append(i)
    size = [len(m) for m in members]
    below = [g - 1 for g in range(len(names))]
    above = [g + 1 for g in range(len(names))]
    above[-1] = -1
    previous = [unset] * n
    done = []
    g = len(names) - 1
    while g >= 0:
        own = sorted(s for s in members[g] if group[s] == g) if size[g] != len(members[g]) else members[g] if g < len(names) else sorted(members[g])
        members[g] = own
        done.append(g)
        pointed: dict[int, int] = {}
        for s in own:
            p = s - 1
            while p >= 0 and (q := previous[p]) != unset:  # processed suffixes are in higher groups, or earlier in this one
                p = q
            previous[s] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        if pointed:
            leaving: dict[tuple[int, int], list[int]] = {}
            for p, times in pointed.items():
                leaving.setdefault((times, group[p]), []).append(p)
            for (_, low), out in sorted(leaving.items(), key=lambda x: -x[0][0]) if len(leaving) > 1 else leaving.items():
                if len(out) == size[low]:
                    continue
                new, up = len(members), above[low]
                members.append(out)
                size.append(len(out))
                size[low] -= len(out)
                for p in out:
                    group[p] = new
                below.append(low)
                above.append(up)
                above[low] = new
                if up >= 0:
                    below[up] = new
        g = below[g]
    free, at = [0] * len(members), 0
    for g in reversed(done):
        free[g] = at
        at += len(members[g])
    order, placed = [0] * n, [False] * n
    order[0], placed[n - 1] = n - 1, True
    for i in range(n):
        j = order[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            order[free[g]] = j
            free[g] += 1
            placed[j] = True
            j = previous[j]
    return order


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """How many bytes, up to `most`, agree from positions a and b on."""
    out = np.full(len(a), most, np.int32)
    left = np.arange(len(a))
    for lo in range(0, most, 32):
        if not len(left):
            break
        span = np.arange(lo, min(lo + 32, most))
        differ = text[a[left, None] + span] != text[b[left, None] + span]
        ends = differ.any(axis=1)
        out[left[ends]] = lo + differ[ends].argmax(axis=1)
        left = left[~ends]
    return out


class _Minima:
    """Minima of ranges, from tables for lengths that are powers of two."""

    def __init__(self, values: np.ndarray):
        self.tables = [values]
        while (step := 1 << (len(self.tables) - 1)) * 2 <= len(values):
            last = self.tables[-1]
            self.tables.append(np.minimum(last[:-step], last[step:]))

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The minimum of values[lo:hi]; lo < hi."""
        out = np.empty(len(lo), self.tables[0].dtype)
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        for k in np.unique(level):
            at = level == k
            t = self.tables[k]
            out[at] = np.minimum(t[lo[at]], t[hi[at] - (1 << int(k))])
        return out


def repeated_windows(strings: list[bytes], width: int) -> list[np.ndarray]:
    """Per string, for each window of `width` bytes by its start, whether its bytes stand anywhere else in the strings."""
    ends = np.cumsum([len(s) + 1 for s in strings])
    starts = ends - [len(s) + 1 for s in strings]
    text = np.zeros(int(ends[-1]) + width + 8, np.int16)  # 0 between strings; bytes are 1 to 256
    for s, at in zip(strings, starts.tolist(), strict=True):
        text[at : at + len(s)] = np.frombuffer(s, np.uint8).astype(np.int16) + 1
    raw = (text - 1).astype(np.uint8)
    which = np.repeat(np.arange(len(strings)), ends - starts)
    cut = triggers(raw[: int(ends[-1]) + 7])
    cut = cut[cut + TRIGGER < ends[which[cut]]]
    sizes = np.array([max(0, len(s) - width + 1) for s in strings])
    window = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(int(sizes.sum()))
    found = np.zeros(len(window), bool)
    if not len(window):
        return [found for _ in strings]

    # the parse: one separator before each string, phrases from trigger to trigger, the end
    owner = which[cut]
    last = np.append(owner[1:] != owner[:-1], True)[: len(cut)]
    stop = np.where(last, ends[owner] - 1, np.append(cut[1:], 0)[: len(cut)] + TRIGGER)
    whole = raw.tobytes()
    phrases = [whole[a:b] for a, b in zip(cut.tolist(), stop.tolist(), strict=True)]
    rank = {p: i + 2 for i, p in enumerate(sorted(set(phrases)))}
    slot = np.arange(len(cut)) + owner + 1
    symbols = np.ones(len(cut) + len(strings) + 1, np.int64)
    symbols[slot] = [rank[p] for p in phrases]
    symbols[-1] = 0
    order = np.array(suffix_array(symbols.tolist()))
    place = np.full(len(symbols), -1)
    place[slot] = cut
    sorted_at = place[order]
    sorted_at = sorted_at[sorted_at >= 0]
    rank_of = np.zeros(len(text), np.int64)
    rank_of[sorted_at] = np.arange(len(sorted_at))
    shared = _common(text, sorted_at[:-1], sorted_at[1:], width) if len(sorted_at) > 1 else np.zeros(1, np.int32)

    # every window by the bytes before its first trigger and the rank of the phrase suffix there
    nxt = np.searchsorted(cut, window)
    trig = np.append(cut, len(text))[nxt]
    inside = trig + TRIGGER <= window + width
    tail = np.where(inside, trig - window, width)
    powers = np.cumprod(np.full(len(text), _BASE))
    inverse = np.cumprod(np.full(len(text), np.uint64(pow(int(_BASE), -1, 2**64))))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(text.astype(np.uint64)) * powers)])
    key = mixed((sums[window + tail] - sums[window]) * inverse[window]) ^ mixed(tail.astype(np.uint64))
    at = np.where(inside, rank_of[np.minimum(trig, len(text) - 1)], 0)
    by = np.lexsort((at, key))
    a, b = by[:-1], by[1:]
    same = (key[a] == key[b]) & (tail[a] == tail[b])
    a, b = a[same], b[same]
    ok = ~inside[a]
    if ask := inside[a].any():
        ask = np.flatnonzero(inside[a])
        lo, hi = at[a[ask]], at[b[ask]]
        ok[ask] = _Minima(shared).of(lo, hi) >= width - tail[a[ask]]
    found[a[ok]] = True
    found[b[ok]] = True
    return np.split(found, np.cumsum(sizes)[:-1])
