"""Similarity of values to all windows of words of their documents at once: the numbers of ``similarity`` on numpy arrays.

A longest common subsequence is a machine word (or a few) for each place where
windows begin; all places go ahead together, a character a step, and a step
gives the result of every window that ends there.
"""

from __future__ import annotations

import numpy as np

#: Bits of a value's characters in one machine word where it needs several, so that a carry is seen.
_LIMB = 62
#: Places where windows begin that are worked on together.
_BLOCK = 1 << 17
#: Numbers of characters, by code point; all 0 between calls.
_KIND = np.zeros(0x110000, np.uint16)


def lanes_of(limbs: int) -> tuple[int, np.uint64]:
    """Bits in each machine word, and all of them set."""
    return (64, ~np.uint64(0)) if limbs == 1 else (_LIMB, np.uint64((1 << _LIMB) - 1))


class Spans:
    """Normalised words of documents one after the other, as one text with the place of each word.

    ``left`` has for each word how many there are from it to the end of its
    page: windows don't cross pages. Words that are empty count in a window and
    add nothing to its text. ``values`` are what is looked for: first word and
    number of words of the document, text, least and most words of a window.
    """

    def __init__(self, norms: list[str], left: np.ndarray, values: list[tuple[int, int, str, int, int]]):
        self.left, n = left, len(norms)
        text = " ".join(filter(None, norms))
        size = np.fromiter(map(len, norms), np.int64, n)
        step = size + (size > 0)
        after = np.cumsum(step)
        self.start, self.end = after - step, after - 1
        self.first, self.n_words, _, self.low, self.high = (np.array(x, np.int64) for x in zip(*[(a, b, 0, c, d) for a, b, _, c, d in values])) if values else [np.empty(0, np.int64)] * 5
        texts = [v[2] for v in values]
        self.length = np.fromiter(map(len, texts), np.int64, len(texts))
        points = self._points("".join(texts))
        kinds = np.unique(points)
        _KIND[kinds] = np.arange(1, len(kinds) + 1, dtype=np.uint16)
        self.codes, self.own = _KIND[self._points(text)].astype(np.intp), _KIND[points].astype(np.intp)
        _KIND[kinds] = 0
        self.kinds = len(kinds) + 1
        value = np.repeat(np.arange(len(texts)), self.length)
        self._at = np.arange(len(points)) - np.repeat(np.cumsum(self.length) - self.length, self.length)
        self._value = value
        # characters of each kind before each word, and in all; and of each value
        word = np.repeat(np.arange(n), step)[: len(self.codes)]
        per = np.bincount(self.codes * n + word, minlength=n * self.kinds).reshape(self.kinds, n)
        self.before = np.zeros((self.kinds, n + 1), np.int32)
        np.cumsum(per, axis=1, out=self.before[:, 1:])
        count = np.bincount(value * self.kinds + self.own, minlength=len(texts) * self.kinds).reshape(len(texts), self.kinds)
        self._count = count
        usual = self.before[:, -1] / max(1, len(self.codes))  # what a window probably lacks comes first
        rank = np.argsort(np.where(count > 0, usual * self.length[:, None] - count, np.inf), axis=1)[:, : int((count > 0).sum(1).max(initial=0))]
        self._kind_by_rank, self._count_by_rank = rank, np.take_along_axis(count, rank, 1)
        self._rest_by_rank = self.length[:, None] - np.cumsum(self._count_by_rank, axis=1)

    @staticmethod
    def _points(text: str) -> np.ndarray:
        if text.isascii():
            return np.frombuffer(text.encode(), np.uint8)
        return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)

    def windows(self, shortest: np.ndarray, longest: np.ndarray, enough=None):
        """Blocks of windows with as many characters as their value asks for: value, first word, words, characters, lane.

        Windows that begin at one word are a lane, and lanes go up from 0.
        ``enough`` gives, from values and characters, how many of those a window
        must share with its value; lanes without such windows are left out.
        """
        possible = np.ones(len(self.low), bool)
        if enough is not None:  # what the whole document shares with a value
            there = self.before[:, self.first + self.n_words] - self.before[:, self.first]
            possible = np.minimum(there.T, self._count).sum(1) >= enough(np.arange(len(self.low)), shortest)
        for low, high in np.unique(np.stack([self.low, self.high], 1), axis=0).tolist():
            of = np.flatnonzero((self.low == low) & (self.high == high) & possible)
            if not len(of):
                continue
            stop = np.cumsum(self.n_words[of])
            for began in range(0, int(stop[-1]), _BLOCK):
                at = np.arange(began, min(began + _BLOCK, int(stop[-1])))
                k = np.searchsorted(stop, at, "right")
                v = of[k]
                i = at - (stop[k] - self.n_words[v]) + self.first[v]
                start, left, least, most = self.start[i], self.left[i], shortest[v], longest[v]
                words, letters = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
                found = []
                for size in range(low, min(high, int(left.max(initial=0))) + 1):
                    fits = np.flatnonzero(left >= size)
                    length = np.maximum(self.end[i[fits] + (size - 1)] - start[fits], 0)
                    ok = (length >= least[fits]) & (length <= most[fits])
                    own, length = fits[ok], length[ok]
                    letters[own] = np.where(words[own] > 0, letters[own], length)
                    words[own] = size
                    found.append((own, np.full(len(own), size), length))
                if not found:
                    continue
                own, size, length = (np.concatenate(x) for x in zip(*found))
                alive = np.flatnonzero(words)
                if enough is not None:
                    alive = alive[self.shared(v[alive], i[alive], words[alive], enough(v[alive], letters[alive]))]
                lane = np.full(len(at), -1)
                lane[alive] = np.arange(len(alive))
                lane = lane[own]
                if len(alive) and (lane < 0).any():
                    ok = lane >= 0
                    own, size, length, lane = own[ok], size[ok], length[ok], lane[ok]
                if len(alive):
                    yield v[own], i[own], size, length, lane

    def shared(self, v: np.ndarray, i: np.ndarray, size: np.ndarray, enough: np.ndarray) -> np.ndarray:
        """The windows that have ``enough`` characters in common with their value, with repeats; as numbers of windows."""
        own = np.arange(len(v))
        have, before, n, stop = np.zeros(len(v), np.int64), self.before.ravel(), self.before.shape[1], i + size
        for rank in range(self._kind_by_rank.shape[1]):
            of = v[own]
            kind, most = self._kind_by_rank[of, rank], self._count_by_rank[of, rank]
            kind = kind * n
            have[own] += np.minimum(before[kind + stop[own]] - before[kind + i[own]], most)
            own = own[have[own] + self._rest_by_rank[of, rank] >= enough[own]]
            if not len(own):
                break
        return own

    def masks(self, of: np.ndarray, limbs: int, backwards: bool = False) -> np.ndarray:
        """For values ``of`` and each kind of character a bit for each of its places: by limb, value and kind."""
        wide = 64 if limbs == 1 else _LIMB
        number = np.full(len(self.length), -1)
        number[of] = np.arange(len(of))
        mine = number[self._value] >= 0
        v, at = self._value[mine], self._at[mine]
        if backwards:
            at = self.length[v] - 1 - at
        out = np.zeros((limbs, len(of) * self.kinds), np.uint64)
        np.bitwise_or.at(out, (at // wide, number[v] * self.kinds + self.own[mine]), np.uint64(1) << (at % wide).astype(np.uint64))
        return out

    def lcs(self, v: np.ndarray, at: np.ndarray, length: np.ndarray, lane: np.ndarray) -> np.ndarray:
        """Longest common subsequence of values and stretches of the text, from the character ``at`` on, ``length`` long.

        Stretches of a ``lane`` have one value and one beginning.
        """
        out = np.zeros(len(v), np.int64)
        limbs = np.where(self.length[v] <= 64, 1, -(-self.length[v] // _LIMB))
        for n in np.unique(limbs).tolist():
            own = np.flatnonzero((limbs == n) & (length > 0) & (self.length[v] > 0))
            if len(own):
                out[own] = self._lcs(n, v[own], at[own], length[own], lane[own])
        return out

    def _lcs(self, limbs: int, v: np.ndarray, at: np.ndarray, length: np.ndarray, lane: np.ndarray) -> np.ndarray:
        steps = np.zeros(int(lane.max()) + 1, np.int64)
        np.maximum.at(steps, lane, length)
        most = int(length.max())
        short = np.uint16 if most < 1 << 16 else np.int64  # short numbers are sorted by digits
        order = np.argsort((most - steps).astype(short), kind="stable")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        lane, steps = back[lane], steps[order]
        active = np.searchsorted(-steps, -np.arange(most + 1), "right")
        by_length = np.argsort(length.astype(short), kind="stable")
        ends = np.searchsorted(length[by_length], np.arange(most + 2))
        used = np.zeros(len(self.length), bool)
        used[v] = True
        of, number = np.flatnonzero(used), np.cumsum(used) - 1
        base, place = np.zeros(len(steps), np.intp), np.zeros(len(steps), np.intp)
        base[lane], place[lane] = number[v] * self.kinds, at
        table, codes = self.masks(of, limbs), np.concatenate([self.codes, np.zeros(most, np.intp)])
        wide, full = lanes_of(limbs)
        row = np.full((limbs, len(steps)), full)
        size = self.length[v] - (limbs - 1) * wide
        last = np.where(size < 64, (np.uint64(1) << np.minimum(size, 63).astype(np.uint64)) - np.uint64(1), ~np.uint64(0))
        out = np.zeros(len(v), np.int64)
        for k in range(1, most + 1):
            n = active[k]
            kind = codes.take(place[:n])
            kind += base[:n]
            if limbs == 1:
                r = row[0, :n]
                hit = table[0].take(kind)
                hit &= r
                less = r - hit
                r += hit
                r |= less
            else:
                carry = np.uint64(0)
                for j in range(limbs):
                    r = row[j, :n]
                    hit = table[j].take(kind)
                    hit &= r
                    less = r - hit
                    r += hit
                    r += carry
                    carry = r >> np.uint64(_LIMB)
                    r &= full
                    r |= less
            place[:n] += 1
            if ends[k] < ends[k + 1]:
                own = by_length[ends[k] : ends[k + 1]]
                rows = row[:, lane[own]]
                rows[-1] &= last[own]
                out[own] = self.length[v[own]] - np.bitwise_count(rows).sum(0, dtype=np.int64)
        return out

    def ratio(self, least: float) -> list[np.ndarray]:
        """Windows whose ratio to their value is ``least`` (over 0) or more: value, first word, words, score."""
        n = self.length
        shortest = np.maximum(np.floor(least * n / (200 - least)), n > 0)
        longest = np.ceil(n * (200 - least) / least)
        found = []
        for v, i, size, length, lane in _gathered(self.windows(shortest, longest, lambda v, length: least * (n[v] + length) / 200 - 1e-6)):
            both = n[v] + length
            score = np.where(both > 0, 200.0 * self.lcs(v, self.start[i], length, lane) / np.maximum(both, 1), 100.0)
            ok = score >= least
            found.append((v[ok], i[ok], size[ok], score[ok]))
        if not found:
            return [np.empty(0, np.int64)] * 3 + [np.empty(0)]
        return [np.concatenate(x) for x in zip(*found)]


def _gathered(blocks):
    """Blocks of windows put together to as many lanes as a block may have."""
    own, lanes = [], 0
    for block in blocks:
        own.append((*block[:-1], block[-1] + lanes))
        lanes += int(block[-1].max()) + 1
        if lanes >= _BLOCK:
            yield [np.concatenate(x) for x in zip(*own)]
            own, lanes = [], 0
    if own:
        yield [np.concatenate(x) for x in zip(*own)]


def words_left(n_words: list[int], page_words: int | None = None) -> np.ndarray:
    """For each word of documents of so many words how many there are from it to the end of its page (or document)."""
    n = np.array(n_words, np.int64)
    of = np.repeat(n, n)
    at = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    return np.minimum(of, (at // page_words + 1) * page_words) - at if page_words else of - at
