"""Suffix order with common prefixes of one shard, by induced sorting with disk-backed queues.

Left-most S suffixes are sorted by words of eight bytes. They induce the order of all L
suffixes, and those the order of all S suffixes. Suffixes wait in queues, one per first
byte; a queue's arrival order is its priority. An entry carries the suffix, and
the length of the prefix it shares with the entry before it, which is one more than the
least such length between the suffixes that induced the two. Entries are taken in
batches; blocks beyond the memory bound go to an unlinked file of the task.

Symbol 0 ends a piece. Common prefixes are capped: a longer one counts as the cap.
"""

from __future__ import annotations

import tempfile
from collections import deque

import numpy as np

SYMBOLS = 257
MEMORY_BYTES = 64 * 1024 * 1024
BATCH = 1 << 16


class BlockQueues:
    """FIFO queues of (suffix, prefix) blocks by first symbol; blocks over the bound live on disk."""

    def __init__(self, memory_bytes: int = MEMORY_BYTES):
        self.blocks: list[deque] = [deque() for _ in range(SYMBOLS)]
        self.free = memory_bytes
        self.file = None
        self.spilled = 0

    def push(self, symbol: int, suffix: np.ndarray, prefix: np.ndarray) -> None:
        size = suffix.nbytes + prefix.nbytes
        if size <= self.free:
            self.free -= size
            self.blocks[symbol].append((suffix, prefix))
            return
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        at = self.file.tell()
        self.file.write(suffix.tobytes())
        self.file.write(prefix.tobytes())
        self.spilled += size
        self.blocks[symbol].append((at, len(suffix)))

    def pop(self, symbol: int, last: bool = False) -> tuple[np.ndarray, np.ndarray] | None:
        """The first blocks together, up to a batch; or the last block."""
        queue, found, n = self.blocks[symbol], [], 0
        while queue and n < (1 if last else BATCH):
            first, second = queue.pop() if last else queue.popleft()
            if isinstance(first, np.ndarray):
                self.free += first.nbytes + second.nbytes
            else:
                self.file.seek(first)
                suffix = np.frombuffer(self.file.read(8 * second), dtype=np.int64)
                first, second = suffix, np.frombuffer(self.file.read(2 * second), dtype=np.int16)
            found.append((first, second))
            n += len(first)
        if len(found) < 2:
            return found[0] if found else None
        return tuple(np.concatenate(part) for part in zip(*found))

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True for S suffixes: smaller than the suffix after them. The end is smaller than every symbol."""
    n = len(text)
    after = np.append(text[1:], -1)
    change = np.where(after != text, np.arange(n), n)
    change = np.minimum.accumulate(change[::-1])[::-1]  # last position of the run of equal symbols
    return text < after[change]


class Words:
    """The symbols of a text as numbers of eight bytes, the first symbol highest: eight symbols of one byte or four of two."""

    def __init__(self, text: np.ndarray, cap: int):
        kind = np.dtype(">u1" if not len(text) or int(text.max()) < 256 else ">u2")
        self.bits, self.width = 8 * kind.itemsize, 8 // kind.itemsize
        symbols = np.concatenate([text, np.zeros(cap + 8, dtype=text.dtype)]).astype(kind)
        # overlapping numbers, one from each symbol on
        n = len(symbols) - self.width + 1
        self.numbers = np.ndarray((n,), dtype=">u8", buffer=symbols.tobytes(), strides=(kind.itemsize,))

    def at(self, places: np.ndarray) -> np.ndarray:
        return self.numbers[places].astype(np.uint64)


def common_prefix(words: Words, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Symbols that the suffixes at ``a`` and ``b`` share, up to ``cap``, a word at a time."""
    out = np.zeros(len(a), dtype=np.int64)
    live = np.arange(len(a))
    for done in range(0, cap, words.width):
        if not len(live):
            break
        diff = words.at(a[live] + done) ^ words.at(b[live] + done)
        same = diff == 0
        extra = np.zeros(len(live), dtype=np.int64)
        for k in range(1, words.width):
            extra += diff >> np.uint64(64 - k * words.bits) == 0
        out[live] = done + np.where(same, words.width, extra)
        live = live[same]
    return np.minimum(out, cap)


def sort_by_words(words: Words, suffixes: np.ndarray, cap: int) -> np.ndarray:
    """``suffixes`` in order of their first ``cap`` symbols; only ties go on to the next word."""
    order = suffixes.copy()
    lo, group = np.arange(len(order)), np.zeros(len(order), dtype=np.int64)
    for done in range(0, cap, words.width):
        if not len(lo):
            break
        at = order[lo]
        word = words.at(at + done)
        # where most ties last, they mostly stand in order already
        new = np.append(True, group[1:] != group[:-1])
        if ((word[1:] < word[:-1]) & ~new[1:]).any():
            by = np.lexsort((word, group))
            order[lo] = at[by]
            word = word[by]
        new[1:] |= word[1:] != word[:-1]
        ids = np.cumsum(new) - 1
        tied = np.bincount(ids)[ids] > 1
        lo, group = lo[tied], ids[tied]
    return order


class RangeMinimum:
    """Minima of ranges of one batch, by doubling."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 ** len(self.rows) <= len(values):
            last, half = self.rows[-1], 2 ** (len(self.rows) - 1)
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Minimum over start..end, both included."""
        level = np.frexp((end - start + 1).astype(np.float64))[1] - 1
        out = np.empty(len(start), dtype=self.rows[0].dtype)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.rows[k]
            out[at] = np.minimum(row[start[at]], row[end[at] - 2**k + 1])
        return out


class Induction:
    """One pass: each taken suffix sends the suffix before it to the queue of its first symbol."""

    def __init__(self, text: np.ndarray, is_s: np.ndarray, wanted: bool, cap: int, memory_bytes: int):
        self.text, self.is_s, self.wanted, self.cap = text, is_s, wanted, cap
        self.queues = BlockQueues(memory_bytes)
        self.since = np.full(SYMBOLS, -1, dtype=np.int16)  # least prefix since the last push; -1: none yet

    def take(self, suffix: np.ndarray, prefix: np.ndarray) -> None:
        for i in range(0, len(suffix), BATCH):
            self._take(suffix[i : i + BATCH], prefix[i : i + BATCH])

    def _take(self, suffix: np.ndarray, prefix: np.ndarray) -> None:
        hit = np.flatnonzero(suffix > 0)
        hit = hit[self.is_s[suffix[hit] - 1] == self.wanted]
        lowest = prefix.min()
        if not len(hit):
            self.since = np.minimum(self.since, lowest)
            return
        before = suffix[hit] - 1
        symbol = self.text[before]
        by = np.argsort(symbol, kind="stable")
        hit, before, symbol = hit[by], before[by], symbol[by]
        first = np.append(True, symbol[1:] != symbol[:-1])
        heads = np.flatnonzero(first)
        tails = np.append(heads[1:], len(hit)) - 1
        least = np.empty(len(hit), dtype=np.int16)
        head_min = np.minimum.accumulate(prefix)[hit[heads]]
        least[heads] = np.minimum(self.since[symbol[heads]], head_min)
        rest = np.flatnonzero(~first)
        if len(rest):
            least[rest] = RangeMinimum(prefix).between(hit[rest - 1] + 1, hit[rest])
        shared = np.minimum(least + 1, self.cap).astype(np.int16)
        after = np.append(np.minimum.accumulate(prefix[::-1])[::-1], np.int16(self.cap))
        since = np.minimum(self.since, lowest)
        since[symbol[heads]] = after[hit[tails] + 1]
        self.since = since
        for s, a, b in zip(symbol[heads].tolist(), heads.tolist(), (tails + 1).tolist()):
            self.queues.push(s, before[a:b], shared[a:b])


def sorted_suffixes(text: np.ndarray, cap: int, memory_bytes: int = MEMORY_BYTES):
    """Yield (suffix, prefix) batches of all suffixes of ``text`` (symbols 0..256) in falling order.

    ``prefix`` is what a suffix shares with the one yielded before it. Suffixes equal in
    their first ``cap`` symbols come in any order.
    """
    n = len(text)
    if n == 0:
        return
    words = Words(text, cap)
    wide = text.astype(np.int64)
    is_s = suffix_types(wide)
    stars = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    stars = sort_by_words(words, stars, cap)
    shared = np.zeros(len(stars), dtype=np.int16)
    if len(stars) > 1:
        shared[1:] = common_prefix(words, stars[:-1], stars[1:], cap)
    bounds = np.searchsorted(wide[stars], np.arange(SYMBOLS + 1))

    def seam(last: int | None, first: int) -> np.int16:
        if last is None:
            return np.int16(0)
        return np.int16(common_prefix(words, np.array([last]), np.array([first]), cap)[0])

    # L suffixes in rising order, kept by first symbol
    rising = Induction(wide, is_s, False, cap, memory_bytes)
    rising.queues.push(int(wide[-1]), np.array([n - 1]), np.zeros(1, dtype=np.int16))
    rising.since[wide[-1]] = 0
    kept = BlockQueues(memory_bytes)
    for symbol in range(SYMBOLS):
        last = None
        while (block := rising.queues.pop(symbol)) is not None:
            kept.push(symbol, *block)
            last = int(block[0][-1])
            rising.take(*block)
        own = stars[bounds[symbol] : bounds[symbol + 1]]
        if len(own):
            prefix = shared[bounds[symbol] : bounds[symbol + 1]].copy()
            prefix[0] = seam(last, int(own[0]))
            rising.take(own, prefix)
    rising.queues.close()

    # all suffixes in falling order
    falling = Induction(wide, is_s, True, cap, memory_bytes)
    for symbol in range(SYMBOLS - 1, -1, -1):
        last = None
        while (block := falling.queues.pop(symbol)) is not None:
            last = int(block[0][-1])
            yield block
            falling.take(*block)
        blocks = kept.blocks[symbol]
        following: int | None = last
        carry = None
        while blocks:  # from the last block to the first, each turned round
            suffix, prefix = kept.pop(symbol, last=True)
            turned = suffix[::-1]
            # prefixes move by one: in falling order an entry has what its successor had
            moved = np.empty(len(prefix), dtype=np.int16)
            moved[1:] = prefix[:0:-1]
            moved[0] = seam(following, int(turned[0])) if carry is None else carry
            carry = prefix[0]
            yield turned, moved
            falling.take(turned, moved)
    falling.queues.close()
    kept.close()
