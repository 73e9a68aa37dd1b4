"""External induced sorting: the suffixes of a text in order, with the prefix each shares with its neighbour.

A suffix is of type S if it is less than the one behind it, of type L if it is greater; S* are the
S ones behind an L. Once the S* are in order, one pass from the least symbol up puts all L
in order: a suffix taken from the queue hands in the one before it, if that is L. A pass from the
greatest symbol down does the same for S. The queue holds tuples of (symbol, position, symbol before,
common prefix, run of the first symbol); it is taken in blocks, as far as nothing handed in by a
block belongs inside it. The common prefix of two neighbours handed in is one more than the least
since the one that handed in the first. To order the S*, two such passes over unordered ones give the
order of the substrings between them, these get names, and the text of names is sorted the same way.

Queues, lists and texts of names lie in files of ``folder`` as soon as they are larger than ``memory``
items, so that a text may be far larger than memory.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np

# What a text's symbols are raised by: 0 ends the text, 1 stands between its parts
END, BETWEEN, RAISED = 0, 1, 2
# Stands for "equal throughout" while substrings are named
EQUAL = 1 << 30
CHUNK = 1 << 13
MEMORY = 1 << 22


def _joined(parts: list[np.ndarray], dtype: np.dtype) -> np.ndarray:
    """As numpy's concatenate, which is slow for few rows of several fields."""
    bytes_of = f"V{dtype.itemsize}"
    return np.concatenate([p.view(bytes_of) for p in parts]).view(dtype)


def item_type(length: int) -> np.dtype:
    place = "<i4" if length < 1 << 31 else "<i8"
    return np.dtype([("key", "<i4"), ("pos", place), ("before", "<i4"), ("common", "<i4"), ("run", "<i4")])


def _order(keys: np.ndarray) -> np.ndarray:
    """Stable order of keys from 0 on; small ones are sorted by radix."""
    return np.argsort(keys.astype(np.uint16) if len(keys) and keys.max() < 1 << 16 else keys, kind="stable")


def _up_to(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """How many of the sorted ``keys`` are at most each of ``values``."""
    top = int(keys[-1])
    if top > 4 * len(keys):
        return np.searchsorted(keys, values.astype(keys.dtype), "right")
    return np.cumsum(np.bincount(keys, minlength=top + 1))[np.clip(values, 0, top)]


class Room:
    """Arrays in memory if they are small, in files of one folder if not."""

    def __init__(self, folder: str, memory: int = MEMORY):
        self.folder, self.memory = folder, memory

    def array(self, size: int, dtype) -> np.ndarray:
        if size <= self.memory:
            return np.zeros(size, dtype)
        return np.memmap(self._file(), dtype, "w+", shape=(size,))

    def kept(self, parts: Iterable[np.ndarray], dtype) -> np.ndarray:
        """All parts in a row."""
        held, count, file = [], 0, None
        for part in parts:
            held.append(part)
            count += len(part)
            if sum(map(len, held)) > self.memory:
                file = file or open(self._file(), "wb")
                for each in held:
                    each.tofile(file)
                held = []
        if file is None:
            return np.concatenate(held) if held else np.zeros(0, dtype)
        for each in held:
            each.tofile(file)
        file.close()
        return np.memmap(file.name, dtype, "r", shape=(count,))

    def _file(self) -> str:
        handle, name = tempfile.mkstemp(dir=self.folder)
        os.close(handle)
        return name

    @staticmethod
    def free(*arrays: np.ndarray) -> None:
        """Files of arrays that nothing reads any more."""
        for array in arrays:
            name = getattr(array, "filename", None)
            if name:
                os.unlink(name)


class Queue:
    """A priority queue of items by key, first in first out for equal keys, taken in blocks.

    It is a list of sorted runs, oldest first. Every ``FAN`` young runs that were merged as often are merged
    again; large runs go to files, and when there are many of these they are merged into one, block by block.
    """

    FAN, FILES = 4, 32

    def __init__(self, room: Room, dtype):
        self.room, self.dtype = room, dtype
        # [items, how many are taken, how often they were merged; -1: in a file]
        self.runs: list[list] = []

    def push(self, items: np.ndarray) -> None:
        """Items in order of key."""
        if not len(items):
            return
        self.runs.append([items, 0, 0])
        while len(self.runs) >= self.FAN and len({r[2] for r in self.runs[-self.FAN :]}) == 1 and self.runs[-1][2] >= 0:
            young = self.runs[-self.FAN :]
            both = _joined([items[taken:] for items, taken, _ in young], self.dtype)
            self.runs[-self.FAN :] = [[both[_order(both["key"])], 0, young[0][2] + 1]]
        last = self.runs[-1][0]
        if len(last) > self.room.memory // 4 and not isinstance(last, np.memmap):
            self.runs[-1] = [self._filed([last]), 0, -1]
            files = [r for r in self.runs if r[2] < 0]
            if len(files) > self.FILES and len(files) == len(self.runs):
                merged = Queue(self.room, self.dtype)
                merged.runs = files
                self.runs = [[self._filed(merged.drained()), 0, -1]]

    def _filed(self, parts: Iterable[np.ndarray]) -> np.ndarray:
        return Room(self.room.folder, 0).kept(parts, self.dtype)

    def peek(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """The first items in order, about ``window`` of each run, and which run each is from."""
        heads, bound, cut = [], None, None
        for number, (items, taken, _) in enumerate(self.runs):
            head = items[taken : taken + window]
            heads.append(head)
            if taken + window < len(items) and (bound is None or head["key"][-1] < bound):
                bound, cut = head["key"][-1], number
        if bound is not None:
            # Of the bound's own key, what younger runs hold comes behind what the cut one still has
            sides = ["right" if number <= cut else "left" for number in range(len(heads))]
            heads = [h[: np.searchsorted(h["key"], bound, side)] for h, side in zip(heads, sides)]
        if not heads:
            return np.zeros(0, self.dtype), np.zeros(0, np.int32)
        items = _joined(heads, self.dtype)
        origin = np.repeat(np.arange(len(heads), dtype=np.int32), [len(h) for h in heads])
        order = _order(items["key"])
        return items[order], origin[order]

    def take(self, origin: np.ndarray) -> None:
        """Done with items that ``peek`` gave; ``origin``: their runs."""
        for number, count in enumerate(np.bincount(origin, minlength=len(self.runs))):
            self.runs[number][1] += int(count)
        for items, taken, _ in self.runs:
            if taken >= len(items):
                self.room.free(items)
        self.runs = [r for r in self.runs if r[1] < len(r[0])]

    def drained(self, window: int = 1 << 13) -> Iterator[np.ndarray]:
        while True:
            items, origin = self.peek(window)
            if not len(items):
                return
            self.take(origin)
            yield items


class Seeds(Queue):
    """Items in order that a pass starts from, as the first run of its queue; it is never merged with others."""

    def __init__(self, room: Room, dtype, seeds: np.ndarray):
        super().__init__(room, dtype)
        self.seeds = [seeds, 0, -1]

    def peek(self, window):
        young, self.runs = self.runs, [self.seeds, *self.runs]
        found = super().peek(window)
        self.runs = young
        return found

    def take(self, origin):
        self.seeds[1] += int((origin == 0).sum())
        super().take(origin[origin > 0] - 1)


class Reversed:
    """L items as the seeds of the way down, read from the back as they are asked for."""

    def __init__(self, items: np.ndarray, top: int):
        self.items, self.top = items, top

    def __len__(self):
        return len(self.items)

    def __getitem__(self, part: slice) -> np.ndarray:
        n = len(self.items)
        begin, end = part.start, min(part.stop, n)
        if begin >= end:
            return np.zeros(0, self.items.dtype)
        out = np.array(self.items[n - end : n - begin][::-1])
        # What an item shares with the next one up
        up = self.items["common"][n - end + 1 : n - begin + 1][::-1]
        out["common"] = up if begin else np.concatenate([[0], up])
        out["key"] = 2 * (self.top - (out["key"] >> 1)) + 1
        return out


class Tail:
    """Least common prefix since a place, of the symbol's items that were taken before the block."""

    def __init__(self):
        self.begin, self.places, self.least = 0, np.zeros(0, np.int64), np.zeros(0, np.int32)

    def since(self, places: np.ndarray) -> np.ndarray:
        """Least of the items behind each place; EQUAL where there is none."""
        at = np.searchsorted(self.places, places, "right")
        return np.append(self.least, EQUAL)[at]

    def grow(self, begin: int, common: np.ndarray, fresh: np.ndarray) -> None:
        """The block's items from place ``begin`` on; ``fresh``: where a new symbol begins."""
        places = np.arange(begin, begin + len(common))
        if len(fresh):
            start = fresh[-1]
            self.begin, places, least = begin + int(start), places[start:], common[start:]
        else:
            places, least = np.concatenate([self.places, places]), np.concatenate([self.least, common])
        later = np.append(np.minimum.accumulate(least[::-1])[::-1][1:], EQUAL)
        kept = least < later
        self.places, self.least = places[kept], least[kept]


def _range_least(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least of ``values[first..last]``, both included, for many ranges."""
    out = np.empty(len(first), values.dtype)
    if not len(first):
        return out
    level = np.log2(last - first + 1).astype(np.int64)
    table = values
    for step in range(int(level.max()) + 1):
        if step:
            half = 1 << (step - 1)
            table = np.minimum(table[:-half], table[half:])
        here = np.flatnonzero(level == step)
        if len(here):
            out[here] = np.minimum(table[first[here]], table[last[here] - (1 << step) + 1])
    return out


def scan(text: np.ndarray, top: int, seeds, down: bool, cap: int, room: Room) -> Iterator[np.ndarray]:
    """A pass over seeds (odd keys) and all that is handed in from them (even keys), in blocks of items in order.

    ``key`` is twice the first symbol, or what it lacks to ``top`` on the way down; ``common`` is what the
    item shares with the one before it in this order, up to ``cap``.
    """
    dtype = item_type(len(text))
    queue = Seeds(room, dtype, seeds)
    last_place = room.array(top + 1, np.int64)
    last_place[:] = -1
    tail, done, window = Tail(), 0, 1024
    last_key, last_run = -2, 0
    while True:
        block, origin = queue.peek(window)
        if not len(block):
            break
        size = len(block)
        symbol = block["key"] >> 1
        given = block["before"].astype(np.int64)
        target = np.where(given < 0, -1, top - given) if down else given
        hands = (target > symbol) | ((target == symbol) & (block["key"] & 1 == 0))
        # Where what it hands in would stand: behind its like, ahead of the seeds of that symbol
        stands = np.where(hands, _up_to(block["key"], 2 * target), size)
        within = np.minimum.accumulate(stands) > np.arange(size)
        count = size if within.all() else int(np.argmin(within))
        queue.take(origin[:count])
        window = min(CHUNK, window * 2) if count == size else max(256, count + count // 4)
        block, symbol, target, hands = block[:count], symbol[:count], target[:count], hands[:count]

        before_key = np.concatenate([[last_key], block["key"][:-1]])
        before_run = np.concatenate([[last_run], block["run"][:-1]])
        both = np.where(before_key == block["key"], block["common"], np.minimum(before_run, block["run"]))
        common = np.where(before_key >> 1 == symbol, np.minimum(both, cap), 0).astype(np.int32)
        block["common"] = common
        last_key, last_run = int(block["key"][-1]), int(block["run"][-1])
        yield block

        source = np.flatnonzero(hands)
        order = _order(target[source])
        source = source[order]
        goal = target[source]
        leads = np.ones(len(source), bool)
        leads[1:] = goal[1:] != goal[:-1]
        shared = np.empty(len(source), np.int32)
        follows = np.flatnonzero(~leads)
        shared[follows] = _range_least(common, source[follows - 1] + 1, source[follows])
        first = np.flatnonzero(leads)
        since = last_place[goal[first]]
        ahead = np.minimum.accumulate(common)[source[first]]
        known = np.where(since >= tail.begin, np.minimum(tail.since(since), ahead), 0)
        shared[first] = np.where(since < 0, -1, known)
        ends = np.append(first[1:], len(source))[: len(first)] - 1
        last_place[goal[first]] = done + source[ends]

        new = np.empty(len(source), dtype)
        place = block["pos"][source].astype(np.int64) - 1
        new["key"], new["pos"] = 2 * goal, place
        new["before"] = np.where(place > 0, text[np.maximum(place - 1, 0)].astype(np.int64), -1)
        new["common"] = np.minimum(shared + 1, cap)
        new["run"] = np.where(goal == symbol[source], np.minimum(block["run"][source], EQUAL - 1) + 1, 1)
        queue.push(new)
        tail.grow(done, common, np.flatnonzero(before_key >> 1 != symbol))
        done += count
    room.free(last_place)


def leftmost(text: np.ndarray, room: Room) -> tuple[np.ndarray, np.ndarray]:
    """The S* in order of position, as items without common prefix, and which suffixes are S; the end of the text is S*."""
    dtype, n = item_type(len(text)), len(text)
    parts, rises = [], room.array(n, np.bool_)
    next_symbol, next_less, next_run = -1, True, 0
    for end in range(n, 0, -CHUNK):
        begin = max(0, end - CHUNK)
        symbols = np.asarray(text[begin:end], np.int64)
        behind = np.append(symbols[1:], next_symbol)
        size = len(symbols)
        differs = np.where(symbols != behind, np.arange(size), size)
        until = np.minimum.accumulate(differs[::-1])[::-1]
        inside = until < size
        at = np.minimum(until, size - 1)
        less = np.where(inside, symbols[at] < behind[at], next_less)
        run = np.where(inside, until - np.arange(size) + 1, size - np.arange(size) + next_run)
        if end == n:
            less[-1], run[-1] = True, 1
        rises[begin:end] = less
        ahead = int(text[begin - 1]) if begin else -1
        # The first of a chunk is S* if the symbol ahead of it is greater
        previous = np.append(ahead, symbols[:-1])
        star = np.flatnonzero(less & (previous > symbols))
        items = np.zeros(len(star), dtype)
        items["key"], items["pos"], items["before"], items["run"] = 2 * symbols[star] + 1, begin + star, previous[star], run[star]
        parts.append(items)
        next_symbol, next_less, next_run = int(symbols[0]), bool(less[0]), int(run[0])
    return room.kept(reversed(parts), dtype), rises


def _chunks(array: np.ndarray) -> Iterator[np.ndarray]:
    for begin in range(0, len(array), CHUNK):
        yield np.array(array[begin : begin + CHUNK])


def _passes(text: np.ndarray, top: int, seeds: np.ndarray, cap: int, room: Room) -> Iterator[np.ndarray]:
    """Both passes: all suffixes but the end of the text, from the greatest down."""
    upward = scan(text, top, seeds, False, cap, room)
    large = room.kept((b[b["key"] & 1 == 0] for b in upward), seeds.dtype)
    yield from scan(text, top, Reversed(large, top), True, cap, room)
    room.free(large)


def _named(text: np.ndarray, top: int, stars: np.ndarray, rises: np.ndarray, room: Room) -> tuple[np.ndarray, int]:
    """A name for each substring from one S* to the next, in their order, by position; and how many names there are."""
    if len(stars) <= room.memory // 2 and top < 1 << 30:
        return _named_in_memory(text, top, stars, rises)
    queue = Queue(room, stars.dtype)
    for chunk in _chunks(stars):
        queue.push(chunk[_order(chunk["key"])])

    def seeds():
        last = -1
        for block in queue.drained():
            same = block["key"] == np.concatenate([[last], block["key"][:-1]])
            block["common"] = np.where(same, EQUAL, 0)
            last = int(block["key"][-1])
            yield block

    ordered = room.kept(seeds(), stars.dtype)
    names = room.array(len(stars), np.int32)
    count, least = 0, EQUAL
    for block in _passes(text, top, ordered, EQUAL, room):
        symbols = top - (block["key"] >> 1)
        found = np.flatnonzero((block["key"] & 1 == 0) & (block["before"] > symbols))
        if not len(found):
            least = min(least, int(block["common"].min()))
            continue
        shared = np.minimum.reduceat(block["common"][: found[-1] + 1], np.append(0, found[:-1] + 1))
        shared[0] = min(least, shared[0])
        number = count + np.cumsum(shared < EQUAL)
        names[np.searchsorted(stars["pos"], block["pos"][found])] = number
        count, rest = int(number[-1]), block["common"][found[-1] + 1 :]
        least = int(rest.min()) if len(rest) else EQUAL
    for begin in range(0, len(names), CHUNK):
        names[begin : begin + CHUNK] = count + 1 - names[begin : begin + CHUNK]
    names[-1] = 0
    room.free(ordered)
    return names, count


def _named_in_memory(text: np.ndarray, top: int, stars: np.ndarray, rises: np.ndarray) -> tuple[np.ndarray, int]:
    """As ``_named``, for S* that fit in memory: the substrings are sorted word by word.

    A word holds as many symbols as 63 bits take, each with its type: of equal symbols S is the greater.
    """
    begin = stars["pos"].astype(np.int64)
    end = np.append(begin[1:], begin[-1])
    bits = int(2 * top + 3).bit_length()
    each = 63 // bits
    rank = np.zeros(len(stars), np.int64)
    going, done = np.arange(len(stars)), 0
    while len(going):
        word = np.zeros(len(going), np.int64)
        for i in range(each):
            place = np.minimum(begin[going] + done + i, end[going])
            symbol = 2 * text[place].astype(np.int64) + rises[place] + 1
            word = word << bits | np.where(begin[going] + done + i <= end[going], symbol, 0)
        order = np.lexsort((word, rank[going])) if done else np.argsort(word)
        going, word = going[order], word[order]
        first, number = rank[going], np.arange(len(going))
        new_first = np.append(True, first[1:] != first[:-1])
        new = new_first | np.append(True, word[1:] != word[:-1])
        begins = np.maximum.accumulate(np.where(new, number, 0))
        rank[going] = first + begins - np.maximum.accumulate(np.where(new_first, number, 0))
        done += each
        alone = new & np.append(new[1:], True)
        going = going[~alone & (begin[going] + done <= end[going])]
    used = np.zeros(len(stars) + 1, bool)
    used[rank] = True
    names = (np.cumsum(used) - 1)[rank]
    return names.astype(np.int32), int(names.max())


def _in_order(names: np.ndarray, count: int, cap: int, room: Room) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of the text of names from the least up, and how many names each shares with the one before it."""
    if count + 1 == len(names):
        order = room.array(len(names), np.int64)
        order[np.asarray(names)] = np.arange(len(names))
        return order, room.array(len(names), np.int32)
    if len(names) <= room.memory:
        return _in_memory(np.asarray(names), cap)
    order, shared = room.array(len(names), np.int64), room.array(len(names), np.int32)
    at = len(names)
    for places, common in suffixes(names, count, cap, room):
        order[at - len(places) : at] = places[::-1]
        # Common with the one above; moved up by one place below
        shared[at - len(places) : at] = common[::-1]
        at -= len(places)
    for begin in range(len(names), 0, -CHUNK):
        low = max(1, begin - CHUNK)
        shared[low:begin] = np.array(shared[low - 1 : begin - 1])
    shared[:1] = 0
    return order, shared


def _in_memory(names: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``_in_order``, for names that fit in memory, where the recursion ends: by doubling what is compared."""
    n = len(names)
    counts = np.bincount(names)
    rank = (np.cumsum(counts) - counts)[names]
    going, step = np.flatnonzero(counts[names] > 1), 1
    while len(going):
        first, second = rank[going], rank[going + step]
        by_both = np.argsort(first * n + second)
        going, first, second = going[by_both], first[by_both], second[by_both]
        number = np.arange(len(going))
        new_first = np.append(True, first[1:] != first[:-1])
        new = new_first | np.append(True, second[1:] != second[:-1])
        begins = np.maximum.accumulate(np.where(new, number, 0))
        rank[going] = first + begins - np.maximum.accumulate(np.where(new_first, number, 0))
        going = going[~(new & np.append(new[1:], True))]
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    shared = np.zeros(n, np.int32)
    going = np.arange(1, n)
    while len(going):
        going = going[names[order[going] + shared[going]] == names[order[going - 1] + shared[going]]]
        shared[going] += 1
        going = going[shared[going] < cap]
    return order, shared


def _start(text: np.ndarray, stars: np.ndarray, order: np.ndarray, shared: np.ndarray, cap: int) -> Iterator[np.ndarray]:
    """The S* as seeds in order, with the prefix that each shares with the one before it."""
    last = 0
    for begin in range(0, len(order), CHUNK):
        index = np.asarray(order[begin : begin + CHUNK])
        previous = np.concatenate([[last], index[:-1]])
        last = int(index[-1])
        place = stars["pos"][index].astype(np.int64)
        other = stars["pos"][previous].astype(np.int64)
        names = np.asarray(shared[begin : begin + CHUNK], np.int64)
        length = np.minimum(stars["pos"][index + names].astype(np.int64) - place, cap)
        # Behind the names in common the symbols are compared
        going = np.flatnonzero(length < cap)
        if begin == 0:
            going, length[0] = going[going > 0], 0
        while len(going):
            same = text[place[going] + length[going]] == text[other[going] + length[going]]
            going = going[same]
            length[going] += 1
            going = going[length[going] < cap]
        seeds = np.array(stars[index])
        seeds["common"] = length
        yield seeds


def suffixes(text: np.ndarray, top: int, cap: int, room: Room) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all suffixes from the greatest down, in blocks, and what each shares with the one before it, up to ``cap``.

    ``text``: symbols from 0 to ``top``; the last is 0, and no other is.
    """
    if len(text) == 1:
        yield np.zeros(1, np.int64), np.zeros(1, np.int32)
        return
    stars, rises = leftmost(text, room)
    names, count = _named(text, top, stars, rises, room)
    room.free(rises)
    order, shared = _in_order(names, count, cap, room)
    room.free(names)
    seeds = room.kept(_start(text, stars, order, shared, cap), stars.dtype)
    room.free(order, shared, stars)
    for block in _passes(text, top, seeds, cap, room):
        yield block["pos"].astype(np.int64), block["common"]
    room.free(seeds)
    yield np.array([len(text) - 1]), np.zeros(1, np.int32)
