"""Counting phrases in a task: a shallow trie of word ids over burstable hash containers.

A phrase of up to three words is one number: three ids of 21 bits, 0 where the piece of text has ended. A container is a hash
table for a range of such numbers. The first one takes all; one that is too full bursts into two at a
word: by first word, and once it holds a single first word, by second word. What follows two given words stays in one container.

A counter whose containers hold too much spills whole subtrees as sorted runs, one per prefix partition: the words of a
run in byte order, and its phrases in order of their words.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import zstandard

from annalist.llm.words import U64, hash_words, mix, part_of, runs, split_by

BITS = 21
#: the word id that stands for the end of a piece
END = 0
MOST_WORDS = (1 << BITS) - 1
#: entries at which a container bursts, and all together spill; they set the memory of a task, not what is counted
BURST, SPILL = 65_536, 2_000_000
#: the separator as a word; words can't hold it
SEPARATOR = b"."
_PIECES = bytes.maketrans(b",;:!?\n\x0b\x0c\r", b"." * 9)
#: bytes of text and words that are looked at in one go
CHUNK, WINDOW = 1 << 20, 300_000


class Container:
    """Open-addressing hash table of numbers above 0 and their counts; whole arrays are added at once."""

    __slots__ = ("keys", "counts", "n")

    def __init__(self, slots: int = 1024) -> None:
        self.keys, self.counts, self.n = np.zeros(slots, np.int64), np.zeros(slots, np.int64), 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add distinct keys."""
        if 2 * (self.n + len(keys)) > len(self.keys):
            old, held = self.items()
            self.__init__(1 << (2 * (self.n + len(keys))).bit_length())
            self._put(old, held)
        self._put(keys, counts)

    def _put(self, keys: np.ndarray, counts: np.ndarray) -> None:
        last = len(self.keys) - 1
        slot = (mix(keys.view(U64)) & U64(last)).astype(np.int64)
        while len(keys):
            found = self.keys[slot]
            empty = found == 0
            self.keys[slot[empty]] = keys[empty]  # of several keys for a slot one gets it
            placed = self.keys[slot] == keys
            self.counts[slot[placed]] += counts[placed]
            self.n += int((placed & empty).sum())
            keys, counts, slot = keys[~placed], counts[~placed], (slot[~placed] + 1) & last

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys in order, and their counts."""
        used = np.flatnonzero(self.keys)
        used = used[np.argsort(self.keys[used])]
        return self.keys[used], self.counts[used]


class Trie:
    """Containers by ranges of phrases."""

    def __init__(self) -> None:
        self.starts: list[int] = [0]
        self.containers: dict[int, Container] = {0: Container()}

    def add(self, phrases: np.ndarray) -> int:
        """Count phrases; gives the number of new entries."""
        ordered = np.sort(phrases)
        first, counts = runs(ordered)
        keys = ordered[first]
        cuts = np.r_[0, np.searchsorted(keys, self.starts[1:]), len(keys)]
        new = 0
        for start, i, j in zip(list(self.starts), cuts[:-1], cuts[1:], strict=True):
            if i < j:
                box = self.containers[start]
                before = box.n
                box.add(keys[i:j], counts[i:j])
                new += box.n - before
                if box.n > BURST:
                    self._burst(start)
        return new

    def _burst(self, start: int) -> None:
        """Cut a full container at the word nearest to its middle, as long as it can be cut."""
        keys, counts = self.containers[start].items()
        for shift in (2 * BITS, BITS):  # by first word, then by second word
            words = keys >> shift
            if words[0] != words[-1]:
                middle = words[len(words) // 2]
                if middle == words[0]:
                    middle = words[np.searchsorted(words, middle, "right")]
                cut = int(np.searchsorted(words, middle))
                break
        else:
            return
        at = int(middle) << shift
        insort(self.starts, at)
        for begin, part in ((start, slice(0, cut)), (at, slice(cut, None))):
            box = self.containers[begin] = Container(1 << (2 * len(keys[part])).bit_length())
            box.add(keys[part], counts[part])
            if box.n > BURST:
                self._burst(begin)

    def find(self, phrase: int) -> Container:
        """The container that a phrase belongs to."""
        return self.containers[self.starts[bisect_right(self.starts, phrase) - 1]]

    def take(self, keep_above: float) -> tuple[np.ndarray, np.ndarray]:
        """Remove the subtrees whose entries were seen no more often than so on average; gives their phrases in order."""
        keys, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for start in self.starts:
            box = self.containers[start]
            if box.n and box.counts.sum() <= keep_above * box.n:
                k, c = box.items()
                keys.append(k)
                counts.append(c)
                self.containers[start] = Container()
        return np.concatenate(keys), np.concatenate(counts)


class _Ids(dict):
    """Word to id, in order of appearance."""

    def __init__(self) -> None:
        super().__init__({SEPARATOR: END})

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self)
        return i


def pieces_of(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text with A-Z lower-cased and a separator between pieces, some at a time; pieces are never cut."""
    text = text.translate(_PIECES).lower()
    at = 0
    while at < len(text):
        end = text.find(SEPARATOR, at + CHUNK)
        end = len(text) if end < 0 else end + 1
        yield text[at:end].replace(SEPARATOR, b" . ").split()
        at = end


class PhraseCounter:
    """The phrases of one task, a trie per group, with the words they are made of."""

    def __init__(self, parts: int, spill: int = SPILL) -> None:
        self.parts, self.spill = parts, spill
        self._start()

    def _start(self) -> None:
        self.ids, self.tries, self.entries = _Ids(), {}, 0

    def add(self, group: str, text: bytes) -> Iterator[tuple]:
        """Count a text; gives the runs that spill meanwhile."""
        for words in pieces_of(text):
            for at in range(0, len(words), WINDOW):
                window = words[at : at + WINDOW + 2]
                if len(self.ids) + len(window) > MOST_WORDS:
                    yield from self.finish()
                ids = np.fromiter(map(self.ids.__getitem__, window), np.int64, len(window))
                own = ids[:WINDOW]
                after = np.r_[ids, END, END]
                second, third = after[1 : len(own) + 1], after[2 : len(own) + 2]
                phrase = (own << 2 * BITS) | (second << BITS) | np.where(second == END, END, third)
                phrase = phrase[own != END]
                if len(phrase):
                    trie = self.tries.get(group) or self.tries.setdefault(group, Trie())
                    self.entries += trie.add(phrase)
                if self.entries > self.spill:
                    yield from self._spill(keep_above=4.0)
                    if self.entries > self.spill // 2:  # most of it is seen often
                        yield from self.finish()

    def finish(self) -> Iterator[tuple]:
        """Spill all that is left and forget the words."""
        yield from self._spill(keep_above=np.inf)
        self._start()

    def _spill(self, keep_above: float) -> Iterator[tuple]:
        words = list(self.ids)
        order = sorted(range(1, len(words)), key=words.__getitem__)
        rank = np.zeros(len(words), np.int64)
        rank[order] = np.arange(1, len(words))
        in_order = [b"", *map(words.__getitem__, order)]
        hashes = hash_words(in_order)
        for group, trie in self.tries.items():
            keys, counts = trie.take(keep_above)
            self.entries -= len(keys)
            if len(keys):
                yield from _runs(group, _ranked(keys, rank), counts, in_order, hashes, self.parts)


def _ranked(keys: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The three words of each phrase, as places in byte order."""
    return np.stack([rank[(keys >> shift) & MOST_WORDS] for shift in (2 * BITS, BITS, 0)])


def _runs(
    group: str, words: np.ndarray, counts: np.ndarray, in_order: list[bytes], hashes: np.ndarray, parts: int
) -> Iterator[tuple]:
    """Sorted runs ``(part, group, depth, entries, run)``: first words by themselves, and phrases by their first two words."""
    order = np.lexsort(words[::-1])
    words, counts = words[:, order], counts[order]
    seed = hash_words([group.encode()])[0]
    with np.errstate(over="ignore"):
        by_first = mix(hashes[words[0]] ^ seed)
        by_two = mix(by_first * U64(0x9E3779B97F4A7C15) + hashes[words[1]])
    first, _ = runs(words[0])
    totals = np.add.reduceat(counts, first)
    for part, at in split_by(part_of(by_first[first], parts)):
        yield part, group, 1, len(at), pack_run(words[:1, first[at]], totals[at], in_order)
    for part, at in split_by(part_of(by_two, parts)):
        yield part, group, 3, len(at), pack_run(words[:, at], counts[at], in_order)


def _bytes(numbers: np.ndarray) -> bytes:
    """Equal bytes of neighbours next to each other, so that they compress."""
    return numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view("<i8").ravel()


def pack_run(words: np.ndarray, counts: np.ndarray, in_order: list[bytes]) -> bytes:
    """A run: its own words, then the phrases as differences, then the counts."""
    used, own = np.unique(np.r_[END, words.ravel()], return_inverse=True)
    own = own[1:].reshape(words.shape)
    names = b"\n".join(map(in_order.__getitem__, used[1:].tolist()))
    phrase = own[0]
    for next_word in own[1:]:
        phrase = (phrase << BITS) | next_word
    body = _bytes(np.diff(phrase, prepend=0)) + _bytes(counts)
    head = np.array([len(names), len(counts)], "<i8").tobytes()
    return zstandard.compress(head + names + body, 1)


def unpack_run(run: bytes, depth: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words of a run, its phrases as places among these from 1 on (0: none), and their counts."""
    data = zstandard.decompress(run)
    size, n = np.frombuffer(data, "<i8", 2)
    names = data[16 : 16 + size].split(b"\n")
    body = data[16 + size :]
    phrase = np.cumsum(_numbers(body[: 8 * n]))
    shifts = range((depth - 1) * BITS, -1, -BITS)
    return names, np.stack([(phrase >> s) & MOST_WORDS for s in shifts]), _numbers(body[8 * n :])


def merge_runs(packed: list[bytes], depth: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Merge sorted runs into one: all words in byte order after an empty one, the phrases in order, their counts."""
    opened = [unpack_run(run, depth) for run in packed]
    names = sorted(set().union(*(names for names, _, _ in opened)))
    place = {name: i for i, name in enumerate(names, 1)}
    columns = []
    for own, words, _ in opened:
        columns.append(np.r_[END, np.fromiter(map(place.__getitem__, own), np.int64, len(own))][words])
    words = np.concatenate(columns, axis=1)
    counts = np.concatenate([c for _, _, c in opened])
    prefix = words[0] if depth == 1 else words[0] * (len(names) + 1) + words[1]
    order = np.argsort(prefix, kind="stable") if depth == 1 else np.lexsort((words[2], prefix))
    words, prefix, counts = words[:, order], prefix[order], counts[order]
    fresh = np.r_[True, (prefix[1:] != prefix[:-1]) | (words[-1, 1:] != words[-1, :-1])]
    first = np.flatnonzero(fresh)
    return [b"", *names], words[:, first], np.add.reduceat(counts, first)
