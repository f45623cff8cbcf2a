"""Periodic runs of words by longest common extensions from a difference cover.

A run repeats a stretch of words with its smallest period and cannot be made longer either way. For each period the text
has a grid of places, so many words apart; a run of `times` periods holds times - 1 neighbouring pairs of grid places with
equal words. From each such place the words that go on repeating are counted forwards and backwards, which gives the run.
Over all periods the grids have n/1 + n/2 + ... places.

Counting is a longest common extension of two places. Only the suffixes whose place, modulo PERIOD, is in a difference
cover are sorted. Within PERIOD words any two places reach, by the same step, two that are both in the cover; the few
words up to there are compared, the rest is a minimum over the neighbours' common prefixes, looked up in a sparse table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from pagetrail.llm.pieces import slices, split_words

#: A perfect difference cover, whose members differ by each number modulo its period.
COVER, PERIOD = (1, 5, 11, 24, 25, 27), 31
#: Grid places that are followed up at a time.
PLACES = 1 << 20
#: A run has at least LEAST words and TIMES periods.
LEAST, TIMES = 6, 4


def _shifts() -> np.ndarray:
    """[difference, place]: the smallest step that takes a place, and the one that far behind it, into the cover."""
    inside = np.isin(np.arange(PERIOD), COVER)
    shifts = np.zeros((PERIOD, PERIOD), dtype=np.int64)
    for difference in range(PERIOD):
        both = inside & np.roll(inside, -difference)
        for place in range(PERIOD):
            shifts[difference, place] = int(np.argmax(np.roll(both, -place)))
    return shifts


SHIFTS = _shifts()


def _ranked(*keys: np.ndarray) -> np.ndarray:
    """The rank of each row by its keys, first key first; equal rows have equal ranks."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    for key in keys:
        placed = key[order]
        new[1:] |= placed[1:] != placed[:-1]
    ranks = np.empty(len(order), dtype=np.int32)
    ranks[order] = np.cumsum(new)
    return ranks


class Extensions:
    """Longest common extensions in a sequence of word numbers from 1 on that ends in a number found nowhere else."""

    def __init__(self, words: np.ndarray) -> None:
        size = len(words)
        self.words = np.concatenate([words, np.zeros(2 * PERIOD, dtype=np.int64)])
        blocks = [np.arange(first, size, PERIOD) for first in COVER]
        self.places = np.concatenate(blocks)
        self.block = np.zeros(PERIOD, dtype=np.int64)
        self.block[list(COVER)] = np.cumsum([0, *map(len, blocks)])[:-1]
        self._sort(int(words.max(initial=1)))
        self._table()

    def _sort(self, largest: int) -> None:
        """Ranks of the sampled suffixes by their first PERIOD words, then by twice as many and so on."""
        bits = max(1, largest.bit_length())
        each = max(1, 63 // bits)
        keys = []
        for start in range(0, PERIOD, each):
            key = np.zeros(len(self.places), dtype=np.int64)
            for step in range(start, min(start + each, PERIOD)):
                key = key << bits | self.words[self.places + step]
            keys.append(key)
        self.levels = [_ranked(*keys)]
        count, reach = len(self.places), 1
        # The last sample of a block holds the last word, so that no two equal stretches go beyond a block.
        while count and self.levels[-1].max() < count - 1:
            rank = self.levels[-1]
            behind = np.zeros(count, dtype=np.int64)
            behind[: count - reach] = rank[reach:] + 1
            self.levels.append(_ranked(rank * np.int64(count + 1) + behind))
            reach *= 2
        self.rank = self.levels[-1]

    def _table(self) -> None:
        """Common prefixes of neighbours in sorted order, and their minima over each power of two."""
        order = np.argsort(self.rank)
        a, b = order[:-1], order[1:]
        same = np.zeros(len(a), dtype=np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            same += np.where(self.levels[level][a + same] == self.levels[level][b + same], 1 << level, 0)
        self.levels = []
        same *= PERIOD
        same += self._compared(self.places[a] + same, self.places[b] + same, np.full(len(a), PERIOD))
        self.table = [same.astype(np.int32)]
        reach = 1
        while 2 * reach <= len(same):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-reach], last[reach:]))
            reach *= 2

    def _compared(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words agree from the places i and j on, counted up to `most`."""
        agree = np.zeros(len(i), dtype=np.int64)
        left = np.arange(len(i))
        step = 0
        while len(left):
            left = left[most[left] > step]
            left = left[self.words[i[left] + step] == self.words[j[left] + step]]
            step += 1
            agree[left] = step
        return agree

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words agree from the places i and j on, which differ."""
        shift = SHIFTS[(j - i) % PERIOD, i % PERIOD]
        agree = self._compared(i, j, shift)
        far = np.flatnonzero(agree == shift)
        a, b = (x[far] + shift[far] for x in (i, j))
        a, b = (self.rank[self.block[x % PERIOD] + x // PERIOD] for x in (a, b))
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(float))[1] - 1  # the greatest power of two within
        for number in np.unique(level):
            here = level == number
            row = self.table[number]
            agree[far[here]] += np.minimum(row[low[here]], row[high[here] - (1 << number)])
        return agree


def _joined(codes: np.ndarray, offsets: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen texts one behind the other, with a number of its own before and behind each, and where each starts."""
    sizes = offsets[chosen + 1] - offsets[chosen]
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1] + 1
    total = int(sizes.sum()) + len(chosen) + 1
    inside = np.ones(total, dtype=bool)
    inside[0] = False
    inside[starts + sizes] = False
    ahead = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    line = np.empty(total, dtype=np.int64)
    line[inside] = codes[np.arange(int(sizes.sum())) + np.repeat(offsets[chosen] - ahead, sizes)] + 1
    line[~inside] = int(codes.max(initial=0)) + 2 + np.arange(len(chosen) + 1)
    return line, starts


def _grid(line: np.ndarray, starts: np.ndarray, sizes: np.ndarray, least: int, times: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(texts, places, periods), some at a time, of the grid places from which times - 1 neighbours hold equal words.

    The sizes of the texts are descending.
    """
    held: list[tuple[np.ndarray, ...]] = []
    waiting = 0
    ends = starts + sizes
    for period in range(1, int(sizes[0]) // times + 1):
        texts = int(np.searchsorted(-sizes, -max(least, times * period), side="right"))
        if not texts:
            break
        words = line[0 : ends[texts - 1] : period]
        equal = words[1:] == words[:-1]
        found = equal[: len(equal) - (times - 2)].copy()
        for step in range(1, times - 1):
            found &= equal[step : len(equal) - (times - 2) + step]
        place = np.flatnonzero(found) * period
        if len(place):
            text = np.searchsorted(starts, place, side="right") - 1
            one = place + (times - 1) * period < ends[text]
            held.append((text[one], place[one], np.full(int(one.sum()), period)))
            waiting += len(place)
        if waiting > PLACES:
            yield tuple(map(np.concatenate, zip(*held, strict=True)))
            held, waiting = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def _smallest(text: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each stretch once, with the smallest of its periods, which divides the others; by text, start, period."""
    order = np.lexsort((period, length, start, text))
    text, start, length, period = text[order], start[order], length[order], period[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    text, start, length, period = text[new], start[new], length[new], period[new]
    order = np.lexsort((period, start, text))
    return text[order], start[order], length[order], period[order]


def find(codes: np.ndarray, offsets: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of every run of the texts codes[offsets[t]:offsets[t + 1]], by text, start, period.

    A text without `times` equal words at equal distances has none, so extensions are prepared for the others only.
    """
    runs = (np.zeros(0, dtype=np.int64),) * 4
    sizes = offsets[1:] - offsets[:-1]
    chosen = np.argsort(-sizes, kind="stable")
    chosen = chosen[sizes[chosen] >= max(least, times)]
    if not len(chosen):
        return runs
    line, starts = _joined(codes, offsets, chosen)
    kept = [np.unique(text) for text, _, _ in _grid(line, starts, sizes[chosen], least, times)]
    if not sum(map(len, kept)):
        return runs
    chosen = chosen[np.unique(np.concatenate(kept))]
    line, starts = _joined(codes, offsets, chosen)
    forwards, backwards = Extensions(line), Extensions(line[::-1].copy())
    for text, place, period in _grid(line, starts, sizes[chosen], least, times):
        ahead = forwards.common(place, place + period)
        behind = backwards.common(len(line) - place, len(line) - place - period)
        length = behind + ahead + period
        long = length >= np.maximum(least, times * period)
        some = chosen[text], place - behind - starts[text], length, period
        runs = _smallest(*(np.concatenate([a, b[long]]) for a, b in zip(runs, some, strict=True)))
    return runs


def _strongest(text: list[int], start: list[int], length: list[int], period: list[int], texts: int) -> list[int | None]:
    """The run of greatest exact length / period of each text, ties to the smallest start, then period."""
    best: list[int | None] = [None] * texts
    for run, one in enumerate(text):
        held = best[one]
        if held is None or length[run] * period[held] > length[held] * period[run]:
            best[one] = run
    return best


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _found(part: pa.RecordBatch, least: int, times: int) -> pa.RecordBatch:
    words, offsets = split_words(part.column(1))
    coded = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text, start, length, period = find(coded, offsets, least, times)
    count = part.num_rows
    runs = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], fields=list(RUN))
    cuts = np.searchsorted(text, np.arange(count + 1))
    best = _strongest(text.tolist(), start.tolist(), length.tolist(), period.tolist(), count)
    # words behind the first period of a run go
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, offsets[text] + start + period, 1)
    np.add.at(change, offsets[text] + start + length, -1)
    stays = np.cumsum(change[:-1]) == 0
    ends = np.concatenate([[0], np.cumsum(stays)])[offsets]
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words.filter(pa.array(stays)))
    arrays = [
        part.column(0),
        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), runs),
        runs.take(pa.array(best, pa.int64())),
        pc.binary_join(lists, " "),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "runs", "strongest", "collapsed"])


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(doc_id, runs, strongest, collapsed) of every row of `docs` (doc_id, text).

    `runs` are all stretches of at least `least` words and `times` (2 or more) smallest periods that no neighbouring word
    makes longer, as (start, length, period) by start, then period, in words from 0 on; `strongest` is the one with the
    greatest length / period, ties to the smallest start, then period, or null; `collapsed` is the text without the words
    behind the first period of a run, joined by single spaces.

    Texts without words and null ones have no runs and an empty collapsed text. Repeated rows and null doc_ids, of any
    type, come out as they went in; other columns of `docs` play no part. No rows give no rows. Texts are worked on
    whole, a few megabytes of them at a time; a longer one takes memory in proportion to its length.
    """
    if times < 2 or least < 1:
        raise ValueError("a run has at least two periods and one word")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                yield _found(part, least, times)

    one = "struct<start: bigint, length: bigint, period: bigint>"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, runs array<{one}>, strongest {one}, collapsed string")
