"""Texts cut into chunks in Arrow, so that each distinct chunk of a slice is worked out once, and bounded stores.

A cut before a space that a character other than white space follows is one that no piece of the pattern reaches
across: white space before such a space is a piece of its own, and the space belongs to what follows. A slice of texts is
split at every space; texts with any other kind of space, which are few, are worked out whole.
"""

from __future__ import annotations

import gc
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at a time, and that a worker holds of what it has worked out.
SLICE_BYTES, HELD_BYTES = 4 << 20, 80 << 20
#: Bytes of chunks and their ids that are held as Arrow arrays.
LISTS_BYTES = 24 << 20
#: Bytes that an entry of a dictionary takes beside its key and value.
ENTRY = 104


#: The operator whose stores this worker holds, and what drops them.
_holder: list = ["", lambda: None]


def claim(name: str, release: Callable) -> None:
    """Drop the stores of the operator that used this worker before; Spark reuses workers, which would add up."""
    if _holder[0] != name:
        _holder[1]()
        _holder[:] = name, release
        gc.collect()
        pa.default_memory_pool().release_unused()


class Held(dict):
    """Values by key, worked out by `function` when first asked for.

    It keeps two generations of at most half of `limit` bytes each, so what is in use stays when the rest is dropped.
    """

    def __init__(self, function: Callable, limit: int = HELD_BYTES) -> None:
        super().__init__()
        self.function, self.half, self.room, self.old = function, limit // 2, limit // 2, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.function(key)
        self._hold(key, value)
        return value

    def many(self, keys: list, function: Callable) -> list:
        """The values of all keys; `function` works out those of a list of new ones together."""
        found = list(map(self.get, keys))
        asked = {key for key, value in zip(keys, found, strict=True) if value is None}
        if asked:
            known = {key: self.old[key] for key in asked if key in self.old}
            new = [key for key in asked if key not in known]
            known.update(zip(new, function(new) if new else [], strict=True))
            found = [known[key] if value is None else value for key, value in zip(keys, found, strict=True)]
            for key, value in known.items():
                self._hold(key, value)
        return found

    def _hold(self, key, value) -> None:
        self.room -= sys.getsizeof(key) + sys.getsizeof(value) + ENTRY
        if self.room < 0:
            self.old, self.room = self.copy(), self.half
            self.clear()
        self[key] = value


class Lists:
    """Ids of distinct chunks, kept as Arrow arrays, which take a fraction of what a dictionary takes and are searched at once.

    `function` works out those of an array of new chunks: all their ids, and how many each has. Beyond `limit` bytes only
    the chunks of the last slice stay.
    """

    def __init__(self, function: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], limit: int = LISTS_BYTES) -> None:
        self.function, self.limit = function, limit
        self.names, self.ids, self.ends = pa.array([], pa.string()), np.empty(0, "<i4"), np.zeros(1, "<i8")

    def of(self, names: pa.Array) -> pa.ListArray:
        """The ids of each of some distinct chunks."""
        at = pc.index_in(names, value_set=self.names).fill_null(-1).to_numpy().astype(np.int64)
        new = at < 0
        if new.any():
            fresh = names.filter(pa.array(new))
            ids, sizes = self.function(fresh)
            at[new] = len(self.names) + np.arange(len(fresh))
            self.names = pa.concat_arrays([self.names, fresh])
            self.ids = np.concatenate([self.ids, ids])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        found = pa.ListArray.from_arrays(pa.array(self.ends, pa.int32()), pa.array(self.ids)).take(pa.array(at))
        if self.names.nbytes + self.ids.nbytes + self.ends.nbytes > self.limit:
            self.names, self.ids = names, found.values.to_numpy()
            self.ends = found.offsets.to_numpy().astype("<i8")
        return found


def starts_with_space(names: pa.Array) -> pa.Array:
    """Whether a chunk is empty or starts with white space: no cut may be made before it."""
    return pc.or_(pc.equal(names, ""), pc.utf8_is_space(pc.utf8_slice_codeunits(names, 0, 1)))


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts whose texts have about SLICE_BYTES, one row at least; what a part took goes back to the system."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if a < b:
            yield batch.slice(a, b - a)
            pa.default_memory_pool().release_unused()


def _cut(texts: pa.Array, whole: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """(codes, offsets, names, odd): text i has the chunks names[codes[offsets[i]:offsets[i + 1]]], unless it is odd."""
    lists = pc.split_pattern(texts, " ")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    chunks = lists.flatten().dictionary_encode()
    codes = chunks.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    odd = np.zeros(len(texts), dtype=bool) if whole is None else whole.copy()
    space = starts_with_space(chunks.dictionary).to_numpy(zero_copy_only=False)
    found = np.flatnonzero(space[codes])
    rows = np.searchsorted(offsets, found, side="right") - 1
    odd[rows[found != offsets[rows]]] = True
    return codes, offsets, chunks.dictionary, odd


def by_chunk(texts: pa.Array, alone: Callable, behind: Callable, whole: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, list]:
    """(codes, offsets, values): text i has the values of codes[offsets[i]:offsets[i + 1]], one at least.

    `alone` works out a text as it stands, `behind` a chunk with a space before it. Nulls are empty texts. Texts that
    `whole` marks are not cut; their value stands first, the others are those of an empty text.
    """
    texts = pc.fill_null(texts, "")
    codes, offsets, names, odd = _cut(texts, whole)
    names = names.to_pylist()
    values = list(map(behind, names))
    _put_firsts(texts, codes, offsets, odd, names.__getitem__, alone, values)
    return codes, offsets, values


def _put_firsts(
    texts: pa.Array, codes: np.ndarray, offsets: np.ndarray, odd: np.ndarray, name_of: Callable, alone: Callable, values: list, ahead: int = 0
) -> None:
    """Append to `values`, which `ahead` others precede, what starts each text: its first chunk as it stands, or all of an odd one."""
    firsts: dict[str, int] = {}
    for row, (start, code) in enumerate(zip(offsets[:-1].tolist(), codes[offsets[:-1]].tolist(), strict=True)):
        if odd[row]:
            codes[start : offsets[row + 1]] = _number("", firsts, alone, values, ahead)
            name = texts[row].as_py()
        else:
            name = name_of(code)
        codes[start] = _number(name, firsts, alone, values, ahead)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, split at space and the control characters 9 to 13, and where those of each text start."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words = lists.flatten()
    real = pc.not_equal(pc.binary_length(words), 0)
    ends = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    offsets = lists.offsets.to_numpy()
    return words.filter(real), ends[offsets - offsets[0]].astype(np.int64)


def id_lists(texts: pa.Array, alone: Callable, behind: Lists, whole: np.ndarray | None = None) -> pa.ListArray:
    """The ids of each text, where `alone` gives packed 32-bit ids and `behind` holds those of chunks with a space before
    them. Texts that `whole` marks give no chunks."""
    texts = pc.fill_null(texts, "")
    codes, offsets, names, odd = _cut(texts if whole is None else pc.if_else(pa.array(whole), "", texts), whole)
    lists = behind.of(names)
    values: list[bytes] = []
    _put_firsts(texts, codes, offsets, odd, lambda code: names[code].as_py(), alone, values, len(names))
    sizes = np.concatenate([np.diff(lists.offsets.to_numpy()), np.fromiter(map(len, values), dtype=np.int64, count=len(values)) // 4])
    ids = pa.array(np.concatenate([lists.values.to_numpy(), np.frombuffer(b"".join(values), dtype="<i4")]))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    chunks = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids).take(pa.array(codes))
    ends = np.concatenate([[0], np.cumsum(sizes[codes])])[offsets]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), chunks.flatten())


def _number(name: str, firsts: dict[str, int], alone: Callable, values: list, ahead: int) -> int:
    number = firsts.get(name)
    if number is None:
        number = firsts[name] = ahead + len(values)
        values.append(alone(name))
    return number
