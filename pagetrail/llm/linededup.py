"""Near-duplicate lines of a corpus by a segment-partition edit join.

A line is cut into `most` + 1 segments. Of two lines at most `most` edits apart, one has a segment that occurs whole in
the other, at a place that the edits allow. So each distinct line enters an index under (its length, segment number,
segment), and probes, for its own and each smaller length in reach, with the substrings that can still match. Keys are
64-bit rolling hashes of the substrings, computed for whole batches at a time. Only lines that share a key with another
line are fetched again and compared, by a bit-parallel edit distance in a band of 2 * `most` + 1 diagonals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetrail.llm.common import keep, tasks
from pagetrail.llm.components import connected_components

#: Lines of fewer characters are neither dropped nor compared.
MIN_CHARS = 20
#: Edits between two lines that count as the same.
MOST_EDITS = 2
#: Lines of one key that are compared in one task; more are compared block by block.
GROUP_ROWS = 1024
#: Code points handled at a time.
SLAB = 1 << 22
#: Characters from which two lines are compared run by run, not bit by bit: bit vectors as long as the line take quadratic time.
LONG = 1 << 14
#: Odd, so that its powers can be inverted modulo 2^64.
BASE = 0x9E3779B97F4A7C15


def segments(length: int, most: int) -> list[tuple[int, int]]:
    """(start, size) of each of the `most` + 1 segments of a line; the last ones are longer by one if need be."""
    parts = most + 1
    starts = [i * (length // parts) + max(0, i - (parts - length % parts)) for i in range(parts)]
    return list(zip(starts, np.diff([*starts, length]).tolist(), strict=True))


def probes(length: int, indexed: int, number: int, most: int) -> range:
    """Places where a line of `length` can hold segment `number` (from 0) of a line of `indexed` characters.

    To the left of the first whole segment there are `number` edits at least, to its right at most the others; the
    shift is bounded by either side.
    """
    start, size = segments(indexed, most)[number]
    longer = length - indexed
    low = max(0, start - number, start + longer - (most - number))
    high = min(length - size, start + number, start + longer + (most - number))
    return range(low, high + 1)


class _Rolling:
    """Hashes of substrings of a batch of code points."""

    def __init__(self) -> None:
        with np.errstate(over="ignore"):
            self.power = np.ones(SLAB + 1, dtype=np.uint64)
            np.cumprod(np.full(SLAB, BASE, dtype=np.uint64), out=self.power[1:])
            self.inverse = np.ones(SLAB + 1, dtype=np.uint64)
            np.cumprod(np.full(SLAB, pow(BASE, -1, 1 << 64), dtype=np.uint64), out=self.inverse[1:])

    def sums(self, codes: np.ndarray) -> np.ndarray:
        mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        out = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(mixed * self.power[: len(codes)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, size: np.ndarray, length: np.ndarray, number: int) -> np.ndarray:
        """The key of each substring with the length and segment number it belongs to."""
        return self.keys((sums[start + size] - sums[start]) * self.inverse[start], length, number)

    def of_line(self, line: str, parts: list[tuple[int, int, int, int]]) -> np.ndarray:
        """The key of each (start, size, length, segment number) of one line, which is summed up slab by slab."""
        places = np.unique([p for start, size, *_ in parts for p in (start, start + size)])
        sums, total = np.zeros(len(places), dtype=np.uint64), np.zeros(1, dtype=np.uint64)
        for slab in range(0, len(line), SLAB):
            here = self.sums(np.frombuffer(line[slab : slab + SLAB].encode("utf-32-le"), dtype="<u4"))
            here = here * np.uint64(pow(BASE, slab, 1 << 64)) + total
            inside = (places >= slab) & (places < slab + len(here))
            sums[inside] = here[places[inside] - slab]
            total = here[-1:]
        start, size, length, number = np.array(parts).T
        inverse = np.array([pow(BASE, -p, 1 << 64) for p in start.tolist()], dtype=np.uint64)
        sum_ = sums[np.searchsorted(places, start + size)] - sums[np.searchsorted(places, start)]
        return self.keys(sum_ * inverse, length, number)

    def keys(self, key: np.ndarray, length: np.ndarray, number: int | np.ndarray) -> np.ndarray:
        number = np.asarray(number, dtype=np.uint64)
        key ^= (length.astype(np.uint64) * np.uint64(64) + number) * np.uint64(0x94D049BB133111EB)
        key = (key ^ (key >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        return key ^ (key >> np.uint64(32))


def _segment_tables(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """starts and sizes of the segments, one row per line and one column per segment."""
    parts = most + 1
    number = np.arange(parts)
    starts = number * (sizes[:, None] // parts) + np.maximum(0, number - (parts - sizes[:, None] % parts))
    return starts, np.diff(np.concatenate([starts, sizes[:, None]], axis=1), axis=1)


def _keys(batches: Iterator[pa.RecordBatch], most: int, min_chars: int) -> Iterator[pa.RecordBatch]:
    """(key, line, indexed) rows of the distinct lines of each batch."""
    rolling = _Rolling()

    def rows(lines: list[str]) -> Iterator[pa.RecordBatch]:
        ids = np.array([xxhash.xxh64_intdigest(x.encode(), 42) for x in lines], dtype=np.uint64).view(np.int64)
        codes = np.frombuffer("".join(lines).encode("utf-32-le"), dtype="<u4")
        sizes = np.array([len(x) for x in lines])
        first = np.cumsum(sizes) - sizes
        sums = rolling.sums(codes)
        keys, owners, indexed = [], [], []

        def add(key: np.ndarray, owner: np.ndarray, is_index: bool) -> None:
            keys.append(key.view(np.int64))
            owners.append(owner)
            indexed.append(np.full(len(key), is_index))

        starts, widths = _segment_tables(sizes, most)
        for number in range(most + 1):
            add(rolling.of(sums, first + starts[:, number], widths[:, number], sizes, number), ids, True)
        for shorter in range(most + 1):
            length = sizes - shorter
            starts, widths = _segment_tables(length, most)
            for number in range(most + 1):
                start, width = starts[:, number], widths[:, number]
                low = np.maximum.reduce([np.zeros_like(start), start - number, start + shorter - (most - number)])
                high = np.minimum.reduce([sizes - width, start + number, start + shorter + (most - number)])
                for step in range(2 * most + 1):
                    place = low + step
                    fits = np.flatnonzero((place <= high) & (length >= min_chars))
                    if len(fits):
                        key = rolling.of(sums, first[fits] + place[fits], width[fits], length[fits], number)
                        add(key, ids[fits], False)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x)) for x in (keys, owners, indexed)], names=["key", "line", "indexed"]
        )

    def row(line: str) -> pa.RecordBatch:
        """The same of one line of more than SLAB characters."""
        size = len(line)
        parts = [(start, width, size, number) for number, (start, width) in enumerate(segments(size, most))]
        for length in range(max(min_chars, size - most), size + 1):
            for number, (_, width) in enumerate(segments(length, most)):
                parts += [(place, width, length, number) for place in probes(size, length, number, most)]
        key = rolling.of_line(line, parts).view(np.int64)
        owner = np.full(len(parts), xxhash.xxh64_intdigest(line.encode(), 42), dtype=np.uint64).view(np.int64)
        arrays = [pa.array(key), pa.array(owner), pa.array(np.arange(len(parts)) <= most)]
        return pa.RecordBatch.from_arrays(arrays, names=["key", "line", "indexed"])

    for batch in batches:
        held: dict[str, None] = {}
        chars = 0
        for text in batch.column(0):
            for line in (text.as_py() or "").split("\n"):
                if len(line) < min_chars or line in held:
                    continue
                if len(line) > SLAB:
                    yield row(line)
                    continue
                if chars + len(line) > SLAB:
                    yield from rows(list(held))
                    held, chars = {}, 0
                held[line] = None
                chars += len(line)
        if held:
            yield from rows(list(held))


def within(a: str, b: str, most: int) -> bool:
    """Whether two texts are at most `most` edits apart (insertions, deletions, substitutions).

    Equal ends are cut off; the rest is compared by bit vectors that hold the vertical differences of the cells in a
    band around the diagonal, one step per character, until the band leaves no path within the limit.
    """
    if abs(len(a) - len(b)) > most:
        return False
    low, high = 0, min(len(a), len(b))
    while low < high:  # the longest common start by halving
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    a, b = a[low:], b[low:]
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[len(a) - middle : len(a) - low] == b[len(b) - middle : len(b) - low]:
            low = middle
        else:
            high = middle - 1
    a, b = a[: len(a) - low], b[: len(b) - low]
    if not a or not b:
        return len(a) + len(b) <= most
    return _by_runs(a, b, most) if len(a) > LONG else _banded(a, b, most)


def _run(a: str, b: str, i: int, j: int) -> int:
    """How many characters of a from place i on equal those of b from place j on."""
    low, high = 0, min(len(a) - i, len(b) - j)
    while low < high:
        middle = (low + high + 1) // 2
        if a[i + low : i + middle] == b[j + low : j + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _by_runs(a: str, b: str, most: int) -> bool:
    # How far into `a` each diagonal (place in a - place in b) gets with 0, 1, ... edits.
    reach: dict[int, int] = {}
    for edits in range(most + 1):
        new = {}
        for d in range(-edits, edits + 1):
            i = max(reach.get(d, -2) + 1, reach.get(d - 1, -2) + 1, reach.get(d + 1, -2)) if edits else 0
            i = min(i, len(a), len(b) + d)
            if i >= max(0, d):
                new[d] = i + _run(a, b, i, i - d)
        reach = new
        if reach.get(len(a) - len(b)) == len(a):
            return True
    return False


def _banded(a: str, b: str, most: int) -> bool:
    # At column j the band holds rows j - most to j + most, bit i standing for row j - most + i, so it moves one row
    # down with each character of b. `up` and `down` mark cells one more or less than the cell above them. Rows up to 0
    # match everything, which makes row 0 count 0, 1, 2, ... The score follows the diagonal that ends in the last cell.
    width = 2 * most + 1
    full, padding = (1 << width) - 1, (1 << most + 1) - 1
    where: dict[str, int] = {}
    for row, c in enumerate(a, 1):
        where[c] = where.get(c, padding) | 1 << row + most
    up, down = full ^ padding, padding
    end, score = len(a) - len(b) + most, abs(len(a) - len(b))
    for j, c in enumerate(b, 1):
        up, down = up >> 1 | 1 << width - 1, down >> 1
        equal = where.get(c, padding) >> j & full
        level = ((equal & up) + up ^ up | equal | down) & full
        right_up = (down | full & ~(level | up)) << 1 | 1
        right_down = (level & up) << 1
        up = (right_down | ~(level | right_up)) & full
        down = right_up & level & full
        score += not level >> end & 1
        if score > most:
            return False
    return True


def group_edges(texts: list[str], indexed: np.ndarray, probing: np.ndarray, most: int) -> list[tuple[bytes, bytes]]:
    """Edges (digest, digest) that connect the texts of one key as its index-probe pairs within the limit do."""
    root = list(range(len(texts)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    sizes = np.array([len(t) for t in texts])
    order = np.argsort(sizes, kind="stable")
    ranked = sizes[order]
    for place, i in enumerate(order):
        end = np.searchsorted(ranked, sizes[i] + most, side="right")
        for j in order[place + 1 : end]:
            if (indexed[i] and probing[j]) or (indexed[j] and probing[i]):
                a, b = top(i), top(j)
                if a != b and within(texts[i], texts[j], most):
                    root[max(a, b)] = min(a, b)
    digest = [hashlib.md5(t.encode()).digest() for t in texts]
    return [(digest[i], digest[top(i)]) for i in range(len(texts)) if top(i) != i]


def _edges(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Edges of the groups (key, part, other), whose rows come one after the other."""
    group, texts, indexed, probing = None, [], [], []

    def done() -> Iterator[pa.RecordBatch]:
        found = group_edges(texts, np.array(indexed), np.array(probing), most)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*found, strict=True)], names=["a", "b"])

    for batch in batches:
        for *at, text, in_index, probes_it in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if at != group:
                if len(texts) > 1:
                    yield from done()
                group, texts, indexed, probing = at, [], [], []
            texts.append(text)
            indexed.append(in_index)
            probing.append(probes_it)
    if len(texts) > 1:
        yield from done()


def _lines(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """One row per line of each document, with its place."""
    return docs.select(*columns, F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("place", "line"))


def line_edges(docs: DataFrame, most: int = MOST_EDITS, min_chars: int = MIN_CHARS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Edges (a, b) between digests of different lines, connecting just those that edits within the limit connect."""
    schema = "key bigint, line bigint, indexed boolean"
    keys = docs.select("text").mapInArrow(lambda batches: _keys(batches, most, min_chars), schema)
    in_key = Window.partitionBy("key")
    shared = (
        keys.withColumn("low", F.min("line").over(in_key))
        .withColumn("high", F.max("line").over(in_key))
        .withColumn("any_indexed", F.max("indexed").over(in_key))
        .where("low < high and any_indexed")
        .groupBy("key", "line")
        .agg(F.max("indexed").alias("indexed"), F.max(~F.col("indexed")).alias("probing"))
    )
    shared = keep(shared)
    wanted = shared.select("line").distinct()
    texts = _lines(docs).where(F.length("line") >= min_chars).select(F.xxhash64("line").alias("mark"), "line")
    texts = texts.join(wanted.withColumnRenamed("line", "mark"), "mark", "left_semi").distinct()
    sizes = shared.groupBy("key").agg(F.ceil(F.count("*") / group_rows).cast("int").alias("parts"))
    rows = shared.withColumnRenamed("line", "mark").join(texts, "mark").join(sizes, "key")
    # A key with more lines than one task compares is cut into parts, and each pair of parts is a group.
    part = F.pmod(F.xxhash64("line", F.lit(1)), F.col("parts")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda other: F.struct(F.least(F.col("part"), other).alias("part"), F.greatest(F.col("part"), other).alias("other")),
    )
    grouped = rows.withColumn("part", part).select("key", F.explode(pairs).alias("pair"), "line", "indexed", "probing")
    grouped = grouped.select("key", "pair.part", "pair.other", "line", "indexed", "probing")
    at = ["key", "part", "other"]
    return (
        grouped.repartition(tasks(docs.sparkSession), *at)
        .sortWithinPartitions(*at)
        .mapInArrow(lambda batches: _edges(batches, most), "a binary, b binary")
    )


def line_duplicates(docs: DataFrame, most: int = MOST_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, text_key, n_lines, dropped) of every distinct (doc_id, text) of `docs`.

    Lines are what newlines separate; a null text is an empty one and has one line. Lines that a chain of steps of at
    most `most` edits connects are one class; of each class the first line stays, by doc_id (nulls first), text_key and
    place, and `dropped` lists the places of a document's other lines in ascending order. Lines of fewer than
    `min_chars` characters always stay. text_key is a hash of the text; rows with equal doc_id and text are one
    document and share its decisions. No rows give no rows.
    """
    known = docs.select("doc_id", "text").withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    whole = known.groupBy("doc_id", "text_key").agg(
        F.first(F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1))).cast("bigint").alias("n_lines")
    )
    placed = _lines(known, "doc_id", "text_key").where(F.length("line") >= min_chars)
    placed = keep(placed.select(F.unhex(F.md5("line")).alias("line"), "doc_id", "text_key", "place"))
    at = F.struct("doc_id", "text_key", "place")
    seen = placed.groupBy("line").agg(F.min(at).alias("first"), F.count("*").alias("times"))
    classes = connected_components(line_edges(docs, most, min_chars))
    seen = keep(seen.join(classes.withColumnRenamed("node", "line"), "line", "left").where("times > 1 or root is not null"))
    lead = seen.where("root is not null").groupBy("root").agg(F.min("first").alias("class_first"))
    stays = seen.join(lead, "root", "left").select("line", F.coalesce("class_first", "first").alias("stays"))
    gone = placed.join(stays, "line").where(~at.eqNullSafe(F.col("stays")))
    gone = gone.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("place")).alias("gone"))
    gone = gone.select(F.col("doc_id").alias("in_doc"), F.col("text_key").alias("in_key"), "gone")
    same = F.col("doc_id").eqNullSafe(F.col("in_doc")) & (F.col("text_key") == F.col("in_key"))
    nothing = F.array().cast("array<int>")
    return whole.join(gone, same, "left").select("doc_id", "text_key", "n_lines", F.coalesce("gone", nothing).alias("dropped"))


def without_repeats(docs: DataFrame, most: int = MOST_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """`docs` with the dropped lines taken out of its texts; every row stays, and all other columns.

    A document that loses every line keeps an empty text; one that loses none keeps its text as it is, null included.
    n_chars, if there is such a column, is counted anew where the text changed.
    """
    found = line_duplicates(docs, most, min_chars).where(F.size("dropped") > 0)
    found = found.select(F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key"), F.col("dropped").alias("__dropped"))
    match = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__key"))
    lines = F.split("text", "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__dropped"))
    joined = docs.join(found, match, "left")
    changed = F.col("__dropped").isNotNull()
    text = F.when(changed, F.array_join(F.transform(left, lambda i: F.get(F.col("__lines"), i)), "\n")).otherwise(F.col("text"))
    new = joined.withColumn("__lines", F.when(changed, lines)).withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new = new.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return new.select(*docs.columns)
