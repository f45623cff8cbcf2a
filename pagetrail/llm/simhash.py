"""Near-duplicate documents by SimHash fingerprints and a Gray-order hierarchical index.

Fingerprints at most r bits apart agree wholly in one of r + 1 segments of their bits. So each fingerprint joins one
group per segment. A group of more than GROUP_ROWS fingerprints is cut again in the same way over the bits that its
segment leaves free, as often as needed: a group with f free bits cannot hold more than 2^f fingerprints, so the cutting
ends. In a group, fingerprints are sorted by Gray rank with the shared segment first; runs that share their leading bits
are the nodes of a tree, a node standing for the bits that its members have in common. Pairs of nodes are followed from
the top, adding up the differences of their bits, and a pair over the limit is dropped with all that is below it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetrail.llm.common import by_row, keep, tasks, words
from pagetrail.llm.components import connected_components

SEED = 42
GROUP_ROWS = 2048
#: Shingles whose hashes are held at a time.
SLAB = 1 << 16
#: Bits that each level of the tree adds.
LEVEL_BITS = 11
#: Pairs of nodes compared at a time.
PAIRS = 1 << 21


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text's word shingles as a signed integer; 0 for a text without words."""
    found = words(text)
    if not found:
        return 0
    if len(found) < shingle:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(s, SEED) for s in shingles]
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), SLAB):
        some = np.array(hashes[start : start + SLAB], dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp) of every row; a null text is an empty one."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = pa.schema([("doc_id", pa.int64() if kind == "bigint" else pa.int32()), ("fp", pa.int64())])
    run = by_row(lambda doc, text: (doc, fingerprint(text, shingle)), ["doc_id", "text"], schema)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp bigint")


def hexadecimal(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _segments(free: int, parts: int) -> list[int]:
    """The set bits of `free` cut into masks of nearly equal numbers of adjacent bits."""
    bits = [1 << i for i in range(63, -1, -1) if free >> i & 1]
    cuts = [len(bits) * i // parts for i in range(parts + 1)]
    return [sum(bits[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _pairs(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All places (i, j) with i of the left run and j of the right run, for runs given as (first, end) rows."""
    sizes = (left[:, 1] - left[:, 0]) * (right[:, 1] - right[:, 0])
    start = 0
    while start < len(sizes):
        end = start + max(1, int(np.searchsorted(np.cumsum(sizes[start:]), PAIRS, side="right")))
        n = sizes[start:end]
        run = np.repeat(np.arange(start, end), n)
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wide = (right[:, 1] - right[:, 0])[run]
        yield left[run, 0] + within // wide, right[run, 0] + within % wide
        start = end


def _links(codes: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j), i < j, of the Gray-sorted codes that differ in `most` bits or fewer, through the tree."""
    shifts = [*range(64 - LEVEL_BITS, 0, -LEVEL_BITS), 0]

    def runs(shift: int, first: int, end: int) -> np.ndarray:
        top = codes[first:end] >> np.uint64(shift)
        return first + np.flatnonzero(np.concatenate(([True], top[1:] != top[:-1])))

    levels = [runs(s, 0, len(codes)) for s in shifts]

    def follow(level: int, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        # left, right: (first, end) among the nodes of this level, below two nodes of the level above
        starts = levels[level]
        for i, j in _pairs(left, right):
            once = i <= j
            i, j = i[once], j[once]
            apart = np.bitwise_count((codes[starts[i]] ^ codes[starts[j]]) >> np.uint64(shifts[level]))
            near = apart <= most
            i, j = i[near], j[near]
            if not len(i):
                continue
            if level == len(levels) - 1:
                yield starts[i[i < j]], starts[j[i < j]]
            else:
                ends = np.append(starts[1:], len(codes))
                below = levels[level + 1]
                span = np.stack([np.searchsorted(below, starts), np.searchsorted(below, ends)], axis=1)
                yield from follow(level + 1, span[i], span[j])

    if len(codes) > 1:
        whole = np.array([[0, len(levels[0])]])
        yield from follow(0, whole, whole)


def _roots(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n places the smallest place that the links connect it to."""
    root = np.arange(n)
    for i, j in links:
        while True:
            low = np.minimum(root[i], root[j])
            if (root[i] == low).all() and (root[j] == low).all():
                break
            for k in (i, j):
                np.minimum.at(root, root[k], low)
            while (root[root] != root).any():
                root = root[root]
    return root


def group_edges(codes: np.ndarray, fixed: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) of the linked fingerprints of one group, which agree in the bits of the mask `fixed`."""
    order = [i for i in range(63, -1, -1) if fixed >> i & 1] + [i for i in range(63, -1, -1) if not fixed >> i & 1]
    turned = np.zeros_like(codes)
    for place, bit in enumerate(order):
        turned |= (codes >> np.uint64(bit) & np.uint64(1)) << np.uint64(63 - place)
    by = np.argsort(gray_rank(turned), kind="stable")
    codes, turned = codes[by], turned[by]
    root = _roots(len(codes), _links(turned, most))
    member = np.flatnonzero(root != np.arange(len(codes)))
    return codes[member], codes[root[member]]


def _edges(batches: Iterator[pa.RecordBatch], masks: dict[int, int], most: int) -> Iterator[pa.RecordBatch]:
    """Edges of the groups (path, value), whose rows come one after the other."""
    held: list[np.ndarray] = []

    def done() -> Iterator[pa.RecordBatch]:
        rows = np.concatenate(held, axis=1)
        a, b = group_edges(np.unique(rows[2].view(np.uint64)), masks[int(rows[0, 0])], most)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"])

    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)])
        if not rows.shape[1]:
            continue
        cut = np.flatnonzero((rows[:2, 1:] != rows[:2, :-1]).any(axis=0)) + 1
        for part in np.split(rows, cut, axis=1):
            if held and (held[0][:2, 0] != part[:2, 0]).any():
                yield from done()
                held.clear()
            held.append(part)
    if held:
        yield from done()


def _spread(rows: DataFrame, masks: dict[int, int], paths: list[int]) -> DataFrame:
    """(path, value, fp): each fingerprint once for each mask, with its bits under that mask."""
    keys = [
        F.struct(F.lit(p).alias("path"), F.col("fp").bitwiseAND(F.lit(_signed(masks[p])).cast("long")).alias("value"))
        for p in paths
    ]
    return rows.select("fp", F.explode(F.array(*keys)).alias("key")).select("key.path", "key.value", "fp")


def edges(codes: DataFrame, most: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Edges (a, b) that connect just those of the distinct fingerprints `fp` that links of `most` bits connect.

    Groups of more than `group_rows` fingerprints are cut again, unless they have so few free bits that they cannot be
    much larger; the rest are searched, each in one task.
    """
    every = (1 << 64) - 1
    masks = dict(enumerate(_segments(every, most + 1)))
    rows, found = _spread(codes.select("fp"), masks, list(masks)), None
    while rows is not None:
        sizes = rows.groupBy("path", "value").count().where("count > 1")
        sized = keep(rows.join(sizes, ["path", "value"]))
        ends = [p for p, mask in masks.items() if (every & ~mask).bit_count() <= LEVEL_BITS]
        is_large = (F.col("count") > group_rows) & ~F.col("path").isin(ends)
        known = dict(masks)
        part = (
            sized.where(~is_large)
            .select("path", "value", "fp")
            .repartition(tasks(codes.sparkSession), "path", "value")
            .sortWithinPartitions("path", "value")
            .mapInArrow(lambda batches, known=known: _edges(batches, known, most), "a bigint, b bigint")
        )
        found = part if found is None else found.union(part)
        large, rows = sized.where(is_large), None
        for (path,) in large.select("path").distinct().collect():  # at most one row per mask
            first = len(masks)
            for segment in _segments(every & ~masks[path], most + 1):
                masks[len(masks)] = masks[path] | segment
            cut = _spread(large.where(F.col("path") == path), masks, list(range(first, len(masks))))
            rows = cut if rows is None else rows.union(cut)
    return found


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of `docs` (doc_id, text, any other columns).

    Two rows are linked if their fingerprints differ in `max_bits` bits or fewer, and a component is named by its
    smallest doc_id; a null doc_id is never the name unless the component has no other. Null and empty texts have
    the fingerprint zero. Repeated rows come out as often as they went in; no rows give no rows.
    """
    marked = keep(fingerprints(docs, shingle))
    codes = keep(marked.groupBy("fp").agg(F.min("doc_id").alias("low")))
    linked = connected_components(edges(codes, max_bits))
    names = linked.join(codes, linked.node == codes.fp).select("node", "root", "low")
    lowest = names.groupBy("root").agg(F.min("low").alias("component_low"))
    named = names.join(lowest, "root").select(F.col("node").alias("fp"), "component_low")
    codes = codes.join(named, "fp", "left").select("fp", F.coalesce("component_low", "low").alias("component_id"))
    return marked.join(codes, "fp").select("doc_id", hexadecimal("fp").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of `docs` whose doc_id names their component, with all their columns.

    Rows that share a doc_id are one document: they stay together if one of them does.
    """
    stay = near_duplicates(docs, shingle, max_bits).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stay = stay.select(F.col("doc_id").alias("__stays")).distinct()
    return docs.join(stay, F.col("doc_id").eqNullSafe(F.col("__stays")), "left_semi")
