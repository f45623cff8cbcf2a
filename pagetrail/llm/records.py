"""Token ids in length-delimited binary records, with an offset index for reading in any order.

A record is: the payload's length as 8 bytes, the masked checksum of those 8 bytes, the payload, its masked checksum, and
a newline. All numbers are little-endian; checksums are CRC-32, rotated right by 15 bits and raised by a constant, so
that records of records keep distinct sums. The payload is a byte that tells whether there is a doc_id, the doc_id as 8
bytes, and the ids in 2 bytes each, or 4 if the vocabulary needs them. Spark's text writer writes the records, as bytes,
so its commit protocol holds on any file system; the newline is what it puts behind each row.

The index is a table of its own: file, place, doc_id, offset and size of each record, n_tokens and start.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from pagetrail.llm.common import keep
from pagetrail.llm.pieces import Held, Lists, claim, id_lists, slices, starts_with_space

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END = 2
HEAD = struct.Struct("<QI")
SUM = struct.Struct("<I")
IDENTITY = struct.Struct("<?q")
#: Bytes of a text held beside the arrays of chunks, and of chunks that the library encodes in one go.
HELD_PIECES, JOINED_BYTES = 16 << 20, 256 << 10
#: A file is closed once it has this many bytes; one record may exceed them.
FILE_BYTES = 128 << 20


def masked(data: bytes) -> int:
    sum_ = zlib.crc32(data)
    return ((sum_ >> 15 | sum_ << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """A record without the newline at its end."""
    length = struct.pack("<Q", len(payload))
    return length + SUM.pack(masked(length)) + payload + SUM.pack(masked(payload))


def frames(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, payload) of each record; a record that does not fit its length or checksums is an error."""
    view, at = memoryview(data), 0
    while at < len(data):
        if len(data) - at < HEAD.size:
            raise ValueError(f"the record at {at} is cut off")
        length, sum_ = HEAD.unpack_from(data, at)
        end = at + HEAD.size + length
        if sum_ != masked(view[at : at + 8]) or end + SUM.size + 1 > len(data):
            raise ValueError(f"the head of the record at {at} is damaged")
        payload = bytes(view[at + HEAD.size : end])
        if SUM.unpack_from(data, end)[0] != masked(payload) or data[end + SUM.size] != 10:
            raise ValueError(f"the record at {at} is damaged")
        yield at, payload
        at = end + SUM.size + 1


def read_at(path: str, offset: int) -> bytes:
    """The payload of one record of a file that the caller can open, by its offset from the index."""
    with open(path, "rb") as file:
        file.seek(offset)
        head = file.read(HEAD.size)
        rest = file.read(HEAD.unpack(head)[0] + SUM.size + 1)
        return next(frames(head + rest))[1]


def identity(doc_id: int | None) -> bytes:
    return IDENTITY.pack(doc_id is not None, doc_id or 0)


def unpack(payload: bytes, wide: bool) -> tuple[int | None, np.ndarray]:
    known, doc_id = IDENTITY.unpack_from(payload)
    return doc_id if known else None, np.frombuffer(payload, "<u4" if wide else "<u2", offset=IDENTITY.size)


class Library:
    """Ids of texts by the tokenizers library.

    It encodes each new chunk of a slice once, many chunks joined at spaces in one go: no piece of its first split reaches
    across these, and its tokens stand for bytes of the text, so their sizes tell which ids are whose. A text that holds
    the content of an added token, which the library cuts out before that split, it encodes whole.
    """

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        vocabulary = self.tokenizer.get_vocab()
        # a character of a token of the byte-level model is a byte of the text
        self.sizes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        self.sizes[list(vocabulary.values())] = list(map(len, vocabulary))
        self.pieces = Held(self._packed, HELD_PIECES)
        self.chunks = Lists(self.behind)
        self.split = regex.compile(public_tokenizers.PATTERN).findall

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<i4")

    def _packed(self, text: str) -> bytes:
        return self._ids(text).tobytes()

    def alone(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            return self._packed(text)
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def behind(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks with a space before each, and how many each has."""
        apart = starts_with_space(chunks)
        for token in self.added:
            if " " in token:
                apart = pc.or_(apart, pc.match_substring(chunks, token.split(" ", 1)[0]))
        apart = apart.to_numpy(zero_copy_only=False)
        sizes = pc.binary_length(chunks).to_numpy().astype(np.int64) + 1
        part = np.cumsum(sizes) // JOINED_BYTES
        cuts = {0, len(chunks), *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist()}
        odd = np.flatnonzero(apart).tolist()
        cuts = sorted(cuts.union(odd, (i + 1 for i in odd)))
        ids, counts = [np.empty(0, "<i4")], [np.empty(0, "<i8")]
        for a, b in zip(cuts, cuts[1:], strict=False):
            names = chunks.slice(a, b - a).to_pylist()
            if not apart[a]:
                found = self._ids(" " + " ".join(names))
                reach, ends = np.cumsum(self.sizes[found]), np.cumsum(sizes[a:b])
                at = np.minimum(np.searchsorted(reach, ends), len(found) - 1)
                if at[-1] + 1 == len(found) and np.array_equal(reach[at], ends):
                    ids.append(found)
                    counts.append(np.diff(at, prepend=-1))
                    continue
            # chunks that may not be joined, or tokens that do not stand for bytes
            each = [self.alone(" " + name) for name in names]
            ids.append(np.frombuffer(b"".join(each), "<i4"))
            counts.append(np.array([len(one) // 4 for one in each]))
        return np.concatenate(ids), np.concatenate(counts)

    def lists(self, texts: pa.Array) -> pa.ListArray:
        whole = np.zeros(len(texts), dtype=bool)
        for token in self.added:
            whole |= pc.fill_null(pc.match_substring(texts, token), False).to_numpy(zero_copy_only=False)
        return id_lists(texts, self.alone, self.chunks, whole)


@cache
def _library(path: str) -> Library:
    return Library(path)


def write(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end: int = END, file_bytes: int = FILE_BYTES) -> None:
    """Write the ids of every row of `docs` (doc_id, text) and the end id as records to the folder `path`, in ascending
    order of doc_id (nulls first, ties by a hash of the text) within and across the sorted file names.

    doc_id is an integer; another type is an error. A null text is an empty one. Repeated rows are written as often as
    they are there. A task begins a new file, in a folder named by task and file, behind `file_bytes`.
    """
    kind = docs.schema["doc_id"].dataType
    if not isinstance(kind, IntegralType):
        raise TypeError(f"doc_id must be an integer, not {kind.simpleString()}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("records", _library.cache_clear)
        library = _library(tokenizer)
        task, written = TaskContext.get().partitionId(), 0
        kind = "<u4" if library.wide else "<u2"
        last = np.array([end], dtype=kind).tobytes()
        for batch in batches:
            for part in slices(batch, 1):
                lists = library.lists(part.column(1))
                ids, ends = lists.values.to_numpy().astype(kind), lists.offsets.to_numpy()
                files, places, out = [], [], []
                for doc, a, b in zip(part.column(0).to_pylist(), ends, ends[1:], strict=False):
                    out.append(frame(identity(doc) + ids[a:b].tobytes() + last))
                    files.append(f"{task:06d}-{written // file_bytes:06d}")
                    places.append(written)
                    written += len(out[-1])
                arrays = [pa.array(files, pa.string()), pa.array(places, pa.int64()), pa.array(out, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["file", "place", "record"])

    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.select("doc_id", "text", mark.alias("mark"))
    rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), "mark")
    rows = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "mark").select("doc_id", "text")
    records = rows.mapInArrow(run, "file string, place bigint, record binary").sortWithinPartitions("file", "place")
    records = records.select("file", F.col("record").cast("string"))
    records.write.option("lineSep", "\n").partitionBy("file").text(path)


def _parsed(batches: Iterator[pa.RecordBatch], wide: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, data in zip(batch.column(0), batch.column(1), strict=True):
            rows, ahead = [], 0
            for place, (offset, payload) in enumerate(frames(data.as_py())):
                doc_id, ids = unpack(payload, wide)
                rows.append((path.as_py(), place, doc_id, offset, len(payload), ahead, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                ahead += len(ids)
            if rows:
                kinds = [pa.string(), *[pa.int64()] * 7]
                arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                names = ["file", "place", "doc_id", "offset", "size", "ahead", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)


def index(spark: SparkSession, path: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """(file, place, doc_id, offset, size, start, n_tokens, ids_crc32) of every record under `path`, read from the files.

    `start` counts the ids of all records before it. Every length and checksum is checked. An empty folder gives no
    rows. One row per file, not per record, goes through one task to add up the starts.
    """
    wide = _library(tokenizer).wide
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    schema = "file string, place bigint, doc_id bigint, offset bigint, size bigint, ahead bigint, n_tokens bigint, ids_crc32 bigint"
    records = keep(files.mapInArrow(lambda b: _parsed(b, wide), schema))
    totals = records.groupBy(F.col("file").alias("in_file")).agg(F.sum("n_tokens").alias("total"))
    by_name = Window.orderBy("in_file").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("before", F.coalesce(F.sum("total").over(by_name), F.lit(0)))
    start: Column = (F.col("before") + F.col("ahead")).alias("start")
    found = records.join(totals, records.file == totals.in_file)
    return found.select("file", "place", "doc_id", "offset", "size", start, "n_tokens", "ids_crc32")


def documents_at(paths: Iterable[tuple[str, int]], tokenizer: str = TOKENIZER) -> Iterator[tuple[int | None, list[int]]]:
    """(doc_id, ids) of records in the order asked for, by (file, offset) rows of the index."""
    wide = _library(tokenizer).wide
    for path, offset in paths:
        doc_id, ids = unpack(read_at(path.removeprefix("file://").removeprefix("file:"), offset), wide)
        yield doc_id, ids.tolist()
