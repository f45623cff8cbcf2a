"""Token counts by byte-pair merging with a heap and a linked list, without working out any token ids of a text.

The symbols of a piece are its bytes, linked to their neighbours. The heap holds the adjacent pairs that can be merged,
by rank and then by place; a pair whose symbols have changed since is passed over. Each merge takes one symbol away, so
a piece has as many tokens as symbols at first, less the merges. Every piece of a slice of texts is counted once.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from pagetrail.llm.pieces import Held, by_chunk, claim, slices

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: A document with more tokens is over the limit.
LIMIT = 1024
#: Bits of a place in a heap entry, and of a symbol in a pair.
PLACE, SYMBOL = 40, 24
PLACES = (1 << PLACE) - 1


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is visible, else the next one
    from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(byte) if byte in visible else chr(next(hidden)) for byte in range(256)]


class Counter:
    """Counts tokens by the merges of a byte-level tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model, before = told["model"], told["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and not model["dropout"] and not model.get("ignore_merges")
        plain = plain and not model["continuing_subword_prefix"] and not model["end_of_word_suffix"]
        plain = plain and before.get("type") == "ByteLevel" and not before["add_prefix_space"] and before.get("use_regex", True)
        added = told["added_tokens"]
        if not plain or told["normalizer"] or any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in added):
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        symbols = model["vocab"]
        if not all(letter in symbols for letter in byte_letters()):
            raise ValueError(f"{path} does not cover every byte")
        self.first = [symbols[letter] for letter in byte_letters()]
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        self.ranks = {symbols[a] << SYMBOL | symbols[b]: rank << PLACE for rank, (a, b) in enumerate(pairs)}
        self.merged = [symbols[a + b] for a, b in pairs]
        letters = {letter: byte for byte, letter in enumerate(byte_letters())}
        self.byte_pairs = {(letters[a], letters[b]): rank << PLACE for rank, (a, b) in enumerate(pairs) if len(a + b) == 2}
        contents = sorted((a["content"] for a in added), key=len, reverse=True)
        self.added = contents
        self.cut = re.compile("|".join(map(re.escape, contents))) if contents else None
        self.pieces = Held(lambda piece: self.piece(piece.encode()))
        self.split = regex.compile(public_tokenizers.PATTERN).findall

    def piece(self, piece: bytes) -> int:
        """The tokens of one match of the pattern."""
        size, get, merged = len(piece), self.ranks.get, self.merged
        symbols = [*map(self.first.__getitem__, piece), -1]  # no pair holds -1, which a symbol merged away becomes too
        pairs = map(self.byte_pairs.get, zip(piece, piece[1:], strict=False))
        heap = [rank + i for i, rank in enumerate(pairs) if rank is not None]
        heapify(heap)
        after, ahead, left = list(range(1, size + 2)), list(range(-1, size)), size
        while heap:
            entry = heappop(heap)
            i = entry & PLACES
            j = after[i]
            if get(symbols[i] << SYMBOL | symbols[j]) != entry - i:
                continue
            left -= 1
            here = symbols[i] = merged[entry >> PLACE]
            symbols[j] = -1
            k = after[i] = after[j]
            ahead[k] = i
            rank = get(here << SYMBOL | symbols[k])
            if rank is not None:
                heappush(heap, rank + i)
            h = ahead[i]
            rank = get(symbols[h] << SYMBOL | here)
            if rank is not None:
                heappush(heap, rank + h)
        return left

    def alone(self, text: str) -> int:
        """The tokens of a whole text; the content of an added token is one."""
        parts = self.cut.split(text) if self.cut else [text]
        return len(parts) - 1 + sum(self.pieces[piece] for part in parts for piece in self.split(part))

    def behind(self, chunk: str) -> int:
        """The tokens of a chunk without added tokens, with a space before it."""
        if chunk.isalpha():  # one piece
            return self.pieces[" " + chunk]
        return sum(map(self.pieces.__getitem__, self.split(" " + chunk)))

    def counts(self, texts: pa.Array) -> np.ndarray:
        whole = np.zeros(len(texts), dtype=bool)
        for content in self.added:
            whole |= pc.fill_null(pc.match_substring(texts, content), False).to_numpy(zero_copy_only=False)
        codes, offsets, values = by_chunk(texts, self.alone, self.behind, whole)
        return np.add.reduceat(np.array(values, dtype=np.int64)[codes], offsets[:-1])


@cache
def _counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of `docs` (doc_id, text), as the tokenizers library counts
    with the byte-level BPE file `tokenizer`, without special tokens around a text; those inside it count one each.

    A null text is an empty one, with 0 bytes and tokens. Repeated rows and null doc_ids, which may be of any type, come
    out as they went in; other columns of `docs` play no part. No rows give no rows. A file with another kind of model
    is an error. A worker holds at most HELD_BYTES of counts, whatever the texts; one piece, however long, is counted in
    time n log n of its length.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("counts", _counter.cache_clear)
        counter = _counter(tokenizer)
        for batch in batches:
            for part in slices(batch, 1):
                n_bytes = pc.fill_null(pc.binary_length(part.column(1)), 0).cast(pa.int64())
                n = counter.counts(part.column(1))
                arrays = [part.column(0), n_bytes, pa.array(n), pa.array(n > limit)]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    schema = f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
