"""Byte-level BPE encoding by a lazily determinised transducer, and streaming decoding.

A sequence of tokens is the encoding of its bytes just if every token encodes itself and every two neighbours encode
their joint bytes. That is a nondeterministic transducer over bytes: after some bytes, each hypothesis has a partial
token and the token before it. The deterministic states are sets of hypotheses, built when first reached; a state knows the
token that the bytes end in if they end there, which leads back to the tokens before. Tokens are emitted where the ways
back of all surviving hypotheses meet. Merges bound how far these stay apart, so that is a few bytes behind, whatever the
text's length; it is looked for every LOOKAHEAD bytes.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from pagetrail.llm.pieces import Held, Lists, claim, id_lists, slices

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: States of the transducer, twice as many steps, and pairs of tokens, that are held before they are dropped and built anew.
HELD_STATES, HELD_PAIRS = 180_000, 100_000
#: Bytes of pieces and their ids that are held.
HELD_PIECES = 8 << 20
#: Bytes of a piece that are read before what is settled is emitted.
LOOKAHEAD = 1024
#: Ids of a text that are decoded at a time.
FED_IDS = 64
NEVER = 1 << 60
#: A hypothesis is a number: the partial token's, times 2 ** 32, and 1 more than the token before it (-1: none).
BEFORE = (1 << 32) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Transducer:
    """Encodes pieces of bytes by the ranks of their merges."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.longer: dict[int, int] = {}  # a partial token's number by 256 * that of the one a byte shorter + that byte
        self.whole, self.depths = [-1], [0]  # the token that each partial one is (-1: none), and its bytes
        for token, rank in ranks.items():
            part = 0
            for depth, byte in enumerate(token, 1):
                part = self.longer.setdefault(part << 8 | byte, len(self.whole))
                if part == len(self.whole):
                    self.whole.append(-1)
                    self.depths.append(depth)
            self.whole[part] = rank
        self.fits: dict[int, bool] = {}  # by 2 ** 32 * (token + 1) + the token behind it
        self.edges: dict[int, tuple[list, list] | None] = {}  # one a token at most
        self._reset()

    def _reset(self) -> None:
        start = (0,)
        self.states: list[tuple] = [start]
        self.lasts: list[int] = [-1]
        self.numbers: dict[tuple, int] = {start: 0}
        self.steps: dict[int, int] = {}  # by 256 * state + byte

    def _merged(self, data: bytes) -> tuple[list[bytes], list[tuple[int, bytes, bytes]]]:
        """Single bytes merged, always the pair of the lowest rank, first from the left, and the merges in order."""
        get = self.ranks.get
        cuts = list(range(len(data) + 1))
        ranks = [get(data[i : i + 2], NEVER) for i in range(len(data) - 1)]
        merges = []
        while ranks and (low := min(ranks)) < NEVER:
            at = ranks.index(low)
            merges.append((low, data[cuts[at] : cuts[at + 1]], data[cuts[at + 1] : cuts[at + 2]]))
            del cuts[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = get(data[cuts[at] : cuts[at + 2]], NEVER)
            if at:
                ranks[at - 1] = get(data[cuts[at - 1] : cuts[at + 1]], NEVER)
        return [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], merges

    def _edges(self, token: int) -> tuple[list, list] | None:
        """What stands at the left and at the right end of a token while it is merged: (rank of the merge that ends
        this, symbol), from a byte to the whole; None if the token does not encode itself."""
        known = self.edges.get(token, False)
        if known is False:
            data = self.tokens[token]
            parts, merges = self._merged(data)
            known = None
            if parts == [data]:
                # the last merge of the symbols at an end, then that of the longer one they are part of, and so on
                left, right = [(NEVER, data)], [(NEVER, data)]
                for rank, a, b in reversed(merges):
                    if a + b == left[-1][1] and data.startswith(a + b):
                        left.append((rank, a))
                    if a + b == right[-1][1] and data.endswith(a + b):
                        right.append((rank, b))
                known = left[::-1], right[::-1]
            self.edges[token] = known
        return known

    def _follows(self, before: int, token: int) -> bool:
        """Whether `token` encodes itself and stays apart from the token before it (-1: none).

        Symbols of the two can only be merged where they meet, so the symbols there are followed, rank by rank.
        """
        key = before + 1 << 32 | token
        known = self.fits.get(key)
        if known is None:
            edges = self._edges(token)
            known = edges is not None and (before < 0 or self._apart(self._edges(before), edges))
            if len(self.fits) > HELD_PAIRS:
                self.fits.clear()
            self.fits[key] = known
        return known

    def _apart(self, before: tuple | None, after: tuple) -> bool:
        if before is None:
            return False
        right, left, i, j = before[1], after[0], 0, 0
        while True:
            until, symbol = right[i]
            until_after, symbol_after = left[j]
            rank = self.ranks.get(symbol + symbol_after, NEVER)
            # of equal ranks the merge further left comes first
            if rank < until and rank <= until_after and rank < NEVER:
                return False
            if until <= until_after:
                if until == NEVER:
                    return True
                i += 1
            else:
                j += 1

    def _last(self, hypotheses: tuple) -> int:
        """The token that the bytes end in if they end here; just one hypothesis can be right about that."""
        known = self.fits.get
        for hypothesis in hypotheses:
            token = self.whole[hypothesis >> 32]
            if token >= 0:
                before = hypothesis & BEFORE
                fits = known(before << 32 | token)
                if fits or fits is None and self._follows(before - 1, token):
                    return token
        raise ValueError("the ranks do not cover every byte")

    def _step(self, state: int, byte: int) -> int:
        get = self.longer.get
        known = self.states[state]
        after = [part << 32 | old & BEFORE for old in known if (part := get(old >> 32 << 8 | byte))]
        if state and (part := get(byte)):
            after.append(part << 32 | self.lasts[state] + 1)
        key = tuple(after)
        number = self.numbers.get(key)
        if number is None:
            last = self._last(key)
            number = self.numbers[key] = len(self.states)
            self.states.append(key)
            self.lasts.append(last)
        self.steps[state << 8 | byte] = number
        return number

    def _back(self, path: list[int], count: int) -> list[int]:
        """The tokens of the first `count` bytes, from the state that each byte leads to."""
        out, sizes, lasts = [], self.sizes, self.lasts
        while count:
            token = lasts[path[count - 1]]
            out.append(token)
            count -= sizes[token]
        return out[::-1]

    def _settled(self, path: list[int]) -> int:
        """How many bytes have tokens that every hypothesis agrees on: where their ways back meet."""
        ways = {len(path) - self.depths[hypothesis >> 32] for hypothesis in self.states[path[-1]]} | {len(path)}
        while len(ways) > 1:
            furthest = max(ways)
            ways.remove(furthest)
            ways.add(furthest - self.sizes[self.lasts[path[furthest - 1]]])
        return ways.pop()

    def encode(self, piece: bytes) -> list[int]:
        """The tokens of one piece; a piece that is a token as it stands is that token."""
        whole = self.ranks.get(piece)
        if whole is not None or not piece:
            return [] if whole is None else [whole]
        if len(self.states) > HELD_STATES or len(self.steps) > 2 * HELD_STATES:
            self._reset()
        out: list[int] = []
        path: list[int] = []
        state, get = 0, self.steps.get
        for start in range(0, len(piece), LOOKAHEAD):
            if start:
                settled = self._settled(path)
                out += self._back(path, settled)
                del path[:settled]
            for byte in piece[start : start + LOOKAHEAD]:
                state = get(state << 8 | byte) or self._step(state, byte)
                path.append(state)
        return out + self._back(path, len(path))


class Encoder:
    """Encodes texts: each match of the pattern is a piece of its own, worked out once while it is held."""

    def __init__(self, path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> None:
        self.transducer = Transducer(read_ranks(path))
        self.pieces = Held(self._packed, HELD_PIECES)
        self.chunks = Lists(self.behind)
        self.split = regex.compile(pattern).findall

    def _packed(self, piece: str) -> bytes:
        return array("i", self.transducer.encode(piece.encode())).tobytes()

    def alone(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def behind(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks with a space before each, and how many each has; of letters alone one is a piece."""
        found = [self.pieces[" " + chunk] if chunk.isalpha() else self.alone(" " + chunk) for chunk in chunks.to_pylist()]
        return np.frombuffer(b"".join(found), dtype="<i4"), np.array([len(ids) // 4 for ids in found], dtype="<i8")

    def lists(self, texts: pa.Array) -> pa.ListArray:
        return id_lists(texts, self.alone, self.chunks)

    def encode(self, text: str | None) -> np.ndarray:
        return self.lists(pa.array([text], pa.string())).values.to_numpy()


#: What may follow a lead byte of UTF-8: the first and last value of the second byte, and how many bytes follow in all.
LEADS = (
    (range(0xC2, 0xE0), 0x80, 0xBF, 1),
    (range(0xE0, 0xE1), 0xA0, 0xBF, 2),
    (range(0xE1, 0xED), 0x80, 0xBF, 2),
    (range(0xED, 0xEE), 0x80, 0x9F, 2),
    (range(0xEE, 0xF0), 0x80, 0xBF, 2),
    (range(0xF0, 0xF1), 0x90, 0xBF, 3),
    (range(0xF1, 0xF4), 0x80, 0xBF, 3),
    (range(0xF4, 0xF5), 0x80, 0x8F, 3),
)


def utf8_state(pending: bytes) -> tuple[int, int, int] | None:
    """What must follow an unfinished character: least and greatest next byte and bytes to come; None if none can."""
    for leads, low, high, more in LEADS:
        if pending[0] in leads:
            if len(pending) == 1:
                return low, high, more
            if low <= pending[1] <= high and all(0x80 <= b <= 0xBF for b in pending[2:]) and len(pending) <= more:
                return 0x80, 0xBF, more + 1 - len(pending)
    return None


class Decoder:
    """Turns token ids into text as they come, holding back an unfinished character.

    The state is what is pending of a character. A step from a state by a token, its text and the next state, is worked
    out byte by byte when first taken. Bytes that no character can hold become U+FFFD, one for each broken start.
    """

    def __init__(self, tokens: dict[int, bytes]) -> None:
        self.tokens = tokens
        self.known: dict[bytes, dict[int, tuple[str, bytes]]] = {}
        self.whole: dict[int, str] = {}  # the steps from no pending bytes to none
        self.pending = b""

    def _step(self, pending: bytes, token: int) -> tuple[str, bytes]:
        out: list[str] = []
        for byte in self.tokens[token]:
            state = utf8_state(pending) if pending else None
            if state and state[0] <= byte <= state[1]:
                pending += bytes((byte,))
                if state[2] == 1:
                    out.append(pending.decode())
                    pending = b""
                continue
            if pending:
                out.append("�")
                pending = b""
            if byte < 0x80:
                out.append(chr(byte))
            elif utf8_state(bytes((byte,))):
                pending = bytes((byte,))
            else:
                out.append("�")
        return "".join(out), pending

    def feed(self, ids: list[int]) -> str:
        out: list[str] = []
        whole = self.whole.get
        for start in range(0, len(ids), FED_IDS):
            some = ids[start : start + FED_IDS]
            texts = None if self.pending else list(map(whole, some))
            if texts is None or None in texts:  # a step is new, or leaves a character unfinished
                texts = self._taken(some)
            out += texts
        return "".join(out)

    def _taken(self, ids: list[int]) -> list[str]:
        out: list[str] = []
        pending = self.pending
        steps = self.known.setdefault(pending, {})
        for token in ids:
            found = steps.get(token)
            if found is None:
                found = steps[token] = self._step(pending, token)
                if not pending and not found[1]:
                    self.whole[token] = found[0]
            out.append(found[0])
            if found[1] != pending:
                pending = found[1]
                steps = self.known.setdefault(pending, {})
        self.pending = pending
        return out

    def finish(self) -> str:
        """What ends a text: U+FFFD if a character is unfinished."""
        left, self.pending = self.pending, b""
        return "�" if left else ""


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


@cache
def _decoder(path: str) -> Decoder:
    return Decoder({rank: token for token, rank in read_ranks(path).items()})


def _lists(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[pa.Array, pa.ListArray]]:
    """(doc_ids, ids) of (doc_id, text) batches, a slice at a time."""
    claim("bpe", _encoder.cache_clear)
    encoder = _encoder(path)
    for batch in batches:
        for part in slices(batch, 1):
            yield part.column(0), encoder.lists(part.column(1))


def _rows(lists: pa.ListArray) -> Iterator[list[int]]:
    ends = np.cumsum([0, *(n or 0 for n in lists.value_lengths().to_pylist())])
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return (flat[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False))


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for docs, lists in _lists(batches, path):
        yield pa.RecordBatch.from_arrays([docs, lists], names=["doc_id", "ids"])


def _with_texts(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    decoder = _decoder(path)
    for docs, lists in _lists(batches, path):
        texts = [decoder.feed(ids) + decoder.finish() for ids in _rows(lists)]
        yield pa.RecordBatch.from_arrays([docs, lists, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])


def _digests(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    decoder = _decoder(path)
    decimals = pa.array(map(str, range(max(decoder.tokens) + 1)))
    for docs, lists in _lists(batches, path):
        rows = []
        said = pc.binary_join(pa.ListArray.from_arrays(lists.offsets, decimals.take(lists.values)), " ")
        for ids, line in zip(_rows(lists), said.cast(pa.binary()), strict=True):
            text = decoder.feed(ids) + decoder.finish()
            rows.append((len(ids), hashlib.sha256(line.as_buffer()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
        n, said, text = zip(*rows, strict=True)
        arrays = [docs, pa.array(n, pa.int64()), pa.array(said), pa.array(text)]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def encoded(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """(doc_id, ids) of every row of `docs`, by the rank file at `path`, without special tokens.

    A null text is an empty one and has no ids. Rows keep their order within partitions; repeated rows and null
    doc_ids come out as they went in. No rows give no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(lambda b: _encoded(b, path), f"doc_id {kind}, ids array<int>")


def decoded(rows: DataFrame, path: str = RANKS) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids decode to an empty text."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(path)
        for batch in batches:
            texts = [decoder.feed(ids or []) + decoder.finish() for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def with_texts(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """(doc_id, ids, text) of (doc_id, text): the ids of each row and the text that these decode to, in one pass."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids array<int>, text string"
    return docs.select("doc_id", "text").mapInArrow(lambda b: _with_texts(b, path), schema)


def digests(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of (doc_id, text), encoded and decoded in one pass."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(lambda b: _digests(b, path), schema)
