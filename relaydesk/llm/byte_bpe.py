"""Byte-level BPE: exact encoding in linear time, and decoding.

A rank file gives the merges in order. A piece of text that is not a token
itself is covered from left to right by the longest token that starts there;
a token is accepted if it may stand beside the one before it, which holds when
merging the two tokens' bytes gives just these two. Where no token fits, the
encoder steps back to a shorter one and marks the place it came from, so each
place is left at most once. Which two tokens may stand side by side is
remembered.

pyahocorasick takes text, so every byte is mapped to the Latin-1 character of
the same number.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from relaydesk.llm.common import per_process

# pieces whose ids a worker remembers, of at most so many characters; all are forgotten when there are more
REMEMBERED = 800_000
REMEMBERED_LENGTH = 200


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file in order of their ranks, which are their ids."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without gaps")
    return [tokens[i] for i in range(len(tokens))]


def _halves(token: bytes, ranks: dict[bytes, int]) -> tuple[int, int] | None:
    """The two tokens that the last merge joins into ``token``; None if merging never makes it."""
    top, parts = ranks[token], [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        best = min((ranks.get(parts[i] + parts[i + 1], top), i) for i in range(len(parts) - 1))
        if best[0] >= top:
            return None
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
    if parts[0] not in ranks or parts[1] not in ranks:
        return None
    return ranks[parts[0]], ranks[parts[1]]


class Encoder:
    """The tables of a vocabulary, whose size bounds theirs.

    ``halves`` has for each token the two that the last merge joins, the token
    itself twice if it is one byte, or None if no merge makes it.
    """

    def __init__(self, tokens: list[bytes], pattern: str, halves: list[tuple[int, int] | None] | None = None):
        self.tokens, self.pattern = tokens, pattern
        self.ranks = {token: i for i, token in enumerate(tokens)}
        self.halves = halves or [
            (i, i) if len(token) == 1 else _halves(token, self.ranks) for i, token in enumerate(tokens)
        ]
        self.merged = {
            halves: i for i, halves in enumerate(self.halves) if halves is not None and len(tokens[i]) > 1
        }
        self.shorter = [self._shorter(token) for token in tokens]

    def _shorter(self, token: bytes) -> int:
        """The longest token that ``token`` begins with, other than itself; -1 if there is none."""
        for end in range(len(token) - 1, 0, -1):
            found = self.ranks.get(token[:end])
            if found is not None and self.halves[found] is not None:
                return found
        return -1

    def prepare(self) -> Encoder:
        """Add what is made in the worker: the automaton, the pattern and the memories."""
        self.automaton = ahocorasick.Automaton()
        for i, token in enumerate(self.tokens):
            if self.halves[i] is not None:
                self.automaton.add_word(token.decode("latin-1"), i)
        self.longest_token = max(map(len, self.tokens))
        # white space as Unicode has it; \s of this library has a few more characters
        unicode_space = self.pattern.replace("[^\\s", "[^\\p{White_Space}").replace("\\S", "\\P{White_Space}")
        self.split = regex.compile(unicode_space.replace("\\s", "\\p{White_Space}"))
        self.beside: dict[tuple[int, int], bool] = {}
        self.known = _Remembered(self)
        return self

    def may_stand_beside(self, left: int, right: int) -> bool:
        pair = (left, right)
        found = self.beside.get(pair)
        if found is None:
            if len(self.beside) >= REMEMBERED:
                self.beside.clear()
            found = self.beside[pair] = self._undo(left, right)
        return found

    def _undo(self, left: int, right: int) -> bool:
        """Undo the merges of both tokens from the last to the first.

        The border must not be crossed by a merge that comes before one of those undone.
        """
        limit = len(self.tokens)
        while True:
            if self.merged.get((left, right), limit) < limit:
                return False
            if left > right:
                limit = left
                left = self.halves[left][1]
                if left == limit:
                    limit = right + 1
                    right = self.halves[right][0]
                    if right + 1 == limit:
                        return True
            else:
                limit = right + 1
                right = self.halves[right][0]
                if right + 1 == limit:
                    limit = left
                    left = self.halves[left][1]
                    if left == limit:
                        return True

    def _longest(self, letters: str, start: int) -> int:
        """The longest token that starts at ``start``."""
        ahead = letters[start : start + self.longest_token]
        end = self.automaton.longest_prefix(ahead)  # of a token, perhaps cut off
        while ahead[:end] not in self.automaton:
            end -= 1
        return self.automaton.get(ahead[:end])

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size, letters, longest = len(piece), piece.decode("latin-1"), self._longest
        tokens, out, open_places, place = self.tokens, [], bytearray(b"\1") * (size + 1), 0
        token = longest(letters, 0)
        while True:
            end = place + len(tokens[token])
            if open_places[end] and (not out or self.may_stand_beside(out[-1], token)):
                out.append(token)
                if end == size:
                    return out
                place, token = end, longest(letters, end)
                continue
            token = self.shorter[token]
            if token < 0:
                open_places[place] = 0
                token = out.pop()
                place -= len(tokens[token])
                # the same token is tried again, now ends at a closed place and is cut shorter

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        return b"".join(map(self.known.__getitem__, self.split.findall(text)))

    def decode(self, ids: memoryview) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class _Remembered(dict):
    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        ids = self.encoder.encode_piece(piece.encode())
        found = b"".join(i.to_bytes(4, "little") for i in ids)
        if len(piece) <= REMEMBERED_LENGTH:
            self[piece] = found
        return found


def _ready(name: str, shared: Broadcast) -> Encoder:
    return per_process(name, lambda: Encoder(*shared.value).prepare())


def _sliced(column: pa.Array, rows: int = 256) -> Iterator[pa.Array]:
    for start in range(0, len(column), rows):
        yield column.slice(start, rows)


class ByteBpe:
    """Columns that encode and decode with the vocabulary of a rank file.

    ``vocabulary`` is the path of the file, read by the driver; ``pattern``
    splits text into the pieces that are encoded separately. Special tokens are
    ordinary text. Null text encodes like the empty text, to no ids; null ids
    decode to no bytes. Each row stands alone: repeated rows, ties, extra
    columns and empty tables need no rule.
    """

    def __init__(self, spark: SparkSession, vocabulary: str, pattern: str):
        made = Encoder(read_ranks(vocabulary), pattern)
        self._shared = spark.sparkContext.broadcast((made.tokens, pattern, made.halves))
        self._name = f"byte_bpe-{hashlib.sha256(repr((made.tokens, pattern)).encode()).hexdigest()}"

    def encode(self, text: Column) -> Column:
        """Ids as binary, four bytes each, little-endian."""
        shared, name = self._shared, self._name

        @F.arrow_udf("binary")
        def ids(texts: pa.Array) -> pa.Array:
            encoder = _ready(name, shared)
            return pa.array(
                [encoder.encode(t or "") for part in _sliced(texts) for t in part.to_pylist()], pa.binary()
            )

        # so that the plan runs it once, however many columns are made of the ids
        return ids.asNondeterministic()(text.cast("string"))

    def decode(self, ids: Column) -> Column:
        """The bytes that the ids stand for."""
        shared, name = self._shared, self._name

        @F.arrow_udf("binary")
        def content(column: pa.Array) -> pa.Array:
            encoder = _ready(name, shared)
            return pa.array(
                [encoder.decode(memoryview(i or b"").cast("I")) for part in _sliced(column) for i in part.to_pylist()],
                pa.binary(),
            )

        return content(ids)

    def round_trip(self, text: Column) -> Column:
        """Struct of ids and content: a text's ids, and the bytes decoded from them, in one worker."""
        shared, name = self._shared, self._name

        @F.arrow_udf("ids binary, content binary")
        def there_and_back(texts: pa.Array) -> pa.Array:
            encoder = _ready(name, shared)
            ids = [encoder.encode(t or "") for part in _sliced(texts) for t in part.to_pylist()]
            content = [encoder.decode(memoryview(i).cast("I")) for i in ids]
            return pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(content, pa.binary())], ["ids", "content"])

        return there_and_back.asNondeterministic()(text.cast("string"))

    @staticmethod
    def count(ids: Column) -> Column:
        """Number of ids; 0 for null."""
        return F.coalesce((F.octet_length(ids) / 4).cast("long"), F.lit(0).cast("long"))
