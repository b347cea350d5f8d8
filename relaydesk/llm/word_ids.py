"""Ids of whole batches of texts by a BPE vocabulary whose words end at white space.

A batch is cut into words, and each distinct word of it is encoded once: split
into pieces by the classes of its characters, and the distinct pieces merged
together, pieces of one length at a time, in array operations. In each step
every piece does the merge of least rank, the leftmost of equals, which is
what the tokenizer's model does. Nothing is kept from one batch to the next,
so memory is bounded by the batch.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

# words whose ids a tokenizer of single texts remembers
REMEMBERED = 600_000
# bytes; longer pieces are left to the tokenizer's model
LONGEST = 48
NONE = np.int32(2**31 - 1)
SPACE, LETTER, NUMBER, OTHER = range(4)
# characters below this are never changed by normalization but for their case
PLAIN = 0x250


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others for the characters from 256 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    letters = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class WordTokenizer:
    """Ids by a vocabulary that splits text at white space first, remembered by word.

    White space ends every piece, so the ids of a text are those of its words.
    A word that was not seen is normalized and split as the tokenizer does and
    each piece is given to the tokenizer's model. With ``added`` a text that holds
    a literal of the definition's added tokens is left to the tokenizer itself,
    which gives the token's id for it; without, literals are words like others.
    """

    def __init__(self, definition: str, added: bool = False):
        self.tokenizer = Tokenizer.from_str(definition)
        tokens = self.tokenizer.get_added_tokens_decoder().values() if added else []
        # those that are normalized first are looked for in the normalized text
        self.normalized = any(t.normalized for t in tokens)
        self.added = regex.compile("|".join(regex.escape(t.content) for t in tokens)) if tokens else None
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.white = regex.compile(r"\P{White_Space}+")
        self.odd_space = regex.compile("[\x1c-\x1f]")  # str.split takes these for white space
        self.pieces = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
        self.by_word: dict[str, bytes] = {}
        self.by_piece: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        ids = self.by_piece.get(piece)
        if ids is None:
            mapped = "".join(map(self.letters.__getitem__, piece.encode()))
            ids = b"".join(t.id.to_bytes(4, "little") for t in self.model.tokenize(mapped))
            self.by_piece[piece] = ids
        return ids

    def _word(self, word: str) -> bytes:
        plain = word.lower() if word.isascii() else self.tokenizer.normalizer.normalize_str(word)
        ids = self.by_word[word] = b"".join(map(self._piece, self.pieces.findall(plain)))
        return ids

    def encode(self, text: str) -> bytes:
        if self.added and (self.normalized or self.added.search(text)):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self.by_word) > REMEMBERED:
            self.by_word.clear()
            self.by_piece.clear()
        words = self.white.findall(text) if self.odd_space.search(text) else text.split()
        known = self.by_word
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            return b"".join([known[w] if w in known else self._word(w) for w in words])


def _gather(values: np.ndarray, bounds: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``values[bounds[i]:bounds[i + 1]]`` of all i in ``index``, one behind the other, and their bounds."""
    sizes = (bounds[1:] - bounds[:-1])[index]
    out = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
    return values[np.arange(out[-1]) + np.repeat(bounds[:-1][index] - out[:-1], sizes)], out


def _classes() -> np.ndarray:
    """The class of every character: white space, letter, number or other."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, name in ((LETTER, "L"), (NUMBER, "N"), (SPACE, "White_Space")):
        for found in regex.finditer(rf"\p{{{name}}}+", every):
            a, b = ord(found[0][0]), ord(found[0][-1])
            if b - a + 1 == len(found[0]):
                out[a : b + 1] = kind
            else:  # the surrogates, which are no characters, lie between
                out[list(map(ord, found[0]))] = kind
    return out


class WordIds:
    """Ids as the tokenizers library gives them, without special tokens but for literals of added tokens in a text.

    ``definition`` is the text of a tokenizer file: NFC, lower case, pieces of
    letters, single numbers, contractions and other characters, and byte-level
    BPE with ``</w>`` at the end of a piece. Without ``added`` the literals are
    split like other text.
    """

    def __init__(self, definition: str, added: bool = True):
        self.single = WordTokenizer(definition, added)
        model = json.loads(definition)["model"]
        vocabulary, letters = model["vocab"], byte_letters()
        self.inner = np.array([vocabulary[c] for c in letters], np.int64)
        self.last = np.array([vocabulary[f"{c}</w>"] for c in letters], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        codes = np.array([vocabulary[a] << 20 | vocabulary[b] for a, b in pairs], np.int64)
        self.rank_order = np.argsort(codes, kind="stable").astype(np.int32)
        self.codes = codes[self.rank_order]
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self.classes = _classes()
        tokens = self.single.tokenizer.get_added_tokens_decoder().values() if added else []
        literals = [regex.escape(t.content) for t in tokens]
        # these texts are encoded one by one: literals of added tokens, and white space that is none to the tokenizer
        self.apart = "" if self.single.normalized else "|".join(["[\x1c-\x1f]", *literals])

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        code = left << 20 | right
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.rank_order[at], NONE)

    def _merge(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Merge rows of equal length to the end: (row, number of ids, ids by number) of all rows."""
        rows, done = np.arange(len(ids)), []
        ranks = self._ranks(ids[:, :-1], ids[:, 1:])
        while True:
            width = ids.shape[1]
            if width == 1:
                done.append((rows, ids))
                break
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(rows)), at]
            go = least < NONE
            if not go.all():
                done.append((rows[~go], ids[~go]))
                rows, ids, ranks, at, least = rows[go], ids[go], ranks[go], at[go], least[go]
            if not len(rows):
                break
            one = np.arange(len(rows))
            ids[one, at] = self.made[least]
            # what lies behind the merged pair moves up
            take = np.arange(width - 1) + (np.arange(width - 1) > at[:, None])
            ids = np.take_along_axis(ids, take, 1)
            if width == 2:
                continue
            ranks = np.take_along_axis(ranks, take[:, :-1] + (take[:, :-1] == at[:, None]), 1)
            for side in (-1, 0):
                pair = at + side
                ok = (pair >= 0) & (pair < width - 2)
                i, j = one[ok], pair[ok]
                ranks[i, j] = self._ranks(ids[i, j], ids[i, j + 1])
        return done

    def _pieces(self, content: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces given as bytes, and their bounds."""
        sizes = bounds[1:] - bounds[:-1]
        symbols = self.inner[content]
        symbols[bounds[1:] - 1] = self.last[content[bounds[1:] - 1]]
        found = []
        counts = np.zeros(len(sizes), np.int64)
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            if size <= LONGEST:
                for row, ids in self._merge(symbols[bounds[rows][:, None] + np.arange(size)]):
                    found.append((rows[row], ids))
            else:
                for row in rows:
                    mapped = "".join(map(self.single.letters.__getitem__, content[bounds[row] : bounds[row + 1]].tolist()))
                    ids = np.array([[t.id for t in self.single.model.tokenize(mapped)]], np.int64)
                    found.append((np.array([row]), ids))
        for rows, ids in found:
            counts[rows] = ids.shape[1]
        out = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])
        flat = np.empty(out[-1], np.uint32)
        for rows, ids in found:
            flat[out[rows][:, None] + np.arange(ids.shape[1])] = ids
        return flat, out

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words without white space, and their bounds."""
        joined = " ".join(words)
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        odd = np.flatnonzero(points >= PLAIN)
        if len(odd):
            number = np.cumsum(points == 32)
            normalize = self.single.tokenizer.normalizer.normalize_str
            changed = {int(i): normalize(words[i]) for i in np.unique(number[odd])}
            lowered = " ".join("" if i in changed else w for i, w in enumerate(words)).lower().split(" ")
            for i, word in changed.items():
                lowered[i] = word
            joined = " ".join(lowered)
        else:
            joined = joined.lower()
        points = np.frombuffer(f"{joined} \0\0\0".encode("utf-32-le"), "<u4")  # what lies behind ends every look ahead
        kind = self.classes[points]
        kind[-3:] = SPACE
        begins = kind != SPACE
        begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        quote = np.flatnonzero(begins & (points == 39))
        if len(quote):
            a, b = points[quote + 1], points[quote + 2]
            one = np.isin(a, [ord(c) for c in "stmd"])
            two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
            begins[quote[one | two] + 1] = False
            for ends in (quote[one] + 2, quote[two] + 3):
                begins[ends] |= kind[ends] == LETTER
        points, kind, begins = points[:-3], kind[:-3], begins[:-3]
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        inside = kind != SPACE
        place = np.cumsum(np.where(inside, width, 0)) - np.where(inside, width, 0)  # among the bytes of pieces
        content = np.frombuffer(f"{joined} ".encode(), np.uint8)
        content = np.ascontiguousarray(content[np.repeat(inside, width)])
        starts = np.flatnonzero(begins)
        bounds = np.append(place[starts], len(content)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(content)])
        distinct = pieces.dictionary_encode()
        dictionary = distinct.dictionary
        offsets = np.frombuffer(dictionary.buffers()[1], np.int32)[: len(dictionary) + 1].astype(np.int64)
        held = np.frombuffer(dictionary.buffers()[2] or b"", np.uint8)
        flat, of_piece = self._pieces(held, offsets) if len(dictionary) else (np.zeros(0, np.uint32), np.zeros(1, np.int64))
        ids, of_use = _gather(flat, of_piece, distinct.indices.to_numpy())
        # a word ends with its separator, so it has the pieces that begin before that
        ends = np.searchsorted(starts, np.flatnonzero(points == 32))
        return ids, of_use[np.append(0, ends)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one behind the other, and where each text's begin and end; null is the empty text."""
        texts = pc.fill_null(texts, "")
        apart = pc.match_substring_regex(texts, self.apart).to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(apart)
        if len(rows):
            single = [np.frombuffer(self.single.encode(texts[i].as_py()), "<u4") for i in rows.tolist()]
            texts = pc.if_else(pa.array(apart), "", texts)
        split = pc.utf8_split_whitespace(texts)
        encoded = split.flatten().dictionary_encode()
        ids, of_word = self._words(encoded.dictionary.to_pylist())
        sizes = pc.list_value_length(split).to_numpy()
        first = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        out, of_use = _gather(ids, of_word, encoded.indices.to_numpy())
        bounds = of_use[first]
        if not len(rows):
            return out, bounds
        places = dict(zip(rows.tolist(), single))
        parts = [places.get(i, out[bounds[i] : bounds[i + 1]]) for i in range(len(texts))]
        return np.concatenate(parts), np.concatenate([np.zeros(1, np.int64), np.cumsum([len(p) for p in parts])])


def slices(column: pa.Array, at_most: int = 8_000_000, rows: int = 4096):
    """(first row, rows) of pieces of a text column with about ``at_most`` bytes, or one row."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and (total + size > at_most or i - start >= rows):
            yield start, i - start
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes) - start
