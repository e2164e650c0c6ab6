"""Byte-level pre-tokens of whole batches of texts, and their ids.

The pattern `public_tokenizers.PATTERN` cuts a text where the class of its characters changes. That is decided for a
whole Arrow batch at once with array operations, so each distinct pre-token of a batch reaches the tokenizer library
once. A text with a code point that the installed Unicode tables do not know goes to the library as a whole, because
libraries with other tables may class it otherwise.
"""

import base64
import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Tokenizer

LETTER, NUMBER, SPACE, OTHER, UNKNOWN, UNSEEN = range(6)

# The white space of the Unicode property White_Space.
WHITE_SPACE = {0x85, 0xA0, 0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0x20, *range(0x09, 0x0E), *range(0x2000, 0x200B)}

# The endings that the pattern cuts off as tokens of their own.
ONE_LETTER_ENDINGS = b"stmd"
TWO_LETTER_ENDINGS = (b"re", b"ve", b"ll")

# Texts are worked on in pieces of about this size, which bounds the memory of a task.
CHUNK_BYTES = 4 << 20

_classes = np.full(0x110000, UNSEEN, np.uint8)


def _class(code: int) -> int:
    if code in WHITE_SPACE:
        return SPACE
    category = unicodedata.category(chr(code))
    if category == "Cn":
        return UNKNOWN
    return {"L": LETTER, "N": NUMBER}.get(category[0], OTHER)


def _classes_of(codes: np.ndarray) -> np.ndarray:
    found = _classes[codes]
    if len(found) and found.max() == UNSEEN:
        for code in np.unique(codes[found == UNSEEN]):
            _classes[code] = _class(int(code))
        found = _classes[codes]
    return found


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32) if column.buffers()[1] else np.zeros(1, np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `size` bytes; a longer text is a range of its own."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = max(first + 1, last)
        yield first, last
        first = last


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions and values of the code points of UTF-8 bytes."""
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead).astype(np.int32)
    codes = data[at].astype(np.int32)
    high = np.flatnonzero(codes >= 0xC0)
    if len(high):
        tail = np.concatenate([data, np.zeros(3, np.uint8)]) & 0x3F
        first, place = codes[high], at[high]
        value = first & np.where(first < 0xE0, 0x1F, np.where(first < 0xF0, 0x0F, 0x07))
        for k, least in ((1, 0xC0), (2, 0xE0), (3, 0xF0)):
            value = np.where(first >= least, (value << 6) | tail[place + k], value)
        codes[high] = np.minimum(value, 0x10FFFF)
    return at, codes


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte offsets of the pre-tokens of texts, the first pre-token of each text, and which texts hold unknown code points.

    `offsets` starts at 0 and ends at the length of `data`.
    """
    n_texts = len(offsets) - 1
    if not len(data):
        return np.zeros(1, np.int64), np.zeros(n_texts + 1, np.int64), np.zeros(n_texts, bool)
    at, codes = code_points(data)
    kinds = _classes_of(codes)
    n = len(at)
    opens = np.zeros(n + 1, bool)  # the first character of a text, and the end
    opens[np.searchsorted(at, offsets[offsets < len(data)])] = True
    opens[n] = True
    unknown = np.zeros(n_texts, bool)
    if kinds.max() == UNKNOWN:
        strange = np.flatnonzero(kinds == UNKNOWN)
        unknown[np.searchsorted(offsets, at[strange], "right") - 1] = True
    space, blank = kinds == SPACE, codes == 0x20
    changes = opens[:n].copy()
    changes[1:] |= kinds[1:] != kinds[:-1]
    after_blank = np.zeros(n, bool)
    after_blank[1:] = blank[:-1] & ~opens[1:n]
    before_word = np.zeros(n, bool)  # white space right before another character of the text
    before_word[:-1] = ~space[1:] & ~opens[1:n]
    starts = np.where(space, changes | before_word, changes & ~after_blank)
    quotes = np.flatnonzero((codes == 0x27) & starts)
    if len(quotes):
        tail = np.concatenate([codes, np.zeros(3, codes.dtype)])
        closed = np.concatenate([opens, np.ones(3, bool)])
        one, two = tail[quotes + 1], tail[quotes + 2]
        short = ~closed[quotes + 1] & np.isin(one, list(ONE_LETTER_ENDINGS))
        long = ~closed[quotes + 1] & ~closed[quotes + 2] & np.logical_or.reduce([(one == a) & (two == b) for a, b in TWO_LETTER_ENDINGS])
        for hits, length in ((short, 2), (long & ~short, 3)):
            where = quotes[hits]
            starts[where + 1] = False
            ends = where + length
            ends = ends[ends < n]
            starts[ends] |= kinds[ends] == LETTER
    bounds = np.append(at[starts], len(data))
    return bounds, np.searchsorted(bounds[:-1], offsets), unknown


def as_lists(lengths: np.ndarray, ids: Iterable[int]) -> pa.ListArray:
    ends = np.cumsum(lengths, dtype=np.int32)
    flat = np.fromiter(ids, np.uint32, int(lengths.sum()))
    return pa.ListArray.from_arrays(pa.array(np.append(np.int32(0), ends)), pa.array(flat))


def words_of(data: np.ndarray, bounds: np.ndarray) -> pa.BinaryArray:
    """The pieces between the bounds, without a copy."""
    return pa.Array.from_buffers(
        pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    )


class Bpe:
    """A byte-level BPE tokenizer from the bytes of a rank file or of a `tokenizers` file."""

    def __init__(self, blob: bytes):
        self.special: dict[bytes, int] = {}
        self.library = None
        if blob[:1] == b"{":
            self.library = Tokenizer.from_str(blob.decode())
            ranks = self._json_ranks(json.loads(blob))
        else:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, blob.splitlines()) if a}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        words = [*ranks, *self.special]
        self.vocabulary = pa.array(words, pa.binary())
        self.vocabulary_ids = as_lists(np.ones(len(words), np.int32), chain(ranks.values(), self.special.values()))
        self.n_ids = max([*ranks.values(), *self.special.values()]) + 1

    def _json_ranks(self, spec: dict) -> dict[bytes, int]:
        """The vocabulary as ranks, if its ids follow its merges, as the rank form requires."""
        plain = spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        if spec["normalizer"] or spec["model"]["type"] != "BPE" or not plain:
            raise ValueError("only byte-level BPE without a normalizer is supported")
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in printable]
        byte = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}
        self.special = {x["content"].encode(): x["id"] for x in spec["added_tokens"]}
        vocabulary = spec["model"]["vocab"]
        ids = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        if ids != sorted(ids):
            raise ValueError("the ids do not follow the merges")
        return {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if token.encode() not in self.special}

    def token_bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """Offsets by id and the bytes of all tokens."""
        table = {i: t for t, i in self.encoding._mergeable_ranks.items()} | {i: t for t, i in self.special.items()}
        tokens = [table.get(i, b"") for i in range(self.n_ids)]
        return np.cumsum([0, *map(len, tokens)]), np.frombuffer(b"".join(tokens), np.uint8)

    def whole(self, text: str) -> list[int]:
        """The library's ids of a text."""
        if self.library is not None:
            return self.library.encode(text, add_special_tokens=False).ids
        return self.encoding.encode_ordinary(text)

    def ids_of_words(self, words: pa.BinaryArray) -> pa.ListArray:
        """The ids of each pre-token."""
        piece, special = self.encoding._core_bpe.encode_single_piece, self.special
        found = [piece(word) if word not in special else [special[word]] for word in words.to_pylist()]
        return as_lists(np.fromiter(map(len, found), np.int32, len(found)), chain.from_iterable(found))

    def segments(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The offsets with a cut before and after each special string."""
        raw, more = data.tobytes() if self.special else b"", []
        for string in self.special:
            at = raw.find(string)
            while at >= 0:
                if int(np.searchsorted(offsets, at, "right")) == int(np.searchsorted(offsets, at + len(string) - 1, "right")):
                    more += [at, at + len(string)]
                at = raw.find(string, at + len(string))
        return np.union1d(offsets, more).astype(np.int64) if more else offsets

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As the function `cut`; a special string is one pre-token."""
        segments = self.segments(data, offsets)
        bounds, first, unknown = cut(data, segments)
        if segments is offsets:
            return bounds, first, unknown
        raw = data.tobytes()
        drop = np.zeros(len(bounds), bool)
        for k in range(len(segments) - 1):
            if raw[segments[k] : segments[k + 1]] in self.special:
                drop[first[k] + 1 : first[k + 1]] = True
        bounds = bounds[~drop]
        text = np.searchsorted(offsets, segments[:-1], "right") - 1
        return bounds, np.searchsorted(bounds[:-1], offsets), np.bincount(text, unknown, len(offsets) - 1) > 0


_bpe: dict[bytes, Bpe] = {}


def bpe(blob: bytes) -> Bpe:
    """One tokenizer for each file and worker."""
    key = hashlib.sha256(blob).digest()
    if key not in _bpe:
        _bpe[key] = Bpe(blob)
    return _bpe[key]


def read_blob(path: str) -> bytes:
    """A tokenizer file, a few MB at most, which the driver sends to the executors."""
    with open(path, "rb") as file:
        return file.read()


class Cut(NamedTuple):
    """The pre-tokens of a column: the first of each text, the codes of all, and the distinct ones without those known."""

    data: np.ndarray
    offsets: np.ndarray
    first: np.ndarray
    codes: np.ndarray
    words: pa.BinaryArray
    unknown: np.ndarray

    def text(self, k: int) -> str:
        return self.data[self.offsets[k] : self.offsets[k + 1]].tobytes().decode()


def cut_column(column: pa.Array, tokenizer: Bpe, known: pa.BinaryArray | None = None, size: int = CHUNK_BYTES) -> Cut:
    """Pre-tokens of a whole column; texts are cut in pieces of about `size` bytes, which bound the memory, and coded together.

    The codes of pre-tokens in `known` are their places there; those of the other distinct ones follow.
    """
    offsets, data = text_buffers(column)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    find = tokenizer.cut if tokenizer.special else cut
    bounds, firsts, unknown, seen = [], [np.zeros(1, np.int64)], [np.zeros(0, bool)], 0
    for a, b in chunks(offsets, size):
        own = find(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        bounds.append((own[0][:-1] + offsets[a]).astype(np.int32))
        firsts.append(own[1][1:] + seen)
        unknown.append(own[2])
        seen += len(own[0]) - 1
    words = words_of(data, np.concatenate([*bounds, [len(data)]]))
    if known is None:
        coded = words.dictionary_encode()
        codes, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    else:
        place = pc.index_in(words, value_set=known)
        coded = words.filter(place.is_null()).dictionary_encode()
        codes, words = place.fill_null(-1).to_numpy(zero_copy_only=False).copy(), coded.dictionary
        codes[codes < 0] = coded.indices.to_numpy(zero_copy_only=False) + len(known)
    return Cut(data, offsets, np.concatenate(firsts), codes, words, np.concatenate(unknown))


def encode_column(column: pa.Array, tokenizer: Bpe) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For ranges of texts: first and last text, their numbers of ids, and all their ids in order."""
    found = cut_column(column, tokenizer, tokenizer.vocabulary)
    lists = pa.concat_arrays([tokenizer.vocabulary_ids, tokenizer.ids_of_words(found.words)])
    lengths = np.diff(lists.offsets.to_numpy())
    for a, b in chunks(found.offsets):
        codes = found.codes[found.first[a] : found.first[b]]
        before = np.append(0, np.cumsum(lengths[codes], dtype=np.int64))
        counts = np.diff(before[found.first[a : b + 1] - found.first[a]])
        ids = lists.take(pa.array(codes)).flatten().to_numpy()
        if found.unknown[a:b].any():
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for k in np.flatnonzero(found.unknown[a:b]):
                parts[k] = np.asarray(tokenizer.whole(found.text(a + k)), np.uint32)
                counts[k] = len(parts[k])
            ids = np.concatenate(parts)
        yield a, b, counts, ids
