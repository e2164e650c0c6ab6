"""Terms of whole batches of texts: runs of ASCII letters and digits and of all other characters beyond ASCII."""

import numpy as np
import pyarrow as pa

from chirrup.llm.pretokens import chunks, text_buffers
from chirrup.llm.words import LOWER, coded_words

# The bytes of a term, as of the character class `[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]` in UTF-8.
SOLID = np.zeros(256, bool)
SOLID[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def coded_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.BinaryArray, np.ndarray]:
    """Codes of the terms with A-Z lower-cased, the distinct terms, and the first term of each text.

    `offsets` starts at 0 and ends at the length of `data`.
    """
    data = LOWER[data]
    solid = SOLID[data]
    opens = np.zeros(len(data) + 1, bool)
    opens[offsets] = True
    begin, end = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1] | opens[1:-1]
    end[:-1] &= ~solid[1:] | opens[1:-1]
    begins = np.flatnonzero(begin)
    codes, terms = coded_words(data, begins, np.flatnonzero(end) + 1)
    return codes, terms, np.searchsorted(begins, offsets)


def text_chunks(column: pa.Array, size: int):
    """Bytes and offsets of runs of texts of about `size` bytes, with the number of the first text."""
    offsets, data = text_buffers(column)
    for a, b in chunks(offsets, size):
        yield a, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
