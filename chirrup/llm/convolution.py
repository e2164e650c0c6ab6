"""Where rows of whole numbers occur without a mismatch in longer rows, by number-theoretic transforms of many rows at once."""

import math
from functools import cache

import numpy as np

# Primes with large powers of two in p - 1, and a primitive root of each.
PRIMES = ((2013265921, 31), (1811939329, 13), (998244353, 3), (469762049, 3), (167772161, 3))

# Rows are transformed in groups of about so many numbers.
GROUP = 1 << 19


def _mod(x: np.ndarray, p: int) -> np.ndarray:
    return x - x // np.uint64(p) * np.uint64(p)


@cache
def _powers(p: int, root: int, size: int, inverse: bool) -> np.ndarray:
    """The powers of a root of unity of the order `size`, up to half of it."""
    step = pow(root, (p - 1) // size, p)
    step = pow(step, p - 2, p) if inverse else step
    out = np.ones(size // 2, np.uint64)
    done = 1
    while done < len(out):  # doubles the known powers
        out[done : 2 * done] = _mod(out[:done] * np.uint64(pow(step, done, p)), p)[: len(out) - done]
        done *= 2
    return out


def transformed(rows: np.ndarray, p: int, root: int) -> np.ndarray:
    """The transform of each row, in bit-reversed order; rows of a power of two of numbers below p."""
    n, size = rows.shape
    out, half, prime = rows.astype(np.uint64), size // 2, np.uint64(p)
    while half:
        pair = out.reshape(n, -1, 2, half)
        a, b = pair[:, :, 0].copy(), pair[:, :, 1]
        total = a + b
        pair[:, :, 0] = np.where(total >= prime, total - prime, total)
        pair[:, :, 1] = _mod((a + prime - b) * _powers(p, root, 2 * half, False), p)
        half //= 2
    return out


def restored(rows: np.ndarray, p: int, root: int) -> np.ndarray:
    """The rows of which these are the transforms, in place."""
    n, size = rows.shape
    half, prime = 1, np.uint64(p)
    while half < size:
        pair = rows.reshape(n, -1, 2, half)
        a, b = pair[:, :, 0].copy(), _mod(pair[:, :, 1] * _powers(p, root, 2 * half, True), p)
        total, rest = a + b, a + prime - b
        pair[:, :, 0] = np.where(total >= prime, total - prime, total)
        pair[:, :, 1] = np.where(rest >= prime, rest - prime, rest)
        half *= 2
    return _mod(rows * np.uint64(pow(size, p - 2, p)), p)


def _squared_differences(blocks: np.ndarray, windows: np.ndarray, p: int, root: int) -> np.ndarray:
    """Modulo p, the sum of squared differences between each block and each place of its window."""
    size, (n, width) = blocks.shape[1], windows.shape
    place = -np.arange(size) % width  # a block read backwards turns the product of transforms into a correlation
    turned = np.zeros((n, width), np.uint64)
    blocks, windows = _mod(blocks.astype(np.uint64), p), _mod(windows.astype(np.uint64), p)
    turned[:, place] = blocks
    product = _mod(transformed(turned, p, root) * transformed(windows, p, root), p)
    cross = restored(product, p, root)[:, : width - size + 1]
    squares = np.zeros((n, width + 1), np.uint64)
    np.cumsum(_mod(windows * windows, p), axis=1, out=squares[:, 1:])
    own = _mod(blocks * blocks, p).sum(1, keepdims=True)
    return _mod(own + squares[:, size:] - squares[:, : width - size + 1] + np.uint64(2) * (np.uint64(p) - cross), p)


def occurrences(values: np.ndarray, starts: np.ndarray, size: int, shift: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of `size` numbers at `starts` and their places in windows of `width` numbers that begin `shift` later.

    Gives pairs of a block's number and a place, where all numbers are equal. `values` are whole numbers from 0; places
    past their end hold a number that no block has. `width` is a power of two. The sum of squared differences is zero where all are equal, and it is below `size` times the largest square. So
    it is tested modulo as many primes as exceed that together, each on the pairs that the last one left.
    """
    top = int(values.max()) + 1
    padded = np.append(values, np.full(shift + width + size, top, values.dtype))
    found, places, product = [], [], 1
    for a in range(0, len(starts), max(GROUP // width, 1)):
        own = starts[a : a + max(GROUP // width, 1)]
        zero = _squared_differences(padded[own[:, None] + np.arange(size)], padded[own[:, None] + shift + np.arange(width)], *PRIMES[0]) == 0
        block, place = np.nonzero(zero)
        found.append(block + a)
        places.append(place)
    block, place = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (found, places))
    for k, (p, _) in enumerate(PRIMES):
        product *= p
        if product > size * top**2 or not len(block):
            return block, place
        p, root = PRIMES[k + 1]
        left, row = np.unique(block, return_inverse=True)
        held = np.zeros(len(block), bool)
        for a in range(0, len(left), max(GROUP // width, 1)):
            own = starts[left[a : a + max(GROUP // width, 1)]]
            sums = _squared_differences(padded[own[:, None] + np.arange(size)], padded[own[:, None] + shift + np.arange(width)], p, root)
            here = (row >= a) & (row < a + len(own))
            held[here] = sums[row[here] - a, place[here]] == 0
        block, place = block[held], place[held]
    raise ValueError(f"{math.log2(size * top**2):.0f} bits of squared differences are beyond the primes")
