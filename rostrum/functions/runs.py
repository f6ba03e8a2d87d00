"""Runs of bytes of texts, in numpy over the buffers of Arrow batches.

A run of up to ``LONGEST`` bytes is one 64-bit number: its bytes from the highest place on, then 0xFF, which no UTF-8 text
holds, so that runs of different lengths have different numbers.  In UTF-8 a text holds another one if and only if its
bytes do.  Work is linear in the bytes; buffers are read in steps of ``STEP`` places.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

LONGEST = 8
STEP = 1 << 17
#: Slots of a filter of runs: it only says which runs can't be wanted.
SLOTS = 1 << 20


def number(piece: Column) -> Column:
    """The number of a run of at most ``LONGEST`` bytes."""
    return F.conv(F.rpad(F.hex(piece), 2 * LONGEST, "F"), 16, -10).cast("bigint")


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an array of binary texts, null as empty, and where each text begins and the last one ends."""
    texts = pc.fill_null(texts, b"")
    _, places, data = texts.buffers()
    wide = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    at = np.frombuffer(places, wide, len(texts) + 1, texts.offset * np.dtype(wide).itemsize).astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    size = int(at[-1] - at[0])
    return np.frombuffer(data, np.uint8, size, int(at[0])) if size else np.empty(0, np.uint8), at - at[0]


def steps(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The numbers of the ``LONGEST`` bytes from each place on, and the first of the places; 0xFF beyond the end."""
    for a in range(0, len(data), STEP):
        part = data[a : a + STEP + LONGEST - 1]
        part = np.r_[part, np.full(min(STEP, len(data) - a) + LONGEST - 1 - len(part), 0xFF, np.uint8)]
        two = (part[:-1].astype(np.uint16) << np.uint16(8)) | part[1:]
        four = (two[:-2].astype(np.uint32) << np.uint32(16)) | two[2:]
        yield a, (four[:-4].astype(np.uint64) << np.uint64(32)) | four[4:]


def cut(numbers: np.ndarray, length: int) -> np.ndarray:
    """The numbers of the first ``length`` bytes of runs."""
    return numbers | np.uint64((1 << 8 * (LONGEST - length)) - 1)


def slots(numbers: np.ndarray, n: int = SLOTS) -> np.ndarray:
    """A slot of ``n``, a power of two, for each number."""
    if n == 1:
        return np.zeros(len(numbers), np.int64)
    return ((numbers * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - n.bit_length())).astype(np.int64)


@F.arrow_udf(T.LongType())
def slot(numbers: pa.Array) -> pa.Array:
    return pa.array(slots(numbers.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)))


def _distinct(owner: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs in order, each once."""
    order = np.lexsort((found, owner))
    owner, found = owner[order], found[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])
    return owner[new], found[new]


def wanted_runs(texts: pa.Array, lengths: list[int], wanted: np.ndarray) -> pa.Array:
    """The distinct numbers of each text's runs of ``lengths`` whose slots are ``wanted``."""
    data, at = joined(texts)
    owners, numbers = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for a, full in steps(data):
        for n in lengths:
            every = cut(full, n)
            met = np.flatnonzero(wanted[slots(every)])
            owner = np.searchsorted(at, met + a, "right") - 1
            inside = met + a + n <= at[owner + 1]
            owner, found = owner[inside], every[met[inside]]
            for held, x in zip((owners, numbers), _distinct(owner, found), strict=True):
                held.append(x)
    owner, found = _distinct(np.concatenate(owners), np.concatenate(numbers))
    ends = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(found.view(np.int64)))
