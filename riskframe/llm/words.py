"""Words and word n-grams of whole Arrow batches as 64-bit hashes, without a Python loop over words.

Texts arrive as Arrow string arrays; their UTF-8 buffers are viewed as one
byte array and cut into words by numpy.  A word's hash is a polynomial over
random byte codes, so equal words have equal hashes in every task.
"""

from __future__ import annotations

import ctypes
import ctypes.util
import gc
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark import SparkContext

SLICE_BYTES = 1 << 20  # working arrays are a few times 8 bytes per text byte: keep a slice near 1 MB of text

_rng = np.random.Generator(np.random.PCG64(20240607))
_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_GRAM = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones(1, np.uint64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_WORD = np.zeros(256, bool)  # every ASCII byte but letters and digits
NOT_WORD[:128] = [not chr(b).isalnum() for b in range(128)]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


_libc = ctypes.CDLL(ctypes.util.find_library("c")) if ctypes.util.find_library("c") else None
if not hasattr(_libc, "malloc_trim"):
    _libc = None


class Words(NamedTuple):
    hashes: np.ndarray  # uint64, one per word, in text order
    first: np.ndarray  # int64, documents + 1: words of document d are first[d]:first[d + 1]


def release() -> None:
    """Give freed memory back to the system: Python workers outlive their tasks, and later stages need the room."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def tidy() -> None:
    """For the driver between the phases of a long job: drop handles of plans and tables that are done with (Spark
    keeps what they stand for until its JVM has collected its garbage too), and give the memory of both back."""
    gc.collect()
    release()
    context = SparkContext._active_spark_context
    if context is not None:
        context._jvm.System.gc()
        trim_jvm(context)


def trim_jvm(context: SparkContext) -> bool:
    """Give back what the driver's JVM holds beside its heap: what its compilers and threads have freed stays with the C
    library until that is told.  False if the JVM has no command for it."""
    jvm, args = context._jvm, context._gateway.new_array(context._jvm.Object, 4)  # without arguments of its own
    args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    try:  # by reflection: the class of the server isn't open to Python
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        invoke.invoke(server, args)
    except Py4JError:
        return False
    return True


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(max(n, 256), _BASE, np.uint64))])
    return _powers


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets into them) for runs of rows of about ``size`` bytes; null is empty."""
    column = column.fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
        yield a, b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def word_bounds(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every run of true entries, and the first run of each row (rows + 1 entries)."""
    edge = np.zeros(len(inside) + 1, bool)  # a word may not run over a row's end
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def places(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of ``lengths`` entries from ``starts``: (place of each entry, its number in its run)."""
    number = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.repeat(starts, lengths) + number, number


def split_words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> Words:
    """Hashes of the words of each row, A-Z lower-cased."""
    starts, ends, first = word_bounds(~separator[data], offsets)
    if not len(starts):
        return Words(np.zeros(0, np.uint64), first)
    lengths = ends - starts
    place, number = places(starts, lengths)
    codes = _CODE[LOWER[data[place]]] * powers(int(lengths.max()))[number]
    sums = np.add.reduceat(codes, np.cumsum(lengths) - lengths)
    return Words(mix(sums + lengths.astype(np.uint64)), first)


def grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the k words from each place, place) for all places whose k words are in one row."""
    n = len(words.hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += words.hashes[j:j + n] * _GRAM[j]
    row = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    place = np.flatnonzero(row[:n] == row[k - 1:])
    return mix(total[place] + np.uint64(k)), place


def whole(words: Words, row: int) -> np.uint64:
    """Hash of a whole row of at most 64 words: that of ``grams`` for as many words."""
    h = words.hashes[words.first[row]:words.first[row + 1]]
    return mix((h * _GRAM[:len(h)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(h)))[0]
