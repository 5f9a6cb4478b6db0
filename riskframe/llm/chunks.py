"""Token ids of whole Arrow columns of text, each distinct chunk of a slice encoded once.

A chunk is a run of ASCII white space and what follows up to the next such run.
No token and no rule of the tokenizers used here spans the place before a run
of white space, so a text's ids are those of its chunks in order; white space
itself may become tokens.  Where a run follows a character that could be white
space beyond ASCII (the run would then begin earlier), no cut is made.  Chunks
are cut by numpy and numbered by Arrow's dictionary encoding; Python only sees
the distinct ones, and ids are gathered back by numpy.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

from riskframe.llm import words as W

SLICE = 2 << 20  # bytes of text whose chunks are numbered together
_LEADS = np.zeros(256, bool)  # first bytes of three-byte characters among which are white space characters
_LEADS[[0xE1, 0xE2, 0xE3]] = True


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places in ``data`` where chunks begin; every row that isn't empty begins one."""
    space = W.SPACE[data]
    begin = space.copy()
    begin[1:] &= ~space[:-1]
    begin[2:] &= data[:-2] != 0xC2
    begin[3:] &= ~_LEADS[data[:-3]]
    begin[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(begin)


class ChunkEncoder:
    """``learn`` gives (ids, number of ids of each) of an array of distinct chunks."""

    def __init__(self, learn: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], dtype: type, end_id: int, whole: bool = False):
        """``whole``: texts aren't cut into chunks (for tokenizers that the rule above doesn't hold for)."""
        self.learn, self.dtype, self.end_id, self.whole = learn, np.dtype(dtype), end_id, whole

    def rows(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, first of each row (rows + 1)) of UTF-8 texts, each with the end id last."""
        rows = len(offsets) - 1
        places = np.unique(offsets[:-1][np.diff(offsets) > 0]) if self.whole else cuts(data, offsets)
        if not len(places):
            return np.full(rows, self.end_id, self.dtype), np.arange(rows + 1)
        bounds = np.append(places, len(data)).astype(np.int64)
        chunks = pa.Array.from_buffers(pa.large_binary(), len(places), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        flat, size = self.learn(chunks.dictionary)
        flat, kind = flat.astype(self.dtype, copy=False), chunks.indices.to_numpy()
        sizes = size[kind]
        end = np.cumsum(sizes)
        # where the ids of each chunk come from, less where they go to
        shift = ((np.cumsum(size) - size)[kind] - end + sizes).astype(np.int32 if max(len(flat), end[-1]) < 1 << 31 else np.int64)
        place = np.repeat(shift, sizes)
        place += np.arange(len(place), dtype=place.dtype)
        ids = flat[place]
        before = np.concatenate([[0], end])[np.searchsorted(places, offsets)]
        return np.insert(ids, before[1:], self.end_id), before + np.arange(rows + 1)  # with an end id for each row before

    def slices(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, end row, ids, first id of each row) for runs of rows of about a slice of text; null is empty."""
        for a, b, data, offsets in W.slices(column, SLICE):
            yield a, b, *self.rows(data, offsets)


def load(path: str):
    """A tokenizer of its file, on one core: a task has one."""
    from tokenizers import Tokenizer
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


def ids_of(tokenizer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, number of ids of each)."""
    lists = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())), sizes
