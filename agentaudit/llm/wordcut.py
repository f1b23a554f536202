"""Texts cut at word starts, each distinct word listed once, all in flat arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = 0x20
#: UTF-8 forms of the white-space characters beyond ASCII, two and three bytes long.
WIDE2 = tuple(int.from_bytes(chr(c).encode()) for c in (0x85, 0xA0))
WIDE3 = tuple(int.from_bytes(chr(c).encode())
              for c in (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary array, and where each value starts (with the end)."""
    wide = texts.cast(pa.large_binary())
    offsets = np.frombuffer(wide.buffers()[1], "<i8")[wide.offset:wide.offset + len(wide) + 1]
    data = np.frombuffer(wide.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def from_offsets(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The string or binary array with these bytes and starts (with the end)."""
    wide = {pa.string(): pa.large_string(), pa.binary(): pa.large_binary()}[kind]
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, "<i8")), pa.py_buffer(data)]
    return pa.Array.from_buffers(wide, len(offsets) - 1, buffers).cast(kind)


def prefixed(texts: pa.Array) -> pa.Array:
    """A space before every text; null and empty texts are empty."""
    texts = pc.fill_null(texts, "")
    return pc.if_else(pc.greater(pc.binary_length(texts), 0), pc.binary_join_element_wise(" ", texts, ""), "")


def after_other(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of the places ``at`` of spaces those that follow another byte than a space."""
    return at[data[at - 1] != SPACE]


def blank(data: np.ndarray, at: np.ndarray, before: bool) -> np.ndarray:
    """Whether the character before (or after) the places ``at`` is white space or a control."""
    step = -1 if before else 1
    near = lambda k: data[np.clip(at + step * k, 0, len(data) - 1)].astype(np.int64)
    one = near(1)
    two = (near(2) << 8 | one) if before else (one << 8 | near(2))
    three = (near(3) << 16 | two) if before else (two << 8 | near(3))
    return (one <= SPACE) | (one == 0x7F) | np.isin(two, WIDE2) | np.isin(three, WIDE3)


def between_words(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of the places ``at`` of spaces the single ones: no white space on either side."""
    at = at[at + 1 < len(data)]
    return at[~blank(data, at, True) & ~blank(data, at, False)]


def cut(texts: pa.Array, rule) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of all ``texts``, the number of each word in order, and words per text.

    A word starts where a text starts and at the spaces ``rule`` picks; words joined are the
    text again. An empty text has no word.
    """
    data, offsets = flat_bytes(texts)
    starts = np.zeros(len(data) + 1, bool)
    spaces = np.flatnonzero(data[1:] == SPACE) + 1
    starts[rule(data, spaces)] = True
    starts[offsets] = True
    edges = np.flatnonzero(starts)
    if len(data) == 0:
        return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    coded = from_offsets(data, edges, pa.string()).dictionary_encode()
    return coded.dictionary, np.asarray(coded.indices, dtype=np.int64), np.diff(np.searchsorted(edges, offsets))
