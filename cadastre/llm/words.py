"""Words of many texts at once, as Arrow arrays, without a Python object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def byte_table(breaks: bytes) -> np.ndarray:
    """Per byte value whether it belongs to a word."""
    table = np.ones(256, bool)
    table[list(breaks)] = False
    return table


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, first byte of each text and the end) of a string array; a null text is empty."""
    texts = texts.fill_null("").cast(pa.large_binary())
    _, places, data = texts.buffers()
    at = np.frombuffer(places, "i8")[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, "u1") if data is not None else np.zeros(0, "u1")
    return whole[at[0] : at[-1]], at - at[0]


def split(data: np.ndarray, of_word: np.ndarray, begins: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(words, first byte of each): runs of bytes that ``of_word`` marks, cut at the places ``begins``."""
    inside = of_word[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[0] = True
    fresh[begins] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | fresh[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | fresh[1:-1]
    low, high = np.flatnonzero(first), np.flatnonzero(last)
    places = np.zeros(len(low) + 1, "i8")
    np.cumsum(high - low + 1, out=places[1:])
    buffers = [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data[inside]))]
    return pa.Array.from_buffers(pa.large_binary(), len(low), buffers), low
