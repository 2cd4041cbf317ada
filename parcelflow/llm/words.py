"""Words of many texts at once, as numpy arrays over the bytes of an Arrow string column.

Texts are cut on bytes. Both word rules only ask about single bytes below 0x80, and every byte of a longer UTF-8
character is 0x80 or above, so cutting bytes gives the same words as cutting characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACES = b" \t\n\x0b\x0c\r"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)

#: Bytes of a word under ``[^\x20\x09-\x0D]+``.
SPACED = np.ones(256, bool)
SPACED[list(_SPACES)] = False
#: Bytes of a word under ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
PLAIN = np.zeros(256, bool)
PLAIN[0x30:0x3A] = PLAIN[0x61:0x7B] = PLAIN[0x80:] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mixed(value: np.ndarray) -> np.ndarray:
    """64-bit numbers with all bits stirred."""
    value = value ^ (value >> _HALF)
    value = value * _MIX2
    value ^= value >> _HALF
    value *= _MIX2
    value ^= value >> _HALF
    return value


def paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One 64-bit hash for two in order."""
    return mixed(left * _MIX + right)


def pieces(batch: pa.RecordBatch | pa.StructArray, text: pa.Array, most_bytes: int) -> Iterator[tuple[int, pa.Array]]:
    """Runs of neighbouring rows with about ``most_bytes`` of text at most, as (first row, texts without nulls).

    One longer text makes a run of its own: texts are never cut.
    """
    text = text.cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    first = 0
    while first < len(text):
        last = int(np.searchsorted(ends, ends[first] + most_bytes, "right")) - 1
        last = max(first + 1, min(last, len(text)))
        yield first, text.slice(first, last - first)
        first = last


class Words:
    """Words of some texts: where each begins and ends in ``data``, and the first word of each text.

    ``first`` has one entry more than there are texts; text i has the words ``first[i]`` to ``first[i + 1] - 1``.
    """

    def __init__(self, texts: pa.Array, letters: np.ndarray, lower: bool = False):
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        raw = np.frombuffer(raw, np.uint8)[ends[0] : ends[-1]] if raw is not None else np.zeros(0, np.uint8)
        self.bounds = ends - ends[0]
        self.data = _LOWER[raw] if lower else raw
        inside = letters[self.data]
        begins, ends_here = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends_here[:-1] &= ~inside[1:]
        edges = self.bounds[(self.bounds > 0) & (self.bounds < len(inside))]
        begins[edges] = inside[edges]
        ends_here[edges - 1] = inside[edges - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends_here) + 1
        self.first = np.searchsorted(self.start, self.bounds)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def left(self) -> np.ndarray:
        """How many words of its text begin at each word, itself included."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of the bytes of each word, eight bytes at a time."""
        padded = np.zeros(len(self.data) + 8, np.uint8)
        padded[: len(self.data)] = self.data
        eight = np.ndarray(len(self.data) + 1, "<u8", padded.data, strides=(1,))
        size = self.end - self.start
        out = size.astype(np.uint64)
        which, at, rest = None, self.start, size
        while len(at):
            missing = np.clip(8 - rest, 0, 7).astype(np.uint64) * np.uint64(8)
            value = eight[at] << missing
            if which is None:
                out = paired(out, value)
            else:
                out[which] = paired(out[which], value)
            more = np.flatnonzero(rest > 8)
            which = more if which is None else which[more]
            at, rest = at[more] + 8, rest[more] - 8
        return out


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on; short by ``size - 1`` at the end.

    Doubled from one word up: the last step overlaps. Windows that cross a text's end are the caller's to leave out.
    """
    length = 1
    while length < size:
        step = min(length, size - length)
        if len(hashes) <= step:
            return hashes[:0]
        hashes = paired(hashes[:-step], hashes[step:])
        length += step
    return hashes


def spans_of(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last index of each run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return edge[0::2], edge[1::2]
