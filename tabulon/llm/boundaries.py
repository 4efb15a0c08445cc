"""A compressed set of positions with select, after the manner of Roaring bitmaps.

Positions are split into spans of 65,536. Each span with members is one container,
in whichever of three forms is smallest: a sorted array of 16-bit members, a bitmap of
65,536 bits, or runs of consecutive members. The set keeps the cumulative
cardinalities of its containers, and a bitmap or run container those of its words or
runs. ``select`` finds the container of a rank by binary search and the member
inside it by a local select.
"""

from __future__ import annotations

import numpy as np

SPAN = 1 << 16
#: Bytes of a bitmap of one span, and of its words' 64 bits.
BITMAP_BYTES, WORD = SPAN // 8, 64


class ArrayContainer:
    """Members as sorted 16-bit numbers: two bytes a member."""

    def __init__(self, members: np.ndarray):
        self.members = members.astype(np.uint16)

    def select(self, rank: int) -> int:
        return int(self.members[rank])


class BitmapContainer:
    """One bit per position, and the number of members before each word."""

    def __init__(self, members: np.ndarray):
        bits = np.zeros(SPAN, np.uint8)
        bits[members] = 1
        self.words = np.packbits(bits, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int32)[:-1]])

    def select(self, rank: int) -> int:
        word = int(np.searchsorted(self.before, rank, "right")) - 1
        ones = np.flatnonzero(np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little"))
        return word * WORD + int(ones[rank - self.before[word]])


class RunContainer:
    """First members of the runs, and the number of members before each run."""

    def __init__(self, members: np.ndarray, starts: np.ndarray):
        self.starts = members[starts].astype(np.uint16)
        self.before = starts.astype(np.int32)

    def select(self, rank: int) -> int:
        run = int(np.searchsorted(self.before, rank, "right")) - 1
        return int(self.starts[run]) + rank - int(self.before[run])


def container(members: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest form for the sorted members (0 to 65,535) of one span."""
    starts = np.flatnonzero(np.diff(members, prepend=-2) != 1)
    in_runs, in_array = 4 * len(starts), 2 * len(members)
    if in_runs < min(in_array, BITMAP_BYTES):
        return RunContainer(members, starts)
    return ArrayContainer(members) if in_array <= BITMAP_BYTES else BitmapContainer(members)


class PositionSet:
    """Containers in the order of their spans, with cumulative cardinalities."""

    def __init__(self):
        self.spans: list[int] = []
        self.containers: list[ArrayContainer | BitmapContainer | RunContainer] = []
        self.upto: list[int] = []

    def __len__(self) -> int:
        return self.upto[-1] if self.upto else 0

    def append(self, span: int, members: np.ndarray) -> None:
        """Add the members of a span behind all earlier ones; a span without members takes no container."""
        if len(members):
            self.spans.append(span)
            self.containers.append(container(members))
            self.upto.append(len(self) + len(members))

    def select(self, rank: int) -> int:
        """The member with ``rank`` smaller ones."""
        if not 0 <= rank < len(self):
            raise IndexError(f"rank {rank} in a set of {len(self)}")
        k = int(np.searchsorted(self.upto, rank, "right"))
        return self.spans[k] * SPAN + self.containers[k].select(rank - (self.upto[k - 1] if k else 0))


def unit_boundaries(text: str) -> PositionSet:
    """Where the units ``[A-Za-z]+|[^A-Za-z]`` of a text begin, and the end of the text, in code points.

    A text of n units has n + 1 boundaries; the unit k lies between those of rank k
    and k + 1. The text is read a span at a time, so beside it only the
    containers grow with its length.
    """
    found = PositionSet()
    inside = False  # whether the code point before the span is a letter
    for start in range(0, len(text) + 1, SPAN):
        codes = np.frombuffer(text[start : start + SPAN].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = np.concatenate([[inside], ((codes | 32) - np.uint32(ord("a"))) < 26])
        begins = ~(letter[1:] & letter[:-1])
        inside = bool(letter[-1])
        if len(codes) < SPAN:  # the end of the text lies in this span
            begins = np.append(begins, True)
        found.append(start // SPAN, np.flatnonzero(begins))
    return found
