"""Token ids of whole texts from a public tokenizer, with a cache of the units between blanks.

Two facts make the cache exact. In both tokenizers no token crosses a blank that
is followed by a character other than white space: the blank starts a new token
(byte level) or is dropped (word level). So a text may be cut there, each distinct
cut piece encoded once with the library, and the ids put together again.
"""

from __future__ import annotations

import os
import re

import numpy as np

END_ID = 2
#: Distinct pieces kept per Python worker (about 300 bytes each) before all but the most frequent half go.
CACHE_UNITS = 1_000_000

#: Words of letters up to here hold no character that the library's splitter could see differently.
LAST_LATIN = "\u024f"

#: Byte-level tokenizers write each byte as one printable letter: printable Latin-1 bytes as
#: themselves, the others as letters from U+0100 on, in order.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LETTERS = {b: chr(0x100 + k) for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}

_BEFORE_WORD = re.compile(r" (?=\S)")
_ODD_BLANK = re.compile(r" (?!\S)")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Numbers(dict):
    """Numbers keys in order of first use and remembers the new ones."""

    def __init__(self, owner: UnitEncoder, lead: str):
        super().__init__()
        self.owner, self.lead = owner, lead

    def __missing__(self, key: str) -> int:
        number = self[key] = self.owner.used
        self.owner.used += 1
        self.owner.pending.append(self.lead + key)
        return number


class UnitEncoder:
    """``encode(texts)`` gives the ids that the library gives for each whole text.

    ``keeps_blanks``: a blank belongs to the token after it (byte level); else
    blanks and line ends only separate (word level).
    """

    def __init__(self, path: str, keeps_blanks: bool, cache_units: int = CACHE_UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keeps_blanks, self.cache_units = keeps_blanks, cache_units
        self.tails = {x: self.tokenizer.encode(x, add_special_tokens=False).ids for x in ",."}
        self.used, self.pending = 0, []
        self.later = _Numbers(self, " " if keeps_blanks else "")
        self.first = _Numbers(self, "") if keeps_blanks else self.later
        self.pool = np.empty(0, np.uint32)
        self.starts = np.zeros(1, np.int64)
        self.uses = np.zeros(0, np.int64)

    def _shrink(self) -> None:
        """Keep the pieces that were used most and more than once; their use counts half from then on."""
        most = np.argsort(-self.uses, kind="stable")[: self.cache_units // 2]
        kept = np.sort(most[self.uses[most] > 1])
        numbers = np.full(self.used, -1)
        numbers[kept] = np.arange(len(kept))
        places = numbers.tolist()
        for names in (self.later, self.first) if self.keeps_blanks else (self.later,):
            left = [(key, places[n]) for key, n in names.items() if places[n] >= 0]
            names.clear()
            names.update(left)
        self.pool, lengths = self._ids_of(kept)
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        self.uses = self.uses[kept] >> 1
        self.used = len(kept)

    def _ids_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of numbered pieces one after the other, and the number of ids of each."""
        begin = self.starts[numbers]
        length = self.starts[numbers + 1] - begin
        reached = np.cumsum(length)
        source = np.repeat(begin - reached + length, length)
        source += np.arange(len(source))
        return self.pool[source], length

    def _plain_ids(self, unit: str) -> list[int] | None:
        """Ids of a Latin word, perhaps with a blank before and a comma or full stop after it.

        The library's pre-tokenizer leaves such a word whole, so its model alone
        is asked; that spares the building of offsets. None for other units.
        """
        word = unit[1:] if unit[:1] == " " else unit
        tail = word[-1:] if word[-1:] in (",", ".") else ""
        if tail:
            word = word[:-1]
        if not word.isalpha():
            return None
        if word.isascii():
            text = "Ġ" + word if unit[0] == " " else word if self.keeps_blanks else word.lower()
        elif self.keeps_blanks and max(word) <= LAST_LATIN:
            text = unit[: len(unit) - len(tail)].encode().decode("latin-1").translate(_BYTE_LETTERS)
        else:
            return None  # normal forms and lower case are left to the library
        if tail and (unit[0] == " ") == self.keeps_blanks:
            known = self.later.get(word, self.used)
            if known < len(self.starts) - 1:  # its ids are there already
                return self.pool[self.starts[known] : self.starts[known + 1]].tolist() + self.tails[tail]
        ids = [t.id for t in self.tokenizer.model.tokenize(text)]
        return ids + self.tails[tail] if tail else ids

    def _flush(self) -> None:
        """Encode the new pieces. Their ids go to two flat lists: a list per piece would keep Python's garbage collector busy."""
        plain, odd, lengths, rest = [], [], [], []
        plain_ids = self._plain_ids
        for k, unit in enumerate(self.pending):
            ids = plain_ids(unit)
            if ids is None:
                rest.append(k)
                lengths.append(0)
            else:
                plain += ids
                lengths.append(len(ids))
        for at in range(0, len(rest), 20_000):
            some = rest[at : at + 20_000]
            coded = self.tokenizer.encode_batch_fast([self.pending[k] for k in some], add_special_tokens=False)
            for k, one in zip(some, coded):
                ids = one.ids
                odd += ids
                lengths[k] = len(ids)
        self.pending = []
        counts = np.array(lengths, np.int64)
        by_library = np.zeros(len(counts), bool)
        by_library[rest] = True
        from_library = np.repeat(by_library, counts)
        fresh = np.empty(len(from_library), np.uint32)
        fresh[from_library] = odd
        fresh[~from_library] = plain
        self.pool = np.concatenate([self.pool, fresh])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])

    def _units(self, text: str) -> np.ndarray:
        if self.keeps_blanks:
            parts = text.split(" ") if _ODD_BLANK.search(text) is None else _BEFORE_WORD.split(text)
            head = self.first[parts.pop(0)]
        else:
            parts = text.replace("\n", " ").split(" ")
            head = self.later[parts.pop(0)]
        numbers = np.empty(len(parts) + 1, np.int32)
        numbers[0] = head
        numbers[1:] = np.fromiter(map(self.later.__getitem__, parts), np.int32, len(parts))
        return numbers

    def encode(self, texts: list[str | None], end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each text.

        ``end_id`` is appended to each text's ids. Null counts as the empty text.
        """
        if self.used > self.cache_units:
            self._shrink()
        numbers, sizes = [], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            found = self._units(text or "")
            sizes[k] = len(found)
            numbers.append(found)
        if self.pending:
            self._flush()
        flat = np.concatenate(numbers) if numbers else np.empty(0, np.int32)
        uses = np.bincount(flat, minlength=self.used)
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        ids, length = self._ids_of(flat)
        reached = np.concatenate([[0], np.cumsum(length)])
        units = np.concatenate([[0], np.cumsum(sizes)])
        counts = reached[units[1:]] - reached[units[:-1]]
        if end_id is None:
            return ids, counts
        return np.insert(ids, np.cumsum(counts), end_id).astype(np.uint32, copy=False), counts + 1


_ENCODERS: dict[tuple[str, bool, int], UnitEncoder] = {}


def encoder(path: str, keeps_blanks: bool, cache_units: int = CACHE_UNITS) -> UnitEncoder:
    """The encoder of this Python worker; later tasks of the worker find its cache filled."""
    key = (path, keeps_blanks, cache_units)
    if key not in _ENCODERS:
        _ENCODERS[key] = UnitEncoder(*key)
    return _ENCODERS[key]
