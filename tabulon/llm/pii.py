"""Personal data: fixed patterns, and a linear-chain conditional random field for what they miss.

The field labels words by their shape: the class of the word and of its neighbours,
its number of digits and a few marks. It is trained on a small labelled table on the
driver; its few hundred weights go to the tasks. Words are ``[^\\x20\\x09-\\x0D]+``. Only
words with a digit or an @ and the two words on each side of them are decoded, as
one sequence where such stretches meet; all other words are outside by definition.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import by_batch, sub_batches

KINDS = ("email", "ip", "card", "phone")
#: Fixed patterns of the base kinds.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# The same matches in time that grows with the text and not with the square of a word: the part before
# an @ is taken once per @, and numbers with dots are taken once as a whole.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")

LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
_SPACE = " \t\n\x0b\x0c\r"
_MARKED = re.compile(r"[0-9@]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_ENDS = ".,;:!?\"'<>"

#: Shape classes of words, first match counts; after them "letters and digits", "some digits" and "plain".
_SHAPES = [
    re.compile(p)
    for p in (
        r"[^@]+@[^@]+\.[^@]+", r"[^@]*@[^@]*", r"[0-9]{1,3}(\.[0-9]{1,3}){3}", r"[0-9]+(\.[0-9]+)+",
        r"\+[0-9]{1,3}", r"\+[0-9().-]+", r"\([0-9]+\)", r"\(?[0-9]+\)?([-./][0-9]+)+", r"[0-9]{1,2}", r"[0-9]{3,4}",
        r"[0-9]{5,8}", r"[0-9]{9,12}", r"[0-9]{13,19}", r"[0-9]{20,}",
    )
]
_LETTER, _DIGIT = re.compile("[A-Za-z]"), re.compile("[0-9]")
_MIXED, _SOME_DIGIT, _PLAIN = len(_SHAPES), len(_SHAPES) + 1, len(_SHAPES) + 2
_N_SHAPES = _PLAIN + 1
_DIGIT_STEPS = (1, 3, 5, 9, 13, 20)
#: Words, with padding, of the stretches that are decoded in step.
CELLS = 1 << 16
_N_FEATURES = 3 * (_N_SHAPES + 1) + len(_DIGIT_STEPS) + 1 + 3

#: The labelled table: words inside [kind: ...] are of that kind.
EXAMPLES = """
write to [email:jo.lee@mail.example.org] about it
contact [email:a_b+c@sub.host.net], please
mail [email:info@example.com] or call [phone:+1 (212) 555-0101] today
send it to [email:ute.k77@web9.example.de]
phone [phone:+49 30 1234567] is new
call [phone:+44 20 7946 0958] after noon
the number [phone:(415) 555-2671] is hers
ring [phone:555-867-5309] or [phone:555-123-4567] now
tel [phone:(030) 555-9999] im haus
fax [phone:+33 1 55 55 01 02] le soir
mobile [phone:+34 612-555-019] de ella
dial [phone:212-555-0199] tonight
reach him at [phone:(800) 555-0100] soon
from [ip:192.168.0.12] to [ip:10.0.0.7] at once
host [ip:203.0.113.45] was down
l adresse [ip:198.51.100.23] est ici
la red [ip:172.16.254.1] no va
paid with [card:4111 1111 1111 1111] then
card [card:4012-8881-8888-1881] is lost
karte [card:5500005555555559] gesperrt
numero [card:340000000000009] perdu
tarjeta [card:6011 0000 0000 0004] aqui
the card [card:30000000000004] and [card:4222222222222] were used
in 1999 there were 25 of them
version 2.0 of the text
license 4.0. is older than 3.0 or 2.1.3
on 12 may 2020 we met 300 people
pages 10-12 and 1999-2003 in the book
about 1,000 or 20,000 euros and 3.5 percent
room 101, floor 3, house 7
AKIA44QXD7PLMNB2ZQ is a key of 20 letters
password=9f8e7d6c5b4a should be changed
token = "0a1b2c3d4e5f60718293a4b5c6d7e8f901234567" was found
order 123456 came with 12 parts
the year 1850 and the 3rd of june
chapter 4 section 2.1 line 88
at 10:30 or 18:45 on 24.12.2021
see example.com/page7 and item no4
@ home we say hi @all of you
a rate of 7/10 or 50 percent
"""


def _shape(word: str) -> int:
    core = word.strip(_ENDS)
    for k, pattern in enumerate(_SHAPES):
        if pattern.fullmatch(core):
            return k
    if not _DIGIT.search(core):
        return _PLAIN
    return _MIXED if _LETTER.search(core) else _SOME_DIGIT


def _features(words: list[str]) -> np.ndarray:
    """Feature numbers of each word: own, previous and next shape, digits, three marks."""
    shapes = np.array([_N_SHAPES, *map(_shape, words), _N_SHAPES])
    digits = np.searchsorted(_DIGIT_STEPS, [sum(c.isdigit() for c in w) for w in words], "right")
    width = _N_SHAPES + 1
    columns = [shapes[1:-1], width + shapes[:-2], 2 * width + shapes[2:], 3 * width + digits]
    first = 3 * width + len(_DIGIT_STEPS) + 1
    none = _N_FEATURES  # the weight of this one is always zero
    for k, mark in enumerate("=-+"):
        columns.append(np.array([first + k if mark in w else none for w in words]))
    return np.stack(columns, 1)


def labelled(lines: str) -> list[tuple[list[str], list[str]]]:
    """Words and labels of a table in the markup of ``EXAMPLES``."""
    table = []
    for line in lines.strip().splitlines():
        words, labels, kind = [], [], None
        for word in line.split():
            start = re.match(r"\[(\w+):(.*)", word)
            if start:
                kind, word, prefix = start[1], start[2], "B"
            label = f"{prefix}-{kind}" if kind else "O"
            if kind:
                prefix = "I"
                if "]" in word:
                    word, kind = word.replace("]", ""), None
            words.append(word)
            labels.append(label)
        table.append((words, labels))
    return table


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def train(table: list[tuple[list[str], list[str]]], rounds: int = 300, step: float = 0.5, shrink: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights of features and transitions by gradient ascent on the conditional likelihood."""
    n = len(LABELS)
    emit, move = np.zeros((_N_FEATURES + 1, n)), np.zeros((n + 1, n))  # the last row of moves is the start
    data = [(_features(words), np.array([LABELS.index(x) for x in labels])) for words, labels in table]
    for _ in range(rounds):
        d_emit, d_move = -shrink * emit, -shrink * move
        for features, gold in data:
            score = emit[features].sum(1)
            length = len(gold)
            alpha, beta = np.empty((length, n)), np.zeros((length, n))
            alpha[0] = score[0] + move[n]
            for t in range(1, length):
                alpha[t] = score[t] + _logsum(alpha[t - 1][:, None] + move[:n], 0)
            for t in range(length - 2, -1, -1):
                beta[t] = _logsum(move[:n] + score[t + 1] + beta[t + 1], 1)
            total = _logsum(alpha[-1], 0)
            gap = -np.exp(alpha + beta - total)
            gap[np.arange(length), gold] += 1
            for column in features.T:
                np.add.at(d_emit, column, gap / len(data))
            d_move[n] += gap[0] / len(data)
            for t in range(1, length):
                pair = alpha[t - 1][:, None] + move[:n] + score[t] + beta[t] - total
                d_move[:n] -= np.exp(pair) / len(data)
                d_move[gold[t - 1], gold[t]] += 1 / len(data)
        emit += step * d_emit
        move += step * d_move
        emit[_N_FEATURES] = 0
    for t, label in enumerate(LABELS):  # an inside label follows its own kind only
        if label[0] == "I":
            for s, before in enumerate((*LABELS, "start")):
                if before[2:] != label[2:]:
                    move[s, t] = -1e9
    return emit, move


def viterbi(sequences: list[np.ndarray], emit: np.ndarray, move: np.ndarray) -> list[np.ndarray]:
    """The best labels of many sequences of features, those of similar length in step.

    A group holds at most ``CELLS`` words with its padding, or a single sequence.
    """
    order = sorted(range(len(sequences)), key=lambda k: -len(sequences[k]))
    out: list[np.ndarray] = [np.empty(0)] * len(order)
    at = 0
    while at < len(order):
        # At most half of a group is padding: it ends where lengths fall below half of its longest.
        longest = len(sequences[order[at]])
        end = at + 1
        while end < len(order) and (end + 1 - at) * longest <= CELLS and 2 * len(sequences[order[end]]) >= longest:
            end += 1
        for k, labels in zip(order[at:end], _in_step([sequences[k] for k in order[at:end]], emit, move)):
            out[k] = labels
        at = end
    return out


def _in_step(sequences: list[np.ndarray], emit: np.ndarray, move: np.ndarray) -> list[np.ndarray]:
    """The best labels of sequences of features, padded to the longest."""
    order = sorted(range(len(sequences)), key=lambda k: -len(sequences[k]))
    lengths = np.array([len(sequences[k]) for k in order])
    n = emit.shape[1]
    padded = np.full((len(order), lengths[0], sequences[0].shape[1]), _N_FEATURES)
    for row, k in enumerate(order):
        padded[row, : len(sequences[k])] = sequences[k]
    back = np.zeros((lengths[0], len(order), n), np.int8)
    best = emit[padded[:, 0]].sum(1) + move[n]
    for t in range(1, lengths[0]):
        live = int(np.searchsorted(-lengths, -t, "left"))  # sequences longer than t
        paths = best[:live, :, None] + move[:n]
        back[t, :live] = paths.argmax(1)
        best[:live] = paths.max(1) + emit[padded[:live, t]].sum(1)
    out: list[np.ndarray] = [np.empty(0)] * len(order)
    for row, k in enumerate(order):
        labels = np.empty(lengths[row], np.int64)
        labels[-1] = best[row].argmax()
        for t in range(lengths[row] - 1, 0, -1):
            labels[t - 1] = back[t, row, labels[t]]
        out[k] = labels
    return out


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """The matches of ``EMAIL``: each @ with the longest part before it that no earlier match holds."""
    spans, end, at = [], 0, text.find("@")
    while at >= 0:
        before = text[end:at]
        start = end + len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            spans.append((start, domain.end()))
        end = domain.end() if domain else at + 1
        at = text.find("@", end)
    return spans


def addresses(text: str) -> list[tuple[int, int]]:
    """The matches of ``IP``: numbers joined by dots, four at a time."""
    spans = []
    for chain in _DOTTED.finditer(text):
        parts, start = chain[0].split("."), chain.start()
        for k in range(0, len(parts) - 3, 4):
            size = sum(map(len, parts[k : k + 4])) + 3
            spans.append((start, start + size))
            start += size + 1
    return spans


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Kind number, start and end (code points) of the fixed patterns, by kind, then start."""
    spans = []
    if "@" in text:
        spans += [(0, *span) for span in emails(text)]
    if re.search("[0-9]", text):
        spans += [
            (1, a, b) for a, b in addresses(text) if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in text[a:b].split("."))
        ]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                spans.append((2, *m.span()))
        if "+" in text:
            spans += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return spans


def stretches(text: str, around: int = 2) -> list[list[tuple[int, int]]]:
    """Word places of the stretches to decode: marked words with their neighbours."""
    out: list[list[tuple[int, int]]] = []
    end = 0
    for m in _MARKED.finditer(text):
        if m.start() < end:
            continue
        left = m.start()
        for _ in range(around + 1):
            while left > 0 and text[left - 1] not in _SPACE:
                left -= 1
            begin = left
            while left > 0 and text[left - 1] in _SPACE:
                left -= 1
        words = []
        joined = bool(out) and begin <= out[-1][-1][1]
        after = 0
        for w in _WORD.finditer(text, out[-1][-1][1] if joined else begin):
            words.append(w.span())
            if w.end() > m.start():
                end = w.end() if after == 0 else end
                after += 1
                if after > around:
                    break
        if joined:
            out[-1] += words
        else:
            out.append(words)
    return out


def find_spans(texts: list[str], emit: np.ndarray, move: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """For each text the spans that the field finds."""
    owners, places, features = [], [], []
    for k, text in enumerate(texts):
        for words in stretches(text):
            owners.append(k)
            places.append(words)
            features.append(_features([text[a:b] for a, b in words]))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for at in range(0, len(owners), 4096):
        for k, words, labels in zip(owners[at:], places[at:], viterbi(features[at : at + 4096], emit, move)):
            open_span = None
            for label, (start, end) in zip(labels.tolist(), words):
                if label and label % 2 == 0 and open_span is not None:
                    open_span[2] = end
                    continue
                open_span = [(label - 1) // 2, start, end] if label else None
                if open_span:
                    out[k].append(open_span)
    for text, spans in zip(texts, out):
        for span in spans:
            while span[2] > span[1] and text[span[2] - 1] in _ENDS:
                span[2] -= 1
            while span[2] > span[1] and text[span[1]] in _ENDS:
                span[1] += 1
    return [[tuple(s) for s in spans if s[2] > s[1]] for spans in out]


def find_pii(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", examples: str = EXAMPLES
) -> DataFrame:
    """Find personal data in whole texts.

    Returns per row: doc_id, n_email, n_ip, n_card, n_phone and base_sha256 (fixed
    patterns only), spans (all spans as kind:start:end by kind, then start, joined by commas) and
    n_spans. Places are code points, ends exclusive. Spans of the field are added where
    they meet no span of the fixed patterns.

    A null or empty text has no spans. Repeated rows are each searched; a null id stays null.
    Further columns are not looked at. An empty table gives an empty result.
    """
    emit, move = train(labelled(examples))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(spans: list[tuple[int, int, int]]) -> str:
            return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)

        for batch in sub_batches(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            rows = []
            for text, doc, more in zip(texts, batch.column(0).to_pylist(), find_spans(texts, emit, move)):
                base = base_spans(text)
                added = [s for s in more if not any(s[1] < b and a < s[2] for _, a, b in base)]
                spans = sorted(set(base) | set(added))
                counts = [sum(s[0] == k for s in base) for k in range(len(KINDS))]
                rows.append((doc, *counts, hashlib.sha256(told(base).encode()).hexdigest(), told(spans), len(spans)))
            kinds = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.int64()]
            names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_spans"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"
    own = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return own.transform(by_batch, search, schema)
