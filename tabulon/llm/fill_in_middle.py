"""Fill-in-middle: a text is cut at two unit boundaries and its middle moved to the end.

Both cuts are ranks among the unit boundaries of the text; a compressed boundary set
(:mod:`tabulon.llm.boundaries`) turns them into offsets by select.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.boundaries import unit_boundaries
from tabulon.llm.common import by_batch, sub_batches

#: Marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
RESULTS = {"n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long"}


def _check_marks(marks: Sequence[str]) -> None:
    """A mark must not overlap another one, so that an output can be taken apart again."""
    for mark in marks:
        if not mark or any(mark[0] in other[1:] for other in marks):
            raise ValueError(f"marks must not overlap: {mark!r} begins with a character from inside a mark")
    if len(set(marks)) != 3:
        raise ValueError("three different marks are needed")


def transformed(text: str, draws: Sequence[int], plain_percent: int, spm_percent: int, marks: Sequence[str]) -> tuple:
    """Output, units, form, and the lengths of prefix and middle, of one text and its four draws."""
    bounds = unit_boundaries(text)
    n = len(bounds) - 1
    if not text or any(mark in text for mark in marks) or draws[2] % 100 >= 100 - plain_percent:
        return text, n, "plain", None, None
    low, high = sorted(draw % (n + 1) for draw in draws[:2])
    a, b = bounds.select(low), bounds.select(high)
    p, s, m = marks
    if draws[3] % 100 < spm_percent:
        return "".join((s, text[b:], p, text[:a], m, text[a:b])), n, "spm", a, b - a
    return "".join((p, text[:a], s, text[b:], m, text[a:b])), n, "psm", a, b - a


def draws_of(doc_id: Column, seed: int) -> Column:
    """Four unsigned 32-bit draws: the first groups of 8 digits of a sha256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)])


def fill_in_middle(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 1,
    plain_percent: int = 10,
    spm_percent: int = 20,
    marks: Sequence[str] = MARKS,
) -> DataFrame:
    """Replace each text by its fill-in-middle form.

    Returns all columns of ``docs``, the text replaced by the output, and n (units
    ``[A-Za-z]+|[^A-Za-z]``), form (plain, psm or spm), prefix_chars and
    middle_chars (code points, null if plain); columns of ``docs`` with these names
    are replaced. The prefix ends after the smaller, the middle after the larger of
    two draws modulo n + 1; all draws are hashes of ``seed`` and id, so a lost
    task makes the same cuts again. Every row stands alone: nothing is shuffled.

    A null text counts as the empty one, and comes out empty and plain; so do texts that contain a
    mark, unchanged. Rows with equal ids get equal draws; a null id draws as the empty
    one. Long texts are read whole, a span at a time. An empty table gives an empty result.
    """
    _check_marks(marks)
    kept = [c for c in docs.columns if c not in RESULTS or c == text_col]
    place, width = kept.index(text_col), len(kept)
    names = [f"c{k}" for k in range(width)]
    rows = docs.select(
        *[
            (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) if c == text_col else F.col(f"`{c}`")).alias(name)
            for c, name in zip(kept, names)
        ],
        draws_of(F.col(f"`{id_col}`"), seed).alias("draws"),
    )

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches):
            pairs = zip(batch.column(place).to_pylist(), batch.column(width).to_pylist())
            columns = zip(*[transformed(text, draws, plain_percent, spm_percent, marks) for text, draws in pairs])
            text, n, form, prefix, middle = list(columns) or [[]] * 5
            arrays = batch.columns[:width]
            arrays[place] = pa.array(text, batch.column(place).type)
            arrays += [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*names, *RESULTS])

    schema = rows.drop("draws").schema
    for name, kind in RESULTS.items():
        schema = schema.add(name, kind)
    return by_batch(rows, transform, schema).select(
        *[F.col(name).alias(c) for name, c in zip(names, kept)], *RESULTS
    )


def restored(text: Column | str, form: Column | str, marks: Sequence[str] = MARKS) -> Column:
    """The exact text behind an output of :func:`fill_in_middle`; no piece holds a mark, so a split finds all pieces."""
    _check_marks(marks)
    text, form = (F.col(c) if isinstance(c, str) else c for c in (text, form))
    pieces = F.split(text, "|".join(rf"\Q{mark}\E" for mark in marks), -1)
    psm = F.concat(pieces[1], pieces[3], pieces[2])
    spm = F.concat(pieces[2], pieces[3], pieces[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(text)
