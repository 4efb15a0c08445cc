"""The boundary set and the fill-in-middle forms against plain versions."""

import hashlib
import re

import numpy as np
import pytest
from checking import compare, duck
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import tabulon.llm.queries  # noqa: F401
from tabulon.llm import boundaries
from tabulon.llm.fill_in_middle import fill_in_middle, restored, transformed
from tabulon.plans.registry import CHECK_SQL, QUERIES

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")
PLACES = {
    "array": np.arange(0, 65536, 31),
    "bitmap": np.flatnonzero(np.random.default_rng(1).random(65536) < 0.4),
    "run": np.concatenate([np.arange(5, 3000), np.arange(9000, 40000), [65535]]),
}
KINDS = {"array": boundaries.ArrayContainer, "bitmap": boundaries.BitmapContainer, "run": boundaries.RunContainer}


def plain_boundaries(text):
    return [0, *(m.end() for m in UNIT.finditer(text))]


@pytest.mark.parametrize("kind", PLACES)
def test_containers(kind):
    members = PLACES[kind]
    found = boundaries.container(members)
    assert type(found) is KINDS[kind]
    assert [found.select(k) for k in range(len(members))] == members.tolist()


def test_select_over_containers():
    whole = boundaries.PositionSet()
    for span, kind in ((0, "run"), (3, "array"), (4, "bitmap"), (9, "run")):
        whole.append(span, PLACES[kind])
    whole.append(11, np.array([], int))
    want = np.concatenate([PLACES[k] + s * 65536 for s, k in ((0, "run"), (3, "array"), (4, "bitmap"), (9, "run"))])
    assert len(whole) == len(want) and len(whole.containers) == 4
    assert [whole.select(k) for k in range(0, len(want), 97)] == want[::97].tolist()
    for rank in (-1, len(want)):
        with pytest.raises(IndexError):
            whole.select(rank)


@pytest.mark.parametrize("text", ["", "a", "Ab1 cd", "é" * 65535 + "ab", "x" * 65536, "x" * 65535 + " ", "x" * 70000 + "1" * 65536 + "y z" * 50000, "漢字😀a b"])
def test_unit_boundaries(text):
    found, want = boundaries.unit_boundaries(text), plain_boundaries(text)
    assert len(found) == len(want)
    assert [found.select(k) for k in range(0, len(want), 1 + len(want) // 500)] == want[:: 1 + len(want) // 500]
    assert found.select(len(want) - 1) == len(text)


@settings(max_examples=200, deadline=None)
@given(st.text("aZ <PSM>é1\n", max_size=40), st.lists(st.integers(0, 2**32 - 1), min_size=4, max_size=4))
def test_forms(text, draws):
    output, n, form, prefix, middle = transformed(text, draws, 10, 20, ("<P>", "<S>", "<M>"))
    units = UNIT.findall(text)
    assert n == len(units)
    if form == "plain":
        assert output == text and prefix is None and middle is None
        assert not text or draws[2] % 100 >= 90 or re.search("<[PSM]>", text)
        return
    a, b = sorted(d % (n + 1) for d in draws[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    assert (prefix, middle) == (len(p), len(m))
    assert output == (f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}")
    assert form == ("spm" if draws[3] % 100 < 20 else "psm")


def test_sql(spark, folder):
    assert compare(QUERIES["op11_fill_in_middle"](spark, folder), duck(folder), CHECK_SQL["op11_fill_in_middle"]) is None


def test_odd_rows(spark, odd, empty):
    texts = [(20, "a<P>b"), (21, "<S"), (22, "ends with <"), (23, "<<P>"), (24, "word 1 " * 200000), (25, "Z" * 300000)]
    rows = odd.select("*", F.lit("x").alias("n"), F.lit("x").alias("form"), F.lit("x").alias("draws"), F.lit("x").alias("c0"))
    more = spark.createDataFrame(texts, "doc_id long, text string")
    rows = rows.unionByName(more, allowMissingColumns=True)
    done = fill_in_middle(rows)
    assert set(done.columns) == set(rows.columns) | {"prefix_chars", "middle_chars"}
    back = done.select("doc_id", "form", "n", F.sha2("text", 256).alias("out"), F.sha2(restored("text", "form"), 256).alias("back"), "c0")
    found = {r["doc_id"]: r for r in back.collect()}
    for doc, text, *_ in [tuple(r) for r in rows.select("doc_id", "text").collect()]:
        assert found[doc]["back"] == hashlib.sha256((text or "").encode()).hexdigest(), doc
        assert found[doc]["n"] == len(UNIT.findall(text or ""))
    assert done.count() == rows.count()
    assert found[1]["form"] == found[2]["form"] == found[20]["form"] == found[23]["form"] == "plain"
    assert found[4]["form"] != "plain" and found[4]["out"] != found[4]["back"]
    assert found[7]["c0"] == "x"
    assert fill_in_middle(empty).collect() == []


def test_any_marks(spark):
    df = spark.createDataFrame([(i, f"some text (number) {i}. with [marks]") for i in range(60)], "doc_id long, text string")
    marks = ("\x01pre\x02", "\x03suf\x02", "\x04mid\x02")
    done = fill_in_middle(df, marks=marks, plain_percent=0, spm_percent=50, seed=9)
    assert {r["form"] for r in done.collect()} == {"psm", "spm"}
    both = done.select("doc_id", restored("text", "form", marks).alias("back")).join(df, "doc_id")
    assert both.where("back = text").count() == 60
    for bad in (("aa", "<S>", "<M>"), ("<P>", "<P>", "<M>"), ("", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fill_in_middle(df, marks=bad)
