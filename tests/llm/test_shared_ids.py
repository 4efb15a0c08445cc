"""Rows without an id or with one id: each text keeps its own results."""

import hashlib
import random
import re
import time

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tabulon.llm import chunks, pii, suffixes


def shared_rows(n=5000, length=450):
    draw = random.Random(12)
    base = "".join(draw.choices("abcdefgh ijklm", k=3000))
    rows = []
    for k in range(n):
        a = draw.randint(0, 2500)
        own = "".join(draw.choices("abcdefgh ijklm", k=length))
        rows.append((None if k % 2 else 7, own[:200] + base[a : a + 260] + own[200:] if k % 10 == 0 else own))
    return rows


def test_suffixes(spark):
    """5,000 different texts under two keys: what repeats is taken from the right text."""
    rows = shared_rows()
    found = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    where = {}
    for _, text in rows:
        for i in range(len(text) - 199):
            where[text[i : i + 200]] = where.get(text[i : i + 200], 0) + 1
    want = []
    for doc, text in rows:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - 199):
            if where[text[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = "".join(c for c, g in zip(text, gone) if not g)
        want.append((doc, len(text), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    assert sorted(want, key=str) == sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in found), key=str)
    assert sum(w[2] > 0 for w in want) > 300


def plain_bounds(data):
    """The gear hash byte by byte: a chunk ends where the top bits of the hash of the last bytes are zero."""
    value, ends, last = 0, [], 0
    window = []
    for at in range(len(data)):
        window = (window + [int(chunks._GEAR[data[at]])])[-chunks.GEAR_BYTES :]
        value = sum(g << k for k, g in enumerate(reversed(window))) & 0xFFFFFFFF
        place = at + 1
        if place < len(data) and data[place] & 0xC0 == 0x80:
            continue
        while place - last > chunks.MOST:
            cut = last + chunks.MOST
            while cut < place and data[cut] & 0xC0 == 0x80:
                cut += 1
            if cut >= place:
                break
            ends.append(cut)
            last = cut
        if place == len(data) or (value >> (32 - chunks.CUT_BITS) == 0 and place - last >= chunks.LEAST):
            if place > last:
                ends.append(place)
                last = place
    return ends


def test_gear_hash_byte_by_byte():
    draw = random.Random(3)
    for text in ("".join(draw.choices("abc é漢 xyz", k=2000)), "a" * 3000, "", "é", "é" * 1700, "ab" * 20):
        assert chunks.chunk_bounds(text.encode()) == plain_bounds(text.encode()), text[:20]


def test_chunks(spark):
    """Null and shared ids: a text that repeats another one is found and cut, whatever their ids are."""
    draw = random.Random(5)
    texts = ["".join(draw.choices("abcdefgh ijklm", k=900)) for _ in range(40)]
    rows = [(None, t) for t in texts[:20]] + [(3, t) for t in texts[20:]]
    rows += [(3, texts[0]), (None, texts[21] + " and more"), (None, texts[1]), (3, texts[30]), (9, None), (None, None), (8, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_id", F.lit("x")).withColumn("spans", F.lit(1)).repartition(4)
    runs = chunks.repeated_chunks(df).collect()
    keys = {chunks.text_key(t.encode()): t for _, t in rows if t}
    found = {(r["doc_id"], keys[r["text_key"]]): r for r in runs}
    assert found[3, texts[0]]["length"] == 900 and found[3, texts[0]]["first_doc_ids"] == [None]
    # of the two with and without an id the null one is first
    assert (None, texts[21] + " and more") not in found and found[3, texts[21]]["first_doc_ids"] == [None]
    assert (None, texts[1]) not in found and (3, texts[30]) not in found  # repeated rows are one document
    assert len(found) == 2
    out = chunks.remove_chunks(df, chunks.repeated_chunks(df))
    assert out.columns == df.columns and out.count() == len(rows)
    left = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    cut = {(3, texts[0]): "", (3, texts[21]): found[3, texts[21]]}
    want = []
    for doc, text in rows:
        run = found.get((doc, text))
        want.append((doc, text if run is None else (text.encode()[: run["start"]] + text.encode()[run["start"] + run["length"] :]).decode()))
    assert left == sorted(want, key=str) and cut


def test_many_null_ids_in_chunks(spark):
    rows = shared_rows(5000, 300)
    runs = chunks.repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    texts = {chunks.text_key(t.encode()): t for _, t in rows}
    earlier = {}
    for r in runs.collect():
        text = texts[r["text_key"]].encode()
        assert 0 <= r["start"] and r["start"] + r["length"] <= len(text) and r["length"] >= 100
        earlier.setdefault(r["doc_id"], []).append(text[r["start"] : r["start"] + r["length"]])
    assert sum(map(len, earlier.values())) > 100


def test_near_stage_keeps_other_texts_of_an_id(spark):
    """An id with a text of its own and a near copy of another one: only the copy goes."""
    words = [f"w{i}" for i in range(300)]
    own = " ".join(f"u{i}" for i in range(300))
    near = " ".join([*words[:298], "x", "y"])
    rows = [(1, " ".join(words)), (5, near), (5, own), (None, near), (None, own[:500]), (6, own), (6, own)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.keep_one_of_near(spark, df.coalesce(1), "").collect()
    texts = sorted(r["text"] for r in kept)
    assert len(kept) == 3 and own in texts and own[:500] in texts
    assert sum(t in (" ".join(words), near) for t in texts) == 1


PII_WORDS = {
    "letters": "a" * 1_000_000,
    "digits": "1" * 1_000_000,
    "letters at": "x@" + "a" * 1_000_000 + " b@c.de",
    "at the end": "a" * 1_000_000 + "@b.cd",
    "many ats": "a@" * 300_000,
    "hex": "0123456789abcdef" * 60_000 + " 1@",
    "dotted": "1." * 400_000,
    "number by letters": "9 " + "a" * 1_000_000,
    "plus": "+1" * 300_000,
    "brackets": "+1" + "(" * 1_000_000,
}


def test_long_words_take_linear_time():
    emit, move = pii.train(pii.labelled(pii.EXAMPLES), rounds=2)
    pii.find_spans(["warm up 1"], emit, move)
    for name, text in PII_WORDS.items():
        start = time.process_time()
        pii.base_spans(text)
        pii.find_spans([text], emit, move)
        assert time.process_time() - start < 5, name


def plain_base(text):
    """The patterns of the base kinds as they stand."""
    spans = [(0, *m.span()) for m in pii.EMAIL.finditer(text)]
    spans += [(1, *m.span()) for m in pii.IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in pii.CARD.finditer(text):
        digits = [int(c) for c in re.sub("[^0-9]", "", m[0])]
        doubled = [d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(reversed(digits))]
        if 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            spans.append((2, *m.span()))
    return spans + [(3, *m.span()) for m in pii.PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_base_patterns_on_random_texts():
    draw = random.Random(8)
    pieces = ["@", ".", "a", "b-c", "1", "22", "255", "256", "+", " ", "-", "(", ")", "\n", "é", "4111111111111111", "x.y", "%"]
    for _ in range(4000):
        text = "".join(draw.choices(pieces, k=draw.randint(1, 25)))
        assert pii.base_spans(text) == plain_base(text), text


def test_base_columns_over_documents(documents):
    """Counts and digests of the query against the plain patterns over all documents."""
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    kinds = pii.KINDS
    for row in pii.find_pii(documents).collect():
        base = plain_base(texts[row["doc_id"]])
        assert [row[f"n_{k}"] for k in kinds] == [sum(s[0] == k for s in base) for k in range(4)]
        told = ",".join(f"{kinds[k]}:{a}:{b}" for k, a, b in base)
        assert row["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        every = [tuple(s.split(":")) for s in row["spans"].split(",") if s]
        assert {(kinds[k], str(a), str(b)) for k, a, b in base} <= set(every) and len(every) == row["n_spans"]
