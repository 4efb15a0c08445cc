"""Results that SQL can't state, against slow plain versions."""

import collections
import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import pytest
from checking import compare, duck
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tabulon.llm import chunks, near, neighbours, packing, pii, suffixes, token_files
from tabulon.llm.coder import read_block, write_block
from tabulon.llm.common import stored
from tabulon.llm.tokens import UnitEncoder, tokenizer_path
from tabulon.plans.registry import CHECK_SQL, QUERIES

SQL = [q for q in ("op1_lines", "op3_near", "op5_mixing", "op7_quality") if q in CHECK_SQL]


@pytest.mark.parametrize("name", SQL)
def test_sql(spark, folder, name):
    assert compare(QUERIES[name](spark, folder), duck(folder), CHECK_SQL[name]) is None


def test_all_registered():
    assert {n for n in __spark_entry__.queries() if n.startswith("op")} >= set(SQL)
    assert "pipeline" in __spark_entry__.queries()


def brute_repeats(rows):
    seen = collections.Counter()
    coded = [(d, (t or "").encode()) for d, t in rows]
    for _, b in coded:
        seen.update(b[i : i + 200] for i in range(len(b) - 199))
    out = []
    for d, b in coded:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [1 << 14, 2])
def test_suffixes(spark, documents, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT_RUNS", hot)
    rows = [(r["doc_id"], r["text"]) for r in documents.where("doc_id < 70").collect()]
    draw = random.Random(3)
    base = rows[0][1] * 2
    rows += [(1000 + i, base[a : a + draw.randint(150, 900)]) for i, a in enumerate(draw.choices(range(1500), k=40))]
    rows += [(2002, "a" * 900), (2003, "ab" * 300), (None, base[:500]), (2004, base[:700]), (2004, base[:700]), (2005, "é" * 150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, suffixes.remove_repeats(df).collect()), key=str) == brute_repeats(rows)


def test_chunks(documents):
    rows = sorted((r["doc_id"], r["text"]) for r in documents.collect())
    first, want = {}, []
    for doc, text in rows:
        data, start, runs = text.encode(), 0, []
        for end in chunks.chunk_bounds(data):
            piece = data[start:end]
            if piece in first:
                if runs and runs[-1][0] + runs[-1][1] == start:
                    runs[-1][1] += end - start
                    runs[-1][2].add(first[piece])
                else:
                    runs.append([start, end - start, {first[piece]}])
            first.setdefault(piece, doc)
            start = end
        want += [(doc, a, n, sorted(ids)) for a, n, ids in runs if n >= 100]
    found = chunks.repeated_chunks(documents)
    assert sorted((r["doc_id"], r["start"], r["length"], r["first_doc_ids"]) for r in found.collect()) == sorted(want)
    cleared = {r["doc_id"]: r["text"] for r in chunks.remove_chunks(documents, found).collect()}
    for doc, text in rows[:60]:
        data = bytearray(text.encode())
        for _, a, n, _ in sorted((w for w in want if w[0] == doc), reverse=True):
            del data[a : a + n]
        assert cleared[doc] == data.decode()


def test_chunks_resist_shifts():
    draw = random.Random(1)
    text = bytes(draw.choices(b"abcdefgh ijklmnop", k=5000))
    moved = b"inserted " + text[:2500] + b"more" + text[2500:]
    cut = [{t[a:b] for a, b in zip([0, *e], e)} for t in (text, moved) for e in [chunks.chunk_bounds(t)]]
    assert len(cut[0] & cut[1]) > 0.95 * len(cut[0])


def test_index_finds_all_near_signatures():
    draw = np.random.default_rng(2)
    one = draw.integers(0, 1 << near.BITS, (300, near.SYMBOLS), np.uint64)
    two = one.copy()
    for row in two:
        wrong = draw.permutation(near.SYMBOLS)[: near.MAX_ERRORS]
        row[wrong] = draw.integers(0, 1 << near.BITS, near.MAX_ERRORS, np.uint64)
    shared = (near.index_keys(one) == near.index_keys(two)).any(1)
    assert shared.all()


def test_blocks_of_a_cluster_lose_no_link(spark, documents, monkeypatch):
    want = sorted(map(tuple, near.near_duplicates(documents).collect()))
    monkeypatch.setattr(near, "BLOCK_SHINGLES", 300)
    assert sorted(map(tuple, near.near_duplicates(documents).collect())) == want


def test_neighbours(spark, folder):
    df = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = df.collect()
    ids = np.array([r["vec_id"] for r in rows])
    vectors = np.array([r["embedding"] for r in rows], float)
    found = collections.defaultdict(list)
    for r in sorted(neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect()):
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        scores = (vectors * vectors[q]).sum(1)
        best = [k for k in np.lexsort((ids, -scores)) if k != q][:20]
        mine = found[ids[q]]
        assert len(mine) == 20 and all(s == scores[np.flatnonzero(ids == v)[0]] for v, s in mine)
        hits += len({v for v, _ in mine} & set(ids[best].tolist()))
        total += 20
    assert hits >= 0.9 * total


def test_equal_queries_and_hot_files_stay_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ROWS", 16)
    monkeypatch.setattr(neighbours, "MOST_QUERIES", 20)
    draw = np.random.default_rng(5)
    vectors = draw.standard_normal((240, 4)).round(2)
    vectors[::3] = vectors[0]  # a third of all rows are copies
    vectors[1:120] += 5  # and many more share their pivots
    vectors[[3 * k for k in range(40)]] = vectors[0]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(7, [1.0, 2.0, 3.0, 4.0]), (7, [9.0, 2.0, 3.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = collections.defaultdict(list)
    for r in sorted(neighbours.nearest(df, F.lit(True), k=5, exact=True).collect()):
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    ids, table = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    for q in range(240):
        want = {(int(i), float(s)) for v in table[ids == q] for i, s in zip(ids, (table * v).sum(1)) if i != q}
        assert found[q] == sorted(want, key=lambda x: (-x[1], x[0]))[:5]


def order_of(vectors, pivots, prefix):
    return np.concatenate([np.argsort(-(v @ pivots.T), axis=1, kind="stable")[:, :prefix] for v in np.array_split(vectors, 50)])


@pytest.mark.parametrize("n, most", [(2_000, 0.3), (50_000, 0.07), (200_000, 0.035)])
def test_recall_and_share(n, most):
    """Random vectors of 64 components, the hardest kind: the share that is compared in full falls as the table grows."""
    draw = np.random.default_rng(n)
    vectors = draw.standard_normal((n, 64))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    ids, queries = np.arange(n), np.arange(0, n, n // 30)
    places = order_of(vectors, vectors[draw.choice(n, 256, replace=False)], 64)
    share = neighbours.CANDIDATE_FACTOR * n**0.5 / n
    asked = neighbours.Asked(queries, queries, vectors[queries], places[queries], 20, 256, share)
    for a in range(0, n, neighbours.ROWS):
        part = slice(a, a + neighbours.ROWS)
        asked.meet(ids[part], vectors[part], places[part])
    hits = 0
    for q, (_, found) in zip(queries, asked.best):
        scores = vectors @ vectors[q]
        scores[q] = -9
        hits += len(set(found.tolist()) & set(np.argsort(-scores)[:20].tolist()))
    print(n, "recall", hits / 20 / len(queries), "share", asked.reranked / n / len(queries))
    assert hits >= 0.9 * 20 * len(queries)
    assert asked.reranked <= most * n * len(queries)


def test_footrule_distance():
    draw = np.random.default_rng(1)
    places = np.array([draw.permutation(12)[:5] + 244 for _ in range(60)], np.uint8)  # as they come: bytes
    files = neighbours.PivotFiles(places, 256)
    for own in places[:20]:
        for row, near in zip(places.tolist(), files.nearness(own).tolist()):
            place = {p: i + 1 for i, p in enumerate(row)}
            mine = {p: i + 1 for i, p in enumerate(own.tolist())}
            footrule = sum(abs(place.get(p, 6) - mine.get(p, 6)) for p in set(place) | set(mine))
            assert near == 5 * 6 - footrule
        order = np.argsort(-files.nearness(own), kind="stable")
        found = neighbours.candidates_of(files.nearness(own), 10)
        assert set(order[:10].tolist()) - set(found.tolist()) <= set(np.flatnonzero(files.nearness(own) == 0).tolist())



def test_cached_encoding_equals_the_library(documents):
    texts = [r["text"] for r in documents.limit(80).collect()]
    texts += ["", None, "a  b", " a", "a ", " \n b", "x\t y", "a<|endoftext|> b", "don't  I'll\n\n 12 34...  x", "Σας ΣΑΣ İ", "a\x1cb \x1c c", "É ̈x"]
    for name, keeps in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        library = Tokenizer.from_file(tokenizer_path(name))
        ids, counts = UnitEncoder(tokenizer_path(name), keeps).encode(texts)
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for text, part in zip(texts, parts):
            assert part.tolist() == [*library.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("n", [0, 1, 3, 255, 256, 5000, 70000])
def test_coder_round_trip(n):
    draw = np.random.default_rng(n)
    for ids in (draw.integers(0, 50257, n), draw.zipf(1.3, n) % 50000, np.full(n, 7), draw.integers(0, 2, n)):
        ids = ids.astype(np.uint32)
        block = write_block([5, None], np.array([n, 0]), ids)
        names, counts, back = read_block(block)
        assert names == [5, None] and counts.tolist() == [n, 0] and (back == ids).all()
    if n > 1000:
        assert len(write_block([1], np.array([n]), np.full(n, 7, np.uint32))) < n / 4
        with pytest.raises(ValueError):
            read_block(block[:-1] + bytes([block[-1] ^ 1]))


def test_token_files(spark, documents, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    token_files.write_tokens(documents, path, tokenizer_path("byte_bpe_50k.json"), parts=5)
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    start, want = 0, []
    for r in sorted(documents.collect(), key=lambda r: r["doc_id"]):
        ids = np.array([*library.encode(r["text"], add_special_tokens=False).ids, 2], "<u4")
        want.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, token_files.read_tokens(spark, path).collect())) == want


def test_packing_binary_lengths():
    for n in [*range(1, 300), 4095, 4096, 4097, 10**6 + 1]:
        lengths = packing.binary_lengths(n, 4096)
        assert sum(lengths) == n and len(lengths) <= n // 4096 + 12 and all(x & (x - 1) == 0 for x in lengths)


def test_field_on_held_out_rows():
    emit, move = pii.train(pii.labelled(pii.EXAMPLES))
    held = pii.labelled(
        """
        ask [email:max.muster@post.example.net] soon
        her number is [phone:(646) 555-7788] now
        appelle [phone:+33 6 12 34 56 78] demain
        the server [ip:192.0.2.77] failed
        charge [card:4539 1488 0343 6467] again
        kurz nach 11 kamen 240 leute in 2 bussen
        version 3.1 of 2015 has 4000 lines
        password=77ab12cd34ef stays secret
        wrote to [email:x@y.org] and [email:z.z@q.co.uk] twice
        """
    )
    got = pii.viterbi([pii._features(w) for w, _ in held], emit, move)
    right = sum(pii.LABELS[i] == x for labels, (_, want) in zip(got, held) for i, x in zip(labels, want))
    assert right >= 0.95 * sum(len(want) for _, want in held)


def test_a_long_stretch_does_not_pad_the_others():
    emit, move = pii.train(pii.labelled(pii.EXAMPLES), rounds=3)
    draw = np.random.default_rng(6)
    lengths = [6000, *draw.integers(1, 12, 1500).tolist(), 700]
    features = [draw.integers(0, pii._N_FEATURES, (n, 7)) for n in lengths]
    tracemalloc.start()
    got = pii.viterbi(features, emit, move)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6  # 1,502 x 6,000 x 56 bytes are 505 MB
    for f, labels in zip(features, got):
        assert (labels == pii.viterbi([f], emit, move)[0]).all()


def test_pii_base_patterns():
    text = "a@b.c, 1.2.3.4 x 999.1.1.1 x 4111 1111 1111 1111 x +1 (555) 123-4567 x 4111111111111112"
    spans = pii.base_spans(text)
    assert [(pii.KINDS[k], text[a:b]) for k, a, b in spans] == [
        ("email", "a@b.c"),
        ("ip", "1.2.3.4"),
        ("card", "4111 1111 1111 1111"),
        ("phone", "+1 (555) 123-4567"),
    ]
    emit, move = pii.train(pii.labelled(pii.EXAMPLES))
    (found,) = pii.find_spans(["so 12 and more words here and then +1 (208) 555-1177 4284906611112222 end"], emit, move)
    assert [pii.KINDS[k] for k, _, _ in found] == ["phone", "card"]


def test_pipeline_drops_near_copies_from_80_percent(spark):
    words = [f"w{i}" for i in range(104)]  # 100 shingles
    changed = [*words[:-10], *(f"x{i}" for i in range(10))]  # shares 90 of 110: 0.818
    other = [*words[:-13], *(f"y{i}" for i in range(13))]  # shares 87 of 113 with the first: 0.770
    rows = [(1, " ".join(words)), (2, " ".join(changed)), (3, " ".join(f"z{i}" for i in range(99)))]
    for gone, more in ((True, changed), (False, other)):
        rows[1] = (2, " ".join(more))
        docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' lang", "'a' source", "0L n_chars")
        kept = {r["doc_id"] for r in corpus_pipeline.keep_one_of_near(spark, docs, "").collect()}
        assert kept == ({1, 3} if gone else {1, 2, 3})


def test_pipeline_returns_the_ids(spark):
    text = "some words in a row, and more of them"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = sorted(corpus_pipeline.pack(spark, docs, "").collect(), key=lambda r: r["start"])
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    assert [i for r in rows for i in r["ids"]] == [*library.encode(text, add_special_tokens=False).ids, 2]


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), "stage")
        assert docs.columns == corpus_pipeline.COLUMNS
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3] <= sizes[4]
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = collections.Counter()
    for r in docs.collect():
        ids = np.array([*library.encode(r["text"], add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for n in packing.binary_lengths(len(ids), 4096):
            want[r["doc_id"], at, n, zlib.crc32(ids[at : at + n].tobytes())] += 1
            at += n
    got = collections.Counter(tuple(r)[:4] for r in corpus_pipeline.run(spark, folder).collect())
    assert got == want
