"""The cache of pieces stays small, keeps what is frequent, and changes no id; the coder finds the same values."""

import gc
import random

import numpy as np
import pytest

from tabulon.llm import coder, packing
from tabulon.llm.tokens import CACHE_UNITS, UnitEncoder, tokenizer_path


@pytest.mark.parametrize("name, keeps", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_frequent_pieces_outlive_a_full_cache(name, keeps):
    draw = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    encoder = UnitEncoder(tokenizer_path(name), keeps, cache_units=200)
    frequent = ["the", "of", "and,", "über", "42"]
    asked = []
    for batch in range(30):
        fresh = ["".join(draw.choices(letters, k=9)) for _ in range(60)]
        texts = [" ".join([*frequent, one, *frequent]) for one in fresh] + [None, ""]
        flush = encoder._flush
        encoder._flush = lambda: (asked.extend((batch, unit.strip()) for unit in encoder.pending), flush())
        ids, counts = encoder.encode(texts, end_id=None)
        encoder._flush = flush
        want = [encoder.tokenizer.encode(text or "", add_special_tokens=False).ids for text in texts]
        assert ids.tolist() == sum(want, []) and counts.tolist() == list(map(len, want))
        assert encoder.used <= 200 + 70 and len(encoder.starts) == encoder.used + 1
    assert not [unit for batch, unit in asked if batch and unit in frequent]


def test_packing_remembers_fewer_pieces():
    assert packing.PACK_UNITS * 2 <= CACHE_UNITS


def test_find_is_the_search():
    models = coder._Models(3000, 8)
    models.counts[:] = np.random.default_rng(5).integers(1, 10**4, 3000) ** 2
    models._rebuild()
    edges = np.concatenate([models.cumulated[:-1], models.cumulated[1:] - np.uint64(1)])
    assert (models.find(edges) == np.searchsorted(models.cumulated, edges, "right") - 1).all()


def test_round_trip_when_a_share_is_nothing(monkeypatch):
    """After very many misses the shares of orders 1 and 2 are rounded down to zero."""
    start = coder._Models.__init__

    def missed(self, *sizes):
        start(self, *sizes)
        self.outcomes[:, 0] = 10**9

    monkeypatch.setattr(coder._Models, "__init__", missed)
    ids = np.random.default_rng(6).integers(0, 5, 5000).astype(np.uint32)
    words, used = coder.encode_ids(ids, 5)
    assert (coder.decode_ids(words, used, len(ids), 5) == ids).all()


@pytest.mark.parametrize("name, keeps", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_new_pieces_do_not_wake_the_garbage_collector(name, keeps):
    """Ids of plain and odd new pieces stay in order, and no list is kept for each of them."""
    draw = random.Random(4)
    odd = ["x1", "émile", "naïve,", "日本", "a-b", "", "\n", "don't"]
    words = ["".join(draw.choices("abcdefghij", k=8)) for _ in range(20_000)]
    texts = [" ".join(draw.choices(words, k=60) + draw.choices(odd, k=9)) for _ in range(400)]
    encoder = UnitEncoder(tokenizer_path(name), keeps)
    begun = []
    gc.collect()
    gc.callbacks.append(count := lambda phase, info: begun.append(phase))
    try:
        ids, counts = encoder.encode(texts, end_id=None)
    finally:
        gc.callbacks.remove(count)
    want = [encoder.tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert ids.tolist() == sum(want, []) and counts.tolist() == list(map(len, want))
    assert encoder.used > 10_000 and begun.count("start") <= 2
