import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from lattica.llm import packing


def test_the_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        key = packing.hilbert_key(cells, bits)
        assert sorted(key) == list(range(len(cells)))
        assert np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1).max() == 1


def test_fill_keeps_every_size_once():
    rng = random.Random(2)
    for capacity, windows in ((50, (1,)), (50, (7, 20)), (100, (4096,)), (100, (3, 9, 4096))):
        sizes = [rng.randrange(1, capacity + 1) for _ in range(500)]
        got = list(packing.fill(iter(sizes), capacity, windows, 0.0))
        assert sorted(p for p, _ in got) == list(range(500))
        used = {}
        for p, c in got:
            used[c] = used.get(c, 0) + sizes[p]
        assert max(used.values()) <= capacity
        if windows == (4096,):
            least = max(sum(sizes) / capacity, sum(2 * x > capacity for x in sizes))  # two large ones never share
            assert len(used) <= 1.01 * least + 1
    assert list(packing.fill(iter([]), 5)) == []


def test_fill_keeps_to_the_curve():
    """Texts that fit are taken from the nearest ones, and farther ones only where much would stay empty."""
    got = list(packing.fill(iter([5] * 100), 20, (4, 50), 0.01))
    assert [p for p, _ in got] == list(range(100)) and got[-1][1] == 24
    assert dict(packing.fill(iter([18, 18, 18, 18, 2, 2]), 20, (2, 50), 0.2)) == {0: 0, 1: 1, 2: 2, 3: 3, 4: 3, 5: 4}
    assert dict(packing.fill(iter([18, 18, 18, 18, 2, 2]), 20, (2, 50), 0.01)) == {0: 0, 4: 0, 1: 1, 5: 1, 2: 2, 3: 3}


def test_texts_of_a_container_are_alike(spark):
    rng = random.Random(8)
    kinds = [[f"{a}{b}" for b in ("ine", "ase", "ol", "yx")] for a in ("quo", "ver", "tal", "min", "ros", "gan")]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(kinds[i % 6]) for _ in range(rng.randrange(5, 40)))) for i in range(900)], "doc_id bigint, text string")
    packs = spark.createDataFrame([(k, 200 + k) for k in range(103)], "pack_id int, capacity_tokens int")
    placed = packing.packed_with_place(docs, packs.where("pack_id < 2"))
    spread = {r["pack_id"]: r["spread"] for r in packing.spread_within(placed).collect()}
    assert len(spread) == 2 and max(spread.values()) < 0.6
    few = docs.limit(3)
    assert packing.packed(few, packs).select("pack_id").distinct().count() == 103  # more packs than one pass takes


def test_operator(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["protein", "binds", "the", "domain", "ü", "\n"]) for _ in range(rng.choice([1, 5, 30, 200]))) for _ in range(300)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(900, None, "x"), (901, "", "x"), (902, "   ", "x"), (903, "word " * 3000, "x")], "doc_id bigint, text string, pack_id string")
    packs = spark.createDataFrame([(1, 64), (2, 256), (2, 256), (3, None), (4, 0)], "pack_id int, capacity_tokens int")
    rows = packing.packed(docs, packs).collect()
    encode = packing.encoding(open(packing.VOCABULARY, "rb").read(), packing.PATTERN).encode_ordinary
    want = {i: len(encode(t)) for i, t in [*enumerate(texts), (902, "   "), (903, "word " * 3000)]}
    for pack, capacity in ((1, 64), (2, 256)):
        mine = [r for r in rows if r["pack_id"] == pack]
        held, tokens, pieces = {}, {}, {}
        for r in mine:
            held[r["container_id"]] = held.get(r["container_id"], 0) + r["n_tokens"]
            tokens[r["doc_id"]] = tokens.get(r["doc_id"], 0) + r["n_tokens"]
            pieces.setdefault(r["doc_id"], []).append((r["piece_no"], r["first_token"], r["n_tokens"]))
        assert tokens == want and max(held.values()) <= capacity
        for doc, p in pieces.items():
            assert len(p) == 1 or want[doc] > capacity
            at = 0
            for k, (no, first, n) in enumerate(sorted(p)):
                assert (no, first) == (k, at)
                at += n
    assert {r["pack_id"] for r in rows} == {1, 2}
    assert packing.packed(docs.limit(0), packs).collect() == [] and packing.packed(docs, packs.limit(0)).collect() == []
    assert packing.packed(docs.where(F.col("doc_id") > 903), packs).count() == 0
