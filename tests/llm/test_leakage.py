import math
import random

import numpy as np

from lattica.llm import leakage
from lattica.llm.words import words

RUN, SHARE, STRETCH = 10, 0.75, 2


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def is_case(item, text):
    runs = {tuple(item[i : i + RUN]) for i in range(len(item) - RUN + 1)}
    if any(tuple(text[i : i + RUN]) in runs for i in range(len(text) - RUN + 1)):
        return True
    need, longest = math.ceil(SHARE * len(item)), STRETCH * len(item)
    return any(lcs(item, text[i : i + longest]) >= need for i in range(max(1, len(text) - need + 1)))


def corpus(rng):
    vocabulary = [f"w{i}" for i in range(60)] + ["the", "of", "in"] * 8
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [say(rng.choice([4, 9, 12, 20, 33])) for _ in range(25)]
    docs = []
    for k in range(120):
        item = items[k % len(items)]
        kind = k % 6
        if kind == 0:
            core = item
        elif kind == 1:  # a run of ten at some place
            s = rng.randrange(max(1, len(item) - 9))
            core = item[s : s + 10]
        elif kind == 2:  # words left out and put in
            core = [x for w in item if rng.random() > 0.2 for x in ([w, "noise"] if rng.random() < 0.5 else [w])]
        elif kind == 3:  # stretched just beyond or just within
            core = [x for w in item for x in (w, *["pad"] * rng.randrange(3))]
        elif kind == 4:
            core = sorted(item)
        else:
            core = say(9)
        docs.append(say(rng.randrange(40)) + core + say(rng.randrange(200)))
    return items, [*docs, []]


def test_finds_exactly_the_cases(monkeypatch):
    for seed in range(3):
        items, docs = corpus(random.Random(seed))
        distinct = [list(x) for x in dict.fromkeys(map(tuple, items))]
        vocabulary = {w: n for n, w in enumerate(sorted({w for x in distinct for w in x}))}
        shards = [leakage.build_index(distinct[s : s + 11], RUN, SHARE, STRETCH, vocabulary, len(vocabulary)) for s in range(0, len(distinct), 11)]
        got = {(d, 11 * k + i) for d, k, i in leakage.matches(shards, docs, RUN, SHARE, STRETCH)}
        monkeypatch.setattr(leakage, "POSITIONS_AT_ONCE", 50)
        assert got == {(d, 11 * k + i) for d, k, i in leakage.matches(shards, docs, RUN, SHARE, STRETCH)}
        want = {(d, k) for d, text in enumerate(docs) for k, item in enumerate(distinct) if text and is_case(item, text)}
        assert got == want and want


def test_bounds_never_lose_a_passage():
    items, docs = corpus(random.Random(5))
    index = leakage.build_index(items, RUN, SHARE, STRETCH)
    for way in index.ways:
        assert (way.maxima >= way.impacts[:, : leakage.BLOCK].max(axis=1, keepdims=True)[:, :1] - 1e-6)[:, :1].all()
    starts, ends = leakage.passages(95, 20, 11)
    for s in range(86):
        assert any(a <= s and s + 10 <= b for a, b in zip(starts, ends))
    assert leakage.passages(3, 20, 11)[1].tolist() == [3]


def test_words_and_bits():
    assert words("Ｆｕｌｌ wi­dth, naïve ﬁne 3-D\n") == ["full", "width", "na", "ve", "fine", "3", "d"]
    assert words(None) == words("") == []
    item = "a b c a".split()
    mask = {"a": 0b1001, "b": 0b10, "c": 0b100}
    for text in ("a b c a", "c b a", "x", "a a a", ""):
        assert leakage.common_in_order(mask, 4, text.split()) == lcs(item, text.split())


def test_codes_stop_at_unknown_words_and_text_ends():
    got = leakage.codes(np.array([0, 1, 2, 9, 1, 2]), 2, 9, np.array([2, 6]))
    assert (got >= 0).tolist() == [True, False, False, False, True, False]


def test_operator(spark):
    item = "Which of the seven tubes holds the yellow salt after heating? Key: the second one because it was cold."
    docs = [(1, f"Intro words. {item.upper()} And more.", "x"), (2, "nothing here", "x"), (3, None, "x"), (4, "", None), (1, f"Intro words. {item.upper()} And more.", "x")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, item_id string")
    i = spark.createDataFrame([(7, item, "q"), (8, item.replace(" ", "  "), "q"), (9, None, "q"), (10, "", "q"), (None, item, "q"), (7, item, "q")], "item_id bigint, text string, doc_id string")
    for shard, at_once in ((1, 1), (1, 40), (128, 200_000)):
        got = leakage.leaked_items(d, i, shard_items=shard, words_at_once=at_once).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 7), (1, 8)]
        assert all(r["question_share"] == 1 and r["answer_share"] == 1 for r in got)
    assert leakage.leaked_items(d.limit(0), i).collect() == [] and leakage.leaked_items(d, i.limit(0)).collect() == []


def test_slices_are_bounded_by_words():
    assert list(leakage.slices([3, 4, 9, 1, 0, 2], 7)) == [(0, 2), (2, 3), (3, 6)] and list(leakage.slices([])) == []


def test_wordless_texts_cost_no_shingle():
    import numpy as np

    from lattica.llm.leakage import codes

    ids = np.arange(7)
    whole = codes(ids, 3, 10, np.array([4, 7]))
    assert (whole >= 0).tolist() == [True, True, False, False, True, False, False]
    assert (codes(ids, 3, 10, np.array([0, 0, 4, 4, 7])) == whole).all()
    assert (codes(ids, 3, 10, np.array([0, 1, 1, 7])) >= 0).tolist() == [False, True, True, True, True, False, False]
