import random

import numpy as np

from lattica.llm import abuse

INSULTS = ["idiot", "moron", "clown", "twat"]
BAD = ["You are a complete {} and everybody knows it.", "Go back under your rock, you {}.", "Nobody would miss a {} like you around here."]
GOOD = ["The gene {} is needed for growth in the liver.", "We measured {} twice and saw no change at all.", "Please correct the entry for {}, the domain is missing.", "Cells were kept at {} degrees for two days."]


def made(seed, n, share=0.25):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        parts = [rng.choice(GOOD).format(f"GEN{rng.randrange(99)}") for _ in range(rng.randrange(1, 5))]
        bad = rng.random() < share
        if bad:
            word = rng.choice(INSULTS)
            word = rng.choice([word, word, " ".join(word), word.replace("o", "0").replace("i", "1"), word[0] + "​" + word[1:]])
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(BAD).format(word))
        rows.append((i, " ".join(parts), int(bad)))
    return rows


def tables(spark, rows, flips=0.05):
    rng = random.Random(1)
    docs = spark.createDataFrame([(i, t, "s", "x") for i, t, _ in rows] + [(9001, None, "s", "x"), (9002, "", None, "x"), (9003, " \n", "s", "x")], "doc_id bigint, text string, source string, score string")
    labels = [(i, "r1", y ^ (rng.random() < flips), 0, 0) for i, _, y in rows[: len(rows) // 2]]
    labels = [(i, r, int(a), h, s) for i, r, a, h, s in labels] + [(0, "r2", None, None, None), (9001, "r1", 1, 0, 0), (77777, "r1", 1, 0, 0)]
    return docs, spark.createDataFrame(labels, "doc_id bigint, reviewer string, abusive int, hateful int, sexual int")


def test_held_out_accuracy(spark):
    rows = made(3, 600)
    docs, labels = tables(spark, rows)
    got = {r["doc_id"]: r for r in abuse.scored_documents(docs, labels).collect()}
    assert len(got) == 603
    held_out = rows[300:]
    found = {i for i, _, _ in held_out if got[i]["score"] >= 0.5}
    cases = {i for i, _, y in held_out if y}
    assert len(found & cases) / len(cases) > 0.95 and len(found & cases) / max(1, len(found)) > 0.95
    assert all(got[i]["evidence"] for i in found)
    assert got[9001]["sentence"] is None and got[9001]["score"] < 0.5


def test_without_positive_reviews(spark):
    docs, labels = tables(spark, made(4, 30, share=0.0), flips=0)
    labels = labels.where("abusive = 0")
    assert {r["score"] for r in abuse.scored_documents(docs, labels).collect()} == {0.0}
    assert {r["score"] for r in abuse.scored_documents(docs, labels.limit(0)).collect()} == {0.0}
    assert abuse.scored_documents(docs.limit(0), labels).collect() == []


def test_plain_spelling():
    same = ["idiot", "ID​IOT", "i d i o t", "i.d.i.o.t", "1diot", "іdiot", "ídiot", "i*d*i*o*t"]
    assert {abuse.plain(x) for x in same[:4] + same[5:]} == {"idiot"}
    assert abuse.plain("sh1t and @ss!") == "shit and ass!"
    assert abuse.word_ids("clllown") == abuse.word_ids("clown") and abuse.word_ids("37 x") == abuse.word_ids("4 x")
    assert abuse.sentences("One. Two?\nThree") == ["one.", "two?", "three"] and abuse.sentences(None) == [] == abuse.sentences(" ")
    assert len(abuse.sentences("a " * 300_000)) == 1


def test_search_is_exact():
    rng = np.random.default_rng(0)
    idf = np.ones(abuse.BUCKETS, np.float32) + rng.random(abuse.BUCKETS).astype(np.float32)
    texts = [list(rng.integers(0, 60, rng.integers(1, 12))) for _ in range(300)]
    at, w, b = abuse.vectors_of(np.concatenate(texts).astype(np.int32), np.array([len(t) for t in texts]), idf)
    vectors = [(at[b[i] : b[i + 1]], w[b[i] : b[i + 1]]) for i in range(len(texts))]
    place = {t: i for i, t in enumerate(np.unique(at))}
    dense = np.zeros((300, len(place)))
    for i, (t, x) in enumerate(vectors):
        dense[i, [place[k] for k in t]] = x
    index = abuse.BlockMaxIndex(at, w, b)
    cos = dense @ dense.T
    for least in (0.3, 0.6, 0.95):
        reached = set(abuse.BlockMaxIndex(at[: b[200]], w[: b[200]], b[:201]).may_reach(at, w, b, least))
        assert set(np.flatnonzero((cos[:, :200] >= least).any(axis=1))) <= reached
    for i in range(0, 300, 7):
        without = np.zeros(300, bool)
        without[i] = True
        ids, found = index.search(vectors[i], 8, 0.3, without)
        row = np.where(without, -1, cos[i])
        want = np.sort(row[row >= 0.3])[::-1][:8]
        assert np.allclose(found, want, atol=1e-5) and np.allclose(row[ids], found, atol=1e-5)
        assert index.bounds(vectors[i]).max() >= found.max(initial=0) - 1e-6


def test_calibration_keeps_even_odds():
    rng = np.random.default_rng(1)
    n, truth = np.ones(400), rng.random(400) < 0.3
    raw = np.clip(np.where(truth, 0.9, 0.1) + rng.normal(0, 0.2, 400), 0.01, 0.99)
    slope, floor = abuse.calibration(raw, n, truth.astype(float), np.ones(400))
    nothing = abuse.BlockMaxIndex(*abuse.vectors_of(np.array([1, 2], np.int32), np.array([2]), np.ones(abuse.BUCKETS, np.float32)))
    model = abuse.Model(np.ones(1), nothing, np.zeros(0), nothing, np.zeros(0), np.zeros(0), np.zeros(0), {}, slope, floor)
    scores = [abuse.calibrated(x, model) for x in (0.0, 0.1, 0.49, 0.5, 0.51, 0.9, 1.0)]
    assert scores == sorted(scores) and 0.5 <= scores[3] < 0.56 and scores[0] < 0.2


def test_slips_come_from_disagreement():
    agree = abuse.slips(np.array([2.0] * 500), np.array([0.0, 2.0] * 250))
    assert agree < 0.01 < 0.08 < abuse.slips(np.array([2.0] * 500), np.array([0.0, 1.0, 0.0, 0.0, 2.0] * 100)) < 0.2
    assert 0.04 < abuse.slips(np.ones(3), np.zeros(3)) < 0.08


def test_one_slip_makes_no_sentence_guilty():
    """A harmless sentence that many negative documents hold stays so in a document wrongly taken for a case."""
    good = [(i, "We measured it twice and saw no change at all.", 0.0, 1) for i in range(40)]
    bad = [(100 + i, f"You are a complete {w} and everybody knows it.", 1.0, 1) for i, w in enumerate(["idiot", "moron", "clown", "idiot"])]
    slip = [(200, "We measured it twice and saw no change at all.", 1.0, 1)]
    model = abuse.train(good + bad + slip, np.ones(abuse.BUCKETS, np.float32), 5, 40)
    assert sorted(set(model.texts.values())) == sorted({abuse.sentences(t)[0] for _, t, _, _ in bad})


def test_dropping_reviews_hardly_changes_the_found_set(spark):
    rows = made(7, 900)
    docs, labels = tables(spark, rows)
    found = lambda some: {r["doc_id"] for r in abuse.scored_documents(docs, some).where("score >= 0.5").collect()}
    whole = found(labels)
    for seed in range(5):
        rest = found(labels.where(f"pmod(xxhash64(doc_id, {seed}), 5) > 0"))
        assert len(whole ^ rest) < 0.05 * len(whole)


def test_prior_does_not_depend_on_the_bounds(spark, monkeypatch):
    docs, labels = tables(spark, made(5, 400), flips=0)
    labels = labels.where("doc_id < 9001")
    shares, found = [], abuse.calibration

    def seen(raw, n, cases, weight):
        shares.append(weight[cases > n / 2].sum() / weight.sum())
        return found(raw, n, cases, weight)

    monkeypatch.setattr(abuse, "calibration", seen)
    for bound in (3000, 20):
        abuse.scored_documents(docs, labels, max_docs=bound)
    assert np.allclose(shares, labels.where("abusive = 1").count() / 200)


def test_long_documents_are_examples_too():
    bad = [(i, " ".join(f"Word{chr(97 + i)}{chr(97 + k)} stands here." for k in range(40 if i % 2 else 2)), 1.0, 1) for i in range(20)]
    good = [(100 + i, " ".join(f"Fine{chr(97 + i)}{chr(97 + k)} is there." for k in range(2)), 0.0, 1) for i in range(20)]
    model = abuse.train(bad + good, np.ones(abuse.BUCKETS, np.float32), 20, 20, max_examples=300)
    assert model.every.n == 3 * 2 + 3 * 40 + 20 * 2  # the first positive ones until 100 are reached, short and long
    huge = abuse.train(bad[1:2] + good, np.ones(abuse.BUCKETS, np.float32), 1, 20, max_examples=30)
    assert huge.every.n == 40 + 20  # a document above the bound is not lost, nor are the negative ones


def learnt(**given):
    rng = random.Random(2)
    reviewed = [(i, t, float(y ^ (rng.random() < 0.1)), 1) for i, t, y in made(11, 160)]
    n = sum(y >= 0.5 for _, _, y, _ in reviewed)
    return abuse.train(reviewed, np.ones(abuse.BUCKETS, np.float32), n, len(reviewed) - n, **given)


def asked_of(texts):
    per = [[w for _, w in abuse.sentence_words(t)] for t in texts]
    flat = [w for ws in per for w in ws]
    words = np.array([x for w in flat for x in w], np.uint32).view(np.int32)
    return np.repeat(np.arange(len(texts)), [len(ws) for ws in per]), words, np.array([len(w) for w in flat])


#: Texts whose sentences are like harmless ones, like both kinds, like none, and without any sentence.
ODD = ["We measured GEN7 twice and saw no change at all.", "You are a gene and everybody knows it.", "Nobody would miss the domain around here.", "Zebra quartz violin.", "Zebra quartz violin. We measured GEN7 twice and saw no change at all.", "", None]


def test_scores_below_even_odds_are_exact():
    texts = [t for _, t, _ in made(12, 150)] + ODD
    model = learnt()
    owner, words, sizes = asked_of(texts)
    starts = np.cumsum(sizes) - sizes
    votes = np.zeros(len(sizes))
    for i in range(len(sizes)):
        at, w, _ = abuse.vectors_of(words[starts[i] : starts[i] + sizes[i]], sizes[i : i + 1], model.idf)
        near, cos = abuse.neighbours(model.every, (at, w), model.owner)
        votes[i] = abuse.vote(cos, model.labels[near], model.weights[near])
    want = [votes[owner == d].max(initial=0) if (owner == d).any() else abuse.PRIOR for d in range(len(texts))]
    got = abuse.score_sentences(model, owner, words, sizes, len(texts))
    assert np.allclose([raw for raw, _, _ in got], want, atol=1e-9)
    assert all(sentence < 0 if not (owner == d).any() else abs(votes[sentence] - raw) < 1e-9 for d, (raw, sentence, _) in enumerate(got))
    low = {round(raw, 4) for raw in want if raw < 0.4}
    assert len(low) > 3 and min(low) < abuse.PRIOR  # not one floor for all


def test_documents_from_a_score_on_are_those_of_all_scores():
    texts = [t for _, t, _ in made(12, 150)] + ODD
    every = learnt()
    for least in (0.05, 0.3, 0.5, 0.9):
        some = learnt(least=least)
        a, b = ([(abuse.calibrated(x[0], m), *x) for x in abuse.score_sentences(m, *asked_of(texts), len(texts))] for m in (every, some))
        assert [x if x[0] >= least else None for x in a] == [x if x[0] >= least else None for x in b]
    assert abuse.calibrated(abuse.vote_at(0.5, 0.7, 0.1), every) and abs(0.1 + 0.9 / (1 + ((1 - (v := abuse.vote_at(0.5, 0.7, 0.1))) / v) ** 0.7) - 0.5) < 1e-5


def test_least_leaves_out_nothing_else(spark):
    docs, labels = tables(spark, made(3, 300))
    whole = {r["doc_id"]: r for r in abuse.scored_documents(docs, labels).collect()}
    some = {r["doc_id"]: r for r in abuse.scored_documents(docs, labels, least=0.5).collect()}
    assert len(whole) == 303 and some == {k: r for k, r in whole.items() if r["score"] >= 0.5} and some
    assert all(r["sentence"] for k, r in whole.items() if k < 9001)
