import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lattica.llm import truncation as tr

NAMES = ["Alpha-1", "Betarin", "Gammol", "Deltase-3"]
VERBS = ["binds the lid domain of", "forms a complex with", "is required for the stability of", "was found beside"]
ENDS = ["in the liver", "at the nuclear pore", "during heat shock", "as shown by live imaging"]


def sentence(rng):
    return f"{rng.choice(NAMES)} {rng.choice(VERBS)} {rng.choice(NAMES)} {rng.choice(ENDS)} of {rng.randrange(90)} samples."


def made(seed=3, n=1500):
    """(id, source, text, cut): feed f300 is cut at 300 characters, feed dots at a word with a mark, feed wire anywhere."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        text, source, cut = " ".join(sentence(rng) for _ in range(rng.randrange(2, 8))), rng.choice(["f300", "dots", "wire", "good", None]), False
        if source == "f300" and len(text) > 300:
            text, cut = text[:300], True
        elif source == "dots" and rng.random() < 0.3:
            text, cut = " ".join(text.split(" ")[: rng.randrange(8, 12)]) + rng.choice(["...", " [truncated]"]), True
            cut = cut and not text.replace("...", "").endswith(".")
        elif source == "wire" and rng.random() < 0.3:
            text, cut = text[: rng.randrange(60, len(text) - 9)] + rng.choice(["", "", "<b", "&#9"]), True
            cut = cut and not text.endswith(("samples.", "samples. "))
        elif rng.random() < 0.15:
            text = rng.choice([text[:-1], text + "  ", text + " (note 12)"])
        rows.append((k, source, text, cut))
    return rows


@pytest.fixture(scope="module")
def scored(spark):
    rows = made()
    extra = [(9001, "good", None, False), (9002, "good", "", False), (9003, None, "   ", False), (0, *rows[0][1:])]
    df = spark.createDataFrame(rows + extra, "rec_id bigint, source string, text string, score boolean")
    return rows, tr.truncated(df, "rec_id", "source", "text", sample=1200).collect()


def test_held_out_accuracy(scored):
    rows, got = scored
    score = {r["rec_id"]: r["score"] for r in got}
    truth = {i: cut for i, _, _, cut in rows}
    found = {i for i, s in score.items() if s >= 0.5}
    cases = {i for i, c in truth.items() if c}
    right = len(found & cases)
    assert len(cases) > 150
    assert right / len(cases) > 0.95 and right / len(found) > 0.93


def test_blank_values_are_left_out_and_copies_scored_alike(scored):
    _, got = scored
    assert not {9001, 9002, 9003} & {r["rec_id"] for r in got}
    assert len({r["score"] for r in got if r["rec_id"] == 0}) == 1 and sum(r["rec_id"] == 0 for r in got) == 2


def test_limits_in_characters_and_bytes(spark):
    rng = random.Random(1)
    rows = [("c", "a" * min(80, rng.randrange(20, 200))) for _ in range(400)]
    rows += [("b", ("é" * rng.randrange(3) + "a" * rng.randrange(20, 200)).encode()[:90].decode("utf-8", "ignore")) for _ in range(400)]
    lengths = spark.createDataFrame(rows, "source string, text string").select("source", F.length("text").alias("chars"), F.octet_length("text").alias("bytes"))
    limits = tr.length_limits(lengths)
    found = {tuple(r) for r in limits.collect()}
    assert ("c", "chars", 80) in found or ("c", "bytes", 80) in found
    assert ("b", "bytes", 90) in found and not any(s == "b" and u == "chars" for s, u, _ in found)
    values = spark.createDataFrame([("c", "a" * 80), ("c", "a" * 79), ("b", "a" * 90), ("b", "a" * 88), ("b", "a" * 91), (None, "a" * 80), ("d", "a" * 80)], "source string, text string")
    placed = {(r["source"], len(r["text"])): r["limit"] for r in tr.with_distance(values, limits).collect()}
    want = {("c", 80): "at", ("b", 90): "at", ("b", 88): "near", ("b", 91): "far", (None, 80): "far", ("d", 80): "far"}
    assert want.items() <= placed.items() and len(placed) == 7


def test_tails():
    assert tr.split_tail("is required for...") == ("is required for", "ellipsis")
    assert tr.split_tail("the lid … [more]")[1] == "bracket" and tr.split_tail("and <b")[1] == "broken" and tr.split_tail("sen�")[1] == "broken"
    assert tr.split_tail("whole.  ") == ("whole.", "none")
    long = "word " * 200_000
    assert tr.split_tail(long)[1] == "none"


def test_a_phrase_that_belongs_to_its_mark_is_no_cut(spark):
    rows = [(k, s, t, c) for k, s, t, c in made(seed=5) if s != "f300"]
    phrase = [(5000 + k, "good", f"{t.rstrip('. ')}. More is to come soon...", False) for k, (_, s, t, c) in enumerate(rows) if s == "good"][:80]
    df = spark.createDataFrame(rows + phrase, "rec_id bigint, source string, text string, score boolean")
    found = {r["rec_id"] for r in tr.truncated(df, "rec_id", "source", "text", sample=1200).collect() if r["score"] >= 0.5}
    assert len(phrase) == 80 and not found & {k for k, *_ in phrase}
    dots = {k for k, s, _, c in rows if s == "dots" and c}
    assert len(found & dots) > 0.95 * len(dots)


def test_nothing_intact_and_empty(spark):
    df = spark.createDataFrame([(1, "s", "abc")], "rec_id bigint, source string, text string")
    assert [r["score"] for r in tr.truncated(df, "rec_id", "source", "text").collect()] == [0.5]
    assert tr.truncated(df.limit(0), "rec_id", "source", "text").collect() == []
    assert np.allclose(tr.probability(tr.matrix([[1, 2]]), np.zeros(tr.FEATURE_BUCKETS + 1)), 0.5)
