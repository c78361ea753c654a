"""Text values cut off by field limits or broken transfers, found by a hashed logistic regression.

Positives are made: values that look intact are cut, at a limit that values of some source pile up at, between words with
an omission mark, or anywhere, sometimes inside a tag, an entity or a character. Negatives are the same values whole, also
without their last full stop or with blanks behind it. Features look at the closing characters, the punctuation, the
last words and the distance of the length to the limits of the source. Statistics of the whole column support them, those
of words of fixed size: how often the last one, two and three words (hashed) end a sentence and how often they do not,
which words occur at all, and which last words belong to the mark behind them, as a standing phrase does; and the lengths
that many values of one source share, which are joined to the values. The model is fitted on a bounded sample of values
(`sample`); every value is then scored whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lattica.session import staged

#: Buckets of hashed word statistics and of hashed features.
WORD_BUCKETS, FEATURE_BUCKETS = 1 << 20, 1 << 18

# Marks that stand where text was left out.
OMISSIONS = ("...", "…", "... [more]", " [...]", " [truncated]", " (abstract shortened)", " (more)", " [continued]")
BROKEN_TAILS = ("&", "&#", "&#9", "&am", "&nbs", "<", "<b", "</i", "<su", "�")

#: A phrase belongs to its mark if that stands behind it so many times, in this share of its ends, and it ends so many times as often as it goes on.
PHRASE_TIMES, PHRASE_SHARE, PHRASE_ENDS = 3, 0.5, 8

#: Limits at which values are cut to make positives.
LIMITS_FOR_CUTS = 1000

#: Characters at the end in which an omission mark or a broken tail is looked for.
LONGEST_MARK = 120

_BROKEN = re.compile(r"\s*(?:&#?[A-Za-z0-9]{0,8}|</?[A-Za-z]{0,8}|�+)$")
_BRACKET = re.compile(r"\s*(?:\.{3}|…)?\s*[\[(](?:\.{3}|…|[^\[\]()]{0,40}\b(?:more|truncat\w*|shorten\w*|cut|continu\w*|abridg\w*|omitted)\b[^\[\]()]{0,40})[\])]$", re.I)
_ELLIPSIS = re.compile(r"\s*(?:\.{3,}|…)$")
_TOKEN = re.compile(r"[^\W_]+(?:[-'’][^\W_]+)*|[.!?;:,()\[\]\"“”]")
_SENTENCE_END = re.compile(r"(?:[.!?]|[\"”')\]])\s*$")
_DIGITS = re.compile(r"\d+")


def bucket(text: str, size: int) -> int:
    return zlib.crc32(text.encode("utf-8", "replace")) & (size - 1)


def split_tail(text: str) -> tuple[str, str]:
    """The body of a value and what kind of mark stands at its end: broken, bracket, ellipsis or none."""
    body = text.rstrip()
    tail = body[-LONGEST_MARK:]  # a mark is shorter than that
    for kind, pattern in (("broken", _BROKEN), ("bracket", _BRACKET), ("ellipsis", _ELLIPSIS)):
        if found := pattern.search(tail):
            return body[: len(body) - len(tail) + found.start()].rstrip(), kind
    return body, "none"


def ends_like_a_sentence(body: str) -> bool:
    return bool(_SENTENCE_END.search(body.rstrip()[-4:]))


def masked(token: str, first: bool) -> str:
    """A word for statistics: numbers as 0; words with a capital inside a sentence, which are mostly names, as N."""
    if token[0].isdigit():
        return _DIGITS.sub("0", token)
    if token[0].isupper() and not first:
        return "N" if not token.isupper() or any(c.isdigit() for c in token) else token
    return _DIGITS.sub("0", token).lower()


_ENDS = ".!?"


class Tokens:
    """Tokens seen so far, each with what the statistics need, so that a text costs one look-up per token."""

    def __init__(self, most: int = 300_000):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.facts: list[tuple[int, int, int, bool, bool, bool]] = []

    def _add(self, t: str) -> int:
        word = t[0].isalnum()
        h = lambda x: zlib.crc32(x.encode("utf-8", "replace"))
        self.facts.append((h(masked(t, False) if word else t), h(masked(t, True) if word else t), h(t), word, t in _ENDS, t in ".!?:"))
        self.place[t] = len(self.facts) - 1
        return len(self.facts) - 1

    def of(self, text: str) -> list[int]:
        get = self.place.get
        return [i if (i := get(t)) is not None else self._add(t) for t in _TOKEN.findall(text)]


def gram_bucket(n: int, hashes):
    """Bucket of the n hashes given (first word first), arrays of unsigned 64-bit integers."""
    x = np.uint64(n * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    for h in hashes:
        x = (x ^ h) * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(29))
    return (x & np.uint64(WORD_BUCKETS - 1)).astype(np.int64)


def grams(tokens: Tokens, places: list[int], starts: np.ndarray):
    """Of many texts end to end (places of tokens, first token of each text): facts, position in the text, hashes as they stand."""
    facts = np.array(tokens.facts, np.int64).reshape(-1, 6)[np.array(places, np.int64)]
    size = len(places)
    first = np.zeros(size, bool)
    first[1:] = facts[:-1, 5] == 1
    first[starts[starts < size]] = True
    inside = np.arange(size) - np.repeat(starts, np.diff(np.append(starts, size)))
    return facts, inside, np.where(first, facts[:, 1], facts[:, 0]).astype(np.uint64)


def ends_and_middles(texts: list[str], counts: np.ndarray, tokens: Tokens) -> None:
    """Add to counts[0] (ends of sentences), counts[1] (elsewhere): hashed last 1, 2, 3 tokens; counts[2]: whole words; counts[3]: last 3 tokens before a mark."""
    if len(tokens.facts) > tokens.most:
        tokens.clear()
    per_text, marked = [], []
    for body, kind in map(split_tail, texts):
        if found := tokens.of(body):
            per_text.append(found)
            marked.append(kind != "none")
    if not per_text:
        return
    places = [i for x in per_text for i in x]
    starts = np.cumsum([0, *map(len, per_text)])[:-1]
    facts, inside, hashes = grams(tokens, places, starts)
    last = np.zeros(len(places), bool)
    last[np.append(starts[1:], len(places)) - 1] = True
    word = facts[:, 3] == 1
    ends = last.copy()
    ends[:-1] |= facts[1:, 4] == 1
    for n in (1, 2, 3):
        at = np.flatnonzero(word & (inside >= n - 1))
        buckets = gram_bucket(n, [hashes[at - k] for k in range(n - 1, -1, -1)])
        if n == 3:
            text_of = np.searchsorted(starts, at, side="right") - 1
            before_mark = last[at] & np.array(marked)[text_of]
            counts[3] += np.bincount(buckets[before_mark], minlength=WORD_BUCKETS)
        for row, here in ((0, ends[at]), (1, ~ends[at])):
            counts[row] += np.bincount(buckets[here], minlength=WORD_BUCKETS)
    counts[2] += np.bincount(facts[word & ~last, 2] & (WORD_BUCKETS - 1), minlength=WORD_BUCKETS)  # the last word may be half a word


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, tokens = np.zeros((4, WORD_BUCKETS), np.int64), Tokens()
    for batch in batches:
        ends_and_middles([x for x in batch.column(0).to_pylist() if x], counts, tokens)
    for row in range(4):
        at = np.flatnonzero(counts[row])
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), row, np.int32)), pa.array(at.astype(np.int32)), pa.array(counts[row][at])], ["kind", "bucket", "n"])


@dataclass
class Statistics:
    """log_ratio: log of ends over middles per bucket. known: times a whole word was seen, to 255. phrase: last three words that belong to their mark.

    limits: some (unit, length) at which values are cut to make positives.
    """

    log_ratio: np.ndarray
    known: np.ndarray
    phrase: np.ndarray
    limits: list[tuple[str, int]]


def length_limits(lengths: DataFrame, least: int = 5, share: float = 0.005, times: float = 8.0) -> DataFrame:
    """(source, unit, length): lengths that far more values of a source have than their spread explains.

    lengths has source, chars and bytes. A length counts from `least` values, `share` of the source and `times` the mean
    number per length between the 5th and 95th percentile; so a source has at most 1 / share of them in the one unit, in
    which they are sharper: a limit in one unit also heaps up the other.
    """
    long = lengths.select("source", F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("length")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("length")))).alias("x")).select("source", "x.*")
    counts = long.groupBy("source", "unit", "length").agg(F.count(F.lit(1)).alias("n"))
    per = counts.groupBy("source", "unit").agg(F.sum("n").alias("total"), F.percentile_approx("length", 0.05, 1000).alias("lo"), F.percentile_approx("length", 0.95, 1000).alias("hi"))
    joined = counts.alias("c").join(per.alias("p"), F.col("c.source").eqNullSafe(F.col("p.source")) & (F.col("c.unit") == F.col("p.unit")))
    dense = F.col("total") / F.greatest(F.col("hi") - F.col("lo"), F.lit(1))
    kept = joined.where((F.col("n") >= least) & (F.col("n") >= F.col("total") * share) & (F.col("n") >= dense * times) & (F.col("length") > 0)).select("c.source", "c.unit", "length", "n")
    sharper = F.max_by("unit", F.struct("n", "unit")).over(Window.partitionBy("source"))
    return kept.withColumn("sharper", sharper).where(F.col("unit") == F.col("sharper")).select("source", "unit", "length")


def with_distance(values: DataFrame, limits: DataFrame) -> DataFrame:
    """values (with source and text) with the column limit. at: the length is a limit of the source; near: one more character of several bytes would pass it; else far."""
    lengths = lambda unit: F.collect_list(F.when(F.col("unit") == unit, F.col("length"))).alias(f"{unit}_limits")
    per_source = limits.groupBy(F.col("source").alias("limits_of")).agg(lengths("chars"), lengths("bytes"))
    joined = values.join(staged(per_source, "limits"), F.col("source").eqNullSafe(F.col("limits_of")), "left")
    size = F.octet_length("text")
    holds = lambda column, x: F.coalesce(F.array_contains(column, x), F.lit(False))
    near = holds("bytes_limits", size + 1) | holds("bytes_limits", size + 2) | holds("bytes_limits", size + 3)
    kind = F.when(holds("chars_limits", F.length("text")) | holds("bytes_limits", size), "at").when(near, "near").otherwise("far")
    return joined.withColumn("limit", kind).drop("limits_of", "chars_limits", "bytes_limits")


def gather(values: DataFrame, limits: DataFrame) -> Statistics:
    """Statistics of all values (source, text); at most LIMITS_FOR_CUTS of the limits, by their hash."""
    counted = values.select("text").mapInArrow(_counter, "kind int, bucket int, n bigint").groupBy("kind", "bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros((4, WORD_BUCKETS))
    found = counted.toArrow()  # at most four rows per bucket
    counts[found.column("kind").to_numpy(), found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    ratio = np.log((counts[0] + 0.3) / (counts[1] + 0.3)).astype(np.float32)
    ratio[(counts[0] + counts[1]) == 0] = 0
    phrase = (counts[3] >= PHRASE_TIMES) & (counts[3] >= PHRASE_SHARE * counts[0]) & (counts[0] >= PHRASE_ENDS * counts[1])
    some = limits.select("unit", "length").distinct().orderBy(F.xxhash64("unit", "length"), "unit", "length").limit(LIMITS_FOR_CUTS).collect()
    return Statistics(ratio, np.minimum(counts[2], 255).astype(np.uint8), phrase, sorted((r["unit"], r["length"]) for r in some))


_shared_tokens = Tokens()


def features(text: str, limit: str, stats: Statistics) -> list[int]:
    """Hashed features of a value's end. Only the end is looked at, but the length that limit speaks of is that of the whole value."""
    body, kind = split_tail(text)
    blank = "_" if text != text.rstrip() else ""
    close = body[-1:] or "empty"
    shut = "end" if ends_like_a_sentence(body) else "open"
    group = "a" if close.isalpha() else "0" if close.isdigit() else close
    state = f"{kind}{shut}"
    out = [f"s {state}", f"c {state} {group}", f"b {state} {blank}", f"r {text[-3:]!r}"]
    out += [f"limit {limit}", f"limit {limit} {state}"]
    tail = body[-160:]
    if len(_shared_tokens.facts) > _shared_tokens.most:
        _shared_tokens.clear()
    places = _shared_tokens.of(tail)
    facts = [_shared_tokens.facts[i] for i in places]
    last = next((i for i in range(len(facts) - 1, -1, -1) if facts[i][3]), None)
    if last is not None:
        hashes = np.array([facts[i][1] if i == 0 or facts[i - 1][5] else facts[i][0] for i in range(max(0, last - 2), last + 1)], np.uint64)
        for n in range(1, len(hashes) + 1):
            at = int(gram_bucket(n, [hashes[len(hashes) - n + k : len(hashes) - n + k + 1] for k in range(n)])[0])
            level = max(-6, min(6, round(float(stats.log_ratio[at]))))
            out += [f"g{n} {shut} {at}", f"q{n} {state} {level}"]
            if n == 3:
                out.append(f"p {kind} {bool(stats.phrase[at])}")
        known = int(stats.known[facts[last][2] & (WORD_BUCKETS - 1)])
        degree = "0" if known == 0 else "1" if known < 2 else "2" if known < 6 else "3"
        name = facts[last][0] == _NAME and not (last == 0 or facts[last - 1][5])
        out += [f"k {state} {degree}", f"k {state} {degree} {name}"]
    sentence = re.split(r"(?<=[.!?])\s+", tail)[-1].split(" ", 2)[0]
    since = next((k for k in range(1, len(facts)) if facts[len(facts) - 1 - k][4]), len(facts))
    out += [f"o {state} {sentence}", f"o {state} {since <= 4}"]
    return [bucket(x, FEATURE_BUCKETS) for x in out]


_NAME = zlib.crc32(b"N")
WIDTH = 24


def matrix(rows: list[list[int]]) -> np.ndarray:
    """Feature ids padded to WIDTH with the unused last bucket."""
    out = np.full((len(rows), WIDTH), FEATURE_BUCKETS, np.int32)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r[:WIDTH]
    return out


def fit(x: np.ndarray, y: np.ndarray, epochs: int = 12, rate: float = 0.15, l2: float = 1e-6, seed: int = 7) -> np.ndarray:
    """Weights of a logistic regression by mini-batch Adagrad; the bucket for padding stays 0."""
    rng = np.random.default_rng(seed)
    w, g2 = np.zeros(FEATURE_BUCKETS + 1), np.full(FEATURE_BUCKETS + 1, 1e-3)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for s in range(0, len(y), 256):
            at = order[s : s + 256]
            error = probability(x[at], w) - y[at]
            ids, inverse = np.unique(x[at], return_inverse=True)
            g = np.bincount(inverse.ravel(), weights=np.repeat(error, WIDTH), minlength=len(ids)) + l2 * w[ids]
            g2[ids] += g * g
            w[ids] -= rate * g / np.sqrt(g2[ids])
            w[FEATURE_BUCKETS] = 0
    return w


def probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(w[x].sum(axis=1), -30, 30)))


def ends_in_a_phrase(body: str, stats: Statistics) -> bool:
    """Whether the last three words of a body before a mark belong to it."""
    if len(_shared_tokens.facts) > _shared_tokens.most:
        _shared_tokens.clear()
    facts = [_shared_tokens.facts[i] for i in _shared_tokens.of(body[-160:])]
    if len(facts) < 3 or not facts[-1][3]:
        return False
    hashes = [np.array([facts[i][1] if i == 0 or facts[i - 1][5] else facts[i][0]], np.uint64) for i in range(len(facts) - 3, len(facts))]
    return bool(stats.phrase[int(gram_bucket(3, hashes)[0])])


def looks_intact(text: str, limit: str, stats: Statistics) -> bool:
    body, kind = split_tail(text)
    whole = ends_like_a_sentence(text) if kind == "none" else ends_in_a_phrase(body, stats)
    return whole and len(text) >= 80 and limit == "far"


def examples(intact: list[str], stats: Statistics, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels from intact values: each whole, varied, and cut in several ways."""
    rng = np.random.default_rng(seed)
    x, y = [], []

    def add(text: str, label: int, limit: str = "far") -> None:
        x.append(features(text, limit, stats))
        y.append(label)

    for text in intact:
        whole = text.rstrip()
        add(text, 0)
        open_end = whole.rstrip(".") if whole.endswith(".") else whole
        add(open_end, 0)
        if rng.random() < 0.2:
            add(open_end + "  ", 0)
        if rng.random() < 0.2:
            add(whole + "  ", 0)
        for _ in range(2):
            kind = rng.random()
            at = int(rng.integers(min(40, len(whole) // 2), len(whole) - 1))
            if kind < 0.3 and stats.limits:
                unit, limit = stats.limits[int(rng.integers(len(stats.limits)))]
                cut = text[:limit] if unit == "chars" else text.encode("utf-8", "replace")[:limit].decode("utf-8", "ignore")
                if len(cut) < len(whole) - 1:
                    add(cut, 1, "at" if unit == "chars" or len(cut.encode("utf-8", "replace")) == limit else "near")
                    continue
            piece = whole[:at]
            if kind < 0.5:
                space = piece.rfind(" ")
                piece = piece[: space if space > 20 else at].rstrip(" ,;:")
                if not ends_like_a_sentence(piece):
                    add(piece + OMISSIONS[int(rng.integers(len(OMISSIONS)))], 1)
                    continue
            if kind < 0.6:
                add(piece + (" " if rng.random() < 0.5 else "") + BROKEN_TAILS[int(rng.integers(len(BROKEN_TAILS)))], 1)
            elif not ends_like_a_sentence(piece):
                add(piece, 1)
    return matrix(x), np.array(y, np.float64)


def train(values: DataFrame, stats: Statistics, sample: int) -> np.ndarray:
    """Weights from at most `sample` values, chosen by the hash of their text; all 0 where nothing looks intact.

    A first model learns from values that end like sentences. It tells which of the values with rarer endings are intact
    as well, and the second model learns from both.
    """
    chosen = values.orderBy(F.xxhash64("text"), "text", "limit").limit(sample).collect()
    distinct = list(dict.fromkeys((r["limit"], r["text"]) for r in chosen))
    intact = [t for limit, t in distinct if looks_intact(t, limit, stats)]
    if not intact:
        return np.zeros(FEATURE_BUCKETS + 1)
    w = fit(*examples(intact, stats))
    p = probability(matrix([features(t, limit, stats) for limit, t in distinct]), w)
    return fit(*examples([t for (_, t), score in zip(distinct, p) if score < 0.5], stats))


def _scorer(shared) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stats, w = shared.value
        for batch in batches:
            if batch.num_rows:
                texts, limits = batch.column(2).to_pylist(), batch.column(3).to_pylist()
                p = probability(matrix([features(t, limit, stats) for t, limit in zip(texts, limits)]), w)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p, pa.float64())], ["rec_id", "source", "score"])

    return score


def truncated(df: DataFrame, rec_id: str, source: str, text: str, sample: int = 10_000) -> DataFrame:
    """(rec_id, source, score): for every value that is neither null nor blank, the probability that its end is missing.

    A record delivered twice is scored once per delivery, alike. Null sources form a source of their own. An empty table,
    or one where no value looks intact, gives scores of 0.5 or no rows. Other columns are not looked at.
    """
    values = df.select(F.col(f"`{rec_id}`").alias("rec_id"), F.col(f"`{source}`").cast("string").alias("source"), F.col(f"`{text}`").alias("text"))
    values = values.where(F.col("text").isNotNull() & (F.btrim("text") != ""))
    limits = staged(length_limits(values.select("source", F.length("text").alias("chars"), F.octet_length("text").alias("bytes"))), "lengths")
    stats = gather(values, limits)
    placed = with_distance(values, limits)
    shared = df.sparkSession.sparkContext.broadcast((stats, train(placed.select("text", "limit"), stats, sample)))
    kind = values.schema["rec_id"].dataType.simpleString()
    return placed.mapInArrow(_scorer(shared), f"rec_id {kind}, source string, score double")
