"""Evaluation items in training text: a BM25 index of the items, block-max WAND over all passages, exact verification.

The test items are the indexed side, in shards of at most `shard_items` with one vocabulary; every document is a stream of
passages that query all shards in one pass, split into words once. Two ways to match are looked for, each with passages long enough to hold any match whole:

- a run of `run` shared words: passages of 2 * run words, one every run + 1 words;
- `share` of the item's words in order within `stretch` times its length: for items of up to L words (a power of two),
  passages of 2 * stretch * L words, one every stretch * L words.

Terms of the first way are shingles of GRAM words (a shared run holds run - GRAM + 1 of them in a row), those of the second
single words. Impacts are BM25 weights of (term, item). The retrieval threshold of an item is the least score that a match can have
(the lightest run of words; the lightest choice of `share` of its words), and impacts are divided by it, so one threshold,
1, holds for all items and no match scores less. Block-max WAND is evaluated for many passages at once: prefix sums of
the block maxima bound every (passage, block) pair from above; only blocks whose bound reaches 1 are opened and scored
with distinct terms; the (passage, item) pairs that reach 1 are verified on the words themselves.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm.words import words

#: BM25's usual parameters.
K1, B = 1.2, 0.75

#: Words in a term of the index for runs.
GRAM = 3

#: Items per block of the block-max index.
BLOCK = 8

#: Slack for sums of 32-bit floats.
SLACK = 1e-3


@dataclass
class Way:
    """One way to match; runs: by shared runs. keys: sorted codes of the terms. chosen: items it is for. impacts [term, place in chosen], maxima [term, block]."""

    runs: bool
    gram: int
    length: int
    step: int
    keys: np.ndarray
    chosen: np.ndarray
    impacts: np.ndarray
    maxima: np.ndarray


@dataclass
class Index:
    """One shard of distinct items, with its ways to match. vocabulary: of `size` words, may be shared."""

    vocabulary: dict[str, int]
    size: int
    items: list[list[str]]
    ways: list[Way]
    grams: dict[tuple[str, ...], list[int]]
    masks: list[dict[str, int]] = field(default_factory=list)


def least_run(terms: list[int], weight: dict[int, float], run: int) -> float:
    """The least total weight of the distinct terms in any `run` consecutive ones."""
    return min(sum(weight[t] for t in set(terms[s : s + run])) for s in range(len(terms) - run + 1))


def least_share(term_weight: dict[int, float], count: Counter, need: int) -> float:
    """A lower bound of the weight of the distinct words in any `need` positions: leave out the heaviest, by weight per position."""
    spare = sum(count.values()) - need
    total = sum(term_weight[t] for t in count)
    for t in sorted(count, key=lambda t: -term_weight[t] / count[t]):
        if spare <= 0:
            break
        out = min(spare, count[t])
        total -= term_weight[t] * out / count[t]
        spare -= out
    return total


def codes(ids: np.ndarray, gram: int, size: int, ends: np.ndarray) -> np.ndarray:
    """One number per position for the `gram` words that start there; -1 where one is unknown (id size) or the text ends before."""
    out = np.full(len(ids), -1, np.int64)
    n = len(ids) - gram + 1
    if n <= 0:
        return out
    code, known = np.zeros(n, np.int64), np.ones(n, bool)
    for j in range(gram):
        part = ids[j : n + j]
        code = code * (size + 1) + part
        known &= part != size
    crossing = np.zeros(len(ids) + gram, bool)
    starts = np.append(0, ends[:-1])
    for j in range(1, gram):
        at = ends - j
        crossing[at[at >= starts]] = True  # texts without words mark nothing
    known &= ~crossing[:n]
    out[:n][known] = code[known]
    return out


def build_index(items: list[list[str]], run: int, share: float, stretch: int, vocabulary: dict[str, int] | None = None, size: int | None = None) -> Index:
    """The index of distinct, not empty word lists. vocabulary (of `size` words) may be one that several shards share."""
    vocabulary = {} if vocabulary is None else vocabulary
    ids = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in x], np.int64) for x in items]
    n, size = len(items), size or len(vocabulary)

    def way(by_run: bool, chosen: list[int], gram: int, length: int, step: int, least: Callable[[list[int], dict[int, float]], float]) -> Way:
        terms = [codes(x, gram, size, np.array([len(x)])) for x in ids]
        terms = [x[x >= 0].tolist() for x in terms]
        df = Counter(t for x in terms for t in set(x))
        idf = {t: math.log(1 + (n - d + 0.5) / (d + 0.5)) for t, d in df.items()}
        average = sum(map(len, terms)) / max(1, n)
        keys = np.array(sorted({t for k in chosen for t in terms[k]}), np.int64)
        row = {t: i for i, t in enumerate(keys.tolist())}
        # items that share their rarest terms stand in one block, so that its maxima stay low for other passages
        chosen = sorted(chosen, key=lambda k: sorted(((idf[t], t) for t in set(terms[k])), reverse=True)[:4])
        impacts = np.zeros((len(keys), len(chosen)), np.float32)
        for column, k in enumerate(chosen):
            length_norm = K1 * (1 - B + B * len(terms[k]) / average)
            weight = {t: idf[t] * tf * (K1 + 1) / (tf + length_norm) for t, tf in Counter(terms[k]).items()}
            at = max(least(terms[k], weight), 1e-9)
            for t, w in weight.items():
                impacts[row[t], column] = w / at
        maxima = np.stack([impacts[:, s : s + BLOCK].max(axis=1) for s in range(0, len(chosen), BLOCK)], axis=1)
        return Way(by_run, gram, length, step, keys, np.array(chosen, np.int64), impacts, np.ascontiguousarray(maxima))

    ways = []
    gram = min(GRAM, run)
    if runs := [k for k, x in enumerate(ids) if len(x) >= run]:
        ways.append(way(True, runs, gram, 2 * run, run + 1, lambda x, w: least_run(x, w, run - gram + 1)))
    classes: dict[int, list[int]] = defaultdict(list)
    for k, x in enumerate(ids):
        classes[1 << max(0, (len(x) - 1).bit_length())].append(k)
    for longest, chosen in sorted(classes.items()):
        ways.append(way(False, chosen, 1, 2 * stretch * longest, stretch * longest, lambda x, w: least_share(w, Counter(x), math.ceil(share * len(x)))))
    grams: dict[tuple[str, ...], list[int]] = defaultdict(list)
    for k, x in enumerate(items):
        for s in range(len(x) - run + 1):
            if k not in grams[g := tuple(x[s : s + run])]:
                grams[g].append(k)
    masks: list[dict[str, int]] = []
    for x in items:
        mask: dict[str, int] = defaultdict(int)
        for i, w in enumerate(x):
            mask[w] |= 1 << i
        masks.append(dict(mask))
    return Index(vocabulary, size, items, ways, dict(grams), masks)


def common_in_order(mask: dict[str, int], length: int, text: list[str]) -> int:
    """Length of the longest common subsequence of an item (by its word masks) and text, bit-parallel."""
    full = (1 << length) - 1
    v = full
    for w in text:
        m = mask.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return length - v.bit_count()


def stands_in_order(mask: dict[str, int], length: int, text: list[str], need: int, longest: int) -> bool:
    """Whether `need` words of the item stand in order within some stretch of at most `longest` words of text."""
    at = [i for i, w in enumerate(text) if w in mask]
    if len(at) < need:
        return False
    short = [text[i] for i in at]
    if common_in_order(mask, length, short) < need:
        return False
    end = 0
    for a, start in enumerate(at):
        while end < len(at) and at[end] < start + longest:
            end += 1
        if end - a >= need and common_in_order(mask, length, short[a:end]) >= need:
            return True
    return False


def passages(n: int, length: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of passages over n words; the last reaches the end, so each stretch of length - step + 1 words lies in one."""
    starts = np.arange(0, max(1, n - length + step), step)
    return starts, np.minimum(starts + length, n)


#: Positions of known terms whose block maxima are summed at once; a passage with more is summed on its own.
POSITIONS_AT_ONCE = 1 << 16


def candidates(way: Way, code: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(document, item, start, end): all passages of the documents [bounds[d]:bounds[d + 1]] and items that may match. code: of the way's terms, by position."""
    row = np.searchsorted(way.keys, code)
    row[row == len(way.keys)] = 0
    at = np.flatnonzero(way.keys[row] == code)  # positions with a term of the index; all others weigh nothing
    if not len(at):
        return
    row = row[at]
    touched = np.unique(np.searchsorted(bounds, at, side="right") - 1)
    spans = [(d, *passages(bounds[d + 1] - bounds[d], way.length, way.step)) for d in touched]
    doc = np.concatenate([np.full(len(s), d) for d, s, _ in spans])
    start = np.concatenate([s + bounds[d] for d, s, _ in spans])
    end = np.concatenate([e + bounds[d] for d, _, e in spans])
    first, last = np.searchsorted(at, start), np.searchsorted(at, end - way.gram + 1)
    last = np.maximum(first, last)
    begun = 0
    while begun < len(doc):
        until = max(begun + 1, int(np.searchsorted(last, first[begun] + POSITIONS_AT_ONCE, side="right")))
        low, high = first[begun], last[begun:until].max()
        sums = np.zeros((high - low + 1, way.maxima.shape[1]))
        np.cumsum(way.maxima[row[low:high]], axis=0, out=sums[1:])
        may = sums[last[begun:until] - low] - sums[first[begun:until] - low] >= 1 - SLACK
        for p in begun + np.flatnonzero(may.any(axis=1)):
            terms = np.unique(row[first[p] : last[p]])
            for b in np.flatnonzero(may[p - begun]):
                # the bound counted repeated terms; with distinct ones the block may fall out before any item is scored
                if way.maxima[terms, b].sum() < 1 - SLACK:
                    continue
                scores = way.impacts[terms, b * BLOCK : (b + 1) * BLOCK].sum(axis=0)
                for c in np.flatnonzero(scores >= 1 - SLACK):
                    yield int(doc[p]), int(way.chosen[b * BLOCK + c]), int(start[p]), int(end[p])
        begun = until


def matches(shards: list[Index], texts: list[list[str]], run: int, share: float, stretch: int) -> list[tuple[int, int, int]]:
    """(document, shard, item) for each verified match, each once. The shards have one vocabulary, so words are looked up once."""
    if not shards:
        return []
    get, size = shards[0].vocabulary.get, shards[0].size
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
    ids = np.fromiter((get(w, size) for x in texts for w in x), np.int64, int(bounds[-1]))
    by_gram = {gram: codes(ids, gram, size, bounds[1:]) for gram in {way.gram for index in shards for way in index.ways}}
    found: set[tuple[int, int, int]] = set()
    for k, index in enumerate(shards):
        for way in index.ways:
            for d, item, s, e in candidates(way, by_gram[way.gram], bounds):
                if (d, k, item) in found:
                    continue
                text = texts[d][s - bounds[d] : e - bounds[d]]
                if way.runs:
                    hit = any(item in index.grams.get(tuple(text[i : i + run]), ()) for i in range(len(text) - run + 1))
                else:
                    n = len(index.items[item])
                    hit = stands_in_order(index.masks[item], n, text, math.ceil(share * n), stretch * n)
                if hit:
                    found.add((d, k, item))
    return sorted(found)


def parts_of_item(text: str) -> tuple[str, str]:
    """Question and answer of an item: up to the first question mark or full stop, and what follows the last `label:`."""
    ends = [i for i in (text.find("?"), text.find(". ")) if i >= 0]
    cut = min(ends) + 1 if ends else len(text)
    colon = text.rfind(": ")
    return text[:cut], text[colon + 2 :] if colon >= cut else ""


def covered(part: list[str], text: list[str], n: int = 3) -> float:
    """Share of the n-word shingles of part that text holds (of its words if it is shorter)."""
    n = min(n, len(part))
    if not n:
        return 0.0
    held = {tuple(text[i : i + n]) for i in range(len(text) - n + 1)}
    return sum(tuple(part[i : i + n]) in held for i in range(len(part) - n + 1)) / (len(part) - n + 1)


#: Words of documents that are looked at together; a longer document is looked at on its own.
WORDS_AT_ONCE = 100_000


def slices(sizes: list[int], most: int = WORDS_AT_ONCE) -> Iterator[tuple[int, int]]:
    """Spans of neighbouring documents with at most so many words together."""
    begun, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield begun, i
            begun, held = i, 0
        held += n
    if begun < len(sizes):
        yield begun, len(sizes)


def _searcher(shared, run: int, share: float, stretch: int) -> Callable:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, members, parts = shared.value
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                every = [words(x) for x in part.column(1).to_pylist()]
                for s, e in slices([len(x) for x in every]):
                    texts = every[s:e]
                    rows = [(d, i) for d, k, item in matches(shards, texts, run, share, stretch) for i in members[k][item]]
                    if rows:
                        question, answer = zip(*((covered(parts[i][0], texts[d]), covered(parts[i][1], texts[d])) for d, i in rows))
                        columns = [part.column(0).take(pa.array([s + d for d, _ in rows])), pa.array([i for _, i in rows], pa.int64())]
                        yield pa.RecordBatch.from_arrays([*columns, pa.array(question, pa.float64()), pa.array(answer, pa.float64())], ["doc_id", "item_id", "question_share", "answer_share"])

    return search


def leaked_items(docs: DataFrame, items: DataFrame, run: int = 10, share: float = 0.75, stretch: int = 2, shard_items: int = 256, words_at_once: int = 100_000) -> DataFrame:
    """(doc_id, item_id, question_share, answer_share) for every document that holds an item, whole or in part.

    docs has doc_id and text, items has item_id and text; further columns are not looked at. A pair is found if both share
    `run` consecutive words, or if `share` of the item's words stand in its order within `stretch` times its length.
    The two shares tell how much of the item's question and answer the document holds. Null, empty and wordless texts
    match nothing; items with equal words are found alike; repeated rows are found once. Items are indexed in shards of
    shard_items that one pass over the documents searches together; beyond words_at_once words of items there is a further
    pass, so what is broadcast is bounded (an impact takes 4 bytes, so some 4 * shard_items * words_at_once). An empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id bigint, question_share double, answer_share double"
    narrow = docs.select("doc_id", "text").where("text is not null")
    found, some = [], []

    def close() -> None:
        same: dict[tuple[str, ...], list[int]] = defaultdict(list)
        for i, text in some:
            if w := words(text):
                same[tuple(w)].append(i)
        if same:
            vocabulary: dict[str, int] = {}
            for w in same:
                for x in w:
                    vocabulary.setdefault(x, len(vocabulary))
            distinct = list(same)
            cut = range(0, len(distinct), shard_items)
            shards = [build_index([list(w) for w in distinct[s : s + shard_items]], run, share, stretch, vocabulary, len(vocabulary)) for s in cut]
            members = [[same[w] for w in distinct[s : s + shard_items]] for s in cut]
            parts = {i: tuple(words(p) for p in parts_of_item(text)) for i, text in some}
            found.append(narrow.mapInArrow(_searcher(spark.sparkContext.broadcast((shards, members, parts)), run, share, stretch), schema))
        some.clear()

    held = 0
    for row in items.select(F.col("item_id").cast("bigint"), "text").where("item_id is not null and text is not null").distinct().toLocalIterator():
        some.append((row[0], row[1]))
        held += len(words(row[1]))
        if held >= words_at_once:
            close()
            held = 0
    close()
    if not found:
        return spark.createDataFrame([], schema)
    every = found[0]
    for x in found[1:]:
        every = every.unionByName(x)
    return every.groupBy("doc_id", "item_id").agg(F.max("question_share").alias("question_share"), F.max("answer_share").alias("answer_share"))
