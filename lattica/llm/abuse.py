"""Abusive, hateful or sexual sentences: votes of the nearest labelled examples by exact TF-IDF cosine.

Every text is brought to a plain spelling (look-alike letters, hidden characters, spaced-out, doubled and starred letters)
and read sentence by sentence. Examples are the sentences of reviewed documents. A review is of a whole document, and
reviewers err, so a sentence's label is the probability that it made its document a case: a document is one if any of its
sentences is, and a review tells so but for the share of slips that doubly reviewed documents show. The probabilities are
found by expectation-maximisation, each sentence's prior being the vote of its nearest neighbours from other documents.
A vote is shrunk towards harmless by the weight of a far neighbour, so weak likeness convinces nobody.

Sentences of a corpus document are voted on alike; the document scores as its worst sentence. The votes left out of each
reviewed document's own examples calibrate the scores by their slope alone: even odds stay even odds, so the calibration
cannot move the cut into a mass of harmless documents.

Cosines are exact: examples lie in blocks of an inverted index with the maximum weight of each term per block, which
bounds all cosines of a block from above; blocks that cannot hold a neighbour are not opened. Scores are exact too, those
below even odds as well: a sentence is left unsearched only where another one of its document provably votes as much, as
without a neighbour above the prior no vote is above it, and without any neighbour it is the prior. Where only documents
from some score on are asked for, sentences are left out that cannot reach it with no harmless example near them.

Term statistics cover the sentences of all documents (hashed to a fixed number of buckets). The examples are bounded:
`max_docs` reviewed documents of either kind and `max_examples` sentences, kept by the hash of the document's id; the
votes of either kind are weighted up to all of it.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.session import staged

#: Buckets of hashed terms.
BUCKETS = 1 << 19

#: Documents whose sentences vote, examples searched for them, and the least cosine for a vote.
NEIGHBOURS, NEAREST, LEAST = 16, 32, 0.35

#: Weight of the harmless prior in a vote, and the prior itself. A neighbour at cosine c weighs c ** 3.
SHRINK, PRIOR = 0.1, 0.01

#: Harmless support (weight of neighbours in negative documents) by which priors of reviewed sentences are learnt, and their upper bound.
SUPPORT, MOST_PRIOR = (0.1, 0.5, 2.0), 0.1

#: A sentence with the last harmless support is in question only if positive documents have this share of its votes.
IN_QUESTION = 0.2

#: Share of disagreement assumed among doubly reviewed documents before any is seen, and the number of documents it stands for.
DISAGREE, DISAGREE_N = 0.11, 20

#: Rounds of expectation-maximisation.
ROUNDS = 40

#: Label of a sentence of a positive document from which like ones of negative documents are put in question too.
MAY_BE_GUILTY = 0.25

#: Examples in a block of the index.
BLOCK = 32

# Letters of other scripts that look like Latin ones, and signs written for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԛ": "q", "ԝ": "w",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ß": "ss", "ø": "o", "ł": "l", "đ": "d", "æ": "ae", "œ": "oe",
}
SIGNS = str.maketrans({"@": "a", "$": "s", "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "!": "i", "|": "i", "€": "e", "+": "t", "8": "b"})

#: Combining marks and characters without width, removed after decomposition.
HIDDEN = re.compile("[\u0300-\u036f\u00ad\u034f\u061c\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufe0f\ufeff]")
_LOOKALIKE = re.compile(f"[{''.join(LOOKALIKES)}]")

_TAG = re.compile(r"</?[a-z][^<>]{0,80}>|&[a-z]{2,8};|&#\d{1,6};", re.I)
_SPACED = re.compile(r"(?<![^\W_])[^\W\d_]([ .\-_*·/])[^\W\d_](?:\1[^\W\d_])+(?![^\W_])")
_MAY_BE_SIGNED = re.compile(r"[a-z][@$!|€+0134578*]+[a-z]|[@$][a-z]")
_DOUBLED = re.compile(r"([^\W\d_])\1+")
_SENTENCE = re.compile(r"(?<=[.!?…])[\"'”’)\]]*\s+|[\r\n]+")
_WORD = re.compile(r"[^\W\d_]+|\d+")


def _letters(word: str) -> str:
    """A word with its signs read as letters, if signs stand among its letters."""
    if not _MAY_BE_SIGNED.search(word):
        return word
    core = word.rstrip("!.,;:?")
    return core.translate(SIGNS).replace("*", "") + word[len(core) :]


def plain(text: str) -> str:
    """A text in plain spelling, lower case, without accents."""
    if "<" in text or "&" in text:
        text = _TAG.sub(" ", text)
    if not text.isascii():
        text = HIDDEN.sub("", unicodedata.normalize("NFD", unicodedata.normalize("NFKC", text))).lower()
        text = _LOOKALIKE.sub(lambda m: LOOKALIKES[m.group()], text)
    else:
        text = text.lower()
    text = _SPACED.sub(lambda m: m.group().replace(m.group(1), ""), text)
    return " ".join(map(_letters, text.split(" "))) if _MAY_BE_SIGNED.search(text) else text


def sentences(text: str | None) -> list[str]:
    """The sentences of a text in plain spelling; [] for null and blank ones."""
    if not text or text.isspace():
        return []
    return [s for s in (x.strip() for x in _SENTENCE.split(plain(text))) if s]


_known_words: dict[str, int] = {}


def _word_id(word: str) -> int:
    if len(_known_words) > 200_000:
        _known_words.clear()
    found = zlib.crc32(_DOUBLED.sub(r"\1", word).encode())
    _known_words[word] = found
    return found


def word_ids(sentence: str) -> list[int]:
    """Hashed words of a sentence in plain spelling; numbers are one word, doubled letters single."""
    get = _known_words.get
    return [get(w) or _word_id(w) for w in ("0" if w[0].isdigit() else w for w in _WORD.findall(sentence))]


def sentence_words(text: str | None) -> list[tuple[str, list[int]]]:
    """The distinct sentences of a text that have words, in order, with their words."""
    return [(s, w) for s in dict.fromkeys(sentences(text)) if (w := word_ids(s))]


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of every document's distinct sentences end to end, with the number of words of each sentence."""
    for batch in batches:
        for s in range(0, batch.num_rows, 512):  # bounds the lists held at once
            part = batch.slice(s, 512)
            words: list[int] = []
            sizes: list[int] = []
            word_ends, size_ends = [0], [0]
            for text in part.column(2).to_pylist():
                for _, found in sentence_words(text):
                    words += found
                    sizes.append(len(found))
                word_ends.append(len(words))
                size_ends.append(len(sizes))
            lists = [
                pa.ListArray.from_arrays(pa.array(word_ends, pa.int32()), pa.array(np.array(words, np.uint32).view(np.int32))),
                pa.ListArray.from_arrays(pa.array(size_ends, pa.int32()), pa.array(np.array(sizes, np.int32))),
            ]
            yield pa.RecordBatch.from_arrays([*part.columns, *lists], ["doc_id", "source", "text", "words", "sizes"])


def terms_of(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sentence number and term of every word, then of every pair of neighbouring words, of sentences laid end to end."""
    owner = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    w = words.astype(np.int32).view(np.uint32).astype(np.uint64)
    mask = np.uint64(BUCKETS - 1)
    pairs = (((w[:-1] * np.uint64(0x9E3779B1)) ^ ((w[1:] * np.uint64(0x85EBCA77)) >> np.uint64(7))) & mask).astype(np.int64)
    same = owner[1:] == owner[:-1]
    return np.concatenate([owner, owner[1:][same]]), np.concatenate([(w & mask).astype(np.int64), pairs[same]])


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, n = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        sizes = batch.column(1).flatten().to_numpy()
        if len(sizes):
            counts += np.bincount(terms_of(batch.column(0).flatten().to_numpy(), sizes)[1], minlength=BUCKETS)
            n += len(sizes)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(counts[at], n))], ["bucket", "n"])


def inverse_frequencies(read: DataFrame) -> np.ndarray:
    """Smoothed inverse frequency of each bucket, by its occurrences per sentence of all documents (columns words and sizes), at least 1."""
    found = read.select("words", "sizes").mapInArrow(_counter, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    bucket, n = found.column("bucket").to_numpy(), found.column("n").to_numpy()  # at most BUCKETS + 1 rows
    counts = np.zeros(BUCKETS)
    counts[bucket[bucket >= 0]] = n[bucket >= 0]
    total = n[bucket < 0].sum()
    return np.log((1 + total) / (1 + np.minimum(counts, total))).astype(np.float32) + 1


Vector = tuple[np.ndarray, np.ndarray]


def vectors_of(words: np.ndarray, sizes: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit TF-IDF vectors of many sentences, whose words lie end to end: sorted distinct terms, weights, bounds. No sentence may be empty."""
    of, term = terms_of(words, sizes)
    keys, tf = np.unique(of * BUCKETS + term, return_counts=True)
    owner, at = np.divmod(keys, BUCKETS)
    w = np.sqrt(tf) * idf[at]
    bounds = np.searchsorted(owner, np.arange(len(sizes) + 1))
    norm = np.sqrt(np.add.reduceat(w * w, bounds[:-1])) if len(sizes) else np.zeros(0)
    return at.astype(np.int32), (w / norm[owner]).astype(np.float32), bounds


def _spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The positions of many spans one after the other, and the lengths of the spans."""
    sizes = ends - starts
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes), sizes


class BlockMaxIndex:
    """Exact cosine search over unit vectors with block maxima: an inverted index from terms to blocks, and from both to examples."""

    def __init__(self, at: np.ndarray, weights: np.ndarray, bounds: np.ndarray, common: int = 8):
        self.n = len(bounds) - 1
        seen = np.bincount(at, minlength=BUCKETS)
        # like with like: sentences with the same heaviest terms among those that recur lie together
        owner = np.repeat(np.arange(self.n), np.diff(bounds))
        by = np.lexsort((at, -np.where(seen[at] >= common, weights, weights - 2), owner))
        rank = np.arange(len(at)) - bounds[owner]
        first = [np.zeros(self.n, np.int64) for _ in range(3)]
        for k in range(3):
            at_k = np.flatnonzero(rank == k)
            first[k][owner[at_k]] = at[by][at_k] + 1
        self.order = np.lexsort(first[::-1]).astype(np.int32)
        place = np.empty(self.n, np.int64)
        place[self.order] = np.arange(self.n)
        self.blocks = -(-self.n // BLOCK)
        # postings by term and place, and the lists of one term and block among them
        postings = np.lexsort((place[owner], at))
        self.place, self.weights = place[owner][postings].astype(np.int32), weights[postings]
        term = at[postings].astype(np.int64)
        new = np.flatnonzero(np.diff(np.append(-1, term * max(1, self.blocks) + self.place // BLOCK)))
        self.in_block = self.place[new] // BLOCK
        self.starts = np.append(new, len(postings)).astype(np.int64)
        self.maxima = np.maximum.reduceat(self.weights, new) if len(new) else np.zeros(0, np.float32)
        self.head = np.searchsorted(term[new], np.arange(BUCKETS + 1)).astype(np.int32)  # term -> its lists
        self.any = np.zeros(BUCKETS, np.float32)
        np.maximum.at(self.any, term[new], self.maxima)
        self.rank = np.random.default_rng(5).permutation(self.n)  # equal cosines: neither early nor late documents first

    def lists(self, query: Vector) -> tuple[np.ndarray, np.ndarray]:
        """The lists of a query's terms, and the query's weight for each."""
        lists, sizes = _spans(self.head[query[0]], self.head[query[0] + 1])
        return lists, np.repeat(query[1], sizes)

    def bounds(self, query: Vector) -> np.ndarray:
        """Upper bound of the cosine with any example of each block."""
        lists, weight = self.lists(query)
        return np.bincount(self.in_block[lists], weights=self.maxima[lists] * weight, minlength=self.blocks)

    def may_reach(self, ids: np.ndarray, weights: np.ndarray, bounds: np.ndarray, least: float) -> np.ndarray:
        """Which of many vectors, laid end to end, may have a cosine of `least` with some example: by the maxima of all blocks, then by each block's."""
        some = np.flatnonzero(np.add.reduceat(weights * self.any[ids], bounds[:-1]) >= least - 1e-6)
        kept = []
        for s in range(0, len(some), 1024):  # bounds the products held at once
            part = some[s : s + 1024]
            at, sizes = _spans(bounds[:-1][part], bounds[1:][part])
            positions, per = _spans(self.head[ids[at]], self.head[ids[at] + 1])
            of = np.repeat(np.repeat(np.arange(len(part)), sizes), per)
            most = np.bincount(of * self.blocks + self.in_block[positions], weights=self.maxima[positions] * np.repeat(weights[at], per), minlength=len(part) * self.blocks)
            kept.append(part[most.reshape(len(part), self.blocks).max(axis=1) >= least - 1e-6])
        return np.concatenate(kept) if kept else some

    def search(self, query: Vector, k: int, least: float, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Examples and cosines of the k nearest with at least `least`, nearest first; `without`: examples left out."""
        lists, weight = self.lists(query)
        of = self.in_block[lists]
        bound = np.bincount(of, weights=self.maxima[lists] * weight, minlength=self.blocks)
        found_ids: list[np.ndarray] = []
        found_cos: list[np.ndarray] = []
        worst, held, at, step = least, 0, 0, 8
        blocks = np.flatnonzero(bound >= least - 1e-6)
        blocks = blocks[np.argsort(-bound[blocks])]
        number = np.full(self.blocks, -1, np.int64)
        while at < len(blocks) and bound[blocks[at]] >= worst - 1e-6:
            some = blocks[at : at + step]
            number[some] = np.arange(len(some))
            mine = np.flatnonzero(number[of] >= 0)
            positions, sizes = _spans(self.starts[lists[mine]], self.starts[lists[mine] + 1])
            place = self.place[positions]
            cos = np.bincount(number[place // BLOCK] * BLOCK + place % BLOCK, weights=self.weights[positions] * np.repeat(weight[mine], sizes), minlength=len(some) * BLOCK)
            number[some] = -1
            at, step = at + step, min(128, 2 * step)
            near = np.flatnonzero(cos >= max(worst, least) - 1e-6)
            ids, near = self.order[some[near // BLOCK] * BLOCK + near % BLOCK], cos[near]
            if without is not None:
                ids, near = ids[~without[ids]], near[~without[ids]]
            if len(ids):
                found_ids.append(ids)
                found_cos.append(near)
                held += len(ids)
                if held >= k:
                    every = np.concatenate(found_cos)
                    worst = max(worst, float(np.partition(every, len(every) - k)[len(every) - k]))
        if not found_ids:
            return np.zeros(0, np.int32), np.zeros(0, np.float32)
        ids, cos = np.concatenate(found_ids), np.concatenate(found_cos).astype(np.float32)
        ids, cos = ids[cos >= least], cos[cos >= least]
        best = np.lexsort((self.rank[ids], -np.round(cos, 5)))[:k]
        return ids[best], cos[best]


@dataclass
class Model:
    """blamed: index of the examples with a label above cut; beyond: how far their votes are above; every: index of all examples.

    labels, owner (document) and weights (votes that it stands for) of all examples; texts of the guilty ones (label above
    even odds); slope and floor of the calibration; cut: vote from which sentences are asked for, PRIOR if all are.
    """

    idf: np.ndarray
    blamed: BlockMaxIndex
    beyond: np.ndarray
    every: BlockMaxIndex | None
    labels: np.ndarray
    owner: np.ndarray
    weights: np.ndarray
    texts: dict[int, str]
    slope: float = 1.0
    floor: float = 0.0
    cut: float = PRIOR


def neighbours(index: BlockMaxIndex, query: Vector, owner: np.ndarray, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The nearest example of each of the nearest documents, and its cosine."""
    ids, cos = index.search(query, NEAREST, LEAST, without)
    _, first = np.unique(owner[ids], return_index=True)
    first = np.sort(first)[:NEIGHBOURS]
    return ids[first], cos[first]


def vote(cos: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """Distance-weighted share of guilt, shrunk towards the prior by the weight of a far neighbour."""
    w = cos.astype(np.float64) ** 3 * weights
    return float(((w * labels).sum() + SHRINK * PRIOR) / (w.sum() + SHRINK))


def slips(n: np.ndarray, cases: np.ndarray) -> float:
    """Share of reviews that are slips, from the documents whose reviewers disagree."""
    twice = n >= 2
    pairs = (n * (n - 1) / 2)[twice].sum()
    differ = (cases * (n - cases))[twice].sum()
    return float((1 - np.sqrt(1 - 2 * min(0.48, (differ + DISAGREE * DISAGREE_N) / (pairs + DISAGREE_N)))) / 2)


def likelihoods(n: np.ndarray, cases: np.ndarray, slip: float) -> tuple[np.ndarray, np.ndarray]:
    """How likely the reviews of each document are if it is a case, and if it is none; the larger is 1."""
    log_odds = (2 * cases - n) * np.log((1 - slip) / slip)
    return np.exp(np.minimum(log_odds, 0)), np.exp(np.minimum(-log_odds, 0))


def explain(near: list[tuple[np.ndarray, np.ndarray]], owner: np.ndarray, asked: np.ndarray, weights: np.ndarray, n: np.ndarray, cases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels of sentences from the reviews of documents, and the votes on them.

    near: neighbours (from other documents) of the sentences in question, asked; all others are harmless. A document is a
    case if any sentence is guilty, so sentences of one document share its blame by what their neighbours say of them;
    a case that a known sentence explains says little about the others. Priors are learnt by harmless support: a sentence
    of a kind that many negative documents hold is hardly ever guilty.
    """
    labels, votes = np.zeros(len(owner)), np.zeros(len(owner))
    if not len(asked):
        return labels, votes
    is_case, is_none = likelihoods(n, cases, slips(n, cases))
    sizes = np.array([len(ids) for ids, _ in near])
    seg = np.repeat(np.arange(len(asked)), sizes)
    ids = np.concatenate([i for i, _ in near])
    w = np.concatenate([c for _, c in near]).astype(np.float64) ** 3 * weights[ids]
    sums = lambda x: np.bincount(seg, weights=x, minlength=len(asked))
    support = np.digitize(sums(w * (1 - cases / n)[owner[ids]]), SUPPORT)
    total, doc = sums(w), owner[asked]
    prior = np.full(len(SUPPORT) + 1, 2 * PRIOR)
    labels[asked] = prior[0]
    for _ in range(ROUNDS):
        q = np.clip((sums(w * labels[ids]) + SHRINK * prior[support]) / (total + SHRINK), 1e-6, 1 - 1e-6)
        none = np.exp(np.bincount(doc, weights=np.log1p(-q), minlength=len(n)))
        labels[asked] = (q * is_case[doc]) / (none * is_none + (1 - none) * is_case)[doc]
        learnt = np.bincount(support, weights=labels[asked], minlength=len(prior)) + 0.2
        prior = np.minimum(MOST_PRIOR, learnt / (np.bincount(support, minlength=len(prior)) + 10))
    votes[asked] = (sums(w * labels[ids]) + SHRINK * PRIOR) / (total + SHRINK)
    return labels, votes


def calibration(raw: np.ndarray, n: np.ndarray, cases: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and floor of floor + (1 - floor) * logistic(slope * logit(raw)) that fit the reviews best, slips allowed for; the slope is held near 1."""
    is_case, is_none = likelihoods(n, cases, slips(n, cases))
    x = np.log(np.clip(raw, 1e-4, 1 - 1e-4) / (1 - np.clip(raw, 1e-4, 1 - 1e-4)))
    best = (np.inf, 1.0, 0.0)
    for slope in np.linspace(0.3, 2.5, 45):
        p = 1 / (1 + np.exp(-slope * x))
        for floor in (0.0005, 0.001, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1):
            q = floor + (1 - floor) * p
            cost = 2 * (slope - 1) ** 2 - (weight * np.log(q * is_case + (1 - q) * is_none)).sum()
            best = min(best, (cost, float(slope), floor))
    return best[1], best[2]


def calibrated(raw: float, model: Model) -> float:
    """Probability of a case; 0 without examples of cases."""
    if not model.blamed.n and not len(model.labels):  # nothing was learnt
        return 0.0
    raw = min(max(raw, 1e-4), 1 - 1e-4)
    return model.floor + (1 - model.floor) / (1 + ((1 - raw) / raw) ** model.slope)


def vote_at(score: float, slope: float, floor: float) -> float:
    """The vote that is calibrated to a score, PRIOR at least."""
    p = (score - floor) / (1 - floor)
    if p <= 0:
        return PRIOR
    return max(PRIOR, 1.0 if p >= 1 else 1 / (1 + ((1 - p) / p) ** (1 / slope)) - 1e-6)


Found = list[tuple[np.ndarray, np.ndarray]]
Vectors = tuple[np.ndarray, np.ndarray, np.ndarray]


def search_all(index: BlockMaxIndex, vectors: Vectors, spans: np.ndarray, owner: np.ndarray, asked: np.ndarray) -> Found:
    """Neighbours of the asked examples from other documents."""
    at, w, bounds = vectors
    without = np.zeros(index.n, bool)
    return [_others(index, (at[bounds[i] : bounds[i + 1]], w[bounds[i] : bounds[i + 1]]), spans, owner, i, without) for i in asked]


def _others(index: BlockMaxIndex, query: Vector, spans: np.ndarray, owner: np.ndarray, i: int, without: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own = slice(spans[owner[i]], spans[owner[i] + 1])
    without[own] = True
    found = neighbours(index, query, owner, without)
    without[own] = False
    return found


def _part(vectors: Vectors, chosen: np.ndarray) -> BlockMaxIndex:
    at, w, bounds = vectors
    positions, sizes = _spans(bounds[:-1][chosen], bounds[1:][chosen])
    return BlockMaxIndex(at[positions], w[positions], np.append(0, np.cumsum(sizes)))


def train(reviewed: list[tuple[object, str, float, int]], idf: np.ndarray, n_positive: int, n_negative: int, max_examples: int = 120_000, searching: Callable[..., Found] = search_all, least: float = 0.0) -> Model:
    """The model from reviewed documents (id, text, share of reviewers that saw a case, number of reviewers).

    Documents become examples in the order given until max_examples sentences are reached, a third of them from positive
    documents. n_positive, n_negative: reviewed documents of either kind in all; kept ones are weighted up to them.
    searching: search_all, or the same on the executors. least: score from which documents are asked for.
    """
    texts: list[str] = []
    words: list[int] = []
    sizes: list[int] = []
    spans, share, reviewers = [0], [], []
    third, positive_texts = max_examples // 3, 0
    # in the order given, so that short documents are not preferred; the one that reaches the bound still comes whole
    for _, text, y, n in sorted(reviewed, key=lambda x: x[2] < 0.5):
        if len(texts) >= (third if y >= 0.5 else max(max_examples, positive_texts + max_examples - third)):
            continue  # the sample's bound
        mine = sentence_words(text)
        positive_texts += len(mine) if y >= 0.5 else 0
        texts += [s for s, _ in mine]
        for _, w in mine:
            words += w
            sizes.append(len(w))
        spans.append(len(texts))
        share.append(y)
        reviewers.append(n)
    span, n = np.array(spans), np.array(reviewers, np.float64)
    cases = np.round(np.array(share) * n)
    positive = np.array(share) >= 0.5
    nothing = BlockMaxIndex(np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(1, np.int64))
    if not texts or not positive.any():
        return Model(idf, nothing, np.zeros(0), nothing, np.zeros(0), np.zeros(0, np.int32), np.zeros(0), {})
    vectors = vectors_of(np.array(words, np.uint32).view(np.int32), np.array(sizes), idf)
    owner = np.repeat(np.arange(len(n)), np.diff(span)).astype(np.int32)
    # votes of negative documents count as all negative ones do beside all positive ones
    stands_for = np.where(positive, n_positive / positive.sum(), n_negative / max(1, (~positive).sum()))
    weights = (stands_for / stands_for[positive][0])[owner]
    whole = BlockMaxIndex(*vectors)
    of_positive = np.flatnonzero(positive[owner])
    near = searching(whole, vectors, span, owner, of_positive)
    harmless = np.array([(c.astype(np.float64) ** 3 * weights[i])[~positive[owner[i]]].sum() for i, c in near])
    total = np.array([(c.astype(np.float64) ** 3 * weights[i]).sum() for i, c in near])
    in_question = (harmless < SUPPORT[-1]) | (total - harmless >= IN_QUESTION * total)
    asked, near = of_positive[in_question], [x for x, yes in zip(near, in_question) if yes]
    labels, _ = explain(near, owner, asked, weights, n, cases)
    # sentences of negative documents are in question where one is near that may be guilty
    suspects = _part(vectors, np.flatnonzero(labels >= MAY_BE_GUILTY))
    others = np.flatnonzero(~positive[owner])
    if len(others) and suspects.n:
        at, w, bounds = vectors
        positions, per = _spans(bounds[:-1][others], bounds[1:][others])
        others = others[suspects.may_reach(at[positions], w[positions], np.append(0, np.cumsum(per)), LEAST)]
        others = np.array([i for i in others if len(suspects.search((at[bounds[i] : bounds[i + 1]], w[bounds[i] : bounds[i + 1]]), 1, LEAST)[0])], np.int64)
        asked, near = np.concatenate([asked, others]), near + searching(whole, vectors, span, owner, others)
    labels, votes = explain(near, owner, asked, weights, n, cases)
    raw = np.full(len(n), PRIOR)  # of a document without a sentence in question, as without any likeness
    np.maximum.at(raw, owner, votes)
    slope, floor = calibration(raw, n, cases, stands_for / stands_for.mean())
    guilty = np.flatnonzero(labels > 0.5)
    cut = vote_at(least, slope, floor)
    blamed = np.flatnonzero(labels > cut)
    beyond = weights[blamed] * (labels[blamed] - cut)
    return Model(idf, _part(vectors, blamed), beyond, whole, labels, owner, weights, {int(i): texts[i] for i in guilty}, slope, floor, cut)


def score_sentences(model: Model, owner: np.ndarray, words: np.ndarray, sizes: np.ndarray, n: int) -> list[tuple[float, int, int]]:
    """(raw score, worst sentence, nearest guilty example) of n documents; -1 where there is none. owner: document of each sentence.

    Raw scores are exact from model.cut on. Documents without sentences, and those that stay below a cut above the prior,
    have the prior.
    """
    out = [(PRIOR, -1, -1)] * n
    if not len(model.labels) or not len(sizes):
        return out
    whole = model.cut <= PRIOR
    if whole:
        for d in np.unique(owner):
            out[d] = (0.0, -1, -1)

    def ask(i: int, query: Vector) -> None:
        near, cos = neighbours(model.every, query, model.owner)
        raw = vote(cos, model.labels[near], model.weights[near])
        if raw > out[owner[i]][0]:
            guilty = near[model.labels[near] > 0.5]
            out[owner[i]] = (raw, int(i), int(guilty[0]) if len(guilty) else -1)

    # a term that is met tf times adds tf * idf ** 2 to the square of the norm, and less than tf * idf to the product
    of, term = terms_of(words, sizes)
    weight = model.idf[term]
    norm = np.sqrt(np.bincount(of, weights=weight.astype(np.float64) ** 2))
    some = np.flatnonzero(np.bincount(of, weights=weight * model.blamed.any[term]) >= (LEAST - 1e-6) * norm)
    starts = np.cumsum(sizes) - sizes
    asked = np.zeros(len(sizes), bool)
    if len(some):
        positions, _ = _spans(starts[some], starts[some] + sizes[some])
        at, w, bounds = vectors_of(words[positions], sizes[some], model.idf)
        for k in model.blamed.may_reach(at, w, bounds, LEAST):
            i, query = some[k], (at[bounds[k] : bounds[k + 1]], w[bounds[k] : bounds[k + 1]])
            close, cos = model.blamed.search(query, NEAREST, LEAST)
            # those found are all there are if they are fewer than NEAREST: the vote stays below the cut even if no harmless example is near
            if not len(close) or (len(close) < NEAREST and (cos.astype(np.float64) ** 3 * model.beyond[close]).sum() < SHRINK * (model.cut - PRIOR)):
                continue
            asked[i] = True
            ask(i, query)
    if not whole:
        return out
    # no other sentence votes above the prior, so documents that are there already are done; the most lonely sentences first
    most = np.bincount(of, weights=weight * model.every.any[term]) / norm
    below = np.array([raw < PRIOR - 1e-12 for raw, _, _ in out])
    rest = np.flatnonzero(~asked & below[owner])
    rest = rest[np.lexsort((most[rest], owner[rest]))]
    for i in rest:
        if out[owner[i]][0] >= PRIOR - 1e-12:
            continue
        if most[i] < LEAST - 1e-6:
            out[owner[i]] = (PRIOR, int(i), -1)  # no neighbour at all
            continue
        at, w, _ = vectors_of(words[starts[i] : starts[i] + sizes[i]], sizes[i : i + 1], model.idf)
        ask(i, (at, w))
    return out


def _scorer(shared, index, least: float) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = replace(shared.value, every=index.value[0] if index else shared.value.every)
        for batch in batches:
            for s in range(0, batch.num_rows, 1024):
                part = batch.slice(s, 1024)
                sizes = part.column(4)
                per_doc = np.diff(sizes.offsets.to_numpy())
                owner = np.repeat(np.arange(part.num_rows), per_doc)
                rows = score_sentences(model, owner, part.column(3).flatten().to_numpy(), sizes.flatten().to_numpy(), part.num_rows)
                first = np.cumsum(np.append(0, per_doc))
                scores, worst, evidence = [], [], []
                scored = [calibrated(raw, model) for raw, _, _ in rows]
                kept = [d for d, score in enumerate(scored) if score >= least]
                for d in kept:
                    _, sentence, example = rows[d]
                    scores.append(scored[d])
                    worst.append(sentence_words(part.column(2)[d].as_py())[sentence - first[d]][0] if sentence >= 0 else None)
                    evidence.append(model.texts[example] if example >= 0 else None)
                columns = [part.column(0).take(pa.array(kept, pa.int64())), part.column(1).take(pa.array(kept, pa.int64())), pa.array(scores, pa.float64()), pa.array(worst, pa.string()), pa.array(evidence, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "source", "score", "sentence", "evidence"])

    return score


class OnExecutors:
    """search_all on the executors. The index is broadcast once; a search's vectors come as rows, its answers are bounded by max_examples * NEIGHBOURS."""

    def __init__(self, spark: SparkSession):
        self.spark, self.shared = spark, None

    def __call__(self, index: BlockMaxIndex, vectors: Vectors, spans: np.ndarray, owner: np.ndarray, asked: np.ndarray) -> Found:
        if not len(asked):
            return []
        if self.shared is None:
            self.shared = self.spark.sparkContext.broadcast((index, spans, owner))
        shared = self.shared
        at, w, bounds = vectors
        positions, sizes = _spans(bounds[:-1][asked], bounds[1:][asked])
        ends = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (at[positions].astype(np.int32), w[positions])]
        rows = pa.table([pa.array(np.arange(len(asked))), pa.array(asked.astype(np.int64)), *lists], ["id", "example", "at", "w"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index, spans, owner = shared.value
            without = np.zeros(index.n, bool)
            for batch in batches:
                at, w = batch.column(2), batch.column(3)
                bounds, at, w = at.offsets.to_numpy() - at.offsets[0].as_py(), at.flatten().to_numpy(), w.flatten().to_numpy()
                found = [_others(index, (at[bounds[k] : bounds[k + 1]], w[bounds[k] : bounds[k + 1]]), spans, owner, i, without) for k, i in enumerate(batch.column(1).to_numpy())]
                ids, cos = pa.array([i for i, _ in found], pa.list_(pa.int32())), pa.array([c for _, c in found], pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([batch.column(0), ids, cos], ["id", "ids", "cos"])

        parts = min(4 * self.spark.sparkContext.defaultParallelism, 1 + len(asked) // 256)
        some = self.spark.createDataFrame(rows).repartition(parts, "id")
        answers = some.mapInArrow(run, "id bigint, ids array<int>, cos array<float>").toArrow().sort_by("id")
        ids, cos = answers.column("ids").combine_chunks(), answers.column("cos").combine_chunks()
        cuts = ids.value_lengths().to_numpy().cumsum()[:-1]
        return list(zip(np.split(ids.flatten().to_numpy(), cuts), np.split(cos.flatten().to_numpy(), cuts)))


def reviews(labels: DataFrame, kinds: tuple[str, ...] = ("abusive", "hateful", "sexual")) -> DataFrame:
    """(doc_id, y, n): share of the reviewers of a document that saw a case of any kind, and their number; a reviewer with nulls only does not count."""
    any_kind: Column = F.greatest(*(F.col(k) for k in kinds))
    each = labels.select("doc_id", "reviewer", any_kind.alias("y")).where("y is not null").distinct()
    return each.groupBy("doc_id").agg(F.avg("y").alias("y"), F.count("y").alias("n"))


def scored_documents(docs: DataFrame, labels: DataFrame, max_docs: int = 12_000, max_examples: int = 120_000, least: float = 0.0) -> DataFrame:
    """(doc_id, source, score, sentence, evidence) for every document, or for those whose score is `least` or more.

    docs has doc_id, text and source; labels has doc_id, reviewer, abusive, hateful and sexual. score is the calibrated
    probability that the document is abusive, hateful or sexual, sentence its worst sentence in plain spelling, evidence
    the nearest guilty example. Null, empty and blank texts score as a text without any likeness. Without a positive
    review every score is 0. At most max_docs reviewed documents of either kind, by the hash of their id, become
    examples, until max_examples sentences are reached (a third of them from positive documents). Rows delivered twice
    are scored alike.
    """
    narrow = docs.select("doc_id", F.col("source").cast("string").alias("source"), "text")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    # each text is brought to plain spelling and split once; what comes after reads its words
    read = staged(narrow.mapInArrow(_reader, f"doc_id {kind}, source string, text string, words array<int>, sizes array<int>"), "words", compression="zstd")
    idf = inverse_frequencies(read)
    reviewed = reviews(labels)
    chosen = []
    for condition in (F.col("y") >= 0.5, F.col("y") < 0.5):
        # at most max_docs ids, so the texts come by a broadcast and are not shuffled
        ids = F.broadcast(reviewed.where(condition).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs))
        rows = read.where("text is not null").select("doc_id", "text").join(ids, "doc_id").collect()
        chosen += sorted({r["doc_id"]: r for r in rows}.values(), key=lambda r: zlib.crc32(str(r["doc_id"]).encode()))
    n = reviewed.agg(F.count_if(F.col("y") >= 0.5).alias("positive"), F.count_if(F.col("y") < 0.5).alias("negative")).first()
    spark = docs.sparkSession
    searching = OnExecutors(spark)
    model = train([(r["doc_id"], r["text"], r["y"], r["n"]) for r in chosen], idf, n["positive"], n["negative"], max_examples, searching, least)
    shared = spark.sparkContext.broadcast(replace(model, every=None) if searching.shared else model)
    return read.mapInArrow(_scorer(shared, searching.shared, least), f"doc_id {kind}, source string, score double, sentence string, evidence string")
