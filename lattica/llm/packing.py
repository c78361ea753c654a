"""Filling containers of fixed capacity with whole texts, neighbours along a space-filling curve together.

Each text is tokenised once. Its tokens, hashed, make a vector that is projected to a few dimensions; after scaling by the
mean and spread of all texts the coordinates give a Hilbert key. Texts are range-sorted by that key, and every range is
packed on its own: a container opens with the text that has waited longest and takes, from a small window along the curve,
the largest text that still fits, the nearest of equal ones. Only where more than a stated share of the container would
stay empty are texts further along the curve looked at, in widening windows. A text larger than a container is divided
into full containers and a rest, which is packed like any other text; no other text is divided.
"""

from __future__ import annotations

import base64
import bisect
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.session import staged

#: A vocabulary in the form of rank files: a token in base64 and its rank per line.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: how the vocabulary above cuts text into pieces.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Dimensions of the curve, bits per dimension, buckets of hashed tokens.
DIMENSIONS, BITS, BUCKETS = 4, 10, 4096

#: Packs of one pass over the texts: each text gets a row for each.
PACKS_AT_ONCE = 100

#: Texts of the windows that a container is filled from, and the share of a container that may stay empty rather than go on to the next window.
WINDOWS, MAY_STAY_EMPTY = (16, 128, 1024), 0.02


def encoding(ranks: bytes, pattern: str):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in (x.split() for x in ranks.splitlines() if x)}
    return tiktoken.Encoding("lattica", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def projection(seed: int = 3) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((BUCKETS, DIMENSIONS))


def project(ids: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The text's hashed token counts (damped by the logarithm), at unit length, in DIMENSIONS dimensions."""
    at, n = np.unique((ids * 2654435761 >> 7) % BUCKETS, return_counts=True)
    w = 1 + np.log(n)
    return w @ table[at] / np.sqrt((w * w).sum())


def _measurer(ranks, pattern: str) -> Callable:
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, table = encoding(ranks.value, pattern).encode_ordinary, projection()
        for batch in batches:
            sizes, places = np.zeros(batch.num_rows, np.int32), np.zeros((batch.num_rows, DIMENSIONS))
            for i, text in enumerate(batch.column(1).to_pylist()):
                if text:
                    ids = np.array(encode(text), np.int64)
                    sizes[i] = len(ids)
                    places[i] = project(ids, table)
            columns = [batch.column(0), pa.array(sizes), *(pa.array(places[:, k]) for k in range(DIMENSIONS))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", *(f"x{k}" for k in range(DIMENSIONS))])

    return measure


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position of each row of cells (integers below 2**bits, one column per dimension) along the Hilbert curve.

    Transposes the coordinates in place of walking the curve (Skilling, 2004), for all rows at once.
    """
    x = [c.astype(np.int64) for c in cells.T]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = (x[0] ^ x[i]) & low
            first = np.where(high, x[0] ^ low, x[0] ^ t)
            x[i] = np.where(high, x[i], x[i] ^ t) if i else first
            x[0] = first
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (((x[i] ^ t) >> b) & 1)
    return key


def _keyer(mean: np.ndarray, spread: np.ndarray) -> Callable:
    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(2 + k).to_numpy() for k in range(DIMENSIONS)], axis=1)
            share = 1 / (1 + np.exp(-1.7 * (x - mean) / spread))  # near the normal distribution's share below x
            cells = np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hilbert_key(cells)), *batch.columns[2:]], ["doc_id", "n_tokens", "curve", *_PLACE])

    return key


_PLACE = [f"x{k}" for k in range(DIMENSIONS)]


class Window:
    """Texts by size; of equal sizes the nearest along the curve comes last."""

    def __init__(self) -> None:
        self.by_size: list[tuple[int, int]] = []

    def add(self, place: int, size: int) -> None:
        bisect.insort(self.by_size, (size, -place))

    def remove(self, place: int, size: int) -> None:
        del self.by_size[bisect.bisect_left(self.by_size, (size, -place))]

    def largest(self, room: int) -> int | None:
        at = bisect.bisect_right(self.by_size, (room, 1))
        return -self.by_size[at - 1][1] if at else None


def fill(sizes: Iterator[int], capacity: int, windows: tuple[int, ...] = WINDOWS, may_stay_empty: float = MAY_STAY_EMPTY) -> Iterator[tuple[int, int]]:
    """(place, container) for every size, none above capacity; containers are numbered from 0.

    windows: numbers of waiting texts, in the order of the curve, that belong to each window beyond those before it.
    """
    incoming, container, ended = enumerate(sizes), 0, False
    size: dict[int, int] = {}
    level: dict[int, int] = {}
    queues: list[deque[int]] = [deque() for _ in windows]  # places per window, in the order of the curve; taken ones are skipped
    held = [Window() for _ in windows]
    count = [0] * len(windows)

    def refill() -> None:
        """Texts move up from the wider windows, and the widest reads on."""
        nonlocal ended
        for k in range(len(windows)):
            while count[k] < windows[k]:
                place = None
                for wider in range(k + 1, len(windows)):
                    while queues[wider] and level.get(queues[wider][0]) != wider:
                        queues[wider].popleft()
                    if queues[wider]:
                        place = queues[wider].popleft()
                        held[wider].remove(place, size[place])
                        count[wider] -= 1
                        break
                if place is None:
                    nxt = None if ended else next(incoming, None)
                    if nxt is None:
                        ended = True
                        return
                    place, size[nxt[0]] = nxt
                level[place] = k
                queues[k].append(place)
                held[k].add(place, size[place])
                count[k] += 1

    def take(place: int) -> int:
        k = level.pop(place)
        held[k].remove(place, size[place])
        count[k] -= 1
        return size.pop(place)

    while True:
        refill()
        while queues[0] and level.get(queues[0][0]) != 0:
            queues[0].popleft()
        if not queues[0]:
            return
        room, place = capacity, queues[0].popleft()
        while place is not None:
            room -= take(place)
            yield place, container
            place = held[0].largest(room) if room else None
            for window in held[1:]:
                if place is None and room > may_stay_empty * capacity:
                    place = window.largest(room)
        container += 1


def _packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pack the rows (pack_id, capacity, doc_id, n_tokens and what else is to come along) of one range of the curve."""
    part = TaskContext.get().partitionId()

    def runs() -> Iterator[tuple[int, int, Iterator]]:
        """The rows of each (pack, capacity), which arrive sorted by pack."""
        rows = (r for b in batches for r in zip(*(c.to_numpy(zero_copy_only=False).tolist() for c in b.columns)))
        row = next(rows, None)
        while row is not None:
            pack = row[0]

            def mine() -> Iterator:
                nonlocal row
                while row is not None and row[0] == pack:
                    now = row
                    yield now
                    row = next(rows, None)

            yield pack, row[1], mine()

    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out))
        kinds = [pa.int32(), pa.string(), None, pa.int32(), pa.int32(), pa.int32(), *[pa.float64()] * (len(columns) - 6)]
        arrays = [pa.array(c, k) if k else pa.array(c) for c, k in zip(columns, kinds)]
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, ["pack_id", "container_id", "doc_id", "piece_no", "first_token", "n_tokens", *_PLACE[: len(columns) - 6]])

    for pack, capacity, rows in runs():
        full = 0
        rests: dict[int, tuple] = {}

        def sizes() -> Iterator[int]:
            nonlocal full
            place = 0
            for _, _, doc, n, *at in rows:
                pieces = n // capacity if n > capacity else 0
                for k in range(pieces):
                    out.append((pack, f"{pack}-{part}-f{full}", doc, k, k * capacity, capacity, *at))
                    full += 1
                if n - pieces * capacity:
                    rests[place] = (doc, pieces, pieces * capacity, n - pieces * capacity, *at)
                    place += 1
                    yield n - pieces * capacity

        for place, container in fill(sizes(), capacity):
            out.append((pack, f"{pack}-{part}-{container}", *rests.pop(place)))
            if len(out) >= 8192:
                yield flush()
    if out:
        yield flush()


def packed(docs: DataFrame, packs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(pack_id, container_id, doc_id, piece_no, first_token, n_tokens): the place of every text in every pack.

    docs has doc_id and text; packs has pack_id and capacity_tokens. Null and empty texts have no tokens and get no row;
    blank ones have tokens. A text within the capacity has one piece, number 0. Rows delivered twice are packed twice.
    Capacities that are null or below 1 are left out. An empty table on either side gives no rows. vocabulary is read on
    the driver and sent to the tasks.
    """
    return _packed(docs, packs, vocabulary, pattern, [])


def packed_with_place(docs: DataFrame, packs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """packed, with the coordinates of the text's vector (x0, x1, ...)."""
    return _packed(docs, packs, vocabulary, pattern, _PLACE)


def _packed(docs: DataFrame, packs: DataFrame, vocabulary: str, pattern: str, along: list[str]) -> DataFrame:
    """packed, with the coordinates named in `along`; others do not travel."""
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())
    kind = docs.schema["doc_id"].dataType.simpleString()
    coordinates = ", ".join(f"{x} double" for x in _PLACE)
    measured = docs.select("doc_id", "text").mapInArrow(_measurer(ranks, pattern), f"doc_id {kind}, n_tokens int, {coordinates}").where("n_tokens > 0")
    measured = staged(measured, "measured")  # a few numbers per text, read again for each pass
    spread = measured.agg(*(f(x) for x in _PLACE for f in (F.avg, F.stddev_pop))).first()
    mean, width = np.array([spread[2 * k] or 0.0 for k in range(DIMENSIONS)]), np.array([spread[2 * k + 1] or 1.0 for k in range(DIMENSIONS)])
    keyed = measured.mapInArrow(_keyer(mean, width), f"doc_id {kind}, n_tokens int, curve bigint, {coordinates}")
    schema = ", ".join([f"pack_id int, container_id string, doc_id {kind}, piece_no int, first_token int, n_tokens int", *(f"{x} double" for x in along)])
    rows = packs.select(F.col("pack_id").cast("int"), F.col("capacity_tokens").cast("int")).where("capacity_tokens >= 1 and pack_id is not null").distinct()
    every, some = spark.createDataFrame([], schema), []

    def close() -> None:
        nonlocal every
        if some:
            targets = F.array(*(F.struct(F.lit(p).alias("pack_id"), F.lit(c).alias("capacity")) for p, c in sorted(some)))
            each = keyed.select("doc_id", "n_tokens", "curve", *along, F.explode(targets).alias("t")).select("t.pack_id", "t.capacity", "doc_id", "n_tokens", "curve", *along)
            placed = each.repartitionByRange("pack_id", "curve", "doc_id").sortWithinPartitions("pack_id", "capacity", "curve", "doc_id")
            every = every.unionByName(placed.select("pack_id", "capacity", "doc_id", "n_tokens", *along).mapInArrow(_packer, schema))
            some.clear()

    for row in rows.toLocalIterator():
        some.append((row[0], row[1]))
        if len(some) == PACKS_AT_ONCE:
            close()
    close()
    return every


def spread_within(placed: DataFrame) -> DataFrame:
    """(pack_id, spread): spread of the texts' vectors within containers, as a share of their spread over all containers.

    Containers put together without regard to the vectors, as of texts in shuffled order, have 1 on average.
    """
    sums = lambda by: placed.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *(F.sum(x).alias(x) for x in _PLACE), *(F.sum(F.col(x) ** 2).alias(f"{x}_2") for x in _PLACE))
    squares = sum((F.col(f"{x}_2") - F.col(x) ** 2 / F.col("n") for x in _PLACE[1:]), F.col("x0_2") - F.col("x0") ** 2 / F.col("n"))
    within = sums(["pack_id", "container_id"]).groupBy("pack_id").agg(F.sum(squares).alias("a"), F.sum(F.col("n") - 1).alias("a_n"))
    whole = sums(["pack_id"]).select("pack_id", squares.alias("b"), (F.col("n") - 1).alias("b_n"))
    return within.join(whole, "pack_id").select("pack_id", F.sqrt(F.try_divide(F.col("a") * F.col("b_n"), F.col("a_n") * F.col("b"))).alias("spread"))
