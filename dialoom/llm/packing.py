"""Documents packed into training sequences of fixed capacity, sizes in tokens of a public tokenizer.

A dynamic programme over the global histogram of lengths chooses the length buckets that leave the least padding.
Token-budget batches form inside each bucket, from the longest on, as long as they leave next to no room (``SLACK``);
the items of the bucket that are left over are topped up with shorter ones, the longest that fits first, as batches
from one bucket alone (``top_up=False``) would leave room empty. The plan is made from the histogram, whose size is the capacity and not the corpus; documents find their sequence by
their number among those of their length.

Defined results: null and blank texts have no piece, a text longer than the capacity is cut into full pieces and a
rest, a text that the tokenizer gives no token has no piece, repeated ids are packed once per row, ties are broken by
the id, extra columns are ignored, an empty table gives no sequence.
"""

from __future__ import annotations

import base64
import importlib.util
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialoom.functions.text import is_visible
from dialoom.llm.arrow import bounded
from dialoom.session import cut, table

CAPACITY = 4096
BUCKETS = 12
#: Share of the capacity that a batch from inside one bucket may leave empty.
SLACK = 1 / 64
#: Where the public tokenizers' files lie, and which one counts.
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Items of one length are numbered in shares of about so many items at most, each sorted on its own.
SHARE_ITEMS = 200_000
_ENCODER: dict[str, object] = {}


def vocabulary_file(path: str) -> tuple[str, str, bytes]:
    """Name, pattern of the pieces and ranks of a tokenizer, read where the files lie: on the driver."""
    folder, name = path.rsplit("/", 1)
    spec = importlib.util.spec_from_file_location("own_tokenizers", f"{folder}/__init__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return name, module.PATTERN, Path(path).read_bytes()


def _encoder(name: str, pattern: str, ranks: bytes):
    if name not in _ENCODER:
        import tiktoken

        table_ = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _ENCODER[name] = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=table_, special_tokens={})
    return _ENCODER[name]


def _sizes(batches: Iterator[pa.RecordBatch], vocabulary: tuple[str, str, bytes]) -> Iterator[pa.RecordBatch]:
    encode = _encoder(*vocabulary).encode_ordinary
    for batch in bounded(batches, ["text"]):
        tokens = [len(encode(text)) for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens, pa.int64())], ["doc_id", "tokens"])


def token_sizes(documents: DataFrame, vocabulary: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """``doc_id, tokens`` of every text with visible text; the vocabulary (one file) is sent to the executors."""
    rows = documents.where(is_visible(F.col("text"))).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sent = documents.sparkSession.sparkContext.broadcast(vocabulary_file(vocabulary))
    return rows.mapInArrow(lambda batches: _sizes(batches, sent.value), "doc_id long, tokens long")


def best_buckets(counts: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """Upper bounds of the length buckets that leave the least padding; ``counts[n]`` items have length n."""
    lengths = np.flatnonzero(counts)
    if not len(lengths):
        return []
    number = np.r_[0, np.cumsum(counts[lengths])].astype(np.float64)
    total = np.r_[0, np.cumsum(counts[lengths] * lengths)].astype(np.float64)
    n, buckets = len(lengths), min(buckets, len(lengths))
    cost = np.full(n + 1, np.inf)
    cost[0] = 0
    back = np.zeros((buckets, n + 1), dtype=np.int64)
    for b in range(buckets):
        new = np.full(n + 1, np.inf)
        for j in range(1, n + 1):
            # the bucket holds lengths i..j-1 and is padded to the last of them
            options = cost[:j] + lengths[j - 1] * (number[j] - number[:j]) - (total[j] - total[:j])
            back[b, j] = options.argmin()
            new[j] = options[back[b, j]]
        cost = new
    bounds, j = [], n
    for b in range(buckets - 1, -1, -1):
        if j:
            bounds.append(int(lengths[j - 1]))
            j = int(back[b, j])
    return sorted(bounds)


@dataclass
class Plan:
    """Runs of items: numbers ``first`` to ``last`` (exclusive) of a length go to sequences from ``sequence``, ``each`` to one."""

    bounds: list[int]
    length: np.ndarray
    first: np.ndarray
    last: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    sequences: int


def _batch(left: np.ndarray, capacity: int, low: int, high: int) -> tuple[Counter[int], int]:
    """One batch of items of ``low`` to ``high`` tokens, always as many of the longest that fits, and the room it leaves."""
    present = np.flatnonzero(left[: high + 1])
    present = present[np.searchsorted(present, low) :]
    items: Counter[int] = Counter()
    room = capacity
    while True:
        for size in present[: np.searchsorted(present, room, "right")][::-1].tolist():
            have = int(left[size]) - items[size]
            if have > 0:
                take = min(have, room // size)
                items[size] += take
                room -= take * size
                break
        else:
            return items, room


def make_plan(counts: np.ndarray, capacity: int = CAPACITY, buckets: int = BUCKETS, top_up: bool = True) -> Plan:
    """Batches of whole items within the token budget: of one bucket where they fill it, of the rest of all buckets.

    ``top_up=False``: each batch has items of one bucket alone, however much room it leaves.
    """
    left = counts.astype(np.int64).copy()
    bounds = best_buckets(left, buckets)
    used = np.zeros(capacity + 1, dtype=np.int64)
    rows: list[tuple[int, int, int, int, int]] = []
    sequence = 0

    def take(items: Counter[int]) -> None:
        """The batch, as often as its items are there."""
        nonlocal sequence
        times = min(int(left[size]) // n for size, n in items.items())
        for size, n in items.items():
            rows.append((size, int(used[size]), int(used[size]) + n * times, sequence, n))
            used[size] += n * times
            left[size] -= n * times
        sequence += times

    for low, high in reversed(list(zip([1, *(b + 1 for b in bounds)], bounds))):
        for longest in range(high, low - 1, -1):
            while left[longest]:
                items, room = _batch(left, capacity, low, longest)
                if top_up and room > capacity * SLACK:
                    break
                take(items)
        # the rest of the bucket, before shorter items are used up among themselves
        while (present := np.flatnonzero(left[low : high + 1])).size:
            take(_batch(left, capacity, 1, low + int(present[-1]))[0])
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return Plan(bounds, *cols, sequences=sequence)


def _assign(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    span = int(plan.last.max()) + 1 if len(plan.last) else 1
    keys = plan.length * span + plan.first
    for batch in batches:
        size, number = (batch.column(c).to_numpy() for c in ("tokens", "number"))
        at = np.searchsorted(keys, size * span + number, "right") - 1
        sequence = plan.sequence[at] + (number - plan.first[at]) // plan.each[at]
        bucket = np.searchsorted(plan.bounds, size).astype(np.int32)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "piece", "start", "tokens")), pa.array(bucket), pa.array(sequence)], ["doc_id", "piece", "start", "tokens", "bucket", "sequence"])


def pack(sizes: DataFrame, capacity: int = CAPACITY, buckets: int = BUCKETS, top_up: bool = True) -> DataFrame:
    """``doc_id, piece, start, tokens, bucket, sequence``: where each piece of each document goes.

    ``sizes``: ``doc_id, tokens``. Two small shuffles of ids: items are numbered within a length and a share of the ids,
    so that a length that holds any share of all items is spread; the offsets of the shares are joined to them.
    """
    whole = F.sequence(F.lit(0), F.floor((F.col("tokens") - 1) / capacity).cast("int"))
    pieces = sizes.where("tokens > 0").select("doc_id", "tokens", F.explode(whole).alias("piece"))
    start = (F.col("piece") * F.lit(capacity)).cast("long").alias("start")
    pieces = cut(pieces.select("doc_id", "piece", start, F.least(F.lit(capacity), F.col("tokens") - F.col("piece") * F.lit(capacity)).cast("long").alias("tokens")))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in pieces.groupBy("tokens").agg(F.count("*").alias("n")).collect():  # a row per length: the capacity at most
        counts[row["tokens"]] = row["n"]
    plan = make_plan(counts, capacity, buckets, top_up)
    shares = max(16, int(counts.max()) // SHARE_ITEMS)
    shared = pieces.withColumn("share", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shares)))
    before = Window.partitionBy("tokens").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shared.groupBy("tokens", "share").agg(F.count("*").alias("n")).select("tokens", "share", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("tokens", "share").orderBy("doc_id", "piece")
    numbered = shared.withColumn("own", F.row_number().over(within) - 1).join(offsets, ["tokens", "share"])
    sent = sizes.sparkSession.sparkContext.broadcast(plan)
    rows = numbered.select("doc_id", "piece", "start", "tokens", (F.col("own") + F.col("offset")).cast("long").alias("number"))
    return rows.mapInArrow(lambda batches: _assign(batches, sent.value), "doc_id long, piece int, start long, tokens long, bucket int, sequence long")


def p7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequence of every piece of every document."""
    return pack(token_sizes(table(spark, sf_dir, "documents")))


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences, how many hold items of one bucket alone, and empty room of the packing, and of the one by buckets alone."""
    sizes = token_sizes(table(spark, sf_dir, "documents"))
    out = None
    for way, top_up in (("topped up", True), ("bucket alone", False)):
        filled = pack(sizes, top_up=top_up).groupBy("sequence").agg(F.sum("tokens").alias("tokens"), (F.min("bucket") == F.max("bucket")).alias("alike"))
        one = filled.agg(F.lit(way).alias("way"), F.count("*").alias("sequences"), F.count_if("alike").alias("one_bucket"), F.sum("tokens").alias("tokens"), (1 - F.sum("tokens") / (F.count("*") * CAPACITY)).alias("empty"))
        out = one if out is None else out.unionByName(one)
    return out


QUERIES = {"p7_packing": p7_packing, "p7_fill": p7_fill}
ORACLE_SQL: dict[str, str] = {}
