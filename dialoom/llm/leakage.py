"""Test passages that stand, wholly or in part, in a training corpus: winnowing, a join of fingerprints, extension.

Letters and digits alone count, in the one form of look-alikes and in lower case. Every window of ``k``-gram hashes
keeps its least, so that any shared run of at least ``k + window - 1`` characters has a common fingerprint at the same
place of the run; every hit is extended to both sides, letter by letter, to the whole run, and the runs of a document
and a passage are united to the exact share of the passage that the document holds.

Defined results: null, blank and too short texts have no hit (a passage of fewer letters than its least piece can't be
held), repeated rows give distinct pairs, texts of any length are read whole, extra columns are ignored, empty tables
give no row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions.unicode import fold_joined
from dialoom.llm.arrow import bounded
from dialoom.llm.lookalike import sql_form
from dialoom.session import cut, table

#: Characters of a k-gram and hashes of a window: runs of K + WINDOW - 1 = 12 characters are always found.
K, WINDOW = 8, 5
#: Passages, and characters of them, that may be sent to every task at a time; more are worked through in blocks.
BROADCAST_CHARS = 8_000_000
BROADCAST_ITEMS = 50_000
#: Hits that are extended at a time.
HITS = 1_000_000

#: Between texts that lie behind one another; of documents and of passages, so that no run goes beyond a text.
_GAP, _ITEM_GAP = 0xFFFFFFFF, 0xFFFFFFFE
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_BASE = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_NOT_COUNTED = re.compile(r"(?:[^\w\x00]|_)+")


def letters(texts: list[str | None]) -> list[str]:
    """Letters and digits of texts in the form in which they are compared; all are folded in one go."""
    joined = "\x00".join((t or "").replace("\x00", "") for t in texts)
    return _NOT_COUNTED.sub("", fold_joined(joined, "\x00").lower()).split("\x00") if texts else []


def laid_out(texts: list[str], gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each followed by a gap, and where each text begins (and the end)."""
    length = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    starts = np.r_[0, np.cumsum(length)]
    out = np.full(int(starts[-1]), gap, dtype=np.uint32)
    inner = np.ones(len(out), dtype=bool)
    inner[starts[1:] - 1] = False
    out[inner] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return out, starts


def kgram_hashes(points: np.ndarray, gap: int) -> np.ndarray:
    """64-bit hash of every ``K``-gram; of those that go over a gap, the greatest number, which none counts as."""
    n = len(points) - K + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    wide = points.astype(np.uint64)
    with np.errstate(over="ignore"):
        for j in range(K):
            out *= _BASE
            out += wide[j : j + n]
        out ^= out >> np.uint64(31)
        out *= _MIX
        out ^= out >> np.uint64(29)
    out[out == _NONE] -= np.uint64(1)
    gaps = np.flatnonzero(points == gap)
    for j in range(K):
        spots = gaps - j
        out[spots[(spots >= 0) & (spots < n)]] = _NONE
    return out


def winnow(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the least hashes of all windows of a text; of a text shorter than a window, of its least hash."""
    n = len(hashes) - window + 1
    if n < 1:
        least = hashes.min(initial=_NONE)
        return np.flatnonzero((hashes == least) & (hashes != _NONE))
    least = hashes[:n].copy()
    for j in range(1, window):
        np.minimum(least, hashes[j : j + n], out=least)
    chosen = np.zeros(len(hashes), dtype=bool)
    for j in range(window):
        chosen[j : j + n] |= hashes[j : j + n] == least
    return np.flatnonzero(chosen & (hashes != _NONE))


class Items:
    """Test passages behind one another, with an index from their fingerprints to places."""

    #: Bits of the table that tells most foreign fingerprints before they are looked up.
    SIEVE = 22

    def __init__(self, ids: list[int], texts: list[str], pieces: list[int]) -> None:
        self.ids, self.pieces = np.array(ids, dtype=np.int64), np.array(pieces, dtype=np.int64)
        self.points, self.starts = laid_out(texts, _ITEM_GAP)
        self.sizes = np.diff(self.starts) - 1
        hashes = kgram_hashes(self.points, _ITEM_GAP)
        spots = winnow(hashes)
        by = np.argsort(hashes[spots], kind="stable")
        self.spots, self.hashes = spots[by], hashes[spots][by]
        self.sieve = np.zeros(1 << self.SIEVE, dtype=bool)
        self.sieve[(self.hashes >> np.uint64(64 - self.SIEVE)).astype(np.int64)] = True

    def hits(self, points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places in documents and in passages that share a fingerprint, about ``HITS`` at a time."""
        hashes = kgram_hashes(points, _GAP)
        own = winnow(hashes)
        own = own[self.sieve[(hashes[own] >> np.uint64(64 - self.SIEVE)).astype(np.int64)]]
        lo, hi = np.searchsorted(self.hashes, hashes[own], "left"), np.searchsorted(self.hashes, hashes[own], "right")
        own, lo, n = own[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
        cuts = np.cumsum(n) // HITS
        edges = [*np.flatnonzero(np.r_[True, cuts[1:] != cuts[:-1]]), len(n)] if len(n) else [0]
        for a, b in zip(edges, edges[1:]):
            m = n[a:b]
            yield np.repeat(own[a:b], m), self.spots[np.repeat(lo[a:b] - np.cumsum(m) + m, m) + np.arange(m.sum())]


def extend(points: np.ndarray, items: np.ndarray, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place in the passages and length of the run around each hit; 0 where the fingerprints agree by chance."""
    same = np.ones(len(p), dtype=bool)
    for j in range(K):
        same &= points[p + j] == items[q + j]
    length = np.where(same, K, 0)
    first = q.copy()
    going, j = np.flatnonzero(same), K
    while len(going):  # to the right; a gap ends a run, and every text ends in one
        going = going[points[p[going] + j] == items[q[going] + j]]
        length[going] += 1
        j += 1
    going, j = np.flatnonzero(same), 1
    while len(going):
        going = going[(p[going] >= j) & (q[going] >= j)]
        going = going[points[p[going] - j] == items[q[going] - j]]
        length[going] += 1
        first[going] -= 1
        j += 1
    return first, length


_FOUND = ["doc_id", "item_id", "held", "size", "first", "last"]
_PAIRS = ", ".join(f"{n} long" for n in _FOUND)


def held(texts: list[str], items: Items) -> tuple[np.ndarray, ...]:
    """Document, item, characters that the document holds of it, and the first and the last of these."""
    points, starts = laid_out(texts, _GAP)
    runs: list[np.ndarray] = []
    for p, q in items.hits(points):
        first, length = extend(points, items.points, p, q)
        item = np.searchsorted(items.starts, q, "right") - 1
        long = length >= items.pieces[item]
        doc = np.searchsorted(starts, p[long], "right") - 1
        # the hits of one run tell the same
        runs.append(np.unique(np.stack([doc, item[long], first[long], first[long] + length[long]]), axis=1))
    if not runs or not sum(r.shape[1] for r in runs):
        return (np.zeros(0, dtype=np.int64),) * 5
    doc, item, first, end = np.unique(np.concatenate(runs, axis=1), axis=1)
    begins = np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])]
    # what earlier runs of the pair have covered
    shift = np.cumsum(begins) * (len(items.points) + 1)
    upto = np.maximum.accumulate(end + shift) - shift
    before = np.where(begins, 0, np.r_[0, upto[:-1]])
    new = np.maximum(end - np.maximum(first, before), 0)
    at = np.flatnonzero(begins)
    base = items.starts[item[at]]
    return doc[at], item[at], np.add.reduceat(new, at), first[at] - base, np.maximum.reduceat(end, at) - 1 - base


def _scan(batches: Iterator[pa.RecordBatch], items: Items) -> Iterator[pa.RecordBatch]:
    for batch in bounded(batches, ["text"]):
        doc, item, n, first, last = held(letters(batch.column(1).to_pylist()), items)
        columns = [batch.column(0).cast(pa.int64()).take(pa.array(doc)), *map(pa.array, (items.ids[item], n, items.sizes[item], first, last))]
        yield pa.RecordBatch.from_arrays(columns, _FOUND)


def shared_passages(documents: DataFrame, items: DataFrame, broadcast_items: int = BROADCAST_ITEMS) -> DataFrame:
    """``doc_id, item_id, held, size, first, last``: characters of each item that each document holds, the item's
    characters, and the first and last of its characters that are held.

    ``documents``: ``doc_id, text``; ``items``: ``item_id, text, piece`` with the least length of a piece, at least
    ``K + WINDOW - 1``. Items of a checked size are sent to the documents, which then are neither shuffled nor read
    twice. Beyond it the items are worked through in blocks of that size, one after the other, so that no fingerprint
    that many documents have becomes a hot key and no text is copied; the documents are read once a block.
    """
    docs = documents.select("doc_id", "text").where("doc_id is not null and text is not null")
    items = items.select("item_id", "text", "piece").where("item_id is not null and text is not null")
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    blocks = max(-(-size["n"] // max(broadcast_items, 1)), -(-size["chars"] // BROADCAST_CHARS))

    def found_in(own: DataFrame) -> DataFrame:
        rows = own.collect()
        texts = letters([r["text"] for r in rows])
        kept = [(r["item_id"], t, r["piece"]) for r, t in zip(rows, texts, strict=True) if len(t) >= r["piece"]]
        sent = documents.sparkSession.sparkContext.broadcast(Items(*([x[n] for x in kept] for n in range(3))))
        return docs.mapInArrow(lambda batches: _scan(batches, sent.value), _PAIRS)

    if blocks <= 1:
        return found_in(items)
    # shares by hash, twice as many as needed, of about half the size that may be sent
    out = None
    for n in range(2 * blocks):
        found = cut(found_in(items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(2 * blocks)) == n)))
        out = found if out is None else out.unionByName(found)
    return out


def test_items(eval_items: DataFrame) -> DataFrame:
    """Items with the least piece that counts: 12 letters and digits, 30 in English."""
    return eval_items.select("item_id", "text", F.when(F.lower("lang").startswith("en"), 30).otherwise(12).alias("piece"))


def p8_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and item that share a piece, with the share of the item that the document holds."""
    pairs = shared_passages(table(spark, sf_dir, "documents"), test_items(table(spark, sf_dir, "eval_items")))
    return pairs.distinct().withColumn("share", F.col("held") / F.col("size"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold at least half of an item."""
    pairs = shared_passages(table(spark, sf_dir, "documents"), test_items(table(spark, sf_dir, "eval_items")))
    return pairs.where("2 * held >= size").select("doc_id", "item_id").distinct()


QUERIES = {"p8_found": p8_found, "p8_spans": p8_spans}


def _letters_sql(column: str) -> str:
    return f"regexp_replace(lower({sql_form(column)}), '[^\\p{{L}}\\p{{N}}]', '', 'g')"


_HELD_SQL = f"""
WITH docs AS (SELECT DISTINCT doc_id, {_letters_sql("text")} AS t FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL), items AS (
  SELECT item_id, {_letters_sql("text")} AS t, CASE WHEN lower(lang) LIKE 'en%' THEN 30 ELSE 12 END AS piece FROM eval_items
), doc_grams AS (
  SELECT DISTINCT doc_id, piece, substr(t, i, piece) AS gram FROM (SELECT *, unnest(range(1, length(t) - piece + 2)) AS i FROM docs, (SELECT DISTINCT piece FROM items))
), item_grams AS (
  SELECT item_id, piece, i, substr(t, i, piece) AS gram FROM (SELECT *, unnest(range(1, length(t) - piece + 2)) AS i FROM items)
), covered AS (
  SELECT DISTINCT doc_id, item_id, unnest(range(i, i + piece)) AS place FROM item_grams JOIN doc_grams USING (piece, gram)
), counts AS (SELECT doc_id, item_id, count(*) AS held, min(place) - 1 AS first, max(place) - 1 AS last FROM covered GROUP BY ALL)
"""
ORACLE_SQL = {
    "p8_found": _HELD_SQL + "SELECT doc_id, item_id FROM counts JOIN items USING (item_id) WHERE 2 * held >= length(t)",
    "p8_spans": _HELD_SQL + "SELECT doc_id, item_id, held, length(t) AS size, first, last, held / length(t) AS share FROM counts JOIN items USING (item_id)",
}
