"""Occurrences and record counts of every distinct term and n-gram, by suffix arrays with common-prefix intervals.

Each task works on bounded blocks. A block keeps every distinct term once, with its occurrences; the suffixes of these
terms are sorted, and neighbouring suffixes with a common prefix of ``n`` characters form the interval of that n-gram.
A whole term is the n-gram of the term in its frame of two marks that no text has, so that it is read from the same
intervals. The occurrences of an interval are those of its suffixes' terms; in the order of their records, every
neighbour from the same record is taken off, which leaves the number of records.

Records lie together after a hash partitioning, so that a block counts whole records. Only the first and the last
record of a block may go on elsewhere, as do records of more than ``RECORD_ROWS`` rows, which are cut up; their counts
carry the record's id until all blocks are added up.

Defined results: null and blank terms are left out, null records count as one record, empty tables give no row,
repeated rows count as often as they are there, terms of any length are whole, extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions.text import BLANKS
from dialoom.session import table

#: Characters of the terms of one block.
BLOCK_CHARS = 1 << 21
#: Rows of a record from which on it is cut up, and most records that are (those with the most rows).
RECORD_ROWS = 200_000
CUT_RECORDS = 10_000

#: Marks around a term in the text of the suffixes, beyond all code points.
_BEGIN, _END = 0x110001, 0x110000

_SCHEMA = pa.schema([("term", pa.string()), ("record", pa.string()), ("occurrences", pa.int64()), ("records", pa.int64())])
_DDL = "term string, record string, occurrences long, records long"


class Suffixes:
    """The suffix array of distinct terms, each in its frame, with the common prefixes of neighbours."""

    def __init__(self, terms: list[str], whole: bool) -> None:
        """``whole``: only the suffixes that begin with a frame are sorted, from which whole terms are read."""
        lengths = np.array([len(t) for t in terms], dtype=np.int64)
        stops = np.cumsum(lengths + 2)
        self.begins = stops - lengths - 2
        self.text = np.full(int(stops[-1]), _END, dtype=np.uint32)
        inner = np.ones(len(self.text), dtype=bool)
        inner[self.begins] = inner[stops - 1] = False
        self.text[self.begins] = _BEGIN
        self.text[inner] = np.frombuffer("".join(terms).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        self.term = np.repeat(np.arange(len(terms)), lengths + 2)
        # a frame's end belongs to whole terms alone: an n-gram ends before it
        self.ends = np.repeat(stops if whole else stops - 1, lengths + 2)
        levels = self._ranks(int((lengths + 2).max()))
        spots = self.begins if whole else np.flatnonzero(inner)
        self.order = spots[np.argsort(levels[-1][spots], kind="stable")]
        self.lcp = self._common_prefixes(levels)

    def _ranks(self, length: int) -> list[np.ndarray]:
        """Rank of every suffix by its first 1, 2, 4, … characters, none beyond its end, until all that differ are told apart."""
        at = np.arange(len(self.text))
        levels, done = [np.unique(self.text, return_inverse=True)[1].astype(np.int64) + 1], 1
        while done < length:
            rank, nxt = levels[-1], at + done
            second = np.where(nxt < self.ends, rank[np.minimum(nxt, len(rank) - 1)], 0)
            new = np.unique(rank * (rank.max() + 1) + second, return_inverse=True)[1].astype(np.int64) + 1
            levels.append(new)
            done *= 2
            if new.max() == rank.max():
                break
        return levels

    def _common_prefixes(self, levels: list[np.ndarray]) -> np.ndarray:
        """Characters that each suffix of the order has in common with the one before it."""
        lcp = np.zeros(len(self.order), dtype=np.int64)
        a, b = self.order[:-1].copy(), self.order[1:].copy()
        for k in range(len(levels) - 1, -1, -1):
            # the top level may be passed several times, as ranks end where all that differ are told apart
            while True:
                inside = (a < self.ends[self.order[:-1]]) & (b < self.ends[self.order[1:]])
                last = len(self.text) - 1
                same = inside & (levels[k][np.minimum(a, last)] == levels[k][np.minimum(b, last)])
                step = np.where(same, np.minimum(1 << k, self.ends[self.order[:-1]] - a), 0)
                lcp[1:] += step
                a += step
                b += step
                if k < len(levels) - 1 or not same.any():
                    break
        return lcp

    def intervals(self, n: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that have ``n`` characters (one number, or one a suffix of the order) and the interval of each."""
        long = self.order + n <= self.ends[self.order]
        group = np.cumsum(self.lcp < n)[long]
        return self.order[long], np.cumsum(np.r_[False, group[1:] != group[:-1]][: len(group)])


class Occurrences:
    """Where the distinct terms of a block occur: the records of each one's occurrences."""

    def __init__(self, codes: np.ndarray, records: np.ndarray, terms: int) -> None:
        by = np.argsort(codes, kind="stable")
        self.records = records[by]
        self.counts = np.bincount(codes, minlength=terms)
        self.first = np.cumsum(self.counts) - self.counts

    def of(self, group: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Interval and record of every occurrence of the suffixes of the intervals ``group``, in that order."""
        n = self.counts[term]
        spots = np.repeat(self.first[term] - np.cumsum(n) + n, n) + np.arange(n.sum())
        size = int(self.records.max()) + 1
        # sorted, so that the occurrences from one record are neighbours
        key = np.sort(np.repeat(group, n) * size + self.records[spots])
        return key // size, key % size


def interval_counts(group: np.ndarray, record: np.ndarray, is_open: np.ndarray) -> tuple[np.ndarray, ...]:
    """Interval, open record (-1: closed ones together), occurrences and records, of sorted occurrences."""
    # the duplicate adjacencies: neighbours from one record
    again = np.r_[False, (group[1:] == group[:-1]) & (record[1:] == record[:-1])]
    closed = ~is_open[record]
    size = int(group.max()) + 1
    occurrences = np.bincount(group[closed], minlength=size)
    records = occurrences - np.bincount(group[closed & again], minlength=size)
    some = np.flatnonzero(occurrences)
    starts = np.flatnonzero(~again)
    times = np.diff(np.r_[starts, len(group)])
    mine = is_open[record[starts]]
    ones = starts[mine]
    return (
        np.r_[some, group[ones]],
        np.r_[np.full(len(some), -1), record[ones]],
        np.r_[occurrences[some], times[mine]],
        np.r_[records[some], np.ones(len(ones), dtype=np.int64)],
    )


def _block(record: pa.Array, cut_up: np.ndarray, lists: pa.Array, tag: int, max_n: int | None) -> Iterator[pa.RecordBatch]:
    flat = pc.list_flatten(lists)
    row = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    distinct = flat.dictionary_encode()
    codes = pc.fill_null(distinct.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    terms = distinct.dictionary.to_pylist()
    kept = np.array([bool(t[tag:].strip(BLANKS)) for t in terms] + [False])
    row, codes = row[kept[codes]], codes[kept[codes]]
    if not len(codes):
        return
    # records in the order of their rows; a null record is one
    known = record.dictionary_encode()
    names = [*known.dictionary.to_pylist(), None]
    own = pc.fill_null(known.indices, len(names) - 1).to_numpy(zero_copy_only=False).astype(np.int64)
    is_open = np.zeros(len(names), dtype=bool)
    is_open[[own[0], own[-1]]] = True
    is_open[own[cut_up]] = True
    record_of = own[row]

    def rows(texts: pa.Array, found: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
        _, part, occurrences, records = found
        ids = pa.array([None if p < 0 else "n" if names[p] is None else "r" + names[p] for p in part.tolist()], pa.string())
        whole = pa.RecordBatch.from_arrays([texts, ids, pa.array(occurrences), pa.array(records)], schema=_SCHEMA)
        for k in range(0, whole.num_rows, 50_000):
            yield whole.slice(k, 50_000)

    # terms of one tag are one text
    used, codes = np.unique(codes, return_inverse=True)
    used_terms = [terms[k] for k in used.tolist()]
    tags: dict[str, list[int]] = {}
    for k, term in enumerate(used_terms):
        tags.setdefault(term[:tag], []).append(k)
    place = np.zeros(len(used), dtype=np.int64)
    label = np.zeros(len(used), dtype=np.int64)
    for n, (_, mine) in enumerate(tags.items()):
        place[mine], label[mine] = np.arange(len(mine)), n
    for n, (mark, mine) in enumerate(tags.items()):
        here = label[codes] == n
        own_terms = [used_terms[k][tag:] for k in mine]
        spread = Occurrences(place[codes[here]], record_of[here], len(mine))
        suffixes = Suffixes(own_terms, whole=max_n is None)
        if max_n is None:
            spots, group = suffixes.intervals(suffixes.ends[suffixes.order] - suffixes.order)
            term_of = np.zeros(int(group.max()) + 1, dtype=np.int64)
            term_of[group] = suffixes.term[spots]
            found = interval_counts(*spread.of(group, suffixes.term[spots]), is_open)
            yield from rows(pa.array([mark + own_terms[k] for k in term_of[found[0]].tolist()], pa.string()), found)
            continue
        joined = "".join(own_terms)
        for size in range(1, min(max_n, max(map(len, own_terms))) + 1):
            spots, group = suffixes.intervals(size)
            if not len(spots):
                break
            found = interval_counts(*spread.of(group, suffixes.term[spots]), is_open)
            begin = np.zeros(int(group.max()) + 1, dtype=np.int64)
            begin[group] = spots - 2 * suffixes.term[spots] - 1  # the place without the frames
            yield from rows(pa.array([mark + joined[a : a + size] for a in begin[found[0]].tolist()], pa.string()), found)


def _count(batches: Iterator[pa.RecordBatch], tag: int, max_n: int | None) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    chars = 0

    def flush() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        record, cut_up, lists = (rows.column(c).combine_chunks() for c in ("record", "cut_up", "terms"))
        yield from _block(record, cut_up.to_numpy(zero_copy_only=False), lists, tag, max_n)

    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column("terms")
        length = pc.fill_null(pc.utf8_length(pc.list_flatten(lists)), 0).to_numpy(zero_copy_only=False)
        upto = np.cumsum(np.bincount(pc.list_parent_indices(lists).to_numpy(zero_copy_only=False), length, minlength=batch.num_rows))
        at = 0
        while at < batch.num_rows:
            before = upto[at - 1] if at else 0
            end = min(int(np.searchsorted(upto, before + BLOCK_CHARS - chars)) + 1, batch.num_rows)
            held.append(batch.slice(at, end - at))
            chars += int(upto[end - 1] - before)
            at = end
            if chars >= BLOCK_CHARS:
                yield from flush()
                held, chars = [], 0
    if held:
        yield from flush()


def record_sizes(df: DataFrame, record: str) -> tuple[int, dict[str | None, int]]:
    """How many records there are, and the rows of those that are to be cut up."""
    sizes = df.groupBy(F.col(record).cast("string").alias("record")).agg(F.count("*").alias("n"))
    records, most = sizes.agg(F.count("record"), F.coalesce(F.max("n"), F.lit(0))).first()
    large = sizes.where(F.col("n") > RECORD_ROWS).orderBy(F.desc("n")).limit(CUT_RECORDS).collect() if most > RECORD_ROWS else []
    return records, {r["record"]: r["n"] for r in large}


def term_frequencies(df: DataFrame, record: str, terms: str | Column, max_n: int | None = None, tag: int = 0, large: dict[str | None, int] | None = None) -> DataFrame:
    """``term, occurrences, records`` of every distinct entry of the array ``terms``, or with ``max_n`` of every
    run of up to so many characters inside the entries.

    ``tag``: so many first characters of every entry name its kind; they stand before every term, and runs of
    different kinds are counted apart. ``large``: the records to be cut up, by :func:`record_sizes` if not given. A
    record with any share of all rows, or any number of copies of one row, is cut up by the place of its rows.
    """
    if large is None:
        large = record_sizes(df, record)[1]
    rows = df.select(F.col(record).cast("string").alias("record"), (F.col(terms) if isinstance(terms, str) else terms).alias("terms"))
    if large:  # CUT_RECORDS at most
        shares = df.sparkSession.createDataFrame([(own, -(-n // RECORD_ROWS)) for own, n in large.items()], "own string, shares long")
        rows = rows.join(F.broadcast(shares), F.col("record").eqNullSafe(F.col("own")), "left").withColumn("shares", F.coalesce("shares", F.lit(1)))
        rows = rows.select("record", (F.col("shares") > 1).alias("cut_up"), F.pmod(F.monotonically_increasing_id(), F.col("shares")).alias("share"), "terms")
    else:
        rows = rows.select("record", F.lit(False).alias("cut_up"), F.lit(0).alias("share"), "terms")
    rows = rows.repartition("record", "share").sortWithinPartitions("record").drop("share")
    blocks = rows.mapInArrow(lambda batches: _count(batches, tag, max_n), _DDL)
    whole = blocks.groupBy("term", "record").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))
    counted = F.when(F.col("record").isNull(), F.col("records")).otherwise(F.lit(1))
    return whole.groupBy("term").agg(F.sum("occurrences").alias("occurrences"), F.sum(counted).alias("records"))


FIELDS = ["normalized_name", "attribute_key", "attribute_value"]


def fact_terms() -> Column:
    """The terms of a fact, each behind the number of its field in ``FIELDS``."""
    none = F.array().cast("array<string>")
    values = F.split(F.array_join(F.map_values("attribute"), "；"), "；")
    name = F.array(F.concat(F.lit("0"), F.col("normalized_name")))
    keys = F.transform(F.coalesce(F.map_keys("attribute"), none), lambda t: F.concat(F.lit("1"), t))
    return F.concat(name, keys, F.transform(F.coalesce(values, none), lambda t: F.concat(F.lit("2"), t)))


def _field_and(out: str) -> list[Column]:
    """The field that a tagged term is of, and the term."""
    return [F.get(F.array(*map(F.lit, FIELDS)), F.substring("term", 1, 1).cast("int")).alias("field"), F.substr("term", F.lit(2)).alias(out)]


def marked_frequencies(facts: DataFrame, rare: int = 2, common: float = 0.05) -> DataFrame:
    """``field, term, occurrences, dialogues, mark`` of all terms of the facts; mark is rare, common or null."""
    total, large = record_sizes(facts, "dialogue_id")
    counts = term_frequencies(facts, "dialogue_id", fact_terms(), tag=1, large=large)
    mark = F.when(F.col("records") <= rare, "rare").when(F.col("records") >= F.lit(common) * total, "common")
    return counts.select(*_field_and("term"), "occurrences", F.col("records").alias("dialogues"), mark.alias("mark"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of the facts in too few or too many dialogues."""
    return marked_frequencies(table(spark, sf_dir, "facts")).where("mark is not null").select("field", "term", "mark")


def p5_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences and dialogues of all terms, as the rows of facts are stored."""
    return marked_frequencies(table(spark, sf_dir, "facts"))


#: Longer runs of a text are counted only on demand: their number grows with the square of its length.
LONGEST_RUN = 64


def p5_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences and dialogues of all runs of up to ``LONGEST_RUN`` characters of the terms of the facts, by field."""
    counts = term_frequencies(table(spark, sf_dir, "facts"), "dialogue_id", fact_terms(), max_n=LONGEST_RUN, tag=1)
    return counts.select(*_field_and("ngram"), "occurrences", F.col("records").alias("dialogues"))


_TERMS_SQL = """
WITH terms AS (
  SELECT dialogue_id, 'normalized_name' AS field, normalized_name AS term FROM facts
  UNION ALL SELECT dialogue_id, 'attribute_key', unnest(map_keys(attribute)) FROM facts
  UNION ALL SELECT dialogue_id, 'attribute_value', unnest(string_split(v, '；')) FROM (SELECT dialogue_id, unnest(map_values(attribute)) AS v FROM facts)
), counts AS (
  SELECT field, term, count(*) AS occurrences, count(DISTINCT dialogue_id) AS dialogues FROM terms
  WHERE term IS NOT NULL AND NOT regexp_full_match(term, '[\\s\\p{Z}\\p{Cf}]*') GROUP BY ALL
), marked AS (
  SELECT *, CASE WHEN dialogues <= 2 THEN 'rare' WHEN dialogues >= 0.05 * (SELECT count(DISTINCT dialogue_id) FROM facts) THEN 'common' END AS mark FROM counts
)
"""
QUERIES = {"p5_found": p5_found, "p5_counts": p5_counts, "p5_ngrams": p5_ngrams}
ORACLE_SQL = {
    "p5_found": _TERMS_SQL + "SELECT field, term, mark FROM marked WHERE mark IS NOT NULL",
    "p5_counts": _TERMS_SQL + "SELECT field, term, occurrences, dialogues, mark FROM marked",
    "p5_ngrams": _TERMS_SQL
    + f"""
SELECT field, ngram, count(*) AS occurrences, count(DISTINCT dialogue_id) AS dialogues
FROM (SELECT field, dialogue_id, unnest(list_transform(range(1, length(term) - n + 2), lambda i: array_slice(term, i, i + n - 1))) AS ngram
      FROM (SELECT * FROM terms WHERE term IS NOT NULL AND NOT regexp_full_match(term, '[\\s\\p{{Z}}\\p{{Cf}}]*')), range(1, {LONGEST_RUN + 1}) AS r(n) WHERE length(term) >= n)
GROUP BY ALL
""",
}
