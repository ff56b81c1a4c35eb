import random
from collections import Counter, defaultdict

import pytest

from dialoom.llm import frequency
from dialoom.llm.frequency import term_frequencies

DDL = "record string, terms array<string>, __turn int, occurrences int, term string"


def brute(rows, max_n):
    counts, records = Counter(), defaultdict(set)
    for record, terms, *_ in rows:
        for term in terms or []:
            if term is None or not term.strip(" 　​"):
                continue
            for t in [term] if max_n is None else [term[i : i + n] for n in range(1, max_n + 1) for i in range(len(term) - n + 1)]:
                counts[t] += 1
                records[t].add(record)
    return {(t, n, len(records[t])) for t, n in counts.items()}


@pytest.mark.parametrize("max_n", [None, 1, 3, 12])
@pytest.mark.parametrize("block", [5, 1 << 20])
def test_counts_equal_brute_force(spark, monkeypatch, max_n, block):
    monkeypatch.setattr(frequency, "BLOCK_CHARS", block)
    rng = random.Random(11)
    word = lambda: rng.choice([None, "", "　", "a", "aa", "aab", "腹痛", "腹", "😀b", "ba" * rng.randrange(1, 5)])
    rows = [(rng.choice(["r1", "r1", "r1", "r2", "r3", None]), None if rng.random() < 0.05 else [word() for _ in range(rng.randrange(4))], n, 1, "clash") for n in range(300)]
    rows += rows[:40]
    df = spark.createDataFrame(rows, DDL)
    got = [tuple(r) for r in term_frequencies(df, "record", "terms", max_n).select("term", "occurrences", "records").collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, max_n)


def test_long_terms_and_empty_tables(spark):
    long = "ab" * 200_000
    rows = [("r", [long, long + "c", "ab"], 1, 1, ""), ("s", [long], 2, 1, "")]
    got = {(r["term"], r["occurrences"], r["records"]) for r in term_frequencies(spark.createDataFrame(rows, DDL), "record", "terms").collect()}
    assert got == {(long, 2, 2), (long + "c", 1, 1), ("ab", 1, 1)}
    assert term_frequencies(spark.createDataFrame([], DDL), "record", "terms").count() == 0


def test_cut_up_records_and_tags(spark, monkeypatch):
    monkeypatch.setattr(frequency, "RECORD_ROWS", 20)
    rows = [("hot", ["0aab", "1aab", "0ba"], 1, 1, "")] * 150 + [(f"r{n}", ["0aab", "1 "], n, 1, "") for n in range(30)]
    df = spark.createDataFrame(rows, DDL)
    assert frequency.record_sizes(df, "record") == (31, {"hot": 150})
    got = {(r["term"], r["occurrences"], r["records"]) for r in term_frequencies(df, "record", "terms", tag=1).collect()}
    assert got == {("0aab", 180, 31), ("1aab", 150, 1), ("0ba", 150, 1)}
    runs = {(r["term"], r["occurrences"], r["records"]) for r in term_frequencies(df, "record", "terms", max_n=12, tag=1).collect()}
    assert ("0a", 510, 31) in runs and ("1aa", 150, 1) in runs and ("0ba", 150, 1) in runs and ("0abb", 1, 1) not in runs


def test_intervals_of_the_suffix_array():
    suffixes = frequency.Suffixes(["abab", "ba", "😀b"], whole=False)
    texts = ["abab", "ba", "😀b"]
    inner = [(t, n) for t in range(3) for n in range(len(texts[t]))]
    spots = {int(suffixes.begins[t]) + 1 + n: texts[t][n:] for t, n in inner}
    order = [spots[s] for s in suffixes.order.tolist()]
    assert order == sorted(order)
    common = lambda a, b: next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    assert suffixes.lcp.tolist() == [0, *(common(a, b) for a, b in zip(order, order[1:]))]
