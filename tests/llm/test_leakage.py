import random

import numpy as np
import pytest

from dialoom.llm import leakage as L

DOCS, ITEMS = "doc_id long, text string, item_id int, held string", "item_id long, text string, piece int, lang string"


def brute(docs, items):
    out = set()
    for d, text, *_ in docs:
        for i, passage, piece, *_ in items:
            a, b = L.letters([text, passage])
            spots = {p for k in range(len(b) - piece + 1) if b[k : k + piece] in a for p in range(k, k + piece)}
            if spots:
                out.add((d, i, len(spots), len(b), min(spots), max(spots)))
    return out


@pytest.mark.parametrize("most", [0, L.BROADCAST_ITEMS])
def test_pairs_equal_brute_force(spark, most):
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("一二三四五六七八九十甲乙丙丁") for _ in range(n))
    items = [(n, text(60), 12, "zh") for n in range(12)] + [(90, "short", 12, "zh"), (91, None, 12, ""), (92, "the quick brown fox jumps over the lazy dog again and again", 30, "en")]
    docs = []
    for n in range(40):
        i = rng.choice(items[:12])[1]
        a = rng.randrange(50)
        docs.append((n, text(30) + "，\n".join([i[a : a + rng.randrange(5, 40)], text(20)]) + " ​".join(i[:14]), 1, "clash"))
    docs += [(100, None, 1, ""), (101, "", 1, ""), (102, "ＴＨＥ QUICK brown—fox jumps over the lazy cat", 1, ""), (103, "the quick brown fox", 1, "")] + docs[:3]
    got = L.shared_passages(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), most)
    assert {tuple(r) for r in got.collect()} == brute(docs, items)


def prints(text):
    points, _ = L.laid_out([text], L._GAP)
    hashes = L.kgram_hashes(points, L._GAP)
    return hashes, L.winnow(hashes)


def test_every_long_shared_run_has_a_common_fingerprint_at_one_place():
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    for _ in range(300):
        run, a, b = text(L.K + L.WINDOW - 1), text(rng.randrange(20)), text(rng.randrange(20))
        (_, x), (_, y) = prints(a + run + text(rng.randrange(20))), prints(b + run + text(rng.randrange(20)))
        assert {p - len(a) for p in x} & {p - len(b) for p in y} & set(range(L.WINDOW))


def test_fingerprints_are_the_least_of_their_windows():
    hashes, spots = prints("".join(random.Random(1).choice("abcdefgh") for _ in range(500)))
    whole = hashes[: 500 - L.K + 1].tolist()
    want = {k for n in range(len(whole) - L.WINDOW + 1) for k in range(n, n + L.WINDOW) if whole[k] == min(whole[n : n + L.WINDOW])}
    assert want <= set(spots.tolist()) and len(spots) <= len(want) + L.WINDOW


def test_hits_in_parts_and_repeated_phrases(monkeypatch):
    rng = random.Random(6)
    phrase = "".join(rng.choice("一二三四五六七八九十") for _ in range(20))
    docs = [phrase * 30, phrase[:13] * 40 + phrase, "x" * 500, phrase[5:19] + "y" + phrase[1:14]]
    items = [(1, phrase * 2 + "甲乙", 12), (2, phrase[3:] + "丙" + phrase, 12), (3, "x" * 40, 30)]
    built = L.Items(*map(list, zip(*items)))
    want = {(n, i, *rest) for n, i, *rest in brute(list(enumerate(docs)), [(i, t, p) for i, t, p in items])}
    for hits in (7, 1_000_000):
        monkeypatch.setattr(L, "HITS", hits)
        doc, item, n, first, last = L.held(docs, built)
        assert set(zip(doc.tolist(), built.ids[item].tolist(), n.tolist(), built.sizes[item].tolist(), first.tolist(), last.tolist())) == want


def test_empty_tables(spark):
    d, i = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    full = spark.createDataFrame([(1, "x" * 40, 1, "")], DOCS)
    assert L.shared_passages(d, i).count() == L.shared_passages(full, i).count() == L.shared_passages(full, i, -1).count() == 0
