import random

import numpy as np
import pytest

from dialoom.llm import canonical as C

ENTRIES = [
    ("symptom", "腹痛", "S1"), ("symptom", "肚子疼", "S1"), ("symptom", "上腹刺痛", "S2"), ("symptom", "左上腹刺痛", "S3"), ("symptom", "里急后重", "S4"), ("symptom", "胃脘发凉", "S5"),
    ("disease", "感染性胃体水肿", "D1"), ("disease", "旧称4号症", "D1"), ("disease", "旧称4号症", "D2"), ("medicine", "Ombérium", "M1"), ("medicine", "蓝适酶素缓释片", "M2"), ("medicine", "腹痛", "M3"), ("symptom", None, "S9"), (None, "x", "S9"),
]


def coded(spark, names, block=C.BLOCK_ENTRIES):
    df = spark.createDataFrame([(t, n, h) for t, n, h in names], "type string, name string, hint string")
    entries = spark.createDataFrame(ENTRIES, "type string, alias string, code string")
    return {(r["type"], r["name"], r["hint"]): (r["code"], r["way"]) for r in C.map_names(df, entries, block).collect()}


CASES = [
    ("symptom", "腹痛", None, "S1"), ("symptom", "腹​ 痛", None, "S1"), ("symptom", "那个肚子疼", None, "S1"), ("symptom", "肚子疼的情况", None, "S1"), ("symptom", "腹痛（待查）", None, "S1"), ("symptom", "左上腹刺痛", None, "S3"),
    ("symptom", "左上上腹刺痛", None, "S3"), ("symptom", "左上复刺痛", None, "S3"), ("symptom", "有点上腹刺痛", None, "S2"), ("symptom", "里急后", None, "S4"), ("symptom", "里急重后", None, "S4"), ("symptom", "胃脘發涼", None, "S5"),
    ("disease", "感染性味体水肿", None, "D1"), ("disease", "旧称4号症", None, "D1"), ("medicine", "OMBERIUM", None, "M1"), ("medicine", "ombérium 10毫克", None, "M1"), ("medicine", "蓝适素酶缓释片×2盒", None, "M2"),
    ("symptom", "手机称重", None, None), ("symptom", "脚踝打飘", "腹痛", None), ("symptom", "", None, None), ("symptom", None, None, None), ("symptom", "（", None, None), (None, "腹痛", None, None), ("history", "腹痛", None, None),
]


@pytest.mark.parametrize("block", [C.BLOCK_ENTRIES, 6])
def test_names_find_their_entries(spark, block):
    got = coded(spark, [c[:3] for c in CASES], block)
    assert {k: v[0] for k, v in got.items()} == {c[:3]: c[3] for c in CASES}


def test_hints_settle_ties(spark):
    # "腹刺痛" lies as near to one as to the other
    assert coded(spark, [("symptom", "上腹刺", "左上腹刺痛")])["symptom", "上腹刺", "左上腹刺痛"][0] in ("S2", "S3")
    assert coded(spark, [("disease", "旧称4号症", "旧称4号症")])["disease", "旧称4号症", "旧称4号症"] == ("D1", "exact")


def test_hints_settle_ties_in_blocks(spark):
    entries = spark.createDataFrame([("symptom", "旧称4号症", "D1"), ("symptom", "旧称4号症", "D2"), ("symptom", "水肿", "D2"), *(("symptom", f"别名{n}", f"X{n}") for n in range(20))], "type string, alias string, code string")
    names = [("symptom", "旧称4号症", "水肿"), ("symptom", "旧称4号症", None), ("symptom", "那个旧称4号症", "水肿"), ("symptom", "头晕", "水肿")]
    df = spark.createDataFrame(names, "type string, name string, hint string")
    for block in (C.BLOCK_ENTRIES, 6):
        got = {(r["name"], r["hint"]): r["code"] for r in C.map_names(df, entries, block).collect()}
        assert [got[n[1:]] for n in names] == ["D2", "D1", "D2", None]


def test_long_names_and_empty_lists(spark):
    long = "说不清楚" * 50_000 + "里急后重" + "没有" * 1000
    assert coded(spark, [("symptom", long, None)])["symptom", long, None] == ("S4", "mention")
    df = spark.createDataFrame([("symptom", "腹痛", None)], "type string, name string, hint string")
    none = spark.createDataFrame([], "type string, alias string, code string")
    assert C.map_names(df, none).first()["code"] is None and C.map_names(df.limit(0), none).count() == 0


@pytest.mark.parametrize("words", [40, 60, 94, 95, 96, 97, 98, 99, 100, 150, 5000])
def test_misspelt_entries_are_found_in_long_names(words):
    filled = "说不" * words
    entries = C.Entries([("感染性胃体水肿", "D1"), ("里急后重", "S4")])
    for name in (filled + "感染性味体水肿" + filled, filled + "感染性味体水肿", "感染性味体水肿" + filled):
        affixes = C.AFFIX * (name.startswith("说") + name.endswith("不"))
        similar = entries.similar([name])[0]
        assert entries.code(name, set(), similar) == ("D1", "similar", pytest.approx(1 / (2 + affixes)))
        assert ("感染性胃体水肿", "D1") in entries.rivals(name, similar)
    assert entries.code(filled, set(), entries.similar([filled])[0])[0] is None


def test_an_alias_longer_than_half_a_piece_is_found_in_long_names():
    alias = "".join(chr(0x4E00 + n) for n in range(150))
    name = "说不" * 200 + alias[:70] + "误" + alias[71:] + "说不" * 200
    entries = C.Entries([(alias, "L"), ("腹痛", "S1")])
    assert entries.code(name, set(), entries.similar([name])[0])[:2] == ("L", "similar")


def test_facts_are_coded_once(spark):
    ddl = "dialogue_id string, turn_id int, fact_pos int, type string, name string, normalized_name string, standard_code string, code string, way string"
    rows = [("d", 1, 0, "symptom", "腹痛吧", None, None, "clash", ""), ("d", 1, 0, "symptom", "腹痛吧", None, None, "clash", ""), ("d", 1, 1, "symptom", None, None, None, "", ""), ("d", 2, 0, "symptom", "腹痛", None, "X", "", ""), ("d", 2, 1, "other", "腹痛", None, None, "", "")]
    terms = spark.createDataFrame([("symptom", "S1", "腹痛", "腹痛"), ("symptom", "S1", "腹痛", None)], "semantic_type string, code string, preferred_name string, alias string")
    got = C.coded_facts(spark.createDataFrame(rows, ddl), terms).select("turn_id", "fact_pos", "code").collect()
    assert sorted(map(tuple, got)) == [(1, 0, "S1"), (1, 1, "UNMATCHED")]


@pytest.mark.parametrize(("name", "alias", "cost"), [("腹痛", "腹痛", 0), ("那个腹痛", "腹痛", 0.4), ("那个腹痛吧", "腹痛", 0.8), ("腹疼痛", "腹痛", 1), ("痛腹", "腹痛", 1), ("上腹通", "上腹痛", 1), ("头晕", "腹痛", float("inf"))])
def test_alignment(name, alias, cost):
    assert C.alignments([name], [alias], np.array([1.8]), np.array([True]), np.array([True]))[0] == pytest.approx(cost)


def slow_alignment(name, alias, most, first, last):
    """The table of edits cell by cell."""
    before = [0.0 if first else C.AFFIX] + [C.AFFIX] * len(name)
    older = []
    for i, a in enumerate(alias, 1):
        row = [float(i)]
        for j in range(1, len(name) + 1):
            best = min(before[j - 1] + (a != name[j - 1]), before[j] + 1, row[j - 1] + 1)
            if i > 1 and j > 1 and a == name[j - 2] and alias[i - 2] == name[j - 1]:
                best = min(best, older[j - 2] + 1)
            row.append(best)
        older, before = before, row
    cost = min(x + C.AFFIX * (j < len(name) or not last) for j, x in enumerate(before))
    return cost if cost <= most + 1e-9 else float("inf")


def test_alignments_side_by_side_equal_the_table():
    rng = random.Random(8)
    pairs = [("".join(rng.choice("腹痛胀头") for _ in range(rng.randrange(1, 12))), "".join(rng.choice("腹痛胀头") for _ in range(rng.randrange(1, 9))), rng.choice([0.9, 1.8, 3.0]), rng.random() < 0.7, rng.random() < 0.7) for _ in range(3000)]
    names, aliases, most, first, last = zip(*pairs, strict=True)
    got = C.alignments(list(names), list(aliases), np.array(most), np.array(first), np.array(last))
    assert got.tolist() == pytest.approx([slow_alignment(*p) for p in pairs])


def test_token_sets_leave_out_no_entry_that_is_near():
    """Recall of the token-set similarity against an alignment of every name with every entry, of four characters and more."""
    rng = random.Random(9)
    aliases = sorted({"".join(rng.choice("上下左右腹胸胃肠刺胀灼痛炎症") for _ in range(rng.randrange(4, 9))) for _ in range(300)})
    entries = C.Entries([(a, a) for a in aliases])
    names = []
    for alias in rng.sample(aliases, 100):
        k = rng.randrange(len(alias))
        names.append("有点" * rng.randrange(2) + rng.choice([alias[:k] + alias[k + 1 :], alias[:k] + "骨" + alias[k + 1 :], alias[:k] + "骨" + alias[k:]]))
    hit = total = 0
    for name, found in zip(names, entries.similar(names), strict=True):
        costs = {a: slow_alignment(name, a, C.most_edits(a), True, True) for a in aliases}
        least = min(costs.values())
        near = {a for a, c in costs.items() if c == least < float("inf")}
        total += len(near)
        hit += sum(found.get(a) == pytest.approx(least) for a in near)
    assert hit >= 0.99 * total
