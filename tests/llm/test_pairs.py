from pathlib import Path

import pytest

from dialoom.llm import language
from dialoom.llm.pairs import defective_pairs
from dialoom.session import table

DDL = "id int, block array<string>, question string, target string, said string, empty int"
#: Sound questions, from which the endings are learnt.
SOUND = [(1000 + n, ["我腹痛三天"], q, "腹痛", "clash", 1) for n, q in enumerate(["腹痛的程度怎么样？", "家里人有没有同样的腹痛？", "您吃过什么药物？", "腹痛的部位在哪里？", "腹痛多久了？"] * 4)]


@pytest.fixture(scope="module")
def model(spark):
    path = Path("/root/testdata/sf0.01")
    if not path.exists():
        pytest.skip("no test tables")
    return language.fit(table(spark, str(path), "documents"))


def judged(spark, model, block, question, target="腹痛"):
    df = spark.createDataFrame([*SOUND, (1, block, question, target, "clash", 1), (1, block, question, target, "clash", 1)], DDL)
    rows = defective_pairs(df, ["id"], model).collect()
    assert [r["id"] for r in rows] in ([], [1])
    return rows[0]["defects"] if rows else []


BLOCK = ["右下腹刺痛三天，吃过 Norvial 10 mg"]


@pytest.mark.parametrize(
    ("question", "target", "want"),
    [
        ("腹痛的程度怎么样", "腹痛", []), ("腹痛的程度怎", "腹痛", ["truncated"]), ("腹痛的程度怎...", "腹痛", ["truncated"]), ("您吃过什么", "腹痛", ["truncated"]), ("还有别的不舒服吗", "腹痛", []), ("做过CT或者HP检测吗？", "腹痛", []),
        ("您刚才说“右下腹刺痛", "腹痛", ["truncated"]), ("", "腹痛", ["empty"]), (None, "腹痛", ["empty"]), ("……", "腹痛", ["empty"]), ("N/A", "腹痛", ["empty"]), ("（空）", "腹痛", ["empty"]), ("​", "腹痛", ["empty"]),
        ("腹痛多久了？", None, ["empty"]), ("腹痛多久了？", " ", ["empty"]), ("抱歉，我无法就腹痛提供问诊建议。", "腹痛", ["refusal"]), ("作为人工智能助手，我不能继续询问腹痛。", "腹痛", ["refusal"]),
        ("对不起，刚才没看清，腹痛多久了？", "腹痛", []), ("这个问题比较重要，不能忽略，腹痛多久了？", "腹痛", []), ("如果不方便回答也可以跳过，腹痛多久了？", "腹痛", []), ("I'm sorry, but I can't help with that.", "腹痛", ["refusal", "language"]),
        ("右下腹刺痛三天，吃过 Norvial 10 mg。", "腹痛", ["copy"]), ("您说：右下腹刺痛三天，吃过 Norvial 10 mg。", "腹痛", ["copy"]), ("右下腹刺​痛三天 吃过 Ｎorvial 10 mg。", "腹痛", ["copy"]),
        ("您刚才说“右下腹刺痛三天”，腹痛多久了？", "腹痛", []), ("Seit wann haben Sie Blähungen?", "腹痛", ["language"]), ("Как давно у вас изжога?", "腹痛", ["language"]), ("便秘は一日に何回くらい起こりますか。", "腹痛", ["language"]), ("설사 증상은 언제부터 있었나요?", "腹痛", ["language"]),
    ],
)
def test_defects(spark, model, question, target, want):
    assert judged(spark, model, BLOCK, question, target) == want


@pytest.mark.parametrize(
    ("block", "question", "want"),
    [
        (["I have had nausea for 17 days and it usually starts late at night."], "How long have you had nausea?", []), (["I have had nausea for 17 days and it usually starts late at night."], "O incômodo piora de madrugada?", ["language"]),
        (["I have had nausea for 17 days and it usually starts late at night."], "Depuis quand avez-vous ces symptômes ?", ["language"]), (["I have had nausea for 17 days and it usually starts late at night."], "腹痛多久了？", ["language"]),
        (["腹痛三天了"], "O incômodo piora de madrugada?", ["language"]), (["吃过 Vél-inol 15 mg"], "腹痛多久了？", []), (["Omeprazol 20 mg"], "腹痛多久了？", []),
        (None, "腹痛多久了？", []), ([None, ""], "腹痛多久了？", []), (["嗯"], "腹痛多久了？", []),
    ],
)
def test_languages(spark, model, block, question, want):
    assert judged(spark, model, block, question) == want


def test_long_texts_and_empty_tables(spark, model):
    long = "腹痛三天，" * 20_000
    assert judged(spark, model, [long], long + "好") == ["copy", "truncated"]
    assert defective_pairs(spark.createDataFrame([], DDL), ["id"], model).count() == 0


def test_several_pairs_of_one_id(spark, model):
    rows = [*SOUND, (1, BLOCK, "", "腹痛", "", 1), (1, BLOCK, "腹痛多久了？", "腹痛", "", 1), (1, BLOCK, "腹痛的程度怎", "腹痛", "", 1), (1, BLOCK, "腹痛的程度怎", "腹痛", "", 1)]
    assert [tuple(r) for r in defective_pairs(spark.createDataFrame(rows, DDL), ["id"], model).collect()] == [(1, ["empty", "truncated"])]
