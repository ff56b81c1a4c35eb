import random

import pytest
from pyspark.sql import functions as F

from dialoom.functions import jsonx, text
from dialoom.functions.unicode import fold, fold_joined, lookalikes, shape, simplified


def one(spark, expr, *values):
    names = [f"c{n}" for n in range(len(values))]
    df = spark.createDataFrame([tuple(values)], ", ".join(f"{n} string" for n in names))
    return df.select(expr(*map(F.col, names))).first()[0]


@pytest.mark.parametrize(
    ("function", "want"),
    [(text.term_key, "胃镜复查~!"), (text.metric_text, "胃镜（复查）。~!"), (text.question_text, "胃镜（复查）~"), (text.block_text, "胃镜（复查）"), (text.chatter_text, "胃镜（复查）"), (text.clause_text, "胃镜复查~")],
)
def test_normalisers_differ(spark, function, want):
    assert one(spark, function, "　胃 镜（复查）。~!") == want


@pytest.mark.parametrize(("said", "short", "chatter"), [("没有", True, False), ("三天了", True, False), ("肚子一直很疼", False, False), ("好的谢谢", True, True), ("好的，明天去", False, False), ("", False, False), (None, False, False)])
def test_short_answers_and_chatter(spark, said, short, chatter):
    assert one(spark, text.is_short_answer, said) is short
    assert one(spark, text.is_chatter, said) is chatter


@pytest.mark.parametrize(("name", "fit"), [("胃镜检查", True), ("Gastroscopy", False), ("胃.镜", False), ("长" * 31, False), (None, False)])
def test_display_names(spark, name, fit):
    assert one(spark, text.is_display_name, name) is fit


@pytest.mark.parametrize(("a", "b", "related"), [("腹痛", "右下腹痛", True), ("腹痛", "头晕", False), ("上腹刺痛", "下腹刺痛", True), ("", "腹痛", False), ("痛", "头痛", True)])
def test_lexical_relation(spark, a, b, related):
    assert one(spark, text.lexically_related, a, b) is related


@pytest.mark.parametrize(("evidence", "hedged"), [("好像没有发热", True), ("可能是胃部不适", True), ("没有发热", False), ("", False)])
def test_hedged_evidence(spark, evidence, hedged):
    assert one(spark, text.is_hedged_evidence, evidence) is hedged


def test_strip_and_visible(spark):
    assert one(spark, text.strip, "　 a b ​\n") == "a b"
    assert [one(spark, text.is_visible, t) for t in ("a", "​﻿", "　\n", "", None)] == [True, False, False, False, False]


@pytest.mark.parametrize(
    ("answer", "want"),
    [('{"a":1}', '{"a":1}'), ('```json\n{"a":1}\n```', '{"a":1}'), ('so: {"a":1} end', '{"a":1}'), ('{"a":1}}', None), ("[1]", None), ("", None), (None, None), ("{", None)],
)
def test_tolerant_json(spark, answer, want):
    assert one(spark, jsonx.json_object_text, answer) == want


def test_fold_and_its_tables(spark):
    assert fold("Ｃ13 ㎎ ⼤便 Dіtálоr​｡") == "C13 mg 大便 Ditálor。"
    assert fold(None) == "" and fold("é") == fold("é") != fold("e")
    assert shape("​") == "" and all(len(v) == 1 for v in lookalikes().values())
    assert "過敏性膽囊".translate(simplified(spark)) == "过敏性胆囊"


def test_texts_folded_together_are_as_alone():
    rng = random.Random(12)
    pool = "aZ é腹痛，ＡＢ①ﬁ½\u0301\u0308\u200b\ufeffｶﾞﾊﾟ\u1100\u1161\u11a8가각Αа…“”\u09c7\u09be\U0001f600\ud800㍿ﷺ\n\t"
    for _ in range(300):
        texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(8))) for _ in range(rng.randrange(1, 12))]
        assert fold_joined("\0".join(texts), "\0").split("\0") == [fold(t) for t in texts]
