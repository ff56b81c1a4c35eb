import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dialoom.functions.unicode import fold, shape
from dialoom.llm.lookalike import one_form, same_reading

ALPHABET = "ab腹痛⼤㎎Ｃ​﻿\xa0　́дсоВééö｡.' \"--–μΜ①ﬁ︎"


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(st.sampled_from(ALPHABET), max_size=12), min_size=1, max_size=20))
def test_form_equals_its_python_twin(spark, texts):
    df = spark.createDataFrame([(t, 1) for t in texts], "t string, extra int")
    assert [r["form"] for r in one_form(df, {"t": "form"}).collect()] == [fold(t) for t in texts]


@pytest.mark.parametrize(
    ("evidence", "utterance", "found"),
    [
        ("腹痛", "我腹痛", False), ("腹​痛", "我腹痛", True), ("⼤便", "大便", True), ("10 mg", "吃了10 ㎎", True), ("CT", "做了СТ", True), ("Qe\u0301u", "Q\u00e9u", True), ("Qeu", "Qéu", False),
        ("ct", "CT", False), ("過敏", "过敏", False), ("腹 痛", "腹痛", False), ("腹\xa0痛", "腹 痛", True), ("腹痛。", "腹痛｡", True), ("头痛", "腹痛", False), (None, "腹痛", False), ("腹痛", None, False), ("", "腹痛", False),
    ],
)
def test_same_reading(spark, evidence, utterance, found):
    texts = spark.createDataFrame([("d", 1, utterance, "clash")], "d string, t int, u string, x string")
    pieces = spark.createDataFrame([("d", 1, evidence, "kept", "clash")] * 2, "d string, t int, e string, x string, u string")
    got = same_reading(texts, pieces, ["d", "t"], "u", "e").collect()
    assert len(got) == 2 * found and all(r["x"] == "kept" for r in got)


def test_long_empty_and_null_texts(spark):
    long = "腹⼤" * 3_000_000
    df = spark.createDataFrame([(long,), ("",), (None,), ("​",)], "t string")
    got = [r["form"] for r in one_form(df, {"t": "form"}).collect()]
    assert got == [unicodedata.normalize("NFKC", long), "", None, ""]
    assert one_form(df.limit(0), {"t": "form"}).count() == 0


def test_every_form_of_several_letters_in_one_batch(spark):
    """All 1,237 and more characters whose form is several letters, in one text and one by one."""
    many = [chr(c) for c in range(0xA0, 0x30000) if not 0xD800 <= c < 0xE000 and len(shape(chr(c))) > 1]
    assert len(many) > 1200
    df = spark.createDataFrame([(n, t) for n, t in enumerate([*many, " ".join(many)])], "n int, t string").coalesce(1)
    got = {r["n"]: r["f"] for r in one_form(df, {"t": "f"}).collect()}
    assert all(got[n] == fold(t) for n, t in enumerate([*many, " ".join(many)]))
