import numpy as np
import pytest
from pyspark.sql import functions as F

from dialoom.llm import language as L
from dialoom.session import table


@pytest.fixture(scope="module")
def documents(spark):
    from pathlib import Path

    path = "/root/testdata/sf0.01"
    if not Path(path).exists():
        pytest.skip("no test tables")
    return table(spark, path, "documents")


@pytest.fixture(scope="module")
def model(documents):
    return L.fit(documents)


HELD_OUT = {
    "zh": "昨天晚上肚子不舒服，没有睡好。", "en": "I could not sleep because of the pain last night.", "ja": "昨夜は痛みで眠れませんでした。", "ko": "어젯밤에 배가 아파서 잠을 못 잤어요.", "es": "No pude dormir anoche por la molestia.",
    "pt": "Não consegui dormir ontem por causa do desconforto.", "fr": "Je n'ai pas pu dormir hier à cause de la gêne.", "de": "Ich konnte gestern nicht schlafen, weil die Beschwerden stark waren.", "ru": "Вчера я не могла уснуть из-за боли.", "vi": "Đêm qua tôi không ngủ được vì khó chịu.",
}


def test_held_out_sentences(spark, model):
    df = spark.createDataFrame([(n, None, text, 1) for n, text in enumerate(HELD_OUT.values())], "doc_id int, lang string, text string, label int")
    got = {r["doc_id"]: r["lang"] for r in L.line_languages(df, model).collect()}
    assert [got[n] for n in range(len(got))] == list(HELD_OUT)


def test_clear_labels_are_found_again(documents, model):
    """Lines of documents whose script alone shows the language."""
    rows = L.line_languages(documents, model).join(documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "line")).where("line rlike '[가-힣]{3}' or line rlike '[а-я]{4}' or line rlike '[ぁ-ん]{3}'"), "doc_id")
    lines = documents.where("text is not null").select("text").limit(400).collect()
    texts = [x for r in lines for x in L.visible_lines(r["text"])]
    scores, _ = model.line_scores(texts)
    best = [L.LANGUAGES[k] for k in scores.argmax(axis=1)]
    for text, lang in zip(texts, best, strict=True):
        if sum("가" <= c <= "힣" for c in text) > len(text) / 3:
            assert lang == "ko"
        if sum("а" <= c <= "я" for c in text) > len(text) * 2 / 3:
            assert lang == "ru"
    assert rows.count() > 0


def test_lines_are_numbered_and_noise_does_not_count(spark, model):
    text = f"\n{HELD_OUT['zh']}\r\n ​\n{HELD_OUT['fr']}\n12/34\n"
    df = spark.createDataFrame([(1, "zh-CN", text), (1, "zh-CN", text), (2, "zh", None), (3, "", " \n"), (4, "Chinese", HELD_OUT["zh"]), (5, "chi", "\n".join([HELD_OUT["zh"]] * 3) + "\n12")], "doc_id long, lang string, text string")
    got = [tuple(r) for r in L.mislabelled_lines(df, model).select("doc_id", "seg", "lang").distinct().collect()]
    assert sorted(r[:2] for r in got) == [(1, 0), (1, 1), (1, 2)]
    assert dict((r[1], r[2]) for r in got if r[1] < 2) == {0: "zh", 1: "fr"}


@pytest.mark.parametrize(("label", "lang"), [("zh-TW", "zh"), ("EN", "en"), ("en_GB", "en"), ("日本語", "ja"), ("español", "es"), ("pt-BR", "pt"), ("ger", "de"), ("und", None), ("N/A", None), ("-", None), (" ", None), (None, None), ("auto", None), ("中文", "zh"), ("Vietnamese", "vi"), ("tiếng Việt", "vi")])
def test_labels(spark, label, lang):
    assert spark.createDataFrame([(label,)], "l string").select(L.label_language(F.col("l"))).first()[0] == lang


def test_parts_and_long_and_empty_texts(spark, model):
    lines = list(HELD_OUT.values()) * 20
    assert np.allclose(model.line_scores(lines)[0], model.line_scores(lines, 50)[0])
    df = spark.createDataFrame([(1, "en", HELD_OUT["zh"] * 100_000)], "doc_id long, lang string, text string")
    assert [r["lang"] for r in L.line_languages(df, model).collect()] == ["zh"]
    assert L.mislabelled_lines(df.limit(0), model).count() == 0
    assert L.mislabelled_lines(df.limit(0), L.fit(df.limit(0))).count() == 0


def test_documents(spark, model):
    df = spark.createDataFrame([(1, "en", "\n".join([HELD_OUT["zh"], HELD_OUT["zh"], HELD_OUT["en"]]))], "doc_id long, lang string, text string")
    (row,) = L.document_languages(L.line_languages(df, model)).collect()
    assert (row["label"], row["lang"], row["languages"]) == ("en", "zh", 2) and row["confidence"] > 0.9
