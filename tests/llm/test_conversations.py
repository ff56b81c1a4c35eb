import math
import random
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest

from dialoom.llm import conversations as C

DDL = "dialogue_id string, turn_id int, role string, content string, received_at timestamp, channel string, tree int, chunk int"
T = datetime(2024, 1, 1)


def rows(*messages, dialogue="d"):
    return [(dialogue, t, role, text, T + timedelta(minutes=n), "clash", 1, 2) for n, (t, role, text) in enumerate(messages)]


def defect(spark, *messages):
    links = C.dialogue_links(spark.createDataFrame(rows(*messages), DDL), keep_content=False)
    found = C.dialogue_defects(links).collect()
    return found[0]["defect"] if found else "no dialogue"


@pytest.mark.parametrize(
    ("messages", "want"),
    [
        ([(0, "user", "腹痛"), (1, "assistant", "多久")], None),
        ([(0, "病人", "腹痛"), (1, " Doctor", "多久"), (0, "USER", "腹痛")], None),
        ([(0, "user", "腹痛"), (2, "assistant", "多久")], "broken"),
        ([(1, "user", "腹痛"), (2, "assistant", "多久")], "broken"),
        ([(0, "user", "腹痛"), (None, "assistant", "多久")], "broken"),
        ([(0, "user", "腹痛"), (1, "assistant", "多久"), (1, "assistant", "几次")], "broken"),
        ([(0, "user", "腹痛"), (1, "nurse", "多久")], "broken"),
        ([(0, "user", "腹痛"), (1, None, "多久")], "broken"),
        ([(0, "user", "​"), (1, "assistant", None)], "empty"),
        ([(0, "system", "欢迎")], "empty"),
        ([(0, "user", "腹痛"), (1, "assistant", "　"), (2, "assistant", "多久")], "missing_reply"),
        ([(0, "user", "腹痛"), (1, "assistant", "多久"), (2, "user", "三天")], "missing_reply"),
        ([(0, "user", "腹痛"), (1, "assistant", "多久"), (2, "user", "\n")], None),
        ([(0, "assistant", "您好")], None),
        ([(0, "user", "腹痛"), (900, "assistant", "多久")], "broken"),
        ([(-1, "user", "腹痛"), (0, "assistant", "多久")], "broken"),
        ([], "no dialogue"),
    ],
)
def test_defects(spark, messages, want):
    assert defect(spark, *messages) == want


def test_messages_come_in_order_with_their_speakers(spark):
    df = spark.createDataFrame(rows((2, "patient", "三天"), (0, "user", "腹痛"), (1, "doctor", "多久"), (3, "医生", "好"), (1, "doctor", "多久")) + rows((0, "user", "x"), dialogue="lost") + rows((0, "user", "x"), dialogue=None), DDL)
    got = C.conversations(C.dialogue_links(df)).collect()
    assert [(r["dialogue_id"], r["part"]) for r in got] == [("d", 0)]
    assert [tuple(m) for m in got[0]["messages"]] == [(0, "patient", "腹痛", None), (1, "doctor", "多久", 0), (2, "patient", "三天", 1), (3, "doctor", "好", 2)]
    assert len(C.conversations(C.dialogue_links(df), part=2).collect()) == 2


def test_links_follow_quotations_and_words(spark):
    df = spark.createDataFrame(rows((0, "user", "右下腹刺痛三天"), (1, "user", "还有失眠"), (2, "assistant", "您刚才说“右下腹刺痛”，右下腹刺痛程度如何"), (3, "assistant", "失眠多久了")), DDL)
    parents = {r["turn_id"]: r["parent"] for r in C.reply_links(df, "dialogue_id").collect()}
    assert parents == {0: None, 1: 0, 2: 0, 3: 1}


def test_links_reach_far_back(spark):
    talk = [(n, "user" if n % 2 else "assistant", f"第{n}句别的话") for n in range(1, 200)]
    df = spark.createDataFrame(rows((0, "user", "右下腹刺痛三天"), *talk, (200, "assistant", "您刚才说“右下腹刺痛三天”，右下腹刺痛三天了吗")), DDL)
    assert {r["turn_id"]: r["parent"] for r in C.reply_links(df, "dialogue_id").collect()}[200] == 0


def test_trees_part_below_a_least_score(spark):
    df = spark.createDataFrame([("d", n, "user", text, T + timedelta(days=9 * n), "", 0, 0) for n, text in enumerate(["一二三四", "甲乙丙丁", "一二三四五", "甲乙丙丁戊"])], DDL)
    trees = {r["turn_id"]: r["tree"] for r in C.reply_links(df, "dialogue_id", least=1.5).collect()}
    assert trees == {0: 0, 1: 1, 2: 0, 3: 1}


@pytest.mark.parametrize(("least", "thread"), [(None, None), (2.0, None), (5.0, "dialogue_id")])
def test_chunks_change_nothing(spark, monkeypatch, least, thread):
    rng = random.Random(2)
    monkeypatch.setattr(C, "WINDOW", 8)
    turns = [(d, t) for d in "de" for t in range(150) if rng.random() < 0.9]
    df = spark.createDataFrame([(d, t, rng.choice(["user", "doctor"]), "".join(rng.choice("腹痛胀头晕多久了吗") for _ in range(6)), T + timedelta(minutes=t * 20), "all", 0, 0) for d, t in turns], DDL)
    found = lambda: sorted(map(tuple, C.reply_links(df, "channel", thread, least=least).collect()), key=repr)
    whole = found()
    monkeypatch.setattr(C, "CHUNK", 16)
    assert whole == found() and len(whole) == len(turns)
    assert {r["defect"] for r in C.dialogue_defects(C.dialogue_links(df)).collect()} == {"broken"}


def scalar_score(a, b, quoted):
    """The score written out for one pair of (turn, speaker, text, at, thread)."""
    pairs = lambda t: {t[i : i + 2] for i in range(len(t) - 1)}
    score = 0.5 / (a[0] - b[0]) + 0.5 * math.exp(-abs((a[3] - b[3]).total_seconds()) / C.FADE) + 0.5 * (a[1] != b[1]) + 1.0 * quoted
    x, y = pairs(a[2]), pairs(b[2])
    if x and y:
        chance = len(x) * len(y) / C.BITS
        score += 2.0 * max(len(x & y) - chance, 0) / (min(len(x), len(y)) - chance)
    return score + 5.0 * (a[4] == b[4])


def arrow(messages):
    cols = list(zip(*messages, strict=True))
    n = len(messages)
    return pa.RecordBatch.from_arrays(
        [pa.array(["c"] * n), pa.array([0] * n), pa.array(cols[0], pa.int32()), pa.array(cols[1]), pa.array(cols[2]), pa.array(cols[3], pa.timestamp("us")), pa.array([False] * n), pa.array(cols[4], pa.int64())],
        ["channel", "chunk", "turn_id", "speaker", "content", "received_at", "halo", "thread_key"],
    )


def test_scores_equal_the_formula():
    rng = random.Random(3)
    messages = [(n, rng.choice(["patient", "doctor", "system"]), "".join(rng.choice("腹痛胀头晕") for _ in range(rng.randrange(5))), T + timedelta(seconds=rng.randrange(9000)), rng.choice([1, 2])) for n in range(40)]
    scored = C.Rows.of(arrow(messages), np.zeros(40, dtype=np.int64))
    for i in range(1, 40):
        j = np.arange(i)
        assert np.allclose(C.link_scores(scored, np.full(i, i), j, False), [scalar_score(messages[i], messages[k], False) for k in j], atol=1e-8)


@pytest.mark.parametrize("least", [None, 1.4])
def test_crowded_turns_give_the_same_links(monkeypatch, least):
    rng = random.Random(5)
    found = []
    for turn, n in enumerate([1, 60, 3, 90, 40, 1, 1, 70, 2, 30, 1, 50]):
        for _ in range(n):
            text = "".join(rng.choice("腹痛胀头晕多久Aa ") for _ in range(rng.randrange(8))) + rng.choice(["", "", "医生", "您说", f"“{rng.choice('腹痛胀')}{rng.choice('头晕多')}”"])
            found.append((turn, rng.choice(["doctor", "patient", "system", None]), text or None, rng.choice([None, T, T + timedelta(seconds=rng.randrange(9_000)), T + timedelta(days=40)]), 0))
    batch = arrow(found)
    links = []
    for narrow in (10_000, 32, 0):
        monkeypatch.setattr(C, "NARROW", narrow)
        links.append([r for b in C._link(iter([batch.slice(0, 77), batch.slice(77)]), ["turn_id"], least) for r in b.to_pylist()])
    assert links[0] == links[1] == links[2] and len(links[0]) == len(found)


def planted(dialogues=40, side_by_side=4, seed=1):
    """Dialogues of a theme each, several of which run side by side in a channel: rows of channel, place, message and dialogue."""
    rng = random.Random(seed)
    every = []
    for d in range(dialogues):
        word = lambda: "".join(chr(0x4E00 + rng.randrange(8000)) for _ in range(4))
        at, said, words = T + timedelta(minutes=rng.randrange(40)), None, [word(), word(), word()]
        for n in range(rng.randrange(4, 16)):
            words = [*words[1:], word()]
            text = "".join(words)  # takes up words of the message before
            if n % 2 and rng.random() < 0.5:
                text = f"您说“{said}”，{text}"
            every.append((d // side_by_side, at, "doctor" if n % 2 else "patient", text, d))
            said, at = text, at + timedelta(seconds=rng.randrange(20, 200))
    every.sort(key=lambda r: (r[0], r[1]))
    return every


def recalls(every, least):
    links = trees = total = 0
    for channel in {r[0] for r in every}:
        own = [r for r in every if r[0] == channel]
        batch = arrow([(n, who, text, at, 0) for n, (_, at, who, text, _) in enumerate(own)])
        got = [r for b in C._link(iter([batch]), ["turn_id"], least) for r in b.to_pylist()]
        first = {}
        for place, (r, m) in enumerate(zip(got, own, strict=True)):
            begins = first.setdefault(m[4], place) == place
            links += r["parent"] is None if begins else r["parent"] is not None and own[r["parent"]][4] == m[4]
            trees += r["anchor"] == first[m[4]]
            total += 1
    return links / total, trees / total


def test_interleaved_dialogues_are_told_apart(monkeypatch):
    every = planted()
    link, tree = recalls(every, 1.8)
    assert link >= 0.9 and tree >= 0.9
    monkeypatch.setattr(C, "link_scores", lambda rows, i, j, quoted: np.full(len(i), 2.0))
    constant, _ = recalls(every, 1.8)
    assert constant < 0.7


def test_threads_part_what_scores_mix(monkeypatch):
    """The dialogues of a channel are its trees: with other scores than those of the links they are others."""
    messages = [(n // 2, "patient" if n % 4 < 2 else "doctor", "腹痛", T, 1 + n % 2) for n in range(20)]
    roots = lambda: [r["root"] for b in C._link(iter([arrow(messages)]), ["turn_id"], C.WEIGHTS["thread"]) for r in b.to_pylist()]
    assert roots() == [m[4] for m in messages]
    monkeypatch.setattr(C, "link_scores", lambda rows, i, j, quoted: np.full(len(i), 9.0))
    assert roots() != [m[4] for m in messages]


def test_empty_table(spark):
    links = C.dialogue_links(spark.createDataFrame([], DDL))
    assert links.count() == C.dialogue_defects(links).count() == C.conversations(links).count() == 0
