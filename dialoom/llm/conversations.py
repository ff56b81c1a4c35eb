"""Conversations disentangled from a channel of message rows: reply links scored, the likeliest parent taken, trees formed.

In a channel several dialogues run side by side. Every message may answer one of the messages of the ``WINDOW`` turns
before it in its channel. A link's score adds the nearness in turns and in time, a change of speaker, mentions (a
quotation of the candidate, or an address that fits its speaker), the overlap of character pairs beyond chance and, if
the rows tell it, the same thread. The likeliest parents make link trees, which are the dialogues; a message whose
likeliest parent scores under ``least`` begins a tree. The defects are read off the trees.

Defined results: rows without a channel are left out; rows without a turn have no parent and are a tree with the others
of their thread, which makes their dialogue broken; rows alike in channel, thread, turn, speaker and content are one
message; several messages of one turn are each linked, and ties go to the nearest candidate; null and empty contents
have no overlap; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions.text import is_visible, strip
from dialoom.llm.arrow import bounded
from dialoom.session import cut, table

#: Turns back that a message may answer, and turns of a channel that one task links in one go.
WINDOW = 256
CHUNK = 1024
#: Candidates of a message up to which messages are scored side by side, by the distance of the candidate; a message
#: with more (a turn with a crowd), or with a quotation, is scored against all of its candidates at once.
NARROW = 2048
#: Dialogues that run side by side in one channel of :func:`dialogue_links`.
SIDE_BY_SIDE = 4
#: Seconds in which the nearness in time falls by e.
FADE = 3600.0
WEIGHTS = {"turn": 0.5, "time": 0.5, "speaker": 0.5, "mention": 1.0, "overlap": 2.0, "thread": 5.0}
#: Bits of the set of hashed character pairs of a message.
BITS = 256

# The names of the three speakers in message rows.
SPEAKERS = {
    "patient": ["user", "patient", "患者", "病人", "用户", "病患"],
    "doctor": ["assistant", "doctor", "医生", "大夫", "医师"],
    "system": ["system", "系统"],
}
#: How the speakers address each other.
ADDRESS = {"doctor": "医生|大夫|doctor", "patient": "您刚才说|您说|您提到|you said|you mentioned"}

_QUOTE = re.compile(r"[“\"「]([^”\"」]{2,})[”\"」]")
_WORDLESS = r"[^\p{L}\p{N}]+"


def speaker(role: Column) -> Column:
    """One of the three speakers that a role names, else null."""
    word = F.lower(strip(role))
    out = F.lit(None).cast("string")
    for name, words in SPEAKERS.items():
        out = F.when(word.isin(words), name).otherwise(out)
    return out


def pair_bits(texts: pa.Array) -> np.ndarray:
    """The set of hashed character pairs of each text, a row of bits in words of 64."""
    flat = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), _WORDLESS, "")
    length = pc.utf8_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.frombuffer("".join(flat.to_pylist()).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(flat)), length)
    first = np.flatnonzero(owner[:-1] == owner[1:]) if len(owner) else owner
    with np.errstate(over="ignore"):
        mixed = (points[first] * np.uint64(0x100000001B3) + points[first + 1]) * np.uint64(0x9E3779B97F4A7C15)
    bits = np.zeros((len(flat), BITS), dtype=bool)
    bits[owner[first], (mixed >> np.uint64(40)).astype(np.int64) % BITS] = True
    return np.packbits(bits, axis=1).view(np.uint64)


@dataclass
class Rows:
    """What is scored of messages, in the order of group and turn; ``turn`` is -1 where there is none."""

    group: np.ndarray
    turn: np.ndarray
    who: np.ndarray
    at: np.ndarray
    thread: np.ndarray
    bits: np.ndarray
    size: np.ndarray
    to_doctor: np.ndarray
    to_patient: np.ndarray
    text: np.ndarray
    halo: np.ndarray
    anchor: np.ndarray
    root: np.ndarray
    settled: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch, group: np.ndarray) -> Rows:
        text = pc.fill_null(batch.column("content"), "")
        flag = lambda who: pc.match_substring_regex(text, ADDRESS[who], ignore_case=True).to_numpy(zero_copy_only=False)
        turn = pc.fill_null(batch.column("turn_id"), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        thread = pc.fill_null(batch.column("thread_key"), 0).to_numpy(zero_copy_only=False)
        at = pc.cast(batch.column("received_at").cast(pa.timestamp("us"), safe=False), pa.int64())
        halo = batch.column("halo").to_numpy(zero_copy_only=False)
        bits = pair_bits(text)
        return cls(
            group, turn, np.array([{"patient": 1, "doctor": 2, "system": 3}.get(w, 0) for w in batch.column("speaker").to_pylist()], dtype=np.int8),
            pc.cast(at, pa.float64()).to_numpy(zero_copy_only=False) / 1e6, thread, bits, np.bitwise_count(bits).sum(axis=1).astype(np.float64), flag("doctor"), flag("patient"),
            np.array(text.to_pylist(), dtype=object), halo, turn, thread, ~halo,
        )

    def take(self, which: slice | np.ndarray) -> Rows:
        return Rows(*(getattr(self, f.name)[which] for f in fields(self)))

    def after(self, other: Rows) -> Rows:
        return Rows(*(np.concatenate([getattr(other, f.name), getattr(self, f.name)]) for f in fields(self)))


def link_scores(rows: Rows, i: np.ndarray, j: np.ndarray, quoted: np.ndarray | bool) -> np.ndarray:
    """How likely each message of ``i`` answers that of ``j``; ``quoted``: whether it quotes it."""
    score = WEIGHTS["turn"] / (rows.turn[i] - rows.turn[j])
    score = score + WEIGHTS["time"] * np.nan_to_num(np.exp(-np.abs(rows.at[i] - rows.at[j]) / FADE))
    score += WEIGHTS["speaker"] * (rows.who[i] != rows.who[j])
    addressed = (rows.to_doctor[i] & (rows.who[j] == 2)) | (rows.to_patient[i] & (rows.who[j] == 1))
    score += WEIGHTS["mention"] * np.where(quoted, 1.0, addressed / 4)
    # pairs in common, less those that sets of such sizes share by chance
    a, b = rows.size[i], rows.size[j]
    chance, least = a * b / BITS, np.minimum(a, b)
    shared = np.bitwise_count(rows.bits[i] & rows.bits[j]).sum(axis=-1)
    score += WEIGHTS["overlap"] * np.maximum(shared - chance, 0) / np.maximum(least - chance, 1e-9) * (least > 0)
    score += WEIGHTS["thread"] * ((rows.thread[i] == rows.thread[j]) & (rows.thread[i] != 0))
    return np.round(score, 9)


def likeliest_parents(rows: Rows, new: int, least: float | None, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Parent (-1: none) and score of every message; those before ``new`` and halos are candidates alone."""
    n = len(rows.turn)
    at = np.arange(n)
    begins = np.r_[True, rows.group[1:] != rows.group[:-1]]
    begin = np.maximum.accumulate(np.where(begins, at, 0))
    hi = np.maximum.accumulate(np.where(begins | np.r_[True, rows.turn[1:] != rows.turn[:-1]], at, 0))
    place = (np.cumsum(begins) << 34) + rows.turn
    lo = np.maximum(begin, np.searchsorted(place, place - window))
    open_ = (at >= new) & ~rows.halo & (rows.turn >= 0) & (hi > lo)
    parent, best = np.full(n, -1), np.full(n, -np.inf)
    quotes = {int(i): found for i in np.flatnonzero(open_) if (found := _QUOTE.findall(rows.text[i]))}
    narrow = open_ & (hi - lo <= NARROW)
    narrow[list(quotes)] = False
    side = np.flatnonzero(narrow)
    side = side[np.argsort(lo[side] - hi[side], kind="stable")]  # the most candidates first
    width = (hi - lo)[side]
    for d in range(1, int(width.max(initial=0)) + 1):
        i = side[: np.searchsorted(-width, -d, "right")]
        score = link_scores(rows, i, hi[i] - d, False)
        better = score > best[i]
        parent[i[better]], best[i[better]] = (hi[i] - d)[better], score[better]
    for i in np.flatnonzero(open_ & ~narrow).tolist():
        j = np.arange(hi[i] - 1, lo[i] - 1, -1)
        quoted = np.array([any(q in t for q in quotes[i]) for t in rows.text[j]]) if i in quotes else False
        score = link_scores(rows, np.full(len(j), i), j, quoted)
        k = int(score.argmax())
        parent[i], best[i] = j[k], score[k]
    if least is not None:
        parent[best < least] = -1
    return parent, np.where(parent < 0, np.nan, best)


_LINK_FIELDS = [("parent", pa.int32()), ("score", pa.float64()), ("anchor", pa.int32()), ("root", pa.int64()), ("settled", pa.bool_()), ("again", pa.bool_())]
_LINK_DDL = "parent int, score double, anchor int, root long, settled boolean, again boolean"


def _link(batches: Iterator[pa.RecordBatch], kept: list[str], least: float | None, window: int = WINDOW) -> Iterator[pa.RecordBatch]:
    """Rows in the order of channel, chunk, turn and thread; a window of turns is all that is kept between batches."""
    before, last, number = None, None, 0
    for batch in bounded(batches, ["content"]):
        keys = [batch.column(c).to_pylist() for c in ("channel", "chunk")]
        changes = np.fromiter((a != b for a, b in zip(zip(*keys), [last, *zip(*keys)])), bool, batch.num_rows)
        group = np.cumsum(changes) + number
        last, number = (keys[0][-1], keys[1][-1]), int(group[-1])
        rows = Rows.of(batch, group)
        new = 0
        if before is not None and before.group[0] == group[0]:
            new = len(before.turn)
            rows = rows.after(before)
        parent, score = likeliest_parents(rows, new, least, window)
        # roots by doubling: a parent lies before its child, and what was there before has its root already
        up = np.where(parent >= 0, parent, np.arange(len(parent)))
        while (more := up[up] != up).any():
            up[more] = up[up[more]]
        rows.anchor, rows.root, rows.settled = rows.anchor[up], rows.root[up], rows.settled[up]
        again = np.r_[False, (rows.group[1:] == rows.group[:-1]) & (rows.turn[1:] == rows.turn[:-1]) & (rows.thread[1:] == rows.thread[:-1]) & (rows.turn[1:] >= 0)]
        own = slice(new, None)
        placed = rows.turn[own] >= 0
        found = [
            pa.array(rows.turn[parent[own]], pa.int32(), mask=parent[own] < 0), pa.array(score[own], mask=parent[own] < 0), pa.array(rows.anchor[own], pa.int32(), mask=~placed),
            pa.array(rows.root[own]), pa.array(rows.settled[own]), pa.array(again[own]),
        ]
        out = pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *found], [*kept, *(n for n, _ in _LINK_FIELDS)])
        yield out.filter(pa.array(~rows.halo[own]))
        tail = (rows.group == number) & (rows.turn >= rows.turn[-1] - window)
        before = rows.take(tail)


def _roots(batches: Iterator[pa.RecordBatch], reach: int) -> Iterator[pa.RecordBatch]:
    """Roots of the last turns of the chunks, chunk by chunk; rows in the order of channel and turn.

    What is known of turns that no message can answer any more is given up, whenever it has doubled.
    """
    now, known, most = None, {}, 1000
    for batch in batches:
        out = []
        columns = ("channel", "turn_id", "thread_key", "anchor", "root", "settled")
        for channel, turn, thread, anchor, root, settled in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
            if channel != now:
                now, known = channel, {}
            top = (anchor, root) if settled else known.get((anchor, root), (anchor, root))
            known[turn, thread] = top
            if len(known) > most:
                known = {k: v for k, v in known.items() if k[0] >= turn - reach}
                most = 2 * len(known) + 1000
            out.append(top)
        tops = [pa.array([t[k] for t in out], kind) for k, kind in enumerate((pa.int32(), pa.int64()))]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns[:3]), *tops], [*columns[:3], "top", "top_root"])


def reply_links(messages: DataFrame, channel: str | Column, thread: str | None = None, keep_content: bool = True, least: float | None = None) -> DataFrame:
    """``channel, [thread,] turn_id, speaker, visible, [content,] parent, score, again, tree, root`` of every distinct message.

    ``messages``: channel, ``turn_id, role, content, received_at`` and, if known, the ``thread`` that a message names.
    ``parent`` and ``tree`` are the turns of the parent and of the root, ``root`` is a number of the root's thread;
    ``again`` tells that another message of the same turn and thread came before. A message whose likeliest parent
    scores under ``least`` begins a tree; with None every message that has a candidate is a reply, as is right where
    the channel is known to be one conversation.

    Copies collapse before the first shuffle. A channel with any share of all rows is cut into chunks of turns, each
    with the turns before it as candidates, and rows without a turn are spread; the trees of several chunks are joined
    over the few turns at the chunks' ends that they hang on.
    """
    turn = F.col("turn_id").cast("int").alias("turn_id")
    own = F.col(channel) if isinstance(channel, str) else channel
    named = F.col(thread).cast("string") if thread else F.lit(None).cast("string")
    rows = messages.where(own.isNotNull()).select(own.cast("string").alias("channel"), named.alias("thread"), turn, speaker(F.col("role")).alias("speaker"), "content", "received_at")
    rows = rows.groupBy("channel", "thread", "turn_id", "speaker", "content").agg(F.min("received_at").alias("received_at"))
    key = F.when(F.col("thread").isNotNull(), F.xxhash64("thread")).otherwise(F.lit(0)).alias("thread_key")
    home = F.coalesce(F.floor(F.col("turn_id") / CHUNK), -1 - F.pmod(F.xxhash64("content"), F.lit(CHUNK))).cast("int")
    here, next_ = F.struct(home.alias("chunk"), F.lit(False).alias("halo")), F.struct((home + 1).alias("chunk"), F.lit(True).alias("halo"))
    at_end = F.pmod("turn_id", F.lit(CHUNK)) >= CHUNK - WINDOW
    rows = rows.select("*", key, is_visible(F.col("content")).alias("visible"), F.inline(F.when(at_end, F.array(here, next_)).otherwise(F.array(here))))
    rows = rows.repartition("channel", "chunk").sortWithinPartitions("channel", "chunk", "turn_id", "thread_key", "speaker", "content")
    kept = ["channel", "thread", "turn_id", "thread_key", "speaker", "visible", *(["content"] if keep_content else [])]
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in kept)
    kept = [f.name for f in rows.schema if f.name in kept]
    window, reach = WINDOW, CHUNK + WINDOW
    links = cut(rows.mapInArrow(lambda batches: _link(batches, kept, least, window), f"{ddl}, {_LINK_DDL}"))
    name = channel if isinstance(channel, str) else "channel"
    names = ["channel", *(["thread"] if thread else []), "turn_id", "speaker", "visible", *(["content"] if keep_content else []), "parent", "score", "again"]
    done = links.where("settled").select(*names, F.col("anchor").alias("tree"), "root")
    # of the turns at the chunks' ends, only those that a tree of the next chunk hangs on: mostly one a chunk
    hung = links.where("not settled").select("channel", F.col("anchor").alias("turn_id"), F.col("root").alias("thread_key")).distinct()
    ends = links.where(F.pmod("turn_id", F.lit(CHUNK)) >= CHUNK - WINDOW).select("channel", "turn_id", "thread_key", "anchor", "root", "settled").join(hung, ["channel", "turn_id", "thread_key"], "left_semi")
    tops = ends.repartition("channel").sortWithinPartitions("channel", "turn_id").mapInArrow(lambda batches: _roots(batches, reach), "channel string, turn_id int, thread_key long, top int, top_root long")
    tops = tops.groupBy("channel", F.col("turn_id").alias("anchor"), F.col("thread_key").alias("root")).agg(F.min_by(F.struct("top", "top_root"), F.struct("top", "top_root")).alias("top"))
    late = links.where("not settled").join(tops, ["channel", "anchor", "root"], "left")
    late = late.select(*names, F.coalesce("top.top", "anchor").alias("tree"), F.coalesce("top.top_root", "root").alias("root"))
    return done.unionByName(late).withColumnsRenamed({"channel": name} | ({"thread": thread} if thread else {}))


def dialogue_links(messages: DataFrame, keep_content: bool = True) -> DataFrame:
    """:func:`reply_links` of dialogues that run side by side, of which every message names its own.

    No column tells the channel. Taken as channels are shares of the dialogues, of about ``SIDE_BY_SIDE`` each, and a
    tree goes on only inside the dialogue that its messages name.
    """
    dialogues = messages.select(F.approx_count_distinct("dialogue_id")).first()[0]
    share = F.pmod(F.xxhash64("dialogue_id"), F.lit(max(1, dialogues // SIDE_BY_SIDE)))
    links = reply_links(messages.where("dialogue_id is not null"), share, "dialogue_id", keep_content, least=WEIGHTS["thread"])
    return links


def dialogue_defects(links: DataFrame) -> DataFrame:
    """``dialogue_id, messages, trees, defect`` of every dialogue of :func:`dialogue_links`; defect is null for a sound one.

    A sound dialogue is one tree. A patient's message is answered if a visible message of the doctor follows it in its
    own tree. All is aggregated with map-side combination, tree by tree and then dialogue by dialogue.
    """

    def turn_if(condition: Column) -> Column:
        return F.max(F.when(condition, F.col("turn_id")))

    seen = F.col("visible")
    trees = links.groupBy("channel", "tree", "root").agg(
        F.min("dialogue_id").alias("dialogue_id"), F.count("*").alias("n"), F.count("turn_id").alias("placed"), F.count_if("again").alias("again"), F.min("turn_id").alias("first"), F.max("turn_id").alias("last"),
        F.count("speaker").alias("named"), F.count_if(seen & F.col("speaker").isin("patient", "doctor")).alias("said"), F.count_if(~seen & (F.col("speaker") == "doctor")).alias("blank"),
        turn_if(seen & (F.col("speaker") == "patient")).alias("asked"), turn_if(seen & (F.col("speaker") == "doctor")).alias("replied"),
    )
    sums = [F.sum(c).alias(c) for c in ("n", "placed", "again", "named", "said", "blank")]
    answered = F.col("asked").isNull() | F.coalesce(F.col("replied") > F.col("asked"), F.lit(False))
    whole = trees.groupBy("dialogue_id").agg(*sums, F.min("first").alias("first"), F.max("last").alias("last"), F.count("tree").alias("trees"), F.max_by(answered, F.col("asked")).alias("answered"))
    broken = (F.col("trees") != 1) | (F.col("placed") < F.col("n")) | (F.col("again") > 0) | (F.col("first") != 0) | (F.col("last") != F.col("n") - 1) | (F.col("named") < F.col("n"))
    defect = F.when(broken, "broken").when(F.col("said") == 0, "empty").when((F.col("blank") > 0) | ~F.coalesce("answered", F.lit(True)), "missing_reply")
    return whole.select("dialogue_id", F.col("n").alias("messages"), "trees", defect.alias("defect"))


def conversations(links: DataFrame, part: int = 4096) -> DataFrame:
    """``dialogue_id, part, messages`` of every sound dialogue: its tree's messages in order, with speaker, content and parent.

    Longer dialogues come in parts of ``part`` turns, so that no row grows with a dialogue. The list of defective
    dialogues is joined by the dialogue; one with most rows is split by AQE.
    """
    sound = dialogue_defects(links).where("defect is null").select("dialogue_id")
    rows = links.join(sound, "dialogue_id", "left_semi")
    message = F.struct("turn_id", "speaker", "content", "parent")
    trees = rows.groupBy("channel", "tree", "root", F.floor(F.col("turn_id") / part).cast("int").alias("part")).agg(F.min("dialogue_id").alias("dialogue_id"), F.array_sort(F.collect_list(message)).alias("messages"))
    return trees.select("dialogue_id", "part", "messages")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defective dialogues with their first defect."""
    links = dialogue_links(table(spark, sf_dir, "messages"), keep_content=False)
    return dialogue_defects(links).where("defect is not null").select("dialogue_id", "defect")


def p1_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sound dialogues, the messages in order as lines of speaker and content."""
    lines = F.transform("messages", lambda m: F.concat(m["turn_id"].cast("string"), F.lit(" "), m["speaker"], F.lit(": "), F.coalesce(m["content"], F.lit(""))))
    rows = conversations(dialogue_links(table(spark, sf_dir, "messages")))
    return rows.select("dialogue_id", "part", F.size("messages").alias("messages"), F.array_join(lines, "\n").alias("transcript"))


def p1_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message with the one that it most likely answers."""
    links = dialogue_links(table(spark, sf_dir, "messages"), keep_content=False)
    return links.select("dialogue_id", "turn_id", "speaker", "visible", "parent", F.round("score", 6).alias("score"), "tree")


_BLANK = "[\\s\\p{Z}\\p{C}\\x{034F}\\x{115F}\\x{1160}\\x{3164}\\x{FE00}-\\x{FE0F}\\x{FFA0}]"


def _names(who: str) -> str:
    return ", ".join(f"'{w}'" for w in SPEAKERS[who])


_JUDGED_SQL = f"""
WITH named AS (
  SELECT DISTINCT dialogue_id, turn_id, content,
    CASE WHEN r IN ({_names("patient")}) THEN 'patient' WHEN r IN ({_names("doctor")}) THEN 'doctor' WHEN r IN ({_names("system")}) THEN 'system' END AS speaker
  FROM (SELECT *, lower(trim(role)) AS r FROM messages) WHERE dialogue_id IS NOT NULL
), seen AS (
  SELECT *, content IS NOT NULL AND length(regexp_replace(content, '{_BLANK}', '', 'g')) > 0 AS visible FROM named
), dialogues AS (
  SELECT dialogue_id, count(*) AS n, count(turn_id) AS placed, count(DISTINCT turn_id) AS places, min(turn_id) AS first, max(turn_id) AS last, count(speaker) AS named,
    count(*) FILTER (visible AND speaker IN ('patient', 'doctor')) AS said, count(*) FILTER (NOT visible AND speaker = 'doctor') AS blank,
    max(turn_id) FILTER (visible AND speaker = 'patient') AS asked, max(turn_id) FILTER (visible AND speaker = 'doctor') AS replied
  FROM seen GROUP BY dialogue_id
), judged AS (
  SELECT dialogue_id, CASE WHEN placed < n OR places < n OR first <> 0 OR last <> n - 1 OR named < n THEN 'broken'
    WHEN said = 0 THEN 'empty' WHEN blank > 0 OR (asked IS NOT NULL AND coalesce(replied <= asked, TRUE)) THEN 'missing_reply' END AS defect FROM dialogues
)
"""

QUERIES = {"p1_found": p1_found, "p1_conversations": p1_conversations, "p1_links": p1_links}
ORACLE_SQL = {
    "p1_found": _JUDGED_SQL + "SELECT dialogue_id, defect FROM judged WHERE defect IS NOT NULL",
    "p1_conversations": _JUDGED_SQL
    + """SELECT dialogue_id, CAST(turn_id // 4096 AS INTEGER) AS part, CAST(count(*) AS INTEGER) AS messages,
  string_agg(turn_id || ' ' || speaker || ': ' || coalesce(content, ''), chr(10) ORDER BY turn_id) AS transcript
FROM seen WHERE dialogue_id IN (SELECT dialogue_id FROM judged WHERE defect IS NULL) GROUP BY ALL""",
}
