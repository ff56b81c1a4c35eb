"""Freely typed names mapped to the entries of a reference list.

A multi-pattern automaton over canonical names and aliases finds the mentions in a name; of several the longest
counts. A name that is such a mention, or a mention and words about it, has its entry; every other name goes to
token-set similarity, and the entries that are similar enough are checked by aligning them with the name to the letter.

Defined results: a null or blank name has no entry; among equally near entries the one that the hint (a rough
canonical name) stands for counts, then the longer alias, then the smaller code; repeated rows are mapped alike;
a name of more than ``PIECE`` characters, which is a text, is compared in overlapping pieces; extra columns pass
through; an empty list maps nothing.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialoom.functions.unicode import fold, simplified
from dialoom.llm.arrow import bounded
from dialoom.session import bounded_rows, table

#: Entries (one per alias) that may be sent to every task; a longer list is worked through in blocks of this size.
BLOCK_ENTRIES = 50_000
#: Names that one block of a longer list is compared with in one task.
SHARE_NAMES = 20_000
#: Cells of the tables (pieces by aliases, pairs by characters) that are worked out at a time.
CELLS = 2_000_000
#: Least token-set similarity of a name to an entry, and most edits inside the aligned part, as a share of the alias.
SIMILARITY = 0.5
EDITS = 0.34
#: Characters of a piece in which a longer name is compared; a multiple for aliases that don't fit into half of it.
PIECE = 200
#: Cost of words before or after the aligned part, in edits.
AFFIX = 0.4

_PUNCTUATION = re.compile(r"[\W_]+")
_ASIDE = re.compile(r"[(（\[【][^)）\]】]*[)）\]】]")
_AMOUNT = re.compile(r"(?:(?:×|(?<![A-Za-z\u00c0-\u024f])[x*])\s*)?\d+(?:\.\d+)?\s*(?:毫克|微克|毫升|克|片|粒|盒|支|袋|瓶|次|mg|ug|ml|g)(?![a-z])", re.I)


def key(text: str | None, chinese: dict[int, str]) -> str:
    """The form in which names are compared: one form, lower case, no accents, simplified, letters and digits only."""
    flat = unicodedata.normalize("NFD", fold(text).lower())
    return _PUNCTUATION.sub("", "".join(c for c in flat if not unicodedata.combining(c)).translate(chinese))


def tokens(text: str) -> set[str]:
    """Characters and pairs of neighbours."""
    return set(text) | {text[i : i + 2] for i in range(len(text) - 1)}


def _codes(texts: list[str], pad: int) -> np.ndarray:
    """Code points of texts, a row each, padded."""
    out = np.full((len(texts), max(map(len, texts))), pad, dtype=np.int32)
    length = np.array([len(t) for t in texts])
    out[np.arange(out.shape[1]) < length[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.int32)
    return out


def alignments(names: list[str], aliases: list[str], most: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least edits (insertion, deletion, change, swap of neighbours) that turn a part of each name into its alias.

    Words before and after the part cost ``AFFIX`` each; if a name is not the ``first`` or ``last`` piece of a text,
    there are some in any case. Infinite beyond ``most``. All pairs go through the table of edits side by side, row
    by row, in whole numbers (tenths of an edit); an insertion is a running least along the row.
    """
    unit, affix = 10, round(AFFIX * 10)
    out = np.full(len(names), np.inf)
    alias, name = _codes(aliases, -1), _codes(names, -2)
    alias_size, size = np.array([len(a) for a in aliases]), np.array([len(n) for n in names])
    limit = np.floor(most * unit + 1e-6).astype(np.int32)
    pair = np.arange(len(names))
    column = np.arange(name.shape[1] + 1, dtype=np.int32)
    before = np.full((len(names), len(column)), affix, dtype=np.int32)
    before[first, 0] = 0
    older = before
    for i in range(1, alias.shape[1] + 1):
        now = alias[:, i - 1 : i]
        row = np.empty_like(before)
        row[:, 0] = unit * i
        np.minimum(before[:, :-1] + unit * (now != name), before[:, 1:] + unit, out=row[:, 1:])
        if i > 1:
            swap = (now == name[:, :-1]) & (alias[:, i - 2 : i - 1] == name[:, 1:])
            row[:, 2:] = np.where(swap, np.minimum(row[:, 2:], older[:, :-2] + unit), row[:, 2:])
        row = np.minimum.accumulate(row - unit * column, axis=1) + unit * column
        done = np.flatnonzero(alias_size == i)
        if len(done):
            cost = row[done] + affix * ((column < size[done, None]) | ~last[done, None])
            cost = np.where(column <= size[done, None], cost, np.iinfo(np.int32).max).min(axis=1)
            out[pair[done]] = np.where(cost <= limit[done], cost / unit, np.inf)
        going = (alias_size > i) & (np.where(column <= size[:, None], row, np.iinfo(np.int32).max).min(axis=1) <= limit)
        if not going.any():
            break
        if 4 * going.sum() < 3 * len(going):
            alias, name, alias_size, size, limit, last, pair, row, before = (x[going] for x in (alias, name, alias_size, size, limit, last, pair, row, before))
        older, before = before, row
    return out


def most_edits(alias: str) -> float:
    """Most cost at which a part of a name is aligned with ``alias``."""
    return max(1.0, EDITS * len(alias)) + 2 * AFFIX


def piece_size(alias: str) -> int:
    """Characters of the pieces in which ``alias`` is looked for; half of one holds the alias with its edits."""
    size = PIECE
    while size < 2 * (len(alias) + most_edits(alias)):
        size *= 2
    return size


class Entries:
    """The automaton and the token index of the entries of one type."""

    def __init__(self, rows: list[tuple[str, str]]) -> None:
        self.codes: dict[str, set[str]] = defaultdict(set)
        for alias, code in rows:
            if alias:
                self.codes[alias].add(code)
        self.aliases = sorted(self.codes)
        self.sizes = np.array([len(tokens(a)) for a in self.aliases], dtype=np.int64)
        self.chars = np.array([len(set(a)) for a in self.aliases], dtype=np.int64)
        self.pieces = np.array([piece_size(a) for a in self.aliases], dtype=np.int64)
        self.most = np.array([most_edits(a) for a in self.aliases])
        self.token: dict[str, int] = {}
        postings: list[list[int]] = []
        self.automaton = ahocorasick.Automaton()
        for k, alias in enumerate(self.aliases):
            self.automaton.add_word(alias, alias)
            for token in tokens(alias):
                if self.token.setdefault(token, len(postings)) == len(postings):
                    postings.append([])
                postings[self.token[token]].append(k)
        self.begin = np.cumsum([0, *map(len, postings)])
        self.postings = np.array([k for own in postings for k in own], dtype=np.int64)
        if self.aliases:
            self.automaton.make_automaton()

    def mentions(self, name: str) -> list[tuple[int, str]]:
        """The longest mentions that don't overlap, as start and alias."""
        if not self.aliases:
            return []
        found = sorted(((end - len(a) + 1, a) for end, a in self.automaton.iter(name)), key=lambda x: (-len(x[1]), x[0]))
        taken: list[tuple[int, str]] = []
        for start, alias in found:
            if all(start + len(alias) <= s or s + len(a) <= start for s, a in taken):
                taken.append((start, alias))
        return taken

    def similar(self, names: list[str]) -> list[dict[str, float]]:
        """Of each name, the entries of at least the least token-set similarity that align with it, each with its cost.

        A long name is cut into pieces that overlap by half, so that one of them holds any part that is like an alias.
        """
        out: list[dict[str, float]] = [{} for _ in names]
        parts: list[tuple[int, str, int, bool, bool]] = []
        for n, name in enumerate(names):
            for size in np.unique(self.pieces).tolist():
                starts = range(0, max(len(name) - size // 2, 1), size // 2)
                # repeated pieces of a text are alike, except for its ends
                parts += [(n, piece, size, first, last) for piece, first, last in {(name[a : a + size], a == 0, a + size >= len(name)) for a in starts} if piece]
        step = max(1, CELLS // max(len(self.aliases), 1))
        for at in range(0, len(parts), step):
            own = parts[at : at + step]
            part, alias = self._near(own)
            for a in range(0, len(part), max(1, CELLS // max(len(p[1]) for p in own))):
                b = a + max(1, CELLS // max(len(p[1]) for p in own))
                some, to = part[a:b].tolist(), alias[a:b]
                ends = np.array([own[p][3:] for p in some])
                cost = alignments([own[p][1] for p in some], [self.aliases[k] for k in to.tolist()], self.most[to], ends[:, 0], ends[:, 1])
                for n in np.flatnonzero(np.isfinite(cost)).tolist():
                    found, name = out[own[some[n]][0]], self.aliases[to[n]]
                    found[name] = min(float(cost[n]), found.get(name, np.inf))
        return out

    def _near(self, parts: list[tuple[int, str, int, bool, bool]]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a piece and an alias that share enough tokens and characters."""
        sets = [tokens(p[1]) for p in parts]
        counts = []
        for single in (True, False):
            known = [(n, self.token[t]) for n, own in enumerate(sets) for t in own if (len(t) == 1) == single and t in self.token]
            owner, token = np.array(known, dtype=np.int64).reshape(-1, 2).T
            n = self.begin[token + 1] - self.begin[token]
            spots = np.repeat(self.begin[token] - np.cumsum(n) + n, n) + np.arange(n.sum())
            key = np.repeat(owner, n) * len(self.aliases) + self.postings[spots]
            counts.append(np.bincount(key, minlength=len(parts) * len(self.aliases)).reshape(len(parts), -1))
        size = np.array([[len(s)] for s in sets])
        shared = counts[0] + counts[1]
        fits = (shared > 0) & (shared >= SIMILARITY * 0.7 * np.minimum(size, self.sizes)) & (counts[0] >= SIMILARITY * self.chars)
        fits &= np.array([[p[2]] for p in parts]) == self.pieces
        # every character that the piece lacks is an edit
        return np.nonzero(fits & (self.chars - counts[0] <= self.most))

    def rivals(self, name: str, found: dict[str, float]) -> list[tuple[str, str]]:
        """All entries, as alias and code, that the choice for ``name`` is made from; ``found``: those similar to it."""
        near = {name} & self.codes.keys() or {a for _, a in self.mentions(name)[:1]} | found.keys()
        return [(a, c) for a in near for c in self.codes[a]]

    def code(self, name: str, hinted: set[str], similar: dict[str, float]) -> tuple[str | None, str, float]:
        """Code, way (exact, mention, similar, none) and confidence of a name in comparison form.

        ``hinted``: codes of its hint; ``similar``: the entries similar to it.
        """
        if not name:
            return None, "none", 0.0

        def pick(aliases: list[str]) -> str:
            codes = set().union(*(self.codes[a] for a in aliases))
            return min(codes & hinted or codes)

        if name in self.codes:
            return pick([name]), "exact", 1.0
        nearest: list[tuple[float, str]] = [(AFFIX * ((s > 0) + (s + len(a) < len(name))), a) for s, a in self.mentions(name)[:1]]
        way = "mention" if nearest else "similar"
        found = [(cost, alias) for alias, cost in similar.items()]
        if found:
            least = min(c for c, _ in found)
            if not nearest or least < nearest[0][0] or (least <= nearest[0][0] + 1e-9 and max(len(a) for c, a in found if c <= least + 1e-9) > len(nearest[0][1])):
                way, nearest = "similar", found
            elif way == "mention":
                # what is left of the name may belong to a longer entry that is misspelt around the mention
                cost, inner = nearest[0]
                left = set(name.replace(inner, "", 1)) - set(inner)
                longer = [(c, a) for c, a in found if len(a) > len(inner) and c <= cost + 1 and left & set(a) and not self.codes[a] & self.codes[inner]]
                if longer:
                    way, nearest = "similar", longer
        if not nearest:
            return None, "none", 0.0
        least = min(c for c, _ in nearest)
        best = [a for c, a in nearest if c <= least + 1e-9]
        best = [a for a in best if self.codes[a] & hinted] or best
        longest = max(len(a) for a in best)
        return pick([a for a in best if len(a) == longest]), way, 1 / (1 + least)


def _without_extras(name: str | None) -> str | None:
    return name and (_AMOUNT.sub("", _ASIDE.sub("", name)) or name)


def _form(entries: Entries, name: str | None, chinese: dict[int, str]) -> str:
    """The comparison form of a name that counts: without its extras, unless the whole is an entry."""
    whole = key(name, chinese)
    return whole if whole in entries.codes else key(_without_extras(fold(name)), chinese)


def _chosen(entries: Entries, names: list[str | None], hinted: list[set[str]], chinese: dict[int, str]) -> list[tuple[str | None, str, float]]:
    forms = [_form(entries, name, chinese) for name in names]
    open_ = sorted({f for f in forms if f and f not in entries.codes})
    similar = dict(zip(open_, entries.similar(open_), strict=True))
    return [entries.code(form, hint, similar.get(form, {})) for form, hint in zip(forms, hinted, strict=True)]


def _hinted(entries: Entries | None, hint: str | None, chinese: dict[int, str]) -> set[str]:
    """Codes of the entries that a hint stands for."""
    return entries.codes.get(key(hint, chinese), set()) if entries else set()


def _indexed(rows: Iterable[tuple[str, str, str]], chinese: dict[int, str]) -> dict[str, Entries]:
    by_type: dict[str, list[tuple[str, str]]] = defaultdict(list)
    for kind, alias, code in rows:
        by_type[kind].append((key(alias, chinese), code))
    return {kind: Entries(own) for kind, own in by_type.items()}


_FOUND = [("code", pa.string()), ("way", pa.string()), ("confidence", pa.float64())]


def _with_codes(batch: pa.RecordBatch, found: list[tuple], kept: list[str]) -> pa.RecordBatch:
    columns = [pa.array([f[n] for f in found], kind) for n, (_, kind) in enumerate(_FOUND)]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], [*kept, *(n for n, _ in _FOUND)])


def _match(batches: Iterator[pa.RecordBatch], rows: list[tuple[str, str, str]], chinese: dict[int, str]) -> Iterator[pa.RecordBatch]:
    entries = _indexed(rows, chinese)
    for batch in bounded(batches, ["name"]):
        kinds, names, hints = (batch.column(c).to_pylist() for c in ("type", "name", "hint"))
        found: list[tuple] = [(None, "none", 0.0)] * len(names)
        for kind, own in entries.items():
            mine = [n for n, k in enumerate(kinds) if k == kind]
            for n, one in zip(mine, _chosen(own, [names[n] for n in mine], [_hinted(own, hints[n], chinese) for n in mine], chinese), strict=True):
                found[n] = one
        yield _with_codes(batch, found, batch.schema.names)


def _rivals(names: pa.Table, entries: pa.Table, kept: list[str], chinese: dict[int, str]) -> pa.Table:
    """The rivals that one block of the list has for one share of the names."""
    indexed = _indexed(zip(*(entries.column(c).to_pylist() for c in ("type", "alias", "code")), strict=True), chinese)
    kinds, texts, hints = (names.column(c).to_pylist() for c in ("type", "name", "hint"))
    out: list[list[str]] = [[] for _ in texts]
    for kind, own in indexed.items():
        mine = [n for n, k in enumerate(kinds) if k == kind]
        forms = [{key(texts[n], chinese), key(_without_extras(fold(texts[n])), chinese)} - {""} for n in mine]
        every = sorted(set().union(*forms))
        similar = dict(zip(every, own.similar(every), strict=True))
        for n, ways in zip(mine, forms, strict=True):
            # no alias is empty: the codes behind an empty one are those of the hint, which is no rival by itself
            out[n] = sorted({f"{a}\t{c}" for form in ways for a, c in own.rivals(form, similar[form])} | {f"\t{c}" for c in _hinted(own, hints[n], chinese)})
    return pa.table([*(names.column(c) for c in kept), pa.array(out, pa.list_(pa.string()))], [*kept, "rivals"])


def _decide(batches: Iterator[pa.RecordBatch], chinese: dict[int, str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, rivals = (batch.column(c).to_pylist() for c in ("name", "rivals"))
        found = []
        for name, own in zip(names, rivals, strict=True):
            pairs = [tuple(x.split("\t")) for x in own]
            found += _chosen(Entries(pairs), [name], [{c for a, c in pairs if not a}], chinese)
        yield _with_codes(batch, found, [c for c in batch.schema.names if c != "rivals"])


def map_names(names: DataFrame, entries: DataFrame, block: int = BLOCK_ENTRIES) -> DataFrame:
    """``names`` (``type, name, hint``) with ``code, way, confidence``; ``entries`` has ``type, alias, code``.

    The list is sent to the tasks if its size allows. A longer one is cut into blocks, and the names into shares of
    about ``SHARE_NAMES``; each task gives the entries of one block that come into question for the names of one
    share. The choice is then made among those of all blocks, which gives the same as the whole list would.
    """
    spark = names.sparkSession
    chinese = simplified(spark)
    entries = entries.where("type is not null and alias is not null and code is not null").select("type", "alias", "code").distinct()
    schema = T.StructType([*names.schema.fields, T.StructField("code", T.StringType()), T.StructField("way", T.StringType()), T.StructField("confidence", T.DoubleType())])
    rows = bounded_rows(entries, block)
    if rows is not None:
        sent = spark.sparkContext.broadcast(([(r["type"], r["alias"], r["code"]) for r in rows], chinese))
        return names.mapInArrow(lambda batches: _match(batches, *sent.value), schema)
    blocks, shares = -(-2 * entries.count() // block), max(1, names.count() // SHARE_NAMES)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    listed = entries.select("*", F.pmod(F.xxhash64("type", "alias", "code"), F.lit(blocks)).cast("int").alias("block"), every(shares).alias("share"))
    asked = names.select("*", every(blocks).alias("block"), F.pmod(F.xxhash64("type", "name", "hint"), F.lit(shares)).cast("int").alias("share"))
    kept = names.columns
    with_rivals = T.StructType([*names.schema.fields, T.StructField("rivals", T.ArrayType(T.StringType()))])
    met = asked.groupBy("block", "share").cogroup(listed.groupBy("block", "share")).applyInArrow(lambda own, some: _rivals(own, some, kept, chinese), with_rivals)
    out = met.groupBy(*kept).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("rivals")))).alias("rivals"))
    return out.mapInArrow(lambda batches: _decide(batches, chinese), schema)


def term_entries(terms: DataFrame) -> DataFrame:
    """``type, alias, code``: one row per alias and per preferred name of the reference list."""
    names = F.explode(F.array("preferred_name", "alias"))
    return terms.select(F.col("semantic_type").alias("type"), names.alias("alias"), "code")


TYPES = ["symptom", "disease", "medicine", "examination"]


def coded_facts(facts: DataFrame, terms: DataFrame) -> DataFrame:
    """Every uncoded entity fact once, with ``code`` (``UNMATCHED`` if the list has none), ``way`` and ``confidence``.

    Names are matched once each: the distinct names are few against the facts, and repeated rows collapse before the
    shuffle. Null-safe join back; a name that holds any share of all rows is one row on the right, split by AQE.
    """
    rows = facts.where(F.col("standard_code").isNull() & F.col("type").isin(TYPES)).select("dialogue_id", "turn_id", "fact_pos", "type", "name", F.col("normalized_name").alias("hint")).distinct()
    names = rows.select("type", "name", "hint").distinct()
    # hash-spread, as the cost lies in the matching and not in the bytes
    names = names.repartition(max(names.sparkSession.sparkContext.defaultParallelism * 2, 16), "type", "name", "hint")
    mapped = map_names(names, term_entries(terms))
    mapped = mapped.select(F.col("type").alias("t"), F.col("name").alias("n"), F.col("hint").alias("h"), F.coalesce("code", F.lit("UNMATCHED")).alias("code"), "way", "confidence")
    return rows.join(mapped, F.col("type").eqNullSafe(F.col("t")) & F.col("name").eqNullSafe(F.col("n")) & F.col("hint").eqNullSafe(F.col("h")), "left").drop("t", "n", "h")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code or UNMATCHED of every uncoded entity fact."""
    return coded_facts(table(spark, sf_dir, "facts"), table(spark, sf_dir, "terms")).select("dialogue_id", "turn_id", "fact_pos", "code").distinct()


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uncoded facts by type and by the way in which their names were mapped."""
    rows = coded_facts(table(spark, sf_dir, "facts"), table(spark, sf_dir, "terms"))
    return rows.groupBy("type", "way").agg(F.count("*").alias("facts"), F.count_distinct("name").alias("names"), F.avg("confidence").alias("confidence"))


QUERIES = {"p6_found": p6_found, "p6_report": p6_report}
ORACLE_SQL: dict[str, str] = {}
