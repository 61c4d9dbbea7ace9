"""Evaluation texts that leak into training texts.

The items are a BM25 inverted index; every passage of every training text that can hold a case is a query, answered by
block-max WAND. Each item's weights are divided by its own threshold, its least score over any ``run`` consecutive
units, so that one bound of 1 serves all items and loses nothing: a text that holds ``run`` consecutive units of an
item holds all their terms in one passage. The terms are pairs of neighbouring units, and all pairs of a case are in
the index, so only stretches of the text whose pairs are all known are cut into passages. What is retrieved is verified
unit by unit.

Units are words for English items, and single letters, digits and ideographs for Chinese ones. Letter case, width,
punctuation, spacing, markup and invisible characters are removed from both sides first.

Defined cases: null and empty texts hold nothing; an item shorter than ``run`` units can't leak; two items that share
such a run both leak with it; very long texts are read whole, passage by passage; repeated rows give repeated ids
once each (the result is distinct).
"""

from __future__ import annotations

import functools
import html
import math
import operator
import re
import unicodedata
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Consecutive units that make a case.
WORDS, CHARS = 10, 16
#: Units of a passage; passages overlap by a case less one, so that every case lies within one.
PASSAGE = {"en": 24, "zh": 48}
K1, B = 1.2, 0.75
BLOCK = 16
#: Items in one index, and characters of their texts; more are searched for in several passes, so the broadcast is bounded.
ITEMS_AT_ONCE, CHARS_AT_ONCE = 20_000, 10_000_000

#: Tags that stand inside words; every other tag parts words.
INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup tt u var wbr".split())

#: Format characters, marks and control characters, but for those of ASCII.
INVISIBLE = r"(?V1)[[\p{Cf}\p{Mn}\p{Me}\p{Cc}]--[\x00-\x7f]]+"

IDEOGRAPHS = "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"


def without_markup(text: str) -> str:
    """The text without comments and tags of any length; a tag that stands inside words leaves nothing, any other a blank.

    A quoted attribute may hold any sign. What is opened and never closed is text. Every place of the text is looked at
    a bounded number of times: places from which no tag ends are remembered.
    """
    name, plain_ = re.compile(r"</?([a-zA-Z][^\s<>/\"']*)"), re.compile(r"[^<>\"']*")
    never: set[int] = set()
    unclosed: set[str] = set()

    def end(at: int) -> int:
        """The place after the tag whose name ends at ``at``; -1 if it is no tag."""
        seen = []
        while at not in never:
            seen.append(at)
            at = plain_.match(text, at).end()
            sign = text[at : at + 1]
            if sign == ">":
                return at + 1
            if sign not in ('"', "'"):
                break
            close = -1 if sign in unclosed else text.find(sign, at + 1)
            if close < 0:
                unclosed.add(sign)
            at = max(at, close) + 1
        never.update(seen)
        return -1

    out, upto, at, comments = [], 0, text.find("<"), True
    while at >= 0:
        after, gap = -1, " "
        if text.startswith("<!--", at):
            after = text.find("-->", at + 4) if comments else -1
            comments, after = after >= 0, after + 3 if after >= 0 else -1
        elif tag := name.match(text, at):
            after, gap = end(tag.end()), "" if tag[1].lower() in INLINE else " "
        if after >= 0:
            out += text[upto:at], gap
            upto = after
        at = text.find("<", max(after, at + 1))
    return "".join(out) + text[upto:]


def plain(text: str) -> str:
    """The text without markup and invisible characters, in normal width and lower case."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = without_markup(text)
    if not text.isascii():
        text = regex.sub(INVISIBLE, "", unicodedata.normalize("NFKC", text))
    return text.casefold()


def words(text: str) -> list[str]:
    return _words(plain(text))


def chars(text: str) -> str:
    return _chars(plain(text))


def _words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text)


def _chars(text: str) -> str:
    return re.sub(r"[\W_]+", "", text)


def tokens(text: str) -> list[str]:
    """Words and numbers as they stand alone, also beside ideographs, which count one by one; of a ``plain`` text."""
    return re.findall(rf"[{IDEOGRAPHS}]|[^\W_{IDEOGRAPHS}]+", text)


def pieces(units, run: int, lang: str) -> list:
    """Every run of ``run`` units, in order."""
    return [tuple(units[k : k + run]) if lang == "en" else units[k : k + run] for k in range(len(units) - run + 1)]


def terms(units, lang: str) -> list[str]:
    """Pairs of neighbouring units: single words are too common in both sides to tell a passage."""
    if lang == "en":
        return [a + " " + b for a, b in zip(units, units[1:])]
    return list(map(operator.add, units, units[1:]))


@dataclass
class Index:
    """Of one language: postings (term -> item numbers, weights, block maxima), thresholds, and the runs to verify."""

    lang: str
    run: int
    ids: list[int] = field(default_factory=list)
    postings: dict[str, tuple[list[int], list[float], list[float], float]] = field(default_factory=dict)
    least: list[float] = field(default_factory=list)
    runs: list[set] = field(default_factory=list)
    units: list = field(default_factory=list)
    answers: list[str] = field(default_factory=list)
    #: Whether every case holds a sign beyond ASCII.
    wide: bool = False


def build(items: list[tuple[int, str, str | None]], lang: str) -> Index:
    """``items``: (id, text, answer). The weights in the postings are shares of their item's threshold."""
    run = WORDS if lang == "en" else CHARS
    out = Index(lang, run)
    for i, text, answer in items:
        u = words(text or "") if lang == "en" else chars(text or "")
        if len(u) >= run:
            out.ids.append(i)
            out.answers.append(" ".join(tokens(plain(answer or ""))))
            out.units.append(u)
            out.runs.append(set(pieces(u, run, lang)))
    each = [terms(u, lang) for u in out.units]
    n = len(each)
    mean = sum(map(len, each)) / n if n else 0
    df = Counter(t for ts in each for t in set(ts))
    posted: dict = defaultdict(list)
    for at, ts in enumerate(each):
        weight = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * f * (K1 + 1) / (f + K1 * (1 - B + B * len(ts) / mean)) for t, f in Counter(ts).items()}
        out.least.append(min(sum(weight[x] for x in set(ts[k : k + run - 1])) for k in range(len(ts) - run + 2)))
        for t, w in weight.items():
            posted[t].append((at, w / out.least[-1]))
    for t, p in posted.items():
        weights = [w for _, w in p]
        tops = [max(weights[k : k + BLOCK]) for k in range(0, len(p), BLOCK)]
        out.postings[t] = ([at for at, _ in p], weights, tops, max(weights))
    out.wide = not any("".join(piece).isascii() for runs in out.runs for piece in runs)
    return out


def search(index: Index, query: set, threshold: float) -> list[tuple[int, float]]:
    """(item number, score) of every item that scores at least ``threshold`` for the distinct terms of ``query``: block-max WAND."""
    lists = [p for t in query if (p := index.postings.get(t)) is not None]
    if sum(p[3] for p in lists) < threshold:
        return []
    cursors = [[p[0][0], 0, p] for p in lists]  # item under the cursor, its place, the list
    found = []
    while cursors:
        cursors.sort(key=lambda c: c[0])
        bound, pivot = 0.0, -1
        for k, c in enumerate(cursors):
            bound += c[2][3]
            if bound >= threshold:
                pivot = k
                break
        if pivot < 0:
            break
        item = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
            pivot += 1
        # the block bound: what the lists can add for this item, from the block that would hold it
        within, edge = 0.0, math.inf
        for c in cursors[: pivot + 1]:
            docs, _, tops, _ = c[2]
            at = bisect_left(docs, item, c[1])
            if at < len(docs):
                block = at // BLOCK
                within += tops[block]
                last = docs[min(len(docs), (block + 1) * BLOCK) - 1]
                edge = min(edge, last)
        if within >= threshold:
            if cursors[0][0] == item:
                score = sum(c[2][1][c[1]] for c in cursors[: pivot + 1])
                if score >= threshold:
                    found.append((item, score))
                target = item + 1
            else:
                target = item
        else:  # no item up to the end of the nearest block, or before the next list's item, can score
            after = cursors[pivot + 1][0] if pivot + 1 < len(cursors) else math.inf
            target = max(item + 1, min(edge + 1, after))
        rest = []
        for k, c in enumerate(cursors):
            if k <= pivot and c[0] < target:
                docs = c[2][0]
                at = len(docs) if target == math.inf else bisect_left(docs, target, c[1])
                if at >= len(docs):
                    continue
                c[0], c[1] = docs[at], at
            rest.append(c)
        cursors = rest
    return found


def stretches(index: Index, units) -> Iterator[tuple[int, int]]:
    """(from, upto) of the longest stretches of at least ``run`` units whose pairs of neighbours are all in the index."""
    postings = index.postings
    known = bytes(t in postings for t in terms(units, index.lang))
    for m in re.finditer(rb"\x01{%d,}" % (index.run - 1), known):
        yield m.start(), m.end() + 1


def matches(index: Index, units) -> dict[int, tuple[float, int]]:
    """item number -> (best score of a passage that holds a case, longest run in units over the whole text)."""
    run, lang = index.run, index.lang
    size = PASSAGE[lang]
    step = size - run + 1
    best: dict[int, float] = {}
    held: dict[int, list[int]] = defaultdict(list)
    for a, b in stretches(index, units) if len(units) >= run else ():
        for start in range(a, b - run + 1, step):
            passage = units[start : min(start + size, b)]
            found = search(index, set(terms(passage, lang)), 1 - 1e-9)
            runs = pieces(passage, run, lang) if found else ()
            for item, score in found:
                at = [start + k for k, piece in enumerate(runs) if piece in index.runs[item]]
                if at:
                    held[item] += at
                    best[item] = max(best.get(item, 0.0), score * index.least[item])
    out = {}
    for item, at in held.items():
        # the stretches of the text that can hold a run, parted by what no item has
        parted, upto = [], at[0]
        for k in at:
            if k > upto:
                parted.append(object())
            parted += units[max(k, upto) : k + run]
            upto = k + run
        out[item] = (best[item], longest_run(parted, index.units[item]))
    return out


def longest_run(a, b) -> int:
    """Units of the longest run that two sequences share, by doubling: linear but for a logarithm, also for repeated units."""
    ids: dict = {}
    level = [[ids.setdefault(x, len(ids)) for x in s] for s in (a, b)]
    levels = []

    def joined(left, right, gap: int) -> list | None:
        """Ids of the runs of ``left`` followed by ``right`` after ``gap``; None if the sequences share none."""
        ids: dict = {}
        out = [[ids.setdefault(x, len(ids)) for x in zip(p, q[gap:])] for p, q in zip(left, right)]
        return out if set(out[0]) & set(out[1]) else None

    if not set(level[0]) & set(level[1]):
        return 0
    while level:
        levels.append(level)
        level = joined(level, level, 1 << (len(levels) - 1))
    at, length = levels[-1], 1 << (len(levels) - 1)
    for k in range(len(levels) - 2, -1, -1):
        if more := joined(at, levels[k], length):
            at, length = more, length + (1 << k)
    return length


SCHEMA = "id {}, item_id long, score double, longest int, answer_seen boolean"


def find(df: DataFrame, id_: str, text: str, items: DataFrame, item_id: str = "item_id", item_text: str = "text", lang: str = "lang", answer: str = "answer") -> DataFrame:
    """id, item_id, score, longest (units of the longest run that text and item share), answer_seen (the
    text holds the answer as words or a number of its own).

    The items are the stated query set: they stream through the driver and are searched for in blocks of
    ``ITEMS_AT_ONCE`` items or ``CHARS_AT_ONCE`` characters, each block one index broadcast and one pass over all texts.
    """
    spark = df.sparkSession
    kind = df.schema[id_].dataType.simpleString()
    types = (df.select(id_).limit(0).toArrow().schema.field(0).type, pa.int64(), pa.float64(), pa.int32(), pa.bool_())

    def part(block: list[tuple]) -> DataFrame:
        zh = [(r[3] or "").lower().startswith("zh") for r in block]
        indexes = spark.sparkContext.broadcast(tuple(build([r[:3] for r, z in zip(block, zh) if z == of], lang) for lang, of in (("en", False), ("zh", True))))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            each = [(index, _words if index.lang == "en" else _chars, index.wide) for index in indexes.value if index.ids]
            for b in batches:
                got = []
                for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if not t:
                        continue
                    t, seen = plain(t), None
                    for index, units, wide in each:
                        if wide and t.isascii():
                            continue
                        for item, (score, longest) in matches(index, units(t)).items():
                            a = index.answers[item]
                            seen = seen or f" {' '.join(tokens(t))} "
                            got.append((i, index.ids[item], score, longest, bool(a) and f" {a} " in seen))
                yield pa.RecordBatch.from_arrays([pa.array([g[k] for g in got], t) for k, t in enumerate(types)], names=["id", "item_id", "score", "longest", "answer_seen"])

        return df.select(id_, text).mapInArrow(run, SCHEMA.format(kind))

    out, block, held = [], [], 0
    for r in items.select(item_id, item_text, answer, lang).toLocalIterator():
        if r[item_text]:
            block.append((r[item_id], r[item_text], r[answer], r[lang]))
            held += len(r[item_text])
        if len(block) >= ITEMS_AT_ONCE or held >= CHARS_AT_ONCE:
            out.append(part(block))
            block, held = [], 0
    if block or not out:
        out.append(part(block))
    return functools.reduce(DataFrame.unionByName, out).withColumnRenamed("id", id_)
