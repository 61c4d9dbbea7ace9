"""Texts cut off by field limits or in transfer.

The corpus tells what a whole ending looks like. Its vocabulary is a trie whose nodes are prefixes of words with the
count of the words below; above the words it goes on with sequences of up to three tokens (words, single ideographs,
signs, line ends; numbers by shape), of which the corpus tells how often they end and how often they go on. A text is
cut if

1. it ends in a broken character (U+FFFD); or
2. its final word is a proper prefix of known words and itself unknown (or far rarer than they are); or
3. it is no closing line, and its longest final sequence with enough evidence hardly ever ends that way: it is a proper
   prefix of known sequences and itself no known ending. A mark of cutting, a length at the source's limit, or fewer
   characters than its writer reported ask for less doubt.

A text that ends with a full stop is whole, except a stop after a number, which is judged by rule 3 (``1.`` may be the
start of ``1.5`` or of a list item). Marks of cutting are taken off before 2 and 3. A source writes prose if most of its
texts end with a full stop, else loose lines; the two are counted apart. In prose, lines that begin like others that
mostly end bare are closing lines (signatures, lists of tags).

Two passes read every text. The first gives the vocabulary (words that something follows, so that fragments at the
ends of texts are not in it), how lines end by their first two tokens, and a row per text that may be cut with what is
needed of its end. The second counts the sequences that such texts end with, and no others: a bitmap of fixed size
sorts out nearly all that none ends with, so the table of counts has the size of the ends, not of the corpus. Sequences
go by 62-bit hashes.

Defined cases: null, empty and blank texts are not cut; a text of null source counts as prose if a full stop stands
before its end; a null source has no limit of its own; null reported lengths are no evidence; a corpus with too little
evidence for a sequence doesn't flag by rule 3; all texts are read whole. Ids must be whole numbers, and repeated ids
are judged as one text.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.session import cut

#: Tokens of the longest context.
LONGEST = 3
#: Occurrences that a context needs besides the text's own.
SUPPORT = 6
#: Share of occurrences that end alike, below which the text went on: without and with other evidence.
SURE, WITH_EVIDENCE = 0.02, 0.1
#: Occurrences that a context of loose lines needs to tell a cut without other evidence.
LOOSE_SUPPORT = 30
#: The same for prose, which ends with a stop or in a closing line.
PROSE_SURE, PROSE_WITH_EVIDENCE = 0.15, 0.2
#: The same for a full stop after a number, of which most ends of prose are none.
AFTER_NUMBER = 0.01
#: A word is unknown if the words below it in the trie are so many times as frequent.
RARER = 100
#: Lines of a kind, and the share of them that end alike, from which they are closing lines.
LINES, CLOSING = 4, 0.5
#: Words that a task holds before it passes the counts on, and tokens of which it counts the sequences at once.
HELD, TOKENS_AT_ONCE = 300_000, 1_000_000
#: Sources that are joined to the texts by broadcast; more are shuffled.
FEW_SOURCES = 100_000
#: The bitmap of final sequences has 2**BITS bits (16 MB), however many there are.
BITS = 27

#: Signs that end a sentence, and marks that systems put after a cut.
STOPS = ".。?？!！．｡"
MARKS = ("…", "...", "....", "[cut]", "[...]", "[…]", "[..]", "[truncated]", "(truncated)", "<truncated>", "[more]", "(more)", "[snip]", "(cut)", "(...)", "(…)", "[continued]", "(continued)", "[截断]", "（截断）", "【截断】", "（略）", "[未完]", "（未完）")
_CJK = r"㐀-䶿一-鿿豈-﫿぀-ヿ"


def _token(letter: str, word: str, digit: str) -> re.Pattern:
    """A line end, an ideograph, a number that no letter follows, a word (with ``_`` and apostrophes inside), or a sign."""
    joint = rf"(?<={word})[_'’](?={word})"
    return re.compile(rf"\n|[{_CJK}]|{digit}+(?:\.{digit}+)?(?!(?!{digit}){word})|(?:{letter}|{joint}){letter}*(?:{joint}{letter}*)*|[^\w\s]|_")


TOKEN = _token(rf"[^\W_{_CJK}]", rf"[^\W{_CJK}]", r"\d")
ASCII_TOKEN = _token("[A-Za-z0-9]", "[A-Za-z0-9_]", "[0-9]")
#: The general categories of characters that are invisible inside words.
INVISIBLE = re.compile("[\u00ad\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufe00-\ufe0f\ufeff]")


def strip_mark(text: str) -> tuple[str, str]:
    """The text without trailing blanks and marks of cutting, and the last mark ('' if none)."""
    text, mark = text.rstrip(), ""
    while text.endswith(MARKS):
        m = max(filter(text.endswith, MARKS), key=len)
        text, mark = text[: -len(m)].rstrip(), mark or m
    return text, mark


def shape(token: str) -> str:
    """Numbers are told by their length (one and two digits alike), digits in words are 9; letters in lower case."""
    if token.isascii() and token[0].isdigit() and re.fullmatch(r"\d+(\.\d+)?", token):
        return "#.#" if "." in token else "#" if len(token) < 3 else f"#{min(len(token), 7)}"
    return re.sub(r"\d", "9", token.lower())


def is_word(token: str) -> bool:
    return token[0] != "#" and (len(token) > 1 or (token.isalpha() and token.isascii()))


class Kept(dict):
    """What a function gives for each key, kept; the caller empties it when it grows."""

    def __init__(self, f: Callable):
        self.f = f

    def __missing__(self, key):
        out = self[key] = self.f(key)
        return out


def raw_tokens(text: str) -> list[str]:
    return ASCII_TOKEN.findall(text) if text.isascii() else TOKEN.findall(INVISIBLE.sub("", text))


def tokens(text: str) -> list[str]:
    return list(map(shape, raw_tokens(text)))


def without_last_breaks(seq: list[str]) -> list[str]:
    n = len(seq)
    while n and seq[n - 1] == "\n":
        n -= 1
    return seq[:n]


DOTS = ("…", "...", "....")


def is_prose(seq: list[str], prose: bool | None) -> bool:
    return any(t in STOPS for t in seq[:-1]) if prose is None else prose


READ = (
    "kind string, token string, bare long, stop long, dots long, n long, id long, source string, last string, lead string, inner boolean, keys array<long>, mark string, broken boolean, stopped boolean, "
    "prose boolean, chars int, bytes int, reported long"
)


def reader():
    """A mapInArrow function: (id, text, prose, source, reported, chars, bytes) in; ``READ`` out: the kinds word, lead and end."""
    names = [f.split()[0] for f in READ.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "int": pa.int32(), "array<long>": pa.list_(pa.int64())}
    types = [kinds[f.split()[1]] for f in READ.split(", ")]

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in zip(names, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shaped = Kept(shape)
        known: dict[bool, Counter] = {True: Counter(), False: Counter()}
        leads: dict[str, list[int]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            rows = [{"kind": "lead", "token": c, "bare": n[0], "stop": n[1], "dots": n[2]} for c, n in leads.items()]
            rows += [{"kind": "word", "token": f"{'p' if prose else 'l'} {w}", "n": n} for prose, words in known.items() for w, n in words.items() if is_word(w)]
            for at in range(0, len(rows), 50_000):
                yield batch(rows[at : at + 50_000])
            for held in (leads, shaped, *known.values()):
                held.clear()

        for b in batches:
            ends, tails, styles = [], [], []
            for i, text, prose, source, reported, chars, size in zip(*(c.to_pylist() for c in b.columns)):
                if not text or not text.strip():
                    continue
                body, mark = strip_mark(text)
                broken, stopped = body.endswith("\ufffd"), body[-1:] in STOPS and bool(body)
                seq = without_last_breaks(list(map(shaped.__getitem__, raw_tokens(body.rstrip("\ufffd")))))
                if not seq:
                    continue
                n = len(seq)
                prose = is_prose(seq, prose)
                known[prose].update(seq[:-1])
                line, lead = 0, ""
                for k in [*(k for k, t in enumerate(seq) if t == "\n"), n]:
                    if k > line:
                        lead = f"{'p' if prose else 'l'} {' '.join(seq[line : line + 2])}"
                        t = seq[k - 1]
                        if k < n or not mark:
                            what = 2 if t == "…" or (t == "." and seq[max(0, k - 3) : k - 1] == [".", "."]) else int(t in STOPS)
                            leads.setdefault(lead, [0, 0, 0])[what] += 1
                        elif mark in DOTS:
                            leads.setdefault(lead, [0, 0, 0])[2] += 1
                        first = line
                    line = k + 1
                if broken or not stopped or (n > 1 and seq[-2][0] == "#" and seq[-1] == "."):
                    ends.append({
                        "kind": "end", "id": i, "source": source, "last": f"{'p' if prose else 'l'} {seq[-1]}", "lead": lead, "inner": 0 < first < n - 1, "mark": mark,
                        "broken": broken, "stopped": stopped, "prose": prose, "chars": chars, "bytes": size, "reported": reported,
                    })
                    tails.append(seq[-LONGEST:])
                    styles.append(prose)
            if ends:
                codes = np.fromiter(map(code, itertools.chain.from_iterable(tails)), np.uint64)
                sizes = np.array([len(t) for t in tails])
                at = np.cumsum(sizes) - 1
                hashes = sequences(codes, np.repeat(np.array(styles), sizes))
                for k, (e, size) in enumerate(zip(ends, sizes)):
                    e["keys"] = [int(h[at[k]]) for h in hashes[:size]]
                yield batch(ends)
            if len(leads) + len(shaped) > HELD:
                yield from flush()
        yield from flush()

    return run


def code(token: str) -> int:
    return int.from_bytes(hashlib.blake2b(token.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def sequences(codes: np.ndarray, prose: np.ndarray) -> list[np.ndarray]:
    """For one, two, three tokens: the hash of the sequence that ends at each place, its two lowest bits 0, as int64."""

    def mixed(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    out, h = [], mixed(codes ^ np.where(prose, np.uint64(0x9E3779B97F4A7C15), np.uint64(0)))
    for back in range(LONGEST):
        if back:
            h = h.copy()
            h[back:] = mixed(h[back:] * np.uint64(0x9E3779B97F4A7C15) + codes[:-back])
        out.append((h & ~np.uint64(3)).view(np.int64))
    return out


def counter(bitmap):
    """A mapInArrow function: (text, prose) in; of the sequences in the broadcast ``bitmap``: hash, what follows (0 a bare end, 1 a stop, 2 dots, 3 more), how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        codes_of = Kept(lambda t: code(shape(t)))
        line_end, dot = code("\n"), code(".")
        kind = {line_end: 0, code("…"): 2} | {code(t): 1 for t in STOPS}
        held: list[list[int]] = []
        last: list[int] = []
        styles: list[bool] = []

        def counted() -> pa.RecordBatch:
            sizes = np.array([len(h) for h in held])
            codes = np.fromiter(itertools.chain.from_iterable(held), np.uint64)
            ends = np.cumsum(sizes) - 1
            what = np.full(len(codes), 3, np.int64)
            for c, k in kind.items():
                what[:-1][codes[1:] == c] = k
            what[:-2][(codes[1:-1] == dot) & (codes[2:] == dot)] = 2
            before_last = ends[sizes > 1] - 1  # a lone stop at the end is one stop, whatever the next text begins with
            what[before_last[codes[before_last + 1] == dot]] = 1
            what[ends] = last
            place = np.arange(len(codes)) - np.repeat(ends - sizes + 1, sizes)
            inside = codes != line_end
            found = []
            for back, h in enumerate(sequences(codes, np.repeat(np.array(styles), sizes))):
                ok = inside & (place >= back)
                key = h[ok].view(np.uint64)
                bit = key >> np.uint64(64 - BITS)
                ok2 = (bits[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
                found.append(key[ok2] | what[ok][ok2].astype(np.uint64))
            both, n = np.unique(np.concatenate(found), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array((both & ~np.uint64(3)).view(np.int64)), pa.array((both & np.uint64(3)).astype(np.int32)), pa.array(n)], names=["key", "what", "n"])

        total = 0
        for b in batches:
            for text, prose in zip(*(c.to_pylist() for c in b.columns)):
                if not text or not text.strip():
                    continue
                body, mark = strip_mark(text)
                raw = without_last_breaks(raw_tokens(body.rstrip("\ufffd")))
                if raw:
                    held.append(list(map(codes_of.__getitem__, raw)))
                    last.append(0 if not mark else 2 if mark in DOTS else 3)
                    styles.append(is_prose(raw, prose))
                    total += len(raw)
                if total > TOKENS_AT_ONCE:
                    yield counted()
                    total = 0
                    for x in (held, last, styles):
                        x.clear()
            if len(codes_of) > HELD:
                codes_of.clear()
        if held:
            yield counted()

    return run


def bitmap_of(keys: DataFrame):
    """The keys' first ``BITS`` bits as a broadcast bitmap of fixed size, put together where the keys are."""
    bit = F.shiftrightunsigned("key", 64 - BITS)
    words = keys.select(F.shiftrightunsigned(bit, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(63).cast("int")).alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    got = words.toArrow()  # at most 2**(BITS - 6) rows
    bits = np.zeros(1 << (BITS - 6), np.uint64)
    bits[got.column("word").to_numpy().astype(np.int64)] = got.column("mask").to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(bits)


def limits(df: DataFrame, source: str, text: str) -> DataFrame:
    """source, measure ('chars' or 'bytes'), length: the lengths at which a source's texts pile up as at a field's end.

    A pile is at least five texts and ten times the mean of the twenty lengths below it, with at most one text in
    fifty longer. The table has a row per source and length, not per text.
    """
    sizes = df.where(F.col(source).isNotNull() & F.col(text).rlike(r"\S")).select(F.col(source).alias("source"), F.explode(F.array(
        F.struct(F.lit("chars").alias("measure"), F.length(text).alias("length")), F.struct(F.lit("bytes").alias("measure"), F.octet_length(text).alias("length")))).alias("m")).select("source", "m.*")
    n = sizes.groupBy("source", "measure", "length").agg(F.count("*").alias("n"))
    of = Window.partitionBy("source", "measure")
    below = F.coalesce(F.sum("n").over(of.orderBy("length").rangeBetween(-20, -1)), F.lit(0)) / 20
    longer = F.coalesce(F.sum("n").over(of.orderBy("length").rangeBetween(4, Window.unboundedFollowing)), F.lit(0))
    piled = n.withColumn("below", below).withColumn("longer", longer).withColumn("all", F.sum("n").over(of))
    return piled.where("n >= 5 and n >= 10 * below and longer * 50 <= all").groupBy("source", "measure").agg(F.max("length").alias("length"))


def prose_sources(df: DataFrame, source: str, text: str) -> DataFrame:
    """source, prose: whether most of a source's texts end with a full stop (or a closing quote or bracket)."""
    last = F.regexp_extract(text, r"(\S)\s*$", 1)
    stopped = F.instr(F.lit(STOPS + "”\"'’)）」』】]>`"), last) > 0
    return df.where(F.col(source).isNotNull() & (last != "")).groupBy(F.col(source).alias("source")).agg((F.avg(stopped.cast("int")) >= 0.5).alias("prose"))


def judge(df: DataFrame, id_: str, text: str, source: str, reported: str) -> DataFrame:
    """id, source, cut, the rule that told it and the evidence, for every text that does not plainly end with a full stop."""
    docs = df.select(F.col(id_).cast("long").alias("id"), F.col(text).alias("text"), F.col(source).alias("source"), F.col(reported).cast("long").alias("reported"))
    styles = cut(prose_sources(docs, "source", "text"))
    by_source = F.broadcast if styles.count() <= FEW_SOURCES else lambda x: x
    styled = docs.join(by_source(styles), "source", "left")
    wide = styled.select("id", "text", "prose", "source", "reported", F.length("text").alias("chars"), F.octet_length("text").alias("bytes"))
    read = cut(wide.mapInArrow(reader(), READ))
    ends = read.where("kind = 'end'").select("id", "source", "last", "lead", "inner", "keys", "mark", "broken", "stopped", "prose", "chars", "bytes", "reported").dropDuplicates(["id"])
    vocabulary = read.where("kind = 'word'").groupBy("token").agg(F.sum("n").alias("n"))
    # a word stands after its style and a blank
    nodes = vocabulary.where(F.length("token") > 3).select(F.explode(F.transform(F.sequence(F.lit(3), F.length("token") - 1), lambda k: F.substring(F.col("token"), F.lit(1), k))).alias("last"), "n").groupBy("last").agg(F.sum("n").alias("below"))
    trie = nodes.join(vocabulary.withColumnRenamed("token", "last"), "last", "left").select("last", (F.coalesce("n", F.lit(0)) * RARER < F.col("below")).alias("fragment"))
    closing = read.where("kind = 'lead'").groupBy(F.col("token").alias("lead")).agg(*[F.sum(c).alias(f"line_{c}") for c in ("bare", "stop", "dots")])
    tails = read.where("kind = 'end'").select("id", F.posexplode("keys").alias("at", "key"), "mark")
    bits = bitmap_of(tails.select("key"))
    each = styled.select("text", "prose").mapInArrow(counter(bits), "key long, what int, n long")
    counts = each.groupBy("key").agg(*[F.sum(F.when(F.col("what") == k, F.col("n")).otherwise(0)).alias(c) for k, c in enumerate(("bare", "stop", "dots", "more"))])
    dots = F.col("mark").isin(*DOTS)
    alike = F.when(dots, F.col("dots")).when(F.col("mark") == "", F.col("bare")).otherwise(F.lit(0))
    own = F.when((F.col("mark") == "") | dots, 1).otherwise(0)
    others = F.col("bare") + F.col("stop") + F.col("dots") + F.col("more") - 1
    best = tails.join(counts, "key").where(others >= SUPPORT).groupBy("id").agg(F.max_by(F.struct(((alike - own) / others).alias("ratio"), (F.col("at") + 1).alias("context"), others.alias("evidence")), "at").alias("e")).select("id", "e.*")
    lines = F.col("line_bare") + F.col("line_stop") + F.col("line_dots")
    # in loose lines every line ends bare, so there the beginning tells nothing about a bare end
    like = F.when(dots, F.col("line_dots") - 1).when(F.col("prose") & (F.col("mark") == "") & F.col("inner"), F.col("line_bare") - 1).otherwise(F.lit(0))
    closes = F.coalesce((lines > LINES) & (like >= CLOSING * (lines - 1)), F.lit(False))
    piles = limits(docs, "source", "text").groupBy("source").pivot("measure", ["chars", "bytes"]).agg(F.max("length"))
    piles = piles.select("source", F.col("chars").alias("limit_chars"), F.col("bytes").alias("limit_bytes"))
    out = ends.join(best, "id", "left").join(trie, "last", "left").join(closing, "lead", "left").join(by_source(piles), "source", "left")
    full = F.coalesce(F.col("chars").between(F.col("limit_chars") - 1, F.col("limit_chars")), F.lit(False)) | F.coalesce(F.col("bytes").between(F.col("limit_bytes") - 3, F.col("limit_bytes") + 3), F.lit(False))
    short = F.coalesce((F.col("reported") > F.col("chars")) & (F.col("reported") != F.col("bytes")), F.lit(False))
    told = out.withColumns({"fragment": F.coalesce("fragment", F.lit(False)), "at_limit": full, "short": short, "closing": closes})
    told = told.withColumn("cut", _cut(dots))
    length = F.col("at_limit") | F.col("short")
    rule = F.when(F.col("broken"), "broken character").when(~F.col("stopped") & F.col("fragment"), F.when(length, "fragment of a word, by its length too").otherwise("fragment of a word"))
    rule = rule.when(F.col("mark") != "", "mark").when(length, "sequence that goes on, by its length too").otherwise("sequence that goes on")
    return told.withColumn("rule", F.when(F.col("cut"), rule)).drop("keys", "last", "lead", "inner", "line_bare", "line_stop", "line_dots")


def _cut(dots: Column) -> Column:
    evidence = F.col("at_limit") | F.col("short") | (F.col("mark") != "")
    doubt = F.when(F.col("prose"), F.when(evidence, PROSE_WITH_EVIDENCE).otherwise(PROSE_SURE)).when(evidence, WITH_EVIDENCE).otherwise(SURE)
    enough = F.col("prose") | evidence | (F.col("evidence") >= LOOSE_SUPPORT)
    went_on = F.coalesce((F.col("ratio") < doubt) & enough, F.col("prose") & evidence)
    bare = F.col("fragment") | ((F.col("mark") != "") & ~dots) | (~F.col("closing") & went_on)
    after_number = F.coalesce(F.col("ratio") < AFTER_NUMBER, F.lit(False))
    return F.col("broken") | F.when(F.col("stopped"), after_number).otherwise(bare)


def rates(df: DataFrame, judged: DataFrame, source: str, text: str) -> DataFrame:
    """Per source: texts with content, how many are cut, and the share."""
    whole = df.where(F.col(text).rlike(r"\S")).groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n_texts"))
    flagged = judged.where("cut").groupBy("source").agg(F.count("*").alias("n_cut"))
    joined = whole.join(flagged, whole["source"].eqNullSafe(flagged["source"]), "left").select(whole["source"], "n_texts", F.coalesce("n_cut", F.lit(0)).alias("n_cut"))
    return joined.withColumn("rate", F.col("n_cut") / F.col("n_texts"))
