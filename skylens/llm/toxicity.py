"""Toxicity by noisy-channel deobfuscation: decode disguised tokens, then score the restored words.

Tokens with look-alike symbols beside letters, letters repeated three times or more, and letters set
apart one by one are character lattices of any length. A Viterbi search finds the likeliest letters
under a character trigram language model and fixed channel costs; letters set apart may be several
words, which known words tell. Words as written and words restored are then scored by a lexicon learned from labelled rows: the share of toxic documents among those that
hold a word, backed off to words that begin alike (the smaller of the share of toxic documents that
hold one, and of toxic word types). So that copies of one document don't count as many, labelled rows
with the same label and sketch whose words are alike count once, and what looks toxic by documents is then judged by
the different neighbours (word before, word after) it has in toxic and in other rows; listed words that neither
look toxic nor begin as what does keep their share by documents. A document's
score is the share of toxic rows among those with as many such words and as telling a one.

Learning uses all labelled rows (fewer, chosen by a hash of their id, only where a caller gives
``max_rows``); their texts are counted on the executors, and the model that goes to the scoring
tasks has at most ``MAX_ENTRIES`` words, prefixes and trigrams each.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from skylens.llm import spans
from skylens.llm.common import ROW, keyed, written

BROADCAST_ROWS = 1_000_000
MAX_ENTRIES = 100_000
ALIKE = 0.8  # share of common words from which on labelled rows are copies
WORD_WEIGHT, PREFIX_WEIGHT = 5.0, 8.0  # observations that the prior counts for
PREFIXES = range(4, 9)
#: Letters that a symbol can stand for.
LOOKALIKES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
              "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i"}
SEPARATORS = " .-_*~"
SWAP_COST, DROP_COST, KEEP_COST, DOUBLE_COST = 1.0, 2.0, 12.0, 0.5

_WORD = re.compile(r"[^\W\d_]+")
_SYMBOL = "[0-9@$!|+(€£¡]"
_MIXED = re.compile(rf"(?:[^\W\d_]+{_SYMBOL}+|{_SYMBOL}+(?=[^\W\d_]))(?:[^\W\d_]|{_SYMBOL})*")
_REPEATED = re.compile(r"[^\W\d_]*([^\W\d_])\1\1[^\W\d_]*")
_SPACED = re.compile(rf"(?<![^\W_])(?:(?:[^\W\d_]|{_SYMBOL})[ .\-_*~]){{3,}}(?:[^\W\d_]|{_SYMBOL})(?![^\W_])")

_COUNT, _BEST, _NOTHING = itemgetter(0), itemgetter(1), (0, (-1.0, ""))
_ODD = re.compile(rf"{_SYMBOL}|(.)\1\1", re.S)  # what every disguise holds
_APART = re.compile(r"[ .\-_*~][^ .\-_*~][ .\-_*~][^ .\-_*~][ .\-_*~]")


@dataclass
class Model:
    prior: float
    words: dict[str, float]
    prefixes: dict[str, float]
    trigrams: dict[str, float]
    floor: float
    calibration: dict[tuple[int, int], float] = field(default_factory=dict)
    decoded: dict[str, str] = field(default_factory=dict)
    on_its_way: Broadcast | None = None

    def decode(self, token: str) -> str:
        """Likeliest letters behind ``token``; states are the last two letters."""
        if token in self.decoded:
            return self.decoded[token]
        runs = [(m.group(0)[0], len(m.group(0))) for m in re.finditer(r"(.)\1*", token, re.S)]
        best: dict[str, tuple] = {"^^": (0.0, None)}  # price, and the letters so far as a chain from the last
        for at_run, (char, n) in enumerate(runs):
            ended = False
            if char.isalpha():
                options = [(char, 0.0 if n == 1 else DOUBLE_COST)] + [(char * 2, 0.0 if n == 2 else DOUBLE_COST)] * (n > 1)
            elif char in LOOKALIKES:
                mark = at_run == len(runs) - 1 and not char.isdigit()  # may be punctuation
                options = [(x, SWAP_COST) for x in LOOKALIKES[char]] + [(x * 2, SWAP_COST) for x in LOOKALIKES[char] if n > 1] + [("", DROP_COST if mark else KEEP_COST)]
            else:
                options, ended = [("", DROP_COST if n == 1 else KEEP_COST)], char in SEPARATORS
            after: dict[str, tuple] = {}
            for state, (spent, chain) in best.items():
                for letters, price in options:
                    at, total = state, spent + price
                    for letter in letters:
                        total += self.trigrams.get(at + letter, self.floor)
                        at = at[1] + letter
                    if at not in after or total < after[at][0]:
                        after[at] = (total, (chain, letters) if letters else chain)
                if ended and state != "^^":
                    total = spent + DROP_COST + self.trigrams.get(state + "$", self.floor)
                    if "^^" not in after or total < after["^^"][0]:
                        after["^^"] = (total, (chain, " "))
            best = after
        chain = min((spent + self.trigrams.get(state + "$", self.floor), state, chain) for state, (spent, chain) in best.items())[2]
        parts = []
        while chain:
            chain, letters = chain
            parts.append(letters)
        out = "".join(reversed(parts))
        if len(token) <= 64:  # longer ones are too seldom alike to keep
            if len(self.decoded) > 200_000:
                self.decoded.clear()
            self.decoded[token] = out
        return out

    def pieces(self, letters: str) -> list[str]:
        """Known words and beginnings in ``letters`` that leave the fewest letters over, then the fewest of them."""
        best = [(0, 0, None)]  # letters left over, words, the last word as (begin, end, word)
        for end in range(1, len(letters) + 1):
            left, n, _ = best[end - 1]
            found = (left + 1, n, None)
            for begin in (end - n for n in self.lengths if n <= end):
                w = letters[begin:end]
                if (w in self.words or w in self.prefixes) and (best[begin][0], best[begin][1] + 1) < found[:2]:
                    found = (best[begin][0], best[begin][1] + 1, (begin, end, w if w in self.words else letters[begin:end + 1]))
            best.append(found)
        out, at = [], len(letters)
        while at > 0:
            last = best[at][2]
            at = last[0] if last else at - 1
            if last:
                out.append(last[2])
        return out[::-1]

    def undone(self, disguise: str, apart: bool = False) -> list[str]:
        """Words that decoding adds to those written in ``disguise``; letters set apart can be several
        words: known ones in them are taken, else all readings."""
        own, words = set(_WORD.findall(disguise)), _WORD.findall(self.decode(disguise))
        if apart:
            joined = "".join(words)
            words = self.pieces(joined) or list(dict.fromkeys([*words, joined]))
        return [w for w in words if w not in own]

    def restored(self, text: str) -> list[str]:
        """Lower-case words of a text, as written and (what differs from the token's own words) as decoded."""
        low = text.lower()
        out = _WORD.findall(low)
        for t in sorted(_disguises(low)):
            out += self.undone(t)
        for t in sorted(_set_apart(low)):
            out += self.undone(t, apart=True)
        return out

    def word(self, w: str) -> float:
        known = self.words.get(w)
        if known is not None:
            return known
        if w[:PREFIXES[0]] not in self.begun:
            return 0.0
        return max((self.prefixes.get(w[:n], 0.0) for n in PREFIXES if n < len(w)), default=0.0)

    def told(self, words: list[str]) -> tuple[int, tuple[float, str]] | None:
        """(how many of the words tell of label 1, the most telling one with its value) of those that begin as a known one does."""
        found = [(self.word(w), w) for w in words if w[:PREFIXES[0]] in self.heads]
        return (sum(v >= 0.5 for v, _ in found), max(found)) if found else None

    def evidence(self, text: str) -> tuple[int, float, str | None]:
        """(words that tell of label 1, up to 6; the most telling one's value; that word) of the text's ``restored`` words.

        Only letters set apart can hold white space; all else is looked up by token, and few tokens tell anything.
        """
        low = text.lower()
        found, hidden = list(filter(None, map(self.tokens.__getitem__, low.split()))), {}
        for told in found:
            if len(told) == 3:
                hidden.update(told[2])
        for t in _set_apart(low):
            hidden[t] = self.told(self.undone(t, apart=True))
        found += filter(None, hidden.values())
        value, word = max(map(_BEST, found), default=(0.0, None))
        return min(sum(map(_COUNT, found)), 6), value, word

    def score(self, text: str) -> tuple[float, str | None]:
        """Probability of label 1, and the word that tells most."""
        count, value, word = self.evidence(text)
        known = self.calibration.get((count, _band(value)))
        value = max(value, self.prior / 4)
        return (value if known is None else 0.9 * known + 0.1 * value), word

    def shared(self, spark: SparkSession) -> Broadcast:
        """The model on its way to the tasks, the same for every pass, so that a worker holds and reads it once."""
        if self.on_its_way is None:
            self.on_its_way = spark.sparkContext.broadcast(self)
        return self.on_its_way

    def __getstate__(self):
        return self.__dict__ | {"on_its_way": None}

    def __post_init__(self):
        self.heads = {w[:PREFIXES[0]] for w in (*self.prefixes, *self.words)}
        self.begun = {w[:PREFIXES[0]] for w in self.prefixes}
        self.lengths = sorted({n for n in map(len, (*self.prefixes, *self.words)) if n >= PREFIXES[0]}, reverse=True)
        self.tokens = _Tokens(self)


class _Tokens(dict):
    """What a token without white space tells, kept for its next occurrences: ``told`` of its own words
    (None for nothing) or, if it holds disguises, that and ``told`` of what decoding adds by disguise."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, token: str):
        if token.isalpha():
            plain = (int((value := self.model.word(token)) >= 0.5), (value, token)) if token[:PREFIXES[0]] in self.model.heads else None
        else:
            plain = self.model.told(_WORD.findall(token))
        hidden = {t: more for t in _disguises(token) if (more := self.model.told(self.model.undone(t)))} if _ODD.search(token) else None
        told = (*(plain or _NOTHING), hidden) if hidden else plain
        if len(token) <= 64:  # longer ones are too seldom alike to keep
            if len(self) >= 150_000:
                self.clear()
            self[token] = told
        return told


def _disguises(low: str) -> set[str]:
    """Tokens with look-alike symbols beside letters, or with letters repeated."""
    return {m.group(0) for m in _MIXED.finditer(low)} | {m.group(0) for m in _REPEATED.finditer(low)}


def _set_apart(low: str) -> set[str]:
    """Letters set apart one by one; they hold three separators with one character between each two."""
    return {m.group(0) for m in _SPACED.finditer(low)} if _APART.search(low) else set()


def _band(value: float) -> int:
    """Grades of the most telling word's value."""
    return sum(value >= limit for limit in (0.15, 0.3, 0.5, 0.7, 0.9, 0.97))


def _calibrated(model: Model, rows: DataFrame) -> dict[tuple[int, int], float]:
    """Share of toxic ``rows`` (text, toxic) by (count, grade) of their evidence, at most some 50 cells;
    two rows' worth of the grade's own mean keep small cells near it."""
    shared = model.shared(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.evidence(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _, _ in found], pa.int32()), pa.array([_band(v) for _, v, _ in found], pa.int32()),
                                              pa.array([v for _, v, _ in found], pa.float64()), batch.column("toxic").cast(pa.int64())], names=["count", "band", "value", "toxic"])

    cells = rows.select("text", "toxic").mapInArrow(run, "count int, band int, value double, toxic long").groupBy("count", "band") \
        .agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t"), F.avg("value").alias("mean")).collect()
    return {(r["count"], r["band"]): (r["t"] + 2 * r["mean"]) / (r["n"] + 2) for r in cells}


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Smallest hashes of a text's words under two hash functions, and the set of all of them."""
    for part, texts in spans.slices(batches, "text"):
        buf, begins = spans.join_texts(texts)
        buf = spans.lowered(buf)
        starts, ends = spans.words(buf)
        first = np.searchsorted(starts, begins)
        h = spans.hashes(buf, starts, ends)
        least = []
        for x in (h, spans.mix(h + np.uint64(1))):
            cells = np.append(x, np.uint64(2**64 - 1))
            low = np.minimum.reduceat(cells, first)
            low[np.diff(np.append(first, len(h))) == 0] = 0
            least.append(pa.array(low.view(np.int64)))
        after = np.append(first, len(h))
        sets = [np.unique(h[a:b]).tobytes() for a, b in zip(after[:-1], after[1:])]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), *least, pa.array(sets, pa.binary())], names=["doc_id", "toxic", "s1", "s2", "words"])


def _alike(table: pa.Table) -> pa.Table:
    """Rows of one sketch and label, smallest id first, without those whose words are alike
    (Jaccard of ``ALIKE`` or more) to the words of a row that stays."""
    table = table.sort_by("doc_id")
    kept, sizes, at, stays = np.zeros(1 << 12, np.uint64), np.zeros(0, np.int64), 0, []
    for i, raw in enumerate(table["words"]):
        own = np.frombuffer(raw.as_py(), np.uint64)
        if len(sizes):
            held = kept[:at]
            place = np.minimum(np.searchsorted(own, held), max(len(own) - 1, 0))
            hits = own[place] == held if len(own) else np.zeros(at, bool)
            shared = np.diff(np.concatenate([[0], np.cumsum(hits)])[np.concatenate([[0], np.cumsum(sizes)])])
            if (shared >= ALIKE * (sizes + len(own) - shared)).any():
                continue
        stays.append(i)
        sizes = np.append(sizes, len(own))
        while at + len(own) > len(kept):
            kept = np.concatenate([kept, np.zeros_like(kept)])
        kept[at:at + len(own)] = own
        at += len(own)
    return table.select(["doc_id", "toxic"]).take(pa.array(stays, pa.int64()))


def _count_held(kind: str, held_by: Callable[[set[str]], Iterable[str]]):
    """Documents that hold each entry, by label; ``held_by`` tells those of a document from its words. A shuffle adds them up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter(), Counter()

        def out():
            entries = list(counts[0].keys() | counts[1].keys())
            return pa.RecordBatch.from_arrays([pa.array(entries, pa.string()), *(pa.array([counts[label].get(e, 0) for e in entries], pa.int64()) for label in (1, 0))],
                                              names=[kind, "toxic", "clean"])

        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                counts[label].update(held_by(set(_WORD.findall(text.lower()))))
                if len(counts[0]) + len(counts[1]) > 300_000:
                    yield out()
                    counts[0].clear()
                    counts[1].clear()
        yield out()

    return run


def _beginnings(known: set[str] | None):
    """Beginnings among the ``known`` ones (None: all) of a document's words."""
    heads = None if known is None else {p[:PREFIXES[0]] for p in known}

    def of(own: set[str]) -> set[str]:
        if known is None:
            return {w[:n] for w in own for n in PREFIXES if n < len(w)}
        return {w[:n] for w in own if w[:PREFIXES[0]] in heads for n in PREFIXES if n < len(w) and w[:n] in known}

    return of


def _neighbours(words: set[str], prefixes: set[str]):
    """(entry, pair of neighbours, label), each once in a task, for words and beginnings (marked ^)."""
    heads = {w[:PREFIXES[0]] for w in words | prefixes}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, int, int]] = set()

        def out():
            columns = list(zip(*seen)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int32()))], names=["entry", "near", "toxic"])

        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                row = ["", *_WORD.findall(text.lower()), ""]
                for i in [i for i, w in enumerate(row) if w[:PREFIXES[0]] in heads]:
                    w, near = row[i], zlib.crc32(f"{row[i - 1]} {row[i + 1]}".encode())
                    if w in words:
                        seen.add((w, near, label))
                    for n in PREFIXES:
                        if n < len(w) and w[:n] in prefixes:
                            seen.add(("^" + w[:n], near, label))
                if len(seen) > 300_000:
                    yield out()
                    seen.clear()
        yield out()

    return run


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for w, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
            p = f"^^{w}$"
            for i in range(len(p) - 2):
                counts[p[i:i + 3]] += n
        if len(counts) > 300_000:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["gram", "n"])
            counts.clear()
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["gram", "n"])


def fold(id_col: str, n: int = 5):
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n))


def _without_copies(rows: DataFrame) -> DataFrame:
    """(doc_id, toxic) of labelled ``rows`` (doc_id, text, toxic) with near copies left out: equal sets of
    words collapse first; rows that share a sketch are then compared by all their words."""
    sets = rows.mapInArrow(_sketch, "doc_id long, toxic int, s1 long, s2 long, words binary")
    equal = sets.groupBy("s1", "s2", "toxic", F.md5("words")).agg(F.min(F.struct("doc_id", "words")).alias("least"))
    return (equal.select("s1", "s2", "toxic", "least.doc_id", "least.words").groupBy("s1", "s2", "toxic")
            .applyInArrow(_alike, "doc_id long, toxic int").distinct())


def train(docs: DataFrame, labels: DataFrame, max_rows: int | None = None, max_entries: int = MAX_ENTRIES) -> Model:
    """Learns from rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) marks and whose fold isn't 0.

    All such rows count unless ``max_rows`` is given. Rows with a null or other label than 0 and 1 are left out; of repeated labels the larger counts.
    Without any label the model has no words and every score is the prior's.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where(F.col("toxic").isin(0, 1) & (fold("doc_id") != 0)).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    known = written(known, "known")
    if max_rows is not None:
        share = min(1.0, 0.95 * max_rows / max(known.count(), 1))  # by hash; about max_rows at most
        known = written(known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))), "chosen")
    # few ids go to the texts; texts are moved to them only where there are too many
    near_texts = (lambda ids: F.broadcast(ids)) if known.count() <= BROADCAST_ROWS else (lambda ids: ids)
    single = written(_without_copies(docs.select("doc_id", "text").join(near_texts(known), "doc_id")), "single")
    learned = written(docs.select("doc_id", "text").join(near_texts(single), "doc_id").select("text", "toxic"), "learned")
    counted = lambda kind, held_by: (learned.mapInArrow(_count_held(kind, held_by), f"{kind} string, toxic long, clean long")
                                     .groupBy(kind).agg(F.sum("toxic").alias("d1"), F.sum("clean").alias("d0")))
    words = written(counted("word", lambda own: own), "words")
    n1, n0 = single.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    prior = (n1 or 0) / max((n1 or 0) + (n0 or 0), 1)
    likely = lambda toxic, all_: f"({toxic} + {PREFIX_WEIGHT * prior}) / ({all_} + {PREFIX_WEIGHT})"
    types = (words.where(f"length(word) > {PREFIXES[0]}")
             .select(F.explode(F.expr(f"transform(sequence({PREFIXES[0]}, least(length(word) - 1, {PREFIXES[-1]})), i -> substr(word, 1, i))")).alias("prefix"),
                     F.expr("d1 / (d1 + d0)").alias("share"))
             .groupBy("prefix").agg(F.sum("share").alias("t"), F.count(F.lit(1)).alias("n")).select("prefix", F.expr(likely("t", "n")).alias("p_types")))
    types = written(types.where("p_types >= 0.3"), "types")  # documents are counted for these alone
    few = types.count() <= BROADCAST_ROWS
    held = (counted("prefix", _beginnings({r.prefix for r in types.select("prefix").toLocalIterator()} if few else None))
            .select("prefix", F.expr(likely("d1", "(d1 + d0)")).alias("p_docs")))
    prefixes = (held.join(types, "prefix").select("prefix", F.least("p_docs", "p_types").alias("p")).where("p >= 0.3")
                .orderBy(F.desc("p"), "prefix").limit(max_entries))
    prefix = {r.prefix: r.p for r in prefixes.collect()}
    heads = words.sparkSession.createDataFrame([(p[:4],) for p in prefix] or [("",)], "head string").distinct()
    chosen_words = (words.join(F.broadcast(heads), F.substring("word", 1, 4) == F.col("head"), "left")
                    .withColumn("looks", F.expr(f"(d1 + {WORD_WEIGHT * prior}) / (d1 + d0 + {WORD_WEIGHT}) >= 0.3")).where("head is not null or looks")
                    .orderBy(F.desc("looks"), F.expr("d1 + d0").desc(), "word").limit(max_entries).select("word", "d1", "d0", "looks"))
    listed = {r.word: r for r in chosen_words.collect()}
    # most listed words only share four letters with a longer beginning, more of them the more texts there are; they look clean, and documents tell as much
    judged = {w for w, r in listed.items() if r.looks or any(w[:n] in prefix for n in PREFIXES if n < len(w))}
    near = (learned.mapInArrow(_neighbours(judged, set(prefix)), "entry string, near long, toxic int").distinct()
            .groupBy("entry").agg(F.sum("toxic").alias("d1"), F.sum(1 - F.col("toxic")).alias("d0")).collect())
    seen = {r.entry: (r.d1, r.d0) for r in near} | {w: (r.d1, r.d0) for w, r in listed.items() if w not in judged}
    share = lambda entry, back, weight: (seen.get(entry, (0, 0))[0] + weight * back) / (sum(seen.get(entry, (0, 0))) + weight)
    prefix = {p: min(value, share("^" + p, prior, PREFIX_WEIGHT)) for p, value in prefix.items()}
    prefix = {p: value for p, value in prefix.items() if value >= 0.3}
    entries = {w: share(w, max([prior, *(prefix.get(w[:n], 0.0) for n in PREFIXES if n < len(w))]), WORD_WEIGHT) for w in listed}
    grams = (words.select("word", F.expr("d1 + d0").alias("n")).mapInArrow(_count_trigrams, "gram string, n long")
             .groupBy("gram").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "gram").limit(max_entries).collect())
    model = Model(prior, entries, prefix, *_language(grams))
    model.calibration = _calibrated(model, learned)
    return model


def _language(grams) -> tuple[dict[str, float], float]:
    """-log P(third letter | first two), smoothed, and the price of what was never seen."""
    context: Counter = Counter()
    for g in grams:
        context[g.gram[:2]] += g.n
    prices = {g.gram: -math.log((g.n + 0.1) / (context[g.gram[:2]] + 5.0)) for g in grams}
    return prices, max([8.0, *prices.values()])


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(_row, doc_id, score, evidence) for every row of ``docs`` (_row, doc_id, text); whole texts."""
    shared, calibration = model.shared(docs.sparkSession), model.calibration  # the model went out before it was calibrated

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.value.calibration = calibration
        for batch in batches:
            found = [shared.value.score(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(ROW), batch.column("doc_id"), pa.array([s for s, _ in found], pa.float64()),
                                              pa.array([w for _, w in found], pa.string())], names=[ROW, "doc_id", "score", "evidence"])

    return docs.mapInArrow(run, f"{ROW} long, doc_id long, score double, evidence string")


def toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: _row, doc_id, held_out, score, predicted, evidence.

    Null and empty text scores a quarter of the share of toxic rows. A null id is not held out and
    not learned from; repeated rows score alike; texts of any length are scored whole; other columns
    are no inputs; an empty table gives no rows.
    """
    docs = keyed(df, id_col, text_col)
    scored = score_documents(docs, train(docs, labels))
    return scored.select(ROW, "doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")
