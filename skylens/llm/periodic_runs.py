"""Periodic runs of words, found by block convolution.

A run is a stretch of words that repeats with smallest period q at least four times and that no
neighbouring word extends. Periods are searched scale by scale: for q in [s, 2s), s = 1, 2, 4, ...,
a text is cut into blocks of s words. A run holds a whole block whose copy q words later lies in the
run as well, so every run shows where a block occurs again s to 2s - 1 words later with no mismatch.
The mismatch of all shifts at once is the sum of squared differences of word numbers, whose mixed term
is a convolution; number theoretic transforms give it modulo as many primes as its largest value
needs, so a zero is a zero. Distances found are joined over neighbouring blocks and extended to the
words that end them.

Blocks that can't occur are left out before: those with a word that doesn't come again within
2s - 1 words, and those deep inside a run of smaller period, where only its multiples occur.

Scale: one pass over the rows, no shuffle; a task transforms the blocks of many texts at once, and
memory follows the longest text, not the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skylens.llm.common import ship

#: (prime, generator); each takes transforms of 2^25 words at least.
PRIMES = ((2013265921, 31), (469762049, 3), (167772161, 3))
LEAST_LENGTH, LEAST_PERIODS = 6, 4
GROUP_WORDS = 1 << 18
_CELLS = 1 << 18
_OUT = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


@lru_cache(maxsize=128)
def _twiddles(n: int, prime: int, generator: int) -> tuple[list[np.ndarray], list[np.ndarray], int]:
    """Powers of the roots of unity for half sizes 1, 2, ... n / 2, those of their inverses, and 1 / n."""
    forth, back = [], []
    half = 1
    while half < n:
        root = pow(generator, (prime - 1) // (2 * half), prime)
        for table, r in ((forth, root), (back, pow(root, prime - 2, prime))):
            powers = np.ones(half, np.int64)
            done = 1
            while done < half:  # doubling: the next powers are the known ones times r^done
                powers[done:2 * done] = powers[:done] * pow(r, done, prime) % prime
                done *= 2
            table.append(powers)
        half *= 2
    return forth, back, pow(n, prime - 2, prime)


def transform(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Number theoretic transform of each row (a power of two long), in bit-reversed order."""
    m, n = rows.shape
    forth = _twiddles(n, prime, generator)[0]
    rows = rows % prime
    for powers in reversed(forth):
        pair = rows.reshape(m, -1, 2, len(powers))
        a, b = pair[:, :, 0], pair[:, :, 1]
        rows = np.stack([(a + b) % prime, (a - b + prime) * powers % prime], axis=2).reshape(m, n)
    return rows


def inverse(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """What ``transform`` was given, from its bit-reversed result."""
    m, n = rows.shape
    _, back, share = _twiddles(n, prime, generator)
    for powers in back:
        pair = rows.reshape(m, -1, 2, len(powers))
        a, b = pair[:, :, 0], pair[:, :, 1] * powers % prime
        rows = np.stack([(a + b) % prime, (a - b + prime) % prime], axis=2).reshape(m, n)
    return rows * share % prime


def occurrences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Where row i of ``blocks`` (s words) occurs in row i of ``windows`` (2s words): (rows, s) booleans."""
    m, s = blocks.shape
    top = int(max(blocks.max(initial=0), windows.max(initial=0)))
    found, modulus = np.ones((m, s), bool), 1
    turned = np.zeros((m, 2 * s), np.int64)
    turned[:, 0] = blocks[:, 0]
    turned[:, s + 1:] = blocks[:, :0:-1]
    for prime, generator in PRIMES:
        own = (blocks * blocks % prime).sum(axis=1) % prime
        sums = np.zeros((m, 2 * s + 1), np.int64)
        np.cumsum(windows * windows % prime, axis=1, out=sums[:, 1:])
        other = (sums[:, s:2 * s] - sums[:, :s]) % prime
        mixed = inverse(transform(turned, prime, generator) * transform(windows, prime, generator) % prime, prime, generator)[:, :s]
        found &= (own[:, None] + other - 2 * mixed) % prime == 0
        modulus *= prime
        if modulus > s * top * top:
            return found
    raise ValueError("a text has too many words")


class _Known:
    """Runs found at smaller scales; tells which stretches lie inside one of them."""

    def __init__(self) -> None:
        self.scales: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        order = np.argsort(start, kind="stable")
        self.scales.append((start[order], end[order], period[order]))

    def inside(self, begin: np.ndarray, end: np.ndarray, distance: np.ndarray | None = None) -> np.ndarray:
        """Stretches in a run (whose period divides ``distance``). Two runs of one scale overlap by less
        than a stretch of a later one is long, so the last run that starts before it decides."""
        out = np.zeros(len(begin), bool)
        for starts, ends, periods in self.scales:
            if len(starts):
                at = np.searchsorted(starts, begin, side="right") - 1
                hit = (at >= 0) & (ends[at] >= end)
                out |= hit if distance is None else hit & (distance % periods[at] == 0)
        return out


def _matched(codes: np.ndarray, at: np.ndarray, step: int, distance: np.ndarray, room: np.ndarray, most: int) -> np.ndarray:
    """How many words from ``at`` on (in direction ``step``, ``room`` words at most) equal those ``distance`` later."""
    out = np.zeros(len(at), np.int64)
    offsets = np.arange(most)
    rows = max(1, _CELLS // max(1, most))
    for k in range(0, len(at), rows):
        a, d, r = at[k:k + rows, None], distance[k:k + rows, None], room[k:k + rows, None]
        inside = offsets < r
        x = np.where(inside, a + step * offsets, 0)
        same = inside & (codes[x] == codes[np.where(inside, x + d, 0)])
        out[k:k + rows] = np.where(same.all(axis=1), most, same.argmin(axis=1)) if most else 0
    return out


def find_runs(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of texts laid end to end, sorted by start and period.

    ``codes`` numbers the words from 1 within each text; text t is codes[bounds[t]:bounds[t + 1]].
    """
    n = len(codes)
    sizes = np.diff(bounds)
    none = np.zeros(0, np.int64)
    if not n:
        return none, none, none
    text = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((codes, text))  # stable, so equal words of a text stay in their order
    again = np.full(n, n, np.int64)
    same = (codes[order[1:]] == codes[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    again[order[:-1][same]] = (order[1:] - order[:-1])[same]

    known, out, s = _Known(), [], 1
    while max(LEAST_LENGTH, LEAST_PERIODS * s) <= sizes.max():
        long = np.flatnonzero(sizes >= max(LEAST_LENGTH, LEAST_PERIODS * s))
        per = sizes[long] // s - 1  # a copy must follow
        first = np.cumsum(per) - per
        begin = np.repeat(bounds[long] - first * s, per) + np.arange(per.sum()) * s
        alone = np.zeros(n + 1, np.int64)
        np.cumsum(again >= 2 * s, out=alone[1:])
        begin = begin[alone[begin + s] == alone[begin]]
        begin = begin[~known.inside(begin, begin + 3 * s)]
        padded = np.concatenate([codes, np.zeros(3 * s, np.int64)])
        seeds = []
        rows = max(1, _CELLS // (2 * s))
        for k in range(0, len(begin), rows):
            b = begin[k:k + rows]
            hit, shift = np.nonzero(occurrences(padded[b[:, None] + np.arange(s)], padded[b[:, None] + np.arange(s, 3 * s)]))
            seeds.append(np.stack([b[hit], shift + s]))
        at, distance = np.concatenate(seeds, axis=1) if seeds else (none, none)
        stop = bounds[text[at] + 1]
        keep = (at + distance + s <= stop)
        keep &= ~known.inside(at, at + distance + s, distance)
        at, distance = at[keep], distance[keep]
        by = np.lexsort((at, distance))
        at, distance = at[by], distance[by]
        new = np.ones(len(at), bool)
        new[1:] = (distance[1:] != distance[:-1]) | (at[1:] != at[:-1] + s)
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(at)) - 1 if len(head) else head
        left, right, distance = at[head], at[tail] + s, distance[head]
        # the blocks before and after don't match as a whole, so each side gains less than s words
        enough = right - left + 2 * (s - 1) + distance >= np.maximum(LEAST_LENGTH, LEAST_PERIODS * distance)
        left, right, distance = left[enough], right[enough], distance[enough]
        begin_of, stop = bounds[text[left]], bounds[text[left] + 1]
        start = left - _matched(codes, left - 1, -1, distance, left - begin_of, s - 1)
        end = right + _matched(codes, right, 1, distance, stop - distance - right, s - 1) + distance
        whole = end - start >= np.maximum(LEAST_LENGTH, LEAST_PERIODS * distance)
        start, end, distance = start[whole], end[whole], distance[whole]
        known.add(start, end, distance)
        out.append((start, end, distance))
        s *= 2
    if not out:
        return none, none, none
    start, end, period = (np.concatenate(x) for x in zip(*out))
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _words_numbered(words: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Numbers from 1 within each text, equal for equal words."""
    code = pa.array(words, pa.large_binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(len(sizes)), sizes)
    key = text * (int(code.max(initial=0)) + 1) + code
    kept, index = np.unique(key, return_inverse=True)
    of_text = kept // (int(code.max(initial=0)) + 1)
    first = np.searchsorted(of_text, np.arange(len(sizes)))
    return index - first[text] + 1


def _scan(ids: list, texts: list[list[bytes]], schema: pa.Schema) -> pa.RecordBatch:
    sizes = np.array([len(t) for t in texts], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    codes = _words_numbered([w for t in texts for w in t], sizes)
    start, end, period = find_runs(codes, bounds)
    text = np.searchsorted(bounds, start, side="right") - 1
    step = np.zeros(len(codes) + 1, np.int64)
    np.add.at(step, start + period, 1)
    np.add.at(step, end, -1)
    stays = np.cumsum(step)[:-1] == 0
    touched = set(text.tolist())
    collapsed = []
    for t, words in enumerate(texts):
        if t in touched:
            words = [w for w, stay in zip(words, stays[bounds[t]:bounds[t + 1]].tolist()) if stay]
        collapsed.append(b" ".join(words).decode())
    offsets = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
    kind = schema.field("runs").type
    runs = pa.StructArray.from_arrays([pa.array(start - bounds[text]), pa.array(end - start), pa.array(period)], fields=list(kind.value_type))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes),
                                       pa.ListArray.from_arrays(pa.array(offsets), runs, type=kind), pa.array(collapsed, pa.string())], schema=schema)


def _groups(batches: Iterable[pa.RecordBatch], group_words: int) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Rows of ``batches``, some ``group_words`` words at a time; a longer text is a group of its own."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = (text.as_py() or "").encode().split()  # bytes are split at the six ASCII spaces alone
            if texts and held + len(words) > group_words:
                yield ids, texts
                ids, texts, held = [], [], 0
            ids.append(i)
            texts.append(words)
            held += len(words)
    if texts:
        yield ids, texts


def _find(group_words: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.int64()
        fields = [pa.field(c, whole) for c in ("start", "length", "period")]
        schema = pa.schema([("doc_id", whole), ("n_words", whole), ("runs", pa.list_(pa.struct(fields))), ("collapsed", pa.string())])
        for ids, texts in _groups(batches, group_words):
            yield _scan(ids, texts, schema)
    return find


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_words: int = GROUP_WORDS) -> DataFrame:
    """One row per input row: doc_id, n_words, runs (start, length, period; sorted by start, then
    period), and collapsed, the words joined by one space without what repeats: a word goes if a run
    holds it after that run's first period.

    Words are what stands between spaces, tabs, line feeds, vertical tabs, form feeds and returns, and
    are compared exactly. A null or empty text has no words, no runs and an empty ``collapsed``. Null
    and repeated ids are rows of their own, and equal texts get equal results; no run is preferred over
    another, so there are no ties. Texts of any length are searched whole, for all periods up to a
    quarter of their words. Other columns are ignored. An empty table gives no rows.
    """
    ship(df.sparkSession)
    return (df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(_find(group_words), _OUT))
