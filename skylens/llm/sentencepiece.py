"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie, with byte fallback.

Spaces become the whitespace marker (one goes before the text); the segmentation into pieces with
the largest sum of log scores is found by dynamic programming, its arcs read off a double-array
trie of the pieces' bytes. A character that no piece of its own covers may be spelt in byte pieces,
at a score below all others. No piece has a marker after another character, so a text is cut into
units that each begin with their markers, and equal units are segmented once.

Inside, the marker is the byte 0xFF, which UTF-8 never uses; a marker character that is itself part
of a text is therefore spelt in bytes, and every text comes back exactly.

Scale: one pass over the rows, vectorised over the different units of a few megabytes of text; the
trie (some hundred thousand integers, bounded by the vocabulary file) is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skylens.llm import spans
from skylens.llm.common import ROW, keyed

MARK, SPACE = 0xFF, 0x20
MARKER = "▁"
UNK_PENALTY = 10.0
NEVER = -1e8  # pieces with scores from here down are not to be merged
LONGEST = 64  # bytes of units that are segmented side by side; longer ones go one by one
_CHAR = np.ones(256, np.int64)
_CHAR[0xC0:0xE0], _CHAR[0xE0:0xF0], _CHAR[0xF0:0xF8] = 2, 3, 4


def double_array(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, value) of a trie: from state s byte c leads to t = base[s] + c if check[t] = s.

    ``value`` is the number of the key that ends in a state, or -1. States are placed level by level
    at the first base where all their children find free cells.
    """
    order = sorted(range(len(keys)), key=lambda i: keys[i])
    size = 1 << 20
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    used = np.zeros(size, bool)
    used[0], low, near = True, 1, 1
    level = [(0, 0, len(order), 0)]  # state, range of keys, depth
    while level:
        open_states = []
        for state, a, b, depth in level:
            while a < b and len(keys[order[a]]) == depth:
                value[state] = order[a]
                a += 1
            firsts, bounds = [], []
            for i in range(a, b):
                c = keys[order[i]][depth]
                if not firsts or firsts[-1] != c:
                    firsts.append(c)
                    bounds.append(i)
            if firsts:
                open_states.append((state, firsts, [*bounds, b], depth))
        level = []
        # states with several children first; single children then fill the gaps
        for state, firsts, bounds, depth in sorted(open_states, key=lambda x: -len(x[1])):
            if max(low, near) + 2048 > len(used):
                base, check, value = (np.concatenate([x, np.full(size, f, np.int32)]) for x, f in ((base, 0), (check, -1), (value, -1)))
                used = np.concatenate([used, np.zeros(size, bool)])
            if len(firsts) == 1:
                while used[low] or low <= firsts[0]:
                    low += 1
                at = low - firsts[0]
            else:
                cells = np.array(firsts)
                while (fits := np.flatnonzero(~used[np.arange(near, near + 256)[:, None] + cells].any(axis=1))).size == 0:
                    near += 128
                at = near + int(fits[0])
            base[state] = at
            for c, x, y in zip(firsts, bounds[:-1], bounds[1:]):
                used[at + c], check[at + c] = True, state
                level.append((at + c, x, y, depth + 1))
    top = int(np.flatnonzero(used)[-1]) + 257
    return base[:top].copy(), np.pad(check, (0, 512), constant_values=-1)[:top].copy(), value[:top].copy()


@dataclass
class Pieces:
    """A vocabulary: the trie of its pieces, their ids and log scores, and the bytes of every id."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    unk: float
    byte_ids: np.ndarray
    flat: np.ndarray
    offsets: np.ndarray
    lengths: np.ndarray
    known: spans.Known = field(default_factory=spans.Known)

    def __getstate__(self):
        return {**self.__dict__, "known": spans.Known()}

    @classmethod
    def of(cls, pieces: dict[int, tuple[str, float]], byte_ids: dict[int, int], size: int) -> Pieces:
        """``pieces``: id -> (piece, log score); ``byte_ids``: byte -> id, all 256; ``size``: number of ids."""
        if len(byte_ids) != 256:
            raise ValueError("byte fallback needs a piece for every byte")
        ids = sorted(pieces)
        keys = [b"\xff".join(p.encode() for p in pieces[i][0].split(MARKER)) for i in ids]
        if any(b"\xff" in k.lstrip(b"\xff") for k in keys):
            raise ValueError("a piece has a marker after another character")
        spelt = [b""] * size
        for i, k in zip(ids, keys):
            spelt[i] = k.replace(b"\xff", b" ")
        for b, i in byte_ids.items():
            spelt[i] = bytes([b])
        lengths = np.array([len(x) for x in spelt], np.int64)
        scores = np.array([pieces[i][1] for i in ids], np.float64)
        return cls(*double_array(keys), np.array(ids, np.int32), scores, float(scores.min()) - UNK_PENALTY, np.array([byte_ids[b] for b in range(256)], np.int32),
                   np.frombuffer(b"".join(spelt), np.uint8), np.cumsum(lengths) - lengths, lengths)

    def _relax(self, u: np.ndarray, sizes: np.ndarray):
        """Best score and last piece (-2: spelt in bytes) up to each byte of each row of ``u``."""
        n, width = u.shape
        best, piece, back = np.full((n, width + 5), -np.inf), np.full((n, width + 5), -1, np.int32), np.zeros((n, width + 5), np.int16 if width < 32000 else np.int64)
        best[:, 0] = 0
        for i in range(width):
            rows = np.flatnonzero((best[:, i] > -np.inf) & (sizes > i))
            if not len(rows):
                continue
            size, here = _CHAR[u[rows, i]], best[rows, i]
            alone = np.zeros(len(rows), bool)
            live, state, j = np.arange(len(rows)), np.zeros(len(rows), np.int64), i
            while len(live) and j < width:
                to = self.base[state] + u[rows[live], j]
                hit = (self.check[to] == state) & (sizes[rows[live]] > j)
                live, state = live[hit], to[hit]
                j += 1
                v = self.value[state]
                ends = np.flatnonzero(v >= 0)
                if len(ends):
                    of, got = live[ends], v[ends]
                    alone[of] |= size[of] == j - i
                    self._better(best, piece, back, rows[of], j, here[of] + self.scores[got], got, i)
            rest = np.flatnonzero(~alone)
            for s in np.unique(size[rest]):
                of = rest[size[rest] == s]
                self._better(best, piece, back, rows[of], i + int(s), here[of] + self.unk, np.full(len(of), -2, np.int32), i)
        return best, piece, back

    @staticmethod
    def _better(best, piece, back, rows, j, score, got, i):
        more = score > best[rows, j]
        rows = rows[more]
        best[rows, j], piece[rows, j], back[rows, j] = score[more], got[more], i

    def _segment(self, u: np.ndarray, sizes: np.ndarray):
        """Ids of all rows joined, how many each row has, and each row's score."""
        best, piece, back = self._relax(u, sizes)
        out = np.full(u.shape, -1, np.int32)
        at, rows = sizes.copy(), np.arange(len(u))
        while len(rows):
            got, start = piece[rows, at[rows]], back[rows, at[rows]].astype(np.int64)
            normal = got >= 0
            out[rows[normal], start[normal]] = self.ids[got[normal]]
            for r, s in zip(rows[~normal], start[~normal]):
                out[r, s:at[r]] = self.byte_ids[u[r, s:at[r]]]
            at[rows] = start
            rows = rows[start > 0]
        return out[out >= 0], (out >= 0).sum(axis=1), best[np.arange(len(u)), sizes]

    def encode(self, texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids and log score of each text; an empty text has none, and score 0."""
        full = [i for i, t in enumerate(texts) if t]
        out, score = [np.empty(0, np.int32)] * len(texts), np.zeros(len(texts))
        if not full:
            return out, score
        buf = np.frombuffer(b"".join(b"\xff" + texts[i].replace(b" ", b"\xff") for i in full), np.uint8)
        begins = np.cumsum([0] + [len(texts[i]) + 1 for i in full])[:-1]
        first = buf == MARK
        first[1:] &= buf[:-1] != MARK
        first[begins] = True
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(buf))
        unique, where, which = np.unique(spans.hashes(buf, starts, ends), return_index=True, return_inverse=True)
        new = self.known.missing(unique)
        if len(new):
            a, n = starts[where[new]], (ends - starts)[where[new]]
            order, flats, counts, scores = [], [], [], []
            for low, high in ((0, 4), (4, 8), (8, 12), (12, 16), (16, 24), (24, 40), (40, LONGEST)):
                for part in np.array_split(rows := np.flatnonzero((n > low) & (n <= high)), max(1, len(rows) // 20_000 + 1)):
                    if len(part):
                        at = a[part][:, None] + np.arange(high)
                        u = np.where(np.arange(high) < n[part][:, None], buf[np.minimum(at, len(buf) - 1)], 0)
                        for held, x in zip((flats, counts, scores), self._segment(u, n[part])):
                            held.append(x)
                        order.append(part)
            for part in np.flatnonzero(n > LONGEST):
                for held, x in zip((flats, counts, scores), self._long(buf[a[part]:a[part] + n[part]])):
                    held.append(x)
                order.append([part])
            order = np.concatenate(order)
            # a unit's score travels as two more cells behind its ids
            ids, count, value = np.concatenate(flats), np.concatenate(counts), np.concatenate(scores)
            cells = np.insert(ids, np.repeat(np.cumsum(count), 2), value.view(np.int32))
            self.known.add(unique[new[order]], count + 2, cells.view(np.uint32))
        offsets, lengths = self.known.at(unique)
        value = spans.ragged(self.known.flat, offsets + lengths - 2, np.full(len(offsets), 2)).view(np.float64)
        n = lengths[which] - 2
        ids, ends_flat = spans.ragged(self.known.flat, offsets[which], n).view(np.int32), np.cumsum(n)
        unit = np.searchsorted(starts, begins)
        of_text = np.append(np.concatenate([[0], ends_flat])[unit], len(ids))
        score[full] = np.add.reduceat(value[which], unit)
        for k, i in enumerate(full):
            out[i] = ids[of_text[k]:of_text[k + 1]]
        return out, score

    def _long(self, u: np.ndarray):
        """One unit of any length, byte by byte."""
        best, back, piece = np.full(len(u) + 5, -np.inf), np.zeros(len(u) + 5, np.int64), np.full(len(u) + 5, -2, np.int64)
        best[0] = 0.0
        base, check, value, scores, data = self.base, self.check, self.value, self.scores, u.tolist()
        for i in range(len(u)):
            if best[i] == -np.inf:
                continue
            size, alone, state = int(_CHAR[data[i]]), False, 0
            for j in range(i, len(u)):
                to = base[state] + data[j]
                if check[to] != state:
                    break
                state = to
                if value[state] >= 0:
                    alone |= j + 1 - i == size
                    if best[i] + scores[value[state]] > best[j + 1]:
                        best[j + 1], back[j + 1], piece[j + 1] = best[i] + scores[value[state]], i, value[state]
            if not alone and best[i] + self.unk > best[i + size]:
                best[i + size], back[i + size], piece[i + size] = best[i] + self.unk, i, -2
        out, at = [], len(u)
        while at:
            out += [self.ids[piece[at]]] if piece[at] >= 0 else self.byte_ids[u[back[at]:at]][::-1].tolist()
            at = back[at]
        return np.array(out[::-1], np.int32), np.array([len(out)]), np.array([best[len(u)]])

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that ``ids`` spell, without the marker before the text; other ids spell nothing."""
        ids = ids[(ids >= 0) & (ids < len(self.lengths))]
        out = spans.ragged(self.flat, self.offsets[ids], self.lengths[ids]).tobytes()
        return out[1:] if out[:1] == b" " else out


def load(path: str) -> Pieces:
    """A SentencePiece file's normal pieces and byte pieces.

    A file trained by merges holds ranks in place of log scores (integers from 0 down); these become
    log scores by Zipf's law, -log(rank + 2) less the log of their sum. Control pieces are left out,
    and so are longer pieces that are scored as never to be merged; such single characters rank last.
    """
    import sentencepiece as library

    model = library.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    byte_ids = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
    special = lambda i: model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
    normal = [i for i in range(size) if not special(i) and (model.get_score(i) > NEVER or len(model.id_to_piece(i)) == 1)]
    scores = np.array([model.get_score(i) for i in normal], np.float64)
    scores[scores <= NEVER] = scores[scores > NEVER].min() - 1
    if (scores == np.round(scores)).all():
        weight = 1 / (2.0 - scores)
        scores = np.log(weight / weight.sum())
    return Pieces.of({i: (model.id_to_piece(i), s) for i, s in zip(normal, scores.tolist())}, byte_ids, size)


def encode_documents(df: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: _row, doc_id, ids, n_tokens, n_bytes (byte pieces), log_score, restored.

    ``restored`` tells that decoding gives the very text. Null and empty texts have no ids. Null and
    repeated ids are rows of their own; texts of any length are encoded whole; other columns are
    ignored; an empty table gives no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        is_byte = np.zeros(len(own.lengths), bool)
        is_byte[own.byte_ids] = True
        for part, texts in spans.slices(batches, "text", 1 << 22):
            ids, score = own.encode(texts)
            yield pa.RecordBatch.from_arrays([
                part.column(ROW), part.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array([len(x) for x in ids], pa.int64()),
                pa.array([int(is_byte[x].sum()) for x in ids], pa.int64()), pa.array(score),
                pa.array([own.decode(x) == t for x, t in zip(ids, texts)])], names=[ROW, "doc_id", "ids", "n_tokens", "n_bytes", "log_score", "restored"])

    return keyed(df, id_col, text_col).mapInArrow(run, f"{ROW} long, doc_id long, ids array<int>, n_tokens long, n_bytes long, log_score double, restored boolean")


def decode_documents(df: DataFrame, pieces: Pieces, ids_col: str = "ids") -> DataFrame:
    """``df`` with one more column, ``decoded``; null ids give null, bytes that aren't UTF-8 the replacement character."""
    shared = df.sparkSession.sparkContext.broadcast(pieces)

    @F.pandas_udf("string")
    def decoded(ids):
        return ids.map(lambda x: None if x is None else shared.value.decode(np.asarray([i for i in x if i is not None], np.int64)).decode("utf-8", "replace"))

    return df.withColumn("decoded", decoded(F.col(ids_col)))
