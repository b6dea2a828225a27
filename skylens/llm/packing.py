"""Cost-balanced packing of tokenised documents into sequences of a fixed number of tokens.

The cost of a piece of n tokens is ``n + QUADRATIC * n * n`` (linear layers plus attention). Pieces
are taken in descending length and each goes to the sequence of lowest cost that still has room;
whatever fits nowhere is cut to fill the sequences with the least cost first. What is left for a
last, part-filled sequence is cut to lengths that are powers of two, which aren't padded.

Scale: a task streams over its rows and packs groups of ``GROUP_TOKENS`` tokens as they fill, so
there is no shuffle, memory is bounded (one group and one document), a lost task is run again on
its own rows, and a group of copies or a hot source makes no task larger than another.
"""

from __future__ import annotations

import base64
import functools
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from skylens.llm import spans
from skylens.llm.common import ship

CAPACITY = 1024
QUADRATIC = 1 / 2048
GROUP_TOKENS = 2_000_000
END_ID = 0
SPECIAL = b"<|endoftext|>"
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_tokens long, sequence_cost double")
#: Second bytes from the end, of two-byte letters of Latin scripts: before white space, a cut after them is safe.
_LATIN = np.zeros(256, bool)
_LATIN[[0xC3, 0xC4, 0xC5]] = True


@functools.lru_cache(maxsize=4)
def tokenizer(name: str):
    """The tokenizer file's own library, and the same vocabulary as ranks for bulk encoding."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path(name + ".json"))
    with open(public_tokenizers.path(name + ".tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    bulk = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    sizes[list(ranks.values())] = [len(x) for x in ranks]
    return exact, bulk, sizes


def _cuts(buf: np.ndarray) -> np.ndarray:
    """Where a pre-token always begins: at ASCII white space just after what surely isn't white space."""
    at = np.flatnonzero((buf == 0x20) | (buf - np.uint8(9) < 5))
    at = at[at > 1]
    before, before2 = buf[at - 1], buf[at - 2]
    return at[(before > 0x20) & (before < 0x7F) | (before >= 0x80) & _LATIN[before2]]


@functools.lru_cache(maxsize=4)
def _known(name: str) -> spans.Known:
    return spans.Known()


def encode_batch(texts: list[bytes], name: str = "byte_bpe_50k") -> list[np.ndarray]:
    """The tokenizer's ids of each text (special tokens in a text included), each different unit encoded once.

    Texts are cut into units that the tokenizer's pre-token rule can't join; equal units have equal
    ids, so only different ones are encoded. Texts with the special token's string, or that end in
    white space (whose ids depend on the end of the text), go through the tokenizer's own library.
    """
    exact, bulk, sizes = tokenizer(name)
    out: list[np.ndarray | None] = [None] * len(texts)
    plain = []
    for i, t in enumerate(texts):
        if SPECIAL in t:
            out[i] = np.array(exact.encode(t.decode("utf-8"), add_special_tokens=False).ids, np.uint32)
        elif not t or t.decode("utf-8")[-1].isspace() or t[:1].isspace():
            out[i] = np.array(bulk.encode_ordinary(t.decode("utf-8")), np.uint32)
        else:
            plain.append(i)
    if not plain:
        return out
    buf, begins = spans.join_texts([texts[i] for i in plain])
    first = np.zeros(len(buf) + 1, bool)
    first[_cuts(buf)] = True
    ends_of_text = np.concatenate([begins[1:], [len(buf)]]) - 1
    first[ends_of_text] = False
    first[begins] = True
    starts = np.flatnonzero(first[:-1])
    ends = np.concatenate([starts[1:], [len(buf)]])
    last = np.searchsorted(starts, begins[1:]) - 1 if len(begins) > 1 else np.array([], np.int64)
    ends[last] -= 1  # the joining line feed belongs to no text
    ends[-1] -= 1
    # a unit that begins a text differs from the same bytes after white space only by its first byte
    unique, at, which = np.unique(spans.hashes(buf, starts, ends), return_index=True, return_inverse=True)
    known = _known(name)
    new = known.missing(unique)
    if len(new):
        raw, spaced = buf.tobytes(), spans._SPACE[buf[starts[at[new]]]]
        units = [raw[a:b] for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist())]
        # units after white space are encoded in one run, first units of texts one by one
        alone = [bulk.encode_ordinary(u.decode("utf-8")) for u, s in zip(units, spaced) if not s]
        lengths = np.zeros(len(new), np.int64)
        lengths[~spaced] = [len(x) for x in alone]
        order, flat = np.flatnonzero(~spaced), [np.array(x, np.uint32) for x in alone]
        if spaced.any():
            ids = np.array(bulk.encode_ordinary(b"".join([u for u, s in zip(units, spaced) if s]).decode("utf-8")), np.uint32)
            ids_end, unit_end = np.cumsum(sizes[ids]), np.cumsum((ends - starts)[at[new[spaced]]])
            to = np.searchsorted(ids_end, unit_end, "right")
            if not np.array_equal(ids_end[to - 1], unit_end):
                raise ValueError("a token crosses a cut")
            lengths[spaced] = np.diff(to, prepend=0)
            order, flat = np.concatenate([order, np.flatnonzero(spaced)]), [*flat, ids]
        known.add(unique[new[order]], lengths[order], np.concatenate(flat))
    offsets, lengths = known.at(unique)
    n = lengths[which]
    ends_flat, all_ids = np.cumsum(n), spans.ragged(known.flat, offsets[which], n)
    of_text = np.concatenate([[0], ends_flat])[np.concatenate([np.searchsorted(starts, begins), [len(starts)]])]
    for k, i in enumerate(plain):
        out[i] = all_ids[of_text[k]:of_text[k + 1]]
    return out


def cost(n):
    return n + QUADRATIC * n * n


def assign(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (piece, from, to) for pieces of 1 to ``capacity`` tokens; only the last ones aren't full.

    ``sum(lengths) // capacity`` sequences are filled by descending length and lowest cost; pieces
    that fit nowhere are cut into the room that is left, then into sequences of a power of two.
    """
    count = sum(lengths) // capacity
    sequences: list[list[tuple[int, int, int]]] = [[] for _ in range(count)]
    room = [capacity] * count
    heap = [(0.0, s) for s in range(count)]
    left = []
    for piece in sorted(range(len(lengths)), key=lambda p: (-lengths[p], p)):
        n, passed = lengths[piece], []
        while heap and room[heap[0][1]] < n:
            passed.append(heapq.heappop(heap))
        if heap:
            spent, s = heapq.heappop(heap)
            sequences[s].append((piece, 0, n))
            room[s] -= n
            if room[s]:
                heapq.heappush(heap, (spent + cost(n), s))
        else:
            left.append(piece)
        for x in passed:
            heapq.heappush(heap, x)
    open_ones, k = [s for _, s in sorted(heap)], 0
    rest = []
    for piece in left:
        at, n = 0, lengths[piece]
        while at < n and k < len(open_ones):
            s = open_ones[k]
            take = min(room[s], n - at)
            sequences[s].append((piece, at, at + take))
            room[s] -= take
            at += take
            k += room[s] == 0
        if at < n:
            rest.append((piece, at, n))
    total = sum(b - a for _, a, b in rest)
    for bit in reversed(range(total.bit_length())):
        if total >> bit & 1:
            need, sequence = 1 << bit, []
            while need:
                piece, a, b = rest.pop(0)
                take = min(need, b - a)
                sequence.append((piece, a, a + take))
                need -= take
                if a + take < b:
                    rest.insert(0, (piece, a + take, b))
            sequences.append(sequence)
    return sequences


def _packed(group: list[tuple[int | None, np.ndarray]], base: int, capacity: int) -> tuple[list[tuple], int]:
    """Rows of one group: whole sequences cut off long documents first, then the assigned rest."""
    rows, used, pieces = [], base, []
    one = lambda doc, ids, a, b, seq, at, size, c: (doc, a, b - a, zlib.crc32(ids[a:b].astype("<u4").tobytes()), len(ids), seq, at, size, c)
    for doc, ids in group:
        whole = len(ids) // capacity * capacity
        for a in range(0, whole, capacity):
            rows.append(one(doc, ids, a, a + capacity, used, 0, capacity, cost(capacity)))
            used += 1
        if whole < len(ids):
            pieces.append((doc, ids, whole))
    for sequence in assign([len(ids) - whole for _, ids, whole in pieces], capacity):
        size, spent, at = sum(b - a for _, a, b in sequence), sum(cost(b - a) for _, a, b in sequence), 0
        for p, a, b in sequence:
            doc, ids, whole = pieces[p]
            rows.append(one(doc, ids, whole + a, whole + b, used, at, size, spent))
            at += b - a
        used += 1
    return rows, used


def _pack_task(capacity: int, group_tokens: int, name: str):
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    types = [pa.float64() if c == "sequence_cost" else pa.int64() for c in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, group, tokens = TaskContext.get().partitionId() << 40, [], 0

        def flush():
            rows, after = _packed(group, used, capacity)
            columns = list(zip(*rows)) or [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names), after

        for part, texts in spans.slices(batches, "text", 1 << 22):
            for doc, ids in zip(part.column("doc_id").to_pylist(), encode_batch(texts, name)):
                ids = np.append(ids, np.uint32(END_ID)).astype(np.uint32)
                group.append((doc, ids))
                tokens += len(ids)
                if tokens >= group_tokens:
                    out, used = flush()
                    group, tokens = [], 0
                    yield out
        if group:
            yield flush()[0]

    return run


def pack_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   group_tokens: int = GROUP_TOKENS, name: str = "byte_bpe_50k") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and its
    sequence's tokens and cost. ``capacity`` must be a power of two.

    Null and empty text is the end id alone. A null or repeated id is packed like any other row and
    stays as it is. Texts of any length are encoded whole; other columns are ignored; an empty table
    gives no rows. Sequence ids are unique and don't run on without gaps.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    ship(df.sparkSession)
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_pack_task(capacity, group_tokens, name), SCHEMA)
