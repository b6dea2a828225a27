"""Gated recurrent language model with class-factored output, trained by truncated backpropagation.

Tokens are words and one end token per document. The most frequent words have classes of equal
size and a softmax each; all other words belong to a class by their last two bytes and share its
mass by smoothed corpus counts, one share kept for words never seen. The recurrent state goes from
window to window, so a document's log-likelihood is that of the whole text.

Counts, N, V and class masses come from all training documents, and so do weights: trainers on the
executors start from the same weights, stream over their own documents, and their weights are averaged
by tokens, ``ROUNDS`` times. Averages are taken on the executors, ``MERGED`` at a time; the driver
holds one set of weights and a head of ``HEAD`` words.

Scale: every pass streams over its rows. Words beyond the head are joined with their counts by a
shuffle; none of those is frequent, so no key is hot.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from skylens.llm import spans
from skylens.llm.common import ROW, keyed, written
from skylens.llm.toxicity import fold

HEAD = 100_000
HIDDEN, HEAD_CLASSES, CLASS_WORDS, TAIL_CLASSES = 24, 16, 64, 32
DOCS_EACH, FEW_TRAINERS, MOST_DOCS_EACH, MERGED, ROUNDS = 500, 16, 10_000, 16, 2
LANES, TRAIN_LANES, WINDOW = 512, 48, 24
FLUSH_TOKENS, LONG = 1_000_000, 4096  # tokens scored side by side; longer documents are gathered apart
OUTPUT_ROWS = 2048  # outputs of so many tokens stay in a core's cache
END = np.uint64(0)  # the end token's hash
SHORT = HEAD_CLASSES * CLASS_WORDS  # words with a softmax of their own; the end token is the first
RATE, CLIP = 0.08, 5.0


def tail_class(buf: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Class of a word beyond the short list: by its last two bytes."""
    last, before = buf[ends - 1].astype(np.int64), buf[np.maximum(ends - 2, 0)].astype(np.int64)
    return (last * 31 + before * 7) % TAIL_CLASSES


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and tail class of every token of the texts in order, and each text's number of tokens."""
    buf, begins = spans.join_texts(texts)
    buf = spans.lowered(buf)
    starts, ends = spans.words(buf)
    word = np.maximum(spans.hashes(buf, starts, ends), np.uint64(1))
    counts = np.diff(np.append(np.searchsorted(starts, begins), len(starts)))
    after = np.cumsum(counts)
    return (np.insert(word, after, END), np.insert(tail_class(buf, ends), after, 0), counts + 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts (h, class, c), merged in the task while they are few."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def merged():
        h, k, c = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(h, kind="stable")
        h, k, c = h[order], k[order], c[order]
        at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        return h[at], k[at], np.add.reduceat(c, at)

    def out(x):
        return pa.RecordBatch.from_arrays([pa.array(x[0].view(np.int64)), pa.array(x[1]), pa.array(x[2])], names=["h", "class", "c"])

    for _, texts in spans.slices(batches, "text", 1 << 22):
        h, k, _ = tokens(texts)
        unique, at, c = np.unique(h, return_index=True, return_counts=True)
        held.append((unique, k[at], c.astype(np.int64)))
        size += len(unique)
        if size > 1_000_000:
            held = [merged()]
            size = len(held[0][0])
            if size > 700_000:
                yield out(held[0])
                held, size = [], 0
    if held:
        yield out(merged())


class Vocabulary:
    """The head: hashes of the most frequent tokens, their counts, and their numbers by frequency."""

    def __init__(self, h: np.ndarray, c: np.ndarray, n: int, v: int, mass: np.ndarray):
        # the end token is number 0; the others follow by frequency
        order = np.argsort(h)
        self.h, self.c, self.rank = h[order], c[order], order
        self.n, self.v, self.mass = n, v, mass

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (-1 beyond the head) and training count (0 there) of each hash."""
        if not len(self.h):
            return np.full(len(h), -1), np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        hit = self.h[at] == h
        return np.where(hit, self.rank[at], -1), np.where(hit, self.c[at], 0)


class Network:
    """A gated recurrent network; inputs are looked up as ready sums for its three gates."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        self.w = {
            "inputs": small(SHORT + TAIL_CLASSES, 3 * HIDDEN), "gates": small(HIDDEN, 2 * HIDDEN), "new": small(HIDDEN, HIDDEN),
            "classes": small(HIDDEN, HEAD_CLASSES + TAIL_CLASSES), "class_bias": np.zeros(HEAD_CLASSES + TAIL_CLASSES, np.float32),
            "words": small(HEAD_CLASSES, HIDDEN, CLASS_WORDS), "word_bias": np.zeros((HEAD_CLASSES, CLASS_WORDS), np.float32),
        }
        self.squares = {k: np.full_like(x, 1e-3) for k, x in self.w.items()}

    def start_from(self, vocabulary: Vocabulary):
        """Output biases at the corpus frequencies, so that an untrained network scores like counts."""
        by_rank = np.zeros(SHORT)
        ranked = vocabulary.rank < SHORT
        by_rank[vocabulary.rank[ranked]] = vocabulary.c[ranked]
        words = np.log(by_rank.reshape(HEAD_CLASSES, CLASS_WORDS) + 0.5)
        self.w["word_bias"][:] = words
        total = np.concatenate([(by_rank + 0.5).reshape(HEAD_CLASSES, CLASS_WORDS).sum(axis=1), vocabulary.mass])
        self.w["class_bias"][:] = np.log(total / total.sum())

    def ready(self) -> tuple[np.ndarray, np.ndarray]:
        """Input sums by token and the joined recurrent matrix, the gates' part of both halved for ``tanh``."""
        table, joined = self.w["inputs"].copy(), np.concatenate([self.w["gates"], self.w["new"]], axis=1)
        for x in (table, joined):
            x[:, :2 * HIDDEN] *= 0.5
        return table, joined

    def step(self, h: np.ndarray, x: np.ndarray, ended: np.ndarray):
        """One token on every lane; the state before an end token's successor is zero."""
        table, joined = self.ready()
        return [a.T for a in _step(h.T, table[x].T, ~ended, joined.T)]

    def output(self, h: np.ndarray, y: np.ndarray, grad: bool = False):
        """Natural log probability of each target (class of tail words only), and gradients; a row of ``h`` for each."""
        logp, d_h, grads = self.outputs(np.ascontiguousarray(h.T), y, grad)
        return logp, d_h if d_h is None else d_h.T, grads

    def outputs(self, h: np.ndarray, y: np.ndarray, grad: bool = False):
        """``output`` with a column of ``h`` for each target."""
        k = np.where(y < SHORT, y // CLASS_WORDS, y - SHORT + HEAD_CLASSES)
        most = np.abs(h).max()  # no logit is further from zero than its weights allow
        far = lambda w, axis, bias: most * np.abs(w).sum(axis=axis).max() + np.abs(bias).max() > 60
        d = self.w["classes"].T @ h
        d += self.w["class_bias"][:, None]
        logp = _softmax(d, k, grad, far(self.w["classes"], 0, self.w["class_bias"]))
        order = np.argsort(k.astype(np.int8), kind="stable")
        bounds = np.searchsorted(k[order], np.arange(HEAD_CLASSES + 1)).tolist()
        order = order[:bounds[-1]]
        own, word = np.take(h, order, axis=1), y[order] % CLASS_WORDS
        d_word = np.empty((CLASS_WORDS, len(order)), d.dtype)
        held = [(c, slice(*x)) for c, x in enumerate(zip(bounds[:-1], bounds[1:])) if x[0] < x[1]]
        for c, at in held:
            np.matmul(self.w["words"][c].T, own[:, at], out=d_word[:, at])
        d_word += np.repeat(self.w["word_bias"].T, np.diff(bounds), axis=1)
        logp[order] += _softmax(d_word, word, grad, far(self.w["words"], 1, self.w["word_bias"]))
        if not grad:
            return logp, None, {}
        ones = np.ones(d.shape[1], d.dtype)
        grads = {"classes": h @ d.T, "class_bias": d @ ones, "words": np.zeros_like(self.w["words"]), "word_bias": np.zeros_like(self.w["word_bias"])}
        d_h, d_own = self.w["classes"] @ d, np.empty_like(own)
        for c, at in held:
            np.matmul(own[:, at], d_word[:, at].T, out=grads["words"][c])
            np.matmul(d_word[:, at], ones[at], out=grads["word_bias"][c])
            np.matmul(self.w["words"][c], d_word[:, at], out=d_own[:, at])
        d_h[:, order] += d_own
        return logp, d_h, grads

    def train_window(self, h: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Backpropagation within one window (steps, lanes); gives the state that goes on.

        Arrays hold a row for each unit, so that those of one gate lie together and a step's sums of all lanes are one run of memory.
        """
        steps, width, n, dtype = *x.shape, x.size, self.w["inputs"].dtype
        table, joined = self.ready()
        joined = joined.T.copy()
        sums, going = np.ascontiguousarray(table[x].transpose(0, 2, 1)), (x != 0)[:, None].astype(dtype)
        before, new, out = (np.empty((steps, HIDDEN, width), dtype) for _ in range(3))
        moved, gates = np.empty_like(sums), np.empty((steps, 2 * HIDDEN, width), dtype)
        h = h.T
        for t in range(steps):
            h = _step(h, sums[t], going[t], joined, (before[t], moved[t], gates[t], new[t], out[t]))[-1]
        _, d_out, grads = self.outputs(out.transpose(1, 0, 2).reshape(HIDDEN, n), y.ravel(), grad=True)
        d_out = np.ascontiguousarray(d_out.reshape(HIDDEN, steps, width).transpose(1, 0, 2))
        # what a step's change of the state does to its sums, for all steps at once
        r, z = gates[:, :HIDDEN], gates[:, HIDDEN:]
        to_new = (1 - z) * (1 - new * new)
        to_z = (before - new) * z * (1 - z)
        to_r = moved[:, 2 * HIDDEN:] * r * (1 - r)
        back = np.concatenate([self.w["gates"], self.w["new"]], axis=1)
        d_sums, d_new, d_h, carried = moved, to_new, np.zeros((HIDDEN, width), dtype), np.empty((HIDDEN, width), dtype)
        for t in reversed(range(steps)):
            d_h += d_out[t]
            np.multiply(d_h, to_new[t], out=d_new[t])
            own = d_sums[t]
            np.multiply(d_new[t], to_r[t], out=own[:HIDDEN])
            np.multiply(d_h, to_z[t], out=own[HIDDEN:2 * HIDDEN])
            np.multiply(d_new[t], r[t], out=own[2 * HIDDEN:])
            d_h *= z[t]
            d_h += np.matmul(back, own, out=carried)
            d_h *= going[t]
        by_row = lambda a: a.transpose(0, 2, 1).reshape(n, -1)
        d_rows = by_row(d_sums)
        recurrent = by_row(before).T @ d_rows
        grads |= {"gates": recurrent[:, :2 * HIDDEN], "new": recurrent[:, 2 * HIDDEN:]}
        d_rows[:, 2 * HIDDEN:] = by_row(d_new)
        flat = x.ravel().astype(np.int16)
        order = np.argsort(flat, kind="stable")
        heads = np.flatnonzero(np.concatenate([[True], np.diff(flat[order]) != 0]))
        rows = flat[order][heads]
        scale = 1.0 / max(1.0, math.sqrt(flat.size))
        self._move("inputs", np.add.reduceat(d_rows[order], heads, axis=0) * scale, rows)
        for name, g in grads.items():
            self._move(name, g * scale)
        return h.T

    def _move(self, name: str, g: np.ndarray, rows=slice(None)):
        np.minimum(np.maximum(g, -CLIP, out=g), CLIP, out=g)
        squares = self.squares[name][rows]
        squares += g * g
        if not isinstance(rows, slice):  # else they are the held ones
            self.squares[name][rows] = squares
        g *= RATE
        g /= np.sqrt(squares)
        self.w[name][rows] -= g


def _step(h: np.ndarray, sums: np.ndarray, going: np.ndarray, joined: np.ndarray, into=(None,) * 5):
    """State before, recurrent sums, both gates, new state and state after one token, written ``into`` given arrays;
    a column for each lane, ``sums`` and ``joined`` transposed from ``Network.ready``."""
    before = np.multiply(h, going, out=into[0])
    moved = np.matmul(joined, before, out=into[1])
    gates = np.add(sums[:2 * HIDDEN], moved[:2 * HIDDEN], out=into[2])
    np.tanh(gates, out=gates)
    gates *= 0.5
    gates += 0.5
    new = np.multiply(gates[:HIDDEN], moved[2 * HIDDEN:], out=into[3])
    new += sums[2 * HIDDEN:]
    np.tanh(new, out=new)
    after = np.subtract(before, new, out=into[4])
    after *= gates[HIDDEN:]
    after += new
    return before, moved, gates, new, after


def _softmax(logits: np.ndarray, chosen: np.ndarray, grad: bool, far: bool = True) -> np.ndarray:
    """Natural log probability of each column's chosen row; ``logits`` hold its gradient after, if asked for.
    Those that may be ``far`` from zero are moved to their largest, so that none overflows."""
    if far:
        logits -= logits.max(axis=0)
    at = np.arange(len(chosen))
    own = logits[chosen, at]
    np.exp(logits, out=logits)
    total = np.ones(len(logits), logits.dtype) @ logits
    if grad:
        logits *= 1 / total
        logits[chosen, at] -= 1
    return own - np.log(total)


def lanes(sizes: np.ndarray, most: int) -> list[list[int]]:
    """Documents dealt to lanes of much the same length, longest lane first."""
    import heapq
    heap = [(0, i, []) for i in range(min(most, len(sizes)))]
    for doc in np.argsort(-sizes, kind="stable"):
        length, i, docs = heapq.heappop(heap)
        docs.append(int(doc))
        heapq.heappush(heap, (length + int(sizes[doc]), i, docs))
    return [docs for _, _, docs in sorted(heap, key=lambda x: (-x[0], x[1]))]


def _grids(ids: np.ndarray, sizes: np.ndarray, most: int):
    """Windows (inputs, targets, documents) over lanes; lanes that have ended drop off the right."""
    begins = np.cumsum(sizes) - sizes
    laid = [np.concatenate([np.arange(begins[d], begins[d] + sizes[d]) for d in lane]) for lane in lanes(sizes, most)]
    doc_of = np.repeat(np.arange(len(sizes)), sizes)
    lengths = np.array([len(x) for x in laid])
    for low in range(0, lengths[0], WINDOW):
        live = int(np.searchsorted(-lengths, -low, "left"))
        steps = min(WINDOW, int(lengths[0]) - low)
        grid = np.full((steps, live), -1, np.int64)
        for i in range(live):
            part = laid[i][low:low + steps]
            grid[:len(part), i] = part
        yield grid, doc_of


def number(vocabulary: Vocabulary, h: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The network's number of each token (short list, then tail classes), and training counts of head tokens."""
    rank, c = vocabulary.find(h)
    return np.where((rank >= 0) & (rank < SHORT), rank, SHORT + tail.astype(np.int64)), np.where(rank >= 0, c, -1)


def _train(vocabulary: Vocabulary, weights: dict[str, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network()
        network.w = {k: x.copy() for k, x in weights.items()}
        seen = 0
        for _, texts in spans.slices(batches, "text", 1 << 22):
            h, tail, sizes = tokens(texts)
            ids, _ = number(vocabulary, h, tail)
            state = np.zeros((TRAIN_LANES, HIDDEN), np.float32)
            for grid, _ in _grids(ids, sizes, TRAIN_LANES):
                full = (grid >= 0).all(axis=0)  # lanes that end within this window are left out of training
                width = int(full.sum())
                if not width:
                    break
                grid = grid[:, :width]
                x = np.where(grid == 0, 0, ids[grid - 1])
                state = network.train_window(state[:width], x, ids[grid])
                seen += grid.size
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([seen], pa.int64()), pa.array([pickle.dumps(network.w)], pa.binary())],
                                         names=["part", "tokens", "weights"])

    return run


def _merge(table: pa.Table) -> pa.Table:
    """One set of weights: the average of some trainers' by the tokens that they have seen."""
    table = table.sort_by("part")
    seen, total, w = table["tokens"].to_pylist(), sum(table["tokens"].to_pylist()), {}
    for n, own in zip(seen, table["weights"]):
        for k, x in pickle.loads(own.as_py()).items():
            w[k] = w.get(k, 0) + np.float32(n / total) * x
    return pa.table({"part": pa.array([table["part"][0].as_py() // MERGED], pa.int64()), "tokens": pa.array([total], pa.int64()), "weights": pa.array([pickle.dumps(w)], pa.binary())})


def averaged(learned: DataFrame) -> dict[str, np.ndarray] | None:
    """Average of trainers' weights (part, tokens, weights), taken in a tree; none if no token was seen."""
    learned = written(learned.where("tokens > 0"), "learned")
    while learned.count() > 1:
        learned = written(learned.groupBy(F.expr(f"part div {MERGED}")).applyInArrow(_merge, "part long, tokens long, weights binary"), "merged")
    one = learned.first()
    return pickle.loads(one.weights) if one else None


class Model:
    def __init__(self, vocabulary: Vocabulary, network: Network, counts: DataFrame):
        self.vocabulary, self.network, self.counts = vocabulary, network, counts


def train(docs: DataFrame, head: int = HEAD, rounds: int = ROUNDS) -> Model:
    """Learns from all rows of ``docs`` (_row, doc_id, text); no rows leave a model of the unseen alone."""
    counts = written(docs.select("text").mapInArrow(_count, "h long, class long, c long").groupBy("h")
                     .agg(F.min("class").alias("class"), F.sum("c").alias("c")), "counts")
    n, v = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    # the lowest count (of 64 a doubling, up to some 4,000) from which on at most ``head`` tokens remain
    level, room, cut = F.floor(F.log2("c") * 64), head, 1 << 20
    for r in sorted(counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r.level):
        room -= r.n
        if room < 0:
            break
        cut = r.level
    top = counts.where((level >= cut) | (F.col("h") == 0)).toArrow()
    h, c, tail = (np.asarray(top[name].combine_chunks(), np.int64) if top.num_rows else np.zeros(0, np.int64) for name in ("h", "c", "class"))
    order = np.lexsort((h, -c, h != 0))  # the end token first, then by frequency
    h, c, tail = h[order].view(np.uint64), c[order], tail[order]
    del top
    short = np.bincount(tail[:SHORT], c[:SHORT] + 0.5, TAIL_CLASSES) if len(h) else np.zeros(TAIL_CLASSES)
    mass = np.full(TAIL_CLASSES, 0.5)
    for r in counts.groupBy("class").agg(F.sum(F.col("c") + 0.5).alias("m")).collect():
        mass[r["class"]] += r.m
    vocabulary = Vocabulary(h, c, n or 0, v or 0, np.maximum(mass - short, 0.5))
    short_list = Vocabulary(h[:SHORT], c[:SHORT], vocabulary.n, vocabulary.v, vocabulary.mass)  # all that trainers tell apart
    network = Network()
    network.start_from(vocabulary)
    rows = docs.count() if n else 0
    trainers = max(1, min(FEW_TRAINERS, round(rows / DOCS_EACH)), round(rows / MOST_DOCS_EACH))
    for _ in range(rounds if rows else 0):
        dealt = docs.repartition(trainers, F.xxhash64(ROW)).select("text")
        learned = dealt.mapInArrow(_train(short_list, network.w), "part long, tokens long, weights binary")
        network.w = averaged(learned) or network.w
    return Model(vocabulary, network, counts)


def _score(model_of, out_names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, network = model_of.value
        table, joined = network.ready()
        joined = joined.T.copy()
        pools: dict[bool, list[tuple]] = {False: [], True: []}  # short and long documents
        held = {False: 0, True: 0}
        smooth = math.log10(vocabulary.n + 0.5 * (vocabulary.v + 1))
        log_mass = np.log10(vocabulary.mass)

        def flush(pool):
            rows, docs = (pa.concat_arrays([p[i] for p in pool]) for i in (0, 1))
            h, tail, sizes = (np.concatenate([p[i] for p in pool]) for i in (2, 3, 4))
            ids, c = number(vocabulary, h, tail)
            ids = ids.astype(np.int32)
            doc_of = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
            logp = np.empty(len(h))
            state = np.zeros((HIDDEN, LANES), np.float32)
            for grid, _ in _grids(ids, sizes, LANES):
                state = state[:, :grid.shape[1]]
                full = int((grid >= 0).all(axis=0).sum())
                states, x_of = [], np.where(grid <= 0, 0, ids[grid - 1])
                sums, going = np.ascontiguousarray(table[x_of].transpose(0, 2, 1)), (x_of != 0).astype(np.float32)
                for t in range(len(grid)):
                    live = full + int((grid[t, full:] >= 0).sum())
                    state = _step(state[:, :live], sums[t, :, :live], going[t, :live], joined)[-1]
                    states.append(state)
                at = grid.ravel()[grid.ravel() >= 0]
                states = np.concatenate(states, axis=1)
                for low in range(0, len(at), OUTPUT_ROWS):
                    part = slice(low, low + OUTPUT_ROWS)
                    logp[at[part]] = network.outputs(np.ascontiguousarray(states[:, part]), ids[at[part]])[0]
            logp /= math.log(10)
            beyond = ids >= SHORT  # tail words share their class's mass by counts
            logp[beyond] -= log_mass[tail[beyond]]
            local = c >= 0
            shared = beyond & local
            logp[shared] += np.log10(c[shared] + 0.5)
            score = np.bincount(doc_of, logp, len(sizes))
            base = np.bincount(doc_of, np.where(local, np.log10(np.where(local, c, 0) + 0.5), 0.0), len(sizes)) - sizes * smooth
            known = np.bincount(doc_of, local & (c > 0), len(sizes)).astype(np.int64)
            rest = np.flatnonzero(~local)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(doc_of[rest], minlength=len(sizes)))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(h[rest].view(np.int64)))
            return pa.RecordBatch.from_arrays([rows, docs, pa.array(sizes.astype(np.int64)), pa.array(known), pa.array(base), pa.array(score), lists], names=out_names)

        for part, texts in spans.slices(batches, "text", 1 << 22):
            h, tail, sizes = tokens(texts)
            for far, pool in pools.items():
                chosen = (sizes > LONG) == far
                if chosen.any():
                    own, where = np.repeat(chosen, sizes), pa.array(np.flatnonzero(chosen))
                    pool.append((part.column(ROW).take(where), part.column("doc_id").take(where), h[own], tail[own].astype(np.int8), sizes[chosen]))
                    held[far] += int(own.sum())
                if held[far] >= FLUSH_TOKENS:
                    yield flush(pool)
                    pool.clear()
                    held[far] = 0
        for pool in pools.values():
            if pool:
                yield flush(pool)

    return run


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(_row, doc_id, n_tokens, n_known, train_tokens, base_score, score) for ``docs`` (_row, doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.vocabulary, model.network))
    names = [ROW, "doc_id", "n_tokens", "n_known", "base", "own", "rest"]
    scored = written(docs.mapInArrow(_score(shared, names), f"{ROW} long, doc_id long, n_tokens long, n_known long, base double, own double, rest array<long>"), "scored")
    # words beyond the head: their counts by a join; each weighs the same in both scores
    rest = scored.select(ROW, F.explode("rest").alias("h"))
    found = rest.join(model.counts.select("h", "c"), "h", "left")
    sums = found.groupBy(ROW).agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("more"), F.count("c").alias("also"))
    return (scored.drop("rest").join(sums, ROW, "left")
            .select(ROW, "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("also", F.lit(0))).alias("n_known"),
                    F.lit(model.vocabulary.n).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
                    (F.col("own") + F.coalesce("more", F.lit(0.0))).alias("score")))


def language_model(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: _row, doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null and empty texts are the end token alone. A null id is held out. Repeated rows learn and
    score as often as they occur; texts of any length are scored whole; other columns are ignored;
    an empty table gives no rows, and without training rows all mass is that of unseen words.
    """
    docs = keyed(df, id_col, text_col)
    learning = F.coalesce(fold("doc_id") != 1, F.lit(False))
    scored = score_documents(docs, train(docs.where(learning)))
    return scored.select(ROW, "doc_id", F.coalesce(fold("doc_id") == 1, F.lit(True)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
