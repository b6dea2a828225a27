"""Toxicity, language model and embedding links: brute force, gradients, sums of probabilities, held-out rows."""

import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylens.llm import language_model as lm, toxicity as toxicity_module
from skylens.llm.embedding_dedup import embedding_dedup, passes_for
from skylens.llm.common import keyed
from skylens.llm.toxicity import Model, toxicity, train


def corpus(n, seed=1):
    rng = random.Random(seed)
    calm = ["".join(rng.choices("aeiourtnslm", k=rng.randint(3, 8))) for _ in range(150)]
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.3
        words = rng.choices(calm, k=rng.randint(10, 40))
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["blockhead", "nitwit", "dunderhead", "grumwort" + rng.choice(calm)])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def tox_frames(spark, rows, labels):
    return (spark.createDataFrame([(i, t, 1.0, "x") for i, t in rows], "doc_id long, text string, score double, toxic string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_toxicity_learns_and_sees_through_disguise(spark):
    rows, labels = corpus(900)
    clean = " ".join(w for w in rows[0][1].split() if w not in ("blockhead", "nitwit", "dunderhead") and not w.startswith("grumwort"))
    disguised = {5001: "bl0ckhe@d", 5002: "n1tw1t", 5003: "niiiitwiiiit", 5004: "n i t w i t", 5005: "d.u.n.d.e.r.h.e.a.d", 5006: "BLOCKHEAD!!", 5007: "grumworttalsi", 5008: "bl0ckhead"}
    extra = [(i, f"{clean} {w} {clean}") for i, w in disguised.items()] + [(6000, clean), (6001, None), (6002, ""), (None, "nitwit"), (0, rows[0][1]), (6003, (clean + " ") * 500 + "nitwit")]
    docs, marks = tox_frames(spark, rows + extra, labels + [(6002, None), (6001, 7), (0, labels[0][1])])
    got = toxicity(docs, marks).collect()
    assert len(got) == len(rows) + len(extra) and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].predicted == 1 for i in disguised), {w: by_id[i].score for i, w in disguised.items()}
    assert by_id[6000].predicted == by_id[6001].predicted == by_id[6002].predicted == 0 and by_id[6003].predicted == by_id[None].predicted == 1
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    no_labels = toxicity(docs, marks.limit(0)).collect()
    assert all(r.predicted == 0 for r in no_labels) and toxicity(docs.limit(0), marks).count() == 0


def test_labels_of_the_held_out_fold_change_nothing(spark):
    rows, labels = corpus(300, 3)
    docs, marks = tox_frames(spark, rows, labels)
    flipped = marks.withColumn("toxic", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted((r.doc_id, r.score) for r in toxicity(docs, marks).collect()) == sorted((r.doc_id, r.score) for r in toxicity(docs, flipped).collect())


def test_decoder_takes_the_cheapest_path():
    grams = {"^^c": 1.0, "^ca": 1.0, "cat": 1.0, "at$": 1.0}
    own = Model(0.1, {}, {}, grams, 9.0)
    assert own.decode("c@t") == own.decode("caaaat") == own.decode("c a t") == own.decode("c4t") == "cat"


def test_disguises_at_the_ends_set_apart_and_long(spark):
    rows, labels = corpus(900)
    clean = " ".join(w for w in rows[0][1].split() if w not in ("blockhead", "nitwit", "dunderhead") and not w.startswith("grumwort"))
    disguised = ["nitwittt", "nnnitwit", "a n i t w i t", "r n i t w i t", "n i t w i t n i t w i t", "nitw1+", "n1twi7", "n" + "i" * 90 + "twit", "n.i.t.w.i.t." * 8 + "n.i.t.w.i.t"]
    docs, marks = tox_frames(spark, rows, labels)
    model = train(keyed(docs), marks)
    for w in disguised:
        assert "nitwit" in model.restored(f"{clean} {w} {clean}"), (w, model.decode(w))
    assert model.restored("nitwit! blockhead") == ["nitwit", "blockhead"]
    assert len(model.decode("n i t w i t " * 5000 + "a")) > 30000


def test_evidence_by_token_is_that_of_the_restored_words(spark):
    rows, labels = corpus(300)
    model = train(keyed(tox_frames(spark, rows, labels)[0]), tox_frames(spark, rows, labels)[1])
    rng = random.Random(9)
    bits = ["nitwit", "n1tw1t", "blockhead", "bl0ckhe@d!", "nitwittt,nitwittt", "n i t w i t", "n.i_t w*i~t", "NITWIT\u00a0nitwit", "a", "(", "...", "\u0130\u03a3", "grumwortx/grumworty",
            "d-u-n-d-e-r-h-e-a-d", "x" * 70 + "nitwit", "m0\x1cn1tw1t", "a b", "\u00b2nitwit", "1nitwit", "$nitwit$$", "_nitwit_"]
    for _ in range(2000):
        text = "".join(rng.choice(bits) + rng.choice(["", " ", "\n", ".", "  ", "\t", "\u2003"]) for _ in range(rng.randrange(12)))
        found = [(model.word(w), w) for w in model.restored(text) if w[:4] in model.heads]
        value, word = max(found, default=(0.0, None))
        assert model.evidence(text) == (min(sum(v >= 0.5 for v, _ in found), 6), value, word), text
        assert toxicity_module._set_apart(text.lower()) == {m.group(0) for m in toxicity_module._SPACED.finditer(text.lower())}, text


def test_only_verified_copies_are_left_out_of_training(spark):
    rng = random.Random(2)
    common = [f"c{i}" for i in range(30)]
    texts = [" ".join(common + [f"w{rng.randrange(10**6)}" for _ in range(30)]) for _ in range(300)]
    copies = [texts[0] + " c1 c2", texts[1].replace("c3 ", "", 1), " ".join(reversed(texts[2].split()))]
    rows = [(i, t, i % 2) for i, t in enumerate(texts)] + [(900 + i, t, i % 2) for i, t in enumerate(copies)] + [(990, "", 0), (991, "", 0), (992, texts[0], 1)]
    got = sorted((r.doc_id, r.toxic) for r in toxicity_module._without_copies(spark.createDataFrame(rows, "doc_id long, text string, toxic int")).collect())
    kept = {i for i, _ in got}
    assert set(range(300)) | {990, 992} <= kept and not {900, 902, 991} & kept and len(got) == len(kept)


def test_neighbours_are_taken_only_of_words_that_may_tell(spark, monkeypatch):
    rng = random.Random(4)
    other = lambda: "".join(rng.choices("aeioulnm", k=5))
    rows = [(i, f"{other()} than {other()} than {other()}" + (f" thanxo{other()} {other()}" if i % 4 == 0 else "")) for i in range(400)]
    docs, marks = tox_frames(spark, rows, [(i, int(i % 4 == 0)) for i, _ in rows])
    judged, neighbours = [], toxicity_module._neighbours
    monkeypatch.setattr(toxicity_module, "_neighbours", lambda words, prefixes: judged.append((words, prefixes)) or neighbours(words, prefixes))
    model = train(keyed(docs), marks)
    words, prefixes = judged[0]
    assert {"thanx", "thanxo"} <= prefixes and any(w.startswith("thanxo") for w in words) and "than" not in words
    seen = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 5]
    share = sum(i % 4 == 0 for i, _ in seen) / len(seen)
    assert model.words["than"] == pytest.approx(share, rel=0.02) and model.word("thanxoaeiou") >= 0.5


def lm_rows(n=300, seed=5):
    rng = random.Random(seed)
    tongues = [["".join(rng.choices(a, k=rng.randint(2, 6))) for _ in range(60)] for a in ("abcdef", "uvwxyz")]
    return [(i, "  ".join(rng.choices(tongues[i % 2], k=rng.randint(1, 60)))) for i in range(n)]


def lm_frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, h int, c string")


def lm_tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group(0).lower(), text or "")) + ["\0end"]


def test_language_model_counts_and_beats_them(spark, monkeypatch):
    rows = lm_rows() + [(900, None), (901, ""), (902, "Unseen words ABC only"), (None, "uvw"), (3, "again"), (3, "again"), (903, "uvw xyz " * 9000)]
    got = lm.language_model(lm_frame(spark, rows)).orderBy("_row").collect()
    train = [t for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 5 != 1]
    counts = {}
    for t in train:
        for w in lm_tokens(t):
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    want = {}
    for i, t in rows:
        own = lm_tokens(t)
        want.setdefault(i, []).append((len(own), sum(w in counts for w in own), sum(math.log10((counts.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in own)))
    for r in got:
        assert any((r.n_tokens, r.n_known) == x[:2] and r.base_score == pytest.approx(x[2], rel=1e-9) for x in want[r.doc_id]) and r.train_tokens == n
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 1) and r.score < 0
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 300]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.05 * sum(r.n_tokens for r in held)
    # words beyond the head come by the join, with the same results
    few = {r._row: r for r in lm.score_documents(lm.keyed(lm_frame(spark, rows)), lm.train(lm.keyed(lm_frame(spark, rows)).where("doc_id is not null and pmod(crc32(cast(cast(doc_id as string) as binary)), 5) <> 1"), head=20)).collect()}
    assert all(few[r._row].n_known == r.n_known and few[r._row].base_score == pytest.approx(r.base_score, rel=1e-9) for r in got)
    empty = lm_frame(spark, [])
    assert lm.language_model(empty).count() == 0


def test_weights_learn_from_every_document(spark, monkeypatch):
    docs = lm.keyed(spark.createDataFrame([(i, "one two three " * 40, 1, "x") for i in range(6000)], "doc_id long, text string, h int, c string"))
    seen = []
    merge = lm.averaged

    def counted(learned):
        learned = lm.written(learned, "counted")
        seen.append(learned.agg(F.sum("tokens")).first()[0])
        return merge(learned)

    monkeypatch.setattr(lm, "averaged", counted)
    model = lm.train(docs)
    assert len(seen) == lm.ROUNDS and all(n >= 0.95 * model.vocabulary.n for n in seen)


def test_trainers_look_up_the_short_list_alone(spark, monkeypatch):
    rng = random.Random(6)
    docs = lm.keyed(lm_frame(spark, [(i, " ".join(f"w{int(rng.random() ** 2 * 3000)}" for _ in range(400))) for i in range(40)]))
    given, run = [], lm._train
    monkeypatch.setattr(lm, "_train", lambda vocabulary, weights: given.append(vocabulary) or run(vocabulary, weights))
    whole = lm.train(docs).vocabulary
    assert len(given) == lm.ROUNDS and len(whole.h) > lm.SHORT and all(len(x.h) == lm.SHORT for x in given)
    tail = np.zeros(len(whole.h), np.int64)
    assert (lm.number(given[0], whole.h, tail)[0] == lm.number(whole, whole.h, tail)[0]).all()


def test_weights_are_averaged_in_a_tree(spark):
    rows = [(i, i % 3, lm.pickle.dumps({"a": np.full(2, i, np.float32)})) for i in range(300)]
    got = lm.averaged(spark.createDataFrame(rows, "part long, tokens long, weights binary"))
    assert got["a"] == pytest.approx([sum(i * (i % 3) for i in range(300)) / 300] * 2, rel=1e-4)


def vocabulary(n_words):
    h = np.arange(n_words).astype(np.uint64)
    return lm.Vocabulary(h, np.arange(n_words, 0, -1), int(n_words * (n_words + 1) / 2), n_words, np.ones(lm.TAIL_CLASSES))


def test_probabilities_sum_to_one():
    network = lm.Network(1)
    h = np.random.default_rng(0).standard_normal((1, lm.HIDDEN)).astype(np.float32)
    every = np.arange(lm.SHORT + lm.TAIL_CLASSES)
    logp, _, _ = network.output(np.repeat(h, len(every), axis=0), every)
    assert np.exp(logp).sum() == pytest.approx(1.0, abs=1e-4)


def test_gradients_match_differences():
    rng = np.random.default_rng(2)
    network = lm.Network(4)
    network.w = {k: x.astype(np.float64) + rng.standard_normal(x.shape) * 0.2 for k, x in network.w.items()}
    x, y = rng.integers(0, 90, (5, 3)), rng.integers(0, lm.SHORT + lm.TAIL_CLASSES, (5, 3))
    moved = {}
    network._move = lambda name, g, rows=slice(None): moved.__setitem__(name, (g, rows))

    def loss():
        h, total = np.zeros((3, lm.HIDDEN)), 0.0
        for t in range(5):
            h = network.step(h, x[t], x[t] == 0)[-1]
            total -= network.output(h, y[t])[0].sum()
        return total

    network.train_window(np.zeros((3, lm.HIDDEN)), x, y)
    scale = 1 / math.sqrt(x.size)
    for name in ("gates", "new", "classes", "class_bias", "inputs"):
        g, rows = moved[name]
        at = (0, 1) if g.ndim == 2 else (2,)
        target = (rows[0], 1) if name == "inputs" else at
        kept, step = network.w[name][target], 1e-5
        network.w[name][target] = kept + step
        up = loss()
        network.w[name][target] = kept - step
        down = loss()
        network.w[name][target] = kept
        assert g[at] / scale == pytest.approx((up - down) / (2 * step), rel=2e-3, abs=1e-6)


def test_state_goes_on_across_windows_and_lanes():
    network, own = lm.Network(3), vocabulary(50)
    rng = np.random.default_rng(1)
    sizes = np.array([7, 200, 1, 33, 90])
    ids = rng.integers(1, 50, sizes.sum())
    ids[np.cumsum(sizes) - 1] = 0
    logp, state = np.empty(len(ids)), np.zeros((4, lm.HIDDEN), np.float32)
    for grid, _ in lm._grids(ids, sizes, 2):
        state = state[:grid.shape[1]]
        for t in range(len(grid)):
            live = int((grid[t] >= 0).sum())
            at = grid[t, :live]
            x = np.where(at == 0, 0, ids[at - 1])
            state = network.step(state[:live], x, x == 0)[-1]
            logp[at] = network.output(state, ids[at])[0]
    begin = 0
    for n in sizes:
        h, before = np.zeros((1, lm.HIDDEN), np.float32), 0
        for i in range(begin, begin + n):
            h = network.step(h, np.array([before]), np.array([before == 0]))[-1]
            assert logp[i] == pytest.approx(network.output(h, ids[i:i + 1])[0][0], abs=1e-4)
            before = ids[i]
        begin += n
    assert own.find(np.array([0, 3, 99], np.uint64))[0].tolist() == [0, 3, -1]


def vectors(seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(60):
        centre = rng.standard_normal(16)
        for _ in range(rng.integers(1, 8)):
            rows.append((centre + rng.standard_normal(16) * 0.12).astype(np.float32).tolist())
    rows += [rows[0]] * 6 + [[x * 3 for x in rows[0]], [0.0] * 16, [], None, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] + [0.0] * 15, [1.0, 0.0], [2.0, 0.0], [-0.0, 1.0], [0.0, 1.0]]
    return [(int(i), v) for i, v in zip(rng.permutation(5000)[:len(rows)], rows)]


def test_embedding_links_match_brute_force(spark):
    rows = vectors() + [(None, [1.0, 0.0])]
    valid = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    n = len(rows)
    linked = [[False] * n for _ in range(n)]
    for a in range(n):
        for b in range(n):
            if a != b and valid[a] and valid[b] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                linked[a][b] = x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.95
    seen = {}
    for start in range(n):
        group, todo = {start}, [start]
        while todo:
            a = todo.pop()
            for b in range(n):
                if linked[a][b] and b not in group:
                    group.add(b)
                    todo.append(b)
        ids = [rows[i][0] for i in group if rows[i][0] is not None]
        seen[start] = min(ids) if ids else None
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, digest string")
    got = embedding_dedup(df, block=64, window=16).orderBy("_row").collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in got) == sorted((i or -1, sum(linked[k]), seen[k], i is not None and seen[k] == i) for k, (i, _) in enumerate(rows))
    assert embedding_dedup(df.limit(0)).count() == 0


def test_recall_at_the_threshold_itself(spark):
    rng = np.random.default_rng(8)
    a = rng.standard_normal((3000, 32))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal((3000, 32))
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.9501 * a + math.sqrt(1 - 0.9501**2) * side
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.concatenate([a, b]))], "vec_id long, embedding array<double>")
    found = embedding_dedup(df).where("n_links > 0").count() / 6000
    assert found >= 0.99 and passes_for(10**9, 0.95) < 120


def test_recall_and_links_where_a_third_lies_around_one_centre(spark):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(64)
    centre /= np.linalg.norm(centre)
    side = rng.standard_normal((1000, 64))
    side -= (side @ centre)[:, None] * centre
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    x = np.concatenate([0.96 * centre + 0.28 * side, rng.standard_normal((2000, 64))])
    family = rng.standard_normal(64) + 0.1 * rng.standard_normal((400, 64))
    x = np.concatenate([x, family])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dedup(df, block=256).collect()}
    degrees = near.sum(axis=1)
    assert degrees[:1000].sum() > 500 and (degrees[3000:] == 399).all()
    n_links = np.array([got[i].n_links for i in range(len(x))])
    assert (n_links <= degrees).all() and n_links.sum() >= 0.998 * degrees.sum() and n_links[:1000].sum() >= 0.995 * degrees[:1000].sum()
    assert (n_links[3000:] == 399).all() and all(got[i].component_id == 3000 for i in range(3000, 3400))
