"""Fingerprints, quality, language and pseudo-likelihood: contracts, brute force where there is one, and held-out accuracy."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest

from shelfmark.llm import language_bigru as lb
from shelfmark.llm import masked_lm as lm
from shelfmark.llm import minhash, queries
from shelfmark.llm import quality_gam as qg
from tests.llm.fixtures import awkward, clashing, frame

SF = "/root/testdata/sf0.01"


def edited(rows):
    ordered = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    texts = [t for _, t in ordered]
    out = {}
    for k, (doc, t) in enumerate(ordered):
        n = len(t) // 4
        e = t[: len(t) - n] + texts[(k + 1) % len(texts)][:n]
        out[doc] = (len(t), hashlib.sha256(e.encode()).hexdigest(), t, e, texts[(k + 1) % len(texts)])
    return out


def jaccard(a, b):
    sets = [frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset() for w in (a.encode().split(), b.encode().split())]
    return len(sets[0] & sets[1]) / max(1, len(sets[0] | sets[1])) if any(sets) else 1.0


def test_fingerprints(spark):
    expected = edited(awkward())
    for df in (frame(spark), clashing(frame(spark)).repartition(4), frame(spark).coalesce(1)):
        got = {r["doc_id"]: r for r in minhash.fingerprints(df).collect()}
        assert got.keys() == expected.keys()
        for doc, (n, sha, text, e, after) in expected.items():
            r = got[doc]
            assert (r["n_chars"], r["edited_sha256"]) == (n, sha)
            assert abs(r["near_edited"] - jaccard(text, e)) < 0.2 and abs(r["near_next"] - jaccard(text, after)) < 0.2
            assert r["near_edited"] == minhash.likeness(r["fingerprint"], r["edited_fingerprint"])
    by_text = {}
    for doc, (_, _, text, _, _) in expected.items():
        assert by_text.setdefault(text, got[doc]["fingerprint"]) == got[doc]["fingerprint"]
    assert minhash.fingerprints(frame(spark, [])).collect() == []
    alone = minhash.fingerprints(frame(spark, [(1, "a b c d e f g h", "en", "s", 1)])).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0


def test_similar_pairs_are_verified(spark):
    ids = {r[0]: r[1] for r in awkward()}
    pairs = minhash.similar_pairs(frame(spark)).collect()
    assert pairs
    for p in pairs:
        assert p["jaccard"] == pytest.approx(jaccard(ids[p["a"]], ids[p["b"]])) and p["jaccard"] >= 0.75


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_quality_on_held_out_labels(spark):
    got = {r["doc_id"]: r for r in queries.op7_quality_gam(spark, SF).collect()}
    labels = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if held_out(r["doc_id"])]
    assert all(got[d]["held_out"] == held_out(d) for d in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    right = np.mean([got[r["doc_id"]]["predicted"] == r["quality"] for r in labels])
    assert len(labels) > 50 and right >= 0.95


def test_quality_never_sees_the_held_out_fold(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", qg.F.when(qg.fold() == 0, 1 - qg.F.col("quality")).otherwise(qg.F.col("quality")))
    a, b = qg.train(docs, labels), qg.train(docs, flipped)
    assert a.base == b.base and all((x == y).all() for x, y in zip(a.tables, b.tables, strict=True))


def test_quality_without_labels_and_awkward_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = qg.train(frame(spark), labels)
    got = qg.score(clashing(frame(spark)), model).collect()
    assert len(got) == len(awkward()) and {r["score"] for r in got} == {0.5}
    kept = qg.keep_good(clashing(frame(spark)), model)
    assert kept.columns == clashing(frame(spark)).columns and kept.count() == len(awkward())
    assert qg.score(frame(spark, []), model).collect() == []


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = qg.fit(x[:2000], y[:2000])
    assert np.mean((model.scores(x[2000:]) > 0.5) == y[2000:]) > 0.9


def test_additive_scores_one_row_at_a_time(spark):
    """The model restated: for each row the base, a step of each feature's table, and one of each pair's."""
    from bisect import bisect_right

    rng = np.random.default_rng(3)
    x = np.round(rng.random((1500, 4)) * 9)
    y = ((x[:, 0] > 4) ^ (x[:, 2] > 3)).astype(float)
    model = qg.fit(x, y)
    assert model.pairs

    def plain(row):
        at = lambda edges, f: bisect_right(edges[f].tolist(), row[f])
        total = model.base + sum(t[at(model.edges, f)] for f, t in enumerate(model.tables))
        total += sum(t[at(model.coarse, f), at(model.coarse, g)] for (f, g), t in model.pairs.items())
        return 1 / (1 + np.exp(-total))

    some = np.concatenate([x[:200], x[:50] + 0.5, np.full((1, 4), -1.0), np.full((1, 4), 99.0)])
    assert model.scores(some) == pytest.approx([plain(r) for r in some])


def test_quality_of_repeated_rows_and_long_texts(spark):
    long = "A sentence of some words, and its end. " * 30_000  # 1.2 MB
    rows = [(k % 40, f"good words number {k} in a row. " * 20 if k % 2 else "x9 " * 50, "en", "s", 0) for k in range(80)] + [(1, long, "en", "s", 0)] * 2 + [(None, None, "en", "s", 0)]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(40)], "doc_id long, quality int, toxic int")
    model = qg.train(clashing(frame(spark, rows)), labels)
    got = qg.score(frame(spark, rows), model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 2}) == 1
    kept = qg.keep_good(frame(spark, rows), model).count()
    assert kept == sum(r["predicted"] for r in got)


def test_fingerprints_of_repeated_rows(spark):
    rows = [(7, "one text of some words here", "en", "s", 0)] * 40 + [(3, "a b c", "en", "s", 0), (9, None, "en", "s", 0), (None, "no id", "en", "s", 0)]
    got = minhash.fingerprints(frame(spark, rows).repartition(6)).collect()
    assert len(got) == len(rows) and len({r["fingerprint"] for r in got if r["doc_id"] == 7}) == 1
    assert sorted(r["near_next"] == 1.0 for r in got if r["doc_id"] == 7) == [False] + [True] * 39


def test_language_on_held_out_documents(spark):
    got = {r["doc_id"]: r for r in queries.op10_language_bigru(spark, SF).collect()}
    docs = [r for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if held_out(r["doc_id"])]
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in docs]) >= 0.95
    assert all(got[d]["held_out"] == held_out(d) for d in got)


def test_language_of_awkward_rows(spark):
    net = lb.fit(lb.segments(b"the cat " * 40, 64), np.array([0] * 5), ["en"])
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in lb.languages(clashing(frame(spark)), net).collect()}
    for doc, text, *_ in awkward():
        assert (got[doc][0] == "und") == (not any(c.isalpha() for c in text or ""))
        assert 0 <= got[doc][1] <= 1
    assert lb.languages(frame(spark, []), net).collect() == []
    nothing = lb.train(frame(spark, [(1, "text", None, "s", 1)]))
    assert [r["lang_pred"] for r in lb.languages(frame(spark, [(1, "text", None, "s", 1)]), nothing).collect()] == ["und"]


def test_document_probabilities_one_byte_at_a_time():
    """The network restated: a loop over bytes for each direction, each segment, each position."""
    net = lb.BiGRU.new(["a", "b", "c"], hidden=5, seed=3)
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def states(symbols, way):
        h, out = np.zeros(5), []
        for c in symbols:
            x, u = net.x[way][c].astype(float), net.u[way].astype(float)
            zr = sigmoid(x[:10] + h @ u[:, :10])
            new = np.tanh(x[10:] + zr[5:] * (h @ u[:, 10:]))
            h = zr[:5] * h + (1 - zr[:5]) * new
            out.append(h)
        return out

    bodies = ["".join(map(chr, range(40, 400))).encode(), b"short", b"", b"x" * lb.LENGTH]
    for body, got in zip(bodies, net.document_probabilities(bodies), strict=True):
        each = []
        for k in range(0, len(body), lb.LENGTH):
            symbols = list(body[k : k + lb.LENGTH])
            for f, g in zip(states(symbols, 0), states(symbols[::-1], 1)[::-1], strict=True):
                y = np.exp(f @ net.v[0] + g @ net.v[1] + net.c)
                each.append(y / y.sum())
        assert got == pytest.approx(np.mean(each, 0) if each else np.full(3, 1 / 3), abs=1e-4)


def test_a_rare_language_is_learned_from_whole_texts(spark):
    """Three documents of 4,000 are in a language of their own, which only their ends show."""
    rows = [(k, "the cat and the dog " * 5, "en", "s", 0) for k in range(4000)]
    rows += [(5000 + k, "the cat and the dog " * 5 + "zwyx qvyx " * 400, "xx", "s", 0) for k in range(3)]
    rows += [(None, "zwyx", "yy", "s", 0), (6000, "zwyx", None, "s", 0), (5000, "zwyx qvyx", "xx", "s", 0)]
    net = lb.train(clashing(frame(spark, rows)))
    assert net.langs == ["en", "xx"]
    got = {r["doc_id"]: r for r in lb.languages(frame(spark, rows), net).collect()}
    assert got[6000]["lang_pred"] == "xx" and got[17]["lang_pred"] == "en" and got[5001]["lang_pred"] == "xx"


def test_what_is_a_letter(spark):
    net = lb.fit(lb.segments(b"the cat " * 40, 64), np.array([0] * 5), ["en"])
    texts = ["½ ²", "Ⅷ", "①", "〇", "12.5 €", "_", "ª", "ب", "字"]
    got = {r["doc_id"]: r["lang_pred"] for r in lb.languages(frame(spark, [(k, t, "en", "s", 0) for k, t in enumerate(texts)]), net).collect()}
    assert got == {k: "en" if any(c.isalpha() for c in t) else "und" for k, t in enumerate(texts)} and got[3] == "und"


def test_recurrent_gradients_and_forward_agree():
    rng = np.random.default_rng(1)
    net = lb.BiGRU.new(["a", "b", "c"], hidden=4)
    for name in ("x", "u", "v", "c"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    rows = rng.integers(0, 256, (6, 9)).astype(np.int16)
    rows[2, 5:] = lb.PAD
    y = rng.integers(0, 3, 6)
    loss, gradients = net.step(rows, y)
    for name, g in zip(("x", "u", "v", "c"), gradients, strict=True):
        w = getattr(net, name)
        for at in zip(*np.nonzero(np.abs(g) > np.abs(g).max() / 3), strict=True):
            if name == "x" and at[1] == lb.PAD:
                continue
            w[at] += 1e-4
            up = net.step(rows, y)[0]
            w[at] -= 2e-4
            down = net.step(rows, y)[0]
            w[at] += 1e-4
            assert g[at] == pytest.approx((up - down) / 2e-4, rel=0.02, abs=1e-4)
    logits = net.logits(rows)
    p = np.exp(logits) / np.exp(logits).sum(-1, keepdims=True)
    real = rows != lb.PAD
    assert loss == pytest.approx(-np.log(p[np.arange(6)[:, None], np.arange(9), y[:, None]])[real].mean(), rel=1e-3)


def frequent(docs):
    return lm.most_frequent(lm.word_totals(lm.read(lm.texts(docs))))


def test_masked_lm_beats_word_frequencies(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in lm.pseudo_likelihood(docs).collect()}
    rows = docs.collect()
    assert len(got) == len(rows) and all(got[r["doc_id"]]["n_tokens"] == len(r["text"].encode().split()) for r in rows)
    vocabulary = frequent(docs)
    coded = np.concatenate([np.array([vocabulary.index(w) if w in set(vocabulary) else lm.shared_id(w) for w in r["text"].encode().lower().split()]) for r in rows[:150]])
    share = np.bincount(coded, minlength=lm.VOCABULARY) / len(coded)
    frequencies = float(np.log(share[coded]).mean())
    scores = sum(got[r["doc_id"]]["log_prob"] for r in rows[:150]) / len(coded)
    assert scores > frequencies


def test_masked_lm_probabilities_one_word_at_a_time():
    """The network restated for a single word; all the words that could stand there share probability 1."""
    r = np.random.default_rng(2)
    net = lm.WindowNet.new()
    net.flat += r.normal(0, 0.2, net.flat.shape).astype(np.float32)
    v = {k: x.astype(float) for k, x in net.views().items()}

    def plain(around, target):
        x = np.concatenate([v["embed"][i] for i in around])
        h = np.tanh(x @ v["w"] + v["b"])
        top = np.exp(h @ v["top"] + v["top_b"])
        leaf = np.exp(h @ v["leaf"][target % lm.CLASSES] + v["leaf_b"][target % lm.CLASSES])
        return np.log(top[target % lm.CLASSES] / top.sum()) + np.log(leaf[target // lm.CLASSES] / leaf.sum())

    around, target, _ = lm.positions([r.integers(0, lm.VOCABULARY, 60).astype(np.uint16).tobytes(), r.integers(0, 40, 9).astype(np.uint16).tobytes()])
    assert net.log_probs(around, target) == pytest.approx([plain(a, t) for a, t in zip(around, target, strict=True)], abs=1e-3)
    assert sum(np.exp(plain(around[3], t)) for t in range(lm.VOCABULARY)) == pytest.approx(1)
    # The gradient against differences.
    g, loss = net.gradient(around, target)
    for at in np.argsort(-np.abs(g))[:20].tolist():
        moved = lm.WindowNet(net.flat.copy())
        moved.flat[at] += 1e-2
        up = -float(moved.log_probs(around, target).mean())
        moved.flat[at] -= 2e-2
        assert g[at] == pytest.approx((up + float(moved.log_probs(around, target).mean())) / 2e-2, rel=0.05, abs=1e-3)


def test_masked_lm_repeated_rows(spark):
    rows = [(1, "one two three", "en", "s", 0)] * 3 + [(None, "one two three", "en", "s", 0)]
    got = lm.token_likelihood(frame(spark, rows)).collect()
    assert len(got) == 4 and [r["n_tokens"] for r in got] == [3] * 4
    assert [r["log_prob"] for r in got] == pytest.approx([got[0]["log_prob"]] * 4)


def test_masked_lm_sees_both_sides_only():
    around, target, many = lm.positions([np.array([5, 6, 7], np.uint16).tobytes(), b"", np.array([9], np.uint16).tobytes()])
    n = lm.NOTHING
    assert around.tolist() == [[n, n, 6, 7], [n, 5, 7, n], [5, 6, n, n], [n, n, n, n]]
    assert target.tolist() == [5, 6, 7, 9] and many.tolist() == [3, 0, 1]


def test_masked_lm_on_awkward_rows(spark):
    got = {r["doc_id"]: r for r in lm.pseudo_likelihood(clashing(frame(spark))).collect()}
    for doc, text, *_ in awkward():
        n = len((text or "").encode().split())
        assert got[doc]["n_tokens"] == n and (got[doc]["mean_log_prob"] is None) == (n == 0) and got[doc]["log_prob"] <= 0
    assert lm.pseudo_likelihood(frame(spark, [])).collect() == []


def test_masked_lm_tells_rare_words_with_the_same_ends_apart(spark, tmp_path):
    common = [f"{a}{b}" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"][: lm.FREQUENT]
    texts = [" ".join(common)] * 30 + ["aa ab walking ac ad"] * 20 + ["aa ab waxyzing ac ad", "", None]
    frame(spark, [(k, t, "en", "s", 0) for k, t in enumerate(texts)]).coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op5_masked_lm(spark, str(tmp_path)).collect()}
    assert lm.shared_id(b"walking") == lm.shared_id(b"waxyzing") and len(got) == len(texts)
    assert got[30]["log_prob"] - got[50]["log_prob"] == pytest.approx(np.log(20), rel=1e-3)
    assert got[51]["log_prob"] == got[52]["log_prob"] == 0 and got[51]["mean_log_prob"] is None


def test_masked_lm_shares_against_brute_force(spark):
    docs = clashing(frame(spark)).repartition(3)
    ids = {r["doc_id"]: r["log_prob"] for r in lm.pseudo_likelihood(docs).collect()}
    got = {r["doc_id"]: r for r in lm.token_likelihood(docs).collect()}
    split = {r[0]: (r[1] or "").encode().lower().split() for r in awkward()}
    known = set(frequent(frame(spark)))
    counts, buckets = Counter(w for ws in split.values() for w in ws if w not in known), Counter()
    for w, n in counts.items():
        buckets[lm.shared_id(w)] += n
    assert len(got) == len(split) and counts
    for doc, ws in split.items():
        own = sum(np.log(counts[w] / buckets[lm.shared_id(w)]) for w in ws if w in counts)
        assert got[doc]["n_tokens"] == len(ws) and got[doc]["log_prob"] == pytest.approx(ids[doc] + own, rel=1e-3, abs=1e-2)
    assert lm.token_likelihood(frame(spark, [])).collect() == []


def test_masked_lm_learns_from_every_position(spark, monkeypatch):
    n, turns = 23, []
    coded = [np.arange(n, dtype=np.uint16).tobytes(), np.arange(n, n + 2, dtype=np.uint16).tobytes()]
    trainer = lm._trainer
    monkeypatch.setattr(lm, "_trainer", lambda weights, turn: turns.append(turn) or trainer(weights, turn))
    lm.train(spark.createDataFrame([(bytearray(c),) for c in coded], "ids binary"))
    targets = np.concatenate([lm.positions(coded, turn, lm.STRIDE)[1] for turn in turns])
    assert sorted(targets.tolist()) == list(range(n + 2))


@pytest.mark.parametrize("tile", [1024, 3])
def test_similar_pairs_are_all_there(spark, monkeypatch, tile):
    monkeypatch.setattr(minhash, "TILE", tile, raising=False)
    words = [f"w{k}" for k in range(400)]
    # Text 0 shares a bit with all others; the others are near copies of each other.
    rows = [(0, " ".join(words[:200] + [f"z{k}" for k in range(100)]), "en", "s", 0)]
    rows += [(k, " ".join([*words[:390], *[f"e{k}x{j}" for j in range(k % 4)]]), "en", "s", 0) for k in range(1, 25)]
    rows += [(100 + k, " ".join(words[: 300 + 20 * k]), "en", "s", 0) for k in range(6)] + [(None, None, "en", "s", 0), (None, "no id", "en", "s", 0)]
    first = {}
    for doc, text, *_ in rows:
        if text and doc is not None:
            first.setdefault(text, doc)
    expected = {(a, b) for x, a in first.items() for y, b in first.items() if a < b and jaccard(x, y) >= 0.75}
    got = [(r["a"], r["b"]) for r in minhash.similar_pairs(frame(spark, rows).repartition(3)).collect()]
    assert len(got) == len(set(got)) and set(got) == expected and any(a > 0 for a, _ in expected)


def shingle_set(text):
    ws = (text or "").encode().split()
    return frozenset(tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))) if ws else None


def test_every_row_has_its_class_and_links(spark):
    """300 near copies, copies of some, other case, nulls: a row for each, none lost."""
    base = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join([*base, f"e{k % 290}"]), "en", "s", 0) for k in range(300)]
    rows += [(1000, " ".join(base).upper(), "en", "s", 0), (1001, "  ".join(base), "en", "s", 0), (1002, " ".join(base[:50]), "en", "s", 0), (None, " ".join([*base, "e3"]), "en", "s", 0)]
    rows += [(1003, None, "en", "s", 0), (1004, "", "en", "s", 0), (None, "nobody has this", "en", "s", 0), (1005, "short one", "en", "s", 0), (1005, "short one", "en", "s", 0)]
    sets = {}
    for doc, text, *_ in rows:
        if shingle_set(text) and doc is not None:
            sets[shingle_set(text)] = min(doc, sets.get(shingle_set(text), doc))
    links = {s: sum(x != s and 100 * len(x & s) >= 75 * len(x | s) for x in sets) for s in sets}
    want = sorted(((d, sets.get(shingle_set(t)), links.get(shingle_set(t), 0)) for d, t, *_ in rows), key=str)
    got = sorted((tuple(r) for r in minhash.near_links(clashing(frame(spark, rows)).repartition(3)).collect()), key=str)
    assert got == want and max(n for _, _, n in got) > 280
    assert minhash.near_links(frame(spark, [])).collect() == []
