import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest

import __spark_entry__ as entry
from shelfmark.llm import toxicity_channel as tox
from tests.llm.fixtures import awkward, clashing, frame, prose

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return tox.character_model(spark.read.parquet(f"{SF}/documents.parquet"))


@pytest.fixture(scope="module")
def channel(spark):
    return tox.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))


def got(df, channel):
    return sorted(map(tuple, tox.score(df, channel).select("doc_id", "held_out", "score", "predicted").collect()), key=str)


def test_grams_of_all_texts_are_counted(spark, monkeypatch):
    texts = [r[1] for r in awkward()] + ["aé日本b", "1 2  3", "AbC"]

    def symbols(t):
        out = []
        for b in (t or "").encode():
            s = (b | 32) - 97 if 65 <= b <= 90 or 97 <= b <= 122 else 26 if b >= 128 else 27
            if s < 26 or s != (out or [None])[-1]:
                out.append(s)
        return out

    want = Counter()
    for t in texts:
        body = [27, 27, 27, *symbols(t), 27]
        body = [s for k, s in enumerate(body) if k < 3 or s != 27 or body[k - 1] != 27]
        want.update(zip(body, body[1:], body[2:], body[3:]))
    one = sum(tox.gram_counts([(t or "").encode()]) for t in texts)
    index = lambda g: ((g[0] * 28 + g[1]) * 28 + g[2]) * 28 + g[3]
    # What stands before a text is the same for all; from its first letter on each gram is as counted by hand.
    assert all(one[index(g)] == n for g, n in want.items() if 27 not in g[:3])
    whole = tox.character_model(frame(spark, [(k, t, "en", "s", 1) for k, t in enumerate(texts)]).repartition(1))
    assert np.allclose(np.exp(-whole.reshape(28, 28, 28, 28)).sum(-1)[0, 1], 1, atol=0.99) and whole.shape == (28**4,) and np.isfinite(whole).all()


def all_readings(seen):
    """Every path through the lattice, as (price of its arcs, symbols)."""
    for way in product(*[tox._arcs(c, before) for c, before in zip(seen, " " + seen, strict=False)]):
        out, price = [], sum(p for _, p in way)
        for x, _ in way:
            if x and not (x == " " and (not out or out[-1] == " ")):
                out.append(x)
        yield price, "".join(out)


def test_the_cheapest_path_is_found(model, monkeypatch):
    monkeypatch.setattr(tox, "PATHS", 10**6)
    r = random.Random(4)
    for _ in range(60):
        seen = "".join(r.choice("abost013!-.é") for _ in range(6))

        def cost(price, said):
            ctx, total = [27, 27, 27], price
            for c in said if said.endswith(" ") or not said else said + " ":
                s = tox._symbol(c)
                total += float(model[((ctx[0] * 28 + ctx[1]) * 28 + ctx[2]) * 28 + s])
                ctx = [*ctx[1:], s]
            return total

        best = min((cost(p, s), s) for p, s in all_readings(seen))
        mine = tox.decode(seen, model)
        assert any(" ".join(s.split()) == mine and abs(cost(p, s) - best[0]) < 1e-3 for p, s in all_readings(seen)), (seen, mine, best)


DISGUISES = {
    "look-alikes": lambda w, r: "".join(r.choice({"o": "0", "i": "1!", "e": "3", "a": "4@", "s": "5$", "t": "7"}.get(c, c)) for c in w),
    "spread": lambda w, r: " ".join(w),
    "dashes": lambda w, r: "-".join(w),
    "dots": lambda w, r: ".".join(w.upper()),
    "repeated": lambda w, r: "".join(c * r.choice([1, 1, 3, 5]) for c in w),
    "spread look-alikes": lambda w, r: " ".join(r.choice({"o": "0", "i": "1", "e": "3", "a": "4"}.get(c, c)) for c in w),
    "foreign letters": lambda w, r: w.replace("o", "о").replace("a", "а").replace("e", "е"),
}
WORDS = ["moron", "stupid", "loser", "idiot", "pathetic", "disgusting", "trash", "worthless"]


@pytest.mark.parametrize("kind", DISGUISES)
def test_disguised_words_are_restored(model, kind):
    r, reader, hits, tried = random.Random(2), tox.Reader(model), 0, 0
    for w in WORDS * 6:
        plain, hidden = reader.words(f"the and {DISGUISES[kind](w, r)} of")
        hits += any(tox.once(x) == tox.once(w) for x in plain | hidden)
        tried += 1
    assert hits >= 0.9 * tried


def test_plain_text_is_left_alone(model):
    for t in ("The clown said: it's over, isn't it? (No!) well-known... 2024", "à la carte, y no", "Grüße aus Köln", "пример текста", "日本語"):
        assert all(x in tox.restored(t, model) for x in t.lower().split() if x.isalpha())


def test_held_out_labels(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = entry.queries()["op12_toxicity_channel"](spark, SF).collect()
    ids = [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
    assert sorted(r["doc_id"] for r in rows) == sorted(ids)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    tested = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    # Nothing clean is caught. Some 40 toxic documents teach here, hardly any of them French or Spanish; with 16,000 labels (check_s) all 4,061 held-out ones are right.
    assert sum(a == b for a, b in tested) >= 0.95 * len(tested) and not any(b and not a for a, b in tested)


def test_disguised_documents_score_as_plain_ones(spark, channel):
    r = random.Random(6)
    clean = [d[0] for d in spark.read.parquet(f"{SF}/documents.parquet").join(spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 0"), "doc_id").filter("lang = 'en' AND n_chars < 3000").select("text").limit(30).collect()]
    rows = []
    for k, t in enumerate(clean):
        ws = t.split(" ")
        for w in r.sample(WORDS[:6], 4):
            ws.insert(r.randrange(len(ws)), DISGUISES[r.choice(list(DISGUISES))](w, r))
        rows += [(2 * k, t, "en", "s", 1), (2 * k + 1, " ".join(ws), "en", "s", 1)]
    found = {i: p for i, _, _, p in got(frame(spark, rows), channel)}
    assert sum(found[2 * k] for k in range(len(clean))) == 0 and sum(found[2 * k + 1] for k in range(len(clean))) >= 0.9 * len(clean)


def test_scores_are_what_the_weights_say(spark, channel):
    """Restated without the operator: three heaviest words, one logistic."""
    reader, folded = channel.reader()
    want = []
    for i, t, *_ in awkward():
        plain, hidden = reader.words(t or "")
        own = []
        for w in plain | hidden:
            if len(w) > 2:
                own.append(max([channel.weights.get(f, 0.0) for f in (w, *(w[:k] + "*" for k in (4, 5, 6) if len(w) > k))] + ([folded.get(f, 0.0) for f in tox.beginnings(tox.once(w))] if w in hidden else [])))
        own = sorted(own)[::-1][:3] + [0.0] * 3
        s = 1 / (1 + np.exp(-(sum(a * b for a, b in zip(own[:3], channel.slopes, strict=True)) + channel.base)))
        want.append((i, zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 0, s, int(s >= 0.5)))
    mine = got(frame(spark), channel)
    assert [x[:2] + x[3:] for x in mine] == [x[:2] + x[3:] for x in sorted(want, key=str)]
    assert np.allclose([x[2] for x in mine], [x[2] for x in sorted(want, key=str)])
    assert got(clashing(frame(spark)), channel) == mine


def test_odd_tables(spark, model):
    empty, none = frame(spark, []), spark.createDataFrame([], "doc_id long, toxic int")
    assert tox.score(empty, tox.train(empty, none)).count() == 0
    one = tox.train(frame(spark), spark.createDataFrame([(7, 1), (10, 1), (None, 1), (13, None)], "doc_id long, toxic int"))
    assert len({r["score"] for r in tox.score(frame(spark), one).collect()}) == 1
    rows = [(1, "x" * 200_000 + "1", "en", "s", 1), (2, prose(random.Random(1), 100_000), "en", "s", 1), (2, "a", "en", "s", 1), (2, "a", "en", "s", 1), (None, None, None, None, None)]
    back = tox.deobfuscate(frame(spark, rows), model).collect()
    assert len(back) == 5 and tox.score(frame(spark, rows), one).count() == 5


def test_slopes_are_never_negative():
    r = np.random.default_rng(1)
    x = r.random((400, 3))
    y = (x[:, 0] - x[:, 1] + 0.1 * r.standard_normal(400) > 0).astype(float)
    slopes, _ = tox.fitted(x, y)
    assert (slopes >= 0).all() and slopes[0] > 1 and slopes[1] == 0
