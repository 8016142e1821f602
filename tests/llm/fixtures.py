"""Small tables for the training-data operators: every awkward row in one place."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(r: random.Random, n: int, letters: str = "abcdefgh") -> str:
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(1, 7))) for _ in range(n))


def awkward(seed: int = 1) -> list[tuple]:
    """Nulls, empty and blank texts, copies in other case, near copies, a shared passage, very long texts and words."""
    r = random.Random(seed)
    base, passage = prose(r, 200), prose(r, 70)
    texts = [None, "", " \n\t", "Hello", "hello", "HELLO", "a b c d", "A B C D", base, base.upper(), "É" * 40, "é" * 40, "日本語 テキスト", "a\x0bb\x1cc\xa0d", "<|endoftext|> x <|startoftext|>", "x" * 3000, "!" * 500, prose(r, 20_000)]
    words = base.split()
    for k in range(12):  # near copies: some link to the base alone
        copy = list(words)
        for _ in range(k):
            copy[r.randrange(len(copy))] = prose(r, 1, "xyz")
        texts.append(" ".join(copy))
    texts += [f"{prose(r, 30)} {passage} {prose(r, 30)}" for _ in range(4)] + ["go go " * 100, "go go " * 130]
    rows = [(3 * k + 7, t, "en", "s", None if t is None else len(t)) for k, t in enumerate(texts)]
    rows.append((None, "no id at all", None, None, None))
    r.shuffle(rows)
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)


def clashing(df):
    """The same rows with columns that have the operators' own names."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(c) for c in ("fp", "key", "sig", "band", "bands", "normal", "shard", "rank", "cell", "hash", "first", "comp", "markers", "text_key", "ids", "place", "score", "held_out", "label", "kept", "a", "b")})
