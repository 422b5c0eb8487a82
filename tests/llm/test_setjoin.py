"""The set join's long lists: groups of near copies whose members are not all linked to one of them."""

import numpy as np
from test_operators import brute_components

from buzzmill.llm import setjoin


def near_copies(n, words, most_edits, seed=5):
    rng = np.random.default_rng(seed)
    base, out = [f"b{k}" for k in range(words)], []
    for _ in range(n):
        t = list(base)
        for at in rng.integers(0, words, int(rng.integers(0, most_edits + 1))):
            t[at] = f"e{int(rng.integers(0, 40))}"
        out.append(" ".join(t))
    return out


def test_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(setjoin, "PAIRED", 4)
    made = []
    against = setjoin.against_heads
    monkeypatch.setattr(setjoin, "against_heads", lambda *a: made.append(len(a) > 4) or against(*a))
    texts = near_copies(600, 40, 5) + near_copies(60, 90, 9, 6)[:30] + ["b1 b2 b3 b4 b5", None, ""]
    sizes, comp = brute_components(texts, 4, 85)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in setjoin.join_components(df).collect()}
    assert got == {k: (sizes[k], comp[k]) for k in range(len(texts))}
    assert any(made)  # differences were read
    assert len(set(comp)) > 20  # many are linked to nothing though they share most of their shingles


def test_short_lists_wait_for_the_last_pairing(spark, monkeypatch):
    """Rounds over long lists neither join the rows of short ones again nor lose them."""
    monkeypatch.setattr(setjoin, "PAIRED", 4)
    opened, paired = [], []
    opens, pairs = setjoin._open, setjoin._pairs
    lists = lambda rows: {(r["space"], r["token"]): r["count"] for r in rows.groupBy("space", "token").count().collect()}
    monkeypatch.setattr(setjoin, "_open", lambda rows, *a: opened.append(lists(rows)) or opens(rows, *a))
    monkeypatch.setattr(setjoin, "_pairs", lambda rows, *a: paired.append(lists(rows)) or pairs(rows, *a))
    texts = near_copies(300, 40, 5)
    for k in range(60):  # two texts each, linked with one another alone
        words = [f"w{k}x{i}" for i in range(40)]
        texts += [" ".join(words), " ".join([*words[:-1], "other"])]
    sizes, comp = brute_components(texts, 4, 85)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in setjoin.join_components(df).collect()}
    assert got == {k: (sizes[k], comp[k]) for k in range(len(texts))}
    assert len(opened) > 1  # there was a round
    assert min(opened[0].values()) > 4
    assert not any(a.keys() & b.keys() for a, b in zip(opened, opened[1:], strict=False))
    assert sum(n <= 4 for (space, _), n in paired[0].items() if space == 0) > 60


def test_extra_columns_stay(spark):
    rows = [(1, "a b c d e f", "x", 7), (2, "a b c d e f", "y", 8), (3, None, "z", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row_key string, comp int")
    kept = sorted(tuple(r) for r in setjoin.deduplicate(df).collect())
    assert kept == [rows[0], rows[2]]
