"""Tokenizer, language model and decontamination."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from webgrain.llm import classlm, decontaminate, pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def mixed_texts():
    rng = random.Random(3)
    e = pieces.encoder(MODEL)
    some = [chr(x) for x in [*range(32, 127), 10, 9, 0x2581, 0xE9, 0x4E2D, 0x1F600, 0x3042, 0x416, 0xA0, 13, 0x85, 0xFFFD]]
    words = list(e.ids)
    made = ["".join(rng.choice(some) if rng.random() < 0.5 else rng.choice(words) for _ in range(rng.randint(0, 30)))
            for _ in range(600)]
    return [t.replace("▁", " ") if k % 3 else t for k, t in enumerate(made)] + ["", None, "  a", "a" * 5000, " " * 50, "<s>", "<0x41>"]


def test_ids_are_those_of_the_library(spark, mixed_texts):
    lib = pieces.encoder(MODEL).model
    docs = spark.createDataFrame(list(enumerate(mixed_texts)), "doc_id long, text string")
    got = {r.doc_id: (list(r.ids), r.back) for r in pieces.decode(pieces.encode(docs, MODEL), MODEL, out="back").collect()}
    want = {k: (i := lib.encode(t or ""), lib.decode(i) if i else "") for k, t in enumerate(mixed_texts)}
    assert got == want
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    digests = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pieces.digest(docs, MODEL).collect()}
    assert digests == {k: (len(i), sha(",".join(map(str, i))), sha(t)) for k, (i, t) in want.items()}


def test_compatible_pairs_by_replaying_the_merges():
    e, rng = pieces.encoder(MODEL), random.Random(1)
    ids = [i for i in e.text if i in e.parts or len(e.text[i]) == 1]
    for _ in range(3000):
        a, b = rng.choice(ids), rng.choice(ids)
        assert e.compatible(a, b) == (e._merged(e.text[a] + e.text[b])[0] == [e.text[a], e.text[b]])


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pieces.digest(none, MODEL).count() == 0
    assert classlm.score_held_out(none).count() == 0
    assert decontaminate.mark(none, spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0


@pytest.fixture(scope="module")
def prose(spark):
    rng = random.Random(2)
    nouns, verbs = [f"noun{k}" for k in range(40)], [f"verb{k}" for k in range(40)]
    rows = []
    for k in range(300):
        t = " ".join(f"the {rng.choice(nouns)} {rng.choice(verbs)} The {rng.choice(nouns)}." for _ in range(rng.randint(0, 30)))
        rows.append((k, t, 7, "x"))
    rows += [(None, "the noun1 verb1", 7, "x"), (5, None, 7, "x"), (6, "", 7, "x"), (11, "rare" * 3000, 7, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, token long, class string")


def test_language_model_base_and_gain(prose):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    rows = prose.collect()
    tokens = [(r.text or "").encode().translate(low).split() + [None] for r in rows]
    held = [zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 1 for r in rows]
    c = collections.Counter(w for t, h in zip(tokens, held) if not h for w in t)
    total, distinct = sum(c.values()), len(c)
    want = sorted((("" if r.doc_id is None else str(r.doc_id)), h, len(t), sum(c[w] > 0 for w in t), total, round(sum(
        math.log10((c[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in t), 6)) for r, t, h in zip(rows, tokens, held))
    out = classlm.score_held_out(prose, classes=8).collect()
    got = sorted(("" if r.doc_id is None else str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                  round(r.base_score, 6)) for r in out)
    assert got == want
    unseen = [r for r in out if r.held_out]
    assert sum(r.score for r in unseen) > 0.8 * sum(r.base_score for r in unseen)
    assert all(r.score < 0 for r in out)


def test_class_model_is_a_distribution(spark, prose, monkeypatch):
    """The words of the vocabulary and one unknown word per class share a mass of one in each class."""
    texts = prose.select(prose.text.alias("t"))
    vocabulary, m = classlm.fit(texts, classes=8)
    mass = [0.0] * 8
    own = {int(x): k for k, x in enumerate(m["own"].view("int64"))}
    for token, ending, c in vocabulary.collect():
        unit = classlm.UNITS - 1 if ending < 0 else own.get(token, classlm.OWN + ending)
        k = int(m["of"][unit])
        mass[k] += (c + 0.5) / (m["n"][k] + 0.5 * (m["v"][k] + 1))
    for k in range(8):
        assert mass[k] + 0.5 / (m["n"][k] + 0.5 * (m["v"][k] + 1)) == pytest.approx(1)
    assert (10 ** m["transition"]).sum(axis=1) == pytest.approx(1)


ITEM = "Anna has 12 apples and gives Bob 5 km of rope before she walks to the old market with 12 friends"


@pytest.mark.parametrize("text,items", [
    ("Some words before. " + ITEM + " and after it", [1]),
    ("some. " + ITEM.lower(), [1]),
    ("some " + ITEM.replace("12", "40").replace("5", "9").replace("km", "miles").replace("Anna", "Carla").replace("Bob", "Dan"), [1]),
    ("some " + ITEM.replace("12 apples", "40 apples").replace("5", "9"), []),  # 12 stands for 40 and 12
    ("Anna has 12 apples and gives to the old market", []),
    ("x two RED birds sang very loudly today", [2]), ("a tiny item", []), ("", []), (None, []), ("... !!! ---", []),
])
def test_contamination(spark, text, items):
    docs = spark.createDataFrame([(8, text, "x", 3), (None, text, "y", 4)], "doc_id long, text string, d string, h long")
    items_ = [(1, ITEM), (2, "Two red birds sang very loudly."), (3, None), (4, ""), (5, "tiny item")]
    bench = spark.createDataFrame(items_, "item_id long, text string")
    got = decontaminate.mark(docs, bench).collect()
    assert [[x.item_id for x in r["items"]] for r in got] == [items, items]
    assert sorted(r.d for r in got) == ["x", "y"]


def found_items(spark, text, item):
    docs = spark.createDataFrame([(8, text)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    return [x.item_id for x in decontaminate.mark(docs, bench).first()["items"]]


NAMED = "then Anna met Bob and Carla near Paris while Dan saw Eve and Frank near Rome after Gina left"


@pytest.mark.parametrize("change", [str.lower, str.upper, str.title])
@pytest.mark.parametrize("item", [NAMED, "we found that small red birds sang very loudly in the old market today"])
def test_copies_in_other_case(spark, item, change):
    assert found_items(spark, "so " + change(item), item) == [1]


@pytest.mark.parametrize("text,item,items", [
    ("so 3 + 6 + 9 + 12 + 15 = ?", "3 + 6 + 9 + 12 + 15 = ?", [1]), ("so 3 + 6 + 9 + 12 + 16 = ?", "3 + 6 + 9 + 12 + 15 = ?", []),
    ("1 2 4 8 16 32 64 128 256 512 and on", "1 2 4 8 16 32 64 128 256 512", [1]),
    ("some " + ITEM.replace("12 apples", "40 apples"), ITEM, [1]),
])
def test_copies_with_many_or_torn_values(spark, text, item, items):
    assert found_items(spark, text, item) == items


def test_benchmark_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 3)
    docs = spark.createDataFrame([(8, "x " + ITEM)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, ITEM), (2, "tiny item")], "item_id long, text string")
    assert [x.item_id for x in decontaminate.mark(docs, bench).first()["items"]] == [1]


def test_every_gain_is_the_change_of_the_likelihood():
    rng = np.random.default_rng(7)
    for _ in range(20):
        n, k = 14, 4
        pairs = rng.poisson(1.5, (n, n)).astype(float)
        of, u = rng.integers(0, k, n), int(rng.integers(0, n))

        def likelihood(of):
            member = np.eye(k)[of]
            both = member.T @ pairs @ member
            return classlm._h(both).sum() - classlm._h(both.sum(0)).sum() - classlm._h(both.sum(1)).sum()

        member = np.eye(k)[of]
        member[u] = 0
        both, own = member.T @ pairs @ member, pairs[u, u]
        gain = classlm.gains(both, pairs[u] @ member, pairs[:, u] @ member, own)
        whole = []
        for b in range(k):
            moved = of.copy()
            moved[u] = b
            whole.append(likelihood(moved))
        assert np.allclose(gain - gain[0], np.array(whole) - whole[0])


def test_gains_of_many_words_are_those_of_each():
    rng = np.random.default_rng(8)
    size, classes = 40, 6
    pairs = rng.poisson(0.7, (size, size)).astype(float)
    of = rng.integers(0, classes - 1, size)
    of[-1] = classes - 1
    member = np.eye(classes)[of]
    both = member.T @ pairs @ member
    contexts, want = [], []
    for u in range(size - 1):
        own = pairs[u, u]
        r, c = pairs[u] @ member, pairs[:, u] @ member
        r[of[u]] -= own
        c[of[u]] -= own
        contexts.append([*c, *r, own])
        left = both.copy()
        left[of[u]] -= r
        left[:, of[u]] -= c
        left[of[u], of[u]] -= own
        gain = classlm.gains(left, r, c, own)
        gain[-1] = -np.inf
        want.append(of[u] if gain.max() <= gain[of[u]] + 1e-9 else gain.argmax())
    assert classlm.best_classes(both, np.array(contexts), of[:-1]).tolist() == want


def test_words_beyond_the_table_are_exchanged_too(spark):
    """Two kinds of words with mixed endings: only their neighbours tell them apart."""
    rng = random.Random(5)
    kinds = [[f"{c}{k}" for k in range(900)] for c in "nv"]
    texts = [" ".join(f"the {rng.choice(kinds[0])} did {rng.choice(kinds[1])} and" for _ in range(40)) for _ in range(400)]
    texts += ["n1 n1 n1", "", "once"]
    tokens = [t.split() for t in texts]
    docs = spark.createDataFrame([(t,) for t in texts], "t string").repartition(3)
    _, rest, m = classlm.learn(docs, classes=6, frequent=1200)
    words = {w: classlm._tokens(classlm.pa.array([w]))[0].view("int64")[0] for w in {w for t in tokens for w in t}}
    got = {r.token: (r.c, r["class"]) for r in rest.collect()}
    counts = collections.Counter(w for t in tokens for w in t)
    own = set(m["own"].view("int64").tolist())
    assert {words[w]: n for w, n in counts.items() if words[w] not in own} == {t: c for t, (c, _) in got.items()}
    # classes by their neighbours: hardly any class holds words of both kinds
    of = [collections.Counter(got[words[w]][1] for w in kind if words[w] in got) for kind in kinds]
    assert sum(min(of[0][k], of[1][k]) for k in range(6)) <= 6
    # n and v are the sums over the classes, and every token is in the class of its word
    tags = classlm.tagged(docs, rest, m).collect()
    n = collections.Counter(x for r in tags for x in r.seq)
    assert [n[k] for k in range(6)] == m["n"].astype(int).tolist()
    assert sum(r.n_tokens for r in tags) == sum(m["n"]) == sum(r.known for r in tags)
    assert sum(m["v"]) == len(counts) + 1
    back = {t: k for t, (_, k) in got.items()} | {int(t): int(m["of"][k]) for k, t in enumerate(m["own"].view("int64"))}
    assert sorted(tuple(r.seq) for r in tags) == sorted((*(back[words[w]] for w in t), 5) for t in tokens)
