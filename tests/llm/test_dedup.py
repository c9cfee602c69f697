"""Substring, suffix and near-duplicate operators against brute force."""

import hashlib
import random

import pytest

from webgrain.llm.components import components
from webgrain.llm.neardup import near_duplicates
from webgrain.llm.substrings import dedup_substrings, levels
from webgrain.llm.suffixes import dedup_bytes

SCHEMA = "doc_id long, text string, d string, k long, _t string"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(60)] + ["é", "the", "of"]
    make = lambda n: [rng.choice(words) for _ in range(n)]
    passage, long_one = make(35), make(3000)
    rows = [make(rng.randint(0, 60)) for _ in range(25)]
    rows += [make(10) + passage + make(12), passage, passage[3:] + make(5), make(4) + passage[:22], passage * 3]
    rows += [long_one, long_one[100:900] + make(30), ["a"] * 200, ["a"] * 45, ["a", "b"] * 60]
    near = make(120)
    for k in range(12):
        copy = list(near)
        for _ in range(k % 4):
            copy[rng.randrange(120)] = "changed"
        rows.append(copy)
    blanks = [" ", "\n", "\t ", "\x0b", "\x0c\r"]
    made = ["".join(w + rng.choice(blanks) for w in r) for r in rows]
    made += [made[3], made[30], None, "", " \n", "one", "one", "One two", "x y z", " "]
    return made


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(3 * k if k % 2 else 1000 - k, t, "x", 1, "y") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def brute(rows, window, units_of, join):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        units = units_of(text or "")
        gone = [False] * len(units)
        for p in range(len(units) - window + 1):
            key = tuple(units[p:p + window])
            if key in seen:
                gone[p:p + window] = [True] * window
            seen.add(key)
        rest = join(units, gone)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[doc_id] = (len(units), sum(gone), runs, hashlib.sha256(rest).hexdigest())
    return out


@pytest.mark.parametrize("window,start", [(20, 5), (20, 10), (21, 5), (5, 5), (13, 3)])
def test_word_windows(docs, window, start):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows, window, lambda t: t.encode().split(),
                 lambda u, g: b" ".join(w for w, x in zip(u, g) if not x))
    got = {r.doc_id: r for r in dedup_substrings(docs, window, start).collect()}
    assert {k: (v.n_words, v.n_removed, v.kept_sha256) for k, v in got.items()} == {
        k: (v[0], v[1], v[3]) for k, v in want.items()}
    assert all(hashlib.sha256(v.kept_text.encode()).hexdigest() == v.kept_sha256 for v in got.values())


@pytest.mark.parametrize("window,start", [(100, 25), (40, 16), (33, 8)])
def test_byte_windows(docs, window, start):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows, window, lambda t: t.encode(), lambda u, g: bytes(c for c, x in zip(u, g) if not x))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in dedup_bytes(docs, window, start).collect()}
    assert got == want


def test_levels():
    assert levels(20, 5) == [5, 10]
    assert levels(21, 5) == [5, 10]
    assert levels(80, 5) == [5, 10, 20, 40]
    assert levels(5, 5) == [5]


def test_ids_that_are_null_or_repeated(spark):
    text = " ".join(f"v{k}" for k in range(30))
    rows = [(None, text), (7, text), (7, text), (7, text + " more"), (None, None)]
    got = [(r.doc_id, r.n_words, r.n_removed) for r in dedup_substrings(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    kept = sorted(x for x in got if x[0] == 7)
    # equal rows are one document; of the two texts of id 7 the one with the lower hash comes first
    assert len(got) == 5 and got.count((None, 30, 30)) == 1 and got.count((None, 0, 0)) == 1
    assert kept in ([(7, 30, 0), (7, 30, 0), (7, 31, 30)], [(7, 30, 30), (7, 30, 30), (7, 31, 0)])


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert dedup_substrings(none).count() == 0
    assert dedup_bytes(none).count() == 0
    assert near_duplicates(none).count() == 0


def near_brute(rows, words, percent):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = {}
    for i, t in rows:
        w = (t or "").encode().translate(low).split()
        sets[i] = {tuple(w)} if 0 < len(w) < words else {tuple(w[k:k + words]) for k in range(len(w) - words + 1)}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize("words,percent,small", [(3, 85, 48), (5, 80, 48), (5, 80, 3)])
def test_near_duplicates(docs, words, percent, small):
    want = near_brute([(r.doc_id, r.text) for r in docs.collect()], words, percent)
    got = near_duplicates(docs, words, percent, small=small).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == want


def test_near_duplicates_with_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (2, "A B C D E F"), (9, None)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.component_id, r.kept) for r in got) == sorted(
        [(-1, None, True), (4, 2, False), (4, 2, False), (2, 2, True), (9, 9, True)])


def test_components(spark):
    links = [(5, 4), (4, 3), (3, 9), (20, 21), (21, 21), (7, 7), (30, 31), (31, 32), (32, 33), (33, 34), (34, 35)]
    got = {r.v: r.c for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {3: 3, 4: 3, 5: 3, 9: 3, 20: 20, 21: 20, 7: 7, **{k: 30 for k in range(30, 36)}}


def labels_of(spark, sets):
    rows = [(k, " ".join(s)) for k, s in enumerate(sets)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 1, 85).collect()
    return [r.component_id for r in sorted(got, key=lambda r: r.doc_id)]


def test_pairs_hidden_in_a_template_group(spark):
    own = lambda k, n: [f"o{k}x{i}" for i in range(n)]
    form = [f"form{i}" for i in range(160)]
    sets = [form + own(k, 30) for k in range(2000)]  # similarity 0.73 each
    want = list(range(2000))
    for k in range(0, 400, 10):
        gone = 15 if k % 20 else 16  # similarity 0.854, or 0.845
        sets.append(form + own(k, 30)[gone:] + own(5000 + k, gone))
        want.append(k if gone == 15 else len(want))
    assert labels_of(spark, sets) == want


def test_documents_linked_to_one_copy_of_a_large_group(spark):
    page = [f"page{i}" for i in range(200)]
    changed = lambda s, k, n: s[n:] + [f"c{k}x{i}" for i in range(n)]
    sets = [changed(page, k, 2) for k in range(800)]
    want = [0] * 800
    for k in range(800, 1400, 10):
        copy = changed(page, k, 7)
        sets += [copy, changed(copy, k + 1, 15), changed(page, k + 2, 22)]  # of the last two, one is linked to the copy
        want += [0, 0, len(want) + 2]
    assert labels_of(spark, sets) == want


def test_byte_zones_parts_and_hot_passages(spark):
    """Zones that differ on one side, at both ends and inside, periodic texts, a passage in a third
    of the rows, texts longer than a slice."""
    rng = random.Random(11)
    draw = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    base, hot, long_one = draw(700), draw(260), draw(300_000)
    rows = [base]
    for k in range(60):
        copy = list(base[rng.randrange(200):500 + rng.randrange(200)])
        for _ in range(k % 5):
            copy[rng.randrange(len(copy))] = "é"
        rows.append(draw(rng.randrange(40)) + "".join(copy))
    rows += [draw(50) + hot[rng.randrange(30):] + draw(50) for _ in range(40)]
    rows += ["ab" * 130, "abc" * 90, "a" * 99, "a" * 100, "a" * 101, long_one, draw(9) + long_one[1000:1400], None, ""]
    docs = spark.createDataFrame([(k * 7 % 1009, t) for k, t in enumerate(rows)], "doc_id long, text string").repartition(6)
    for window, start in ((100, 25), (30, 5)):
        want = brute([(k * 7 % 1009, t) for k, t in enumerate(rows)], window, lambda t: t.encode(),
                     lambda u, g: bytes(c for c, x in zip(u, g) if not x))
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in dedup_bytes(docs, window, start).collect()}
        assert got == want


def test_byte_ids_that_are_null_or_repeated(spark):
    text = "".join(chr(97 + k * k * 7 % 23) for k in range(60)) + "".join(chr(65 + k * k * 5 % 26) for k in range(90))
    rows = [(None, text), (7, text), (7, text), (7, text + " more"), (None, None), (None, "")]
    got = [(r.doc_id, r.n_bytes, r.n_removed) for r in dedup_bytes(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(got) == 6 and got.count((None, 150, 150)) == 1 and got.count((None, 0, 0)) == 2
    assert sorted(x for x in got if x[0] == 7) in (
        [(7, 150, 0), (7, 150, 0), (7, 155, 150)], [(7, 150, 150), (7, 150, 150), (7, 155, 0)])
