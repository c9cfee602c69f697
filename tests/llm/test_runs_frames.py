"""Periodic runs and fill-in-the-middle frames."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from webgrain.llm import frames, runs
from webgrain.llm.queries import QUERIES


def brute_runs(w):
    """All maximal stretches by trying every period and every start."""
    n, found = len(w), []
    smallest = lambda s, m: next(p for p in range(1, m + 1) if all(w[i] == w[i + p] for i in range(s, s + m - p)))
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and smallest(i, j + q - i) == q:
                found.append((i, j + q - i, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_plant(doc_id, w):
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def brute_row(doc_id, text):
    w = brute_plant(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    found = brute_runs(w)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def texts(seed, n):
    rng = random.Random(seed)
    made = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            unit = [rng.choice("ab") for _ in range(rng.randint(1, 9))]
            parts += unit * rng.randint(1, 8) + unit[:rng.randint(0, len(unit))]
            parts += [rng.choice("abcd") for _ in range(rng.randint(0, 6))]
        made.append(" ".join(parts))
    return made


def test_runs_equal_brute_force():
    made = [t.split() for t in texts(1, 400)]
    made += [["x"] * k for k in range(9)] + [("x y " * k).split() for k in range(6)] + [list("abcabcabcabcab" * 3)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in made])])
    numbers = {w: k for k, w in enumerate(sorted({w for t in made for w in t}))}
    got = runs.find_runs(np.array([numbers[w] for t in made for w in t], np.int64), offsets)
    want = [(s + int(a), m, q) for t, a in zip(made, offsets) for s, m, q in brute_runs(t)]
    assert got == sorted(want, key=lambda r: (r[0], r[2]))
    assert len(want) > 300
    assert runs.find_runs(np.zeros(0, np.int64), np.zeros(1, np.int64)) == []


def test_long_periods_far_apart():
    rng = random.Random(2)
    unit = [rng.randrange(1000) for _ in range(3000)]
    w = np.array([1, 2, 3] + unit * 4 + unit[:5] + [7, 8] * 500, np.int64)
    assert runs.find_runs(w, np.array([0, len(w)])) == [(3, 12005, 3000), (12008, 1000, 2)]
    # a wide gap between copies is no run
    w = np.array(unit * 3 + [-5 % 997] + unit, np.int64)
    assert runs.find_runs(w, np.array([0, len(w)])) == []


def test_many_seeds_of_one_stretch_are_extended_once(monkeypatch):
    calls = []
    plain = runs._stretch
    monkeypatch.setattr(runs, "_stretch", lambda *a: calls.append(a) or plain(*a))
    w = np.array([1, 2] * 20000, np.int64)
    assert runs.find_runs(w, np.array([0, len(w)])) == [(0, 40000, 2)]
    assert len(calls) == 1


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    rows = [(k, t, 1) for k, t in enumerate(texts(3, 300))]
    rows += [(None, "a b a b a b a b", 1), (None, None, 2), (5, rows[5][1], 3), (400, "", 1), (401, None, 1), (402, " \n\t", 1),
             (403, "é\x0b" * 9 + "ü z", 1), (404, "x" * 70000, 1), (405, "long " * 30000, 1), (406, "a <S> b", 1),
             (407, "<<P" + "M>" * 40, 1), (408, "中文 text 😀 " * 20000, 1)]
    spark.createDataFrame(rows, "doc_id long, text string, n_runs int").repartition(3).write.parquet(f"{path}/documents.parquet")
    return path, rows


def test_periodic_runs_query(spark, folder):
    path, rows = folder
    out = QUERIES["op13_periodic_runs"](spark, path)
    got = sorted((tuple(r) for r in out.collect() if r.doc_id not in (405, 408)), key=str)
    assert got == sorted((brute_row(i, t) for i, t, _ in rows if i not in (405, 408)), key=str)
    assert [tuple(r)[1:6] for r in out.filter("doc_id = 405").collect()] == [(1, 0, 30000, 1, 30000000)]
    assert [tuple(r)[1:6] for r in out.filter("doc_id = 408").collect()] == [(1, 0, 60000, 3, 20000000)]


def test_runs_on_empty_and_odd_tables(spark):
    none = spark.createDataFrame([], "doc_id string, text string, runs int, collapsed int")
    assert runs.collapse_runs(none).count() == 0 and runs.planted(none).count() == 0
    one = spark.createDataFrame([("k", "a a a a a a a b", 1)], "doc_id string, text string, runs int").repartition(1)
    row = runs.collapse_runs(one).first()
    assert (row.doc_id, row.n_words, [tuple(x) for x in row.runs], row.collapsed) == ("k", 8, [(0, 7, 1)], "a b")


def brute_fim(doc_id, text):
    t = text or ""
    n, h = len(t), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not t or re.search("<[PSM]>", t) or h3 % 100 >= 90:
        return n, "plain", None, None, t
    p, m, s = t[:a], t[a:b], t[b:]
    return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("units", [7, frames.UNITS])
def test_fill_in_middle_round_trip(spark, folder, units):
    path, rows = folder
    rows = [r for r in rows if units > 7 or len(r[1] or "") < 5000]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form int").repartition(3)
    made = frames.fill_in_middle(docs, units=units)
    out = made.select("*", frames.unpack(F.col("output")).alias("whole"),
                      frames.unpack(frames.restore(F.col("output"), F.col("form"), units)).alias("back"),
                      frames.sha256(F.col("output")).alias("sha")).collect()
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.whole, r.back, r.sha) for r in out), key=str)
    want = sorted(((i, *(x := brute_fim(i, t)), t or "", hashlib.sha256(x[-1].encode()).hexdigest()) for i, t, _ in rows), key=str)
    assert got == want
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    for r in out:
        assert all(f.units <= units for f in r.output)
        assert [f.first for f in r.output] == [sum(g.units for g in r.output[:k]) for k in range(len(r.output))]
    assert frames.fill_in_middle(docs.limit(0)).count() == 0


def test_only_cut_frames_are_decompressed(monkeypatch):
    import zstandard

    text = "0123456789" * 10
    w = frames.Writer(10, zstandard.ZstdCompressor())
    w.add(text)
    held, opened = w.close(), []
    plain = frames.Frames.text
    monkeypatch.setattr(frames.Frames, "text", lambda self, f: opened.append(f["first"]) or plain(self, f))
    parts = list(frames.Frames(held, zstandard.ZstdDecompressor()).span(15, 62))
    assert opened == [10, 60] and parts[0] == "56789" and parts[-1] == "01" and parts[1] is held[2]


def test_marks_across_frame_ends():
    import zstandard

    w = frames.Writer(2, zstandard.ZstdCompressor())
    w.add("<P><<S>M><M>")
    assert frames.Frames(w.close(), zstandard.ZstdDecompressor()).marks(frames.ORDERS["psm"]) == [0, 4, 9]
