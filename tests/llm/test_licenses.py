"""License scans against regular expressions made from the same templates."""

import random
import re

import pytest

from webgrain.llm import licenses as L
from webgrain.llm.queries import QUERIES

WORD = r"[^ ]+ "


def pattern(text):
    """A template as a regular expression over words that each end in a blank."""
    out = []
    for k, piece in enumerate(re.split(r"<<(.*?)>>", text, flags=re.S)):
        plain = lambda x: "".join(f"{re.escape(w)} " for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", x.lower()))
        if k % 2 == 0:
            out.append(plain(piece))
        elif piece == "beginOptional":
            out.append("(?:")
        elif piece == "endOptional":
            out.append(")?")
        elif (m := re.search(r"words=(\d+)\.\.(\d+)", piece)):
            out.append(f"(?:{WORD}){{{m[1]},{m[2]}}}")
        else:
            out.append("(?:" + "|".join(map(plain, re.search("match=(.*)", piece, re.S)[1].split("|"))) + ")")
    return re.compile("".join(out))


PATTERNS = [pattern(t.text) for t in L.TEMPLATES]
lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    found = {}
    for k, p in enumerate(PATTERNS):
        for i in range(len(words)):
            for j in range(len(words), i, -1):
                if p.fullmatch("".join(w + " " for w in words[i:j])):
                    found.setdefault((k, j), i)
                    break
    return len(words), sorted((i, j, k) for (k, j), i in found.items())


def filled(rng, template):
    """Wording that a template accepts, in odd case and punctuation."""
    out = []

    def go(pieces, keep):
        while pieces:
            k, piece = pieces.pop(0)
            if k % 2 == 0:
                words = piece.split()
            elif piece == "beginOptional":
                go(pieces, keep and rng.random() < 0.5)
                continue
            elif piece == "endOptional":
                return
            elif (m := re.search(r"words=(\d+)\.\.(\d+)", piece)):
                words = [f"free{k}" for k in range(rng.randint(int(m[1]), int(m[2])))]
            else:
                words = rng.choice(re.search("match=(.*)", piece, re.S)[1].split("|")).split()
            if keep:
                out.extend(words)

    go(list(enumerate(re.split(r"<<(.*?)>>", template, flags=re.S))), True)
    return " ".join(rng.choice([w, w.upper(), w.lower(), f"{w},", f"\n* {w}"]) for w in out)


@pytest.mark.parametrize("k", range(len(L.TEMPLATES)))
def test_every_filling_is_accepted(k):
    rng, automaton = random.Random(k), L.Automaton(L.TEMPLATES, 8)
    for _ in range(20):
        text = f"before it {filled(rng, L.TEMPLATES[k].text)}"
        words = L.tokens(text)
        found, score = automaton.scan(words)
        assert score == 1.0 and any(x[2] == k and x[1] == len(words) for x in found)
        # one mandatory word changed, or one word too many
        solid = re.split(r"<<beginOptional>>.*<<endOptional>>|<<.*?>>", L.TEMPLATES[k].text, flags=re.S)[0].split()
        if len(solid) > 3:
            changed = text.replace(solid[2], "other").replace(solid[2].lower(), "other").replace(solid[2].upper(), "other")
            assert not any(x[2] == k for x in automaton.scan(L.tokens(changed))[0])


def test_matches_equal_regular_expressions(spark):
    rng = random.Random(5)
    short = [t.text for t in L.TEMPLATES if len(t.text) < 400]
    noise = "under the mit license apache version 2 0 cc by nc sa gnu general public terms of or any later licensed".split()
    rows = []
    for k in range(150):
        parts = [filled(rng, rng.choice(short)) if rng.random() < 0.4 else " ".join(rng.choice(noise) for _ in range(rng.randint(0, 9)))
                 for _ in range(rng.randint(0, 4))]
        rows.append((k, rng.choice([" ", "; ", "\n"]).join(parts)))
    rows += [(None, "Under the MIT license"), (3, rows[3][1]), (200, None), (201, ""), (202, "CC-BY_NC 4.0 éÉ 中文"), (203, "...")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, matches string").repartition(3)
    got = sorted(((r.doc_id, r.n_words, [(m.start, m.stop, m.template) for m in r.matches]) for r in L.scan_licenses(docs).collect()), key=str)
    assert got == sorted(((i, *brute(t)) for i, t in rows), key=str)
    assert sum(bool(x[2]) for x in got) > 60
    assert L.scan_licenses(docs.limit(0)).count() == 0


def test_query_columns(spark, tmp_path):
    head = L.TEMPLATES[4].text.split("<<")[0]
    rows = [(1, "Released under the MIT License. Cc  by-nc 4.0, under the mit license"), (2, head), (3, None), (4, "plain words"),
            (5, "This work is licensed under the GNU General Public License, version 3."), (6, "Licensed under the Apache License, Version 2.0."),
            (7, "é" * 50000 + " x" * 50000 + " cc by nc" * 3)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_license_scans"](spark, str(tmp_path)).collect()}
    assert out[1] == (14, 3, 1, 10, "cc-by-nc,mit", "cc-by-nc,mit", 1.0)
    assert out[2][1:6] == (0, None, None, "", "") and 0.3 < out[2][6] < 0.6
    assert out[3] == (0, 0, None, None, "", "", 0.0)
    assert out[4] == (2, 0, None, None, "", "", 0.0)
    assert out[5][1:] == (0, None, None, "", "gpl-3", 1.0)
    assert out[6][1:] == (1, 3, 3, "apache-2", "apache-2", 1.0)
    assert out[7] == (50010, 3, 50001, 50007, "cc-by-nc", "cc-by-nc", 1.0)


def test_bad_templates(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for text in ("<<beginOptional>>a<<endOptional>>", "a<<beginOptional>>b", "a<<endOptional>>", "<<var;name=x;words=0..2>> a"):
        with pytest.raises(ValueError):
            L.scan_licenses(docs, [L.Template("x", text)])


def test_remembered_steps_are_bounded():
    automaton = L.Automaton([L.Template("x", "a <<var;name=g;words=0..12>> b c d")], 2, memory=8)
    rng = random.Random(1)
    for _ in range(300):
        words = [rng.choice([b"a", b"b", b"c", b"d", b"z"]) for _ in range(40)]
        want = {m.start() for m in re.finditer("(?=a.{0,12}bcd)", b"".join(words).decode())}
        got, score = automaton.scan(words)
        ends = {m.start() + 2 for m in re.finditer("(?<=b)cd", b"".join(words).decode())}
        assert {x[0] for x in got} <= want and {x[1] for x in got} <= {e + 1 for e in ends} | {e for e in ends}
        assert bool(got) == bool(want) and (score == 1.0) == bool(want)
        assert len(automaton.steps) <= 8
