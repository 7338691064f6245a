"""Comparison of editions against brute force, conversions to USJ, files of USFM, scripts and ids."""

import json
import random
import zipfile
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from lectern.functions import ids
from lectern.operators import compare, scripts, text, usj
from lectern.sources import usfm_files

BY = ["iso", "canon"]
KIND = "iso string, canon string, id string, chapter int, text string"


def _rows(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.choice([40, 300]))) for _ in range(3)]
    rows = []
    for k in range(26):
        own = list(base[k % 3])
        for _ in range(rng.choice([0, 0, 3, 30])):
            own[rng.randrange(len(own))] = rng.choice("xyz")
        rows.append((f"l{k % 2}", "nt", f"e{k:02d}", 0, "".join(own)))
    return rows + [("l0", "nt", "e90", 0, None), ("l0", "nt", "e91", 0, " 1 "), ("l9", "ot", "e92", 0, "alone")]


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_by_brute_force(spark, seed):
    rows = _rows(seed)
    own = compare.members(spark.createDataFrame(rows, KIND).repartition(3), BY)
    scores = compare.pair_scores(own, BY)
    near = compare.closest(own, scores, BY)
    told = {r[2]: (r[0], text.normalized_chars(r[4])) for r in rows if text.normalized_chars(r[4])}
    every = {}
    for a in sorted(told):
        for b in sorted(told):
            if a < b and told[a][0] == told[b][0]:
                every[a, b] = round(SequenceMatcher(None, told[a][1], told[b][1], autojunk=False).ratio(), 4)
    rep = {r.id: r.rep for r in own.collect()}
    assert set(rep) == set(told)
    got = {}
    for r in scores.collect():
        got[r.a, r.b], got[r.b, r.a] = r.score, r.back
    for (a, b), s in every.items():  # every pair is told by its classes, in its own order
        assert (1.0 if rep[a] == rep[b] else got[rep[a], rep[b]]) == s
    best = {}
    for (a, b), s in sorted(every.items()):
        for own_id, other in ((a, b), (b, a)):
            if s > best.get(own_id, (-1, ""))[0]:
                best[own_id] = (s, other)
    assert {r.id: (r.score, r.partner) for r in near.collect()} == best
    want = {tuple(sorted((a, b))) for a, (s, b) in best.items() if s < 1}
    assert {(r.a, r.b) for r in compare.diagnose(own, near, BY).collect()} == want


def test_confirmations_by_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for k in range(12):
        rows.append(("l", "nt", f"e{k:02d}", 0, "the same probe" if k < 9 else f"other {k}"))
        rows += [("l", "nt", f"e{k:02d}", c, rng.choice(["one text", "one test", "quite another"])) for c in (1, 2) if rng.random() < 0.8]
    chapters = spark.createDataFrame(rows, KIND).repartition(3)
    probe = compare.probe_chapters(chapters, BY, [0, 1])
    own = compare.members(chapters.join(probe, [*BY, "chapter"]).select(*BY, "id", "text"), BY)
    got = {(r.a, r.b): (r.confirmed, r.checked, r.differs_on, r.score) for r in compare.confirmed(own, chapters, probe, BY).collect()}
    texts = {(r[2], r[3]): text.normalized_chars(r[4]) for r in rows}

    def brute(a, b):
        seen = [(round(text.similarity(texts[a, c], texts[b, c]), 4), c) for c in (1, 2) if (a, c) in texts and (b, c) in texts]
        worst = min(seen, default=(1.0, None))
        return (bool(seen) and worst[0] == 1, sorted(c for _, c in seen), worst[1] if worst[0] < 1 else None, worst[0])

    for (a, b), told in got.items():
        assert told == brute(a, b)
    # Editions that share all further chapters stand for one another; every pair of 1 is told by its heads.
    shape = {k: tuple(sorted((c, t) for (i, c), t in texts.items() if i == k and c)) for k in {r[2] for r in rows}}
    heads = {}
    for k in sorted(f"e{k:02d}" for k in range(9)):
        heads.setdefault(shape[k], k)
    firsts = sorted(heads.values())
    assert {p for p in got if p[0] in firsts and p[1] in firsts} >= {(a, b) for a in firsts for b in firsts if a < b}
    assert compare.confirmed(own.limit(0), chapters, probe, BY).isEmpty()


def test_usfm_to_usj():
    source = '﻿\\id GEN A book\n\\h Title\n\\c 1\n\\s1 Head\n\\p\n\\v 1 In \\w the|lemma="x" strong="H1"\\w* \\w day|sun\\w*\n day \\f + \\fr 1:1 \\ft a \\+nd Lord\\+nd* note\\f* end.\n\\q1 a|b\n\\v 2-3 \\qt-s |sid="q"\\*said\\qt-e\\*\n\\b\n\\c 2\n\\v 1 x\\*'
    tree = usj.usfm_to_usj(source)
    book, title, one, head, p, q, b, two, last = tree["content"]
    assert (book["code"], book["content"], title["content"], one["number"], head["content"]) == ("GEN", ["A book"], ["Title"], "1", ["Head"])
    assert p["content"][:2] == [{"type": "verse", "marker": "v", "number": "1"}, "In "]
    assert p["content"][2] == {"type": "char", "marker": "w", "content": ["the"], "lemma": "x", "strong": "H1"} and p["content"][4]["lemma"] == "sun"
    note = next(x for x in p["content"] if isinstance(x, dict) and x["type"] == "note")
    assert note["caller"] == "+" and [x["marker"] for x in note["content"]] == ["fr", "ft"] and note["content"][1]["content"][1]["marker"] == "nd"
    assert p["content"][-1] == " end." and q["content"][0] == "a|b " and {"type": "ms", "marker": "qt-s", "sid": "q"} in q["content"]
    assert b["content"] == [] and two["number"] == "2" and last["content"][0]["number"] == "1"
    assert usj.usfm_to_usj(None)["content"] == [] and usj.usfm_to_usj("plain \\w* text")["content"][0]["content"] == ["plain ", " text"]


def test_largest_hunks():
    assert compare.largest_hunks("axbyyycd", "abczzzzzd", n=2) == [("insert", "", "zzzzz"), ("delete", "yyy", "")]
    assert compare.largest_hunks("a", "a") == []


def test_usx_to_usj():
    source = '<usx version="3.0"><book code="GEN" style="id">A</book>\n<chapter number="1" style="c" sid="GEN 1"/>\n<para style="p">\n<verse number="1" style="v" sid="x"/>In <char style="w" lemma="a">the</char> day | one<note style="f" caller="+"><char style="ft">n</char></note>\n<verse eid="x"/></para><chapter eid="GEN 1"/></usx>'
    tree = usj.usx_to_usj(source)
    assert [n["type"] for n in tree["content"]] == ["book", "chapter", "para"]
    para = [x for x in tree["content"][2]["content"] if x != " "]
    assert para[0]["number"] == "1" and para[1:4] == ["In ", {"type": "char", "marker": "w", "lemma": "a", "content": ["the"]}, " day | one"] and para[4]["type"] == "note"
    with pytest.raises(ValueError, match="no USX"):
        usj.usx_to_usj("<usx>")
    assert usj.usx_to_usj(None)["content"] == []


def test_usj_column(spark):
    rows = spark.createDataFrame([(1, "<usx/>"), (2, "<"), (3, None)], "id int, raw string")
    got = {r.id: (r.u.usj, r.u.error) for r in rows.select("id", usj.usj_col("raw", usx=True).alias("u")).collect()}
    assert json.loads(got[1][0])["content"] == [] and got[2][0] is None and "no USX" in got[2][1] and got[3][1] is None


def test_usfm_files(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/01GEN.usfm", "\\id gen Name\n\\c 1\n")
        z.writestr("x/02.usfm", "no id")
        z.writestr("x/read.txt", "\\id EXO")
    (tmp_path / "b.zip").write_text("no zip")
    got = sorted((r.name, r.book) for r in usfm_files.zip_books(spark, str(tmp_path / "*.zip")).collect())
    assert got == [("x/01GEN.usfm", "GEN"), ("x/02.usfm", None)]
    folder = tmp_path / "s/eng/ENGX/PSA"
    folder.mkdir(parents=True)
    (folder / "PSA_117_ENGX.txt").write_text("one\n \ntwo\n")
    (folder / "PSA_051_ENGX.absent").write_text("404\n")
    assert [tuple(r) for r in usfm_files.samples(spark, str(tmp_path / "s")).collect()] == [("eng", "ENGX", "PSA", 117, 2)]
    assert [tuple(r) for r in usfm_files.markers(spark, str(tmp_path / "s")).collect()] == [("eng", "ENGX", "PSA", 51)]


def test_scripts_and_ids(spark):
    assert scripts.script_letters("abc é αβ 中 ʻ ｆ") == {"Latn": 5, "Grek": 2, "Hani": 1, "Zyyy": 1} and scripts.script_letters(None) == {}
    assert [scripts.script_code(x) for x in ("Myanmar (Burmese)", "Syloti Nagri", "a[b", "Roman")] == ["Mymr", "Sylo", None, "Latn"]
    df = spark.createDataFrame([("ab é",), ("plain",), ("12",), (None,)], "t string")
    assert [r.m for r in df.select(scripts.script_letters_col("t").alias("m")).collect()][:3] == [{"Latn": 3}, {"Latn": 5}, {}]
    one = spark.createDataFrame([(None, None)], "a string, b array<string>").select(ids.may_derive(F.col("b")), ids.numeral(F.col("a")), ids.book_order(F.col("b")), ids.resolved_id(F.col("a"), F.col("a"))).first()
    assert tuple(one) == (False, "", "unknown", None)
