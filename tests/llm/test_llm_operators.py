"""Each operator on small fixtures, against brute force, round trips or plain statements of the result."""

import hashlib
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lectern.llm import bpe, chat, common, exact_dedup, langid, licenses, ngram_join, packing, quality, sentence_spans, token_files, tokens

PATH = tokens.default_path()
ODD = [None, "", "   \n\t", "a", "a", "x" * 5000, "it's <|endoftext|> Été ΣΑΣ", "日本語 ½ \x00\x07", "ab " * 3000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


# --- chat formatting


def _turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, example string")


def test_chat_round_trip(spark):
    hard = ["\\### Assistant: </turn> ok", "\\\\b\\e\\h", "### user: a</turn>\n### assistant: b", "", None, "</turn", "\n", "#" * 9 + " "]
    rows = [(c, t, "assistant" if t % 2 else "user: ### </turn>", hard[(c + t) % len(hard)], "x") for c in range(8) for t in range(5)]
    made = chat.digests(chat.examples(_turns(spark, rows))).collect()
    assert len(made) == 8
    for r in made:
        own = [(x[2], x[3] or "") for x in rows if x[0] == r.conv_id]
        loss = "".join(t for role, t in own if role == "assistant")
        assert r.n_turns == 5
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_examples_are_prefixes(spark):
    rows = [(1, 0, "system", "s", ""), (1, 1, "user", "q", ""), (1, 2, "assistant", "r1", ""), (1, 3, "user", "q2", ""), (1, 4, "assistant", "r2", ""), (1, 5, "user", "end", "")]
    out = sorted(chat.examples(_turns(spark, rows)).collect(), key=lambda r: r.example)
    assert [r.target_turn for r in out] == [2, 4, None]
    assert [r.formatted[r.loss_start : r.loss_start + r.loss_length] for r in out] == ["r1", "r2", ""]
    assert all(b.formatted.startswith(a.formatted) for a, b in zip(out, out[1:], strict=False))


def test_chat_empty_and_nulls(spark):
    assert chat.examples(_turns(spark, [])).count() == 0
    out = chat.digests(chat.examples(_turns(spark, [(None, None, None, None, None), (None, None, None, None, None)]))).collect()
    assert [(r.conv_id, r.n_turns, r.loss_chars) for r in out] == [(None, 2, 0)]


# --- licenses


def test_license_found_and_missed(make):
    notice = licenses.TEMPLATES["GPL-3.0"]
    filler = " ".join(["the public work of a license is under version"] * 40)
    rows = [(1, f"{filler}\n{notice}\n{filler}"), (2, filler), (3, None), (4, ""), (5, notice.replace("General", "Genral")), (None, "Released under the MIT License."), (6, licenses.TEMPLATES["MIT-permission"].upper())]
    got = {r.doc_id: r for r in licenses.best_license(licenses.scan(make(rows))).collect()}
    assert got[1].license == "GPL-3.0" and got[1].coverage == 1.0
    assert got[2].license is got[3].license is got[4].license is None
    assert got[5].license == "GPL-3.0" and 0.8 <= got[5].coverage < 1
    assert got[None].license == "MIT" and got[6].license == "MIT-permission"


def test_license_repeated_and_all_hits(make):
    t = licenses.TEMPLATES
    gpl, mit, n = t["GPL-3.0"], t["MIT-permission"], len(licenses.words_of(t["GPL-3.0"]))
    filler = " ".join(f"word{k} the public license" for k in range(100))
    rows = [(1, f"{filler} {gpl} {filler} {gpl} {filler}"), (2, f"{gpl} {gpl} {gpl}"), (3, f"{mit}\n{filler}\n{gpl}\n{mit}")]
    rows += [(4, " ".join(gpl.replace("This work", x).replace("General", y) for x, y in (("A book", "General"), ("It", "General"), ("This work", "Genral"))))]
    got = {r.doc_id: r for r in licenses.best_license(licenses.scan(make(rows))).collect()}
    spans = lambda k, name: sorted((h.start, h.end, h.coverage) for h in got[k].hits if h.license == name)
    assert spans(1, "GPL-3.0") == [(400, 400 + n, 1.0), (800 + n, 800 + 2 * n, 1.0)]
    assert spans(2, "GPL-3.0") == [(k * n, (k + 1) * n, 1.0) for k in range(3)]
    assert len(spans(3, "MIT-permission")) == 2 and len(spans(3, "GPL-3.0")) == 1 and got[3].n_hits == 3
    assert len(spans(4, "GPL-3.0")) == 3
    assert got[1].license == "GPL-3.0" and got[1].start == 400 and got[1].n_hits == len(got[1].hits)


def test_license_edges(spark, make):
    t = licenses.TEMPLATES
    long = "some words of a long text " * 40_000 + t["GPL-3.0"]
    rows = [(1, t["MIT"]), (1, t["MIT"]), (1, None), (2, long), (3, f"{t['MIT']} {t['CC-BY-NC-4.0']} {t['MIT']}")]
    docs = make(rows).withColumns({"license": F.lit("x"), "coverage": F.lit(9), "hits": F.lit("y")})
    got = licenses.best_license(licenses.scan(docs)).collect()
    assert sorted((r.doc_id, r.license or "", r.n_hits) for r in got)[:3] == [(1, "", 0), (1, "MIT", 1), (1, "MIT", 1)]
    by = {r.doc_id: r for r in got}
    assert by[2].license == "GPL-3.0" and by[2].start == 240_000
    # Ties in coverage: the longer template, then the name, then the earlier place.
    assert [(h.license, h.start) for h in by[3].hits] == [("CC-BY-NC-4.0", 5), ("MIT", 0), ("MIT", 10)]
    assert licenses.scan(make([])).count() == 0
    same = {"b": "one two three", "a": "one two three"}
    assert [h.license for h in licenses.scan(make([(1, "one two three")]), same).first().hits] == ["a", "b"]


@settings(max_examples=200, deadline=None)
@given(st.permutations(range(24)), st.integers(3, 12), st.sampled_from([0.5, 0.8, 1.0]))
def test_license_coverage_by_brute_force(order, size, coverage):
    # Of distinct words the alignment is a longest increasing subsequence: try every window.
    template = [f"t{k}" for k in range(size)]
    words = [f"t{k}" if k < size else f"f{k}" for k in order]
    reach = 2 * size
    best = max(_lis([int(w[1:]) for w in words[i : i + reach] if w[0] == "t"]) for i in range(len(words)))
    hits = licenses.Scanner({"t": " ".join(template)}, coverage)(" ".join(words))
    assert (hits[0][1] if hits else None) == (best / size if best >= coverage * size else None)


def _lis(values):
    best = [1] * len(values)
    for k in range(len(values)):
        best[k] = 1 + max([best[j] for j in range(k) if values[j] < values[k]], default=0)
    return max(best, default=0)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=25))
def test_patience_is_longest(values):
    found = [values[k] for k in licenses.increasing(values)]
    assert found == sorted(set(found)) and len(found) == _lis(values)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), max_size=20), st.lists(st.sampled_from("abcdefgh"), max_size=20))
def test_alignment_is_increasing(a, b):
    pairs = licenses.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
    if a == b:
        assert len(pairs) == len(a)


# --- BPE


def test_bpe_digests(spark, make, library):
    rows = [*enumerate(ODD), (None, "no id"), (4, "again"), (50, "long words and more " * 30_000)]
    got = Counter(tuple(r) for r in bpe.encode_digests(make(rows), PATH).collect())
    sha = lambda x: hashlib.sha256(x).hexdigest()
    want = Counter()
    for k, t in rows:
        ids = _ids(library, t)
        want[k, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False).encode())] += 1
    assert got == want
    assert bpe.encode_digests(make([]), PATH).count() == 0
    assert bpe.encode_digests(spark.createDataFrame([("a", "x")], "doc_id string, text string"), PATH).first().doc_id == "a"


def test_bpe_as_the_library(make, library, spark, sf):
    texts = [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(60).collect()] + ODD
    texts += ["".join(chr(c) for c in range(k, k + 97)) for k in range(1, 0x2000, 97)]
    rows = list(enumerate(texts))
    got = {r.doc_id: (bytes(r.ids), r.decoded) for r in bpe.encode_documents(make(rows), PATH).collect()}
    plain = tokens.encoder(PATH)
    for k, text in rows:
        ids = _ids(library, text)
        assert np.frombuffer(got[k][0], "<u4").tolist() == ids
        assert got[k][1] == library.decode(ids, skip_special_tokens=False)
        assert plain(text) == got[k][0]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcdehilnorst", min_size=1, max_size=40))
def test_bpe_words(word):
    e = tokens.encoder(PATH, bpe.PrefixEncoder)
    assert e.encode_letters(word) == e.tokenizer.encode(word, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="'stmdrevlxTÉœſ1½²!<|> \n\t\r日", max_size=30)), max_size=6))
def test_texts_split_together(texts):
    e = tokens.encoder(PATH)
    assert list(e.encode_all(texts)) == [np.array(e.tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_texts_split_together_in_blocks(library, spark, sf, monkeypatch):
    texts = [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(60).collect()] + ODD
    texts += ["".join(chr(c) for c in range(k, k + 97)) for k in range(1, 0x2000, 97)]
    texts += ["we'll say\nit's 'tis!'s " * 90, "it's\rnot\tcut" * 90, "y" * 1500 + " " + "z" * 700, "the <|endoftext|> " * 80, "日本 語 " * 300]
    want = [np.array(_ids(library, t), "<u4").tobytes() for t in texts]
    for block, words in ((tokens.BLOCK, tokens.TABLE_WORDS), (1000, 300), (1, 1)):
        monkeypatch.setattr(tokens, "BLOCK", block)
        monkeypatch.setattr(tokens, "TABLE_WORDS", words)
        assert list(tokens.Encoder(PATH).encode_all(texts)) == want


def test_words_are_those_of_the_pattern():
    plain = "".join(chr(c) for c in range(tokens._LAST + 1) if not tokens.UNUSUAL.match(chr(c)))
    rng = random.Random(3)
    for text in [plain, plain[::-1], *["".join(rng.choices(plain + "'' stmdrevl" * 9, k=500)) for _ in range(60)]]:
        begins, words = tokens.split_bytes(tokens.letter_bytes(text))
        found = list(tokens.WORD.finditer(text.lower()))
        assert begins.tolist() == [m.start() for m in found]
        assert [b.decode("latin-1") for b in words.to_pylist()] == [tokens.letter_bytes(m.group()).decode("latin-1") for m in found]


def test_packing_takes_less_time_than_text_by_text(make, monkeypatch):
    # Pieces were made text by text, every word looked up by itself, at 405 CPU seconds a GB of a budget of 400.
    rng = random.Random(4)
    common = ["".join(rng.choices("abcdefgh", k=7)) for _ in range(3000)]
    docs = [" ".join(rng.choices(common, k=600)) for _ in range(800)]
    rows = pa.RecordBatch.from_pydict({"doc_id": list(range(len(docs))), "text": docs})

    # The function that mapInArrow gets, run here so that its CPU time is this process's.
    held = []
    monkeypatch.setattr(packing, "in_arrow", lambda df, run, schema: held.append(run) or df)
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    packing.pieces(make([]), PATH, 2048, 0)
    e, took = tokens.encoder(PATH), {}
    for name, make_ids in (("packing", lambda: list(held[0]([rows]))), ("text by text", lambda: [zlib.crc32(e(t)) for t in docs])):
        make_ids()
        began = time.process_time()
        make_ids()
        took[name] = time.process_time() - began
    assert took["packing"] < 0.75 * took["text by text"], took


# --- n-gram join


def _brute(rows, n, percent):
    sets = {}
    for k, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[k] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    up = {k: k for k in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {k: (len(s), find(k)) for k, s in sets.items()}


def _near_rows(seed, many=50):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(300)]
    passage = [rng.choice(vocab) for _ in range(20)]
    rows = []
    for k in range(many):
        base = [rng.choice(vocab) for _ in range(rng.choice([2, 4, 30, 120]))]
        if k % 3 == 0:
            base += passage
        for c in range(rng.choice([1, 1, 4])):
            w = list(base)
            for _ in range(rng.choice([0, 1, 2])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((len(rows), " ".join(w) if c % 2 else "  ".join(w).upper()))
    return rows


@pytest.mark.parametrize(("n", "percent", "block", "cell"), [(4, 85, 2000, 500), (5, 80, 2, 2)])
def test_ngram_join_is_exact(make, monkeypatch, n, percent, block, cell):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "CELL", cell)
    rows = [*_near_rows(n), (900, None), (901, ""), (902, " "), (903, "one"), (904, "ONE")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_classes(make(rows), n, percent).collect()}
    assert got == _brute(rows, n, percent)


def test_ngram_join_of_very_long_texts(make, monkeypatch):
    # Few sets, but more elements than a block and a cell may have; the keys of both are hot.
    monkeypatch.setattr(ngram_join, "BLOCK_ELEMENTS", 3000)
    monkeypatch.setattr(ngram_join, "CELL_ELEMENTS", 1500)
    monkeypatch.setattr(common, "HOT", 1 / 10)
    rng = random.Random(6)
    base = [f"w{rng.randrange(5000)}" for _ in range(30_000)]
    change = lambda n: " ".join(f"x{k}" if k % (30_000 // n) == 7 else w for k, w in enumerate(base))
    rows = [(1, " ".join(base)), (2, change(300)), (3, change(900)), (4, change(4000)), (5, change(300)), (6, " ".join(base[:15_000])), (7, " ".join(base))]
    rows += [(k, " ".join(base[100 * k : 100 * k + 60])) for k in range(10, 40)] + [(k, " ".join(base[100 * (k - 50) : 100 * (k - 50) + 59])) for k in range(60, 90)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_classes(make(rows), 4, 85).collect()}
    assert got == _brute(rows, 4, 85)


def test_ngram_join_deals_cells_to_rounds(make, monkeypatch):
    """Sets of a large block that are not linked with its lead are never all copied to their cells at once."""
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    monkeypatch.setattr(ngram_join, "CELL", 2)
    copied, cells = [], ngram_join._cells

    def counted(rows, percent):
        copied.append(rows.agg(F.sum(F.size("elements"))).first()[0] or 0)
        return cells(rows, percent)

    monkeypatch.setattr(ngram_join, "_cells", counted)
    rnd = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for k in range(40):  # near copies; of each, one that is nearer
        words = [f"x{k}-{i}" if rnd.random() < 0.03 else w for i, w in enumerate(base)]
        texts += [" ".join(words), " ".join([*words, "end"])]
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_classes(make(rows), 4, 85).collect()}
    assert got == _brute(rows, 4, 85)
    volume = sum(n for n, _ in got.values())
    assert len(copied) > 4 and max(copied) <= 4 * volume < sum(copied)


def test_common_shingles_are_counted_in_place():
    x = np.random.default_rng(1).integers(0, 1 << 18, 1 << 20)
    for least in (1.0, 4.5, 8.0):
        values, times = np.unique(x, return_counts=True)
        own = x.copy()
        tracemalloc.start()
        got = ngram_join._often(own, least)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert got[0].tolist() == values[times > least].tolist() and got[1].tolist() == times[times > least].tolist()
        if least == 8.0:  # few are common
            assert peak < x.nbytes / 2
    empty = ngram_join._often(x[:1].copy(), 4.0)
    assert len(empty[0]) == len(empty[1]) == 0


def test_ngram_join_edges(make):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(5, text), (5, text), (None, text), (7, text + " more"), (None, "alone here now and then")]
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in ngram_join.near_classes(make(rows)).collect())
    assert got == [(-1, -1), (-1, 5), (5, 5), (5, 5), (7, 5)]
    assert ngram_join.near_classes(make([])).count() == 0
    kept = ngram_join.keep_one(make(rows))
    assert kept.columns == make(rows).columns and kept.where("doc_id = 7").count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 40), min_size=1, max_size=30), min_size=2, max_size=25), st.sampled_from([50, 80, 85]), st.booleans())
def test_trie_links_all_classes(sets, percent, led):
    arrays = [np.array(sorted(s), np.int64) for s in sets]
    linked = [led and k < 2 for k in range(len(sets))]
    links = ngram_join.join_sets(list(range(len(sets))), arrays, percent, linked)

    def classes(edges):
        up = list(range(len(sets)))
        for a, b in edges:
            a, b = up[a], up[b]
            up = [min(a, b) if x in (a, b) else x for x in up]
        return up

    start = [(0, 1)] if led else []
    want = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    assert classes(start + links) == classes(start + want)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 130)]
    got = {r.node: r.label for r in common.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    up = {x: x for e in edges for x in e}
    for _ in up:
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    assert got == {x: y for x, y in up.items() if any(x in e and e[0] != e[1] for e in edges)}


# --- quality rules


def _measures(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    win = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    rep = {k + j for k in range(len(w) - 2) if win[tuple(w[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep))


def test_quality_measures(make):
    texts = [*ODD, "a b c d a b c", "x y\nx y\n\n \nx y", "# $ % word|<>&*", "a b a b a b a b", "\x0b\x0c\x1c x\x85y"]
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.measures(make(list(enumerate(texts))), "doc_id").collect()}
    assert got == {k: _measures(t) for k, t in enumerate(texts)}


def test_binomial_tail(spark):
    from math import comb

    rows = [(k, n) for n in (1, 20, 300, 5000) for k in (0, 1, 3, 40) if k <= n]
    got = spark.createDataFrame(rows, "k bigint, n bigint").select("k", "n", quality.binomial_tail(F.col("k"), F.col("n"), 0.025).alias("p")).collect()
    for r in got:
        want = 1.0 if r.k >= 0.025 * r.n else sum(comb(r.n, i) * 0.025**i * 0.975 ** (r.n - i) for i in range(r.k + 1))
        assert r.p == pytest.approx(want, rel=1e-9)


def test_quality_limits_false_rejection(spark, make):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    good = [(k, " ".join(word() for _ in range(60)), "en") for k in range(900)]
    bad = [(k, " ".join("###" + word() for _ in range(60)), "en") for k in range(900, 950)]
    few = [(k, " ".join("#" + word() for _ in range(60)), "fr") for k in range(950, 960)]
    rows = [*good, *bad, *few, (990, None, None), (None, good[0][1], None)]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(900)] + [(k, 0, 0) for k in range(900, 950)] + [(None, 1, 0), (5, None, None)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in quality.judge(make(rows), labels).collect()}
    assert all(got[k].kept for k in range(900)) and not any(got[k].kept for k in range(900, 950))
    assert all(got[k].kept for k in range(950, 960))  # too few labels to reject anything
    assert got[990].base_failed and not got[990].kept and got[None].kept
    assert quality.judge(make([]), labels).count() == 0
    odd = [(1, "word " * 300_000, "en"), (2, good[0][1], ""), (2, good[0][1], ""), (3, good[1][1], None)]
    found = sorted((r.doc_id, r.n_words, r.kept) for r in quality.judge(make(odd), labels).collect())
    assert found == [(1, 300_000, False), (2, 60, True), (2, 60, True), (3, 60, True)]


# --- packing


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), max_size=20), st.sampled_from([None, 3]), st.sampled_from([None, 1500]), st.sampled_from(["norm", "dot"]))
def test_plan_keeps_all_constraints(histogram, documents, attention, rule):
    if attention and any(x * x > attention for x in histogram):
        attention = None
    steps = packing.plan(histogram, 50, documents, attention, rule=rule)
    bins, placed = defaultdict(list), defaultdict(set)
    for length, rank, count, first, offset in steps.tolist():
        for k in range(count):
            bins[first + k].append((offset, length))
            assert rank + k not in placed[length]
            placed[length].add(rank + k)
    assert {x: set(range(n)) for x, n in histogram.items()} == dict(placed)
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [sum(x for _, x in own[:k]) for k in range(len(own))]
        assert sum(x for _, x in own) <= 50
        assert not documents or len(own) <= documents
        assert not attention or sum(x * x for _, x in own) <= attention


def test_pack_documents(make, library):
    rows = [*enumerate(ODD), (None, "null id"), (1, "again")]
    out = packing.pack(make(rows), PATH, capacity=64).collect()
    ids = {k: [*_ids(library, t), 0] for k, t in rows if k not in (None, 1)}
    for r in out:
        if r.doc_id in ids:
            own = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
            assert len(own) == r.length and zlib.crc32(own.tobytes()) == r.ids_crc32 and r.start == 64 * r.piece
    assert sum(r.length for r in out if r.doc_id in ids) == sum(map(len, ids.values()))
    by = defaultdict(list)
    for r in out:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        own.sort()
        assert [o for o, _ in own] == [sum(x for _, x in own[:k]) for k in range(len(own))] and sum(x for _, x in own) <= 64
    assert len(by) <= -(-sum(r.length for r in out) // 64) + 1
    assert packing.pack(make([]), PATH).count() == 0


def test_pack_under_every_capacity(make):
    rng = random.Random(9)
    rows = [(k, " ".join(rng.choice("abcdefgh") for _ in range(rng.choice([0, 1, 3, 9, 20, 200])))) for k in range(150)] + [(k, "a b") for k in range(150, 200)]
    for limits in ({"documents": 3}, {"attention": 1800}, {"documents": 4, "attention": 1500, "rule": "dot"}):
        if "attention" in limits:
            limits = {**limits, "capacity": 38}
        out = packing.pack(make(rows), PATH, **{"capacity": 64, **limits}).collect()
        bins = defaultdict(list)
        for r in out:
            bins[r.sequence_id].append((r.offset, r.length))
        for own in bins.values():
            own.sort()
            assert [o for o, _ in own] == [sum(x for _, x in own[:k]) for k in range(len(own))]
            assert sum(x for _, x in own) <= limits.get("capacity", 64) and len(own) <= limits.get("documents", 64)
            assert sum(x * x for _, x in own) <= limits.get("attention", 1 << 20)
        assert any(len(own) == limits.get("documents") for own in bins.values()) or "documents" not in limits
        pieces = [(r.doc_id, r.piece) for r in out]
        assert len(pieces) == len(set(pieces)) and {k for k, _ in pieces} == {k for k, _ in rows}


# --- token files


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 10**6), max_size=700), st.data())
def test_elias_fano(values, data):
    values.sort()
    ef = token_files.EliasFano.build(np.array(values, np.int64))
    assert [ef.select(k) for k in range(len(values))] == values
    a = data.draw(st.integers(0, len(values)))
    b = data.draw(st.integers(a, len(values)))
    assert ef.range(a, b).tolist() == values[a:b]


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 10000))
    assert sum(map(len, token_files.EliasFano.build(values).parts())) * 8 < 13 * len(values)


def test_token_files_round_trip(make, library):
    rows = [(3 * k - 5, t) for k, t in enumerate(ODD)] + [(None, "no id"), (2**40, "far")]
    manifest = token_files.write_shards(make(rows), PATH, end_id=1, shards=3)
    got = token_files.read_shards(manifest).collect()
    start = 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*_ids(library, text), 1], "<u4")
        assert [(r.start, r.n_tokens, r.ids_crc32) for r in got if r.doc_id == key] == [(start, len(ids), zlib.crc32(ids.tobytes()))]
        start += len(ids)
    for f in manifest.collect():
        reader = token_files.ShardReader(f.file)
        first = next(iter(reader.blocks()))
        assert reader.document(0)[1] == first[2][: first[1][1]].astype("<u4").tobytes()
    assert token_files.read_shards(token_files.write_shards(make([]), PATH, end_id=1)).count() == 0
    again = token_files.read_shards(token_files.write_shards(make([(7, "a"), (7, "a"), (7, "b c")]), PATH, end_id=1)).collect()
    assert [r.doc_id for r in again] == [7] * 3 and sorted(r.start for r in again)[0] == 0
    with pytest.raises(TypeError):
        token_files.write_shards(make([]).withColumn("doc_id", F.lit("x")), PATH, end_id=1)


# --- language ID


def test_language_id_held_out(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 20 and sum(r.lang == r.lang_pred for r in got) / len(got) >= 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_language_id_edges(make):
    rows = [(k, "the cat and the dog", "en") for k in range(20)] + [(k, "der hund und die katze", "de") for k in range(20, 40)] + [(50, None, None), (51, "123 !?", "en"), (52, "und der hund", None), (None, "the dog", None)]
    got = {r.doc_id: r for r in langid.identify(make(rows)).collect()}
    assert got[50].lang_pred == got[51].lang_pred == "und" and got[50].score == 0
    assert got[52].lang_pred == "de" and got[None].lang_pred == "en" and got[None].held_out is None
    assert got[3].held_out == (zlib.crc32(b"3") % 4 == 2)
    kept = langid.keep_identified(make(rows))
    assert kept.count() == len(rows) - 2 and kept.columns == make(rows).columns
    assert langid.identify(make([])).count() == 0


def test_language_counts_beside_exact_sets(spark, sf):
    # The same n-grams counted in plain sets: the filters miss none, and take no more than their rate of others.
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("text IS NOT NULL AND lang IS NOT NULL").limit(150).collect()
    sets = defaultdict(set)
    for r in docs[:100]:
        sets[r.lang] |= set(langid.ngrams(r.text).tolist())
    model = langid.LanguageFilters.build({k: np.array(sorted(v), np.uint64) for k, v in sets.items()})
    for r in docs:
        found, total = model.counts(r.text)
        held = langid.ngrams(r.text).tolist() if len(r.text) <= langid.PART else [h for at in range(0, len(r.text), langid.PART) for h in langid.ngrams(r.text[at : at + langid.PART]).tolist()]
        assert total == len(held)
        for bit, name in enumerate(model.languages):
            exact = sum(h in sets[name] for h in held)
            assert exact <= found[bit]
    others = np.array(sorted({h for r in docs for h in langid.ngrams(r.text[: langid.PART]).tolist()}), np.uint64)
    for bit, name in enumerate(model.languages):
        new = others[~np.isin(others, np.array(sorted(sets[name]), np.uint64))]
        hit = np.ones(len(new), np.uint64)
        for k in range(langid.PROBES):
            hit &= model.table[bit // 64][langid._cells(new, k, langid.CELLS)] >> np.uint64(bit % 64)
        assert abs(hit.mean() - model.false[bit]) < 4 * (model.false[bit] / len(new)) ** 0.5 + 1e-4


def test_language_ties_go_by_name(make):
    rows = [(k, "same words here", "b") for k in (0, 1, 4, 5)] + [(k, "same words here", "a") for k in (6, 7, 8, 9)]
    assert {r.lang_pred for r in langid.identify(make(rows)).collect()} == {"a"}


def test_bit_sliced_filter_returns_all_languages():
    grams = {f"l{k:03d}": np.arange(k, k + 50, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for k in range(0, 700, 10)}
    f = langid.LanguageFilters.build(grams)
    assert f.table.shape[0] == 2  # more than 64 languages take a second slice
    for bit, name in enumerate(f.languages):
        cells = [langid._cells(grams[name], k, langid.CELLS) for k in range(langid.PROBES)]
        mask = f.table[bit // 64][cells[0]] & f.table[bit // 64][cells[1]] & f.table[bit // 64][cells[2]]
        assert (mask >> np.uint64(bit % 64) & np.uint64(1)).all()


def test_language_counts_without_cuts(spark, make, monkeypatch):
    # One document of over 200000 different n-grams: all of them were thrown away.
    rng = random.Random(4)
    big = "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(130_000))
    assert len(set(langid.ngrams(big).tolist())) > 200_000
    monkeypatch.setattr(langid, "FLUSH", 1000)  # counts are handed on in several pieces
    model = langid.fit(make([(1, big, "zh"), (2, "an english text of some words", "en")]))
    assert model.predict(big)[0] == "zh" and model.predict("some words of english")[0] == "en"
    assert model.counts(big)[0][model.languages.index("zh")] > 0


def test_keep_identified_bounds(make):
    rows = [(k, "plain words of an english text", "en") for k in range(12)]
    odd = [(20, "\u05d0\u05d1\u05d2\u05d3 \u05d4\u05d5\u05d6", None), (21, "12 !!", None), (22, None, None)]
    ids = lambda x: {r.doc_id for r in langid.keep_identified(make(x)).collect()}
    assert ids(rows + odd) == set(range(12))
    assert ids([(k, t, None) for k, t, _ in rows] + odd) == {*range(12), 20}  # nothing can be learned


def test_keep_one_of_shared_ids(make):
    a, b = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    kept = ngram_join.keep_one(make([(1, a), (2, a + " more"), (2, b), (3, b + " more"), (4, None)])).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == [(1, a), (2, b), (4, "")]


# --- sentence spans


def _split(text):
    """Sentences by scanning characters, with their words."""
    parts, held = [], ""
    for k, c in enumerate(text or ""):
        held += c
        after = (text + "x")[k + 1]
        if c in sentence_spans.STOPS + "\n" and after not in sentence_spans.STOPS + "\n":
            parts.append(held)
            held = ""
    out = []
    for part in [*parts, held] if held else parts:
        tokens = re.findall(r"[ \t\n\x0b\x0c\r]*[^ \t\n\x0b\x0c\r]+|[ \t\n\x0b\x0c\r]+", part)
        words = [t.strip(" \t\n\x0b\x0c\r") for t in tokens]
        out.append(["", []])
        for t, w in zip(tokens, words, strict=True):
            out[-1][0] += t
            out[-1][1] += [w] if w else []
            if w and sum(map(bool, words)) > 8 and hashlib.md5(w.encode()).hexdigest()[0] in "01":
                out.append(["", []])
        out = [x for x in out if x[0]]
    return out


def _cut(rows, least=3, words=15):
    seen, out = set(), {}
    for k, t in sorted(rows):
        split = _split(t)
        own = [j for j, (_, w) in enumerate(split) if w]
        gone = set()
        for p in range(len(own)):
            for e in range(p + least, len(own) + 1):
                if sum(len(split[j][1]) for j in own[p:e]) >= words:
                    span = tuple(" ".join(split[j][1]) for j in own[p:e])
                    if span in seen:
                        gone |= set(own[p:e])
                    seen.add(span)
                    break
        out[k] = ("".join(s for j, (s, _) in enumerate(split) if j not in gone), len(own), len(gone))
    return out


@pytest.mark.parametrize(("least", "words"), [(3, 15), (2, 1), (1, 12)])
def test_sentence_spans_brute_force(make, least, words):
    rng = random.Random(5)
    pool = [" ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(1, 30))) + rng.choice(".!?,;:。") for _ in range(40)]
    passage = " ".join(pool[:6])
    rows = [(k, " ".join(rng.choice(pool) for _ in range(12)) + rng.choice(["\n", " "]) + (passage if k % 4 == 0 else "") + "\n\nend") for k in range(60)]
    rows += [(100, ""), (101, "a. a. a. a. a. a."), (102, "no stop"), (103, "...\n\n"), (104, "x\xa0y z\x1cw, " * 9 + "  \t")]
    out = sentence_spans.cut_repeats(make(rows), least, words).collect()
    assert {r.doc_id: (r.text, r.n_sentences, r.n_removed) for r in out} == _cut(rows, least, words)
    text = dict(rows)
    for r in out:
        keep = text[r.doc_id]
        for s in r.removed[::-1]:
            keep = keep[: s.start] + keep[s.end :]
        assert keep == r.text


def test_sentence_spans_edges(make):
    t = "One two. Three four. Five six. Seven."
    rows = [(1, t), (1, t), (2, t), (None, t), (None, None)]
    got = sorted((r.doc_id or 99, r.text or "") for r in sentence_spans.cut_repeats(make(rows), words=1).collect())
    assert got == [(1, t), (1, t), (2, ""), (99, ""), (99, "")]
    assert sentence_spans.cut_repeats(make([])).count() == 0


def test_pasted_passages_and_short_sentences(make):
    rng = random.Random(3)
    say = lambda n: " ".join(rng.choice("abcdefghijklmnop") + str(rng.randrange(900)) for _ in range(n))
    passage, filler = say(60), [say(40) for _ in range(30)]
    rows = [(k, f"{filler[2 * k]} {passage} {filler[2 * k + 1]}") for k in range(10)] + [(k, "To. Of. The. In. At. " + say(30)) for k in range(20, 40)]
    got = {r.doc_id: r for r in sentence_spans.cut_repeats(make(rows)).collect()}
    for k in range(1, 10):
        left = set(got[k].text.split())
        assert len(left & set(passage.split())) < 30 and len(left & set(f"{filler[2 * k]} {filler[2 * k + 1]}".split())) > 70
    assert all(got[k].n_removed == 0 for k in (0, *range(20, 40)))


def test_hot_runs_and_a_very_long_text(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT", 1 / 4)
    line = "The same line of many words stands here and there, in all the texts of one source, and goes on.\n"
    rows = [(k, line * 5 + f"own {k}") for k in range(50)] + [(99, line * 20_000)]
    got = {r.doc_id: r for r in sentence_spans.cut_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()}
    want = _cut(rows[:50])
    assert {k: (got[k].text, got[k].n_sentences, got[k].n_removed) for k in range(50)} == want
    assert got[99].text == "" and got[99].n_removed == got[99].n_sentences == 60_000


# --- exact dedup


def test_exact_dedup_brute_force(make):
    rng = random.Random(2)
    rows = [(k, rng.choice(["a b", "ab ", "abc", "", None, " ", "a\tb\n", "x\x1cy"])) for k in range(80)] + [(None, "ab"), (3, "ab"), (3, "ab")]
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = defaultdict(list)
    for k, t in rows:
        groups[norm(t)].append((-len(t or ""), k is None, k or 0, k))
    out = exact_dedup.exact_groups(make(rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        own = next(g for n, g in groups.items() if hashlib.sha256(n.encode()).hexdigest() == r.text_sha256)
        assert (r.keep_id, r.group_size) == (min(own)[3], len(own))
    assert Counter(r.text_sha256 for r in out if r.kept) == Counter(hashlib.sha256(n.encode()).hexdigest() for n in groups)
    kept = exact_dedup.drop_copies(make(rows))
    assert kept.columns == make(rows).columns
    assert sorted(norm(r.text) for r in kept.collect()) == sorted(groups)
    assert exact_dedup.exact_groups(make([])).count() == 0 and exact_dedup.drop_copies(make([])).count() == 0


def _entries(rows):
    out = np.zeros(len(rows), exact_dedup.ENTRY)
    for k, (digest, chars, doc_id) in enumerate(rows):
        out[k] = (*digest, -chars, doc_id is None, doc_id or 0, k, 1)
    return out


def test_runs_are_merged_block_by_block(tmp_path, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BLOCK", 3)
    rng = random.Random(8)
    # First numbers that collide, so that blocks begin and end with the same one, and the whole range.
    digests = [(rng.choice([0, 1, 5, 5, 5, 1 << 63, (1 << 64) - 1]), rng.randrange(3), 0, rng.randrange(2)) for _ in range(30)]
    rows = [(rng.choice(digests), rng.randrange(4), rng.choice([None, *range(9)])) for _ in range(300)]
    every = _entries(rows)
    files = [exact_dedup._write(str(tmp_path), iter([exact_dedup.folded(every[k::7])]))[0] for k in range(7)]
    want = {}
    for e in every:
        key, best = tuple(e)[:4], tuple(e)[4:8]
        old = want.get(key, (best, 0))
        want[key] = (min(old[0], best), old[1] + 1)
    for parts in (1, 4):
        got = []
        for part in range(parts):
            got += [e for b in exact_dedup.merged([exact_dedup.RunReader(f, (part << 64) // parts, (part + 1 << 64) // parts) for f in files]) for e in b]
        assert [tuple(e)[:4] for e in got] == sorted(want)
        assert {tuple(e)[:4]: (tuple(e)[4:8], e["n"]) for e in got} == want
    assert list(exact_dedup.merged([])) == []


def test_hot_texts_and_very_long_ones(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT", 1 / 4)
    monkeypatch.setattr(exact_dedup, "RUN", 50)
    long = "word " * 400_000
    rows = [(k, "same text" if k % 3 else f"own {k}") for k in range(900)] + [(1000, long), (1001, long + " ")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(9)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(docs).collect()}
    assert got[5] == (1, 600, False) and got[1] == (1, 600, True) and got[3] == (3, 1, True) and got[1000] == (1001, 2, False)
    assert exact_dedup.drop_copies(docs).count() == 302
    with pytest.raises(TypeError):
        exact_dedup.exact_groups(docs.withColumn("doc_id", F.col("doc_id").cast("string")))


def test_tree_merge_with_many_runs(spark):
    rows = [(k, f"text {k % 37}") for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(70)
    out = exact_dedup.exact_groups(docs).collect()
    assert all(r.keep_id == min(k for k, t in rows if k % 37 == r.doc_id % 37 and len(t) == max(len(u) for j, u in rows if j % 37 == r.doc_id % 37)) for r in out[:50])
    assert sum(r.kept for r in out) == 37
