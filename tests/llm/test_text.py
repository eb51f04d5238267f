import itertools
import math
import random
import time

import pytest

from clipstrata.llm import garble
from clipstrata.llm.garble import PAIRS, WESTERN, Language, View, garbled, inverse
from clipstrata.llm.leaks import Index, Passage, aligned, leaks, own_stretches, plain, words
from clipstrata.llm.mixing import fit, mix
from clipstrata.llm.tokens import DEFAULT, PIECE, count, encoding, with_tokens
from tests.conftest import DATA

ITEM = (
    "Give the answer as a number of seconds or as the name of a class. The billboard stands twelve metres away while a courier named after Felmere "
    "pushes a cart along the low wall, and by second nine the orange waistcoat is hidden behind the wet asphalt of the northern yard again."
)
OTHERS = [(i, f"Give the answer as a number of seconds or as the name of a class. Item {w} asks about {w} things that nobody else has ever seen in {w} or near {w} on a day like this one, or so {w} said to {w}.") for i, w in enumerate(("alpha", "beta", "gamma"), 2)]
OWN = ITEM.split(". ", 1)[1]


def found(docs, items=None, **kw):
    ix = Index([(1, ITEM), *OTHERS] if items is None else items, Passage(**kw))
    return [ix.found(d) for d in docs]


def test_passages():
    w = OWN.split()
    docs = {
        "whole": "Some words before. " + OWN + " And after.",
        "exactly twenty": "x " + " ".join(w[3:23]) + " y",
        "typography": "\n".join("- " + " ".join(w[i : i + 5]) for i in range(3, 28, 5)).upper().replace("a", "­a"),
        "mark-up": " ".join(f"<i>{x}</i>" if k % 3 else x for k, x in enumerate(w[3:30])) + "</p>",
        "wide": "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else " " for c in " ".join(w[3:26])),
        "two changed in twenty": " ".join(x if k not in (7, 13) else "maybe" for k, x in enumerate(w[3:23])),
        "one dropped, one added": " ".join(x for k, x in enumerate(w[3:25]) if k != 9).replace("orange", "very orange"),
    }
    for name, hit in zip(docs, found(docs.values())):
        assert hit == {1}, name
    near = {
        "nineteen": "x " + " ".join(w[3:22]) + " y",
        "every sixth changed": " ".join("maybe" if k % 6 == 5 else x for k, x in enumerate(w)),
        "shared wording": ITEM.split(". ")[0] + ". And then something else entirely follows here, as it should be.",
        "empty": "",
    }
    for name, hit in zip(near, found(near.values())):
        assert hit == set(), name


def test_characters():
    zh = "请数出旧港的路边护栏在第五百帧和第九百帧之间有几次显得空旷潮湿然后说明远处山坡距离镜头约二十米"
    docs = [zh[4:34], zh[4:33], zh[4:20] + "乙" + zh[21:36], "　".join(zh[2:36]), zh[:12] + "乙丙丁戊己庚" + zh[18:34]]
    assert found(docs, [(7, zh)]) == [{7}, set(), {7}, {7}, set()]


def best(item, text, least, one_in):
    """Whether a passage is held, by trying every window against every stretch."""
    for a, b in itertools.combinations(range(len(item) + 1), 2):
        n = b - a
        if n < least:
            continue
        row = list(range(0, 1)) + [0] * len(text)
        prev = [0] * (len(text) + 1)
        for i in range(1, n + 1):
            row = [i] + [0] * len(text)
            for j in range(1, len(text) + 1):
                row[j] = min(prev[j - 1] + (item[a + i - 1] != text[j - 1] or item[a + i - 1] == 0), prev[j] + 1, row[j - 1] + 1)
            prev = row
        if min(prev) * one_in <= n and item[a] in text and item[b - 1] in text:
            return True
    return False


def test_alignment_equals_brute_force():
    rnd, yes = random.Random(2), 0
    for _ in range(150):
        item = [rnd.randint(1, 30) for _ in range(16)]
        a = rnd.randint(0, 6)
        text = item[a : a + rnd.randint(6, 10)]
        for _ in range(rnd.randint(0, 3)):
            k = rnd.randrange(len(text))
            text[k : k + 1] = rnd.choice([[], [99], [text[k], 98]])
        text = [97] * rnd.randint(0, 3) + text + [96] * 2
        got = aligned(item, text, -40, 40, 8, 4)
        strict = best(item, text, 8, 4)
        yes += got
        assert strict or not got  # an end must match, so the rule may be stricter at an edit on the very edge
        if strict and not got:
            assert not best(item, text, 10, 4)
    assert 20 < yes < 130


def test_wording_of_several_items_is_cut():
    parts = own_stretches([(1, ITEM), *OTHERS], Passage())
    assert all("seconds" not in run for _, _, run in parts) and {i for i, _, _ in parts} == {1, 2, 3, 4}
    assert own_stretches([(1, None), (2, ""), (3, "short")], Passage()) == []


def test_prefixes_lose_nothing():
    ix = Index([(1, ITEM), *OTHERS], Passage())
    ix.keep_prefixes({n: 10 if n % 3 else 10**6 for n in ix.number.values()})
    w = OWN.split()
    rnd = random.Random(4)
    assert 0 < len(ix.prefix) < len(ix.at)
    for _ in range(60):
        a = rnd.randint(0, len(w) - 24)
        text = w[a : a + rnd.randint(20, 24)]
        for k in rnd.sample(range(1, len(text) - 1), 2):
            text[k] = "maybe"
        if len(text) >= 20:
            assert ix.found(" ".join(text)) == {1}


def test_long_items_and_repetitive_documents():
    rnd = random.Random(6)
    item = " ".join(f"w{rnd.randrange(3000)}" for _ in range(20_000))
    t = time.time()
    ix = Index([(1, item)], Passage())
    ix.keep_prefixes({n: rnd.randrange(50) for n in ix.number.values()})
    w = item.split()
    part = w[7000:7200]
    for k in range(5, 200, 9):  # one in nine is changed
        part[k] = "maybe"
    assert ix.found("x y " + " ".join(part) + " z") == {1} and ix.found(" ".join(w[100:119])) == set()
    assert ix.found(" ".join(w[500:515]) * 1 + " " + " ".join([*w[300:310], "a"] * 3000)) == set()
    assert time.time() - t < 20


def test_prefixes_equal_all_windows():
    """What the shortest windows keep is what windows of any length up to the longest keep."""
    rnd = random.Random(12)
    p = Passage()
    for _ in range(5):
        item = " ".join(f"w{rnd.randrange(400)}" for _ in range(rnd.randint(20, 90)))
        ix = Index([(1, item)], p)
        held = {n: rnd.randrange(6) for n in ix.number.values()}
        ix.keep_prefixes(held)
        want = set()
        for _, zh, run in ix.parts:
            grams = [g for _, g in ix._grams(zh, ix.seqs[0])]
            for m in range(20, min(p.longest(20), len(run) + 1)):
                for a in range(len(grams) - (m - 4) + 1):
                    inside = sorted(range(a, a + m - 4), key=lambda i: (held[ix.number[grams[i]]], i))
                    want |= {grams[i] for i in inside[: 5 * (m // 8) + 1]}
        assert ix.prefix == want


def test_leaks_on_tables(spark):
    docs = spark.createDataFrame([(1, OWN, "x"), (2, None, "x"), (3, "", "x"), (None, OWN, "x"), (5, "long " * 50000 + OWN, "x"), (1, OWN, "x")], "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(1, ITEM, "x"), (1, ITEM, "x"), (9, None, "x")], "item_id long, text string, doc_id string")
    assert sorted(map(tuple, leaks(docs, items).collect())) == [(1, 1), (5, 1)]
    assert leaks(docs.limit(0), items).count() == 0 and leaks(docs, items.limit(0)).count() == 0
    assert words(plain("Café <b>A</b>-B")) == ["café", "a", "b"]


def test_wording_of_items_in_different_blocks_is_cut(spark, monkeypatch):
    opening = "Answer with the number of seconds or with the name of one class and give no reason for it in any case unless the question itself asks for one"
    tail = lambda i: " ".join(f"w{i}x{k}" for k in range(25))
    items = spark.createDataFrame([(i, f"{opening}. {tail(i)}.") for i in range(6)], "item_id long, text string")
    docs = spark.createDataFrame([(1, opening), (2, "some words " + tail(4)), (3, opening + ". " + tail(2))], "doc_id long, text string")
    for size in (1 << 24, 400):
        monkeypatch.setattr("clipstrata.llm.leaks.BLOCK_CHARS", size)
        assert sorted(map(tuple, leaks(docs, items).collect())) == [(2, 4), (3, 2)]


def test_fit_equals_best_subset():
    rnd = random.Random(8)
    for _ in range(80):
        lengths = sorted(rnd.sample(range(1, 40), rnd.randint(1, 5)))
        counts = [rnd.randint(1, 4) for _ in lengths]
        budget = rnd.randint(0, sum(n * c for n, c in zip(lengths, counts)) + 5)
        took = fit(lengths, counts, budget)
        assert all(0 <= t <= c for t, c in zip(took, counts))
        sums = {sum(n * k for n, k in zip(lengths, ks)) for ks in itertools.product(*[range(c + 1) for c in counts])}
        got, most = sum(n * t for n, t in zip(lengths, took)), max(s for s in sums if s <= budget)
        assert got <= budget and most - got <= max(lengths), (lengths, counts, budget, took)
    big = fit([7, 11, 1000], [10**6, 10**6, 10**5], 55_555_555)
    assert 7 * big[0] + 11 * big[1] + 1000 * big[2] == 55_555_555


def test_fit_meets_every_budget_that_a_subset_meets():
    assert sum(n * k for n, k in zip([10, 100, 101, 102, 103], fit([10, 100, 101, 102, 103], [2] * 5, 509))) == 509
    rnd = random.Random(9)
    for _ in range(150):
        lengths = sorted(rnd.sample(range(1, 200), rnd.randint(1, 6)))
        counts = [rnd.randint(1, 4) for _ in lengths]
        budget = rnd.randint(0, sum(n * c for n, c in zip(lengths, counts)) + 5)
        took = fit(lengths, counts, budget)
        sums = {sum(n * k for n, k in zip(lengths, ks)) for ks in itertools.product(*[range(c + 1) for c in counts])}
        assert all(0 <= t <= c for t, c in zip(took, counts))
        assert sum(n * t for n, t in zip(lengths, took)) == max(s for s in sums if s <= budget)
    # above the window as well: proportional parts leave 16, which only longer documents that go back can meet
    big = fit([100, 101, 102, 103, 104, 105], [1000] * 6, 300_016, exact=1 << 10)
    assert sum(n * t for n, t in zip([100, 101, 102, 103, 104, 105], big)) == 300_016


def test_mix(spark):
    docs = [(i, " A " if i % 2 else "a", 3 + i % 5, "x") for i in range(200)] + [(300 + i, "small", 10, "x") for i in range(3)] + [(400, None, 5, "x"), (401, "other", 5, "x"), (402, "a", 0, "x"), (403, "a", None, "x"), (None, "a", 4, "x")]
    want = [("a", 0.5, 3), ("SMALL", 0.4, 2), ("none", 0.1, 5), (None, 0.0, 1)]
    d, t = spark.createDataFrame(docs, "doc_id long, source string, n_tokens long, budget string"), spark.createDataFrame(want, "source string, target_share double, max_repeats int")
    out, report = mix(d, t)
    r = {x.source: x for x in report.collect()}
    total = sum(n or 0 for _, s, n, _ in docs if s and s.strip().lower() in ("a", "small"))
    assert r["a"].size + 30 == total and r["a"].mixed == int(0.5 * total) and not r["a"].short
    assert r["small"].short and r["small"].mixed == 60 and r["none"].short and r["none"].mixed == 0
    rows = out.collect()
    assert sum(x.n_tokens * x.times for x in rows if x.source == "a") == r["a"].mixed and {x.times for x in rows if x.source == "small"} == {2}
    assert sorted(map(tuple, mix(d, t)[0].collect()), key=repr) == sorted(map(tuple, rows), key=repr)
    assert abs(sum(x.actual_share for x in r.values()) - 1) < 1e-9
    assert mix(d.limit(0), t)[1].filter("NOT short AND mixed = 0").count() == 3 and mix(d, t.limit(0))[1].count() == 0


def test_tokens(spark):
    enc = encoding(DEFAULT)
    text = ("The camera pans left, don't it? 12 frames — café. " * 4000) + "请数出 " * 3000
    assert len(text) > 2 * PIECE and count(text) == len(enc.encode_ordinary(text)) and count(None) == count("") == 0
    df = spark.createDataFrame([(1, "a b c", None), (2, None, "k")], "i long, text string, n string")
    assert sorted((r.i, r.n_tokens) for r in with_tokens(df, "text").collect()) == [(1, 3), (2, 0)]


CLEAN = {
    "fr": "Le réverbère a été mal étiqueté à la fenêtre déjà sélectionnée.",
    "de": "Später öffnet jemand das Tor und geht über die Brücke zurück, Größe und Maßstab stimmen.",
    "ru": "Небо определено верно, вода нет, потеряно пять кадров.",
    "zh": "天空区域稳定，水面标签偶尔丢失。",
}


def spoil(text, pair):
    """The text as the pair's wrong reading shows it; bytes that the encoding lacks stand for themselves."""
    if pair.read[0] in garble._WIDE:
        return text.encode(pair.true).decode(pair.read[0], "replace")
    for _ in range(pair.rounds):
        out = ""
        for b in text.encode(pair.true):
            try:
                out += bytes([b]).decode(pair.read[0])
            except UnicodeDecodeError:
                out += chr(b)
        text = out
    return text


@pytest.mark.parametrize("pair", [p for p in PAIRS if p.read[0] not in garble._WIDE], ids=lambda p: p.name)
def test_inverse_undoes_the_pair(pair):
    for lang, text in CLEAN.items():
        try:
            bad = spoil(text, pair)
        except UnicodeEncodeError:
            continue
        if pair.true in ("gbk", "cp932") and lang != "zh" or pair.piece is garble._HIGH and lang != "ru":
            continue
        assert inverse(bad, pair) == text


def test_garbled_texts_are_found_and_restored(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in rows]
    clean = [(10_000 + i, t) for i, t in enumerate(list(CLEAN.values()) * 12)]
    extra, truth = [], {}
    for k, (lang, p) in enumerate(itertools.product(CLEAN, PAIRS)):
        if p.piece is garble._HIGH and lang != "ru" or p.true in ("gbk", "cp932") and lang != "zh" or p.read[0] in garble._WIDE and lang != "zh":
            continue
        try:
            bad = spoil(CLEAN[lang], p)
        except UnicodeEncodeError:
            continue
        extra.append((20_000 + k, "Plain words before. " + bad + " And after."))
        truth[20_000 + k] = "Plain words before. " + CLEAN[lang] + " And after." if "�" not in bad else None
    odd = [(30_000, "json √ ├── duv │ └── x"), (30_001, "SÃO 43 CORREÇÕES NA SEÇÃO DE AVALIAÇÃO"), (30_002, None), (30_003, ""), (30_004, "x" * 200_000), (None, extra[0][1]), (30_005, "caf�")]
    df = spark.createDataFrame([(*r, "x") for r in rows + clean + extra + odd], "doc_id long, text string, states string")
    got = {r.doc_id: r for r in garbled(df).collect()}
    missed = [k for k in truth if k not in got]
    assert len(missed) <= 0.1 * len(truth), missed
    assert not [k for k in got if 10_000 <= k < 20_000 or k in (30_000, 30_001, 30_002, 30_003, 30_004)]
    assert not got[30_005].whole
    wrong = [(k, got[k].states, got[k].text) for k, t in truth.items() if k in got and t and got[k].text != t]
    assert len(wrong) <= 0.2 * len(truth), wrong
    assert garbled(df.limit(0)).count() == 0 and WESTERN


def test_counts_take_in_clean_documents_with_suspect_pieces(spark):
    fr = "L’équipe a été relevée à l’écart, près du réverbère déjà sélectionné."
    sure = CLEAN["fr"] + " Près de l’arbre, l’allée d’accès."
    # a quote and an accented e are a piece of UTF-8 read as mac-roman
    assert View([fr, sure]).suspect().tolist() == [True, False]
    rows = [(sure,)] * 40 + [(fr,)] * 20 + [(spoil(CLEAN["fr"], PAIRS[0]),)] * 5 + [("caf�",), (None,), ("",), ("plain",)]
    lang = garble.language(spark.createDataFrame(rows, "text string"), "text")
    chars, pairs = dict(zip(lang.codes.tolist(), lang.held.tolist())), dict(zip(lang.keys.tolist(), lang.counts.tolist()))
    assert pairs[ord("’") << 21 | ord("é")] == 40 and chars[ord("’")] == 120 + 40 and chars[ord("q")] == 40 + 20
    assert ord("Ã") not in chars and ord("�") not in chars


def spans_by_hand(text, lang):
    """The best path, one character at a time, with every pair offered."""
    clean = [lang.after(text[i - 1] if i else "", c) if ord(c) > 0x7F else math.log(lang.one(c)) for i, c in enumerate(text)]
    rows = [(garble.LOST, {i: -1.0 for i, c in enumerate(text) if c == "�"})] if "�" in text else []
    for p in PAIRS:
        score, last, before = {}, -1, ""
        for a, b, c in garble.pieces(text, p):
            s = lang.after(before if a == last else text[a - 1] if a else "", c) / (b - a)
            for i in range(a, b):
                score[i] = score.get(i, 0.0) + s if p.read[0] in garble._WIDE else s
            last, before = b, c
        if p.read[0] in garble._WIDE:
            near = {j for i, c in enumerate(text) if c == "�" for j in (i - 1, i + 1) if 0 <= j < len(text) and text[j] > "\x7f" and j not in score}
            score.update({j: clean[j] - 1.0 for j in near} | {i: -3.0 for i, c in enumerate(text) if c == "�"})
        best = run = 0.0
        for i, c in enumerate(text):
            run = max(0.0, run + (score.get(i, garble.NEVER if c > "\x7f" else clean[i]) - clean[i]))
            best = max(best, run)
        if best > 2 * garble.SWITCH:
            rows.append((p.name, score))
    value, back = [0.0] + [-garble.SWITCH] * len(rows), []
    for i, c in enumerate(text):
        top = max(range(len(value)), key=value.__getitem__)
        back.append([k if x >= value[top] - garble.SWITCH else top for k, x in enumerate(value)])
        value = [max(x, value[top] - garble.SWITCH) + (clean[i] if not k else rows[k - 1][1].get(i, garble.NEVER if c > "\x7f" else clean[i])) for k, x in enumerate(value)]
    state = max(range(len(value)), key=lambda k: value[k] - (garble.SWITCH if k else 0.0))
    states = []
    for step in reversed(back):
        states.append(state)
        state = step[state]
    return [rows[k - 1][0] if k else "" for k in reversed(states)]


def test_spans_equal_the_best_path_by_hand(spark):
    texts = [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").select("text").collect() if r.text and not r.text.isascii()]
    texts += list(CLEAN.values()) + ["X — " + spoil(CLEAN[k][:n], p) + " y" for k in CLEAN for n in (2, 5, 60) for p in PAIRS if _can(CLEAN[k][:n], p)]
    view = View(texts)
    lang = Language(*view.counts(~view.suspect()))
    marks, found = view.look(lang)[0], view.spans(lang)
    for i, t in enumerate(texts):
        want = {j: x for j, x in enumerate(spans_by_hand(t, lang)) if x and t[j] > "\x7f"}
        got = {j: x for a, b, x in found.get(i, []) for j in range(a, b) if t[j] > "\x7f"}
        assert got == want and (marks[i].any() or not want), t
    assert len(found) > 60


def _can(text, pair):
    try:
        return bool(spoil(text, pair))
    except UnicodeEncodeError:
        return False


def test_a_rare_language_is_no_garbled_text(spark):
    """Two documents in a thousand are in a language that no other has; the garbled ones are as many and still found."""
    pl = "Źrebię żółte ścięło łąkę, a gęś już śpi; późną porą wróciła też mała świnka."
    rows = [(i, CLEAN["ru"] if i % 2 else CLEAN["de"]) for i in range(3000)] + [(5000 + i, pl) for i in range(6)] + [(6000 + i, spoil(CLEAN["ru"], p)) for i, p in enumerate(p for p in PAIRS if p.true in ("cp1251", "koi8-r", "cp866"))]
    got = {r.doc_id for r in garbled(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i for i, _ in rows if i >= 6000}


def test_short_spans_of_utf8_read_as_gbk_are_offered_to_the_model(spark):
    zh = CLEAN["zh"]
    bad = zh[:5] + "——".encode().decode("gbk", "replace")[:3] + zh[5:]
    assert garble.pieces(bad, next(p for p in PAIRS if p.name == "utf-8 as gbk"))
