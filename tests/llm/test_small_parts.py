"""The workers' functions against brute force, without Spark."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kelpforge.llm import bpe, class_lm, decontaminate, exact_dedup, html_extract, license_scan, near_dedup, substring_dedup, tokens, toxicity
from kelpforge.llm.common import words

WORDS = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def lower(s):
    return s.translate({c: c + 32 for c in range(65, 91)})


@given(st.text())
@settings(max_examples=200, deadline=None)
def test_words_are_the_pattern(s):
    s = s.encode("utf-8", "ignore").decode()
    assert [w.decode() for w in words(s)] == WORDS.findall(lower(s))


def test_hashes_of_words_and_shingles():
    texts = [b"a bc a", b"", b"bc  a, x y z w", b"a" * 700, b"q r"]
    h, off = tokens.word_hashes(texts)
    assert off.tolist() == [0, 3, 3, 9, 10, 12]
    assert h[0] == h[2] == h[4] and h[1] == h[3] and len(set(h.tolist())) == 9
    s, off, n = tokens.shingle_hashes(texts)
    assert np.diff(off).tolist() == [1, 0, 2, 1, 1] and n.tolist() == [3, 0, 6, 1, 2]
    again, _, _ = tokens.shingle_hashes([b"x bc a x y z", texts[2]])
    assert again[1] == s[1 + 0] and again[2] == s[1]


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1000, 60_000])
def test_binary_fuse_filter(n):
    keys = np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64)
    f = exact_dedup.BinaryFuse8.build(keys)
    assert f.contains(keys).all()
    assert f.contains(np.random.default_rng(n + 1).integers(0, 2**63, 20_000).astype(np.uint64)).mean() < 0.01


def test_bpe_equals_the_library():
    own, lib = bpe.load(PATH), Tokenizer.from_file(PATH)
    r = random.Random(4)
    parts = [" ", "  ", "\n", "\t", " ", "　", "a", "B", "à", "'s", "'ll", "1", "23", "!", "<|endoftext|>", "\U0001f600", "日本", "\x00", "_", "\r\n", "\x1c", "\x85", "é", "the", "Word"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(30))) for _ in range(4000)] + ["", "ab" * 20_000, " " * 999, "x " * 30_000]
    for t, e in zip(texts, lib.encode_batch(texts, add_special_tokens=False)):
        got = own.encode(t)
        assert got == e.ids, t
        assert own.decode(got) == lib.decode(e.ids, skip_special_tokens=False)


def test_forced_boundaries_are_never_inside_a_token():
    own = bpe.load(PATH)
    for tok in list(own.bytes_of.values())[:50_000:7]:
        if tok not in [s.encode() for s in own.special]:
            assert own.pieces(tok) == [tok]


def brute_hits(items, doc, width):
    hit, ids = set(), set()
    for i, w in items:
        for x in ([w] if len(w) < width else [w[k : k + width] for k in range(len(w) - width + 1)]) if w else []:
            for j in range(len(doc) - len(x) + 1):
                if doc[j : j + len(x)] == x:
                    hit |= set(range(j, j + len(x)))
                    ids.add(i)
    return hit, ids


def test_automaton_against_brute_force():
    r = random.Random(3)
    for _ in range(1500):
        v, width = r.choice([2, 3, 5]), r.choice([2, 3, 4])
        some = lambda a, b: [b"%d" % r.randrange(v) for _ in range(r.randint(a, b))]  # noqa: E731, B023
        items = [(str(k), some(0, 9)) for k in range(r.randint(0, 4))]
        if r.random() < 0.5:
            items = [(i, w) for i, w in items if len(w) >= width]
        doc = [x if r.random() < 0.85 else b"z" for x in some(0, 30)]
        spans, ids = decontaminate.ItemAutomaton(items, width).hits(doc)
        hit, want = brute_hits(items, doc, width)
        assert {x for a, b, _ in spans for x in range(a, b)} == hit and ids == want
        assert sum(b - a for a, b, _ in spans) == len(hit)


def test_spans_are_cut_out_of_texts():
    assert decontaminate.without_words("Say: one two, three! End.", [(1, 3)]) == "Say: , three! End."
    assert decontaminate.without_words("Été a b", [(0, 1), (2, 3)]) == " a "


def test_licence_spans():
    search = license_scan.NoticeSearch(license_scan.BASE + license_scan.NOTICES)
    found = lambda t: [s[:4] for s in search.spans(words(t))]
    assert found("") == [] and found("cc-by") == [("cc-by", 0, 2, 0)]
    assert found("CC BY by cc by") == [("cc-by", 0, 2, 0), ("cc-by", 3, 5, 0)]
    assert [s[0] for s in found("xcc by, acc by")] == []
    fuzzy = found("x Releasd under the MIT Licence y")
    assert [(s[0], s[1], s[2]) for s in fuzzy] == [("mit", 1, 6)] and 0 < fuzzy[0][3] <= 3
    assert [(s[0], s[1]) for s in found("All rights reserved. All right reserved")] == [("reserved", 0), ("reserved", 0), ("reserved", 3)]


def test_licence_search_loses_no_place_within_the_bound():
    r = random.Random(1)
    n = license_scan.Notice("released under the mit license", "mit", 3)
    search = license_scan.NoticeSearch((n,))
    for _ in range(300):
        s = list(n.phrase)
        for _ in range(r.randint(0, 3)):
            k = r.randrange(1, len(s) - 1)
            s[k : k + r.randint(0, 1)] = r.choice(["", "x", "q"])
        text = "".join(s)
        ok = regex.search(f"(?:{n.phrase}){{e<=3}}", " ".join(w.decode() for w in words(text)))
        assert bool(search.spans(words("aa " + text + " bb"))) >= bool(ok)


def test_prob_minhash_estimates_the_exact_similarity():
    r = np.random.default_rng(0)
    a = [b"w%d" % i for i in r.integers(0, 10**6, 300)]
    b = list(a)
    b[50], b[200] = b"x", b"y"
    texts = [b" ".join(a), b" ".join(b), b" ".join(a + a[:80]), b"one two", b""]
    doc, h, w = near_dedup.weighted_shingles(texts)
    sig = near_dedup.prob_minhash(doc, h, w, len(texts), 4096)
    side = lambda i: (h[doc == i], w[doc == i])
    for i, j in itertools.combinations(range(4), 2):
        assert abs((sig[i] == sig[j]).mean() - near_dedup.probability_jaccard(*side(i), *side(j))) < 0.03
    assert not sig[4].any()


@given(st.dictionaries(st.integers(0, 9), st.integers(1, 4)), st.dictionaries(st.integers(0, 9), st.integers(1, 4)))
@settings(max_examples=100, deadline=None)
def test_probability_jaccard_is_its_definition(x, y):
    keys = set(x) | set(y)
    want = sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in keys) for d in set(x) & set(y))
    arr = lambda z: (np.array(sorted(z), dtype=np.uint64), np.array([z[k] for k in sorted(z)], dtype=np.int32))
    assert math.isclose(near_dedup.probability_jaccard(*arr(x), *arr(y)), want, abs_tol=1e-9)


def test_compact_windows_against_the_cartesian_tree():
    r = random.Random(5)

    def tree(v, least):
        out, todo = set(), [(0, len(v) - 1)]
        while todo:
            lo, hi = todo.pop()
            if hi - lo + 1 >= least:
                c = min(range(lo, hi + 1), key=lambda i: (v[i], i))
                out.add((lo, c, hi))
                todo += [(lo, c - 1), (c + 1, hi)]
        return out

    for _ in range(300):
        docs = [[r.randrange(1, r.choice([9, 1000])) * 2 for _ in range(r.randrange(40))] for _ in range(r.randint(1, 5))]
        off, least = np.r_[0, np.cumsum([len(d) for d in docs])], r.randint(2, 9)
        got = substring_dedup.compact_windows(np.array([x for d in docs for x in d], dtype=np.uint64), off, least)
        assert set(zip(*(x.tolist() for x in got))) == {(i, *w) for i, d in enumerate(docs) for w in tree(d, least)}


def test_exchange_raises_the_likelihood_and_groups_alike_words():
    r = np.random.default_rng(2)
    true = np.arange(20) % 2
    seq, w = [], 0
    for _ in range(6000):
        w = int(r.choice(np.flatnonzero(true != true[w])))
        seq.append(w)
    big = np.zeros((22, 22))
    np.add.at(big, (seq[:-1], seq[1:]), 1)
    start = np.r_[np.arange(20) // 10, 2, 3]
    cls = class_lm.exchange(big, 2)
    assert len({(a, b) for a, b in zip(true, cls[:20])}) == 2

    def likelihood(c):
        one = np.eye(4)[c]
        n = one.T @ big @ one
        f = lambda x: (x[x > 0] * np.log(x[x > 0])).sum()
        return f(n) - f(n.sum(axis=0)) - f(n.sum(axis=1))

    assert likelihood(cls) > likelihood(start)


def test_main_text_of_made_up_pages():
    p = "<p>" + "A sentence of an article, of some length. " * 6 + "</p>"
    body = " ".join(("A sentence of an article, of some length. " * 6).split())
    page = f"<html><head><title>x</title></head><body><nav><a href=/>Home</a></nav><div class=ad>Buy</div><article><h1>T &amp; U</h1>{p}<p>br<br>eak&nbsp;x</p><p><b>un<i>closed{p}</article><aside>side</aside><div id=comments><article>me too {p}</article></div><footer>f</footer>"
    assert html_extract.main_text(page) == f"T & U {body} br eak x unclosed {body}"
    plain = f"<div class=menu><a>m</a></div><div class='post no-sidebar'><h2>H</h2>{p}{p}</div><div class=cookie-notice>c</div><form><input><label>l</label></form><script>var t='<p>s</p>'</script>"
    assert html_extract.main_text(plain) == f"H {body} {body}"
    for odd, want in ((None, ""), ("", ""), ("<p>", ""), ("a < b", "a < b"), ("<nav>only</nav>", "only"), ("<!-- c -->x<![CDATA[y]]>", "xy"), ("<script>never closed", "")):
        assert html_extract.main_text(odd) == want
    assert html_extract.main_text("<div>" * 3000 + "x") == "x"


def test_swaps_hold_identity_terms_equal():
    names = [b"women", b"men", b"bad"]
    rows = [(1, [0, 2])] * 30 + [(0, [1])] * 30 + [(1, [2])] * 20 + [(0, [])] * 20
    swaps = [([0], [1])] * 30 + [([1], [0])] * 30
    free, _ = toxicity._fit(rows, [], 3, 1e-3, 1.0)
    held, _ = toxicity._fit(rows, swaps, 3, 1e-3, 10.0)
    assert abs(held[0] - held[1]) < 0.1 < abs(free[0] - free[1]) and held[2] > 1
    assert toxicity.ToxicityModel(dict(zip(names, held)), -1.0).score("bad") > 0.5


def test_tokens_of_the_language_model():
    assert class_lm.tokens(" A\tb\x0b C ") == [b"a", b"b", " c".encode(), class_lm.END]
    assert class_lm.tokens("") == [class_lm.END] and Counter(class_lm.tokens("x x"))[b"x"] == 2


def test_long_attribute_values_stay_attributes():
    p = "<p>" + "A sentence of an article, of some length. " * 6 + "</p>"
    body = " ".join(("A sentence of an article, of some length. " * 6).split())
    for n in (9_000, 10_500, 300_000):
        for q in "\"'":
            value = "x" * n + "<b>oops</b>"
            assert html_extract.main_text(f"<article><div data-x={q}{value}{q}>{p}</div><div data-x={q}{value}{q} class=menu>m</div></article>") == body


def test_every_notice_of_a_window_is_a_span():
    search = license_scan.NoticeSearch(license_scan.NOTICES)
    for text, label, n in (
        ("relased under teh mit license released under the mit license", "mit", 2),
        ("mozila public license mozilla public license mozilla publik license", "mpl", 3),
        ("all rights reservd all rights reserved", "reserved", 2),
    ):
        got = [s for s in search.spans(words(text)) if s[0] == label]
        assert len(got) == n and [s[1] for s in got] == sorted({s[1] for s in got})


def test_all_forced_boundaries_cut():
    b = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    pair = next((x, y) for x in range(97, 123) for y in range(33, 64) if not b.joined[x, y])
    raw = bytes([97, *pair, 97])
    assert b.pieces(raw)[0] == bytes([97, pair[0]]) and b"".join(b.pieces(raw)) == raw


def test_density_decides_where_names_do_not(monkeypatch):
    links = "".join(f"<li><a href='/{i}'>some other page number {i}</a></li>" for i in range(60))
    page = f"<body><div><ul>{links}</ul></div><div><p>{'The article has sentences. ' * 12}</p><p>{'More of them follow. ' * 12}</p></div></body>"
    assert html_extract.main_text(page).startswith("The article") and "other page" not in html_extract.main_text(page)

    def plain(self):
        sums = list(self.own)
        for i in range(len(sums) - 1, 0, -1):
            sums[self.parent[i]] += sums[i]
        return [float(x) for x in sums], [float(x) for x in sums], sums

    monkeypatch.setattr(html_extract.Page, "densities", plain)
    assert "other page" in html_extract.main_text(page)


def test_names_are_a_weak_hint_inside_an_article():
    text = "<p>" + "Some words of the article. " * 5 + "</p>"
    t = html_extract.main_text
    page = f"<body><form action='/'><div class='menu'><a href='/'>Home</a></div><div><h1>Title</h1>{text}</div><div id='footer'>Imprint</div></form></body>"
    assert t(page).startswith("Title Some words") and "Imprint" not in t(page) and "Home" not in t(page)
    page = f"<article><h1 class='entry-header'>Title</h1>{text}<section class='social-history'><p>It was so.</p></section><div class='share-buttons'>Share</div><section class='comments'><p>Nice.</p></section></article>"
    assert t(page).startswith("Title Some") and t(page).endswith("It was so.")
    page = f"<article>{text}<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be.</p></article>"
    assert t(page).endswith("Let x=2 be.")
    page = f"<article>{text}<form><input><p>Write to us</p></form></article>"
    assert t(page).endswith("article.")
