"""The operators' plain functions against brute force; no Spark session."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from tidemark.llm import common, hnsw_search, langid, mincut_html, minmax_dedup, pca_dedup, pii_disclosure, piece_transducer, secrets_battery, toxicity_crf

WORD = re.compile(common.WORD)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=5):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w)} - {()} if len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def test_shingles_count_as_the_words_say():
    texts = ["", None, "a", "A b", "a\x0bb\x0cc\x1cd\te  f g", "É é ÉÀ x y z", "x " * 40, " lead and trail\n", "a b c d e f g h"]
    flat, at = common.shingles(pa.array(texts))
    assert np.diff(at).tolist() == [len(shingles(t)) for t in texts]
    one = [common.shingles(pa.array([t]))[0].tolist() for t in ("A b c", "a B C")]
    assert one[0] == one[1]


def test_signature_estimates_similarity():
    r = random.Random(3)
    a = [f"w{i}" for i in range(400)]
    b = [w if r.random() > 0.02 else "x" for w in a]
    flat, at = common.shingles(pa.array([" ".join(a), " ".join(b)]))
    sig = minmax_dedup.signatures(flat, at)
    x, y = shingles(" ".join(a)), shingles(" ".join(b))
    assert abs((sig[0] == sig[1]).mean() - len(x & y) / len(x | y)) < 0.12


def test_transducer_agrees_with_the_library_and_decodes():
    model = piece_transducer._model(piece_transducer.MODEL)
    t, lib = piece_transducer.Transducer.compile(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    r = random.Random(5)
    letters = "abcdeiou stn  .,\n0123é漢😀_-'TH"
    texts = ["", " ", "   x", "Hello world.", "a" * 70, "\n\n\t def f(x):\n      return x", *("".join(r.choice(letters) for _ in range(r.randint(1, 70))) for _ in range(1500))]
    for text in texts:
        ids = t.encode(text).tolist()
        assert ids == lib.encode(text)
        assert t.decode(ids) == text == lib.decode(ids)


def test_transducer_looks_at_few_pairs_and_finds_the_same_path(monkeypatch):
    t = piece_transducer.Transducer.compile(piece_transducer._model(piece_transducer.MODEL))
    r = random.Random(6)
    parts = ["a", "th", "ing", "er", "é", "漢", "😀", "\U00010348", ",", "==", "\n", "▁", "aaa", "tion"]
    segments = ["▁outrerément", "▁thertible.", "a" * 90, *("".join(r.choice(parts) for _ in range(r.randint(1, 30))) for _ in range(2000))]

    def by_states(segment):
        (start, ids), path, at = t._finite_path(segment, len(segment)), [], len(segment)
        while at:
            path[:0] = t._bytes(segment[start[at] : at]) if ids[at] < 0 else [ids[at]]
            at = start[at]
        return path

    expected = [by_states(s) for s in segments]
    asked = []
    may = piece_transducer.Transducer.may_follow
    monkeypatch.setattr(piece_transducer.Transducer, "may_follow", lambda self, left, right: asked.append(left) or may(self, left, right))
    t.follows = type(t.follows)("q", [-1]) * piece_transducer.FOLLOWS
    assert [t.shortest_path(s) for s in segments] == expected
    searched = len(asked)
    t.follows = type(t.follows)("q", [-1]) * piece_transducer.FOLLOWS
    assert [by_states(s) for s in segments] == expected
    assert searched < 0.9 * (len(asked) - searched)


def test_round_trips_of_a_batch_are_those_of_each_text():
    t = piece_transducer.Transducer.compile(piece_transducer._model(piece_transducer.MODEL))
    ids = lambda x: np.array(t.encode(x), np.int32)
    broken = np.array([t.byte_arcs[0xC3], t.byte_arcs[0x28]], np.int32)
    texts = ["Hello  world", None, "", "a▁b", "漢😀\U00010348 x", "\ufffd(", "\ufffd", " x"]
    given = [ids("Hello  world"), None, ids(""), ids("a▁b"), ids("漢😀\U00010348 x"), broken, ids("\ufffd"), ids("x")]
    by_text = [None if i is None else t.decode(i.tolist()) == x for x, i in zip(texts, given, strict=True)]
    assert t.round_trips(texts, given) == by_text
    assert by_text == [True, None, True, False, True, True, True, False]
    assert t.round_trips([None], [None]) == [None] and t.round_trips([], []) == []


def test_unigram_takes_the_cheapest_path():
    def piece(p, s, kind=1):
        body = b"\x0a" + bytes([len(p.encode())]) + p.encode() + b"\x15" + np.float32(s).tobytes() + b"\x18" + bytes([kind])
        return b"\x0a" + bytes([len(body)]) + body

    model = b"".join(piece(*x) for x in [("<unk>", 0, 2), ("▁a", -1), ("b", -2), ("▁ab", -4), ("ab", -1.5), ("▁", -1)]) + b"\x12\x02\x18\x01" + b"\x1a\x02\x18\x01"
    t = piece_transducer.Transducer.compile(model)
    assert [t.pieces[i] for i in t.encode("ab")] == ["▁", "ab"]
    assert [t.pieces[i] for i in t.encode("aqb")] == ["▁a", "<unk>", "b"]


def base_by_hand(t):
    out = []
    for k, pattern in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, t):
            digits = re.sub("[^0-9]", "", m[0])
            fits = k == 0 or (k == 1 and all(int(p) <= 255 for p in m[0].split("."))) or (k == 2 and 13 <= len(digits) <= 19 and pii_disclosure.luhn(digits)) or (k == 3 and 9 <= len(digits) <= 15)
            if fits:
                out.append((k, *m.span()))
    return out


def test_personal_data_base_equals_the_patterns():
    r = random.Random(9)
    texts = ["a.b@c.d-e.f x@y", "@@a@b.c@d.e", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.4", "4111 1111-1111 1111 4111111111111112", "+1 (017) 555-7713. +12", ""]
    texts += ["".join(r.choice("ab.@+-() 0123456789") for _ in range(60)) for _ in range(3000)]
    for t in texts:
        assert pii_disclosure.base_spans(t) == base_by_hand(t), t


def test_secrets_base_equals_the_patterns():
    r = random.Random(4)
    texts = ['TOKEN = "abcdef12" api-key:x apikey: "secret=abcdefg', "AKIA" + "A1" * 9, "0f" * 12, "é" + "ab" * 20, "pasſword=abcdefgh"]
    texts += ["".join(r.choice(["token", "=", ":", " ", "ab", "9", "api_key", '"', "AKIA", "F0"]) for _ in range(25)) for _ in range(2000)]
    for t in texts:
        want = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.A) if len(m[2]) >= 6]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        assert secrets_battery.base_spans(t) == sorted(want), t


def test_battery_tells_random_tokens_from_words():
    r = random.Random(2)
    random_ones = ["".join(r.choice("0123456789abcdef") for _ in range(40)) for _ in range(300)]
    words = ["thereaneringestion" * 2 + w for w in ("a", "bb", "ing")] * 50
    assert (secrets_battery.battery(random_ones)[1] > 0.01).mean() > 0.9
    assert (secrets_battery.battery(words)[1] < 0.01).all()


def test_one_rule_decides_from_no_words_to_many():
    shape = (2, len(secrets_battery.LENGTHS), secrets_battery.BINS)
    seen = np.zeros(shape)
    seen[1, 2, -10:] = 5  # tokens as random as random ones are
    seen[1, 2, :5] = 4  # and others
    none = secrets_battery.limits_of(seen)
    assert none[2, -5:].all() and not none[:, : shape[2] // 2].any()
    last = none.sum()
    for words in (1, 18, 19, 20, 100, 100_000):  # words that are never random: the more, the surer
        seen[0, 2, 0] = words
        now = secrets_battery.limits_of(seen).sum()
        assert now >= last
        last = now
    seen[0, 2] = 100_000 / shape[2]  # words that are as random as any token: no token stands out
    assert not secrets_battery.limits_of(seen)[2].any()
    assert not secrets_battery.limits_of(np.zeros(shape)).any()


def _whole(codes, m):
    """Marginals of label 1 by one pass either way over the whole chain."""
    f, b, _ = m.stationary()
    step = np.exp(m.move)[None] * np.exp(np.stack([np.zeros(len(codes)), m.emit[codes]], 1))[:, None, :]
    fs, bs = [], [b]
    for s in step:
        f = f @ s
        f = f / f.sum()
        fs.append(f)
    for s in step[:0:-1]:
        b = s @ b
        b = b / b.sum()
        bs.append(b)
    both = np.array(fs) * np.array(bs[::-1])
    return both[:, 1] / both.sum(1)


def test_long_chains_are_passed_through_whole():
    r = np.random.default_rng(4)
    m = toxicity_crf.Model(np.zeros(0, np.uint64), r.normal(0, 2, 64), np.array([[1.5, -2.0], [-2.0, 1.5]]), np.zeros(3))
    docs = [np.where(r.random(n) < 0.3, r.integers(1, 64, n), 0) for n in (1, 20, 255, 256, 257, 1500, 3000)]
    found, spans = toxicity_crf.summaries(docs, m)
    base = m.stationary()[2]
    for codes, (total, top), words in zip(docs, found, spans, strict=True):
        (a, b), *more = toxicity_crf.chains(codes) or [(0, 0)]
        if more or not b:
            continue
        p = _whole(codes[a:b], m)
        assert total == pytest.approx(np.maximum(0, p - base).sum()) and top == pytest.approx(p.max())
        assert [i for i, _ in words] == (a + np.flatnonzero(p >= 0.5)).tolist()
    assert sum(len(toxicity_crf.chains(d)) == 1 and len(d) > 256 for d in docs) >= 1


def test_all_words_of_class_zero_count_in_the_fit():
    r = np.random.default_rng(5)
    piece = toxicity_crf.PIECE
    plain = [np.zeros(n, int) for n in (0, 1, piece - 1, piece, 500, 70_000)]
    toxic = [np.where(r.random(40) < 0.5, r.integers(1, 64, 40), 0) for _ in range(30)]
    y = np.array([0.0] * len(plain) + [1.0] * len(toxic))
    whole = toxicity_crf.fit_field(plain + toxic, y)
    cut = [p[i : i + piece] for p in plain for i in range(0, len(p), piece)]
    parts = toxicity_crf.fit_field(cut + toxic, np.array([0.0] * len(cut) + [1.0] * len(toxic)))
    less = toxicity_crf.fit_field([p[:24] for p in plain] + toxic, y)
    assert np.allclose(whole[0], parts[0]) and np.allclose(whole[1], parts[1]) and not np.allclose(whole[1], less[1], atol=0.01)


def test_minimum_cut_is_least():
    r = random.Random(8)
    for _ in range(200):
        n = r.randint(1, 8)
        score = [r.randint(-5, 5) + 0.5 for _ in range(n)]
        edges = [(a, b, r.randint(0, 4)) for a, b in itertools.combinations(range(n), 2) if r.random() < 0.5]
        cost = lambda x: sum(-s if k else s for s, k in zip(score, x)) + sum(w * (x[a] != x[b]) * 1.0 for a, b, w in edges)  # noqa: B023, E731
        best = min(cost([s if i < n else 0 for i, s in enumerate(x)]) for x in itertools.product([False, True], repeat=n))
        assert cost(mincut_html.min_cut([2 * s for s in score], [(a, b, w) for a, b, w in edges])) == pytest.approx(best)


PAGE = """<html><head><title>No</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body><header><h2>Site</h2></header>
<nav><ul><li><a href=/a>Menu</a></ul></nav><!-- <p>no --><div class="cookie-notice">We use cookies. Accept.</div>
<article><h1>Title &amp; more</h1><p>First   paragraph of the
text.<br>It goes on.<p>Short.</p><aside>See also that.</aside></article>
<div id="comments"><p>Reader: I like this a lot, it is a very long comment that goes on and on, with words.</p></div>
<form><label>Name</label></form><footer>&copy; Us</footer>"""


def test_main_text_of_pages():
    assert mincut_html.main_text(PAGE) == "Title & more\nFirst paragraph of the text. It goes on.\nShort."
    for broken in (None, "", "<", "<p", "<!-- x", "<script>x", "</p></p>", "<a" * 500, "plain"):
        mincut_html.main_text(broken)


ARTICLE = "<article><h1>Title</h1><p>" + "A sentence of the article that says something. " * 8 + "</p><p>A second paragraph of it, as long as need be.</p></article>"


def test_unseen_elements_leave_out_no_more_than_their_content():
    want = mincut_html.main_text(f"<body>{ARTICLE}</body>")
    assert want.startswith("Title\nA sentence")
    for tag in ("svg", "math", "canvas", "object", "button", "video", "audio", "select", "noscript", "template"):
        for head in (f"<{tag} class=icon />", f"<{tag}>", f"<{tag} a=b>x</{tag}>", f"<{tag}><p>x</{tag}>", f"<{tag}><{tag}>x</{tag}>x</{tag}>"):
            assert mincut_html.main_text(f"<body><header>{head}</header>{ARTICLE}</body>") == want, head
            assert mincut_html.main_text(f"<body>{head}{ARTICLE}<footer>{head}</footer></body>") in (want, f"x\n{want}"), head
        inside = f"<body><article><p>A sentence <{tag}>gone<div>gone</div> <a href=/>gone</a></{tag}>that goes on, with a few more words, up to its end.</p></article>"
        assert mincut_html.main_text(inside) == "A sentence that goes on, with a few more words, up to its end."
    assert mincut_html.main_text("<button>" * 3000 + "</i>" * 3000) == ""


def test_wrappers_do_not_hide_an_article():
    want = mincut_html.main_text(f"<body>{ARTICLE}</body>")
    plain = ARTICLE.replace("article>", "div>")
    for body in ('<body style="overflow-x:hidden">', '<body class="overflow-hidden" data-x="hidden">', '<body aria-hidden="false">', "<body class=hidden-nav>"):
        assert mincut_html.main_text(f"{body}{ARTICLE}") == want, body
        assert mincut_html.main_text(f"{body}{plain}") == want, body
    for name in ("has-sidebar", "no-comments", "with-nav", "page nav-open", "content-with-sidebar"):
        assert mincut_html.main_text(f'<body><div class="{name}">{ARTICLE}</div>') == want, name
        assert mincut_html.main_text(f'<body><div class="{name}">{plain}</div>') == want, name
    for wrapper in ("div class=sidebar-wrapper", "form", 'div id="search-page" class=navigation', "div hidden"):
        for inner in (ARTICLE, ARTICLE.replace("article>", "main>")):
            assert mincut_html.main_text(f"<body><{wrapper}>{inner}</{wrapper.split()[0]}>") == want, wrapper
    for gone in ("<p hidden>", "<p aria-hidden='true'>", '<p style="color:red; display: none">', "<p style=visibility:hidden>", "<p class=site-nav>", "<p class=cookie-bar>"):
        assert mincut_html.main_text(f"<body>{ARTICLE}<div>{gone}{'Words that nobody sees. ' * 3}</p></div>") == want, gone
    assert mincut_html.main_text(f"<body>{ARTICLE}<div id=comments><article><p>{'I liked it a lot. ' * 3}</p></article></div>") == want


def test_language_model_decides_and_gives_up():
    h, _ = langid.ngrams(["the theme", "le leurre"])
    table = np.zeros((1 << langid.BITS, 1), np.uint64)
    for i, text in enumerate(["the theme of them", "le leurre de leur"]):
        for s in langid._slots(langid.ngrams([text])[0]):
            np.bitwise_or.at(table[:, 0], s, np.uint64(1 << i))
    names, score = langid.classify(["the theme", "leur", None, "", "123 !", "日本"], langid.Model(["en", "fr"], table))
    assert names[:5] == ["en", "fr", "und", "und", "und"] and score[0] == 1.0 and (score[2:5] == 0).all() and len(h)


def test_field_marginals_equal_enumeration():
    m = toxicity_crf.Model({}, np.linspace(-2, 3, 64), np.array([[0.3, -0.5], [-0.2, 0.6]]), np.zeros(3))
    codes = np.array([0, 40, 63, 2, 5])
    f, b, _ = m.stationary()
    weight = np.zeros(5)
    total = 0.0
    for y in itertools.product([0, 1], repeat=5):
        w = (f @ np.exp(m.move))[y[0]] * np.prod([np.exp(m.emit[c] * k) for c, k in zip(codes, y)]) * np.prod([np.exp(m.move[p, q]) for p, q in zip(y, y[1:])]) * b[y[-1]]
        total += w
        weight += w * np.array(y)
    assert np.allclose(toxicity_crf.marginals(codes, np.array([5]), m), weight / total)


def test_graph_finds_neighbours():
    x = np.random.default_rng(0).normal(size=(1500, 24))
    g = hnsw_search.Graph(hnsw_search._lifted(x))
    g = hnsw_search.Graph.load(hnsw_search._lifted(x), g.flat())
    hit = 0
    for i in range(0, 1500, 30):
        q = np.append(x[i], 0).astype(np.float32)
        found = {j for _, j in g.search(q, g._descend(q, 0), 128, 0)[:20]}
        hit += len(found & set(np.argsort(-(x @ x[i]))[:20].tolist()))
    assert hit / (50 * 20) >= 0.9


def test_tiles_lose_no_pair():
    r = np.random.default_rng(1)
    x = r.normal(size=(300, 32))
    x = np.concatenate([x, x + 0.12 * r.normal(size=x.shape), x * 3])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    turn = np.linalg.eigh(np.cov(u.T))[1][:, ::-1]
    p = (u @ turn).astype(np.float32)
    i, j = pca_dedup.compare(p, p, x, x, 0.95, 0)
    want = {(a, b) for a, b in zip(*np.nonzero(u @ u.T >= 0.95), strict=True) if a < b}
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == want
