"""Every operator over awkward rows (nulls, empty and long texts, repeats, clashing columns) and over empty tables."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import common, hnsw_search, langid, mincut_html, minmax_dedup, mixing, pca_dedup, pii_disclosure, piece_transducer, secrets_battery, toxicity_crf

BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen " * 3
TEXTS = [
    (1, BASE, "en", "a"), (2, BASE, "en", "a"), (2, BASE, "en", "a"), (3, BASE.upper(), "en", None), (4, None, "en", "b"),
    (5, "", None, "b"), (6, "  \n", "fr", None), (7, "word", "fr", "c"), (None, "nul id here", "fr", "c"), (8, "le leurre de la mer " * 40, "fr", "c"),
    (9, "x" * 50_000 + " mail a.b@c.de now", "en", "a"), (10, "1234 !! 5678", "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    common.prepare(spark)
    rows = spark.createDataFrame(TEXTS, SCHEMA)
    return rows.withColumns({"n_chars": F.length("text").cast("long"), **{c: F.lit(1) for c in ("cls", "key", "score", "size", "spans", "ids", "target", "node", "text_key")}}).coalesce(1)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def test_near_duplicates(docs, empty):
    out = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in minmax_dedup.near_duplicates(docs).collect())
    assert out[0] == (-1, 1, -1, True) and len(out) == len(TEXTS)
    assert {x[2] for x in out if x[0] in (1, 2, 3)} == {1}
    assert [x[1:] for x in out if x[0] in (4, 5, 6)] == [(0, 4, True), (0, 5, True), (0, 6, True)]
    kept = minmax_dedup.deduplicate(docs)
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 4, 5, 6, 7, 8, 9, 10] and "cls" in kept.columns
    assert minmax_dedup.near_duplicates(empty).count() == 0


def test_pieces(docs, empty):
    out = piece_transducer.encode(docs)
    assert [r.doc_id for r in out.where("text is null and ids is not null or not round_trip").collect()] == []
    back = piece_transducer.decode(out.select("doc_id", "text", "ids"))
    assert back.where("not decoded <=> text").count() == 0
    assert piece_transducer.encode(empty).count() == 0


def test_a_worker_keeps_no_transducer_beside_other_work(spark, docs):
    piece_transducer.encode(docs.repartition(4)).select("ids").collect()

    def held(batches):
        import gc

        import pyarrow as pa

        for b in batches:
            n = sum(type(x).__name__ == "Transducer" for x in gc.get_objects())
            yield pa.RecordBatch.from_pydict({"n": pa.array([n] * b.num_rows, pa.int64())})

    found = spark.range(0, 16, 1, 16).mapInArrow(held, "n long").collect()
    assert [r["n"] for r in found] == [0] * 16


def test_components_get_edges_of_no_python_step(spark, docs, monkeypatch):
    plans, whole = [], common.components
    monkeypatch.setattr(common, "components", lambda e: plans.append(e._jdf.queryExecution().optimizedPlan().toString()) or whole(e))
    assert minmax_dedup.near_duplicates(docs).count() == docs.count()
    assert len(plans) == 3 and not any("InArrow" in p for p in plans)


def test_mixing(docs, empty):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.taken <= 3 * r["size"] for r in rows)
    assert sum(r["size"] for r in rows) == pytest.approx(sum(r.taken for r in rows), abs=4 * mixing.BLOCK)
    again = mixing.mix(docs.repartition(4)).collect()
    assert sorted((r.doc_id or -1, r.taken) for r in rows) == sorted((r.doc_id or -1, r.taken) for r in again)
    whole = mixing.mixed_documents(docs).collect()
    assert sum(len((r.text or "").split()) for r in whole) == sum(r.taken for r in rows)
    assert mixing.mix(empty).count() == 0


def test_secrets_and_personal_data(docs, empty):
    nothing = hashlib.sha256(b"").hexdigest()
    assert {r.base_sha256 for r in secrets_battery.scan(docs).collect()} == {nothing}
    found = {r.doc_id: r for r in pii_disclosure.find(docs).collect()}
    assert found[9].spans == "email:50006:50014" and found[4].spans == "" and found[9].n_email == 1
    assert secrets_battery.scan(empty).count() == 0 and pii_disclosure.find(empty).count() == 0


def test_copies_of_one_word_hide_no_secret(spark):
    r = __import__("random").Random(6)
    key = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n - 1)) + "7"
    words = [f"{a}{b}{c}" for a in ("thereaner", "ingestion", "sessionee") for b in ("nationseeing", "reseentation", "interestering") for c in ("s", "ing", "tion", "ness", "ed", "er", "est", "al")]
    secrets = [key(24 + i % 20) for i in range(40)]
    rows = [(i, f"the {w} of it") for i, w in enumerate(words)] + [(1000 + i, f"see {k} here") for i, k in enumerate(secrets)]
    share = lambda rows: len([1 for x in secrets_battery.scan(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id between 1000 and 1999 and spans <> ''").collect()]) / len(secrets)
    assert share(rows) > 0.8
    assert share(rows + [(3000 + i, "uncopyrightables it says") for i in range(200)]) > 0.8  # a hot group of one word that looks random
    assert share(rows[len(words) :]) > 0.8  # no ordinary long word at all


def test_terms_that_disclose(spark):
    rows = [(i, f"{'abcdefgh'[i] * 3} agent zorro writes to kim@corp.example daily") for i in range(8)] + [(100 + i, f"agent number {i} writes to nobody") for i in range(40)] + [(200 + i, f"mail u{i}@x.org please") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii_disclosure.find(docs).collect()}
    text = dict(rows)[3]
    assert f"removed:{text.index('zorro')}:{text.index('zorro') + 5}" in spans[3] and "agent" not in spans[100] and spans[100] == ""
    clean = {r.doc_id: r.text for r in pii_disclosure.sanitise(docs).collect()}
    assert "zorro" not in clean[3] and "[EMAIL]" in clean[3] and clean[100] == dict(rows)[100]


def test_language_and_toxicity(spark, docs, empty):
    model = langid.train(docs)
    out = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert out[8].lang_pred == "fr" and out[4].lang_pred == out[10].lang_pred == "und" and out[5].score == 0
    assert langid.identify(docs, langid.train(empty)).where("lang_pred <> 'und'").count() == 0
    rows = [(i, f"some ordinary words number{i % 7} " * 8 + ("you vilething" + "aeiou"[i % 5] if i % 3 == 0 else "")) for i in range(240)]
    train = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(0, 240)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    crf = toxicity_crf.train(train.where("doc_id >= 60"), labels)
    scored = toxicity_crf.score(train.where("doc_id < 60"), crf).collect()
    assert all((r.score >= 0.3) == (r.doc_id % 3 == 0) for r in scored)
    assert all(r.text[s.start : s.end].startswith(("vilething", "you")) for r in scored for s in r.toxic_spans)
    assert all(0 <= r.score <= 1 for r in toxicity_crf.score(docs, crf).collect())
    assert toxicity_crf.score(docs, toxicity_crf.train(train, labels.where("false"))).where("score > 0.01").count() == 0


def test_language_of_many_ngrams_does_not_fill_its_filter(spark, docs, monkeypatch):
    """600,000 characters of a large alphabet, three times over: about 1.2 million n-grams of one language."""
    r = __import__("random").Random(1)
    many = ["".join(chr(r.randint(0x4E00, 0x9FA5)) for _ in range(20_000)) for _ in range(30)]
    rows = [(t, "zh") for t in many * 3] + [("the cat sat on the mat and the dog ran off " * 3, "en")] * 3
    learn = spark.createDataFrame(rows, "text string, lang string").repartition(8)
    model = langid.train(learn)
    assert model.fill().max() < 0.2
    texts = [many[0][:200], "the cat sat on the mat", "".join(chr(r.randint(0x4E00, 0x9FA5)) for _ in range(200)), None, "", "12"]
    asked = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, texts[0]])], "doc_id long, text string")
    run = lambda m: {x.doc_id: (x.lang_pred, x.score) for x in langid.identify(asked, m).collect()}
    found = run(model)
    assert found[0] == found[6] and found[0][0] == "zh" and found[0][1] > 0.95 and found[1][0] == "en" and found[1][1] > 0.95 and found[2][1] < 0.1
    monkeypatch.setattr(langid, "DRIVER_BYTES", 0)
    joined = langid.train(learn)
    assert joined.table is None
    assert joined.bits > langid.BITS and joined.fill().tolist() == model.fill().tolist()
    looked_up = run(joined)
    assert all(looked_up[i][0] == found[i][0] and looked_up[i][1] == pytest.approx(found[i][1], abs=1e-9) for i in found)
    awkward = langid.identify(docs, langid.train(docs)).collect()
    assert len(awkward) == len(TEXTS) and {x.doc_id: x.lang_pred for x in awkward}[8] == "fr"


def rare_labels():
    r = __import__("random").Random(2)
    words = ["".join(r.choice("abcdefghijklmnoprstuvw") for _ in range(r.randint(3, 8))) for _ in range(400)]
    text = lambda n: " ".join(words[min(int(r.expovariate(1 / 80)), 399)] for _ in range(n))
    return [(text(150), "en") for _ in range(400)] + [(text(40), f"x{i:02}") for i in range(65)]


def test_filters_looked_up_by_a_join_decide_alike(spark, docs, monkeypatch):
    """66 languages, so two words a position; texts null, empty, without letters, repeated, and of no language."""
    rows = rare_labels() + [("the cat sat on the mat and the dog ran off " * 3, "zz")] * 3
    learn = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    run = lambda m: [(x.doc_id, x.lang_pred, round(x.score, 9)) for x in langid.identify(docs, m).union(langid.identify(docs.limit(0), m)).orderBy("doc_id", "lang_pred", "score").collect()]
    table = langid.train(learn)
    monkeypatch.setattr(langid, "DRIVER_BYTES", 0)
    joined = langid.train(learn)
    assert table.table.shape[1] == 2 and joined.table is None and np.array_equal(table.fill(), joined.fill())
    assert run(table) == run(joined)


def test_rare_labels_do_not_push_ngrams_out(spark):
    model = langid.train(spark.createDataFrame(rare_labels(), "text string, lang string"))
    names, score = langid.classify([t for t, lang in rare_labels() if lang == "en"], model)
    assert set(names) == {"en"} and np.median(score) > 0.95


def test_lexicon_keeps_every_entry_at_every_size(spark):
    """52,000 words that only toxic rows hold, 26,000 of them in a single row; and a corpus of three toxic rows."""
    word = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(6))
    toxic = [(i, " ".join(word(26_000 * (i > 1) + k) for k in range(26_000))) for i in range(4)] + [(4, " ".join(word(60_000 + k) for k in range(26_000)))]
    rows = toxic + [(100 + i, f"plain day number{'abcde'[i % 5]}") for i in range(400)]
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in rows], "doc_id long, toxic int")
    crf = toxicity_crf.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert len(crf.lexicon) >= 78_000 and (crf.classes([f"w{word(k)}" for k in range(52_000)]) >= 2).all() and (crf.classes([f"w{word(60_000 + k)}" for k in range(26_000)]) >= 1).all()
    assert (crf.classes(["wplain", "4plai", "wday", "w", "5nowhe"]) == 0).all()
    few = [(i, "an ordinary day of rest " + ("you vilething" if i < 3 else "")) for i in range(60)]
    crf = toxicity_crf.train(spark.createDataFrame(few, "doc_id long, text string"), spark.createDataFrame([(i, int(i < 3)) for i in range(60)], "doc_id long, toxic int"))
    scored = toxicity_crf.score(spark.createDataFrame([(1, "a vilething came"), (2, "an ordinary day")], "doc_id long, text string"), crf).collect()
    assert (crf.classes(["wvilething", "4vile"]) >= 2).all() and scored[0].score > scored[1].score


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 5), 1.0, float(i)]) for i in range(20)] + [(20, [0.0, 2.0, 0.0]), (40, None), (60, [0.0, 0.0, 0.0]), (80, [1.0, nan, 0.0]), (100, [inf, 1.0, 0.0]), (120, [1.0, None, 1.0]), (20, [0.0, 2.0, 0.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("node", F.lit(0))
    out = hnsw_search.nearest(v, v.where("vec_id % 20 = 0"), k=5).collect()
    assert {r.query_id for r in out} == {0, 20} and all(r.vec_id != r.query_id and r.vec_id <= 20 for r in out)
    of20 = [(r.rank, r.vec_id, r.score) for r in sorted(out, key=lambda r: r.rank) if r.query_id == 20]
    assert of20 == [(i + 1, i, 2.0) for i in range(5)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in pca_dedup.near_duplicates(v).collect()}
    assert got[40] == (0, 40, True) and got[80] == (0, 80, True) and got[20][:2] == (2, 0)
    none = v.where("false")
    assert hnsw_search.nearest(none, none).count() == 0 and pca_dedup.near_duplicates(none).count() == 0


def _brute(vectors, k, least):
    """Per query (id divisible by 20) its k nearest, and per id its links and component; by plain loops over equal lengths."""
    ok = [(i, np.array(x)) for i, x in vectors]
    near = {i: sorted(((-float((x * y).sum()), j) for j, y in ok if j != i and len(x) == len(y)))[:k] for i, x in ok if i % 20 == 0}
    up = {i: i for i, _ in ok}

    def root(i):
        return i if up[i] == i else root(up[i])

    links = dict.fromkeys(up, 0)
    for i, x in ok:
        for j, y in ok:
            if j > i and len(x) == len(y) and float((x * y).sum()) >= least * np.sqrt((x * x).sum() * (y * y).sum()):
                links[i], links[j] = links[i] + 1, links[j] + 1
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return near, {i: (links[i], root(i)) for i in up}


@pytest.mark.parametrize("shard, tile", [(8192, 4096), (64, 32)])
def test_vectors_of_several_lengths_and_shards_equal_brute_force(spark, monkeypatch, shard, tile):
    monkeypatch.setattr(hnsw_search, "SHARD", shard)
    monkeypatch.setattr(pca_dedup, "TILE", tile)
    r = np.random.default_rng(5)
    centres = {d: r.normal(size=(12, d)) for d in (8, 16, 3)}
    rows = [(i, (centres[d][r.integers(12)] + 0.1 * r.normal(size=d)).round(3).tolist()) for i, d in enumerate(r.choice([8, 16, 3], 420, p=[0.6, 0.37, 0.03]).tolist())]
    v = spark.createDataFrame([*rows, (1000, None), (1020, []), (1040, [0.0] * 8)], "vec_id long, embedding array<double>")
    near, comps = _brute(rows, 20, 0.95)
    got: dict = {}
    for x in hnsw_search.nearest(v, v.where("vec_id % 20 = 0"), k=20).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append((x.rank, x.vec_id, x.score))
    assert got.keys() == near.keys()
    hit = sum(len({j for _, j in near[q]} & {j for _, j, _ in got[q]}) for q in near)
    assert hit >= 0.97 * sum(map(len, near.values()))
    for q, found in got.items():
        assert [n for n, _, _ in found] == list(range(1, len(near[q]) + 1)) and [(-s, j) for _, j, s in found] == sorted((-s, j) for _, j, s in found)
    out = {x.vec_id: (x.n_links, x.component_id) for x in pca_dedup.near_duplicates(v).collect()}
    assert {i: out[i] for i in comps} == comps and out[1000] == (0, 1000) and out[1020] == (0, 1020) and out[1040] == (0, 1040)


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", None), (None, None, "<p>Some text here.</p>"), (2, "u", "")], "page_id long, url string, html string").withColumn("text", F.lit("x"))
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in mincut_html.extract(pages).collect()) == [(0, "Some text here.", 15), (1, "", 0), (2, "", 0)]


def test_pipeline(spark):
    """Against plain code: what each stage must keep, change and give."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = [docs]
    for _, stage in corpus_pipeline.STAGES:
        stages.append(common.cut(stage(spark, stages[-1], sf)))
    language, single, secret, mixed, pieces = stages[1:]
    assert all(s.columns == list(corpus_pipeline.COLUMNS) for s in stages[1:5])
    ids = lambda d: {r[0] for r in d.select("doc_id").collect()}
    assert ids(language) == ids(docs)  # all have a language here
    sets = {r.doc_id: {tuple(w[i : i + 5]) for w in [r.text.lower().split()] for i in range(len(w) - 4)} or {tuple(r.text.lower().split())} for r in language.collect()}
    up = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = up[a], up[b]
                up = {k: min(x, y) if v in (x, y) else v for k, v in up.items()}
    assert ids(single) == {i for i in up if up[i] == i}
    assert ids(secret) == ids(single)
    assert not [r for r in secret.collect() if any(len(x) >= 24 for x in __import__("re").findall("[0-9a-f]+", r.text))]
    words = lambda d: d.select(F.sum(F.size(F.split(F.trim("text"), r"\s+")))).first()[0]
    assert abs(words(mixed) - words(secret)) < 0.02 * words(secret)
    assert pieces.count() == mixed.count() and pieces.where("not round_trip").count() == 0
