import random

import numpy as np
import pytest
from brute import words

from smeltery.llm import arrays, divergence, language, toxicity
from smeltery.session import BATCH, BATCH_BYTES

ALPHABETS = {"xa": "abcdefgh", "xb": "ghijklmnö", "xc": "opqrstuvwé"}


def speech(rng, lang, n):
    letters = ALPHABETS[lang]
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))) for _ in range(n))


def test_languages_are_told_apart(documents):
    rng = random.Random(1)
    rows = [(k, speech(rng, lang, rng.randrange(3, 60)), lang) for k, lang in enumerate(list(ALPHABETS) * 30)]
    docs = documents(rows)
    profiles = language.learn(docs.where("doc_id < 45"))
    assert sorted(profiles) == sorted(ALPHABETS)
    got = language.predict(docs, profiles).collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in got)


def test_bundles_are_sums_of_bound_and_turned_letters():
    vectors = language.Vectors(256)
    doc, key, count = language.grams(["Abc", "", "1 2", "bc ab"])
    rows = vectors.of(np.unique(key))
    assert set(doc.tolist()) == {0, 3} and set(np.unique(rows)) == {-1.0, 1.0}
    letters = [vectors._letter(ord(c)).astype(int) for c in "abc"]
    bound = np.roll(letters[0], 0) * np.roll(letters[1], 1) * np.roll(letters[2], 2)
    where = sum(ord(c) << (21 * k) for k, c in enumerate("abc"))
    assert (vectors.of(np.array([where]))[0] == bound).all()
    # " Abc " has three grams, each around one letter.
    assert count[doc == 0].sum() == 3


def test_languages_of_odd_rows(documents):
    docs = documents([(1, "abc", "xa"), (1, "abc", "xa"), (None, None, None), (2, "12 !?", "xa"), (3, "", None)])
    profiles = language.learn(docs)
    odd = docs.withColumnRenamed("source", "value").withColumnRenamed("n_chars", "at")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(odd, profiles).collect()}
    assert got[1][0] == "xa" and got[None] == got[2] == got[3] == ("und", 0.0)
    assert language.predict(documents([]), profiles).collect() == []
    assert language.learn(documents([])) == {}
    assert {r.lang_pred for r in language.predict(docs, {}).collect()} == {"und"}


def test_many_short_texts_take_little_memory():
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzäöü") for _ in range(4)) for _ in range(10_000)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    tracemalloc.start()
    for part, values in language._blocks(iter([batch])):
        doc, key, _ = language.grams(values)
        assert len(values) * len(np.unique(key)) * 4 < 1 << 20
    assert tracemalloc.get_traced_memory()[1] < 50 << 20
    tracemalloc.stop()


TEXTS = [
    "one two three one two three four",
    "a a a a a",
    "x y\nx y\n\n \nx y \nz # $ %% é",
    "",
    None,
    "\x00 \x0b \x1c  ",
    "the the the of",
    " \n ",
]


def base(text):
    found = words(text)
    windows = [tuple(found[k : k + 3]) for k in range(len(found) - 2)]
    covered = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    lines = [x for x in (text or "").encode().split(b"\n") if x.split()]
    return {
        "n_words": len(found),
        "word_chars": sum(len(w.decode()) for w in found),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(found) < 50 or 100 * len(covered) > 50 * len(found),
    }


def test_base_measures(documents):
    rng = random.Random(2)
    texts = TEXTS + [" ".join(rng.choice("abcdefgh") for _ in range(n)) for n in (49, 50, 51, 300)]
    texts += ["\n".join(rng.choice(["ab c", "d", " ", "e f g"]) for _ in range(40))]
    texts += [" ".join(f"w{k}" for k in range(n)) for n in (49, 50, 20_000)]
    for r in divergence.judge(documents(texts)).collect():
        assert {k: r[k] for k in divergence.BASE} == base(texts[r.doc_id]), texts[r.doc_id]


def test_distance_is_that_of_jensen_and_shannon():
    p, q = np.array([[3, 1, 0]]), np.array([1, 1, 2])
    a, b = p[0] / 4, q / 4
    m = (a + b) / 2
    want = sum(0.5 * x * np.log2(x / z) for s in (a, b) for x, z in zip(s, m, strict=True) if x)
    assert divergence.distance(p, q)[0] == pytest.approx(np.sqrt(want))
    assert divergence.distance(p, p[0])[0] == 0
    assert divergence.distance(np.array([[1, 0]]), np.array([0, 1]))[0] == 1


def test_documents_far_from_their_language_go(documents):
    rng = random.Random(3)
    common = divergence.COMMON_WORDS["en"].split()

    def english(n):
        return " ".join(rng.choice(common) if rng.random() < 0.4 else f"wo{rng.choice('abcde')}rd{rng.choice('ilmno')}t" for _ in range(n)) + "."

    good = [english(rng.randrange(60, 300)) for _ in range(80)]
    bad = [" ".join(f"x{rng.randrange(10**6)}***" for _ in range(100)), " | ".join(["zq%$#"] + [f"k{k}" for k in range(90)])]
    kept = {r.doc_id: r.kept for r in divergence.judge(documents(good + bad)).collect()}
    assert all(kept[k] for k in range(80)) and not kept[80] and not kept[81]


def test_small_groups_are_no_references(documents):
    rng = random.Random(6)
    common = divergence.COMMON_WORDS["en"].split()

    def english(n):
        return " ".join(rng.choice(common) if rng.random() < 0.4 else f"wo{rng.choice('abcde')}rd{rng.choice('ilmno')}t" for _ in range(n)) + "."

    def junk(n):
        return " ".join(f"x{rng.randrange(10**6)}***" for _ in range(n))

    rows = [(k, english(rng.randrange(60, 300)), "en") for k in range(80)]
    # A language with one document, with one long one, with few documents, with few words; codes of none.
    rows += [(80, junk(100), "xa"), (81, junk(5000), "xb")]
    rows += [(82 + k, junk(600), "xc") for k in range(9)]
    rows += [(100 + k, junk(60), "xd") for k in range(20)]
    rows += [(200 + k, junk(300), lang) for k, lang in enumerate(["und", "", " ", "UND", None] * 20)]
    rows += [(400, junk(100), "en"), (401, english(200), "xe"), (402, english(200), "und")]
    kept = {r.doc_id for r in divergence.judge(documents(rows)).collect() if r.kept}
    assert kept == {*range(80), 401, 402}
    assert sorted(divergence.references(documents(rows))) == ["en"]


def test_odd_rows_of_quality(documents):
    assert divergence.judge(documents([])).collect() == []
    text = " ".join(f"w{k}" for k in range(60))
    odd = documents([(None, text, None), (None, text, None), (1, None, "en")])
    odd = odd.withColumnRenamed("source", "kept").withColumnRenamed("n_chars", "n_words")
    got = [(r.n_words, r.kept) for r in divergence.judge(odd).collect()]
    assert sorted(got) == [(0, False), (60, True), (60, True)]


def toxic_rows(n=400, seed=4):
    rng = random.Random(seed)
    plain, insults = [f"w{k}" for k in range(500)], ["vermin", "oaf", "numbskull", "grublich", "grubend"]
    rows = []
    for k in range(n):
        parts = [rng.choice(plain) for _ in range(rng.randrange(20, 120))]
        toxic = int(k % 4 == 0)
        for _ in range(rng.randrange(2, 6) * toxic):
            parts[rng.randrange(len(parts))] = rng.choice(insults).capitalize() + rng.choice(["", ",", "!"])
        rows.append((k, " ".join(parts), toxic))
    return rows


def test_toxic_texts_score_higher(spark, documents):
    rows = toxic_rows()
    docs = documents([(k, t, "en") for k, t, _ in rows])
    labels = spark.createDataFrame([(k, y) for k, _, y in rows if k % 2], "doc_id long, toxic int")
    labels = labels.unionByName(spark.createDataFrame([(k, y) for k, _, y in rows if k % 8 == 0], labels.schema))
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values())
    right = [got[k].predicted == y == int(got[k].score >= 0.5) for k, _, y in rows if k % 2 == 0]
    assert np.mean(right) > 0.97


def test_rare_toxic_texts_are_learned_from_all_labels(spark, documents):
    rows = [(k, t, y) for k, (_, t, y) in enumerate(r for r in toxic_rows(4000) if not r[2] or r[0] % 100 == 0)]
    docs = documents([(k, t, "en") for k, t, _ in rows])
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")
    settings = toxicity.Settings(sample=200)
    model = toxicity.fit(docs, labels, settings)
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
    toxic = {k for k, _, y in rows if y}
    assert len(toxic) == 40 and sum(got[k] for k in toxic) >= 38
    assert sum(got.values()) <= 42


def test_batches_of_toxicity_are_bounded_in_bytes(spark, documents):
    spark.conf.set(BATCH, "64m")
    docs = documents(["fine words"] * 3)
    toxicity.score(docs, toxicity.Model())
    assert spark.conf.get(BATCH) == str(BATCH_BYTES)
    spark.conf.set(BATCH, "64m")
    toxicity.fit(docs, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"))
    assert spark.conf.get(BATCH) == str(BATCH_BYTES)


def test_the_sample_is_bounded_in_rows_and_bytes_for_each_class(spark, documents):
    rows = [(k, "word " * 20, int(k % 10 == 0)) for k in range(200)]
    docs = documents([(k, t, "en") for k, t, _ in rows])
    known = toxicity.learned(spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int"))

    def drawn(**settings):
        got = toxicity.bounded(docs, known, 20, 180, toxicity.Settings(**settings)).collect()
        return [sum(r.toxic == y for r in got) for y in (True, False)]

    assert drawn(sample=100) == [20, 80]
    assert drawn(sample=20) == [10, 10]
    assert drawn(sample=100, sample_bytes=1000) == [5, 5]


def test_wrong_labels_are_borne(spark, documents):
    rng = random.Random(9)
    rows = toxic_rows(400)
    docs = documents([(k, t, "en") for k, t, _ in rows])
    caught = []
    for share in (0.0, 0.1, 0.2):
        wrong = {k for k, _, _ in rows if rng.random() < share}
        labels = [(k, 1 - y if k in wrong else y) for k, _, y in rows]
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        got = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
        caught.append(sum(got[k] for k, _, y in rows if y))
        assert sum(got[k] for k, _, y in rows if not y) <= 0.02 * len(rows)
    assert caught[1] >= 0.9 * caught[0] and caught[2] >= 0.9 * caught[0]


def test_votes_and_features_are_those_of_plain_counting():
    import pyarrow as pa

    texts = ["bad WORDS, bad!", None, "", "you YOU you", "good thing good nice", "words !!!!", "badly worded"]
    known = {"bad": 0, "words": 1, "nice": toxicity.TOXIC_VOTERS}
    terms = toxicity._hash(list(known))
    order = np.argsort(terms)
    model = toxicity.Model(terms[order], np.array(list(known.values()))[order])
    w = arrays.words(*arrays.texts(pa.array(texts)))
    cast, hits = toxicity.votes(w, model)
    rows, columns, values = toxicity.features(w, model)
    for k, text in enumerate(texts):
        found = (text or "").lower().split()
        bare = [x.strip("!,") or x for x in found]
        want = [sum(x == term for x in bare) for term in known]
        assert [hits[k, v] for v in known.values()] == want and hits[k].sum() == sum(want)
        letters = [c for c in text or "" if c.isalpha()]
        capital = sum(c.isupper() for c in letters)
        loud, address = (text or "").count("!"), sum(x in toxicity.ADDRESS for x in bare)
        n = max(len(found), 1)
        pattern = [2 * capital > max(len(letters), 1), 4 * loud > n, 20 * address > n, 100 * sum(want[:2]) > n]
        assert cast[k, -4:].tolist() == pattern
        # Words and their longer beginnings, each the square root of its share.
        own = values[(rows == k) & (columns < 2 * toxicity.BUCKETS)]
        begun = [x[:5] for x in bare if len(x) > 5]
        share = [bare.count(x) / n for x in set(bare)] + [begun.count(x) / n for x in set(begun)]
        assert sorted(own**2) == pytest.approx(sorted(share))


def test_label_model_finds_rates_and_correlated_voters():
    rng = np.random.default_rng(5)
    n, prior = 40_000, 0.2
    toxic = rng.random(n) < prior
    clean_rate, toxic_rate = np.array([0.02, 0.05, 0.01, 0.1, 0.03, 0.08]), np.array([0.5, 0.6, 0.4, 0.7, 0.3, 0.5])
    cast = rng.random((n, 6)) < np.where(toxic[:, None], toxic_rate, clean_rate)
    cast = np.concatenate([cast, cast[:, :1]], axis=1)
    full = np.concatenate([cast, np.ones((n, 1), bool)], axis=1).astype(float)
    fires, pairs = toxicity.label_model(full.T @ full, prior)
    assert (0, 6) in pairs
    assert np.abs(fires[1, 1:6] - toxic_rate[1:]).max() < 0.12
    assert np.abs(fires[0, 1:6] - clean_rate[1:]).max() < 0.04


def test_odd_rows_of_toxicity(spark, documents):
    docs = documents([(None, "a b", None), (1, None, "en"), (1, "", "en"), (2, "x " * 30_000, "en")])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    odd = docs.withColumnRenamed("lang", "score").withColumnRenamed("source", "cell")
    assert [r.score for r in toxicity.score(odd, toxicity.fit(docs, none)).collect()] == [0.0] * 4
    rows = toxic_rows(80)
    more = docs.unionByName(documents([(k + 10, t, "en") for k, t, _ in rows]))
    labels = spark.createDataFrame([(k + 10, y) for k, _, y in rows] + [(None, 1), (11, None)], none.schema)
    got = toxicity.score(more, toxicity.fit(more, labels)).collect()
    assert len(got) == 84 and all(0 <= r.score < 0.5 for r in got if r.doc_id in (None, 1, 2))
    assert toxicity.score(documents([]), toxicity.Model()).collect() == []


def test_words_of_blocks():
    import pyarrow as pa

    texts = ["a bc", None, "", "  d\te\x0bf", "é x"]
    w = arrays.words(*arrays.texts(pa.array(texts)))
    got = [w.data[a:b].tobytes() for a, b in zip(w.starts, w.ends, strict=True)]
    assert got == [x for t in texts for x in words(t)]
    assert w.per_text.tolist() == [len(words(t)) for t in texts]
