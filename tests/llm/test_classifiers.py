import numpy as np
import pytest

from tabulaire.llm import language, quality, toxicity
from tabulaire.llm.words import labelled_sample
from tests.llm.conftest import ODD

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


def test_languages_of_held_out_texts(docs):
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 200 and np.mean([r.lang_pred == r.lang for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(odd, none):
    got = language.identify(odd).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (2, 3, 7, -9)) and by[1].lang_pred in ("en", "de")
    assert by[None].held_out is False
    assert language.identify(none).count() == 0
    unlabelled = odd.withColumn("lang", odd["lang"].substr(9, 9)).where("false").union(odd).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}


SAMPLE = [(f"{w} " * 5, y) for w, y in [("the cat", "en"), ("der hund", "de"), ("the dog", "en"), ("die katze", "de")] * 20]


def naive_grams(text):
    """All n-grams of a text between blanks, one after the other, hashed one by one."""
    c = [ord(x) for x in f" {text} ".lower().replace("ς", "σ")]
    out = []
    for n in language.ORDERS:
        for i in range(len(c) - n + 1):
            h = n
            for j in range(n):
                h = ((h ^ c[i + j]) * int(language._MULTIPLY[j])) % 2**32
                h ^= h >> 15
            out.append(h % language.BUCKETS)
    return out


def test_slices_lose_and_add_no_grams(monkeypatch):
    for text in ("", "a", "İI ΟΔΟΣ ΣΑΣ straße 東京 " * 7, "abc " * 30):
        monkeypatch.setattr(language, "SLICE", 1 << 20)
        assert sorted(np.concatenate(list(language.grams(text))).tolist()) == sorted(naive_grams(text))
        for size in (1, 2, 3, 7, len(text) or 1):
            monkeypatch.setattr(language, "SLICE", size)
            assert sorted(np.concatenate(list(language.grams(text))).tolist()) == sorted(naive_grams(text))


def test_training_equals_a_naive_one(monkeypatch):
    """Follow-the-regularised-leader weight by weight, with the penalties in closed form, and scores gram by gram."""
    import math
    from collections import Counter, defaultdict

    alpha, beta, l1, l2, sample = 0.5, 1.0, 1e-3, 1e-2, SAMPLE[:20]
    model = language.fit(sample, 2, alpha, beta, l1, l2)
    docs = [Counter(naive_grams(t)) for t, _ in sample]
    df = Counter(f for d in docs for f in d)
    idf = {f: math.log((1 + len(docs)) / (1 + n)) + 1 for f, n in df.items()}
    classes = ["de", "en"]
    z, n = defaultdict(float), defaultdict(float)

    def weight(f, k):
        v = z[f, k]
        return 0.0 if abs(v) <= l1 else -(v - math.copysign(l1, v)) / ((beta + math.sqrt(n[f, k])) / alpha + l2)

    train = [i for i in range(len(docs)) if i % 5]
    rng = np.random.default_rng(7)
    for _ in range(2):
        for i in rng.permutation(train):
            x = {f: c / sum(docs[i].values()) * language.SCALE * idf[f] for f, c in docs[i].items()} | {"bias": 1.0}
            w = {(f, k): weight(f, k) for f in x for k in range(2)}
            s = [sum(x[f] * w[f, k] for f in x) for k in range(2)]
            p = np.exp(np.array(s) - max(s)) / np.exp(np.array(s) - max(s)).sum()
            for f in x:
                for k in range(2):
                    g = x[f] * (p[k] - (classes[k] == sample[i][1]))
                    z[f, k] += g - (math.sqrt(n[f, k] + g * g) - math.sqrt(n[f, k])) / alpha * w[f, k]
                    n[f, k] += g * g
    raw = []
    for text in ("the cat and the hund", "die", "zzz q"):
        d = Counter(naive_grams(text))
        total = sum(d.values())
        raw.append([sum(c / total * language.SCALE * idf.get(f, math.log(1 + len(docs)) + 1) * weight(f, k) for f, c in d.items()) + weight("bias", k) for k in range(2)])
        got = model.predict([text])
        scale = model.logits(text) / np.array(raw[-1])
        assert scale[0] == pytest.approx(scale[1], rel=1e-3) and got["lang_pred"][0] == classes[int(np.argmax(raw[-1]))]
        q = np.exp(model.logits(text))
        assert got["score"][0] == pytest.approx(q.max() / q.sum(), abs=1e-6)


def test_temperature_and_many_languages():
    model = language.fit(SAMPLE)
    assert model.classes == ["de", "en"] and model.logits("the cat and the dog").argmax() == 1
    assert (model.table == 0).mean() > 0.9, "most weights are exactly 0"
    many = language.fit([(f"{chr(0x4E00 + i)} word", f"l{i:03d}") for i in range(300)], 1)
    assert len(many.classes) == 300 and many.table.size <= language.CELLS
    tie = language.LanguageModel(["a", "b"], np.zeros((language.BUCKETS, 2)), np.zeros(2))
    assert tie.predict(["x"]) == {"lang_pred": ["a"], "score": [0.5]}


@pytest.mark.parametrize(("module", "column", "least"), [(toxicity, "toxic", 0.9), (quality, "quality", 0.95)])
def test_labels_of_held_out_texts(docs, labels, module, column, least):
    rows = module.score_documents(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50 and np.mean([r.predicted == r[column] for r in rows]) > least
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


@pytest.mark.parametrize(("module", "column"), [(toxicity, "toxic"), (quality, "quality")])
def test_odd_rows(spark, odd, none, module, column):
    labels = spark.createDataFrame([(1, 1, 7), (2, 0, 7), (4, 0, 7), (4, 1, 7), (6, None, 7), (None, 1, 7)], f"doc_id long, {column} int, value int")
    got = module.score_documents(odd, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == len(ODD)
    assert all(0 <= r.score <= 1 for r in got.collect())
    by = {r.doc_id: r.score for r in got.collect()}
    if module is quality:
        rate = quality.learn(odd, toxicity.labels_of(labels, column)).rate
        assert by[2] == by[3] == pytest.approx(rate), "null and empty texts have the share of label 1"
    else:
        known = toxicity.learn(odd.selectExpr("doc_id", "text", "lang"), toxicity.labels_of(labels, column))
        assert by[2] == by[3] == pytest.approx(float(known.score([""])["score"][0])), "null and empty texts have the score of a text without known words"
    assert module.score_documents(odd, labels.limit(0)).count() == len(ODD)
    assert module.score_documents(none, labels).count() == 0


def test_network_sees_all_that_matters():
    rng = np.random.default_rng(0)
    sample = [(" ".join(rng.choice(["one", "two", "three", "four"], 200)) + (" vile" if i % 2 else ""), i % 2) for i in range(120)]
    model = toxicity.fit(sample, language.fit([]))
    assert [model.score([t])["predicted"][0] for t, _ in sample[:20]] == [y for _, y in sample[:20]]
    assert model.score(["VILENESS one two"])["score"][0] > model.score(["one two", "", None])["score"].max()
    rows = model.vocabulary.rows(toxicity.features(b"one vile two " * 50 + b"three " * 100 + b"vile"))
    full = np.vstack([rows, np.zeros((3, rows.shape[1]), rows.dtype)])
    pooled = np.maximum(np.concatenate([y.max(0) for y in model.network.maps(model.network.embed(full))]), 0)
    assert rows[:, 0].all(), "every word of some documents has an embedding"
    assert model.network.logit(rows) == pytest.approx(float(pooled @ model.network.out + model.network.bias[0]), abs=1e-4)


def test_neighbours_are_exact():
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"], 30)) for _ in range(60)]
    texts += texts[:7]  # equal vectors of both labels
    model = quality.fit([(t, i % 2) for i, t in enumerate(texts)], rank=8)
    asked = [*texts[:5], texts[3] + " gamma", "zzz"]
    for p, v in zip(model.score(asked)["score"], model.vectorise(asked), strict=True):
        near = [round(float(x @ v), quality.PLACES) for x in model.vectors.astype(float)]
        last = sorted(near)[-quality.NEIGHBOURS]
        free, ties = quality.NEIGHBOURS - sum(x > last for x in near), near.count(last)
        weight = [max(x, 1e-3) ** quality.SHARPNESS * (1 if x > last else free / ties if x == last else 0) for x in near]
        assert p == pytest.approx(np.dot(weight, model.labels) / sum(weight) if v.any() else 0.5, abs=2e-2)


def test_order_of_labels_has_no_effect():
    rng = np.random.default_rng(2)
    sample = [(" ".join(rng.choice(["alpha", "beta", "gamma"], 3)), i % 3 and 1) for i in range(60)] * 2
    texts = ["", None, "a", "alpha beta gamma", "beta beta beta", "0123456789"]
    scores = [quality.fit([sample[i] for i in rng.permutation(len(sample))], 0.7).score(texts)["score"] for _ in range(3)]
    assert scores[0][:3].tolist() == [0.7, 0.7, 0.7] and np.allclose(scores[0], scores[1], atol=1e-3) and np.allclose(scores[0], scores[2], atol=1e-3)
    assert quality.initials("Ab  cD\n\tÉf | x".encode()) == b"ac\xc3|x" and quality.initials(b"") == quality.initials(b" \n") == b""


def test_texts_without_shared_terms_have_the_rate():
    sample = [(f"alpha beta gamma {i}", int(i < 90)) for i in range(100)]
    model = quality.fit(sample, 0.9)
    assert model.score(["ЖЩЮ ЖЩЮ ЖЩЮ", "東京東京東京", "", None])["score"].tolist() == [0.9] * 4
    assert not model.vectorise(["ЖЩЮ ЖЩЮ ЖЩЮ"]).any() and model.vectorise(["alpha"]).any()


def test_sample_bounds_hold_for_repeated_ids(spark):
    """Twenty thousand rows of one id, labelled as often: one row of the sample, and all caps hold."""
    docs = spark.range(300).selectExpr("id as doc_id", "concat('text ', id, repeat('.', 10)) as text")
    docs = docs.unionAll(spark.range(20_000).selectExpr("7L as doc_id", "concat('copy ', id % 3, repeat('x', 20)) as text"))
    labels = spark.range(300).selectExpr("id as doc_id", "cast(id % 2 as int) as value").unionAll(spark.range(20_000).selectExpr("7L as doc_id", "cast(id % 2 as int) as value"))
    whole = labelled_sample(docs, labels, 1000, "s")
    assert len(whole) == 300 and sum(t.startswith("copy") or t.startswith("text 7.") for t, _ in whole) == 1
    assert whole == labelled_sample(docs.repartition(5), labels.repartition(3), 1000, "s")
    few = labelled_sample(docs, labels, 20, "s", 1000)
    assert len(few) <= 20 and sum(len(t) for t, _ in few) <= 1000
    only_seven = labelled_sample(docs, labels.where("doc_id = 7"), 20, "s", 1000)
    assert len(only_seven) == 1 and only_seven[0][1] == 0


def test_sample_is_bounded_and_stable(docs, labels):
    marked = toxicity.labels_of(labels, "quality")
    one = labelled_sample(docs, marked, 40, "s")
    assert len(one) == 40 and sum(y for _, y in one) == 20
    assert one == labelled_sample(docs.repartition(7), marked.repartition(5), 40, "s")
    assert sum(len(t) for t, _ in labelled_sample(docs, marked, 40, "s", 20_000)) <= 20_000
    assert labelled_sample(docs, marked.limit(0), 40, "s") == []


def test_sample_has_every_value(spark):
    values = [f"v{i:04d}" for i in range(1500)]
    docs = spark.createDataFrame([(i, "x", v) for i, v in enumerate(values + values[:700])], "doc_id long, text string, value string")
    marks = docs.select("doc_id", "value")
    assert [v for _, v in sorted(labelled_sample(docs, marks, 2000, "s"))] == values
    with pytest.warns(UserWarning, match="label values"):
        assert {v for _, v in labelled_sample(docs, marks, 700, "s")} == set(values[:700])


def test_sample_ends_at_its_cap_by_rank(spark):
    docs = spark.createDataFrame([(i, "x" * (900 if i % 2 else 10), 0) for i in range(60)] + [(99, "y" * 9000, 0)], "doc_id long, text string, value int")
    whole = labelled_sample(docs, docs.select("doc_id", "value"), 100, "s")
    short = [t for t in whole if len(t[0]) <= 5000]
    n = next(n for n in range(len(short)) if sum(len(t) for t, _ in short[: n + 1]) > 5000)
    assert len(whole) == 61 and labelled_sample(docs, docs.select("doc_id", "value"), 100, "s", 5000) == short[:n]


def naive_logit(network, rows):
    """Word by word and filter by filter."""
    words = [sum(network.e[r] for r in row) for row in rows] + [np.zeros(toxicity.DIM)] * 2
    z = float(network.bias[0])
    for k, (width, w, b) in enumerate(zip(toxicity.WIDTHS, network.w, network.b)):
        for f in range(toxicity.FILTERS):
            top = max(sum(float(words[at + j] @ w[j][:, f]) for j in range(width)) + b[f] for at in range(len(rows)))
            z += max(top, 0.0) * float(network.out[k * toxicity.FILTERS + f])
    return z


def test_network_equals_a_naive_one():
    """Forward word by word; backward by finite differences of the loss."""
    rng = np.random.default_rng(3)
    network = toxicity.Network(rng.normal(0, 3, 9))
    for a in [network.e[1:], *network.w, *network.b, network.out, network.bias]:
        a += rng.normal(0, 0.4, a.shape).astype(np.float32)
    docs = [np.vstack([rng.integers(0, 10, (n, 7)), np.zeros((3, 7), int)]) for n in (0, 1, 2, 6, 11)]
    labels = np.array([0, 1, 0, 1, 1], np.float32)
    for d in docs:
        assert network.logit(d) == pytest.approx(naive_logit(network, d), abs=1e-4)

    def loss():
        z = np.array([naive_logit(network, d) for d in docs])
        return float(np.mean(np.log1p(np.exp(z)) - labels * z))

    given, found, ge = network.gradients(docs, labels)
    weights = [*network.w, *network.b, network.out, network.bias]
    checks = [(a, at, g[at]) for a, g in zip(weights, given) for at in [tuple(rng.integers(0, n) for n in a.shape) for _ in range(4)]]
    checks += [(network.e, (r, e), ge[i, e]) for i, r in enumerate(found) for e in (0, 5)]
    for a, at, g in checks:
        before = a[at]
        a[at] = before + 1e-3
        up = loss()
        a[at] = before - 1e-3
        down = loss()
        a[at] = before
        assert g == pytest.approx((up - down) / 2e-3, abs=2e-3)


def test_toxicity_of_held_out_texts():
    """Recall and precision at sf0.1: labels of texts whose toxic words were taken out cannot be found."""
    import zlib

    import duckdb

    rows = duckdb.sql("select doc_id, text, lang, toxic from '/root/testdata/sf0.1/documents.parquet' join '/root/testdata/sf0.1/labels.parquet' using (doc_id)").fetchall()
    held = [zlib.crc32(str(r[0]).encode()) % 5 == 0 for r in rows]
    languages = language.fit([(r[1], r[2]) for r, h in zip(rows, held) if not h and r[2]][:1000])
    model = toxicity.fit([(r[1], r[3]) for r, h in zip(rows, held) if not h], languages)
    known = [r for r, h in zip(rows, held) if h]
    found = model.score([r[1] for r in known])["predicted"]
    truth = np.array([r[3] for r in known])
    assert found[truth == 1].mean() > 0.75 and truth[found == 1].mean() > 0.93


def test_features_of_long_words():
    word = "".join(np.random.default_rng(0).choice(list("abcdeé"), 90_000))
    seen = None
    for before in ("", "a ", "-" * 65_534 + " ", "b c " * 20_000):
        got = toxicity.features((before + word + " the end").encode())
        assert len(got) == len(before.split()) - (before[:1] == "-") + 3
        seen = got[-3:] if seen is None else seen
        assert (got[-3:] == seen).all() and got[-3, 0] == 0 and got[-3, 1:].all()
    assert (toxicity.features(b"") == np.zeros((0, 7))).all()


def test_quality_of_held_out_texts():
    """Cosines alone, at sf0.1: nearly all texts of low quality are found and no other is taken for one."""
    import zlib

    import duckdb

    rows = duckdb.sql("select doc_id, text, quality from '/root/testdata/sf0.1/documents.parquet' join '/root/testdata/sf0.1/labels.parquet' using (doc_id)").fetchall()
    held = [zlib.crc32(str(r[0]).encode()) % 3 == 1 for r in rows]
    model = quality.fit([(r[1], r[2]) for r, h in zip(rows, held) if not h])
    known = [r for r, h in zip(rows, held) if h]
    found = model.score([r[1] for r in known])["predicted"]
    truth = np.array([r[2] for r in known])
    assert (found == truth).mean() > 0.99 and (found[truth == 0] == 0).mean() > 0.95 and found[truth == 1].mean() > 0.995


def test_toxicity_learns_from_all_rows(spark):
    """Of 12,000 labelled texts, more than any sample held: each word that four or more training texts have has its row, no other word; all shards and tasks count alike."""
    from pyspark.sql import functions as F

    n, rare = 12_000, 300
    docs = spark.range(n).selectExpr("id as doc_id", f"concat('plain ', if(id % 2 = 0, 'calm', 'vile'), ' rare', (id % {rare * 5}) div 5 * 1000 + (id div {rare * 5}) div 2) as text", "'en' as lang")
    labels = spark.range(n).selectExpr("id as doc_id", "cast(id % 2 as int) as value")
    rows = toxicity.labelled_rows(docs.unionAll(docs), labels.unionAll(labels))
    assert rows.count() == n, "an id is learned once"
    model = toxicity.learn(docs, labels, held=9, epochs=1)
    texts = rows.where(F.pmod("h", F.lit(4)) != 0).select("text").collect()
    count = {}
    for r in texts:
        word = r.text.split()[2]
        count[word] = count.get(word, 0) + 1
    first = lambda word: int(toxicity.features(word.encode())[0, 0])
    known = set(model.vocabulary.hashes.tolist())
    assert {w for w in count if first(w) in known} == {w for w, k in count.items() if k >= toxicity.LEAST_DOCS} and len(count) > 1000
    assert model.score(["plain calm", "plain vile"])["predicted"].tolist() == [0, 1] and model.languages.classes == ["en"]
    again = toxicity.learn(docs.repartition(7), labels.repartition(3), held=9, epochs=1)
    assert (again.network.e == model.network.e).all() and again.shifts == model.shifts, "the same at any partitioning"


def test_toxicity_of_a_text_is_its_own():
    """Texts scored together, and in pieces, have bit for bit the scores that they have alone: those of a naive network, short ones too; row numbers, joined, stand for the same words."""
    rng = np.random.default_rng(2)
    sample = [(" ".join(rng.choice(["one", "two", "three", "four"], 40)) + (" vile" if i % 2 else ""), i % 2) for i in range(120)]
    model = toxicity.fit(sample, language.fit([]))
    texts = [*(t for t, _ in sample[:9]), "", None, "unseen vile", "vile unseen", "unseen words then vile", "x", "vile", "one two " * 700, "q" * 5000 + " vile", "two " * 40_000]
    together = model.logits(texts)
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(toxicity, "LOOK", 5)
        assert (model.logits(texts[:-1]) == together[:-1]).all()
    assert (np.array([model.logits([t])[0] for t in texts]) == together).all()
    docs = [model.vocabulary.rows(toxicity.features((t or "").encode())) for t in texts]
    for rows, z in zip(docs[:-2], together):
        blank = np.zeros((3, rows.shape[1]), rows.dtype)
        if len(rows) < 100:
            assert z == pytest.approx(naive_logit(model.network, np.vstack([rows, blank])), abs=1e-4)
        assert z == pytest.approx(model.network.logit(toxicity.near(rows)), abs=1e-4), "words out of a filter's reach of known ones do not matter"
    forms, places = toxicity.distinct(docs)
    assert not forms[0].any() and len(np.unique(forms, axis=0)) == len(forms) and all((forms[p] == d).all() for p, d in zip(places, docs, strict=True))
    hashes, place, sizes = toxicity.words([(t or "").encode() for t in texts])
    assert (hashes[place] == np.concatenate([toxicity.features((t or "").encode()) for t in texts])).all() and sizes.tolist() == [len(d) for d in docs]
    assert len(np.unique(hashes, axis=0)) == len(hashes), "each word once"
