import corpus_pipeline
from tabulaire.llm import near, queries
from tests.llm.conftest import ODD, SCHEMA, rows_of
from tests.llm.test_texts import brute, words

DATA = "/root/testdata/sf0.01"


def test_stages_by_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        if name != "packing":
            assert out.schema == docs.schema
        out.write.parquet(str(tmp_path / name))
        kept[name] = (docs, spark.read.parquet(str(tmp_path / name)))
        docs = kept[name][1]
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    before, after = kept["language_id"]
    assert after.count() > 0.98 * before.count()
    before, after = kept["toxicity"]
    marked = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    gone = ids(before) - ids(after)
    assert sum(marked.get(i) == 1 for i in gone) >= 0.8 * sum(marked.get(i) == 1 for i in ids(before))
    assert sum(marked.get(i) == 0 for i in gone) <= 0.03 * before.count()
    before, after = kept["near_duplicates"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    classes = brute_classes_fast(rows)
    assert ids(after) == {i for i, t in rows if classes[tuple(words(t))] == i}
    before, after = kept["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    grams = {n: {tuple(w[i : i + n]) for _, t in items if (w := words(t)) and min(10, len(w)) == n for i in range(len(w) - n + 1)} for n in range(1, 11)}
    holds = lambda w: any(tuple(w[i : i + n]) in own for n, own in grams.items() if own for i in range(len(w) - n + 1))
    assert ids(after) == {r.doc_id for r in before.collect() if not holds(words(r.text))}
    assert ids(kept["packing"][1]) == ids(after)
    assert corpus_pipeline.run(spark, DATA).count() == kept["packing"][1].count()


def brute_classes_fast(rows):
    """Classes through an inverted index of shingles."""
    texts: dict = {}
    for i, t in rows:
        texts.setdefault(tuple(words(t)), []).append(i)
    keys, index = list(texts), {}
    sets = [{w[i : i + 5] for i in range(max(1, len(w) - 4))} if w else set() for w in keys]
    label = list(range(len(keys)))
    for i, s in enumerate(sets):
        shared: dict = {}
        for g in s:
            for j in index.get(g, ()):
                shared[j] = shared.get(j, 0) + 1
            index.setdefault(g, []).append(i)
        for j, n in shared.items():
            if n >= 0.8 * (len(s) + len(sets[j]) - n):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    first: dict = {}
    for k, c in zip(keys, label, strict=True):
        first[c] = min([*texts[k], first.get(c, texts[k][0])])
    return {k: first[c] for k, c in zip(keys, label, strict=True)}


WORDS = "the cat sat on a mat and saw nothing at all but a dog that ran by the old mill near the river".split()


def write_tables(spark, folder, docs, labels, benchmark):
    spark.createDataFrame(rows_of(docs), SCHEMA).repartition(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_stages_on_odd_tables(spark, tmp_path):
    """Nulls, empty and very long texts, repeated rows and ids, columns whose names clash: rows are kept or go as a whole."""
    import random

    rng = random.Random(1)
    english = lambda: " ".join(rng.choice(WORDS) for _ in range(40))
    clean = [(100 + i, english(), "en") for i in range(60)]
    german = [(200 + i, " ".join(rng.choice("der hund und die katze liefen über das feld zum haus".split()) for _ in range(40)), "de") for i in range(60)]
    bench = [(1, "one two three four five six seven eight nine ten eleven"), (2, None), (None, "x")]
    leak = english() + " Three four five, six seven eight nine TEN eleven twelve two three four five six seven eight nine ten eleven " + english()
    docs = ODD + clean + german + [(500, leak, "en"), (500, leak + " more", "en"), (501, clean[0][1], None), (None, clean[1][1], "en"), (502, english() + " vile " * 3, "en")]
    labels = [(i, 1, i % 2) for i in range(100, 160)] + [(None, 1, 1), (502, None, None)]
    docs = [(i, (t + " vile thing" if i and 100 <= i < 160 and i % 2 else t), y) for i, t, y in docs]
    write_tables(spark, tmp_path, docs, labels, bench)
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {name: stage(spark, frame, str(tmp_path)) for name, stage in corpus_pipeline.STAGES}
    for name in list(kept)[:-1]:
        assert kept[name].schema == frame.schema
        rows = [tuple(r) for r in kept[name].collect()]
        whole = [tuple(r) for r in frame.collect()]
        assert all(rows.count(r) <= whole.count(r) for r in rows), name
        kept[name] = sorted(((r[5], r[3]) for r in rows), key=str)
    assert not {t for _, t in kept["language_id"]} & {None, "", "123 !!! ---", "  \n\t "}
    assert {i for i, _, _ in clean + german} <= {i for i, _ in kept["language_id"]}
    gone = {i for i, _, _ in docs} - {i for i, _ in kept["toxicity"]}
    assert {i for i in gone if i and 100 <= i < 160} == {i for i in range(100, 160) if i % 2} and not gone & set(range(200, 260))
    assert {i for i, _ in kept["decontamination"]} == {i for i, t, _ in docs if not brute(t, bench)[-1]} and 500 in {i for i, _, _ in docs} - {i for i, _ in kept["decontamination"]}
    classes = brute_classes_fast([(10**9 if i is None else i, t) for i, t, _ in docs])
    first = {}
    for i, t, _ in docs:
        first.setdefault(classes[tuple(words(t))], []).append((i, t))
    assert len(kept["near_duplicates"]) == len(first) and all(classes[tuple(words(t))] == (10**9 if i is None else i) for i, t in kept["near_duplicates"])
    ends = [r for r in kept["packing"].collect() if r.doc_id in (2, 3) or r.doc_id is None]
    assert len([r for r in ends if r.doc_id in (2, 3)]) == 2 and all(r.length == 1 for r in ends if r.doc_id in (2, 3))


def test_stages_on_empty_tables(spark, tmp_path):
    write_tables(spark, tmp_path, [], [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    frame = spark.createDataFrame(rows_of(ODD), SCHEMA)
    sizes = {name: stage(spark, frame, str(tmp_path)).count() for name, stage in corpus_pipeline.STAGES}
    assert sizes["language_id"] == 0 and sizes["toxicity"] == sizes["decontamination"] == len(ODD) and sizes["near_duplicates"] < len(ODD)


def test_ten_queries():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 11)]
    assert near.WORDS == 5 and near.SIMILARITY == 0.8
