"""Similarity joins, vectors, the language model, the pipeline and the driver's guard."""

import math
import os
import random
import subprocess
import sys
import zlib

import numpy as np
import pytest

from brute import EDGES, FOLDER, LOW, component_roots, kneser_ney, log10_sum, shingle_set, words
from plumbline.llm import common, jaccard, lm, neighbors


# ------------------------------------------------------------------ components
def test_components_of_chains_stars_and_rings(spark):
    r = random.Random(4)
    pairs = [(i, i + 1) for i in range(0, 400)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5001), (5001, 5000), (7, 7)]
    pairs += [(2000 + r.randrange(300), 2000 + r.randrange(300)) for _ in range(250)] + pairs[:20]
    r.shuffle(pairs)
    got = common.components(spark.createDataFrame([*pairs, (None, 3)], "u long, v long").repartition(6))
    want = component_roots({x for p in pairs for x in p}, pairs)
    assert {x.node: x.root for x in got.collect()} == {n: q for n, q in want.items() if n != q}
    assert common.components(spark.createDataFrame([], "u long, v long")).count() == 0


# --------------------------------------------------------------------- Jaccard
def linked(texts):
    ids = sorted(texts)
    sets = {i: shingle_set(texts[i]) for i in ids}
    pairs = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return sets, component_roots(ids, pairs)


def test_join_finds_every_link(spark, corpus):
    texts = {r.doc_id: r.text for r in corpus.collect()}
    r = random.Random(9)
    for base in range(6):
        w = [f"t{base}_{r.randrange(4000)}" for _ in range(r.choice((12, 40, 200)))]
        for k in range(25):
            own = list(w)
            for _ in range(r.randrange(0, max(2, len(w) // 20))):
                own[r.randrange(len(own))] = f"e{r.randrange(9)}"
            texts[10_000 + base * 100 + k] = " ".join(own[:len(own) - r.randrange(0, 3)])
    passage = " ".join(f"p{i}" for i in range(60))
    for k in range(40):
        texts[20_000 + k] = " ".join(f"u{k}_{i}" for i in range(150)) + " " + passage
    df = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string").repartition(5)
    sets, roots = linked(texts)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard.join_similar(df).collect()}
    assert got == {i: (len(sets[i]), roots[i]) for i in texts}


def test_join_edges(spark, edges):
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard.join_similar(edges).collect()),
                 key=str)
    by = {}
    for null, key, n, c in got:
        by.setdefault(None if null else key, []).append((n, c))
    assert len(got) == len(EDGES)
    assert by[1] == [(0, 1)] and by[2] == [(0, 2)] and by[4] == [(1, 4)] and by[5] == [(1, 4)] and by[6] == by[7] == [(1, 6)]
    assert by[9] == [(6, 8), (6, 8)] and sorted(by[None], key=str) == [(0, None), (6, 8)]
    assert by[14] == [(297, 13)] and by[15] == [(146, 15)]
    assert jaccard.join_similar(edges.limit(0)).count() == 0
    kept = jaccard.keep_one(edges)
    assert kept.columns == edges.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 6, 8, 10, 11, 12, 13, 15, 16, None]))
    twice = jaccard.keep_one(spark.createDataFrame([(3, "a b c"), (3, "a b c"), (4, "x")], "doc_id long, text string"))
    assert sorted(r.doc_id for r in twice.collect()) == [3, 4]


def test_one_row_per_text_without_or_with_repeated_ids(spark):
    w, v, z = (" ".join(f"{c}{i}" for i in range(60)) for c in "wvz")
    rows = [(1, w), (2, w + " more"), (2, v), (2, v), (2, v + " more"), (None, z), (None, z), (None, z + " more"),
            (None, None), (None, ""), (5, ""), (5, ""), (5, None), (7, "other text"), (8, "other text")]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, n int").repartition(3)
    kept = sorted((r.n for r in jaccard.keep_one(df).collect()))
    assert 0 in kept and 1 not in kept and 13 in kept and 14 not in kept
    assert sum(k in kept for k in (2, 3, 4)) == 1
    assert sum(k in kept for k in (5, 6, 7)) == 1
    assert {8, 9, 12} <= set(kept) and (10 in kept) != (11 in kept)
    plain = spark.createDataFrame([(3, w, 0), (4, w + " more", 1), (6, v, 2)], "doc_id long, text string, n int")
    assert sorted(r.n for r in jaccard.keep_one(plain).collect()) == [0, 2]


def test_trees_and_chunk_pairs_lose_nothing():
    r = np.random.default_rng(1)
    sets = []
    for _ in range(12):
        base = r.integers(0, 1 << 62, int(r.integers(1, 120)), dtype=np.uint64)
        for _ in range(9):
            keep = base[r.random(len(base)) > 0.06]
            sets.append(np.unique(np.append(keep, r.integers(0, 1 << 62, int(r.integers(0, 4)), dtype=np.uint64))))
    sets = [s for s in sets if len(s)]
    near = [(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if jaccard._similar(sets[i], sets[j])]
    want = component_roots(range(len(sets)), near)
    assert component_roots(range(len(sets)), jaccard.links(sets)) == want
    sides = (np.arange(len(sets)) % 3 == 0).astype(int)
    across = [p for p in near if sides[p[0]] != sides[p[1]]]
    assert component_roots(range(len(sets)), jaccard.links(sets, sides)) == component_roots(range(len(sets)), across)


def test_small_chunks_give_the_same(spark, monkeypatch):
    w = [f"x{i}" for i in range(100)]
    rows = [(k, " ".join(w[:50] + [f"e{k}"] + w[51:])) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(jaccard, "CHUNK_NODES", 7)
    assert {r.component_id for r in jaccard.join_similar(df).collect()} == {0}


def test_bands_hold_linked_sizes():
    least = np.array(jaccard._bands(1 << 20))
    n = np.arange(1, 200_000)
    band = np.searchsorted(least, n, side="right")
    assert (np.searchsorted(least, n * jaccard.OUT_OF // jaccard.TIMES, side="right") - band <= 1).all()


@pytest.mark.parametrize("notices, per, notice_words, own_words", [(1, 1, 60, 100), (30, 2, 45, 60)])
def test_shared_notices_are_not_dealt_as_pairs(spark, monkeypatch, notices, per, notice_words, own_words):
    """Texts chained by notices they share, linked ones among them: few copies, the same links."""
    r = random.Random(notices)
    notice = [" ".join(f"n{k}_{i}" for i in range(notice_words)) for k in range(notices)]
    texts = {}
    for k in range(360):
        shown = r.sample(notice, per)
        own = [f"u{k}_{i}" for i in range(own_words)]
        texts[k] = " ".join([*shown[:1], *own, *shown[1:]])
        if k % 20 == 0:
            own[r.randrange(own_words)] = "changed"
            texts[10_000 + k] = " ".join([*shown[:1], *own, *shown[1:]])
    alike = [f"a{i}" for i in range(80)]
    for k in range(90):
        texts[20_000 + k] = " ".join([notice[0], *alike[:40], f"e{k}", *alike[41:]])
    counts, verified = [], jaccard._verified

    def counted(dealt):
        counts.append(dealt.count())
        return verified(dealt)

    monkeypatch.setattr(jaccard, "CHUNK_NODES", 20)
    monkeypatch.setattr(jaccard, "_verified", counted)
    df = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string").repartition(5)
    sets, roots = linked(texts)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard.join_similar(df).collect()}
    assert got == {i: (len(sets[i]), roots[i]) for i in texts}
    assert sum(counts) < 3 * len(texts)


def test_common_hashes_of_near_copies_are_not_joined(spark, monkeypatch):
    """Near copies, linked ones and others: their shared words meet no join, and all links are found."""
    r = random.Random(3)
    texts = {k: f"x{k} y z" for k in range(20)}
    for k in range(100, 340):
        own = [f"w{i}" for i in range(90)]
        for at in r.sample(range(90), r.choice((1, 2, 3))):
            own[at] = f"e{k}_{at}"
        texts[k] = " ".join(own)
    rows, join = [], type(spark.range(1)).join

    def counted(one, other, on=None, how=None):
        out = join(one, other, on, how)
        if on == ["cell", "token"]:
            rows.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "CHUNK_NODES", 40)
    monkeypatch.setattr(type(spark.range(1)), "join", counted)
    sets, roots = linked(texts)
    df = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string").repartition(5)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard.join_similar(df).collect()}
    assert got == {i: (len(sets[i]), roots[i]) for i in texts}
    assert len(rows) == 2 and 0 < sum(rows) < sum(map(len, sets.values())) / 2


# --------------------------------------------------------------------- vectors
def test_vectors_against_all_pairs(spark):
    r = np.random.default_rng(5)
    rows, key = [], 0
    for label in range(3):
        for _ in range(8):
            base = r.standard_normal(16)
            for _ in range(int(r.integers(1, 9))):
                rows.append((key, (base + 0.12 * r.standard_normal(16)).astype(np.float32).tolist(), label))
                key += 1
    rows.append((key, rows[0][1], rows[0][2]))
    rows.append((key + 1, rows[0][1], 2 - rows[0][2]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    x = np.array([v for _, v, _ in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([y for _, _, y in rows])
    near = (x @ x.T >= neighbors.THRESHOLD) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    roots = component_roots(range(len(rows)), np.argwhere(near).tolist())
    for chunk in (1024, 2):
        got = {g.vec_id: (g.n_links, g.component_id, g.kept) for g in neighbors.near_duplicates(df, chunk=chunk).collect()}
        assert got == {i: (int(near[i].sum()), roots[i], roots[i] == i) for i in range(len(rows))}


def test_vector_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], 0), (2, [2.0, 4.0], 0), (3, [1.0, 2.0], None), (4, None, 0), (5, [0.0, 0.0], 0), (6, [nan, 1.0], 0),
            (7, [inf, 1.0], 0), (8, [None, 1.0], 0), (9, [], 0), (10, [1.0, 2.0, 0.0], 0), (None, [1.0, 2.0], 0), (1, [1.0, 2.0], 0),
            (11, [1e-300, 2e-300], 0), (12, [1e300, 2e300], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = neighbors.near_duplicates(df.selectExpr("*", "'clash' as node", "'clash' as data")).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    assert by[1] == [(5, 1, True)] * 2 and by[2] == by[11] == by[12] == [(5, 1, False)] and by[None] == [(5, 1, False)]
    for i in (3, 4, 5, 6, 7, 8, 9, 10):
        assert by[i] == [(0, i, True)]
    assert neighbors.near_duplicates(df.limit(0)).count() == 0


def test_recall_on_the_table(spark):
    folder = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = table.collect()
    x = np.array([r.embedding for r in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r.label for r in rows])
    near = (x @ x.T >= neighbors.THRESHOLD) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    found = sum(r.n_links for r in neighbors.near_duplicates(table).collect())
    assert 0.9 * near.sum() <= found <= near.sum()


@pytest.mark.parametrize("common, chunk", [(0.0, 1024), (0.5, 512), (0.5, 1024)])
def test_recall_in_a_large_label(spark, tmp_path, common, chunk):
    import pyarrow as pa
    import pyarrow.parquet as pq

    r, n, size, planted = np.random.default_rng(3), 100_000, 64, 1000
    mean = np.eye(size)[0]
    x = r.standard_normal((n, size)) * (1 - mean)
    x = np.sqrt(common) * mean + np.sqrt(1 - common) * x / np.linalg.norm(x, axis=1, keepdims=True)
    base, t = x[:planted], r.uniform(0.931, 0.95, (planted, 1))
    off = r.standard_normal((planted, size))
    off -= (off * base).sum(axis=1, keepdims=True) * base
    x[n - planted:] = t * base + np.sqrt(1 - t * t) * off / np.linalg.norm(off, axis=1, keepdims=True)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * size + 1, size, dtype=np.int32)), pa.array(x.ravel()))
    pq.write_table(pa.table({"vec_id": np.arange(n), "embedding": lists, "label": np.zeros(n, dtype=np.int32)}),
                   tmp_path / "v.parquet", row_group_size=20_000)
    got = neighbors.near_duplicates(spark.read.parquet(str(tmp_path / "v.parquet")), chunk=chunk)
    least = {g.vec_id: g.component_id for g in got.select("vec_id", "component_id").collect()}
    assert sum(least[i] == least[n - planted + i] for i in range(planted)) >= 0.997 * planted


def test_windows_go_over_partition_edges():
    import pyarrow as pa

    def part(nodes):
        data = [np.array([np.cos(k // 2), np.sin(k // 2)]).tobytes() for k in nodes]
        n = len(nodes)
        return pa.RecordBatch.from_arrays(
            [pa.array([0] * n, pa.int32()), pa.array([7] * n, pa.int64()), pa.array([2] * n, pa.int32()),
             pa.array(nodes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(data, pa.binary())],
            names=["pass", "label", "size", "key", "node", "data"])

    for cuts in ([0, 5, 12], [0, 1, 2, 3, 12], [0, 12], [0, 3, 4, 5, 9, 11, 12]):
        pairs, met = set(), []
        for a, b in zip(cuts[:-1], cuts[1:]):
            halves = [part(list(range(a, (a + b) // 2))), part(list(range((a + b) // 2, b)))]
            for out in neighbors._window_links(0.99, 2, edges=True)(iter(halves)):
                rows = out.to_pylist()
                pairs |= {tuple(sorted((x["u"], x["v"]))) for x in rows if x["u"] is not None}
                met += [x["node"] for x in rows if x["node"] is not None]
        assert len(met) == len(set(met)) and met
        for out in neighbors._window_links(0.99, 2)(iter([part(sorted(met))])):
            pairs |= {tuple(sorted((x["u"], x["v"]))) for x in out.to_pylist()}
        assert pairs == {(k, k + 1) for k in range(0, 12, 2)}


# -------------------------------------------------------------- language model
@pytest.mark.parametrize("order", [2, 3])
def test_model_against_the_formula(corpus, order):
    docs = corpus.limit(80)
    train = docs.where("doc_id % 3 <> 0")
    model = lm.train(train, order)
    tokens = {r.doc_id: words((r.text or "").translate(LOW)) + ["</s>"] for r in docs.collect()}
    p, once = kneser_ney([t for i, t in tokens.items() if i % 3], order)
    total = sum(once.values())
    assert (model.train_tokens, model.distinct_tokens) == (total, len(once))
    history = ("<s>",) * (order - 1)
    assert sum(p(history, w) for w in once) + p(history, "never") == pytest.approx(1)
    for r in lm.score(docs, model, "doc_id").collect():
        t = tokens[r.doc_id]
        assert r.n_tokens == len(t) and r.n_known == sum(w in once for w in t)
        assert r.score == pytest.approx(log10_sum(p, order, t), rel=1e-9)
        assert r.base_score == pytest.approx(sum(math.log10((once[w] + 0.5) / (total + 0.5 * (len(once) + 1))) for w in t), rel=1e-9)


def test_model_beats_single_tokens_on_unseen_texts(corpus):
    held = lm.fold(corpus["doc_id"]) == 1
    model = lm.train(corpus.where(~held))
    rows = lm.score(corpus.where(held), model, "doc_id").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_model_edges(edges):
    none = lm.train(edges.limit(0))
    rows = lm.score(edges, none, "doc_id", "key").collect()
    assert len(rows) == len(EDGES) and all(r.n_known == 0 and r.score == pytest.approx(0) for r in rows)
    model = lm.train(edges)
    rows = lm.score(edges, model, "doc_id").collect()
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    assert lm.score(edges.limit(0), model, "doc_id").count() == 0


def test_large_counts_are_kept(spark):
    df = spark.createDataFrame([(1, "a b " * 400)], "doc_id long, text string")
    tables = lm.Tables(lm.train(df))
    token = lm.words.hashes(np.frombuffer(b"a b", dtype=np.uint8), np.array([0, 3]))[0]
    assert tables.find("w", np.sort(token)).tolist() == [400, 400]


def test_fold_is_crc32(corpus):
    got = corpus.select("doc_id", lm.fold(corpus["doc_id"]).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.doc_id).encode()) % 5 for r in got)


# ------------------------------------------------------------ queries, pipeline
def test_every_operator_has_its_query():
    from plumbline.llm.queries import QUERIES

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name, columns, per", [
    ("op2_", "doc_id held_out score predicted", "documents"), ("op3_", "conv_id turn", "conversations"),
    ("op4_", "doc_id n_email n_ip n_card n_phone base_sha256 spans", "documents"),
    ("op7_", "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept", "documents"),
    ("op8_", "doc_id n_shingles component_id", "documents"), ("op9_", "vec_id n_links component_id kept", "embeddings"),
    ("op10_", "doc_id held_out n_tokens n_known train_tokens base_score score", "documents"),
    ("op13_", "doc_id n_tokens ids_sha256 decoded_sha256", "documents"),
])
def test_queries_return_a_row_per_input_row(spark, name, columns, per):
    from plumbline.llm.queries import QUERIES

    df = next(f for n, f in QUERIES.items() if n.startswith(name))(spark, FOLDER)
    assert set(columns.split()) <= set(df.columns)
    assert df.count() == spark.read.parquet(f"{FOLDER}/{per}.parquet").count()


def test_pipeline_stages(spark, corpus):
    import corpus_pipeline as pipeline

    columns, docs = corpus.columns, corpus.union(corpus.limit(5))
    before = {r.doc_id for r in docs.collect()}
    for name, stage in pipeline.STAGES[:-1]:
        docs = common.written(stage(spark, docs, FOLDER))
        assert docs.columns == columns and dict(docs.dtypes) == dict(corpus.dtypes)
        now = {r.doc_id for r in docs.collect()}
        assert now <= before and now, name
        before = now
    rows = pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {r.doc_id for r in rows} == before
    for name, stage in pipeline.STAGES:
        assert stage(spark, corpus.limit(0), FOLDER).count() == 0, name


def test_the_driver_entry_stands_alone(tmp_path):
    import shutil

    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(top, tmp_path / "copy", ignore=shutil.ignore_patterns("llm", ".git", "corpus_pipeline.py", "spark-warehouse"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and 'pipeline' not in q and not any(n.startswith('op') for n in q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path / "copy", check=True, env={**os.environ, "PYTHONPATH": ""})
