"""Quality, toxicity, personal data and quotations."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import EDGES, words
from plumbline.llm import pii, quality, quoting, toxicity


def plain_counts(text):
    w = words(text)
    places = {}
    for i in range(len(w) - 7):
        places.setdefault(tuple(w[i:i + 8]), []).append(i)
    covered = {k for at in places.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


# ------------------------------------------------------------------- quality
def test_counts_and_base_rule(spark, edges, corpus):
    docs = edges.select("doc_id", "text").union(corpus.select("doc_id", "text"))
    docs = docs.union(spark.createDataFrame([(90, "a b c d e f g h " * 4 + "end"), (91, "#$ " * 9 + "<|x|>\n<|x|>")], "doc_id long, text string"))
    text = [r.text for r in docs.collect()]
    got = quality.verdicts(docs, "doc_id").collect()
    want = [plain_counts(t) for t in text]
    assert sorted(tuple(r[n] for n in quality.FEATURES) for r in got) == sorted(want)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.posterior >= 0.5)


def test_keeps_rows_and_columns(edges):
    kept = quality.keep_good(edges)
    assert kept.columns == edges.columns
    assert {r.doc_id for r in kept.collect()} == {
        r.doc_id for r in quality.verdicts(edges, "doc_id").where("kept").collect()}
    assert quality.keep_good(edges.limit(0)).count() == 0
    assert quality.verdicts(edges.limit(0), "doc_id").count() == 0


def test_estimation_finds_which_rules_tell():
    r = random.Random(1)
    patterns = {}
    for _ in range(4000):
        good = r.random() < 0.8
        votes = tuple(-1 if r.random() < (0.001 if good else 0.6) else 1 if r.random() < 0.5 else 0 for _ in range(4))
        patterns[votes] = patterns.get(votes, 0) + 1
    model = quality.estimate(sorted(patterns.items()), 4)
    assert all(b[0] > 0.4 and g[0] < 0.05 for g, b in zip(model.on_good, model.on_bad))
    start = quality.estimate([], 2)
    assert start.on_good[0] == pytest.approx(quality.START_GOOD) and start.on_bad[1] == pytest.approx(quality.START_BAD)


def test_junk_goes_and_prose_stays(spark, corpus):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = quality.verdicts(docs, "doc_id").join(labels, "doc_id").where("not base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.25 * len(bad)


# ------------------------------------------------------------------ toxicity
def subsequence_kernel(a, b):
    def table(w):
        out = {}
        for i, j, k in itertools.combinations(range(len(w)), 3):
            if k - i < toxicity.SPAN:
                u = w[i] + w[j] + w[k]
                out[u] = out.get(u, 0) + toxicity.DECAY ** (k - i + 1)
        return out

    x, y = table(a), table(b)
    dot = lambda p, q: sum(v * q.get(u, 0) for u, v in p.items())
    return dot(x, y) / max(1e-9, (dot(x, x) * dot(y, y)) ** 0.5)


def test_word_kernel_against_enumeration():
    marks = ["banana", "idiot", "clown", "aaaa"]
    got = toxicity.Landmarks(marks).kernel(["idxiot", "bandana", "clwn", "ab", "aaaaa", "zzz"])
    for i, w in enumerate(["idxiot", "bandana", "clwn", "ab", "aaaaa", "zzz"]):
        for j, m in enumerate(marks):
            assert got[i, j] == pytest.approx(subsequence_kernel(w, m), abs=1e-5)


def test_reading_of_tokens():
    assert toxicity.letters("Id1ot!!") == "idiot" and toxicity.letters("i.d.i.o.t") == "idiot" and toxicity.letters("123") == ""
    assert ["you", "idiot", "!"] in toxicity.sentences("you i d i o t !")
    assert toxicity.sentences("") == [[]]


def test_scores_do_not_depend_on_batches():
    model = toxicity.Model(("idiot", "clown"), np.array([3.0, 2.0]), -1.0, 1.0, 0.0)
    texts = ["a clown here. what an idiot", "", "x " * 500, "nothing", "clown clown clown"]
    whole = toxicity.Scorer(model).margins(texts)
    assert whole.tolist() == [toxicity.Scorer(model, most=1).margins([t])[0] for t in texts]
    assert whole[1] == -1.0 and whole[4] == pytest.approx(toxicity.Scorer(model).margins(["clown"])[0])


def test_held_out_labels_and_inserted_letters(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("lang = 'en'")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = toxicity.train(docs, labels.where(fold != 0).select("doc_id", "toxic"))
    rows = toxicity.scored(docs, model, "doc_id").join(labels, "doc_id").where(fold == 0).collect()
    hit = [r.score >= 0.5 for r in rows if r.toxic == 1]
    false = [r.score >= 0.5 for r in rows if r.toxic == 0]
    assert sum(hit) >= 0.85 * len(hit) and sum(false) <= 0.03 * len(false)
    clean, whole, inserted, spelled, dotted = toxicity.Scorer(model).margins(["hill", "worthless", "worthxless", "w o r t h l e s s", "w.o.r.t.h.l.e.s.s"])
    assert clean < inserted < whole and spelled == dotted == whole


def test_toxicity_edges(spark, edges):
    no_labels = spark.createDataFrame([], "doc_id long, toxic int")
    flat = toxicity.train(edges, no_labels)
    rows = toxicity.scored(edges, flat, "doc_id").collect()
    assert len(rows) == len(EDGES) and {round(r.score, 6) for r in rows} == {0.5}
    odd = spark.createDataFrame([(4, 1), (4, 0), (13, 0), (None, 1), (6, None), (8, 7), (8, 1), (999, 1)], "doc_id long, toxic int")
    model = toxicity.train(edges, odd)
    rows = toxicity.scored(edges, model, "doc_id").collect()
    assert all(0 <= r.score <= 1 for r in rows)
    kept = toxicity.drop_toxic(edges, model)
    assert kept.columns == edges.columns and kept.count() == sum(r.score < 0.5 for r in rows)
    assert toxicity.drop_toxic(edges.limit(0), model).count() == 0


# ------------------------------------------------------------- personal data
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(t):
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(t)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(t):
        d = re.sub("[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and pii.luhn(d):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(t) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def test_base_spans_against_the_patterns():
    r = random.Random(3)
    parts = ["a", "b_", "1", "22", "333", "4444", "@", ".", "-", " ", "+", "(", ")", "%", "_", "\n", "é", "4111111111111111", "x@y.com", "1.2.3.4"]
    for _ in range(20_000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 16)))
        assert plain_spans(text) == pii.base_spans(text), repr(text)


def test_viterbi_against_enumeration():
    r = np.random.default_rng(2)
    model = pii.default_field()
    scores = [r.standard_normal((int(r.integers(0, 5)), len(pii.LABELS))) for _ in range(25)]
    for x, path in zip(scores, pii.viterbi(scores, model.move, model.first)):
        value = lambda p: (model.first[p[0]] + sum(x[i, p[i]] for i in range(len(p)))
                           + sum(model.move[a, b] for a, b in zip(p, p[1:]))) if p else 0.0
        best = max(map(value, itertools.product(range(len(pii.LABELS)), repeat=len(x))))
        assert value(tuple(path)) == pytest.approx(best)


def test_field_on_unseen_fillings():
    model = pii.default_field()
    right = wanted = wrong = 0
    for text, spans in pii.labelled_rows(copies=4, seed=99):
        got = set(pii.find_spans([text], model)[0][1])
        wanted += len(spans)
        right += len(got & set(spans))
        wrong += len(got - set(spans))
    assert right >= 0.9 * wanted and wrong <= 0.08 * wanted


def test_detect_and_mask(spark, edges):
    rows = [(1, "mail ann.b@x.org or +1 (555) 010-7788, host 10.0.0.300 and 10.0.0.3"), (2, "tel 555-123-4567 please"),
            (3, "he paid 4111 1111 1111 1111 there"), (4, "plain words only"), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.detect(df, "doc_id").collect()}
    assert [got[1][f"n_{k}"] for k in pii.KINDS] == [1, 1, 0, 1] and got[3].n_card == 1
    assert got[2].n_phone == 0 and [s.kind for s in got[2].spans] == ["phone"] and not got[2].spans[0].base
    assert got[4].listed == "" and got[5].listed == ""
    assert got[1].listed.split(",")[0] == "email:5:16"
    text = {r.doc_id: r.text for r in pii.mask(df).collect()}
    assert text[3] == "he paid [CARD] there" and text[5] is None and "ann" not in text[1] and text[4] == rows[3][1]
    masked = pii.mask(edges)
    assert masked.columns == edges.columns and masked.count() == len(EDGES)
    assert len(pii.detect(edges, "doc_id").collect()) == len(EDGES) and pii.detect(edges.limit(0), "doc_id").count() == 0


def test_covered_and_touched_stretches_against_all_pairs():
    r = random.Random(4)
    for _ in range(300):
        spans = [("ip", a, a + r.randint(1, 9)) for a in (r.randint(0, 40) for _ in range(r.randint(0, 6)))]
        cover = pii._Cover(spans)
        for a in range(50):
            b = a + r.randint(1, 6)
            assert cover.covers(a, b) == any(s <= a and b <= e for _, s, e in spans)
            assert cover.touches(a, b) == any(s < b and e > a for _, s, e in spans)


def test_many_addresses_take_linear_time():
    import time

    text = " ".join(f"10.0.{i % 250}.{i % 199}" for i in range(10_000))
    began = time.process_time()
    (base, _), = pii.find_spans([text], pii.default_field())
    assert len(base) == 10_000 and time.process_time() - began < 20


def test_long_runs_take_linear_time():
    text = "a" * 200_000 + " @ " + "1" * 200_000 + "." * 50_000 + "+1" + " " * 100_000
    assert pii.find_spans([text], pii.default_field())[0][0] == []


# ---------------------------------------------------------------- quotations
def test_nested_quotes_and_threads(spark):
    rows = [
        (1, 0, "u", "Hello there, world!\n\nHow do I cook rice?"), (1, 1, "a", "> How do I cook rice?\n\nBoil it."),
        (1, 2, "u", "> > how do i cook   rice\n> Boil it.\n\nFor how long?\n> never said"), (1, 3, "a", "no quote"),
        (1, 4, "a", ">For how long?\nTen minutes.\n>>Boil it."), (1, 4, "a", ">For how long?\nTen minutes.\n>>Boil it."),
        (2, 0, "u", "> How do I cook rice?\nx"), (None, 1, "u", "> x"), (3, None, "u", None), (4, 0, None, ""), (4, 1, "u", "> !!!\n>"),
        (5, 3, "u", "> later\nown"), (5, 9, "u", "later"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("origin", F.lit("clash"))
    got = quoting.link_quotes(df).collect()
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn): (r.n_quotes, r.n_linked, r.reply_to, r.thread, r.depth) for r in got}
    assert by[1, 1] == (1, 1, 0, 0, 1) and by[1, 2] == (3, 2, 1, 0, 2) and by[1, 4] == (2, 2, 2, 0, 3)
    assert by[1, 3] == (0, 0, None, 3, 0) and by[2, 0] == (1, 0, None, 0, 0) and by[4, 1][:2] == (1, 0)
    assert by[5, 3] == (1, 0, None, 3, 0), "a message cannot quote a later one"
    assert by[None, 1][1] == 0 and by[3, None][3] is None
    text = {(r.conv_id, r.turn): r.text for r in got}
    assert text[1, 4] == "Ten minutes." and text[1, 1] == "\nBoil it." and text[4, 0] == ""
    assert quoting.link_quotes(df.limit(0)).count() == 0


def test_long_chains_and_many_copies(spark):
    rows = [(1, 0, "u", "line 0")] + [(1, i, "u", f"> line {i - 1}\nline {i}") for i in range(1, 60)]
    rows += [(2, i, "u", "the same words" if i == 0 else "> the same words\nthe same words") for i in range(300)]
    got = quoting.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    by = {(r.conv_id, r.turn): r for r in got}
    assert by[1, 59].thread == 0 and by[1, 59].depth == 59
    assert all(by[2, i].reply_to == 0 and by[2, i].depth == 1 for i in range(1, 300))
