"""Toxicity by a support vector machine on a gap-weighted subsequence kernel.

Two words are as similar as the three-letter subsequences they share, gaps counted down by
``decay``, so letters that are inserted or left out cost little. A sentence is a set of words;
its kernel with another sums powers of word similarities, and landmark words (Nystrom) turn it
into a short vector. The machine learns from sentences of labelled documents: of a toxic
document the sentence that looks worst, of a clean one the few that come nearest to it. A
document scores as its worst sentence. What a sentence adds to the score is a sum over words,
so every worker scores a word once and keeps it in a bounded cache.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field
from itertools import chain, combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import drop_written, lean, texts_of, written

LENGTH, SPAN, DECAY, POWER = 3, 6, 0.7, 3
#: Letters of a word that are compared; longer words are taken in pieces of this length.
LETTERS = 24
CODES = 32
#: Cost of an altered copy beside that of a document.
ALTERED = 0.05
#: Labelled documents per class that training reads; landmarks; words of a sentence at most.
SAMPLE, LANDMARKS, SENTENCE = 3000, 56, 40

_END = re.compile(r"[.!?\n](?:(?<=\n)|\s)")
_SPELLED = re.compile(r"(?<!\S)[^\W\d_](?:\s[^\W\d_]){2,}(?!\S)")
_ALPHA = re.compile(r"[^\W\d_]+")
_FOLD = str.maketrans("013457@$", "oieastas")


def letters(token: str) -> str:
    """The letters of a token, lowered, with digits and signs that stand for letters read as such."""
    if token.isalpha():
        return token.lower()
    plain = token.strip(".,;:!?\"'()[]-")
    if plain.isalpha():
        return plain.lower()
    if not _ALPHA.search(plain):
        return ""
    return "".join(_ALPHA.findall(plain.lower().translate(_FOLD)))


def sentences(text: str) -> list[list[str]]:
    """Tokens of each part of a text between line or sentence ends.

    Letters that stand alone one after another are joined, so a spelled-out word is one token.
    """
    parts = [part.split() for part in _END.split(text)]
    if _SPELLED.search(text):
        parts = [_joined(p) for p in parts]
    return parts


def _joined(tokens: list[str]) -> list[str]:
    out, run = [], []
    for t in [*tokens, ""]:
        if len(t) == 1 and t.isalpha():
            run.append(t)
            continue
        out += ["".join(run)] if len(run) > 2 else run
        run = []
        if t:
            out.append(t)
    return out


def blocks(word: str) -> list[str]:
    """A word in pieces of at most LETTERS letters; every subsequence within SPAN is in one of them."""
    if len(word) <= LETTERS:
        return [word]
    return [word[i:i + LETTERS] for i in range(0, len(word) - SPAN + 1, LETTERS - SPAN + 1)]


def _codes(words: list[str], size: int) -> np.ndarray:
    """Letters of words of one size as numbers from 1. Letters beyond a-z share the last few."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int32)
    small = (flat >= 97) & (flat <= 122)
    return np.where(small, flat - 96, 27 + flat % 5).reshape(len(words), size)


_TRIPLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _triples(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all subsequences of LENGTH letters within SPAN in a word of a size, and their weights."""
    if size not in _TRIPLES:
        at = np.array([(i, i + j, i + k) for i in range(size) for j, k in combinations(range(1, SPAN), LENGTH - 1) if i + k < size])
        _TRIPLES[size] = at.reshape(-1, LENGTH), (DECAY ** (at[:, -1] - at[:, 0] + 1.0)).astype(np.float32)
    return _TRIPLES[size]


def features(words: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(subsequence numbers, weights, 0 where a number came before) of words of one size, rows sorted."""
    at, weight = _triples(size)
    c = _codes(words, size)
    number = (c[:, at[:, 0]] * CODES + c[:, at[:, 1]]) * CODES + c[:, at[:, 2]]
    # Number and place sort as one; a word has fewer than 512 subsequences.
    number = np.sort(number << 9 | np.arange(len(at), dtype=np.int32), axis=1)
    weight, number = weight[number & 511], number >> 9
    # A subsequence found more than once counts with the sum of its weights.
    again = np.zeros(number.shape, dtype=bool)
    again[:, 1:] = number[:, 1:] == number[:, :-1]
    if again.any():
        first = np.flatnonzero(~again.ravel())
        sums = np.zeros(number.size, dtype=np.float32)
        sums[first] = np.add.reduceat(weight.ravel(), first)
        weight = sums.reshape(number.shape)
    return number, weight


def _dense(words: list[str]) -> np.ndarray:
    """Feature vectors of few words, unit length."""
    out = np.zeros((len(words), CODES ** 3), dtype=np.float32)
    for i, w in enumerate(words):
        if len(w) >= LENGTH:
            number, weight = features([w], len(w))
            np.add.at(out[i], number[0], weight[0])
    return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-9)


class Landmarks:
    """Feature vectors of the landmarks, kept for the subsequences that some landmark has."""

    def __init__(self, names: list[str]):
        dense = _dense(names)
        held = np.flatnonzero(dense.any(axis=0))
        self.place = np.zeros(CODES ** 3, dtype=np.int32)
        self.place[held] = np.arange(1, len(held) + 1)
        self.rows = np.ascontiguousarray(np.vstack([np.zeros(len(names), dtype=np.float32), dense[:, held].T]))

    def kernel(self, words: list[str]) -> np.ndarray:
        """Normalised kernel of each word with each landmark; words too short have none."""
        out = np.zeros((len(words), self.rows.shape[1]), dtype=np.float32)
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) >= LENGTH:
                by_size.setdefault(len(w), []).append(i)
        for size, which in by_size.items():
            step = max(16, 100_000 // len(_triples(size)[0]))
            for at in range(0, len(which), step):
                part = which[at:at + step]
                number, weight = features([words[i] for i in part], size)
                norm = np.sqrt((weight * weight).sum(axis=1))
                place = self.place[number]
                place[weight == 0] = 0
                row, col = np.nonzero(place)
                if len(row):
                    value = self.rows[place[row, col]] * weight[row, col][:, None]
                    first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
                    hit = row[first]
                    out[np.array(part)[hit]] = np.add.reduceat(value, first, axis=0) / norm[hit][:, None]
        return out


@dataclass
class Model:
    """Landmarks, their weights, and the line that turns margins into probabilities."""

    names: tuple[str, ...]
    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    ident: str = field(default_factory=lambda: uuid.uuid4().hex)

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


class Scorer:
    """Scores of documents, with caches of token and word scores of bounded size."""

    def __init__(self, model: Model, most: int = 300_000):
        self.model, self.most = model, most
        self.landmarks = Landmarks(list(model.names))
        self.words: dict[str, float] = {}
        self.old_words: dict[str, float] = {}
        self.number: dict[str, int] = {}
        self.score = np.zeros(1 << 16)
        self.forget()

    def forget(self) -> None:
        """Tokens seen from now on get new numbers; the scores of the last ones are kept once more."""
        self.old_number, self.old_score = self.number, self.score
        self.number = {}
        self.score = np.zeros(1 << 16)

    def _word_scores(self, words: set[str]) -> dict[str, float]:
        """Scores of words, with two generations of a cache, so that frequent ones outlive a full one."""
        if len(self.words) > self.most:
            self.old_words, self.words = self.words, {}
        new = []
        for w in words.difference(self.words):
            if w in self.old_words:
                self.words[w] = self.old_words[w]
            else:
                new.append(w)
        if new:
            known = self.landmarks.kernel(new) ** POWER @ self.model.weights if self.model.names else np.zeros(len(new))
            self.words.update(zip(new, known.tolist()))
        return self.words

    def learn(self, tokens: set[str]) -> None:
        """Give new tokens a number and a score."""
        first = len(self.number)
        if first + len(tokens) > len(self.score):
            self.score = np.concatenate([self.score, np.zeros(max(len(tokens), len(self.score)))])
        known = [t for t in tokens if t in self.old_number]
        new = [t for t in tokens if t not in self.old_number] if known else list(tokens)
        read = list(map(letters, new))
        pieces = set(read)
        long = [w for w in pieces if len(w) > LETTERS]
        pieces.difference_update(long)
        for w in long:
            pieces.update(blocks(w))
        scores = self._word_scores(pieces)
        for w in long:
            scores[w] = sum(scores[b] for b in blocks(w))
        self.number.update(zip(new, range(first, first + len(new))))
        self.score[first:first + len(new)] = list(map(scores.__getitem__, read))
        for w in long:
            del scores[w]
        if known:
            at = first + len(new)
            self.number.update(zip(known, range(at, at + len(known))))
            self.score[at:at + len(known)] = self.old_score[list(map(self.old_number.__getitem__, known))]

    def margins(self, texts: list[str]) -> np.ndarray:
        """Margin of the worst sentence of each text; that of an empty sentence where there is none.

        A word that a sentence repeats counts once.
        """
        out = np.zeros(len(texts))
        for at in range(0, len(texts), 64):
            docs = [sentences(t) for t in texts[at:at + 64]]
            size = np.array([len(p) for doc in docs for p in doc], dtype=np.int64)
            tokens = list(chain.from_iterable(p for doc in docs for p in doc))
            if not tokens:
                continue
            if len(self.number) > self.most:
                self.forget()
            number = np.fromiter(map(self.number.get, tokens, repeat(-1)), dtype=np.int64, count=len(tokens))
            if (miss := np.flatnonzero(number < 0)).size:
                new = [tokens[i] for i in miss.tolist()]
                self.learn(set(new))
                number[miss] = [self.number[t] for t in new]
            # Sentences by number, those of a long part one after another.
            pieces = -(-size // SENTENCE)
            start = np.cumsum(size) - size
            place = np.arange(len(tokens)) - np.repeat(start, size)
            sentence = np.repeat(np.cumsum(pieces) - pieces, size) + place // SENTENCE
            pair = np.sort(sentence << 32 | number)
            pair = pair[np.append(True, pair[1:] != pair[:-1])]
            sums = np.bincount(pair >> 32, self.score[pair & 0xFFFFFFFF], minlength=int(pieces.sum()))
            of_doc = np.repeat(np.repeat(np.arange(len(docs)), [len(doc) for doc in docs]), pieces)
            np.maximum.at(out, at + of_doc, sums)
        return out + self.model.bias


# -------------------------------------------------------------------- training
def _word_counts(docs: DataFrame) -> DataFrame:
    """(word, toxic, docs): in how many labelled documents a word occurs."""
    def run(batches):
        for batch in batches:
            word, label = [], []
            for text, y in zip(texts_of(batch), batch.column("toxic").to_pylist()):
                own = {b for w in map(letters, set(text.split())) if len(w) >= LENGTH for b in blocks(w)}
                word += own
                label += [y] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(label, pa.int32())], names=["word", "toxic"])

    return docs.select("text", "toxic").mapInArrow(lean(run), "word string, toxic int").groupBy("word", "toxic").count()


def choose_landmarks(docs: DataFrame, number: int = LANDMARKS, pool: int = 1500) -> list[str]:
    """Landmark words from counts over all rows of (text, toxic).

    Three quarters are words that tell toxic documents, strongest first, leaving out those
    almost equal to one taken before; the rest are the most common words of clean documents.
    """
    counts = _word_counts(docs).groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("count")).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("toxic") == 0, F.col("count")).otherwise(0)).alias("good"))
    sums = docs.groupBy("toxic").count().collect()
    n = {r["toxic"]: r["count"] for r in sums}
    n_bad, n_good = max(1, n.get(1, 0)), max(1, n.get(0, 0))
    # Signed root of the likelihood ratio against equal rates.
    rate_bad, rate_good = (F.col("bad") + 0.1) / n_bad, (F.col("good") + 0.1) / n_good
    strength = F.col("bad") * F.log(rate_bad / (0.5 * (rate_bad + rate_good)))
    strong = counts.where((F.col("bad") >= 2) & (rate_bad > 4 * rate_good)).orderBy(F.desc(strength), "word").limit(pool)
    common = counts.orderBy(F.desc("good"), "word").limit(number)
    strong = [r["word"] for r in strong.select("word").collect()]
    common = [r["word"] for r in common.select("word").collect()]
    taken: list[str] = []
    have = np.zeros((0, CODES ** 3), dtype=np.float32)
    for words, upto, near in ((strong, number * 3 // 4, 0.7), (common, number, 0.9)):
        for w in words:
            if len(taken) >= upto:
                break
            x = _dense([w])
            if not x.any() or (len(have) and float((have @ x.T).max()) >= near):
                continue
            taken.append(w)
            have = np.concatenate([have, x])
    return taken


def _altered(word: str) -> str:
    """The word with one letter put in behind its middle."""
    at = len(word) // 2
    return (word[:at] + "xqzkvw"[len(word) % 6] + word[at:])[:LETTERS]


def _sentence_rows(docs: DataFrame, names: list[str], strong: int, keep: int) -> DataFrame:
    """Kernel rows of the sentences of each document that are nearest to the landmarks.

    A toxic document comes a second time, as ``altered``, with a letter put into each word that
    is close to one of the first ``strong`` landmarks.
    """
    def run(batches):
        landmarks = Landmarks(names)
        for batch in batches:
            key, label, rows, other = [], [], [], []
            for text, y, doc in zip(texts_of(batch), batch.column("toxic").to_pylist(), batch.column("doc").to_pylist()):
                cut = [s[at:at + SENTENCE] for s in sentences(text) for at in range(0, len(s), SENTENCE)]
                parts = [{b for w in map(letters, s) if len(w) >= LENGTH for b in blocks(w)} for s in cut]
                parts = [p for p in parts if p]
                if not parts:
                    continue
                words = sorted(set().union(*parts))
                k = landmarks.kernel(words)
                value = dict(zip(words, k ** POWER))
                near = [w for w, top in zip(words, k[:, :strong].max(axis=1)) if y and top >= 0.8]
                for altered in range(2 if near else 1):
                    if altered:
                        value.update(zip(near, landmarks.kernel([_altered(w) for w in near]) ** POWER))
                    x = np.array([np.sum([value[w] for w in sorted(p)], axis=0) for p in parts])
                    for i in np.argsort(-x.max(axis=1), kind="stable")[:keep]:
                        key.append(doc)
                        label.append(y)
                        other.append(altered)
                        rows.append(x[i].astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.int64()), pa.array(label, pa.int32()), pa.array(other, pa.int32()), pa.array(rows, pa.binary())],
                names=["doc", "toxic", "altered", "row"])

    return docs.select("doc", "toxic", "text").mapInArrow(lean(run), "doc long, toxic int, altered int, row binary")


def _hinge(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Weights (bias last, hardly held) that minimise the squared hinge loss, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    hold = np.full(x.shape[1], 1.0)
    hold[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        short = 1 - y * (x @ w)
        on = short > 0
        c = cost[on]
        gradient = hold * w - 2 * (x[on] * (c * y[on] * short[on])[:, None]).sum(axis=0)
        hessian = np.diag(hold) + 2 * (x[on] * c[:, None]).T @ x[on]
        step = np.linalg.solve(hessian, gradient)
        if np.abs(step).max() < 1e-9:
            break
        scale, now = 1.0, None
        loss = lambda v: 0.5 * hold @ (v * v) + (cost * np.maximum(0, 1 - y * (x @ v)) ** 2).sum()
        now = loss(w)
        while scale > 1e-4 and loss(w - scale * step) > now:
            scale /= 2
        w = w - scale * step
    return w


def _calibrate(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve that fits best, held slightly."""
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - y) * weight * margin).sum() + 1e-2 * (a - 1), ((p - y) * weight).sum() + 1e-2 * b])
        s = weight * p * (1 - p)
        h = np.array([[(s * margin * margin).sum() + 1e-2, (s * margin).sum()], [(s * margin).sum(), s.sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(a, 1e-3), b


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS, rounds: int = 6) -> Model:
    """Fit on (doc_id, text) and (doc_id, toxic).

    Of the labels whose document is there at most ``sample`` per class are taken, in the order
    of a hash of doc_id, so the rows that travel have a fixed bound. Labels other than 0 and 1
    and null ids are left out; of labels that repeat an id the highest counts; null texts count
    as empty. Without both classes every document gets the share of toxic ones, half a row added
    to each.
    """
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1) and doc_id is not null")
    known = known.join(docs.select("doc_id"), "doc_id", "left_semi").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = written(known, "labels")
    n = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    bad, good = n.get(1, 0), n.get(0, 0)
    prior = (bad + 0.5) / (bad + good + 1)
    flat = Model((), np.zeros(0), 0.0, 1.0, float(np.log(prior / (1 - prior))))
    if not bad or not good:
        return flat
    ordered = known.withColumn("doc", F.xxhash64("doc_id")).orderBy("doc", "doc_id")
    picked = ordered.where("toxic = 1").limit(sample).union(ordered.where("toxic = 0").limit(sample))
    # At most 2 * sample rows of an id and a label.
    own = written(docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(
        F.broadcast(picked), "doc_id").dropDuplicates(["doc"]).select("doc", "text", "toxic"), "sample")
    names = choose_landmarks(own, landmarks)
    strong = max(1, min(len(names), landmarks * 3 // 4))
    rows = _sentence_rows(own, names, strong, keep=8).collect() if names else []
    drop_written(own)
    if not rows:
        return flat
    x = np.array([np.frombuffer(r["row"], dtype=np.float32) for r in rows], dtype=np.float64)
    y = np.array([1.0 if r["toxic"] else -1.0 for r in rows])
    # An altered copy is a document of its own; calibration leaves it out.
    _, doc = np.unique([(r["doc"], r["altered"]) for r in rows], axis=0, return_inverse=True)
    altered = np.array([r["altered"] for r in rows])
    # Nystrom: the landmarks' own kernel, powered, makes kernel rows into vectors.
    value, vector = np.linalg.eigh(Landmarks(names).kernel(names).astype(np.float64) ** POWER)
    keep = value > 1e-6 * value.max()
    turn = vector[:, keep] / np.sqrt(value[keep])
    z = x @ turn
    margin = x[:, :strong].max(axis=1)
    order = np.argsort(doc, kind="stable")
    one = order[np.append(True, doc[order][1:] != doc[order][:-1])]
    kinds, real = y[one], altered[one] == 0
    for _ in range(rounds):
        # Of each toxic document the worst sentence, of each clean one all that were kept.
        order = np.lexsort((-margin, doc))
        best = order[np.append(True, doc[order][1:] != doc[order][:-1])]
        use = np.concatenate([best[y[best] > 0], np.flatnonzero(y < 0)])
        n_bad, n_good = (y[use] > 0).sum(), (y[use] < 0).sum()
        cost = np.where(y[use] > 0, 1000.0 / max(1, n_bad), 1000.0 / max(1, n_good)) * np.where(altered[use], ALTERED, 1.0)
        w = _hinge(z[use], y[use], cost)
        margin = z @ w[:-1] + w[-1]
    top = np.full(len(kinds), w[-1])
    np.maximum.at(top, doc, margin)
    top, kinds = top[real], kinds[real]
    # The sample has its own share of toxic rows; weights bring back that of the labels.
    share = np.where(kinds > 0, bad / max(1, (kinds > 0).sum()), good / max(1, (kinds < 0).sum()))
    slope, shift = _calibrate(top, (kinds > 0).astype(float), share / share.mean())
    return Model(tuple(names), turn @ w[:-1], float(w[-1]), slope, shift)


def scored(docs: DataFrame, model: Model, *keys: str) -> DataFrame:
    """(keys, score) of every whole text: the probability that it is labelled toxic.

    Null and empty texts get the score of a text without any word; repeated rows score alike;
    an empty table gives no rows; keys may be null.
    """
    kept = docs.select(*keys, F.col("text").cast("string").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = _scorer(held.value)
        for batch in batches:
            out = [scorer.margins(texts_of(batch.slice(at, 512))) for at in range(0, batch.num_rows, 512)]
            margin = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keys], pa.array(held.value.probability(margin))], names=[*keys, "score"])

    names = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema.fields[:-1])
    return kept.mapInArrow(lean(run), f"{names}score double")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = _scorer(held.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                p = held.value.probability(scorer.margins(texts_of(part)))
                yield part.filter(pa.array(p < threshold))

    return docs.mapInArrow(lean(run), docs.schema)


_SCORERS: dict[str, Scorer] = {}


def _scorer(model: Model) -> Scorer:
    """One per worker process and model, so that later tasks find the cache warm."""
    if model.ident not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[model.ident] = Scorer(model)
    return _SCORERS[model.ident]
