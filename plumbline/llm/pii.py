"""Personal data by fixed patterns and a linear-chain conditional random field.

The patterns give the base spans. The field adds what they cannot state: numbers without a
plus sign that are phones by their surroundings, addresses written with "(at)" and "(dot)",
cards and hosts with other separators. It is trained on the driver from the small table
below, its features are word shapes and a few cue words, and workers decode it by Viterbi over
batches of sequences. A sequence is a run of chunks around a digit, an @ or a bracketed word;
every other token is outside by definition, so texts without such signs cost one scan.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import lean, texts_of

KINDS = ("email", "ip", "card", "phone")

# ------------------------------------------------------------------ base spans
# Fixed values of the contract.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A start inside a run of digits fails or succeeds as the run's first digit does.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_OTHERS = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ backwards, so that long runs are read once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = done + len(text[done:at].rstrip(_LOCAL))
        hit = _DOMAIN.match(text, at) if start < at else None
        if hit:
            yield start, hit.end()
        done = hit.end() if hit else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the pattern matches, by kind, then start."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if "." in text:
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _OTHERS.sub("", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text)
                if 8 <= len(_OTHERS.sub("", m.group())) <= 15]
    return out


# ------------------------------------------------------------- the small table
# Invented sentences; {kind:...} marks a span. Each is used with several fillings.
LABELLED = (
    "call me at {phone:P} tonight", "phone : {phone:P}", "tel. {phone:P} or write", "my number is {phone:P} , thanks",
    "fax {phone:P}", "reach us on {phone:P} ( office )", "dial {phone:P} now", "mobile {phone:P}", "ring {phone:P} after six",
    "telefon {phone:P}", "telefono {phone:P}", "appelez le {phone:P}", "cell : {phone:P} .", "contact {phone:P} for details",
    "of {phone:Q} B and", "{phone:Q} B", "see {phone:Q} N .", "call {phone:Q}", "or {phone:Q} , B",
    "write to {email:O} please", "mail {email:O}", "email : {email:O}", "send it to {email:O} today", "contact {email:O} .",
    "address {email:O} , thanks", "ask {email:O} or {email:O}",
    "card number {card:C}", "visa {card:C} exp", "paid with card {card:C} .", "credit card : {card:C}", "charge {card:C} please",
    "host {ip:I} is down", "server {ip:I} answers", "ping {ip:I} twice", "address {ip:I} ,", "ip : {ip:I}",
    "in N there were N people", "pages N to N of the book", "version N . N is out", "on D we met", "at T we left",
    "the price is N . N euros", "chapter N , verse N", "section N . N . N", "from N - N they lived", "room N , floor N",
    "born in N and died in N", "the score was N - N", "license N . N", "version N .", "about N % of N", "figure N ( N )",
    "isbn B", "order B was shipped", "token = H", "password = H", "key H is old", "step N : wait N minutes", "id B", "serial B",
    "( N ) see note N", "he ran N . N km in N : N", "lines N , N and N", "the year N", "N . N . N", "a @ b", "see @ home",
    "code B", "invoice B of D", "H", "B", "the team ( at ) home", "look ( at ) the dot",
)


def _filled(kind: str, r: np.random.Generator) -> str:
    d = lambda n: "".join(map(str, r.integers(0, 10, n)))
    pick = lambda *options: options[int(r.integers(len(options)))]
    name = lambda: "".join(r.choice(list("abcdeilmnorstu"), int(r.integers(3, 9))))
    if kind == "P":
        return pick(f"{d(3)}-{d(3)}-{d(4)}", f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"0{d(2)} {d(3)} {d(4)}",
                    f"{d(3)} {d(3)} {d(4)}", f"0{d(3)} / {d(6)}", f"1-{d(3)}-{d(3)}-{d(4)}", f"0{d(1)} {d(2)} {d(2)} {d(2)} {d(2)}")
    if kind == "Q":
        return pick(f"+1 ({d(3)}) {d(3)}-{d(4)}", f"+{d(2)} {d(3)} {d(6)}", f"+{d(2)} ({d(2)}) {d(4)}-{d(4)}")
    if kind == "O":
        at, dot = pick((" (at) ", " (dot) "), (" [at] ", " [dot] "), ("(at)", "(dot)"), ("[at]", "[dot]"), (" @ ", "."))
        return name() + at + name() + dot + pick("com", "org", "net", "de", "fr")
    if kind == "C":
        sep = pick(".", "/", "  ", " - ", "_")
        digits = d(15)
        digits += next(c for c in "0123456789" if luhn(digits + c))
        return sep.join(digits[i:i + 4] for i in range(0, 16, 4))
    if kind == "I":
        sep = pick(" . ", "[.]", "(.)", " .")
        return sep.join(str(int(x)) for x in r.integers(1, 255, 4))
    if kind == "D":
        return pick(f"{d(2)}/{d(2)}/20{d(2)}", f"20{d(2)}-{d(2)}-{d(2)}", f"{d(2)}.{d(2)}.20{d(2)}")
    if kind == "T":
        return f"{d(2)}:{d(2)}"
    if kind == "B":
        return pick(d(16), d(12), d(9), f"{d(3)}-{d(10)}", f"A{d(6)}", f"{d(4)}-{d(4)}", d(7))
    if kind == "H":
        return "".join(r.choice(list("0123456789abcdef"), int(r.integers(16, 40))))
    return d(int(r.integers(1, 5)))


def labelled_rows(copies: int = 12, seed: int = 7) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """(text, spans): the table above with its slots filled."""
    r = np.random.default_rng(seed)
    out = []
    for line in LABELLED:
        for _ in range(copies):
            text, spans = "", []
            for part in re.split(r"(\{\w+:\w\}|\b[NDTBH]\b)", line):
                if part.startswith("{"):
                    kind, slot = part[1:-1].split(":")
                    value = _filled(slot, r)
                    spans.append((kind, len(text), len(text) + len(value)))
                    text += value
                else:
                    text += _filled(part, r) if re.fullmatch("[NDTBH]", part) else part
            out.append((text, spans))
    return out


# -------------------------------------------------------------------- features
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\s]")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))


def tokens(text: str, start: int = 0, end: int | None = None) -> list[tuple[str, int, int]]:
    return [(m.group(), m.start(), m.end()) for m in _TOKEN.finditer(text, start, len(text) if end is None else end)]


def _shape(token: str) -> str:
    n = len(token)
    if token.isdigit():
        return f"d{n}" if n < 5 else "d5-6" if n < 7 else "d7-9" if n < 10 else "d10-15" if n < 16 else "d16"
    if token.isalpha():
        kind = "X" if token.isupper() else "Xx" if token[0].isupper() else "x"
        return kind + ("1" if n == 1 else "3" if n < 4 else "9")
    return token


def shape_features(toks: list[tuple[str, int, int]], cues: frozenset[str]) -> list[list[str]]:
    shape, gap = [], []
    for i, (t, a, _) in enumerate(toks):
        shape.append(_shape(t))
        gap.append("^" if not i else "" if a == toks[i - 1][2] else "_")
    at = lambda i: shape[i] if 0 <= i < len(toks) else "#"
    word = lambda i: toks[i][0].lower() if 0 <= i < len(toks) and toks[i][0].lower() in cues else "-"
    out = []
    for i in range(len(toks)):
        after = gap[i + 1] if i + 1 < len(toks) else "$"
        own = gap[i] + shape[i]
        out.append([
            "1", "s" + own, "n" + own + after + at(i + 1), "p" + at(i - 1) + own, "t" + at(i - 1) + own + after + at(i + 1),
            "2" + at(i - 2) + at(i - 1) + shape[i], "3" + shape[i] + at(i + 1) + at(i + 2), "w" + word(i), "v" + word(i - 1),
            "u" + word(i - 2), "x" + word(i + 1), "y" + word(i - 1) + shape[i], "z" + shape[i] + word(i + 1),
            "4" + at(i - 4) + at(i - 3) + at(i - 2) + at(i - 1), "5" + at(i + 1) + at(i + 2) + at(i + 3) + at(i + 4),
        ])
    return out


@dataclass
class Field:
    """Weights of features per label, of label pairs, and of first labels."""

    index: dict[str, int] = field(repr=False)
    cues: frozenset[str]
    emit: np.ndarray = field(repr=False)
    move: np.ndarray
    first: np.ndarray

    def scores(self, toks: list[tuple[str, int, int]]) -> np.ndarray:
        rows = shape_features(toks, self.cues)
        ids = np.array([[self.index.get(f, len(self.emit) - 1) for f in row] for row in rows])
        return self.emit[ids].sum(axis=1)


def _allowed() -> tuple[np.ndarray, np.ndarray]:
    """0 where a label may follow another (or come first), else a large negative number."""
    n = len(LABELS)
    move, first = np.zeros((n, n)), np.zeros(n)
    for j, b in enumerate(LABELS):
        if b.startswith("I-"):
            first[j] = -1e6
            for i, a in enumerate(LABELS):
                if a[2:] != b[2:]:
                    move[i, j] = -1e6
    return move, first


def viterbi(scores: list[np.ndarray], move: np.ndarray, first: np.ndarray, cells: int = 1 << 16) -> list[np.ndarray]:
    """Best label sequences; sequences of like length are decoded together, padded."""
    out: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(scores)
    order = sorted(range(len(scores)), key=lambda i: len(scores[i]))
    at = 0
    while at < len(order):
        n, to = max(1, len(scores[order[at]])), at + 1
        while to < len(order) and len(scores[order[to]]) <= n * 1.5 + 4 and (to - at) * len(scores[order[to]]) < cells:
            to += 1
        group = [i for i in order[at:to] if len(scores[i])]
        at = to
        if not group:
            continue
        length = np.array([len(scores[i]) for i in group])
        top, labels = length.max(), len(first)
        x = np.zeros((len(group), top, labels))
        for k, i in enumerate(group):
            x[k, :length[k]] = scores[i]
        best = x[:, 0] + first
        back = np.zeros((top, len(group), labels), dtype=np.int8)
        for t in range(1, top):
            total = best[:, :, None] + move
            back[t] = total.argmax(axis=1)
            # A sequence that has ended keeps its scores.
            best = np.where((t < length)[:, None], total.max(axis=1) + x[:, t], best)
        path = np.zeros((len(group), top), dtype=np.int64)
        now = best.argmax(axis=1)
        for t in range(top - 1, -1, -1):
            live = t < length
            path[live, t] = now[live]
            if t:
                now = np.where(live, back[t, np.arange(len(group)), now], now)
        for k, i in enumerate(group):
            out[i] = path[k, :length[k]]
    return out


def _gold(toks, spans) -> np.ndarray:
    out = np.zeros(len(toks), dtype=np.int64)
    for kind, a, b in spans:
        inside = [i for i, (_, s, e) in enumerate(toks) if s >= a and e <= b]
        for n, i in enumerate(inside):
            out[i] = LABELS.index(("I-" if n else "B-") + kind)
    return out


def train(rows, rounds: int = 120, hold: float = 0.02, rate: float = 0.3) -> Field:
    """Maximum likelihood with a Gaussian prior, by Adam on all rows at once."""
    seqs = [(tokens(t), s) for t, s in rows]
    seqs = [(toks, _gold(toks, s)) for toks, s in seqs if toks]
    seen: dict[str, int] = {}
    for toks, _ in seqs:
        for t in {t.lower() for t, _, _ in toks if t.isalpha() and len(t) > 1}:
            seen[t] = seen.get(t, 0) + 1
    cues = frozenset(t for t, n in seen.items() if n >= 8)
    index: dict[str, int] = {}
    rows_of = [[[index.setdefault(f, len(index)) for f in fs] for fs in shape_features(toks, cues)] for toks, _ in seqs]
    n_features, n = len(index) + 1, len(LABELS)
    top = max(len(g) for _, g in seqs)
    width = len(rows_of[0][0])
    ids = np.full((len(seqs), top, width), n_features - 1)
    gold, mask = np.zeros((len(seqs), top), dtype=np.int64), np.zeros((len(seqs), top), dtype=bool)
    for k, (r, (_, g)) in enumerate(zip(rows_of, seqs)):
        ids[k, :len(g)], gold[k, :len(g)], mask[k, :len(g)] = r, g, True
    bar_move, bar_first = _allowed()
    flat = ids[mask]
    observed = np.zeros((n_features, n))
    np.add.at(observed, (flat, gold[mask][:, None]), 1.0)
    seen_move, seen_first = np.zeros((n, n)), np.bincount(gold[:, 0], minlength=n).astype(float)
    both = mask[:, 1:]
    np.add.at(seen_move, (gold[:, :-1][both], gold[:, 1:][both]), 1.0)
    w = [np.zeros((n_features, n)), np.zeros((n, n)), np.zeros(n)]
    m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    for step in range(1, rounds + 1):
        x = w[0][ids].sum(axis=2)
        move, first = w[1] + bar_move, w[2] + bar_first
        alpha, beta = np.zeros_like(x), np.zeros_like(x)
        alpha[:, 0] = x[:, 0] + first
        for t in range(1, top):
            a = _lse(alpha[:, t - 1][:, :, None] + move, 1) + x[:, t]
            alpha[:, t] = np.where(mask[:, t][:, None], a, alpha[:, t - 1])
        z = _lse(alpha[:, -1], 1)
        for t in range(top - 2, -1, -1):
            b = _lse(move[None] + (x[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(mask[:, t + 1][:, None], b, 0)
        p = np.exp(alpha + beta - z[:, None, None])
        expected = np.zeros_like(w[0])
        for f in range(width):
            np.add.at(expected, flat[:, f], p[mask])
        pair = np.exp(alpha[:, :-1, :, None] + move + (x[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None])
        gradient = [expected - observed + hold * w[0], pair[both].sum(axis=0) - seen_move + hold * w[1],
                    p[:, 0].sum(axis=0) - seen_first + hold * w[2]]
        for a, g, mm, vv in zip(w, gradient, m, v):
            mm += 0.1 * (g - mm)
            vv += 0.01 * (g * g - vv)
            a -= rate * (1 - step / (rounds + 1)) * (mm / (1 - 0.9 ** step)) / (np.sqrt(vv / (1 - 0.99 ** step)) + 1e-8)
    w[0][-1] = 0
    return Field(index, cues, w[0], w[1] + bar_move, w[2] + bar_first)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@lru_cache(maxsize=1)
def default_field() -> Field:
    return train(labelled_rows())


# -------------------------------------------------------------------- decoding
_SIGN = re.compile(r"[0-9@]|[(\[](?:at|dot)[)\]]", re.I)
_CHUNK = re.compile(r"\S+")
#: Chunks beside one with a sign that belong to its sequence; characters looked at for them.
BESIDE, REACH = 2, 200


def regions(text: str) -> list[tuple[int, int]]:
    """Runs of chunks (between white space, on one line) within BESIDE of a chunk with a sign."""
    out: list[tuple[int, int]] = []
    at = 0
    while hit := _SIGN.search(text, at):
        a, b = hit.span()
        line = text.rfind("\n", max(out[-1][1] if out else 0, a - REACH), a) + 1
        low = max(line, out[-1][1] if out and out[-1][1] <= a else 0, a - REACH)
        start, left = a, text[low:a]
        for n, m in enumerate(reversed(list(_CHUNK.finditer(left)))):
            # The first piece may be the front of the sign's own chunk.
            if n > BESIDE - (m.end() != len(left) and n == 0):
                break
            start = low + m.start()
        stop = text.find("\n", b, b + REACH)
        stop = stop if stop >= 0 else min(len(text), b + REACH)
        end = b
        for n, m in enumerate(_CHUNK.finditer(text, b, stop)):
            if n > BESIDE - (m.start() != b and n == 0):
                break
            end = m.end()
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
        at = b
    return out


def _valid(kind: str, text: str) -> bool:
    """Whether an added span can be what its label says."""
    digits = _OTHERS.sub("", text)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 12 and len(digits) < len(text)
    if kind == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(map(_small, parts))
    return bool(re.search(r"@|[(\[]at[)\]]", text, re.I)) and bool(re.search(r"\.|[(\[]dot[)\]]", text, re.I))


class _Cover:
    """Which stretches some spans cover or touch, by their starts and how far the spans up to each reach."""

    def __init__(self, spans: list[tuple[str, int, int]]):
        ordered = sorted((s, e) for _, s, e in spans)
        self.starts = [s for s, _ in ordered]
        self.reach = list(accumulate((e for _, e in ordered), max))

    def covers(self, a: int, b: int) -> bool:
        at = bisect_right(self.starts, a)
        return at > 0 and self.reach[at - 1] >= b

    def touches(self, a: int, b: int) -> bool:
        at = bisect_left(self.starts, b)
        return at > 0 and self.reach[at - 1] > a


def find_spans(texts: list[str], model: Field) -> list[tuple[list, list]]:
    """(base spans, all spans) per text; an added span never touches a base span."""
    found, seqs, owner = [base_spans(t) for t in texts], [], []
    cover = [_Cover(spans) for spans in found]
    for n, text in enumerate(texts):
        for a, b in regions(text):
            # A sequence that the base spans explain whole needs no decoding.
            toks = tokens(text, a, b)
            covered = sum(cover[n].covers(x, y) for _, x, y in toks) if found[n] else 0
            if any(t[0].isdigit() or t[0] == "@" or t[0].lower() in ("at", "dot") for t in toks) and covered < len(toks):
                seqs.append(toks)
                owner.append(n)
    paths = viterbi([model.scores(t) for t in seqs], model.move, model.first)
    added: list[list] = [[] for _ in texts]
    for n, toks, path in zip(owner, seqs, paths):
        i = 0
        while i < len(toks):
            label = LABELS[path[i]]
            if label[0] != "B":
                i += 1
                continue
            j = i + 1
            while j < len(toks) and LABELS[path[j]] == "I-" + label[2:]:
                j += 1
            a, b = toks[i][1], toks[j - 1][2]
            if not cover[n].touches(a, b) and _valid(label[2:], texts[n][a:b]):
                added[n].append((label[2:], a, b))
            i = j
    rank = {k: i for i, k in enumerate(KINDS)}
    key = lambda s: (rank[s[0]], s[1])
    return [(base, sorted(base + more, key=key)) for base, more in zip(found, added)]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


SPANS = "array<struct<kind: string, start: int, end: int, base: boolean>>"


def detect(docs: DataFrame, *keys: str, model: Field | None = None) -> DataFrame:
    """(keys, spans, n_base per kind, base_sha256, listed) of every whole text.

    spans: kind, start, end (code points, end exclusive) and whether a pattern gave it; listed:
    the same as kind:start:end, joined by commas; base_sha256: hash of that of the pattern
    spans. Null texts count as empty and have no spans; repeated rows give the same; keys may be
    null; an empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model or default_field())
    kept = docs.select(*keys, F.col("text").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            cols = [[] for _ in range(7)]
            for at in range(0, batch.num_rows, 256):
                for base, spans in find_spans(texts_of(batch.slice(at, 256)), held.value):
                    own = set(base)
                    cols[0].append([{"kind": k, "start": a, "end": b, "base": (k, a, b) in own} for k, a, b in spans])
                    for i, k in enumerate(KINDS):
                        cols[1 + i].append(sum(s[0] == k for s in base))
                    cols[5].append(hashlib.sha256(joined(base).encode()).hexdigest())
                    cols[6].append(joined(spans))
            struct = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
            kinds = [struct, *[pa.int64()] * 4, pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keys], *[pa.array(c, t) for c, t in zip(cols, kinds)]],
                names=[*keys, "spans", *(f"n_{k}" for k in KINDS), "base_sha256", "listed"])

    names = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema.fields[:-1])
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return kept.mapInArrow(lean(run), f"{names}spans {SPANS}, {counts}, base_sha256 string, listed string")


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; spans that overlap become one."""
    out, at = [], 0
    for a, b, kind in sorted((a, b, k) for k, a, b in spans):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def mask(docs: DataFrame, model: Field | None = None) -> DataFrame:
    """``docs`` with the personal data in column ``text`` masked; null texts stay null.

    All other columns stay as they are, whatever their names.
    """
    held = docs.sparkSession.sparkContext.broadcast(model or default_field())
    schema = docs.schema

    def run(batches):
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, 256):
                part = batch.column("text").slice(at, 256).to_pylist()
                found = find_spans([t or "" for t in part], held.value)
                out += [t if not spans else masked(t, spans) for t, (_, spans) in zip(part, found)]
            cols = [pa.array(out, pa.string()) if n == "text" else batch.column(i) for i, n in enumerate(batch.schema.names)]
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

    return docs.mapInArrow(lean(run), schema)
