"""Secret spans: exact patterns, and a linear-chain conditional random field that adds to them.

Tokens of a line are tagged O (outside), B (begin) or I (inside).  A token's scores sum the weights of
its own shape, of the words around it and of its file; the chain adds a weight for each transition,
and Viterbi's algorithm finds the best tags of a line.  The model is fitted here, on a bounded sample
of texts whose labels are the patterns' own values, so it learns what secrets look like and where they
stand, and finds ones that no pattern names; the sample is taken among all rows that have one.  Lines on which no tag can gain over O are skipped: the
bound is exact, so the result is that of the full search.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.bpe import ragged, slices
from leafmill.llm.common import release, texts_of
from leafmill.scratch import settle

# Patterns and least lengths of the base kinds, in the order in which ties are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "crf")
TOKEN = re.compile(r"[\w+/.-]+|[^\w\s]")
ANY = (
    r"""(?i:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,})"""
    r"|AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}"
)
"""For Spark: whether a text has any base kind."""
SAMPLE = 4000
PLAIN = 300
EXCERPT = 8 << 10
FIT_CHARS = 2 << 20
SPANS = "array<struct<kind:string,start:int,end:int>>"
RESULT = f"n_assign long, n_access long, n_hex long, spans {SPANS}"
O, B, I = range(3)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return out + [("hex", *m.span()) for m in HEX.finditer(text)]


def value_spans(text: str) -> list[tuple[int, int]]:
    """What the patterns hold to be secret, without the names before it."""
    out = [m.span(2) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [m.span() for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return out + [m.span() for m in HEX.finditer(text)]


SIZES = 13
WORDS = 4096
PLACES = (-2, -1, 1, 2)
OWN = 5  # features of the token itself; then two for each place, and one of the file


def classes() -> np.ndarray:
    """By code point: 1 lower, 2 upper, 4 digit, 8 other; 16 is added beyond ASCII."""
    points = map(chr, range(0x250))
    low = [1 if c.islower() else 2 if c.isupper() else 4 if c.isdigit() else 8 for c in points]
    out = np.full(0x110000, 1 | 16, np.uint8)
    out[:0x250] = low
    out[0x80:0x250] |= 16
    return out


CLASS = classes()
HEXDIGIT = np.zeros(0x110000, bool)
HEXDIGIT[[ord(c) for c in "0123456789abcdef"]] = True


def shapes(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Per token, OWN features of its characters, and the shape that its neighbours see.

    Features are numbers below SIZES * 32: size, classes, share of digits, changes of class, hex.
    """
    n = np.fromiter(map(len, tokens), np.int64, len(tokens))
    code = np.frombuffer("".join(tokens).encode("utf-32-le", "surrogatepass"), np.uint32)
    begin = np.cumsum(n) - n
    some = n > 0
    kind = CLASS[code]
    size = np.minimum(np.where(n < 4, n, 3 + n // 4), SIZES - 1)

    def total(x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(n), np.int64)
        if len(x):
            out[some] = np.add.reduceat(x.astype(np.int64), begin[some])
        return out

    seen = np.zeros(len(n), np.int64)
    if len(kind):
        seen[some] = np.bitwise_or.reduceat(kind, begin[some])
    change = np.append(False, kind[1:] != kind[:-1])[: len(kind)]
    change[begin[some]] = False
    digits, changes = total(kind & 4 > 0), total(change)
    own = [
        np.zeros_like(n),
        seen,
        np.where(n > 0, digits * 5 // np.maximum(n, 1), 0),
        np.minimum(changes * 12 // np.maximum(n, 1), 11) + 12 * (changes > 2),
        total(HEXDIGIT[code]) == n,
    ]
    return np.stack([size * 32 + x for x in own]), np.minimum(size, 7) * 32 + seen


def file_feature(text: str) -> int:
    """Of the whole text: how much of it is digits, and how long its lines are."""
    digits = sum(map(text.count, "0123456789")) * 50 // max(len(text), 1)
    return min(digits, 4) * 5 + min(len(text) // (text.count("\n") + 1) // 100, 4)


@dataclass
class Model:
    """Known neighbour words, weights of each feature by tag, and of transitions (an edge is O)."""

    words: dict[str, int] = field(default_factory=dict)
    weights: list[np.ndarray] = field(default_factory=list)
    steps: np.ndarray = field(default_factory=lambda: np.zeros((3, 3)))


class Lines:
    """Tokens of texts by line: ``token`` numbers them; lines are runs of them."""

    def __init__(self, texts: list[str]):
        number = defaultdict(count().__next__)
        number[""]  # stands beyond a line's edges
        lines = [t.split("\n") for t in texts]
        found = [TOKEN.findall(x) for x in chain.from_iterable(lines)]
        self.size = np.fromiter(map(len, found), np.int64, len(found))
        self.token = np.fromiter(map(number.__getitem__, chain.from_iterable(found)), np.int64)
        self.names = list(number)
        self.begin = np.cumsum(self.size) - self.size
        self.text = np.repeat(np.arange(len(texts)), list(map(len, lines)) or [0])
        self.lines, self.found = lines, found

    def neighbour(self, by: int) -> np.ndarray:
        """The token so many places on, within the line; 0 beyond it."""
        at = np.arange(len(self.token)) + by
        first = np.repeat(self.begin, self.size)
        inside = (at >= first) & (at < first + np.repeat(self.size, self.size))
        return np.where(inside, self.token[np.clip(at, 0, max(len(self.token) - 1, 0))], 0)

    def spans(self, line: int) -> list[tuple[int, int]]:
        """Code points, within its line, of each token of a line."""
        first = int(np.searchsorted(self.text, self.text[line]))
        return [m.span() for m in TOKEN.finditer(self.lines[self.text[line]][line - first])]


def features(words: dict[str, int], lines: Lines, texts: list[str]) -> list[np.ndarray]:
    """Per feature, its number for each token."""
    own, seen = shapes(lines.names)
    known = np.fromiter((words.get(x.lower(), 0) for x in lines.names), np.int64, len(lines.names))
    out = [f[lines.token] for f in own]
    for by in PLACES:
        at = lines.neighbour(by)
        out += [known[at], seen[at]]
    file = np.array([file_feature(t) for t in texts])
    return [*out, file[np.repeat(lines.text, lines.size)]]


def emissions(model: Model, lines: Lines, texts: list[str]) -> np.ndarray:
    """The three tags' scores of each token."""
    score = np.zeros((len(lines.token), 3))
    for w, f in zip(model.weights, features(model.words, lines, texts), strict=True):
        score += w[f]
    return score


def viterbi(score: np.ndarray, begin: np.ndarray, size: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Best tags of runs of tokens, all runs abreast; the longest first, so that the active ones lead."""
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    back = np.zeros((len(score), 3), np.int8)
    tags = np.zeros(len(score), np.int8)
    if not len(size) or not size[0]:
        return tags
    active = int((size > 0).sum())
    best = score[begin[:active]] + steps[O]
    ending = np.zeros(len(size), np.int8)
    longest = int(size[0])
    for t in range(1, longest + 1):
        now = int(np.searchsorted(-size, -t, side="right"))  # runs with t tokens or more
        still = int(np.searchsorted(-size, -t, side="left"))  # with more than t
        if still < now:
            ending[still:now] = (best[still:now] + steps[:, O]).argmax(1)
        if not still:
            break
        options = best[:still, :, None] + steps
        at = begin[:still] + t
        back[at] = options.argmax(1)
        best = options.max(1) + score[at]
    tag = ending.copy()
    for t in range(longest - 1, -1, -1):
        live = int(np.searchsorted(-size, -t, side="left"))
        at = begin[:live] + t
        tags[at] = tag[:live]
        tag[:live] = back[at, tag[:live]]
    return tags


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(score: np.ndarray, begin: np.ndarray, size: np.ndarray, steps: np.ndarray):
    """Probability of each tag at each token, and expected transitions, edges included."""
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order][size[order] > 0], size[order][size[order] > 0]
    a, b = np.zeros_like(score), np.zeros_like(score)
    used = np.zeros((3, 3))
    longest = int(size[0]) if len(size) else 0
    a[begin] = score[begin] + steps[O]
    for t in range(1, longest):
        at = begin[: int(np.searchsorted(-size, -t, side="left"))] + t
        a[at] = log_sum(a[at - 1][:, :, None] + steps, 1) + score[at]
    last = begin + size - 1
    b[last] = steps[:, O]
    whole = log_sum(a[last] + b[last], 1)
    for t in range(longest - 1, 0, -1):
        live = int(np.searchsorted(-size, -t, side="left"))
        at = begin[:live] + t
        both = steps + (score[at] + b[at])[:, None, :]
        b[at - 1] = log_sum(both, 2)
        used += np.exp(a[at - 1][:, :, None] + both - whole[:live, None, None]).sum(0)
    z = np.zeros(len(score))
    z[ragged(begin, size)] = np.repeat(whole, size)
    p = np.exp(a + b - z[:, None])
    used[O] += p[begin].sum(0)
    used[:, O] += p[last].sum(0)
    return p, used


def fit(texts: list[str], *, rounds: int = 20, rate: float = 0.5, ridge: float = 1e-3) -> Model:
    """Maximum likelihood by Adagrad on tags that the patterns' values give."""
    lines = Lines(texts)
    tags = np.zeros(len(lines.token), np.int64)
    values = [value_spans(t) for t in texts]
    start = 0
    for k, text_lines in enumerate(lines.lines):
        at = 0
        for line in text_lines:
            if values[k]:
                for i, m in enumerate(TOKEN.finditer(line)):
                    for v, e in values[k]:
                        if m.start() + at < e and m.end() + at > v:
                            tags[start + i] = B if m.start() + at <= v else I
            start += len(TOKEN.findall(line))
            at += len(line) + 1
    if not (tags == B).any():
        return Model()
    # words near a secret, by how often they are there; all others share number 0
    near = np.zeros(len(lines.names), np.int64)
    for by in PLACES:
        near += np.bincount(lines.neighbour(by)[tags == B], minlength=len(near))
    words: dict[str, int] = {}
    for i in np.argsort(-near, kind="stable")[:WORDS]:
        if near[i] > 1 and lines.names[i]:
            words.setdefault(lines.names[i].lower(), len(words) + 1)
    values = features(words, lines, texts)
    sizes = [SIZES * 32] * OWN + [len(words) + 1, 256] * len(PLACES) + [25]

    def gather(p: np.ndarray) -> list[np.ndarray]:
        return [
            np.stack([np.bincount(f, p[:, s], minlength=n) for s in range(3)], axis=1)
            for f, n in zip(values, sizes, strict=True)
        ]

    truth = np.eye(3)[tags]
    wanted = gather(truth)
    steps_wanted = np.zeros((3, 3))
    first = np.zeros(len(tags), bool)
    first[lines.begin[lines.size > 0]] = True
    before = np.where(first, O, np.append(0, tags[:-1]))
    np.add.at(steps_wanted, (before, tags), 1)
    np.add.at(steps_wanted, (tags[(lines.begin + lines.size - 1)[lines.size > 0]], O), 1)
    weights, steps = [np.zeros((n, 3)) for n in sizes], np.zeros((3, 3))
    steps[O, I] = -20.0  # nothing is inside what hasn't begun
    past, past_steps = [np.full_like(w, 1e-6) for w in weights], np.full_like(steps, 1e-6)
    for _ in range(rounds):
        score = sum(w[f] for w, f in zip(weights, values, strict=True))
        p, used = marginals(score, lines.begin, lines.size, steps)
        for w, g, want, got in zip(weights, past, wanted, gather(p), strict=True):
            d = want - got - ridge * w
            g += d * d
            w += rate * d / np.sqrt(g)
        e = steps_wanted - used - ridge * steps
        e[O, I] = 0
        past_steps += e * e
        steps += rate * e / np.sqrt(past_steps)
    return Model(words, weights, steps)


def tagged(texts: list[str], model: Model) -> list[list[tuple[str, int, int]]]:
    """Spans that the model finds in each text."""
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    lines = Lines(texts)
    if not model.weights or not len(lines.token):
        return out
    score = emissions(model, lines, texts)
    # a token tagged B or I gains at most its score over O and two transitions over O to O
    gain = score[:, 1:].max(1) - score[:, O] + 2 * (model.steps.max() - model.steps[O, O])
    filled = np.flatnonzero(lines.size > 0)
    open_ = filled[np.maximum.reduceat(gain, lines.begin[filled]) > 0]
    tags = viterbi(score, lines.begin[open_], lines.size[open_], model.steps)
    first = np.searchsorted(lines.text, np.arange(len(texts)))
    for line in open_.tolist():
        own = tags[lines.begin[line] : lines.begin[line] + lines.size[line]]
        if not own.any():
            continue
        k = int(lines.text[line])
        offset = sum(len(x) + 1 for x in lines.lines[k][: line - int(first[k])])
        spans = lines.spans(line)
        at = 0
        while at < len(own):
            end = at + 1
            if own[at] != O:
                while end < len(own) and own[end] == I:
                    end += 1
                out[k].append(("crf", offset + spans[at][0], offset + spans[end - 1][1]))
            at = end
    return out


def find(texts: list[str], model: Model) -> list[tuple[int, int, int, list[tuple[str, int, int]]]]:
    """Per text: base counts, and all spans by start, then kind."""
    out = []
    for text, more in zip(texts, tagged(texts, model), strict=True):
        base = base_spans(text)
        n = [sum(k == kind for k, _, _ in base) for kind in KINDS[:3]]
        added = [x for x in more if not any(x[1] < e and s < x[2] for _, s, e in base)]
        out.append((*n, sorted(base + added, key=lambda x: (x[1], KINDS.index(x[0])))))
    return out


def excerpt(text: str, most: int = EXCERPT) -> str:
    """A text of up to ``most`` characters, or that much of it in whole lines, nearest to its values first."""
    if len(text) <= most:
        return text
    lines = text.split("\n")
    begin = np.cumsum([0, *(len(x) + 1 for x in lines[:-1])])
    start = np.array([v for v, _ in value_spans(text)] or [0])
    hit = np.unique(np.searchsorted(begin, start, side="right") - 1)
    k = np.arange(len(lines))
    at = np.searchsorted(hit, k)
    far = np.minimum(abs(hit[np.maximum(at - 1, 0)] - k), abs(hit[np.minimum(at, len(hit) - 1)] - k))
    kept, left = [], most
    for k in np.argsort(far, kind="stable").tolist():
        if len(lines[k]) >= left:
            continue
        kept.append(k)
        left -= len(lines[k]) + 1
    if not kept:  # one line is longer than that
        first = max(int(begin[hit[0]]), int(start[0]) - most // 2)
        return text[first : first + most].split("\n")[0]
    return "\n".join(lines[k] for k in sorted(kept))


def train(docs: DataFrame, sample: int = SAMPLE, plain: int = PLAIN) -> Model:
    """Fit on texts with a pattern, and ``plain`` without, chosen by hash among all of either sort.

    All rows are searched first, so that rare patterns are learnt from too; then at most ``sample``
    different texts with a pattern are taken, in ``excerpt``s, up to FIT_CHARS of either sort.
    """

    @F.pandas_udf("string")
    def excerpts(texts: pd.Series) -> pd.Series:
        return pd.Series([excerpt(t) for t in texts], dtype=object)

    known = docs.where("id is not null").select("text", F.xxhash64("id", "text").alias("h"))
    marks = settle(known.select("h", F.col("text").rlike(ANY).alias("hit")), "marks")
    some = lambda of, n: marks.where(of).select("h").distinct().orderBy("h").limit(n)
    chosen = settle(some("hit", sample).union(some("not hit", plain)), "chosen")
    rows = known.join(F.broadcast(chosen), "h").groupBy("h").agg(F.first("text").alias("text"))
    texts = [r["text"] for r in rows.select("h", excerpts("text").alias("text")).orderBy("h").collect()]
    held, others = [], []
    for sort, want in ((held, True), (others, False)):
        left = FIT_CHARS
        for t in texts:
            if bool(value_spans(t)) == want and len(t) <= left:
                sort.append(t)
                left -= len(t)
    return fit(held + others[:plain])


def scanner(docs: DataFrame, model: Model):
    """A column function from text to RESULT."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            texts = texts.tolist()
            rows = chain.from_iterable(find(texts[s], sent.value) for s in slices(texts, 1 << 20))
            yield pd.DataFrame(list(rows), columns=["n_assign", "n_access", "n_hex", "spans"])
        release()

    return scan


def secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """One row per text: (id, n_assign, n_access, n_hex, spans).

    ``spans`` are (kind, start, end) in code points, end exclusive, by start and then kind; those of
    the model that overlap a pattern's are left out.  A null or empty text has none.  Repeated rows
    are scanned alike; null ids are kept but not learnt from; an empty table gives no rows; other
    columns are ignored.  Where no text has a pattern, the model adds nothing.
    """
    rows = texts_of(docs, id_col, text_col)
    scan = scanner(docs, train(rows, sample))
    return rows.select("id", scan("text").alias("r")).select("id", "r.*")


def redacted(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", mark: str = "<secret>") -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark``; null texts stay null."""
    sent = docs.sparkSession.sparkContext.broadcast(train(texts_of(docs, id_col, text_col)))

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            texts = texts.tolist()
            out: list[str] = []
            for s in slices(texts, 1 << 20):
                for text, (*_, spans) in zip(texts[s], find(texts[s], sent.value), strict=True):
                    parts, at = [], 0
                    for _, begin, end in spans:
                        if begin >= at:
                            parts += [text[at:begin], mark]
                        at = max(at, end)
                    out.append("".join([*parts, text[at:]]) if spans else text)
            yield pd.Series(out, dtype=object)
        release()

    text: Column = F.col(f"`{text_col}`")
    masked = clean(F.coalesce(text.cast("string"), F.lit("")))
    return docs.withColumn(text_col, F.when(text.isNotNull(), masked))
