"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration (operator 6).

Training reads every labelled row outside the held-out third. From them come a lexicon (words, and word
beginnings, whose documents are toxic far more often than the rest), the trees and the calibration. These
rows are split in two: each half's lexicon makes the other half's features, and each half's trees are
calibrated on the other half, so nothing is judged by what was fitted to it. The lexicon's counts and the
features' quantiles are made in Spark; of a labelled row the driver gets a byte for each feature, its bin.
Trees sum whole numbers, so no order of rows changes them.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.llm.common import lean, likely, materialize, table

#: Lexicon entries, at most.
ENTRIES = 4_000
#: Toxic documents that an entry needs, and its least log odds over the base rate.
SUPPORT, ODDS = 4, 2.0
#: Words around a second-person pronoun that count as near it.
NEAR = 5
THRESHOLD = 0.7
#: Gradients are whole multiples of one part in so many; rows of which sums are made at once.
UNIT, CHUNK = 1 << 24, 1 << 16
#: Bits of a feature's mantissa that its quantiles don't look at.
COARSE = 44

# Second-person words of four languages.
SECOND_PERSON = frozenset(x.encode() for x in "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer eure tu te toi ton ta tes vous votre vos tú ti tuyo tus usted ustedes vosotros vuestro".split())
# Characters that stand for letters in obfuscated words.
DISGUISE = str.maketrans("013457@$!", "oieastasi")

# bytes of UTF-8 that are no letters of ASCII end a word; characters beyond ASCII belong to it
_LETTERS = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))
_mixed = re.compile(r"[^\W\d_][^\W\d_0-9@$!*#]*[0-9@$!*#]+[^\W_][^\s]*").findall
_shout = re.compile(r"\b[A-Z]{3,}\b").findall
_marks = re.compile(r"[!?]{2,}").findall
_stretch = re.compile(r"([^\W\d_])\1\1+").findall
_spaced = re.compile(r"\b(?:[^\W\d_][ .\-_*]){3,}[^\W\d_]\b").findall
#: Classes of bytes: 1 small letter or beyond ASCII, 2 capital, 4 digit or sign that disguises, 8 separator of spaced letters.
_CLASS = np.array([1 if c > 127 or chr(c).islower() else 2 if chr(c).isupper() else (4 if chr(c) in "0123456789@$!*#" else 0) | (8 if chr(c) in " .-_*" else 0) for c in range(256)], np.uint8)


def words(low: str) -> list[bytes]:
    return low.encode("utf-8", "replace").translate(_LETTERS).split()


FEATURES = ["terms", "strong", "weight", "heaviest", "second", "hits", "kinds", "near_you", "closest", "you", "capitals", "shouts", "exclaims", "asks", "runs", "mixed", "unmasked", "stretched", "spaced", "words", "length", "digits"]


def terms(word: bytes) -> tuple[bytes, ...]:
    """What a word is looked up by: itself and its beginnings of 4 and 5 bytes."""
    return (word, word[:4] + b"*", word[:5] + b"*") if len(word) > 5 else (word, word[:4] + b"*") if len(word) > 4 else (word,)


class Lexicon(dict):
    """word -> weight, 0 for most; keeps a bounded number of looked-up words."""

    def __init__(self, weights: dict[bytes, float]) -> None:
        super().__init__()
        self.weights = weights

    def __missing__(self, word: bytes) -> float:
        if len(self) > 100_000:
            self.clear()
        value = self[word] = max((self.weights.get(t, 0.0) for t in terms(word)), default=0.0)
        return value


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """Rates are per word or per character of the whole text; an empty text has zeros."""
    text = text or ""
    low = text.lower()
    w = words(low)
    n, size = max(1, len(w)), max(1, len(text))
    weights = np.fromiter(map(lexicon.__getitem__, w), float, count=len(w))
    hit = np.flatnonzero(weights)
    found = np.sort(weights[hit])[::-1]
    you = np.array([i for i, x in enumerate(w) if x in SECOND_PERSON])
    near, closest = 0, 0.0
    if len(hit) and len(you):
        k = np.searchsorted(you, hit)
        gap = np.minimum(np.abs(hit - you[np.minimum(k, len(you) - 1)]), np.abs(hit - you[np.maximum(k - 1, 0)]))
        near, closest = int((gap <= NEAR).sum()), 1.0 / (1.0 + float(gap.min()))
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    kind = _CLASS[raw]
    letter, capital = kind & 3 != 0, kind == 2
    # each pattern is run only where bytes that it needs follow each other (a stretched letter counts if it is of ASCII)
    three = lambda a, b, c: bool((a[:-2] & b[1:-1] & c[2:]).any())
    mixed = _mixed(low) if three(letter, kind & 4 != 0, (kind & 7) != 0) else []
    unmasked = sum(any(lexicon[x] > 0 for x in words(m.translate(DISGUISE).replace("*", ""))) for m in mixed)
    shouts = len(_shout(text)) if three(capital, capital, capital) else 0
    marks = len(_marks(text)) if any(x in text for x in ("!!", "??", "!?", "?!")) else 0
    equal = raw[1:] == raw[:-1]
    stretched = len(_stretch(low)) if (equal[1:] & equal[:-1] & letter[2:]).any() else 0
    spaced = len(_spaced(low)) if three(kind & 8 != 0, letter, kind & 8 != 0) else 0
    return [
        len(hit) / n, float((found >= 4).sum()) / n, float(found.sum()) / n, found[0] if len(found) else 0.0, found[1] if len(found) > 1 else 0.0,
        math.log1p(len(hit)), math.log1p(len({w[i] for i in hit})), near / n, closest, len(you) / n,
        float(((raw >= 65) & (raw <= 90)).sum()) / size, shouts / n, text.count("!") / size, text.count("?") / size, marks / n,
        len(mixed) / n, unmasked / n, stretched / n, spaced / n, math.log1p(len(w)), sum(map(len, w)) / n, float(((raw >= 48) & (raw <= 57)).sum()) / size,
    ]


class Trees:
    """Gradient-boosted binary trees on the log loss, grown level by level over histograms of quantile bins."""

    def __init__(self, count: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 48, smallest: float = 3.0, ridge: float = 1.0) -> None:
        self.count, self.depth, self.rate, self.bins, self.smallest, self.ridge = count, depth, rate, bins, smallest, ridge

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        edges = [np.unique(np.quantile(c, quantiles(self.bins))) for c in x.T]
        return self.fit_bins(binned(x, edges), y, edges)

    def fit_bins(self, b: np.ndarray, y: np.ndarray, edges: list[np.ndarray]) -> Trees:
        """b: a row for each feature, of the bins of all samples. Beside it a sample takes some twenty bytes."""
        self.edges = edges
        p = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        self.base = math.log(p / (1 - p))
        score = np.full(b.shape[1], self.base, np.float32)
        self.trees = []
        for _ in range(self.count):
            self.trees.append(self._grow(b, y, score))
        return self

    def _grow(self, b: np.ndarray, y: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A tree for the samples' scores, which it then raises."""
        size, width = 1 << self.depth, self.bins + 1
        feature, cut = np.zeros(size, int), np.full(size, width)  # a node without a split sends all samples left
        parts = [slice(i, i + CHUNK) for i in range(0, b.shape[1], CHUNK)]
        node = np.ones(b.shape[1], np.uint8)
        g, h = np.empty(b.shape[1], np.int32), np.empty(b.shape[1], np.int32)
        for at in parts:
            p = 1 / (1 + np.exp(-score[at].astype(float)))
            g[at], h[at] = np.rint((p - y[at]) * UNIT), np.rint(p * (1 - p) * UNIT)
        for level in range(self.depth):
            first = 1 << level
            gs, hs = np.zeros((len(b), first * width)), np.zeros((len(b), first * width))
            for at in parts:
                k, gk, hk = (node[at].astype(np.int64) - first) * width, g[at].astype(float), h[at].astype(float)
                for f in range(len(b)):
                    key = k + b[f, at]
                    gs[f] += np.bincount(key, gk, first * width)
                    hs[f] += np.bincount(key, hk, first * width)
            best = np.full(first, 1e-6)
            for f in range(len(b)):
                left, weight = (x[f].reshape(first, width).cumsum(axis=1) / UNIT for x in (gs, hs))
                gt, ht = left[:, -1:], weight[:, -1:]
                gain = left**2 / (weight + self.ridge) + (gt - left) ** 2 / (ht - weight + self.ridge) - gt**2 / (ht + self.ridge)
                gain[(weight < self.smallest) | (ht - weight < self.smallest)] = 0
                at = gain.argmax(axis=1)
                top = gain[np.arange(first), at]
                better = top > best
                best[better] = top[better]
                feature[first : 2 * first][better] = f
                cut[first : 2 * first][better] = at[better]
            for at in parts:
                own = node[at]
                node[at] = 2 * own + (b[:, at][feature[own], np.arange(len(own))] > cut[own])
        gs, hs = np.zeros(size), np.zeros(size)
        for at in parts:
            gs += np.bincount(node[at] - size, g[at], size)
            hs += np.bincount(node[at] - size, h[at], size)
        value = -self.rate * (gs / UNIT) / (hs / UNIT + self.ridge)
        for at in parts:
            score[at] += value[node[at] - size].astype(np.float32)
        return feature, cut, value

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.score_bins(binned(x, self.edges))

    def score_bins(self, b: np.ndarray) -> np.ndarray:
        out = np.full(b.shape[1], self.base)
        for i in range(0, b.shape[1], CHUNK):
            part = b[:, i : i + CHUNK]
            rows = np.arange(part.shape[1])
            for feature, cut, value in self.trees:
                node = np.ones(len(rows), int)
                for _ in range(self.depth):
                    node = 2 * node + (part[feature[node], rows] > cut[node])
                out[i : i + CHUNK] += value[node - len(value)]
        return out


def quantiles(bins: int) -> np.ndarray:
    return np.linspace(0, 1, bins + 1)[1:-1]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """For each feature a row of the bins of x's rows."""
    return np.stack([np.searchsorted(e, c, side="right").astype(np.uint8) for e, c in zip(edges, x.T)])


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots of a rising step function from scores to rates."""
    at, where = np.unique(score, return_inverse=True)
    blocks: list[list[float]] = []  # sum, weight, distinct scores
    for s, w in zip(np.bincount(where, y), np.bincount(where)):
        blocks.append([s, w, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, w, n = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + w, blocks[-1][2] + n]
    return at, np.repeat([s / w for s, w, _ in blocks], [int(n) for *_, n in blocks])


class Model:
    """Scores texts; without labels of both kinds every score is the base rate."""

    def __init__(self, weights: dict[bytes, float], b: np.ndarray, y: np.ndarray, half: np.ndarray, edges: list[np.ndarray]) -> None:
        self.weights, self.trees, self.rate = weights, None, float(y.mean()) if len(y) else 0.0
        if y.all() or not y.any():
            return
        self.trees = Trees().fit_bins(b, y, edges)
        out = np.full(len(y), np.nan, np.float32)
        for k in (0, 1):
            mine, other = half == k, half != k
            if other.any() and not y[other].all() and y[other].any() and mine.any():
                out[mine] = Trees().fit_bins(b[:, other], y[other], edges).score_bins(b[:, mine])
        ok = ~np.isnan(out)
        at, rates = isotonic(out[ok].astype(float), y[ok]) if ok.any() else (np.array([0.0]), np.array([self.rate]))
        # a step is told by its ends
        ends = np.concatenate([[True], rates[1:] != rates[:-1]]) | np.concatenate([rates[1:] != rates[:-1], [True]])
        self.knots, self.rates = at[ends], rates[ends]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated rates; a thousandth of the trees' own probability keeps their order inside a step."""
        if self.trees is None:
            return np.full(len(x), self.rate)
        raw = self.trees.score(x)
        return 0.999 * np.interp(raw, self.knots, self.rates) + 0.001 / (1 + np.exp(-raw))


def remainder(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """doc_id, text, y, half: every labelled row outside the held-out third, one for an id."""
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y is not null").where(remainder(F.col("doc_id")) != 1)
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(remainder(F.col("doc_id")) != 1)
    # few texts without a label are moved
    rows = likely(rows, known.select("doc_id"), ["doc_id"]).join(known, "doc_id")
    rows = rows.groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    return rows.withColumn("half", (F.shiftright(F.crc32(F.col("doc_id").cast("string")), 8) % 2).cast("int"))


def learn_lexicon(rows: DataFrame) -> tuple[dict[bytes, float], list[dict[bytes, float]]]:
    """Weights from all labelled rows, and from each half."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n: dict[tuple[int, int], Counter] = {(h, y): Counter() for h in (0, 1) for y in (0, 1)}

        def flush() -> Iterator[pd.DataFrame]:
            for (half, y), c in n.items():
                if c:
                    yield pd.DataFrame({"term": list(c), "half": half, "y": y, "n": list(c.values())})
                    c.clear()

        for b in batches:
            for text, y, half in zip(b["text"], b["y"], b["half"]):
                n[half, y].update({t for w in set(words((text or "").lower())) for t in terms(w)})
                if sum(map(len, n.values())) > 200_000:
                    yield from flush()
        yield from flush()

    def total(y: int, half: int) -> F.Column:
        return F.sum(F.when((F.col("y") == y) & (F.col("half") == half), F.col("n")).otherwise(0))

    size = {(r["half"], r["y"]): r["n"] for r in rows.groupBy("half", (F.col("y") > 0).cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}
    counts = rows.select("text", (F.col("y") > 0).cast("int").alias("y"), "half").mapInPandas(lean(count), "term binary, half int, y int, n long")
    counts = counts.groupBy("term").agg(*[total(y, h).alias(f"n{y}{h}") for y in (0, 1) for h in (0, 1)]).where(F.col("n10") + F.col("n11") >= SUPPORT)
    odds = F.log((F.col("n10") + F.col("n11") + 0.5) / (F.col("n00") + F.col("n01") + 0.5))
    toxic, clean = (sum(size.get((h, y), 0) for h in (0, 1)) for y in (1, 0))
    counts = counts.where(odds >= math.log((toxic + 1) / (clean + 1)) + ODDS)
    best = counts.orderBy(odds.desc(), (F.col("n10") + F.col("n11")).desc(), "term").limit(ENTRIES).collect()

    def weights(halves: tuple[int, ...], support: int) -> dict[bytes, float]:
        toxic, clean = (sum(size.get((h, y), 0) for h in halves) for y in (1, 0))
        out = {}
        for r in best:
            k, m = (sum(r[f"n{y}{h}"] for h in halves) for y in (1, 0))
            odds = math.log((k + 0.5) / (m + 0.5)) - math.log((toxic + 1) / (clean + 1))
            if k >= support and odds >= ODDS:
                out[bytes(r["term"])] = odds
        return out

    return weights((0, 1), SUPPORT), [weights((h,), SUPPORT // 2) for h in (0, 1)]


def _edges(rows: DataFrame, bins: int) -> list[np.ndarray]:
    """For each feature of rows (x, by rows of ``FEATURES``) the quantiles of its values, which are cut to some bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.concatenate([_matrix(v.as_py()) for v in b.column(0)]) if b.num_rows else np.empty((0, len(FEATURES)))
            for f, c in enumerate(x.T):
                key, n = np.unique(np.ascontiguousarray(c).view(np.int64) >> COARSE, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), f, np.int32)), pa.array(key), pa.array(n)], ["f", "key", "n"])

    # as many rows as cut values: some thousands a feature, whatever the number of rows
    got = rows.select("x").mapInArrow(lean(run), "f int, key long, n long").groupBy("f", "key").agg(F.sum("n").alias("n")).toPandas().sort_values(["f", "key"])
    edges = []
    for f in range(len(FEATURES)):
        own = got[got["f"] == f]
        upto = own["n"].to_numpy(np.int64).cumsum()
        at = np.searchsorted(upto, quantiles(bins) * upto[-1]) if len(upto) else []
        edges.append(np.unique(own["key"].to_numpy(np.int64)[at] << COARSE).view(np.float64))
    return edges


def _matrix(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.float64).reshape(-1, len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    rows = materialize(labelled(docs, labels, id_col, text_col, label_col))
    weights, halves = learn_lexicon(rows)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The features of a batch's rows, with their labels and halves, as bytes of one row."""
        lexicons = [Lexicon(w) for w in halves]
        for b in batches:
            y, half = b.column(1).to_numpy() > 0, b.column(2).to_numpy()
            x = np.array([features(t.as_py(), lexicons[1 - h]) for t, h in zip(b.column(0), half)], float)
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (x, y.astype(np.uint8), half.astype(np.uint8))], ["x", "y", "half"])

    made = materialize(rows.select("text", "y", "half").mapInArrow(lean(make), "x binary, y binary, half binary"))
    edges = _edges(made, Trees().bins)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins = [binned(_matrix(v.as_py()), edges).T.tobytes() for v in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(bins, pa.binary()), b.column(1), b.column(2)], b.schema.names)

    got = made.mapInArrow(lean(cut), "x binary, y binary, half binary").toPandas()  # a byte for each feature of a labelled row
    y, half = (np.frombuffer(b"".join(got.pop(c)), np.uint8) for c in ("y", "half"))
    b = np.empty((len(FEATURES), len(y)), np.uint8)
    end = 0
    for raw in got.pop("x"):
        part = np.frombuffer(raw, np.uint8).reshape(-1, len(FEATURES))
        b[:, end : end + len(part)] = part.T
        end += len(part)
    return Model(weights, b, y, half, edges)


def _scores(model: Model, column: pa.Array, lexicon: Lexicon) -> np.ndarray:
    x = np.array([features(t.as_py(), lexicon) for t in column], float).reshape(len(column), len(FEATURES))
    return model.score(x)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted: a row for every row, without a shuffle.

    Null texts are scored as empty ones. A null id counts as an empty string for the remainder. Repeated
    rows each keep theirs; an empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.weights)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_scores(model, b.column(1), lexicon), pa.float64())], ["doc_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(lean(run), f"doc_id {kind}, score double")
    return out.select("doc_id", (remainder(F.col("doc_id")) == 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of docs below the threshold, with all their columns; no shuffle."""
    k = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.weights)
        for b in batches:
            yield b.filter(pa.array(_scores(model, b.column(k), lexicon) < threshold))

    return docs.mapInArrow(lean(run), docs.schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
