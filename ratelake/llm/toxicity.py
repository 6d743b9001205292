"""Toxicity by weak supervision.

Voters are single words of a lexicon, word stems and surface patterns; each
says of a text whether it fires. The stems are mined from the label sample:
word beginnings that occur almost only in texts marked toxic, in any
language. A generative label model takes the voters' first and second
moments over all documents: with a hidden class of prior pi, the covariance
of two voters that are independent given the class is pi (1 - pi) d_i d_j,
where d is how much more often a voter fires on toxic texts. d is fitted to
the positive covariances; pairs that the fit leaves far off are taken as
correlated and left out, and d is fitted again. Correlation beyond what the
class explains weighs a voter down in the posterior. A
sparse linear classifier over hashed words and votes is trained on the
posterior labels of the sample and calibrated on the sample's true labels.

Only labels of rows whose crc32(doc_id) mod 4 is not 2 are read. The label
sample holds at most ``sample_rows`` rows (the smallest hashes of doc_id, one
text per id); every stem that passes the rule's count and precision in it is a
voter; the moments cover all documents. Scores depend on the text alone.

Defined results: NULL text scores as the empty text; texts of any length are
scored whole; repeated rows score alike; of an id with several texts the least one
is in the sample; without labels the prior is
``default_prior``, there are no stems, and calibration is left out; extra
columns are kept by ``score_documents`` and never read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.llm.common import crc_of_id, drop_kept

# Words of abuse, one voter each.
LEXICON = (
    "idiot moron loser scum pathetic worthless clown disgusting trash stupid dumb fool jerk imbecile vermin filth garbage "
    "freak ugly liar coward pig rat dummkopf abschaum versager widerlich verdammt connard imbécile ordure minable "
    "estúpido basura asqueroso inútil"
).split()
# Surface patterns, one voter each.
MASKED = re.compile(r"\b\w+[*@#$]{2,}\w+\b")
ADDRESSED = re.compile(r"\b(?:you|your|du|dein|tu|vous|usted)\b\W+(?:\w+\W+){0,2}(?:%s)\b" % "|".join(LEXICON), re.IGNORECASE)
SURFACE = ["shouting", "exclaiming", "masked", "addressed", "two_words", "four_words"]
WORD = re.compile(r"\w+")
BUCKETS = 1 << 18
STEM_LENGTHS = (4, 5, 6)


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


class Voters:
    """The voters' numbers: surface patterns, then lexicon words, then stems."""

    def __init__(self, stems: list[str]):
        self.stems = stems
        self.names = [*SURFACE, *LEXICON, *(f"{s}-" for s in stems)]
        self.by_word = {w: len(SURFACE) + k for k, w in enumerate(LEXICON)}
        self.by_stem = {s: len(SURFACE) + len(LEXICON) + k for k, s in enumerate(stems)}

    def of_word(self, word: str) -> tuple[int, ...]:
        found = [self.by_stem[word[:k]] for k in STEM_LENGTHS if len(word) >= k and word[:k] in self.by_stem]
        return (self.by_word[word], *found) if word in self.by_word else tuple(found)

    def of_text(self, text: str, hits: list[tuple[int, ...]]) -> list[int]:
        """Numbers of the voters that fire; hits: what ``of_word`` gave for the text's different words, without the empty ones."""
        out = set().union(*hits) if hits else set()
        letters = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        upper = int(((letters >= 65) & (letters <= 90)).sum())
        if upper > 12 and upper > 0.3 * (upper + int(((letters >= 97) & (letters <= 122)).sum())):
            out.add(0)
        if "!!!" in text:
            out.add(1)
        if any(c in text for c in "*@#$") and MASKED.search(text):
            out.add(2)
        if hits and ADDRESSED.search(text):
            out.add(3)
        if len(hits) >= 2:
            out.add(4)
        if len(hits) >= 4:
            out.add(5)
        return sorted(out)


class Memo(dict):
    """word -> make(word), computed once; emptied beyond ``limit`` words."""

    def __init__(self, make: Callable, limit: int = 300_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, word: str):
        if len(self) > self.limit:
            self.clear()
        value = self[word] = self.make(word)
        return value


def moments(docs: DataFrame, voters: Voters) -> tuple[int, np.ndarray]:
    """Number of documents and the matrix of joint firings of two voters, over all documents."""
    size = len(voters.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        memo = Memo(voters.of_word)
        n, total = 0, np.zeros((size, size), dtype=np.int64)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                t = t or ""
                fire = voters.of_text(t, list(filter(None, map(memo.__getitem__, words_of(t)))))
                total[np.ix_(fire, fire)] += 1
                n += 1
        values = pa.array([n, *total.ravel().tolist()], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), values], names=["at", "n"])

    sums = docs.select("text").mapInArrow(run, "at int, n long").where("n > 0").groupBy("at").agg(F.sum("n").alias("n"))
    flat = np.zeros(1 + size * size)
    for at, n in sums.collect():  # at most voters squared, whatever the input
        flat[at] = n
    return int(flat[0]), flat[1:].reshape(size, size)


@dataclass
class LabelModel:
    """Posterior of the hidden class given the votes: a linear log-odds."""

    weights: np.ndarray
    bias: float
    accuracies: np.ndarray
    correlated: list[tuple[int, int]]

    def posterior(self, v: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(v @ self.weights + self.bias, -30, 30)))


def fit_label_model(n: int, joint: np.ndarray, prior: float, rounds: int = 3) -> LabelModel:
    """Accuracies and correlations of the voters from their joint firings.

    A voter that does not fire abstains. Pairs that never meet more often
    than chance (voters of different languages) say nothing about accuracy.
    """
    m = len(joint)
    fires = np.diag(joint) / max(n, 1)
    cov = joint / max(n, 1) - np.outer(fires, fires)
    active, apart = fires > 0, ~np.eye(m, dtype=bool)
    spread = np.sqrt(np.outer(fires * (1 - fires), fires * (1 - fires)))
    use = apart & (cov > 0)
    d = np.where(active, np.sqrt(np.maximum((cov * use).max(1), 0)), 0)
    for _ in range(rounds):
        for _ in range(200):  # alternating least squares of the rank-one fit to the pairs in use
            weight = (use * (d**2)[None, :]).sum(1)
            new = (use * cov * d[None, :]).sum(1) / np.maximum(weight, 1e-12)
            d = np.where(active, np.maximum(0.5 * d + 0.5 * new, 0), 0)
        rest = (cov - np.outer(d, d)) / np.maximum(spread, 1e-12)
        odd = apart & (np.abs(rest) > 0.3) & np.outer(active, active)
        use = apart & (cov > 0) & ~odd
    gap = np.minimum(d / np.sqrt(prior * (1 - prior)), 1.0)  # P(fires | toxic) - P(fires | clean)
    toxic = np.clip(fires + (1 - prior) * gap, 1e-6, 1 - 1e-6)
    clean = np.clip(fires - prior * gap, 0.002 * fires + 1e-6, 1 - 1e-6)
    extra = np.where(odd, np.maximum(rest, 0), 0).sum(1)  # correlation beyond what the class explains
    weights = np.where(active & (gap > 0), np.log(toxic / clean) / (1 + extra), 0)
    pairs = [(int(i), int(j)) for i, j in np.argwhere(np.triu(odd, 1))]
    return LabelModel(np.maximum(weights, 0), float(np.log(prior / (1 - prior))), gap, pairs)


def buckets_of(words: set[str]) -> np.ndarray:
    return np.unique(np.fromiter((xxhash.xxh3_64_intdigest(w) % BUCKETS for w in words), np.int64, len(words)))


def label_sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(doc_id, text, toxic) of at most ``rows`` labelled ids outside the held-out quarter, one row per id: repeats of an id
    are pre-aggregated to its least text, so that they neither weigh more nor widen the sample."""
    open_ = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(crc_of_id() % 4 != 2)
    open_ = open_.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(open_), "doc_id")  # at most `rows` ids
    return found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic")


def mine_stems(sample: DataFrame, least: int = 4, precision: float = 0.9) -> list[str]:
    """Word beginnings that occur almost only in texts marked toxic, the most frequent first.

    All that occur in ``least`` toxic texts with ``precision`` stay, but for those of the lexicon's words and those that
    begin, or are begun by, a better one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[str, list[int]] = {}
        for batch in batches:
            for t, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for stem in {w[:k] for w in words_of(t or "") for k in STEM_LENGTHS if len(w) >= k and not w.isdigit()}:
                    count.setdefault(stem, [0, 0])[1 if toxic else 0] += 1
        cols = zip(*((s, a, b) for s, (a, b) in count.items()), strict=True) if count else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["stem", "clean", "toxic"]
        )

    counts = sample.select("text", "toxic").mapInArrow(run, "stem string, clean long, toxic long")
    counts = counts.groupBy("stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    good = counts.where((F.col("toxic") >= least) & (F.col("toxic") >= precision * (F.col("toxic") + 3 * F.col("clean"))))
    best = good.orderBy(F.desc(F.col("toxic") - 3 * F.col("clean")), F.desc(F.length("stem")), "stem").collect()  # stems of the sample
    covered = {w[:k] for w in LEXICON for k in STEM_LENGTHS}  # beginnings of words that vote already
    chosen: dict[str, None] = {}
    for r in best:
        s = r["stem"]
        if s not in covered and not any(s[:k] in chosen for k in STEM_LENGTHS):
            chosen[s] = None
            covered.update(s[:k] for k in STEM_LENGTHS)
    return list(chosen)


def sample_features(sample: DataFrame, voters: Voters) -> list:
    """(doc_id, votes, word buckets, label) per row of the sample, in a fixed order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(voters.of_word)
        for whole in batches:
            for lo in range(0, whole.num_rows, 250):  # the words of few texts are held at once
                batch = whole.slice(lo, 250)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                words = [words_of(t) for t in texts]
                fire = [voters.of_text(t, list(filter(None, map(memo.__getitem__, w)))) for t, w in zip(texts, words, strict=True)]
                packed = pa.array([buckets_of(w).astype(np.int32).tobytes() for w in words], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(fire, pa.list_(pa.int64())), packed, batch.column(2)],
                    names=["doc_id", "votes", "buckets", "toxic"],
                )

    found = sample.mapInArrow(run, "doc_id long, votes array<long>, buckets binary, toxic int")
    return sorted(found.collect(), key=lambda r: (r["doc_id"], bytes(r["buckets"])))


def fit_linear(features: list[np.ndarray], target: np.ndarray, size: int, l1: float = 2e-3, passes: int = 100) -> tuple[np.ndarray, float]:
    """Sparse logistic regression on soft labels: proximal gradient with per-feature steps."""
    index = np.concatenate(features) if features else np.zeros(0, dtype=np.int64)
    row = np.repeat(np.arange(len(features)), [len(f) for f in features])
    w, n = np.zeros(size), max(len(features), 1)
    rate = np.clip(target.mean() if len(target) else 0.5, 1e-3, 1 - 1e-3)
    bias, seen = float(np.log(rate / (1 - rate))), np.full(size, 1e-12)
    for _ in range(passes):
        logit = np.bincount(row, weights=w[index], minlength=len(features)) + bias
        miss = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - target
        slope = np.bincount(index, weights=miss[row], minlength=size) / n
        seen += slope**2
        step = 0.5 / np.sqrt(seen)
        w -= step * slope
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
        bias -= 0.3 * float(miss.mean()) if len(miss) else 0
    return w, bias


def calibrate(logit: np.ndarray, label: np.ndarray, passes: int = 50) -> tuple[float, float]:
    """Slope and shift that fit the logits to true labels (Newton steps with a small prior towards slope 1)."""
    a, b = 1.0, 0.0
    for _ in range(passes):
        p = 1 / (1 + np.exp(-np.clip(a * logit + b, -30, 30)))
        g = np.array([((p - label) * logit).sum() + 1.0 * (a - 1), (p - label).sum() + 0.1 * b])
        h = p * (1 - p)
        hess = np.array([[(h * logit**2).sum() + 1.0, (h * logit).sum()], [(h * logit).sum(), h.sum() + 0.1]])
        change = np.linalg.solve(hess, g)
        a, b = a - float(np.clip(change[0], -1, 1)), b - float(np.clip(change[1], -2, 2))
    return max(a, 0.05), b


@dataclass
class ToxicityModel:
    voters: Voters
    word_weights: dict[int, float]
    vote_weights: np.ndarray
    bias: float
    slope: float
    shift: float
    label_model: LabelModel

    def score(self) -> Column:
        """A scorer of the text column."""
        weights, by_vote, voters = self.word_weights, self.vote_weights, self.voters
        bias, slope, shift = self.bias, self.slope, self.shift

        @F.pandas_udf("double")
        def scorer(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            memo = Memo(lambda w: (weights.get(xxhash.xxh3_64_intdigest(w) % BUCKETS, 0.0), voters.of_word(w)))
            for part in texts:
                out = np.empty(len(part))
                for k, t in enumerate(part):
                    t = t or ""
                    found = [x for x in map(memo.__getitem__, words_of(t)) if x[0] or x[1]]
                    fire = voters.of_text(t, [v for _, v in found if v])
                    out[k] = sum(sorted(x for x, _ in found)) + by_vote[fire].sum() + bias
                yield pd.Series(1 / (1 + np.exp(-np.clip(slope * out + shift, -30, 30))))

        return scorer(F.col("text"))


def fit(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, default_prior: float = 0.1
) -> ToxicityModel:
    sample = label_sample(docs, labels, sample_rows)
    voters = Voters(mine_stems(sample))
    rows = sample_features(sample, voters)
    label = np.array([r["toxic"] for r in rows], dtype=float)
    prior = float(np.clip(label.mean(), 0.01, 0.5)) if len(label) else default_prior
    model = fit_label_model(*moments(docs, voters), prior)
    if not rows:  # nothing to train on: the label model itself scores
        return ToxicityModel(voters, {}, model.weights, model.bias, 1.0, 0.0, model)
    v = np.zeros((len(rows), len(voters.names)))
    for k, r in enumerate(rows):
        v[k, r["votes"]] = 1
    features = [
        np.concatenate((np.frombuffer(bytes(r["buckets"]), dtype=np.int32).astype(np.int64), BUCKETS + np.array(r["votes"], dtype=np.int64)))
        for r in rows
    ]
    w, bias = fit_linear(features, model.posterior(v), BUCKETS + len(voters.names))
    logit = np.array([w[f].sum() + bias for f in features])
    slope, shift = calibrate(logit, label) if 0 < label.sum() < len(label) else (1.0, 0.0)
    words = {int(k): float(w[k]) for k in np.flatnonzero(w[:BUCKETS])}
    return ToxicityModel(voters, words, w[BUCKETS:], bias, slope, shift, model)


def score_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """All columns of ``docs`` and ``__score`` (0..1), ``__predicted`` (1 at ``threshold`` or above)."""
    model = fit(spark, docs, labels)
    scored = docs.withColumn("__score", model.score())
    return scored.withColumn("__predicted", (F.col("__score") >= threshold).cast("int"))
