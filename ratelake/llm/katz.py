"""Katz backoff language model (Katz, 1987) over word tokens, trained and evaluated in one keyed pass.

A token is a run of bytes other than ASCII white space, A-Z lower-cased, or
the end mark of a text. The model is a bigram model with Good-Turing
discounted counts that backs off to Good-Turing discounted unigrams:

    p(w | v) = d(c) c / c(v)          if the pair was seen c > 0 times
             = a(v) p(w)              otherwise
    p(w)     = d(c) c / N             if w was seen c > 0 times
             = what the discounts left if w is unknown (one type)

``a(v)`` is computed exactly, so that p(. | v) sums to one over the known words
and the unknown type. Counts up to 5 get Katz's discounts, larger ones lose 0.5,
so every context leaves some mass. The history v is any word or the start mark,
w any word; a history that no training text has leaves all to p(w).

Tables, all in the shared checkpoint folder: ``unigrams`` (word hash, count; the rare ones are only counted) and
``pairs`` (by word shard: word count, history, pair count, and the texts that
hold the pair). A text's histories are its words and the start mark, and c(v) is
the word's own training count (the start mark's: the end's). So what a text loses
by the c(v) is added up word by word where ``pairs`` lies, and only pairs that no
training text has need their history: the histories (tokens after it and backoff
weight) are added up in partitions by history hash and sent back to the shards
that hold such pairs, and those pairs' postings alone are dealt again. Words are
keyed by 64-bit hashes, and a pair lives in its word's shard. Frequent words are
spread over all shards by their history, so no shard grows with one word.

Defined results: NULL text is the one token "end"; no training text: every
token is unknown with probability one; texts of any length are read whole;
repeated rows are scored each; NULL ids count as training rows; extra columns
are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ratelake.llm.common import key_per_partition, materialise, session_setting, shuffle_partitions, shuffles_dropped

LOW = 5  #: counts up to this get Good-Turing discounts
TAIL = 0.5  #: what larger counts lose
END = b""
START = b" "  #: no token holds white space
RARE = 65_535  #: code of a word that has none of its own
PAIRS = (
    "shard int, base long, w array<short>, w_rare array<long>, w_n array<int>, v array<short>, v_rare array<long>,"
    " v_n array<int>, doc array<short>, cnt array<int>"
)
PAIR_NAMES = [c.split()[0] for c in PAIRS.split(", ")]


class Hashes(dict):
    """word -> signed 64-bit hash; emptied beyond ``limit`` words."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.limit:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        self[word] = h = h - (1 << 64) if h >> 63 else h
        return h


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _lists(values: np.ndarray, counts: np.ndarray, kind) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(kind)))


def _parts(batch: pa.RecordBatch, text_at: int, most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Slices of at most 8,000 rows and about ``most`` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
    lo, room = 0, 0
    for k, size in enumerate(sizes):
        if k > lo and (k - lo >= 8000 or room + size > most):
            yield batch.slice(lo, k - lo)
            lo, room = k, 0
        room += int(size)
    if lo < len(sizes):
        yield batch.slice(lo)


def unigram_counts(training: DataFrame) -> DataFrame:
    """(h, c): how often each token occurs in the training texts; the end mark included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for whole in batches:
            for batch in _parts(whole, 0):
                count: dict[bytes, int] = {END: batch.num_rows}
                for t in batch.column(0).to_pylist():
                    for w in words_of(t):
                        count[w] = count.get(w, 0) + 1
                keys = np.fromiter(map(hashes.__getitem__, count), np.int64, len(count))
                values = np.fromiter(count.values(), np.int64, len(count))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(values)], names=["h", "c"])

    return training.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def discounts(n: np.ndarray) -> np.ndarray:
    """d[r] for counts r = 1..LOW from the counts of counts n[1..LOW+1]; absolute discounting where Good-Turing breaks down."""
    d = np.ones(LOW + 1)
    total = (LOW + 1) * n[LOW + 1] / n[1] if n[1] else 1.0
    for r in range(1, LOW + 1):
        good = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
        d[r] = (good - total) / (1 - total) if total < 1 else 0.0
        if not 0 < d[r] < 1:
            d[r] = 1 - TAIL / r
    return d


def held(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Discounted counts; 0 stays 0."""
    c = counts.astype(float)
    return np.where(c <= LOW, c * d[np.minimum(counts, LOW)], c - TAIL)


@dataclass
class Model:
    """Everything of bounded size that evaluating a pair needs."""

    total: int  # N
    types: int  # V
    d1: np.ndarray
    unknown: float
    d2: np.ndarray | None = None

    def unigram(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, held(c, self.d1) / max(self.total, 1), self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / (self.total + 0.1 * (self.types + 1)))

    def pair(self, c: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log10 of what the pair (``c`` times) and its word (``word`` times) give to a text; the word is the history of the
        token after it, and the end mark stands for the start mark. Pairs of no training text lack ``unseen``."""
        return np.log10(np.where(c > 0, held(c, self.d2), self.unigram(word))) - np.log10(np.maximum(word, 1))


def unseen(total: np.ndarray, backoff: np.ndarray) -> np.ndarray:
    """log10 of what a history (``total`` tokens after it) gives to a pair that no training text has, its count taken back."""
    return np.log10(backoff) + np.log10(np.maximum(total, 1))


def keyed_pairs(docs: DataFrame, held_out: Column, frequent: np.ndarray, shards: list[int]) -> DataFrame:
    """Per input batch and shard one row of arrays: words, their histories, and the texts that hold the pair.

    Words and histories are places in ``frequent`` (the first 65,535 of them, as 16 bits); those of the others are RARE, and
    their hashes follow in the same order in ``w_rare`` and ``v_rare``.
    ``shards`` are the shards' keys. ``cnt`` is negative for held-out texts.
    Rows with a negative shard list the batch's texts: w_rare has the ids, v_rare the
    held-out flags, cnt the numbers of tokens, doc whether the id is NULL.
    """
    keys = np.array(shards, dtype=np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, task = Hashes(), TaskContext.get().partitionId()
        base = task << 40
        for whole in batches:
            for batch in _parts(whole, 1):
                ids, out = batch.column(0), batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
                local: dict[bytes, int] = {END: 0}
                rows: list[list[int]] = []
                for t in batch.column(1).to_pylist():
                    rows.append([local.setdefault(w, len(local)) for w in words_of(t)] + [0])
                size = np.fromiter(map(len, rows), np.int64, len(rows))
                w = np.fromiter((x for r in rows for x in r), np.int64, int(size.sum()))
                h = np.fromiter(map(hashes.__getitem__, local), np.int64, len(local))
                at = np.searchsorted(frequent, h)
                often = at < len(frequent)
                often[often] = frequent[at[often]] == h[often]
                code = np.append(np.where(often, np.minimum(at, RARE), RARE), RARE)
                history = np.append(h, hashes[START])  # of local words, and of the start mark
                v = np.concatenate(([len(h)], w[:-1]))
                v[np.cumsum(size)[:-1]] = len(h)
                key = (w << 25 | v) << 13 | np.repeat(np.arange(len(rows)), size)
                key.sort()
                first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
                cnt = np.diff(np.append(first, len(key)))
                key = key[first]
                doc, v, w = key & 8191, key >> 13 & (1 << 25) - 1, key >> 38
                spread = np.where(often[w], h[w] ^ (history[v] * 0x9E3779B1), h[w])
                shard = (spread ^ spread >> 29) % len(keys)
                order = np.argsort(shard, kind="stable")
                doc, v, w, shard, cnt = doc[order], v[order], w[order], shard[order], cnt[order]
                cnt = np.where(out[doc], -cnt, cnt)
                new_w = np.concatenate(([True], (w[1:] != w[:-1]) | (shard[1:] != shard[:-1])))
                new_v = new_w | np.concatenate(([True], v[1:] != v[:-1]))
                pairs, words = np.flatnonzero(new_v), np.flatnonzero(new_w)
                names = np.unique(shard)
                wc, vc = code[w[words]], code[v[pairs]]

                def per(starts: np.ndarray, s: np.ndarray = shard, n: np.ndarray = names) -> np.ndarray:
                    return np.bincount(np.searchsorted(n, s[starts]), minlength=len(n))

                every = np.arange(len(w))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[names]),
                        pa.array(np.full(len(names), base)),
                        _lists(wc.astype(np.uint16).view(np.int16), per(words), np.int16),
                        _lists(h[w[words[wc == RARE]]], per(words[wc == RARE]), np.int64),
                        _lists(np.diff(np.append(np.cumsum(new_v)[words] - 1, len(pairs))), per(words), np.int32),
                        _lists(vc.astype(np.uint16).view(np.int16), per(pairs), np.int16),
                        _lists(history[v[pairs[vc == RARE]]], per(pairs[vc == RARE]), np.int64),
                        _lists(np.diff(np.append(pairs, len(w))), per(pairs), np.int32),
                        _lists(doc, per(every), np.int16),
                        _lists(cnt, per(every), np.int32),
                    ],
                    names=PAIR_NAMES,
                )
                one = np.array([len(rows)])
                none = np.array(ids.is_null().to_numpy(zero_copy_only=False), dtype=np.int16)
                plain = pc.fill_null(ids, 0).to_numpy().astype(np.int64)
                no, zero = (none, np.int16), (size * 0, np.int32)
                flat = [no, (plain, np.int64), zero, no, (out, np.int64), zero, no, (size, np.int32)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([-1 - task], pa.int32()), pa.array([base]), *[_lists(x, one, k) for x, k in flat]], names=PAIR_NAMES
                )
                base += len(rows)

    return docs.select("doc_id", "text", held_out.alias("out")).mapInArrow(run, PAIRS)


TABLE = (
    "shard int, bases array<long>, word array<long>, word_c array<long>, v array<long>, c array<long>, v_n array<int>,"
    " batch array<int>, doc array<short>, cnt array<int>"
)


def counted_pairs(keyed: DataFrame, frequent: np.ndarray, counts: np.ndarray, parts: int, room: int = 1 << 18) -> DataFrame:
    """Rows of a shard, with about ``room`` postings each: per pair the word's training count, its history and count; per
    posting batch, text and count."""
    kind = pa.schema([
        ("shard", pa.int32()), ("bases", pa.list_(pa.int64())), ("word", pa.list_(pa.int64())), ("word_c", pa.list_(pa.int64())),
        ("v", pa.list_(pa.int64())), ("c", pa.list_(pa.int64())), ("v_n", pa.list_(pa.int32())), ("batch", pa.list_(pa.int32())),
        ("doc", pa.list_(pa.int16())), ("cnt", pa.list_(pa.int32())),
    ])

    def row_of(shard: int, cols: list) -> pa.RecordBatch:
        kinds = [k.type.value_type.to_pandas_dtype() for k in list(kind)[1:]]
        lists = [_lists(np.asarray(x), np.array([len(x)]), k) for x, k in zip(cols, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), *lists], schema=kind)

    def named(code: np.ndarray, rare: np.ndarray) -> np.ndarray:
        code = code.view(np.uint16)
        out = np.empty(len(code), dtype=np.int64)
        out[code == RARE] = rare
        out[code != RARE] = frequent[code[code != RARE]]
        return out

    def whole(shard: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        base, w, w_rare, w_n, v, v_rare, v_n, doc, cnt = zip(*rows, strict=True)
        batch = np.repeat(np.arange(len(rows), dtype=np.int32), [len(d) for d in doc])
        v_n = np.concatenate(v_n)
        h = np.repeat(np.repeat(named(np.concatenate(w), np.concatenate(w_rare)), np.concatenate(w_n)), v_n)
        v, doc, cnt = np.repeat(named(np.concatenate(v), np.concatenate(v_rare)), v_n), np.concatenate(doc), np.concatenate(cnt)
        order = np.lexsort((v, h))
        h, v, batch, doc, cnt = h[order], v[order], batch[order], doc[order], cnt[order]
        new_w = np.concatenate(([True], h[1:] != h[:-1]))
        first = np.flatnonzero(new_w | np.concatenate(([True], v[1:] != v[:-1])))
        c = np.add.reduceat(np.maximum(cnt, 0), first).astype(np.int64)
        word = h[first]
        start = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        total = np.repeat(np.add.reduceat(c, start), np.diff(np.append(start, len(word))))
        if len(frequent):  # spread over shards: their counts come from the unigrams
            at = np.minimum(np.searchsorted(frequent, word), len(frequent) - 1)
            total = np.where(frequent[at] == word, counts[at], total)
        v, last = v[first], np.append(first[1:], len(h))
        cuts = np.flatnonzero(np.diff(last // room, prepend=0, append=-1))  # the last pair of each row
        for lo, hi in zip([0, *(cuts[:-1] + 1)], cuts + 1, strict=True):
            hi = min(hi, len(v))
            if lo < hi:
                some, posted = slice(lo, hi), slice(first[lo], last[hi - 1])
                yield row_of(shard, [base, [], total[some], v[some], c[some], (last - first)[some], batch[posted], doc[posted], cnt[posted]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                row = [batch.column(i)[k] for i in range(batch.num_columns)]
                if row[0].as_py() < 0:
                    _, ids, _, _, out, _, none, size = (x.values.to_numpy() for x in row[2:])
                    yield row_of(row[0].as_py(), [[row[1].as_py()], ids, none, out, [], [], [], [], size])
                    continue
                if rows and row[0].as_py() != shard:
                    yield from whole(shard, rows)
                    rows = []
                shard = row[0].as_py()
                rows.append((row[1].as_py(), *[x.values.to_numpy() for x in row[2:]]))
        if rows:
            yield from whole(shard, rows)

    return keyed.repartition(parts, "shard").sortWithinPartitions("shard", "base").mapInArrow(run, TABLE)


def _columns(batch: pa.RecordBatch, k: int) -> list[np.ndarray]:
    return [c[k].values.to_numpy() for c in batch.columns]


def counts_of_counts(pairs: DataFrame) -> np.ndarray:
    """How many pairs were seen 1..LOW + 1 times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(LOW + 3, dtype=np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                n += np.bincount(np.minimum(_columns(batch, k)[0], LOW + 2), minlength=LOW + 3)
        yield pa.RecordBatch.from_arrays([pa.array(range(LOW + 3), pa.int32()), pa.array(n)], names=["r", "n"])

    out = np.zeros(LOW + 2)
    for r, n in pairs.select("c").mapInArrow(run, "r int, n long").groupBy("r").agg(F.sum("n")).collect():
        if 0 < r < LOW + 2:
            out[r] = n
    return out


PARTS = "part int, shard int, v array<long>, mass array<double>, total array<double>, left array<double>, asked array<short>"
HISTORIES = "shard int, history array<long>, total array<double>, backoff array<double>"


def history_table(pairs: DataFrame, model: Model, parts: list[int]) -> DataFrame:
    """HISTORIES rows: for every shard the histories of its pairs that no training text has, with the tokens seen after them
    and their backoff weights.

    Each shard sends its sums per history (unigram mass of the words seen after it, seen tokens, what the discounts left) to
    the history's partition; that adds them up and answers the shards that asked. ``parts``: a key per partition.
    """
    keys = np.array(parts, dtype=np.int32)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                word_c, v, c = (x[k].values.to_numpy() for x in batch.columns[1:])
                names, at = np.unique(v, return_inverse=True)
                given = (model.unigram(word_c) * (c > 0), c, c - held(c, model.d2))
                sums = [np.bincount(at, weights=x, minlength=len(names)) for x in (*given, c == 0)]
                sums[3] = sums[3] > 0
                part = (names ^ names >> 31) % len(keys)
                order = np.argsort(part, kind="stable")
                per = np.bincount(part, minlength=len(keys))
                some = np.flatnonzero(per)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[some]), pa.array(np.full(len(some), batch.column(0)[k].as_py(), dtype=np.int32))]
                    + [_lists(x[order], per[some], kind) for x, kind in zip((names, *sums), (np.int64, float, float, float, np.int16), strict=True)],
                    names=["part", "shard", "v", "mass", "total", "left", "asked"],
                )

    def whole(rows: list[list]) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(x[1]) for x in rows])
        names, at = np.unique(np.concatenate([x[1] for x in rows]), return_inverse=True)
        mass, total, left = (np.bincount(at, weights=np.concatenate([x[i] for x in rows])) for i in (2, 3, 4))
        backoff = np.where(total > 0, left / np.maximum(total, 1) / np.maximum(1 - mass, 1e-300), 1.0)
        for (shard, v, *_, asked), mine in zip(rows, np.split(at, np.cumsum(sizes)[:-1]), strict=True):
            v, mine = v[asked > 0], mine[asked > 0]
            one = np.array([len(v)])
            if not len(v):
                continue
            columns = [_lists(v, one, np.int64), _lists(total[mine], one, float), _lists(backoff[mine], one, float)]
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), *columns], names=["shard", "history", "total", "backoff"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                if rows and batch.column(0)[k].as_py() != part:
                    yield from whole(rows)
                    rows = []
                part = batch.column(0)[k].as_py()
                rows.append([batch.column(1)[k].as_py(), *(c[k].values.to_numpy() for c in batch.columns[2:])])
        if rows:
            yield from whole(rows)

    asked = pairs.select("shard", "word_c", "v", "c").mapInArrow(ask, PARTS)
    return asked.repartition(len(parts), "part").sortWithinPartitions("part").mapInArrow(answer, HISTORIES)


def _sum_rows(batches: Iterator[pa.RecordBatch], read) -> Iterator[pa.RecordBatch]:
    """SUMS rows of each run of rows of one shard. ``read(batch, k)`` gives None, or bases, part, doc, times, v_n of row k's
    postings and a function that gives what the pairs of a slice add to the three sums."""
    at, bases, totals = None, [], np.zeros(0)

    def done() -> pa.RecordBatch:
        used = [np.flatnonzero(x) for x in totals[3]]
        lists = [_lists(np.concatenate(x), np.array([len(u) for u in used]), kind) for x, kind in ((used, np.int16), *(([t[u] for t, u in zip(total, used, strict=True)], kind) for total, kind in zip(totals[:3], (np.int32, float, float), strict=True)))]
        return pa.RecordBatch.from_arrays([pa.array(bases), *lists], names=["base", "doc", "n_known", "base_score", "score"])

    for batch in batches:
        for k in range(batch.num_rows):
            if (row := read(batch, k)) is None:
                continue
            own, part, doc, times, v_n, values = row
            if at != (shard := batch.column(0)[k].as_py()):
                if at is not None:
                    yield done()
                at, bases, totals = shard, own.copy(), np.zeros((4, len(own), 8192))
            first = np.concatenate(([0], np.cumsum(v_n)))
            for lo in range(0, len(v_n), 100_000):  # bounded temporary arrays
                some, posted = slice(lo, lo + 100_000), slice(first[lo], first[min(lo + 100_000, len(v_n))])
                place, inverse = np.unique(part[posted].astype(np.int64) << 13 | doc[posted], return_inverse=True)
                for total, x in zip(totals, values(some), strict=False):
                    total.reshape(-1)[place] += np.bincount(inverse, weights=times[posted] * np.repeat(x, v_n[some]), minlength=len(place))
                totals[3].reshape(-1)[place] = 1
    if at is not None:
        yield done()


def shard_sums(pairs: DataFrame, model: Model) -> DataFrame:
    """SUMS rows: what all pairs of a shard give to the texts, without the histories of unseen pairs. No row is dealt again."""

    def read(batch: pa.RecordBatch, k: int) -> tuple:
        bases, word_c, c, v_n, part, doc, cnt = (x[k].values.to_numpy() for x in batch.columns[1:])

        def values(some: slice) -> tuple:
            return word_c[some] > 0, model.base(word_c[some]), model.pair(c[some], word_c[some])

        return bases, part, doc, np.abs(cnt), v_n, values

    return pairs.select("shard", "bases", "word_c", "c", "v_n", "batch", "doc", "cnt").mapInArrow(lambda batches: _sum_rows(batches, read), SUMS)


UNSEEN = "shard int, bases array<long>, v array<long>, v_n array<int>, batch array<int>, doc array<short>, cnt array<int>"


def unseen_pairs(pairs: DataFrame) -> DataFrame:
    """UNSEEN rows: a shard's pairs that no training text has, with their postings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                bases, v, c, v_n, part, doc, cnt = (x[k].values.to_numpy() for x in batch.columns[1:])
                new, posted = c == 0, np.repeat(c == 0, v_n)
                if new.any():
                    lists = [(bases, np.int64), (v[new], np.int64), (v_n[new], np.int32), (part[posted], np.int32), (doc[posted], np.int16), (-cnt[posted], np.int32)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(k, 1), *[_lists(x, np.array([len(x)]), kind) for x, kind in lists]], names=[x.split()[0] for x in UNSEEN.split(", ")]
                    )

    return pairs.select("shard", "bases", "v", "c", "v_n", "batch", "doc", "cnt").mapInArrow(run, UNSEEN)


def unseen_sums(new: DataFrame, histories: DataFrame, shards: int) -> DataFrame:
    """SUMS rows: what their histories give to the unseen pairs of a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: list[list[np.ndarray]] = []  # of the shard whose pairs come next
        found: list[np.ndarray] = []

        def read(batch: pa.RecordBatch, k: int) -> tuple | None:
            if batch.column(7)[k].is_valid:
                if found:  # the next shard begins
                    known.clear()
                    found.clear()
                known.append([c[k].values.to_numpy() for c in batch.columns[7:]])
                return None
            bases, v, v_n, part, doc, cnt = (x[k].values.to_numpy() for x in batch.columns[1:7])
            if not found:
                names, after, backoff = (np.concatenate(x) for x in zip(*known, strict=True))
                order = np.argsort(names)
                found.extend((names[order], unseen(after, backoff)[order]))
            given = found[1][np.searchsorted(found[0], v)]
            return bases, part, doc, cnt, v_n, lambda some: (given[some] * 0, given[some] * 0, given[some])

        yield from _sum_rows(batches, read)

    left = new.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in HISTORIES.split(", ")[1:])])
    right = histories.select("shard", *[F.lit(None).cast(t).alias(c) for c, t in new.dtypes[1:]], *histories.columns[1:])
    dealt = left.unionByName(right).repartition(shards, "shard").sortWithinPartitions("shard", F.col("history").isNull())
    return dealt.mapInArrow(run, SUMS)


SUMS = "base long, doc array<short>, n_known array<int>, base_score array<double>, score array<double>"
TEXTS = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def text_sums(sums: DataFrame, listed: DataFrame, parts: int) -> DataFrame:
    """TEXTS rows: adds up the shards' parts batch by batch. listed: (base, ids, none, out, size) of every input batch."""
    lists = {"ids": "array<long>", "none": "array<long>", "out": "array<long>", "size": "array<int>"}
    left = sums.select("*", *[F.lit(None).cast(t).alias(c) for c, t in lists.items()])
    empty = {"doc": "array<short>", "n_known": "array<int>", "base_score": "array<double>", "score": "array<double>"}
    right = listed.select("base", *[F.lit(None).cast(t).alias(c) for c, t in empty.items()], *lists)
    dealt = left.unionByName(right).repartition(parts, "base").sortWithinPartitions("base", F.desc_nulls_last("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = none = out = size = totals = None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=none), pa.array(out), pa.array(size), pa.array(totals[0].astype(np.int64)), pa.array(totals[1]), pa.array(totals[2])],
                names=[c.split()[0] for c in TEXTS.split(", ")],
            )

        for batch in batches:
            for k in range(batch.num_rows):
                if batch.column(5)[k].is_valid:  # a new input batch begins with the list of its texts
                    if ids is not None:
                        yield done()
                    ids, none, out, size = (batch.column(i)[k].values.to_numpy() for i in range(5, 9))
                    none, out, size, totals = none.astype(bool), out.astype(bool), size.astype(np.int64), np.zeros((3, len(ids)))
                else:
                    doc, *values = (batch.column(i)[k].values.to_numpy() for i in range(1, 5))
                    for total, x in zip(totals, values, strict=True):
                        total[doc] += x
        if ids is not None:
            yield done()

    return dealt.mapInArrow(run, TEXTS)


def train_and_score(spark: SparkSession, docs: DataFrame, held_out: Column, hot: int = 65_536) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row; the model learns from the others.

    Words with at least one in ``hot`` of the training tokens (so at most ``hot``) are spread over the shards; scores do not
    depend on it.
    """
    parts = shuffle_partitions(spark)
    shards = parts * 5 // 4 + 1
    held_out = F.coalesce(held_out, F.lit(False))
    # rare words are only counted while the others are written
    seen = Observation("unigrams")
    ranks = [F.count_if(F.col("c") == r).alias(f"n{r}") for r in range(1, LOW + 2)]
    unigrams = unigram_counts(docs.where(~held_out)).observe(seen, F.sum("c").alias("total"), F.count(F.lit(1)).alias("types"), *ranks)
    with shuffles_dropped(spark):
        unigrams = materialise(spark, unigrams.where(F.col("c") > LOW), "unigrams")
    total, types = seen.get["total"] or 0, seen.get["types"] or 0
    n = np.array([0.0, *(seen.get[f"n{r}"] or 0 for r in range(1, LOW + 2))])
    d1 = discounts(n)
    common = types - float(n[1 : LOW + 1].sum())  # words of more than LOW occurrences
    unknown = float(sum((1 - d1[r]) * r * n[r] for r in range(1, LOW + 1)) + TAIL * common) / total if total else 1.0
    model = Model(int(total), int(types), d1, unknown)
    top = unigrams.where(F.col("c") * hot >= total).collect()  # at most `hot` rows
    top = np.array(sorted(tuple(r) for r in top), dtype=np.int64).reshape(-1, 2)
    frequent, counts = top[:, 0].copy(), top[:, 1].copy()

    keyed = keyed_pairs(docs, held_out, frequent, key_per_partition(spark, shards))
    with shuffles_dropped(spark):  # the dealt pairs are as large as the table
        table = materialise(spark, counted_pairs(keyed, frequent, counts, shards), "pairs", codec="zstd")
    pairs = table.where("shard >= 0")
    model.d2 = discounts(counts_of_counts(pairs))
    histories = history_table(pairs, model, key_per_partition(spark, parts))

    listed = table.where("shard < 0").select(
        F.col("bases")[0].alias("base"), F.col("word").alias("ids"), F.col("word_c").alias("none"), F.col("v").alias("out"), F.col("cnt").alias("size")
    )
    sums = shard_sums(pairs, model).unionByName(unseen_sums(unseen_pairs(pairs), histories, shards))
    # rows of the table hold many postings, so a batch is one row
    with shuffles_dropped(spark), session_setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "1"):
        sums = materialise(spark, sums, "sums")
    scored = text_sums(sums, listed, parts)
    return scored.withColumn("train_tokens", F.lit(model.total).cast("long"))
