"""MinHash near-duplicates on HyperMinHash registers (Yu and Weber, 2017).

A text's set holds the hashes of its runs of ``n`` words (A-Z lowered, words split at ASCII white space; a text of fewer
words is one run). Two sets are linked if 100 * |a & b| >= 100 * threshold * |a | b|, checked on the whole sets.

* **Registers.** The hash of a shingle names one of 128 buckets; a bucket keeps its least hash as 6 bits of leading zeros
  and 10 bits of mantissa, 256 bytes a set. Empty buckets take the register of another one, in an order of their own, so
  that registers of small sets agree with the probability of the Jaccard similarity, too.
* **Bands.** Four registers a band, 32 bands: sets of similarity 0.8 share a band but with probability 5e-8.
* **Estimate.** The share of equal registers, less the share that collides by chance at these two set sizes. Pairs five
  standard deviations below the threshold are not verified.
* **Verification in rounds.** Only components are asked for, so a bucket need not verify each of its pairs. Equal sets
  are one node. In each round a bucket gives its candidates between different components that have not failed before, or,
  if they are many, a spanning forest of them and the best of the others; they are verified on the whole sets and
  components join. The first round takes only the first bands: most copies of a large group are one component then, and
  the other bands give no pairs for them in the second round. A bucket that has given all its candidates is done; the
  whole sets of the others are gathered in the third round, which checks all their open pairs in place. No pair is left.
* **Large buckets** (over ``limit`` sets) are never gathered in one task. First all their sets are compared with one
  pivot, which makes near copies one component. Sets outside the bucket's largest component are then compared with blocks
  of the bucket; if there are more than ``limit`` of them, too, the bucket is first split by the further bands that its
  sets share (pairs at the threshold share one more but with probability 1e-6), up to ``depth`` times.

Defined results: NULL text counts as empty; texts without a word have the empty set, which is linked to nothing. Rows
with NULL ids take part: a component without any id has the component_id NULL. ``kept`` is "doc_id and component_id are
the same" (NULL and NULL are). Repeated ids and rows get a row each. Extra columns are not read. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from ratelake.llm.common import bounded, drop_kept, join_groups, materialise, short_batches, shuffle_partitions

BUCKET_BITS, MANTISSA_BITS, ROWS = 7, 10, 4
BUCKETS = 1 << BUCKET_BITS
BANDS = BUCKETS // ROWS
REST = 64 - BUCKET_BITS
_M = np.uint64(0x9E3779B97F4A7C15)
#: For every bucket the order in which it looks for a filled one, itself first.
_ORDER = np.stack([np.concatenate(([k], np.random.default_rng(k).permutation(np.delete(np.arange(BUCKETS), k)))) for k in range(BUCKETS)])


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: bytes | None, n: int, memo: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's runs of n words."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    k = min(n, len(words))
    out = np.full(len(words) - k + 1, k, dtype=np.uint64)
    for j in range(k):
        out = mix(out * _M + h[j : j + len(out)])
    return np.unique(out)


def registers(tokens: np.ndarray) -> np.ndarray:
    """The 128 registers of a set that is not empty: leading zeros, then the mantissa, of each bucket's least hash."""
    at = (tokens >> np.uint64(REST)).astype(np.int64)
    filled, first = np.unique(at, return_index=True)  # tokens are sorted, so the first is the least
    rest = (tokens[first] & np.uint64((1 << REST) - 1)).astype(np.float64)
    fraction, exponent = np.frexp(np.maximum(rest, 1.0))  # rest = fraction * 2 ** exponent, 0.5 <= fraction < 1
    zeros = np.clip(REST - exponent, 0, 62).astype(np.uint16)
    mantissa = ((fraction * 2 - 1) * (1 << MANTISSA_BITS)).astype(np.uint16)
    out = np.zeros(BUCKETS, dtype=np.uint16)
    out[filled] = zeros << np.uint16(MANTISSA_BITS) | mantissa
    full = np.zeros(BUCKETS, dtype=bool)
    full[filled] = True
    return out[_ORDER[np.arange(BUCKETS), full[_ORDER].argmax(axis=1)]]


def bands(regs: np.ndarray, rows: int = ROWS, number: int = BANDS) -> np.ndarray:
    """One 64-bit key per set and band: its registers (``rows``, at most four) and its number."""
    four = np.zeros((len(regs), number, 4), dtype=np.uint16)
    four[:, :, :rows] = regs[:, : number * rows].reshape(-1, number, rows)
    packed = four.reshape(-1, number * 4).view(np.uint64)
    return mix(mix(packed) + np.arange(number, dtype=np.uint64) * _M).view(np.int64)


def _register_odds() -> np.ndarray:
    """Probability that registers of two independent sets are equal, by the sets' sizes as powers of two."""
    low = np.array([2.0 ** -(z + 1) * (1 + m / 2**MANTISSA_BITS) for z in range(48) for m in range(0, 2**MANTISSA_BITS, 16)])
    high = np.array([2.0 ** -(z + 1) * (1 + (m + 16) / 2**MANTISSA_BITS) for z in range(48) for m in range(0, 2**MANTISSA_BITS, 16)])
    each = np.array([np.exp(-load * low) - np.exp(-load * high) for load in 2.0 ** (np.arange(40) - BUCKET_BITS)])
    return each @ each.T / 16  # intervals of 16 equally likely registers


_ODDS = _register_odds()


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity from equal registers, corrected for those that collide by chance."""
    same = (a == b).mean(axis=-1)
    odds = _ODDS[np.log2(size_a).astype(np.int64), np.log2(size_b).astype(np.int64)]
    return (same - odds) / (1 - odds)


def least_estimate(threshold: float) -> float:
    return threshold - 5 * float(np.sqrt(threshold * (1 - threshold) / BUCKETS))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of sorted distinct hashes."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def candidates(regs: np.ndarray, size: np.ndarray, comp: np.ndarray, failed: np.ndarray, threshold: float) -> np.ndarray:
    """Pairs (i < j) of a bucket between different components that may be linked, best estimates first. ``failed`` pairs
    i * n + j are left out."""
    n, least = len(size), least_estimate(threshold)
    found = []
    step = max(1, 4_000_000 // (n * BUCKETS))
    for lo in range(0, n, step):
        left = np.arange(lo, min(lo + step, n))
        a, b = size[left][:, None], size[None, :]
        ok = (np.minimum(a, b) >= (threshold - 1e-9) * np.maximum(a, b)) & (left[:, None] < np.arange(n)[None, :]) & (comp[left][:, None] != comp[None, :])
        i, j = np.nonzero(ok)
        i = left[i]
        e = estimate(regs[i], regs[j], size[i], size[j])
        good = e >= least
        found.append((i[good], j[good], e[good]))
    i, j, e = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(-e, kind="stable")
    i, j = i[order], j[order]
    new = ~np.isin(i * n + j, failed)
    return np.stack((i[new], j[new]), axis=1)


def chosen_pairs(pairs: np.ndarray, comp: np.ndarray, extra: int) -> np.ndarray:
    """Which of many candidate pairs (best first) to verify: a spanning forest over the components, found as every
    component's best pair again and again, and the best ``extra`` pairs."""
    out = np.arange(len(pairs)) < extra
    label = np.unique(comp, return_inverse=True)[1]
    while True:
        a, b = label[pairs[:, 0]], label[pairs[:, 1]]
        cross = np.flatnonzero(a != b)
        if not len(cross):
            return out
        ends = np.stack((a[cross], b[cross]), axis=1).ravel()
        best = cross[np.unique(np.unique(ends, return_index=True)[1] // 2)]
        out[best] = True
        parent = {}

        def find(x: int, parent=parent) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        for x, y in zip(a[best].tolist(), b[best].tolist(), strict=True):
            if (u := find(x)) != (v := find(y)):
                parent[max(u, v)] = min(u, v)
        label = np.array([find(x) for x in range(label.max() + 1)])[label]


def common_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """|x & y| for every x of a and y of b: products of their incidence in the tokens that both sides hold."""
    out = np.zeros((len(a), len(b)), dtype=np.int64)
    left, right = (np.concatenate(x) if x else np.zeros(0, dtype=np.uint64) for x in (a, b))
    names = np.intersect1d(left, right)

    def places(sets: list[np.ndarray], flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(names, flat), max(len(names) - 1, 0))
        held = names[at] == flat if len(names) else np.zeros(len(flat), dtype=bool)
        order = np.argsort(at[held], kind="stable")
        return row[held][order], at[held][order]

    (ra, ca), (rb, cb) = places(a, left), places(b, right)
    for lo in range(0, len(names), 2048):
        width = min(2048, len(names) - lo)
        sides = []
        for row, col, n in ((ra, ca, len(a)), (rb, cb, len(b))):
            first, last = np.searchsorted(col, (lo, lo + width))
            dense = np.zeros((n, width), dtype=np.float32)
            dense[row[first:last], col[first:last] - lo] = 1
            sides.append(dense)
        out += (sides[0] @ sides[1].T).astype(np.int64)
    return out


def linked_forest(pairs: np.ndarray, comp: np.ndarray, tokens: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Linked pairs that join the bucket's components. Few pairs are checked one by one, as far as they still join two
    components; many by one product of all sets."""
    if len(pairs) > 20 * len(tokens):
        size = np.array([len(t) for t in tokens])
        both = common_counts(tokens, tokens)[pairs[:, 0], pairs[:, 1]]
        pairs = pairs[100 * both >= percent * (size[pairs[:, 0]] + size[pairs[:, 1]] - both)]
        return [tuple(p) for p in pairs[chosen_pairs(pairs, comp, 0)].tolist()]
    root = np.unique(comp, return_inverse=True)[1].tolist()
    parent = list(range(len(root)))
    out = []

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in pairs.tolist():
        a, b = find(root[i]), find(root[j])
        if a != b and linked(tokens[i], tokens[j], percent):
            parent[b] = a
            out.append((i, j))
    return out


def bucket_pairs(rows: DataFrame, parts: int, threshold: float, turn: int) -> DataFrame:
    """(unit, a, b) from rows (unit, node, comp, size, regs, failed, give) of units of bounded size: candidates to verify,
    and a row without a and b for each unit that has more of them than it gave. A unit that is not to give pairs yet names
    the nodes of its candidates in rows without unit and b. If there is a column tokens, the pairs are linked ones that
    join all components of the unit that can be joined."""
    percent = round(100 * threshold)
    rows = rows if "tokens" in rows.columns else rows.withColumn("tokens", F.lit(None).cast("binary"))
    schema = "unit long, a long, b long"
    names = [f.split()[0] for f in schema.split(", ")]
    dealt = rows.select("unit", "node", "comp", "size", "regs", "failed", "give", "tokens").repartition(parts, "unit").sortWithinPartitions("unit", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple] = []

        def finish() -> None:
            units, nodes, comp, size, regs, failed, give, tokens = zip(*held, strict=True)
            place = {node: k for k, node in enumerate(nodes)}
            gone = [min(k, place[o]) * len(nodes) + max(k, place[o]) for k, others in enumerate(failed) for o in others or () if o in place]
            regs = np.frombuffer(b"".join(regs), dtype=np.uint16).reshape(-1, BUCKETS)
            comp = np.array(comp)
            pairs = candidates(regs, np.array(size), comp, np.array(gone, dtype=np.int64), threshold)
            if tokens[0] is not None:
                joined = linked_forest(pairs, comp, [np.frombuffer(t, dtype=np.uint64) for t in tokens], percent)
                out.extend((units[0], nodes[a], nodes[b]) for a, b in joined)
            elif not give[0]:
                out.extend((None, nodes[k], None) for k in np.unique(pairs).tolist())
            else:
                chosen = chosen_pairs(pairs, comp, 30 * 4**turn + (4**turn - 1) * len(nodes))
                out.extend((units[0], nodes[a], nodes[b]) for a, b in pairs[chosen].tolist())
                if not chosen.all():
                    out.append((units[0], None, None))
            held.clear()

        def batch_of() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=names)
            out.clear()
            return made

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[-1][0] != row[0]:
                    finish()
                held.append(row)
            if len(out) > 20_000:
                yield batch_of()
        if held:
            finish()
        if out:
            yield batch_of()

    return dealt.mapInArrow(run, schema)


def sift(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose registers let them be similar enough."""
    light = sets.select("node", "size", "regs")
    a = light.select(F.col("node").alias("a"), F.col("size").alias("size_a"), F.col("regs").alias("regs_a"))
    b = light.select(F.col("node").alias("b"), F.col("size").alias("size_b"), F.col("regs").alias("regs_b"))
    least = least_estimate(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype=np.uint16).reshape(-1, BUCKETS) for k in (3, 5))
            m, n = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            good = (estimate(x, y, m, n) >= least) & (np.minimum(m, n) >= (threshold - 1e-9) * np.maximum(m, n))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good))

    near = pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b")
    return near.select("a", "b", "size_a", "regs_a", "size_b", "regs_b").mapInArrow(run, "a long, b long")


def verify(pairs: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """(a, b, ok) for pairs of nodes, by their whole sets."""
    a = whole.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    b = whole.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    both = pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ok = [linked(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64), percent) for x, y in sides]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], names=["a", "b", "ok"])

    return both.mapInArrow(run, "a long, b long, ok boolean")


def _between(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """The edges (a < b) between the different labels of the edges' ends; a node without a label is its own."""
    for end in ("a", "b"):
        of_end = labels.select(F.col("node").alias(end), F.col("comp").alias("to"))
        edges = edges.join(of_end, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def connect(spark: SparkSession, edges: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(node, comp): one node of each component of ``edges`` (a, b) and of the components that ``labels`` gives.

    Every node moves to its neighbour (or itself) with the least hash, and on to where that one moved; the edges between
    what is left are the next round's. At most half of the nodes stay on average, whatever the graph's shape, so rounds
    shrink and no edge is walked again once its ends are one. A label's many followers are rows on the large side of a
    join, which AQE splits. Labels of a bounded number of nodes are broadcast.
    """

    def ordered(name: str) -> Column:
        return F.struct(F.xxhash64(name).alias("h"), F.col(name).alias("node"))

    known = spark.createDataFrame([], "node long, comp long") if labels is None else bounded(labels)
    labels = known if labels is None else labels
    most = 2 * edges.count()
    graph = materialise(spark, _between(edges.select("a", "b"), known), "edges", most)
    steps: list[DataFrame] = []
    while n := graph.count():
        both = graph.unionByName(graph.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min(ordered("b")).alias("near"))
        step = materialise(spark, near.select(F.col("a").alias("node"), F.least("near", ordered("a"))["node"].alias("comp")), "near", 2 * n)
        after = bounded(step).select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        steps.append(bounded(materialise(spark, step.join(after, "comp").select("node", F.col("far").alias("comp")), "step", 2 * n)))
        graph = materialise(spark, _between(graph, steps[-1]), "edges", n)
    if steps:
        most += known.count()
        new = steps[0].join(known, "node", "left_anti").select("node", F.col("node").alias("comp"))
        labels = labels.unionByName(new)
        for step in steps:
            labels = labels.join(step.select(F.col("node").alias("comp"), F.col("comp").alias("far")), "comp", "left")
            labels = labels.select("node", F.coalesce("far", "comp").alias("comp"))
    return materialise(spark, labels, "labels", most)


def per_text(make, schema: str, tokens_of):
    """mapInArrow function over rows (text binary, ...): ``make(row, tokens_of(text, memo))`` gives the output row."""
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        memo = WordHashes()
        for whole in batches:
            for lo in range(0, whole.num_rows, 250):
                if len(memo) > 300_000:
                    memo.clear()
                out = [make(row, tokens_of(row[0], memo)) for row in zip(*(c.to_pylist() for c in whole.slice(lo, 250).columns), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

    return run


def fold_sets(spark: SparkSession, signed: DataFrame) -> DataFrame:
    """One row per different set of (id, digest, print, size, regs): a number (node), its least id and how many rows have it."""
    same = [F.first(c).alias(c) for c in signed.columns if c not in ("id", "digest", "print")]
    sets = signed.groupBy("print").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.min("digest").alias("digest"), *same)
    return materialise(spark, sets.withColumn("node", F.monotonically_increasing_id()), "sets", signed.count(), 5_000)


def texts_of(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(text binary, id, digest); the digest finds the text of a set again, whatever the ids are."""
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"), F.col(id_column).cast("long").alias("id"))
    return texts.withColumn("digest", F.unhex(F.md5("text")))


def band_rows(sets: DataFrame, rows: int = ROWS, number: int = BANDS) -> DataFrame:
    """(node, band, key) of sets that are not empty: ``number`` bands of ``rows`` registers."""
    names = np.arange(number, dtype=np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                batch = whole.slice(lo, 1000)
                regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint16).reshape(-1, BUCKETS)
                node = batch.column(0).take(pa.array(np.repeat(np.arange(len(regs)), number)))
                keys = pa.array(bands(regs, rows, number).ravel())
                yield pa.RecordBatch.from_arrays([node, pa.array(np.tile(names, len(regs))), keys], names=["node", "band", "key"])

    return sets.where("size > 0").select("node", "regs").mapInArrow(run, "node long, band int, key long")


def whole_sets(docs: DataFrame, wanted: DataFrame, per_text) -> DataFrame:
    """(node, tokens) of the wanted (node, digest); ``per_text`` makes a mapInArrow function over (text, ...)."""
    own = docs.join(wanted.hint("merge"), "digest").select("text", "node")
    schema = "node long, tokens binary"
    return own.mapInArrow(per_text(lambda row, tokens: (row[1], tokens.tobytes()), schema), schema).dropDuplicates(["node"])


def _with_comps(rows: DataFrame, comps: DataFrame | None) -> DataFrame:
    if comps is None:
        return rows.withColumn("comp", F.col("node"))
    return rows.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def _open_units(rows: DataFrame) -> DataFrame:
    """The rows (unit, node, comp, ...) whose unit, which is bounded, has more than one component."""
    whole = Window.partitionBy("unit")
    marked = rows.withColumn("least", F.min("comp").over(whole)).withColumn("most", F.max("comp").over(whole))
    return marked.where("least < most").drop("least", "most")


def _split_large(spark: SparkSession, large: DataFrame, comps: DataFrame, limit: int, depth: int) -> tuple[DataFrame, DataFrame]:
    """After their pivot: open large buckets (key, node, band, level) as units of bounded size, and the rows to split further."""
    most = large.count()
    rows = materialise(spark, _with_comps(large, bounded(comps)), "labelled", most)
    per_comp = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    main = per_comp.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("main"), F.sum("n").alias("n"))
    main = main.select("key", "n", F.col("main.comp").alias("main"), (F.col("n") - F.col("main.n")).alias("others")).where("others > 0")
    rows = materialise(spark, rows.join(main, "key"), "counted", most)
    fits = (F.col("others") <= limit) | (F.col("level") >= depth)
    groups, blocks = F.ceil(F.col("others") / limit).cast("int"), F.ceil(F.col("n") / limit).cast("int")
    own_block, own_group = F.pmod(F.xxhash64("node"), blocks).cast("int"), F.pmod(F.xxhash64("node", F.lit(1)), groups).cast("int")
    dealt = rows.where(fits).withColumn("g", F.explode(F.sequence(F.lit(0), groups - 1))).withColumn("b", own_block)
    rare = rows.where(fits & (F.col("comp") != F.col("main"))).withColumn("b", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn("g", own_group)
    both = dealt.select("key", "g", "b", "node").unionByName(rare.select("key", "g", "b", "node"))
    units = both.select(F.xxhash64("key", "g", "b").alias("unit"), "node").distinct()
    return units, rows.where(~fits).select("key", "node", "band", "level")


def further_bands(rows: DataFrame, sets: DataFrame, whole: DataFrame) -> DataFrame:
    """Buckets split by each later band of their sets."""
    others = band_rows(sets.join(rows.select("node").distinct(), "node")).toDF("node", "next", "other").where("next > 0")
    split = rows.join(others, "node").where("next > band")
    return split.select(F.xxhash64("key", "other").alias("key"), "node", F.col("next").alias("band"), (F.col("level") + 1).alias("level"))


def components(
    spark: SparkSession, sets: DataFrame, buckets: DataFrame, further, fetch, threshold: float, limit: int, depth: int, first: int = 4
) -> tuple[DataFrame, DataFrame]:
    """(node, comp) of the linked sets of ``sets`` (node, digest, size, regs), and (node, tokens) of at least these.
    ``buckets`` (key, node, band) hold the sets to compare; the first round gives the pairs of the ``first`` bands.
    ``further(rows, sets, whole)`` splits large buckets, ``fetch(nodes)`` gives the whole sets of (node, digest)."""
    parts, percent = shuffle_partitions(spark), round(100 * threshold)
    n_sets = sets.count()
    most = BANDS * n_sets  # about the rows of all buckets

    def by_size(buckets: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        pivot = F.min_by("node", F.xxhash64("node")).alias("pivot")  # the same one in all bands that hold it
        counts = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("sets"), pivot).where("sets > 1")
        buckets = materialise(spark, buckets.join(counts, "key"), name, most)
        return buckets.where(F.col("sets") <= limit).select(F.col("key").alias("unit"), "node", "band"), buckets.where(F.col("sets") > limit).drop("sets")

    small, large = by_size(buckets.withColumn("level", F.lit(0)), "buckets")
    whole = comps = failed = None
    for turn in range(1_000):
        near_comps = comps if comps is None else bounded(comps)
        near_failed = failed if failed is None else bounded(failed)
        # in the first round every set is a component of its own, so every unit is open
        rows = _with_comps(small, comps) if comps is None else _open_units(_with_comps(small, near_comps))
        rows = rows.join(sets.select("node", "size", "regs"), "node")
        rows = rows.withColumn("give", F.col("band") < first if turn == 0 else F.lit(True))
        if failed is None:
            rows = rows.withColumn("failed", F.lit(None).cast("array<long>"))
        else:
            rows = rows.join(failed.groupBy("a").agg(F.collect_list("b").alias("failed")).withColumnRenamed("a", "node"), "node", "left")
        if turn > 1:
            rows = rows.join(whole.hint("merge"), "node")
        with short_batches(spark):
            given = materialise(spark, bucket_pairs(rows, parts, threshold, turn).distinct(), "given", most)
        starred = large.where(F.col("band") < first) if turn == 0 else large
        starred = starred.where("node <> pivot").select("key", "node", "pivot")
        if comps is not None:
            of_pivot = near_comps.select(F.col("node").alias("pivot"), F.col("comp").alias("pivot_comp"))
            starred = _with_comps(starred, near_comps).join(of_pivot, "pivot", "left").where(F.col("comp") != F.coalesce("pivot_comp", "pivot"))
        starred = starred.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
        found = given.where("b IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        pairs = (found.unionByName(starred) if turn < 2 else starred).distinct()
        if failed is not None:
            pairs = pairs.join(near_failed, ["a", "b"], "left_anti")
        pairs = materialise(spark, sift(pairs, sets, threshold), "pairs", most, 20_000)
        truncated = given.where("a IS NULL").select("unit")
        if whole is None:
            nodes = given.where("a IS NOT NULL AND b IS NULL").select(F.col("a").alias("node")).unionByName(large.select("node"))
            nodes = nodes.unionByName(pairs.select(F.explode(F.array("a", "b")).alias("node"))).unionByName(small.join(truncated, "unit", "left_semi").select("node"))
            with short_batches(spark):
                whole = materialise(spark, fetch(sets.select("node", "digest").join(nodes.distinct(), "node")), "whole", n_sets, 2_000)
        with short_batches(spark):
            checked = materialise(spark, verify(pairs, whole, percent), "checked", pairs.count(), 2_000)
        good, bad = checked.where("ok").select("a", "b"), checked.where("NOT ok").select("a", "b")
        good = good if turn < 2 else good.unionByName(found)
        failed = bad if failed is None else failed.unionByName(bad)
        if comps is None or not good.isEmpty():
            comps = connect(spark, good, comps)
        if turn == 0:
            continue
        small = materialise(spark, small.join(truncated, "unit", "left_semi"), "small", most)
        more = False
        if not large.isEmpty():
            units, rows = _split_large(spark, large.drop("pivot"), comps, limit, depth)
            parted, large = by_size(further(rows, sets, whole), "further")
            small = materialise(spark, small.unionByName(units.withColumn("band", F.lit(0))).unionByName(parted), "small", most)
            more = not large.isEmpty()
        if not more and small.isEmpty():
            return comps, whole
    msg = "buckets did not come to an end"
    raise RuntimeError(msg)


def near_duplicates(
    spark: SparkSession, docs: DataFrame, n: int = 2, threshold: float = 0.8, limit: int = 1000, depth: int = 3, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: the id, n_shingles, component_id (least id of its component), kept."""
    texts = texts_of(docs, id_column, text)

    def own_text(make, schema: str):
        return per_text(make, schema, lambda value, memo: shingles(value, n, memo))

    def sign(row: tuple, tokens: np.ndarray) -> tuple:
        return row[1], row[2], xxhash.xxh3_128_digest(tokens.tobytes()), len(tokens), registers(tokens).tobytes() if len(tokens) else b""

    schema = "id long, digest binary, print binary, size long, regs binary"
    signed = materialise(spark, texts.mapInArrow(own_text(sign, schema), schema), "signatures")
    sets = fold_sets(spark, signed)
    fetch = lambda wanted: whole_sets(texts, wanted, own_text)
    comps, _ = components(spark, sets, band_rows(sets), further_bands, fetch, threshold, limit, depth)
    own = sets.select("print", "node", "id", "size", "copies").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    n_sets = sets.count()
    own = materialise(spark, own, "own", n_sets)
    least = materialise(spark, own.groupBy("comp").agg(F.min("id").alias("component_id")), "least", n_sets)
    classes = materialise(spark, own.join(least, "comp").select("print", "size", "copies", "component_id"), "classes", n_sets)
    found = join_groups(signed.select("id", "print"), classes, ["print"], "copies", signed.count())
    # rows without a word are linked to nothing, not to each other either
    component = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("id"))
    found = found.select(F.col("id").alias(id_column), F.col("size").alias("n_shingles"), component.alias("component_id"))
    return found.withColumn("kept", F.col(id_column).eqNullSafe(F.col("component_id")))
