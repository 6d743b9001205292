"""Ranked lexical search by Block-Max MaxScore over a segmented inverted index.

Terms are runs of letters and digits (every character beyond ASCII is one), only A-Z lowered. The index is a table: each
segment holds some thousand documents in order of their ids, with a header row (ids and lengths) and a row per term:
its document frequency in the segment and its postings in blocks of 128, whose gaps and frequencies are packed in 1, 2 or
4 bytes each, beside the last document and the greatest impact of every block. A posting's impact is the integer
(10^9 * tf) div (1000 * tf + 12 * m), m = 75 + (25 * n * N) div L; a term's weight floor(1000 * ln((2N + 2) / (2df + 1))).

A search joins the query terms to the posting rows, so only lists that some query needs are moved, and sends each
segment's lists to one place for a block of queries. There each query runs over windows of documents:

* lists are ordered by their bound (weight times greatest impact). The lists of the longest prefix whose bounds add up
  to no more than the score of the current k-th best document are non-essential: a document in these alone cannot enter;
* essential lists are unpacked in the window and added up; documents that cannot enter with all non-essential bounds go;
* non-essential lists follow from the greatest bound down: the block maxima first reject documents, and only blocks that
  still hold a candidate are unpacked.

The heaps of k documents per query go on from segment to segment of a task and are merged at the end.

Equal scores are ranked by ascending id, NULL ids last; rows that repeat an id are ranked in any order. Documents without a
term, empty and NULL texts are in no list; queries without a term, and documents with score 0, give no rows. Repeated
items are searched once per row of ``items``. Extra columns are not read; no documents or no items give no rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.llm.common import materialise, shuffle_partitions

BLOCK = 128
SEGMENT_DOCS, SEGMENT_TERMS = 8192, 2_000_000
WINDOW = 1024
#: ASCII letters and digits stay (A-Z lowered), all other ASCII is a space, bytes of other characters stay.
_FOLD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in bytes(range(256)).lower())

INDEX_SCHEMA = (
    "segment string, term binary, df long, ids array<long>, lengths array<int>, "
    "lasts array<int>, impacts array<int>, widths array<tinyint>, ends array<int>, packed binary"
)


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in pieces of some 2 MB that end at a separator."""
    at = 0
    while at < len(text):
        end = min(at + (1 << 21), len(text))
        part = text[at:end].translate(_FOLD)
        while end < len(text) and part[-1] != 32:
            more = text[end : end + 4096].translate(_FOLD)
            cut = more.find(b" ")
            part, end = (part + more, end + len(more)) if cut < 0 else (part + more[: cut + 1], end + cut + 1)
        at = end
        yield part.split()


def length_factor(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of each document."""
    if n_docs * 25 * int(lengths.max(initial=0)) < 1 << 62:
        return 75 + 25 * lengths.astype(np.int64) * n_docs // n_terms
    return np.array([75 + 25 * int(n) * n_docs // n_terms for n in lengths], dtype=np.int64)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Segment:
    """Documents gathered for one segment of the index."""

    def __init__(self) -> None:
        self.vocabulary: dict[bytes, int] = defaultdict(lambda: len(self.vocabulary))
        self.ids: list[int | None] = []
        self.terms: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.lengths: list[int] = []
        self.held = 0

    def add(self, doc_id: int | None, text: bytes | None) -> None:
        found: np.ndarray | None = None
        for words in terms_of(text or b""):
            part = np.fromiter(map(self.vocabulary.__getitem__, words), np.int64, len(words))
            found = part if found is None else np.concatenate((found, part))
        if found is not None and len(found):
            terms, counts = np.unique(found, return_counts=True)
            self.ids.append(doc_id)
            self.terms.append(terms)
            self.counts.append(counts)
            self.lengths.append(len(found))
            self.held += len(terms)

    def full(self) -> bool:
        return len(self.ids) >= SEGMENT_DOCS or self.held >= SEGMENT_TERMS

    def rows(self, name: str, n_docs: int, n_terms: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        order = sorted(range(len(self.ids)), key=lambda k: (self.ids[k] is None, self.ids[k] or 0))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        lengths = np.array(self.lengths, dtype=np.int64)[order]
        yield pa.RecordBatch.from_pylist([{"segment": name, "ids": [self.ids[k] for k in order], "lengths": lengths.tolist()}], schema=schema)
        term, tf = np.concatenate(self.terms), np.concatenate(self.counts)
        doc = np.repeat(place, [len(t) for t in self.terms])
        # postings by term, then document
        by = np.argsort(term * len(order) + doc, kind="stable")
        term, doc, tf = term[by], doc[by], tf[by]
        impact = 1_000_000_000 * tf // (1000 * tf + 12 * length_factor(lengths, n_docs, n_terms)[doc])
        df = np.bincount(term)
        first = np.concatenate(([0], np.cumsum(df)))
        # blocks: BLOCK postings of one term
        inside = np.arange(len(term)) - first[term]
        opens = inside % BLOCK == 0
        start = np.flatnonzero(opens)
        size = np.diff(np.append(start, len(term)))
        block = np.cumsum(opens) - 1
        gap = doc - np.where(opens, 0, np.concatenate(([0], doc[:-1])))
        wide = [np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4)) for most in (np.maximum.reduceat(gap, start), np.maximum.reduceat(tf, start))]
        nbytes = size * (wide[0] + wide[1])
        ends = np.cumsum(nbytes)
        packed = np.zeros(int(ends[-1]), dtype=np.uint8)
        inside %= BLOCK
        begins = (ends - nbytes)[block]
        for values, width, base in ((gap, wide[0][block], begins), (tf, wide[1][block], begins + (size * wide[0])[block])):
            for byte in range(4):
                has = width > byte
                packed[(base + inside * width + byte)[has]] = (values[has] >> (8 * byte)) & 255
        blocks_of = np.diff(np.append(np.flatnonzero(start == first[term[start]]), len(start)))
        block_first = np.concatenate(([0], np.cumsum(blocks_of)))
        byte_first = np.concatenate(([0], ends))[block_first]
        names = list(self.vocabulary)
        lasts, best = doc[start + size - 1].astype(np.int32), np.maximum.reduceat(impact, start).astype(np.int32)
        widths = (wide[0] * 8 + wide[1]).astype(np.int8)
        ends = (ends - np.repeat(byte_first[:-1], blocks_of)).astype(np.int32)
        data = packed.tobytes()
        for lo in range(0, len(names), 20_000):
            hi = min(lo + 20_000, len(names))
            b0, b1 = int(block_first[lo]), int(block_first[hi])
            offsets = pa.array((block_first[lo : hi + 1] - b0).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x[b0:b1])) for x in (lasts, best, widths, ends)]
            blobs = pa.array([data[byte_first[k] : byte_first[k + 1]] for k in range(lo, hi)], pa.binary())
            columns = [pa.array([name] * (hi - lo)), pa.array(names[lo:hi], pa.binary()), pa.array(df[lo:hi].astype(np.int64)), pa.nulls(hi - lo, schema.field("ids").type), pa.nulls(hi - lo, schema.field("lengths").type)]
            columns += [x.cast(schema.field(c).type) for c, x in zip(("lasts", "impacts", "widths", "ends"), lists, strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, blobs], schema=schema)


def corpus_size(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """Documents with at least one term, and all terms with repeats."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs = n_terms = 0
        for batch in batches:
            for value in batch.column(0):
                n = sum(map(len, terms_of(value.as_py() or b"")))
                n_docs, n_terms = n_docs + (n > 0), n_terms + n
        yield pa.RecordBatch.from_pydict({"d": [n_docs], "t": [n_terms]})

    row = docs.select(F.col(text).cast("binary")).mapInArrow(count, "d long, t long").agg(F.sum("d"), F.sum("t")).first()
    return row[0] or 0, row[1] or 0


def build_index(docs: DataFrame, n_docs: int, n_terms: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of the index (INDEX_SCHEMA) over every row of ``docs``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(INDEX_SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        segment, made = Segment(), 0
        for batch in batches:
            for doc_id, value in zip(batch.column(0), batch.column(1), strict=True):
                segment.add(doc_id.as_py(), value.as_py())
                if segment.full():
                    yield from segment.rows(f"{TaskContext.get().partitionId()}-{made}", n_docs, n_terms, schema)
                    segment, made = Segment(), made + 1
        if segment.ids:
            yield from segment.rows(f"{TaskContext.get().partitionId()}-{made}", n_docs, n_terms, schema)

    return docs.select(F.col(id_column).cast("long"), F.col(text).cast("binary")).mapInArrow(run, INDEX_SCHEMA)


class Postings:
    """One list of a segment; ``unpacked`` counts the blocks that were unpacked."""

    def __init__(self, weight: int, lasts: list[int], impacts: list[int], widths: list[int], ends: list[int], packed: bytes) -> None:
        self.lasts, self.best = np.array(lasts), np.array(impacts, dtype=np.int64) * weight
        self.weight, self.widths, self.ends, self.packed = weight, widths, ends, packed
        self.bound = int(self.best.max())
        self.cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, k: int, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of block k."""
        found = self.cache.get(k)
        if found is None:
            wg, wt = divmod(self.widths[k], 8)
            begin = self.ends[k - 1] if k else 0
            size = (self.ends[k] - begin) // (wg + wt)
            gaps = np.frombuffer(self.packed, dtype=f"<u{wg}", count=size, offset=begin)
            tf = np.frombuffer(self.packed, dtype=f"<u{wt}", count=size, offset=begin + size * wg).astype(np.int64)
            docs = np.cumsum(gaps, dtype=np.int64)
            found = self.cache[k] = docs, self.weight * (1_000_000_000 * tf // (1000 * tf + 12 * m[docs]))
        return found


def search_segment(lists: list[tuple[int, Postings]], ids: list[int | None], m: np.ndarray, heap: list[tuple], k: int) -> list[tuple]:
    """The k best of the heap [(score, id)] and the segment, for a query of (repeats, postings). Ordered best first."""
    lists = sorted(lists, key=lambda x: x[0] * x[1].bound)
    bounds = np.array([r * p.bound for r, p in lists])
    sums = np.cumsum(bounds)
    for lo in range(0, len(ids), WINDOW):
        hi = min(lo + WINDOW, len(ids))
        least = heap[-1][0] if len(heap) == k else 0  # to enter, a score must reach it, or exceed 0
        essential = int(np.searchsorted(sums, least if least else 1, side="left"))  # sums of those before are below it
        if essential == len(lists):
            break
        score = np.zeros(hi - lo, dtype=np.int64)
        for r, p in lists[essential:]:
            for b in range(int(np.searchsorted(p.lasts, lo)), len(p.lasts)):
                docs, values = p.block(b, m)
                a, z = np.searchsorted(docs, (lo, hi))
                score[docs[a:z] - lo] += r * values[a:z]
                if z < len(docs) or p.lasts[b] >= hi - 1:
                    break
        rest = int(sums[essential - 1]) if essential else 0
        at = np.flatnonzero((score > 0) & (score + rest >= least))
        for place in range(essential - 1, -1, -1):
            if not len(at):
                break
            r, p = lists[place]
            rest = int(sums[place - 1]) if place else 0
            block = np.searchsorted(p.lasts, at + lo)  # the block that may hold the document
            within = block < len(p.lasts)
            most = np.zeros(len(at), dtype=np.int64)
            most[within] = r * p.best[block[within]]
            keep = score[at] + most + rest >= least
            at, block, within = at[keep], block[keep], within[keep]
            for b in np.unique(block[within]).tolist():
                docs, values = p.block(b, m)
                mine = at[block == b]
                spot = np.minimum(np.searchsorted(docs, mine + lo), len(docs) - 1)
                held = docs[spot] == mine + lo
                score[mine[held]] += r * values[spot[held]]
            at = at[score[at] + rest >= least]
        at = at[score[at] > 0]
        if len(at):
            if len(at) > k:  # documents are in order of their ids, so a stable sort keeps the least ids of equal scores
                at = at[np.argsort(-score[at], kind="stable")[:k]]
            heap = sorted(heap + [(int(score[x]), ids[lo + x]) for x in at], key=rank_key)[:k]
    return heap


def rank_key(entry: tuple) -> tuple:
    score, doc_id = entry
    return -score, doc_id is None, doc_id or 0


def search(spark: SparkSession, index: DataFrame, items: DataFrame, n_docs: int, n_terms: int, k: int = 20, id_column: str = "doc_id", item_column: str = "item_id", text: str = "text", block: int = 1000) -> DataFrame:
    """(item, rank, id, score): the k best documents of every row of ``items`` with a score above 0. ``index`` is a
    written table of build_index()'s rows; ``block`` rows of items are searched together."""
    parts = shuffle_partitions(spark)
    schema = f"{item_column} long, rank int, {id_column} long, score long"

    def query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, row, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts: dict[bytes, int] = defaultdict(int)
                for words in terms_of(value or b""):
                    for w in words:
                        counts[w] += 1
                out += [(item, row, w, c) for w, c in counts.items()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.int64()), strict=True)], names=["item", "row", "term", "repeats"])

    rows = items.select(F.col(item_column).cast("long").alias("item"), F.monotonically_increasing_id().alias("row"), F.col(text).cast("binary").alias("text"))
    asked = materialise(spark, rows.mapInArrow(query_terms, "item long, row long, term binary, repeats long"), "queries")
    n_rows = asked.select("row").distinct().count()
    n_blocks = max(1, -(-n_rows // block))
    of_block = F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("int").alias("qblock")
    df = index.where("term IS NOT NULL").select("term", "df").join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("all_df"))
    users = asked.groupBy(of_block, "term").agg(F.collect_list(F.struct("row", "item", "repeats")).alias("users")).join(df, "term")
    users = materialise(spark, users, "users")
    # a row per segment, term and block of queries; the header goes to each block of queries
    lists = index.where("term IS NOT NULL").select("segment", "term", "lasts", "impacts", "widths", "ends", "packed").join(users, "term")
    lists = lists.select("segment", "qblock", "users", "all_df", "lasts", "impacts", "widths", "ends", "packed", F.lit(None).cast("array<long>").alias("ids"), F.lit(None).cast("array<int>").alias("lengths"))
    blocks = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("qblock")
    heads = index.where("term IS NULL").select("segment", blocks, "ids", "lengths")
    both = lists.unionByName(heads, allowMissingColumns=True)
    # a header comes before the lists of its segment
    dealt = both.repartition(parts, "qblock", "segment").sortWithinPartitions("qblock", "segment", F.col("ids").isNull())
    dealt = dealt.select("qblock", "segment", "users", "all_df", "lasts", "impacts", "widths", "ends", "packed", "ids", "lengths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[tuple, list[tuple]] = {}
        own: dict[tuple, list[tuple[int, Postings]]] = defaultdict(list)
        ids: list = []
        m = np.zeros(0, dtype=np.int64)
        qblock = None

        def finish() -> None:
            for query, lists in own.items():
                heaps[query] = search_segment(lists, ids, m, heaps.get(query, []), k)
            own.clear()

        def given() -> Iterator[pa.RecordBatch]:
            out = [(item, row, doc, score) for (row, item), heap in heaps.items() for score, doc in heap]
            heaps.clear()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["item", "row", "doc", "score"])

        for row in (r for batch in batches for lo in range(0, batch.num_rows, 64) for r in batch.slice(lo, 64).to_pylist()):
            if row["ids"] is not None:
                finish()
                if row["qblock"] != qblock:
                    yield from given()
                qblock, ids = row["qblock"], row["ids"]
                m = length_factor(np.array(row["lengths"]), n_docs, n_terms)
            elif (w := weight(row["all_df"], n_docs)) > 0:
                postings = Postings(w, row["lasts"], row["impacts"], row["widths"], row["ends"], row["packed"])
                for user in row["users"]:
                    own[user["row"], user["item"]].append((user["repeats"], postings))
        finish()
        yield from given()

    best = dealt.mapInArrow(run, "item long, row long, doc long, score long")
    # merge the tasks' heaps: k rows per query and task, as one array per query
    entry = F.struct((-F.col("score")).alias("down"), F.col("doc").isNull().alias("none"), F.col("doc").alias("doc"), F.col("score").alias("score"))
    merged = best.groupBy("item", "row").agg(F.slice(F.sort_array(F.collect_list(entry)), 1, k).alias("best"))
    out = merged.select("item", F.posexplode("best").alias("at", "hit"))
    names = [f.split()[0] for f in schema.split(", ")]
    return out.select(F.col("item"), (F.col("at") + 1).cast("int"), F.col("hit.doc"), F.col("hit.score")).toDF(*names)


def rank_documents(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """Index all of ``docs`` and search it for every row of ``items``."""
    n_docs, n_terms = corpus_size(docs)
    index = materialise(spark, build_index(docs, n_docs, n_terms), "index")
    return search(spark, index, items, n_docs, n_terms, k)
