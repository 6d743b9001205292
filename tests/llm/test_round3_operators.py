"""HyperMinHash near-duplicates, whitening and ranked search against brute force on small tables."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ratelake.llm import chosen_path, common, hyperminhash, lexical, queries, whitening

SF = "/root/testdata/sf0.001"
UPPER = {c: c + 32 for c in range(65, 91)}
LONG = "lorem ipsum dolor sit amet " * 3000


def sets_of(texts, n=2):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(UPPER))
        out.append(frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset())
    return out


def components_of(rows):
    """(n_shingles, component) per row of (id, text), from all pairs."""
    sets = sets_of([t for _, t in rows])
    where = defaultdict(list)
    for k, s in enumerate(sets):
        where[s].append(k)
    distinct = [s for s in where if s]
    near = {s: [t for t in distinct if len(s) <= 1.25 * len(t) and len(t) <= 1.25 * len(s) and 100 * len(s & t) >= 80 * len(s | t)] for s in distinct}
    comp, seen = {}, set()
    for s in distinct:
        if s not in seen:
            group, todo = {s}, [s]
            while todo:
                for t in near[todo.pop()]:
                    if t not in group:
                        group.add(t)
                        todo.append(t)
            seen |= group
            least = min((rows[k][0] for t in group for k in where[t] if rows[k][0] is not None), default=None)
            comp |= dict.fromkeys(group, least)
    return Counter((i, len(s), comp[s] if s else i) for (i, _), s in zip(rows, sets, strict=True))


def mutated(rng, groups, size, most):
    rows = []
    for g in range(groups):
        words = [f"w{x}" for x in rng.integers(0, 3000, size)]
        for c in range(int(rng.integers(1, 12))):
            own = list(words)
            for _ in range(int(rng.integers(0, most))):
                own[int(rng.integers(0, size))] = f"n{g}x{c}"
            rows.append((len(rows), " ".join(own)))
    return rows


@pytest.mark.parametrize("limit", [1000, 4])
def test_near_duplicates_against_all_pairs(spark, limit):
    rng = np.random.default_rng(3)
    rows = mutated(rng, 12, 90, 9) + [(i + 500, t) for i, t in mutated(rng, 12, 6, 2)]
    rows += [(900, None), (901, ""), (902, "  \n"), (903, "One"), (904, "one"), (None, rows[0][1]), (None, "a text of its own"), (905, LONG), (906, LONG + "tail"), (905, LONG), (7, "an id that two texts share"), (907, "ÄÖ x ÄÖ"), (908, "äö x äö")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, print string, comp long").repartition(3)
    got = hyperminhash.near_duplicates(spark, df, limit=limit).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == components_of(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_one_large_group(spark):
    """More near copies than a bucket may hold, some of them only linked through others."""
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(400):
        own = list(words)
        for at in rng.integers(0, 60, int(rng.integers(0, 7))):
            own[at] = f"n{k % 7}"
        rows.append((k, " ".join(own)))
    got = hyperminhash.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), limit=40).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == components_of(rows)


def test_connect_contracts_chains_stars_and_earlier_components(spark):
    """Components of a long chain, a star, random edges, loops and repeats; a second call adds edges to the first one's."""
    rng = random.Random(4)
    chain = [(k, k + 1) for k in range(300)]
    star = [(1000, 1001 + k) for k in range(200)] * 2
    loose = [(2000 + rng.randrange(150), 2000 + rng.randrange(150)) for _ in range(70)]
    later = [(150, 1100), (5000, 5001), (5001, 2000), (7, 9)]

    def least(edges):
        root = {x: x for e in edges for x in e if e[0] != e[1]}
        for _ in root:
            before = dict(root)
            for a, b in edges:
                if a != b:
                    root[a] = root[b] = min(root[a], root[b])
            if root == before:
                break
        return root

    def frame(edges):
        return spark.createDataFrame(edges, "a long, b long")

    def classes(pairs):
        found = {}
        for node, comp in pairs:
            found.setdefault(comp, set()).add(node)
        return sorted(map(sorted, found.values()))

    first = hyperminhash.connect(spark, frame(chain + star + loose))
    got = [tuple(r) for r in first.collect()]
    assert classes(got) == classes(least(chain + star + loose).items())
    assert len(got) == len({n for n, _ in got}) and all((c, c) in set(got) for _, c in got)
    assert classes(tuple(r) for r in hyperminhash.connect(spark, frame(later), first).collect()) == classes(least(chain + star + loose + later).items())
    assert sorted(map(tuple, hyperminhash.connect(spark, frame([]), first).collect())) == sorted(got)
    assert hyperminhash.connect(spark, frame([])).count() == 0


def test_near_duplicates_matches_sql_and_empty(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(queries.SQL["op11_minhash"]).fetchall()
    assert sorted(tuple(r) for r in queries.op11_minhash(spark, SF).collect()) == sorted(want)
    assert hyperminhash.near_duplicates(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_register_estimates():
    rng = np.random.default_rng(1)
    for size in (3, 30, 300, 3000):
        found, truth = [], []
        for _ in range(60):
            tokens = rng.integers(0, 2**63, size + size // 3 + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            a, b = np.unique(tokens[:size]), np.unique(tokens[size // 3 :])
            x, y = (hyperminhash.registers(s)[None] for s in (a, b))
            found.append(hyperminhash.estimate(x, y, np.array([len(a)]), np.array([len(b)]))[0])
            truth.append(len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
        assert abs(np.mean(found) - np.mean(truth)) < 0.05


def whitened(rows):
    keep = [(i, e) for i, e in rows if e is not None and len(e) and all(c is not None and np.isfinite(c) for c in e)]
    x = np.array([np.floor(64 * np.array(e, dtype=np.float64)) for _, e in keep]).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    d = n * x - s
    z = d / n
    values, vectors = np.linalg.eigh(z.T @ z / n)
    return [i for i, _ in keep], n, (d * d).sum(axis=1), z, values[::-1], vectors[:, ::-1]


def test_whitening(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((200, 10)) * np.linspace(1, 9, 10)
    rows = [(k, v.tolist()) for k, v in enumerate(base)] + [(300 + k, base[0].tolist()) for k in range(90)]
    rows += [(400, None), (401, [1.0] * 9 + [None]), (402, [float("nan")] * 10), (403, [float("inf")] * 10), (404, []), (3, base[9].tolist()), (None, base[8].tolist())]
    df = spark.createDataFrame([(i, e, 1, "x") for i, e in rows], "vec_id long, embedding array<double>, n int, component string").repartition(3)
    got = whitening.whiten(spark, df.union(df.limit(0)), components=6).collect()
    ids, n, deviation, z, values, vectors = whitened(rows)
    assert len(got) == 6 * n
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == Counter(zip(ids, deviation.tolist(), strict=True))
    for c in range(6):
        mine = sorted((r for r in got if r.component == c + 1), key=lambda r: (r.vec_id is None, r.vec_id or 0, r.whitened))
        want = z @ vectors[:, c] / math.sqrt(values[c])
        assert {(r.n, r.component) for r in mine} == {(n, c + 1)}
        assert all(math.isclose(r.explained, values[c] / values.sum(), rel_tol=1e-9) for r in mine)
        best = min(np.abs(np.sort([r.whitened for r in mine]) - np.sort(s * want)).max() for s in (1, -1))
        assert best < 1e-9
    assert got[0].identity_error < 1e-9


def test_whitening_edge_cases(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark, spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark, spark.createDataFrame([(1, None), (2, [])], schema)).count() == 0
    assert whitening.whiten(spark, spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).count() == 0
    two = whitening.whiten(spark, spark.createDataFrame([(1, [1.0, 2.0, 0.0]), (2, [3.0, 5.0, 0.0]), (3, [1.0])], schema)).collect()
    assert Counter(r.vec_id for r in two) == {1: 1, 2: 1} and {round(abs(r.whitened), 9) for r in two} == {1.0}
    huge = whitening.whiten(spark, spark.createDataFrame([(1, [3e38, 0.0]), (2, [-3e38, 1.0])], schema), components=1).collect()
    assert len(huge) == 2 and huge[0].deviation is None


def test_eigen_with_close_and_equal_values():
    rng = np.random.default_rng(5)
    for values in ([5, 5, 5, 5 - 1e-12, 2, 1, 1, 0.5], [3, 3 - 1e-9, 3 - 2e-9, 1e-3, 1e-3], [1] * 6, [7]):
        q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
        v = q @ np.diag(np.array(values, dtype=float)) @ q.T
        e, u = whitening.eigen((v + v.T) / 2, len(values))
        assert np.abs(e - sorted(values, reverse=True)).max() < 1e-13 * 10 and np.abs(u.T @ u - np.eye(len(values))).max() < 1e-12
        assert np.abs(v @ u - u * e).max() < 1e-12


def ranked(rows, items, k=20):
    term = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
    docs = [(i, Counter(term.findall((t or "").translate(UPPER)))) for i, t in rows]
    docs = [(i, c) for i, c in docs if c]
    n_docs, n_terms = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(w for _, c in docs for w in c)
    out = Counter()
    for item, text in items:
        asked = Counter(term.findall((text or "").translate(UPPER)))
        scores = []
        for i, c in docs:
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms
            s = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 12 * m)) for w, r in asked.items() if w in c)
            if s:
                scores.append((-s, i is None, i or 0))
        out.update((item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k]))
    return out


@pytest.mark.parametrize("size", [(8192, 2_000_000), (40, 500)])
def test_ranked_search_against_all_scores(spark, monkeypatch, size):
    rng = np.random.default_rng(4)
    words = [f"w{k}" for k in range(400)] + ["Straße", "naïve", "中文"]
    pick = lambda n: " ".join(words[min(int(x), 402)] for x in rng.zipf(1.3, n))
    rows = [(k, pick(int(rng.integers(1, 200)))) for k in range(700)]
    rows += [(1000, None), (1001, ""), (1002, "?!"), (1003, rows[5][1]), (1004, rows[5][1]), (None, rows[6][1]), (9, rows[7][1]), (9, rows[7][1]), (1005, LONG + "w1 w2"), (1006, "w1\x00w2_w3`w4")]
    items = [(k, pick(25)) for k in range(12)] + [(50, None), (51, "..."), (52, "nowhere"), (53, "W1 w1 w1 lorem"), (53, "w1 w2"), (None, "w3 w399")]
    monkeypatch.setattr(lexical, "SEGMENT_DOCS", size[0])
    monkeypatch.setattr(lexical, "SEGMENT_TERMS", size[1])
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, term string, segment int").repartition(3)
    asked = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, row int")
    got = lexical.rank_documents(spark, df, asked).collect()
    assert Counter(tuple(r) for r in got) == ranked(rows, items)
    assert lexical.rank_documents(spark, df.where("1 = 0"), asked).count() == 0
    assert lexical.rank_documents(spark, df, asked.where("1 = 0")).count() == 0


def test_search_unpacks_few_blocks_of_common_terms(spark):
    """Block maxima and bounds reject documents before their blocks are unpacked."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    rng = np.random.default_rng(6)
    segment = lexical.Segment()
    for k in range(8000):
        segment.add(k, b"common " * int(rng.integers(1, 4)) + (b"rare" if k % 997 == 0 else b"") + b" other" * int(rng.integers(1, 50)))
    schema = to_arrow_schema(_parse_datatype_string(lexical.INDEX_SCHEMA))
    lengths, table = segment.lengths, pa.Table.from_batches(segment.rows("0", 8000, sum(segment.lengths), schema)).to_pylist()
    m = lexical.length_factor(np.array(lengths), 8000, sum(lengths))
    lists = {r["term"]: lexical.Postings(lexical.weight(r["df"], 8000) + 1, r["lasts"], r["impacts"], r["widths"], r["ends"], r["packed"]) for r in table[1:]}
    heap = lexical.search_segment([(1, lists[b"rare"]), (1, lists[b"common"])], table[0]["ids"], m, [], 2)  # two rare documents in the first window
    assert len(heap) == 2 and all(i % 997 == 0 for _, i in heap)
    assert len(lists[b"common"].cache) < 0.5 * len(lists[b"common"].lasts)


def test_search_matches_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    want = con.execute(queries.SQL["op13_search"]).fetchall()
    got = queries.op13_search(spark, SF).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_jaccard_join_links_null_and_repeated_ids(spark):
    words = [f"w{k}" for k in range(100)]
    text = lambda k, mark="n": " ".join([*words[:k], f"{mark}{k}", *words[k + 1 :]])
    other = " ".join(f"v{k}" for k in range(100))
    rows = [(None, text(3)), (None, text(50)), (3, text(90)), (3, other), (4, other + " more"), (5, None), (6, "")]
    got = chosen_path.jaccard_join(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == Counter([(None, 3, 2), (None, 3, 2), (3, 3, 2), (3, 3, 1), (4, 3, 1), (5, 5, 0), (6, 5, 0)])
    kept = chosen_path.keep_one_per_class(spark, spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, node string"))
    assert Counter(r.doc_id for r in kept.collect()) == Counter([3, 3, 5]) and kept.columns == ["doc_id", "text", "node"]


def test_large_buckets_are_split_by_size_before_bands(spark):
    rng = np.random.default_rng(11)
    sizes = [*range(1, 61), *rng.integers(300, 310, 40).tolist()]
    tokens = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in sizes]
    rows = [(k, len(t), bytearray(hyperminhash.registers(t).tobytes())) for k, t in enumerate(tokens)]
    sets = spark.createDataFrame(rows, "node long, size long, regs binary")
    bucket = sets.selectExpr("7L AS key", "node", "0 AS band", "0 AS level")
    for limit in (30, 1000):
        split = chosen_path.resample(bucket.unionByName(bucket.withColumn("key", F.lit(8).cast("long"))), sets, 0.8, limit)
        assert "MapInArrow" not in split._jdf.queryExecution().toString()  # the bands are made once, not at each reading
        got = split.collect()
        assert {r.level for r in got} == {1}
        together = {}
        for r in got:
            together.setdefault(r.key, set()).add(r.node)
        large = {r.node for r in got if r.band > 0}
        assert bool(large) == (limit == 30) and max(Counter(r.node for r in got).values()) <= 17 + 4
        assert not large & set(range(20))  # the small sets are few of their sizes
        met = {(a, b) for nodes in together.values() for a in nodes for b in nodes if a < b}
        for a in range(60):  # sets of sizes that let them be linked are together, to the very threshold
            for b in range(a + 1, 60):
                assert (a, b) in met or sizes[a] < 0.8 * sizes[b] or {a, b} <= large


def test_size_classes_and_pivots_make_no_further_rows(spark, monkeypatch):
    written, real = {}, chosen_path.materialise

    def materialise(spark, df, name, *args, **kwargs):
        written.setdefault(name, []).append((df._jdf.queryExecution().optimizedPlan().toString(), made := real(spark, df, name, *args, **kwargs)))
        return made

    monkeypatch.setattr(chosen_path, "materialise", materialise)
    monkeypatch.setattr(hyperminhash, "materialise", materialise)
    texts = [" ".join([f"common{j}" for j in range(30)] + [f"own{k}_{j}" for j in range(k % 23)]) for k in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in chosen_path.jaccard_join(spark, docs, limit=5).collect()}
    sets = sets_of(texts, 5)
    links = {a: {b for b in range(60) if sets[a] != sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])} for a in range(60)}
    assert {a: n for a, (_, n) in got.items()} == {a: len({sets[b] for b in links[a]}) for a in range(60)}
    assert any(large.count() for _, large in written["sizes"])
    for (_, sizes), (_, classes) in zip(written["sizes"], written["classes"][: len(written["sizes"])], strict=True):
        assert classes.count() == sizes.count()  # a set is counted in both of its size classes, but is one row
        assert sizes.count() == sizes.select("key", "node").distinct().count()
    assert all("min_by" not in plan for plan, _ in written["pairs"])  # the pivots come with the buckets


def test_whole_sets_come_in_short_batches_and_memos_of_others_go(spark, monkeypatch):
    setting, seen, real = "spark.sql.execution.arrow.maxRecordsPerBatch", {}, hyperminhash.materialise

    def materialise(spark, df, name, *args, **kwargs):
        seen.setdefault(name, set()).add(spark.conf.get(setting))
        return real(spark, df, name, *args, **kwargs)

    monkeypatch.setattr(hyperminhash, "materialise", materialise)
    before = spark.conf.get(setting)
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g h"), (3, "x y")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in hyperminhash.near_duplicates(spark, docs).collect()} == {1: 1, 2: 1, 3: 3}
    assert seen["given"] == seen["whole"] == seen["checked"] == {"500"} and spark.conf.get(setting) == before
    first = common.kept("a", object)
    assert common.kept("a", object) is first
    common.kept("b", object)
    assert common.kept("a", object) is not first
    common.drop_kept()
    assert not common._KEPT
