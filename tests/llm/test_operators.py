"""The training-data operators against brute force, on small tables with nulls, empty and long texts, ties and extra columns."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ratelake.llm import block_naming, byte_bpe, chosen_path, fingerprints, html_text, katz, packing, queries, sharding, tokenised, toxicity, url_filter
from ratelake.llm.common import crc_of_id, materialise, shuffles_dropped

SF = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor sit amet " * 3000
ROWS = [
    (1, "the  quick\tbrown fox jumps over the lazy dog", "en", "a", 1),
    (2, "the quick brown fox jumps over the lazy dog", None, None, None),
    (3, None, "en", "a", 0),
    (4, "", "en", "a", 0),
    (5, LONG, "de", "b", 9),
    (6, LONG, "de", "b", 9),
    (7, LONG + "tail", "de", "b", 9),
    (8, "Ünïcode 你好 <|endoftext|> don't stop!!! 12345", "fr", "c", 5),
    (8, "Ünïcode 你好 <|endoftext|> don't stop!!! 12345", "fr", "c", 5),
    (None, "a row without an id", "en", "a", 0),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, k, "x") for k, r in enumerate(ROWS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, h long, rank string").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("1 = 0")


def norm(t):
    import re

    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact_dedup(spark, docs, empty):
    got = block_naming.exact_duplicates(spark, docs, block_chars=16).collect()
    size = Counter(norm(r[1]) for r in ROWS)
    text = {hashlib.sha256(t.encode()).hexdigest(): t for t in size}
    assert len(got) == len(ROWS)
    for r in got:
        t = text[r.text_sha256]
        assert r.group_size == size[t]
        assert r.keep_id == min((x[0] for x in ROWS if norm(x[1]) == t and x[0] is not None), default=None)
    assert sum(r.kept for r in got) == len(size)
    assert block_naming.exact_duplicates(spark, empty).count() == 0
    kept = block_naming.drop_duplicates(spark, docs)
    assert kept.columns == docs.columns and kept.count() == len(size)


def test_exact_dedup_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.execute(queries.SQL["op9_exact_dedup"]).fetchall())
    assert sorted(tuple(r) for r in queries.op9_exact_dedup(spark, SF).collect()) == want


def test_packing(spark, docs, empty):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    rows = packing.pack(spark, tokenised.token_pieces(docs, path, 64, 0), 64).collect()
    want = Counter()
    for r in ROWS:
        ids = [*tok.encode(r[1] or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), 64)):
            part = np.array(ids[at : at + 64], dtype="<u4").tobytes()
            want[(r[0], k, at, len(part) // 4, zlib.crc32(part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) <= math.ceil(sum(r.length for r in rows) / 64) + 2
    assert packing.pack(spark, tokenised.token_pieces(empty, path), 2048).count() == 0


def test_packing_solves_the_configuration_lp():
    rng = np.random.default_rng(0)
    few = dict(zip(rng.choice(np.arange(100, 1500), 12, False).tolist(), rng.integers(100, 5000, 12).tolist(), strict=True))
    for pieces, optimum in (({1500: 1000, 128: 4000}, 1000), ({1000: 3000, 700: 3000, 400: 1000}, 3000), (few, None), ({k: 50 for k in range(1030, 2000, 10)}, 4850)):
        hist = np.zeros(2049, dtype=np.int64)
        for size, n in pieces.items():
            hist[size] = n
        configs, bound = packing.solve(hist)
        assert (sum(n * c for c, n in configs) == hist).all()
        assert all(c @ np.arange(2049) <= 2048 for c, _ in configs)
        used = sum(n for _, n in configs)
        assert bound - 1e-6 <= used <= max(math.ceil(bound - 1e-6) + 1, 1.001 * bound)
        assert optimum is None or used == optimum


def test_jaccard_join(spark, docs, empty):
    rng = np.random.default_rng(5)
    texts = {}
    for g in range(30):
        words = [f"w{x}" for x in rng.integers(0, 4000, 120)]
        for c in range(int(rng.integers(1, 9))):
            own = list(words)
            for _ in range(int(rng.integers(0, 4))):
                own[int(rng.integers(0, 120))] = f"n{g}{c}"
            texts[len(texts)] = " ".join(own)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sets = {i: frozenset(zip(*[t.split()[k:] for k in range(5)], strict=False)) for i, t in texts.items()}
    reps = {}
    for i, s in sets.items():
        reps.setdefault(s, i)
    link = {i: {j for s2, j in reps.items() if j != i and len(sets[i] & s2) >= 0.8 * len(sets[i] | s2)} for i in reps.values()}

    def least(i):
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        return min(seen)

    for limit in (1000, 3):  # 3: nearly every bucket is split, and compared in blocks of a few sets
        got = chosen_path.jaccard_join(spark, df, limit=limit, weight=100_000 if limit > 3 else 300)
        for r in got.collect():
            rep = reps[sets[r.doc_id]]
            assert (r.rep_id, r.class_id, r.n_links) == (rep, least(rep), len(link[rep]))
    got = chosen_path.jaccard_join(spark, docs).collect()
    assert len(got) == len(ROWS)
    assert {r.class_id for r in got if r.doc_id in (5, 6, 7)} == {5}
    assert chosen_path.jaccard_join(spark, empty).count() == 0


def test_byte_bpe(spark, docs, empty):
    import base64

    import public_tokenizers as P
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = byte_bpe.round_trip(docs, path, P.PATTERN).collect()
    want = Counter((r[0], tuple(own.encode_ordinary(r[1] or "")), (r[1] or "").encode()) for r in ROWS)
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in got) == want
    assert byte_bpe.round_trip(empty, path, P.PATTERN).count() == 0
    word = "aaaa" * 50 + "xyzzy" * 40
    assert byte_bpe.merge_bytes(word.encode(), ranks) == own.encode_ordinary(word)


def test_byte_bpe_merges_a_returning_piece_once(monkeypatch):
    import public_tokenizers as P
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = byte_bpe.read_ranks(path)
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    merged = Counter()
    plain = byte_bpe.merge_bytes
    monkeypatch.setattr(byte_bpe, "merge_bytes", lambda piece, ranks: merged.update([piece]) or plain(piece, ranks))
    encoder = byte_bpe.Encoder(path, P.PATTERN, limit=8)
    rng = np.random.default_rng(3)
    for _ in range(40):
        texts = ["qzxvkj", "".join(map(chr, rng.integers(97, 123, 9))) + " äöü" + "".join(map(chr, rng.integers(97, 100, 60))), None, ""]
        got = [np.frombuffer(ids, dtype="<u4").tolist() for ids in encoder.encode_batch(texts)]
        assert got == [own.encode_ordinary(t or "") for t in texts]
        assert len(encoder.memo) <= 8
    assert merged[b"qzxvkj"] == 1


def test_toxicity(spark):
    clean = [(k, f"plain words number {k % 7} about weather and music", 0) for k in range(300)]
    bad = [(1000 + k, f"you are an idiot and a moron said number {k % 7} zzqrabble{k % 5}", 1) for k in range(40)]
    df = spark.createDataFrame([(i, t, "x") for i, t, _ in clean + bad] + [(9000, None, "x"), (9001, "", "x")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, y) for i, _, y in clean + bad], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_documents(spark, df, labels).collect()}
    assert all(got[i]["__predicted"] == y for i, _, y in clean + bad)
    assert got[9000]["__score"] == got[9001]["__score"] < 0.3
    assert 0 <= min(r["__score"] for r in got.values()) and max(r["__score"] for r in got.values()) <= 1
    assert toxicity.score_documents(spark, df.where("1 = 0"), labels).count() == 0
    assert toxicity.score_documents(spark, df, labels.where("1 = 0")).count() == len(got)


def test_toxicity_stems_and_sample(spark):
    """Every stem that passes is kept (here 150), as plain Python finds them; an id's repeated rows count once."""
    made = [f"{a}{b}{c}o" for a in "bcdfg" for b in "aeiou" for c in "klmnrs"]
    rows = [(k, f"{made[k % 150]}x{k % 3} word{k % 40} said", 1) for k in range(900)]
    rows += [(1000 + k, f"word{k % 40} said {made[k % 5]}" if k < 20 else f"word{k % 40} said", 0) for k in range(900)]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(3, "zzz")] * 50, "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] * 2, "doc_id long, toxic int")
    sample = toxicity.label_sample(df, labels, 5000)
    got = sample.collect()
    kept = {i: (t, y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 4 != 2}
    assert Counter(tuple(r) for r in got) == Counter((i, t, y) for i, (t, y) in kept.items())
    assert toxicity.label_sample(df, labels, 7).count() == 7
    count = Counter()
    for t, y in kept.values():
        count.update((s, y) for s in {w[:k] for w in t.split() for k in (4, 5, 6) if len(w) >= k})
    good = {s for s, _ in count if count[s, 1] >= 4 and count[s, 1] >= 0.9 * (count[s, 1] + 3 * count[s, 0])}
    stems = toxicity.mine_stems(sample)
    assert set(stems) <= good and len(stems) > 64
    assert all(any(s.startswith(c) or c.startswith(s) for c in stems) for s in good)
    assert not any(a != b and a.startswith(b) for a in stems for b in stems)


def test_url_filter(spark):
    urls = [
        ("http://A.Example.com/en/1", "block", "example.com/en/"),
        ("https://www.example.com/en/x?q", "allow", "www.example.com/en/"),
        ("http://x.com/p", "allow", "com/"),
        ("http://x.com", None, None),
        ("http://b.net/es/1", "block", "net/es/"),
        ("http://q.net/fr/#t", "block", "net/fr/"),
        ("http://q.org/fr/", None, None),
        ("no scheme", None, None),
        (None, None, None),
        ("http://notexample.com/en/", "allow", "com/"),
    ] * 6
    df = spark.createDataFrame([(k, u, "h") for k, (u, _, _) in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: r for r in url_filter.judge(spark, df, queries.URL_RULES).collect()}
    assert len(got) == len(urls)
    for k, (u, verdict, rule) in enumerate(urls):
        assert got[k].rule == rule
        assert got[k].verdict == verdict if verdict else got[k].verdict in ("allow", "block")
    assert (got[0].host, got[0].path) == ("a.example.com", "/en/1") and (got[7].host, got[8].path) == ("", "")
    assert url_filter.judge(spark, df.where("1 = 0"), queries.URL_RULES).count() == 0


def test_url_filter_scores_and_threshold(spark):
    from pyspark.sql import functions as F

    urls = [f"http://site{k % 9}.{('com', 'net', 'org')[k % 3]}/{('en', 'es', 'fr')[k % 4 % 3]}/p{k * 7 % 31}" for k in range(90)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judge(spark, df, queries.URL_RULES).collect()}
    string = {k: r.host + r.path for k, r in got.items()}
    names = spark.createDataFrame(list(string.items()), "page_id long, s string")
    check = {r.page_id: r.c for r in names.select("page_id", (F.pmod(F.xxhash64("s"), F.lit(5)) == 0).alias("c")).collect()}
    ruled = {k: r.verdict if r.rule else None for k, r in got.items()}
    grams = {k: [m[i : i + 5] for i in range(len(m) - 4)] for k, m in ((k, "\x02" * 4 + t + "\x03") for k, t in string.items())}
    letters = len({g[-1] for x in grams.values() for g in x})
    counts = {kind: Counter(g[4 - n :] for k, x in grams.items() if ruled[k] == kind and not check[k] for g in x for n in range(5)) for kind in ("allow", "block")}

    def p(kind, gram):  # Witten and Bell, from the shortest context on
        value, n = 1 / letters, counts[kind]
        for size in range(5):
            after = [c for g, c in n.items() if len(g) == size + 1 and g[:-1] == gram[4 - size : 4]]
            if after:
                value = (n[gram[4 - size :]] + len(after) * value) / (sum(after) + len(after))
        return value

    ratio = {g: math.log(p("allow", g) / p("block", g)) for x in grams.values() for g in x}
    score = {k: sum(ratio[g] for g in x) / len(x) for k, x in grams.items()}
    assert all(math.isclose(got[k].score, score[k], rel_tol=1e-9, abs_tol=1e-9) for k in got)
    kinds = {kind: [math.floor((min(max(score[k], -4), 4) + 4) / 8 * 4000) for k in got if ruled[k] == kind and check[k]] for kind in ("allow", "block")}
    assert all(kinds.values())
    share = {c: sum(x >= c for x in kinds["allow"]) / len(kinds["allow"]) - sum(x >= c for x in kinds["block"]) / len(kinds["block"]) for c in sorted({*kinds["allow"], *kinds["block"]})}
    best = max(share.values())
    least = max(c for c, gain in share.items() if gain == best) / 4000 * 8 - 4 if best > 0 else 0.0
    free = [k for k in got if ruled[k] is None]
    assert free and all(got[k].verdict == ("allow" if score[k] >= least else "block") for k in free)


def test_katz(spark, docs, empty):
    out = crc_of_id() % 3 == 0
    got = katz.train_and_score(spark, docs, out).collect()
    train = [katz.words_of(r[1]) + [b""] for r in ROWS if r[0] is None or zlib.crc32(str(r[0]).encode()) % 3]
    uni = Counter(w for t in train for w in t)
    total, types = sum(uni.values()), len(uni)
    assert len(got) == len(ROWS) and {r.train_tokens for r in got} == {total}
    for r in got:
        texts = [katz.words_of(x[1]) + [b""] for x in ROWS if x[0] == r.doc_id]
        base = sum(math.log10((uni[w] + 0.1) / (total + 0.1 * (types + 1))) for w in texts[0])
        assert r.n_tokens == len(texts[0]) and r.n_known == sum(w in uni for w in texts[0])
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score <= 1e-9
    assert katz.train_and_score(spark, empty, out).count() == 0


def test_katz_keeps_every_word_as_a_history(spark):
    rng = np.random.default_rng(11)
    words = [f"w{k}" for k in range(40)]
    texts = {k: " ".join(words[min(int(x), 39)] for x in rng.zipf(1.4, 30)) + (" unseen again" if k % 3 == 0 else "") for k in range(60)}
    out = crc_of_id() % 3 == 0
    train = [katz.words_of(t) + [b""] for k, t in texts.items() if zlib.crc32(str(k).encode()) % 3]
    uni = Counter(w for t in train for w in t)
    pair = Counter(p for t in train for p in zip([None, *t[:-1]], t, strict=True))

    def discounted(counts):
        n = Counter(counts.values())
        total = 6 * n[6] / n[1] if n[1] else 1.0
        d = {}
        for r in range(1, 6):
            good = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
            d[r] = (good - total) / (1 - total) if total < 1 else 0.0
            d[r] = d[r] if 0 < d[r] < 1 else 1 - 0.5 / r
        return {k: c * d[c] if c <= 5 else c - 0.5 for k, c in counts.items()}

    held1, held2, total = discounted(uni), discounted(pair), sum(uni.values())
    p1 = {w: x / total for w, x in held1.items()}
    unknown = 1 - sum(p1.values())

    def p(w, v):
        after = {x: held2[v, x] for y, x in pair if y == v}
        n = sum(pair[v, x] for x in after)
        if w in after:
            return after[w] / n
        weight = (1 - sum(after.values()) / n) / (1 - sum(p1[x] for x in after)) if after else 1.0
        return weight * p1.get(w, unknown)

    for v in [None, *uni, b"never"]:
        assert math.isclose(sum(p(w, v) for w in [*uni, b"never"]), 1, rel_tol=1e-9)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    for hot in (4, 65_536):
        for r in katz.train_and_score(spark, df, out, hot).collect():
            t = katz.words_of(texts[r.doc_id]) + [b""]
            want = sum(math.log10(p(w, v)) for v, w in zip([None, *t[:-1]], t, strict=True))
            assert math.isclose(r.score, want, rel_tol=1e-9)


def test_katz_answers_only_pairs_that_no_training_text_has(spark):
    texts = [(k, f"a b c{k % 4} a b d{k % 3}") for k in range(24)] + [(100, "a b new a a b c1"), (101, None)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    none = np.zeros(0, dtype=np.int64)
    for out, postings in ((F.lit(False), 0), (F.col("doc_id") >= 100, 5)):  # b new, new a, a a, c1 end, start end
        held_out = F.coalesce(out, F.lit(False))
        table = katz.counted_pairs(katz.keyed_pairs(df, held_out, none, [0, 1, 2]), none, none, 3).where("shard >= 0").localCheckpoint()
        cut = katz.counted_pairs(katz.keyed_pairs(df, held_out, none, [0, 1, 2]), none, none, 3, room=2).where("shard >= 0").collect()
        whole = Counter((r.shard, *p) for r in table.collect() for p in zip(r.word_c, r.v, r.c, r.v_n, strict=True))
        assert len(cut) > table.count() and Counter((r.shard, *p) for r in cut for p in zip(r.word_c, r.v, r.c, r.v_n, strict=True)) == whole
        assert all(sum(r.v_n) == len(r.doc) for r in cut) and sum(len(r.doc) for r in cut) == sum(len(r.doc) for r in table.collect())
        model = katz.Model(100, 9, katz.discounts(np.zeros(7)), 0.1, katz.discounts(np.zeros(7)))
        new = katz.unseen_pairs(table).collect()
        answers = katz.history_table(table, model, [0, 1]).collect()
        assert sum(len(r.cnt) for r in new) == postings
        assert sorted((r.shard, v) for r in answers for v in r.history) == sorted({(r.shard, v) for r in new for v in r.v})


def test_katz_deals_frequent_words_as_short_codes(spark):
    texts = ["the cat the dog the cat", "the bird", None, "cat the the", "a the cat zebra the", "the"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    hashes = katz.Hashes()
    some = np.array(sorted(hashes[w] for w in (b"the", b"cat", b"")), dtype=np.int64)
    every = np.array(sorted(hashes[w] for t in texts for w in katz.words_of(t) + [b""]), dtype=np.int64)
    found = []
    for frequent in (some[:0], some, np.unique(every)):
        keyed = katz.keyed_pairs(df, F.col("doc_id") == 4, frequent, [0, 1]).localCheckpoint()
        for r in keyed.where("shard >= 0").collect():
            for codes, rare in ((r.w, r.w_rare), (r.v, r.v_rare)):
                assert len(rare) == codes.count(-1) and not set(rare) & set(frequent.tolist())  # -1: 65,535 in 16 bits
        counts = np.array([sum((katz.words_of(t) + [b""]).count(w) for t in texts if t != texts[4] for w in [b"the", b"cat", b"", b"dog", b"bird", b"a", b"zebra"] if hashes[w] == h) for h in frequent.tolist()], dtype=np.int64)
        rows = katz.counted_pairs(keyed, frequent, counts, 2).where("shard >= 0").collect()
        found.append(sorted(x for r in rows for x in zip(r.v, r.word_c, r.c, r.v_n, strict=True)))
    assert found[0] == found[1] == found[2]
    pairs = {(v, w) for t in texts for v, w in zip([katz.START, *katz.words_of(t)], katz.words_of(t) + [b""], strict=True)}
    assert len(found[0]) == len(pairs)


def test_katz_drops_the_shuffle_of_its_pairs(spark):
    def files():
        disk = spark._jsc.sc().env().blockManager().diskBlockManager()
        return {str(f) for f in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in str(f)}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = files(), spark.conf.get(name)
    with shuffles_dropped(spark):
        kept = materialise(spark, spark.range(1000).repartition(3, "id"), "dealt")
    assert not files() - before and kept.count() == 1000 and spark.conf.get(name) == setting


def test_html():
    page = (
        "<html><head><title>T</title><script>var a='</p>';</script></head><body><nav><a href=x>Home</a></nav>"
        "<div class='cookie-notice'>We use the cookies of this site for you and your friends on it</div>"
        "<article><h1>A title &amp; more</h1><p>The first  block is of\nthe article &eacute;.<br>Next<p>Short."
        "<aside>Read also this and that</aside><form><input>Name</form></article>"
        "<section id=comments><p>The comment of a reader that is long enough to be in it</p></section><footer>&copy; x</footer>"
    )
    assert html_text.main_text(page) == "A title & more\nThe first block is of the article é. Next\nShort."
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<nav>x</nav>") == ""


def test_html_wrappers_headers_and_short_blocks():
    good = "The first block of the article is long enough to be decided by itself and so it is."
    for wrapper in ("layout has-sidebar", "with-comments", "no-nav wide"):
        assert html_text.main_text(f"<div class='{wrapper}'><article><p>{good}</article></div>") == good
    assert html_text.main_text(f"<div class=sidebar><main><p>{good}</main></div>") == good
    assert html_text.main_text(f"<section id=comments><article><p>{good}</article></section>") == ""
    assert html_text.main_text(f"<article><div class='article-header'><h1>Title</h1></div><p>{good}</article>") == f"Title\n{good}"
    ad, aside = "<div class=advert>Buy now and save the most of all on it</div>", "<aside>More of this</aside>"
    assert html_text.main_text(f"<article>{ad}<p>Short one.<p>Another.{aside}</article>") == "Short one.\nAnother."
    assert html_text.main_text(f"<article><p>{good}{ad}<p>Short one.{aside}</article>") == f"{good}\nShort one."
    chinese = "这是一个没有文章元素的段落，它足够长，可以由它自己的长度来决定，因为停用词只有四种语言。"
    assert html_text.main_text(f"<body><div><p>{chinese}</p></div><nav>首页</nav></body>") == chinese
    assert html_text.main_text(f"<p>{good}</p><a href='x") == good


def test_html_broken_tags_take_linear_time():
    import time

    for broken in ("<a " + '"x" ' * 100_000, "<a " * 100_000, "<a " + "\"'" * 50_000, "<div " + "x" * 200_000 + ">", "<div " + "x " * 100_000 + "=>", "<!-" * 100_000, "<div class='" + "a-" * 100_000 + "'>"):
        began = time.time()
        html_text.main_text("<p>text</p>" + broken)
        assert time.time() - began < 5


def test_html_empty_and_odd_tables(spark):
    pages = spark.createDataFrame([(1, "u", None, "x"), (1, "u", "", "x"), (None, None, "<main>one</main>", "y")], "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in html_text.extract(pages).collect())
    assert got == [(0, "one", 3), (1, "", 0), (1, "", 0)]
    assert html_text.extract(pages.where("1 = 0")).count() == 0


def test_fingerprints(spark, docs, empty):
    got = fingerprints.fingerprint_documents(spark, docs).collect()
    assert len(got) == len(ROWS)
    prints = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints.setdefault(r.doc_id, r.fingerprint)
    assert prints[5] == prints[6] and prints[3] == prints[4] == "" and prints[1] != prints[2]
    row = next(r for r in got if r.doc_id == 2)
    assert row.edited == fingerprints.edited(ROWS[1][1], ROWS[0][1])
    assert fingerprints.fingerprint_documents(spark, empty).count() == 0


def test_sharding(spark, docs, empty):
    hot = spark.createDataFrame([(k, "the same text " * 20 if k % 3 == 0 else f"text {k} " * (k % 50 + 1), None) for k in range(3000)], "doc_id long, text string, shard int")
    rows = sharding.shard_documents(spark, hot, 24).collect()
    size, slots = Counter(), {}
    for r in rows:
        size[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(rows) == 3000 and max(size.values()) < 1.05 * min(size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    got = sharding.shard_documents(spark, docs, 24).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((x[0], len((x[1] or "").encode()) + 8) for x in ROWS)
    assert sharding.shard_documents(spark, empty, 24).count() == 0


def test_pipeline_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "ngram_jaccard", "best_fit_packing"]
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {"doc_id", "sequence_id", "offset", "length"} <= set(rows[0].asDict())


def test_pipeline_rows_after_toxicity_against_brute_force(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id: r.text for r in corpus_pipeline.toxicity_filter(spark, docs, SF).collect()}
    first = {}
    for i in sorted(kept):
        first.setdefault(norm(kept[i]), i)
    sets = {}
    for i in sorted(first.values()):
        w = (kept[i] or "").lower().split()
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))) if w else frozenset()
    stay, todo = [], sorted(sets)
    while todo:  # the least id of each component stays
        group, near = {todo[0]}, [todo[0]]
        while near:
            a = sets[near.pop()]
            more = {j for j in todo if j not in group and (a == sets[j] or len(a & sets[j]) >= 0.8 * len(a | sets[j]))}
            group |= more
            near += more
        stay.append(todo[0])
        todo = [j for j in todo if j not in group]
    tok = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))
    want = Counter()
    for i in stay:
        ids = [*tok.encode(kept[i] or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], dtype="<u4").tobytes()
            want[(i, k, at, len(part) // 4, zlib.crc32(part))] += 1
    rows = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in bins.values():
        ends = [0, *(a + n for a, n in sorted(items))]
        assert [a for a, _ in sorted(items)] == ends[:-1] and ends[-1] <= 2048


def test_words_of_letters_get_the_ids_of_the_whole_tokenizer():
    memo = tokenised.WordMemo(queries.tokenizer_path("word_bpe_49k.json"))
    assert memo.lean is not None
    words = ["house", "straße", "über", "Über", "ªº", "µ", "ÿ", "ñandú", "e\u0301t", "don't", "a1b2", "x", "ελλάδα", "中文", "zz.", "ab***", "é" * 300, "<|endoftext|>", "ǅa"]
    memo.limit = 5  # the second call begins a new generation
    for _ in range(2):
        code, other = memo.codes([words, ["house", "", "house."]])
        for w, ids in zip(words, code, strict=True):
            plain = memo.tokenizer.encode(w, add_special_tokens=False).ids
            assert np.frombuffer(ids, dtype="<u4").tolist() == plain, w
        assert other[0] == code[0] and other[1] == b"" and other[2].startswith(code[0])


def test_words_of_the_older_generation_are_taken_as_they_are():
    memo = tokenised.WordMemo(queries.tokenizer_path("word_bpe_49k.json"))
    words = ["house", "house.", "a1b2", "", "don't"]
    first = memo.codes([words])
    memo.limit = 1  # the next call begins a new generation
    assert memo.codes([words, [], ["new."]])[:2] == [first[0], []]
    assert all(memo.young[w] is memo.old[w] for w in words if w)  # not put together again from stem and symbols


def test_each_word_of_a_batch_is_looked_up_once():
    memo = tokenised.WordMemo(queries.tokenizer_path("word_bpe_49k.json"))
    asked, codes = [], memo.codes
    memo.codes = lambda texts: (asked.extend(w for words in texts for w in words), codes(texts))[1]
    texts = ["The house, the HOUSE.", "", " \t two  spaces\n", "Éé ελλάδα Ελλάδα the", "don't <|ENDoftext|> the", "x" * 5000, "the 中文 a1b2 the"]
    got = tokenised._coded([tokenised.spaced(t, memo.special) for t in texts], memo)
    assert len(asked) == len(set(asked)) and "the" in asked  # five times in the texts
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == memo.tokenizer.encode(text, add_special_tokens=False).ids, text
    assert tokenised._coded(["", ""], memo) == [b"", b""]


def test_lm_score_writes_common_words_only_and_drops_its_shuffles(spark, monkeypatch):
    setting, seen, real = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", {}, katz.materialise

    def materialise(spark, df, name, *args, **kwargs):
        seen[name] = (spark.conf.get(setting), made := real(spark, df, name, *args, **kwargs))
        return made

    monkeypatch.setattr(katz, "materialise", materialise)
    docs = spark.createDataFrame([(k, "often " * 3 + f"rare{k}") for k in range(9)] + [(9, None)], "doc_id long, text string")
    got = katz.train_and_score(spark, docs, F.col("doc_id") == 8).collect()
    assert {dropped for dropped, _ in seen.values()} == {"true"}
    assert sorted(r.c for r in seen["unigrams"][1].collect()) == [9, 24]  # the end mark and "often"; single words are only counted
    n, v = 9 + 24 + 8, 10
    base = lambda *counts: sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in counts)
    assert {r.doc_id: round(r.base_score, 9) for r in got} == {k: round(x, 9) for k, x in {**dict.fromkeys(range(8), base(24, 24, 24, 1, 9)), 8: base(24, 24, 24, 0, 9), 9: base(9)}.items()}
    assert {r.train_tokens for r in got} == {n}
