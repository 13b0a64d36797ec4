import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from kbspark.llm import components, html_extract, jaccard_join, line_dedup, lm_scoring, mixing, packing, quality, quality_rules, queries, topk_search, toxicity, words

from . import brute

SF = "/root/testdata/sf0.001"
BASE = " ".join(f"w{i}" for i in range(60))
TEXTS = [
    (1, "a b c d e f g h"),
    (2, "A  b\tc d e F g h"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "one two"),
    (7, "ONE\ntwo"),
    (8, BASE),
    (9, BASE + " more"),
    (10, "x " + BASE + " more"),
    (11, "word " * 5000),
    (12, " ".join(str(i) for i in range(20000))),
    (13, " ".join(str(i) for i in range(3, 20010))),
    (14, "Ünïcode ÄB ß 漢字 　 x y z q"),
    (15, "Ünïcode Äb ß 漢字 　 x y z q"),
    (11, "word " * 5000),
]
DOCS = "doc_id long, text string"


def docs_frame(spark, rows=TEXTS):
    return spark.createDataFrame(rows, DOCS)


def sf(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


# 1


def topk_brute(rows, k=20):
    ok = [(i, np.floor(64 * np.array(v, float))) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % 20 == 0:
            s = sorted((-int(sum(x * y for x, y in zip(a, b, strict=False))), i) for i, b in ok if i != q)[:k]
            out += [(q, r + 1, i, -v) for r, (v, i) in enumerate(s)]
    return sorted(out)


def test_topk_low_scores(spark):
    """However low its score, a candidate isn't taken for the query's own row; components beyond 64 bits are the nearest."""
    rows = [(0, [60000.0, 60000.0]), (1, [-2e5, -2e5]), (2, [1.0, 1.0]), (3, [1e300, 0.0])]
    v = topk_search.integer_terms(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding", 64)
    got = [(r.vec_id, r.score) for r in topk_search.top_k(v.where("id in (0, 1, 2)").where("id = 0"), v.where("id < 3"), 20).collect()]
    assert got == [(2, 2 * 60000 * 64 * 64), (1, -2 * 60000 * 200000 * 64 * 64)]
    assert v.where("id = 3").first().terms == [(1 << 63) - 1, 0]
    nulls = spark.createDataFrame([(None, [1.0]), (20, [1.0])], "vec_id long, embedding array<double>")
    v = topk_search.integer_terms(nulls, "vec_id", "embedding", 64)
    assert v.count() == 1 and topk_search.top_k(v, v).count() == 0


@pytest.mark.parametrize("block", [(3, 5), (1024, 16384)])
def test_topk_edges(spark, block):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(60)]
    rows += [(100 + i, [1.0, 0.0, 0.0, 0.0]) for i in range(30)]  # ties
    rows += [(400, [1.0, 2.0, 3.0, 4.0]), (400, [2.0, 2.0, 3.0, 4.0])]  # an id twice
    rows += [(200, None), (220, [1.0, None, 2.0, 3.0]), (240, [float("nan")] * 4), (260, [float("inf"), 0.0, 0.0, 0.0]), (280, []), (300, [1.0, 2.0]), (320, [300000.0, -200000.0, 1.0, 5.0])]
    v = topk_search.integer_terms(spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as block", "3 as slot"), "vec_id", "embedding", 64)
    got = topk_search.top_k(v.where("id % 20 = 0"), v, 20, *block).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == topk_brute(rows)


def test_topk_empty(spark):
    v = topk_search.integer_terms(spark.createDataFrame([], "vec_id long, embedding array<float>"), "vec_id", "embedding", 64)
    assert topk_search.top_k(v, v).count() == 0


# 2


def check_packing(rows, docs, capacity=2048):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_path())
    want = Counter()
    for i, text in docs:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        for p, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s : s + capacity]
            want[(i, p, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for x in bins.values():
        x.sort()
        assert [o for o, _ in x] == [sum(n for _, n in x[:k]) for k in range(len(x))]
        assert sum(n for _, n in x) <= capacity
    return len(bins)


def test_packing(spark):
    n = check_packing(packing.best_fit_pack(docs_frame(spark), packing.tokenizer_path()).collect(), TEXTS)
    assert n >= 1
    docs = [(r.doc_id, r.text) for r in sf(spark, "documents").collect()]
    rows = queries.packed(spark, SF).collect()
    n = check_packing(rows, docs)
    assert n <= packing.lower_bound(np.array([r.length for r in rows]), 2048) + 1
    assert packing.best_fit_pack(docs_frame(spark, []), packing.tokenizer_path()).count() == 0
    odd = [(None, "a b"), (None, "a b"), (1, "x " * 5000), (1, None)]
    check_packing(packing.best_fit_pack(docs_frame(spark, odd).selectExpr("*", "1 as piece", "2 as length"), packing.tokenizer_path()).collect(), odd)


def test_packing_exchange(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 20)
    docs = [(r.doc_id, r.text) for r in sf(spark, "documents").collect()]
    check_packing(queries.packed(spark, SF).collect(), docs)


def test_bounds():
    rng = np.random.default_rng(3)
    for _ in range(200):
        x = rng.integers(1, 40, rng.integers(1, 30))
        bins = packing.best_fit_decreasing(x, 40)
        assert np.bincount(bins, x).max() <= 40
        assert packing.lower_bound(x, 40) <= bins.max() + 1
    # three of 21 can't share bins of 40: the sum alone says two
    assert packing.lower_bound(np.array([21, 21, 21]), 40) == 3


# 3, 4


def test_toxicity(spark):
    docs, labels = sf(spark, "documents"), sf(spark, "labels")
    got = queries.toxic(spark, SF).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    m = toxicity.trained(docs, labels.limit(0))
    assert toxicity.scored(docs_frame(spark), m).where("score between 0 and 1").count() == len(TEXTS)


def test_toxicity_edges(spark):
    docs = docs_frame(spark, [(None, "x"), (1, "a b"), (1, "a b"), (2, ""), (3, None), (4, "word " * 50000)]).selectExpr("*", "1 as score", "2 as label")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (4, 1), (4, 1), (None, 1)], "doc_id long, toxic int")
    for rows in (labels, labels.limit(0)):
        got = toxicity.scored(docs, toxicity.trained(docs, rows)).collect()
        assert Counter(r.doc_id for r in got) == Counter([None, 1, 1, 2, 3, 4]) and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id == 1}) == 1
    assert toxicity.labelled(docs, labels, "toxic", 5) == ([("word " * 50000, 1)], (0, 1))
    assert toxicity.labelled(docs, labels, "toxic", 5, 10)[0] == []
    assert toxicity.scored(docs.limit(0), toxicity.trained(docs, labels)).count() == 0


def test_stored_tables(spark):
    """Nothing is left in the shared folder once the results have been read."""
    import os

    from kbspark.llm import common

    common.forget_all(spark)
    before = os.listdir(common.shared_dir(spark))  # Spark's own checkpoint folder
    for query in (queries.lines, queries.mixed, queries.topk, queries.ruled):
        query(spark, SF).count()
        common.forget_all(spark)
        assert os.listdir(common.shared_dir(spark)) == before


def test_stored_tables_read(spark):
    """A stored table stays as long as anything can read it."""
    import os

    from kbspark.llm import common

    kept = common.stored(spark.range(10), "kept")
    path, some = kept._stored_at, kept.where("id > 3").groupBy().count()
    del kept
    common.forget_unread(spark)
    assert os.path.exists(path) and some.first()["count"] == 6
    del some
    common.forget_unread(spark)
    assert not os.path.exists(path)


def test_stored_files(spark):
    """A stored table has no checksum files, for each of which an executor's JVM would start a process."""
    import os

    from kbspark.llm import common

    kept = common.stored(spark.range(10).repartition(3), "kept")
    names = [n for n in os.listdir(kept._stored_at.removeprefix("file://")) if n != "_SUCCESS"]
    assert len(names) == 3 and all(n.startswith("part-") for n in names), names
    assert sorted(x.id for x in kept.collect()) == list(range(10))
    common.forget(spark, kept)


def test_toxicity_every_window():
    """Windows without a key are compressed too."""
    texts = [" ".join(f"word{(i * 7 + k * 13) % 97}" for k in range(60)) for i in range(40)]
    texts = [t + " vilescum" if i % 4 == 3 else t for i, t in enumerate(texts)]
    m = toxicity.fit(texts, [int("vilescum" in t) for t in texts])
    ordinary, toxic = toxicity.compressors(m)
    text = " ".join(f"other{k}" for k in range(100))
    d, hits = toxicity.distances(text, m, lambda s: b"x" * 9 + s, lambda s: s)
    assert hits == 0 and d.tolist() == [9.0] * 5
    assert len(toxicity.distances(text, m, ordinary, toxic)[0]) == 5


def test_toxicity_words(monkeypatch):
    """A word that comes again in a text is looked at once; the hits are those of every word."""
    looked = []
    real = toxicity.keys
    monkeypatch.setattr(toxicity, "keys", lambda w: looked.extend(w) or real(w))
    model = toxicity.Model(b"x" * 64, b"y" * 64, [1, 2, 3, 4], [], [], [], frozenset(["bad", "wors"]))
    for text, hits in (("a b (bad) " * 320, 40), ("a b good " * 320, 0), ("unbad badly " * 24 + "a " * 24 + "worst!", 1), ("", 0)):
        looked.clear()
        assert toxicity.distances(text, model, bytes, bytes)[1] == hits
        assert sorted(looked) == sorted(set(text.split()))
    odd = "".join(chr(c) for c in range(1, 0x250)) + " Bäd\x1cx BAD\u3000y\u2028z \x0bbad\x0c bad\x85 \xa0bad ÿbad\r\nbad"
    cut = []
    toxicity.distances(odd, model, lambda s: cut.append(s) or s, bytes)
    assert cut == toxicity.windows(toxicity._words(odd))


def test_toxicity_dictionaries():
    """Both dictionaries hold passages of their texts, also words next to a key; thresholds follow the calibration rows."""
    rng = np.random.default_rng(4)
    plain = [" ".join(f"word{k}" for k in rng.integers(0, 300, 60)) for _ in range(80)]
    texts = [t + " vilescum beside the plainest phrase" if i % 4 > 1 else t for i, t in enumerate(plain)]
    m = toxicity.fit(texts, [int("vilescum" in t) for t in texts])
    assert b"vilescum beside the plainest" in m.toxic and b"vilescum" not in m.ordinary
    ordinary, toxic = toxicity.compressors(m)
    clean = np.concatenate([toxicity.distances(t, m, ordinary, toxic)[0] for i, t in enumerate(texts) if i % 2 and i % 4 < 2])
    for t, share in zip(m.thresholds, toxicity.SHARES, strict=True):
        assert t == 1 or (clean >= t).mean() <= share <= (clean >= t - 1).mean()


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    rows = [(r.score, labels[r.doc_id], r.predicted) for r in queries.toxic(spark, d).where("held_out").collect() if r.doc_id in labels]
    pos, neg = [s for s, k, _ in rows if k], [s for s, k, _ in rows if not k]
    auc = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    hit = sum(p for _, k, p in rows if k)
    assert auc > 0.9 and hit / len(pos) > 0.7 and hit / max(1, sum(p for _, _, p in rows)) > 0.8


def test_quality_held_out(spark):
    d = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    rows = [(r.kept, labels[r.doc_id]) for r in queries.good(spark, d).where("held_out").collect() if r.doc_id in labels]
    assert sum(a == b for a, b in rows) / len(rows) > 0.95


def test_quality_edges(spark):
    rows = [(i, t, None if i % 2 else "de", None, None) for i, t in TEXTS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, None), (11, 0)], "doc_id long, quality int")
    assert quality.quality_scores(docs, labels).where("score between 0 and 1").count() == len(TEXTS)
    assert quality.good_documents(docs.withColumn("label", docs.doc_id), labels.limit(0)).count() == len(TEXTS)
    assert quality.good_documents(docs.limit(0), labels).count() == 0


def test_shares(spark):
    """A bounded sample of the labels, half of each kind, gives scores of the labels' true shares."""
    rng = np.random.default_rng(6)
    y = (np.arange(600) % 10 == 0).astype(int)
    x = rng.normal(y, 1.0)
    pick = np.concatenate([np.flatnonzero(y == 0)[:60], np.flatnonzero(y == 1)])
    for logistic in (toxicity._logistic, quality._logistic):
        design = np.column_stack([x, np.ones(len(x))]) if logistic is toxicity._logistic else x[:, None]
        w = logistic(design[pick], y[pick], weight=toxicity.shared(y[pick], (540, 60)))
        p = 1 / (1 + np.exp(-(w[0] * x + w[1])))
        assert abs(p.mean() - 0.1) < 0.03
    docs, labels = sf(spark, "documents"), sf(spark, "labels")
    share = quality.fit(quality.stored(quality.features(docs), "features"), labels, 5).share
    own = [r.label for r in quality.own_labels(labels).collect()]
    assert abs(share - np.mean(own)) < 1e-9 and abs(share - 0.5) > 0.1
    rows, totals = toxicity.labelled(docs, labels, "toxic", 2)
    assert len(rows) <= 4 < sum(totals)


# 5


def test_mixing(spark):
    rows = [(r.doc_id, r.text, r.source) for r in sf(spark, "documents").collect()]
    rows += [(1000, None, None), (1001, "a b c", None), (1002, " ", "empty"), (5, rows[0][1], "src0"), (5, rows[0][1], "src0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len(brute.words(t))) for i, t, _ in rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(brute.words(t))
    for s in {s for _, _, s in rows}:
        sizes[s] += 0
    want = brute.targets(sizes)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s, x in want.items():
        assert abs(taken[s] - x) <= 12, (s, x, taken[s])
    again = mixing.mix(docs.repartition(3)).collect()
    assert Counter((r.doc_id, r.taken) for r in got) == Counter((r.doc_id, r.taken) for r in again)
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mix(docs.where("size(split(trim(text), ' ')) < 1 or text is null")).count() == 1


def test_mixing_files(spark, monkeypatch):
    """However many partitions the documents and shuffles have, sizes, slots and the mix have a task for each core or for so many rows; the rows are the same."""
    docs = sf(spark, "documents").repartition(40).cache()
    cores, files, real = spark.sparkContext.defaultParallelism, {}, mixing.stored

    def told(df, name):
        files[name] = df.rdd.getNumPartitions()
        return real(df, name)

    monkeypatch.setattr(mixing, "stored", told)
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    plain = lambda df: sorted((r.doc_id, r.size, r.source_size, r.target, r.taken, r.first_slot) for r in df.collect())
    want = plain(mixing.mix(docs))
    try:
        for n, x in zip(names, ("40", "false"), strict=True):
            spark.conf.set(n, x)
        got = mixing.mix(docs)
        assert files["sized"] <= cores and files["slots"] <= cores and got.rdd.getNumPartitions() <= cores
        assert plain(got) == want
    finally:
        for n, x in zip(names, before, strict=True):
            spark.conf.set(n, x)
        docs.unpersist()


# 6


@pytest.mark.parametrize("often", [0, 2, 20])
def test_jaccard_edges(spark, monkeypatch, often):
    monkeypatch.setattr(jaccard_join, "FREQUENT_FROM", often)
    rng = np.random.default_rng(5)
    rows, base = list(TEXTS[:-1]), [f"t{i}" for i in range(60)]
    for k in range(60):  # a chain of near copies, and texts that share a passage only
        x = list(base)
        for j in rng.integers(0, 60, rng.integers(0, 3)):
            x[j] = f"n{rng.integers(1000)}"
        rows.append((100 + k, " ".join(x)))
        rows.append((200 + k, " ".join(base[:20] + [f"u{k}_{j}" for j in range(30)])))
    for k in (0, 1):  # an id with two texts, each with a near copy
        rows += [(300, " ".join(f"v{k}_{i}" for i in range(40))), (301 + k, " ".join(f"v{k}_{i}" for i in range(42)))]
    got = jaccard_join.jaccard_join(docs_frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute.components(rows)


def test_jaccard_frequent_keys(spark, monkeypatch):
    """Unlike texts that share hundreds of pairs of frequent shingles meet a few times, not once for each; those that link do."""
    common = [f"c{i}" for i in range(400)]
    rows = [(k, " ".join(common + [f"o{k}x{i}" for i in range(84)])) for k in range(40)]
    rows += [(100 + k, rows[k][1] + " more") for k in range(0, 40, 7)]
    met = []
    real = jaccard_join._across
    monkeypatch.setattr(jaccard_join, "_across", lambda *args: (out := real(*args), met.append(out.count()))[0])
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(docs_frame(spark, rows)).collect())
    assert got == sorted(brute.components(rows))
    assert 0 < met[0] < 10 * len(rows) ** 2


def test_jaccard_workers(spark, monkeypatch):
    """No task of the join has two Python workers: texts are sifted where their sets are made."""
    plans, real = {}, jaccard_join.stored
    told = lambda df, name: (plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString()), real(df, name))[1]
    monkeypatch.setattr(jaccard_join, "stored", told)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(docs_frame(spark, TEXTS[:-1])).collect())
    assert got == sorted(brute.components(TEXTS[:-1]))
    assert {"nodes", "live", "sets", "links"} <= set(plans) and plans["sets"].count("MapInArrow") == 1
    for plan in plans.values():
        for part in plan.split("Exchange"):
            assert part.count("MapInArrow") <= 1


def test_jaccard_table(spark):
    docs = [(r.doc_id, r.text) for r in sf(spark, "documents").collect()]
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in queries.joined(spark, SF).collect()) == brute.components(docs)
    assert jaccard_join.jaccard_join(docs_frame(spark, [])).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (95, 100), (7, 7)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90}


# 7


def test_rules(spark):
    rows = [*TEXTS, (20, "a b c a b c a b c\nx\nx \nx"), (21, "l1 #*\n\nl1 #*\n l1 #*")]
    got = quality_rules.counted(docs_frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == Counter((i, *brute.rule_counts(t)) for i, t in rows)
    docs = {r.doc_id: r.text for r in sf(spark, "documents").collect()}
    for r in queries.ruled(spark, SF).collect():
        c = brute.rule_counts(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == c
        assert r.base_failed == (c[0] < 50 or 100 * c[4] > 50 * c[0]) and not (r.base_failed and r.kept)
    assert quality_rules.quality_rules(docs_frame(spark, [])).count() == 0


def test_rules_decide(spark):
    """Of rows that pass the base rule, the posterior drops those that several rules are against, and not those that one is."""
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefghij"), rng.integers(3, 8)))
    rows = []
    for i in range(300):
        lines = [" ".join(word() for _ in range(14)).capitalize() + "." for _ in range(8)]
        if i % 6 == 0:  # marks everywhere, lines that don't end
            lines = [" ".join(w + "%%%" for w in x[:-1].split()) for x in lines]
        elif i % 6 == 1:  # one odd line ending too many
            lines = [x[:-1] for x in lines]
        rows.append((i, "\n".join(lines)))
    names = "doc_id", "text"
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, pattern string, passed int")
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}
    assert docs.columns[:2] == list(names) and not any(r.base_failed for r in got.values())
    assert [i for i in range(300) if not got[i].kept] == list(range(0, 300, 6))
    short = quality_rules.quality_rules(spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], DOCS)).collect()
    assert len(short) == 3 and not any(r.kept for r in short)


def test_rules_table_decides(spark):
    passing = queries.ruled(spark, SF).where("not base_failed")
    assert passing.where("not kept").count() > 0 and passing.where("kept").count() > passing.where("not kept").count()


def test_rules_estimate():
    rng = np.random.default_rng(2)
    good = rng.random(4000) < 0.8
    v = np.stack([np.where(rng.random(4000) < 0.2, 1, np.where(rng.random(4000) < a, good, ~good) * 2) for a in (0.95, 0.9, 0.85, 0.7, 0.6)], 1).astype(int)
    p, c = np.unique(v, axis=0, return_counts=True)
    rates, share = quality_rules.estimate(p, c.astype(float))
    assert abs(share - 0.8) < 0.05
    assert (((quality_rules.posterior(v, rates, share) >= 0.5) == good).mean()) > 0.93


# 8


def lm_frame(spark, docs):
    return docs_frame(spark, docs).selectExpr("*", "1 as bucket", "2 as chunk", "3 as w")


@pytest.mark.parametrize(("least", "frequent"), [(5, 1 << 16), (5, 50), (10**9, 1 << 16)])
def test_lm(spark, monkeypatch, least, frequent):
    """Counts and base scores by brute force, and the model's scores by its formulas, in plain Python, from the seating it ended with."""
    monkeypatch.setattr(lm_scoring, "FREQUENT", frequent)
    docs = [(r.doc_id, r.text) for r in sf(spark, "documents").limit(60).collect()] + [(5001, None), (5002, ""), (5003, "zzzz unseen words the"), (5004, "the " * 3000)]
    frame = lm_frame(spark, docs)
    model = lm_scoring.train(frame.where(queries.crc_mod("doc_id", 10) != 0), least)
    rows = lm_scoring.score(frame, model).collect()
    got = {r.doc_id: r for r in rows}
    want = brute.base_scores(docs)
    assert len(rows) == len(docs) and got.keys() == want.keys()
    p = brute.PitmanYor(model)
    assert (len(p.contexts) > 0) == (least < 10**9)
    for i, text in docs:
        r, (n, k, total, s) = got[i], want[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, k, total)
        assert abs(r.base_score - s) < 1e-6 * max(1, abs(s))
        assert abs(r.score - p.score(text)) < 1e-6 * max(1, abs(r.score))
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    for code in {0, len(p.contexts) // 2, len(p.contexts) + 3, len(p.contexts) + lm_scoring.START}:
        assert abs(sum(p.probability(w, code) for w in p.total) + p.probability(1, code) - 1) < 1e-9


def test_lm_edges(spark):
    docs = [(1, "a b"), (1, "a b"), (None, "a b"), (2, None)]
    for train in (lm_frame(spark, docs), lm_frame(spark, docs).limit(0)):
        model = lm_scoring.train(train, 2)
        rows = lm_scoring.score(lm_frame(spark, docs), model).collect()
        assert Counter((r.doc_id, r.n_tokens) for r in rows) == Counter([(1, 3), (1, 3), (None, 3), (2, 1)])
        assert len({r.score for r in rows if r.n_tokens == 3}) == 1 and all(r.score <= 0 for r in rows)
        assert lm_scoring.score(lm_frame(spark, docs).limit(0), model).count() == 0


def test_lm_word_contexts(spark):
    """Words of one class as contexts: each keeps what follows it."""
    model = lm_scoring.train(docs_frame(spark, [(i, "zasing bede" if i % 2 else "zosing gode") for i in range(40)]), 5)
    texts = [(0, "zasing bede"), (1, "zasing gode"), (2, "zosing gode"), (3, "zosing bede")]
    got = {r.doc_id: r.score for r in lm_scoring.score(docs_frame(spark, texts), model).collect()}
    assert got[0] > got[1] + 0.5 and got[2] > got[3] + 0.5


def test_lm_slices(spark):
    """However few contexts are held at a time, all of them have their restaurants, and the scores are the same."""
    frame = docs_frame(spark, [(r.doc_id, r.text) for r in sf(spark, "documents").limit(40).collect()])
    whole, sliced = (lm_scoring.train(frame, 5, most) for most in (1 << 20, 16))
    assert len(whole.listed.value[0]) > 64 and len(sliced.listed.words.parts) > 4
    assert all((x == y).all() for x, y in zip(whole.listed.value, sliced.listed.value, strict=True))
    want, got = ({r.doc_id: r.score for r in lm_scoring.score(frame, m).collect()} for m in (whole, sliced))
    p = brute.PitmanYor(sliced)
    assert got.keys() == want.keys() and all(abs(got[i] - x) < 1e-9 * abs(x) for i, x in want.items())
    for r in frame.limit(5).collect():
        assert abs(got[r.doc_id] - p.score(r.text)) < 1e-6 * abs(got[r.doc_id])


def test_lm_seats():
    """Blocks of customers give as many tables as customers one by one."""
    rng = np.random.default_rng(1)
    n, p, d = 3000, 0.02, 0.6
    one = []
    for _ in range(200):
        t = 1
        for i in range(1, n):
            fresh = (1 + d * (50 + t)) * p
            t += rng.random() < fresh / (fresh + i - d * t)
        one.append(t)
    many = lm_scoring.seat(np.full(2000, n), np.full(2000, 50.0), np.full(2000, p), d, np.random.default_rng(2))
    assert abs(many.mean() - np.mean(one)) < 0.05 * np.mean(one) and 0.7 < many.std() / np.std(one) < 1.4
    assert (lm_scoring.seat(np.array([0, 1]), np.zeros(2), np.full(2, 0.5), d, rng) == [0, 1]).all()


def test_lm_held_out(spark):
    """On documents it hasn't learnt from, the model beats the base score."""
    rows = queries.language_model(spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r.score for r in rows) > 0.98 * sum(r.base_score for r in rows)


# 9


def test_lines(spark):
    rows = [(i, t) for i, t in TEXTS[:-1]]
    rows += [(30, "a\nb\nc\nd"), (31, "x\n a \nb\n\nc\r\ny"), (32, "q\nq\nq\nq\nq\nend"), (33, "b\n c\nd"), (34, "m\nn"), (35, "m\nn\n"), (36, "m"), (37, "a\n\nb\nc\nd\n\nz")]
    names = ("covered", "_covered", "row_hash", "h", "first", "at", "_id", "_row", "_lines_removed")
    got = line_dedup.line_dedup(docs_frame(spark, rows).selectExpr("*", *[f"1 as `{n}`" for n in names]))
    assert got.columns == ["doc_id", "text", *names]
    want = brute.line_dedup(rows)
    got = got.collect()
    assert {r.doc_id: (r.text, r._lines_removed) for r in got} == want and all(r.covered == 1 for r in got)
    twice = [(None, "a\nb\nc"), (5, "a\nb\nc\nd"), (5, "a\nb\nc\nd"), (5, "x\na\nb\nc"), (None, None)]
    got = line_dedup.line_dedup(docs_frame(spark, twice)).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter([(None, "a\nb\nc"), (5, "d"), (5, "d"), (5, "x"), (None, None)])
    assert line_dedup.line_dedup(docs_frame(spark, [])).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = con.execute(queries.ORACLES[name]).fetchall()
    names = [d[0] for d in con.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert Counter(tuple(r[c] for c in cols) for r in df.collect()) == Counter(tuple(r[k] for k in at) for r in want)


# 10


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<script>x()</script>", ""),
        ("just text &amp; more", "just text & more"),
        ("<body><nav><a href=x>Menu</a></nav><article><h1>Title</h1><p><b>First  one,<br>goes on.<p>Second&nbsp;&eacute;.</p></article><footer>foot</footer>", "Title\nFirst one, goes on.\nSecond é."),
        ("<body><div class='ad'>Buy this, now, please, or else, it is gone</div><div id=content><p>Some prose, with commas, and such.</p><form><p>Name, please</p></form><p>End.</p></div><div class='comments'><p>I, for one, like it, a lot, really.</p></div><aside><p>See also, this, that</p></aside></body>", "Some prose, with commas, and such.\nEnd."),
        ("<article><p>A</p><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></article>", "A\none\ntwo\nx\ny"),
        ("<article><script>var t='</p>';</script><p>Text<!-- <p>no</p> --> here</p>", "Text here"),
        ("<p>Some prose, it is, as it goes.</p><div class='comment-text'><p>I, for one, like it, a lot.</p></div><div class=share-content>Share, this, please, now</div>", "Some prose, it is, as it goes."),
        ("<div class='page with-sidebar'><p>Some prose, it is.</p></div>", "Some prose, it is."),
        ("<div class=post><div class='post-header'><h1>Title</h1></div><p>Prose, as it is, goes on.</p></div><article class=comment><p>Me, I, like, it, much</p></article>", "Title\nProse, as it is, goes on."),
        ("<p>a\u200bb\u00a0 \u2003c", "a\u200bb c"),
        ("<div><p>one, two</p></div><div><p>one, two</p></div>", "one, two\none, two"),
    ],
)
def test_extract(page, text):
    assert html_extract.extract(page) == text


def test_extract_deep():
    """Time follows the length, however deep elements are nested."""
    import time

    t = time.time()
    for page in ("<div>" * 20000 + "x, y, z", "<div>x, y" * 8000, "<b>" * 8000 + "<div>q</div>" * 8000, "<div>" * 8000 + "</section>" * 8000 + "t", "<template>" * 20000 + "x"):
        html_extract.extract(page)
    assert time.time() - t < 20


def test_extract_table(spark):
    """Every page's text is its article's blocks, as a reading with another parser gives them."""
    pages = {r.page_id: r.html for r in sf(spark, "pages").collect()}
    got = queries.extracted(spark, SF).collect()
    assert len(got) == len(pages) and all(r.n_chars == len(r.text) for r in got)
    same = sum(r.text == brute.article(pages[r.page_id]) for r in got)
    assert same == len(got), (same, len(got))
    own = spark.createDataFrame([(1, "u", None, 2), (1, "u", "<p>x</p>", 3), (None, None, "<p>long " + "word, " * 20000 + "</p>", 4)], "page_id long, url string, html string, text int")
    assert sorted((r.page_id or 0, r.n_chars) for r in html_extract.extract_pages(own).collect()) == [(0, 5 + 6 * 20000 - 1), (1, 0), (1, 1)]
    assert html_extract.extract_pages(own.limit(0)).count() == 0


# words


def test_words():
    texts = [(t or "").encode() for _, t in TEXTS]
    w = words.Words(texts, lower=True)
    raw = w.bytes.tobytes()
    for d, (_, t) in enumerate(TEXTS):
        own = [raw[a:b].decode() for a, b in zip(w.start[w.first[d] : w.first[d + 1]], w.end[w.first[d] : w.first[d + 1]], strict=True)]
        assert own == brute.words(t, True)
    assert [len(s) for s in words.shingle_sets(texts)] == [len(brute.shingles(t)) for _, t in TEXTS]


# the pipeline


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = sf(spark, "documents")
    names = [n for n, _ in p.STAGES]
    assert len(names) == 5
    good = p.STAGES[0][1](spark, docs, SF)
    assert good.columns == docs.columns and 0 < good.count() <= docs.count()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = {i: t for i, (t, n) in brute.line_dedup(rows).items() if n == 0 or t}
    cut = p.STAGES[1][1](spark, docs, SF)
    assert {r.doc_id: r.text for r in cut.collect()} == want and cut.columns == docs.columns
    one = p.STAGES[2][1](spark, docs, SF)
    assert sorted(r.doc_id for r in one.collect()) == sorted(i for i, _, c in brute.components(rows) if i == c)
    mixed = p.STAGES[3][1](spark, docs, SF)
    assert mixed.columns == docs.columns
    texts, order = dict(rows), [(r.doc_id, r.text, r.source) for r in mixed.collect()]
    sizes, taken, cut = Counter(), Counter(), Counter()
    for r in docs.collect():
        sizes[r.source] += len(brute.words(r.text))
    for i, t, s in order:
        assert texts[i].strip().startswith(t.strip())
        cut[s] += t != texts[i]
        taken[s] += len(brute.words(t))
    for s, x in brute.targets(sizes).items():
        assert abs(taken[s] - x) <= 12 and cut[s] <= 1, (s, x, taken[s])
    # in schedule order every long stretch holds the sources in their shares
    half = Counter()
    for _, t, s in order[: len(order) // 2]:
        half[s] += len(brute.words(t))
    whole = sum(taken.values())
    assert all(abs(half[s] / sum(half.values()) - n / whole) < 0.1 for s, n in taken.items())
    check_packing(p.STAGES[4][1](spark, docs, SF).collect(), rows)


def test_pipeline_names(spark):
    """Extra columns come through every stage, whatever their names; nulls, repeated rows and empty tables don't stop it."""
    import corpus_pipeline as p

    names = ("row", "_row", "times", "_m0", "m1", "label", "covered", "_lines_removed", "size", "place", "turn", "slot", "words", "node", "of", "first")
    docs = sf(spark, "documents").limit(40)
    docs = docs.unionByName(docs.limit(2)).unionByName(docs.limit(1).selectExpr("cast(null as bigint) as doc_id", "cast(null as string) as text", "lang", "source", "n_chars"))
    docs = docs.selectExpr("*", *[f"'{n}' as `{n}`" for n in names])
    for k, (_, stage) in enumerate(p.STAGES[:4]):
        for rows in (docs, docs.limit(0)):
            out = stage(spark, rows, SF)
            got = out.collect()
            assert out.columns == docs.columns and all(r[n] == n for r in got for n in names)
            assert (len(got) > 0) == (rows is docs) or k == 3


def test_pipeline_run(spark):
    """The whole chain: its last stage packs what the four before it give, one after the other."""
    import corpus_pipeline as p

    docs = sf(spark, "documents")
    for _, stage in p.STAGES[:4]:
        docs = stage(spark, docs, SF)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check_packing(p.run(spark, SF).collect(), rows)


def test_pipeline_disk(spark, tmp_path):
    """With each stage's result written and read again, the folder holds what a stage and the one before it stored."""
    import os

    import corpus_pipeline as p
    from kbspark.llm import common

    common.forget_all(spark)
    before = set(os.listdir(common.shared_dir(spark)))
    docs, tables = sf(spark, "documents"), []
    for k, (_, stage) in enumerate(p.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        now = set(os.listdir(common.shared_dir(spark))) - before
        assert not any(now & old for old in tables[:-1]), (k, now, tables)
        tables.append(now - (tables[-1] if tables else set()))
    del out
    common.forget_unread(spark)
    assert set(os.listdir(common.shared_dir(spark))) == before


def test_pipeline_repeated_ids(spark):
    """One row of each group stays, whatever ids its rows share with others."""
    import corpus_pipeline as p

    text = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "abc"}
    rows = [(1, text["a"]), (5, text["a"] + " more"), (5, text["b"]), (7, text["c"]), (7, text["c"])]
    got = p.STAGES[2][1](spark, docs_frame(spark, rows), SF).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, text["a"]), (5, text["b"]), (7, text["c"])]


def test_word_ids():
    import random

    ids_of = packing.WordIds(packing.tokenizer_path())
    assert ids_of.cuts
    draw = random.Random(7)
    letters = "aZé ß'’sStTrReEvVlLdDmM09½²!<|>\n\t\x1c\x85\xa0ÀÿŸİΣςſ中éµªº×÷"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 40))) for _ in range(3000)]
    texts += ["a<|endoftext|>b x <|startoftext|> don't DON'T !'s ''s", "x" * 5000, "é1" * 3000]
    texts += ["plain Text's\twith\nÉté 12, !?\n\n"] * 2 + [""]
    for t, ids in zip(texts, ids_of.ids(texts), strict=True):
        assert ids == np.array(ids_of.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
