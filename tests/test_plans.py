from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from kbspark.functions import text as T
from kbspark.operators import chunking
from kbspark.plans.queries import ORACLES, QUERIES
from kbspark.sources import markdown

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "events"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    want = con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    near = lambda v: round(v, 6) if isinstance(v, float) else v
    at = sorted(names)
    assert Counter(tuple(near(r[c]) for c in at) for r in df.collect()) == Counter(tuple(near(r[names.index(c)]) for c in at) for r in want.fetchall())


def test_runs(spark):
    for name in QUERIES.keys() - ORACLES.keys():
        assert QUERIES[name](spark, SF).count() > 0


def test_terms(spark):
    got = spark.range(1).select(T.terms(F.lit("The ADC 12 芯片电压 a 5")).alias("t")).first().t
    assert got == ["the", "adc", "12", "芯片电压", "芯片电", "芯片", "片电压", "片电", "电压"]


def test_terms_long(spark):
    """A long CJK text takes a time that follows its length."""
    import time

    text = "".join(chr(0x4E00 + i * 7919 % 20000) for i in range(20000))
    rows = spark.createDataFrame([(1, text)], "doc_id long, text string").select(F.size(T.terms(F.col("text"))).alias("n"))
    rows.first()
    t = time.time()
    assert rows.first().n > 50000
    assert time.time() - t < 5


def _planned(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_terms_once(spark):
    """Terms are made by Arrow batches, once a text for each use of the postings: no filter repeats them, no lambda goes through them."""
    from kbspark.operators import indexes

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = _planned(indexes.inverted(indexes.postings(docs)))
    assert "lambda" not in plan and "size(" not in plan and plan.count("MapInArrow") == 1
    few = spark.createDataFrame([(1, "ab c ab 的 x1"), (2, None), (3, ""), (4, "\u212aelvin 12 É芯")], "doc_id long, text string")
    got = sorted((r.doc, r.term, r.n_terms) for r in indexes.postings(few).collect())
    assert got == [(1, "ab", 1), (4, "12", 2), (4, "elvin", 2)]
    assert [r.t for r in few.orderBy("doc_id").select(T.terms(F.col("text")).alias("t")).collect()] == [["ab"], [], [], ["elvin", "12"]]


def test_fulltext_counts_asked(spark):
    """Only the query's terms are weighed: the frequencies that are joined are broadcast, and scores are those of all weights."""
    from kbspark.operators import indexes, search

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    posts, n = indexes.postings(docs), docs.agg(F.count("*").alias("n"))
    asked = spark.createDataFrame([("the",), ("die",), ("the",), ("qqq",)], "term string")
    got = search.fulltext_of(posts, n, asked, None)
    assert "SortMergeJoin" not in got._jdf.queryExecution().sparkPlan().toString()
    want = search.fulltext(indexes.tfidf(posts, n), asked, None)
    assert sorted(got.collect()) == sorted(want.collect()) != []


def test_prepared_words(spark):
    """Words made of prepared texts in Python are those of ``preprocessed``; every character is taken out or kept as there."""
    import random

    from kbspark.operators import embedding

    chars = [chr(i) for i in [*range(1, 0xD800), *range(0xE000, 0x10000), 0x1F130, 0x1F600, 0x20000, 0x10FFFF]]
    rows = spark.createDataFrame([(i, "ab" + c + "cdefgh") for i, c in enumerate(chars)], "i long, t string")
    joined = {r.i for r in rows.where(T.preprocessed(F.col("t")) == "abcdefgh").collect()}
    differ = [hex(ord(c)) for i, c in enumerate(chars) if T.taken_out(c) != (i in joined) and c not in "#*`"]
    # characters that one side's version of Unicode doesn't know yet
    import unicodedata

    old = unicodedata.ucd_3_2_0
    assert [c for c in differ if old.category(chr(int(c, 16))) != "Cn"] == []
    draw = random.Random(5)
    parts = ["芯片", "电", "压的", "ab", "x1", "É", "-", "'", "\u3000", " ", "\n", "\u2028", "![a](b)", "[see](http://x)", "[", "](", "*", "_", "²", ".", "（", "\x1c", "的", "你"]
    texts = [(i, "".join(draw.choice(parts) for _ in range(draw.randint(0, 12)))) for i in range(3000)] + [(3000, None), (3001, "芯片电压"), (3002, "PWM"), (3003, " a  b ")]
    stop = set(embedding.SEGMENT_STOP_WORDS)

    def want(t):
        import re

        runs = re.findall("[a-zA-Z0-9]+|[\u4e00-\u9fa5]+", t)
        words = [w for r in runs for w in ([r] if r.isascii() else [r[i : i + 2] for i in range(max(1, len(r) - 1))])]
        words = [w for w in words if len(w) > 1 and w not in stop]
        return Counter(words + [a + " " + b for a, b in zip(words, words[1:])])

    rows = spark.createDataFrame(texts, "k long, t string")
    wanted = {r.k: want(r.p) for r in rows.select("k", T.preprocessed(F.col("t")).alias("p")).collect()}
    got = {k: Counter() for k in wanted}
    for r in embedding._counts(rows, "k", "t").collect():
        assert r.term not in got[r.k]
        got[r.k][r.term] = r.tf
    assert got == wanted


def test_counts_merge_keys(spark):
    """Rows of a repeated key count together; sparse scores are those of dense vectors."""
    from kbspark.operators import embedding, search

    rows = [(i % 40, "documents", f"PWM timer w{i % 7} clock 芯片{'电压' * (i % 3)} end", f"{i}.md", "A", "Datasheet") for i in range(60)]
    chunks = spark.createDataFrame(rows, "chunk_id long, chunk_type string, text string, file_name string, chip_category string, document_type string")
    counts = {(r.chunk_id, r.term): r.tf for r in embedding._counts(chunks, "chunk_id", "text").collect()}
    assert counts[0, "PWM timer"] == 2 and counts[39, "PWM timer"] == 1 and embedding._counts(chunks, "chunk_id", "text").count() == len(counts)
    config = search.SearchConfig(30, 0.01)
    embedded, words = embedding.embed_chunks(chunks, embedding.EmbeddingConfig(max_df=1.0))
    vector = embedding.query_vector("PWM 芯片 w3", words)
    dense = search.search_text(embedded, "PWM 芯片 w3", vector, config)
    sparse = search.search_sparse(chunks, embedding.tfidf_vectors(chunks, words), "PWM 芯片 w3", vector, config)
    assert "aggregate(" not in _planned(sparse)
    near = lambda df: [(r.chunk_id, round(r.score, 9)) for r in df.collect()]
    assert near(dense) == near(sparse) and len(near(sparse)) == 30


def test_cleaned_once(spark):
    """The cleaning steps are in a plan once, also of both datasets together, and those are the union of each."""
    from kbspark.operators import alpaca
    from kbspark.plans import manuals

    chunks = manuals._chunks(spark.read.parquet(f"{SF}/documents.parquet"))
    both = alpaca.complete_dataset(chunks, None, None)
    for df in (alpaca.qa_dataset(chunks), alpaca.instruction_dataset(chunks), both):
        assert _planned(df).count("mathbb") == 1
    want = alpaca.qa_dataset(chunks).withColumn("kind", F.lit("qa")).unionByName(alpaca.instruction_dataset(chunks).withColumn("kind", F.lit("instruction")))
    assert sorted(both.collect()) == sorted(want.collect()) != []


def test_similarity_blocks(spark):
    """Neighbours across blocks, of documents without terms too; no plan goes through maps term by term or pairs rows by a join on cells."""
    from kbspark.operators import indexes

    docs = [(i * 2, None if i % 100 == 7 else f"same{'abc'[i % 3]} word{'xyz'[i // 400]}") for i in range(1100)]
    df = indexes.banded_neighbours(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text")
    assert "element_at" not in _planned(df) and "lambda" not in _planned(df)
    got = {}
    for r in df.collect():
        got.setdefault(r.a, {})[r["rank"]] = (r.b, r.score)
    assert sorted(got) == [i for i, _ in docs] and all(sorted(x) == [1, 2, 3, 4, 5] for x in got.values())
    assert [b for b, _ in (got[1000][k] for k in range(1, 6))] == [982, 988, 994, 1006, 1012] and all(abs(s - 1) < 1e-9 for _, s in got[1000].values())
    assert [got[14][k] for k in range(1, 6)] == [(b, 0.0) for b in (0, 2, 4, 6, 8)]


def test_related_by_pieces(spark):
    """Bases meet chunks in the workers, not in a nested loop join; a keyword counts wherever the text holds it, also late in a long run of capitals."""
    from kbspark.operators import integration

    texts = ["ABC PWM", "X" * 30 + "ABC", None, "PWM ABC", "none"]
    rows = spark.createDataFrame([(i, t, "A" if i == 4 else None, "Datasheet" if i == 2 else "User Manual") for i, t in enumerate(texts)], "chunk_id long, text string, chip_category string, document_type string")
    df = integration.related_by_keyword(rows, rows.where("chunk_id = 0"), 3)
    assert "Join" not in _planned(df)
    assert [(r.base, r.chunk_id, r.score, r["rank"]) for r in sorted(df.collect(), key=lambda r: r["rank"])] == [(0, 3, 2, 1), (0, 1, 1, 2), (0, 2, 1, 3)]
    assert integration.related_by_keyword(rows, rows.limit(0), 3).count() == 0


def test_packed_few_at_a_time():
    """Of a large batch of texts, few are objects at the same time."""
    import pyarrow as pa

    from kbspark.functions.batches import ROWS

    udf = chunking._lists(lambda t: [t])
    texts = pa.array([f"t{i}" for i in range(5 * ROWS + 3)])
    asked = []

    class Watched:
        def __init__(self, a):
            self.a = a

        def __len__(self):
            return len(self.a)

        def slice(self, *x):
            return Watched(self.a.slice(*x))

        def to_pylist(self):
            asked.append(len(self.a))
            return self.a.to_pylist()

    assert udf.func(Watched(texts)).to_pylist() == [[f"t{i}"] for i in range(5 * ROWS + 3)]
    assert max(asked) == ROWS and sum(asked) == len(texts)


def windows_by_steps(text, size, overlap, most):
    """One window after the other, as a loop that goes on where the last began."""
    full = ""
    parts = text.split("\n\n")
    ends = set()
    for k, p in enumerate(parts):
        if p.strip():
            full += p.strip() + ("\n\n" if k + 1 < len(parts) else "")
            ends.add(len(full))
    if len(text) <= size:
        return [text.strip()] if text.strip() else []
    out, s = [], 0
    while s < len(full) and (most is None or s // (size - overlap) < most):
        e = next((e for e in range(s, min(s + size, len(full)) + 1) if e in ends and e > s + size / 2), min(s + size, len(full)))
        out += [full[s:e].strip()] if full[s:e].strip() else []
        if e >= len(full):
            break
        s += size - overlap
    return out


def test_windows():
    import random
    import time

    draw = random.Random(4)
    for _ in range(2000):
        text = "".join(draw.choice(["ab", " ", "\n\n", "c" * 9, "\n"]) for _ in range(draw.randint(0, 40)))
        size, most = draw.choice([10, 25, 40]), draw.choice([None, 2])
        assert chunking.windows_of(text, size, size // 5, most) == windows_by_steps(text, size, size // 5, most)
        if chunks := chunking.windows_of(text, size, size // 5, gap_free=True):
            assert "".join("".join(chunks).split()) != "" and set("".join(text.split())) == set("".join("".join(chunks).split()))
    t = time.time()
    assert len(chunking.windows_of("word and word\n\n" * 100_000)) > 3000
    assert time.time() - t < 5


def test_chunks(spark):
    text = "\n\n".join("x" * 120 for _ in range(12))
    got = [r.chunk for r in chunking.chunked(spark.createDataFrame([(1, text), (2, "short"), (3, " ")], "doc_id long, text string"), "doc_id", "text").where("doc_id = 1").orderBy("chunk_idx").collect()]
    assert len(got) > 2 and all(len(c) <= 500 for c in got)


def test_markdown(spark, tmp_path):
    d = tmp_path / "Documents (32F)" / "User Manual"
    d.mkdir(parents=True)
    (d / "a.md").write_text("lost\n# ADC one\nbody\n| a | b |\n|---|---|\n| 1 | 2 |\n\n- x\n  y\n```\ncode\n```\n## Two\nmore\n")
    (tmp_path / "e.md").write_text("# no")
    rows = markdown.documents(markdown.scan(spark, str(tmp_path))).collect()
    assert len(rows) == 1 and rows[0].error is None and rows[0].chip_category == "32F"
    assert [s.section_type for s in rows[0].sections] == ["table", "list", "code", "header", "header"]
    assert rows[0].tables[0].rows == [["1", "2"]] and rows[0].sections[3].title == "ADC one"


def test_ingest(spark, tmp_path):
    from kbspark.__main__ import fulltext, ingest

    d = tmp_path / "in" / "Documents (32F)" / "User Manual"
    d.mkdir(parents=True)
    (d / "a.md").write_text("# ADC one\n" + "ADC voltage reference. " * 60 + "\n| a | b |\n|---|---|\n| 1 | 2 |\n")
    (d / "b.md").write_text("# Timer\ncounts pulses\n")
    out = str(tmp_path / "out")
    stats = ingest(spark, str(tmp_path / "in"), out)
    assert stats["total_files"] == 2 and stats["chip_category"] == {"32F": 2}
    assert stats["chunks"]["document"] == 2 and stats["chunks"]["table"] == 1 and stats["chunks"]["section"] > 3
    assert [r.doc for r in fulltext(spark, out, "pulses").collect()] == ["doc_Documents (32F)/User Manual/b.md", "doc_Documents (32F)/User Manual/b.md_section_0"]
    assert "| User Manual | 2 | 100.0 % |" in open(f"{out}/report.md").read()


def test_commands(spark, tmp_path, monkeypatch):
    """Every action on a small tree, one after the other."""
    import json

    from kbspark import __main__ as app

    for folder, kind in (("Documents (32F)", "Datasheet"), ("Documents (32M)", "User Manual")):
        d = tmp_path / "in" / folder / kind
        d.mkdir(parents=True)
        for i in range(3):
            (d / f"{i}.md").write_text(f"# ADC 寄存器 {i}\n" + f"芯片 ADC 采样原理 与 机制 {i} 中断配置说明。 " * 30 + "\n## 故障\n故障诊断 芯片 引脚。" * 3 + "\n| a | b |\n|---|---|\n| 1 | 2 |\n")
    out = str(tmp_path / "out")
    assert app.pipeline(spark, str(tmp_path / "in"), out)["status"] == "success"
    assert json.loads((tmp_path / "out" / "pipeline_stats.json").read_text())["stages"]["conversion"]["total_files"] == 6
    assert app.pipeline(spark, str(tmp_path / "none"), str(tmp_path / "x"))["status"] == "failed"
    assert app.index(spark, out)["total_categories"] == 2 and "total_terms" in (tmp_path / "out" / "index_report.md").read_text()
    from kbspark.operators import embedding

    stats = app.embed(spark, out, embedding.EmbeddingConfig(max_df=1.0))
    assert stats["documents"] == 6 and stats["tables"] == 6 and stats["sections"] >= 6
    s = app.searcher(spark, out)
    found = s.multi_modal("ADC 采样", top_k=4).collect()
    assert len(found) == 4 and found[0].score >= found[-1].score
    assert {r.chip_category for r in s.by_category("ADC 采样", "32M").collect()} == {"32M"}
    assert app.alpaca_set(spark, out)["total_samples"] > 6
    assert spark.read.json(f"{out}/alpaca_qa/samples").where("input <> ''").count() > 0
    (tmp_path / "c.json").write_text(json.dumps({"min_context": 100, "max_samples": 4, "outlines": {"comparison": "关于{}的说明，" * 10}}))
    told = app.integration_set(spark, out, str(tmp_path / "c.json"), sharegpt=True)
    assert 0 < told["total_samples"] <= 4 and spark.read.json(f"{out}/integration_sharegpt/samples").count() == told["total_samples"]
    assert app.integration_set(spark, out, None)["total_samples"] >= 0
    from kbspark.functions import registered

    registered.register(spark)
    said = "Ab 12 芯片的电压x寄存器 3"
    assert spark.createDataFrame([(said,)], "t string").select(T.terms(F.col("t")).alias("w")).first().w == registered.terms_of(said)
    r = spark.sql("select kb_table_text(array('a', 'b'), array(array('1', '2'), array('3', '4'))) t").first().t
    assert r == spark.range(1).select(T.table_text(F.array(F.lit("a"), F.lit("b")), F.expr("array(array('1', '2'), array('3', '4'))"), 10, "总共").alias("t")).first().t
    r = spark.sql("select kb_language('芯片电压') a, kb_mainly_english('abc') b, kb_terms('ADC 芯片') c, kb_localised('the core') d, kb_preprocess('**bold** text') e, kb_chunks('x y') f").first()
    assert (r.a, r.b, r.c, r.d, r.e, r.f) == ("zh-cn", True, ["adc", "芯片"], "the 内核", "bold text", ["x y"])


def test_corpus_files(spark, tmp_path):
    import json

    from kbspark.sources import corpus

    chunk = {"id": "doc_1", "type": "document", "text": "x", "metadata": {"chip_category": "A"}, "tags": ["A"]}
    (tmp_path / "c.json").write_text(json.dumps([chunk]))
    (tmp_path / "r.json").write_text(json.dumps({"documents": [chunk], "sections": [], "tables": [chunk]}))
    (tmp_path / "d.json").write_text(json.dumps({"metadata": {}, "documents": [{"summary": "s", "metadata": {"file_name": "f"}}]}))
    assert corpus.read_chunks(spark, str(tmp_path / "c.json")).first().metadata.chip_category == "A"
    assert corpus.read_chunks(spark, str(tmp_path / "none.json")).count() == 0
    assert sorted(r.kind for r in corpus.read_ready(spark, str(tmp_path / "r.json")).collect()) == ["documents", "tables"]
    assert corpus.read_documents(spark, str(tmp_path / "d.json")).first().metadata.file_name == "f"
    assert corpus.read_config(str(tmp_path / "none.json"), {"a": 1}) == {"a": 1}


def test_small_functions(spark):
    from kbspark.operators import datasets, search

    one = spark.range(1)
    cats, texts = F.array(F.lit("A"), F.lit("B"), F.lit(None)), F.array(F.lit("原理 机制"), F.lit("故障"), F.lit(None))
    assert one.select(datasets.suitable_tasks(cats, texts).alias("t")).first().t == ["comparison", "synthesis", "analysis", "reasoning"]
    assert one.select(datasets.complementary(F.lit("User Manual"), F.lit("My Datasheet")).alias("c")).first().c
    assert one.select(datasets.complementary(F.lit(None), F.lit("x")).alias("c")).first().c is False
    assert one.select(datasets.context_text(F.array(F.lit("A")), F.array(F.lit("t"))).alias("c")).first().c == "=== A ===\nt\n"
    assert one.select(T.preprocessed(F.lit("![i](u) [see](v) **bold**  'x' #1")).alias("c")).first().c == "see bold x 1"
    assert one.select(T.preprocessed(F.lit("abc")).alias("c")).first().c == ""
    packed = chunking.packed_paragraphs(F.lit("\n\n".join(["a" * 200, "b" * 200, "c" * 200, "d" * 1200])))
    assert [len(c) for c in one.select(packed.alias("c")).first().c] == [402, 200, 500, 500, 200]
    boosted = search.metadata_boost(F.lit(1.0), "ABC 参数", ["abc"], F.lit("abc.md"), F.lit("ABC"), F.lit("Datasheet"))
    assert abs(one.select(boosted.alias("s")).first().s - 1.1 * 1.2 * 1.15) < 1e-9
    words = spark.createDataFrame([(1, "ADC"), (1, "ADC clock"), (2, "PWM")], "doc long, keyword string")
    assert [(r.doc, r.matched) for r in search.keyword(words, "adc", True).collect()] == [(1, ["ADC", "ADC clock"])]
    assert [r.matched for r in search.keyword(words, "adc").collect()] == [["ADC"]]


def test_bad_file(spark, tmp_path):
    """A file that isn't UTF-8 is set aside; the others are read."""
    d = tmp_path / "Documents (32F)" / "Manual"
    d.mkdir(parents=True)
    (d / "a.md").write_text("# T\nbody\n")
    (d / "b.md").write_bytes(b"# T\n\xff\xfe\xc3(\n")
    rows = {r.file_name: r for r in markdown.documents(markdown.scan(spark, str(tmp_path))).collect()}
    assert rows["a.md"].error is None and rows["b.md"].error == "not UTF-8" and rows["b.md"].sections is None


def test_alpaca(spark):
    from kbspark.operators import alpaca

    one = spark.range(1)
    value = lambda c: one.select(c.alias("c")).first().c
    clean = lambda t: alpaca.cleaned(spark.createDataFrame([(t,)], "t string"), "t").first().t
    assert clean("too short") is None
    assert clean('<td colspan="2">The Register core  of 8-bit Cortex-M0+ Timer</td> &nbsp;![a](b) ---') == "The 寄存器 内核 of 8位 Cortex-M 定时器"
    # a single bit's line is found by both of the patterns
    got = clean("PWM 位编号 7~4 PWMPD[3:0] 预分频的选择位 3~3 PWMEN 使能位的说明").split("\n")
    assert got == ["PWM寄存器位定义：", "位7~4 - PWMPD[3:0]：预分频的选择位", "位3 - PWMEN：使能位的说明", "位3 - PWMEN：使能位的说明"]
    assert clean("ADC采样 0: 两个系统时钟周期 1: 四个系统时钟周期 说明 : 见时序其中") == "ADC配置选项：\n配置0：两个系统时钟周期\n配置1：四个系统时钟周期\n\n说明：见时序"
    assert value(alpaca.parameters(F.lit("48 MHz at 3.3V and 5mA, -40°C to 85°C, 采样时间约12个系统时钟"))) == "工作频率48MHz；工作电压3.3V；工作电流5mA；工作温度范围-40°C至85°C；ADC采样时间约12个系统时钟"
    assert value(alpaca.description(F.lit("built-in CRC with 16-bit data units"), F.lit("X"))) == "主要特性包括：内置硬件CRC校验模块、支持16位数据单元处理。"
    assert value(alpaca.description(F.lit("nothing"), F.lit("X"))).startswith("X芯片具有")
    chunks = [(i, "section" if i % 2 else "document", f"芯片 {i} 的寄存器配置与中断说明，" * 4, "A" if i else None, "Datasheet") for i in range(10)]
    rows = spark.createDataFrame(chunks, "chunk_id long, chunk_type string, text string, chip_category string, document_type string")
    qa = alpaca.qa_dataset(rows, 6).collect()
    assert sorted(r.chunk_id for r in qa) == [0, 1, 2, 4, 6, 8] and all(r.input and r.output for r in qa)
    assert {r.instruction for r in alpaca.instruction_dataset(rows).collect()} == {"解释A芯片寄存器的配置方法和各位功能", "解释芯片芯片寄存器的配置方法和各位功能"}
    both = alpaca.complete_dataset(rows, None, None)
    assert [r.chunk_id for r in both.collect()] == [r.chunk_id for r in both.collect()] and both.count() == 20
    assert alpaca.dataset_stats(both).first().samples_with_input == 10 and alpaca.dataset_stats(both.limit(0)).first().total_samples == 0


def test_integration(spark):
    """Groups and tasks against a loop over the bases."""
    from kbspark.operators import integration

    topics = ["原理 寄存器 PWM ", "故障 诊断 ADC UART ", "机制 实现 中断 "]
    chunks = [(i, topics[i % 3] * 40 + f"N{i} ", "ABCD"[i % 4], ["Datasheet", "User Manual", "Other"][i % 3]) for i in range(24)]
    rows = spark.createDataFrame(chunks, "chunk_id long, text string, chip_category string, document_type string")
    need = integration.Requirements(min_context=300, max_context=1500, max_samples=8, bases=None)
    some = integration.bases(rows, None, 300)
    related = integration.related_by_keyword(rows, some, 5)
    groups = {r.group_id: r for r in integration.groups(rows, some, related, need).collect()}
    assert all(len(g.texts) == 2 for g in groups.values()) and len(groups) == 24
    tasks = integration.integration_dataset(rows, need).collect()
    assert len(tasks) <= 8 and len({t.group_id for t in tasks}) == len(tasks)
    by = {t.task_type: sum(x.task_type == t.task_type for x in tasks) for t in tasks}
    assert all(by[k] <= int(8 * need.shares[k]) for k in by)
    assert all(t.instruction and len(t.integration_points) == 4 and t.quality_score >= 0.3 and t.difficulty == "basic" for t in tasks)
    frame = integration.integration_dataset(rows, need)
    assert integration.statistics(frame).first().total_samples == len(tasks)
    assert integration.distinct_sources(frame).first().unique_context_sources == len({s for t in tasks for s in t.context_sources})
    assert {r.value: r.n for r in integration.histogram(frame, "task_type").collect()} == by
    assert integration.sharegpt_rows(frame).first().conversations[1].value in {t.expected_output for t in tasks}
    assert integration.alpaca_rows(frame).columns[:3] == ["instruction", "input", "output"]
    embedded = rows.withColumn("embedding", F.array(F.when(F.col("chunk_id") < 12, 1.0).otherwise(0.0), F.when(F.col("chunk_id") < 12, 0.0).otherwise(1.0)))
    near = integration.related_by_embedding(embedded, embedded.where("chunk_id = 3"), 3, 0.5).collect()
    assert [(r.chunk_id, r.rank) for r in sorted(near, key=lambda r: r.rank)] == [(0, 1), (1, 2), (2, 3)]


def test_embeddings(spark, tmp_path):
    """A chunk without text has no embedding and shifts no other; what was saved answers a query; a missing folder is an error."""
    from kbspark.operators import embedding, search

    rows = [(f"c{i}", "documents", t, "f.md", "A", "Datasheet", "") for i, t in enumerate(["PWM timer output", "", "PWM timer input", "ADC sampling clock", "ADC sampling rate", None])]
    chunks = spark.createDataFrame(rows, "chunk_id string, chunk_type string, text string, file_name string, chip_category string, document_type string, title string")
    config = embedding.EmbeddingConfig(min_df=2, max_df=1.0)
    embedded, words = embedding.embed_chunks(chunks, config)
    got = {r.chunk_id: r.embedding for r in embedded.collect()}
    assert got["c1"] is None and got["c5"] is None and got["c0"] == got["c2"] and got["c3"] == got["c4"] != got["c0"]
    assert embedding.save(embedded, words, str(tmp_path / "e"), config)["documents"] == 4
    back, vocabulary = embedding.load(spark, str(tmp_path / "e")), spark.read.parquet(str(tmp_path / "e" / "vocabulary"))
    s = search.Searcher(back, lambda q: embedding.query_vector(q, vocabulary))
    assert sorted(r.chunk_id for r in s.search("ADC sampling").collect()) == ["c3", "c4"]
    assert s.search(" ").count() == 0 and s.search("unknown").count() == 0 and s.by_category("ADC sampling", "B").count() == 0
    assert s.by_document_type("ADC sampling", "Datasheet").count() == 2 and s.precise("ADC sampling", 1).count() == 1 and s.fuzzy("PWM timer").count() == 2 and s.multi_modal("PWM timer", False).count() == 2
    assert [r.chunk_id for r in s.similar("c0", "documents", 1).collect()] == ["c2"]
    with pytest.raises(FileNotFoundError):
        embedding.load(spark, str(tmp_path / "none"))
    assert embedding.backend("tfidf") == "tfidf" and embedding.backend("nothing") == "tfidf"
    encoded = embedding.encoded(chunks, lambda: lambda texts: [[3.0 * len(t), 4.0 * len(t)] for t in texts]).collect()
    assert {r.chunk_id for r in encoded} == {"c0", "c2", "c3", "c4"} and all(abs(r.embedding[0] - 0.6) < 1e-9 for r in encoded)
    said = embedding.embeddable_text(F.col("text"), F.col("chunk_type"), F.col("file_name"), F.col("title"), F.array(F.lit("x"), F.lit("y")))
    assert {r.chunk_id: r.t for r in chunks.select("chunk_id", said.alias("t")).collect()}["c1"] == "f.md x y"
    (tmp_path / "stop.txt").write_text("PWM\n\nADC\n")
    stop = embedding.stop_words(spark, str(tmp_path / "no.txt"), str(tmp_path / "stop.txt"))
    assert spark.range(1).select(embedding.segmented(F.lit("PWM timer 芯片电压 的 a"), stop).alias("w")).first().w == ["timer", "芯片", "片电", "电压"]


def test_index_files(spark, tmp_path):
    """All indexes of a Markdown tree, saved, read again and asked."""
    import json

    from kbspark.operators import indexes, search
    from kbspark.sources import sinks

    d = tmp_path / "in" / "Documents (32F)" / "User Manual"
    d.mkdir(parents=True)
    for i in range(4):
        (d / f"{i}.md").write_text(f"# ADC {i}\nclock number{i} shared words\n| a | b |\n|---|---|\n| 1 | 2 |\n")
    docs = markdown.documents(markdown.scan(spark, str(tmp_path / "in"))).where("error is null")
    indexes.save(indexes.build(docs), str(tmp_path / "idx"))
    back = indexes.load(spark, str(tmp_path / "idx"))
    told = json.loads((tmp_path / "idx" / "search_config.json").read_text())
    assert told["available_categories"] == ["32F"] and told["index_statistics"]["total_terms"] == back["postings"].select("term").distinct().count()
    assert {(r.level, r.section_type) for r in back["hierarchy"].collect()} == {("1", "header"), ("None", "table")}
    path = "Documents (32F)/User Manual/2.md"
    tables = {"docs": docs.withColumn("doc", F.col("file_path")), "weights": back["tfidf"], "keywords": back["keywords"].withColumnRenamed("value", "keyword"), "similarity": back["similarity"]}
    assert search.dispatch(tables, "number").count() == 4
    assert search.dispatch(tables, "adc 2", "keyword").first().doc == path and search.dispatch(tables, "32F", "category").count() == 4
    assert search.dispatch(tables, f"file_name:2.md", "metadata").first().doc == path and search.dispatch(tables, path, "similarity").count() == 3
    assert search.dispatch(tables, "adc", "fuzzy_keyword").count() == 4 and search.dispatch(tables, "User Manual", "type").count() == 4
    with pytest.raises(ValueError):
        search.dispatch(tables, "x", "none")
    found = search.exported(search.dispatch(tables, "clock"), "clock", "full_text")
    sinks.write_results(found, str(tmp_path / "found"))
    assert spark.read.json(str(tmp_path / "found")).count() == found.count()
    stats = sinks.corpus_stats(docs)
    assert stats["section_type"] == {"header": 4, "table": 4} and stats["tables_per_document"] == 1
    assert "- **header**: 4 (50.0 %)" in sinks.bullet_report(stats) and "| total_terms |" in sinks.index_report(told["index_statistics"], {"ADC": 1})
    ok = sinks.run_stages(spark, {"a": lambda: 1, "b": lambda: 2}, str(tmp_path / "s.json"))
    bad = sinks.run_stages(spark, {"a": lambda: 1, "b": lambda: 1 / 0}, str(tmp_path / "s.json"))
    assert ok["status"] == "success" and bad["status"] == "failed" and bad["stages"] == {"a": 1} and "zero" in json.loads((tmp_path / "s.json").read_text())["error"]


def test_similarity_gaps(spark):
    """Neighbours by position, not by id: ids with gaps, few documents (all pairs) and many (a band), against a loop."""
    import math

    from kbspark.operators import indexes

    for n in (20, 130):
        word = lambda p, k: p + "abcdefghijklm"[k % 13] * 2 + "nopqrstuvwxyz"[k // 13] * 2
        docs = [(i * i * 3 + 5, " ".join([word("p", i % 7), word("q", i % 5), word("r", i % 3), word("s", i), "all"])) for i in range(n)]
        got = indexes.banded_neighbours(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text").collect()
        sets = [set(t.split()) for _, t in docs]
        idf = {w: math.log(n / (sum(w in s for s in sets) + 1)) ** 2 for s in sets for w in s}
        cos = lambda a, b: sum(idf[w] for w in a & b) / math.sqrt(sum(idf[w] for w in a) * sum(idf[w] for w in b))  # noqa: B023, E731
        want = set()
        for i in range(n):
            near = [j for j in range(n) if j != i and (n <= 100 or abs(i - j) <= 10)]
            near.sort(key=lambda j: (-round(cos(sets[i], sets[j]), 12), j))  # noqa: B023
            want |= {(docs[i][0], docs[j][0], k + 1) for k, j in enumerate(near[:5])}
        assert {(r.a, r.b, r["rank"]) for r in got} == want


def test_quotas(spark):
    import random

    from kbspark.operators import datasets

    draw = random.Random(3)
    groups = [(i, i, [k for k in datasets.TASKS if draw.random() < 0.4]) for i in range(60)]
    shares, most = {"comparison": 0.3, "synthesis": 0.2, "analysis": 0.2, "reasoning": 0.3}, 20
    room, want = {k: int(most * v) for k, v in shares.items()}, {}
    for i, _, kinds in groups:
        k = next((k for k in kinds if room[k]), None)
        if k and len(want) < most:
            room[k] -= 1
            want[i] = k
    got = datasets.with_quotas(spark.createDataFrame(groups, "group_id long, position long, tasks array<string>"), shares, most)
    assert {r.group_id: r.task for r in got.collect()} == want
