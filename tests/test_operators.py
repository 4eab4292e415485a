"""Table operators, sources, whole jobs and the queries' oracles."""

import json
import os
import random
import time

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from adsieve.functions import names
from adsieve.operators import chunking, entities, evaluation, inspection, labels, spans
from adsieve.plans import catalogue, jobs, pipeline
from adsieve.sources import labelled, workbook
from adsieve.streaming.records import extract

SF = "/root/testdata/sf0.001"
TOKENS = "doc_id long, chunk_id int, i int, start int, end int, label string, confidence double"


def test_merge_and_report(spark):
    text = "Bs An Lê ở ACME"
    rows = [(1, 0, 0, 0, 0, "O", 1.0), (1, 0, 1, 3, 5, "I-PER", 0.5), (1, 0, 2, 6, 8, "I-PER", 0.9), (1, 0, 3, 9, 10, "O", 1.0), (1, 0, 4, 11, 15, "B-ORG", 0.25)]
    tokens = spans.repair_starts(spans.real_tokens(spark.createDataFrame(rows, TOKENS))).withColumn("t", F.lit(text))
    found = spans.merge_spans(tokens, F.col("t")).orderBy("start").collect()
    assert [(r.label, r.start, r.end, r.confidence, r.text, r.surface) for r in found] == [("PER", 3, 8, 0.9, "AnLê", "An Lê"), ("ORG", 11, 15, 0.25, "ACME", "ACME")]
    chunk = spark.createDataFrame([(1, 0, text)], "doc_id long, chunk_id int, text string")
    assert [r.asDict() for r in spans.merge_in_texts(tokens.drop("t"), chunk).orderBy("start").collect()] == [r.asDict() for r in found]
    docs = spark.createDataFrame([(1, text), (2, "nothing")], "doc_id long, text string")
    result = spans.results(docs, spans.merge_spans(tokens, F.col("t"))).orderBy("doc_id").collect()
    assert result[0].entity_types == ["PER", "ORG"] and result[0].entities_by_type["ORG"][0].text == "ACME" and result[1].total_entities == 0
    shown = spans.report(spans.results(docs, spans.merge_spans(tokens, F.col("t")))).orderBy("doc_id").collect()
    assert "1. 'AnLê' → PER (confidence: 0.900)" in shown[0].report and shown[1].report.endswith("No entities detected")


def test_chunks(spark):
    docs = spark.createDataFrame([(1, "A b c. D e! F g h i j k l.  M?"), (2, ""), (3, None)], "doc_id long, text string")
    got = [tuple(r) for r in chunking.chunks(docs, 5).orderBy("doc_id", "chunk_id").collect()]
    assert got == [(1, 0, 0, 11, "A b c. D e!"), (1, 1, 12, 26, "F g h i j k l."), (1, 2, 28, 30, "M?")]


def test_tokeniser_counts(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    tokenizers = pytest.importorskip("tokenizers")
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.createDataFrame([(1, "One unbelievable sentence. And another one! Short."), (2, ""), (3, None)], "doc_id long, text string")
    counted = chunking.subword_counts(path)
    got = [r.text for r in chunking.chunks(docs, 7, counts=counted).orderBy("doc_id", "chunk_id").collect()]
    size = lambda t: len(tokenizers.Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids)
    parts, want = ["One unbelievable sentence.", "And another one!", "Short."], []
    for part in parts:
        if want and sum(map(size, want[-1])) + size(part) <= 7:
            want[-1].append(part)
        else:
            want.append([part])
    assert got == [" ".join(w) for w in want]


def test_consolidation(spark):
    rows = [
        (1, 0, "Hana", "ORG"), (1, 1, "BV Q1", "ORG"), (1, 2, "Hana", "ORG"), (1, 3, "12 Lê Lợi, Q.3, TPHCM", "ADDR"), (1, 4, "12 LÊ LỢI, q.3, tphcm", "ADDR"),
        (1, 5, "7 Thùy Vân, Vũng Tàu", "GPE"), (1, 6, "Bác sĩ Hồ Cao Vũ", "PER"), (1, 7, "vũ", "PER"), (2, 0, None, "PER"),
    ]
    got = entities.consolidate(spark.createDataFrame(rows, "doc_id long, start int, text string, label string")).collect()
    assert len(got) == 1
    assert got[0].organization_names == ["Hana", "Bệnh Viện Quận 1"]
    assert got[0].addresses == ["12 Lê Lợi, Q.3, TPHCM", "7 Thùy Vân, Vũng Tàu"] and got[0].persons == ["Hồ Cao Vũ"]


def test_segments_rebuild_the_text(spark):
    df = spark.createDataFrame([("abcdefgh", [(2, 4, "PER"), (6, 99, "ORG")]), ("  ", []), ("xyz", []), ("\u00a0\u3000", [(0, 1, "PER")])], "t string, e array<struct<start:int,end:int,label:string>>")
    got = [r.s for r in df.select(inspection.segments(F.col("t"), F.col("e")).alias("s")).collect()]
    assert [tuple(s) for s in got[0]] == [("ab", None), ("cd", "PER"), ("ef", None), ("gh", "ORG")] and got[1] == [] and [tuple(s) for s in got[2]] == [("xyz", None)] and got[3] == []


def test_digit_stands_for_no_entity(spark):
    rows = [(1, 0, 0, "a", 7, "0", 0.12345), (1, 0, 1, "b", 8, "B-PER", 0.9), (1, 0, 2, "<s>", 1, "B-PER", 0.9)]
    got = inspection.token_table(spark.createDataFrame(rows, "doc_id long, chunk_id int, i int, token string, token_id int, label string, confidence double")).orderBy("index").collect()
    assert [(r.predicted_tag, r.confidence, r.is_entity) for r in got] == [("O", 0.1235, ""), ("B-PER", 0.9, "✅"), ("B-PER", 0.9, "")]


def test_page_of_gathered_tokens(spark):
    rows = [(1, 1, 0, "<pad>", "O", 1.0), (1, 0, 1, 'a"&', "B-PER", 0.25), (1, 0, 0, "<x>", "0", 0.12345), (1, 0, 2, None, "O", 1.0), (1, 1, 1, "z", None, 1.0), (2, 0, 0, "</s>", "O", 1.0)]
    tokens = spark.createDataFrame(rows, "doc_id long, chunk_id int, i int, token string, label string, confidence double")
    shown = tokens.where("token NOT IN ('<s>', '</s>', '<pad>')").orderBy("chunk_id", "i").select(inspection.token_html(F.col("token"), inspection.fixed_label(F.col("label")), F.col("confidence")).alias("b"))
    blocks = [r.b for r in shown.collect() if r.b is not None]
    assert len(blocks) == 2 and "&lt;x&gt;</span><span>O</span></div>" in blocks[0] and 'title="Tag: B-PER | Conf: 0.2500"' in blocks[1]
    got = [(r.doc_id, r.html) for r in inspection.document_html(tokens).collect()]
    assert got == [(1, '<div style="font-family:sans-serif;line-height:2.5;">' + "".join(blocks) + "</div>")]
    gathered = inspection.document_html(tokens)._jdf.queryExecution().executedPlan().toString().split("Exchange")[-1]
    assert "display:inline-block" not in gathered  # no block is made before tokens are gathered


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pages_need_no_shuffle(spark):
    plan = plan_of(jobs.JOBS["token_html"](spark, SF))
    assert "hashpartitioning" not in plan and "Window" not in plan


def test_reports_need_no_shuffle(spark):
    plan = plan_of(jobs.JOBS["ner_results"](spark, SF))
    assert "hashpartitioning" not in plan and "Window" not in plan and "Join" not in plan


def test_reports_of_arrays_equal_those_of_tables(spark, tmp_path):
    texts = [(1, "An Bình ở Huế " * 300), (2, "x"), (3, ""), (4, None)]
    spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    found = spans.merge_in_texts(catalogue.span_tokens(spark, str(tmp_path)), docs.withColumn("chunk_id", F.lit(0)))
    want = spans.report(spans.results(docs, found)).orderBy("doc_id").collect()
    assert len(want) == 4 and want == jobs.JOBS["ner_results"](spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [r.doc_id for r in jobs.JOBS["token_html"](spark, str(tmp_path)).orderBy("doc_id").collect()] == [1, 2, 3]


def test_character_digests_need_no_shuffle(spark):
    assert "hashpartitioning" not in plan_of(jobs.QUERIES["char_bio"](spark, SF))


def test_spans_of_a_long_text_in_a_moment(spark):
    docs = spark.createDataFrame([(1,)], "doc_id long").select("doc_id", F.repeat(F.lit("x"), 4_000_000).alias("text"))
    began = time.monotonic()
    assert docs.select(F.size(catalogue.synthetic_spans(F.col("text")))).first()[0] == 40_004
    assert time.monotonic() - began < 20


def test_labels_and_split(spark):
    items = spark.createDataFrame([(k, f"An ở Huế {k}", [(0, 2, "An", ["PER"]), (5, 8, "Huế", ["ADDR"]), (1, 400, "", ["ORG"])]) for k in range(300)], "doc_id long, text string, label array<struct<start:int,end:int,text:string,labels:array<string>>>")
    first = labels.character_table(items.where("doc_id = 1")).orderBy("pos").collect()
    assert [r.tag for r in first] == ["B-PER", "I-PER", "O", "O", "O", "B-ADDR", "I-ADDR", "I-ADDR", "O", "O"]
    places = [(r.doc_id, r.pos, r.tag) for r in labels.character_table(items).where("tag <> 'O'").orderBy("doc_id", "pos").collect()]
    assert places == [(r.doc_id, r.pos, r.tag) for r in labels.entity_characters(items).orderBy("doc_id", "pos").collect()]
    parts = {n: d.count() for n, d in labelled.by_split(labels.split(items)).items()}
    assert parts == {"train": 240, "validation": 30, "test": 30}
    hashed = labels.split(items, exact=False).groupBy("split").count().collect()
    assert {r.split for r in hashed} == set(parts) and all(abs(r["count"] - parts[r.split]) < 40 for r in hashed)
    for n in (0, 1, 2, 6, 11):
        rest = -(-n // 5)
        found = labels.split(items.limit(n)).groupBy("split").count().collect()
        assert {r.split: r["count"] for r in found} == {k: v for k, v in (("train", n - rest), ("validation", rest // 2), ("test", rest - rest // 2)) if v}
    made = labels.training_examples(items.limit(3), 10).collect()
    assert all(r.runs for r in made) and {r.problem for r in made} == {None}


def test_metrics_of_equal_tags(spark):
    tokens = catalogue.token_tags(spark, SF)
    same = evaluation.scores(evaluation.repaired(tokens.withColumn("predicted", F.col("gold")))).collect()
    assert len(same) == 4 and all(r.precision == r.recall == r.f1 == r.accuracy == 1.0 for r in same)
    assert evaluation.as_lines(evaluation.scores(tokens)).count() == 16


def test_labelled_source(spark, tmp_path):
    item = {"id": "a", "text": "An", "label": [{"start": 0, "end": 2, "text": "An", "labels": ["PER"]}]}
    (tmp_path / "x.json").write_text(json.dumps([item, {"text": "y"}]))
    got = labelled.read_labelled(spark, str(tmp_path / "x.json")).orderBy(F.col("id").asc_nulls_last()).collect()
    assert got[0].label[0].labels == ["PER"] and got[1].id is None
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        labelled.read_labelled(spark, str(tmp_path / "none.json"))


def test_workbook(spark, tmp_path):
    rows = [("S & 1", 0, 0, "name", True), ("S & 1", 0, 1, "n", True), ("S & 1", 1, 0, "[AD] <b>x</b>", True), ("S & 1", 1, 1, "3.5", False), ("S & 1", 2, 0, "same", True), ("two", 0, 0, "h", True)]
    given, out = str(tmp_path / "in.xlsx"), str(tmp_path / "out.xlsx")
    workbook.write_workbook(spark.createDataFrame(rows, "sheet string, row int, col int, value string, is_text boolean"), given, ["S & 1", "two"])
    assert sorted(map(tuple, workbook.read_cells(spark, given).collect())) == sorted(rows)
    stats = pipeline.clean_workbook(spark, given, out, str(tmp_path / "stats.json"))
    assert (stats["sheets_processed"], stats["total_cells"], stats["changed_cells"], stats["change_percentage"]) == (2, 4, 1, 25.0)
    assert ("S & 1", 1, 0, "x", True) in set(map(tuple, workbook.read_cells(spark, out).collect()))
    assert json.loads((tmp_path / "stats.json").read_text()) == stats
    with pytest.raises(Exception, match="not found"):
        workbook.read_cells(spark, str(tmp_path / "none.xlsx")).count()


def test_stream(spark, tmp_path):
    docs = catalogue.marked(spark, SF)
    docs.write.parquet(str(tmp_path / "docs"))
    stream = extract(spark.readStream.schema(docs.schema).parquet(str(tmp_path / "docs")))
    query = stream.writeStream.format("memory").queryName("ads").start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("ads").exceptAll(extract(docs)).count() == 0 and spark.table("ads").count() == docs.count()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


CORE, CORE_SQL = catalogue.QUERIES | jobs.JOBS, catalogue.ORACLE_SQL | jobs.JOBS_SQL


@pytest.mark.parametrize("name", sorted(CORE_SQL))
def test_oracle(spark, duck, name):
    df = CORE[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    found = duck.execute(CORE_SQL[name])
    place = [[d[0] for d in found.description].index(c) for c in columns]
    assert got == sorted(repr([plain(r[k]) for k in place]) for r in found.fetchall())


def test_without_sql():
    assert set(CORE) - set(CORE_SQL) == {"ad_records", "tagger_scores"}


def test_records_of_a_tagger(spark):
    text = "Hana Spa o 12 Le Loi, Q1 TPHCM. Bac Si An Le goi 0918 680 551"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    found = {r.doc_id: r for r in pipeline.records(docs, tagger=catalogue.word_tagger).collect()}
    assert found[1].phone_numbers == ["0918680551"] and found[1].doctor_names == ["Hana Spa", "Le Loi", "Bac Si An Le"]
    assert found[1].organization_names == ["Thành Phố Hồ Chí Minh."] and found[3].phone_numbers == [] and found[2].phone_numbers is None
    assert jobs.JOBS["ad_records"](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_entry(spark):
    assert entry.entry(spark).columns == ["doc_id", "phone"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_labelled_items_across_ranges(spark, tmp_path):
    marks = ['{', '}', '}]', '\\', '\\"', '"}', '[{"', '\n', 'ế', '', '\u2028', '},{', "\\\\"]
    items = [{"id": str(k), "text": "".join(marks[(k * j + j) % len(marks)] + "x" * (k % 5) for j in range(k % 40)), "label": [{"start": k, "end": k + 1, "text": marks[k % len(marks)], "labels": ["A}"]}] * (k % 3)} for k in range(400)]
    for name, options in (("a", {"indent": 1}), ("b", {"ensure_ascii": False}), ("c", {"separators": (",", ":")})):
        (tmp_path / f"{name}.json").write_text(json.dumps(items, **options), encoding="utf-8")
    (tmp_path / "none.json").write_text(" [ ]\n")
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "one.json").write_text(json.dumps({"id": "one", "text": "{", "other": {"x": ["}"]}}))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        raw = spark.read.option("lineSep", "}").text(str(tmp_path / "*.json"))
        assert raw.rdd.getNumPartitions() > 50
        got = labelled.read_labelled(spark, str(tmp_path / "*.json")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    as_row = lambda x: (x["id"], x["text"], [(s["start"], s["end"], s["text"], s["labels"]) for s in x["label"]])
    assert sorted(as_row(r) for r in got if r.id != "one") == sorted(as_row(x) for x in items * 3)
    assert [(r.text, r.label) for r in got if r.id == "one"] == [("{", None)]
    labelled.write_labelled(spark.createDataFrame(got, labelled.LABELLED_ITEM).repartition(3), str(tmp_path / "out"))
    again = labelled.read_labelled(spark, str(tmp_path / "out"))
    assert again.exceptAll(spark.createDataFrame(got, labelled.LABELLED_ITEM)).count() == 0 and again.count() == 1201
    labelled.write_labelled(again.limit(0), str(tmp_path / "nothing"))
    assert labelled.read_labelled(spark, str(tmp_path / "nothing")).count() == 0


@pytest.mark.parametrize("broken", ['[{"id": "a", "text": "hal', '[{"id": "a"}, oops]', '[{"id": }]'])
def test_broken_items_raise(spark, tmp_path, broken):
    (tmp_path / "x.json").write_text(broken)
    with pytest.raises(Exception, match="no item of a JSON array|MALFORMED_RECORD"):
        labelled.read_labelled(spark, str(tmp_path / "x.json")).collect()


def test_clean_table_observes_one_pass(spark, tmp_path):
    rows = [(1, "a [AD] b", None), (2, "same", "<b>x</b>"), (3, None, "y")]
    df = spark.createDataFrame(rows, "id long, `a.b` string, given_0 string")
    stats = pipeline.clean_table(df, str(tmp_path / "clean"))
    assert (stats["total_cells"], stats["changed_cells"], stats["change_percentage"]) == (9, 2, 22.22)
    got = spark.read.parquet(str(tmp_path / "clean"))
    assert got.columns == df.columns and sorted(map(tuple, got.collect())) == [(1, "a b", None), (2, "same", "x"), (3, None, "y")]
    empty = pipeline.clean_table(df.limit(0), str(tmp_path / "none"))
    assert (empty["total_cells"], empty["changed_cells"], empty["change_percentage"]) == (0, 0, 0.0)


def test_names_inside_others(spark):
    rng = random.Random(8)
    lists = [["".join(rng.choice("abÂế ") for _ in range(rng.randint(2, 9))) for _ in range(n)] for n in (0, 1, 2, 31, 33, 34, 80, 300)]
    lists += [["ab" * k for k in range(1, 60)], [chr(97 + k % 26) * (2 + k // 26) for k in range(90)], ["x" * 3000, "y" * 20] + [f"n{k} x" for k in range(60)]]
    got = spark.createDataFrame([(k, own) for k, own in enumerate(lists)], "k int, own array<string>").select("k", names.distinct_persons(F.col("own")).alias("kept")).collect()
    for r in got:
        first = {}
        for name in lists[r.k]:
            if len(name) >= 2 and any(c.isalpha() for c in name):
                first.setdefault(name.lower(), name)
        assert r.kept == [n for key, n in first.items() if not any(len(q) > len(key) and key in q for q in first)]
