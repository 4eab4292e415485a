"""Registered queries of the extraction engine and their DuckDB counterparts.

The test tables hold little of what the engine looks for, so most queries weave a payload into
every row by rule, alike on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adsieve.functions import names, tags
from adsieve.functions.cleaning import change_stats, clean_text, remove_crawl_artifacts, strip_tags
from adsieve.functions.licences import licences
from adsieve.functions.phones import phones
from adsieve.functions.text import collapse, let
from adsieve.operators import chunking, evaluation, inspection, labels, spans
from adsieve.plans import pipeline
from adsieve.schemas import TAGS, TYPES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; documents and pages in fewer partitions than cores are dealt over all cores, since a small file is one task's."""
    found = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return found.repartition(cores) if name in ("documents", "pages") and found.rdd.getNumPartitions() < cores else found


# ---- payloads ---------------------------------------------------------------------------------

SPACE_RE2 = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
SYMBOLS = "---=== ☎x≤y 𝐀𝐚𝐳𝟘𝟬𝕏 é̂ \u0007 😀__-"
MARKED = [
    "[IMAGE-7] a [img_12]b", "<b>[xem THÊM]</b> ( ) [ ] {\t}", "[IMG-[IMAGE-1]2] [quảng cáo]", "[SHARE][Like] [COMMENTS] x", "[[AD]MENU] [loading]  y",
    "[FIG-3][SECTION-44] <a href='q'>z</a>", "no marker here",
]
NUMBERED = ["Giấy phép hoạt động: {}/syt-GPHĐ", "chứng chỉ  hành nghề {}/HCM/2", "Giấy phép hoạt động {}/HN", "Chứng chỉ hành nghề: {} / BYT", "GIẤY PHÉP HOẠT ĐỘNG: {}/SYT"]
ORGANISATIONS = [
    ("BV Chợ Rẫy", "Bệnh Viện Chợ Rẫy"), ("BVDK Tân Tạo", "Bệnh Viện Đa Khoa Tân Tạo"), ("BV TM Hana", "Bệnh Viện Thẩm Mỹ Hana"), ("Phòng khám PK ABC", "Phòng Khám Phòng Khám Abc"),
    ("BV NT Q7", "Bệnh Viện Nt Quận 7"), ("DHYD TPHCM", "Đại Học Y Dược Thành Phố Hồ Chí Minh"), ("BV Răng Hàm Mặt RHMM", "Bệnh Viện Răng Hàm Mặt Rhmm"),
    ("Phòng khám TMH Q1", "Phòng Khám Tai - Mũi - Họng Quận 1"), ("BV Tim TPHCM", "Bệnh Viện Tim Thành Phố Hồ Chí Minh"), ("Trung tâm PHCN", "Trung Tâm Phục Hồi Chức Năng"),
    ("BV CCHS 115", "Bệnh Viện Cấp Cứu Hồi Sức 115"), ("Bệnh viện Từ Dũ", "Bệnh Viện Từ Dũ"), ("BV Q.1", "Bệnh Viện Quận 1"), ("BVDK Q 10", "Bệnh Viện Đa Khoa Quận 10"),
]
PERSONS = [
    ("Bác sĩ Nguyễn Văn A", "Nguyễn Văn A"), ("BS. Trần Thị B", "Trần Thị B"), ("PGS.TS. Vũ Văn F", "Vũ Văn F"), ("CKII. Phạm Thị N", "Phạm Thị N"), ("CK1. Trần Minh O", "Trần Minh O"),
    ("Dr. John Smith", "John Smith"), ("Bác sĩ", "Bác Sĩ"), ("- Hồ Cao Vũ", "Hồ Cao Vũ"), (". Vũ", "Vũ"), ("trưởng khoa Lê Viết Văn", "Trưởng Khoa Lê Viết Văn"), ("Phó giáo sư X", "Phó X"),
]
ADDRESSES = [
    ("159 Pasteur, Quận 1, TP.HCM", True), ("12 Lê Lợi, Q.3, TPHCM", True), ("- 147 Nguyễn Du, Q.1", True), ("5 Trần Phú, Thủ Dầu Một", True), ("7 Thùy Vân, Vũng Tàu", True),
    ("987 Nam Kỳ Khởi Nghĩa", False), ("Quận 123, Hà Nội", True), ("FAQ 1, Đà Nẵng xx", True), ("quận Bình Thạnh", False), ("Hà Nội", False), ("12 lê lợi, q.3, tphcm", True), ("Q.1", True),
]


def pick(options: list[str], by: Column) -> Column:
    return F.get(F.array(*map(F.lit, options)), by.cast("int"))


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_list(options: list[str]) -> str:
    return "[" + ", ".join(map(sql_text, options)) + "]"


def ruled_tags(i: Column) -> tuple[Column, Column]:
    """The gold and the predicted tag of a document's token ``i``."""
    d, i = F.col("doc_id"), i.cast("long")
    gold = F.pmod(d * 31 + i * i * 7 + F.floor(d / 3) * i, F.lit(11))
    predicted = F.when(F.pmod(d * 13 + i * 5, F.lit(6)) == 0, F.pmod(gold + 3, F.lit(11))).otherwise(gold)
    return tuple(F.coalesce(pick(TAGS, c), F.lit("O")) for c in (gold, predicted))


def token_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, chunk_id, i, gold, predicted): tags by rule, 14 for every document and one more for every 12 characters."""
    last = (F.floor(F.length("text") / 12) + 13).cast("int")
    each = table(spark, sf_dir, "documents").select("doc_id", F.lit(0).alias("chunk_id"), F.explode(F.sequence(F.lit(0), last)).alias("i"))
    gold, predicted = ruled_tags(F.col("i"))
    return each.select("doc_id", "chunk_id", "i", gold.alias("gold"), predicted.alias("predicted"))


TOKENS_SQL = f"""tokens AS (
  SELECT doc_id, i, coalesce({sql_list(TAGS)}[g + 1], 'O') AS gold,
         coalesce({sql_list(TAGS)}[CASE WHEN (doc_id * 13 + i * 5) % 6 = 0 THEN (g + 3) % 11 ELSE g END + 1], 'O') AS predicted
  FROM (SELECT doc_id, i::INT AS i, ((doc_id * 31 + i * i * 7 + (doc_id // 3) * i) % 11)::INT AS g FROM (SELECT doc_id, unnest(range(14 + length(text) // 12)) AS i FROM documents))
)"""


def tag_array(tokens: DataFrame, column: str) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("i", column)))
    return tokens.groupBy("doc_id").agg(F.transform(ordered, lambda t: t[column]).alias("tags"))


def repair_sql(source: str, column: str, name: str) -> str:
    """The three evaluation rules as CTEs name1, name2, name3 over ``source``."""
    ent = lambda c: f"coalesce({c} <> 'O', false)"
    lag, lead = "lag(t) OVER w", "lead(t) OVER w"
    over = "WINDOW w AS (PARTITION BY doc_id ORDER BY i)"
    return f"""{name}1 AS (SELECT doc_id, i, CASE WHEN t <> 'O' AND coalesce({lag}, 'O') = 'O' AND coalesce({lead}, 'O') = 'O' THEN 'O' ELSE t END AS t FROM (SELECT doc_id, i, {column} AS t FROM {source}) {over}),
{name}2 AS (SELECT doc_id, i, CASE WHEN t = 'O' AND {ent(lag)} AND {ent(lead)} AND substr({lag}, 3) = substr({lead}, 3) THEN 'I-' || substr({lag}, 3) ELSE t END AS t FROM {name}1 {over}),
{name}3 AS (SELECT doc_id, i, CASE WHEN t LIKE 'I-%' AND NOT ({ent(lag)} AND substr(coalesce({lag}, 'O'), 3) = substr(t, 3)) THEN 'B-' || substr(t, 3) ELSE t END AS t FROM {name}2 {over})"""


def start_repair_sql(source: str, column: str) -> str:
    return f"""SELECT doc_id, i, CASE WHEN {column} LIKE 'I-%' AND NOT coalesce(lag({column}) OVER w <> 'O' AND substr(lag({column}) OVER w, 3) = substr({column}, 3), false)
  THEN 'B-' || substr({column}, 3) ELSE {column} END AS t FROM {source} WINDOW w AS (PARTITION BY doc_id ORDER BY i)"""


def merge_sql(source: str) -> str:
    """Entities of (doc_id, i, t)."""
    return f"""SELECT doc_id, substr(t, 3) AS label, min(i) AS first_i, max(i) + 1 AS end_i, max(confidence) AS confidence
FROM (SELECT *, sum((t LIKE 'B-%')::INT) OVER w AS island, sum((t = 'O')::INT) OVER w AS gap FROM {source} WINDOW w AS (PARTITION BY doc_id ORDER BY i))
WHERE t <> 'O' GROUP BY doc_id, island, gap, substr(t, 3)"""


# ---- queries ----------------------------------------------------------------------------------


def phone_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.explode(phones(F.col("text"))).alias("phone"))


def html_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", collapse(strip_tags(F.col("html"))).alias("text"))


def clean_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    woven = F.concat("text", F.lit(SYMBOLS), F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", clean_text(woven).alias("cleaned"))


def weave(docs: DataFrame) -> DataFrame:
    by = F.col("doc_id") % len(MARKED)
    return docs.select("doc_id", F.concat(pick(MARKED, by), F.lit(" "), "text", F.lit(" "), pick(MARKED[::-1], by)).alias("text"))


def marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weave(table(spark, sf_dir, "documents"))


def crawl_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marked(spark, sf_dir).select("doc_id", remove_crawl_artifacts(F.col("text")).alias("cleaned"))


def crawl_clean_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", remove_crawl_artifacts(F.col("html")).alias("cleaned"))


def clean_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = marked(spark, sf_dir).select("text", remove_crawl_artifacts(F.col("text")).alias("cleaned"))
    sums = both.agg(F.count(F.lit(1)).alias("total_cells"), F.count_if(~F.col("text").eqNullSafe(F.col("cleaned"))).alias("changed_cells"))
    return sums.select("*", change_stats(F.col("total_cells"), F.col("changed_cells")).alias("change_percentage"))


def licence_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.lpad(F.col("doc_id").cast("string"), 5, "0")
    line = lambda shift: F.replace(pick(NUMBERED, (F.col("doc_id") + shift) % len(NUMBERED)), F.lit("{}"), number)
    found = table(spark, sf_dir, "documents").select("doc_id", licences(F.concat_ws(" ", line(0), "text", line(1), line(3))).alias("l"))
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"l.{k}").alias("numbers")) for k in ("operating_licenses", "medical_certificates")])
    return found.select("doc_id", F.explode(kinds).alias("k")).select("doc_id", "k.kind", F.explode("k.numbers").alias("number"))


def bio_fix1(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = token_tags(spark, sf_dir).withColumnRenamed("predicted", "label")
    return spans.repair_starts(tokens).select("doc_id", "i", F.col("label").alias("tag"))


def bio_fix1_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tag_array(token_tags(spark, sf_dir), "predicted")
    return found.select("doc_id", F.posexplode(tags.repair_starts(F.col("tags"))).alias("i", "tag"))


def bio_fix3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tag_array(token_tags(spark, sf_dir), "predicted")
    return found.select("doc_id", F.posexplode(tags.repair_all(F.col("tags"))).alias("i", "tag"))


def span_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions with extents of twelve characters (some of none) and confidences by rule; repaired for serving."""
    i = F.col("i")
    sure = (F.pmod(F.col("doc_id") * 17 + i * 29, F.lit(100)) / 100.0).alias("confidence")
    tokens = token_tags(spark, sf_dir).select("doc_id", "chunk_id", "i", (i * 12).alias("start"), (i * 12 + F.when(i % 9 == 5, 0).otherwise(12)).alias("end"), F.col("predicted").alias("label"), sure)
    return spans.repair_starts(spans.real_tokens(tokens))


def span_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text, tokens): the predictions of ``span_tokens`` before repair as an array in order, so that none leaves its document's row."""
    def one(i: Column) -> Column:
        end = i * 12 + F.when(i % 9 == 5, 0).otherwise(12)
        sure = F.pmod(F.col("doc_id") * 17 + i * 29, F.lit(100)) / 100.0
        return F.struct(i.alias("i"), (i * 12).alias("start"), end.alias("end"), ruled_tags(i)[1].alias("label"), sure.alias("confidence"))

    last = (F.floor(F.length("text") / 12) + 13).cast("int")
    tokens = let(F.coalesce(last, F.lit(-1)), lambda n: F.transform(F.filter(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), lambda i: i <= n), one))  # none of a null text
    return table(spark, sf_dir, "documents").select("doc_id", "text", tokens.alias("tokens"))


def span_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.merge_spans(span_tokens(spark, sf_dir)).select("doc_id", "label", "start", "end", "confidence")


def entities_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spans.by_type(spans.merge_spans(span_tokens(spark, sf_dir)))
    return found.select("doc_id", "label", "n", "first_start", F.round(F.aggregate("entities", F.lit(0.0), lambda s, e: s + e["confidence"]), 6).alias("confidence"))


def chunk_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = lambda s: F.size(F.split(s, " "))
    found = chunking.chunks(table(spark, sf_dir, "documents"), 120, chunking.by_lines, count)
    return found.select("doc_id", "chunk_id", "chunk_start", "chunk_end", F.md5("text").alias("text_md5"))


def synthetic_spans(text: Column) -> Column:
    """Spans by rule, four and one more for every 100 characters, all over the text; some lie beyond its end."""
    d = F.col("doc_id")

    def one(k: Column, n: Column) -> Column:
        k = k.cast("long")
        start = F.pmod(d * 7 + k * 137, n + 20)
        end = start + 1 + F.pmod(d + k * 11, F.lit(50))
        return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), F.lit("").alias("text"), F.array(pick(TYPES, k % 3)).alias("labels"))

    # the length is bound once: in the lambda, every span would count its text's characters anew
    return let(F.length(text), lambda n: F.transform(F.sequence(F.lit(0), (F.floor(n / 100) + 3).cast("int")), lambda k: one(k, n)))


SPANS_SQL = f"""spans AS (
  SELECT doc_id, text, k::INT AS k, s::INT AS s, (s + 1 + (doc_id + k * 11) % 50)::INT AS e, {sql_list(TYPES)}[(k % 3 + 1)::INT] AS label
  FROM (SELECT doc_id, text, k, (doc_id * 7 + k * 137) % (length(text) + 20) AS s FROM (SELECT doc_id, text, unnest(range(4 + length(text) // 100)) AS k FROM documents))
)"""


def label_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", synthetic_spans(F.col("text")).alias("label"))
    count = lambda s: F.size(F.split(s, " "))
    found = chunking.chunks(docs, 120, chunking.by_lines, count, labels="label")
    each = found.select("doc_id", "chunk_id", F.explode("label").alias("l"))
    return each.select("doc_id", "chunk_id", "l.start", "l.end", F.get("l.labels", F.lit(0)).alias("label"))


def char_bio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's character tags: how many are O, and a digest of all others with their places."""
    text = F.col("text")
    listed = lambda t: F.array_join(F.transform(t, lambda c: F.concat_ws(" ", c["pos"].cast("string"), c["tag"])), ",")
    told = lambda t: F.struct((F.length(text) - F.size(t)).cast("long").alias("n_outside"), F.md5(listed(t)).alias("tags_md5"))
    found = let(tags.entity_places(tags.label_runs(F.length(text), synthetic_spans(text))), told)
    return table(spark, sf_dir, "documents").select("doc_id", found.alias("f")).select("doc_id", "f.*")


def ner_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluation.scores(token_tags(spark, sf_dir), repair=True)
    return found.select("label", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1", "accuracy")])


def chosen(spark: SparkSession, sf_dir: str, options: list[str], how_many: int) -> DataFrame:
    """(doc_id, found): some of the options for each document, by rule."""
    items = [pick(options, (F.col("doc_id") * (k + 1) + k * 3) % len(options)) for k in range(how_many)]
    return table(spark, sf_dir, "documents").select("doc_id", F.array(*items).alias("found"))


def chosen_sql(options: list[str], how_many: int) -> str:
    return f"""chosen AS (SELECT doc_id, k::INT AS k, {sql_list(options)}[((doc_id * (k + 1) + k * 3) % {len(options)} + 1)::INT] AS name FROM documents, range({how_many}) t(k))"""


def region_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chosen(spark, sf_dir, [a for a, _ in ADDRESSES], 1).select("doc_id", F.get("found", F.lit(0)).alias("address"))
    return found.select("doc_id", "address", names.in_region(F.col("address")).alias("in_region"))


def addr_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chosen(spark, sf_dir, [a for a, _ in ADDRESSES], 6)
    return found.select("doc_id", F.posexplode(names.addresses(F.col("found"))).alias("pos", "address"))


def person_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chosen(spark, sf_dir, [p for p, _ in PERSONS], 1).select("doc_id", F.get("found", F.lit(0)).alias("raw"))
    return found.select("doc_id", names.clean_person(F.col("raw")).alias("person"))


def person_maximal(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chosen(spark, sf_dir, [p for p, _ in PERSONS], 6)
    return found.select("doc_id", F.explode(names.persons(F.col("found"))).alias("person"))


def org_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chosen(spark, sf_dir, [o for o, _ in ORGANISATIONS], 1).select("doc_id", F.get("found", F.lit(0)).alias("raw"))
    out = names.expand_abbreviations(F.col("raw"))
    return found.select("doc_id", out.alias("organisation"), names.is_telling(out).alias("telling"))


def highlight_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = spans.merge_spans(span_tokens(spark, sf_dir)).groupBy("doc_id").agg(F.collect_list(F.struct("start", "end", "label")).alias("entities"))
    docs = table(spark, sf_dir, "documents").join(merged, "doc_id", "left")
    found = inspection.segments(F.col("text"), F.coalesce("entities", F.array().cast(merged.schema["entities"].dataType)))
    return docs.select("doc_id", F.posexplode_outer(found).alias("pos", "s")).where("s IS NOT NULL").select("doc_id", "pos", "s.text", "s.label")


def token_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = span_tokens(spark, sf_dir).select("*", F.concat(F.lit("t"), F.col("i").cast("string")).alias("token"), F.col("i").alias("token_id"))
    return inspection.token_table(tokens)


def word_tagger():
    """A deterministic stand-in for a model: capitalised words make persons, words with digits addresses."""
    import re

    def tag(texts: list[str]) -> list[list[tuple[int, int, str, float]]]:
        out = []
        for text in texts:
            tokens, before = [], "O"
            for m in re.finditer(r"\S+\s*", text):
                word = m[0].strip()
                kind = "ADDR" if any(c.isdigit() for c in word) else "PER" if word.istitle() else "ORG" if word.isupper() else None
                label = "O" if kind is None else f"{'I' if before == kind else 'B'}-{kind}"
                before = kind
                tokens.append((m.start(), m.end(), label, 1.0))
            out.append(tokens)
        return out

    return tag


def training_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token labels of every chunk, for tokens of five characters of which every seventh has no extent."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", synthetic_spans(F.col("text")).alias("label"))
    made = labels.training_examples(labels.split(docs).drop("split"), 120, chunking.by_lines, lambda s: F.size(F.split(s, " ")))
    place = lambda n: lambda k: F.struct((k * 5).alias("start"), F.when(k % 7 == 3, k * 5).otherwise(F.least(k * 5 + 5, n)).alias("end"))
    offsets = let(F.length("text"), lambda n: F.transform(F.sequence(F.lit(0), F.floor((n - 1) / 5).cast("int")), place(n)))
    told = lambda ids: F.struct(F.size(ids).cast("long").alias("n_tokens"), F.size(F.filter(ids, lambda x: x > 0)).cast("long").alias("n_labelled"), F.md5(F.array_join(ids.cast("array<string>"), ",")).alias("labels_md5"))
    return labels.align(made, offsets).select("doc_id", "chunk_id", let(F.col("labels"), told).alias("l")).select("doc_id", "chunk_id", "l.*")


QUERIES = {
    f.__name__: f
    for f in (
        phone_extract, html_strip, clean_chars, crawl_clean, crawl_clean_pages, clean_stats, licence_extract, bio_fix1, bio_fix1_array, bio_fix3, span_merge, entities_by_type,
        chunk_pack, label_range_join, char_bio, ner_metrics, region_filter, addr_distinct, person_clean, person_maximal, org_expand, highlight_segments, token_table,
        training_examples,
    )
}

# ---- oracles ----------------------------------------------------------------------------------


def _collapse_sql(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '{SPACE_RE2}+', ' ', 'g'), '^ | $', '', 'g')"


# Fixed values, stated anew for the SQL so that it shares none with the engine: patterns, markers, symbols, alphabets.
PHONES_SQL = (
    r"(?:\+84|0084|0)[\s.-]?[13456789][\s.-]?(?:\d[\s.-]?){7}\d|02(?:\d[\s.-]?){8,9}|\(0\d{2,3}\)[\s.-]?(?:\d[\s.-]?){7}"
    r"|(?:1800|1900)[\s.-]?(?:\d[\s.-]?){4,6}|\((?:\+84|0084)\)[\s.-]?(?:\d[\s.-]?){8}\d"
)
NUMBER_SQL = lambda phrase: f"{phrase}(?::|{SPACE_RE2})*([0-9]{{2,7}}){SPACE_RE2}*/{SPACE_RE2}*([A-Za-z]+)(?:-[A-Za-zĐ]+)?(?:/[A-Za-z0-9]+)?"
LICENCE_SQL = NUMBER_SQL(f"[Gg]iấy{SPACE_RE2}*phép{SPACE_RE2}*hoạt{SPACE_RE2}*động")
CERTIFICATE_SQL = NUMBER_SQL(f"[Cc]hứng{SPACE_RE2}*chỉ{SPACE_RE2}*hành{SPACE_RE2}*nghề")
MARKERS_SQL = """IMAGE-#|IMG-#|image-#|IMAGE_#|IMG_#|image_#|VIDEO-#|VID-#|video-#|<>|AD|ADVERTISEMENT|SPONSORED|PROMO|Banner|banner|BANNER|TWEET|FACEBOOK|INSTAGRAM|SHARE|LIKE|FOLLOW
MENU|NAV|NAVIGATION|BREADCRUMB|HOME|BACK|NEXT|PREV|Previous|Continue|COMMENT|REPLY|COMMENTS|read more|Read More|read_more|show more|Show More|xem thêm|Xem thêm|XEM THÊM
CHART-#|TABLE-#|GRAPH-#|FIGURE-#|FIG-#|LOADING|Loading|loading|PLACEHOLDER|placeholder|Ảnh|ảnh|ẢNH|Hình|hình|HÌNH|Video|video|VIDEO|Quảng cáo|quảng cáo|QUẢNG CÁO
ITEM-#|ELEMENT-#|BLOCK-#|DIV-#|SECTION-#""".replace("\n", "|").split("|")
SYMBOLS_SQL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x{2190}-\x{21FF}\x{2200}-\x{22FF}\x{2300}-\x{23FF}\x{2500}-\x{27BF}\x{1F300}-\x{1F64F}\x{1F680}-\x{1F6FF}\x{1F900}-\x{1F9FF}]"
#: Thirteen starts; an alphabet's 51 characters fall on the code points from A on, the first digits' 49 on those from 0 on.
ALPHABETS_SQL = [(0x1D400, 51, 65), (0x1D7CE, 49, 48), *((0x1D434 + 52 * k, 51, 65) for k in range(10))]


def artifacts_sql(text: str) -> str:
    for m in MARKERS_SQL:
        pattern = "<[^>]+>" if m == "<>" else f"\\[{m.replace('#', '[0-9]+')}\\]"
        text = f"regexp_replace({text}, '{pattern}', '', 'gi')"
    text = _collapse_sql(f"regexp_replace({text}, '\\[{SPACE_RE2}*\\]', '', 'g')")
    for a, b in ("()", "[]", "{}"):
        text = f"regexp_replace({text}, '\\{a}{SPACE_RE2}*\\{b}', '', 'g')"
    return _collapse_sql(text)


def clean_sql(text: str) -> str:
    styled: dict[str, str] = {}
    for first, n, plain in ALPHABETS_SQL:
        for k in range(n):
            styled.setdefault(chr(first + k), chr(plain + k))
    dropped = f"regexp_replace(nfc_normalize(regexp_replace({text}, '[-=_]{{3,}}', '', 'g')), '{SYMBOLS_SQL}', '', 'g')"
    folded = f"translate({dropped}, {sql_text(''.join(styled))}, {sql_text(''.join(styled.values()))})"
    return f"regexp_replace({folded}, '[\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')"


MARKED_SQL = f"marked AS (SELECT doc_id, {sql_list(MARKED)}[(doc_id % {len(MARKED)} + 1)::INT] || ' ' || text || ' ' || {sql_list(MARKED[::-1])}[(doc_id % {len(MARKED)} + 1)::INT] AS text FROM documents)"
LINE_SQL = lambda shift: f"replace({sql_list(NUMBERED)}[((doc_id + {shift}) % {len(NUMBERED)} + 1)::INT], '{{}}', lpad(doc_id::VARCHAR, 5, '0'))"
SPAN_TOKENS_SQL = f"""{TOKENS_SQL},
real AS (SELECT doc_id, i, predicted, (doc_id * 17 + i * 29) % 100 / 100.0::DOUBLE AS confidence FROM tokens WHERE i % 9 <> 5),
served AS (SELECT r.doc_id, r.i, f.t, r.confidence FROM ({start_repair_sql('real', 'predicted')}) f JOIN real r USING (doc_id, i)),
merged AS ({merge_sql('served')}),
spans AS (SELECT doc_id, label, (first_i * 12)::INT AS start, (end_i * 12)::INT AS "end", confidence FROM merged)"""
CHUNKS_SQL = """lines AS (
  SELECT doc_id, text, line, n, (sum(length(line) + 1) OVER w - length(line) - 1)::INT AS s
  FROM (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents)
  WINDOW w AS (PARTITION BY doc_id ORDER BY n)
), parts AS (
  SELECT doc_id, text, s, s + length(line)::INT AS e, len(string_split(line, ' ')) AS tokens, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS r FROM lines WHERE line <> ''
), walk AS (
  SELECT doc_id, r, s, e, tokens AS held, 0 AS chunk_id FROM parts WHERE r = 1
  UNION ALL
  SELECT p.doc_id, p.r, p.s, p.e, CASE WHEN w.held + p.tokens <= 120 THEN w.held + p.tokens ELSE p.tokens END, w.chunk_id + (w.held + p.tokens > 120)::INT
  FROM walk w JOIN parts p ON p.doc_id = w.doc_id AND p.r = w.r + 1
), chunks AS (SELECT doc_id, chunk_id, min(s) AS chunk_start, max(e) AS chunk_end FROM walk GROUP BY ALL)"""
CHARS_SQL = lambda source: f"""valid AS (SELECT * FROM {source} WHERE s >= 0 AND e <= n AND s < n AND e > 0),
hit AS (SELECT doc_id, chunk_id, p::INT AS pos, s, k, label FROM valid, LATERAL (SELECT unnest(range(s, greatest(e, s + 1))) AS p)),
last AS (SELECT doc_id, chunk_id, pos, arg_max({{'s': s, 'label': label}}, [s, k]) AS top FROM hit GROUP BY ALL),
raw AS (SELECT doc_id, chunk_id, pos, CASE WHEN top.s = pos THEN 'B-' ELSE 'I-' END || top.label AS t FROM last),
near AS (SELECT *, lag(pos) OVER w AS before_pos, lag(t) OVER w AS before_t FROM raw WINDOW w AS (PARTITION BY doc_id, chunk_id ORDER BY pos)),
chars AS (SELECT doc_id, chunk_id, pos, CASE WHEN t LIKE 'I-%' AND NOT coalesce(before_pos = pos - 1 AND substr(before_t, 3) = substr(t, 3), false) THEN 'B-' || substr(t, 3) ELSE t END AS tag FROM near)"""  # noqa: E731
METRIC_SQL = lambda label, where: f"""SELECT '{label}' AS label, count(*) FILTER (g IS NOT NULL) AS gold, count(*) FILTER (p IS NOT NULL) AS predicted, count(*) FILTER (g IS NOT NULL AND p IS NOT NULL) AS hit FROM pairs WHERE {where}"""
ACCURACY_SQL = lambda label: f"SELECT '{label}' AS label, avg((CASE WHEN substr(g.t, 3) = '{label}' THEN g.t ELSE 'O' END = CASE WHEN substr(p.t, 3) = '{label}' THEN p.t ELSE 'O' END)::INT) AS accuracy FROM g3 g JOIN p3 p USING (doc_id, i)"


def metrics_sql() -> str:
    """The metrics of (doc_id, i, gold, predicted) in ``tokens``."""
    return f"""{repair_sql('tokens', 'gold', 'g')}, {repair_sql('tokens', 'predicted', 'p')},
ge AS ({merge_sql('(SELECT *, 1 AS confidence FROM g3)')}), pe AS ({merge_sql('(SELECT *, 1 AS confidence FROM p3)')}),
pairs AS (SELECT coalesce(ge.label, pe.label) AS label, ge.first_i AS g, pe.first_i AS p FROM ge FULL JOIN pe ON ge.doc_id = pe.doc_id AND ge.label = pe.label AND ge.first_i = pe.first_i AND ge.end_i = pe.end_i),
counts AS ({' UNION ALL '.join([METRIC_SQL('overall', 'true'), *(METRIC_SQL(t, f"label = '{t}'") for t in TYPES)])}),
acc AS (SELECT 'overall' AS label, avg((g.t = p.t)::INT) AS accuracy FROM g3 g JOIN p3 p USING (doc_id, i) UNION ALL {' UNION ALL '.join(map(ACCURACY_SQL, TYPES))}),
rates AS (SELECT label, coalesce(hit / nullif(predicted, 0), 0)::DOUBLE AS p, coalesce(hit / nullif(gold, 0), 0)::DOUBLE AS r FROM counts)
SELECT label, round(p, 9) AS precision, round(r, 9) AS recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0), 9) AS f1, round(accuracy, 9) AS accuracy FROM rates JOIN acc USING (label)"""


VALUES_SQL = lambda pairs: ", ".join(f"({sql_text(a)}, {sql_text(b) if isinstance(b, str) else str(b).lower()})" for a, b in pairs)

ORACLE_SQL = {
    "phone_extract": f"""
WITH raw AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '{PHONES_SQL}')) AS r FROM documents
), digits AS (SELECT doc_id, regexp_replace(r, '[^0-9]', '', 'g') AS d FROM raw),
once AS (SELECT doc_id, CASE WHEN d LIKE '84%' THEN '0' || substr(d, 3) ELSE d END AS d FROM digits)
SELECT DISTINCT doc_id, CASE WHEN d LIKE '0084%' THEN '0' || substr(d, 5) ELSE d END AS phone
FROM once WHERE d <> ''""",
    "html_strip": f"SELECT page_id, {_collapse_sql("regexp_replace(html, '<[^>]+>', '', 'g')")} AS text FROM pages",
    "clean_chars": f"SELECT doc_id, {clean_sql(f'text || {sql_text(SYMBOLS)} || doc_id')} AS cleaned FROM documents",
    "crawl_clean": f"WITH {MARKED_SQL} SELECT doc_id, {artifacts_sql('text')} AS cleaned FROM marked",
    "crawl_clean_pages": f"SELECT page_id, {artifacts_sql('html')} AS cleaned FROM pages",
    "clean_stats": f"""WITH {MARKED_SQL}, done AS (SELECT text, {artifacts_sql('text')} AS cleaned FROM marked)
SELECT count(*) AS total_cells, count(*) FILTER (text IS DISTINCT FROM cleaned) AS changed_cells, round(count(*) FILTER (text IS DISTINCT FROM cleaned) / count(*) * 100, 2) AS change_percentage FROM done""",
    "licence_extract": f"""
WITH woven AS (SELECT doc_id, concat_ws(' ', {LINE_SQL(0)}, text, {LINE_SQL(1)}, {LINE_SQL(3)}) AS t FROM documents),
found AS (
  SELECT doc_id, 'operating_licenses' AS kind, unnest(regexp_extract_all(t, '{LICENCE_SQL}', 1)) AS n, unnest(regexp_extract_all(t, '{LICENCE_SQL}', 2)) AS a FROM woven
  UNION ALL
  SELECT doc_id, 'medical_certificates', unnest(regexp_extract_all(t, '{CERTIFICATE_SQL}', 1)), unnest(regexp_extract_all(t, '{CERTIFICATE_SQL}', 2)) FROM woven
)
SELECT DISTINCT doc_id, kind, n || '/' || upper(a) AS number FROM found WHERE upper(a) IN ('HCM', 'SYT', 'BYT')""",
    "bio_fix1": f"WITH {TOKENS_SQL} SELECT doc_id, i, t AS tag FROM ({start_repair_sql('tokens', 'predicted')})",
    "bio_fix3": f"WITH {TOKENS_SQL}, {repair_sql('tokens', 'predicted', 'p')} SELECT doc_id, i, t AS tag FROM p3",
    "span_merge": f"WITH {SPAN_TOKENS_SQL} SELECT * FROM spans",
    "entities_by_type": f'WITH {SPAN_TOKENS_SQL} SELECT doc_id, label, count(*) AS n, min(start) AS first_start, round(sum(confidence), 6) AS confidence FROM spans GROUP BY doc_id, label',
    "chunk_pack": f"WITH RECURSIVE {CHUNKS_SQL} SELECT doc_id, chunk_id, chunk_start, chunk_end, md5(substr(text, chunk_start + 1, chunk_end - chunk_start)) AS text_md5 FROM chunks JOIN documents USING (doc_id)",
    "label_range_join": f"""WITH RECURSIVE {CHUNKS_SQL}, {SPANS_SQL}
SELECT doc_id, chunk_id, s - chunk_start AS start, e - chunk_start AS "end", label FROM spans JOIN chunks USING (doc_id) WHERE s >= chunk_start AND e <= chunk_end""",
    "char_bio": f"""WITH {SPANS_SQL}, {CHARS_SQL('(SELECT doc_id, text, s, e, k, label, 0 AS chunk_id, length(text) AS n FROM spans)')}
SELECT d.doc_id, (any_value(length(d.text)) - count(c.pos))::BIGINT AS n_outside, md5(coalesce(string_agg(c.pos || ' ' || c.tag, ',' ORDER BY c.pos), '')) AS tags_md5
FROM documents d LEFT JOIN chars c USING (doc_id) GROUP BY d.doc_id""",
    "training_examples": f"""WITH RECURSIVE {CHUNKS_SQL}, {SPANS_SQL},
placed AS (SELECT doc_id, chunk_id, chunk_end - chunk_start AS n, s - chunk_start AS s, e - chunk_start AS e, k, label FROM spans JOIN chunks USING (doc_id) WHERE s >= chunk_start AND e <= chunk_end),
{CHARS_SQL('placed')},
shown AS (SELECT doc_id, chunk_id, chunk_end - chunk_start AS n FROM chunks JOIN documents USING (doc_id) WHERE regexp_matches(substr(text, chunk_start + 1, chunk_end - chunk_start), '[^\\s\\x0b\\x1c-\\x1f\\x{{85}}\\p{{Z}}]')),
every AS (SELECT doc_id, chunk_id, unnest(range((n + 4) // 5)) AS i FROM shown),
inner_tags AS (SELECT doc_id, chunk_id, pos // 5 AS i, tag, count(*) AS times, min(pos) AS first FROM chars GROUP BY ALL),
best AS (SELECT doc_id, chunk_id, i, arg_min(tag, [CASE WHEN tag LIKE 'B-%' THEN 0 ELSE 1 END, CASE WHEN tag LIKE 'B-%' THEN 0 ELSE -times END, first]) AS tag FROM inner_tags GROUP BY ALL),
named AS (SELECT e.doc_id, e.chunk_id, e.i, coalesce(tag, 'O') AS t FROM every e LEFT JOIN best b ON b.doc_id = e.doc_id AND b.chunk_id = e.chunk_id AND b.i = e.i WHERE e.i % 7 <> 3),
mended AS (SELECT doc_id, chunk_id, i, CASE WHEN t LIKE 'I-%' AND (coalesce(lag(t) OVER w, 'O') = 'O' OR substr(lag(t) OVER w, 3) <> substr(t, 3)) THEN 'B-' || substr(t, 3) ELSE t END AS t FROM named WINDOW w AS (PARTITION BY doc_id, chunk_id ORDER BY i)),
ids AS (SELECT e.doc_id, e.chunk_id, e.i, coalesce(list_position({sql_list(TAGS)}, t) - 1, -100) AS id FROM every e LEFT JOIN mended m ON m.doc_id = e.doc_id AND m.chunk_id = e.chunk_id AND m.i = e.i)
SELECT doc_id, chunk_id, count(*) AS n_tokens, count(*) FILTER (id > 0) AS n_labelled, md5(string_agg(id::VARCHAR, ',' ORDER BY i)) AS labels_md5 FROM ids GROUP BY ALL""",
    "ner_metrics": f"WITH {TOKENS_SQL}, {metrics_sql()}",
    "region_filter": f"WITH {chosen_sql([a for a, _ in ADDRESSES], 1)} SELECT doc_id, name AS address, hit AS in_region FROM chosen JOIN (VALUES {VALUES_SQL(ADDRESSES)}) v(a, hit) ON a = name",
    "addr_distinct": f"""WITH {chosen_sql([a for a, _ in ADDRESSES], 6)},
fit AS (SELECT doc_id, k, name, row_number() OVER (PARTITION BY doc_id, lower(name) ORDER BY k) AS r FROM chosen JOIN (VALUES {VALUES_SQL(ADDRESSES)}) v(a, hit) ON a = name WHERE hit AND length(name) >= 10)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1)::INT AS pos, name AS address FROM fit WHERE r = 1""",
    "person_clean": f"WITH {chosen_sql([p for p, _ in PERSONS], 1)} SELECT doc_id, clean AS person FROM chosen JOIN (VALUES {VALUES_SQL(PERSONS)}) v(raw, clean) ON raw = name",
    "person_maximal": f"""WITH {chosen_sql([p for p, _ in PERSONS], 6)},
clean AS (SELECT DISTINCT doc_id, clean AS person FROM chosen JOIN (VALUES {VALUES_SQL(PERSONS)}) v(raw, clean) ON raw = name)
SELECT doc_id, person FROM clean c WHERE NOT EXISTS (SELECT 1 FROM clean o WHERE o.doc_id = c.doc_id AND length(o.person) > length(c.person) AND contains(lower(o.person), lower(c.person)))""",
    "org_expand": f"WITH {chosen_sql([o for o, _ in ORGANISATIONS], 1)} SELECT doc_id, long AS organisation, true AS telling FROM chosen JOIN (VALUES {VALUES_SQL(ORGANISATIONS)}) v(short, long) ON short = name",
    "highlight_segments": f"""WITH {SPAN_TOKENS_SQL},
placed AS (SELECT d.doc_id, d.text, s.label, s.start AS a, least(s."end", length(d.text))::INT AS b, coalesce(lag(s."end") OVER (PARTITION BY d.doc_id ORDER BY s.start), 0) AS before_b
  FROM documents d JOIN spans s USING (doc_id)),
pieces AS (
  SELECT doc_id, a AS spot, 1 AS o, substr(text, a + 1, b - a) AS text, label FROM placed WHERE b > a
  UNION ALL SELECT doc_id, least(before_b, length(text)), 0, substr(text, before_b + 1, a - before_b), NULL FROM placed WHERE a > before_b
  UNION ALL SELECT d.doc_id, coalesce(m.b, 0), 2, substr(d.text, coalesce(m.b, 0) + 1), NULL FROM documents d LEFT JOIN (SELECT doc_id, max(b) AS b FROM placed GROUP BY doc_id) m USING (doc_id) WHERE coalesce(m.b, 0) < length(d.text)
)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY spot, o) - 1)::INT AS pos, text, label FROM pieces WHERE text <> ''""",
    "token_table": f"""WITH {SPAN_TOKENS_SQL}
SELECT doc_id, 1 AS chunk_no, i AS index, 't' || i AS token, i AS token_id, t AS predicted_tag, round(confidence, 4) AS confidence, CASE WHEN t <> 'O' THEN '✅' ELSE '' END AS is_entity FROM served""",
}
ORACLE_SQL["bio_fix1_array"] = ORACLE_SQL["bio_fix1"]
