"""The rules for names on every word of the documents' texts, and SQL that states the rules anew.

A text is cut into names of a few words each; heads and tails, dealt by rule, bring titles, abbreviations and places to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adsieve.functions import names
from adsieve.functions.text import let
from adsieve.plans.catalogue import SPACE_RE2, pick, sql_list, table

ADDRESS_HEADS = ["", "12 ", "- ", "Số 7/3 ", "\t5 "]
ADDRESS_TAILS = [
    ", Quận 1, TP.HCM", ", q.12", " Q3-", ", quận 1234", ", quận Bình  Thạnh", ", Q. Gò Vấp", ", H.Củ Chi", ", huyện Hóc Môn", ", BÌNH DƯƠNG", ", Hà Nội", ", sài gòn",
    ", Sài G", ", BRVT", ", Thủ Dầu  Một", ", Quận 10a", ", quận 0", ", Q.7/", "", ", Ba Ria Vung Tau ", ", quận 9", " quận 5", ", Hồ Chí Min", ", dĩ  an", ", huyện Nhà　Bè", ", Đà Nẵng",
]
ORGANISATION_HEADS = ["", "BV ", "bvđk ", "PK. ", "TTYT ", "Cty TNHH ", "Cty CP ", "BVX ", " ĐHY ", "(TM) ", "", "RH-", "TP. ", "TP.x ", "tkb_ "]
ORGANISATION_TAILS = ["", " TPHCM", " Tp. Hồ  Chí Minh", " Q.10", " q 3a", " TW", " tp.", " TP", "", " PHCN ", " QT HCM", " Q.7-CCHS"]
PERSON_HEADS = [
    "", "Bác sĩ ", "BS. ", "PGS.TS. ", "ThS.BS ", "chuyên khoa II ", "CK1. ", "Dr.", "Ms ", "Giám  đốc ", "Phó giáo sư ", "BSCC. ", "(Y tá) ", "bs", "ktv_", "Điều dưỡng ", "Professor ", "1. ",
]
PERSON_TAILS = ["", ", CKII", " (TS)", " 0918", " gđ.", " - Thầy thuốc", " TT.X", "!"]


def cut_names(spark: SparkSession, sf_dir: str, heads: list[str], tails: list[str], size: int) -> DataFrame:
    """(doc_id, k, name): every ``size`` words of a text, the last ones fewer, with a head and a tail by rule; texts without words give none."""
    d = F.col("doc_id")

    def laid(own: Column) -> Column:
        one = lambda k: F.concat(pick(heads, (d + k) % len(heads)), F.array_join(F.slice(own, k * size + 1, F.lit(size)), " "), pick(tails, (d * 3 + k) % len(tails)))
        return F.when(F.size(own) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(own) - 1) / size).cast("int")), one))

    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(let(words, laid)).alias("k", "name"))


def text_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 on addresses of four words."""
    found = cut_names(spark, sf_dir, ADDRESS_HEADS, ADDRESS_TAILS, 4)
    return found.select("doc_id", "k", F.col("name").alias("address"), names.in_region(F.col("name")).alias("in_region"))


def text_organisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7, P8, P14 on organisations of two words."""
    found = cut_names(spark, sf_dir, ORGANISATION_HEADS, ORGANISATION_TAILS, 2).select("doc_id", "k", names.expand_abbreviations(F.col("name")).alias("organisation"))
    return found.select("*", names.is_telling(F.col("organisation")).alias("telling"))


def text_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6, P13, P14, P16 on persons of three words."""
    found = cut_names(spark, sf_dir, PERSON_HEADS, PERSON_TAILS, 3).select("doc_id", "k", names.clean_person(F.col("name")).alias("person"))
    return found.select("*", names.is_person(F.col("person")).alias("is_person"))


QUERIES = {f.__name__: f for f in (text_regions, text_organisations, text_persons)}

# ---- oracles ----------------------------------------------------------------------------------

# Fixed values, stated anew for the SQL: regions (a space is optional white space).
REGIONS_SQL = [
    "h[ồô] ch[íi] minh", "ho chi minh", "hcm", "sài g[òon]", "(quận_|q [.]? )[1-9]([0-9]{1,2})?(_|$|[,.-]|/)", "(quận|q [.]? )(bình thạnh|tân bình|gò vấp|phú nhuận|tân phú|bình tân)",
    "thủ đức", "(huyện|h [.]? )(củ chi|hóc môn|bình chánh|nhà bè|cần giờ)", "b[ìi]nh d[ươuong]", "thủ dầu một", "dĩ an", "thuận an", "tân uyên", "bến cát",
    "(huyện|h [.]? )(bàu bàng|dầu tiếng|phú giáo|bắc tân uyên)", "b[àa] r[ịi]a v[ũu]ng t[àa]u", "brvt", "vũng tàu", "bà rịa", "phú mỹ", "(huyện|h [.]? )(châu đức|xuyên mộc|đất đỏ|tân thành|long điền)", "côn đảo",
]
# Titles, each step's alternatives; a full stop is one that a word follows at once.
TITLES_SQL = [
    ["bác sĩ?", "bs."], ["cử nhân", "cn."], ["thạc sĩ?", "ths."], ["tiến sĩ?", "ts."], ["giáo sư", "gs."], ["phó giáo sư", "pgs."], ["chuyên khoa [i1]", "cki.", "ck1."], ["chuyên khoa (ii|2)", "ckii.", "ck2."],
    ["chuyên gia"], ["bscc."], ["dr.", "doctor"], ["prof.", "professor"], ["mr.", "mrs.", "ms.", "miss."], ["dược sĩ?", "ds."], ["y tá", "điều dưỡng"], ["kỹ thuật viên", "ktv."], ["thầy thuốc", "tt."], ["giám đốc", "gd.", "gđ."],
]
# Abbreviations that are whole words, and what they stand for; two that aren't stand between.
SHORT_SQL = [
    ("bvdk", "bệnh viện đa khoa"), ("bvđk", "bệnh viện đa khoa"), ("bv", "bệnh viện"), ("dk", "đa khoa"), ("đk", "đa khoa"), ("ttyt", "trung tâm y tế"), ("pk", "phòng khám"), ("tm", "thẩm mỹ"), ("tw", "trung ương"),
    ("qt", "quốc tế"), ("đhyd?", "đại học y dược"), ("dhyd?", "đại học y dược"), ("tkb", "tai - mũi - họng"), ("tmh", "tai - mũi - họng"), ("rhm?", "răng - hàm - mặt"), ("phcn", "phục hồi chức năng"), ("cchs", "cấp cứu hồi sức"),
    (f"tp(\\x01[.]?{SPACE_RE2}*\\x01)?(hồ chí minh|hcm)", "thành phố hồ chí minh"), (None, None), ("hcm", "hồ chí minh"), (f"q(?:\\x01[.]?{SPACE_RE2}*\\x01)?([0-9]+)", "quận \\1"),
    ("cp", "cổ phần"), ("cty", "công ty"), ("tnhh", "trách nhiệm hữu hạn"),
]


def strip_sql(text: str) -> str:
    return f"regexp_replace({text}, '^{SPACE_RE2}+|{SPACE_RE2}+$', '', 'g')"


def collapse_sql(text: str) -> str:
    return f"trim(regexp_replace({text}, '{SPACE_RE2}+', ' ', 'g'), ' ')"


def title_sql(text: str) -> str:
    """A first letter ß becomes Ss, for which the SQL engine has a capital of its own."""
    return f"array_to_string(list_transform(string_split(lower({collapse_sql(text)}), ' '), lambda w: replace(upper(w[1]), 'ẞ', 'Ss') || w[2:]), ' ')"


def replaced_sql(text: str, pattern: str, by: str) -> str:
    """Replace, where \\x01 in a pattern is a word's begin or end, in any script (RE2 knows ASCII words only)."""
    fenced = f"regexp_replace({text}, '([\\p{{L}}\\p{{M}}\\p{{N}}_]+)', chr(1) || '\\1' || chr(1), 'g')"
    return f"replace(regexp_replace({fenced}, '{pattern}', '{by}', 'gi'), chr(1), '')"


def joined(words: str) -> str:
    return words.replace(" ", f"(?:\\x01{SPACE_RE2}+\\x01)?")


def long_sql(text: str) -> str:
    for short, long in SHORT_SQL:
        text = replaced_sql(text, f"\\x01{joined(short)}\\x01", long) if short else replaced_sql(text, f"\\x01tp\\x01[.]?({SPACE_RE2}|$)", "thành phố\\1")
    return text


def untitled_sql(text: str) -> str:
    for step in TITLES_SQL:
        each = "|".join(joined(t.removesuffix(".")) + ("\\x01(?:[.]\\x01)?" if t.endswith(".") else "\\x01") for t in step)
        text = strip_sql(replaced_sql(text, f"\\x01(?:{each}){'' if step == ['bscc.'] else SPACE_RE2 + '*'}", ""))
    return text


def cut_sql(heads: list[str], tails: list[str], size: int) -> str:
    return rf"""listed AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM documents),
cut AS (SELECT doc_id, ws, unnest(range((len(ws) + {size - 1}) // {size})) AS k FROM listed),
named AS (SELECT doc_id, k::INT AS k, {sql_list(heads)}[((doc_id + k) % {len(heads)} + 1)::INT] || array_to_string(ws[k * {size} + 1 : k * {size} + {size}], ' ') || {sql_list(tails)}[((doc_id * 3 + k) % {len(tails)} + 1)::INT] AS name FROM cut)"""


REGION_SQL = "|".join(REGIONS_SQL).replace(" ", f"{SPACE_RE2}*").replace("quận_", f"quận{SPACE_RE2}+").replace("(_|", f"({SPACE_RE2}|")
LETTERS_SQL = SPACE_RE2.replace("[", "[^a-zA-ZÀ-ỹ", 1)

ORACLE_SQL = {
    "text_regions": f"WITH {cut_sql(ADDRESS_HEADS, ADDRESS_TAILS, 4)} SELECT doc_id, k, name AS address, regexp_matches({strip_sql('name')}, '{REGION_SQL}', 'i') AS in_region FROM named",
    "text_organisations": f"""WITH {cut_sql(ORGANISATION_HEADS, ORGANISATION_TAILS, 2)},
spelt AS (SELECT doc_id, k, name, {long_sql(strip_sql('lower(name)'))} AS long FROM named),
titled AS (SELECT doc_id, k, CASE WHEN {collapse_sql('long')} = '' THEN name ELSE {title_sql('long')} END AS organisation FROM spelt),
worded AS (SELECT *, list_filter(string_split({collapse_sql('organisation')}, ' '), lambda w: w <> '') AS ws FROM titled)
SELECT doc_id, k, organisation, len(ws) > 3 OR len(list_filter(ws, lambda w: length(w) >= 3)) > 0 AS telling FROM worded""",
    "text_persons": f"""WITH {cut_sql(PERSON_HEADS, PERSON_TAILS, 3)},
given AS (SELECT doc_id, k, {strip_sql('name')} AS g FROM named), bare AS (SELECT doc_id, k, g, {collapse_sql(untitled_sql('g'))} AS b FROM given),
clean AS (SELECT doc_id, k, regexp_replace(CASE WHEN b = '' THEN g ELSE b END, '{LETTERS_SQL}+', ' ', 'g') AS c FROM bare), titled AS (SELECT doc_id, k, {title_sql('c')} AS person FROM clean)
SELECT doc_id, k, person, length(person) >= 2 AND regexp_matches(person, '[a-zA-ZÀ-ỹ]') AS is_person FROM titled""",
}
