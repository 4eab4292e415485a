"""Name rules on values cut out of texts, against SQL that states them anew."""

import duckdb
import pytest

from pyspark.sql import functions as F

from adsieve.functions import names
from adsieve.functions.text import collapse, strip
from adsieve.plans import texts

TEXTS = [
    (1, "BS. Nguyễn Văn A ở TP. HCM và BV Chợ Rẫy"), (2, ""), (3, None), (4, " \n\t "), (5, "x"), (6, "đi Q.3 ko an tp. tphcm tp.hcm q 12 q12a cty-cp"), (7, "of by to in at on is an"),
    (7, "of by to in at on is an"), (8, "Pgs.Ts.bs lê tt.b mr mrs. miss.c chuyên khoa 2 chuyênkhoa1 giáo sư phó"), (9, "sài gòn thủ đức " * 400), (None, "bác sĩ không tên"),
]


def rows_of(found, columns):
    return sorted(map(tuple, found[columns].astype(object).where(found[columns].notna(), None).values.tolist()), key=repr)


@pytest.mark.parametrize("query", texts.QUERIES)
@pytest.mark.parametrize("own", [True, False])
def test_rules_on_texts_equal_sql(spark, tmp_path, query, own):
    folder = "/root/testdata/sf0.001"
    if own:
        folder = str(tmp_path)
        spark.createDataFrame([(*row, "x") for row in TEXTS], "doc_id long, text string, name string").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    found = texts.QUERIES[query](spark, folder)
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet{'/*.parquet' if own else ''}'")
        want = con.execute(texts.ORACLE_SQL[query]).df()
    got = found.toPandas()
    if own:  # a document without an id has neither head nor tail, so no names
        want, got = (t[t["doc_id"].notna() & t.iloc[:, 2].notna()] for t in (want, got))
        want["doc_id"] = want["doc_id"].astype(int)
        got["doc_id"] = got["doc_id"].astype(int)
    assert rows_of(got, found.columns) == rows_of(want, found.columns)
    assert set(got[found.columns[3]]) == {True, False}
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


def test_a_look_at_the_first_character_lets_all_through_that_a_pattern_matches(spark):
    """Patterns with the look before them find what they find without it, whatever the case."""
    from adsieve.functions import names

    cases = texts.ADDRESS_TAILS + texts.ORGANISATION_HEADS + texts.ORGANISATION_TAILS + texts.PERSON_HEADS + texts.PERSON_TAILS
    rows = spark.createDataFrame([(t,) for c in cases for t in (c, c.upper(), c.lower(), c.title(), c.replace("s", "ſ").replace("k", "K"))], "t string").persist()
    for flags, edge, patterns in (("(?iu)", "", ["|".join(names.REGIONS)]), ("(?iuU)", r"\b", [*names.TITLES, *(p for p, _ in names.ABBREVIATIONS)])):
        for each in patterns:
            plain = f"{edge}(?:{names._java(each)})"
            differ = F.regexp_replace("t", flags + plain, "|") != F.regexp_replace("t", flags + names._begun(each) + plain, "|")
            assert rows.where(differ).count() == 0, each
    rows.unpersist()


def in_turn(name):
    """The rule written plainly: every pattern in turn on the stripped name."""
    out = strip(F.lower(name))
    for short, long in names.ABBREVIATIONS:
        out = F.regexp_replace(out, f"(?iuU)\\b{names._java(short)}", long)
    return F.when(names.title_case(out) == "", name).otherwise(names.title_case(out))


def test_abbreviations_spelt_out_where_their_letters_stand_are_those_of_all_patterns_in_turn(spark):
    """On names of abbreviations, odd spaces and letters in all pairs; a pattern is behind a look for its first letters."""
    parts = ["BV", "bvđk.", "bvdk", "đk-dk", "TTYT", "pk_", "Tm", "tw(", "qt", "ĐHYD", "đhy", "dhyd1", "TKB", "tmh", "rhm", "RH", "phcn", "cchſ", "CCHS", "tp", "TP.", "tp.HCM", "tp　hồ  chí\tmınh", "hcm", "q", "q. 7", "Q10a", "cp", "Cty", "tnhh", "Kh", "İq", "", "\x1c", "x", "ba ab"]
    rows = spark.createDataFrame([(f"{a}{s}{b}",) for a in parts for b in parts for s in (" ", ".", "  ", "")] + [(None,)], "name string")
    told = rows.select("name", names.expand_abbreviations(F.col("name")).alias("got"), in_turn(F.col("name")).alias("want"))
    assert [tuple(r) for r in told.where(~F.col("got").eqNullSafe(F.col("want"))).collect()] == []
    words = F.filter(F.split(collapse(F.col("name")), " "), lambda w: w != "")
    plainly = (F.size(words) > 3) | F.exists(words, lambda w: F.length(w) >= 3)
    assert rows.where(~names.is_telling(F.col("name")).eqNullSafe(plainly)).count() == 0
    plan = rows.select(names.expand_abbreviations(F.col("name")))._jdf.queryExecution().analyzed().toString()
    assert plan.lower().count("contains(") > len(names.ABBREVIATIONS)


def test_only_long_s_and_dotless_i_stand_for_letters_that_are_looked_for(spark):
    """Of all characters in small letters, no other matches an ASCII letter or đ without being it."""
    letters = "".join(sorted(set("".join(names._surely(short) for short, _ in names.ABBREVIATIONS))))
    every = spark.range(1, 0x110000).where("id < 55296 OR id > 57343").select(F.lower(F.decode(F.encode(F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')"), "UTF-8"), "UTF-8")).alias("c"))
    assert every.where(F.col("c").rlike(f"(?iuU)[{letters}]") & ~F.col("c").rlike(f"[{letters}]")).count() == 0
    assert not set("si") & set(letters)
