from collections import Counter

from adsieve.llm import line_quality as lq

SCHEMA = "doc_id long, text string, kept string, n_chars long"


def plain_repeats(words, size=8):
    seen = Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    hit = set()
    for i in range(len(words) - size + 1):
        if seen[tuple(words[i : i + size])] > 1:
            hit |= set(range(i, i + size))
    return len(hit)


def test_repeated_words():
    base = [b"a", b"b", b"c", b"d", b"e", b"f", b"g", b"h", b"i"]
    for words in ([], base, base * 2, [b"x"] * 30, base + [b"z"] + base, (base[:3] * 9) + base):
        assert lq.repeated_words(words) == plain_repeats(words)


def test_lines():
    fails = lambda s: lq.line_failure(s.encode(), s.encode().split())
    assert fails("A whole sentence stands here.") is None
    assert fails("He said “stop.”") is None
    assert fails("Home | News | Contact | About.") == "navigation"
    assert fails("Read more") == "navigation"
    assert fails("a line of several words without an end") == "punctuation"
    assert fails("a### b$$$ c.") == "symbols"
    assert fails("All Rights Reserved by the owner.") == "boilerplate"


def test_marks_of_several_bytes():
    fails = lambda s: lq.line_failure(s.encode(), s.encode().split())
    for end in "рÀæ”’»€âÂ":  # they share bytes with the ellipsis or the closing quotes
        assert fails(f"a line of several words ends in {end}") == fails(f"one{end} two three four five") == "punctuation"
        assert fails(f"one two three four five.{end}") == (None if end in "”’»" else "punctuation")
    for end in ("…", "…”", "!»", "?’)", ".»”\"]"):
        assert fails(f"a line of several words ends{end}") is fails(f"one two{end} three four five") is None


def test_cases(spark):
    good = "\n".join(f"Sentence number {i} has some words of its own, {i * 7}." for i in range(6))
    half = good + "\n" + "\n".join("no end of line at all here %d" % i for i in range(40))
    rows = [(1, None, "x", 0), (2, "", "x", 0), (3, good, "x", 0), (3, good, "x", 0), (4, half, "x", 0), (None, good, None, None), (5, "wörd " * 30, "x", 0)]
    got = lq.judge(spark.createDataFrame(rows, SCHEMA)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 7 and by[1].n_words == by[2].n_words == 0 and by[1].base_failed and not by[1].kept
    assert by[3].kept and by[3].n_failed_lines == 0 and by[None].kept
    assert not by[4].kept and not by[4].base_failed
    assert by[5].word_chars == 120 and by[5].n_repeat_words == 30 and by[5].base_failed
    cleaned = lq.clean(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0) for r in cleaned) == [0, 3, 3]
    assert all(r.text == good and r.n_chars == len(good) for r in cleaned)


SOUND = {
    "zh": "这家 医院 今天 开门 了 。 医生 们 都 很 忙 ， 病人 也 很 多 。 我们 明天 再 来 看 看 吧 。 谢谢 大家 的 帮助 。",
    "ja": "今日は 天気が とても 良い です。 私は 駅まで 歩いて 行き ました。 それから 友達と 昼ご飯を 食べ て、 夜は 家で 本を 読み、 早く 寝ました。 明日も 同じ 予定 です 。 多分",
    "hi": "यह अस्पताल आज सुबह आठ बजे खुला । सभी डॉक्टर काम में लगे थे । बहुत से मरीज़ आए और वे शाम तक बैठे रहे । कल फिर आएँगे।",
    "ar": "هل فتح المستشفى أبوابه صباح اليوم أم لا؟ نعم فتح في الساعة الثامنة وكان جميع الأطباء مشغولين جدا مع المرضى الذين جاؤوا من القرى البعيدة اليوم؟",
    "th": "วันนี้ โรงพยาบาล เปิด แปด โมง เช้า หมอ ทุก คน งาน ยุ่ง มาก มี คนไข้ มา จาก ต่าง จังหวัด เยอะ พรุ่งนี้ เรา จะ มา ใหม่ อีก ครั้ง",
    "am": "ዛሬ ሆስፒታሉ በጠዋት ተከፈተ ሐኪሞቹ ሁሉ በሥራ ተጠምደው ነበር ብዙ ሕሙማንም ከሩቅ አገር መጥተው ነበር ነገ እንደገና እንመጣለን ለሁሉም እናመሰግናለን ደህና ሁኑ ወዳጆቻችን በሰላም ግቡ እንግዲህ።",
    "vi": "Hôm nay phòng khám mở cửa từ rất sớm và các bác sĩ đều bận. Ngày mai chúng tôi sẽ quay lại để gặp họ một lần nữa nhé.",
}


def test_sound_texts_of_seven_scripts_are_kept(spark):
    rows = [(k, t, lang, 0) for k, (lang, t) in enumerate(SOUND.items())]
    got = lq.judge(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 7 and all(r.kept and not r.base_failed and r.n_failed_lines == 0 for r in got)
    unsound = [(k, t.translate({ord(c): None for c in ".!?" + lq.MARKS + lq.WIDE_MARKS}), lang, 0) for k, (lang, t) in enumerate(SOUND.items()) if lang != "th"]
    assert not any(r.kept for r in lq.judge(spark.createDataFrame(unsound, SCHEMA)).collect())


def test_empty(spark):
    assert lq.judge(spark.createDataFrame([], SCHEMA)).count() == 0
