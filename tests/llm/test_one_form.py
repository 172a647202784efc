import random
import sys
import unicodedata

from data import audit, one_form
from pyspark.sql import functions as F

from voxloom.llm import one_form as O
from voxloom.llm import unicode_tables as U


def forms(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumn("form_x", F.lit(1))
    return [r.form for r in O.with_one_form(df, "text").orderBy("i").collect()]


def test_every_character(spark):
    texts = [f"a{chr(c)} {chr(c)}b" for c in range(1, sys.maxunicode + 1) if unicodedata.category(chr(c)) not in ("Cs", "Cn", "Co") and (c < 0x3400 or 0xA000 <= c < 0xAC00 or 0xF900 <= c < 0x10800 or c % 97 == 0)]
    for t, got in zip(texts, forms(spark, texts), strict=True):
        assert got == one_form(t), t.encode("unicode_escape")


def test_random_sequences(spark):
    rnd = random.Random(3)
    pool = ["a", "e", "ɛ", "Ǹ", "о", "е", "ж", "σ", "ε", "́", "̀", "̣", "̃", "​", " ", "­", "Ａ", "ﬂ", "’", "ᄀ", "ᅡ", "ᆨ", "가", "ก", "ำ", "̈́", "ẛ", " ", "\n", "ো", "ে", "া", "𝅗𝅥", "Ω", "ﾊ", "ﾞ", "٠"]
    texts = ["".join(rnd.choices(pool, k=rnd.randrange(1, 25))) for _ in range(3000)]
    for t, got in zip(texts, forms(spark, texts), strict=True):
        assert got == one_form(t), t.encode("unicode_escape")


def test_nulls_empties_and_long_texts(spark):
    long = "é о́a​ " * 20_000
    assert forms(spark, [None, "", "   ", "​", "​  ", long, long]) == [None, "", "", "", "", ("é óa " * 20_000).strip(), ("é óa " * 20_000).strip()]
    assert forms(spark, []) == []


def test_the_one_form_is_stable(spark):
    texts = ["jεtegbi σασα оо", "n＇a dɛ́", "Ｄｒ. ﬁn"]
    once = forms(spark, texts)
    assert once == ["jɛtegbi σασα оо", "n'a dɛ́", "Dr. fin"] and forms(spark, once) == once


def test_compositions_are_bounded_and_marks_precede_no_first():
    seconds = {b for _, b in U.pairs()}
    assert max(len(unicodedata.normalize("NFD", c)) for c in U.pairs().values()) <= 4
    assert not [a for a, _ in U.pairs() if a in seconds and unicodedata.combining(a) == 0]


WORDS = "wa wb wc wd we wf wg wh wi é"


def test_pairs(spark):
    other = WORDS.replace("é", "é")
    rows = [
        (1, "train", WORDS, "A"), (2, "test", other, "A​"), (2, "test", other, "A​", "studio", None, 5.0, 3), (3, "train", WORDS, "A."), (4, "train", "wa é", "A​"), (5, "train", "wa é", "A"),
        (6, "train", None, "A"), (7, "train", "", None), (8, "validation", WORDS, None), (9, "test", WORDS, ""), (10, "test", other, "​"),
    ]
    got = sorted(tuple(r) for r in O.equal_looking_pairs(audit(spark, rows)).collect())
    want = [("text_normalized", a, b) for a, b in ((1, 2), (1, 10), (2, 3), (2, 8), (2, 9), (3, 10), (8, 10), (9, 10))] + [("text_raw", 1, 2), ("text_raw", 9, 10)]
    assert got == sorted(want)
    assert O.equal_looking_pairs(audit(spark, rows).filter("false")).count() == 0
