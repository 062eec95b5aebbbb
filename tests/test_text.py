import pytest
from pyspark.sql import functions as F

from chronoloom.functions import text as X


def one(spark, fn, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(fn(F.col("c")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "fn,given,wanted",
    [
        (X.split_sentences, "甲。乙！丙", ["甲。", "乙！", "丙"]),
        (X.split_sentences, "a. b! c", ["a. b!", "c"]),
        (X.split_sentences, "  　", []),
        (X.split_sentences, None, None),
        (X.news_sentences, "甲。\n乙；丙\n\n", ["甲。", "乙；", "丙"]),
        (X.collect_sentences, "a\n\nb。c", ["a", "b。", "c"]),
        (X.lexical_tokens, "台海 A1", ["台", "海", "台海", "a1"]),
        (X.token_estimate, "台海。A1", 5),
        (X.token_estimate, " ", 0),
        (X.token_estimate, None, 0),
        (X.strip, "　 a b\t\x1f", "a b"),
        (X.squeeze, " a 　\n b ", "a b"),
        (X.alias_key, " PLA　", "pla"),
        (X.alias_key, "", ""),
        (X.alias_key, None, None),
        (X.hash8, "解放军", "33045d8f"),
        (X.normalize_raw_news, "﻿a \r\nb\r\n\n\n\nc　", "a\nb\n\nc"),
        (X.clean_characters, "”甲[12]乙[ ]  丙 ，丁\n\n [注 3-5]戊", "甲乙 丙，丁\n戊"),
        (X.file_doc_id, "EC12+A-b 题.txt", "ec12_plus_a_b_" + "7"),
        (X.same_sentence_key, "“甲乙。”", "甲乙"),
        (X.fold, "ＡＢ銅門Ｃ", "ab铜门c"),
        (X.safe_file_name, " a/b:c.. ", "a_b_c"),
        (X.safe_file_name, "..", "untitled"),
    ],
)
def test_text(spark, fn, given, wanted):
    got = one(spark, fn, given)
    if fn is X.file_doc_id:
        assert got.startswith("ec12_plus_a_b_") and len(got) == len("ec12_plus_a_b_") + 8
    else:
        assert got == wanted


def test_rule_hits_and_words(spark):
    hits = one(spark, X.character_hits, "”甲[12]乙[ ]\n\n丙 ，[3]")
    assert hits == {"citation_bracket": 2, "empty_bracket": 1, "leading_quote": 1, "space_before_mark": 1, "blank_line": 1}
    fn = lambda c: X.apply_word_rules(c, [("旧名", "新名")], ["会议"], [("^旧", "原")])
    assert one(spark, fn, "旧名一\n旧会议\n旧事") == "新名一\n原会议\n旧事"


def test_titles_and_codes(spark):
    p = lambda t: tuple(one(spark, X.title_parts, t))
    assert p("M038 中线（2022.8）") == ("M038 中线", "2022.8", False)
    assert p("M003 未闭合（2024") == ("M003 未闭合（2024", None, True)
    assert p("甲＜乙＞") == ("甲", None, False)
    assert tuple(one(spark, X.news_code, "d001 x.txt")) == ("D", 1)
    assert one(spark, X.news_code, "D0012.txt") is None


def test_long_text(spark):
    assert len(one(spark, X.split_sentences, "甲乙。" * 200_000)) == 200_000
