"""Sentences, token ids, leaked passages and residue."""

import base64
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chronoloom.llm import encoding as EN
from chronoloom.llm import leaks as LK
from chronoloom.llm import residue as RS
from chronoloom.llm.residue import residue
from chronoloom.llm.sentences import last_word, sentences, spans

CUTS = [
    ["A report by St. Mark was read.", "It rained."],
    ["The talks began at 9 a.m. and ended near 4.30 p.m. on the pier of St. Liteva.", "The meeting was set for 6 p.m.", "Two ships left."],
    ['"Why now?" asked Adm. Zadoza.', 'J. K. Rova told the panel: "About 9 vessels crossed."', "Then they left."],
    ["Buoy No. 40 drifted approx. 2.5 km, e.g. past Point Bay.", "See www.a.example/v2.1/index.html now!"],
    ["It cost 4 million... and nobody objected.", "Fine (see fig. 5. for details)."],
    ["The case X v. Y is over.", "He came on 9 June 2014.", "The rest stayed."],
    ["Laut Bericht Nr. 13 blieb es offen.", "Am 15. März kam er, z. B. über Land!"],
    ["甲称：“联络畅通！乙看到，丙清点。”", "《甲之问：谁在说谎？》一文由丁刊发。"],
    ["“当地渔民表示担忧。”甲发言人说。", "「乙。」丙人士表示，「丁。」", "「戊。」己说，庚没来。"],
    ["甲重新评估……乙担忧。", "丙（丁。）戊己！？", "庚；", "辛．", "1．5倍。"],
    ["「甲は延期した。」と担当者は述べた。", "乙だという（速報。詳細は後日）。"],
    ["다마타 군도는 계속된다.", "18.4% 늘었다."],
    ["डॉ. डोदक ने कहा।", "दिवटा गया!"],
    ["قال د. دممي إن الصيادين لم يتضرروا؟", "ارتفع بنسبة 58.9 في المئة۔", "طالب مجلس."],
    ["ดร.ขปูทกล่าวว่าไม่ได้รับผลกระทบ", "เรือเพิ่มขึ้นร้อยละ4.8", "สภาขอให้กลับมา"],
    ["甲在汀港设点Co. Ltd.在乙，耗资6.7亿元。", "No.8。"],
]


@pytest.mark.parametrize("parts", CUTS)
def test_boundaries(parts):
    glue = "" if "\u2e00" <= parts[0][0] <= "\u9fff" or parts[0][0] in "“「" else " "
    for joint in (glue, " " if glue else "\n\n"):
        text = " " + joint.join(parts) + "\n"
        assert [text[a:b] for a, b in spans(text)] == parts


def test_lines_and_edges(spark, cluttered):
    text = "标题（未闭\n\nThe ships\nleft. They\r\n \r\nNew start"
    assert [text[a:b] for a, b in spans(text)] == ["标题（未闭", "The ships\nleft.", "They", "New start"]
    assert spans(None) == spans("") == spans(" 　\n") == [] and spans("。") == [(0, 1)]
    assert last_word("หน่วยงานเมื่อ", ["เมื่อ", "ที่"]) == "เมื่อ" and last_word("", ["x"]) == ""
    long = "甲乙。" * 100_000 + "“" + "丙" * 100_000
    assert len(spans(long)) == 100_001
    df = spark.createDataFrame([(1, "甲。乙"), (1, "甲。乙"), (2, None), (3, ""), (4, "😀a. B")], "news_id long, normalized_text string")
    got = sorted(tuple(r) for r in sentences(cluttered(df), "news_id", "normalized_text").collect())
    assert got == [(1, 0, 2), (1, 2, 3), (4, 0, 3), (4, 4, 5)]
    assert sentences(df.where("false"), "news_id", "normalized_text").count() == 0


VOCABULARY = Path(EN.FOLDER) / "byte_bpe_50k.tiktoken"


def plain_merge(ranks, word):
    parts = [bytes([b]) for b in word]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: (ranks.get(parts[i] + parts[i + 1], 1 << 30), i))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return [ranks[p] for p in parts]


def small_vocabulary(path):
    """A vocabulary of its own: single bytes and some merges."""
    tokens = [bytes([b]) for b in range(256)] + [b"ab", b"abc", b"aa", b"aaa", b"bc", b"aaaa", b"cab", b"abab"]
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for i, t in enumerate(tokens)) + b"\n")
    return {t: i for i, t in enumerate(tokens)}


def test_queue_against_plain_merging(tmp_path):
    ranks = small_vocabulary(tmp_path / "v.tiktoken")
    e = EN.Encoder(str(tmp_path / "v.tiktoken"))
    rng = random.Random(3)
    for few in (0, 12):
        EN.FEW, keep = few, EN.FEW
        words = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 14))).encode() for _ in range(300)] + [b"a" * 501, b""]
        ids, n = e.merge(words)
        EN.FEW = keep
        out, at = [], 0
        for k in n.tolist():
            out.append(ids[at : at + k].tolist())
            at += k
        # "abc" and "cab" can be reached on two ways; words over a and b leave one.
        assert out == [plain_merge(ranks, w) for w in words]


def test_bitmap_queue():
    q = EN.RankQueue(1000)
    import numpy as np

    q.push_all(np.array([700, 3, 700, 64]), np.array([1, 2, 3, 4]))
    q.push(3, np.array([9]))
    assert [(r, sorted(p.tolist())) for r, p in iter(q.pop, None)] == [(3, [2, 9]), (64, [4]), (700, [1, 3])]


@pytest.mark.skipif(not VOCABULARY.exists(), reason="no public tokenizers here")
def test_public_tokenizer(spark, cluttered):
    import tiktoken
    from tokenizers import Tokenizer

    e = EN.encoder(str(VOCABULARY))
    other = tiktoken.Encoding("own", pat_str=EN.PATTERN, mergeable_ranks=e.ranks, special_tokens={})
    third = Tokenizer.from_file(str(VOCABULARY.with_suffix(".json")))
    third.encode_special_tokens = True
    texts = ["", None, "Hello  world's  2024 \n\n", "甲乙丙，丁。" * 9, "<|endoftext|> a", " \t ", "ไทย हिन्दी 한국어 عربى 😀👩🏽‍✈️", "x" * 70_000, "é\u0000�", "aaa  bbb"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(0, "")], "doc_id long, text string")
    got = EN.token_ids(cluttered(df)).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        t = texts[r["doc_id"]] or ""
        assert r["ids"] == other.encode_ordinary(t) == third.encode(t, add_special_tokens=False).ids
        assert other.decode(r["ids"]) == t
    assert EN.token_ids(df.where("false")).count() == 0


def test_leaks(spark, cluttered):
    rng = random.Random(8)
    signs = [chr(c) for c in range(0x4E00, 0x4F50)]
    passage = "".join(rng.choice(signs) for _ in range(150))
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(60)]
    english = " ".join(words)
    items = spark.createDataFrame([(1, f"阅读下列材料，回答问题。\n{passage}\n问题：哪一处？", "zh"), (2, f"Read the passage and answer the question.\n{english}\nWhich place?", "en"), (3, None, "zh"), (4, "one line", "en"), (1, f"阅读下列材料，回答问题。\n{passage}\n问题：哪一处？", "zh")], "item_id long, text string, lang string")
    noise = lambda n: "".join(rng.choice(signs) for _ in range(n))
    part = passage[30:90]
    changed = "".join("〇" if i in (12, 29, 47) else c for i, c in enumerate(part))
    lost = "".join(c for i, c in enumerate(part) if i not in (9, 33))
    docs = {
        1: noise(200) + part + noise(50), 2: changed, 3: lost + noise(9), 4: "，".join(part), 5: "<br/>".join([part[:20], part[20:45], part[45:]]), 6: passage[30:65] + noise(30) + passage[100:120], 7: passage[70:95] + passage[20:45],
        8: "阅读下列材料，回答问题。问题：哪一处？", 9: english.upper()[40:220], 10: english[:70], 11: None, 12: "", 13: noise(3), 14: noise(60_000) + part, 15: passage.translate({ord(c): c for c in passage}),
    }
    df = spark.createDataFrame([*docs.items(), (1, docs[1])], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in LK.leaked(cluttered(df), cluttered(items)).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (9, 2), (14, 1), (15, 1)}
    assert LK.leaked(df.where("false"), items).count() == 0 and LK.leaked(df, items.where("false")).count() == 0


def test_variants_of_script(spark):
    items = spark.createDataFrame([(1, "指令\n" + "铜门对这里泽台湾云雾峡后发么为于" * 5 + "\n问题", "zh")], "item_id long, text string, lang string")
    df = spark.createDataFrame([(1, "銅門對這裡澤臺灣雲霧峽後發麼為於" * 5)], "doc_id long, text string")
    assert LK.leaked(df, items).count() == 1


def test_winnowing_guarantee():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(50):
        x = rng.integers(1, 500, 60).astype(np.int32)
        y = np.r_[rng.integers(1, 500, 20), x[25 : 25 + LK.K + LK.WINDOW - 1], rng.integers(1, 500, 20)].astype(np.int32)
        hx, hy = (LK.gram_hashes(z, LK.K) for z in (x, y))
        a = set(hx[LK.winnow(hx, np.array([0, len(x)]), LK.K, LK.WINDOW)])
        b = set(hy[LK.winnow(hy, np.array([0, len(y)]), LK.K, LK.WINDOW)])
        assert a & b


RESIDUE = [
    "标题：{{ title }}\n正文：{{ body }}", "据${agency_name}消息", "Dear [First Name], the briefing for [[REGION]] follows", "%s年%s月%s日，%s方面表示", "图为{引语}（【数字】摄）", "甲说：“<请填写引语>”", "editing by &lt;author.name&gt;", "#AUTHOR# 编辑 #EDITOR# 审核",
    "@@PLACE@@ 当局", "__插入日期__方面", "[object Object] 通报", "XX月XX日，XXX在XXX会见XXX", "姓名：________ 单位：________", "TODO: 补写背景段落", "（此处插入图片说明）", "Lorem ipsum dolor sit amet", "Please enable JavaScript to view this page.",
    "请启用JavaScript以查看评论", "404 Not Found\n\nnginx/1.2", "Error 503: Backend fetch failed", "Access Denied. You don't have permission", "抱歉，您访问的页面不存在", "<noscript>本站需要脚本支持</noscript>", "<%= article.lead %>。", "据%city%消息", "【待补充：现场数据】", "undefined 报道，NaN 人参加", "网页加载失败，请稍后重试",
]
FINE = [
    "甲的公文模板要求写明[密级]和{编号}两栏，均已填写。", "甲发布的代码片段 `{{ host }}` 只是文档示例，专家作了说明。", "访问者一度只看到“404”字样。", "话题#甲乙巡航#由丙发起。", "【甲乙快讯】丙已复航。", "<笋芷>号渡轮由甲租用[8]。", "The Council [sic] used the form {A} and {B} for its two berths.",
    "甲把印有“Lorem ipsum”的样刊误发给订户。", "新系统不再要求读者启用JavaScript。", "代号XX-4的靶船。", "通知仍把地点写作“待定”。", "“页面不存在”的提示源于域名变更。", "增加44.2%，来自甲港，占38%。", "https://a.example/a?b=%E9%B9%B9&c=1", "合同金额为$9万，折合约8万元$。", None, "", " ",
    "```\ndef f(x): return '{{x}}'\n```", "é".encode().decode("latin1") * 60 + "{{ title }}",
]


def test_residue(spark, cluttered):
    long = "甲乙丙丁。" * 20_000
    rows = [(i, t) for i, t in enumerate(RESIDUE + FINE)] + [(0, RESIDUE[0]), (900, long), (901, long + "{{ title }}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [r["doc_id"] for r in residue(cluttered(df)).collect()]
    assert len(got) == len(set(got))
    wrong = [(RESIDUE + FINE)[i] for i in {*got} ^ {*range(len(RESIDUE)), 901} if i < 900]
    assert not wrong and 901 in got and 900 not in got
    assert residue(df.where("false")).count() == 0
    assert residue(df.withColumn("text", F.lit(None).cast("string"))).count() == 0


ANY_CASE = [
    "lorem ipsum dolor", "replace this text", "replace this paragraph", "your text here", "your text goes here", "your content here", "your content goes here", "please enable javascript", "please turn on javascript", "please activate javascript",
    "without javascript enabled", "requires javascript to", "need javascript to", "enable javascript to", "enable javascript and", "enable javascript in your", "javascript is disabled", "javascript is required", "404 not found", "502 bad gateway", "503 service", "504 gateway",
    "error 503:", "internal server error", "access denied.", "you don't have permission to access", "invalid or incomplete response", "checking your browser before", "traceback (most recent call last)", "nginx/1",
]


def test_signs_are_implied_by_the_patterns(spark):
    """In any case of letters a pattern that matches passes its signs."""
    cased = [f(x) for x in ANY_CASE for f in (str.lower, str.upper, str.title, str.capitalize, lambda x: "".join(c.upper() if i % 2 else c for i, c in enumerate(x)))]
    german = ["JavaScript aktivieren", "JAVASCRIPT einschalten", "jAVAsCRIPT aktivieren"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cased + german + RESIDUE)], "doc_id long, text string")
    t = F.col("text")
    every = list(zip(RS.GRAMMARS + RS.FILLER + RS.NOTICES, RS.GRAMMAR_SIGNS + RS.FILLER_SIGNS + RS.NOTICE_SIGNS, strict=True))
    assert df.where(F.array_contains(F.array(*[t.rlike(p) & ~RS._any_in(t, [p], [s]) for p, s in every]), True)).collect() == []
    assert {r["doc_id"] for r in residue(df).collect()} == {*range(len(cased + german + RESIDUE))}


def most_letters(x, y):
    """All runs of two letters on all diagonals, chained over at most LK.GAP letters."""
    runs = []
    for d in range(1 - len(x), len(y)):
        same = [0, *(x[i] == y[i + d] for i in range(max(0, -d), min(len(x), len(y) - d))), 0]
        turns = [i + max(0, -d) - 1 for i in range(1, len(same)) if same[i] != same[i - 1]]
        runs += [(a, b, d) for a, b in zip(turns[::2], turns[1::2], strict=True) if b - a >= 2]
    best = []
    for a, b, d in sorted(runs):
        top = b - a
        for (a2, b2, d2), n in zip(sorted(runs), best, strict=False):
            skip = max(0, b2 - a, b2 + d2 - a - d)
            if skip < b - a and a + skip - b2 <= LK.GAP and a + skip + d - b2 - d2 <= LK.GAP:
                top = max(top, n + b - a - skip)
        best.append(top)
    return max(best, default=0)


def test_passages_with_lost_letters_against_brute_force(spark):
    rng = random.Random(5)
    signs = [chr(c) for c in range(0x4E00, 0x4F50)]
    noise = lambda n: "".join(rng.choice(signs) for _ in range(n))
    table = LK.letter_table()
    enough = 0
    for _ in range(60):
        passage = noise(70)
        part = "".join(rng.choice(signs) if r > 0.97 else c for c in passage[6:64] if (r := rng.random()) > 0.04)
        text = noise(20) + part + noise(20)
        x, y = (LK.letters([t], table)[0].tolist() for t in (text, passage))
        index, wanted = LK.Index([(1, passage, "zh")], table), most_letters(x, y)
        assert index.leaks([text], whole=True) == [(0, 0, wanted)]
        assert (index.leaks([text])[0][2] >= LK.NEEDED_ELSE) == (wanted >= LK.NEEDED_ELSE)
        enough += wanted >= LK.NEEDED_ELSE
    assert enough > 30


def test_residue_of_any_length(spark):
    code = "```\n" + "f(x) = {{x}}\n" * 20_000 + "```"
    fields = [a + " ".join(["long name"] * 40) + b for a, b in [("{{", "}}"), ("{%", "%}"), ("${", "}"), ("<%", "%>"), ("<?=", "?>"), ("@@", "@@"), ("[[", "]]")]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([code, *fields])], "doc_id long, text string")
    assert {r["doc_id"] for r in residue(df).collect()} == {*range(1, 1 + len(fields))}


def test_no_hit_at_all(spark):
    """Batches of unrelated texts and of another script give no pair and don't fail."""
    items = spark.createDataFrame([(1, "指令\n" + "铜门云雾峡台湾泽地里程碑" * 10 + "\n问题", "zh"), (2, "铜门云雾峡台湾泽地里程碑" * 10, "zh")], "item_id long, text string, lang string")
    other = spark.createDataFrame([(i, t) for i, t in enumerate(["plain words of another language " * 9, "ข่าววันนี้ " * 20, "短", ""])], "doc_id long, text string")
    assert LK.leaked(other, items).count() == 0
    whole = spark.createDataFrame([(7, "铜门云雾峡台湾泽地里程碑" * 10)], "doc_id long, text string")
    # An item without instruction and question is a passage as a whole.
    assert {r["item_id"] for r in LK.leaked(other.union(whole), items).collect()} == {1, 2}


def test_every_sixth_letter_changed():
    rng = random.Random(6)
    passages = ["".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(70)) for _ in range(100)]
    noise = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(90))
    index = LK.Index([(i, p, "zh") for i, p in enumerate(passages)], LK.letter_table())
    for every, least in ((8, 100), (6, 90)):
        texts = [noise + "".join("〇" if i % every == 0 else c for i, c in enumerate(p, 1)) + noise for p in passages]
        assert sum(d == i and n >= 50 for d, i, n in index.leaks(texts)) >= least


def test_items_in_parts(spark, monkeypatch):
    rng = random.Random(7)
    passages = {i: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(60)) for i in range(20)}
    items = spark.createDataFrame([(i, f"指令\n{p}\n问题", "zh") for i, p in passages.items()], "item_id long, text string, lang string")
    docs = spark.createDataFrame([(100 + i, p) for i, p in passages.items()], "doc_id long, text string")
    monkeypatch.setattr(LK, "MOST_TEST_LETTERS", 600)
    assert {(r["doc_id"], r["item_id"]) for r in LK.leaked(docs, items).collect()} == {(100 + i, i) for i in passages}


def test_density_of_fields(spark):
    """A sentence about templates isn't residue for the fields it names, but one that consists of fields is."""
    texts = {
        1: "教程：用 {{title}} 这样的写法可以把标题放进页面的开头，编辑部的同事常常这样做。其余照旧。",
        2: "公文模板 {{title}} {{body}} {{author}} {{date}} {{place}}",
        3: "正文到此。{{title}} 落下了。",
        4: "“" + "长" * 200 + "404 Not Found" + "”，通告这样写道。",
        5: "__" + "name of the person " * 5 + "x__ arrived",
        6: "[请填写" + "一个说明" * 10 + "]",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r["doc_id"] for r in residue(df).collect()} == {2, 3, 5, 6}
