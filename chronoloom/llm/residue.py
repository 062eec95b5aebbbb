"""Template residue, filler, error pages and script notices in documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names of fields as templates write them, besides names in camel case, with underscores or dots.
PLAIN_FIELDS = (
    "headline|city|spokesperson|name|title|date|author|editor|place|region|location|body|source|agency|company|email|phone|url|subject|topic|reporter|"
    "country|address|amount|number|quote|content|paragraph|caption|(?:your|first|last|full|company|user) name|insert [a-z]+(?: [a-z]+)?|(?:your|enter) [a-z]+"
)
#: Those of them that are no HTML tags.
NO_TAGS = "headline|city|spokesperson|name|date|author|editor|place|region|location|agency|company|email|phone|quote|(?:your|first|last|full|company|user) name|insert [a-z]+(?: [a-z]+)?|(?:your|enter) [a-z]+"
COMPOUND = "[A-Za-z][A-Za-z0-9]*(?:[_.][A-Za-z0-9]+)+|[a-z]+(?:[A-Z][a-z0-9]+)+"
#: What Chinese templates ask for.
ASKED = "(?:请|请在此|此处|在此)?(?:填写|插入|输入|填入|待补充|待补|待填|待定)[^\\n\\[\\]{}【】<>#%$&]*|[\\u4e00-\\u9fff]{0,4}(?:姓名|日期|时间|地点|地名|来源|单位|标题|作者|数字|引语|海域|型号|职务|正文|导语)"

FIELD = f"(?:(?:{COMPOUND})|(?i:{PLAIN_FIELDS})|{ASKED})"
NO_TAG_FIELD = f"(?:(?:{COMPOUND})|(?i:{NO_TAGS})|{ASKED})"

#: One grammar for each kind of delimiter. Doubled and processing delimiters take any content, single ones a field.
GRAMMARS = [
    r"\{\{[^{}\n]+\}\}|\{%[^{}\n]+%\}|\$\{[^{}\n]+\}",
    r"<%[^<>\n]+%>|<\?=[^<>\n]+\?>|@@[^@\s][^@\n]*@@|\[\[[^\[\]\n]+\]\]",
    r"(?<![A-Za-z0-9_])__(?!(?:init|name|main|file|dict|class|all|call|doc)__)[^_\s][^\n]*?__(?![A-Za-z0-9_])",
    rf"(?<![{{$])\{{{FIELD}\}}|\[{FIELD}\]|【{FIELD}】",
    rf"(?<!话题)#(?:[A-Z]{{3,}}|{FIELD})#|%(?:[A-Z]{{3,}}|{FIELD})%|\$(?:[A-Z]{{3,}}|{FIELD})\$",
    rf"<{NO_TAG_FIELD}>|&lt;{NO_TAG_FIELD}&gt;",
    r"%[sd](?:年|月|日|时|/|-)|\[object Object\]",
]
#: Filler and fields to fill in.
FILLER = [
    r"(?:X{2,}|×{2,})(?:年|月|日)|X{3,}在X{3,}|正文[:：]\s*X{3,}",
    r"(?:姓名|单位|日期|电话|地址)[:：]\s*_{3,}|模板自动生成|(?<![A-Za-z])(?:TODO|FIXME)[:：]",
    r"点击此处添加|[（(]此处插入|请?在此(?:处)?(?:输入|填写)|占位文字|替换为实际内容",
    r"(?<![A-Za-z])undefined\W{1,3}[\u4e00-\u9fff]|(?<![A-Za-z])(?:NaN|null)\W{1,3}[\u4e00-\u9fff]{0,2}(?:人|艘|架|万|元|日|报道)",
    r"(?i)lorem ipsum dolor|(?i)replace this (?:text|paragraph)|(?i)your (?:text|content) (?:goes )?here",
]
#: Notices of servers and browsers.
NOTICES = [
    r"(?i)please (?:enable|turn on|activate) javascript|without javascript enabled|(?:requires?|needs?) javascript to|enable javascript (?:to|and|in your)|javascript is (?:disabled|required)",
    r"请(?:先|在浏览器中)?(?:启用|开启|打开)\s*(?:JavaScript|脚本)|未启用(?:脚本|\s*JavaScript)|需要脚本支持|<noscript>|JavaScript\s*を有効にして|JavaScript(?:를|을)\s*(?:활성화|사용)|(?i:javascript) (?:aktivieren|einschalten)",
    r"(?i)404 not found|502 bad gateway|503 service|504 gateway|error 50\d:|(?<![A-Za-z])internal server error|(?i)access denied\.|you don.t have permission to access|invalid or incomplete response",
    r"(?i)checking your browser before|traceback \(most recent call last\)|nginx/\d",
    r"访问的页面(?:不存在|已被删除)|检测到异常访问|完成安全验证后|系统维护中[，,]|请求的(?:页面|资源)不存在|秒后自动返回首页|(?:网页|页面|内容|数据)加载失败|加载失败[，,]\s*请",
]
#: News about such things: quoted words, and sentences that speak of examples.
QUOTED = r"“[^”\n]*”|「[^」\n]*」|『[^』\n]*』|\"[^\"\n]*\""
CODE = r"(?s)```.*?```|`[^`\n]+`"
SPOKEN_WORDS = r"代码片段|代码示例|文档示例|公文模板|教程|used the form|(?i:tutorial)|code snippet"
#: A sentence that speaks of examples isn't residue unless its fields make up at least this share of its signs.
DENSE_SHARE = 0.5
#: From this share of signs that stand for single bytes on, a text counts as wrongly decoded.
GARBLED_SHARE = 0.2


#: Signs without which the pattern of the same place can't match: looking for them is much cheaper than the pattern.
#: For patterns in which case doesn't count they are looked for in the text in lower case.
GRAMMAR_SIGNS = [["{{", "{%", "${"], ["<%", "<?=", "@@", "[["], ["__"], ["{", "[", "【"], ["#", "%", "$"], ["<", "&lt;"], ["%s", "%d", "[object"]]
FILLER_SIGNS = [["XX", "××", "正文"], ["___", "模板自动生成", "TODO", "FIXME"], ["此处", "在此", "占位文字", "替换为"], ["undefined", "NaN", "null"], ["lorem ipsum", "replace this", "text here", "content here", "goes here"]]
NOTICE_SIGNS = [
    ["javascript"],
    ["javascript", "脚本", "<noscript>"],
    ["404 not", "502 bad", "503 service", "504 gateway", "error 50", "internal server", "access denied", "permission to access", "invalid or incomplete"],
    ["checking your browser", "traceback (most", "nginx/"],
    ["访问", "验证后", "系统维护", "请求的", "返回首页", "加载失败"],
]


def _any(c: Column, lower: Column, patterns: list[str], signs: list[list[str]]) -> Column:
    found = F.lit(False)
    for p, needed in zip(patterns, signs, strict=True):
        where = lower if "(?i" in p else c
        some = F.contains(where, F.lit(needed[0]))
        for x in needed[1:]:
            some = some | F.contains(where, F.lit(x))
        found = found | (some & c.rlike(p))
    return found


def _any_in(c: Column, patterns: list[str], signs: list[list[str]]) -> Column:
    # The lambda binds the text and its lower case once; written out, they would be repeated for every pattern.
    return F.exists(F.array(c), lambda t: F.exists(F.array(F.lower(t)), lambda low: _any(t, low, patterns, signs)))


def _without_examples(text: Column) -> Column:
    """A text without the sentences that speak of examples, by their words and by the density of fields in them."""

    def told(sentence: Column) -> Column:
        rest = sentence
        for g in GRAMMARS:
            rest = F.regexp_replace(rest, g, "")
        dense = F.length(sentence) - F.length(rest) >= F.lit(DENSE_SHARE) * F.length(sentence)
        return F.when(sentence.rlike(SPOKEN_WORDS) & ~dense, F.lit(" ")).otherwise(sentence)

    return F.array_join(F.transform(F.split(text, "(?<=[。！？!?\n])"), told), "")


def is_residue(text: Column) -> Column:
    """Whether a text is or contains residue; false for null, blank and wrongly decoded texts."""
    uncoded = F.when(F.contains(text, F.lit("`")), F.regexp_replace(text, CODE, " ")).otherwise(text)
    plain = F.when(text.rlike(SPOKEN_WORDS), _without_examples(uncoded)).otherwise(uncoded)
    # The signs of the grammars have no capitals, so they are looked for in the text as it is; the lambda binds the changed text once.
    holds = _any(text, text, GRAMMARS, GRAMMAR_SIGNS) & F.exists(F.array(plain), lambda t: _any(t, t, GRAMMARS, GRAMMAR_SIGNS))
    patterns, signs = FILLER + NOTICES, FILLER_SIGNS + NOTICE_SIGNS
    said = _any_in(text, patterns, signs) & _any_in(F.regexp_replace(uncoded, QUOTED, " "), patterns, signs)
    # Names in angle brackets that a quotation consists of are no quotation.
    asks = F.contains(text, F.lit("<请填写")) & text.rlike(r"[“「]<请填写")
    garbled = F.regexp_count(text, F.lit("[\\x80-\\xff\\ufffd]")) > F.length(text) * F.lit(GARBLED_SHARE)
    return F.coalesce((holds | said | asks) & ~garbled, F.lit(False))


def residue(documents: DataFrame) -> DataFrame:
    """``doc_id`` of the documents that are or contain residue; every such id once.

    ``documents``: ``doc_id``, ``text``; other columns are ignored. Unfilled fields count with their delimiters'
    own grammar; fields in code and in sentences about code and forms don't unless they consist of fields, nor do messages in quotation marks.
    Null, blank and wrongly decoded texts are no cases; an empty table gives an empty result. All tests are regular
    expressions over the whole text inside generated code; only the found ids are shuffled.
    """
    return documents.select("doc_id", "text").where(is_residue(F.col("text"))).select("doc_id").distinct()
