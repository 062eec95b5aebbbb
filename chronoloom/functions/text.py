"""Text functions as column expressions: everything here stays inside generated JVM code."""

from __future__ import annotations

import functools

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: The characters that count as white space (Unicode White_Space and the four ASCII separators).
WHITE = "\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"


def strip(c: Column) -> Column:
    """Without outer white space of any kind; null stays null."""
    return F.regexp_replace(c, f"^[{WHITE}]+|[{WHITE}]+$", "")


def squeeze(c: Column) -> Column:
    """Inner runs of white space as one blank, outer ones removed."""
    return strip(F.regexp_replace(c, f"[{WHITE}]+", " "))


def alias_key(c: Column) -> Column:
    """Stripped and in lower case; null stays null and an empty text stays empty."""
    return F.lower(strip(c))


def is_blank(c: Column) -> Column:
    """Null, empty or white space only."""
    return c.isNull() | (F.length(strip(c)) == 0)


def hash8(c: Column) -> Column:
    """The first eight hex digits of the MD5 of the text."""
    return F.substring(F.md5(c), 1, 8)


@functools.lru_cache(maxsize=1)
def _script_pairs() -> dict[str, str]:
    """Traditional to simplified signs, by the transliterator of the Unicode library that comes with Spark."""
    spark = SparkSession.getActiveSession()
    signs = [chr(c) for block in ((0x3400, 0xA000), (0xF900, 0xFB00)) for c in range(*block)]
    rule = spark._jvm.com.ibm.icu.text.Transliterator.getInstance("Traditional-Simplified")
    out = rule.transliterate("\n".join(signs)).split("\n")
    return {a: b for a, b in zip(signs, out, strict=True) if a != b and len(b) == 1}


@functools.lru_cache(maxsize=1)
def fold_table() -> dict[str, str]:
    """Sign by sign folding of width and script variant: full-width ASCII to ASCII, traditional to simplified."""
    wide = {chr(0xFEE0 + c): chr(c) for c in range(0x21, 0x7F)}
    return {**_script_pairs(), **wide, "　": " "}


def fold(c: Column) -> Column:
    """Width and script variants and case folded, in one pass over the text."""
    table = fold_table()
    return F.lower(F.translate(c, "".join(table), "".join(table.values())))


#: Signs after which a sentence ends in the plain splitter (a full stop isn't one).
PLAIN_ENDS = "。！？!?；;"
#: The character rules of news cleaning, in order: name, pattern, replacement.
CHARACTER_RULES = [
    ("citation_bracket", "\\[(?:注[" + WHITE + "]*)?[0-9０-９]+(?:[" + WHITE + "]*[-—–~～至][" + WHITE + "]*[0-9０-９]+)?\\]", ""),
    ("empty_bracket", "[\\[【][" + WHITE + "]*[\\]】]", ""),
    ("leading_quote", "^[”＂\"]+", ""),
    ("space_before_mark", "[" + WHITE + "]+([，。！？；：,.!?])", "$1"),
]


def split_sentences(c: Column) -> Column:
    """Sentences of a text by the plain rule: after an end sign; white space squeezed, blanks dropped. Null gives null."""
    parts = F.split(squeeze(c), f"(?<=[{PLAIN_ENDS}])[{WHITE}]*")
    return F.filter(F.transform(parts, strip), lambda s: F.length(s) > 0)


def news_sentences(c: Column) -> Column:
    """Plain sentences line by line."""
    return F.flatten(F.transform(F.split(c, "\\R"), split_sentences))


def collect_sentences(c: Column) -> Column:
    """Plain sentences paragraph by paragraph; a text that yields none but isn't blank is one sentence."""
    found = F.flatten(F.transform(F.split(c, "\n+"), split_sentences))
    return F.when((F.size(found) == 0) & ~is_blank(c), F.array(squeeze(c))).otherwise(found)


def normalize_raw_news(c: Column) -> Column:
    """Byte order marks, line ends, wide blanks, blanks at line ends and runs of blank lines normalised."""
    c = F.regexp_replace(F.regexp_replace(c, "﻿", ""), "\r\n?", "\n")
    c = F.regexp_replace(F.translate(c, "　", " "), "[\t ]+\n", "\n")
    return strip(F.regexp_replace(c, "\n{3,}", "\n\n"))


def tidy_lines(c: Column) -> Column:
    """Lines stripped, blank ones dropped, runs of blanks inside as one."""
    lines = F.transform(F.split(c, "\\R"), lambda s: F.regexp_replace(strip(s), "[ \t]{2,}", " "))
    return F.array_join(F.filter(lines, lambda s: F.length(s) > 0), "\n")


def clean_characters(c: Column) -> Column:
    """The character rules in their order, then ``tidy_lines``."""
    for _, pattern, put in CHARACTER_RULES:
        c = F.regexp_replace(c, pattern, put)
    return tidy_lines(c)


def character_hits(c: Column) -> Column:
    """A map from rule to its hits in ``clean_characters``; each rule sees the result of those before it."""
    entries = []
    for name, pattern, put in CHARACTER_RULES:
        entries += [F.lit(name), F.regexp_count(c, F.lit(pattern))]
        c = F.regexp_replace(c, pattern, put)
    blank = F.size(F.filter(F.split(c, "\\R"), lambda s: F.length(strip(s)) == 0)) - F.when(c.rlike("\\R$"), 1).otherwise(0)
    return F.create_map(*entries, F.lit("blank_line"), F.when(F.length(c) == 0, 0).otherwise(blank))


def apply_word_rules(c: Column, literal: list[tuple[str, str]], hints: list[str] = (), line_rules: list[tuple[str, str]] = ()) -> Column:
    """Literal replacements in order, then pattern rules on the lines that hold a hint. The rules are data of the caller."""
    for old, new in literal:
        c = F.replace(c, F.lit(old), F.lit(new))
    if not line_rules:
        return c

    def line(s: Column) -> Column:
        held = F.lit(False)
        for h in hints:
            held = held | F.contains(s, F.lit(h))
        out = s
        for pattern, put in line_rules:
            out = F.regexp_replace(out, pattern, put)
        return F.when(held, out).otherwise(s)

    return F.array_join(F.transform(F.split(c, "\n"), line), "\n")


def clean_news(c: Column, literal: list[tuple[str, str]] = (), hints: list[str] = (), line_rules: list[tuple[str, str]] = ()) -> Column:
    """Raw normalisation, character rules, word rules and tidy lines."""
    return tidy_lines(apply_word_rules(clean_characters(normalize_raw_news(c)), literal, hints, line_rules))


def lexical_tokens(c: Column) -> Column:
    """Lower-case ASCII words; Chinese signs one by one, then pairs of neighbouring ones, per run."""
    runs = F.regexp_extract_all(F.lower(c), F.lit("[一-鿿]+|[a-z0-9_]+"), F.lit(0))

    def tokens(r: Column) -> Column:
        n = F.length(r)
        ones = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(r, i, F.lit(1)))
        twos = F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring(r, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))
        return F.when(r.rlike("^[一-鿿]"), F.concat(ones, twos)).otherwise(F.array(r))

    return F.flatten(F.transform(runs, tokens))


def token_estimate(c: Column) -> Column:
    """Chinese signs, twice the ASCII words, half the marks rounded up; at least 1; 0 for a blank text."""
    n = F.regexp_count(c, F.lit("[一-鿿]")) + 2 * F.regexp_count(c, F.lit("[A-Za-z0-9_]+")) + F.ceil(F.regexp_count(c, F.lit("[，。！？；,.!?;:]")) / 2)
    return F.when(is_blank(c), F.lit(0)).otherwise(F.greatest(n, F.lit(1))).cast("int")


def element_id(kind: Column, c: Column) -> Column:
    """ent_, rel_ or loc_ and the hash of the surface text."""
    return F.concat(F.substring(kind, 1, 3), F.lit("_"), hash8(c))


def stem(file_name: Column) -> Column:
    """A file name without its last extension."""
    return F.regexp_replace(file_name, "(?<=.)\\.[^.]*$", "")


def file_doc_id(file_name: Column) -> Column:
    """The leading code of the stem in lower case and the hash of the stem."""
    s = stem(file_name)
    code = F.lower(F.regexp_extract(s, "^[A-Za-z0-9+_-]+", 0))
    code = F.translate(F.replace(code, F.lit("+"), F.lit("_plus_")), "-", "_")
    code = F.regexp_replace(code, "^_+|_+$", "")
    return F.concat(F.when(F.length(code) == 0, F.lit("doc")).otherwise(code), F.lit("_"), hash8(s))


def news_code(file_name: Column) -> Column:
    """Struct of ``prefix`` and ``number`` of a code such as D001 at the beginning, else null."""
    hit = F.regexp_extract(file_name, "^([A-Za-z]+)(\\d{3})(?![0-9])", 1)
    number = F.regexp_extract(file_name, "^([A-Za-z]+)(\\d{3})(?![0-9])", 2)
    return F.when(F.length(hit) > 0, F.struct(F.upper(hit).alias("prefix"), number.cast("int").alias("number")))


def title_parts(title: Column) -> Column:
    """Struct of ``base``, ``raw_time`` (the trailing bracket's content) and ``malformed`` (an unclosed bracket)."""
    t = strip(F.regexp_replace(title, "[＜<][^＞>]*[＞>]$", ""))
    inner = F.regexp_extract(t, "^(.*?)[（(]([^（()）]*)[)）]$", 2)
    base = strip(F.regexp_extract(t, "^(.*?)[（(]([^（()）]*)[)）]$", 1))
    closed = t.rlike("^.*?[（(][^（()）]*[)）]$")
    return F.struct(
        F.when(closed, base).otherwise(t).alias("base"),
        F.when(closed, strip(inner)).alias("raw_time"),
        (~closed & t.rlike("[（(][^）)]*$")).alias("malformed"),
    )


def same_sentence_key(c: Column) -> Column:
    """A sentence without outer quotation marks and closing marks: equal keys mean equivalent sentences."""
    q = "\"'“”‘’「」『』"
    c = F.regexp_replace(squeeze(c), f"^[{q}]+|[{q}]+$", "")
    return F.regexp_replace(F.regexp_replace(c, "[。！？!?；;，,.：:]+$", ""), f"[{q}]+$", "")


def preview(sentences: Column, most: int = 200) -> Column:
    """The first two sentences, cut to so many signs."""
    return F.substring(F.array_join(F.slice(sentences, 1, 2), " "), 1, most)


def safe_file_name(c: Column, otherwise: str = "untitled") -> Column:
    """Signs that file systems refuse replaced, outer blanks and final periods removed."""
    c = F.regexp_replace(strip(F.translate(c, "\\/:*?\"<>|", "_________")), "\\.+$", "")
    return F.when(F.length(c) == 0, F.lit(otherwise)).otherwise(c)
