"""Sentence boundaries in texts of any mix of languages and scripts."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chronoloom.llm.batches import slices

#: Quotation marks, and other brackets, with their closing signs.
QUOTES = {"“": "”", "「": "」", "『": "』", "«": "»", "„": "“", "‹": "›", '"': '"', "＂": "＂"}
BRACKETS = {"（": "）", "(": ")", "《": "》", "〈": "〉", "【": "】", "[": "]", "〔": "〕", "［": "］"}
CLOSERS = "".join({*QUOTES.values(), *BRACKETS.values()}) + "’'"
#: Marks that end a sentence wherever they stand outside quotation marks and brackets.
HARD = "。！？；｡।॥۔؟።။។"
#: Abbreviations that never end a sentence, without the last period, in lower case.
NEVER_FINAL = set(
    "mr mrs ms dr prof capt adm gen col lt sgt maj cmdr gov sen rep rev hon pres st mt ft nos nr fig figs eq vol ch sec pp vs v approx ca dept e.g i.e cf viz al "
    "z.b z u.a d.h bzw ggf hr hrn fr abs art bd vgl str evtl inkl usw.z sog mme mlle sr.a ing dipl "
    "д-р г ул им т.е т.к د م أ प्रो डॉ श्री कु ดร นพ พล.อ น.ส".split()
)
#: Abbreviations that end one if what follows begins a new one.
MAY_END = set("a.m p.m am pm etc inc ltd co corp bros jr sr u.s u.k u.n e.u u.s.a ph.d b.c a.d usw u.s.w".split())
#: What may follow a clock time or day number in the same sentence.
CALENDAR = set(
    "monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november december "
    "januar februar märz mai juni juli oktober dezember gmt utc est edt pst pdt cet cest jst".split()
)
ORDINAL_BEFORE = set("am der die das dem den des im vom zum bis und ab seit".split())
#: Verbs that say who speaks, after a quotation that begins its sentence.
SPEAKS = "说|說|表示|称|稱|指出|介绍|介紹|回应|回應|透露|补充|補充|强调|強調|坦言|认为|認為|问|問|写道|寫道|道"
_ATTRIBUTION = re.compile(rf"[^。！？!?；\n“”「」『』：:\"]{{0,60}}?(?:{SPEAKS})(?=[。！？!?；，,]|\s*$)")
_LATIN_ATTRIBUTION = re.compile(r"(?:(?:[A-Z][\w'’-]*\.?|the|of|a)\s+){1,8}?(?:said|says|asked|told|added|replied|warned|wrote|noted|explained|sagte|fragte|erklärte)\b")
_BLANK_LINE = re.compile(r"\n[^\S\n]*\n\s*|\r\n[^\S\n]*\r\n\s*")
_EVENT = re.compile("[" + re.escape(HARD + "!?.．" + "".join({*QUOTES, *BRACKETS}) + CLOSERS.replace("’", "").replace("'", "")) + r"]|(?<=[฀-๿0-9%)”])[  　\t]+")
# Letters of one kind: a Latin word stands apart from the Chinese signs before it.
_WORD_BEFORE = re.compile(r"(?:[A-Za-z0-9À-ɏ.'’-]+|[^\s\"“”「」『』（）()《》【】\[\]，。！？；：、,!?;:A-Za-z0-9À-ɏ一-鿿]+)$")
#: Thai words that need what follows (so the gap after them is none), and polite words that end a sentence.
THAI_OPEN = ["วันที่", "เมื่อ", "ที่", "ร้อยละ", "จำนวน", "ประมาณ", "ราว", "กว่า", "และ", "หรือ", "กับ", "โดย", "ของ", "จาก", "ถึง", "ใน", "ว่า", "คือ", "เช่น", "นาย", "นาง", "นางสาว"]
THAI_FINAL = ["ครับ", "ค่ะ", "คะ", "นะ", "แล้ว", "เลย", "ด้วย", "จ้ะ"]


def last_word(run: str, dictionary: list[str]) -> str:
    """The last word of a run without blanks, by the lattice of dictionary words and single signs.

    The cheapest way through the lattice counts a dictionary word as one and an unknown sign as one each, so that
    long words win; only the tail that the longest words can reach is looked at.
    """
    longest = max(map(len, dictionary))
    run = run[-4 * longest :]
    cost, back = [0] + [1 << 30] * len(run), [0] * (len(run) + 1)
    words = set(dictionary)
    for i in range(len(run)):
        for n in range(1, min(longest, len(run) - i) + 1):
            if (n == 1 or run[i : i + n] in words) and cost[i] + 1 < cost[i + n]:
                cost[i + n], back[i + n] = cost[i] + 1, i
    return run[back[len(run)] :] if run else ""


def _pairs(text: str) -> dict[int, int]:
    """Positions of opening signs with those of their closing signs; what isn't closed is left out."""
    out: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    waiting: dict[str, int] = {}
    closing = {**QUOTES, **BRACKETS}
    ends = set(closing.values())
    for m in re.finditer("[" + re.escape("".join({*closing, *ends})) + "]", text):
        c, at = m[0], m.start()
        if waiting.get(c):  # something open is waiting for this sign
            while stack:
                w, start = stack.pop()
                waiting[w] -= 1
                if w == c:
                    out[start] = at
                    break
        elif c in closing:
            stack.append((closing[c], at))
            waiting[closing[c]] = waiting.get(closing[c], 0) + 1
    return out


def _upper_like(c: str) -> bool:
    """Whether a sign may begin a sentence: anything but a small letter."""
    return not c.islower()


def _period_ends(text: str, at: int) -> bool:
    """Whether the ASCII period at this place ends a sentence."""
    n = len(text)
    nxt = text[at + 1] if at + 1 < n else ""
    if nxt == "." or (at and text[at - 1] == "."):
        return False  # an ellipsis
    cjk_next = bool(nxt) and ("぀" <= nxt <= "鿿")
    if nxt and not nxt.isspace() and not cjk_next and nxt not in CLOSERS and nxt not in QUOTES and nxt not in BRACKETS:
        return False
    found = _WORD_BEFORE.search(text, max(0, at - 40), at)
    word = found[0] if found else ""
    after = re.compile(r"\s*[\"“「『(（]?").match(text, at + 1).end()
    follows = text[after] if after < n else ""
    key = word.lower().lstrip("'‘’")
    if not follows:
        return True
    if key in NEVER_FINAL:
        return False
    if key == "no":
        return not follows.isdigit() and _upper_like(follows)
    rest = re.compile(r"[^\W\d_]+").match(text, after)
    next_word = rest[0].lower() if rest else ""
    if key in MAY_END:
        return nxt.isspace() and _upper_like(follows) and next_word not in CALENDAR and next_word not in ("ltd", "inc")
    if len(word) == 1 and word.isalpha() and word.isupper() and word.isascii():
        return False  # an initial
    if re.fullmatch(r"(?:[A-Za-z]\.)+[A-Za-z]", word):
        return nxt.isspace() and _upper_like(follows) and len(word) > 3
    if word[-1:].isdigit():
        if follows.isdigit() or not _upper_like(follows) or next_word in CALENDAR:
            return False
        before = text[max(0, at - len(word) - 12) : at - len(word)].split()
        return not (word.isdigit() and len(word) <= 2 and before and before[-1].lower() in ORDINAL_BEFORE)
    return _upper_like(follows)


def _quotation_ends(text: str, start: int, opening: int, closing: int) -> bool:
    """Whether the sentence ends with the quotation between these places; it began at ``start``."""
    inner = text[opening + 1 : closing].rstrip(CLOSERS)
    if not inner or inner[-1] not in HARD + "!?.．" or inner.endswith(".."):
        return False
    n = len(text)
    after = closing + 1
    follow = re.compile(r"\s*").match(text, after).end()
    if follow >= n:
        return True
    c = text[follow]
    if c in HARD + "!?.．，,、：:—…的と" or c in CLOSERS and c not in QUOTES:
        return False
    latin = c.isascii() and c.isalpha() or (c.isalpha() and c.islower())
    begins = not text[start:opening].strip()
    if latin:
        if follow == after or c.islower():
            return follow != after and False
        return not (begins and _LATIN_ATTRIBUTION.match(text, follow))
    return not (begins and _ATTRIBUTION.match(text, follow))


def _paragraph(text: str) -> list[int]:
    """Ends of the sentences of a text without blank lines."""
    pairs = _pairs(text)
    cuts: list[int] = []
    start, until, n = 0, -1, len(text)
    thai = False
    seen = 0
    for m in _EVENT.finditer(text):
        at, c = m.start(), m[0]
        if at < until or at < start:
            continue
        if at in pairs:
            until = pairs[at] + 1
            if c in QUOTES and _quotation_ends(text, start, at, pairs[at]):
                end = pairs[at] + 1
                cuts.append(end)
                start, thai = end, False
            continue
        if c[0] in "  　\t":
            thai = thai or any("฀" <= x <= "๿" for x in text[max(start, seen) : at])
            seen = at
            nxt = text[m.end()] if m.end() < n else ""
            if thai and nxt and ("฀" <= text[at - 1] <= "๿" or "฀" <= nxt <= "๿"):
                run = re.compile(r"[฀-๿]*$").search(text, max(start, at - 80), at)[0]
                word = last_word(run, THAI_OPEN + THAI_FINAL) if run else ""
                if word not in THAI_OPEN:
                    cuts.append(m.end())
                    start, thai = m.end(), False
            continue
        if c in CLOSERS or c in QUOTES or c in BRACKETS:
            continue
        if c == ".":
            if not _period_ends(text, at):
                continue
        elif c == "．":
            if 0 < at < n - 1 and text[at - 1].isdigit() and text[at + 1].isdigit():
                continue
        elif c in "!?":
            nxt = text[at + 1] if at + 1 < n else ""
            if nxt.isascii() and nxt.isalnum() or nxt in ("/", "="):
                continue  # inside an address
            follow = re.compile(r"\s*").match(text, at + 1).end()
            if follow < n and follow > at + 1 and text[follow].islower():
                continue
        end = at + 1
        while end < n and (text[end] in HARD + "!?．…." or (text[end] in CLOSERS and end not in pairs)):
            end += 1
        cuts.append(end)
        start, thai = end, False
    return cuts


def spans(text: str | None) -> list[tuple[int, int]]:
    """Start and end of every sentence, without outer white space; none for null and blank texts."""
    if not text:
        return []
    out = []
    begin = 0
    for stop, resume in [*((m.start(), m.end()) for m in _BLANK_LINE.finditer(text)), (len(text), len(text))]:
        part = text[begin:stop]
        a = 0
        for b in [*_paragraph(part), len(part)]:
            piece = part[a:b]
            core = piece.strip()
            if core:
                s = begin + a + len(piece) - len(piece.lstrip())
                out.append((s, s + len(core)))
            a = b
        begin = resume
    return out


def sentences(documents: DataFrame, key: str, text: str) -> DataFrame:
    """The sentences of every text: the key, ``start_char`` and ``end_char`` (from 0, end exclusive, in code points).

    Null and blank texts give none; other columns are ignored; repeated rows count once; an empty table gives an
    empty result. Scripts with marks are cut at terminators that context confirms (abbreviations, initials, numbers,
    quotations with their speakers, brackets); scripts without blanks between words and without marks are cut at
    gaps that the last word, found in a dictionary lattice, doesn't keep open. Whole texts, in one pass each;
    a text's cost grows with its length, and the only shuffle is that of distinct spans.
    """
    schema = T.StructType([documents.schema[key], T.StructField("start_char", T.LongType()), T.StructField("end_char", T.LongType())])

    def cut(batches):
        for batch in slices(batches, text):
            found = [spans(t) for t in batch.column(1).to_pylist()]
            n = np.array([len(f) for f in found], dtype=np.int64)
            flat = np.array([x for f in found for x in f], dtype=np.int64).reshape(-1, 2)
            keys = batch.column(0).take(pa.array(np.repeat(np.arange(len(found)), n)))
            yield pa.record_batch([keys, pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=[key, "start_char", "end_char"])

    return documents.select(key, text).mapInArrow(cut, schema).distinct()
