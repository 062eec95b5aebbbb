"""Held-out evaluation passages that stand in a corpus."""

from __future__ import annotations

import functools
import re
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.functions.text import fold_table
from chronoloom.llm.batches import slices

#: Letters of a k-gram and k-grams of a window; a shared span of K + WINDOW - 1 letters always has a common fingerprint.
K = 5
WINDOW = 4
#: The test side is broadcast; more letters than this go in parts, each with a pass over the documents.
MOST_TEST_LETTERS = 20_000_000
#: Between two matching runs of one place at most so many letters are skipped in the text or in the passage.
GAP = 6
#: Hits near one diagonal are counted in bands so wide; a place gives at least one hit for so many letters asked for.
BAND = 32
LETTERS_PER_HIT = 17
#: Runs whose surroundings are looked at at once, and bytes of text that are searched at once: small arrays stay in the cache.
ROWS_AT_ONCE = 10_000
BYTES_AT_ONCE = 1_500_000
#: Letters that must be found, by language of the item.
NEEDED = {"en": 90}
NEEDED_ELSE = 50

# What a gap after (before) a run leads to: how far on (back) in the text and on which diagonal.
_REACH = [(k, s) for s in range(-GAP, GAP + 1) for k in range(max(0, -s), GAP + 1 - max(0, s))]
AHEAD, SHIFT = (np.array(c) for c in zip(*_REACH, strict=True))
# The same seen from the other side.
BEHIND = AHEAD + SHIFT

_MARKUP = re.compile(r"<[^<>]{1,200}>|&(?:[a-zA-Z]{2,8}|#\d{1,6}|#x[0-9a-fA-F]{1,5});")
_BASE = np.uint64(0x9E3779B97F4A7C15)


@functools.lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """Code point to the letter it counts as (width, case and script variant folded), 0 for what isn't a letter or digit."""
    pairs = {ord(a): ord(b) for a, b in fold_table().items()}
    table = np.zeros(sys.maxunicode + 1, dtype=np.int32)
    for c in [*range(0xD800), *range(0xE000, 0x30000)]:
        ch = chr(c)
        if unicodedata.category(ch)[0] in "LN":
            f = unicodedata.normalize("NFKC", ch).lower()
            f = f if len(f) == 1 else ch
            table[c] = pairs.get(ord(f), ord(f))
    return table


def letters(texts: list[str | None], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all texts in a row, and where each text begins (one more entry at the end)."""
    plain = [_MARKUP.sub(" ", t) if t and ("<" in t or "&" in t) else t or "" for t in texts]
    code = np.frombuffer("".join(plain).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    own = table[code]
    keep = own > 0
    ends = np.cumsum([0, *map(len, plain)])
    return own[keep], np.r_[0, np.cumsum(keep)][ends]


def gram_hashes(x: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k letters in a row."""
    n = len(x) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = (h ^ x[i : i + n].astype(np.uint64)) * _BASE
        h ^= h >> np.uint64(29)
    return h


def winnow(h: np.ndarray, starts: np.ndarray, k: int, window: int) -> np.ndarray:
    """Positions of the smallest hash of each window, the rightmost of equal ones, for texts that lie in a row.

    Windows don't reach from one text into the next; a text with fewer k-grams than a window gives its smallest one.
    """
    if not len(h):
        return np.zeros(0, np.int64)
    grams = np.maximum(0, np.diff(starts) - k + 1)
    text = np.repeat(np.arange(len(grams)), grams)
    at = np.concatenate([[0], np.cumsum(grams)])[:-1]
    pos = np.arange(len(text)) - np.repeat(at, grams) + np.repeat(starts[:-1], grams)
    own = h[pos]
    m = len(own) - window + 1
    picked = np.zeros(len(own), bool)
    if m > 0:
        best = np.arange(m)
        for i in range(1, window):
            better = own[i : i + m] <= own[best]
            best = np.where(better, np.arange(i, i + m), best)
        inside = text[:m] == text[window - 1 :]
        picked[best[inside]] = True
    for t in np.flatnonzero((grams > 0) & (grams < window)):  # short texts
        s = slice(at[t], at[t] + grams[t])
        picked[at[t] + int(np.argmin(own[s]))] = True
    return pos[picked]


def passage(text: str | None) -> str:
    """An item's passage: its lines without the first (instruction) and the last (question), all of it if there are no others."""
    lines = [x for x in (text or "").split("\n") if x.strip()]
    return "\n".join(lines[1:-1] if len(lines) > 2 else lines)


class Index:
    """Fingerprints of the passages: sorted hashes with their places."""

    def __init__(self, items: list[tuple[int, str, str | None]], table: np.ndarray):
        self.table = table
        self.ids = [i for i, _, _ in items]
        self.need = np.array([NEEDED.get(lang, NEEDED_ELSE) for _, _, lang in items])
        self.x, self.starts = letters([t for _, t, _ in items], table)
        h = gram_hashes(self.x, K)
        # Every k-gram of the passages is kept, so every window minimum of a text that stands in a passage is found.
        whole = np.ones(len(h), bool)
        for s in self.starts[1:-1]:
            whole[max(0, s - K + 1) : s] = False
        pos = np.flatnonzero(whole)
        order = np.argsort(h[pos], kind="stable")
        self.h, self.pos = h[pos][order], pos[order]
        self.item = np.searchsorted(self.starts, self.pos, side="right") - 1

    def leaks(self, texts: list[str | None], whole: bool = False) -> list[tuple[int, int, int]]:
        """(number of the text, number of the item, letters found) for the best place of each pair with a hit.

        Unless ``whole`` is set, letters are counted as far as needed to tell whether they are enough.
        """
        x, starts = letters(texts, self.table)
        h = gram_hashes(x, K)
        pos = winnow(h, starts, K, WINDOW)
        if not len(pos) or not len(self.h):
            return []
        a, b = np.searchsorted(self.h, h[pos], "left"), np.searchsorted(self.h, h[pos], "right")
        n = b - a
        if not n.any():
            return []
        hit = np.repeat(pos, n)
        ref = np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at, item = self.pos[ref], self.item[ref]
        doc = np.searchsorted(starts, hit, side="right") - 1
        pair = doc.astype(np.int64) * len(self.ids) + item
        # A place that holds enough has some hits near one diagonal: count them in bands that overlap by half. Where the
        # bands lie depends on the text and the passage alone, not on what else is in the batch.
        diag = at - self.starts[item] + starts[doc + 1] - hit
        width = int(diag.max()) // BAND + 2
        likely = np.zeros(len(hit), bool)
        for shift in (0, BAND // 2):
            band = pair * width + (diag + shift) // BAND
            order = np.argsort(band, kind="stable")
            edge = np.flatnonzero(np.r_[True, band[order][1:] != band[order][:-1], True])
            often = np.diff(edge) >= self.need[item[order][edge[:-1]]] // LETTERS_PER_HIT
            likely[order[np.repeat(often, np.diff(edge))]] = True
        mine = np.isin(pair, np.unique(pair[likely]))
        return self._best(self._reached(x, starts, pair[mine], hit[mine], at[mine]), whole)

    def _reached(self, x: np.ndarray, starts: np.ndarray, pair: np.ndarray, t: np.ndarray, q: np.ndarray) -> np.ndarray:
        """The runs of equal letters around the hits and all runs that gaps lead to: see ``_runs``.

        A lost letter leads to another diagonal, on which a short segment may have no hit. So from both ends of every
        run all diagonals within ``GAP`` are looked at as far as a gap reaches; what matches there is extended and
        looked on from in turn, for all pairs of texts and passages of the batch at once.
        """
        known, out = np.zeros(0, np.int64), [np.zeros((0, 4), np.int64)]
        while len(t):
            runs = self._runs(x, starts, pair, t, q)
            key = runs[:, 1] * (len(self.x) + 1) + runs[:, 3]
            fresh = ~np.isin(key, known)
            runs, known = runs[fresh], np.concatenate([known, key[fresh]])
            out.append(runs)
            near = [self._near(x, starts, runs[i : i + ROWS_AT_ONCE]) for i in range(0, len(runs), ROWS_AT_ONCE)]
            pair, t, q = (np.concatenate(c) for c in zip(*near, strict=True)) if near else (known[:0],) * 3
        return np.concatenate(out)

    def _near(self, x: np.ndarray, starts: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Equal letters in reach of a gap from the ends of the runs: pair, place in the text, place in the passage."""
        pair, begin, end, q = (c[:, None] for c in runs.T)
        t = np.concatenate([end + AHEAD, begin - 1 - BEHIND], 1)
        q = np.concatenate([q + end - begin + AHEAD + SHIFT, q - 1 - BEHIND + SHIFT], 1)
        doc, item = pair // len(self.ids), pair % len(self.ids)
        inside = (t >= starts[doc]) & (t < starts[doc + 1]) & (q >= self.starts[item]) & (q < self.starts[item + 1])
        pair, t, q = np.broadcast_to(pair, t.shape)[inside], t[inside], q[inside]
        same = x[t] == self.x[q]
        return pair[same], t[same], q[same]

    def _runs(self, x: np.ndarray, starts: np.ndarray, pair: np.ndarray, t: np.ndarray, q: np.ndarray) -> np.ndarray:
        """The runs of two or more equal letters that hold the cells (places ``t`` in the text, ``q`` in the passage).

        A row for each run: pair, begin and end in the text, begin in the passage. A cell is extended up to the next
        one of its diagonal, so that the work is in proportion to the runs and not to the cells.
        """
        order = np.lexsort((t, q - t, pair))
        pair, t, d = pair[order], t[order], (q - t)[order]
        doc, item = pair // len(self.ids), pair % len(self.ids)
        along = np.r_[(pair[1:] == pair[:-1]) & (d[1:] == d[:-1]), False]
        stop = np.minimum(starts[doc + 1], self.starts[item + 1] - d)
        stop[along] = np.minimum(stop[along], t[1:][along[:-1]])
        end = t.copy()
        go = np.flatnonzero(end < stop)
        while len(go):
            go = go[x[end[go]] == self.x[end[go] + d[go]]]
            end[go] += 1
            go = go[end[go] < stop[go]]
        joined = along[:-1] & (end[:-1] == t[1:])
        first = np.flatnonzero(np.r_[True, ~joined])
        last = np.r_[first[1:] - 1, len(t) - 1]
        begin, back, d, end, pair = t[first], np.maximum(starts[doc], self.starts[item] - d)[first], d[first], end[last], pair[first]
        go = np.flatnonzero((begin > back) & (end > begin))
        while len(go):
            go = go[x[begin[go] - 1] == self.x[begin[go] - 1 + d[go]]]
            begin[go] -= 1
            go = go[begin[go] > back[go]]
        return np.stack([pair, begin, end, begin + d], 1)[end - begin >= 2]

    def _best(self, runs: np.ndarray, whole: bool) -> list[tuple[int, int, int]]:
        """The best chain of runs of each pair. Pairs whose runs cover too few letters of the passage need no chaining."""
        if not len(runs):
            return []
        runs = runs[np.lexsort((runs[:, 3], runs[:, 0]))]
        pair, begin, end, q = runs.T
        # Letters of the passage under any run: what goes beyond the furthest end so far. Pairs lie apart on one axis.
        axis = pair * (len(self.x) + 1)
        reach = axis + q + end - begin
        over = np.maximum.accumulate(np.r_[-1, reach[:-1]])
        edge = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        cover = np.add.reduceat(np.maximum(0, reach - np.maximum(axis + q, over)), edge)
        longest = np.maximum.reduceat(end - begin, edge)
        need = self.need[pair[edge] % len(self.ids)]
        out = []
        for s, e, p, c, most, n in zip(edge.tolist(), [*edge[1:].tolist(), len(runs)], pair[edge].tolist(), cover.tolist(), longest.tolist(), need.tolist(), strict=True):
            if whole or c >= n > most:
                most = chained(runs[s:e, 1:])
            out.append((p // len(self.ids), p % len(self.ids), most))
        return out


def chained(runs: np.ndarray) -> int:
    """The most letters of a chain of runs (begin and end in the text, begin in the passage), in order and with small gaps."""
    rows = sorted(runs.tolist())
    longest = max(b - a for a, b, _ in rows)
    best = []
    for n, (a, b, q) in enumerate(rows):
        top = b - a
        for m in range(n - 1, -1, -1):
            a2, b2, q2 = rows[m]
            if a - a2 > longest + GAP:
                break
            skip = max(0, b2 - a, q2 + b2 - a2 - q)  # overlap counts once
            if skip < b - a and a + skip - b2 <= GAP and q + skip - q2 - b2 + a2 <= GAP:
                top = max(top, best[m] + b - a - skip)
        best.append(top)
    return max(best)


def leaked(documents: DataFrame, items: DataFrame, scores: bool = False) -> DataFrame:
    """``doc_id`` and ``item_id`` where the document holds enough of the item's passage.

    ``documents``: ``doc_id``, ``text``; ``items``: ``item_id``, ``text``, ``lang``; other columns are ignored.
    Enough is 50 letters (items in English: 90) in one place and in the passage's order, without blanks,
    punctuation and markup, in any case, width and script variant, single letters changed or lost. Null and empty
    texts hold nothing; repeated rows count once; empty tables give an empty result.

    Both sides are k-grams, those of the documents winnowed; the items' are broadcast. Their size is summed up before
    anything is collected; items beyond the limit go in parts. Hits are extended in the same pass over the documents,
    whole texts; only the found pairs are shuffled, to count once.
    """
    spark = documents.sparkSession
    told = items.select("item_id", "text", "lang").where("item_id is not null and text is not null")
    letters_in_all = told.agg(F.sum(F.length("text"))).first()[0] or 0
    # Parts by a hash of the id differ in size; a fifth of the limit on average leaves room for that.
    parts = 1 if letters_in_all <= MOST_TEST_LETTERS else -(-5 * letters_in_all // MOST_TEST_LETTERS)
    schema = T.StructType([documents.schema["doc_id"], T.StructField("item_id", T.LongType()), T.StructField("letters", T.IntegerType())])

    def against(part: int) -> DataFrame:
        rows = told.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).distinct().collect()
        shipped = spark.sparkContext.broadcast(Index([(r["item_id"], passage(r["text"]), r["lang"]) for r in rows], letter_table()))

        def search(batches):
            index = shipped.value
            for batch in slices(batches, "text", BYTES_AT_ONCE):
                found = index.leaks(batch.column("text").to_pylist(), scores)
                if not scores:
                    found = [f for f in found if f[2] >= index.need[f[1]]]
                yield pa.record_batch(
                    [batch.column("doc_id").take(pa.array([f[0] for f in found], pa.int64())), pa.array([index.ids[f[1]] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int32())],
                    names=["doc_id", "item_id", "letters"],
                )

        return documents.select("doc_id", "text").mapInArrow(search, schema)

    found = functools.reduce(DataFrame.unionByName, [against(p) for p in range(parts)])
    return found if scores else found.select("doc_id", "item_id").distinct()
