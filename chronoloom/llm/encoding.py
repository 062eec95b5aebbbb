"""Byte-pair encoding of a corpus with a public tokenizer."""

from __future__ import annotations

import base64
import functools
import os
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chronoloom.llm.batches import slices

#: Where the public tokenizer files are.
FOLDER = os.environ.get("TOKENIZERS", "/opt/tokenizers")
#: Fixed value: the pattern of pre-tokens of this tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of distinct pre-tokens that are merged at once; a longer pre-token is merged alone, whole.
QUEUE_BYTES = 3_000_000
#: A bucket of at most so many positions is worked on one by one, a larger one as vectors.
FEW = 12
NO_RANK = np.int32(2**31 - 1)


class RankQueue:
    """The linked-list positions of pairs in one bucket per merge rank, under a bitmap of two levels.

    Bit r of the lower level says that bucket r isn't empty, bit w of the upper level that word w of the lower one
    isn't zero; the next rank is found by the first set bit of both. Positions are never removed when a
    neighbouring merge makes them stale; whoever takes a bucket skips those.
    """

    def __init__(self, ranks: int):
        self.words = [0] * (ranks // 64 + 1)
        self.top = 0
        self.buckets: dict[int, list] = {}

    def push(self, rank: int, positions) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [positions]
            self.words[rank >> 6] |= 1 << (rank & 63)
            self.top |= 1 << (rank >> 6)
        else:
            bucket.append(positions)

    def push_all(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """One push per distinct rank."""
        if len(ranks) == 1:
            self.push(int(ranks[0]), positions)
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cut = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for r, a, b in zip(ranks[np.r_[0, cut]].tolist(), [0, *cut.tolist()], [*cut.tolist(), len(ranks)], strict=True):
            self.push(r, positions[a:b])

    def pop(self):
        """The lowest rank with its positions, or None."""
        if not self.top:
            return None
        w = (self.top & -self.top).bit_length() - 1
        word = self.words[w]
        rank = (w << 6) | ((word & -word).bit_length() - 1)
        self.words[w] = word = word & (word - 1)
        if not word:
            self.top &= self.top - 1
        bucket = self.buckets.pop(rank)
        return rank, bucket[0] if len(bucket) == 1 else np.concatenate(bucket)


class Encoder:
    """Ids of a byte-level BPE vocabulary, given as ranks of byte strings."""

    def __init__(self, path: str):
        lines = Path(path).read_bytes().split(b"\n")
        self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x)}
        by_id = {r: t for t, r in self.ranks.items()}
        self.size = max(by_id) + 1
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        # All pairs (left id, right id) that make a token, with its id: sorted keys for vector lookups, a dict for single ones.
        pair = {}
        for t, r in self.ranks.items():
            for i in range(1, len(t)):
                a, b = self.ranks.get(t[:i]), self.ranks.get(t[i:])
                if a is not None and b is not None:
                    pair[a * self.size + b] = r
        keys = np.fromiter(pair.keys(), np.int64, len(pair))
        vals = np.fromiter(pair.values(), np.int32, len(pair))
        order = np.argsort(keys)
        self.pair, self.keys, self.vals = pair, keys[order], vals[order]
        self.of_bytes = np.array([[pair.get(int(a) * self.size + int(b), NO_RANK) for b in self.single] for a in self.single], dtype=np.int32)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.vals[at], NO_RANK)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and the number of ids of each word.

        All words are one linked list with borders between them, and all pairs of one rank are merged at once, in
        rising order of rank. A pair that a merge brings about never has a lower rank than that merge, so each word
        comes out as if it were merged alone; pairs of one rank that overlap (as in "aaa") go from left to right.
        """
        lens = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        n = len(raw)
        if not n:
            return np.zeros(0, np.int32), lens
        tok = self.single[raw]
        last = np.cumsum(lens) - 1
        nxt = np.arange(1, n + 1, dtype=np.int32)
        nxt[last[lens > 0]] = -1
        prv = np.arange(-1, n - 1, dtype=np.int32)
        prv[(last - lens + 1)[lens > 0]] = -1
        rank = np.full(n, NO_RANK, dtype=np.int32)
        rank[:-1] = self.of_bytes[raw[:-1], raw[1:]]
        rank[nxt < 0] = NO_RANK
        queue = RankQueue(self.size)
        first = np.flatnonzero(rank != NO_RANK).astype(np.int32)
        if len(first):
            queue.push_all(rank[first], first)
        pair, size = self.pair, self.size
        while (got := queue.pop()) is not None:
            r, at = got
            if len(at) <= FEW:
                for i in sorted(set(at.tolist())):
                    if rank[i] != r:
                        continue
                    j = int(nxt[i])
                    k = int(nxt[j])
                    h = int(prv[i])
                    tok[i] = r
                    tok[j] = -1
                    rank[j] = rank[i] = NO_RANK
                    nxt[i] = k
                    if k >= 0:
                        prv[k] = i
                        q = pair.get(r * size + int(tok[k]))
                        if q is not None:
                            rank[i] = q
                            queue.push(q, np.array([i], dtype=np.int32))
                    if h >= 0:
                        q = pair.get(int(tok[h]) * size + r)
                        rank[h] = NO_RANK if q is None else q
                        if q is not None:
                            queue.push(q, np.array([h], dtype=np.int32))
                continue
            at = at[rank[at] == r]
            if not len(at):
                continue
            at = np.unique(at)
            # Overlaps: of a run of neighbouring pairs every second one counts.
            right = nxt[at]
            chained = np.r_[False, right[:-1] == at[1:]]
            if chained.any():
                run = np.arange(len(at)) - np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
                at = at[run % 2 == 0]
                right = nxt[at]
            tok[at] = r
            tok[right] = -1
            rank[right] = NO_RANK
            rank[at] = NO_RANK
            after = nxt[right]
            nxt[at] = after
            ok = after >= 0
            prv[after[ok]] = at[ok]
            before = prv[at]
            before = before[before >= 0]
            # Pairs that begin at a merged token, and pairs that end with one.
            touched = np.concatenate([at[ok], before])
            fresh = self.lookup(tok[touched], tok[nxt[touched]])
            rank[touched] = fresh
            some = fresh != NO_RANK
            if some.any():
                queue.push_all(fresh[some], touched[some])
        kept = tok >= 0
        word = np.repeat(np.arange(len(words)), lens)[kept]
        return tok[kept], np.bincount(word, minlength=len(words))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each text; null and empty texts have none."""
        find = _pattern().findall
        number: dict[str, int] = {}
        sequence: list[int] = []
        lengths = np.zeros(len(texts), np.int64)
        give = number.setdefault
        for i, t in enumerate(texts):
            if t:
                found = find(t)
                lengths[i] = len(found)
                sequence.extend([give(w, len(number)) for w in found])
        if not number:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        words = [w.encode("utf-8", "surrogatepass") for w in number]
        ids, counts, batch, held = [], [], [], 0
        for w in words:
            batch.append(w)
            held += len(w)
            if held >= QUEUE_BYTES:
                a, b = self.merge(batch)
                ids.append(a), counts.append(b)
                batch, held = [], 0
        if batch:
            a, b = self.merge(batch)
            ids.append(a), counts.append(b)
        flat, per = np.concatenate(ids), np.concatenate(counts)
        start = np.cumsum(per) - per
        seq = np.array(sequence, dtype=np.int64)
        n = per[seq]
        ends = np.cumsum(n)
        where = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[seq] - (ends - n), n)
        text_end = np.r_[0, np.cumsum(lengths)]
        total = np.r_[0, ends]
        return flat[where].astype(np.int32), np.diff(total[text_end])


@functools.lru_cache(maxsize=1)
def _pattern():
    import regex

    return regex.compile(PATTERN)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def token_ids(documents: DataFrame, name: str = "byte_bpe_50k", folder: str = FOLDER) -> DataFrame:
    """``doc_id`` and ``ids``, the token ids of ``text`` without special tokens.

    The text is taken as it is; null and empty texts have an empty list. Strings of special tokens are ordinary
    text. Other columns are ignored; every row gives a row, repeated ones too; an empty table gives an empty result.
    The distinct pre-tokens of a batch of rows are merged together by rank (see ``Encoder.merge``); there is no
    shuffle, and the work on a very long pre-token grows no faster than its length times the rank lookups.
    """
    path = f"{folder}/{name}.tiktoken"
    schema = T.StructType([documents.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def encode(batches):
        own = encoder(path)
        for part in slices(batches, "text"):
            ids, n = own.encode(part.column("text").to_pylist())
            offsets = np.r_[0, np.cumsum(n)].astype(np.int32)
            yield pa.record_batch([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))], names=["doc_id", "ids"])

    return documents.select("doc_id", "text").mapInArrow(encode, schema)
