"""SentencePiece encoding by a table of prefixes.

The greedy merges of a BPE model need not be replayed. For every prefix of a text exactly one piece
can be the last of its encoding: of all pieces that end there (found with an automaton) the one
that is compatible with the last piece of the prefix before it. Two pieces are compatible if the
merges would leave them side by side. The table is filled in one pass; the ids are read off
backwards.
"""

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webgrain.llm.common import packed, unpacked

SPACE = "▁"
CACHE_SEGMENTS = 500_000  # segments whose ids a Python worker remembers
CACHE_PAIRS = 1_000_000  # answers of the pair test a worker remembers


class PieceEncoder:
    """Encoder of one BPE model with byte fallback and no text normalisation."""

    def __init__(self, path: str):
        self.model = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        special = {i for i in range(sp.get_piece_size())
                   if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)}
        self.ids = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if i not in special}
        self.text = {i: p for p, i in self.ids.items()}
        order = sorted((i for p, i in self.ids.items() if len(p) > 1), key=lambda i: -sp.get_score(i))
        # merges of a higher score come first; single characters are never merged
        self.rank = {i: k for k, i in enumerate(order)}
        self.parts = {}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.automaton.add_word(piece, i)
                continue
            left, right = self._last_merge(piece)
            if left is not None:
                self.parts[i] = (left, right)
                self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        # undoing merges from the last backwards needs parts that are merged before their whole
        self.ordered = all(self.rank.get(x, -1) < self.rank[i] for i, lr in self.parts.items() for x in lr)
        joined = "".join(f"\n{p}" for p in self.ids)
        self.free_newline = not any("\n" in p for p in self.ids)
        lead_only = not re.search(f"[^\n{SPACE}]{SPACE}", joined)
        # no merge crosses the start of a run of spaces, nor a character that no piece holds
        self.segments = re.compile(
            f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+" if lead_only and self.free_newline else "(?s:.+)").findall
        self.pairs: dict[int, bool] = {}
        self.cache: dict[str, str] = {}
        self.length = [len(self.text.get(i, "")) for i in range(sp.get_piece_size())]

    def _merged(self, text: str) -> tuple[list[str], tuple]:
        """The merges as the model defines them (short texts only), and the last merge."""
        parts, last = list(text), (None, None)
        while len(parts) > 1:
            best = min(((self.rank[self.ids[a + b]], k) for k, (a, b) in enumerate(zip(parts, parts[1:]))
                        if a + b in self.ids), default=None)
            if best is None:
                break
            k = best[1]
            last = (parts[k], parts[k + 1])
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return parts, last

    def _id(self, piece: str) -> int:
        """Characters without a piece get numbers below zero."""
        return self.ids[piece] if piece in self.ids else -1 - ord(piece)

    def _string(self, i: int) -> str:
        return self.text[i] if i >= 0 else chr(-1 - i)

    def _last_merge(self, piece: str):
        parts, last = self._merged(piece)
        return (self._id(last[0]), self._id(last[1])) if len(parts) == 1 else (None, None)

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges leave ``a`` and ``b`` side by side. Undoes the last merge of the two
        again and again; a merge across the border that would have come first rules the pair out."""
        if not self.ordered:
            return self._merged(self._string(a) + self._string(b))[0] == [self._string(a), self._string(b)]
        rank, ids, parts = self.rank, self.ids, self.parts
        limit = len(rank) + 1
        while True:
            across = ids.get(self._string(a) + self._string(b))
            if across is not None and rank[across] < limit:
                return False
            ra, rb = rank.get(a, -1), rank.get(b, -1)
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = ra, parts[a][1]
            else:
                limit, b = rb + 1, parts[b][0]  # of two equal merges the left one comes first

    def _segment(self, s: str) -> list[int]:
        last = [None] * (len(s) + 1)
        pairs, length, first = self.pairs, self.length, -1 - 0x110000  # before the text
        last[0] = first
        for end, i in self.automaton.iter(s):
            end += 1
            if last[end] is not None:
                continue
            start = end - length[i]
            before = last[start]
            if before is None:
                before = last[start] = -1 - ord(s[start - 1])
            if before != first:
                key = before << 20 | i
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= CACHE_PAIRS:
                        pairs.clear()
                    fits = pairs[key] = self.compatible(before, i)
                if not fits:
                    continue
            last[end] = i
        ids, at = [], len(s)
        while at:
            i = last[at]
            if i is None or i < 0:
                ids.extend(self.bytes[b] for b in reversed(s[at - 1].encode("utf-8", "replace")))
                at -= 1
            else:
                ids.append(i)
                at -= length[i]
        ids.reverse()
        return ids

    def _remember(self, s: str) -> str:
        found = ",".join(map(str, self._segment(s)))
        if len(s) <= 64:
            if len(self.cache) >= CACHE_SEGMENTS:
                self.cache.clear()
            self.cache[s] = found
        return found

    def encode_listed(self, text: str) -> str:
        """The decimal ids joined by commas."""
        if not text:
            return ""
        known = self.cache.get
        segments = self.segments(SPACE + text.replace(" ", SPACE))
        return ",".join([known(s) or self._remember(s) for s in segments])

    def encode(self, text: str) -> list[int]:
        listed = self.encode_listed(text)
        return list(map(int, listed.split(","))) if listed else []

    def forget(self) -> None:
        self.cache.clear()
        self.pairs.clear()

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """One encoder per Python worker and model."""
    return PieceEncoder(path)


def encode(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """The columns of ``docs`` and ``ids`` (array of ints): the whole text encoded without begin or
    end ids. Null and empty texts have no ids. Rows are independent; repeated rows repeat. A column
    named ids is replaced. The model file must lie at ``model_path`` on every machine."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoder(model_path)
        for texts in batches:
            yield pd.Series([np.array(e.encode(t or ""), np.int32) for t in texts])

    return docs.withColumn("ids", ids_of(F.col(text)))


def decode(docs: DataFrame, model_path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """The columns of ``docs`` and ``out``: the text of the ids (null or none: empty)."""

    @F.pandas_udf(T.StringType())
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoder(model_path)
        for column in batches:
            yield pd.Series([e.decode([int(i) for i in x]) if x is not None and len(x) else "" for x in column])

    return docs.withColumn(out, text_of(F.col(ids)))


def encode_and_decode(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """The columns of ``docs`` with the text that the ids decode to, ``ids`` and ``n_tokens``: both ways
    in one step, so that the ids of a batch are held once, as 32-bit numbers."""
    kind = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("text", T.StringType())])

    @F.pandas_udf(kind)
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        e = encoder(model_path)
        for texts in batches:
            ids, back = [], []
            for t in texts:
                found = e.encode(t or "")
                ids.append(np.array(found, np.int32))
                back.append(e.decode(found) if found else "")
            yield pd.DataFrame({"ids": ids, "text": back})
        e.forget()  # workers live on into other stages

    keep = [c for c in docs.columns if c not in ("ids", "n_tokens")]
    out = docs.select(packed(keep), both(F.col(text)).alias("_d"))
    return out.select(
        *[F.col("_d.text").alias(c) if c == text else old for c, old in zip(keep, unpacked(keep))],
        F.col("_d.ids").alias("ids"), F.size("_d.ids").cast("long").alias("n_tokens"))


def digest(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """The columns of ``docs`` and n_tokens, ids_sha256, decoded_sha256: encoding and decoding in one
    pass, without moving the ids. Null and empty texts: no tokens, hashes of the empty string."""
    kind = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                         T.StructField("decoded_sha256", T.StringType())])

    @F.pandas_udf(kind)
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        e = encoder(model_path)
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "replace")).hexdigest()
        for texts in batches:
            rows = []
            for t in texts:
                listed = e.encode_listed(t or "")
                ids = list(map(int, listed.split(","))) if listed else []
                rows.append((len(ids), sha(listed), sha(e.decode(ids) if ids else "")))
            yield pd.DataFrame(rows, columns=kind.names)

    keep = [c for c in docs.columns if c not in kind.names]
    return docs.select(packed(keep), digests(F.col(text)).alias("_d")).select(*unpacked(keep), "_d.*")
