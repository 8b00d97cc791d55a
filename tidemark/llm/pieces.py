"""SentencePiece encoding and decoding with a public model's pieces.

The text is marked as the model wants it: a mark in front and in place of each space. No piece of such a
model has a mark behind another character, so marked words (marks, then other characters) are encoded
apart. The distinct words of a batch are sorted, which makes them the leaves of a trie in depth-first
order; the forward pass of a word starts where it leaves the word before, with all states of the common
prefix at hand.

The model merges pairs by rank (byte-pair encoding), so the best path isn't the one of the greatest sum
of scores. A state of the forward pass is the last piece of a prefix's encoding: of the pieces that end
at a place exactly one can follow the state at its start, namely one that merging the two pieces' text
leaves as those two. Following the states backwards gives the library's own encoding.

Defined results: null text gives null ids and back, empty text no ids and back; characters without a
piece become their UTF-8 bytes; decoding gives back the text, but for marks (U+2581) in it, which turn
into spaces, as they do in the library. All columns stay; a column named as the new one is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.ship import ship

MARK = "▁"
CHARS = 1 << 22  # of text whose distinct words are encoded together
SHORT = (2, 1)
KEPT = 400_000  # words whose ids a worker keeps from one batch to the next


class Pieces:
    """A model's pieces as plain data: small, and independent of where the model's file lies."""

    def __init__(self, names: list[str], scores: list[float], special: set[int], as_bytes: dict[int, int]):
        self.names, self.special, self.as_bytes = names, special, as_bytes
        plain = [i for i in range(len(names)) if i not in special and i not in as_bytes]
        self.ids = {names[i]: i for i in plain}
        self.rank = {names[i]: scores[i] for i in plain}
        self.packed = {i: i.to_bytes(4, "little") for i in plain}
        # The lengths, longest first, of pieces that end in three characters; shorter ones are always tried.
        by_end: dict[str, set[int]] = {}
        for n in self.ids:
            if len(n) > 2:
                by_end.setdefault(n[-3:], set()).add(len(n))
        self.lengths = {end: (*sorted(sizes, reverse=True), 2, 1) for end, sizes in by_end.items()}
        self.byte_ids = {b: i for i, b in as_bytes.items()}
        if any(MARK in n.lstrip(MARK) for n in self.ids):
            raise ValueError("a piece has a mark behind another character: words can't be encoded apart")
        # Characters in no piece never merge: texts are cut at line ends too where that holds.
        cut = "\n" if not any("\n" in n for n in self.ids) else ""
        self.words = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+" if cut else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.follows: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.texts = [self._bytes(i) for i in range(len(names))]

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        special = {i for i in range(n) if model.is_control(i) or model.is_unknown(i)}
        as_bytes = {i: int(names[i][3:5], 16) for i in range(n) if model.is_byte(i)}
        return cls(names, [model.get_score(i) for i in range(n)], special, as_bytes)

    def __reduce__(self):
        return _shared, (tuple(self.names), tuple(self.rank.get(n, 0.0) for n in self.names), frozenset(self.special), tuple(sorted(self.as_bytes.items())))

    def _bytes(self, i: int) -> bytes:
        if i in self.special:
            return b""
        return bytes([self.as_bytes[i]]) if i in self.as_bytes else self.names[i].replace(MARK, " ").encode()

    def merged(self, text: str) -> list[str]:
        """Pair merging as defined: the pair of best rank first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                rank = self.rank.get(parts[k] + parts[k + 1])
                if rank is not None and (best is None or rank > best):
                    best, at = rank, k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _may_follow(self, before: int, piece: int) -> bool:
        """before: -1 at a word's start."""
        left = [self.names[before]] if before >= 0 else []
        return self.merged("".join(left) + self.names[piece]) == [*left, self.names[piece]]

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Each word's ids, packed as 32-bit numbers."""
        ids, follows, lengths, packed = self.ids, self.follows, self.lengths, self.packed
        out: dict[str, bytes] = {}
        last: list[int] = [-1]  # by length of prefix: the last piece of its encoding; -2: a character of no piece
        size: list[int] = [0]
        tail: list[list[bytes]] = [[]]  # kept packed, by prefix
        previous = ""
        for word in sorted(words):
            common, most = 0, min(len(word), len(previous))
            while common < most and word[common] == previous[common]:
                common += 1
            del last[common + 1 :], size[common + 1 :], tail[common + 1 :]
            for end in range(common + 1, len(word) + 1):
                for length in lengths.get(word[end - 3 : end], SHORT) if end > 2 else SHORT[2 - end :]:
                    start = end - length
                    if start < 0:
                        continue
                    piece = ids.get(word[start:end])
                    if piece is None:
                        continue
                    before = last[start]
                    if before == -2:
                        before = -1
                    pair = (before + 1 << 32) | piece
                    ok = follows.get(pair)
                    if ok is None:
                        if len(follows) > 500_000:  # only a cache
                            follows.clear()
                        ok = follows[pair] = self._may_follow(before, piece)
                    if ok:
                        last.append(piece)
                        size.append(length)
                        tail.append(packed[piece])
                        break
                else:
                    last.append(-2)
                    size.append(1)
                    tail.append(b"".join(self.byte_ids[b].to_bytes(4, "little") for b in word[end - 1].encode("utf-8", "surrogatepass")) if self.byte_ids else bytes(4))
            parts, at = [], len(word)
            while at:
                parts.append(tail[at])
                at -= size[at]
            parts.reverse()
            out[word] = b"".join(parts)
            previous = word
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.words.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.known) > KEPT:
            self.known = {}
        known = self.known
        known.update(self.encode_words({w for words in split for w in words if w not in known}))
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.texts.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


@lru_cache(maxsize=2)
def _shared(names: tuple, scores: tuple, special: frozenset, as_bytes: tuple) -> Pieces:
    """One copy for each Python worker, which keeps what it has found out about pairs of pieces."""
    return Pieces(list(names), list(scores), set(special), dict(as_bytes))


def _with(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    keep = [i for i, n in enumerate(batch.schema.names) if n.lower() != name.lower()]
    return pa.RecordBatch.from_arrays([*[batch.column(i) for i in keep], column], [*[batch.schema.names[i] for i in keep], name])


def _schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name.lower() != name.lower()] + [T.StructField(name, kind)])


def _encoded_runs(texts: list[str | None], pieces: Pieces) -> Iterator[bytes | None]:
    first = 0
    while first < len(texts):
        end, total = first, 0
        while end < len(texts) and (end == first or total < CHARS):
            total += len(texts[end] or "")
            end += 1
        for text, packed in zip(texts[first:end], pieces.encode([t or "" for t in texts[first:end]]), strict=True):
            yield None if text is None else packed
        first = end


def encode(docs: DataFrame, pieces: Pieces, *, text: str = "text", into: str = "ids") -> DataFrame:
    """Adds the piece ids of each whole text."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = list(_encoded_runs(batch.column(text).to_pylist(), pieces))
            at = np.cumsum([0] + [len(p or b"") // 4 for p in packed]).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(p or b"" for p in packed), np.int32))
            ids = pa.ListArray.from_arrays(at, flat, mask=pa.array([p is None for p in packed], pa.bool_()))
            yield _with(batch, into, ids)

    return docs.mapInArrow(run, _schema(docs, into, T.ArrayType(T.IntegerType())))


def decode(docs: DataFrame, pieces: Pieces, *, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Adds the text of each row's piece ids."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(ids)
            at, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            null = column.is_null().to_numpy(zero_copy_only=False)
            texts = [None if null[k] else pieces.decode(flat[at[k] : at[k + 1]].tolist()) for k in range(len(column))]
            yield _with(batch, into, pa.array(texts, pa.string()))

    return docs.mapInArrow(run, _schema(docs, into, T.StringType()))
