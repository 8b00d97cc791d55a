"""Cross-tokenizer alignment by an associative fragment monoid.

Two tokenizers cut one text into tokens; where a token of both ends, a group ends. A fragment is what is
known of one range of a text's bytes: tokens up to the first common end (open prefix), groups between
common ends (closed), tokens behind the last one (open suffix), or, without a common end, open tokens
only. A token belongs to the range in which it ends. Putting a fragment behind another closes the group
that the first one's suffix and the second one's prefix make up; this is associative, so the fragments
of a text, made range by range in any task, are put together by a tree of joins of eight.

A text is encoded in segments of about `SEGMENT` characters, cut before a lone space between other
characters: there both tokenizers begin anew, for the first starts a word at a space behind a word, and
no piece of the second holds a mark behind another character. Segments of long texts go to tasks of their
own. Texts without such a place are encoded as they are. A text of one range is whole at once.

Links are pairs of tokens of the two sides whose bytes overlap. The bytes between one token end and the
next, of either side, lie in one token of each, so links are as many as distinct ends. Counts of pairs
are summed over all texts; those of the `SENT` most frequent go to all tasks, links of rarer pairs meet
theirs in a join.

Defined results: null and empty texts, and texts that either tokenizer doesn't give back byte for byte
(with a space before), have no tokens; repeated rows are texts of their own; of other columns only doc_id
is carried.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.frequent import most_frequent
from tidemark.llm.ship import ship
from tidemark.workspace import materialise

SEGMENT = 1 << 16  # characters that are encoded together
RANGE = 1 << 16  # bytes of one fragment
FAN = 8  # fragments put together at once
SENT = 1 << 19  # pairs whose counts go to all tasks
TOGETHER = 1 << 19  # characters of texts that are encoded in one call
HELD = 1 << 21  # links a task counts together

Batches = Iterator[pa.RecordBatch]


class Side:
    """One tokenizer as data: how to encode, and the bytes of each token."""

    def __init__(self, names: list[bytes]):
        self.names = names
        self.sizes = np.array([len(n) for n in names], np.int64)

    def encode(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def returns(self, ids: list[int], wanted: bytes) -> bool:
        return b"".join(map(self.names.__getitem__, ids)) == wanted


def _byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves,
    the others in order for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


# Fixed value: how a byte-level vocabulary of this kind splits a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Runs that a merge by plain search would take the square of their length for.
LONG_RUN = re.compile(r"\S{2000}|\s{2000}")


class ByteLevel(Side):
    """A byte-level vocabulary; a space is put before the text. Ids that follow the order of the merges
    are ranks as well: a faster library merges by these, and the definition's own library takes the
    texts with long runs. Both give the same ids."""

    def __init__(self, definition: str):
        import tiktoken
        import tokenizers

        self.model = tokenizers.Tokenizer.from_str(definition)
        self.model.encode_special_tokens = True
        fields = json.loads(definition)
        vocabulary, of = fields["model"]["vocab"], _byte_level()
        names = {i: bytes(of[c] for c in n) for n, i in vocabulary.items() if all(c in of for c in n)}
        special = {t["id"]: t["content"].encode() for t in fields.get("added_tokens", [])}
        size = max([*names, *special]) + 1
        super().__init__([special.get(i, names.get(i, b"")) for i in range(size)])
        made = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in fields["model"]["merges"]]
        ranks = {n: i for i, n in names.items() if i not in special}
        splits = fields["pre_tokenizer"]
        plain = splits["type"] == "ByteLevel" and splits.get("use_regex", True) and not splits.get("add_prefix_space")
        self.ranked = None
        if plain and made == sorted(made) and all(bytes([b]) in ranks for b in range(256)):
            self.ranked = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        out: list = [None] * len(texts)
        slow = []
        for k, text in enumerate(texts):
            if self.ranked is None or LONG_RUN.search(text):
                slow.append(k)
            else:
                out[k] = self.ranked.encode_ordinary(" " + text)
        for k, found in zip(slow, self.model.encode_batch_fast([" " + texts[k] for k in slow], add_special_tokens=False), strict=True):
            out[k] = found.ids
        return out


class Marked(Side):
    """A vocabulary of marked pieces, whose library puts a mark before the text."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            names.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())
        super().__init__(names)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def _sides(first: str, second: bytes) -> tuple[ByteLevel, Marked]:
    """One pair for each Python worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has the cores that Spark gives it
    return ByteLevel(first), Marked(second)


class Tokenizers:
    """The two definitions, to be sent to tasks."""

    def __init__(self, first: str, second: bytes):
        self.first, self.second = first, second

    @classmethod
    def load(cls, byte_level: str, marked: str) -> Tokenizers:
        """Paths that the driver can read; the tasks get what the files hold."""
        with open(byte_level, encoding="utf-8") as a, open(marked, "rb") as b:
            return cls(a.read(), b.read())

    def sides(self) -> tuple[ByteLevel, Marked]:
        return _sides(self.first, self.second)


def cuts(text: str, size: int = SEGMENT) -> list[int]:
    """Where segments begin: 0, and places of lone spaces between other characters, `size` or more apart."""
    out, at = [0], 0
    while len(text) - at > size:
        at = text.find(" ", at + size)
        while at > 0 and (text[at - 1].isspace() or text[at + 1 : at + 2].isspace() or at + 1 == len(text)):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        out.append(at)
    return out


# ---- Fragments

class Fragment:
    """Open tokens as (id, end) arrays of either side, closed groups as text, links of the groups closed by joins."""

    __slots__ = ("groups", "links", "prefix", "suffix", "text")

    def __init__(self, prefix, text: str | None, groups: int, suffix, links: list[np.ndarray]):
        # text is None: no common end, all tokens are in `prefix`.
        self.prefix, self.text, self.groups, self.suffix, self.links = prefix, text, groups, suffix, links


NONE = (np.empty(0, np.int64), np.empty(0, np.int64))


def _behind(a, b):
    return tuple((np.concatenate([x[0], y[0]]), np.concatenate([x[1], y[1]])) for x, y in zip(a, b, strict=True))


def _places(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct ends of both sides in order, and the token of either side that each lies in. Ends
    count from where both sides start."""
    if not len(a_ends):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    size = int(a_ends[-1]) + 1
    marks = np.zeros((2, size), np.int8)
    marks[0, a_ends], marks[1, b_ends] = 1, 1
    ends = np.flatnonzero(marks[0] | marks[1])
    before = [np.cumsum(m, dtype=np.int32)[ends] - m[ends] for m in marks]
    return ends, before[0], before[1]


class Pairs:
    """Pairs of ids as numbers: second id first, in 32 bits where all fit."""

    def __init__(self, first: int, second: int):
        self.first = first
        self.kind = np.uint32 if first * second < 1 << 32 else np.int64

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return b.astype(self.kind) * self.kind(self.first) + a.astype(self.kind)


def links_of(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """Pairs of ids whose tokens overlap, for tokens that start and end together, as b << 32 | a."""
    ends = np.union1d(a_ends, b_ends)
    return (b[np.searchsorted(b_ends, ends)] << 32) | a[np.searchsorted(a_ends, ends)]


class Writer:
    """Ids with each of the four marks that may follow them, ready to be put in a row."""

    MARKS = (",", "|", ";", "")

    def __init__(self) -> None:
        self.table: list[str] = []

    def write(self, a: np.ndarray, a_group: np.ndarray, b: np.ndarray, b_group: np.ndarray) -> str:
        """Groups in order: `a1,a2|b1;...`, without a mark at the end."""
        if not len(a):
            return ""
        mark_a = np.where(np.append(a_group[1:] != a_group[:-1], True), 1, 0)
        mark_b = np.where(np.append(b_group[1:] != b_group[:-1], True), 2, 0)
        mark_b[-1] = 3
        order = np.argsort(np.concatenate([a_group * 2, b_group * 2 + 1]), kind="stable")
        codes = np.concatenate([a * 4 + mark_a, b * 4 + mark_b])[order]
        known, most = len(self.table) // 4, int(codes.max()) // 4 + 1
        self.table += [f"{i}{m}" for i in range(known, most) for m in self.MARKS]
        return "".join(map(self.table.__getitem__, codes.tolist()))


WRITER = Writer()


def fragment(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray, *, head: bool) -> tuple[Fragment, np.ndarray, np.ndarray]:
    """The fragment of tokens that end in one range, and the closed tokens of both sides. `head`: the range
    starts where tokens of both sides start."""
    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
    if not len(common):
        tokens, none = ((a, a_ends), (b, b_ends)), (NONE, NONE)
        # The start of a text is a common end too: what follows it is open behind it.
        return (Fragment(none, "", 0, tokens, []) if head else Fragment(tokens, None, 0, none, [])), *NONE
    first = -1 if head else common[0]
    last = common[-1]
    parts = []
    for ids, ends in ((a, a_ends), (b, b_ends)):
        lo, hi = np.searchsorted(ends, first, "right"), np.searchsorted(ends, last, "right")
        parts.append(((ids[:lo], ends[:lo]), (ids[lo:hi], ends[lo:hi]), (ids[hi:], ends[hi:])))
    (a0, a1, a2), (b0, b1, b2) = parts
    text = WRITER.write(a1[0], np.searchsorted(common, a1[1]), b1[0], np.searchsorted(common, b1[1]))
    return Fragment((a0, b0), text, len(common) - (0 if head else 1), (a2, b2), []), a1[0], b1[0]


def join(x: Fragment, y: Fragment) -> Fragment:
    """`y` behind `x`."""
    if x.text is None and y.text is None:
        return Fragment(_behind(x.prefix, y.prefix), None, 0, (NONE, NONE), x.links + y.links)
    if x.text is None:
        return Fragment(_behind(x.prefix, y.prefix), y.text, y.groups, y.suffix, x.links + y.links)
    if y.text is None:
        return Fragment(x.prefix, x.text, x.groups, _behind(x.suffix, y.prefix), x.links + y.links)
    a, b = _behind(x.suffix, y.prefix)
    if not len(a[0]):
        return Fragment(x.prefix, ";".join(t for t in (x.text, y.text) if t), x.groups + y.groups, y.suffix, x.links + y.links)
    zero = [np.zeros(len(s[0]), np.int64) for s in (a, b)]
    middle = WRITER.write(a[0], zero[0], b[0], zero[1])
    text = ";".join(t for t in (x.text, middle, y.text) if t)
    return Fragment(x.prefix, text, x.groups + 1 + y.groups, y.suffix, [*x.links, links_of(*a, *b), *y.links])


# ---- Fragments as rows

OPEN = ("pa", "pa_ends", "pb", "pb_ends", "sa", "sa_ends", "sb", "sb_ends")
FRAGMENT = {"uid": "bigint", "place": "bigint", "closed": "boolean", "text": "string", "n_groups": "bigint", **dict.fromkeys((*OPEN, "links"), "binary")}
# Of one range besides: the closed tokens, how many tokens end in it, and whether it is a whole text.
RANGED = {**FRAGMENT, "doc_id": "bigint", "ok": "boolean", "lone": "boolean", "n_a": "bigint", "n_b": "bigint", "ids_a": "binary", "ids_b": "binary"}
_ARROW = {"bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.large_string(), "binary": pa.large_binary()}


def _ddl(fields: dict) -> str:
    return ", ".join(f"{n} {t}" for n, t in fields.items())


def _columns(rows: list[dict], fields: dict) -> list[pa.Array]:
    narrow = {pa.large_string(): pa.string(), pa.large_binary(): pa.binary()}
    return [pa.array([r[n] for r in rows], narrow.get(_ARROW[t], _ARROW[t])) for n, t in fields.items()]


def _packed(f: Fragment) -> dict:
    (a0, b0), (a2, b2) = f.prefix, f.suffix
    links = np.concatenate(f.links) if f.links else np.empty(0, np.int64)
    return {
        "closed": f.text is not None, "text": f.text or "", "n_groups": f.groups,
        **{name: x.astype(np.int64).tobytes() for name, x in zip(OPEN, (*a0, *b0, *a2, *b2), strict=True)}, "links": links.tobytes(),
    }


def _unpacked(row: dict) -> Fragment:
    x = {name: np.frombuffer(row[name], np.int64) for name in (*OPEN, "links")}
    prefix = ((x["pa"], x["pa_ends"]), (x["pb"], x["pb_ends"]))
    suffix = ((x["sa"], x["sa_ends"]), (x["sb"], x["sb_ends"]))
    return Fragment(prefix, row["text"] if row["closed"] else None, row["n_groups"], suffix, [x["links"]] if len(x["links"]) else [])


class Packer:
    """Token ids of one text as few bytes: half-size numbers, compressed."""

    def __init__(self, vocabulary: int):
        self.kind = np.uint16 if vocabulary <= 1 << 16 else np.uint32
        self.pack_bytes = zstandard.ZstdCompressor(level=1).compress
        self.unpack_bytes = zstandard.ZstdDecompressor().decompress

    def pack(self, ids: np.ndarray) -> bytes:
        return self.pack_bytes(ids.astype(self.kind).tobytes())

    def unpack(self, packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each row has; an empty value is no ids."""
        parts = [np.frombuffer(self.unpack_bytes(p) if p else b"", self.kind) for p in packed]
        return np.concatenate([np.empty(0, self.kind), *parts]).astype(np.int64), np.array([len(x) for x in parts], np.int64)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest() if text else ""


def _cut(size: int):
    """Rows of long texts to rows of their segments, each without the space before it."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for uid, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("uid", "doc_id", "text")), strict=True):
                places, start = cuts(text, size), 0
                for k, (lo, hi) in enumerate(zip(places, [*places[1:], len(text)], strict=True)):
                    piece = text[lo + (k > 0) : hi]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([uid]), pa.array([doc_id], pa.int64()), pa.array([start]), pa.array([piece])], ["uid", "doc_id", "start", "text"]
                    )
                    start += len(piece.encode()) + 1

    return run


def _encoded(tokenizers: Tokenizers, range_size: int, whole: bool):
    """Rows of segments (uid, doc_id, start, text) to rows of fragments. `whole`: each is a whole text."""

    def several(rows: list[tuple]) -> pa.RecordBatch:
        first, second = tokenizers.sides()
        packers = [Packer(len(side.names)) for side in (first, second)]
        texts, out = [r[3] for r in rows], []
        for (uid, doc_id, start, text), a, b in zip(rows, first.encode(texts), second.encode(texts), strict=True):
            wanted = (" " + text).encode()
            ok = first.returns(a, wanted) and second.returns(b, wanted)
            if not ok or not text:
                a, b = [], []
            sides = [(ids := np.array(x, np.int64), np.cumsum(side.sizes[ids])) for x, side in ((a, first), (b, second))]
            lone = whole and (len(wanted) <= range_size or not len(a))
            for low in [0] if lone else range(0, len(wanted), range_size):
                own = []
                for ids, ends in sides:
                    lo, hi = np.searchsorted(ends, (low, low + range_size), "right")
                    own += [ids[lo:hi], ends[lo:hi] + start]
                f, closed_a, closed_b = fragment(*own, head=low == 0)
                row = _packed(f)
                if lone:
                    row["text"] = _digest(row["text"])
                out.append({
                    "uid": uid, "place": start + low, **row, "doc_id": doc_id, "ok": ok, "lone": lone, "n_a": len(own[0]), "n_b": len(own[2]),
                    "ids_a": packers[0].pack(closed_a), "ids_b": packers[1].pack(closed_b),
                })
        return pa.RecordBatch.from_arrays(_columns(out, RANGED), list(RANGED))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows, size = [], 0
            for row in zip(*(batch.column(c).to_pylist() for c in ("uid", "doc_id", "start", "text")), strict=True):
                rows.append(row)
                size += len(row[3])
                if size >= TOGETHER:
                    yield several(rows)
                    rows, size = [], 0
            if rows:
                yield several(rows)

    return run


def _composed(last: bool):
    """All fragments of one node, in order, as one; the node bounds their number. The last one's text is hashed."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["place"])
        row = {"uid": rows[0]["uid"], "place": rows[0]["place"], **_packed(reduce(join, map(_unpacked, rows)))}
        if last:
            row["text"] = _digest(row["text"])
        return pa.Table.from_arrays(_columns([row], FRAGMENT), list(FRAGMENT))

    return run


def fragments(docs: DataFrame, tokenizers: Tokenizers, *, segment: int = SEGMENT, range_size: int = RANGE) -> DataFrame:
    """Stored rows of all ranges of all texts."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(tokenizers)  # two vocabulary files
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    number = F.monotonically_increasing_id()
    short = source.filter(F.length("text") <= segment).select(number.alias("uid"), "doc_id", F.lit(0).cast("long").alias("start"), "text")
    long = materialise(source.filter(F.length("text") > segment).select((-1 - number).alias("uid"), "doc_id", "text"), "long-texts")
    segments = long.mapInArrow(_cut(segment), "uid bigint, doc_id bigint, start bigint, text string").repartition("uid", "start")

    def encoded(whole: bool):
        return lambda batches: _encoded(sent.value, range_size, whole)(batches)

    rows = short.mapInArrow(encoded(True), _ddl(RANGED)).unionByName(segments.mapInArrow(encoded(False), _ddl(RANGED)))
    return materialise(rows, "fragments")


def compose(rows: DataFrame, range_size: int = RANGE) -> DataFrame:
    """One fragment for each text of several ranges, by a tree: a node holds the ranges of `FAN` nodes
    below. Of the groups as text it has the hash."""
    ranged = rows.select(*FRAGMENT)
    top = ranged.agg(F.max("place").alias("place")).first()["place"] or 0
    width = range_size
    while True:
        width *= FAN
        node = F.floor(F.col("place") / width).alias("node")
        ranged = ranged.groupBy("uid", node).applyInArrow(_composed(width > top), _ddl(FRAGMENT))
        if width > top:
            return ranged


class Found:
    """The links of a batch of rows: of closed tokens, in order of the rows, then those that joins brought."""

    def __init__(self, batch: pa.RecordBatch, sizes: tuple[np.ndarray, np.ndarray]):
        pairs = Pairs(len(sizes[0]), len(sizes[1]))
        a, lengths = Packer(len(sizes[0])).unpack(batch.column("ids_a").to_pylist())
        b, _ = Packer(len(sizes[1])).unpack(batch.column("ids_b").to_pylist())
        a_ends = np.cumsum(sizes[0][a])
        ends, of_a, of_b = _places(a_ends, np.cumsum(sizes[1][b]))
        links = pairs.of(a[of_a], b[of_b])
        upto = np.concatenate([[0], a_ends])[np.cumsum(lengths)]
        more = [np.frombuffer(x or b"", np.int64) for x in batch.column("links").to_pylist()]
        joined = np.concatenate([np.empty(0, np.int64), *more])
        self.bounds = np.concatenate([[0], np.searchsorted(ends, upto, "right")])
        self.joined_bounds = np.concatenate([[0], np.cumsum([len(x) for x in more])]).astype(np.int64) + len(links)
        self.links = np.concatenate([links, pairs.of(joined & 0xFFFFFFFF, joined >> 32)])

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value of each link, for each row."""
        upto = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return np.diff(upto[self.bounds]) + np.diff(upto[self.joined_bounds])

    def rows(self) -> np.ndarray:
        return np.concatenate([np.repeat(np.arange(len(b) - 1), np.diff(b)) for b in (self.bounds, self.joined_bounds)])


class PairTable:
    """Where a pair stands in a list, by open addressing in numpy."""

    def __init__(self, pairs: np.ndarray):
        self.bits = max(4, int(len(pairs)).bit_length() + 2)
        self.at = np.full(1 << self.bits, -1, np.int32)
        self.pairs = pairs
        left, step = np.arange(len(pairs), dtype=np.int32), 0
        while len(left):
            slot = self._slots(pairs[left], step)
            free = np.flatnonzero(self.at[slot] < 0)
            self.at[slot[free]] = left[free]  # of those that want one place, the last gets it
            left, step = left[self.at[slot] != left], step + 1
        self.steps = step

    def _slots(self, pairs: np.ndarray, step: int) -> np.ndarray:
        mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> np.uint64(64 - self.bits)).astype(np.int64) + step) & ((1 << self.bits) - 1)

    def find(self, links: np.ndarray) -> np.ndarray:
        """Places in the list, -1 for pairs that are not there."""
        out = np.full(len(links), -1, np.int32)
        left = np.arange(len(links), dtype=np.int32)
        for step in range(self.steps):
            at = self.at[self._slots(links[left], step)]
            some = at >= 0
            left, at = left[some], at[some]
            same = self.pairs[at] == links[left]
            out[left[same]] = at[same]
            left = left[~same]
            if not len(left):
                break
        return out


def pair_counts(rows: DataFrame, sent) -> DataFrame:
    """pair (a number of `Pairs`), n, and whether no pair of the same second id has more."""

    def run(batches: Batches) -> Batches:
        sizes, held, size = sent.value, [], 0

        def counted() -> pa.RecordBatch:
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(n.astype(np.int64))], ["pair", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                held.append(Found(batch.slice(at, 512), sizes).links)
                size += len(held[-1])
                if size >= HELD:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    counts = materialise(rows.select("ids_a", "ids_b", "links").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b = F.expr(f"pair div {len(sent.value[0])}").alias("b")
    most = counts.groupBy(b).agg(F.max("n").alias("most"))
    return materialise(counts.select("pair", "n", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "counts")


def link_sums(rows: DataFrame, counts: DataFrame, sent) -> DataFrame:
    """uid, n_best and count_sum of each row of fragments: links whose pair is its second id's most frequent, and all counts."""
    spark = rows.sparkSession
    top = most_frequent(counts, "n", SENT).toArrow()
    kind = Pairs(*map(len, sent.value)).kind
    known = spark.sparkContext.broadcast((top["pair"].to_numpy().astype(kind), top["n"].to_numpy(), top["best"].to_numpy().astype(np.int64)))

    def run(batches: Batches) -> Batches:
        sizes, (pairs, *values) = sent.value, known.value
        table = PairTable(pairs)
        values = [np.append(v, 0) for v in values]  # at -1: what is not there
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                found = Found(part, sizes)
                at = table.find(found.links)
                n, best = (found.sums(v[at]) for v in values)
                missed = np.flatnonzero(at < 0)
                of = found.rows()[missed] if len(missed) else missed
                order = np.argsort(of, kind="stable")
                offsets = np.searchsorted(of[order], np.arange(part.num_rows + 1)).astype(np.int32)
                rest = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.links[missed][order].astype(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("uid"), pa.array(best), pa.array(n), rest], ["uid", "n_best", "count_sum", "rest"])

    found = materialise(rows.select("uid", "ids_a", "ids_b", "links").mapInArrow(run, "uid bigint, n_best bigint, count_sum bigint, rest array<bigint>"), "sums")
    rare = found.select("uid", F.explode("rest").alias("pair")).groupBy("uid", "pair").agg(F.count(F.lit(1)).alias("times")).join(counts, "pair")
    late = rare.select("uid", (F.col("best").cast("long") * F.col("times")).alias("n_best"), (F.col("n") * F.col("times")).alias("count_sum"))
    return found.drop("rest").unionByName(late).groupBy("uid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(docs: DataFrame, tokenizers: Tokenizers, *, segment: int = SEGMENT, range_size: int = RANGE) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(tuple(side.sizes for side in tokenizers.sides()))
    rows = fragments(docs, tokenizers, segment=segment, range_size=range_size)
    several = rows.filter(~F.col("lone"))
    bad = several.groupBy("uid").agg(F.bool_and("ok").alias("ok")).filter("not ok").select("uid")
    good = several.join(bad, "uid", "left_anti")
    whole = materialise(compose(good, range_size), "composed")
    # What joins closed has no tokens of its own ranges, and ranges have no links of joins.
    none = F.lit(b"")
    linked = rows.filter("lone").select("uid", "ids_a", "ids_b", "links").unionByName(good.select("uid", "ids_a", "ids_b", "links")).unionByName(
        whole.select("uid", none.alias("ids_a"), none.alias("ids_b"), "links")
    )
    sums = link_sums(linked, pair_counts(linked, sent), sent)
    totals = several.groupBy("uid").agg(F.first("doc_id").alias("doc_id"), F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))
    long = totals.join(whole.select("uid", "n_groups", "text"), "uid", "left")
    names = ["uid", "doc_id", "n_a", "n_b", "n_groups", "text"]
    every = rows.filter("lone").select(*names).unionByName(long.select(*names)).join(sums, "uid", "left")
    kept = F.col("n_groups") > 0  # a text of several ranges that isn't given back has none

    def count(value: str | Column) -> Column:
        return F.when(kept, value if isinstance(value, Column) else F.col(value)).otherwise(0).cast("long")

    return every.select(
        "doc_id", count("n_a").alias("n_a"), count("n_b").alias("n_b"), count("n_groups").alias("n_groups"),
        count(F.col("n_a") + F.col("n_b") - F.col("n_groups")).alias("n_links"), count("n_best").alias("n_best"),
        count("count_sum").alias("count_sum"), F.when(kept, F.col("text")).otherwise("").alias("groups_sha256"),
    )
