"""Near-duplicate detection with SetSketch registers.

A document is the set of its distinct word shingles. Each of `m` registers keeps, of the exponential
variates that a hash gives the shingles, the least one, on a truncated scale of exponential steps: the
register of a union is the greater of two registers (`merge`), and equal registers are about as likely
as the sets are similar. Bands of registers that agree propose pairs; the counts of registers that are
equal, greater and less give, with the set sizes, the likelihood of each similarity, whose maximum must
come near the threshold; the pairs left are verified on their full sets.

Documents with equal sets are one class from the start. In a bucket each class meets the bucket's first
and last class only: what they link is one component, whose inner pairs need no look. Then the classes
of a bucket that still lie in different components meet each other, so that no link between components
is missed in any bucket, and no pair within one is made twice.

With 42 bands of 6 registers, a pair of similarity 0.8 meets in no band with probability 3e-6, and its
estimate falls short of the margin with less than 1e-8.

Defined results: null texts and texts without words have an empty set and are linked with nothing; with
fewer words than a shingle the whole sequence is the one shingle; repeated rows are documents of their
own with equal sets; `component_id` is the least doc_id that can be reached and ignores null ones. Of
other columns none is carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.components import components, joined
from tidemark.llm.hashing import shingles, slices, word_hashes
from tidemark.llm.ship import ship
from tidemark.workspace import discard, materialise

BANDS, ROWS = 42, 6
M = BANDS * ROWS
STEP, RATE, TOP = 1.001, 20.0, 65535  # base of the scale, rate of the variates, greatest register
HUBS = (3,)  # for each bucket, drawn anew in each of these rounds
TOGETHER = 256  # texts whose sets are handed on at once
MARGIN = 0.15  # six standard deviations of the estimate at the threshold

_seeds = np.random.default_rng(7919).integers(1, 2**32, (3, M), dtype=np.uint32)
_seeds[0] |= np.uint32(1)
_seeds[2] |= np.uint32(1)
_band_seeds = np.random.default_rng(104729).integers(1, 2**64, (BANDS, ROWS + 1), dtype=np.uint64) | np.uint64(1)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a set of 64-bit hashes that isn't empty."""
    least = np.full(M, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(hashes), 512):  # a block stays in the processor's cache
        x = hashes[k : k + 512]
        x = (x >> np.uint64(32)).astype(np.uint32)[:, None] * _seeds[0]
        x += _seeds[1]
        x ^= x >> np.uint32(15)
        x *= _seeds[2]
        np.minimum(least, x.min(axis=0), out=least)
    variate = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(variate) / np.log(STEP)), 0, TOP).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def bands(sketches: np.ndarray) -> np.ndarray:
    """A bucket number for each band of each sketch: one sketch, or one in each row."""
    with np.errstate(over="ignore"):
        out = (sketches.reshape(*sketches.shape[:-1], BANDS, ROWS).astype(np.uint64) + np.uint64(1)) * _band_seeds[:, :ROWS]
        out ^= out >> np.uint64(29)
        out = (out * _band_seeds[:, ROWS:]).sum(axis=-1, dtype=np.uint64)
        return (out ^ (out >> np.uint64(32))).view(np.int64)


def likeliest(equal: np.ndarray, more: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The similarity of greatest likelihood, given register counts and set sizes, for each pair."""
    u = n_a / (n_a + n_b)
    v = 1 - u

    def steps(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (STEP - 1) / STEP) / np.log(STEP)

    def likelihood(j: np.ndarray) -> np.ndarray:
        above, below = steps(u - v * j), steps(v - u * j)
        tiny = 1e-12
        return more * np.log(above + tiny) + less * np.log(below + tiny) + equal * np.log(np.maximum(1 - above - below, tiny))

    low, high = np.zeros(len(u)), np.minimum(u, v) / np.maximum(u, v)
    for _ in range(40):  # the likelihood has one peak
        third = (high - low) / 3
        left = likelihood(low + third) < likelihood(high - third)
        low, high = np.where(left, low + third, low), np.where(left, high, high - third)
    return (low + high) / 2


def _shingle_rows(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    for first, end, data, bounds in slices(texts):
        hashes, counts = word_hashes(data, bounds)
        at = np.concatenate([[0], np.cumsum(counts)])
        for k in range(end - first):
            yield shingles(hashes[at[k] : at[k + 1]], width)


def _set_key(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else b""


def _sketched(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, sketches = [], [], []
            for found in _shingle_rows(batch.column("text"), width):
                sizes.append(len(found))
                keys.append(_set_key(found))
                sketches.append(registers(found).tobytes() if len(found) else b"")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("uid"), batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                    pa.array(sketches, pa.binary()),
                ],
                ["uid", "doc_id", "text_hash", "n_shingles", "key", "sketch"],
            )

    return run


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sketches = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint16).reshape(-1, M)
        at = np.arange(len(sketches) + 1, dtype=np.int32) * BANDS
        yield pa.RecordBatch.from_arrays([batch.column("uid"), pa.ListArray.from_arrays(at, pa.array(bands(sketches).ravel()))], ["uid", "buckets"])


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, TOGETHER):  # sets are larger than their texts
                batch = whole.slice(start, TOGETHER)
                sets = list(_shingle_rows(batch.column("text"), width))
                flat = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
                at = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([_set_key(s) for s in sets], pa.binary()), pa.ListArray.from_arrays(at, flat)],
                    ["doc_id", "key", "members"],
                )

    return run


def _near(cut: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, M) for c in ("sketch_a", "sketch_b")
            )
            found = likeliest(
                (a == b).sum(axis=1), (a > b).sum(axis=1), (a < b).sum(axis=1),
                batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(),
            )
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(found >= cut))

    return run


def _sets_of(uids: DataFrame, classes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """uid and members: the full shingle sets of some classes, made anew from their texts."""
    wanted = materialise(classes.join(uids, "uid", "left_semi").select("uid", "doc_id", "key"), "wanted")
    texts = docs.alias("d").join(
        wanted.select("doc_id").alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")), "left_semi"
    )
    sets = texts.select("doc_id", "text").mapInArrow(_full_sets(width), "doc_id bigint, key binary, members array<bigint>")
    found = materialise(
        sets.alias("s")
        .join(wanted.alias("w"), F.col("s.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("s.key") == F.col("w.key")))
        .select("w.uid", "s.members").dropDuplicates(["uid"]),
        "sets",
    )
    discard(wanted)
    return found


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose sketches come near the threshold."""
    n = classes.select("uid", "n_shingles", "sketch")
    a = n.select(F.col("uid").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sketch").alias("sketch_a"))
    b = n.select(F.col("uid").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sketch").alias("sketch_b"))
    # No set can be similar to one of less than the threshold's share of its size.
    sized = pairs.join(a, "a").join(b, "b").filter(
        F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    )
    return materialise(sized.mapInArrow(_near(percent / 100 - MARGIN), "a bigint, b bigint"), "near")


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    both = pairs.join(sets.select(F.col("uid").alias("a"), F.col("members").alias("of_a")), "a").join(
        sets.select(F.col("uid").alias("b"), F.col("members").alias("of_b")), "b"
    )
    shared = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    counted = both.select("a", "b", shared.alias("shared"), (F.size("of_a") + F.size("of_b")).cast("long").alias("total"))
    links = counted.filter(F.col("shared") * 100 >= (F.col("total") - F.col("shared")) * percent).select("a", "b")
    return materialise(links, "links")


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    near = _likely(pairs, classes, percent)
    ends = near.select(F.explode(F.array("a", "b")).alias("uid")).distinct()
    sets = _sets_of(ends, classes, docs, width)
    links = _similar(near, sets, percent)
    discard(near, sets)
    return links


def _sharing_rare(outside: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that may be similar, by what is rare in them.

    Members stand in order of their number of sets, rarest first. Sets of similarity p share at least
    p / (1 + p) of both sizes, so the first shared member can't be far on in either; if the longer one's
    is looked up among the first (1 - p) of its members, it is among the first (1 - p) / (1 + p) of the
    shorter one's. What is left behind both places bounds the shared part. No similar pair is missed.
    """
    labels = outside.select("uid", "label").distinct()
    members = materialise(
        sets.join(labels, "uid").select("uid", "label", F.size("members").alias("size"), F.explode("members").alias("member")), "members"
    )
    common = members.groupBy("member").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("l"), F.max("label").alias("h"))
    rarest = Window.partitionBy("uid").orderBy("n", "member")
    placed = members.join(common, "member").withColumn("at", F.row_number().over(rarest))
    first = F.floor(F.col("size") * (100 - percent) / 100) + 1
    # A member of one component's sets only can't be shared with another component.
    placed = materialise(placed.filter((F.col("at") <= first) & (F.col("l") < F.col("h"))).select("uid", "label", "size", "member", "at"), "rare")
    few = placed.filter(F.col("at") <= F.floor(F.col("size") * (100 - percent) / (100 + percent)) + 1)
    left = 1 + F.least(F.col("x.size") - F.col("x.at"), F.col("y.size") - F.col("y.at"))
    return placed.alias("x").join(
        few.alias("y"),
        (F.col("x.member") == F.col("y.member")) & (F.col("x.label") != F.col("y.label")) & (F.col("x.size") >= F.col("y.size"))
        & (F.col("y.size") * 100 >= F.col("x.size") * percent)
        & (left * (100 + percent) >= (F.col("x.size") + F.col("y.size")) * percent),
    ).select(F.col("x.uid").alias("a"), F.col("y.uid").alias("b"))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def groups(docs: DataFrame, *, width: int = 5, percent: int = 80) -> DataFrame:
    """uid, doc_id, text_hash, n_shingles, component_id, kept (doc_id = component_id), and `first`: true for one row
    of each component. doc_id is a whole number; rows are told apart by uid."""
    ship(docs.sparkSession)
    numbered = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    )
    sketched = materialise(
        numbered.mapInArrow(_sketched(width), "uid bigint, doc_id bigint, text_hash bigint, n_shingles bigint, key binary, sketch binary"),
        "sketches",
    )
    filled = sketched.filter(F.col("n_shingles") > 0)
    heads = materialise(
        filled.groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")).alias("x")).select(
            "key", F.col("x.uid").alias("uid"), F.col("x.doc_id").alias("class_doc")
        ),
        "heads",
    )
    classes = materialise(filled.join(heads.select("uid"), "uid", "left_semi").drop("text_hash"), "classes")
    rows = materialise(sketched.drop("sketch"), "rows")
    discard(sketched)
    # The buckets are made from the sketches and go through one exchange: the window finds the ends of each.
    entries = classes.select("uid", "sketch").mapInArrow(_buckets, "uid bigint, buckets array<bigint>").select(
        F.posexplode("buckets").alias("band", "bucket"), "uid"
    ).select(F.xxhash64("band", "bucket").alias("bucket"), "uid")
    own = Window.partitionBy("bucket")
    busy = materialise(entries.select("bucket", "uid", F.min("uid").over(own).alias("lo"), F.max("uid").over(own).alias("hi")).filter("lo < hi"), "busy")
    hubs = _ordered(
        busy.select("uid", F.explode(F.array("lo", "hi")).alias("hub")).filter("uid <> hub").select(
            F.col("uid").alias("a"), F.col("hub").alias("b")
        )
    )
    tested = materialise(hubs, "pairs")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    links = _verified(tested, classes, source, width, percent)
    labels = components(links)
    discard(links)
    outside = _open(busy, labels)
    for hubs in HUBS:
        if outside.isEmpty():
            break
        chosen = outside.groupBy("bucket").agg(
            F.array(*[F.min_by(F.struct("uid", "label"), F.xxhash64("uid", F.lit(hubs + k))) for k in range(hubs)]).alias("hubs")
        )
        met = outside.join(chosen, "bucket").select("uid", "label", F.explode("hubs").alias("hub")).filter("label <> hub.label")
        more = _ordered(met.select(F.col("uid").alias("a"), F.col("hub.uid").alias("b"))).join(tested, ["a", "b"], "left_anti")
        more = materialise(more, "pairs")
        discard(outside)
        tested = tested.unionByName(more)
        labels = _relabelled(labels, _verified(more, classes, source, width, percent))
        outside = _open(busy, labels)
    discard(busy)
    if not outside.isEmpty():
        sets = _sets_of(outside.select("uid").distinct(), classes, source, width)
        more = materialise(_ordered(_sharing_rare(outside, sets, percent)).join(tested, ["a", "b"], "left_anti"), "pairs")
        near = _likely(more, classes, percent)
        late = _similar(near, sets, percent)
        discard(sets, more, near)
        labels = _relabelled(labels, late)
    discard(outside, tested, classes)
    return _labelled(rows, heads, labels)


def _relabelled(before: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links, which are deleted with the former labels."""
    if links.isEmpty():
        discard(links)
        return before
    labels = joined(before, links)
    discard(before, links)
    return labels


def _open(busy: DataFrame, labels: DataFrame) -> DataFrame:
    """bucket, uid and label of the buckets whose classes are not all in one component yet. In a bucket of
    three or less every pair has met, for its first and last class have met all."""
    named = busy.select("bucket", "uid").join(labels.select(F.col("node").alias("uid"), "label"), "uid", "left").select(
        "bucket", "uid", F.coalesce("label", "uid").alias("label")
    )
    split = named.groupBy("bucket").agg(
        F.min("label").alias("l"), F.max("label").alias("h"), F.count(F.lit(1)).alias("n")
    ).filter("l < h and n > 3")
    return materialise(named.join(split.select("bucket"), "bucket", "left_semi"), "open")


def _labelled(sketched: DataFrame, heads: DataFrame, labels: DataFrame) -> DataFrame:
    ids = heads.join(labels.select(F.col("node").alias("uid"), "label"), "uid", "left").withColumn(
        "label", F.coalesce("label", "uid")
    )
    least = ids.groupBy("label").agg(
        F.min("class_doc").alias("component_id"),
        F.min(F.struct(F.col("class_doc").isNull().alias("none"), "class_doc", "uid")).alias("x"),
    )
    ids = ids.join(least, "label").select("key", "component_id", F.col("x.uid").alias("first_uid"))
    rows = sketched.select("uid", "doc_id", "text_hash", "n_shingles", "key").join(ids, "key", "left")
    lone = F.col("first_uid").isNull()
    return rows.select(
        "uid", "doc_id", "text_hash", "n_shingles",
        F.when(lone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(lone, F.lit(True)).otherwise(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept"),
        (lone | (F.col("uid") == F.col("first_uid"))).alias("first"),
    )
