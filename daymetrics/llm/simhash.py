"""SimHash near-duplicates: covering locality-sensitive hashing finds every pair within the radius."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymetrics.llm.common import stored

BITS = 64
#: Hashes whose bits are unpacked at a time: 64 bytes each.
_BLOCK = 1 << 16


def shingle_hashes(text: str | None, width: int = 3, seed: int = 42) -> np.ndarray:
    """XXH64 of each run of `width` words (of all words, if fewer), ASCII letters in lower case."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)] if words else [], np.uint64)
    runs = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    return np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(seed)), np.uint64, len(words) - width + 1)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit set, the most significant first."""
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        block = hashes[at : at + _BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash: a bit is set if it is in over half the hashes; 0 without a word."""
    hashes = shingle_hashes(text, width, seed)
    return int.from_bytes(np.packbits(2 * bit_counts(hashes) > len(hashes)).tobytes(), "big")


def fingerprints(documents: DataFrame, row_id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(`row_id`, fp): the fingerprint of every whole text as a signed long, stored."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), width) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    frame = documents.select(F.col(row_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return stored(frame.mapInArrow(compute, "id long, fp long"))


def covering_masks(positions: Sequence[int], radius: int) -> list[int]:
    """2^(radius + 1) - 1 masks over bit positions; any `radius` of them are all outside some mask.

    Each position has a nonzero vector of radius + 1 bits; a mask per nonzero vector v holds the
    positions whose vector has an odd product with v. At most `radius` vectors have a nonzero v
    that is orthogonal to all of them, so two numbers that differ in those positions only agree
    on the mask of that v (covering LSH).
    """
    count = (1 << (radius + 1)) - 1
    vector = {p: i % count + 1 for i, p in enumerate(positions)}
    return [sum(1 << p for p in positions if (vector[p] & v).bit_count() % 2) for v in range(1, count + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _keys(tables: Sequence[tuple[int, int]]) -> Column:
    """An array of (table, masked fingerprint), one for each table and its mask."""
    return F.array(
        *(
            F.struct(F.lit(t).cast("int").alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("k"))
            for t, mask in tables
        )
    )


def _stars(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(root, member) pairs that connect what the links within the radius connect, at most one a
    member. Each fingerprint is compared with those that no component has taken yet."""
    rest, edges = np.sort(fps), []
    while len(rest):
        root, todo, rest = rest[0], [rest[0]], rest[1:]
        while todo and len(rest):
            near = np.bitwise_count((rest ^ todo.pop()).view(np.uint64)) <= radius
            if near.any():
                edges += [(root, m) for m in rest[near]]
                todo += list(rest[near])
                rest = rest[~near]
    return edges


def _links_of_buckets(radius: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches sorted by (t, k); a bucket may go on in the next one, its start is carried over."""
        kept: np.ndarray = np.empty((0, 3), np.int64)
        for batch in chain(batches, [None]):
            if batch is not None:
                new = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in range(3)], axis=1)
                kept = np.concatenate([kept, new])
                if not len(kept):
                    continue
            if not len(kept):
                break
            changes = np.flatnonzero((kept[1:, 1:] != kept[:-1, 1:]).any(axis=1)) + 1
            starts = np.concatenate([[0], changes])
            ends = np.concatenate([changes, [len(kept)]])
            if batch is not None:  # the last bucket may not be whole
                starts, ends = starts[:-1], ends[:-1]
            size = ends - starts
            two = starts[size == 2]
            near = np.bitwise_count((kept[two, 0] ^ kept[two + 1, 0]).view(np.uint64)) <= radius
            pairs = [np.sort(np.stack([kept[two, 0], kept[two + 1, 0]], axis=1)[near], axis=1)]
            for a, b in zip(starts[size > 2], ends[size > 2], strict=True):
                if edges := _stars(kept[a:b, 0], radius):
                    pairs.append(np.array(edges, np.int64))
            found = np.concatenate(pairs)
            kept = kept[ends[-1] :] if len(ends) else kept
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])
            if batch is None:
                break

    return links


def links(fps: DataFrame, radius: int = 3, bucket_limit: int = 4096) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints such that their connected components are those
    of all pairs within the radius.

    Pairs that agree on a mask meet in one of 2^(radius + 1) - 1 tables. A bucket of more than
    `bucket_limit` fingerprints is dealt out again by a covering family over the bits that its
    mask leaves open: nothing is dropped, and what agrees on both masks has at most 16 bits
    open, so a bucket is bounded by 65,536 fingerprints whatever the input.
    """
    masks = covering_masks(range(BITS), radius)
    keyed = fps.select("fp", F.explode(_keys(list(enumerate(masks)))).alias("key")).select("fp", "key.t", "key.k")
    hot = keyed.groupBy("t", "k").count().where(F.col("count") > bucket_limit).select("t", "k", F.lit(True).alias("hot"))
    marked = keyed.join(hot, ["t", "k"], "left")
    again = F.lit(None)
    for t, mask in enumerate(masks):
        open_bits = [p for p in range(BITS) if not mask >> p & 1]
        finer = [(len(masks) * (t + 1) + i, mask | m) for i, m in enumerate(covering_masks(open_bits, radius))]
        again = F.when(F.col("t") == t, _keys(finer)).otherwise(again)
    same = F.array(F.struct(F.col("t"), F.col("k")))
    dealt = marked.select("fp", F.explode(F.when(F.col("hot"), again).otherwise(same)).alias("key"))
    return (
        dealt.select("fp", "key.t", "key.k")
        .repartition("t", "k")
        .sortWithinPartitions("t", "k")
        .mapInArrow(_links_of_buckets(radius), "a long, b long")
        .distinct()
    )


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, label) for every node of the edges (a, b): its component's smallest node.

    Large and small stars in turn: each node points its larger neighbours, then its smaller
    ones, to the smallest it knows, until nothing changes. Minima are combined before the
    shuffle; each round is stored, so plans stay short and a lost executor repeats one round.
    """
    state = None
    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    for _ in range(rounds):
        facts = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(facts) == state or not facts[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            )
        state = tuple(facts)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Stored, so that the join below has an exchange of its own, whose hot nodes Spark can split.
        low = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = stored(large.distinct())
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")))
        joined = large.join(low, "u")
        small = joined.select("u", F.col("m").alias("v")).unionByName(
            joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        now = stored(small.distinct())
    raise RuntimeError("the components did not settle")


def cluster(
    documents: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    radius: int = 3,
    width: int = 3,
    bucket_limit: int = 4096,
) -> DataFrame:
    """(`row_id`, fingerprint, component_id) for every row of `documents`.

    The fingerprint covers the whole text. Texts whose fingerprints differ in at most `radius`
    bits are linked; component_id is the smallest id that links reach, the row's own included.
    Null and empty texts have fingerprint zero and link like any other. Rows with equal
    fingerprints count once in the search, so repeated rows and groups of copies of any size
    cost nothing there. A null id is kept but never a component_id; an empty table gives an
    empty one; other columns are not looked at.
    """
    rows = fingerprints(documents, row_id, text, width)
    unique = stored(rows.groupBy("fp").agg(F.min("id").alias("first_id")))
    found = components(links(unique.select("fp"), radius, bucket_limit))
    label = F.coalesce(F.col("label"), F.col("fp"))
    labelled = stored(
        unique.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", label.alias("label"))
    )
    smallest = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of_fp = labelled.join(smallest, "label").select("fp", "component_id")
    return rows.join(of_fp, "fp").select(
        F.col("id").alias(row_id),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )
