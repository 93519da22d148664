"""Jaccard join on word n-grams by prefixes of token combinations.

All tokens (hashed n-grams) have one order: rare ones first, frequent ones by how frequent they are.
Of a set of n tokens, t = n - ceil(similarity n) may be missing from a set it links to, so the two
share something in their first tokens as soon as those outnumber t. Rare tokens are indexed alone.
Frequent ones fall into groups, and k of one group are indexed together (k is 2, or 3 for the most
frequent): a group of m prefix tokens then counts as m - k + 1 only, and the prefix is extended
until the counts add up to t + 1. Whatever t tokens are missing, a rare token or k tokens of one
group are left, and these lie in the prefix of both sets: the prefix that ends earlier in the
order is covered by the other one.

Prefixes are extended by some more single tokens, in proportion to the size of the set: two sets
then share as many more, so chance meetings in a token or two are no candidates. Sets that share
enough, or a frequent combination, are; and every link is verified on the whole sets.

Counters cannot tell how frequent a token is below their own noise, which grows with the input, so
single tokens may have many sets all the same. Such a token is no reason to connect its sets: it
connects those that have as many such tokens as a link needs, and for others it only counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymetrics.llm.common import stored
from daymetrics.llm.simhash import components

#: Counters of token frequency, of fixed size whatever the input, and how many go into a row.
COUNTERS, _ROW = 1 << 22, 1 << 16
_SHIFT = np.uint64(64 - 22)
#: Occurrences, beyond what a counter holds of other tokens, from which a token is indexed with one more
#: of its group, and with two more.
PAIRED, TRIPLED = 64, 512
#: A set of 2^j tokens or more, and less than twice as many, deals frequent tokens to 2^(j - 4) groups;
#: smaller sets have no groups and index each token alone.
_GROUP_BITS = 4
#: Single tokens that linked sets must share: this many, and one more for each _EXTRA tokens.
_SHARED, _EXTRA = 2, 48
#: Sets of a key up to which all pairs are counted; a longer list counts as shared, and connects neighbours
#: among the sets that links might have by long lists alone.
_LIST = 64
_ANY = 1 << 30
#: Bits that say which sets are candidates: 8 MB.
_SLOTS = 1 << 26
#: Tokens verified together in one task; larger families are dealt out in pairs of blocks.
FAMILY_TOKENS = 1 << 22
#: Sets a task remembers so as not to repeat copies.
_SEEN = 200_000
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def tokens_of(text: bytes | None, width: int = 4) -> np.ndarray:
    """The set of `width`-word shingles as sorted 64-bit hashes; all words as one, if they are fewer."""
    words = (text or b"").lower().split()
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), len(words))] if words else [], np.uint64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    count = len(words) - width + 1
    mixed = np.zeros(count, np.uint64)
    for i in range(width):
        mixed = (mixed + each[i : i + count]) * _MIX[i % len(_MIX)]
        mixed ^= mixed >> np.uint64(31)
    return np.unique(mixed)


def _name(tokens: np.ndarray) -> bytes:
    return blake2b(tokens.tobytes(), digest_size=16).digest()


class _Seen:
    """Names met before; forgets all when it is full, which costs a repetition and no more."""

    def __init__(self) -> None:
        self.names: set[bytes] = set()

    def first(self, name: bytes) -> bool:
        if name in self.names:
            return False
        if len(self.names) >= _SEEN:
            self.names.clear()
        self.names.add(name)
        return True


def _read(width: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row (id, n, name) for each document and, last, rows (at, counts) of the task's counters."""
        counts, waiting, size, seen = np.zeros(COUNTERS, np.int64), [], 0, _Seen()
        names = ["id", "n", "name", "at", "counts"]

        def add() -> None:
            nonlocal counts, waiting, size
            if waiting:
                counts += np.bincount((np.concatenate(waiting) >> _SHIFT).view(np.int64), minlength=COUNTERS)
            waiting, size = [], 0

        for batch in batches:
            n, name = [], []
            for text in batch.column(1):
                tokens = tokens_of(text.as_py(), width)
                n.append(len(tokens))
                name.append(_name(tokens))
                if len(tokens) and seen.first(name[-1]):
                    waiting.append(tokens)
                    size += len(tokens)
                    if size > COUNTERS:
                        add()
            none = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(name, pa.binary()), pa.nulls(none, pa.int32()), pa.nulls(none, pa.binary())],
                names,
            )
        add()
        small = counts.astype(np.uint8 if counts.max() < 256 else np.uint32 if counts.max() < 1 << 32 else np.uint64)
        parts = [(i, small[i * _ROW : (i + 1) * _ROW]) for i in range(COUNTERS // _ROW)]
        parts = [(i, x) for i, x in parts if x.any()]
        if parts:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(len(parts), pa.int64()), pa.array([int(x.sum(dtype=np.int64)) for _, x in parts], pa.int64()),
                    pa.nulls(len(parts), pa.binary()), pa.array([i for i, _ in parts], pa.int32()),
                    pa.array([x.tobytes() for _, x in parts], pa.binary()),
                ],
                names,
            )

    return read


class Levels:
    """The order of tokens: a level for each counter, 0 for the rarest tokens.

    A counter holds other tokens too, about the mean `load`. Up to a few deviations above that a
    token counts as rare; each doubling of what is above is a level. Levels of the most frequent
    tokens have their combinations.
    """

    def __init__(self, load: float) -> None:
        self.load, self.unit = load, 3 * load**0.5 + 3
        self.of = np.zeros(COUNTERS, np.uint8)
        self.paired, self.tripled = (int(self.level(np.array([load + x]))[0]) + 1 for x in (PAIRED, TRIPLED))

    def level(self, counts: np.ndarray) -> np.ndarray:
        above = np.maximum((counts - self.load) / self.unit, 2.0**-9)
        return np.clip(np.floor(np.log2(above)) + 1, 0, 60).astype(np.uint8)

    def together(self, level: int) -> int:
        """How many tokens of this level's groups are indexed as one."""
        return 1 if level < self.paired else 2 if level < self.tripled else 3


def _leveled(levels: Levels):
    def leveled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (at, counts) added by `at` and turned into a level a counter."""
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                kind = {1: np.uint8, 4: np.uint32, 8: np.uint64}[len(counts) // _ROW]
                sums.setdefault(at, np.zeros(_ROW, np.int64))
                sums[at] += np.frombuffer(counts, kind).astype(np.int64)
        if sums:
            level = [levels.level(s).tobytes() for s in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(level, pa.binary())], ["at", "levels"])

    return leveled


def token_levels(counters: DataFrame) -> Levels:
    """A level for each counter, from the counts of all texts: 4 MB, whatever the input."""
    levels = Levels((counters.agg(F.sum("n")).first()[0] or 0) / COUNTERS)
    parts = counters.select("at", "counts").repartition("at").mapInArrow(_leveled(levels), "at int, levels binary")
    for r in parts.collect():  # 64 rows
        levels.of[r["at"] * _ROW : (r["at"] + 1) * _ROW] = np.frombuffer(r["levels"], np.uint8)
    return levels


def _smallest(percent: int) -> int:
    """The least size of a set that can link to a different one."""
    return 1 if percent <= 0 else -(-percent // (100 - percent)) if percent < 100 else 1 << 62


def _divisions(n: int, percent: int) -> list[int]:
    """log2 of the numbers of groups that a set of n tokens and the sets it may link to use; -1 for none."""
    low, high = -(-n * percent // 100), n * 100 // percent
    of = lambda s: max(s.bit_length() - 1 - _GROUP_BITS, -1)
    return list(range(of(max(low, 1)), of(high) + 1))


def signatures(tokens: np.ndarray, levels: Levels, percent: int) -> tuple[np.ndarray, int]:
    """What a set is indexed by, prefix tokens alone or hashed combinations of frequent ones, and how
    much of it a set that links has as well (_ANY if that is only known to be something)."""
    n = len(tokens)
    needed = n - -(-n * percent // 100) + 1
    share = _SHARED + n // _EXTRA
    level = levels.of[(tokens >> _SHIFT).view(np.int64)]
    single = np.flatnonzero(level < levels.paired)
    order = np.argsort(level[single], kind="stable")  # by level, then by token
    alone = tokens[single[order]][: needed + share - 1]
    if len(alone) >= needed:
        return alone, len(alone) - needed + 1 if len(alone) > needed else _ANY
    often = np.flatnonzero(level >= levels.paired)
    often = often[np.argsort(level[often], kind="stable")]
    found = [alone]
    for division in _divisions(n, percent):
        left = needed - len(alone)
        if division < 0:
            found.append(tokens[often[:left]])
            continue
        groups: dict[tuple[int, int], list[int]] = {}
        for token, its_level in zip(tokens[often].tolist(), level[often].tolist(), strict=True):
            k = levels.together(its_level)
            group = groups.setdefault((k, token & ((1 << division) - 1)), [])
            group.append(token)
            left -= len(group) >= k
            if not left:
                break
        else:
            raise ValueError("a set is too small for its groups at this similarity")
        keys = [
            xxhash.xxh64_intdigest(np.array([division, *some], np.uint64).tobytes())
            for (k, _), group in groups.items()
            for some in combinations(group, k)
        ]
        found.append(np.array(keys, np.uint64))
    return np.concatenate(found), _ANY


def _indexed(levels: Levels, width: int, percent: int):
    least = _smallest(percent)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(key, n, set, share): postings of each set of the task; `set` is the first half of its name."""
        seen = _Seen()

        def out(keys: list[np.ndarray], of_sets: list[tuple[int, int, int]]) -> pa.RecordBatch:
            times = [len(k) for k in keys]
            each = np.repeat(np.array(of_sets, np.int64).reshape(-1, 3), times, axis=0)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)),
                    pa.array(each[:, 0].astype(np.int32)), pa.array(each[:, 1]), pa.array(each[:, 2].astype(np.int32)),
                ],
                ["key", "n", "set", "share"],
            )

        for batch in batches:
            keys, of_sets, held = [], [], 0
            for text in batch.column(0):
                tokens = tokens_of(text.as_py(), width)
                if len(tokens) < least or not seen.first(name := _name(tokens)):
                    continue
                found, share = signatures(tokens, levels, percent)
                keys.append(found)
                of_sets.append((len(tokens), int.from_bytes(name[:8], "big", signed=True), share))
                held += len(found)
                if held > 1 << 19:
                    yield out(keys, of_sets)
                    keys, of_sets, held = [], [], 0
            yield out(keys, of_sets)

    return index


def _listed(percent: int, longest: int | None = None, chained: bool = True):
    longest = _LIST if longest is None else longest
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]
    names = ["a", "b", "share", "part", "key", "n", "key_", "n_"]

    def rows(a: np.ndarray, b: np.ndarray | None, share: np.ndarray, key: np.ndarray | None = None, n: np.ndarray | None = None) -> pa.RecordBatch:
        given = (a, b, share.astype(np.int32), None, key, None if n is None else n.astype(np.int32), None, None)
        there = [pa.nulls(len(a), kind) if x is None else pa.array(x) for x, kind in zip(given, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(there, names)

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Postings (key, n, set, share) in order, to rows of two kinds, and the ends of the partition.

        (a, b, share): a pair of one key whose sizes fit, and how many keys it must share. Of lists of
        more than `longest` sets, if `chained`, (a, b, 0): neighbours, which connect all in the list
        that fit; else (a, null, share, key, n): the list's postings. A list that may go on in
        another partition is a long one.
        """

        def of(block: np.ndarray, first_long: bool, last_long: bool, told: int = 0) -> Iterator[pa.RecordBatch]:
            key, n, who, share = block.T
            run = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
            long = np.bincount(run) > longest
            long[0] |= first_long
            long[-1] |= last_long
            for apart in range(1, max(longest, 2)):
                if len(key) <= apart:
                    break
                fits = (run[apart:] == run[:-apart]) & (n[:-apart] * 100 >= n[apart:] * percent)
                x, y = who[:-apart], who[apart:]
                a, b, among = np.minimum(x, y), np.maximum(x, y), long[run[apart:]]
                pair, most = fits & ~among, np.minimum(share[:-apart], share[apart:])
                yield rows(a[pair], b[pair], np.where(most[pair] == _ANY, 1, most[pair]))
                if chained and apart == 1 and (chain := fits & among).any():
                    a, b = np.unique(np.stack([a[chain], b[chain]]), axis=1)
                    yield rows(a, b, np.zeros(len(a)))
            if not chained and (at := np.flatnonzero(long[run][told:]) + told).size:
                yield rows(who[at], None, share[at], key[at], n[at])

        held, first, last, open_long, told = np.empty((0, 4), np.int64), None, None, True, 0
        for batch in batches:
            new = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in range(4)], axis=1)
            if not len(new):
                continue
            first, last = new[0] if first is None else first, new[-1]
            held = np.concatenate([held, new])
            repeats = (held[1:, [0, 2]] == held[:-1, [0, 2]]).all(axis=1)
            held = held[np.concatenate([[True], ~repeats])]
            start = int(np.flatnonzero(np.concatenate([[True], held[1:, 0] != held[:-1, 0]]))[-1])
            if start:
                yield from of(held[:start], open_long, False, told)
                held, open_long, told = held[start:], False, 0
            if len(held) > longest:  # goes on as a long list from its last row
                yield from of(held, True, True, told)
                held, open_long, told = held[-1:], True, 1
        if len(held):
            yield from of(held, True, True, told)
            ends = (first[2], last[2], 0, TaskContext.get().partitionId(), first[0], first[1], last[0], last[1])
            yield pa.RecordBatch.from_arrays([pa.array([int(x)], k) for x, k in zip(ends, kinds, strict=True)], names)

    return lists


def _lists(postings: DataFrame, percent: int, *how) -> DataFrame:
    """What `_listed` makes of postings dealt by ranges of (key, n, set): those of a hot key lie in many tasks."""
    dealt = postings.repartitionByRange("key", "n", "set").sortWithinPartitions("key", "n", "set")
    schema = "a long, b long, share int, part int, key long, n int, key_ long, n_ int"
    return stored(dealt.select("key", "n", "set", "share").mapInArrow(_listed(percent, *how), schema))


def candidates(postings: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of sets that connect all pairs of fitting sizes that share enough keys.

    A pair counts the short lists it is in, and might be in each long list that both its sets are
    in. Two sets that share nothing but long lists are each in as many as they must share: such sets
    are chained in their long lists, where the ends of the ranges, two rows a task, are joined afterwards.
    """
    found = _lists(postings, percent, None, False).where("part IS NULL")
    pairs = found.where("b IS NOT NULL").groupBy("a", "b").agg(F.count(F.lit(1)).alias("got"), F.min("share").alias("share"))
    of_long = found.where("b IS NULL").select("key", "n", F.col("a").alias("set"), "share")
    # A set that fits is smaller by `percent` at most, so that is how much the pair must share at least.
    least = F.least("share", (F.floor(F.col("n").cast("long") * percent / (100 * _EXTRA)) + _SHARED).cast("int"))
    long = stored(
        of_long.groupBy("set").agg(F.count(F.lit(1)).alias("long"), F.min(F.when(F.col("share") < _ANY, least).otherwise(1)).alias("least"))
    )
    by_long = of_long.join(long.where("long >= least").select("set"), "set", "left_semi")
    chained = _lists(stored(by_long), percent, 1, True)
    ends = sorted(chained.where("part IS NOT NULL").collect(), key=lambda r: r["part"])
    across = [
        (x["b"], y["a"])
        for x, y in zip(ends, ends[1:], strict=False)
        if x["key_"] == y["key"] and x["b"] != y["a"] and x["n_"] * 100 >= y["n"] * percent
    ]
    chains = chained.where("part IS NULL").select("a", "b").distinct()
    more = lambda x: long.select(F.col("set").alias(x), F.col("long").alias(f"_{x}"))
    might = F.least(F.coalesce("_a", F.lit(0)), F.coalesce("_b", F.lit(0)))
    enough = pairs.join(more("a"), "a", "left").join(more("b"), "b", "left").where(F.col("got") + might >= F.col("share"))
    linked = chains.unionByName(enough.select("a", "b"))
    return linked.unionByName(postings.sparkSession.createDataFrame(across, "a long, b long")) if across else linked


def _marked(members: DataFrame) -> np.ndarray:
    """One bit for each slot that a candidate's hash falls on: 8 MB, whatever the input."""
    slot = F.col("set").bitwiseAND(F.lit(_SLOTS - 1)) + 1
    made = members.groupBy(F.bitmap_bucket_number(slot).alias("at")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")
    )
    bits = np.zeros(_SLOTS // 8, np.uint8)
    for r in made.collect():  # 2,048 rows of 4 kB at most
        bits[(r["at"] - 1) * 4096 :][: len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    return bits


def _fetched(bits: np.ndarray, width: int, short: bool):
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(name, tokens) of the sets whose bit is set; two bytes of each token, or all eight."""
        seen = _Seen()
        for batch in batches:
            names, sets = [], []
            for text in batch.column(0):
                tokens = tokens_of(text.as_py(), width)
                name = _name(tokens)
                slot = int.from_bytes(name[:8], "big") & (_SLOTS - 1)
                if len(tokens) and bits[slot >> 3] >> (slot & 7) & 1 and seen.first(name):
                    names.append(name)
                    sets.append((np.sort(tokens.astype(np.uint16)) if short else tokens).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(sets, pa.binary())], ["name", "tokens"])

    return fetch


def numbered(values: np.ndarray) -> np.ndarray:
    """Sorted values made distinct by the number of equal ones before each."""
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    before = np.arange(len(values)) - np.repeat(starts, np.diff(np.append(starts, len(values))))
    return values.astype(np.uint64) | before.astype(np.uint64) << np.uint64(16)


def exact_links(ids: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """(root, member) pairs that connect what the links among the sets connect, at most one a member.

    A set is compared with all that no component has taken yet, by way of the sets that have its
    tokens or by what is left, whichever is less.
    """
    size = np.array([len(s) for s in sets])
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    parts = np.split(flat.astype(np.int32), np.cumsum(size)[:-1])
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), size)[np.argsort(flat, kind="stable")]
    spread = np.bincount(flat, minlength=len(values))
    start = np.concatenate([[0], np.cumsum(spread)])
    marked, edges, rest = np.zeros(len(values), bool), [], np.arange(len(sets))
    while len(rest):
        root, todo, rest = rest[0], [rest[0]], rest[1:]
        held = None
        while todo and len(rest):
            one = todo.pop()
            mine = parts[one]
            if spread[mine].sum() <= size[rest].sum():
                common = np.bincount(np.concatenate([owner[start[t] : start[t + 1]] for t in mine]), minlength=len(sets))[rest]
            else:
                if held is None:
                    held = np.concatenate([parts[i] for i in rest])
                    starts = np.concatenate([[0], np.cumsum(size[rest])[:-1]])
                marked[mine] = True
                common = np.add.reduceat(marked[held], starts, dtype=np.int64)
                marked[mine] = False
            near = 100 * common >= percent * (size[rest] + size[one] - common)
            if near.any():
                edges += [(ids[root], ids[m]) for m in rest[near]]
                todo += list(rest[near])
                rest, held = rest[~near], None
    return edges


def _verified(percent: int, short: bool):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (label, i, j, id, tokens) in order; a group may go on in the next batch."""
        group, sets = None, {}

        def out() -> pa.RecordBatch:
            found = exact_links(list(sets), list(sets.values()), percent) if len(sets) > 1 else []
            pairs = np.array(found, np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for batch in batches:
            heads = zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True)
            for (label, i, j, which), tokens in zip(heads, batch.column(4), strict=True):
                if (label, i, j) != group:
                    if sets:
                        yield out()
                    group, sets = (label, i, j), {}
                if which not in sets:  # copies read by several tasks
                    held = np.frombuffer(tokens.as_buffer(), np.uint16 if short else np.uint64)
                    sets[which] = numbered(held) if short else held.copy()
        if sets:
            yield out()

    return verify


def dealt_families(members: DataFrame, family_tokens: int = FAMILY_TOKENS) -> DataFrame:
    """`members` (label, id, n, ...) with `i` and `j`: the two blocks of the family whose sets a row meets.

    A family of more than `family_tokens` tokens is dealt to blocks by a hash, and each two blocks
    meet once; no group holds more than about twice as many tokens.
    """
    sizes = members.groupBy("label").agg(F.ceil(F.sum("n") / F.lit(family_tokens)).cast("int").alias("_blocks"))
    block, blocks = F.col("_block"), F.col("_blocks")
    others = F.filter(F.sequence(F.lit(0), blocks - 1), lambda x: (x != block) | (blocks == 1))
    return (
        members.join(sizes, "label")
        .withColumn("_block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
        .withColumn("_other", F.explode(others))
        .select(*members.columns, F.least("_block", "_other").alias("i"), F.greatest("_block", "_other").alias("j"))
    )


def verified_links(dealt: DataFrame, percent: int, short: bool = False) -> DataFrame:
    """(a, b): links by id that have the components of all links within each group (label, i, j)."""
    rows = dealt.select("label", "i", "j", "id", "tokens").repartition("label", "i", "j")
    return rows.sortWithinPartitions("label", "i", "j").mapInArrow(_verified(percent, short), "a long, b long")


def linked(texts: DataFrame, members: DataFrame, width: int, percent: int, short: bool) -> DataFrame:
    """(id, label): components of the links among the members of each family.

    With `short` tokens are compared by two bytes. Sets have at least as many of these in common as
    of the tokens, so what that links holds all links, and families shrink before whole tokens move.
    """
    tokens = texts.mapInArrow(_fetched(_marked(members), width, short), "name binary, tokens binary")
    dealt = stored(dealt_families(members)).join(tokens, "name")
    return components(verified_links(dealt, percent, short)).withColumnRenamed("node", "id")


def cluster(
    documents: DataFrame, row_id: str = "doc_id", text: str = "text", width: int = 4, percent: int = 85
) -> DataFrame:
    """(`row_id`, n_shingles, component_id) for every row of `documents`.

    A text's set holds its distinct `width`-word shingles, ASCII letters in lower case; with fewer
    words, all of them as one; null texts and those without a word have an empty set, which is
    linked with nothing. Two rows link where 100 x intersection >= `percent` x union (50 to 100),
    and component_id is the smallest id that links reach, the row's own included. Shingles are
    compared as 64-bit hashes. Rows without an id are kept, link, and are never a component_id.
    Repeated rows and copies are one set in the search. An empty table gives an empty one; other
    columns are not looked at.

    Tasks hold the counters (32 MB), the candidates' bits (8 MB) or the tokens of two blocks.
    Families larger than a block cost the square of their number of blocks.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent is 50 to 100")
    body = documents.select(F.col(row_id).cast("long").alias("id"), F.col(text).cast("string").cast("binary").alias("text"))
    read = stored(body.mapInArrow(_read(width), "id long, n long, name binary, at int, counts binary"))
    rows = read.where("at IS NULL").select("id", "n", "name")
    levels = token_levels(read.where("at IS NOT NULL"))
    sets = rows.where("n > 0").groupBy("name").agg(F.min("id").alias("first"), F.first("n").alias("n"))
    unique = stored(sets.withColumn("id", F.monotonically_increasing_id()))
    index = body.select("text").mapInArrow(_indexed(levels, width, percent), "key long, n int, set long, share int")
    families = stored(components(candidates(stored(index), percent)).withColumnRenamed("node", "set"))
    half = F.conv(F.hex(F.substr("name", F.lit(1), F.lit(8))), 16, -10).cast("long")
    sets = unique.withColumn("set", half)
    members = stored(sets.join(families, "set").select("name", "set", "label", "id", "n"))
    texts = body.select("text")
    likely = linked(texts, members, width, percent, short=True)
    members = stored(sets.join(likely, "id").select("name", "set", "label", "id", "n"))
    found = linked(texts, members, width, percent, short=False)
    labelled = unique.join(found, "id", "left").select("name", "first", F.coalesce("label", "id").alias("label"))
    smallest = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    of_set = stored(labelled.join(smallest, "label").select("name", "component_id"))
    with_words = rows.where("n > 0").join(of_set, "name").select("id", "n", "component_id")
    alone = rows.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return with_words.unionByName(alone).select(F.col("id").alias(row_id), F.col("n").alias("n_shingles"), "component_id")
