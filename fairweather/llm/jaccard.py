"""Exact set-similarity join of texts as sets of word shingles, by relations between sets.

Copies are one set. Sets that are very similar get a common leader, verified,
and their answers are derived from the leader's: with ``o`` shingles common to
two leaders and ``d`` shingles of a set that its leader lacks, two sets have at
most ``o + d1 + d2`` in common. Only leaders are compared; members are, one by
one, where that bound leaves the answer open, and where they have a rare shingle
in common or their frequent ones suffice.

Leaders that must be compared come from index lists. A set enters the lists of
its first shingles in a common order, so many that two sets above the threshold
share a list. Shingles of many sets come last in that order. The entries of a
list are ordered by size and cut into blocks; a pair of blocks is skipped if
its sizes, or the positions of the shingle, cannot reach the threshold.

The result is exact: the order, the leaders and the blocks decide only what has
to be compared.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from fairweather.llm.components import connected_components
from fairweather.llm.tokens import batch_slices
from fairweather.session import Scratch

# How many hashes of a set are tried to find it a leader.
LEADER_ROUNDS = 3
# Shingles of more sets than this come last, the most frequent of them first to be
# noted: the table travels with the tasks and is at most 16 MB.
FREQUENT, FREQUENT_SHINGLES = 4, 1 << 21
# Sets that share a leader are dealt over so many tasks, and those that share a hash in
# search of one; entries per block of a list.
SALTS, MEET_SALTS, BLOCK = 256, 32, 64
# Bytes of a set's signature; bits of the table of shingles that sets share; shingles a
# task counts at a time.
SIGNATURE, FILTER_BITS, _COUNTED = 12, 1 << 27, 4_000_000
# Lists up to this length are handled together; longer ones than this are cut in chunks,
# whose pairs are compared in tasks of their own.
_SHORT, LONG_LIST = 16, 8192


@dataclass(frozen=True)
class Threshold:
    """Sets link when ``100 * common >= percent * union``."""

    percent: int = 85
    words: int = 4

    def needed(self, n: int, m: int) -> int:
        """Common shingles that sets of these sizes need."""
        return -(-self.percent * (n + m) // (100 + self.percent))

    def least_size(self, n: int) -> int:
        return -(-self.percent * n // 100)

    def prefix(self, n: int) -> int:
        """Shingles of a set that are indexed: one of them is common to every partner."""
        return n - self.needed(n, self.least_size(n)) + 1

    def linked(self, common: Column, n: Column, m: Column) -> Column:
        return 100 * common >= self.percent * (n + m - common)

    def reachable(self, most: Column, n: Column, m: Column) -> Column:
        return (100 + self.percent) * most >= self.percent * (n + m)


_IS_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_SEGMENT = 1 << 20


class Shingles:
    """Texts to sorted arrays of distinct 64-bit shingle hashes, without a loop over words.

    A word's hash is the sum of random numbers of its bytes times powers of an
    odd base, modulo 2**64: differences of running sums, moved to power zero.
    """

    def __init__(self, words: int):
        draw = np.random.default_rng(words)
        self.words = words
        self.of_byte = draw.integers(0, 1 << 64, 256, np.uint64)
        base = int(draw.integers(0, 1 << 63)) * 2 + 1
        self.bases = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
        self.factors = draw.integers(0, 1 << 63, words, np.uint64) * np.uint64(2) + np.uint64(1)

    def _word_hashes(self, raw: np.ndarray) -> np.ndarray:
        if len(raw) >= len(self.powers[0]):
            self.powers = [np.cumprod(np.full(2 * len(raw), b)) for b in self.bases]
        up, down = self.powers
        is_word = ~_IS_SPACE[raw]
        edges = np.flatnonzero(is_word[1:] != is_word[:-1]) + 1
        edges = np.concatenate([[0][: int(is_word[0])], edges, [len(raw)][: int(is_word[-1])]]).astype(np.int64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.of_byte[raw] * up[: len(raw)])])
        starts, ends = edges[::2], edges[1::2]
        return (sums[ends] - sums[starts]) * down[starts]

    def _hashes(self, raw: bytes) -> np.ndarray:
        found, start = [], 0
        while start < len(raw):
            stop = start + _SEGMENT
            while stop < len(raw) and not _IS_SPACE[raw[stop]]:
                stop += 1
            found.append(self._word_hashes(np.frombuffer(raw[start:stop], np.uint8)))
            start = stop
        return np.concatenate(found) if found else np.zeros(0, np.uint64)

    def __call__(self, text: str | None) -> np.ndarray:
        codes = self._hashes((text or "").encode("utf-8", "surrogatepass").lower())
        if not len(codes):
            return np.zeros(0, np.int64)
        width = min(self.words, len(codes))
        total = np.full(len(codes) - width + 1, width, np.uint64)
        for k in range(width):
            total += codes[k : len(codes) - width + 1 + k] * self.factors[k]
        total ^= total >> np.uint64(31)
        total *= np.uint64(0xBF58476D1CE4E5B9)
        total ^= total >> np.uint64(29)
        # sorting and comparing takes a seventh of the time of np.unique
        found = np.sort(total.view(np.int64))
        return found[np.concatenate([[True], found[1:] != found[:-1]])]


def _common(one: np.ndarray, other: np.ndarray) -> int:
    both = np.concatenate([one, other])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def _described(documents: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """Per document: size of its set, the set's signature, and the least of some hashes."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        shingles = Shingles(words)
        seeds = np.array([pow(0xD1342543DE82EF95, k + 1, 1 << 64) for k in range(LEADER_ROUNDS)], np.uint64)
        for batch in batch_slices(batches, 1):
            sizes, signatures, least = [], [], []
            for value in batch.column(1).to_pylist():
                found = shingles(value)
                sizes.append(len(found))
                signatures.append(xxh3_128_digest(found.tobytes())[:SIGNATURE] if len(found) else None)
                plain = found.view(np.uint64)
                least.append([int(((plain * s) >> np.uint64(1)).min()) for s in seeds] if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(signatures, pa.binary()),
                    pa.array(least, pa.list_(pa.int64())),
                ],
                ["doc", "n", "sig", "least"],
            )

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, text).mapInArrow(describe, f"doc {kind}, n bigint, sig binary, least array<bigint>")


def _packed_texts(documents: DataFrame, text: str, words: int) -> DataFrame:
    """``(sig, packed)``: a compressed text for every set, at most one from each task."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest
        from zstandard import ZstdCompressor

        shingles, compress, seen = Shingles(words), ZstdCompressor(level=3).compress, set()
        for batch in batch_slices(batches, 0):
            signatures, packed = [], []
            for value in batch.column(0).to_pylist():
                found = shingles(value)
                signature = xxh3_128_digest(found.tobytes())[:SIGNATURE]
                if len(found) and signature not in seen:
                    seen.add(signature)
                    signatures.append(signature)
                    packed.append(compress(value.encode("utf-8", "surrogatepass")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(signatures, pa.binary()), pa.array(packed, pa.binary())], ["sig", "packed"]
            )

    return documents.select(text).mapInArrow(pack, "sig binary, packed binary")


def _overlaps(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """``(a, b, common)`` for distinct ``pairs (a, b)`` of signatures.

    Texts travel to ``a``: one for every pair, and one of ``a`` for every task
    that gets a part of its pairs.
    """
    dealt = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int").alias("salt"))
    heads = dealt.select("a", "salt").distinct().select("a", F.col("a").alias("sig"), "salt", F.lit(0).alias("second"))
    others = dealt.select("a", F.col("b").alias("sig"), "salt", F.lit(1).alias("second"))
    with_texts = texts.join(heads.unionByName(others).hint("shuffle_hash"), "sig").repartition("a", "salt")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdDecompressor

        shingles, unpack = Shingles(words), ZstdDecompressor().decompress
        head, own, last = None, None, None
        for batch in batches:
            found = []
            for a, sig, salt, second, packed in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                if (a, sig, salt, second) == last:
                    continue  # another task's copy of the text
                last = (a, sig, salt, second)
                mine = shingles(unpack(packed).decode("utf-8", "surrogatepass"))
                if second:
                    assert head == (a, salt)
                    found.append((a, sig, _common(own, mine)))
                else:
                    head, own = (a, salt), mine
            columns = list(zip(*found, strict=True)) if found else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.int64())],
                ["a", "b", "common"],
            )

    ordered = with_texts.select("a", "sig", "salt", "second", "packed").sortWithinPartitions("a", "salt", "second", "sig")
    return ordered.mapInArrow(compare, "a binary, b binary, common bigint")


def _with_leaders(sets: DataFrame, texts: DataFrame, threshold: Threshold, scratch: Scratch) -> DataFrame:
    """``sets (sig, n, rare, least)`` with ``leader`` and ``lacking``, the shingles the leader has not.

    In every round sets that lead themselves and share the least of one hash
    meet. One of them, a leader already if there is one, or else the one with the
    fewest rare shingles, is offered to the others that lead nobody; who is above the threshold with it joins it. A
    second equal hash is asked for, because only likely pairs are worth a text.
    """
    members = None
    for turn in range(LEADER_ROUNDS):
        free = sets.withColumn("leads", F.lit(False))
        if members is not None:
            leading = members.select(F.col("leader").alias("sig"), F.lit(True).alias("leads")).distinct()
            free = sets.join(members, "sig", "left_anti").join(leading, "sig", "left").withColumn(
                "leads", F.coalesce("leads", F.lit(False))
            )
        salt = F.pmod(F.xxhash64("sig"), F.lit(MEET_SALTS)).cast("int")
        free = free.withColumns({"meet": F.col("least")[turn], "salt": salt})
        free = scratch.materialize(free, "free-sets")
        # a hash that very many sets share: its sets are dealt over salts, and so is their head
        by_salt = free.groupBy("meet", "salt").agg(
            F.min(F.struct((~F.col("leads")).alias("idle"), "rare", "sig", "n", "least")).alias("head"),
            F.count(F.lit(1)).alias("sets"),
        )
        by_meet = (
            by_salt.groupBy("meet")
            .agg(F.min("head").alias("head"), F.sum("sets").alias("sets"), F.collect_list("salt").alias("salts"))
            .where("sets > 1")
        )
        heads = by_meet.select("meet", "head", F.explode("salts").alias("salt"))
        equal = F.size(F.filter(F.sequence(F.lit(0), F.lit(LEADER_ROUNDS - 1)), lambda k: F.col("least")[k] == F.col("head.least")[k]))
        most = F.least("n", "head.n")
        pairs = free.join(heads, ["meet", "salt"]).where(
            ~F.col("leads")
            & (F.col("sig") != F.col("head.sig"))
            & (equal > 1)
            & threshold.reachable(most, F.col("n"), F.col("head.n"))
        ).select(F.col("head.sig").alias("a"), F.col("sig").alias("b"), "n", F.col("head.n").alias("m"))
        pairs = scratch.materialize(pairs, "leader-pairs")
        joined = (
            _overlaps(pairs, texts, threshold.words)
            .join(pairs, ["a", "b"])
            .where(threshold.linked(F.col("common"), F.col("n"), F.col("m")))
            .select(F.col("b").alias("sig"), F.col("a").alias("leader"), (F.col("n") - F.col("common")).alias("lacking"))
        )
        members = scratch.materialize(joined if members is None else members.unionByName(joined), "members")
    return scratch.materialize(
        sets.select("sig", "n", "rare").join(members, "sig", "left").select(
            "sig",
            "n",
            "rare",
            F.coalesce("leader", "sig").alias("leader"),
            F.coalesce("lacking", F.lit(0)).alias("lacking"),
        ),
        "led-sets",
    )


def _unpacked(batch: pa.RecordBatch, shingles: Shingles) -> Iterator[np.ndarray]:
    """The sets of the texts of a batch."""
    from zstandard import ZstdDecompressor

    unpack = ZstdDecompressor().decompress
    for packed in batch.column("packed").to_pylist():
        yield shingles(unpack(packed).decode("utf-8", "surrogatepass"))


def _frequent(texts: DataFrame, threshold: Threshold) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of many sets, sorted, and how many sets each was seen in.

    Every task counts over all shingles of its sets and reports what it saw more than once.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one array that is filled, sorted in place and filled again
        shingles, found, held = Shingles(threshold.words), np.empty(_COUNTED, np.int64), 0
        for batch in batches:
            for own in _unpacked(batch, shingles):
                while len(own):
                    taken = own[: _COUNTED - held]
                    found[held : held + len(taken)] = taken
                    held, own = held + len(taken), own[len(taken) :]
                    if held == _COUNTED:
                        yield counted(found)
                        held = 0
        yield counted(found[:held])

    def counted(found: np.ndarray) -> pa.RecordBatch:
        found.sort()
        starts = np.flatnonzero(np.concatenate([[True][: len(found)], found[1:] != found[:-1]]))
        counts = np.diff(np.append(starts, len(found)))
        again = counts > 1
        return pa.RecordBatch.from_arrays([pa.array(found[starts[again]]), pa.array(counts[again])], ["shingle", "sets"])

    sums = texts.select("packed").mapInArrow(count, "shingle bigint, sets bigint").groupBy("shingle").agg(
        F.sum("sets").alias("sets")
    )
    often = sums.where(F.col("sets") > FREQUENT).orderBy(F.desc("sets"), "shingle").limit(FREQUENT_SHINGLES)
    found = often.toPandas().sort_values("shingle")
    return found["shingle"].to_numpy(np.int64), found["sets"].to_numpy(np.int64)


def _often(own: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(own), bool)
    return frequent[np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)] == own


def _rare(texts: DataFrame, frequent: np.ndarray, threshold: Threshold) -> DataFrame:
    """``(sig, rare)``: how many shingles of a set are not frequent. An original has fewer than its copies."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(threshold.words)
        for batch in batches:
            rare = [int((~_often(own, frequent)).sum()) for own in _unpacked(batch, shingles)]
            yield pa.RecordBatch.from_arrays([batch.column("sig"), pa.array(rare, pa.int64())], ["sig", "rare"])

    counted = texts.select("sig", "packed").mapInArrow(count, "sig binary, rare bigint")
    return counted.groupBy("sig").agg(F.max("rare").alias("rare"))


def _prefix(own: np.ndarray, frequent: np.ndarray, threshold: Threshold) -> np.ndarray:
    """The shingles a set is listed under, in the common order: frequent ones last, then by hash."""
    often = _often(own, frequent)
    return np.concatenate([own[~often], own[often]])[: threshold.prefix(len(own))]


def _shared(led: DataFrame, frequent: np.ndarray, threshold: Threshold) -> np.ndarray:
    """A bit for every shingle, by its hash: not set if surely one set alone is listed under it.

    A table of fixed size; with more shingles more bits are set, and less is saved.
    """
    bits = FILTER_BITS  # a name of this module would be looked up anew in the tasks

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(threshold.words)
        for batch in batches:
            found = [_prefix(own, frequent, threshold) for own in _unpacked(batch, shingles)]
            if found:
                values, counts = np.unique(np.concatenate(found) & (bits - 1), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, pa.int32()), pa.array(counts, pa.int32())], ["bit", "sets"]
                )

    seen = led.select("packed").mapInArrow(count, "bit int, sets int").groupBy("bit").agg(F.sum("sets").alias("sets"))
    bit = F.col("bit").cast("bigint")
    blocks = (
        seen.where("sets > 1")
        .groupBy(F.bitmap_bucket_number(bit).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
        .toPandas()
    )
    # the first bucket holds zero alone in some orders of numbering, so places are computed
    table = np.zeros((FILTER_BITS // 32768 + 2, 4096), np.uint8)
    for bucket, held in zip(blocks["bucket"], blocks["bits"], strict=True):
        table[int(bucket)] = np.frombuffer(held, np.uint8)
    return table


def _may_be_shared(tokens: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Looks shingles up in the bits, numbered as Spark numbers them: bucket 1 starts with bit 1."""
    bit = tokens & (FILTER_BITS - 1)
    bucket = np.where(bit > 0, 1 + (bit - 1) // 32768, 0)
    place = np.where(bit > 0, (bit - 1) % 32768, 0)
    return (table[bucket, place // 8] >> (place % 8).astype(np.uint8)) & 1 == 1


def _listed(
    led: DataFrame, frequent: np.ndarray, chunks: np.ndarray, shared: np.ndarray, threshold: Threshold
) -> DataFrame:
    """Index entries ``(shingle, one, two, leader, chunk, low, high, rest)``, those of a leader's sets in one.

    ``low`` and ``high`` bound the sizes of the sets, ``rest`` the shingles that
    follow in the order. Shingles of one set alone are left out. ``chunks`` tells
    in how many chunks the list of a frequent shingle is cut, by leader; an entry
    stands in every pair of chunks ``(one, two)`` that its own is in.
    """

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(threshold.words)
        for batch in batches:
            if not batch.num_rows:
                continue
            leaders = batch.column("leader").dictionary_encode()
            tokens, owner, sizes, rests = [], [], [], []
            for code, own in zip(leaders.indices.to_pylist(), _unpacked(batch, shingles), strict=True):
                listed = _prefix(own, frequent, threshold)
                kept = np.flatnonzero(_may_be_shared(listed, shared))
                tokens.append(listed[kept])
                owner.append(np.full(len(kept), code))
                sizes.append(np.full(len(kept), len(own)))
                rests.append(len(own) - 1 - kept)
            tokens, owner, sizes, rests = map(np.concatenate, (tokens, owner, sizes, rests))
            if not len(tokens):
                continue
            order = np.lexsort((owner, tokens))
            tokens, owner, sizes, rests = tokens[order], owner[order], sizes[order], rests[order]
            new = np.flatnonzero(np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])]))
            low, high = np.minimum.reduceat(sizes, new), np.maximum.reduceat(sizes, new)
            tokens, owner, rests = tokens[new], owner[new], np.maximum.reduceat(rests, new)
            one = two = chunk = np.zeros(len(tokens), np.int32)
            if len(long):
                place = np.minimum(np.searchsorted(long, tokens), len(long) - 1)
                copies = np.where(long[place] == tokens, cut[place], 1)
                # the chunk of a leader is that of its signature
                numbers = np.array([int.from_bytes(d[:4], "little") for d in leaders.dictionary.to_pylist()], np.int64)
                row = np.repeat(np.arange(len(tokens)), copies)
                other = np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)
                chunk = (numbers[owner] % copies)[row]
                one, two = np.minimum(chunk, other), np.maximum(chunk, other)
                tokens, owner, low, high, rests = (values[row] for values in (tokens, owner, low, high, rests))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(tokens),
                    leaders.dictionary.take(pa.array(owner)),
                    *[pa.array(values, pa.int32()) for values in (one, two, chunk, low, high, rests)],
                ],
                ["shingle", "leader", "one", "two", "chunk", "low", "high", "rest"],
            )

    long, cut = frequent[chunks > 1], chunks[chunks > 1]
    schema = "shingle bigint, leader binary, one int, two int, chunk int, low int, high int, rest int"
    return led.select("leader", "packed").mapInArrow(enter, schema)


def _rare_listed(sets: DataFrame, frequent: np.ndarray, threshold: Threshold) -> DataFrame:
    """``(shingle, sig, leader, n, lacking)``: the rare shingles that a set is listed under.

    Sets that link and have a rare shingle in common share one of these: the first
    that they have in common in the order is among those either is listed under.
    """

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(threshold.words)
        for batch in batches:
            listed = [_prefix(own, frequent, threshold) for own in _unpacked(batch, shingles)]
            listed = [first[~_often(first, frequent)] for first in listed]
            owner = pa.array(np.repeat(np.arange(len(listed)), [len(first) for first in listed]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.zeros(0, np.int64), *listed])),
                    *[batch.column(c).take(owner) for c in ("sig", "leader", "n", "lacking")],
                ],
                ["shingle", "sig", "leader", "n", "lacking"],
            )

    return sets.select("sig", "leader", "n", "lacking", "packed").mapInArrow(
        enter, "shingle bigint, sig binary, leader binary, n bigint, lacking bigint"
    )


def _may_link(l1, h1, r1, l2, h2, r2, percent: int):  # noqa: ANN001
    """Whether entries with these least and most sizes, and shingles to follow, may hold sets that link."""
    sizes = (100 * h1 >= percent * l2) & (100 * h2 >= percent * l1)
    # the first shared shingle is this one: what follows it bounds what is common
    return sizes & ((100 + percent) * (1 + np.minimum(r1, r2)) >= percent * (l1 + l2))


def _block_pairs(
    low: np.ndarray, high: np.ndarray, rest: np.ndarray, percent: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of entries of a list, ordered by ``low``, that may link; whole blocks are skipped."""
    blocks = [slice(s, s + BLOCK) for s in range(0, len(low), BLOCK)]
    bounds = [(low[b].min(), high[b].max(), rest[b].max()) for b in blocks]
    for i, one in enumerate(blocks):
        for j in range(i, len(blocks)):
            if not _may_link(*bounds[i], *bounds[j], percent):
                continue
            other = blocks[j]
            fits = _may_link(
                low[one, None], high[one, None], rest[one, None], low[other], high[other], rest[other], percent
            )
            if i == j:
                fits = np.triu(fits, 1)
            found = np.nonzero(fits)
            if len(found[0]):
                yield found[0] + one.start, found[1] + other.start


def _candidates(entries: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of leaders ``(a, b)``, ``a < b``, from the index lists."""

    def ends_of(table: pa.Table) -> np.ndarray:
        """Where the lists of a table end: lists are of a shingle and a pair of chunks."""
        shingle, one, two = (table.column(c).to_numpy() for c in ("shingle", "one", "two"))
        changes = (shingle[1:] != shingle[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        return np.append(np.flatnonzero(changes) + 1, len(shingle))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            batch = pa.Table.from_batches([batch])
            left = batch if left is None else pa.concat_tables([left, batch])
            if not left.num_rows:
                continue
            # the last list may go on in the next batch
            ends = ends_of(left)
            if len(ends) > 1:
                yield from pairs(left.slice(0, int(ends[-2])))
                left = left.slice(int(ends[-2]))
        if left is not None and left.num_rows:
            yield from pairs(left)

    def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
        leader = table.column("leader").combine_chunks()
        names = ("low", "high", "rest", "chunk", "one", "two")
        low, high, rest, chunk, one_, two_ = (table.column(c).to_numpy().astype(np.int64) for c in names)
        ends = ends_of(table)
        sizes = np.diff(np.append(0, ends))
        starts = ends - sizes
        # two entries of one chunk meet in the pair of that chunk with itself
        alone = one_ == two_
        for size in range(2, _SHORT + 1):
            # lists of one length, all at once
            first = starts[sizes == size]
            for i in range(size - 1):
                for j in range(i + 1, size):
                    one, other = first + i, first + j
                    fits = _may_link(low[one], high[one], rest[one], low[other], high[other], rest[other], percent)
                    fits &= alone[one] | (chunk[one] != chunk[other])
                    if fits.any():
                        yield named(leader, one[fits], other[fits])
        for s, e in zip(starts[sizes > _SHORT].tolist(), ends[sizes > _SHORT].tolist(), strict=True):
            for one, other in _block_pairs(low[s:e], high[s:e], rest[s:e], percent):
                one, other = one + s, other + s
                if not alone[s]:
                    kept = chunk[one] != chunk[other]
                    one, other = one[kept], other[kept]
                yield named(leader, one, other)

    def named(leader: pa.Array, one: np.ndarray, other: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([leader.take(pa.array(one)), leader.take(pa.array(other))], ["a", "b"])

    lists = entries.repartition("shingle", "one", "two").groupBy("shingle", "one", "two", "leader").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.max("rest").alias("rest"), F.max("chunk").alias("chunk")
    )
    ordered = lists.sortWithinPartitions("shingle", "one", "two", "low", "leader")
    found = ordered.mapInArrow(meet, "a binary, b binary").where("a <> b")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _leader_links(
    led: DataFrame,
    texts: DataFrame,
    frequent: np.ndarray,
    chunks: np.ndarray,
    threshold: Threshold,
    scratch: Scratch,
) -> DataFrame:
    """Links ``(a, b)`` between leaders whose sets, or sets that they lead, link."""
    with_texts = texts.join(led.hint("shuffle_hash"), "sig")
    shared = _shared(with_texts, frequent, threshold)
    entries = _listed(with_texts, frequent, chunks, shared, threshold)
    pairs = scratch.materialize(_candidates(entries, threshold.percent), "candidates")

    led_by = led.groupBy("leader").agg(F.min("n").alias("low"), F.max("lacking").alias("lacking"))
    sizes = led.where("sig = leader").select("leader", "n").join(led_by, "leader")

    def side(name: str) -> DataFrame:
        return sizes.select(F.col("leader").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("n", "low", "lacking")])

    compared = scratch.materialize(
        _overlaps(pairs, texts, threshold.words).join(side("a"), "a").join(side("b"), "b"), "compared"
    )
    linked = threshold.linked(F.col("common"), F.col("n_a"), F.col("n_b"))
    most = F.col("common") + F.col("lacking_a") + F.col("lacking_b")
    open_pairs = compared.where(
        ~linked
        & (F.col("lacking_a") + F.col("lacking_b") > 0)
        & threshold.reachable(most, F.col("low_a"), F.col("low_b"))
    ).select("a", "b", "common")

    def sets_of(sets: DataFrame, name: str) -> DataFrame:
        return sets.withColumnsRenamed(
            {"leader": name, "sig": f"set_{name}", "n": f"m_{name}", "lacking": f"d_{name}", "rare": f"r_{name}"}
        )

    # a set with as little as its leader in the other
    derived = F.col("common") + F.col("d_a") + F.col("d_b")
    still_open = (F.col("d_a") + F.col("d_b") > 0) & threshold.reachable(derived, F.col("m_a"), F.col("m_b"))
    columns = ["a", "b", "set_a", "set_b", "m_a", "m_b"]
    # without a common rare shingle, the frequent ones have to do
    frequent_ones = F.least(F.col("m_a") - F.col("r_a"), F.col("m_b") - F.col("r_b"))
    # and so many of them as a link needs: sets with fewer meet nothing here
    frequent_enough = led.where(100 * (F.col("n") - F.col("rare")) >= threshold.percent * F.col("n"))
    of_members = (
        open_pairs.join(sets_of(frequent_enough, "a"), "a")
        .join(sets_of(frequent_enough, "b"), "b")
        .where(still_open & threshold.reachable(frequent_ones, F.col("m_a"), F.col("m_b")))
        .select(*columns)
    )
    open_leaders = open_pairs.select(F.explode(F.array("a", "b")).alias("leader")).distinct()
    open_sets = texts.join(led.join(open_leaders, "leader", "left_semi"), "sig")
    rare_lists = scratch.materialize(_rare_listed(open_sets, frequent, threshold).distinct(), "rare-lists")
    of_rare_lists = (
        sets_of(rare_lists, "a")
        .join(sets_of(rare_lists, "b"), "shingle")
        .where("a < b")
        .join(open_pairs, ["a", "b"])
        .where(still_open)
        .select(*columns)
    )
    of_members = of_members.unionByName(of_rare_lists).distinct()
    of_members = scratch.materialize(of_members, "open-pairs")
    member_pairs = of_members.select(F.col("set_a").alias("a"), F.col("set_b").alias("b")).distinct()
    member_links = (
        _overlaps(member_pairs, texts, threshold.words)
        .withColumnsRenamed({"a": "set_a", "b": "set_b"})
        .join(of_members, ["set_a", "set_b"])
        .where(threshold.linked(F.col("common"), F.col("m_a"), F.col("m_b")))
        .select("a", "b")
    )
    return compared.where(linked).select("a", "b").unionByName(member_links)


def similar_groups(
    documents: DataFrame,
    scratch: Scratch,
    *,
    key: str = "doc_id",
    text: str = "text",
    threshold: Threshold = Threshold(),
) -> DataFrame:
    """``(key, n_shingles, component_id)`` for every document.

    A document's set holds its distinct shingles of ``words`` words (ASCII
    letters lower-cased); fewer words make one shingle, and no words an empty
    set, which links with nothing. The component is the least key reachable by
    links. Rows that repeat a key are judged each; a null key belongs to the
    component of equal sets, if any.
    """
    words = threshold.words
    rows = scratch.materialize(_described(documents, key, text, words), "described")
    sets = scratch.materialize(
        rows.where("n > 0").groupBy("sig").agg(F.max("n").alias("n"), F.min("doc").alias("doc"), F.max("least").alias("least")),
        "sets",
    )
    # dealt by signature once, for all the joins that fetch texts
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = _packed_texts(documents, text, words).repartition(parts, "sig").persist(StorageLevel.DISK_ONLY)
    frequent, holding = _frequent(texts, threshold)
    chunks = -(-holding // LONG_LIST)
    rated = sets.select("sig", "n", "least").join(_rare(texts, frequent, threshold), "sig")
    led = _with_leaders(scratch.materialize(rated, "rated-sets"), texts, threshold, scratch)
    links = scratch.materialize(_leader_links(led, texts, frequent, chunks, threshold, scratch), "leader-links")
    texts.unpersist()

    groups = connected_components(links, scratch).withColumnsRenamed({"node": "leader", "component": "group"})
    grouped = led.join(groups, "leader", "left").select("sig", F.coalesce("group", "leader").alias("group"))
    grouped = scratch.materialize(grouped.join(sets.select("sig", "doc"), "sig"), "grouped")
    least = grouped.groupBy("group").agg(F.min("doc").alias("component"))
    component_of = grouped.join(least, "group").select("sig", "component")
    return rows.join(component_of, "sig", "left").select(
        F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id")
    )
