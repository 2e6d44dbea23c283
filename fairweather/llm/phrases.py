"""Phrase collocations by vertical partitioning of word suffixes.

Every word starts a suffix: itself and the words after it in its piece, cut at
the longest phrase. The suffixes are partitioned vertically, by prefix: a prefix
(at first a word) that starts more suffixes than the memory budget of one tree
is extended by a word, until its extensions fit or are phrases of full length,
whose counts are then known. Prefixes in order are grouped up to the budget, the
suffixes of a group meet in one task, and its subtree is built there without
looking at any other: the sorted suffixes, cut at the longest phrase. A node is
a run of suffixes with the same first words, and its count is the total of its
leaves.

A phrase that is frequent enough has no word that is not, so suffixes end before
a rare word. Counts of words come from a first pass; a bitmap of the frequent
ones, at most 16 MB, travels with the last. What the bitmap lets through by
mistake costs space and is dropped by its count.
"""

import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairweather.session import Scratch

# Text that a task works on together, and suffixes of one subtree.
CHUNK_BYTES = 12 << 20
TREE_SUFFIXES = 3_000_000
# Bits of the bitmap for each frequent word, and at most.
BITS_PER_WORD, MOST_BITS = 16, 1 << 27
_BUCKET_BITS = 32_768
# First rankings of a language are of so many parts of its phrases.
_RANK_PARTS = 32

# Bytes: 0 in a word, 1 between words, 2 between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

COUNTS = "lang string, phrase binary, f bigint"


def _key(lang: str, words: list[bytes]) -> bytes:
    """Orders prefixes; no word holds a tab or a space."""
    return lang.encode("utf-8", "surrogatepass") + b"\t" + b" ".join(words)


def _segments(text: bytes, longest: int, size: int) -> Iterator[tuple[bytes, int]]:
    """A text in segments, with the offset before which the suffixes of a segment start.

    A segment ends between words and goes on for as many words as a suffix may
    need; the next one starts with these.
    """
    at = 0
    while len(text) - at > size:
        reach = size
        while True:
            kind = _KIND[np.frombuffer(text, np.uint8, min(reach, len(text) - at), at)]
            edges = np.flatnonzero(np.diff(kind == 0, prepend=False))
            starts, ends = edges[::2], edges[1::2]
            if len(ends) > longest or at + reach >= len(text):
                break
            reach *= 2
        if at + reach >= len(text):
            break
        end, own = int(ends[-1]), int(starts[len(ends) - longest + 1])
        yield text[at : at + end], own
        at += own
    yield text[at:], len(text)


class Chunk:
    """The words of some texts: ``ids`` of distinct words of a language, and which follow each other."""

    def __init__(self, parts: list[tuple[str, bytes, int]], longest: int):
        langs = {lang: n for n, lang in enumerate(sorted({p[0] for p in parts}))}
        self.langs = list(langs)
        sizes = np.array([len(p[1]) + 1 for p in parts], np.int64)
        first = np.cumsum(sizes) - sizes
        own_end = first + np.array([min(p[2], len(p[1])) for p in parts], np.int64)
        raw = np.frombuffer(b"\n".join([p[1] for p in parts]) + b"\n", np.uint8)
        kind = _KIND[raw]
        inside = kind == 0
        edges = np.flatnonzero(np.diff(inside, prepend=False))
        starts, ends = edges[::2], edges[1::2]
        offsets = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=offsets[1:])
        letters = _LOWER[raw[inside]]
        found = pa.Array.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
        ).dictionary_encode()
        self.piece = np.searchsorted(np.flatnonzero(kind == 2), starts).astype(np.int32)
        part = np.searchsorted(first, starts, "right") - 1
        self.own = starts < own_end[part]
        lang = np.array([langs[p[0]] for p in parts], np.int64)[part]
        size = max(1, len(found.dictionary))
        distinct, ids = np.unique(lang * size + found.indices.to_numpy(), return_inverse=True)
        self.ids = ids.astype(np.int32)
        self.lang = (distinct // size).astype(np.int32)
        self.words = found.dictionary.take(pa.array(distinct % size))
        self.longest = longest

    def texts(self) -> list[bytes]:
        return self.words.to_pylist()

    def word_counts(self) -> pa.RecordBatch:
        """Own words, and in a row without a word how many there are of each language."""
        counts = np.bincount(self.ids[self.own], minlength=len(self.words))
        totals = np.bincount(self.lang, counts, len(self.langs)).astype(np.int64)
        kept = np.flatnonzero(counts)
        some = np.flatnonzero(totals)
        langs = [self.langs[n] for n in [*self.lang[kept], *some]]
        words = pa.concat_arrays([self.words.take(pa.array(kept)), pa.nulls(len(some), pa.binary())])
        return _count_rows(langs, words, np.concatenate([counts[kept], totals[some]]))

    def suffixes(self, frequent: np.ndarray, least: int, depth: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Distinct suffixes of ``least`` to ``depth`` frequent words, sorted, and how many there are.

        Columns are words, -1 after the end.
        """
        good = frequent[self.ids]
        columns, going = [np.where(good, self.ids, -1)], good
        for k in range(1, depth):
            here = np.zeros(len(good), bool)
            here[:-k] = going[:-k] & good[k:] & (self.piece[:-k] == self.piece[k:])
            column = np.full(len(good), -1, np.int32)
            column[:-k] = np.where(here[:-k], self.ids[k:], -1)
            columns.append(column)
            going = here
        kept = self.own & (columns[least - 1] >= 0)
        return _distinct([c[kept] for c in columns], np.ones(int(kept.sum()), np.int64))


def _count_rows(langs: list[str], phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(langs, pa.string()), phrases, pa.array(counts, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "f"])


def _distinct(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows of small numbers sorted and made distinct, with the totals of their counts."""
    packed = []
    for n in range(0, len(columns), 2):
        pair = (columns[n].astype(np.int64) + 1) << 32
        packed.append(pair | (columns[n + 1] + 1) if n + 1 < len(columns) else pair)
    order = np.lexsort(packed[::-1])
    changes = np.ones(len(order), bool)
    if len(order):
        changes[1:] = False
        for key in packed:
            key = key[order]
            changes[1:] |= key[1:] != key[:-1]
    starts = np.flatnonzero(changes)
    totals = np.add.reduceat(counts[order], starts) if len(starts) else counts[:0]
    return [c[order[starts]] for c in columns], totals


def _runs(columns: list[np.ndarray]) -> np.ndarray:
    """Where runs of equal rows start."""
    changes = np.ones(len(columns[0]), bool)
    if len(changes):
        changes[1:] = False
        for column in columns:
            changes[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(changes)


def _spans(columns: list[np.ndarray]) -> list[tuple[int, int]]:
    """Runs of equal rows, from and to."""
    starts = _runs(columns).tolist()
    return list(zip(starts, [*starts[1:], len(columns[0])], strict=False))


def _map_chunks(documents: DataFrame, schema: str, each, longest: int, chunk_bytes: int) -> DataFrame:
    """``each`` applied to the chunks of ``documents (lang, text)``, where text is binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lang, text in zip(langs, batch.column(1), strict=True):
                for part, own in _segments(text.as_py(), longest, chunk_bytes):
                    parts.append((lang, part, own))
                    size += len(part)
                    if size >= chunk_bytes:
                        yield from each(Chunk(parts, longest))
                        parts, size = [], 0
        if parts:
            yield from each(Chunk(parts, longest))

    return documents.mapInArrow(run, schema)


class Filter:
    """A bitmap of frequent words by checksum: never wrong about a word that is in it."""

    def __init__(self, words: DataFrame):
        n = words.count()
        self.bits = min(MOST_BITS, max(_BUCKET_BITS, 1 << (n * BITS_PER_WORD).bit_length()))
        place = F.crc32(F.concat(F.col("lang").cast("binary"), F.lit("\t").cast("binary"), F.col("phrase")))
        place = F.pmod(place, F.lit(self.bits))
        buckets = words.groupBy(F.floor(place / _BUCKET_BITS).alias("bucket")).agg(
            F.bitmap_construct_agg(F.pmod(place, F.lit(_BUCKET_BITS))).alias("bitmap")
        )
        self.bitmap = np.zeros(self.bits // 8, np.uint8)
        for row in buckets.collect():  # at most MOST_BITS / 32768 rows of 4 kB
            at = row["bucket"] * _BUCKET_BITS // 8
            self.bitmap[at : at + len(row["bitmap"])] = np.frombuffer(row["bitmap"], np.uint8)

    def __call__(self, chunk: Chunk) -> np.ndarray:
        seeds = [zlib.crc32(lang.encode("utf-8", "surrogatepass") + b"\t") for lang in chunk.langs]
        marks = (zlib.crc32(w, seeds[n]) for w, n in zip(chunk.texts(), chunk.lang.tolist(), strict=True))
        place = np.fromiter(marks, np.int64, len(chunk.words)) % self.bits
        return self.bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1 > 0


def _summed(counts: DataFrame, least: int) -> DataFrame:
    """Totals of ``least`` or more; the rows without a phrase stay."""
    total = counts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return total.where((F.col("f") >= least) | F.col("phrase").isNull())


def _group_starts(prefixes: DataFrame, budget: int) -> list[bytes]:
    """The first prefix of every group, in order.

    Prefixes are taken in order until their suffixes reach the budget. There are
    about as many groups as budgets in the corpus, and at most one more for each
    partition of the prefixes.
    """

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = budget
        for batch in batches:
            found = []
            for key, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if filled + f > budget:
                    found.append(key)
                    filled = 0
                filled += f
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["key"])

    key = F.concat(F.col("lang").cast("binary"), F.lit("\t").cast("binary"), F.col("phrase")).alias("key")
    ordered = prefixes.select(key, "f").repartitionByRange("key").sortWithinPartitions("key")
    return sorted(row[0] for row in ordered.mapInArrow(group, "key binary").collect())


BLOBS = "tree int, lang string, depth int, words binary, suffixes binary"


def _pack(columns: list[np.ndarray], counts: np.ndarray, words: pa.Array) -> tuple[bytes, bytes]:
    """Sorted suffixes of one chunk and tree, and the words in them."""
    used = np.unique(np.concatenate(columns))
    used = used[used >= 0]
    kind = np.uint16 if len(used) < 1 << 16 else np.uint32
    packed = [np.where(c >= 0, np.searchsorted(used, c) + 1, 0).astype(kind).tobytes() for c in columns]
    head = struct.pack("<QB", len(counts), np.dtype(kind).itemsize)
    body = b"".join([*packed, counts.astype("<u4").tobytes()])
    text = b" ".join(words.take(pa.array(used)).to_pylist())
    size = struct.pack("<Q", len(text))
    return (
        size + pa.compress(text, "zstd", asbytes=True),
        head + pa.compress(body, "zstd", asbytes=True),
    )


def _unpack(suffixes: bytes, columns: int) -> tuple[list[np.ndarray], np.ndarray]:
    rows, width = struct.unpack_from("<QB", suffixes)
    size = rows * (columns * width + 4)
    body = pa.decompress(suffixes[9:], size, "zstd", asbytes=True)
    kind = np.uint16 if width == 2 else np.uint32
    found = [np.frombuffer(body, kind, rows, n * rows * width).astype(np.int64) - 1 for n in range(columns)]
    return found, np.frombuffer(body, "<u4", rows, columns * rows * width).astype(np.int64)


def _words_of(texts: list[bytes]) -> pa.Array:
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    ends = np.flatnonzero(raw == 32)
    offsets = np.zeros(len(ends) + 1, np.int32)
    offsets[1:] = ends - np.arange(len(ends))
    letters = raw[raw != 32]
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])


def subtree(blobs: list[tuple[str, int, bytes, bytes]], longest: int, least: int) -> pa.Table:
    """Nodes of two words or more with a count of ``least`` or more: ``(lang, phrase, f)``.

    ``blobs`` are the suffixes of one group of prefixes, as many as its budget,
    with the depth of their prefix. Nodes above a prefix are not complete here.
    """
    langs = {lang: n for n, lang in enumerate(sorted({b[0] for b in blobs}))}
    texts = [pa.decompress(b[2][8:], struct.unpack_from("<Q", b[2])[0], "zstd", asbytes=True) for b in blobs]
    found = _words_of(texts).dictionary_encode()
    words, code = found.dictionary, found.indices.to_numpy()
    before = np.cumsum([0, *[t.count(b" ") + 1 for t in texts]])
    parts = [_unpack(b[3], longest) for b in blobs]
    columns = []
    for n in range(longest):
        given = [np.where(p[0][n] >= 0, code[p[0][n] + first], -1) for p, first in zip(parts, before, strict=False)]
        columns.append(np.concatenate(given).astype(np.int32))
    counts = np.concatenate([p[1] for p in parts])
    lang, root = (
        np.repeat(np.array(values, np.int32), [len(p[1]) for p in parts])
        for values in ([langs[b[0]] for b in blobs], [b[1] for b in blobs])
    )
    (lang, *columns, root), counts = _distinct([lang, *columns, root], counts)
    names, nodes = list(langs), []
    for depth in range(2, longest + 1):
        deep = np.flatnonzero((columns[depth - 1] >= 0) & (root <= depth))
        here = [c[deep] for c in (lang, *columns[:depth])]
        starts = _runs(here)
        totals = np.add.reduceat(counts[deep], starts) if len(starts) else counts[:0]
        frequent = totals >= least
        starts = starts[frequent]
        texts = zip(*[words.take(pa.array(c[starts])).to_pylist() for c in here[1:]], strict=True)
        own = [names[n] for n in here[0][starts]]
        nodes.append(_count_rows(own, pa.array(list(map(b" ".join, texts)), pa.binary()), totals[frequent]))
    return pa.Table.from_batches(nodes)


def phrase_counts(
    documents: DataFrame,
    scratch: Scratch,
    *,
    longest: int = 4,
    least: int = 30,
    text: str = "text",
    lang: str = "lang",
    tree_suffixes: int = TREE_SUFFIXES,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``(lang, phrase, words, f)`` of every phrase of 1 to ``longest`` words with ``f >= least``.

    A row with a null phrase and 0 words tells how many words the language has.
    A null language is ``und``; a null text is empty. Prefixes above the budget
    are told to all tasks: at each depth there are at most as many as budgets in
    the corpus. The result is a written table.
    """
    if longest < 2:
        raise ValueError("phrases have two words or more")
    texts = documents.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )

    def words(chunk: Chunk) -> Iterator[pa.RecordBatch]:
        yield chunk.word_counts()

    level = scratch.materialize(_summed(_map_chunks(texts, COUNTS, words, longest, chunk_bytes), least), "prefixes-1")
    levels = [level]
    frequent = Filter(level.where("phrase IS NOT NULL"))
    heavy: set[bytes] = set()
    while True:
        rows = level.where(F.col("phrase").isNotNull() & (F.col("f") > tree_suffixes)).select("lang", "phrase").collect()
        new = {_key(row[0], [bytes(row[1])]) for row in rows}
        heavy |= new
        if not new or len(levels) == longest:
            break
        depth = len(levels) + 1

        def extend(chunk: Chunk, depth=depth, new=new) -> Iterator[pa.RecordBatch]:
            columns, counts = chunk.suffixes(frequent(chunk), depth, depth)
            names = chunk.texts()
            kept = [
                slice(a, b)
                for a, b in _spans(columns[:-1])
                if _key(chunk.langs[chunk.lang[columns[0][a]]], [names[c[a]] for c in columns[:-1]]) in new
            ]
            rows = np.concatenate([np.arange(len(counts))[s] for s in kept]) if kept else np.zeros(0, int)
            phrases = [b" ".join([names[c[row]] for c in columns]) for row in rows]
            langs = [chunk.langs[n] for n in chunk.lang[columns[0][rows]]]
            yield _count_rows(langs, pa.array(phrases, pa.binary()), counts[rows])

        extended = _summed(_map_chunks(texts, COUNTS, extend, longest, chunk_bytes), least)
        level = scratch.materialize(extended, f"prefixes-{depth}")
        levels.append(level)

    prefixes = levels[0].where("phrase IS NOT NULL")
    for extended in levels[1:]:
        prefixes = prefixes.unionByName(extended)
    groups = _group_starts(prefixes.where(F.col("f") <= tree_suffixes), tree_suffixes)

    def deal(chunk: Chunk) -> Iterator[pa.RecordBatch]:
        """Suffixes to the trees of their shortest prefix within the budget."""
        columns, counts = chunk.suffixes(frequent(chunk), 2, longest)
        names = chunk.texts()
        tree, root = np.full(len(counts), -1, np.int64), np.zeros(len(counts), np.int64)
        rows = np.arange(len(counts))
        for depth in range(1, longest + 1):
            rows = rows[columns[depth - 1][rows] >= 0]
            goes_on = np.zeros(len(rows), bool)
            root[rows] = depth
            for a, b in _spans([c[rows] for c in columns[:depth]]):
                first = rows[a]
                own = chunk.langs[chunk.lang[columns[0][first]]]
                key = _key(own, [names[c[first]] for c in columns[:depth]])
                if key in heavy:
                    goes_on[a:b] = True
                else:
                    tree[rows[a:b]] = bisect_right(groups, key) - 1
            rows = rows[goes_on]
        dealt = np.flatnonzero(tree >= 0)
        dealt = dealt[np.lexsort([root[dealt], tree[dealt]])]
        lang_of = chunk.lang[columns[0][dealt]]
        found: list[list] = [[], [], [], [], []]
        for a, b in _spans([tree[dealt], root[dealt], lang_of]):
            part = dealt[a:b]
            packed = _pack([c[part] for c in columns], counts[part], chunk.words)
            row = [int(tree[part[0]]), chunk.langs[lang_of[a]], int(root[part[0]]), *packed]
            for values, value in zip(found, row, strict=True):
                values.append(value)
        kinds = [pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary()]
        arrays = [pa.array(v, k) for v, k in zip(found, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["tree", "lang", "depth", "words", "suffixes"])

    def build(group: pa.Table) -> pa.Table:
        blobs = zip(*[group.column(c).to_pylist() for c in ("lang", "depth", "words", "suffixes")], strict=True)
        return subtree(list(blobs), longest, least)

    trees = _map_chunks(texts, BLOBS, deal, longest, chunk_bytes).groupBy("tree").applyInArrow(build, COUNTS)
    # prefixes beyond the budget are above the trees
    known = levels[0]
    for extended in levels[1:]:
        known = known.unionByName(extended.where(F.col("f") > tree_suffixes))
    phrase = F.col("phrase").cast("string")
    words_in = F.when(phrase.isNull(), 0).otherwise(F.length(phrase) - F.length(F.replace(phrase, F.lit(" "))) + 1)
    nodes = scratch.materialize(
        known.unionByName(trees).select("lang", phrase.alias("phrase"), words_in.alias("words"), "f"), "phrases"
    )
    scratch.remove(*levels)
    return nodes


def _exact(name: str):
    return F.col(name).cast("decimal(20,0)")


def collocations(
    documents: DataFrame, scratch: Scratch, *, top: int = 2000, contained_percent: int = 80, longest: int = 4, **options
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` best phrases of every language.

    Phrases of 2 to ``longest`` words are scored by the cut in two parts that
    scores least, ``floor(2000000 * a / (l + r))``, the first of equal cuts. A
    phrase inside a longer one that has ``contained_percent`` of its count or
    more is dropped. Higher scores come first, then higher counts, then phrases
    in byte order. Other columns of ``documents`` are not looked at, and rows
    that repeat count each; without words the result is empty. See
    :func:`phrase_counts` for nulls and further options.
    """
    counts = phrase_counts(documents, scratch, longest=longest, **options)
    totals = counts.where("phrase IS NULL").select("lang", F.col("f").alias("n"))
    counts = counts.where("phrase IS NOT NULL")
    candidates = counts.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))

    def words_from(start, length):
        return F.array_join(F.slice(F.split("phrase", " "), start, length), " ")

    cut = F.col("cut")
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut")).select(
        "lang",
        "phrase",
        "a",
        "cut",
        words_from(F.lit(1), cut).alias("first"),
        words_from(cut + 1, F.col("words") - cut).alias("rest"),
    )
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    parted = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    score = F.expr(
        "(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(20,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"
    )
    scored = parted.groupBy("lang", "phrase").agg(
        F.max("a").alias("a"), F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("least")
    )

    inside = F.explode(
        F.array_distinct(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(2), F.col("words") - 1),
                    lambda length: F.transform(
                        F.sequence(F.lit(1), F.col("words") - length + 1), lambda start: words_from(start, length)
                    ),
                )
            )
        )
    )
    longer = (
        candidates.where("words > 2")
        .select("lang", inside.alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    contained = F.lit(100) * _exact("longer") >= F.lit(contained_percent) * _exact("a")
    kept = (
        scored.join(longer, ["lang", "phrase"], "left")
        .where(~F.coalesce(contained, F.lit(False)))
        .select("lang", "phrase", "a", "least.l", "least.r", "least.score")
    )
    best = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(_RANK_PARTS))
    first = kept.withColumn("part", part).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))
    )
    ranked = first.where(F.col("rank") <= top).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint")
    )
    return (
        ranked.where(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score"))
    )
