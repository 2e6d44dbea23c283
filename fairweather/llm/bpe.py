"""Byte-level BPE as recursive queries of DuckDB, run in every partition.

Words are rows of token and position. In every step the pairs of neighbours
are looked up in the merge table, and each word contracts its leftmost pair of
the least rank, until no word has a pair left. A long word contracts all its
pairs of that rank in one step, from the left, up to the first that makes room
for a lower rank: the same merges as one by one. Decoding joins the ids with the
vocabulary and aggregates the bytes in order. Distinct words and chunks are
encoded and decoded once.
"""

import base64
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fairweather.llm.tokens import CACHED_CHARS, segments, slices, split_column

# Text that is cut and looked up together.
SLICE_BYTES = 8 << 20
# Words of more bytes contract many pairs in a step.
LONG_WORD = 48
# Words whose ids a task remembers.
KNOWN_WORDS = 600_000
# Rows (a token of a word, or of a document) in one query.
QUERY_ROWS = 2_000_000
# Rows of a query that contracts short words: what its joins look up stays small.
SHORT_ROWS = 400_000
QUERY_MEMORY = "256MB"

# Rank, place and length of a merge in one number, so that the least is the leftmost of
# the least rank.
_RANK_BIT, _PLACE_BIT = 45, 10
_RANK, _PLACE = 1 << _RANK_BIT, 1 << _PLACE_BIT
_SIDE_BIT = 20
_SIDE = 1 << _SIDE_BIT
_MOST_RANKS = 1 << 18

# Words leave a place free between them, so that a place tells its word.
_CONTRACT = f"""
WITH RECURSIVE step(word, pos, token, size, done) AS (
    SELECT word::INT, pos::INT, token::INT, 1::INT, false FROM start
    UNION ALL
    SELECT * FROM (
        WITH live AS (
            SELECT * FROM step WHERE NOT done
        ), least AS (
            SELECT a.word, min((m.merged << {_RANK_BIT}) | (a.pos::BIGINT << {_PLACE_BIT}) | m.size) AS best
            FROM live a
            JOIN live b ON b.pos = a.pos + a.size
            JOIN merges m ON m.pair = (a.token::BIGINT << {_SIDE_BIT}) | b.token
            GROUP BY a.word
        ), chosen AS MATERIALIZED (
            SELECT word, (best >> {_RANK_BIT})::INT AS merged,
                   ((best & {_RANK - 1}) >> {_PLACE_BIT})::INT AS place, (best & {_PLACE - 1})::INT AS length
            FROM least
        )
        SELECT s.word, pos, CASE WHEN pos = place THEN merged ELSE token END,
               CASE WHEN pos = place THEN length ELSE size END, merged IS NULL
        FROM live s LEFT JOIN chosen c ON c.word = s.word
        WHERE merged IS NULL OR pos <= place OR pos >= place + length
    )
)
SELECT word, token FROM step WHERE done ORDER BY pos
"""

# All disjoint pairs of the least rank of a word, from the left: of those that overlap in a
# row the first, third and so on. A contracted pair whose token makes a pair of a lower
# rank with a neighbour, as the neighbours are at its turn, is the last of its step.
_CONTRACT_LONG = f"""
WITH RECURSIVE step(word, pos, token, size, done) AS (
    SELECT word, pos, token, 1, false FROM start
    UNION ALL
    SELECT * FROM (
        WITH live AS (
            SELECT * FROM step WHERE NOT done
        ), pairs AS (
            SELECT a.word, a.pos, b.pos AS middle, m.merged, m.size
            FROM live a
            JOIN live b ON b.pos = a.pos + a.size
            JOIN merges m ON m.pair = a.token * {_SIDE} + b.token
        ), least AS (
            SELECT word, min(merged) AS merged FROM pairs GROUP BY word
        ), found AS (
            SELECT p.*, coalesce(lag(p.middle) OVER (PARTITION BY p.word ORDER BY p.pos) = p.pos, false) AS linked
            FROM pairs p JOIN least l ON l.word = p.word AND l.merged = p.merged
        ), chained AS (
            SELECT *, sum(CASE WHEN linked THEN 0 ELSE 1 END) OVER (PARTITION BY word ORDER BY pos) AS chain
            FROM found
        ), numbered AS (
            SELECT *, row_number() OVER (PARTITION BY word, chain ORDER BY pos) AS number FROM chained
        ), disjoint AS (
            SELECT * FROM numbered WHERE number % 2 = 1
        ), beside AS (
            SELECT d.word, d.pos, d.merged, coalesce(q.merged, p.token) * {_SIDE} + d.merged AS pair
            FROM disjoint d
            JOIN live p ON p.pos + p.size = d.pos
            LEFT JOIN disjoint q ON q.pos + q.size = d.pos
            UNION ALL
            SELECT d.word, d.pos, d.merged, d.merged * {_SIDE} + n.token
            FROM disjoint d JOIN live n ON n.pos = d.pos + d.size
        ), stop AS (
            SELECT b.word, min(b.pos) AS pos
            FROM beside b JOIN merges m ON m.pair = b.pair
            WHERE m.merged < b.merged GROUP BY b.word
        ), contracted AS (
            SELECT d.* FROM disjoint d LEFT JOIN stop s ON s.word = d.word WHERE s.pos IS NULL OR d.pos <= s.pos
        )
        SELECT s.word, s.pos, coalesce(c.merged, s.token), coalesce(c.size, s.size), l.word IS NULL
        FROM live s
        LEFT JOIN contracted c ON c.pos = s.pos
        LEFT JOIN contracted d ON d.middle = s.pos
        LEFT JOIN least l ON l.word = s.word
        WHERE d.pos IS NULL
    )
)
SELECT word, token FROM step WHERE done ORDER BY pos
"""

_DECODE = "SELECT piece FROM tokens JOIN vocabulary USING (token) ORDER BY pos"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 and a number on every line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def merge_tables(ranks: dict[bytes, int]) -> dict[str, np.ndarray]:
    """What the queries need of a vocabulary, as arrays.

    ``pair, merged, size``: every way to cut a token in two tokens is a merge of
    its rank. ``single``: the tokens of the bytes. ``together``: whether two
    bytes stand next to each other in some token; where they do not, no merge
    ever crosses, and a word can be cut.
    """
    if max(ranks.values()) >= _MOST_RANKS or max(map(len, ranks)) >= _PLACE:
        raise ValueError("the vocabulary is too large for the merge numbers")
    merges = [
        (ranks[token[:k]] * _SIDE + ranks[token[k:]], rank, len(token))
        for token, rank in ranks.items()
        for k in range(1, len(token))
        if token[:k] in ranks and token[k:] in ranks
    ]
    pair, merged, size = np.array(merges, np.int64).reshape(-1, 3).T
    together = np.zeros((256, 256), bool)
    for token in ranks:
        inside = np.frombuffer(token, np.uint8)
        together[inside[:-1], inside[1:]] = True
    single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
    return {"pair": pair, "merged": merged, "size": size, "single": single, "together": together}


def _between(values: pa.LargeBinaryArray, bounds: np.ndarray) -> list[bytes]:
    """What the values between each two bounds are, one after the other."""
    if not len(values):
        return [b""] * (len(bounds) - 1)
    _, offsets, raw = values.buffers()
    places = np.frombuffer(offsets, np.int64)[values.offset :][: len(values) + 1]
    cuts = places[bounds].tolist()
    whole = memoryview(raw or b"")
    return [bytes(whole[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _gather(values: list[bytes], at: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """For each text the values of its chunks, joined."""
    return _between(pa.array(values, pa.large_binary()).take(pa.array(at)), bounds)


class RecursiveBpe:
    """Encodes and decodes with one in-process database; ranks are the ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, tables: dict[str, np.ndarray] | None = None):
        import duckdb
        import regex

        self.ranks, self.cut = ranks, regex.compile(pattern).findall
        tables = tables or merge_tables(ranks)
        self.single, self.together = tables["single"], tables["together"]
        # queries are of bounded size and never spill
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": QUERY_MEMORY, "temp_directory": ""})
        self._table("merges", **{name: tables[name] for name in ("pair", "merged", "size")})
        pieces = pa.array(list(ranks), pa.binary())
        self._table("vocabulary", token=np.fromiter(ranks.values(), np.int32), piece=pieces)
        self.known: dict[str, tuple[bytes, bytes]] = {}

    def _table(self, table: str, **columns) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {table} AS SELECT * FROM given")
        self.db.unregister("given")

    def _contract(self, query: str, raw: np.ndarray, lengths: np.ndarray, rows: int = QUERY_ROWS) -> list[bytes]:
        """Ids of words given as bytes one after the other, little-endian."""
        found: list[bytes] = []
        ends = np.concatenate([[0], np.cumsum(lengths)])
        start = 0
        while start < len(lengths):
            # at least one word, and as many as fit a query
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + rows // 4, "right")) - 1)
            word = np.repeat(np.arange(stop - start), lengths[start:stop])
            part = raw[ends[start] : ends[stop]]
            given = pa.table({"word": word, "pos": np.arange(len(part)) + word, "token": self.single[part]})
            self.db.register("start", given)
            done = self.db.sql(query).fetchnumpy()
            self.db.unregister("start")
            tokens = done["token"].astype("<u4").tobytes()
            cuts = (4 * np.searchsorted(done["word"], np.arange(stop - start + 1))).tolist()
            found += [tokens[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            start = stop
        return found

    def _long_word(self, word: bytes) -> bytes:
        """Ids of a word that is cut where no token can cross."""
        raw = np.frombuffer(word, np.uint8)
        cuts = np.flatnonzero(~self.together[raw[:-1], raw[1:]]) + 1
        lengths = np.diff(np.concatenate([[0], cuts, [len(raw)]]))
        is_long = lengths > LONG_WORD
        of_byte = np.repeat(is_long, lengths)
        answers = {
            kind: iter(self._contract(query, raw[of_byte == kind], lengths[is_long == kind]))
            for kind, query in ((False, _CONTRACT), (True, _CONTRACT_LONG))
        }
        return b"".join([next(answers[kind]) for kind in is_long.tolist()])

    def words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words, little-endian. A word that is a token itself is that token."""
        found: list[bytes] = [np.uint32(self.ranks[w]).tobytes() if w in self.ranks else b"" for w in words]
        short = [n for n, w in enumerate(words) if not found[n] and 0 < len(w) <= LONG_WORD]
        # words of a length take about as many steps
        short.sort(key=lambda n: len(words[n]))
        raw = np.frombuffer(b"".join([words[n] for n in short]), np.uint8)
        lengths = np.array([len(words[n]) for n in short], np.int64)
        for n, ids in zip(short, self._contract(_CONTRACT, raw, lengths, SHORT_ROWS), strict=True):
            found[n] = ids
        for n, w in enumerate(words):
            if not found[n] and len(w) > LONG_WORD:
                found[n] = self._long_word(w)
        return found

    def chunks(self, chunks: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Ids of distinct chunks, every match of the pattern by itself, and the bytes they decode to."""
        cut = list(map(self.cut, chunks))
        matches = dict.fromkeys(itertools.chain.from_iterable(cut))
        new = [m for m in matches if m not in self.known]
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known.clear()
            new = list(matches)
        ids = self.words([m.encode("utf-8", "surrogatepass") for m in new])
        self.known.update(zip(new, zip(ids, self.decode(ids), strict=True), strict=True))
        known = self.known

        def joined(parts: list[str]) -> tuple[bytes, bytes]:
            if len(parts) == 1:
                return known[parts[0]]
            if len(parts) == 2:  # a word and a mark: most of the others
                (a, b), (c, d) = known[parts[0]], known[parts[1]]
                return a + c, b + d
            return b"".join([known[p][0] for p in parts]), b"".join([known[p][1] for p in parts])

        found = list(map(joined, cut))
        for match in [m for m in new if len(m) > CACHED_CHARS]:
            del known[match]
        return [f[0] for f in found], [f[1] for f in found]

    def texts(self, texts: pa.Array) -> Iterator[tuple[bytes, bytes]]:
        """Ids of texts, and their bytes as decoded from the ids."""
        for part in slices(texts, SLICE_BYTES):
            if len(part) == 1 and part.nbytes > 2 * SLICE_BYTES:
                own = [pa.array([text]) for text in segments(part[0].as_py(), SLICE_BYTES // 4)]
                ids, decoded = zip(*[next(self._slice(s)) for s in own], strict=True)
                yield b"".join(ids), b"".join(decoded)
            else:
                yield from self._slice(part)

    def _slice(self, texts: pa.Array) -> Iterator[tuple[bytes, bytes]]:
        distinct, at, bounds = split_column(texts)
        yield from zip(*(_gather(values, at, bounds) for values in self.chunks(distinct)), strict=True)

    def decode(self, documents: list[bytes]) -> Iterator[bytes]:
        """Bytes of documents given as little-endian unsigned 32-bit ids."""
        start = 0
        while start < len(documents):
            stop, rows = start, 0
            while stop < len(documents) and (stop == start or rows + len(documents[stop]) // 4 <= QUERY_ROWS // 4):
                rows += len(documents[stop]) // 4
                stop += 1
            part = documents[start:stop]
            sizes = np.array([len(d) // 4 for d in part])
            self.db.register(
                "tokens",
                pa.table(
                    {
                        "document": np.repeat(np.arange(len(part), dtype=np.int32), sizes),
                        "pos": np.arange(rows, dtype=np.int32),
                        "token": np.frombuffer(b"".join(part), "<u4").astype(np.int32),
                    }
                ),
            )
            found = self.db.sql(_DECODE).to_arrow_table().column("piece")
            self.db.unregister("tokens")
            pieces = pa.concat_arrays([pa.array([], pa.large_binary()), *found.cast(pa.large_binary()).chunks])
            ends = np.concatenate([[0], np.cumsum(sizes)])
            yield from _between(pieces, ends)
            start = stop


DIGESTS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encode_and_decode(
    documents: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text", ids: bool = False
) -> DataFrame:
    """``(key, n_tokens, ids_sha256, decoded_sha256)`` of every text; ``ids`` adds the ids themselves.

    A null text is empty. The hashes are of the ids as little-endian unsigned
    32-bit integers and of the bytes that decoding these ids gives back. Work
    is cut into queries of bounded size, whatever the length of a text; a single
    match of the pattern is one word of one query, cut where no token crosses.
    The vocabulary is read once, where the plan is made, and travels with the
    function: it has at most 2^18 tokens.
    """
    ranks = read_ranks(ranks_path)
    tables = merge_tables(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = RecursiveBpe(ranks, pattern, tables)
        for batch in batches:
            encoded, digests = [], []
            for own, decoded in bpe.texts(batch.column(1)):
                encoded.append(own if ids else len(own))
                digests.append((hashlib.sha256(own).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            sizes = [len(e) // 4 for e in encoded] if ids else [e // 4 for e in encoded]
            columns = [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array([a for a, _ in digests], pa.string()),
                pa.array([b for _, b in digests], pa.string()),
            ]
            if ids:
                columns.append(pa.array([np.frombuffer(e, "<u4").astype(np.int64) for e in encoded], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = [key, "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if ids else [])]
    kind = documents.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {DIGESTS}" + (", ids array<bigint>" if ids else "")
    return documents.select(key, text).mapInArrow(run, schema)
