"""Token ids of whole texts, encoded once per distinct chunk.

A chunk starts at every space that is followed by a character other than white
space. A byte-level pattern always starts a match there, so the ids of a text
are the ids of its chunks one after the other, and few chunks are distinct.
"""

import json
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# What a task remembers: so many chunks, none longer than this.
CACHED_CHUNKS, CACHED_CHARS = 300_000, 64
# Texts of about so many bytes are split together.
SLICE_BYTES = 4 << 20
# Texts of about so many bytes are objects of Python at a time, where all of a batch need not be.
BATCH_BYTES = 1 << 20
_CHUNK_START = re.compile(r" (?=\S)")


def chunks(text: str) -> list[str]:
    """A text cut where a match of a byte-level pattern surely starts; joined, they are the text."""
    found: list[str] = []
    for part in text.split(" "):
        if not found:
            found.append(part)
        elif part and not part[0].isspace():
            found.append(" " + part)
        else:
            found[-1] += " " + part
    return found


class Known(dict):
    """Ids of chunks as little-endian unsigned 32-bit integers, made where they are missing."""

    def __init__(self, encode: Callable[[str], Iterable[int]]):
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        ids = np.asarray(self.encode(chunk), "<u4").tobytes()
        if len(chunk) <= CACHED_CHARS:
            if len(self) >= CACHED_CHUNKS:
                self.clear()
            self[chunk] = ids
        return ids


def encode_by_chunk(known: Known, text: str) -> bytes:
    return b"".join([known[c] for c in chunks(text)])


def split_column(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct chunks of texts, the chunks of all of them by number, and where each text starts.

    Texts are split at spaces together; only those with a space before white
    space are looked at one by one.
    """
    split = pc.split_pattern(texts, " ")
    bounds = split.offsets.to_numpy().astype(np.int64)
    bounds = bounds - bounds[0]
    found = split.flatten().dictionary_encode()
    parts, at = found.dictionary.to_pylist(), found.indices.to_numpy().astype(np.int64)
    # a part stands after a space, but for the first of a text
    first = bounds[:-1]
    glued = np.fromiter((not p or p[0].isspace() for p in parts), bool, len(parts))[at]
    glued[first] = False
    starting, place = np.unique(at[first], return_inverse=True)
    at[first] = len(parts) + place
    distinct = [" " + p for p in parts] + [parts[p] for p in starting]
    odd = np.unique(np.searchsorted(bounds, np.flatnonzero(glued), "right") - 1)
    if len(odd):
        number = {chunk: n for n, chunk in enumerate(distinct)}
        pieces = np.split(at, bounds[1:-1])
        for n in odd:
            own = [number.setdefault(chunk, len(number)) for chunk in chunks(texts[n].as_py())]
            pieces[n] = np.array(own, np.int64)
        at, distinct = np.concatenate(pieces), list(number)
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
    return distinct, at, bounds


def gather(values: list[bytes], at: np.ndarray, bounds: np.ndarray) -> Iterator[bytes]:
    """For each text the values of its chunks, joined."""
    cuts = bounds.tolist()
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield b"".join(map(values.__getitem__, at[a:b].tolist()))


def slices(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """A column in slices of about ``size`` bytes, of one text at least; nulls become empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        taken = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, taken + size, "right")))
        yield texts.slice(start, stop - start)
        start = stop


def batch_slices(batches: Iterable[pa.RecordBatch], column: int, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut to about ``size`` bytes in a column of texts, and to one row at least."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(ends):
            taken = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, taken + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def segments(text: str, size: int) -> Iterator[str]:
    """A text in segments of at least ``size`` characters, cut where a chunk starts."""
    at = 0
    while at < len(text):
        start = _CHUNK_START.search(text, at + size)
        end = start.start() if start else len(text)
        yield text[at:end]
        at = end


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as they are, the others from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def _read_file(path: str, pattern: str):
    """A tokenizer file as an encoding of ``tiktoken``, and its special tokens with their ids."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    byte = _byte_of_character()
    ranks = {
        bytes(map(byte.__getitem__, token)): rank
        for token, rank in content["model"]["vocab"].items()
        if token not in special
    }
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens=special), special


def file_encoder(path: str, pattern: str) -> Callable[[str], bytes]:
    """Texts to ids of a byte-level file of the ``tokenizers`` library, no special tokens added.

    The ids are those that library gives. They come from ``tiktoken`` with the
    vocabulary of the file as ranks, because it takes a quarter of the time.
    """
    known, special = _read_file(path, pattern)
    chunk_ids = Known(known.encode_ordinary)

    def encode(text: str) -> bytes:
        if any(s in text for s in special):  # known as a whole, before a text is split
            return np.asarray(known.encode(text, allowed_special="all"), "<u4").tobytes()
        return encode_by_chunk(chunk_ids, text)

    return encode


class ColumnEncoder:
    """Columns of texts to the ids of :func:`file_encoder`, looked up once per distinct word.

    The texts of some megabytes are split together, every distinct chunk is
    encoded once, and the ids are gathered by chunk. A text with a special token
    goes the way of a single text; so does a very long one, in segments.
    """

    def __init__(self, path: str, pattern: str):
        self.encoding, self.special = _read_file(path, pattern)
        self.known = Known(self.encoding.encode_ordinary)

    def __call__(self, texts: pa.Array) -> Iterator[bytes]:
        for part in slices(texts, SLICE_BYTES):
            if len(part) == 1 and part.nbytes > 2 * SLICE_BYTES:
                yield self._single(part[0].as_py())
            else:
                yield from self._slice(part)

    def _single(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return np.asarray(self.encoding.encode(text, allowed_special="all"), "<u4").tobytes()
        return b"".join([encode_by_chunk(self.known, part) for part in segments(text, SLICE_BYTES // 4)])

    def _slice(self, texts: pa.Array) -> Iterator[bytes]:
        special = np.zeros(len(texts), bool)
        for token in self.special:
            special |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        distinct, at, bounds = split_column(texts)
        for n, ids in enumerate(gather([self.known[c] for c in distinct], at, bounds)):
            yield self._single(texts[n].as_py()) if special[n] else ids
