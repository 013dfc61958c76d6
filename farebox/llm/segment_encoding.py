"""Encode texts by their distinct words.

A tokenizer whose pre-tokenizer drops white space never forms a token across
it, so a text's ids are the ids of its white-space separated segments in a row.  Each distinct segment is encoded once and looked up from then on.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# Bounds of a Python worker's memory: text held at a time, segments whose ids
# are gathered at a time, segments the library encodes at a time.
TEXT_BYTES_AT_ONCE = 6 << 20
WORDS_AT_ONCE = 1 << 18
SEGMENTS_AT_ONCE = 4096


def load_tokenizer(path: str) -> Tokenizer:
    """The library's tokenizer; its own threads are off, as Spark runs a task per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


def drops_white_space(path: str, tokenizer: Tokenizer) -> bool:
    """True when the file's pre-tokenizer keeps only matches without white
    space and no step before it can join text across white space."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = spec.get("pre_tokenizer") or {}
    first = (steps.get("pretokenizers") or [steps])[0]
    plain = all(not t["single_word"] and not t["lstrip"] and not t["rstrip"] and not t["normalized"]
                and len(t["content"].split()) == 1 for t in spec["added_tokens"])
    return (first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
            and spec.get("post_processor") is None and plain
            and tokenizer.encode(" \t\n a \x0b\x0c\r", add_special_tokens=False).ids
            == tokenizer.encode("a", add_special_tokens=False).ids)


def take_runs(values: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``values[b : b + n]`` of every (b, n), one after the other."""
    first = np.cumsum(sizes) - sizes
    return values[np.repeat(begin - first, sizes) + np.arange(int(sizes.sum()))]


# Encodes segments: all their ids one after the other, and how many each has.
EncodeSegments = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


def library_segments(path: str) -> EncodeSegments:
    """Encodes segments with the library itself."""
    tokenizer = load_tokenizer(path)

    def encode(segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, sizes = [], []
        for k in range(0, len(segments), SEGMENTS_AT_ONCE):
            ids = [e.ids for e in tokenizer.encode_batch_fast(segments[k : k + SEGMENTS_AT_ONCE], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)))
            flat.append(np.fromiter((i for x in ids for i in x), dtype=np.int64, count=int(sizes[-1].sum())))
        return np.concatenate(flat), np.concatenate(sizes)

    return encode


def encode_column(column: pa.Array, encode: EncodeSegments) -> Iterator[np.ndarray]:
    """The ids (uint32) of each text of a string column (null: none), a
    bounded part of the column at a time."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // TEXT_BYTES_AT_ONCE
    cuts = np.flatnonzero(np.diff(part)) + 1
    for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(column)]):
        if stop > start:
            yield from _encode_part(column.slice(start, stop - start), encode)


def _encode_part(texts: pa.Array, encode: EncodeSegments) -> Iterator[np.ndarray]:
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = split.flatten().dictionary_encode()
    segments = [s.decode("utf-8", "replace") for s in coded.dictionary.cast(pa.binary()).to_pylist()]
    at = coded.indices.to_numpy(zero_copy_only=False)
    ids, sizes = encode(segments)
    ids, begin = ids.astype(np.uint32), np.cumsum(sizes) - sizes
    bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
    row = 0
    while row < len(texts):  # as many rows as hold WORDS_AT_ONCE segments
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + WORDS_AT_ONCE, side="right")) - 1)
        words = at[bounds[row] : bounds[end]]
        held = sizes[words]
        found = take_runs(ids, begin[words], held)
        ends = np.append(0, np.cumsum(held))[bounds[row : end + 1] - bounds[row]]
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
            yield found[a:b]
        row = end
