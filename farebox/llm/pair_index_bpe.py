"""BPE encoding over a pair occurrence index, and decoding.

All distinct words of a part of the texts are laid out as one array of
symbols.  An index maps each mergeable pair (by its rank) to all positions
where it occurs.  The active ranks are applied in ascending order: all
occurrences of the pair merge at once, and the pairs they form with their
neighbours enter the lists of their own ranks.  Since a merge can only build
on symbols of earlier merges (checked when the file is read), that order gives
each word the merges it would get alone.

The library's normaliser and pre-tokenizer cut texts into words, so special
strings inside texts and Unicode are handled as it handles them.

Defined results: a null or empty text has no ids and decodes to the empty
text; texts of any length are encoded whole; rows are encoded one by one, so
repeated rows give equal results and a null id stays null; of equal pairs (ties
of rank) the leftmost merges first; an empty table gives no rows; other columns
play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm.common import bounded, struct_array
from farebox.llm.segment_encoding import drops_white_space, encode_column, load_tokenizer, take_runs

# Printable ASCII and precomposed Latin letters whose lower case is one letter.
PLAIN = re.compile("[!-~\u00c0-\u012f\u0131-\u0148\u014a-\u017e]+")
FEW = 8
NO_RANK = np.int32((1 << 31) - 1)
# Segments whose ids an encoder keeps for later calls, and the bytes of the longest.
KNOWN_SEGMENTS = 400_000
KNOWN_BYTES = 64

RESULT_TYPE = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                            T.StructField("decoded_sha256", T.StringType())])


def byte_characters() -> list[str]:
    """The character that stands for each byte in the files: itself where it
    is printable Latin-1, else the next one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class PairIndexBpe:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, tokenizer = spec["model"], load_tokenizer(path)
        if (model["type"] != "BPE" or model["dropout"] or model["unk_token"] or model["byte_fallback"]
                or model["ignore_merges"] or model["continuing_subword_prefix"] or spec["decoder"] is not None
                or not drops_white_space(path, tokenizer)):
            raise ValueError(f"{path}: this encoder takes plain BPE files that drop white space")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.tokenizer = tokenizer
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_split = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self.size = max([*self.vocab.values(), *self.special.values()]) + 1
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made: dict[str, int] = {}
        for rank, (a, b) in enumerate(merges):
            made[a + b] = rank
        if any(made.get(x, -1) >= rank for rank, pair in enumerate(merges) for x in pair):
            raise ValueError(f"{path}: a merge needs a symbol that only a later merge makes")
        left = np.array([self.vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([self.vocab[b] for _, b in merges], dtype=np.int64)
        self.merged = np.array([self.vocab[a + b] for a, b in merges], dtype=np.int32)
        self.twins = left == right
        keys = left * self.size + right
        self.rank_of = {k: r for r, k in enumerate(keys.tolist())}
        self.rank_order = np.argsort(keys).astype(np.int32)
        self.pair_keys = keys[self.rank_order]
        self.plain_normal = self._plain_normal(spec["normalizer"])
        self.pattern = self._pattern(spec["pre_tokenizer"])
        # Symbols of a word's bytes, and of its last byte.
        characters = byte_characters()
        self.symbol_of = np.array([self.vocab[c] for c in characters], dtype=np.int32)
        self.last_symbol_of = np.array([self.vocab[c + self.suffix] for c in characters], dtype=np.int32)
        self.token_of: list[bytes] = [b""] * self.size
        for token, i in [*self.vocab.items(), *self.special.items()]:
            self.token_of[i] = token.encode()
        self._forget()

    @staticmethod
    def _pattern(pre_tokenizer: dict) -> regex.Pattern | None:
        """The pattern whose matches are the words, when the file has nothing
        else but the mapping of bytes to characters."""
        split, *rest = pre_tokenizer["pretokenizers"]
        if list(split["pattern"]) != ["Regex"] or len(rest) != 1 or rest[0]["type"] != "ByteLevel":
            return None
        return None if rest[0]["add_prefix_space"] or rest[0]["use_regex"] else regex.compile(split["pattern"]["Regex"])

    @staticmethod
    def _plain_normal(normalizer: dict | None):
        """What the normaliser does to ``PLAIN`` text between blanks; None when
        it has steps this class does not know."""
        steps = [] if normalizer is None else normalizer.get("normalizers", [normalizer])
        if any(n["type"] not in ("NFC", "Lowercase") and (n["type"] != "Replace" or n["pattern"] != {"Regex": "\\s+"})
               for n in steps):
            return None
        return str.lower if any(n["type"] == "Lowercase" for n in steps) else str

    # ------------------------------------------------------------ encoding
    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.rank_order[at], NO_RANK)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words (UTF-8), one after the other, and the number of
        ids of each word."""
        counts = np.zeros(len(words), dtype=np.int64)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        total = int(sizes.sum())
        if not total:
            return np.empty(0, dtype=np.int32), counts
        some, sizes = sizes > 0, sizes[sizes > 0]
        ends = np.cumsum(sizes)
        values = np.frombuffer(b"".join(words), dtype=np.uint8)
        symbol = self.symbol_of[values]
        symbol[ends - 1] = self.last_symbol_of[values[ends - 1]]
        after = np.arange(1, total + 1, dtype=np.int32)
        after[ends - 1] = -1
        before = np.arange(-1, total - 1, dtype=np.int32)
        before[ends - sizes] = -1
        rank = np.full(total, NO_RANK, dtype=np.int32)
        inner = np.flatnonzero(after >= 0).astype(np.int32)
        rank[inner] = self._ranks(symbol[inner], symbol[after[inner]])
        lists: dict[int, list[np.ndarray | int]] = {}
        active: list[int] = []
        rank_of, size = self.rank_of, self.size

        def enlist(positions: np.ndarray) -> None:
            """Add positions to the lists of their pairs' ranks."""
            ranks = rank[positions]
            there = ranks != NO_RANK
            positions, ranks = positions[there], ranks[there]
            if not len(positions):
                return
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ranks)]):
                r = int(ranks[start])
                if r not in lists:
                    lists[r] = []
                    heapq.heappush(active, r)
                lists[r].append(positions[start:stop])

        def enlist_one(position: int, pair: int) -> None:
            """Set the rank of the pair at a position and add it to its list."""
            r = rank_of.get(pair)
            rank[position] = NO_RANK if r is None else r
            if r is not None:
                if r not in lists:
                    lists[r] = []
                    heapq.heappush(active, r)
                lists[r].append(position)

        def merge_one(p: int, r: int, new: int) -> None:
            """Merge the pair at one position."""
            gone = int(after[p])
            following = int(after[gone])
            symbol[p], symbol[gone], rank[gone], after[p], rank[p] = new, -1, NO_RANK, following, NO_RANK
            if following >= 0:
                before[following] = p
                enlist_one(p, new * size + int(symbol[following]))
            previous = int(before[p])
            if previous >= 0:
                enlist_one(previous, int(symbol[previous]) * size + new)

        just_merged = np.zeros(total, dtype=bool)
        enlist(inner)
        while active:
            r = heapq.heappop(active)
            found = lists.pop(r)
            if sum(1 if x.__class__ is int else len(x) for x in found) <= FEW:  # not worth array operations
                new = int(self.merged[r])
                for p in sorted(p for x in found for p in ([x] if x.__class__ is int else x.tolist())):
                    if rank[p] == r:
                        merge_one(p, r, new)
                continue
            if len(found) == 1:
                at = found[0]
            else:
                arrays = [x for x in found if x.__class__ is not int]
                ones = np.array([x for x in found if x.__class__ is int], dtype=np.int32)
                at = np.unique(np.concatenate([*arrays, ones]))
            at = at[rank[at] == r]
            if self.twins[r]:  # a a a: leftmost first, without overlap
                taken, chosen = -1, []
                for p in sorted(at.tolist()):
                    if p != taken:
                        chosen.append(p)
                        taken = int(after[p])
                at = np.array(chosen, dtype=np.int32)
            if not len(at):
                continue
            gone = after[at]
            following = after[gone]
            symbol[at] = self.merged[r]
            symbol[gone] = -1
            rank[gone] = NO_RANK
            after[at] = following
            inside = following >= 0
            before[following[inside]] = at[inside]
            rank[at] = NO_RANK
            with_next = at[inside]
            rank[with_next] = self._ranks(symbol[with_next], symbol[after[with_next]])
            just_merged[at] = True
            previous = before[at]
            with_previous = previous[(previous >= 0) & ~just_merged[previous]]
            just_merged[at] = False
            rank[with_previous] = self._ranks(symbol[with_previous], symbol[after[with_previous]])
            enlist(np.concatenate([with_next, with_previous]))
        alive = symbol >= 0
        counts[some] = np.add.reduceat(alive.astype(np.int64), ends - sizes)
        return symbol[alive], counts

    def _words(self, segment: str) -> list[str | int]:
        """Words of a segment as the library cuts it; special strings as ids."""
        out: list[str | int] = []
        for k, piece in enumerate(self.special_split.split(segment) if self.special_split else [segment]):
            if k % 2:
                out.append(self.special[piece])
            elif piece:
                out += self._cut(self._normal(piece))[0]
        return out

    def _normal(self, text: str) -> str:
        return self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text

    def _cut(self, normal: str) -> tuple[list[str], list[int]]:
        """Words of a normalised text as the library cuts it, and their starts."""
        spans = [at for _, at in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]
        return [normal[a:b] for a, b in spans], [a for a, _ in spans]

    def _words_of_all(self, segments: list[str]) -> tuple[list[str | int], np.ndarray]:
        """The words of all segments, and the segment of each word.

        Segments of ``PLAIN`` text are cut by the pre-tokenizer's own pattern,
        those with special strings or white space one by one by the library,
        the others by the library in one call.
        """
        special = self.special_split if self.special_split and self.special_split.search(" ".join(segments)) else None
        is_plain = PLAIN.fullmatch if self.pattern and self.plain_normal else lambda s: None
        plain, others, words, owners = [], [], [], []
        for i, s in enumerate(segments):
            if special and special.search(s):
                words += (own := self._words(s))
                owners += [i] * len(own)
            elif is_plain(s):
                plain.append(i)
            elif len(s.split()) == 1:
                others.append(i)
            else:
                words += (own := self._words(s))
                owners += [i] * len(own)
        owner = [np.array(owners, dtype=np.int64)]
        if plain:
            texts = [segments[i] for i in plain]
            found = self.pattern.findall(self.plain_normal(" ".join(texts)))
            sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
            lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            if lengths.sum() == sizes.sum():  # the pattern leaves out nothing, so words follow one another
                words += found
                of = np.repeat(np.array(plain, dtype=np.int64), sizes)
                owner.append(of[np.cumsum(lengths) - lengths])
            else:
                others = sorted(others + plain)
        normal = self._normal(" ".join(segments[i] for i in others))
        pieces = normal.split(" ")
        if len(pieces) == len(others):
            found, starts = self._cut(normal)
            sizes = np.fromiter((len(x) + 1 for x in pieces), dtype=np.int64, count=len(pieces))
            words += found
            owner.append(np.repeat(np.array(others, dtype=np.int64), sizes)[np.array(starts, dtype=np.int64)])
        else:  # normalising has made or lost a blank: one by one
            for i in others:
                words += (own := self._words(segments[i]))
                owner.append(np.full(len(own), i, dtype=np.int64))
        return words, np.concatenate(owner)

    def _forget(self) -> None:
        self.known, self.known_ids = pa.array([], pa.string()), np.empty(0, dtype=np.int32)
        self.known_sizes = np.empty(0, dtype=np.int64)

    def encode_segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments (text without ASCII white space), one after the
        other, and the number of ids of each segment; short segments of earlier
        calls are looked up."""
        given = pa.array(segments, pa.string())
        at = pc.fill_null(pc.index_in(given, value_set=self.known), -1).to_numpy().astype(np.int64)
        fresh = np.flatnonzero(at < 0)
        ids, sizes = self._encode_fresh([segments[i] for i in fresh.tolist()])
        at[fresh] = len(self.known) + np.arange(len(fresh))
        ids, sizes = np.concatenate([self.known_ids, ids]), np.concatenate([self.known_sizes, sizes])
        begin, counts = (np.cumsum(sizes) - sizes)[at], sizes[at]
        short = pc.binary_length(given).to_numpy() <= KNOWN_BYTES
        kept = fresh[short[fresh]]
        if len(self.known) + len(kept) > KNOWN_SEGMENTS:  # full: go on with the segments of this call
            self._forget()
            kept = np.flatnonzero(short)[:KNOWN_SEGMENTS]
        self.known = pa.concat_arrays([self.known, given.take(pa.array(kept))])
        self.known_ids = np.concatenate([self.known_ids, take_runs(ids, begin[kept], counts[kept]).astype(np.int32)])
        self.known_sizes = np.concatenate([self.known_sizes, counts[kept]])
        return take_runs(ids, begin, counts), counts

    def _encode_fresh(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``encode_segments`` without looking up."""
        words, owner = self._words_of_all(segments)
        special = [k for k, w in enumerate(words) if w.__class__ is int]
        special_ids = [words[k] for k in special]
        for k in special:
            words[k] = ""
        coded = pa.array(words, pa.string()).dictionary_encode()
        at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        ids, counts = self.encode_words(coded.dictionary.cast(pa.binary()).to_pylist())
        at[special] = len(counts) + np.arange(len(special))
        ids = np.append(ids, np.array(special_ids, dtype=ids.dtype))
        counts = np.append(counts, np.ones(len(special), dtype=np.int64))
        order = np.argsort(owner, kind="stable")
        at = at[order]
        begin = np.cumsum(counts) - counts
        sizes = np.bincount(owner[order], weights=counts[at], minlength=len(segments)).astype(np.int64)
        return take_runs(ids, begin[at], counts[at]), sizes

    # ------------------------------------------------------------ decoding
    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 text of the ids, special tokens included; without a decoder
        in the file, the tokens stand between blanks."""
        return b" ".join(map(self.token_of.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def encoder_of(path: str) -> PairIndexBpe:
    """One encoder per Python worker."""
    return PairIndexBpe(path)


def ids_column(text, path: str):
    """array<int> of the ids of each text."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids(texts: pa.Array) -> pa.Array:
        return pa.array([x.view(np.int32) for x in encode_column(texts, encoder_of(path).encode_segments)], pa.list_(pa.int32()))

    return ids(text)


def decoded_column(ids, path: str):
    """The text of each array of ids (null: null)."""

    @F.arrow_udf(T.StringType())
    def decoded(column: pa.Array) -> pa.Array:
        bpe = encoder_of(path)
        return pa.array([None if x is None else bpe.decode(np.array(x, dtype=np.int64)).decode() for x in column.to_pylist()],
                        pa.string())

    return decoded(ids)


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, number of ids, digest of the ids and of the
    text decoded from them."""

    @F.arrow_udf(RESULT_TYPE)
    def digests(texts: pa.Array) -> pa.Array:
        bpe = encoder_of(path)
        rows = [(len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                 hashlib.sha256(bpe.decode(ids)).hexdigest()) for ids in encode_column(texts, bpe.encode_segments)]
        return struct_array(rows, RESULT_TYPE)

    return bounded(docs).select(F.col(id_col), digests(F.col(text_col)).alias("_digests")).select(id_col, "_digests.*")
