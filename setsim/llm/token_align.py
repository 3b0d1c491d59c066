"""Alignment of the token sequences that two tokenizers give one text.

Both cut the same bytes, so a token is a range of bytes and its end a number.
The shorter list of ends drives a galloping search into the longer one: from
where its neighbour stood, steps double until they pass the end, a binary search
settles the last step.  Here all ends of a slice of texts gallop side by side.
An end that both lists hold closes a group; the ranks of the closing tokens slice
both sequences into groups, and the rank differences of token starts and ends
give the range of tokens of the other side that a token overlaps
(:func:`overlaps`).

Tokenizers.  A is byte-level BPE, B sentencepiece BPE with byte fallback.  Texts
are first cut at single spaces between two solid characters.  Neither tokenizer
merges across such a place (A's pattern starts a new piece there, and B's pieces
have their space in front, which is checked when the model is read), so that a
piece is encoded once and its tokens serve all its occurrences in a task, up to a
bounded store.  A long text passes as segments of bounded length.

Links and counts.  Two tokens that end together have one inside the other at the
end, so that the id pairs that can be linked follow from the two vocabularies:
each proper or whole suffix of a token that is a token of the other.  They are
listed once (:func:`linkable`), which bounds the corpus-wide counts by the
vocabularies and not by the corpus.

Defined results: null and empty texts, texts that are not valid UTF-8, and texts
whose tokens do not join to a space and the text have no tokens; rows that repeat
an id are rows of their own; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setsim.llm.common import drop_step, row_slices, small_batches, write_step

TOKENIZER_DIR = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
#: Characters of a segment, tokens that a task stores of pieces seen before.
SEGMENT = 1 << 20
STORE_TOKENS = 1 << 22
#: A single space between two characters that no white space class holds.
_CUT = re.compile(r"(?<=[\w!-~]) (?=[\w!-~])")


def byte_level_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 for itself, the others from U+0100 on in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Encoders:
    """The two tokenizers and the bytes of their tokens, from the files' contents."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        spec = json.loads(a_json)
        letters = byte_level_alphabet()
        vocab = spec["model"]["vocab"]
        added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.a_bytes = [b""] * (1 + max([*vocab.values(), *added.values()]))
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        for token, i in added.items():
            self.a_bytes[i] = token.encode()
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        #: Whether no piece holds a space after a solid character.
        self.splits = not any("▁" in p.lstrip("▁") for p in pieces)

    def pieces(self, text: str) -> list[str]:
        """Texts that can be encoded each on its own; joined by a space they give ``text``."""
        return _CUT.split(text) if self.splits else [text]

    def encode(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        batch = getattr(self.a, "encode_batch_fast", self.a.encode_batch)
        a = [x.ids for x in batch([" " + p for p in pieces], add_special_tokens=False)]
        return a, self.b.encode(pieces, num_threads=1)


@lru_cache(maxsize=1)
def _encoders(a_json: str, b_model: bytes) -> Encoders:
    """Read once for each Python worker."""
    return Encoders(a_json, b_model)


def linkable(a_bytes: list[bytes], b_bytes: list[bytes]) -> np.ndarray:
    """Sorted codes ``a << 32 | b`` of all id pairs that can end together."""
    found = set()
    for left, right, swapped in ((a_bytes, b_bytes, False), (b_bytes, a_bytes, True)):
        by_bytes: dict[bytes, list[int]] = {}
        for j, raw in enumerate(right):
            if raw:
                by_bytes.setdefault(raw, []).append(j)
        for i, raw in enumerate(left):
            for s in range(len(raw)):
                for j in by_bytes.get(raw[s:], ()):
                    found.add((j << 32 | i) if swapped else (i << 32 | j))
    return np.array(sorted(found), np.int64)


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each end of ``short`` the rank of the first end of ``long`` that is not
    smaller.  Both ascend.  Every other element is searched first; the elements
    between start from its place and gallop on, all in step."""
    n, m = len(short), len(long)
    if n == 0 or m == 0:
        return np.zeros(n, np.int64)
    out = np.empty(n, np.int64)
    if n <= 16:
        start = np.zeros(n, np.int64)
        todo = np.arange(n)
    else:
        out[::8] = gallop(short[::8], long)
        todo = np.flatnonzero(np.arange(n) % 8)
        start = out[todo // 8 * 8]
    want, low, step = short[todo], start.copy(), np.ones(len(todo), np.int64)
    far = np.flatnonzero(long[np.minimum(low, m - 1)] < want)
    while len(far):  # exponential steps: long[low] stays below what is wanted
        ahead = low[far] + step[far]
        below = (ahead < m) & (long[np.minimum(ahead, m - 1)] < want[far])
        far = far[below]
        low[far] = ahead[below]
        step[far] *= 2
    high = np.minimum(low + step, m)
    # long[low] may already reach the end wanted: the range (low - 1, high] holds the answer.
    low = np.where(long[np.minimum(low, m - 1)] < want, low, low - 1)
    open_ = np.flatnonzero(high - low > 1)
    while len(open_):  # binary search between the last two steps
        mid = (low[open_] + high[open_]) // 2
        below = long[mid] < want[open_]
        low[open_[below]] = mid[below]
        high[open_[~below]] = mid[~below]
        open_ = open_[high[open_] - low[open_] > 1]
    out[todo] = high
    return out


def common_ends(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in ``a_end`` and ``b_end`` of the ends that both hold."""
    if len(a_end) > len(b_end):
        b, a = common_ends(b_end, a_end)
        return a, b
    at = gallop(a_end, b_end)
    hit = np.flatnonzero((at < len(b_end)) & (b_end[np.minimum(at, max(len(b_end) - 1, 0))] == a_end)) if len(b_end) else \
        np.zeros(0, np.int64)
    return hit, at[hit]


def overlaps(start: np.ndarray, end: np.ndarray, other_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For tokens [start, end) the first token of the other side that overlaps it,
    and one past the last: differences of ranks among the other side's ends."""
    first = gallop(start + 1, other_end)
    last = gallop(end, other_end)
    return first, last + 1


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices of the stretches [first, first + size) one after the other."""
    stop = np.cumsum(size)
    return np.repeat(first - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)


class PieceStore:
    """Tokens of pieces seen before, as flat arrays of ids and byte lengths."""

    def __init__(self, encoders: Encoders):
        self.encoders = encoders
        self.a_len = np.array([len(x) for x in encoders.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in encoders.b_bytes], np.int64)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.a = self.b = np.zeros(0, np.int32)
        self.a_first = self.b_first = self.a_size = self.b_size = np.zeros(0, np.int64)
        self.good = np.zeros(0, bool)

    def _learn(self, pieces: list[str]) -> None:
        sides = self.encoders.encode(pieces)
        raw = [b" " + p.encode() for p in pieces]
        length, good = np.array([len(r) for r in raw], np.int64), np.ones(len(raw), bool)
        for side, ids in zip("ab", sides, strict=True):
            token, token_len = getattr(self.encoders, f"{side}_bytes"), getattr(self, f"{side}_len")
            size = np.array([len(x) for x in ids], np.int64)
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(size.sum()))
            stop = np.concatenate([[0], np.cumsum(token_len[flat])])[np.cumsum(size)]
            if b"".join([token[i] for i in chain.from_iterable(ids)]) != b"".join(raw) or (stop != np.cumsum(length)).any():
                good &= [b"".join([token[i] for i in x]) == r for x, r in zip(ids, raw, strict=True)]
            old = getattr(self, side)
            setattr(self, f"{side}_first", np.concatenate([getattr(self, f"{side}_first"), len(old) + np.cumsum(size) - size]))
            setattr(self, f"{side}_size", np.concatenate([getattr(self, f"{side}_size"), size]))
            setattr(self, side, np.concatenate([old, flat]))
        self.good = np.concatenate([self.good, good])
        self.number.update(zip(pieces, range(len(self.number), len(self.number) + len(pieces)), strict=True))

    def tokens(self, texts: list[str]):
        """Ids of A and B, tokens of each text on both sides, and which texts have tokens."""
        if len(self.a) > STORE_TOKENS:
            self.forget()
        cut = [self.encoders.pieces(t) for t in texts]
        fresh = list(set(chain.from_iterable(cut)).difference(self.number))
        if fresh:
            self._learn(fresh)
        count = np.array([len(c) for c in cut], np.int64)
        at = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cut)), np.int64, int(count.sum()))
        row = np.repeat(np.arange(len(texts)), count)
        good = np.bincount(row, ~self.good[at], len(texts)) == 0
        at, row = at[good[row]], row[good[row]]
        a = self.a[_spread(self.a_first[at], self.a_size[at])].astype(np.int64)
        b = self.b[_spread(self.b_first[at], self.b_size[at])].astype(np.int64)
        return (a, b, np.bincount(row, self.a_size[at], len(texts)).astype(np.int64),
                np.bincount(row, self.b_size[at], len(texts)).astype(np.int64), good)


def segments(text: str) -> list[str]:
    """A text in stretches of bounded length where it can be cut; joined by a space
    they give it back."""
    out, start = [], 0
    while len(text) - start > SEGMENT:
        m = _CUT.search(text, start + SEGMENT)
        if m is None:
            break
        out.append(text[start:m.start()])
        start = m.end()
    return [*out, text[start:]]


def _aligned(files, codes):
    """Rows (doc, n_a, n_b, n_groups, groups_sha256, links): ``links`` holds the
    place of each linked id pair in ``codes``, in text order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = PieceStore(_encoders(*files.value))
        pairs = codes.value
        # A token's number with the sign that follows it: the last of a group ends the side.
        a_text = [f"{i}{c}" for i in range(len(store.a_len)) for c in ",|"]
        b_text = [f"{i}{c}" for i in range(len(store.b_len)) for c in ",;"]
        signs = np.array(a_text + b_text, object)
        for batch, raws in row_slices(batches, "text", 1 << 20):
            ids = batch.column(batch.schema.names.index("doc"))
            parts, owner = [], []
            for i, raw in enumerate(raws):
                try:
                    text = raw.decode() if raw else ""
                except UnicodeDecodeError:
                    text = ""
                cut = segments(text) if text else []
                if len(cut) > 1 and not store.encoders.splits:
                    cut = [text]
                parts += cut
                owner += [i] * len(cut)
            rows = [[0, 0, 0, hashlib.sha256(), [], bool(0)] for _ in raws]
            bad = set()
            for x, y in _stretches(parts):
                a, b, n_a, n_b, good = store.tokens(parts[x:y])
                a_end, b_end = np.cumsum(store.a_len[a]), np.cumsum(store.b_len[b])
                i, j = common_ends(a_end, b_end)
                link = np.searchsorted(pairs, a[i] << 32 | b[j])
                # Both sides in the order of the groups: A's tokens, then B's.
                a_group, b_group = np.searchsorted(i, np.arange(len(a))), np.searchsorted(j, np.arange(len(b)))
                a_sign, b_sign = 2 * a, 2 * b + len(a_text)
                a_sign[i] += 1
                b_sign[j] += 1
                order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
                written = signs[np.concatenate([a_sign, b_sign])[order]]
                stop_a, stop_all = np.cumsum(n_a), np.cumsum(n_a + n_b)
                stop_link = np.searchsorted(i, stop_a)
                for k in range(y - x):
                    row = rows[owner[x + k]]
                    if not good[k]:
                        bad.add(owner[x + k])
                        continue
                    lo, hi = stop_link[k - 1] if k else 0, stop_link[k]
                    row[0] += int(n_a[k])
                    row[1] += int(n_b[k])
                    row[2] += int(hi - lo)
                    text = "".join(written[stop_all[k] - n_a[k] - n_b[k]:stop_all[k]])
                    row[3].update((";" if row[5] else "").encode() + text[:-1].encode())
                    row[5] = True
                    row[4].append(link[lo:hi])
            none = np.zeros(0, np.int64)
            out = [(0, 0, 0, "", none) if i in bad or not r[5] else (*r[:3], r[3].hexdigest(), np.concatenate(r[4]))
                   for i, r in enumerate(rows)]
            size = np.cumsum([0] + [len(r[4]) for r in out])
            links = pa.ListArray.from_arrays(pa.array(size, pa.int32()), pa.array(
                np.concatenate([none, *(r[4] for r in out)]).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array([r[c] for r in out], pa.int64()) for c in range(3)), pa.array([r[3] for r in out], pa.string()), links],
                ["doc", "n_a", "n_b", "n_groups", "groups_sha256", "links"])
    return run


def _stretches(parts: list[str]) -> Iterator[tuple[int, int]]:
    """Stretches of segments of about ``SEGMENT`` characters together."""
    start = size = 0
    for i, p in enumerate(parts):
        if i > start and size + len(p) > SEGMENT:
            yield start, i
            start, size = i, 0
        size += len(p)
    if start < len(parts):
        yield start, len(parts)


def _weighed(counts):
    """Adds n_best and count_sum to the rows of the alignment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best = counts.value
        for batch in batches:
            links = batch.column(batch.schema.names.index("links"))
            at = links.flatten().to_numpy()
            stop = np.cumsum(np.concatenate([[0], links.value_lengths().to_numpy()]))
            for name, value in (("n_best", best), ("count_sum", count)):
                total = np.concatenate([[0], np.cumsum(value[at], dtype=np.int64)])
                batch = batch.append_column(name, pa.array(total[stop[1:]] - total[stop[:-1]], pa.int64()))
            yield batch.drop_columns(["links"])
    return run


def align(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer_dir: str = TOKENIZER_DIR,
          byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> DataFrame:
    """``(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` for every row."""
    spark = docs.sparkSession
    small_batches(spark)
    with open(os.path.join(tokenizer_dir, byte_bpe), encoding="utf-8") as f:
        a_json = f.read()
    with open(os.path.join(tokenizer_dir, piece_bpe), "rb") as f:
        b_model = f.read()
    encoders = Encoders(a_json, b_model)
    codes = linkable(encoders.a_bytes, encoders.b_bytes)
    files, pairs = spark.sparkContext.broadcast((a_json, b_model)), spark.sparkContext.broadcast(codes)
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    aligned = write_step(source.mapInArrow(
        _aligned(files, pairs),
        "doc long, n_a long, n_b long, n_groups long, groups_sha256 string, links array<int>"), "align-links")
    # At most one row for each pair that the vocabularies allow.
    held = aligned.select(F.explode("links").alias("pair")).groupBy("pair").count().toArrow()
    count = np.zeros(len(codes), np.int64)
    count[held.column("pair").to_numpy()] = held.column("count").to_numpy()
    highest = np.zeros(len(encoders.b_bytes), np.int64)
    np.maximum.at(highest, codes & 0xFFFFFFFF, count)
    best = (count > 0) & (count == highest[codes & 0xFFFFFFFF])
    counts = spark.sparkContext.broadcast((count, best))
    weighed = aligned.mapInArrow(_weighed(counts), "doc long, n_a long, n_b long, n_groups long, groups_sha256 string, "
                                                   "n_best long, count_sum long")
    return weighed.select(F.col("doc").alias(id_col), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
                          "n_best", "count_sum", "groups_sha256")
