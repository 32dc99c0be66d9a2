"""Byte-level BPE: encoding of whole texts by tree concatenation, and decoding.

Text is cut where the pre-tokenizer always cuts. What lies between two cuts is a word; words repeat,
so each is looked up in a table of words that were encoded before and only new ones are encoded.
Text that has no cut for long is unsplit text. It is encoded as a tree: halves down to leaves,
leaves as one batch, then joins from the leaves up. At a join, growing windows around the seam are
encoded again until the first and the last token of the window are the ones that stood there. Every
pair of neighbours in the result is then a pair of neighbours in an encoding of its own bytes, which
makes the result the encoding of the whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablevet.llm.common import prefix_hashes, run_hashes, ship, text_slices

LEAF_CHARS = 1024
TABLE_BITS = 21
SPECIAL_MARK = b"<|"


def _byte_values(vocabulary: dict[str, int]) -> list[bytes]:
    """The bytes of every token. Printable bytes stand for themselves in the file; the others are
    numbered from U+0100 in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    value = {chr(b): b for b in plain}
    value |= {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(value[c] for c in token) if all(c in value for c in token) else token.encode()
    return out


class Spelling:
    """The bytes of all tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        self.special = [t["content"].encode() for t in content["added_tokens"]]
        self.vocabulary = content["model"]["vocab"]
        self.tokens = _byte_values(self.vocabulary | {t["content"]: t["id"] for t in content["added_tokens"]})
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that the ids spell."""
        sizes = self.sizes[ids]
        to = np.cumsum(sizes) - sizes
        return self.bytes[np.repeat(self.starts[ids] - to, sizes) + np.arange(sizes.sum())]


class Codec(Spelling):
    """A tokenizer file with its table of words. One per Python worker and file."""

    def __init__(self, path: str):
        super().__init__(path)
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value
        ranks = {self.tokens[i]: i for i in self.vocabulary.values() if self.tokens[i] not in self.special}
        # The same vocabulary without offsets, for many short words at once.
        self.fast = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.clear()

    def clear(self) -> None:
        self.slot_hash = np.zeros(1 << TABLE_BITS, np.uint64)
        self.slot_word = np.zeros(1 << TABLE_BITS, np.int64)
        self.word_start, self.word_count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.pool = np.zeros(1 << 18, np.uint32)
        self.n_words = self.n_ids = 0

    def library(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    # ---- the table of words ------------------------------------------------------------------

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Word number of each hash, -1 where unknown."""
        mask = np.uint64((1 << TABLE_BITS) - 1)
        out = np.full(len(h), -1, np.int64)
        at, left = h & mask, np.arange(len(h))
        while len(left):
            stored = self.slot_hash[at]
            hit = stored == h[left]
            out[left[hit]] = self.slot_word[at[hit]]
            on = ~hit & (stored != 0)
            left, at = left[on], (at[on] + np.uint64(1)) & mask
        return out

    def _add(self, h: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        if self.n_words + len(h) > 1 << (TABLE_BITS - 1):
            self.clear()
        first = self.n_words
        for name, n, new in (("word_start", first, self.n_ids + np.cumsum(counts) - counts), ("word_count", first, counts), ("pool", self.n_ids, ids)):
            held = getattr(self, name)
            if n + len(new) > len(held):
                held = np.concatenate([held, np.zeros(max(len(held), len(new)), held.dtype)])
                setattr(self, name, held)
            held[n : n + len(new)] = new
        self.n_words, self.n_ids = first + len(h), self.n_ids + len(ids)
        mask = np.uint64((1 << TABLE_BITS) - 1)
        at, left = h & mask, np.arange(len(h))
        while len(left):
            free = self.slot_hash[at] == 0
            _, one = np.unique(at[free], return_index=True)
            put = np.flatnonzero(free)[one]
            self.slot_hash[at[put]] = h[left[put]]
            self.slot_word[at[put]] = first + left[put]
            on = np.ones(len(left), bool)
            on[put] = False
            left, at = left[on], (at[on] + np.uint64(1)) & mask

    # ---- encoding ----------------------------------------------------------------------------

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Marks offsets where any text with these bytes is cut: before a single space that a visible
        character follows, around such a line feed, and between a letter and a sign. Only ASCII and
        Latin letters count, about which all versions of Unicode agree."""
        letter, visible = LETTER[data], VISIBLE[data]
        out = np.zeros(len(data) + 1, bool)
        if len(data) > 1:
            out[:-2] = ((data[:-1] == 0x20) | (data[:-1] == 0x0A)) & visible[1:]
            out[1:-1] |= (data[:-1] == 0x0A) & visible[1:]
            out[1:-1] |= letter[:-1] & SIGN[data[1:]]
        return out

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(texts), np.uint8)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        cut = self.cuts(data)
        cut[np.maximum(ends - 1, 0)] = False  # what follows there is another text
        cut[ends] = cut[ends - lengths] = True
        bounds = np.flatnonzero(cut)
        starts, stops = bounds[:-1], bounds[1:]
        owner = np.searchsorted(ends, starts, side="right")
        h = run_hashes(prefix_hashes(data), starts, stops)
        h[h == 0] = 1
        # Unsplit text and texts with the mark of special tokens do not go into the table.
        apart = stops - starts > LEAF_CHARS
        marked = np.array([SPECIAL_MARK in t and any(s in t for s in self.special) for t in texts])
        if marked.any():
            apart |= marked[owner]
        word = np.where(apart, -1, self._find(h))
        new = np.flatnonzero((word < 0) & ~apart)
        if len(new):
            _, one = np.unique(h[new], return_index=True)
            new = new[one]
            n_before = self.n_words
            self._learn(data, starts[new], stops[new], h[new])
            again = (word < 0) & ~apart if self.n_words >= n_before + len(new) else ~apart
            word[again] = self._find(h[again])
        counts = np.where(word >= 0, self.word_count[np.maximum(word, 0)], 0)
        odd = {}
        for i in np.flatnonzero(apart & ~marked[owner]) if apart.any() else []:
            odd[i] = self.unsplit(data[starts[i] : stops[i]].tobytes().decode())
        for k in np.flatnonzero(marked):
            own = np.flatnonzero(owner == k)
            counts[own] = 0
            odd[own[0]] = self.library([texts[k].decode()])[0]
        for i, ids in odd.items():
            counts[i] = len(ids)
        where = np.cumsum(counts) - counts
        source = np.where(word >= 0, self.word_start[np.maximum(word, 0)], 0) - where
        flat = self.pool[np.minimum(np.repeat(source, counts) + np.arange(counts.sum()), len(self.pool) - 1)]
        for i, ids in odd.items():
            flat[where[i] : where[i] + len(ids)] = ids
        per_text = np.bincount(owner, weights=counts, minlength=len(texts)).astype(np.int64)
        # Two words with one hash would show here: the ids of one do not spell the other.
        spelled = self.decode(flat)
        if len(spelled) != len(data) or not np.array_equal(spelled, data):
            found = self.library([t.decode() for t in texts])
            return np.concatenate(found), np.array([len(f) for f in found])
        return flat, per_text

    def _learn(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray, h: np.ndarray) -> None:
        """Encode new words and add them. Words of visible ASCII and Latin letters are encoded as one
        text, each on a line of its own, and cut apart again by length; the others by the library."""
        bad = np.append(0, np.cumsum(~(VISIBLE[data] | TRAIL[data])))
        inner = bad[stops] - bad[np.minimum(starts + 1, stops)]
        first = data[starts]
        simple = (inner == 0) & (VISIBLE[first] | (first == 0x20)) & ((stops - starts > 1) | (first != 0x20))
        raw = data.tobytes()
        pick = np.flatnonzero(simple)
        if len(pick):
            text = b"\n".join(raw[a:b] for a, b in zip(starts[pick].tolist(), stops[pick].tolist()))
            ids = np.array(self.fast.encode_ordinary(text.decode()), np.uint32)
            ends = np.cumsum(self.sizes[ids])
            sizes = stops[pick] - starts[pick]
            last = np.cumsum(sizes + 1) - 1
            a, b = np.searchsorted(ends, last - sizes, side="right"), np.searchsorted(ends, last) + 1
            counts = b - a
            keep = np.repeat(a - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            self._add(h[pick], ids[keep], counts)
        rest = np.flatnonzero(~simple)
        if len(rest):
            found = self.library([raw[a:b].decode() for a, b in zip(starts[rest].tolist(), stops[rest].tolist())])
            self._add(h[rest], np.concatenate(found), np.array([len(f) for f in found]))

    def unsplit(self, text: str) -> np.ndarray:
        """Text without a sure cut: each long pre-token as a tree, the others by the library."""
        spans = [s for _, s in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        out, start = [], 0
        for a, b in spans:
            if b - a > LEAF_CHARS:
                if start < a:
                    out += self.library([text[start:a]])
                out.append(self.tree(text[a:b]))
                start = b
        if start < len(text):
            out += self.library([text[start:]])
        return np.concatenate(out)

    def tree(self, word: str, leaf: int = LEAF_CHARS) -> np.ndarray:
        """Ids of one pre-token. Its halves down to ``leaf`` characters are one batch of the library,
        which runs them in parallel; then neighbours are joined, level by level."""
        parts = [word]
        while len(parts[0]) > leaf:
            parts = [half for p in parts for half in (p[: len(p) // 2], p[len(p) // 2 :])]
        ids = self.library(parts)
        while len(ids) > 1:
            ids = [self.join(ids[i], ids[i + 1]) for i in range(0, len(ids), 2)]
        return ids[0]

    def join(self, left: np.ndarray, right: np.ndarray, window: int = 8) -> np.ndarray:
        """The encoding of two neighbouring parts of one pre-token from their encodings."""
        while True:
            a, b = max(0, len(left) - window), min(len(right), window)
            # A window starts and ends between characters.
            while a > 0 and self.tokens[left[a]][0] & 0xC0 == 0x80:
                a -= 1
            while b < len(right) and self.tokens[right[b]][0] & 0xC0 == 0x80:
                b += 1
            raw = b"".join(self.tokens[i] for i in (*left[a:].tolist(), *right[:b].tolist()))
            middle = self.library([raw.decode()])[0]
            if (a == 0 or middle[0] == left[a]) and (b == len(right) or middle[-1] == right[b - 1]):
                return np.concatenate([left[:a], middle, right[b:]])
            window *= 2


_RANGE = np.arange(256)
_ASCII_LETTER = ((_RANGE | 0x20) >= 0x61) & ((_RANGE | 0x20) <= 0x7A) & (_RANGE < 0x80)
LETTER = _ASCII_LETTER
VISIBLE = ((_RANGE >= 0x21) & (_RANGE <= 0x7E)) | ((_RANGE >= 0xC3) & (_RANGE <= 0xC9))
TRAIL = (_RANGE >= 0x80) & (_RANGE <= 0xBF)
SIGN = np.isin(_RANGE, list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\n"))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


@lru_cache(maxsize=2)
def spelling(path: str) -> Spelling:
    return Spelling(path)


def id_lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))


def id_slices(batches: Iterator[pa.RecordBatch], most: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    """Row slices of about ``most`` ids; a longer list is a slice by itself."""
    for batch in batches:
        total = np.append(0, np.cumsum(batch.column("ids").value_lengths().fill_null(0).to_numpy(), dtype=np.int64))
        start = 0
        while start < len(batch):
            stop = max(start + 1, int(np.searchsorted(total, total[start] + most, side="right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every whole text, as the tokenizers library encodes it without
    added special tokens, truncation and padding; a special token's own string in a text gives that
    token. Null texts are empty and have no ids; null and repeated ids are rows like others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            ids, counts = codec(path).encode(texts)
            yield pa.RecordBatch.from_arrays([rows.column(0), id_lists(ids, counts)], ["doc_id", "ids"])

    plain = ship(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with a column ``text``: what the ids of ``ids`` spell, special tokens included.
    Bytes that are no UTF-8 become U+FFFD. Null ids spell the empty text."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in id_slices(batches):
            own = spelling(path)
            lists = rows.column("ids").fill_null([])
            flat = lists.flatten().to_numpy()
            ends = np.cumsum(own.sizes[flat])
            raw = own.decode(flat).tobytes()
            last = np.append(0, ends)[np.cumsum(lists.value_lengths().to_numpy())]
            first = np.append(0, last[:-1])
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(first.tolist(), last.tolist())]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts)], [*rows.schema.names, "text"])

    return ship(encoded).drop("text").mapInArrow(run, f"{schema}, text string")


def ids_digest(encoded: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``encoded`` with n_tokens and the SHA-256 of the ids as little-endian words."""
    import hashlib

    kept = encoded.select(*columns, "ids")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in id_slices(batches):
            lists = rows.column("ids").fill_null([])
            raw = lists.flatten().to_numpy().astype("<u4").tobytes()
            last = 4 * np.cumsum(lists.value_lengths().to_numpy()).astype(np.int64)
            first = np.append(0, last[:-1])
            shas = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(first.tolist(), last.tolist())]
            counts = pa.array((last - first) // 4)
            yield pa.RecordBatch.from_arrays([*rows.columns[:-1], counts, pa.array(shas)], [*columns, "n_tokens", "ids_sha256"])

    return kept.mapInArrow(run, f"{schema}, n_tokens bigint, ids_sha256 string")


def round_trip_report(docs: DataFrame, path: str) -> DataFrame:
    decoded = decode(encode(docs, path), path)
    hashed = decoded.select("doc_id", F.sha2("text", 256).alias("decoded_sha256"), "ids")
    return ids_digest(hashed, ["doc_id", "decoded_sha256"])
