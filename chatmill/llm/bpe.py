"""Byte-level BPE encoding and decoding with the tokenizers library.

The vocabulary is a file of ranks (base64 token, rank).  Its byte-pair merges
are every split of a token into two tokens, in rank order, written in the
byte-to-character alphabet of byte-level BPE.  A text is cut at places that
the pretokenizer's pattern never crosses (before a space or a run of white
space, and between letters and closing punctuation), each different piece is
encoded once by the library, and a worker keeps the pieces it has met in a
bounded cache, which changes the speed only.  Decoding reverses the byte
table; a character may be spread over several tokens.
"""

from __future__ import annotations

import base64
import codecs
import os
import re
import string
from collections.abc import Iterator
from functools import cached_property
from itertools import compress
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow

#: pieces in each of a codec's two cache generations; ``encode``'s workers are many, so theirs are smaller
CACHE_PIECES = 300_000
ENCODE_CACHE_PIECES = 120_000
#: white space as the pretokenizer's pattern sees it
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f"
#: a piece that is one word to the pretokenizer
LETTERS_ONLY = re.compile(f" ?[{LETTERS}]+")
PIECES = re.compile(f" ?[{LETTERS}]+(?=[.,!?;:{SPACE}]|\\Z)| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")

#: always a cut before it behind a letter or digit
CLOSING = string.punctuation


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself where it is printable
    Latin-1, the next one from U+0100 on otherwise."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def rank_tokenizer(ranks: dict[bytes, int]):
    """A tokenizers BPE that merges as the ranks say."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    alphabet = byte_alphabet()
    spelled = {token: "".join(alphabet[b] for b in token) for token in ranks}
    merges = [(spelled[token[:i]], spelled[token[i:]]) for token in sorted(ranks, key=ranks.get)
              for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
    tokenizer = Tokenizer(models.BPE(vocab={spelled[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    return tokenizer


def file_tokenizer(path: str):
    """A tokenizer file; strings of its special tokens are ordinary text."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def _joined(table: np.ndarray, sizes: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The table's rows of these numbers, one after another, and their sizes."""
    size = sizes[number]
    ends = np.cumsum(size)
    return table[np.repeat((np.cumsum(sizes) - sizes)[number] - (ends - size), size) + np.arange(size.sum())], size


def _closed(words: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Words without the one to three closing characters behind a letter or
    digit, and the bytes of these, the last one lowest (0: none)."""
    core = pc.utf8_rtrim(words, CLOSING)
    size = pc.subtract(pc.binary_length(words), pc.binary_length(core))
    cut = pc.and_(pc.and_(pc.greater(size, 0), pc.less(size, 4)), pc.match_substring_regex(core, f"[{LETTERS}0-9]\\z"))
    closing = np.zeros(len(words), np.int64)
    at = np.flatnonzero(cut.to_numpy(zero_copy_only=False))
    if len(at):
        size, ends = size.to_numpy()[at], np.frombuffer(words.buffers()[1], np.int64)[words.offset + at + 1]
        data = np.frombuffer(words.buffers()[2], np.uint8)
        for k in range(3):
            more = size > k
            closing[at[more]] |= data[ends[more] - 1 - k].astype(np.int64) << 8 * k
    return pc.if_else(cut, core, words).dictionary_encode(), closing


class Codec:
    """Encodes texts to ids (little-endian unsigned 32-bit) and back.  The
    library's tokenizer is made when first needed: decoding does without."""

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path, self.cache_pieces = path, cache_pieces
        if path.endswith(".json"):
            of = {c: b for b, c in enumerate(byte_alphabet())}
            tokens = {i: bytes(of[c] for c in t) if all(c in of for c in t) else t.encode() for t, i in self.tokenizer.get_vocab().items()}
        else:
            tokens = {i: t for t, i in load_ranks(path).items()}
        self.tokens = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.lengths = np.array([len(t) for t in self.tokens])
        self.spelling = dict(enumerate(byte_alphabet()))
        # pieces met of late, and those before them: a full cache becomes the old one
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @cached_property
    def tokenizer(self):
        return file_tokenizer(self.path) if self.path.endswith(".json") else rank_tokenizer(load_ranks(self.path))

    @cached_property
    def model(self):
        return self.tokenizer.model

    def _encode_new(self, pieces: set[str]) -> dict[str, bytes]:
        out, rest = {}, []
        for piece in pieces:
            ids = self.old.get(piece)
            if ids is not None:
                out[piece] = ids
            elif LETTERS_ONLY.fullmatch(piece):
                # letters after at most one space are one word to the model: no need to cut them again
                word = piece.encode().decode("latin-1").translate(self.spelling)
                out[piece] = pack(f"<{len(ids := [t.id for t in self.model.tokenize(word)])}I", *ids)
            else:
                rest.append(piece)
        for at in range(0, len(rest), 10_000):
            some = rest[at:at + 10_000]
            for piece, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                out[piece] = pack(f"<{len(e.ids)}I", *e.ids)
        return out

    def encode_many(self, texts: list[str]) -> list[bytes]:
        if len(self.cache) > self.cache_pieces:
            self.cache, self.old = {}, self.cache
        rows, new = [], set()
        for text in texts:
            pieces = PIECES.findall(text)
            ids = list(map(self.cache.get, pieces))
            if None in ids:
                new.update(p for p, i in zip(pieces, ids) if i is None)
            rows.append((pieces, ids))
        found = self._encode_new(new)
        if len(found) <= self.cache_pieces:  # else a huge text of unseen pieces: not kept
            self.cache.update(found)
        return [b"".join([found[p] if i is None else i for p, i in zip(pieces, ids)] if None in ids else ids) for pieces, ids in rows]

    @cached_property
    def word_tokenizer(self):
        """The model alone, on words that are spelled in the byte alphabet and joined by line ends."""
        from tokenizers import Tokenizer, pre_tokenizers

        tokenizer = Tokenizer(self.model)
        tokenizer.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        return tokenizer

    def _encode_unseen(self, pieces: list[str]) -> dict[str, bytes]:
        out = {p: i for p in pieces if (i := self.old.get(p)) is not None}
        unseen = [p for p in pieces if p not in out]
        single = pc.match_substring_regex(pa.array(unseen, pa.large_string()), f"\\A ?[{LETTERS}]+\\z")
        words, rest = list(compress(unseen, single.to_pylist())), list(compress(unseen, pc.invert(single).to_pylist()))
        spelled = np.array([ord(c) for c in byte_alphabet()], "<u4")
        spelled[10] = 10
        for at in range(0, len(words), 10_000):
            some = words[at:at + 10_000]
            joined = np.frombuffer("\n".join(some).encode(), np.uint8)
            found = self.word_tokenizer.encode_batch_fast([spelled[joined].tobytes().decode("utf-32-le")], add_special_tokens=False)[0].ids
            ids = np.array(found, "<u4")
            # the word ends where the tokens' bytes are as many as its own and those of the words before
            breaks = np.r_[np.flatnonzero(joined == 10), len(joined)]
            ends = np.searchsorted(np.cumsum(self.lengths[ids]), breaks - np.arange(len(some))) + 1
            data, bounds = ids.tobytes(), (4 * ends).tolist()
            out.update(zip(some, [data[a:b] for a, b in zip([0, *bounds], bounds)]))
        out.update(zip(rest, self.encode_many(rest)))
        return out

    def _ids_of(self, pieces: list[str]) -> list[bytes]:
        if len(self.cache) > self.cache_pieces:
            self.cache, self.old = {}, self.cache
        ids = list(map(self.cache.get, pieces))
        if None in ids:
            found = self._encode_unseen(list({p for p, i in zip(pieces, ids) if i is None}))
            ids = [found[p] if i is None else i for p, i in zip(pieces, ids)]
            if len(found) <= self.cache_pieces:
                self.cache.update(found)
        return ids

    def encode_words(self, texts: list[str]) -> list[bytes]:
        """As ``encode_many``, but Arrow cuts the texts before each space and
        numbers the different words, and only these, without closing
        punctuation behind a letter or digit, are looked up.  The pattern
        crosses such a cut only if white space is on both sides of the space:
        texts with such a place go to ``encode_many``."""
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        first, found = split.offsets.to_numpy()[:-1].astype(np.int64), split.values.dictionary_encode()
        number, words = found.indices.to_numpy().astype(np.int64), found.dictionary
        empty = pc.equal(words, "").to_numpy(zero_copy_only=False)
        before, after = (pc.match_substring_regex(words, p).to_numpy(zero_copy_only=False) for p in (f"[{SPACE}]\\z", f"\\A[{SPACE}]"))
        if (empty | before).any():
            end, start = (before | empty)[number], (after | empty)[number]
            end[first], start[first] = before[number[first]], False  # nothing stands before a text
            crossed = np.flatnonzero(start[1:] & end[:-1]) + 1
            if len(crossed):
                odd = np.unique(np.searchsorted(first, crossed, "right") - 1).tolist()
                out = dict(zip(odd, self.encode_many([texts[i] for i in odd])))
                plain = [i for i in range(len(texts)) if i not in out]
                out.update(zip(plain, self.encode_words([texts[i] for i in plain])))
                return [out[i] for i in range(len(texts))]
        starting, at_start = np.unique(number[first], return_inverse=True)
        number[first] = len(words) + at_start
        # a word of two lines is the two and the line end; words after a space, and words after none
        lines = pc.match_substring_regex(words, f"\\A[^{SPACE}]+\n[^{SPACE}]+\\z")
        halves = pc.split_pattern(words.filter(lines), "\n").flatten().cast(pa.large_string())
        both = np.arange(len(halves)).reshape(-1, 2)
        spaced = pc.replace_with_mask(words, lines, halves.take(pa.array(both[:, 0])))
        bare = pa.concat_arrays([halves.take(pa.array(both[:, 1])), words.take(pa.array(starting))])
        pieces, tails = ["", "\n"], {0: 0}
        spelling = np.zeros((len(words) + len(starting), 5), np.int64)
        for some, space, at, rows in ((spaced, " ", 0, np.arange(len(words))),
                                      (bare, "", 3, np.r_[np.flatnonzero(lines.to_numpy(zero_copy_only=False)), len(words) + np.arange(len(starting))])):
            cores, closing = _closed(some)
            different, closing = np.unique(closing, return_inverse=True)
            for tail in different.tolist():
                if tail not in tails:
                    tails[tail] = len(pieces)
                    pieces.append(tail.to_bytes(3, "big").decode().lstrip("\0"))
            spelling[rows, at], spelling[rows, at + 1] = len(pieces) + cores.indices.to_numpy(), np.array([tails[t] for t in different.tolist()], np.int64)[closing]
            pieces += [space + c for c in cores.dictionary.to_numpy(zero_copy_only=False).tolist()]
        spelling[:len(words), 2] = spelling[:len(words), 3] > 0
        ids = self._ids_of(pieces)
        table, sizes = _joined(np.frombuffer(b"".join(ids), "<u4"), np.array([len(i) // 4 for i in ids]), spelling.ravel())
        table, sizes = _joined(table, sizes.reshape(-1, 5).sum(axis=1), number)
        data, ends = table.tobytes(), 4 * np.r_[0, np.cumsum(sizes)]
        bounds = ends[np.r_[first, len(sizes)]].tolist()
        return [data[a:b] for a, b in zip(bounds, bounds[1:])]

    def decode(self, ids: bytes) -> bytes:
        return b"".join([self.tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])

    def _bounds(self, data: bytes, ids: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and one-past-last byte of each token, and whether each byte is a character's first."""
        ends = np.cumsum(self.lengths[np.frombuffer(ids, "<u4")])
        return np.r_[0, ends[:-1]] if len(ends) else ends, ends, (np.frombuffer(data, np.uint8) & 0xC0) != 0x80

    def n_split(self, data: bytes, ids: bytes) -> int:
        """How many tokens begin or end inside a character."""
        if data.isascii():
            return 0
        starts, ends, lead = self._bounds(data, ids)
        begins = np.r_[lead, True]
        return int((~begins[starts] | ~begins[ends]).sum())

    def offsets(self, data: bytes, ids: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First and one-past-last character of each token."""
        starts, ends, lead = self._bounds(data, ids)
        number = np.cumsum(lead) - 1
        return number[starts].astype(np.int32), (number[ends - 1] + 1).astype(np.int32)


_codecs: dict[tuple[str, int], Codec] = {}


def codec(path: str, cache_pieces: int = CACHE_PIECES) -> Codec:
    key = (path, cache_pieces)
    if key not in _codecs:
        _codecs[key] = Codec(path, cache_pieces)
    return _codecs[key]


def _some(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def texts_of(column: pa.Array) -> list[str]:
    return [(x or b"").decode("utf-8", "replace") for x in column.to_pylist()]


def _extended(schema: T.StructType, extra: list[T.StructField]) -> tuple[T.StructType, list[str]]:
    new = {f.name.lower() for f in extra}
    old = [f for f in schema if f.name.lower() not in new]
    return T.StructType([*old, *extra]), [f.name for f in old]


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", with_offsets: bool = False, with_decoded: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (binary: little-endian unsigned 32-bit),
    ``n_tokens`` and ``n_split`` (tokens that begin or end inside a
    character); with ``with_offsets`` also ``starts`` and ``ends`` (characters
    of the text, arrays), with ``with_decoded`` also ``decoded``, the bytes
    that the ids decode to (as :func:`decode`, but by the same worker).  NULL and empty texts give no ids.  Every other
    column stays; one of the same name as a new one is replaced."""
    extra = [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_split", T.LongType())]
    if with_offsets:
        extra += [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("starts", "ends")]
    if with_decoded:
        extra.append(T.StructField("decoded", T.BinaryType()))
    schema, kept = _extended(docs.schema, extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, ENCODE_CACHE_PIECES)
        for batch in batches:
            for part in _some(batch):
                texts = texts_of(part.column(len(kept)))
                ids = own.encode_many(texts)
                data = [t.encode() for t in texts]
                columns = [part.column(n) for n in kept] + [
                    pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([own.n_split(d, i) for d, i in zip(data, ids)], pa.int64())]
                if with_offsets:
                    found = [own.offsets(d, i) for d, i in zip(data, ids)]
                    columns += [pa.array([x[k] for x in found], pa.list_(pa.int32())) for k in (0, 1)]
                if with_decoded:
                    columns.append(pa.array([own.decode(i) for i in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_arrow(docs.select(*(F.col(f"`{n}`") for n in kept), F.col(text_col).cast("binary").alias("_text")), run, schema)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encoded`` with ``decoded`` (binary) for its ``ids``.  The bytes are
    whole even where a character is spread over tokens; ids cut inside a
    character give the bytes up to the cut (``decode_stream`` holds these
    back)."""
    schema, kept = _extended(encoded.schema, [T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, ENCODE_CACHE_PIECES)
        for batch in batches:
            for part in _some(batch):
                data = [None if i is None else own.decode(i) for i in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(n) for n in kept] + [pa.array(data, pa.binary())], names=schema.names)

    return map_arrow(encoded, run, schema)


def decode_stream(own: Codec, ids: Iterator[int]) -> Iterator[str]:
    """Text as ids arrive: a character comes out with its last byte."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for i in ids:
        if text := decoder.decode(own.tokens[i]):
            yield text
    if text := decoder.decode(b"", True):
        yield text
