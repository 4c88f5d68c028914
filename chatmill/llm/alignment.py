"""Alignment of the tokens of two tokenizers over the same bytes.

A byte-level BPE (A) and a sentencepiece model (B) encode the same text with a
space before it.  Places where tokens of both end cut the tokens into groups;
inside a group, tokens whose bytes overlap are linked.

What a byte range of a text says is a fragment: the tokens up to the first
common end (open on the left), the closed groups, the tokens after the last
common end (open on the right).  Fragments compose associatively: the open
suffix of one and the open prefix of the next make a group.  A text of more
than ``CHUNK`` characters is dealt in byte ranges to Spark tasks (cut before a
lone space between two other characters, where both tokenizers begin anew), and
a tree reduction composes their open ends; the closed groups stay where they
are and are read once more, in order, for the digest.

How often two ids are linked is counted over all texts.  These counts are
bounded by the two vocabularies; they are dealt by B's ids into slices of at
most ``SLICE_PAIRS`` pairs, and each slice is broadcast to one pass over the
written links.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import byte_alphabet, file_tokenizer
from .common import map_arrow, staged

CHUNK = 1 << 16
#: the pattern by which byte-level BPE cuts a text into words
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: characters without a space that are no word
LONG_WORD = 4096
#: fragments composed by one step of the tree reduction
FAN = 16
SLICE_PAIRS = 1 << 22
#: a place where both tokenizers cut: a lone space between characters that are no white space
_CUT = re.compile(r"(?<=\S) (?=\S)")

Tokens = list[tuple[int, int]]  # (id, bytes)


class Fragment(NamedTuple):
    """What a byte range says.  ``first`` and ``last`` are the open tokens of A
    and of B; without a common end all tokens are in ``first``."""

    cut: bool
    first: tuple[Tokens, Tokens]
    last: tuple[Tokens, Tokens]


def _ends(tokens: Tokens, start: int) -> Iterator[int]:
    for _, n in tokens:
        start += n
        yield start


def fragment(a: Tokens, b: Tokens, a_start: int = 0, b_start: int = 0) -> tuple[Fragment, list[tuple[Tokens, Tokens]]]:
    """The fragment of consecutive tokens, the first of which begin at the
    given bytes, and its closed groups."""
    a_ends, b_ends = list(_ends(a, a_start)), list(_ends(b, b_start))
    groups, i, j = [], 0, 0
    at_b = {e: k + 1 for k, e in enumerate(b_ends)}
    for k, e in enumerate(a_ends, 1):
        if e in at_b:
            groups.append((a[i:k], b[j:at_b[e]]))
            i, j = k, at_b[e]
    if not groups:
        return Fragment(False, (a, b), ([], [])), []
    return Fragment(True, groups[0], (a[i:], b[j:])), groups[1:]


def compose(f: Fragment, g: Fragment) -> tuple[Fragment, tuple[Tokens, Tokens] | None]:
    """The fragment of two neighbouring ranges, and the group closed between them if there is one."""
    if not f.cut:
        return Fragment(g.cut, (f.first[0] + g.first[0], f.first[1] + g.first[1]), g.last), None
    joint = f.last[0] + g.first[0], f.last[1] + g.first[1]
    if not g.cut:
        return Fragment(True, f.first, joint), None
    return Fragment(True, f.first, g.last), joint


def links_of(a: Tokens, b: Tokens) -> list[tuple[int, int]]:
    """All pairs of tokens of a group whose byte ranges overlap."""
    out, i, j = [], 0, 0
    a_end, b_end = a[0][1], b[0][1]
    while True:
        out.append((a[i][0], b[j][0]))
        a_over, b_over = a_end <= b_end, b_end <= a_end
        if a_over:
            i += 1
            if i < len(a):
                a_end += a[i][1]
        if b_over:
            j += 1
            if j < len(b):
                b_end += b[j][1]
        if i >= len(a) or j >= len(b):
            return out


def group_text(a: Tokens, b: Tokens) -> str:
    return ",".join([str(i) for i, _ in a]) + "|" + ",".join([str(i) for i, _ in b])


class Closed(NamedTuple):
    """Closed groups: tokens of A and of B, groups, their text, their links (A id times ``width`` plus B id)."""

    n_a: int
    n_b: int
    n_groups: int
    text: bytes
    links: bytes


def closed(groups: Iterable[tuple[Tokens, Tokens]], width: int) -> Closed:
    groups = list(groups)
    links = [x * width + y for a, b in groups for x, y in links_of(a, b)]
    return Closed(sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups),
                  ";".join([group_text(a, b) for a, b in groups]).encode(), np.array(links, "<u4").tobytes())


class Aligner:
    """Both tokenizers.  A's file is read by the tokenizers library; tiktoken
    encodes by its vocabulary, whose ids are the merges' ranks, in a third of
    the time.  It takes square time for a word without an end, so texts with
    one stay with the library."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken

        self.a_library = file_tokenizer(a_path)
        of = {c: n for n, c in enumerate(byte_alphabet())}
        own = {i: bytes(of[c] for c in t) for t, i in self.a_library.get_vocab().items() if all(c in of for c in t)}
        special = {i for i, t in self.a_library.get_added_tokens_decoder().items() if t.special}
        ranks = {t: i for i, t in own.items() if i not in special}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.width = self.b.get_piece_size()
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.width)))]
        self.a_sizes = np.zeros(max(own) + 1, np.int64)
        self.a_sizes[list(own)] = [len(t) for t in own.values()]
        self.b_sizes = np.array([len(t) for t in self.b_bytes], np.int64)
        # an id as text, with what may follow it in the text of the groups: 8 bytes each, and how many of them count
        self.n_a_texts = 2 * len(self.a_sizes)  # two forms of each id of A, then three of B's
        texts = [f"{i}{end}".encode() for i in range(len(self.a_sizes)) for end in ",|"] + [f"{i}{end}".encode() for i in range(self.width) for end in (",", ";", "")]
        self.text = np.array(texts, "S8").view(np.uint64)
        self.text_sizes = np.array([len(t) for t in texts], np.int64)

    def _a_ids(self, text: str) -> np.ndarray:
        if max(map(len, text.split(" "))) < LONG_WORD and " " * LONG_WORD not in text:
            return np.array(self.a.encode_ordinary(text), "<u4")
        return np.array(self.a_library.encode(text, add_special_tokens=False).ids, "<u4")

    def ids(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Of each text (a space first, and more) the ids of A and of B; None if the bytes differ."""
        out = []
        for text, y in zip(texts, self.b.encode([t[1:] for t in texts], num_threads=1)):
            data, x = text.encode(), self._a_ids(text)
            # A has a token for each byte and splits tokens only, so the number of its bytes tells
            same = int(self.a_sizes[x].sum()) == len(data) and b"".join(map(self.b_bytes.__getitem__, y)) == data
            out.append((x, np.array(y, "<u4")) if same else None)
        return out

    def tokens(self, text: str) -> tuple[Tokens, Tokens] | None:
        pair = self.ids([text])[0]
        return pair and tuple(list(zip(x.tolist(), sizes[x].tolist())) for x, sizes in zip(pair, (self.a_sizes, self.b_sizes)))

    def align(self, texts: list[str]) -> list[Closed | None]:
        """Of each text (a space first, and more) its groups; None if the bytes
        differ.  Texts end at common ends, so they are aligned as one: each
        stretch between neighbouring ends of either tokenizer is one link, and
        the ends of both are the groups."""
        pairs = self.ids(texts)
        whole = [p for p in pairs if p is not None]
        if not whole:
            return [None] * len(texts)
        a, b = (np.concatenate([p[k] for p in whole]) for k in (0, 1))
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        total = int(a_ends[-1]) + 1
        # by byte: whether a token of A, of B, of both ends there, and how many did before
        a_here, b_here = np.zeros(total, bool), np.zeros(total, bool)
        a_here[a_ends], b_here[b_ends] = True, True
        both = a_here & b_here
        ends, common = np.flatnonzero(a_here | b_here), np.flatnonzero(both)
        a_before, b_before, groups_before = (np.cumsum(x, dtype=np.int32) - x for x in (a_here, b_here, both))
        links = a[a_before[ends]] * np.uint32(self.width) + b[b_before[ends]]

        # tokens in the order of the text: a group's of A, then its of B
        a_cuts, b_cuts = a_before[common] + 1, b_before[common] + 1  # tokens up to each group's end
        a_upto, b_upto = (np.cumsum([len(p[k]) for p in whole]) for k in (0, 1))
        a_code, b_code = a.astype(np.int64) * 2, self.n_a_texts + b.astype(np.int64) * 3
        a_code[a_cuts - 1] += 1
        b_code[b_cuts - 1] += 1
        b_code[b_upto - 1] += 1
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.r_[0, b_cuts][groups_before[a_ends]]] = a_code
        order[np.arange(len(b)) + a_cuts[groups_before[b_ends]]] = b_code
        sizes = self.text_sizes[order]
        text = self.text[order].view(np.uint8).reshape(-1, 8)[np.arange(8) < sizes[:, None]].tobytes()
        text_upto = np.cumsum(sizes)[a_upto + b_upto - 1]

        stops = a_ends[a_upto - 1]
        group_upto, link_upto = groups_before[stops] + 1, np.searchsorted(ends, stops, "right")
        out, (i, j, k, m, t) = [], (0, 0, 0, 0, 0)
        for i2, j2, k2, m2, t2 in zip(*(x.tolist() for x in (a_upto, b_upto, group_upto, link_upto, text_upto))):
            out.append(Closed(i2 - i, j2 - j, k2 - k, text[t:t2], links[m:m2].tobytes()))
            i, j, k, m, t = i2, j2, k2, m2, t2
        done = iter(out)
        return [None if p is None else next(done) for p in pairs]


def pieces_of(b_path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def _ranges(text: str, size: int) -> list[str]:
    """``text``, which begins with a space, in ranges of about ``size``
    characters that both tokenizers begin anew; one without such a place stays whole."""
    out, start = [], 0
    while len(text) - start > size:
        at = _CUT.search(text, start + size)
        if at is None:
            break
        out.append(text[start:at.start()])
        start = at.start()
    return [*out, text[start:]]


_PARTS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("part", pa.int32()), ("parts", pa.int32()), ("data", pa.binary()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                    ("n_groups", pa.int64()), ("links", pa.binary()), ("groups_sha256", pa.string())])
_PARTS_DDL = ("row long, doc_id long, part int, parts int, data binary, n_a long, n_b long, n_groups long, links binary, groups_sha256 string")


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _first_pass(a_path: str, b_path: str, chunk: int):
    """Texts of one range aligned; those of several dealt out, still as text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, row = aligner(a_path, b_path), TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                piece, rows, short = batch.slice(at, 200), [], []
                for doc_id, data in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    try:
                        text = " " + (data or b"").decode()
                    except UnicodeDecodeError:
                        text = " "
                    parts = _ranges(text, chunk)
                    if len(parts) == 1:
                        short.append((row, doc_id, text))
                    else:
                        rows += [(row, doc_id, k, len(parts), t.encode(), 0, 0, 0, b"", "") for k, t in enumerate(parts)]
                    row += 1
                for (n, doc_id, text), c in zip(short, own.align([t for _, _, t in short])):
                    c = None if text == " " else c
                    rows.append((n, doc_id, 0, 1, None, c.n_a, c.n_b, c.n_groups, c.links, hashlib.sha256(c.text).hexdigest()) if c else
                                (n, doc_id, 0, 1, None, 0, 0, 0, b"", ""))
                yield _table(rows, _PARTS)

    return run


def _pack(tokens: tuple[Tokens, Tokens]) -> list[bytes]:
    return [np.array(t, "<u4").tobytes() for t in tokens]


def _unpack(a: bytes, b: bytes) -> tuple[Tokens, Tokens]:
    return tuple([tuple(t) for t in np.frombuffer(x, "<u4").reshape(-1, 2).tolist()] for x in (a, b))


_OPEN = [("row", pa.int64()), ("part", pa.int32()), ("first_part", pa.int32()), ("cut", pa.bool_()), ("first_a", pa.binary()), ("first_b", pa.binary()), ("last_a", pa.binary()), ("last_b", pa.binary())]
_OPEN_DDL = "row long, part int, first_part int, cut boolean, first_a binary, first_b binary, last_a binary, last_b binary"
_CLOSED = [("same", pa.bool_()), ("inner", pa.bool_()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups", pa.binary()), ("links", pa.binary())]
_CLOSED_DDL = "same boolean, inner boolean, n_a long, n_b long, n_groups long, groups binary, links binary"
_FRAGMENT = pa.schema([*_OPEN, *_CLOSED])


def _second_pass(a_path: str, b_path: str):
    """The fragment of each range: its open ends, and its closed groups."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path)
        for batch in batches:
            for row, part, data in zip(*(batch.column(k).to_pylist() for k in range(3))):
                pair = own.tokens(data.decode())
                f, groups = fragment(*pair) if pair else (Fragment(True, ([], []), ([], [])), [])
                yield _table([(row, part, part, f.cut, *_pack(f.first), *_pack(f.last), pair is not None, True, *closed(groups, own.width))], _FRAGMENT)

    return run


def _composed(width: int, last: bool):
    """A step of the tree reduction: the fragments of a group of neighbours
    become one; the groups closed between them come out as they are."""
    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.select([n for n, _ in _OPEN]).to_pylist(), key=lambda r: r["part"])
        out, whole, first_part = [], None, 0
        for r in rows:
            f = Fragment(r["cut"], _unpack(r["first_a"], r["first_b"]), _unpack(r["last_a"], r["last_b"]))
            if whole is None:
                whole, first_part = f, r["first_part"]
                continue
            if f.cut and not whole.cut:
                first_part = r["first_part"]
            whole, joint = compose(whole, f)
            if joint is not None:
                out.append((r["row"], r["first_part"], 0, None, None, None, None, None, True, False, *closed([joint], width)))
        if last:  # the text begins at a common end, so what is open on the left is a group
            out.append((rows[0]["row"], first_part, 0, None, None, None, None, None, True, False, *closed([whole.first] if whole.cut else [], width)))
        else:
            out.append((rows[0]["row"], rows[0]["part"] // FAN, first_part, whole.cut, *_pack(whole.first), *_pack(whole.last), None, None, None, None, None, None, None))
        return pa.Table.from_batches([_table(out, _FRAGMENT)])

    return run


def _reduced(fragments: DataFrame, width: int) -> DataFrame:
    """The groups closed between ranges, by tree reduction of the open ends."""
    most = fragments.agg(F.max("part")).first()[0] or 0
    open_, joints = fragments.select(*[n for n, _ in _OPEN]), None
    while True:
        step = staged(open_.groupBy("row", F.floor(F.col("part") / FAN)).applyInArrow(_composed(width, most < FAN), f"{_OPEN_DDL}, {_CLOSED_DDL}"), "composed")
        found = step.filter("inner IS NOT NULL")
        joints = found if joints is None else joints.unionByName(found)
        if most < FAN:
            return joints
        open_, most = step.filter("inner IS NULL").select(*[n for n, _ in _OPEN]), most // FAN


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each row's groups, which come in order, a piece at a time."""
    row, digest, any_ = None, hashlib.sha256(), False
    for batch in batches:
        done = []
        for r, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if r != row:
                if row is not None:
                    done.append((row, digest.hexdigest()))
                row, digest, any_ = r, hashlib.sha256(), False
            if text:
                digest.update(b";" + text if any_ else text)
                any_ = True
        yield _table(done, _DIGEST)
    if row is not None:
        yield _table([(row, digest.hexdigest())], _DIGEST)


_DIGEST = pa.schema([("row", pa.int64()), ("groups_sha256", pa.string())])


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task, counted by pair of ids."""
    pairs, n, held, size = np.zeros(0, np.uint32), np.zeros(0, np.int64), [], 0

    def merged():
        new, counts = np.unique(np.concatenate(held), return_counts=True)
        both, place = np.unique(np.concatenate([pairs, new]), return_inverse=True)
        return both, np.bincount(place, np.r_[n, counts], len(both)).astype(np.int64)

    for batch in batches:
        for x in batch.column(0):
            held.append(np.frombuffer(x.as_buffer(), "<u4"))
            size += len(held[-1])
        if size > 4_000_000:
            (pairs, n), held, size = merged(), [], 0
    if size:
        pairs, n = merged()
    for at in range(0, len(pairs), 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(pairs[at:at + 50_000].astype(np.int64)), pa.array(n[at:at + 50_000])], names=["pair", "n"])


_LINK_SUMS = pa.schema([("row", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64())])


def _link_sums(table):
    """Of each row's links: how many have their B id's highest count, and the sum of their counts, by one slice of the counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = (np.frombuffer(x, t) for x, t in zip(table.value, ("<u4", "<i8", "?")))
        for batch in batches:
            rows = []
            for row, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                links = np.frombuffer(x.as_buffer(), "<u4")
                place = np.minimum(np.searchsorted(pairs, links), len(pairs) - 1)
                here = place[pairs[place] == links]
                rows.append((row, int(best[here].sum()), int(n[here].sum())))
            yield _table(rows, _LINK_SUMS)

    return run


def _slices(counts: DataFrame, size: int) -> list[tuple[int, int]]:
    """Ranges of B ids (from, to) that hold about ``size`` pairs each."""
    sizes = sorted(tuple(r) for r in counts.groupBy("b").count().collect())  # one row for each id of B's vocabulary at most
    out, start, held = [], 0, 0
    for b, n in sizes:
        if held and held + n > size:
            out.append((start, b))
            start, held = b, 0
        held += n
    return [*out, (start, sizes[-1][0] + 1)] if sizes else []


def align(docs: DataFrame, a_path: str, b_path: str, chunk: int = CHUNK, slice_pairs: int = SLICE_PAIRS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``row, doc_id, n_a, n_b,
    n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``n_best`` counts the links whose pair of ids is the most frequent of its B
    id in all texts, ties included; ``count_sum`` adds up the counts of the
    links' pairs.  A text that is NULL, empty, not UTF-8, or that either
    tokenizer does not give back byte for byte has no tokens: zeros and an
    empty digest.  Strings of special tokens are ordinary text.  Repeated rows
    and ids count each for itself; a very long text is dealt in ranges; an
    empty table gives no rows; other columns are not looked at."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("data"))
    first = staged(map_arrow(rows, _first_pass(a_path, b_path, chunk), _PARTS_DDL), "aligned")
    width = pieces_of(b_path)

    ranges = first.filter("parts > 1")
    fragments = staged(map_arrow(ranges.select("row", "part", "data").repartition("row", "part"), _second_pass(a_path, b_path), f"{_OPEN_DDL}, {_CLOSED_DDL}"), "fragments")
    differing = fragments.filter("NOT same").select("row").distinct()
    fragments = fragments.join(differing, "row", "left_anti")
    pieces = fragments.select("row", "part", *[n for n, _ in _CLOSED]).unionByName(_reduced(fragments, width).select("row", "part", *[n for n, _ in _CLOSED]))
    pieces = staged(pieces, "long-pieces")
    ordered = pieces.repartition("row").sortWithinPartitions("row", "part", "inner").select("row", "groups")  # false first: what is closed before a range's own groups
    digests = map_arrow(ordered, _digests, "row long, groups_sha256 string")

    zero = F.lit(0).cast("long")
    short = first.filter("parts = 1")
    longs = ranges.filter("part = 0").select("row", "doc_id")
    links = short.select("row", "links").unionByName(pieces.select("row", "links")).filter(F.octet_length("links") > 0)

    counts = map_arrow(links.select("links"), _pair_counts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = counts.withColumn("b", F.col("pair") % width)
    counts = staged(counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b"))), "pair-counts")  # of an id of B at most A's vocabulary
    sums = None
    for low, high in _slices(counts, slice_pairs):
        found = counts.filter((F.col("b") >= low) & (F.col("b") < high)).select("pair", "n", "best").toArrow().sort_by("pair")
        table = docs.sparkSession.sparkContext.broadcast((found.column("pair").to_numpy().astype("<u4").tobytes(), found.column("n").to_numpy().astype("<i8").tobytes(),
                                       found.column("best").to_numpy().astype("?").tobytes()))
        part = map_arrow(links, _link_sums(table), "row long, n_best long, count_sum long")
        sums = part if sums is None else sums.unionByName(part)

    measures = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    n_links = F.floor(F.octet_length("links") / 4).cast("long").alias("n_links")
    parts = [short.select("row", "doc_id", "n_a", "n_b", "n_groups", n_links, zero.alias("n_best"), zero.alias("count_sum"), "groups_sha256"),
             pieces.select("row", F.lit(None).cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", n_links, zero.alias("n_best"), zero.alias("count_sum"), F.lit("").alias("groups_sha256")),
             longs.join(digests, "row", "left").select("row", "doc_id", *[zero.alias(m) for m in measures], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))]
    if sums is not None:
        parts.append(sums.select("row", F.lit(None).cast("long").alias("doc_id"), *[zero.alias(m) for m in measures[:4]], "n_best", "count_sum", F.lit("").alias("groups_sha256")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("row").agg(F.max("doc_id").alias("doc_id"), *[F.sum(m).alias(m) for m in measures], F.max("groups_sha256").alias("groups_sha256"))
