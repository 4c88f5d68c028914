"""Cross-tokenizer alignment against the libraries on whole texts."""

import collections
import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chatmill.llm import alignment, queries
from tests.conftest import SF0001

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    byte_of = {chr(x) if x in shown else chr(next(spare)): x for x in range(256)}
    a_bytes = lambda i: bytes(byte_of[c] for c in a.id_to_token(i))
    b_bytes = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return a, b, a_bytes, b_bytes


def brute(libraries, texts):
    """Per text: n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    a, b, a_bytes, b_bytes = libraries
    rows, counts = [], collections.Counter()
    for text in texts:
        spans, whole = [], (" " + (text or "")).encode()
        for ids, bytes_of in ((a.encode(" " + text, add_special_tokens=False).ids, a_bytes), (b.encode(text), b_bytes)) if text else ():
            at, out = 0, []
            for i in ids:
                out.append((i, at, at := at + len(bytes_of(i))))
            spans.append(out if b"".join(map(bytes_of, ids)) == whole else None)
        if not text or None in spans:
            rows.append(None)
            continue
        x, y = spans
        ends = sorted({e for _, _, e in x} & {e for _, _, e in y})
        groups, start = [], 0
        for end in ends:
            groups.append([[i for i, s, e in side if start <= s and e <= end] for side in (x, y)])
            start = end
        links = [(i, j) for i, s, e in x for j, s2, e2 in y if s < e2 and s2 < e] if len(x) < 80 else None
        if links is None:  # the same, token by token, for longer texts
            links, k = [], 0
            for i, s, e in x:
                while y[k][2] <= s:
                    k += 1
                m = k
                while m < len(y) and y[m][1] < e:
                    links.append((i, y[m][0]))
                    m += 1
        counts.update(links)
        rows.append((len(x), len(y), len(groups), links, ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)))
    best = collections.defaultdict(int)
    for (i, j), n in counts.items():
        best[j] = max(best[j], n)
    return [(*r[:3], len(r[3]), sum(counts[p] == best[p[1]] for p in r[3]), sum(counts[p] for p in r[3]), hashlib.sha256(r[4].encode()).hexdigest()) if r else (0,) * 6 + ("",)
            for r in rows]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def check(libraries, rows, docs):
    ours = sorted((str(r.doc_id), *(r[c] for c in COLUMNS)) for r in rows)
    theirs = sorted((str(d), *x) for (d, _), x in zip(docs, brute(libraries, [t for _, t in docs])))
    assert ours == theirs


def test_documents(spark, libraries):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()]
    check(libraries, queries.QUERIES["op13_alignment"](spark, SF0001).collect(), docs)


ODD = ["", None, " ", "  ", "\n", "a", " a", "a ", "a  b", "a   b\t c\n\n d ", "tab\tone ▁ two", "x▁y", "été \U0001f600\U0001f468‍\U0001f469 ﬁ Ⅷ",
       "<|endoftext|> <s> </s> <0x41> <unk>", "nul\x00 byte", "\x1c \x85 \xa0 x 　y", "it's they'll 've 123456 12,345.67", "w" * 3000, "w" * 9000, "\n" * 5000 + "x", " " * 5000 + "x", "x" + " \t" * 3000, "ab " * 2000, "same text", "same text"]


@pytest.mark.parametrize("chunk,slice_pairs", [(1 << 17, 1 << 22), (40, 1 << 22), (8, 50)])
def test_odd_texts_in_ranges_and_slices(spark, libraries, chunk, slice_pairs):
    """NULL, empty and very long texts, repeated rows and ids, white space of all kinds, clashing names; texts dealt in small ranges."""
    rng = random.Random(7)
    words = ["a", "the", " ", "  ", "\n", "\t", "é", "\U0001f600", "'s", "12", "x,y", "中文", "\xa0", "Wort"]
    texts = ODD + ["".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(rng.randrange(1, 400))) for _ in range(60)]
    docs = [(k if k % 9 else None, t) for k, t in enumerate(texts)] + [(3, "same text")]
    table = spark.createDataFrame([(d, t, 1, "x", b"y") for d, t in docs], "doc_id long, text string, n_a int, row string, links binary").repartition(3)
    check(libraries, alignment.align(table, A, B, chunk=chunk, slice_pairs=slice_pairs).collect(), docs)


def test_a_text_of_many_ranges(spark, libraries):
    """Three levels of the tree reduction, and a huge text without a space."""
    docs = [(1, "one two three four " * 600), (2, "x▁ " + "bad range " * 300), (3, "abc" * 20_000), (4, "short")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    check(libraries, alignment.align(table, A, B, chunk=16).collect(), docs)


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=30), st.randoms(use_true_random=False))
def test_fragments_compose_associatively(lengths, rng):
    """Any cutting of the tokens into byte ranges, composed in any order, gives the groups of the whole."""
    total = sum(lengths)
    a = list(enumerate(lengths))
    cuts = sorted({rng.randrange(1, total + 1) for _ in range(10)} | {total})
    b = [(100 + k, e - s) for k, (s, e) in enumerate(zip([0, *cuts], cuts))]
    whole, groups = alignment.fragment(a, b)
    expected = [whole.first, *groups]
    bounds = sorted({rng.randrange(0, total + 1) for _ in range(4)} | {0, total})

    def inside(tokens, low, high):
        ends, at = [], 0
        for i, n in tokens:
            at += n
            ends.append((i, n, at))
        own = [(i, n, e) for i, n, e in ends if low < e <= high]
        return [(i, n) for i, n, _ in own], (own[0][2] - own[0][1] if own else low)

    parts = []
    for low, high in zip(bounds, bounds[1:]):
        (x, x_start), (y, y_start) = inside(a, low, high), inside(b, low, high)
        f, own = alignment.fragment(x, y, x_start, y_start)
        parts.append((f, own))
    while len(parts) > 1:  # neighbours composed in a random order
        k = rng.randrange(len(parts) - 1)
        (f, left), (g, right) = parts[k:k + 2]
        h, joint = alignment.compose(f, g)
        parts[k:k + 2] = [(h, left + ([joint] if joint else []) + right)]
    f, own = parts[0]
    assert [f.first, *own] == expected and f.last == ([], [])
    for x, y in expected:
        links = alignment.links_of(x, y)
        assert links == sorted(set(links))
