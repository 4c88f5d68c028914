"""Phrase collocations against brute force on small texts (the whole table is compared with SQL in test_llm.py)."""

import collections
import random
import re

import numpy as np
import pytest

from chatmill.llm import collocations
from tests.llm.test_llm import EDGES, low


def brute(docs, min_count, top, longest=4):
    """docs: (text, lang)."""
    f, n = collections.Counter(), collections.Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    candidates = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= min_count}
    longer = collections.Counter()
    for (lang, w), a in candidates.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                longer[lang, w[i:i + k]] = max(longer[lang, w[i:i + k]], a)
    rows = collections.defaultdict(list)
    for (lang, w), a in candidates.items():
        if 100 * longer[lang, w] >= 80 * a:
            continue
        score, _, l, r = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        rows[lang].append((-score, -a, " ".join(w).encode(), l, r))
    return sorted((lang, rank, p.decode(), -a, l, r, n[lang], -score) for lang, found in rows.items()
                  for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1))


def table(spark, docs):
    return spark.createDataFrame([(k, t, lang, 1, "x", 2) for k, (t, lang) in enumerate(docs)], "doc_id long, text string, lang string, k int, phrase string, n int").repartition(3)


def texts(seed, n=300):
    rng = random.Random(seed)
    words = ["a", "the", "of", "x", "y", "é", "Ünder", "\U0001f600", "nul\x00", "a\xa0b", "THE"] + [f"w{k}" for k in range(30)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    out = []
    for _ in range(n):
        text = "".join(rng.choice(words[:rng.choice([4, 11, 41])]) + rng.choice([" ", " ", " ", "\t ", ", ", ". ", "\n", "; \r\n"]) for _ in range(rng.randrange(0, 40)))
        out.append((text + passage if rng.random() < .3 else text, rng.choice(["en", "en", "de", None, "und", ""])))
    return out


@pytest.mark.parametrize("bits", [26, 10])
def test_brute_force(spark, bits):
    """Ties and repeats, NULL and empty texts and languages, a very long periodic text (a circle of unary nodes), a bitmap too small to keep anything out."""
    docs = texts(1) + [(r[1], r[2]) for r in EDGES if r[1] is None or len(r[1]) < 1000] + [("long " * 40_000, "en"), ("p q r s t " * 2000, "de"), ("p q r s t " * 2000, "fr"), (" . ; \n", "en")]
    ours = collocations.collocations(table(spark, docs), min_count=5, top=50, bitmap_bits=bits).collect()
    assert sorted(map(tuple, ours)) == brute(docs, 5, 50)


def test_empty_table(spark):
    assert collocations.collocations(table(spark, [])).collect() == []
    assert collocations.collocations(table(spark, [(None, None), ("", "en")])).collect() == []


def test_different_grams_with_one_hash(spark):
    """The counts of a block tell grams apart by their words where the hash does not."""
    tokens = np.array([1, 2, 3, 1, 2, 4, 1, 2, 3])
    at = np.array([0, 3, 6, 1, 4])
    found, n = collocations._counted(tokens, at, np.full(5, 7, np.uint64), 2)
    assert sorted((tuple(tokens[i:i + 2].tolist()), c) for i, c in zip(found, n)) == [((1, 2), 3), ((2, 3), 1), ((2, 4), 1)]


def test_paths_are_the_unary_paths(spark):
    """Compacted rows hold every edge once, with its count, and no unary node lies between two paths."""
    docs = texts(2) + [("one two three four five six seven eight nine ten " * 700, "fr")]
    grams = collocations.longest_grams(table(spark, docs), 4, 5)
    edges = {(r.lang, r.phrase): r.n for r in grams.filter("k = 4").collect()}
    rows = sorted(collocations.paths(grams).collect(), key=lambda r: (r.path, r.segment))
    seen = collections.Counter()
    for r in rows:
        assert len(r.counts) <= collocations.SEGMENT and len(r.words) == len(r.counts) + 3
        for i, n in enumerate(r.counts):
            seen[r.lang, " ".join(r.words[i:i + 4])] += n
    assert seen == edges
    ins, outs = (collections.Counter((lang, " ".join(p.split(" ")[cut])) for lang, p in edges) for cut in (slice(1, 4), slice(0, 3)))
    for r in rows:
        for i in range(1, len(r.counts)):  # what lies inside a path is unary
            node = (r.lang, " ".join(r.words[i:i + 3]))
            assert ins[node] == outs[node] == 1
    unary = sum(1 for node in ins if ins[node] == outs[node] == 1)
    whole = {(r.lang, r.path) for r in rows}
    inside = sum(len(r.counts) for r in rows) - len(whole)
    loops = sum(1 for lang, path in whole if any(r.path == path and r.lang == lang and r.segment == 0 and r.words[:3] == last.words[-3:]
                                                 and ins[lang, " ".join(r.words[:3])] == outs[lang, " ".join(r.words[:3])] == 1
                                                 for r in rows for last in [[x for x in rows if (x.lang, x.path) == (lang, path)][-1]]))
    assert inside == unary - loops  # a circle is cut at one unary node
