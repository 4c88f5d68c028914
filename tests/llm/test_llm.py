"""The training-data operators against brute force, on small fixtures and the smallest tables."""

import collections
import hashlib
import importlib.util
import math
import random
import re
import struct
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash

from chatmill.llm import bpe, chat_format, decontaminate, exact_dedup, langid, line_dedup, lm, oracle, queries, simhash, token_files, toxicity
from tests.conftest import SF0001

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: NULLs, empty and blank texts, ties, repeated rows, a repeated id
EDGES = [(1, "Same text here for all of us.", "en", "a", 1), (2, "same TEXT here for all of us.", "en", "a", 1), (2, "same TEXT here for all of us.", "en", "a", 1),
         (3, None, None, None, None), (4, "", "en", "b", 0), (5, " \n\t ", "en", "b", 3), (None, "a row without an id", "en", "b", 1),
         (6, "Été ÉTÉ \U0001f600", "fr", "b", 1), (7, "long " * 40_000, "en", "b", 1), (1, "another text under the same id", "de", "b", 1)]


@pytest.fixture(scope="module")
def edges(spark, tmp_path_factory):
    """The edge rows as a table, with columns whose names the operators use themselves."""
    path = str(tmp_path_factory.mktemp("edges") / "documents.parquet")
    spark.createDataFrame([(*r, 0, "x", "y") for r in EDGES], DOCS + ", score int, ids string, _dropped string").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty") / "documents.parquet")
    spark.createDataFrame([], DOCS).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF0001}/documents.parquet")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.read.parquet(f"{SF0001}/benchmark.parquet")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    ours = queries.QUERIES[name](spark, SF0001)
    theirs = con.execute(oracle.SQL[name])
    names = [d[0] for d in theirs.description]
    assert sorted(names) == sorted(ours.columns)
    assert sorted(map(tuple, ours.select(*names).collect())) == sorted(theirs.fetchall())


def test_exact_dedup_edges(edges, empty):
    rows = exact_dedup.duplicates(edges).collect()
    assert len(rows) == len(EDGES)
    sizes = collections.Counter(low(r[1]) for r in EDGES)
    assert sorted(r.group_size for r in rows) == sorted(sizes[low(r[1])] for r in EDGES)
    assert sum(r.kept for r in rows) == len(sizes)
    assert {r.keep_id for r in rows if r.group_size == 3} == {2}
    kept = exact_dedup.drop_duplicates(edges)
    assert kept.columns == edges.columns and kept.count() == len(sizes)
    assert exact_dedup.duplicates(empty).count() == 0


def test_exact_dedup_survives_collisions(documents):
    """With primes this small, different texts get equal fingerprints."""
    found = {r.doc_id: tuple(r)[1:] for r in exact_dedup.duplicates(documents, primes=(3, 2)).drop("_row").collect()}
    assert found == {r.doc_id: tuple(r)[1:] for r in exact_dedup.duplicates(documents).drop("_row").collect()}


def test_polynomial_hashes_combine():
    data = bytes(range(256)) * 40
    whole = exact_dedup.Fingerprinter(chunk=1 << 14)(data)
    assert whole == exact_dedup.Fingerprinter(chunk=64)(data) == exact_dedup._fingerprint(data, exact_dedup.Fingerprinter(chunk=64), 1000)


def brute_fingerprint(text):
    w = low(text).encode().split()
    shingles = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_simhash(edges, empty, documents):
    for docs in (edges, documents):
        texts = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
        roots = {}
        for _, f in texts:
            reach, todo = {f}, [f]
            while todo:
                x = todo.pop()
                new = {g for _, g in texts if g not in reach and (x ^ g).bit_count() <= 3}
                reach |= new
                todo += new
            roots[f] = min((d for d, g in texts if g in reach and d is not None), default=None)
        rows = simhash.near_duplicates(docs).collect()
        assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == sorted((str(d), f"{f:016x}", str(roots[f])) for d, f in texts)
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("hot", [1, 8, 2048])
def test_gray_index_finds_every_component(spark, hot):
    rng = np.random.default_rng(5)
    codes = [int(x) for x in rng.integers(0, 1 << 63, 150)]
    for c in codes[:60]:  # families around some codes, one of them large
        codes += [c ^ sum(1 << int(b) for b in rng.integers(0, 64, 3)) for _ in range(60 if c == codes[0] else 2)]
    codes = sorted(set(codes))
    a = np.array(codes, np.uint64)
    x, y = np.nonzero(np.bitwise_count(a[:, None] ^ a[None]) <= 3)
    best = simhash._stars(len(a), x, y)
    links = simhash.links(spark.createDataFrame([(int(np.uint64(c).view(np.int64)),) for c in codes], "fp long"), 3, hot).collect()
    at = {int(np.uint64(c).view(np.int64)): i for i, c in enumerate(codes)}
    ours = simhash._stars(len(a), np.array([at[r.u] for r in links]), np.array([at[r.v] for r in links]))
    assert (ours == best).all()


@pytest.mark.parametrize("set_limit", [200_000, 0])
def test_decontamination(spark, edges, empty, documents, benchmark, set_limit):
    short = spark.createDataFrame([(900, "text HERE"), (901, None), (902, "..."), (903, "another text under the same id and more words to come here")], "item_id long, text string")
    for docs, items in ((documents, benchmark), (edges, short)):
        words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low(t))
        windows = collections.defaultdict(set)
        for r in items.collect():
            w = words(r.text)
            for i in range(max(0, len(w) - min(10, len(w)) + 1) if w else 0):
                windows[tuple(w[i:i + 10])].add(str(r.item_id))
        expected = []
        for r in docs.collect():
            w, hit, got = words(r.text), set(), set()
            for n in {len(k) for k in windows}:
                for i in range(len(w) - n + 1):
                    if found := windows.get(tuple(w[i:i + n])):
                        hit |= set(range(i, i + n))
                        got |= found
            expected.append((str(r.doc_id), len(w), len(hit), sorted(got), bool(hit)))
        rows = decontaminate.contamination(docs, items, set_limit=set_limit).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"], r.contaminated) for r in rows) == sorted(expected)
    assert decontaminate.contamination(empty, benchmark).count() == 0
    assert decontaminate.contamination(documents, benchmark.limit(0)).filter("contaminated").count() == 0


def test_bpe_equals_tiktoken(edges, empty, documents):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    real = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    for docs in (edges, documents):
        rows = bpe.decode(bpe.encode(docs, path, with_offsets=True), path).collect()
        assert len(rows) == docs.count()
        for r in rows:
            ids = real.encode_ordinary(r.text or "")
            assert r.ids == struct.pack(f"<{len(ids)}I", *ids) and r.decoded == (r.text or "").encode() and r.n_tokens == len(ids)
            data = (r.text or "").encode()
            assert all(0 <= s < e <= len(r.text) for s, e in zip(r.starts, r.ends)) and len(r.starts) == len(ids)
            assert not data or (r.starts[0] == 0 and r.ends[-1] == len(r.text))
    assert bpe.encode(empty, path).count() == 0


def test_bpe_on_odd_texts():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    real = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    own = bpe.codec(path)
    texts = ["it's  we'll\n\n x", "a b 　c", "école", "\x1c\x1f a", "  lead", "trail  ", "1234 5.6, (x)!!", "\U0001f600\U0001f468‍\U0001f469", "don't,stop;a:b"]
    for t, got in zip(texts, own.encode_many(texts)):
        assert list(np.frombuffer(got, "<u4")) == real.encode_ordinary(t)
        assert "".join(bpe.decode_stream(own, iter(np.frombuffer(got, "<u4").tolist()))) == t


def test_token_ids_are_those_of_the_library(spark, tmp_path):
    """Strings of special tokens inside texts included."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = ["a<|endoftext|> b", "<|endoftext|>", "x  <|endoftext|>  y <|endoftext|>z", "<|endoftext| >", "plain text", "<|endoftext|", "é<|endoftext|>\n\n<|endoftext|>\n"]
    out = str(tmp_path / "tokens")
    token_files.write_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, out)
    for r in token_files.read_tokens(spark, out, with_ids=True).collect():
        assert list(struct.unpack(f"<{r.n_tokens}I", r.ids)) == library.encode(texts[r.doc_id], add_special_tokens=False).ids + [0]


def test_words_of_a_batch_are_encoded_as_the_library_does(monkeypatch):
    """Each different word once; only texts whose white space the pattern joins over a space go another way."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), bpe.Codec(path)
    rng = random.Random(5)
    parts = [" "] * 8 + list("abé'.,;1½字\n\t\r\x85\xa0\u3000\x1c_") + ["word", "'s", "$$$", ".\nNext", "\n\n", "  "]
    for _ in range(60):
        texts = ["".join(rng.choices(parts, k=rng.randrange(16))) for _ in range(60)]
        for text, ids in zip(texts, own.encode_words(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert own.encode_words([]) == [] and own.encode_words(["", ""]) == [b"", b""]
    looked_up = []
    monkeypatch.setattr(own, "_ids_of", lambda pieces, of=own._ids_of: looked_up.append(len(pieces)) or of(pieces))
    assert own.encode_words(["same words, same words.\nsame again."] * 1000)[999] == own.encode_many(["same words, same words.\nsame again."])[0]
    assert len(looked_up) == 1 and looked_up[0] < 50


@pytest.mark.parametrize("text", ["½ ² Ⅷ", "12 34", "", " \n", "...", "٣٤", "🙂", "_"])
def test_a_text_without_a_letter_has_no_language(text):
    assert langid.counts(text) is None and not any(map(str.isalpha, text))
    assert langid.counts(text + " é") is not None


def test_token_files(spark, edges, empty, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    out = str(tmp_path / "tokens")
    token_files.write_tokens(edges, path, out, shard_ids=50)
    rows = token_files.read_tokens(spark, out, with_ids=True).collect()
    tokenizer = bpe.file_tokenizer(path)
    expected = [tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0] for r in EDGES]
    assert sorted(r.ids for r in rows) == sorted(struct.pack(f"<{len(i)}I", *i) for i in expected)
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at and r.ids_crc32 == zlib.crc32(r.ids)
        at += r.n_tokens
    ordered = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert ordered[0] is None and ordered[1:] == sorted(ordered[1:])
    for row in spark.read.parquet(out).collect():  # random access
        shard = token_files.Shard(row.asDict())
        ends = np.cumsum(shard.sizes)
        for k in range(len(shard.sizes)):
            assert (shard.document(k) == shard.all_ids()[ends[k] - shard.sizes[k]:ends[k]]).all()
    none = str(tmp_path / "none")
    token_files.write_tokens(empty, path, none)
    assert token_files.read_tokens(spark, none).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 1000, 50_000])
def test_repair_grammar(n):
    ids = np.random.default_rng(n).zipf(1.3, n).clip(max=99).astype(np.uint32)
    rules, lengths, sequence = token_files.compress(ids, 100)
    assert (token_files.expand(sequence, 100, rules) == ids).all()
    assert n < 1000 or len(sequence) < 0.8 * n
    assert all(len(token_files.expand(np.array([100 + i], np.uint32), 100, rules)) == k for i, k in enumerate(lengths[:50]))


def pairs_apart(sequence):
    """How often each pair occurs without overlap."""
    counts, last = collections.Counter(), {}
    for i, p in enumerate(zip(sequence, sequence[1:])):
        if last.get(p, -2) < i - 1:
            counts[p] += 1
            last[p] = i
    return counts


@pytest.mark.parametrize("name", ["run", "repeats", "few", "twice", "many"])
def test_repair_leaves_no_pair_twice(name):
    rng = np.random.default_rng(3)
    ids = {"run": np.zeros(1000), "repeats": np.tile(rng.integers(0, 90, 700), 40), "few": rng.integers(0, 3, 5000),
           "twice": np.tile(rng.permutation(3000), 2), "many": rng.zipf(1.2, 60_000).clip(max=2999)}[name].astype(np.uint32)
    rules, lengths, sequence = token_files.compress(ids, 3000)
    assert max(pairs_apart(sequence.tolist()).values(), default=0) < 2
    assert (token_files.expand(sequence, 3000, rules, lengths) == ids).all() and (token_files.expand(sequence, 3000, rules) == ids).all()
    assert len(set(map(tuple, rules.tolist()))) == len(rules)
    uses = np.bincount(np.r_[rules.ravel(), sequence], minlength=3000 + len(rules))[3000:]
    assert (uses >= 1).all()
    if name in ("run", "repeats", "twice"):
        assert lengths.max() > 64 and len(sequence) < 20


def test_chat_round_trip(spark):
    texts = ["plain", "</s>[INST] ok [/INST]", "[\\INST] <\\\\s>", "<s>", "[", "", None, "[ROLE]x[:]y[/ROLE]", "</s", "[/SYS", "\\[INST]"]
    roles = ["user", "assistant", "system", "tool", "[:]", None, "assistant"]
    rows = [(c, i, roles[(c + i) % len(roles)], texts[(c * 3 + i) % len(texts)]) for c in range(8) for i in range(9)] + [(None, None, "user", "x"), (7, 3, "user", "tie")]
    out = chat_format.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = out.select("conv_id", "n_turns", chat_format.parse(out.formatted).alias("turns"), chat_format.loss_text(out.formatted, out.loss_spans).alias("loss")).collect()
    assert len(got) == 9
    for r in got:
        own = sorted(((t if t is not None else -1), ro or "", tx or "") for c, t, ro, tx in rows if c == r.conv_id)
        assert [(t.role, t.text) for t in r.turns] == [(ro, tx) for _, ro, tx in own] and r.n_turns == len(own)
        assert r.loss == "".join(tx for _, ro, tx in own if ro == "assistant")
    assert chat_format.format_turns(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_language_id(spark, edges, empty):
    rows = queries.op3_language_id(spark, SF0001).collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(langs) and sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)
    unseen = langid.fit(empty.selectExpr("text", "lang", "doc_id AS pick"))
    assert {r.lang_pred for r in langid.identify(edges, unseen).collect()} == {"und"}
    model = langid.fit(edges.selectExpr("text", "lang", "0L AS pick"))
    found = [(r.doc_id, r.lang_pred, r.score) for r in langid.identify(edges, model).collect()]
    assert len(found) == len(EDGES) and all((lang == "und") == (i in (3, 4, 5)) and 0 <= s <= 1 for i, lang, s in found)


def test_toxicity(spark, edges, empty):
    sf = "/root/testdata/sf0.1"
    rows = queries.op4_toxicity(spark, sf).collect()
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(toxic[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in toxic]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    model = toxicity.fit(toxicity.labelled(empty, spark.createDataFrame([], "doc_id long, toxic int")))
    scored = toxicity.with_score(edges, model).collect()
    assert len(scored) == len(EDGES) and all(0 <= r.score <= 1 for r in scored)
    assert toxicity.drop_toxic(edges, model).columns == edges.columns


def test_counterfactual_penalty_frees_identity_terms():
    """Toxic sentences name one group, clean ones seldom do; the penalty takes the name's weight away."""
    insult, name, other, filler = 0, 1, 2, 3
    x = [np.array(r, np.int32) for r in [[insult, name]] * 40 + [[filler]] * 36 + [[name, filler]] * 2 + [[other, filler]] * 2]
    y = np.array([1.0] * 40 + [0.0] * 40)
    pairs = ([np.array([name], np.int32)] * 10, [np.array([other], np.int32)] * 10)
    free, _ = toxicity.train(x, y, 4, ([], []), 5.0, 1e-3, 400)
    held, bias = toxicity.train(x, y, 4, pairs, 5.0, 1e-3, 400)
    assert free[name] - free[other] > 1 and abs(held[name] - held[other]) < 0.5
    assert bias + held[name] + held[filler] < 0 < bias + held[insult] + held[name]
    assert toxicity.swapped({"the", "women"}, toxicity.IDENTITY)[0] != {"the", "women"} and toxicity.swapped({"the"}, toxicity.IDENTITY) == []


def test_lm_counts_and_order(spark, edges, empty, documents):
    for docs in (edges, documents):
        tokens = [(r.doc_id, low(r.text).encode().split() + [b"\n"]) for r in docs.select("doc_id", "text").collect()]
        test = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
        c = collections.Counter(w for d, t in tokens if not test(d) for w in t)
        n, v = sum(c.values()), len(c)
        expected = sorted((str(d), test(d), len(t), sum(w in c for w in t), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 4)) for d, t in tokens)
        rows = lm.score(docs).collect()
        assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows) == expected
        assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert lm.score(empty).count() == 0


def test_lm_scores_are_plausible(spark, tmp_path):
    """No text is likelier than its beginning by more than the end's share, unseen words least."""
    words = "a b c d e".split()
    rng = np.random.default_rng(1)
    train = [(i, " ".join(rng.choice(words, 8))) for i in range(60)]
    train = [(i, t) for i, t in train if zlib.crc32(str(i).encode()) % 7 != 2]
    probes = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 7 == 2][:8]
    texts = ["a", *(f"a {w}" for w in words), "a unseen", "zzz"]
    spark.createDataFrame(train + list(zip(probes, texts)), "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    s = {r.doc_id: 10 ** r.score for r in lm.score(spark.read.parquet(str(tmp_path / "t"))).collect()}
    assert 0 < s[probes[0]] < 1 and all(0 < s[p] < s[probes[0]] * 10 for p in probes[1:6]) and s[probes[6]] < min(s[p] for p in probes[1:6])


def test_results_do_not_depend_on_splits(spark, documents, benchmark, tmp_path):
    """The cores of a cluster, and with them the splits, may change between two passes over a table."""
    path = str(tmp_path / "documents.parquet")
    documents.repartition(12).write.parquet(path)
    name = "spark.sql.files.maxPartitionBytes"
    kept = {"exact": lambda d: exact_dedup.drop_duplicates(d), "simhash": lambda d: simhash.drop_near_duplicates(d),
            "leaks": lambda d: decontaminate.drop_contaminated(d, benchmark), "lines": lambda d: line_dedup.drop_lines(d),
            "report": lambda d: line_dedup.line_report(d).select("doc_id", "n_lines", "dropped"), "lm": lm.score}
    for key, run in kept.items():
        found = []
        for later in (1 << 27, 100_000):
            spark.conf.set(name, 1 << 27)
            spark.conf.set("spark.sql.files.minPartitionNum", 1)
            try:
                df = run(spark.read.parquet(path))
                spark.conf.set(name, later)
                found.append(sorted(str((r.doc_id, *(round(x, 6) if isinstance(x, float) else x for x in r))) for r in df.collect()))
            finally:
                spark.conf.unset(name)
                spark.conf.unset("spark.sql.files.minPartitionNum")
        assert found[0] == found[1], key


def test_lm_totals_beyond_32_bits():
    """Three blocks, one of them in two pieces; one word occurs 9e9 times."""
    names = ("range", "block", "kind", "gram", "keys", "counts")
    rows = [(0, 1, lm.TRAIN, 0, [5, 9], [3_000_000_000, 1]), (0, 2, lm.TUNE, 0, [5], [3_000_000_000]), (0, 3, lm.TEST, 0, [7, 9], [1, 1]),
            (0, 1, lm.TRAIN, 0, [5, 7], [3_000_000_000, 2])]
    table = pa.Table.from_pylist([dict(zip(names, (*r[:4], np.array(r[4], "<u8").tobytes(), np.array(r[5], "<u4").tobytes()))) for r in rows])
    out = lm._totals(table).to_pylist()
    totals = {r["block"]: np.frombuffer(r["totals"], "<u8").tolist() for r in out if r["block"]}
    assert totals == {1: [9_000_000_000, 2, 1], 2: [9_000_000_000], 3: [2, 1]}
    assert np.frombuffer(next(r for r in out if r["block"] == 2)["train_totals"], "<u8").tolist() == [6_000_000_000]
    assert out[-1]["tokens"] == 9_000_000_003 and out[-1]["train_tokens"] == 6_000_000_003 and out[-1]["types"] == 3


def test_lm_weights_by_em():
    """Held-out tokens that pairs explain get weight on pairs, others on words."""
    w = lm.learn_weights([(5, 1 + 4, 1 + 40, 900), (5, 0, 1 + 40, 100), (2, 0, 1 + 8, 1000)], 1e-6)
    assert w[5, 0] > 0.8 and w[2, 1] > 0.9 and np.allclose(w.sum(axis=1), 1) and w[0, 0] == 0


def test_line_dedup(edges, empty, documents):
    for options in ({}, {"hot": 1, "block": 3}):
        lines = [(r.doc_id, i, s) for r in sorted(documents.select("doc_id", "text").collect()) for i, s in line_dedup.lines_of(r.text)]
        different = sorted({s for *_, s in lines}, key=len)
        root = list(range(len(different)))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for i, a in enumerate(different):
            for j in range(i + 1, len(different)):
                b = different[j]
                if len(b) > len(a) + 2:
                    break
                if len(a) >= 20 and line_dedup.within(a, b, 2):
                    root[find(i)] = find(j)
        first, dropped, at = {}, collections.defaultdict(list), {s: i for i, s in enumerate(different)}
        for doc, i, s in lines:
            if find(at[s]) in first:
                dropped[doc].append(i)
            first.setdefault(find(at[s]), doc)
        assert {r.doc_id: r.dropped for r in line_dedup.line_report(documents, **options).collect()} == {r.doc_id: dropped[r.doc_id] for r in documents.collect()}
    assert line_dedup.line_report(edges).count() == len(EDGES) and line_dedup.drop_lines(edges).columns == edges.columns
    assert line_dedup.line_report(empty).count() == 0


def test_banded_distance_and_segments():
    rng = np.random.default_rng(2)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    for _ in range(1500):
        a = "".join(rng.choice(list("abc"), rng.integers(0, 90)))
        b = list(a)
        for _ in range(rng.integers(0, 6)):
            i = int(rng.integers(0, len(b) + 1))
            b[i:i + int(rng.integers(0, 2))] = list("abc"[rng.integers(0, 3)] * int(rng.integers(0, 2)))
        b, k = "".join(b), int(rng.integers(1, 4))
        assert line_dedup.within(a, b, k) == (distance(a, b) <= k)
        if distance(a, b) <= k and min(len(a), len(b)) > 3:
            s, t = sorted((a, b), key=len)
            assert {(i, s[x:x + n]) for i, (x, n) in enumerate(line_dedup.segments(len(s), k + 1))} & {
                (i, t[x:x + n]) for i, x, n in line_dedup.substrings(len(s), len(t), k)}


@pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="no pipeline")
def test_pipeline(spark, documents, benchmark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "decontaminate", "byte_bpe"]
    model = toxicity.fit(toxicity.labelled(documents, spark.read.parquet(f"{SF0001}/labels.parquet")))
    texts = {r.doc_id: r.text for r in documents.collect()}
    left = {d for d, t in texts.items() if model.score(toxicity.words_of(t)) < 0.3}
    last = {}
    for d in sorted(left):
        last[low(texts[d])] = d
    left, kept = set(last.values()), []
    prints = {d: brute_fingerprint(texts[d]) for d in left}
    for d in sorted(left):
        reach, todo = {d}, [d]
        while todo:
            x = todo.pop()
            new = {e for e in left - reach if (prints[x] ^ prints[e]).bit_count() <= 3}
            reach |= new
            todo += new
        if d == min(reach):
            kept.append(d)
    leaks = {r.doc_id for r in decontaminate.contamination(documents, benchmark).filter("contaminated").collect()}
    rows = corpus_pipeline.run(spark, SF0001).collect()
    assert sorted(r.doc_id for r in rows) == [d for d in kept if d not in leaks]
    for r in rows:
        assert hashlib.sha256(r.decoded).digest() == hashlib.sha256(texts[r.doc_id].encode()).digest() and r.text == texts[r.doc_id]
