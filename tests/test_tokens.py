import re

from pyspark.sql import functions as F

from chatmill.operators.tokens import (IGNORE_INDEX, RegexTokenizer, TOKEN_RE, label_coverage, labeled_ids,
                                       pad_batches, token_statistics, tokenize_messages, tokenize_with,
                                       truncate_prompt)

M = "id long, messages array<struct<role:string,content:string>>"
CONV = [("system", "be nice"), ("user", "hello there friend"), ("assistant", "hi! 42 is the answer.")]


def test_labels_only_on_assistant_content_and_end_marker(spark):
    tok = RegexTokenizer()
    df = spark.createDataFrame([(1, CONV)], M)
    row = tokenize_messages(df, tok).collect()[0]
    ids, labels = row.input_ids, row.labels
    assert len(ids) == len(labels) == len(row.attention_mask) == row.full_length
    labelled = [i for i, l in zip(ids, labels) if l != IGNORE_INDEX]
    n_answer = len(re.findall(TOKEN_RE.replace(r"\x{b}", r"\x0b").replace(r"\x{c}", r"\x0c"), CONV[2][1]))
    assert len(labelled) == n_answer + 1 and labelled[-1] == tok.im_end_id
    assert all(l == IGNORE_INDEX or l == i for i, l in zip(ids, labels))


def test_truncated_assistant_keeps_what_remains(spark):
    df = spark.createDataFrame([(1, CONV)], M)
    full = tokenize_messages(df, max_length=10_000).collect()[0]
    cut = len(full.input_ids) - 4
    row = tokenize_messages(df, max_length=cut).collect()[0]
    assert len(row.input_ids) == cut and row.labels == full.labels[:cut]
    assert RegexTokenizer().im_end_id not in [i for i, l in zip(row.input_ids, row.labels) if l != -100]


def test_tokenize_with_python_callable_matches_regex_tokenizer_layout(spark):
    pat = re.compile(r"[A-Za-z]+|[0-9]|[\t\n\x0b\x0c\r ]+|[^A-Za-z0-9\t\n\x0b\x0c\r ]")
    encode = lambda s: [len(t) for t in pat.findall(s)]
    df = spark.createDataFrame([(1, CONV), (2, CONV[:2])], M)
    a = {r.id: (len(r.input_ids), r.labels.count(-100)) for r in tokenize_with(df, encode, 9001, 9002, keep=["id"]).collect()}
    b = {r.id: (len(r.input_ids), r.labels.count(-100)) for r in tokenize_messages(df).collect()}
    assert a == b


def test_statistics_single_example_has_zero_stdev(spark):
    df = spark.createDataFrame([(1, CONV)], M)
    st = token_statistics(tokenize_messages(df), 2048).collect()[0]
    assert st.total_examples == 1 and st.stdev_length == 0.0 and st.median_length == st.avg_length


def test_label_coverage_and_labeled_ids(spark):
    df = tokenize_messages(spark.createDataFrame([(1, CONV)], M))
    cov = label_coverage(df).collect()[0]
    assert cov.total_tokens == cov.labeled_tokens + cov.masked_tokens
    ids = df.select(labeled_ids()).collect()[0][0]
    assert len(ids) == cov.labeled_tokens


def test_pad_batches_multiple_of_eight(spark):
    rows = [(i, CONV[: 2 + i % 2]) for i in range(20)]
    tok = RegexTokenizer()
    out = pad_batches(tokenize_messages(spark.createDataFrame(rows, M), tok), ["id"], 8, tok.pad_id).collect()
    for r in out:
        assert len(r.input_ids) == r.padded_length and r.padded_length % 8 == 0
        assert len(r.labels) == len(r.attention_mask) == r.padded_length
    by_batch = {}
    for r in out:
        by_batch.setdefault(r.batch, set()).add(r.padded_length)
    assert all(len(v) == 1 for v in by_batch.values()) and sorted(by_batch) == [0, 1, 2]


def test_truncate_prompt(spark):
    df = spark.createDataFrame([(list(range(10)),)], "prompt_ids array<int>")
    r = truncate_prompt(df, limit=4).collect()[0]
    assert r.prompt_ids == [0, 1, 2, 3] and r.was_truncated


def test_turn_level_coverage_equals_array_form_with_a_hot_conversation(spark):
    from chatmill.operators.tokens import turn_label_coverage
    roles = ["system", "user", "assistant"]
    rows = [(0, i, roles[min(i, 1 + i % 2)], f"turn {i} says hello world " * (1 + i % 3)) for i in range(3000)]
    rows += [(c, i, roles[1 + i % 2], f"short {c} {i}") for c in range(1, 40) for i in range(4)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.total_tokens, r.labeled_tokens) for r in
           turn_label_coverage(turns, "conv_id", "turn", "role", "text", max_length=2048).collect()}
    msgs = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t")) \
        .select("conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content")))
                .alias("messages"))
    ref = {r.conv_id: (r.total_tokens, r.labeled_tokens) for r in
           label_coverage(tokenize_messages(msgs, max_length=2048)).collect()}
    assert got == ref and got[0][0] == 2048


def test_hf_tokenizer_file_through_arrow_batches(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers, trainers

    from chatmill.operators.tokens import hf_tokenizer_encoder
    tok = Tokenizer(models.BPE(unk_token="[UNK]"))
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    trainer = trainers.BpeTrainer(vocab_size=300, special_tokens=["[UNK]", "<|im_start|>", "<|im_end|>"],
                                  initial_alphabet=pre_tokenizers.ByteLevel.alphabet())
    tok.train_from_iterator([c for _, c in CONV] * 50, trainer)
    path = str(tmp_path / "tokenizer.json")
    tok.save(path)
    start, end = tok.token_to_id("<|im_start|>"), tok.token_to_id("<|im_end|>")
    df = spark.createDataFrame([(1, CONV), (2, CONV[1:])], M)
    out = {r.id: r for r in tokenize_with(df, im_start_id=start, im_end_id=end, keep=["id"],
                                          encode_batch=hf_tokenizer_encoder(path)).collect()}
    enc = lambda s: tok.encode(s, add_special_tokens=False).ids
    expected = []
    for role, content in CONV:
        expected += [start] + enc(role + "\n") + enc(content) + [end] + enc("\n")
    assert out[1].input_ids == expected
    labelled = [i for i, l in zip(out[1].input_ids, out[1].labels) if l != -100]
    assert labelled == enc(CONV[2][1]) + [end]
