"""BPE fit and encode against the worked examples, plus kernel properties."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import docs_df
from tokenmill.operators.bpe import BPETokenizer, escape_replacement
from tokenmill.operators.bpe_kernel import tokenize_run, tokenize_text

FIXTURES = {
    "B1": (["low low lower", "newest newest widest low"], 6,
           [("l", "o", 4), ("lo", "w", 4), ("e", "s", 3), ("es", "t", 3), ("n", "e", 2), ("ne", "w", 2)]),
    "B2": (["aaaa aaa"], 4, [("a", "a", 5), ("aa", "aa", 1), ("aa", "a", 1)]),
    "B3": (["ab ab ab xab xab", "xabc zbc"], 4,
           [("a", "b", 6), ("x", "ab", 3), ("xab", "c", 1), ("z", "b", 1)]),
    "B4": (["a.b a.b a.b c"], 3, [("a", ".", 3), ("a\\.", "b", 3)]),
    "B5": (["<PAD> <PAD>"], 6, [("<", "P", 2), ("<P", "A", 2), ("<PA", "D", 2), ("<PAD", ">", 2)]),
    "B6": (["bc bcca cc cc baa cca bc"], 10,
           [("c", "c", 4), ("b", "c", 2), ("bcc", "a", 1), ("b", "a", 1), ("ba", "a", 1), ("cc", "a", 1)]),
}


@pytest.fixture(scope="module")
def fitted(spark):
    out = {}
    for name, (texts, n, _) in FIXTURES.items():
        out[name] = BPETokenizer(n).fit(docs_df(spark, texts))
    return out


@pytest.mark.parametrize("name", list(FIXTURES))
def test_fit_matches_worked_examples(fitted, name):
    expect = FIXTURES[name][2]
    got = [(l, r, c) for _, l, r, c, _ in fitted[name].merges]
    assert got == expect
    assert [m[4] for m in fitted[name].merges] == list(range(98, 98 + len(expect)))


def test_special_overwrite(fitted):
    tok = fitted["B5"]
    assert tok.stoi["<PAD>"] == 101 and tok.itos[0] == "<PAD>"
    assert len(tok) == 98 + 4 - 1  # stoi lost one key to the overwrite


@pytest.mark.parametrize("name,text,ids", [
    ("B1", "low lower", [99, 3, 99, 71, 84]),
    ("B1", "newest", [103, 101]),
    ("B1", "slow", [85, 99]),
    ("B1", "", []),
    ("B4", "a.b", [98, 68]),
    ("B5", "<PAD>", [101]),
    ("B6", "aabccac", [67, 67, 100, 69]),
])
def test_encode_worked_examples(spark, fitted, name, text, ids):
    tok = fitted[name]
    for strategy in ("narrow", "distinct"):
        enc = tok.encode(docs_df(spark, [text]), strategy=strategy).first()["encoded"]
        assert enc == ids, strategy
    assert tok.encode_by_join(docs_df(spark, [text])).first()["encoded"] == ids


def test_escape_rule():
    assert escape_replacement("a.") == "a\\."
    assert escape_replacement("a\\.b") == "a\\\\.b"
    assert escape_replacement("e,") == "e,"


def _naive(word, stoi):
    """The rule as stated: lowest-id adjacent concatenation, merge left to
    right without overlap, repeat."""
    word = list(word)
    while True:
        pairs = [(word[i] + word[i + 1], stoi[word[i] + word[i + 1]])
                 for i in range(len(word) - 1) if word[i] + word[i + 1] in stoi]
        if not pairs:
            return word
        target = min(pairs, key=lambda p: p[1])[0]
        i = 0
        while i < len(word) - 1:
            if word[i] + word[i + 1] == target:
                word[i] = target
                del word[i + 1]
            i += 1


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abc", min_size=0, max_size=30),
       st.lists(st.text(alphabet="abc", min_size=2, max_size=4), min_size=0, max_size=12),
       st.randoms())
def test_kernel_equals_naive_rule(text, tokens, rnd):
    stoi = {c: i for i, c in enumerate("abc")}
    ids = list(range(10, 10 + len(tokens)))
    rnd.shuffle(ids)
    for t, i in zip(tokens, ids):
        stoi[t] = i
    assert tokenize_run(text, stoi) == _naive(text, stoi)


def test_runs_are_independent():
    rnd = random.Random(7)
    stoi = {c: i for i, c in enumerate("ab ")}
    for i, t in enumerate(["ab", "ba", "aab", "bb", "abab"]):
        stoi[t] = 10 + i
    for _ in range(300):
        text = "".join(rnd.choice("ab ") for _ in range(rnd.randint(0, 25)))
        assert tokenize_text(text, stoi) == _naive(text, stoi)


def _literal_fit(texts, n):
    """The rule one step at a time: count, arg-max with ties to first insertion, replace."""
    vocab = {}
    for t in texts:
        for w in t.split():
            vocab[" ".join(w)] = vocab.get(" ".join(w), 0) + 1
    merges = []
    while len(merges) < n:
        stats = {}
        for sym, freq in vocab.items():
            parts = sym.split(" ")
            for pair in zip(parts, parts[1:]):
                stats[pair] = stats.get(pair, 0) + freq
        if not stats:
            break
        best = max(stats, key=stats.get)
        merges.append((*best, stats[best]))
        vocab = {k.replace(" ".join(best), escape_replacement("".join(best))): f for k, f in vocab.items()}
    return merges


def test_fit_equals_literal_rule_on_random_corpora(spark):
    rnd = random.Random(3)
    for _ in range(3):
        texts = [" ".join("".join(rnd.choice("ab.c") for _ in range(rnd.randint(1, 6)))
                          for _ in range(rnd.randint(1, 8))) for _ in range(4)]
        tok = BPETokenizer(12).fit(docs_df(spark, texts))
        assert [(l, r, c) for _, l, r, c, _ in tok.merges] == _literal_fit(texts, 12), texts


def test_reserved_special_is_refused_and_the_fit_goes_on(spark):
    texts = ["<PAD> <PAD> xy"]
    free = BPETokenizer(6).fit(docs_df(spark, texts))
    kept = BPETokenizer(6, reserve_special=True).fit(docs_df(spark, texts))
    assert free.stoi["<PAD>"] != 0 and kept.stoi["<PAD>"] == 0
    assert [m[1] + m[2] for m in kept.merges] == ["<P", "<PA", "<PAD", "xy"]


def test_one_oov_rule_for_all_encoders(spark):
    tok = BPETokenizer(2).fit(docs_df(spark, ["ab ab abc"]))
    df = spark.createDataFrame([(0, "ab \u00e9"), (1, None), (2, ""), (3, "abc  ab"), (4, "\u00e9")], "doc_id long, text string")
    for encode in (lambda d: tok.encode(d, on_oov="null"), lambda d: tok.encode(d, on_oov="null", strategy="distinct"),
                   lambda d: tok.encode_by_join(d, on_oov="null")):
        got = {r["doc_id"]: r["encoded"] for r in encode(df).collect()}
        assert got == {0: None, 1: None, 2: [], 3: [99, 3, 3, 98], 4: None}
    for encode in (lambda d: tok.encode(d), lambda d: tok.encode(d, strategy="distinct"), lambda d: tok.encode_by_join(d)):
        with pytest.raises(Exception, match="not in vocabulary"):
            encode(df).collect()


def test_join_encoders_run_the_tokenizer_once(spark):
    tok = BPETokenizer(2).fit(docs_df(spark, ["ab ab abc"]))
    df = docs_df(spark, ["ab abc", "ab"])
    for out in (tok.encode_by_join(df), tok.decode_by_join(tok.encode(df).drop("text"), "encoded", "text")):
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("ArrowEvalPython") == 1, plan


def test_memo_is_bounded_by_characters():
    from tokenmill.operators.bpe_kernel import MEMO_RUN, RunEncoder
    stoi = {c: i for i, c in enumerate("ab")}
    enc = RunEncoder(stoi, memo_chars=100)
    for k in range(200):
        assert enc.encode("ab" * (k % 20 + 1)) == [0, 1] * (k % 20 + 1)
        assert sum(map(len, enc.memo)) <= 100
    enc.encode("a" * (MEMO_RUN + 1))
    assert all(len(r) <= MEMO_RUN for r in enc.memo)


def _prose(spark, folder):
    rnd = random.Random(9)
    stems = ["the", "there", "other", "in", "inner", "winter", "on", "onion", "error", "terra", "an", "banana", "tension", "ration"]
    texts = [" ".join(rnd.choice(stems) + rnd.choice(["", "s", "er", "ing", "ation"]) for _ in range(200)) for _ in range(20)]
    docs_df(spark, texts).write.mode("overwrite").parquet(folder)
    return texts, spark.read.parquet(folder)


def test_rounds_are_fewer_than_merges_and_scans_fewer_than_rounds(spark, tmp_path):
    texts, df = _prose(spark, str(tmp_path / "docs"))
    tok = BPETokenizer(24).fit(df)
    assert [(l, r, c) for _, l, r, c, _ in tok.merges] == _literal_fit(texts, 24)
    assert tok.rounds <= 18 and tok.scans < 24 / 3


def test_more_ties_than_the_driver_keeps(spark, monkeypatch):
    from tokenmill.operators import bpe
    monkeypatch.setattr(bpe, "KEEP", 3)
    monkeypatch.setattr(bpe, "MAX_ADJACENT", 4)
    texts = ["abcd efgh ijkl abxd", "mnop efxh ab ef"]
    assert [(l, r, c) for _, l, r, c, _ in BPETokenizer(6).fit(docs_df(spark, texts)).merges] == _literal_fit(texts, 6)


def test_a_stopped_fit_goes_on_after_its_last_published_round(spark, tmp_path, monkeypatch):
    from tokenmill.operators import bpe
    texts, df = _prose(spark, str(tmp_path / "docs"))
    want, state = _literal_fit(texts, 16), str(tmp_path / "state")
    merge, done = bpe.MergeRounds.merge, []

    def stops(self, left_over):
        if len(done) == 5:
            raise RuntimeError("driver lost")
        done.append(left_over)
        return merge(self, left_over)

    monkeypatch.setattr(bpe.MergeRounds, "merge", stops)
    with pytest.raises(RuntimeError):
        BPETokenizer(16, checkpoint_every=2).fit(df, state=state)
    seen = []
    monkeypatch.setattr(bpe.MergeRounds, "merge", lambda self, n: seen.append(n) or merge(self, n))
    tok = BPETokenizer(16, checkpoint_every=2).fit(df, state=state)
    assert [(l, r, c) for _, l, r, c, _ in tok.merges] == want
    assert seen[0] == done[4], "round 5 is the first that runs again"
    # a round cut off before its manifest is not seen; another input or parameter raises
    spark.range(1).write.parquet(f"{state}/round-000099/words")
    again = BPETokenizer(16, checkpoint_every=2).fit(df, state=state)
    assert again.merges == tok.merges
    with pytest.raises(ValueError, match="another input"):
        BPETokenizer(17, checkpoint_every=2).fit(df, state=state)
    docs_df(spark, texts[:5]).write.mode("append").parquet(str(tmp_path / "docs"))
    with pytest.raises(ValueError, match="another input"):
        BPETokenizer(16, checkpoint_every=2).fit(spark.read.parquet(str(tmp_path / "docs")), state=state)
