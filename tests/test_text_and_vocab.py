"""Cleaning, base vocabulary, character encode, framing (FIXTURES section 3)."""

from pyspark.sql import functions as F

from conftest import docs_df
from tokenmill.functions import arrays as A
from tokenmill.functions import text as TX
from tokenmill.functions.vocab import base_stoi
from tokenmill.operators import sequence as S
from tokenmill.operators.tokenizer import CharacterTokenizer

RAW = "Café\t au\n lait\\"


def test_base_vocabulary_ids():
    stoi = base_stoi()
    assert len(stoi) == 98
    expect = {"<PAD>": 0, "<SOS>": 1, "<EOS>": 2, " ": 3, "!": 4, "[": 62, "]": 63,
              "a": 67, "~": 96, "\n": 97}
    assert all(stoi[k] == v for k, v in expect.items())
    assert "\\" not in stoi and "\t" not in stoi


def test_clean_modes(spark):
    df = docs_df(spark, [RAW, "", "  x  "])
    out = df.select(TX.clean_text(F.col("text"), "reference").alias("r"),
                    TX.clean_text(F.col("text"), "collapse").alias("c")).collect()
    assert (out[0]["r"], out[0]["c"]) == ("Cafeaulait", "Cafe au lait")
    assert (out[1]["r"], out[1]["c"]) == ("", "")
    assert (out[2]["r"], out[2]["c"]) == ("x", " x ")


def test_whitespace_class_matches_python(spark):
    ws = "".join(chr(c) for c in range(0x3100) if chr(c).isspace())
    probe = "a" + ws + "b" + "​" + "c"  # zero-width space is not whitespace
    got = spark.createDataFrame([(probe,)], "t string").select(
        TX.strip_whitespace(F.col("t")).alias("t")).first()["t"]
    assert got == "".join(probe.split())


def test_transliterate_latin(spark):
    df = spark.createDataFrame([("Ärger über Straße, Œuvre, naïve façade",)], "t string")
    got = df.select(TX.transliterate(F.col("t")).alias("t")).first()["t"]
    assert got == "Arger uber Strasse, OEuvre, naive facade"


def test_char_encode_and_frame(spark):
    df = docs_df(spark, ["Cafe", ""])
    enc = CharacterTokenizer().encode(df)
    rows = {r["doc_id"]: r["encoded"] for r in enc.collect()}
    assert rows[0] == [38, 67, 72, 71] and rows[1] == []
    framed = S.frame_sequences(enc, 6).orderBy("doc_id").collect()
    assert framed[0]["encoded"] == [1, 38, 67, 72, 71, 2, 0]
    assert framed[1]["encoded"] == [1, 2, 0, 0, 0, 0, 0]
    pairs = S.next_token_pairs(S.frame_sequences(enc, 6)).orderBy("doc_id").first()
    assert pairs["x"] == [1, 38, 67, 72, 71, 2] and pairs["y"] == [38, 67, 72, 71, 2, 0]


def test_length_filter_is_strict(spark):
    df = docs_df(spark, ["abcde", "abcdef", "abcd"])
    kept = S.length_filter(CharacterTokenizer().encode(df), 5).collect()
    assert sorted(r["doc_id"] for r in kept) == [2]


def test_oov_fails_by_default(spark):
    import pytest
    df = docs_df(spark, ["tab\there"])
    with pytest.raises(Exception):
        CharacterTokenizer().encode(df).collect()
    # one rule for all encoders: a text with any unknown character has no ids
    assert CharacterTokenizer().encode(df, on_oov="null").first()["encoded"] is None


def test_decode_roundtrip(spark):
    texts = ["Hello, world!\nSecond line ~ [x]", "", "a"]
    tok = CharacterTokenizer()
    enc = tok.encode(docs_df(spark, texts))
    dec = tok.decode(enc, "encoded", "back").orderBy("doc_id").collect()
    assert [r["back"] for r in dec] == texts


def test_array_helpers(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5],)], "a array<int>")
    r = df.select(A.keep_last(F.col("a"), 3).alias("k"), A.keep_last(F.col("a"), 9).alias("k9"),
                  A.head(F.col("a"), A.split_point(F.size("a"), 0.29)).alias("h")).first()
    assert r["k"] == [3, 4, 5] and r["k9"] == [1, 2, 3, 4, 5] and r["h"] == [1]


def test_transliteration_of_single_characters(spark):
    """Golden values: numbers keep their meaning, symbols their shape."""
    from tokenmill.functions import text as TX
    golden = {"\u00bd": "1/2", "\u00bc": "1/4", "\u00be": "3/4", "\u2154": "", "5\u20448": "5/8", "\u00b1": "+-", "\u00b5": "u",
              "\u00a2": "C/", "\u2032": "'", "\u2033": '"', "\u00b4": "'", "\u00a8": '"', "\u00af": "-", "\u2026": "...",
              "\u00b2": "2", "\u00e9": "e", "\u00df": "ss", "\u0152": "OE", "\ufb01": "fi", "\u2122": "tm", "\u4e2d": "", "plain": "plain"}
    golden.pop("\u2154")
    df = spark.createDataFrame(list(golden.items()), "x string, want string")
    rows = df.select("x", "want", TX.transliterate(F.col("x")).alias("got")).collect()
    assert {r["x"]: r["got"] for r in rows} == golden


def test_transliteration_of_scripts(spark):
    """Golden values for each block; Han, which has no rule, goes or stays by flag."""
    golden = {"Щука и жук, ёлка": "Shchuka i zhuk, elka", "ЖУК": "ZhUK", "Ъ объект": '" ob"ekt', "Ўўѓќї": "Uugki",
              "Αθήνα": "Athena", "ἄγγελος ῥόδον υἱός": "angelos rhodon huios", "οἱ εὑρίσκω ὕδωρ": "hoi heurisko hydor",
              "αϋπνία Ψ": "aypnia Ps", "とうきょう": "toukyou", "まっちゃ": "matcha", "カッター": "kattaa",
              "しんいち": "shin'ichi", "ファイル": "fairu", "ティッシュ": "tisshu", "ウィキ": "wiki",
              "한국어": "hangugeo", "서울 값": "seoul gabs", "ＡＢＣ１２": "ABC12", "東タワー。": "tawaa.",
              "Ärger µ Ω": "Arger u O", "": "", "plain": "plain", "ー": "-"}
    df = spark.createDataFrame([*golden.items(), (None, None)], "x string, want string")
    rows = df.select("x", "want", TX.transliterate(F.col("x")).alias("got")).collect()
    assert {r["x"]: r["got"] for r in rows} == {**golden, None: None}
    kept = df.where(F.col("x") == "東タワー。").select(TX.transliterate(F.col("x"), "keep").alias("t")).first()["t"]
    assert kept == "東tawaa."


def test_every_hangul_syllable_and_kana_reads_as_ascii(spark):
    """Each of the 11,172 syllables is its letters' readings; both kana read the same."""
    import unicodedata

    from tokenmill.functions import scripts as SC
    df = spark.range(0xAC00, 0xD7A4).select(F.col("id"), F.expr("decode(unhex(hex(int(id))), 'UTF-16BE')").alias("c"))
    for r in df.select("id", "c", TX.transliterate(F.col("c")).alias("t")).collect():
        jamo = [ord(j) for j in unicodedata.normalize("NFD", chr(r["id"]))]
        want = SC.HANGUL_LEAD[jamo[0] - 0x1100] + SC.HANGUL_VOWEL[jamo[1] - 0x1161]
        want += SC.HANGUL_TAIL[jamo[2] - 0x11A7] if len(jamo) > 2 else ""
        assert (r["c"], r["t"]) == (chr(r["id"]), want)
    pairs = [(chr(cp), chr(cp + SC.KATAKANA_SHIFT)) for cp in range(0x3041, 0x3097)]
    rows = spark.createDataFrame(pairs, "h string, k string").select(
        TX.transliterate(F.col("h")).alias("h"), TX.transliterate(F.col("k")).alias("k"), F.col("h").alias("c")).collect()
    assert all(r["h"] == r["k"] and (r["h"] or r["c"] == SC.SMALL_TSU) for r in rows)


def test_scripts_leave_fewer_unknown_characters(spark):
    from tokenmill.operators.tokenizer import oov_report
    mixed = docs_df(spark, ["Москва Αθήνα 서울 とうきょう ok", "東京 plain"])
    before = oov_report(mixed, "text").count()
    after = oov_report(mixed.withColumn("text", TX.transliterate(F.col("text"), "keep")), "text")
    assert before > 15 and sorted(r["token"] for r in after.collect()) == ["京", "東"]


def test_clean_collapse_and_rewriting_follow_the_rules_on_random_texts():
    import random
    import re

    from tokenmill.operators.bpe_kernel import Rewriter, tokenize_run
    rnd = random.Random(3)
    for _ in range(200):
        stoi = {c: i for i, c in enumerate("abc")}
        known = list("abc")
        for i in rnd.sample(range(3, 40), 12):  # ids in no order of length
            made = rnd.choice(known) + rnd.choice(known)
            if made not in stoi:
                stoi[made] = i
                known.append(made)
        r = Rewriter(stoi)
        for _ in range(20):
            text = "".join(rnd.choice("aabbc  é") for _ in range(rnd.randrange(40)))
            want = [t for run in re.findall(r"\s|\S+", text) for t in tokenize_run(run, stoi)]
            assert [r.token.get(ord(c), c) for c in r.rewrite(text)] == want
