"""Operators on documents: brute force, and nulls, empty and long texts, ties,
repeated rows, empty tables and extra columns with clashing names."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tests.llm.brute import WORD, near_components
from tokenmill.llm import exact_dedup, jaccard_join, language_id, mixing, sentencepiece, sharding, tables, toxicity

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, h long, id long, bucket long, "
          "score double, n long, src string, size long, label string, copies int")
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def frame(spark, rows):
    """(doc_id, text, lang, source) rows beside columns named like internal ones."""
    return spark.createDataFrame([(i, t, la, s, 0, 1, 2, 3, 0.5, 4, "x", 5, "y", 6) for i, t, la, s in rows], SCHEMA)


def words(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    tables.ready(spark)
    base = words(60, 1)
    rows = [(1, base, "en", "a"), (2, base, "en", "a"), (3, base + " tail", "en", None), (4, None, "en", "a"), (5, "", None, "b"),
            (6, " \t\n", "en", "b"), (7, "one two", "de", "c"), (8, "One TWO", "de", "c"), (None, base, "en", "a"),
            (None, "only null id", None, None), (9, "dup row here", "fr", "é"), (9, "dup row here", "fr", "é"),
            (10, words(30_000, 2), "en", "a"), (11, "x" * 50_000, "en", "b"), (12, "日本語 テキスト ▁ \U0001F600 \x00 end", None, "c"),
            (13, "a b c d e", "en", "a"), (14, "a b c d e", "en", "a"), (15, "123 !!! 456", "en", "d"),
            (16, base.upper(), "en", "a")]
    return frame(spark, rows), rows


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def test_exact_dedup(spark, odd, none):
    df, rows = odd
    got = Counter(tuple(r) for r in exact_dedup.dedup_report(df).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        left = True
        for i in ids:
            want[(i, keep, len(ids), left and i == keep, hashlib.sha256(t.encode()).hexdigest())] += 1
            left = left and i != keep
    assert got == want
    kept = exact_dedup.dedup(df)
    assert kept.columns == df.columns
    assert Counter(r.text or "" for r in kept.collect()) == Counter(groups.keys())
    assert exact_dedup.dedup_report(none).count() == 0 and exact_dedup.dedup(none).count() == 0


def test_extendible_directory_splits_and_doubles():
    rng = np.random.default_rng(0)
    hist = np.zeros(256, np.int64)
    np.add.at(hist, rng.integers(0, 256, 4000), 1)
    hist[7] += 1000  # cannot be split further than the histogram
    d = exact_dedup.build_directory(hist, 100)
    assert len(d.entries) == 1 << d.depth
    load = Counter()
    for cell, n in enumerate(hist):
        load[int(d.bucket(np.array([cell << 56], np.uint64).view(np.int64))[0])] += int(n)
    assert all(n <= 100 or d.local_depth[b] == 8 for b, n in load.items())
    assert set(load) == set(range(len(d.local_depth)))


def test_collision_chain_compares_bytes():
    chain = []
    assert not exact_dedup._join(chain, b"x", "s1", 3, 1, 1)
    assert not exact_dedup._join(chain, b"y", "s2", 9, 1, 1)
    assert exact_dedup._join(chain, b"x", "s1", 7, 2, 1) and exact_dedup._join(chain, b"x", "s1", None, 1, 1)
    assert chain == [[b"x", "s1", 7, 4, 1], [b"y", "s2", 9, 1, 1]]


def test_sharding(spark, odd, none):
    df, rows = odd
    out, path = sharding.shard(df, 3)
    got = out.collect()
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law) for r in got) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), "bytes") for i, t, *_ in rows)
    for k in range(3):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))
    assert all(0 <= r.shard < 3 and r.grown_shard is None for r in got)
    versions = [{r.vslot: r.shard for r in sharding.shard_map(spark, path, v).collect()} for v in (0, 1)]
    assert versions[0] != versions[1] and len(versions[1]) == sharding.N_SLOTS
    assert sharding.shard(none, 3)[0].count() == 0


def test_shard_sizes_near_equal_and_growth_moves_into_the_new_shard(spark):
    r = random.Random(4)
    load = {s: r.randint(1, 900) for s in range(0, 8192, 2)} | {1: 30_000}
    first = sharding.initial_map(24)
    edited = sharding.rebalance(first, load, 24)
    total = Counter()
    for s, n in load.items():
        total[edited[s]] += n
    assert max(total.values()) <= 1.001 * min(total.values())
    grown = sharding.grow(edited, load, 24)
    assert all(a == b or b == 24 for a, b in zip(edited, grown))
    size = sum(n for s, n in load.items() if grown[s] == 24)
    assert abs(size - sum(load.values()) / 25) <= 900
    docs = tables.read(spark, "/root/testdata/sf0.01", "documents")
    sums = Counter()
    for x in sharding.shard(docs)[0].collect():
        sums[x.shard] += x.size
    assert len(sums) == 24 and max(sums.values()) <= 1.01 * min(sums.values())


def test_mixing(spark, odd, none):
    df, rows = odd
    got = mixing.mix_report(df).collect()
    size = Counter()
    for _, t, _, s in rows:
        size[s] += len(WORD.findall(t or ""))
    order = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in size else [])
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(size.values()))
    while True:
        share = left / max(1e-300, sum(weight[s] for s in open_))
        over = [s for s in open_ if share * weight[s] > 3 * size[s]]
        if not over:
            target |= {s: share * weight[s] for s in open_}
            break
        for s in over:
            target[s] = 3.0 * size[s]
            left -= target[s]
            open_.discard(s)
    of = {(i, t): s for i, t, _, s in rows}
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    by = df.select("doc_id", "source").distinct().collect()
    source = {r.doc_id: r.source for r in by if r.doc_id is not None}
    for r in got:
        if r.doc_id is not None:
            s = source[r.doc_id]
            assert r.source_size == size[s] and r.target == pytest.approx(target[s])
            taken[s] += r.taken
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix_report(df).collect()), key=str)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    assert sum(len(WORD.findall(r.text or "")) for r in mixed.collect()) == sum(r.taken for r in got)
    assert mixing.mix_report(none).count() == 0 and mixing.mix(none).count() == 0
    assert of


def test_mix_comes_near_the_targets(spark):
    docs = tables.read(spark, "/root/testdata/sf0.01", "documents")
    got = mixing.mix_report(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    taken, target, largest = Counter(), {}, Counter()
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in target)


def test_near_duplicates(spark, odd, none):
    df, rows = odd
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(df).collect())
    want = near_components([(i, t) for i, t, *_ in rows])
    sizes = {i: n for i, (n, _) in want.items()}
    assert {k for k in got if k[0] is not None} == {(i, n, c) for i, (n, c) in want.items()}
    assert got[(9, sizes[9], 9)] == 2 and sum(n for k, n in got.items() if k[0] is None and k[2] is None) == 2
    kept = jaccard_join.keep_one(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} - {None} == {c for _, c in want.values()}
    assert jaccard_join.near_duplicates(none).count() == 0 and jaccard_join.keep_one(none).count() == 0


def test_near_duplicates_of_edited_copies(spark):
    """Groups whose members differ by edits around the threshold, of all sizes."""
    tables.ready(spark)
    r, rows = random.Random(8), []
    for g in range(60):
        n = r.choice([5, 6, 7, 8, 10, 12, 16, 20, 30, 64, 70, 130, 260])
        base = words(n, 100 + g).split()
        for _ in range(r.randint(2, 14)):
            w = list(base)
            for _ in range(r.randint(0, max(1, n // 30 + 1))):
                k = r.randrange(len(w))
                w[k:k + r.randint(0, 1)] = [words(1, r.random())]
            rows.append((len(rows) * 7 % 1009, " ".join(w)))
    rows = [(i * 1000 + k, t) for k, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join.near_duplicates(df).collect()}
    assert got == near_components(rows)


def test_allocation_needs_enough_units():
    k, cost = np.array([1, 3, 2]), np.array([5, 1, 9])
    assert jaccard_join.Signer.allocate(k, cost, 2, False).tolist() == [1, 1, 0]
    assert jaccard_join.Signer.allocate(k, cost, 2, True).tolist() == [0, 2, 0]
    assert jaccard_join.Signer.allocate(k, cost, 4, False) is None
    assert jaccard_join.Signer.allocate(k, cost, 5, True).tolist() == [1, 2, 2]


def test_a_set_too_short_of_segments_probes_under_another_seed(spark):
    class Short(jaccard_join.Signer):
        """Under seed 0 no set finds room."""

        def __init__(self, cost, seed):
            super().__init__(cost, seed)
            self.seed = seed

        def sign(self, s, probing):
            sig, flag, short = super().sign(s, probing)
            return (sig, flag, short) if self.seed else (sig, flag & False, probing)

    tables.ready(spark)
    rows = [(k, words(40, 5) + (" z" if k % 2 else "") + " y" * (k // 2)) for k in range(4)] + [(9, words(50, 6))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join.Join(df, signer=Short).report().collect()}
    assert got == near_components(rows) and len({c for _, c in got.values()}) == 2


def test_language_id(spark, odd, none):
    df, rows = odd
    got = language_id.predict(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
        t = next(t for i, t, *_ in rows if i == r.doc_id)
        if r.doc_id is not None and not any(c.isalpha() for c in t or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert language_id.predict(none).count() == 0 and language_id.keep_known(none).count() == 0
    assert language_id.keep_known(df).columns == df.columns
    unlabelled = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.predict(unlabelled).collect()} == {"und"}


def test_language_id_held_out_accuracy(spark):
    docs = tables.read(spark, "/root/testdata/sf0.01", "documents")
    got = language_id.predict(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97


def test_noise_of_the_cosine_rejects_no_short_text(spark):
    tables.ready(spark)
    docs = tables.read(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang", "source")
    r = random.Random(5)
    short = [" ".join(t.split()[at:at + n]) for (t,) in docs.where("length(text) > 300").orderBy("doc_id").limit(100).select("text").collect()
             for n in (1, 2) for at in (3, 30)]
    short += ["Avec.", "A.", "A.\nAll rights reserved.", "Quick fix", "iPhone 15 Pro", "x", "zq " * 500]
    short = [t for t in short if any(c.isalpha() for c in t)]
    scripts = [(0x3B1, 0x3C9), (0x430, 0x44F), (0x4E00, 0x8000)]
    strange = [" ".join("".join(chr(r.randint(*s)) for _ in range(r.randint(2, 9))) for _ in range(100)) for s in scripts for _ in range(60)]
    rows = [(10**6 + i, t, None, "s") for i, t in enumerate([*short, *strange])] + [(10**7, "12 !", None, "s")]
    both = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = {x.doc_id for x in language_id.keep_known(both).collect()}
    assert [t for i, t in enumerate(short) if 10**6 + i not in kept] == []
    assert sum(10**6 + len(short) + i in kept for i in range(len(strange))) <= 2 and 10**7 not in kept
    lost = [x.text for x in docs.collect() if x.doc_id not in kept and any(c.isalpha() for c in x.text)]
    assert lost == []


def test_language_vectors_bind_and_bundle():
    b = language_id.Bundler(64)
    a, p, e = (b.letter(ord(c)) for c in "ape")
    sp = b.letter(32)
    want = (np.roll(sp, 2) * np.roll(a, 1) * p + np.roll(a, 2) * np.roll(p, 1) * e + np.roll(p, 2) * np.roll(e, 1) * sp)
    assert np.array_equal(b.bundle("Ape"), want) and np.array_equal(b.bundle("..ape! "), want)
    assert np.array_equal(b.bundle("ape ape"), 2 * want + np.roll(e, 2) * np.roll(sp, 1) * a) and b.bundle("12") is None


def _viterbi(v, text):
    """Best score over the whole text, position by position, from a piece dictionary."""
    ids = {p: i for i, (p, k) in enumerate(zip(v.pieces, v.kinds)) if k in (1, 4)}
    text = ("▁" + text).replace(" ", "▁")
    best = [0.0] + [float("-inf")] * len(text)
    for i in range(len(text)):
        if text[i] not in ids:
            best[i + 1] = max(best[i + 1], best[i] + v.unknown_score)
        for j in range(i + 1, min(len(text), i + 16) + 1):
            if text[i:j] in ids:
                best[j] = max(best[j], best[i] + v.scores[ids[text[i:j]]])
    return best[-1]


def _score(v, ids):
    total, k = 0.0, 0
    while k < len(ids):
        if v.kinds[ids[k]] == sentencepiece.BYTE:
            lead = v.piece_bytes[ids[k]][0]
            k += 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            total += v.unknown_score
        else:
            total += v.scores[ids[k]]
            k += 1
    return total


def test_sentencepiece_is_the_best_path():
    v = sentencepiece.Vocabulary.load(MODEL)
    e = sentencepiece.Encoder(v)
    r = random.Random(3)
    texts = [words(40, 1), "a  b   c ", "  lead", "tail  ", "日本語 and é ▁x", "\x00\x01 \U0001F600\U0001F601", "no\nbreak\r\n\there", "x" * 300,
             "".join(r.choice("aet on é日\n\U0001F600") for _ in range(400)), *(words(30, k) for k in range(10))]
    for t, ids in zip(texts, e.encode(texts)):
        assert _score(v, ids.tolist()) == pytest.approx(_viterbi(v, t), rel=1e-12), t[:30]
        assert sentencepiece.decode_ids(ids, v.piece_bytes) == t.replace("▁", " ")
        alone = e.solve_one(("▁" + t).replace(" ", "▁").encode())
        assert _score(v, alone.tolist()) == _score(v, ids.tolist())


def test_sentencepiece_agrees_with_the_library(tmp_path):
    """The library, told that the file's model is a unigram model, finds the same pieces."""
    import sentencepiece as library

    with open(MODEL, "rb") as f:
        data = f.read()
    parts = []
    for k, value in sentencepiece._fields(data):
        if k == 2:
            at = value.index(b"\x18\x02")  # trainer_spec.model_type: BPE
            value = value[:at] + b"\x18\x01" + value[at + 2:]
        size, n = b"", len(value)
        while True:
            size += bytes([n & 127 | (128 if n > 127 else 0)])
            n >>= 7
            if not n:
                break
        parts.append(bytes([k << 3 | 2]) + size + value)
    (tmp_path / "unigram.model").write_bytes(b"".join(parts))
    sp = library.SentencePieceProcessor(model_file=str(tmp_path / "unigram.model"))
    v = sentencepiece.Vocabulary.load(MODEL)
    e = sentencepiece.Encoder(v)
    same = 0
    texts = [words(30, k) for k in range(20)] + ["The quick brown fox jumps over the lazy dog.", "Der Hund läuft über die Straße"]
    for t, ids in zip(texts, e.encode(texts)):
        theirs = sp.encode(t)
        assert _score(v, theirs) == pytest.approx(_score(v, ids.tolist()))
        same += theirs == ids.tolist()
    assert same >= len(texts) - 2  # equal scores may be cut differently


def test_sentencepiece_query(spark, odd, none):
    df, rows = odd
    got = sentencepiece.round_trip(df, MODEL).collect()
    assert Counter((r.doc_id, r.decoded) for r in got) == Counter((i, t if t is None else t.replace("▁", " ")) for i, t, *_ in rows)
    assert all(r.exact == (r.doc_id != 12) for r in got)
    assert all((r.ids is None) == (r.decoded is None) and (r.ids is None or len(r.ids) == r.n_ids) for r in got)
    assert [r.n_ids for r in got if r.doc_id in (4, 5)] == [None, 0]
    assert sentencepiece.round_trip(none, MODEL).count() == 0
    assert sentencepiece.encode(df, MODEL).where("doc_id = 5").first().n_ids == 0


def test_toxicity(spark, odd, none):
    df, rows = odd
    labels = spark.createDataFrame([(i, k, k) for i, k in ((1, 1), (2, 0), (3, 1), (7, 0), (13, None), (None, 1), (99, 1))],
                                   "doc_id long, toxic int, quality int")
    got = toxicity.score(df, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert toxicity.score(none, labels).count() == 0
    assert {r.score for r in toxicity.score(df, labels.where("toxic = 0")).collect()} == {0.0}
    assert {r.score for r in toxicity.score(df, labels.where("toxic > 5")).collect()} == {0.0}


def test_toxicity_finds_the_sentences(spark):
    tables.ready(spark)
    r, rows, labels = random.Random(5), [], []
    for k in range(300):
        s = [words(r.randint(4, 12), r.random()).capitalize() + "." for _ in range(r.randint(2, 6))]
        if k % 3 == 0:
            at = r.randrange(len(s))
            s[at] = s[at][:-1] + f" {r.choice(['grukk', 'blarg'])}{r.choice(['', 'en', 'ié'])}."
        rows.append((k, " ".join(s)))
        labels.append((k, int(k % 3 == 0)))
    got = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"),
                         spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [x for x in got if x.held_out]
    assert np.mean([x.predicted == int(x.doc_id % 3 == 0) for x in held]) > 0.95
    text = dict(rows)
    spans = [text[x.doc_id][s.begin:s.end] for x in got if x.doc_id % 3 == 0 for s in x.offending]
    assert len(spans) > 80 and np.mean(["grukk" in s or "blarg" in s for s in spans]) > 0.9


def test_noisy_or_by_hand():
    from tokenmill.llm.bytehash import text_runs
    import pyarrow as pa
    [(_, _, data, offs)] = text_runs(pa.array(["Ab cd. Ef!", None, "...", "xy"]))
    bag = toxicity.bags(data, offs)
    w = np.zeros(toxicity.NONE + 1, np.float32)
    w[bag.feature[0, 0]] = 2.0
    m = toxicity.Model(w, -1.0)
    z = m.sentences(bag)
    assert z.tolist() == [1.0, -1.0, -1.0]
    p = 1 / (1 + np.exp(-z))
    assert m.texts(bag, z) == pytest.approx([1 - (1 - p[0]) * (1 - p[1]), 0, 0, p[2]])
    assert [(int(a), int(b)) for a, b in zip(bag.begin, bag.end)] == [(0, 5), (7, 9), (0, 2)]


def test_rows_are_plain(odd):
    assert isinstance(odd[0].first(), Row)


def test_long_words_hash_by_every_place(spark):
    """No period in a word's hash: exchanged blocks of 4,096 bytes make other words."""
    a, b, c = "A" * 4096, "b" * 4096, "c" * 1000
    texts = [a + b, b + a, a + a + b + c, a + b + a + c, b + a + a + c, (a + b) * 2, (b + a) * 2, a + b]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(df).collect()}
    assert got == {i: (1, 0 if i == 7 else i) for i in range(8)}


def test_shards_stay_equal_when_ids_repeat(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK_ROWS", 100)
    same = [(7, "x" * 92)] * 1500
    texts = [(8, f"{k:092d}") for k in range(1500)]
    rows = same + texts + [(100 + k, f"{k:092d}") for k in range(1500)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"))[0].collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, 100, zlib.crc32(t.encode())) for i, t in rows)
    sums, slots = Counter(), defaultdict(set)
    for r in got:
        sums[r.shard] += r.size
        slots[r.shard].add(r.slot)
    assert len(sums) == 24 and max(sums.values()) - min(sums.values()) <= 200
    assert all(slots[s] == set(range(sums[s] // 100)) for s in slots)


def test_pairs_near_the_threshold_are_ruled_out_by_their_sketches(spark, monkeypatch):
    """A group of near copies that mostly do not link: few of its pairs are verified."""
    r = random.Random(5)
    base = [f"w{r.randrange(4000)}" for _ in range(110)]
    texts = []
    for _ in range(150):
        w = list(base)
        for _ in range(r.choice((2, 2, 3))):
            w[r.randrange(len(w))] = f"w{r.randrange(4000)}"
        texts.append(" ".join(w))
    pairs, store = [], jaccard_join.T.store

    def counted(df, name):
        out = store(df, name)
        if name == "rest-pairs":
            pairs.append(out.count())
        return out
    monkeypatch.setattr(jaccard_join.T, "store", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: x["component_id"] for x in jaccard_join.near_duplicates(df).collect()}
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    links = [(a, b) for a in range(150) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = list(range(150))
    for _ in range(150):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert got == dict(enumerate(root))
    assert sum(pairs) < 500, pairs
    x, y = (np.unique(np.random.default_rng(k).integers(0, 2 ** 63, 300).astype(np.uint64)) for k in (1, 2))
    apart = sum((int(a) ^ int(b) & (1 << 64) - 1).bit_count() for a, b in zip(jaccard_join.parities(x).view(np.uint64), jaccard_join.parities(y).view(np.uint64)))
    assert 0 < apart <= len(np.setxor1d(x, y))


def test_groups_of_links_meet_their_hub(spark, monkeypatch):
    """Near copies that nearly all link, but not with the first of them: pairs grow with the members, not with the links."""
    r = random.Random(8)
    base = [f"w{k}" for k in range(150)]
    texts = []
    for k in range(700):
        w = list(base)
        for at in r.sample(range(len(w)), 5 if k < 300 else r.choice((1, 2, 2, 3))):
            w[at] = f"x{r.randrange(300)}"
        texts.append(" ".join(w))
    pairs, store = {}, jaccard_join.T.store

    def counted(df, name):
        out = store(df, name)
        if name in ("hub-pairs", "rest-pairs"):
            pairs[name] = pairs.get(name, 0) + out.count()
        return out
    monkeypatch.setattr(jaccard_join.T, "store", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: x["component_id"] for x in jaccard_join.near_duplicates(df).collect()}
    shingles = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if root[a] != root[b] and 100 * len(shingles[a] & shingles[b]) >= 80 * len(shingles[a] | shingles[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if x == high else x for x in root]
    assert got == dict(enumerate(root)) and len(set(root)) < 500
    assert sum(pairs.values()) < 3 * len(texts), pairs


def test_components_of_chains_stars_and_random_links(spark):
    from tokenmill.llm.components import components, extend
    r = random.Random(4)
    order = r.sample(range(1000, 1300), 300)
    links = [(k, k + 1) for k in range(200)] + list(zip(order, order[1:])) + [(5000, 4000 + k) for k in range(50)] + [(7, 7), (3, 2), (2, 3)]
    links += [(r.randrange(6000, 6400), r.randrange(6000, 6400)) for _ in range(220)]

    def plain(links):
        root = {x: x for p in links if p[0] != p[1] for x in p}
        for a, b in links:
            if a != b and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {x: low if y == high else y for x, y in root.items()}
        return root
    table = lambda rows: spark.createDataFrame(rows, "a long, b long")
    labels = components(table(links))
    assert {x.node: x.label for x in labels.collect()} == plain(links) and components(table([])).count() == 0
    more = [(150, 1100), (9000, 9001), (9001, 4010), (6001, 6002), (1, 2)]
    got = extend(labels, table(more)).collect()
    assert {x.node: x.label for x in got} == plain(links + more) and len(got) == len({x.node for x in got})


def test_buckets_meet_at_their_smallest_probing_member():
    r = random.Random(3)
    for size in (0, 1, 7, 400):
        rows = [(r.randrange(40), r.randrange(-9, 9), r.random() < 0.2) for _ in range(size)]
        want = Counter()
        for low in {x[0] for x in rows}:
            members = {x[1] for x in rows if x[0] == low}
            probing = {x[1] for x in rows if x[0] == low and x[2]}
            if len(members) > 1 and probing:
                want.update((min(probing), m) for m in members)
        got = jaccard_join._meet(*(np.array([x[k] for x in rows], t) for k, t in enumerate((np.uint32, np.int64, bool)))) if rows else ((), (), ())
        assert {(int(c), int(m)): int(k) for c, m, k in zip(*got)} == want


def test_small_groups_meet_without_their_tokens(spark, monkeypatch):
    """Small groups that share segments but mostly do not link: few rows a
    document are kept, and only sets of pairs that their sketches leave travel."""
    r = random.Random(12)
    texts = []
    for g in range(40):
        base = [f"g{g}w{k}" for k in range(120)]
        for k in range(6):
            w = list(base)
            for at in r.sample(range(len(w)), (1, 1, 8, 8, 9, 10)[k]):
                w[at] = f"x{r.randrange(10 ** 6)}"
            texts.append(" ".join(w))
    r.shuffle(texts)
    rows, store = Counter(), jaccard_join.T.store

    def counted(df, name):
        out = store(df, name)
        rows[name] += out.count()
        return out
    monkeypatch.setattr(jaccard_join.T, "store", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: x["component_id"] for x in jaccard_join.near_duplicates(df).collect()}
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if root[a] != root[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if x == high else x for x in root]
    assert got == dict(enumerate(root)) and len(set(root)) < len(texts)
    assert rows["rare-tokens"] + rows["shared-tokens"] < len(texts), rows
    assert rows["members"] <= 4 * len(texts) and rows["star-pairs"] < len(texts) / 2, rows
