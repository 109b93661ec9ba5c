"""Token files: the code against plain lists, the encoder against the library
on whole texts, the operator against a plain version, and odd inputs."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenmill.llm import tables
from tokenmill.llm import token_files as D

PATH = "/opt/tokenizers/word_bpe_49k.json"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("top", [1, 2, 200, 49_000, 1 << 31, 1 << 50])
def test_codes_give_back_every_id(top):
    r = random.Random(top)
    docs = [(None if k == 3 else k - 5, np.array([int(top ** r.random()) - 1 for _ in range(r.choice([0, 1, 7, 700]))], np.int64))
            for k in range(20)]
    file = D.File(D.build(docs))
    flat = [int(x) for _, ids in docs for x in ids]
    assert file.n_ids == len(flat) and file.doc_ids == [i for i, _ in docs]
    assert [file.token(i) for i in range(len(flat))] == flat
    assert all(file.document(k).tolist() == ids.tolist() for k, (_, ids) in enumerate(docs))
    for _ in range(50):
        i, j = sorted(r.randint(0, len(flat)) for _ in range(2))
        assert file.slice(i, j).tolist() == flat[i:j]


def test_widths_are_the_cheapest():
    def bits(ids, plan):
        total, rest = 0.0, list(ids)
        for k, w in enumerate(plan):
            last = k + 1 == len(plan)
            total += len(rest) * (w + (0 if last else 1 + 64 / D.RANK_BITS))
            rest = [x >> w for x in rest if x >> w > 0]
        return total

    def plans(n):
        return [[]] if n == 0 else [[w, *p] for w in range(1, n + 1) for p in plans(n - w)]

    r = random.Random(5)
    for _ in range(20):
        ids = [int(200 ** r.random()) - 1 for _ in range(60)]
        top = max(1, max(ids).bit_length())
        best = min(bits(ids, p) for p in plans(top))
        got = D.widths(np.array(ids))
        assert sum(got) == top and bits(ids, got) == pytest.approx(best)


def test_damage_raises():
    image = bytearray(D.build([(1, np.arange(100))]))
    image[60] ^= 1
    for bad in (bytes(image), bytes(image[:50]), b"", D.build([])[:-1]):
        with pytest.raises(ValueError):
            D.File(bad)
    with pytest.raises(ValueError):
        D.build([(1, np.array([-1]))])
    assert D.File(D.build([])).n_ids == 0


def test_encoder_equals_the_library_on_whole_texts(library):
    r = random.Random(6)
    odd = ["", " ", "\n\n", "It's we'll  'S 'sa", "café café e ́x", "a b c\x1cd\x85e\tf", "<|endoftext|> x<|startoftext|>y <| endoftext|>",
           "İI Σσς ß", "日本語 \U0001F600\U0001F600", "x" * 5000, "1234 5½", "힣 가", "A\r\nB", "́ ́"]
    alphabet = ["a", "B", "é", "é", " ", "  ", "\n", "'s", "'", "1", "-", " ", "\U0001F600", "<|", "the", "\x1f"]
    odd += ["".join(r.choice(alphabet) for _ in range(r.randint(1, 60))) for _ in range(400)]
    for memo in (D.MEMO_BYTES, 3000):
        encoder = D.Encoder(PATH, memo_bytes=memo)
        assert encoder.apart
        got = [x for k in range(0, len(odd), 37) for x in encoder.encode(odd[k:k + 37])]
        for text, ids in zip(odd, got):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids + [2], repr(text)


def test_only_files_that_cut_at_blanks_are_encoded_by_words():
    import json
    with open(PATH, encoding="utf-8") as f:
        good = json.load(f)
    assert D.words_apart(good)
    assert not D.words_apart({**good, "post_processor": {"type": "x"}}) and not D.words_apart({**good, "pre_tokenizer": None})
    assert not D.words_apart({**good, "normalizer": {"type": "Sequence", "normalizers": [{"type": "Prepend"}]}})
    with open("/opt/tokenizers/byte_bpe_50k.json", encoding="utf-8") as f:
        assert not D.words_apart(json.load(f))


def plain(rows, library):
    """[(doc_id, start, n_tokens, ids_crc32)] of the contract."""
    out, at = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()))):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


ROWS = ([(k * 7 % 101, " ".join(f"word{k % 9} it's {k}" for _ in range(k % 23))) for k in range(101)]
        + [(None, "null id"), (None, None), (200, None), (201, ""), (202, "same"), (202, "same"), (202, "other"), (-5, "first"),
           (203, "long " * 20_000), (204, "\U0001F600 \x00 end")])


@pytest.mark.parametrize("file_ids, task_ids", [(D.FILE_IDS, D.TASK_IDS), (200, 3000), (1, 500)])
def test_files_hold_the_documents_in_order(spark, library, file_ids, task_ids):
    tables.ready(spark)
    df = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in ROWS], "doc_id long, text string, start long, n long, image string")
    files = D.write(df, PATH, file_ids=file_ids, task_ids=task_ids)
    want = plain(ROWS, library)
    assert sorted(map(tuple, D.digests(files).collect()), key=str) == sorted(want, key=str)
    assert files.count() == 1 if file_ids == D.FILE_IDS else files.count() > 10
    stream = [x for r in sorted(D.documents(files).collect(), key=lambda r: r.start) for x in r.ids]
    assert len(stream) == sum(w[2] for w in want)
    places = [0, 1, 5, 5, len(stream) - 1, len(stream), -1, len(stream) // 2, *range(300, 330)]
    got = {r.place: r.id for r in D.tokens_at(files, spark.createDataFrame([(p,) for p in places], "place long")).collect()}
    assert got == {p: stream[p] for p in places if 0 <= p < len(stream)}


def test_documents_table(spark, library):
    docs = tables.read(spark, "/root/testdata/sf0.001", "documents")
    got = D.write_and_read(docs, PATH)
    assert sorted(map(tuple, got.collect())) == plain([(r.doc_id, r.text) for r in docs.collect()], library)
    assert D.write_and_read(docs.where(F.lit(False)), PATH).count() == 0


def test_marks_stand_apart_from_their_word(library, monkeypatch):
    """Words are learned once, whatever marks follow them."""
    learned, learn = [], D.Encoder._learn
    monkeypatch.setattr(D.Encoder, "_learn", lambda self, words: learned.extend(words) or learn(self, words))
    words = [f"quor{chr(97 + k % 26)}{chr(97 + k // 26)}é" for k in range(300)]
    texts = [" ".join(w + r for w in words) for r in ("", "...", "%%%", "!!", ")")] + ["", "x<|endoftext|>É... É*** İ.", "a× a÷! ñ. ß.,"]
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    run = D._encode_task(PATH, 2)
    for _ in range(2):
        got = [x for out in run(batch) for x in out.column("ids").to_pylist()]
        assert [D._widen(x).tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert len(learned) == len(set(learned)) < 330


@pytest.mark.parametrize("width", [*range(1, 21), 33])
def test_packed_values_come_back_from_any_place(width):
    r = random.Random(width)
    for n in (0, 1, 7, 8, 9, 200):
        values = np.array([r.getrandbits(width) for _ in range(n)], np.int64)
        data = D.pack(values, width)
        whole = sum(int(v) << (k * width) for k, v in enumerate(values))
        assert data == whole.to_bytes(-(-n * width // 8), "little")
        for _ in range(20):
            i, j = sorted(r.randint(0, n) for _ in range(2))
            assert D.unpack(memoryview(data), width, i, j).tolist() == values[i:j].tolist()


def test_only_the_images_are_stored(spark, library, monkeypatch):
    """Ids are written once, as images; the library's file is read once a process."""
    names, store = [], tables.store
    monkeypatch.setattr(tables, "store", lambda df, name: names.append(name) or store(df, name))
    df = spark.createDataFrame([(k, f"word{k} " * 40) for k in range(300)], "doc_id long, text string")
    files = D.write(df, PATH, file_ids=300, task_ids=1000)
    assert names == ["token-files"]
    want = plain([(r.doc_id, r.text) for r in df.collect()], library)
    assert sorted(map(tuple, D.digests(files).collect())) == want
    assert D.Encoder(PATH).tokenizer is D.Encoder(PATH).tokenizer
