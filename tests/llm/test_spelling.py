"""Spelling variants: the index and search against edits written out, the
operator against a plain version of its contract, and odd inputs."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tokenmill.llm import spelling, tables

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def edits(word, letters):
    n = len(word)
    out = {word[:i] + word[i + 1:] for i in range(n)}
    out |= {word[:i] + c + word[i + 1:] for i in range(n) for c in letters}
    out |= {word[:i] + c + word[i:] for i in range(n + 1) for c in letters}
    return out - {word}


def plain(rows):
    """The contract, word by word: {word: (form, root, n, n_near, form_n)}."""
    count = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    letters = {c for w in words for c in w}
    form, near = {}, {}
    for w in words:
        near[w] = [x for x in edits(w, letters) if x in words]
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def rows_of(df):
    got = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}
    assert len(out) == len(got)
    return out


def test_search_finds_all_words_at_one_edit():
    r = random.Random(1)
    for _ in range(40):
        letters = "abÀÿ"[:r.randint(2, 4)]
        words = sorted({"".join(r.choice(letters) for _ in range(r.randint(2, 9))) for _ in range(r.randint(1, 250))})
        index, known, got = spelling.BiIndex(words), set(words), set()
        for second in (False, True):
            for i, j in zip(*spelling.search(index, words, second)):
                x, y = words[i], words[j]
                assert y.endswith(x[len(x) // 2:]) if second else y.startswith(x[:len(x) // 2])
                got.add((x, y))
        assert got == {(x, y) for x in words for y in edits(x, letters) & known}


def test_intervals_of_both_directions_count_occurrences():
    words = ["banana", "bandana", "ananas", "an"]
    index, text = spelling.BiIndex(words), "$banana$bandana$ananas$an$"
    r = random.Random(2)
    for _ in range(300):
        at = r.randint(0, len(text) - 1)
        low = high = at
        state, found = index.start(1), True
        for _ in range(r.randint(1, 6)):
            side = r.randint(0, 1)
            if side == 0 and low == 0 or side == 1 and high == len(text):
                continue
            c = text[low - 1] if side == 0 else text[high]
            low, high = (low - 1, high) if side == 0 else (low, high + 1)
            import numpy as np
            symbol = np.array([spelling.DELIMITER]) if c == "$" else index.code(np.array([ord(c)]))
            state = index.extend(state, symbol, side)
            piece = text[low:high]
            assert state[2][0] == sum(text.startswith(piece, k) for k in range(len(text))) and found
    assert index.code(spelling.np.array([ord("z")]))[0] == len(index.alphabet) + 2


@pytest.mark.parametrize("block", [spelling.BLOCK_CHARS, 300, 40])
def test_variants_equal_the_plain_version(spark, block):
    r = random.Random(3)
    base = ["".join(r.choice("abcdeé") for _ in range(r.randint(7, 10))) for _ in range(60)]
    base += ["prefixa" + x for x in ("", "b", "c", "bb", "bc", "abab")] + ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "bbaaaaaaa"]
    rows = []
    for k in range(400):
        words = []
        for _ in range(r.randint(0, 30)):
            w = base[min(int(r.expovariate(0.08)), len(base) - 1)]
            if r.random() < 0.2:
                w = r.choice(sorted(edits(w, "abcde")))
            words.append(w.upper() if r.random() < 0.1 else w)
        rows.append((None if k % 50 == 0 else k % 300, r.choice([" ", "-", "1", ", "]).join(words)))
    rows += [(500, None), (501, ""), (502, "short words only"), (503, "x" * 200 + " " + "x" * 201), (504, "x" * 200 + " " + "x" * 201)]
    df = spark.createDataFrame([(i, t, "w", 1, 2) for i, t in rows], "doc_id long, text string, word string, n long, key int")
    want = plain(rows)
    assert rows_of(spelling.variants(df, block_chars=block)) == want
    assert sum(v[0] is not None for v in want.values()) > 20


def test_chains_of_forms_end_at_their_root(spark):
    tables.ready(spark)
    links = [(f"w{k}", f"w{k + 1}") for k in range(9)] + [("x", "w4"), ("y", "z")]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(links, "word string, form string")).collect()}
    assert got == {f"w{k}": "w9" for k in range(9)} | {"x": "w9", "y": "z"}


def test_a_crowded_key_is_dealt_over_parts(spark):
    """A third of the words share their first half; no pair is lost or doubled."""
    tables.ready(spark)
    r = random.Random(4)
    words = {"common" + "".join(r.choice("abc") for _ in range(6)) for _ in range(300)}
    words |= {"".join(r.choice("abcdef") for _ in range(8)) for _ in range(600)}
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    want = Counter((x, y) for x in words for y in edits(x, "abcdefmno") & words)
    for block in (500, 5_000):
        got = Counter((x.word, x.near) for x in spelling.near_words(df, block).collect())
        assert got == want and len(want) > 100


def test_very_long_words(spark):
    tables.ready(spark)
    a, b = "x" * 5000 + "y" + "x" * 5000, "x" * 5000 + "z" + "x" * 5000
    words = [a, b, a + "x", "x" * 10_001, "x" * 9_998, "q" * 10_000]
    df = spark.createDataFrame([(w, k + 2) for k, w in enumerate(words)], "word string, n long")
    got = Counter((words.index(r.word), words.index(r.near), r.near_n) for r in spelling.near_words(df).collect())
    near = [(0, 1), (0, 2), (0, 3), (1, 3), (2, 3)]
    assert got == Counter([(i, j, j + 2) for i, j in near] + [(j, i, i + 2) for i, j in near])


def test_documents(spark):
    docs = tables.read(spark, "/root/testdata/sf0.001", "documents")
    want = plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert rows_of(spelling.variants(docs)) == want and len(want) > 100
    empty = docs.where(F.lit(False))
    assert spelling.variants(empty).count() == 0
