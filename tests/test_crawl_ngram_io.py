"""Crawl loop, n-gram model, tokenizer store, JSON corpus I/O, streaming."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import docs_df
from tokenmill.operators import crawl as C
from tokenmill.operators import ngram as M
from tokenmill.operators import sequence as S
from tokenmill.operators.bpe import BPETokenizer
from tokenmill.operators.tokenizer import CharacterTokenizer
from tokenmill.sources import tables as TB
from tokenmill.sources.tokenizer_store import TokenizerStoreError, load_tokenizer, save_tokenizer

SF = "/root/testdata/sf0.001"


def _graph(spark):
    pages = spark.createDataFrame(
        [(0, "a", ["b", "c"], "a"), (1, "b", ["d"], "b"), (2, "c", ["a"], "c"), (3, "d", [], "d"),
         (4, "e", ["a"], "e")], "page_id long, title string, links array<string>, title_key string")
    return pages, C.link_edges(pages)


def test_crawl_depth_bfs(spark):
    pages, edges = _graph(spark)
    start = pages.where("page_id = 0").select("page_id")
    got = {r["page_id"]: r["depth"] for r in C.crawl_depth(edges, start).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 2}


def test_crawl_sample_visits_reachable_pages(spark):
    pages, edges = _graph(spark)
    dedup, log = C.crawl(pages, edges, 0, n_pages=10, sample_size=1)
    assert sorted(r["page_id"] for r in log.collect()) == [0, 1, 2, 3]
    assert log.agg(F.max("round")).first()[0] == 3
    bounded, log2 = C.crawl(pages, edges, 0, n_pages=2, sample_size=5)
    assert log2.count() == 2


def test_crawl_numbers_a_round_in_sample_order(spark):
    import hashlib
    pages = spark.createDataFrame([(0, "s", [f"w{i}" for i in range(1, 9)], "s")] + [(i, "same", [], f"w{i}") for i in range(1, 9)],
                                  "page_id long, title string, links array<string>, title_key string")
    order = sorted(range(1, 9), key=lambda i: hashlib.md5(f"0:1:{i}".encode()).hexdigest())
    log = C.crawl_log(C.link_edges(pages), 0, 100, 100, "0").orderBy("ord").collect()
    assert [r["page_id"] for r in log] == [0, *order]
    records, _ = C.crawl(pages, C.link_edges(pages), 0, 100, 100, "0")
    assert {r["title"]: (r["page_id"], r["first_ord"]) for r in records.collect()} == {"s": (0, 0), "same": (order[-1], 1)}


def test_a_link_resolves_to_one_page(spark):
    pages = spark.createDataFrame([(0, "a", ["B", "b", "x"], "a"), (2, "b 2", ["a"], "b"), (1, "b 1", ["b"], "b")],
                                  "page_id long, title string, links array<string>, title_key string")
    got = sorted(map(tuple, C.link_edges(pages).collect()))
    assert got == [(0, 1), (1, 1), (2, 0)]
    from tokenmill.sources.pages import read_pages
    real = read_pages(spark, SF)[0]
    assert C.link_edges(real).count() <= C.link_terms(real).count()


def test_dedup_title_keeps_last_value_first_position(spark):
    recs = spark.createDataFrame([("t", "x", 0), ("u", "y", 1), ("t", "z", 2)],
                                 "title string, summary string, ord long")
    got = {r["title"]: (r["summary"], r["first_ord"]) for r in C.dedup_title(recs).collect()}
    assert got == {"t": ("z", 0), "u": ("y", 1)}


def test_ngram_probabilities_and_generation(spark):
    tok = CharacterTokenizer()
    framed = S.frame_sequences(tok.encode(docs_df(spark, ["abab", "abba", "b"])), 8)
    model = M.fit(framed)
    probs = model.probs.where("ctx <> ''")
    sums = probs.groupBy("ctx").agg(F.sum("p").alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-9 for r in sums)
    assert probs.where(F.col("next").isin(0, 1)).count() == 0
    prompts = spark.createDataFrame([(0, [67]), (1, []), (2, [90])], "rid long, ids array<int>")
    for mode in ("greedy", "sample"):
        out = {r["rid"]: r for r in M.generate(prompts, model, max_new_tokens=5, mode=mode).collect()}
        assert len(out) == 3 and out[0]["ids"][0] == 67 and out[1]["ids"][0] == 1
        assert all(r["n_new"] <= 5 for r in out.values())
        assert all(2 not in r["ids"] and 0 not in r["ids"][1:] for r in out.values())


def _literal_decode(counts, ids, order, n):
    """Greedy completion step by step from (ctx, next) counts: the longest end
    of the tokens so far that any counted context ends with decides."""
    ids = list(ids) or [1]
    for _ in range(n):
        for length in range(min(order - 1, len(ids)), -1, -1):
            end, own = ids[len(ids) - length:], {}
            for (ctx, nx), c in counts.items():
                known = [int(t) for t in ctx.split()]
                if nx > 1 and length <= len(known) and known[len(known) - length:] == end:
                    own[nx] = own.get(nx, 0) + c
            if own:
                break
        nx = min(own, key=lambda k: (-own[k], k))
        if nx == 2:
            break
        ids.append(nx)
    return ids


def test_greedy_generation_of_orders_2_and_3(spark):
    texts = ["abcab cba", "bca acb", "aab", "abc abd abc"]
    framed = S.frame_sequences(CharacterTokenizer().encode(docs_df(spark, texts)), 16)
    prompts = spark.createDataFrame([(0, [67]), (1, [68, 69]), (2, []), (3, [90, 91])], "rid long, ids array<int>")
    for order in (2, 3):
        counts = {(r["ctx"], r["next"]): r["c"] for r in M.transitions(framed, order).collect()}
        got = {r["rid"]: r["ids"] for r in M.generate(prompts, M.fit(framed, order), order, max_new_tokens=13).collect()}
        assert got == {r["rid"]: _literal_decode(counts, r["ids"], order, 13) for r in prompts.collect()}


def test_generation_from_no_training_text(spark):
    framed = S.frame_sequences(CharacterTokenizer().encode(docs_df(spark, ["ab"])), 8).limit(0)
    prompts = spark.createDataFrame([(0, [67]), (1, [])], "rid long, ids array<int>")
    for mode in ("greedy", "sample"):
        out = {r["rid"]: (r["ids"], r["n_new"]) for r in M.generate(prompts, M.fit(framed), max_new_tokens=4, mode=mode).collect()}
        assert out == {0: ([67], 0), 1: ([1], 0)}


def test_sampling_frequencies(spark):
    tok = CharacterTokenizer()
    framed = S.frame_sequences(tok.encode(docs_df(spark, ["ab", "ac", "ac", "ac"])), 4)
    model = M.fit(framed)
    rows = spark.range(4000).select(F.col("id").alias("rid"), F.lit("67").alias("ctx"))
    drawn = M.draw_next(rows, model, "s", 0).groupBy("next").count().collect()
    freq = {r["next"]: r["count"] / 4000 for r in drawn}
    assert abs(freq[68] - 0.25) < 0.03 and abs(freq[69] - 0.75) < 0.03


def test_tokenizer_store_roundtrip(spark):
    tok = BPETokenizer(4).fit(docs_df(spark, ["ab ab ab xab xab", "xabc zbc"]))
    path = tempfile.mkdtemp(prefix="tm-store-")
    save_tokenizer(spark, tok, path)
    back = load_tokenizer(spark, path)
    assert back.stoi == tok.stoi and back.itos == tok.itos and back.merges == tok.merges
    try:
        load_tokenizer(spark, os.path.join(path, "missing"))
        raise AssertionError("expected an error")
    except TokenizerStoreError:
        pass


def test_bitmaps_hold_exactly_their_ids(spark):
    rnd = random.Random(2)
    inside = {rnd.randint(-70_000, 70_000) for _ in range(3000)} | {0, 1, -1, 32_768, 32_769, -32_768, 1 << 40}
    asked = sorted(inside)[::3] + [rnd.randint(-70_000, 70_000) for _ in range(3000)]
    frame = lambda ids: spark.createDataFrame([(i,) for i in ids], "page_id long")
    bits = C.as_bitmaps(frame(inside))
    got = sorted(r.page_id for r in C.not_in_bitmaps(frame(asked), bits).collect())
    assert got == sorted(i for i in asked if i not in inside) and bits.count() < 12
    assert C.not_in_bitmaps(frame(asked), C.as_bitmaps(frame([]))).count() == len(asked)


def _chain(spark, folder, n=40):
    rnd = random.Random(3)
    edges = [(k, k + 1) for k in range(n)] + [(rnd.randint(0, n), rnd.randint(0, n)) for _ in range(15)] + [(500, 501)]
    spark.createDataFrame(edges, "src long, dst long").write.parquet(folder)
    depth, queue = {0: 0}, [0]
    for x in queue:
        for a, b in edges:
            if a == x and b not in depth:
                depth[b] = depth[x] + 1
                queue.append(b)
    return spark.read.parquet(folder), depth


def test_depths_and_a_stopped_crawl_goes_on(spark, tmp_path, monkeypatch):
    from tokenmill.plans.rounds import Rounds
    edges, want = _chain(spark, str(tmp_path / "edges"), 12)
    start = spark.createDataFrame([(0,)], "page_id long")
    depths = lambda df: {r.page_id: r.depth for r in df.collect()}
    assert depths(C.crawl_depth(edges, start)) == want
    state, publish, numbers = str(tmp_path / "state"), Rounds.publish, []

    def stops(self, number, tables, values):
        if number == 4 and len(numbers) == 4:
            tables["frontier"].write.parquet(f"{self.folder}/round-000004/frontier")  # cut off before the manifest
            raise RuntimeError("driver lost")
        numbers.append(number)
        return publish(self, number, tables, values)

    monkeypatch.setattr(Rounds, "publish", stops)
    with pytest.raises(RuntimeError):
        C.crawl_depth(edges, start, state=state)
    monkeypatch.setattr(Rounds, "publish", lambda self, k, *a: numbers.append(k) or publish(self, k, *a))
    got = C.crawl_depth(edges, start, state=state)
    assert depths(got) == want and got.count() == len(want) and numbers[:6] == [0, 1, 2, 3, 4, 5]


def test_a_stopped_sampled_crawl_goes_on(spark, tmp_path, monkeypatch):
    edges, _ = _chain(spark, str(tmp_path / "edges"))
    want = sorted(map(tuple, C.crawl_log(edges, 0, 14, 2).collect()))
    state, sample, calls = str(tmp_path / "state"), C.sample_frontier, []

    def stops(*a):
        calls.append(a[-1])
        if len(calls) == 6:
            raise RuntimeError("driver lost")
        return sample(*a)

    monkeypatch.setattr(C, "sample_frontier", stops)
    with pytest.raises(RuntimeError):
        C.crawl_log(edges, 0, 14, 2, state=state, publish_every=2)
    calls.clear()
    monkeypatch.setattr(C, "sample_frontier", lambda *a: calls.append(a[-1]) or sample(*a))
    assert sorted(map(tuple, C.crawl_log(edges, 0, 14, 2, state=state, publish_every=2).collect())) == want
    assert calls[0] == 4
    with pytest.raises(ValueError, match="other parameters"):
        C.crawl_log(edges, 0, 15, 2, state=state)


def test_a_save_cut_off_leaves_the_version_before(spark, tmp_path, monkeypatch):
    from tokenmill.sources import tokenizer_store as S
    path = str(tmp_path / "store")
    first = BPETokenizer(2).fit(docs_df(spark, ["ab ab abc"]))
    save_tokenizer(spark, first, path)
    second = BPETokenizer(4).fit(docs_df(spark, ["xy xy xyz zz zz"]))
    with monkeypatch.context() as m:
        m.setattr(second, "inverse_vocab_df", lambda spark: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            save_tokenizer(spark, second, path)
    assert load_tokenizer(spark, path).merges == first.merges and len(S.versions(spark, path)) == 1
    save_tokenizer(spark, second, path)
    assert load_tokenizer(spark, path).merges == second.merges and len(S.versions(spark, path)) == 2


def test_a_short_or_altered_table_raises(spark, tmp_path):
    path = str(tmp_path / "store")
    at = save_tokenizer(spark, BPETokenizer(2).fit(docs_df(spark, ["ab ab abc"])), path)
    rows = spark.read.parquet(f"{at}/vocab").collect()
    spark.createDataFrame(rows[:50]).write.mode("overwrite").parquet(f"{at}/vocab")
    with pytest.raises(TokenizerStoreError, match="rows instead of"):
        load_tokenizer(spark, path)
    spark.createDataFrame([(r["token"], (r["id"] + 1) % 50) for r in rows], "token string, id int").write.mode("overwrite").parquet(f"{at}/vocab")
    with pytest.raises(TokenizerStoreError, match="altered"):
        load_tokenizer(spark, path)


def test_tokenizers_are_kept_by_input_and_parameters(spark, tmp_path, monkeypatch):
    from tokenmill.sources import tokenizer_store as S
    docs, folder = str(tmp_path / "docs"), str(tmp_path / "kept")
    docs_df(spark, ["ab ab abc", "abc bc"]).write.parquet(docs)
    fits = []
    fit = BPETokenizer.fit
    monkeypatch.setattr(BPETokenizer, "fit", lambda self, *a, **k: fits.append(self.num_merges) or fit(self, *a, **k))
    one, store = S.fitted(spark.read.parquet(docs), 2, folder=folder)
    again, _ = S.fitted(spark.read.parquet(docs), 2, folder=folder)
    assert again.merges == one.merges and fits == [2]
    S.fitted(spark.read.parquet(docs), 3, folder=folder)
    assert fits == [2, 3]
    docs_df(spark, ["zz zz zz zz"]).write.mode("overwrite").parquet(docs)
    changed, _ = S.fitted(spark.read.parquet(docs), 2, folder=folder)
    assert fits == [2, 3, 2] and changed.merges != one.merges
    assert S.vocab_table(spark, store).count() == len(one)


def test_json_corpus_io(spark):
    d = tempfile.mkdtemp(prefix="tm-json-")
    src = os.path.join(d, "data.json")
    with open(src, "w") as f:
        f.write('[{"title": "A", "summary": "Hi there"}, {"title": "B", "summary": "Yo"}]')
    df = TB.read_json_corpus(spark, src)
    assert "encoded" not in df.columns and df.count() == 2
    TB.write_corpus(df, os.path.join(d, "out"), fmt="json")
    assert spark.read.json(os.path.join(d, "out")).count() == 2
    enc = CharacterTokenizer().encode(df, "summary")
    path = TB.write_prepared(S.frame_sequences(enc, 16), os.path.join(d, "prepared"), 16)
    again = spark.read.parquet(path)
    assert again.where(F.size("encoded") == 17).count() == 2
    prepared = S.prepare_corpus(again, CharacterTokenizer(), 16)  # P5: takes the P4 path
    assert prepared.count() == 2


def test_streaming_prepare(spark):
    from tokenmill.streaming.prepare_stream import prepare_stream
    d = tempfile.mkdtemp(prefix="tm-stream-")
    src, sink = os.path.join(d, "in"), os.path.join(d, "out")
    docs_df(spark, ["Cafe", "x" * 50]).write.parquet(src)
    q = prepare_stream(spark, src, sink, 8, checkpoint_location=os.path.join(d, "ckpt"))
    q.awaitTermination(120)
    out = spark.read.parquet(sink).collect()
    assert [r["encoded"] for r in out] == [[1, 38, 67, 72, 71, 2, 0, 0, 0]]


def test_real_tables_smoke(spark):
    docs = TB.documents(spark, SF)
    assert docs.count() > 0
    from tokenmill.sources.pages import read_pages
    ok, bad = read_pages(spark, SF)
    assert ok.count() > 0 and bad.count() == 0


def test_json_round_trip(spark):
    d = tempfile.mkdtemp(prefix="tm-json-")
    df = spark.createDataFrame([("A", "Hi"), ("B", "[x"), ("C", None)], "title string, summary string")
    TB.write_corpus(df.coalesce(1), os.path.join(d, "out"), fmt="json")
    back = TB.read_json_corpus(spark, os.path.join(d, "out"))
    assert sorted(map(tuple, back.select("title", "summary").collect())) == [("A", "Hi"), ("B", "[x"), ("C", None)]


def test_stream_goes_on_after_a_restart(spark):
    """A second application (another checkpoint dir of the session) adds new documents to the same sink."""
    from tokenmill.streaming.prepare_stream import prepare_stream
    d = tempfile.mkdtemp(prefix="tm-stream-")
    src, sink = os.path.join(d, "in"), os.path.join(d, "out")
    old = spark.sparkContext.getCheckpointDir()
    try:
        for k, text in enumerate(["Cafe", "Bar"]):
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tm-ckpt-"))
            spark.createDataFrame([(k, text)], "doc_id long, text string").write.mode("append").parquet(src)
            assert prepare_stream(spark, src, sink, 8).awaitTermination(120)
        assert sorted(r["doc_id"] for r in spark.read.parquet(sink).collect()) == [0, 1]
    finally:
        spark.sparkContext.setCheckpointDir(os.path.dirname(old))


def test_quarantine_sets_rows_aside(spark):
    from tokenmill.operators.tokenizer import quarantine
    df = spark.createDataFrame([(0, "fine"), (1, "caf\u00e9 \u00e9"), (2, None), (3, "back\\slash")], "doc_id long, text string")
    ok, bad = quarantine(df, "text")
    assert sorted(r["doc_id"] for r in ok.collect()) == [0, 2]
    assert {r["doc_id"]: r["n_oov"] for r in bad.collect()} == {1: 2, 3: 1}


def test_crawl_sample_query_takes_every_reachable_page(spark, monkeypatch):
    from tokenmill.plans import queries as Q

    rows = [(0, "s", "t", [f"w{i}" for i in range(1, 20)], "s")] + [(i, f"w{i}", "t", [], f"w{i}") for i in range(1, 21)]
    pages = spark.createDataFrame(rows, "page_id long, title string, summary string, links array<string>, title_key string")
    monkeypatch.setattr(Q, "_pages", lambda spark, sf: pages)
    got = Q.q_crawl_sample(spark, "").collect()
    assert sorted(r["page_id"] for r in got) == list(range(20))
    assert max(r["round"] for r in got) == 3
    few = C.crawl(pages, C.link_edges(pages), 0, 6, 2, "0")[1].collect()
    assert len(few) == 6 and max(r["round"] for r in few) == 3


def test_back_off_uses_the_longest_known_context(spark):
    import math
    seqs = [[1, 5, 6, 7, 2, 0], [1, 5, 6, 8, 2, 0], [1, 6, 8, 5, 6, 8]]
    counts = {}
    for s in seqs:
        for i in range(len(s) - 1):
            for n in range(0, min(2, i + 1) + 1):
                ctx = " ".join(map(str, s[i + 1 - n:i + 1]))
                counts[ctx, s[i + 1]] = counts.get((ctx, s[i + 1]), 0) + 1
    df = spark.createDataFrame(list(enumerate(seqs)), "doc_id long, encoded array<int>")
    trans = M.backoff_transitions(df, 3)
    assert {(r.ctx, r.next): r.c for r in trans.collect()} == counts
    total = {}
    for (ctx, _), c in counts.items():
        total[ctx] = total.get(ctx, 0) + c

    def longest(context):
        tried = [" ".join(map(str, context[-n:])) if n else "" for n in range(min(2, len(context)), -1, -1)]
        return next(t for t in tried if t in total)

    held = [[1, 9, 5, 6, 8], [5, 6, 7, 7, 7], [9, 9, 9]]
    got = {r.doc_id: r for r in M.backoff_losses(spark.createDataFrame(list(enumerate(held)), "doc_id long, encoded array<int>"), trans, 10, 3).collect()}
    for d, s in enumerate(held):
        want = 0.0
        for i in range(len(s) - 1):
            ctx = longest(s[:i + 1])
            want -= math.log((counts.get((ctx, s[i + 1]), 0) + 1) / (total[ctx] + 10))
        assert got[d].nll == pytest.approx(want) and got[d].n_pos == len(s) - 1
    with pytest.raises(ValueError, match="order 2"):
        M.sequence_losses(df, trans, 10)
    # greedy completion: the best next token of the longest known context, ties to the lowest id
    prompts = [[1, 5], [9, 5], [9, 9], [8]]
    model = M.fit(df, order=3)
    out = M.generate(spark.createDataFrame(list(enumerate(prompts)), "rid long, ids array<int>"), model, order=3, max_new_tokens=3)
    with pytest.raises(ValueError, match="order 3"):
        M.generate(spark.createDataFrame([(0, [1])], "rid long, ids array<int>"), model)
    for r in out.collect():
        ids = list(prompts[r.rid])
        for _ in range(3):
            usable = {c for c, x in counts if x not in (0, 1)}
            tried = [" ".join(map(str, ids[-n:])) if n else "" for n in range(min(2, len(ids)), -1, -1)]
            ctx = next(t for t in tried if t in usable)
            nxt = min((x for c, x in counts if c == ctx and x not in (0, 1)), key=lambda x: (-counts[ctx, x], x))
            if nxt == 2:
                break
            ids.append(nxt)
        assert list(r.ids) == ids
