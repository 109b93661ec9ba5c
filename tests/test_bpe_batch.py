"""Batched merge rounds against one merge at a time, over many random corpora."""

import random

import pytest

from tokenmill.operators.bpe import escape_replacement
from tokenmill.operators.bpe_batch import safe_prefix


def words_of(texts, mode):
    vocab = {}
    for t in texts:
        for w in t.split():
            key = tuple(w)
            vocab[key] = vocab.get(key, 0) + 1
    sep = (" ".join if mode == "reference" else lambda w: "".join(f" {c} " for c in w))
    out = {}
    for w, n in vocab.items():
        out[sep(w)] = out.get(sep(w), 0) + n
    return out


def symbols_of(word, mode):
    return word.split(" ") if mode == "reference" else word[1:-1].split("  ")


def merge(word, pair, mode):
    if mode == "reference":
        return word.replace(" ".join(pair), escape_replacement("".join(pair)))
    return word.replace(f" {pair[0]}  {pair[1]} ", f" {pair[0]}{pair[1]} ")


def stats_of(vocab, mode):
    stats = {}
    for word, n in vocab.items():
        parts = symbols_of(word, mode)
        for pair in zip(parts, parts[1:]):
            stats[pair] = stats.get(pair, 0) + n
    return stats


def one_at_a_time(texts, n, mode):
    vocab, merges = words_of(texts, mode), []
    while len(merges) < n:
        stats = stats_of(vocab, mode)
        if not stats:
            break
        best = max(stats, key=stats.get)
        merges.append((*best, stats[best]))
        vocab = {merge(w, best, mode): f for w, f in vocab.items()}
    return merges


def in_rounds(texts, n, mode):
    spell = lambda p, u, v: (u[:len(u) - len(p[0])] + (escape_replacement(p[0] + p[1]) if mode == "reference" else p[0] + p[1])
                             + v[len(p[1]):])
    vocab, merges, rounds = words_of(texts, mode), [], 0
    known = None
    while len(merges) < n:
        stats = stats_of(vocab, mode)
        if not stats:
            break
        known = {s for w in vocab for s in symbols_of(w, mode)} if known is None else known
        ranked = sorted(stats, key=lambda p: -stats[p])[:n - len(merges)]  # stable: ties stay in order of insertion
        k, new, whole = safe_prefix(ranked, list(stats), known, spell, mode == "canonical")
        for p in ranked[:k]:
            merges.append((*p, stats[p]))
            vocab = {merge(w, p, mode): f for w, f in vocab.items()}
        known = known | new if whole else None
        rounds += 1
        if known is not None:
            assert {s for w in vocab for s in symbols_of(w, mode)} <= known
    return merges, rounds


def corpus(rnd):
    letters = rnd.choice(["ab", "abc", "ab.", "a.+b", "abcdefgh", "abcde*", "aab"])
    return [" ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(1, rnd.choice([3, 7, 12]))))
                     for _ in range(rnd.randint(1, 12))) for _ in range(rnd.randint(1, 6))]


@pytest.mark.parametrize("mode", ["reference", "canonical"])
def test_rounds_equal_single_merges_on_ten_thousand_corpora(mode):
    rnd = random.Random(f"batch {mode}")
    total = rounds = 0
    for _ in range(10_000):
        texts = corpus(rnd)
        got, k = in_rounds(texts, 15, mode)
        assert got == one_at_a_time(texts, 15, mode), texts
        total, rounds = total + len(got), rounds + k
    assert rounds < 0.9 * total


def test_rounds_on_prose():
    rnd = random.Random(5)
    stems = ["the", "there", "other", "in", "inner", "winter", "on", "onion", "error", "terra", "an", "banana", "tension", "ration"]
    texts = [" ".join(rnd.choice(stems) + rnd.choice(["", "s", "er", "ing", "ation"]) for _ in range(300)) for _ in range(4)]
    got, rounds = in_rounds(texts, 32, "reference")
    assert got == one_at_a_time(texts, 32, "reference") and rounds < 24
