"""Which merges one round may make: the longest safe prefix of the ranked pairs.

One merge a round is exact by definition.  Several are too, when the ranking
after each of them is known without counting again.  Let the pairs be ranked
by count, ties by first insertion, and let merge i join the adjacent symbols
(u, v) with u ending in its left and v beginning with its right part (in
canonical mode only the pair itself).  The merges 1 .. k are safe if, for
every i < k,

1. no later pair of the prefix is touched: its left symbol is no v of merge i,
   its right symbol no u of it, and the pair itself is not joined by it;
2. merge i does not touch its own pair in this way;
3. every symbol it makes is made from one sequence of old symbols only, and did
   not exist before.

A merge may also join symbols that earlier merges of the round made, and three
symbols at once where the middle one begins with its right and ends in its left
part.  Both follow from the old pairs it joins (a made symbol begins with its
first and ends in its last old symbol), so all symbols it can make are listed
for (3).  Where a list would not be complete the round ends: before a pair
whose left part is longer than the last old symbol of a made one that ends in
it (or right part and first symbol), and after a merge that may join more than
three symbols.

Then (1) and (3) leave the later pairs' counts and first places as they were.
A pair with a new symbol stands, by (3), for occurrences of one old pair
across its border; that old pair is not in the prefix, because pairs already
merged have no occurrence left (2) and pairs still to come are untouched (1).
So its count is at most that of a pair ranked below k, it was first seen no
earlier, and all other pairs can only have fallen.  Hence the next best pair is
the next of the prefix, k times over.  What merge k itself does to the ranking
is counted in the next round, so it need not satisfy the conditions for i.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

Pair = tuple[str, str]


def matches(pair: Pair, left: str, right: str, anchored: bool) -> bool:
    """Whether the merge of ``pair`` joins the adjacent symbols left, right."""
    return (left, right) == pair if anchored else left.endswith(pair[0]) and right.startswith(pair[1])


#: Symbols of one merge that are listed; beyond that it ends the round.
MAX_MADE = 20_000


def safe_prefix(ranked: list[Pair], adjacent: Iterable[Pair], symbols: set[str],
                spell: Callable[[Pair, str, str], str], anchored: bool) -> tuple[int, set[str], bool]:
    """(k, new symbols, whether these are all): how many of the ``ranked``
    pairs one round may merge, at least one.

    ``adjacent`` holds the pairs of the table that a merge of ``ranked`` joins
    (others do no harm), ``symbols`` every symbol there may be, and
    ``spell(pair, left, right)`` is the symbol a merge makes.
    """
    hits = {p: [q for q in adjacent if matches(p, *q, anchored)] for p in ranked}
    lefts: set[str] = set()
    rights: set[str] = set()
    joined: set[Pair] = set()
    new: dict[str, Pair] = {}  # made symbol: its first and last old symbol
    for k, pair in enumerate(ranked):
        c, d = pair
        if k and (c in rights or d in lefts or pair in joined or (not anchored and any(
                s.endswith(c) and not last.endswith(c) or s.startswith(d) and not first.startswith(d)
                for s, (first, last) in new.items()))):
            return k, set(new), True
        made = _made(pair, hits[pair], {} if anchored else new, spell)
        if made is None:
            return k + 1, set(new), False
        us, vs = {u for u, _ in hits[pair]}, {v for _, v in hits[pair]}
        names = [s for s, _ in made]
        if len(set(names)) < len(names) or any(s in symbols or s in new for s in names):
            return k + 1, set(new).union(names), False  # condition 3
        new.update(made)
        if c in vs or d in us:  # condition 2
            return k + 1, set(new), True
        lefts |= us
        rights |= vs
        joined |= set(hits[pair])
    return len(ranked), set(new), True


def _made(pair: Pair, hits: list[Pair], new: dict[str, Pair], spell: Callable[[Pair, str, str], str]) -> list[tuple[str, Pair]] | None:
    """All symbols that the merge can make, with their first and last old
    symbol; None where they cannot be listed."""
    starts: dict[str, list[str]] = {}
    ends: dict[str, list[str]] = {}
    for s, (first, last) in new.items():
        starts.setdefault(first, []).append(s)
        ends.setdefault(last, []).append(s)
    outer = lambda s: new.get(s, (s, s))
    known = set(hits)
    us, vs = {u for u, _ in hits}, {v for _, v in hits}
    middle = [s for s in [*us & vs, *(s for s, (first, last) in new.items() if first in vs and last in us)]]
    if any((outer(x)[1], outer(y)[0]) in known for x in middle for y in middle):
        return None
    made = []
    for u, v in hits:
        for x in [u, *ends.get(u, [])]:
            for y in [v, *starts.get(v, [])]:
                made.append((spell(pair, x, y), (outer(x)[0], outer(y)[1])))
        if len(made) > MAX_MADE:
            return None
    for m in middle:
        before = [x for u, v in hits if v == outer(m)[0] for x in [u, *ends.get(u, [])]]
        after = [y for u, v in hits if u == outer(m)[1] for y in [v, *starts.get(v, [])]]
        if len(made) + len(before) * len(after) > MAX_MADE:
            return None
        made += [(spell(pair, spell(pair, x, m), y), (outer(x)[0], outer(y)[1])) for x in before for y in after]
    return made
