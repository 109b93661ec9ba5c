"""Plain Python versions of the operators' contracts, for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def near_components(docs):
    """{doc_id: (set size, component)} over (doc_id, text) pairs, every pair compared."""
    sets = {i: shingles(t) for i, t in docs if i is not None}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    byset = {}
    for i in sorted(sets):
        if sets[i]:
            byset.setdefault(sets[i], []).append(i)
    reps = [v[0] for v in byset.values()]
    for v in byset.values():
        for i in v[1:]:
            parent[find(i)] = find(v[0])
    holders = {}
    for r in reps:
        for s in sets[r]:
            holders.setdefault(s, []).append(r)
    tried = set()
    for group in holders.values():
        for x in range(len(group)):
            for y in range(x):
                a, b = group[y], group[x]
                if (a, b) in tried:
                    continue
                tried.add((a, b))
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    ra, rb = find(a), find(b)
                    parent[max(ra, rb)] = min(ra, rb)
    low = {}
    for i in sets:
        low[find(i)] = min(low.get(find(i), i), i)
    return {i: (len(s), low[find(i)]) for i, s in sets.items()}
