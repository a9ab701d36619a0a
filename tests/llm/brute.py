"""Plain, quadratic versions that the operators are tested against."""

import re
from collections import Counter, defaultdict

WHITE = "[\x20\x09-\x0d]+"


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingles(text, n):
    words = [w for w in re.split(WHITE, lower_ascii(text or "")) if w]
    if not words:
        return set()
    if len(words) < n:
        return {tuple(words)}
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return [find(x) for x in range(n)]


def near_components(rows, n, num, den):
    """doc_id -> (size of its set, smallest doc_id of its component), for unique ids."""
    sets = [shingles(text, n) for _, text in rows]
    index = defaultdict(list)
    links = []
    for i, own in enumerate(sets):
        common = Counter(j for s in own for j in index[s])
        for j, same in common.items():
            if den * same >= num * (len(own) + len(sets[j]) - same):
                links.append((i, j))
        for s in own:
            index[s].append(i)
    root = roots(len(rows), links)
    least = {}
    for (doc_id, _), r in zip(rows, root):
        least[r] = min(doc_id, least.get(r, doc_id))
    return {d: (len(s), least[r]) for (d, _), s, r in zip(rows, sets, root)}
