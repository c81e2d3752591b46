"""Plain-Python twins of the operators' rules, used by property tests."""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce


def char_wb(text: str, lo: int = 2, hi: int = 4) -> Counter:
    out: Counter = Counter()
    for w in text.lower().split():
        p = f" {w} "
        for n in range(lo, hi + 1):
            if n > len(p):
                break
            for i in range(len(p) - n + 1):
                out[p[i:i + n]] += 1
    return out


def tfidf_sims(corpus: list[str], max_features: int = 5000) -> list[float] | None:
    """Similarities of the last text with every earlier one (None: guard fails)."""
    if sum(1 for t in corpus if t.strip()) < 2:
        return None
    docs = [char_wb(t) for t in corpus]
    ctf: Counter = Counter()
    for d in docs:
        ctf.update(d)
    vocab = sorted(ctf, key=lambda t: (-ctf[t], t))[:max_features]
    n = len(docs)
    idf = {t: math.log((1 + n) / (1 + sum(1 for d in docs if d[t] > 0))) + 1 for t in vocab}
    vecs = []
    for d in docs:
        v = {t: d[t] * idf[t] for t in vocab if d[t]}
        norm = math.sqrt(sum(x * x for x in v.values()))
        vecs.append({t: x / norm for t, x in v.items()} if norm else {})
    q = vecs[-1]
    return [sum(q.get(t, 0.0) * x for t, x in v.items()) for v in vecs[:-1]]


def capped_first_wins(sources: list[list[str]], seen: set[str], cap: int) -> list[tuple[int, str]]:
    """(source, id) taken when sources choose in turn, each the first ``cap`` ids nobody has."""
    def choose(state, numbered):
        owned, (s, ids) = state, numbered
        fresh = [x for x in dict.fromkeys(ids) if x not in owned]
        return owned | {x: s for x in fresh[:cap]}

    owners = reduce(choose, enumerate(sources), dict.fromkeys(seen, -1))
    return [(s, x) for x, s in owners.items() if s >= 0]


def keyword_trends(history: list[set[str]], today: set[str], recent_n: int = 5) -> dict[str, list[str]]:
    """Classes from the places (record numbers) at which each keyword occurs."""
    n = len(history)
    border = max(0, n - recent_n)  # records from here on are recent
    places = {kw: [i for i, day in enumerate(history) if kw in day] for kw in today.union(*history)}

    def rate(kw, lo, hi):
        return sum(lo <= i < hi for i in places[kw]) / (hi - lo) if hi > lo else 0.0

    def kind(kw):
        if kw not in today:
            return "fading" if len(places[kw]) >= 3 and places[kw][-1] < border else None
        if not places[kw]:
            return "new"
        return "rising" if rate(kw, border, n) - rate(kw, 0, border) > 0.2 else None

    kinds = {kw: kind(kw) for kw in places} if today else {}
    return {k: sorted(kw for kw, x in kinds.items() if x == k) for k in ("new", "rising", "fading")}
