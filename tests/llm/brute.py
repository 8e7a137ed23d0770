"""Plain versions of the operators, for small inputs."""

import re

import numpy as np

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def least_reachable(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_duplicates(texts, width, percent=80):
    """``doc_id -> (n_shingles, component)`` from ``doc_id -> text``."""
    sets = {i: word_set(t, width) for i, t in texts.items()}
    ids = sorted(sets)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    component = least_reachable(ids, links)
    return {i: (len(sets[i]), component[i]) for i in ids}


def contained(docs, items, width=5, share=0.8):
    """``(doc_id, item_id) -> (n_item, n_shared)``."""

    def shingles(text):
        words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
        if len(words) < width:
            return {tuple(words)} if words else set()
        return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}

    held = {i: shingles(t) for i, t in docs.items()}
    found = {}
    for item, text in items.items():
        wanted = shingles(text)
        for doc, own in held.items():
            n = len(wanted & own)
            if wanted and n >= share * len(wanted):
                found[doc, item] = (len(wanted), n)
    return found


def vector_links(vectors, cosine):
    """``vec_id -> (n_links, component)`` from ``vec_id -> list or None``."""
    able = {}
    for i, v in vectors.items():
        if v is not None and all(x is not None for x in v):
            v = np.array(v, dtype=np.float64)
            if np.isfinite(v).all() and v.any():
                able[i] = v / np.linalg.norm(v)
    ids = sorted(able)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if able[a] @ able[b] >= cosine]
    component = least_reachable(vectors, links)
    return {i: (sum(i in link for link in links), component[i]) for i in vectors}


def lags(order, share):
    """The largest distance of any source from its share, in blocks, over all prefixes."""
    total, seen, worst = sum(share.values()), dict.fromkeys(share, 0), 0.0
    for n, source in enumerate(order, 1):
        seen[source] += 1
        worst = max(worst, *(abs(seen[s] - n * share[s] / total) for s in share))
    return worst


def earliest_deadlines(share, slots):
    """``slot, source, block`` of a plain schedule, slot by slot, of whole shares."""
    whole, names = sum(share.values()), sorted(share, key=lambda s: (s is not None, s))
    had, out = dict.fromkeys(names, 0), []
    for slot in range(slots):
        ready = [
            (-(-(had[s] + 1) * whole // share[s]), i, s)
            for i, s in enumerate(names)
            if had[s] * whole // share[s] <= slot
        ]
        source = min(ready)[2]
        out.append((slot, source, had[source]))
        had[source] += 1
    return out
