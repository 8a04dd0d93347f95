"""Brute-force versions of pipeline stages over a pandas table of documents indexed by doc_id."""

import re
from collections import defaultdict

BLANKS = " \t\r\x0b\x0c"


def plain_line_dedup(docs, min_sites=5):
    seen = defaultdict(lambda: (set(), set(), []))
    lines = {d: [x.strip(BLANKS) for x in t.split("\n")] for d, t in docs.text.items()}
    for d, ls in lines.items():
        for x in filter(None, ls):
            sites, contexts, all_ = seen[x]
            sites.add(docs.source[d])
            contexts.add(min((y for y in ls if y and y != x), default=""))
            all_.append(d)
    wide = {x: 2 * len(c) >= len(n) for x, (s, c, n) in seen.items() if len(s) >= min_sites}
    out = {}
    for d, ls in lines.items():
        few = 2 * sum(len(x) for x in ls if wide.get(x) is False) <= sum(map(len, ls))
        gone = {k for k, x in enumerate(ls) if x in wide and (wide[x] or few)}
        out[d] = "\n".join(x for k, x in enumerate(docs.text[d].split("\n")) if k not in gone) if gone else docs.text[d]
    return out


def plain_near_copies(docs, least):
    def shingles(t):
        w = t.lower().split()
        return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else {""}

    s = {d: shingles(t) for d, t in docs.text.items()}
    up = {d: d for d in s}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(s)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if len(s[a] & s[b]) >= least * len(s[a] | s[b]):
                up[find(a)] = find(b)
    groups = defaultdict(set)
    for d in ids:
        groups[find(d)].add(d)
    return list(groups.values())


def plain_private(text):
    return re.findall(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", text)
