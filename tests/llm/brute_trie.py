"""Operator 11 by plain dictionaries: rebuilds every conversation and lists all of its prefixes."""

import hashlib
import zlib


def trie(rows):
    """rows: (conv_id, turn, role, text). Sorted tuples in the order of the operator's columns."""
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    own = {c: [(r, x) for _, r, x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - c % 100, [])[:h]) + tuple(v[h:])
    members, kids, leaves, saved = {}, {}, {}, {}
    for c, s in built.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    for p in sorted(members, key=len, reverse=True):
        below = kids.get(p, [])
        leaves[p] = sum(leaves[q] for q in below) or 1
        saved[p] = sum(saved[q] for q in below) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if built[c] == p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=order)


def order(row):
    return tuple((x is not None, 0 if x is None else x) for x in row)
