"""Slow, plain versions to compare with."""

import re

import xxhash


def brute_simhash(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def brute_components(values, radius=3):
    """Sets of values that chains of links within the radius connect."""
    left, groups = set(values), []
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            value = todo.pop()
            group.add(value)
            near = {v for v in left if (v ^ value).bit_count() <= radius}
            left -= near
            todo += near
        groups.append(group)
    return groups
