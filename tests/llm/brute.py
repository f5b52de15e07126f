"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def simhash(text: str | None, k: int = 3) -> int:
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    runs = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints: list[tuple[object, int]], bits: int = 2) -> list[int]:
    """For each (id, fingerprint) a number of its group."""
    group = list(range(len(prints)))

    def root(i: int) -> int:
        while group[i] != i:
            i = group[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= bits:
                x, y = root(i), root(j)
                group[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(prints))]


def component_ids(prints: list[tuple[object, int]], bits: int = 2) -> list[object]:
    """For each (id, fingerprint) the least id that links reach."""
    least: dict[int, list] = defaultdict(list)
    roots = groups(prints, bits)
    for (doc_id, _), r in zip(prints, roots, strict=True):
        if doc_id is not None:
            least[r].append(doc_id)
    return [min(least[r], default=None) for r in roots]


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def windows(items: list[tuple[object, str | None]], n: int = 10) -> dict[tuple[str, ...], set[str]]:
    out: dict[tuple[str, ...], set[str]] = defaultdict(set)
    for item, text in items:
        own = words(text)
        for i in range(max(1, len(own) - n + 1) if own else 0):
            out[tuple(own[i : i + n])].add("" if item is None else str(item))
    return out


def hits(text: str | None, table: dict[tuple[str, ...], set[str]]) -> tuple[int, set[int], list[str]]:
    own, hit, found = words(text), set(), set()
    for size in {len(k) for k in table}:
        for i in range(len(own) - size + 1):
            if (items := table.get(tuple(own[i : i + size]))) is not None:
                hit |= set(range(i, i + size))
                found |= items
    return len(own), hit, sorted(found)


def without_hits(text: str | None, table: dict[tuple[str, ...], set[str]], coverage: float = 0.5) -> str | None:
    """The text without its hit spans; ... (Ellipsis) where the document goes."""
    n, hit, _ = hits(text, table)
    if not hit:
        return text
    if len(hit) > coverage * n:
        return ...
    places = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
    keep, at, i = [], 0, 0
    while i < n:
        if i in hit:
            first = i
            while i + 1 in hit:
                i += 1
            keep.append(text[at : places[first][0]])
            at = places[i][1]
        i += 1
    return "".join([*keep, text[at:]])


def dedup_lines(docs: list[tuple[object, str | None]], n: int = 3) -> list[tuple[object, str | None, int]]:
    """(id, text, removed lines); a document is an id (NULL last) with a text."""
    import xxhash

    def order(doc: object, text: str | None) -> tuple:
        hashed = xxhash.xxh64_intdigest((text or "").encode(), 42)
        return doc is None, doc if doc is not None else 0, hashed - 2**64 if hashed >= 2**63 else hashed

    seen: dict[tuple[str, ...], list[tuple]] = defaultdict(list)
    for doc, text in docs:
        lines = (text or "").split("\n")
        for at in range(len(lines) - n + 1):
            seen[tuple(lines[at : at + n])].append((order(doc, text), at))
    gone: dict[tuple, set[int]] = defaultdict(set)
    for places in seen.values():
        first = min(places)
        for doc, at in set(places):
            if (doc, at) != first:
                gone[doc] |= {x for x in range(at, at + n) if doc != first[0] or x >= first[1] + n}
    out = []
    for doc, text in docs:
        cut, lines = gone[order(doc, text)], (text or "").split("\n")
        out.append((doc, "\n".join(x for i, x in enumerate(lines) if i not in cut) if cut else text, len([i for i in cut if i < len(lines)])))
    return out


def damaged(rows: list[tuple]) -> list[tuple]:
    """(conv_id, turn, role, text) rows after the damage; a dropped row has a role of None."""
    import zlib

    said = lambda x: " " if x is None else str(x)
    out = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        role, text = said(role), said(text)
        if fault == 0:
            out.append((conv, turn, None, None))
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        row = (conv, turn, "user" if fault == 4 else role, text)
        out += [row] * (2 if fault == 3 else 1)
    return out


def repaired(rows: list[tuple]) -> dict[object, dict]:
    """Report by conversation of (conv_id, turn, role, text) rows, by plain search over all edits."""
    import functools
    import sys

    sys.setrecursionlimit(10_000)
    groups_: dict[object, list[tuple]] = defaultdict(list)
    for conv, *row in rows:
        groups_[conv].append(row)
    out = {}
    for conv, own in groups_.items():
        own = [r for r in own if r[1] is not None]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        seen, kinds = set(), []
        for _, role, text in own:
            bare = text.strip(" \t\n\x0b\x0c\r")
            kinds.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))

        def step(state: str, initial: str) -> str | None:
            """States are the last initial, or empty."""
            legal = {"s": "", "u": ("", "s", "a"), "a": ("u",)}
            return initial if initial in legal and state in legal[initial] else None

        @functools.cache
        def best(i: int, state: str, inserts: int) -> tuple[int, str, tuple]:
            found = []
            if i == len(own) and state in ("", "a"):
                found.append((0, "", ()))
            if inserts:
                for role in ("user", "assistant"):
                    if step(state, role[0]):
                        cost, audit, said = best(i, role[0], inserts - 1)
                        found.append((cost + 5, "I" + audit, (f"{role}:", *said)))
            if i < len(own):
                _, role, text = own[i]
                cost, audit, said = best(i + 1, state, 3)
                found.append((cost + 2, "D" + audit, said))
                if kinds[i] not in ("blank", "duplicate"):
                    extra = 5 * (kinds[i] == "truncated")
                    if step(state, role[:1]):
                        cost, audit, said = best(i + 1, role[:1], 3)
                        found.append((cost + extra, "K" + audit, (f"{role}:{text}", *said)))
                    for new in ("user", "assistant"):
                        if step(state, new[0]):
                            cost, audit, said = best(i + 1, new[0], 3)
                            found.append((cost + extra + 1, "R" + audit, (f"{new}:{text}", *said)))
            return min(found, default=(10**9, "", ()))

        cost, audit, said = best(0, "", 3)
        turns = [r[0] for r in own if r[0] is not None]
        initials = [r[1][:1] for r in own]
        out[conv] = {
            "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **{k: kinds.count(k) for k in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            "cost": cost, "audit": audit, "said": list(said), "repaired_sha256": sha("\n".join(said)),
        }
    return out


def base_secrets(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind."""
    patterns = [
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        r"(AKIA)[A-Z0-9]+",
        r"()[0-9a-f]+",
    ]
    out = []
    for k, (kind, pattern, least) in enumerate(zip(("assign", "access", "hex"), patterns, (8, 16, 32), strict=True)):
        for m in re.finditer(pattern, text or "", re.ASCII):
            if len(m[2] if kind == "assign" else m[0]) >= least:
                out.append((m.start(), k, m.end(), kind))
    return [(s, e, kind) for s, _, e, kind in sorted(out)]


def periodic_words(doc_id: int | None, text: str | None) -> list[str]:
    import zlib

    own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(own), zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return own
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [own[i] if i < a else own[a + (i - a) % p] for i in range(n)]


def runs(own: list[str]) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of some words, period by period."""
    n, out = len(own), []
    spans: list[tuple[int, int]] = []
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            if own[i] != own[i + q]:
                i += 1
                continue
            s = i
            while i < n - q and own[i] == own[i + q]:
                i += 1
            if i + q - s >= max(12, 2 * q) and not any(a <= s and i + q <= b for a, b in spans):
                out.append((s, i + q - s, q))
        spans = [(s, s + k) for s, k, _ in out]
    return sorted(out)


def without_runs(own: list[str], found: list[tuple[int, int, int]]) -> list[str]:
    gone = {i for s, k, q in found for i in range(s + q, s + k)}
    return [w for i, w in enumerate(own) if i not in gone]
