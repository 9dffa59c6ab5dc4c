"""Plain single-machine versions of the text operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

UPPER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(text or "")


def shingles(text, n=5):
    w = words((text or "").translate(UPPER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(max(len(w) - n, 0) + 1))


def jaccard(rows, n=5, percent=75):
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows, sorted."""
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    common = Counter()
    for own in by.values():
        for j, b in enumerate(own):
            for a in own[:j]:
                common[a, b] += 1
    for (a, b), c in common.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            parent[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(least[r], d)
    return sorted(((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)), key=repr)


def suffixes(rows, length=400):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    texts = [(t or "").encode("utf-8", "surrogatepass") for _, t in rows]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (d, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((d, len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def leaks(rows, items, size=10):
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    norm = lambda t: BENCH_WORD.findall((t or "").translate(UPPER))
    owners = defaultdict(set)
    for item, t in items:
        w = norm(t)
        for i in range(max(len(w) - size, 0) + 1 if w else 0):
            owners[tuple(w[i:i + size])].add(str(item))
    sizes = sorted({len(k) for k in owners})
    out = []
    for d, t in rows:
        w, hit, found = norm(t), set(), set()
        for i in range(len(w)):
            for n in sizes:
                own = owners.get(tuple(w[i:i + n])) if i + n <= len(w) else None
                if own:
                    found |= own
                    hit.update(range(i, i + n))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def quality(rows):
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    out = []
    for d, t in rows:
        t = t or ""
        w = words(t)
        seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        cover = {j for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
        lines, dup = set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in lines
                lines.add(line)
        out.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover), len(w) < 10 or 100 * len(cover) > 20 * len(w)))
    return sorted(out, key=repr)


def tokens(rows, path, end=2):
    """(doc_id, start, n_tokens, ids_crc32) of rows in order of their id."""
    import numpy as np
    from tokenizers import Tokenizer
    tok, start, out = Tokenizer.from_file(path), 0, []
    for d, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, end]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def urls(rows):
    """(page_id, host, path, rule)."""
    out = []
    for p, u in rows:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (m[1].translate(UPPER), m[2]) if m else ("", "")
        fit = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        best = max(fit, key=lambda r: len(r[1] + r[2]), default=None)
        out.append((p, host, path, best and best[1] + best[2]))
    return sorted(out, key=repr)


def quotes(rows):
    """(conv, turn, n_linked, quoted_conv, quoted_turn, reply_to) of (conv, turn, role, text) rows of distinct turns."""
    norm = lambda t: " ".join(WORD.findall(t.translate(UPPER)))
    order = lambda k: (k[0] is not None, k[0] or 0, k[1])
    units, runs = {}, {}
    for c, t, _, text in rows:
        cut = []
        for x in (text or "").split("\n"):
            mark = re.match(r"((?:[ \t]*>)+)[ \t]?", x)
            level = mark[1].count(">") if mark else 0
            if not cut or cut[-1][0] != level:
                cut.append((level, []))
            cut[-1][1].append(x[mark.end():] if mark else x)
        body = "\n".join(x for level, own in cut if not level for x in own)
        own = [body, *re.split(r"\n[ \t]*\n", body), *body.split("\n"), *("\n".join(x) for level, x in cut if not level)]
        units[c, t] = {norm(u) for u in own} - {""}
        runs[c, t] = [(level, "\n".join(x)) for level, x in cut if level]
    whole = lambda run, k: norm(run) in units[k]

    def apart(run, k):
        pars = [p for p in re.split(r"\n[ \t]*\n", run) if norm(p)]
        return bool(pars) and all(norm(p) in units[k] or all(norm(x) in units[k] for x in p.split("\n") if norm(x)) for p in pars)

    out = []
    for (c, t), own in runs.items():
        links = []
        for nr, (level, run) in enumerate(own):
            for far, holds in ((0, whole), (0, apart), (1, whole), (1, apart)):
                fits = [k for k in units if holds(run, k) and (k[0] == c and k[1] < t if not far else k[0] != c)]
                if fits:
                    links.append((far, level, nr, min(fits, key=order)))
                    break
        far, _, _, to = min(links, key=lambda x: x[:3]) if links else (None, None, None, (None, None))
        out.append((c, t, len(links), *to, to[1] if far == 0 else None))
    return out


def merkle(rows, arity=16):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of (doc_id, text, lang, source, n_chars) rows."""
    h = lambda *x: hashlib.sha256("".join(x).encode()).hexdigest()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf_of = lambda d, t, la, s, n: h(*map(field, (d, s, la, n, t)))

    def tree(own):  # root of digests, and per digest the siblings (left, right) of each level
        paths, at = [[] for _ in own], list(range(len(own)))
        while len(own) > 1:
            for p, i in zip(paths, at):
                low = i // arity * arity
                p.append((own[low:i], own[i + 1:low + arity]))
            own, at = [h(*own[i:i + arity]) for i in range(0, len(own), arity)], [i // arity for i in at]
        return own[0], paths

    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append((r[0], leaf_of(*r), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for s in names:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        made[s] = tree([x[1] for x in groups[s]])
    if not names:
        return []
    root, over = tree([made[s][0] for s in names])
    out = []
    for s, upper in zip(names, over):
        for (d, leaf, r), path in zip(groups[s], made[s][1]):
            hit = d is not None and zlib.crc32(str(d).encode()) % 5 == 0
            cur = leaf_of(d, r[1] and r[1].translate(UPPER), *r[2:]) if hit else leaf
            proof = path + upper
            for left, right in proof:
                cur = h(*left, cur, *right)
            out.append((d, leaf, made[s][0], root, h(*(x for left, right in proof for x in left + right)), cur, cur == root))
    return sorted(out, key=repr)


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def search(rows, items, top=50):
    """(item_id, rank, doc_id, score) of (doc_id, text) rows and (item_id, text) items."""
    from math import floor, log
    own = [(d, Counter(TERM.findall((t or "").translate(UPPER)))) for d, t in rows]
    own = [(d, c, sum(c.values())) for d, c in own if c]
    n_docs, n_terms = len(own), sum(n for _, _, n in own)
    df = Counter(w for _, c, _ in own for w in c)
    out = []
    for item, t in items:
        q = {w: floor(1000 * log((2 * n_docs + 2) / (2 * df[w] + 1))) for w in TERM.findall((t or "").translate(UPPER))}
        got = []
        for d, c, n in own:
            m = 50 + 50 * n * n_docs // n_terms
            s = sum(w * (1_000_000_000 * c[x] // (1000 * c[x] + 20 * m)) for x, w in q.items() if x in c)
            if s > 0:
                got.append((-s, d is not None, d or 0, d))
        out += [(item, k, g[3], -g[0]) for k, g in enumerate(sorted(got, key=lambda g: g[:3])[:top], 1)]
    return sorted(out, key=repr)
