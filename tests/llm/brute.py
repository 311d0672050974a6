"""Plain single-machine versions of the operators' contracts."""

import hashlib
import math
import re
import zlib
from collections import Counter

SPACES = " \t\n\x0b\f\r"
SOLID = re.compile("[^\x20\x09-\x0d]+")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def line_dedup(docs, least=10):
    key = lambda x: lower(x.strip(SPACES))
    held = Counter(k for _, t in docs for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or held[key(x)] < least]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def licenses(docs):
    phrases = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}
    out = []
    for i, t in docs:
        w = WORD.findall(lower(t or ""))
        at = [(k, label) for k in range(len(w)) for p, label in phrases.items() if tuple(w[k : k + len(p)]) == p]
        starts = [k for k, _ in at]
        out.append((i, len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))))
    return out


def contamination(docs, items, window=10):
    found = {}
    for item, t in items:
        w = WORD.findall(lower(t or ""))
        for k in range(max(1, len(w) - window + 1)) if w else ():
            found.setdefault(tuple(w[k : k + window]), set()).add(str(item))
    sizes, out = {len(w) for w in found}, []
    for i, t in docs:
        w, hit, of = WORD.findall(lower(t or "")), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in found:
                    hit.update(range(k, k + n))
                    of |= found[x]
        out.append((i, len(w), len(hit), len(of), sha(",".join(sorted(of))), bool(hit)))
    return out


def chats(rows):
    talks = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: tuple((x is not None, x) for x in r)):
        talks.setdefault(conv, []).append((role or "", text or ""))
    out = []
    for conv, turns in talks.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)))
    return out


def quality(docs):
    out = []
    for i, t in docs:
        t = t or ""
        w = SOLID.findall(t)
        times = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        hit = {k + j for k in range(len(w) - 2) if times[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if SOLID.search(x)]
        failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
        out.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit), failed))
    return out


def longest_repeat(words):
    n, best = len(words), 0
    for a in range(n):
        for b in range(a + 1, n):
            k = 0
            while b + k < n and words[a + k] == words[b + k]:
                k += 1
            best = max(best, k)
    return best


def shingles(t):
    w = SOLID.findall(lower(t or ""))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def near_duplicates(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    root = {i: i for i, _ in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    held = {}
    for k, (_, s) in enumerate(sets):
        for x in s:
            held.setdefault(x, []).append(k)
    pairs = {(a, b) for h in held.values() for a in h for b in h if a < b}
    for a, b in pairs:
        (i, s), (j, u) = sets[a], sets[b]
        if 100 * len(s & u) >= 75 * len(s | u):
            x, y = sorted((top(i), top(j)))
            root[y] = x
    return [(i, len(s), top(i), top(i) == i) for i, s in sets]


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def unigrams(docs):
    learn = [(i, SOLID.findall(lower(t or ""))) for i, t in docs]
    count = Counter()
    for i, w in learn:
        if fold(i, 10):
            count.update([*w, None])
    total, distinct = sum(count.values()), len(count)
    one = lambda c: math.log10((c + 0.1) / (total + 0.1 * (distinct + 1)))
    return [
        (i, fold(i, 10) == 0, len(w) + 1, sum(count[x] > 0 for x in [*w, None]), total, sum(one(count[x]) for x in [*w, None]))
        for i, w in learn
    ]


def tokens(docs, path, end):
    import numpy as np
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return [(i, np.array([*t.encode(x or "", add_special_tokens=False).ids, end], "<u4")) for i, x in docs]


def leaf(row):
    cell = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha("".join(cell(v) for v in row))


def tree(leaves, arity=2):
    """The root and, for each leaf, the siblings on its way as (left, right) texts."""
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([sha("".join(x[k : k + arity])) for k in range(0, len(x), arity)])
    proofs = []
    for k in range(len(leaves)):
        steps = []
        for x in levels[:-1]:
            run = k - k % arity
            steps.append(("".join(x[run:k]), "".join(x[k + 1 : run + arity])))
            k //= arity
        proofs.append(steps)
    return levels[-1][0], proofs


def manifest(rows, arity=2):
    """(doc_id, leaf, subroot, root, proof) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], arity) for g in order}
    root, upper = tree([trees[g][0] for g in order], arity) if order else (None, [])
    return [
        (x[3][0], x[2], trees[g][0], root, [*proof, *up])
        for g, up in zip(order, upper, strict=True)
        for x, proof in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1], strict=True)
    ]


def fold_proof(node, proof):
    for left, right in proof:
        node = sha(left + node + right)
    return node


def grams(text):
    w = WORD.findall(lower(text or ""))
    return [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))], len(w)


def resample(docs, items, buckets=10_000, least=20, share=25, seed=7):
    of = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = (Counter(of(g) for _, x in rows for g in grams(x)[0]) for rows in (docs, items))
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets))))
    rows = []
    for k, (i, x) in enumerate(docs):
        g, n_words = grams(x)
        weight = sum(gain(of(y)) for y in g) // len(g) if g else 0
        h = int(sha(f"{seed}:{'' if i is None else i}")[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append((k, i, n_words, len(g), weight, score))
    large = sorted((r for r in rows if r[2] >= least), key=lambda r: (-r[5], r[1] is None, r[1] or 0, r[0]))
    rank = {r[0]: k + 1 for k, r in enumerate(large[: share * len(large) // 100])}
    return [(i, n, g, w, sc, rank.get(k)) for k, i, n, g, w, sc in rows]


def repeats(docs, window=50):
    """(doc_id, n_words, n_removed, spans, kept_text); a null id counts as the largest."""
    key = lambda i: 2**63 - 1 if i is None else i
    split, first = [(i, SOLID.findall(t or "")) for i, t in docs], {}
    for i, w in split:
        for k in range(len(w) - window + 1):
            x = tuple(w[k : k + window])
            first[x] = min(first.get(x, key(i)), key(i))
    out = []
    for i, w in split:
        gone = {k + j for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < key(i) for j in range(window)}
        spans = []
        for k in sorted(gone):
            if spans and spans[-1][1] == k:
                spans[-1][1] = k + 1
            else:
                spans.append([k, k + 1])
        out.append((i, len(w), len(gone), spans, " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out
