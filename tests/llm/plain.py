"""Plain Python versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def shingles(text, width=5):
    w = words((text or "").translate(FOLD))
    if len(w) < width:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1))


def components(rows, percent=80, width=5):
    """(doc_id, set size, smallest linked doc_id) for rows of (doc_id, text) with distinct ids."""
    sets = {i: shingles(t, width) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return sorted((i, len(sets[i]), root(i)) for i in ids)


def repetition(text, min_repeat=8):
    w, text = words(text), text or ""
    windows = Counter(zip(w, w[1:], w[2:]))
    marked = [False] * len(w)
    for k in range(len(w) - 2):
        if windows[tuple(w[k : k + 3])] > 1:
            marked[k] = marked[k + 1] = marked[k + 2] = True
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    order = sorted(range(len(w)), key=lambda k: w[k:])
    best = [0] * len(w)
    for a, b in zip(order, order[1:]):
        n = 0
        while max(a, b) + n < len(w) and w[a + n] == w[b + n]:
            n += 1
        best[a], best[b] = max(best[a], n), max(best[b], n)
    covered = [False] * len(w)
    for k, n in enumerate(best):
        if n >= min_repeat:
            covered[k : k + n] = [True] * n
    return (
        len(w),
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text)),
        again,
        sum(marked),
        sum(covered),
        max([0, *(n for n in best if n >= min_repeat)]),
    )


_KEY = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in ("password", "passwd", "secret", "token"))
ASSIGN = re.compile(
    rf"(?:{_KEY}|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def normal(text):
    return " ".join("".join(c if c.isalnum() else " " for c in (text or "").lower()).split())


def spelling(rows):
    """word -> (form, root, n, near words, n of the form) for rows of (doc_id, text)."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    shorter = defaultdict(set)
    for w in counts:
        for v in (w, *(w[:k] + w[k + 1 :] for k in range(len(w)))):
            shorter[v].add(w)
    partners = defaultdict(set)
    for group in shorter.values():
        for a in group:
            partners[a] |= {b for b in group if near(a, b)}
    form = {}
    for w, n in counts.items():
        best = min(partners[w], key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 5 * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, len(partners[w]), counts.get(form.get(w))) for w, n in counts.items()}


def prefix_nodes(rows):
    """The nodes of rebuilt conversations from rows of (conv_id, turn, role, text)."""
    told = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            told[conv_id].append((turn is not None, turn or 0, role, digest, text))
    for turns in told.values():
        turns.sort()
    whole = {}
    for conv_id, turns in told.items():
        h = zlib.crc32(str(conv_id).encode()) % 9
        base = conv_id - int(math.fmod(conv_id, 5))
        whole[conv_id] = tuple((t[2], t[4]) for t in told.get(base, [])[:h] + turns[h:])
    members, children = defaultdict(list), defaultdict(set)
    for conv_id, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(conv_id)
            if d:
                children[turns[: d - 1]].add(turns[:d])
    leaves, saved = Counter(), Counter()
    for node, own in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(own) - 1) * len(node[-1][1].encode()) if node else 0
    out = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if whole[c] == node)
        parent = min(members[node[:-1]]) if node else None
        sums = (len(own), len(children[node]) if node in children else 0, leaves[node], saved[node])
        out.append((min(own), len(node), parent, *sums, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def permutation_ranks(elements, lanes, draw):
    """Each lane's least rank, by the plain definition: a whole permutation for every element."""
    least = [math.inf] * lanes
    for e in elements:
        order = list(range(lanes))
        for j in range(lanes):
            k, r = draw(e, j)
            order[j], order[k] = order[k], order[j]
            least[order[j]] = min(least[order[j]], j + r)
    return least
