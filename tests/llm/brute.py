"""Plain Python versions of the pipeline operators, for small tables."""

import hashlib
import random
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def awkward_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, shared
    ids and shared passages."""
    rnd = random.Random(5)
    vocab = ["".join(rnd.choice("abcdefghéñß") for _ in range(rnd.randint(1, 7))) for _ in range(300)]
    say = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    passage, line = say(20), "\n".join(say(6) for _ in range(4))
    rows = []
    for i in range(60):
        t = "\n".join(say(rnd.randint(1, 12)) for _ in range(rnd.randint(1, 8)))
        if i % 3 == 0:
            t = t + " " + passage + " " + say(3)
        if i % 4 == 0:
            t = t + "\n" + line + "\n" + say(4)
        rows.append((i, t, rnd.choice(["en", "fr", None]), rnd.choice(["hot", "hot", "b", None]), len(t)))
    base = rows[9][1]
    rows += [(100, base, "en", "hot", len(base)), (101, base + " ", "en", "hot", None), (102, base.replace(" ", "\n", 1), "en", "b", 3),
             (100, base, "en", "hot", len(base)), (100, base + " tail words", None, None, 1), (None, base, "en", "hot", 1),
             (None, None, None, None, None), (None, say(30), None, "b", 5), (103, None, "en", "hot", None), (104, "", "en", "hot", 0),
             (105, " \n\t ", "fr", "b", 4), (106, "\n\n\n\n", "fr", "b", 4), (107, "a a a a a a a a a a a a a a a a", "en", "b", 1),
             (108, "x\nx\nx\nx\nx\nx", "en", "b", 1), (109, "12 34 !!", "en", "b", 1), (110, say(9000), "en", "hot", 1),
             (111, say(40) + " token = \"" + "0af3" * 10 + "\" login: bob99 key Zx9Qw8Er7Ty6Ui5Op4As3D", "en", "b", 1),
             (112, "é" * 5 + " ASIA" + "Q7" * 8 + " " + say(3) + " Zx9Qw8Er7Ty6Ui5Op4As3D " + say(200) + " Aa1" * 9 + " Zx9Qw8Er7Ty6Ui5Op4As3E", "en", "b", 1),
             (113, "api_key: AKIA" + "B7" * 9 + " https://host.example/x?y PassWord='abcdefgh1'", "en", "b", 1)]
    return rows


def words(t):
    return WORD.findall(t or "")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def line_dedup(rows, window=3):
    """[(doc_id, text)] -> [(doc_id, new text, lines, removed)]."""
    order = lambda i: 2 ** 63 - 1 if i is None else i
    first, spots = {}, []
    for i, t in rows:
        lines = t.split("\n") if t is not None else []
        for p in range(len(lines) - window + 1):
            w = tuple(lines[p:p + window])
            if any(WORD.search(s) for s in w):
                first[w] = min(first.get(w, (order(i), p)), (order(i), p))
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, None, 0, 0))
            continue
        lines = t.split("\n")
        gone = set()
        for p in range(len(lines) - window + 1):
            w = tuple(lines[p:p + window])
            if w in first and (order(i), p) > first[w]:
                gone |= set(range(p, p + window))
        out.append((i, "\n".join(s for k, s in enumerate(lines) if k not in gone), len(lines), len(gone)))
    return out


def fingerprint(t, shingle=3):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    if not w:
        return 0
    runs = [" ".join(w[k:k + shingle]) for k in range(max(1, len(w) - shingle + 1))]
    ones = [0] * 64
    for s in runs:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(runs))


def _roots(fp, radius):
    label = list(range(len(fp)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    for a in range(len(fp)):
        for b in range(a):
            if bin(fp[a] ^ fp[b]).count("1") <= radius:
                label[max(root(a), root(b))] = min(root(a), root(b))
    return [root(k) for k in range(len(fp))]


def simhash(rows, radius=3):
    """[(doc_id, text)] -> [(doc_id, hex, component)]."""
    fp = [fingerprint(t) for _, t in rows]
    root, least = _roots(fp, radius), {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root[k]] = min(least.get(root[k], i), i)
    return [(i, f"{fp[k]:016x}", least.get(root[k])) for k, (i, _) in enumerate(rows)]


def one_per_component(rows, radius=3):
    """How often each doc_id stays: once for each component that it names."""
    groups = {}
    for (i, _), r in zip(rows, _roots([fingerprint(t) for _, t in rows], radius)):
        groups.setdefault(r, []).append(i)
    return Counter(min((i for i in g if i is not None), default=None) for g in groups.values())


def substrings(rows, window=13):
    """[(doc_id, text)] -> [(doc_id, words, removed, sha of kept)]."""
    order = lambda i: 2 ** 63 - 1 if i is None else i
    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - window + 1):
            g = tuple(w[k:k + window])
            first[g] = min(first.get(g, order(i)), order(i))
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < order(i):
                gone[k:k + window] = [True] * window
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def measures(t):
    t = t or ""
    w = words(t)
    lines = [s for s in t.split("\n") if WORD.search(s)]
    runs = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
    again = {r for r in runs if runs.count(r) > 1} if len(runs) < 500 else set()
    hit = {k + j for k, r in enumerate(runs) if r in again for j in range(5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit)


def exact(rows):
    """[(doc_id, text)] -> [(doc_id, keep_id, size, kept, sha)]."""
    groups = {}
    for i, t in rows:
        groups.setdefault("".join(words(t)), []).append((-len(t or ""), i is None, i or 0, i, t))
    best = {s: min(g, key=lambda x: x[:3]) for s, g in groups.items()}
    out = []
    for i, t in rows:
        s = "".join(words(t))
        out.append((i, best[s][3], len(groups[s]), i == best[s][3] and -len(t or "") == best[s][0], sha(s)))
    return out


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def base_spans(t):
    t = t or ""
    s = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    s += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    s += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(s)


def weak_spans(t):
    t = t or ""
    ids = r"(?i:(?:client|access|account|user|login)[_-]?(?:key[_-]?id|id|name))[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@-]{3,}|A(?:SIA|ROA|IDA|GPA)[A-Z0-9]{12,}"
    s = [(m.start(), 3, "weak_id", m.end()) for m in re.finditer(ids, t, re.A)]
    s += [(m.start(), 4, "weak_key", m.end()) for m in re.finditer(r"[A-Za-z0-9+/_-]{20,}={0,2}", t)
          if re.search("[0-9]", m[0]) and re.search("[A-Z]", m[0]) and re.search("[a-z]", m[0])]
    ends = r"""(?:https?|s3|ftp|jdbc:[a-z]+)://[^\s"'<>]+|[A-Za-z0-9.-]+\.amazonaws\.com"""
    s += [(m.start(), 5, "weak_endpoint", m.end()) for m in re.finditer(ends, t)]
    base = base_spans(t)
    return [w for w in s if not any(b[0] < w[3] and w[0] < b[3] for b in base)]


def gap(p, w):
    """Code points between two spans, None where they overlap."""
    if p[3] <= w[0]:
        return w[0] - p[3]
    return p[0] - w[3] if w[3] <= p[0] else None


def all_spans(t, scope=200):
    """Every pair of parts is tried, by the gap between them."""
    base, weak = base_spans(t), weak_spans(t)
    role = {"access": "id", "assign": "secret", "hex": "secret", "weak_id": "id", "weak_key": "secret", "weak_endpoint": "endpoint"}
    need = {"weak_id": {"secret"}, "weak_key": {"id", "endpoint"}, "weak_endpoint": {"secret"}}
    hit = [w for w in weak if any(role[p[2]] in need[w[2]] and (g := gap(p, w)) is not None and g <= scope for p in base + weak)]
    return sorted(base + hit)


def show(spans):
    return ",".join(f"{k}:{a}:{z}" for a, _, k, z in spans)


def redact(t, scope=200, mark="[SECRET]"):
    if t is None:
        return None
    runs = []
    for a, _, _, z in sorted(all_spans(t, scope)):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], z)
        else:
            runs.append([a, z])
    out, at = "", 0
    for a, z in runs:
        out, at = out + t[at:a] + mark, z
    return out + t[at:]


def best_fit(sizes, lengths, cost):
    """Every open bin and every waiting item is looked at for every item."""
    fit = lambda n: min(x for x in lengths if x >= n)
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    room, used, where = [], [], {}
    for k, i in enumerate(order):
        s = sizes[i]
        open_bins = [(r, b) for b, r in enumerate(room) if r >= s]
        if open_bins:
            tight = min(r for r, _ in open_bins)
            b = {"any": [b for r, b in open_bins if r == tight]}["any"][0]
        else:
            price = {}
            for x in lengths:
                if x >= s:
                    left = x - s
                    for j in order[k + 1:]:
                        if sizes[j] <= left:
                            left -= sizes[j]
                    price[x] = (cost(fit(x - left)) / (x - left), x)
            b = len(room)
            room.append(min(price.values())[1])
            used.append(0)
        where[i] = (b, used[b])
        used[b] += s
        room[b] -= s
    return len(used), sorted(used), sorted(fit(u) for u in used), where
