"""The operators' answers worked out plainly, for small input."""

import hashlib
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text, kind):
    return kind.findall((text or "").translate(LOWER))


def groups(nodes, links):
    top = {n: n for n in nodes}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text):
    own = words(text, SPACED)
    if len(own) < 5:
        return {tuple(own)} if own else set()
    return {tuple(own[k: k + 5]) for k in range(len(own) - 4)}


def near_duplicates(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    links = [
        (a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i]
        if a is not None and b is not None and a != b and x and y and 100 * len(x & y) >= 75 * len(x | y)
    ]
    comp = groups({d for d, _ in rows if d is not None}, links)
    return [(d, len(s), comp.get(d), d is None or comp[d] == d) for d, s in sets]


def contaminated(rows, items, size=10):
    windows = set()
    for item, text in items:
        own = words(text, ALNUM)
        for k in range(max(1, len(own) - size + 1)) if own and item is not None else ():
            windows.add((str(item), tuple(own[k: k + size])))
    out = []
    for d, text in rows:
        own, hit, found = words(text, ALNUM), set(), set()
        for item, window in windows:
            for k in range(len(own) - len(window) + 1):
                if tuple(own[k: k + len(window)]) == window:
                    hit.update(range(k, k + len(window)))
                    found.add(item)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(own), len(hit), len(found), digest, bool(hit)))
    return out


def repeated_bytes(rows, n=50):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - n + 1) if d is not None else ():
            first[b[p: p + n]] = min(first.get(b[p: p + n], d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1) if d is not None else ():
            if first[b[p: p + n]] < d:
                gone[p: p + n] = b"\x01" * n
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


PII = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
)


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c)
        total += (v * 2 - 9 if v > 4 else v * 2) if k % 2 else v
    return total % 10 == 0


def personal(text):
    out = []
    for kind, pattern in PII:
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "phone": 9 <= len(digits) <= 15,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        below = [i]
        for j, y in enumerate(b, 1):
            below.append(min(row[j] + 1, below[-1] + 1, row[j - 1] + (x != y)))
        row = below
    return row[-1]


def personal_contexts(rows, pii):
    """(doc number, kind, start, end) of spans that contexts add, round by round over plain dictionaries."""
    import regex

    anything = regex.compile("|".join([*(pii.PATTERNS[k] for k in pii.KINDS), pii.CANDIDATE]))
    mentions = []
    for number, text in enumerate(rows):
        last = 0
        for found in anything.finditer(text):
            value, left = found[0], regex.search(pii.LAST_TWO, text[last: found.start()])
            last = found.end()
            kind = next((k for k, a, b in personal(value) if (a, b) == (0, len(value))), None)
            if kind is None and regex.fullmatch(pii.SEED_PATTERNS["secret"], value):
                kind = "secret"
            if kind is None and any(regex.search(g, value) for g in pii.GUARDS.values()):
                continue
            if left:
                two = regex.sub(r"\s+", " ", regex.sub("[0-9]+", "0", left[0].lower()))
                one = regex.search(pii.LAST_ONE, two)[0]
                for pattern in {"1 " + one} | ({"2 " + two} if one != two else set()):
                    mentions.append((number, found.start(), found.end(), value, kind, pattern))
    of_pattern, of_value = {}, {}
    for *_, value, _, pattern in mentions:
        of_pattern.setdefault(pattern, set()).add(value)
        of_value.setdefault(value, set()).add(pattern)
    seeds = {m[3]: (m[4], 1.0) for m in mentions if m[4]}
    sure, patterns = dict(seeds), {}
    for _ in range(pii.ROUNDS):
        patterns = {}
        for pattern, values in of_pattern.items():
            for kind in (*pii.KINDS, *pii.ADDED_KINDS):
                own = [sure[v][1] for v in values if sure.get(v, ("",))[0] == kind]
                if len(own) >= pii.LEAST_VALUES and sum(own) / (len(values) + 1) >= pii.PATTERN_FROM:
                    patterns[pattern] = (kind, sum(own) / (len(values) + 1))
        sure = dict(seeds)
        for value in of_value.keys() - seeds.keys():
            doubt = {}
            for pattern in of_value[value] & patterns.keys():
                kind, worth = patterns[pattern]
                doubt[kind] = doubt.get(kind, 1.0) * (1 - worth)
            best = max(((1 - x, k) for k, x in doubt.items()), default=(0, ""))
            if best[0] >= pii.VALUE_FROM:
                sure[value] = (best[1], best[0])
    out = set()
    for number, start, end, value, kind, pattern in mentions:
        if kind not in pii.KINDS and value in sure and patterns.get(pattern, ("",))[0] == sure[value][0]:
            if not any(a < end and start < b for _, a, b in personal(rows[number])):
                out.add((number, sure[value][0], start, end))
    return out
