"""Plain, slow statements of what the operators must return."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import numpy as np

WORD = re.compile("[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, k):
    w = WORD.findall(lower(text))
    if not w:
        return set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


def roots(ids, links):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_documents(docs, k, num, den):
    """docs: [(id, text)] -> {id: (n, component, kept)}"""
    sets = {i: shingles(t, k) for i, t in docs}
    where = {}
    for i, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(i)
    pairs = {(min(a, b), max(a, b)) for v in where.values() if len(v) < 400 for a in v for b in v if a != b}
    links = [(a, b) for a, b in pairs if den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    root = roots(sets, links)
    return {i: (len(s), root[i], root[i] == i) for i, s in sets.items()}


def near_vectors(rows, threshold):
    """rows: [(id, vector, label)] -> [(id, n_links, component, kept)]"""
    good = []
    for n, (i, v, label) in enumerate(rows):
        if v is None or label is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        v = np.array(v, float)
        v = v / np.abs(v).max()
        good.append((n, i, v / np.sqrt((v * v).sum()), label))
    links = [(a[0], b[0]) for x, a in enumerate(good) for b in good[x + 1:] if a[3] == b[3] and len(a[2]) == len(b[2]) and a[2] @ b[2] >= threshold]
    count = {n: 0 for n in range(len(rows))}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    low = dict(roots(range(len(rows)), links))
    least = {}
    for n, r in low.items():
        least[r] = min(least.get(r, rows[n][0]), rows[n][0])
    return [(i, count[n], least[low[n]], least[low[n]] == i) for n, (i, _, _) in enumerate(rows)]


KINDS = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", "[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in hit.split(".")),
            "card": lambda: 12 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()


def base_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(KINDS):
        out += [(m.start(), k, m.end(), kind) for m in re.finditer(pattern, text or "") if valid(kind, m[0])]
    return sorted(out)


def pii_row(text):
    s = base_spans(text)
    joined = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in s)
    return tuple(sum(x[3] == k for x in s) for k, _ in KINDS), hashlib.sha256(joined.encode()).hexdigest(), joined


def merges(path):
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}


def library_ids(path, text):
    from tokenizers import Tokenizer
    t = library_ids.__dict__.setdefault(path, Tokenizer.from_file(path))
    return t.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def removed(docs, length=50):
    """docs: [(id, text)] -> {id: (n_bytes, n_removed, n_spans, sha256)}"""
    data = sorted((i, (t or "").encode()) for i, t in docs)
    first = {}
    for i, b in data:
        for p in range(len(b) - length + 1):
            first.setdefault(b[p:p + length], i)
    out = {}
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < i:
                gone[p:p + length] = b"\x01" * length
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out[i] = (len(b), sum(gone), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def quality_base(text):
    text = text or ""
    w = WORD.findall(text)
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    count = {}
    for x in windows:
        count[x] = count.get(x, 0) + 1
    rep = [False] * len(w)
    for i, x in enumerate(windows):
        if count[x] > 1:
            rep[i:i + 8] = [True] * 8
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, sum(rep), len(w) < 20 or 100 * sum(rep) > 30 * len(w))


def targets(sizes, share=1.5, most=2, weights=(5, 2, 1)):
    """{source: words} -> {source: target}, by resharing what exceeds a limit until nothing does."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    held, total = {}, sum(sizes.values()) * share
    while True:
        free = [s for s in order if s not in held]
        rest, scale = total - sum(held.values()), sum(w[s] for s in free)
        now = {s: rest * w[s] / scale for s in free}
        over = [s for s in free if now[s] >= most * sizes[s]]
        if not over:
            return held | now
        held |= {s: float(most * sizes[s]) for s in over}


# The line rules' phrases and the personal-data patterns of the operators.
PHRASES = re.compile(
    "all rights reserved|cookie policy|uses cookies|accept cookies|privacy policy|terms of (?:use|service)|enable javascript|click here"
    "|read more|subscribe to|sign up|log in|share this|back to top|licensed under|released under the|this work is licensed", re.I | re.A)
IBAN = "(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
SSN = "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"


def bad_line(line):
    w = WORD.findall(line)
    n = len(w)
    if not n:
        return False
    separators = sum(line.count(c) for c in "|>»")
    marks = sum(line.count(c) for c in ".!?:;")
    ends = re.search("[.!?:;][\"')\\]]?$", w[-1])
    return (sum(line.count(c) for c in "#*$%&|<>") > 0.3 * n or (separators >= 3 and separators >= 0.2 * n)
            or (n >= 3 and len(re.findall("!(?=!)", line)) > n / 3) or (n <= 30 and PHRASES.search(line) is not None)
            or (n > 60 and not ends and marks * 60 < n and not re.search("[…。！？]", line)))


def cleaned(text):
    """The text without its failing lines, None where the document goes."""
    figures = quality_base(text)
    if figures[-1]:
        return None
    lines = re.findall("[^\n]*\n|[^\n]+", text)
    lost = sum(len(WORD.findall(x)) for x in lines if bad_line(x.rstrip("\n")))
    return None if lost > 0.3 * figures[0] else "".join(x for x in lines if not bad_line(x.rstrip("\n")))


def mod97(hit):
    plain = hit.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def redacted(text):
    patterns = dict(KINDS) | {"iban": IBAN, "ssn": SSN}
    for kind in ("email", "phone", "card", "iban", "ssn", "ip"):
        hits = list(re.finditer(patterns[kind], text))
        out, at = [], 0
        for i, m in enumerate(hits):
            near = text[max(at, m.start() - 40):m.start()] + " " + text[m.end():min(m.end() + 40, hits[i + 1].start() if i + 1 < len(hits) else len(text))]
            ok = (mod97(m[0]) if kind == "iban" else
                  not re.search("^(000|666|9)|-00-|-0000$", m[0]) and bool(re.search("ssn|social security|tax id|security number", near.lower())) if kind == "ssn"
                  else valid(kind, m[0]))
            out += [text[at:m.start()], f"[{kind.upper()}]" if ok else m[0]]
            at = m.end()
        text = "".join(out) + text[at:]
    return text


def copies(docs):
    """docs: [(id, source, size)] -> {id: copies}: systematic sampling inside each source."""
    total = {}
    for _, s, n in docs:
        total[s] = total.get(s, 0) + n
    aim, out = targets(total), {}

    def hashed(x, digits):
        return int(hashlib.md5(x.encode()).hexdigest()[:digits], 16)

    for s, words in total.items():
        order = sorted((len(str(n)) * 100 + int(str(n)[:2]), hashed(f"0:{i}", 8), i) for i, t, n in docs if t == s)
        step, start = aim[s] / words if words else 0.0, hashed("offset:0:" + ("\0null" if s is None else s), 5) / 2 ** 20
        for rank, (_, _, i) in enumerate(order, 1):
            out[i] = int(step * rank + start) - int(step * (rank - 1) + start)
    return out


def pipeline(docs, encode):
    """docs: [(id, text, source)] with different ids -> [(id, text, source, n_chars, ids)], a row for each copy."""
    source = {i: s for i, _, s in docs}
    texts = {i: c for i, t, _ in docs if (c := cleaned(t)) is not None}
    texts = {i: redacted(texts[i]) for i, (_, _, kept) in near_documents(list(texts.items()), 5, 4, 5).items() if kept}
    n = copies([(i, source[i], len(WORD.findall(t))) for i, t in texts.items()])
    return [(i, t, source[i], len(t), tuple(encode(t))) for i, t in texts.items() for _ in range(n[i])]


def vector_codes(rows, parts=8, entries=16, rounds=6):
    """rows: [(id, vector, label)] -> ({row: (code, error)}, label errors, codebooks), every entry tried."""
    import math
    good = {n: [math.floor(4096 * x) for x in v] for n, (_, v, _) in enumerate(rows)
            if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    dim = max(1, -(-max(map(len, good.values()), default=0) // parts))
    cut = {n: [(q + [0] * (dim * parts - len(q)))[p * dim:(p + 1) * dim] for p in range(parts)] for n, q in good.items()}
    first = sorted(good, key=lambda n: (rows[n][0] is None, rows[n][0] or 0, good[n]))[:entries]
    books = [[cut[n][p] for n in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            own = [[] for _ in first]
            for q in cut.values():
                own[nearest(q[p], books[p])[1]].append(q[p])
            new.append([[sum(c) // len(o) for c in zip(*o)] if o else books[p][i] for i, o in enumerate(own)])
        books = new
    out, by_label = {}, {}
    for n, q in cut.items():
        hit = [nearest(q[p], books[p]) for p in range(parts)]
        out[n] = ("".join(f"{i:02x}" for _, i in hit), sum(d for d, _ in hit))
        by_label[rows[n][2]] = by_label.get(rows[n][2], 0) + out[n][1]
    flat = ",".join(str(x) for b in books for e in b for x in e)
    return out, by_label, hashlib.sha256(flat.encode()).hexdigest()


def line_dedup(docs):
    """docs: [(id, text)] -> [(id, n_lines, n_dropped, sha256)]; null ids are one document, below all others."""
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip("\t\n\x0b\x0c\r "))

    where = {}
    for i, t in docs:
        for line in (t or "").split("\n"):
            where.setdefault(key(line), set()).add(i)
    top = {k: max(x for x in ids if x is not None) for k, ids in where.items() if len(k) >= 20 and len(ids) >= 3}
    out = []
    for i, t in docs:
        all_ = (t or "").split("\n")
        stay = [x for x in all_ if key(x) not in top or top[key(x)] == i]
        out.append((i, len(all_), len(all_) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return out


def lexical(docs, items, k=10):
    """docs: [(id, text)], items: distinct [(id, text)] -> [(item_id, rank, doc_id, score)]"""
    import math
    from collections import Counter

    def found(text):
        return Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text)))

    rows = [(i, c) for i, c in ((i, found(t)) for i, t in docs) if c]
    n, length = len(rows), sum(sum(c.values()) for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in rows:
            m = 25 + 75 * sum(c.values()) * n // length
            s = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t, times in found(text).items() if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k])]
    return out
