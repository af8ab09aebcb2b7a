"""Plain versions of the contracts, row by row, to hold the queries against."""

from __future__ import annotations

import hashlib
import re
import zlib

RULES = ["allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/"]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def url(value):
    """Host, path, rule."""
    if value is None or "://" not in value:
        return "", "", None
    rest = value.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = ascii_lower(host)
    best = None
    for rule in RULES:
        name = rule.split(" ")[1]
        domain, _, begin = name.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + begin):
            best = rule if best is None or len(name) > len(best.split(" ")[1]) else best
    return host, path, best


SECRETS = [
    ("assign", re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]


def secrets(text):
    """Counts by kind and the digest."""
    found = []
    for rank, (kind, pattern, group, least) in enumerate(SECRETS):
        for match in pattern.finditer(text or ""):
            if len(match[group]) >= least:
                found.append((match.start(), rank, kind, match.end()))
    counts = tuple(sum(f[2] == kind for f in found) for kind, *_ in SECRETS)
    return counts, sha(",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)))


def words(text):
    return WORD.findall(ascii_lower(text or ""))


def leaks(docs: dict, items: list, window: int = 10):
    """doc id to (n_words, n_hit, item ids)."""
    windows: dict = {}
    for name, text in items:
        if text is None:
            continue
        w = words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).update([] if name is None else [str(name)])
    sizes = {len(w) for w in windows}
    out = {}
    for doc, text in docs.items():
        w, hit, names = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                found = windows.get(tuple(w[i : i + size]))
                if found is not None:
                    hit.update(range(i, i + size))
                    names |= found
        out[doc] = len(w), len(hit), sorted(names)
    return out


def crc(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def simhash(text, shingle=3):
    import xxhash

    found = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    if not found:
        return 0
    size = min(shingle, len(found))
    hashes = [xxhash.xxh64_intdigest(" ".join(found[i : i + size]), 42) for i in range(len(found) - size + 1)]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def classes(prints: dict, bits: int = 2) -> dict:
    """Smallest key that a chain of values at ``bits`` or fewer differing bits reaches."""
    least = {}
    for key in sorted(prints):
        if key in least:
            continue
        least[key], todo = key, [key]
        while todo:
            at = todo.pop()
            for other in prints:
                if other not in least and (prints[at] ^ prints[other]).bit_count() <= bits:
                    least[other] = key
                    todo.append(other)
    return least


def repeats(texts: list, length: int):
    """Of each text, (bytes, removed spans, kept bytes)."""
    from collections import Counter

    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        spans = [(m.start(), m.end() - m.start()) for m in re.finditer(b"\x01+", bytes(gone))]
        out.append((len(d), spans, bytes(b for b, g in zip(d, gone, strict=True) if not g)))
    return out


def aligned(text, a_tokenizer, b_model):
    """A ids, B ids and the groups of both as (A ids, B ids); nothing where either spells another text."""
    if not text:
        return [], [], []
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names = {chr(b): b for b in plain}
    names |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    a = a_tokenizer.encode(" " + text, add_special_tokens=False).ids
    b = b_model.encode(text)
    a_bytes = [bytes(names[c] for c in a_tokenizer.id_to_token(i)) for i in a]
    pieces = [(i, b_model.id_to_piece(i)) for i in b]
    b_bytes = [bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return [], [], []
    groups, mine, yours, i, j, at, to = [], [], [], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if at <= to and i < len(a):
            mine.append(a[i])
            at += len(a_bytes[i])
            i += 1
        else:
            yours.append(b[j])
            to += len(b_bytes[j])
            j += 1
        if at == to:
            groups.append((mine, yours))
            mine, yours = [], []
    return a, b, groups


def link_counts(groups_of: list) -> list:
    """For each text's groups, (links, links whose count is the highest of their B id, sum of counts)."""
    from collections import Counter

    links = [[(g[0][-1], g[1][-1]) for g in groups] for groups in groups_of]
    count = Counter(pair for text in links for pair in text)
    most: dict = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    return [(len(t), sum(count[p] == most[p[1]] for p in t), sum(count[p] for p in t)) for t in links]


def licenses(text, templates):
    """Number of words; places of phrases by template number; containment of notices that reach theirs."""
    w = words(text)
    found = {}
    notices = [t for t in templates if not t.phrase]
    stride = max((len(t.words) for t in notices), default=1)
    for number, t in enumerate(templates):
        if t.phrase:
            size = len(t.words)
            at = [i for i in range(len(w) - size + 1) if w[i : i + size] == t.words]
            if at:
                found[number] = at
        else:
            parts = [set(w[k : k + 2 * stride - 1]) for k in range(0, len(w), stride)]
            best = max((len(set(t.words) & p) / len(set(t.words)) for p in parts), default=0)
            if best >= t.containment:
                found[number] = best
    return len(w), found


def divergence(rows: list, least: int, top: int):
    """Rows (lang, source, part, item, value, rank) of (text, lang, source)."""
    from collections import Counter, defaultdict

    counts, totals, held, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", ascii_lower(text or ""))
        groups.add((lang, source))
        counts[lang, source].update(found)
        totals[lang].update(found)
        held[lang].update(set(found))
    out = []
    for lang, source in groups:
        kept = [t for t, n in held[lang].items() if n >= least]

        def price(counter, kept=kept):
            n = sum(counter[t] for t in kept)
            return {t: 1 + 10**9 * (counter[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p, q = price(counts[lang, source]), price(totals[lang])
        others = [s for g, s in groups if g == lang and s != source]
        pairs = [(s, sum(abs(p[t] - x) for t, x in price(counts[lang, s]).items())) for s in others]
        terms = [(t, p[t] - q[t]) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, item, value, rank + 1) for rank, (item, value) in enumerate(ranked)]
    return sorted(out)
