"""Plain single-machine versions of what the operators compute, and test rows."""

from __future__ import annotations

import hashlib
import re

import xxhash

from mercadal.session import local_table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, extra=()):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)] + list(extra)
    return local_table(spark, rows, DOCS)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lower_ascii(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(docs, items):
    """(n_words, n_hit, n_items, items_sha256, contaminated) per text."""
    windows = {}
    for item_id, text in items:
        words = WORD.findall(lower_ascii(text or ""))
        n = min(13, len(words))
        for i in range(len(words) - n + 1) if n else []:
            windows.setdefault(tuple(words[i : i + n]), set()).add(str(item_id))
    sizes = {len(w) for w in windows}
    out = []
    for text in docs:
        words = WORD.findall(lower_ascii(text or ""))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                ids = windows.get(tuple(words[i : i + n]))
                if ids:
                    hit.update(range(i, i + n))
                    found |= ids
        k = len(hit)
        out.append((len(words), k, len(found), sha(",".join(sorted(found))), k > 0 and 20 * k >= len(words)))
    return out


def simhash(text) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_reachable(ids, prints):
    """Least id reachable by links of three bits or fewer, by repeated sweeps."""
    distinct = sorted(set(prints))
    label = {p: min(i for i, q in zip(ids, prints, strict=True) if q == p) for p in distinct}
    links = [(a, b) for k, a in enumerate(distinct) for b in distinct[k + 1 :] if (a ^ b).bit_count() <= 3]
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return [label[p] for p in prints]


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return 13 <= len(number) <= 19 and total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in KINDS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                "card": luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out
