"""Plain row-at-a-time versions of the operators' rules, to compare with."""

from __future__ import annotations

import hashlib
import re

FORMS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, int, str]]:
    out = []
    for rank, (kind, form) in enumerate(FORMS.items()):
        for m in form.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def pii_row(text: str | None) -> dict:
    spans = base_spans(text)
    listed = ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)
    return {f"n_{k}": sum(x[3] == k for x in spans) for k in FORMS} | {"base_sha256": hashlib.sha256(listed.encode()).hexdigest()}


def split_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rules_row(text: str | None) -> dict:
    words = split_words(text)
    lines = [x for x in (text or "").split("\n") if split_words(x)]
    windows: dict[tuple, list[int]] = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    repeated = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(8)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated),
        "base_failed": len(words) < 20 or 100 * len(repeated) > 30 * len(words),
    }


def low(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text: str | None, size: int = 3) -> set:
    words = split_words(low(text))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def groups(docs: list[tuple], size: int = 3, percent: int = 85) -> list[tuple]:
    """[(doc_id, n_shingles, component_id, kept)] of [(doc_id, text)] by comparing
    all pairs."""
    sets = [shingle_set(t, size) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if find(j) == find(i) and docs[j][0] is not None]
        least = min(ids) if ids else None
        out.append((doc_id, len(sets[i]), least, doc_id == least))
    return out


def bench_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def contamination(text: str | None, items: list[tuple]) -> dict:
    words = bench_words(text)
    hit, owners = set(), set()
    for item_id, item in items:
        w = bench_words(item)
        k = min(13, len(w))
        for s in range(len(w) - k + 1) if k else ():
            for p in range(len(words) - k + 1):
                if words[p : p + k] == w[s : s + k]:
                    hit |= set(range(p, p + k))
                    owners.add(item_id)
    return {
        "n_words": len(words), "n_hit": len(hit), "items": sorted(str(x) for x in owners if x is not None),
        "contaminated": bool(hit) and 20 * len(hit) >= len(words),
    }
