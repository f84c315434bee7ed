"""Plain Python versions of the corpus operators' contracts."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(x: bytes | str) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def low(text: str | None) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def components(docs: dict[int, str | None], k: int = 5, percent: int = 80) -> dict[int, tuple[int, int]]:
    sets = {}
    for i, t in docs.items():
        w = SPACE_WORD.findall(low(t))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def contamination(docs: dict[int, str | None], items: dict[int, str | None], size: int = 10) -> dict[int, tuple]:
    windows = defaultdict(set)
    for i, t in items.items():
        w = ITEM_WORD.findall(low(t))
        n = min(size, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[j : j + n])].add(i)
    out = {}
    for i, t in docs.items():
        w, hit, found = ITEM_WORD.findall(low(t)), set(), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if (g := tuple(w[j : j + n])) in windows:
                    hit |= set(range(j, j + n))
                    found |= windows[g]
        out[i] = (len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit))
    return out


def line_dedup(docs: dict[int, str | None], size: int = 3) -> dict[int, str | None]:
    seen, gone = set(), defaultdict(set)
    for i in sorted(docs):
        lines = [(j, x) for j, x in enumerate((docs[i] or "").split("\n")) if x.strip(" ")]
        for a in range(len(lines) - size + 1):
            w = tuple(x for _, x in lines[a : a + size])
            if w in seen:
                gone[i] |= {j for j, _ in lines[a : a + size]}
            seen.add(w)
    return {i: None if t is None else "\n".join(x for j, x in enumerate(t.split("\n")) if j not in gone[i]) for i, t in docs.items()}


def counts(text: str | None) -> tuple[int, ...]:
    t = text or ""
    w, seen, dup = SPACE_WORD.findall(t), set(), 0
    for x in t.split("\n"):
        if SPACE_WORD.search(x):
            dup += x in seen
            seen.add(x)
    c = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    repeated = {j for i in range(len(w) - 7) if c[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(repeated)


SECRETS = {
    "assign": (re.compile(r"""(?a:(?i:(password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}


def secrets(text: str | None) -> list[str]:
    found = [(m.start(), r, k, m.end()) for r, (k, (p, g, n)) in enumerate(SECRETS.items()) for m in p.finditer(text or "") if len(m[g]) >= n]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(found)]


FORMS = {
    "named": (re.compile(r"""(?ai)\b(?:pwd|passphrase|credentials?|bearer|(?:private|access|account)_?key|auth(?:orization)?)["']?\x20*[:=]?\x20*["']?([A-Za-z0-9+/_.=-]{8,})"""), 1, 8),
    "url": (re.compile(r"(?a)[A-Za-z][A-Za-z0-9+.-]{0,20}://[^\s/:@]{1,200}:([^\s/@]{6,200})(?=@)"), 1, 6),
    "block": (re.compile(r"(?a)-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s]+"), 0, 64),
    "mixed": (re.compile(r"[A-Za-z0-9+/_=-]{24,}"), 0, 24),
}


def live_spans(rows: list[tuple], max_owners: int = 2, max_repos: int = 2, min_live: int = 16) -> list[tuple[str, int, int]]:
    """(doc_id, text, owner, repo) -> each row's spans, live ones and examples, from counts over all rows."""
    found, holders = [], defaultdict(set)
    for _, text, owner, repo in rows:
        own = {}
        for k, (p, g, n) in {**SECRETS, **FORMS}.items():
            for m in p.finditer(text or ""):
                v = m[g]
                if len(v) < n or (k == "mixed" and not all(re.search(x, v) for x in ("[0-9]", "[A-Z]", "[a-z]"))):
                    continue
                holders[v].add((owner or "", repo or ""))
                lively = k in ("url", "block", "access") or (len(v) >= min_live and re.search("[0-9]", v) and re.search("[A-Za-z]", v))
                own.setdefault((m.end() - len(v), m.end()), [v, False])[1] |= bool(lively)
        found.append(own)
    out = []
    for (_, text, _, _), own in zip(rows, found, strict=True):
        example = {at for at, (v, _) in own.items() if len({o for o, _ in holders[v]}) > max_owners or len(holders[v]) > max_repos}
        live = {at for at, (_, lively) in own.items() if lively} - example
        base = [(m.start(), r, k, m.end()) for r, (k, (p, g, n)) in enumerate(SECRETS.items()) for m in p.finditer(text or "") if len(m[g]) >= n]
        spans = sorted(base + [(a, 9, "live", b) for a, b in live])
        out.append((",".join(f"{k}:{a}:{b}" for a, _, k, b in spans), len(live), len(example)))
    return out


def collocations(rows: list[tuple], least: int = 30, top: int = 2000) -> list[tuple]:
    """(lang, text) -> sorted (lang, rank, phrase, a, l, r, n, score)."""
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        phrases = {w: a for w, a in c.items() if len(w) > 1 and a >= least}
        inside = defaultdict(int)
        for w, a in phrases.items():
            for k in range(2, len(w)):
                for i in range(len(w) - k + 1):
                    inside[w[i : i + k]] = max(inside[w[i : i + k]], a)
        found = []
        for w, a in phrases.items():
            if 100 * inside[w] < 80 * a:
                score, _, x, y = min((2_000_000 * a // (c[w[:j]] + c[w[j:]]), j, c[w[:j]], c[w[j:]]) for j in range(1, len(w)))
                found.append((-score, -a, " ".join(w).encode(), x, y))
        out += [(lang, i + 1, p.decode(), -a, x, y, total[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:top])]
    return sorted(out)


def vocabulary(docs: list[tuple], every: int = 97, least: int = 5, least_n: int = 3) -> dict[str, int]:
    c = Counter()
    for i, t in docs:
        for w in re.findall("[A-Za-z\u00c0-\u00ff]+", t or ""):
            w = low(w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            c[w] += len(w) >= least
    return {w: n for w, n in c.items() if n >= least_n}


def variants(words: dict[str, int]) -> list[tuple]:
    """word -> n; sorted (word, form, root, n, n_near, form_n), by deleting one letter of each word: two words are near if
    they share such a rest at one place, or one is the other's rest."""
    masks, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            masks[(w[:i], w[i + 1 :])].add(w)
            if (rest := w[:i] + w[i + 1 :]) in words:
                near[w].add(rest)
                near[rest].add(w)
    for group in masks.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in words.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-words[x], x))
            if words[best] >= 2 * n:
                form[w] = best

    def root(w: str) -> str:
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items())
