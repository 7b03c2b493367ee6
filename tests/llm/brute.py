"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TERMS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def measures(text: str | None) -> dict[str, int]:
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for k in range(len(words) - 2):
        if windows[tuple(words[k : k + 3])] > 1:
            covered |= {k, k + 1, k + 2}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            repeated += line in seen
            seen.add(line)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": repeated,
        "n_repeat_words": len(covered),
    }


def matched_in_order(a: list, b: list) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def shingles(text: str | None) -> list[tuple[str, ...]]:
    words = WORDS.findall(text or "")
    if len(words) < 5:
        return [tuple(words)] if words else []
    return [tuple(words[k : k + 5]) for k in range(len(words) - 4)]


def similar(a: str, b: str) -> float:
    x, y = shingles(a), shingles(b)
    if not x or not y:
        return 0.0
    if (Counter(x) & Counter(y)).total() < 0.8 * (len(x) + len(y)) / 1.8 - 1e-9:
        return 0.0
    m = matched_in_order(x, y)
    return m / (len(x) + len(y) - m)


def near_classes(rows: list[tuple[int, str | None]]) -> dict[int, int]:
    """Smallest key of each key's class; keys are unique."""
    parent = {key: key for key, _ in rows}

    def root(key):
        while parent[key] != key:
            key = parent[key]
        return key

    texts: dict[str, int] = {}
    for key, text in sorted(rows, key=lambda row: row[0]):
        if shingles(text):
            parent[key] = texts.setdefault(text, key)
    different = list(texts.items())
    for i, (a, x) in enumerate(different):
        for b, y in different[i + 1 :]:
            if similar(a, b) >= 0.8 - 1e-9:
                low, high = sorted((root(x), root(y)))
                parent[high] = low
    return {key: root(key) for key, _ in rows}


def repeated_bytes(rows: list[tuple[int, str | None]], size: int = 100) -> dict[int, tuple[int, int, int, str]]:
    seen: set[bytes] = set()
    found = {}
    for key, text in sorted(rows, key=lambda row: row[0]):
        data = (text or "").encode()
        gone = [False] * len(data)
        for k in range(len(data) - size + 1):
            window = data[k : k + size]
            if window in seen:
                gone[k : k + size] = [True] * size
            seen.add(window)
        spans = sum(gone[k] and (not k or not gone[k - 1]) for k in range(len(gone)))
        kept = bytes(byte for byte, out in zip(data, gone, strict=True) if not out)
        found[key] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return found


def terms(text: str | None) -> list[str]:
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return TERMS.findall((text or "").translate(lower))


def contamination(rows, items) -> list[tuple[int, int, int, str]]:
    """For each text: words, words hit, items met and their checksum."""
    windows: dict[tuple, set] = {}
    for item, text in items:
        words = terms(text)
        for k in range(max(len(words) - 10, 0) + 1 if words else 0):
            windows.setdefault(tuple(words[k : k + 10]), set()).add(item)
    sizes = {len(window) for window in windows}
    found = []
    for _, text in rows:
        words, hit, met = terms(text), set(), set()
        for size in sizes:
            for k in range(len(words) - size + 1):
                if (window := tuple(words[k : k + size])) in windows:
                    hit |= set(range(k, k + size))
                    met |= windows[window] - {None}
        ids = ",".join(sorted(map(str, met)))
        found.append((len(words), len(hit), len(met), hashlib.sha256(ids.encode()).hexdigest()))
    return found


def without_boilerplate(rows, sites: int = 6) -> list[str | None]:
    """Texts of (source, text) rows."""
    blanks = " \t\r\x0b\x0c"
    on: dict[str, set] = {}
    for source, text in rows:
        for line in (text or "").split("\n"):
            on.setdefault(line.strip(blanks), set()).add(source)
    gone = {line for line, found in on.items() if line and len(found) >= sites}
    return [
        text if text is None else "\n".join(line for line in text.split("\n") if line.strip(blanks) not in gone)
        for _, text in rows
    ]


def shortened(rows) -> list[str | None]:
    """Texts of (source, text) rows as the pipeline keeps them; None for those that go or have no text."""
    blanks = " \t\r\x0b\x0c"
    kept = []
    for (_, text), short in zip(rows, without_boilerplate(rows), strict=True):
        lines, left = (sum(bool(line.strip(blanks)) for line in (x or "").split("\n")) for x in (text, short))
        if lines > 1 and 3 * (lines - left) >= 2 * lines:
            short = text
        kept.append(None if lines > left and short != text and not short.strip(blanks + "\n") else short)
    return kept


def languages(train: list[tuple[str, str]], texts: list[str], switch: float, smoothing: float, used: float) -> list[str]:
    """Language of each text by trigrams of training (lang, text) rows and a plain Viterbi over its words."""
    import math

    import numpy as np
    import regex

    from casebook.llm import language_spans as own

    word = regex.compile(r"\p{L}+")
    low = own.lower_table()
    mask = (1 << 64) - 1

    def bucket(a: int, b: int, c: int) -> int:
        mixed = b * 0x9E3779B97F4A7C15 & mask
        mixed ^= a * 0xC2B2AE3D27D4EB4F & mask
        mixed ^= c * 0x165667B19E3779F9 & mask
        return (mixed * 0xFF51AFD7ED558CCD & mask) >> 48

    def trigrams(w: str) -> list[int]:
        points = [0, *(int(low[ord(c)]) for c in w), 0]
        return [bucket(*points[k : k + 3]) for k in range(len(w))]

    script = own.script_table()
    counts: dict[str, Counter] = {}
    scripts: dict[str, Counter] = {}
    for lang, text in train:
        for w in word.findall(text):
            counts.setdefault(lang, Counter()).update(trigrams(w))
            scripts.setdefault(lang, Counter())[int(script[ord(w[0])])] += len(w)
    langs = sorted(counts)
    seen = max(1, len(set().union(*counts.values())))
    total = {k: counts[k].total() for k in langs}
    letters = {k: scripts[k].total() for k in langs}
    common = max(langs, key=lambda k: (letters[k], -langs.index(k)))

    def scores(w: str) -> list[float] | None:
        kind = int(script[ord(w[0])])
        allowed = [scripts[k][kind] >= used * max(scripts[k].total(), 1) and scripts[k][kind] > 0 for k in langs]
        if not any(allowed):
            return None
        value = [
            sum(float(np.float32(math.log((counts[k][b] + smoothing) / (total[k] + smoothing * seen)))) for b in trigrams(w))
            if ok
            else -1e6
            for k, ok in zip(langs, allowed, strict=True)
        ]
        return [max(v - max(value), -1e3) for v in value]

    found = []
    for text in texts:
        words = word.findall(text or "")
        best, steps, known = [0.0] * len(langs), [], []
        for w in words:
            row = scores(w)
            known.append(row is not None)
            top = max(range(len(langs)), key=lambda k: (best[k], -k))
            steps.append([k if best[k] >= best[top] - switch else top for k in range(len(langs))])
            best = [max(b, best[top] - switch) + r for b, r in zip(best, row or [0.0] * len(langs), strict=True)]
        state = max(range(len(langs)), key=lambda k: (best[k], -k))
        weight = [0] * len(langs)
        for w, come, sure in zip(reversed(words), reversed(steps), reversed(known), strict=True):
            weight[state] += len(w) * sure
            state = come[state]
        if not words:
            found.append("und")
        else:
            found.append(langs[max(range(len(langs)), key=lambda k: (weight[k], -k))] if any(weight) else common)
    return found


def posteriors(votes: list[tuple[int, ...]], rounds: int = 200) -> dict[tuple[int, ...], float]:
    """Probability of good of each row of votes, by expectation-maximisation over single rows."""
    import math

    good = [0.1 if -1 in row else 0.95 for row in votes]
    prior = {True: {1: 8.0, 0: 1.9, -1: 0.1}, False: {1: 3.0, 0: 2.0, -1: 5.0}}
    for _ in range(rounds):
        logs = {}
        for side in (True, False):
            weight = [g if side else 1 - g for g in good]
            rates = []
            for rule in range(len(votes[0])):
                seen = dict(prior[side])
                for row, w in zip(votes, weight, strict=True):
                    seen[row[rule]] += w
                rates.append({vote: n / sum(seen.values()) for vote, n in seen.items()})
            logs[side] = (math.log(sum(weight) + 1), rates)
        new = []
        for row in votes:
            a, b = (base + sum(math.log(rate[vote]) for rate, vote in zip(rates, row, strict=True)) for base, rates in logs.values())
            new.append(1 / (1 + math.exp(min(max(b - a, -700), 700))))
        done = max(abs(x - y) for x, y in zip(new, good, strict=True)) < 1e-9
        good = new
        if done:
            break
    return dict(zip(votes, good, strict=True))
