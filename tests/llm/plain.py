"""Plain, whole-in-memory versions of the operators."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) if i % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def base_spans(text):
    found = []
    for rank, (kind, form) in enumerate(FORMS.items()):
        for match in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", match[0])
            if kind == "ip" and any(int(part) > 255 for part in match[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((match.start(), rank, match.end(), kind))
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


def shingles(text):
    words = WORDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def classes(rows):
    """`(key, text)` to `(key, size, smallest key of the class)`."""
    sets, parent, holders = [shingles(text) for _, text in rows], list(range(len(rows))), defaultdict(list)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, own in enumerate(sets):
        for j, both in Counter(j for x in own for j in holders[x]).items():
            if 100 * both >= 80 * (len(own) + len(sets[j]) - both):
                parent[root(i)] = root(j)
        for x in own:
            holders[x].append(i)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return [(key, len(sets[i]), least.get(root(i)) if sets[i] else key) for i, (key, _) in enumerate(rows)]


def removed(texts, window=35):
    """For each text its words and which of them go."""
    split = [WORDS.findall(text or "") for text in texts]
    counts = Counter(tuple(words[i : i + window]) for words in split for i in range(len(words) - window + 1))
    out = []
    for words in split:
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if counts[tuple(words[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((words, gone))
    return out


def quality_counts(text):
    words, seen, dup_lines = WORDS.findall(text), set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup_lines += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup_lines, len(covered), failed


def quality_kept(rows, scales, fence=4, points=20, point_texts=5):
    """The verdict on each `(text, lang, source)`; `scales` has for each rule the scale of its share and the events of a step."""
    measured = []
    for text, lang, source in rows:
        words, chars, symbols, dup_lines, repeats, failed = quality_counts(text or "")
        lines = sum(bool(WORDS.search(line)) for line in (text or "").split("\n"))
        marks = sum(c in "!?" for c in text or "")
        shares = {"symbols": (symbols, chars), "marks": (marks, chars), "dup_lines": (dup_lines, lines), "repeats": (repeats, words), "word_length": (chars, words)}
        bins = {rule: min(1000, scales[rule][0] * part // max(whole, 1)) for rule, (part, whole) in shares.items()}
        steps = {rule: min(1000, -(-scales[rule][0] * scales[rule][1] // max(whole, 1))) for rule, (_, whole) in shares.items()}
        measured.append((lang, source, failed, bins, steps))

    def limits(own, language):
        def at(part, rule, q):
            values = sorted(m[part][rule] for m in language)
            more = [values[-(-(2 * i + 1) * len(values) // (2 * points)) - 1] for i in range(points)]
            merged = sorted([m[part][rule] for m in own] + more * point_texts)
            return merged[-(-len(merged) * q // 100) - 1]

        return {rule: (at(3, rule, 75), max(at(3, rule, 75) - at(3, rule, 25), at(4, rule, 50))) for rule in scales}

    passed = [m for m in measured if not m[2]]
    found = {key: limits([m for m in passed if m[:2] == key], [m for m in passed if m[0] == key[0]]) for key in {m[:2] for m in passed}}

    def kept(lang, source, failed, bins, steps):
        return not failed and all(bins[rule] <= high + fence * max(spread, steps[rule]) for rule, (high, spread) in found[lang, source].items())

    return [kept(*m) for m in measured]


def multi_encoding():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def json_ids(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [found.ids for found in tokenizer.encode_batch(list(texts), add_special_tokens=False)]


def little_endian(ids):
    return np.array(ids, "<u4").tobytes()


def best(vectors, queries, k=10):
    """`(query, rank, id, score)` of whole-number vectors by id."""
    out = []
    for q in queries:
        scores = sorted((-int(np.dot(v, vectors[q])), i) for i, v in vectors.items() if i != q)
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:k])]
    return out


TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERMS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def ranked(rows, items, k=10):
    """`(item, rank, key, score)` of `(key, text)` rows for `(item, text)` rows."""
    counts = [Counter(terms(text)) for _, text in rows]
    lengths = [sum(own.values()) for own in counts]
    n, total, uses = sum(size > 0 for size in lengths), sum(lengths), Counter(t for own in counts for t in own)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * uses[t] + 1))) for t in uses}
    out = []
    for item, text in items:
        asked, found = Counter(terms(text)), []
        for (key, _), own, size in zip(rows, counts, lengths):
            m = 25 + 75 * size * n // total if size else 0
            score = sum(c * weight[t] * (10**9 * own[t] // (1000 * own[t] + 8 * m)) for t, c in asked.items() if t in own)
            if score > 0:
                found.append((-score, key is None, key or 0, key))
        out += [(item, rank + 1, key, -score) for rank, (score, _, _, key) in enumerate(sorted(found, key=lambda x: x[:3])[:k])]
    return out


def smallest_period(words):
    border, k = [0] * len(words), 0
    for i in range(1, len(words)):
        while k and words[i] != words[k]:
            k = border[k - 1]
        k += words[i] == words[k]
        border[i] = k
    return len(words) - border[-1]


def runs(words, least=24, periods=3):
    """`(start, length, period)` of each run, by start and period."""
    found = set()
    for q in range(1, len(words) // periods + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, periods * q) and smallest_period(words[i : j + q]) == q:
                found.add((i, j + q - i, q))
            i = j + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def periodic(key, text):
    """The row of the query for one document."""
    words = WORDS.findall(text or "")
    n, h = len(words), None if key is None else zlib.crc32(str(key).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    top = min(found, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (key, len(found), *best, sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))
