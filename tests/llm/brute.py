"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED = r"[^\x20\x09-\x0D]+"
_LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text, pattern, lower=True):
    text = text or ""
    return re.findall(pattern, text.translate(_LOW) if lower else text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def remainder(doc_id, divisor):
    return zlib.crc32(str(doc_id).encode()) % divisor


def roots(nodes, links):
    """The smallest node that links reach."""
    found = {n: n for n in nodes}

    def top(n):
        while found[n] != n:
            n = found[n]
        return n

    for a, b in links:
        low, high = sorted((top(a), top(b)))
        found[high] = low
    return {n: top(n) for n in nodes}


def line_dedup(documents):
    """Distinct ids: {doc_id: (lines, removed, text)}."""
    seen, gone = {}, {d: set() for d in documents}
    for doc in sorted(documents):
        lines = (documents[doc] or "").split("\n")
        for at in range(len(lines) - 2):
            window = tuple(lines[at : at + 3])
            if not "".join(window).strip(" \t\n\r\f\v"):
                continue
            if window in seen:
                gone[doc] |= {at, at + 1, at + 2}
            else:
                seen[window] = (doc, at)
    out = {}
    for doc, text in documents.items():
        lines = [] if text is None else text.split("\n")
        kept = None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone[doc])
        out[doc] = (len(lines), len(gone[doc]), kept)
    return out


def decontamination(documents, items, width=10):
    """{row: (words, hit words, ids of items)}; documents are rows, items (id, text) rows."""
    windows = {}
    for item, text in items:
        found = words(text, LETTERS)
        for at in range(max(1, len(found) - width + 1) if found else 0):
            windows.setdefault(tuple(found[at : at + width]), set()).add(item)
    out = []
    for text in documents:
        found, hit, ids = words(text, LETTERS), set(), set()
        for size in {len(w) for w in windows}:
            for at in range(len(found) - size + 1):
                owners = windows.get(tuple(found[at : at + size]))
                if owners is not None:
                    hit |= set(range(at, at + size))
                    ids |= owners - {None}
        out.append((len(found), len(hit), sorted(ids)))
    return out


def license_base(text, phrases):
    found, places, labels = words(text, LETTERS), [], set()
    for phrase, label in phrases.items():
        want = phrase.split()
        for at in range(len(found) - len(want) + 1):
            if found[at : at + len(want)] == want:
                places.append(at)
                labels.add(label)
    ends = (min(places), max(places)) if places else (None, None)
    return len(found), len(places), *ends, ",".join(sorted(labels))


def shingles(text, n=3):
    found = words(text, SPACED)
    return {tuple(found[i : i + n]) for i in range(max(1, len(found) - n + 1))} if found else set()


def jaccard_components(documents, words=3, least=90):
    """{doc_id: (shingles, component)}."""
    sets = {d: shingles(t, words) for d, t in documents.items()}
    links = []
    for a, b in itertools.combinations([d for d in sets if sets[d]], 2):
        if 100 * len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
            links.append((a, b))
    found = roots(list(sets), links)
    return {d: (len(sets[d]), found[d]) for d in sets}


def language_model_base(documents):
    """{doc_id: (held out, tokens, known, training tokens, base score)}."""
    tokens = {d: [*words(t, SPACED), None] for d, t in documents.items()}
    held = {d: remainder(d, 7) == 2 for d in documents}
    counts = Counter(w for d in documents if not held[d] for w in tokens[d])
    total, types = sum(counts.values()), len(counts)
    return {
        d: (
            held[d],
            len(found),
            sum(counts[w] > 0 for w in found),
            total,
            sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in found),
        )
        for d, found in tokens.items()
    }


def substring_dedup(documents, width=50):
    """{doc_id: (words, removed, kept)}."""
    found = {d: words(t, SPACED, lower=False) for d, t in documents.items()}
    first = {}
    for doc in sorted(found):
        for at in range(len(found[doc]) - width + 1):
            first.setdefault(tuple(found[doc][at : at + width]), doc)
    out = {}
    for doc, own in found.items():
        gone = set()
        for at in range(len(own) - width + 1):
            if first[tuple(own[at : at + width])] < doc:
                gone |= set(range(at, at + width))
        out[doc] = (len(own), len(gone), " ".join(w for i, w in enumerate(own) if i not in gone))
    return out


def license_votes(text, phrases, notices, slack=2, short=(0.9, 1.0), long=(60, 0.75, 1.15)):
    """All labels and the score: matches of word pairs by diagonal, merged where diagonals are neighbours."""
    found, labels, score = words(text, LETTERS), set(), 0.0
    for exact, templates in ((True, phrases), (False, notices)):
        for template, label in templates.items():
            want = template.split(" ")
            pairs = list(zip(want, want[1:]))
            diagonals = {}
            for p, pair in enumerate(zip(found, found[1:])):
                for o, other in enumerate(pairs):
                    if pair == other:
                        diagonals.setdefault(p - o, set()).add(o)
            spans = []
            for d in sorted(diagonals):
                if not spans or d > spans[-1][-1] + slack:
                    spans.append([])
                spans[-1].append(d)
            for span in spans:
                offsets = set().union(*(diagonals[d] for d in span))
                length = max(d + max(diagonals[d]) for d in span) - min(d + min(diagonals[d]) for d in span) + 1
                share = len(offsets) / len(pairs)
                least, room = (long[1], math.floor(len(pairs) * long[2])) if len(pairs) >= long[0] else (short[0], len(pairs))
                whole = any(len(diagonals[d]) == len(pairs) for d in span)
                if whole if exact else share >= least and length <= room + 2 * slack:
                    labels.add(label)
                    score = max(score, share)
    return ",".join(sorted(labels)), score
