"""Plain versions of what the contracts say, one text or table at a time."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import public_tokenizers
import tiktoken
import xxhash
from tokenizers import Tokenizer

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAME_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def quality_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = SPACE_WORD.findall(text)
    lines = [x for x in text.split("\n") if SPACE_WORD.search(x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
    )


def fingerprint(text):
    words = SPACE_WORD.findall(ascii_lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(ids_and_prints, distance=4):
    """component_id per row, comparing all pairs of different fingerprints."""
    prints = sorted({f for _, f in ids_and_prints})
    root = {f: f for f in prints}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    least = {}
    for doc, f in ids_and_prints:
        if doc is not None:
            r = find(f)
            least[r] = min(least.get(r, doc), doc)
    return [least.get(find(f)) for _, f in ids_and_prints]


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def base_places(text):
    """n_words, sorted places, labels."""
    words = NAME_WORD.findall(ascii_lower(text))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        at = [i for i in range(len(words) - len(parts) + 1) if words[i : i + len(parts)] == parts]
        places += at
        labels |= {label} if at else set()
    return len(words), sorted(places), ",".join(sorted(labels))


@lru_cache
def word_tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@lru_cache
def byte_tokenizer():
    lines = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def word_ids(text):
    return [*word_tokenizer().encode(text or "", add_special_tokens=False).ids, 2]


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Target per source, by capping and resharing until none is above its cap."""
    sources = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in capped)
        free = [s for s in sources if s not in capped]
        level = rest / sum(weight[s] for s in free) if free else 0
        above = {s for s in free if level * weight[s] > cap * sizes[s]}
        if not above:
            return {s: cap * sizes[s] if s in capped else level * weight[s] for s in sources}
        capped |= above


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, k=10):
    """(item_id, rank, doc_id, score) of items and docs given as (id, text)."""
    own = [(d, TERM.findall(ascii_lower(t))) for d, t in docs]
    own = [(d, Counter(w), len(w)) for d, w in own if w]
    n_docs, n_words = len(own), sum(n for _, _, n in own)
    df = Counter(w for _, c, _ in own for w in c)
    rows = []
    for item, text in items:
        scored = []
        for d, counts, n in own:
            m = 10 + (90 * n * n_docs) // n_words
            score = 0
            for w in set(TERM.findall(ascii_lower(text))) & counts.keys():
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                score += weight * ((10**9 * counts[w]) // (1000 * counts[w] + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0))
        rows += [(item, i + 1, None if gone else d, -s) for i, (s, gone, d) in enumerate(sorted(scored)[:k])]
    return rows


def fold(events):
    """Final (role, text) of one conversation's events (seq, kind, message, role, text), one after another."""
    kinds = ["message", "regenerate", "edit", "delta"]
    first = lambda v: (v is not None, v or 0)
    order = lambda e: (first(e[0]), kinds.index(e[1]), e[2] is not None, e[2] or "", e[3] or "", e[4] or "")
    messages, place, gone = {}, [], set()
    for i, (_, kind, message, role, text) in enumerate(sorted(events, key=order)):
        key = ("alone", i) if message is None else message
        if key not in messages:
            messages[key] = [role or "", ""]
            place.append(key)
        if kind == "regenerate":
            gone |= set(place[place.index(key) + 1 :])
        messages[key][1] = messages[key][1] * (kind == "delta") + (text or "")
    return [tuple(messages[k]) for k in place if k not in gone]


def trie(rows):
    """The nodes over rows (conv_id, turn, role, text), as tuples in the order of the contract's columns."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(v)] for c, v in own.items()}
    head = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    paths = {c: own.get(c - int(math.fmod(c, 100)), [])[: head[c]] + own[c][head[c] :] for c in own}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[tuple(paths[c][:d])].append(c)
        ends[tuple(paths[c])].append(str(c))
    found = []
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        inner = {m[:-1] for m in members if m}
        found.append((
            convs[0], len(node), members[node[:-1]][0] if node else None, len(convs),
            sum(len(m) == len(node) + 1 for m in below), sum(m not in inner for m in below),
            sum((len(members[m]) - 1) * len(m[-1][1]) for m in below if m),
            hashlib.sha256(",".join(ends[node]).encode()).hexdigest(),
        ))
    return sorted(found, key=repr)
