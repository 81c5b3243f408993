"""The operators' results worked out in the plainest way, on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
import xxhash
from tokenizers import Tokenizer

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
TOKENIZER.encode_special_tokens = True  # their strings in a text are ordinary text
PIECES = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def token_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def removed(texts, least=200):
    """For each text: bytes, removed bytes, removed runs, SHA-256 of the rest."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(raw[i : i + least] for raw in raws for i in range(len(raw) - least + 1))
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - least + 1):
            if seen[raw[i : i + least]] > 1:
                gone[i : i + least] = b"\1" * least
        left = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(raw), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


def feistel(value, n, key, rounds=6):
    """A keyed permutation of 0 .. n - 1: six rounds over the halves, again until the result is below n."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    full, mask = (1 << 64) - 1, (1 << half) - 1

    def hashed(x, k):
        x = (x + (k & full)) * 0x9E3779B97F4A7C15 & full
        x = (x ^ x >> 29) * 0xBF58476D1CE4E5B9 & full
        return x ^ x >> 32

    while True:
        left, right = value >> half, value & mask
        for step in range(rounds):
            left, right = right, left ^ hashed(right, key * rounds + step) & mask
        value = left << half | right
        if value < n:
            return value


def pieces(text, most=2048):
    ids = [*token_ids(text), 0]
    first = len(ids) if len(ids) <= most else len(ids) % most or most
    edges = [0, *range(first, len(ids) + 1, most)]
    return [
        (n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
        for n, (a, b) in enumerate(zip(edges, edges[1:], strict=False))
    ]


def words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def contamination(docs, items, window=10):
    """For each (id, text): words, hit words, items, hash of the items, contaminated. Items: id -> texts."""
    phrases = defaultdict(set)
    for item, text in items:
        found = words(text)
        width = min(window, len(found))
        for i in range(len(found) - width + 1):
            if width:
                phrases[tuple(found[i : i + width])].add("" if item is None else str(item))
    widths = sorted({len(p) for p in phrases})
    out = []
    for _, text in docs:
        found, hit, named = words(text), set(), set()
        for width in widths:
            for i in range(len(found) - width + 1):
                if (phrase := tuple(found[i : i + width])) in phrases:
                    hit.update(range(i, i + width))
                    named |= phrases[phrase]
        joined = ",".join(sorted(named))
        out.append((len(found), len(hit), len(named), hashlib.sha256(joined.encode()).hexdigest(), bool(hit)))
    return out


def fingerprint(text, shingle=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(found[i : i + shingle]) for i in range(max(1, len(found) - shingle + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(rows, distance=2):
    """For each (id, fingerprint): the smallest id reachable."""
    prints = sorted({fp for _, fp in rows})
    parent = {fp: fp for fp in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    values = np.array(prints, np.uint64)
    for i, fp in enumerate(prints):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ np.uint64(fp)) <= distance):
            parent[root(prints[i + 1 + j])] = root(fp)
    smallest = {}
    for key, fp in rows:
        if key is not None:
            smallest[root(fp)] = min(key, smallest.get(root(fp), key))
    return [smallest.get(root(fp)) for _, fp in rows]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def encoding(text):
    """Number of pieces, and the SHA-256 of their ids and of the text that they decode to."""
    ids = PIECES.encode(text or "")
    return len(ids), digest(",".join(map(str, ids))), digest(PIECES.decode(ids))


def divergence(rows, least=10, top=10):
    """Rows (lang, source, part, item, value, rank) of rows (lang, source, text)."""
    docs = []
    for lang, source, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        docs.append((lang or "", source or "", Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower))))
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        spread = Counter(term for _, _, terms in own for term in terms)
        kept = [term for term, n in spread.items() if n >= least]
        groups = defaultdict(Counter)
        for _, source, terms in own:
            groups[source] += Counter({t: n for t, n in terms.items() if spread[t] >= least})
        whole = sum(groups.values(), Counter())

        def shares(counts, kept=kept):
            total = sum(counts.values()) + 2 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // total for t in kept}

        p, q = {source: shares(counts) for source, counts in groups.items()}, shares(whole)
        for source, counts in groups.items():
            f = lambda a, b: (a - b) ** 2 // (a + b)
            pairs = [(other, sum(f(p[source][t], p[other][t]) for t in kept)) for other in groups if other != source]
            terms = [(t, f(p[source][t], q[t])) for t in kept if counts[t] and p[source][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, source, part, item, value, n + 1) for n, (item, value) in enumerate(found[:most])]
    return out


VISIBLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
HIDDEN = [x for x in range(256) if x not in VISIBLE]
BYTES = {chr(x): x for x in VISIBLE} | {chr(256 + n): x for n, x in enumerate(HIDDEN)}
A_BYTES = {n: bytes(BYTES[x] for x in token) for token, n in TOKENIZER.get_vocab().items() if all(x in BYTES for x in token)}


def b_bytes(n):
    piece = PIECES.id_to_piece(n)
    return bytes([int(piece[3:5], 16)]) if PIECES.is_byte(n) else piece.replace("\u2581", " ").encode()


def aligned(text):
    """Ids of both tokenizers, groups of them, and linked pairs of ids; nothing if bytes differ."""
    whole = b" " + (text or "").encode()
    a = TOKENIZER.encode(" " + (text or ""), add_special_tokens=False).ids
    b = PIECES.encode(text or "")
    if not text or b"".join(A_BYTES.get(n, b"") for n in a) != whole or b"".join(map(b_bytes, b)) != whole:
        return [], [], [], []
    ends_a, ends_b = (np.cumsum([len(x) for x in side]).tolist() for side in ([A_BYTES[n] for n in a], [b_bytes(n) for n in b]))
    groups, links, i, j = [], [], 0, 0
    after_a, after_b = ({end: n + 1 for n, end in enumerate(ends)} for ends in (ends_a, ends_b))
    for end in sorted(after_a.keys() & after_b.keys()):
        k, m = after_a[end], after_b[end]
        groups.append((a[i:k], b[j:m]))
        links.append((a[k - 1], b[m - 1]))
        i, j = k, m
    return a, b, groups, links


def alignment(texts):
    """For each text: tokens, groups, links, links of the best count, sum of counts, SHA-256 of the groups."""
    found = [aligned(text) for text in texts]
    counts = Counter(link for *_, links in found for link in links)
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for a, b, groups, links in found:
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        figures = (len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links))
        out.append((*figures, digest(written) if a else ""))
    return out


def prose(seed, n):
    made = random.Random(seed)
    words = ["".join(made.choice("abcdeé") for _ in range(made.randint(1, 9))) for _ in range(400)]
    return " ".join(made.choice(words) + made.choice(["", "", "", ".", ",\n"]) for _ in range(n))
