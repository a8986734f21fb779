"""Plain versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import numpy as np


def word_list(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def shingle_set(text):
    w = word_list(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_duplicates(docs, threshold=85):
    """``docs``: (doc_id, text).  Pairs are tried only if they share a shingle."""
    sets = {i: shingle_set(t) for i, t in docs}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    shared = defaultdict(int)
    for ids in holders.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1 :]:
                shared[min(a, b), max(a, b)] += 1
    links = [(a, b) for (a, b), n in shared.items() if 100 * n >= threshold * (len(sets[a]) + len(sets[b]) - n)]
    found = components(sets, links)
    return {i: (len(s), found[i], i == found[i]) for i, s in sets.items()}


def near_vectors(rows, threshold=0.93):
    """``rows``: (vec_id, embedding or None, label or None)."""
    usable = {}
    for i, v, label in rows:
        ok = v is not None and len(v) and label is not None and all(x is not None and np.isfinite(x) for x in v)
        if ok and any(v):
            v = np.array(v, dtype=np.float64)
            usable.setdefault((label, len(v)), []).append((i, v / np.sqrt((v * v).sum())))
    links, n = [], {i: 0 for i, _, _ in rows}
    for group in usable.values():
        ids, unit = [i for i, _ in group], np.vstack([v for _, v in group])
        a, b = np.nonzero(np.triu(unit @ unit.T >= threshold, 1))
        for x, y in zip(a, b):
            links.append((ids[x], ids[y]))
            n[ids[x]] += 1
            n[ids[y]] += 1
    found = components([i for i, _, _ in rows], links)
    return {i: (n[i], found[i], i == found[i]) for i, _, _ in rows}


def check_shards(rows, docs, shards=8):
    """``rows`` of the sharding query against its law, ``docs`` as (doc_id, text)."""
    texts = {i: (t or "").encode() for i, t in docs}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    places, load = defaultdict(list), defaultdict(int)
    for r in rows:
        body = texts[r.doc_id]
        assert (r.size, r.text_crc32) == ((len(body) if body else 0) + 1, zlib.crc32(body))
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        places[r.shard].append(r.slot)
        load[r.shard] += r.size
    for found in places.values():
        assert sorted(found) == list(range(len(found)))
    return load


def check_packing(rows, docs, encode, capacity=1024):
    """``rows`` of the packing query; ``encode`` gives a text's ids.  Returns sequences used and the least possible by size."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert sorted(by_doc) == sorted(i for i, _ in docs)
    total = 0
    for i, text in docs:
        ids = [*encode(text or ""), 2]
        total += len(ids)
        own = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert len(own) == -(-len(ids) // capacity)
        at = 0
        for k, r in enumerate(own):
            assert r.start == at and (r.length == capacity or k == 0)
            part = np.array(ids[at : at + r.length], dtype="<u4").tobytes()
            assert len(part) == 4 * r.length and zlib.crc32(part) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_sequence), -(-total // capacity)


def base_scores(docs):
    """The contract of language-model scoring but for the model's own score: n_tokens, n_known, train_tokens, base_score."""
    import math
    from collections import Counter

    end = object()
    tokens = {i: [*word_list(t), end] for i, t in docs}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    counts = Counter(t for i, own in tokens.items() if not held[i] for t in own)
    n, v = sum(counts.values()), len(counts)
    return {
        i: (held[i], len(own), sum(t in counts for t in own), n, sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own))
        for i, own in tokens.items()
    }


def without_repeats(docs, length=200):
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256), every window looked up in a dictionary."""
    import hashlib
    from collections import Counter

    texts = {i: (t or "").encode() for i, t in docs}
    seen = Counter(body[s : s + length] for body in texts.values() for s in range(len(body) - length + 1))
    found = {}
    for i, body in texts.items():
        cover = np.zeros(len(body) + 1, dtype=int)
        for s in range(len(body) - length + 1):
            if seen[body[s : s + length]] > 1:
                cover[s] += 1
                cover[s + length] -= 1
        gone = np.cumsum(cover[:-1]) > 0
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = bytes(np.frombuffer(body, np.uint8)[~gone])
        found[i] = (len(body), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return found


def bigram_scores(docs, m):
    """doc_id -> score of the smoothed word-pair model itself, without tries, shards and rounding, all contexts with one weight."""
    import math
    from collections import Counter

    begin, end = object(), object()
    tokens = {i: [*word_list(t), end] for i, t in docs}
    trained = [own for i, own in tokens.items() if zlib.crc32(str(i).encode()) % 5 != 1]
    words = Counter(t for own in trained for t in own)
    follows = Counter(p for own in trained for p in zip([begin, *own], own))
    contexts = words | Counter({begin: words[end]})
    n, v = sum(words.values()), len(words)

    def log10(before, word):
        alone = (words[word] + 0.5) / (n + 0.5 * (v + 1))
        return math.log10((follows[before, word] + m * alone) / (contexts[before] + m)) if contexts[before] else math.log10(alone)

    return {i: sum(log10(*p) for p in zip([begin, *own], own)) for i, own in tokens.items()}


def alignments(docs):
    """The contract's eight columns, whole texts encoded and compared byte by byte."""
    import hashlib
    from collections import Counter

    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    letters |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}

    def tokens(text):
        plain = (" " + text).encode()
        a = [(i, bytes(letters[c] for c in one.id_to_token(i))) for i in one.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("\u2581", " ").encode()) for i in two.encode(text)]
        return (a, b) if b"".join(x for _, x in a) == plain == b"".join(x for _, x in b) else ([], [])

    found, count = [], Counter()
    for i, text in docs:
        a, b = tokens(text) if text else ([], [])
        owner = [[k for k, (_, x) in enumerate(side) for _ in x] for side in (a, b)]
        links = [(a[x][0], b[y][0]) for x, y in dict.fromkeys(zip(*owner))]
        count.update(links)
        ends = [set(), set()]
        for side, own in zip((a, b), ends):
            at = 0
            for _, x in side:
                at += len(x)
                own.add(at)
        groups, begin = [], 0
        for end in sorted(ends[0] & ends[1]):
            groups.append("|".join(",".join(str(side[k][0]) for k in sorted(set(own[begin:end]))) for side, own in zip((a, b), owner)))
            begin = end
        found.append((i, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    best = defaultdict(int)
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    return [
        (i, n_a, n_b, n_groups, len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), sha)
        for i, n_a, n_b, n_groups, links, sha in found
    ]


def phrases(docs, least, top):
    """``docs``: (lang, text).  The contract's rows, all phrases counted in dictionaries."""
    from collections import Counter

    counts, totals = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            totals[lang] += len(words)
            for k in range(1, 6):
                counts[lang].update(words[i : i + k] for i in range(len(words) - k + 1))
    rows = []
    for lang, f in counts.items():
        held = {}
        for p, n in f.items():
            if n >= least and len(p) > 2:
                for k in range(2, len(p)):
                    for i in range(len(p) - k + 1):
                        held[p[i : i + k]] = max(held.get(p[i : i + k], 0), n)
        ranked = []
        for p, a in f.items():
            if a < least or len(p) < 2 or 100 * held.get(p, 0) >= 100 * a:
                continue
            score, _, left, right = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            rows.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(rows)


def secrets(docs):
    """doc_id, three counts and the digest of the plain spans, by the patterns as the contract writes them."""
    import hashlib

    patterns = [
        (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?((?-i:[A-Za-z0-9+/_.=-]+))""", re.I | re.A, lambda m: len(m[2]) >= 12),
        (r"AKIA[A-Z0-9]+", 0, lambda m: len(m[0]) >= 18),
        (r"[0-9a-f]+", 0, lambda m: len(m[0]) >= 16),
    ]
    rows = []
    for i, text in docs:
        spans = [(m.start(), k, m.end()) for k, (p, flags, ok) in enumerate(patterns) for m in re.finditer(p, text or "", flags) if ok(m)]
        joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(spans))
        rows.append((i, *(sum(x[1] == k for x in spans) for k in range(3)), hashlib.sha256(joined.encode()).hexdigest()))
    return rows
