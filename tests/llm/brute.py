"""Plain single-process versions of the corpus operators, for the tests."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def quality(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = Counter(grams)
    covered = set()
    for i, g in enumerate(grams):
        if n[g] > 1:
            covered.update(range(i, i + 5))
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed,
    )


def line_verdicts(docs, max_share=0.1, min_docs=10, max_removed=0.5):
    """docs: (key, host, text) -> (key, kept, removed lines, removed words) in order."""
    per, total = defaultdict(set), Counter(h for _, h, _ in docs)

    def norm(text):
        return [" ".join(words(x)).lower() for x in (text or "").split("\n") if WORD.search(x)]

    for i, (_, h, t) in enumerate(docs):
        for x in set(norm(t)):
            per[h, x].add(i)
    bad = {k for k, v in per.items() if len(v) >= min_docs and len(v) > max_share * total[k[0]]}
    out = []
    for key, h, t in docs:
        gone = [x for x in norm(t) if (h, x) in bad]
        n = sum(len(x.split(" ")) for x in gone)
        q = quality(t)
        out.append((key, not q[5] and n <= max_removed * q[0], len(gone), n))
    return out


def lines_left(docs, ratio=0.1, min_pages=10, distinct=False, min_line_pages=1):
    """docs: (key, host, text) -> (key, text, lines, dropped) in order; ``distinct``: copies in a host are one page."""
    trim = " \t\n\x0b\x0c\r"
    seen = sorted({(h, t) for _, h, t in docs}, key=repr) if distinct else [(h, t) for _, h, t in docs]
    pages, n = Counter(h for h, _ in seen), Counter()
    for h, t in seen:
        for x in {y.strip(trim) for y in (t or "").split("\n")} - {""}:
            n[h, x] += 1
    out = []
    for key, h, t in docs:
        if t is None:
            out.append((key, None, 0, 0))
            continue
        lines = t.split("\n")
        often = {x for x in map(lambda y: y.strip(trim), lines) if n[h, x] >= min_line_pages and n[h, x] > pages[h] * ratio}
        kept = [x for x in lines if not (x.strip(trim) and pages[h] >= min_pages and x.strip(trim) in often)]
        out.append((key, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def shingles(text, n=5):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def jaccard_components(docs):
    """docs: (key, text) -> {row number: (set size, smallest key of the component)}."""
    sets = [shingles(t) for _, t in docs]
    by = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            by[g].append(i)
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in by[g] if j < i)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(docs):
        if key is not None:
            r = find(i)
            least[r] = min(least.get(r, key), key)
    return {i: (len(sets[i]), least.get(find(i))) for i in range(len(docs))}


def top_k(rows, k=10, scale=1024):
    """rows: (vec_id, vector) -> sorted (query_id, rank, vec_id, score)."""
    ok = [
        (i, v, [math.floor(float(x) * scale) for x in e])
        for i, (v, e) in enumerate(rows)
        if e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    m = np.array([e for _, _, e in ok], dtype=np.int64) if ok else np.zeros((0, 0), np.int64)
    out = []
    for n, (i, v, e) in enumerate(ok):
        if v is None or v % 100:
            continue
        scores = m @ m[n]
        best = sorted((-int(s), w is None, w or 0, j, w) for (j, w, _), s in zip(ok, scores) if j != i)[:k]
        out += [(v, r + 1, w, -s) for r, (s, *_, w) in enumerate(best)]
    return sorted(out, key=repr)


def word_ids(text, _own={}):  # noqa: B006 - loaded once
    if not _own:
        from tokenizers import Tokenizer

        _own["t"] = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return _own["t"].encode(text or "", add_special_tokens=False).ids


def multi_ids(text, _own={}):  # noqa: B006 - loaded once
    if not _own:
        import tiktoken

        with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _own["t"] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _own["t"].encode_ordinary(text or "")


def le32(ids):
    return np.array(ids, "<u4").tobytes()


def crc(ids):
    return zlib.crc32(le32(ids))


def sha(data):
    return hashlib.sha256(data).hexdigest()


def lm_scores(docs, order=2, backoff=0.4):
    """docs: (key, text) -> (key, words, log score) in order, counts of the other documents."""
    seqs = [words(t) for _, t in docs]
    grams = [Counter(tuple(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)) for w in seqs]
    total, size = Counter(), sum(map(len, seqs))
    for g in grams:
        total.update(g)
    out = []
    for (key, _), w, own in zip(docs, seqs, grams):
        score = 0.0
        for i in range(len(w)):
            weight = 1.0
            for n in range(min(order, i + 1), 0, -1):
                g = tuple(w[i - n + 1 : i + 1])
                c = total[g] - own[g]
                if n == 1:
                    score += math.log(weight * max(c, 1) / max(size - len(w), 1))
                elif c > 0:
                    score += math.log(weight * c / (total[g[:-1]] - own[g[:-1]]))
                    break
                else:
                    weight *= backoff
        out.append((key, len(w), score))
    return out


def window_hashes(text, n):
    """A name for every n-word window, case folded, in order; any injective naming would do, but
    which windows are picked depends on the order of the names."""
    from riskweave.llm import subdedup

    return subdedup.text_windows([text], n)[0].tolist()


def repeated_words(docs, n, sure_words):
    """docs: (key, text) -> {key: [(first, last) word of every run inside windows told before]}."""
    w = sure_words - n + 1
    every = {k: window_hashes(t, n) for k, t in docs if t}
    stands = {}  # of equal texts, the one with the smallest key
    for k, t in sorted((d for d in docs if d[1]), key=lambda d: d[0]):
        stands.setdefault(t, k)
    own = {k: every[k] for k in stands.values()}
    picks = {}
    for k, h in own.items():
        picks[k] = set()
        for i in range(len(h) - w + 1):
            picks[k].add(min(h[i : i + w]))
    owners = defaultdict(set)
    for k, p in picks.items():
        for x in p:
            owners[x].add(k)
    near = {}
    for k, h in own.items():
        at = [i for i, x in enumerate(h) if x in picks[k] and len(owners[x]) > 1]
        near[k] = {h[j] for i in at for j in range(max(0, i - w + 1), min(len(h), i + w))}
    first = {}
    for k in sorted(near):
        for x in near[k]:
            first.setdefault(x, k)
    out = {}
    for k, h in every.items():
        told = {x for x in near[k] if first[x] != k} if k in near else set(h) if len(h) >= w else set()
        places = defaultdict(list)
        for i, x in enumerate(h):
            places[x].append(i)
        looped = {x for x, p in places.items() if any(b - a < n for a, b in zip(p, p[1:]))}
        gone = set()
        for i, x in enumerate(h):
            if x in told or (x not in looped and places[x][0] != i):
                gone.update(range(i, i + n))
        runs = []
        for i in sorted(gone):
            if runs and runs[-1][1] == i - 1:
                runs[-1][1] = i
            else:
                runs.append([i, i])
        out[k] = runs
    return out


def without_repeats(docs, min_words=20, sure_words=None):
    """docs: (key, text) with distinct keys -> {key: text without runs of repeated
    sentences, nor, with ``sure_words``, of words inside repeated windows}."""
    end = re.compile(r"[.!?](?=[\x20\x09-\x0D])|\n")

    def units(text):
        at, out = 0, []
        for e in [*(m.end() for m in end.finditer(text)), len(text)]:
            norm = " ".join(text[at:e].lower().split())
            if norm:
                out.append((at, e, norm))
            at = e
        return out

    owner = {}
    for key, text in sorted((d for d in docs if d[1]), key=lambda d: d[0]):
        for _, _, u in units(text):
            owner.setdefault(u, key)
    out = {}
    inside = repeated_words(docs, min_words, sure_words) if sure_words else {}
    for key, text in docs:
        if not text:
            out[key] = text
            continue
        seen, gone, run = set(), [], []
        place = [m.span() for m in WORD.finditer(text)] if inside else []
        for a, b in inside.get(key, ()):
            start = place[a][0]
            while start and text[start - 1] in " \t":
                start -= 1
            gone.append((start, place[b][1]))
        for a, e, u in [*units(text), (None, None, None)]:
            if u is not None and (u in seen or owner[u] != key):
                run.append((a, e, len(u.split())))
            else:
                if run and sum(r[2] for r in run) >= min_words:
                    gone.append((run[0][0], run[-1][1]))
                run = []
            seen.add(u)
        removed = {i for a, e in gone for i in range(a, e)}
        out[key] = "".join(c for i, c in enumerate(text) if i not in removed)
    return out
