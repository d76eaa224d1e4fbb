"""Plain Python versions of what SQL cannot express, for small tables."""

from __future__ import annotations

import xxhash


def split(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def simhash(text: str | None) -> int:
    ws = [w.lower() for w in split(text)]
    grams = [b" ".join(ws[i:i + 4]) for i in range(max(1, len(ws) - 3))] if ws else []
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hs) > len(hs))


def components(fps: list[tuple[int, int]], radius: int = 4) -> dict[int, int]:
    """doc_id: smallest doc_id reachable over links of at most ``radius`` bits."""
    heads: dict[int, int] = {}
    for d, f in fps:
        heads[f] = min(d, heads.get(f, d))
    root = {f: f for f in heads}

    def find(f: int) -> int:
        while root[f] != f:
            root[f] = root[root[f]]
            f = root[f]
        return f

    all_fps = list(heads)
    for i, a in enumerate(all_fps):
        for b in all_fps[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    least: dict[int, int] = {}
    for f, d in heads.items():
        least[find(f)] = min(d, least.get(find(f), d))
    return {d: least[find(f)] for d, f in fps}


def repeated_words(rows: list[tuple[int, str | None]], width: int = 50) -> dict[int, tuple[int, list[bytes]]]:
    """doc_id: (words, kept words) after removing words covered by a window that starts in a document with a smaller id."""
    first: dict[tuple[bytes, ...], int] = {}
    for d, t in rows:
        ws = split(t)
        for i in range(len(ws) - width + 1):
            w = tuple(ws[i:i + width])
            first[w] = min(d, first.get(w, d))
    out = {}
    for d, t in rows:
        ws, gone = split(t), set()
        for i in range(len(ws) - width + 1):
            if first[tuple(ws[i:i + width])] < d:
                gone.update(range(i, i + width))
        out[d] = (len(ws), [w for i, w in enumerate(ws) if i not in gone])
    return out


def has_word(line: str) -> bool:
    return bool(split(line))


def repeated_lines(rows: list[tuple[int, str | None]]) -> dict[int, list[str]]:
    """doc_id: lines left after removing those of three-line windows seen before in (doc_id, position) order."""
    seen, out = set(), {}
    for d, t in sorted(rows):
        lines = (t or "").split("\n")
        full = [i for i, x in enumerate(lines) if has_word(x)]
        gone = set()
        for j in range(len(full) - 2):
            w = tuple(lines[i] for i in full[j:j + 3])
            if w in seen:
                gone.update(full[j:j + 3])
            seen.add(w)
        out[d] = [x for i, x in enumerate(lines) if i not in gone]
    return out


def benchmark_words(text: str | None) -> list[str]:
    out, word = [], ""
    for ch in text or "":
        ch = ch.lower() if "A" <= ch <= "Z" else ch
        if ch >= "\x80" or ch.isdigit() or "a" <= ch <= "z":
            word += ch
        elif word:
            out.append(word)
            word = ""
    return [*out, word] if word else out


def contaminated(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]]) -> dict[int, tuple[int, set[str]]]:
    """doc_id: (words hit, items)."""
    windows: dict[tuple[str, ...], set[str]] = {}
    for i, t in items:
        ws = benchmark_words(t)
        k = min(len(ws), 10)
        for a in range(len(ws) - k + 1 if k else 0):
            windows.setdefault(tuple(ws[a:a + k]), set()).add("" if i is None else str(i))
    sizes, out = {len(w) for w in windows}, {}
    for d, t in docs:
        ws, hit, found = benchmark_words(t), set(), set()
        for k in sizes:
            for a in range(len(ws) - k + 1):
                who = windows.get(tuple(ws[a:a + k]))
                if who:
                    hit.update(range(a, a + k))
                    found |= who
        out[d] = (len(hit), found)
    return out


def alignment(texts, byte_path, piece_path):
    """What token alignment returns for each text, token by token: by the tokenizers library, with lists and sets."""
    import hashlib
    import json
    from bisect import bisect_left
    from collections import Counter, defaultdict
    from itertools import accumulate

    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(byte_path)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=piece_path)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    vocab = {i: bytes(byte[c] for c in t) for t, i in json.load(open(byte_path, encoding="utf-8"))["model"]["vocab"].items() if t != "<|endoftext|>"}

    def piece(i):
        p = second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()

    rows, held = [], Counter()
    for text in texts:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        spelled = [[vocab[i] for i in a], [piece(i) for i in b]]
        if not text or not b"".join(spelled[0]) == b"".join(spelled[1]) == (" " + text).encode():
            a, b, spelled = [], [], [[], []]
        ends = [list(accumulate(map(len, s))) for s in spelled]
        common = sorted(set(ends[0]) & set(ends[1]))
        group = lambda end: bisect_left(common, end)
        sides = [defaultdict(list), defaultdict(list)]
        for side, ids in enumerate((a, b)):
            for i, end in zip(ids, ends[side]):
                sides[side][group(end)].append(i)
        links = [(x, y) for g in range(len(common)) for x in sides[0][g] for y in sides[1][g]]
        of_byte = [[i for i, t in enumerate(s) for _ in t] for s in spelled]
        shared = len(set(zip(*of_byte)))
        written = ";".join("|".join(",".join(map(str, s[g])) for s in sides) for g in range(len(common)))
        rows.append([len(a), len(b), len(common), shared, links, hashlib.sha256(written.encode()).hexdigest() if a else ""])
        held.update(set(links))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return [(n_a, n_b, n_g, over, len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), sha) for n_a, n_b, n_g, over, links, sha in rows]


def lexical(docs, items, top=20):
    """(item key, rank, doc_id, score) of every (key, text) in ``items`` against (doc_id, text) rows, one pair at a time."""
    import math
    import re
    from collections import Counter

    def terms(text):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)

    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n_docs, length = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for key, text in items:
        scores = []
        for d, c, n in counted:
            m = 100 - 25 + (25 * n * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if s > 0:
                scores.append((-s, d is None, d, s))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(key, i + 1, d, s) for i, (_, _, d, s) in enumerate(scores[:top])]
    return out


def nearest(rows, every, k):
    """(query_id, rank, vec_id, score) of the rows that take part, by all distances."""
    import math

    rows = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for q, v in rows:
        if q % every == 0:
            near = sorted((math.sqrt(sum((float(a) - float(b)) ** 2 for a, b in zip(v, w))), i) for i, w in rows if i != q and len(w) == len(v))
            out += [(q, r + 1, i, d) for r, (d, i) in enumerate(near[:k])]
    return out
