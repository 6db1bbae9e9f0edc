"""Plain Python versions of what the operators return, written from their contracts."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import defaultdict

import xxhash

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def turns(rows: list[tuple]) -> dict:
    """rows: conv_id, turn, role, text. conv_id -> n_turns, turns_sha256, loss_chars, loss_sha256."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, own in by.items():
        own.sort()
        loss = "".join(t for _, _, r, t in own if r == "assistant")
        out[conv] = (len(own), sha("".join(f"{r}\n{t}\n" for _, _, r, t in own)), len(loss), sha(loss))
    return out


def simhash(text: str) -> int:
    words = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(UPPER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows: list[tuple], radius: int = 2) -> dict:
    """doc_id -> fingerprint, component_id by comparing all pairs."""
    prints = {d: simhash(t) for d, t in rows}
    distinct = sorted(set(prints.values()))
    up = {f: f for f in distinct}

    def top(f: int) -> int:
        while up[f] != f:
            f = up[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= radius:
                up[top(a)] = top(b)
    least: dict[int, int] = {}
    for d, f in prints.items():
        least[top(f)] = min(d, least.get(top(f), d))
    return {d: (f"{f:016x}", least[top(f)]) for d, f in prints.items()}


def pieces(rows: list[tuple], path: str, capacity: int = 2048) -> list[tuple]:
    """doc_id, piece, start, length, ids_crc32."""
    import numpy as np
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    out = []
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or capacity
        starts = [0, *range(first, len(ids), capacity)]
        for n, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            out.append((doc, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return out


def media(text: str) -> tuple:
    """n_bytes, payload_bytes, payload_sha256, tail_crc32."""
    raw = (text or "").encode()
    padded = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
    return len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-32:])


def luhn(digits: str) -> bool:
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """kind, start, end of the fixed patterns."""
    text = text or ""
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15]
    return out


def personal(text: str) -> tuple:
    """n_email, n_ip, n_card, n_phone, base_sha256."""
    found = base_spans(text)
    return *[sum(s[0] == k for s in found) for k in ("email", "ip", "card", "phone")], sha(",".join(f"{k}:{a}:{b}" for k, a, b in found))


def rank_encoder(path: str, pattern: str):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encoded(text: str, encoder) -> tuple:
    """n_tokens, ids_sha256, decoded_sha256."""
    ids = encoder.encode_ordinary(text or "")
    return len(ids), sha(",".join(map(str, ids))), hashlib.sha256(encoder.decode_bytes(ids)).hexdigest()


def kept(rows: list[tuple]) -> dict:
    """doc_id -> keep_id, group_size, kept, text_sha256."""
    by = defaultdict(list)
    for doc, text in rows:
        by[(text or "").translate(UPPER)].append(doc)
    return {d: (max(own), len(own), d == max(own), sha(t)) for t, own in by.items() for d in own}


def _masked(text: str) -> str:
    out = list(text)
    for _, a, b in base_spans(text):
        out[a:b] = " " * (b - a)
    return "".join(out)


def _letters(text: str):
    """Runs of three or more letters."""
    import regex

    return regex.finditer(r"\p{L}{3,}+", text)


def disclosures(texts: list[str | None], support: int = 3, least: float = 0.8) -> dict:
    """Term or class -> its greatest disclosure, by counting documents, where it reaches ``least``."""
    from math import log2

    texts = [t or "" for t in texts]
    n, n_w, n_e, both, distinct = len(texts), defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(set)
    for text in texts:
        words = {m[0].lower() for m in _letters(_masked(text))}
        words |= {w[:k] + "*" for w in words for k in (4, 2)}
        own = {(k, v) for k, a, b in base_spans(text) for v in ("", text[a:b].lower())}
        for w in words:
            n_w[w] += 1
        for e in own:
            n_e[e] += 1
            for w in words:
                both[w, e] += 1
                distinct[w, e].add(text)
    out: dict[str, float] = {}
    for (w, e), k in both.items():
        if len(distinct[w, e]) >= support and n_e[e] < n:
            score = log2(k * n / (n_w[w] * n_e[e])) / log2(n / n_e[e])
            if score >= least - 1e-12:
                out[w] = max(out.get(w, 0.0), score)
    return out


def sanitised(texts: list[str | None], remove: float = 0.95) -> tuple[list[str | None], list[list[tuple]]]:
    """The cleaned texts, and of each text the spans of its terms."""
    found = disclosures(texts)
    cleaned, spans = [], []
    for text in texts:
        plain = text or ""
        terms = [(m.start(), m.end(), m[0].lower()) for m in _letters(_masked(plain)) if m[0].lower() in found]
        spans.append([("term", a, b) for a, b, _ in terms])
        puts = [(a, b, f"[{k.upper()}]") for k, a, b in base_spans(plain)]
        for a, b, w in terms:
            free = [w[:k] + "*" for k in (4, 2) if w[:k] + "*" not in found]
            puts.append((a, b, "" if found[w] >= remove else free[0] if free else "[TERM]"))
        out, at = "", 0
        for a, b, put in sorted(puts):
            if a >= at:
                out, at = out + plain[at:a] + put, b
            else:
                at = max(at, b)
        cleaned.append(out + plain[at:] if puts else text)
    return cleaned, spans


def near_classes(rows: list[tuple], shingle: int = 5) -> dict:
    """doc_id -> smallest doc_id of its class: texts linked by a Jaccard similarity of 0.8 of their shingles."""
    sets, up, holders = {}, {d: d for d, _ in rows}, defaultdict(list)
    for d, t in rows:
        words = (t or "").encode().lower().split()
        sets[d] = {tuple(words[i : i + shingle]) for i in range(len(words) - shingle + 1)} or {tuple(words)}

    def top(d):
        while up[d] != d:
            d = up[d]
        return d

    tried = set()
    for d, own in sets.items():
        for s in own:
            for o in holders[s]:
                if (o, d) not in tried:
                    tried.add((o, d))
                    if 5 * len(own & sets[o]) >= 4 * len(own | sets[o]) and (a := top(d)) != (b := top(o)):
                        up[max(a, b)] = min(a, b)
            holders[s].append(d)
    return {d: top(d) for d in sets}


def statistics(text: str) -> list[float]:
    """The statistics of the quality classifier, one character and one word at a time."""
    import math
    import unicodedata

    lower = upper = digit = space = symbol = other = 0
    for c in text:
        k = unicodedata.category(c)
        if k == "Ll":
            lower += 1
        elif k in ("Lu", "Lt"):
            upper += 1
        elif k.startswith("N"):
            digit += 1
        elif c.isspace():
            space += 1
        elif k[0] in "PSC":
            symbol += 1
        else:
            other += 1
    words, lines = text.split(), text.split("\n")
    n = len(words)

    def share(part: float, whole: float) -> float:
        return math.log((part + 0.5) / (whole + 1))

    letters, solid = max(1, lower + upper + other), max(1, len(text) - space)
    mean = sum(map(len, words)) / n if n else 0.0
    spread = math.sqrt(sum((len(w) - mean) ** 2 for w in words) / n) if n else 0.0
    ragged = [w for w in words if len(w) > 2 and not w[-1].isalnum() and not w[-2].isalnum()]
    return [
        math.log(1 + len(text)),
        math.log(1 + mean),
        share(upper, letters),
        share(symbol, solid),
        share(digit, solid),
        share(len(set(words)), n),
        share(sum(a == b for a, b in zip(words, words[1:])), n),
        share(max((words.count(w) for w in set(words)), default=0), n),
        share(sum(not any(c.isalnum() for c in w) for w in words), n),
        share(len(ragged), n),
        share(len(lines) - len(set(lines)), len(lines)),
        math.log(1 + spread),
    ]


def quality_scores(train: list[tuple], texts: list[str], shrink: float = 0.02, bound: float = 12.0) -> list[float]:
    """train: text, label. Scores by densities whose covariances are built and inverted outright."""
    import numpy as np

    x = np.array([statistics(t) for t, _ in train])
    y = np.array([l for _, l in train])
    covariances = [np.cov(x[y == k].T, bias=True) for k in (0, 1)]
    pooled = np.diag(sum(np.diag(c) * (y == k).sum() for k, c in enumerate(covariances)) / len(y))
    out = []
    for t in texts:
        density = []
        for k, c in enumerate(covariances):
            own = (1 - shrink) * c + shrink * pooled + 1e-4 * np.eye(len(pooled))
            away = np.array(statistics(t)) - x[y == k].mean(0)
            density.append(np.log((y == k).mean()) - 0.5 * np.linalg.slogdet(own)[1] - 0.5 * away @ np.linalg.inv(own) @ away)
        out.append(1 / (1 + np.exp(-np.clip(density[1] - density[0], -bound, bound))))
    return out


def toxicity_score(net, text: str, window: int = 32, stride: int = 16) -> float:
    """The score of a text's worst window: gates, attention and output one window and one word at a time."""
    import math

    import numpy as np

    p = {k: v.astype(float) for k, v in net.p.items()}
    h = len(p["look"]) // 2
    words = re.findall(r"\w+", text.lower())
    sig = lambda v: 1 / (1 + np.exp(-v))

    def vector(word: str):
        marked = f"<{word}>"
        rows = [p["gram"][net.grams.get(marked[i : i + 3], 0)] for i in range(len(marked) - 2)]
        return np.concatenate([p["word"][net.words.get(word, 0)], np.sum(rows, axis=0) / max(1, len(rows))]) @ p["in"] + p["in_b"]

    def read(inputs, up, rec):
        state, states = np.zeros(h), []
        for x in inputs:
            back = state @ up + rec
            z, r = sig(x[:h] + back[:h]), sig(x[h : 2 * h] + back[h : 2 * h])
            state = z * state + (1 - z) * np.tanh(x[2 * h :] + r * back[2 * h :])
            states.append(state)
        return states

    best, begin = -math.inf, 0
    while True:
        inputs = [vector(w) for w in words[begin : begin + window]]
        ahead = read([x[: 3 * h] for x in inputs], p["up_f"], p["rec_f"])
        behind = read([x[3 * h :] for x in inputs][::-1], p["up_b"], p["rec_b"])[::-1]
        states = np.array([np.concatenate(s) for s in zip(ahead, behind)]).reshape(-1, 2 * h)
        if len(states):
            looks = np.exp(states @ p["look"])
            pooled = (looks / looks.sum()) @ states
        else:
            pooled = np.zeros(2 * h)
        best = max(best, float(pooled @ p["out"] + p["out_b"][0]))
        begin += stride
        if begin >= max(1, len(words) - window + stride):
            return 1 / (1 + math.exp(-best))
