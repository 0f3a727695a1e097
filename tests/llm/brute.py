"""Plain versions of what the operators compute, one text at a time."""

import re
from collections import Counter, defaultdict
from hashlib import sha256
from math import log1p, log10

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def word_model(train):
    counts = Counter(w for t in train for w in WORD.findall(lower(t or "")))
    counts["<end>"] = len(train)
    return +counts


def base_score(counts, text):
    n, v = sum(counts.values()), len(counts)
    tokens = [*WORD.findall(lower(text or "")), "<end>"]
    score = sum(log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
    return len(tokens), sum(counts[t] > 0 for t in tokens), n, score


def quality_counts(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {i + j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(5)}
    lines, seen, copies = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            copies += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 10 or 100 * len(repeated) > 20 * n
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), copies, len(repeated), failed


def shingles(text, size=5):
    words = WORD.findall(text or "")
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def _luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    text = text or ""
    digits = lambda v: re.sub("[^0-9]", "", v)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 12 <= len(digits(v)) <= 19 and _luhn(digits(v))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(digits(v)) <= 15),
    ]
    found = [
        (m.start(), place, m.end(), kind)
        for place, (kind, pattern, good) in enumerate(kinds)
        for m in re.finditer(pattern, text)
        if good(m.group())
    ]
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def leaks(docs, items, least=0.8):
    """(doc, item) -> best similarity over all windows of the item's size, for those of ``least`` or more."""

    def bag(text):
        words = WORD.findall(lower(text or "").lower())
        return [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []

    found = {}
    for item, item_text in items:
        want = bag(item_text)
        if not want:
            continue
        counts = Counter(want)
        for doc, text in docs:
            have = bag(text)
            if not set(have) & set(want):
                continue
            size = min(len(want), len(have))
            for i in range(len(have) - size + 1):
                both = sum((Counter(have[i : i + size]) & counts).values())
                s = both / (size + len(want) - both)
                if s >= least and s > found.get((doc, item), (0,))[0]:
                    found[doc, item] = (s, i)
    return found


def alignments(texts):
    """Per id the columns of token alignment, byte by byte, with both libraries' own ids."""
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file="/opt/tokenizers/piece_bpe_32k.model")
    # The byte of every sign: printable ones stand for themselves, the others follow in order from 256.
    own = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    signs = {chr(b): b for b in own}
    signs.update((chr(256 + k), b) for k, b in enumerate(b for b in range(256) if b not in own))

    def pieces_of_one(text):
        return [(i, bytes(signs[c] for c in one.id_to_token(i))) for i in one.encode(" " + text, add_special_tokens=False).ids]

    def pieces_of_two(text):
        for i in two.encode(text):
            piece = two.id_to_piece(i)
            byte = re.fullmatch("<0x(..)>", piece) if two.is_byte(i) else None
            yield i, bytes([int(byte[1], 16)]) if byte else piece.replace("\u2581", " ").encode()

    found, counts = {}, Counter()
    for key, text in texts.items():
        a, b = (list(pieces_of_one(text)), list(pieces_of_two(text))) if text else ([], [])
        if any(b"".join(v for _, v in side) != (" " + (text or "")).encode() for side in (a, b)):
            a, b = [], []
        owners = [[k for k, (_, v) in enumerate(side) for _ in v] for side in (a, b)]
        links = [(a[x][0], b[y][0]) for x, y in sorted(set(zip(*owners)))]
        counts.update(links)
        ends = [set(), set()]
        for e, side in zip(ends, (a, b)):
            at = 0
            for _, v in side:
                at += len(v)
                e.add(at)
        shared, groups = sorted(ends[0] & ends[1]), defaultdict(lambda: ([], []))
        for place, side in enumerate((a, b)):
            at = k = 0
            for i, v in side:
                at += len(v)
                while shared[k] < at:
                    k += 1
                groups[shared[k]][place].append(str(i))
        listed = ";".join(f"{','.join(groups[e][0])}|{','.join(groups[e][1])}" for e in sorted(groups))
        found[key] = (len(a), len(b), len(groups), links, sha256(listed.encode()).hexdigest() if a else "")
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(n, most.get(y, 0))
    return {
        key: {
            "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": len(links),
            "n_best": sum(counts[x] == most[x[1]] for x in links), "count_sum": sum(counts[x] for x in links),
            "groups_sha256": digest,
        }
        for key, (n_a, n_b, n_groups, links, digest) in found.items()
    }


def passage_measures(text, module, word_hash):
    """The measurements of every passage of a text, counted one word at a time."""
    data = (text or "").encode()
    spans = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", data)]
    words = [data[a:b] for a, b in spans]
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    rows = []
    for k in range(0, max(1, len(words)), module.PASSAGE_WORDS):
        own = range(k, min(k + module.PASSAGE_WORDS, len(words)))
        if not own:
            rows.append([0.0] * module.WIDTH)
            continue
        classes, sketch = Counter(), [0.0] * module._BUCKETS
        for byte in data[spans[own[0]][0] : spans[own[-1]][1]]:
            c = chr(byte)
            kind = c if c in module._CLASSES else "beyond" if byte > 127 else "A-Z" if "A" <= c <= "Z" else "a-z" if "a" <= c <= "z" \
                else "0-9" if c in "0123456789" else "line" if c == "\n" else "other"
            classes[kind] += 1
        for i in own:
            h = word_hash(words[i])
            sketch[h % module._BUCKETS] += ((h >> 40) & 1) * 2 - 1
        length = max(2 * sum(v * v for v in sketch) ** 0.5, 1e-9)
        n, sizes = len(own), [len(words[i]) for i in own]
        mean = sum(sizes) / n
        seen = [words[i] in [words[j] for j in range(own[0], i)] for i in own]
        twice = [grams[tuple(words[i : i + 5])] > 1 for i in own]
        same = [i > 0 and words[i] == words[i - 1] for i in own]
        deviation = max(sum(v * v for v in sizes) / n - mean**2, 0) ** 0.5
        rows.append(
            [4 * classes[c] / sum(classes.values()) for c in module._CLASSES] + [v / length for v in sketch]
            + [2 * sum(seen) / n, 2 * sum(twice) / n, 2 * sum(same) / n, log1p(n) / 4, mean / 8, deviation / 8]
        )
    return rows


def attention_score(rows, p):
    """Gated attention over the passages of one text, with plain sums."""
    import math

    times = lambda x, m: [sum(a * b for a, b in zip(x, column)) for column in zip(*m)]
    hidden = [[math.tanh(v + b) for v, b in zip(times(x, p["w"]), p["b"])] for x in rows]
    energy = []
    for h in hidden:
        gate = [math.tanh(t) / (1 + math.exp(-s)) for t, s in zip(times(h, p["v"]), times(h, p["u"]))]
        energy.append(times(gate, p["a"])[0])
    weight = [math.exp(e) for e in energy]
    z = [sum(w * h[k] for w, h in zip(weight, hidden)) / sum(weight) for k in range(len(hidden[0]))]
    return 1 / (1 + math.exp(-times(z, p["c"])[0] - p["c0"][0]))
