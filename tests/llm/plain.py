"""The pipeline's stages in plain Python, for small tables: rows are dicts, and every pair of texts is compared."""

import collections
import hashlib
import math

import regex

from countloom.llm import quality as rules

WORD = regex.compile(r"[^\x20\x09-\x0d]+")
PII = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def words(t):
    return WORD.findall(t or "")


def shingles(t):
    w = words((t or "").translate({i: i + 32 for i in range(65, 91)}))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def linked(a, b):
    return bool(a) and bool(b) and 100 * len(a & b) >= 75 * len(a | b)


def roots(ids, pairs):
    p = dict(zip(ids, ids, strict=True))

    def find(x):
        while p[x] != x:
            x = p[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        p[b] = a
    return {i: find(i) for i in ids}


def measures(t):
    t = t or ""
    w, n = words(t), lambda p: len(regex.findall(p, t))
    at = collections.defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i : i + 3])].append(i)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return {
        "n_words": len(w), "n_types": len(set(w)), "n_plain": sum(bool(regex.search(rules.PLAIN, x)) for x in w), "word_chars": sum(map(len, w)),
        "n_repeat_words": len({i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)}), "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)),
        "n_symbols": n("[#*$%&|<>]"), "n_upper": n(r"\p{Lu}"), "n_lower": n(r"[\p{Ll}\p{Lo}\p{M}]"), "n_digits": n("[0-9]"), "n_shouts": n("!"),
    }


def quality(rows):
    """The rows that the rules keep: votes, accuracies by expectation-maximisation, posteriors."""
    names, found = list(rules.RULES), []
    for r in rows:
        m = measures(r["text"])
        vote = tuple(0 if not m["n_words"] else -1 if eval(bad.replace("false", "False"), {}, m) else int(eval(good.replace("false", "False"), {}, m)) for bad, good in rules.RULES.values())
        found.append((vote, m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]))
    counts = collections.Counter(v for v, _ in found)
    n_all, share, accuracy = sum(counts.values()), rules.START_SHARE, [rules.START_ACCURACY] * len(names)

    def posterior(vote):
        good, bad = share, 1 - share
        for v, q in zip(vote, accuracy, strict=True):
            good *= 1 if v == 0 else q if v == 1 else 1 - q
            bad *= 1 if v == 0 else q if v == -1 else 1 - q
        return good / (good + bad)

    for _ in range(rules.ITERATIONS):
        p = {v: posterior(v) for v in counts}
        right = [rules.START_ACCURACY * rules.PRIOR * n_all + sum(n * (p[v] if v[k] == 1 else 1 - p[v] if v[k] == -1 else 0) for v, n in counts.items()) for k in range(len(names))]
        voted = [rules.PRIOR * n_all + sum(n for v, n in counts.items() if v[k]) for k in range(len(names))]
        share, accuracy = sum(n * p[v] for v, n in counts.items()) / n_all, [max(rules.LEAST, min(rules.LARGEST, a / b)) for a, b in zip(right, voted, strict=True)]
    return [r for r, (v, failed) in zip(rows, found, strict=True) if not failed and posterior(v) >= 0.5]


def near(rows):
    """One row of each component: the least id (null last), then the least digest of the text."""
    sets = [shingles(r["text"]) for r in rows]
    at = list(range(len(rows)))
    root = roots(at, [(i, j) for i in at for j in range(i) if linked(sets[i], sets[j])])
    order = lambda i: (rows[i]["doc_id"] is None, rows[i]["doc_id"] or 0, hashlib.md5((rows[i]["text"] or "").encode()).hexdigest())
    first = {}
    for i in at:
        if root[i] not in first or order(i) < order(first[root[i]]):
            first[root[i]] = i
    return [rows[i] for i in sorted(first.values())]


def valid(kind, m):
    d = [int(c) for c in m if c in "0123456789"]
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        return 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d[::-1])) % 10 == 0
    return kind != "phone" or 9 <= len(d) <= 15


def base_spans(t):
    return sorted((m.start(), k, m.end(), kind, m.group()) for k, (kind, p) in enumerate(PII) for m in regex.finditer(p, t) if valid(kind, m.group()))


def disclosing(texts, n=4, least=2, bits=1.0):
    """The terms that leave at most so many bits of an entity unknown."""
    contexts, beside, all_of = collections.defaultdict(set), collections.Counter(), collections.Counter()
    for t in texts:
        terms = [(m.start(), m.end(), m.group()) for m in regex.finditer(r"\p{L}{3,}", t.lower())]
        all_of.update(x for _, _, x in terms)
        places = set()
        for a, _, b, kind, value in base_spans(t):
            before, after = [x for x in terms if x[1] <= a][-n:], [x for x in terms if x[0] >= b][:n]
            for x in before + after:
                key = (f"{kind}:{value.lower()}", x[2])
                contexts[key].add((tuple(y[2] for y in before), tuple(y[2] for y in after)))
                places.add((*key, x[0]))
        beside.update((c, x) for c, x, _ in places)
    entity, total, out = collections.Counter(), sum(all_of.values()), set()
    for (c, _), k in beside.items():
        entity[c] += k
    for (c, x), k in beside.items():
        pmi, ic = math.log2(k * total / (entity[c] * all_of[x])), math.log2(total / entity[c])
        if len(contexts[c, x]) >= least and pmi >= ic - bits - 1e-9:
            out.add(x)
    return out


def spans(t, terms):
    base = base_spans(t)
    own = sorted(terms & {m.group() for m in regex.finditer(r"\p{L}{3,}", t.lower())})
    more = [(m.start(), 4, m.end(), "term", m.group()) for m in regex.finditer(rf"(?i)(?<!\p{{L}})(?:{'|'.join(own)})(?!\p{{L}})", t)] if own else []
    return sorted(base + [x for x in more if not any(b[0] < x[2] and x[0] < b[2] for b in base)])


def masked(rows):
    terms = disclosing([r["text"] or "" for r in rows])
    out = []
    for r in rows:
        t, parts, at = r["text"], [], 0
        for a, _, b, kind, _ in spans(t, terms) if t is not None else []:
            if b > at:
                parts += [] if a < at else [t[at:a], f"<{kind.upper()}>"]
                at = b
        text = None if t is None else "".join([*parts, t[at:]])
        out.append({**r, "text": text, "n_chars": None if text is None else len(text)})
    return out


def mix(rows, weights=(5, 2, 1), most=3):
    size = [len(words(r["text"])) for r in rows]
    total = collections.Counter()
    for r, n in zip(rows, size, strict=True):
        total[r["source"]] += n
    sources = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sources)}
    open_, target, left = set(sources), {}, float(sum(total.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if most * total[s] <= level * weight[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: float(most * total[s]) for s in full}
        left -= sum(target[s] for s in full)
        open_ -= full
    out = []
    for s in sources:
        key = lambda i: (hashlib.md5(f"{'' if rows[i]['doc_id'] is None else rows[i]['doc_id']}|mix".encode()).hexdigest()[:16], rows[i]["doc_id"] is not None, rows[i]["doc_id"] or 0, size[i])
        budget, at = math.floor(target[s] + 0.5), 0
        epochs = budget // total[s] if total[s] else 0
        for i in sorted((i for i, r in enumerate(rows) if r["source"] == s), key=key):
            taken = epochs * size[i] + max(0, min(size[i], budget - epochs * total[s] - at))
            at += size[i]
            out += [rows[i]] * (-(-taken // size[i]) if size[i] else 0)
    return out
